"""HTML extraction, chat formatting and the whole pipeline."""

import hashlib
import time
from collections import Counter
from html.parser import HTMLParser

import pytest

import corpus_pipeline
from tidemark.llm import chat, decontaminate, html_text, queries, secrets_scan


def text_of(page):
    return html_text.Page(page).blocks(set())


def test_blocks():
    page = '<html><head><title>T</title><style>p{}</style></head><body><nav><p>menu</p></nav><div class="ad">Buy</div><article><h1>A &amp;&#65;</h1><p><b>x  y<br>z<p>next<script>var t="</p>";</script> one<aside>side</aside><!-- c --><ul><li>i<li>j</ul><form>f</form><section class="comments"><p>reader</p></section></article><footer>&copy;</footer></body>'
    assert text_of(page) == ["A &A", "x y z", "next one", "i", "j"]
    assert text_of("") == [] and text_of("plain < text & <b>bold</b>") == ["plain < text & bold"] and text_of("<p>cut <a hre") == ["cut"]
    assert text_of("<div>" * 5000 + "deep" + "</div>" * 5000) == ["deep"]


def test_hostile_pages():
    for page in ("<a " * 340_000, "<a " * 340_000 + ">", "<script>" + "</script " * 120_000, "<a \"'" * 200_000, "<!--" * 250_000, "<div " * 200_000):
        assert text_of(page) == []


def test_wrappers_and_teasers():
    assert text_of("<div class='site has-sidebar'><article><p>kept</p></article></div>") == ["kept"]
    assert text_of("<div class='no-comments layout-with-header'><p>kept</p></div><div class='site-footer'>gone</div>") == ["kept"]
    assert text_of("<main><article>one</article><article>two</article><p>own text</p></main>") == ["one", "two", "own text"]
    assert text_of("<body><div class='related'><article>teaser</article></div><article>the real text of this page</article>") == ["the real text of this page"]
    assert text_of("<form><div><article>in a form</article></div></form>") == ["in a form"]


def test_templates(spark):
    body = lambda i: f"<body><div><p>Follow our paper</p></div><div><p>story number {i} is here</p></div><div>All rights kept</div></body>"
    pages = [(i, f"https://a.example/{i}", body(i)) for i in range(6)] + [(i, "https://b.example/x", body(i)) for i in range(10, 12)] + [(20, None, None), (21, "x", ""), (22, "https://a.example/1", body(1)), (22, "https://a.example/1", body(1)), (None, None, body(1))]
    frame = spark.createDataFrame([(*p, "t", "h", "c") for p in pages], "page_id long, url string, html string, text string, host string, content string")
    rows = html_text.extract(frame).collect()
    got = {r.page_id: r.text for r in rows}
    assert len(rows) == len(pages) and got[3] == "story number 3 is here" and got[22] == "story number 1 is here"
    assert got[10] == "Follow our paper\n\nstory number 10 is here\n\nAll rights kept" and got[20] == got[21] == ""
    assert html_text.extract(frame.limit(0)).collect() == []


def test_many_copies_of_a_page(spark):
    body = lambda i: f"<div>Frame of the site</div><p>story {i}</p>"
    pages = [(i, "https://a.example/", body(i)) for i in range(6)] + [(100 + i, "https://a.example/", body(0)) for i in range(300)]
    rows = html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()
    assert len(rows) == 306 and {r.text for r in rows if r.page_id >= 100} == {"story 0"}


def test_templates_decide_inside_and_outside_the_article(spark):
    """Elements without a telling name: what recurs on the host and isn't prose goes, and stays on a host where it doesn't recur."""
    share = "<div><a href='#'>Send to a friend</a></div>"
    page = lambda i, inner, outer: f"<body><article><p>the same licence on every page</p>{inner}<p>own {i}</p></article>{outer}</body>"
    plain = lambda i, inner: f"<body><div>{inner}<p>own {i}</p></div><div>Town paper since 1901</div></body>"
    pages = [(i, "https://a.example/", page(i, share, "")) for i in range(9)] + [(i, "https://b.example/", page(i, share if i == 10 else "", "")) for i in range(10, 30)]
    pages += [(i, "https://c.example/", plain(i, "<section>Tip of the day</section>")) for i in range(40, 50)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[3] == "the same licence on every page\n\nown 3"
    assert got[10] == "the same licence on every page\n\nSend to a friend\n\nown 10"
    assert got[41] == "own 41"


def test_few_pages_of_many_do_not_make_a_template(spark):
    quote = "<p>a paragraph that some pages quote</p>"
    pages = [(i, "https://a.example/", f"<div><p>page {i}</p>{quote if i < 10 else ''}</div>") for i in range(60)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[2] == "page 2\n\na paragraph that some pages quote" and got[50] == "page 50"


class PlainArticle(HTMLParser):
    """Blocks of text in a page's article, by the standard library's parser: enough for pages whose only frame is around it."""

    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.open, self.out, self.part = 0, [], []
        self.feed(page)
        self.close()

    def cut(self):
        if text := " ".join("".join(self.part).split()):
            self.out.append(text)
        self.part = []

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.open += 1
        if tag == "br":
            self.part.append(" ")
        elif tag in ("article", "p", "h1", "ul", "li"):
            self.cut()

    def handle_endtag(self, tag):
        if tag in ("article", "p", "h1", "ul", "li"):
            self.cut()
        if tag == "article":
            self.open -= 1

    def handle_data(self, data):
        if self.open:
            self.part.append(data)


def test_extraction_against_a_plain_parser(spark, small):
    """Every given page has its text in one article."""
    want = {r.page_id: "\n\n".join(PlainArticle(r.html).out) if r.html else "" for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = {r.page_id: r for r in queries.op3_html_extraction(spark, small).collect()}
    assert {i: r.text for i, r in got.items()} == want and all(r.n_chars == len(r.text) for r in got.values())


def test_counts_decide_on_given_pages(spark, small):
    """Without any name and without the main element's bounds the counted templates alone leave the article; without them no page does."""
    pages = spark.read.parquet(f"{small.replace('sf0.001', 'sf0.01')}/pages.parquet")
    known = {}
    for r in html_text.templates(html_text.subtrees(html_text.keyed(pages))).join(html_text.keyed(pages).select("host", html_text.host_column("url").alias("name")).distinct(), "host").collect():
        known.setdefault(r.name, set()).add(r.subtree % (1 << 64))
    rows = [r for r in pages.collect() if r.html]
    hosts = Counter(html_text.host(r.url) for r in rows)
    large = [r for r in rows if hosts[html_text.host(r.url)] >= 5]
    alone = changed = 0
    for r in large:
        page, drops = html_text.Page(r.html), known.get(html_text.host(r.url), set())
        alone += page.blocks(drops, names=False) == PlainArticle(r.html).out
        changed += page.blocks(drops, names=False) != page.blocks(set(), names=False)
    print(f"counts alone leave the article on {alone} and change {changed} of {len(large)} pages of hosts with five or more")
    assert len(large) > 100 and alone == changed == len(large)


def test_shapes_recur_where_words_differ(spark):
    """Menus and notes of other words and lengths on each page, without telling names; a story in an unnamed element stays."""
    links = lambda i: "".join(f"<a href='#'>topic {i * j}</a>" for j in range(3, 5 + i % 3))
    plain = lambda i: f"<body><div class='x{i}'>{links(i)}</div><div>story {i} is told here in a few words and in some more</div></body>"
    lists = lambda i: f"<body><div><div>{links(i)}</div></div></body>"
    pages = [(i, "https://a.example/", plain(i)) for i in range(10)] + [(20 + i, "https://b.example/", lists(i)) for i in range(10)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[4] == "story 4 is told here in a few words and in some more"
    # a page that is a list of links is not its own menu
    assert all(got[20 + i] for i in range(10))


def test_names_that_only_qualify():
    """Sentences in elements whose class merely contains a telling word stay; what the word heads goes."""
    assert text_of('<article><div class="share-price">The price of a share rose.</div><section id="notice-period">Notice is three months here.</section></article>') == ["The price of a share rose.", "Notice is three months here."]
    assert text_of('<main><div class="search-results-explained">How results of a search are explained.</div></main>') == ["How results of a search are explained."]
    assert text_of('<article>kept<div class="share-links"><a>x</a></div><div class="share-price-box">12</div><div class="google-ads">Buy this thing, it is good for you.</div><div id="disqus_thread_2">A reader wrote this sentence.</div></article>') == ["kept"]


def test_marked_prose_goes_if_counted(spark):
    note = "<div class='notice-period'>The same sentence stands on every page.</div>"
    pages = [(i, "https://a.example/", f"<article><p>own {i}</p>{note}</article>") for i in range(6)] + [(9, "https://b.example/", f"<article><p>own</p>{note}</article>")]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got[2] == "own 2" and got[9] == "own\n\nThe same sentence stands on every page."


def test_many_anchors_take_linear_time():
    def seconds(n):
        start = time.process_time()
        html_text.Page("<div class=comments>" * n + "<article>x</article>" * n).blocks(set())
        return time.process_time() - start

    seconds(500)
    assert seconds(16_000) < 10 * seconds(4_000) + 0.5


@pytest.mark.parametrize("page", ["<p>" + "word " * 400_000, "<div>" * 3000 + "deep text" + "</p>" * 10, "<article><b>" + "<i>x" * 2000, "<ul>" + "<li><a>y</a>" * 3000])
def test_long_unclosed_and_deep_pages_in_spark(spark, page):
    frame = spark.createDataFrame([(1, "https://a.example/", page), (1, "https://a.example/", page), (2, None, page), (None, "", None)], "page_id long, url string, html string")
    got = sorted(html_text.extract(frame).collect(), key=lambda r: len(r.text))
    assert len(got) == 4 and got[0].text == "" and len({r.text for r in got[1:]}) == 1 and got[1].text


def test_chats(spark, small):
    rows = {r.conv_id: r for r in queries.op5_chat_formatting(spark, small).collect()}
    turns = {}
    for r in sorted(spark.read.parquet(f"{small}/conversations.parquet").collect(), key=lambda r: (r.conv_id, r.turn)):
        turns.setdefault(r.conv_id, []).append((r.role or "", r.text or ""))
    turns[-1] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    assert set(rows) == set(turns)
    for i, all_turns in turns.items():
        loss = "".join(t for r, t in all_turns if r == "assistant")
        assert rows[i].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in all_turns).encode()).hexdigest()
        assert (rows[i].n_turns, rows[i].loss_chars, rows[i].loss_sha256) == (len(all_turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())


@pytest.mark.parametrize("text", ["", None, "<", "[", "<\\", "<|turn|>user\nx<|end|>\n", "[INST]\\[", "\\", "a\n", "<|end|>", "é\U0001f600<"])
def test_texts_come_back(spark, text):
    frame = spark.createDataFrame([(1, 0, "user", text), (1, 1, "as\\sis\n<t\\n", text), (1, 2, "assistant", text), (1, 2, "assistant", text)], "conv_id long, turn long, role string, text string")
    made = chat.format_chat(frame).select("formatted", chat.read_back(chat.F.col("formatted")).alias("t"), chat.masked(chat.F.col("formatted"), chat.F.col("loss")).alias("m")).first()
    assert [(x.role, x.text) for x in made.t] == [("user", text or ""), ("as\\sis\n<t\\n", text or ""), ("assistant", text or ""), ("assistant", text or "")]
    assert made.m == (text or "") * 2 and made.formatted.count("<|turn|>") == 4 and "[INST]" not in made.formatted


def test_layouts(spark):
    kind = "id long, record struct<prompt: string, response: string, system: string, instruction: string, input: string, output: string, conversations: array<struct<`from`: string, value: string>>, other: string>"
    rows = [(1, ("p", "r") + (None,) * 6), (2, (None, None, None, "i", None, "o", None, None)), (3, (None, None, None, "i", "x", "o", None, None)), (4, (None,) * 6 + ([("human", "h"), ("gpt", None)], None)), (5, (None,) * 7 + ("?",)), (6, (None,) * 6 + ([], None)), (7, ("p", "r", "s") + (None,) * 5)]
    got = {}
    for r in sorted(chat.canonical_turns(spark.createDataFrame(rows, kind), "id").collect(), key=lambda r: (r.conv_id, r.turn or 0)):
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert got == {
        1: [("prompt", "user", "p"), ("prompt", "assistant", "r")], 2: [("instruction", "user", "i"), ("instruction", "assistant", "o")], 3: [("instruction_input", "user", "i"), ("instruction_input", "user", "x"), ("instruction_input", "assistant", "o")],
        4: [("conversations", "user", "h"), ("conversations", "assistant", "")], 5: [(None, "", "")], 7: [("system_prompt", "system", "s"), ("system_prompt", "user", "p"), ("system_prompt", "assistant", "r")],
    }


def test_layouts_of_each_record(spark):
    """One type of message can hold two layouts; a record of none is no turn; texts may all be null."""
    kind = "id long, turn string, record struct<messages: array<struct<role: string, content: string, `from`: string, value: string>>, x: string>"
    rows = [(1, "c", ([("user", "a", None, None), ("assistant", "b", None, None)], None)), (2, "c", ([(None, None, "human", "q"), (None, None, "gpt", "r")], None)), (3, "c", (None, "?")), (4, "c", ([("user", None, None, None)], None)), (5, "c", ([], None)), (None, "c", ([("user", "n", None, None)], None))]
    turns = chat.canonical_turns(spark.createDataFrame(rows, kind), "id")
    got = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id or 0, r.turn or 0)):
        got.setdefault(r.conv_id, []).append((r.layout, r.role, r.text))
    assert got == {1: [("messages", "user", "a"), ("messages", "assistant", "b")], 2: [("messages_from", "user", "q"), ("messages_from", "assistant", "r")], 3: [(None, "", "")], 4: [("messages", "user", "")], None: [("messages", "user", "n")]}
    made = {r.conv_id: r.formatted for r in chat.format_chat(turns).collect()}
    assert set(made) == {1, 2, 4, None} and made[2].count("<|turn|>") == 2
    assert chat.format_chat(turns.limit(0)).collect() == []


def test_pipeline(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    now, counts = docs, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, now, small)
        assert after.columns == docs.columns, name
        now = spark.createDataFrame(after.collect(), docs.schema)
        counts.append(now.count())
    assert counts[0] >= counts[1] > counts[2] > counts[3] == counts[4]
    texts = [r.text for r in now.collect()]
    items = decontaminate.Items([(r.item_id, r.text) for r in spark.read.parquet(f"{small}/benchmark.parquet").collect()])
    assert len(texts) == len(set(texts)) and not any(secrets_scan.scan(t)[0] for t in texts)
    assert not any(decontaminate.matches(items, t, 0.5) for t in texts)
    assert corpus_pipeline.run(spark, small).count() == counts[-1]


def test_pipeline_on_odd_rows(spark, small):
    schema = spark.read.parquet(f"{small}/documents.parquet").schema
    rows = [(1, "the a of and with words", "en", "s", 3), (1, "the a of and with words", "en", "s", 3), (None, "the same of and", None, None, None), (2, None, None, None, None), (3, "", None, None, None)]
    docs = spark.createDataFrame(rows, schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, small)
    assert sorted(str(r.doc_id) for r in docs.collect()) in (["1", "None"], ["1"])
    empty = spark.createDataFrame([], schema)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, small)
    assert empty.collect() == []
