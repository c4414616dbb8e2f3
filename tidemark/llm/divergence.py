"""How far sources of a language differ in their words: every pair of them, and the terms that set a source apart.

Counts are exact whole numbers. A pair of sources starts at V times the divergence of two terms that neither has, so terms missing
from both cost nothing; postings of the inverted index then emit corrections only. A term of one source alone is the same
correction for all terms of that count, so those come from the histogram of its counts; terms
of both come from a join of the postings of each term.

Tokens are counted by language and source in each task before anything is shuffled, so a source with a third of the rows
sends no more rows than it has terms. What a (language, term) holds is a row for each source.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.functions import lit

from .common import settle, small_batches

#: Documents of a language that must hold a term; denominator of probabilities; terms listed for a source.
MIN_DOCS, SCALE, TOP_TERMS = 3, 1_000_000_000, 200
#: Counted (language, source, term) triples that a task holds before it passes them on.
HELD = 300_000
#: Letters A-Z become a-z; other bytes below 128 that aren't letters part terms; bytes from 128 on are kept.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences) and df (rows that hold it): partial counts, to be summed."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}

        def drain() -> Iterator[pd.DataFrame]:
            for (lang, source), (n, df) in counts.items():
                if not n:
                    continue
                yield pd.DataFrame({"lang": lang, "source": source, "term": [t.decode() for t in n], "n": list(n.values()), "df": [df[t] for t in n]})
            counts.clear()

        for batch in batches:
            for lang, source, text in zip(batch["lang"], batch["source"], batch["text"]):
                terms = text.encode().translate(TERM_BYTES).split()
                n, df = counts.setdefault((lang, source), (Counter(), Counter()))
                n.update(terms)
                df.update(set(terms))
            if sum(len(n) for n, _ in counts.values()) > HELD:
                yield from drain()
        yield from drain()

    return docs.mapInPandas(run, "lang string, source string, term string, n long, df long")


def chance(n: Column, total: Column, kept: Column) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + kept)), exact for counts beyond 64 bits of the product."""
    return F.call_function("div", lit(SCALE).cast("decimal(10,0)") * (n + 1).cast("decimal(19,0)"), (total + kept).cast("decimal(20,0)")) + 1


def gap(p: Column, q: Column) -> Column:
    """floor((p - q) ** 2 / q)."""
    return F.call_function("div", (p - q) * (p - q), q)


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP_TERMS) -> DataFrame:
    """lang, source, part, item, value, rank. Part `pair`: the divergence of a source from each other source of its language,
    summed over the language's terms. Part `term`: the `top` terms by which a source exceeds its language.
    Null text, lang or source count as empty. A group without terms has probabilities of zero counts; a language
    without kept terms gives pairs of value 0 and no term. Repeated rows count each time; a table without rows gives none.
    Other columns aren't read."""
    small_batches(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), lit("")).alias(c) for c in ("lang", "source", "text")])
    summed = term_counts(rows).repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))
    term = W.partitionBy("lang", "term")  # a row for each source
    whole = summed.withColumns({"lang_df": F.sum("df").over(term), "lang_n": F.sum("n").over(term)})
    postings, _ = settle(whole.where(F.col("lang_df") >= min_docs).select("lang", "source", "term", "n", "lang_n"), "postings")

    of_source = postings.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = postings.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("kept"))
    groups = rows.select("lang", "source").distinct().join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left").na.fill(0, ["total", "lang_total", "kept"])
    none = F.when(F.col("kept") > 0, chance(lit(0), F.col("total"), F.col("kept"))).otherwise(lit(1))
    groups, _ = settle(groups.withColumn("p0", none), "groups")

    known = postings.join(groups, ["lang", "source"]).withColumn("p", chance(F.col("n"), F.col("total"), F.col("kept")))
    own = known.withColumn("q", chance(F.col("lang_n"), F.col("lang_total"), F.col("kept"))).where("p > q")
    best = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    terms = own.select("lang", "source", F.col("term").alias("item"), gap(F.col("p"), F.col("q")).alias("value")).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)

    one = groups.select("lang", "source", F.col("p0").alias("p0"), "kept")
    two = groups.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"))
    differ = F.col("source") != F.col("item")
    base = gap(F.col("p0"), F.col("q0"))
    started = one.join(two, "lang").where(differ).select("lang", "source", "item", (F.col("kept") * base).alias("value"))
    counts = known.groupBy("lang", "source", "p0", "p").agg(F.count("*").alias("terms"))
    of_one = counts.join(two, "lang").where(differ).groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (gap(F.col("p"), F.col("q0")) - base)).alias("value"))
    other = counts.select("lang", F.col("source").alias("item"), F.col("p0").alias("q0"), F.col("p").alias("q"), "terms")
    of_other = other.join(one, "lang").where(differ).groupBy("lang", "source", "item").agg(F.sum(F.col("terms") * (gap(F.col("p0"), F.col("q")) - base)).alias("value"))
    left = known.select("lang", "term", F.col("source").alias("a"), "p", "p0")
    right = known.select("lang", "term", F.col("source").alias("b"), F.col("p").alias("q"), F.col("p0").alias("q0"))

    def both(p, p0, q, q0) -> Column:
        """What a term of both adds to the corrections of each alone."""
        p, p0, q, q0 = map(F.col, (p, p0, q, q0))
        return gap(p, q) - gap(p, q0) - gap(p0, q) + gap(p0, q0)

    met = left.join(right, ["lang", "term"]).where("a < b").groupBy("lang", "a", "b").agg(F.sum(both("p", "p0", "q", "q0")).alias("ab"), F.sum(both("q", "q0", "p", "p0")).alias("ba"))
    of_both = met.select("lang", F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")))).alias("x")).select("lang", "x.*")
    value = started.union(of_one).union(of_other).union(of_both).groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = value.withColumn("rank", F.row_number().over(best))
    out = pairs.withColumn("part", lit("pair")).unionByName(terms.withColumn("part", lit("term")))
    return out.select("lang", "source", "part", "item", F.col("value").cast("long").alias("value"), F.col("rank").cast("int").alias("rank"))
