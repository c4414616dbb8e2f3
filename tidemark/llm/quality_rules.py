"""Quality rules as a short-circuit cascade: cost and selectivity of each rule are estimated on a sample, rules are
ordered by what they reject per cost, and a document is judged only until its first failure.

A rule needs features of the text; features are computed once for each text and shared. The sample
gives the time of every feature and which rules each of its rows fails. The order is greedy: next comes the rule that rejects the
most of the sample's surviving rows for the time of its features not computed by then. The order changes the work and
which failure is found first, never whether a document is kept.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from time import perf_counter_ns

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from .common import small_batches

#: Rows of the sample that costs and selectivities are estimated on (about; only the order of rules rests on it).
SAMPLE_ROWS = 2000
WORD = re.compile("[^ \t-\r]+")
SYMBOLS = "#*$%&|<>"


def repeat_words(words: list[str], size: int = 3) -> int:
    """Words that lie in a window of `size` words found twice or more in the text."""
    n = len(words)
    if n <= size:
        return 0
    ids = pd.factorize(np.array(words, dtype=object))[0]
    many, grams = int(ids.max()) + 1, ids
    for k in range(1, size):
        grams = pd.factorize(grams[:-1] * many + ids[k:])[0]  # below n * n
    twice = np.bincount(grams)[grams] > 1
    covered = np.zeros(n, bool)
    for k in range(size):
        covered[k : n - size + 1 + k] |= twice
    return int(covered.sum())


def dup_lines(text: str) -> tuple[int, int]:
    """Lines with a word, and those of them equal to an earlier line."""
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(lines), len(lines) - len(set(lines))


#: Features: name -> (features that it needs, function of the text and of the features so far).
FEATURES: dict[str, tuple[tuple[str, ...], Callable]] = {
    "words": ((), lambda text, f: WORD.findall(text)),
    "n_words": (("words",), lambda text, f: len(f["words"])),
    "word_chars": (("words",), lambda text, f: sum(map(len, f["words"]))),
    "n_symbols": ((), lambda text, f: sum(map(text.count, SYMBOLS))),
    "lines": ((), lambda text, f: dup_lines(text)),
    "n_dup_lines": (("lines",), lambda text, f: f["lines"][1]),
    "n_repeat_words": (("words",), lambda text, f: repeat_words(f["words"])),
    "n_upper": ((), lambda text, f: len(re.findall("[A-Z]", text))),
}


@dataclass(frozen=True)
class Rule:
    """Rejects a document if `fails` is true of its features."""

    name: str
    needs: tuple[str, ...]
    fails: Callable[[dict], bool]


#: Length and repetition, which every document must pass.
BASE = (
    Rule("few_words", ("n_words",), lambda f: f["n_words"] < 50),
    Rule("repetition", ("n_words", "n_repeat_words"), lambda f: 100 * f["n_repeat_words"] > 50 * f["n_words"]),
)
RULES = BASE + (
    Rule("symbols", ("n_words", "n_symbols"), lambda f: 100 * f["n_symbols"] > 30 * f["n_words"]),
    Rule("word_length", ("n_words", "word_chars"), lambda f: not 2 * f["n_words"] <= f["word_chars"] <= 20 * f["n_words"]),
    Rule("duplicate_lines", ("lines",), lambda f: 100 * f["lines"][1] > 60 * f["lines"][0]),
    Rule("capitals", ("word_chars", "n_upper"), lambda f: 100 * f["n_upper"] > 50 * f["word_chars"]),
)


def compute(name: str, text: str, known: dict, spent: dict | None = None) -> None:
    """Put a feature and what it needs into `known`; the time of each into `spent`."""
    if name in known:
        return
    needs, make = FEATURES[name]
    for other in needs:
        compute(other, text, known, spent)
    began = perf_counter_ns()
    known[name] = make(text, known)
    if spent is not None:
        spent[name] = spent.get(name, 0) + perf_counter_ns() - began


def judge(text: str, rules: tuple[Rule, ...], known: dict) -> str | None:
    """The first rule that the text fails; nothing after it is evaluated."""
    for rule in rules:
        for name in rule.needs:
            compute(name, text, known)
        if rule.fails(known):
            return rule.name
    return None


def closure(needs: tuple[str, ...]) -> set[str]:
    """Features and all that they need."""
    return {n for name in needs for n in {name} | closure(FEATURES[name][0])}


def estimate(docs: DataFrame, rules: tuple[Rule, ...], rows: int = SAMPLE_ROWS) -> tuple[dict[str, float], dict[int, int]]:
    """On a sample of about `rows` rows: nanoseconds of each feature a row, and for each set of failed rules (a bit each)
    its number of rows. No more than the sample's rows reach the driver."""
    names = sorted({n for r in rules for n in closure(r.needs)})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            failed, times = [], {n: [] for n in names}
            for text in batch["text"]:
                known, spent = {}, {}
                for name in names:
                    compute(name, text or "", known, spent)
                failed.append(sum(1 << i for i, r in enumerate(rules) if r.fails(known)))
                for n in names:
                    times[n].append(spent[n])
            yield pd.DataFrame({"failed": failed, **times})

    total = docs.count()
    sampled = docs.select(F.col("text").cast("string").alias("text")).sample(min(1.0, rows / max(total, 1)), seed=7)
    schema = "failed long, " + ", ".join(f"`{n}` long" for n in names)
    found = sampled.mapInPandas(run, schema).groupBy("failed").agg(F.count("*").alias("_rows"), *[F.sum(n).alias(n) for n in names]).collect()
    seen = max(1, sum(r["_rows"] for r in found))
    return {n: sum(r[n] for r in found) / seen for n in names}, {r["failed"]: r["_rows"] for r in found}


def order(rules: tuple[Rule, ...], cost: dict[str, float], failed: dict[int, int]) -> tuple[Rule, ...]:
    """Rules by rejected surviving rows per further cost, one after another; ties keep the given order."""
    left, alive, done, out = list(range(len(rules))), dict(failed), set(), []
    while left:

        def worth(i: int) -> float:
            rejects = sum(n for mask, n in alive.items() if mask >> i & 1)
            return rejects / (1.0 + sum(cost[n] for n in closure(rules[i].needs) - done))

        best = max(left, key=worth)
        left.remove(best)
        done |= closure(rules[best].needs)
        alive = {mask: n for mask, n in alive.items() if not mask >> best & 1}
        out.append(rules[best])
    return tuple(out)


def cascade(docs: DataFrame, rules: tuple[Rule, ...] = RULES, report: tuple[str, ...] = (), rows: int = SAMPLE_ROWS) -> DataFrame:
    """docs with a struct `quality`: failed (a rule that the row fails, the first in the order of the sample; null if it is
    kept), kept, and the integer features named in `report`, which are computed for all rows. A null text counts as empty.
    Any other column is kept and not read; one called quality is replaced. An empty table stays empty."""
    small_batches(docs.sparkSession)
    chosen = order(rules, *estimate(docs, rules, rows))

    @F.pandas_udf("failed string, kept boolean" + "".join(f", `{n}` long" for n in report))
    def verdicts(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            known: dict = {}
            failed = judge(text or "", chosen, known)
            for name in report:
                compute(name, text or "", known)
            out.append((failed, failed is None, *[known[n] for n in report]))
        return pd.DataFrame(out, columns=["failed", "kept", *report])

    return docs.withColumn("quality", verdicts(F.col("text").cast("string")))
