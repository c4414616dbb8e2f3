"""Language identification by a byte convolutional network.

The network reads fixed-length windows of UTF-8 bytes: a byte embedding, filters of several
widths with a rectifier, the maximum of each filter over the window, and a softmax. It is trained
with numpy on a bounded sample of labelled windows; a whole text is cut into windows without a
gap, and the windows' class probabilities are averaged by their number of letters' bytes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import small_batches

WINDOW = 256
#: Bytes that a filter sees; `tables` spells these widths out.
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBED = 8
#: Windows the network is trained on, at most: shared out evenly over the languages.
TRAIN_WINDOWS = 6_000
#: Texts of each language, at least, however many languages there are.
EACH = 16
UNDETERMINED = "und"


def windows(text: str) -> np.ndarray:
    """The whole text's lower-case bytes, (windows, WINDOW) and padded with zeros. Each window starts
    max(WIDTHS) - 1 bytes before the last one's end, so no filter position is lost."""
    data = np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)
    step = WINDOW - max(WIDTHS) + 1
    n = max(1, -(-(len(data) - max(WIDTHS) + 1) // step))
    padded = np.zeros((n - 1) * step + WINDOW, np.uint8)
    padded[: len(data)] = data
    return sliding_window_view(padded, WINDOW)[::step]


class ByteNet:
    """weights: emb (256, EMBED); w<k> (k * EMBED, FILTERS) and b<k> for each width; out, bias."""

    def __init__(self, classes: list[str], weights: dict[str, np.ndarray] | None = None, seed: int = 0):
        self.classes, g = classes, np.random.default_rng(seed)
        if weights is None:
            weights = {"emb": g.normal(0, 0.5, (256, EMBED)), "out": g.normal(0, 0.2, (FILTERS * len(WIDTHS), len(classes))), "bias": np.zeros(len(classes))}
            for k in WIDTHS:
                weights |= {f"w{k}": g.normal(0, (2 / (k * EMBED)) ** 0.5, (k * EMBED, FILTERS)), f"b{k}": np.zeros(FILTERS)}
        self.weights = {k: v.astype(np.float32) for k, v in weights.items()}

    def pooled(self, x: np.ndarray, trace: list | None = None) -> np.ndarray:
        emb, parts = self.weights["emb"][x], []
        for k in WIDTHS:
            seen = sliding_window_view(emb, k, axis=1).transpose(0, 1, 3, 2).reshape(len(x), -1, k * EMBED)
            made = seen.reshape(-1, k * EMBED) @ self.weights[f"w{k}"]
            made = made.reshape(len(x), -1, FILTERS)
            top = made.max(1)
            if trace is not None:
                at = made.argmax(1)
                trace.append((at, np.take_along_axis(seen, at[:, :, None], 1)))
            parts.append(np.maximum(top + self.weights[f"b{k}"], 0))
        return np.concatenate(parts, 1)

    def tables(self) -> None:
        """A filter is a sum over its bytes, so its value is looked up by pairs of bytes: 16-bit
        tables at a common scale, whose sums can't overflow."""
        emb, pair = self.weights["emb"].astype(np.float64), np.arange(1 << 16)
        part = lambda k, i: emb @ self.weights[f"w{k}"][i * EMBED : (i + 1) * EMBED]
        two = lambda k, i: part(k, i)[pair >> 8] + part(k, i + 1)[pair & 255]
        whole = [two(2, 0), two(3, 0), part(3, 2), two(4, 0), two(4, 2)]
        self.scale = 16_000 / max(np.abs(t).max() for t in whole)
        self.parts = [np.ascontiguousarray(np.round(t * self.scale).astype(np.int16)) for t in whole]

    def proba(self, x: np.ndarray) -> np.ndarray:
        """After `tables`: class probabilities of windows, 64 at a time; positions come first, so each maximum runs over whole rows."""
        tops = []
        for i in range(0, len(x), 64):
            byte = np.ascontiguousarray(x[i : i + 64].T)
            pair = (byte[:-1].astype(np.intp) << 8) | byte[1:]
            two, three, third, front, back = (t.take(at, 0, mode="clip") for t, at in zip(self.parts, (pair, pair[:-1], byte[2:].astype(np.intp), pair[:-2], pair[2:])))
            three += third
            front += back
            tops.append(np.concatenate([np.maximum.reduce(t, 0) for t in (two, three, front)], 1))
        z = np.concatenate(tops) / self.scale + np.concatenate([self.weights[f"b{k}"] for k in WIDTHS])
        z = np.maximum(z, 0) @ self.weights["out"] + self.weights["bias"]
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 5, steps: int = 600, rate: float = 4e-3, batch: int = 64, seed: int = 0) -> None:
        """Adam on the cross-entropy; only each filter's best position has a gradient. At least
        `epochs` passes and about `steps` steps, so a small sample is seen more often."""
        g, m, step = np.random.default_rng(seed), {}, 0
        for _ in range(max(epochs, -(-steps * batch // len(x)))):
            for rows in np.array_split(g.permutation(len(x)), max(1, len(x) // batch)):
                trace: list = []
                h = self.pooled(x[rows], trace)
                z = h @ self.weights["out"] + self.weights["bias"]
                p = np.exp(z - z.max(1, keepdims=True))
                p /= p.sum(1, keepdims=True)
                p[np.arange(len(rows)), y[rows]] -= 1
                p /= len(rows)
                grads = {"out": h.T @ p, "bias": p.sum(0), "emb": np.zeros_like(self.weights["emb"])}
                dh = (p @ self.weights["out"].T) * (h > 0)
                for n, k in enumerate(WIDTHS):
                    d, (at, seen) = dh[:, n * FILTERS : (n + 1) * FILTERS], trace[n]
                    grads[f"b{k}"] = d.sum(0)
                    grads[f"w{k}"] = np.einsum("rfi,rf->if", seen, d)
                    de = (d[:, :, None] * self.weights[f"w{k}"].T).reshape(len(rows), FILTERS, k, EMBED)
                    where = x[rows][np.arange(len(rows))[:, None, None], at[:, :, None] + np.arange(k)]
                    np.add.at(grads["emb"], where.ravel(), de.reshape(-1, EMBED))
                step += 1
                for name, d in grads.items():
                    a, b = m.get(name, (0, 0))
                    a, b = 0.9 * a + 0.1 * d, 0.99 * b + 0.01 * d * d
                    m[name] = a, b
                    self.weights[name] -= (rate * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)).astype(np.float32)

    def predict(self, text: str | None) -> tuple[str, float]:
        """The whole text's language and mean probability; `und`, 0 if it has no letter."""
        if not text or not self.classes or not any(map(str.isalpha, text)):
            return UNDETERMINED, 0.0
        x = windows(text)
        weight = (((x >= 97) & (x <= 122)) | (x >= 128)).sum(1) + 1e-3
        p = weight @ self.proba(x) / weight.sum()
        best = int(p.argmax())
        return self.classes[best], float(min(1.0, max(0.0, p[best])))


def remainder(doc_id: Column) -> Column:
    """crc32 of doc_id as text, mod 3: 1 marks the rows that are held out of training."""
    return F.crc32(doc_id.cast("string")) % 3


def fit(docs: DataFrame, train_windows: int = TRAIN_WINDOWS, seed: int = 0) -> ByteNet:
    """Train on texts with a lang and a remainder other than 1: train_windows of them at most, shared out
    evenly over the languages, but EACH of every language at least, so none is left out (the network has an output
    for each). The sample is by hash of doc_id; each text gives one to four windows. Without labelled
    rows the network has no class and answers `und`."""
    spark, cut = docs.sparkSession, 4 * WINDOW  # characters brought to the driver for each sampled row
    known = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "") & (F.coalesce(remainder(F.col("doc_id")), F.lit(1)) != 1)
    )
    counts = known.groupBy("lang").count().collect()  # as many as the network has classes
    if not counts:
        return ByteNet([])
    each = max(EACH, train_windows // len(counts))
    # enough by hash that `each` are left with near certainty, then the first `each` of them
    share = [(r["lang"], min(1 << 30, int((1 << 30) * (each + 6 * each**0.5 + 20) / r["count"]))) for r in counts]
    limits = F.broadcast(spark.createDataFrame(share, "lang string, top long"))
    lot = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed)), F.lit(1 << 30))
    start = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(seed + 1)), F.greatest(F.lit(1), F.length("text") - WINDOW // 2)).cast("int")
    drawn = known.join(limits, "lang").where(lot < F.col("top")).select("lang", "doc_id", F.substring(F.col("text"), start + 1, F.lit(cut)).alias("text"), lot.alias("lot"))
    first = drawn.withColumn("n", F.row_number().over(W.partitionBy("lang").orderBy("lot", "doc_id", "text"))).where(F.col("n") <= each)
    rows = first.orderBy("lot", "doc_id", "lang", "text").collect()
    classes = sorted({r["lang"] for r in rows})
    each = max(1, min(4, train_windows // len(rows)))
    parts = [windows(r["text"])[:each] for r in rows]
    x = np.concatenate(parts)
    y = np.repeat([classes.index(r["lang"]) for r in rows], [len(p) for p in parts])
    net = ByteNet(classes, seed=seed)
    # a second copy with a random share of its tail blanked teaches short texts
    g = np.random.default_rng(seed)
    short = x.copy()
    short[np.arange(WINDOW)[None, :] >= g.integers(12, WINDOW, len(x))[:, None]] = 0
    net.train(np.concatenate([x, short]), np.concatenate([y, y]), seed=seed)
    return net


def identify(docs: DataFrame, net: ByteNet, reject: float | None = None) -> DataFrame:
    """All columns of docs, then lang_pred and score (replacing columns of those names).
    reject: leave out rows that are `und` or score less. Null, empty and letterless texts are
    `und` with score 0; a null doc_id and repeated rows pass through."""
    small_batches(docs.sparkSession)
    kept = docs.drop("lang_pred", "score")
    schema = kept.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    columns = [*kept.columns, "lang_pred", "score"]
    net.tables()
    at, sent = kept.columns.index("text"), docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for b in batches:
            found = [model.predict(t) for t in b.column(at).to_pylist()]
            out = pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], columns
            )
            if reject is not None:
                out = out.filter(pa.array([x != UNDETERMINED and s >= reject for x, s in found], pa.bool_()))
            yield out

    return kept.mapInArrow(run, schema)


def held_out(doc_id: int) -> bool:
    """The rule of `remainder` in Python, for tests: a row without an id is never held out, nor trained on."""
    return zlib.crc32(str(doc_id).encode()) % 3 == 1
