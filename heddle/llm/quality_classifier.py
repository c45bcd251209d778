"""Quality classifier: histogram gradient-boosted trees over document statistics.

Tasks turn whole texts into ``FEATURES`` numbers.  The trees are grown on the driver
from a sample of labelled rows of at most ``TRAIN_ROWS`` (by hash of the id, so the same
at every run), with gradients summed per histogram bin.  A grown forest is four flat
arrays; a batch of documents walks through all trees at once in numpy.

Defined cases: a NULL or empty text has zero statistics and a score like any other; rows
without a label, or with a label of NULL, are only scored; with no labelled rows, or
labels of one kind, the score is the smoothed share of label 1; repeated rows are scored
one by one, repeated labels of one id all count; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import cut, quoted

FEATURES = (
    "chars", "words", "word_length", "longest_word", "distinct_words", "distinct_pairs", "top_word", "stutter", "lines",
    "line_words", "equal_lines", "upper", "digits", "blanks", "symbols", "punctuation", "not_ascii", "entropy",
    "wordless", "sentence_ends",
)
TRAIN_ROWS = 20_000
BINS = 64
TREES = 80
DEPTH = 4
RATE = 0.15
LEAST_WEIGHT = 1.0
SHRINK = 1.0

_CLASS = np.zeros((256, 6), np.int64)  # upper, digits, blanks, symbols, other punctuation, not ASCII
_CLASS[65:91, 0] = _CLASS[48:58, 1] = 1
_CLASS[[9, 10, 11, 12, 13, 32], 2] = 1
_CLASS[[ord(c) for c in "#*$%&|<>"], 3] = 1
_CLASS[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in "#*$%&|<>"], 4] = 1
_CLASS[128:, 5] = 1


def statistics(text: str | None) -> np.ndarray:
    """Numbers that describe a whole text; the same for equal texts."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    n, size = len(words), len(raw)
    if not n:
        return np.zeros(len(FEATURES), np.float32)
    counts = Counter(words)
    lengths = np.fromiter(map(len, words), np.int64, n)
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    bytes_ = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    shares = bytes_[bytes_ > 0] / size
    classes = bytes_ @ _CLASS / size
    bare = wordless(counts)
    stutter = sum(a == b for a, b in zip(words, words[1:]))
    ends = sum(c for w, c in counts.items() if w[-1:] in (b".", b"!", b"?"))
    return np.array([
        math.log1p(size), math.log1p(n), lengths.mean(), math.log1p(lengths.max()), len(counts) / n, pairs / max(n - 1, 1),
        max(counts.values()) / n, stutter / n, math.log1p(len(lines)), math.log1p(n / len(lines)), 1 - len(set(lines)) / len(lines),
        *classes, float(-(shares * np.log2(shares)).sum()), bare / n, ends / n,
    ], np.float32)


def wordless(counts: Counter) -> int:
    """Words without a letter."""
    return sum(c for w, c in counts.items() if not any(b > 127 or 65 <= b <= 90 or 97 <= b <= 122 for b in w))


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` of whole texts."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("stats", T.ArrayType(T.FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t.as_py()) for t in batch.column(1)]
            flat = np.concatenate(stats) if stats else np.zeros(0, np.float32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(stats) + 1) * len(FEATURES), pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


@dataclass(frozen=True)
class Forest:
    """Complete trees of equal depth, level by level: ``feature`` and ``cut`` of the inner nodes, ``value`` of the leaves."""

    start: float
    feature: np.ndarray  # trees x inner nodes
    cut: np.ndarray
    value: np.ndarray  # trees x leaves

    def score(self, x: np.ndarray) -> np.ndarray:
        """Chance of label 1 per row of ``x``."""
        trees, inner = self.feature.shape
        total = np.full(len(x), self.start)
        if not trees:
            return 1 / (1 + np.exp(-total))
        base, node = np.arange(trees) * inner, np.zeros((len(x), trees), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(int(math.log2(inner + 1))):
            at = base + node
            node = 2 * node + 1 + (x[rows, self.feature.ravel()[at]] > self.cut.ravel()[at])
        leaves = self.value.ravel()[np.arange(trees) * self.value.shape[1] + node - inner]
        return 1 / (1 + np.exp(-(total + leaves.sum(1))))


def grow(
    x: np.ndarray, y: np.ndarray, trees: int = TREES, depth: int = DEPTH, bins: int = BINS, rate: float = RATE
) -> Forest:
    """Boosted trees for labels 0 and 1 by histograms of gradients."""
    inner, width = (1 << depth) - 1, x.shape[1] if x.ndim == 2 else 0
    share = (y.sum() + 1) / (len(y) + 2)
    start = float(np.log(share / (1 - share)))
    empty = Forest(start, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)))
    if len(np.unique(y)) < 2:
        return empty
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)], 1)
    flat = binned + np.arange(width) * bins
    margin = np.full(len(y), start)
    feature, cuts, value = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(len(y), np.int64)
        own_feature, own_cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = (1 << level) - 1, 1 << level
            key = ((node - first)[:, None] * (width * bins) + flat).ravel()
            size = count * width * bins
            gs = np.bincount(key, np.repeat(g, width), size).reshape(count, width, bins)
            hs = np.bincount(key, np.repeat(h, width), size).reshape(count, width, bins)
            gl, hl = gs.cumsum(2), hs.cumsum(2)
            gt, ht = gl[:, :, -1:], hl[:, :, -1:]
            gain = gl**2 / (hl + SHRINK) + (gt - gl) ** 2 / (ht - hl + SHRINK) - gt**2 / (ht + SHRINK)
            gain[(hl < LEAST_WEIGHT) | (ht - hl < LEAST_WEIGHT)] = 0
            gain[:, :, -1] = 0
            for f, e in enumerate(edges):
                gain[:, f, len(e) :] = 0
            best = gain.reshape(count, -1).argmax(1)
            for i in range(count):
                f, b = divmod(int(best[i]), bins)
                if gain[i, f, b] > 1e-6:
                    own_feature[first + i], own_cut[first + i] = f, edges[f][b]
            mine = own_feature[node]
            node = 2 * node + 1 + (x[np.arange(len(y)), mine] > own_cut[node])
        leaf = node - inner
        gsum, hsum = np.bincount(leaf, g, inner + 1), np.bincount(leaf, h, inner + 1)
        own_value = -rate * gsum / (hsum + SHRINK)
        margin += own_value[leaf]
        feature.append(own_feature)
        cuts.append(own_cut)
        value.append(own_value)
    return Forest(start, np.array(feature), np.array(cuts), np.array(value))


def train(stats: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, **options) -> Forest:
    """Forest from at most ``rows`` labelled rows.  ``labels``: ``doc_id`` and ``label`` (0 or 1)."""
    known = stats.join(labels.filter("label IN (0, 1)").select("doc_id", "label"), "doc_id")
    picked = known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "label").limit(rows).select("stats", "label").toPandas()
    x = np.array(picked["stats"].tolist(), np.float64).reshape(len(picked), len(FEATURES))
    return grow(x, picked["label"].to_numpy(np.float64), **options)


def classify(
    docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7, rows: int = TRAIN_ROWS,
    id_col: str = "doc_id", text_col: str = "text", **options,
) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of all rows, learning from labelled rows not held out.

    ``held_out`` is a condition on ``doc_id``.  The statistics, a few numbers per
    document, are written once: texts are read a single time.
    """
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    stats = cut(measured(docs), "stats")
    forest = train(stats.filter(~F.coalesce(held_out, F.lit(False))), labels, rows, **options)
    schema = T.StructType([*stats.schema.fields[:1], T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, len(FEATURES)).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(forest.score(x))], schema.names)

    marked = stats.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "stats")
    return marked.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
