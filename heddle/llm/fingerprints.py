"""Document fingerprints of improbable features.

Every window of 64 bytes has an entropy; over all documents Spark counts how frequent
each entropy is, and a window's rank is the rarity of its own.  In every run of 64
neighbouring windows the rarest one gains a point, and windows with 16 points or more
are the document's features.  They go in order into a chain of Bloom filters of 2048
bits, 160 features each.  Two fingerprints are compared filter by filter: the bits in
common, less what chance and a margin explain, as a share of the most there could be;
each filter of the shorter chain counts with its best partner.

Defined cases: a NULL text is empty and has the empty fingerprint, which is like another
empty one and like nothing else; a text below 64 bytes is one feature; a text in which no
window has 16 points (few windows, or a short period) has its rarest window; rows of equal id follow by text; NULL ids are the
last; a lone document is its own successor; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import quoted
from heddle.llm.common import bucket_of, id_bounds

WINDOW = 64
POPULAR = 16
BITS = 2048
FEATURES = 160
HASHES = 5
MARGIN = 0.1
LEVELS = 1000
#: Bytes that are walked at once; the arrays for them fit a core's cache.
CHUNK = 150_000

_PLOGP = np.array([0] + [round(c * np.log2(c) * (1 << 20)) for c in range(1, WINDOW + 1)], np.int64)
_ODD = np.arange(1, 17, 2, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) | np.uint64(1)


def entropies(data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entropy level (0 to 1000) of the window that ends at each byte, and whether one ends there.

    ``data`` holds texts one after another.  Sliding a window changes two counts; what
    the entering and the leaving byte add is found for all places at once.
    """
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, bool)
    place = np.arange(n)
    start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    end = np.repeat(np.cumsum(lengths), lengths) - 1
    order = np.argsort(data, kind="stable")
    byte = data[order].astype(np.int64) * (n + 1)
    line = byte + order
    rank = np.arange(n)
    back, ahead = np.empty(n, np.int64), np.empty(n, np.int64)
    back[order] = rank - np.searchsorted(line, byte + np.maximum(order - (WINDOW - 1), start[order]))
    ahead[order] = np.searchsorted(line, byte + np.minimum(order + (WINDOW - 1), end[order]), "right") - rank - 1
    change = _PLOGP[back + 1] - _PLOGP[back]
    leaves = place - start >= WINDOW
    gone = place[leaves] - WINDOW
    change[leaves] -= _PLOGP[ahead[gone] + 1] - _PLOGP[ahead[gone]]
    run = np.cumsum(change)
    run -= np.where(start > 0, run[start - 1], 0)
    most = int(np.log2(WINDOW))
    bits = most - run / (WINDOW * float(1 << 20))
    return np.clip((bits * LEVELS / most).astype(np.int64), 0, LEVELS), place - start >= WINDOW - 1


def rarity(docs: DataFrame) -> np.ndarray:
    """Rank of every entropy level, the rarest first, from the windows of all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(LEVELS + 1, np.int64)
        for batch in batches:
            for data, lengths in _joined(batch.column(0).to_pylist()):
                level, valid = entropies(data, lengths)
                counts += np.bincount(level[valid], minlength=LEVELS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS + 1)), pa.array(counts)], ["level", "n"])

    counts = docs.select("text").mapInArrow(run, "level long, n long").groupBy("level").agg(F.sum("n").alias("n"))
    total = np.zeros(LEVELS + 1, np.int64)
    for row in counts.collect():
        total[row["level"]] = row["n"]
    rank = np.empty(LEVELS + 1, np.int64)
    rank[np.lexsort((np.arange(LEVELS + 1), total))] = np.arange(LEVELS + 1)
    return rank


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _joined(texts: list[str | None], size: int = CHUNK) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Texts as bytes, a few at a time."""
    held, total = [], 0
    for t in texts:
        held.append(_bytes(t))
        total += len(held[-1])
        if total >= size:
            yield np.frombuffer(b"".join(held), np.uint8), np.array([len(h) for h in held], np.int64)
            held, total = [], 0
    if held:
        yield np.frombuffer(b"".join(held), np.uint8), np.array([len(h) for h in held], np.int64)


def features(texts: list[bytes], rank: np.ndarray) -> list[np.ndarray]:
    """Hashes of each text's features, in order and without repeats."""
    data, lengths = np.frombuffer(b"".join(texts), np.uint8), np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    level, valid = entropies(data, lengths)
    worst = np.int64(1) << 62
    line = np.where(valid, (rank[level] << 32) + np.arange(len(data)), worst) if len(data) else np.zeros(0, np.int64)
    low, width = line, 1
    while width < WINDOW and len(low) > width:  # the least of 2, 4, ... 64 neighbours
        low, width = np.minimum(low[:-width], low[width:]), 2 * width
    owner = np.repeat(np.arange(len(texts)), lengths)
    full = np.zeros(0, np.int64)
    if width == WINDOW and len(low):
        first = np.arange(len(low))
        inside = valid[first] & (owner[first] == owner[first + WINDOW - 1])
        full = low[inside] & 0xFFFFFFFF
    picked = np.flatnonzero(np.bincount(full, minlength=len(data)) >= POPULAR) if len(data) else full
    none = np.bincount(owner[picked], minlength=len(texts)) == 0
    few = np.flatnonzero((lengths >= WINDOW) & none)  # no window with enough points
    single = [int(line[starts[i] : starts[i] + lengths[i]].min() & 0xFFFFFFFF) for i in few]
    picked = np.sort(np.concatenate([picked, np.array(single, np.int64)]))
    windows = data[(picked - (WINDOW - 1))[:, None] + np.arange(WINDOW)].view(np.uint64) if len(picked) else np.zeros((0, 8), np.uint64)
    mixed = windows ^ (windows >> np.uint64(31))
    key = (mixed * _ODD).sum(1, dtype=np.uint64)
    key = (key ^ (key >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    key ^= key >> np.uint64(29)
    cuts = np.searchsorted(picked, np.append(starts, len(data)))
    out = []
    for i, text in enumerate(texts):
        own = key[cuts[i] : cuts[i + 1]]
        if 0 < len(text) < WINDOW:
            own = np.array([xxhash.xxh3_64_intdigest(text)], np.uint64)
        _, at = np.unique(own, return_index=True)
        out.append(own[np.sort(at)])
    return out


def chain(keys: np.ndarray) -> np.ndarray:
    """Bloom filters of feature hashes, one packed row of 256 bytes each."""
    filters = np.zeros((-(-len(keys) // FEATURES), BITS), np.uint8)
    row = np.arange(len(keys)) // FEATURES
    for k in range(HASHES):
        filters[row, ((keys >> np.uint64(11 * k)) & np.uint64(BITS - 1)).astype(np.int64)] = 1
    return np.packbits(filters, axis=1)


def written(filters: np.ndarray) -> str:
    """Fingerprint as text: the number of filters and their bits."""
    return f"{len(filters)}:{base64.b64encode(filters.tobytes()).decode()}"


def parsed(fingerprint: str) -> np.ndarray:
    n, _, body = fingerprint.partition(":")
    return np.frombuffer(base64.b64decode(body), np.uint8).reshape(int(n), BITS // 8)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """0 to 1: normalised overlap of two chains."""
    if a.shape == b.shape and (a == b).all():
        return 1.0
    if not len(a) or not len(b):
        return 0.0
    if len(a) > len(b):
        a, b = b, a
    x, y = np.ascontiguousarray(a).view(np.uint64), np.ascontiguousarray(b).view(np.uint64)
    ones_x, ones_y = np.bitwise_count(x).sum(1).astype(float), np.bitwise_count(y).sum(1).astype(float)
    best = np.zeros(len(x))
    for i in range(len(x)):
        common = np.bitwise_count(x[i] & y).sum(1)
        chance, most = ones_x[i] * ones_y / BITS, np.minimum(ones_x[i], ones_y)
        floor = chance + MARGIN * (most - chance)
        best[i] = np.max(np.clip((common - floor) / np.maximum(most - floor, 1e-9), 0, 1))
    return float((best * ones_x).sum() / ones_x.sum())


def fingerprints(texts: list[str | None], rank: np.ndarray) -> list[np.ndarray]:
    """Chains of some texts."""
    return [chain(k) for k in features([_bytes(t) for t in texts], rank)]


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by as much of the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def compare_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of all texts and of their edits, with likenesses.

    The next document is the one before in id order; each range of ids is one sorted
    partition, which also gets the row that follows its last one.
    """
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    rank = rarity(docs)
    bounds = id_bounds(docs, "doc_id")
    ranges = max(1, len(bounds))
    own = bucket_of(F.col("doc_id"), bounds)
    places = F.array(F.struct(F.col("_own").alias("range"), F.lit(False).alias("tail")))
    if bounds:  # the highest row of a range follows the lowest of the range above; the first follows the last
        edge = F.col("doc_id") == F.get(F.lit(bounds) if len(bounds) > 1 else F.array(F.lit(bounds[0])), F.col("_own"))
        above = F.struct(((F.col("_own") + 1) % ranges).cast("int").alias("range"), F.lit(True).alias("tail"))
        places = F.when(edge, F.concat(places, F.array(above))).otherwise(places)
    dealt = docs.withColumn("_own", own).withColumn("_p", F.explode(places)).select("doc_id", "text", "_p.range", "_p.tail")
    rows = dealt.repartitionById(ranges, F.col("range")).sortWithinPartitions(
        "tail", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text")
    )
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("n_chars", T.LongType()),
        T.StructField("edited_sha256", T.StringType()), T.StructField("fingerprint", T.StringType()),
        T.StructField("edited_fingerprint", T.StringType()), T.StructField("near_edited", T.DoubleType()),
        T.StructField("near_next", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # (id, text) in order; the last one waits for its successor
        first, last, id_type, done = None, None, None, False

        def answered(rows_: list[tuple], after: str) -> pa.RecordBatch:
            texts = [t for _, t in rows_]
            follow = [*texts[1:], after]
            edits = [edited(t, f) for t, f in zip(texts, follow)]
            chains = fingerprints([*texts, after, *edits], rank)
            own_, edit = chains[: len(texts) + 1], chains[len(texts) + 1 :]
            return pa.RecordBatch.from_arrays([
                pa.array([k for k, _ in rows_], id_type), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([hashlib.sha256(_bytes(e)).hexdigest() for e in edits]),
                pa.array([written(c) for c in own_[:-1]]), pa.array([written(c) for c in edit]),
                pa.array([likeness(a, b) for a, b in zip(own_, edit)], pa.float64()),
                pa.array([likeness(a, b) for a, b in zip(own_, own_[1:])], pa.float64()),
            ], schema.names)

        size = 0
        for batch in batches:
            id_type = batch.column(0).type
            for key, text, tail in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(3).to_pylist()):
                if tail:
                    last = text.as_py() or "" if last is None else last
                    done = True
                    continue
                text = text.as_py() or ""
                first = text if first is None else first
                if held and 2 * size >= CHUNK:  # each text and its edit
                    yield answered(held, text)
                    held, size = [], 0
                held.append((key, text))
                size += len(text)
        if held:
            yield answered(held, last if done else first)

    return rows.mapInArrow(run, schema)
