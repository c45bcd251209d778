"""Near copies by SimHash, found through deletion variants of few segments.

A fingerprint has 64 bits; two of them link when at most three bits differ.  Cut into two
segments, one of the two differs by at most one bit.  Every segment is indexed once per bit
with that bit wiped out (``variants``), so linked fingerprints meet under an equal key; the
join verifies all 64 bits.  Fingerprints whose segments are equal meet under the first key
alone: under the others only those join that differ in the wiped bit.

Exact copies are one fingerprint, so the index grows with different fingerprints.  A key
that more than ``SHORT`` of them share is not joined: one task connects them (``connect``).
The fingerprints of a key with more than ``LONG`` agree in 31 bits, and their other segment is
indexed in the same way (two segments of 16 bits).  What still shares a key then agrees in
46 bits: at most 2^18 different fingerprints, which one task takes whole and connects by
looking up their neighbours.  So no group grows with the data, no link is lost, and pairs of
a large group are never listed.

Components take the links, contracted within tasks before the rounds of joins.

Defined cases: a text without words, or NULL, has fingerprint zero and links like any
other; fewer than three words are one shingle; repeated shingles count as often as they
occur; repeated rows are all returned; a NULL id is never a component's id while the
component has another; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from heddle.functions.runtime import cut, quoted
from heddle.llm.ngram_join import contracted
from heddle.operators.graph import connected_components

WIDTH = 3
SEED = 42
#: Fingerprints link at this many differing bits or fewer; the index is built for it.
DISTANCE = 3
#: Fingerprints under one key that are joined with each other; more are compared in one task.
SHORT = 32
#: Fingerprints under one key that one task compares; more are indexed again.
LONG = 4096
#: Shingles whose bits are summed at once.
BLOCK = 1 << 16


def shingle_hashes(text: bytes, width: int = WIDTH) -> np.ndarray:
    """XXH64 of all shingles of a lower-cased text, in order."""
    words = text.lower().split()
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        return np.array([digest(b" ".join(words), SEED)], np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist())
    return np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)


def fingerprint(hashes: np.ndarray) -> int:
    """The 64-bit fingerprint as an unsigned number: bits that more than half of the hashes have."""
    counts = np.zeros(64, np.int64)
    for i in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[i : i + BLOCK].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(((2 * counts > len(hashes)).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum())


def fingerprints(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row ``doc_id`` and ``fp``, the fingerprint's bits as a long."""
    docs = docs.select(quoted(id_col).alias("doc_id"), F.coalesce(quoted(text_col).cast("string"), F.lit("")).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(shingle_hashes(t.as_py(), width)) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


def _part(fp: Column, at: int, size: int) -> Column:
    return F.shiftrightunsigned(fp, at).bitwiseAND((1 << size) - 1)


def variants(rows: DataFrame, keys: list[str], segments: list[tuple[int, int]]) -> DataFrame:
    """Every row once per bit of every segment: ``keys``, ``key`` (the segment without that bit) and ``bit``.

    A segment is its lowest bit and its size.  ``key`` also names the segment and the bit.
    ``bit`` is what was wiped out, and NULL under a segment's first key, where all meet.
    """
    made = []
    for number, (at, size) in enumerate(segments):
        for i in range(size):
            wiped = _part(F.col("fp"), at, size).bitwiseAND(((1 << size) - 1) ^ (1 << i))
            key = F.shiftleft(wiped, 8).bitwiseOR(number * 32 + i)
            bit = F.lit(None).cast("long") if i == 0 else _part(F.col("fp"), at + i, 1)
            made.append(F.struct(key.alias("key"), bit.alias("bit")))
    return rows.select(*keys, "fp", F.explode(F.array(*made)).alias("v")).select(*keys, "fp", "v.key", "v.bit")


def shared(indexed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key several fingerprints have, with their number ``n`` and an order ``at`` among them."""
    own = Window.partitionBy(*keys)
    both = indexed.withColumn("n", F.count(F.lit(1)).over(own)).filter("n > 1")
    return cut(both, "shared")


def joined(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Links (``src``, ``dst``) among rows of equal keys, verified on all bits."""
    a = rows.select(*keys, F.col("fp").alias("src"), F.col("bit").alias("_a"))
    b = rows.select(*keys, F.col("fp").alias("dst"), F.col("bit").alias("_b"))
    close = F.bit_count(F.col("src").bitwiseXOR(F.col("dst"))) <= DISTANCE
    met = F.col("_a").isNull() | (F.col("_a") != F.col("_b"))
    return a.join(b, keys).filter((F.col("src") < F.col("dst")) & met & close).select("src", "dst")


def connect(fps: np.ndarray) -> np.ndarray:
    """Per fingerprint the place of one that stands for all it is connected with.

    Few fingerprints are compared directly.  Many differ in few bits only: those bits give
    each its place in a table, and each looks up all places at most ``DISTANCE`` bits away.
    """
    fps = fps.astype(np.uint64)
    label = np.arange(len(fps))

    def unite(u: np.ndarray, v: np.ndarray) -> None:
        nonlocal label
        while True:
            a, b = label[u], label[v]
            apart = a != b
            if not apart.any():
                return
            u, v, a, b = u[apart], v[apart], a[apart], b[apart]
            root = np.arange(len(label))
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while True:  # follow to the end
                further = root[root]
                if (further == root).all():
                    break
                root = further
            label = root[label]

    varying = np.bitwise_or.reduce(fps ^ fps[0]) if len(fps) else np.uint64(0)
    places = [i for i in range(64) if int(varying) >> i & 1]
    near = [0]
    for _ in range(DISTANCE):
        near += [m | 1 << i for m in near for i in range(m.bit_length(), len(places))]
    masks = sorted(set(near) - {0}, key=lambda m: (m.bit_count(), m))
    if len(fps) <= len(masks) or len(places) > 18:
        for i in range(len(fps) - 1):
            hit = np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= DISTANCE) + i + 1
            unite(np.full(len(hit), i), hit)
        return label
    code = np.zeros(len(fps), np.int64)
    for at, place in enumerate(places):
        code |= ((fps >> np.uint64(place)) & np.uint64(1)).astype(np.int64) << at
    table = np.full(1 << len(places), -1, np.int64)
    table[code] = np.arange(len(fps))
    for mask in masks:
        other = table[code ^ mask]
        here = np.flatnonzero(other >= 0)
        unite(here, other[here])
    return label


def connected(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Links that connect what is linked among rows of equal keys; a group is bounded by the caller."""

    def run(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy()
        label = connect(fps.view(np.uint64))
        apart = label != np.arange(len(fps))
        return pa.table({"src": fps[label[apart]], "dst": fps[apart]})

    return rows.select(*keys, "fp").groupBy(*keys).applyInArrow(run, "src long, dst long")


def crowded(rows: DataFrame) -> DataFrame:
    """``rows`` (``key, fp``) under the first key, ``outer``, and a key on the segment that it does not name."""
    high = F.col("key").bitwiseAND(32) == 0  # keys of segment 0 hold the low half
    other = F.when(high, F.shiftrightunsigned("fp", 32)).otherwise(F.col("fp").bitwiseAND((1 << 32) - 1))
    halves = rows.select(F.col("key").alias("outer"), F.col("fp").alias("whole"), other.alias("fp"))
    again = variants(halves, ["outer", "whole"], [(0, 16), (16, 16)])
    return again.select("outer", "key", F.col("whole").alias("fp"), "bit")


def links(fps: DataFrame) -> DataFrame:
    """Links between different fingerprints (``fp``) that connect all that are linked."""
    met = shared(variants(fps.select("fp"), [], [(0, 32), (32, 32)]), ["key"])
    short, long = F.col("n") <= SHORT, F.col("n") > LONG
    found = joined(met.filter(short), ["key"]).unionByName(connected(met.filter(~short & ~long), ["key"]))
    if met.filter(long).isEmpty():
        return found
    deep = shared(crowded(met.filter(long)), ["outer", "key"])
    found = found.unionByName(joined(deep.filter(short), ["outer", "key"]))
    return found.unionByName(connected(deep.filter(~short), ["outer", "key"]))


def dedup(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ``doc_id``, ``fingerprint`` (hex) and ``component_id``, the least id that it reaches by links."""
    rows = cut(fingerprints(docs, width, id_col, text_col), "fingerprints")
    fps = cut(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    linked = cut(contracted(links(fps)), "links")
    ends = linked.select(F.col("src").alias("node")).unionByName(linked.select(F.col("dst").alias("node"))).distinct()
    parts = connected_components(linked, ends).withColumnRenamed("node", "fp")
    named = fps.join(parts, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    answer = named.join(least, "component").select("fp", "component_id")
    return rows.join(answer, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
