"""Token ids in word-aligned Simple-8b blocks.

A 64-bit word holds a selector in its upper four bits and as many equally wide ids in
the others as the selector says; ids over 60 bits follow an escape word verbatim.  A
file is a table of blocks in id order, each with the ids of whole documents, the number
of ids before it in its shard, and the lengths of its documents, so any block decodes by
itself and without a loop over ids.  Shards are ranges of document ids: Spark sorts
within them, and its committer makes a lost task's files good.

Defined cases: a NULL text is empty and has the end id only; rows that share an id stand
in the order of their ids; NULL ids come first; an empty table gives no blocks; other
columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import quoted, shared_dir
from heddle.llm.common import id_bounds
from heddle.llm.tokens import encoder, slices

#: Ids per word and bits per id by selector; 0 is the escape, 1 a run of zeros.
COUNTS = (1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)
#: A block is closed when it holds this many ids.
BLOCK = 1 << 16


_SMALL = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _widths(ids: np.ndarray, n: int) -> np.ndarray:
    """Bits of every id; one too many where a double cannot tell, which only costs space."""
    if n and int(ids.max()) < len(_SMALL):
        return _SMALL[ids.astype(np.uint16)]
    return np.frexp(ids.astype(np.float64))[1].astype(np.uint8)


def pack(ids: np.ndarray) -> np.ndarray:
    """64-bit words of non-negative ids, packed greedily from the front."""
    ids = np.asarray(ids, np.uint64)
    n = len(ids)
    choice = np.zeros(n, np.int8)
    widest = _widths(ids, n)
    widths = [np.concatenate([widest, np.zeros(max(COUNTS), np.uint8)])]  # of 1, 2, 4 ... ids together
    while 2 << len(widths) <= 2 * max(COUNTS):
        half = 1 << (len(widths) - 1)
        widths.append(np.maximum(widths[-1][: len(widths[-1]) - half], widths[-1][half:]))
    for selector in range(15, 0, -1):  # a smaller selector holds more ids and wins
        count = COUNTS[selector]
        level = count.bit_length() - 1
        ahead = count - (1 << level)
        window = np.maximum(widths[level][:n], widths[level][ahead : ahead + n])
        choice[window <= BITS[selector]] = selector
    step, starts, at = np.array(COUNTS)[choice].tolist(), [], 0
    while at < n:
        starts.append(at)
        at += step[at]
    starts = np.array(starts, np.int64)
    chosen = choice[starts].astype(np.int64)
    place = np.cumsum(np.where(chosen == 0, 2, 1)) - np.where(chosen == 0, 2, 1)
    words = np.zeros(int(place[-1] + (2 if chosen[-1] == 0 else 1)) if n else 0, np.uint64)
    padded = np.concatenate([ids, np.zeros(max(COUNTS), np.uint64)])
    for selector in np.unique(chosen):
        mine = chosen == selector
        if selector == 0:
            words[place[mine] + 1] = ids[starts[mine]]
            continue
        word = np.full(int(mine.sum()), np.uint64(selector) << np.uint64(60), np.uint64)
        for k in range(COUNTS[selector] if BITS[selector] else 0):
            word |= padded[starts[mine] + k] << np.uint64(k * BITS[selector])
        words[place[mine]] = word
    return words


def unpack(words: np.ndarray, n: int) -> np.ndarray:
    """The first ``n`` ids of packed words."""
    words = np.asarray(words, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for at in np.flatnonzero(selector == 0).tolist():  # escapes only
        if not raw[at]:
            raw[at + 1] = True
    count = np.where(raw, 0, np.array(COUNTS)[selector])
    start = np.cumsum(count) - count
    out = np.zeros(int(count.sum()), np.uint64)
    for s in np.unique(selector[~raw]):
        mine = np.flatnonzero((selector == s) & ~raw)
        if s == 0:
            out[start[mine]] = words[mine + 1]
            continue
        low = np.uint64((1 << BITS[s]) - 1)
        for k in range(COUNTS[s] if BITS[s] else 0):
            out[start[mine] + k] = (words[mine] >> np.uint64(k * BITS[s])) & low
    return out[:n]


def _encoded(docs: DataFrame, path: str, end_id: int, bounds: list) -> DataFrame:
    """Rows (shard, doc_id, ids) of the documents; ids take two bytes where the vocabulary allows."""
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("doc_id", docs.schema["doc_id"].dataType),
        T.StructField("wide", T.BooleanType()), T.StructField("ids", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, limits = encoder(path), np.array(bounds)
        wide = max(own.library.get_vocab_size(), end_id) > 1 << 16
        end = np.array([end_id], "<u4")
        for batch in batches:
            for first, texts in slices(batch.column(1)):
                keys = batch.column(0).slice(first, len(texts))
                ids = [np.concatenate([x, end]).astype("<u4" if wide else "<u2").tobytes() for x in own.encode(texts)]
                shard = [0 if k is None else int(np.searchsorted(limits, k)) for k in keys.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shard, pa.int32()), keys, pa.array([wide] * len(ids)), pa.array(ids, pa.binary())], schema.names
                )

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def write(docs: DataFrame, path: str, end_id: int, folder: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> str:
    """Encode ``docs`` and write their ids, in ascending id order, as blocks; returns the folder."""
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    spark = docs.sparkSession
    folder = folder or f"{shared_dir(spark)}/tokens-{uuid.uuid4().hex}"
    bounds = id_bounds(docs, "doc_id")
    shards = max(1, len(bounds))
    sorted_rows = _encoded(docs, path, end_id, bounds).repartitionById(shards, F.col("shard"))
    sorted_rows = sorted_rows.sortWithinPartitions("shard", F.asc_nulls_first("doc_id"), "ids")
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("shard", T.IntegerType()), T.StructField("id_offset", T.LongType()), T.StructField("n_ids", T.LongType()),
        T.StructField("doc_ids", T.ArrayType(id_type)), T.StructField("lengths", T.ArrayType(T.LongType())),
        T.StructField("words", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, parts, shard, before, size, key_type = [], [], None, 0, 0, None

        def block() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            return pa.RecordBatch.from_arrays([
                pa.array([shard], pa.int32()), pa.array([before], pa.int64()), pa.array([len(ids)], pa.int64()),
                pa.array([keys], pa.list_(key_type)), pa.array([[len(p) for p in parts]], pa.list_(pa.int64())),
                pa.array([pack(ids).astype("<u8").tobytes()], pa.binary()),
            ], schema.names)

        for batch in batches:
            key_type = batch.column(1).type
            for s, key, wide, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if parts and (s != shard or size >= BLOCK):
                    yield block()
                    before, keys, parts, size = before + size if s == shard else 0, [], [], 0
                shard = s
                keys.append(key)
                parts.append(np.frombuffer(ids, "<u4" if wide else "<u2"))
                size += len(parts[-1])
        if parts:
            yield block()

    sorted_rows.mapInArrow(run, schema).write.parquet(folder)
    return folder


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Per document of the files: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` (little-endian 32-bit, binary).

    The lengths of the shards, at most one number per range of ids, reach the driver.
    """
    blocks = spark.read.parquet(folder)
    schema = T.StructType([
        T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])
    upto, before = 0, {}
    for row in blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).orderBy("shard").collect():
        before[row["shard"]], upto = upto, upto + row["n"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, offset, n, lengths, words = (batch.column(c)[row].as_py() for c in (0, 1, 2, 4, 5))
                ids = unpack(np.frombuffer(words, "<u8"), n).astype("<u4")
                ends = np.cumsum(lengths)
                starts = ends - np.array(lengths)
                yield pa.RecordBatch.from_arrays([
                    batch.column(3)[row].values, pa.array(before[shard] + offset + starts, pa.int64()),
                    pa.array(lengths, pa.int64()), pa.array([ids[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()),
                ], schema.names)

    return blocks.mapInArrow(run, schema)


def digests(docs: DataFrame) -> DataFrame:
    """``read``'s rows with ``ids_crc32`` in place of the ids."""
    return docs.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())
