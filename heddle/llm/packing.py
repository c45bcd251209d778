"""Packing documents into training windows, online and with bounded space.

Every task walks its documents once and keeps ``open_windows`` open windows.  What a
document has beyond full windows goes to the window where it fits best.  If it fits
nowhere, the fullest window is emitted; should more than ``slack`` ids be missing there,
the piece is cut to fill it.  Windows left open at the end of the tasks are merged whole,
best fit first, in groups of tasks.  Nothing is shuffled but those leftovers.

Defined cases: a NULL or empty text is the end id alone; repeated rows are packed one by
one; an empty table gives no pieces; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import cut, quoted
from heddle.llm.token_files import crc32
from heddle.llm.tokens import encoder, slices

WINDOW = 1024
OPEN = 64
SLACK = 8
#: Tasks whose leftovers are merged together.
MERGED = 64


class OpenWindows:
    """Open windows by free space, numbered as they are made."""

    def __init__(self, size: int, most: int, slack: int):
        self.size, self.most, self.slack = size, most, slack
        self.gaps: list[tuple[int, int]] = []  # (free ids, window), sorted
        self.made = 0

    def _new(self) -> int:
        self.made += 1
        return self.made - 1

    def place(self, length: int) -> tuple[list[tuple[int, int, int]], list[int]]:
        """Pieces (window, start, length) of a document, and the windows emitted on the way."""
        pieces, emitted, start = [], [], 0
        while length - start >= self.size:
            pieces.append((self._new(), start, self.size))
            emitted.append(pieces[-1][0])
            start += self.size
        if start == length:
            return pieces, emitted
        at = bisect_left(self.gaps, (length - start, -1))
        if at < len(self.gaps):  # the tightest window that takes it
            gap, window = self.gaps.pop(at)
            left = gap - (length - start)
        else:
            if len(self.gaps) >= self.most:
                gap, window = self.gaps.pop(0)
                emitted.append(window)
                if gap > self.slack:
                    pieces.append((window, start, gap))
                    start += gap
            window, left = self._new(), self.size - (length - start)
        pieces.append((window, start, length - start))
        if left:
            insort(self.gaps, (left, window))
        else:
            emitted.append(window)
        return pieces, emitted

    def rest(self) -> list[int]:
        return [window for _, window in self.gaps]


def _schema(id_type: T.DataType) -> T.StructType:
    return T.StructType([
        T.StructField("doc_id", id_type), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
        T.StructField("part", T.IntegerType()), T.StructField("is_open", T.BooleanType()),
    ])


def place(docs: DataFrame, path: str, end_id: int, size: int, open_windows: int, slack: int) -> DataFrame:
    """Pieces with their windows; those of windows left open are marked."""
    schema = _schema(docs.schema["doc_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, own = TaskContext.get().partitionId(), encoder(path)
        state = OpenWindows(size, open_windows, slack)
        held: dict[int, list] = {}  # pieces of the open windows
        end, id_type, rows = np.array([end_id], "<u4"), None, []

        def emit(window: int, is_open: bool) -> None:
            offset = 0
            for key, start, length, crc, total in held.pop(window):
                rows.append((key, start, length, crc, total, (part << 33) + window, offset, part, is_open))
                offset += length

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*rows))
            types = [id_type, *[pa.int64()] * 6, pa.int32(), pa.bool_()]
            rows.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], schema.names)

        for batch in batches:
            id_type = batch.column(0).type
            keys = batch.column(0).to_pylist()
            for first, texts in slices(batch.column(1)):
                for key, ids in zip(keys[first:], own.encode(texts)):
                    ids = np.concatenate([ids, end])
                    pieces, emitted = state.place(len(ids))
                    for window, start, length in pieces:
                        row = (key, start, length, crc32(ids[start : start + length]), len(ids))
                        held.setdefault(window, []).append(row)
                    for window in emitted:
                        emit(window, False)
                if rows:
                    yield flushed()
        for window in state.rest():
            emit(window, True)
        if rows:
            yield flushed()

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def merge(pieces: DataFrame, size: int, tasks: int) -> DataFrame:
    """Windows left open, merged whole within groups of tasks."""
    schema = pieces.schema

    def run(table: pa.Table) -> pa.Table:
        order = np.lexsort((table.column("offset").to_numpy(), table.column("sequence_id").to_numpy()))
        table = table.take(pa.array(order))
        window, length = table.column("sequence_id").to_numpy(), table.column("length").to_numpy()
        names, first = np.unique(window, return_index=True)
        filled = np.add.reduceat(length, first)
        gaps: list[tuple[int, int]] = []
        target, shift, made = {}, {}, 0
        for i in np.lexsort((names, -filled)).tolist():  # the fullest first
            need = int(filled[i])
            at = bisect_left(gaps, (need, -1))
            if at < len(gaps):
                gap, bin_ = gaps.pop(at)
            else:
                gap, bin_, made = size, made, made + 1
            target[i], shift[i] = bin_, size - gap
            insort(gaps, (gap - need, bin_))
        group = int(table.column("part")[0].as_py()) // tasks
        at = np.repeat(np.arange(len(names)), np.diff(np.append(first, len(window))))
        sequence = np.array([(1 << 62) + (group << 33) + target[i] for i in at.tolist()], np.int64)
        offset = table.column("offset").to_numpy() + np.array([shift[i] for i in at.tolist()], np.int64)
        table = table.set_column(schema.names.index("sequence_id"), "sequence_id", pa.array(sequence))
        return table.set_column(schema.names.index("offset"), "offset", pa.array(offset))

    key = F.floor(F.col("part") / F.lit(tasks)).alias("group")
    return pieces.groupBy(key).applyInArrow(run, schema)


def pack(
    docs: DataFrame, path: str, end_id: int, size: int = WINDOW, open_windows: int = OPEN, slack: int = SLACK,
    merged_tasks: int = MERGED, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``, ``sequence_id`` and ``offset``."""
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    placed = cut(place(docs, path, end_id, size, open_windows, slack), "pieces")
    whole = placed.filter("NOT is_open").unionByName(merge(placed.filter("is_open"), size, merged_tasks))
    return whole.drop("part", "is_open")
