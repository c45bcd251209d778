"""Scores of texts under prediction by partial matching, and a unigram baseline.

Spark counts byte sequences of the training texts (``order`` context bytes and the byte
behind them).  A context's escape probability is that of method C (distinct followers /
(all + distinct)), and a byte that escapes is predicted by the shorter context without
the bytes that the longer one has already ruled out.  What follows a context also follows
its shorter forms, so what a longer context rules out is known from counts alone, and the
cost of a sequence takes one look-up per length.  ``adaptive_bits`` is the other mode: a
text's code length under a model that starts empty and learns from the text itself.

Texts are lower-cased (A-Z), padded in front, and closed by an end mark, both byte 255,
which no UTF-8 text has.  Every context of the training texts is kept, so the model grows
with the corpus and is never in one place: contexts of up to ``NEAR - 1`` bytes are
broadcast, longer ones are dealt by their nearest ``NEAR`` bytes to shards.  Texts are
put into chunks of some megabytes; a chunk asks each shard once for the costs of its
distinct sequences and adds them up over its texts.  All counts are over all training
texts.  Words are counted by a 64-bit hash; ten million distinct words share one with a
chance of 3 in a million.

Defined cases: a NULL text is empty: one token, the end, and the end mark's cost; with
no training texts every byte costs the same; repeated rows are scored one by one; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import cut, quoted
from heddle.llm.common import frequent_rows
from heddle.llm.tokens import sub_batches

ORDER = 5
#: Contexts of this many bytes and more are dealt to shards by their nearest bytes.
NEAR = 3
#: Sequences of a shard, about; there are at least ``SHARDS``.
SHARD_ROWS = 1_000_000
SHARDS = 512
#: Bytes of the texts that ask for their sequences together.
CHUNK = 8_000_000
#: The most frequent words, whose counts are broadcast (16 bytes each); the others are joined.
BROADCAST_WORDS = 400_000
END = 255
WORDS = 9


def lowered(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass").lower()


def word_key(word: bytes) -> int:
    """Signed hash of a word; the end token is the empty word."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(word))))


END_KEY = word_key(b"")


def _sequences(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the padded texts with its context, as context * 256 + byte; bytes per text."""
    pad = bytes([END]) * order
    data = bytes(7 - order) + b"".join([pad + t + bytes([END]) for t in texts])
    # eight bytes from every place on, of which the last ones are the sequence
    windows = np.ndarray((max(len(data) - 7, 0),), ">u8", data, strides=(1,))
    key = windows.astype(np.uint64)
    key &= np.uint64((1 << 8 * (order + 1)) - 1)
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    skip = np.zeros(len(key), bool)  # places whose byte is the next text's padding
    ends = np.cumsum(lengths + order)[:-1]
    for k in range(order):
        skip[ends - order + k] = True
    return key[~skip], lengths


def _distinct(key: np.ndarray) -> np.ndarray:
    """Ascending distinct values; sorts ``key`` in place."""
    key.sort()
    return key[np.concatenate([[True], key[1:] != key[:-1]])] if len(key) else key


def count(train: DataFrame, order: int = ORDER) -> DataFrame:
    """Counts of the training texts: rows (``kind``, ``key``, ``n``).

    Kind k up to ``order`` is a byte behind k others, ``WORDS`` a word.  A task's counts
    of one length give those of the next shorter one, so the texts are walked once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()

        def rows(kind: int, keys: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(keys), kind, np.int32)), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                ["kind", "key", "n"],
            )

        def word_rows() -> pa.RecordBatch:
            keys = np.array([word_key(w) for w in words], np.int64)
            out = rows(WORDS, keys, np.fromiter(words.values(), np.int64, len(words)))
            words.clear()
            return out

        held: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> tuple[np.ndarray, np.ndarray]:
            keys, n = (np.concatenate(x) for x in zip(*held))
            order_ = np.argsort(keys, kind="stable")
            keys, n = keys[order_], n[order_]
            first = np.flatnonzero(np.diff(keys, prepend=keys[:1] ^ np.uint64(1)))
            return keys[first], np.add.reduceat(n, first)

        for batch in batches:
            for _, texts in sub_batches(batch.column(0)):
                low = [lowered(t) for t in texts]
                for t in low:
                    words.update(t.split())
                words[b""] += len(low)
                key, _ = _sequences(low, order)
                key.sort()
                first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
                held.append((key[first], np.diff(np.append(first, len(key)))))
                if len(held) > 16:
                    held = [merged()]
                if len(words) > 1_000_000:
                    yield word_rows()
        if held:
            keys, n = merged()
            for length in range(order, -1, -1):
                held = [(keys & np.uint64((1 << 8 * (length + 1)) - 1), n)]
                keys, n = merged()
                yield rows(length, keys, n)
        if words:
            yield word_rows()

    counts = train.select("text").mapInArrow(run, "kind int, key long, n long")
    return counts.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class Level(NamedTuple):
    """Contexts of one length: what a byte costs behind them, as log10."""

    keys: np.ndarray  # context * 256 + byte, sorted
    logs: np.ndarray  # of their counts
    n: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    bottom: np.ndarray  # of a byte that follows
    escape: np.ndarray
    below: np.ndarray  # bottom of the next shorter context without what follows this one
    escape_below: np.ndarray


def level(keys: np.ndarray, n: np.ndarray, length: int, shorter: Level | None) -> Level:
    """The contexts of ``length`` bytes, from sorted keys and counts and the level below."""
    ahead = keys >> 8
    first = np.flatnonzero(np.concatenate([[True], ahead[1:] != ahead[:-1]])) if len(keys) else np.zeros(0, np.int64)
    contexts = ahead[first]
    sums = lambda x: np.add.reduceat(x, first) if len(x) else np.zeros(0, np.int64)
    total, distinct = sums(n), np.diff(np.append(first, len(keys)))
    bottom = np.log10(total + distinct)
    below, escape_below = np.zeros(len(contexts)), np.zeros(len(contexts))
    if shorter is not None and len(contexts):
        shared = sums(shorter.n[np.searchsorted(shorter.keys, keys & ((1 << 8 * length) - 1))])
        parent = np.searchsorted(shorter.contexts, contexts & ((1 << 8 * (length - 1)) - 1))
        left, fresh = shorter.total[parent] - shared, shorter.distinct[parent] - distinct
        below = np.log10(np.maximum(left + fresh, 1))
        escape_below = np.where(left > 0, np.log10(np.maximum(fresh, 1)) - below, 0)
    return Level(keys, np.log10(n), n, contexts, total, distinct, bottom, np.log10(distinct) - bottom, below, escape_below)


def _found(among: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` in sorted values, and whether they are there."""
    if not len(among):
        return np.zeros(len(asked), np.int64), np.zeros(len(asked), bool)
    at = np.minimum(np.searchsorted(among, asked), len(among) - 1)
    return at, among[at] == asked


def costs(levels: list[Level], asked: np.ndarray) -> np.ndarray:
    """log10 probability of each byte behind its context; ``asked``: context * 256 + byte, sorted.

    ``levels`` are those of lengths from 0, with all contexts that the asked ones end in.
    """
    out = np.zeros(len(asked))
    open_, inside = np.ones(len(asked), bool), np.zeros(len(asked), bool)  # inside: a longer context was there
    below, escape_below = np.zeros(len(asked)), np.zeros(len(asked))
    for k in range(len(levels) - 1, -1, -1):
        own, key = levels[k], asked & ((1 << 8 * (k + 1)) - 1)
        at, seen = _found(own.contexts, key >> 8)
        place, follows = _found(own.keys, key)
        hit, miss = np.flatnonzero(open_ & follows), np.flatnonzero(open_ & seen & ~follows)
        out[hit] += own.logs[place[hit]] - np.where(inside[hit], below[hit], own.bottom[at[hit]])
        out[miss] += np.where(inside[miss], escape_below[miss], own.escape[at[miss]])
        open_[hit] = False
        inside |= seen
        if len(own.contexts):
            below, escape_below = own.below[at], own.escape_below[at]
    ruled_out = int(levels[0].distinct[0]) if len(levels[0].contexts) else 0
    out[open_] -= math.log10(max(256 - ruled_out, 1))
    return out


def _shard(key, shards: int):
    """Shard of a key of at least ``NEAR`` context bytes, by the nearest ones; for arrays and columns."""
    return ((((key // 256) % (1 << 8 * NEAR)) * 2654435761) % (1 << 32)) // 256 % shards


def _levels(base: list[Level], kinds: np.ndarray, keys: np.ndarray, n: np.ndarray, order: int) -> list[Level]:
    """``base`` and the longer levels of unsorted counts."""
    out = list(base)
    for k in range(len(base), order + 1):
        own = np.flatnonzero(kinds == k)
        own = own[np.argsort(keys[own])]
        out.append(level(keys[own], n[own], k, out[-1] if out else None))
    return out


def packed_keys(keys: np.ndarray) -> bytes:
    """Ascending keys as their steps, byte plane by byte plane: the high planes are zeros, which compress to nothing."""
    steps = np.diff(keys.astype(np.uint64), prepend=np.uint64(0))
    return steps.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked_keys(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64).astype(np.int64)


def _asking(docs: DataFrame, order: int, shards: int, size: int) -> DataFrame:
    """Rows of ``docs`` with their ``chunk``; and per chunk and ``shard`` a row with its distinct ``keys``."""
    schema = T.StructType([
        *[T.StructField(f.name, f.dataType) for f in docs.schema], T.StructField("chunk", T.LongType()), T.StructField("shard", T.LongType()),
        T.StructField("keys", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, held, bytes_ = TaskContext.get().partitionId() << 32, [], 0
        types: list[pa.DataType] = []

        def asked() -> pa.RecordBatch:
            keys = _distinct(np.concatenate(held)).astype(np.int64)
            shard = _shard(keys, shards)
            by = np.argsort(shard, kind="stable")
            own, first = np.unique(shard[by], return_index=True)
            parts = [packed_keys(p) for p in np.split(keys[by], first[1:])]
            return pa.RecordBatch.from_arrays([
                *[pa.nulls(len(own), t) for t in types], pa.array(np.full(len(own), chunk)), pa.array(own), pa.array(parts, pa.binary()),
            ], schema.names)

        for batch in batches:
            types = [c.type for c in batch.columns]
            for a, texts in sub_batches(batch.column(1)):
                b = a + len(texts)
                key, lengths = _sequences([lowered(t) for t in texts], order)
                held.append(_distinct(key))
                bytes_ += int(lengths.sum())
                yield pa.RecordBatch.from_arrays([
                    *[c.slice(a, b - a) for c in batch.columns], pa.array(np.full(b - a, chunk)),
                    pa.nulls(b - a, pa.int64()), pa.nulls(b - a, pa.binary()),
                ], schema.names)
                if bytes_ >= size:
                    yield asked()
                    chunk, held, bytes_ = chunk + 1, [], 0
        if held:
            yield asked()

    return docs.mapInArrow(run, schema)


def _priced(asked: DataFrame, pairs: DataFrame, order: int, shards: int) -> DataFrame:
    """Rows (``chunk``, ``keys``, ``costs``) for the asked keys of each chunk and shard."""
    near = pairs.filter(F.col("kind") < NEAR).toPandas()
    columns = lambda t: [np.asarray(t[c], np.int64) for c in ("kind", "key", "n")]
    base = _levels([], *columns(near), min(order, NEAR - 1))
    shared = asked.sparkSession.sparkContext.broadcast(base)

    def price(counts: pa.Table, wanted: pa.Table) -> pa.Table:
        parts = [unpacked_keys(k) for k in wanted["keys"].to_pylist()]
        done = []
        if parts:
            keys, place = np.unique(np.concatenate(parts), return_inverse=True)
            cost = costs(_levels(shared.value, *columns(counts), order), keys).astype(np.float32)[place]
            done = [c.tobytes() for c in np.split(cost, np.cumsum([len(p) for p in parts])[:-1])]
        return pa.table({"chunk": wanted["chunk"], "keys": wanted["keys"], "costs": pa.array(done, pa.binary())})

    key = F.col("key")
    number = F.expr(f"(((shiftright(key, 8) % {1 << 8 * NEAR}L) * 2654435761L) % {1 << 32}L) div 256 % {shards}L")
    dealt = pairs.filter(F.col("kind") >= NEAR).select(number.alias("shard"), "kind", key, "n")
    return dealt.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(price, "chunk long, keys binary, costs binary")


def text_scores(texts: list[bytes], keys: np.ndarray, cost: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of each text, from the costs of its sequences by sorted keys."""
    key, lengths = _sequences(texts, order)
    found = np.empty(len(key))
    spare = min(64 - 8 * (order + 1), 16)  # bits of a key that hold its place while a run of keys is sorted
    asked, place = keys.astype(np.uint64), np.arange(1 << spare, dtype=np.uint64)
    for at in range(0, len(key), 1 << spare):
        run = key[at : at + (1 << spare)] << np.uint64(spare)
        run |= place[: len(run)]
        run.sort()  # ascending look-ups stay in the cache
        found[at + (run & np.uint64((1 << spare) - 1)).astype(np.int64)] = cost[np.searchsorted(asked, run >> np.uint64(spare))]
    return np.add.reduceat(found, np.cumsum(lengths) - lengths)


def adaptive_bits(text: str | None, order: int = ORDER) -> float:
    """Code length of one text in bits under a model that starts empty and learns on the way."""
    data = bytes([END]) * order + lowered(text) + bytes([END])
    seen: dict[bytes, dict[int, int]] = {}
    bits = 0.0
    for i in range(order, len(data)):
        byte, ruled_out = data[i], set()
        for k in range(order, -1, -1):
            here = seen.get(data[i - k : i], {})
            live = {b: n for b, n in here.items() if b not in ruled_out}
            if not live:
                continue
            total = sum(live.values()) + len(live)
            if byte in live:
                bits -= math.log2(live[byte] / total)
                break
            bits -= math.log2(len(live) / total)
            ruled_out |= live.keys()
        else:
            bits += math.log2(256 - len(ruled_out))
        for k in range(order + 1):
            here = seen.setdefault(data[i - k : i], {})
            here[byte] = here.get(byte, 0) + 1
    return bits


def score(
    docs: DataFrame, training: Column, order: int = ORDER, nodes: int | None = None, broadcast_words: int = BROADCAST_WORDS,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """Scores of all rows of ``docs``, learning from those where ``training`` holds.

    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``
    and ``score`` (log10 probabilities), ``n_bytes`` (with the end mark).  Every context
    counts; ``nodes``, if given, keeps the most frequent ones only.
    """
    if not 1 <= order <= 6:
        raise ValueError("contexts of one to six bytes")
    known = F.coalesce(training, F.lit(False))
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"), (~known).alias("held_out"))
    counts = cut(count(docs.filter("NOT held_out"), order), "counts")
    pairs = counts.filter(F.col("kind") <= order)
    if nodes is not None:  # a context is never more frequent than its shorter forms, so these are kept too
        pairs = pairs.withColumn("context", F.shiftright("key", 8))
        sizes = cut(pairs.groupBy("kind", "context").agg(F.sum("n").alias("total")), "contexts")
        pairs = pairs.join(frequent_rows(sizes, "total", nodes).select("kind", "context"), ["kind", "context"], "left_semi")
    shards = max(SHARDS, counts.count() // SHARD_ROWS)
    asking = cut(_asking(docs, order, shards, CHUNK), "chunks")
    priced = _priced(asking.filter("shard IS NOT NULL").select("chunk", "shard", "keys"), pairs, order, shards)
    words = counts.filter(F.col("kind") == WORDS).select("key", "n")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    floor = math.log10(total + distinct + 1)
    common = frequent_rows(words, "n", broadcast_words).toPandas().sort_values("key")
    keys, logs_of = common["key"].to_numpy(np.int64), np.log10(common["n"].to_numpy(np.int64) + 1.0)
    shared = docs.sparkSession.sparkContext.broadcast((keys, logs_of))
    longs = T.ArrayType(T.LongType())
    schema = T.StructType([
        T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("n_common", T.LongType()), T.StructField("logs", T.DoubleType()),
        T.StructField("score", T.DoubleType()), T.StructField("n_bytes", T.LongType()), T.StructField("rare", longs),
        T.StructField("times", longs),
    ])

    def run(rows: pa.Table, prices: pa.Table) -> pa.Table:
        keys_, logs_ = shared.value
        asked = np.concatenate([unpacked_keys(x) for x in prices["keys"].to_pylist()])
        cost = np.concatenate([np.frombuffer(x, np.float32) for x in prices["costs"].to_pylist()])
        by = np.argsort(asked)
        asked, cost = asked[by], cost[by]
        known: dict[bytes, float] = {}  # NaN: not among the common words

        def look_up(new: list[bytes]) -> None:
            asked_words = np.array([word_key(w) for w in new], np.int64)
            if len(keys_):
                at = np.minimum(np.searchsorted(keys_, asked_words), len(keys_) - 1)
                known.update(zip(new, np.where(keys_[at] == asked_words, logs_[at], np.nan).tolist()))
            else:
                known.update(dict.fromkeys(new, math.nan))

        out = []
        for a, texts in sub_batches(rows["text"].combine_chunks(), 2_000_000):
            b = a + len(texts)
            low = [lowered(t) for t in texts]
            split = [[*t.split(), b""] for t in low]
            look_up(list({w for s in split for w in s if w not in known}))
            values = [np.array([known[w] for w in s]) for s in split]
            others = [np.isnan(v) for v in values]
            rare = [Counter(s[i] for i in np.flatnonzero(o).tolist()) for s, o in zip(split, others)]
            n_tokens = np.array([len(s) for s in split], np.int64)
            out.append(pa.Table.from_arrays([
                rows["doc_id"].slice(a, b - a), rows["held_out"].slice(a, b - a), pa.array(n_tokens),
                pa.array(n_tokens - np.array([int(o.sum()) for o in others], np.int64)),
                pa.array(np.array([np.nansum(v) for v in values])), pa.array(text_scores(low, asked, cost, order)),
                pa.array(np.array([len(t) + 1 for t in low], np.int64)),
                pa.array([[word_key(w) for w in c] for c in rare], pa.list_(pa.int64())),
                pa.array([list(c.values()) for c in rare], pa.list_(pa.int64())),
            ], schema.names))
        return pa.concat_tables(out)

    texts = asking.filter("shard IS NULL").select("chunk", "doc_id", "text", "held_out")
    scored = texts.groupBy("chunk").cogroup(priced.groupBy("chunk")).applyInArrow(run, schema)
    scored = cut(scored.withColumn("_row", F.monotonically_increasing_id()), "scored")
    pairs = scored.select("_row", F.explode(F.arrays_zip("rare", "times")).alias("w")).select(
        "_row", F.col("w.rare").alias("key"), F.col("w.times").alias("times")
    )
    # words are spread by their hash, and frequent ones are not among these, so no key is hot
    sums = pairs.join(words, "key").groupBy("_row").agg(
        F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("_logs")
    )
    scored = scored.drop("rare", "times").join(sums, "_row", "left").withColumns({
        "n_known": F.col("n_common") + F.coalesce("_known", F.lit(0)), "logs": F.col("logs") + F.coalesce("_logs", F.lit(0.0)),
    })
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"),
        (F.col("logs") - F.col("n_tokens") * F.lit(floor)).alias("base_score"), "score", "n_bytes",
    )
