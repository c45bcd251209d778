"""Exact Jaccard join on word shingles by skipping over set relations.

Documents become sets of hashed shingles; equal sets are one set from then on.

1. ``read_sets`` numbers the sets and counts shingles that occur in several sets of a
   task.  The counts only order the shingles, frequent ones last, so any order is right
   and a better one is faster.
2. ``postings`` writes the prefix of each set (all but 3/4 of it, plus one) into index
   lists, dealt by shingle.  Two sets that link share a shingle of their prefixes.
3. ``candidates`` reads the lists: pairs of short lists pass a length filter
   and, summed over all lists, a bound on what the rest of the sets can add; a
   long list is one star, because all its members go on together.
4. Sets connected by candidates meet in one group, cut into blocks of bounded size, and
   ``block_links`` answers the join there.  Its index lists are ordered by what is left of
   a set behind the position, so the part of a list that cannot reach the threshold is
   skipped as a block; and a set that is highly similar to one with a computed answer
   derives its own from it, by the shingles in which the two differ.
5. Links, as a spanning forest per block, give the components.

Shingles and sets are compared by 64-bit hashes: two sets of a million shingles share a
false one with a chance below 1e-7, and a billion distinct sets hold a false twin with a
chance of 3 %.

Defined cases: a NULL, empty or blank text has no shingles and links with nothing, also
not with another empty one; a text shorter than a shingle is one shingle; repeated rows
and copies are members of one class; a NULL id is the largest id; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import cut, quoted
from heddle.llm.common import frequent_rows
from heddle.operators.graph import connected_components

WIDTH = 5
PERCENT = 75
#: Shingles in one block of a group (16 MB), and postings in one bucket (21 MB).
BLOCK = 2_000_000
BUCKET = 1_000_000
#: Up to this length, a list's pairs are listed; a longer one is a star.
SHORT = 16
#: The shingles that go last by frequency; it bounds a broadcast (16 bytes each).
FREQUENT = 500_000
#: From this many sets on, a shingle's list is dealt over several buckets.
SALTED = 50_000
#: Answers are derived from a set of at least this similarity.
SIMILAR = 0.8

_ODD = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64
)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of the shingles of ``text``; A-Z count as a-z."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(words) < width:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - width + 1
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out += hashes[k : k + n] * (_ODD[k % len(_ODD)] + np.uint64(2 * (k // len(_ODD))))
    return np.unique(_mixed(out))


def set_key(tokens: np.ndarray) -> int:
    """Signed 64-bit name of a set; 0 for the empty one."""
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(tokens.tobytes())))) if len(tokens) else 0


def prefix_size(n: np.ndarray | int, percent: int = PERCENT) -> np.ndarray | int:
    return n - (-(-percent * n // 100)) + 1


def _signed(a: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(a, np.uint64).view(np.int64)


def read_sets(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Rows (``doc_id``, ``th``, ``sid``, ``n``) of documents, and rows (``token``, ``freq``) of repeated shingles.

    ``th`` is a hash of the text: with it, rows of one id (or none) are told apart.
    """
    id_type = docs.schema["doc_id"].dataType
    schema = T.StructType([
        T.StructField("doc_id", id_type), T.StructField("th", T.LongType()), T.StructField("sid", T.LongType()), T.StructField("n", T.LongType()),
        T.StructField("token", T.LongType()), T.StructField("freq", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def counted(held: list[np.ndarray]) -> pa.RecordBatch:
            tokens, freq = np.unique(np.concatenate(held), return_counts=True)
            often = freq > 1
            tokens, freq = _signed(tokens[often]), freq[often].astype(np.int64)
            none = [pa.nulls(len(tokens), t) for t in (id_arrow, pa.int64(), pa.int64(), pa.int64())]
            return pa.RecordBatch.from_arrays([*none, pa.array(tokens), pa.array(freq)], names)

        names, id_arrow = schema.names, pa.int64()
        held, size, seen = [], 0, set()
        for batch in batches:
            id_arrow = batch.column(0).type
            sids, ns = [], []
            for text in batch.column(1):
                tokens = shingle_set(text.as_py(), width)
                key = set_key(tokens)
                sids.append(key)
                ns.append(len(tokens))
                if key not in seen and len(tokens):
                    seen.add(key)
                    held.append(tokens)
                    size += len(tokens)
            none = pa.nulls(len(sids), pa.int64())
            own = [pa.array(sids, pa.int64()), pa.array(ns, pa.int64())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *own, none, none], names)
            if size > 4 * BLOCK:
                yield counted(held)
                held, size, seen = [], 0, set()
        if held:
            yield counted(held)

    return docs.select("doc_id", "text", "th").mapInArrow(run, schema)


def frequent(sets: DataFrame, limit: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent shingles, sorted, and their counts; at most ``limit`` of them."""
    counts = sets.filter("token IS NOT NULL").groupBy("token").agg(F.sum("freq").alias("freq"))
    rows = frequent_rows(cut(counts, "shingles"), "freq", limit).toPandas()
    tokens = rows["token"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    return tokens[order], rows["freq"].to_numpy(np.int64)[order]


def in_order(tokens: np.ndarray, known: np.ndarray, freq: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``tokens`` with the frequent ones last, and the counts (0: not known as frequent)."""
    if not len(known):
        return tokens, np.zeros(len(tokens), np.int64)
    at = np.minimum(np.searchsorted(known, tokens), len(known) - 1)
    counts = np.where(known[at] == tokens, freq[at], 0)
    order = np.lexsort((tokens, counts))
    return tokens[order], counts[order]


def postings(docs: DataFrame, known: np.ndarray, freq: np.ndarray, buckets: int, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Prefix entries packed into one row per task and bucket: shingle, set, size, salted."""
    shared = docs.sparkSession.sparkContext.broadcast((known, freq))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def packed() -> pa.RecordBatch:
            token, sid, n, salt = (np.concatenate(x) for x in zip(*held))
            deal = np.where(salt, _mixed(token ^ sid), token >> np.uint64(20)) % np.uint64(buckets)
            order = np.argsort(deal, kind="stable")
            edges = np.flatnonzero(np.diff(deal[order], prepend=np.uint64(buckets), append=np.uint64(buckets)))
            columns = [np.ascontiguousarray(c[order]) for c in (token, sid, n, salt)]
            parts = list(zip(edges[:-1], edges[1:]))
            return pa.RecordBatch.from_arrays(
                [pa.array([int(deal[order[a]]) for a, _ in parts], pa.int32())]
                + [pa.array([c[a:b].tobytes() for a, b in parts], pa.binary()) for c in columns],
                ["bucket", "token", "sid", "n", "salt"],
            )

        common, counts = shared.value
        held, size, seen = [], 0, set()
        for batch in batches:
            for text in batch.column(0):
                tokens = shingle_set(text.as_py(), width)
                key = set_key(tokens)
                if not len(tokens) or key in seen:
                    continue
                seen.add(key)
                n = len(tokens)
                p = prefix_size(n, percent)
                ordered, often = in_order(tokens, common, counts)
                held.append((
                    ordered[:p], np.full(p, np.uint64(key & (2**64 - 1))), np.full(p, n, np.int32), often[:p] >= SALTED,
                ))
                size += p
                if size > 2 * BUCKET:
                    yield packed()
                    held, size = [], 0
        if held:
            yield packed()

    schema = "bucket int, token binary, sid binary, n binary, salt binary"
    return docs.select("text").mapInArrow(run, schema)


def list_pairs(token, sid, n, salt, percent: int = PERCENT) -> tuple[np.ndarray, ...]:
    """Candidates of one bucket's lists: (a, b, size of a, size of b, shared shingles).

    A star's edges count as many shared shingles as a set can have.
    """
    order = np.lexsort((sid, n, token))
    token, sid, n, salt = (x[order] for x in (token, sid, n, salt))
    fresh = np.ones(len(token), bool)  # a set that several tasks wrote counts once
    fresh[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
    token, sid, n, salt = (x[fresh] for x in (token, sid, n.astype(np.int64), salt))
    heads = np.flatnonzero(np.diff(token, prepend=token[:1] ^ np.uint64(1)))
    length = np.repeat(np.diff(heads, append=len(token)), np.diff(heads, append=len(token)))
    found: list[tuple[np.ndarray, ...]] = []
    at = np.flatnonzero((length > 1) & (length <= SHORT) & ~salt)
    step = 1
    while len(at):
        at = at[at + step < len(token)]
        at = at[token[at] == token[at + step]]
        x, y = at, at + step
        near = 100 * n[x] >= percent * n[y]
        x, y = x[near], y[near]
        found.append((sid[x], sid[y], n[x], n[y], np.ones(len(x), np.int64)))
        step += 1
    at = np.flatnonzero((length > SHORT) & ~salt)
    if len(at):  # every run of neighbouring sizes hangs on its first set
        first = (np.diff(token[at], prepend=token[at[:1]] ^ np.uint64(1)) != 0)
        first[1:] |= 100 * n[at][:-1] < percent * n[at][1:]
        lead = at[np.flatnonzero(first)][np.cumsum(first) - 1]
        other = lead != at
        x, y = lead[other], at[other]
        found.append((sid[x], sid[y], n[x], n[y], np.full(len(x), 2**40)))
    at = np.flatnonzero(salt)
    for more in (0, 1) if len(at) else ():  # sizes that may link are in the same class or the next
        grade = np.floor(np.log(n[at]) / np.log(100 / percent)).astype(np.int64) + more
        hub = _mixed(token[at] * _ODD[0] + grade.astype(np.uint64))
        found.append((hub, sid[at], n[at], n[at], np.full(len(at), 2**40)))
    if not found:
        return tuple(np.zeros(0, t) for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64))
    a, b, na, nb, c = (np.concatenate(x) for x in zip(*found))
    swap = a > b
    a, b, na, nb = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, nb, na), np.where(swap, na, nb)
    order = np.lexsort((b, a))
    a, b, na, nb, c = (x[order] for x in (a, b, na, nb, c))
    new = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])])) if len(a) else np.zeros(0, int)
    return a[new], b[new], na[new], nb[new], np.add.reduceat(c, new) if len(new) else c


def candidates(lists: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Pairs (``src``, ``dst``) of sets that may link, by all lists together."""

    def run(table: pa.Table) -> pa.Table:
        kinds = {"token": np.uint64, "sid": np.uint64, "n": np.int32, "salt": np.bool_}
        columns = [np.frombuffer(b"".join(table.column(c).to_pylist()), t) for c, t in kinds.items()]
        a, b, na, nb, c = list_pairs(*columns, percent)
        return pa.table({"src": _signed(a), "dst": _signed(b), "na": na, "nb": nb, "c": c})

    pairs = lists.groupBy("bucket").applyInArrow(run, "src long, dst long, na long, nb long, c long")
    summed = pairs.groupBy("src", "dst").agg(F.max("na").alias("na"), F.max("nb").alias("nb"), F.sum("c").alias("c"))
    # what the prefixes do not share must be shared by the rest of one of the sets
    rest = F.greatest(*[F.expr(f"({percent} * {n} + 99) div 100 - 1") for n in ("na", "nb")])
    least = F.expr(f"({percent} * (na + nb) + {99 + percent}) div {100 + percent}")
    return summed.filter(F.col("c") >= least - rest).select("src", "dst")


def block_links(
    sets: list[np.ndarray], weight: np.ndarray, side: np.ndarray, percent: int = PERCENT
) -> tuple[list[tuple[int, int]], np.ndarray, int]:
    """Links between sets of a block (or of two: only those between side 0 and side 1).

    Returns a spanning forest of the links as pairs of places, per set the weight of the
    sets that it links with, and how many answers were derived from others.
    """
    g = len(sets)
    across = bool(side.any())
    sizes = np.array([len(s) for s in sets], np.int64)
    if g == 2:
        shared = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
        if 100 * shared >= percent * (sizes.sum() - shared):
            return [(0, 1)], weight[::-1].copy(), 0
        return [], np.zeros(2, np.int64), 0
    by_size = np.argsort(sizes, kind="stable")
    sizes, side, weight = sizes[by_size], side[by_size], weight[by_size]
    owner = np.repeat(np.arange(g), sizes)
    _, token, df = np.unique(np.concatenate([sets[i] for i in by_size]), return_inverse=True, return_counts=True)
    rank = np.empty(len(df), np.int64)
    rank[np.lexsort((np.arange(len(df)), df))] = np.arange(len(df))
    token = rank[token]  # rare shingles first
    order = np.lexsort((token, owner))
    token = token[order]
    start = np.concatenate([[0], np.cumsum(sizes)])
    pos = np.arange(len(token)) - np.repeat(start[:-1], sizes)
    rest = np.repeat(sizes, sizes) - pos
    full = np.argsort(token, kind="stable")  # full lists, members by size
    full_owner, full_start = owner[full], np.concatenate([[0], np.cumsum(np.bincount(token, minlength=len(df)))])
    in_prefix = np.flatnonzero(pos < np.repeat(prefix_size(sizes, percent), sizes))
    index = in_prefix[np.lexsort((-rest[in_prefix], token[in_prefix]))]  # prefix lists, by what is left
    list_owner, list_rest = owner[index], -rest[index]
    list_start = np.concatenate([[0], np.cumsum(np.bincount(token[index], minlength=len(df)))])

    def overlaps(tokens: np.ndarray) -> np.ndarray:
        a, b = full_start[tokens], full_start[tokens + 1]
        lengths = b - a
        if not lengths.sum():
            return np.zeros(g, np.int64)
        at = np.repeat(a - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        return np.bincount(full_owner[at], minlength=g)

    answers: dict[int, np.ndarray] = {}
    best_of, best_like = np.full(g, -1), np.zeros(g)  # per set: the answered set that it is most similar to
    links, forest, derived = np.zeros(g, np.int64), [], 0
    parent = list(range(g))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for x in range(g):
        n, mine = int(sizes[x]), token[start[x] : start[x + 1]]
        high = int(np.searchsorted(sizes, 100 * n // percent, "right"))
        if best_like[x] >= SIMILAR:
            base = int(best_of[x])
            other = token[start[base] : start[base + 1]]
            counts = answers[base] + overlaps(np.setdiff1d(mine, other, True)) - overlaps(np.setdiff1d(other, mine, True))
            derived += 1
        else:
            hit, least = False, -(-percent * n // 100)
            for t in mine[: prefix_size(n, percent)]:
                a, b = list_start[t], list_start[t + 1]
                if b - a < 2:
                    continue
                near = list_owner[a : a + int(np.searchsorted(list_rest[a:b], -least, "right"))]
                if ((near > x) & (near < high)).any():
                    hit = True
                    break
            if not hit:
                continue
            counts = overlaps(mine)
            answers[x] = counts
            like = counts / (n + sizes - counts)
            better = like > best_like
            best_like[better], best_of[better] = like[better], x
        later = np.arange(x + 1, high)
        linked = later[100 * counts[later] >= percent * (n + sizes[later] - counts[later])]
        if across:
            linked = linked[side[linked] != side[x]]
        links[x] += weight[linked].sum()
        links[linked] += weight[x]
        for y in linked.tolist():
            a, b = root(x), root(y)
            if a != b:
                parent[b] = a
                forest.append((int(by_size[x]), int(by_size[y])))
    out = np.empty(g, np.int64)
    out[by_size] = links
    return forest, out, derived


def links(members: DataFrame, slots: int, percent: int = PERCENT) -> DataFrame:
    """Forest edges (``src``, ``dst``) and link counts (``src``, ``n``) of the sets of candidate groups.

    ``members``: ``component``, ``blocks`` (of that group), ``block``, ``sid``, ``weight``
    (documents of that set) and ``tokens``.  Every pair of blocks of a large group meets
    in one task; groups of one block share ``slots`` tasks.
    """
    pairs = F.expr("transform(sequence(0, blocks - 1), b -> struct(least(b, block) AS low, greatest(b, block) AS high))")
    slot = F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("component"), F.lit(slots))).otherwise(-1).alias("slot")
    owner = F.when(F.col("blocks") == 1, 0).otherwise(F.col("component")).alias("owner")
    dealt = members.withColumn("pair", F.explode(pairs)).select(
        slot, owner, "pair.low", "pair.high", "component", "block", "sid", "weight", "tokens"
    )

    def run(table: pa.Table) -> pa.Table:
        low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
        groups: dict[int, dict[int, tuple]] = {}
        columns = [table.column(c).to_pylist() for c in ("component", "sid", "block", "weight", "tokens")]
        for component, sid, *row in zip(*columns):
            groups.setdefault(component, {})[sid] = row
        out: list[tuple[int, int | None, int | None]] = []
        for rows in groups.values():
            sids = sorted(rows)
            side = np.array([int(low != high and rows[s][0] == high) for s in sids])
            weight = np.array([rows[s][1] for s in sids], np.int64)
            forest, counts, _ = block_links([np.frombuffer(rows[s][2], np.uint64) for s in sids], weight, side, percent)
            out += [(sids[a], sids[b], None) for a, b in forest]
            out += [(s, None, c) for s, c in zip(sids, counts.tolist()) if c]
        src, dst, n = zip(*out) if out else ((), (), ())
        return pa.table({"src": pa.array(src, pa.int64()), "dst": pa.array(dst, pa.int64()), "n": pa.array(n, pa.int64())})

    return dealt.groupBy("slot", "owner", "low", "high").applyInArrow(run, "src long, dst long, n long")


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (``src``, ``dst``) with the same components: every task replaces its own by stars.

    What is connected within a task hangs on its least node afterwards, so the rounds of
    the components that follow are few.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(i: int) -> int:
            while parent.setdefault(i, i) != i:
                parent[i] = parent[parent[i]]
                i = parent[i]
            return i

        def stars() -> pa.RecordBatch:
            member = [i for i in parent if parent[i] != i]
            least = [root(i) for i in member]
            parent.clear()
            return pa.RecordBatch.from_arrays([pa.array(least, pa.int64()), pa.array(member, pa.int64())], ["src", "dst"])

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                a, b = root(a), root(b)
                if a != b:
                    parent[max(a, b)] = min(a, b)
            if len(parent) > BLOCK:
                yield stars()
        if parent:
            yield stars()

    return edges.select("src", "dst").mapInArrow(run, "src long, dst long")


def join(
    docs: DataFrame, width: int = WIDTH, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id`` (the least id it reaches by links) and ``n_links``."""
    docs = docs.select(quoted(id_col).alias("doc_id"), quoted(text_col).cast("string").alias("text"))
    docs = docs.withColumn("th", F.xxhash64("text"))
    sets = cut(read_sets(docs, width), "sets")
    rows = sets.filter("sid IS NOT NULL").select("doc_id", "th", "sid", "n")
    known, freq = frequent(sets)
    entries = int(rows.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) * (100 - percent) // 100
    lists = postings(docs, known, freq, max(16, entries // BUCKET), width, percent)
    maybe = cut(contracted(candidates(lists, percent)), "candidates")
    ends = maybe.select(F.col("src").alias("node")).unionByName(maybe.select(F.col("dst").alias("node"))).distinct()
    groups = connected_components(maybe, ends).withColumnRenamed("node", "sid")
    # the row of the least id stands for a set; equal rows are counted beforehand
    equal = rows.filter("n > 0").groupBy("sid", "doc_id", "th").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "th", "copies")).alias("first")
    classes = equal.groupBy("sid").agg(first, F.max("n").alias("n"), F.sum("copies").alias("weight"))
    classes = cut(classes.select("sid", "first.doc_id", "first.th", "first.copies", "n", "weight").join(groups, "sid", "left"), "classes")
    asked = classes.filter("component IS NOT NULL")
    slots = int(asked.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]) // BLOCK + 1
    weights = asked.groupBy("component").agg(F.ceil(F.sum("n") / float(BLOCK)).cast("int").alias("blocks"))
    placed = asked.join(weights, "component").withColumn("block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int"))
    named = docs.withColumnsRenamed({"doc_id": "_id", "th": "_th"})
    texts = placed.join(named, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    if not asked.filter("copies > 1").isEmpty():
        texts = texts.filter("copies = 1").unionByName(texts.filter("copies > 1").dropDuplicates(["sid"]))

    def tokens_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(t.as_py(), width) for t in batch.column(5)]
            same = pa.array([set_key(t) == s for t, s in zip(found, batch.column(3).to_pylist())], pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array([t.tobytes() for t in found], pa.binary())],
                ["component", "blocks", "block", "sid", "weight", "tokens"],
            ).filter(same)

    members = texts.select("component", "blocks", "block", "sid", "weight", "text").mapInArrow(
        tokens_of, "component long, blocks int, block int, sid long, weight long, tokens binary"
    )
    found = cut(links(members, slots, percent), "links")
    linked = cut(contracted(found.filter("dst IS NOT NULL")), "forest")
    counts = found.filter("n IS NOT NULL").groupBy(F.col("src").alias("sid")).agg(F.sum("n").alias("n_others"))
    ends = linked.select(F.col("src").alias("node")).unionByName(linked.select(F.col("dst").alias("node"))).distinct()
    parts = connected_components(linked, ends).withColumnRenamed("node", "sid")
    named = classes.select("sid", "doc_id", "weight").join(parts, "sid", "left").join(counts, "sid", "left")
    named = named.withColumn("component", F.coalesce("component", "sid"))
    least = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    answer = named.join(least, "component").select(
        "sid", "component_id", (F.coalesce("n_others", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
    return rows.join(answer, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
    )
