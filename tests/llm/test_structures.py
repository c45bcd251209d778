"""Prefix trie, Merkle manifest and SimHash against plain versions, on awkward rows too."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from heddle.functions.runtime import cut
from heddle.llm import merkle_manifest, prefix_trie, simhash

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


# prefix trie


def plain_trie(rows):
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    convs = {c: [v[2:] for v in sorted(vs)] for c, vs in convs.items()}
    rebuilt = {}
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 9
        rebuilt[c] = tuple(convs.get(5 * int(c / 5), [])[:h] + convs[c][h:])
    nodes = {}
    for c, s in rebuilt.items():
        for d in range(len(s) + 1):
            nodes.setdefault(s[:d], []).append(c)
    kids, leaves, saved = (dict.fromkeys(nodes, 0) for _ in range(3))
    for n in nodes:
        if n:
            kids[n[:-1]] += 1
    for n, members in nodes.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(members) - 1) * len(n[-1][1].encode()) if n else 0
            leaves[n[:d]] += not kids[n]
    ends = {n: ",".join(str(c) for c in sorted(ms) if len(rebuilt[c]) == len(n)) for n, ms in nodes.items()}
    return sorted((
        (min(ms), len(n), min(nodes[n[:-1]]) if n else None, len(ms), kids[n], leaves[n], saved[n], hashlib.sha256(ends[n].encode()).hexdigest())
        for n, ms in nodes.items()
    ), key=str)


def talk(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    return df.withColumns({c: F.lit("clash") for c in ("path", "p", "depth", "pos", "conv", "bytes")}).repartition(3)


def random_talks(seed):
    rng, rows = random.Random(seed), []
    for c in range(-12, 30):
        for t in range(rng.choice([0, 1, 2, 5, 9, 14])):
            odd = rng.random() < 0.08
            rows.append((c, None, "u", "x") if odd else (c if rng.random() < 0.98 else None, t, rng.choice(["u", "a", None]), rng.choice(["", "yé", None])))
    return rows


def test_trie_of_random_talks(spark):
    rows = random_talks(1)
    assert found(prefix_trie.build(talk(spark, rows))) == plain_trie(rows)
    twice = rows + [r for r in rows if r[1] is None]  # repeated rows are turns of their own
    assert found(prefix_trie.build(talk(spark, twice))) == plain_trie(twice)


def test_trie_of_long_chains_logs_and_wide_nodes(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "BLOCK", 16)
    monkeypatch.setattr(prefix_trie, "WIDE", 3)
    rows = [(100, t, "u", f"t{t}") for t in range(200)] + [(101, t, "u", f"t{t}") for t in range(190)]
    rows += [(1000 + 5 * k, t, "u", f"c{t}") for k in range(30) for t in range(k + 1)]  # every turn logs all before it
    rows += [(2000 + 5 * k, t, "u", f"c{t}" if t < k else f"leg{k}-{t}") for k in range(30) for t in range(60)]
    rows += [(3000 + 5 * k, 0, "u", "common first turn") for k in range(40)]
    assert found(prefix_trie.build(talk(spark, rows))) == plain_trie(rows)


def test_trie_of_nothing(spark):
    assert found(prefix_trie.build(talk(spark, []))) == []
    assert found(prefix_trie.build(talk(spark, [(None, 0, "u", "x")]))) == []


def test_contraction_by_any_shape(spark):
    """Subtree totals of random trees, without the chains that a trie's paths would give."""
    rng = random.Random(5)
    n, parent = 300, {0: None}
    for i in range(1, n):
        parent[i] = rng.choice([i - 1, i - 1, i - 1, rng.randrange(i)])
    depth = {0: 0}
    for i in range(1, n):
        depth[i] = depth[parent[i]] + 1
    kids = {i: sum(p == i for p in parent.values()) for i in parent}
    own = {i: rng.randrange(100) for i in parent}
    want = dict.fromkeys(parent, 0)
    leaves = dict.fromkeys(parent, 0)
    for i in parent:
        at = i
        while at is not None:
            want[at] += own[i]
            leaves[at] += not kids[i]
            at = parent[at]
    rows = [(i, depth[i], parent[i], depth[parent[i]] if i else None, kids[i], int(not kids[i]), own[i], 0, 0) for i in parent]
    state = spark.createDataFrame(
        rows, "path long, depth long, up_path long, up_depth long, kids long, leaves long, saved long, up_leaves long, up_saved long"
    )
    raked, gone, rounds, is_open = [], [], 0, True
    while is_open:
        leaf_rows, out, state, is_open = prefix_trie.contract(state)
        raked.append(leaf_rows)
        gone += [out] if is_open else []
        rounds += 1
    known = raked.pop()
    while gone:
        known = known.unionByName(cut(prefix_trie.expand(known, gone.pop()), "expanded")).unionByName(raked.pop())
    assert {r.path: (r.leaves, r.saved) for r in known.collect()} == {i: (leaves[i], want[i]) for i in parent}
    assert rounds < max(depth.values()) / 2


# Merkle manifest


def H(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_manifest(rows):
    leaf = lambda r: H("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r)
    by_source = {}
    for r in rows:
        by_source.setdefault(r[1], []).append(r)

    def build(level):
        out = [level]
        while len(level) > 1:
            level = [H(level[i : i + 16]) for i in range(0, len(level), 16)]
            out.append(level)
        return out

    def path(tree, i):
        for level in tree[:-1]:
            run, k = level[i // 16 * 16 : i // 16 * 16 + 16], i % 16
            yield run[:k], run[k + 1 :]
            i //= 16

    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in order:
        by_source[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = build([leaf(r) for r in by_source[s]])
    top, out = build([trees[s][-1][0] for s in order]), []
    for k, s in enumerate(order):
        for i, r in enumerate(by_source[s]):
            steps = [*path(trees[s], i), *path(top, k)]
            forged = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            acc = leaf((*r[:4], r[4] and r[4].translate(UPPER))) if forged else leaf(r)
            for left, right in steps:
                acc = H([*left, acc, *right])
            root = top[-1][0]
            out.append((r[0], leaf(r), trees[s][-1][0], root, H(x for a, b in steps for x in a + b), acc, acc == root))
    return sorted(out, key=str)





def forged():
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def table(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    return df.withColumns({c: F.lit("clash") for c in ("src", "word", "n", "idx", "leaf", "path", "slots", "digest")}).repartition(4)


@pytest.mark.parametrize("rows", [
    [(i * 3 - 200, "hot" if i % 4 else f"s{i % 60}", "en", i, f"Text {i}" if i % 9 else None) for i in range(700)],
    [(i % 7 if i % 3 else None, "a" if i % 2 else None, "en", 1, f"T{i % 5}") for i in range(90)]
    + [(i, f"s{i}é", None, None, "") for i in range(20)] + [(5, "z", "x", 1, "Same")] * 40 + [(2**62, "z", "x", 1, "Far"), (-(2**62), "z", "x", 1, "Low")],
    [(7, None, None, None, "Only One")],
    [],
])
def test_manifest(spark, rows, monkeypatch):
    monkeypatch.setattr(merkle_manifest, "REPEATS", 16)
    assert found(merkle_manifest.manifest(table(spark, rows), forged())) == plain_manifest(rows)


def test_manifest_without_tampering_verifies(spark):
    rows = [(i, f"s{i % 3}", "en", i, f"Text {i}") for i in range(200)]
    got = merkle_manifest.manifest(table(spark, rows)).collect()
    assert all(r.verified and r.folded_root == r.root for r in got)


def test_rank_of_words(spark):
    ids = sorted(random.Random(2).sample(range(-50_000, 200_000), 900))
    rows = spark.createDataFrame([("s", i, "x", None) for i in ids], "src string, doc_id long, leaf string, forged string")
    got = {r.doc_id: r.idx for r in merkle_manifest.placed(rows).collect()}
    assert got == {i: k for k, i in enumerate(ids)}


# SimHash


def plain_print(text):
    words = re.findall("[^\\x20\\x09-\\x0D]+", (text or "").translate(UPPER))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(fps):
    label = list(range(len(fps)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps) - 1):
        for j in (np.flatnonzero(np.bitwise_count(fps[i + 1 :] ^ fps[i]) <= 3) + i + 1).tolist():
            a, b = root(i), root(j)
            label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(fps))]


def plain_dedup(rows):
    fps = np.array([plain_print(t) for _, t in rows], np.uint64)
    label, least = plain_groups(fps), {}
    for (i, _), g in zip(rows, label):
        if i is not None:
            least[g] = min(least.get(g, i), i)
    return sorted(((i, f"{int(p):016x}", least.get(g)) for (i, _), p, g in zip(rows, fps, label)), key=str)


def texts():
    rng = random.Random(3)
    words = [f"w{rng.randrange(10**6)}" for _ in range(600)]
    rows = [(k, " ".join(rng.choices(words, k=rng.choice([1, 2, 3, 9, 80, 400])))) for k in range(60)]
    near = []
    for k, t in rows[:40]:
        w = t.split()
        w[rng.randrange(len(w))] = "Changed"
        near.append((100 + k, " ".join(w).upper() if k % 2 else "\t".join(w)))
    return rows + near + [(300, None), (301, ""), (302, " \r\n\x0b"), (None, rows[3][1]), (5, rows[3][1]), (5, rows[3][1]), (303, "é " * 30_000 + "naïve\x1cü ende")]


def test_simhash_against_all_pairs(spark):
    rows = texts()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("fp", "key", "bit", "n", "component", "first")}).repartition(3)
    assert found(simhash.dedup(df)) == plain_dedup(rows)
    assert found(simhash.dedup(df.limit(0))) == []


def test_shingle_hash_is_the_one_of_spark(spark):
    rows = ["a b c", "über straße zu", "x" * 100 + " y z"]
    got = [r.h for r in spark.createDataFrame([(r,) for r in rows], "t string").select(F.xxhash64("t").alias("h")).collect()]
    assert [int(simhash.shingle_hashes(r.encode())[0].astype(np.int64)) for r in rows] == got


@pytest.mark.parametrize("long", [4096, 60])
def test_crowded_keys_lose_no_link(spark, monkeypatch, long):
    """A dense ball of fingerprints, a line that shares its upper bits, and random ones."""
    monkeypatch.setattr(simhash, "LONG", long)
    rng = random.Random(4)
    base, prints = rng.getrandbits(64), set()
    for _ in range(300):
        x = base
        for _ in range(rng.randrange(7)):
            x ^= 1 << rng.randrange(64)
        prints.add(x)
    prints |= {(base & ~0x3FF) | k | 1 << 40 for k in range(0, 200, 3)} | {rng.getrandbits(64) for _ in range(100)} | {0, 7, 2**64 - 1}
    fps = np.array(sorted(prints), np.uint64)
    signed = fps.view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long")).distinct().collect()
    label = {x: x for x in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for r in links:
        a, b = root(r.src), root(r.dst)
        label[max(a, b)] = min(a, b)
    groups = lambda keys: sorted(sorted(x for x, k in zip(signed, keys) if k == g) for g in set(keys))
    assert groups([root(x) for x in signed]) == groups(plain_groups(fps))


def test_neighbours_by_table():
    rng = random.Random(6)
    for n, bits in ((3000, 16), (3000, 18), (50, 40)):
        fps = np.unique(np.array([rng.getrandbits(bits) << 20 | 5 for _ in range(n)], np.uint64))
        assert simhash.connect(fps).tolist() == plain_groups(fps)
