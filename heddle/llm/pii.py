"""Personal data: fixed patterns, and terms that disclose an entity by co-occurrence.

The patterns give the base spans; their normalised values are the protected entities.
Spark counts, over all documents, how many hold the entity, the word, and both, wherever
the two stand.  A word discloses an entity by its
pointwise mutual information with it as a share of the entity's own information,
log(p(e,t) / (p(e) p(t))) / -log p(e): 1 means that the word occurs with this entity
only.  Words from ``GENERALISE`` on are generalised to their shape wherever they occur in
a document that holds the entity, from ``REMOVE`` on they are removed.  When the support
of a pair is counted, documents are one if the ``AROUND`` words on each side of the
entity and of the word are equal, so copies of one document prove nothing.  Entities of
fewer documents than the support cannot have it, and are not paired.

Defined cases: a NULL text is empty; a text without personal data has no spans at all;
repeated rows are scanned one by one and add to the counts; an empty table gives an
empty result; other columns are ignored, and ``sanitise`` keeps them.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import cut, quoted

KINDS = ("email", "ip", "card", "phone", "generalised", "removed")
AROUND = 8
SUPPORT = 3
GENERALISE = 0.8
REMOVE = 0.95

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a run of digits is entered at its start only: no other place of it matches if that fails
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_TERM = re.compile(r"[^\W_]+")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the address pattern: what stands before an @ back to the last match, and a domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            done = domain.end()
            yield start, done
        at = text.find("@", max(at + 1, done))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else (2 * n - 9 if n > 4 else 2 * n)
    return total % 10 == 0


def base_spans(text: str | None) -> list[tuple[int, int, int, str]]:
    """(kind, start, end, normalised value) by kind and start."""
    if not text:
        return []
    found = [(0, a, b, text[a:b].lower()) for a, b in _emails(text)]
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            found.append((1, m.start(), m.end(), m[0]))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end(), digits))
    for m in _PHONE.finditer(text):
        digits = "".join(_DIGIT.findall(m[0]))
        if 8 <= len(digits) <= 15:
            found.append((3, m.start(), m.end(), digits))
    return found


def term_key(word: str) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(word.lower().encode("utf-8", "surrogatepass")))))


def words_of(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(term, start, end) of all words that no span touches."""
    covered = bytearray(len(text))
    for a, b in spans:
        covered[a:b] = b"\1" * (b - a)
    return [(term_key(m[0]), m.start(), m.end()) for m in _TERM.finditer(text) if covered.find(1, m.start(), m.end()) < 0]


def surroundings(text: str, spans: list[tuple[int, int, int, str]], around: int = AROUND) -> list[tuple[int, int]]:
    """(entity, place) of each entity; ``place`` names the words on both sides of a mention."""
    words = words_of(text, [s[1:3] for s in spans])
    terms, starts = np.array([w[0] for w in words], np.int64), np.array([w[1] for w in words], np.int64)
    out: dict[int, int] = {}
    for kind, start, _, value in spans:
        entity = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(f"{kind}:{value}".encode()))))
        i = int(np.searchsorted(starts, start))
        place = int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(terms[max(0, i - around) : i + around].tobytes()))))
        out[entity] = min(out.get(entity, place), place)
    return list(out.items())


def term_places(terms: np.ndarray, around: int = AROUND) -> tuple[np.ndarray, np.ndarray]:
    """Distinct terms of a text, and a name of the words around the first mention of each."""
    padded = np.concatenate([np.zeros(around, np.int64), terms, np.zeros(around, np.int64)]).view(np.uint64)
    sums = np.zeros(len(terms), np.uint64)
    for k in range(2 * around + 1):
        mixed = (padded[k : k + len(terms)] + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15 + 2 * k)
        sums += mixed ^ (mixed >> np.uint64(29))
    own, first = np.unique(terms, return_index=True)
    return own, sums[first].view(np.int64)


_SPAN = T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
]))
_ENTITIES = T.ArrayType(T.StructType([T.StructField("entity", T.LongType()), T.StructField("place", T.LongType())]))


def mentions(docs: DataFrame, around: int = AROUND) -> DataFrame:
    """Columns of ``docs`` (text last) with ``base`` spans and ``entities``; the text is kept where there are any."""
    schema = T.StructType([*docs.schema.fields, T.StructField("base", _SPAN), T.StructField("entities", _ENTITIES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32())]))
        entity = pa.list_(pa.struct([("entity", pa.int64()), ("place", pa.int64())]))
        for batch in batches:
            base, held, texts = [], [], []
            for text in batch.column(batch.num_columns - 1):
                text = text.as_py()
                spans = base_spans(text)
                base.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
                held.append([dict(zip(("entity", "place"), e)) for e in (surroundings(text, spans, around) if spans else [])])
                texts.append(text if spans else None)
            yield pa.RecordBatch.from_arrays([
                *batch.columns[:-1], pa.array(texts, batch.columns[-1].type), pa.array(base, span), pa.array(held, entity),
            ], schema.names)

    return docs.mapInArrow(run, schema)


def pairs_of(texts: DataFrame, around: int = AROUND) -> DataFrame:
    """Rows (``_row``, ``entity``, ``term``, ``place``): every word of a row once with each of its entities.

    ``texts``: rows with ``_row``, ``_text``, ``base`` and ``entities``.
    """
    names = ("_row", "entity", "term", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, text, base, held in zip(*[c.to_pylist() for c in batch.columns]):
                words = words_of(text, [(s["start"], s["end"]) for s in base])
                terms, places = term_places(np.array([w[0] for w in words], np.int64), around)
                for e in held:
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(terms), row)), pa.array(np.full(len(terms), e["entity"])), pa.array(terms),
                        pa.array(places ^ np.int64(e["place"])),
                    ], names)

    return texts.select("_row", "_text", "base", "entities").mapInArrow(run, "_row long, entity long, term long, place long")


def term_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Per word (by its hash): the number of rows that hold it, over whole texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        keys: dict[str, tuple[int, ...]] = {}

        def rows() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], ["term", "n"]
            )
            counts.clear()
            return out

        for batch in batches:
            for text in batch.column(0):
                held: set[int] = set()
                for raw in set((text.as_py() or "").split()):
                    found = keys.get(raw)
                    if found is None:
                        if len(keys) > 300_000:
                            keys.clear()
                        found = keys[raw] = tuple(term_key(w) for w in _TERM.findall(raw))
                    held.update(found)
                counts.update(held)
                if len(counts) > 1_000_000:
                    yield rows()
        if counts:
            yield rows()

    counts = docs.select(quoted(text_col).cast("string").alias("text")).mapInArrow(run, "term long, n long")
    return counts.groupBy("term").agg(F.sum("n").alias("n"))


def disclosures(
    in_doc: DataFrame, entities: DataFrame, terms: DataFrame, n_docs: int, support: int = SUPPORT, least: float = GENERALISE
) -> DataFrame:
    """Pairs (``entity``, ``term``) with their ``disclosure``, from ``least`` on.

    ``in_doc``: ``pairs_of`` the rows; ``entities`` and ``terms``: documents per entity and word.
    """
    # equal surroundings are counted first, so a copied passage is one row from here on
    by_place = in_doc.groupBy("entity", "term", "place").agg(F.count(F.lit(1)).alias("n"))
    pairs = by_place.groupBy("entity", "term").agg(F.sum("n").alias("n_both"), F.count(F.lit(1)).alias("support"))
    known = pairs.filter(F.col("support") >= support).join(entities, "entity").join(terms, "term")
    information = -F.log(F.col("n_entity") / float(max(n_docs, 1)))
    shared = F.log(F.col("n_both") * float(n_docs) / (F.col("n_entity") * F.col("n")))
    ratio = F.when(information > 0, shared / information)
    return known.withColumn("disclosure", ratio).filter(F.col("disclosure") >= least).select("entity", "term", "disclosure")


def scan(
    docs: DataFrame, around: int = AROUND, support: int = SUPPORT, generalise: float = GENERALISE, remove: float = REMOVE,
    id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
) -> DataFrame:
    """Per row of ``docs``: ``row`` (its id, or with ``carry`` the whole row), ``base`` and ``added`` spans."""
    text = quoted(text_col).cast("string").alias("_text")
    kept = F.struct(*[quoted(c) for c in docs.columns]) if carry else quoted(id_col)
    found = mentions(docs.select(kept.alias("row"), text), around)
    found = cut(found.withColumn("_row", F.monotonically_increasing_id()), "mentions")
    asked = found.select("_row", F.explode("entities").alias("e")).select("_row", "e.entity", "e.place")
    entities = asked.groupBy("entity").agg(F.count(F.lit(1)).alias("n_entity")).filter(F.col("n_entity") >= support)
    live = asked.join(entities, "entity").groupBy("_row").agg(F.collect_list(F.struct("entity", "place")).alias("entities"))
    in_doc = cut(pairs_of(found.filter(F.size("base") > 0).drop("entities").join(live, "_row"), around), "pairs")
    pairs = disclosures(in_doc, entities, term_counts(docs, text_col), found.count(), support, generalise)
    kind = F.when(F.col("disclosure") >= remove, F.lit(KINDS.index("removed"))).otherwise(F.lit(KINDS.index("generalised")))
    flagged = in_doc.join(pairs, ["entity", "term"]).groupBy("_row", "term").agg(F.max(kind).alias("kind"))
    flagged = flagged.groupBy("_row").agg(F.collect_list(F.struct("term", "kind")).alias("_flagged"))

    @F.pandas_udf(_SPAN)
    def marked(texts, bases, words):
        import pandas as pd

        out = []
        for text, base, own in zip(texts, bases, words):
            if own is None or not len(own):
                out.append([])
                continue
            kinds = {int(w["term"]): int(w["kind"]) for w in own}
            spans = [(kinds[t], a, b) for t, a, b in words_of(text, [(s["start"], s["end"]) for s in base]) if t in kinds]
            out.append([dict(zip(("kind", "start", "end"), s)) for s in sorted(spans)])
        return pd.Series(out)

    joined = found.drop("entities").join(flagged, "_row", "left")
    return joined.select("row", "base", marked("_text", "base", "_flagged").alias("added"))


def shape(word: str) -> str:
    """What a generalised word keeps: its kind."""
    return "<number>" if word.isdigit() else "<name>" if word[:1].isupper() else "<word>"


def sanitise(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """``docs`` with personal data replaced by its kind, and disclosing words generalised or removed."""
    found = scan(docs, text_col=text_col, carry=True, **options)
    marked = found.select("row", quoted("row").getField(text_col).cast("string").alias("text"), F.concat("base", "added").alias("spans"))

    @F.pandas_udf("string")
    def replaced(texts, spans):
        import pandas as pd

        out = []
        for text, own in zip(texts, spans):
            if text is None or not len(own):
                out.append(text)
                continue
            done, parts = 0, []
            for s in sorted(own, key=lambda s: (s["start"], s["kind"])):
                if s["start"] < done:
                    done = max(done, s["end"])
                    continue
                kind, word = KINDS[s["kind"]], text[s["start"] : s["end"]]
                parts += [text[done : s["start"]], "" if kind == "removed" else shape(word) if kind == "generalised" else f"<{kind}>"]
                done = s["end"]
            out.append("".join([*parts, text[done:]]))
        return pd.Series(out)

    fixed = marked.withColumn("text", replaced("text", "spans"))
    columns = [F.col("text").alias(c) if c == text_col else quoted("row").getField(c).alias(c) for c in docs.columns]
    return fixed.select(*columns)
