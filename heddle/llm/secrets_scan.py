"""Secret scans: fixed patterns, and random strings by two character Markov models.

The patterns give the base spans.  The values they find are samples of random strings,
long plain words are samples of ordinary identifiers; one first-order Markov model is
counted from each.  A plain-looking word is no sample if it is a found value elsewhere,
or if the models of a first round call it random; copies of a word count once.  Every
run of key characters outside the base spans, plain-looking or not, becomes a further
span if the log-likelihood ratio of the two models reaches ``min_ratio``.  Both models
are conditioned on the classes of characters (upper, lower, digit, other) that the run
has, since a key of lower-case letters only was drawn from these alone.  Only
DataFrame functions are used: what a model needs are 67 x 67 counts.

Defined cases: a NULL text is empty; a text without matches has empty lists; with no
samples at all both models are uniform and nothing is added; repeated rows are scanned
one by one; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.runtime import cut, quoted
from heddle.llm.common import bind

ASSIGN = (
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
#: Classes of key characters; a bit each.
CLASSES = ("[A-Z]", "[a-z]", "[0-9]", "[+/_=-]")
#: Characters of keys, in the order of the models' tables.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
RUN = r"[A-Za-z0-9+/_=-]"
#: Plain words and numbers, as one finds them in prose and in code; a source of samples only.
ORDINARY = r"^[A-Z]?[a-z]+$|^[a-z]+(_[a-z]+)+$|^[A-Z]+$|^[0-9]+$"
KINDS = ("assign", "access", "hex", "markov")
MIN_RUN = 16
#: Natural logarithm of the odds that a random string must have over an identifier.
MIN_RATIO = 12.0


def _spans(text: Column, pattern: str, kind: str, value_group: int, least: int, hint: Column) -> Column:
    """Matches of ``pattern`` as (start, order, end, kind, value), without those of short values.

    The pieces between the matches give the places: both regex functions walk the text
    alike.  ``hint`` is a cheap test that every wanted text passes.
    """

    def located(pieces: Column) -> Column:
        found, values, gaps = pieces["m"], pieces["v" if value_group else "m"], pieces["g"]
        empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
        walked = F.aggregate(
            F.sequence(F.lit(0), F.size(found) - 1),
            empty,
            lambda acc, i: F.struct(
                (acc["at"] + F.length(F.get(gaps, i)) + F.length(F.get(found, i))).alias("at"),
                F.array_append(acc["starts"], acc["at"] + F.length(F.get(gaps, i))).alias("starts"),
            ),
            lambda acc: acc["starts"],
        )
        spans = F.transform(
            F.arrays_zip(walked.alias("s"), found.alias("m"), values.alias("v")),
            lambda x: F.struct(
                x["s"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                (x["s"] + F.length(x["m"])).alias("end"), F.lit(kind).alias("kind"), x["v"].alias("value"),
            ),
        )
        return F.filter(spans, lambda x: F.length(x["value"]) >= least)

    pieces = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("m"),
        *([F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group)).alias("v")] if value_group else []),
        F.split(text, pattern, -1).alias("g"),
    )
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string,value:string>>")
    return F.when(hint, bind(pieces, located)).otherwise(none)


def base_spans(text: Column) -> Column:
    """Base spans of all kinds, sorted by start and then kind."""
    return F.sort_array(F.concat(
        _spans(text, ASSIGN, "assign", 2, 8, text.rlike("[:=]") & text.rlike("(?i)pass|secret|token|api")),
        _spans(text, ACCESS, "access", 0, 16, text.contains("AKIA")),
        # a longer run is the same run, so short ones need not be listed
        _spans(text, "[0-9a-f]{32,}", "hex", 0, 32, text.rlike("[0-9a-f]{32}")),
    ))


def runs(text: Column, least: int = MIN_RUN) -> Column:
    """Runs of key characters of some length."""
    pattern = f"(?<!{RUN}){RUN}{{{least}"
    return _spans(text, f"{pattern},}}", "markov", 0, least, text.rlike(f"{pattern}}}"))


def _pairs(samples: DataFrame) -> DataFrame:
    """Counts of neighbouring characters in ``value``; a space stands before the first."""
    padded = F.concat(F.lit(" "), F.col("value"))
    pairs = F.transform(F.sequence(F.lit(1), F.length("value")), lambda i: F.substr(padded, i, F.lit(2)))
    return samples.select("random", F.explode(pairs).alias("pair")).groupBy("random", "pair").agg(F.count(F.lit(1)).alias("n"))


def train(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of every pair of characters, random against ordinary.

    Then, for every set of classes, what a character before any of them adds if only
    these can follow.  ``samples``: ``value`` and ``random`` (boolean label).  At most 2 x 68 x 67 counts
    reach the driver.  Counts are smoothed by one half.
    """
    places = {c: i for i, c in enumerate(f" {ALPHABET}")}
    known = samples.filter(F.col("value").rlike(f"^{RUN}+$") & F.col("random").isNotNull())
    counts = {(r["random"], r["pair"]): r["n"] for r in _pairs(known).collect()}
    table, given = [], []
    for a in places:
        seen = {k: sum(counts.get((k, a + b), 0) for b in ALPHABET) for k in (True, False)}
        for b in ALPHABET:
            chance = {k: (counts.get((k, a + b), 0) + 0.5) / (seen[k] + 0.5 * len(ALPHABET)) for k in seen}
            table.append(math.log(chance[True] / chance[False]))
    for classes in range(1 << len(CLASSES)):
        own = [b for b in ALPHABET if any(classes >> k & 1 and re.match(c, b) for k, c in enumerate(CLASSES))] or ALPHABET
        for a in places:
            seen = {k: sum(counts.get((k, a + b), 0) for b in ALPHABET) for k in (True, False)}
            follow = {k: sum(counts.get((k, a + b), 0) + 0.5 for b in own) / (seen[k] + 0.5 * len(ALPHABET)) for k in seen}
            given.append(math.log(follow[False] / follow[True]))
    return table + given


def ratio(value: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a string of key characters under a trained table."""
    numbers = F.split(F.lit(",".join(f"{x:.6f}" for x in table)), ",").cast("array<double>")
    width, rows = len(ALPHABET), len(ALPHABET) + 1
    place = lambda c: F.instr(F.lit(f" {ALPHABET}"), c)
    at = lambda i: F.element_at(numbers, i.cast("int"))
    classes = sum((F.when(value.rlike(c), 1 << k).otherwise(0) for k, c in enumerate(CLASSES)), F.lit(0))
    return bind(rows * width + classes * rows, lambda given: F.aggregate(
        F.split(value, ""),
        F.struct(F.lit(1).alias("at"), F.lit(0.0).alias("sum")),
        lambda acc, c: F.struct(
            place(c).alias("at"),
            (acc["sum"] + at((acc["at"] - 1) * width + place(c) - 1) + at(given + acc["at"])).alias("sum"),
        ),
        lambda acc: acc["sum"],
    ))


def samples(found: DataFrame) -> DataFrame:
    """Labelled samples of scanned texts: values of base spans, and other plain words among the runs."""
    value = F.explode("base.value").alias("value")
    random = found.select(F.lit(True).alias("random"), value)
    plain = found.select(F.explode("free.value").alias("value")).filter(F.col("value").rlike(ORDINARY)).distinct()
    plain = plain.join(random.select("value"), "value", "left_anti").select(F.lit(False).alias("random"), "value")
    return random.unionByName(plain)


def trusted(labelled: DataFrame, min_ratio: float) -> DataFrame:
    """Samples without the plain words that a first round of the models calls random."""
    table = train(labelled)
    return labelled.filter(F.when(F.col("random"), F.lit(True)).otherwise(ratio(F.col("value"), table) < min_ratio))


def scan(
    docs: DataFrame, labelled: DataFrame | None = None, least: int = MIN_RUN, min_ratio: float = MIN_RATIO,
    id_col: str = "doc_id", text_col: str = "text", carry: bool = False,
) -> DataFrame:
    """Per row of ``docs``: its id, ``base`` spans and ``spans`` (base and added ones).

    ``labelled`` (``value``, ``random``) replaces the samples taken from ``docs``.  With
    ``carry``, ``row`` holds the whole input row instead of its id.
    """
    text = F.coalesce(quoted(text_col), F.lit(""))
    kept = F.struct(*[quoted(c) for c in docs.columns]) if carry else quoted(id_col)
    rows = docs.select(kept.alias("row"), base_spans(text).alias("base"), runs(text, least).alias("runs"))
    free = F.filter("runs", lambda r: ~F.exists("base", lambda b: (b["start"] < r["end"]) & (r["start"] < b["end"])))
    found = cut(rows.select("row", "base", free.alias("free")), "scanned")
    table = train(labelled if labelled is not None else trusted(cut(samples(found), "samples"), min_ratio))
    added = F.filter("free", lambda r: ratio(r["value"], table) >= min_ratio)
    return found.select("row", "base", F.sort_array(F.concat("base", added)).alias("spans"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """``text`` with every span replaced; overlapping spans become one mark."""
    done = F.aggregate(
        spans,
        F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                (s["start"] >= acc["at"]),
                F.concat(acc["out"], F.substr(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)),
            ).otherwise(acc["out"]).alias("out"),
        ),
    )
    return bind(done, lambda d: F.concat(d["out"], F.substr(text, d["at"] + 1, F.length(text))))
