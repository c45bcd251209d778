"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps the measurements and one
long of failure bits; a policy is a named mask over those bits, so trying another
policy, or leaving a rule out, reads the ledger and never the texts again.  Only
DataFrame functions are used.

Defined cases: a NULL or empty text has no words and fails ``few_words``; repeated rows
are measured one by one; an empty table gives an empty ledger; columns other than the
id and the text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from heddle.functions.runtime import quoted
from heddle.llm.common import BLANK, bind, total, words_of

#: Words of a window that counts as repeated text.
WINDOW = 8


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL condition over the measurements; its bit is its place in the list."""

    name: str
    fails: str


RULES = (
    Rule("few_words", "n_words < 20"),
    Rule("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("repeated_lines", "n_lines >= 6 AND 2 * n_dup_lines > n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("shouting", "2 * n_upper > word_chars"),
    Rule("stutter", "5 * n_stutter > n_words"),
)
BASE = ("few_words", "repeated_words")

#: Policies by version: the rules that a document must not fail.
POLICIES: Mapping[str, Sequence[str]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "repeated_lines"),
    "v2": tuple(r.name for r in RULES),
}
CURRENT = "v2"


def _repeat_words(windows: Column) -> Column:
    """Words covered by windows (given by their hashes) that occur twice or more.

    Only a text with an equal pair of windows is sorted; equal neighbours in the sorted
    list give the places, and each place covers up to the next one.
    """
    marked = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        twins = F.filter(
            s,
            lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twins, lambda e: e["i"]))

    def covered(p: Column) -> Column:
        return total(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW))))
        )

    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, bind(bind(marked, places), covered)).otherwise(F.lit(0).cast("long"))


def _pair_up(hashes: Column, width: int) -> Column:
    """Hash of each element with the one ``width`` places on."""
    return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + width)))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of measurements per document.

    Windows are compared by a 64-bit hash of their eight words: within one text of a
    million words a false match has a chance below 1e-7.
    """
    rows = docs.select(quoted(id_col).alias(id_col), F.coalesce(quoted(text_col), F.lit("")).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(f"[^{BLANK}]"))
    split = rows.select(
        id_col,
        words_of(F.col("_text")).alias("_words"),
        lines.alias("_lines"),
        F.length(F.regexp_replace("_text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        F.length(F.regexp_replace("_text", "[^A-Z]+", "")).cast("long").alias("n_upper"),
    )
    n = F.size("_words")
    # hashes of 1, 2, 4 and 8 words: each doubles the one before
    hashed = split.withColumn("_h1", F.transform("_words", lambda w: F.xxhash64(w)))
    for width in (1, 2, 4):
        hashed = hashed.withColumn(f"_h{2 * width}", _pair_up(F.col(f"_h{width}"), width))
    windows = F.slice("_h8", 1, F.greatest(n - (WINDOW - 1), F.lit(0)))
    return hashed.withColumn("_windows", windows).select(
        id_col,
        n.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        "n_symbols",
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("_windows")).alias("n_repeat_words"),
        F.size(F.filter("_words", lambda w, i: w == F.coalesce(F.get("_words", i - 1), F.lit("")))).cast("long").alias("n_stutter"),
        "n_upper",
    )


def ledger(measured: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The measurements with ``failure_bits``: bit i is set if rule i fails."""
    if len(rules) > 63:
        raise ValueError("a long holds 63 rules")
    bits = F.lit(0).cast("long")
    for i, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured.withColumn("failure_bits", bits)


def mask(names: Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    places = {r.name: i for i, r in enumerate(rules)}
    return sum(1 << places[n] for n in set(names))


def passes(names: Sequence[str], rules: Sequence[Rule] = RULES) -> Column:
    """Whether a row of the ledger fails none of the named rules."""
    return F.col("failure_bits").bitwiseAND(F.lit(mask(names, rules)).cast("long")) == 0


def ablations(
    book: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES, rules: Sequence[Rule] = RULES
) -> DataFrame:
    """Per policy and rule: documents failing it, failing it alone, and kept without it.

    The ledger is first counted by its bits, so what follows handles one row per
    combination of failures instead of one per document.
    """
    counts = book.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    tries = [
        F.struct(
            F.lit(policy).alias("policy"), F.lit(rule).alias("rule"),
            F.lit(mask(names, rules)).cast("long").alias("all"), F.lit(mask([rule], rules)).cast("long").alias("one"),
        )
        for policy, names in policies.items()
        for rule in names
    ]
    each = counts.select("n", "failure_bits", F.explode(F.array(*tries)).alias("t"))
    hit = F.col("failure_bits").bitwiseAND(F.col("t.all"))
    rest = hit.bitwiseAND(F.bitwise_not(F.col("t.one")))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return each.groupBy(F.col("t.policy").alias("policy"), F.col("t.rule").alias("rule")).agg(
        F.sum("n").alias("n_documents"),
        count(hit == 0).alias("n_kept"),
        count(F.col("failure_bits").bitwiseAND(F.col("t.one")) != 0).alias("n_failing"),
        count(hit == F.col("t.one")).alias("n_failing_alone"),
        count(rest == 0).alias("n_kept_without"),
    )


def judge(
    docs: DataFrame, policy: str = CURRENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Ledger of ``docs`` with ``base_failed`` and the verdict ``kept`` of a policy."""
    book = ledger(measure(docs, id_col, text_col))
    return book.withColumns({"base_failed": ~passes(BASE), "kept": passes(BASE) & passes(POLICIES[policy])})


def keep(docs: DataFrame, policy: str = CURRENT, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the policy keeps, with all their columns; no join and no shuffle."""
    packed = docs.select(F.struct(*[quoted(c) for c in docs.columns]).alias("_row"), quoted(text_col).alias("_t"))
    judged = judge(packed, policy, id_col="_row", text_col="_t")
    # the id keeps the filter above the measurements: below them, each of its uses would measure anew
    placed = judged.select("_row", "kept", F.monotonically_increasing_id().alias("_place"))
    return placed.filter("kept AND _place >= 0").select("_row.*")
