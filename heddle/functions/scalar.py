"""Column expressions for text, numbers, maps and flags."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from heddle.functions.runtime import quoted


def as_text(df: DataFrame, name: str) -> Column:
    """Text form of a column: missing is ``'nan'``, flags are ``'True'``/``'False'``."""
    text = quoted(name).cast("string")
    if isinstance(df.schema[name].dataType, T.BooleanType):
        text = F.initcap(text)
    return F.coalesce(text, F.lit("nan"))


def safe_name(col: Column) -> Column:
    """Value as part of a file name: blanks and slashes become underscores."""
    return F.regexp_replace(col, "[ /]", "_")


def first_token(col: Column, sep: str = "-") -> Column:
    return F.substring_index(col, sep, 1)


def split_trimmed(col: Column, sep: str) -> Column:
    return F.transform(F.split(col, sep), F.trim)


def log1p_base(col: Column, base: float) -> Column:
    return F.log1p(col) / math.log(base)


def neg_log10(col: Column) -> Column:
    return -F.log10(col)


def human_format(col: Column) -> Column:
    """Short number text with at most three digits and a K/M/B/T suffix."""
    value = col.cast("double")
    digits = F.when(value == 0, 0.0).otherwise(
        F.round(value / F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - 2))
        * F.pow(F.lit(10.0), F.floor(F.log10(F.abs(value))) - 2)
    )
    power = F.when(F.abs(digits) < 1000, 0).otherwise(
        F.least(F.lit(4), F.floor(F.log10(F.abs(digits)) / 3 + 1e-12).cast("int"))
    )
    scaled = F.round(digits / F.pow(F.lit(1000.0), power), 2)
    text = F.regexp_replace(F.regexp_replace(F.format_string("%.2f", scaled), "0+$", ""), "\\.$", "")
    suffix = F.element_at(F.array(*[F.lit(s) for s in ("", "K", "M", "B", "T")]), power + 1)
    return F.concat(text, suffix)


def short_id(*cols: Column, length: int = 10) -> Column:
    """Stable short id of a parameter set."""
    return F.substring(F.sha2(F.concat_ws("|", *cols), 256), 1, length)


def parse_thresholds(col: Column) -> Column:
    """Threshold text such as ``{'n_counts_max': 10}`` as a map."""
    return F.from_json(F.replace(col, F.lit("'"), F.lit('"')), "map<string,double>")


def two_flag_status(first: Column, second: Column) -> Column:
    return (
        F.when(first & second, "passed").when(~(first | second), "failed").otherwise("ambiguous")
    )


def significance_stars(z: Column) -> Column:
    return F.when(z > 3, "**").when(z > 1.5, "*").otherwise("")


def rounded_label(col: Column, prefix: str = "", digits: int = 2) -> Column:
    return F.concat(F.lit(prefix), F.format_string(f"%.{digits}f", col))


def merge_maps(base: Column, update: Column) -> Column:
    """Union of two maps where the update wins."""
    return F.map_zip_with(base, update, lambda k, a, b: F.coalesce(b, a))


def unpack_map(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    return df.withColumns({k: quoted(column)[k] for k in keys}).drop(column)


def clean_categories(col: Column, placeholders: Sequence[str] = ("NaN", "None", "", "nan", "unknown")) -> Column:
    return F.when(~col.isin(*placeholders), col)


def map_literal(values: Mapping[str, float | None]) -> Column:
    pairs = [F.lit(x) for k, v in values.items() for x in (k, v)]
    return F.create_map(*pairs)


def organism_guess(names: DataFrame, column: str) -> DataFrame:
    """'mouse' when at most a tenth of the names are upper case, else 'human'."""
    share = F.avg((quoted(column) == F.upper(quoted(column))).cast("double"))
    return names.agg(share.alias("upper_share")).withColumn(
        "organism", F.when(F.col("upper_share") <= 0.1, "mouse").otherwise("human")
    )
