"""Text normalisation expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import col as _c

# The accented capitals folded by ``capitalize`` and their
# replacements, position by position.  Only these eleven letters are folded;
# every other accented letter (À Ü Ñ È …) is kept.
ACCENTED = "ÁÉÍÓÚÇÕÂÃÔÊ"
PLAIN = "AEIOUCOAAOE"


def upper_unaccent(c: Column) -> Column:
    """X1 as an expression: ``upper`` then fold the eleven accented capitals."""
    return F.translate(F.upper(c), ACCENTED, PLAIN)


def capitalize(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Upper-case the named columns and fold the accented capitals.
    ``upper`` on a number yields a string (the column changes type)."""
    cols = list(columns)
    if not cols:
        return df
    return df.withColumns({c: upper_unaccent(_c(c)) for c in cols})


def regex_rules(df: DataFrame, rules: Iterable[Mapping]) -> DataFrame:
    """``[{field, pattern, replacement}, ...]`` applied in sequence with
    Java regex semantics (``$1`` group references, every match replaced).
    Despite the config key's name (``capitalizeword``) nothing is
    capitalised."""
    for rule in rules or []:
        df = df.withColumn(rule["field"], F.regexp_replace(_c(rule["field"]), rule["pattern"],
                                                           rule["replacement"]))
    return df


def truncate_width(df: DataFrame, widths: Mapping[str, int]) -> DataFrame:
    """K4: cut over-long strings to the declared width (in characters)
    instead of rejecting the row."""
    return df.withColumns({c: F.substring(_c(c), 1, int(n)) for c, n in widths.items()})
