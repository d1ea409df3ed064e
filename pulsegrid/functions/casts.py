"""Null-safe casts that keep track of what did not parse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Texts that stand for "no value" in landed files.
NULL_WORDS = ("", "null", "nan", "none")
#: Texts that mean true in a success flag.
TRUE_WORDS = ("true", "1", "yes")


def null_sentinels(col: Column) -> Column:
    """Null where the text is one of the no-value words, else the text itself."""
    return F.when(F.lower(F.trim(col)).isin(*NULL_WORDS), None).otherwise(col)


def success_flag(col: Column) -> Column:
    """True for the true words, false for any other text, null for null."""
    return F.lower(F.trim(col)).isin(*TRUE_WORDS)


def parse_timestamp(col: Column) -> Column:
    """ISO-8601 or ``YYYY-MM-DD HH:MM:SS`` text to a timestamp, null if unreadable."""
    return col.try_cast("timestamp")


def typed(col: Column, type_name: str) -> Column:
    if type_name == "boolean":
        return success_flag(col)
    return col.try_cast(type_name)


def cast_with_quarantine(
    df: DataFrame,
    types: dict[str, str],
    errors_col: str = "_cast_errors",
) -> DataFrame:
    """Cast the named text columns; list in ``errors_col`` those that failed.

    A sentinel is a legitimate null. A decimal text in a long column is an
    error, because ``try_cast`` does not truncate. One projection, no UDF.
    """
    present = {name: t for name, t in types.items() if name in df.columns}
    raw = {name: null_sentinels(F.trim(F.col(name).cast("string"))) for name in present}
    failed = [
        F.when(raw[name].isNotNull() & typed(raw[name], t).isNull(), F.lit(name))
        for name, t in present.items()
        if t != "boolean"
    ]
    errors = F.array_compact(F.array(*failed)) if failed else F.array().cast("array<string>")
    return df.select(
        *[
            typed(raw[name], present[name]).alias(name) if name in present else F.col(name)
            for name in df.columns
        ],
        errors.alias(errors_col),
    )
