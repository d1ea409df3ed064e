"""Text predicates, the context decoder and message fingerprints."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F


def is_empty(col: Column) -> Column:
    """Null or empty text."""
    return F.coalesce(col, F.lit("")) == ""


def not_empty(col: Column) -> Column:
    return ~is_empty(col)


def has_term(col: Column, term: str) -> Column:
    """Whole-term, case-insensitive search."""
    return col.rlike(rf"(?i)(^|[^a-z0-9]){re.escape(term)}([^a-z0-9]|$)")


def has_any_term(col: Column, terms: list[str]) -> Column:
    joined = "|".join(re.escape(t) for t in terms)
    return col.rlike(rf"(?i)(^|[^a-z0-9])({joined})([^a-z0-9]|$)")


def decode_context(col: Column) -> Column:
    """Context JSON from plain or base64 text; anything else becomes null."""
    trimmed = F.trim(col)
    unpacked = F.try_validate_utf8(F.try_to_binary(trimmed, F.lit("base64")))
    return (
        F.when(trimmed.startswith("{"), trimmed)
        .when((trimmed != "") & F.trim(unpacked).startswith("{"), F.trim(unpacked))
    )


def context_artifact_id(context: Column) -> Column:
    return F.get_json_object(context, "$.artifactId")


def context_artifact_type(context: Column) -> Column:
    return F.get_json_object(context, "$.artifactKind")


def leaf_name(col: Column) -> Column:
    """``Table[Column]`` or ``[Column]`` to ``Column``."""
    return F.trim(F.regexp_replace(F.substring_index(col, "[", -1), r"\]+$", ""))


def normalize_statement(col: Column) -> Column:
    """Literals replaced by ``?``, upper case, white space collapsed."""
    no_strings = F.regexp_replace(col, r"'[^']*'", "?")
    no_quoted = F.regexp_replace(no_strings, r'"[^"]*"', "?")
    no_numbers = F.regexp_replace(no_quoted, r"[0-9]+(\.[0-9]+)?", "?")
    return F.trim(F.regexp_replace(F.upper(no_numbers), r"[ \t\r\n]+", " "))


def fingerprint(col: Column) -> Column:
    return F.sha2(normalize_statement(col), 256)


def first_match(cases: list[tuple[str, Column]], otherwise: str) -> Column:
    """The name of the first case whose condition holds."""
    chain = F
    for name, condition in cases:
        chain = chain.when(condition, F.lit(name))
    return chain.otherwise(F.lit(otherwise))


#: Failure classes and the message patterns that mean them, in order.
ERROR_PATTERNS = {
    "gateway_spool": "Spool",
    "network": "(?i)timeout|path|network",
    "source_or_cred": "(?i)login|credential|account",
    "user_cancel": "(?i)cancel",
}


def error_class(message: Column) -> Column:
    """Failure class read from the message alone."""
    return first_match([(name, message.rlike(p)) for name, p in ERROR_PATTERNS.items()], "unclassified")


def causal_class(
    latency: Column, cpu: Column, message: Column, latency_ms: float, cpu_pct: float
) -> Column:
    """Failure class from network, processor and message signals, in that order."""
    return first_match(
        [
            ("network", latency > latency_ms),
            ("gateway_cpu", cpu > cpu_pct),
            ("gateway_spool", has_term(message, "spool")),
            ("source_or_cred", has_any_term(message, ["timeout", "login", "credential"])),
        ],
        "unclassified",
    )
