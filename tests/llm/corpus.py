"""Small tables for the operators' tests."""

from __future__ import annotations

import random

#: Columns whose names the operators use themselves.
CLASH = ["ids", "text_in", "fingerprint", "shard", "slot", "size", "gone", "k", "t", "k0", "row", "left", "digest_of",
         "lang_pred", "score", "n_lines"]


def docs(spark, rows, extra: bool = False):
    """(doc_id, text) rows as a table; with ``extra`` also columns with clashing names."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        from pyspark.sql import functions as F

        df = df.select("*", *[F.lit(f"x{i}").alias(c) for i, c in enumerate(CLASH)])
    return df


def words(rnd: random.Random, n: int) -> str:
    parts = ["the", "of", "ing", "and", "on", "er", "st", "re", "th", "at"]
    return " ".join("".join(rnd.choice(parts) for _ in range(rnd.randint(1, 3))) for _ in range(n))


def odd_texts() -> list[str | None]:
    """Null, empty, blank, tiny, signs, scripts, line breaks, special tokens and one long text without a blank."""
    rnd = random.Random(5)
    return [
        None, "", " ", "\n\n", "a", "Ab", "one two", "a\nb", "###", "日本語 テスト", "É é ﬁ İ", "x\x1cy\x85z",
        "<|endoftext|> tail", "don't y'all's", "12,345.6 ² ½", " lead and trail ", "a  b\t\tc",
        "".join(rnd.choice("abcdefgh") for _ in range(3000)), "a" * 2500, words(rnd, 900),
    ]
