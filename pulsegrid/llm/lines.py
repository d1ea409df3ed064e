"""Removal of repeated runs of lines, with DataFrame functions only.

The lines of a text are cut into chunks of two lines or more whose borders depend on
content alone: a rolling hash over two neighbouring line hashes has a local
minimum there, so text moved, put in front or left out shifts no border but the
next few. Chunks that occur again anywhere are removed but for their first
occurrence (smallest key, hash of the text, place). Chunks meet by their MD5 and are
removed only if all bytes agree: the smallest and the largest text of a hash must be
equal, which also holds a hot chunk to one text per task.

Single-line texts have no chunk of several lines and stay. Blank chunks stay. A null
text stays null, an empty one empty; a text of which all chunks go becomes empty.
Rows that agree in key and text count as one document and are treated alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.frames import fresh

#: Rolling hash: previous line, own line, modulus; borders need two lines on either side.
PREVIOUS, OWN, MODULUS = 1_000_003, 31, 2_147_483_647


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def chunks_of(text: Column) -> Column:
    """The array of chunks; joined by line breaks they are the text."""

    def borders(rolled: Column, n: Column) -> Column:
        inner = F.filter(
            F.sequence(F.lit(2), F.greatest(n - 2, F.lit(2))),
            lambda i: (F.get(rolled, i) < F.get(rolled, i - 1)) & (F.get(rolled, i) <= F.get(rolled, i + 1))
            & (i <= n - 2),
        )
        return F.concat(F.array(F.lit(0)), inner)

    def roll(hashes: Column) -> Column:
        return F.transform(
            hashes, lambda h, i: (F.coalesce(F.get(hashes, i - 1), F.lit(0)) * PREVIOUS + h * OWN) % MODULUS
        )

    def cut(lines: Column, starts: Column) -> Column:
        return F.transform(
            starts,
            lambda s, k: F.array_join(
                F.slice(lines, s + 1, F.coalesce(F.get(starts, k + 1), F.size(lines)) - s), "\n"
            ),
        )

    return _let(
        F.split(text, "\n"),
        lambda lines: _let(
            F.transform(lines, line_hash),
            lambda hashes: _let(
                roll(hashes),
                lambda rolled: _let(borders(rolled, F.size(rolled)), lambda starts: cut(lines, starts)),
            ),
        ),
    )


def count_lines(chunk: Column) -> Column:
    return F.length(chunk) - F.length(F.replace(chunk, F.lit("\n"), F.lit(""))) + 1


def _occurrences(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, pos, chunk, hash) of every chunk that can be judged; k and t name the document."""
    base = df.select(
        F.col(f"`{key}`").alias("k"), F.xxhash64(f"`{text}`").alias("t"), F.col(f"`{text}`").alias("text")
    ).filter(F.instr("text", "\n") > 0)
    return (
        base.select("k", "t", F.posexplode(chunks_of(F.col("text"))).alias("pos", "chunk"))
        .filter(F.col("chunk").contains("\n") & F.col("chunk").rlike("[^\\x20\\x09-\\x0D]"))
        .withColumn("hash", F.unhex(F.md5("chunk")))
    )


def removed_chunks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, gone): the places of the chunks to remove, one row per document that has some."""
    found = _occurrences(df, key, text)
    repeated = (
        found.groupBy("hash")
        .agg(
            F.count("*").alias("n"), F.min(F.struct("k", "t", "pos")).alias("first"),
            (F.min("chunk") == F.max("chunk")).alias("equal"),
        )
        .filter("n > 1 AND equal").select("hash", "first")
    )
    return (
        found.select("k", "t", "pos", "hash").join(repeated, "hash")
        .filter(~F.struct("k", "t", "pos").eqNullSafe(F.col("first")))
        .groupBy("k", "t").agg(F.collect_set("pos").alias("gone"))
    )


def dedup_lines(
    df: DataFrame, key: str = "doc_id", text: str = "text", lines: str | None = None, removed: str | None = None,
) -> DataFrame:
    """``df`` with repeated chunks taken out of ``text``.

    With ``lines`` and ``removed`` the numbers of lines before and of lines removed are added.
    """
    gone = removed_chunks(df, key, text)
    names = {c: fresh(df, c) for c in ("doc_hash", "gone", "left", "k", "t")}
    gone = gone.select(
        F.col("k").alias(names["k"]), F.col("t").alias(names["t"]), F.col("gone").alias(names["gone"])
    )
    marked = df.withColumn(names["doc_hash"], F.xxhash64(f"`{text}`")).join(
        gone, F.col(f"`{key}`").eqNullSafe(F.col(names["k"])) & (F.col(names["doc_hash"]) == F.col(names["t"])), "left"
    )
    touched = F.col(names["gone"]).isNotNull()
    # texts without a removal are not cut again
    both = _let(
        chunks_of(F.when(touched, F.col(f"`{text}`"))),
        lambda chunks: F.struct(
            F.array_join(F.filter(chunks, lambda c, i: ~F.array_contains(names["gone"], i)), "\n").alias("text"),
            F.aggregate(
                F.filter(chunks, lambda c, i: F.array_contains(names["gone"], i)), F.lit(0),
                lambda n, c: n + count_lines(c),
            ).alias("lines"),
        ),
    )
    cut = marked.withColumn(names["left"], F.when(touched, both))
    left = F.col(names["left"])
    whole = F.coalesce(F.when(F.col(f"`{text}`") == "", 0).otherwise(count_lines(F.col(f"`{text}`"))), F.lit(0))
    extra = {}
    if lines:
        extra[lines] = whole.cast("long")
    if removed:
        extra[removed] = F.coalesce(left["lines"], F.lit(0)).cast("long")
    new_text = F.when(touched, left["text"]).otherwise(F.col(f"`{text}`"))
    return cut.select(
        *[new_text.alias(c) if c == text else F.col(f"`{c}`") for c in df.columns],
        *[value.alias(name) for name, value in extra.items()],
    )


#: DuckDB's form of the same over ``documents`` (doc_id, n_lines, n_removed_lines, kept_sha256).
CHECK = f"""
WITH split_lines AS (
  SELECT doc_id, len(ls) AS n, unnest(ls) AS line, generate_subscripts(ls, 1) - 1 AS i
  FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL)
), hashed AS (
  SELECT *, ('0x' || substr(md5(line), 1, 8))::BIGINT AS h FROM split_lines
), rolled AS (
  SELECT *, (coalesce(lag(h) OVER w, 0) * {PREVIOUS} + h * {OWN}) % {MODULUS} AS r
  FROM hashed WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), borders AS (
  SELECT *, CASE WHEN i = 0 OR (i >= 2 AND i <= n - 2 AND r < lag(r) OVER w AND r <= lead(r) OVER w)
                 THEN 1 ELSE 0 END AS s
  FROM rolled WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), numbered AS (
  SELECT *, sum(s) OVER (PARTITION BY doc_id ORDER BY i ROWS UNBOUNDED PRECEDING) AS k FROM borders
), chunks AS (
  SELECT doc_id, k, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS lines FROM numbered GROUP BY 1, 2
), judged AS (
  SELECT *, lines > 1 AND regexp_matches(chunk, '[^\\x20\\x09-\\x0D]')
            AND row_number() OVER (PARTITION BY chunk ORDER BY doc_id, k) > 1 AS gone
  FROM chunks
)
SELECT d.doc_id,
       CASE WHEN coalesce(d.text, '') = '' THEN 0 ELSE coalesce(j.n_lines, 0) END::BIGINT AS n_lines,
       coalesce(j.n_removed_lines, 0)::BIGINT AS n_removed_lines, j.kept_sha256
FROM documents d LEFT JOIN (
  SELECT doc_id, sum(lines) AS n_lines, sum(CASE WHEN gone THEN lines ELSE 0 END) AS n_removed_lines,
         sha256(coalesce(string_agg(chunk, chr(10) ORDER BY k) FILTER (WHERE NOT gone), '')) AS kept_sha256
  FROM judged GROUP BY 1
) j USING (doc_id)
"""
