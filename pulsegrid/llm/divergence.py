"""Divergence of the sources of each language from each other and from the language, by terms.

A language keeps the terms found in ``min_docs`` of its documents or more. With V kept
terms and N of their occurrences a group gives a kept term that occurs n times in it
p = 1 + floor(SCALE * (n + 2) / (N + 2 V)), and two groups differ there by
f = floor((p - q)^2 / (p + q)); all of it in whole numbers.

The sum of f over all kept terms is taken for each two sources by row accumulation: the
terms of a language are dealt into blocks that hold whole terms, and a block is a
term-major index (term -> its sources). Each source adds its terms through that index
into a dense accumulator with a place for each peer, so no (source, source, term) rows
come to be. What is absent has its own value, p of n = 0: each accumulator starts from
the terms that both lack, is corrected for those that one of them has, and again where
the index shows that both have it. Every language has a block 0, also one without terms.

Null text, language and source are empty strings. Repeated rows count each. A text
without terms still makes its group known. Ties go to the smaller item in bytes.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import ship, written

SCALE = 1_000_000_000
#: Terms that a task holds before it gives out its counts, and bytes of a text split at once.
HELD_TERMS, PIECE = 300_000, 1 << 22
#: Postings of a block, and sources whose accumulators one task fills.
BLOCK_POSTINGS, SLICE = 500_000, 1024
#: Letters and all bytes of other characters stay, only A-Z are lowered; the rest parts terms.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_in(raw: bytes):
    """The terms of a UTF-8 text, in lists of one piece each; no term is cut."""
    folded, at = raw.translate(FOLD), 0
    while at < len(folded):
        stop = folded.find(b" ", at + PIECE)
        stop = len(folded) if stop < 0 else stop
        yield folded[at:stop].split()
        at = stop


def term_counts(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, term, n, docs) of each group, counted in tasks first; the term '' (n 0) stands for the group."""

    def run(batches):
        held: dict[tuple, tuple[Counter, Counter]] = {}

        def give():
            for (la, so), (n, docs) in held.items():
                terms = [b"", *n]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([la] * len(terms), pa.string()), pa.array([so] * len(terms), pa.string()),
                     pa.array(terms, pa.binary()).cast(pa.string()), pa.array([0, *n.values()], pa.int64()),
                     pa.array([0, *map(docs.__getitem__, n)], pa.int64())],
                    ["lang", "source", "term", "n", "docs"],
                )
            held.clear()

        for batch in batches:
            for la, so, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                if (la, so) not in held:
                    held[la, so] = Counter(), Counter()
                n, docs = held[la, so]
                own = set()
                for found in terms_in((value.as_py() or "").encode()):
                    n.update(found)
                    own.update(found)
                docs.update(own)
            if sum(len(n) for n, _ in held.values()) > HELD_TERMS:
                yield from give()
        yield from give()

    ship(df.sparkSession)
    named = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(x) for c, x in ((lang, "l"), (source, "s"))]
    found = df.select(*named, F.col(f"`{text}`").alias("t")).mapInArrow(
        run, "lang string, source string, term string, n long, docs long"
    )
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def _p(n: str, total: str, terms: str):
    return F.expr(f"1 + (cast({SCALE} as decimal(38,0)) * ({n} + 2)) div ({total} + 2 * {terms})")


def _f(p, q):
    return (p - q) * (p - q) // (p + q)


def accumulate(sources: np.ndarray, p0: np.ndarray, term: np.ndarray, peer: np.ndarray, p: np.ndarray, rows: np.ndarray,
               absent: int) -> np.ndarray:
    """Sums of f of the sources ``rows`` (places in ``sources``) against every source, over the terms of one block.

    The postings are (term, peer, p); ``p0`` is p of an absent term; ``absent`` terms more occur nowhere.
    """
    order = np.argsort(term, kind="stable")
    term, peer, p = term[order], peer[order], p[order]
    n_terms = int(term[-1]) + 1 if len(term) else 0
    starts = np.searchsorted(term, np.arange(n_terms + 1))
    # (peer, p) with their numbers: most terms of a source are seen once or twice
    kinds, times = np.unique(np.stack([peer, p]), axis=1, return_counts=True)
    by_source = np.argsort(peer, kind="stable")
    bounds = np.searchsorted(peer[by_source], np.arange(len(sources) + 1))
    out = np.zeros((len(rows), len(sources)), np.int64)
    for acc, g in zip(out, rows.tolist()):
        nothing = _f(p0[g], p0)
        acc += nothing * absent
        # terms that only the peer has
        np.add.at(acc, kinds[0], times * (_f(p0[g], kinds[1]) - nothing[kinds[0]]))
        own = by_source[bounds[g]:bounds[g + 1]]
        # terms that only this source has
        values, many = np.unique(p[own], return_counts=True)
        for v, m in zip(values.tolist(), many.tolist()):
            acc += m * (_f(v, p0) - nothing)
        # terms of both, through the index: each of them is in both corrections above
        first, last = starts[term[own]], starts[term[own] + 1]
        size = last - first
        at = np.repeat(first - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())
        h, q, mine = peer[at], p[at], np.repeat(p[own], size)
        np.add.at(acc, h, _f(mine, q) - _f(mine, p0[h]) - _f(p0[g], q) + nothing[h])
    return out


def _pairs(postings: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for every two sources of a language."""
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block")
    slices = F.explode(F.sequence(F.lit(0), F.col("slices") - 1)).alias("slice")
    left = postings.select("lang", "place", "term", "p", block, "slices").select("lang", "block", "place", "term", "p", slices)
    right = groups.select("lang", "source", "place", "p0", "terms", "blocks", slices).select(
        "*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block")
    )

    right = right.toDF(*right.columns)  # columns of its own: both sides come from the same table

    def fill(own: pa.Table, peers: pa.Table) -> pa.Table:
        peers = peers.sort_by("place")
        names = peers.column("source").combine_chunks()
        p0, g = peers.column("p0").to_numpy(), peers.num_rows
        at = peers.column("slice")[0].as_py()
        term = own.column("term").combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
        rows = np.arange(at * SLICE, min(g, (at + 1) * SLICE))
        first = peers.column("block")[0].as_py() == 0
        found = accumulate(
            np.arange(g), p0, term, own.column("place").to_numpy() - 1, own.column("p").to_numpy(), rows,
            peers.column("terms")[0].as_py() if first else 0,
        )
        return pa.table({
            "lang": pa.array([peers.column("lang")[0].as_py()] * len(rows), pa.string()),
            "source": names.take(pa.array(rows)),
            "items": pa.array([names] * len(rows), pa.list_(pa.string())) if len(rows) else pa.array([], pa.list_(pa.string())),
            "sums": pa.array(list(found), pa.list_(pa.int64())),
        })

    ship(groups.sparkSession)
    part = ["lang", "block", "slice"]
    found = left.groupBy(*part).cogroup(right.groupBy(*part)).applyInArrow(
        fill, "lang string, source string, items array<string>, sums array<long>"
    )
    return (
        found.select("lang", "source", F.explode(F.arrays_zip("items", "sums")).alias("x"))
        .select("lang", "source", F.col("x.items").alias("item"), F.col("x.sums").alias("value"))
        .filter("item <> source").groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    )


def audit(
    df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", min_docs: int = 10, top: int = 10
) -> DataFrame:
    """(lang, source, part, item, value, rank).

    Part ``pair``: each other source of the language with the divergence from it, all ranks.
    Part ``term``: the ``top`` kept terms that the source uses more than its language, by f.
    """
    counts = written(term_counts(df, text, lang, source), "divergence-counts")
    kept = written(
        counts.groupBy("lang", "term").agg(F.sum("n").alias("in_lang"), F.sum("docs").alias("docs"))
        .filter((F.col("docs") >= min_docs) & (F.col("term") != "")).select("lang", "term", "in_lang"), "divergence-kept",
    )
    used = written(counts.join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "in_lang"), "divergence-used")
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("in_lang").alias("lang_total"))
    sizes = used.groupBy("lang").agg(F.count("*").alias("postings"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    of_lang = Window.partitionBy("lang")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    groups = (
        counts.filter("term = ''").select("lang", "source")
        .join(totals, ["lang", "source"], "left").join(langs, "lang", "left").join(sizes, "lang", "left")
        .select("lang", "source", *map(zero, ("total", "terms", "lang_total", "postings")))
        # an accumulator holds all sources of a language, so they can be numbered together
        .withColumn("place", F.row_number().over(of_lang.orderBy("source")).cast("long"))
        .withColumn("slices", F.ceil(F.count("*").over(of_lang) / SLICE).cast("int"))
        .withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("postings") / BLOCK_POSTINGS)).cast("int"))
        .withColumn("p0", F.when(F.col("terms") > 0, _p("0L", "total", "terms")).otherwise(1))
    )
    groups = written(groups, "divergence-groups")
    postings = used.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "place", "slices", "blocks", _p("n", "total", "terms").alias("p"),
        _p("in_lang", "lang_total", "terms").alias("q"),
    )
    marked = postings.filter("p > q").select(
        "lang", "source", F.col("term").alias("item"), F.expr("(p - q) * (p - q) div (p + q)").alias("value")
    )
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")).alias("rank")
    terms = marked.select("*", rank).filter(F.col("rank") <= top)
    pairs = _pairs(postings, groups).select("*", rank)
    shape = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    return shape(pairs, "pair").unionByName(shape(terms, "term"))


#: The same over ``documents`` with dense rows; (10, 10) are the defaults above.
CHECK = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
w AS (SELECT lang, source, r, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
l AS (
  SELECT lang, count(term)::HUGEINT AS v, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang FROM d) LEFT JOIN kept USING (lang) GROUP BY lang),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000 * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
         1 + (1000000000 * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM g JOIN l USING (lang) JOIN kept k USING (lang)
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM dense a JOIN dense b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM dense WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""
