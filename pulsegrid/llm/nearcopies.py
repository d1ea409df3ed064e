"""Near copies by the Jaccard similarity of five-word shingle sets.

Two texts link if their sets of ``SHINGLE``-word shingles (XXH64 of each, A-Z
lower-cased) have a Jaccard similarity of ``LEAST`` or more; components of links are
the groups. Equal sets become one node first.

Candidates are found by the SimHash search of operator 3 (``simhash``): fingerprints of
the shingle sets, pivot distance tables, and links of at most ``BITS`` differing bits.
Fingerprints at 0.8 are 10 bits apart on average, too far for blocks alone, so a second
search completes the first: MinHash, ``BANDS`` bands of ``ROWS`` minima each. A pair at
exactly 0.8 agrees in no band with probability (1 - 0.8^6)^40 = 5e-6, at 0.9 below
1e-13. Whatever either search finds is verified by the true similarity.

All members of a band's cell are candidates of its smallest node, so cells give as many
rows as they have members; the links of fingerprints are spanning forests, and nodes of
one fingerprint hang on its smallest. Candidates are verified one by one; where this
leaves a candidate component in several pieces, every pair of nodes in different pieces
is verified in groups of two chunks at most.

Texts without a word are one group. A text of fewer words is one shingle. Of repeated
rows, and of rows without a key, one stays like of any other group.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm.components import components
from pulsegrid.llm.frames import fresh, lists, map_arrow, written
from pulsegrid.llm.simhash import links, majority, shingle_hashes

SHINGLE = 5
#: Least similarity as a fraction: 4 / 5.
PART, WHOLE = 4, 5
ROWS, BANDS = 6, 40
#: Differing bits of two fingerprints that make a candidate.
BITS = 12
#: Nodes of a chunk of a large candidate component.
CHUNK = 256
FACTORS = np.random.default_rng(42).integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint32) | np.uint32(1)
#: Shingles that are multiplied at a time.
PIECE = 1024


def shingle_set(text: str | None) -> np.ndarray:
    """The different shingle hashes, increasing."""
    return np.unique(shingle_hashes(text, SHINGLE))


def bands(shingles: np.ndarray) -> list[int]:
    """One signed hash per band; a text without a shingle has none."""
    if not len(shingles):
        return []
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(FACTORS), (1 << 32) - 1, np.uint32)
    for at in range(0, len(short), PIECE):
        np.minimum(least, (FACTORS[:, None] * short[None, at:at + PIECE]).min(1), out=least)
    raw = least.tobytes()
    return [xxhash.xxh64_intdigest(raw[4 * ROWS * k:4 * ROWS * (k + 1)], k) - (1 << 63) for k in range(BANDS)]


def alike(shared, n, m):
    """Whether sets of ``n`` and ``m`` elements, ``shared`` in common, are similar enough; in whole numbers."""
    return (PART + WHOLE) * shared >= PART * (n + m)


# -- nodes -------------------------------------------------------------------
def _digest(text: str):
    return F.unhex(F.md5(F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")))


def _nodes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(k, t, node, fp, bands) per row: digest of the text, hash of its shingle set, its fingerprint and bands."""
    kind = df.schema[key].dataType.simpleString()

    def make():
        def step(batch):
            node, fp, found = [], [], []
            for x in batch.column(2):
                shingles = shingle_set(x.as_py())
                node.append(xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63))
                fp.append(majority(shingles) if len(shingles) else None)
                found.append(bands(shingles))
            return pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(node, pa.int64()), pa.array(fp, pa.int64()),
                 pa.array(found, pa.list_(pa.int64()))],
                ["k", "t", "node", "fp", "bands"],
            )

        return step

    given = df.select(F.col(f"`{key}`").alias("k"), _digest(text).alias("t"), F.col(f"`{text}`").alias("text"))
    return map_arrow(given, make, f"k {kind}, t binary, node long, fp long, bands array<long>")


def _sets(df: DataFrame, text: str, wanted: DataFrame) -> DataFrame:
    """(node, shingles) of the texts in ``wanted`` (t, node)."""

    def make():
        def step(batch):
            found = [shingle_set(x.as_py()).view(np.int64) for x in batch.column(1)]
            return pa.RecordBatch.from_arrays([batch.column(0), lists(found, pa.int64())], ["node", "shingles"])

        return step

    source = df.select(_digest(text).alias("t"), F.col(f"`{text}`").alias("text"))
    chosen = source.join(wanted, "t").select("node", "text").dropDuplicates(["node"])
    return map_arrow(chosen, make, "node long, shingles array<long>")


# -- links -------------------------------------------------------------------
def pivot_candidates(nodes: DataFrame, bits: int = BITS) -> DataFrame:
    """(a, b): links of fingerprints by pivot tables, each between their smallest nodes, and the nodes of one fingerprint."""
    known = nodes.filter("fp IS NOT NULL").select("fp", "node").distinct()
    least = written(known.groupBy("fp").agg(F.min("node").alias("b")), "near-fingerprints")
    found = links(least.select("fp"), bits=bits).select(F.col("a").alias("x"), F.col("b").alias("y"))
    x = least.select(F.col("fp").alias("x"), F.col("b").alias("a"))
    y = least.select(F.col("fp").alias("y"), "b")
    same = known.join(least, "fp").filter("node > b").select(F.col("node").alias("a"), "b")
    return found.join(x, "x").join(y, "y").select("a", "b").unionByName(same)


def _candidates(nodes: DataFrame) -> DataFrame:
    """(a, b): each member of a band's cell with the smallest one."""
    members = written(nodes.select("node", F.explode("bands").alias("band")), "near-bands")
    cells = members.groupBy("band").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b < last")
    return members.join(cells.select("band", "b"), "band").filter("node > b").select(F.col("node").alias("a"), "b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("y"))
    shared = F.size(F.array_intersect("x", "y"))
    return pairs.join(x, "a").join(y, "b").filter(alike(shared, F.size("x"), F.size("y"))).select("a", "b")


def forest(nodes: np.ndarray, pieces: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Links that connect all pieces that a similar pair connects; the sets are not empty."""
    sizes = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    different, place = np.unique(np.concatenate(sets), return_inverse=True)
    root, out = pieces.copy(), []
    for i in range(len(nodes) - 1):
        rest = np.flatnonzero(root[i + 1:] != root[i]) + i + 1
        rest = rest[WHOLE * np.minimum(sizes[rest], sizes[i]) >= PART * np.maximum(sizes[rest], sizes[i])]
        if not len(rest):
            continue
        mine = np.zeros(len(different), bool)
        mine[place[starts[i]:starts[i] + sizes[i]]] = True
        shared = np.add.reduceat(mine[place].astype(np.int32), starts)
        for j in rest[alike(shared[rest], sizes[rest], sizes[i])].tolist():
            if root[i] != root[j]:
                root[root == root[j]] = root[i]
                out.append((int(nodes[i]), int(nodes[j])))
    return out


def _across(open_nodes: DataFrame, sets: DataFrame, chunk: int) -> DataFrame:
    """(a, b): links between the pieces of each group; ``open_nodes`` has group, node and piece."""
    sizes = open_nodes.groupBy("group").count().select(
        F.col("group").alias("of"), F.ceil(F.col("count") / chunk).cast("int").alias("chunks")
    )
    mine = F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")
    dealt = (
        open_nodes.join(sizes, F.col("group") == F.col("of"))
        .select("group", "node", "piece", mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("other"))
        .select("group", "node", "piece", F.least("mine", "other").alias("p"), F.greatest("mine", "other").alias("q"))
        .join(sets, "node")
    )
    groups = dealt.groupBy("group", "p", "q").agg(F.collect_list(F.struct("node", "piece", "shingles")).alias("x")).filter("size(x) > 1")

    def make():
        def step(batch):
            found = []
            for rows in batch.column(0):
                node, piece, sets_ = rows.values.flatten()
                parts = [s.values.to_numpy() for s in sets_]
                found += forest(node.to_numpy(), piece.to_numpy(), parts)
            a, b = (list(x) for x in zip(*found)) if found else ([], [])
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

        return step

    return map_arrow(groups.select("x"), make, "a long, b long")


def _members(df: DataFrame, text: str, nodes: DataFrame, chunk: int) -> DataFrame:
    """(node, component) of the nodes that link to another one."""
    pairs = written(pivot_candidates(nodes).unionByName(_candidates(nodes)).distinct(), "near-pairs")
    either = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node"))).distinct()
    wanted = nodes.groupBy("node").agg(F.min("t").alias("t")).join(either, "node")
    sets = written(_sets(df, text, wanted), "near-sets")
    verified = written(_verified(pairs, sets), "near-links")
    linked = components(verified)
    pieces = written(
        components(pairs).withColumnRenamed("component", "group").join(linked, "node", "left")
        .select("group", "node", F.coalesce("component", "node").alias("piece")),
        "near-pieces",
    )
    parted = pieces.groupBy("group").agg(F.min("piece").alias("x"), F.max("piece").alias("y")).filter("x < y").select("group")
    more = written(_across(pieces.join(parted, "group", "left_semi"), sets, chunk), "near-links")
    return linked if more.isEmpty() else components(verified.unionByName(more))


def keep_first(df: DataFrame, key: str = "doc_id", text: str = "text", chunk: int = CHUNK) -> DataFrame:
    """One row of ``df`` of each group: the smallest key (null last), then digest of the text, then one of equal rows."""
    nodes = written(_nodes(df, key, text), "near-nodes")
    rows = nodes.groupBy("node", "k", "t").count()
    first = F.struct(F.col("k").isNull().alias("none"), "k", "t", "count")
    least = rows.groupBy("node").agg(F.min(first).alias("first"))
    member = _members(df, text, nodes, chunk).select(F.col("node").alias("of"), "component")
    of_key, of_text, times = fresh(df, "kept_key"), fresh(df, "kept_digest"), fresh(df, "kept_rows")
    kept = written(
        least.join(member, F.col("node") == F.col("of"), "left").groupBy(F.coalesce("component", "node").alias("root"))
        .agg(F.min("first").alias("first"))
        .select(F.col("first.k").alias(of_key), F.col("first.t").alias(of_text), F.col("first.count").alias(times)),
        "near-kept",
    )
    same = F.col(f"`{key}`").eqNullSafe(F.col(of_key)) & (_digest(text) == F.col(of_text))
    # only rows that repeat are dealt anew
    once = df.join(kept.filter(F.col(times) == 1), same, "left_semi")
    again = df.join(kept.filter(F.col(times) > 1), same).dropDuplicates([of_key, of_text])
    return once.unionByName(again.select(*[F.col(f"`{c}`") for c in df.columns]))
