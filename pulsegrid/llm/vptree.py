"""Approximate nearest neighbours with vantage-point trees, one per shard.

Nearness is the largest inner product. Vectors get one more component,
sqrt(M^2 - |x|^2) with M the largest norm, and queries a zero; then the nearest by
Euclidean distance is the one of largest inner product, and trees that need a
metric can be used. A node splits its vectors at the median distance to a vantage
point; a search skips a side when the triangle inequality puts it farther than the
k-th best so far. ``relax`` (1 or more) multiplies that lower bound: factor one is
exact, more prunes more and may miss some.

Equal vectors are one entry of the index with their ``k + 1`` smallest ids, which
is all that the k nearest can show of them. Trees are written, in pieces of some rows, so
a lost executor costs one search. A task gets the pieces of a tree once, or of the few
trees of its bin, and then all queries in Arrow batches; the queries of a batch descend
a tree together.
The scores returned are computed again in double precision on the vectors as given,
one dot product after another, so that equal vectors have equal scores.

Vectors that are null, empty, zero, of another length than most, or hold a null or a
non-finite component take no part, and neither do null ids. Of rows with equal ids
and vectors one counts; equal ids with different vectors are all candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pulsegrid.llm.frames import map_arrow, ship, written

#: Different vectors of a shard, of a leaf and of a written row.
SHARD_ROWS, LEAF_ROWS, PIECE_ROWS = 16_384, 256, 2_048
#: Up to so many bins hold one tree each; then they fill up to that many trees, which a task holds at once.
BINS, BIN_TREES = 64, 8
#: Row groups of the written trees: rows are large, so their size is looked at after each.
GROUPS = {"parquet.block.size": str(16 << 20), "parquet.block.size.row.check.min": "1", "parquet.page.size.row.check.min": "1"}
#: Entries kept beyond k, for scores that rounding puts in another order.
SPARE = 4
#: Recall measured on the given vectors: 1.0 up to a factor of 3, 0.99 at 5.
RELAX = 2.0


class Tree:
    """Vectors in tree order, and for every inner node its vantage point and radius."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF_ROWS, seed: int = 5):
        self.order = np.arange(len(points))
        self.points = points
        #: (start, stop, vantage point, radius, left, right); leaves have no children
        self.nodes: list[tuple] = []
        self._rng = np.random.default_rng(seed)
        self._build(0, len(points), leaf)

    def _build(self, start: int, stop: int, leaf: int) -> int:
        at = len(self.nodes)
        self.nodes.append((start, stop, -1, 0.0, -1, -1))
        if stop - start <= leaf:
            return at
        own = self.order[start:stop]
        vantage = int(self._rng.choice(own))
        d = np.sqrt(np.maximum(((self.points[own] - self.points[vantage]) ** 2).sum(1), 0))
        half = (stop - start) // 2
        split = np.argpartition(d, half)
        radius = float(d[split[half]])
        self.order[start:stop] = own[split]
        left = self._build(start, start + half, leaf)
        right = self._build(start + half, stop, leaf)
        self.nodes[at] = (start, stop, vantage, radius, left, right)
        return at


def search(points: np.ndarray, nodes: np.ndarray, vantage: np.ndarray, q: np.ndarray, k: int, relax: float):
    """(places, distances) of the k nearest for each query; ``points`` in tree order.

    ``nodes`` has (start, stop, left, right, radius), ``vantage`` the point of each node.
    """
    k = min(k, len(points))
    best = np.full((len(q), k), np.inf)
    place = np.full((len(q), k), -1, np.int64)
    norms, q_norms = (points * points).sum(1), (q * q).sum(1)

    def visit(at: int, who: np.ndarray) -> None:
        if not len(who):
            return
        start, stop, left, right = (int(x) for x in nodes[at, :4])
        if left < 0:
            d = norms[None, start:stop] + q_norms[who, None] - 2 * (q[who] @ points[start:stop].T)
            d = np.sqrt(np.maximum(d, 0))
            both = np.concatenate([best[who], d], axis=1)
            where = np.concatenate([place[who], np.broadcast_to(np.arange(start, stop), d.shape)], axis=1)
            take = np.argpartition(both, k - 1, axis=1)[:, :k]
            best[who], place[who] = np.take_along_axis(both, take, 1), np.take_along_axis(where, take, 1)
            return
        radius = nodes[at, 4]
        d = np.sqrt(np.maximum(((q[who] - vantage[at]) ** 2).sum(1), 0))
        inner = d <= radius
        visit(left, who[inner])
        visit(right, who[~inner])
        # what lies on the other side is at least |d - radius| away
        open_ = np.abs(d - radius) * relax <= best[who].max(1) * (1 + 1e-9)
        visit(right, who[inner & open_])
        visit(left, who[~inner & open_])

    visit(0, np.arange(len(q)))
    return place, best


def valid_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id and the vector in doubles, without those that take no part."""
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    cleaned = (
        df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
        .filter(F.col("id").isNotNull() & v.isNotNull())
        .filter((F.size("v") > 0) & finite & F.exists(v, lambda x: x != 0))
        .withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))  # -0.0 is 0.0
    )
    usual = cleaned.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return cleaned.filter(F.size("v") == (usual["n"] if usual else 0))


def build(rows: DataFrame, k: int, shard_rows: int = SHARD_ROWS) -> tuple[DataFrame, int]:
    """The written index, a tree with the different vectors of each shard, in pieces; and the shard count."""
    ranked = rows.withColumn("class", F.xxhash64("v")).distinct().withColumn(
        "rank", F.row_number().over(Window.partitionBy("class", "v").orderBy("id"))
    )
    classes = written(
        ranked.filter(F.col("rank") <= k + 1).groupBy("class", "v").agg(F.sort_array(F.collect_list("id")).alias("ids")),
        "vector-classes",
    )
    size, top = classes.agg(
        F.count("*"), F.max(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    ).first()
    shards = max(1, -(-size // shard_rows))
    dealt = classes.withColumn("shard", F.pmod("class", F.lit(shards)).cast("int"))

    def plant(table: pa.Table) -> pa.Table:
        shard = table.column("shard")[0].as_py()
        v = table.column("v").combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)
        extra = np.sqrt(np.maximum(top - (v * v).sum(1), 0))
        tree = Tree(np.concatenate([v, extra[:, None]], axis=1))
        points, ids = tree.points[tree.order], table.column("ids").combine_chunks().take(pa.array(tree.order))
        nodes = np.array([(s, e, a, b, r) for s, e, _, r, a, b in tree.nodes])
        vantage = np.array([tree.points[max(x[2], 0)] for x in tree.nodes])
        starts = range(0, len(points), PIECE_ROWS)
        n = len(starts)
        return pa.table({
            "shard": pa.array([shard] * n, pa.int32()),
            "piece": pa.array(range(n), pa.int32()),
            "points": pa.array([points[a:a + PIECE_ROWS].tobytes() for a in starts], pa.binary()),
            # of the whole tree, with its first piece
            "nodes": pa.array([nodes.tobytes()] + [b""] * (n - 1), pa.binary()),
            "vantage": pa.array([vantage.tobytes()] + [b""] * (n - 1), pa.binary()),
            "ids": pa.array([ids[a:a + PIECE_ROWS].to_pylist() for a in starts], pa.list_(pa.list_(pa.int64()))),
        })

    ship(rows.sparkSession)
    trees = dealt.groupBy("shard").applyInArrow(
        plant, "shard int, piece int, points binary, nodes binary, vantage binary, ids array<array<long>>"
    )
    return written(trees, "vector-trees", **GROUPS), shards


class Planted:
    """A tree of the index, put together from its pieces."""

    def __init__(self, shard: int):
        self.shard, self.pieces = shard, []
        self.points = None

    def add(self, row: dict[str, pa.Scalar]) -> None:
        ids = row["ids"].values
        if not self.pieces:
            self.nodes = np.frombuffer(row["nodes"].as_buffer()).reshape(-1, 5).copy()
            self.vantage = np.frombuffer(row["vantage"].as_buffer()).reshape(len(self.nodes), -1).copy()
        points = np.frombuffer(row["points"].as_buffer()).reshape(-1, self.vantage.shape[1])
        # copies: the batch they come with goes
        self.pieces.append((points.copy(), ids.value_lengths().to_numpy().copy(), ids.flatten().to_numpy().copy()))

    def grown(self) -> Planted:
        if self.points is None:
            points, sizes, ids = zip(*self.pieces)
            self.points, self.ids = np.concatenate(points), np.concatenate(ids)
            self.ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            self.pieces = [()]
        return self

    def best(self, names: list[int], q: np.ndarray, k: int, relax: float) -> list[list[tuple[float, int]]]:
        """For each query (-score, id) of its k nearest, best first."""
        place, _ = search(self.points, self.nodes, self.vantage, np.pad(q, ((0, 0), (0, 1))), k + 1 + SPARE, relax)
        near = self.points[place]
        score = np.zeros(place.shape)
        for c in range(q.shape[1]):  # the same order of additions for every vector
            score += near[:, :, c] * q[:, c, None]
        out = []
        for name, at, found in zip(names, place.tolist(), score.tolist()):
            own = [(-s, x) for p, s in zip(at, found) if p >= 0 for x in self.ids[self.ends[p]:self.ends[p + 1]].tolist() if x != name]
            out.append(sorted(own)[:k])
        return out


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 20, relax: float = RELAX, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest rows (not the query's own id), for (id, v) tables."""
    index, shards = build(rows, k, shard_rows)
    held = min(BIN_TREES, -(-shards // BINS))  # trees of a bin
    bins = -(-shards // held)
    bin_of = F.pmod(F.col("shard"), F.lit(bins))
    # the stated queries meet every shard
    asked = queries.select("id", "v").distinct().withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    met = (
        index.withColumn("bin", bin_of).unionByName(asked, allowMissingColumns=True)
        .repartitionById(bins, "bin").sortWithinPartitions("bin", F.col("shard").asc_nulls_last(), "piece")
        .select("bin", "shard", "points", "nodes", "vantage", "ids", "id", "v")
    )

    def make():
        bin_, trees = None, []

        def step(batch):
            nonlocal bin_
            out_q, out_id, out_s = [], [], []
            which, shard = batch.column(0).to_numpy(), batch.column(1).to_pylist()
            query = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            at = 0
            while at < batch.num_rows:
                if which[at] != bin_:
                    bin_ = which[at]
                    trees.clear()
                if not query[at]:
                    if not trees or trees[-1].shard != shard[at]:
                        trees.append(Planted(shard[at]))
                    trees[-1].add({c: batch.column(c)[at] for c in ("points", "nodes", "vantage", "ids")})
                    at += 1
                    continue
                stop = at + 1
                while stop < batch.num_rows and which[stop] == bin_:
                    stop += 1
                names = batch.column(6)[at:stop].to_pylist()
                own = batch.column(7)[at:stop].flatten().to_numpy().reshape(len(names), -1)
                for name, *best in zip(names, *(tree.grown().best(names, own, k, relax) for tree in trees)):
                    kept = sorted(set().union(*best))[:k]
                    out_q += [name] * len(kept)
                    out_id += [x for _, x in kept]
                    out_s += [-s for s, _ in kept]
                at = stop
            return pa.RecordBatch.from_arrays(
                [pa.array(out_q, pa.int64()), pa.array(out_id, pa.int64()), pa.array(out_s, pa.float64())],
                ["query_id", "vec_id", "score"],
            )

        return step

    found = map_arrow(met, make, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
