"""Exact interpolated quantiles without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.session import materialize

#: Accuracy of the bracketing sketch.
ACCURACY = 10000


#: Different values of a key that are put in order together at the end, and parts of a further round.
HELD, PARTS = 10_000, 256


def exact_quantile(
    df: DataFrame, keys: list[str], value: str, q: float, slack: float = 3.0 / ACCURACY, held: int = HELD
) -> DataFrame:
    """Inclusive (interpolated) quantile per key: keys, ``quantile``.

    A sketch brackets the wanted ranks ``slack`` wide. How many values lie below and
    within the bracket is then counted, and a bracket that misses the wanted ranks is
    replaced by the key's whole range, so the answer never rests on the sketch.
    Of a large key about one row in 1500 is in the bracket. As long as a key has more than ``held``
    different values there, rounds of counting cut the bracket into ``PARTS`` and keep the parts that
    hold the wanted ranks; nothing is put in order but the last few values of a key.
    ``keys`` must not be empty.
    """
    rows = df.select(*keys, F.col(value).cast("double").alias("v")).filter(F.col("v").isNotNull())
    ends = F.percentile_approx(
        "v", F.array(F.lit(max(0.0, q - slack)), F.lit(min(1.0, q + slack))), F.lit(ACCURACY)
    )
    guess = (
        rows.groupBy(*keys)
        .agg(ends.alias("e"), F.count(F.lit(1)).alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .select(
            *keys, "low", "high",
            ((F.col("n") - 1) * F.lit(float(q))).alias("rank"),
            F.col("e")[0].alias("lo"), F.col("e")[1].alias("hi"),
        )
    )

    def same(a: str, b: str):
        on = F.lit(True)
        for key in keys:
            on &= F.col(f"{a}.{key}").eqNullSafe(F.col(f"{b}.{key}"))
        return on

    met = (
        rows.alias("r").join(guess.alias("g"), same("r", "g"))
        .groupBy(*[F.col(f"g.{k}").alias(k) for k in keys], "rank", "lo", "hi", "low", "high")
        .agg(F.count_if(F.col("v") < F.col("lo")).alias("below"), F.count_if(F.col("v") <= F.col("hi")).alias("upto"))
    )
    bracket = met.select(
        *keys, "rank",
        F.when(F.col("below") <= F.floor("rank"), F.col("lo")).otherwise(F.col("low")).alias("lo"),
        F.when(F.col("upto") > F.ceil("rank"), F.col("hi")).otherwise(F.col("high")).alias("hi"),
    )
    inside = rows.alias("r").join(bracket.alias("b"), same("r", "b")).filter(F.col("v") <= F.col("hi"))
    own = [F.col(f"r.{k}").alias(k) for k in keys]
    # values below the bracket are one row with a null value
    counted = inside.groupBy(*own, "rank", F.when(F.col("v") >= F.col("lo"), F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("c"))
    counted = _narrowed(counted, keys, held)
    ordered = F.array_sort(F.collect_list(F.struct("v", "c")))
    low, high = (r.cast("long") for r in (F.floor("rank"), F.ceil("rank")))

    def at(rank: Column) -> Column:
        """The value at a rank: counts add up from the smallest value on."""
        start = F.struct(F.coalesce("below", F.lit(0)).cast("long").alias("upto"), F.lit(None).cast("double").alias("v"))
        found = F.aggregate("values", start, lambda s, x: F.struct(
            (s["upto"] + x["c"]).alias("upto"),
            F.when(s["v"].isNull() & (s["upto"] + x["c"] > rank), x["v"]).otherwise(s["v"]).alias("v")))
        return found["v"]

    sorted_ = counted.groupBy(*keys, "rank").agg(
        F.sum(F.when(F.col("v").isNull(), F.col("c"))).alias("below"), F.filter(ordered, lambda x: x["v"].isNotNull()).alias("values")
    ).select(*keys, "rank", at(low).alias("a"), at(high).alias("b"))
    return sorted_.select(*keys, (F.col("a") + (F.col("b") - F.col("a")) * (F.col("rank") - F.floor("rank"))).alias("quantile"))


def _narrowed(counted: DataFrame, keys: list[str], held: int) -> DataFrame:
    """(keys, rank, v, c) with at most ``held`` different values of a key; what is left out below them stays in the null row.

    One action a round sees how many values the largest key still has; each round leaves about
    2 / ``PARTS`` of them. A key with few values keeps them all.
    """
    group = [*keys, "rank"]
    while True:
        counted = materialize(counted, "quantile-values")
        most = counted.groupBy(*group).count().agg(F.max("count")).first()[0] or 0
        if most <= held + 1:
            return counted
        edges = F.percentile_approx("v", F.array(*[F.lit(i / PARTS) for i in range(1, PARTS)]), F.lit(ACCURACY))
        cuts = counted.groupBy(*group).agg(edges.alias("edges")).select(*[F.col(c).alias(f"_{c}") for c in group], "edges")
        same = F.lit(True)
        for c in group:
            same &= F.col(c).eqNullSafe(F.col(f"_{c}"))
        part = F.when(F.col("v").isNull(), -1).otherwise(F.size(F.filter("edges", lambda e: e < F.col("v"))))
        dealt = counted.join(cuts, same).select(*group, "v", "c", part.alias("part"))
        parts = dealt.groupBy(*group, "part").agg(F.sum("c").alias("n"))
        # PARTS rows of a key at most
        upto = F.sum("n").over(Window.partitionBy(*group).orderBy("part"))
        wanted = parts.withColumn("upto", upto).withColumn("gone", F.col("upto") <= F.floor("rank")).filter(
            F.col("gone") | (F.col("upto") - F.col("n") <= F.ceil("rank"))
        ).select(*[F.col(c).alias(f"_{c}") for c in group], F.col("part").alias("_part"), "gone")
        left = dealt.join(wanted, same & (F.col("part") == F.col("_part")))
        counted = left.groupBy(*group, F.when(~F.col("gone"), F.col("v")).alias("v")).agg(F.sum("c").alias("c"))
