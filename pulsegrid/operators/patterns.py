"""Value combinations that mark a failure spike, and dominant combinations.

A pattern fixes some columns and leaves the others open. A value that is rare in
its column cannot be part of a supported pattern, so rare values are set aside
before anything is combined: at most ``2 / min_support`` values per column are
left, and the cube runs over the few combinations of those, not over rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from pulsegrid.session import materialize


def _supported(df: DataFrame, spike: Column, cols: list[str], min_support: float) -> DataFrame:
    """Patterns whose share reaches ``min_support`` on either side.

    Columns: ``codes`` (per column 0 where open, else the number of its value), ``gid``, counts and
    shares ``a``/``b``, ``pattern`` as text, ``fixed_columns``. The pattern with all columns
    open is included. The source is read once; its combinations of values are written
    and everything else reads those. Values are numbered per column, null has
    a number of its own; text comes back at the end.
    """
    k = len(cols)
    slots = [f"v{i}" for i in range(k)]
    value = lambda c: F.struct(F.col(c).isNull().alias("none"), F.col(c).cast("string").alias("text"))
    combined = materialize(
        df.select(spike.cast("int").alias("a"), (~spike).cast("int").alias("b"), *[value(c).alias(v) for c, v in zip(cols, slots)])
        .groupBy(*slots).agg(F.sum("a").alias("a"), F.sum("b").alias("b")),
        "pattern-values",
    )
    # every row has one value in each column, so the counts of a column add up to the totals
    counts = (
        combined.select("a", "b", F.posexplode(F.array(*slots)).alias("place", "value"))
        .groupBy("place", "value").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    )
    of_column = Window.partitionBy("place")
    share = lambda n, t: F.coalesce(F.try_divide(n.cast("double"), t), F.lit(0.0))
    total = lambda c: F.sum(c).over(of_column)
    frequent = counts.withColumns({"ta": total("a"), "tb": total("b")}).filter(
        (share(F.col("a"), F.col("ta")) >= min_support) | (share(F.col("b"), F.col("tb")) >= min_support)
    )
    known = frequent.orderBy("place", "value").collect()  # at most 2k / min_support values
    texts: list[list[str]] = [[] for _ in cols]
    codes: list[list[tuple]] = [[] for _ in cols]
    for r in known:
        codes[r.place].append((r.value.none, r.value.text))
        texts[r.place].append(f"{cols[r.place]}={'(null)' if r.value.none else r.value.text}")
    ta, tb = (known[0].ta, known[0].tb) if known else (0, 0)

    def code(slot: str, values: list[tuple]) -> Column:
        """1, 2, ... of a frequent value, 0 of the others."""
        found = F.lit(0)
        for number, (none, text) in enumerate(values, 1):
            is_it = F.col(slot)["none"] if none else F.col(slot)["text"].eqNullSafe(F.lit(text))
            found = F.when(is_it, number).otherwise(found)
        return found.alias(slot)

    cubed = (
        combined.select("a", "b", *[code(v, values) for v, values in zip(slots, codes)])
        .groupBy(*slots).agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
        .cube(*slots).agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.grouping_id().cast("long").alias("gid"))
    )
    is_fixed = [F.col("gid").bitwiseAND(F.lit(1 << (k - 1 - i))) == 0 for i in range(k)]
    no_rare = F.lit(True)
    for fixed, v in zip(is_fixed, slots):
        no_rare &= ~fixed | (F.col(v) > 0)
    names = [F.when(fixed, F.get(F.array(*[F.lit(t) for t in ts] or [F.lit("")]), F.col(v) - 1)) for fixed, v, ts in zip(is_fixed, slots, texts)]
    shares = cubed.filter(no_rare).withColumns({"share_a": share(F.col("a"), F.lit(ta)), "share_b": share(F.col("b"), F.lit(tb))})
    return materialize(
        shares.filter((F.col("share_a") >= min_support) | (F.col("share_b") >= min_support)).select(
            "gid", "a", "b", "share_a", "share_b", F.array(*[F.when(f, F.col(v)).otherwise(0) for f, v in zip(is_fixed, slots)]).alias("codes"),
            F.concat_ws(" & ", *names).alias("pattern"), (F.lit(k) - F.bit_count("gid")).cast("int").alias("fixed_columns"),
        ),
        "pattern-supported",
    )


def diff_patterns(df: DataFrame, spike: Column, cols: list[str], min_support: float = 0.05) -> DataFrame:
    """Patterns whose share differs between spike rows and the other rows.

    Kept when either share reaches ``min_support`` and no pattern with one fixed
    column less has the same two counts. Ranked by size of the difference.
    """
    supported = _supported(df, spike, cols, min_support)
    opened = lambda i: F.array(*[F.lit(0) if j == i else F.col("codes")[j] for j in range(len(cols))])
    parents = F.array(*[F.when(F.col("codes")[i] > 0, opened(i)) for i in range(len(cols))])
    same_as_parent = (
        supported.select("codes", "a", "b", F.explode(parents).alias("up"))
        .join(supported.select(F.col("codes").alias("up"), F.col("a").alias("pa"), F.col("b").alias("pb")), "up")
        .filter((F.col("a") == F.col("pa")) & (F.col("b") == F.col("pb")))
        .select("codes")
    )
    return (
        supported.filter("fixed_columns > 0")
        .join(same_as_parent, "codes", "left_anti")
        .select(
            "pattern",
            "fixed_columns",
            F.col("a").alias("spike_count"),
            F.col("b").alias("baseline_count"),
            F.round(F.col("share_a") * 100.0, 2).alias("spike_pct"),
            F.round(F.col("share_b") * 100.0, 2).alias("baseline_pct"),
            F.round((F.col("share_a") - F.col("share_b")) * 100.0, 2).alias("difference_pct"),
        )
        .orderBy(F.abs("difference_pct").desc(), F.col("fixed_columns").desc(), "pattern")
    )


def auto_cluster(df: DataFrame, cols: list[str], weight: float = 0.6, min_support: float = 0.05) -> DataFrame:
    """Dominant patterns of one set.

    score = coverage^weight * specificity^(1 - weight). Of two patterns where one
    contains the other only the better stays; equal scores favour the more
    specific one.
    """
    k = len(cols)
    specificity = F.col("fixed_columns") / F.lit(float(k))
    supported = (
        _supported(df, F.lit(True), cols, min_support)
        .filter("fixed_columns > 0")
        .withColumn(
            "score",
            F.round(F.pow("share_a", F.lit(weight)) * F.pow(specificity, F.lit(1.0 - weight)), 6),
        )
    )
    # every pattern that contains this one: open further columns, mask by mask
    masks = F.explode(F.sequence(F.lit(0), F.lit((1 << k) - 2))).alias("mask")
    opened = F.array(*[
        F.when(F.col("mask").bitwiseAND(F.lit(1 << (k - 1 - i))) == 0, F.col("codes")[i]).otherwise(0) for i in range(k)
    ])
    pairs = (
        supported.select("codes", "gid", "score", masks)
        .filter((F.col("mask").bitwiseAND(F.col("gid")) == F.col("gid")) & (F.col("mask") != F.col("gid")))
        .select("codes", "score", opened.alias("wider"))
        .join(supported.select(F.col("codes").alias("wider"), F.col("score").alias("wider_score")), "wider")
    )
    wider_wins = F.col("wider_score") > F.col("score")
    losers = pairs.select(F.when(wider_wins, F.col("codes")).otherwise(F.col("wider")).alias("codes"))
    return (
        supported.join(losers, "codes", "left_anti")
        .select(
            "pattern",
            "fixed_columns",
            F.col("a").alias("rows"),
            F.round(F.col("share_a") * 100.0, 2).alias("coverage_pct"),
            "score",
        )
        .orderBy(F.col("score").desc(), "pattern")
    )


def signature_clusters(df: DataFrame, message: str) -> DataFrame:
    """Messages grouped by their text without literals."""
    from pulsegrid.functions.text import fingerprint, normalize_statement

    text = F.col(message)
    return (
        df.filter(text.isNotNull())
        .groupBy(fingerprint(text).alias("signature_id"), normalize_statement(text).alias("signature"))
        .agg(F.count(F.lit(1)).alias("failures"), F.min(message).alias("example"))
    )
