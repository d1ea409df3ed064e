"""Keyed upserts, version history, retention and governance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from pulsegrid.config import DEFAULTS, Settings
from pulsegrid.operators.dedup import latest_wins
from pulsegrid.operators.timeline import DENSE, state_runs, timed, with_previous


def tagged_union(parts: dict[str, DataFrame], label: str) -> DataFrame:
    """All parts with a column naming the part a row came from."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(label, F.lit(name))
        out = tagged if out is None else union_by_name(out, tagged)
    return out


def union_by_name(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.unionByName(b, allowMissingColumns=True)


def upsert_by_key(current: DataFrame, changes: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Both row sets folded to the newest row per key."""
    return latest_wins(union_by_name(current, changes), keys, order)


#: Parts of the index of an upserted table; a change reads and writes only the parts of its keys.
INDEX_PARTS = 64


def upsert_table(
    spark: SparkSession, path: str, changes: DataFrame, keys: list[str], order: list[Column],
    partition: str = "partition_date",
) -> None:
    """Upsert into a partitioned table, rewriting only the partitions that change; a key may move to another one.

    An index beside the table (``<path>__index``: keys and the partition of their row, in
    ``INDEX_PARTS`` parts by the hash of the keys) says where the changed keys are stored
    now, so their old rows are found without a look at the other partitions. The merged rows go to
    a staging folder first, because a plan must not overwrite what it reads. Then the
    partitions are replaced, those left empty are removed, and the index follows last: a
    job that failed anywhere in between is run again with the same changes. Only the touched
    partitions and index parts reach the driver.
    """
    from pulsegrid.session import materialize
    from pulsegrid.sources.storage import drop_partitions, read_table, write_partitions

    changes = materialize(latest_wins(changes, keys, order), "upsert-changes")
    part = F.pmod(F.xxhash64(*keys), F.lit(INDEX_PARTS)).cast("int").alias("part")
    placed = lambda df: df.select(*keys, F.col(partition).alias("at"), part)
    current, index_path = read_table(spark, path), f"{path}__index"
    if current is None:
        write_partitions(changes, path, [partition])
        write_partitions(placed(changes), index_path, ["part"])
        return
    index = read_table(spark, index_path)
    if index is None:  # a table from before it had an index
        write_partitions(placed(current), index_path, ["part"])
        index = read_table(spark, index_path)
    parts = [r[0] for r in changes.select(part).distinct().collect()]
    index = index.filter(F.col("part").isin(parts))
    mine = changes.select(*[F.col(k).alias(f"_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"_{k}"))
    stored_at = index.join(mine, same, "left_semi").select(F.col("at").alias(partition))
    touched = [r[0] for r in changes.select(partition).union(stored_at).distinct().collect()]
    inside = F.col(partition).isin([t for t in touched if t is not None]) | (F.col(partition).isNull() & F.lit(None in touched))
    staged = materialize(upsert_by_key(current.filter(inside), changes, keys, order), "upsert-merged", [partition])
    moved_to = staged.join(mine, same, "left_semi")
    fresh = materialize(index.join(mine, same, "left_anti").unionByName(placed(moved_to)), "upsert-index", ["part"])
    left = {r[0] for r in staged.select(partition).distinct().collect()}
    write_partitions(staged, path, [partition])
    drop_partitions(spark, path, [partition], [(t,) for t in touched if t not in left])
    write_partitions(fresh, index_path, ["part"])


def scd2_history(
    snapshots: DataFrame, key: str, time: str, tie: list[str], attributes: list[str]
) -> DataFrame:
    """Versions of ``attributes`` per key: valid_from, valid_to, is_current."""
    polls = timed(snapshots, [key], time, tie, attributes).select(
        key, "sec", "ord", F.struct(*attributes).alias("version_row")
    )
    runs = state_runs(polls, [key], "version_row", DENSE, "ord").select(
        key, "version_row", "run_start", "ord", F.unix_timestamp("run_start").alias("sec")
    )
    chained = with_previous(runs, [key], [], order="ord", following=True)
    return chained.select(
        key,
        *[F.col(f"version_row.{a}").alias(a) for a in attributes],
        F.col("run_start").alias("valid_from"),
        F.timestamp_seconds("prev_sec").alias("valid_to"),
        F.col("prev_sec").isNull().alias("is_current"),
    )


def scd2_merge(history: DataFrame, snapshot: DataFrame, key: str, attributes: list[str]) -> DataFrame:
    """Apply one newer snapshot (key, attributes, seen_at) to a history.

    A changed key closes its current version and opens one; an unchanged key
    keeps it; a new key opens one; a key missing from the snapshot stays open.
    """
    closed = history.filter("NOT is_current")
    current = history.filter("is_current")
    joined = current.alias("h").join(snapshot.alias("s"), key, "full_outer")
    same = F.lit(True)
    for a in attributes:
        same &= F.col(f"h.{a}").eqNullSafe(F.col(f"s.{a}"))
    known, seen = F.col("h.valid_from").isNotNull(), F.col("s.seen_at").isNotNull()
    changed = known & seen & ~same
    kept = joined.filter(known).select(
        key,
        *[F.col(f"h.{a}").alias(a) for a in attributes],
        F.col("h.valid_from"),
        F.when(changed, F.col("s.seen_at")).alias("valid_to"),
        (~changed).alias("is_current"),
    )
    opened = joined.filter(seen & (~known | ~same)).select(
        key,
        *[F.col(f"s.{a}").alias(a) for a in attributes],
        F.col("s.seen_at").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
    )
    columns = [key, *attributes, "valid_from", "valid_to", "is_current"]
    return closed.select(*columns).unionByName(kept.select(*columns)).unionByName(opened.select(*columns))


def current_dimension(snapshots: DataFrame) -> DataFrame:
    """Newest row per node as the open version."""
    from pulsegrid.operators.rollups import newest_of

    return newest_of(snapshots, ["node_id"], "collected_at", ["record_id"]).select(
        "node_id",
        "cluster_id",
        "cluster_name",
        "node_name",
        "version",
        F.col("status").alias("status_current"),
        "datasource_count",
        F.col("collected_at").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(True).alias("is_current"),
        F.to_date("collected_at").alias("partition_date"),
    )


def dimension_history(snapshots: DataFrame) -> DataFrame:
    """All versions of each node, in the columns of ``current_dimension``."""
    attributes = ["cluster_id", "cluster_name", "node_name", "version", "status", "datasource_count"]
    versions = scd2_history(snapshots, "node_id", "collected_at", ["record_id"], attributes)
    return versions.withColumnRenamed("status", "status_current").withColumn(
        "partition_date", F.to_date("valid_from")
    )


def retained(df: DataFrame, layer: str, as_of: Column, cfg: Settings = DEFAULTS, partition: str = "partition_date") -> DataFrame:
    """Rows young enough for their layer; the filter is on the partition column."""
    days = {
        "bronze": cfg.bronze_days, "silver": cfg.silver_days, "gold": cfg.gold_days,
        "identity": cfg.identity_days,
    }[layer]
    return df.filter(F.col(partition) >= F.date_sub(F.to_date(as_of), days))


def pseudonymize(df: DataFrame, columns: list[str], salt: str) -> DataFrame:
    """Keyed hash in place of identities; null stays null."""
    return df.withColumns(
        {c: F.sha2(F.concat(F.lit(salt), F.col(c).cast("string")), 256) for c in columns}
    )


def drop_expired(
    spark: SparkSession, path: str, layer: str, as_of: Column, cfg: Settings = DEFAULTS, partition: str = "partition_date"
) -> list:
    """Remove the partitions of a stored table that ``retained`` would leave out; returns their days.

    Whole folders go and no file is rewritten, so a run that was cut off just leaves days for the next one.
    """
    from pulsegrid.sources.storage import drop_partitions, read_table

    stored = read_table(spark, path)
    if stored is None:
        return []
    # days of the table only: one value per folder
    days = stored.select(partition).distinct()
    old = days.join(retained(days, layer, as_of, cfg, partition), partition, "left_anti").dropna()
    expired = sorted(r[0] for r in old.collect())
    drop_partitions(spark, path, [partition], [(day,) for day in expired])
    return expired


def purge_table(
    spark: SparkSession, path: str, subjects: DataFrame, column: str, partition: str = "partition_date"
) -> list:
    """Remove all rows of the given subjects from a stored table; returns the partitions that were rewritten.

    Only partitions that hold such a row are rewritten, others keep their files. The rows that stay are
    written to a staging folder first. Every partition is replaced as a whole, so a run that was cut off
    leaves each of them as it was or purged, and is run again.
    """
    from pulsegrid.session import materialize
    from pulsegrid.sources.storage import BATCH, drop_partitions, read_table, write_partitions

    stored = read_table(spark, path)
    if stored is None:
        return []
    subjects = materialize(subjects.select(column).dropna().distinct(), "purge-subjects")
    # bronze tables have the batch as a second level of folders
    levels = [c for c in (partition, BATCH) if c in stored.columns]
    folders = lambda df: {tuple(r) for r in df.select(*levels).distinct().collect()}
    hit = folders(stored.join(subjects, column, "left_semi"))
    if not hit:
        return []
    inside = F.lit(False)
    for values in hit:
        here = F.lit(True)
        for level, value in zip(levels, values):
            here &= F.col(level).eqNullSafe(F.lit(value))
        inside |= here
    staged = materialize(purge_subject(stored.filter(inside), subjects, column), "purge-kept", levels)
    left = folders(staged)
    write_partitions(staged, path, levels)
    drop_partitions(spark, path, levels, sorted(hit - left, key=str))
    return sorted({values[0] for values in hit}, key=str)


def row_scope(df: DataFrame, entitlements: DataFrame, viewer: str, key: str) -> DataFrame:
    """Rows whose ``key`` the viewer may see."""
    allowed = entitlements.filter(F.col("viewer") == viewer).select(key).distinct()
    return df.join(allowed, key, "left_semi")


def purge_subject(df: DataFrame, subjects: DataFrame, column: str) -> DataFrame:
    """Rows without those of the given subjects."""
    return df.join(subjects.select(column).distinct(), column, "left_anti")
