"""References to records that do not exist, or did not exist yet when they were made."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: References per key above which the key's group is split over several tasks, and most keys that are split.
HOT_ROWS, HOT_KEYS = 200_000, 4096


def orphan_references(parents: DataFrame, children: DataFrame, hot_rows: int = HOT_ROWS, hot_keys: int = HOT_KEYS, counted: DataFrame | None = None) -> DataFrame:
    """References whose target had no live row when the reference was made.

    ``parents``: ``parent_table, parent_key, loaded_at, deleted_at`` (one row per delivery). ``children``: ``parent_table,
    parent_key, ref_table, ref_id, ref_at``. Other columns are ignored. Result: ``ref_table, ref_id, parent_table, parent_key,
    ref_at, reason``, one row for each orphan row of ``children``.

    Both sides are tagged and united in long form and grouped by parent table and key in one shuffle. Inside a group, rows run
    in order of time (a parent delivery before a reference of the same moment), carrying the latest withdrawal among the
    parents seen so far: a reference is sound exactly when that lies after it. A group without any parent flag is ``missing``;
    with parents that all came afterwards ``late``; otherwise ``deleted``.

    A key with more than ``hot_rows`` references is split: its references are spread over salts by ``ref_id`` and its parents
    repeated once per salt. The ``hot_keys`` largest of such keys are split, so their map is bounded; any other key holds at most
    1 / ``hot_keys`` of all references. ``counted`` (``parent_table, parent_key``) is what the keys are counted in, by default
    ``children``: pass the rows before their repetitions were removed if these are cheaper to read.

    Null ``parent_key``: not a reference, left out. Null ``loaded_at``: the parent is known but never arrived (never live).
    Null ``ref_at``: no parent counts as live; ``ref_at`` stays null. Repeated rows: each orphan row is reported.
    Empty inputs give an empty result; with no parents every reference is ``missing``.
    """
    children = children.where(F.col("parent_key").isNotNull()).select("parent_table", "parent_key", "ref_table", "ref_id", "ref_at")
    sizes = (children if counted is None else counted).where(F.col("parent_key").isNotNull()).groupBy("parent_table", "parent_key").count()
    largest = sizes.where(F.col("count") > hot_rows).orderBy(F.desc("count"), "parent_table", "parent_key").limit(hot_keys).collect()
    hot = [(r["parent_table"], r["parent_key"], -(-r["count"] // hot_rows)) for r in largest]

    def salted(df: DataFrame) -> DataFrame:
        if not hot:
            return df.withColumn("salts", F.lit(1))
        split = df.sparkSession.createDataFrame(hot, "parent_table string, parent_key string, salts int")  # at most hot_keys rows
        return df.join(F.broadcast(split), ["parent_table", "parent_key"], "left").withColumn("salts", F.coalesce("salts", F.lit(1)))

    refs = salted(children).select(
        "parent_table", "parent_key", F.pmod(F.xxhash64("ref_table", "ref_id"), F.col("salts").cast("long")).cast("int").alias("salt"),
        F.lit(0).alias("is_parent"), F.col("ref_at").alias("at"), F.lit(None).cast("timestamp").alias("until"), "ref_table", "ref_id",
    )
    # deliveries with one withdrawal day say no more than the first of them
    first = parents.where(F.col("parent_key").isNotNull()).groupBy("parent_table", "parent_key", "deleted_at").agg(F.min("loaded_at").alias("loaded_at"))
    targets = salted(first).select(
        "parent_table", "parent_key", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
        F.lit(1).alias("is_parent"), F.col("loaded_at").alias("at"),
        F.when(F.col("loaded_at").isNotNull(), F.coalesce("deleted_at", F.lit("9999-12-31").cast("timestamp"))).alias("until"),
        F.lit(None).cast("string").alias("ref_table"), F.lit(None).cast("string").alias("ref_id"),
    )
    group = W.partitionBy("parent_table", "parent_key", "salt")
    so_far = group.orderBy(F.col("at").asc_nulls_first(), F.col("is_parent").desc()).rowsBetween(W.unboundedPreceding, W.currentRow)
    seen = targets.unionByName(refs).select(
        "*", F.max("until").over(so_far).alias("live_until"),
        F.max("is_parent").over(group).alias("parents"), F.min(F.when(F.col("is_parent") == 1, F.col("at"))).over(group).alias("arrived"),
    )
    sound = F.coalesce(F.col("live_until") > F.col("at"), F.lit(False))
    reason = F.when(F.col("parents") == 0, "missing").when(F.col("arrived") > F.col("at"), "late").otherwise("deleted")
    return seen.where((F.col("is_parent") == 0) & ~sound).select("ref_table", "ref_id", "parent_table", "parent_key", F.col("at").alias("ref_at"), reason.alias("reason"))


def orphan_report(orphans: DataFrame, period: str = "yyyy-MM") -> DataFrame:
    """Orphan references counted per parent table, referring table, period of the reference and reason. A null time has a null period."""
    return orphans.groupBy("parent_table", "ref_table", F.date_format("ref_at", period).alias("period"), "reason").agg(F.count(F.lit(1)).alias("n_refs"))
