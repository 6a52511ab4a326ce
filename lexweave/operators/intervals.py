"""Continuous periods and gaps from overlapping validity intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

#: Rows above which an entity is cut into time shards; most entities that are; most shards of one.
HOT_ROWS, HOT_ENTITIES, SHARDS = 200_000, 1024, 128


def _islands(part: DataFrame, by: list[str], extra: list, aggs: list) -> DataFrame:
    """Rows ``_a, _b, _n`` joined where they overlap or touch, within the groups ``by``."""
    order = W.partitionBy(*by).orderBy("_a", "_b")
    reach = F.max("_b").over(order.rowsBetween(W.unboundedPreceding, -1))
    part = part.select("*", reach.alias("_reach"), *(e(order) for e in extra))
    part = part.withColumn("_new", (F.col("_reach").isNull() | (F.col("_a").cast("long") > F.col("_reach").cast("long") + 1)).cast("int"))
    part = part.withColumn("_island", F.sum("_new").over(order.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return part.groupBy(*by, "_island").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"), F.sum("_n").alias("_n"), *(a() for a in aggs))


def _gap(a: Column, b: Column) -> Column:
    return F.struct(a.cast("int").alias("a"), b.cast("int").alias("b"))


def _in_shards(rows: DataFrame, names: list[str], borders: DataFrame) -> DataFrame:
    """Stretches and gaps (``_a, _b, _n, _gaps``) of the entities in ``borders`` (the names and ``_borders``, ascending first days of all
    shards but the first)."""
    cut, k = F.broadcast(borders), F.col("_shard")
    same = lambda df: [df[f"{n}"].eqNullSafe(cut[f"{n}"]) for n in names]
    with_borders = lambda df: df.join(cut, same(df), "inner").select(*(df[c] for c in df.columns), "_borders")
    shard_of = lambda day: F.size(F.filter("_borders", lambda b: b <= day))
    first_day = lambda n: F.when(n <= 0, F.lit(-(2**31))).otherwise(F.try_element_at("_borders", F.greatest(n, F.lit(1)))).cast("int")
    last_day = lambda n: F.when(n >= F.size("_borders"), F.lit(2**31 - 2)).otherwise(F.try_element_at("_borders", n + 1) - 1).cast("int")
    lo, hi, p, q, none = F.col("_s"), F.col("_e"), F.col("_p"), F.col("_q"), F.lit(None).cast("int")
    piece = lambda a, b, start, stop, tag: F.struct(a.alias("_from"), b.alias("_to"), start.alias("_a"), stop.alias("_b"), tag.alias("_tag"))
    parts = F.array(
        piece(p, p, lo, F.least(hi, last_day(p)), hi), F.when(q > p, piece(q, q, first_day(q), hi, none)), F.when(q > p + 1, piece(p + 1, q - 1, none, none, none))
    )
    # an interval makes three pieces at most: where it starts, where it ends, and all whole shards between; equal ones collapse here
    at = with_borders(rows).withColumns({"_p": shard_of(lo), "_q": shard_of(hi)})
    pieces = at.select(*names, F.explode(F.array_compact(parts)).alias("_x")).select(*names, "_x.*").distinct()
    clipped = (
        with_borders(pieces).withColumn("_shard", F.explode(F.sequence("_from", "_to")))
        .select(*names, k, F.coalesce("_a", first_day(k)).alias("_a"), F.coalesce("_b", last_day(k)).alias("_b"), F.col("_tag").isNotNull().cast("int").alias("_n"))
    )
    local = _islands(clipped, [*names, "_shard"], [], [])
    order = W.partitionBy(*names, "_shard").orderBy("_a")
    follows, before = F.lead("_a").over(order), F.lag("_b").over(order)
    local = local.select(
        *names, "_shard", "_a", "_b", "_n",
        F.when(follows.isNotNull(), _gap(F.col("_b") + 1, follows - 1)).alias("_gap"),
        F.when(follows.isNotNull() & before.isNotNull(), k).otherwise(-1).alias("_level"),
    )
    new_gap = lambda: F.when((F.col("_new") == 1) & (F.col("_before") != k), _gap(F.col("_reach") + 1, F.col("_a") - 1))
    return _islands(
        local, [*names, "_level"], [lambda o: F.lag("_shard").over(o).alias("_before")],
        [lambda: F.array_compact(F.flatten(F.collect_list(F.array(F.col("_gap"), new_gap())))).alias("_gaps")],
    ).select(*names, "_a", "_b", "_n", "_gaps")


def merge_intervals(
    df: DataFrame, entity: list[str], start: str, end: str, hot_rows: int = HOT_ROWS, hot_entities: int = HOT_ENTITIES, shards: int = SHARDS
) -> DataFrame:
    """Joined stretches of each entity's intervals, and the gaps between neighbouring stretches.

    ``start`` and ``end`` are integer days, both inclusive. Intervals that overlap or follow each other without a free day join.
    Result: the entity columns, ``kind`` (``stretch`` or ``gap``), ``start_day``, ``end_day``, ``n_intervals`` (distinct
    intervals in a stretch; null for gaps).

    Entities of up to ``hot_rows`` rows are merged in one step, in one shuffle. Larger ones are merged in two levels, so that an
    entity of any size is worked by many tasks: its time is cut into up to ``shards`` shards at quantiles of its own start days, so
    a shard holds about as many intervals as the others, however narrow the span. Intervals are clipped into the shards (equal
    pieces collapse before they are shuffled) and merged within; then only the first and last stretch of each shard meet to be
    stitched across shard borders. Stretches between these can touch no border and pass as they are. An interval counts once,
    in the shard where it starts. The ``hot_entities`` largest are cut, so the borders the tasks hold are bounded; any other
    entity has at most 1 / ``hot_entities`` of all rows.

    Null start or end, or end before start: left out. Null entity values form their own group. Equal intervals count once.
    """
    names = [f"_k{i}" for i in range(len(entity))]
    keys = [F.col(c).alias(n) for c, n in zip(entity, names, strict=True)]
    rows = df.select(*keys, F.col(start).cast("int").alias("_s"), F.col(end).cast("int").alias("_e")).where(F.col("_s") <= F.col("_e"))
    sizes = rows.groupBy(*names).agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") > hot_rows)
    largest = sizes.orderBy(F.desc("_rows"), *names).limit(hot_entities).collect()
    parts = []
    if largest:
        hot = df.sparkSession.createDataFrame([tuple(r) for r in largest], sizes.schema)  # at most hot_entities rows
        same = [rows[n].eqNullSafe(hot[n]) for n in names]
        theirs = rows.join(F.broadcast(hot), same, "left_semi")
        steps = [i / shards for i in range(1, shards)]
        borders = theirs.groupBy(*names).agg(F.array_distinct(F.percentile_approx("_s", steps, 10 * shards)).alias("_borders")).collect()
        named = df.sparkSession.createDataFrame([tuple(r) for r in borders], theirs.select(*names).schema.add("_borders", ArrayType(IntegerType())))
        parts.append(_in_shards(theirs, names, named))
        rows = rows.join(F.broadcast(hot), same, "left_anti")
    # a partitioning by entity serves all that follows
    each = rows.repartition(*names).select(*names, F.col("_s").alias("_a"), F.col("_e").alias("_b")).distinct().withColumn("_n", F.lit(1))
    order = W.partitionBy(*names).orderBy("_a")
    whole = _islands(each, names, [], []).withColumn("_next", F.lead("_a").over(order))
    gaps = F.when(F.col("_next").isNotNull(), F.array(_gap(F.col("_b") + 1, F.col("_next") - 1))).otherwise(F.array().cast("array<struct<a:int,b:int>>"))
    parts.append(whole.select(*names, "_a", "_b", "_n", gaps.alias("_gaps")))
    out = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    stretch = F.array(F.struct(F.lit("stretch").alias("kind"), F.col("_a").alias("a"), F.col("_b").alias("b"), F.col("_n").cast("long").alias("n")))
    free = F.transform("_gaps", lambda g: F.struct(F.lit("gap").alias("kind"), g["a"].alias("a"), g["b"].alias("b"), F.lit(None).cast("long").alias("n")))
    back = [F.col(n).alias(c) for c, n in zip(entity, names, strict=True)]
    return out.select(*back, F.inline(F.concat(stretch, free)).alias("kind", "start_day", "end_day", "n_intervals"))
