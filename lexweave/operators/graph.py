"""Property-graph operators on a node table and an edge table.

Nodes: ``id, label`` and properties. Edges: ``src, dst, type`` and optionally ``weight``. All results are DataFrames.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage


def upsert_nodes(df: DataFrame, key: str, version: list[str]) -> DataFrame:
    """One row per key, the one with the greatest version columns (nulls least): the last write wins, as a whole row. Null keys are
    dropped. One aggregation with map-side combine, so a key with many versions is no hot spot. Full ties go by a hash of the row, the
    same row whatever the order of the input. The result has all columns of ``df``, so select what is needed before."""
    rest = [c for c in df.columns if c != key]
    hashed = [c for c in rest if df.schema[c].dataType.typeName() not in ("map", "variant")]
    order = F.struct(*version, F.xxhash64(*hashed)) if hashed else F.struct(F.lit(0))
    best = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.max_by(F.struct(*rest), order).alias("_best"))
    return best.select(*(F.col(key) if c == key else F.col(f"_best.{c}").alias(c) for c in df.columns))


def upsert_edges(edges: DataFrame) -> DataFrame:
    """Edges once per (src, type, dst); ``weight``, where there is one, is the greatest. Edges with a null end are dropped."""
    kept = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull())
    return kept.groupBy("src", "type", "dst").agg(F.max("weight").alias("weight")) if "weight" in edges.columns else kept.select("src", "type", "dst").distinct()


def upsert_report(before: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """What an upsert of ``rows`` into ``before`` does: one row, ``n_created, n_updated`` keys."""
    new = rows.select(key).where(F.col(key).isNotNull()).distinct()
    known = before.select(F.col(key), F.lit(True).alias("_known")).where(F.col(key).isNotNull()).distinct()
    return new.join(known, key, "left").agg(F.count_if(F.col("_known").isNull()).alias("n_created"), F.count_if(F.col("_known")).alias("n_updated"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys held by more than one row, with their number; empty where the key is unique."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)


def both_directions(edges: DataFrame) -> DataFrame:
    """Every edge as seen from either end; an edge from a node to itself is seen twice, as in an undirected match."""
    return edges.select("src", "dst", "type").unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "type"))


def schema_triples(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Distinct ``src_label, type, dst_label``."""
    label = nodes.select("id", "label")
    step = edges.join(label.select(F.col("id").alias("src"), F.col("label").alias("src_label")), "src").join(label.select(F.col("id").alias("dst"), F.col("label").alias("dst_label")), "dst")
    return step.select("src_label", "type", "dst_label").distinct()


def closed_network(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges with both ends among the ids of ``members``."""
    ids = members.select("id").distinct()
    return edges.join(ids.withColumnRenamed("id", "src"), "src", "left_semi").join(ids.withColumnRenamed("id", "dst"), "dst", "left_semi")


def trail_counts(edges: DataFrame, roots: DataFrame, last: list[str], types: list[str], most: int = 10) -> DataFrame:
    """How many paths of up to ``most`` structural steps (``types``) and one final step (``last``) lead from each root to each target:
    ``src, dst, weight``; a root's paths to itself are left out.

    Counts are carried level by level, (root, node, count) summed per node, so no path is ever spelled out: the rows are bounded by
    reachable (root, node) pairs however many paths join them. The structure must be free of cycles. ``roots`` has ``id``.
    """
    edges = cut_lineage(edges.where(F.col("type").isin(types + last)).select("src", "dst", "type"))  # every level reads them
    inner = edges.where(F.col("type").isin(types)).select("src", "dst")
    final = edges.where(F.col("type").isin(last)).select("src", F.col("dst").alias("goal"))
    level = roots.select(F.col("id").alias("root"), F.col("id").alias("node"), F.lit(1).cast("long").alias("n"))
    parts = []
    for _ in range(most):
        level = level.join(inner, level["node"] == inner["src"]).groupBy("root", "dst").agg(F.sum("n").alias("n")).withColumnRenamed("dst", "node")
        level = cut_lineage(level)
        if level.isEmpty():
            break
        parts.append(level.join(final, level["node"] == final["src"]).select("root", "goal", "n"))
    if not parts:
        parts = [level.select("root", F.col("node").alias("goal"), "n").limit(0)]
    out = reduce(DataFrame.unionByName, parts).where(F.col("root") != F.col("goal"))
    return out.groupBy(F.col("root").alias("src"), F.col("goal").alias("dst")).agg(F.sum("n").alias("weight"))


def expand(edges: DataFrame, starts: DataFrame, types: list[str] | None = None, least: int = 1, most: int = 6) -> DataFrame:
    """All paths of ``least`` to ``most`` steps from the ids of ``starts``: ``root, id, depth, path`` (ids in order). No node is visited
    twice on a path. Depth 0 is the start itself. Every level is written once and read by the next; the walk ends at an empty one."""
    step = cut_lineage((edges.where(F.col("type").isin(types)) if types else edges).select("src", "dst"))  # every level reads them
    level = starts.select(F.col("id").alias("root"), F.col("id"), F.lit(0).alias("depth"), F.array("id").alias("path"))
    parts = [level] if least == 0 else []
    for depth in range(1, most + 1):
        further = level.join(step, level["id"] == step["src"]).where(~F.array_contains("path", F.col("dst")))
        level = cut_lineage(further.select("root", F.col("dst").alias("id"), F.lit(depth).alias("depth"), F.array_append("path", F.col("dst")).alias("path")))
        if depth >= least:
            parts.append(level)
        if level.isEmpty():
            break
    return reduce(DataFrame.unionByName, parts) if parts else level.limit(0)


def all_shortest_paths(edges: DataFrame, source: str, target: str, most: int = 10, interior: DataFrame | None = None) -> DataFrame:
    """All shortest undirected paths between two ids, of at most ``most`` steps: ``path, hops``, ordered by nothing.

    With ``interior`` (a frame of ids), only paths whose inner nodes all are among these count: the shortest of the satisfying paths.
    Nodes are visited level by level, each kept with all its parents on the level before; visited nodes are cut out by an
    anti-join. Only the level at which the target appears is walked back, so no dead end is spelled out. The driver sees one
    number per level. No path gives an empty result; source and target being one gives the path of that node.
    """
    spark = edges.sparkSession
    empty = spark.createDataFrame([], "path array<string>, hops int")
    if source == target:
        return spark.createDataFrame([([source], 0)], empty.schema)
    links = edges.where(F.col("src").isNotNull() & F.col("dst").isNotNull()).select("src", "dst")
    links = cut_lineage(links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"))).distinct())  # every level reads them
    if interior is not None:
        allowed = interior.select(F.col("id").cast("string").alias("dst")).unionByName(spark.createDataFrame([(target,)], "dst string")).distinct()
        links = cut_lineage(links.join(allowed, "dst", "left_semi").select("src", "dst"))
    frontier = visited = spark.createDataFrame([(source,)], "id string")
    levels = []
    for _ in range(most):
        step = links.join(frontier, links["src"] == frontier["id"], "left_semi").select(F.col("src").alias("parent"), F.col("dst").alias("id"))
        step = cut_lineage(step.join(visited, "id", "left_anti").select("parent", "id").distinct())
        levels.append(step)
        frontier = step.select("id").distinct()
        reached = frontier.agg(F.count(F.lit(1)), F.count_if(F.col("id") == target)).first()
        if not reached[0]:
            return empty
        if reached[1]:
            break
        visited = cut_lineage(visited.unionByName(frontier))
    else:
        return empty
    paths = spark.createDataFrame([(target, [target])], "id string, path array<string>")
    for step in reversed(levels):
        paths = paths.join(step, "id").select(F.col("parent").alias("id"), F.concat(F.array("parent"), "path").alias("path"))
    return paths.select("path", F.lit(len(levels)).alias("hops"))


def shortest_path(edges: DataFrame, source: str, target: str, most: int = 10) -> DataFrame:
    """One shortest undirected path, ties to the least in order of ids: ``path, hops``."""
    return all_shortest_paths(edges, source, target, most).orderBy("path").limit(1)


def supersede_network(edges: DataFrame, types: tuple[str, ...] = ("SUPERSEDES", "SUPERSEDED_BY")) -> DataFrame:
    """Undirected matches of the supersede edges: every edge from either end."""
    return both_directions(edges.where(F.col("type").isin(*types)))


def degree_counts(acts: DataFrame, links: DataFrame, samples: int = 5) -> DataFrame:
    """Per act: distinct targets and sources over ``links`` (src, dst) and the first ``samples`` of their titles in order. ``acts`` has
    ``uri, title``; acts without links have zeros and empty lists.

    The sample lists come from ranked rows, at most ``samples`` per act, so an act cited by a third of all rows collects no more.
    """

    titled = acts.select(F.col("uri"), F.col("title").alias("_title"))
    pairs = cut_lineage(links.select("src", "dst").distinct())  # both sides read them

    def side(mine: str, other: str, name: str) -> DataFrame:
        named = pairs.select(F.col(mine).alias("_mine"), F.col(other).alias("uri")).join(titled, "uri").select(F.col("_mine").alias("uri"), "_title")
        # one row for each title of an act, numbered by titles; the rows of a title add up to the count
        each = named.groupBy("uri", "_title").agg(F.count(F.lit(1)).alias("_n"))
        ranked = each.withColumn("_r", F.row_number().over(W.partitionBy("uri").orderBy(F.asc_nulls_last("_title"))))
        first = F.filter(F.sort_array(F.collect_list(F.when(F.col("_r") <= samples, F.col("_title")))), lambda t: t.isNotNull())
        return ranked.groupBy("uri").agg(F.sum("_n").alias(f"{name}_count"), first.alias(f"top_{name}_titles"))

    out = acts.select("uri", "title").join(side("src", "dst", "outgoing"), "uri", "left").join(side("dst", "src", "incoming"), "uri", "left")
    none = F.array().cast("array<string>")
    zero: dict[str, Column] = {f"{s}_count": F.coalesce(F.col(f"{s}_count"), F.lit(0).cast("long")) for s in ("outgoing", "incoming")}
    lists: dict[str, Column] = {f"top_{s}_titles": F.coalesce(F.col(f"top_{s}_titles"), none) for s in ("outgoing", "incoming")}
    return out.withColumns(zero | lists)
