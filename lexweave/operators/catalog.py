"""Views, guarded SQL, and small operators on chats and tool events."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import WRITE_WORDS

#: Further SQL words that change something.
SQL_WRITES = ("INSERT", "UPDATE", "ALTER", "TRUNCATE", "REFRESH", "CACHE", "UNCACHE", "LOAD", "ADD", "REPLACE", "ANALYZE", "MSCK", "GRANT", "REVOKE", "CALL")
_WRITES = re.compile(rf"\b({'|'.join(WRITE_WORDS + SQL_WRITES)})\b", re.IGNORECASE)


def register(tables: dict[str, DataFrame]) -> None:
    """Temporary views by name."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_query(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    return spark.sql(sql, args=params or {})


def run_query_df(spark: SparkSession, sql: str, params: dict | None = None) -> pd.DataFrame:
    return run_query(spark, sql, params).toPandas()


def run_query_single(spark: SparkSession, sql: str, params: dict | None = None) -> Row | None:
    """The only row, or None; more than one is an error."""
    rows = run_query(spark, sql, params).limit(2).collect()
    if len(rows) > 1:
        raise ValueError("the query has more than one row")
    return rows[0] if rows else None


def verify(spark: SparkSession) -> bool:
    return spark.sql("SELECT 1 AS one").first()["one"] == 1


def read_only(spark: SparkSession, sql: str, params: dict | None = None) -> DataFrame:
    """The result of a statement that reads; a statement holding a writing keyword, even in a string, gives one row with ``error``."""
    if _WRITES.search(sql or ""):
        return spark.createDataFrame([("only statements that read are allowed",)], "error string")
    return run_query(spark, sql, params)


def graph_of_paths(paths: DataFrame, nodes: DataFrame, edges: DataFrame, path: str = "path") -> tuple[DataFrame, DataFrame]:
    """The distinct nodes and edges on paths (arrays of ids), for drawing."""
    ids = paths.select(F.explode(path).alias("id")).distinct()
    steps = paths.select(F.explode(F.arrays_zip(F.slice(path, 1, F.size(path) - 1).alias("a"), F.slice(path, 2, F.size(path) - 1).alias("b"))).alias("s")).select(F.col("s.a").alias("a"), F.col("s.b").alias("b")).distinct()
    both = steps.unionByName(steps.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    return nodes.join(ids, "id", "left_semi"), edges.join(both, (edges["src"] == both["a"]) & (edges["dst"] == both["b"]), "left_semi")


def describe(tables: dict[str, DataFrame]) -> list[str]:
    """A line per table: its columns and types."""
    return [f"{name}: " + ", ".join(f"{c}: {t}" for c, t in df.dtypes) for name, df in sorted(tables.items())]


def trim_history(messages: DataFrame, conversation: str, turn: str, role: str, text: str, last: int = 20) -> DataFrame:
    """The last messages of each conversation, then of these only those by user or assistant that aren't blank."""
    recent = messages.withColumn("_r", F.row_number().over(W.partitionBy(conversation).orderBy(F.desc(turn), F.desc(role)))).where(F.col("_r") <= last)
    return recent.where(F.col(role).isin("user", "assistant") & (F.trim(F.coalesce(F.col(text), F.lit(""))) != "")).drop("_r")


def tool_durations(events: DataFrame, keys: list[str], kind: str, at: str, start: str, end: str, tie: str) -> DataFrame:
    """Starts and ends of tool calls paired first in, first out per key: the keys, ``n, started_at, ended_at, seconds``. Starts without an
    end, and ends without a start, are left out."""
    w = W.partitionBy(*keys, kind).orderBy(at, tie)
    numbered = events.where(F.col(kind).isin(start, end)).select(*keys, kind, at, F.row_number().over(w).alias("n"))
    pick = lambda k: F.max(F.when(F.col(kind) == k, F.col(at).cast("timestamp")))
    pairs = numbered.groupBy(*keys, "n").agg(pick(start).alias("started_at"), pick(end).alias("ended_at")).where(F.col("started_at").isNotNull() & F.col("ended_at").isNotNull())
    return pairs.withColumn("seconds", F.round((F.unix_micros("ended_at") - F.unix_micros("started_at")) / 1e6, 3))


def metrics(acts: DataFrame, sections: DataFrame, paragraphs: DataFrame, links: DataFrame) -> DataFrame:
    """One row: acts with first and last enactment, numbers of sections, paragraphs and links. Four one-row aggregates side by side."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    head = acts.agg(F.count(F.lit(1)).alias("n_acts"), F.min("enactment_date").alias("first_enacted"), F.max("enactment_date").alias("last_enacted"))
    return head.crossJoin(count(sections, "n_sections")).crossJoin(count(paragraphs, "n_paragraphs")).crossJoin(count(links, "n_links"))


def same_model(indexed_with: str | None, queried_with: str | None) -> bool:
    """Whether vectors and queries come from one embedding model; unknown models are not the same."""
    return indexed_with is not None and indexed_with == queried_with
