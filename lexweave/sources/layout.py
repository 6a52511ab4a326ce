"""What takes the place of indexes: how a table is laid out on disk, so that a scan can skip what a query doesn't want."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

#: The columns that are looked up by value and those that are compared as ranges, by label.
LOOKUPS = {"Legislation": ["uri"], "Paragraph": ["uri"], "Section": ["uri"]}
RANGES = {"Legislation": ["uri"], "Part": ["order"], "Paragraph": ["restrict_start_date", "restrict_end_date"]}


def write_layout(df: DataFrame, path: str, ranges: list[str] | None = None, lookups: list[str] | None = None, files: int | None = None) -> None:
    """Writes a table whose files and row groups cover narrow ranges of ``ranges`` (the first one above all), and hold bloom filters of the
    values of ``lookups``. Readers push comparisons into the scan and skip the rest."""
    if ranges:
        spread = df.repartitionByRange(files, *ranges) if files else df.repartitionByRange(*ranges)
        df = spread.sortWithinPartitions(*ranges)
    writer = df.write.mode("overwrite")
    for c in lookups or []:
        writer = writer.option(f"parquet.bloom.filter.enabled#{c}", "true")
    writer.parquet(path)


def layout_of(spark: SparkSession, path: str, columns: list[str]) -> list[Row]:
    """Per file and column the least and greatest value, as a check that the ranges are narrow: ``file, column, least, greatest``."""
    df = spark.read.parquet(path).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    each = None
    for c in columns:
        one = df.groupBy("file").agg(F.lit(c).alias("column"), F.min(F.col(c).cast("string")).alias("least"), F.max(F.col(c).cast("string")).alias("greatest"))
        each = one if each is None else each.unionByName(one)
    return each.orderBy("column", "least", "file").collect() if each is not None else []


def write_graph(nodes: dict[str, DataFrame], out: str) -> list[str]:
    """Every label's table in its layout, below ``out``; the list of what was made, one line for each."""
    made = []
    for label, df in nodes.items():
        ranges, lookups = RANGES.get(label, []), LOOKUPS.get(label, [])
        write_layout(df, f"{out}/{label}", ranges, lookups)
        made += [f"{label}.{c}: range" for c in ranges] + [f"{label}.{c}: lookup" for c in lookups]
    return sorted(made)


def missing_layouts(made: list[str]) -> list[str]:
    """Which of the layouts that queries rely on are not among those made."""
    wanted = [f"{label}.{c}: {kind}" for kind, of in (("range", RANGES), ("lookup", LOOKUPS)) for label, columns in of.items() for c in columns]
    return sorted(set(wanted) - set(made))
