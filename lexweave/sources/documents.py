"""Reading and writing act records, seed lists and page tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType

from ..functions.urls import file_name
from ..operators.nested import as_list, field_of, is_object, parse_records, quoted
from .schema import document_schema


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Act records from JSON files below a folder, one record per file. Corrupt files and records without a URL are left out."""
    schema = document_schema().add("_corrupt_record", StringType())
    reader = spark.read.schema(schema).option("multiLine", True).option("mode", "PERMISSIVE").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return usable_documents(reader.json(path))


def usable_documents(df: DataFrame) -> DataFrame:
    """Without corrupt records and those whose ``legislation_url`` is null or empty."""
    if "_corrupt_record" in df.columns:
        df = df.where(F.col("_corrupt_record").isNull()).drop("_corrupt_record")
    return df.where(F.col("legislation_url").isNotNull() & (F.col("legislation_url") != ""))


def tidy(v: str, kind: StructType, depth: int = 0) -> str:
    """A variant in the declared shape, as SQL: a lone object, or text holding a JSON list, where a list belongs becomes that list; null
    entries of lists go; what can't be brought into shape is null."""

    def value(name: str, kind: DataType) -> str:
        if isinstance(kind, ArrayType):
            x = f"x{depth}"
            shaped = f"transform({as_list(v, name)}, {x} -> CASE WHEN {is_object(x)} THEN {tidy(x, kind.elementType, depth + 1)} END)"
            return f"filter({shaped}, {x} -> {x} IS NOT NULL)"
        if isinstance(kind, StructType):
            inner = field_of(v, name, "variant")
            return f"CASE WHEN {is_object(inner)} THEN {tidy(inner, kind, depth)} END"
        return field_of(v, name, kind.simpleString())

    return f"named_struct({', '.join(f'{quoted(f.name)}, {value(f.name, f.dataType)}' for f in kind.fields)})"


def documents_from_text(df: DataFrame, text: str, mend: bool = False, version: str | None = None) -> DataFrame:
    """Act records from a column of JSON text; damaged text gives no row. With ``mend``, records whose lists come in other shapes are
    brought into the declared one; without, they count as damaged. ``version`` names a column that orders deliveries of one record and
    stays as ``_version``. All in the JVM; every record is parsed once."""
    order = F.lit(None).cast("string") if version is None else F.col(version)
    if mend:
        parsed = parse_records(df, order, text).select(F.col("_key").alias("_version"), F.explode(F.array(F.expr(tidy("_v", document_schema())))).alias("d"))
        out = parsed.select("d.*", "_version")
    else:
        shape = document_schema().add("_corrupt_record", StringType())
        parsed = df.select(order.alias("_version"), F.from_json(text, shape, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("d"))
        out = parsed.where(F.col("d").isNotNull()).select("d.*", "_version")
    return usable_documents(out if version else out.drop("_version"))


def write_documents(df: DataFrame, path: str, prefix: str = "") -> None:
    """Records as JSON lines in one folder per year of the act, ``unknown_year`` where there is none."""
    year = F.coalesce(F.nullif(F.col("metadata.year"), F.lit("")), F.lit("unknown_year"))
    df.withColumns({"year": year, "file_name": file_name("legislation_url", prefix)}).write.mode("overwrite").partitionBy("year").json(path)


def read_seeds(spark: SparkSession, path: str, base: str) -> DataFrame:
    """Seed URLs, one per non-blank line of a text file, behind a base URL: ``url, depth`` with depth 0."""
    line = F.trim("value")
    return spark.read.text(path).where(line != "").select(F.concat(F.lit(base.rstrip("/") + "/"), line).alias("url"), F.lit(0).alias("depth"))


def read_pages(spark: SparkSession, path: str, url_of: dict[str, str] | None = None) -> DataFrame:
    """Stored pages as ``url, body``: from a folder of files, named by ``url_of`` (file name to URL) or by their path."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.element_at(F.split("path", "/"), -1)
    if url_of:
        names = spark.createDataFrame(list(url_of.items()), "name string, url string")
        return files.withColumn("name", name).join(F.broadcast(names), "name").select("url", F.col("content").cast("string").alias("body"))
    return files.select(F.col("path").alias("url"), F.col("content").cast("string").alias("body"))
