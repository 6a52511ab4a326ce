"""Pages fetched by any fetcher, each only once: what was fetched is kept in a table by URL."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.request import urlopen

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.urls import fetch_url

#: A URL to its body; None, or an error, where there is none.
Fetcher = Callable[[str], bytes | str | None]


def http_fetcher(url: str) -> bytes | None:
    """A plain GET; an empty body counts as none."""
    with urlopen(url, timeout=30) as answer:  # noqa: S310
        return answer.read() or None


def choose_fetcher(given: Fetcher | None = None, session: object | None = None) -> Fetcher:
    """The fetcher that was given, else one over the session's ``get``, else plain GET."""
    if given is not None:
        return given
    if session is not None:

        def by_session(url: str) -> bytes | None:
            answer = session.get(url, timeout=30)
            answer.raise_for_status()
            return answer.content or None

        return by_session
    return http_fetcher


def fetch_many(urls: DataFrame, fetcher: Fetcher) -> DataFrame:
    """``url, body, error`` of each distinct URL (column ``url``, normalised). A URL that fails, or gives nothing, has a null body and says
    why; the others are not touched by it. URLs spread over the tasks, each task fetches its own one after another."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for url in batch["url"]:
                try:
                    body = fetcher(url)
                    text = body.decode() if isinstance(body, bytes) else body
                    out.append((url, text or None, None if text else "no body"))
                except Exception as e:  # one bad URL must not end the task
                    out.append((url, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["url", "body", "error"])

    wanted = urls.select(fetch_url("url").alias("url")).where(F.col("url").isNotNull()).distinct()
    return wanted.mapInPandas(fetch, "url string, body string, error string")


def read_cache(spark: SparkSession, cache: str) -> DataFrame:
    """The pages kept so far, one per URL: the last fetched."""
    schema = "url string, body string, fetched_at timestamp"
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(cache).groupBy("url").agg(F.max_by("body", "fetched_at").alias("body"), F.max("fetched_at").alias("fetched_at"))


def fetch_pages(urls: DataFrame, cache: str, fetcher: Fetcher | None = None) -> DataFrame:
    """The pages of all URLs, ``url, body``: those in the cache as they are, the others fetched and added to it. Failures are not kept, so
    they are tried again next time; they have no row."""
    spark = urls.sparkSession
    wanted = urls.select(fetch_url("url").alias("url")).where(F.col("url").isNotNull()).distinct()
    missing = wanted.join(read_cache(spark, cache).select("url"), "url", "left_anti")
    got = fetch_many(missing, choose_fetcher(fetcher)).where(F.col("body").isNotNull())
    got.select("url", "body", F.current_timestamp().alias("fetched_at")).write.mode("append").parquet(cache)
    return wanted.join(read_cache(spark, cache), "url").select("url", "body")
