"""Vectors for nodes that have text, made by any encoder, and retrieval by a text query."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import combined_text
from .search import vector_hits

#: Texts to vectors, one row for each text. It must not depend on which texts come together.
Encoder = Callable[[list[str]], np.ndarray]


def unit(x: np.ndarray) -> np.ndarray:
    """Rows of unit length; rows of zeros stay."""
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.divide(x, length, out=np.zeros_like(x), where=length > 0)


def letter_encoder(texts: list[str]) -> np.ndarray:
    """How often each letter from a to z stands in a text: a stand-in for a model, for tests and demonstrations."""
    return np.array([[t.lower().count(chr(97 + i)) for i in range(26)] for t in texts], dtype=np.float64).reshape(-1, 26)


def embed_missing(nodes: DataFrame, encoder: Encoder, key: str = "id", text: tuple[str, str, str] = ("title", "description", "text"), batch: int = 256) -> DataFrame:
    """All nodes with ``embedding`` (array of float, unit length) and ``is_text``, which marks those that have one.

    Nodes without ``embedding``, or with an empty one, and with something to read (title, description and text on lines of their own) get
    theirs from the encoder, ``batch`` texts at a time; all others pass as they are. One pass, no shuffle, no loop over batches on the
    driver. Columns of ``text`` that the nodes don't have count as null. Null keys and repeated rows are treated like others.
    """
    has = lambda c: F.col(c).cast("string") if c in nodes.columns else F.lit(None).cast("string")
    before = F.col("embedding").cast("array<float>") if "embedding" in nodes.columns else F.lit(None).cast("array<float>")
    rest = [c for c in nodes.columns if c not in ("embedding", "is_text")]
    src = nodes.select(*rest, before.alias("embedding"), combined_text(*(has(c) for c in text)).alias("_content"))

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            vectors, content = rows.column("embedding").to_pylist(), rows.column("_content").to_pylist()
            want = [i for i, (v, c) in enumerate(zip(vectors, content, strict=True)) if not v and c]
            for at in range(0, len(want), batch):
                some = want[at : at + batch]
                for i, v in zip(some, unit(np.asarray(encoder([content[i] for i in some]), dtype=np.float64)), strict=True):
                    vectors[i] = v.tolist()
            columns = [rows.column(i) for i in range(rows.num_columns - 2)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(vectors, pa.list_(pa.float32()))], rows.schema.names[:-1])

    out = src.mapInArrow(fill, src.drop("_content").schema)
    return out.withColumn("is_text", F.coalesce(F.size("embedding") > 0, F.lit(False)))


def embedded_count(nodes: DataFrame) -> int:
    """How many nodes have a vector."""
    return nodes.where(F.col("is_text")).count()


def text_hits(nodes: DataFrame, encoder: Encoder, query: str | None, k: int = 10, key: str = "id") -> DataFrame:
    """The nodes most similar to a text: ``node_id, score``. A null or blank query finds nothing."""
    vector = unit(np.asarray(encoder([query or ""]), dtype=np.float64))[0].tolist()
    found = vector_hits(nodes, key, "embedding", vector, k)
    return found if (query or "").strip() else found.limit(0)


def retrieve(nodes: DataFrame, encoder: Encoder, query: str | None, k: int = 4, key: str = "id", text: tuple[str, str, str] = ("title", "description", "text")) -> DataFrame:
    """Passages for a question: the hits of a text with what the nodes have to read, ``node_id, score, content``, best first."""
    has = lambda c: F.col(c).cast("string") if c in nodes.columns else F.lit(None).cast("string")
    content = nodes.select(F.col(key).alias("node_id"), combined_text(*(has(c) for c in text)).alias("content"))
    return text_hits(nodes, encoder, query, k, key).join(content, "node_id").orderBy(F.desc("score"), "node_id")
