"""Cutting oversized texts into overlapping pieces at natural boundaries, with regular expressions and array functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Boundaries by falling strength: blank line, line end, sentence end, clause end, white space. Each ends a piece behind it.
BOUNDARIES = (r"\n[^\S\n]*\n", r"\n", r"[.!?][\"')\]”’]?\s", r"[;:,]\s", r"\s")


def body_pattern(most: int, least: int) -> str:
    """One piece without its overlap: for each boundary in order of strength, the longest run of ``least`` to ``most`` characters
    that ends in it; then the rest of the text if it fits; then ``most`` characters wherever they end.

    All quantifiers are bounded, so a match looks at no more than ``most`` characters per alternative, however long the text is.
    The rest of the text goes first, as no cut is better than any cut.
    """
    ways = [rf".{{1,{most}}}\z"]
    for b in BOUNDARIES:
        width = 3 if b.startswith("[.!?]") else 2
        if b == BOUNDARIES[0]:  # a wide blank line is left to the next piece
            ways.append(rf".{{{max(1, least - 2)},{most - 12}}}\n[^\S\n]{{0,10}}\n")
            ways.append(rf".{{{max(1, least - 1)},{most - 1}}}\n(?=[^\S\n]{{11,{most}}}+\n)")
        else:
            ways.append(rf".{{{max(1, least - width)},{most - width}}}{b}")
    return f"(?s)(?:{'|'.join(ways)}|.{{1,{most}}})"


def overlap_tail(body: Column, overlap: int) -> Column:
    """The last ``overlap`` characters of a piece, less the word they cut into if that ends within the first quarter."""
    tail = F.when(F.length(body) > overlap, F.right(body, F.lit(overlap))).otherwise(body)
    return F.when(F.length(body) > overlap, F.regexp_replace(tail, rf"(?s)^\S{{0,{overlap // 4}}}\s", "")).otherwise(tail)


def split_text(text: Column | str, limit: int = 2000, overlap: int = 200) -> Column:
    """The pieces of a text as ``array<struct<piece int, start long, length int, shared int, text string>>``.

    No piece is longer than ``limit`` characters (code points). Leaving out each piece's first ``shared`` characters, the pieces laid
    end to end are the text itself. ``start`` is the offset of the piece, overlap included; ``shared`` about ``overlap`` (less at most
    a quarter, to begin at a word; none for the first piece). Text within the limit is one piece as it is, the empty text included.
    Null gives null.
    """
    if not 0 <= overlap < limit // 2:
        raise ValueError("the overlap must be under half of the limit")
    c = F.col(text) if isinstance(text, str) else text
    most = limit - overlap
    bodies = F.regexp_extract_all(c, F.lit(body_pattern(most, most // 2)), F.lit(0))
    bodies = F.when(F.length(c) > limit, bodies).otherwise(F.array(c))
    # (body, offset behind it) for all pieces: lookback offsets then come from array positions
    sums = F.aggregate(
        F.transform(bodies, lambda b: F.length(b).cast("long")), F.array(F.lit(0).cast("long")),
        lambda ends, n: F.concat(ends, F.array(F.element_at(ends, -1) + n)),
    )
    parts = F.struct(bodies.alias("bodies"), sums.alias("ends"))

    def piece(body: Column, i: Column, p: Column) -> Column:
        tail = F.when(i > 0, overlap_tail(F.element_at(p["bodies"], F.greatest(i, F.lit(1))), overlap)).otherwise(F.lit(""))
        start = F.element_at(p["ends"], i + 1) - F.length(tail)
        return F.struct(
            (i + 1).cast("int").alias("piece"), start.alias("start"), (F.length(tail) + F.length(body)).cast("int").alias("length"),
            F.length(tail).cast("int").alias("shared"), F.concat(tail, body).alias("text"),
        )

    pieces = F.flatten(F.transform(F.array(parts), lambda p: F.transform(p["bodies"], lambda b, i: piece(b, i, p))))
    return F.when(c.isNotNull(), pieces)


def split_records(df: DataFrame, text: str, keys: list[str], limit: int = 2000, overlap: int = 200) -> DataFrame:
    """One row per piece: the key columns, ``piece, start, length, shared, text`` and ``n_pieces``. Null texts give no row. No shuffle;
    repeated rows are split one by one; other columns are ignored."""
    parts = df.select(*keys, split_text(text, limit, overlap).alias("_pieces"))
    return parts.select(*keys, F.size("_pieces").alias("n_pieces"), F.inline("_pieces").alias("piece", "start", "length", "shared", "text"))
