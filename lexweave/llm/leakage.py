"""Evaluation texts leaking into training text: template windows, exact and re-parameterised, met by a hash join."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: Words that name a unit.
UNITS = frozenset(
    "crown crowns penny pence pound pounds shilling shillings mile miles yard yards metre metres kilometre kilometres acre acres hectare hectares day days week weeks month months year years hour hours minute minutes kg g mg km cm mm m percent".split()
)
#: Bits of the filter of ordinary words, and the least and most of the filter of item windows. Filters of bits, so their size doesn't grow.
WORD_BITS, LEAST_BITS, MOST_BITS = 26, 20, 27
#: Swapped windows, in units of windows that no other item shares, that make a re-parameterised copy: by chance a stock phrase of several
#: items stands beside a word or two that fit one of them.
RARE = 3.0
#: Least literal words of a template window.
LITERALS = 7
_WORD = re.compile(r"[^\W_]+")
_NUM, _UNIT, _NAME = (np.uint64(xxhash.xxh3_64_intdigest(p)) for p in ("<num>", "<unit>", "<name>"))
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def words_of(text: str) -> list[str]:
    """The longest runs of letters and digits after NFKC and lower-casing."""
    return _WORD.findall((text if text.isascii() else unicodedata.normalize("NFKC", text)).lower())


def is_number(word: str) -> bool:
    return any(c.isnumeric() for c in word)


class Templates:
    """Template windows of texts.

    A word's template is the word itself where it is ordinary vocabulary, else a typed placeholder: number for words holding a digit,
    unit for units, name for everything else: words that the items only ever write with a capital, and words they don't have at all.
    Ordinary is what the filter ``ordinary`` holds. The template of a word depends on the word alone, so equal text has equal templates.

    A window of ``width`` words with at least half of them literal is keyed by its template. Any other would fit too much: it is keyed by
    its words as they stand, and, once more, by the template of the window widened until it holds as many literal words.
    """

    def __init__(self, ordinary: np.ndarray, width: int):
        self.ordinary, self.width = ordinary, width
        self.index: dict[str, int] = {}
        self.plain = self.template = np.empty(0, np.uint64)
        self.literal = np.empty(0, bool)
        self.powers = self.inverses = np.ones(1, np.uint64)

    def _codes(self, words: list[str]) -> np.ndarray:
        """Numbers of the words; new words are entered, and the table is emptied when it grows large."""
        if len(self.index) > 1_000_000:
            self.index.clear()
            self.plain = self.template = np.empty(0, np.uint64)
            self.literal = np.empty(0, bool)
        new = [w for w in dict.fromkeys(words) if w not in self.index]
        if new:
            self.index.update(zip(new, range(len(self.index), len(self.index) + len(new)), strict=True))
            plain = np.array([xxhash.xxh3_64_intdigest(w) for w in new], np.uint64)
            known = self.ordinary[(plain >> np.uint64(64 - WORD_BITS)).astype(np.int64)]
            kind = np.array([1 if is_number(w) else 2 if w in UNITS else 0 for w in new])
            literal = known & (kind == 0)
            template = np.where(literal, plain, np.where(kind == 1, _NUM, np.where(kind == 2, _UNIT, _NAME)))
            self.plain, self.template = np.concatenate([self.plain, plain]), np.concatenate([self.template, template])
            self.literal = np.concatenate([self.literal, literal])
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))

    def _hashes(self, codes: np.ndarray, start: np.ndarray, stop: np.ndarray, kind: int) -> np.ndarray:
        """A 64-bit hash of each stretch of codes: differences of running sums of a polynomial, which wrap around as they should."""
        n = len(codes)
        if len(self.powers) < n:
            self.powers = np.append(np.uint64(1), np.cumprod(np.full(n, _BASE, np.uint64)))
            self.inverses = np.append(np.uint64(1), np.cumprod(np.full(n, _INVERSE, np.uint64)))
        sums = np.append(np.uint64(0), np.cumsum(codes * self.powers[:n]))
        h = (sums[stop] - sums[start]) * self.inverses[start] + (stop - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93 + 2 * kind)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def windows(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, stop and key of every window."""
        n = len(words) - self.width + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
        at = self._codes(words)
        template, literal = self.template[at], self.literal[at]
        seen = np.append(0, np.cumsum(literal))
        start = np.arange(n)
        loose = seen[self.width :] - seen[:n] >= LITERALS
        tight = start[~loose]
        literals = np.flatnonzero(literal)
        last = seen[tight] + LITERALS - 1
        wide = tight[last < len(literals)]
        ends = literals[last[last < len(literals)]] + 1
        keys = [
            self._hashes(template, start[loose], start[loose] + self.width, 0),
            self._hashes(self.plain[at], tight, tight + self.width, 1),
            self._hashes(template, wide, ends, 2),
        ]
        starts = np.concatenate([start[loose], tight, wide])
        return starts, np.concatenate([start[loose] + self.width, tight + self.width, ends]), np.concatenate(keys)


_SCHEMA = "id long, copy long, at int, key long, words array<string>, n_windows int"


def _window_rows(df: DataFrame, ordinary, width: int, sieve=None) -> DataFrame:
    """Windows of ``id, text`` rows; with a sieve, only those that the filter of the other side's keys lets through."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = Templates(np.unpackbits(ordinary.value).astype(bool), width)
        held = None if sieve is None else np.unpackbits(sieve.value).astype(bool)
        shift = None if held is None else np.uint64(65 - len(held).bit_length())
        for batch in batches:
            out: list[tuple] = []
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                words = words_of(text) if text else []
                start, stop, keys = templates.windows(words)
                n = len(start)
                if held is not None and n:
                    kept = np.flatnonzero(held[(keys >> shift).astype(np.int64)])
                    start, stop, keys = start[kept], stop[kept], keys[kept]
                if len(start):
                    copy = xxhash.xxh3_64_intdigest(text) - (1 << 63)
                    signed = keys.view(np.int64).tolist()
                    out += [(key, copy, a, k, words[a:b], n) for a, b, k in zip(start.tolist(), stop.tolist(), signed, strict=True)]
            columns = list(zip(*out, strict=True)) or [[]] * 6
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.string()), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], ["id", "copy", "at", "key", "words", "n_windows"])

    return df.mapInArrow(rows, _SCHEMA)


def _bits(positions: DataFrame, position: str, bits: int) -> np.ndarray:
    """A filter of 2 ** bits bits, packed, with the bits set at the positions. Bitmaps of 32,768 bits are merged on the executors, so the
    driver gets 2 ** bits / 8 bytes at most, whatever the number of rows."""
    maps = positions.groupBy(F.bitmap_bucket_number(position).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bitmap"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in maps.collect():  # bucket n holds the positions from 32768 (n - 1) + 1 on, least bit of each byte first
        piece = np.packbits(np.unpackbits(np.frombuffer(bytes(r["bitmap"]), np.uint8), bitorder="little"))
        at = (r["bucket"] - 1) * 4096
        out[at : at + len(piece)] = piece[: len(out) - at]
    return out


def ordinary_words(items: DataFrame, passage: str) -> DataFrame:
    """The vocabulary that templates keep literally: words that some item writes in lower case. ``position`` is the word's place in the
    filter, counted from 1."""

    def lower(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for text in batch.column("passage"):
                raw = _WORD.findall(unicodedata.normalize("NFKC", text.as_py() or ""))
                seen.update((xxhash.xxh3_64_intdigest(w) >> (64 - WORD_BITS)) + 1 for w in raw if w == w.lower() and not is_number(w))
        yield pa.RecordBatch.from_arrays([pa.array(sorted(seen), pa.int64())], ["position"])

    return items.select(F.col(passage).alias("passage")).mapInArrow(lower, "position long").distinct()


def consistent(own: Column, there: Column) -> Column:
    """Whether every word of ``own`` stands for one word of ``there`` at the same places, and no two for the same."""
    pairs = F.size(F.array_distinct(F.arrays_zip(own.alias("a"), there.alias("b"))))
    return (pairs == F.size(F.array_distinct(own))) & (pairs == F.size(F.array_distinct(there)))


def find_leaks(documents: DataFrame, doc_id: str, text: str, items: DataFrame, item_id: str, passage: str, width: int = 13) -> DataFrame:
    """Documents that hold passages of evaluation items: ``doc_id, item_id, exact_windows, swapped_windows, swapped_slots, rare_windows,
    covered, first_word``.

    Both sides are cut into words (NFKC, lower case, longest runs of letters and digits) and canonicalised: numbers, names and units
    become typed placeholders. Windows of ``width`` words with equal templates meet in a hash join, and their slots are compared:
    ``exact_windows`` counts windows equal word for word (one such is a leak of a passage in whole or part); ``swapped_windows`` those
    where every slot value of the item is consistently replaced by another, one for one: a re-parameterised question, or a stretch of
    at least ``width`` words of it. ``swapped_slots``: how many values are exchanged in one alignment. ``rare_windows``: the swapped
    windows, each divided by the number of items that have the same template, so that stock phrases count little. ``covered``: share of
    the item's windows that are exact or swapped.

    The documents are read once, whatever the number of items: each task keeps the windows that pass a filter of bits of the items'
    window hashes, of at most 2 ** MOST_BITS bits, and only these are shuffled. A filter lets some others through, never a true one back;
    the join decides. What is ordinary vocabulary is told by a filter of 2 ** WORD_BITS bits likewise. A window of a template
    that a third of all documents hold is a hot join key: adaptive execution splits it.

    Null ids, null and empty texts, and passages of fewer than ``width`` words, match nothing. Repeated rows of documents or items
    count once; of several texts under one id the largest counts hold. Empty tables give an empty result. Other columns are ignored.
    """
    spark = documents.sparkSession
    side = lambda df, key, body: df.select(F.col(key).cast("long").alias("id"), F.col(body).alias("text")).where(F.col("id").isNotNull() & F.col("text").isNotNull())
    tests = side(items, item_id, passage).distinct()
    ordinary = spark.sparkContext.broadcast(_bits(ordinary_words(tests, "text"), "position", WORD_BITS))
    wanted = cut_lineage(_window_rows(tests, ordinary, width))
    n = wanted.count()
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * n).bit_length()))
    sieve = spark.sparkContext.broadcast(_bits(wanted.select((F.shiftrightunsigned("key", 64 - bits) + 1).alias("position")), "position", bits))
    met_by = wanted.groupBy("key").agg(F.count_distinct("id").alias("n_items"))
    theirs = wanted.join(met_by, "key").select(
        "key", F.col("id").alias("item_id"), F.col("copy").alias("item_copy"), F.col("at").alias("q"), F.col("words").alias("own"), "n_windows", (1 / F.col("n_items")).alias("rare")
    )
    ours = _window_rows(side(documents, doc_id, text), ordinary, width, sieve).select("key", F.col("id").alias("doc_id"), "copy", F.col("at").alias("p"), F.col("words").alias("there"))
    exact = F.col("own") == F.col("there")
    met = ours.join(theirs, "key").where(consistent(F.col("own"), F.col("there")))
    alike = met.select("doc_id", "copy", "item_id", "item_copy", "n_windows", "q", "p", "rare", exact.alias("exact"), (F.col("p") - F.col("q")).alias("shift"), F.when(~exact, F.filter(F.arrays_zip(F.col("own").alias("a"), F.col("there").alias("b")), lambda x: x["a"] != x["b"])).alias("slots"))
    # one row for each window of an item in an alignment: a wide window may begin where another does, and a document may stand twice
    pair = ["doc_id", "copy", "item_id", "item_copy", "n_windows"]
    each = alike.groupBy(*pair, "shift", "q").agg(F.max("exact").alias("exact"), F.min("p").alias("p"), F.max("rare").alias("rare"), F.first("slots", True).alias("slots"))
    swapped = F.when(~F.col("exact"), 1)
    lines = each.groupBy(*pair, "shift").agg(
        F.count_if("exact").alias("exact_windows"), F.count(swapped).alias("swapped_windows"), F.coalesce(F.sum(swapped * F.col("rare")), F.lit(0.0)).alias("rare_windows"),
        F.size(F.array_distinct(F.flatten(F.collect_set("slots")))).alias("swapped_slots"), F.collect_set("q").alias("starts"), F.min("p").alias("first_word"),
    )
    texts = lines.groupBy(*pair).agg(
        *(F.sum(c).alias(c) for c in ("exact_windows", "swapped_windows", "rare_windows")), F.max("swapped_slots").alias("swapped_slots"),
        (F.size(F.array_distinct(F.flatten(F.collect_list("starts")))) / F.col("n_windows")).alias("covered"), F.min("first_word").alias("first_word"),
    )
    counts = ("exact_windows", "swapped_windows", "swapped_slots", "rare_windows", "covered")
    best = texts.groupBy("doc_id", "item_id").agg(*(F.max(c).alias(c) for c in counts), F.min("first_word").alias("first_word"))
    whole = {c: F.col(c).cast("int") for c in ("exact_windows", "swapped_windows", "swapped_slots")}
    return best.withColumns(whole | {"covered": F.least("covered", F.lit(1.0))})
