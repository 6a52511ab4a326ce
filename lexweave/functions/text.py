"""Text, payload and scoring functions on columns."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import DoubleType

#: Keywords that mark a statement as writing.
WRITE_WORDS = ("CREATE", "MERGE", "DELETE", "DETACH", "SET", "DROP", "REMOVE")
#: Weights of the lexical title score and of the fused score.
EXACT, QUERY_IN_TITLE, TITLE_IN_QUERY, QUERY_IN_URI, OVERLAP, RATIO, SAME_YEAR, BOTH_ACT = 1.0, 0.6, 0.35, 0.25, 0.55, 0.35, 0.25, 0.1
LEXICAL, VECTOR, YEAR_BONUS = 0.65, 0.30, 0.1


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Without white space at both ends, line breaks included."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


def normalise(c: Column | str) -> Column:
    """Lower case; runs of anything but a-z and 0-9 become one blank; no blanks at the ends. Null counts as empty."""
    return F.trim(F.regexp_replace(F.lower(F.coalesce(_c(c), F.lit(""))), "[^a-z0-9]+", " "))


def year_in(c: Column | str) -> Column:
    """The first year from 1600 to 2100 that stands as a word of its own; null if there is none."""
    words = F.transform(F.regexp_extract_all(F.coalesce(_c(c), F.lit("")), F.lit(r"\b\d{4}\b"), F.lit(0)), lambda w: w.cast("int"))
    return F.try_element_at(F.filter(words, lambda n: n.between(1600, 2100)), F.lit(1))


def tokens(c: Column | str, longer_than: int = 2) -> Column:
    """The words of a normalised text that are longer than ``longer_than`` characters, in order."""
    return F.filter(F.split(_c(c), " "), lambda t: F.length(t) > longer_than)


def overlap(a: Column, b: Column) -> Column:
    """Share of the distinct tokens of ``a`` that are in ``b``."""
    own = F.array_distinct(a)
    return F.size(F.array_intersect(own, b)) / F.greatest(F.size(own), F.lit(1))


@pandas_udf(DoubleType())
def similarity_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratcliff-Obershelp similarity of two strings, first against second; null counts as empty."""
    return pd.Series([SequenceMatcher(None, x or "", y or "").ratio() for x, y in zip(a, b, strict=True)], dtype="float64")


def lexical_score(query: Column, title: Column, uri: Column, with_ratio: bool = True) -> Column:
    """How well a query fits a title and uri, to 6 places: a sum of weights for equality, containment either way, containment in
    the uri, the share of the query's tokens found, the similarity ratio, the query's year standing in the title, and the token
    ``act`` on both sides. All on normalised text."""
    q, t, u = normalise(query), normalise(title), normalise(uri)
    mine, theirs = tokens(q), tokens(t)
    add = lambda test, weight: F.when(test, weight).otherwise(0.0)
    score = add(t == q, EXACT) + add(t.contains(q), QUERY_IN_TITLE) + add((t != "") & q.contains(t), TITLE_IN_QUERY) + add(u.contains(q), QUERY_IN_URI)
    score = score + OVERLAP * overlap(mine, theirs) + add(t.contains(year_in(query).cast("string")), SAME_YEAR)
    score = score + add(F.array_contains(mine, "act") & F.array_contains(theirs, "act"), BOTH_ACT)
    return F.round(score + RATIO * similarity_ratio(q, t) if with_ratio else score, 6)


def combined_text(title: Column | str, description: Column | str, text: Column | str) -> Column:
    """Title, description and text on lines of their own, absent ones left out, stripped; null if nothing is left."""
    line = lambda c: F.coalesce(F.concat(_c(c), F.lit("\n")), F.lit(""))
    return F.nullif(strip(F.concat(line(title), line(description), F.coalesce(_c(text), F.lit("")))), F.lit(""))


def payload(c: Column | str) -> Column:
    """A tool payload as ``map<string,string>``: a JSON object as it is, blank as the empty map, other text as ``q``."""
    p = F.coalesce(_c(c), F.lit(""))
    empty = F.create_map().cast("map<string,string>")
    is_object = F.try_variant_get(F.try_parse_json(p), "$", "map<string,variant>").isNotNull()
    return F.when(strip(p) == "", empty).when(is_object, F.coalesce(F.from_json(p, "map<string,string>"), empty)).otherwise(F.create_map(F.lit("q"), p))


def json_inside(c: Column | str) -> Column:
    """The JSON in a mixed text, as text: the whole, else the widest ``{...}``, else the widest ``[...]``, else the text itself."""
    t = _c(c)
    valid = lambda x: F.when(F.try_parse_json(x).isNotNull() & (x != ""), x)
    return F.coalesce(valid(strip(t)), valid(F.regexp_extract(t, r"(?s)(\{.*\})", 1)), valid(F.regexp_extract(t, r"(?s)(\[.*\])", 1)), t)


def is_write(c: Column | str, words: tuple[str, ...] = WRITE_WORDS) -> Column:
    """True where the text holds a writing keyword as a word, in any case, also inside string literals. Null is not a write."""
    return F.coalesce(_c(c).rlike(rf"(?i)\b({'|'.join(words)})\b"), F.lit(False))


def plain_alternation(c: Column | str) -> Column:
    """Alternatives written ``|:`` as ``|``."""
    return F.replace(_c(c), F.lit("|:"), F.lit("|"))


def preview(c: Column | str, most: int = 1200) -> Column:
    """The first ``most`` characters, with dots where something was cut."""
    return F.when(F.length(_c(c)) > most, F.concat(F.substring(_c(c), 1, most), F.lit("..."))).otherwise(_c(c))


def int_or(c: Column | str, default: int) -> Column:
    """An integer from text; blank and null give the default."""
    return F.coalesce(F.nullif(F.trim(_c(c)), F.lit("")).cast("int"), F.lit(default))


def year_range(first: Column, last: Column) -> Column:
    """``N/A``, one year, or ``a - b``."""
    a, b = F.date_format(first, "yyyy"), F.date_format(last, "yyyy")
    return F.when(a.isNull() | b.isNull(), "N/A").when(a == b, a).otherwise(F.concat(a, F.lit(" - "), b))


def contains_any(text: Column, words: Column) -> Column:
    """True if any non-empty word of the array stands anywhere in the text, case ignored."""
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.coalesce(F.exists(words, lambda w: (w != "") & low.contains(w)), F.lit(False))


def contains_folded(text: Column, part: Column | str) -> Column:
    """Containment with case ignored; a null text contains only the empty string."""
    return F.lower(F.coalesce(text, F.lit(""))).contains(F.lower(part if isinstance(part, Column) else F.lit(part)))


def merged_maps(first: Column | str, then: Column | str) -> Column:
    """Two maps as one; where both have a key, the second one's value holds. A null map counts as empty."""
    a, b = (F.coalesce(_c(m), F.create_map().cast("map<string,string>")) for m in (first, then))
    return F.map_concat(F.map_filter(a, lambda k, _: ~F.map_contains_key(b, k)), b)


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two arrays of double; null where one is null, of another length, or all zero."""
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms)


def cosine_to(a: Column, query: list[float]) -> Column:
    """Cosine of an array of double to a fixed vector, whose length is taken once, here."""
    length = sum(x * x for x in query) ** 0.5
    if not length:
        return F.lit(None).cast("double")
    q = F.array(*(F.lit(x / length) for x in query))
    norm = F.sqrt(dot(a, a))
    return F.when((F.size(a) == len(query)) & (norm > 0), dot(a, q) / norm)
