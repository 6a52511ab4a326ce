"""Several values packed into one text field."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Quotes that may enclose a value, as (opening, closing, is a doubled closing quote one quote).
QUOTES = (('"', '"', True), ("'", "'", False), ("“", "”", False))
#: Characters that separate, and the word that separates when it stands between blanks.
SEPARATORS, WORD = "+,;/|&\n\r", "and"


def _cls(chars: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c not in "\n\r" else c for c in chars)


def packed_grammar(separators: str = SEPARATORS, word: str | None = WORD, quotes=QUOTES, brackets: tuple[tuple[str, str], ...] = ()) -> str:
    """The grammar of one value with the separator behind it, as ordered alternatives: quoted, then bracketed, then bare.

    The first alternative that reaches a separator or the end wins. A quote or bracket that is not closed, or that is closed in
    the middle of a value, lets its alternative fail; the parser then goes back to the start of the value and takes it as bare.
    Repetitions are possessive and none nests, so the depth of the match does not grow with the text.
    """
    blank = r"[^\S\n\r]"
    stop = f"[{_cls(separators)}]" + (f"|(?<={blank}){word}(?={blank})" if word else "")
    ahead = rf"(?={blank}*+(?:{stop}|\z))"
    ways = []
    for opening, closing, doubled in quotes:
        o, c = _cls(opening), _cls(closing)
        ways.append(f"{o}[^{c}]*+" + (f"(?:{c}{c}[^{c}]*+)*+" if doubled else "") + f"{c}{ahead}")
    ways += [rf"{_cls(o)}[^{_cls(o + c)}]*+{_cls(c)}{ahead}" for o, c in brackets]
    ways.append(rf"[^{_cls(separators)}]*?(?={stop}|\z)")
    return rf"(?U){blank}*+({'|'.join(ways)}){blank}*?(?:{stop}|\z)"


def split_packed(value: Column | str, separators: str = SEPARATORS, word: str | None = WORD, quotes=QUOTES, brackets: tuple[tuple[str, str], ...] = ()) -> Column:
    """The values of a packed field, as ``array<struct<pos int, value string, kind string, error string>>``.

    ``pos`` counts the non-empty values from 1. ``kind`` is ``quoted``, ``bracketed`` or ``bare``. ``error`` is
    ``malformed_quote`` (or ``malformed_bracket``) where a value opens with one that the grammar could not close, else null; such
    a value is kept as bare text, its quote included. Enclosing quotes and surrounding blanks are dropped, a doubled quote becomes
    one, brackets stay part of the value. Null gives null; empty and blank text, or nothing but separators, an empty array.
    """
    c = F.col(value) if isinstance(value, str) else value
    edge = r"(?U)^\s+|\s+$"
    raw = F.regexp_extract_all(c, F.lit(packed_grammar(separators, word, quotes, brackets)), F.lit(1))

    def entry(item: Column) -> Column:
        text = F.regexp_replace(item, edge, "")
        inner = text.substr(F.lit(2), F.length(text) - 2)
        kind, plain, error = F.lit("bare"), text, F.lit(None).cast("string")
        for opening, closing in brackets:
            shut = text.rlike(f"(?s)^{_cls(opening)}[^{_cls(opening + closing)}]*+{_cls(closing)}$")
            kind = F.when(shut, "bracketed").otherwise(kind)
            error = F.when(text.startswith(opening) & ~shut, "malformed_bracket").otherwise(error)
        for opening, closing, doubled in quotes:
            o, q = _cls(opening), _cls(closing)
            shut = text.rlike(f"(?s)^{o}[^{q}]*+" + (f"(?:{q}{q}[^{q}]*+)*+" if doubled else "") + f"{q}$")
            plain = F.when(shut, F.regexp_replace(F.replace(inner, F.lit(closing * 2), F.lit(closing)) if doubled else inner, edge, "")).otherwise(plain)
            kind = F.when(shut, "quoted").otherwise(kind)
            error = F.when(text.startswith(opening) & ~shut, "malformed_quote").otherwise(error)
        return F.struct(plain.alias("value"), kind.alias("kind"), error.alias("error"))

    kept = F.filter(F.transform(raw, entry), lambda e: e["value"] != "")
    return F.transform(kept, lambda e, i: F.struct((i + 1).cast("int").alias("pos"), e["value"].alias("value"), e["kind"].alias("kind"), e["error"].alias("error")))


def unpack_values(df: DataFrame, value: str, keys: list[str], at_least: int = 1, **grammar) -> DataFrame:
    """One row per value of a packed field: the key columns, ``pos, value, kind, error``. Rows with fewer than ``at_least``
    values give none. No shuffle; rows of any number and repeated rows are handled one by one."""
    parts = df.select(*keys, split_packed(value, **grammar).alias("_parts")).where(F.size("_parts") >= at_least)
    return parts.select(*keys, F.inline("_parts").alias("pos", "value", "kind", "error"))
