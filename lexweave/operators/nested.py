"""Deeply nested semi-structured records as related flat tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: A field name counts as a level when one of these hold it; leaves keep their JSON text otherwise.
LIST_KINDS = ("array", "object", "packed")


# The expressions below are SQL text: a walk over many levels and fields is then one call to the parser instead of thousands of calls
# that each build one node of it.


def quoted(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def is_object(v: str) -> str:
    """True for a variant that holds an object. Read as a struct of one field that need not be there, so nothing is copied."""
    return f"(try_variant_get({v}, '$', 'struct<`_`:variant>') IS NOT NULL)"


def parse_records(df: DataFrame, key: Column, text: str) -> DataFrame:
    """Rows ``_key, _v`` with each record as a variant, for the texts that are exactly one JSON object; all others are left out."""
    t = F.trim(F.col(text), F.lit(" \t\n\r"))
    # inside a list, anything behind the first value is an error instead of being passed over
    whole = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))), "$", "array<variant>")
    # explode keeps the parsed list as a column: without it every later use would parse again
    parsed = df.where(t.startswith("{") & t.endswith("}")).select(key.alias("_key"), F.explode(F.array(whole)).alias("_whole"))
    return parsed.where(F.size("_whole") == 1).select("_key", F.explode("_whole").alias("_v"))


def field_of(v: str, name: str, kind: str) -> str:
    """A field of an object read as a type. Names that hold both kinds of quotes can't stand in a path and go through a map."""
    if "'" in name and '"' in name:
        inner = f"try_element_at(try_variant_get({v}, '$', 'map<string,variant>'), {quoted(name)})"
        return inner if kind == "variant" else f"try_variant_get({inner}, '$', {quoted(kind)})"
    mark = '"' if "'" in name else "'"
    return f"try_variant_get({v}, {quoted(f'$[{mark}{name}{mark}]')}, {quoted(kind)})"


def as_list(v: str, name: str) -> str:
    """A field as ``array<variant>``: a list as it is, a lone object as a list of one, text holding a JSON list as that list;
    anything else (null, numbers, other text) is null."""
    packed = f"try_variant_get(try_parse_json({field_of(v, name, 'string')}), '$', 'array<variant>')"
    alone = f"CASE WHEN {field_of(v, name, 'struct<`_`:variant>')} IS NOT NULL THEN array({field_of(v, name, 'variant')}) END"
    return f"coalesce({field_of(v, name, 'array<variant>')}, {alone}, {packed})"


def infer_schema(df: DataFrame, text: str) -> DataFrame:
    """The merged schema of all records: ``path, field, kind, n_records``. ``path`` names the levels down to the objects that
    hold the field (``parts.chapters``; empty for the record itself); ``kind`` is ``array``, ``object``, ``packed`` (text holding a JSON
    list), ``text``, ``number``, ``boolean`` or ``null``. Partitions merge their own records first, so only distinct
    (path, field, kind) triples are shuffled. Damaged and null records add nothing; a record nested more than 1,000 deep counts as
    damaged here and in ``flatten_nested``, since no JSON reader of Spark takes it."""

    def merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[tuple[str, str, str], int] = {}

        def kind_of(value: object) -> tuple[str, object]:
            if isinstance(value, str):
                if value.lstrip()[:1] == "[":
                    try:
                        unpacked = json.loads(value)
                    except ValueError:
                        return "text", value
                    if isinstance(unpacked, list):
                        return "packed", unpacked
                return "text", value
            if isinstance(value, bool):
                return "boolean", value
            if value is None:
                return "null", value
            return {dict: "object", list: "array"}.get(type(value), "number"), value

        for batch in batches:
            for record in batch["record"]:
                try:
                    root = json.loads(record) if record else None
                except (ValueError, RecursionError):
                    continue
                stack, found = [("", root)] if isinstance(root, dict) else [], set()
                while stack:
                    path, node = stack.pop()
                    for field, value in node.items():
                        kind, value = kind_of(value)
                        found.add((path, field, kind))
                        below = f"{path}.{field}" if path else field
                        inside = value if kind in ("array", "packed") else [value] if kind == "object" else []
                        stack += [(below, x) for x in inside if isinstance(x, dict)]
                for triple in found:
                    seen[triple] = seen.get(triple, 0) + 1
        yield pd.DataFrame([(*k, n) for k, n in seen.items()], columns=["path", "field", "kind", "n"])

    parts = df.select(F.col(text).alias("record")).mapInPandas(merged, "path string, field string, kind string, n long")
    return parts.groupBy("path", "field", "kind").agg(F.sum("n").alias("n_records"))


def nested_levels(schema: DataFrame, under: str, names: list[str] | None = None) -> dict[str, list[str]]:
    """The levels to explode below the field ``under``: level path -> its plain fields, parents before children. With ``names``,
    only levels that lead to one of these fields. Only rows below ``under`` reach the driver, one for each field, whatever the number of
    records. Levels are told apart by their names, so a name holding a dot must not stand among them."""
    whole = F.when(F.col("path") == "", F.col("field")).otherwise(F.concat("path", F.lit("."), "field"))
    rows = schema.withColumn("whole", whole).where((F.col("whole") == under) | F.col("whole").startswith(f"{under}.")).select("path", "field", "kind", "whole").distinct().collect()
    levels = {r["whole"] for r in rows if r["kind"] in LIST_KINDS}
    if names is not None:
        levels = {p for p in levels if any((q == p or q.startswith(p + ".")) and q.rsplit(".", 1)[-1] in names for q in levels)}
    fields: dict[str, set[str]] = {p: set() for p in levels}
    for r in rows:
        if r["path"] in levels and r["whole"] not in levels:
            fields[r["path"]].add(r["field"])
    return {p: sorted(fields[p]) for p in sorted(levels, key=lambda p: (p.count("."), p))}


def flatten_long(df: DataFrame, key: str, text: str, levels: list[str], keep_objects: bool = True) -> DataFrame:
    """All objects of all levels in one frame: the record key, ``level, ordinal, node_path, parent_path`` and, unless left out, the
    ``object`` itself.

    Each record is parsed once. One expression walks its levels, the list of every level exploded inside the record, with path and
    ordinal carried down; one explode at the end makes the rows. One scan, no join, no shuffle. A null or non-object entry gives no
    row but keeps its index. Damaged, null and empty records give no rows.
    """
    fields = ["level", "ordinal", "node_path", "parent_path", *(["object"] if keep_objects else [])]
    kinds = dict.fromkeys(fields, "string") | {"ordinal": "int", "object": "variant"}
    nothing = f"CAST(array() AS array<struct<{','.join(f'{c}:{kinds[c]}' for c in fields)}>>)"

    def below(v: str, path: str, above: str, depth: int) -> list[str]:
        found = []
        for level in (p for p in levels if p.rpartition(".")[0] == above):
            name, x, i = level.rpartition(".")[2], f"x{depth}", f"i{depth}"
            here = f"concat({path}, {quoted(('/' if above else '') + name + '/')}, {i})"
            values = [quoted(level), i, here, path, x]
            own = f"array(named_struct({', '.join(f'{quoted(c)}, {val}' for c, val in zip(fields, values, strict=False))}))"
            inner = f"concat({', '.join([own, *below(x, here, level, depth + 1)])})"
            found.append(f"coalesce(flatten(transform({as_list(v, name)}, ({x}, {i}) -> CASE WHEN {is_object(x)} THEN {inner} ELSE {nothing} END)), {nothing})")
        return found

    roots = F.expr(f"concat({', '.join([nothing, *below('_v', quoted(''), '', 0)])})")
    rows = parse_records(df, F.col(key), text).select(F.col("_key").alias(key), F.explode(roots).alias("_n"))
    return rows.select(key, *(F.col(f"_n.{c}").alias(c) for c in fields))


def surrogate(key: str, path: Column) -> Column:
    """A 128-bit key of a node: its record and its path, as 32 hex digits. Collisions aren't to be expected at any number of nodes."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), path))


def level_table(long: DataFrame, key: str, level: str, fields: list[str]) -> DataFrame:
    """One level as a flat table: the record key, ``node_id, parent_id`` (surrogate keys; the parent of a top-level object is its
    record), ``ordinal`` (index in the list as stored, from 0), ``node_path, parent_path`` and the level's plain fields as text, each
    named ``f_<field>`` so that no field can clash with these."""
    plain = [F.expr(field_of("object", f, "string")).alias(f"f_{f}") for f in fields]
    own, up = surrogate(key, F.col("node_path")).alias("node_id"), surrogate(key, F.col("parent_path")).alias("parent_id")
    return long.where(F.col("level") == level).select(key, own, up, "ordinal", "node_path", "parent_path", *plain)


def flatten_nested(df: DataFrame, key: str, text: str, levels: dict[str, list[str]], written: bool = False) -> dict[str, DataFrame]:
    """One table per level; see ``level_table``. Each table alone is one scan, of its own level and those above. To use several, ask for
    ``written``: all levels are then flattened in one pass, kept in the shared folder by level, and every table reads only its own."""
    if written:
        long = cut_lineage(flatten_long(df, key, text, list(levels)).withColumn("object", F.to_json("object")), by=["level"])
        long = long.withColumn("object", F.try_parse_json("object"))
        return {p: level_table(long, key, p, fields) for p, fields in levels.items()}
    lead = lambda p: [q for q in levels if p == q or p.startswith(f"{q}.")]
    return {p: level_table(flatten_long(df, key, text, lead(p)), key, p, fields) for p, fields in levels.items()}


def node_table(df: DataFrame, key: str, text: str, levels: dict[str, list[str]], names: dict[str, str]) -> DataFrame:
    """All objects of the levels whose last step is in ``names`` (field -> node type): key, ``node_type, parent_path, node_path``. Where
    there is no such level, the result is empty."""
    found = flatten_long(df, key, text, list(levels), keep_objects=False)
    last = F.element_at(F.split("level", r"\."), -1)
    kind = F.element_at(F.create_map(*(F.lit(x) for pair in names.items() for x in pair)), last)
    return found.where(last.isin(*names)).select(key, kind.alias("node_type"), "parent_path", "node_path")


def empty_level(df: DataFrame, key: str) -> DataFrame:
    """A level table without rows and without fields of its own."""
    text = F.lit("")
    return df.limit(0).select(key, text.alias("node_id"), text.alias("parent_id"), F.lit(0).alias("ordinal"), text.alias("node_path"), text.alias("parent_path"))
