"""Queries for similar vectors (p2), splitting (p3), packing (p7), leakage (p8) and text quality (p9) over the test tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import table
from .leakage import LITERALS, RARE, UNITS, find_leaks
from .packing import pack_documents, packing_faults, packing_report
from .quality import CHI2, LEAST_SPREAD, STATS, is_no_prose, quality_outliers
from .splitting import split_records, split_text
from .vectors import nearest_vectors, similar_pairs


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(nearest_vectors(table(spark, sf_dir, "text_node"), "vec_id", "text_embedding", k=10, min_similarity=0.8))


def p2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 most similar nodes, however similar they are, of every node whose id is divisible by 20, against all nodes."""
    near = nearest_vectors(table(spark, sf_dir, "text_node"), "vec_id", "text_embedding", k=10, lists=32, cells=256, query_every=20)
    return near.select(F.col("query").alias("vec_id"), F.col("other").alias("neighbour_id"), F.round("similarity", 3).alias("similarity"))


TEXT_TABLES = ("section", "paragraph", "notes_paragraph")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lambda name: table(spark, sf_dir, name).where(F.size(split_text("text")) > 1).select(F.lit(name).alias("record_type"), "row_id")
    return reduce(DataFrame.unionByName, map(cut, TEXT_TABLES))


def p3_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pieces of all texts of sections, paragraphs and notes, each at most 2,000 characters."""
    cut = lambda name: split_records(table(spark, sf_dir, name), "text", ["row_id"]).select(F.lit(name).alias("record_type"), "*")
    return reduce(DataFrame.unionByName, map(cut, TEXT_TABLES))


def p3_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text put together again from its pieces, and whether all pieces keep the limit and share what they should."""

    def whole(name: str) -> DataFrame:
        kept = table(spark, sf_dir, name).select("row_id", split_text("text").alias("pieces")).where(F.col("pieces").isNotNull())
        again = F.array_join(F.transform("pieces", lambda p: F.substring(p["text"], p["shared"] + 1, p["length"])), "")
        shared = F.forall("pieces", lambda p: ((p["piece"] == 1) & (p["shared"] == 0)) | p["shared"].between(149, 200))
        return kept.select(F.lit(name).alias("record_type"), "row_id", F.md5(again).alias("text_md5"), F.forall("pieces", lambda p: p["length"] <= 2000).alias("within_limit"), shared.alias("overlaps"))

    return reduce(DataFrame.unionByName, map(whole, TEXT_TABLES))


#: Shares of tokens that differ from those of the corpus.
TARGETS = {"notes": 0.25, "guidance": 0.2}


def p7_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a packing to unequal targets, in several shards, has of faults: nothing, with every document placed once."""
    packed = pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", "source", targets=TARGETS, shard_tokens=150_000, window=16)
    return packing_faults(packed, TARGETS, window=16).drop("n_tokens")


def p7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's container of 2,048 tokens, sources balanced at the corpus' own proportions."""
    return pack_documents(table(spark, sf_dir, "documents"), "doc_id", "text", "source")


def p7_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(p7_packing(spark, sf_dir))


def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(table(spark, sf_dir, "documents"), "doc_id", "text", table(spark, sf_dir, "eval_items"), "item_id", "passage")


def p8_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(spark, sf_dir).where(F.col("exact_windows") > 0).select("doc_id", "item_id")


def p8_reparameterised(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents holding an item with other numbers, names or units in its slots, consistently exchanged; see RARE."""
    found = leaks(spark, sf_dir).where(F.col("rare_windows") >= RARE)
    return found.select("doc_id", "item_id", "exact_windows", "swapped_windows", "swapped_slots", F.round("rare_windows", 3).alias("rare_windows"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_outliers(table(spark, sf_dir, "documents"), "text", ["doc_id"], table(spark, sf_dir, "common_words"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark, sf_dir).where(is_no_prose()).select("doc_id")


def p9_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's statistics, distance from its language's prose, and what each statistic adds to the squared distance."""
    plain = [F.round(c, 6).alias(c) for c in ("mean_word_length", "symbol_ratio", "closed_lines", "common_share")]
    parts = [(F.round(f"from_{s}", 3) + 0.0).alias(f"from_{s}") for s in STATS]  # no -0.0
    return quality(spark, sf_dir).select("doc_id", "n_words", *plain, "language", F.round("distance", 4).alias("distance"), *parts)


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p2_nearest, p3_found, p3_pieces, p3_rebuilt, p7_packing, p7_report, p7_faults, p8_found, p8_reparameterised, p9_found, p9_outliers)}


_PAIRS = """
WITH v AS (SELECT vec_id, text_embedding AS e FROM text_node WHERE len(text_embedding) = 128 AND NOT list_contains(list_transform(text_embedding, lambda x: coalesce(isfinite(x), false)), false)
             AND list_contains(list_transform(text_embedding, lambda x: x <> 0), true)),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS c FROM v a JOIN v b ON a.vec_id <> b.vec_id),
r AS (SELECT a, b, c, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS k FROM s WHERE c >= 0.80)
SELECT DISTINCT least(a, b) AS vec_id_a, greatest(a, b) AS vec_id_b FROM r WHERE k <= 10
"""
# the operator's fixed point of 1 / 32767, since neighbours a hair apart may change places in it
_NEAREST = """
WITH v AS (SELECT vec_id, list_transform(text_embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM text_node WHERE vec_id IS NOT NULL AND len(text_embedding) = 128
  AND NOT list_contains(list_transform(text_embedding, lambda x: coalesce(isfinite(x), false)), false) AND list_contains(list_transform(text_embedding, lambda x: x <> 0), true)),
u AS (SELECT vec_id, list_transform(e, lambda x: x / sqrt(list_sum(list_transform(e, lambda y: y * y)))) AS e FROM v),
c AS (SELECT vec_id, list_transform(e, lambda x: round(x * 32767) / 32767) AS e FROM u),
s AS (SELECT a.vec_id, b.vec_id AS neighbour_id, list_dot_product(a.e, b.e) AS similarity FROM c a JOIN c b ON a.vec_id <> b.vec_id WHERE a.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY similarity DESC, neighbour_id) AS k FROM s)
SELECT vec_id, neighbour_id, CAST(round(similarity, 3) AS FLOAT) AS similarity FROM r WHERE k <= 10
"""
_LONG = " UNION ALL ".join(f"SELECT '{t}' AS record_type, row_id FROM {t} WHERE length(text) > 2000" for t in TEXT_TABLES)

_BLANK = r"[\s\x{00a0}]"
_PROSE = rf"""
WITH cw AS (SELECT list(word) FILTER (WHERE lang = 'en') AS en, list(word) FILTER (WHERE lang = 'cy') AS cy FROM common_words),
t AS (SELECT doc_id, coalesce(text, '') AS text, list_filter(string_split_regex(coalesce(text, ''), '{_BLANK}+'), lambda w: w <> '') AS ws FROM documents),
u AS (SELECT doc_id, text, ws, len(ws) AS n, regexp_replace(text, '{_BLANK}+', '', 'g') AS solid, list_transform(ws, lambda w: regexp_replace(lower(w), '^[^\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}]+$', '', 'g')) AS bare,
  list_filter(list_transform(string_split(text, chr(10)), lambda l: regexp_replace(l, '^{_BLANK}+|{_BLANK}+$', '', 'g')), lambda l: l <> '') AS ls FROM t),
s AS (SELECT doc_id, n, length(solid) / n AS mean, length(regexp_replace(solid, '[\p{{L}}\p{{N}}]', '', 'g')) / length(solid) AS symbols,
  len(list_filter(ls, lambda l: regexp_matches(l, '[.!?;:]["'')\]}}”’»]*$'))) / len(ls) AS closed,
  len(list_filter(bare, lambda w: list_contains(en, w))) AS en_hits, len(list_filter(bare, lambda w: list_contains(cy, w))) AS cy_hits, greatest(en_hits, cy_hits) / n AS common FROM u, cw WHERE n > 0)
"""
_PROSE_STATS = _PROSE + """, st AS (SELECT u.doc_id, u.n AS n_words, coalesce(mean, 0.0) AS mean_word_length, coalesce(symbols, 0.0) AS symbol_ratio, coalesce(closed, 0.0) AS closed_lines, coalesce(common, 0.0) AS common_share,
  CASE WHEN cy_hits > 0 AND cy_hits >= en_hits THEN 'cy' WHEN en_hits > 0 THEN 'en' END AS language FROM u LEFT JOIN s USING (doc_id))
"""
_PROSE += """SELECT doc_id FROM u WHERE n < 30
UNION ALL
SELECT doc_id FROM s WHERE n >= 30 AND CAST(mean < 3.0 OR mean > 8.5 AS INTEGER) + CAST(symbols > 0.10 AS INTEGER) + CAST(closed < 0.5 AS INTEGER) + CAST(common < 0.20 AS INTEGER) >= 2
"""
# full-width forms stand for NFKC here: no others occur in the tables
_WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_FOLD = lambda c: f"lower(translate({c}, '{_WIDE}', '{''.join(chr(ord(w) - 0xFEE0) for w in _WIDE).replace(chr(39), chr(39) * 2)}'))"
_GRAMS = rf"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex({_FOLD("text")}, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, list_filter(string_split_regex({_FOLD("passage")}, '[^\p{{L}}\p{{N}}]+'), lambda w: w <> '') AS w FROM eval_items WHERE passage IS NOT NULL),
dg AS (SELECT doc_id, array_to_string(w[k : k + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 13) x),
ig AS (SELECT item_id, array_to_string(w[k : k + 12], ' ') AS g FROM (SELECT item_id, w, unnest(range(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 13) x)
SELECT DISTINCT doc_id, item_id FROM dg JOIN ig ON dg.g = ig.g
"""


def _windows(name: str, source: str, key: str, text: str) -> str:
    """Template windows of a table: ``id, k, key, ws``; kinds a (template), b (plain words) and c (template of the widened window)."""
    template = f"CASE WHEN regexp_matches(x, '\\p{{N}}') THEN '<num>' WHEN x IN ({', '.join(repr(u) for u in sorted(UNITS))}) THEN '<unit>' WHEN list_contains(o, x) THEN x ELSE '<name>' END"
    words = rf"list_filter(string_split_regex({_FOLD(text)}, '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '')"
    return rf"""{name}0 AS (SELECT DISTINCT {key} AS id, {words} AS w FROM {source} WHERE {text} IS NOT NULL AND {key} IS NOT NULL),
{name}1 AS (SELECT id, w, list_transform(w, lambda x: {template}) AS t FROM {name}0, vocabulary),
{name}2 AS (SELECT *, list_filter(range(1, len(w) + 1), lambda i: NOT starts_with(t[i], '<')) AS lits FROM {name}1),
{name}3 AS (SELECT *, unnest(range(1, len(w) - 11)) AS k FROM {name}2 WHERE len(w) >= 13),
{name}4 AS (SELECT *, len(list_filter(lits, lambda i: i < k)) AS c, len(list_filter(lits, lambda i: i >= k AND i < k + 13)) AS n FROM {name}3),
{name} AS (SELECT id, k, 'a' || array_to_string(t[k : k + 12], ' ') AS key, w[k : k + 12] AS ws FROM {name}4 WHERE n >= {LITERALS}
  UNION ALL SELECT id, k, 'b' || array_to_string(w[k : k + 12], ' '), w[k : k + 12] FROM {name}4 WHERE n < {LITERALS}
  UNION ALL SELECT id, k, 'c' || array_to_string(t[k : lits[c + {LITERALS}]], ' '), w[k : lits[c + {LITERALS}]] FROM {name}4 WHERE n < {LITERALS} AND len(lits) >= c + {LITERALS})"""


_RAW = f"translate(passage, '{_WIDE}', '{''.join(chr(ord(w) - 0xFEE0) for w in _WIDE).replace(chr(39), chr(39) * 2)}')"
_SWAPS = rf"""
WITH vocabulary AS (SELECT list(DISTINCT x) AS o FROM (SELECT unnest(string_split_regex({_RAW}, '[^\p{{L}}\p{{N}}]+')) AS x FROM eval_items) y WHERE x <> '' AND x = lower(x) AND NOT regexp_matches(x, '\p{{N}}')),
{_windows("dw", "documents", "doc_id", "text")},
{_windows("iw", "eval_items", "item_id", "passage")},
shared AS (SELECT key, count(DISTINCT id) AS n FROM iw GROUP BY key),
met AS (SELECT d.id AS doc_id, i.id AS item_id, d.k - i.k AS shift, i.k AS q, 1.0 / s.n AS rare, i.ws = d.ws AS same, i.ws AS a, d.ws AS b,
  list_transform(range(1, len(i.ws) + 1), lambda j: i.ws[j] || ' ' || d.ws[j]) AS pairs FROM dw d JOIN iw i ON d.key = i.key JOIN shared s ON s.key = i.key),
fit AS (SELECT *, list_filter(pairs, lambda p: split_part(p, ' ', 1) <> split_part(p, ' ', 2)) AS slots FROM met
  WHERE len(list_distinct(pairs)) = len(list_distinct(a)) AND len(list_distinct(pairs)) = len(list_distinct(b))),
each AS (SELECT doc_id, item_id, shift, q, max(CAST(same AS INTEGER)) AS same, max(rare) AS rare, flatten(list(slots)) AS slots FROM fit GROUP BY doc_id, item_id, shift, q),
line AS (SELECT doc_id, item_id, sum(same) AS e, sum(1 - same) AS s, sum(CASE WHEN same = 0 THEN rare ELSE 0 END) AS r, len(list_distinct(flatten(list(slots)))) AS n FROM each GROUP BY doc_id, item_id, shift)
SELECT doc_id, item_id, CAST(sum(e) AS INTEGER) AS exact_windows, CAST(sum(s) AS INTEGER) AS swapped_windows, CAST(max(n) AS INTEGER) AS swapped_slots, round(CAST(sum(r) AS DOUBLE), 3) AS rare_windows
FROM line GROUP BY doc_id, item_id HAVING sum(r) >= {RARE}
"""


_REBUILT = " UNION ALL ".join(f"SELECT '{t}' AS record_type, row_id, md5(text) AS text_md5, true AS within_limit, true AS overlaps FROM {t} WHERE text IS NOT NULL" for t in TEXT_TABLES)
_FAULTLESS = "SELECT count(*) AS n_docs, " + ", ".join(f"CAST(0 AS BIGINT) AS {c}" for c in ("needless_cuts", "over_capacity", "misplaced", "off_target")) + " FROM documents"


def _outlier_sql() -> str:
    """Robust distances with the covariance taken apart into triangles by hand."""
    n, floor = len(STATS), LEAST_SPREAD
    each = lambda f: ", ".join(f(i) for i in range(n))
    lower = [(i, j) for i in range(n) for j in range(i + 1)]
    steps = [
        f"x AS (SELECT doc_id, n_words, mean_word_length, symbol_ratio, closed_lines, common_share, language, ln(1 + n_words) AS x0, mean_word_length AS x1, symbol_ratio AS x2, closed_lines AS x3, common_share AS x4 FROM st)",
        "fine AS (SELECT * FROM x WHERE n_words > 0 AND language IS NOT NULL)",
        f"med AS (SELECT language, {each(lambda i: f'quantile_disc(x{i}, 0.5) AS m{i}')} FROM fine GROUP BY language)",
        f"mad AS (SELECT language, {each(lambda i: f'quantile_disc(abs(x{i} - m{i}), 0.5) AS s{i}')} FROM fine JOIN med USING (language) GROUP BY language)",
        f"k0 AS (SELECT language, {each(lambda i: f'm{i}')}, {', '.join(f'greatest(1.4826 * s{i}, {floor[i]}) AS l{i}{j}' if i == j else f'0.0 AS l{i}{j}' for i, j in lower)} FROM med JOIN mad USING (language))",
    ]

    def solved(model: str, out: str, rows: str) -> list[str]:
        """z with L z = x - m, one CTE for each row."""
        made, last = [], f"(SELECT r.*, {each(lambda i: f'm{i}')}, {', '.join(f'l{i}{j}' for i, j in lower)} FROM {rows} r JOIN {model} USING (language))"
        for i in range(n):
            name = f"{out}{i}"
            made.append(f"{name} AS (SELECT *, (x{i} - m{i}{''.join(f' - l{i}{j} * z{j}' for j in range(i))}) / l{i}{i} AS z{i} FROM {last} q{i})")
            last = name
        return made

    for r in range(3):
        steps += solved(f"k{r}", f"e{r}_", "fine")
        cov = ", ".join(f"sum(x{i} * x{j}) / count(*) - avg(x{i}) * avg(x{j}){f' + {floor[i] ** 2!r}' if i == j else ''} AS a{i}{j}" for i, j in lower)
        steps.append(f"c{r} AS (SELECT language, count(*) AS n, {each(lambda i: f'avg(x{i}) AS m{i}')}, {cov} FROM e{r}_{n - 1} WHERE {' + '.join(f'z{i} * z{i}' for i in range(n))} < {CHI2} GROUP BY language HAVING count(*) > {10 * n})")
        last = f"c{r}"
        for j in range(n):
            steps.append(f"d{r}_{j} AS (SELECT *, sqrt(a{j}{j}{''.join(f' - l{j}{k} * l{j}{k}' for k in range(j))}) AS l{j}{j} FROM {last})")
            below = [f"(a{i}{j}{''.join(f' - l{i}{k} * l{j}{k}' for k in range(j))}) / l{j}{j} AS l{i}{j}" for i in range(j + 1, n)]
            last = f"d{r}_{j}"
            if below:
                steps.append(f"f{r}_{j} AS (SELECT *, {', '.join(below)} FROM {last})")
                last = f"f{r}_{j}"
        columns = f"{each(lambda i: f'm{i}')}, {', '.join(f'l{i}{j}' for i, j in lower)}"
        steps.append(f"k{r + 1} AS (SELECT language, {columns} FROM {last} UNION ALL SELECT language, {columns} FROM k{r} WHERE language NOT IN (SELECT language FROM {last}))")
    steps += solved("k3", "g", "(SELECT * FROM x WHERE language IS NOT NULL)")
    last = f"g{n - 1}"
    for i in reversed(range(n)):  # and L' p = z
        steps.append(f"h{i} AS (SELECT *, (z{i}{''.join(f' - l{j}{i} * p{j}' for j in range(i + 1, n))}) / l{i}{i} AS p{i} FROM {last})")
        last = f"h{i}"
    parts = each(lambda i: f"round(h.p{i} * (x.x{i} - h.m{i}), 3) + 0.0 AS from_{STATS[i]}")
    return f"""{_PROSE_STATS}, {", ".join(steps)}
SELECT x.doc_id, x.n_words, round(x.mean_word_length, 6) AS mean_word_length, round(x.symbol_ratio, 6) AS symbol_ratio, round(x.closed_lines, 6) AS closed_lines, round(x.common_share, 6) AS common_share,
x.language, round(sqrt({" + ".join(f"h.z{i} * h.z{i}" for i in range(n))}), 4) AS distance, {parts} FROM x LEFT JOIN h0 h USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"p2_found": _PAIRS, "p2_nearest": _NEAREST, "p3_found": _LONG, "p3_rebuilt": _REBUILT, "p7_faults": _FAULTLESS, "p9_outliers": _outlier_sql(), "p8_found": _GRAMS, "p8_reparameterised": _SWAPS, "p9_found": _PROSE}
