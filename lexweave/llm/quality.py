"""Per-document text quality statistics and how far each document is from prose of its language."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

#: The statistics, in the order of the model's rows.
STATS = ("log_words", "mean_word_length", "symbol_ratio", "closed_lines", "common_share")
#: Punctuation that ends a line of prose, and closing marks that may follow it.
ENDS, CLOSERS = r"[.!?;:]", "[\"')\\]}”’»]"
#: Most common words, all languages together: every task holds them, so a longer list is refused with an error.
MOST_WORDS = 200_000
#: Least spread of each statistic, in the order of STATS: what a text of some twenty words or lines can't tell apart. A statistic that
#: hardly varies in a language must not decide alone.
LEAST_SPREAD = (0.05, 0.05, 0.002, 0.02, 0.01)
#: 0.975 quantile of the chi-squared distribution with 5 degrees of freedom: squared distances below it count as prose.
CHI2 = 12.8325


def word_lists(common: DataFrame, most: int = MOST_WORDS) -> dict[str, list[str]]:
    """Common words per language. The table is held by every task, so its size is checked."""
    rows = common.where(F.col("lang").isNotNull() & F.col("word").isNotNull()).select("lang", "word").distinct().limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} common words")
    out: dict[str, list[str]] = {}
    for r in sorted(rows):
        out.setdefault(r["lang"], []).append(r["word"])
    return out


def text_statistics(documents: DataFrame, text: str, keep: list[str], common: dict[str, list[str]]) -> DataFrame:
    """The ``keep`` columns with ``n_words, mean_word_length, symbol_ratio, closed_lines, common_share, language``.

    Words stand between Unicode white space. ``symbol_ratio``: characters neither letter, digit nor white space, among those not
    white space. ``closed_lines``: share of non-blank lines that end in punctuation, closing marks behind it ignored.
    ``common_share``: the largest share, over the languages of ``common``, of words found in its list after lower-casing and
    stripping other characters at both ends; ``language`` is that language (the first by name on a tie, null if no word is found).
    Null and empty texts have no words; their other statistics are 0. All in the JVM, no shuffle.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    count = lambda pattern: F.regexp_count(t, F.lit(pattern))
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    solid = F.length(F.regexp_replace(t, r"(?U)\s+", ""))
    # what parts two words takes the marks at their ends with it, so every word is plain at once
    words = F.split(F.concat(F.lit(" "), F.lower(t), F.lit(" ")), r"(?U)[^\p{L}\p{N}\s]*+\s[^\p{L}\p{N}]*+")

    def found(listed: list[str]) -> Column:
        return F.size(F.filter(F.col("_words"), lambda w: w.isin(listed))).cast("double")

    known = {lang: found(ws) for lang, ws in sorted(common.items())}
    base = documents.select(
        *keep, count(r"(?U)\S+").cast("long").alias("n_words"), solid.alias("_solid"), count(r"(?U)[^\p{L}\p{N}\s]").alias("_symbols"),
        count(r"(?Umd)^[^\S\n]*+\S").alias("_lines"), count(rf"(?Umd){ENDS}{CLOSERS}*+[^\S\n]*+$").alias("_closed"), words.alias("_words"),
    )
    hits = base.select("*", *(n.alias(f"_hits{i}") for i, n in enumerate(known.values())))
    most = F.greatest(*(F.col(f"_hits{i}") for i in range(len(known))), F.lit(0.0)) if known else F.lit(0.0)
    language = F.lit(None).cast("string")
    for i, lang in reversed(list(enumerate(known))):
        language = F.when((most > 0) & (F.col(f"_hits{i}") == most), lang).otherwise(language)
    n = F.col("n_words")
    return hits.select(
        *keep, "n_words", share(F.col("_solid"), n).alias("mean_word_length"), share(F.col("_symbols"), F.col("_solid")).alias("symbol_ratio"),
        share(F.col("_closed"), F.col("_lines")).alias("closed_lines"), share(most, n).alias("common_share"), language.alias("language"),
    )


def _vector() -> list[Column]:
    return [F.log1p("n_words"), *(F.col(c) for c in STATS[1:])]


def fit_prose(stats: DataFrame, rounds: int = 3, least_spread: tuple[float, ...] = LEAST_SPREAD) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """Robust mean and inverse covariance of the statistics per language, over all documents.

    Starts from medians and median absolute deviations, then concentrates: in each round the mean and covariance are taken over
    the documents closer than the 0.975 chi-squared quantile to the last fit. Each round is one aggregation with map-side sums;
    only a few numbers per language reach the driver. Documents without words or language take no part.
    """
    v = _vector()
    rows = stats.where((F.col("n_words") > 0) & F.col("language").isNotNull()).select("language", *(x.alias(f"x{i}") for i, x in enumerate(v)))
    names = [f"x{i}" for i in range(len(v))]
    middle = {r[0]: np.array(r[1:], float) for r in rows.groupBy("language").agg(*(F.percentile_approx(c, 0.5, 2000).alias(c) for c in names)).collect()}
    if not middle:
        return {}

    def by_language(values: dict[str, np.ndarray], i: int) -> Column:
        out = F.lit(None).cast("double")
        for lang, x in values.items():
            out = F.when(F.col("language") == lang, float(x[i])).otherwise(out)
        return out

    off = rows.groupBy("language").agg(*(F.percentile_approx(F.abs(F.col(c) - by_language(middle, i)), 0.5, 2000).alias(c) for i, c in enumerate(names)))
    floor = np.array(least_spread)
    spread = {r[0]: np.maximum(1.4826 * np.array(r[1:], float), floor) for r in off.collect()}
    model = {lang: (middle[lang], np.diag(spread[lang] ** -2.0)) for lang in middle}
    pairs = [(i, j) for i in range(len(v)) for j in range(i, len(v))]
    for _ in range(rounds):
        near = rows.where(distance(model, [F.col(c) for c in names])[0] < CHI2)
        sums = near.groupBy("language").agg(F.count(F.lit(1)).alias("n"), *(F.sum(c) for c in names), *(F.sum(F.col(names[i]) * F.col(names[j])) for i, j in pairs)).collect()
        for r in sums:
            n, s, q = r[1], np.array(r[2 : 2 + len(v)], float), np.array(r[2 + len(v) :], float)
            if n > 10 * len(v):
                mean = s / n
                cov = np.zeros((len(v), len(v)))
                for (i, j), x in zip(pairs, q, strict=True):
                    cov[i, j] = cov[j, i] = x / n - mean[i] * mean[j]
                model[r[0]] = (mean, np.linalg.inv(cov + np.diag(floor**2)))
    return model


def distance(model: dict[str, tuple[np.ndarray, np.ndarray]], v: list[Column]) -> tuple[Column, list[Column]]:
    """Squared Mahalanobis distance from the document's language, and what each statistic contributes: (x - m)_i * (P (x - m))_i; the
    contributions add up to the squared distance. Null for languages without a model."""
    parts = []
    for i in range(len(v)):
        part = F.lit(None).cast("double")
        for lang, (mean, inverse) in model.items():
            d = [x - float(m) for x, m in zip(v, mean, strict=True)]
            pull = sum((float(inverse[i, j]) * d[j] for j in range(1, len(v))), float(inverse[i, 0]) * d[0])
            part = F.when(F.col("language") == lang, d[i] * pull).otherwise(part)
        parts.append(part)
    return sum(parts[1:], parts[0]), parts


def quality_outliers(documents: DataFrame, text: str, keep: list[str], common: DataFrame, rounds: int = 3, least_spread: tuple[float, ...] = LEAST_SPREAD) -> DataFrame:
    """Every document's statistics, its ``distance`` from the prose of its language (robust Mahalanobis distance) and each statistic's
    contribution to the squared distance (``from_<statistic>``).

    The language is the one whose common words the text holds most of, so wrong or missing language labels do no harm. Documents
    without words, or without any common word, have no language and a null distance: they are no prose of any. A model needs more
    than 50 documents near its centre; below that it rests on medians alone. Every input row gives one row. An empty table gives none.
    """
    stats = cut_lineage(text_statistics(documents, text, keep, word_lists(common)))  # a few numbers for each document; texts are read once
    model = fit_prose(stats, rounds, least_spread)
    d2, parts = distance(model, _vector()) if model else (F.lit(None).cast("double"), [F.lit(None).cast("double")] * len(STATS))
    return stats.select("*", F.when(d2.isNotNull(), F.sqrt(F.greatest(d2, F.lit(0.0)))).alias("distance"), *(p.alias(f"from_{s}") for p, s in zip(parts, STATS, strict=True)))


def is_no_prose() -> Column:
    """The rule on a document's statistics: fewer than 30 words, or at least two of: words too short or too long on average, too many
    symbols, too few closed lines, too few common words."""
    signs = [(F.col("mean_word_length") < 3.0) | (F.col("mean_word_length") > 8.5), F.col("symbol_ratio") > 0.10, F.col("closed_lines") < 0.5, F.col("common_share") < 0.20]
    return (F.col("n_words") < 30) | (sum((s.cast("int") for s in signs[1:]), signs[0].cast("int")) >= 2)
