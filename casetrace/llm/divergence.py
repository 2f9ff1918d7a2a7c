"""Quality rules by distribution divergence, on DataFrame functions only.

Base rules come first: too few words, or too many words in repeated 3-word
windows.  Then two histograms of each text, of character classes and of the
common words of its language, are compared by Jensen-Shannon distance (base 2,
0 to 1) to the reference of that language.  A reference is the sum of the
histograms of *all* documents of the language; a language without a word list
shares one reference with the others of that kind.  A guard keeps short texts:
a histogram is only judged when the text is long enough to fill it.

With ``robust`` a reference is the mean share of each bin over the texts that
pass the base rules, every distinct text once, so neither copies nor long or
broken texts pull it; each value of ``lang`` has its own, listed or not, and a
null ``lang`` has none, so neither distance rejects its texts.  ``op2`` and
the pipeline use it.  Without, a reference is the plain sum.

Result for odd input: a null or blank text has no words and fails the base
rule; a null or unknown language uses the shared reference; repeated rows are
judged alike; an empty table gives no rows; long texts are read whole; other
columns travel along unless they bear a name this operator writes, which is
then replaced.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import frozen, packed, require, unpacked
from casetrace.llm.doc_stats import (CLASS_COLUMNS, share, with_classes, with_repeats, with_words)

# The most common words of each language.
COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "a", "in", "is", "that", "for", "it", "was", "on", "with",
           "as", "be", "at"],
    "de": ["der", "die", "und", "in", "zu", "den", "das", "nicht", "von", "sie", "ist", "des",
           "mit", "dem", "ein", "auf"],
    "fr": ["de", "la", "le", "et", "les", "des", "un", "une", "que", "en", "du", "est", "dans",
           "qui", "par", "avec"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un", "por", "con",
           "una", "es"],
}
OTHERS = "*"
BROADCAST_LANGUAGES = 10_000


@dataclass(frozen=True)
class Limits:
    """Thresholds; the distances are the largest that pass."""

    min_words: int = 50
    max_repeat_percent: int = 50
    class_distance: float = 0.25
    class_min_chars: int = 200
    word_distance: float = 0.27
    word_min_words: int = 100
    words: dict[str, list[str]] = field(default_factory=lambda: dict(COMMON_WORDS))


OUTPUT = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
          "class_distance", "word_distance", "kept"]


def _bins(words: dict[str, list[str]]) -> int:
    return max(map(len, words.values()))


def _language(words: dict[str, list[str]]) -> Column:
    return F.when(F.col("lang").isin(list(words)), F.col("lang")).otherwise(F.lit(OTHERS))


def histograms(docs: DataFrame, words: dict[str, list[str]]) -> DataFrame:
    """Base counts, character-class counts and common-word counts (``w_0``,
    ``w_1``, ...; the rest of the words in ``w_rest``) of every document."""
    out = with_repeats(with_words(with_classes(docs)))
    every = sorted({w for ws in words.values() for w in ws})
    forms = sorted({f for w in every for f in (w, w.capitalize(), w.upper())})
    out = out.withColumn("__common", F.transform(
        F.filter("__words", lambda w: w.isin(forms)), F.lower)).drop("__words")
    lists = F.create_map(*[x for lang, ws in words.items() for x in
                           (F.lit(lang), F.array(*map(F.lit, ws)))])
    out = out.withColumn("__lang", _language(words))
    # an unlisted language has no words of its own: every word counts as the rest
    out = out.withColumn("__list", F.coalesce(
        F.try_element_at(lists, F.col("__lang")), F.array().cast("array<string>")))
    for k in range(_bins(words)):
        out = out.withColumn(f"w_{k}", F.coalesce(
            F.size("__common") - F.size(F.array_remove("__common", F.get("__list", F.lit(k)))),
            F.lit(0)).cast("long"))
    counted = sum((F.col(f"w_{k}") for k in range(_bins(words))), F.lit(0))
    return out.withColumn("w_rest", F.col("n_words") - counted).drop("__common", "__list")


def _literal(reference: dict[str, list[float]], size: int) -> Column:
    """A row's reference out of a few, as a constant."""
    return F.coalesce(*[F.when(F.col("__lang") == lang, F.lit(np.array(v, dtype=np.float64)))
                        for lang, v in reference.items()], F.lit(np.zeros(size)))


def _divergence(counts: list[str], theirs: Column) -> Column:
    """Jensen-Shannon distance of a row's counts to its language's reference.
    As array functions, so that the generated code stays small."""
    held = F.array(*[F.col(c).cast("double") for c in counts])
    total = F.aggregate(held, F.lit(0.0), lambda a, c: a + c)
    own = F.transform(held, lambda c: share(c, total))

    def term(x: Column, p: Column, q: Column) -> Column:
        return F.when(x > 0, x * F.log2(2 * x / (p + q))).otherwise(0.0)

    terms = F.zip_with(own, theirs, lambda p, q: term(p, p, q) + term(q, p, q))
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, t: a + t) / 2, F.lit(0.0)))


def references(stats: DataFrame, columns: list[str]) -> dict[str, dict[str, int]]:
    """Summed histograms per language; at most one row per listed language
    reaches the driver."""
    sums = stats.groupBy("__lang").agg(*[F.sum(c).alias(c) for c in columns])
    return {r["__lang"]: r.asDict() for r in sums.collect()}


def _base_failed(limits: Limits) -> Column:
    return ((F.col("n_words") < limits.min_words) | (
        100 * F.col("n_repeat_words") > limits.max_repeat_percent * F.col("n_words")))


def with_robust_references(stats: DataFrame, source: DataFrame, limits: Limits) -> DataFrame:
    """``stats`` with its language's mean shares in ``__class_ref`` and
    ``__word_ref``, learnt from ``source``, whose rows name their text by
    ``__text``."""
    bins = _bin_columns(limits)
    # no filter before the grouping: it would repeat every expression of the counts
    once = source.withColumn("__failed", _base_failed(limits)).groupBy("lang", "__text").agg(
        F.min("__failed").alias("__failed"), *[F.min(c).alias(c) for c in CLASS_COLUMNS + bins])

    def means(columns: list[str]) -> Column:
        total = sum((F.col(c) for c in columns), F.lit(0))
        return F.array(*[F.avg(share(F.col(c), total)) for c in columns])

    mean = frozen(once.where(~F.col("__failed")).groupBy("lang").agg(
        means(CLASS_COLUMNS).alias("__class_ref"), means(bins).alias("__word_ref")))
    if mean.count() <= BROADCAST_LANGUAGES:
        mean = F.broadcast(mean)
    zeros = {"__class_ref": len(CLASS_COLUMNS), "__word_ref": len(bins)}
    return stats.join(mean, "lang", "left").withColumns(
        {c: F.coalesce(c, F.lit(np.zeros(n))) for c, n in zeros.items()})


def _bin_columns(limits: Limits) -> list[str]:
    return [f"w_{k}" for k in range(_bins(limits.words))] + ["w_rest"]


def _plain(docs: DataFrame, limits: Limits) -> DataFrame:
    require(docs, ["doc_id", "text", "lang"])
    return docs.drop(*OUTPUT, *_bin_columns(limits), *CLASS_COLUMNS, "n_chars_read")


def _with_references(stats: DataFrame, source: DataFrame, limits: Limits,
                     robust: bool) -> DataFrame:
    """``stats`` with the references learnt from ``source``."""
    if robust:
        return with_robust_references(stats, source, limits)
    bins = _bin_columns(limits)
    reference = references(source, CLASS_COLUMNS + bins)

    def normal(columns: list[str]) -> Column:
        return _literal({lang: [r[c] / max(1, sum(r[x] for x in columns)) for c in columns]
                         for lang, r in reference.items()}, len(columns))

    return (stats.withColumn("__class_ref", normal(CLASS_COLUMNS))
            .withColumn("__word_ref", normal(bins)))


def _with_verdict(stats: DataFrame, limits: Limits, robust: bool) -> DataFrame:
    bins = _bin_columns(limits)
    out = (stats.withColumn("base_failed", _base_failed(limits))
           .withColumn("class_distance", _divergence(CLASS_COLUMNS, F.col("__class_ref")))
           .withColumn("word_distance", _divergence(bins, F.col("__word_ref"))))
    strange = (((F.col("n_chars_read") >= limits.class_min_chars)
                & (F.col("class_distance") > limits.class_distance))
               | ((F.col("n_words") >= limits.word_min_words)
                  & (F.col("__lang") != OTHERS) & (F.col("word_distance") > limits.word_distance)))
    if robust:
        strange = strange & F.col("lang").isNotNull()
    return (out.withColumn("kept", ~F.col("base_failed") & ~strange)
            .withColumn("word_chars", F.col("n_chars_read") - F.col("n_space"))
            .withColumn("n_symbols", F.col("n_symbol")))


def judge(docs: DataFrame, limits: Limits | None = None, robust: bool = False) -> DataFrame:
    """``docs`` without the text, with the base counts, ``base_failed``, both
    distances and ``kept``.  The histograms are computed once and frozen."""
    limits = limits or Limits()
    plain = _plain(docs, limits)
    stats = histograms(plain, limits.words)
    if robust:
        stats = stats.withColumn("__text", F.xxhash64("text"))
    stats = frozen(stats.drop("text"))
    return _with_verdict(_with_references(stats, stats, limits, robust), limits, robust).select(
        *plain.drop("text").columns, *OUTPUT)


def keep(docs: DataFrame, limits: Limits | None = None, robust: bool = False) -> DataFrame:
    """``docs`` that pass, with their columns.  The histograms are computed
    twice, for the references and for the verdict, so that no text crosses the
    network."""
    limits = limits or Limits()
    used = ["doc_id", "text", "lang"]
    require(docs, used)
    stats = histograms(packed(docs, used), limits.words)
    referred = _with_references(stats, stats.withColumn("__text", F.xxhash64("text")), limits,
                                robust)
    # the row number keeps the filter above the counts; pushed below them it
    # would repeat every expression it is made of
    judged = _with_verdict(referred, limits, robust).withColumn(
        "__row", F.monotonically_increasing_id())
    return unpacked(judged.where(F.col("kept") & (F.col("__row") >= 0)), docs.columns, used)
