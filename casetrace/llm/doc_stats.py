"""Statistics of whole texts on DataFrame functions: no shuffle, no Python.

Every count is taken in the row.  Character classes are counted by stripping
one class after the other, so each pass reads only what the last one left.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import SPACE, words_of

# Character classes, in the order they are stripped.
CLASSES = (
    ("lower", "[a-z]+"),
    ("space", SPACE),
    ("other_script", r"[^\x00-\x7F]+"),
    ("upper", "[A-Z]+"),
    ("sentence", r"[.,;:!?'\"()\-]+"),
    ("symbol", r"[#*$%&|<>]+"),
    ("digit", "[0-9]+"),
)
CLASS_COLUMNS = [f"n_{name}" for name, _ in CLASSES] + ["n_rest"]


def with_classes(df: DataFrame, text: str = "text") -> DataFrame:
    """Add a count of characters per class and ``n_chars``."""
    out = df.withColumn("__rest", F.coalesce(F.col(text), F.lit("")))
    out = out.withColumn("n_chars_read", F.length("__rest").cast("long"))
    for name, pattern in CLASSES:
        out = (out.withColumn("__left", F.regexp_replace("__rest", pattern, ""))
               .withColumn(f"n_{name}", (F.length("__rest") - F.length("__left")).cast("long"))
               .withColumn("__rest", F.col("__left")).drop("__left"))
    return out.withColumn("n_rest", F.length("__rest").cast("long")).drop("__rest")


def with_words(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``__words``, ``n_words`` and ``n_dup_lines`` (lines with a word that
    equal an earlier line)."""
    lines = F.filter(F.split(F.coalesce(F.col(text), F.lit("")), "\n"),
                     lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    out = df.withColumn("__words", words_of(F.col(text))).withColumn("__lines", lines)
    return (out.withColumn("n_words", F.size("__words").cast("long"))
            .withColumn("n_dup_lines", (F.size("__lines") - F.size(F.array_distinct("__lines")))
                        .cast("long")).drop("__lines"))


def with_repeats(df: DataFrame) -> DataFrame:
    """Add ``n_repeat_words``: words inside 3-word windows that occur twice or
    more in the text (the first occurrence included).

    Windows are compared by a 64-bit hash.  Sorting (hash, place) pairs puts
    equal windows side by side, so a long text costs n log n; texts without a
    repeat skip the sort.
    """
    words = F.col("__words")
    n = F.size(words)
    pairs = F.zip_with(words, F.slice(words, F.lit(2), F.greatest(n - 1, F.lit(0))),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    triples = F.zip_with(pairs, F.slice(words, F.lit(3), F.greatest(n - 2, F.lit(0))),
                         lambda p, c: F.xxhash64(p["a"], p["b"], c))
    out = df.withColumn("__windows", F.when(n >= 3, F.slice(triples, F.lit(1), n - 2)))
    out = out.withColumn("__again", F.size(F.array_distinct("__windows")) < F.size("__windows"))
    out = out.withColumn("__sorted", F.when(F.col("__again"), F.sort_array(F.transform(
        "__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    m = F.size("__sorted")
    equal = F.zip_with(F.slice("__sorted", F.lit(2), m - 1), F.slice("__sorted", F.lit(1), m - 1),
                       lambda b, a: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    places = F.flatten(F.filter(equal, lambda e: e.isNotNull()))
    out = out.withColumn("__places", F.when(F.col("__again"), F.array_distinct(places)))
    covered = F.size(F.array_distinct(F.flatten(F.transform(
        "__places", lambda p: F.array(p, p + 1, p + 2)))))
    return (out.withColumn("n_repeat_words", F.when(F.col("__again"), covered).otherwise(0)
                           .cast("long"))
            .drop("__windows", "__again", "__sorted", "__places"))


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(0.0)
