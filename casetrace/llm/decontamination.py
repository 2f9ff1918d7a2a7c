"""Benchmark decontamination by spaced seeds, on DataFrame functions only.

Texts are lower-cased, stripped of punctuation marks and cut into words.  A
seed is a window of ``SPAN`` words of which a fixed mask keeps some: words at
the other places may differ.  Every window of the benchmark is indexed under
every mask, and every window of a document is hashed.  Hits are then verified
on the words around them: some aligned run of ``WINDOW`` words (the whole item
if it is shorter) that contains the seed must agree in at least ``PERCENT`` of
its places.

No such run is missed, wherever its words differ: the three masks leave at
least one seed of a 13-word run whole under any two differences; where the
benchmark holds items of 9 to 12 words, ``masks_for`` adds masks until that
holds for them too; shorter items are hashed as a whole and, from 5 words on,
with each word left out in turn (``short_masks``).

A two-probe bit filter of the benchmark's hashes, of a fixed size, discards
nearly all windows inside the row, before anything is exploded; a first one, of
the words that all masks keep, spares them the hashes under every mask.  The index is
broadcast only while it has at most ``BROADCAST_ROWS`` rows and joined by
shuffle beyond; the result is the same.

Result for odd input: a null or blank text has no windows and is clean; an
item without words matches nothing; repeated items and documents are each reported; a null id is kept as
it is; with an empty benchmark every document is clean; an empty table gives
no rows; other columns travel along unless named like the output.
"""

from __future__ import annotations

import functools
import itertools
import operator
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casetrace.llm.common import frozen, require, words_of

# The masks; 1 keeps a word, 0 ignores it.
MASKS = ("110101011", "111011001", "100111101")
SPAN = 9
WEIGHT = 6
WINDOW = 13
PERCENT = 80
BROADCAST_ROWS = 1_000_000
_FILTER_WORDS = 1 << 14  # 64-bit words: 128 KB
_BEFORE = WINDOW - SPAN


def word_hashes(text: Column) -> Column:
    plain = F.regexp_replace(F.lower(text), r"[.,;:!?\"'()\[\]]+", "")
    return F.transform(words_of(plain), lambda w: F.xxhash64(w))


def need(width: int) -> int:
    """Equal places that a run of ``width`` words needs."""
    return -(-width * PERCENT // 100)


def _whole_under(mask: str, width: int) -> set[tuple[int, ...]]:
    """Sets of differing places of a ``width``-word run that leave some seed
    under ``mask`` whole."""
    seeds = [{o + i for i, bit in enumerate(mask) if bit == "1"}
             for o in range(width - len(mask) + 1)]
    return {places for places in itertools.combinations(range(width), width - need(width))
            if any(seed.isdisjoint(places) for seed in seeds)}


def masks_for(widths: list[int]) -> tuple[str, ...]:
    """``MASKS``, and as many more as runs of these widths need so that one
    seed is whole wherever the allowed differences lie."""
    masks = list(MASKS)
    every = ["".join("1" if i in held else "0" for i in range(SPAN))
             for held in itertools.combinations(range(SPAN), WEIGHT)]
    for width in sorted({w for w in widths if SPAN <= w <= WINDOW}, reverse=True):
        left = set(itertools.combinations(range(width), width - need(width)))
        for mask in masks:
            left -= _whole_under(mask, width)
        while left:
            masks.append(max(every, key=lambda m: len(left & _whole_under(m, width))))
            left -= _whole_under(masks[-1], width)
    return tuple(masks)


def short_masks(width: int) -> tuple[str, ...]:
    """Masks of a whole item of fewer than ``SPAN`` words."""
    whole = "1" * width
    return (whole,) if need(width) == width else tuple(
        whole[:i] + "0" + whole[i + 1:] for i in range(width))


def _seeds(words: Column, at: Column, masks: tuple[str, ...]) -> Column:
    """One (place, hash) per mask for the window at ``at``."""
    made = []
    for number, mask in enumerate(masks):
        kept = [F.get(words, at + i) for i, bit in enumerate(mask) if bit == "1"]
        first = number if len(mask) == SPAN else -100 * len(mask) - number
        made.append(F.struct(at.cast("int").alias("at"),
                             F.xxhash64(F.lit(first), *kept).alias("h")))
    return F.array(*made)


def _around(words: Column, at: Column) -> Column:
    """Words of every WINDOW-word run that holds the seed at ``at``; null
    beyond either end of the text."""
    return F.array(*[F.get(words, at + k) for k in range(-_BEFORE, WINDOW)])


def _under(words: Column, masks: tuple[str, ...]) -> Column:
    """Seeds of all windows of the masks' length; none if the text is shorter."""
    span = len(masks[0])
    return F.when(F.size(words) >= span, F.flatten(F.transform(
        F.sequence(F.lit(0), F.size(words) - span), lambda i: _seeds(words, i, masks)))
        ).otherwise(F.array().cast("array<struct<at:int,h:bigint>>"))


def _core(masks: tuple[str, ...]) -> list[int]:
    """Places that every one of the masks keeps."""
    return [i for i in range(len(masks[0])) if all(mask[i] == "1" for mask in masks)]


def _core_hash(words: Column, at: Column, core: list[int]) -> Column:
    return F.xxhash64(F.lit(-1), *[F.get(words, at + i) for i in core])


def _windows(words: Column, widths: list[int], passes: Callable[[Column], Column],
             core_passes: Callable[[Column], Column] | None) -> Column:
    """Seeds of a document against items of these widths that pass the filter.
    Windows of ``SPAN`` words are first judged by the places that all masks
    keep, with one hash; only those that pass are hashed under every mask."""
    masks = masks_for(widths)
    core = _core(masks)
    held = [_under(words, short_masks(w)) for w in widths if 0 < w < SPAN]
    if core_passes is None or not core:
        held.insert(0, _under(words, masks))
    else:
        starts = F.filter(F.sequence(F.lit(0), F.size(words) - SPAN),
                          lambda i: core_passes(_core_hash(words, i, core)))
        held.insert(0, F.when(F.size(words) >= SPAN, F.flatten(F.transform(
            starts, lambda i: _seeds(words, i, masks)))).otherwise(
            F.array().cast("array<struct<at:int,h:bigint>>")))
    return F.filter(F.concat(*held), lambda s: passes(s["h"]))


def _item_windows(words: Column, widths: list[int]) -> Column:
    """Seeds of an item: under the masks, or of the whole item if it is shorter."""
    out = F.when(F.size(words) >= SPAN, _under(words, masks_for(widths)))
    for w in widths:
        if 0 < w < SPAN:
            out = out.when(F.size(words) == w, _under(words, short_masks(w)))
    return out


def _probes(h: Column) -> list[tuple[Column, Column]]:
    """Word and bit of the filter that a hash sets."""
    return [(F.shiftrightunsigned(h, shift + 6).bitwiseAND(_FILTER_WORDS - 1).cast("int"),
             F.shiftrightunsigned(h, shift).bitwiseAND(63).cast("int")) for shift in (0, 24)]


def index(items: DataFrame) -> tuple[DataFrame, list[int]]:
    """Seeds of the benchmark: ``h, item_id, around, need`` (agreeing places
    that a run needs), and the widths of its items' runs."""
    require(items, ["item_id", "text"])
    own = items.select("item_id", "text").withColumn("__w", word_hashes(F.col("text")))
    width = F.least(F.size("__w"), F.lit(WINDOW))
    widths = sorted(r["width"] for r in own.select(width.alias("width")).distinct().collect())
    seeds = own.select("item_id", "__w", F.explode_outer(
        _item_windows(F.col("__w"), widths)).alias("s"))
    return frozen(seeds.select(
        F.col("s.h").alias("h"), "item_id", _around(F.col("__w"), F.col("s.at")).alias("around"),
        width.alias("width"), F.ceil(width * PERCENT / 100).cast("int").alias("need"))
        .where("h is not null").distinct()), widths


def _core_seeds(seeds: DataFrame, widths: list[int]) -> DataFrame:
    """Hashes of the places that all masks keep, of every indexed window."""
    core = _core(masks_for(widths))
    return seeds.where(F.col("width") >= SPAN).select(
        _core_hash(F.col("around"), F.lit(_BEFORE), core).alias("h")).distinct()


def _bit_filter(seeds: DataFrame) -> Column:
    """The filter as a constant of fixed size."""
    bits = functools.reduce(DataFrame.unionByName, [
        seeds.select(word.alias("word"), bit.alias("bit")) for word, bit in _probes(F.col("h"))])
    held = np.zeros(_FILTER_WORDS, np.int64)
    for r in bits.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("b")).collect():
        held[r["word"]] = r["b"]
    return F.lit(held)


def matches(docs: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """(``key``, ``item_id``, ``agreeing``) of every document and item that
    share a passage; ``agreeing`` is the best run's number of equal places."""
    seeds, widths = index(items)

    def filtered(own: DataFrame) -> Callable[[Column], Column]:
        held = _bit_filter(own)
        return lambda h: functools.reduce(operator.and_, [
            F.getbit(F.get(held, word), bit) == 1 for word, bit in _probes(h)])

    passes = filtered(seeds)
    core_passes = filtered(_core_seeds(seeds, widths)) if _core(masks_for(widths)) else None

    own = docs.select(key, "text").withColumn("__w", word_hashes(F.col("text"))).drop("text")
    own = own.withColumn("__s", _windows(F.col("__w"), widths, passes, core_passes))
    own = own.withColumn("__s", F.transform("__s", lambda s: F.struct(
        s["h"].alias("h"), _around(F.col("__w"), s["at"]).alias("doc"))))
    # explode_outer: a filter on the array, which explode implies, would be
    # pushed below the hashing and hash the text again for every window
    hits = own.select(key, F.explode_outer("__s").alias("s")).select(key, "s.*").where(
        "h is not null")
    if seeds.count() <= BROADCAST_ROWS:
        seeds = F.broadcast(seeds)
    equal = F.zip_with("doc", "around", lambda a, b: F.coalesce((a == b).cast("int"), F.lit(0)))
    # runs of `width` words that start up to _BEFORE words before the seed
    runs = [F.aggregate(F.slice("__e", F.lit(o + 1), F.col("width")), F.lit(0), lambda x, y: x + y)
            for o in range(_BEFORE + 1)]
    return (hits.join(seeds, "h").withColumn("__e", equal)
            .withColumn("agreeing", F.greatest(*runs)).where("agreeing >= need")
            .groupBy(key, "item_id").agg(F.max("agreeing").alias("agreeing")))


def flag(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` with ``contaminated``, ``n_items`` and ``worst_item`` (the item
    with the most agreeing places, then the least id)."""
    require(docs, ["doc_id", "text"])
    own = docs.drop("contaminated", "n_items", "worst_item")
    # a row is known by its id and text, so repeated ids do not mix
    keyed = own.withColumn("__k", F.xxhash64("doc_id", "text"))
    per_doc = matches(keyed, items, "__k").groupBy("__k").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.min(F.struct(-F.col("agreeing"), "item_id"))["item_id"].alias("worst_item"))
    return (keyed.join(per_doc, "__k", "left").drop("__k")
            .withColumn("contaminated", F.col("n_items").isNotNull())
            .withColumn("n_items", F.coalesce("n_items", F.lit(0)).cast("long")))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated ones."""
    keyed = docs.withColumn("__k", F.xxhash64("doc_id", "text"))
    return keyed.join(matches(keyed, items, "__k").select("__k").distinct(), "__k",
                      "left_anti").select(*docs.columns)
