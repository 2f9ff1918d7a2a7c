"""Near-duplicates by SuperMinHash, banding, verification and union-find.

A document's set is its distinct 5-word shingles (A-Z lower-cased; a shorter
text is one shingle).  Equal sets collapse first, by a hash of the set: bands,
buckets and links are made of one member of a group of copies whatever its
size.  Then, for the different sets:

1. signature: SuperMinHash.  In round j every element takes the j-th place of
   its own random permutation and proposes j plus a random fraction there; a
   place keeps its least proposal.  Rounds stop as soon as no later proposal
   can win, so a long text needs only a few;
2. banding: signature rows are hashed in bands; sets that share a band meet.
   The bands fit the threshold (``banding``): a pair right at it is missed
   with a probability of about 1e-5, with 24 bands of 6 rows at 85 per cent
   and 29 of 5 at 80;
3. inside a bucket signatures are compared, and sets that look at least
   ``margin`` below the threshold are chained to clusters (a bucket larger
   than ``block`` is compared block against block, in separate tasks);
4. verification: in each cluster the full shingle sets are intersected exactly,
   again block against block; only a spanning forest of the confirmed links is
   kept, never all pairs;
5. components of the confirmed links.

Result for odd input: a null, blank or wordless text has an empty set, links
to nothing and is kept; a null ``doc_id`` links like any other and counts as
the greatest, so a component's id is null only where all its ids are; an empty
table gives no rows; very long texts are read whole; other columns travel
along.  ``near_duplicates`` marks as kept every row whose id is its
component's.  ``keep`` leaves one row of each component: of different texts
under its id the one with the least hash, of rows that are the same in id and
text any one.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.llm.common import frozen, require, struct
from casetrace.llm.components import components
from casetrace.llm.skew import join_to_unique
from casetrace.llm.words import (find_words, hash_spans, lower_ascii, mix, shingle_hashes,
                                 text_slices)

SHINGLE = 5
PERCENT = 85  # where the caller names no other threshold
MISSED = 1e-5
PLACES = 160
MARGIN = 0.15
BLOCK = 256
_CHUNK = 65_536
_COLUMNS = 8_192

FEATURES = struct(("doc_id", T.LongType()), ("text_hash", T.LongType()),
                  ("n_shingles", T.LongType()), ("c", T.LongType()), ("bands", T.ArrayType(T.LongType())),
                  ("signature", T.BinaryType()))


def banding(percent: int) -> tuple[int, int]:
    """(bands, rows): the most selective bands of at most ``PLACES`` rows in
    all that miss a pair at ``percent`` with a probability of about ``MISSED``."""
    for rows in range(8, 0, -1):
        bands = max(1, round(math.log(MISSED) / math.log1p(-min(percent / 100, 0.999999) ** rows)))
        if bands * rows <= PLACES:
            return bands, rows
    raise ValueError(f"no bands of {PLACES} places find pairs at {percent} per cent")


# --- sets and signatures -----------------------------------------------------

def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    for part in text_slices(texts):
        data = lower_ascii(part.data)
        starts, ends, first_word = find_words(part._replace(data=data))
        words = hash_spans(data, starts, ends)
        windows = shingle_hashes(words, SHINGLE) if len(words) >= SHINGLE else words[:0]
        for a, b in zip(first_word[:-1].tolist(), first_word[1:].tolist()):
            if b - a >= SHINGLE:
                yield np.unique(windows[a:b - SHINGLE + 1])
            elif b > a:  # the whole sequence, told apart from longer ones by its length
                yield mix(shingle_hashes(words[a:b], b - a) + np.uint64(b - a))
            else:
                yield words[:0]


def super_min_hash(elements: np.ndarray, size: int) -> np.ndarray:
    """Signature of a set of 64-bit hashes: ``size`` numbers, place by place."""
    held = np.full(size, np.inf)
    for k in range(0, len(elements), _CHUNK):
        part = elements[k:k + _CHUNK]
        rows = np.arange(len(part))
        places = np.tile(np.arange(size, dtype=np.int16), (len(part), 1))
        for j in range(size):
            if j >= held.max():
                break
            draw = mix(part + np.uint64(((j + 1) * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF))
            swap = j + ((draw & np.uint64(0xFFFF)) % np.uint64(size - j)).astype(np.int64)
            taken = places[rows, swap]
            places[rows, swap] = places[:, j]
            np.minimum.at(held, taken, j + (draw >> np.uint64(20)) * 2.0 ** -44)
    return held


def _features(batches: Iterator[pa.RecordBatch], n_bands: int,
              n_rows: int) -> Iterator[pa.RecordBatch]:
    lanes = mix(np.arange(1, n_bands * n_rows + 1, dtype=np.uint64))
    for batch in batches:
        sizes, names, bands, signatures = [], [], [], []
        for elements in shingle_sets(batch.column(2)):
            sizes.append(len(elements))
            if not len(elements):
                names.append(None)
                bands.append(None)
                signatures.append(None)
                continue
            # the elements are in order, so equal sets give equal names
            name = mix(np.array([np.sum(elements * (mix(elements) | np.uint64(1)))
                                 + np.uint64(len(elements))]))
            names.append(int(name.view(np.int64)[0]))
            rows = mix(super_min_hash(elements, n_bands * n_rows).view(np.uint64) ^ lanes)
            per_band = rows.reshape(n_bands, n_rows)
            key = np.zeros(n_bands, np.uint64)
            for r in range(n_rows):
                key = mix(key * np.uint64(0x9E3779B97F4A7C15) + per_band[:, r])
            bands.append((key + np.arange(n_bands, dtype=np.uint64)).view(np.int64))
            signatures.append((rows & np.uint64(0xFFFF)).astype("<u2").tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()),
             pa.array(bands, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
            names=FEATURES.names)


# --- clusters and links ------------------------------------------------------

def forest(links: np.ndarray) -> list[tuple[int, int]]:
    """Edges (root, member) of the components of a square boolean matrix."""
    left = np.ones(len(links), bool)
    out = []
    for root in range(len(links)):
        if not left[root]:
            continue
        left[root] = False
        front = links[root] & left
        while front.any():
            left &= ~front
            members = np.flatnonzero(front)
            out += [(root, int(i)) for i in members]
            front = links[members].any(axis=0) & left
    return out


def _similar_signatures(pdf: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Pairs that chain sets of a bucket which look alike."""
    rows = np.stack([np.frombuffer(s, "<u2") for s in pdf["signature"]])
    agree = np.zeros((len(rows), len(rows)), np.int16)
    for column in rows.T:
        agree += column[:, None] == column[None, :]
    sizes = pdf["n_shingles"].to_numpy()
    low, high = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    links = ((agree >= (percent / 100 - MARGIN) * rows.shape[1]) & (100 * low >= percent * high))
    return forest(links)


def _similar_sets(pdf: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """Spanning forest of the sets with 100 * |A and B| >= percent * |A or B|."""
    sets = list(shingle_sets(pa.array(pdf["text"], pa.large_string())))
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts[column] > 1
    owner, column = owner[shared], column[shared]
    rank = np.cumsum(counts > 1) - 1
    column = rank[column]
    common = np.zeros((len(sets), len(sets)))
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for k in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, (k, k + _COLUMNS))
        block = np.zeros((len(sets), _COLUMNS), np.float32)
        block[owner[a:b], column[a:b] - k] = 1
        common += block @ block.T
    links = 100 * common >= percent * (np.add.outer(sizes, sizes) - common)
    return forest(links)


def _edges(members: DataFrame, payload: DataFrame, find: Callable, per_task: int,
           bytes_per_task: int = 64 << 20) -> DataFrame:
    """Run ``find`` over the ``members`` (c, group; stored) of every group with
    their ``payload`` (one row per c) and return its edges (a, b).  Groups above
    ``BLOCK`` members are dealt to pairs of blocks, so a task holds a few
    blocks at most; small groups share a task."""
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("__n")).where("__n > 1")
    sized = join_to_unique(members, sizes, "group", members.count())
    blocks = F.ceil(F.col("__n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("c", F.lit(5)), blocks).cast("int")
    # block i meets block j once: as (i, j) and (j, i) under one name
    dealt = sized.select("group", "c", own.alias("__own"), F.explode(
        F.sequence(F.lit(0), blocks - 1)).alias("__other"))
    pair = frozen(dealt.select("c", F.xxhash64(
        "group", F.least("__own", "__other"), F.greatest("__own", "__other")).alias("__pair"))
        .join(payload, "c"))
    heavy = [c for c in payload.columns if c != "c"]
    size = sum((F.octet_length(c) if kind in ("string", "binary") else F.lit(8))
               for c, kind in payload.dtypes if c in heavy)
    rows, volume = pair.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    tasks = max(1, -(-rows // per_task), -(-volume // bytes_per_task))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        out = []
        for _, part in pdf.groupby("__pair", sort=False):
            if len(part) > 1:
                c = part["c"].to_numpy()
                out += [(c[i], c[j]) for i, j in find(part)]
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return (pair.withColumn("__task", F.pmod("__pair", F.lit(tasks))).groupBy("__task")
            .applyInPandas(run, "a long, b long").distinct())


def _named(docs: DataFrame) -> DataFrame:
    """A row is known by its id and the hash of its text."""
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).withColumn(
        "text_hash", F.xxhash64("text"))


def _keys(doc_id: str = "doc_id") -> list[Column]:
    """The id as two columns without nulls, which a join can compare."""
    return [F.coalesce(F.col(doc_id).cast("long"), F.lit(0)).alias("__id"),
            F.col(doc_id).isNull().alias("__none")]


def features(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """Set size, set name ``c``, bands and signature of every document, frozen."""
    require(docs, ["doc_id", "text"])
    n_bands, n_rows = banding(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _features(batches, n_bands, n_rows)

    return frozen(_named(docs).select("doc_id", "text_hash", "text").mapInArrow(run, FEATURES))


def links(docs: DataFrame, found: DataFrame,
          percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Classes (``c``, ``first``: none, doc_id and text_hash of the least
    document with that set) and the confirmed links between different sets
    (a, b), as a spanning forest."""
    classes = frozen(found.where("c is not null").groupBy("c").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")).alias("first"),
        *[F.first(x).alias(x) for x in ("n_shingles", "bands", "signature")]))  # equal in a class
    # buckets that at least two different sets share
    banded = classes.select("c", F.explode("bands").alias("group"))
    shared = (banded.groupBy("group").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
              .where("lo < hi").select("group"))
    alike = _edges(frozen(banded.join(shared, "group")), classes.select("c", "n_shingles", "signature"),
                   functools.partial(_similar_signatures, percent=percent), 4_000)
    clusters = frozen(components(alike).select(F.col("node").alias("c"), F.col("root").alias("group")))
    # the text of one document per set
    chosen = clusters.join(classes, "c").select("c", *_keys("first.doc_id"), F.col("first.text_hash").alias("text_hash"))
    texts = (_named(docs).select(*_keys(), "text_hash", "text").join(chosen, ["__id", "__none", "text_hash"])
             .select("c", "text").dropDuplicates(["c"]))
    return classes.select("c", "first"), _edges(
        clusters, texts, functools.partial(_similar_sets, percent=percent), 400)


def _judged(docs: DataFrame, percent: int) -> DataFrame:
    """``doc_id, text_hash, n_shingles, c`` of every row and ``lead``, the
    least document of its component (none, doc_id, text_hash)."""
    found = features(docs, percent)
    classes, linked = links(docs, found, percent)
    groups = components(linked)
    named = frozen(classes.join(groups.withColumnRenamed("node", "c"), "c", "left").withColumn(
        "root", F.coalesce("root", "c")))
    n = named.count()
    least = named.groupBy("root").agg(F.min("first").alias("lead"))
    of_class = join_to_unique(named, least, "root", n).select("c", "lead")
    rows = found.select("doc_id", "text_hash", "n_shingles", "c")
    # empty sets belong to no class; each of their rows leads itself
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    return join_to_unique(rows.where("c is not null"), of_class, "c", found.count()).unionByName(
        rows.where("c is null").withColumn("lead", own))


def near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every document."""
    return _judged(docs, percent).select(
        "doc_id", "n_shingles", F.col("lead.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("lead.doc_id")).alias("kept"))


def keep(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component: that with the least id."""
    judged = frozen(_judged(docs, percent).select(
        *_keys(), "text_hash", "c", (F.col("doc_id").eqNullSafe(F.col("lead.doc_id"))
                                     & (F.col("text_hash") == F.col("lead.text_hash"))).alias("leads")))
    key = ["__id", "__none", "__text"]
    names = [*judged.columns[:2], F.col("text_hash").alias("__text")]
    copies = judged.where(~F.col("leads")).select(*names).distinct()
    repeated = frozen(judged.where("leads and c is not null").groupBy(*key[:2], "text_hash")
                      .agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(*names))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    left = docs.select(F.struct(*columns).alias("__row"), *_keys(),
                       F.xxhash64(F.col("text").cast("string")).alias("__text")).join(copies, key, "left_anti")
    if repeated.isEmpty():
        return left.select("__row.*")
    one = left.join(repeated, key, "left_semi").groupBy(*key).agg(F.first("__row").alias("__row"))
    return left.join(repeated, key, "left_anti").select("__row.*").unionByName(one.select("__row.*"))
