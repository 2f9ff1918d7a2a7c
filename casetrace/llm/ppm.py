"""Text scoring by prediction by partial matching, with a word baseline.

The model is a trie of byte contexts of up to ``order`` bytes (2, or 4 as in
``op7``), counted over all training texts.  A byte's probability in its longest known context is its
count over (counts + distinct bytes); what remains is the escape to the next
shorter context, where bytes already offered are excluded from the counts, and
below the empty context every byte not offered is equally likely.  A text is
opened and closed by byte 0xFF, which UTF-8 never uses, so the sum of log10
probabilities is that of the whole text with its end.

The trie's orders 0 to 2 have at most 2**24 counts however large the corpus is
(all byte triples), so it is a proven bound that they can be collected and
broadcast as one table of probabilities (at most 64 MB; only contexts that
occur take space).

Contexts of three and four bytes grow with the corpus and stay in Spark, as
counts of (context, byte).  The probabilities of the ``COMMON_GRAMS`` most
frequent are broadcast; the rest meet (document, gram) rows in a shuffle join.
A gram that training lacks is scored once, however many documents hold it, by
joins on its shorter contexts: what followed a context also followed every
shorter one, so excluding the bytes already offered needs sums only.

The word baseline has no such bound: counts of all words stay in Spark.  Words
held by very many documents are looked up from a table of at most
``COMMON_WORDS`` entries, which is broadcast; all others meet their counts in
a shuffle join of (document, word) rows.

Result for odd input: a null or empty text is one end token; a null
``doc_id`` is never held out; repeated rows are each scored, and count each in
training; an empty table gives no rows, and without a training text every
probability is that of an empty model; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.llm.common import frozen, require, struct
from casetrace.llm.words import Slice, find_words, hash_spans, lower_ascii, text_slices

MARK = 0xFF
COMMON_WORDS = 1 << 18
COMMON_GRAMS = 1 << 19

COUNTS = struct(("kind", T.IntegerType()), ("key", T.LongType()), ("n", T.LongType()))
# a document's summary, or one of its rare words or grams with its count
ROWS = struct(("row", T.LongType()), ("kind", T.IntegerType()), ("key", T.LongType()),
              ("n", T.LongType()),
              ("of", struct(("doc_id", T.LongType()), ("held_out", T.BooleanType()),
                            ("known", T.LongType()), ("log_known", T.DoubleType()),
                            ("score", T.DoubleType()))))
WORD, TRIPLE, TEXT, GRAM, SUMMARY = 0, 1, 2, 3, 4


# --- the trie ---------------------------------------------------------------

def marked(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a slice with two marks before and one after every text, and
    the places of the coded bytes' ends per document."""
    lengths = np.diff(part.offsets)
    out = np.full(int(lengths.sum()) + 3 * len(lengths), MARK, np.uint8)
    at = np.arange(len(part.data)) + np.repeat(3 * np.arange(len(lengths)) + 2, lengths)
    out[at] = part.data
    return out, np.cumsum(lengths + 3)


def triples(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code of (two bytes before, byte) for every coded byte, and how many
    each document has."""
    data, ends = marked(part)
    wide = data.astype(np.int32)
    codes = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    keep = np.ones(len(codes), bool)
    keep[ends[:-1] - 2] = False  # windows that reach into the next text
    keep[ends[:-1] - 1] = False
    return codes[keep], np.diff(part.offsets) + 1


def grams(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Code of (four bytes before, byte) for every coded byte, and how many
    each document has."""
    lengths = np.diff(part.offsets)
    data = np.full(int(lengths.sum()) + 5 * len(lengths), MARK, np.uint8)
    data[np.arange(len(part.data)) + np.repeat(5 * np.arange(len(lengths)) + 4, lengths)] = part.data
    wide, ends = data.astype(np.int64), np.cumsum(lengths + 5)
    codes = ((wide[:-4] << 32) | (wide[1:-3] << 24) | (wide[2:-2] << 16) | (wide[3:-1] << 8)
             | wide[4:])
    keep = np.ones(len(codes), bool)
    for k in range(1, 5):
        keep[ends[:-1] - k] = False  # windows that reach into the next text
    return codes[keep], lengths + 1


def blended(levels: list[np.ndarray]) -> np.ndarray:
    """Probabilities from counts, longest context first (rows of 256)."""
    shape = levels[0].shape
    p, escape, offered = np.zeros(shape), np.ones((shape[0], 1)), np.zeros(shape, bool)
    for counts in levels:
        counts = np.where(offered, 0.0, counts)
        kinds = np.count_nonzero(counts, axis=1, keepdims=True)
        whole = counts.sum(axis=1, keepdims=True) + kinds
        some = whole > 0
        whole = np.where(some, whole, 1.0)
        p += escape * counts / whole
        escape = np.where(some, escape * kinds / whole, escape)
        offered |= counts > 0
    left = (~offered).sum(axis=1, keepdims=True)
    p += np.where(offered, 0.0, escape / np.maximum(left, 1))
    return p / p.sum(axis=1, keepdims=True)  # the last escape, if all bytes were offered


class Trie:
    """log10 probabilities: a row of 256 per context, found by its two bytes.
    An unknown context uses the row of its last byte, and that of none."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray):
        counts = counts.astype(np.float64)
        none = np.bincount(codes & 255, counts, 256)
        one = np.bincount(codes & 0xFFFF, counts, 65_536).reshape(256, 256)
        rows = [np.log10(blended([one, np.broadcast_to(none, one.shape)])).astype(np.float32)]
        self._row_of = np.tile(np.arange(256, dtype=np.int32), 256)
        order = np.argsort(codes)
        codes, counts = codes[order], counts[order]
        contexts, first = np.unique(codes >> 8, return_index=True)
        self._row_of[contexts] = 256 + np.arange(len(contexts))
        ends = np.append(first[1:], len(codes))
        for k in range(0, len(contexts), 1_024):
            part = contexts[k:k + 1_024]
            a, b = first[k], ends[k + len(part) - 1]
            two = np.zeros((len(part), 256))
            two[np.searchsorted(part, codes[a:b] >> 8), codes[a:b] & 255] = counts[a:b]
            rows.append(np.log10(blended([two, one[part & 255],
                                          np.broadcast_to(none, two.shape)])).astype(np.float32))
        self._table = np.concatenate(rows)

    def logs(self, codes: np.ndarray) -> np.ndarray:
        return self._table[self._row_of[codes >> 8], codes & 255]


# --- counting and scoring ---------------------------------------------------

def _words(part: Slice) -> tuple[np.ndarray, np.ndarray]:
    data = lower_ascii(part.data)
    starts, ends, first_word = find_words(part._replace(data=data))
    return hash_spans(data, starts, ends).view(np.int64), first_word


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, at = np.unique(np.concatenate(keys), return_inverse=True)
    return key, np.bincount(at, np.concatenate(counts), len(key)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words, codes, sizes, long, long_sizes = [], [], [], [], []
        for part in text_slices(batch.column(0)):
            words.append(_words(part)[0])
            got, n = np.unique(triples(part)[0], return_counts=True)
            codes.append(got)
            sizes.append(n)
            if order > 2:
                got, n = np.unique(grams(part)[0], return_counts=True)
                long.append(got)
                long_sizes.append(n)
        if not words:
            continue
        key, n = np.unique(np.concatenate(words), return_counts=True)
        code, held = _summed(codes, sizes)
        gram, times = _summed(long, long_sizes) if long else (code[:0], held[:0])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.array([WORD, TRIPLE, TEXT, GRAM], np.int32),
                                [len(key), len(code), 1, len(gram)])),
             pa.array(np.concatenate([key, code.astype(np.int64), [0], gram.astype(np.int64)])),
             pa.array(np.concatenate([n, held, [batch.num_rows], times]))], names=COUNTS.names)


def _least(counts: DataFrame, room: int) -> int:
    """A count that at most ``room`` keys reach, and nearly as many as may.
    Counts are grouped by their ten leading binary digits, so some 30,000 rows
    reach the driver at most, whatever the corpus; the count found only parts
    broadcast keys from joined ones, and no result hangs on it."""
    low = F.expr("shiftleft(shiftright(n, s), s)")
    kinds = (counts.select("n", F.expr("greatest(length(bin(n)) - 10, 0)").alias("s"))
             .groupBy(low.alias("n")).agg(F.count(F.lit(1)).alias("k")).collect())
    for n, k in sorted(((r["n"], r["k"]) for r in kinds), reverse=True):
        room -= k
        if room < 0:
            return n + (1 << max(n.bit_length() - 10, 0))  # past this group
    return 1


class Grams:
    """Contexts of three and four bytes, in Spark."""

    def __init__(self, counts: DataFrame, triples: DataFrame):
        self._four = counts.select("key", "n", F.shiftright("key", 8).alias("c4"),
                                   F.col("key").bitwiseAND(0xFFFFFFFF).alias("k4"))
        contexts = self._four.groupBy("c4").agg(F.sum("n").alias("t4"),
                                                F.count(F.lit(1)).alias("d4"))
        self._three = (self._four.groupBy("k4").agg(F.sum("n").alias("n3"))
                       .withColumn("c3", F.shiftright("k4", 8))
                       .withColumn("k3", F.col("k4").bitwiseAND(0xFFFFFF)))
        self._two = triples.select(F.col("key").alias("k3"), F.col("n").alias("n2"))
        self.seen = frozen(self._four.join(contexts, "c4").select(
            "key", "n", (F.log10("n") - F.log10(F.col("t4") + F.col("d4"))).alias("value")))
        self.least = _least(self.seen, COMMON_GRAMS)
        common = self.seen.where(F.col("n") >= self.least).select("key", "value").toArrow()
        order = np.argsort(common["key"].to_numpy())
        self.common = common["key"].to_numpy()[order], common["value"].to_numpy()[order]

    def unseen(self, keys: DataFrame, held) -> DataFrame:
        """``key, value`` of grams (``key``, distinct) that training lacks."""
        def shorter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trie = held.value[2]
            for batch in batches:
                codes = (batch.column(0).to_numpy() & 0xFFFFFF).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(trie.logs(codes).astype(np.float64))],
                    names=["key", "short"])

        # totals, distinct bytes, and the counts of those bytes one order below
        of_four = self._four.join(self._three.select("k4", "n3"), "k4").groupBy("c4").agg(
            F.sum("n").alias("t4"), F.count(F.lit(1)).alias("d4"), F.sum("n3").alias("x3"))
        of_three = self._three.join(self._two, "k3").groupBy("c3").agg(
            F.sum("n3").alias("t3"), F.count(F.lit(1)).alias("d3"), F.sum("n2").alias("x2"))
        of_two = self._two.groupBy(F.shiftright("k3", 8).alias("c2")).agg(
            F.sum("n2").alias("t2"), F.count(F.lit(1)).alias("d2"))
        rows = keys.mapInArrow(shorter, "key long, short double").select(
            "key", "short", F.shiftright("key", 8).alias("c4"),
            F.col("key").bitwiseAND(0xFFFFFFFF).alias("k4"),
            F.col("key").bitwiseAND(0xFFFFFF).alias("k3"),
            F.shiftright(F.col("key").bitwiseAND(0xFFFFFFFF), 8).alias("c3"),
            F.shiftright(F.col("key").bitwiseAND(0xFFFFFF), 8).alias("c2"))
        rows = (rows.join(of_four, "c4", "left").join(of_three, "c3", "left")
                .join(self._three.select("k4", "n3"), "k4", "left")
                .join(self._two, "k3", "left").join(F.broadcast(of_two), "c2", "left"))

        def escape(kinds, whole):
            return F.when(kinds > 0, F.log10(kinds) - F.log10(whole)).otherwise(0.0)

        kinds3 = F.col("d3") - F.coalesce("d4", F.lit(0))
        whole3 = F.col("t3") - F.coalesce("x3", F.lit(0)) + kinds3
        kinds2 = F.col("d2") - F.col("d3")
        whole2 = F.col("t2") - F.col("x2") + kinds2
        lead = F.coalesce(F.log10("d4") - F.log10(F.col("t4") + F.col("d4")), F.lit(0.0))
        below = F.when(F.col("n2").isNotNull(), F.log10("n2") - F.log10(whole2)).otherwise(
            escape(kinds2, whole2) + F.col("short")
            - (F.log10("d2") - F.log10(F.col("t2") + F.col("d2"))))
        return rows.select("key", F.when(F.col("d3").isNull(), F.col("short")).otherwise(
            lead + F.when(F.col("n3").isNotNull(), F.log10("n3") - F.log10(whole3)).otherwise(
                escape(kinds3, whole3) + below)).alias("value"))


def train(docs: DataFrame, order: int = 2) -> Model:
    """Count words and bytes after contexts of all ``docs``."""
    require(docs, ["text"])
    if order not in (2, 4):
        raise ValueError(f"order must be 2 or 4, not {order}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(batches, order)

    counts = frozen(docs.select(F.col("text").cast("string")).mapInArrow(run, COUNTS)
                    .groupBy("kind", "key").agg(F.sum("n").alias("n")))
    spark = docs.sparkSession
    words = counts.where(F.col("kind") == WORD).select("key", "n")
    texts = counts.where(F.col("kind") == TEXT).agg(F.sum("n")).first()[0] or 0
    tokens, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    least = _least(words, COMMON_WORDS)
    common = words.where(F.col("n") >= least).toArrow()
    short = counts.where(F.col("kind") == TRIPLE).select("key", "n")
    trie = short.toArrow()
    long = Grams(counts.where(F.col("kind") == GRAM).select("key", "n"), short) if order > 2 else None
    order = np.argsort(common["key"].to_numpy())
    return Model(spark, tokens + texts, distinct + (texts > 0), texts,
                 words.where(F.col("n") < least),
                 common["key"].to_numpy()[order], common["n"].to_numpy()[order],
                 Trie(trie["key"].to_numpy(), trie["n"].to_numpy()), long)


class Model:
    """Token totals, the rare words' counts in Spark, and the bounded parts."""

    def __init__(self, spark: SparkSession, tokens: int, distinct: int, texts: int,
                 rare: DataFrame, keys: np.ndarray, counts: np.ndarray, trie: Trie,
                 long: Grams | None):
        self.long = long
        self.tokens, self.distinct, self.rare = tokens, distinct, rare
        self.texts = texts
        self.held = spark.sparkContext.broadcast((
            keys, np.log10(counts + 1.0), trie, texts, long.common if long else None))

    def score(self, docs: DataFrame) -> DataFrame:
        """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
        score`` of every row of ``docs`` (``doc_id, held_out, text``)."""
        require(docs, ["doc_id", "held_out", "text"])
        held = self.held

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keys, logs, trie, texts, common = held.value
            for batch in batches:
                for part in text_slices(batch.column(3)):
                    yield _score_slice(part, batch.slice(part.first, len(part.offsets) - 1),
                                       keys, logs, trie, texts, common)

        rows = docs.select(F.monotonically_increasing_id().alias("row"),
                           F.col("doc_id").cast("long"), "held_out",
                           F.col("text").cast("string")).mapInArrow(run, ROWS)
        found = self.rare.select("key", F.lit(WORD).alias("kind"),
                                 F.log10(F.col("n") + 1.0).alias("value"))
        if self.long:
            rows = frozen(rows)
            seen = self.long.seen.where(F.col("n") < self.long.least)
            asked = rows.where(F.col("kind") == GRAM).select("key").distinct()
            unseen = self.long.unseen(asked.join(seen, "key", "left_anti"), held)
            found = found.unionByName(seen.select("key", "value").unionByName(unseen).select(
                "key", F.lit(GRAM).alias("kind"), "value"))
        # summaries share no kind with a word or gram and so pass the join untouched
        joined = rows.join(found, ["key", "kind"], "left")
        word, gram, summary = (F.col("kind") == k for k in (WORD, GRAM, SUMMARY))
        per_row = joined.groupBy("row").agg(
            F.max("of.doc_id").alias("doc_id"), F.max("of.held_out").alias("held_out"),
            F.sum(F.when(summary, F.col("n"))).alias("n_tokens"),
            F.sum(F.when(word & F.col("value").isNotNull(), F.col("n"))
                  .otherwise(F.col("of.known"))).alias("n_known"),
            F.sum(F.when(word, F.col("n") * F.coalesce("value", F.lit(0.0)))
                  .otherwise(F.col("of.log_known"))).alias("logs"),
            F.sum(F.when(gram, F.col("n") * F.col("value")).otherwise(F.col("of.score")))
            .alias("score"))
        whole = float(np.log10(self.tokens + self.distinct + 1))
        return per_row.select(
            "doc_id", "held_out", "n_tokens", F.coalesce("n_known", F.lit(0)).alias("n_known"),
            F.lit(self.tokens).cast("long").alias("train_tokens"),
            (F.col("logs") - F.col("n_tokens") * F.lit(whole)).alias("base_score"), "score")


def _per_document(keys: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Every key once per document: keys, documents and counts."""
    order = np.lexsort((keys, owner))
    keys, owner = keys[order], owner[order]
    new = np.ones(len(keys), bool)
    new[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    return keys[first], owner[first], np.diff(np.append(first, len(keys)))


def _find(keys: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``asked`` in sorted ``keys``, and whether they are there."""
    at = np.minimum(np.searchsorted(keys, asked), max(len(keys) - 1, 0))
    return at, keys[at] == asked if len(keys) else np.zeros(len(asked), bool)


def _score_slice(part: Slice, rows: pa.RecordBatch, keys: np.ndarray, logs: np.ndarray,
                 trie: Trie, texts: int,
                 common: tuple[np.ndarray, np.ndarray] | None) -> pa.RecordBatch:
    docs = len(part.offsets) - 1
    codes, lengths = grams(part) if common else triples(part)
    if common:
        at, hit = _find(common[0], codes)
        each = np.zeros(len(codes))
        each[hit] = common[1][at[hit]]
        rare = _per_document(codes[~hit], np.repeat(np.arange(docs), lengths)[~hit])
    else:
        each = trie.logs(codes).astype(np.float64)
        rare = codes[:0], lengths[:0], lengths[:0]
    score = np.add.reduceat(each, np.cumsum(lengths) - lengths)
    words, first_word = _words(part)
    owner = np.repeat(np.arange(docs), np.diff(first_word))
    at, hit = _find(keys, words)
    log_known = np.bincount(owner[hit], logs[at[hit]], docs) + np.log10(texts + 1.0)
    known = np.bincount(owner[hit], minlength=docs) + (texts > 0)
    word, own, times = _per_document(words[~hit], owner[~hit])
    gram, gram_own, gram_times = rare
    ids = rows.column(0).to_numpy()
    n_rare = len(word) + len(gram)
    of = pa.StructArray.from_arrays(
        [rows.column(1), rows.column(2), pa.array(known, pa.int64()),
         pa.array(log_known, pa.float64()), pa.array(score, pa.float64())],
        names=ROWS["of"].dataType.names)
    return pa.RecordBatch.from_arrays([
        pa.array(np.concatenate([ids, ids[own], ids[gram_own]]), pa.int64()),
        pa.array(np.repeat(np.array([SUMMARY, WORD, GRAM], np.int32),
                           [docs, len(word), len(gram)])),
        pa.array(np.concatenate([ids, word, gram]).astype(np.int64), pa.int64()),
        pa.array(np.concatenate([np.diff(first_word) + 1, times, gram_times]), pa.int64()),
        pa.concat_arrays([of, pa.nulls(n_rare, of.type)])], names=ROWS.names)
