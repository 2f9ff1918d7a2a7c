"""Phrase collocations by Misra-Gries summaries and an exact second pass.

Texts are lower-cased (A-Z), split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
pieces into words ``[^\\x20\\x09]+``.  Everything is counted per language.

1. pass one: every task counts the hashes of its n-grams (one to ``longest``
   words) and deals the counts to hash partitions.  Such a partition merges
   them into one Misra-Gries summary whose capacity exceeds its mass divided
   by the threshold.  When a summary outgrows its capacity, the count of the
   first place beyond it is taken from all; the sum of what was taken is the
   summary's error, and it stays below the threshold.  So an n-gram that
   occurs ``threshold`` times or more keeps a count of at least ``threshold``
   minus the error: it survives, and memory is bounded by the capacity however
   many different n-grams there are;
2. the survivors make a filter of two probes into one bit array per hash
   partition, of ``FILTER_BITS`` bits at most in all.  It never refuses a
   survivor; where it is full it only lets more through;
3. pass two: n-grams that pass the filter are counted by their text, exactly,
   and those below the threshold go.  Whatever passed by a shared hash or bit
   goes here too.

Parts of a frequent phrase are at least as frequent, so one table serves
scores and phrases.  A phrase scores ``floor(2000000 * a / (l + r))`` at its
weakest cut; a phrase that lies mostly (``inside_percent``) inside one longer
frequent phrase is dropped.  Products are decimals, so they are exact beyond
64 bits.

Within one slice of text (about 1 MB) n-grams are told apart by 64-bit hashes,
beyond it by their text.

Result for odd input: a null, blank or empty text has no words; a null
language is ``und``; repeated rows count as often as they occur; a very long
text is read whole; a language without any phrase gives no rows; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.llm.common import frozen, require, struct
from casetrace.llm.words import Slice, hash_spans, lower_ascii, mix, text_slices
from casetrace.operators.joins import fanout_join
from casetrace.session import default_parallelism

UNKNOWN = "und"
SCALE = 2_000_000
# most n-gram occurrences a hash partition should hold; its summary then keeps
# at most this many divided by the threshold
PARTITION_MASS = 1 << 26
FILTER_BITS = 1 << 28
_HASH_BITS = 48
_FLUSH = 1_000_000
_PIECE = 256  # keys a row, so that a batch of rows stays small
_SLICE = 1_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)

# Bytes between words (1) and between pieces (2).
_KIND = np.zeros(256, np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2

PARTIALS = struct(("bucket", T.IntegerType()), ("mass", T.LongType()), ("body", T.BinaryType()))
SURVIVORS = struct(("bucket", T.IntegerType()), ("n", T.LongType()), ("body", T.BinaryType()))
COUNTS = struct(("lang", T.StringType()), ("words", T.IntegerType()), ("phrase", T.StringType()),
                ("n", T.LongType()))


# --- n-grams of a slice ------------------------------------------------------

def _words(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased bytes, and start, end and piece number of every word."""
    data, offsets = lower_ascii(part.data), part.offsets
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, none
    kind = _KIND[data]
    first = np.zeros(len(data) + 1, bool)  # first byte of a document
    first[offsets] = True
    inside = kind == 0
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    piece = np.cumsum((kind == 2) | first[:-1])
    return data, starts, np.flatnonzero(ends) + 1, piece[starts]


def _grams(part: Slice, salts: np.ndarray, longest: int):
    """Bytes, spans and languages of the words of a slice, and for every
    length the first words of its n-grams with their hashes.  ``salts`` holds
    one number per document, the same for one language."""
    data, starts, ends, piece = _words(part)
    doc = np.searchsorted(part.offsets, starts, "right") - 1
    words = mix(hash_spans(data, starts, ends) ^ salts[doc]) if len(starts) else np.zeros(0, np.uint64)
    grams, running = [], words
    for m in range(1, longest + 1):
        if m > 1:
            running = mix(running[:-1] * _STEP + words[m - 1:]) if len(running) > 1 else words[:0]
        at = np.flatnonzero(piece[:len(running)] == piece[m - 1:][:len(running)])
        grams.append((m, at, running[at]))
    return data, starts, ends, doc, grams


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[Slice, np.ndarray, np.ndarray, list[str]]]:
    """Slices of a (lang, text) batch with the salt and the language number of
    each of their documents."""
    coded = batch.column(0).fill_null(UNKNOWN).dictionary_encode()
    names = coded.dictionary.to_pylist()
    salt = np.array([int.from_bytes(hashlib.blake2b(name.encode(), digest_size=8).digest(), "little")
                     for name in names], np.uint64)
    codes = coded.indices.to_numpy(zero_copy_only=False)
    for part in text_slices(batch.column(1), _SLICE):
        own = codes[part.first:part.first + len(part.offsets) - 1]
        yield part, salt[own], own, names


# --- summaries ---------------------------------------------------------------

def _merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, with their summed counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[at], np.add.reduceat(counts, at)


def _pack(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Keys, then counts, byte plane by byte plane: planes of ordered keys
    and small counts compress well."""
    return (np.ascontiguousarray(keys).view(np.uint8).reshape(-1, 8)[:, :_HASH_BITS // 8].T.tobytes()
            + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    width = _HASH_BITS // 8
    planes = np.frombuffer(raw, np.uint8).reshape(width + 4, -1)
    keys = np.zeros((planes.shape[1], 8), np.uint8)
    keys[:, :width] = planes[:width].T
    counts = np.ascontiguousarray(planes[width:].T).view("<u4").ravel()
    return keys.view("<u8").ravel(), counts.astype(np.int64)


class Summary:
    """Misra-Gries summary: at most ``capacity`` keys between two merges.
    ``error`` is the most that any key's count may lack."""

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self._keys, self._counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self._waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self._n_waiting = 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self._waiting.append((keys, counts))
        self._n_waiting += len(keys)
        if self._n_waiting > max(self.capacity, 1 << 20):
            self._settle()

    def _settle(self) -> None:
        self._keys, self._counts = _merged(
            np.concatenate([self._keys, *[k for k, _ in self._waiting]]),
            np.concatenate([self._counts, *[c for _, c in self._waiting]]))
        self._waiting, self._n_waiting = [], 0
        beyond = len(self._keys) - self.capacity
        if beyond > 0:
            # at least capacity + 1 keys lose this much each
            taken = int(np.partition(self._counts, beyond - 1)[beyond - 1])
            self.error += taken
            left = self._counts > taken
            self._keys, self._counts = self._keys[left], self._counts[left] - taken

    def survivors(self, threshold: int) -> np.ndarray:
        """Every key that occurs ``threshold`` times or more, in order."""
        self._settle()
        return self._keys[self._counts >= max(1, threshold - self.error)]


def _survivors(docs: DataFrame, buckets_log2: int, threshold: int, longest: int) -> DataFrame:
    """Keys that may be frequent, packed per hash partition; frozen."""
    shift = np.uint64(_HASH_BITS - buckets_log2)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed() -> Iterator[pa.RecordBatch]:
            keys, counts = _merged(np.concatenate([k for k, _ in held]),
                                   np.concatenate([c for _, c in held]))
            cuts = np.searchsorted(keys >> shift, np.arange((1 << buckets_log2) + 1))
            rows = []
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                rows.append((b, int(counts[cuts[b]:cuts[b + 1]].sum()), None))
                rows += [(b, None, _pack(keys[i:min(i + _PIECE, cuts[b + 1])], counts[i:min(i + _PIECE, cuts[b + 1])]))
                         for i in range(cuts[b], cuts[b + 1], _PIECE)]
            yield _record(rows, PARTIALS)

        held: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part, salts, _, _ in _batches(batch):
                grams = _grams(part, salts, longest)[-1]
                keys = np.concatenate([h for _, _, h in grams]) & np.uint64((1 << _HASH_BITS) - 1)
                held.append(np.unique(keys, return_counts=True))
                if sum(len(k) for k, _ in held) >= _FLUSH:
                    yield from flushed()
                    held = []
        if held:
            yield from flushed()

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, mass, summary = None, 0, None

        def result() -> pa.RecordBatch:
            keys = summary.survivors(threshold)
            return _record([(bucket, len(keys), _pack(keys, np.ones(len(keys), np.int64)))], SURVIVORS)

        for batch in batches:
            for at, own, body in zip(*[batch.column(i).to_pylist() for i in range(3)]):
                if at != bucket:
                    if summary:
                        yield result()
                    bucket, mass, summary = at, 0, None
                if body is None:  # the masses come first
                    mass += own
                    continue
                summary = summary or Summary(mass // threshold + 1)
                summary.add(*_unpack(body))
        if summary:
            yield result()

    partials = docs.mapInArrow(partial, PARTIALS)
    return frozen(partials.repartition(1 << buckets_log2, "bucket")
                  .sortWithinPartitions("bucket", F.col("mass").asc_nulls_last())
                  .mapInArrow(summarise, SURVIVORS))


def _record(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.BinaryType(): pa.binary()}
    columns = list(zip(*rows)) or [()] * len(schema.fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[f.dataType])
                                       for c, f in zip(columns, schema.fields)], names=schema.names)


# --- the filter --------------------------------------------------------------

class Filter:
    """Two probes into the bit array of a key's hash partition."""

    def __init__(self, buckets_log2: int, parts: dict[int, bytes]):
        self._shift = np.uint64(_HASH_BITS - buckets_log2)
        sizes = np.array([len(parts.get(b, b"\0")) * 8 for b in range(1 << buckets_log2)], np.uint64)
        self._masks = sizes - np.uint64(1)
        self._starts = np.cumsum(sizes, dtype=np.uint64) - sizes
        self._bits = np.frombuffer(b"".join(parts.get(b, b"\0") for b in range(len(sizes))), np.uint8)

    @staticmethod
    def probes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mixed = mix(keys)
        return mixed, mixed >> np.uint64(32)

    @classmethod
    def part(cls, keys: np.ndarray, bits_a_key: float) -> bytes:
        """Bit array of one hash partition; its size is a power of two."""
        size = 1 << max(3, int(np.ceil(np.log2(max(1.0, bits_a_key * len(keys))))))
        bits = np.zeros(size, bool)
        for probe in cls.probes(keys):
            bits[(probe & np.uint64(size - 1)).astype(np.int64)] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        keys = hashes & np.uint64((1 << _HASH_BITS) - 1)
        bucket = (keys >> self._shift).astype(np.int64)
        start, mask = self._starts[bucket], self._masks[bucket]
        out = np.ones(len(keys), bool)
        for probe in self.probes(keys):
            at = start + (probe & mask)
            out &= (self._bits[(at >> np.uint64(3)).astype(np.int64)]
                    >> (at & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        return out


def _filter(survivors: DataFrame, buckets_log2: int) -> Filter:
    total = survivors.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # sizes are rounded up to a power of two, by less than twice
    bits_a_key = min(16.0, FILTER_BITS / 2 / max(total, 1))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, body in zip(batch.column(0), batch.column(2)):
                yield _record([(at.as_py(), None, Filter.part(_unpack(body.as_py())[0], bits_a_key))],
                              SURVIVORS)

    # at most FILTER_BITS / 8 bytes and one row per hash partition
    rows = survivors.where("n > 0").mapInArrow(build, SURVIVORS).select("bucket", "body").collect()
    return Filter(buckets_log2, {r["bucket"]: bytes(r["body"]) for r in rows})


# --- exact counts ------------------------------------------------------------

def _phrases(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray,
             at: np.ndarray, m: int) -> pa.Array:
    """Texts of the n-grams of ``m`` words from word ``at`` on, with single
    spaces.  ``odd`` counts the gaps before each word that are no single space."""
    plain = odd[at] == odd[at + m - 1]
    first, last = starts[at], np.where(plain, ends[at + m - 1], starts[at])
    sizes = last - first
    bounds = np.concatenate(([0], np.cumsum(sizes)))
    body = data[np.repeat(first - bounds[:-1], sizes) + np.arange(bounds[-1])]
    out = pa.Array.from_buffers(pa.large_string(), len(at), [
        None, pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(body.tobytes())]).cast(pa.string())
    if plain.all():
        return out
    texts = out.to_pylist()
    for i in np.flatnonzero(~plain).tolist():
        texts[i] = " ".join(data[starts[w]:ends[w]].tobytes().decode() for w in range(at[i], at[i] + m))
    return pa.array(texts, pa.string())


def _counts(docs: DataFrame, keep: Filter, longest: int) -> DataFrame:
    """(lang, words, phrase, n) of n-grams that pass ``keep``, one row per
    slice, and of the number of words (``words`` 0)."""
    held = docs.sparkSession.sparkContext.broadcast(keep)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, salts, codes, names in _batches(batch):
                data, starts, ends, doc, grams = _grams(part, salts, longest)
                langs = pa.array(names, pa.string())
                per_lang = np.bincount(codes[doc], minlength=len(names))
                yield pa.RecordBatch.from_arrays(
                    [langs, pa.array([0] * len(names), pa.int32()), pa.array([""] * len(names)),
                     pa.array(per_lang, pa.int64())], names=COUNTS.names)
                gaps = np.ones(len(starts), np.int64)
                if len(starts):
                    gaps[1:] = (starts[1:] - ends[:-1] != 1) | (data[starts[1:] - 1] != 0x20)
                odd = np.cumsum(gaps)
                for m, at, hashes in grams:
                    passed = held.value.passes(hashes)
                    _, first, n = np.unique(hashes[passed], return_index=True, return_counts=True)
                    at = at[passed][first]
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [langs.take(pa.array(codes[doc[at]])), pa.array(np.full(len(at), m, np.int32)),
                             _phrases(data, starts, ends, odd, at, m), pa.array(n, pa.int64())],
                            names=COUNTS.names)

    return docs.mapInArrow(count, COUNTS)


def frequent_ngrams(docs: DataFrame, threshold: int, longest: int = 4) -> DataFrame:
    """(lang, words, phrase, f) of every n-gram of 1 to ``longest`` words that
    occurs ``threshold`` times or more, frozen; ``words`` 0 with an empty
    phrase holds the number of words of each language."""
    require(docs, ["lang", "text"])
    if threshold < 1 or longest < 1:
        raise ValueError("threshold and longest are at least 1")
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"),
                        F.col("text").cast("string").alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    # a word and its gap are taken as four bytes; only the number of hash
    # partitions hangs on it, never a result
    partitions = max(default_parallelism(docs.sparkSession), size * longest // (4 * PARTITION_MASS))
    log2 = min(max(partitions - 1, 1).bit_length(), 24)
    keep = _filter(_survivors(texts, log2, threshold, longest), log2)
    return frozen(_counts(texts, keep, longest).groupBy("lang", "words", "phrase")
                  .agg(F.sum("n").alias("f"))
                  .where((F.col("f") >= threshold) | (F.col("words") == 0)))


# --- scores ------------------------------------------------------------------

def _exact(column: str) -> Column:
    return F.col(column).cast("decimal(20,0)")


def _part(words: Column, first: Column, size: Column) -> Column:
    return F.array_join(F.slice(words, first, size), " ")


def scored(ngrams: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score, cut) of every phrase of two words
    or more: its weakest cut.  A part that very many phrases share (a common
    word) is split over tasks by counted rows."""
    phrases = ngrams.where("words >= 2").withColumn("w", F.split("phrase", " ", -1))
    k = F.col("cut")
    cuts = (phrases.select("lang", "phrase", "words", F.col("f").alias("a"), "w",
                           F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("cut"))
            .select("lang", "phrase", "words", "a", "cut", _part(F.col("w"), F.lit(1), k).alias("first"),
                    _part(F.col("w"), k + 1, F.col("words") - k).alias("rest")))
    per_task = max(20_000, 2 * phrases.count() // default_parallelism(ngrams.sparkSession))
    for part, count in (("first", "l"), ("rest", "r")):
        known = ngrams.where("words >= 1").select("lang", F.col("phrase").alias(part), F.col("f").alias(count))
        cuts = fanout_join(cuts, known, ["lang", part], per_task)
    score = F.call_function("div", _exact("a") * F.lit(SCALE).cast("decimal(10,0)"), _exact("l") + _exact("r"))
    best = cuts.withColumn("score", score.cast("long")).groupBy("lang", "phrase").agg(
        F.min(F.struct("score", "cut", "words", "a", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "best.words", "best.a", "best.l", "best.r", "best.score", "best.cut")


def enclosed(ngrams: DataFrame, inside_percent: int) -> DataFrame:
    """(lang, phrase) of phrases whose words lie contiguously inside a longer
    frequent phrase that makes up ``inside_percent`` of their occurrences."""
    phrases = ngrams.where("words >= 2")
    w, m = F.split("phrase", " ", -1), F.col("words")
    inner = phrases.where("words >= 3").select("lang", "f", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), m - 1), lambda size: F.transform(
            F.sequence(F.lit(1), m - size + 1), lambda at: _part(w, at, size))))).alias("phrase"))
    outer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
    return (phrases.join(outer, ["lang", "phrase"])
            .where(_exact("longer") * 100 >= _exact("f") * inside_percent).select("lang", "phrase"))


def collocations(docs: DataFrame, threshold: int = 30, longest: int = 4,
                 inside_percent: int = 80, top: int = 2000) -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n,
    score``.  Only the report is cut; every phrase is counted and scored."""
    ngrams = frequent_ngrams(docs, threshold, longest)
    kept = scored(ngrams).join(enclosed(ngrams, inside_percent), ["lang", "phrase"], "left_anti")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    totals = ngrams.where("words = 0").select("lang", F.col("f").alias("n"))
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
