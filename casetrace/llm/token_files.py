"""Token-id shard files with a minimal perfect hash index.

``write_token_files`` range-partitions documents by id, encodes them and
writes one payload file a partition: raw ids in ascending ``doc_id`` order
(16-bit when the vocabulary allows it, else 32-bit, little-endian), then a
footer with the ids of the documents and their ends.  ``build_index`` maps
document keys to places in those files: keys are dealt to index files by hash,
and each index file holds a minimal perfect hash of its keys (levels of bit
arrays; a key lives where its position is unshared, others move on to the next
level; the slot is the rank of its bit) beside one row per slot: a 32-bit
fingerprint of the key, file, place in the file, first id, number of ids and
number of copies.  A lookup costs one hash per level and one row; an unknown
key is refused by its fingerprint (a false hit has probability 2**-32).

Files are written with ``pyarrow.fs`` under a URI all executors share, first
under a private name and then renamed, so a lost or repeated task leaves a
whole file or none.

Result for odd input: a null or empty text is just its end id; a null
``doc_id`` sorts first and is a key of its own; repeated rows are kept, lie
next to each other, and the key finds them all; an empty table gives an empty
folder and an index without keys; other columns are ignored.
"""

from __future__ import annotations

import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casetrace.llm.common import frozen, require, struct
from casetrace.llm.tokens import id_bytes, word_encoder
from casetrace.llm.words import mix

MAGIC = b"CTIDS\x001\n"
KEYS_PER_INDEX = 200_000
_GAMMA = 2.0
_MASK32 = np.uint64(0xFFFFFFFF)

PLACED = struct(("doc_id", T.LongType()), ("shard", T.IntegerType()), ("place", T.LongType()),
                ("first_id", T.LongType()), ("n_ids", T.LongType()))
FETCHED = struct(("doc_id", T.LongType()), ("shard", T.IntegerType()), ("place", T.LongType()),
                 ("first_id", T.LongType()), ("ids", T.BinaryType()))
FOUND = struct(("doc_id", T.LongType()), ("shard", T.IntegerType()), ("place", T.LongType()),
               ("first_id", T.LongType()), ("n_ids", T.LongType()), ("copies", T.LongType()))


# --- files -----------------------------------------------------------------

def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


class _Output:
    """A file that appears whole or not at all."""

    def __init__(self, uri: str):
        self._fs, self._path = _filesystem(uri)
        self._fs.create_dir(self._path.rpartition("/")[0], recursive=True)
        self._part = f"{self._path}.{uuid.uuid4().hex[:8]}.part"
        self._out = self._fs.open_output_stream(self._part)
        self.write = self._out.write

    def done(self) -> None:
        self._out.close()
        self._fs.move(self._part, self._path)


def shard_uri(path: str, shard: int) -> str:
    return f"{path}/ids-{shard:06d}.bin"


def index_uri(path: str, number: int) -> str:
    return f"{path}/index-{number:06d}.npz"


class ShardWriter:
    """Payload first, then the footer: ids, null marks and ends of documents."""

    def __init__(self, uri: str, width: int):
        self._out = _Output(uri)
        self._out.write(MAGIC + bytes([width]) + b"\0" * 7)
        self._kind = "<u2" if width == 2 else "<u4"
        self._keys: list[np.ndarray] = []
        self._nulls: list[np.ndarray] = []
        self._ends: list[np.ndarray] = []
        self.n_ids = self.n_docs = 0

    def add(self, keys: np.ndarray, nulls: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Append documents with ``sizes`` ids each; returns their first ids."""
        self._out.write(ids.astype(self._kind).tobytes())
        ends = self.n_ids + np.cumsum(sizes)
        self.n_ids += len(ids)
        self.n_docs += len(sizes)
        self._keys.append(keys)
        self._nulls.append(nulls)
        self._ends.append(ends)
        return ends - sizes

    def done(self) -> None:
        for parts, kind in ((self._keys, "<i8"), (self._nulls, np.uint8), (self._ends, "<i8")):
            self._out.write(np.concatenate([np.zeros(0, kind), *parts]).astype(kind).tobytes())
        self._out.write(np.array([self.n_docs, self.n_ids], "<i8").tobytes())
        self._out.done()


class ShardReader:
    """Random access to one payload file: the footer is read once, then any
    document's ids by one ranged read."""

    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        self._file = fs.open_input_file(path)
        size = self._file.size()
        head = self._file.read_at(16, 0)
        if head[:8] != MAGIC:
            raise ValueError(f"{uri} is no id file")
        self._width = head[8]
        n, _ = np.frombuffer(self._file.read_at(16, size - 16), "<i8").tolist()
        foot = self._file.read_at(17 * n, size - 16 - 17 * n)
        self.doc_ids = np.frombuffer(foot, "<i8", n)
        self.nulls = np.frombuffer(foot, np.uint8, n, 8 * n).astype(bool)
        self.bounds = np.concatenate(([0], np.frombuffer(foot, "<i8", n, 9 * n)))

    def ids(self, place: int) -> bytes:
        first, last = int(self.bounds[place]), int(self.bounds[place + 1])
        raw = self._file.read_at((last - first) * self._width, 16 + first * self._width)
        return raw if self._width == 4 else id_bytes(np.frombuffer(raw, "<u2"))

    def close(self) -> None:
        self._file.close()


def write_token_files(docs: DataFrame, tokenizer: str, path: str, end_id: int,
                      shards: int, id_width: int) -> DataFrame:
    """Encode every whole text and write the payload files under ``path``.

    Returns one row per document: ``doc_id, shard, place, first_id, n_ids``
    (place and first id within its file), frozen.  Texts cross the network
    once, to the range their id falls in.
    """
    require(docs, ["doc_id", "text"])
    if id_width not in (2, 4):
        raise ValueError("ids are 2 or 4 bytes wide")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = word_encoder(tokenizer)
        shard = TaskContext.get().partitionId()
        writer: ShardWriter | None = None
        for batch in batches:
            writer = writer or ShardWriter(shard_uri(path, shard), id_width)
            nulls = np.asarray(batch.column(0).is_null())
            keys = batch.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            for first, tokens, bounds in encoder.encode_slices(batch.column(1)):
                own = slice(first, first + len(bounds) - 1)
                sizes = np.diff(bounds) + 1
                ids = np.full(len(tokens) + len(sizes), end_id, "<u4")
                text = np.ones(len(ids), bool)
                text[np.cumsum(sizes) - 1] = False
                ids[text] = tokens
                place = writer.n_docs + np.arange(len(sizes))
                starts = writer.add(keys[own], nulls[own], ids, sizes)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[own], pa.int64(), mask=nulls[own]),
                     pa.array(np.full(len(sizes), shard, np.int32)), pa.array(place, pa.int64()),
                     pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())], names=PLACED.names)
        if writer:
            writer.done()

    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).select(
        "doc_id", "text", F.xxhash64("text").alias("__h"),
        # copies of one row may be cut between ranges wherever they are very many
        F.monotonically_increasing_id().alias("__salt"))
    order = ["doc_id", "__h", "__salt"]
    return frozen(keyed.repartitionByRange(shards, *order).sortWithinPartitions(*order)
                  .select("doc_id", "text").mapInArrow(write, PLACED))


def shard_totals(placed: DataFrame) -> list[tuple[int, int, int]]:
    """(file, documents, ids) of every payload file; as many rows as files."""
    return sorted((r["shard"], r["n"], r["ids"]) for r in
                  placed.groupBy("shard").agg(F.count(F.lit(1)).alias("n"),
                                              F.sum("n_ids").alias("ids")).collect())


# --- minimal perfect hash ----------------------------------------------------

def key_hash(keys: np.ndarray, nulls: np.ndarray) -> np.ndarray:
    """One-to-one on 64-bit keys; a null key hashes to a value of its own."""
    h = mix(keys.astype(np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019))
    return np.where(nulls, np.uint64(0x1F123BB5F7B7D1C3), h)


def _level_hash(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    seed = np.uint64((0xD1342543DE82EF95 * (level + 1)) & 0xFFFFFFFFFFFFFFFF)
    return (mix(hashes ^ seed) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Slots 0..n-1 for n distinct hashes."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self._starts = np.concatenate(([0], np.cumsum(sizes)))
        self._rank = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        sizes, levels, left = [], [], hashes
        while len(left):
            if len(levels) > 200:
                raise ValueError("keys are not distinct")
            size = max(64, int(_GAMMA * len(left)) | 1)
            at = _level_hash(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            left = left[~alone[at]]
        bits = np.concatenate(levels) if levels else np.zeros(0, bool)
        return cls(np.array(sizes, np.int64), bits)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of every hash; -1 where no level has it (surely unknown)."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            at = self._starts[level] + _level_hash(hashes[todo], level, size)
            hit = self.bits[at]
            out[todo[hit]] = self._rank[at[hit]]
            todo = todo[~hit]
        return out


def _keyed(df: DataFrame, files: int) -> DataFrame:
    """Index number and null-free key of every row (pandas would turn a column
    of ids with nulls into floats)."""
    return df.select("*", F.pmod(F.xxhash64("doc_id"), F.lit(files)).alias("__index"),
                     F.coalesce("doc_id", F.lit(0).cast("long")).alias("__key"),
                     F.col("doc_id").isNull().alias("__null")).drop("doc_id")


def _hashes(pdf: pd.DataFrame) -> np.ndarray:
    return key_hash(pdf["__key"].to_numpy(np.int64), pdf["__null"].to_numpy(bool))


def _ids_or_null(keys: np.ndarray, nulls: np.ndarray) -> pd.arrays.IntegerArray:
    return pd.arrays.IntegerArray(keys.astype(np.int64), nulls.astype(bool))


def build_index(placed: DataFrame, path: str) -> int:
    """Write the index files under ``path`` and return how many there are.

    Each holds about ``KEYS_PER_INDEX`` keys however many keys there are in
    all: keys are distinct and dealt by hash, so no file outgrows a task.
    """
    first = F.min(F.struct("shard", "place", "first_id", "n_ids"))
    keys = frozen(placed.groupBy("doc_id").agg(first.alias("at"),
                                               F.count(F.lit(1)).alias("copies"))
                  .select("doc_id", "at.*", "copies"))
    files = max(1, -(-keys.count() // KEYS_PER_INDEX))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = _hashes(pdf)
        table = PerfectHash.build(hashes)
        order = np.argsort(table.slots(hashes))
        body = io.BytesIO()
        np.savez(body, sizes=table.sizes, bits=np.packbits(table.bits),
                 n_bits=np.int64(len(table.bits)),
                 print=(hashes & _MASK32).astype(np.uint32)[order],
                 **{c: pdf[c].to_numpy(np.int64)[order]
                    for c in ("shard", "place", "first_id", "n_ids", "copies")})
        number = int(pdf["__index"].iloc[0])
        out = _Output(index_uri(path, number))
        out.write(body.getvalue())
        out.done()
        return pd.DataFrame({"file": [number], "keys": [len(pdf)]})

    written = (_keyed(keys, files).groupBy("__index")
               .applyInPandas(build, "file long, keys long"))
    written.agg(F.sum("keys")).collect()
    return files


class IndexReader:
    def __init__(self, uri: str):
        fs, path = _filesystem(uri)
        with fs.open_input_file(path) as f:
            held = np.load(io.BytesIO(f.read()))
        self._rows = {k: held[k] for k in ("print", "shard", "place", "first_id", "n_ids",
                                           "copies")}
        self._hash = PerfectHash(held["sizes"], np.unpackbits(
            held["bits"], count=int(held["n_bits"])).astype(bool))

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which keys are known, and the rows of those."""
        slots = self._hash.slots(hashes)
        known = slots >= 0
        known[known] = (self._rows["print"][slots[known]]
                        == (hashes[known] & _MASK32).astype(np.uint32))
        return known, {k: v[slots[known]] for k, v in self._rows.items() if k != "print"}


def find_documents(keys: DataFrame, path: str, files: int) -> DataFrame:
    """Places of the documents with the given ``doc_id``s; unknown keys give
    no row.  Keys meet their index file by hash, so tasks stay even."""

    def find(pdf: pd.DataFrame) -> pd.DataFrame:
        known, rows = IndexReader(index_uri(path, int(pdf["__index"].iloc[0]))).find(_hashes(pdf))
        ids = _ids_or_null(pdf["__key"].to_numpy()[known], pdf["__null"].to_numpy()[known])
        return pd.DataFrame({"doc_id": ids, **rows})[FOUND.names]

    return (_keyed(keys.select("doc_id").distinct(), files)
            .groupBy("__index").applyInPandas(find, FOUND))


def fetch(found: DataFrame, path: str, totals: list[tuple[int, int, int]]) -> DataFrame:
    """Ids of found documents, every copy: ``doc_id, shard, place, first_id,
    ids``.  ``totals`` as from ``shard_totals`` (one entry a file)."""
    shards = np.array([s for s, _, _ in totals], np.int64)
    ends = np.cumsum([n for _, n, _ in totals]) if totals else np.zeros(0, np.int64)
    base = {s: int(e - n) for (s, n, _), e in zip(totals, ends)}

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Copies beyond the end of a file lie at the start of the next."""
        for pdf in batches:
            if not len(pdf):
                continue
            row = pdf.shard.map(base).to_numpy(np.int64) + pdf.place.to_numpy(np.int64) + \
                pdf["__copy"].to_numpy(np.int64)
            at = np.searchsorted(ends, row, "right")
            yield pd.DataFrame({"__key": pdf["__key"], "__null": pdf["__null"],
                                "shard": shards[at],
                                "place": row - np.array([base[s] for s in shards[at]])})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[int, ShardReader] | None = None
        for pdf in batches:
            for k in range(0, len(pdf), 2_000):
                part = pdf.iloc[k:k + 2_000]
                firsts, raws = [], []
                for key, null, shard, place in part.itertuples(index=False):
                    if held is None or held[0] != shard:
                        if held:
                            held[1].close()
                        held = (shard, ShardReader(shard_uri(path, shard)))
                    file = held[1]
                    if file.nulls[place] != null or file.doc_ids[place] != key:
                        raise ValueError(f"file {shard} does not hold document {key} at {place}")
                    firsts.append(int(file.bounds[place]))
                    raws.append(file.ids(place))
                yield pd.DataFrame({
                    "doc_id": _ids_or_null(part["__key"].to_numpy(), part["__null"].to_numpy()),
                    "shard": part.shard, "place": part.place, "first_id": firsts, "ids": raws})
        if held:
            held[1].close()

    one = found.select(
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("__key"),
        F.col("doc_id").isNull().alias("__null"), "shard", "place", F.explode(
            F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("__copy"))
    return (one.mapInPandas(spread, "__key long, __null boolean, shard int, place long")
            .repartition(max(1, len(totals)), "shard").sortWithinPartitions("shard", "place")
            .mapInPandas(read, FETCHED))


def with_start(spark: SparkSession, rows: DataFrame,
               totals: list[tuple[int, int, int]]) -> DataFrame:
    """Add ``start``: ids of all documents before, over all files (a table
    with one row a file is broadcast)."""
    base, at = [], 0
    for shard, _, ids in totals:
        base.append((shard, at))
        at += ids
    bases = spark.createDataFrame(base, "shard int, __base long")
    return rows.join(F.broadcast(bases), "shard").withColumn(
        "start", F.col("__base") + F.col("first_id")).drop("__base")
