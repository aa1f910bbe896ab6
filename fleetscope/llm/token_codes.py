"""Token ids in files with direct access to every single id.

Ids are written in ascending document order as *directly addressable codes*. An
id is split into chunks of 8, 8 and 16 bits. Level 0 holds the lowest chunk of
every id, level k + 1 the next chunk of those ids that do not end at level k. A
bitmap per level tells which ids go on, and a rank directory holds the number of
set bits before each block of 512, so the place of id i at the next level takes
one directory entry and the bits of one block; nothing before it is decoded.

A task writes its shards, whole documents of about SHARD_IDS ids, one behind the
other and uncompressed into a file of its own. An index in Parquet has a row per shard: file,
place and length, ids and sizes of its documents. Spark commits the index, so files of lost
attempts are named nowhere. A single token is looked up in the index and then takes a few reads of up to 64 bytes at
known places of the file. ``read_documents`` and ``read_tokens`` give documents and tokens back.

A null text holds the end id only. Rows of one doc_id stand next to each other,
ordered by a hash of their text; a null doc_id comes first. A text of any length is
whole in one shard. Extra columns are ignored; an empty table gives an index without rows.
Files are written and read through Arrow's file systems.
"""

from __future__ import annotations

import struct
import uuid
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.llm.bpe import encoder
from fleetscope.llm.common import release, store_of, text_slices, texts_of

CHUNKS = (8, 8, 16)
BLOCK = 512
MAGIC = b"DAC1"
SHARD_IDS = 1 << 19
#: Shards that a task reads, and tasks at most; a task holds one shard at a time.
TASK_SHARDS = 8
TASKS = 100_000
_TYPES = {8: np.dtype("<u1"), 16: np.dtype("<u2")}


def pack(ids: np.ndarray) -> bytes:
    """Codes of unsigned 32-bit ids. Layout: magic, number of ids, then per level
    its number of chunks, the chunks, the bitmap and the rank directory."""
    rest = np.asarray(ids, np.uint32)
    out = [MAGIC, struct.pack("<Q", len(rest))]
    for bits in CHUNKS:
        chunk, rest = rest & np.uint32((1 << bits) - 1), rest >> np.uint32(bits)
        more = rest > 0
        padded = np.zeros(-(-len(more) // BLOCK) * BLOCK, bool)
        padded[: len(more)] = more
        counts = padded.reshape(-1, BLOCK).sum(1)
        ranks = (np.cumsum(counts) - counts).astype("<u4")
        out += [struct.pack("<Q", len(chunk)), chunk.astype(_TYPES[bits]).tobytes()]
        out += [np.packbits(padded, bitorder="little").tobytes(), ranks.tobytes()]
        rest = rest[more]
    return b"".join(out)


class Codes:
    """A view of packed ids."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of codes")
        (self.size,) = struct.unpack_from("<Q", data, 4)
        self.levels = []
        at = 12
        for bits in CHUNKS:
            (n,) = struct.unpack_from("<Q", data, at)
            at += 8
            blocks = -(-n // BLOCK)
            kind = _TYPES[bits]
            chunks = np.frombuffer(data, kind, n, at)
            at += n * kind.itemsize
            bitmap = np.frombuffer(data, np.uint8, blocks * BLOCK // 8, at)
            at += len(bitmap)
            ranks = np.frombuffer(data, "<u4", blocks, at)
            at += ranks.nbytes
            self.levels.append((bits, chunks, bitmap, ranks))

    def __getitem__(self, i: int) -> int:
        """One id, from one chunk and one rank per level."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = shift = 0
        for bits, chunks, bitmap, ranks in self.levels:
            value |= int(chunks[i]) << shift
            shift += bits
            if not bitmap[i >> 3] >> (i & 7) & 1:
                break
            start = i // BLOCK * BLOCK
            bits_before = np.unpackbits(bitmap[start >> 3 : (i >> 3) + 1], bitorder="little")[: i - start]
            i = int(ranks[i // BLOCK]) + int(bits_before.sum())
        return value

    def all(self) -> np.ndarray:
        ids, where, shift = np.zeros(self.size, np.uint32), None, 0
        for bits, chunks, bitmap, _ in self.levels:
            part = chunks.astype(np.uint32) << np.uint32(shift)
            if where is None:
                ids |= part
            else:
                ids[where] |= part
            more = np.unpackbits(bitmap, count=len(chunks), bitorder="little").astype(bool)
            where = np.flatnonzero(more) if where is None else where[more]
            shift += bits
            if not len(where):
                break
        return ids


class StoredCodes:
    """Packed ids in an open file, of which only what an id needs is read."""

    def __init__(self, file: pa.NativeFile, at: int = 0):
        if file.read_at(4, at) != MAGIC:
            raise ValueError("not a block of codes")
        self.file, self.levels = file, []
        (self.size,) = struct.unpack("<Q", file.read_at(8, at + 4))
        at += 12
        for bits in CHUNKS:
            (n,) = struct.unpack("<Q", file.read_at(8, at))
            blocks, width = -(-n // BLOCK), bits // 8
            bitmap = at + 8 + n * width
            self.levels.append((bits, width, at + 8, bitmap, bitmap + blocks * BLOCK // 8))
            at = bitmap + blocks * (BLOCK // 8 + 4)

    def __getitem__(self, i: int) -> int:
        """One id, from one chunk, one entry of the rank directory and the bits before it in its block per level."""
        if not 0 <= i < self.size:
            raise IndexError(i)
        value = shift = 0
        for bits, width, chunks, bitmap, ranks in self.levels:
            value |= int.from_bytes(self.file.read_at(width, chunks + i * width), "little") << shift
            shift += bits
            block, place = divmod(i, BLOCK)
            marks = int.from_bytes(self.file.read_at((place >> 3) + 1, bitmap + block * BLOCK // 8), "little")
            if not marks >> place & 1:
                break
            (rank,) = struct.unpack("<I", self.file.read_at(4, ranks + 4 * block))
            i = rank + (marks & (1 << place) - 1).bit_count()
        return value


_SHARDS = "part long, seq long, n_ids long, doc_ids array<long>, n_tokens array<long>, file string, at long, length long"


def write(
    docs: DataFrame, folder: str, path: str, end_id: int = 1, key: str = "doc_id", text: str = "text"
) -> None:
    """Encode all texts with the tokenizer at ``path`` and write them, ``end_id`` after each, to ``folder``.

    The rows are dealt out by ranges of ``key``; hashes of the texts split a key that many rows share.
    """
    schema = pa.schema(
        [("part", pa.int64()), ("seq", pa.int64()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
         ("n_tokens", pa.list_(pa.int64())), ("file", pa.string()), ("at", pa.int64()), ("length", pa.int64())]
    )
    spark = docs.sparkSession
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/codes")
    place.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(place)

    def run(batches):
        code, part, seq = encoder(path), TaskContext.get().partitionId(), 0
        keys, sizes, held, n, at = [], [], [], 0, 0
        store, inside = store_of(f"{folder}/codes")
        name = f"part-{part:05d}-{uuid.uuid4().hex}.bin"
        out = None

        def shard():
            nonlocal out, at
            out = out or store.open_output_stream(f"{inside}/{name}", compression=None)
            codes = pack(np.concatenate(held))
            out.write(codes)
            at += len(codes)
            return pa.RecordBatch.from_arrays(
                [pa.array([part]), pa.array([seq]), pa.array([n]), pa.array([keys], pa.list_(pa.int64())),
                 pa.array([sizes], pa.list_(pa.int64())), pa.array([name]), pa.array([at - len(codes)]), pa.array([len(codes)])],
                schema=schema,
            )

        for batch in text_slices(batches, "_text"):
            ids, starts = code.texts(texts_of(batch, "_text"))
            closed = np.insert(ids, starts[1:], end_id).astype(np.uint32)
            starts = starts + np.arange(len(starts))
            batch_keys = batch.column(0).to_pylist()
            first = 0
            while first < len(batch_keys):
                room = max(starts[first] + SHARD_IDS - n, starts[first + 1])
                last = int(np.searchsorted(starts, room, side="right")) - 1
                keys += batch_keys[first:last]
                sizes += np.diff(starts[first : last + 1]).tolist()
                held.append(closed[starts[first] : starts[last]])
                n += int(starts[last] - starts[first])
                first = last
                if n >= SHARD_IDS or first < len(batch_keys):
                    yield shard()
                    seq, keys, sizes, held, n = seq + 1, [], [], [], 0
        last_shard = [shard()] if keys else []
        if out:
            out.close()
        yield from last_shard
        code.forget()
        release()

    rows = docs.select(F.col(key).cast("long").alias("_key"), F.col(text).alias("_text"))
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    rows = rows.repartitionByRange("_key", "_tie").sortWithinPartitions("_key", "_tie")
    rows.select("_key", "_text").mapInArrow(run, _SHARDS).write.parquet(f"{folder}/index")


def read_shards(spark: SparkSession, folder: str) -> DataFrame:
    """The index of the shards with ``first_id``, the number of ids before each in the whole corpus.

    No code is read. Only sizes pass through the windows: one row per part, then the shards of a part.
    """
    shards = spark.read.schema(_SHARDS).parquet(f"{folder}/index")
    shards = shards.withColumn("file", F.concat(F.lit(f"{folder}/codes/"), "file"))
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = shards.select("part", "seq", "n_ids").withColumn("_in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    places = places.join(parts, "part").select("part", "seq", (F.col("_before") + F.col("_in")).alias("first_id"))
    return shards.join(places, ["part", "seq"])


def read_documents(shards: DataFrame) -> DataFrame:
    """Per document doc_id, start, n_tokens and ids_crc32 of its ids as little-endian 32-bit integers."""
    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                first, keys, sizes, file, at, length = (batch.column(c)[row] for c in range(6))
                store, path = store_of(file.as_py())
                with store.open_input_file(path) as codes:
                    data = codes.read_at(length.as_py(), at.as_py())
                lengths = sizes.values.to_numpy()
                ends = np.cumsum(lengths)
                raw = memoryview(Codes(data).all().astype("<u4").tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(ends - lengths, ends)]
                columns = [keys.values, pa.array(first.as_py() + ends - lengths), pa.array(lengths), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)
        release()

    # The index is small beside the codes, so its rows are dealt out by their number.
    tasks = min(TASKS, max(1, -(-shards.count() // TASK_SHARDS)))
    rows = shards.select("first_id", "doc_ids", "n_tokens", "file", "at", "length").repartition(tasks, "file", "at")
    return rows.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_tokens(shards: DataFrame, positions: DataFrame, position: str = "position") -> DataFrame:
    """``position`` and ``token_id`` of corpus positions, each from its shard alone; others are left out."""
    bits = 19
    last = F.col("first_id") + F.col("n_ids") - 1
    cells = F.explode(F.sequence(F.shiftright("first_id", bits), F.shiftright(last, bits)))
    held = shards.select("first_id", "n_ids", cells.alias("_cell"))
    asked = positions.select(F.col(position).cast("long").alias("_at")).distinct()
    asked = asked.withColumn("_cell", F.shiftright("_at", bits))
    found = asked.join(held, "_cell")
    found = found.filter((F.col("_at") >= F.col("first_id")) & (F.col("_at") < F.col("first_id") + F.col("n_ids")))
    found = found.groupBy("first_id", F.shiftright("_at", 16).alias("_run")).agg(F.collect_list("_at").alias("_at"))
    schema = pa.schema([("position", pa.int64()), ("token_id", pa.int64())])

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                store, path = store_of(row["file"])
                with store.open_input_file(path) as file:
                    codes = StoredCodes(file, row["at"])
                    ids = [codes[at - row["first_id"]] for at in row["_at"]]
                yield pa.RecordBatch.from_arrays([pa.array(row["_at"], pa.int64()), pa.array(ids, pa.int64())], schema=schema)

    joined = found.join(shards.select("first_id", "file", "at"), "first_id").select("first_id", "_at", "file", "at")
    return joined.mapInArrow(run, "position long, token_id long").withColumnRenamed("position", position)
