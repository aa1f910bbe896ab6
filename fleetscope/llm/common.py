"""What the operators share: slices of Arrow batches, words, written tables."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import fleetscope

#: Bytes of text that a task turns into arrays at once.
SLICE_BYTES = 5 << 20


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Sends this package to the executors, which need it in their tasks; once per application."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(fleetscope.__file__).parent
    archive = Path(tempfile.mkdtemp(prefix="fleetscope-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store_of(location: str):
    """Arrow's file system of a location, and the path in it."""
    from pyarrow import fs

    if location.startswith("file:"):
        return fs.LocalFileSystem(), "/" + location[5:].lstrip("/")
    return fs.FileSystem.from_uri(location)


def texts_of(batch: pa.RecordBatch, column: str) -> pa.Array:
    """The column as strings; null becomes empty."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(column)), "")


def text_slices(
    batches: Iterator[pa.RecordBatch], column: str, budget: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """The batches cut into row ranges with about ``budget`` bytes of text each.

    A single row may be larger; no row is cut or left out.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0)
        ends = np.cumsum(lengths.to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + budget, side="right")))
            yield batch.slice(start, stop - start)
            start = stop


def release() -> None:
    """Gives memory that this worker has freed back to the system; workers outlive their tasks."""
    import ctypes

    # Memory of the system's allocator can be given back; Arrow's own keeps what it had.
    if pa.default_memory_pool().backend_name != "system":
        pa.set_memory_pool(pa.system_memory_pool())
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # not every C library has it
        pass


def tidy(run):
    """``run`` over batches, with the memory released at the end of the task."""

    def tidied(batches):
        yield from run(batches)
        release()

    return tidied


class Words(NamedTuple):
    """Words of several texts: those of text i are codes[starts[i]:starts[i + 1]]."""

    starts: np.ndarray
    codes: np.ndarray
    uniques: pa.Array


def split_words(texts: pa.Array) -> Words:
    """Words between white space, each as its number among the different words."""
    lists = pc.utf8_split_whitespace(texts)
    flat = lists.flatten()
    starts = lists.offsets.to_numpy().astype(np.int64)
    starts = starts - starts[0]
    filled = pc.greater(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not filled.all():
        starts = np.concatenate(([0], np.cumsum(filled)))[starts]
        flat = flat.filter(pa.array(filled))
    coded = flat.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    return Words(starts, coded.indices.to_numpy().astype(np.int32), coded.dictionary)


def ragged_take(starts: np.ndarray, lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Positions of the items of the chosen lists, one list after the other."""
    counts = lengths[chosen]
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(counts) - counts
    return np.repeat(starts[chosen] - before, counts) + np.arange(total)


def mix64(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of unsigned 64-bit numbers."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


def word_hashes(uniques: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, the same in every process."""
    from xxhash import xxh64_intdigest

    return np.fromiter((xxh64_intdigest(w) for w in uniques.to_pylist()), np.uint64, len(uniques))
