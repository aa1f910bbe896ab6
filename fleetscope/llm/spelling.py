"""Spelling variants: words one edit apart, grouped under the more frequent form.

Words are counted natively. Every word then generates the words that one deleted
or one replaced code point makes of it (an inserted one is the other word's
deletion, and of a replaced pair the word with the smaller code point asks) and
probes them against Bloom filters, one shard for each length. Only those found
are put together as strings and shuffled to the vocabulary, which removes the
false positives, so a filter never changes a result.

A filter has blocks of 64 bits, and a word sets ``BITS`` of one block. All shards
together hold at most ``filter_bytes``: that is what is broadcast at any size of
the vocabulary. A vocabulary beyond it gets fewer bits a word and more false
positives, not other results. A hash is a polynomial over the code points, so that of
an edited word comes from prefix and suffix sums without the edited word.

Null and empty texts have no words. A null doc_id counts as an empty one in the
fold's hash. Very long texts and words stay whole; the edits of a word are
generated ``CHUNK`` at a time. Rows count as often as they occur. Ties of the most
frequent neighbour go to the smallest in code-point order. Extra columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import mix64, release
from fleetscope.session import cut_lineage

RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Code points that a word can hold.
ALPHABET = np.array([*map(ord, LOWER), *range(0xC0, 0x100)], np.uint64)
MIN_LENGTH, MIN_COUNT, TIMES = 6, 5, 5
BITS = 4
BITS_PER_WORD = 24
FILTER_BYTES = 32 << 20
#: Edits that a task holds at once.
CHUNK = 1 << 20
BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_INVERSE = pow(BASE, -1, 1 << 64)


# --- Words ----------------------------------------------------------------------------


def folded_runs(key: Column, text: Column, one_in: int | None) -> Column:
    """The lower-cased runs of a text; in one of ``one_in`` (by hash of key and run) a code point is missing."""
    runs = F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(RUN), F.lit(0))
    if one_in is None:
        return runs
    prefix = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"))

    def folded(run: Column) -> Column:
        h = F.crc32(F.concat(prefix, run).cast("binary"))
        at = (h % F.length(run)).cast("int")
        shorter = F.concat(F.substr(run, F.lit(1), at), F.substr(run, at + 2))
        return F.when(h % one_in == 0, shorter).otherwise(run)

    return F.transform(runs, folded)


def vocabulary(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    one_in: int | None = None,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """word, n: the words of all texts that are long and frequent enough; written out."""
    words = docs.select(F.explode(folded_runs(F.col(key), F.col(text), one_in)).alias("word"))
    counts = words.filter(F.length("word") >= min_length).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return cut_lineage(counts.filter(F.col("n") >= min_count))


# --- Filters --------------------------------------------------------------------------


def _by_length(words: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places in the list, code points as a matrix) for each length. Code points are below 256."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for places in np.split(order, np.flatnonzero(np.diff(lengths[order])) + 1) if len(words) else ():
        length = int(lengths[places[0]])
        step = max(1, CHUNK // max(1, length))
        for i in range(0, len(places), step):
            some = places[i : i + step]
            text = "".join(words[k] for k in some.tolist()).encode("latin-1")
            yield length, some, np.frombuffer(text, np.uint8).reshape(len(some), length)


def _powers(length: int) -> np.ndarray:
    out = np.ones(length + 1, np.uint64)
    out[1:] = np.cumprod(np.full(length, BASE, np.uint64), dtype=np.uint64)
    return out


def _place(hashes: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """Block and bits of words with these hashes."""
    mixed = mix64(hashes)
    block = (mixed >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)
    mask = np.zeros(len(mixed), np.uint64)
    for k in range(BITS):
        mask |= np.uint64(1) << (mixed >> np.uint64(6 * k) & np.uint64(63))
    return block, mask


def _hash(points: np.ndarray) -> np.ndarray:
    return (points.astype(np.uint64) * _powers(points.shape[1])[:-1]).sum(1, dtype=np.uint64)


def build_filters(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> dict[int, np.ndarray]:
    """Blocks of 64 bits for each length: bits are set by tasks and combined before they are collected."""
    sizes = {r["length"]: r["n"] for r in words.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(sizes.values())
    if not total:
        return {}
    bits = min(BITS_PER_WORD, filter_bytes * 8 / total)
    blocks = {length: max(1, math.floor(n * bits / 64)) for length, n in sizes.items()}
    schema = pa.schema([("length", pa.int32()), ("block", pa.int64()), ("bits", pa.int64())])

    def run(batches):
        for batch in batches:
            for length, _, points in _by_length(batch.column(0).to_pylist()):
                block, mask = _place(_hash(points), blocks[length])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(block), length, np.int32)), pa.array(block.astype(np.int64)),
                     pa.array(mask.view(np.int64))], schema=schema)

    marks = words.select("word").mapInArrow(run, "length int, block long, bits long")
    marks = marks.groupBy("length", "block").agg(F.bit_or("bits").alias("bits"))
    filters = {length: np.zeros(n, np.uint64) for length, n in blocks.items()}
    table = marks.toArrow()
    length, block, word = (table.column(c).to_numpy() for c in ("length", "block", "bits"))
    for key in filters:
        here = length == key
        filters[key][block[here]] = word[here].view(np.uint64)
    return filters


# --- Neighbours -----------------------------------------------------------------------


def _found(filters: dict[int, np.ndarray], length: int, hashes: np.ndarray) -> np.ndarray:
    shard = filters[length]
    block, mask = _place(hashes, len(shard))
    return np.flatnonzero(shard[block] & mask == mask)


def probes(filters: dict[int, np.ndarray], words: list[str]) -> Iterator[tuple[list[str], list[str]]]:
    """(words, edited words) that the filters hold, in chunks."""
    for length, places, points in _by_length(words):
        powers = _powers(length)
        wide = points.astype(np.uint64)
        terms = wide * powers[:-1]
        prefix = np.concatenate((np.zeros((len(points), 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)), axis=1)
        whole = prefix[:, -1]
        if length - 1 in filters:
            # Without code point i those behind it move one place down. Of equal neighbours only the first is deleted.
            rest = (whole[:, None] - prefix[:, 1:]) * np.uint64(_INVERSE)
            row, at = np.nonzero(np.diff(points, axis=1, prepend=0) != 0)
            hit = _found(filters, length - 1, prefix[row, at] + rest[row, at])
            yield _strings(words, places, row[hit], lambda w, i: w[:i] + w[i + 1 :], at[hit])
        if length in filters:
            for point in ALPHABET.tolist():
                row, at = np.nonzero(points < point)
                if len(row):
                    hashes = whole[row] + (np.uint64(point) - wide[row, at]) * powers[at]
                    hit = _found(filters, length, hashes)
                    yield _strings(words, places, row[hit], lambda w, i, c=chr(point): w[:i] + c + w[i + 1 :], at[hit])


def _strings(words, places, row, edit, at) -> tuple[list[str], list[str]]:
    whole = [words[k] for k in places[row].tolist()]
    return whole, [edit(w, i) for w, i in zip(whole, at.tolist())]


def neighbours(words: DataFrame, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, n, near, near_n: both directions of each pair of words one edit apart."""
    spark = words.sparkSession
    filters = spark.sparkContext.broadcast(build_filters(words, filter_bytes))
    schema = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.string())])

    def run(batches):
        for batch in batches:
            texts = batch.column(0).to_pylist()
            count = dict(zip(texts, batch.column(1).to_pylist()))
            for left, right in probes(filters.value, texts):
                if left:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(left, pa.string()), pa.array([count[w] for w in left], pa.int64()),
                         pa.array(right, pa.string())], schema=schema)
        release()

    # The vocabulary is small beside the work on it, so it is dealt to all tasks anew.
    asked = words.repartition(_tasks(words), "word").mapInArrow(run, "word string, n long, near string")
    exact = asked.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    both = F.array(
        F.struct("word", "n", "near", "near_n"),
        F.struct(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")),
    )
    return exact.select(F.inline(both))


def _tasks(words: DataFrame) -> int:
    return int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))


# --- Groups ---------------------------------------------------------------------------


def variants(words: DataFrame, times: int = TIMES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n for each row (word, n) of a vocabulary.

    ``words`` is read several times: write it out first, as ``vocabulary`` does.
    """
    near = neighbours(words, filter_bytes).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best")
    )
    rows = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(-F.col("best.order") >= times * F.col("n"), F.struct(F.col("best.near").alias("form"), (-F.col("best.order")).alias("form_n"))).alias("to"),
    )
    rows = cut_lineage(rows.select("word", "n", "n_near", "to.*"))
    return rows.join(roots(rows, times), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def roots(rows: DataFrame, times: int = TIMES) -> DataFrame:
    """word, root for words with a form, by doubling the steps taken.

    A form is ``times`` as frequent as its word, so the highest count bounds the
    length of a chain and the number of rounds.
    """
    step = rows.filter("form IS NOT NULL").select("word", F.col("form").alias("root"))
    low, high = rows.agg(F.min("n"), F.max("n")).first()
    if low is None:
        return step
    longest = math.floor(math.log(high / low, times)) + 1 if times > 1 else rows.count()
    for _ in range(max(0, math.ceil(math.log2(longest + 1)))):
        further = step.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        step = step.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root"))
        step = cut_lineage(step)
    return step
