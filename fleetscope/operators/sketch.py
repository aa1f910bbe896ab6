"""A Bloom filter over the keys of a small side, to thin a large one before a join.

The filter is a row of 64-bit words that Spark aggregates from the keys and hands to the
filter of the large side as a scalar, so it is neither joined nor copied per row. It
holds at most ``MAX_WORDS`` words (2 MB). More keys than that was made for only
let more rows through; a key that the small side has always passes.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS_A_KEY = 16
PROBES = 4
MAX_WORDS = 1 << 18


def word_count(expected: int) -> int:
    """Words for ``expected`` keys, a power of two."""
    wanted = max(1, -(-expected * BITS_A_KEY // 64))
    return min(MAX_WORDS, 1 << (wanted - 1).bit_length())


def _probes(columns: Sequence[str], words: int) -> list[tuple[Column, Column]]:
    """The word and the bit of each probe."""
    hashes = [F.xxhash64(*columns, F.lit(seed)) for seed in range(PROBES)]
    return [
        (F.shiftrightunsigned(h, 6).bitwiseAND(words - 1), h.bitwiseAND(63).cast("int")) for h in hashes
    ]


def key_words(keys: DataFrame, columns: Sequence[str], expected: int) -> DataFrame:
    """One row with the filter's words, in order."""
    words = word_count(expected)
    probes = F.array(*[F.struct(w.alias("word"), b.alias("bit")) for w, b in _probes(columns, words)])
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("probe.bit"))
    set_bits = (
        keys.select(F.explode(probes).alias("probe"))
        .groupBy(F.col("probe.word").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
    )
    filled = keys.sparkSession.range(words).withColumnRenamed("id", "word").join(set_bits, "word", "left")
    pairs = F.sort_array(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return filled.agg(F.transform(pairs, lambda p: p["bits"]).alias("words"))


def may_match(
    large: DataFrame, keys: DataFrame, columns: Sequence[str], expected: int
) -> DataFrame:
    """``large`` without most of the rows whose key ``keys`` does not have.

    ``keys`` is read once more for it, so it should be stored or cached.
    """
    words = key_words(keys, columns, expected).scalar()
    hit = F.lit(True)
    for word, bit in _probes(columns, word_count(expected)):
        hit = hit & (F.getbit(F.get(words, word.cast("int")), bit) == 1)
    return large.filter(hit)
