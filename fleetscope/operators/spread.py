"""Look-ups for rows of which one key may hold a large part."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from fleetscope.session import cut_lineage

# A key with more than one in so many rows is spread; so at most this many keys are.
PIECES = 1000


def hot_keys(rows: DataFrame, keys: Sequence[str], pieces: int = PIECES) -> DataFrame:
    """The keys with more than one in ``pieces`` of all rows, and how many such parts each has.

    The columns are ``_hot_<key>`` and ``_salts``. At most ``pieces`` keys can be
    that frequent, so the highest counts suffice; the total is observed while
    they are taken. Both come from one pass over the rows, which runs here: the
    list is written out and whoever uses it reads at most ``pieces`` rows.
    """
    seen = Observation()
    counts = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).observe(seen, F.sum("_n").alias("total"))
    named = [F.col(k).alias(f"_hot_{k}") for k in keys]
    highest = cut_lineage(counts.orderBy(F.desc("_n")).limit(pieces).select("_n", *named))
    part = F.col("_n") * pieces / F.lit(seen.get["total"] or 1)
    return highest.filter(part > 1).select(*[f"_hot_{k}" for k in keys], F.ceil(part).alias("_salts"))


def spread_lookup(
    rows: DataFrame,
    keyed: DataFrame,
    keys: Sequence[str],
    spread_by: str,
    how: str = "inner",
    pieces: int = PIECES,
    hashed: bool = False,
) -> DataFrame:
    """Join ``rows`` to ``keyed``, which has one row per ``keys``.

    A table that was just aggregated on the join keys is not shuffled again for
    the join, and adaptive execution splits a hot key only between two fresh
    shuffles. So the keys are counted (map-side combined, the rows' other columns
    are not read for it), and those with more than one in ``pieces`` of all rows
    get as many salts as they hold such parts: their rows are spread by a hash of
    the column ``spread_by``, and their row of ``keyed`` is repeated for each salt.
    All other keys are joined as they are. At most ``pieces`` keys can be hot,
    which bounds the list that is broadcast. ``rows`` is evaluated twice: for the
    counts, when this is called, and for the join. Use it where ``keyed`` is the result of an aggregation; ``how`` is inner, left,
    left_semi or left_anti. ``hashed`` is for wide rows and a ``keyed`` much smaller than they are: a task
    holds its part of ``keyed`` in a hash table and does not sort its rows.
    """
    hot = hot_keys(rows, keys, pieces)

    def with_salts(df: DataFrame, salt: Column) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_hot_{k}")) for k in keys])
        marked = df.join(F.broadcast(hot), same, "left").withColumn("_salt", salt)
        return marked.drop("_salts", *[f"_hot_{k}" for k in keys])

    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    salted = with_salts(rows, F.pmod(F.xxhash64(spread_by), salts))
    repeated = with_salts(keyed, F.explode(F.sequence(F.lit(0).cast("long"), salts - 1)))
    if hashed:
        repeated = repeated.hint("shuffle_hash")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
