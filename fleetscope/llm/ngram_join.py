"""Near-duplicate texts by the Jaccard similarity of their word n-grams.

Words are runs between white space. Texts with the same set of n-grams are one
class. MinHash signatures of the classes are cut into bands; classes that share
a band's hash are candidates. Bands and rows are chosen so that a pair at the
similarity is found with at least the wished recall, and a pair far below it
seldom. The band hashes are shuffled with an id alone. Candidates form
components, and inside each component all pairs are verified on their full sets
of n-grams, in blocks, so that no link between candidates is lost and no row per
pair is made, however many copies there are.

A text with fewer words than an n-gram is one n-gram of all its words. Null texts
and texts without a word link with nothing. Repeated rows are copies of each
other. A null id is kept and is never a class's id unless all ids are null. Extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import mix64, split_words, text_slices, texts_of, tidy, word_hashes
from fleetscope.llm.graph import compare_members, components
from fleetscope.session import cut_lineage

WORDS = 5
SIMILARITY = 0.8
RECALL = 0.999
_C = np.uint64(0x9E3779B97F4A7C15)


def banding(similarity: float, recall: float, far: float, noise: float = 0.1) -> tuple[int, int]:
    """(bands, rows): the fewest hashes that find pairs at ``similarity`` with ``recall`` and pairs at
    ``far`` in at most ``noise`` of cases."""
    best = None
    for rows in range(1, 21):
        miss = 1 - similarity**rows
        bands = 1 if miss <= 0 else int(np.ceil(np.log(1 - recall) / np.log(miss)))
        cost = bands * rows
        if 1 - (1 - far**rows) ** bands <= noise and (best is None or cost < best[0] * best[1]):
            best = (bands, rows)
    return best or (1, 1)


def shingles(texts: pa.Array, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different n-gram hashes of each text, and where each text's begin."""
    starts, codes, uniques = split_words(texts)
    words = word_hashes(uniques)[codes] if len(codes) else np.zeros(0, np.uint64)
    lengths = np.diff(starts)
    grams = np.where(lengths > 0, np.maximum(lengths - n + 1, 1), 0)
    row = np.repeat(np.arange(len(lengths)), grams)
    at = starts[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(grams) - grams, grams)
    stop = starts[1:][row]
    mixed = np.zeros(len(row), np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    for j in range(n):
        mixed = mixed * _C + np.where(at + j < stop, mix64(padded[at + j] + np.uint64(1)), np.uint64(0))
    mixed = mix64(mixed)
    order = np.lexsort((mixed, row))
    row, mixed = row[order], mixed[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (mixed[1:] != mixed[:-1])
    row, mixed = row[new], mixed[new]
    return mixed, np.concatenate(([0], np.cumsum(np.bincount(row, minlength=len(lengths)))))


def _signatures(bands: int, rows: int, n: int):
    schema = pa.schema([("doc_id", pa.int64()), ("mark", pa.int64()), ("n", pa.int32()), ("one", pa.int64()), ("two", pa.int64()), ("bands", pa.list_(pa.int64()))])
    rng = np.random.default_rng(5)
    times = rng.integers(1 << 63, size=bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    plus = rng.integers(1 << 63, size=bands * rows, dtype=np.uint64)

    def run(batches):
        for batch in text_slices(batches, "text", 3 << 20):
            grams, starts = shingles(texts_of(batch, "text"), n)
            sizes = np.diff(starts)
            filled = np.flatnonzero(sizes)
            begin = starts[:-1][filled]
            one, two = np.zeros(len(sizes), np.uint64), np.zeros(len(sizes), np.uint64)
            found = np.zeros((len(sizes), bands), np.uint64)
            if len(filled):
                one[filled] = np.add.reduceat(mix64(grams), begin)
                two[filled] = np.add.reduceat(mix64(grams ^ _C), begin)
                for b in range(bands):
                    held = np.full(len(filled), b + 1, np.uint64)
                    for r in range(b * rows, (b + 1) * rows):
                        hashed = (grams * times[r] + plus[r] >> np.uint64(32)).astype(np.uint32)
                        held = mix64(held * _C + np.minimum.reduceat(hashed, begin))
                    found[filled, b] = held
            offsets = np.arange(len(sizes) + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(sizes.astype(np.int32)), pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                 pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.reshape(-1).view(np.int64)))],
                schema=schema,
            )

    return run


def _linked(similarity: float, n: int):
    """Links between texts from the sizes of their sets and intersections."""

    def links(table: pa.Table) -> np.ndarray:
        texts = pc.fill_null(table.column("text").combine_chunks(), "")
        grams, starts = shingles(texts, n)
        sizes, m = np.diff(starts), len(texts)
        if m == 2:
            both = len(np.intersect1d(grams[: starts[1]], grams[starts[1] :], assume_unique=True))
            return np.full((2, 2), both >= similarity * (sizes.sum() - both) - 1e-9)
        row = np.repeat(np.arange(m), sizes)
        order = np.argsort(grams, kind="stable")
        number = np.cumsum(np.diff(grams[order], prepend=grams[order[:1]]) != 0)
        row = row[order]
        several = np.bincount(number)[number] > 1
        row, number = row[several], number[several]
        number = np.cumsum(np.diff(number, prepend=number[:1]) != 0)
        common = np.zeros((m, m), np.float32)
        width = max(256, (1 << 21) // m)
        cuts = np.searchsorted(number, np.arange(0, (number[-1] if len(number) else 0) + width + 1, width))
        for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
            if a < b:
                part = np.zeros((m, width), np.float32)
                part[row[a:b], number[a:b] - k * width] = 1
                common += part @ part.T
        return common >= similarity * (sizes[:, None] + sizes - common) - 1e-9

    return links


def join(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    n: int = WORDS,
    similarity: float = SIMILARITY,
    recall: float = RECALL,
) -> DataFrame:
    """Per document ``key``, mark, class_id, n_links and kept.

    class_id is the smallest id that links lead to, n_links the number of other documents at
    ``similarity`` or more. kept marks the document of that id, one for each class; rows with both key
    and text alike share the mark and are kept or not together.
    """
    bands, rows = banding(similarity, recall, similarity / 2)
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), text_mark(text).alias("mark"), F.col(text).alias("text"))
    ddl = "doc_id long, mark long, n int, one long, two long, bands array<long>"
    signed = cut_lineage(texts.mapInArrow(tidy(_signatures(bands, rows, n)), ddl))
    same = ["one", "two", "n"]
    id_order = F.coalesce("doc_id", F.lit((1 << 63) - 1))
    classes = signed.filter("n > 0").groupBy(*same).agg(
        F.count(F.lit(1)).alias("size"), F.min("doc_id").alias("low"),
        F.min(F.struct(id_order.alias("at"), "mark", "doc_id")).alias("first"), F.first("bands").alias("bands"),
    )
    classes = cut_lineage(classes)
    # Candidates: classes in one bucket, each with the bucket's smallest.
    held = classes.select(F.col("one").alias("a"), F.explode("bands").alias("band"))
    heads = held.groupBy("band").agg(F.min("a").alias("b"), F.max("a").alias("_most")).filter("b < _most").drop("_most")
    found = components(held.join(heads, "band").filter("a <> b").select("a", "b"))
    members = classes.join(found, F.col("one") == F.col("id")).select(
        F.col("component"), F.col("one").alias("node"), F.col("size").alias("weight"),
        F.col("first.doc_id").alias("_id"), F.col("first.mark").alias("_mark"),
    )
    keys = members
    members = texts.join(keys, texts["doc_id"].eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark")))
    # Rows with both id and text alike stand for one.
    members = members.select("component", "node", "weight", "text").dropDuplicates(["node"])
    compared = cut_lineage(compare_members(cut_lineage(members), _linked(similarity, n), ["text"]))
    links = compared.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(compared.filter("links > 0").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = classes.select(*same, "size", "low", "first").join(links, F.col("one") == F.col("node"), "left").drop("node")
    known = known.join(joined, F.col("one") == F.col("id"), "left").drop("id")
    known = known.withColumn("component", F.coalesce("component", "one"))
    lowest = known.groupBy("component").agg(F.min("low").alias("class_id"), F.min("first").alias("head"))
    known = known.join(lowest, "component").select(
        *same, "class_id", "head", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    linked = signed.filter("n > 0").select("doc_id", "mark", *same).join(known, same)
    kept = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("mark") == F.col("head.mark"))
    linked = linked.select("doc_id", "mark", "class_id", "n_links", kept.alias("kept"))
    alone = signed.filter("n = 0").select(
        "doc_id", "mark", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(True).alias("kept")
    )
    return linked.unionByName(alone).withColumnRenamed("doc_id", key)


def text_mark(text: str) -> Column:
    """A hash of the text that, beside the key, tells rows apart."""
    return F.xxhash64(F.col(text))
