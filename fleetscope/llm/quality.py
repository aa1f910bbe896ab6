"""Quality scores by voting of the nearest labelled texts in a latent space.

A text becomes the logarithms of its hashed byte trigram counts, weighted by
inverse document frequency, and next to them a few terms that tell how far it
can be compressed, which shows repetition. A truncated singular value decomposition of a
bounded sample of labelled texts gives the latent space. The sample's vectors
are broadcast, and every text is compared with all of them by exact cosine
products, block by block. The ``neighbours`` nearest vote for their label with
their similarity to the power ``sharpness``; votes of a label that the sample
holds less often than the labelled rows do count for more.

Null and empty texts, and texts of fewer than three bytes, have no trigram; they
get the share of label 1 among the labelled rows. Without labelled rows every
score is 0.5. Rows without a label and labels without a document teach nothing;
repeated rows are scored each; extra columns stay as they are. Which of equally near neighbours is
the last to vote depends on the sample alone. Texts of any length count whole; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import text_slices, texts_of, tidy

#: Hashed trigrams, dimensions of the latent space, texts compared at once.
FEATURES = 2048
DIMENSIONS = 64
BLOCK = 256
#: Terms for the compression ratio, and their weight next to all trigrams.
RATIOS = 12
RATIO_WEIGHT = 1.0
#: Labelled rows of each label that are kept; bounds the model whatever the input.
PER_LABEL = 2000


def trigram_counts(texts: pa.Array) -> np.ndarray:
    """Hashed byte trigram counts of each text; no trigram spans two texts. The ratio terms follow."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    if data is None or offsets[-1] - offsets[0] < 3:
        return np.zeros((len(texts), FEATURES + RATIOS), np.float32)
    plain = memoryview(data)[offsets[0] : offsets[-1]]
    raw = np.frombuffer(plain, np.uint8).astype(np.uint32)
    offsets = (offsets - offsets[0]).astype(np.int64)
    code = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
    code = (code * np.uint32(0x9E3779B1) >> np.uint32(32 - 11)).astype(np.int64)
    out = np.zeros((len(texts), FEATURES + RATIOS), np.float32)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        if b - a < 3:
            continue
        out[i, :FEATURES] = np.bincount(code[a : b - 2], minlength=FEATURES)
        # Ratios on a logarithmic scale, shared between the two nearest terms.
        at = min(RATIOS - 1.001, max(0.0, -2.0 * np.log2(len(zlib.compress(plain[a:b], 1)) / (b - a))))
        out[i, FEATURES + int(at) : FEATURES + int(at) + 2] = (1 - at % 1, at % 1)
    return out


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, length, out=np.zeros_like(rows), where=length > 0)


def _weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    trigrams = _unit(np.log1p(counts[:, :FEATURES]) * idf)
    return np.hstack([trigrams, RATIO_WEIGHT * counts[:, FEATURES:]])


@dataclass
class Model:
    """Everything a task needs; its size depends on the parameters only."""

    idf: np.ndarray
    axes: np.ndarray
    vectors: np.ndarray
    votes: np.ndarray
    labels: np.ndarray
    prior: float
    neighbours: int
    sharpness: float

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_weighted(counts, self.idf) @ self.axes)

    def scores(self, counts: np.ndarray) -> np.ndarray:
        out = np.full(len(counts), self.prior)
        if not len(self.labels):
            return out
        own = self.latent(counts)
        for k in range(0, len(own), BLOCK):
            near = own[k : k + BLOCK] @ self.vectors.T
            m = min(self.neighbours, near.shape[1])
            best = np.argpartition(near, near.shape[1] - m, axis=1)[:, -m:]
            weight = np.maximum(np.take_along_axis(near, best, 1), 0).astype(np.float64) ** self.sharpness
            weight *= self.votes[best]
            total = weight.sum(1)
            share = (weight * self.labels[best]).sum(1)
            rows = np.flatnonzero(total > 0)
            out[k + rows] = share[rows] / total[rows]
        return np.clip(out, 0.0, 1.0)


def fit(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    per_label: int = PER_LABEL,
    dimensions: int = DIMENSIONS,
    neighbours: int = 25,
    sharpness: float = 12.0,
) -> Model:
    """A model from the labelled documents: at most ``per_label`` of each label, chosen by a hash of the key.

    The choice is made on the narrow labels, so texts outside it are never moved.
    """
    known = labels.filter(F.col(label).isin(0, 1) & F.col(key).isNotNull())
    known = known.join(docs.select(key).distinct(), key, "left_semi")
    sizes = {r[0]: r[1] for r in known.groupBy(label).count().collect()}
    chosen = known.select(F.col(key).alias("_key"), F.col(label).cast("long").alias("_label"))
    # Each partition keeps its smallest hashes only, so no task holds a label.
    drawn = [F.xxhash64(F.lit("sample"), "_key"), F.col("_key")]
    first, second = (chosen.filter(F.col("_label") == v).orderBy(*drawn).limit(per_label) for v in (0, 1))
    chosen = first.unionByName(second)  # at most 2 * per_label rows
    sample = docs.select(key, text).join(F.broadcast(chosen), F.col(key) == F.col("_key"))
    sample = sample.select(F.col("_key"), F.col("_label"), F.col(text).alias("_text"))
    schema = pa.schema([("key", pa.int64()), ("label", pa.int64()), ("at", pa.binary()), ("counts", pa.binary())])

    def run(batches):
        for batch in text_slices(batches, "_text"):
            counts = trigram_counts(texts_of(batch, "_text"))
            filled = [np.flatnonzero(c) for c in counts]
            at = pa.array([f.astype(np.uint16).tobytes() for f in filled], pa.binary())
            packed = pa.array([c[f].tobytes() for c, f in zip(counts, filled)], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.int64()), at, packed], schema=schema
            )

    # Counts that are not zero, as exact as those of the texts to be scored.
    rows = sample.mapInArrow(tidy(run), "key long, label long, at binary, counts binary")
    rows = rows.dropDuplicates(["key", "label"]).orderBy("key", "label").limit(2 * per_label).collect()
    if not rows:
        empty = np.zeros((0, dimensions), np.float32)
        return Model(np.ones(FEATURES, np.float32), np.zeros((FEATURES + RATIOS, dimensions), np.float32), empty, np.zeros(0),
                     np.zeros(0), 0.5, neighbours, sharpness)
    counts = np.zeros((len(rows), FEATURES + RATIOS), np.float32)
    for i, r in enumerate(rows):
        counts[i, np.frombuffer(r["at"], np.uint16)] = np.frombuffer(r["counts"], np.float32)
    marks = np.array([r["label"] for r in rows], np.float64)
    in_texts = (counts[:, :FEATURES] > 0).sum(0)
    idf = np.log((1 + len(rows)) / (1 + in_texts)).astype(np.float32) + np.float32(1)
    weighted = _weighted(counts, idf)
    # Randomised range finder with two power steps, then the exact decomposition of the small rest.
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(weighted.T @ rng.standard_normal((len(rows), dimensions + 16)).astype(np.float32))[0]
    for _ in range(2):
        basis = np.linalg.qr(weighted.T @ (weighted @ basis))[0]
    _, _, right = np.linalg.svd(weighted @ basis, full_matrices=False)
    axes = (basis @ right[:dimensions].T).astype(np.float32)
    vectors = _unit(weighted @ axes)
    total = sum(sizes.values())
    in_sample = {v: max(1, int((marks == v).sum())) for v in (0, 1)}
    votes = np.array([sizes.get(int(v), 0) / in_sample[int(v)] for v in marks])
    return Model(idf, axes, vectors, votes, marks, sizes.get(1, 0) / total, neighbours, sharpness)


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score") -> DataFrame:
    """The rows with the score of their text in column ``name``, which replaces one of that name."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop(name)

    def run(batches):
        for batch in text_slices(batches, text, 2 << 20):
            scores = held.value.scores(trigram_counts(texts_of(batch, text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], names=[*batch.schema.names, name])

    return kept.mapInArrow(tidy(run), T.StructType([*kept.schema.fields, T.StructField(name, T.DoubleType())]))
