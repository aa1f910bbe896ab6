"""Language of whole texts, and the spans of each language inside them.

Words are runs between white space, without the characters that are no letters.
The script of a word's first letter narrows the languages it can be in, and the
word's byte trigrams (with its two edges) give a score for each of those. A
Viterbi path over the words, in which a change of language costs ``penalty``,
labels spans; the language with most letters is the text's, its share the score.

The model is learned by counting over all given documents: trigrams and scripts
per language, added up by Spark. It holds ``TRIGRAMS`` numbers per language.

Null and empty texts, and texts without a letter, are ``und`` with score 0, as is
every text if nothing was learned; marks alone are no letters. A word in a script that no learned language
uses says nothing: its letters lower the score, down to 0 for a text of such words only, which gets the first language. Ties go to the language that is first by code point. Repeated
rows are kept, extra columns ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import split_words, text_slices, texts_of, tidy

TRIGRAMS = 1 << 14
#: First code points of script ranges and the script's number; letters before the first are none.
SCRIPTS = [
    (0x41, 1), (0x370, 2), (0x400, 3), (0x530, 4), (0x590, 5), (0x600, 6), (0x900, 7), (0x980, 8), (0xA00, 9),
    (0xE00, 10), (0x10A0, 11), (0x1100, 12), (0x1200, 13), (0x1E00, 1), (0x1F00, 2), (0x2C00, 3), (0x2C60, 1),
    (0x2E80, 14), (0x3040, 15), (0x3100, 14), (0x3130, 12), (0x31F0, 15), (0x3400, 14), (0xA000, 16),
    (0xA640, 3), (0xA700, 1), (0xAC00, 12), (0xD7FC, 16), (0xF900, 14), (0xFB00, 1), (0xFB1D, 5), (0xFB50, 6),
    (0xFF00, 1), (0xFF66, 15), (0xFFDC, 16), (0x20000, 14), (0x40000, 16),
]
N_SCRIPTS = 17
#: Share of a language's words in a script from which the script can be that language.
USED = 0.01


class _Words:
    """The different words of a slice: their letters, script and hashed trigrams."""

    def __init__(self, texts: pa.Array):
        self.starts, self.codes, uniques = split_words(texts)
        letters = pc.utf8_lower(pc.replace_substring_regex(uniques, r"[^\pL\pM]+", ""))
        # Marks belong to a word with a letter; alone they are none.
        letters = pc.if_else(pc.match_substring_regex(letters, r"\pL"), letters, "")
        self.letters = pc.utf8_length(pc.replace_substring_regex(letters, r"\pM+", "")).to_numpy().astype(np.int64)
        first = pc.utf8_slice_codeunits(pc.replace_substring_regex(letters, r"^\pM+", ""), 0, 1).dictionary_encode()
        points = [ord(c) if c else 0 for c in first.dictionary.to_pylist()]
        firsts, scripts = map(np.array, zip(*SCRIPTS))
        at = np.searchsorted(firsts, points, side="right") - 1
        self.scripts = np.where(at < 0, 0, scripts[np.maximum(at, 0)])[first.indices.to_numpy()] if points else np.zeros(0, int)
        # Each word between two blanks; as many trigrams as it has bytes.
        marked = pc.binary_join_element_wise(" ", letters, " ", "")
        offsets = np.frombuffer(marked.buffers()[1], np.int32)[marked.offset :][: len(marked) + 1].astype(np.int64)
        raw = np.frombuffer(marked.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]].astype(np.uint32)
        offsets -= offsets[0]
        code = np.zeros(0, np.uint32)
        if len(raw) > 2:
            code = raw[:-2] | raw[1:-1] << np.uint32(8) | raw[2:] << np.uint32(16)
        inside = np.ones(len(code), bool)
        inside[offsets[1:-1] - 1] = False
        inside[offsets[1:-1] - 2] = False
        self.grams = (code[inside] * np.uint32(0x9E3779B1) >> np.uint32(18)).astype(np.int64)
        self.sizes = np.diff(offsets) - 2


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # languages x trigrams
    fits: np.ndarray  # scripts x languages
    penalty: float

    def word_scores(self, words: _Words) -> np.ndarray:
        """Evidence of each different word for each language; 0 where there is none."""
        out = np.zeros((len(words.sizes), len(self.languages)))
        if not len(words.grams):
            return out
        filled = np.flatnonzero(words.sizes > 0)
        begin = (np.cumsum(words.sizes) - words.sizes)[filled]
        for i, row in enumerate(self.logs):
            out[filled, i] = np.add.reduceat(row[words.grams], begin)
        fits = self.fits[words.scripts]
        out = np.where(fits, out, -np.inf)
        best = out.max(1, keepdims=True)
        out = np.maximum(np.subtract(out, best, where=np.isfinite(best), out=np.zeros_like(out)), -40.0)
        out[~fits.any(1) | (words.letters == 0)] = 0.0
        return out

    def path(self, words: _Words) -> np.ndarray:
        """The language of each word on its text's best path."""
        scores = self.word_scores(words)[words.codes]
        lengths = np.diff(words.starts)
        order = np.argsort(-lengths, kind="stable")
        first, lengths = words.starts[:-1][order], lengths[order]
        steps = int(lengths[0]) if len(lengths) else 0
        running = np.searchsorted(-lengths, -np.arange(steps), side="left")
        value = np.zeros((len(lengths), len(self.languages)))
        keeps = np.zeros((len(scores), len(self.languages)), bool)
        jumps = np.zeros(len(scores), np.int32)
        for t in range(steps):
            n = running[t]
            at, before = first[:n] + t, value[:n]
            jump = before.argmax(1)
            least = before[np.arange(n), jump] - self.penalty
            keep = before >= least[:, None]
            keeps[at], jumps[at] = keep, jump
            value[:n] = np.where(keep, before, least[:, None]) + scores[at]
        now = value.argmax(1)
        out = np.zeros(len(scores), np.int32)
        for t in range(steps - 1, -1, -1):
            n = running[t]
            at, own = first[:n] + t, now[:n]
            out[at] = own
            now[:n] = np.where(keeps[at, own], own, jumps[at])
        return out


def fit(
    docs: DataFrame, text: str = "text", lang: str = "lang", penalty: float = 8.0, smoothing: float = 0.5
) -> Model:
    """Trigrams and scripts of every language, counted over all documents with a language.

    The counts come to the driver: TRIGRAMS + N_SCRIPTS numbers per language.
    """
    schema = pa.schema([("lang", pa.string()), ("cell", pa.int32()), ("n", pa.int64())])

    def run(batches):
        total: dict[str, np.ndarray] = {}
        for batch in text_slices(batches, "_text"):
            words = _Words(texts_of(batch, "_text"))
            langs = batch.column(0).dictionary_encode()
            ids = langs.indices.to_numpy()
            for i, name in enumerate(langs.dictionary.to_pylist()):
                of_lang = np.repeat(ids == i, np.diff(words.starts))
                times = np.bincount(words.codes[of_lang], minlength=len(words.sizes))
                grams = np.bincount(words.grams, np.repeat(times, words.sizes), TRIGRAMS)
                scripts = np.bincount(words.scripts, times * (words.letters > 0), N_SCRIPTS)
                total[name] = total.get(name, 0) + np.concatenate([grams, scripts]).astype(np.int64)
        for name, counts in total.items():
            cells = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(counts[cells])],
                schema=schema,
            )

    rows = docs.filter(F.col(lang).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("_text"))
    counted = rows.mapInArrow(tidy(run), "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n"))
    found = counted.toArrow()
    names = sorted(set(found.column("lang").to_pylist()))
    counts = np.zeros((len(names), TRIGRAMS + N_SCRIPTS))
    place = {name: i for i, name in enumerate(names)}
    at = [place[x] for x in found.column("lang").to_pylist()]
    counts[at, found.column("cell").to_numpy()] = found.column("n").to_numpy()
    grams, scripts = counts[:, :TRIGRAMS] + smoothing, counts[:, TRIGRAMS:].copy()
    scripts[:, 0] = 0
    fits = (scripts >= USED * scripts.sum(1, keepdims=True)) & (scripts > 0)
    return Model(names, np.log(grams / grams.sum(1, keepdims=True)), fits.T.copy(), penalty)


def predict(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document ``key``, lang_pred, score and spans (language, first word, number of words)."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    span = pa.struct([("lang", pa.string()), ("start", pa.int64()), ("n_words", pa.int64())])
    schema = pa.schema([("key", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64()), ("spans", pa.list_(span))])

    def run(batches):
        for batch in text_slices(batches, "_text"):
            model, words = held.value, _Words(texts_of(batch, "_text"))
            n, m = batch.num_rows, max(1, len(model.languages))
            lengths = np.diff(words.starts)
            row = np.repeat(np.arange(n), lengths)
            path = model.path(words) if model.languages else np.zeros(len(words.codes), np.int32)
            letters = words.letters[words.codes]
            # Letters of words in no learned language's script count, but for no language.
            says = letters * model.fits.any(1)[words.scripts][words.codes] if model.languages else letters
            share = np.bincount(row * m + path, says, n * m).reshape(n, m)
            total, best = np.bincount(row, letters, n), share.argmax(1)
            sure = (total > 0) & (len(model.languages) > 0)
            names = np.array([*model.languages, "und"], object)
            score = np.where(sure, share[np.arange(n), best] / np.maximum(total, 1), 0.0)
            new = np.ones(len(path), bool)
            new[1:] = (path[1:] != path[:-1]) | (row[1:] != row[:-1])
            new &= sure[row]
            begins = np.flatnonzero(new)
            ends = np.minimum(np.append(begins[1:], len(path)), words.starts[1:][row[begins]])
            parts = pa.StructArray.from_arrays(
                [pa.array(names[path[begins]], pa.string()), pa.array(begins - words.starts[row[begins]]), pa.array(ends - begins)],
                fields=list(span),
            )
            offsets = np.concatenate(([0], np.cumsum(np.bincount(row[begins], minlength=n)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names[np.where(sure, best, len(model.languages))], pa.string()),
                 pa.array(score), pa.ListArray.from_arrays(pa.array(offsets), parts)],
                schema=schema,
            )

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("_text"))
    ddl = "key long, lang_pred string, score double, spans array<struct<lang string, start long, n_words long>>"
    return rows.mapInArrow(tidy(run), ddl).withColumnRenamed("key", key)
