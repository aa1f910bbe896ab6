"""Alignment of two tokenizers' ids over the bytes they share.

Every text is encoded whole by both tokenizers, with a space in front. Where the
bytes of both agree with the text, a byte offset at which both have a token end
and both next tokens begin with a space is an *anchor*: it cuts the text into
windows of token ids, and no group or link crosses it. A window is aligned once
for its tuple of ids and remembered, since words repeat.

Both tokenizers cut at a space behind a visible character, whatever stands
around it (``Pair`` checks that of the vocabularies, and encodes texts in one
piece otherwise). So a slice of texts is split there, and each different part is
encoded once; the parts' ids one after the other are the ids of the whole text.

How often a pair of ids is linked is a count over the whole corpus. Texts are
taken in blocks of ``block_bytes``; a block holds its different windows and pairs
once. Pairs travel as (block, pair, number), are summed, and the totals go back to
the blocks that have the pair, so nothing is broadcast and no task holds more than
one block, its windows and its pairs, or one long text.

Null and empty texts, and texts whose bytes are lost or changed by a tokenizer
(U+2581, for one), have no tokens: zeros and ''. Very long texts are whole and are
a block of their own. Null and repeated doc_ids stay rows of their own; ties of
the highest count all count; extra columns are ignored; an empty table gives an
empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.bpe import BYTE
from fleetscope.llm.common import ragged_take, release, text_slices, texts_of
from fleetscope.session import cut_lineage

#: Bytes of text whose windows and pairs are held together.
BLOCK_BYTES = 24 << 20
SLICE = 1 << 21
#: Parts that B encodes at once.
FEW = 64
#: Fixed value: how the piece model writes a space.
SPACE = "▁"
_BEHIND_WORD = re.compile(r"(?<=\S)(?= )")
#: A space at the start or behind white space: such texts are split by the pattern above.
_ODD = r"^ |[\s\x1c-\x1f\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}] "
#: Texts with such characters are encoded by A's own library, whatever version of Unicode it knows.
_WIDE = re.compile("[^\x00-\u024f]")
#: Fixed value: how byte-level tokenizers split a text.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")


class Pair:
    """Both tokenizers, with the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a, self.b = Tokenizer.from_file(path_a), SentencePieceProcessor(model_file=path_b)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are plain text
        value = {c: b for b, c in BYTE.items()}
        tokens = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size())]
        a_bytes = [bytes(map(value.get, t)) if all(c in value for c in t) else t.encode() for t in tokens]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [
            bytes.fromhex(p[3:5]) if self.b.is_byte(i) and _BYTE_PIECE.fullmatch(p) else p.replace(SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.a_bytes, self.a_size, self.a_spaced = self._table(a_bytes)
        self.b_bytes, self.b_size, self.b_spaced = self._table(b_bytes)
        self.texts = pa.array([f"{i}{after}" for i in range(max(len(tokens), len(pieces))) for after in ",|;"])
        self.space = self.b.piece_to_id(SPACE)
        self.in_parts = self._cuts_before_spaces(pieces)
        self.quick = self._quick(a_bytes) if self.in_parts else None

    def _quick(self, a_bytes: list[bytes]):
        """A faster encoder with A's vocabulary, if its ids are in the order of the merges."""
        import tiktoken

        model = json.loads(self.a.to_str())["model"]
        joined = [model["vocab"]["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        plain = not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        if not plain or joined != sorted(set(joined)) or joined[:1] <= [255]:
            return None
        ranks = {a_bytes[i]: i for i in [*range(joined[0]), *joined]}
        if len(ranks) != joined[0] + len(joined) or len(model["vocab"]) - len(ranks) > len(self.a.get_added_tokens_decoder()):
            return None
        return tiktoken.Encoding("a", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    @staticmethod
    def _table(values: list[bytes]):
        """Bytes, their number and whether a space is first, of each id."""
        spaced = np.array([v[:1] == b" " for v in values])
        return pa.array(values, pa.binary()), np.array([len(v) for v in values], np.int64), spaced

    def text_a(self, ids: np.ndarray) -> bytes:
        return self._text(self.a_bytes, ids)

    def text_b(self, ids: np.ndarray) -> bytes:
        return self._text(self.b_bytes, ids)

    @staticmethod
    def _text(values: pa.Array, ids: np.ndarray) -> bytes:
        words = values.take(pa.array(ids))
        return pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), b"")[0].as_py()

    def _cuts_before_spaces(self, pieces: list[str]) -> bool:
        """Whether a space behind a visible character always starts a new token of both."""
        split = json.loads(self.a.to_str())
        step = split["pre_tokenizer"] or {}
        byte_level = step.get("type") == "ByteLevel" and step.get("use_regex") and not step.get("add_prefix_space")
        if not byte_level or split["normalizer"]:
            return False
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            return False
        # The model keeps repeated spaces and adds one in front.
        return self.b.decode(self.b.encode("a  b ")) == "a  b " and self.b.encode("") == []

    def encode(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids by A and by B of parts, one after the other, with a space in front of each."""
        text = " " + " ".join(parts)
        if self.quick and not _WIDE.search(text):
            a = self.quick.encode_ordinary(text)
        else:
            a = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids
        # B puts the first space in front itself, but not in front of an empty text. It is slow on long ones.
        some = [" ".join(parts[i : i + FEW]) for i in range(0, len(parts), FEW)]
        b = [i for ids in self.b.encode(some, num_threads=1) for i in ids or [self.space]]
        return np.array(a, np.int32), np.array(b, np.int32)


_pairs: dict[tuple[str, str], Pair] = {}


def pair_of(path_a: str, path_b: str) -> Pair:
    """The process's tokenizers; executors have the files at the same paths."""
    if (path_a, path_b) not in _pairs:
        _pairs[path_a, path_b] = Pair(path_a, path_b)
    return _pairs[path_a, path_b]


def _slices(data: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw, ends = data.tobytes(), (ends * data.itemsize).tolist()
    return [raw[x:y] for x, y in zip([0, *ends], ends)]


def _ragged(lengths: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    return ragged_take(np.cumsum(lengths) - lengths, lengths, chosen)


def _strings(values: pa.Array) -> list[str]:
    if not len(values) or pc.any(pc.match_substring(values, " ")).as_py():
        return values.to_pylist()
    return pc.binary_join(pa.ListArray.from_arrays([0, len(values)], values), " ")[0].as_py().split(" ")


class Ragged:
    """Lists of integers, one after the other, that grow at the end."""

    def __init__(self):
        self.lengths, self.values = np.zeros(0, np.int64), np.zeros(0, np.int32)

    def __len__(self) -> int:
        return len(self.lengths)

    def extend(self, lengths: np.ndarray, values: np.ndarray) -> None:
        self.lengths = np.concatenate((self.lengths, lengths))
        self.values = np.concatenate((self.values, values.astype(np.int32)))

    def take(self, chosen: np.ndarray) -> np.ndarray:
        return self.values[_ragged(self.lengths, chosen)]


class Block:
    """The different parts, windows and pairs of one block of texts."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.parts: dict[str, int] = {}
        self.good = np.zeros(0, bool)  # whether both tokenizers keep the bytes of a part
        self.part_windows = Ragged()
        self.known: dict[bytes, int] = {}  # windows by their ids
        self.links = Ragged()  # of a window, as places of pairs
        self.counts = np.zeros((4, 0), np.int64)  # n_a, n_b, n_groups, n_links of a window
        self.texts = pa.array([], pa.string())  # groups of a window, each with ; behind
        self.pairs: dict[int, int] = {}
        self.seen = np.zeros(0, np.int64)  # how often a window occurs

    def learn(self, parts: list[str]) -> None:
        """Encode and align parts that are new in this block."""
        plain, wide, alone = [], [], []
        for part in parts:
            if not part or part[-1].isspace():  # behind white space the next part's space would join it
                alone.append([part])
            elif part.isascii() or not _WIDE.search(part):
                plain.append(part)
            else:
                wide.append(part)
        for group in (plain, wide, *alone):
            if group:
                self._learn(group)

    def _learn(self, parts: list[str]) -> None:
        """All parts in one go; by halves if a byte is lost or an end is not shared."""
        pair = self.pair
        text = (" " + " ".join(parts)).encode()
        a, b = pair.encode(parts)
        ends_a, ends_b = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        same = pair.text_a(a) == text and pair.text_b(b) == text
        if same:
            sizes = [len(p) if p.isascii() else len(p.encode()) for p in parts]
            starts = np.cumsum([0, *sizes[:-1]]) + np.arange(len(parts))
            anchors = np.intersect1d(
                (ends_a - pair.a_size[a])[pair.a_spaced[a]], (ends_b - pair.b_size[b])[pair.b_spaced[b]], True
            )
            same = bool(np.isin(starts, anchors, True).all())
        if not same and len(parts) > 1:
            half = len(parts) // 2
            self._learn(parts[:half])
            return self._learn(parts[half:])
        self.parts.update(zip(parts, range(len(self.parts), len(self.parts) + len(parts))))
        self.good = np.concatenate((self.good, np.full(len(parts), same)))
        if not same:
            return self.part_windows.extend(np.zeros(1, np.int64), np.zeros(0, np.int32))
        size_a = np.diff(np.searchsorted(ends_a, [*anchors, len(text)], "right"))
        size_b = np.diff(np.searchsorted(ends_b, [*anchors, len(text)], "right"))
        windows = self._windows(a, b, size_a, size_b)
        self.part_windows.extend(np.diff(np.searchsorted(anchors, [*starts, len(text)])), windows)

    def _windows(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
        """Codes of windows given as ids; those met for the first time are aligned."""
        both = np.full(len(a) + len(b) + len(size_a), -1, np.int32)
        ends = np.cumsum(size_a + size_b + 1)
        first = ends - size_a - size_b - 1
        both[np.repeat(first - np.cumsum(size_a) + size_a, size_a) + np.arange(len(a))] = a
        both[np.repeat(first + size_a + 1 - np.cumsum(size_b) + size_b, size_b) + np.arange(len(b))] = b
        before, known = len(self.known), self.known
        codes = [known.setdefault(k, len(known)) for k in _slices(both, ends)]
        codes = np.array(codes, np.int64)
        if len(known) > before:
            # Codes are given in order, so a window met for the first time has the highest one so far.
            highest = np.maximum.accumulate(codes)
            at = np.flatnonzero(codes > np.concatenate(([before - 1], np.maximum(highest[:-1], before - 1))))
            self._align(a[_ragged(size_a, at)], b[_ragged(size_b, at)], size_a[at], size_b[at])
        return codes

    def _align(self, a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray) -> None:
        """Groups and links of windows that follow each other. The two sides of each hold the same bytes."""
        pair = self.pair
        ends_a, ends_b = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        shut = ends_a[np.cumsum(size_a) - 1]  # where the windows end
        # Between two neighbouring ends, of either side, lies one link.
        ends = np.sort(np.concatenate((ends_a, ends_b)), kind="stable")
        ends = ends[np.diff(ends, prepend=0) > 0]
        keys = a[np.searchsorted(ends_a, ends)].astype(np.int64) << 32 | b[np.searchsorted(ends_b, ends)]
        different = pa.array(keys).dictionary_encode()
        pairs = self.pairs
        codes = np.array([pairs.setdefault(k, len(pairs)) for k in different.dictionary.to_pylist()], np.int64)
        n_links = np.diff(np.searchsorted(ends, shut, "right"), prepend=0)
        self.links.extend(n_links, codes[different.indices.to_numpy()])
        common = np.intersect1d(ends_a, ends_b, True)
        n_groups = np.diff(np.searchsorted(common, shut, "right"), prepend=0)
        self.counts = np.concatenate((self.counts, np.stack([size_a, size_b, n_groups, n_links])), axis=1)
        # Text: the ids of A, then those of B, group by group; each id with what follows it.
        group = np.concatenate((np.searchsorted(common, ends_a) * 2, np.searchsorted(common, ends_b) * 2 + 1))
        order = np.argsort(group, kind="stable")
        last = np.isin(np.concatenate((ends_a, ends_b)), common)
        mark = np.where(last, np.repeat([1, 2], [len(a), len(b)]), 0)
        words = pair.texts.take(pa.array((np.concatenate((a, b)) * np.int64(3) + mark)[order]))
        starts = np.concatenate(([0], np.cumsum(size_a + size_b))).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts), words), "")
        self.texts = pa.concat_arrays([self.texts, texts])

    def add(self, keys: pa.Array, lists: pa.ListArray, block: int) -> pa.RecordBatch:
        """Rows of documents given as lists of parts without their leading space."""
        starts = lists.offsets.to_numpy().astype(np.int64)
        starts -= starts[0]
        coded = lists.flatten().dictionary_encode()
        names = _strings(coded.dictionary)
        new = [p for p in names if p not in self.parts]
        if new:
            self.learn(new)
        parts = np.fromiter(map(self.parts.__getitem__, names), np.int64, len(names))[coded.indices.to_numpy()]
        n_docs = len(starts) - 1
        # Texts with a part that loses bytes have no tokens.
        lost = np.concatenate(([0], np.cumsum(~self.good[parts])))
        good = np.diff(lost[starts]) == 0
        doc = np.repeat(np.arange(n_docs), np.diff(starts))
        parts, doc = parts[good[doc]], doc[good[doc]]
        codes = self.part_windows.take(parts)
        doc = np.repeat(doc, self.part_windows.lengths[parts])
        starts = np.searchsorted(doc, np.arange(n_docs + 1))
        sums = [np.diff(np.concatenate(([0], np.cumsum(column[codes])))[starts]) for column in self.counts]
        texts = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), self.texts.take(pa.array(codes)))
        texts = pc.binary_join(texts, "").to_pylist()
        digests = [hashlib.sha256(t[:-1].encode()).hexdigest() if t else "" for t in texts]
        del texts
        # Different windows of each document, with their number.
        key = np.sort(doc << 32 | codes)
        first = np.flatnonzero(np.diff(key, prepend=-1))
        key, times = key[first], np.diff(first, append=len(key))
        total = np.bincount(codes, minlength=len(self.links))
        total[: len(self.seen)] += self.seen
        self.seen = total
        ends = np.searchsorted(key, np.arange(n_docs + 1, dtype=np.int64) << 32).astype(np.int32)
        as_lists = lambda v: pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32)))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n_docs, block)), keys, *map(pa.array, sums),
             pa.array(digests, pa.string()), as_lists(key & 0xFFFFFFFF), as_lists(times),
             *(pa.nulls(n_docs, f.type) for f in list(_SCHEMA)[-4:])],
            schema=_SCHEMA,
        )

    def summary(self, block: int) -> pa.RecordBatch:
        """One row: the block's pairs with their number, and the links of its windows."""
        seen = np.zeros(len(self.links), np.int64)
        seen[: len(self.seen)] = self.seen
        links, lengths = self.links.values, self.links.lengths
        number = np.bincount(links, np.repeat(seen, lengths), len(self.pairs)).astype(np.int64)
        row = [[block], *[[None]] * 8, [np.fromiter(self.pairs, np.int64, len(self.pairs))], [number], [lengths], [links]]
        return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(row, _SCHEMA)], schema=_SCHEMA)


_SCHEMA = pa.schema(
    [("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
     ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("windows", pa.list_(pa.int32())),
     ("times", pa.list_(pa.int32())), ("pairs", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int64())),
     ("lengths", pa.list_(pa.int32())), ("links", pa.list_(pa.int32()))]
)
_CODED = (
    "block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "windows array<int>, times array<int>, pairs array<long>, numbers array<long>, lengths array<int>, links array<int>"
)


def _parts(pair: Pair, batch: pa.RecordBatch):
    """(keys, lists of parts) of the texts; parts come without their leading space."""
    keys, texts = batch.column(0), texts_of(batch, "_text")
    texts = texts.cast(pa.string())
    plain = pc.greater(pc.binary_length(texts), 0)
    if pair.in_parts:
        plain = pc.and_not(plain, pc.match_substring_regex(texts, _ODD))
    else:
        plain = pc.and_(plain, False)
    if pc.any(plain).as_py():
        yield keys.filter(plain), pc.split_pattern(texts.filter(plain), " ")
    if not pc.all(plain).as_py():
        others = pc.invert(plain)
        cut = _BEHIND_WORD.split if pair.in_parts else lambda text: [text]
        lists = [[p[1:] for p in cut(" " + t)] if t else [] for t in texts.filter(others).to_pylist()]
        yield keys.filter(others), pa.array(lists, pa.list_(pa.string()))


def _encode(path_a: str, path_b: str, block_bytes: int):
    def run(batches):
        pair = pair_of(path_a, path_b)
        number, held, block = TaskContext.get().partitionId() << 32, 0, Block(pair)
        for batch in text_slices(batches, "_text", min(SLICE, block_bytes)):
            size = pc.sum(pc.binary_length(texts_of(batch, "_text"))).as_py() or 0
            if held and held + size > block_bytes:
                yield block.summary(number)
                number, held, block = number + 1, 0, Block(pair)
            held += size
            for keys, lists in _parts(pair, batch):
                yield block.add(keys, lists, number)
        if held:
            yield block.summary(number)
        del block
        release()

    return run


_OUT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _score(docs: pa.Table, blocks: pa.Table) -> pa.Table:
    """Sums of the counts and of the best links of each document of one block."""
    columns = {n: docs.column(n) for n in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    if blocks.num_rows:
        one = {n: blocks.column(n).combine_chunks().flatten().to_numpy() for n in ("lengths", "links", "counts", "best")}
        ends = np.concatenate(([0], np.cumsum(one["lengths"].astype(np.int64))))

        def per_window(values):
            sums = np.concatenate(([0], np.cumsum(values[one["links"]].astype(np.int64))))
            return sums[ends[1:]] - sums[ends[:-1]]

        window = docs.column("windows").combine_chunks()
        starts = window.offsets.to_numpy().astype(np.int64)
        window = window.flatten().to_numpy()
        times = docs.column("times").combine_chunks().flatten().to_numpy().astype(np.int64)
        starts -= starts[0]
        for name, source in (("n_best", "best"), ("count_sum", "counts")):
            sums = np.concatenate(([0], np.cumsum(per_window(one[source])[window] * times)))
            columns[name] = pa.array(sums[starts[1:]] - sums[starts[:-1]])
    else:
        columns |= {n: pa.array(np.zeros(docs.num_rows, np.int64)) for n in ("n_best", "count_sum")}
    return pa.table(columns | {"groups_sha256": docs.column("groups_sha256")})


def code(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    key: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents as windows of their block, and a row per block with its windows' links; written out."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("_text"))
    return cut_lineage(rows.mapInArrow(_encode(path_a, path_b, block_bytes), _CODED))


def pair_counts(coded: DataFrame) -> DataFrame:
    """pair, a_id, b_id, n (links that hold it, corpus-wide) and best (no other pair of the B id has more)."""
    held = coded.filter("pairs IS NOT NULL").select(F.explode(F.arrays_zip("pairs", "numbers")).alias("x"))
    # Pairs of a block whose every text was left out have no link.
    totals = held.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.numbers").alias("n")).filter("n > 0")
    totals = totals.withColumn("b_id", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = totals.groupBy("b_id").agg(F.max("n").alias("_most"))
    return totals.join(most, "b_id").select(
        "pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "n", (F.col("n") == F.col("_most")).alias("best")
    )


def align_tokens(coded: DataFrame) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of each document of ``code``."""
    blocks = coded.filter("pairs IS NOT NULL")
    held = blocks.select("block", F.posexplode("pairs").alias("at", "pair"))
    counts = pair_counts(coded).select("pair", "n", "best")
    # A pair that only texts without tokens hold has no total.
    found = F.struct("at", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("best", F.lit(False)).alias("best"))
    back = held.join(counts, "pair", "left").groupBy("block").agg(F.array_sort(F.collect_list(found)).alias("x"))
    back = back.select("block", F.col("x.n").alias("counts"), F.col("x.best").cast("array<int>").alias("best"))
    sides = blocks.select("block", "lengths", "links").join(back, "block").withColumnRenamed("block", "_of")
    docs = coded.filter("pairs IS NULL").select(
        "block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "windows", "times"
    )
    return docs.groupBy("block").cogroup(sides.groupBy("_of")).applyInArrow(_score, _OUT)
