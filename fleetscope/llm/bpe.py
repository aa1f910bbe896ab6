"""Encoding and decoding with a word BPE tokenizer.

A text is split at white space, which the tokenizer drops, and each different
word is encoded once. A word without a break can be as long as the text. Such a
word is encoded by *tree concatenation*: its halves are encoded apart, and a
window around each join is encoded again and grown until it shares a token with
both sides. Adjacent tokens of the result then all stand next to each other in
some encoding, which makes the whole the encoding of the whole.

Texts over ``long_chars`` are cut into parts that are encoded by different
tasks and joined pairwise, so a very long text does not hold up one task.

Null texts count as empty and encode to no ids. Repeated rows and doc_ids are
kept as they are, extra columns are ignored, an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import ragged_take, release, split_words, text_slices, texts_of, tidy
from fleetscope.session import cut_lineage

#: Characters of a piece that is encoded in one go.
LEAF = 2048
#: Texts with more characters are spread over tasks, in parts of about PART.
LONG_CHARS = 65_536
PART = 16_384
#: Bytes of text encoded at once; texts, ids and decoded texts of a slice are in memory together.
ENCODE_BYTES = 3 << 19
#: Pieces of words that a process remembers the ids of, before it starts anew.
REMEMBERED = 100_000
#: Characters below this one have one normal form and a lower case of their own.
SIMPLE = 0x250
#: Words made of them only.
PLAIN = r"^[\x{21}-\x{7E}\x{A1}-\x{24F}]*$"
#: The characters that stand for bytes in the model's alphabet (fixed by byte-level BPE): printable
#: bytes for themselves, the others in order from 256 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
BYTE = {b: chr(b) for b in _SHOWN} | {b: chr(256 + i) for i, b in enumerate(sorted({*range(256)} - {*_SHOWN}))}
#: The same for text whose bytes stand as characters; the blank stays.
SYMBOLS = {chr(b): c for b, c in BYTE.items() if b != 0x20 and chr(b) != c}
#: White space to Python and Arrow, but not to the tokenizer.
_ODD_SPACE = "[\x1c-\x1f]"


class Encoder:
    """A tokenizer with a bounded memory of words."""

    def __init__(self, path: str, leaf: int = LEAF):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = tokenizer = Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        if self._whole("b, a\n b") != self._whole("b,") + self._whole("a") + self._whole("b"):
            raise ValueError(f"{path} does not drop white space between words")
        self.leaf = leaf
        self.special = {t.content: i for i, t in tokenizer.get_added_tokens_decoder().items()}
        self.marker = max(self.special, key=self.special.get, default=None)
        self.special_pattern = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        size = tokenizer.get_vocab_size()
        self.token = [tokenizer.id_to_token(i) or "" for i in range(size)]
        self.is_end = np.array([t.endswith("</w>") for t in self.token])
        self.plain = [t[:-4] if e else t for t, e in zip(self.token, self.is_end)]
        self.known: dict[str, int] = {}
        self.forget()
        self.pattern = self._pattern()

    def _pattern(self):
        """The pre-tokenizer's pattern with a line end as one more piece, if it can be run here."""
        import json

        import regex

        steps = (json.loads(self.tokenizer.to_str())["pre_tokenizer"] or {}).get("pretokenizers", [])
        if [s["type"] for s in steps] != ["Split", "ByteLevel"] or not steps[0]["invert"]:
            return None
        every = "".join(c for c in map(chr, range(SIMPLE)) if not c.isspace())
        if self.tokenizer.normalizer.normalize_str(every) != every.lower():
            return None
        bare = json.loads(self.tokenizer.to_str()) | {"normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}
        self.bare = type(self.tokenizer).from_str(json.dumps(bare | {"added_tokens": []}))
        return regex.compile(steps[0]["pattern"]["Regex"] + r"|\n")

    def _simple(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words with plain characters, and each word's number of ids."""
        text = pc.binary_join(pa.ListArray.from_arrays([0, len(words)], words), "\n")[0].as_py()
        pieces = self.pattern.findall(text.lower())
        if len(self.known) > REMEMBERED:
            self.forget()
        known = self.known
        new = list(set(pieces) - known.keys())
        if new:
            symbols = " ".join(new).encode().decode("latin-1")
            for c in set(symbols) & SYMBOLS.keys():
                symbols = symbols.replace(c, SYMBOLS[c])
            ids = np.array(self.bare.encode_batch_fast([symbols], add_special_tokens=False)[0].ids, np.int32)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(new):
                raise RuntimeError("a piece was split or lost")
            known.update(zip(new, range(len(self.ends) - 1, len(self.ends) - 1 + len(new))))
            self.ends = np.concatenate([self.ends, ends + len(self.ids)])
            self.ids = np.concatenate([self.ids, ids])
        places = np.fromiter(map(known.__getitem__, pieces), np.int32, len(pieces))
        starts, lengths = self.ends[:-1], np.diff(self.ends)
        per_piece = np.concatenate(([0], np.cumsum(lengths[places])))
        breaks = per_piece[np.flatnonzero(places == 0)]  # the line end is piece 0, without ids
        return self.ids[ragged_take(starts, lengths, places)], np.diff(breaks, prepend=0, append=per_piece[-1])

    def forget(self) -> None:
        self.known, self.ids, self.ends = {"\n": 0}, np.zeros(0, np.int32), np.zeros(2, np.int64)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    # --- One piece -------------------------------------------------------------------

    def _model(self, piece: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(piece)]

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece in the model's alphabet, halved while it is long."""
        if len(piece) <= self.leaf:
            return self._model(piece)
        half = len(piece) // 2
        return self.join(self.piece(piece[:half]), self.piece(piece[half:]))

    def join(self, left: list[int], right: list[int]) -> list[int]:
        """Ids of a piece whose two halves have these ids.

        The last id of ``left`` carries a word end that is not there.
        """
        reach = 8
        while True:
            a, b = max(0, len(left) - reach), min(len(right), reach)
            tail, head = left[a:], right[:b]
            window = self._model("".join(map(self.plain.__getitem__, tail + head)))
            at, places = 0, {}
            for j, token in enumerate(window):
                places[at, token] = j
                at += len(self.plain[token])
            first = None if a else (0, 0)  # (position in left, in window)
            at = 0
            for i, token in enumerate(tail):
                if a and first is None and i + 1 < len(tail) and (at, token) in places:
                    first = (a + i, places[at, token])
                at += len(self.plain[token])
            last = None if b < len(right) else (len(right) - 1, len(window) - 1)
            if last is None:
                for i, token in enumerate(head):
                    j = places.get((at, token))
                    if j is not None and j + 1 < len(window):
                        last = (i, j)
                    at += len(self.plain[token])
            if first and last and first[1] <= last[1]:
                return left[: first[0]] + window[first[1] : last[1] + 1] + right[last[0] + 1 :]
            reach *= 2

    def pieces(self, word: str) -> Iterator[tuple[str, int | None]]:
        """Pieces of a word in the model's alphabet; a special token comes with its id."""
        parts = self.special_pattern.split(word) if self.special_pattern else [word]
        for part in parts:
            if part in self.special:
                yield "", self.special[part]
            elif part:
                normal = self.tokenizer.normalizer.normalize_str(part)
                for piece, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal):
                    yield piece, None

    def long_word(self, word: str) -> list[int]:
        out: list[int] = []
        for piece, special in self.pieces(word):
            out += [special] if special is not None else self.piece(piece)
        return out

    # --- Words -----------------------------------------------------------------------

    def _other(self, words: list[str]) -> list[bytes]:
        """Ids of words that are long, hold special tokens or need the full normalisation."""
        return [
            np.array(self.long_word(w) if len(w) > self.leaf else self._whole(w), np.int32).tobytes() for w in words
        ]

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after the other, and each word's number of ids."""
        if not len(words):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        plain = np.zeros(len(words), bool)
        if self.pattern:
            plain = pc.and_(
                pc.match_substring_regex(words, PLAIN),
                pc.and_not(pc.less_equal(pc.binary_length(words), self.leaf), pc.match_substring(words, "<|")),
            ).to_numpy(zero_copy_only=False)
            if any("<|" not in s for s in self.special):
                plain[:] = False
        ids, lengths = np.zeros(0, np.int32), np.zeros(len(words), np.int64)
        if plain.any():
            ids, lengths[plain] = self._simple(words.filter(pa.array(plain)))
        if not plain.all():
            others = np.flatnonzero(~plain)
            known = self._other(words.take(pa.array(others)).to_pylist())
            lengths[others] = [len(x) // 4 for x in known]
            ends = np.cumsum(lengths)
            both = np.empty(int(ends[-1]), np.int32)
            both[np.repeat(plain, lengths)] = ids
            both[np.repeat(~plain, lengths)] = np.frombuffer(b"".join(known), np.int32)
            ids = both
        return ids, lengths

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and where each text's begin."""
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        if odd.any():
            ids = [self._whole(t) if o else self.texts(pa.array([t]))[0] for t, o in zip(texts.to_pylist(), odd)]
            starts = np.concatenate(([0], np.cumsum([len(x) for x in ids])))
            return np.concatenate([np.asarray(x, np.int32) for x in ids]), starts
        starts, codes, uniques = split_words(texts)
        flat, lengths = self.words(uniques)
        ids = flat[ragged_take(np.cumsum(lengths) - lengths, lengths, codes)]
        ends = np.concatenate(([0], np.cumsum(lengths[codes])))
        return ids, ends[starts]

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """What the tokenizer's decode() gives with special tokens kept.

        Without a decoder that is the tokens, a blank between.
        """
        if self.tokenizer.decoder is not None:
            lists = [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]
            return self.tokenizer.decode_batch(lists, skip_special_tokens=False)
        tokens = pa.array(self.token).take(pa.array(ids))
        lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), tokens)
        return pc.binary_join(lists, " ").to_pylist()


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The process's encoder; executors have the file at the same path."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


# --- Long texts over several tasks --------------------------------------------------


def _cut(path: str, column: str):
    """Rows (row, part, kind, text): words, finished pieces, ids or leaves of a text."""
    schema = pa.schema([("_row", pa.int64()), ("node", pa.int64()), ("kind", pa.string()), ("part", pa.string())])

    def parts(text: str) -> Iterator[tuple[str, str]]:
        code = encoder(path)
        if re.search(_ODD_SPACE, text):
            words = re.split(r"[^\S\x1c-\x1f]+", text)
        else:
            words = text.split()
        held: list[str] = []
        size = 0
        for word in words:
            if len(word) > PART:
                if held:
                    yield "words", " ".join(held)
                held, size = [], 0
                for piece, special in code.pieces(word):
                    if special is not None:
                        yield "id", str(special)
                    elif len(piece) <= PART:
                        yield "leaf", piece
                    else:
                        for k in range(0, len(piece), PART):
                            yield "more" if k else "leaf", piece[k : k + PART]
                continue
            if word:
                held.append(word)
                size += len(word) + 1
            if size > PART:
                yield "words", " ".join(held)
                held, size = [], 0
        yield "words", " ".join(held)

    def run(batches):
        for batch in batches:
            for row, text in zip(batch.column(0).to_pylist(), texts_of(batch, column).to_pylist()):
                rows = list(parts(text))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row] * len(rows), pa.int64()), pa.array(range(len(rows)), pa.int64()),
                     pa.array([k for k, _ in rows], pa.string()), pa.array([t for _, t in rows], pa.string())],
                    schema=schema,
                )

    return run


def _encode_parts(path: str):
    schema = pa.schema([("_row", pa.int64()), ("node", pa.int64()), ("more", pa.bool_()), ("ids", pa.binary())])

    def run(batches):
        code = encoder(path)
        for batch in text_slices(batches, "part", ENCODE_BYTES):
            kinds = batch.column(2).to_pylist()
            flat, starts = code.texts(pc.if_else(pc.equal(batch.column(2), "words"), batch.column(3), ""))
            ids = [flat[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
            for i, kind in enumerate(kinds):
                if kind != "words":
                    part = batch.column(3)[i].as_py()
                    ids[i] = np.array([int(part)] if kind == "id" else code.piece(part), np.int32).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([k == "more" for k in kinds]), pa.array(ids, pa.binary())],
                schema=schema,
            )

    return run


def _join_parts(path: str):
    """Joins two neighbours; a leaf that goes on in the right one is re-encoded at the join."""
    schema = pa.schema([("_row", pa.int64()), ("node", pa.int64()), ("more", pa.bool_()), ("ids", pa.binary())])

    def joined(left: bytes, right: bytes) -> bytes:
        code = encoder(path)
        a, b = np.frombuffer(left, np.int32).tolist(), np.frombuffer(right, np.int32).tolist()
        start = len(a) - 1  # the piece begins behind the last word end before
        while start and not code.is_end[a[start - 1]] and a[start - 1] not in code.special.values():
            start -= 1
        stop = next((i + 1 for i, t in enumerate(b) if code.is_end[t]), len(b))
        return np.array(a[:start] + code.join(a[start:], b[:stop]) + b[stop:], np.int32).tobytes()

    def run(batches):
        for batch in batches:
            rows = batch.to_pylist()
            ids = []
            for r in rows:
                if r["l"]["node"] == r["r"]["node"]:
                    ids.append(r["l"]["ids"])
                elif r["r"]["more"]:
                    ids.append(joined(r["l"]["ids"], r["r"]["ids"]))
                else:
                    ids.append(r["l"]["ids"] + r["r"]["ids"])
            yield pa.RecordBatch.from_arrays(
                [pa.array([r["_row"] for r in rows], pa.int64()), pa.array([r["node"] for r in rows], pa.int64()),
                 pa.array([r["l"]["more"] for r in rows], pa.bool_()), pa.array(ids, pa.binary())],
                schema=schema,
            )

    return run


def _encode_long(long: DataFrame, path: str, column: str) -> DataFrame:
    """(_row, ids) of long texts, part by part and then joined pairwise."""
    spark = long.sparkSession
    node = "_row long, node long, more boolean, ids binary"
    parts = long.select("_row", column).mapInArrow(_cut(path, column), "_row long, node long, kind string, part string")
    parts = cut_lineage(parts)
    last = parts.agg(F.max("node")).first()[0]
    if last is None:
        return spark.createDataFrame([], "_row long, ids binary")
    nodes = parts.repartition("_row", "node").mapInArrow(tidy(_encode_parts(path)), node)
    while last:
        last //= 2
        one = F.struct("node", "more", "ids")
        pairs = nodes.groupBy("_row", F.shiftright("node", 1).alias("up")).agg(
            F.min_by(one, "node").alias("l"), F.max_by(one, "node").alias("r")
        )
        nodes = pairs.select("_row", F.col("up").alias("node"), "l", "r").mapInArrow(_join_parts(path), node)
    return nodes.select("_row", "ids")


# --- The operators ------------------------------------------------------------------


def _finish(batch_key: pa.Array, ids: np.ndarray, starts: np.ndarray, decoded: bool, path: str, schema):
    lists = pa.ListArray.from_arrays(pa.array(starts.astype(np.int32)), pa.array(ids))
    columns = [batch_key, lists]
    if decoded:
        columns.append(pa.array(encoder(path).decode(ids, starts), pa.string()))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def encode(
    docs: DataFrame,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    decoded: bool = False,
    long_chars: int = LONG_CHARS,
) -> DataFrame:
    """``key`` and the ids of each text; with ``decoded`` also the ids decoded again."""
    fields = [("key", pa.int64()), ("ids", pa.list_(pa.int32()))] + [("decoded", pa.string())] * decoded
    schema = pa.schema(fields)
    ddl = "key long, ids array<int>" + ", decoded string" * decoded

    def short(batches):
        code = encoder(path)
        for batch in text_slices(batches, "_text", ENCODE_BYTES):
            ids, starts = code.texts(texts_of(batch, "_text"))
            yield _finish(batch.column(0), ids, starts, decoded, path, schema)
            del ids, starts
        code.forget()
        release()

    def long(batches):
        for batch in batches:
            values = [np.frombuffer(x or b"", np.int32) for x in batch.column(1).to_pylist()]
            starts = np.concatenate(([0], np.cumsum([len(v) for v in values])))
            yield _finish(batch.column(0), np.concatenate([*values, np.zeros(0, np.int32)]), starts, decoded, path, schema)

    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("_text"))
    is_long = F.coalesce(F.length("_text") > long_chars, F.lit(False))
    out = rows.filter(~is_long).mapInArrow(short, ddl)
    wide = cut_lineage(rows.filter(is_long).withColumn("_row", F.monotonically_increasing_id()))
    ids = _encode_long(wide, path, "_text")
    out = out.unionByName(wide.select("_row", "key").join(ids, "_row").select("key", "ids").mapInArrow(long, ddl))
    return out.withColumnRenamed("key", key)


def decode(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the text of each list of ids; a null list is empty."""
    schema = pa.schema([("key", pa.int64()), ("decoded", pa.string())])

    def run(batches):
        for batch in batches:
            values = [np.asarray(x or [], np.int32) for x in batch.column(1).to_pylist()]
            starts = np.concatenate(([0], np.cumsum([len(v) for v in values])))
            texts = encoder(path).decode(np.concatenate([*values, np.zeros(0, np.int32)]), starts)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], schema=schema)

    rows = encoded.select(F.col(key).cast("long").alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, "key long, decoded string").withColumnRenamed("key", key)
