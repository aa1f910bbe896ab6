"""Removal of long passages that occur in an earlier document.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id. Documents are taken in batches of consecutive ids,
and each batch gets a sorted array, by hashes and not by suffixes: of every
``LENGTH``-byte window only its *anchor* counts, the ``GRAM``-byte string with the
smallest hash in it. Equal windows have equal anchors, and neighbouring windows mostly
share one, so a window run of one anchor (about 10 windows) is one entry, sorted
by the anchor's hash, with a fingerprint of all the bytes that its windows cover.

The arrays are cut into ranges of the hash. In each range the batches enter a
logarithmic family of levels in order: a new batch is merge-scanned against
every level and then stored; two levels of one size merge into one of the next.
The scan knows two kinds of matches:

* the whole run occurs in an earlier batch: all its bytes go;
* only its anchor does, or several runs of one batch share the anchor: the windows
  of these runs are compared one by one. Each goes as a hash, once per batch, to a range of
  its own hash, so an anchor that very many different runs share is dealt to all ranges.

Inside a batch, equal runs are matched before anything is sent, so a passage that
many documents share is one entry per batch. An entry has 14 bytes. Runs of one anchor are told apart by a
64-bit mark of their bytes, windows by 64 bits within a range that a second hash names.

Null texts are empty. Documents under ``LENGTH`` bytes lose nothing. A text of any length is whole in one
batch. Rows with one id do not take from each other, and are dealt to several batches of one generation if they
are many; a null id counts as larger than all others. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import mix64, release, text_slices, texts_of, tidy
from fleetscope.session import cut_lineage

LENGTH = 50
GRAM = 32
#: Window starts that can share an anchor at most.
REACH = LENGTH - GRAM + 1
#: Bytes of text in a batch; bytes of entries in a hash range, at 16 an entry.
BATCH_BYTES = 6 << 20
RANGE_BYTES = 10 << 20
ENTRIES_PER_BYTE = 0.1
#: Ranges of ids that are counted before they are cut into batches.
ID_RANGES = 512
SUB_RANGES = 64
#: A batch's number is its generation, in the order of ids, and below it the part among batches of one id.
PART_BITS = 20
#: Positions handled at once, few enough for a processor's cache.
_SLICE = 1 << 15
_LAST = (1 << 63) - 1

_rng = np.random.default_rng(50)
_BYTE = _rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FACTORS = _rng.integers(1 << 63, size=GRAM // 8, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R = 0xD1342543DE82EF95
_MASK = (1 << 64) - 1
#: Entries carry six bytes of an anchor's hash. Anchors alike in them are compared window by window.
_ANCHOR = np.uint64(_MASK >> 16 << 16)


def _powers(base: int) -> np.ndarray:
    """base^0, base^1, ... for one slice, modulo 2^64."""
    out = np.full(_SLICE + LENGTH + 1, base & _MASK, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_UP, _DOWN = _powers(_R), _powers(pow(_R, -1, 1 << 64))


def _loads(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each position on, as one number."""
    return np.ndarray((len(raw) - 7,), "<u8", buffer=raw, strides=(1,))


class Runs:
    """Window runs of one anchor: first and last start, anchor hash, fingerprint."""

    def __init__(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """``raw`` has 64 spare bytes at its end; starts and ends are those of the documents."""
        valid = np.zeros(len(raw) - 64 + 1, np.int8)
        long = np.flatnonzero(ends - starts >= LENGTH)
        np.add.at(valid, starts[long], 1)
        np.add.at(valid, ends[long] - LENGTH + 1, -1)
        valid = np.cumsum(valid, dtype=np.int8).astype(bool)
        parts = [self._slice(raw, valid, a) for a in range(0, len(raw) - 64, _SLICE)]
        parts = parts or [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
        self.first, self.last, self.anchor, self.print = map(np.concatenate, zip(*parts))
        self.whole = whole(self.anchor, self.print)
        self.doc = np.searchsorted(starts, self.first, side="right") - 1
        # Empty documents share their start with the next one; runs belong to the last of those.

    @staticmethod
    def _slice(raw, valid, a):
        b = min(a + _SLICE, len(raw) - 64)
        at = np.flatnonzero(valid[a:b])
        eight = _loads(raw[a : min(b + REACH + GRAM + 8, len(raw))])
        n = b - a + REACH - 1
        n = min(n, len(eight) - GRAM + 8)
        x = np.zeros(n, np.uint64)
        for shift, factor in zip(range(0, GRAM, 8), _FACTORS):
            x += eight[shift : shift + n] * factor
        x ^= x >> np.uint64(29)
        x *= np.uint64(0x165667B19E3779F9)
        x ^= x >> np.uint64(32)
        width = 1
        while 2 * width <= REACH:
            x = np.minimum(x[:-width], x[width:])
            width *= 2
        if width < REACH:
            x = np.minimum(x[: len(x) - (REACH - width)], x[REACH - width :])
        low = x[at]
        new = np.ones(len(at), bool)
        new[1:] = (low[1:] != low[:-1]) | (at[1:] != at[:-1] + 1)
        begin = np.flatnonzero(new)
        first = at[begin]
        last = at[np.append(begin[1:], len(at)) - 1] if len(at) else first
        piece = raw[a : min(b + LENGTH, len(raw))]
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_BYTE[piece] * _UP[: len(piece)], out=sums[1:])
        mark = (sums[last + LENGTH] - sums[first]) * _DOWN[first] + (last - first).astype(np.uint64)
        # Smallest hashes crowd near zero; scrambled again they spread over the ranges.
        return first + a, last + a, mix64(low[begin]) & _ANCHOR, mix64(mark)


def whole(anchor: np.ndarray, mark: np.ndarray) -> np.ndarray:
    """One number for anchor and fingerprint together."""
    return mix64(anchor + mark * np.uint64(0x9E3779B97F4A7C15))


class Family:
    """Levels of sorted entries whose sizes grow geometrically."""

    def __init__(self):
        self.levels: list[dict] = []

    def add(self, batch: np.ndarray, anchor: np.ndarray, mark: np.ndarray) -> np.ndarray:
        """Scans the sorted entries of a generation's batches against all levels, stores what is new and returns
        which were seen before."""
        key = whole(anchor, mark)
        seen, shared = np.zeros(len(key), bool), np.zeros(len(key), bool)
        shared[1:] |= anchor[1:] == anchor[:-1]
        shared[:-1] |= anchor[:-1] == anchor[1:]
        touched = []
        for level in self.levels:
            low = np.searchsorted(level["anchor"], anchor)
            hit = np.flatnonzero(level["anchor"][np.minimum(low, len(level["anchor"]) - 1)] == anchor)
            at = np.minimum(np.searchsorted(level["keys"], key[hit]), len(level["keys"]) - 1)
            seen[hit] |= level["keys"][at] == key[hit]
            shared[hit] = True
            touched.append((level, hit, low[hit]))
        fresh = ~seen
        for level, hit, low in touched:
            # Every entry of the level with an anchor that a new entry shares.
            low, hit = low[fresh[hit]], hit[fresh[hit]]
            high = np.searchsorted(level["anchor"], anchor[hit], "right")
            change = np.zeros(len(level["anchor"]) + 1, np.int32)
            np.add.at(change, low, 1)
            np.add.at(change, high, -1)
            level["asked"] |= np.cumsum(change)[:-1] > 0
        if fresh.any():
            self.levels.append({
                "anchor": anchor[fresh], "mark": mark[fresh], "keys": np.sort(key[fresh]),
                "batch": batch[fresh], "asked": shared[fresh],
            })
        while len(self.levels) > 1 and 2 * len(self.levels[-1]["anchor"]) > len(self.levels[-2]["anchor"]):
            b, a = self.levels.pop(), self.levels.pop()
            both = {c: np.concatenate([a[c], b[c]]) for c in a}
            order = np.argsort(both["anchor"], kind="stable")
            self.levels.append({c: np.sort(v, kind="stable") if c == "keys" else v[order] for c, v in both.items()})
        return seen

    def asked(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Batch, anchor and fingerprint of the entries whose windows have to be compared."""
        chosen = [[level[c][level["asked"]] for level in self.levels] for c in ("batch", "anchor", "mark")]
        empty = (np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))
        return tuple(np.concatenate([e, *c]) for e, c in zip(empty, chosen))


# --- Batches -----------------------------------------------------------------------

_TEXTS = pa.schema([("batch", pa.int64()), ("id", pa.int64()), ("order", pa.int64()), ("carry", pa.string()), ("text", pa.binary())])
_TEXTS_DDL = "batch long, id long, order long, carry string, text binary"
_FLAGS = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("anchor", pa.binary()), ("mark", pa.binary())])
_FLAGS_DDL = "batch long, kind int, anchor binary, mark binary"
SEEN, ASKED, COVERED = 0, 1, 2


def _packed(docs: DataFrame) -> DataFrame:
    """The rows with their texts compressed, for the shuffles."""

    def run(batches):
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in text_slices(batches, "text"):
            texts = texts_of(batch, "text").cast(pa.binary()).to_pylist()
            columns = [*batch.columns[:4], pa.array([squeeze(t) for t in texts], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=_TEXTS)

    return docs.mapInArrow(tidy(run), _TEXTS_DDL)


class _Batch:
    """The documents of a batch in ascending order, and their runs."""

    def __init__(self, rows: pa.Table):
        import zstandard

        expand = zstandard.ZstdDecompressor().decompress
        # Buffers of the table, not copies, are expanded; the texts go when they are joined.
        texts = [expand(t.as_buffer()) for chunk in rows.column("text").chunks for t in chunk]
        order = rows.column("order").to_numpy()
        place = sorted(range(len(texts)), key=lambda i: (order[i], texts[i]))
        chosen = pa.array(place, pa.int64())
        self.ids, self.carry = rows.column("id").take(chosen), rows.column("carry").take(chosen)
        self.order = order[place]
        lengths = np.array([len(texts[i]) for i in place], np.int64)
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.raw = np.zeros(int(lengths.sum()) + 64, np.uint8)
        for i, a, b in zip(place, self.starts.tolist(), self.ends.tolist()):
            self.raw[a:b] = np.frombuffer(texts[i], np.uint8)
            texts[i] = None
        self.runs = Runs(self.raw, self.starts, self.ends)

    def asked(self, numbers: np.ndarray) -> np.ndarray:
        """The first of each run with one of the sorted numbers, in the order of their anchors."""
        some = np.flatnonzero(_member(self.runs.whole, numbers))
        one = some[np.unique(self.runs.whole[some], return_index=True)[1]]
        return one[np.argsort(self.runs.anchor[one], kind="stable")]


def _short(anchor: np.ndarray) -> bytes:
    """The six bytes of each anchor that are not zero."""
    return anchor.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def _long(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1).astype(np.uint64)


def _entries(bits: int):
    schema = pa.schema([("range", pa.int64()), ("batch", pa.int64()), ("anchor", pa.binary()), ("mark", pa.binary())])

    def run(key, rows):
        release()  # what the group before has left
        runs = _Batch(rows).runs
        one = np.argsort(runs.anchor, kind="stable")
        anchor, mark = runs.anchor[one], runs.print[one]
        new = np.ones(len(one), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (mark[1:] != mark[:-1])
        anchor, mark = anchor[new], mark[new]
        ranges = (anchor >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.flatnonzero(np.diff(ranges, prepend=-1))
        stops = np.append(cuts[1:], len(anchor))
        return pa.Table.from_arrays(
            [pa.array(ranges[cuts]), pa.array(np.full(len(cuts), key[0].as_py())),
             pa.array([_short(anchor[a:b]) for a, b in zip(cuts, stops)], pa.binary()),
             pa.array([mark[a:b].tobytes() for a, b in zip(cuts, stops)], pa.binary())],
            schema=schema,
        )

    return run


def _by_batch(batch: np.ndarray, kind: int, *columns: np.ndarray) -> list[tuple]:
    """One row of flags for each batch; the columns' items stay in their order."""
    order = np.argsort(batch, kind="stable")
    batch, columns = batch[order], [c[order] for c in columns]
    cuts = np.flatnonzero(np.diff(batch, prepend=-1))
    return [
        (int(batch[a]), kind, *(c[a:b].tobytes() for c in columns)) for a, b in zip(cuts, np.append(cuts[1:], len(batch)))
    ]


def _flag_rows(out: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out) if out else [[]] * 4, _FLAGS)], schema=_FLAGS)


def _scan(key, rows):
    release()
    family, out = Family(), []
    batches = rows.column("batch").to_numpy()
    order = np.argsort(batches, kind="stable")
    generation = batches[order] >> PART_BITS
    for some in np.split(order, np.flatnonzero(np.diff(generation)) + 1):
        anchor = [_long(rows.column("anchor")[i].as_py()) for i in some.tolist()]
        mark = [np.frombuffer(rows.column("mark")[i].as_py(), np.uint64) for i in some.tolist()]
        batch = np.repeat(batches[some], [len(a) for a in anchor])
        anchor, mark = np.concatenate(anchor), np.concatenate(mark)
        if len(some) > 1:
            by = np.lexsort((mark, anchor))
            batch, anchor, mark = batch[by], anchor[by], mark[by]
        seen = family.add(batch, anchor, mark)
        out += _by_batch(batch[seen], SEEN, anchor[seen], mark[seen])
    batch, anchor, mark = family.asked()
    return _flag_rows(out + _by_batch(batch, ASKED, anchor, mark))


def _flagged(flags: pa.Table, kind: int) -> np.ndarray:
    """Sorted numbers of the runs flagged so."""
    chosen = [i for i, k in enumerate(flags.column("kind").to_pylist()) if k == kind]
    found = [
        whole(np.frombuffer(flags.column("anchor")[i].as_py(), np.uint64), np.frombuffer(flags.column("mark")[i].as_py(), np.uint64))
        for i in chosen
    ]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *found]))


def _hashes(flags: pa.Table, kind: int) -> np.ndarray:
    """Sorted hashes flagged so."""
    chosen = [i for i, k in enumerate(flags.column("kind").to_pylist()) if k == kind]
    found = [np.frombuffer(flags.column("anchor")[i].as_py(), np.uint64) for i in chosen]
    return np.sort(np.concatenate([np.zeros(0, np.uint64), *found]))


def _member(values: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Which values are among the sorted numbers."""
    if not len(numbers):
        return np.zeros(len(values), bool)
    return numbers[np.minimum(np.searchsorted(numbers, values), len(numbers) - 1)] == values


_WINDOWS = (0, 8, 16, 24, 32, 40, LENGTH - 8)


def _windows(batch: _Batch, one: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the runs ``one``: place of the run in ``one``, offset in it, hash, and a second hash."""
    first = batch.runs.first[one]
    counts = batch.runs.last[one] - first + 1
    run = np.repeat(np.arange(len(one)), counts)
    offset = np.arange(len(run)) - np.repeat(np.cumsum(counts) - counts, counts)
    at = first[run] + offset
    eight = _loads(batch.raw)
    hashed, second = np.zeros(len(at), np.uint64), np.zeros(len(at), np.uint64)
    for i, shift in enumerate(_WINDOWS):
        part = eight[at + shift]
        hashed = mix64(hashed + part * _UP[i + 1])
        second += (part ^ part >> np.uint64(31)) * _UP[i + len(_WINDOWS) + 1]
    return run, offset, hashed, mix64(second)


def _send(bits: int):
    """The hashes of the asked runs' windows, once per batch, to their ranges."""
    schema = pa.schema([("range", pa.int64()), ("batch", pa.int64()), ("hashes", pa.binary())])

    def run(key, rows, flags):
        if not rows.num_rows or not flags.num_rows:
            return schema.empty_table()
        release()
        batch = _Batch(rows)
        _, _, hashed, second = _windows(batch, batch.asked(_flagged(flags, ASKED)))
        del batch
        hashed, one = np.unique(hashed, return_index=True)
        ranges = (second[one] >> np.uint64(64 - bits)).astype(np.int64)
        by = np.argsort(ranges, kind="stable")
        ranges, hashed = ranges[by], hashed[by]
        cuts = np.flatnonzero(np.diff(ranges, prepend=-1))
        sent = [hashed[a:b].tobytes() for a, b in zip(cuts, np.append(cuts[1:], len(hashed)))]
        return pa.Table.from_arrays(
            [pa.array(ranges[cuts]), pa.array(np.full(len(cuts), key[0].as_py())), pa.array(sent, pa.binary())], schema=schema
        )

    return run


def _compare(key, rows):
    """To each batch the hashes of its windows that an earlier generation has."""
    release()
    sent = [np.frombuffer(t.as_buffer(), np.uint64) for chunk in rows.column("hashes").chunks for t in chunk]
    batch = np.repeat(rows.column("batch").to_numpy(), [len(h) for h in sent])
    hashed = np.concatenate([np.zeros(0, np.uint64), *sent])
    del sent
    by = np.lexsort((batch, hashed))
    batch, hashed = batch[by], hashed[by]
    new = np.ones(len(by), bool)
    new[1:] = hashed[1:] != hashed[:-1]
    least = batch[new][np.cumsum(new) - 1]
    later = batch >> PART_BITS > least >> PART_BITS
    batch, hashed = batch[later], hashed[later]
    return _flag_rows(_by_batch(batch, COVERED, hashed, np.zeros((len(hashed), 0), np.uint8)))


_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_KEPT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(_SPAN)), ("kept", pa.binary()), ("carry", pa.string())])


_WITH_TEXT = pa.schema([pa.field("kept", pa.string()) if f.name == "kept" else f for f in _KEPT])


def _remove_to_text(key, rows, flags):
    """As ``_remove``, with the kept bytes as text, without a worker of its own for it."""
    table = _remove(key, rows, flags)
    at = _KEPT.get_field_index("kept")
    texts = (t.as_buffer() for chunk in table.column(at).chunks for t in chunk)
    texts = pa.array([bytes(t).decode(errors="ignore") for t in texts], pa.string())
    return table.set_column(at, _WITH_TEXT.field(at), texts)


def _remove(key, rows, flags):
    if not rows.num_rows:
        return _KEPT.empty_table()
    release()
    batch = _Batch(rows)
    runs, n = batch.runs, len(batch.raw) - 64
    # Whole runs: seen in an earlier batch, or in a smaller document of this one.
    gone = _member(runs.whole, _flagged(flags, SEEN))
    by = np.argsort(runs.whole, kind="stable")  # the runs stand in the order of their documents
    in_order = runs.whole[by]
    new = np.ones(len(by), bool)
    new[1:] = in_order[1:] != in_order[:-1]
    own = batch.order[runs.doc[by]]
    if len(by):
        gone[by] |= own > own[np.flatnonzero(new)][np.cumsum(new) - 1]
    change = np.zeros(n + 1, np.int32)
    np.add.at(change, runs.first[gone], 1)
    np.add.at(change, runs.last[gone] + LENGTH, -1)
    asked = batch.asked(_flagged(flags, ASKED))
    if len(asked):
        # Windows of runs that share their anchor: in an earlier batch, or in a smaller document of this one.
        run, offset, hashed, _ = _windows(batch, asked)
        order = batch.order[runs.doc[asked]][run]
        hit = _member(hashed, _hashes(flags, COVERED))
        sorted_ = np.lexsort((order, hashed))
        starts = np.ones(len(sorted_), bool)
        starts[1:] = hashed[sorted_[1:]] != hashed[sorted_[:-1]]
        hit[sorted_] |= order[sorted_] > order[sorted_[starts]][np.cumsum(starts) - 1]
        keys, offset = runs.whole[asked][run[hit]], offset[hit]
        del run, hashed, order, sorted_, starts, hit
        # What holds for a run holds for its copies, whose documents are no smaller.
        low = np.searchsorted(in_order, keys, "left")
        high = np.searchsorted(in_order, keys, "right")
        each = np.repeat(np.arange(len(keys)), high - low)
        place = np.arange(len(each)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[each]
        first = runs.first[by[place]] + offset[each]
        np.add.at(change, first, 1)
        np.add.at(change, first + LENGTH, -1)
    del runs, by, in_order, new, own, gone
    batch.runs = None
    removed = np.cumsum(change[:n], dtype=np.int32) > 0
    del change
    # Spans end at the end of their document.
    before = np.zeros(n, bool)
    before[1:] = removed[:-1]
    before[batch.starts[batch.starts < n]] = False
    begins = np.flatnonzero(removed & ~before)
    after = np.zeros(n, bool)
    after[:-1] = removed[1:]
    after[batch.ends[batch.ends > batch.starts] - 1] = False
    stops = np.flatnonzero(removed & ~after) + 1
    del before, after
    first = np.searchsorted(begins, batch.starts)
    last = np.searchsorted(begins, batch.ends)
    of = np.repeat(np.arange(len(first)), last - first)
    spans = pa.StructArray.from_arrays(
        [pa.array(begins - batch.starts[of]), pa.array(stops - batch.starts[of])], fields=list(_SPAN)
    )
    spans = pa.ListArray.from_arrays(pa.array(np.append(first, len(begins)).astype(np.int32)), spans)
    ends = np.concatenate(([0], np.cumsum(~removed)))
    kept = batch.raw[:n][~removed]
    offsets = pa.array(np.append(ends[batch.starts], ends[-1]).astype(np.int32))
    kept = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, offsets.buffers()[1], pa.py_buffer(kept)])
    return pa.Table.from_arrays([batch.ids, pa.array(batch.ends - batch.starts), spans, kept, batch.carry], schema=_KEPT)


def _batches(rows: DataFrame) -> tuple[DataFrame, int]:
    """``rows`` (id, order, text) with their batch, and the number of bytes.

    Ids are cut at ID_RANGES quantiles, ranges of several batches again at SUB_RANGES quantiles of their own,
    so that ids far from all others do not matter; what is still larger is cut evenly. An id that fills several
    quantiles is a range of its own, and so are rows without an id, behind all others: such a range is one
    generation, whose batches are dealt by a hash of the text.
    """
    spark = rows.sparkSession
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")

    def quantiles(n: int) -> Column:
        return F.percentile_approx("id", [i / n for i in range(1, n)], 20 * n)

    def bounds_of(found: list[int]) -> list[int]:
        often = {a for a, b in zip(found, found[1:]) if a == b and a < _LAST}
        return sorted({*found, *(v + 1 for v in often)})

    cuts = bounds_of(rows.agg(quantiles(ID_RANGES)).first()[0] or [])
    beyond = len(cuts) + 1
    range_no = F.when(F.col("id").isNull(), beyond).otherwise(_steps(cuts))
    ranged = rows.withColumn("_range", range_no)
    known = ranged.groupBy("_range").agg(F.sum(size).alias("bytes")).collect()  # at most 2 * ID_RANGES rows
    total = sum(r["bytes"] for r in known)
    many = [r["_range"] for r in known if r["bytes"] > BATCH_BYTES and r["_range"] < beyond]
    subs = []
    if many:
        inner = ranged.filter(F.col("_range").isin(many)).groupBy("_range").agg(quantiles(SUB_RANGES).alias("cuts"))
        subs = [(r["_range"], bounds_of(r["cuts"])) for r in inner.collect()]
    bounds = spark.createDataFrame(subs, "_range int, _cuts array<long>")
    # The number of inner cuts at or below the id.
    below = F.coalesce(F.size(F.filter("_cuts", lambda c: c <= F.col("order"))), F.lit(0))
    ranged = ranged.join(F.broadcast(bounds), "_range", "left").withColumn("_sub", below).drop("_cuts")
    sizes = ranged.groupBy("_range", "_sub").agg(
        F.sum(size).alias("bytes"), F.min("order").alias("low"), F.max("order").alias("high")
    )
    # Ranges under a batch share one with their neighbours.
    plan, number, filled = [], 0, 0
    for r in sorted(sizes.collect(), key=lambda r: (r["_range"], r["_sub"])):
        parts, one_id = max(1, round(r["bytes"] / BATCH_BYTES)), r["high"] == r["low"]
        if parts > 1 or filled + r["bytes"] > BATCH_BYTES:
            number, filled = number + 1, 0
        plan.append((r["_range"], r["_sub"], number, parts, one_id, float(r["low"]), (r["high"] - r["low"] + 1) / parts))
        filled += r["bytes"]
        if parts > 1:
            number, filled = number + (1 if one_id else parts), 0
    lookup = spark.createDataFrame(
        plan, "_range int, _sub int, _first long, _parts long, _one boolean, _low double, _step double"
    )  # at most 4 * ID_RANGES * SUB_RANGES rows
    # In doubles, since two ids can lie further apart than a long reaches; rounding keeps their order.
    part = F.floor((F.col("order").cast("double") - F.col("_low")) / F.col("_step"))
    part = F.least(part, F.col("_parts") - 1).cast("long")
    dealt = F.pmod(F.xxhash64("text"), F.least("_parts", F.lit(1 << PART_BITS)))
    batch = F.when(F.col("_one"), F.col("_first") * (1 << PART_BITS) + dealt)
    batch = batch.otherwise((F.col("_first") + part) * (1 << PART_BITS))
    joined = ranged.join(F.broadcast(lookup), ["_range", "_sub"])
    return joined.withColumn("batch", batch).drop("_range", "_sub", "_first", "_parts", "_one", "_low", "_step"), total


def _steps(cuts: list[int]):
    """The number of cuts at or below the id, by halving."""

    def half(low: int, high: int):
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col("order") >= cuts[middle], half(middle + 1, high)).otherwise(half(low, middle))

    return half(0, len(cuts))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", carry: Column | None = None, as_text: bool = False
) -> DataFrame:
    """Per document ``key``, n_bytes, the removed spans (byte ranges) and the kept bytes.

    ``carry`` is a string that comes with each row. Cuts can fall inside a character; with ``as_text`` the kept
    bytes come as text, without the rests of characters cut in two.
    """
    order = F.coalesce(F.col(key).cast("long"), F.lit(_LAST))
    carry = F.lit(None).cast("string") if carry is None else carry
    rows = docs.select(F.col(key).cast("long").alias("id"), order.alias("order"), carry.alias("carry"), F.col(text).alias("text"))
    rows, total = _batches(rows)
    bits = 4
    while (RANGE_BYTES << bits) < total * ENTRIES_PER_BYTE * 16:
        bits += 1
    texts = _packed(rows.select("batch", "id", "order", "carry", "text")).groupBy("batch")
    entries = texts.applyInArrow(_entries(bits), "range long, batch long, anchor binary, mark binary")
    flags = cut_lineage(entries.groupBy("range").applyInArrow(_scan, _FLAGS_DDL))
    asked = flags.filter(F.col("kind") == ASKED).groupBy("batch")
    sent = texts.cogroup(asked).applyInArrow(_send(bits), "range long, batch long, hashes binary")
    flags = flags.unionByName(sent.groupBy("range").applyInArrow(_compare, _FLAGS_DDL))
    kind = "string" if as_text else "binary"
    kept = texts.cogroup(flags.groupBy("batch")).applyInArrow(
        _remove_to_text if as_text else _remove,
        f"id long, n_bytes long, spans array<struct<start: long, end: long>>, kept {kind}, carry string",
    )
    return kept.withColumnRenamed("id", key)
