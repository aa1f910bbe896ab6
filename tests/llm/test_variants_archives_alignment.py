"""Spelling variants, archives and token alignment against brute force; awkward rows of 3, 9 and the pipeline."""

import base64
import hashlib
import io
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import zstandard
from pyspark.errors import PythonException

import corpus_pipeline
from fleetscope.llm import langid, spelling, suffix_dedup, token_alignment, warc
from fleetscope.llm.common import table
from fleetscope.llm.queries import QUERIES
from fleetscope.session import fresh_folder

SMALL = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


# --- 11 --------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def spelled(rows, one_in, min_length=6, min_count=5):
    lower, counts = str.maketrans(spelling.UPPER, spelling.LOWER), Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if one_in and h % one_in == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    near = {w: [v for k in (-1, 0, 1) for v in by_length[len(w) + k] if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        if best is not None and n[best] >= 5 * n[w]:
            form[w] = best
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None))
    return out


def test_spelling_query(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").collect()]
    got = QUERIES["op11_spelling"](spark, SMALL)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    same(got.collect(), spelled(rows, 199))


@pytest.fixture(scope="module")
def misspelled(spark):
    """Frequent words with edits of all kinds, ties, chains, accents, nulls, long words and texts."""
    draw = random.Random(11)
    stems = ["aabbaabb", "letters", "éclairs", "ÿÿÿÿÿÿ", "x" * 3000, "ab" * 40] + ["".join(draw.choices("abc", k=7)) for _ in range(60)]
    words = []
    for stem in stems:
        words += [stem] * draw.choice((5, 6, 30, 160, 900))
        for _ in range(4):
            i, c = draw.randrange(len(stem)), draw.choice("abcé÷")
            edit = draw.choice((stem[:i] + stem[i + 1 :], stem[:i] + c + stem[i:], stem[:i] + c + stem[i + 1 :]))
            words += [edit] * draw.choice((1, 4, 5, 5, 25))
    words += ["Letters", "LETTERS", "ÉCLAIRS", "lettərs"]
    draw.shuffle(words)
    cut = [sorted(draw.choices(range(len(words)), k=30))]
    parts = [" ".join(words[a:b]) for a, b in zip([0, *cut[0]], [*cut[0], len(words)])]
    rows = [(i if i % 7 else None, p, "w", 1) for i, p in enumerate(parts)]
    rows += [(3, None, "w", 1), (4, "", None, None), rows[5], rows[5]]
    return spark.createDataFrame(rows, "doc_id long, text string, word string, n int").coalesce(3)


@pytest.mark.parametrize("one_in", [None, 3, 199])
def test_spelling_of_odd_rows(misspelled, one_in):
    rows = [tuple(r) for r in misspelled.select("doc_id", "text").collect()]
    got = spelling.variants(spelling.vocabulary(misspelled, one_in=one_in)).collect()
    same(got, spelled(rows, one_in))
    assert any(r["root"] != (r["form"] or r["word"]) for r in got) or one_in


def test_filters_change_no_result(misspelled):
    """Even filters of one block a length, which hold nearly everything."""
    words = spelling.vocabulary(misspelled)
    wide, narrow = spelling.build_filters(words), spelling.build_filters(words, filter_bytes=8)
    assert sum(map(len, narrow.values())) < sum(map(len, wide.values()))
    same(spelling.variants(words, filter_bytes=8).collect(), map(tuple, spelling.variants(words).collect()))


def test_filters_hold_every_word_and_few_others(misspelled):
    words = [r[0] for r in spelling.vocabulary(misspelled).collect()]
    filters = spelling.build_filters(misspelled.sparkSession.createDataFrame([(w,) for w in words], "word string"))
    for length, places, points in spelling._by_length(words):
        assert len(spelling._found(filters, length, spelling._hash(points))) == len(places)
    strange = np.random.default_rng(1).integers(0xC0, 0xFF, (20_000, 7), np.uint8)
    assert len(spelling._found(filters, 7, spelling._hash(strange))) < 2_000


def test_roots_over_a_long_chain(spark):
    rows = [(f"w{i}", f"w{i + 1}" if i < 9 else None, 5**i) for i in range(10)]
    rows = spark.createDataFrame(rows, "word string, form string, n long")
    assert {tuple(r) for r in spelling.roots(rows).collect()} == {(f"w{i}", "w9") for i in range(9)}


# --- 12 --------------------------------------------------------------------------------


def archived(rows, min_bytes):
    ids = defaultdict(list)
    for key, _, html in rows:
        ids[html or ""].append(key)
    out = []
    for key, _, html in rows:
        data = (html or "").encode()
        last = max((k for k in ids[html or ""] if k is not None), default=None)
        revisits = len(data) >= min_bytes and last is not None and key != last
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((key, len(data), digest, "revisit" if revisits else "response", last if revisits else None))
    return out


def test_archive_query(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "pages").select("page_id", "url", "html").collect()]
    got = QUERIES["op12_warc"](spark, SMALL)
    same(got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect(), archived(rows, 0))


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, "http://a/ b\r\nX: y", "x\r\n\r\ny"), (2, None, None), (3, "http://é", ""), (4, "u", "same"), (5, "u", "same"),
            (None, "u", "same"), (5, "u", "same"), (6, "u", "ü" * 900_000), (7, "u", "ü" * 900_000), (None, "q", "zz"),
            (None, "q", "zz"), (8, "w", "\r\n\r\n"), (9, "w", "Content-Length: 3\r\n\r\nWARC/1.1"), (-1, "", "\x00")]
    return spark.createDataFrame([(*r, "f", 1) for r in rows], "page_id long, url string, html string, file string, records int")


@pytest.mark.parametrize("min_bytes", [0, 4, 5, 10_000_000])
def test_archives_of_odd_rows(spark, odd_pages, min_bytes):
    rows = [tuple(r)[:3] for r in odd_pages.collect()]
    folder = fresh_folder(spark, "warc")
    warc.write(odd_pages, folder, min_bytes=min_bytes, archive_bytes=1000)
    found = warc.read(spark, folder).collect()
    same([(r.row_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found], archived(rows, min_bytes))
    full = {(k, html or "") for k, _, html in rows}
    assert all((r.row_id, r.payload) in full for r in found if r.record_type == "response")
    assert all(r.payload is None for r in found if r.record_type == "revisit")
    assert {r.url for r in found if r.row_id == 1} == {"http://a/%20b%0D%0AX:%20y"}
    assert len({r.file for r in found}) > 1


def test_a_file_of_a_lost_attempt_is_not_read(spark, odd_pages):
    folder = fresh_folder(spark, "warc")
    warc.write(odd_pages, folder)
    before = warc.read(spark, folder).count()
    lost = warc.Archive(f"{folder}/archives", "2000-01-01T00:00:00Z")
    lost.close()
    assert warc.read(spark, folder).count() == before


def record(number, text):
    payload = text.encode()
    fields = {"WARC-Record-ID": f"<urn:row:{number}>", "WARC-Date": "2000-01-01T00:00:00Z",
              "WARC-Payload-Digest": f"sha1:{warc.digest_of(payload)}"}
    return warc.record_bytes("response", fields, warc._http_head(len(payload)) + payload)


@pytest.mark.parametrize("packed", [False, True])
def test_dictionary_in_front(packed):
    texts = [f"page {i} with much the same text as every other page of this archive" * 3 for i in range(400)]
    dictionary = zstandard.train_dictionary(4096, [record(i, t) for i, t in enumerate(texts)], k=64, d=8)
    body = dictionary.as_bytes()
    coder = zstandard.ZstdCompressor(dict_data=dictionary)
    front = warc.dictionary_frame(zstandard.ZstdCompressor().compress(body) if packed else body)
    data = front + b"".join(coder.compress(record(i, t)) for i, t in enumerate(texts))
    data += (0x184D2A51).to_bytes(4, "little") + (3).to_bytes(4, "little") + b"abc"  # another skippable frame
    found = list(warc.records(io.BytesIO(data)))
    assert [warc.payload_of(r)[2].decode() for r in found] == texts
    with pytest.raises(warc.BadArchive):
        list(warc.records(io.BytesIO(data[len(front) :])))  # the dictionary is needed


def test_frames_without_a_dictionary():
    data = b"".join(zstandard.compress(record(i, "t" * i)) for i in range(5))
    assert [warc.payload_of(r)[0] for r in warc.records(io.BytesIO(data))] == [0, 1, 2, 3, 4]
    assert list(warc.records(io.BytesIO(b""))) == []


def test_broken_archives():
    good = record(1, "text")
    pack = zstandard.compress

    def read(data):
        return [warc.payload_of(r) for r in warc.records(io.BytesIO(data))]

    read(pack(good))
    for bad in (
        pack(good)[:-3], pack(good) + b"\x01", b"junk" + pack(good), pack(good[:-4]), pack(good + b"x"), pack(good + good),
        pack(good.replace(b"WARC/1.1", b"HTTP/1.1")), pack(good.replace(b"WARC-Date: 2000-01-01T00:00:00Z\r\n", b"")),
        pack(good.replace(b"text", b"tex!")), pack(good.replace(b"sha1:", b"md5:")), pack(good.replace(b"Content-Length: 4", b"Content-Length: 3")),
        warc.dictionary_frame(b"no dictionary") + pack(good), warc.dictionary_frame(b"123456")[:-2],
    ):
        with pytest.raises(warc.BadArchive):
            read(bad)


def test_a_missing_record_is_noticed(spark, odd_pages):
    folder = fresh_folder(spark, "warc")
    warc.write(odd_pages, folder)
    files = spark.read.parquet(f"{folder}/manifest").selectExpr("file", "records + 1 AS records")
    with pytest.raises(PythonException, match="records instead of"):
        warc.read_archives(files, f"{folder}/archives").count()


# --- 13 --------------------------------------------------------------------------------


def aligned(rows):
    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    left, right = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    left.encode_special_tokens = True
    pair = token_alignment.Pair(A, B)
    a_bytes, b_bytes = pair.a_bytes.to_pylist(), pair.b_bytes.to_pylist()
    docs, counts = [], Counter()
    for key, text in rows:
        text = text or ""
        raw = (" " + text).encode()
        a, b = left.encode(" " + text, add_special_tokens=False).ids, right.encode(text)
        if not text or b"".join(a_bytes[i] for i in a) != raw or b"".join(b_bytes[i] for i in b) != raw:
            docs.append((key, [], [], [], []))
            continue
        ends_a, ends_b = (np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((a_bytes, a), (b_bytes, b)))
        groups, links, i, j = [], [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            x = [k for k in range(i, len(a)) if ends_a[k] <= end] if len(a) < 2000 else [*range(i, ends_a.index(end) + 1)]
            y = [k for k in range(j, len(b)) if ends_b[k] <= end] if len(b) < 2000 else [*range(j, ends_b.index(end) + 1)]
            links += [
                (a[k], b[m]) for k in x for m in y
                if max(([0] + ends_a)[k], ([0] + ends_b)[m]) < min(ends_a[k], ends_b[m])
            ]
            groups.append(",".join(str(a[k]) for k in x) + "|" + ",".join(str(b[k]) for k in y))
            i, j = x[-1] + 1, y[-1] + 1
        counts.update(links)
        docs.append((key, a, b, groups, links))
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (k, len(a), len(b), len(g), len(x), sum(counts[p] == most[p[1]] for p in x), sum(counts[p] for p in x),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for k, a, b, g, x in docs
    ]


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_alignment_query(spark):
    rows = [tuple(r) for r in table(spark, SMALL, "documents").select("doc_id", "text").limit(60).collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = token_alignment.align_tokens(token_alignment.code(docs, A, B, block_bytes=20_000))
    assert got.columns == COLUMNS
    same(got.collect(), aligned(rows))
    whole = QUERIES["op13_alignment"](spark, SMALL)
    assert whole.columns == COLUMNS and whole.count() == table(spark, SMALL, "documents").count()


ODD = [
    (1, None), (2, ""), (3, " "), (4, "  a  b "), (5, "a\n b\n  c\t d"), (6, "x▁y z"), (7, "<|endoftext|> <s> <0x41> <unk>"),
    (8, "déjà 中文 　 🙂 x"), (9, "\x00a b"), (None, "the same"), (9, "the same"), (10, "a\x1c b   c  d"), (11, "ab" * 4000),
    (12, "\n"), (13, " \n "), (14, "don't we'll it's   "), (15, "a " * 900), (16, "é ́x"), (17, "  x  y"), (18, "ｱ ǅ ﷽"),
]


@pytest.mark.parametrize("block_bytes", [1, 64, 1 << 24])
def test_alignment_of_odd_rows(spark, block_bytes):
    docs = spark.createDataFrame([(*r, 1, "p") for r in ODD], "doc_id long, text string, block int, pairs string")
    same(token_alignment.align_tokens(token_alignment.code(docs, A, B, block_bytes=block_bytes)).collect(), aligned(ODD))


def test_only_lost_texts(spark):
    docs = spark.createDataFrame([(1, "x▁y"), (2, None)], "doc_id long, text string")
    got = token_alignment.align_tokens(token_alignment.code(docs, A, B)).collect()
    same(got, [(1, 0, 0, 0, 0, 0, 0, ""), (2, 0, 0, 0, 0, 0, 0, "")])


def test_parts_encode_as_the_whole_text():
    """Random texts of spaces, line ends, marks and letters, part by part and whole."""
    draw, pair = random.Random(13), token_alignment.Pair(A, B)
    for _ in range(300):
        text = "".join(draw.choices([" ", " ", "\n", "\t", "a", "Bc", "'s", "1", "é", "中", "!", "　", " "], k=draw.randrange(1, 40)))
        block = token_alignment.Block(pair)
        parts = [p[1:] for p in token_alignment._BEHIND_WORD.split(" " + text)]
        block.learn(list(dict.fromkeys(parts)))
        chosen = np.array([block.parts[p] for p in parts])
        windows = block.part_windows.take(chosen)
        ids = pair.a.encode(" " + text, add_special_tokens=False).ids
        assert block.good.all() and int(block.counts[0][windows].sum()) == len(ids)
        assert int(block.counts[1][windows].sum()) == len(pair.b.encode(text))


# --- 3, 9 and the pipeline -------------------------------------------------------------


def test_marks_alone_and_strange_scripts(spark):
    model = langid.fit(spark.createDataFrame([("the cat and the dog", "en"), ("le chat et le chien", "fr")], "text string, lang string"))
    texts = ["\u0301\u0301", "\u0301 \u0308!", "\u0301the cat", "中文", "中文 the cat", "the\u0301 cat", None, "", "12 %"]
    got = langid.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).orderBy("doc_id").collect()
    assert [r.lang_pred for r in got] == ["und", "und", "en", "en", "en", "en", "und", "und", "und"]
    assert [r.score for r in got][:2] == [0, 0] and got[3].score == 0 and got[2].score == got[5].score == 1
    assert got[4].score == pytest.approx(6 / 8)


def without_repeats(rows):
    last, first = (1 << 63) - 1, {}
    for key, text in rows:
        data = (text or "").encode()
        for k in range(len(data) - 49):
            first[data[k : k + 50]] = min(first.get(data[k : k + 50], last), last if key is None else key)
    out = []
    for key, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - 49):
            if first[data[k : k + 50]] < (last if key is None else key):
                gone[k : k + 50] = bytes([1]) * 50
        spans = [m.span() for m in re.finditer(b"\x01+", bytes(gone))]
        out.append((key, len(data), tuple(spans), bytes(x for x, g in zip(data, gone) if not g)))
    return out


@pytest.mark.parametrize("ids", ["negative", "one", "far", "null"])
@pytest.mark.parametrize("cut", [None, (3000, 4, 3)])
def test_repeats_with_awkward_ids(spark, monkeypatch, ids, cut):
    """Null ids beside ids up to 0, one id for all, ids at both ends of the range, no ids."""
    draw = random.Random(ids)
    passages = [" ".join("".join(draw.choices("abcdef", k=5)) for _ in range(30)) for _ in range(10)]

    def text():
        parts = (draw.choice(passages)[draw.randrange(60) :] if draw.random() < 0.6 else "".join(draw.choices("xyz ", k=80)) for _ in range(draw.randrange(5)))
        return " ".join(parts)

    keys = {"negative": [*range(-150, 0), None], "one": [0] * 80 + [None], "null": [None] * 30 + [3],
            "far": [draw.choice([-(2**63), 2**63 - 1, 5, None]) if i % 9 == 0 else i for i in range(200)]}[ids]
    rows = [(k, text()) for k in keys] + [(7, None), (8, "")]
    if cut:
        for name, value in zip(("BATCH_BYTES", "ID_RANGES", "SUB_RANGES"), cut):
            monkeypatch.setattr(suffix_dedup, name, value)
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = [(r.doc_id, r.n_bytes, tuple(map(tuple, r.spans)), bytes(r.kept)) for r in got]
    assert sorted(got, key=repr) == sorted(without_repeats(rows), key=repr)


def test_one_far_id_does_not_swell_a_batch(spark, monkeypatch):
    for name, value in (("BATCH_BYTES", 3000), ("ID_RANGES", 4), ("SUB_RANGES", 64)):
        monkeypatch.setattr(suffix_dedup, name, value)
    docs = spark.range(1000).selectExpr("IF(id = 999, 9000000000000000000, id) AS id", "id AS order", "repeat('x', 100) AS text")
    sizes = suffix_dedup._batches(docs.withColumn("order", docs["id"]))[0].groupBy("batch").count().collect()
    assert max(r["count"] for r in sizes) <= 60 and len(sizes) >= 25


def test_pipeline_columns_of_its_own_names(spark):
    rows = [(i, f"some words of a text that is number {i} " * 4, "en", "a", 10, 0.5, "m", "x") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _score double, _mark string, _Turn string")
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.mixed):
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and {(r["_score"], r["_mark"], r["_Turn"]) for r in out.collect()} == {(0.5, "m", "x")}
