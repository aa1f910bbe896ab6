"""The operators against brute force on small tables, and on awkward rows."""

import hashlib
import math
import operator
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from fleetscope.llm import (
    bpe, langid, mixing, mtree, ngram_join, nn_descent, quality, suffix_dedup, token_codes, url_filter,
)
from fleetscope.llm.common import table
from fleetscope.llm.queries import ORACLES, QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, mark string, kept string"


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def odd_docs(spark):
    """Nulls in every column, empty, very long and repeated texts, ties, clashing names."""
    words = random.Random(3)
    long = " ".join("".join(words.choices("abcdefgh", k=6)) for _ in range(12_000)) + " " + "xyzw" * 30_000
    passage = "the same passage of rather more than fifty bytes in every one of them, word for word"
    texts = [None, "", " \t\n", "!!! 123", "one two", long, long + " tail", "déjà vu " + passage, passage, passage, "ab " * 400,
             "<|endoftext|> it's \x1c 中文 \u3000 İ Σ", "a\u0301", passage.replace("word", "wörd")]
    rows = [(i, t, ["en", None, "fr"][i % 3], ["a", None, "b"][i % 3], None, "s", None, "k") for i, t in enumerate(texts)]
    rows += [rows[8], (None, passage, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def rows_of(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, tmp_path, name):
    for t in ("documents", "labels", "embeddings", "pages"):
        table(spark, "/root/testdata/sf0.001", t).limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, folder).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())


# --- 1 ---------------------------------------------------------------------------------


def shingle_set(text):
    w = (text or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def check_join(rows, got):
    sets = [shingle_set(t) for _, t in rows]
    links = []
    for i, a in enumerate(sets):
        links.append([j for j, b in enumerate(sets) if i != j and a and b and len(a & b) >= 0.8 * len(a | b)])
    seen = {}
    for i in range(len(rows)):
        group, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()]:
                if j not in group:
                    group.add(j)
                    todo.append(j)
        seen[i] = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
    want = sorted(((r[0], seen[i], len(links[i])) for i, r in enumerate(rows)), key=str)
    assert sorted(got, key=str) == want


def test_join_finds_every_link(spark):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    check_join(rows_of(docs, "doc_id", "text"), rows_of(ngram_join.join(docs), "doc_id", "class_id", "n_links"))


def test_join_of_odd_rows(odd_docs):
    joined = ngram_join.join(odd_docs)
    check_join(rows_of(odd_docs, "doc_id", "text"), rows_of(joined, "doc_id", "class_id", "n_links"))
    assert rows_of(joined.filter("doc_id = 9"), "kept") == [(False,)]


def test_join_of_a_group_over_several_blocks(spark):
    base = [f"w{i}" for i in range(200)]
    texts = [(i, " ".join(base[:150] + [f"own{i}"] + base[150:])) for i in range(600)]
    joined = ngram_join.join(spark.createDataFrame(texts, "doc_id long, text string"))
    assert {tuple(r) for r in joined.select("class_id", "n_links").collect()} == {(0, 599)}
    assert joined.filter("kept").count() == 1


def test_banding():
    bands, rows = ngram_join.banding(0.8, 0.999, 0.4)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.999 and 1 - (1 - 0.4**rows) ** bands <= 0.1


# --- 2 and 3 ---------------------------------------------------------------------------


def test_quality_held_out(spark):
    folder = "/root/testdata/sf0.1"
    scored = QUERIES["op2_quality"](spark, folder).join(table(spark, folder, "labels"), "doc_id").filter("held_out")
    right, clean, n = scored.agg(
        F.avg((F.col("predicted") == F.col("quality")).cast("int")),
        F.min(F.when(F.col("quality") == 1, F.col("predicted"))), F.count(F.lit(1)),
    ).first()
    assert n > 500 and right > 0.97 and clean == 1


def test_quality_of_odd_rows(spark, odd_docs):
    labels = spark.createDataFrame([(4, 1), (5, 0), (8, 1), (99, 0), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit(odd_docs, labels)
    scored = quality.score(odd_docs, model)
    assert scored.count() == odd_docs.count() and set(scored.columns) == set(odd_docs.columns)
    assert scored.filter("score is null or score < 0 or score > 1 or isnan(score)").count() == 0
    nothing = quality.fit(odd_docs, labels.limit(0))
    assert {r[0] for r in rows_of(quality.score(odd_docs, nothing), "score")} == {0.5}


def test_language_held_out(spark):
    folder = "/root/testdata/sf0.1"
    found = QUERIES["op3_language"](spark, folder).join(table(spark, folder, "documents"), "doc_id").filter("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98


def best_path(scores, penalty):
    value, back = scores[0].copy(), []
    for row in scores[1:]:
        jump = int(value.argmax())
        back.append([i if value[i] >= value[jump] - penalty else jump for i in range(len(row))])
        value = np.array([max(value[i], value[jump] - penalty) for i in range(len(row))]) + row
    path = [int(value.argmax())]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def test_language_spans(spark, odd_docs):
    train = spark.createDataFrame([("en", "the cat and the dog " * 20), ("fr", "le chat est là où " * 20), ("el", "το και στο")], "lang string, text string")
    model = langid.fit(train)
    texts = pa.array(["the cat le chat est là où the dog and the cat", "στο", "", "le"])
    words = langid._Words(texts)
    scores = model.word_scores(words)[words.codes]
    path = model.path(words)
    for a, b in zip(words.starts[:-1], words.starts[1:]):
        if b > a:
            assert path[a:b].tolist() == best_path(scores[a:b], model.penalty)
    rows = spark.createDataFrame([(1, "the cat and the dog le chat est là où le chat est là"), (2, "στο"), (3, "中文")], "doc_id long, text string")
    found = {r["doc_id"]: r for r in langid.predict(rows, model).collect()}
    assert [s["lang"] for s in found[1]["spans"]] == ["en", "fr"] and found[2]["lang_pred"] == "el"
    odd = langid.predict(odd_docs, model)
    assert odd.count() == odd_docs.count()
    assert {r[0] for r in rows_of(odd.filter("doc_id in (0, 1, 2, 3)"), "lang_pred")} == {"und"}
    assert {r[0] for r in rows_of(langid.predict(odd_docs, langid.fit(train.limit(0))), "lang_pred")} == {"und"}


# --- 4 ---------------------------------------------------------------------------------


def test_mix_of_odd_rows(odd_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(0 <= r["taken"] <= 2 * r["size"] and r["target"] <= 2 * r["source_size"] + 1e-6 for r in rows)
    assert sorted(map(str, rows)) == sorted(map(str, mixing.mix(odd_docs).collect()))


def test_mix_meets_targets(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.col("id") % 5).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 7 + 1).cast("int")).alias("text"))
    by = mixing.mix(docs).join(docs, "doc_id").groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("g")).collect()
    assert all(abs(r["t"] - r["g"]) <= 16 for r in by)


# --- 5 and 6 ---------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, score int"


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(1)
    centre = rng.standard_normal(8)
    rows = [(i, [float(x) for x in centre + 0.3 * rng.standard_normal(8)], i % 2, 0) for i in range(500)]
    rows += [(500 + i, rows[0][1], 0, 0) for i in range(40)]
    rows += [(600, None, 0, 0), (601, [], 0, 0), (602, [0.0] * 8, 0, 0), (603, [1.0, None] * 4, 0, 0), (604, [float("nan")] * 8, 0, 0),
             (605, [float("inf")] * 8, 0, 0), (606, rows[0][1], None, 0), (607, [1.0, 2.0], 0, 0), (650, [2.0, 4.0], 0, 0)]
    return spark.createDataFrame(rows, VECTORS)


def usable(v, zero):
    return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and (zero or any(v))


def test_nn_descent(vectors):
    rows = rows_of(vectors, "vec_id", "embedding", "label")
    got = {r["vec_id"]: r for r in nn_descent.near_duplicates(vectors).collect()}
    good = [(i, np.array(v, float) / np.linalg.norm(np.array(v, float)), label) for i, v, label in rows if usable(v, False) and label is not None]
    for i, a, label in good:
        near = [j for j, b, other in good if i != j and label == other and len(a) == len(b) and a @ b >= 0.93]
        assert got[i]["n_links"] == len(near)
        assert got[i]["component_id"] <= min([i, *near]) and all(got[j]["component_id"] == got[i]["component_id"] for j in near)
    for i, v, label in rows:
        if not usable(v, False) or label is None:
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, i, True)


def test_nn_descent_joins_dense_groups(spark):
    """Two groups whose links to each other are weaker than those to over 256 of their own."""
    rng = np.random.default_rng(3)
    centres = np.zeros((2, 32))
    centres[0, 0], centres[1, :2] = 1, (0.945, (1 - 0.945**2) ** 0.5)
    x = np.repeat(centres, 300, 0) + 0.003 * rng.standard_normal((600, 32))
    data = spark.createDataFrame([(i, 1, v) for i, v in enumerate(x.tolist())], "vec_id long, label long, embedding array<double>")
    got = nn_descent.near_duplicates(data).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(599, 0)}


def test_nn_descent_packs_follow_the_rows():
    assert all(rows / nn_descent._packs(rows) <= nn_descent.PACK_ROWS for rows in (0, 10**6, 10**7, 25 * 10**7))


def test_nn_descent_tables_follow_the_signs():
    for bits in (0, 5, 15, 18, 25):
        equal = (1 - np.arccos(0.93) / np.pi) ** bits
        assert 1 - (1 - equal) ** nn_descent._tables(bits, 0.93) >= 0.99


def test_nn_descent_audit_sees_rare_pairs(spark):
    """Six pairs among 3,000 vectors, and none of them found."""
    x = np.random.default_rng(5).standard_normal((3000, 32))
    x[-6:] = x[:6] + 0.05 * x[6:12]
    nodes = spark.createDataFrame([(i, 1, 32, v, 1) for i, v in enumerate(x.tolist())], "id long, label long, dim int, v array<double>, weight long")
    found = spark.createDataFrame([], "id long, component long")
    fresh = nn_descent._joined(nn_descent._first_graph(nodes, 1, 0.93))
    merged = nn_descent.components(fresh)
    assert nn_descent.audit(nodes, found, merged, fresh, 0.93) == 0
    assert nn_descent.audit(nodes, merged, merged, fresh, 0.93) >= 0.95


def test_nn_descent_fails_below_its_recall(spark, vectors, monkeypatch):
    monkeypatch.setattr(nn_descent, "ATTEMPTS", 1, raising=False)
    with pytest.raises(RuntimeError, match="recall"):
        nn_descent.near_duplicates(vectors, recall=1.01)


def test_mtree(vectors):
    rows = [(i, np.floor(256 * np.array(v, float))) for i, v in rows_of(vectors, "vec_id", "embedding") if usable(v, True)]
    want = []
    for i, q in rows:
        if i % 50 == 0:
            best = sorted((-int(q @ v), j) for j, v in rows if j != i and len(v) == len(q))[:5]
            want += [(i, rank + 1, j, -s) for rank, (s, j) in enumerate(best)]
    got = mtree.top_k(vectors, F.col("vec_id") % 50 == 0)
    assert sorted(rows_of(got, "query_id", "rank", "vec_id", "score")) == sorted(want)


def test_mtree_keeps_rows_of_repeated_ids(spark):
    """Copies of a query, of its best hit, and an id with two vectors of one score are rows of their own."""
    rng = np.random.default_rng(4)
    x = (rng.standard_normal((300, 4))).tolist()
    rows = [(i, v) for i, v in enumerate(x)]
    rows += [(50, x[50])] * 5 + [(51, x[50]), (50, x[3]), (100, x[9])]
    rows += [(7, [4 * c for c in x[150]])] * 5 + [(400, [1.0, 0, 0, 0]), (401, [0, 1.0, 0, 0]), (401, [1.0, 0, 0, 0])]
    data = spark.createDataFrame([(i, [float(c) for c in v]) for i, v in rows], "vec_id long, embedding array<double>")
    want, floored = [], [(i, np.floor(256 * np.array(v, float))) for i, v in rows]
    for query in {i for i, _ in rows if i % 50 == 0}:
        scored = sorted((-int(q @ v), j) for i, q in floored if i == query for j, v in floored if j != query)
        want += [(query, rank + 1, j, -score) for rank, (score, j) in enumerate(scored[:5])]
    got = mtree.top_k(data, F.col("vec_id") % 50 == 0)
    assert sorted(rows_of(got, "query_id", "rank", "vec_id", "score")) == sorted(want)


def whole_best(rows):
    """Brute force over (id, vector) in whole numbers within 64 bits."""
    low, high = -(1 << 63), (1 << 63) - 1
    whole = [(i, [min(max(math.floor(256 * x), low), high) for x in v]) for i, v in rows]
    want = []
    for query, q in whole:
        if query % 50 == 0:
            scored = [(min(max(sum(map(operator.mul, q, v)), low), high), j) for j, v in whole if j != query and len(v) == len(q)]
            best = sorted(scored, key=lambda t: (-t[0], t[1]))[:5]
            want += [(query, rank + 1, j, score) for rank, (score, j) in enumerate(best)]
    return sorted(want)


def test_mtree_large_components_and_empty_vectors(spark):
    """Neither takes a vector out; products over 2^53 and 2^63 keep their order."""
    draw = random.Random(3)
    rows = [(50, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [40000.0, 1.0]), (100, [-40000.5, 3.0]), (200, []), (201, []), (250, [])]
    rows += [(300 + i, [draw.choice([1.0, 3e6, 7e11, 1e30, -1e30]) * draw.uniform(-1, 1) for _ in range(3)]) for i in range(400)]
    # scores that doubles cannot tell apart
    rows += [(1000 + i, [2.0**24 + i / 256, 2.0**25, 1.0 + i % 3]) for i in range(60)]
    rows += [(2000 + i, [0.25 * i, -1.0, 0.5, 2.0**40 * (i % 2)]) for i in range(60)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = mtree.top_k(data, F.col("vec_id") % 50 == 0)
    assert sorted(rows_of(got, "query_id", "rank", "vec_id", "score")) == whole_best(rows)


def test_mtree_answers_queries_in_blocks(spark, monkeypatch):
    draw = random.Random(8)
    rows = [(i, [draw.gauss(0, 1) for _ in range(4)]) for i in range(1500)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 7)
    monkeypatch.setattr(mtree, "SHARD", 20)
    got = mtree.top_k(data, F.col("vec_id") % 50 == 0)
    assert sorted(rows_of(got, "query_id", "rank", "vec_id", "score")) == whole_best(rows)


def test_mtree_passes_pages_over():
    rng = np.random.default_rng(2)
    x = np.floor(rng.standard_normal((40, 1, 16)) * 900 + rng.standard_normal((40, 100, 16)) * 20).reshape(-1, 16)
    tree = mtree.Tree(x, float((x**2).sum(1).max()))
    ids = [[i] for i in range(len(x))]
    for q in range(0, 4000, 97):
        scores = x @ x[q]
        want = sorted(((-int(s), i) for i, s in enumerate(scores) if i != q))[:5]
        assert sorted((-s, i) for s, i in tree.search(x[q], 5, ids, q)) == want


# --- 7 ---------------------------------------------------------------------------------


def test_urls(spark):
    urls = [None, "", "no scheme", "http://A.Example.NET/en/x?q#f", "http://example.net", "https://x.org/fr/1", "http://x.org/de/1",
            "http://net/", "http://m.example.com/de/a/b", "http://example.com/de", "http://notexample.com/de/", "a://b://c.net/d", "http://h.net?x"]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id long, url string, host int")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    for i, u in enumerate(urls):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:].split("?")[0].split("#")[0]
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        rule = max(fits)[1:] if fits else (None, got[i][3])
        assert got[i] == (host, path, *rule)


def test_url_templates(spark):
    rules = [("block", "h.com", f"/spam/{i}") for i in range(10, 60)] + [("allow", "h.com", f"/good/{i}") for i in range(10, 60)]
    urls = [f"http://h.com/{kind}/{i}.html" for kind in ("spam", "good") for i in range(10, 300)] + [f"http://h.com/u/name{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(90)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rows = url_filter.judge(pages, rules).collect()
    verdicts = {(r["path"].split("/")[1], r["verdict"]) for r in rows}
    assert verdicts == {("spam", "block"), ("good", "allow"), ("u", "allow")}
    assert {r["template"] for r in rows} == {"/spam/*", "/good/*", "/u/*"}


def brute_templates(paths, min_children=8, least_repeats=2.0, z=1.96):
    """{(host, form): template} of {(host, form): (pages, labelled, blocked)}, one node at a time."""
    named = {}

    def like(own, others):
        if not others:
            return False
        n, rest = sum(c[0] for _, c in own), sum(c[0] for _, c in others)
        kinds = {(s[1] if len(s) > 1 else "") for s, _ in own + others}
        apart = 0.0
        for kind in kinds:
            ours, theirs = (sum(c[0] for s, c in side if (s[1] if len(s) > 1 else "") == kind) for side in (own, others))
            for seen, size in ((ours, n), (theirs, rest)):
                expected = size * (ours + theirs) / (n + rest)
                apart += (seen - expected) ** 2 / expected
        free = max(len(kinds) - 1, 1)
        if apart > free * (1 - 2 / (9 * free) + z * math.sqrt(2 / (9 * free))) ** 3:
            return False
        (a, ab), (b, bb) = ((sum(c[1] for _, c in side), sum(c[2] for _, c in side)) for side in (own, others))
        if not a or not b:
            return True
        share = (ab + bb) / (a + b)
        return abs(ab / a - bb / b) <= z * math.sqrt(share * (1 - share) * (1 / a + 1 / b))

    def walk(host, template, rows):
        """rows: (segments left, counts, form)"""
        children = {}
        for left, counts, form in rows:
            if left:
                children.setdefault(left[0], []).append((left, counts, form))
            else:
                named[host, form] = template
        if sum(map(len, children.values())) == 1:
            ((left, _, form),) = next(iter(children.values()))
            named[host, form] = "/".join([template, *left])
            return
        pages = sum(c[0] for group in children.values() for _, c, _ in group)
        below = {}
        for step, group in children.items():
            own = [(left, c) for left, c, _ in group]
            others = [(left, c) for other, rows in children.items() if other != step for left, c, _ in rows]
            varies = len(children) >= min_children and pages < least_repeats * len(children)
            name = "*" if step == "*" or varies else "+" if like(own, others) else step
            below.setdefault(name, []).extend((left[1:], c, form) for left, c, form in group)
        for name, group in below.items():
            walk(host, f"{template}/{name}", group)

    for host in {h for h, _ in paths}:
        walk(host, "", [([s for s in f.split("/") if s], c, f) for (h, f), c in paths.items() if h == host])
    return named


def check_against_tree(pages, rules):
    """The rows of the filter, each explained by the tree above."""
    rows = url_filter.judge(pages, rules).collect()
    assert len(rows) == pages.count()
    forms, paths = [], {}
    for r in rows:
        form = "/".join("*" if re.search(url_filter.VARIABLE, s) else s for s in r["path"].split("/"))
        forms.append(form)
        known = paths.get((r["host"], form), (0, 0, 0))
        blocked = r["rule"] is not None and r["verdict"] == "block"
        paths[r["host"], form] = (known[0] + 1, known[1] + (r["rule"] is not None), known[2] + blocked)
    named, sums = brute_templates(paths), {}
    for (host, form), counts in paths.items():
        sums.setdefault((host, named[host, form]), []).append(counts)
    for r, form in zip(rows, forms):
        template = named[r["host"], form]
        pages_of, labelled, blocked = map(sum, zip(*sums[r["host"], template]))
        purity = (blocked + (pages_of - labelled + 4) / 2) / (pages_of + 4)
        assert r["template"] == template and r["purity"] == pytest.approx(purity)
        assert r["rule"] is not None or r["verdict"] == ("block" if r["purity"] >= 0.8 else "allow")
    return rows


def test_url_tree_on_pages(spark):
    """Labels reach pages without a rule."""
    rows = check_against_tree(table(spark, "/root/testdata/sf0.1", "pages"), url_filter.RULES)
    free = [r for r in rows if r["rule"] is None]
    assert any(r["purity"] > 0.5 for r in free) and any(r["purity"] < 0.5 for r in free)


def test_url_tree_blocks_pages_without_a_rule(spark):
    """Branches with the same pages below share their labels; another kind of branch, and one with other labels, do not."""
    rules = [("block", "h.com", f"/{name}/") for name in ("aa", "bb", "cc")] + [("allow", "h.com", "/ok/")]
    urls = [f"http://h.com/{name}/{kind}/{i}" for name in ("aa", "bb", "cc", "dd") for kind in ("x", "y") for i in range(20)]
    urls += [f"http://k.com/{name}/item/{i}" for name in ("aa", "bb") for i in range(20)] + ["http://h.com/dd/x/5"] * 3
    draw = random.Random(2)
    words = ["p", "q", "r", "long" * 5, "12", "", "ü", "v-1", "w w"]
    rows = urls + [f"http://m.com/{'/'.join(draw.choices(words, k=draw.randrange(7)))}" for _ in range(400)]
    rows += ["http://d.com/" + "/".join(["s"] * 3000), "http://d.com/" + "/".join(["s"] * 12 + ["t"] * 9), "http://d.com/" + "/".join(["s"] * 12), None, None]
    pages = spark.createDataFrame([(i if i % 9 else None, u) for i, u in enumerate(rows)], "page_id long, url string")
    rules += [("block", "m.com", "/p/q"), ("allow", "m.com", "/r")]
    got = check_against_tree(pages, rules)
    blocked = {r["path"].split("/")[1] for r in got if r["host"] == "h.com" and r["rule"] is None and r["verdict"] == "block"}
    assert blocked == {"dd"}
    assert {r["verdict"] for r in got if r["host"] == "k.com"} == {"allow"}
    assert max(len(r["template"]) for r in got) > 5000


# --- 8 and 10 --------------------------------------------------------------------------


def test_codes():
    rng = np.random.default_rng(0)
    for n in (0, 1, 511, 512, 513, 5000):
        ids = rng.integers(0, [1, 200, 70_000, 1 << 32][n % 4], n, dtype=np.uint64).astype(np.uint32)
        codes = token_codes.Codes(token_codes.pack(ids))
        assert (codes.all() == ids).all() and [codes[i] for i in range(0, n, 7)] == ids[::7].tolist()
        stored = token_codes.StoredCodes(pa.BufferReader(b"before" + token_codes.pack(ids) + b"behind"), 6)
        assert [stored[i] for i in range(0, n, 7)] == ids[::7].tolist()
    with pytest.raises(IndexError):
        codes[5000]


def test_token_files(spark, tokenizer, odd_docs, tmp_path):
    docs = odd_docs.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(table(spark, "/root/testdata/sf0.001", "documents").withColumns({"doc_id": F.col("doc_id") + 100, "score": F.lit(""), "mark": F.lit(""), "kept": F.lit("")}))
    token_codes.write(docs, f"{tmp_path}/codes", PATH)
    shards = token_codes.read_shards(spark, f"{tmp_path}/codes")
    got = sorted(rows_of(token_codes.read_documents(shards), "doc_id", "start", "n_tokens", "ids_crc32"))
    want, every = [], []
    for i, t in sorted(rows_of(docs, "doc_id", "text")):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, len(every), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        every += ids
    assert got == want
    at = [0, 5, len(every) // 2, len(every) - 1, len(every)]
    found = token_codes.read_tokens(shards, spark.createDataFrame([(p,) for p in at], "position long"))
    assert sorted(rows_of(found, "position", "token_id")) == [(p, every[p]) for p in at[:-1]]


def test_token_files_of_repeated_and_null_ids(spark, tokenizer, odd_docs, tmp_path):
    token_codes.write(odd_docs.repartition(3), f"{tmp_path}/codes", PATH)
    shards = token_codes.read_shards(spark, f"{tmp_path}/codes")
    got = rows_of(token_codes.read_documents(shards), "doc_id", "start", "n_tokens", "ids_crc32")
    want = []
    for i, t in rows_of(odd_docs, "doc_id", "text"):
        ids = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
        want.append((i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert sorted(((i, n, crc) for i, _, n, crc in got), key=str) == sorted(want, key=str)
    by_start = sorted(got, key=lambda r: r[1])
    assert [i for i, *_ in by_start] == sorted((i for i, *_ in got), key=lambda i: -1 if i is None else i)
    assert [s for _, s, *_ in by_start] == np.cumsum([0, *(n for _, _, n, _ in by_start)])[:-1].tolist()


@pytest.mark.parametrize("long_chars", [500, bpe.LONG_CHARS])
def test_bpe(spark, tokenizer, odd_docs, long_chars, monkeypatch):
    monkeypatch.setattr(bpe, "PART", min(bpe.PART, long_chars))
    coded = bpe.encode(odd_docs, PATH, decoded=True, long_chars=long_chars)
    got = sorted(rows_of(coded, "doc_id", "ids", "decoded"), key=str)
    want = []
    for i, t in rows_of(odd_docs, "doc_id", "text"):
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids
        want.append((i, ids, tokenizer.decode(ids, skip_special_tokens=False)))
    assert got == sorted(want, key=str)
    again = bpe.decode(coded.drop("decoded"), PATH)
    assert sorted(rows_of(again, "doc_id", "decoded"), key=str) == sorted([(i, d) for i, _, d in want], key=str)


def test_tree_concatenation(tokenizer):
    code, chance = bpe.Encoder(PATH, leaf=16), random.Random(1)
    for _ in range(500):
        letters = chance.choice(["ab", "the", "aeinst", "abcdefghijklmnopqrstuvwxyz", "!?*#", "aä'sß", "01a"])
        word = "".join(chance.choices(letters, k=chance.randint(0, 300)))
        assert code.long_word(word) == tokenizer.encode(word, add_special_tokens=False).ids


# --- 9 ---------------------------------------------------------------------------------


def cut_by_hand(rows, length=50):
    """(id, bytes, removed, spans, kept) of each row, window by window."""
    out, first = [], {}
    rows = [((1 << 63) - 1 if i is None else i, i, (t or "").encode()) for i, t in rows]
    for order, _, b in sorted(rows, key=lambda r: r[0]):
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], order)
    for order, i, b in rows:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < order:
                gone[p : p + length] = True
        edges = np.flatnonzero(np.diff(gone, prepend=False, append=False))
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), [tuple(e) for e in edges.reshape(-1, 2).tolist()], hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def check_cut(docs):
    kept = suffix_dedup.remove_repeats(docs).collect()
    got = [(r["doc_id"], r["n_bytes"], [tuple(s) for s in r["spans"]], hashlib.sha256(r["kept"]).hexdigest()) for r in kept]
    assert sorted(got, key=str) == cut_by_hand(rows_of(docs, "doc_id", "text"))


def test_repeats(spark, odd_docs):
    check_cut(odd_docs)


@pytest.mark.parametrize("batch_bytes", [3000, 40_000])
def test_repeats_over_many_batches(spark, monkeypatch, batch_bytes):
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", batch_bytes)
    check_cut(table(spark, "/root/testdata/sf0.001", "documents"))


def test_repeats_with_one_id_in_a_third_of_the_rows(spark, monkeypatch):
    """Rows of one id, and of none, fill several batches and still take nothing from each other."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 1500)
    some = random.Random(4)
    passages = ["".join(some.choices("abcdef ", k=some.randint(40, 90))) for _ in range(30)]
    ids = [7] * 60 + [None] * 60 + list(range(-30, 30)) + [-(1 << 62), (1 << 63) - 2]
    rows = [(i, "".join(some.choices(passages, k=some.randint(0, 4)))) for i in ids]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranged, _ = suffix_dedup._batches(docs.select(F.col("doc_id").alias("id"), F.coalesce("doc_id", F.lit((1 << 63) - 1)).alias("order"), "text"))
    parts = {i: {r["batch"] for r in ranged.filter(F.col("id").eqNullSafe(F.lit(i))).collect()} for i in (7, None)}
    assert all(len(p) > 2 and len({b >> suffix_dedup.PART_BITS for b in p}) == 1 for p in parts.values())
    check_cut(docs)


def test_repeats_of_an_anchor_in_every_row(spark, monkeypatch):
    """Different runs around one frequent string: their windows are dealt to all ranges."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 3000)
    some = random.Random(6)
    hot = "".join(some.choices("abcdefghij", k=45))
    rows = [(i, "".join(some.choices("kl", k=9)) + hot + "".join(some.choices("kl", k=9))) for i in range(400)]
    check_cut(spark.createDataFrame(rows, "doc_id long, text string"))


def test_marks_of_many_runs_differ():
    """As many different runs as one frequent passage has contexts; 32 bits would make some of them equal."""
    n = 300_000
    text = np.random.default_rng(9).integers(97, 123, (n, suffix_dedup.LENGTH), np.uint8)
    raw = np.concatenate([text.reshape(-1), np.zeros(64, np.uint8)])
    starts = np.arange(n) * suffix_dedup.LENGTH
    runs = suffix_dedup.Runs(raw, starts, starts + suffix_dedup.LENGTH)
    assert len(runs.first) == n == len(np.unique(runs.print))


# --- The pipeline ----------------------------------------------------------------------


def test_pipeline_stages(spark, tokenizer):
    folder = "/root/testdata/sf0.001"
    docs = table(spark, folder, "documents")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, spark.createDataFrame(stage(spark, docs, folder).toArrow())
        old, new = {r["doc_id"]: r for r in before.collect()}, docs.collect()
        if name != "encode":
            assert docs.columns == before.columns
        if name == "quality":
            labels = {r["doc_id"]: r["quality"] for r in table(spark, folder, "labels").collect()}
            kept = {r["doc_id"] for r in new}
            assert all(i in kept for i in old if labels.get(i) == 1)
        elif name == "near_duplicates":
            joined = ngram_join.join(before).filter("kept")
            assert sorted(r["doc_id"] for r in new) == sorted(r["doc_id"] for r in joined.collect())
        elif name == "repeats":
            want = {i: h for i, _, _, h in cut_by_hand([(i, r["text"]) for i, r in old.items()])}
            assert len(new) == len(old)
            whole = [r for r in new if hashlib.sha256(r["text"].encode()).hexdigest() == want[r["doc_id"]]]
            assert len(whole) > 0.9 * len(new)  # others lost the rest of a character cut in two
            assert all(r["n_chars"] == len(r["text"]) and r["source"] == old[r["doc_id"]]["source"] for r in new)
        elif name == "mix":
            times = {r["doc_id"]: r["repeats"] for r in mixing.mix(before).collect()}
            count = {i: sum(r["doc_id"] == i for r in new) for i in old}
            assert count == times
        else:
            for r in new[:50]:
                assert r["ids"] == tokenizer.encode(old[r["doc_id"]]["text"], add_special_tokens=False).ids


def test_pipeline_of_odd_rows(spark, odd_docs):
    docs = odd_docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, "/root/testdata/sf0.001").toArrow())
    assert docs.count() > 0
