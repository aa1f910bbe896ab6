"""Near-duplicate vectors by NN-descent.

Vectors are compared when their labels are equal and not null. Equal vectors of a
label are one node. A first neighbour graph comes from random projections: nodes
with the same signs are compared, large groups along one projection. The graph is
then refined: the neighbours of a node, forward and backward, are compared with
each other, and every node keeps its best inside its component and its best outside.
Refinement ends when hardly a neighbour changes and no components merge.

Every pair met at the threshold or above is a link, whatever the lists keep: a task
returns its links as spanning edges, and these form the components. A list of
neighbours outside the component thus never fills with links. Inside each component
all pairs are compared exactly, in blocks.

The number of projections follows the number of signs, so that a pair at the
threshold shares a group with probability ``FOUND`` in any label's size. An audit
draws nodes that fresh projections have links for, of every group size, compares
them with all others, and takes the mean share of found links per node. The fresh
links always join the result; while a group size is below ``recall``, refinement
goes on from them, and after ``ATTEMPTS`` the operator fails.

Vectors that are null, empty, of length zero, or hold null or non-finite
components, and vectors without a label, link with nothing. Vectors of different
lengths do not link. Repeated rows are copies. A null id is kept, links, and is
never a component's id unless all ids are null. Extra columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from fleetscope.llm.graph import compare_members, components
from fleetscope.session import cut_lineage

THRESHOLD = 0.93
#: Neighbours below this cosine lead to none at the threshold and are not kept.
EXPLORE = 0.6
NEIGHBOURS = 8
#: Fewest projections, and the probability that one of them at least brings a pair at the threshold together.
TABLES = 12
FOUND = 0.99
#: Rows with their vectors that a refining task holds at most, about, and the fewest packs they are cut into.
PACK_ROWS = 20_000
PACKS = 64
#: Nodes with the same signs that are compared all with all.
WINDOW = 256
#: Nodes audited of each group size, about, and those compared at once.
AUDIT = 200
AUDIT_BLOCK = 500
RECALL = 0.95
ATTEMPTS = 6

_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("cosine", pa.float64())])
_EDGES_DDL = "a long, b long, cosine double"


def unit(column) -> np.ndarray:
    """Vectors of one length as rows of length 1, in double precision."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _best(ids: np.ndarray, x: np.ndarray, threshold: float, known: np.ndarray, out: list, joined: list) -> None:
    """Adds for each row its nearest others at EXPLORE or above, and all links of the rows as spanning edges.

    ``known`` are the components so far. NEIGHBOURS rows of the own component and as many of others are
    kept, so links inside a dense component crowd out no others.
    """
    near = x @ x.T
    np.fill_diagonal(near, -2)
    match = near >= threshold - 1e-9
    label = np.unique(known, return_inverse=True)[1].reshape(-1)
    same = label[:, None] == label
    if (match & ~same).any():
        match |= same
        label = np.arange(len(ids))
        while True:
            low = np.minimum(label, np.where(match, label[None, :], len(ids)).min(1))
            low = low[low]
            if (low == label).all():
                break
            label = low
        # Each row with the first of its component: as connected as all its links.
        new = np.flatnonzero(known != known[label])
        joined.append((ids[new], ids[label[new]]))
        same = label[:, None] == label
    for side in (same, ~same):
        value = np.where(side, near, -2)
        part = np.tile(np.arange(len(ids)), (len(ids), 1))
        if len(ids) > NEIGHBOURS:
            part = np.argpartition(value, len(ids) - NEIGHBOURS, axis=1)[:, -NEIGHBOURS:]
        value = np.take_along_axis(value, part, 1)
        row, at = np.nonzero(value >= EXPLORE)
        out.append((ids[row], ids[part[row, at]], value[row, at]))


def _edges(found: list, joined: list) -> pa.Table:
    """Edges with their cosine, and without one those that only say that their ends are connected by links."""
    joined = [(a, b, np.full(len(a), np.nan)) for a, b in joined]
    parts = []
    for kind in (found, joined):
        if not kind:
            continue
        a, b, cosine = map(np.concatenate, zip(*kind))
        # One row for an edge, however often the task met it.
        order = np.lexsort((b, a))
        a, b, cosine = a[order], b[order], cosine[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        columns = [pa.array(a[new]), pa.array(b[new]), pa.array(cosine[new], from_pandas=True)]
        parts.append(pa.Table.from_arrays(columns, schema=_EDGES))
    return pa.concat_tables(parts) if parts else _EDGES.empty_table()


def _groups(*columns: np.ndarray) -> list[np.ndarray]:
    """Rows with the same values, group by group."""
    order = np.lexsort(columns)
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[order][1:] != c[order][:-1]
    return np.split(order, np.flatnonzero(new)[1:]) if len(order) else []


def _packs(rows: int) -> int:
    return max(PACKS, -(-rows // PACK_ROWS))


def _tables(bits: int, threshold: float) -> int:
    """Projections of so many signs after which a pair at the threshold has shared all signs with probability FOUND."""
    equal = (1 - math.acos(max(-1.0, min(1.0, threshold))) / math.pi) ** bits
    return TABLES if equal >= FOUND else max(TABLES, math.ceil(math.log(1 - FOUND) / math.log1p(-equal)))


def _first_graph(nodes: DataFrame, attempt: int, threshold: float) -> DataFrame:
    """Edges between nodes with equal signs in one of the random projections of the attempt.

    The number of signs follows the size of the label, so a group has about 32 nodes.
    """
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("_n"))
    bits = F.greatest(F.lit(0), F.round(F.log2(F.col("_n") / 32))).cast("int")
    sized = nodes.join(sizes, ["label", "dim"]).select("id", "label", "dim", "v", bits.alias("bits"))
    schema = pa.schema([("table", pa.int32()), ("label", pa.int64()), ("dim", pa.int32()), ("bucket", pa.int64()), ("id", pa.int64()), ("along", pa.float64()), ("v", pa.list_(pa.float64()))])

    def project(batches):
        for batch in batches:
            dims, bits = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            for dim in np.unique(dims).tolist():
                rows = np.flatnonzero(dims == dim)
                part = batch.take(pa.array(rows))
                x = unit(part.column(3))
                own, tables = bits[rows], np.zeros(len(rows), np.int32)
                for n in np.unique(own).tolist():
                    tables[own == n] = _tables(n, threshold)
                most = int(own.max())
                for t in range(tables.max()):
                    some = np.flatnonzero(tables > t)
                    there = part.take(pa.array(some))
                    # The last column orders the nodes of a group.
                    plane = np.random.default_rng((attempt, t, dim)).standard_normal((dim, 64))
                    y = x[some] @ plane[:, [*range(most), 63]]
                    sign = (y[:, :most] > 0) & (np.arange(most) < own[some][:, None])
                    bucket = sign @ (1 << np.arange(most, dtype=np.int64)) if most else np.zeros(len(some), np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(some), t, np.int32)), there.column(1), there.column(2), pa.array(bucket),
                         there.column(0), pa.array(y[:, most]), there.column(3)],
                        schema=schema,
                    )

    def search(key, rows):
        ids, along = rows.column("id").to_numpy(), rows.column("along").to_numpy()
        found, joined = [], []
        for group in _groups(rows.column("bucket").to_numpy(), rows.column("dim").to_numpy(), rows.column("label").to_numpy()):
            group = group[np.argsort(along[group], kind="stable")]
            x = unit(rows.column("v").take(pa.array(group)))
            for k in range(0, max(1, len(group) - WINDOW // 2), WINDOW // 2):
                some = ids[group[k : k + WINDOW]]
                _best(some, x[k : k + WINDOW], threshold, some, found, joined)
        return _edges(found, joined)

    ddl = "table int, label long, dim int, bucket long, id long, along double, v array<double>"
    # A task takes many small groups; the groups of one label and table are spread over tasks by their signs.
    pack = F.pmod(F.xxhash64("table", "label", "bucket"), F.lit(_packs(nodes.count())))
    spread = sized.mapInArrow(project, ddl).withColumn("_pack", pack)
    return spread.groupBy("table", "_pack").applyInArrow(search, _EDGES_DDL)


def _lists(edges: DataFrame, found: DataFrame) -> DataFrame:
    """The NEIGHBOURS best neighbours of every node inside its component ``found`` so far, and as many outside."""
    edges = edges.filter("cosine is not null").groupBy("a", "b").agg(F.max("cosine").alias("cosine"))
    for end in ("a", "b"):
        edges = edges.join(found.select(F.col("id").alias(end), F.col("component").alias(f"_{end}")), end, "left")
    outside = F.coalesce("_a", "a") != F.coalesce("_b", "b")
    return _nearest(edges.select("a", "b", "cosine", outside.alias("outside")))


def _nearest(edges: DataFrame) -> DataFrame:
    order = Window.partitionBy("a", "outside").orderBy(F.desc("cosine"), "b")
    return edges.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= NEIGHBOURS).drop("_rank")


def _neighbours_of_neighbours(lists: DataFrame, nodes: DataFrame, found: DataFrame, threshold: float) -> DataFrame:
    """Edges between the neighbours of each node, forward and backward."""
    back = _nearest(lists.select(F.col("b").alias("a"), F.col("a").alias("b"), "cosine", "outside"))
    both = lists.select("a", "b").unionByName(back.select("a", "b"))
    both = both.unionByName(both.select("a", F.col("a").alias("b"))).distinct()
    both = cut_lineage(both)
    packs = _packs(both.count())
    known = nodes.select("id", "v").join(found, "id", "left")
    rows = both.join(known.select(F.col("id").alias("b"), "v", F.coalesce("component", "id").alias("known")), "b")

    def run(key, rows):
        at, ids, known = (rows.column(c).to_numpy() for c in ("a", "b", "known"))
        near, joined = [], []
        for group in _groups(at):
            _best(ids[group], unit(rows.column("v").take(pa.array(group))), threshold, known[group], near, joined)
        return _edges(near, joined)

    return rows.groupBy(F.pmod(F.xxhash64("a"), F.lit(packs)).alias("_pack")).applyInArrow(run, _EDGES_DDL)


def _cosines(threshold: float):
    def linked(table: pa.Table) -> np.ndarray:
        x = unit(table.column("v"))
        return x @ x.T >= threshold

    return linked


def _joined(edges: DataFrame) -> DataFrame:
    return edges.filter("cosine is null").select("a", "b")


def _refined(nodes: DataFrame, edges: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """The edges after refinement, and the components of all links found on the way."""
    joined = cut_lineage(_joined(edges).distinct())
    found = cut_lineage(components(joined))
    lists = cut_lineage(_lists(edges, found))
    while True:
        while True:
            before = lists.agg(F.count(F.lit(1)), F.sum("cosine")).first()
            more = cut_lineage(_neighbours_of_neighbours(lists, nodes, found, threshold))
            joined = joined.unionByName(_joined(more))
            lists = cut_lineage(_lists(lists.select("a", "b", "cosine").unionByName(more), found))
            after = lists.agg(F.count(F.lit(1)), F.sum("cosine")).first()
            if not after[0] or (after[0] == before[0] and after[1] - before[1] <= 1e-3 * after[1]):
                break
        joined = cut_lineage(joined.distinct())
        merged = cut_lineage(components(joined))
        # Every node of a component but one stands for a merge.
        merges = [c.agg(F.count(F.lit(1)) - F.countDistinct("component")).first()[0] for c in (found, merged)]
        found = merged
        if merges[0] == merges[1]:
            return lists.select("a", "b", "cosine").unionByName(joined.withColumn("cosine", F.lit(None).cast("double"))), found
        lists = cut_lineage(_lists(lists.select("a", "b", "cosine"), found))


def audit(nodes: DataFrame, found: DataFrame, merged: DataFrame, fresh: DataFrame, threshold: float, sample: int = AUDIT) -> float:
    """The least recall of a group size: the mean over audited nodes of the share of their true links inside ``found``.

    Audited are about ``sample`` nodes of each group size (powers of two) with links in ``fresh``, which
    ``found`` (id, component) does not know, and as many of all nodes. Sizes are those of the components
    ``merged`` of both. The sample's vectors are broadcast, and every node is compared with all of them.
    """
    sizes = merged.groupBy("component").agg(F.floor(F.log2(F.count(F.lit(1)))).cast("int").alias("size"))
    ends = fresh.select(F.col("a").alias("id")).unionByName(fresh.select(F.col("b").alias("id"))).distinct()
    ends = ends.join(merged, "id").join(sizes, "component").select("id", "size")
    ends = ends.unionByName(nodes.select("id", F.lit(-1).alias("size")))
    counts = {r["size"]: r["n"] for r in ends.groupBy("size").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = F.lit(0.0)
    for size, n in counts.items():
        share = F.when(F.col("size") == size, F.lit(sample / n)).otherwise(share)
    drawn = ends.filter(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1 << 30)) / F.lit(float(1 << 30)) < share)
    known = nodes.join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    drawn = drawn.groupBy("id").agg(F.collect_set("size").alias("sizes")).join(known, "id")
    chosen = drawn.select("id", "sizes", "label", "dim", "v", "component").collect()  # some sample a size
    groups: dict = {}
    for r in chosen:
        groups.setdefault((r["label"], r["dim"]), []).append(r)
    blocks = [(k, v[i : i + AUDIT_BLOCK]) for k, v in groups.items() for i in range(0, len(v), AUDIT_BLOCK)]
    held = nodes.sparkSession.sparkContext.broadcast([
        (*k, np.array([r["id"] for r in v]), np.array([r["component"] for r in v]), unit(pa.array([r["v"] for r in v])))
        for k, v in blocks
    ])
    schema = pa.schema([("id", pa.int64()), ("true", pa.int64()), ("found", pa.int64())])

    def run(batches):
        for batch in batches:
            ids, labels, dims, weight, component = (batch.column(i).to_numpy() for i in (0, 1, 2, 4, 5))
            for label, dim, own, inside, x in held.value:
                rows = np.flatnonzero((labels == label) & (dims == dim))
                if len(rows):
                    near = x @ unit(batch.column(3).take(pa.array(rows))).T >= threshold
                    near &= own[:, None] != ids[rows]
                    both = near & (inside[:, None] == component[rows])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own), pa.array(near @ weight[rows]), pa.array(both @ weight[rows])], schema=schema
                    )

    compared = known.select("id", "label", "dim", "v", "weight", "component").mapInArrow(run, "id long, true long, found long")
    compared = compared.groupBy("id").agg(F.sum("true").alias("true"), F.sum("found").alias("found"))
    shares = {r["id"]: r["found"] / r["true"] for r in compared.filter(F.col("true") > 0).collect()}
    by_size: dict[int, list[float]] = {}
    for r in chosen:
        for size in r["sizes"] if r["id"] in shares else ():
            by_size.setdefault(size, []).append(shares[r["id"]])
    return min((sum(v) / len(v) for v in by_size.values()), default=1.0)


def near_duplicates(
    vectors: DataFrame,
    key: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """Per vector ``key``, n_links, component_id and kept (component_id is its own id)."""
    x = F.transform(F.col(embedding), lambda v: v.cast("double"))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), x.alias("v"))
    finite = F.forall("v", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    usable = F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda v: v != 0)
    rows = cut_lineage(rows.withColumn("ok", F.coalesce(usable, F.lit(False))))
    good = rows.filter("ok").withColumn("node", F.xxhash64("label", "v"))
    nodes = good.groupBy("node", "label", "v").agg(F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("low"))
    nodes = cut_lineage(nodes.select(F.col("node").alias("id"), "label", F.size("v").alias("dim"), "v", "weight", "low"))
    edges, attempt = cut_lineage(_first_graph(nodes, 0, threshold)), 0
    while True:
        edges, found = _refined(nodes, edges, threshold)
        attempt += 1
        fresh = cut_lineage(_first_graph(nodes, attempt, threshold))
        merged = cut_lineage(components(_joined(edges).unionByName(_joined(fresh))))
        reached = audit(nodes, found, merged, _joined(fresh), threshold)
        if reached >= recall:
            break
        if attempt == ATTEMPTS:
            raise RuntimeError(f"recall of {reached:.3f} instead of {recall} after {attempt} attempts")
        edges = edges.unionByName(fresh)
    members = nodes.join(merged, "id").select("component", F.col("id").alias("node"), "weight", "v")
    compared = cut_lineage(compare_members(members, _cosines(threshold), ["v"]))
    links = compared.groupBy(F.col("node").alias("id")).agg(F.sum("links").alias("links"))
    joined = components(compared.filter("links > 0").select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.select("id", "label", "v", "weight", "low").join(links, "id", "left").join(joined, "id", "left")
    known = known.withColumn("component", F.coalesce("component", "id"))
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "component").select(
        F.col("id").alias("node"), "component_id", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    linked = good.select("vec_id", "node").join(known, "node").select("vec_id", "n_links", "component_id")
    alone = rows.filter(~F.col("ok")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = linked.unionByName(alone)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))).withColumnRenamed("vec_id", key)
