"""Embedding near-duplicates by NN-descent.

Vectors of one label (and length) with equal components form a class.  A
neighbour graph over the classes starts from random-hyperplane cells.  Each round
compares the neighbours of every node that gained one with each other and keeps
the best of each list, until few lists gain.  Edges below the cosine of twice the
threshold's angle are not kept: two linked vectors see every vector that links
with one of them above it.

A list is saturated when it is full and its last entry still links.  Saturated
lists are enlarged from ``LIST`` to ``LONG`` and descend further.  Links with an
end whose list is not saturated are read off the lists.  Links between vectors
that saturate ``LONG`` too are counted exactly: clusters of edges say which of
them stand in one block, and every two blocks of a label are compared unless the
angle between their centers exceeds both radii and the threshold's angle
together.  Pairs of blocks go to different tasks, which return counts and local
roots, never pairs.

The vectors whose id is divisible by ``EVERY`` are held against all vectors, in
blocks, to audit the recall.  Where they have links and fewer than
``LEAST_RECALL`` of them were found, all vectors go through the exact way.  The
recall is returned (null: the audited vectors have no links, nothing measured).

Cosines are sums in double precision of unit vectors; within 1e-9 of the
threshold the sum is taken in component order, so that every task judges alike.

Defined cases: a vector that is null, empty, zero or holds a null or non-finite
component, or whose label is null, has no links and is its own component; equal
vectors link with each other; repeated rows are separate vectors; a null id
never becomes a component while another id is there; an empty table gives an
empty result; other columns, whatever their names, are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import components, read, written
from millrace.llm.near_duplicates import _roots, grouped

THRESHOLD = 0.93
LIST, LONG, CELL, BLOCK = 10, 40, 128, 400
#: Hyperplanes at most, and the chance that a pair at the threshold shares a first cell.
BITS, MEET = 24, 0.9995
#: Clusters from so many members on have blocks of their own; rounding of angles that no bound may rely on.
OWN_BLOCK, SLACK = 32, 1e-6
#: Rounds at most, and the share of lists that may still gain when a descent ends; the audit judges what is left.
ROUNDS, SETTLED = 12, 0.002
LEAST_RECALL, EVERY = 0.99, 50


def unit(rows: list) -> np.ndarray:
    return np.array([np.frombuffer(b, np.float64) for b in rows])


def cosines(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Cosines of unit vectors; those next to the threshold summed in component order."""
    s = x @ y.T
    first, second = np.nonzero(np.abs(s - threshold) < 1e-9)
    for i, j in zip(first, second, strict=True):
        s[i, j] = sum((x[i] * y[j]).tolist())
    return s


def planes(dim: int, table: int, bits: int) -> np.ndarray:
    return np.random.default_rng((dim, table)).normal(size=(BITS, dim))[:bits]


def _prepared(batches):
    """(vec_id, label, dim, unit vector, code by the hyperplanes of the first table); null vector where nothing can link."""
    for batch in batches:
        ids, labels, vectors = (batch.column(i) for i in range(3))
        dims, units, codes = [], [], []
        known: dict[int, np.ndarray] = {}
        for v, label in zip(vectors.to_pylist(), labels.to_pylist(), strict=True):
            x = None
            if v and label is not None and None not in v:
                x = np.array(v, np.float64)
                peak = np.abs(x).max()
                x = x / peak if np.isfinite(peak) and peak > 0 else None  # so that squares neither overflow nor vanish
            if x is None:
                dims.append(None), units.append(None), codes.append(None)
                continue
            x = x / np.sqrt(x @ x)
            if len(x) not in known:
                known[len(x)] = planes(len(x), 0, BITS)
            dims.append(len(x))
            units.append(x.tobytes())
            codes.append(int((known[len(x)] @ x > 0) @ (1 << np.arange(BITS - 1, -1, -1))))
        yield pa.record_batch([ids, labels, pa.array(dims, pa.int32()), pa.array(units, pa.binary()), pa.array(codes, pa.int64())], names=["vec_id", "label", "dim", "unit", "code"])


def _cell_codes(batches):
    """(node, space, cell): the cell of each vector in each of its label's ``tables``, by ``bits`` hyperplanes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        node, space, dim, bits, tables = (batch.column(c).to_numpy() for c in ("node", "space", "dim", "bits", "tables"))
        units = batch.column("unit").to_pylist()
        kinds = np.stack([dim, bits, tables], 1)
        for d, b, most in np.unique(kinds, axis=0).tolist():
            at = np.flatnonzero((kinds == (d, b, most)).all(1))
            x = unit([units[i] for i in at])
            for t in range(most):
                code = (x @ planes(d, t, b).T > 0) @ (1 << np.arange(b, dtype=np.int64))
                yield pa.record_batch([pa.array(node[at]), pa.array(space[at]), pa.array(np.full(len(at), t, np.int32)), pa.array(code)], names=["node", "space", "table", "code"])


EDGE = "u long, v long, sim double"


def _edges(u, v, sim) -> pa.RecordBatch:
    return pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64()), pa.array(sim, pa.float64())], names=["u", "v", "sim"])


def least_edge(threshold: float) -> float:
    """Cosine of twice the threshold's angle."""
    return float(2 * threshold * threshold - 1) if threshold > 0 else -1.0


def _best(ids: np.ndarray, x: np.ndarray, keep: int, floors: np.ndarray, threshold: float) -> pa.RecordBatch:
    """For each row of ``x`` its ``keep`` nearest others, as directed edges, where better than its floor."""
    s = cosines(x, x, threshold)
    np.fill_diagonal(s, -2)
    k = min(keep, len(ids) - 1)
    near = np.argpartition(-s, k - 1, axis=1)[:, :k]
    sims = np.take_along_axis(s, near, 1)
    row, col = np.nonzero((ids[near] != ids[:, None]) & (sims > floors[:, None] + 1e-12))
    return _edges(ids[row], ids[near[row, col]], sims[row, col])


def _compared(keep: int, threshold: float):
    """The best edges among the members of each part (node, floor, unit)."""

    def run(batches):
        for group in grouped(batches, "part"):
            if group.num_rows > 1:
                yield _best(group.column("node").to_numpy(), unit(group.column("unit").to_pylist()), keep, group.column("floor").to_numpy(), threshold)

    return run


def _in_blocks(threshold: float):
    def run(batches):
        for group in grouped(batches, "part"):
            node, side, weight, x = group.column("node").to_numpy(), group.column("side").to_numpy(), group.column("size").to_numpy(), unit(group.column("unit").to_pylist())
            left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if len(right):
                first, second = np.nonzero(cosines(x[left], x[right], threshold) >= threshold)
                first, second = left[first], right[second]
            else:
                first, second = np.nonzero(np.triu(cosines(x, x, threshold) >= threshold, 1))
            if not len(first):
                continue
            m = len(node)
            links = np.bincount(first, weight[second], m) + np.bincount(second, weight[first], m)
            at = np.flatnonzero(links)
            yield pa.record_batch([pa.array(node[at]), pa.array(node[_roots(m, first, second)[at]]), pa.array(links[at].astype(np.int64))], names=["node", "root", "links"])

    return run


def _centers(batches):
    """(space, block, center, radius): each block's center and the largest angle of a member to it."""
    for group in grouped(batches, "part"):
        x = unit(group.column("unit").to_pylist())
        center = x.mean(0)
        norm = np.sqrt(center @ center)
        center = center / norm if norm > 1e-9 else x[0]
        radius = float(np.arccos(np.clip(x @ center, -1, 1)).max())
        yield pa.record_batch([group.column("space").combine_chunks()[:1], group.column("part").combine_chunks()[:1], pa.array([center.tobytes()], pa.binary()), pa.array([radius])], names=["space", "block", "center", "radius"])


def _near_blocks(threshold: float):
    """(a, b): pairs of blocks of one space, and each block with itself, that can hold a link by their centers and radii."""
    reach = float(np.arccos(np.clip(threshold, -1, 1))) + SLACK

    def run(batches):
        for group in grouped(batches, "part"):
            block, center, radius = group.column("block").to_numpy(), unit(group.column("center").to_pylist()), group.column("radius").to_numpy()
            for at in range(0, len(block), 512):
                angle = np.arccos(np.clip(center[at : at + 512] @ center.T, -1, 1))
                near = np.triu(angle <= radius[at : at + 512, None] + radius[None, :] + reach, at)
                near[np.arange(len(near)), np.arange(at, at + len(near))] = True
                first, second = np.nonzero(near)
                yield pa.record_batch([pa.array(block[at + first]), pa.array(block[second])], names=["a", "b"])

    return run


def _dealt(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return df.select(F.col(key).alias("part"), *columns).repartition("part").sortWithinPartitions("part")


def _cells(nodes: DataFrame, threshold: float) -> DataFrame:
    """First edges: the nearest in blocks of random-hyperplane cells of about ``CELL`` vectors."""
    sizes = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.floor(F.log2(F.col("n") / CELL)))).cast("int")
    # so many tables that two vectors right at the threshold share a cell of one with chance MEET
    together = F.pow(F.lit(1 - np.arccos(threshold) / np.pi), F.col("bits"))
    tables = F.when(F.col("bits") == 0, 1).otherwise(F.ceil(F.log(F.lit(1 - MEET)) / F.log(1 - together))).cast("int")
    rows = nodes.join(sizes.withColumn("bits", bits).withColumn("tables", tables), ["label", "dim"])
    rows = rows.select("node", F.xxhash64("label", "dim").alias("space"), "dim", "bits", "tables", "unit").mapInArrow(_cell_codes, "node long, space long, table int, code long")
    rows = rows.select("node", F.xxhash64("space", "table", "code").alias("cell"))
    counts = rows.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    rows = rows.join(counts, "cell")
    block = F.pmod(F.xxhash64("node", "cell"), F.ceil(F.col("members") / BLOCK))
    rows = rows.select("node", F.xxhash64("cell", block).alias("cut")).join(nodes.select("node", "unit"), "node").withColumn("floor", F.lit(least_edge(threshold)))
    return _dealt(rows, "cut", ["node", "unit", "floor"]).mapInArrow(_compared(LIST, threshold), EDGE)


def _lists(edges: DataFrame) -> DataFrame:
    """(u, v, sim, age, length): the best edges of each node, as many as its list is long."""
    order = Window.partitionBy("u").orderBy(F.desc("sim"), "v")
    edges = edges.groupBy("u", "v").agg(F.max("sim").alias("sim"), F.min("age").alias("age"), F.max("length").alias("length"))
    edges = edges.withColumn("length", F.max("length").over(Window.partitionBy("u"))).withColumn("rank", F.row_number().over(order))
    return edges.where(F.col("rank") <= F.col("length")).drop("rank")


def _state(lists: DataFrame, threshold: float) -> DataFrame:
    """(u, floor, saturated): the cosine that a new edge of ``u`` must exceed, and whether its list is full of links."""
    full = F.count(F.lit(1)) >= F.max("length")
    floor = F.when(full, F.min("sim")).otherwise(F.lit(least_edge(threshold)))
    return lists.groupBy("u").agg(floor.alias("floor"), (full & (F.min("sim") >= threshold)).alias("saturated"))


def _descend(nodes: DataFrame, lists: DataFrame, age: int, keep: int, threshold: float) -> DataFrame:
    """A round: neighbours and reverse neighbours of each node with an edge of ``age``, compared with each other."""
    fresh = lists.where(F.col("age") == age)
    active = fresh.select("u").union(fresh.select(F.col("v").alias("u"))).distinct()
    back = lists.select(F.col("v").alias("u"), F.col("u").alias("v"))
    some = Window.partitionBy("u").orderBy(F.xxhash64("u", "v"), "v")
    back = back.withColumn("r", F.row_number().over(some)).where(F.col("r") <= keep).select("u", "v")  # a hub's other followers meet through their own lists
    around = lists.select("u", "v").union(back).union(active.select("u", F.col("u").alias("v"))).distinct().join(active, "u", "left_semi")
    members = nodes.join(_state(lists, threshold).select(F.col("u").alias("node"), "floor"), "node", "left").select("node", "unit", F.coalesce("floor", F.lit(least_edge(threshold))).alias("floor"))
    met = around.join(members, F.col("v") == F.col("node")).select("u", "node", "unit", "floor")
    return _dealt(met, "u", ["node", "unit", "floor"]).mapInArrow(_compared(keep, threshold), EDGE)


def neighbours(nodes: DataFrame, threshold: float) -> DataFrame:
    """Neighbour lists (u, v, sim, age, length) after descending, saturated ones enlarged."""
    total = nodes.count()
    lists = written(_lists(_cells(nodes, threshold).withColumn("age", F.lit(0)).withColumn("length", F.lit(LIST))), "neighbour-lists")
    age = 0
    for length in (LIST, LONG):
        if length > LIST:
            full = _state(lists, threshold).where("saturated").select("u", F.lit(True).alias("grows"))
            if full.isEmpty():
                break
            lists = lists.join(full, "u", "left").select("u", "v", "sim", F.when(F.col("grows"), age).otherwise(F.col("age") - 1).alias("age"), F.when(F.col("grows"), length).otherwise(F.col("length")).alias("length"))
            lists = written(lists, "neighbour-lists")
        for _ in range(ROUNDS):
            new = _descend(nodes, lists, age, length, threshold).withColumn("age", F.lit(age + 1)).withColumn("length", F.lit(LIST))
            age += 1
            lists = written(_lists(lists.union(new)), "neighbour-lists")
            # gains of lists that are full of links do not count: what they miss is counted exactly
            gained = lists.where(F.col("age") == age).join(_state(lists, threshold).where("NOT saturated"), "u", "left_semi")
            if gained.count() <= SETTLED * total:
                break
    return lists


def _blocks(nodes: DataFrame, clusters: DataFrame) -> DataFrame:
    """(node, space, block, size, unit): all nodes, dealt into blocks of about ``BLOCK`` of one label and length, near ones together."""
    own = clusters.groupBy("component").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") >= OWN_BLOCK)
    own = clusters.join(own, "component").select("node", "component")
    spaces = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    bits = F.least(F.lit(BITS), F.greatest(F.lit(0), F.floor(F.log2(F.col("n") / BLOCK)))).cast("int")
    rows = nodes.join(spaces, ["label", "dim"]).withColumn("bits", bits).join(own, "node", "left")
    key = F.when(F.col("component").isNotNull(), F.xxhash64(F.lit(1), "component")).otherwise(F.xxhash64(F.lit(0), F.expr(f"shiftrightunsigned(code, {BITS} - bits)")))
    rows = rows.select("node", "size", "unit", F.xxhash64("label", "dim").alias("space"), key.alias("key"))
    counts = rows.groupBy("space", "key").agg(F.count(F.lit(1)).alias("members"))
    rows = rows.join(counts, ["space", "key"])
    block = F.xxhash64("space", "key", F.pmod(F.xxhash64("node"), F.ceil(F.col("members") / BLOCK)))
    return written(rows.select("node", "space", block.alias("block"), "size", "unit"), "vector-blocks")


def _completed(nodes: DataFrame, clusters: DataFrame, threshold: float) -> DataFrame:
    """(node, root, links) of all links: every pair of blocks that can hold one is compared exactly."""
    rows = _blocks(nodes, clusters)
    centers = _dealt(rows, "block", ["space", "unit"]).mapInArrow(_centers, "space long, block long, center binary, radius double")
    pairs = _dealt(centers, "space", ["block", "center", "radius"]).mapInArrow(_near_blocks(threshold), "a long, b long")
    sides = F.when(F.col("a") == F.col("b"), F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("block")))).otherwise(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("block")), F.struct(F.lit(1).alias("side"), F.col("b").alias("block"))))
    met = written(pairs.select(F.xxhash64("a", "b").alias("cut"), F.inline(sides)), "block-pairs")
    met = met.join(rows, "block").select("cut", "side", "node", "size", "unit")
    return written(_dealt(met, "cut", ["side", "node", "size", "unit"]).mapInArrow(_in_blocks(threshold), "node long, root long, links long"), "vector-links")


def _read_off(nodes: DataFrame, lists: DataFrame, dense: DataFrame, threshold: float) -> DataFrame:
    """(node, root, links) of the links in ``lists`` but those with both ends in ``dense`` (column ``node``)."""
    pairs = lists.where(F.col("sim") >= threshold).select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    for end in ("a", "b"):
        pairs = pairs.join(dense.select(F.col("node").alias(end), F.lit(True).alias(f"dense_{end}")), end, "left")
    pairs = pairs.where("dense_a IS NULL OR dense_b IS NULL").select("a", "b")
    sizes = nodes.select("node", "size")
    sized = pairs.join(sizes.select(F.col("node").alias("a"), F.col("size").alias("of_a")), "a").join(sizes.select(F.col("node").alias("b"), F.col("size").alias("of_b")), "b")
    ends = F.array(F.struct(F.col("a").alias("node"), F.col("a").alias("root"), F.col("of_b").alias("links")), F.struct(F.col("b").alias("node"), F.col("a").alias("root"), F.col("of_a").alias("links")))
    return written(sized.select(F.inline(ends)), "list-links")


def _true_links(threshold: float):
    def run(batches):
        for group in grouped(batches, "part"):
            node, side, size, x = group.column("node").to_numpy(), group.column("side").to_numpy(), group.column("size").to_numpy(), unit(group.column("unit").to_pylist())
            ask, all_ = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
            if len(ask) and len(all_):
                hit = (cosines(x[ask], x[all_], threshold) >= threshold) & (node[ask][:, None] != node[all_][None, :])
                yield pa.record_batch([pa.array(node[ask]), pa.array((hit @ size[all_]).astype(np.int64))], names=["node", "true_links"])

    return run


def audit(nodes: DataFrame, found: DataFrame, threshold: float) -> float | None:
    """Share of the links of the ``asked`` classes, by brute force in blocks over all classes of their label, that ``found`` (node, links) has; None without such links."""
    counts = nodes.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("asked").cast("int")).alias("q")).where("q > 0")
    counts = counts.select("label", "dim", F.ceil(F.col("n") / 4096).alias("blocks"), F.ceil(F.col("q") / 1024).alias("shares"))
    rows = nodes.join(counts, ["label", "dim"]).select(F.xxhash64("label", "dim").alias("space"), "node", "size", "unit", "asked", "blocks", "shares")
    every = rows.select("space", F.pmod(F.xxhash64("node"), F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("shares") - 1)).alias("share"), F.lit(1).alias("side"), "node", "size", "unit")
    ask = rows.where("asked").select("space", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), F.pmod(F.xxhash64("node"), F.col("shares")).alias("share"), F.lit(0).alias("side"), "node", "size", "unit")
    both = ask.union(every).withColumn("cut", F.xxhash64("space", "block", "share"))
    true = _dealt(both, "cut", ["node", "side", "size", "unit"]).mapInArrow(_true_links(threshold), "node long, true_links long").groupBy("node").agg(F.sum("true_links").alias("true_links"))
    sums = true.join(found.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").agg(F.sum("true_links").alias("t"), F.sum(F.coalesce("links", F.lit(0))).alias("f")).first()
    return sums["f"] / sums["t"] if sums["t"] else None


def link(vectors: DataFrame, threshold: float = THRESHOLD, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(key, n_links, component_id, kept, recall), one row for each row of ``vectors``."""
    names = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("embedding"))
    rows = written(names.mapInArrow(_prepared, "vec_id long, label string, dim int, unit binary, code long"), "vector-rows")
    able = rows.where("unit IS NOT NULL")
    asked = F.coalesce(F.max(F.col("vec_id") % EVERY == 0), F.lit(False)).alias("asked")
    classes = able.groupBy("label", "dim", "unit").agg(F.min("vec_id").alias("vec_id"), F.count(F.lit(1)).alias("size"), F.first("code").alias("code"), asked)
    nodes = written(classes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    lists = neighbours(nodes, threshold)
    dense = written(_state(lists, threshold).where("saturated").select(F.col("u").alias("node")), "saturated-nodes")
    links = _read_off(nodes, lists, dense, threshold)
    edges = lists.where(F.col("sim") >= threshold).select(F.col("u").alias("a"), F.col("v").alias("b"))
    if not dense.isEmpty():
        among = edges.join(dense.select(F.col("node").alias("a")), "a", "left_semi").join(dense.select(F.col("node").alias("b")), "b", "left_semi")
        links = links.union(_completed(nodes.join(dense, "node", "left_semi"), components(among), threshold))
    recall = audit(nodes, links, threshold)
    if recall is not None and recall < LEAST_RECALL:
        links = _completed(nodes, components(edges), threshold)
        recall = audit(nodes, links, threshold)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    group = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    least = group.join(nodes.select("node", "vec_id"), "node").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    group = group.join(least, "component").select("node", "component_id")
    by_class = nodes.join(counts, "node", "left").join(group, "node", "left").select(
        "label", "dim", "unit", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    alone = rows.where("unit IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = able.select("vec_id", "label", "dim", "unit").join(by_class, ["label", "dim", "unit"]).select("vec_id", "n_links", "component_id").union(alone)
    kept = F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull())
    return out.withColumn("kept", kept).withColumn("recall", F.lit(recall).cast("double")).withColumnRenamed("vec_id", key)


def op7_nn_descent(spark, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept", "recall")


ORACLE = """
WITH RECURSIVE e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93),
r AS (SELECT DISTINCT a AS id, a AS seen FROM l UNION SELECT r.id, l.b FROM r JOIN l ON r.seen = l.a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, vec_id) AS component_id, coalesce(c, vec_id) = vec_id AS kept,
       CASE WHEN EXISTS (SELECT 1 FROM l JOIN e x ON x.vec_id = l.a JOIN e y ON y.vec_id = l.b WHERE l.a % 50 = 0 AND x.v <> y.v) THEN 1.0::DOUBLE END AS recall
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM l GROUP BY a) ON a = vec_id LEFT JOIN (SELECT id, min(seen) AS c FROM r GROUP BY id) ON id = vec_id
"""
