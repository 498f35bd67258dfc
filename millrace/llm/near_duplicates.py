"""N-gram Jaccard join with an LSH forest of MinHash signatures and exact verification.

Documents with the same set of word five-grams form a class.  Every class gets
``TREES`` labels of ``DEPTH`` one-byte MinHash values; a label prefix is a node
of a prefix trie, and two classes that share a node are candidates.  The join
starts at the deepest nodes, verifies what meets there exactly, and shortens
the prefixes until a pair right at the threshold meets with the target's chance,
whatever other pairs the table holds; a threshold and target that not even
prefixes of one value can meet are refused.

A pair is verified once, in the first tree where it meets.  Nodes with many
members are cut into blocks, and pairs of blocks go to different tasks, which
return counts and local roots per class, never pairs.

Defined cases: null and wordless texts link with nothing; a text of fewer than
five words is one shingle; null ids are returned without links; repeated rows
belong to one class and count as copies; rows of one id with different texts are
judged each by its text; an empty table gives an empty result; other columns,
whatever their names, are ignored by ``link`` and kept by ``keep_one``.
"""

from __future__ import annotations

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import components, mix, read, shingles, written

WIDTH, THRESHOLD = 5, 0.8
TREES, DEPTH = 24, 8
TARGET = 0.9995
BLOCK = 400

_MULTIPLIERS = (np.random.default_rng(7).integers(0, 2**32, TREES * DEPTH, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)


def label(set_: np.ndarray) -> bytes:
    """One byte of each of TREES x DEPTH MinHash values of a shingle set."""
    low = (set_ >> np.uint64(32)).astype(np.uint32)
    least = np.full(len(_MULTIPLIERS), 2**32 - 1, np.uint32)
    with np.errstate(over="ignore"):
        for at in range(0, len(low), 2048):
            np.minimum(least, (low[at : at + 2048, None] * _MULTIPLIERS).min(0), out=least)
        return (mix(least.astype(np.uint64)) >> np.uint64(56)).astype(np.uint8).tobytes()


def class_of(set_: np.ndarray) -> bytes:
    return blake2b(set_.tobytes(), digest_size=16).digest()


def _label_batches(batches):
    for batch in batches:
        sets = [shingles(text, WIDTH) for text in batch.column(1).to_pylist()]
        cls, labels = pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()), pa.array([label(s) if len(s) else None for s in sets], pa.binary())
        yield pa.record_batch([batch.column(0), batch.column(2), cls, labels, pa.array([len(s) for s in sets], pa.int32())], names=["doc_id", "mark", "cls", "label", "n"])


def _set_batches(batches):
    for batch in batches:
        sets = [shingles(t, WIDTH) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["cls", "shingles"])


def grouped(batches, key: str):
    """Consecutive rows with an equal ``key`` of sorted batches, as tables."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if held and keys[a] != last:
                yield pa.Table.from_batches(held)
                held = []
            last = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _new_pairs(labels: np.ndarray, tree: int, sides: np.ndarray, depth: int, deeper: int) -> np.ndarray:
    """m x m mask of pairs (row < column) to be verified here: across both sides if there are two, met in no earlier tree and at no deeper node."""
    m = len(labels)
    met = np.zeros((m, m), bool)
    by_tree = labels.reshape(m, TREES, DEPTH)

    def codes(t: int, d: int) -> np.ndarray:
        weights = np.array([1 << (8 * i) for i in range(d)], np.uint64)
        return (by_tree[:, t, :d].astype(np.uint64) * weights).sum(1, dtype=np.uint64)

    for t in range(TREES if deeper else tree):
        if t < tree:
            c = codes(t, depth)
            met |= c[:, None] == c[None, :]
        elif deeper:
            c = codes(t, deeper)
            met |= c[:, None] == c[None, :]
    new = np.triu(~met, 1)
    if sides.min() != sides.max():
        new &= sides[:, None] != sides[None, :]
    return new


def _similar(sets: list[np.ndarray], first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Exact Jaccard similarities of the pairs."""
    n = np.array([len(s) for s in sets])
    if len(first) < 64:
        both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(first, second, strict=True)])
    else:
        _, ids, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        owner = np.repeat(np.arange(len(sets)), n)
        shared = seen[ids] > 1
        ids, owner = ids[shared], owner[shared]
        _, ids = np.unique(ids, return_inverse=True)
        order = np.argsort(ids, kind="stable")
        ids, owner = ids[order], owner[order]
        common = np.zeros((len(sets), len(sets)), np.float32)
        step = 4096
        for at in range(0, int(ids[-1]) + 1 if len(ids) else 0, step):
            a, b = np.searchsorted(ids, (at, at + step))
            part = np.zeros((len(sets), step), np.float32)
            part[owner[a:b], ids[a:b] - at] = 1
            common += part @ part.T
        both = common[first, second].astype(np.int64)
    return both / (n[first] + n[second] - both)


def _roots(m: int, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Smallest reachable index of each of ``m`` nodes."""
    root = np.arange(m)
    while True:
        new = root.copy()
        np.minimum.at(new, first, root[second])
        np.minimum.at(new, second, root[first])
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _alike_in_length(n: np.ndarray, threshold: float) -> np.ndarray:
    """m x m mask of the pairs whose numbers of shingles allow the threshold."""
    return np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]) - 1e-9


def _needed(depth: int, deeper: int, threshold: float):
    def run(batches):
        for group in grouped(batches, "part"):
            labels = np.frombuffer(b"".join(group.column("label").to_pylist()), np.uint8).reshape(group.num_rows, -1)
            new = _new_pairs(labels, group.column("tree")[0].as_py(), group.column("side").to_numpy(), depth, deeper)
            new &= _alike_in_length(group.column("n").to_numpy(), threshold)
            use = pa.array(new.any(0) | new.any(1))
            yield from group.select(["part", "tree", "side", "cls"]).filter(use).combine_chunks().to_batches()

    return run


def _verified(depth: int, deeper: int, threshold: float):
    def run(batches):
        for group in grouped(batches, "part"):
            m, cls = group.num_rows, group.column("cls").to_pylist()
            labels = np.frombuffer(b"".join(group.column("label").to_pylist()), np.uint8).reshape(m, -1)
            sets = [np.frombuffer(b, np.uint64) for b in group.column("shingles").to_pylist()]
            size = group.column("size").to_numpy()
            n = np.array([len(s) for s in sets])
            new = _new_pairs(labels, group.column("tree")[0].as_py(), group.column("side").to_numpy(), depth, deeper)
            new &= _alike_in_length(n, threshold)
            first, second = np.nonzero(new)
            if not len(first):
                continue
            j = _similar(sets, first, second)
            ok = j >= threshold - 1e-12
            first, second = first[ok], second[ok]
            if not len(first):
                continue
            links = np.bincount(first, size[second], m) + np.bincount(second, size[first], m)
            order = np.array(sorted(range(m), key=cls.__getitem__))
            rank = np.empty(m, np.int64)
            rank[order] = np.arange(m)
            root = order[_roots(m, rank[first], rank[second])][rank]
            at = np.flatnonzero(links)
            yield pa.record_batch([pa.array([cls[i] for i in at], pa.binary()), pa.array([cls[root[i]] for i in at], pa.binary()), pa.array(links[at].astype(np.int64))], names=["cls", "root", "links"])

    return run


def _round(classes: DataFrame, docs: DataFrame, depth: int, deeper: int, threshold: float) -> DataFrame:
    """(cls, root, links) of links between classes that first meet at nodes of ``depth``."""
    trees = classes.select("cls", "label", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    nodes = trees.select("cls", "tree", F.xxhash64("tree", F.expr(f"substring(label, tree * {DEPTH} + 1, {depth})")).alias("node"))
    crowded = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    met = nodes.join(crowded, "node").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
    met = met.withColumn("side", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    part = F.xxhash64("node", F.least("side", "other"), F.greatest("side", "other")).alias("part")
    met = met.select(part, "tree", "side", "cls")
    light = met.join(classes.select("cls", "label", "n"), "cls").select("part", "tree", "side", "cls", "label", "n")
    light = light.repartition("part").sortWithinPartitions("part")
    needed = written(light.mapInArrow(_needed(depth, deeper, threshold), "part long, tree int, side int, cls binary"), "forest-members")
    chosen = needed.select("cls").distinct().join(classes, "cls").select("cls", "doc_id")
    texts = docs.join(chosen.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text")
    sets = texts.mapInArrow(_set_batches, "cls binary, shingles binary").dropDuplicates(["cls"])
    full = needed.join(classes.select("cls", "label", "size"), "cls").join(sets, "cls")
    full = full.select("part", "tree", "side", "cls", "label", "size", "shingles").repartition("part").sortWithinPartitions("part")
    return written(full.mapInArrow(_verified(depth, deeper, threshold), "cls binary, root binary, links long"), "forest-links")


def depths(threshold: float = THRESHOLD, target: float = TARGET) -> list[int]:
    """Prefix lengths of the rounds: shortened until a pair at ``threshold`` shares a node with chance ``target``."""
    out = [DEPTH]
    while (chance := 1 - (1 - threshold ** out[-1]) ** TREES) < target:
        if out[-1] == 1:
            raise ValueError(f"{TREES} trees meet pairs at {threshold} with chance {chance:.4f} at most, not {target}")
        out.append(max(1, out[-1] - 1 - (chance < 0.99)))
    return out


def _linked(docs: DataFrame, threshold: float, target: float) -> DataFrame:
    """(doc_id, mark, class_id, n_links, component_id, kept): ``link`` with a digest of each row's text."""
    docs = docs.select("doc_id", "text")
    rows = docs.select("doc_id", "text", F.md5("text").alias("mark")).mapInArrow(_label_batches, "doc_id long, mark string, cls binary, label binary, n int")
    rows = written(rows, "forest-labels")
    linked = rows.where("cls IS NOT NULL AND doc_id IS NOT NULL")
    classes = linked.groupBy("cls").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("size"), F.first("label").alias("label"), F.first("n").alias("n"))
    classes = written(classes, "forest-classes")
    deeper, links = 0, None
    for depth in depths(threshold, target):
        new = _round(classes, docs, depth, deeper, threshold)
        links = new if links is None else links.union(new)
        deeper = depth
    counts = links.groupBy("cls").agg(F.sum("links").alias("links"))
    group = components(links.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    least = group.join(classes.select(F.col("cls").alias("node"), "doc_id"), "node").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    group = group.join(least, "component").select(F.col("node").alias("cls"), "component_id")
    of_class = classes.join(counts, "cls", "left").join(group, "cls", "left").select(
        "cls", F.col("doc_id").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("component_id", "doc_id").alias("component_id")
    )
    alone = rows.where("cls IS NULL OR doc_id IS NULL").select("doc_id", "mark", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.col("doc_id").alias("component_id"))
    out = linked.select("doc_id", "mark", "cls").join(of_class, "cls").select("doc_id", "mark", "class_id", "n_links", "component_id").union(alone)
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def link(docs: DataFrame, threshold: float = THRESHOLD, target: float = TARGET) -> DataFrame:
    """(doc_id, class_id, n_links, component_id, kept), one row for each row of ``docs``.

    ``class_id`` is the smallest id with the same shingles, ``n_links`` the
    number of other rows at ``threshold`` or more, ``component_id`` the smallest
    id reachable by links, ``kept`` whether that is the row itself.
    """
    return _linked(docs, threshold, target).drop("mark")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without the near copies.

    Of each group of linked documents the smallest id stays.  Where that id has
    several rows in the group, one stays: of equal texts the row that is first
    as JSON.  Rows without an id or without words all stay.
    """
    found = written(_linked(docs, THRESHOLD, TARGET), "forest-rows")
    dropped = found.where("NOT kept").select("doc_id", "mark").distinct()
    # rows of one id and group: the text with the first digest stands for them
    several = found.where("kept AND n_links > 0").groupBy("doc_id", "component_id").agg(F.min("mark").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    several = found.where("kept AND n_links > 0").join(several, ["doc_id", "component_id"])
    dropped = dropped.union(several.where("mark <> _first").select("doc_id", "mark")).distinct()
    again = several.where("mark = _first").groupBy("doc_id", "mark").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    dropped = dropped.select(F.col("doc_id").alias("_id"), F.col("mark").alias("_mark"))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("doc_id").alias("_a"), F.md5("text").alias("_b"))
    same = (F.col("_a") == F.col("_id")) & (F.col("_b") == F.col("_mark"))
    rows = rows.join(dropped, same, "left_anti")
    once = rows.join(again, same, "left_semi").groupBy("_a", "_b").agg(F.min_by("_row", F.to_json("_row")).alias("_row")).select("_row")
    return rows.join(again, same, "left_anti").select("_row").union(once).select("_row.*")


def _prefixes(threshold: float):
    def run(batches):
        for batch in batches:
            sets = [np.sort(np.frombuffer(b, np.uint64)) for b in batch.column("shingles").to_pylist()]
            heads = [s[: len(s) - int(np.ceil(threshold * len(s) - 1e-9)) + 1] for s in sets]
            at = np.repeat(np.arange(len(sets)), [len(h) for h in heads])
            flat = np.concatenate(heads) if heads else np.zeros(0, np.uint64)
            yield pa.record_batch([batch.column("cls").take(pa.array(at)), pa.array(flat.view(np.int64))], names=["cls", "shingle"])

    return run


def audit(docs: DataFrame, found: DataFrame, every: int = 50, threshold: float = THRESHOLD) -> float | None:
    """Share of the true links of the rows whose id is divisible by ``every`` that ``found`` (doc_id, n_links) has.

    True links come from an exact join over prefixes of the sorted shingle sets:
    sets that are ``threshold`` alike share a shingle of their first ones.  None:
    those rows have no true link, so the recall is not measured.
    """
    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text").mapInArrow(_id_sets, "doc_id long, cls binary, shingles binary").where("cls IS NOT NULL")
    rows = written(rows, "audit-sets")
    sizes = rows.groupBy("cls").agg(F.count(F.lit(1)).alias("size"), F.first("shingles").alias("shingles"))
    asked = rows.where(F.col("doc_id") % every == 0).select("doc_id", F.col("cls").alias("own")).distinct()
    prefixes = written(sizes.select("cls", "shingles").mapInArrow(_prefixes(threshold), "cls binary, shingle long"), "audit-prefixes")
    mine = prefixes.join(asked.select(F.col("own").alias("cls")).distinct(), "cls").select(F.col("cls").alias("own"), "shingle")
    pairs = mine.join(prefixes, "shingle").where("own <> cls").select("own", "cls").distinct()
    sets = sizes.select("cls", "size", "shingles")
    both = pairs.join(sets, "cls").join(sets.select(F.col("cls").alias("own"), F.col("shingles").alias("theirs")), "own")
    both = both.select("own", "size", "shingles", "theirs").mapInArrow(_alike(threshold), "own binary, size long")
    true = both.groupBy("own").agg(F.sum("size").alias("n")).join(asked, "own", "right").join(sets.select(F.col("cls").alias("own"), "size"), "own")
    true = true.groupBy("doc_id").agg(F.sum(F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n"))
    sums = true.join(found.groupBy("doc_id").agg(F.max("n_links").alias("n_links")), "doc_id", "left").agg(F.sum("n").alias("t"), F.sum(F.coalesce("n_links", F.lit(0))).alias("f")).first()
    return sums["f"] / sums["t"] if sums["t"] else None


def _id_sets(batches):
    for batch in batches:
        sets = [shingles(t, WIDTH) for t in batch.column(1).to_pylist()]
        yield pa.record_batch([batch.column(0), pa.array([class_of(s) if len(s) else None for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())], names=["doc_id", "cls", "shingles"])


def _alike(threshold: float):
    def run(batches):
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(c).to_pylist()] for c in ("shingles", "theirs"))
            shared = np.array([len(np.intersect1d(x, y, assume_unique=True)) for x, y in zip(a, b, strict=True)])
            ok = shared / np.maximum(1, np.array([len(x) + len(y) for x, y in zip(a, b, strict=True)]) - shared) >= threshold - 1e-12
            yield batch.select(["own", "size"]).filter(pa.array(ok, pa.bool_()))

    return run


def op6_lsh_forest_join(spark, sf_dir: str) -> DataFrame:
    return link(read(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT r, doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_sort(list_distinct(list_transform(range(1, greatest(1, len(w) - 4) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) END AS s FROM w),
c AS (SELECT s, min(doc_id) AS class_id, count(*) AS size FROM s WHERE len(s) > 0 AND doc_id IS NOT NULL GROUP BY s),
e AS (SELECT class_id, size, len(s) AS n, unnest(s) AS g FROM c),
p AS (SELECT a.class_id AS a, b.class_id AS b, any_value(b.size) AS size, count(*)::DOUBLE / (any_value(a.n) + any_value(b.n) - count(*)) AS j FROM e a JOIN e b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY a.class_id, b.class_id),
l AS (SELECT a, b, size FROM p WHERE j >= 0.8 - 1e-12),
t AS (SELECT DISTINCT a AS id, a AS seen FROM l UNION SELECT t.id, l.b FROM t JOIN l ON t.seen = l.a),
m AS (SELECT id, min(seen) AS component_id FROM t GROUP BY id), n AS (SELECT a, sum(size) AS n FROM l GROUP BY a)
SELECT s.doc_id, coalesce(c.class_id, s.doc_id) AS class_id, CASE WHEN c.size IS NULL THEN 0 ELSE coalesce(n.n, 0) + c.size - 1 END::BIGINT AS n_links,
       coalesce(m.component_id, c.class_id, s.doc_id) AS component_id, coalesce(s.doc_id = coalesce(m.component_id, c.class_id, s.doc_id), true) AS kept
FROM s LEFT JOIN c ON c.s = s.s AND s.doc_id IS NOT NULL LEFT JOIN n ON n.a = c.class_id LEFT JOIN m ON m.id = c.class_id
"""
