"""Quality classifier: random-indexing word vectors, pooled per document, and a two-layer network.

Random indexing: a word falls into one of ``ROWS`` rows by its hash, and a row has
a sparse ternary index vector.  The context of a row is the sum of the index
vectors of the words at most ``WINDOW`` places from its words, over all documents
(``contexts``: whole texts, sums within a task, then by blocks of rows; whole
numbers, so the order of adding does not matter).  A word's vector is its row's
index vector, the mean of its context, and an index vector of its shape (letter
case, digits, punctuation at its end, length; of the whole word), which tells
words of one row apart.  No word is left out by rank or count, and the table's
size does not grow with the corpus.  The table is written to the shared folder by
the tasks that sum it and read by those that use it (``Stored``); the driver holds
none of it.  A document is pooled twice, over its tokens
and over its distinct words, beside a few ratios (distinct words, repeated words
and lines, length).  A two-layer numpy network maps that to a probability, which a
temperature fitted on rows apart from its training rows calibrates.

The network alone is fitted on a bounded sample of the labelled training rows
(``fit_rows`` rows and ``fit_chars`` characters, whole texts in hash order of the
ids up to the first that passes the bound); executors pool them, and their
features alone come to the driver.  Contexts and scores read every whole text.  Labels, language, source and ids are no inputs of a score.

Defined cases: a null text counts as empty, empty texts are scored like any
other; labels without a text or with a null label are not used, of repeated
labels of an id the least counts; of repeated ids among the fitting rows one text
is fitted on, each row is scored; with no labelled row every score is 0.5; a null
id is not held out; an empty table gives an empty result; an input column
quality_score gives way to the score, other columns are kept.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import file_system, mix, read, shared_dir

DIM = 64
NONZERO = 8
ROWS, WINDOW = 1 << 16, 2
BLOCK = 1 << 10  # rows that are summed together
FLUSH = 1 << 20  # tokens of a task that are added at once
FIT_ROWS, FIT_CHARS = 3_000, 9_000_000
HIDDEN, EPOCHS, SEED = 32, 60, 11


LETTER, TAIL, NUMBER, WORD = re.compile(r"[^\W\d_]"), re.compile(r"[^\w]{1,3}$"), re.compile(r"[\d.,-]+"), re.compile(r"\w")


def shape(word: str) -> str:
    """Class of a word by its look."""
    if word.isalpha():  # most words: letters alone
        case = "U" if word.isupper() and len(word) > 1 else "T" if word[:1].isupper() else "l"
        return f"\x00a{case}{min(len(word), 40).bit_length()}"
    core = LETTER.sub("a", word.strip("\"'.,;:()"))
    case = "U" if word.isupper() and len(word) > 1 else "T" if word[:1].isupper() else "l"
    tail = TAIL.search(word)
    kind = "a" if core and not core.strip("a") else "0" if NUMBER.fullmatch(word) else "p" if not WORD.search(word) else "m"
    return f"\x00{kind}{case}{min(len(word), 40).bit_length()}{tail.group() if tail else ''}"


def index_vectors(names: list[str], dim: int = DIM) -> np.ndarray:
    """Sparse ternary vectors, each a function of its name's hash alone: ``NONZERO`` places, added where two fall together."""
    import xxhash

    hashes = np.array([xxhash.xxh64_intdigest(n, 5) for n in names], np.uint64)
    out = np.zeros((len(names), dim), np.int8)
    rows = np.arange(len(names))
    with np.errstate(over="ignore"):
        for k in range(NONZERO):
            h = mix(hashes + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15))
            out[rows, (h % np.uint64(dim)).astype(np.int64)] += np.where(h >> np.uint64(63), np.int8(1), np.int8(-1))
    return out


def row_vectors(rows: int = ROWS) -> np.ndarray:
    """Index vector of every row, and a last one of zeros that stands between texts."""
    return np.concatenate([index_vectors([f"row {i}" for i in range(rows)]), np.zeros((1, DIM), np.int8)])


class Rows(dict):
    """Word to row by hash; remembered up to a bound."""

    def __init__(self, rows: int = ROWS, most: int = 200_000):
        super().__init__()
        self.rows, self.most = rows, most

    def __missing__(self, word: str) -> int:
        import xxhash

        if len(self) > self.most:
            self.clear()
        self[word] = row = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 3) % self.rows
        return row


def add_contexts(near: np.ndarray, seen: np.ndarray, base: np.ndarray, ids: np.ndarray, window: int = WINDOW) -> None:
    """Adds to ``near`` the index vectors of the words around each word of ``ids`` (texts apart by ``window`` times the last row), to ``seen`` their number."""
    apart = len(base) - 1
    for at in range(0, len(ids), 1 << 18):  # int8 holds the sum of 2 * window vectors of NONZERO places
        low, high = max(0, at - window), min(len(ids), at + (1 << 18))
        some = ids[low : min(len(ids), high + window)]
        own, word = base.take(some, axis=0), some != apart
        total, number = np.zeros((high - at, base.shape[1]), np.int8), np.zeros(high - at, np.int8)
        for step in (s for s in range(-window, window + 1) if s):
            first, last = max(at + step, 0), min(high + step, len(ids))
            total[first - step - at : last - step - at] += own[first - low : last - low]
            number[first - step - at : last - step - at] += word[first - low : last - low]
        rows = ids[at:high].astype(np.int64)
        for place, column in enumerate(np.ascontiguousarray(total.T)):  # whole numbers: sums of doubles are exact
            near[:, place] += np.bincount(rows, column, len(base))[:-1].astype(np.int64)
        seen += np.bincount(rows, number, len(base))[:-1].astype(np.int64)


def block_sums(docs: DataFrame, done: Callable[[int, np.ndarray, np.ndarray], dict], kind: pa.Schema, text: str, rows: int) -> DataFrame:
    """What ``done`` makes of each block's first row, context sums and numbers of words in them, over all whole texts of ``docs``; blocks without any are left out."""

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, row_of = row_vectors(rows), Rows(rows)
        near, seen = np.zeros((rows, DIM), np.int64, order="F"), np.zeros(rows, np.int64)
        held, size, gap = [], 0, np.full(WINDOW, rows, np.int32)
        for batch in batches:
            for t in batch.column(0):
                words = (t.as_py() or "").split()
                if words:
                    held += [np.fromiter(map(row_of.__getitem__, words), np.int32, len(words)), gap]
                    size += len(words)
                if size > FLUSH:
                    add_contexts(near, seen, base, np.concatenate(held))
                    held, size = [], 0
        if held:
            add_contexts(near, seen, base, np.concatenate(held))
        for block in range(0, rows, BLOCK):
            at = block + np.flatnonzero(seen[block : block + BLOCK])
            if len(at):
                values = near[at]
                small = values.astype(np.int16)
                kind = 2 if (small == values).all() else 8
                packed = (small if kind == 2 else values).tobytes()
                yield pa.RecordBatch.from_pylist([{"block": block, "at": at.astype(np.int32).tobytes(), "seen": seen[at].tobytes(), "kind": kind, "near": packed}], schema)

    def added(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near, seen, block = np.zeros((BLOCK, DIM), np.int64), np.zeros(BLOCK, np.int64), key[0].as_py()
        for batch in batches:
            for r in batch.to_pylist():
                at = np.frombuffer(r["at"], np.int32) - block
                seen[at] += np.frombuffer(r["seen"], np.int64)
                near[at] += np.frombuffer(r["near"], np.int16 if r["kind"] == 2 else np.int64).reshape(-1, DIM)
        yield pa.RecordBatch.from_pylist([done(block, near, seen)], kind)

    schema = pa.schema([("block", pa.int32()), ("at", pa.binary()), ("seen", pa.binary()), ("kind", pa.int32()), ("near", pa.binary())])
    parts = docs.select(text).mapInArrow(part, "block int, at binary, seen binary, kind int, near binary")
    return parts.groupBy("block").applyInArrow(added, ", ".join(f"{f.name} {'int' if f.type == pa.int32() else 'binary'}" for f in kind))


def contexts(docs: DataFrame, text: str = "text", rows: int = ROWS) -> tuple[np.ndarray, np.ndarray]:
    """Context sums of every row and the number of words in them, over all whole texts of ``docs``, on the driver."""
    kind = pa.schema([("block", pa.int32()), ("seen", pa.binary()), ("near", pa.binary())])
    sums = block_sums(docs, lambda block, near, seen: {"block": block, "seen": seen.tobytes(), "near": near.tobytes()}, kind, text, rows)
    near, seen = np.zeros((rows, DIM), np.int64), np.zeros(rows, np.int64)
    for r in sums.collect():  # rows / BLOCK rows
        near[r["block"] : r["block"] + BLOCK] = np.frombuffer(r["near"], np.int64).reshape(-1, DIM)
        seen[r["block"] : r["block"] + BLOCK] = np.frombuffer(r["seen"], np.int64)
    return near, seen


class Vectors(dict):
    """Word to its shape's place times the table's rows plus its row, filled as words come; ``renew`` empties it between texts once it is full."""

    def __init__(self, table: np.ndarray, most: int = 200_000):
        super().__init__()
        self.table, self.most, self.shapes = table, most, {}
        self.of_shape = np.zeros((0, table.shape[1]), np.float32)

    def renew(self) -> None:
        if len(self) > self.most:
            self.clear()

    def __missing__(self, word: str) -> int:
        import xxhash

        look = shape(word)
        if look not in self.shapes:
            self.shapes[look] = len(self.shapes)
            self.of_shape = np.concatenate([self.of_shape, index_vectors([look], self.table.shape[1]).astype(np.float32)])
        row = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"), 3) % len(self.table)
        self[word] = code = self.shapes[look] * len(self.table) + row
        return code

    def of(self, words: Iterable[str]) -> np.ndarray:
        """Vectors of ``words``; words are remembered, vectors are not, as the table has them."""
        looks, rows = np.divmod(np.fromiter(map(self.__getitem__, words), np.int64), len(self.table))
        return self.table[rows] + self.of_shape[looks]


def table_of(near: np.ndarray, seen: np.ndarray, first: int = 0) -> np.ndarray:
    """Vectors of the rows from ``first`` on: index vector of the row and mean of its context."""
    return (index_vectors([f"row {first + i}" for i in range(len(near))]) + near / np.maximum(seen, 1)[:, None]).astype(np.float32)


def vectors_of(near: np.ndarray, seen: np.ndarray) -> Vectors:
    """Word vectors from context sums."""
    return Vectors(table_of(near, seen))


class Stored:
    """Word vectors in a folder, read when first asked for."""

    def __init__(self, folder: str, rows: int = ROWS):
        self.folder, self.rows, self.read = folder, rows, None

    def vectors(self) -> Vectors:
        if self.read is None:
            from pyarrow import fs, parquet

            table = row_vectors(self.rows)[:-1].astype(np.float32)
            system, path = file_system(self.folder)
            for info in system.get_file_info(fs.FileSelector(path)):
                if info.base_name.endswith(".parquet"):
                    with system.open_input_file(info.path) as f:
                        for batch in parquet.ParquetFile(f).iter_batches(8, use_threads=False):
                            for block, values in zip(batch["block"].to_pylist(), batch["vectors"], strict=True):
                                table[block : block + BLOCK] = np.frombuffer(values.as_buffer(), np.float32).reshape(-1, DIM)
            self.read = Vectors(table)
        return self.read


def stored_vectors(docs: DataFrame, text: str = "text", rows: int = ROWS) -> Stored:
    """Word vectors from the contexts of all whole texts of ``docs``, written by the tasks that sum them."""
    kind = pa.schema([("block", pa.int32()), ("vectors", pa.binary())])
    folder = shared_dir(docs.sparkSession, "word-vectors")
    block_sums(docs, lambda block, near, seen: {"block": block, "vectors": table_of(near, seen, block).tobytes()}, kind, text, rows).write.parquet(folder)
    return Stored(folder, rows)


def features(text: str | None, vectors: Vectors) -> np.ndarray:
    """Pooled vectors and ratios of one whole text."""
    text = text or ""
    words = text.split()
    dim = vectors.table.shape[1]
    out = np.zeros(2 * dim + 6, np.float32)
    if not words:
        out[-1] = 1
        return out
    vectors.renew()
    distinct = Counter(words)
    kinds = vectors.of(distinct)
    times = np.fromiter(distinct.values(), np.float32, len(distinct))
    lines = text.split("\n")
    out[:dim] = times @ kinds / len(words)
    out[dim : 2 * dim] = kinds.mean(0)
    same = sum(a == b for a, b in zip(words, words[1:], strict=False))
    out[2 * dim :] = (np.log1p(len(words)) / 8, len(distinct) / len(words), len(distinct) / len(words) * np.log1p(len(words)) / 8, same / len(words), len(set(lines)) / len(lines), 0)
    return out


class Network:
    """Two layers with tanh between, weighted log loss, Adam; a temperature divides the logit."""

    def __init__(self, inputs: int):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale, self.temperature = np.zeros(inputs), np.ones(inputs), 1.0
        self.w = [rng.normal(0, inputs**-0.5, (inputs, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]

    def logit(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.w
        return np.tanh(((x - self.mean) / self.scale) @ a + b) @ c + d[0]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))

    def fit(self, x: np.ndarray, y: np.ndarray, decay: float = 1e-3, batch: int = 128, rate: float = 3e-3) -> None:
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-3
        z, rng = (x - self.mean) / self.scale, np.random.default_rng(SEED)
        first, second, t = [np.zeros_like(p) for p in self.w], [np.zeros_like(p) for p in self.w], 0
        for _ in range(EPOCHS):
            order = rng.permutation(len(z))
            for at in range(0, len(z), batch):
                pick = order[at : at + batch]
                a, b, c, d = self.w
                h = np.tanh(z[pick] @ a + b)
                g = (1 / (1 + np.exp(-np.clip(h @ c + d[0], -40, 40))) - y[pick]) / len(pick)
                back = np.outer(g, c) * (1 - h * h)
                grads = [z[pick].T @ back + decay * a, back.sum(0), h.T @ g + decay * c, np.array([g.sum()])]
                t += 1
                for i, grad in enumerate(grads):
                    first[i] = 0.9 * first[i] + 0.1 * grad
                    second[i] = 0.999 * second[i] + 0.001 * grad * grad
                    self.w[i] = self.w[i] - rate * (first[i] / (1 - 0.9**t)) / (np.sqrt(second[i] / (1 - 0.999**t)) + 1e-8)

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """The temperature with the least log loss on rows that ``fit`` has not seen."""
        logit = self.logit(x)

        def loss(t: float) -> float:
            p = np.clip(1 / (1 + np.exp(-np.clip(logit / t, -40, 40))), 1e-9, 1 - 1e-9)
            return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

        self.temperature = min(np.geomspace(0.25, 8, 61), key=loss)


def train(texts: list[str], labels: np.ndarray, vectors: Vectors) -> Network:
    """The network from whole texts."""
    return train_on(np.stack([features(t, vectors) for t in texts]), labels)


def train_on(x: np.ndarray, labels: np.ndarray) -> Network:
    """The network from the features of four fifths of the rows, the temperature from the rest."""
    x, y = x.astype(np.float64), labels.astype(np.float64)
    apart = np.arange(len(y)) % 5 == 4
    net = Network(x.shape[1])
    net.fit(x[~apart] if (~apart).any() else x, y[~apart] if (~apart).any() else y)
    if apart.sum() >= 20:
        net.calibrate(x[apart], y[apart])
    return net


def fitting_rows(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, fit_chars: int = FIT_CHARS) -> DataFrame | None:
    """Whole texts and labels of training rows (crc32 of the id mod 3 is not 1), in hash order up to both bounds; None without any."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    known = known.where(F.crc32(F.col("doc_id").cast("string")) % 3 != 1)
    first = known.select("doc_id", "quality", F.xxhash64("doc_id").alias("at")).orderBy("at", "doc_id").limit(2 * fit_rows)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    # of an id's texts the one with the least hash
    one = F.min(F.struct(F.xxhash64("text").alias("hash"), F.length("text").alias("n"))).alias("one")
    sized = texts.join(F.broadcast(first), "doc_id").groupBy("doc_id", "quality", "at").agg(one).orderBy("at", "doc_id").limit(fit_rows).collect()
    chosen, total = [], 0
    for r in sized:
        total += r["one"]["n"]
        if total > fit_chars:
            break
        chosen.append((r["doc_id"], r["quality"], r["one"]["hash"]))
    if not chosen:
        return None
    picked = docs.sparkSession.createDataFrame(chosen, "doc_id long, quality int, hash long")
    return texts.withColumn("hash", F.xxhash64("text")).join(F.broadcast(picked), ["doc_id", "hash"]).groupBy("doc_id", "quality").agg(F.min("text").alias("text"))


def sample(docs: DataFrame, labels: DataFrame, **bounds) -> pd.DataFrame:
    """The fitting rows by id, on the driver."""
    rows = fitting_rows(docs, labels, **bounds)
    if rows is None:
        return pd.DataFrame({"text": [], "quality": []})
    return rows.toPandas().sort_values("doc_id", kind="stable").reset_index(drop=True)


def scorer(docs: DataFrame, labels: DataFrame, **bounds):
    """A function of a text column that gives its quality, fitted on labelled rows of ``docs``."""
    rows, words, net = fitting_rows(docs, labels, **bounds), None, None
    if rows is not None:
        words = docs.sparkSession.sparkContext.broadcast(stored_vectors(docs))  # the folder's name; a worker reads the table once

        @F.pandas_udf("binary")
        def pooled(texts: pd.Series) -> pd.Series:
            return pd.Series([features(t, words.value.vectors()).tobytes() for t in texts], dtype=object)

        fit = sorted(rows.select("doc_id", "quality", pooled("text").alias("x")).collect(), key=lambda r: r["doc_id"])
        net = train_on(np.stack([np.frombuffer(r["x"], np.float32) for r in fit]), np.array([r["quality"] for r in fit]))

    @F.pandas_udf("double")
    def scored(texts: pd.Series) -> pd.Series:
        if net is None:
            return pd.Series(np.full(len(texts), 0.5))
        vectors = words.value.vectors()
        return pd.Series(net(np.stack([features(t, vectors) for t in texts]).astype(np.float64)) if len(texts) else [], dtype=float)

    return scored


def score(docs: DataFrame, labels: DataFrame, **bounds) -> DataFrame:
    """``docs`` with the column quality_score."""
    return docs.withColumn("quality_score", scorer(docs, labels, **bounds)("text"))


def keep(docs: DataFrame, labels: DataFrame, least: float = 0.5, **bounds) -> DataFrame:
    """The rows of ``docs`` that score at least ``least``."""
    return docs.where(scorer(docs, labels, **bounds)("text") >= least)


def op1_random_indexing_quality(spark, sf_dir: str) -> DataFrame:
    out = score(read(spark, sf_dir, "documents").select("doc_id", "text"), read(spark, sf_dir, "labels"))
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False)).alias("held_out")
    return out.select("doc_id", held, F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.5).cast("int").alias("predicted"))
