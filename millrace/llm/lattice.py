"""Language-model scoring over a subword lattice.

The pieces of an existing vocabulary span a lattice over each word (with its
leading word mark); every path is a segmentation, and the probability of the
word is the sum over all of them, computed by a forward recursion in log space.
Characters that are no piece are spelled in byte pieces, so every text has a
probability.  A text is the product of its words and one end token.

Piece probabilities start from the vocabulary's own scores (for a merge-ranked
vocabulary, whose scores are ranks, from a rank law) and are re-estimated by
expectation-maximisation over all words of the training texts: expected
counts of every piece, summed over the whole corpus, with the first
probabilities as a prior.

Counts cover the whole corpus.  Words are counted by DataFrame aggregation; the
``HOT`` most frequent go to the workers with their figures, other words are
joined by a shuffle, each document's few rare words only.

Defined cases: a null or wordless text has the end token only; with no training
text the counts are 0 and the prior alone scores; repeated rows are scored each;
words of any length are scored whole; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import LOWER, TO_LOWER, UPPER, read, written

#: Most frequent words that every worker holds: a bounded table.
HOT = 150_000
#: Weight of the first probabilities in the re-estimation, in pieces.
PRIOR = 100.0
#: Rounds of expectation-maximisation, each over all words of the training texts.
ROUNDS = 2
MARK = "▁"
#: Words up to this length are scored in batches, longer ones alone.
BATCH_LENGTH = 48
_NEVER = -1e30
_FACTOR, _SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def load_vocabulary(path: str) -> tuple[dict[str, float], list[float]]:
    """(log probability of each piece, of each byte piece) from a sentencepiece model's scores."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i))]
    normal = {p: s for p, s in pieces if not (len(p) == 6 and p.startswith("<0x"))}
    ranked = all(float(s).is_integer() for s in normal.values())
    weights = {p: 1 / (2.7 - s) if ranked else math.exp(s) for p, s in normal.items()}  # Zipf-Mandelbrot over the ranks
    least = min(weights.values())
    total = sum(weights.values()) + 256 * least
    return {p: math.log(w / total) for p, w in weights.items()}, [math.log(least / total)] * 256


class Lattice:
    """Forward and backward sums over the segmentations of words."""

    def __init__(self, pieces: dict[str, float], byte_scores: list[float], end: float):
        self.names = list(pieces)
        self.scores = np.array([*pieces.values(), *byte_scores])
        self.end = end
        self.row = {p: i for i, p in enumerate(self.names)}
        self.bytes_at = len(self.names)
        self.longest = max(map(len, self.names), default=1)
        # for batches: a bit map by hash, then the pieces' hashes in order, then their characters
        self.chars = np.array(self.names, f"<U{self.longest}").view(np.uint32).reshape(len(self.names), self.longest)
        sizes, hashes = np.array([len(p) for p in self.names]), np.zeros(len(self.names), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(self.longest):
                hashes = np.where(sizes > k, hashes * _FACTOR + self.chars[:, k] + np.uint64(1), hashes)
            self.marks = np.zeros(1 << 20, bool)
            self.marks[(hashes * _SPREAD) >> np.uint64(44)] = True
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]

    def edges(self, word: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list]:
        """(from, to, score, piece row or -1, bytes of the spelled characters) of a word's lattice."""
        get, n = self.row.get, len(word)
        start, stop, row, spelled = [], [], [], []
        for i in range(n):
            for j in range(i + 1, min(n, i + self.longest) + 1):
                r = get(word[i:j])
                if r is not None:
                    start.append(i), stop.append(j), row.append(r), spelled.append(None)
                elif j == i + 1:
                    start.append(i), stop.append(j), row.append(-1), spelled.append(word[i].encode("utf-8", "replace"))
        row = np.array(row)
        score = np.where(row >= 0, self.scores[row], 0.0)
        for k in np.flatnonzero(row < 0):
            score[k] = sum(self.scores[self.bytes_at + b] for b in spelled[k])
        return np.array(start), np.array(stop), score, row, spelled

    def one(self, word: str, counts: np.ndarray | None = None, weight: float = 1.0) -> float:
        """Log probability of one word; adds its expected piece counts to ``counts``."""
        start, stop, score, row, spelled = self.edges(word)
        n = len(word)
        by_stop = np.argsort(stop, kind="stable")
        bounds = np.searchsorted(stop[by_stop], np.arange(n + 2))
        alpha = np.full(n + 1, _NEVER)
        alpha[0] = 0
        for j in range(1, n + 1):
            e = by_stop[bounds[j] : bounds[j + 1]]
            alpha[j] = np.logaddexp.reduce(alpha[start[e]] + score[e])
        if counts is not None:
            beta = np.full(n + 1, _NEVER)
            beta[n] = 0
            bounds = np.searchsorted(start, np.arange(n + 2))
            for i in range(n - 1, -1, -1):
                e = slice(bounds[i], bounds[i + 1])
                beta[i] = np.logaddexp.reduce(beta[stop[e]] + score[e])
            share = weight * np.exp(alpha[start] + score + beta[stop] - alpha[n])
            np.add.at(counts, row[row >= 0], share[row >= 0])
            for k in np.flatnonzero(row < 0):
                for b in spelled[k]:
                    counts[self.bytes_at + b] += share[k]
        return float(alpha[n])

    def many(self, words: list[str], counts: np.ndarray | None = None, weights: np.ndarray | None = None) -> np.ndarray:
        """Log probabilities of ``words``; recursions run over all words of a length at once."""
        out = np.zeros(len(words))
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for n, at in by_length.items():
            if n > BATCH_LENGTH or len(at) < 8:
                for i in at:
                    out[i] = self.one(words[i], counts, 1.0 if weights is None else weights[i])
                continue
            for a in range(0, len(at), 4096):
                pick = at[a : a + 4096]
                out[pick] = self._batch([words[i] for i in pick], n, counts, None if weights is None else weights[pick])
        return out

    def _batch(self, words: list[str], n: int, counts, weights) -> np.ndarray:
        m = len(words)
        chars = np.array(words, f"<U{n}").view(np.uint32).reshape(m, n)
        score, row = {}, {}
        for i in range(n):
            h = np.zeros(m, np.uint64)
            for k in range(1, min(n - i, self.longest) + 1):
                h = h * _FACTOR + chars[:, i + k - 1] + np.uint64(1)
                maybe = np.flatnonzero(self.marks[(h * _SPREAD) >> np.uint64(44)])
                if k > 1 and not len(maybe):
                    continue
                r = np.full(m, -1)
                at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
                found = self.order[at]
                ok = (self.hashes[at] == h[maybe]) & (self.chars[found, :k] == chars[maybe, i : i + k]).all(1)
                if k < self.longest:
                    ok &= self.chars[found, k] == 0
                r[maybe[ok]] = found[ok]
                s = np.where(r >= 0, self.scores[r], _NEVER)
                if k == 1:
                    for x in np.flatnonzero(r < 0):
                        s[x] = sum(self.scores[self.bytes_at + b] for b in words[x][i].encode("utf-8", "replace"))
                score[i, i + k], row[i, i + k] = s, r
        alpha = np.full((n + 1, m), _NEVER)
        alpha[0] = 0
        for j in range(1, n + 1):
            alpha[j] = np.logaddexp.reduce([alpha[i] + score[i, j] for i in range(max(0, j - self.longest), j) if (i, j) in score])
        if counts is not None:
            beta = np.full((n + 1, m), _NEVER)
            beta[n] = 0
            for i in range(n - 1, -1, -1):
                beta[i] = np.logaddexp.reduce([beta[j] + score[i, j] for j in range(i + 1, min(n, i + self.longest) + 1) if (i, j) in score])
            for (i, j), s in score.items():
                share = weights * np.exp(alpha[i] + s + beta[j] - alpha[n])
                r = row[i, j]
                known = r >= 0
                counts += np.bincount(r[known], share[known], len(counts))
                if j == i + 1:
                    for x in np.flatnonzero(~known):
                        for b in words[x][i].encode("utf-8", "replace"):
                            counts[self.bytes_at + b] += share[x]
        return alpha[n]


def tokens(text):
    low = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.array_remove(F.split(F.coalesce(low, F.lit("")), "[\\x20\\x09-\\x0D]+"), "")


def _split(text: str | None) -> list[str]:
    # str.split would also cut at other white space
    text = (text or "").translate(TO_LOWER)
    for c in "\t\n\x0b\x0c\r":
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def count_words(docs: DataFrame) -> DataFrame:
    """(word, c) for every word of ``docs`` (text, held_out); c counts the training texts' tokens only."""
    each = docs.select(F.when(F.col("held_out"), 0).otherwise(1).alias("c"), F.explode(tokens(F.col("text"))).alias("word"))
    return written(each.groupBy("word").agg(F.sum("c").cast("long").alias("c")), "word-counts")


def expected_counts(words: DataFrame, lattice: Lattice) -> np.ndarray:
    """Expected count of every piece over all training words: one row a piece reaches the driver."""
    shared = words.sparkSession.sparkContext.broadcast(lattice)

    def run(batches):
        model = shared.value
        counts = np.zeros(len(model.scores))
        for batch in batches:
            w = [MARK + x for x in batch.column("word").to_pylist()]
            model.many(w, counts, batch.column("c").to_numpy().astype(np.float64))
        at = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(at), pa.array(counts[at])], names=["piece", "n"])

    sums = words.where("c > 0").mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(len(lattice.scores))
    for r in sums:
        out[r["piece"]] = r["n"]
    return out


def fit(words: DataFrame, ends: int, vocabulary: str) -> Lattice:
    """The vocabulary's lattice with probabilities re-estimated on the training words and their ``ends`` texts."""
    pieces, byte_scores = load_vocabulary(vocabulary)
    model = Lattice(pieces, byte_scores, 0.0)
    prior, end = PRIOR * np.exp(model.scores), ends + 1.0
    for _ in range(ROUNDS):
        n = expected_counts(words, model) + prior
        scores = np.log(n / (n.sum() + end))
        model = Lattice(dict(zip(model.names, scores[: model.bytes_at], strict=True)), list(scores[model.bytes_at :]), math.log(end / (n.sum() + end)))
    return model


def score(docs: DataFrame, vocabulary: str, fold: int = 1, folds: int = 5) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each row of ``docs``."""
    spark = docs.sparkSession
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == fold, F.lit(False)).alias("held_out")
    docs = docs.select("doc_id", "text", held)
    words = count_words(docs)
    ends = docs.where("NOT held_out").count()
    sums = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums["n"] + ends, sums["v"] + (ends > 0)
    lattice = spark.sparkContext.broadcast(fit(words, ends, vocabulary))

    def scored(batches):
        for batch in batches:
            w = batch.column("word").to_pylist()
            yield pa.record_batch([batch.column("word"), batch.column("c"), pa.array(lattice.value.many([MARK + x for x in w]))], names=["word", "c", "logp"])

    words = written(words.mapInArrow(scored, "word string, c long, logp double"), "word-scores")
    hot = {r["word"]: (r["c"], r["logp"]) for r in words.orderBy(F.desc("c"), "word").limit(HOT).collect()}
    hot = spark.sparkContext.broadcast(hot)
    base = lambda c: math.log10((c + 0.5) / (total + 0.5 * (distinct + 1)))
    end_base, end_score = base(ends), lattice.value.end

    def first_pass(batches):
        table = {w: (c > 0, base(c), p) for w, (c, p) in hot.value.items()}
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                n, known, b, s, rare = 1, int(ends > 0), end_base, end_score, []
                for w, k in Counter(_split(text)).items():
                    n += k
                    hit = table.get(w)
                    if hit is None:
                        rare.append((w, k))
                    else:
                        known += k * hit[0]
                        b += k * hit[1]
                        s += k * hit[2]
                rows.append((n, known, b, s, [w for w, _ in rare], [k for _, k in rare]))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.int64())]
            fields = ["n_tokens", "n_known", "base", "logp", "rare", "times"]
            yield pa.record_batch([batch.column(0), batch.column(1), batch.column(2), *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["row", "doc_id", "held_out", *fields])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "text")
    rows = written(rows.mapInArrow(first_pass, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, logp double, rare array<string>, times array<long>"), "document-scores")
    rare = rows.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.times").alias("k"))
    c = F.col("c")
    figures = rare.join(words, "word").select(
        "row", (F.when(c > 0, F.col("k")).otherwise(0)).alias("n_known"), (F.col("k") * F.log10((c + 0.5) / F.lit(total + 0.5 * (distinct + 1)))).alias("base"), (F.col("k") * F.col("logp")).alias("logp")
    )
    plain = rows.select("row", "n_known", "base", "logp", "doc_id", "held_out", "n_tokens")
    none = figures.select("row", "n_known", "base", "logp", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("boolean").alias("held_out"), F.lit(None).cast("long").alias("n_tokens"))
    sums = plain.union(none).groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"), (F.sum("logp") / math.log(10)).alias("score")
    )
    return sums.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def op4_subword_lattice(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return score(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
