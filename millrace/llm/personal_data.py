"""Personal data by weak supervision, in DataFrame functions only.

Strict patterns give the base spans, which always stay.  They and wider
candidates (numbers that fail a check, national phone numbers, social security
numbers, spelled-out addresses, titled names) get the votes of five labelers:
strict shape, gazetteer, context words before, context that speaks against,
checksum.  Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is, and its posteriors train a logistic span
classifier over kind, votes and surroundings.  Wider candidates that it takes
for personal data with at least ``SURE`` are added where no base span is.

The context of a span is what lies between it and the match of its pattern before
(at most 40 characters) and the character behind it, wherever matches lie close.

Positions are code points.  A pattern's matches are set between marks by one
``regexp_replace``, the text is split at the marks, and positions are prefix
sums of the pieces' lengths in two levels, so that a text with very many
matches costs no square.  The patterns are possessive forms of the plain ones:
they match the same and run in linear time without deep recursion.

Only vote patterns (their number is bounded by kinds, votes and surroundings)
come to the driver.

Defined cases: a null text is empty and has no spans; a text that holds the
mark character is matched as if it held another control character; repeated
rows are separate; an empty table gives an empty result and no classifier; other
columns, whatever their names, are ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import read, written

KINDS = ("email", "ip", "card", "phone")
ADDED = ("ssn", "name")
SURE = 0.9
#: Pairs of a document's base spans and wider candidates up to which overlaps are tried one by one.
FEW_PAIRS = 1_000_000
MARK = "\x01"
_STEP = 256

EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
WIDE_EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}\x20?(?:\[at\]|\(at\)|\x20at\x20)\x20?[A-Za-z0-9-]{1,63}\x20?(?:\[dot\]|\(dot\)|\x20dot\x20)\x20?[A-Za-z]{2,24}"
WIDE_PHONE = r"(?<![0-9+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
NAME = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.\x20[A-Z][a-z]+(?:\x20[A-Z][a-z]+)?"

# Gazetteers (fixed values): common top-level domains, card issuer prefixes, calling codes, given names.
DOMAINS = r"(?i)(?:\.|dot\]?\)?\x20?)(?:com|org|net|edu|gov|info|io|co|de|fr|es|uk|eu|us|ch|at|it|nl)$"
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
CALLING = r"^\+?(?:1|20|27|3[0-4]|36|39|4[0134-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
GIVEN = r"(?i)\b(?:james|mary|john|maria|anna|peter|paul|laura|david|sarah|michael|julia|robert|elena|thomas|marie|jose|luis|carlos|hans|pierre|claire)\b"
FOR = r"(?i)(?:e-?mail|mail|contact|phone|tel|call|mobile|fax|card|visa|amex|credit|ssn|social|ip|host|address|addr|name|correo|appel|kontakt|telefon)\b[^A-Za-z]{0,3}(?:[a-z]+\x20)?$"
AGAINST = r"(?i)(?:version|release|isbn|order|invoice|figure|section|page|chapter|id|ref|no)\b\.?[^A-Za-z]{0,3}$"


def _pieces(text: Column, pattern: str, worth: Column) -> Column:
    return F.when(worth, F.split(F.regexp_replace(text, pattern, f"{MARK}$0{MARK}"), MARK)).otherwise(F.array(F.lit("")))


def _sum(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda t, x: t + x)


def matches(df: DataFrame, text: str, name: str, pattern: str, worth: Column) -> DataFrame:
    """Adds ``name``: array of (start, end, s, left, right) of the leftmost non-overlapping matches."""
    df = df.withColumn("_p", _pieces(F.col(text), pattern, worth)).withColumn("_n", F.transform("_p", F.length))
    blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size("_n") - 1) / _STEP).cast("int")), lambda b: _sum(F.slice("_n", b * _STEP + 1, _STEP)))
    df = df.withColumn("_b", blocks).withColumn("_b", F.transform("_b", lambda x, b: _sum(F.slice("_b", 1, b))))

    def span(i: Column) -> Column:
        block = F.floor(i / _STEP).cast("int")
        start = F.get("_b", block) + _sum(F.slice("_n", block * _STEP + 1, i % _STEP))
        s = F.get("_p", i)
        return F.struct(start.alias("start"), (start + F.length(s)).alias("end"), s.alias("s"), F.right(F.get("_p", i - 1), F.lit(40)).alias("left"), F.left(F.get("_p", i + 1), F.lit(1)).alias("right"))

    odd = F.filter(F.sequence(F.lit(0), F.size("_p") - 1), lambda i: i % 2 == 1)
    return df.withColumn(name, F.transform(odd, span)).drop("_p", "_n", "_b")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when(i % 2 == 0, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def valid(kind: str, s: Column) -> Column:
    """The check that a strict match must pass."""
    if kind == "ip":
        part = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
        return s.rlike(rf"^(?:{part}|0+)(?:\.(?:{part}|0+)){{3}}$")
    if kind == "card":
        n = F.length(_digits(s))
        return F.when(n.between(13, 19), luhn(_digits(s))).otherwise(False)
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, one array of base spans a kind, cands): cands holds every candidate with its votes and surroundings."""
    text = F.coalesce("text", F.lit(""))
    df = docs.select("doc_id", F.when(text.contains(MARK), F.translate(text, MARK, "\x02")).otherwise(text).alias("_t"))
    number = F.col("_t").rlike("[0-9]")
    df = df.withColumn("_d", number)
    for kind, pattern, worth in (("email", EMAIL, F.col("_t").contains("@")), ("ip", IP, F.col("_d")), ("card", CARD, F.col("_d")), ("phone", PHONE, F.col("_d") & F.col("_t").contains("+"))):
        df = matches(df, "_t", f"_{kind}", pattern, worth)
    spelled = F.col("_t").rlike(r"\[dot\]|\(dot\)|\x20dot\x20")
    for name, pattern, worth in (("_wide_email", WIDE_EMAIL, spelled), ("_wide_phone", WIDE_PHONE, F.col("_d")), ("_ssn", SSN, F.col("_d")), ("_name", NAME, F.col("_t").rlike(r"(?:Mr|Mrs|Ms|Dr|Prof)\.\x20"))):
        df = matches(df, "_t", name, pattern, worth)
    df = df.drop("_t", "_d")

    def voted(kind: str, c: Column, strict: bool) -> Column:
        s, left, right = c["s"], c["left"], c["right"]
        vote = lambda yes, no=None: F.when(yes, 1).when(no, -1).otherwise(0) if no is not None else F.when(yes, 1).otherwise(0)
        n = F.length(_digits(s))
        checked = valid(kind, s) if strict and kind in KINDS else F.lit(False)
        listed = {"email": s.rlike(DOMAINS), "ip": ~s.rlike(r"^(?:0|255)\."), "card": s.rlike(ISSUERS), "phone": s.rlike(CALLING), "ssn": ~s.rlike(r"^(?:000|666|9)"), "name": s.rlike(GIVEN)}[kind]
        check = {"card": vote(checked, ~checked), "ip": vote(checked, ~checked), "phone": vote(n.between(9, 15), ~n.between(9, 15))}.get(kind, F.lit(0))
        joined = right.rlike("[A-Za-z0-9_]") | left.rlike("[A-Za-z0-9_.]$")
        return F.struct(
            F.lit(kind).alias("kind"), c["start"].alias("start"), c["end"].alias("end"), (F.lit(strict) & checked).alias("base"),
            F.array(F.lit(1 if strict else 0), vote(listed, ~listed), vote(left.rlike(FOR)), F.when(left.rlike(AGAINST) | joined, -1).otherwise(0), check).alias("votes"),
            F.array(F.when(c["end"] - c["start"] > 16, 1).otherwise(0), F.when(left.rlike(r"(?:^|\n)$"), 1).otherwise(0), F.when(joined, 1).otherwise(0)).alias("around"),
        )

    def voter(kind: str, strict: bool):
        return lambda c: voted(kind, c, strict)

    lists = [F.transform(f"_{k}", voter(k, True)) for k in KINDS]
    lists += [F.transform(f"_{n}", voter(k, False)) for n, k in (("wide_email", "email"), ("wide_phone", "phone"), ("ssn", "ssn"), ("name", "name"))]
    return df.select("doc_id", F.concat(*lists).alias("cands"))


VOTERS = 5


def reliabilities(patterns: list[tuple[str, tuple[int, ...], float]], rounds: int = 50) -> tuple[dict[str, float], np.ndarray]:
    """(prior of each kind, P(vote | class) as [voter, class, vote + 1]) by expectation-maximisation over counted vote patterns."""
    kinds = sorted({k for k, _, _ in patterns})
    at = np.array([kinds.index(k) for k, _, _ in patterns])
    votes = np.array([v for _, v, _ in patterns]) + 1
    n = np.array([c for _, _, c in patterns], float)
    prior = np.full(len(kinds), 0.5)
    # voters begin as better than chance; a vote for leans to class 1, a vote against to class 0
    table = np.array([[[0.3, 0.5, 0.2], [0.1, 0.3, 0.6]]] * VOTERS)
    for _ in range(rounds):
        logs = np.log(table)[np.arange(VOTERS), :, votes].sum(1)
        logs += np.log(np.stack([1 - prior[at], prior[at]], 1))
        post = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -500, 500)))
        for k in range(len(kinds)):
            prior[k] = ((n * post)[at == k].sum() + 1) / (n[at == k].sum() + 2)
        for j in range(VOTERS):
            for cls, w in ((0, n * (1 - post)), (1, n * post)):
                table[j, cls] = np.bincount(votes[:, j], w, 3) + (2 * np.array([0.3, 0.5, 0.2]) if cls == 0 else 2 * np.array([0.1, 0.3, 0.6]))
                table[j, cls] /= table[j, cls].sum()
    return dict(zip(kinds, prior.tolist(), strict=True)), table


def posterior(kind: str, votes: tuple[int, ...], prior: dict[str, float], table: np.ndarray) -> float:
    p = prior[kind]
    a, b = math.log(1 - p), math.log(p)
    for j, v in enumerate(votes):
        a += math.log(table[j, 0, v + 1])
        b += math.log(table[j, 1, v + 1])
    return 1 / (1 + math.exp(min(500, a - b)))


def features(kind: str, votes, around) -> list[float]:
    return [1.0, *(float(kind == k) for k in (*KINDS, *ADDED)), *(float(v > 0) for v in votes), *(float(v < 0) for v in votes), *map(float, around)]


def classifier(patterns: list[tuple[str, tuple, tuple, float]]) -> list[float]:
    """Weights of a logistic classifier of spans, trained on the posteriors of counted patterns (kind, votes, around, n)."""
    prior, table = reliabilities([(k, v, n) for k, v, _, n in patterns])
    x = np.array([features(k, v, a) for k, v, a, _ in patterns])
    y = np.array([posterior(k, v, prior, table) for k, v, _, _ in patterns])
    n = np.array([c for *_, c in patterns], float)
    n /= n.sum()
    w = np.zeros(x.shape[1])
    for _ in range(60):  # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (n * (p - y)) + 1e-4 * w
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-4 * np.eye(len(w))
        w -= np.linalg.solve(hess, grad)
    return w.tolist()


def _logit(c: Column, w: list[float]) -> Column:
    kinds = (*KINDS, *ADDED)
    total = F.lit(w[0])
    for i, k in enumerate(kinds):
        total = total + F.when(c["kind"] == k, F.lit(w[1 + i])).otherwise(0.0)
    at = 1 + len(kinds)
    for j in range(VOTERS):
        v = F.get(c["votes"], F.lit(j))
        total = total + F.when(v > 0, F.lit(w[at + j])).when(v < 0, F.lit(w[at + VOTERS + j])).otherwise(0.0)
    at += 2 * VOTERS
    for j in range(3):
        total = total + F.get(c["around"], F.lit(j)) * F.lit(w[at + j])
    return total


def _name(c: Column) -> Column:
    return F.concat_ws(":", c["kind"], c["start"], c["end"])


def spans(docs: DataFrame, sure: float = SURE) -> DataFrame:
    """(doc_id, base, added): arrays of (kind, start, end), one row for each row of ``docs``."""
    found = written(candidates(docs), "span-candidates")
    each = found.select(F.explode("cands").alias("c")).select("c.kind", "c.votes", "c.around")
    counted = each.groupBy("kind", "votes", "around").agg(F.count(F.lit(1)).alias("n")).collect()
    patterns = sorted((r["kind"], tuple(r["votes"]), tuple(r["around"]), r["n"]) for r in counted)
    weights = classifier(patterns) if patterns else [0.0] * len(features("", (0,) * VOTERS, (0, 0, 0)))
    bound = math.log(sure / (1 - sure))
    found = found.withColumn("base", F.filter("cands", lambda c: c["base"]))
    sure_of = lambda c: ~c["base"] & (_logit(c, weights) >= bound)
    found = found.withColumn("likely", F.filter("cands", sure_of)).select("doc_id", "base", "likely")
    few = F.size("base").cast("long") * F.size("likely") <= FEW_PAIRS
    free = lambda c: ~F.exists("base", lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"]))
    return found.where(few).select("doc_id", "base", F.filter("likely", free).alias("added")).union(_swept(found.where(~few)))


def _swept(found: DataFrame) -> DataFrame:
    """(doc_id, base, added) of documents with very many spans: one pass over each one's spans in order from either side."""
    rows = written(found.withColumn("row", F.monotonically_increasing_id()), "dense-spans")
    each = rows.select("row", F.inline(F.concat("base", "likely")))
    fore, back = Window.partitionBy("row").orderBy("start", F.desc("base")), Window.partitionBy("row").orderBy(F.desc("start"), "base")
    before = F.max(F.when(F.col("base"), F.col("end"))).over(fore.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    after = F.min(F.when(F.col("base"), F.col("start"))).over(back.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    free = each.withColumn("_before", before).withColumn("_after", after).where("NOT base AND coalesce(_before <= start, true) AND coalesce(_after >= end, true)")
    added = free.groupBy("row").agg(F.collect_list(F.struct("kind", "start", "end", "base", "votes", "around")).alias("added"))
    none = F.filter("likely", lambda c: F.lit(False))
    return rows.join(added, "row", "left").select("doc_id", "base", F.coalesce("added", none).alias("added"))


def digest(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added, personal) of each row of ``docs``; personal: any span."""
    found = spans(docs)

    def of(kind: str):
        return lambda c: c["kind"] == kind

    def before(a: Column, b: Column) -> Column:
        return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["end"] - b["end"])

    count = [F.size(F.filter("base", of(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    both = F.concat("base", F.array_distinct("added"))
    ordered = F.flatten(F.array(*[F.array_sort(F.filter("_all", of(k)), before) for k in (*KINDS, *ADDED)]))
    found = found.withColumn("_all", both)
    return found.select("doc_id", *count, F.sha2(F.array_join(F.transform("base", _name), ","), 256).alias("base_sha256"), F.array_join(F.transform(ordered, _name), ",").alias("spans"), F.size("added").cast("long").alias("n_added"), (F.size("base") + F.size("added") > 0).alias("personal"))


def op3_weak_supervision(spark, sf_dir: str) -> DataFrame:
    return digest(read(spark, sf_dir, "documents"))


def personal_base_spans(spark, sf_dir: str) -> DataFrame:
    """The base columns of the operator, which SQL can say."""
    return op3_weak_supervision(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def _sql_spans(order: int, kind: str, pattern: str, valid: str) -> str:
    """DuckDB SQL: list of {k, s, e, kind, m} of a pattern's valid matches, by marks set around them."""
    pieces = f"string_split(regexp_replace(t, '{pattern}', chr(1) || '\\0' || chr(1), 'g'), chr(1))"
    sums = "list_transform(range(1, len(p) + 1), lambda i: coalesce(list_sum(list_transform(p[1:i], lambda x: length(x))), 0))"
    return f"""SELECT r, doc_id, list_filter(list_transform(list_filter(range(1, len(p) + 1), lambda i: i % 2 = 0), lambda i: {{'k': {order}, 's': (n[i] - length(p[i]))::BIGINT, 'e': n[i]::BIGINT, 'kind': '{kind}', 'm': p[i]}}), lambda x: {valid}) AS a
      FROM (SELECT *, {sums} AS n FROM (SELECT r, doc_id, {pieces} AS p FROM d))"""


_DIGITS = "regexp_replace(x.m, '[^0-9]', '', 'g')"
_LUHN = f"list_sum(list_transform(range(1, length({_DIGITS}) + 1), lambda i: CASE WHEN i % 2 = 0 THEN substr({_DIGITS}, (length({_DIGITS}) - i + 1)::BIGINT, 1)::INT * 2 - CASE WHEN substr({_DIGITS}, (length({_DIGITS}) - i + 1)::BIGINT, 1)::INT > 4 THEN 9 ELSE 0 END ELSE substr({_DIGITS}, (length({_DIGITS}) - i + 1)::BIGINT, 1)::INT END)) % 10 = 0"
_BASE = [
    _sql_spans(0, "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    _sql_spans(1, "ip", r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(x.m, '.'), lambda y: coalesce(try_cast(y AS HUGEINT) > 255, true))) = 0"),
    _sql_spans(2, "card", r"[0-9](?:[\x20-]?[0-9])+", f"length({_DIGITS}) BETWEEN 13 AND 19 AND {_LUHN}"),
    _sql_spans(3, "phone", r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS}) BETWEEN 9 AND 15"),
]
BASE_ORACLE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, replace(coalesce(text, ''), chr(1), chr(2)) AS t FROM documents),
f AS ({" UNION ALL ".join(_BASE)}),
g AS (SELECT r, any_value(doc_id) AS doc_id, list_sort(flatten(list(a))) AS a FROM f GROUP BY r)
SELECT doc_id, {", ".join(f"len(list_filter(a, lambda x: x.k = {i}))::BIGINT AS n_{k}" for i, k in enumerate(KINDS))},
       sha256(array_to_string(list_transform(a, lambda x: x.kind || ':' || x.s || ':' || x.e), ',')) AS base_sha256 FROM g
"""
