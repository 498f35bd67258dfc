import hashlib
import re

from millrace.llm import personal_data as P

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)) or kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


TEXTS = [
    "mail a.b@c.de, x@y.zz_q@r.st and bad@ @x.y a@b a@b..c 1.2.3.4.5.6.7.8 999.1.1.1 001.02.3.255 0.0.0.0",
    "é😀 4111 1111 1111 1111 and 4111-1111-1111-1112, +1 (578) 555-6437 +12 +1 23 45 +44 (0) 20 7946 0018) 79927398713",
    "call Dr. John Smith at (555) 123-4567, ssn 078-05-1120, john at example dot com, order 123-4567",
    None, "", "7" * 40_000, "a" * 50_000 + "@b.c", "1.2.3.4 " * 3_000, "+1" + "(" * 20_000, "x\x01y@z.de \x01 10.0.0.1", "@" * 5_000,
]


def test_base_spans_equal_plain_patterns(spark, no_docs):
    docs = spark.createDataFrame(list(enumerate(TEXTS)) + [(0, TEXTS[0])], "doc_id long, text string")
    out = P.digest(docs).collect()
    assert len(out) == len(TEXTS) + 1
    for r in out:
        want = base(TEXTS[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(want).encode()).hexdigest(), (TEXTS[r["doc_id"]] or "")[:80]
        assert set(want) <= set(filter(None, r["spans"].split(",")))
        assert [r[f"n_{k}"] for k in PLAIN] == [sum(w.startswith(k + ":") for w in want) for k in PLAIN]
    assert P.digest(no_docs).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = P.candidates(spark.read.parquet(f"{sf}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_reliabilities_tell_good_voters_from_bad():
    # voter 0 is right, voter 1 is noise
    patterns = [("email", (1, 1, 1, 0, 0), 40.0), ("email", (1, -1, 1, 0, 0), 40.0), ("email", (-1, 1, 0, -1, 0), 30.0), ("email", (-1, -1, 0, -1, 0), 30.0)]
    prior, table = P.reliabilities(patterns)
    assert 0.4 < prior["email"] < 0.75
    assert table[0, 1, 2] > 0.9 and abs(table[1, 1, 2] - table[1, 0, 2]) < 0.2
    weights = P.classifier([(k, v, (0, 0, 0), n) for k, v, n in patterns])
    score = lambda v: sum(w * x for w, x in zip(weights, P.features("email", v, (0, 0, 0)), strict=True))
    assert score((1, -1, 1, 0, 0)) > 0 > score((-1, 1, 0, -1, 0))


def test_sweep_equals_pairwise_overlaps(spark, monkeypatch):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(50, TEXTS[2] * 30 + TEXTS[0] * 20)], "doc_id long, text string")
    want = sorted(map(str, P.digest(docs).collect()))
    assert any("n_added=0" not in w for w in want)
    monkeypatch.setattr(P, "FEW_PAIRS", -1)
    assert sorted(map(str, P.digest(docs).collect())) == want


def test_clashing_columns_and_the_flag(spark, odd_docs):
    docs = odd_docs.withColumn("cands", odd_docs["row"]).withColumn("_t", odd_docs["row"])
    out = P.digest(docs).collect()
    assert len(out) == docs.count() and not any(r["personal"] for r in out)
    assert P.digest(spark.createDataFrame([(1, "a@b.cd")], "doc_id long, text string")).first()["personal"]
