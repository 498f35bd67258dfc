import pandas as pd
import pytest
from pyspark.sql import functions as F

from millrace.functions import registration as R
from millrace.functions import vectors as V
from millrace.operators import filters, metrics, ranking, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def keep_even(df, column="id"):
    return df.where(F.pmod(column, F.lit(2)) == 0)


def test_registration(spark):
    def mean(x: pd.Series) -> float:
        return float(x.mean())

    class Letters:  # local, so that workers need not import the tests
        def eval(self, word: str):
            for letter in word:
                yield (letter,)

    R.aggregate(spark, "own_mean", "double", mean)
    assert spark.sql("SELECT own_mean(id) AS m FROM range(5)").first()["m"] == 2.0
    R.table(spark, "letters", "letter string", Letters)
    assert [r["letter"] for r in spark.sql("SELECT * FROM letters('abc')").collect()] == ["a", "b", "c"]
    schema = spark.range(1).schema
    assert R.schema_from_json(R.type_to_json(schema)) == schema
    plan = R.Pipeline.loads(R.Pipeline([(R.dotted(keep_even), {"column": "id"})]).dumps())
    assert plan(spark.range(5)).count() == 3
    even = R.Operator(keep_even, {"id": "bigint"}, {"id": "bigint"})
    assert even(spark.range(5)).count() == 3
    with pytest.raises(TypeError):
        even(spark.range(5).select(F.col("id").cast("string").alias("id")))


def test_loop_ends_or_raises(spark):
    step = lambda d: d.select((F.col("id") + 3).alias("id"))
    done = lambda d: d.where("id < 7").isEmpty()
    assert R.bounded_loop(spark.range(1), step, done, 5).first()["id"] == 9
    with pytest.raises(RuntimeError):
        R.bounded_loop(spark.range(1), step, done, 1)


def test_documented_metric_examples(spark):
    truth = spark.createDataFrame([(0, "France"), (1, "9th century"), (1, "9th")], "qid int, doc_id string")
    run = spark.createDataFrame([(0, "France", 0), (1, "9th century", 0), (1, "10th century", 1), (1, "9th", 2)], "qid int, doc_id string, rank int")
    rows = {r["qid"]: r for r in metrics.by_query(metrics.ranked_hits(run, truth)).collect()}
    assert [rows[i]["mrr"] for i in (0, 1)] == [1.0, 1.0]
    assert rows[1]["map"] == pytest.approx(0.8333333333)
    f1 = metrics.token_f1(F.split(F.lit("a b b c"), " "), F.split(F.lit("b b d"), " "))
    assert one(spark, f1) == pytest.approx(4 / 7)


def test_null_rules_of_filters(spark):
    rows = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    ids = lambda c: [r["id"] for r in rows.where(c).orderBy("id").collect()]
    v = F.col("v")
    assert ids(filters.compare(v, "!=", 5)) == [1] and ids(filters.compare(v, ">", 1)) == [2] and ids(filters.compare(v, "==", None)) == [1]
    assert ids(filters.compare(v, "not in", [5])) == [1] and ids(filters.compare(v, "in", [5, None])) == [1, 2]
    for bad in ({"field": "v", "operator": "~", "value": 1}, {"field": "v", "operator": ">", "value": [1]}, {"operator": "AND", "conditions": []}, {"field": "v"}):
        with pytest.raises(ValueError):
            filters.compile_filter(bad)
    with pytest.raises(ValueError):
        V.similarity("nearness", v, v)


def test_text_pieces(spark):
    long = "one two three. " * 40 + "x" * 230
    chunks = one(spark, text.recursive_chunks(F.lit(long), 100))
    assert "".join(chunks) == long and max(map(len, chunks)) <= 100
    assert one(spark, text.page_ranges(F.lit("1-3,5"))) == [1, 2, 3, 5]
    assert one(spark, text.sentences(F.lit("One. Two! Three? four"))) == ["One.", "Two!", "Three?", "four"]
    assert one(spark, filters.like_number(F.lit("10,000"))) and one(spark, filters.like_number(F.lit("-1/2"))) and not one(spark, filters.like_number(F.lit("a1")))
    assert one(spark, V.gelu(F.lit(1.0))) == pytest.approx(0.841345, abs=1e-5)
    assert one(spark, V.multi_softmax(F.array(*map(F.lit, (1.0, 1.0, 5.0))), [2, 1])) == [0.5, 0.5, 1.0]
    assert one(spark, V.linear(F.array(F.lit(1.0), F.lit(2.0)), [[1, 1], [0, 2]], [0.5, 0])) == [3.5, 4.0]


def test_large_query_sets_are_dealt_in_blocks(spark):
    vectors = spark.range(1500).select(F.col("id").alias("vec_id"), F.array(F.lit(1.0)).alias("embedding"))
    out = ranking.vector_top_k(vectors, vectors, 2).collect()
    assert len(out) == 3000 and all(r["vec_id"] <= 2 for r in out)
