import pytest

SF = "/root/testdata/sf0.001"
WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows and columns with clashing names."""
    long = " ".join(WORDS[i * 7 % 20] + str(i % 97) for i in range(30_000))
    rows = [
        (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 3, "x"), (1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 3, "x"), (2, None, "en", "a", None, "x"),
        (3, "", None, None, 0, None), (4, "   \n\t ", "en", "b", 5, "x"), (5, long, "en", None, 1, "x"), (None, "alpha beta", "en", "c", 2, "y"), (6, "alpha", "en", "c", 2, "y"),
        (7, "Alpha BETA gamma delta epsilon zeta eta theta", "de", "a", 3, "x"), (8, "alpha\x01beta \x02 \U0001f600 née", "fr", "c", 2, None), (9, long + " more", "en", "b", 1, "x"),
    ]
    names = "doc_id long, text string, lang string, source string, n_chars long, row string"
    docs = spark.createDataFrame(rows, names)
    for clash in ("cls", "label", "mix_key", "text_md5", "word", "part", "quality", "quality_score", "score"):
        docs = docs.withColumn(clash, docs["row"])
    return docs


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
