import pytest

from brandflow.llm.shipping import ship_package

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship_package(spark)


@pytest.fixture(scope="session")
def docs(spark):
    """The whole small table."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet").cache()


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, one doc_id with two texts, clashing extra columns."""
    long = " ".join(f"w{k % 977}x{k}" for k in range(40_000))
    text = "The quick brown fox jumps over the lazy dog near the quiet river bank"
    rows = [
        (1, text, "en", "a", 70),
        (1, text, "en", "a", 70),
        (2, None, None, None, None),
        (3, "", "en", "a", 0),
        (4, "... --- !!!", "en", "b", 11),
        (5, long, "en", "b", len(long)),
        (6, "word", None, "c", 4),
        (7, "otro texto", "es", None, 10),
        (7, "un autre texte", "fr", "c", 14),
        (None, text, "en", "a", 70),
        (None, "nobody's text", None, "a", 13),
    ]
    df = spark.createDataFrame(rows, DOCUMENTS)
    for name in ("row", "key", "term", "class", "label", "score", "copy", "size", "target", "gone", "_letter", "length", "lang_pred", "n_shingles", "spans"):
        df = df.selectExpr("*", f"'{name}' AS {name}")
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOCUMENTS)
