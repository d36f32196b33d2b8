import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the old river runs past many quiet houses and never stops to rest in winter".split()


def long_text(n=3000):
    return " ".join(WORDS[(i * i + i // 7) % len(WORDS)] + str(i % 11) for i in range(n))


ODD = [
    (0, long_text(), "en", "a", 1),
    (1, None, "en", "a", None),
    (2, "", None, None, 0),
    (3, " \n\t \r\n", "en", "b", 5),
    (4, "one two three", "en", "b", 13),
    (5, "one two three", "de", None, 13),
    (6, "One TWO three", "en", "c", 13),
    (7, "Straße ÄÖÜ ñandú 😀   x", "de", "c", 20),
    (8, "123 456 !!! ???", "en", "a", 15),
    (9, "x" * 5000, "en", "a", 5000),
    (10, long_text() + " tail", "en", "a", 1),
    (None, "no id here but some words", "en", "a", 5),
    (12, "<|endoftext|> it's , a test's", "en", "b", 5),
    (12, "<|endoftext|> it's , a test's", "en", "b", 5),
]


def docs_frame(spark, rows):
    """Documents with more columns, named like those that operators make for themselves."""
    frame = spark.createDataFrame(rows, DOCS)
    names = (
        "node component_id kept size taken line row chunk score key place bucket label doc id lines "
        "drop copies copy own own_id own_size again gone hashed number rejected range __id __lines"
    ).split()
    return frame.withColumns({n: F.lit("clash") for n in names})


@pytest.fixture(scope="session")
def odd(spark):
    return docs_frame(spark, ODD).repartition(3).persist()


@pytest.fixture(scope="session")
def none(spark):
    return docs_frame(spark, [])


@pytest.fixture(scope="session")
def small(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


@pytest.fixture(scope="session")
def small_rows(small):
    return [r.asDict() for r in small.collect()]


def by_id(df, key="doc_id"):
    out = {}
    for row in df.collect():
        out.setdefault(row[key], []).append(row)
    return out
