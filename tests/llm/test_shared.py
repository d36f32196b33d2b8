import public_tokenizers
import pyarrow as pa
import pytest

from ratingloom.llm import langid, packing

from .conftest import docs_frame

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def limit(spark):
    before = spark.conf.get(LIMIT)
    spark.conf.unset(LIMIT)
    yield LIMIT
    spark.conf.set(LIMIT, before)


def _operators(docs):
    return [
        lambda: langid.identify(docs, public_tokenizers.path("piece_bpe_32k.model")),
        lambda: packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")),
    ]


@pytest.mark.parametrize("which", [0, 1])
def test_texts_come_in_batches_of_bounded_bytes(spark, limit, which):
    texts = [(i, "word " * 20_000, "en", "a", 100_000) for i in range(120)]
    docs = docs_frame(spark, texts).select("doc_id", "text", "lang").repartition(1)
    _operators(docs)[which]()

    def sizes(batches):
        for batch in batches:
            columns = [[batch.num_rows], [batch.nbytes]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["n", "bytes"])

    seen = docs.mapInArrow(sizes, "n long, bytes long").collect()
    assert sum(r.n for r in seen) == 120
    assert max(r.bytes for r in seen) < 4.4e6


@pytest.mark.parametrize("which", [0, 1])
def test_a_limit_that_the_session_sets_stays(spark, none, limit, which):
    spark.conf.set(limit, "9m")
    _operators(none)[which]()
    assert spark.conf.get(limit) == "9m"
