import public_tokenizers
import pytest

SCHEMA = "doc_id long, text string"


@pytest.fixture
def docs(spark):
    """A small documents table, with extra columns whose names clash with those that operators add."""

    def make(rows, extra=False):
        df = spark.createDataFrame(rows, SCHEMA).repartition(3)
        if extra:
            from pyspark.sql import functions as F

            for name in ("n_lines", "n_dropped", "verdict", "leaks", "spans", "_id", "_lost", "n_tokens", "fingerprint", "hashes"):
                df = df.withColumn(name, F.lit("clash"))
        return df

    return make


@pytest.fixture(scope="session")
def words_file():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def pieces_file():
    return public_tokenizers.path("piece_bpe_32k.model")
