import public_tokenizers
import pytest
from pyspark.sql import types as T

from basketry.llm.scratch import importable

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

#: What every operator must take: nulls, no words, long texts, ties, repeated rows.
ODD_ROWS = [
    (1, None, "en", "a", None),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, None, 3),
    (4, "word " * 30_000, "en", "a", 150_000),
    (5, "The same short text.", "en", "b", 20),
    (5, "The same short text.", "en", "b", 20),
    (6, "The same short text.", "en", "b", 20),
    (None, "A text without an id, and one that is a little longer.", "de", None, 5),
    (None, None, None, None, None),
    (7, "!!! ... 123", None, "c", 11),
    (8, "x" * 70_000, "fr", "c", 70_000),
    (9, "Größe und Übermut\nGröße und Übermut\n", "de", "c", 36),
]


@pytest.fixture(scope="module")
def docs(spark):
    importable(spark)

    def build(rows=ODD_ROWS):
        return spark.createDataFrame(rows, DOCUMENTS)

    return build


@pytest.fixture
def byte_tokenizer():
    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def word_tokenizer():
    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def sf(spark):
    importable(spark)
    return "/root/testdata/sf0.001"
