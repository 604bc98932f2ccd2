import random

import pytest

from conftest_llm import DOCUMENT, words

@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="session")
def odd_texts():
    """Texts with every awkward case: null, empty, blank, one word, repeated lines, signs, other scripts, very long."""
    rnd = random.Random(3)
    return [None, "", " \n\t ", "One", "a a a a a a", "x\n\nx\r\ny\x0bz\x1cq", "don't STOP l'été Éa ß 12 3½ á Σς 漢字 かな 　 \xa0 <|endoftext|>", "### $$$ %%% | <b>", "same line\nsame line\nother\nsame line", " ".join(words(rnd, 30000))]


@pytest.fixture()
def documents(spark, odd_texts):
    """A documents table of the odd texts, with repeated rows, a null id and columns whose names clash with those inside."""
    rows = [(k, text, "en", f"src{k % 2}", 1) for k, text in enumerate(odd_texts)]
    rows += [rows[3], rows[3], (None, "no id here", None, None, None)]
    table = spark.createDataFrame(rows, DOCUMENT)
    from pyspark.sql import functions as F
    for name in ("score", "slot", "rep", "label", "kept", "component_id", "hash", "n", "rank", "y", "items", "path", "looks", "__text", "__rejected", "__Quality_Score", "row", "rep_"):
        table = table.withColumn(name, F.lit("clash"))
    return table


@pytest.fixture()
def no_documents(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture()
def labels(spark):
    schema = "doc_id long, quality int, toxic int"
    return lambda rows: spark.createDataFrame([(d, q, 0) for d, q in rows], schema)
