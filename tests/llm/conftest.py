import random

import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    """(doc_id, text) of the smallest test table, with edge cases behind them."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    rng = random.Random(5)
    words = ["alpha", "Beta", "gamma,", "été", "x1", "delta.", "the", "of", "zeta", "ETA"]
    long_text = " ".join(rng.choice(words) + str(rng.randrange(300)) for _ in range(6_000))
    edge = [None, "", "   \n\t ", "one", "one two", "A b\x0bc\x1cd e", "İstanbul ŞEKER ſ K", "á ë <|endoftext|> x", "don't we'll 12 3.4 #$%", "日本語 テキスト 😀", long_text, long_text, "word " * 5000]
    return rows + [(100_000 + i, t) for i, t in enumerate(edge)] + [(None, "no id here"), (100_001, "")]


@pytest.fixture(scope="session")
def frame(spark, documents):
    """The documents with extra columns whose names clash with those that operators add."""
    return spark.createDataFrame([(d, t, 1, "x", 2.0) for d, t in documents], "doc_id long, text string, key int, fp string, g double").repartition(3)
