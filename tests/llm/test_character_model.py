"""The character model of the toxicity operator counts every text."""

from tests.llm.conftest import prose
from tidemark.llm import toxicity


def test_trigrams_of_unlabelled_texts(spark):
    rows = [(i, prose(i, 40) + (" snotworm grumblefool" if i % 5 == 0 else "")) for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 5 == 0)) for i, _ in rows], "doc_id bigint, toxic int")
    docs = spark.createDataFrame([*rows, (900, "Qoxzu, " * 50), (901, "vyjk")], "doc_id bigint, text string")
    model = toxicity.fit(docs, labels)
    assert {"^^q", "^qo", "qox", "oxz", "xzu", "zu$", "vyj"} <= set(model.trigrams)
    assert model.trigrams["qox"] > model.trigrams["^^q"] > model.trigrams["^^v"]
