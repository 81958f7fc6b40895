from collections import Counter

import pytest

from stacklens.operators import tfidf


def counted(rows, low, high):
    found = Counter()
    for key, text in rows:
        words = (text or "").split()
        found.update((key, " ".join(words[i:i + n])) for n in range(low, high + 1) for i in range(len(words) - n + 1))
    return {(k, t, n) for (k, t), n in found.items()}


@pytest.mark.parametrize("low,high", [(1, 2), (2, 3), (1, 1)])
@pytest.mark.parametrize("batch", [10000, 2])
def test_counts_of_odd_texts(spark, monkeypatch, low, high, batch):
    """Keys that repeat or are null count as one text without n-grams across rows; empty and missing texts give nothing."""
    monkeypatch.setattr(tfidf, "WORDS_AT_ONCE", 5)
    rows = [(1, "aa bb aa bb"), (1, "bb aa"), (None, "cc cc cc"), (None, "cc"), (2, ""), (3, None), (4, "dd"), (5, "aa bb cc dd ee ff aa bb cc"), (5, None)]
    rows += [(6, f"w{i % 3}x yy") for i in range(9)] + [(None, "zz éé")]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        docs = spark.createDataFrame(rows, "k long, text string").repartition(3)
        got = [tuple(r) for r in tfidf.term_counts(docs, "k", "text", (low, high), ()).select("k", "term", "tf").collect()]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(got) == len(set(got)) and set(got) == counted(rows, low, high)


def test_tasks_grow_with_the_texts_and_terms_are_not_shuffled(spark, monkeypatch):
    """One exchange, of the texts, into as many partitions as their size asks for."""
    monkeypatch.setattr(tfidf, "CHARS_PER_TASK", 100)
    docs = spark.createDataFrame([(i, "some words of a text " * 5) for i in range(40)], "k long, text string")
    plan = tfidf.term_counts(docs, "k", "text")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Exchange hashpartitioning(k" in plan and "HashAggregate" not in plan
    assert ", 42)" in plan.split("Exchange hashpartitioning")[1].split("\n")[0] or ", 42," in plan
