"""Corpus operators return whole results."""

from folio.operators import corpus


def test_capped_keeps_every_hit(spark):
    rows = [("a", i, 3450 + i) for i in range(9)] + [("a", 3, 10), ("a", 20, 3449), ("b", 1, 7)]
    got = {r.log: (r.tasks, r.hits, r.top) for r in corpus.capped(spark.createDataFrame(rows, "log string, task int, tokens int"), 3500).collect()}
    assert got == {"a": (10, 9, ",".join(str(3450 + i) for i in range(8, -1, -1))), "b": (1, 0, "")}
