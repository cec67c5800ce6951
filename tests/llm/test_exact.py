import hashlib
import re

import pytest

from folio.llm.exact import exact_dedup

TEXTS = ["a b", "a  b", "a\tb", "a\n\x0b b", "b", None, "", " ", "  ", "x" * 100_000, "x" * 100_000, "a b", "é", "e"] + [f"t{i % 40}" for i in range(100)]


@pytest.mark.parametrize("bits", [1 << 15, 1 << 28])
def test_against_a_dictionary(spark, bits):
    rows = [((i * 37) % 1009, t, "k") for i, t in enumerate(TEXTS)] + [(5000, "twice", "k"), (5000, "twice", "l"), (None, "b", "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, sha string").repartition(4)
    got = exact_dedup(df, most_bits=bits).collect()
    norm = lambda t: re.sub(r"[\x20\x09-\x0d]+", " ", t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append(i)
    assert len(got) == len(rows)
    least = lambda ids: None if None in ids else min(ids)
    want = sorted((str(i), str(least(groups[norm(t)])), len(groups[norm(t)]), hashlib.sha256(norm(t).encode()).hexdigest()) for i, t, _ in rows)
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.text_sha256) for r in got) == want
    for r in got:
        assert not r.kept or r.doc_id == r.keep_id
    assert sum(r.kept for r in got) == len(groups)
    assert exact_dedup(df.limit(0)).count() == 0


def test_one_group_of_most_rows(spark):
    """The same result when groups are too many to be sent."""
    rows = [(i, "same  text" if i % 3 else f"text {i % 50}") for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    sent, dealt = (sorted(map(tuple, exact_dedup(df, sent=n).collect())) for n in (500_000, 2))
    assert sent == dealt and sum(r[3] for r in sent) == 1 + len({t for i, t in rows if not i % 3})
