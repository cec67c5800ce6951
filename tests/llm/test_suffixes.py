"""Removed bytes against a plain dictionary of all windows."""

import hashlib
import random

from folio.llm import suffixes
from folio.llm.suffixes import remove_repeats


def brute(docs):
    """{(doc_id, text): (n_bytes, n_removed, n_spans, sha256)}"""
    where = {}
    raw = sorted({(-(1 << 63) if i is None else i, (t or "").encode()) for i, t in docs})
    for d, b in raw:
        for p in range(len(b) - 99):
            where.setdefault(b[p : p + 100], (d, p))
    out = {}
    for d, b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - 99):
            if where[b[p : p + 100]] < (d, p):
                gone[p : p + 100] = [True] * 100
        rest = bytes(c for c, g in zip(b, gone) if not g)
        out[d, b] = (len(b), sum(gone), sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone)), hashlib.sha256(rest).hexdigest())
    return out


def sample(seed, n=60):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdeé ") for _ in range(r.randint(1, 9))) for _ in range(400)]
    say = lambda k: " ".join(r.choice(words) for _ in range(k))
    shared = [say(k) for k in (10, 18, 20, 25, 60, 200)]
    texts = []
    for _ in range(n):
        parts = [say(r.randint(0, 60))] + [r.choice(shared)] * r.choice([0, 1, 1, 2]) + [say(r.randint(0, 40))]
        t = r.choice(["", " "]).join(parts)
        if texts and r.random() < 0.25:
            t = r.choice(texts)
        if texts and r.random() < 0.25:
            b = list(r.choice(texts))
            for _ in range(3):
                if b:
                    b[r.randrange(len(b))] = "#"
            t = "".join(b)
        texts.append(t)
    texts += ["", None, "x" * 1000, "ab" * 300, "x" * 99, "x" * 100]
    return [(i * 7 % 101, t) for i, t in enumerate(texts)]


def check(spark, docs, **kw):
    want = brute(docs)
    df = spark.createDataFrame([(i, t, "clash") for i, t in docs], "doc_id long, text string, spans string").repartition(5)
    got = remove_repeats(df, carry=["text"], with_text=True, **kw).collect()
    assert len(got) == len(docs)
    for r in got:
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == want[-(1 << 63) if r.doc_id is None else r.doc_id, (r.text or "").encode()]
        assert len(r.kept_text.encode()) <= r.n_bytes - r.n_removed


def test_against_all_windows(spark):
    for seed in (1, 2):
        check(spark, sample(seed), batch_shard=4000)


def test_repeated_and_null_ids(spark):
    t = "word " * 80 + "other " * 40
    check(spark, [(3, t), (3, t), (None, "q" + t), (1, t[7:]), (1, t[20:] + "z")])


def test_long_texts_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PIECE", 700)
    docs = sample(3, 30)
    data, begin = suffixes.flat(__import__("pyarrow").array([t for _, t in docs]))
    seen = set()
    for part, b, first, offset in suffixes.pieces(data, begin):
        assert len(part) <= 700
        for k in range(len(b) - 1):
            seen |= {(first + k, offset + p) for p in range(int(b[k + 1] - b[k]) - 99)}
    assert seen == {(i, p) for i, (_, t) in enumerate(docs) for p in range(len((t or "").encode()) - 99)}


def test_empty_table(spark):
    assert remove_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
