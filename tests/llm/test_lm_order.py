"""Models of order three and four against plain dictionaries."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from folio.llm import lm

from .test_lm import TEXTS, toks


def brute(train, texts, order):
    def grams(t):
        w = ["<s>"] * (order - 1) + [(x,) for x in toks(t)]
        return [tuple(w[i : i + order]) for i in range(len(w) - order + 1)]

    top = Counter(g for t in train for g in grams(t))
    raw = {order: top}
    for n in range(order - 1, 0, -1):
        raw[n] = Counter()
        for g, c in raw[n + 1].items():
            raw[n][g[1:]] += c
    # n-grams count how many tokens stand before them, those at the begin of a text how often they stand
    count = {order: {g: c for g, c in top.items() if order == 2 or g[1] != "<s>"}}
    for n in range(order - 1, 0, -1):
        before = defaultdict(set)
        for g in raw[n + 1]:
            before[g[1:]].add(g[0])
        count[n] = {g: raw[n][g] if g[0] == "<s>" else len(before[g]) for g in raw[n] if n < 3 or g[1] != "<s>"}
    d = {n: (0, *lm.discounts([sum(c == k for c in count[n].values()) for k in (1, 2, 3, 4)])) for n in count}
    total, left = defaultdict(int), defaultdict(float)
    for n in count:
        for g, c in count[n].items():
            total[n, g[:-1]] += c
            left[n, g[:-1]] += d[n][min(c, 3)]
    out = []
    for t in texts:
        s = 0.0
        for g in grams(t):
            p = 1 / (len(raw[1]) + 1)
            for n in range(1, order + 1):
                h = g[-n:]
                if total[n, h[:-1]] and not (n > 2 and h[1] == "<s>"):
                    c = count[n].get(h, 0)
                    p = (c - d[n][min(c, 3)] + left[n, h[:-1]] * p) / total[n, h[:-1]]
            s += math.log10(p)
        out.append((len(toks(t)), sum(raw[1][((x,),)] > 0 for x in toks(t)), s))
    return out


@pytest.mark.parametrize(("order", "shard"), [(2, 60), (3, 60), (3, 10_000_000), (4, 200)])
def test_against_dictionaries(spark, order, shard):
    texts = [*TEXTS, "on the mat a dog sat", "the cat sat on a dog", "the cat sat\non the mat a"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    train = docs.filter("doc_id % 4 <> 0")
    model = lm.train(train, shard_bytes=shard, order=order)
    want = brute([t for i, t in enumerate(texts) if i % 4], texts, order)
    for r in lm.score(docs, model, carry=["doc_id"]).collect():
        assert (r.n_tokens, r.n_known) == want[r.doc_id][:2]
        assert r.score == pytest.approx(want[r.doc_id][2], rel=1e-6)


def test_two_words_of_context_count(spark):
    docs = spark.createDataFrame([("a x b",), ("c x d",)] * 5, "text string")
    seen, unseen = ([r.score for r in lm.score(spark.createDataFrame([(t,)], "text string"), lm.train(docs, order=3)).collect()][0] for t in ("a x b", "a x d"))
    assert seen > unseen + 0.1


def test_empty(spark):
    none = spark.createDataFrame([], "text string")
    assert lm.score(spark.createDataFrame([("a b",)], "text string"), lm.train(none, order=3)).first().score == 0.0


def test_keys_are_found():
    rng = np.random.default_rng(3)
    for n in (0, 1, 5, 3000, 300_000):
        key = np.unique(rng.integers(0, 1 << 64, n, dtype=np.uint64))
        raw = lm.keyed(key)
        assert (lm.find(raw, key) == np.arange(len(key))).all()
        assert len(raw) <= 5 * len(key) + 24
        # other keys, and those that differ in the last bit that is kept
        last = np.uint64(1) << np.uint64(64 - lm.KEPT - int(raw[:4].view(np.uint32)[0]))
        others = np.setdiff1d(np.r_[rng.integers(0, 1 << 64, 1000, dtype=np.uint64), key ^ last], key)
        assert (lm.find(raw, others) == -1).all()


def test_grams_go_there_and_back():
    rng = np.random.default_rng(4)
    token = rng.integers(3, 1 << lm.BITS, 500, dtype=np.uint64)
    tok = token[np.minimum(rng.zipf(1.3, 20_000), 500) - 1]
    at = np.array([0, 0, 400, 20_000])
    for order in (2, 3, 4):
        cols, count = lm.grams(tok, at, order)
        before = np.r_[lm.BEGIN, tok[:-1]]
        before[[0, 400]] = lm.BEGIN
        want = Counter(zip(*(c.tolist() for c in lm.histories(tok, before, at[1:], order)), strict=True))
        assert dict(zip(zip(*(c.tolist() for c in cols), strict=True), count.tolist(), strict=True)) == want
        for common in (token[:1], token[:100]):
            rows = np.stack([count, count * 3], 1)
            back, counts = lm._unpack_grams(lm._pack_grams(cols, rows, common), order, common)
            assert all((x == y).all() for x, y in zip(back, cols, strict=True)) and (counts == rows).all()


def test_order_and_counts():
    rng = np.random.default_rng(5)
    h = rng.integers(0, 1 << 64, 50_000, dtype=np.uint64)
    h = np.r_[h, h[:9000], h[:50] + np.uint64(1)]
    assert (lm.order_of(h) == np.argsort(h, kind="stable")).all()
    some, number = lm.numbered(h >> np.uint64(50))
    assert (some[number] == h >> np.uint64(50)).all() and (np.diff(some.astype(np.int64)) > 0).all()
    x = rng.integers(0, 400, (1000, 4))
    assert (lm.counts_at(lm.counted(x), np.arange(1000)) == x).all()
    assert (lm.counts_at(lm.counted(x[:, 0]), np.arange(0, 1000, 3)) == x[::3, 0]).all()
