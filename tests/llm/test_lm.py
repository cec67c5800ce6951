"""The model against plain dictionaries."""

import math
import re
import zlib
from collections import Counter

import pytest

from folio.llm import lm

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def toks(t):
    return WORD.findall((t or "").translate(LOWER)) + [None]


def brute(train, texts):
    uni, bi = Counter(), Counter()
    for t in train:
        w = toks(t)
        uni.update(w)
        bi.update(zip(["<s>", *[(x,) for x in w[:-1]]], w))
    n, v = sum(uni.values()), len(uni)
    ctx = Counter()
    for (a, _), c in bi.items():
        ctx[a] += c
    second = Counter(b for _, b in bi)
    d2 = lm.discounts([sum(c == k for c in bi.values()) for k in (1, 2, 3, 4)])
    d1 = lm.discounts([sum(c == k for c in second.values()) for k in (1, 2, 3, 4)])
    types = len(bi)
    d = lambda ds, c: 0 if not c else ds[min(c, 3) - 1]
    left1 = sum(d(d1, c) for c in second.values()) / types if types else 1
    left2 = Counter()
    for (a, _), c in bi.items():
        left2[a] += d(d2, c)
    out = []
    for t in texts:
        w = toks(t)
        base = sum(math.log10((uni[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        s = 0.0
        for a, b in zip(["<s>", *[(x,) for x in w[:-1]]], w):
            low = ((second[b] - d(d1, second[b])) / types if types else 0) + left1 / (v + 1)
            s += math.log10((bi[a, b] - d(d2, bi[a, b])) / ctx[a] + left2[a] / ctx[a] * low if ctx[a] else low)
        out.append((len(w), sum(uni[x] > 0 for x in w), n, base, s))
    return out


TEXTS = ["The cat sat on the mat", "the cat sat\non the hat", "A dog. a dog", "", None, "the the the the", "É é ÀÉ x\ty", "cat sat on the mat " * 40, "zzz qqq the", "the cat"]


@pytest.mark.parametrize("shard", [60, 10_000_000])
def test_against_dictionaries(spark, shard):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS * 2)], "doc_id long, text string").repartition(4)
    held = {i for i in range(2 * len(TEXTS)) if zlib.crc32(str(i).encode()) % 10 == 0}
    marked = docs.withColumn("out", lm.remainder("doc_id", 10) == 0)
    model = lm.train(marked.filter("NOT out"), shard_bytes=shard)
    want = brute([t for i, t in enumerate(TEXTS * 2) if i not in held], TEXTS * 2)
    rows = lm.score(marked, model, carry=["doc_id", "out"]).collect()
    assert len(rows) == 2 * len(TEXTS)
    for r in rows:
        w = want[r.doc_id]
        assert r.out == (r.doc_id in held)
        assert (r.n_tokens, r.n_known, model.tokens) == w[:3]
        assert r.base_score == pytest.approx(w[3], rel=1e-9) and r.score == pytest.approx(w[4], rel=1e-6)


def test_probabilities_sum_to_one(spark):
    model = lm.train(spark.createDataFrame([(t,) for t in TEXTS], "text string"), shard_bytes=50)
    vocabulary = sorted({x for t in TEXTS for x in toks(t) if x is not None})
    import numpy as np
    import pyarrow as pa

    # p(w | the), for all words, the end and any unknown word
    total = 0.0
    for w in [*vocabulary, "neverseen"]:
        both = model.score(*lm.flat(pa.array([f"the {w}"])))[3]
        end = np.log10(_p_end(model, w))
        first = np.log10(_p_first(model, "the"))
        total += 10 ** (both[0] - end - first)
    total += _p_end(model, "the")
    assert total == pytest.approx(1, rel=1e-6)


def _p_end(model, w):
    import pyarrow as pa

    a = model.score(*lm.flat(pa.array([w])))[3][0]
    return 10**a / _p_first(model, w)


def _p_first(model, w):
    import numpy as np
    import pyarrow as pa

    tok, before, _ = lm.tokens(*lm.flat(pa.array([w])))
    token, index = np.unique(np.r_[tok[:1], before[:1]], return_inverse=True)
    count, second, weight = model.look_up(token)
    i, j = index[0], index[1]
    both = model.bigram_counts(lm._deal(before[:1], tok[:1], model.hot, model.shards), lm._key(before[:1], tok[:1]))[0]
    d1, d2 = np.r_[0.0, model.d1], np.r_[0.0, model.d2]
    low = (second[i] - d1[min(second[i], 3)]) / model.types + model.left / (model.distinct + 1)
    return (both - d2[min(both, 3)]) / count[j] + weight[j] * low


def test_empty_training(spark):
    none = spark.createDataFrame([], "text string")
    model = lm.train(none)
    r = lm.score(spark.createDataFrame([("a b",)], "text string"), model).first()
    assert (r.n_tokens, r.n_known, model.tokens, r.base_score, r.score) == (3, 0, 0, 0.0, 0.0)
    assert lm.score(none, model).count() == 0
