import random

import numpy as np
import pyarrow as pa
import pytest

from folio.llm import classifier as c
from folio.llm.common import flat


def test_gradients():
    net = c.Net.new(3)
    net.bias += 0.1
    texts = [b"hello world " * 60, b"A!! B!!" * 3, b"", bytes(range(256)) * 3]
    y = np.array([1, 0, 1, 0], np.float32)
    data, begin = np.frombuffer(b"".join(texts), np.uint8), np.r_[0, np.cumsum([len(t) for t in texts])]

    def loss():
        p = net.score(data, begin)
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    for x, g in list(zip(net.arrays(), net.gradients(data, begin, y))):
        i = np.unravel_index(np.abs(g).argmax(), x.shape)
        old = x[i]
        x[i] = old + 1e-3
        a = loss()
        x[i] = old - 1e-3
        b = loss()
        x[i] = old
        assert g[i] == pytest.approx((a - b) / 2e-3, rel=0.05)


def texts(n, seed):
    r = random.Random(seed)
    out = []
    for i in range(n):
        w = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(r.randint(3, 200))]
        y = r.random() < 0.7
        out.append((i, " ".join(w if y else [x + "$$" for x in w]), int(y)))
    return out


def test_learns_and_scores_everything(spark):
    rows = texts(600, 1)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows] + [(900, None), (901, ""), (None, "x"), (902, "good " * 300_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(5, None), (None, 1), (900, 1)], "doc_id long, quality int")
    sample = c.training_sample(docs, labels, n=300)
    assert sorted(sample[0]) != sorted(c.training_sample(docs, labels, n=300, longest=50)[0]) and max(map(len, c.training_sample(docs, labels, n=300, longest=50)[0])) == 50
    assert len(sample[0]) == 300
    net = c.fit(*sample, epochs=6)
    got = {r.doc_id: r.score for r in c.classify(docs, net, carry=["doc_id"]).collect()}
    assert len(got) == 604 and all(0 <= s <= 1 for s in got.values())
    held = [(y, got[i]) for i, _, y in rows if __import__("zlib").crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(s >= 0.3) == y for y, s in held]) > 0.97
    assert c.classify(docs.limit(0), net, carry=["doc_id"]).count() == 0


def test_long_texts_in_parts(monkeypatch):
    net = c.Net.new(2)
    for n in (1, 255, 256, 257, 5000, 5121):
        data, begin = flat(pa.array(["ab ϵ" * n]))
        whole = net.score(data, begin)
        monkeypatch.setattr(c, "AT_ONCE", 1024)
        assert c._long(net, data) == pytest.approx(whole, abs=1e-6)
        monkeypatch.undo()


def test_no_labels(spark):
    docs, labels = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([], "doc_id long, quality int")
    net = c.fit(*c.training_sample(docs, labels))
    assert 0 <= c.classify(docs, net).first().score <= 1


def plain(net, text):
    """The network's score by loops over one text."""
    halves = max(-(-len(text) // c.HALF), 1)
    padded = list(text) + [256] * (halves * c.HALF - len(text))
    best = []
    for h in range(halves):
        values = []
        for p in range(h * c.HALF, (h + 1) * c.HALF, c.STRIDE):
            if p + c.WIDTH <= len(padded):
                values.append(net.embed[padded[p : p + c.WIDTH]].reshape(-1).astype(float) @ net.filters)
        best.append(np.max(values, 0))
    chunks = [np.maximum(np.maximum(best[h], best[min(h + 1, halves - 1)]) + net.bias, 0) for h in range(halves)]
    z = np.r_[np.mean(chunks, 0), np.max(chunks, 0)] @ net.last + net.offset[0]
    return 1 / (1 + np.exp(-z))


def test_score_is_of_the_text_alone(spark):
    r = random.Random(5)
    net = c.Net.new(4)
    raw = ["", "a", "x" * 256, "y€" * 300] + ["".join(r.choice("abc é$!") for _ in range(r.choice([3, 200, 244, 250, 255, 257, 511, 900]))) for _ in range(40)]
    want = {t: plain(net, t.encode()) for t in raw}
    for order in (raw, raw[::-1], sorted(raw, key=len)):
        for size in (1, 7, len(order)):
            for a in range(0, len(order), size):
                data, begin = flat(pa.array(order[a : a + size]))
                assert net.score(data, begin) == pytest.approx([want[t] for t in order[a : a + size]], abs=1e-6)
    docs = spark.createDataFrame([(t, 9.0) for t in [*raw, *raw, None]], "text string, score double")
    for parts in (1, 7):
        got = c.classify(docs.repartition(parts), net, carry=["text", "score"]).collect()
        assert len(got) == 2 * len(raw) + 1 and all(x.score == pytest.approx(want[x.text or ""], abs=1e-6) for x in got)
