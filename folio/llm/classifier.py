"""Quality classifier (8): a byte-level convolutional network in numpy, over overlapping chunks of the whole text."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, remainder, runs

#: Bytes of a chunk's half (chunks overlap by one half), of a filter, between two places of a filter; numbers for a byte; filters.
HALF, WIDTH, STRIDE, EMBED, FILTERS = 256, 16, 4, 6, 32
#: Labelled texts that the network learns from, at most, and characters of the longest runs of them; rounds over them, texts in a step.
SAMPLE, LONGEST, EPOCHS, STEP = 3000, 65_536, 8, 32
#: Bytes that are scored at once.
AT_ONCE = 1_000_000
THRESHOLD = 0.3


@dataclass
class Net:
    """Weights: bytes' numbers, filters with bias, and the last layer over means and maxima of the chunks."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    last: np.ndarray
    offset: np.ndarray

    @classmethod
    def new(cls, seed: int = 1) -> Net:
        r = np.random.default_rng(seed)
        return cls(
            r.normal(0, 0.5, (257, EMBED)).astype(np.float32),
            (r.normal(0, 1, (WIDTH * EMBED, FILTERS)) / np.sqrt(WIDTH * EMBED * 0.25)).astype(np.float32),
            np.zeros(FILTERS, np.float32),
            r.normal(0, 0.1, 2 * FILTERS).astype(np.float32),
            np.zeros(1, np.float32),
        )

    def arrays(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.last, self.offset]

    def laid(self, data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The texts' bytes, each from a new half chunk on, padded with 256; and how many halves stand before each text."""
        size = np.diff(begin)
        halves = np.maximum(-(-size // HALF), 1)
        at = np.r_[0, np.cumsum(halves)]
        out = np.full(int(at[-1]) * HALF + WIDTH, 256, np.int16)
        out[np.arange(len(data)) + np.repeat(at[:-1] * HALF - begin[:-1], size)] = data
        return out, at

    def patches(self, laid: np.ndarray) -> np.ndarray:
        """A row for each place of the filters: the numbers of its WIDTH bytes."""
        x = self.embed[laid].reshape(-1)
        n = (len(laid) - WIDTH) // STRIDE
        return np.lib.stride_tricks.as_strided(x, (n, WIDTH * EMBED), (STRIDE * EMBED * 4, 4), writeable=False)

    def placed(self, laid: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The filters at each place, by halves. The last places of a text's last half would reach into the next text: they never count, and the place before them ends where the half does."""
        made = (self.patches(laid) @ self.filters).reshape(-1, HALF // STRIDE, FILTERS)
        made[at[1:] - 1, HALF // STRIDE - (WIDTH // STRIDE - 1) :] = -np.inf
        return made

    def pooled(self, laid: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest value of each filter in each half chunk, and its place."""
        made = self.placed(laid, at)
        place = made.argmax(1)
        return np.take_along_axis(made, place[:, None], 1)[:, 0], place + np.arange(len(made))[:, None] * (HALF // STRIDE)

    def chunks(self, halves: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The maxima of each chunk, a half and the next of the same text, and which halves hold them."""
        own = np.arange(len(halves))
        after = np.minimum(own + 1, np.repeat(at[1:], np.diff(at)) - 1)
        second = halves[after] > halves
        return np.where(second, halves[after], halves), np.where(second, after[:, None], own[:, None])

    def features(self, laid: np.ndarray, at: np.ndarray) -> np.ndarray:
        """For each text the mean and the largest over its chunks, after the rectifier."""
        halves = self.placed(laid, at).max(1)
        chunk = np.maximum(self.chunks(halves, at)[0] + self.bias, 0)
        mean = np.add.reduceat(chunk, at[:-1]) / np.diff(at)[:, None]
        return np.hstack([mean, np.maximum.reduceat(chunk, at[:-1])])

    def score(self, data: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if len(begin) < 2:
            return np.zeros(0)
        z = self.features(*self.laid(data, begin)).astype(np.float64) @ self.last + self.offset[0]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradients(self, data: np.ndarray, begin: np.ndarray, label: np.ndarray) -> list[np.ndarray]:
        """Of the mean logistic loss over the texts."""
        laid, at = self.laid(data, begin)
        halves, place = self.pooled(laid, at)
        raw, which = self.chunks(halves, at)
        raw = raw + self.bias
        chunk = np.maximum(raw, 0)
        n, texts = np.diff(at), len(begin) - 1
        mean = np.add.reduceat(chunk, at[:-1]) / n[:, None]
        top = np.maximum.reduceat(chunk, at[:-1])
        x = np.hstack([mean, top])
        p = 1 / (1 + np.exp(-np.clip(x @ self.last + self.offset[0], -30, 30)))
        dz = ((p - label) / texts).astype(np.float32)
        dx = dz[:, None] * self.last[None, :]
        text = np.repeat(np.arange(texts), n)
        is_top = chunk == top[text]
        ties = np.add.reduceat(is_top.astype(np.float32), at[:-1])
        dchunk = dx[text, :FILTERS] / n[text, None] + dx[text, FILTERS:] * is_top / ties[text]
        dchunk *= raw > 0
        k = np.arange(FILTERS)[None, :]
        spot = place[which, k]  # the place of the filter that each chunk's value comes from
        patches = self.patches(laid)
        dfilters, dembed = np.zeros_like(self.filters), np.zeros_like(self.embed)
        for f in range(FILTERS):
            some = np.flatnonzero(dchunk[:, f])
            if not len(some):
                continue
            g, s = dchunk[some, f], spot[some, f]
            dfilters[:, f] = patches[s].T @ g
            own = laid[(s * STRIDE)[:, None] + np.arange(WIDTH)[None, :]]
            into = g[:, None, None] * self.filters[:, f].reshape(1, WIDTH, EMBED)
            flat_index = own.reshape(-1)
            for e in range(EMBED):
                dembed[:, e] += np.bincount(flat_index, into[:, :, e].reshape(-1), minlength=257).astype(np.float32)
        return [dembed, dfilters, dchunk.sum(0), x.T @ dz, np.array([dz.sum()], np.float32)]


def fit(texts: list[bytes], labels: list[float], epochs: int = EPOCHS, seed: int = 1, rate: float = 0.01) -> Net:
    """A network trained by Adam on whole texts. With no texts, or one label only, it starts at that label's share."""
    net, r = Net.new(seed), np.random.default_rng(seed)
    y = np.array(labels, np.float32)
    share = float(np.clip(y.mean(), 0.01, 0.99)) if len(y) else 0.5
    net.offset[0] = np.log(share / (1 - share))
    if not len(y):
        return net
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in net.arrays()]
    steps, total = 0, epochs * -(-len(y) // STEP)
    for _ in range(epochs):
        order = r.permutation(len(y))
        for a in range(0, len(order), STEP):
            some = order[a : a + STEP]
            raw = [texts[i] for i in some]
            begin = np.r_[0, np.cumsum([len(t) for t in raw])]
            steps += 1
            now = rate * (1 - steps / (total + 1))
            grads = net.gradients(np.frombuffer(b"".join(raw), np.uint8), begin, y[some])
            for x, g, (m, v) in zip(net.arrays(), grads, moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                x -= now * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-7)
    return net


def training_sample(docs: DataFrame, labels: DataFrame, label: str = "quality", n: int = SAMPLE, longest: int = LONGEST) -> tuple[list[bytes], list[float]]:
    """At most n labelled texts, those of the least hashed ids, with their labels; of texts with more characters than `longest` a run of so many, at a place that the id's hash gives.

    Only this sample is bounded; it comes to the driver. Labels that are null are left out, of several for one id the mean counts,
    rounded. Of rows repeated with one id the least text is taken; a null text is empty, a null id never taken.
    """
    marks = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.round(F.avg(label)).alias("label"))
    run = F.expr(f"CASE WHEN length(text) > {longest} THEN substring(text, cast(pmod(xxhash64(doc_id), length(text) - {longest}) AS int) + 1, {longest}) ELSE text END")
    fit_docs = docs.select("doc_id", F.coalesce(run, F.lit("")).alias("text")).filter(remainder("doc_id", 5) != 0)
    some = marks.filter(remainder("doc_id", 5) != 0).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    rows = fit_docs.join(F.broadcast(some), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.min("label").alias("label"))
    got = rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(n).collect()
    return [(r.text or "").encode() for r in got], [float(r.label) for r in got]


def classify(docs: DataFrame, net: Net, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns carry of docs with score, the probability of label 1, from 0 to 1; every byte of every text is read.

    A score is a function of its text alone: neither the batch nor the order of rows matters. A null text is empty, and
    scored as such. Repeated rows are scored each by itself; an empty table gives no rows; a column in carry that is
    named score is replaced by the new one.
    """
    weights = net.arrays()
    carry = [c for c in carry or [] if c != "score"]

    def run(batches):
        own = Net(*weights)
        for batch in batches:
            data, begin = flat(batch.column(0))
            scores = [np.zeros(0)]
            for first, last in runs(begin, AT_ONCE):
                lo, hi = int(begin[first]), int(begin[last])
                scores.append(own.score(data[lo:hi], begin[first : last + 1] - lo) if hi - lo <= 4 * AT_ONCE else _long(own, data[lo:hi]))
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(np.concatenate(scores))], names=[*batch.schema.names[1:], "score"])

    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text_"), *[F.col(f"`{c}`") for c in carry])
    return rows.mapInArrow(run, "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:]) + "score double")


def _long(net: Net, data: np.ndarray) -> np.ndarray:
    """The score of one very long text, whose chunks are made part by part; a part begins where the next chunk would."""
    total, top, n = np.zeros(FILTERS), np.zeros(FILTERS, np.float32), 0
    whole = -(-len(data) // HALF)
    step = AT_ONCE // HALF
    for a in range(0, whole, step):
        part = data[a * HALF : (a + step + 2) * HALF]  # two halves more, for the last chunk and its last filters
        laid, at = net.laid(part, np.array([0, len(part)]))
        halves = net.placed(laid, at).max(1)
        chunk = np.maximum(net.chunks(halves, at)[0][:step] + net.bias, 0)
        total, top, n = total + chunk.sum(0), np.maximum(top, chunk.max(0)), n + len(chunk)
    z = float(np.r_[total / n, top] @ net.last + net.offset[0])
    return np.array([1 / (1 + np.exp(-np.clip(z, -30, 30)))])


def op8_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    net = fit(*training_sample(docs, labels))
    done = classify(docs, net, carry=["doc_id"])
    return done.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
