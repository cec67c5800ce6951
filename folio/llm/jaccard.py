"""N-gram Jaccard join (9): an LSH forest of MinHash signatures, then exact verification in blocks.

Every tree of the forest is a prefix trie of signatures of DEPTH values, held as sorted rows: the texts below a node are
neighbours. Matched prefixes are shortened level by level from the full depth, in each part of a tree until all its texts
are linked or the depth is reached at which a pair at the threshold has met in some tree as surely as RECALL asks. Texts
of one node become candidates only if their whole signatures agree in enough values, so that pairs which are merely
somewhat alike don't chain up; candidates form components, and a component's pairs are verified exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SENT, dealt_join, flat, give_back, mix, packed, prefix_hash, runs, span_hash, table, words
from .components import components

#: Words in a shingle; a pair is linked from a Jaccard similarity of 4/5 on.
SHINGLE, SIMILAR = 5, (4, 5)
#: Trees of the forest, their full depth, and the recall at the threshold until which prefixes are shortened.
TREES, DEPTH, RECALL = 24, 12, 0.9999
#: Values of two whole signatures that agree at least, of 288: at similarity 0.8 it is 231, and 178 is 7 standard deviations less; at 0.5 it is 145.
AGREE = 178
#: Texts that are compared at once.
BLOCK = 1000
#: Bytes of text that are hashed at once.
CHUNK = 2_000_000
_NONE = -(1 << 63)


def shallowest(similar: float, trees: int = TREES, depth: int = DEPTH, recall: float = RECALL) -> int:
    """The least shortening, from the full depth on, at which a pair of that similarity has met in a tree as surely as asked."""
    while depth > 1 and 1 - (1 - similar**depth) ** trees < recall:
        depth -= 1
    return depth


def shingles(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, how many before each text, hash of each text's words): the distinct shingles of each text, sorted.

    A text of fewer words than a shingle has one shingle, of all its words; a text without words has none.
    """
    start, end, at = words(data, begin)
    w = span_hash(prefix_hash(data), start, end)
    n = np.diff(at)
    base = np.uint64(0xD1342543DE82EF95)
    text = np.repeat(np.arange(len(n)), n)
    i = np.flatnonzero(np.arange(len(w)) + SHINGLE <= at[text + 1]) if len(w) else np.zeros(0, np.int64)
    h = np.zeros(len(i), np.uint64)
    for k in range(SHINGLE):
        h = h * base + w[i + k]
    h, of = mix(h), text[i] if len(w) else i
    # the words of a text in order, as one number: a prefix hash over words
    power = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(len(w), 1), base, np.uint64)])
    back = np.multiply.accumulate(np.r_[np.uint64(1), np.full(max(len(w), 1), pow(int(base), -1, 1 << 64), np.uint64)])
    s = np.r_[np.uint64(0), np.cumsum(w * power[: len(w)], dtype=np.uint64)]
    all_words = mix((s[at[1:]] - s[at[:-1]]) * back[at[:-1]] + n.astype(np.uint64))
    few = np.flatnonzero((n > 0) & (n < SHINGLE))
    h, of = np.r_[h, mix(all_words[few] + np.uint64(1))], np.r_[of, few]
    by = np.lexsort((h, of))
    h, of = h[by], of[by]
    new = np.r_[True, (h[1:] != h[:-1]) | (of[1:] != of[:-1])] if len(h) else np.zeros(0, bool)
    h, of = h[new], of[new]
    return h, np.searchsorted(of, np.arange(len(n) + 1)), all_words


def signatures(h: np.ndarray, at: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """For each text with shingles a row of trees * depth MinHash values, a byte each: tree after tree, from its root down."""
    some = np.flatnonzero(np.diff(at))
    out = np.zeros((len(some), trees * depth), np.uint8)
    if len(some):
        first = at[:-1][some]
        for i, factor in enumerate(mix(np.arange(1, trees * depth + 1, dtype=np.uint64)) | np.uint64(1)):
            # the least of many is near 0: mixed again, so that all bytes are as likely
            out[:, i] = mix(np.minimum.reduceat(h * factor, first)) >> np.uint64(56)
    return out


def trie_links(own: np.ndarray, whole: np.ndarray, least: int, agree: int) -> np.ndarray:
    """A label for each of the texts of a part of a tree, in the trie's order: the first text that it is linked with, over any number of links.

    own has their signatures in this tree, whole in all trees. From the full depth on prefixes are shortened down to
    `least`; where not all texts below a node are linked yet they are compared.
    """
    m, depth = own.shape
    label = np.arange(m)
    if m < 2:
        return label
    differ = own[1:] != own[:-1]
    common = np.where(differ.any(1), differ.argmax(1), depth)
    for d in range(depth, least - 1, -1):
        cut = np.r_[0, np.flatnonzero(common < d) + 1, m]
        for a, z in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            if z - a < 2 or (label[a:z] == label[a]).all():
                continue
            link = np.stack([(whole[a:z] == x).sum(1) >= agree for x in whole[a:z]])
            link |= label[a:z, None] == label[None, a:z]
            label[a:z] = _least(link, label[a:z] * m + np.arange(a, z)) // m
    return label


def _climb(least: int, trees: int, depth: int, agree: int):
    """Of rows sorted by trie, salt and own signature, the candidates (a, b) in each part of a tree, as few as link them all.

    A part with more texts than can be compared at once comes in salted portions, which are linked whole.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches):
        held, key = [], None

        def done():
            node = np.concatenate([x[0] for x in held])
            own, whole = (np.concatenate([x[i] for x in held]) for i in (1, 2))
            if key[2] > 1:
                to = np.full(len(node), key[3])
            else:
                label = trie_links(own, whole, least, agree)
                to = node[label]
            some = to != node
            return pa.RecordBatch.from_arrays([pa.array(to[some]), pa.array(node[some])], schema=schema)

        for batch in batches:
            trie, salt, parts, head, node = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            own = flat(batch.column(5))[0].reshape(-1, depth)
            whole = flat(batch.column(6))[0].reshape(-1, trees * depth)
            cut = np.flatnonzero(np.r_[True, (trie[1:] != trie[:-1]) | (salt[1:] != salt[:-1])]) if len(trie) else []
            for a, z in zip(cut, [*cut[1:], len(trie)], strict=True):
                now = (int(trie[a]), int(salt[a]), int(parts[a]), int(head[a]))
                if held and now != key:
                    yield done()
                    held = []
                key = now
                held.append((node[a:z].copy(), own[a:z].copy(), whole[a:z].copy()))
        if held:
            yield done()

    return run


def _chunks(batch):
    """(first, last, shingles) of runs of texts of a batch whose third column is the text."""
    data, begin = flat(batch.column(2))
    for first, last in runs(begin, CHUNK):
        a, z = int(begin[first]), int(begin[last])
        yield first, last, shingles(data[a:z], begin[first : last + 1] - a)
        give_back()


_SIGNED = pa.schema([("key", pa.int64()), ("th", pa.int64()), ("words", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()), ("sig", pa.binary())])


def _sign(trees: int, depth: int):
    def run(batches):
        for batch in batches:
            key, th = batch.column(0), batch.column(1)
            for first, last, (h, at, all_words) in _chunks(batch):
                n = np.diff(at)
                some = n > 0
                sums = [np.r_[np.uint64(0), np.cumsum(x, dtype=np.uint64)] for x in (h, mix(h + np.uint64(7)))]
                h1, h2 = (mix(s[at[1:]] - s[at[:-1]] + n.astype(np.uint64)).view(np.int64) for s in sums)
                offsets = np.r_[0, np.cumsum(some * (trees * depth))].astype(np.int32)
                lists = pa.BinaryArray.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets), pa.py_buffer(signatures(h, at, trees, depth))])
                held = [pa.array(x, mask=~some) for x in (h1, h2)]
                yield pa.RecordBatch.from_arrays([key.slice(first, last - first), th.slice(first, last - first), pa.array(all_words.view(np.int64)), *held, lists], schema=_SIGNED)

    return run


def _gather(batches):
    """(node, h1, h2, texts, comp, blocks, block, shingles) for the representatives; the first two columns are carried inside data."""
    for batch in batches:
        for first, last, (h, at, _) in _chunks(batch):
            offsets = (at * 8).astype(np.int32)
            data = pa.BinaryArray.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(h.tobytes())])
            yield pa.RecordBatch.from_arrays([*(c.slice(first, last - first) for c in batch.columns[:2]), *(c.slice(first, last - first) for c in batch.columns[3:]), data], names=[*batch.schema.names[:2], *batch.schema.names[3:], "shingles"])


def common_counts(sets: list[np.ndarray], others: list[np.ndarray]) -> np.ndarray:
    """How many shingles each of sets has in common with each of others, by products of 0/1 matrices over the shared ones."""
    n = len(sets)
    sizes = np.array([len(x) for x in [*sets, *others]])
    owner = np.repeat(np.arange(len(sizes)), sizes)
    _, which, often = np.unique(np.concatenate([*sets, *others, np.zeros(0, np.uint64)]), return_inverse=True, return_counts=True)
    keep = often[which] > 1
    shared = np.cumsum(often > 1) - 1
    which, owner = shared[which[keep]], owner[keep]
    out = np.zeros((n, len(others)), np.float32)
    by = np.argsort(which, kind="stable")
    which, owner = which[by], owner[by]
    for a in range(0, int(which[-1]) + 1 if len(which) else 0, 4096):
        i, j = np.searchsorted(which, [a, a + 4096])
        m = np.zeros((len(sizes), min(4096, int(which[-1]) + 1 - a)), np.float32)
        m[owner[i:j], which[i:j] - a] = 1
        out += m[:n] @ m[n:].T
    return out


_FOUND = pa.schema([("node", pa.int64()), ("h2", pa.int64()), ("comp", pa.int64()), ("blocks", pa.int32()), ("links", pa.int64()), ("other", pa.int64())])
_FOUND_DDL = "node long, h2 long, comp long, blocks int, links long, other long"


def _verify(batches):
    """Groups (comp, i, j), in order: links of each text of block i with those of block j, and its least neighbour."""
    held, rows = None, []

    def done():
        i, j = held[1:]
        left, right = [r for r in rows if r[4] == i], [r for r in rows if r[4] == j]
        sets = [np.frombuffer(r[5], np.uint64) for r in left]
        others = [np.frombuffer(r[5], np.uint64) for r in right] if i != j else sets
        common = common_counts(sets, others)
        size, size_o = np.array([len(x) for x in sets]), np.array([len(x) for x in others])
        link = (SIMILAR[0] + SIMILAR[1]) * common >= SIMILAR[0] * (size[:, None] + size_o[None, :])
        if i == j:
            np.fill_diagonal(link, False)
        texts, texts_o = np.array([r[2] for r in left]), np.array([r[2] for r in right])
        node, node_o = np.array([r[0] for r in left], np.int64), np.array([r[0] for r in right], np.int64)
        out = []
        if i == j:
            links, low = link @ texts, _least(link, node)
            out += zip(node.tolist(), [r[1] for r in left], links.tolist(), low.tolist(), strict=True)
        else:
            # in one graph of both blocks
            full = np.zeros((len(left) + len(right),) * 2, bool)
            full[: len(left), len(left) :] = link
            full[len(left) :, : len(left)] = link.T
            low = _least(full, np.r_[node, node_o])
            links = np.r_[link @ texts_o, link.T @ texts]
            out += zip([*node.tolist(), *node_o.tolist()], [r[1] for r in [*left, *right]], links.tolist(), low.tolist(), strict=True)
        blocks = rows[0][6]
        return packed([(n, h, held[0], blocks, k, o) for n, h, k, o in out], _FOUND)

    for batch in batches:
        columns = [c.to_pylist() for c in batch.columns]
        for comp, i, j, node, h2, texts, block, blocks, data in zip(*columns, strict=True):
            if (comp, i, j) != held:
                if held:
                    yield done()
                held, rows = (comp, i, j), []
            rows.append((node, h2, texts, None, block, data, blocks))
    if held:
        yield done()


def _least(link: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The least node that each is linked with, over any number of links."""
    order = np.argsort(node, kind="stable")
    label = np.empty(len(node), np.int64)
    label[order] = np.arange(len(node))
    while True:
        near = np.where(link, label[None, :], len(node)).min(1, initial=len(node))
        new = np.minimum(label, near)
        new = new[order[new]]  # and a step further
        if (new == label).all():
            return node[order[label]]
        label = new


def near_duplicates(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", trees: int = TREES, block: int = BLOCK, sent: int = SENT) -> DataFrame:
    """One row per row of docs: doc_id, class_id, n_links, first, key, th.

    Texts are linked when the Jaccard similarity of their sets of five-word shingles is 0.8 or more. n_links counts the
    other different texts (by their words) that a text is linked with; class_id is the least doc_id of all that it is
    linked with, over any number of links; first marks one row of each class, the least by doc_id. Copies are one
    representative: they are never compared. Candidates share a trie node in some tree and agree in their signatures;
    they form components, and every pair of a component is compared exactly, in blocks if there are many. Where more
    than `block` different texts share a node, all of them are in one component.
    A text of fewer than five words has one shingle, of them all; a text without words has no links and is a class of its
    own. A null doc_id is the smallest. Repeated rows are copies. An empty table gives no rows; other columns aren't read.
    """
    least = shallowest(SIMILAR[0] / SIMILAR[1], trees)
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NONE)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.select("key", F.xxhash64("text").alias("th"), "text")
    signed = rows.mapInArrow(_sign(trees, DEPTH), "key long, th long, words long, h1 long, h2 long, sig binary").withColumn("row", F.monotonically_increasing_id())
    signed = table(signed, "signed")
    texts = signed.filter("h1 IS NOT NULL").groupBy("h1", "h2", "words").agg(F.min(F.struct("key", "row", "th")).alias("least"), F.count(F.lit(1)).alias("n"), F.first("sig").alias("sig"))
    sets = texts.groupBy("h1", "h2").agg(F.min("least").alias("least"), F.count(F.lit(1)).alias("texts"), F.sum("n").alias("n"), F.first("sig").alias("sig"))
    sets = table(sets.select(F.col("h1").alias("node"), "h2", F.col("least.key").alias("key"), F.col("least.th").alias("th"), F.col("least.row").alias("row"), "texts", "n", "sig"), "sets")

    nodes = sets.select("node", "sig", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"))
    nodes = nodes.selectExpr("node", "tree", f"xxhash64(tree, substring(sig, tree * {DEPTH} + 1, {least})) AS trie")
    shared = nodes.groupBy("trie").agg(F.min("node").alias("head"), F.max("node").alias("z"), F.count(F.lit(1)).alias("many")).filter("head <> z")
    shared = table(shared.selectExpr("trie", "head", "many", f"cast(ceil(many / {block}) AS int) AS parts"), "shared")
    met = dealt_join(nodes, shared, ["trie"], "many", sent=sent).withColumn("salt", F.pmod(F.xxhash64("node"), "parts").cast("int"))
    met = table(met.select("trie", "salt", "parts", "head", "node", "tree"), "met")
    met = met.join(sets.select("node", "sig"), "node").selectExpr("trie", "salt", "parts", "head", "node", f"substring(sig, tree * {DEPTH} + 1, {DEPTH}) AS own", "sig")
    tasks = max(1, met.count() // 20_000 + 1)
    met = met.repartition(tasks, "trie", "salt").sortWithinPartitions("trie", "salt", "own", "node")
    links = met.mapInArrow(_climb(least, trees, DEPTH, AGREE * trees // TREES), "a long, b long").distinct()
    comps = table(components(links, sent=sent), "candidates")
    sizes = table(comps.groupBy(F.col("root").alias("comp")).agg(F.count(F.lit(1)).alias("many"), F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "sizes")
    members = dealt_join(sets.drop("sig", "row", "n").join(comps, "node").withColumnRenamed("root", "comp"), sizes, ["comp"], "many", sent=sent)
    members = members.withColumn("block", F.pmod(F.xxhash64("h2", "node"), F.col("blocks")).cast("int"))
    members = table(members.select("key", "th", "node", "h2", "texts", "comp", "blocks", "block"), "members")
    some, copies = members.agg(F.count(F.lit(1)), F.sum("blocks")).first()
    side = F.broadcast(members) if some <= sent else members
    # copies of a representative under one id are one row here
    found = rows.join(side, ["key", "th"]).select("key", "th", "text", "node", "h2", "texts", "comp", "blocks", "block")
    ddl = "key long, th long, node long, h2 long, texts long, comp long, blocks int, block int, shingles binary"
    found = table(found.mapInArrow(_gather, ddl).dropDuplicates(["node", "h2"]), "shingles")
    other = F.expr("explode(transform(sequence(0, blocks - 1), x -> struct(least(x, block) AS i, greatest(x, block) AS j)))")
    pairs = found.select("comp", "blocks", "block", "node", "h2", "texts", "shingles", other.alias("ij"))
    pairs = pairs.select("comp", F.col("ij.i").alias("i"), F.col("ij.j").alias("j"), "node", "h2", "texts", "block", "blocks", "shingles")
    tasks = max(1, (copies or 0) // 2000 + 1)
    pairs = pairs.repartition(tasks, "comp", "i", "j").sortWithinPartitions("comp", "i", "j", "node", "h2")
    verified = table(pairs.mapInArrow(_verify, _FOUND_DDL), "verified")
    # a component of one block is settled by its task; the others by the links between their blocks
    roots = verified.filter("blocks = 1").select("node", F.col("other").alias("root"))
    roots = roots.unionByName(components(verified.filter("blocks > 1").select(F.col("node").alias("a"), F.col("other").alias("b")), sent=sent))
    counts = verified.groupBy("node", "h2").agg(F.sum("links").alias("links"))
    part = sets.drop("sig").join(counts, ["node", "h2"], "left").join(roots, "node", "left")
    part = part.select("node", "h2", "key", "row", "texts", "n", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("root", "node").alias("root"))
    part = table(part, "classes")
    heads = part.groupBy("root").agg(F.min(F.struct("key", "row")).alias("head"), F.sum("n").alias("docs"), F.count(F.lit(1)).alias("many"))
    heads = table(heads.filter("docs > 1"), "heads")
    known = dealt_join(part, heads, ["root"], "many", sent=sent).select(F.col("node").alias("h1"), "h2", (F.col("links") + F.col("texts") - 1).alias("links"), "head", "n")
    out = dealt_join(signed.drop("sig", "words"), table(known, "known"), ["h1", "h2"], "n", "left", sent)
    real = lambda c: F.when(c != _NONE, c)
    return out.select(
        real(F.col("key")).alias("doc_id"),
        real(F.coalesce(F.col("head.key"), F.col("key"))).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce(F.col("head.row") == F.col("row"), F.lit(True)).alias("first"),
        "key",
        "th",
    )


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """docs without the rows that near_duplicates doesn't mark as first; of rows repeated with their id and text, one stays."""
    found = table(near_duplicates(docs, text, doc_id).select("key", "th", "first"), "near")
    one = found.groupBy("key", "th").agg(F.bool_or("first").alias("first"), F.count(F.lit(1)).alias("n"))
    gone = table(one.filter("NOT first").select("key", "th"), "gone")
    marked = docs.withColumns({"key_": F.coalesce(F.col(doc_id).cast("long"), F.lit(_NONE)), "th_": F.xxhash64(F.coalesce(F.col(text), F.lit("")))})
    side = F.broadcast(gone) if gone.count() <= SENT else gone
    kept = marked.join(side, (F.col("key_") == side["key"]) & (F.col("th_") == side["th"]), "left_anti")
    has_words = F.coalesce(F.col(text), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    if one.filter("first AND n > 1").limit(1).count():
        kept = kept.filter(has_words).dropDuplicates(["key_", "th_"]).unionByName(kept.filter(~has_words))
    return kept.drop("key_", "th_")


def op9_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "class_id", "n_links")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT array_to_string(w, ' ') AS s, any_value(w) AS w, min(doc_id) AS rep FROM d WHERE len(w) > 0 GROUP BY array_to_string(w, ' ')),
g AS (SELECT DISTINCT rep, unnest(CASE WHEN len(w) < 5 THEN [s] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t),
n AS (SELECT rep, count(*) AS n FROM g GROUP BY rep),
p AS (SELECT a.rep AS a, b.rep AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.rep <> b.rep GROUP BY a.rep, b.rep),
e AS (SELECT p.a AS a, p.b AS b FROM p JOIN n x ON x.rep = p.a JOIN n y ON y.rep = p.b WHERE 9 * p.c >= 4 * (x.n + y.n)),
cc(a, b) AS (SELECT rep, rep FROM t UNION SELECT cc.a, e.b FROM cc JOIN e ON cc.b = e.a),
c AS (SELECT a, min(b) AS class_id FROM cc GROUP BY a),
k AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT d.doc_id AS doc_id, coalesce(c.class_id, d.doc_id) AS class_id, coalesce(k.n_links, 0) AS n_links
FROM d LEFT JOIN t ON array_to_string(d.w, ' ') = t.s LEFT JOIN c ON c.a = t.rep LEFT JOIN k ON k.a = t.rep
"""
