"""The join against all pairs, with a large group, and the forest's depth."""

import random
import re

import numpy as np
import pytest

from folio.llm import jaccard
from folio.llm.jaccard import keep_one, near_duplicates, shallowest, trie_links


def sets(t):
    w = re.findall(r"[^\x20\x09-\x0d]+", t or "")
    return tuple(w), {tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set()


def brute(rows):
    ids = {}
    for i, t in rows:
        ids.setdefault(sets(t)[0], []).append(-1 if i is None else i)
    texts = [w for w in ids if w]
    g = {w: sets(" ".join(w))[1] for w in texts}
    link = {w: [] for w in texts}
    for x, a in enumerate(texts):
        for b in texts[x + 1 :]:
            both = len(g[a] & g[b])
            if both * 9 >= 4 * (len(g[a]) + len(g[b])):
                link[a].append(b)
                link[b].append(a)
    root = {}
    for w in texts:
        if w in root:
            continue
        todo, seen = [w], {w}
        while todo:
            for b in link[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        least = min(min(ids[b]) for b in seen)
        root |= {b: least for b in seen}
    return {w: (root[w], len(link[w])) for w in texts}


def sample(n=150):
    r = random.Random(8)
    words = [f"w{i}" for i in range(3000)]
    rows = []
    for i in range(n):
        if rows and r.random() < 0.55:
            w = list(sets(r.choice(rows)[1])[0])
            for _ in range(r.choice([0, 1, 1, 2, 3])):
                if w:
                    w[r.randrange(len(w))] = r.choice(words)
            t = r.choice([" ", "\n"]).join(w)
        else:
            t = " ".join(r.choice(words) for _ in range(r.choice([3, 4, 5, 6, 40, 80, 200])))
        rows.append((i * 41 % 997, t))
    return rows + [(2000, None), (2001, ""), (2002, " \n"), (None, rows[0][1]), (2003, "a b c"), (2004, "a b c"), (2005, "a b c d e"), (rows[5][0], rows[5][1])]


@pytest.mark.parametrize("block", [1000, 7])
def test_against_all_pairs(spark, block):
    rows = sample()
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, node int").repartition(3)
    want = brute(rows)
    got = near_duplicates(df, block=block).collect()
    assert len(got) == len(rows)
    by = {}
    for i, t in rows:
        by.setdefault(-1 if i is None else i, sets(t)[0])
    for r in got:
        i = -1 if r.doc_id is None else r.doc_id
        w = by[i]
        assert (-1 if r.class_id is None else r.class_id, r.n_links) == (want[w] if w else (i, 0))
    classes = {}
    for r in got:
        classes.setdefault(r.class_id, []).append(r.first)
    assert all(sum(v) == 1 for v in classes.values())
    kept = keep_one(df).collect()
    assert len(kept) == len(classes) and {r.doc_id for r in kept} == set(classes)


def test_empty(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_prefixes_are_shortened_until_the_recall():
    d = shallowest(0.8)
    assert 1 - (1 - 0.8**d) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (d + 1)) ** 24


def test_trie_links_are_those_of_all_pairs():
    r = np.random.default_rng(3)
    base = r.integers(0, 256, (6, 48), dtype=np.uint8)
    whole = base[r.integers(0, 6, 120)]
    whole = np.where(r.random(whole.shape) < 0.25, r.integers(0, 256, whole.shape, dtype=np.uint8), whole)
    whole[:, :2] = 7  # all below one node
    whole = whole[np.lexsort(whole[:, 11::-1].T)]
    label = trie_links(whole[:, :12], whole, 2, 24)
    link = (whole[:, None] == whole[None]).sum(2) >= 24
    want = np.arange(len(whole))
    for _ in want:
        want = np.where(link, want[None], len(want)).min(1)
    assert (label == want).all() and len(set(label)) > 1


def test_weak_pairs_do_not_chain_up(spark, monkeypatch):
    """Each text is 0.4 alike the next: no component, and so nothing to verify."""
    r = random.Random(6)
    words = [f"w{i}" for i in range(100_000)]
    said = [r.choice(words) for _ in range(300 * 100)]
    rows = [(i, " ".join(said[i * 43 : i * 43 + 104])) for i in range(250)]
    met = []
    own = jaccard.components
    monkeypatch.setattr(jaccard, "components", lambda e, **kw: met.append(e.count()) or own(e, **kw))
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert all(x.class_id == x.doc_id and x.n_links == 0 for x in got) and met[0] == 0


@pytest.mark.parametrize("sent", [500_000, 5])
def test_one_group_of_most_rows(spark, sent):
    """Copies and near copies of one text, in a table whose sides are sent and in one where they are dealt."""
    r = random.Random(5)
    w = [f"v{i}" for i in range(300)]
    rows = [(i, " ".join(w)) for i in range(60)]
    for i in range(60, 160):
        x = list(w)
        x[r.randrange(300)] = f"z{i}"
        rows.append((i, " ".join(x)))
    rows += [(i, " ".join(f"u{r.randrange(10**6)}" for _ in range(30))) for i in range(160, 200)]
    want = brute(rows)
    got = near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), block=30, sent=sent).collect()
    by = dict(rows)
    assert all((x.class_id, x.n_links) == want[sets(by[x.doc_id])[0]] for x in got) and len(got) == 200
