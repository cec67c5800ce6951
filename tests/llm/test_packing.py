"""Packing against the library's ids and against a plain best fit."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folio.llm.packing import best_fit_decreasing, pack, tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIB = Tokenizer.from_file(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=80) | st.text(alphabet=st.sampled_from("ab 'st\n\té日1٣<|endoftext> ​"), max_size=60))
def test_ids_are_the_librarys(text):
    text = text.encode("utf-8", "ignore").decode()
    assert tokens(PATH).ids(text).tolist() == LIB.encode(text, add_special_tokens=False).ids


def test_special_strings():
    for text in ("a<|endoftext|>b", "<|endoftext|>", "<|endoftext| >"):
        assert tokens(PATH).ids(text).tolist() == LIB.encode(text, add_special_tokens=False).ids


def plain(lengths, size):
    left, out = [], {}
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        fits = [(c, k) for k, c in enumerate(left) if c >= lengths[i]]
        if fits:
            c, _ = min(fits)
            k = max(k for c2, k in fits if c2 == c)
        else:
            k = len(left)
            left.append(size)
        left[k] -= lengths[i]
        out[i] = k
    return left


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=60))
def test_best_fit_decreasing(lengths):
    seq, off = best_fit_decreasing(np.array(lengths, np.int64), 32)
    used = defaultdict(list)
    for s, o, n in zip(seq, off, lengths):
        used[s].append((o, n))
    for parts in used.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 32
    want = plain(lengths, 32)
    assert sorted(32 - c for c in want) == sorted(sum(n for _, n in p) for p in used.values())


def test_pieces(spark):
    r = random.Random(5)
    texts = ["", None, "word " * 1023, "word " * 3000, "é\n\t" * 500] + [" ".join(r.choice(["the", "cat", "Zürich", "1234"]) for _ in range(r.randint(1, 900))) for _ in range(150)]
    docs = spark.createDataFrame([(i if i else None, t, 7) for i, t in enumerate(texts)] + [(9, texts[9], 7)], "doc_id long, text string, start int").repartition(3)
    rows = pack(docs, PATH, rests_a_task=60).collect()
    by_seq, by_doc = defaultdict(list), defaultdict(list)
    for p in rows:
        by_seq[p.sequence_id].append((p.offset, p.length))
        by_doc[p.doc_id].append(p)
    for parts in by_seq.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    for i, t in enumerate(texts):
        ids = np.array([*LIB.encode(t or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[i if i else None], key=lambda p: p.start)
        pieces = pieces[:: 2 if i == 9 else 1]
        assert [p.start for p in pieces] == list(range(0, len(ids), 1024))
        for p in pieces:
            assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(ids[p.start : p.start + p.length].tobytes())
    lengths = [sum(n for _, n in v) for v in by_seq.values()]
    assert sum(1024 - n for n in lengths) < 0.1 * 1024 * len(lengths)
    assert pack(docs.limit(0), PATH).count() == 0
