"""Encoding and decoding against the sentencepiece library itself."""

import hashlib

import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from folio.llm.pieces import encode, pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIB = sentencepiece.SentencePieceProcessor(model_file=PATH)
CASES = ["", " ", "\n", "  a", "a  ", "a \n b", "<s> </s> <0x0A>", "▁x▁▁y", "\x00a", "日本語のテキスト", "é\té", "🙂🙂", "ab" * 700, "x" * 5000 + " " * 300 + "é" * 250, "abababab aaaa", None, "Hello world.\nHello"]


def both(text: str):
    model = pieces(PATH)
    words = model.words(text)
    ids = [i for w in model.encode_words(words) for i in w]
    return ids, LIB.encode(text)


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcdething  \n▁.,é日\t⁇<>0x"), max_size=60) | st.text(max_size=30))
def test_any_text(text):
    text = text.encode("utf-8", "ignore").decode()
    ids, want = both(text)
    assert ids == want


def test_query_rows(spark):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)] + [(3, CASES[3], "y")], "doc_id long, text string, ids string")
    rows = encode(docs, PATH, with_ids=True).collect()
    assert len(rows) == len(CASES) + 1
    for r in rows:
        ids = LIB.encode(CASES[r.doc_id] or "")
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded == LIB.decode(ids)
        assert r.decoded_sha256 == hashlib.sha256(LIB.decode(ids).encode()).hexdigest()
    assert encode(docs.limit(0), PATH).count() == 0
