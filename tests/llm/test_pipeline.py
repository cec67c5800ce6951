"""The pipeline, stage by stage, against brute force on its own input."""

import random
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from folio.llm import quality

from .test_jaccard import brute as near_brute
from .test_jaccard import sets
from .test_lines import brute as line_brute
from .test_suffixes import brute as repeat_brute


def documents():
    r = random.Random(12)
    words = ["".join(r.choice("abcdefghé") for _ in range(r.randint(2, 7))) for _ in range(900)]
    say = lambda k: " ".join(r.choice(words) for _ in range(k))
    passage, rows = say(40), []
    for i in range(160):
        t = "\n".join(say(r.randint(8, 16)) for _ in range(r.randint(2, 8)))
        if rows and i % 6 == 0:
            t = r.choice(rows)[1]
        if i % 7 == 0:
            t += "\n" + say(3) + passage + say(2)
        if i % 17 == 0:
            t = " ".join(w + "###" for w in t.split())
        if rows and i % 11 == 0:
            b = r.choice(rows)[1].split("\n")
            t = "\n".join(x[:-1] + "z" if r.random() < 0.5 else x + " " + say(1) for x in b)
        rows.append((i, t, "en", f"s{i % 3}", len(t)))
    return rows + [(500, "", "en", "s1", 0), (501, None, None, None, None), (502, "word " * 30_000, "de", "s1", 150_000)]


def test_stages(spark, tmp_path):
    spark.createDataFrame(documents(), "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.collect()
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        seen[name] = (before, docs.collect())
        if k < 4:
            assert docs.columns == columns
    texts = lambda rows: {x.doc_id: x.text for x in rows}

    before, after = seen["quality rules"]
    frame = docs  # noqa: F841
    documents_ = [x.asDict() for x in before]
    con = duckdb.connect()
    import pandas as pd

    con.register("documents", pd.DataFrame(documents_).astype({"doc_id": "int64"}).where(lambda d: d.notna(), None))
    kept = {r[0] for r in con.sql(f"SELECT doc_id FROM ({quality.SQL}) WHERE kept").fetchall()}
    assert {x.doc_id for x in after} == kept and len(kept) < len(before)
    assert {x.doc_id for x in after} >= {x.doc_id for x in before if x.doc_id < 160 and x.doc_id % 17 and x.doc_id % 11 and x.doc_id % 6}

    before, after = seen["line dedup"]
    want = line_brute([(x.doc_id, x.text) for x in before])
    assert texts(after) == {x.doc_id: "\n".join(want[x.doc_id, x.text][3]) for x in before}
    assert all(x.n_chars == len(x.text) for x in after)

    before, after = seen["n-gram Jaccard join"]
    want = near_brute([(x.doc_id, x.text) for x in before])
    assert {x.doc_id for x in after} == {x.doc_id for x in before if not sets(x.text)[0] or want[sets(x.text)[0]][0] == x.doc_id}

    before, after = seen["suffix-array dedup"]
    want = repeat_brute([(x.doc_id, x.text) for x in before])
    assert len(after) == len(before)
    for x in before:
        n, gone, _, _ = want[x.doc_id, x.text.encode()]
        assert n - gone - 6 * len(x.text) <= len(texts(after)[x.doc_id].encode()) <= n - gone

    before, after = seen["packing"]
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    n = {x.doc_id: len(lib.encode(x.text, add_special_tokens=False).ids) + 1 for x in before}
    got, used = defaultdict(int), defaultdict(int)
    for p in after:
        got[p.doc_id] += p.length
        used[p.sequence_id] += p.length
    assert dict(got) == n and max(used.values()) <= 1024
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    pieces = lambda rows: sorted((p.doc_id, p.start, p.length, p.ids_crc32) for p in rows)
    assert pieces(whole) == pieces(after)
    assert np.sum([p.length for p in whole]) == sum(n.values())


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").count() == 0, name
