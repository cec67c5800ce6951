"""Readers and writers on small files."""

import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from folio.sources import readers as R
from folio.sources import sinks as K


def write(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_pages(spark, tmp_path):
    cache = {
        "p2": [{"blocks": [{"text": "a", "bbox": [1, 2, 3, 4], "label": "Text", "confidence": 0.5}, {"text": "  "}, {"html": "<p>b<br>c</p>", "polygon": [[5, 6], [9, 6], [9, 8]]}], "image_bbox": [0, 0, 700, 900], "page": 3}],
        "p1": [{"text_lines": [{"text": "whole"}]}],
    }
    got = R.load_pages(spark, write(tmp_path, "c.json", json.dumps(cache))).orderBy("page_name", "block_idx").collect()
    assert [(r.page_name, r.block_idx, r.text, r.x0, r.y1, r.page_w) for r in got] == [("p1", 0, "whole", 0.0, 1000.0, 1000), ("p2", 0, "a", 1.0, 4.0, 700), ("p2", 2, "b\nc", 5.0, 8.0, 700)]
    assert R.load_pages(spark, write(tmp_path, "bad.json", "{")).count() == 0


def test_boxes(spark, tmp_path):
    path = write(tmp_path, "l.json", json.dumps({"a/p1.png": [{"blocks": [{"bbox": [0, 0, 1, 1]}, {"bbox": [0, 0, 2, 2], "raw_label": "Table"}]}]}))
    assert [(r.stem, r.label) for r in R.load_boxes(spark, path, True).collect()] == [("p1", "Table")]
    assert R.load_boxes(spark, path).count() == 2


def test_native_text(spark):
    s = spark.createDataFrame([(0, 0, "text", [["Hel", "lo"], [" "], ["you"]], 72.0, 0.0, 144.0, 10.0), (0, 1, "image", [], 0.0, 0.0, 1.0, 1.0), (0, 2, "text", [[" "]], 0.0, 0.0, 1.0, 1.0)], "page_idx int, block_idx int, kind string, lines array<array<string>>, x0 double, y0 double, x1 double, y1 double")
    assert [(r.text, r.label, r.x0) for r in R.native_blocks(s, 144).collect()] == [("Hello\nyou", None, 144.0), ("", "Picture", 0.0)]


def test_lists_and_manifests(spark, tmp_path):
    got = R.work_list(spark, write(tmp_path, "w.txt", "# no\n\nbook a\t5\nbook b :: x\nbook c\n"), 9).collect()
    assert [(r.entry, r.limit) for r in got] == [("book a", 5), ("book b", 9), ("book c", 9)]
    got = R.manifest(spark, write(tmp_path, "m.jsonl", '{"edition": 1}\n\n{"edition": 2\n{"edition": 3}'), "edition int").collect()
    assert sorted(r.edition for r in got) == [1, 3]


def test_layout_rules(spark, tmp_path):
    got = R.layout_rules(spark, write(tmp_path, "r.txt", "# all\nedition:5 :: columns=2, two-up\nrose\tdrop-pages=even:2-8 # x\n")).collect()
    assert [(r.ord, r.key, r.opt, r.val) for r in got] == [(2, "edition:5", "columns", "2"), (2, "edition:5", "two_up", "on"), (3, "rose", "drop_pages", "even:2-8")]
    for bad in ("x :: columns=0", "x", ":: two-up=on", "x :: what=1"):
        with pytest.raises(PySparkException, match="line 1"):
            R.layout_rules(spark, write(tmp_path, "bad.txt", bad)).collect()


def test_editions_and_logs(spark, tmp_path):
    rows = spark.createDataFrame([("/a/e12", None), ("/a/x", '{"edition": 7}'), ("/a/e12b", "{}")], "folder string, json string")
    assert [r.edition for r in R.sidecar_edition(rows).collect()] == ["12", "7", None]
    path = write(tmp_path, "perf.log", '[PERF] {"summary": true, "stage": "ocr", "pages": 3}\nnoise\n[PERF] {"stage": "ocr"}\n[PERF] {"summary": true, "stage": "pdf"}\n')
    assert [r.fields["pages"] for r in R.perf_lines(spark, path).collect()] == ["3"]
    path = write(tmp_path, "llama.log", "slot 1 | task 7 |  eval time =  9.5 ms /   50 tokens\nprompt eval time = 1 ms / 2 tokens\n")
    assert [(r.task, r.tokens) for r in R.decoded_tokens(spark, path).collect()] == [(7, 50)]


def test_writers(spark, tmp_path):
    pages = spark.createDataFrame([(1, 1, "p2", "two"), (1, 0, "p1", "one")], "doc_id long, page_idx int, page_name string, page_text string")
    assert K.book_text(pages).first().book_text == "\f===== PAGE 0001 :: p1 =====\none\n\f===== PAGE 0002 :: p2 =====\ntwo"
    K.write_text(pages, f"{tmp_path}/t")
    assert spark.read.json(f"{tmp_path}/t/pages").count() == 2
    rows = spark.createDataFrame([("x1",), ("10",), ("9",)], "edition string")
    K.write_manifest(rows, f"{tmp_path}/m")
    K.append_manifest(rows, f"{tmp_path}/m")
    assert [r.value for r in spark.read.text(f"{tmp_path}/m").collect()].count('{"edition":"10"}') == 2
    books = spark.createDataFrame([("u1", True, "/a/b/x.doc.json"), ("u2", False, "/a/y")], "corpus_key string, ok boolean, doc_path string")
    assert [(r.rel_path, r.exit_code) for r in K.export(books, "/c").orderBy("corpus_key").collect()] == [("u1/x.doc.json", 0), (None, 3)]


def test_images(spark, tmp_path):
    for n in ("p10.png", "p9.PNG", "x.txt"):
        write(tmp_path, n, "x")
    assert [r["name"] for r in R.page_images(spark, str(tmp_path)).orderBy("order").collect()] == ["p9.PNG", "p10.png"]
    assert R.page_images(spark, str(tmp_path)).agg(F.count("*")).first()[0] == 2
