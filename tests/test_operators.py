"""Operators on small tables."""

import pytest
from pyspark.sql import functions as F

from folio.functions import text as T
from folio.operators import corpus as C
from folio.operators import geometry as G
from folio.operators import metrics as M
from folio.operators import notes as N
from folio.operators import pages as P
from folio.operators import raster as R
from folio.operators import structure as S
from folio.plans import docbuild as D
from folio.sources import sinks as K
from folio.plans.metric_queries import rasters

BLK = "doc_id long, page_idx int, block_idx int, label string, text string, html string, confidence double, x0 double, y0 double, x1 double, y1 double, page_w int, page_h int"


def blk(spark, rows, height=1400):
    """rows of (page, label, text, box); blocks without a box are stacked."""
    out, n = [], {}
    for page, label, text, box in rows:
        i = n.get(page, 0)
        n[page] = i + 1
        x0, y0, x1, y1 = box or (0, 100 * i, 800, 100 * i + 60)
        out.append((1, page, i, label, text, None, None, float(x0), float(y0), float(x1), float(y1), 1000, height))
    return spark.createDataFrame(out, BLK)


def test_two_columns_are_read_one_after_the_other(spark):
    rows = [(0, "Text", "R1", (520, 100, 1000, 150)), (0, "Text", "L1", (0, 100, 480, 150)), (0, "Footnote", "F", (0, 900, 1000, 950)), (0, "Text", "L2", (0, 200, 480, 250)), (0, "Text", "R2", (520, 200, 1000, 250))]
    got = [r.text for r in G.reading_order(blk(spark, rows)).orderBy("seq").collect()]
    assert got == ["L1", "L2", "R1", "R2", "F"]


def test_a_wide_block_joins_the_columns(spark):
    rows = [(0, "Text", "L", (0, 100, 480, 150)), (0, "Text", "R", (520, 90, 1000, 150)), (0, "Text", "W", (0, 10, 1000, 50))]
    assert [r.text for r in G.reading_order(blk(spark, rows)).orderBy("seq").collect()] == ["W", "R", "L"]


def test_overlaps_are_strict(spark):
    rows = [(0, "Text", "a", (0, 0, 10, 10)), (0, "Text", "b", (5, 5, 15, 15)), (0, "Text", "c", (15, 0, 20, 10)), (1, "Text", "d", (0, 0, 10, 10))]
    assert sorted(r.text for r in G.overlapping(blk(spark, rows)).collect()) == ["a", "b"]


def test_layout_takes_the_largest_cover(spark):
    b = blk(spark, [(0, "Text", "a", (0, 0, 10, 10)), (0, "Picture", "p", (0, 0, 10, 10)), (0, "Text", "c", (100, 0, 110, 10))])
    r = spark.createDataFrame([(1, 0, 0, "Footnote", 0.0, 0.0, 6.0, 10.0), (1, 0, 1, "Title", 0.0, 0.0, 9.0, 10.0), (1, 0, 2, "Table", 0.0, 0.0, 9.0, 10.0)], "doc_id long, page_idx int, region_idx int, label string, x0 double, y0 double, x1 double, y1 double")
    assert [x.new_label for x in G.merge_layout(b, r).orderBy("block_idx").collect()] == ["Title", "Picture", "Text"]


def test_verses(spark):
    wide = (100, 0, 700, 50)
    rows = [(0, "Text", "w", wide), (0, "Text", "w", (100, 60, 700, 90)), (0, "Text", "one line\nand two", (150, 100, 600, 200)), (0, "Text", "single", (150, 210, 600, 230)), (0, "Text", "not in\nat all", (100, 240, 700, 280))]
    got = [r.verse_type for r in S.verses(blk(spark, rows)).orderBy("block_idx").collect()]
    assert got == [None, None, "verse", None, None]


def test_running_heads_need_three_pages(spark):
    rows = [(p, "Text", t, box) for p in range(4) for t, box in ((f"{p} The Book", (0, 10, 800, 40)), (str(p + 1), (0, 1350, 100, 1390)), ("body", (0, 600, 800, 700)))]
    got = {(r.page_idx, r.head_type) for r in S.running_heads(blk(spark, rows)).collect()}
    assert got == {(p, k) for p in range(4) for k in ("page_header", "page_number")}
    assert S.running_heads(blk(spark, rows[:6])).count() == 0


def test_regions(spark):
    prose = "word " * 30
    rows = [(0, "Title", "The Book", None), (1, "Text", "All rights reserved", None), *[(p, "Text", prose, None) for p in range(2, 9)], (9, "SectionHeader", "Index", None), (10, "Text", "a, 3", None)]
    got = [r.region for r in S.regions(S.page_signals(S.signs(blk(spark, rows)))).orderBy("page_idx").collect()]
    assert got == ["front"] * 2 + ["body"] * 7 + ["back"] * 2


def test_types_and_navigation(spark):
    rows = [(0, "SectionHeader", "Contents", None), (0, "Text", "Preface", None), (1, "Text", "still listed", None), (1, "SectionHeader", "Chapter 2", None), (1, "PageHeader", "12", None), (1, "Text", "1. an item", None), (1, "Text", "10 9 8 7 6", None), (1, "Text", "as he says:", None), (1, "Text", "words (MMK 24.18)", None)]
    t = S.typed(blk(spark, rows)).orderBy("page_idx", "seq").collect()
    assert [r.type for r in t] == ["heading", "toc", "toc", "heading", "page_number", "list_item", "copyright", "body", "body"]
    assert t[-1].chapter == "2" and t[-1].quote_candidate and t[-1].needs_review and t[-1].id == "b00009"


def test_footnotes(spark):
    rows = [(3, "Text", "body [^1] and [^2]", (0, 100, 800, 200)), (3, "Footnote", "[^1] first", (0, 1200, 800, 1220)), (3, "Footnote", "goes on", (0, 1230, 800, 1250)), (3, "Footnote", "[^9] orphan without an end", (0, 1260, 800, 1280)), (4, "Text", "next", (0, 100, 800, 200)), (4, "Footnote", "of the page.", (0, 1200, 800, 1220))]
    got = {r.scope_key: r for r in N.resolve(blk(spark, rows)).collect()}
    assert set(got) == {"p3:1", "p3:9"}
    assert got["p3:1"].text == "first goes on" and not got["p3:1"].needs_review
    assert got["p3:9"].text == "orphan without an end of the page." and got["p3:9"].span_pages == [3, 4] and got["p3:9"].needs_review


def test_an_open_note_goes_on_until_it_ends(spark):
    rows = [(3, "Text", "body [^1]", (0, 100, 800, 200)), (3, "Footnote", "[^1] without an end", (0, 1200, 800, 1220)), (4, "Text", "next [^2]", (0, 100, 800, 200)), (4, "Footnote", "goes on", (0, 1200, 800, 1210)), (4, "Footnote", "and ends.", (0, 1220, 800, 1230)), (4, "Footnote", "no mark.", (0, 1240, 800, 1250))]
    got = {r.scope_key: r.text for r in N.resolve(blk(spark, rows)).collect()}
    assert got == {"p3:1": "without an end goes on and ends.", "p4:2": "no mark."}


def test_numbers_before_the_first_endnote_must_follow(spark):
    rows = [(5, "SectionHeader", "Notes", None), (5, "Text", "1. first.", None), (5, "Text", "2. see pages 500-", None), (6, "Text", "[906] of Cambridge.", (0, 100, 800, 160)), (6, "Text", "3. third.", None), (6, "Text", "4. fourth.", None), (6, "Text", "5. fifth.", None)]
    got = {r.scope_key: r.text for r in N.resolve(blk(spark, rows)).collect()}
    assert set(got) == {f"book:{k}" for k in (1, 2, 3, 4, 5)} and got["book:2"] == "see pages 500- [906] of Cambridge."


def test_a_note_without_a_mark_takes_the_first_unused_reference(spark):
    rows = [(0, "Text", "a [^1] b [^2]", (0, 100, 800, 200)), (0, "Footnote", "no mark.", (0, 1200, 800, 1220)), (0, "Footnote", "[^1] one.", (0, 1230, 800, 1250))]
    got = {r.scope_key: r.text for r in N.resolve(blk(spark, rows)).collect()}
    # the note itself comes later and takes the key again
    assert got == {"p0:1": "one."}


def test_endnotes(spark):
    rows = [(5, "SectionHeader", "Notes to Chapter 2", None), (5, "Text", "1. first.", None), (5, "Text", "2. second without an end", None), (6, "Text", "3. third.", (0, 100, 800, 160)), (6, "Text", "4. fourth.", None), (6, "Text", "5. fifth.", None), (7, "SectionHeader", "Notes", None), (7, "Text", "1. other.", None)]
    got = {r.scope_key: r.kind for r in N.resolve(blk(spark, rows)).collect()}
    assert got == {f"ch2:{k}": "endnote" for k in (1, 2, 3, 4, 5)} | {"book:1": "endnote"}


def test_documents(spark):
    rows = [(0, "PageHeader", "1 Head", (0, 10, 800, 40)), (0, "Text", "Body text", None), (0, "Footnote", "[^1] note.", (0, 1200, 800, 1220))]
    d = D.build(blk(spark, rows)).first()
    assert [b.type for b in d.blocks] == ["page_header", "body", "footnote"] and d.footnotes["p0:1"].block_id == "b00003"
    assert D.doc_text(S.typed(blk(spark, rows))).first().text == "Body text"
    assert '"level":null' in D.to_json(D.build(blk(spark, rows))).first().json


def files(spark, rows):
    return spark.createDataFrame([(1, i, k, p) for i, (k, p) in enumerate(rows, 1)], "book int, file_idx long, kind string, printed long")


def test_descramble(spark):
    got = [r.file_idx for r in P.descramble(files(spark, [("arabic", 3), ("roman", 1), (None, None), ("arabic", 1), ("arabic", 3), ("arabic", 2)])).orderBy("seq").collect()]
    assert got == [2, 3, 4, 6, 1]


def test_missing_numbers(spark):
    rows = [(None, None), ("arabic", 1), (None, None), ("arabic", 3), (None, None), ("arabic", 4), (None, None), (None, None)]
    got = [r.inferred for r in P.infer_missing(files(spark, rows)).orderBy("file_idx").collect()]
    assert got == [None, None, 2, None, None, None, 5, 6]


def test_names(spark):
    f = spark.createDataFrame([(1, n, i) for i, n in enumerate(["p9.jpg", "p10.jpg", "p1000.jpg", "cover.jpg"], 1)], "book int, name string, file_idx long")
    assert sorted(r.new_name for r in P.pad(f).collect()) == ["cover.jpg", "p0009.jpg", "p0010.jpg", "p1000.jpg"]
    assert [r.name for r in f.orderBy(P.natural_key(F.col("name"))).collect()] == ["cover.jpg", "p9.jpg", "p10.jpg", "p1000.jpg"]
    assert [r.new_name for r in P.swap_plan(f, 1).orderBy("file_idx").collect()] == ["p10.jpg", "p9.jpg", "cover.jpg", "p1000.jpg"]
    assert [r.new_name for r in P.swap_plan(f, 2, 4).orderBy("file_idx").collect()] == ["p9.jpg", "p1000.jpg", "p10.jpg", "cover.jpg"]


def test_running_head_labels(spark):
    h = spark.createDataFrame([(1, i, t) for i, t in enumerate(["12 / Sample", "Sample / 13", "xiv / Preface", "A Title", "Introduction / iv"])], "book int, file_idx int, head string")
    got = {r.file_idx: (r.kind, r.val) for r in P.parse_heads(h, P.roman_table(spark)).collect()}
    assert got == {0: ("arabic", 12), 1: ("arabic", 13), 2: ("roman", 14), 3: (None, None), 4: ("roman", 4)}


def test_claims_and_states(spark):
    c = spark.createDataFrame([("a", "h", True, 9999, False), ("b", "h", False, 1, False), ("c", "o", False, 10, False), ("d", "o", True, 9999, False), ("e", "h", True, 1, True)], "name string, host string, alive boolean, age_s int, corrupt boolean")
    assert {r.name for r in C.stealable(c, "h", 900).filter("stealable").collect()} == {"b", "d", "e"}


def test_health_and_upsert(spark):
    rows = spark.createDataFrame([(1, 2, 3, "1.2"), (2, 0, 0, None), (3, 1, None, "1.2")], "edition int, cache_pages int, n_blocks int, schema_version string")
    assert [r.reasons for r in C.health(rows).orderBy("edition").collect()] == ["", "empty cache,no schema_version,no blocks", "cache without doc"]
    assert C.upsert(rows, rows.filter("edition = 2").withColumn("n_blocks", F.lit(9)), ["edition"]).agg(F.sum("n_blocks")).first()[0] == 12


def test_dips_and_duty(spark):
    rows = [(1, f"2024-01-01 00:{m:02d}:00", m, u if u is None else float(u), "ocr") for m, u in enumerate([5, 5, 90, 3, 4, None, 2, 1, 1])]
    s = spark.createDataFrame(rows, "series long, ts string, event_id long, util double, stage string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = [(r.n, r.seconds, r.kind) for r in M.dips(s, 20, 60, 90).orderBy("t0").collect()]
    assert got == [(2, 60, "cold_start"), (2, 60, "stall"), (3, 120, "stall")]
    d = M.duty_cycle(s, 20).first()
    assert (d.episodes, d.max_len) == (3, 3)


@pytest.mark.parametrize("m, want", [((0.1, 9, 90, 0, 4, 0), "memory"), ((0, 9, 90, 400, 4, 0), "mixed"), ((0, 9, 90, 0, 4, 0), "gpu"), ((0, 9, 5, 400, 4, 0), "cpu"), ((0, 9, 5, 5, 4, 5), "underutilised")])
def test_verdicts(spark, m, want):
    df = spark.createDataFrame([tuple(map(float, m))], "swap_delta double, avail double, gpu double, cpu double, cores double, sys double")
    assert M.verdict(df).first().verdict == want


def test_rasters(spark):
    got = {r.id: r for r in R.profiles(spark.createDataFrame(rasters(), "id long, h int, w int, data binary")).collect()}
    assert got[0].inner_gutter is not None and got[1].inner_gutter is None
    assert got[2].rule_y == 30 and got[3].rule_y is None and got[4].rule_y is None
    assert got[5].two_up is not None and got[1].two_up is None


def test_rotations(spark):
    df = spark.createDataFrame([("90:CW@3:9",), ("1.5:ccw@4:end",), ("0:CW",)], "s string")
    got = [r[0] for r in df.select(P.rotation(F.col("s"))).collect()]
    assert [(r.degrees, r.first, r.last) if r else None for r in got] == [(90.0, 3, 9), (-1.5, 4, None), None]
    with pytest.raises(Exception, match="bad rotation"):
        spark.createDataFrame([("270:CW",)], "s string").select(P.rotation(F.col("s"))).collect()


def test_drop_specs(spark):
    r = spark.createDataFrame([("odd:3-8",)], "s string").select(P.drop_spec(F.col("s")).alias("d")).first().d
    assert (r.mode, r.lo, r.hi) == ("odd", 3, 8)


def test_catalogue_contract(spark):
    good = spark.createDataFrame([], "edition_id long, pub_id string, file_path string, content_hash string")
    assert C.verify_catalogue(good, 1) is good
    for df, version in ((good.drop("pub_id"), 1), (good, 0)):
        with pytest.raises(ValueError):
            C.verify_catalogue(df, version)


def test_tables_are_kept(spark):
    d = D.build(blk(spark, [(0, "Table", "a b", None)]).withColumn("html", F.lit("<table>"))).first()
    assert d.blocks[0].table.content == "<table>" and d.blocks[0].type == "table"


def test_added_pages_need_their_anchor(spark):
    f = spark.createDataFrame([(1, 1, "p1.jpg", "x")], "book int, file_idx long, name string, sha string")
    a = spark.createDataFrame([(1, 1, 0, "y"), (1, 1, 1, "z"), (1, 1, 2, "x"), (1, 1, 3, "y")], "book int, after long, ord int, sha string")
    assert sorted(r.new_name for r in P.add_pages(f, a).collect()) == ["p1a.jpg", "p1b.jpg"]
    with pytest.raises(Exception, match="no page 9"):
        P.add_pages(f, a.withColumn("after", F.lit(9).cast("long"))).collect()


def test_letters_beyond_two(spark):
    n = [0, 25, 26, 701, 702, 18277, 18278]
    df = spark.createDataFrame([(i,) for i in n], "n long").select("n", P.letters(F.col("n")).alias("w"))
    df = df.withColumn("back", P.letters_number(F.col("w")))
    assert [(r.w, r.back) for r in df.orderBy("n").collect()] == list(zip(["a", "z", "aa", "zz", "aaa", "zzz", "aaaa"], n, strict=True))


def test_letters_in_use_are_not_given_again(spark):
    files = spark.createDataFrame([("b", 1, "p1.jpg", "x"), ("b", 2, "p1a.jpg", "y"), ("b", 3, "p1c.jpg", "z")], "book string, file_idx long, name string, sha string")
    added = spark.createDataFrame([("b", 1, 1, "n1"), ("b", 1, 2, "n2"), ("b", 1, 3, "n3"), ("b", 1, 4, "y")], "book string, after long, ord int, sha string")
    assert [r.new_name for r in P.add_pages(files, added).orderBy("ord").collect()] == ["p1b.jpg", "p1d.jpg", "p1e.jpg"]


def test_long_numbers_are_not_cut(spark):
    files = spark.createDataFrame([(1, i, f"p{i}", "arabic", i) for i in (1, 2)], "book long, file_idx long, name string, kind string, printed long")
    pages = spark.createDataFrame([(1, 12344, "n", "t")], "doc_id long, page_idx int, page_name string, page_text string")
    assert [r.file for r in P.unscramble(files).collect()] == ["0001", "0002"]
    assert "PAGE 12345 ::" in K.book_text(pages).first().book_text


def test_sampled_side(spark):
    rows = [(1, i, s, 5 if (s == "bottom") == (i in (1, 3, 5, 7, 9)) else None) for i in range(1, 10) for s in ("top", "bottom")]
    assert P.better_side(spark.createDataFrame(rows, "book long, file_idx long, side string, val long"), 3).first().side == "bottom"


def test_actions_and_bounds(spark):
    rows = [(False, 8.0, 0.25, 75.0), (False, 8.0, 0.1, 75.0), (False, 8.0, 0.1, 88.0), (False, 8.0, None, 70.0), (True, 8.0, 0.0, 80.0), (False, 1.9, 0.0, 80.0), (False, None, None, None)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, swapped boolean, avail double, idle double, busy double")
    got = [r.action for r in M.recommend(df).orderBy("i").collect()]
    assert got == ["fix stalls first", "balanced", "saturated", "headroom: add an instance", "reduce instances", "reduce instances", "balanced"]
    m = [("ioreg", 55.0, "gpu"), ("nvml", 55.0, "underutilised"), ("off", 99.0, "underutilised"), ("nvml", 70.0, "gpu"), ("nvml", None, "unknown")]
    df = spark.createDataFrame([(i, 0.0, 8.0, g, None, 4, None, p) for i, (p, g, _) in enumerate(m)], "i int, swap_delta double, avail double, gpu double, cpu double, cores int, sys double, provider string")
    assert [r.verdict for r in M.verdict(df).orderBy("i").collect()] == [v for *_, v in m]


def test_process_tree_with_unknown_and_null_parents(spark):
    procs = spark.createDataFrame([(1, 0), (2, 1), (3, 99), (4, 3), (5, None), (6, 4), (7, 7)], "pid long, ppid long")
    got = {r.pid: (r.root, r.depth) for r in M.process_tree(procs, spark).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (3, 0), 4: (3, 1), 5: (5, 0), 6: (3, 2), 7: (7, 0)}


def test_heading_tags_in_any_case(spark):
    df = spark.createDataFrame([("<H3>x</H3>", "SectionHeader"), ("<h1>", "SectionHeader"), (None, "Title"), ("x", "Text")], "html string, label string")
    assert [r[0] for r in df.select(T.heading_level(F.col("html"), F.col("label"))).collect()] == [3, 1, 1, 2]


def test_merged_columns():
    import numpy as np

    page = np.full((100, 200), 255, np.uint8)
    page[10:40, 5:95] = page[10:40, 105:195] = 0  # two columns
    page[50:90, 5:195] = 0  # one
    assert R.merged_columns(page, [(0, 5, 200, 45), (0, 50, 200, 90), (0, 5, 90, 45), (0, 95, 200, 100)]) == [0]
    inside = np.full((20, 100), 255, np.uint8)
    inside[:, 32:45] = inside[:, 55:68] = 0  # ink between the shares only
    assert R.inner_gutter(inside) is None and R.inner_gutter(page[:, :15]) is None
