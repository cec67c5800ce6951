"""Queries over blocks: text, order, structure, notes, reading."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import geometry as G
from ..operators import notes as N
from ..operators import structure as S
from ..sources.tables import DUCK_BLK, blocks, read
from . import docbuild as D

QUERIES: dict = {}
ORACLES: dict[str, str] = {}
KEY = ["doc_id", "page_idx", "block_idx"]
K = "doc_id, page_idx, block_idx"


def query(oracle: str | None = None):
    """Registers a function of (spark, sf_dir) as q_<name>, with its SQL."""

    def add(f):
        QUERIES["q_" + f.__name__] = f
        if oracle is not None:
            ORACLES["q_" + f.__name__] = oracle
        return f

    return add


# parts of DuckDB's SQL


def d_strip(t: str) -> str:
    return rf"regexp_replace({t}, '^\s+|\s+$', '', 'g')"


def d_dehyphenate(t: str) -> str:
    return rf"regexp_replace({t}, '([\p{{L}}\p{{N}}_])-\n[ \t]*([a-zà-ÿ])', '\1\2', 'g')"


def d_norm(t: str, joined: bool = True) -> str:
    t = f"replace(replace({t}, 'ﬁ', 'fi'), '’', '''')"
    t = rf"regexp_replace({d_dehyphenate(t) if joined else t}, '[ \t]{{2,}}', ' ', 'g')"
    t = rf"regexp_replace({t}, '[ \t]*\n[ \t]*', chr(10), 'g')"
    return d_strip(rf"regexp_replace({t}, '\n{{3,}}', chr(10) || chr(10), 'g')")


def d_emit(t: str) -> str:
    return rf"replace(regexp_replace({t}, '[ \t]*\[\^[^\]]*\]', '', 'g'), '—', '--')"


def d_get(t: str, pattern: str, group: int = 1) -> str:
    return f"nullif(regexp_extract({t}, '{pattern}', {group}), '')"


def d_marker(t: str, bare: bool = False) -> str:
    p = [r"^\s*\[\^([^\]]+)\]", r"^\s*[\(\[]?(\d{1,4})[\)\]]?[.):]", r"^\s*[\(\[](\d{1,4})[\)\]]", rf"^\s*([{T.SYMBOLS}]+)"] + [r"^\s*(\d{1,4})\s"] * bare
    return f"coalesce({', '.join(d_get(t, x) for x in p)})"


def d_squeezed(t: str) -> str:
    return rf"lower(regexp_replace({t}, '\s+', '', 'g'))"


def d_notes(t: str) -> str:
    return f"regexp_matches({d_squeezed(t)}, '^(endnotes|referencenotes|chapternotes|notes)')"


def d_lines(t: str) -> str:
    return rf"list_filter(string_split({t}, chr(10)), lambda x: regexp_matches(x, '\S'))"


def d_lengths(t: str) -> str:
    return f"list_transform({d_lines(t)}, lambda x: length(x))"


def d_ragged(t: str) -> str:
    n = d_lengths(t)
    return f"(len({n}) >= 2 AND len(list_filter({n}, lambda x: x < 0.6 * list_max({n}))) >= 2)"


def d_flowed(t: str) -> str:
    n = d_lengths(t)
    return f"(len({n}) >= 4 AND len(list_filter({n}, lambda x: x >= 0.8 * list_max({n}))) >= len({n}) - 1)"


def d_key(t: str) -> str:
    v = rf"list_transform(regexp_split_to_array({d_strip(t)}, '\s+'), lambda x: try_cast(x AS int))"
    rising = f"list_aggregate(list_transform(range(1, len({v})), lambda i: CASE WHEN {v}[i + 1] > {v}[i] THEN 1 ELSE 0 END), 'min') = 1"
    falling = f"list_aggregate(list_transform(range(1, len({v})), lambda i: CASE WHEN {v}[i + 1] < {v}[i] THEN 1 ELSE 0 END), 'min') = 1"
    return rf"(CASE WHEN regexp_full_match({d_strip(t)}, '\d{{1,2}}(\s+\d{{1,2}}){{3,}}') THEN list_max({v}) <= 24 AND ({rising} OR {falling}) ELSE false END)"


def d_copyright(t: str) -> str:
    return f"regexp_matches({t}, '(?i){T.COPYRIGHT}')"


def d_enumerator(t: str) -> str:
    return f"(regexp_matches({t}, '(?i){T.ENUMERATOR}') OR regexp_matches({t}, '{T.BULLET}'))"


def d_toc(t: str) -> str:
    return f"(regexp_matches({t}, '{T.LEADERS}') OR len(list_filter(string_split({t}, chr(10)), lambda x: regexp_matches(x, '{T.TOC_LINE}'))) >= 2)"


def _d_kind(t: str, kinds: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN regexp_matches({t}, '(?i){p}') THEN '{k}'" for p, k in kinds) + " END"


def d_nav(t: str) -> str:
    return _d_kind(t, T.NAV)


def d_chapter(t: str) -> str:
    return f"nullif(lower(regexp_extract({t}, '(?i){T.CHAPTER}', 1)), '')"


def d_dedication(t: str) -> str:
    return f"(regexp_matches({t}, '(?i){T.DEDICATION}') AND length({t}) < 200)"


def d_note_toc(t: str, in_toc: str) -> str:
    x = d_strip(f"replace({t}, chr(10), ' ')")
    return f"(regexp_matches({x}, '{T.TOC_LEADERS}') OR ({in_toc} AND (regexp_matches({x}, '{T.TOC_DOTS}') OR (length({x}) <= 80 AND regexp_matches({x}, '{T.TOC_TAIL}')))))"


W = r"[\p{L}\p{N}_]"
D_COLON = r"regexp_matches(bt, '[:：]\s*$')"
D_LEAD = rf"({D_COLON} AND regexp_matches(lower(bt), '(^|[^\p{{L}}\p{{N}}_])(?:{T.CUE_WORDS})([^\p{{L}}\p{{N}}_]|$)'))"
D_SOURCE = d_get(d_strip("text"), T.SOURCE.replace(r"\w", r"\p{L}\p{N}_"))

BLK = f"WITH {DUCK_BLK}"
ORDER = f"""{BLK},
nf AS (SELECT *, max(x1) OVER (PARTITION BY doc_id, page_idx ORDER BY x0, x1, block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM blk WHERE label <> 'Footnote'),
cl AS (SELECT *, sum(CASE WHEN reach IS NOT NULL AND x0 > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_idx ORDER BY x0, x1, block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS col FROM nf),
ro AS (SELECT b.*, cast(c.col AS bigint) AS col, row_number() OVER (PARTITION BY b.doc_id, b.page_idx ORDER BY CASE WHEN b.label = 'Footnote' THEN 1 ELSE 0 END, coalesce(c.col, 0), b.y0, b.block_idx) AS seq
    FROM blk b LEFT JOIN cl c ON b.doc_id = c.doc_id AND b.page_idx = c.page_idx AND b.block_idx = c.block_idx)"""


# order and text


@query(f"""{ORDER} SELECT doc_id, page_idx, string_agg({d_emit(d_norm('text'))}, chr(10) || chr(10) ORDER BY seq) AS page_text, count(*) AS n_blocks
FROM ro WHERE label NOT IN ('PageHeader', 'PageFooter') GROUP BY doc_id, page_idx""")
def body_text(spark, sf_dir):
    return D.page_text(blocks(spark, sf_dir))


@query(f"{ORDER} SELECT {K}, col, seq FROM ro")
def reading_order(spark, sf_dir):
    return G.reading_order(blocks(spark, sf_dir)).select(*KEY, "col", F.col("seq").cast("long").alias("seq"))


@query(f"{ORDER} SELECT doc_id, page_idx, max(col) + 1 AS columns, count(*) AS n FROM ro WHERE col IS NOT NULL GROUP BY doc_id, page_idx")
def page_columns(spark, sf_dir):
    b = G.with_columns(blocks(spark, sf_dir), F.col("label") != "Footnote").filter("col IS NOT NULL")
    return b.groupBy("doc_id", "page_idx").agg((F.max("col") + 1).alias("columns"), F.count(F.lit(1)).alias("n"))


@query(f"""{BLK} SELECT {K} FROM blk a WHERE EXISTS (SELECT 1 FROM blk b WHERE a.doc_id = b.doc_id AND a.page_idx = b.page_idx AND a.block_idx <> b.block_idx
    AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1)""")
def overlap_uncertain(spark, sf_dir):
    return G.overlapping(blocks(spark, sf_dir)).select(*KEY)


@query(f"{BLK} SELECT {K}, {d_norm('nfc_normalize(text)')} AS norm FROM blk")
def norm_text(spark, sf_dir):
    return blocks(spark, sf_dir).select(*KEY, T.normalize(F.col("text")).alias("norm"))


@query("SELECT id, nfc_normalize(chr(cast(base AS int)) || chr(cast(mark AS int))) AS norm FROM (SELECT row_number() OVER (ORDER BY base, mark) - 1 AS id, base, mark FROM range(97, 123) a(base), range(768, 776) b(mark))")
def nfc_marks(spark, sf_dir):
    d = spark.range(26 * 8).select("id", F.concat(F.decode(F.unhex(F.hex(97 + F.floor(F.col("id") / 8))), "UTF-8"), F.element_at(F.array(*[F.lit(chr(768 + i)) for i in range(8)]), (F.col("id") % 8 + 1).cast("int"))).alias("t"))
    return d.select("id", T.nfc(F.col("t")).alias("norm"))


@query(f"{BLK} SELECT {K}, {d_emit('text')} AS emitted FROM blk")
def norm_emit(spark, sf_dir):
    return blocks(spark, sf_dir).select(*KEY, T.emit(F.col("text"), True, True).alias("emitted"))


@query(f"{BLK} SELECT {K}, {d_dehyphenate('text')} AS joined FROM blk WHERE k = 11")
def dehyphenate(spark, sf_dir):
    return blocks(spark, sf_dir).filter("k = 11").select(*KEY, T.dehyphenate(F.col("text")).alias("joined"))


@query()
def html_text(spark, sf_dir):
    return read(spark, sf_dir, "pages").select("page_id", T.html_text("html").alias("plain"))


@query(r"SELECT page_id, len(regexp_extract_all(html, '<[a-z][a-z0-9]*')) AS tags, len(regexp_extract_all(html, '&[a-z]+;')) AS entities FROM pages")
def html_tags(spark, sf_dir):
    n = lambda p: F.regexp_count("html", F.lit(p)).cast("long")
    return read(spark, sf_dir, "pages").select("page_id", n("<[a-z][a-z0-9]*").alias("tags"), n("&[a-z]+;").alias("entities"))


@query(rf"""{BLK} SELECT {K}, array_to_string(list_transform(regexp_extract_all(text, '\[\^[^\]]+\]|\[\d{{1,3}}\]'), lambda m: regexp_replace(m, '^\[\^?|\]$', '', 'g')), ',') AS refs
FROM blk WHERE regexp_matches(text, '\[\^[^\]]+\]|\[\d{{1,3}}\]')""")
def find_refs(spark, sf_dir):
    r = blocks(spark, sf_dir).withColumn("r", T.find_refs(F.col("text")))
    return r.filter(F.size("r") > 0).select(*KEY, F.array_join("r", ",").alias("refs"))


@query(f"{BLK} SELECT {K}, {d_marker('text')} AS marker, {d_marker('text', True)} AS bare FROM blk WHERE {d_marker('text', True)} IS NOT NULL")
def extract_marker(spark, sf_dir):
    b = blocks(spark, sf_dir).select(*KEY, T.marker(F.col("text")).alias("marker"), T.marker(F.col("text"), True).alias("bare"))
    return b.filter("bare IS NOT NULL")


@query(f"{BLK} SELECT {K}, coalesce({d_get(d_squeezed('text'), 'chapter([a-z0-9]+)$')}, {d_get(d_squeezed('text'), 'to(?:the)?([a-z0-9]+)$')}) AS scope FROM blk WHERE {d_notes('text')}")
def notes_heading(spark, sf_dir):
    b = blocks(spark, sf_dir).filter(T.is_notes_heading(F.col("text")))
    return b.select(*KEY, T.notes_scope(F.col("text")).alias("scope"))


CUES = f"{ORDER}, bf AS (SELECT *, lag(text, 1, '') OVER (PARTITION BY doc_id ORDER BY page_idx, seq) AS bt FROM ro)"


def _cues(spark, sf_dir):
    from pyspark.sql import Window

    b = G.reading_order(blocks(spark, sf_dir)).withColumn("bt", F.lag("text", 1, "").over(Window.partitionBy("doc_id").orderBy("page_idx", "seq")))
    return b.withColumns({"colon": T.after_colon(F.col("bt")), "lead_in": T.lead_in(F.col("bt")), "source": T.trailing_source(F.col("text"))})


@query(f"{CUES} SELECT {K}, {D_COLON} AS colon, {D_LEAD} AS lead_in, {D_SOURCE} AS source FROM bf WHERE {D_COLON} OR {D_SOURCE} IS NOT NULL")
def cues(spark, sf_dir):
    return _cues(spark, sf_dir).filter("colon OR source IS NOT NULL").select(*KEY, "colon", "lead_in", "source")


@query(f"{BLK} SELECT {K}, {D_SOURCE} AS source FROM blk WHERE {D_SOURCE} IS NOT NULL")
def trailing_source(spark, sf_dir):
    return blocks(spark, sf_dir).select(*KEY, T.trailing_source(F.col("text")).alias("source")).filter("source IS NOT NULL")


@query(f"{CUES} SELECT {K} FROM bf WHERE label = 'Text' AND ({D_LEAD} OR {D_SOURCE} IS NOT NULL)")
def quote_candidates(spark, sf_dir):
    return _cues(spark, sf_dir).filter("label = 'Text' AND (lead_in OR source IS NOT NULL)").select(*KEY)


def _predicate(name: str, test, sql: str) -> None:
    QUERIES[f"q_{name}"] = lambda spark, sf_dir: blocks(spark, sf_dir).filter(test(F.col("text"))).select(*KEY)
    ORACLES[f"q_{name}"] = f"{BLK} SELECT {K} FROM blk WHERE {sql}"


for _name, _test, _sql in (
    ("printer_key", T.is_printer_key, d_key("text")),
    ("copyright", T.is_copyright, d_copyright("text")),
    ("enumerator", T.has_enumerator, d_enumerator("text")),
    ("ragged", T.is_ragged, d_ragged("text")),
    ("list_item", T.is_list_item, f"{d_enumerator('text')} AND NOT {d_ragged('text')}"),
    ("toc_block", T.is_toc, d_toc("text")),
    ("terminated", T.terminated, rf"(regexp_replace(text, '\s+$', '') = '' OR right(regexp_replace(text, '\s+$', ''), 1) IN ('.', '!', '?', '\"', '''', ')', ']', '”', '’', '…'))".replace('\\"', '"')),
):
    _predicate(_name, _test, _sql)


#: Lines of raw as a page wraps them: 26 characters each, some with a short last one.
WRAPPED = "concat_ws(chr(10), substr(raw, 1, 26), substr(raw, 27, 26), substr(raw, 53, 26), substr(raw, 79, 12 + 14 * (line_no % 2)))"


@query(f"{BLK}, wr AS (SELECT {K}, {WRAPPED} AS text FROM blk) SELECT {K} FROM wr WHERE {d_flowed('text')}")
def flowed(spark, sf_dir):
    b = blocks(spark, sf_dir).withColumn("text", F.expr(WRAPPED))
    return b.filter(T.is_flowed(F.col("text"))).select(*KEY)


D_REF = d_get("text", r"^\s*(\d+(?:\.\d+)*)\s*[.)—\-\s]")


@query(f"{BLK} SELECT {K}, {D_REF} AS ref_label FROM blk WHERE {D_REF} IS NOT NULL")
def ref_label(spark, sf_dir):
    return blocks(spark, sf_dir).select(*KEY, T.ref_label(F.col("text")).alias("ref_label")).filter("ref_label IS NOT NULL")


@query("SELECT doc_id, substr(sha256(text), 1, 16) AS hash FROM documents")
def doc_id_hash(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.doc_id_of(F.col("text")).alias("hash"))


D_LETTERS = r"len(regexp_extract_all(text, '\p{L}'))"
D_FAR = r"len(list_filter(regexp_extract_all(text, '\p{L}'), lambda x: unicode(x) >= 592 AND unicode(x) NOT BETWEEN 7680 AND 7935))"


@query(f"SELECT doc_id, CASE WHEN {D_LETTERS} > 0 THEN round({D_FAR} / {D_LETTERS}::double, 6) ELSE 0.0::double END AS share FROM documents")
def nonlatin_fraction(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.round(T.nonlatin_fraction(F.col("text")), 6).alias("share"))


D_LATIN, D_OTHER = (f"len(regexp_extract_all(text, '{p}'))" for p in (r"[A-Za-z\x{C0}-\x{24F}\x{1E00}-\x{1EFF}]", r"[\x{0F00}-\x{0FFF}\x{3400}-\x{9FFF}\x{3040}-\x{30FF}\x{AC00}-\x{D7A3}\x{0E00}-\x{0E7F}]"))


@query(f"SELECT doc_id, {D_LATIN} AS latin, {D_OTHER} AS other FROM documents")
def latin_counts(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", T.latin_count(F.col("text")).cast("long").alias("latin"), T.other_count(F.col("text")).cast("long").alias("other"))


@query(f"{BLK}, p AS (SELECT doc_id, page_idx, string_agg(text, chr(10)) AS text FROM blk GROUP BY doc_id, page_idx) SELECT doc_id, page_idx, NOT ({D_LATIN} >= 10 AND {D_LATIN} >= 0.15 * ({D_LATIN} + {D_OTHER})) AS skip FROM p")
def page_skip(spark, sf_dir):
    p = blocks(spark, sf_dir).groupBy("doc_id", "page_idx").agg(F.concat_ws("\n", F.collect_list("text")).alias("text"))
    return p.select("doc_id", "page_idx", T.skips_page(F.col("text")).alias("skip"))


@query(f"{BLK}, p AS (SELECT doc_id, page_idx, string_agg(text, chr(10)) AS text FROM blk GROUP BY doc_id, page_idx), q AS (SELECT doc_id, page_idx FROM p WHERE {D_LETTERS} >= 20 AND {D_FAR} > 0.5 * {D_LETTERS}) SELECT doc_id, page_idx, count(*) AS n FROM blk WHERE NOT EXISTS (SELECT 1 FROM q WHERE q.doc_id = blk.doc_id AND q.page_idx = blk.page_idx) GROUP BY doc_id, page_idx")
def drop_nonlatin_pages(spark, sf_dir):
    b = blocks(spark, sf_dir)
    p = b.groupBy("doc_id", "page_idx").agg(F.concat_ws("\n", F.collect_list("text")).alias("text"))
    gone = p.filter((F.regexp_count("text", F.lit(r"\p{L}")) >= 20) & (T.nonlatin_fraction(F.col("text")) > 0.5)).select("doc_id", "page_idx")
    return b.join(gone, ["doc_id", "page_idx"], "left_anti").groupBy("doc_id", "page_idx").agg(F.count(F.lit(1)).alias("n"))


@query(rf"{BLK} SELECT DISTINCT doc_id, page_idx, page_name FROM blk WHERE NOT (cast(regexp_extract(page_name, '(\d+)', 1) AS int) % 2 = 0 AND cast(regexp_extract(page_name, '(\d+)', 1) AS int) BETWEEN 2 AND 6)")
def drop_pages_parity(spark, sf_dir):
    n = F.regexp_extract("page_name", r"(\d+)", 1).cast("int")
    return blocks(spark, sf_dir).select("doc_id", "page_idx", "page_name").distinct().filter(~((n % 2 == 0) & n.between(2, 6)))


# structure

VERSE = f"""{BLK},
ac AS (SELECT *, max(x1) OVER (PARTITION BY doc_id, page_idx ORDER BY x0, x1, block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM blk),
ad AS (SELECT *, sum(CASE WHEN reach IS NOT NULL AND x0 > reach THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_idx ORDER BY x0, x1, block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS col2, label NOT IN ('PageHeader', 'PageFooter', 'Table', 'Figure', 'Picture') AND x1 > x0 AS textish FROM ac),
mg AS (SELECT doc_id, page_idx, col2, median(x0) AS ml, median(x1) AS mr, count(*) AS n_text FROM ad WHERE textish GROUP BY doc_id, page_idx, col2 HAVING count(*) >= 2 AND median(x1) > median(x0)),
ve AS (SELECT ad.*, mg.ml, mg.mr, textish AND mg.ml IS NOT NULL AND label = 'Text' AS cand, (x0 - ml) / (mr - ml) AS lf, (mr - x1) / (mr - ml) AS rt FROM ad LEFT JOIN mg ON ad.doc_id = mg.doc_id AND ad.page_idx = mg.page_idx AND ad.col2 = mg.col2),
vf AS (SELECT *, CASE WHEN cand THEN round(greatest(0.0, lf), 3) END AS indent, CASE WHEN cand THEN lf >= 0.06 AND rt >= 0.06 AND abs((x0 + x1 - ml - mr) / 2 / (mr - ml)) <= 0.07 END AS centered FROM ve),
vt AS (SELECT *, CASE WHEN cand AND len({d_lines('text')}) >= 2 AND (greatest(0.0, lf) >= 0.035 OR centered) THEN CASE WHEN {d_flowed('text')} THEN 'quote' ELSE 'verse' END END AS verse_type FROM vf)"""


@query(f"{VERSE} SELECT {K}, indent, centered, verse_type FROM vt WHERE cand")
def verse_detect(spark, sf_dir):
    return S.verses(blocks(spark, sf_dir)).filter("indent IS NOT NULL").select(*KEY, "indent", "centered", "verse_type")


@query(f"{VERSE} SELECT doc_id, page_idx, cast(col2 AS bigint) AS col2, ml, mr, n_text FROM mg")
def column_margins(spark, sf_dir):
    return S.verses(blocks(spark, sf_dir)).filter("ml IS NOT NULL").select("doc_id", "page_idx", "col2", "ml", "mr", "n_text").distinct()


HEADS = rf"""rb AS (SELECT *, CASE WHEN (y0 + y1) / 2 < 0.1 * page_h THEN 'top' WHEN (y0 + y1) / 2 > 0.9 * page_h THEN 'bottom' END AS band, substr({d_strip(r"regexp_replace(text, '\d+', '#', 'g')")}, 1, 80) AS mask FROM blk),
rr AS (SELECT doc_id, band, mask FROM rb WHERE band IS NOT NULL AND mask <> '' GROUP BY doc_id, band, mask HAVING count(DISTINCT page_idx) >= 3),
rh AS (SELECT rb.*, CASE WHEN regexp_full_match({d_strip('text')}, '\d+') THEN 'page_number' WHEN rb.band = 'top' THEN 'page_header' ELSE 'page_footer' END AS head_type FROM rb JOIN rr ON rb.doc_id = rr.doc_id AND rb.band = rr.band AND rb.mask = rr.mask)"""


@query(f"{BLK}, {HEADS} SELECT {K}, head_type FROM rh")
def running_heads(spark, sf_dir):
    return S.running_heads(blocks(spark, sf_dir)).select(*KEY, "head_type")


SIGNS = f"""{VERSE}, {HEADS},
si AS (SELECT vt.*, rh.head_type, CASE WHEN rh.head_type IS NOT NULL THEN rh.head_type WHEN {d_key('vt.text')} OR {d_copyright('vt.text')} THEN 'copyright' WHEN verse_type IS NOT NULL THEN verse_type
    WHEN {d_enumerator('vt.text')} AND NOT {d_ragged('vt.text')} THEN 'list_item' WHEN {d_toc('vt.text')} THEN 'toc' END AS sign FROM vt LEFT JOIN rh ON vt.doc_id = rh.doc_id AND vt.page_idx = rh.page_idx AND vt.block_idx = rh.block_idx)"""
SIGNALS = f"""{SIGNS},
sg AS (SELECT doc_id, page_idx, bool_or(coalesce(sign, '') = 'copyright') AS copyright, bool_or(coalesce(sign, '') = 'toc' OR (label = 'SectionHeader' AND regexp_matches(text, '(?i){T.CONTENTS}'))) AS toc,
    count(*) FILTER (label = 'Text' AND length(text) > 80) AS prose, bool_or(label = 'SectionHeader' AND regexp_matches(text, '(?i){T.BACK_MATTER}')) AS back, count(*) AS n_blocks FROM si GROUP BY doc_id, page_idx)"""
REGIONS = f"""{SIGNALS},
sn AS (SELECT *, max(page_idx) OVER (PARTITION BY doc_id) + 1 AS n, min(CASE WHEN NOT (copyright OR toc OR prose = 0) THEN page_idx END) OVER (PARTITION BY doc_id) AS ff FROM sg),
se AS (SELECT *, least(coalesce(ff, n), greatest(8, cast(floor(n * 0.25) AS int))) AS fe FROM sn),
sb AS (SELECT *, min(CASE WHEN back AND page_idx >= greatest(fe, cast(floor(n / 2) AS int)) THEN page_idx END) OVER (PARTITION BY doc_id) AS bs FROM se),
rg AS (SELECT *, CASE WHEN n <= 2 THEN 'body' WHEN page_idx < fe THEN 'front' WHEN page_idx >= bs THEN 'back' ELSE 'body' END AS region FROM sb)"""


def _signals(spark, sf_dir):
    return S.page_signals(S.signs(blocks(spark, sf_dir)))


@query(f"{SIGNALS} SELECT * FROM sg")
def page_signals(spark, sf_dir):
    return _signals(spark, sf_dir)


@query(f"{REGIONS} SELECT doc_id, page_idx, region FROM rg")
def regions(spark, sf_dir):
    return S.regions(_signals(spark, sf_dir)).select("doc_id", "page_idx", "region")


@query(f"{SIGNS} SELECT {K}, sign FROM si WHERE sign IS NOT NULL")
def signs(spark, sf_dir):
    return S.signs(blocks(spark, sf_dir)).filter("sign IS NOT NULL").select(*KEY, "sign")


ON = " AND ".join(f"ro.{c} = {{0}}.{c}" for c in KEY)
TYPED = f"""{REGIONS}{ORDER.removeprefix(BLK)},
ov AS (SELECT DISTINCT a.doc_id, a.page_idx, a.block_idx FROM blk a JOIN blk b ON a.doc_id = b.doc_id AND a.page_idx = b.page_idx AND a.block_idx <> b.block_idx AND a.x0 < b.x1 AND b.x0 < a.x1 AND a.y0 < b.y1 AND b.y0 < a.y1),
pn AS (SELECT doc_id, page_idx, arg_min({_d_kind('text', T.NAV_HEAD)}, block_idx) FILTER (({_d_kind('text', T.NAV_HEAD)}) IS NOT NULL) AS page_nav FROM blk WHERE label = 'PageHeader' GROUP BY doc_id, page_idx),
t0 AS (SELECT ro.*, si.sign, si.indent, rg.region, rg.region = 'front' AND NOT rg.copyright AND NOT rg.toc AND rg.prose = 0 AND rg.n_blocks <= 8 AS title_pg, ov.doc_id IS NOT NULL AS unsure, pn.page_nav, {d_norm('ro.text')} AS norm,
    CASE ro.label WHEN 'PageHeader' THEN 'page_header' WHEN 'SectionHeader' THEN 'heading' WHEN 'Footnote' THEN 'footnote' ELSE 'body' END AS base
    FROM ro LEFT JOIN si ON {ON.format('si')} LEFT JOIN rg ON ro.doc_id = rg.doc_id AND ro.page_idx = rg.page_idx LEFT JOIN ov ON {ON.format('ov')} LEFT JOIN pn ON ro.doc_id = pn.doc_id AND ro.page_idx = pn.page_idx),
t1 AS (SELECT *, sum(CASE WHEN base = 'heading' THEN 1 ELSE 0 END) OVER d AS hn, last_value(CASE WHEN base = 'heading' THEN {d_chapter('norm')} END IGNORE NULLS) OVER d AS chapter,
    row_number() OVER (PARTITION BY doc_id ORDER BY page_idx, seq) AS rn FROM t0 WINDOW d AS (PARTITION BY doc_id ORDER BY page_idx, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
t2 AS (SELECT *, max(CASE WHEN base = 'heading' THEN {d_nav('norm')} END) OVER (PARTITION BY doc_id, hn) AS nav FROM t1),
t3 AS (SELECT *, CASE WHEN base = 'body' AND coalesce(page_nav, nav) IS NOT NULL THEN coalesce(page_nav, nav) WHEN base = 'page_header' AND regexp_matches(norm, '(?i){T.PAGE_NUMBER}') THEN 'page_number'
    WHEN base = 'footnote' AND {d_note_toc('norm', "(coalesce(page_nav, '') = 'toc' OR coalesce(nav, '') = 'toc')")} THEN 'toc' ELSE base END AS knd FROM t2),
t4 AS (SELECT *, CASE WHEN region = 'back' AND (coalesce(sign, '') = 'copyright' OR (base = 'heading' AND regexp_matches(text, '(?i){T.COLOPHON}'))) THEN 'colophon'
    WHEN region = 'front' AND {d_dedication('text')} AND coalesce(sign, '') NOT IN ('copyright', 'toc') THEN 'dedication'
    WHEN region = 'front' AND title_pg AND coalesce(sign, '') NOT IN ('copyright', 'toc', 'page_header', 'page_footer', 'page_number') THEN 'title_page'
    WHEN region <> 'body' AND coalesce(sign, '') IN ('verse', 'quote') THEN CASE WHEN NOT title_pg AND len({d_lines('text')}) >= 3 THEN 'epigraph' END ELSE sign END AS shape FROM t3),
t5 AS (SELECT *, CASE WHEN shape IN ('verse', 'quote', 'list_item', 'epigraph') THEN CASE WHEN knd = 'body' THEN shape ELSE knd END WHEN shape IN ('page_header', 'page_footer', 'page_number', 'title_page', 'dedication', 'colophon') THEN shape
    WHEN shape IS NOT NULL AND knd <> 'heading' THEN shape ELSE knd END AS type FROM t4),
t6 AS (SELECT * EXCLUDE (text), CASE WHEN knd = 'footnote' THEN regexp_replace(norm, '{T.MARK}', '') WHEN type IN ('verse', 'epigraph') AND knd = 'body' THEN {d_norm('text', False)} ELSE norm END AS text FROM t5),
t7 AS (SELECT *, lag(text, 1, '') OVER (PARTITION BY doc_id ORDER BY page_idx, seq) AS bt FROM t6),
ty AS (SELECT *, 'b' || lpad(cast(rn AS varchar), 5, '0') AS id, type = 'body' AND ({D_LEAD} OR {D_SOURCE} IS NOT NULL) AS quote_candidate FROM t7)"""


@query(f"{TYPED} SELECT {K}, type, region FROM ty")
def block_types(spark, sf_dir):
    return S.typed(blocks(spark, sf_dir)).select(*KEY, "type", "region")


@query(f"{TYPED} SELECT {K}, type FROM ty WHERE region <> 'body' AND type IN ('epigraph', 'colophon', 'copyright', 'dedication', 'title_page')")
def region_gate(spark, sf_dir):
    return S.typed(blocks(spark, sf_dir)).filter("region <> 'body' AND type IN ('epigraph', 'colophon', 'copyright', 'dedication', 'title_page')").select(*KEY, "type")


@query(f"{TYPED} SELECT {K}, nav FROM ty WHERE nav IS NOT NULL")
def nav_mode(spark, sf_dir):
    return S.typed(blocks(spark, sf_dir)).filter("nav IS NOT NULL").select(*KEY, "nav")


@query(f"{TYPED} SELECT {K}, chapter FROM ty WHERE chapter IS NOT NULL")
def chapter(spark, sf_dir):
    return S.typed(blocks(spark, sf_dir)).filter("chapter IS NOT NULL").select(*KEY, "chapter")


@query(f"{TYPED} SELECT {K}, id FROM ty")
def block_ids(spark, sf_dir):
    return S.typed(blocks(spark, sf_dir)).select(*KEY, "id")


@query(f"{TYPED} SELECT {K} FROM ty WHERE coalesce(confidence < 0.6, false) OR unsure OR quote_candidate")
def needs_review(spark, sf_dir):
    return S.typed(blocks(spark, sf_dir)).filter("needs_review").select(*KEY)


@query(rf"{BLK} SELECT {K}, cast(coalesce(nullif(regexp_extract(coalesce(html, ''), '(?i)<h([1-6])', 1), ''), '2') AS int) AS level FROM blk WHERE label = 'SectionHeader'")
def heading_level(spark, sf_dir):
    return blocks(spark, sf_dir).filter("label = 'SectionHeader'").select(*KEY, T.heading_level(F.col("html"), F.col("label")).alias("level"))


# lines and layout

DET = f"""dl AS (SELECT doc_id, page_idx, block_idx AS b, x0, x1, y0 + (y1 - y0) / m * i AS y0, y0 + (y1 - y0) / m * (i + 1) AS y1 FROM (SELECT *, unnest(range(m)) AS i FROM (SELECT *, len({d_lines('text')}) - CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS m FROM blk) WHERE m > 0))"""
BOXES = f"""{DET}, lb AS (SELECT blk.doc_id, blk.page_idx, blk.block_idx, list(struct_pack(y0 := round(d.y0, 1), x0 := round(d.x0, 1), x1 := round(d.x1, 1), y1 := round(d.y1, 1)) ORDER BY round(d.y0, 1), round(d.x0, 1), round(d.x1, 1), round(d.y1, 1)) AS boxes FROM blk JOIN dl d ON blk.doc_id = d.doc_id AND blk.page_idx = d.page_idx
    AND (d.x0 + d.x1) / 2 BETWEEN blk.x0 - 2 AND blk.x1 + 2 AND (d.y0 + d.y1) / 2 BETWEEN blk.y0 - 2 AND blk.y1 + 2 GROUP BY blk.doc_id, blk.page_idx, blk.block_idx)"""


def det_lines(blk):
    """detected lines, equal bands of each block; one too few for some."""
    m = F.size(T.lines(F.col("text"))) - F.when(F.col("k") % 3 == 0, 1).otherwise(0)
    d = blk.withColumn("m", m).filter("m > 0").withColumn("i", F.explode(F.sequence(F.lit(0), F.col("m") - 1)))
    step = (F.col("y1") - F.col("y0")) / F.col("m")
    return d.select("doc_id", "page_idx", "x0", "x1", (F.col("y0") + step * F.col("i")).alias("y0"), (F.col("y0") + step * (F.col("i") + 1)).alias("y1"))


def _boxes(spark, sf_dir):
    b = blocks(spark, sf_dir)
    return G.line_boxes(b, det_lines(b))


@query(f"{BLK}, {BOXES} SELECT lb.doc_id, lb.page_idx, lb.block_idx, cast(len(boxes) AS bigint) AS n, boxes[1].y0 AS top FROM lb JOIN blk ON blk.doc_id = lb.doc_id AND blk.page_idx = lb.page_idx AND blk.block_idx = lb.block_idx WHERE len(boxes) = len({d_lines('text')})")
def line_boxes(spark, sf_dir):
    return _boxes(spark, sf_dir).filter("boxes IS NOT NULL").select(*KEY, F.size("boxes").cast("long").alias("n"), F.get("boxes", F.lit(0))["y0"].alias("top"))


@query(f"""{BLK}, {BOXES}, li AS (SELECT blk.*, CASE WHEN len(lb.boxes) = len({d_lines('text')}) THEN lb.boxes END AS boxes, {d_lines('text')} AS ls FROM blk LEFT JOIN lb ON blk.doc_id = lb.doc_id AND blk.page_idx = lb.page_idx AND blk.block_idx = lb.block_idx),
lj AS (SELECT *, unnest(range(len(ls))) AS line FROM li)
SELECT {K}, line, ls[line + 1] AS line_text, round(coalesce(boxes[line + 1].y0, y0 + (y1 - y0) / len(ls) * line), 3) AS ly0 FROM lj""")
def line_items(spark, sf_dir):
    return G.line_items(_boxes(spark, sf_dir)).select(*KEY, F.col("line").cast("long").alias("line"), "line_text", F.round("ly0", 3).alias("ly0"))


def layout_regions(blk):
    """three regions a page, and a table where the page has two columns."""
    p = blk.groupBy("doc_id", "page_idx").agg(F.bool_or("two").alias("two"))
    box = lambda i, label, x0, y0, x1, y1: F.struct(F.lit(i).alias("region_idx"), F.lit(label).alias("label"), *[F.lit(float(v)).alias(n) for n, v in (("x0", x0), ("y0", y0), ("x1", x1), ("y1", y1))])
    rows = F.array(box(0, "PageHeader", 0, 0, 1000, 100), box(1, "Text", 0, 100, 1000, 1200), box(2, "Footnote", 0, 1200, 1000, 1400), F.when(F.col("two"), box(3, "Table", 0, 100, 500, 700)))
    return p.select("doc_id", "page_idx", F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("r")).select("doc_id", "page_idx", "r.*")


@query(f"""{BLK}, pg AS (SELECT doc_id, page_idx, bool_or(two) AS two FROM blk GROUP BY doc_id, page_idx),
rs AS (SELECT pg.*, v.* FROM pg, (VALUES (0, 'PageHeader', 0.0, 0.0, 1000.0, 100.0), (1, 'Text', 0, 100, 1000, 1200), (2, 'Footnote', 0, 1200, 1000, 1400), (3, 'Table', 0, 100, 500, 700)) v(i, rl, rx0, ry0, rx1, ry1) WHERE i < 3 OR two),
cv AS (SELECT b.doc_id, b.page_idx, b.block_idx, i, rl, greatest(least(x1, rx1) - greatest(x0, rx0), 0.0) * greatest(least(y1, ry1) - greatest(y0, ry0), 0.0) / ((x1 - x0) * (y1 - y0)) AS c FROM blk b JOIN rs ON b.doc_id = rs.doc_id AND b.page_idx = rs.page_idx WHERE (x1 - x0) * (y1 - y0) > 0),
bb AS (SELECT {K}, rl FROM cv WHERE c > 0.5 QUALIFY row_number() OVER (PARTITION BY {K} ORDER BY c DESC, i) = 1)
SELECT b.doc_id AS doc_id, b.page_idx AS page_idx, b.block_idx AS block_idx, coalesce(rl, 'Text') AS new_label FROM blk b LEFT JOIN bb ON b.doc_id = bb.doc_id AND b.page_idx = bb.page_idx AND b.block_idx = bb.block_idx""")
def merge_layout(spark, sf_dir):
    b = blocks(spark, sf_dir)
    return G.merge_layout(b, layout_regions(b)).select(*KEY, "new_label")


@query(f"""{BLK} SELECT cast(doc_id AS varchar) || '-' || page_idx AS page, row_number() OVER (PARTITION BY doc_id, page_idx ORDER BY CASE WHEN block_idx >= 4 THEN 1 ELSE 0 END, block_idx) - 1 AS new_idx, x0 + CASE WHEN block_idx >= 4 THEN 300 ELSE 0 END AS x0 FROM blk""")
def recombine(spark, sf_dir):
    b = blocks(spark, sf_dir).withColumns({"page": F.concat("doc_id", F.lit("-"), "page_idx"), "strip": F.when(F.col("block_idx") >= 4, 1).otherwise(0)})
    b = b.withColumn("stem", F.concat("page", F.lit("__c"), "strip"))
    m = b.select("stem", "page", "strip").distinct().withColumn("x_off", F.col("strip") * 300.0)
    return G.recombine(b.drop("page", "strip"), m).select("page", F.col("new_idx").cast("long").alias("new_idx"), "x0")


# notes


@query()
def notes_exact(spark, sf_dir):
    return N.resolve(blocks(spark, sf_dir)).withColumn("span_pages", F.array_join("span_pages", ","))


NOTE_PAGES = f"""nh AS (SELECT doc_id, page_idx, bool_or(label = 'SectionHeader' AND {d_notes('text')}) AS headed, count(*) FILTER (ok AND m IS NOT NULL) AS marked, count(*) FILTER (ok) AS n, coalesce(bool_or(ok AND m IS NOT NULL AND y0 < 0.5 * page_h), false) AS upper
    FROM (SELECT *, label NOT IN ('PageHeader', 'SectionHeader') AND {d_strip('text')} <> '' AS ok, {d_marker('text')} AS m FROM blk) GROUP BY doc_id, page_idx),
np AS (SELECT doc_id, page_idx, headed, marked >= 3 AND marked >= floor(n / 2) AND upper AS looks FROM nh)"""


@query(f"{BLK}, {NOTE_PAGES} SELECT doc_id, page_idx, headed, looks FROM np")
def note_pages(spark, sf_dir):
    return N.note_pages(blocks(spark, sf_dir))


@query(f"""{BLK}, bd AS (SELECT *, {d_marker('text', True)} AS marker FROM blk WHERE label = 'Footnote' OR y0 >= 0.70 * page_h),
il AS (SELECT *, cast(sum(CASE WHEN marker IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, page_idx ORDER BY y0, block_idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS bigint) AS island FROM bd)
SELECT doc_id, page_idx, island, max(marker) AS marker, count(*) AS n_blocks, string_agg(text, ' ' ORDER BY y0, block_idx) AS note_text FROM il GROUP BY doc_id, page_idx, island""")
def footnote_islands(spark, sf_dir):
    return N.footnote_islands(blocks(spark, sf_dir))


D_SCOPE = f"coalesce({d_get(d_squeezed('text'), 'chapter([a-z0-9]+)$')}, {d_get(d_squeezed('text'), 'to(?:the)?([a-z0-9]+)$')})"


@query(f"""{BLK}, {NOTE_PAGES}, eb AS (SELECT blk.*, label = 'SectionHeader' AND {d_notes('text')} AS h FROM blk JOIN np ON blk.doc_id = np.doc_id AND blk.page_idx = np.page_idx WHERE headed OR looks),
ec AS (SELECT *, sum(CASE WHEN h THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY page_idx, block_idx) AS g FROM eb),
ed AS (SELECT *, max(CASE WHEN h THEN {D_SCOPE} END) OVER (PARTITION BY doc_id, g) AS scope, {d_marker('text', True)} AS marker FROM ec)
SELECT {K}, coalesce('ch' || scope, 'book') || ':' || marker AS scope_key FROM ed WHERE NOT h AND label NOT IN ('PageHeader', 'SectionHeader') AND marker IS NOT NULL""")
def endnote_keys(spark, sf_dir):
    return N.endnote_keys(blocks(spark, sf_dir)).select(*KEY, "scope_key")


BACK = f"{TYPED}, bl AS (SELECT doc_id, 'p' || (page_idx + 1) || ':' || {d_marker('raw_text', True)} AS scope_key, min(id) AS block_id FROM (SELECT ty.*, blk.text AS raw_text FROM ty JOIN blk ON ty.doc_id = blk.doc_id AND ty.page_idx = blk.page_idx AND ty.block_idx = blk.block_idx) WHERE label = 'Footnote' AND {d_marker('raw_text', True)} IS NOT NULL GROUP BY ALL)"


@query(f"{BACK} SELECT * FROM bl")
def footnote_backlinks(spark, sf_dir):
    return N.backlinks(S.typed(blocks(spark, sf_dir)), blocks(spark, sf_dir))


@query(f"{BACK} SELECT bl.doc_id AS doc_id, scope_key, ty.id AS id, ty.text AS text FROM bl JOIN ty ON bl.doc_id = ty.doc_id AND bl.block_id = ty.id")
def note_source(spark, sf_dir):
    t = S.typed(blocks(spark, sf_dir))
    return N.backlinks(t, blocks(spark, sf_dir)).withColumnRenamed("block_id", "id").join(t.select("doc_id", "id", "text"), ["doc_id", "id"])


# documents


@query()
def doc_json(spark, sf_dir):
    return D.to_json(D.build(blocks(spark, sf_dir)))


D_CONTENT = "type NOT IN ('page_header', 'page_footer', 'page_number', 'running_head', 'title_page', 'copyright', 'colophon', 'dedication', 'toc', 'footnote', 'endnote') AND coalesce(region, 'body') = 'body'"


@query(f"{TYPED} SELECT {K}, type FROM ty WHERE {D_CONTENT}")
def content_blocks(spark, sf_dir):
    return D.content_blocks(S.typed(blocks(spark, sf_dir))).select(*KEY, "type")


@query(f"{TYPED} SELECT doc_id, string_agg(text, chr(10) || chr(10) ORDER BY page_idx, seq) AS text FROM ty WHERE {D_CONTENT} GROUP BY doc_id")
def doc_text(spark, sf_dir):
    return D.doc_text(S.typed(blocks(spark, sf_dir)))


@query(f"{TYPED} SELECT type, count(*) AS n FROM ty GROUP BY type")
def type_counts(spark, sf_dir):
    return D.type_counts(S.typed(blocks(spark, sf_dir)))


@query(f"{TYPED} SELECT {K}, type, text FROM ty WHERE type IN ('verse', 'quote', 'epigraph')")
def verses_view(spark, sf_dir):
    return D.verses_of(S.typed(blocks(spark, sf_dir))).select(*KEY, "type", "text")
