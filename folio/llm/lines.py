"""Line deduplication (7): a segment-partition edit join of lines; DataFrame functions only.

Lines are cut into as many equal segments as edits, and one more, of which the edits leave one whole. They are looked up
under those; longer lines probe for them at the places where they can stand (multi-match-aware), by length.

With a share, edits grow with the line, and so would the places. From LONG characters on it is done otherwise then:
- Lines are cut where words end, so that a shift moves no cut: an edit spoils two segments at most. Both sides are looked
  up under their 2 * edits + SHARED longest segments; near lines have SHARED of those in common.
- Lines with too few such segments are indexed under edits + 1 disjoint pieces of GRAM characters; lines that have
  few enough to be near them probe with every GRAM characters.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SENT, dealt_join, free, table
from .exact import BITS_A_ROW, MOST_BITS, PAGE, bit, bitmaps

#: Lines of fewer characters have to be equal. From there on one edit is allowed, from TWO characters of the shorter line on two; with a share, from LONG characters on one in so many characters.
SHORT, TWO, LONG = 20, 40, 150
#: Where long lines are cut: behind white space, unless one of the most frequent last letters stands before it.
CUT, SHARED, GRAM = r"(?<=[^ens\\s]\\s)", 2, 24
#: Characters of the parts that very long lines are taken apart in, as a place far in a text is slow to find.
PART = 256
#: Bits of a line's sketch that one edit can change: it takes away two pairs of characters and brings two.
BITS_AN_EDIT = 4
#: Characters of the blocks that equal begins and ends of two lines are left out by before their distance is measured.
EQUAL = 32
#: Lines that are under one key and meet in one task; a key with more is dealt over several.
MEET = 8192
_NONE = -(1 << 63)


def allowed(length: str, share: int | None) -> str:
    """SQL for how many edits the shorter of two lines allows, by its length."""
    long = f"WHEN {length} >= {LONG} THEN greatest(2, {length} div {share}) " if share else ""
    return f"cast(CASE {long}WHEN {length} >= {TWO} THEN 2 WHEN {length} >= {SHORT} THEN 1 ELSE 0 END AS int)"


def segment(length: str, edits: int, i: int) -> tuple[str, str]:
    """SQL for the first place (from 1) and length of segment i (from 1) of edits + 1; the last ones are longer by one where it doesn't come out even."""
    k = edits + 1
    extra = f"greatest(0, {i - 1} - ({k} - {length} % {k}))"
    return f"({i - 1} * ({length} div {k}) + {extra} + 1)", f"({length} div {k} + CASE WHEN {i} > {k} - {length} % {k} THEN 1 ELSE 0 END)"


def segment_keys(line: str, n: str) -> str:
    """SQL for an array of a line's keys: of every segment its length, number and text."""

    def of(edits: int) -> str:
        out = []
        for i in range(1, edits + 2):
            at, size = segment(n, edits, i)
            out.append(f"xxhash64({n}, {i}, substring({line}, {at}, {size}))")
        return f"array({', '.join(out)})"

    return f"CASE WHEN {n} >= {TWO} THEN {of(2)} ELSE {of(1)} END"


def gram_key(line: str, at: str) -> str:
    return f"xxhash64(0, substring({line}, cast({at} AS int), {GRAM}))"


def probes() -> list[tuple[int, int, int, int]]:
    """(edits, less, i, shift): where lines probe for segment i of lines that are shorter by `less` and allow so many edits.

    Only the places are probed at which a segment can stand when the edits before it and behind it are as few as the
    others leave (multi-match-aware selection); a line's own segments are left out.
    """
    out = []
    for edits in (1, 2):
        for less in range(edits + 1):
            for i in range(1, edits + 2):
                low, high = max(-(i - 1), less - (edits + 1 - i)), min(i - 1, less + edits + 1 - i)
                out += [(edits, less, i, shift) for shift in range(low, high + 1) if less or shift]
    return out


def length_class(n: str, share: int) -> str:
    """SQL for the class of a long line's length: classes are wider than the edits, so near lengths are in one class or in neighbouring ones."""
    return f"cast(floor(ln({n}) * {share * 4 // 5}) AS int)"


def _probed(short: DataFrame, share: int | None) -> DataFrame:
    """(h, n, seg): the keys under which lines no longer than each line and within its edits can be indexed by segments.

    One small expression a row, rather than a long one a line: the compiler leaves very long ones alone.
    """
    at = F.array(*[F.struct(F.lit(e).alias("e"), F.lit(d).alias("less"), F.lit(i).alias("i"), F.lit(x).alias("x")) for e, d, i, x in probes()])
    rows = short.select("line", "h", "n", F.explode(at).alias("p")).selectExpr("line", "h", "n", "n - p.less AS m", "p.e AS e", "p.i AS i", "p.x AS x")
    rows = rows.filter(f"m >= {SHORT} AND e = {allowed('m', None)}" + (f" AND m < {LONG}" if share else ""))
    rows = rows.selectExpr("line", "h", "n", "m", "i", "x", "e + 1 - m % (e + 1) AS even", "m div (e + 1) AS size")
    return rows.selectExpr("h", "n", "xxhash64(m, i, substring(line, cast((i - 1) * size + greatest(0, i - 1 - even) + 1 + x AS int), cast(size + CASE WHEN i > even THEN 1 ELSE 0 END AS int))) AS seg")


def _cut(long: DataFrame, share: int) -> DataFrame:
    """h, n, k, many, segs, line: of each long line the distinct segments as numbers, the longest first; how many; those that it is looked up under.

    A segment's number has its length (at most 127) in the seven bits before 56 of its hash, so that sorting puts the
    longest, which are the rarest, first in every line alike.
    """
    code = f"transform(split(line, '{CUT}'), c -> shiftleft(cast(127 - least(127, length(c)) AS bigint), 56) | (xxhash64(c) & {(1 << 56) - 1}))"
    rows = long.selectExpr("h", "n", f"{allowed('n', share)} AS k", f"sort_array(array_distinct({code})) AS all_", "line")
    return rows.selectExpr("h", "n", "k", "size(all_) AS many", f"slice(all_, 1, 2 * k + {SHARED}) AS segs", "line")


def _in(rows: DataFrame, keys: DataFrame, column: str, name: str) -> DataFrame:
    """The rows whose number in column is in keys, and a few others: by a Bloom filter of bounded size; when keys outgrow it, more others."""
    bits = min(MOST_BITS, max(PAGE, 1 << math.ceil(math.log2(max(1, keys.count()) * BITS_A_ROW))))
    place = F.pmod(column, F.lit(bits))
    found = rows.join(F.broadcast(table(bitmaps(keys, F.pmod(keys.columns[0], F.lit(bits))), name)), (place / PAGE).cast("long") == F.col("page"))
    return found.filter(bit(F.col("words"), place % PAGE)).drop("page", "words")


def near_lines(docs: DataFrame, share: int | None = None, sent: int = SENT) -> tuple[DataFrame, DataFrame]:
    """(places, links) of docs(key, th, text): key, th, no and hash h of every line that isn't blank; verified pairs (a, b) of hashes.

    Probes pass a Bloom filter of the index before they are shuffled. Keys that only one line has are dropped by a
    pre-aggregated minimum and maximum, and the rest is filtered by another. A key with many lines is dealt over several
    tasks: its probing side by a hash, its indexed side copied. Lines meet only where their lengths and sketches are near. Pairs with enough keys in common are verified by banded edit distance.
    """
    lines = docs.select("key", "th", F.posexplode(F.split("text", "\n")).alias("no", "line")).filter(F.col("line").rlike(r"\S"))
    lines = lines.withColumn("h", F.xxhash64("line"))
    places = table(lines.select("key", "th", "no", "h"), "places")
    lines = lines.select("h", "line", F.length("line").alias("n")).filter(f"n >= {SHORT}")
    short = lines.filter(f"n < {LONG + 2}") if share else lines
    index = short.filter(f"n < {LONG}") if share else short
    index = index.select("h", "n", F.explode(F.expr(segment_keys("line", "n"))).alias("seg"))
    probing, held = _probed(short, share), []
    if share:
        cut = _cut(lines.filter(f"n >= {LONG}"), share)
        held.append(long := table(cut.select("h", "n", "segs").distinct(), "cut"))
        # long lines with few segments are indexed under pieces of text; and what may be longer than one of those probes for them
        few = cut.filter(f"many < 4 * k + {SHARED}").selectExpr("h", "n", "k", "line", f"many < 2 * k + {SHARED} AS own")
        pieces = few.filter("own").select("h", "n", F.explode(F.expr(f"transform(sequence(0, k), i -> {gram_key('line', f'i * {GRAM} + 1')})")).alias("seg"))
        index = index.unionByName(pieces)
        parts = few.select("line", "h", "n", F.explode(F.expr(f"sequence(0, (n - {GRAM}) div {PART})")).alias("part")).selectExpr("h", "n", f"substring(line, part * {PART} + 1, {PART + GRAM - 1}) AS line")
        probing = probing.unionByName(parts.select("line", "h", "n", F.explode(F.expr(f"sequence(1, length(line) - {GRAM - 1})")).alias("at")).selectExpr("h", "n", f"{gram_key('line', 'at')} AS seg"))
    held.append(index := table(index.distinct(), "index"))
    held.append(probing := table(_in(probing, index.select("seg"), "seg", "bloom").distinct(), "probes"))
    # own: lines are indexed under it; worth: in how many keys of long lines it counts
    keys = index.selectExpr("h", "n", "seg", "1 AS own", f"{SHARED} AS worth").unionByName(probing.selectExpr("h", "n", "seg", "0 AS own", f"{SHARED} AS worth"))
    if share:
        keys = keys.unionByName(long.select("h", "n", F.explode("segs").alias("seg"), F.lit(1).alias("own"), F.lit(1).alias("worth")))
    ends = [F.min("h").alias("lo"), F.max("h").alias("hi"), F.max("own").alias("any"), F.count(F.lit(1)).alias("lines")]
    held.append(common := table(keys.groupBy("seg").agg(*ends).filter("lo <> hi AND any = 1").select("seg", "lines"), "common"))
    keys = _in(keys, common, "seg", "common")
    # keys with more than a hundred-thousandth of all that are common, and so a bounded number
    least = max(MEET, (common.agg(F.sum("lines")).first()[0] or 0) // 100_000)
    hot = table(common.filter(F.col("lines") > least).selectExpr("seg", f"cast(ceil(lines / {MEET}) AS int) AS parts"), "hot")
    keys = keys.join(F.broadcast(hot), "seg", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    keys = table(keys, "common-keys")
    free(*held)
    wanted = table(keys.groupBy("h").agg(F.count(F.lit(1)).alias("keys")), "wanted")
    sketches = _sketched(_in(lines.select("h", "line"), wanted, "h", "wanted").dropDuplicates(["h"]))
    sketches = table(sketches.join(F.broadcast(wanted) if wanted.count() <= sent else wanted, "h"), "sketches")
    met = table(dealt_join(keys, sketches, ["h"], "keys", sent=sent), "keys")
    pairs = table(_meet(met, share), "candidates")
    free(keys, met, wanted, sketches)
    wanted = table(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "wanted")
    texts = _in(lines.select("h", "line"), wanted, "h", "wanted").groupBy("h").agg(F.first("line").alias("line"))
    blocks = lambda x: f"split({x}, '(?s)(?<=\\\\G.{{{EQUAL}}})')"
    texts = table(texts.selectExpr("h", "line", f"{blocks('line')} AS front", f"{blocks('reverse(line)')} AS back"), "texts")
    both = pairs.join(texts.alias("x"), F.col("a") == F.col("x.h")).join(texts.alias("y"), F.col("b") == F.col("y.h"))
    # equal blocks at the begin and behind the rest at the end change no distance
    rest = lambda line: f"substring({line}, {EQUAL} * same + 1, length({line}) - {EQUAL} * (same + same_back))"
    equal = lambda c: f"array_position(zip_with(x.{c}, y.{c}, (i, j) -> coalesce(i = j, false)), false) - 1"
    both = both.selectExpr("a", "b", "x.line AS line_a", "y.line AS line_b", f"{equal('front')} AS same", f"{equal('back')} AS back")
    both = both.withColumn("most", F.expr(allowed("least(length(line_a), length(line_b))", share)))
    both = both.withColumn("same_back", F.expr(f"greatest(0, least(back, (least(length(line_a), length(line_b)) - {EQUAL} * same) div {EQUAL}))"))
    far = f"levenshtein({rest('line_a')}, {rest('line_b')}, most)"
    return places, table(both.filter(f"{far} >= 0").select("a", "b"), "links")


def _sketched(lines: DataFrame) -> DataFrame:
    """h and c of lines: pairs of neighbouring characters, each hashed to one of 64 bits, by parity."""
    pairs_of = "zip_with(slice(c_, 1, size(c_) - 1), slice(c_, 2, size(c_)), (a, b) -> cast(pmod(xxhash64(a, b), 64) AS int))"
    return lines.withColumn("c_", F.split("line", "")).select("h", F.expr(f"aggregate({pairs_of}, 0L, (s, p) -> s ^ shiftleft(1L, p))").alias("c"))


def _meet(keys: DataFrame, share: int | None) -> DataFrame:
    """Pairs (a, b) of lines that have keys(h, n, c, seg, own, worth, parts) worth SHARED in common, the shorter one as its index, and whose lengths are within its edits."""
    near = lambda x, y: F.expr(f"{y}.n >= {x}.n AND {y}.n - {x}.n <= {allowed(f'{x}.n', share)} AND {x}.h <> {y}.h AND 2 * {x}.own + {y}.own >= 2 AND ({y}.n > {x}.n OR {y}.own = 0 OR {x}.h < {y}.h) AND bit_count({x}.c ^ {y}.c) <= {BITS_AN_EDIT} * {allowed(f'{x}.n', share)}")
    out = [F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b"), "x.worth"]
    # both sides alike, so that they are shuffled once
    few = keys.filter("parts = 1")
    pairs = few.alias("x").join(few.alias("y"), (F.col("x.seg") == F.col("y.seg")) & near("x", "y")).select(*out)
    # keys of many lines are dealt over parts; with a share also by the class of the length, where the key isn't of one length
    hot = keys.filter("parts > 1")
    one = several = "0"
    if share:
        wide, least = f"n >= {LONG + 2} OR worth = 1", f"greatest({LONG}, n - {allowed('n', share)})"
        one = f"CASE WHEN {wide} THEN {length_class('n', share)} ELSE 0 END"
        several = f"CASE WHEN {wide} THEN array_union(array(0), sequence({length_class(least, share)}, {length_class('n', share)})) ELSE array(0) END"
    own = hot.filter("own = 1").withColumn("cls", F.expr(one)).withColumn("part", F.explode(F.expr("sequence(0, parts - 1)")))
    other = hot.withColumn("part", F.pmod("h", "parts")).withColumn("cls", F.explode(F.expr(several)) if share else F.expr(several))
    met = own.alias("x").join(other.alias("y"), (F.col("x.seg") == F.col("y.seg")) & (F.col("x.cls") == F.col("y.cls")) & (F.col("x.part") == F.col("y.part")) & near("x", "y"))
    pairs = pairs.unionByName(met.select(*out))
    return pairs.groupBy("a", "b").agg(F.sum("worth").alias("worth")).filter(f"worth >= {SHARED}").select("a", "b")


def line_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None, share: int | None = None, sent: int = SENT) -> DataFrame:
    """The columns carry of docs (all if not given) with kept_text, n_lines, n_dropped and n_links.

    Lines are near when few edits turn one into the other: by the length of the shorter line one from SHORT characters on,
    two from TWO on and, with a share, one in so many characters (25 or more) from LONG on; shorter lines have to be equal.
    With a share the lines of near copies of a long text are near each other, and their links grow with the square of the
    copies. A line is dropped when a line
    near it, or the same line, stands earlier: in a document of smaller doc_id, or before it in the same. Blank lines are
    never dropped. n_links counts, over the lines of the text, the different lines near them. Of one distance each line is
    one row, however often it stands; hot lines are pre-aggregated. A null text stays null and has no lines; a null doc_id
    is the smallest; documents repeated with id and text are the same one and lose the same lines; different texts under
    one id are ordered by a hash. An empty table gives no rows. Columns of docs with the names of the new ones are
    replaced.
    """
    new = ["kept_text", "n_lines", "n_dropped", "n_links"]
    held = [c for c in (docs.columns if carry is None else carry) if c not in new]
    body = F.coalesce(F.col(text), F.lit(""))
    ident = [F.coalesce(F.col(doc_id).cast("long"), F.lit(_NONE)).alias("key"), F.xxhash64(body).alias("th")]
    narrow = docs.select(*ident, body.alias("text"))
    places, links = near_lines(narrow, share, sent)
    firsts = table(places.groupBy("h").agg(F.min(F.struct("key", "th", "no")).alias("first"), F.count(F.lit(1)).alias("copies")), "firsts")
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    before = ends.join(firsts.select(F.col("h").alias("b"), F.col("first").alias("other")), "b").groupBy("a").agg(F.min("other").alias("other"), F.count(F.lit(1)).alias("links"))
    known = firsts.join(before, firsts["h"] == before["a"], "left").filter("copies > 1 OR links > 0")
    known = table(known.select("h", "first", (F.coalesce(F.col("other") < F.col("first"), F.lit(False))).alias("late"), F.coalesce("links", F.lit(0)).alias("links"), "copies"), "known")
    places = dealt_join(places, known, ["h"], "copies", sent=sent)
    gone = F.col("late") | (F.struct("key", "th", "no") != F.col("first"))
    per = places.groupBy("key", "th", "no").agg(F.max("links").alias("links"), F.bool_or(gone).alias("gone"))
    per = table(per.groupBy("key", "th").agg(F.collect_list(F.when(F.col("gone"), F.col("no"))).alias("gone"), F.sum("links").alias("links")), "dropped")
    size = per.agg(F.count(F.lit(1)), F.sum(F.size("gone"))).first()
    side = F.broadcast(per) if size[0] <= SENT and (size[1] or 0) <= 4 * SENT else per
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in held]).alias("doc"), *ident, F.col(text).alias("text")).join(side, ["key", "th"], "left")
    rows = rows.withColumn("gone", F.coalesce("gone", F.array().cast("array<int>")))
    # the kept line numbers are a set difference; the lines behind them are looked up
    rows = rows.withColumn("lines_", F.split("text", "\n"))
    kept = F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size("lines_") - 1), "gone"), lambda i: F.get("lines_", i)), "\n")
    kept = F.when(F.size("gone") == 0, F.col("text")).otherwise(kept)
    return rows.select("doc.*", kept.alias("kept_text"), F.coalesce(F.size("lines_"), F.lit(0)).cast("long").alias("n_lines"), F.size("gone").cast("long").alias("n_dropped"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def op7_line_dedup(spark, sf_dir: str) -> DataFrame:
    done = line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"), carry=["doc_id"])
    return done.select("doc_id", "n_lines", "n_dropped", "n_links", F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("kept_sha256"))


#: Letters by whose counts the SQL leaves most pairs out before it measures them.
LETTERS = "eantirso"
_FREE = "".join(f"|| chr({i}) " for i in [*range(2, 9), *range(14, 32), 127])
#: DuckDB measures bytes: up to 27 different characters beyond ASCII are put as unused control characters first.
SQL = f"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
o AS (SELECT doc_id, unnest(range(len(l))) AS no, unnest(l) AS line FROM d),
f AS (SELECT coalesce(string_agg(c, '' ORDER BY c), '') AS wide FROM (SELECT DISTINCT unnest(string_split(regexp_replace(text, '[\\x00-\\x7F]+', '', 'g'), '')) AS c FROM documents) x),
t AS (SELECT line, translate(line, f.wide, chr(1) {_FREE}) AS b, length(line) AS n, min(doc_id * 100000 + no) AS first,
    CASE WHEN length(line) >= {TWO} THEN 2 WHEN length(line) >= {SHORT} THEN 1 ELSE 0 END AS k
    FROM o, f WHERE regexp_matches(line, '[^\\s\\x0B]') GROUP BY line, f.wide),
u AS (SELECT *, {", ".join(f"n - length(replace(line, '{x}', '')) AS n_{i}" for i, x in enumerate(LETTERS))} FROM t),
c AS (SELECT x.line AS x, y.line AS y, x.first AS fx, y.first AS fy FROM u x JOIN u y ON x.line <> y.line AND y.n BETWEEN x.n AND x.n + x.k AND (x.n < y.n OR x.line < y.line)
    WHERE x.k > 0 AND CASE WHEN {" + ".join(f"abs(x.n_{i} - y.n_{i})" for i in range(len(LETTERS)))} <= 2 * x.k THEN levenshtein(x.b, y.b) <= x.k ELSE false END),
e AS (SELECT x AS line, fy AS other FROM c UNION ALL SELECT y, fx FROM c),
k AS (SELECT line, count(*) AS links, min(other) AS other FROM e GROUP BY line),
p AS (SELECT o.doc_id AS doc_id, o.no AS no, o.line AS line, coalesce(o.doc_id * 100000 + o.no <> t.first OR k.other < t.first, false) AS gone, coalesce(k.links, 0) AS links
    FROM o LEFT JOIN t ON o.line = t.line LEFT JOIN k ON o.line = k.line)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, cast(sum(links) AS bigint) AS n_links, sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (NOT gone), '')) AS kept_sha256
FROM p GROUP BY doc_id
"""
