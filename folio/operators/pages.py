"""Page names, labels and order: natural sort, padding, swaps, inserts, printed numbers, descrambling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def natural_key(name: Column) -> Column:
    """An array that sorts names by their digits as numbers and by their text in lower case."""
    return F.transform(F.regexp_extract_all(F.lower(name), F.lit(r"\d+|\D+"), F.lit(0)), lambda x: F.struct(F.when(x.rlike(r"^\d"), F.lit("")).otherwise(x).alias("t"), F.coalesce(x.try_cast("long"), F.lit(-1)).alias("n")))


def page_number(name: Column) -> Column:
    """The number at the end of a file name's stem, or null."""
    return F.regexp_extract(name, r"(\d+)\s*(\.[^.]*)?$", 1).try_cast("long")


def padded(name: Column, digits: Column) -> Column:
    """The name with its number filled to so many digits, never cut; unchanged without a number."""
    n = page_number(name).cast("string")
    full = F.when(F.length(n) < digits, F.lpad(n, digits, F.lit("0"))).otherwise(n)
    head, tail = F.regexp_extract(name, r"^(.*?)(\d+)\s*(\.[^.]*)?$", 1), F.regexp_extract(name, r"(\.[^.]*)?$", 1)
    return F.when(n.isNotNull(), F.concat(head, full, tail)).otherwise(name)


def pad(files: DataFrame) -> DataFrame:
    """files(book, name) with new_name, as wide as the book's largest number; clashes marks names that two files would get."""
    w = Window.partitionBy("book")
    width = F.coalesce(F.length(F.max(page_number(F.col("name"))).over(w).cast("string")), F.lit(1))
    out = files.withColumn("new_name", padded(F.col("name"), width))
    return out.withColumn("clashes", F.count(F.lit(1)).over(Window.partitionBy("book", "new_name")) > 1)


def uneven_widths(files: DataFrame) -> DataFrame:
    """Groups of (book, prefix, extension) whose numbers have different widths."""
    f = files.withColumns({"prefix": F.regexp_extract("name", r"^(.*?)\d+(\.[^.]*)?$", 1), "ext": F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1)), "digits": F.length(F.regexp_extract("name", r"(\d+)(\.[^.]*)?$", 1))})
    return f.groupBy("book", "prefix", "ext").agg(F.array_join(F.sort_array(F.collect_set("digits")), ",").alias("widths"), F.count_distinct("digits").alias("n")).filter("n > 1")


def swap_plan(files: DataFrame, start: int, end: int | None = None) -> DataFrame:
    """Pages of files(book, file_idx, name) with the name they take: pairs from start on change places, an odd one stays."""
    last = F.lit(end) if end is not None else F.max("file_idx").over(Window.partitionBy("book"))
    f = files.withColumn("last", last).withColumn("odd", (F.col("file_idx") - start) % 2)
    inside = (F.col("file_idx") >= start) & (F.col("file_idx") <= F.col("last"))
    partner = F.col("file_idx") + F.when(F.col("odd") == 0, 1).otherwise(-1)
    f = f.withColumn("partner", F.when(inside & (partner <= F.col("last")), partner))
    other = files.select("book", F.col("file_idx").alias("partner"), F.col("name").alias("partner_name"))
    return f.join(other, ["book", "partner"], "left").withColumn("new_name", F.coalesce("partner_name", "name")).select(*files.columns, "new_name")


def letters(n: Column) -> Column:
    """a to z, aa to zz, aaa and so on for 0, 1, 2, ...: numbers of base 26 that have no zero, up to 5 letters."""
    out, below = None, 0
    for size in range(1, 6):
        rest = n - below
        word = F.concat(*[F.chr((97 + F.pmod(F.floor(rest / 26**i), F.lit(26))).cast("int")) for i in reversed(range(size))])
        below += 26**size
        out = F.when(n < below, word) if out is None else out.when(n < below, word)
    return out


def letters_number(word: Column) -> Column:
    """The number that letters() writes so."""
    digits = F.transform(F.split(word, ""), lambda c: (F.ascii(c) - 96).cast("long"))
    return F.aggregate(digits, F.lit(0).cast("long"), lambda a, x: a * 26 + x) - 1


def dedupe_added(files: DataFrame) -> DataFrame:
    """Of files with one content in a book the most padded name, then the least."""
    digits = F.length(F.regexp_extract("name", r"(\d+)(\.[^.]*)?$", 1))
    w = Window.partitionBy("book", "sha").orderBy(digits.desc(), "name")
    return files.withColumn("rank", F.row_number().over(w)).filter("rank = 1").drop("rank")


def expand_pages(specs: DataFrame) -> DataFrame:
    """specs(book, spec), as 3,5,100-110, as a row per page."""
    one = specs.select("book", F.explode(F.split("spec", ",")).alias("part"))
    lo, hi = F.split_part("part", F.lit("-"), F.lit(1)).cast("int"), F.split_part("part", F.lit("-"), F.lit(-1)).cast("int")
    return one.select("book", F.explode(F.sequence(lo, hi)).alias("page"))


def _roman(n: int) -> str:
    out = ""
    for value, sign in zip((1000, 900, 500, 400, 100, 90, 50, 40, 10, 9, 5, 4, 1), "M CM D CD C XC L XL X IX V IV I".split(), strict=True):
        out, n = out + sign * (n // value), n % value
    return out


def roman_table(spark: SparkSession) -> DataFrame:
    """(val, roman) for 1 to 3999, made by rule; 4000 rows, so it may be sent to all."""
    return spark.createDataFrame([(i, _roman(i)) for i in range(1, 4000)], "val int, roman string")


def head_label(head: Column) -> Column:
    """The token of a running head that may be its page number: the one before the first slash, the one after it, or the first; numbers before letters."""
    both = F.split(head, "/", 2)
    token = lambda t: F.regexp_extract_all(F.coalesce(t, F.lit("")), F.lit(r"[A-Za-z]+|\d+"), F.lit(0))
    left, right = token(F.get(both, F.lit(0))), token(F.get(both, F.lit(1)))
    slash = F.size(both) == 2
    candidates = F.filter(F.array(F.when(slash, F.try_element_at(left, F.lit(-1))), F.when(slash, F.try_element_at(right, F.lit(1))), F.try_element_at(F.concat(left, right), F.lit(1))), lambda x: x.isNotNull())
    digits = F.try_element_at(F.filter(candidates, lambda x: x.rlike(r"^\d+$")), F.lit(1))
    return F.struct(digits.try_cast("int").alias("digits"), candidates.alias("candidates"))


def parse_heads(heads: DataFrame, romans: DataFrame) -> DataFrame:
    """heads(book, file_idx, head) with kind and val."""
    h = heads.withColumn("l_", head_label(F.col("head"))).withColumn("digits", F.col("l_.digits"))
    words = h.filter("digits IS NULL").select("book", "file_idx", F.posexplode("l_.candidates").alias("pos", "token")).withColumn("roman", F.upper("token"))
    found = words.join(F.broadcast(romans), "roman").groupBy("book", "file_idx").agg(F.min_by("val", "pos").alias("rval"))
    out = h.join(found, ["book", "file_idx"], "left")
    kind = F.when(F.col("digits").isNotNull(), "arabic").when(F.col("rval").isNotNull(), "roman")
    return out.select("book", "file_idx", kind.alias("kind"), F.coalesce("digits", "rval").alias("val"))


def descramble(files: DataFrame) -> DataFrame:
    """files(book, file_idx, kind, printed) in the order of their printed labels, with seq; the first of a label is kept, later ones are dropped; pages without one stay behind the kept page before them."""
    f = files.withColumn("rep", F.when(F.col("kind").isNotNull(), F.row_number().over(Window.partitionBy("book", "kind", "printed").orderBy("file_idx"))))
    f = f.withColumn("dropped", F.coalesce(F.col("rep") > 1, F.lit(False)))
    label = F.when(F.col("kind").isNotNull() & ~F.col("dropped"), F.struct((F.col("kind") == "arabic").alias("a"), F.col("printed").alias("p")))
    f = f.withColumn("own", label)
    anchor = F.last("own", ignorenulls=True).over(Window.partitionBy("book").orderBy("file_idx").rowsBetween(Window.unboundedPreceding, 0))
    f = f.withColumn("anchor", anchor).filter("NOT dropped")
    w = Window.partitionBy("book").orderBy(F.col("anchor").isNotNull(), "anchor", F.col("own").isNull(), "file_idx")
    return f.withColumn("seq", F.row_number().over(w))


def suspects(files: DataFrame, window: int = 5, far: int = 10) -> DataFrame:
    """Numbered pages farther than `far` from the nearest of their kind within `window` places; nothing near, no suspicion."""
    f = files.filter("kind IS NOT NULL")
    w = Window.partitionBy("book").orderBy("file_idx")
    near = F.concat(F.collect_list(F.struct("kind", "printed")).over(w.rowsBetween(-window, -1)), F.collect_list(F.struct("kind", "printed")).over(w.rowsBetween(1, window)))
    f = f.withColumn("near", near)
    f = f.withColumn("distance", F.array_min(F.transform(F.filter("near", lambda x: x["kind"] == F.col("kind")), lambda x: F.abs(x["printed"] - F.col("printed")))))
    return f.drop("near").withColumn("suspect", F.coalesce(F.col("distance") > far, F.lit(False)))


def infer_missing(files: DataFrame) -> DataFrame:
    """Numbers for runs without one: those that fit between neighbours of one kind, or that go on from the last."""
    w = Window.partitionBy("book").orderBy("file_idx")
    own = F.when(F.col("kind").isNotNull(), F.struct("kind", "printed", "file_idx"))
    f = files.withColumn("own", own)
    f = f.withColumns({"prev": F.last("own", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)), "next": F.first("own", ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))})
    steps = F.col("file_idx") - F.col("prev.file_idx")
    value = F.col("prev.printed") + steps
    fits = F.col("prev").isNotNull() & (F.col("next").isNull() | ((F.col("next.kind") == F.col("prev.kind")) & (value < F.col("next.printed"))))
    return f.withColumns({"inferred": F.when(F.col("kind").isNull() & fits, value), "inferred_kind": F.when(F.col("kind").isNull() & fits, F.col("prev.kind"))}).drop("own", "prev", "next")


def not_rising(files: DataFrame) -> DataFrame:
    """Labels that aren't larger than the last of their kind."""
    w = Window.partitionBy("book", "kind").orderBy("file_idx")
    return files.filter("kind IS NOT NULL").withColumn("before", F.lag("printed").over(w)).filter("printed <= before")


def page_no(name: Column, backend: Column, idx: Column) -> Column:
    """The last number of a name's stem, else the backend's if it isn't 0, else the index."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.coalesce(F.regexp_extract(stem, r"(\d+)\D*$", 1).try_cast("long"), F.nullif(backend, F.lit(0)), idx)


def drop_spec(spec: Column) -> Column:
    """even, odd or non-latin, with :LO-HI, as (mode, lo, hi)."""
    span = F.split_part(spec, F.lit(":"), F.lit(2))
    bound = lambda k: F.nullif(F.split_part(span, F.lit("-"), F.lit(k)), F.lit("")).try_cast("int")
    return F.struct(F.lower(F.split_part(spec, F.lit(":"), F.lit(1))).alias("mode"), bound(1).alias("lo"), bound(2).alias("hi"))


def add_pages(files: DataFrame, added: DataFrame) -> DataFrame:
    """added(book, after, ord, sha) with new_name: <name of the anchor><next free letter>; contents that the book has, or that come twice, are left out.

    Letters that a page of the book has behind the anchor's name already aren't given again. An anchor that isn't there
    stops the job.
    """
    own = files.select("book", "sha").distinct()
    once = added.withColumn("rep", F.row_number().over(Window.partitionBy("book", "sha").orderBy("after", "ord"))).filter("rep = 1").drop("rep")
    new = once.join(own, ["book", "sha"], "left_anti")
    at = files.select("book", F.col("file_idx").alias("after"), F.col("name").alias("anchor"))
    new = new.join(at, ["book", "after"], "left").withColumn("n", F.row_number().over(Window.partitionBy("book", "after").orderBy("ord")) - 1)
    stem, ext = F.regexp_replace("anchor", r"\.[^.]*$", ""), F.regexp_extract("anchor", r"(\.[^.]*)$", 1)
    # letters in use, by the name before them; the n-th free number lies behind as many used ones as are not beyond it
    used = files.select("book", F.regexp_replace("name", r"[a-z]+(\.[^.]*)?$", "").alias("stem_"), F.regexp_extract("name", r"\d([a-z]+)(\.[^.]*)?$", 1).alias("word")).filter("word <> ''")
    used = used.groupBy("book", "stem_").agg(F.sort_array(F.collect_set(letters_number(F.col("word")))).alias("used"))
    new = new.withColumn("stem_", stem).join(used, ["book", "stem_"], "left").drop("stem_")
    free = F.aggregate(F.coalesce("used", F.array().cast("array<bigint>")), F.col("n").cast("long"), lambda a, x: F.when(x <= a, a + 1).otherwise(a))
    new = new.withColumn("n", free).drop("used")
    missing = F.raise_error(F.concat(F.lit("no page "), F.col("after"), F.lit(" in book "), F.col("book")))
    return new.withColumn("new_name", F.when(F.col("anchor").isNotNull(), F.concat(stem, letters(F.col("n")), ext)).otherwise(missing)).drop("anchor", "n")


def resolve_start(files: DataFrame, starts: DataFrame) -> DataFrame:
    """starts(book, start) with the file_idx of that name, else of that stem, else of that page number."""
    j = files.join(starts, "book")
    stem = F.regexp_replace("name", r"\.[^.]*$", "")
    how = F.when(F.col("name") == F.col("start"), 0).when(stem == F.col("start"), 1).when(page_number(F.col("name")) == F.col("start").try_cast("long"), 2)
    return j.withColumn("how", how).filter("how IS NOT NULL").groupBy("book", "start").agg(F.min_by("file_idx", F.struct("how", "file_idx")).alias("file_idx"))


def better_side(strips: DataFrame, samples: int = 16) -> DataFrame:
    """strips(book, file_idx, side, val): per book the side whose numbers are read on more of evenly spaced sample pages; top if equal."""
    n = F.max("file_idx").over(Window.partitionBy("book"))
    k = F.least(F.lit(samples), F.col("n_"))
    # place i of k, from 0: i (n - 1) / (k - 1), halves to the even one
    places = F.transform(F.sequence(F.lit(0), (k - 1).cast("int")), lambda i: F.bround(i * (F.col("n_") - 1) / F.greatest(k - 1, F.lit(1))).cast("long"))
    s = strips.withColumn("n_", n).filter(F.array_contains(places, F.col("file_idx") - 1)).drop("n_")
    read = lambda side: F.count_if((F.col("side") == side) & F.col("val").isNotNull())
    return s.groupBy("book").agg(F.when(read("bottom") > read("top"), "bottom").otherwise("top").alias("side"))


def page_values(strips: DataFrame) -> DataFrame:
    """The number of each page: from the book's better side, else from the other."""
    best = better_side(strips).withColumnRenamed("side", "best")
    j = strips.join(best, "book")
    return j.groupBy("book", "file_idx").agg(F.coalesce(F.max(F.when(F.col("side") == F.col("best"), F.col("val"))), F.max(F.when(F.col("side") != F.col("best"), F.col("val")))).alias("val"))


def unscramble(files: DataFrame) -> DataFrame:
    """files in their right order: a new name by sequence, the old name, the number, whether it was inferred or is suspect."""
    order = descramble(files).select("book", "file_idx", "seq")
    inferred = infer_missing(files).select("book", "file_idx", "inferred")
    odd = suspects(files).select("book", "file_idx", "suspect")
    j = files.join(order, ["book", "file_idx"]).join(inferred, ["book", "file_idx"], "left").join(odd, ["book", "file_idx"], "left")
    return j.select("book", F.lpad(F.col("seq").cast("string"), F.greatest(F.lit(4), F.length(F.col("seq").cast("string"))), F.lit("0")).alias("file"), F.col("name").alias("source"), F.coalesce(F.when(F.col("kind").isNotNull(), F.col("printed")), F.col("inferred")).alias("page"), F.col("inferred").isNotNull().alias("was_inferred"), F.coalesce("suspect", F.lit(False)).alias("suspect"))


def rotation(spec: Column) -> Column:
    """DEGREES:CW or DEGREES:CCW, with @FIRST:LAST, as (degrees clockwise, first, last), null for none; anything else stops the job."""
    good = spec.rlike(r"(?i)^\d+(\.\d+)?(:c?cw)?(@\d*:(\d*|end))?$")
    turn, span = F.split_part(spec, F.lit("@"), F.lit(1)), F.split_part(spec, F.lit("@"), F.lit(2))
    degrees = F.split_part(turn, F.lit(":"), F.lit(1)).try_cast("double")
    bound = lambda k: F.split_part(span, F.lit(":"), F.lit(k)).try_cast("int")
    clockwise = F.when(F.upper(F.split_part(turn, F.lit(":"), F.lit(2))) == "CCW", -degrees).otherwise(degrees)
    bad = F.raise_error(F.concat(F.lit("bad rotation "), spec))
    return F.when(~good | (degrees > 180), bad).when(degrees > 0, F.struct(clockwise.alias("degrees"), bound(1).alias("first"), bound(2).alias("last")))


def resolve_anchor(files: DataFrame, anchors: DataFrame, strict: bool = True) -> DataFrame:
    """anchors(book, anchor) with prefix, width and number of the book's first page of that number, after which pages are added.

    An anchor that is a path, has no number, or names no page stops the job, in the last case with the pages at most three
    numbers away; with strict=False they get the message in column error.
    """
    number = page_number(F.col("anchor"))
    path = F.col("anchor").rlike(r"[/\\]")
    pages = files.select("book", "name", page_number(F.col("name")).alias("number")).filter("number IS NOT NULL")
    a = anchors.withColumn("wanted", F.when(~path, number))
    near = a.join(pages, (a["book"] == pages["book"]) & (F.abs(pages["number"] - a["wanted"]) <= 3)).groupBy(a["book"], "anchor")
    near = near.agg(F.sort_array(F.collect_set("number")).alias("near"), F.min_by("name", F.when(F.col("number") == F.col("wanted"), F.struct(F.length("name"), F.col("name")))).alias("found"))
    out = a.join(near, ["book", "anchor"], "left")
    message = F.when(path, "a path").when(F.col("wanted").isNull(), "no page number").when(F.col("found").isNull(), F.concat(F.lit("no such page, near it: "), F.coalesce(F.array_join("near", ","), F.lit(""))))
    if strict:
        message = F.when(message.isNotNull(), F.raise_error(F.concat(F.lit("anchor "), F.col("anchor"), F.lit(": "), message)).cast("string"))
    digits = F.regexp_extract("found", r"(\d+)\s*(\.[^.]*)?$", 1)
    return out.select("book", "anchor", F.regexp_extract("found", r"^(.*?)(\d+)\s*(\.[^.]*)?$", 1).alias("prefix"), F.nullif(F.length(digits), F.lit(0)).alias("width"), F.when(F.col("found").isNotNull(), F.col("wanted")).alias("number"), message.alias("error"))
