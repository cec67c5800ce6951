"""Corpus manifests: de-duplication, identity, health, upserts; and the state of books being worked on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def native_wins(native: DataFrame, scanned: DataFrame) -> DataFrame:
    """All native rows, and the scanned ones of other editions."""
    return native.withColumn("kind", F.lit("native")).unionByName(scanned.join(native, "edition", "left_anti").withColumn("kind", F.lit("scanned")))


def catalogue(holdings: DataFrame) -> DataFrame:
    """Per edition its public id, the first that isn't null, and how many hashed files it holds."""
    return holdings.groupBy(F.col("edition_id").alias("edition")).agg(F.min_by("pub_id", F.when(F.col("pub_id").isNotNull(), F.col("supp"))).alias("pub_id"), F.count("content_hash").alias("n_hashes"), F.min("content_hash").alias("sole"))


def verify_catalogue(holdings: DataFrame, version: int | None = None) -> DataFrame:
    """holdings, if it has the columns that stamping needs and its version, where one is stated, is 1 or later; else ValueError."""
    missing = {"edition_id", "pub_id", "file_path", "content_hash"} - set(holdings.columns)
    if missing:
        raise ValueError(f"the catalogue lacks {', '.join(sorted(missing))}")
    if version is not None and version < 1:
        raise ValueError(f"catalogue version {version}")
    return holdings


def stamp(rows: DataFrame, holdings: DataFrame) -> DataFrame:
    """rows(edition, source, pub_hint) with pub_id and content_hash.

    By edition: the hash of the row's source, else that of its only file. Rows whose edition isn't held go by their source
    alone; what is left takes its own hint.
    """
    by_edition = catalogue(holdings)
    by_path = holdings.groupBy(F.col("file_path").alias("source")).agg(F.max("content_hash").alias("path_hash"), F.max("pub_id").alias("path_pub"), F.max("edition_id").alias("path_edition"))
    out = rows.join(by_edition, "edition", "left").join(by_path, "source", "left")
    own = F.col("path_edition") == F.col("edition")
    found = F.col("pub_id").isNotNull()
    hash_ = F.when(found, F.coalesce(F.when(own, F.col("path_hash")), F.when(F.col("n_hashes") == 1, F.col("sole")))).otherwise(F.col("path_hash"))
    return out.select(*rows.columns, F.coalesce("pub_id", "path_pub", "pub_hint").alias("stamped"), hash_.alias("content_hash"))


def corpus_key(pub_id, edition, folder):
    return F.coalesce(F.nullif(pub_id, F.lit("")), F.concat(F.lit("e"), edition), folder)


def health(rows: DataFrame) -> DataFrame:
    """rows with reasons, joined by commas, and ok."""
    why = F.array(
        F.when(F.col("cache_pages") == 0, "empty cache"),
        F.when((F.col("cache_pages") > 0) & F.col("n_blocks").isNull(), "cache without doc"),
        F.when(F.col("schema_version").isNull(), "no schema_version"),
        F.when(F.col("n_blocks") == 0, "no blocks"),
    )
    out = rows.withColumn("reasons", F.array_join(F.filter(why, lambda x: x.isNotNull()), ","))
    return out.withColumn("ok", F.col("reasons") == "")


def upsert(old: DataFrame, new: DataFrame, key: list[str]) -> DataFrame:
    """old with the rows of new in place of those of the same key."""
    return old.join(new, key, "left_anti").unionByName(new)


def edition_order() -> list[Column]:
    """What manifests are sorted by: numeric editions by number, then the others by text."""
    edition = F.col("edition").cast("string")
    return [F.when(edition.rlike(r"^\d+$"), 0).otherwise(1), edition.try_cast("long"), edition]


def manifest_order(rows: DataFrame) -> DataFrame:
    """rows with pos, their place in that order: the sorted ranges number their own rows, and start behind what the ranges before them hold."""
    ranged = rows.orderBy(*edition_order()).withColumn("part_", F.spark_partition_id()).withColumn("id_", F.monotonically_increasing_id())
    sizes = ranged.groupBy("part_").agg(F.count(F.lit(1)).alias("n_"))
    # a row for each range
    before = sizes.withColumn("before_", F.coalesce(F.sum("n_").over(Window.orderBy("part_").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n_")
    own = F.col("id_") - F.shiftleft(F.col("part_").cast("long"), 33)
    return ranged.join(F.broadcast(before), "part_").withColumn("pos", own + F.col("before_") + 1).drop("part_", "id_", "before_")


def layout_lookup(books: DataFrame, rules: DataFrame) -> DataFrame:
    """books(edition, stem) with the options of all rules(ord, key, opt, val) that match, later ones over earlier ones.

    Rules for an edition join by equality; rules for a part of the name are tried on every book, and sent to all while
    they are few.
    """
    by_id = rules.filter(F.col("key").startswith("edition:")).withColumn("edition", F.substring_index("key", ":", -1).cast("long")).drop("key")
    by_name = rules.filter(~F.col("key").startswith("edition:"))
    hit = books.join(by_id, "edition").select("edition", "ord", "opt", "val")
    part = books.join(F.broadcast(by_name) if by_name.count() <= 10_000 else by_name, F.instr(F.lower(F.col("stem")), F.lower(F.col("key"))) > 0).select("edition", "ord", "opt", "val")
    return hit.unionByName(part).groupBy("edition", "opt").agg(F.max_by("val", "ord").alias("val"))


def pending(images: DataFrame, cached: DataFrame) -> DataFrame:
    """images(book, name, mtime) that aren't in cached(book, name, cache_mtime) or are newer."""
    out = images.join(cached, ["book", "name"], "left")
    return out.filter(F.col("cache_mtime").isNull() | (F.col("mtime") > F.col("cache_mtime"))).select(*images.columns)


def stripe(items: DataFrame, n: int, order: str, group: str) -> DataFrame:
    """items of a group dealt round robin to n shards."""
    return items.withColumn("shard", F.pmod(F.row_number().over(Window.partitionBy(group).orderBy(order)) - 1, F.lit(n)))


def stealable(claims: DataFrame, host: str, ttl: int) -> DataFrame:
    """claims with stealable: corrupt ones, those of a dead process of this host, and of other hosts the expired."""
    rule = F.when(F.col("corrupt"), True).when(F.col("host") == host, ~F.col("alive")).otherwise(F.col("age_s") > ttl)
    return claims.withColumn("stealable", rule)


def book_state(books: DataFrame) -> DataFrame:
    """done, active, broken, not-started or resume, in that order of precedence."""
    state = F.when(F.col("done"), "done").when(F.col("active"), "active").when(~F.col("ok"), "broken").when(F.col("cached") == 0, "not-started").otherwise("resume")
    return books.withColumn("state", state)


def capped(tokens: DataFrame, cap: int, slack: int = 50) -> DataFrame:
    """Per log the tasks whose largest count is within slack of the cap, all their counts from the largest on, and how many tasks there are."""
    t = tokens.groupBy("log", "task").agg(F.max("tokens").alias("tokens"))
    hit = F.col("tokens") >= cap - slack
    return t.groupBy("log").agg(F.count(F.lit(1)).alias("tasks"), F.count_if(hit).alias("hits"), F.array_join(F.transform(F.sort_array(F.collect_list(F.when(hit, F.col("tokens"))), asc=False), lambda x: x.cast("string")), ",").alias("top"))


def progress(books: DataFrame) -> DataFrame:
    """Pages done and in all: a finished book counts whole, others what is cached."""
    done = F.when(F.col("done"), F.col("total")).otherwise(F.least("cached", "total"))
    return books.agg(F.sum(done).alias("pages_done"), F.sum("total").alias("pages"), F.count_if("done").alias("books_done"))


def running_totals(times: DataFrame) -> DataFrame:
    w = Window.partitionBy("batch").orderBy("finish", "book").rowsBetween(Window.unboundedPreceding, 0)
    return times.withColumns({"pages_so_far": F.sum("pages").over(w), "seconds_so_far": F.sum("seconds").over(w)})


def nfc_share(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with nfc: whether the text is in Unicode NFC."""
    from ..functions.text import nfc

    return docs.withColumn("nfc", nfc(F.col(text)).eqNullSafe(F.col(text)))


def active_claims(claims: DataFrame, host: str, ttl: int) -> DataFrame:
    """Claims that can't be stolen, the oldest first, with their age."""
    return stealable(claims, host, ttl).filter("NOT stealable").select("name", "host", "pid", "age_s")


def acquire(claims: DataFrame, wanted: DataFrame, host: str, ttl: int) -> DataFrame:
    """claims after wanted(name, pid, asked_at): a free or stealable name goes to who asked first; others stay with their holder."""
    held = stealable(claims, host, ttl).filter("NOT stealable").select("name", "pid")
    first = wanted.groupBy("name").agg(F.min_by("pid", F.struct("asked_at", "pid")).alias("pid"))
    return held.withColumn("won", F.lit(False)).unionByName(first.join(held, "name", "left_anti").withColumn("won", F.lit(True)))


def update_claims(claims: DataFrame, changes: DataFrame) -> DataFrame:
    """claims(name, host, pid, note) with the notes of changes(name, host, pid, note), each only while who changes it still holds the name."""
    new = changes.groupBy("name", "host", "pid").agg(F.max("note").alias("note_"), F.lit(True).alias("hit_"))
    out = claims.join(new, ["name", "host", "pid"], "left")
    return out.withColumn("note", F.when(F.col("hit_"), F.col("note_")).otherwise(F.col("note"))).select(*claims.columns)


def release(claims: DataFrame, done: DataFrame) -> DataFrame:
    """claims without those of done(name, host, pid): a name that another has taken since stays with that one."""
    return claims.join(done.select("name", "host", "pid").distinct(), ["name", "host", "pid"], "left_anti")


def time_left(state: DataFrame) -> DataFrame:
    """state(pages_done, pages_before, pages, seconds) with s_page and seconds_left: by the pages that were done since the run began; null until one was."""
    fresh = F.col("pages_done") - F.col("pages_before")
    rate = F.when(fresh > 0, F.col("seconds") / fresh)
    return state.withColumns({"s_page": rate, "seconds_left": rate * F.greatest(F.col("pages") - F.col("pages_done"), F.lit(0))})
