"""Writers: page texts, documents, manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def book_text(pages: DataFrame) -> DataFrame:
    """pages(doc_id, page_idx, page_name, page_text) as one text a document: a form feed and a numbered header before each page."""
    head = F.concat(F.lit("\f===== PAGE "), F.lpad((F.col("page_idx") + 1).cast("string"), F.greatest(F.lit(4), F.length((F.col("page_idx") + 1).cast("string"))), F.lit("0")), F.lit(" :: "), "page_name", F.lit(" =====\n"))
    s = F.sort_array(F.collect_list(F.struct("page_idx", F.concat(head, "page_text").alias("t"))))
    return pages.groupBy("doc_id").agg(F.array_join(F.transform(s, lambda x: x["t"]), "\n").alias("book_text"), F.count(F.lit(1)).alias("n_pages"))


def write_text(pages: DataFrame, folder: str) -> None:
    """Page rows as JSON lines, and the books' texts with their ids, below folder; in folders by a hash of the id, so that their number doesn't grow with the corpus."""
    pages.withColumn("bucket", bucket()).write.mode("overwrite").partitionBy("bucket").json(f"{folder}/pages")
    book_text(pages).select("doc_id", "book_text", bucket().alias("bucket")).write.mode("overwrite").partitionBy("bucket").json(f"{folder}/text")


def bucket(n: int = 256) -> Column:
    """The folder of a document."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(n)).cast("int")


def write_documents(docs: DataFrame, folder: str) -> None:
    """to_json()'s rows, a line a document, in folders by a hash of the id."""
    docs.select(F.col("json").alias("value"), bucket().alias("bucket")).write.mode("overwrite").partitionBy("bucket").text(folder)


def append_manifest(rows: DataFrame, folder: str) -> None:
    """Rows as JSON lines behind those that are there."""
    rows.write.mode("append").json(folder)


def write_manifest(rows: DataFrame, folder: str) -> None:
    """The manifest in its order, in files of ranges: one after the other they are sorted."""
    from ..operators.corpus import edition_order

    rows.orderBy(*edition_order()).write.mode("overwrite").json(folder)


def export(books: DataFrame, root: str) -> DataFrame:
    """The healthy of books(corpus_key, ok, doc_path, ...) with paths relative to root, and the reasons of the others."""
    rel = F.when(F.col("ok"), F.concat("corpus_key", F.lit("/"), F.substring_index("doc_path", "/", -1)))
    return books.withColumn("rel_path", rel).withColumn("exit_code", F.when(F.col("ok"), 0).otherwise(3)).withColumn("root", F.lit(root))
