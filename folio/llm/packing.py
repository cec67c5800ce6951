"""Packing (4): token windows by best-fit decreasing over a segment tree of remaining capacities."""

from __future__ import annotations

import math
import os
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

SIZE = 1024
#: Rests in one packing task: enough that its last, partly filled sequences don't count, few enough for its memory.
RESTS_A_TASK = 50_000
#: Id that ends each document.
END = 0
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
_loaded: dict[str, object] = {}


class Tokens:
    """Ids of whole texts as the tokenizers library gives them for a byte-level BPE file.

    The same vocabulary as ranks runs several times faster; texts that hold the string of a special token, which
    the library replaces by that token's id, go to the library itself.
    """

    def __init__(self, path: str):
        import base64  # noqa: F401

        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.exact = Tokenizer.from_file(path)
        special = {t.content for t in self.exact.get_added_tokens_decoder().values()}
        self.special = sorted(special)
        chars = _byte_chars()
        ranks = {bytes(chars[c] for c in piece): i for piece, i in self.exact.get_vocab(with_added_tokens=False).items() if piece not in special}
        self.fast = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if any(s in text for s in self.special):
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32, copy=False)


def _byte_chars() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: printable ones for themselves, the rest from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def tokens(path: str) -> Tokens:
    if path not in _loaded:
        _loaded[path] = Tokens(path)
    return _loaded[path]


class BestFit:
    """Open sequences by remaining capacity, in a segment tree of how many there are."""

    def __init__(self, size: int):
        self.size, self.leaves = size, 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.open: list[list[int]] = [[] for _ in range(self.leaves)]
        self.sequences = 0

    def _add(self, capacity: int, n: int) -> None:
        at = self.leaves + capacity
        while at:
            self.count[at] += n
            at >>= 1

    def _tightest(self, length: int) -> int:
        """The smallest capacity of at least length that an open sequence has, or 0."""
        at = self.leaves + length
        if self.count[at]:
            return length
        while at > 1:
            if not at & 1 and self.count[at + 1]:
                at += 1
                while at < self.leaves:
                    at = 2 * at if self.count[2 * at] else 2 * at + 1
                return at - self.leaves
            at >>= 1
        return 0

    def put(self, length: int) -> tuple[int, int]:
        """The sequence and offset of a piece: in the tightest open sequence that holds it, else in a new one."""
        capacity = self._tightest(length)
        if capacity:
            sequence = self.open[capacity].pop()
            self._add(capacity, -1)
        else:
            sequence, capacity = self.sequences, self.size
            self.sequences += 1
        if capacity > length:
            self.open[capacity - length].append(sequence)
            self._add(capacity - length, 1)
        return sequence, self.size - capacity


def best_fit_decreasing(lengths: np.ndarray, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """For each piece, longest first and in the given order among equals, its sequence and offset."""
    tree, sequence, offset = BestFit(size), np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        sequence[i], offset[i] = tree.put(int(lengths[i]))
    return sequence, offset


def cut(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", size: int = SIZE) -> DataFrame:
    """Each document's full windows, with a sequence of their own, and its rest, without one."""
    schema = pa.schema([("doc_id", pa.int64()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id"))])

    def run(batches):
        own, made = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            ids_of, out = tokens(path).ids, []
            for key, one in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(ids_of(one.as_py() or ""), np.uint32(END)).astype("<u4")
                n = len(ids)
                for at in range(0, n, size):
                    part = ids[at : at + size]
                    full = len(part) == size
                    out.append((key, at, len(part), zlib.crc32(part.tobytes()), n, own + made if full else None))
                    made += full
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema=schema)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long")


def pack(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", size: int = SIZE, rests_a_task: int = RESTS_A_TASK) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and END; what fills whole windows becomes full sequences at once, without a shuffle. The
    rests, spread by hash over tasks of about rests_a_task, are packed best-fit decreasing; a document is in as many
    pieces as it has windows. A null or empty text is END alone; a null doc_id stays null; repeated rows are packed each
    by itself, in any order among equals; an empty table gives no rows; other columns aren't read.
    """
    pieces = table(cut(docs, path, text, doc_id, size), "pieces")
    full = pieces.filter("sequence_id IS NOT NULL").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    rests = pieces.filter("sequence_id IS NULL").drop("sequence_id")
    tasks = max(1, math.ceil(rests.count() / rests_a_task))

    def run(frames):
        rows = pd.concat(list(frames), ignore_index=True)
        rows = rows.sort_values(["length", "doc_id", "ids_crc32"], ascending=[False, True, True], kind="stable", ignore_index=True)
        sequence, rows["offset"] = best_fit_decreasing(rows["length"].to_numpy(), size)
        rows["sequence_id"] = sequence + (1 << 62) + (TaskContext.get().partitionId() << 32)
        yield rows[["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]]

    dealt = rests.repartition(tasks, F.xxhash64("doc_id", "ids_crc32", "length"))
    return full.unionByName(dealt.mapInPandas(_some(run), PIECES))


def _some(run):
    """run for partitions with rows; the others give nothing."""

    def held(frames):
        frames = [f for f in frames if len(f)]
        if frames:
            yield from run(iter(frames))

    return held


def op4_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
