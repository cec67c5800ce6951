"""What the training-data operators share: the scratch folder, Arrow batches as flat bytes, hashes in numpy."""

from __future__ import annotations

import ctypes
import io
import tempfile
import uuid
from collections import OrderedDict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space between words, everywhere in this package.
SPACE = r"[\x20\x09-\x0D]+"
_own: dict[str, str] = {}
#: Whether Spark deletes the shuffle files of a query at its end, instead of when the driver's collector finds the shuffle unused.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, as a URI or path: spark.checkpoint.dir, or, where it is unset and all runs on one machine, a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = _own.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="folio-")
        _own[spark.sparkContext.applicationId] = at
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_dir(spark)}/folio/{name}-{uuid.uuid4().hex[:12]}"


def table(df: DataFrame, name: str, clean: bool = False) -> DataFrame:
    """df written as Parquet below the shared folder and read again: its lineage ends there, and a lost executor costs nothing. With clean, the shuffles that made it are deleted at the end of the write."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, None)
    if clean:
        spark.conf.set(_CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        if clean:
            spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    done = spark.read.schema(df.schema).parquet(path)
    done.scratch_path = path
    return done


def free(*tables: DataFrame, spark: SparkSession | None = None) -> None:
    """Deletes tables that nothing reads any more, and lets the driver forget shuffles that are no longer in use, so that their files go too."""
    spark = spark or tables[0].sparkSession
    for t in tables:
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark._jvm.System.gc()


#: Rows up to which a side of a few numbers a row is sent to all executors (below 32 MB), and the least weight of a hot key.
SENT, HOT_KEY = 500_000, 256


def dealt_join(rows: DataFrame, keys: DataFrame, on: list[str], weight: str, how: str = "inner", sent: int | None = None) -> DataFrame:
    """rows joined with a written table keys that has each of `on` once, and in weight about how many of rows have it.

    Keys are sent if they are few. Else those with more than a hundred-thousandth of all weight are, which bounds their
    number, and only rows of other keys are shuffled: no key brings a large share of rows into one task.
    """
    n = keys.agg(F.count(F.lit(1)), F.sum(weight)).first()
    if n[0] <= (SENT if sent is None else sent):
        return rows.join(F.broadcast(keys), on, how)
    hot = F.broadcast(keys.filter(F.col(weight) > max(HOT_KEY, n[1] // 100_000)))
    return rows.join(hot, on).unionByName(rows.join(hot.select(on), on, "left_anti").join(keys, on, how))


def remainder(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % n


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in one array, and where each text begins in it (one more than texts); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    texts = texts.cast(pa.large_binary())
    begin = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8)[begin[0] : begin[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, begin - begin[0]


def give_back() -> None:
    """Returns freed memory to the system: workers live long, and executors count what they hold."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another libc
    _trim = None


def runs(begin: np.ndarray, most: int):
    """(first, last) of runs of texts with at most `most` bytes each, or of one longer text."""
    first, n = 0, len(begin) - 1
    while first < n:
        last = max(int(np.searchsorted(begin, begin[first] + most, "right")) - 1, first + 1)
        yield first, min(last, n)
        first = last


def mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash; new array."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


#: A 64-bit number for each byte, and the odd base of the rolling hash with its inverse modulo 2**64.
BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
BASE = 0x9E3779B97F4A7C15 | 1
BACK = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** i modulo 2**64 for i < n; kept, as many calls need them."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        x = np.full(max(n, 1 << 16), base, np.uint64)
        x[0] = 1
        have = _powers[base] = np.multiply.accumulate(x)
    return have[:n]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of BYTE[data[k]] * BASE**k over i <= k < j, modulo 2**64."""
    s = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE[data] * powers(BASE, len(data)), out=s[1:])
    return s


def span_hash(s: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """A hash of the bytes i..j of the data behind s: the same wherever they stand."""
    return mix((s[j] - s[i]) * powers(BACK, len(s))[i] + (j - i).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


_SEP = np.zeros(256, bool)
_SEP[[0x20, *range(0x09, 0x0E)]] = True


def words(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words in the flat bytes, and how many words stand before each text (one more than texts)."""
    word = ~_SEP[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[begin] = True
    start, end = word.copy(), word.copy()
    if len(data):
        start[1:] &= ~word[:-1] | edge[1:-1]
        end[:-1] &= ~word[1:] | edge[1:-1]
    start, end = np.flatnonzero(start), np.flatnonzero(end) + 1
    return start, end, np.searchsorted(start, begin)


def save_array(folder: str, x: np.ndarray) -> str:
    """Writes x as a new file below folder, a URI that all workers reach; the file's URI. A task that is run again leaves its first file behind unread."""
    uri = f"{folder}/{uuid.uuid4().hex}.npy"
    store, path = _store(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    held = io.BytesIO()
    np.lib.format.write_array_header_1_0(held, np.lib.format.header_data_from_array_1_0(x))
    with store.open_output_stream(path) as to:
        to.write(held.getvalue())
        to.write(memoryview(np.ascontiguousarray(x).reshape(-1).view(np.uint8)))
    return uri


def load_array(uri: str) -> np.ndarray:
    """The array of save_array: memory-mapped where the folder is mounted; of a store's the last used ones stay in memory, up to HELD bytes a worker."""
    if uri in _arrays:
        _arrays.move_to_end(uri)
        return _arrays[uri]
    store, path = _store(uri)
    if isinstance(store, fs.LocalFileSystem):
        x = np.load(path, mmap_mode="r")
    else:
        with store.open_input_file(path) as f:
            x = np.load(io.BytesIO(f.read()))
    _arrays[uri] = x
    while len(_arrays) > 4000 or len(_arrays) > 1 and sum(_memory(x) for x in _arrays.values()) > HELD:
        _arrays.popitem(last=False)
    return x


def _memory(x: np.ndarray) -> int:
    return 0 if isinstance(x, np.memmap) else x.nbytes


#: Bytes of arrays from a store that a worker keeps.
HELD = 256_000_000
_arrays: OrderedDict[str, np.ndarray] = OrderedDict()


def _store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def packed(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
