"""Language-model scoring (3): interpolated modified Kneser-Ney over word n-grams, in memory-mapped sorted hash arrays."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import flat, free, give_back, load_array, mix, packed, prefix_hash, remainder, runs, save_array, scratch, span_hash, table, words

#: Bytes of text whose counts are merged before they are sent, that are hashed at once, that are scored at once, and whose bigrams one shard holds.
BATCH, CHUNK, SCORED, SHARD = 16_000_000, 2_000_000, 6_000_000, 16_000_000
#: Token hashes have 56 bits; these two stand for the begin and the end of a text.
BITS = 56
BEGIN, END = np.uint64(1), np.uint64(2)
#: So many of the most frequent tokens of the same sample are sent as two bytes; it decides how n-grams are written in a shuffle, not what is counted.
COMMON = 65_535
#: In the arrays keys of n-grams keep, behind the bits of their bucket of at most 16 keys, so many bits: one of 2**28 n-grams that aren't there is taken for one that is.
KEPT = 32
#: Tokens that make up at least this share of a sample are first tokens of so many bigrams that these are dealt by their second token.
HOT, HOT_SAMPLE = 1 / 500, 20_000_000
#: The order of the query's model.
ORDER = 3
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def tokens(data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(tokens, tokens before them, where each text's begin): lower-cased words as hashes, with END after each text's last."""
    toks, sizes = [], []
    for first, last in runs(begin, CHUNK):
        a, z = int(begin[first]), int(begin[last])
        part = _LOWER[data[a:z]]
        start, end, at = words(part, begin[first : last + 1] - a)
        h = span_hash(prefix_hash(part), start, end) >> np.uint64(64 - BITS)
        h[h <= END] += np.uint64(3)
        n = np.diff(at)
        out = np.full(len(h) + len(n), END, np.uint64)
        out[np.arange(len(h)) + np.repeat(np.arange(len(n)), n)] = h
        toks.append(out)
        sizes.append(n + 1)
    tok = np.concatenate([*toks, np.zeros(0, np.uint64)])
    at = np.r_[0, np.cumsum(np.concatenate([*sizes, np.zeros(0, np.int64)]))]
    before = np.r_[BEGIN, tok[:-1]][: len(tok)]
    before[at[:-1]] = BEGIN
    return tok, before, at


def order_of(h: np.ndarray) -> np.ndarray:
    """The places of hashes in sorted order; equal ones stay in theirs.

    Hashes with their place in the low bits sort several times as fast as places do. The few that agree in all other bits
    are put right afterwards, so h has to be mixed.
    """
    low = np.uint64((1 << max(1, (len(h) - 1).bit_length())) - 1)
    by = (np.sort((h & ~low) | np.arange(len(h), dtype=np.uint64)) & low).astype(np.int64)
    while True:
        s = h[by]
        late = np.flatnonzero(s[1:] < s[:-1])
        if not len(late):
            return by
        late = late[np.r_[True, np.diff(late) > 1]]
        by[late], by[late + 1] = by[late + 1], by[late]


def numbered(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values of x, sorted, and for each of x its number among them."""
    by = order_of(mix(x))
    s = x[by]
    new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.zeros(0, bool)
    some = np.argsort(s[new])
    rank = np.empty(len(some), np.int64)
    rank[some] = np.arange(len(some))
    out = np.empty(len(x), np.int64)
    out[by] = rank[np.cumsum(new) - 1]
    return s[new][some], out


def histories(tok: np.ndarray, before: np.ndarray, at: np.ndarray, order: int, begin: int = BEGIN) -> list[np.ndarray]:
    """The columns of the n-grams of this order that end with each token; what lies before a text is begin."""
    cols = [before, tok]
    while len(cols) < order:
        far = np.r_[begin, cols[0][:-1]][: len(tok)]
        far[at[:-1]] = begin
        cols.insert(0, far)
    return cols


def _shard_of(a: np.ndarray, shards: int) -> np.ndarray:
    """Equal ranges of the tokens' hashes, mixed once more so that the two fixed tokens lie anywhere."""
    return ((a >> np.uint64(BITS - 32)) * np.uint64(shards)) >> np.uint64(32)


def _deal(a: np.ndarray, b: np.ndarray, hot: np.ndarray, shards: int) -> np.ndarray:
    """The shards of bigrams: by the first token, or by the second where the first is hot."""
    at = np.minimum(np.searchsorted(hot, a), len(hot) - 1)
    return _shard_of(np.where(hot[at] == a, b, a), shards)


def _bytes7(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _from7(raw: bytes, n: int, at: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :7] = np.frombuffer(raw, np.uint8, 7 * n, at).reshape(n, 7)
    return out.reshape(-1).view("<u8")


def _summed(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct keys (columns, the first counts most), sorted, with their summed counts."""
    by = np.lexsort(keys[::-1])
    keys, counts = [k[by] for k in keys], counts[by]
    if not len(counts):
        return keys, counts
    new = np.zeros(len(counts), bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[1:] != k[:-1]
    first = np.flatnonzero(new)
    return [k[first] for k in keys], np.add.reduceat(counts, first)


_ROWS = pa.schema([("shard", pa.int32()), ("part", pa.int64()), ("data", pa.binary())])
_DDL = "shard int, part long, data binary"


def _pack(a: np.ndarray, b: np.ndarray, count: np.ndarray) -> bytes:
    """Sorted bigrams: each first token once with the number of its bigrams, then second tokens and counts."""
    first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
    own = np.diff(np.r_[first, len(a)])
    small = np.minimum(count, 255).astype(np.uint8)
    large = count[count >= 255].astype(np.int64)
    return np.array([len(a), len(first), len(large)], np.int64).tobytes() + _bytes7(a[first]) + own.astype(np.uint32).tobytes() + _bytes7(b) + small.tobytes() + large.tobytes()


def _unpack(raw: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n, k, large = np.frombuffer(raw, np.int64, 3).tolist()
    at = 24
    a = _from7(raw, k, at)
    at += 7 * k
    own = np.frombuffer(raw, np.uint32, k, at)
    at += 4 * k
    b = _from7(raw, n, at)
    at += 7 * n
    count = np.frombuffer(raw, np.uint8, n, at).astype(np.int64)
    count[count == 255] = np.frombuffer(raw, np.int64, large, at + n)
    return np.repeat(a, own), b, count


def grams(tok: np.ndarray, at: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct n-grams of texts as columns, sorted, and their counts. Tokens are numbered, so that an n-gram is one number if there is room for it."""
    token, number = numbered(np.r_[BEGIN, tok])
    begin, number = number[0], number[1:]
    before = np.r_[begin, number[:-1]][: len(number)]
    before[at[:-1]] = begin
    cols, bits = histories(number, before, at, order, begin), len(token).bit_length()
    if order * bits > 64:
        cols, count = _summed(cols, np.ones(len(tok), np.int64))
        return [token[c] for c in cols], count
    key = np.zeros(len(tok), np.uint64)
    for c in cols:
        key = (key << np.uint64(bits)) | c.astype(np.uint64)
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
    some, low = key[first], np.uint64((1 << bits) - 1)
    return [token[((some >> np.uint64(bits * i)) & low).astype(np.int64)] for i in reversed(range(order))], np.diff(np.r_[first, len(key)])


def _distinct(cols: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Distinct n-grams by their keys, their summed rows of counts, and their sorted keys."""
    key = _gram_key(cols)
    by = order_of(key)
    key = key[by]
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
    return [c[by[first]] for c in cols], np.add.reduceat(counts[by], first, axis=0), key[first]


def _pack_grams(cols: list[np.ndarray], counts: np.ndarray, common: np.ndarray) -> bytes:
    """N-grams as columns, with a row of counts for each. Tokens that repeat those of the n-gram before, from its first on, are left out; of the others common ones are their rank."""
    by_hash = np.argsort(common)
    sorted_ = common[by_hash]
    flat_ = counts.reshape(-1)
    large = flat_[flat_ >= 255].astype(np.int64)
    head, out, new = [len(counts), counts.shape[1], len(large)], [], np.zeros(len(counts), bool)
    new[:1] = True
    for i, c in enumerate(cols):
        new[1:] |= c[1:] != c[:-1]
        x = c[new] if i < len(cols) - 1 else c
        place = np.minimum(np.searchsorted(sorted_, x), len(sorted_) - 1)
        rank = np.where(sorted_[place] == x, by_hash[place], COMMON).astype(np.uint16)
        rare = x[rank == COMMON]
        head += [len(x), len(rare)]
        out += [np.packbits(new).tobytes(), (rank >> 8).astype(np.uint8).tobytes(), (rank & 255).astype(np.uint8).tobytes(), _bytes7(rare)]
    raw = np.array(head, np.int64).tobytes() + b"".join(out) + np.minimum(flat_, 255).astype(np.uint8).tobytes() + large.tobytes()
    return zstandard.ZstdCompressor(level=1).compress(raw)


def _unpack_grams(raw: bytes, order: int, common: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    n, k, large, *sizes = np.frombuffer(raw, np.int64, 3 + 2 * order).tolist()
    at, cols = 24 + 16 * order, []
    for i in range(order):
        m, rare = sizes[2 * i : 2 * i + 2]
        new = np.unpackbits(np.frombuffer(raw, np.uint8, (n + 7) // 8, at))[:n]
        at += (n + 7) // 8
        rank = np.frombuffer(raw, np.uint8, m, at).astype(np.int64) << 8 | np.frombuffer(raw, np.uint8, m, at + m)
        at += 2 * m
        x = common[np.minimum(rank, len(common) - 1)]
        x[rank == COMMON] = _from7(raw, rare, at)
        at += 7 * rare
        cols.append(x[np.cumsum(new, dtype=np.int64) - 1] if i < order - 1 else x)
    counts = np.frombuffer(raw, np.uint8, n * k, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(raw, np.int64, large, at + n * k)
    return cols, counts.reshape(n, k)


def _dealt(cols: list[np.ndarray], counts: np.ndarray, hot: np.ndarray, shards: int, common: np.ndarray):
    """(shard, part, data) of summed n-grams: bigrams as _deal deals them, longer ones by all tokens but the last."""
    shard = _deal(*cols, hot, shards) if len(cols) == 2 else _shard_of_key(_gram_key(cols[:-1]), shards)
    by = np.argsort(shard.astype(np.uint16) if shards <= 1 << 16 else shard, kind="stable")
    cols, counts = [c[by] for c in cols], counts[by]
    cut = np.searchsorted(shard[by], np.arange(shards + 1, dtype=np.uint64))
    return [(i, int(cols[0][cut[i]] ^ cols[-1][cut[i]]), _pack_grams([c[x:z] for c in cols], counts[x:z], common)) for i in range(shards) if (x := cut[i]) < (z := cut[i + 1])]


def keyed(key: np.ndarray) -> np.ndarray:
    """Bytes of sorted keys of 64 bits, about four and a half a key: where each bucket of equal first bits begins, then the next KEPT bits of each key."""
    bits = max(1, len(key).bit_length() - 4)
    start = np.searchsorted(key >> np.uint64(64 - bits), np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.uint32)
    return np.r_[np.uint32(bits), start, _kept(key, bits)].view(np.uint8)


def _kept(key: np.ndarray, bits: int) -> np.ndarray:
    return ((key >> np.uint64(64 - bits - KEPT)) & np.uint64((1 << KEPT) - 1)).astype(np.uint32)


def find(raw: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The place of each key in keyed bytes, or -1: all are searched in their buckets at once."""
    words_ = raw.view(np.uint32)
    bits = int(words_[0])
    start, kept = words_[1 : (1 << bits) + 2], words_[(1 << bits) + 2 :]
    if not len(kept) or not len(key):
        return np.full(len(key), -1, np.int64)
    bucket, want = (key >> np.uint64(64 - bits)).astype(np.int64), _kept(key, bits)
    low, end = start[bucket].astype(np.int64), start[bucket + 1].astype(np.int64)
    high = end.copy()
    for _ in range(int((high - low).max()).bit_length()):
        half = (low + high) >> 1
        less = (kept[np.minimum(half, len(kept) - 1)] < want) & (low < high)
        low, high = np.where(less, half + 1, low), np.where(less, high, half)
    return np.where((low < end) & (kept[np.minimum(low, len(kept) - 1)] == want), low, -1)


def gram_arrays(key: np.ndarray, count: np.ndarray) -> list[np.ndarray]:
    """Arrays of n-grams by their sorted keys: those that stand once without a count."""
    once = count == 1
    return [keyed(key[once]), keyed(key[~once]), *counted(count[~once])]


def counted(x: np.ndarray) -> list[np.ndarray]:
    """Counts (or rows of them) as bytes, and places and values of those that don't fit."""
    wide = np.flatnonzero((x if x.ndim == 1 else x.max(1, initial=0)) >= 255)
    return [np.minimum(x, 255).astype(np.uint8), wide, x[wide].astype(np.int64)]


def counts_at(arrays: list[np.ndarray], at: np.ndarray) -> np.ndarray:
    small, wide, values = arrays
    out = small[at].astype(np.int64)
    large = np.flatnonzero(out == 255) if out.ndim == 1 else np.flatnonzero((out == 255).any(1))
    out[large] = values[np.searchsorted(wide, at[large])]
    return out


_TYPES = ["|u1", "<u4", "<u8", "<i8", "<f4"]


def save_arrays(folder: str, arrays: list[np.ndarray]) -> str:
    """One file of several arrays, each at a multiple of eight bytes."""
    head, parts = [len(arrays)], []
    for x in arrays:
        raw = np.ascontiguousarray(x).reshape(-1).view(np.uint8)
        head += [_TYPES.index(x.dtype.str), x.shape[1] if x.ndim > 1 else 0, len(raw)]
        parts += [raw, np.zeros(-len(raw) % 8, np.uint8)]
    return save_array(folder, np.concatenate([np.array(head, np.int64).view(np.uint8), *parts]))


def load_arrays(uri: str) -> list[np.ndarray]:
    raw = np.asarray(load_array(uri))
    k = int(raw[:8].view(np.int64)[0])
    at, out = 8 + 24 * k, []
    for kind, width, size in raw[8:at].view(np.int64).reshape(k, 3).tolist():
        x = raw[at : at + size].view(_TYPES[kind])
        out.append(x.reshape(-1, width) if width else x)
        at += size + -size % 8
    return out


def _frequent(batches):
    """Of a sample, the tokens that a batch has more than once, with their counts, and all tokens' number as token 0."""
    for batch in batches:
        tok = tokens(*flat(batch.column(0)))[0]
        token, count = np.unique(tok, return_counts=True)
        some = count > 1
        yield pa.RecordBatch.from_arrays([pa.array(np.r_[np.uint64(0), token[some]].astype(np.int64)), pa.array(np.r_[len(tok), count[some]].astype(np.int64))], names=["token", "n"])


def hot_tokens(docs: DataFrame, size: int, text: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """Of a sample of about HOT_SAMPLE bytes BEGIN and the hot tokens, a few hundred at most; and the COMMON most frequent ones, by rank.

    They decide only where bigrams are summed and how n-grams are written, not what the sums are.
    """
    some = docs.filter(F.pmod(F.xxhash64(text), F.lit(max(1, size // HOT_SAMPLE))) == 0).select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    n = some.mapInArrow(_frequent, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    rows = {r.token: r.n for r in n.orderBy(F.desc("n"), "token").limit(COMMON).collect()}
    least = HOT * rows.pop(0, 0)
    common = [int(BEGIN), *(t for t in rows if t != int(BEGIN))][:COMMON]
    return np.array(sorted({int(BEGIN)} | {t for t, k in rows.items() if k >= least}), np.uint64), np.array(common, np.uint64)


def _count(shards: int, hot: np.ndarray, common: np.ndarray, order: int = 2):
    def run(batches):
        for batch in batches:
            data, begin = flat(batch.column(1))
            for first, last in runs(begin, BATCH):
                lo, hi = int(begin[first]), int(begin[last])
                tok, before, at = tokens(data[lo:hi], begin[first : last + 1] - lo)
                if order > 2:
                    cols, count = grams(tok, at, order)
                    yield packed(_dealt(cols, count[:, None], hot, shards, common), _ROWS)
                    del cols, count, tok, before
                    give_back()
                    continue
                (a, b), count = _summed([before, tok], np.ones(len(tok), np.int64))
                shard = _deal(a, b, hot, shards)
                by = np.argsort(shard, kind="stable")
                a, b, count = a[by], b[by], count[by]
                cut = np.searchsorted(shard[by], np.arange(shards + 1, dtype=np.uint64))
                rows = [(i, int(b[cut[i]] ^ a[cut[i]]), _pack(a[x:z], b[x:z], count[x:z])) for i in range(shards) if (x := cut[i]) < (z := cut[i + 1])]
                yield packed(rows, _ROWS)
                give_back()

    return run


def _key(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(a * np.uint64(0x9E3779B97F4A7C15) + b)


def _gram_key(cols: list[np.ndarray]) -> np.ndarray:
    key = cols[0]
    for c in cols[1:]:
        key = _key(key, c)
    return key


def _shard_of_key(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _of_counts(count: np.ndarray) -> np.ndarray:
    """How many are 1, 2, 3 and 4."""
    return np.bincount(np.minimum(count, 5), minlength=6)[1:5]


def _grouped(batches):
    """(shard, its parts) of sorted rows."""
    shard, held = None, []
    for batch in batches:
        for i, raw in zip(batch.column("shard").to_pylist(), batch.column("data"), strict=True):
            if i != shard:
                if held:
                    yield shard, held
                shard, held = i, []
            held.append(raw.as_py())
    if held:
        yield shard, held


#: What a shard of the bigrams returns: files and sums; a hot token's part of its sums; and, for other shards, in how many bigrams tokens are second.
_MERGED = pa.schema([("shard", pa.int32()), ("files", pa.list_(pa.string())), ("sums", pa.list_(pa.int64())), ("hot", pa.int64()), ("to", pa.int32()), ("data", pa.binary())])
_MERGED_DDL = "shard int, files array<string>, sums array<long>, hot long, to int, data binary"


def _level(n: int, shards: int, folder: str, hot: np.ndarray, common: np.ndarray):
    """Sorted arrays of the n-grams (of three tokens or more) of a shard and of their contexts; and, for other shards, the n-grams without their first token.

    Those count in how many n-grams they are; where they begin a text nothing else can stand before them, and they keep
    their count. The second count is always that of the texts. N-grams of fewer tokens, at the begin of texts, only pass.
    """
    def run(batches):
        for shard, parts in _grouped(batches):
            cols, counts = zip(*[_unpack_grams(raw, n, common) for raw in parts], strict=True)
            del parts
            cols, counts, key = _distinct([np.concatenate(c) for c in zip(*cols, strict=True)], np.concatenate(counts))
            real = cols[1] != BEGIN
            count, key = counts[real, 0], key[real]
            context = _gram_key([c[real] for c in cols[:-1]])
            by = order_of(context)
            context, held = context[by], count[by]
            first = np.flatnonzero(np.r_[True, context[1:] != context[:-1]]) if len(context) else np.zeros(0, np.int64)
            own = np.stack([np.add.reduceat(x.astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for x in (held, held == 1, held == 2, held >= 3)], 1)
            context, once = context[first], own[:, 0] == 1
            file = save_arrays(folder, [*gram_arrays(key, count), keyed(context[once]), keyed(context[~once]), *counted(own[~once])])
            yield packed([(shard, [file], [*_of_counts(count).tolist(), len(count)], None, None, None)], _MERGED)
            del key, context, own, by, held
            lower, counts, _ = _distinct(cols[1:], np.stack([np.where(real, 1, counts[:, -1]), counts[:, -1]], 1))
            del cols
            by = order_of(mix(lower[0]))
            for i, _, raw in _dealt([c[by] for c in lower], counts[by], hot, shards, common):
                yield packed([(shard, None, None, None, i, raw)], _MERGED)
            give_back()

    return run


def _merge(shards: int, folder: str, hot: np.ndarray, common: np.ndarray, order: int = 2):
    def run(batches):
        for shard, parts in _grouped(batches):
            if order > 2:
                cols, counts = zip(*[_unpack_grams(raw, 2, common) for raw in parts], strict=True)
                (a, b), counts, _ = _distinct([np.concatenate(c) for c in zip(*cols, strict=True)], np.concatenate(counts))
                by = order_of(mix(a))
                a, b, (count, of_texts) = a[by], b[by], counts[by].T.copy()
                del cols, counts, by
            else:
                a, b, count = (np.concatenate(x) for x in zip(*map(_unpack, parts), strict=True))
                (a, b), count = _summed([a, b], count)
            del parts
            first = np.flatnonzero(np.r_[True, a[1:] != a[:-1]])
            total = np.add.reduceat(count, first)
            ns = [np.add.reduceat((count == k if k < 3 else count >= 3).astype(np.int64), first) for k in (1, 2, 3)]
            key = _key(a, b)
            by = order_of(key)
            token, own = a[first], np.stack([total, *ns] if order == 2 else [np.add.reduceat(of_texts, first), *ns, total], 1)
            at = np.isin(token, hot)
            files = [save_arrays(folder, gram_arrays(key[by], count[by])), save_arrays(f"{folder}/first", [token[~at], *counted(own[~at])])]
            yield packed([(shard, files, [*_of_counts(count).tolist(), len(count)], None, None, None)], _MERGED)
            yield packed([(shard, None, x, t, None, None) for t, x in zip(token[at].tolist(), own[at].tolist(), strict=True)], _MERGED)
            del key, by
            b, n = np.unique(b, return_counts=True)
            cut = np.searchsorted(_shard_of(b, shards), np.arange(shards + 1, dtype=np.uint64))
            for i in range(shards):
                x, z = cut[i], cut[i + 1]
                if x < z:
                    small, large = np.minimum(n[x:z], 255).astype(np.uint8), n[x:z][n[x:z] >= 255]
                    raw = np.array([z - x, len(large)], np.int64).tobytes() + _bytes7(b[x:z]) + small.tobytes() + large.tobytes()
                    yield packed([(shard, None, None, None, i, raw)], _MERGED)
            give_back()

    return run


def discounts(n: list[int]) -> tuple[float, float, float]:
    """The three discounts of modified Kneser-Ney from how many counts are 1, 2, 3 and 4; 0.5, 1 and 1.5 where one of those is 0."""
    if min(n) == 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0.0), float(k)) for k in (1, 2, 3))


def _vocabulary(folder: str, shards: int, contexts: dict[int, str], hot: dict[int, list[int]], d: tuple[float, float, float], order: int = 2):
    """Per shard the tokens, their counts, the bigrams they are second in, and the weight that they leave as a first token; from order three on also the sum of the counts of their bigrams, which then aren't those of the texts."""
    width = 4 if order == 2 else 5

    def run(batches):
        for shard, parts in _grouped(batches):
            b, n = [], []
            for raw in parts:
                k, large = np.frombuffer(raw, np.int64, 2).tolist()
                b.append(_from7(raw, k, 16))
                count = np.frombuffer(raw, np.uint8, k, 16 + 7 * k).astype(np.int64)
                count[count == 255] = np.frombuffer(raw, np.int64, large, 16 + 8 * k)
                n.append(count)
            (b,), n = _summed([np.concatenate(b)], np.concatenate(n))
            file = contexts.get(shard)
            a, *of = load_arrays(file) if file else [np.zeros(0, np.uint64), *counted(np.zeros((0, width), np.int64))]
            of = counts_at(of, np.arange(len(a)))
            own = np.array(sorted(hot), np.uint64)
            own = own[_shard_of(own, shards) == shard]
            a, of = np.r_[a, own], np.vstack([of, np.array([hot[t] for t in own.tolist()], np.int64).reshape(-1, width)])
            token = np.union1d(a, b)
            second, count, weight = np.zeros(len(token), np.uint32), np.zeros(len(token), np.int64), np.ones(len(token), np.float32)
            second[np.searchsorted(token, b)] = n
            i = np.searchsorted(token, a)
            count[i] = of[:, 0]
            total = np.zeros(len(token), np.int64)
            total[i] = of[:, 0 if order == 2 else 4]
            weight[i] = (of[:, 1:4] @ np.array(d)) / total[i]
            count[token == END] = hot.get(int(BEGIN), [0])[0]
            real = token != BEGIN
            sums = [*_of_counts(second[real]).tolist(), int((second[real] >= 3).sum()), int(real.sum()), int(count[real].sum())]
            yield packed([(shard, [save_arrays(folder, [token, weight, *counted(count), *counted(second), *counted(total)])], sums, None, None, None)], _MERGED)

    return run


@dataclass
class Model:
    """Where the arrays are, by shard, and the few numbers that hold for all."""

    shards: int
    hot: np.ndarray
    bigrams: dict[int, str]
    vocabulary: dict[int, str]
    d2: tuple[float, float, float]
    d1: tuple[float, float, float]
    types: int
    left: float
    distinct: int
    tokens: int
    #: From order three on, of each order its file by shard and its discounts.
    longer: list[tuple[dict[int, str], tuple[float, float, float]]] = field(default_factory=list)

    def _by_shard(self, x: np.ndarray, files: dict[int, str]):
        """(arrays, begin, end) of the runs of x, sorted by shard, that lie in one shard that there is."""
        if len(x):
            first = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
            for i, j in zip(first.tolist(), [*first[1:].tolist(), len(x)], strict=True):
                if int(x[i]) in files:
                    yield load_arrays(files[int(x[i])]), i, j

    def look_up(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Count, bigrams that end with it, and weight left to the lower order, of sorted tokens."""
        return self._known(token)[:3]

    def _known(self, token: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Count, bigrams that end with it, weight left to the lower order, and the sum of the counts of the bigrams that begin with it, of sorted tokens."""
        count, second, total, weight = *(np.zeros(len(token), np.int64) for _ in range(3)), np.ones(len(token))
        for (have, left, *of), i, j in self._by_shard(_shard_of(token, self.shards), self.vocabulary):
            if not len(have):
                continue
            at = np.minimum(np.searchsorted(have, token[i:j]), len(have) - 1)
            hit = np.flatnonzero(have[at] == token[i:j])
            weight[i + hit] = left[at[hit]]
            for k, out in enumerate((count, second, total)):
                out[i + hit] = counts_at(of[3 * k : 3 * k + 3], at[hit])
        return count, second, weight, total

    def bigram_counts(self, shard: np.ndarray, key: np.ndarray) -> np.ndarray:
        """Counts of bigrams, sorted by the first token's shard."""
        return self._gram_counts(self.bigrams, shard, key)

    def _longer(self, cols: list[np.ndarray], p: np.ndarray) -> np.ndarray:
        """p of the lower orders, interpolated with n-grams of three tokens or more; at the begin of a text there are none."""
        grams, d = self.longer[len(cols) - 3]
        real = np.flatnonzero(cols[1] != BEGIN)
        context = _gram_key([c[real] for c in cols[:-1]])
        key = _key(context, cols[-1][real])
        # contexts in the order of their shards, which are ranges of them
        by = order_of(context)
        seen = context[by]
        new = np.r_[True, seen[1:] != seen[:-1]] if len(seen) else np.zeros(0, bool)
        index = np.empty(len(real), np.int64)
        index[by] = np.cumsum(new) - 1
        count = np.zeros(len(real), np.int64)
        count[by] = self._gram_counts(grams, _shard_of_key(seen, self.shards), key[by])
        seen = seen[new]
        own = np.zeros((len(seen), 4), np.int64)
        for arrays, i, j in self._by_shard(_shard_of_key(seen, self.shards), grams):
            once = find(arrays[5], seen[i:j]) >= 0
            own[i:j][once] = (1, 1, 0, 0)
            rest = i + np.flatnonzero(~once)
            at = find(arrays[6], seen[rest])
            own[rest[at >= 0]] = counts_at(arrays[7:10], at[at >= 0])
        total = np.maximum(own[:, 0], 1)
        left = np.where(own[:, 0] > 0, own[:, 1:] @ np.array(d) / total, 1.0)
        out = p.copy()
        out[real] = (count - np.r_[0.0, d][np.minimum(count, 3)]) / total[index] + left[index] * p[real]
        return out

    def _gram_counts(self, grams: dict[int, str], shard: np.ndarray, key: np.ndarray) -> np.ndarray:
        out = np.zeros(len(key), np.int64)
        for arrays, i, j in self._by_shard(shard, grams):
            once = find(arrays[0], key[i:j]) >= 0
            out[i:j][once] = 1
            rest = i + np.flatnonzero(~once)
            at = find(arrays[1], key[rest])
            out[rest[at >= 0]] = counts_at(arrays[2:5], at[at >= 0])
        return out

    def score(self, data: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(tokens, known tokens, base score, model score) of each text."""
        tok, before, at = tokens(data, begin)
        token, index = numbered(np.r_[tok, before])
        count, second, weight, total = self._known(token)
        i, j = index[: len(tok)], index[len(tok) :]
        base = np.log10((count + 0.1) / (self.tokens + 0.1 * (self.distinct + 1)))
        d = np.r_[0.0, self.d1][np.minimum(second, 3)]
        low = (second - d) / max(self.types, 1) + (self.left if self.types else 1.0) / (self.distinct + 1)
        shard, key = _deal(before, tok, self.hot, self.shards), _key(before, tok)
        by = order_of(key)
        by = by[np.argsort(shard[by].astype(np.uint16) if self.shards <= 1 << 16 else shard[by], kind="stable")]
        shard, key = shard[by], key[by]
        new = np.r_[True, (key[1:] != key[:-1]) | (shard[1:] != shard[:-1])] if len(key) else np.zeros(0, bool)
        both = np.zeros(len(tok), np.int64)
        both[by] = self.bigram_counts(shard[new], key[new])[np.cumsum(new) - 1]
        high = (both - np.r_[0.0, self.d2][np.minimum(both, 3)]) / np.maximum(total[j], 1)
        p = high + weight[j] * low[i]
        for n in range(3, 3 + len(self.longer)):
            p = self._longer(histories(tok, before, at, n), p)
        first = at[:-1]
        if not len(first):
            return (np.zeros(0, np.int64),) * 2 + (np.zeros(0),) * 2
        return np.diff(at), np.add.reduceat((count[i] > 0).astype(np.int64), first), np.add.reduceat(base[i], first), np.add.reduceat(np.log10(p), first)


def train(docs: DataFrame, text: str = "text", shard_bytes: int = SHARD, order: int = 2) -> Model:
    """The model of this order (two or more) of all texts of docs; null is empty, and every text ends with one end token.

    From order three on the longest n-grams are counted and shuffled by all tokens but their last; each order tells the next
    lower one in how many n-grams its own are, and bigrams go on with those counts.

    Batches of texts are counted where they are read, and only their distinct bigrams are shuffled, to shards by ranges of
    the first token's hash, or of the second's where the first is one of the few hot ones. A shard sums them and writes sorted arrays below the shared folder; a second, smaller shuffle
    tells each token in how many bigrams it is second. To the driver come file names and a few sums for each shard. What a
    task that runs again has written before isn't named in its result, and so is never read.
    """
    spark = docs.sparkSession
    body = docs.select(F.lit(0).alias("one"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    size = body.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards, folder = max(1, math.ceil(size / shard_bytes)), scratch(spark, "lm")
    if order < 2:
        raise ValueError(f"order {order}")
    hot, common = hot_tokens(body, size)
    parts = body.mapInArrow(_count(shards, hot, common, order), _DDL).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "part")
    longer, held = [], []
    for n in range(order, 2, -1):
        level = table(parts.mapInArrow(_level(n, shards, folder, hot, common), _MERGED_DDL), f"grams{n}", clean=True)
        del parts
        free(*held, spark=spark)
        held = [level]
        done = level.filter("files IS NOT NULL").select("shard", "files", "sums").collect()
        of = np.array([r.sums for r in done], np.int64).reshape(-1, 5).sum(0).tolist()
        longer.insert(0, ({r.shard: r.files[0] for r in done}, discounts(of[:4])))
        parts = level.filter("to IS NOT NULL").select(F.col("to").alias("shard"), F.col("shard").cast("long").alias("part"), "data").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "part")
    merged = table(parts.mapInArrow(_merge(shards, folder, hot, common, order), _MERGED_DDL), "bigrams", clean=True)
    del parts
    free(*held, spark=spark)
    done = merged.filter("files IS NOT NULL").select("shard", "files", "sums").collect()
    sums = np.array([r.sums for r in done], np.int64).reshape(-1, 5).sum(0).tolist()
    bigrams, firsts, d2 = {r.shard: r.files[0] for r in done}, {r.shard: r.files[1] for r in done}, discounts(sums[:4])
    part = merged.filter("hot IS NOT NULL").groupBy("hot").agg(*[F.sum(F.get("sums", F.lit(i))).alias(f"s{i}") for i in range(4 if order == 2 else 5)])
    own_sums = {r.hot: list(r[1:]) for r in part.collect()}
    seconds = merged.filter("to IS NOT NULL").select(F.col("to").alias("shard"), F.col("shard").alias("part"), "data")
    # shards without a second token still may hold first ones: a part of nothing for each
    empty = spark.range(shards).select(F.col("id").cast("int").alias("shard"), F.lit(-1).cast("long").alias("part"), F.lit(bytearray(16)).alias("data"))
    seconds = seconds.unionByName(empty).repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "part")
    done = table(seconds.mapInArrow(_vocabulary(folder, shards, firsts, own_sums, d2, order), _MERGED_DDL), "vocabulary", clean=True).select("shard", "files", "sums").collect()
    vocabulary = {r.shard: r.files[0] for r in done}
    del seconds
    firsts_ = spark.range(0)
    firsts_.scratch_path = f"{folder}/first"
    free(merged, firsts_)
    own = np.array([r.sums for r in done], np.int64).reshape(-1, 7).sum(0).tolist()
    d1, types = discounts(own[:4]), sums[4]
    left = (d1[0] * own[0] + d1[1] * own[1] + d1[2] * own[4]) / types if types else 1.0
    return Model(shards, hot, bigrams, vocabulary, d2, d1, types, left, own[5], own[6], longer)


def score(docs: DataFrame, model: Model, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The columns carry of docs with n_tokens, n_known, base_score and score of each text, all logarithms to base 10.

    Perplexity is 10 ** (-score / n_tokens). Null text is empty: one token, the end. Repeated rows are scored each by
    itself; an empty table gives no rows; columns in carry with the names of the new ones are replaced by those.
    """
    carry = [c for c in carry or [] if c not in ("n_tokens", "n_known", "base_score", "score")]
    made = [("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]

    def run(batches):
        for batch in batches:
            data, begin = flat(batch.column(0))
            for first, last in runs(begin, SCORED):
                lo, hi = int(begin[first]), int(begin[last])
                got = model.score(data[lo:hi], begin[first : last + 1] - lo)
                give_back()
                yield pa.RecordBatch.from_arrays([*(c.slice(first, last - first) for c in batch.columns[1:]), *(pa.array(x, t) for x, (_, t) in zip(got, made, strict=True))], names=[*batch.schema.names[1:], *[n for n, _ in made]])

    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text_"), *[F.col(f"`{c}`") for c in carry])
    ddl = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in rows.schema.fields[1:]) + "n_tokens long, n_known long, base_score double, score double"
    return rows.mapInArrow(run, ddl)


def op3_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", (remainder("doc_id", 10) == 0).alias("held_out"))
    model = train(docs.filter("NOT held_out"), order=ORDER)
    done = score(docs, model, carry=["doc_id", "held_out"])
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
