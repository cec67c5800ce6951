"""Repeated substrings (6): a logarithmic family of suffix arrays over content-chosen suffixes.

Every window of WINDOW bytes picks, by the least hash among its K-byte substrings, one place inside it: the same place
wherever the window stands. The suffixes at those places, about one in 26 bytes, stand for all windows. A batch of
documents becomes a sorted array of them, ordered by the fingerprint of their first K bytes and then by that of the
stretch which their windows cover (neighbouring windows share a place, and so a record). Each new array is merge-scanned
against the existing levels of its shard; equal stretches make the later one removable, and two levels of about equal
size merge. Where suffixes share K bytes but not the whole stretch, their windows are compared one by one, by fingerprint.
So two equal windows always meet, and the result is that of a full suffix array.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BACK, flat, give_back, load_array, mix, packed, powers, prefix_hash, runs, save_array, scratch, span_hash, table

WINDOW, K = 100, 50
#: Bits for a place in a piece of text, and so the most bytes of a piece; all pieces must break ties alike.
PLACE = 20
PIECE = (1 << PLACE) - 2 * WINDOW
#: Bytes of text in one batch, whose suffixes are sorted together, and bytes of text whose suffixes one shard holds.
BATCH, SHARD = 8_000_000, 16_000_000
FIELDS = ("g", "v", "d", "p", "n", "multi")
_NONE = -(1 << 63)


def anchors(data: np.ndarray, begin: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, ...]:
    """Records of the texts in data: fingerprint of the K bytes, of the stretch, text, first window's start, windows.

    s is the prefix hash of data. Starts count from the text's begin.
    """
    n = len(data)
    none = (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))
    if n < WINDOW:
        return none
    m = n - K + 1
    h = mix((s[K:] - s[:m]) * powers(BACK, m) + np.uint64(K))
    low = np.uint64((1 << PLACE) - 1)
    least = (h & ~low) | np.arange(m, dtype=np.uint64)
    width, step = WINDOW - K + 1, 1
    while 2 * step <= width:
        least = np.minimum(least[:-step], least[step:])
        step *= 2
    if step < width:
        least = np.minimum(least[: m - width + 1], least[width - step : width - step + m - width + 1])
    valid = np.ones(n - WINDOW + 1, bool)
    for b in begin[1:-1].tolist():  # a window must not reach into the next text
        valid[max(0, b - WINDOW + 1) : b] = False
    start = np.flatnonzero(valid)
    if not len(start):
        return none
    place = (least[start] & low).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    count = np.diff(np.r_[first, len(start)])
    a, p = place[first], start[first]
    text = np.searchsorted(begin, p, "right") - 1
    v = mix(span_hash(s, p, p + count + WINDOW - 1) + (a - p).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    # least hashes lie near 0: mixed again, so that ranges of them are of equal size
    return mix(h[a]), v, text, p - begin[text], count


def pieces(data: np.ndarray, begin: np.ndarray):
    """(data, begin, first text, offset of its start) of pieces of at most PIECE bytes that together hold every window."""
    for first, last in runs(begin, PIECE):
        a, z = int(begin[first]), int(begin[last])
        if z - a <= PIECE:
            yield data[a:z], begin[first : last + 1] - a, first, 0
            continue
        for at in range(a, max(z - WINDOW + 1, a + 1), PIECE - WINDOW):
            end = min(at + PIECE - 1, z)
            yield data[at:end], np.array([0, end - at]), first, at - a


def records(data: np.ndarray, begin: np.ndarray) -> dict[str, np.ndarray]:
    """A batch's suffix array: the records of its texts, sorted by fingerprints, text and place."""
    parts = []
    for part, b, first, offset in pieces(data, begin):
        g, v, text, p, n = anchors(part, b, prefix_hash(part))
        parts.append((g, v, text + first, p + offset, n))
    g, v, d, p, n = (np.concatenate(x) for x in zip(*parts, strict=True)) if parts else (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 3
    by = np.lexsort((p, d, v, g))
    return {"g": g[by], "v": v[by], "d": d[by], "p": p[by], "n": n[by]}


def own_repeats(r: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch's array, by record: is it the first of its stretch; is it at the same place as that first; has its g several stretches."""
    g, v = r["g"], r["v"]
    new_g = np.r_[True, g[1:] != g[:-1]] if len(g) else np.zeros(0, bool)
    first = new_g | np.r_[True, v[1:] != v[:-1]] if len(g) else new_g
    head = np.flatnonzero(first)[np.cumsum(first) - 1] if len(g) else np.zeros(0, np.int64)
    same = (r["d"] == r["d"][head]) & (r["p"] == r["p"][head])
    which = np.cumsum(new_g) - 1
    several = (np.bincount(which, first) > 1)[which] if len(g) else np.zeros(0, bool)
    return first, same, several


class Family:
    """The levels of one shard. add() takes a sorted array with one record per (g, v) and merge-scans it."""

    def __init__(self) -> None:
        self.levels: list[dict[str, np.ndarray]] = []
        self.lost: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, new: dict[str, np.ndarray]) -> None:
        for i, level in enumerate(self.levels):
            self.levels[i], new = self._scan(level, new)
        self.levels.append(new)
        while len(self.levels) > 1 and len(self.levels[-2]["g"]) <= 2 * len(self.levels[-1]["g"]):
            a, b = self.levels.pop(), self.levels.pop()
            both = {f: np.concatenate([b[f], a[f]]) for f in FIELDS}
            by = np.lexsort((both["v"], both["g"]))
            self.levels.append({f: x[by] for f, x in both.items()})

    def _scan(self, level: dict, new: dict) -> tuple[dict, dict]:
        if not len(level["g"]) or not len(new["g"]):
            return level, new
        lo, hi = np.searchsorted(level["g"], new["g"]), np.searchsorted(level["g"], new["g"], "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            return level, new
        size = (hi - lo)[hit]
        mine = np.repeat(hit, size)
        theirs = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo[hit], size)
        equal = level["v"][theirs] == new["v"][mine]
        # a record that sums up several stretches (multi from its batch) has v of its own and equals none
        level, new = dict(level), dict(new)
        level["multi"], new["multi"] = level["multi"].copy(), new["multi"].copy()
        level["multi"][theirs[~equal]] = True
        new["multi"][mine[~equal]] = True
        t, m = theirs[equal], mine[equal]
        both = level["multi"][t] | new["multi"][m]
        level["multi"][t] = new["multi"][m] = both
        dl, dn, pl, pn = level["d"][t], new["d"][m], level["p"][t], new["p"][m]
        newer = (dn[:, 0] > dl[:, 0]) | (dn[:, 0] == dl[:, 0]) & ((dn[:, 1] > dl[:, 1]) | (dn[:, 1] == dl[:, 1]) & (pn >= pl))
        tied = (dn == dl).all(1) & (pn == pl)
        for side, at in ((new, m[newer & ~tied]), (level, t[~newer])):
            self.lost.append((side["d"][at], side["p"][at], side["n"][at]))
        gone_new, gone_level = np.zeros(len(new["g"]), bool), np.zeros(len(level["g"]), bool)
        gone_new[m[newer]] = True
        gone_level[t[~newer]] = True
        return {f: x[~gone_level] for f, x in level.items()}, {f: x[~gone_new] for f, x in new.items()}

    def several(self) -> np.ndarray:
        """The g of more than one stretch, sorted."""
        return np.unique(np.concatenate([x["g"][x["multi"]] for x in self.levels] or [np.zeros(0, np.uint64)]))


def _shard_of(g: np.ndarray, shards: int) -> np.ndarray:
    """Shards in the order of g: g's first 32 bits in equal ranges."""
    return ((g >> np.uint64(32)) * np.uint64(shards)) >> np.uint64(32)


def _blob(keys: np.ndarray, columns: dict[str, np.ndarray]) -> bytes:
    """Columns as bytes; d, an index into the rows of keys, with the keys that it uses."""
    used, d = np.unique(columns["d"], return_inverse=True)
    head = np.array([len(d), len(used)], np.int64).tobytes() + keys[used].tobytes()
    kinds = {"d": np.uint16 if len(used) < 1 << 16 else np.uint32, "p": np.uint32, "n": np.uint8, "multi": np.uint8, "g": np.uint64, "v": np.uint64, "e": np.uint32}
    return head + b"".join((d if f == "d" else columns[f]).astype(kinds[f]).tobytes() for f in columns)


def _unblob(raw: bytes, fields: tuple[str, ...]) -> dict[str, np.ndarray]:
    n, used = np.frombuffer(raw, np.int64, 2).tolist()
    at = 16 + 16 * used
    keys = np.frombuffer(raw, np.int64, 2 * used, 16).reshape(-1, 2)
    kinds = {"d": np.uint16 if used < 1 << 16 else np.uint32, "p": np.uint32, "n": np.uint8, "multi": np.uint8, "g": np.uint64, "v": np.uint64, "e": np.uint32}
    out = {}
    for f in fields:
        out[f] = np.frombuffer(raw, kinds[f], n, at)
        at += out[f].nbytes
    out |= {"e": out["e"].astype(np.int64)} if "e" in fields else {}
    return out | {"d": keys[out["d"]], "p": out["p"].astype(np.int64)} | ({"n": out["n"].astype(np.int64), "multi": out["multi"] > 0} if "n" in fields else {})


#: Kinds of rows: a batch's part for a shard; a document's spans; the name of a file with a shard's g of several stretches.
PART, SPANS, FILE = 0, 1, 2
_ROWS = pa.schema([("kind", pa.int8()), ("shard", pa.int32()), ("key", pa.int64()), ("hash", pa.int64()), ("data", pa.binary())])
_DDL = "kind byte, shard int, key long, hash long, data binary"


def _spans(d: np.ndarray, p: np.ndarray, n: np.ndarray, shards: int) -> pa.RecordBatch:
    """A row per shard with the spans of its documents, joined where they meet; d has rows (key, hash)."""
    if not len(d):
        return packed([], _ROWS)
    bucket = d[:, 1] % shards
    by = np.lexsort((p, d[:, 1], d[:, 0], bucket))
    d, p, end, bucket = d[by], p[by], (p + n + WINDOW - 1)[by], bucket[by]
    new = np.r_[True, (d[1:] != d[:-1]).any(1)]
    # one axis for all documents
    at = np.cumsum(new) << 34
    upto = np.maximum.accumulate(at + end)
    first = np.flatnonzero(np.r_[True, (at + p)[1:] > upto[:-1]])
    last = np.r_[first[1:], len(p)] - 1
    own = np.flatnonzero(new)
    keys, which = d[own], (np.cumsum(new) - 1)[first]
    columns = {"d": which, "p": p[first], "e": upto[last] - at[first]}
    cut = np.searchsorted(bucket[first], np.arange(shards + 1))
    rows = [(SPANS, i, 0, 0, _blob(keys, {f: x[cut[i] : cut[i + 1]] for f, x in columns.items()})) for i in range(shards) if cut[i + 1] > cut[i]]
    return packed(rows, _ROWS)


def _by_document(batches):
    """The spans of each document of a shard, as (start, end) in 32 bits."""
    held = [_unblob(raw.as_py(), ("d", "p", "e")) for batch in batches for raw in batch.column(4)]
    schema = pa.schema([("key", pa.int64()), ("hash", pa.int64()), ("spans", pa.binary())])
    if not held:
        return
    d, p, e = (np.concatenate([h[f] for h in held]) for f in ("d", "p", "e"))
    by = np.lexsort((p, d[:, 1], d[:, 0]))
    d, p, e = d[by], p[by], e[by]
    first = np.flatnonzero(np.r_[True, (d[1:] != d[:-1]).any(1)])
    ends = np.stack([p, e], 1).astype(np.int32)
    for i in range(0, len(first), 10_000):
        some = np.r_[first, len(d)][i : i + 10_001]
        offsets = ((some - some[0]) * 8).astype(np.int32)
        data = pa.BinaryArray.from_buffers(pa.binary(), len(some) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(ends[some[0] : some[-1]].tobytes())])
        yield pa.RecordBatch.from_arrays([pa.array(d[some[:-1], 0]), pa.array(d[some[:-1], 1]), data], schema=schema)


def _parts(batches):
    """Of sorted rows, the spans as they are (None, batch), and each part as (shard, bytes)."""
    for batch in batches:
        own = batch.column(0).to_numpy() == PART
        if not own.all():
            yield None, batch.filter(pa.array(~own))
        for i in np.flatnonzero(own).tolist():
            yield batch.column(1)[i].as_py(), batch.column(4)[i].as_py()


def _batches(batches):
    """(keys, data, begin) of batches of at most BATCH bytes; keys has a row (key, hash) for each text."""
    for batch in batches:
        keys = np.stack([batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)], 1)
        data, begin = flat(batch.column(2))
        # as ids order texts by index below, the texts go in the order of their keys
        for first, last in runs(begin, BATCH):
            a, z = int(begin[first]), int(begin[last])
            yield keys[first:last], data[a:z], begin[first : last + 1] - a
            give_back()


def _ordered(keys: np.ndarray) -> np.ndarray:
    """For each text its place in the order of keys; equal keys have equal places."""
    _, place = np.unique(keys, axis=0, return_inverse=True)
    return place.reshape(-1)


def _index(shards: int):
    def run(batches):
        for keys, data, begin in _batches(batches):
            place = _ordered(keys)
            back = np.zeros(len(keys), np.int64)
            back[place] = np.arange(len(keys))
            r = records(data, begin)
            r["d"] = place[r["d"]]
            by = np.lexsort((r["p"], r["d"], r["v"], r["g"]))
            r = {f: x[by] for f, x in r.items()}
            unique = keys[back]
            first, same, several = own_repeats(r)
            again = ~first & ~same
            yield _spans(unique[r["d"][again]], r["p"][again], r["n"][again], shards)
            # one record for each g: its only stretch, or that it has several
            head = np.flatnonzero(first & np.r_[True, r["g"][1:] != r["g"][:-1]]) if len(first) else np.zeros(0, np.int64)
            sent = {f: x[head] for f, x in r.items()} | {"multi": several[head]}
            sent["v"] = np.where(sent["multi"], mix(sent["v"] + sent["d"].astype(np.uint64) + np.uint64(keys[0, 1] & 0xFFFFFFFF)), sent["v"])
            shard = _shard_of(sent["g"], shards)
            at = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            del r, first, same, several, again
            rows = [(PART, i, int(keys[0, 0]), int(keys[0, 1]), _blob(unique, {f: sent[f][at[i] : at[i + 1]] for f in FIELDS})) for i in range(shards) if at[i + 1] > at[i]]
            if rows:
                yield packed(rows, _ROWS)

    return run


def _merge(folder: str, shards: int):
    """Runs the family of each shard over its batches; spans of what is lost, and the g of several stretches in a file."""

    def run(batches):
        shard, family = None, Family()

        def end():
            if family.lost:
                yield _spans(*(np.concatenate(x) for x in zip(*family.lost, strict=True)), shards)
            family.lost = []
            if len(g := family.several()):
                family.levels = []
                yield packed([(FILE, shard, len(g), 0, save_array(folder, g).encode())], _ROWS)

        for i, raw in _parts(batches):
            if i is None:
                yield raw
                continue
            if i != shard:
                yield from end()
                shard, family = i, Family()
                give_back()
            family.add(_unblob(raw, FIELDS))
        yield from end()

    return run


def _windows(shards: int, files: list[tuple[int, str]], index_shards: int):
    """The windows of records whose g has several stretches, as blobs for the shards of their fingerprints."""
    known = dict(files)

    def several(g: np.ndarray) -> np.ndarray:
        out, shard = np.zeros(len(g), bool), _shard_of(g, index_shards)
        at = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]) if len(g) else []
        for a, z in zip(at, [*at[1:], len(g)], strict=True):
            if (uri := known.get(int(shard[a]))) is not None:
                have = load_array(uri)
                i = np.minimum(np.searchsorted(have, g[a:z]), len(have) - 1)
                out[a:z] = have[i] == g[a:z]
        return out

    def run(batches):
        for keys, data, begin in _batches(batches):
            place = _ordered(keys)
            back = np.zeros(len(keys), np.int64)
            back[place] = np.arange(len(keys))
            unique = keys[back]
            r = records(data, begin)
            some = several(r["g"])
            r = {f: x[some] for f, x in r.items()}
            own = r["d"]
            r["d"] = place[own]
            by = np.lexsort((r["p"], r["d"], r["v"], r["g"]))
            r, own = {f: x[by] for f, x in r.items()}, own[by]
            first, same, _ = own_repeats(r)
            again = ~first & ~same
            yield _spans(unique[r["d"][again]], r["p"][again], r["n"][again], shards)
            r, own = {f: x[first] for f, x in r.items()}, own[first]
            d, p = np.repeat(r["d"], r["n"]), np.repeat(r["p"], r["n"]) + np.arange(r["n"].sum()) - np.repeat(np.cumsum(r["n"]) - r["n"], r["n"])
            at = begin[np.repeat(own, r["n"])] + p
            w = np.zeros(len(p), np.uint64)
            order = np.argsort(at)
            at = at[order]
            d, p = d[order], p[order]
            for a in range(0, len(data), PIECE):  # the prefix hash piece by piece
                i, j = np.searchsorted(at, [a, a + PIECE])
                if i < j:
                    s = prefix_hash(data[a : a + PIECE + WINDOW])
                    w[i:j] = span_hash(s, at[i:j] - a, at[i:j] - a + WINDOW)
            by = np.lexsort((p, d, w))
            w, d, p = w[by], d[by], p[by]
            first = np.r_[True, w[1:] != w[:-1]] if len(w) else np.zeros(0, bool)
            head = np.flatnonzero(first)[np.cumsum(first) - 1] if len(w) else np.zeros(0, np.int64)
            again = (d != d[head]) | (p != p[head])
            yield _spans(unique[d[again]], p[again], np.ones(again.sum(), np.int64), shards)
            w, d, p = w[first], d[first], p[first]
            shard = _shard_of(w, shards)
            cut = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
            rows = [(PART, i, int(keys[0, 0]), int(keys[0, 1]), _blob(unique, {"g": w[cut[i] : cut[i + 1]], "d": d[cut[i] : cut[i + 1]], "p": p[cut[i] : cut[i + 1]]})) for i in range(shards) if cut[i + 1] > cut[i]]
            if rows:
                yield packed(rows, _ROWS)

    return run


def _later(shards: int):
    """Of the windows of each shard, all but the first of those with one fingerprint."""

    def run(batches):
        shard, held, n = None, [], 0

        def reduced():
            x = {f: np.concatenate([h[f] for h in held]) for f in ("g", "d", "p")}
            by = np.lexsort((x["p"], x["d"][:, 1], x["d"][:, 0], x["g"]))
            x = {f: v[by] for f, v in x.items()}
            first = np.r_[True, x["g"][1:] != x["g"][:-1]]
            head = np.flatnonzero(first)[np.cumsum(first) - 1]
            again = (x["d"] != x["d"][head]).any(1) | (x["p"] != x["p"][head])
            return {f: v[first] for f, v in x.items()}, _spans(x["d"][again], x["p"][again], np.ones(again.sum(), np.int64), shards)

        for i, raw in _parts(batches):
            if i is None:
                yield raw
                continue
            if i != shard or n > 2_000_000:
                if held:
                    kept, spans = reduced()
                    yield spans
                    held, n = ([kept], 0) if i == shard else ([], 0)
                shard = i
            held.append(_unblob(raw, ("g", "d", "p")))
            n += len(held[-1]["g"])
        if held:
            yield reduced()[1]

    return run


def merged(spans: np.ndarray, n: int) -> np.ndarray:
    """Maximal runs of the spans (start, end), touching ones joined, in order."""
    if not len(spans):
        return np.zeros((0, 2), np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")].astype(np.int64)
    upto = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.r_[True, spans[1:, 0] > upto[:-1]])
    return np.stack([spans[first, 0], np.minimum(upto[np.r_[first[1:] - 1, len(spans) - 1]], n)], 1)


def remove_repeats(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", carry: list[str] | None = None, with_text: bool = False, batch_shard: int = SHARD) -> DataFrame:
    """One row per row of docs: doc_id, n_bytes, n_removed, n_spans, kept_sha256, the columns carry and, if asked for, kept_text.

    A byte goes if a WINDOW-byte string that covers it also starts earlier: in a text of a smaller doc_id, or further
    left in the same text. Null text is empty, a null doc_id the smallest. Rows with one doc_id and one text are the same
    document and lose the same bytes; different texts under one doc_id are ordered by a hash. Texts shorter than WINDOW
    keep all; an empty table gives no rows. kept_text is the rest as text, without the parts of characters that a cut
    leaves. Columns in carry with the names of the new ones are replaced by those.
    """
    spark = docs.sparkSession
    made = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())] + [("kept_text", pa.string())] * with_text
    carry = [c for c in carry or [] if c not in dict(made)]
    rows = docs.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NONE)).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"), *[F.col(f"`{c}`").alias(f"carry_{c}") for c in carry], F.col(doc_id).isNull().alias("none"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    narrow = rows.select("key", "hash", "text")
    shards = max(1, math.ceil((rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) / batch_shard))
    files = scratch(spark, "several")

    def by_shard(df: DataFrame) -> DataFrame:
        return df.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "kind", "key", "hash")

    levels = table(by_shard(narrow.mapInArrow(_index(shards), _DDL)).mapInArrow(_merge(files, shards), _DDL), "levels")
    found = [(r.shard, bytes(r.data).decode()) for r in levels.filter(F.col("kind") == FILE).select("shard", "data").collect()]
    windows = by_shard(narrow.mapInArrow(_windows(shards, found, shards), _DDL)).mapInArrow(_later(shards), _DDL)
    spans = levels.filter(F.col("kind") == SPANS).unionByName(windows).repartitionById(shards, F.col("shard")).mapInArrow(_by_document, "key long, hash long, spans binary")
    extra = [f for f in rows.schema if f.name.startswith("carry_")]
    both = rows.join(spans, ["key", "hash"], "left").select("key", "none", "text", "spans", *[f.name for f in extra])
    schema = pa.schema(made)

    def run(batches):
        for batch in batches:
            out = []
            for key, none, raw, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), batch.column(3), strict=True):
                raw = raw.as_py()
                gone = merged(np.frombuffer(spans.as_py() or b"", np.int32).reshape(-1, 2), len(raw))
                kept, at = [], 0
                for a, z in gone.tolist():
                    kept.append(raw[at:a])
                    at = z
                rest = b"".join([*kept, raw[at:]])
                out.append((None if none else key, len(raw), len(raw) - len(rest), len(gone), hashlib.sha256(rest).hexdigest(), *([rest.decode(errors="ignore")] * with_text)))
            done = packed(out, schema)
            yield pa.RecordBatch.from_arrays([*done.columns, *batch.columns[4:]], names=[*schema.names, *batch.schema.names[4:]])

    ddl = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept_text string" * with_text
    ddl += "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in extra)
    done = both.mapInArrow(run, ddl)
    return done.select(*[n for n, _ in made], *[F.col(f"`{f.name}`").alias(f.name.removeprefix("carry_")) for f in extra])


def op6_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
