"""SentencePiece BPE (5): encoding by vectorised merge rounds over flat symbol arrays, and decoding."""

from __future__ import annotations

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed

#: Symbols of a word up to which it takes part in the vectorised rounds; longer ones use a heap, whose time doesn't grow with the square.
LONG = 200
#: Symbols in one set of rounds, and words kept with their ids.
AT_ONCE, KEPT = 400_000, 600_000
#: A line break, spaces with what follows them, or spaces at the end of a line.
WORD = re.compile(r"\n| *[^ \n]+| +")
_loaded: dict[str, Pieces] = {}


class Pieces:
    """A BPE model with byte fallback, identity normalisation and one added leading space, as the sentencepiece library runs it."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.unknown = sp.unk_id()
        self.piece = {sp.id_to_piece(i): i for i in plain}
        # by falling score; pieces of equal score are of equal rank, and the leftmost pair goes first
        scores = sorted({-sp.get_score(i) for i in plain})
        rank_of = {x: r for r, x in enumerate(scores)}
        rank = {i: rank_of[-sp.get_score(i)] for i in plain}
        self.byte = np.full(256, -1, np.int64)
        self.text: list[bytes] = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                self.byte[int(sp.id_to_piece(i)[3:-1], 16)] = i
                self.text[i] = bytes([int(sp.id_to_piece(i)[3:-1], 16)])
            elif i == self.unknown:
                self.text[i] = " ⁇ ".encode()
            elif not sp.is_control(i):
                self.text[i] = sp.id_to_piece(i).replace("▁", " ").encode()
        if (self.byte < 0).any():
            raise ValueError("the model has no byte fallback")
        left, right, merged = [], [], []
        for p, i in self.piece.items():
            for k in range(1, len(p)):
                a, b = self.piece.get(p[:k]), self.piece.get(p[k:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(i)
        key = np.array(left, np.int64) * (n + 1) + np.array(right, np.int64)
        by = np.argsort(key)
        self.n, self.pairs, self.merged, self.none = n, key[by], np.array(merged, np.int64)[by], len(scores)
        self.ranks = np.array([rank[i] for i in self.merged.tolist()], np.int64)
        bad = [p for p in self.piece if "▁" in p.lstrip("▁") or "\n" in p]
        single = {p for p in self.piece if len(p) == 1}
        if bad or any(c not in single for p in self.piece for c in p):
            raise ValueError("pieces cross words, or hold characters that aren't pieces")
        self.pair = {divmod(k, n + 1): (r, m) for k, r, m in zip(self.pairs.tolist(), self.ranks.tolist(), self.merged.tolist(), strict=True)}
        self.ids_of: dict[str, str] = {}
        self.text_of: dict[str, bytes] = {}

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of the piece that two symbols make, or none; symbols outside the vocabulary are n."""
        key = a * (self.n + 1) + b
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        return np.where(self.pairs[at] == key, self.ranks[at], self.none)

    def rounds(self, symbols: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Merges until no pair remains. symbols lie word by word; returns (symbols, their words, original places).

        In each round every word merges the leftmost of its pairs of least rank, all words at once; then the arrays
        close up. Words without a pair leave the arrays.
        """
        place = np.arange(len(symbols))
        done: list[tuple[np.ndarray, ...]] = []
        rank = np.full(len(symbols), self.none, np.int64)
        near = np.flatnonzero(word[1:] == word[:-1])
        rank[near] = self.rank(symbols[near], symbols[near + 1])
        while len(symbols):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            sizes = np.diff(np.r_[first, len(symbols)])
            # rank and place in one number: the least is the leftmost of the least
            best = np.minimum.reduceat(rank * len(symbols) + np.arange(len(symbols)), first)
            live = best // len(symbols) < self.none
            if not live.all():
                over = np.repeat(~live, sizes)
                done.append((symbols[over], word[over], place[over]))
                if not live.any():
                    break
            at = best[live] % len(symbols)
            symbols[at] = self.merged[np.searchsorted(self.pairs, symbols[at] * (self.n + 1) + symbols[at + 1])]
            keep = np.repeat(live, sizes)
            keep[at + 1] = False
            at = np.cumsum(keep)[at] - 1
            symbols, word, place, rank = symbols[keep], word[keep], place[keep], rank[keep]
            # only the pairs with a merged symbol are new
            rank[at] = self.none
            for left in (at - 1, at):
                left = left[(left >= 0) & (left + 1 < len(symbols))]
                left = left[word[left] == word[left + 1]]
                rank[left] = self.rank(symbols[left], symbols[left + 1])
        if not done:
            return symbols, word, place
        symbols, word, place = (np.concatenate(x) for x in zip(*done, strict=True))
        by = np.argsort(place, kind="stable")
        return symbols[by], word[by], place[by]

    def by_heap(self, symbols: list[int]) -> list[tuple[int, int]]:
        """The same for one long word: (symbol, original place)."""
        n = len(symbols)
        before, after, symbols = [i - 1 for i in range(n)], [i + 1 for i in range(n)], list(symbols)
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            if i >= 0 and j < n and (found := self.pair.get((symbols[i], symbols[j]))) is not None:
                heapq.heappush(heap, (found[0], i, symbols[i], symbols[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, a, b, both = heapq.heappop(heap)
            j = after[i]
            if symbols[i] != a or j >= n or symbols[j] != b:
                continue
            symbols[i], symbols[j], after[i] = both, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [(s, i) for i, s in enumerate(symbols) if s >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each word; a word has spaces only at its start."""
        out: list[list[int]] = [[]] * len(words)
        short: list[int] = []
        n = 0
        for i, w in enumerate(words):
            if len(w) > LONG:
                w = w.replace(" ", "▁")
                out[i] = self._ids(w, self.by_heap([self.piece.get(c, self.n) for c in w]))
                continue
            short.append(i)
            n += len(w)
            if n >= AT_ONCE:
                self._rounds(words, short, out)
                short, n = [], 0
        if short:
            self._rounds(words, short, out)
        return out

    def _rounds(self, words: list[str], some: list[int], out: list[list[int]]) -> None:
        joined = "".join([words[i] for i in some]).replace(" ", "▁")
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        chars, index = np.unique(points, return_inverse=True)
        symbols = np.array([self.piece.get(chr(c), self.n) for c in chars], np.int64)[index]
        word = np.repeat(np.arange(len(some)), [len(words[i]) for i in some])
        symbols, word, place = self.rounds(symbols, word)
        if (symbols == self.n).any():
            self._with_bytes(joined, symbols, word, place, some, out)
            return
        at = np.searchsorted(word, np.arange(len(some) + 1))
        flat = symbols.tolist()
        for k, i in enumerate(some):
            out[i] = flat[at[k] : at[k + 1]]

    def _with_bytes(self, joined, symbols, word, place, some, out) -> None:
        for i in some:
            out[i] = []
        for s, w, p in zip(symbols.tolist(), word.tolist(), place.tolist(), strict=True):
            out[some[w]] += [s] if s != self.n else self.byte[list(joined[p].encode("utf-8", "surrogatepass"))].tolist()

    def _ids(self, text: str, found: list[tuple[int, int]]) -> list[int]:
        ids: list[int] = []
        for s, p in found:
            ids += [s] if s != self.n else self.byte[list(text[p].encode("utf-8", "surrogatepass"))].tolist()
        return ids

    def decode_bytes(self, ids: list[int]) -> bytes:
        return b"".join([self.text[i] for i in ids])

    def words(self, text: str) -> list[str]:
        return WORD.findall(" " + text.replace("▁", " ")) if text else []

    def learn(self, texts: list[list[str]]) -> None:
        """Encodes and decodes the words that aren't known yet."""
        all_words = set().union(*texts)
        new = [w for w in all_words if w not in self.ids_of]
        if len(self.ids_of) + len(new) > KEPT:
            self.ids_of.clear()
            self.text_of.clear()
            new = list(all_words)
        for w, ids in zip(new, self.encode_words(new), strict=True):
            self.ids_of[w] = ",".join(map(str, ids))
            self.text_of[w] = self.decode_bytes(ids)


def decoded(raw: bytes) -> bytes:
    """The pieces' bytes as decode() returns them: without the added space, and each invalid byte as U+FFFD."""
    raw = raw[1:] if raw[:1] == b" " else raw
    return _replace(raw)


def _replace(raw: bytes) -> bytes:
    try:
        raw.decode()
        return raw
    except UnicodeDecodeError:
        return raw.decode(errors="replace").encode()


def pieces(path: str) -> Pieces:
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


def encode(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """One row per row of docs: doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids (array of int) and decoded.

    Whole texts are encoded without begin or end ids. A null text is empty: no ids, and an empty decoded text. Repeated
    rows and null ids stay as they are; an empty table gives no rows; other columns aren't read.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    if with_ids:
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]
        ddl += ", ids array<int>, decoded string"
    schema = pa.schema(fields)

    def run(batches):
        model = pieces(path)
        for batch in batches:
            keys, rows, n, some = batch.column(0).to_pylist(), [], 0, []
            for key, one in zip(keys, batch.column(1), strict=True):
                t = one.as_py() or ""
                some.append((key, model.words(t)))
                n += len(t)
                if n > 4_000_000:
                    rows += _scored(model, some, with_ids)
                    n, some = 0, []
            rows += _scored(model, some, with_ids)
            yield packed(rows, schema)

    return docs.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, ddl)


def _scored(model: Pieces, some: list[tuple], with_ids: bool) -> list[tuple]:
    model.learn([ws for _, ws in some])
    rows = []
    for key, ws in some:
        ids = ",".join([model.ids_of[w] for w in ws])
        text = decoded(b"".join([model.text_of[w] for w in ws]))
        row = (key, ids.count(",") + 1 if ids else 0, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text).hexdigest())
        rows.append(row + (([int(x) for x in ids.split(",")] if ids else [], text.decode()) if with_ids else ()))
    return rows


def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
