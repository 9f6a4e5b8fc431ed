"""Byte-level BPE by rank files (tiktoken form): padded matrices, one merge a row and round.

Texts are split by a pattern; each distinct piece of a batch that is no token itself becomes
a row of a padded matrix of its length bucket. In each round every row merges its leftmost
pair of minimum rank: ranks of the pairs stand in a second matrix, a merge looks up only
the two pairs it makes (in a hashed table of all joinable pairs), and as each live row loses
one place, both matrices are compacted by one column. Rows without a joinable pair leave.

A piece beyond ``LONG`` bytes is one row folded into blocks of ``FOLD`` places, so that a
round reads a block and the blocks' minima, not the whole row; the merges are the same.

A batch holds about 4 MB of text, or one longer text. Ids of short pieces are kept for the
next batches up to ``MEMO_BYTES`` and dropped when the task ends. Defined results: null text encodes as ''; no special tokens
are known, their strings are plain text; bytes that are no UTF-8 are read as U+FFFD; a very
long text, or one unbroken run of letters, is encoded whole; ids may be null or repeated; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import threading
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprism.llm.bpe_dp import CHUNKS, ODD_SPACE, PATTERN, SPACE
from tabprism.llm.common import slices, text_bytes

NONE = np.int32(2**31 - 1)  # rank of a pair that makes no token
PAD = -1
WIDTHS = [*range(2, 17), 20, 24, 32, 48, 64, 96, 128, 192, 256]
LONG = WIDTHS[-1]
FOLD = 1024
CELLS = 1 << 21  # places of a matrix at once
MEMO_BYTES = 48 << 20  # ids of the latest short pieces, kept until the task ends
MEMO_CHARS = 64
MEMO_ENTRY = 200  # bytes of two small objects and their place in the dictionary
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def spelled_out(pattern: str) -> str:
    """The split pattern with white space as Unicode's property (Python's class has U+001C to U+001F too)."""
    return pattern.replace(r"[^\s", "[^" + SPACE).replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")


class PairTable:
    """Open-addressing table (left id, right id) -> rank of the token that both make."""

    def __init__(self, left: np.ndarray, right: np.ndarray, rank: np.ndarray):
        self.bits = max(4, int(4 * len(left)).bit_length())
        self.mask = (1 << self.bits) - 1
        self.keys = np.full(self.mask + 1, -1, dtype=np.int64)
        self.ranks = np.full(self.mask + 1, NONE, dtype=np.int32)
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):  # one free slot takes one of the keys that ask for it
            free = self.keys[at[todo]] < 0
            slots, first = np.unique(at[todo[free]], return_index=True)
            placed = todo[free][first]
            self.keys[slots], self.ranks[slots] = keys[placed], rank[placed]
            todo = np.setdiff1d(todo, placed, assume_unique=True)
            at[todo] = np.where(self.keys[at[todo]] >= 0, (at[todo] + 1) & self.mask, at[todo])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * MULTIPLIER) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE for pairs that make no token or have a padded place."""
        out = np.full(len(left), NONE, dtype=np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = left[todo].astype(np.int64) << 32 | right[todo]
        at = self._slot(keys)
        while len(todo):
            there = self.keys[at]
            hit = there == keys
            out[todo[hit]] = self.ranks[at[hit]]
            on = ~hit & (there >= 0)
            todo, keys, at = todo[on], keys[on], (at[on] + 1) & self.mask
        return out


class RankEncoder:
    """Tables of a rank file: lines of base64 token and rank, ranks being the ids."""

    def __init__(self, path: str, pattern: str = PATTERN):
        lines = (line.split() for line in Path(path).read_bytes().splitlines())
        self.ids = {base64.b64decode(x[0]): int(x[1]) for x in lines if len(x) == 2}
        missing = [b for b in range(256) if bytes([b]) not in self.ids]
        if missing:
            raise ValueError(f"the rank file lacks the single bytes {missing[:5]}")
        self.byte_id = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int32)
        joins = [(self.ids[t[:k]], self.ids[t[k:]], r) for t, r in self.ids.items() for k in range(1, len(t))
                 if t[:k] in self.ids and t[k:] in self.ids]
        self.pairs = PairTable(*(np.array(x, dtype=np.int32) for x in zip(*joins))) if joins else PairTable(*[np.empty(0, np.int32)] * 3)
        self.byte_pair = self.pairs.find(np.repeat(self.byte_id, 256), np.tile(self.byte_id, 256))
        self.chunked = spelled_out(pattern) in (PATTERN, spelled_out(PATTERN))  # white space may be cut beforehand
        self.split = regex.compile(spelled_out(pattern))
        self.forget()
        top = max(self.ids.values()) + 1
        tokens = [b""] * top
        for t, r in self.ids.items():
            tokens[r] = t
        self.tokens = tokens
        self._size = np.array([len(t) for t in tokens], dtype=np.int64)
        self._start = np.cumsum(self._size) - self._size
        self._flat = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    # ---- rounds ------------------------------------------------------------------------

    def _rounds(self, codes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of byte values padded with PAD; yields (row numbers, padded id rows) as rows get done."""
        real = codes >= 0
        sym = np.where(real, self.byte_id[codes], PAD).astype(np.int32)
        rank = np.where(real[:, 1:], self.byte_pair[(codes[:, :-1].astype(np.int32) << 8 | codes[:, 1:]) & 0xFFFF], NONE).astype(np.int32)
        row = np.arange(len(sym))
        while True:
            at = rank.argmin(axis=1) if rank.shape[1] else np.zeros(len(sym), dtype=np.int64)
            line = np.arange(len(sym))
            best = rank[line, at] if rank.shape[1] else np.full(len(sym), NONE)
            done = best == NONE
            if done.any():
                yield row[done], sym[done]
                live = ~done
                row, sym, rank, at, best = row[live], sym[live], rank[live], at[live], best[live]
                line = line[:len(row)]
            if not len(row):
                return
            sym[line, at] = best  # ranks are ids
            width = sym.shape[1]
            keep = np.ones(sym.shape, dtype=bool)
            keep[line, at + 1] = False
            sym = sym[keep].reshape(len(row), width - 1)
            keep = np.ones(rank.shape, dtype=bool)
            keep[line, at] = False
            rank = rank[keep].reshape(len(row), width - 2)
            for shift in (-1, 0):  # the pair before the new symbol, and the one it starts
                x = at + shift
                ok = np.flatnonzero((x >= 0) & (x < width - 2))
                rank[ok, x[ok]] = self.pairs.find(sym[ok, x[ok]], sym[ok, x[ok] + 1])

    def _folded(self, raw: bytes) -> np.ndarray:
        """Ids of one long piece: its row folded into blocks; dead places have rank NONE."""
        codes = np.frombuffer(raw, dtype=np.uint8)
        n = len(codes)
        sym = self.byte_id[codes]
        rank = np.full(-(-n // FOLD) * FOLD, NONE, dtype=np.int32)
        rank[:n - 1] = self.byte_pair[codes[:-1].astype(np.int32) << 8 | codes[1:]]
        blocks = rank.reshape(-1, FOLD)
        low = blocks.min(axis=1)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        tokens, ids, none = self.tokens, self.ids, int(NONE)

        def pair(x: int, y: int) -> int:
            return ids.get(tokens[sym[x]] + tokens[sym[y]], none) if y < n else none

        while True:
            b = int(low.argmin())
            best = low[b]
            if best == NONE:
                break
            p = b * FOLD + int(blocks[b].argmin())
            gone = int(after[p])
            then = int(after[gone])
            sym[p], sym[gone] = best, PAD
            after[p] = then
            if then < n:
                before[then] = p
            back = int(before[p])
            rank[gone] = NONE
            rank[p] = pair(p, then)
            if back >= 0:
                rank[back] = pair(back, p)
            for i in {p // FOLD, gone // FOLD, max(back, 0) // FOLD}:
                low[i] = blocks[i].min()
        return sym[sym >= 0].astype("<i4")

    def encode_pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each piece."""
        out: list[bytes] = [b""] * len(pieces)
        size = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        order = np.argsort(size, kind="stable")
        for i in order[np.searchsorted(size[order], LONG, "right"):]:
            out[i] = self._folded(pieces[i]).tobytes()
        low = 0
        for width in WIDTHS:
            high = int(np.searchsorted(size[order], width, "right"))
            for at in range(low, high, max(1, CELLS // width)):
                own = order[at:min(high, at + max(1, CELLS // width))]
                there = np.arange(width) < size[own][:, None]
                codes = np.full(there.shape, PAD, dtype=np.int16)
                codes[there] = np.frombuffer(b"".join([pieces[i] for i in own]), dtype=np.uint8)
                for row, ids in self._rounds(codes):
                    there = ids >= 0
                    ends = 4 * np.cumsum(there.sum(axis=1))
                    flat, start = ids[there].astype("<i4").tobytes(), 0
                    for i, end in zip(own[row].tolist(), ends.tolist()):
                        out[i] = flat[start:end]
                        start = end
            low = high
        return out

    # ---- texts ---------------------------------------------------------------------------

    def _cut(self, text: str) -> list[str]:
        if not self.chunked or ODD_SPACE.search(text):
            return self.split.findall(text)
        return CHUNKS.findall(text)

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self._cut(t) for t in texts]
        chunks = set().union(*cut) if cut else set()
        if self._held > MEMO_BYTES:
            self.forget()
        chunks.difference_update(self._memo)
        plain = {c for c in chunks if c.isalpha() or c[0] == " " and c[1:].isalpha()}  # one match of the pattern
        mixed = {c: self.split.findall(c) for c in chunks.difference(plain)}
        words = list(plain.union(*mixed.values()))
        raw = list(map(str.encode, words))
        whole = list(map(self.ids.get, raw))
        rest = [i for i, x in enumerate(whole) if x is None]
        known = {w: x.to_bytes(4, "little") for w, x in zip(words, whole) if x is not None}
        known.update(zip([words[i] for i in rest], self.encode_pieces([raw[i] for i in rest])))
        new = {c: known[c] for c in plain} | {c: b"".join([known[p] for p in own]) for c, own in mixed.items()}
        memo = self._memo
        memo |= new
        out = [b"".join([memo[c] for c in own]) for own in cut]
        for c in [c for c in new if len(c) > MEMO_CHARS]:
            del memo[c], new[c]
        self._held += sum(map(len, new)) + sum(map(len, new.values())) + MEMO_ENTRY * len(new)
        return out

    def forget(self) -> None:
        """Drop the memo; what is not in it is encoded anew."""
        self._memo, self._held = {}, 0

    def decode(self, ids: bytes) -> bytes:
        """Bytes of the ids."""
        own = np.frombuffer(ids, dtype="<u4").astype(np.int64)
        size = self._size[own]
        ends = np.cumsum(size)
        at = np.repeat(self._start[own] - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        return self._flat[at].tobytes()


_encoders: dict[tuple[str, str], RankEncoder] = {}
_lock = threading.Lock()


def encoder(path: str, pattern: str = PATTERN) -> RankEncoder:
    """The file's tables, built once in a process."""
    with _lock:
        if (path, pattern) not in _encoders:
            _encoders[path, pattern] = RankEncoder(path, pattern)
        return _encoders[path, pattern]


def encode_decode(df: DataFrame, ranks: str, pattern: str = PATTERN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, ``n_tokens``, ``ids`` (little-endian unsigned 32-bit, binary) and
    ``decoded``, the bytes of these ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(ranks, pattern)
        try:
            for b in slices(batches, 1):
                ids = own.encode_batch([t.as_py().decode("utf-8", "replace") for t in b.column(1)])
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                                                  pa.array(map(own.decode, ids), pa.binary())], ["id", "n_tokens", "ids", "decoded"])
        finally:
            own.forget()

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, f"id {kind}, n_tokens long, ids binary, decoded binary")
    return out.select(F.col("id").alias(id_col), "n_tokens", "ids", "decoded")
