"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a pre-token there is exactly one last token of its encoding. A suffix
automaton over the vocabulary (Aho-Corasick) lists the tokens that end at each position;
a token is the last one of the prefix if what precedes it is empty, or if it is compatible
with the last token of the prefix before it: merging their bytes from scratch never joins
across the border between them. Back-pointers then give the ids. The result is the ids
of greedy merging, in time linear in the text for any pre-token length.

The tokenizer file (byte-level BPE) is a parameter; every Python worker builds the tables
once and keeps the ids of the short pre-tokens it has met in a dictionary of up to
``MEMO_BYTES`` (a memo only: what is not in it is encoded anew), dropped when a task ends. A full
memo keeps what the batch at hand uses, which is mostly the frequent ones.
A very long text, or one unbroken run of letters, is encoded whole.

Defined results: null text encodes as ''; special tokens of the file that occur in a text
become their ids and decode to their strings, as the tokenizers library does by default;
ids may be null or repeated; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import json
import re
import threading
from array import array
from collections.abc import Iterator
from pathlib import Path

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import slices, text_bytes

# White_Space of Unicode as a character class; Python's own \s also takes U+001C to U+001F.
SPACE = r"\t-\r \x85\xa0  -     　"
# Fixed value: the published split pattern of byte-level BPE, with \s written out.
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^" + SPACE + r"\p{L}\p{N}]+"
           r"|[" + SPACE + r"]+(?![^" + SPACE + r"])|[" + SPACE + r"]+")
# The pattern never joins what stands before the last white space of a run with what
# stands after it, so texts are first cut there by a cheaper pattern.
CHUNKS = re.compile(r"\s?\S+|\s+(?=\s\S)|\s+")
ODD_SPACE = re.compile("[\x1c-\x1f]")

MEMO_BYTES = 48 << 20
MEMO_CHARS = 64  # longer ones are not kept
MEMO_ENTRY = 200  # bytes of two small objects and their place in the dictionary
PAIRS = 300_000
NEVER = 1 << 40
START = 1 << 19  # stands for the start of a word in place of a token


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte: itself if printable, else the next letter from U+0100."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class BpeTables:
    """Vocabulary, merge order and suffix automaton of a byte-level BPE tokenizer file."""

    def __init__(self, path: str):
        spec = json.loads(Path(path).read_text("utf-8"))
        model, letters = spec["model"], byte_letters()
        if model["type"] != "BPE" or model.get("dropout") or model.get("ignore_merges") or spec.get("normalizer"):
            raise ValueError("only plain byte-level BPE files are supported")
        raw = lambda token: bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw(t): i for t, i in model["vocab"].items() if t not in self.special}
        self.bytes = {i: b for b, i in ids.items()} | {i: t.encode() for t, i in self.special.items()}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(ids[raw(a)], ids[raw(b)]): r for r, (a, b) in reversed(list(enumerate(pairs)))}
        made: dict[int, tuple[int, int]] = {}
        for (a, b), _ in sorted(self.rank.items(), key=lambda x: x[1]):
            made.setdefault(ids[self.bytes[a] + self.bytes[b]], (a, b))
        # Each token's border nodes, innermost first, with the rank at which each is merged
        # into the next; a spine ends in the token itself, which nothing merges.
        self._left: dict[int, tuple[list[int], list[int]]] = {}
        self._right: dict[int, tuple[list[int], list[int]]] = {}
        reachable = {i for b, i in ids.items() if len(b) == 1}
        for i in reachable:
            self._left[i] = self._right[i] = ([i], [NEVER])
        for token, (a, b) in made.items():  # by rank: parts come before what they make
            if a not in reachable or b not in reachable:
                continue
            r = self.rank[(a, b)]
            (la, ra), (lb, rb) = self._left[a], self._right[b]
            self._left[token] = (la + [token], ra[:-1] + [r, NEVER])
            self._right[token] = (lb + [token], rb[:-1] + [r, NEVER])
            if self._first_join(a, b) == (a, b):
                reachable.add(token)
        self.automaton = ahocorasick.Automaton()
        for i in reachable:
            self.automaton.add_word(self.bytes[i].decode("latin-1"), i)
        self.automaton.make_automaton()
        self._fit: dict[int, bool] = {}
        self.split = regex.compile(PATTERN)
        self.at_special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self.forget()
        self.length = [len(self.bytes.get(i, b"")) for i in range(max(self.bytes) + 1)]
        self._size = np.array(self.length)
        self._start = np.cumsum(self._size) - self._size
        self._flat = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(len(self.length))), dtype=np.uint8)

    def _first_join(self, a: int, b: int) -> tuple[int, int] | None:
        """The first pair that merging a's and b's bytes joins across their border, or None.
        Of equal ranks the one further left goes first."""
        (na, ra), (nb, rb) = self._right[a], self._left[b]
        i = j = 0
        while True:
            x, y = ra[i], rb[j]
            r = self.rank.get((na[i], nb[j]), NEVER)
            if r < x and r <= y and r < NEVER:
                return na[i], nb[j]
            if x == y == NEVER:
                return None
            if x <= y:
                i += 1
            else:
                j += 1

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of a and b, merged from scratch, stay these two tokens.
        Every token is compatible with the start of a word."""
        if len(self._fit) >= PAIRS:
            self._fit.clear()
        fit = self._fit[a << 20 | b] = a == START or self._first_join(a, b) is None
        return fit

    def encode_words(self, words: list[str]) -> list[bytes]:
        """Ids (little-endian 32-bit) of each pre-token. What a prefix's last token is does
        not depend on what follows, so words in sorted order share the start of the table."""
        raw = [w.encode("utf-8").decode("latin-1") for w in words]
        out, before, last = [b""] * len(raw), "", [START]
        length, known, compatible, matches = self.length, self._fit.get, self.compatible, self.automaton.iter
        for i in sorted(range(len(raw)), key=raw.__getitem__):
            word = raw[i]
            shared = 0
            for step in (8, 4, 2, 1):
                if word[:shared + step] == before[:shared + step] and len(word) >= shared + step <= len(before):
                    shared += step
            before = word
            last = last[:shared + 1] + [-1] * (len(word) - shared)  # by border: the last token up to there
            for end, token in matches(word):
                end += 1
                if last[end] < 0:
                    previous = last[end - length[token]]
                    if previous >= 0:
                        fit = known(previous << 20 | token)
                        if fit is None:
                            fit = compatible(previous, token)
                        if fit:
                            last[end] = token
            ids, at = array("i"), len(word)
            while at:
                token = last[at]
                ids.append(token)
                at -= length[token]
            ids.reverse()
            out[i] = ids.tobytes()
        return out

    def _learn(self, chunks: set[str]) -> None:
        """Add the ids of chunks to the memo, and those of the pre-tokens in them."""
        memo = self.memo
        mixed = {c: self.split.findall(c) for c in chunks if not (c.isalpha() or c[0] == " " and c[1:].isalpha())}
        words = {w for own in mixed.values() for w in own if w not in memo}
        words.update(c for c in chunks if c not in mixed)
        new = list(words)
        memo.update(zip(new, self.encode_words(new)))
        made = [c for c, own in mixed.items() if len(own) > 1]
        for c in made:
            memo[c] = b"".join(map(memo.__getitem__, mixed[c]))
        new += made
        self._long += [c for c in new if len(c) > MEMO_CHARS]
        self._held += sum(map(len, new)) + sum(len(memo[c]) for c in new) + MEMO_ENTRY * len(new)

    def forget(self) -> None:
        """Drop the memo."""
        self.memo: dict[str, bytes] = {}
        self._held, self._long = 0, []

    def _keep(self, chunks: set[str]) -> None:
        """Drop the memo but for what these chunks, of one batch, use; all of it if that is over half."""
        kept = {c: self.memo[c] for c in chunks if c in self.memo}
        held = sum(map(len, kept)) + sum(map(len, kept.values())) + MEMO_ENTRY * len(kept)
        self.forget()
        if held <= MEMO_BYTES // 2:
            self.memo, self._held = kept, held

    def _forget_long(self) -> None:
        for c in self._long:
            self._held -= len(c) + len(self.memo.pop(c)) + MEMO_ENTRY
        self._long = []

    def _cut(self, text: str) -> list[str]:
        return ([text] if text else []) if ODD_SPACE.search(text) else CHUNKS.findall(text)

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of each text, special tokens included."""
        cut = []  # per text: chunks, and ids (as bytes) of special tokens
        for text in texts:
            if self.at_special is None or not self.at_special.search(text):
                cut.append(self._cut(text))
            else:
                cut.append([x for i, p in enumerate(self.at_special.split(text))
                            for x in ([self.special[p].to_bytes(4, "little")] if i % 2 else self._cut(p))])
        if self._held > MEMO_BYTES:
            self._keep({c for own in cut for c in own})
        memo = self.memo
        new = {c for own in cut for c in own if c not in memo and not isinstance(c, bytes)}
        if new:
            self._learn(new)
        out = []
        for own in cut:
            try:
                ids = b"".join(map(memo.__getitem__, own))
            except KeyError:  # special tokens
                ids = b"".join(c if isinstance(c, bytes) else memo[c] for c in own)
            out.append(np.frombuffer(ids, dtype="<i4"))
        self._forget_long()
        return out

    def encode(self, text: str) -> np.ndarray:
        return self.encode_batch([text])[0]

    def decode(self, ids: np.ndarray) -> str:
        """Text of the ids; bytes that are no UTF-8 become U+FFFD."""
        size = self._size[ids]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        at = np.repeat(self._start[ids] - (ends - size), size) + np.arange(total)
        return self._flat[at].tobytes().decode("utf-8", "replace")


_tables: dict[str, BpeTables] = {}
_lock = threading.Lock()


def tables(path: str) -> BpeTables:
    """The file's tables, built once in a process."""
    with _lock:
        if path not in _tables:
            _tables[path] = BpeTables(path)
        return _tables[path]


def encode_decode(df: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: its id, ``ids`` (array of int) and ``decoded``, the text of these ids."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = tables(tokenizer)
        try:
            for b in slices(batches, 1):
                ids = bpe.encode_batch([t.as_py().decode("utf-8", "replace") for t in b.column(1)])
                ends = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
                flat = pa.array(np.concatenate(ids) if ids else np.empty(0, np.int32), pa.int32())
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(ends), flat),
                                                  pa.array(map(bpe.decode, ids), pa.string())], ["id", "ids", "decoded"])
        finally:
            bpe.forget()

    kind = df.schema[id_col].dataType.simpleString()
    out = df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, f"id {kind}, ids array<int>, decoded string")
    return out.select(F.col("id").alias(id_col), "ids", "decoded")


def ids_sha256(ids: Column) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by commas."""
    return F.sha2(F.array_join(ids.cast("array<string>"), ","), 256)
