"""Token-id shards on shared storage with keyed access by minimal perfect hashing.

Documents, range-partitioned and sorted by id, become one payload file per task: raw
little-endian ids (2 bytes each if the vocabulary allows, else 4), one document after the
other, and a file of row ends. The index is cut into buckets by key hash. A bucket's
minimal perfect hash (levels of collision-free bits, ranked by popcount) numbers its keys;
the slot holds a 32-bit fingerprint, which turns absent keys away, and the places of the
key: shard, first row, number of rows. So any key is found with one bucket file, one slot
and one seek, whatever the corpus holds.

All files lie under the folder of ``spark.checkpoint.dir`` and are named by task attempt;
the manifest, a checkpoint, names only those of attempts that succeeded. What a lost
executor leaves half written is never read.

Defined results: null text = no ids but the end id; ids may be null (they come first, and
null is a key like any other) or repeated (all rows of a key are found; rows of one id are
ordered by a hash of their text); an empty table gives an empty index; other columns are
ignored.
"""

from __future__ import annotations

import io
import json
import os
import re
import threading
import uuid
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprism.llm.bpe_dp import byte_letters
from tabprism.llm.common import checkpoint, partitions_for, shared_folder, slices, text_bytes

SHARD_BYTES = 64 << 20
KEYS_PER_BUCKET = 200_000
SMALL_TABLE_ROWS = 200_000
GAMMA = 2.0
MEMO = 900_000
ODD_SPACE = re.compile("[\x1c-\x1f]")
NOT_LATIN = re.compile("[^\x00-\u024f]")


# ---- minimal perfect hash --------------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
    return (_mix(a + _mix(b + np.uint64(level * 2 + 1))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Numbers n distinct 128-bit keys (a, b) from 0 to n - 1. A level is a bit field of
    about ``GAMMA`` bits per key left; keys alone on their bit stay, others go on."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray, ranks: np.ndarray):
        self.sizes, self.bits, self.ranks = sizes, bits, ranks
        self.starts = np.cumsum(sizes) - sizes

    @classmethod
    def build(cls, a: np.ndarray, b: np.ndarray) -> PerfectHash:
        sizes, fields = [], []
        while len(a):
            size = max(64, int(len(a) * GAMMA) // 64 * 64)
            at = _place(a, b, len(sizes), size)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            fields.append(alone)
            rest = ~alone[at]
            a, b = a[rest], b[rest]
        flat = np.concatenate(fields) if fields else np.zeros(0, dtype=bool)
        words = np.packbits(flat, bitorder="little").view("<u8")
        ranks = np.cumsum(np.bitwise_count(words), dtype=np.int64) - np.bitwise_count(words)
        return cls(np.array(sizes, dtype=np.int64), words, ranks)

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The number of each key; for keys that are not in the set, -1 or any number."""
        out = np.full(len(a), -1, dtype=np.int64)
        left = np.arange(len(a))
        for level, (size, start) in enumerate(zip(self.sizes.tolist(), self.starts.tolist())):
            if not len(left):
                break
            at = start + _place(a[left], b[left], level, size)
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = word & ((np.uint64(1) << bit) - np.uint64(1))
            out[left[hit]] = self.ranks[at[hit] >> 6] + np.bitwise_count(below[hit])
            left = left[~hit]
        return out


def _fingerprint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (_mix(b ^ _mix(a)) >> np.uint64(32)).astype(np.uint32)


class Bucket:
    """One bucket of the index: perfect hash, fingerprints, and each slot's places."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.hash = PerfectHash(arrays["sizes"], arrays["bits"], arrays["ranks"])
        self.prints, self.ends, self.places = arrays["prints"], arrays["ends"], arrays["places"]

    @staticmethod
    def pack(a: np.ndarray, b: np.ndarray, places: np.ndarray) -> bytes:
        """File of keys (a, b) with places (shard, row, rows); a key may have several."""
        keys, which = np.unique(np.stack([a, b], axis=1), axis=0, return_inverse=True)
        own = PerfectHash.build(keys[:, 0].copy(), keys[:, 1].copy())
        slot = own.slots(keys[:, 0], keys[:, 1])
        order = np.lexsort((places[:, 1], places[:, 0], slot[which.ravel()]))
        ends = np.cumsum(np.bincount(slot[which.ravel()], minlength=len(keys)))
        prints = np.empty(len(keys), dtype=np.uint32)
        prints[slot] = _fingerprint(keys[:, 0], keys[:, 1])
        out = io.BytesIO()
        np.savez(out, sizes=own.sizes, bits=own.bits, ranks=own.ranks, prints=prints, ends=ends, places=places[order])
        return out.getvalue()

    def find(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(key numbers, places) of the keys that are there; a key may have several."""
        slot = self.hash.slots(a, b)
        at = np.flatnonzero(slot >= 0)
        at = at[self.prints[slot[at]] == _fingerprint(a[at], b[at])]
        hi = self.ends[slot[at]]
        lo = np.where(slot[at] > 0, self.ends[slot[at] - 1], 0)
        n = hi - lo
        rows = np.repeat(hi - np.cumsum(n), n) + np.arange(n.sum())
        return np.repeat(at, n), self.places[rows]


# ---- encoding --------------------------------------------------------------------------


class LibraryEncoder:
    """The tokenizers library behind a memo of words. A file that drops white space, ends
    words by a suffix and splits by a pattern without white space encodes each word by
    itself; then words go to the library once. If such a file also lower-cases, texts of
    Latin letters without combining marks (for which composing changes nothing) are
    lower-cased beforehand, and a word of such letters alone, or with one stop or comma
    behind, is what the pattern would cut: it goes straight to the library's BPE model.
    Any other file gets whole texts."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        spec = json.loads(Path(path).read_text("utf-8"))
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        split = next((s for s in steps if s["type"] == "Split"), {})
        self.word_wise = (bool(spec["model"].get("end_of_word_suffix")) and split.get("behavior") == "Removed" and bool(split.get("invert"))
                          and r"[^\s\p{L}\p{N}]+" in split["pattern"].get("Regex", "") and spec.get("post_processor") is None
                          and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or " " in t["content"] for t in spec["added_tokens"]))
        lowers = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.lower = lowers[:1] == ["NFC"] and lowers[-1:] == ["Lowercase"] and set(lowers) <= {"NFC", "Replace", "Lowercase"}
        self.type = np.dtype("<u2" if max(self.library.get_vocab(with_added_tokens=True).values()) < 1 << 16 else "<u4")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.code = {2: "H", 4: "I"}[self.type.itemsize]
        self.letters = {b: c for c, b in byte_letters().items()}
        self.stops = {c: self._whole(c) for c in ".,"}
        self.memo: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=self.type).tobytes()

    def _words(self, text: str) -> list[str]:
        if self.lower and not NOT_LATIN.search(text):
            low = text.lower()
            if not any(t in low for t in self.special):
                return low.split()
        return text.split()

    def _learn(self, words: set[str]) -> None:
        """Add the ids of words to the memo."""
        memo, code, tokenize, rest = self.memo, self.code, self.library.model.tokenize, []
        for w in words:
            base = w if w.isalpha() else w[:-1] if w[-1] in self.stops else ""
            if self.lower and base.isalpha() and not NOT_LATIN.search(base) and base == base.lower():
                mapped = base if base.isascii() else "".join(map(self.letters.__getitem__, base.encode()))
                ids = array(code, [t.id for t in tokenize(mapped)]).tobytes()
                memo[w] = ids if base is w else ids + self.stops[w[-1]]
            else:
                rest.append(w)
        for w, e in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False)):
            memo[w] = array(code, e.ids).tobytes()

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        if not self.word_wise:
            return [self._whole(t) for t in texts]
        memo = self.memo
        cut = [None if ODD_SPACE.search(t) else self._words(t) for t in texts]
        new = {w for own in cut if own for w in own if w not in memo}
        if new:
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = {w for own in cut if own for w in own}
            self._learn(new)
        return [self._whole(t) if own is None else b"".join(map(memo.__getitem__, own)) for t, own in zip(texts, cut)]


_encoders: dict[str, LibraryEncoder] = {}
_lock = threading.Lock()


def encoder(path: str) -> LibraryEncoder:
    with _lock:
        if path not in _encoders:
            _encoders[path] = LibraryEncoder(path)
        return _encoders[path]


# ---- writing ---------------------------------------------------------------------------


@dataclass
class TokenIndex:
    """``folder`` holds the files; ``shards``: shard, name, rows, n_ids, start (ids of all
    shards before it); ``buckets``: bucket, name."""
    folder: str
    shards: DataFrame
    buckets: DataFrame
    n_buckets: int
    n_shards: int
    width: int


# Schemes of Hadoop's paths and the names Arrow has for them.
ARROW_SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3",
                 "gs": "gs", "gcs": "gs", "abfs": "abfs", "abfss": "abfss"}


def arrow_uri(folder: str) -> str:
    """The folder as Arrow names it; paths without a scheme stay. A scheme that Arrow cannot
    open is refused, which ``write_index`` does before any job."""
    scheme, colon, rest = folder.partition(":")
    if not colon or "/" in scheme:
        return folder
    if scheme.lower() not in ARROW_SCHEMES:
        raise ValueError(f"index files cannot be written to {scheme}: paths; set spark.checkpoint.dir to one of {', '.join(ARROW_SCHEMES)}")
    return f"{ARROW_SCHEMES[scheme.lower()]}:{rest}"


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(arrow_uri(folder))


def _hashes(key: Column) -> list[Column]:
    return [F.xxhash64(key).alias("a"), F.xxhash64(F.lit("second"), key).alias("b")]


def write_index(df: DataFrame, tokenizer: str, end_id: int | None, id_col: str = "doc_id", text_col: str = "text",
                shard_bytes: int = SHARD_BYTES) -> TokenIndex:
    """Encode all texts, write payload and index files, and return where they are."""
    spark, folder = df.sparkSession, shared_folder(df.sparkSession, "token-index")
    arrow_uri(folder)
    width = LibraryEncoder(tokenizer).type.itemsize
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0]
    order = F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))
    rows = (df.select(F.col(id_col).alias("id"), *_hashes(F.col(id_col)), order.alias("tie"), text_bytes(text_col).alias("t"))
            .repartitionByRange(partitions_for(spark, total, shard_bytes), "id", "tie").sortWithinPartitions("id", "tie"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, (store, root) = encoder(tokenizer), _store(folder)
        end = b"" if end_id is None else np.array([end_id], dtype=bpe.type).tobytes()
        task = TaskContext.get()
        name = f"shard-{task.partitionId()}-{task.taskAttemptId()}-{uuid.uuid4().hex}"
        store.create_dir(root, recursive=True)
        keys, lengths = [], []
        with store.open_output_stream(f"{root}/{name}.ids") as payload:
            for b in slices(batches, 2):
                for ids in bpe.encode_batch([t.as_py().decode("utf-8", "replace") for t in b.column(2)]):
                    payload.write(ids + end)
                    lengths.append((len(ids) + len(end)) // width)
                keys.append(np.stack([np.asarray(b.column(0)), np.asarray(b.column(1))], axis=1))
        if not lengths:
            return
        with store.open_output_stream(f"{root}/{name}.ends") as out:
            out.write(np.cumsum(lengths, dtype="<i8").tobytes())
        key = np.concatenate(keys)
        first = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]).any(axis=1)])
        count = np.diff(np.r_[first, len(key)])
        shard = task.partitionId()
        head = pa.RecordBatch.from_pydict({"shard": [shard], "name": [name], "a": [0], "b": [0], "row": [len(key)], "rows": [sum(lengths)]}, schema=schema)
        yield head
        for at in range(0, len(first), 50_000):
            f, c = first[at:at + 50_000], count[at:at + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(f), shard, np.int32)), pa.nulls(len(f), pa.string()), pa.array(key[f, 0]), pa.array(key[f, 1]),
                                              pa.array(f.astype(np.int64)), pa.array(c.astype(np.int64))], schema=schema)

    schema = pa.schema([("shard", pa.int32()), ("name", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("row", pa.int64()), ("rows", pa.int64())])
    made = checkpoint(rows.select("a", "b", "t").mapInArrow(write, "shard int, name string, a long, b long, row long, rows long"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    shards = made.where("name IS NOT NULL").select("shard", "name", F.col("row").alias("rows"), F.col("rows").alias("n_ids"))
    shards = shards.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    places = made.where("name IS NULL")
    n_buckets = partitions_for(spark, places.count(), KEYS_PER_BUCKET)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for bucket, part in _by_group(batches, 0):
            a, b, shard, row, n = (np.concatenate(x) for x in zip(*([np.asarray(p.column(i)) for i in range(1, 6)] for p in part)))
            name = f"bucket-{bucket}-{TaskContext.get().taskAttemptId()}-{uuid.uuid4().hex}.npz"
            with store.open_output_stream(f"{root}/{name}") as out:
                out.write(Bucket.pack(a.view("<u8"), b.view("<u8"), np.stack([shard, row, n], axis=1).astype(np.int64)))
            yield pa.RecordBatch.from_pydict({"bucket": [bucket], "name": [name]}, schema=pa.schema([("bucket", pa.int64()), ("name", pa.string())]))

    dealt = places.select(_bucket(n_buckets), "a", "b", "shard", "row", "rows").repartition(n_buckets, "bucket").sortWithinPartitions("bucket")
    shards = checkpoint(shards)
    return TokenIndex(folder, shards, checkpoint(dealt.mapInArrow(index, "bucket long, name string")), n_buckets, shards.count(), width)


def _small(table: DataFrame, rows: int) -> DataFrame:
    """A table of one row per file: broadcast while its row count is known to be small."""
    return F.broadcast(table) if rows <= SMALL_TABLE_ROWS else table


def _bucket(n: int) -> Column:
    return F.pmod("a", F.lit(n)).cast("long").alias("bucket")


def _by_group(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[int, list[pa.RecordBatch]]]:
    """Rows sorted by a column, group by group."""
    def cut() -> Iterator[tuple[int, pa.RecordBatch]]:
        for b in batches:
            key = np.asarray(b.column(column))
            at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else []
            for i, j in zip(at, [*at[1:], len(key)]):
                yield int(key[i]), b.slice(i, j - i)
    for key, parts in groupby(cut(), key=lambda x: x[0]):
        yield key, [p for _, p in parts]


# ---- reading ---------------------------------------------------------------------------


def lookup(index: TokenIndex, keys: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """All documents of the distinct keys: id, start (over all shards), n_tokens and ``ids``
    (little-endian unsigned 32-bit), read back from the files through the index."""
    folder, width = index.folder, index.width
    kind = keys.schema[id_col].dataType.simpleString()
    asked = keys.select(F.col(id_col).alias("id")).distinct().select("id", *_hashes(F.col("id"))).withColumn("bucket", _bucket(index.n_buckets))
    asked = (asked.join(_small(index.buckets.withColumnRenamed("bucket", "at"), index.n_buckets), F.col("bucket") == F.col("at"))
             .select("bucket", "name", "a", "b", "id").repartition(index.n_buckets, "bucket").sortWithinPartitions("bucket"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for _, parts in _by_group(batches, 0):
            with store.open_input_stream(f"{root}/{parts[0].column(1)[0].as_py()}") as f:
                bucket = Bucket(dict(np.load(io.BytesIO(f.read()))))
            for p in parts:
                key, place = bucket.find(np.asarray(p.column(2)).view("<u8"), np.asarray(p.column(3)).view("<u8"))
                yield pa.RecordBatch.from_arrays([p.column(4).take(pa.array(key)), *(pa.array(place[:, i]) for i in range(3))], ["id", "shard", "row", "rows"])

    found = asked.mapInArrow(find, f"id {kind}, shard long, row long, rows long")
    shards = _small(index.shards.select(F.col("shard").cast("long").alias("of"), "name", "start"), index.n_shards)
    found = found.join(shards, F.col("shard") == F.col("of")).select("shard", "row", "rows", "name", "start", "id")
    n = partitions_for(keys.sparkSession, index.n_shards, 1)
    found = found.repartition(n, "shard").sortWithinPartitions("shard", "row")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        for _, parts in _by_group(batches, 0):
            name, base = parts[0].column(3)[0].as_py(), parts[0].column(4)[0].as_py()
            with store.open_input_stream(f"{root}/{name}.ends") as f:
                ends = np.frombuffer(f.read(), dtype="<i8")
            with store.open_input_file(f"{root}/{name}.ids") as payload:
                for p in parts:
                    yield from _documents(p, ends, payload, base, width)

    out = found.mapInArrow(read, f"id {kind}, start long, n_tokens long, ids binary")
    return out.select(F.col("id").alias(id_col), "start", "n_tokens", "ids")


def _documents(places: pa.RecordBatch, ends: np.ndarray, payload, base: int, width: int) -> Iterator[pa.RecordBatch]:
    """Rows of one shard's places, in batches of about 1M ids."""
    first, n = np.asarray(places.column(1)), np.asarray(places.column(2))
    which = np.repeat(np.arange(len(n)), n)
    row = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    stop = ends[row]
    start = np.where(row > 0, ends[row - 1], 0)
    size = stop - start
    part = np.cumsum(size) // 1_000_000
    for i, j in zip(at := np.flatnonzero(np.r_[True, part[1:] != part[:-1]]) if len(part) else [], [*at[1:], len(part)]):
        ids = []
        for s, m in zip(start[i:j].tolist(), size[i:j].tolist()):
            payload.seek(s * width)
            ids.append(np.frombuffer(payload.read(m * width), dtype=f"<u{width}").astype("<u4").tobytes())
        yield pa.RecordBatch.from_arrays([places.column(5).take(pa.array(which[i:j])), pa.array(base + start[i:j]), pa.array(size[i:j]), pa.array(ids, pa.binary())],
                                         ["id", "start", "n_tokens", "ids"])
