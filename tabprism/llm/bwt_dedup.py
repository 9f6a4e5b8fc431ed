"""Removal of repeated byte strings by merging block-sorted (Burrows-Wheeler) shards.

A byte goes if a ``width``-byte string that covers it also starts earlier: in a document
of smaller order, or earlier in the same one. Matches never cross documents, and strings
are judged on the input.

1. Cutting. Each window of ``width`` bytes belongs to the smallest hash among its 16-byte
   grams, so equal windows have equal smallest hashes. A run of windows with one smallest
   hash is cut out with its bytes and dealt to the bucket of that hash. Equal pieces of
   one batch travel once: all but the first are repeated as a whole.
2. Merging. In a bucket, pieces whose hash occurs once cannot repeat, and all but the
   first of equal pieces are repeated as a whole. The rest of every source is a shard: its
   suffixes are sorted by their first 8 bytes (the block-sorting transform of that order).
   The shards' orders are merged, and the merged interleave is refined: reading, for each
   suffix in order, the symbols in front of it (its transform's output) and dealing the
   suffixes stably by them gives the order of the suffixes that start there, with a common
   prefix longer by as much. No suffix is sorted again. Intervals of one suffix are done;
   those that reach ``width`` bytes hold the equal windows, and all but the earliest of
   an interval are repeated.
3. Removal. Repeated ranges are gathered by document and cut out.

The number of buckets follows the input, and a string that many documents share meets in a
bucket once per batch, not once per document. A short frequent phrase with differing text
round it would still bring one piece per occurrence under one hash. So the bytes of the
different pieces per smallest hash are counted before cutting: windows of a hash that may
hold more than ``HOT_BYTES`` (all that hold more, none that hold less than half) are dealt
one by one, by a 128-bit hash of the whole window; equal windows travel once per
``HOT_WINDOWS`` windows of a batch. Each hash that stays holds ``HOT_BYTES`` at most.

Defined results: null text is empty; a null id comes before all others; rows that share an
id are ordered by a hash of their text, and rows that share both are one document, each
with that document's result; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import partitions_for, slices, text_bytes

WIDTH = 100
GRAM = 16
START_ORDER, STEP = 8, 2  # bytes that the shards are sorted by; symbols read at a time
PIECE = 4096  # windows in a piece at most; longer runs are cut
POSITION = (1 << 24) - 1
SEGMENT = 1 << 23
BATCH_BYTES = 20 << 20
BUCKET_BYTES = 9 << 20
HOT_BYTES = 9 << 20  # bytes of different pieces under one smallest hash
HOT_WINDOWS = 1 << 20
NO_ID = -(1 << 63)


# ---- cutting ---------------------------------------------------------------------------


def _gram_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of the GRAM bytes at every position."""
    eight = np.empty(len(text) - 7, dtype=np.uint64)
    for o in range(8):
        part = np.frombuffer(text, dtype="<u8", count=(len(text) - o) // 8, offset=o)
        eight[o::8] = part[:len(eight[o::8])]
    h = eight[:-8] * np.uint64(0x9E3779B97F4A7C15) ^ eight[8:] * np.uint64(0xC2B2AE3D27D4EB4F)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


def _sliding_min(a: np.ndarray, n: int) -> np.ndarray:
    k = 1
    while 2 * k <= n:
        a = np.minimum(a[:-k], a[k:])
        k *= 2
    return np.minimum(a[:len(a) - (n - k)], a[n - k:]) if k < n else a


def cut_pieces(text: bytes, width: int = WIDTH, places: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Pieces of a text: smallest hash (40 bits), first window, number of windows, and
    whether the smallest hash occurs at two places of the run (only then can one piece
    hold equal windows; not found out without ``places``)."""
    parts = []
    for base in range(0, max(0, len(text) - width + 1), SEGMENT):
        h = _gram_hashes(text[base:base + SEGMENT + width - 1])
        if places:
            at = np.arange(len(h), dtype=np.uint64)
            top = h & ~np.uint64(POSITION)
            low = _sliding_min(top | at, width - GRAM + 1)
            high = _sliding_min(top | (np.uint64(POSITION) - at), width - GRAM + 1) & np.uint64(POSITION)
            value, left = low >> np.uint64(24), low & np.uint64(POSITION)
        else:
            value = _sliding_min(h >> np.uint64(24), width - GRAM + 1)
        first = np.flatnonzero(np.r_[True, value[1:] != value[:-1]])
        last = np.r_[first[1:], len(value)] - 1
        if places:
            two = np.r_[0, np.cumsum(left != np.uint64(POSITION) - high)]
            twice = (two[last + 1] > two[first]) | (left[first] != left[last])
        else:
            twice = np.zeros(len(first), bool)
        n = last - first + 1
        cuts = -(-n // PIECE)
        which = np.repeat(np.arange(len(n)), cuts)
        nth = np.arange(len(which)) - np.repeat(np.cumsum(cuts) - cuts, cuts)
        parts.append((value[first][which], base + first[which] + nth * PIECE, np.minimum(n[which] - nth * PIECE, PIECE), twice[which]))
    if not parts:
        return (np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _gather(buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of the slices, one after the other."""
    ends = np.cumsum(size)
    return buffer[np.repeat(start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)]


def _digests(buffer: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    view = memoryview(buffer)
    return np.fromiter((xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), (start + size).tolist())), dtype=np.uint64, count=len(start))


def _later_copies(value: np.ndarray, print_: np.ndarray, key: np.ndarray, tag: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first of each group of equal pieces, those that are elsewhere than their first)."""
    order = np.lexsort((start, tag, key, print_, value))
    new = np.r_[True, (value[order][1:] != value[order][:-1]) | (print_[order][1:] != print_[order][:-1])]
    first = order[new]
    own = first[np.cumsum(new) - 1]
    away = (key[order] != key[own]) | (tag[order] != tag[own]) | (start[order] != start[own])
    return first, order[away]


def heavy_hashes(texts: list[bytes], least: float, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """(smallest hash, bytes) of those whose different pieces hold over ``least`` bytes."""
    cols, base = [], 0
    for text in texts:
        value, first, n, _ = cut_pieces(text, width, places=False)
        cols.append((value, base + first, n + width - 1))
        base += len(text)
    value, at, size = (np.concatenate(x) for x in zip(*cols))
    value, which = np.unique(value, return_inverse=True)
    rows = np.flatnonzero(np.bincount(which, weights=size, minlength=len(value))[which] > least)
    zero = np.zeros(len(rows), np.int64)
    first, _ = _later_copies(which[rows], _digests(b"".join(texts), at[rows], size[rows]), zero, zero, at[rows]) if len(rows) else (rows, rows)
    held = np.bincount(which[rows[first]], weights=size[rows[first]], minlength=len(value))
    hot = np.flatnonzero(held > least)
    return value[hot], held[hot].astype(np.int64)


_FIELDS = (("value", "<u4"), ("key", "<i8"), ("tag", "<u4"), ("start", "<u4"), ("windows", "<u2"), ("twice", "?"))
_WINDOW_FIELDS = (("high", "<u8"), ("low", "<u8"), ("key", "<i8"), ("tag", "<u4"), ("start", "<u4"))


def _pack_pieces(p: dict[str, np.ndarray], text: np.ndarray, fields: tuple = _FIELDS) -> bytes:
    n = len(p["key"])
    key = np.diff(p["key"], prepend=np.int64(0))  # ids mostly rise: small differences compress
    columns = [np.ascontiguousarray((key if name == "key" else p[name]).astype(kind)).view(np.uint8).reshape(n, -1).T.tobytes() for name, kind in fields]
    return zstandard.ZstdCompressor(level=5).compress(np.int64(n).tobytes() + b"".join(columns) + text.tobytes())


def _unpack_pieces(blob: bytes, fields: tuple = _FIELDS) -> tuple[dict[str, np.ndarray], np.ndarray]:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8)
    n, at, p = int(raw[:8].view("<i8")[0]), 8, {}
    for name, kind in fields:
        size = np.dtype(kind).itemsize * n
        p[name] = np.ascontiguousarray(raw[at:at + size].reshape(-1, n).T).reshape(-1).view(kind)
        at += size
    p["key"] = np.cumsum(p["key"])
    return p, raw[at:]


def _window_rows(raw: bytes, at: np.ndarray, n: np.ndarray, key: np.ndarray, tag: np.ndarray, start: np.ndarray, buckets: int, width: int) -> Iterator[tuple[int, int, bytes]]:
    """As _batch_rows, of the single windows of pieces: kind 2 windows, kind 1."""
    nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at, start, key, tag = np.repeat(at, n) + nth, np.repeat(start, n) + nth, np.repeat(key, n), np.repeat(tag, n)
    view = memoryview(raw)
    prints = np.frombuffer(b"".join(xxhash.xxh3_128_digest(view[a:a + width]) for a in at.tolist()), "<u8").reshape(-1, 2)
    high, low = prints[:, 0], prints[:, 1]
    first, copies = _later_copies(high, low, key, tag, start)
    for k, payload in _pack_ranges(key[copies], tag[copies], start[copies], start[copies] + width):
        yield int(k % buckets), 1, payload
    bucket = (high % np.uint64(buckets)).astype(np.int64)
    order = first[np.lexsort((start[first], key[first], bucket[first]))]
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(edge)).tolist():
        own = order[edge[b]:edge[b + 1]]
        window = {"high": high[own], "low": low[own], "key": key[own], "tag": tag[own], "start": start[own]}
        yield b, 2, _pack_pieces(window, np.empty(0, np.uint8), _WINDOW_FIELDS)


def _batch_rows(docs: list[tuple[int, int, bytes]], buckets: int, width: int, hot: np.ndarray | None = None) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, kind, payload): kind 0 pieces, kind 1 ranges that are repeated for sure,
    kind 2 single windows of the ``hot`` smallest hashes."""
    cols, base = [], 0
    for key, tag, text in docs:
        value, first, n, twice = cut_pieces(text, width)
        m = len(value)
        cols.append((value, first, n, twice, np.full(m, key, np.int64), np.full(m, tag, np.int64), base + first))
        base += len(text)
    value, start, n, twice, key, tag, at = (np.concatenate(x) for x in zip(*cols))
    if not len(value):
        return
    raw = b"".join(d[2] for d in docs)
    if hot is not None and len(hot):
        apart = np.isin(value, hot)
        rows = np.flatnonzero(apart)
        turn = np.cumsum(n[rows]) // HOT_WINDOWS
        for own in np.split(rows, np.flatnonzero(np.diff(turn)) + 1) if len(rows) else []:
            yield from _window_rows(raw, at[own], n[own], key[own], tag[own], start[own], buckets, width)
        value, start, n, twice, key, tag, at = (x[~apart] for x in (value, start, n, twice, key, tag, at))
        if not len(value):
            return
    first, copies = _later_copies(value, _digests(raw, at, n + width - 1), key, tag, start)
    for k, payload in _pack_ranges(key[copies], tag[copies], start[copies], (start + n + width - 1)[copies]):
        yield int(k % buckets), 1, payload
    bucket = (value % np.uint64(buckets)).astype(np.int64)
    order = first[np.lexsort((start[first], key[first], bucket[first]))]
    edge = np.searchsorted(bucket[order], np.arange(buckets + 1))
    text = np.frombuffer(raw, dtype=np.uint8)
    for b in np.flatnonzero(np.diff(edge)).tolist():
        own = order[edge[b]:edge[b + 1]]
        piece = {"value": value[own] // np.uint64(buckets) & np.uint64(0xFFFFFF), "key": key[own], "tag": tag[own], "start": start[own], "windows": n[own], "twice": twice[own]}
        yield b, 0, _pack_pieces(piece, _gather(text, at[own], n[own] + width - 1))


# ---- ranges ----------------------------------------------------------------------------


def union_ranges(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs covered by the ranges; runs that touch are one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    new = np.r_[True, start[1:] > reach[:-1]]
    return start[new], reach[np.r_[new[1:], True]]


def _pack_ranges(key: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Per document (key, packed ranges), joined where they touch."""
    order = np.lexsort((start, tag, key))
    key, tag, start, end = key[order], tag[order], start[order], end[order]
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (tag[1:] != tag[:-1])]) if len(key) else []
    for a, b in zip(new, [*new[1:], len(key)]):
        s, e = union_ranges(start[a:b], end[a:b])
        yield int(key[a]), np.array([key[a], tag[a]], "<i8").tobytes() + np.stack([s, e]).astype("<i8").tobytes()


# ---- merging ---------------------------------------------------------------------------


def repeated_windows(shards: list[tuple[np.ndarray, np.ndarray]], place: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Positions (in the shards' bytes, one after the other) of all windows that equal one
    of smaller place. shards: (bytes, sizes of their strings); place: the order of each
    position's window. Shards are block-sorted alone, merged, and the interleave refined."""
    text = np.concatenate([s[0] for s in shards])
    size = np.concatenate([s[1] for s in shards])
    ends = np.cumsum(size)
    offset = np.arange(len(text)) - np.repeat(ends - size, size)
    left = np.repeat(size, size) - offset
    padded = np.concatenate([text, np.zeros(START_ORDER, np.uint8)])
    prefix = np.zeros(len(text), dtype=np.uint64)
    for o in range(START_ORDER):
        prefix = prefix << np.uint64(8) | padded[o:o + len(text)]
    orders, base = [], 0
    for own, _ in shards:  # each shard's suffixes by their first bytes
        at = base + np.flatnonzero(left[base:base + len(own)] >= START_ORDER)
        orders.append(at[np.argsort(prefix[at], kind="stable")])
        base += len(own)
    order = np.concatenate(orders)
    order = order[np.argsort(prefix[order], kind="stable")]  # merge of sorted runs
    symbol = prefix[order]
    interval = np.cumsum(np.r_[True, symbol[1:] != symbol[:-1]]) if len(order) else np.empty(0, np.int64)
    pair = (padded[:len(text)].astype(np.uint16) << np.uint16(8)) | padded[1:len(text) + 1]
    depth = START_ORDER
    while True:
        # Suffixes alone in their interval have no equal; neither have those in front of them.
        new = np.r_[True, interval[1:] != interval[:-1]] if len(interval) else np.empty(0, bool)
        alone = new & np.r_[new[1:], True]
        order, interval = order[~alone], interval[~alone]
        if depth >= width or not len(order):
            break
        ahead = offset[order] >= STEP
        order, interval = order[ahead] - STEP, interval[ahead]
        symbol = pair[order]
        deal = np.argsort(symbol, kind="stable")
        order, interval, symbol = order[deal], interval[deal], symbol[deal]
        interval = np.cumsum(np.r_[True, (interval[1:] != interval[:-1]) | (symbol[1:] != symbol[:-1])]) if len(order) else interval
        depth += STEP
    if not len(order):
        return order
    first = np.flatnonzero(np.r_[True, interval[1:] != interval[:-1]])
    lowest = np.repeat(np.minimum.reduceat(place[order], first), np.diff(np.r_[first, len(order)]))
    return np.sort(order[place[order] != lowest])


def bucket_ranges(blobs: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, tag, start, end) of the repeated ranges among a bucket's pieces."""
    parts = [_unpack_pieces(b) for b in blobs]
    p = {name: np.concatenate([x[0][name] for x in parts]) for name, _ in _FIELDS}
    source = np.repeat(np.arange(len(parts)), [len(x[0]["value"]) for x in parts])
    size = p["windows"].astype(np.int64) + width - 1
    text, at = np.concatenate([x[1] for x in parts]), np.cumsum(size) - size
    value, tag, start = p["value"].astype(np.int64), p["tag"].astype(np.int64), p["start"].astype(np.int64)

    def several(rows: np.ndarray) -> np.ndarray:
        _, which, n = np.unique(value[rows], return_inverse=True, return_counts=True)
        return rows[(n[which] > 1) | p["twice"][rows]]

    rows = several(np.arange(len(value)))
    first, copies = _later_copies(value[rows], _digests(text.tobytes(), at[rows], size[rows]), p["key"][rows], tag[rows], start[rows])
    first, copies = np.sort(rows[first]), rows[copies]
    out = [(p["key"][copies], tag[copies], start[copies], start[copies] + size[copies])]
    first = several(first)
    if len(first):
        _, document = np.unique(np.stack([p["key"][first], tag[first]], axis=1), axis=0, return_inverse=True)
        own = size[first]
        offset = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
        place = np.repeat((document.ravel() << 32) + start[first], own) + offset
        edge = np.flatnonzero(np.r_[True, np.diff(source[first]) != 0])
        shards = [(_gather(text, at[first[a:b]], own[a:b]), own[a:b]) for a, b in zip(edge, [*edge[1:], len(first)])]
        found = repeated_windows(shards, place, width)
        if len(found):
            piece = np.repeat(np.arange(len(first)), own)[found]
            new = np.flatnonzero(np.r_[True, (np.diff(found) != 1) | (np.diff(piece) != 0)])
            stop = np.r_[new[1:], len(found)] - 1
            of = first[piece[new]]
            out.append((p["key"][of], tag[of], start[of] + offset[found[new]], start[of] + offset[found[stop]] + width))
    return tuple(np.concatenate(x) for x in zip(*out))


def window_ranges(blobs: list[bytes], width: int = WIDTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, tag, start, end) of the repeated ones among a bucket's single windows."""
    parts = [_unpack_pieces(b, _WINDOW_FIELDS)[0] for b in blobs]
    p = {name: np.concatenate([x[name] for x in parts]) for name, _ in _WINDOW_FIELDS}
    tag, start = p["tag"].astype(np.int64), p["start"].astype(np.int64)
    _, copies = _later_copies(p["high"], p["low"], p["key"], tag, start)
    return p["key"][copies], tag[copies], start[copies], start[copies] + width


# ---- Spark -----------------------------------------------------------------------------


def hot_hashes(texts: DataFrame, total: int, width: int = WIDTH, limit: int | None = None) -> np.ndarray:
    """Smallest hashes whose pieces hold over ``limit`` bytes, equal ones of a batch counted
    once. texts: one binary column of ``total`` bytes. A batch leaves out hashes below its
    share of half the limit, so no count is short by more than that half."""
    limit = HOT_BYTES if limit is None else limit

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if held:
                value, size = heavy_hashes(held, limit / 2 * sum(map(len, held)) / total, width)
                held.clear()
                yield pa.RecordBatch.from_arrays([pa.array(value.astype(np.int64)), pa.array(size)], ["value", "size"])

        for b in slices(batches, 0):
            held += [t for t in b.column(0).to_pylist() if len(t) >= width]
            if sum(map(len, held)) >= BATCH_BYTES:
                yield from flush()
        yield from flush()

    sizes = texts.mapInArrow(count, "value long, size long").groupBy("value").agg(F.sum("size").alias("size"))
    return np.sort(np.array([r["value"] for r in sizes.where(F.col("size") > limit / 2).collect()], dtype=np.uint64))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row per document: id, n_bytes, ``spans`` (start and end of each maximal removed
    run, one after the other) and ``kept``, the remaining bytes."""
    if width < GRAM + START_ORDER or (width - START_ORDER) % STEP:
        raise ValueError(f"width must be even and at least {GRAM + START_ORDER}")
    spark = df.sparkSession
    total = df.agg(F.sum(F.octet_length(text_col))).first()[0]
    buckets = partitions_for(spark, 3 * (total or 0), BUCKET_BYTES)
    tag = F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).bitwiseAND(F.lit(0xFFFFFFFF))
    docs = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("key"), tag.alias("tag"), text_bytes(text_col).alias("t"))

    hot = hot_hashes(docs.select("t"), total or 0, width)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, bytes]] = []

        def flush() -> Iterator[pa.RecordBatch]:
            rows = list(_batch_rows(held, buckets, width, hot)) if held else []
            held.clear()
            for i in range(0, len(rows), 64):
                part = list(zip(*rows[i:i + 64]))
                yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int32()), pa.array(part[2], pa.binary())], ["bucket", "kind", "payload"])

        for b in slices(batches, 2):
            held += [row for row in zip(*(c.to_pylist() for c in b.columns)) if len(row[2]) >= width]
            if sum(len(h[2]) for h in held) >= BATCH_BYTES:
                yield from flush()
        yield from flush()

    pieces = docs.select("key", "tag", "t").mapInArrow(cut, "bucket int, kind int, payload binary")
    dealt = pieces.repartition(buckets, "bucket").sortWithinPartitions("bucket")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[bytes]:
            blobs: dict[int, tuple[list[bytes], list[bytes]]] = {}

            def settled(pieces: list[bytes], windows: list[bytes]) -> Iterator[bytes]:
                if pieces:
                    yield from (r for _, r in _pack_ranges(*bucket_ranges(pieces, width)))
                if windows:
                    yield from (r for _, r in _pack_ranges(*window_ranges(windows, width)))

            for b in batches:
                for bucket, kind, payload in zip(*(c.to_pylist() for c in b.columns)):
                    if kind == 1:
                        yield payload
                        continue
                    for done in [x for x in blobs if x != bucket]:
                        yield from settled(*blobs.pop(done))
                    blobs.setdefault(bucket, ([], []))[kind // 2].append(payload)
            for own in blobs.values():
                yield from settled(*own)

        held: list[bytes] = []

        def batch() -> pa.RecordBatch:
            head = np.frombuffer(b"".join(r[:16] for r in held), dtype="<i8").reshape(-1, 2)
            out = pa.RecordBatch.from_arrays([pa.array(head[:, 0]), pa.array(head[:, 1]), pa.array([r[16:] for r in held], pa.binary())], ["of", "of_tag", "ranges"])
            held.clear()
            return out

        for r in rows():
            held.append(r)
            if len(held) >= 20_000:
                yield batch()
        if held:
            yield batch()

    ranges = dealt.mapInArrow(merge, "of long, of_tag long, ranges binary").groupBy("of", "of_tag").agg(F.collect_list("ranges").alias("ranges"))
    joined = docs.join(ranges, (F.col("key") == F.col("of")) & (F.col("tag") == F.col("of_tag")), "left").select("id", "ranges", "t")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            spans, kept, sizes = [], [], []
            for found, text in zip(b.column(1), b.column(2)):
                text = text.as_py()
                pairs = np.concatenate([np.frombuffer(r, "<i8").reshape(2, -1) for r in found.as_py() or ()] or [np.empty((2, 0), np.int64)], axis=1)
                start, end = union_ranges(pairs[0], pairs[1])
                edges = np.stack([start, end], axis=1).reshape(-1).tolist()
                cuts = [0, *edges, len(text)]
                kept.append(b"".join(text[i:j] for i, j in zip(cuts[::2], cuts[1::2])) if edges else text)
                spans.append(edges)
                sizes.append(len(text))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.int64())), pa.array(kept, pa.binary())], ["id", "n_bytes", "spans", "kept"])

    kind = df.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(remove, f"id {kind}, n_bytes long, spans array<long>, kept binary").withColumnRenamed("id", id_col)
