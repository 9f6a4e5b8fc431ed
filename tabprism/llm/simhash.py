"""SimHash near-duplicates with bit-sliced comparison.

Fingerprints: A-Z lower-cased, words ``[^\\x20\\x09-\\x0D]+``, shingles of ``shingle``
words with repeats (fewer words: the whole sequence; none: fingerprint 0), XXH64 with
seed 42 of each; a bit is 1 if set in more than half of the hashes.

Links at ``radius`` or fewer differing bits. The 64 bits are cut into ``radius + 2``
blocks; two fingerprints within the radius agree in at least two blocks, so each
fingerprint goes to one bucket per pair of blocks. Inside a task the bucket-sorted
fingerprints are turned into 64 vertical bit planes; lane i is compared with lane i+k
for k = 1, 2, ..., 64 lanes a machine word, with carry-save counters, and words in
which every lane is beyond the radius are abandoned. Each task emits a spanning forest
of its links, at most one edge per fingerprint; star contraction joins the forests.
Buckets have no cap: a crowded one is dealt again by parts of its remaining bits before the
shuffle (``bucketed``), and a task cuts a large one once more by itself.

Defined results: null text = empty text = fingerprint 0, linked like any other; null ids
take part but never name a component unless all ids of it are null; repeated ids and
texts give repeated rows; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations, islice, repeat

import numpy as np
import pyarrow as pa
import pyspark.sql.functions as F
import xxhash
from pyspark.sql import Column, DataFrame

from tabprism.llm.common import LOWER_AZ, checkpoint, partitions_for, slices, text_bytes
from tabprism.llm.components import components

SHINGLE, RADIUS, SEED = 3, 2, 42
FINGERPRINTS_PER_TASK = 1_000_000
LARGE_BUCKET = 4096  # entries of a bucket that a task cuts again by itself
HOT_BUCKET = 200_000  # entries of a bucket that is dealt again before the shuffle
SMALL_TABLE_ROWS = 100_000


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of a UTF-8 text."""
    words = text.translate(LOWER_AZ).split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams: Iterable[bytes] = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle))))
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):
        part = hashes[at:at + 8192]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    return int.from_bytes(np.packbits(counts * 2 > len(hashes), bitorder="little").tobytes(), "little")


def _fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(1)), dtype="<u8", count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(prints.view("<i8"))], ["id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(F.col(id_col).alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, f"id {kind}, fp long")


# ---- bit-sliced comparison -------------------------------------------------------------


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of packed lanes: bit i of row b is bit b of fingerprint i."""
    pad = np.zeros(-(-len(prints) // 64) * 64 + 64, dtype="<u8")
    pad[:len(prints)] = prints
    planes = np.empty((64, len(pad) // 64), dtype="<u8")
    for b in range(64):
        planes[b] = np.packbits(((pad >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little").view("<u8")
    return planes


def within_radius(planes: np.ndarray, k: int, lanes: np.ndarray, words: np.ndarray, radius: int) -> np.ndarray:
    """Mask per word of the lanes i (given in ``lanes``) whose distance to lane i+k is at
    most ``radius``. Carry-save: counter bit j of all 64 lanes is one machine word."""
    step, shift = divmod(k, 64)
    width = (radius + 1).bit_length()
    live = np.arange(len(words))
    result = np.zeros(len(words), dtype="<u8")
    counters = [np.zeros(len(words), dtype="<u8") for _ in range(width)]
    over = np.zeros(len(words), dtype="<u8")
    lo, hi = words + step, np.minimum(words + step + 1, planes.shape[1] - 1)
    mask = lanes
    for b in range(64):
        other = planes[b][lo]
        if shift:
            other = (other >> np.uint64(shift)) | (planes[b][hi] << np.uint64(64 - shift))
        carry = planes[b][words] ^ other
        for j in range(width):
            counters[j], carry = counters[j] ^ carry, counters[j] & carry
        over |= carry
        if b % 8 == 7:  # abandon words in which every lane is beyond the radius
            far = over.copy()
            above = np.zeros_like(over)
            equal = ~above
            for j in reversed(range(width)):
                bit = ~np.uint64(0) if (radius >> j) & 1 else np.uint64(0)
                above |= equal & counters[j] & ~bit
                equal &= ~(counters[j] ^ bit)
            far |= above
            keep = np.flatnonzero(mask & ~far)
            if b == 63:
                result[live] = mask & ~far
            elif len(keep) < len(live):
                live, lo, hi, words, mask, over = live[keep], lo[keep], hi[keep], words[keep], mask[keep], over[keep]
                counters = [c[keep] for c in counters]
        if not len(live):
            break
    return result


def _roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]], label: np.ndarray) -> np.ndarray:
    """Smallest label per component after adding edges to the forest ``label``."""
    a = np.concatenate([p[0] for p in pairs])
    b = np.concatenate([p[1] for p in pairs])
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return label
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:  # shorten chains
            up = label[label]
            if np.array_equal(up, label):
                break
            label = up


def link_buckets(keys: np.ndarray, nodes: np.ndarray, prints: np.ndarray, label: np.ndarray, radius: int = RADIUS, cut: bool = True) -> np.ndarray:
    """Join, in the forest ``label`` over nodes, those entries of equal key whose
    fingerprints are within the radius. Exact at any bucket size: a bucket over
    ``LARGE_BUCKET`` entries is first cut by radius + 1 parts of its bits in which its
    fingerprints differ (two within the radius agree in one part at least)."""
    order = np.lexsort((prints, keys))
    keys, nodes, prints = keys[order], nodes[order], prints[order]
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]]) if len(keys) else np.empty(0, int)
    size = np.diff(np.r_[start, len(keys)])
    if cut and (size > LARGE_BUCKET).any():
        for s, n in zip(start[size > LARGE_BUCKET], size[size > LARGE_BUCKET]):
            own, at = prints[s:s + n], nodes[s:s + n]
            varying = np.bitwise_or.reduce(own) & ~np.bitwise_and.reduce(own)
            bits = [b for b in range(64) if (int(varying) >> b) & 1]
            for part in np.array_split(np.array(bits, dtype=np.uint64), radius + 1):
                sub = np.zeros(n, dtype="<u8")
                for j, b in enumerate(part):
                    sub |= ((own >> b) & np.uint64(1)) << np.uint64(j)
                label = link_buckets(sub, at, own, label, radius, cut=False)
        small = np.repeat(size <= LARGE_BUCKET, size)
        return link_buckets(keys[small], nodes[small], prints[small], label, radius, cut=False)
    many = np.repeat(size > 1, size)
    if not many.any():
        return label
    keys, nodes, prints = keys[many], nodes[many], prints[many]
    planes, pairs, held, k = bit_planes(prints), [], 0, 1
    while True:
        if k >= len(keys):
            break
        same = np.zeros(planes.shape[1] * 64, dtype=bool)
        np.equal(keys[k:], keys[:-k], out=same[:len(keys) - k])
        lanes = np.packbits(same, bitorder="little").view("<u8")
        words = np.flatnonzero(lanes)
        if not len(words):
            break
        hit = within_radius(planes, k, lanes[words], words, radius)
        some = np.flatnonzero(hit)
        if len(some):
            bit = np.unpackbits(hit[some].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            w, lane = np.nonzero(bit)
            i = words[some][w] * 64 + lane
            pairs.append((nodes[i], nodes[i + k]))
            held += len(i)
        if held > 1_000_000:
            label, pairs, held = _roots(len(label), pairs, label), [], 0
        k += 1
    return _roots(len(label), pairs, label) if pairs else label


def _blocks(radius: int) -> list[tuple[int, int]]:
    n = radius + 2
    cuts = [64 * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _bits(at: int, n: int) -> Column:
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << n) - 1))


def _joined(pieces: list[tuple[int, int]]) -> Column:
    """The bits of some (start, width) pieces side by side."""
    out = _bits(*pieces[0])
    for at, n in pieces[1:]:
        out = F.shiftleft(out, n).bitwiseOR(_bits(at, n))
    return out


def _rest_parts(blocks: list[tuple[int, int]], used: tuple[int, ...], radius: int) -> list[list[tuple[int, int]]]:
    """The bits outside the ``used`` blocks as radius + 1 lists of (start, width) pieces."""
    free = [at + x for i, (at, n) in enumerate(blocks) if i not in used for x in range(n)]
    cuts = [len(free) * i // (radius + 1) for i in range(radius + 2)]
    parts = []
    for low, high in zip(cuts, cuts[1:]):
        pieces: list[tuple[int, int]] = []
        for bit in free[low:high]:
            if pieces and sum(pieces[-1]) == bit:
                pieces[-1] = (pieces[-1][0], pieces[-1][1] + 1)
            else:
                pieces.append((bit, 1))
        parts.append(pieces)
    return parts


def bucketed(prints: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET) -> DataFrame:
    """(fp, t, k, s): the buckets (t, k, s) of each distinct fingerprint; t is the pair of blocks, k its
    bits. Two within the radius share one at least.

    A bucket (t, k) of over ``hot`` fingerprints is dealt again before any task holds it: within
    the radius, two of its fingerprints agree in one of radius + 1 parts of their other bits, so each
    goes to one bucket per part. At radius 2, 32 bits and a part of 10 or 11 are then fixed, so no
    bucket can hold more than 2^22 of them, however many texts share a passage.
    """
    spark, blocks = prints.sparkSession, _blocks(radius)
    pairs = list(combinations(range(len(blocks)), 2))
    keys = [F.struct(F.lit(t).alias("t"), _joined([blocks[i], blocks[j]]).alias("k")) for t, (i, j) in enumerate(pairs)]
    dealt = prints.select("fp", F.explode(F.array(*keys)).alias("x")).select("fp", "x.t", "x.k")
    crowded = checkpoint(dealt.groupBy("t", "k").agg(F.count("*").alias("n")).where(F.col("n") > hot)
                         .select(F.col("t").alias("ht"), F.col("k").alias("hk")))
    n_hot = crowded.count()
    whole = F.lit(-1).cast("long")
    if not n_hot:
        return dealt.withColumn("s", whole)
    again = F.lit(None)
    for t, used in reversed(list(enumerate(pairs))):
        parts = _rest_parts(blocks, used, radius)
        own = F.array(*[F.shiftleft(_joined(p), 2 + radius).bitwiseOR(F.lit(i)) for i, p in enumerate(parts)])
        again = F.when(F.col("t") == t, own).otherwise(again)
    known = F.broadcast(crowded) if n_hot <= SMALL_TABLE_ROWS else crowded
    marked = dealt.join(known, (F.col("t") == F.col("ht")) & (F.col("k") == F.col("hk")), "left")
    return marked.select("fp", "t", "k", F.explode(F.when(F.col("ht").isNull(), F.array(whole)).otherwise(again)).alias("s"))


def links(prints: DataFrame, radius: int = RADIUS, hot: int = HOT_BUCKET) -> DataFrame:
    """Spanning links (a, b) among distinct fingerprints (column fp) within the radius."""
    spark = prints.sparkSession
    n_parts = partitions_for(spark, prints.count() * len(list(combinations(_blocks(radius), 2))), FINGERPRINTS_PER_TASK)
    dealt = bucketed(prints, radius, hot).repartition(n_parts, "t", "k", "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[np.asarray(b.column(i)) for i in range(4)] for b in batches if b.num_rows]
        if got:
            fp, t, k, s = (np.concatenate(x) for x in zip(*got))
            fp = fp.astype("<i8").view("<u8")
            distinct, nodes = np.unique(fp, return_inverse=True)
            label = np.arange(len(distinct))
            # one number per bucket of the table: its place in the order of (k, s)
            for table in np.unique(t):
                own = t == table
                order = np.lexsort((s[own], k[own]))
                ks, ss = k[own][order], s[own][order]
                new = np.r_[True, (ks[1:] != ks[:-1]) | (ss[1:] != ss[:-1])]
                bucket = np.empty(len(order), dtype=np.int64)
                bucket[order] = np.cumsum(new)
                label = link_buckets(bucket, nodes[own], fp[own], label, radius)
            away = np.flatnonzero(label != np.arange(len(label)))
            for at in range(0, len(away), 100_000):
                i = away[at:at + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array(distinct[i].view("<i8")), pa.array(distinct[label[i]].view("<i8"))], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def simhash_groups(fingerprinted: DataFrame, id_col: str = "id", fp_col: str = "fp", radius: int = RADIUS) -> DataFrame:
    """(fp, root, first_id) for every distinct fingerprint: the component's smallest
    fingerprint (as stored) and its smallest document id."""
    prints = checkpoint(fingerprinted.groupBy(F.col(fp_col).alias("fp")).agg(F.min(id_col).alias("low")))
    roots = components(links(prints.select("fp"), radius), "a", "b")
    rooted = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min("low").alias("first_id"))
    return rooted.join(first, "root").select("fp", "root", "first_id")


def simhash_near_dups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``."""
    prints = checkpoint(_fingerprints(df, id_col, text_col, shingle))
    groups = simhash_groups(prints, "id", "fp", radius)
    return prints.join(groups, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first_id").alias("component_id"))


def _row_hash(df: DataFrame) -> list[Column]:
    """Two hashes of a whole row (map columns aside), for telling rows of one id apart."""
    own = [F.col(f"`{f.name}`") for f in df.schema.fields if "map<" not in f.dataType.simpleString()]
    return [F.xxhash64(*[c.isNull() for c in own], *own).alias("__h1"), F.hash(*reversed(own), F.lit(1)).alias("__h2")]


def keep_first(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Rows of ``df`` with one document of each component left: that of the smallest id. Of
    rows that share this id, the one with the smallest hash of its columns stays, whatever
    the partitions; of rows equal in all columns, one."""
    hashes = _row_hash(df)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 3):
            prints = np.fromiter((fingerprint(t.as_py(), shingle) for t in b.column(3)), dtype="<u8", count=b.num_rows)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(prints.view("<i8"))], ["h1", "h2", "id", "fp"])

    kind = df.schema[id_col].dataType.simpleString()
    narrow = df.select(*hashes, F.col(id_col).alias("id"), text_bytes(text_col).alias("t")).mapInArrow(run, f"h1 long, h2 int, id {kind}, fp long")
    prints = checkpoint(narrow)
    groups = simhash_groups(prints, "id", "fp", radius)
    first = prints.join(groups, "fp").where(F.col("id").eqNullSafe(F.col("first_id")))
    first = first.groupBy("root").agg(F.min(F.struct("h1", "h2")).alias("h")).select(F.col("h.h1").alias("__k1"), F.col("h.h2").alias("__k2"))
    wide = df.select("*", *hashes).join(first.hint("merge"), (F.col("__h1") == F.col("__k1")) & (F.col("__h2") == F.col("__k2")))
    return wide.dropDuplicates(["__h1", "__h2"]).select(*[F.col(f"`{n}`") for n in df.columns])
