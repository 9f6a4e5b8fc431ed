"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Words are maximal letter runs, A-Z lower-cased, counted over all texts. Two words are near
if one inserted, deleted or replaced code point leads from one to the other: that is so
exactly when their lengths differ by one at most and the length of the common prefix plus
that of the common suffix reaches the longer length minus one. Padded code-point matrices,
one aligned left and one right, give both lengths for all pairs of two blocks of words.

Not all words meet all words. With M the longer length, the edit lies in one of a few
windows of places; outside its window both words agree. So each word goes to one tile per
window, keyed by what stands before and after the window, once as a word of length M and
once as the shorter one. A pair that meets in several tiles counts in the first only. Tiles
of over ``HOT`` words are cut again, by every single place of their window: such a tile
cannot hold more words than there are letters, plus one. No tile has a cap, and a tile
reports per word (number of near words, best of them), never pairs.

A word's form is its near word of largest count, if that is at least ``RATIO`` times the
word's own; counts grow along forms, so the way to the root is short (pointer doubling).

Defined results: null text has no words; a null id counts as an empty string where the
planted deletions need it; repeated ids and texts count each time; ties of the largest
count go to the smallest word in code-point order; a very long text is cut into words
whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabprism.llm.common import checkpoint, partitions_for

LETTERS = "A-Za-zÀ-ÿ"
MIN_CHARS, MIN_COUNT, RATIO = 6, 5, 5
DAMAGE_PRIME = 199
HOT = 2048
BLOCK = 512  # words of a tile's side at once
CELLS = 1 << 20  # pairs of a tile batch at once
TILE_ROWS = 200_000
MAX_BROADCAST_TILES = 50_000


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_count: int = MIN_COUNT, damage: int | None = None) -> DataFrame:
    """(word, n) of the words with enough code points and occurrences. ``damage``: where this
    number divides the crc32 h of ``<id>:<word>``, the code point h % length is deleted first."""
    low = F.translate(F.coalesce(text_col, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    runs = F.regexp_extract_all(low, F.lit(f"[{LETTERS}]+"), F.lit(0))
    words = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("__id"), F.explode(runs).alias("w"))
    if damage is not None:
        h = F.crc32(F.concat("__id", F.lit(":"), "w").cast("binary"))
        at = (h % F.length("w")).cast("int")
        cut = F.concat(F.expr("substring(w, 1, at)"), F.expr("substring(w, at + 2)"))
        words = words.withColumn("h", h).withColumn("at", at).withColumn("w", F.when(F.col("h") % damage == 0, cut).otherwise(F.col("w")))
    words = words.where(F.length("w") >= min_chars)
    return words.groupBy(F.col("w").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def _windows(m: Column) -> tuple[Column, Column]:
    """Width beyond the first place, and the largest start, of the windows of length m."""
    wide = F.floor(m / 3).cast("int")
    return wide, m - 1 - wide


def tile_keys(words: DataFrame) -> DataFrame:
    """(m, a, prev, wide, pre, suf, word, n): the tiles of every word. ``a`` is the window's
    first place, ``prev`` that of the window before it (-1: none)."""
    both = words.select("word", "n", F.explode(F.array(F.length("word"), F.length("word") + 1)).alias("m"))
    wide, last = _windows(F.col("m"))
    both = both.withColumn("wide", wide).withColumn("last", last)
    both = both.withColumn("i", F.explode(F.expr("sequence(0, cast(ceil(last / (wide + 1)) AS int))")))
    both = both.withColumn("a", F.least(F.col("i") * (F.col("wide") + 1), F.col("last")))
    both = both.withColumn("prev", F.when(F.col("i") == 0, -1).otherwise((F.col("i") - 1) * (F.col("wide") + 1)))
    return both.select("m", "a", "prev", "wide", F.lit(-1).alias("place"), *_context(F.col("a"), F.col("m") - 1 - F.col("wide") - F.col("a")), "word", "n")


def _context(before: Column, after: Column) -> list[Column]:
    """The first ``before`` and the last ``after`` code points of the word."""
    word = F.col("word")
    return [F.substring(word, F.lit(1), before).alias("pre"), F.when(after > 0, F.substring(word, F.length(word) - after + 1, after)).otherwise("").alias("suf")]


KEY = ["m", "a", "place", "pre", "suf"]


def cut_hot(keys: DataFrame, hot_words: int = HOT) -> DataFrame:
    """The same keys, those of tiles over ``hot_words`` words replaced by one per place of the window."""
    hot = checkpoint(keys.groupBy(KEY).count().where(F.col("count") > hot_words).select(*[F.col(k).alias(f"h_{k}") for k in KEY]))
    n = hot.count()
    if not n:
        return keys
    same = F.lit(True)
    for k in KEY:
        same = same & (F.col(k) == F.col(f"h_{k}"))
    marked = keys.join(F.broadcast(hot) if n <= MAX_BROADCAST_TILES else hot, same, "left")
    cool = marked.where(F.col("h_m").isNull()).select(*keys.columns)
    parts = marked.where(F.col("h_m").isNotNull()).withColumn("place", F.explode(F.sequence(F.col("a"), F.col("a") + F.col("wide"))))
    return cool.unionByName(parts.select("m", "a", "prev", "wide", "place", *_context(F.col("place"), F.col("m") - 1 - F.col("place")), "word", "n"))


# ---- tiles ------------------------------------------------------------------------------


def common_ends(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common prefix lengths (tiles, s, t) of the rows of two padded matrices (tiles, s, width) and
    (tiles, t, width). Rows aligned right and turned round give suffixes."""
    alive = np.ones((left.shape[0], left.shape[1], right.shape[1]), dtype=bool)
    total = np.zeros(alive.shape, dtype=np.uint16)
    for c in range(left.shape[2]):
        alive &= (left[:, :, None, c] == right[:, None, :, c]) & (left[:, :, None, c] != 0)
        if not alive.any():
            break
        total += alive
    return total


def near(ahead: tuple[np.ndarray, np.ndarray], size: tuple[np.ndarray, np.ndarray], back: tuple[np.ndarray, np.ndarray],
         rule: tuple[np.ndarray, ...]) -> np.ndarray:
    """Mask (tiles, s, t) of the pairs that are one edit apart, one side has the tile's length
    M, and no earlier window or place of the pair takes them. rule: per tile M, prev, wide, a, place."""
    m, prev, wide, a, place = (x[:, None, None].astype(np.int32) for x in rule)
    long = np.maximum(size[0][:, :, None], size[1][:, None, :]).astype(np.int32)
    some = (size[0][:, :, None] > 0) & (size[1][:, None, :] > 0) & (long == m)
    prefix, suffix = common_ends(*ahead).astype(np.int32), common_ends(*back).astype(np.int32)
    same = (size[0][:, :, None] == size[1][:, None, :]) & (prefix == long)
    earliest = m - 1 - suffix  # first place where the edit may be
    taken = (prev >= 0) & (prev >= earliest - wide) | (place > a) & (place - 1 >= earliest)
    return some & ~same & (prefix + suffix >= long - 1) & ~taken


class _Tiles:
    """Tiles of one batch: words sorted by tile, as numbers of their distinct words."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.size = np.fromiter(map(len, words), dtype=np.int32, count=len(words))
        width = int(self.size.max(initial=1))
        points = np.frombuffer("".join(words).encode("utf-32-le"), dtype="<u4")
        # Dense numbers for the code points met (0 pads), so that a cell is one or two bytes.
        alphabet, dense = np.unique(points, return_inverse=True)
        kind = np.uint8 if len(alphabet) < 255 else np.uint16 if len(alphabet) < 65_535 else np.uint32
        there = np.arange(width) < self.size[:, None]
        self.ahead = np.zeros((len(words), width), dtype=kind)
        self.ahead[there] = dense + 1
        self.back = np.zeros_like(self.ahead)
        ends = np.cumsum(self.size)
        self.back[there] = dense[np.repeat(2 * ends - self.size, self.size) - 1 - np.arange(len(points))] + 1
        # Better words have smaller numbers: larger count, then code-point order (words come sorted).
        self.rank = np.empty(len(words), dtype=np.int64)
        self.rank[np.lexsort((np.arange(len(words)), -counts))] = np.arange(len(words))
        self.n_near = np.zeros(len(words), dtype=np.int64)
        self.best = np.full(len(words), len(words), dtype=np.int64)

    def compare(self, x: np.ndarray, y: np.ndarray, rule: tuple[np.ndarray, ...], both: bool) -> None:
        """Blocks x (tiles, s) and y (tiles, t) of word numbers, -1 pads; ``both``: y's words hear of x's too."""
        size = [np.where(z >= 0, self.size[z], 0) for z in (x, y)]
        width = max(int(size[0].max(initial=0)), int(size[1].max(initial=0)))
        hit = near((self.ahead[x, :width], self.ahead[y, :width]), tuple(size), (self.back[x, :width], self.back[y, :width]), rule)
        for own, other, mask in ((x, y, hit), (y, x, hit.transpose(0, 2, 1)))[:1 + both]:
            some = mask.any(axis=2)
            np.add.at(self.n_near, own[some], mask.sum(axis=2)[some])
            ranks = np.where(mask, self.rank[other][:, None, :], len(self.rank)).min(axis=2)
            np.minimum.at(self.best, own[some], ranks[some])


def _tile_batch(number: np.ndarray, words: list[str], counts: np.ndarray, tile: np.ndarray, rules: np.ndarray) -> _Tiles:
    """Compare all pairs inside each tile; ``number`` is sorted by ``tile``, one row of ``rules`` a tile."""
    own = _Tiles(words, counts)
    start = np.flatnonzero(np.r_[True, tile[1:] != tile[:-1]])
    size = np.diff(np.r_[start, len(tile)])
    low = 1
    while low < size.max(initial=0):  # tiles of like size are padded to the largest of them
        high = min(2 * low, BLOCK)
        pick = np.flatnonzero((size > low) & (size <= high))
        for at in range(0, len(pick), max(1, CELLS // (high * high))):
            some = pick[at:at + max(1, CELLS // (high * high))]
            place = np.arange(high) < size[some][:, None]
            x = np.full(place.shape, -1)
            x[place] = number[(start[some][:, None] + np.arange(high))[place]]
            own.compare(x, x, tuple(rules[some].T), both=False)
        if high == BLOCK:
            break
        low = high
    for t in np.flatnonzero(size > BLOCK):
        blocks = [number[s:min(s + BLOCK, start[t] + size[t])][None, :] for s in range(start[t], start[t] + size[t], BLOCK)]
        for i, x in enumerate(blocks):
            own.compare(x, x, tuple(rules[t:t + 1].T), both=False)
            for y in blocks[:i]:
                own.compare(x, y, tuple(rules[t:t + 1].T), both=True)
    return own


def near_words(words: DataFrame, hot_words: int = HOT) -> DataFrame:
    """(word, n_near, form, form_n) of the words (word, n) that have near words: their number
    and the best of them."""
    keys = cut_hot(tile_keys(words), hot_words)
    parts = partitions_for(words.sparkSession, 10 * words.count(), TILE_ROWS)
    dealt = keys.repartition(parts, *KEY).sortWithinPartitions(*KEY).select(*KEY, "prev", "wide", "word", "n")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        rows = 0

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            """Tiles that have all of their rows; the last one may go on."""
            nonlocal rows
            table = pa.concat_tables(held).combine_chunks()
            held.clear()
            differ = np.zeros(table.num_rows, dtype=bool)
            differ[:1] = True
            for k in KEY:
                col = table.column(k).combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)
                differ[1:] |= col[1:] != col[:-1]
            start = np.flatnonzero(differ)
            if not last:
                held.append(table.slice(start[-1]))
                table, start = table.slice(0, start[-1]), start[:-1]
            rows = sum(t.num_rows for t in held)
            if not len(start):
                return
            text = table.column("word").combine_chunks()
            coded = text.dictionary_encode()
            order = pc.sort_indices(coded.dictionary).to_numpy()
            distinct = coded.dictionary.take(pa.array(order))
            number = np.argsort(order)[coded.indices.to_numpy(zero_copy_only=False)]
            counts = np.empty(len(order), dtype=np.int64)
            counts[number] = table.column("n").to_numpy()
            rules = np.stack([table.column(c).to_numpy()[start] for c in ("m", "prev", "wide", "a", "place")], axis=1)
            tile = np.repeat(np.arange(len(start)), np.diff(np.r_[start, table.num_rows]))
            own = _tile_batch(number, distinct.to_pylist(), counts, tile, rules)
            some = np.flatnonzero(own.n_near)
            best = np.argsort(own.rank)[own.best[some]]
            yield pa.RecordBatch.from_arrays([distinct.take(pa.array(some)), pa.array(own.n_near[some]), distinct.take(pa.array(best)), pa.array(counts[best])],
                                             ["word", "n_near", "form", "form_n"])

        for b in batches:
            if b.num_rows:
                held.append(pa.Table.from_batches([b]))
                rows += b.num_rows
                if rows >= TILE_ROWS:
                    yield from flush(False)
        if held:
            yield from flush(True)

    found = dealt.mapInArrow(run, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("best")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root): from each word of (word, form) along forms to the last. Each round doubles the way."""
    now = checkpoint(forms.select("word", F.col("form").alias("root")))
    while True:
        up = now.select(F.col("word").alias("w"), F.col("root").alias("r"))
        then = checkpoint(now.join(up, F.col("root") == F.col("w"), "left").select("word", F.coalesce("r", "root").alias("root"), F.col("r").isNotNull().alias("moved")))
        if not then.where("moved").limit(1).count():
            return then.select("word", "root")
        now = then.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, hot_words: int = HOT) -> DataFrame:
    """One row per word of (word, n): ``form`` (null if none), ``root``, ``n``, ``n_near``, ``form_n``."""
    words = checkpoint(words)
    close = near_words(words, hot_words).withColumnRenamed("word", "w")
    chosen = F.col("form_n") >= ratio * F.col("n")
    judged = checkpoint(words.join(close, F.col("word") == F.col("w"), "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(chosen, F.col("form")).alias("form"), F.when(chosen, F.col("form_n")).alias("form_n")))
    ends = roots(judged.where(F.col("form").isNotNull())).withColumnRenamed("word", "w")
    return judged.join(ends, F.col("word") == F.col("w"), "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", damage: int | None = None) -> DataFrame:
    """Spelling variants among the words of all texts."""
    return variants(word_counts(df, id_col, text_col, damage=damage))
