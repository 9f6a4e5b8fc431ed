"""Benchmark decontamination with a BM25 index of the test items.

With L the words of an item, its windows in a document are 2 L words, L apart, so a copy of
the item lies whole in one of them. Weights are BM25 impacts divided by the item's own wanted
score (``MIN_SCORE`` times what its full text scores), so a window reaches the item at a sum of
1. It is then verified: the shares of the word trigrams of its question and of its answer that
the window holds must both reach ``MIN_OVERLAP``. An item of fewer words than two trigrams has
no shares that tell: the window must hold all its words in a row. An item's answer starts after
its last question mark or, without one, at its middle word. So a verdict depends on no other
item but for the collection's counts.

Windows are found by search: items of like length (their class: the next power of two) share an
index, and every training passage is a query against it. Passages are four times the class in
length and overlap by half, so each window lies in one. Block-max pruning in two exact steps: a
passage whose terms cannot reach 1 by their largest weights anywhere is skipped, then the blocks
of 16 items whose block maxima cannot reach 1; terms whose maxima together stay below
``NON_ESSENTIAL`` join only in the final scores. These bounds replace the pivoting of cursors.
All items at or above 1 are retrieved (no top-k), and their windows in the passage are judged.

The index is broadcast only while the items it holds are within ``GROUP_BYTES`` of text;
more items are cut into as many groups, each searched by all passages in turn. Collection
statistics always cover all items.

Defined results: null or wordless texts and items match nothing; ids may be null or
repeated (each row is searched, each item row is its own item) and of any type; a very long text
or item is searched whole; empty tables give no hits; other columns are ignored or passed on.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tabprism.llm.common import checkpoint, slices, text_bytes

K1, B = 1.2, 0.75
MIN_SCORE = 0.7
MIN_OVERLAP = 0.5
NON_ESSENTIAL = 0.1
BLOCK = 16
LEAST_CLASS = 64  # shorter items share an index: each index is one more search of every passage
GROUP_BYTES = 16 << 20
GRAM = 3
WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def question_and_answer(text: str) -> tuple[list[str], list[str]]:
    """Words before and after the last question mark that has words on both sides, else halves."""
    at = text.rfind("?")
    while at >= 0:
        q, a = words_of(text[:at]), words_of(text[at + 1:])
        if q and a:
            return q, a
        at = text.rfind("?", 0, at)
    own = words_of(text)
    return own[:len(own) // 2], own[len(own) // 2:]


def grams(words: list[str], n: int = GRAM) -> set[tuple[str, ...]]:
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def overlap(part: list[str], passage: list[str]) -> float:
    """Share of the part's trigrams in the passage; 1 for a part without words."""
    wanted = grams(part)
    return len(wanted & grams(passage, min(GRAM, len(part)) or GRAM)) / len(wanted) if wanted else 1.0


def in_a_row(item: list[str], passage: list[str]) -> bool:
    return any(passage[i:i + len(item)] == item for i in range(len(passage) - len(item) + 1))


def length_class(n: int) -> int:
    """The words an item of n words is reckoned with: the next power of two, ``LEAST_CLASS`` at least."""
    return max(LEAST_CLASS, 1 << max(0, n - 1).bit_length())


class ItemIndex:
    """Postings of items of one class, by term, with list and block maxima."""

    def __init__(self, rows: list[tuple[int, object, str]], postings: list[tuple[int, str, int, int]], stats: tuple[int, float]):
        """rows: (item number, id, text); postings: (number, term, tf, df)."""
        n_items, mean = stats
        rows = sorted(rows, key=lambda r: len(words_of(r[2])))  # a block's items have like weights
        self.stride = 2 * max((length_class(len(words_of(r[2]))) for r in rows), default=LEAST_CLASS)
        self.ids = [r[1] for r in rows]
        self.texts = [r[2] for r in rows]
        number = {r[0]: i for i, r in enumerate(rows)}
        length = np.array([len(words_of(t)) for t in self.texts], dtype=float)
        self.words = [len(words_of(t)) for t in self.texts]
        self.terms: dict[str, int] = {}
        at = np.array([number[p[0]] for p in postings], dtype=np.int64)
        term = np.array([self.terms.setdefault(p[1], len(self.terms)) for p in postings], dtype=np.int64)
        tf, df = (np.array([p[i] for p in postings], dtype=float) for i in (2, 3))
        impact = np.log1p((n_items - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[at] / (mean or 1)))
        self.full = np.bincount(at, weights=impact, minlength=len(rows))
        order = np.lexsort((at, term))
        self.item, self.term, self.weight = at[order], term[order], (impact / (MIN_SCORE * self.full[at]))[order]
        n = len(self.terms)
        self.first = np.searchsorted(self.term, np.arange(n + 1))
        self.top = np.zeros(n)
        np.maximum.at(self.top, self.term, self.weight)
        # Block maxima: one entry for each term and block of items it occurs in.
        self.n_blocks = max(1, math.ceil(len(rows) / BLOCK))
        entry, inverse = np.unique(self.term * self.n_blocks + self.item // BLOCK, return_inverse=True)
        self.block_top = np.zeros(len(entry))
        np.maximum.at(self.block_top, inverse, self.weight)
        self.block = entry % self.n_blocks
        self.block_first = np.searchsorted(entry // self.n_blocks, np.arange(n + 1))
        ranked = np.argsort(self.top, kind="stable")
        small = ranked[np.cumsum(self.top[ranked]) <= NON_ESSENTIAL]
        self.essential = np.ones(n, dtype=bool)
        self.essential[small] = False
        self.rest = float(self.top[small].sum())
        by_item = np.argsort(self.item, kind="stable")
        self._by_item, self._item_first = by_item, np.searchsorted(self.item[by_item], np.arange(len(rows) + 1))

    def weights_of(self, item: int) -> dict[int, float]:
        own = self._by_item[self._item_first[item]:self._item_first[item + 1]]
        return dict(zip(self.term[own].tolist(), self.weight[own].tolist()))

    def term_numbers(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))

    def search(self, ids: np.ndarray) -> list[tuple[int, int, float]]:
        """(passage, item number, weight sum) of every passage and item that reach 1."""
        pos = np.flatnonzero(ids >= 0)
        if not len(pos):
            return []
        n, blocks = len(self.terms), self.n_blocks
        piece = pos // self.stride  # passage k holds the pieces k and k + 1
        passages = int(piece[-1]) + 1
        pairs = _distinct(np.concatenate([piece * n + ids[pos], (piece[piece > 0] - 1) * n + ids[pos][piece > 0]]), passages * n)
        passage, term = np.divmod(pairs, n)
        own = self.essential[term]
        bound = np.bincount(passage[own], weights=self.top[term[own]], minlength=passages) + self.rest
        live = bound[passage] >= 1 - 1e-9
        if not live.any():
            return []
        passage, term = passage[live], term[live]
        own = self.essential[term]
        which, entry = _expand(self.block_first, term[own])
        cell, bound = _sums(passage[own][which] * blocks + self.block[entry], self.block_top[entry], passages * blocks)
        cell = cell[bound + self.rest >= 1 - 1e-9]
        if not len(cell):
            return []
        some = np.zeros(passages, dtype=bool)
        some[cell // blocks] = True
        live = some[passage]
        passage, term = passage[live], term[live]
        which, entry = _expand(self.first, term)
        hit = _among(passage[which] * blocks + self.item[entry] // BLOCK, cell, passages * blocks)
        which, entry = which[hit], entry[hit]
        found, score = _sums(passage[which] * len(self.ids) + self.item[entry], self.weight[entry], passages * len(self.ids))
        return [(int(f) // len(self.ids), int(f) % len(self.ids), float(s)) for f, s in zip(found, score) if s >= 1 - 1e-9]

    def judged(self, words: list[str], ids: np.ndarray, item: int, passage: int) -> tuple[float, float, float] | None:
        """Best (score as a share of the full score, question share, answer share) of the item's
        verified windows that lie in the passage."""
        own, weights, best = self.words[item], self.weights_of(item), None
        low, high = passage * self.stride, (passage + 2) * self.stride
        known = np.flatnonzero(np.isin(ids[low:high], list(weights))) + low
        for k in np.unique(np.r_[known // own, known // own - 1]).tolist():
            start = k * own
            if start < low or min(start + 2 * own, len(words)) > high:
                continue
            score = sum(weights[t] for t in set(ids[start:start + 2 * own].tolist()) if t in weights)
            if score < 1 - 1e-9:
                continue
            held, text = words[start:start + 2 * own], self.texts[item]
            if own < 2 * GRAM and not in_a_row(words_of(text), held):
                continue
            q, a = (overlap(part, held) for part in question_and_answer(text))
            if min(q, a) >= MIN_OVERLAP:
                best = max(best or (0.0, 0.0, 0.0), (round(score * MIN_SCORE, 6), round(q, 6), round(a, 6)))
        return best

    def hits(self, words: list[str], ids: np.ndarray | None = None) -> list[tuple[object, float, float, float]]:
        """(item id, score, question share, answer share) of the items that the words hold."""
        ids, best = self.term_numbers(words) if ids is None else ids, {}
        for passage, item, _ in self.search(ids):
            got = self.judged(words, ids, item, passage)
            if got:
                best[item] = max(best.get(item, got), got)
        return [(self.ids[item], *x) for item, x in sorted(best.items())]


class Indexes:
    """Indexes of all classes of a group of items; words are looked up once for all of them."""

    def __init__(self, parts: list[ItemIndex]):
        self.parts = parts
        self.terms: dict[str, int] = {}
        for p in parts:
            for w in p.terms:
                self.terms.setdefault(w, len(self.terms))
        self.local = [np.full(len(self.terms) + 1, -1, dtype=np.int64) for _ in parts]  # the last place is that of unknown words
        for p, own in zip(parts, self.local):
            own[[self.terms[w] for w in p.terms]] = list(p.terms.values())

    def hits(self, text: str) -> list[tuple[object, float, float, float]]:
        words = words_of(text)
        ids = np.fromiter(map(self.terms.get, words, repeat(-1)), dtype=np.int64, count=len(words))
        return [h for p, own in zip(self.parts, self.local) for h in p.hits(words, own[ids])]


DENSE = 1 << 22  # cells that are kept as an array; more are sorted instead


def _distinct(cell: np.ndarray, size: int) -> np.ndarray:
    if size > DENSE:
        return np.unique(cell)
    seen = np.zeros(size, dtype=bool)
    seen[cell] = True
    return np.flatnonzero(seen)


def _sums(cell: np.ndarray, weight: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells with a weight, and the sums of their weights."""
    if size > DENSE:
        own, inverse = np.unique(cell, return_inverse=True)
        return own, np.bincount(inverse, weights=weight)
    total = np.bincount(cell, weights=weight)
    own = np.flatnonzero(total)
    return own, total[own]


def _among(cell: np.ndarray, wanted: np.ndarray, size: int) -> np.ndarray:
    if size > DENSE:
        return np.isin(cell, wanted)
    seen = np.zeros(size, dtype=bool)
    seen[wanted] = True
    return seen[cell]


def _expand(first: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key k the entries first[k] to first[k + 1]: (position of the key, entry)."""
    n = first[keys + 1] - first[keys]
    which = np.repeat(np.arange(len(keys)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[keys], n)


def item_indexes(items: DataFrame, id_col: str = "item_id", text_col: str = "text", group_bytes: int = GROUP_BYTES) -> Iterator[Indexes]:
    """Indexes of all items, in groups of about ``group_bytes`` of text."""
    rows = checkpoint(items.select(F.monotonically_increasing_id().alias("n"), F.col(id_col).alias("id"), F.col(text_col).alias("t")).where("t IS NOT NULL"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for n, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                own = words_of(text)
                out += [(n, w, own.count(w), len(own)) for w in dict.fromkeys(own)]
            cols = list(zip(*out)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64())], ["n", "term", "tf", "size"])

    postings = checkpoint(rows.select("n", "t").mapInArrow(count, "n long, term string, tf long, size long"))
    sizes = postings.groupBy("n").agg(F.first("size").alias("size")).agg(F.count("*").alias("n"), F.avg("size").alias("mean")).first()
    if not sizes["n"]:
        return
    total = rows.agg(F.sum(F.octet_length("t"))).first()[0]
    groups = max(1, -(-total // group_bytes))
    postings = postings.join(postings.groupBy("term").agg(F.count("*").alias("df")), "term")
    for g in range(groups):
        own = F.pmod(F.xxhash64("n"), F.lit(groups)) == g
        held = [(r["n"], r["id"], r["t"]) for r in rows.where(own).orderBy("n").collect()]
        posted = [(r["n"], r["term"], r["tf"], r["df"]) for r in postings.where(own).select("n", "term", "tf", "df").collect()]
        if not posted:
            continue
        of_class: dict[int, tuple[list, list]] = {}
        number = {}
        for r in held:
            number[r[0]] = length_class(len(words_of(r[2])))
            of_class.setdefault(number[r[0]], ([], []))[0].append(r)
        for p in posted:
            of_class[number[p[0]]][1].append(p)
        yield Indexes([ItemIndex(*of_class[c], (sizes["n"], sizes["mean"])) for c in sorted(of_class) if of_class[c][1]])


def contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 item_id_col: str = "item_id", item_text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """One row per document and item that it holds: ids, score, question and answer shares."""
    doc_kind, item_kind = docs.schema[id_col].dataType.simpleString(), items.schema[item_id_col].dataType.simpleString()
    schema = f"{id_col} {doc_kind}, {item_id_col} {item_kind}, score double, question_share double, answer_share double"
    spark, out, arrow_kind = docs.sparkSession, None, to_arrow_type(items.schema[item_id_col].dataType)
    for index in item_indexes(items, item_id_col, item_text_col, group_bytes):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value
            for b in slices(batches, 1):
                at, hits = [], []
                for i, t in enumerate(b.column(1)):
                    found = own.hits(t.as_py().decode("utf-8", "replace"))
                    at += [i] * len(found)
                    hits += found
                yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array([h[0] for h in hits], arrow_kind),
                                                  *(pa.array([h[k] for h in hits], pa.float64()) for k in (1, 2, 3))],
                                                 [id_col, item_id_col, "score", "question_share", "answer_share"])

        found = docs.select(F.col(id_col), text_bytes(text_col).alias("t")).mapInArrow(run, schema)
        out = found if out is None else out.unionAll(found)
    return spark.createDataFrame([], schema) if out is None else out


def _leaks(shared):
    """Arrow UDF: whether a text holds an item of the broadcast index."""
    @F.arrow_udf("boolean")
    def leaks(texts: pa.Array) -> pa.Array:
        return pa.array([bool(shared.value.hits((t.as_py() or b"").decode("utf-8", "replace"))) for t in texts], pa.bool_())
    return leaks


def without_leaks(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text", group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Rows of ``docs`` that hold no item, with their own columns."""
    for index in item_indexes(items, item_id_col, item_text_col, group_bytes):
        docs = docs.where(~_leaks(docs.sparkSession.sparkContext.broadcast(index))(text_bytes(text_col)))
    return docs
