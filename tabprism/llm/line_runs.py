"""Line deduplication over levelled sorted runs of line hashes.

A line's key is the line with ASCII white space stripped at both ends and A-Z
lower-cased; the index holds 128-bit hashes of the keys that are long enough. A run is a
table sorted by hash: (key, n documents, last document id). Each batch adds one run to
level 0; ``fanout`` runs of a level are merged into one run of the next, so a key is
rewritten a logarithmic number of times. Lines whose key has ``min_docs`` documents go,
except in the largest document id that holds it. Both facts are known only when all batches
are in, so the batches are not cleaned one by one: after the last one all runs become one
table, which is joined once with the lines of all batches. The merges group by key with a
shuffle and do not use the runs' order.

Defined results: null text = one empty line; a row is a document (repeated rows count
each; an id that repeats keeps the line in all its rows); null ids count as documents,
are never the largest while another id holds the line, and keep lines that only null ids
hold; other columns are ignored or passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.llm.common import LOWER_AZ, remove, shared_folder, slices, text_bytes

MIN_CHARS, MIN_DOCS = 40, 5
FANOUT, BATCHES = 4, 6


def line_key(line: bytes, min_chars: int = MIN_CHARS) -> bytes | None:
    """Hash of a line's key, or None if the key is too short to count."""
    key = line.strip()
    if len(key) < min_chars or not (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
        return None
    return xxhash.xxh3_128_digest(key.translate(LOWER_AZ))


def line_keys(df: DataFrame, id_col: str, text_col: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """(id, row, key): each long line's hash once per document; ``row`` identifies the text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            at, keys = [], []
            for i, text in enumerate(b.column(2)):
                own = {line_key(line, min_chars) for line in text.as_py().split(b"\n")} - {None}
                keys += own
                at += [i] * len(own)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(keys, pa.binary())], ["id", "row", "key"])

    kind = df.schema[id_col].dataType.simpleString()
    return _rows(df, id_col, text_col).mapInArrow(run, f"id {kind}, row long, key binary")


def _rows(df: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("row"), text_bytes(text_col).alias("text"), *more)


class LineRuns:
    """The index: ``levels[k]`` lists the runs of level k, newest last."""

    def __init__(self, spark: SparkSession, folder: str | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.folder = folder or shared_folder(spark, "line-runs")
        self.levels: list[list[str]] = []
        self._made = 0

    def _write(self, run: DataFrame, level: int) -> None:
        self._made += 1
        path = f"{self.folder}/level{level}-run{self._made}"
        run.sortWithinPartitions("key").write.parquet(path)
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(path)

    def _merged(self, paths: list[str]) -> DataFrame:
        return self.spark.read.parquet(*paths).groupBy("key").agg(F.sum("n").alias("n"), F.max("last").alias("last"))

    def add(self, keys: DataFrame) -> None:
        """Add a batch's (id, key) rows, one for each document that holds the key, as a
        run; then merge every level that is full."""
        self._write(keys.groupBy("key").agg(F.count("*").alias("n"), F.max("id").alias("last")), 0)
        level = 0
        while level < len(self.levels) and len(self.levels[level]) >= self.fanout:
            full = self.levels[level]
            self._write(self._merged(full), level + 1)
            self.levels[level] = []
            for path in full:
                remove(self.spark, path)
            level += 1

    def compact(self) -> None:
        """Merge all runs into one, a level above."""
        paths = [p for level in self.levels for p in level]
        if len(paths) > 1:
            self._write(self._merged(paths), len(self.levels))
            self.levels = [[] for _ in self.levels[:-1]] + self.levels[-1:]
            for path in paths:
                remove(self.spark, path)

    def drops(self, keys: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
        """Those (id, row, key) rows whose lines go, by what the runs know so far. The runs
        are merged to a table first: a join of two plain tables is one whose large
        partitions Spark can split, so a line that most documents hold is no single task."""
        self.compact()
        if not self._made:
            return keys.limit(0)
        common = self.spark.read.parquet(self.levels[-1][-1]).where(F.col("n") >= min_docs)
        return keys.join(common, "key").where(~F.col("id").eqNullSafe(F.col("last")) & F.col("last").isNotNull()).select("id", "row", "key")


def _apply(df: DataFrame, id_col: str, text_col: str, drops: DataFrame, min_chars: int, more: list) -> DataFrame:
    """id, text without the dropped lines (bytes), n_lines, n_dropped, sha256, ``more``."""
    lost = drops.groupBy("id", "row").agg(F.collect_set("key").alias("lost")).select(F.col("id").alias("lost_id"), F.col("row").alias("lost_row"), "lost")
    rows = _rows(df, id_col, text_col, *more)
    names = rows.columns[3:]
    joined = rows.join(lost, F.col("id").eqNullSafe(F.col("lost_id")) & (F.col("row") == F.col("lost_row")), "left").select("id", "lost", "text", *names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 2):
            texts, n_lines, n_dropped, sums = [], [], [], []
            for keys, text in zip(b.column(1), b.column(2)):
                text, gone = text.as_py(), set(keys.as_py() or ())
                lines = text.split(b"\n")
                kept = [x for x in lines if line_key(x, min_chars) not in gone] if gone else lines
                if len(kept) < len(lines):
                    text = b"\n".join(kept)
                texts.append(text)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                sums.append(hashlib.sha256(text).hexdigest())
            new = [pa.array(texts, pa.binary()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), pa.array(sums, pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *new, *b.columns[3:]], ["id", "text", "n_lines", "n_dropped", "kept_sha256", *names])

    kinds = "".join(f", `{n}` {joined.schema[n].dataType.simpleString()}" for n in names)
    kind = df.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(run, f"id {kind}, text binary, n_lines long, n_dropped long, kept_sha256 string{kinds}")


def _decide(df: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, batches: int) -> DataFrame:
    """All rows go through the index in ``batches`` batches; then the runs decide."""
    spark = df.sparkSession
    path = shared_folder(spark, "line-keys")
    keys = line_keys(df, id_col, text_col, min_chars)
    keys.withColumn("batch", F.pmod(F.xxhash64("id", "row"), F.lit(batches))).write.partitionBy("batch").parquet(path)
    table = spark.read.schema(keys.schema.add("batch", "integer")).parquet(path)
    runs = LineRuns(spark)
    for b in range(batches):
        runs.add(table.where(F.col("batch") == b))
    return runs.drops(table, min_docs)


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """Per document: id, n_lines, n_dropped, kept text and its SHA-256."""
    drops = _decide(df, id_col, text_col, min_chars, min_docs, batches)
    out = _apply(df, id_col, text_col, drops, min_chars, [])
    return out.select(F.col("id").alias(id_col), "n_lines", "n_dropped", "kept_sha256", F.col("text").cast("string").alias("kept_text"))


def without_common_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                         min_docs: int = MIN_DOCS, batches: int = BATCHES) -> DataFrame:
    """``df`` with the same columns, the text without the dropped lines (null stays null)."""
    names = df.columns
    drops = _decide(df, id_col, text_col, min_chars, min_docs, batches)
    others = [n for n in names if n not in (id_col, text_col)]
    more = [F.struct(*[F.col(f"`{n}`") for n in others], F.col(text_col).isNull().alias("__null")).alias("rest")]
    out = _apply(df, id_col, text_col, drops, min_chars, more)
    text = F.when(~F.col("rest.__null"), F.col("text").cast("string")).alias(text_col)
    at = {id_col: F.col("id").alias(id_col), text_col: text}
    return out.select(*[at.get(n, F.col(f"rest.`{n}`").alias(n)) for n in names])
