"""Helpers shared by the training-data operators.

* every operator first renames what it needs to ``__``-prefixed columns, so extra or
  clashing columns of the caller never matter;
* intermediate results that are read more than once are cut with ``checkpoint()`` or
  written under the folder that ``spark.checkpoint.dir`` names (shared by the driver
  and all executors), never under a machine-local folder.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabprism.session import cut_lineage, ensure_checkpoint_dir

# ASCII white space, as in [\x20\x09-\x0D]; bytes.split() and bytes.strip() use the same set.
ASCII_SPACE = " \t\n\x0b\x0c\r"

LOWER_AZ = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def checkpoint(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder; survives the loss of executors."""
    return cut_lineage(df)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder (not yet made) below the shared checkpoint folder."""
    return posixpath.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def partitions_for(spark: SparkSession, total: int, each: int) -> int:
    """Partitions so that each holds about ``each`` units; at least Spark's own setting."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions", "200")), -(-int(total or 0) // each))


def text_bytes(col: str | Column) -> Column:
    """UTF-8 bytes of a text column, null as empty; Arrow then hands over ``bytes``."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit("")).cast("binary")


def sha_key(text: Column) -> Column:
    """32-byte identity of a text; null stays null, so null and '' differ."""
    return F.unhex(F.sha2(text.cast("binary"), 256))


def slices(batches: Iterable[pa.RecordBatch], column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut record batches into runs of rows of about ``limit`` bytes in one binary column,
    so that a few very long texts do not set a worker's memory. A single longer row
    stays whole."""
    for b in batches:
        start, held = 0, 0
        for i, n in enumerate(pc.binary_length(b.column(column)).to_pylist()):
            if held and held + (n or 0) > limit:
                yield b.slice(start, i - start)
                start, held = i, 0
            held += n or 0
        if start < b.num_rows:
            yield b.slice(start)


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a scratch table through the file system that holds it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def positions(df: DataFrame, parts: list[str], order: list[str], out: str) -> DataFrame:
    """``df`` plus the gapless position (from 0) of each row within its ``parts``, in
    ``order``. Rows are dealt by ranges of (parts, order), so a part that holds most rows
    is still spread over many tasks; only one row per part and task is summed up."""
    own = F.col("__seq").bitwiseAND(F.lit((1 << 33) - 1))
    dealt = (df.repartitionByRange(*parts, *order).sortWithinPartitions(*parts, *order)
             .withColumn("__seq", F.monotonically_increasing_id()))
    dealt = checkpoint(dealt.withColumn("__task", F.shiftright("__seq", 33)).withColumn("__seq", own))
    cells = dealt.groupBy(*parts, "__task").agg(F.min("__seq").alias("__low"), F.count("*").alias("__n"))
    before = Window.partitionBy(*parts).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"c.{c}")) for c in [*parts, "__task"]]
    return (dealt.alias("d").join(cells.alias("c"), on=reduce(Column.__and__, same))
            .select(*[F.col(f"d.{c}") for c in df.columns], (F.col("__before") + F.col("__seq") - F.col("__low")).alias(out)))
