"""From raw documents to token ids, in five stages.

``run`` applies the stages in order; each gets what the one before kept, as written
Parquet, and all but the last return the columns of ``documents``:

1. quality rules: documents that the base rules or the divergence rules reject go;
2. line dedup: lines that many documents share stay in the last of them only
   (``n_chars`` then counts the text that is left);
3. SimHash near-dedup: the document with the smallest id of each component stays;
4. benchmark decontamination: documents that hold a test item go;
5. BPE encoding: ids of what is left, decoded again and compared with the text.

Parameters are those of the operators' contracts. Documents with null text fail the first
stage; ids may be null or repeated (see the operators); extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.llm import bpe_dp, decontaminate, divergence, line_runs, simhash
from tabprism.llm.common import remove, shared_folder
from tabprism.sources.tables import read_table

TOKENIZER = "byte_bpe_50k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return divergence.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many of them share."""
    out = line_runs.without_common_lines(docs)
    if "n_chars" in out.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind)).select(*docs.columns)
    return out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark."""
    return decontaminate.without_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def bpe_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, number of ids, digests of the ids and of the text they decode to."""
    import public_tokenizers
    out = bpe_dp.encode_decode(docs, public_tokenizers.path(TOKENIZER))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe_dp.ids_sha256(F.col("ids")).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("BPE encoding and decoding", bpe_encoding),
]

# SimHash components and BPE ids have no SQL form; tests/llm/test_pipeline.py holds the
# rows against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; each result is written and reread, and
    removed when the next one is there. The last one stays: the returned rows come from it."""
    folder = shared_folder(spark, "corpus-pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = f"{folder}/stage-{k}"
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if k:
            remove(spark, f"{folder}/stage-{k - 1}")
    return docs
