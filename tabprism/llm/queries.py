"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabprism.llm import bpe_dp, bpe_matrix, bwt_dedup, conversations, decontaminate, divergence, license_rules, line_runs, lpt_shards, mph_index, simhash, spelling, warc_derive
from tabprism.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_file(name: str) -> str:
    """Place of an installed public tokenizer file; the same on every machine of a cluster."""
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_mph_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to shards and read back through the index."""
    docs = read_table(spark, sf_dir, "documents")
    index = mph_index.write_index(docs, tokenizer_file("word_bpe_49k.json"), end_id=2)
    out = mph_index.lookup(index, docs.select("doc_id"))
    return out.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op2_lpt_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents dealt to 8 shards of near equal bytes, equal texts together."""
    out = lpt_shards.lpt_shards(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op3_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base figures, distances to the language reference and verdict for all documents."""
    return divergence.quality(read_table(spark, sf_dir, "documents"))


def op4_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence sentences and licences of all documents."""
    return license_rules.scan_licenses(read_table(spark, sf_dir, "documents"))


def op5_warc_derive(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and plain-text records of all pages."""
    out = warc_derive.derive(warc_derive.responses(read_table(spark, sf_dir, "pages")))
    return out.select(F.col("id").alias("page_id"), "warc_type", "record_id", "refers_to", "target_uri", "date", "content_type",
                      "block_digest", "payload_digest", "n_links", "header", F.col("content").cast("string").alias("content"))


def op6_bpe_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents by prefix dynamic programming, and back."""
    out = bpe_dp.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))
    return out.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), bpe_dp.ids_sha256(F.col("ids")).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op7_bwt_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the 100-byte strings that start earlier too."""
    out = bwt_dedup.remove_repeats(read_table(spark, sf_dir, "documents"))
    n_removed = (F.col("n_bytes") - F.octet_length("kept")).cast("long")
    return out.select("doc_id", "n_bytes", n_removed.alias("n_removed"), (F.size("spans") / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and benchmark item whose question and answer it holds."""
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline.py over the documents."""
    return corpus_pipeline.run(spark, sf_dir)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash near-duplicate components of all documents."""
    return simhash.simhash_near_dups(read_table(spark, sf_dir, "documents"))


def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 40 or more code points in 5 or more documents kept in the last one only."""
    return line_runs.dedup_lines(read_table(spark, sf_dir, "documents")).drop("kept_text")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents, with planted deletions."""
    return spelling.spelling_groups(read_table(spark, sf_dir, "documents"), damage=spelling.DAMAGE_PRIME)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cheapest repair of every damaged conversation."""
    rows, copies = conversations.damaged(read_table(spark, sf_dir, "conversations"))
    return conversations.repair(rows, copies=copies)


def op13_bpe_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE ids of all documents by merge rounds over padded matrices, and back."""
    import public_tokenizers
    out = bpe_matrix.encode_decode(read_table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_COUNTS = ", ".join(f"length(t) - length(regexp_replace(t, {_quoted(run)}, '', 'g')) AS k_{name}" for name, run in divergence.CLASSES.items())
_BINS = [f"k_{b}" for b in divergence.BINS]
_SUMS = ", ".join(f"sum({b})::DOUBLE / sum(length(t)) AS q_{b}" for b in _BINS)
_CHAR_SUM = " + ".join(
    f"CASE WHEN {b} > 0 THEN {b} / n * log2(2 * {b} / n / ({b} / n + q_{b})) + CASE WHEN q_{b} > 0 THEN q_{b} * log2(2 * q_{b} / ({b} / n + q_{b})) ELSE 0 END ELSE q_{b} END"
    for b in _BINS)

OP3_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
words AS (SELECT rid, lang, generate_subscripts(ws, 1) AS pos, unnest(ws) AS w
          FROM (SELECT rid, lang, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS ws FROM docs)),
spans AS (SELECT rid, pos, list(w) OVER (PARTITION BY rid ORDER BY pos ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING) AS win FROM words),
twice AS (SELECT rid, pos, count(*) OVER (PARTITION BY rid, win) AS times FROM spans WHERE len(win) = 8),
covered AS (SELECT rid, sum(least(8, coalesce(next - pos, 8))) AS n FROM
            (SELECT rid, pos, lead(pos) OVER (PARTITION BY rid ORDER BY pos) AS next FROM twice WHERE times > 1) GROUP BY rid),
wordy AS (SELECT rid, count(*) AS n_words, sum(length(w))::BIGINT AS word_chars FROM words GROUP BY rid),
text_lines AS (SELECT rid, unnest(string_split(t, chr(10))) AS line FROM docs),
dups AS (SELECT rid, count(*) - count(DISTINCT line) AS n_dup_lines FROM text_lines
         WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY rid),
base AS (SELECT d.rid, doc_id, lang, t, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0) AS word_chars,
                length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
                coalesce(c.n, 0)::BIGINT AS n_repeat_words
         FROM docs d LEFT JOIN wordy USING (rid) LEFT JOIN dups USING (rid) LEFT JOIN covered c USING (rid)),
classed AS (SELECT *, {" + ".join(_BINS[:-2])} + k_space AS known, length(t) - known AS k_other FROM
            (SELECT *, {_COUNTS}, length(t) - word_chars AS k_space FROM base)),
char_ref AS (SELECT lang AS char_lang, {_SUMS} FROM classed GROUP BY lang),
totals AS (SELECT lang AS total_lang, count(*) AS total FROM words GROUP BY lang),
common AS (SELECT lang AS common_lang, w AS cw, count(*)::DOUBLE / total AS q
           FROM words JOIN totals ON lang IS NOT DISTINCT FROM total_lang
           GROUP BY lang, w, total HAVING count(*) >= {divergence.COMMON_SHARE} * total),
mass AS (SELECT common_lang AS mass_lang, sum(q) AS all_q FROM common GROUP BY common_lang),
counted AS (SELECT rid, lang, w AS lw, count(*)::DOUBLE AS c FROM words GROUP BY ALL),
shares AS (SELECT rid, sum(p * log2(2 * p / (p + q)) + q * log2(2 * q / (p + q))) AS d, sum(p) AS sp, sum(q) AS sq
           FROM (SELECT rid, c / n_words AS p, q FROM counted JOIN wordy USING (rid)
                 JOIN common ON lang IS NOT DISTINCT FROM common_lang AND lw = cw) GROUP BY rid),
joined AS (SELECT *, length(t)::DOUBLE AS n, 1 - coalesce(sp, 0) AS po, greatest(1 - coalesce(all_q, 0), 0) AS qo,
                  coalesce(d, 0) + coalesce(all_q, 0) - coalesce(sq, 0) AS ds
           FROM classed LEFT JOIN char_ref ON lang IS NOT DISTINCT FROM char_lang
           LEFT JOIN totals ON lang IS NOT DISTINCT FROM total_lang
           LEFT JOIN mass ON lang IS NOT DISTINCT FROM mass_lang LEFT JOIN shares USING (rid)),
summed AS (SELECT *, {_CHAR_SUM} AS char_sum,
                  ds + CASE WHEN po > 1e-12 THEN po * log2(2 * po / (po + qo)) + CASE WHEN qo > 0 THEN qo * log2(2 * qo / (po + qo)) ELSE 0 END ELSE qo END AS word_sum
           FROM joined),
measured AS (SELECT *, n_words < {divergence.MIN_WORDS} OR 100 * n_repeat_words > {divergence.MAX_REPEAT_PERCENT} * n_words AS base_failed,
                    CASE WHEN total >= {divergence.MIN_REFERENCE_WORDS} AND n_words > 0 THEN round(sqrt(greatest(char_sum / 2, 0)), 6) END AS char_distance,
                    CASE WHEN total >= {divergence.MIN_REFERENCE_WORDS} AND n_words >= {divergence.MIN_WORDS_FOR_WORDS} THEN round(sqrt(greatest(word_sum / 2, 0)), 6) END AS word_distance
             FROM summed)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR (n_words > 0 AND (coalesce(char_distance > {divergence.CHAR_LIMIT[0]} + {divergence.CHAR_LIMIT[1]} / sqrt(n_words), false)
                            OR coalesce(word_distance > {divergence.WORD_LIMIT[0]} + {divergence.WORD_LIMIT[1]} / sqrt(n_words), false)))) AS kept,
       char_distance, word_distance
FROM measured
"""

_TAKEN = "ids"
for _name, _ids in license_rules.RULES:
    _TAKEN = f"replace({_TAKEN}, {_quoted(''.join(f'<{i}>' for i in _ids))}, {_quoted('{' + _name + '}')})"

OP4_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, lower(coalesce(text, '')) AS t FROM documents),
known(sentence, sid) AS (VALUES {", ".join(f"({_quoted(k)}, {_quoted(v)})" for k, v in license_rules.SENTENCES.items())}),
cut AS (SELECT rid, doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS part
        FROM (SELECT rid, doc_id, string_split(regexp_replace(t, '[.!?;:][ \\t\\r]+', chr(10), 'g'), chr(10)) AS parts FROM docs)),
plain AS (SELECT rid, doc_id, pos, trim(regexp_replace(part, '[^\\p{{L}}\\p{{N}}.]+', ' ', 'g'), ' .') AS s FROM cut),
gathered AS (SELECT rid, doc_id, count(*) FILTER (s <> '') AS n_sentences, count(sid) AS n_known,
                    coalesce(string_agg('<' || sid || '>', '' ORDER BY pos), '') AS ids
             FROM plain LEFT JOIN known ON s = sentence GROUP BY rid, doc_id),
taken AS (SELECT *, {_TAKEN} AS taken FROM gathered)
SELECT doc_id, n_sentences, n_known, ids AS sentence_ids,
       array_to_string(regexp_extract_all(taken, '\\{{([^}}]+)\\}}', 1), ',') AS licenses,
       regexp_replace(taken, '\\{{[^}}]+\\}}', '', 'g') AS left_over
FROM taken
"""

OP10_SQL = """
WITH lines AS (
  SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
  SELECT doc_id, pos, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS last FROM (SELECT DISTINCT doc_id, key FROM keyed WHERE length(key) >= 40)
  GROUP BY key HAVING count(*) >= 5
), judged AS (
  SELECT doc_id, pos, line, coalesce(doc_id <> last, false) AS gone FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


def queries() -> dict[str, Query]:
    own = (op1_mph_index, op2_lpt_shards, op3_divergence, op4_license_rules, op5_warc_derive, op6_bpe_dp, op7_bwt_dedup, op8_decontaminate, op9_simhash,
           op10_line_runs, op11_spelling, op12_conversation_repair, op13_bpe_matrix, pipeline)
    return {f.__name__: f for f in own}


def oracle_sql() -> dict[str, str]:
    return {"op3_divergence": OP3_SQL, "op4_license_rules": OP4_SQL, "op10_line_runs": OP10_SQL}
