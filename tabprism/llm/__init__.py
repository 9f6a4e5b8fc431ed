"""Training-data operators: tokens, shards, quality, licences, WARC, dedup, decontamination.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.
"""
