"""The operators' queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import ball_trees, best_fit, byte_bpe, decontaminate, embed_dedup, fill_middle, minhash, secrets, sharding, token_output, toxicity, url_filter, warc
from .common import table

Query = Callable[[SparkSession, str], DataFrame]


def _over(op: Callable[..., DataFrame], *tables: str) -> Query:
    return lambda spark, sf_dir: op(*[table(spark, sf_dir, t) for t in tables])


QUERIES: dict[str, Query] = {
    "op1_warc_derivatives": _over(warc.op1, "pages"),
    "op2_embedding_dedup": _over(embed_dedup.op2, "embeddings"),
    "op3_stratified_shards": _over(sharding.op3, "documents"),
    "op4_url_filter": _over(url_filter.op4, "pages"),
    "op5_token_output": _over(token_output.op5, "documents"),
    "op6_secret_scan": _over(secrets.op6, "documents"),
    "op7_decontamination": _over(decontaminate.op7, "documents", "benchmark"),
    "op8_minhash_dedup": _over(minhash.op8, "documents"),
    "op9_toxicity": _over(toxicity.op9, "documents", "labels"),
    "op10_byte_bpe": _over(byte_bpe.op10, "documents"),
    "op11_best_fit_packing": _over(best_fit.op11, "documents"),
    "op12_vector_codes": _over(ball_trees.op12, "embeddings"),
    "op13_fill_middle": _over(fill_middle.op13, "documents"),
}

ORACLE_SQL: dict[str, str] = {
    "op1_warc_derivatives": warc.op1_sql(),
    "op2_embedding_dedup": embed_dedup.op2_sql(),
    "op3_stratified_shards": sharding.op3_sql(),
    "op4_url_filter": url_filter.op4_sql(),
    "op6_secret_scan": secrets.op6_sql(),
    "op7_decontamination": decontaminate.op7_sql(),
    "op12_vector_codes": ball_trees.op12_sql(),
    "op13_fill_middle": fill_middle.op13_sql(),
}
