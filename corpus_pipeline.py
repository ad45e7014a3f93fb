"""A corpus pipeline of five stages, each by one operator of ``skyledger.llm``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows that the stage before it
kept; ``run`` writes each stage's result as Parquet in the shared folder and reads it again.
All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import byte_bpe, decontaminate, minhash, secrets, toxicity
from skyledger.llm.common import discard, table, written, written_alone


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str, threshold: float = 0.7) -> DataFrame:
    """Documents that score below ``threshold`` stay."""
    model = toxicity.learn(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_texts(docs, model, keep=tuple(docs.columns)).where(F.col("score") < threshold).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity 0.8) the document of least id stays.

    Rows are compared and dropped by a written key of their own, so those with a null or shared id are judged like all
    others; in a group a null id comes last, and of equal ids one row stays. Texts without words stand alone and stay.
    """
    row = secrets.free_name(docs, "row")
    keyed = written(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    judged = minhash.near_duplicates(keyed, id_col=row)
    order = F.struct(F.col("id").isNull().alias("none"), "id", "doc_id")
    ids = keyed.select(F.col(row).alias("doc_id"), F.col("doc_id").alias("id"))
    stay = judged.join(ids, "doc_id").groupBy("component_id").agg(F.min(order).alias("best")).select(F.col("best.doc_id").alias(row))
    return keyed.join(stay, row, "left_semi").select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which a twentieth or more lies in passages of the benchmark go."""
    keep = tuple(c for c in docs.columns if c != "doc_id")
    return decontaminate.judged(decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"), keep=keep)).where("NOT contaminated").select(*docs.columns)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; the spans found are replaced by a mark, and ``n_chars`` follows the text."""
    spans = secrets.free_name(docs, "spans")
    out = secrets.redact(secrets.find_secrets(docs, out=spans), spans)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast(kind)).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, ids`` of every document."""
    import public_tokenizers

    return byte_bpe.encode_texts(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode),
]

#: Learned scores, similarity components and tokenizers are beyond SQL; tests/llm holds a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other; a stage's own tables and its input are deleted once its result is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = written_alone(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), name)
        if before is not None:
            discard(before)
        before = docs
    return docs
