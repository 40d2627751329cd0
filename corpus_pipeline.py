"""Training-corpus pipeline: documents in, packed tokens out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet and reads it again as the next one's input, so
a lost executor costs at most the running stage. All stages but the last keep
the columns of ``documents``.

    quality            rows scored below 0.7 go (none where no model can be fitted)
    near_duplicates    one document of each group stays (five-word shingles, 0.8)
    decontaminate      documents that hold a benchmark window go
    secrets            secrets found are replaced by a mark; n_chars follows
    byte_bpe           doc_id, packed ids, counts and digests

An empty table passes through all stages. Rows with a null id are never joined
to labels or groups and stay there; benchmark matches go by the text (its 64-bit
hash), whatever the id. Null texts are empty texts.
"""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import byte_bpe, decontam, neardup, quality, secrets
from ledgerline.llm.queries import MULTILINGUAL_BPE, ship, table, vocabulary
from ledgerline.session import ensure_checkpoint_dir

#: SQL cannot express the learned and randomised stages; tests/llm compares the
#: pipeline with a brute-force version.
ORACLE_SQL = None


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return neardup.drop_near_duplicates(docs, words=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    # keyed by text, so that null and repeated ids are judged by their own text
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    found = decontam.contamination(keyed, table(spark, sf_dir, "benchmark"), id="__key")
    hit = found.where("n_hit > 0").select(F.col("doc_id").alias("__key")).distinct()
    return keyed.join(hit, "__key", "left_anti").select(*docs.columns)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType)))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    encoded = byte_bpe.encode_decode(docs, vocabulary(MULTILINGUAL_BPE), keep=["doc_id"])
    digest = [F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")]
    return encoded.select("doc_id", (F.length("ids") / 4).cast("long").alias("n_tokens"), "ids", *digest)


STAGES = [("quality", keep_quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate),
          ("secrets", mask_secrets), ("byte_bpe", tokens)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what lies between them is kept in the shared
    checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        path = f"{base}/{i}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        gc.collect()  # lets the driver's JVM drop the finished stage's plans, broadcasts and shuffles
    return docs
