"""The training-corpus pipeline: stages over the documents table, each written and read again before the next.

Defined results: every stage takes an empty table and returns none of its rows. A null or empty text has no language,
so language ID drops it; the later stages keep such rows if they get them (no lines, no shingles, 0 words, no ids). A
null doc_id or source stays (a null source is a source of its own). Repeated rows stay together through language ID and
line dedup; near dedup keeps all rows of the id that stays. Other columns stay until the last stage.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliospark.llm import bpe, language_id, line_dedup, minhash, mixing
from foliospark.llm.common import ensure_checkpoint_dir, read_table, shrink_heaps

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def on_small_heaps(stage: Stage) -> Stage:
    """The stage, begun with executors that have given back the heap which earlier stages left them with."""

    @wraps(stage)
    def begun(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        shrink_heaps(spark)
        return stage(spark, docs, sf_dir)

    return begun


@on_small_heaps
def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: documents without a letter, whose best language holds under half of the probability, or that are
    less likely in it for their length than its labelled documents (other languages, letter junk), go."""
    labelled = read_table(spark, sf_dir, "documents").where(~language_id.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    model = language_id.train(labelled, language_id.default_vocabulary(), max_docs=None)
    least = language_id.least_fits(labelled, model)
    judged = language_id.predict(docs, model, with_fit=True)
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= 0.5) & language_id.fits(least)).select(*docs.columns)


@on_small_heaps
def remove_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Line dedup: later occurrences of three-line windows are cut from texts; texts of which nothing is left go."""
    return line_dedup.remove_repeated_lines(docs)


@on_small_heaps
def keep_one_of_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of near duplicates (five words, 0.8) the smallest doc_id stays."""
    return minhash.keep_one(docs, words=5, percent=80)


@on_small_heaps
def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing to target weights: each document stands as often as the mix takes it."""
    mixed = mixing.mix_sources(docs)
    return mixed.where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select(*docs.columns)


@on_small_heaps
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Byte-level BPE: each document's ids, their number, and the hash of the bytes they decode to."""
    encoded = bpe.encode(docs, *bpe.default_ranks(), with_ids=True, hashes=True)
    return encoded.select("doc_id", "lang", "source", "ids", "n_tokens", "decoded_sha256")


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", remove_repeated_lines),
    ("minhash", keep_one_of_near_duplicates),
    ("mixing", mix),
    ("bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows. Stages are written to the shared checkpoint folder, so that none is computed twice."""
    folder = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
