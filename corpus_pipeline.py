"""A corpus pipeline: filter, identify, deduplicate, mix and encode documents.

Each stage is a function of (spark, docs, sf_dir) over all that the stage
before kept, and returns the columns of ``documents`` (the last one returns
the encodings). :func:`run` writes every stage's result as a table in the
shared folder and reads it as the next one's documents.

A stage's intermediate tables are deleted when the next stage starts, unless
that one's documents still read them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.llm import host_rules, langid, mixing, simhash, word_bpe
from tidelink.llm.common import documents, n_words_of, without, workers_import
from tidelink.session import drop_scratch, materialize, scratch_made

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Tables of the latest stage of each application.
_LEFT: dict[str, set[str]] = {}


def _tables(spark: SparkSession) -> set[str]:
    return {f for f in scratch_made(spark) if "/stage-" in f}


def stage(fn: Stage) -> Stage:
    """Run a stage, first deleting the tables that the one before has left."""
    @wraps(fn)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        workers_import(spark)
        app = spark.sparkContext.applicationId
        left = _LEFT.pop(app, set())
        if left:
            read = docs.inputFiles()
            drop_scratch(spark, [f for f in left if not any(f.rpartition("/")[2] in x for x in read)])
        before = _tables(spark)
        out = fn(spark, docs, sf_dir)
        _LEFT[app] = _tables(spark) - before
        return out

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and their host's verdict keep."""
    judged = host_rules.judge(host_rules.with_measures(docs, out="_quality"), out="_quality")
    return judged.where("_quality.kept").drop("_quality")


@stage
def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised with enough confidence."""
    model = langid.fit(docs)
    named = docs.select("*", langid.prediction(F.col("text"), model, spark).alias("_language"))
    return named.where(~F.col("_language.rejected")).drop("_language")


@stage
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal SimHash fingerprints."""
    return simhash.first_of_each_group(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    sized = without(docs, "_size").withColumn("_size", n_words_of(F.col("text")))
    mixed = mixing.mix(sized, size_col="_size", out="_mix")
    return mixing.repeat_rows(mixed, F.col("_mix.copies")).drop("_mix", "_size")


@stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids and decoded text."""
    return word_bpe.digests(word_bpe.encode_decode(docs))


STAGES = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("simhash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("bpe encoding", encode),
]

# SQL cannot express the trained, sampled and tokenising stages; tests hold
# each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = documents(spark, sf_dir)
    before = _tables(spark)
    for _, fn in STAGES[:-1]:
        docs = fn(spark, docs, sf_dir)
        earlier = _tables(spark) - before
        docs = materialize(docs)
        drop_scratch(spark, earlier)  # all that they fed has been written
    return STAGES[-1][1](spark, docs, sf_dir)
