"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Words are maximal runs outside these six ASCII white-space characters.
WORD_GAP = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
GAP_CHARS = " \t\n\x0b\x0c\r"


def workers_import(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    On a cluster the package is shipped with the job (--py-files) and this
    place, if executors lack it, is passed over.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The whole ``documents`` table, or some of its columns."""
    return table(spark, sf_dir, "documents", *columns)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def words_of(text: Column) -> Column:
    """Array of the words of a text; null and blank texts have none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(GAP_CHARS))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, WORD_GAP))


def n_words_of(text: Column) -> Column:
    return F.size(words_of(text)).cast("long")


def public_path(name: str) -> str:
    """Default place of a public tokenizer file."""
    import public_tokenizers
    return os.fspath(public_tokenizers.path(name))


def without(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to write."""
    taken = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken])


class Remembered(dict):
    """Values made on first use, in two bounded generations of keys."""

    def __init__(self, make, entries: int, longest: int = 64):
        super().__init__()
        self.make, self.entries, self.longest, self.older = make, entries, longest, {}

    def __missing__(self, key: str):
        found = self.older.get(key)
        if found is None:
            found = self.make(key)
        if len(key) <= self.longest:
            if len(self) >= self.entries:
                self.older = dict(self)
                self.clear()
            self[key] = found
        return found
