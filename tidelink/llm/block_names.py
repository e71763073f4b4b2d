"""Exact duplicates by deterministic block naming.

Texts are compared without their white space. The rest is cut into blocks of
a fixed number of bytes; the distinct blocks are sorted and numbered, and the
numbers of adjacent blocks are paired, the distinct pairs sorted and numbered
in turn, until one number is left of every text. Two texts have the same
(rounds, number) exactly when their bytes are equal: a number stands for one
pair of numbers, and at last for one sequence of blocks.

Blocks cross the cluster once, when equal ones meet. Their occurrences find
their numbers by two 64-bit hashes, which are first shown to tell all distinct
blocks apart; if two distinct blocks had the same hashes, other hashes would be
taken, so no result rests on chance. Equal blocks and pairs are put together
before each shuffle, and numbers are written before they are joined, so a
block that a third of all texts share can be split.

Main path: DataFrame functions only.

Defined results: a null text counts as the empty text, and blank texts equal
it; of equal texts with equally many code points the smallest id stays, a
null id last, and of rows that also share the id the one that Spark read
first; repeated rows count each; an empty table gives an empty result; only
the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelink.llm.common import GAP_CHARS
from tidelink.session import materialize

BLOCK_BYTES = 2048
NOTHING = -1  # stands beside the last of an odd number of names

Hashes = Callable[[Column, int], tuple[Column, Column]]


def squeezed(text: Column) -> Column:
    """The text without ASCII white space, as UTF-8 bytes; empty for null."""
    out = F.coalesce(text, F.lit(""))
    for c in GAP_CHARS:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out.cast("binary")


def block_hashes(block: Column, salt: int) -> tuple[Column, Column]:
    return F.xxhash64(F.lit(2 * salt), block), F.xxhash64(block, F.lit(2 * salt + 1))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row."""
    return F.transform(F.array(value), use)[0]


def _blocks(data: Column, size: int) -> Column:
    last = F.greatest(F.octet_length(data) - 1, F.lit(0))
    starts = F.sequence(F.lit(0), F.floor(last / size).cast("int"))
    return F.transform(starts, lambda i: F.substring(data, i * size + 1, F.lit(size)))


def _numbered(distinct: DataFrame, *columns: str) -> DataFrame:
    """Sorted distinct rows and their numbers; a part's number is the upper
    half, so no row has to wait for the size of another part."""
    return distinct.sortWithinPartitions(*columns).withColumn("name", F.monotonically_increasing_id())


def _cut(docs: DataFrame, id_col: str, text_col: str, size: int, hashes: Hashes) -> tuple[DataFrame, DataFrame]:
    """Facts of every row with the hashes of its blocks, and the names of all
    distinct blocks by their hashes."""
    text = F.col(text_col)
    for salt in count():
        names = docs.select(F.explode(_bound(squeezed(text), lambda b: _blocks(b, size))).alias("block")).distinct()
        names = _numbered(names, "block")
        h1, h2 = hashes(F.col("block"), salt)
        names = materialize(names.select(h1.alias("h1"), h2.alias("h2"), "name"))
        if names.groupBy("h1", "h2").count().where("count > 1").isEmpty():
            break

    def facts(data: Column) -> Column:
        marks = F.transform(_blocks(data, size), lambda b: F.struct(
            hashes(b, salt)[0].alias("h1"), hashes(b, salt)[1].alias("h2")))
        return F.struct(F.sha2(data, 256).alias("sha256"), marks.alias("marks"))

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"),
        F.coalesce(F.length(text), F.lit(0)).cast("long").alias("n_chars"), _bound(squeezed(text), facts).alias("cut"))
    return materialize(rows), names


def identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
               hashes: Hashes = block_hashes) -> DataFrame:
    """One row per document: row, id, n_chars, sha256, and its identity
    (rounds, name), which is equal for equal texts and no others."""
    rows, names = _cut(docs, id_col, text_col, block_bytes, hashes)
    marks = rows.select("row", F.size("cut.marks").alias("n"), F.posexplode("cut.marks").alias("pos", "mark"))
    nodes = materialize(marks.select("row", "n", "pos", "mark.h1", "mark.h2").join(names, ["h1", "h2"])
                        .select("row", "n", "pos", "name"))
    most = rows.agg(F.max(F.size("cut.marks"))).first()[0] or 1
    done = nodes.where("n = 1").select("row", F.lit(0).alias("rounds"), "name")
    for k in range(1, (most - 1).bit_length() + 1):
        even = F.col("pos") % 2 == 0
        pairs = materialize(
            nodes.where("n > 1").groupBy("row", "n", F.shiftright("pos", 1).alias("pos"))
            .agg(F.max(F.when(even, F.col("name"))).alias("left"),
                 F.coalesce(F.max(F.when(~even, F.col("name"))), F.lit(NOTHING)).alias("right")))
        names = materialize(_numbered(pairs.select("left", "right").distinct(), "left", "right"))
        nodes = materialize(pairs.join(names, ["left", "right"])
                            .select("row", F.ceil(F.col("n") / 2).cast("int").alias("n"), "pos", "name"))
        done = done.union(nodes.where("n = 1").select("row", F.lit(k).alias("rounds"), "name"))
    return rows.select("row", "id", "n_chars", "cut.sha256").join(done, "row")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES,
                     hashes: Hashes = block_hashes) -> DataFrame:
    """Every document with its group of equal texts: the id column, keep_id
    (id of the row that stays), group_size, kept, text_sha256."""
    named = materialize(identities(docs, id_col, text_col, block_bytes, hashes))
    first = F.struct((-F.col("n_chars")).alias("shorter"), F.col("id").isNull().alias("unknown"), "id", "row")
    groups = materialize(named.groupBy("rounds", "name").agg(
        F.count(F.lit(1)).alias("group_size"), F.min(first).alias("stays")))
    return named.join(groups, ["rounds", "name"]).select(
        F.col("id").alias(id_col), F.col("stays.id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"), F.col("sha256").alias("text_sha256"))
