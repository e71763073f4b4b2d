"""SimHash fingerprints and their exact near-duplicate groups, tile by tile.

A fingerprint is the bitwise majority of the 64-bit hashes of a text's word
shingles. Distinct fingerprints are put into tiles by the population counts
of their four 16-bit quarters. Two fingerprints within the radius differ by
no more than it in the sum of those four counts' differences, so only such
tile pairs are compared, with numpy exclusive-or and bit counts. Tiles are
cut into blocks, a tile pair emits a spanning forest instead of its links,
and the forests meet in distributed connected components.

Defined results: a null, empty or blank text has no words and fingerprint
zero, linked like any other; below the shingle length the whole word
sequence is one shingle; repeated rows share their component; a null id
takes no part in the smallest id (a group of null ids only has a null
component); the result has the operator's columns only.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelink.llm.graph import connected_components, local_components
from tidelink.session import materialize

SHINGLE_WORDS = 3
MAX_BITS = 2
HASH_SEED = 42
BLOCK = 2048  # fingerprints of a tile that one comparison holds
QUARTER_COUNTS = 17


def text_fingerprint(text: str | None, shingle: int = SHINGLE_WORDS) -> int:
    """Fingerprint of one text as a signed 64-bit integer."""
    from xxhash import xxh64_intdigest
    # on bytes, lower() changes A-Z only and split() cuts at the six ASCII spaces
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    shingles = map(b" ".join, zip(*(words[i:i + n] for i in range(shingle)))) if len(words) >= shingle else [b" ".join(words)]
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(HASH_SEED)), "u8", n)
    set_bits = np.zeros(64, np.int64)
    for at in range(0, n, 255 * 64):
        bits = np.unpackbits(hashes[at:at + 255 * 64].astype(">u8").view(np.uint8)).reshape(-1, 64)
        for k in range(0, len(bits), 255):  # sums of 255 bits fit a byte
            set_bits += bits[k:k + 255].sum(axis=0, dtype=np.uint8)
    return int(np.packbits(2 * set_bits > n).view(">i8")[0])


def fingerprint(text: Column, shingle: int = SHINGLE_WORDS) -> Column:
    """Fingerprint of a text column as a signed long (never null)."""
    @F.pandas_udf(T.LongType())
    def made(texts: pd.Series) -> pd.Series:
        return pd.Series([text_fingerprint(t, shingle) for t in texts], dtype="int64")

    return made(text)


def tiles(prints: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Blocks of distinct fingerprints ``fp`` and the directory of tiles.

    A tile is the vector of four quarter counts, of which there are at most
    17 ** 4 = 83,521 at any input size; the directory is broadcast.
    """
    quarter = [F.bit_count(F.shiftrightunsigned("fp", s).bitwiseAND(0xFFFF)) for s in (48, 32, 16, 0)]
    tile = sum(q * QUARTER_COUNTS ** k for k, q in enumerate(reversed(quarter)))
    tiled = prints.select("fp", tile.cast("int").alias("tile"))
    directory = materialize(tiled.groupBy("tile").agg(
        F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")))
    blocks = (tiled.join(F.broadcast(directory), "tile")
              .select("fp", "tile", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int").alias("block"))
              .groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")))
    return blocks, directory


def tile_pairs(directory: DataFrame, radius: int) -> DataFrame:
    """Pairs of blocks whose quarter counts allow links within the radius."""
    base = QUARTER_COUNTS
    offsets = [d for d in product(range(-radius, radius + 1), repeat=4)
               if sum(map(abs, d)) <= radius and d >= (0, 0, 0, 0)]
    step = F.explode(F.array(*[F.array(*[F.lit(x) for x in d]) for d in offsets])).alias("d")
    near = directory.select("tile", "blocks", step)
    digits = [F.floor(F.col("tile") / base ** k) % base + F.get("d", 3 - k) for k in (3, 2, 1, 0)]
    other = sum(x * base ** k for x, k in zip(digits, (3, 2, 1, 0)))
    inside = digits[0].between(0, base - 1)
    for x in digits[1:]:
        inside = inside & x.between(0, base - 1)
    near = near.where(inside).select(F.col("tile").alias("tile_a"), F.col("blocks").alias("blocks_a"),
                                     other.cast("int").alias("tile_b"))
    near = near.join(F.broadcast(directory.select(F.col("tile").alias("tile_b"), F.col("blocks").alias("blocks_b"))), "tile_b")
    near = near.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks_a") - 1)).alias("block_a"))
    near = near.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)).alias("block_b"))
    return near.where("tile_a != tile_b or block_a <= block_b").select("tile_a", "block_a", "tile_b", "block_b")


def compare_blocks(a: np.ndarray, b: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest (fingerprint, root) of the links between two blocks."""
    both = np.concatenate([a, b])
    label, rows = np.arange(len(both)), max(1, (1 << 20) // max(1, len(b)))
    for at in range(0, len(a), rows):
        near = np.bitwise_count(a[at:at + rows, None] ^ b[None, :]) <= radius
        i, j = np.nonzero(near)
        if len(i):
            label = local_components(len(both), i + at, j + len(a), label)
    linked = np.flatnonzero((label != np.arange(len(both))) & (both != both[label]))
    return both[linked], both[label[linked]]


def forests(blocks: DataFrame, pairs: DataFrame, radius: int) -> DataFrame:
    """Compare block pairs in tasks; edges (u, v) of their spanning forests."""
    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            us, vs = [], []
            for x, y in zip(batch.column(0), batch.column(1)):
                u, v = compare_blocks(x.values.to_numpy().view("u8"), y.values.to_numpy().view("u8"), radius)
                us.append(u)
                vs.append(v)
            if us:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(z).view("i8"), pa.int64()) for z in (us, vs)], ["u", "v"])

    left = blocks.select(F.col("tile").alias("tile_a"), F.col("block").alias("block_a"), F.col("fps").alias("fps_a"))
    right = blocks.select(F.col("tile").alias("tile_b"), F.col("block").alias("block_b"), F.col("fps").alias("fps_b"))
    joined = pairs.join(left, ["tile_a", "block_a"]).join(right, ["tile_b", "block_b"])
    return joined.select("fps_a", "fps_b").mapInArrow(compared, "u long, v long")


def groups(marked: DataFrame, id_col: str, radius: int = MAX_BITS) -> DataFrame:
    """(id, fp, component_id) of rows with fingerprints ``fp``; ids of any
    ordered type. ``marked`` is read several times and should be a table."""
    classes = materialize(marked.groupBy("fp").agg(F.min(id_col).alias("first_id")))
    blocks, directory = tiles(classes)
    blocks = materialize(blocks)
    roots = connected_components(forests(blocks, tile_pairs(directory, radius), radius))
    linked = materialize(classes.join(roots, F.col("fp") == F.col("vertex")).select("fp", "root", "first_id"))
    smallest = materialize(linked.groupBy("root").agg(F.min("first_id").alias("component_id")))
    joined = linked.join(smallest, "root").select("fp", "component_id")
    # written, so that the join below has a plain exchange on either side and
    # a fingerprint with a great many rows can be split
    of_class = materialize(classes.join(joined, "fp", "left").select(
        "fp", F.coalesce("component_id", "first_id").alias("component_id")))
    return marked.select(F.col(id_col), "fp").join(of_class, "fp")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """Id column, ``fingerprint`` (16 hex digits) and ``component_id``."""
    marked = materialize(docs.select(F.col(id_col), fingerprint(F.col(text_col), shingle).alias("fp")))
    return groups(marked, id_col, radius).select(
        F.col(id_col), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        shingle: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` that stay: of each group the one of smallest id
    (null ids last), and of repeated ids one row."""
    rows = materialize(docs.withColumn("_fp", fingerprint(F.col(text_col), shingle))
                       .withColumn("_row", F.monotonically_increasing_id()))
    key = F.struct(F.col(id_col).isNull().alias("absent"), F.col(id_col).alias("id"), F.col("_row").alias("row"))
    found = groups(rows.select(key.alias("key"), F.col("_fp").alias("fp")), "key", radius)
    gone = found.where("key != component_id").select(F.col("key.row").alias("_row"))
    return rows.join(gone, "_row", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
