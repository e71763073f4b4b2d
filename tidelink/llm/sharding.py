"""Placing documents on shards through a permutation-filled lookup table.

Each shard has its own order of preference over the slots of a table of
prime size: a start and a step from its name's hash, so the order is a
permutation. The shards take turns, each claiming the first free slot of its
order, until the table is full. A document's key hashes to a slot, and the
slot names the shard. Shares differ by at most a turn's claims, and adding or
removing a shard moves few slots beside its own.

Defined results: a null key is placed like the empty text; equal keys go to
one shard; the result keeps all columns, replacing any named like an output;
an empty table gives an empty table. The lookup table is as long as its
prime size whatever the input, so broadcasting it is bounded.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelink.llm.common import without

SLOTS = 65_537


def _is_prime(n: int) -> bool:
    return n > 1 and all(n % k for k in range(2, int(n ** 0.5) + 1))


def preference(name: str, slots: int) -> tuple[int, int]:
    """Start and step of a shard's permutation of 0..slots-1."""
    digest = hashlib.sha256(name.encode("utf-8")).digest()
    return int.from_bytes(digest[:8], "big") % slots, int.from_bytes(digest[8:16], "big") % (slots - 1) + 1


def fill_table(shards: Sequence[str], slots: int = SLOTS, weights: Sequence[int] | None = None) -> np.ndarray:
    """Shard number of each slot; a shard of weight w claims w slots a turn.

    The table depends on the shards' names, not on the order they come in.
    """
    if not _is_prime(slots) or slots < max(3, len(shards)):
        raise ValueError("the number of slots must be a prime of at least 3 and the number of shards")
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("shards must have distinct names, and there must be one")
    turns = [int(w) for w in weights] if weights is not None else [1] * len(shards)
    if len(turns) != len(shards) or min(turns) < 1:
        raise ValueError("each shard needs a positive whole weight")
    order = sorted(range(len(shards)), key=lambda k: shards[k])
    state = {k: preference(shards[k], slots) for k in order}
    place = {k: state[k][0] for k in order}
    table = [-1] * slots
    free = slots
    while free:
        for k in order:
            step, at = state[k][1], place[k]
            for _ in range(turns[k]):
                while table[at] >= 0:
                    at = (at + step) % slots
                table[at] = k
                free -= 1
                if not free:
                    return np.array(table, np.int32)
            place[k] = at
    return np.array(table, np.int32)


def slot_of(key: Column, slots: int = SLOTS) -> Column:
    """Slot of a key: the first 60 bits of the MD5 of its text."""
    digest = F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary"))
    return (F.conv(F.substring(digest, 1, 15), 16, 10).cast("long") % slots).cast("int")


def place(docs: DataFrame, shards: Sequence[str], key_col: str = "doc_id", slots: int = SLOTS,
          weights: Sequence[int] | None = None) -> DataFrame:
    """Add ``slot`` and ``shard`` to every row, without a shuffle."""
    filled = fill_table(shards, slots, weights)
    lookup = docs.sparkSession.createDataFrame(
        pd.DataFrame({"_slot": np.arange(slots, dtype=np.int32), "shard": [shards[k] for k in filled]}),
        "_slot int, shard string")
    base = without(docs, "slot", "shard").withColumn("slot", slot_of(F.col(key_col), slots))
    return base.join(F.broadcast(lookup), F.col("slot") == F.col("_slot"), "left").drop("_slot")


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder for each shard; large shards are split into several files."""
    placed.hint("rebalance", "shard").write.partitionBy("shard").parquet(path)
