"""The trie of conversation prefixes, as a table of its nodes.

Every distinct sequence of the first d turns is a node. A prefix is known by a
128-bit digest, the sum of digests of its turns at their depths, which is a
running sum and so carried over range parts; a conversation of any length is
never gathered. The distinct digests are enumerated by one aggregation, which
also verifies them: a digest whose members differ in their last turn or in
the digest before it stands for two prefixes, and then other digests are
taken.

Subtree sums: a node belongs to the chain of its member with the least hashed
id, so the trie falls into paths, of which a conversation crosses about a
logarithm of their number. Chains, cut every 65,536 turns, are dealt to
shards. What hangs on a chain is first passed from chain to chain as sums at
the turns where they branch off (rounds over the table of chains only). Each
shard then gives its nodes slots by a minimal perfect hash whose slots store
their keys, scatters all counts into flat arrays, finds every node's parent
slot, and adds the arrays up in order of depth.

Defined results: turns of equal number are ordered by their content; turns
without a conversation id belong to none; null role or text is empty; a
conversation may be without turns, and then ends at the root; an empty table
has no nodes. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import count

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidelink.llm.perfect_hash import PerfectHash
from tidelink.operators.scan import PART, range_parts, ranked
from tidelink.session import materialize

CHAIN_TURNS = 1 << 16  # a chain is cut every so many turns
SHARD_NODES = 50_000
PACKED_IDS = 512
LANES = ("s0", "s1", "s2", "s3")
_LOW = 0xFFFFFFFF

Lanes = Callable[[int], list[Column]]


def lanes(salt: int) -> list[Column]:
    """Four 32-bit summands of a turn (t1, t2) at its depth."""
    h = [F.xxhash64(F.lit(2 * salt + k), "depth", "t1", "t2") for k in (0, 1)]
    return [x.bitwiseAND(F.lit(_LOW)) for x in h] + [F.shiftrightunsigned(x, 32) for x in h]


def turns_of(conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
             text_col: str = "text") -> DataFrame:
    """(conv, pos, t1, t2, bytes): 0-based place and 128-bit content digest of
    every turn, without its text."""
    role, text = F.coalesce(F.col(role_col), F.lit("")), F.coalesce(F.col(text_col), F.lit(""))
    digest = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256)
    rows = conversations.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("conv"), F.col(turn_col).alias("turn"), digest.alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"))
    half = [F.conv(F.substring("digest", 1 + 16 * k, 16), 16, -10).cast("long").alias(f"t{k + 1}") for k in (0, 1)]
    rows = materialize(rows.select("conv", "turn", *half, "bytes"))
    return ranked(rows, ["conv"], ["turn", "t1", "t2"], out="pos").select(
        "conv", (F.col("pos") - 1).alias("pos"), "t1", "t2", "bytes")


def with_shared_heads(turns: DataFrame, family: int = 5, heads: int = 9) -> tuple[DataFrame, DataFrame]:
    """Rebuild every conversation c: the first h turns of c - c % family, then
    c's own behind its first h; h = crc32 of c % heads.

    Returns (conv, depth, t1, t2, bytes) and (conv, len) of every conversation.
    """
    turns = materialize(turns)
    convs = turns.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    head = (F.crc32(F.col("conv").cast("string")) % heads).alias("h")
    bases = convs.select(F.col("conv").alias("base"), F.col("own").alias("base_len"))
    convs = materialize(
        convs.select("conv", "own", head, (F.col("conv") - F.col("conv") % family).alias("base"))
        .join(bases, "base", "left")
        .select("conv", "own", "h", "base", F.least("h", F.coalesce("base_len", F.lit(0))).alias("taken")))
    own = turns.join(convs, "conv").where("pos >= h").select(
        "conv", (F.col("pos") - F.col("h") + F.col("taken") + 1).alias("depth"), "t1", "t2", "bytes")
    first = turns.where(F.col("pos") < heads - 1).withColumnRenamed("conv", "base")
    shared = first.join(convs.select("conv", "base", "h"), "base").where("pos < h").select(
        "conv", (F.col("pos") + 1).alias("depth"), "t1", "t2", "bytes")
    lens = convs.select("conv", (F.greatest(F.col("own") - F.col("h"), F.lit(0)) + F.col("taken")).alias("len"))
    return own.union(shared), lens


def _digests(rows: DataFrame, lens: DataFrame, summands: list[Column]) -> DataFrame:
    """Prefix digest (a, b) of every turn, that of the prefix before (pa, pb),
    and whether the conversation ends there."""
    for name, x in zip(LANES, summands):
        rows = rows.withColumn(name, x)
    parts = range_parts(rows.join(lens, "conv").withColumn("ends", F.col("depth") == F.col("len")).drop("len"),
                        ["conv"], ["depth"])
    before = Window.partitionBy("conv").orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    carried = parts.groupBy("conv", PART).agg(*[F.sum(s).alias(s) for s in LANES])
    carried = carried.select("conv", PART, *[F.coalesce(F.sum(s).over(before), F.lit(0)).alias(f"c{s}") for s in LANES])
    run = Window.partitionBy("conv", PART).orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    local = parts.select("*", *[F.sum(s).over(run).alias(f"l{s}") for s in LANES]).join(carried, ["conv", PART])

    def pair(of: Callable[[str], Column]) -> list[Column]:
        low = [of(s).bitwiseAND(F.lit(_LOW)) for s in LANES]
        return [F.shiftleft(low[2], 32).bitwiseOR(low[0]), F.shiftleft(low[3], 32).bitwiseOR(low[1])]

    a, b = pair(lambda s: F.col(f"c{s}") + F.col(f"l{s}"))
    p, q = pair(lambda s: F.col(f"c{s}") + F.col(f"l{s}") - F.col(s))
    return local.select("conv", F.col("depth").cast("int").alias("depth"), a.alias("a"), b.alias("b"), p.alias("pa"),
                        q.alias("pb"), "t1", "t2", "bytes", "ends")


def _nodes(rows: DataFrame, lens: DataFrame, summands: Lanes) -> tuple[DataFrame, DataFrame]:
    """Every distinct prefix once, with digests that are shown to be distinct."""
    for salt in count():
        prefixes = materialize(_digests(rows, lens, summands(salt)))
        same = ("pa", "pb", "t1", "t2")
        nodes = materialize(prefixes.groupBy("depth", "a", "b").agg(
            F.min("conv").alias("conv_id"), F.min(F.xxhash64("conv")).alias("chain"), F.count(F.lit(1)).alias("n_convs"),
            F.sum(F.col("ends").cast("long")).alias("n_ends"), F.max("bytes").alias("bytes"),
            *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_") for c in same]))
        if nodes.where(" or ".join(f"{c} <> {c}_" for c in same)).isEmpty():
            return nodes.drop("t1", "t2", *[f"{c}_" for c in same]), prefixes


def _ends(prefixes: DataFrame) -> DataFrame:
    """SHA-256 of the ascending ids of the conversations that end at a node.

    Ids are packed into strings part by part of one sorted table; a node's
    strings then pass through the hash one after another.
    """
    keys = ["depth", "a", "b"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            d = batch.to_pandas()
            key = d[keys].to_numpy()
            starts = np.ones(len(d), bool)
            starts[1:] = (key[1:] != key[:-1]).any(axis=1)
            run = np.flatnonzero(starts)
            within = np.arange(len(d)) - np.repeat(run, np.diff([*run, len(d)]))
            run = np.flatnonzero(within % PACKED_IDS == 0)
            ids = [",".join(map(str, some)) for some in np.split(d["conv"].to_numpy(), run[1:])]
            out = d.iloc[run][[*keys, "conv"]].rename(columns={"conv": "first"}).assign(ids=ids if len(d) else [])
            yield pa.RecordBatch.from_pandas(out, packed, preserve_index=False)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, state, out = None, None, []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(
                zip(*out), (pa.int32(), pa.int64(), pa.int64(), pa.string()))], [*keys, "ends_sha256"])

        for batch in batches:
            for *key, ids in zip(*(batch.column(c).to_pylist() for c in (*keys, "ids"))):
                if key == at:
                    state.update(b"," + ids.encode())
                    continue
                if at:
                    out.append((*at, state.hexdigest()))
                at, state = key, sha256(ids.encode())
            if len(out) > 10_000:
                yield rows()
                out = []
        if at:
            out.append((*at, state.hexdigest()))
            yield rows()

    packed = pa.schema([("depth", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    ends = prefixes.where("ends").select(*keys, "conv").repartitionByRange(*keys, "conv").sortWithinPartitions(*keys, "conv")
    strings = ends.mapInArrow(pack, "depth int, a long, b long, first long, ids string")
    return (strings.repartition(*keys).sortWithinPartitions(*keys, "first")
            .mapInArrow(digest, "depth int, a long, b long, ends_sha256 string"))


def _hanging(linked: DataFrame) -> DataFrame:
    """What hangs on a chain's turns from other chains: (chain, depth,
    more_children, more_leaves, more_saved)."""
    piece = F.floor((F.col("depth") - 1) / CHAIN_TURNS).alias("piece")
    pieces = materialize(linked.groupBy("chain", piece).agg(
        F.sum("leaf").alias("leaves"), F.sum("saved").alias("saved"),
        F.max(F.when(F.col("top"), F.col("parent_chain"))).alias("on"),
        F.max(F.when(F.col("top"), F.col("depth") - 1)).alias("at")))
    sums = [F.sum(c).alias(c) for c in ("more_children", "more_leaves", "more_saved")]
    sent = materialize(pieces.where("at > 0").select(
        F.col("on").alias("chain"), F.col("at").alias("depth"), F.lit(1).cast("long").alias("more_children"),
        F.col("leaves").alias("more_leaves"), F.col("saved").alias("more_saved")).groupBy("chain", "depth").agg(*sums))
    hung, up = sent, pieces.where("at > 0").select("chain", "piece", "on", "at")
    while not sent.isEmpty():
        carried = sent.groupBy("chain", piece).agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
        sent = materialize(carried.join(up, ["chain", "piece"]).groupBy(F.col("on").alias("chain"), F.col("at").alias("depth")).agg(
            F.lit(0).cast("long").alias("more_children"), F.sum("more_leaves").alias("more_leaves"),
            F.sum("more_saved").alias("more_saved")))
        hung = hung.union(sent)
    return hung.groupBy("chain", "depth").agg(*sums)


def _accumulated(nodes: DataFrame, shard_nodes: int) -> DataFrame:
    """Children, leaves and saved tokens of every node."""
    above = nodes.select((F.col("depth") + 1).alias("depth"), F.col("a").alias("pa"), F.col("b").alias("pb"),
                         F.col("conv_id").alias("parent_conv_id"), F.col("chain").alias("parent_chain"))
    linked = nodes.join(above, ["depth", "pa", "pb"], "left").select(
        "depth", "a", "b", "pa", "pb", "conv_id", F.coalesce("parent_conv_id", "conv_id").alias("parent_conv_id"), "chain", "parent_chain", "n_convs", "n_ends",
        (F.col("n_convs") == F.col("n_ends")).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("bytes")).alias("saved"))
    cut = (F.col("depth") - 1) % CHAIN_TURNS == 0
    linked = materialize(linked.withColumn("top", cut | F.coalesce(F.col("chain") != F.col("parent_chain"), F.lit(True))))
    shards = max(1, -(-linked.count() // shard_nodes))
    spread = F.pmod(F.xxhash64("chain", F.floor((F.col("depth") - 1) / CHAIN_TURNS)), F.lit(shards))
    dealt = linked.join(_hanging(linked), ["chain", "depth"], "left").na.fill(
        0, ["more_children", "more_leaves", "more_saved"]).withColumn("shard", spread)

    def accumulate(d: pd.DataFrame) -> pd.DataFrame:
        key = {c: d[c].to_numpy(np.int64).view(np.uint64) for c in ("a", "b", "pa", "pb")}
        table = PerfectHash(key["a"], key["b"])
        slot, n = table.slots(key["a"], key["b"]), len(d)

        def scattered(values: np.ndarray) -> np.ndarray:
            flat = np.empty(n, values.dtype)
            flat[slot] = values
            return flat

        depth = scattered(d["depth"].to_numpy(np.int64))
        parent = scattered(np.where(d["top"].to_numpy(bool), -1, table.slots(key["pa"], key["pb"])))
        children = scattered(d["more_children"].to_numpy(np.int64))
        leaves = scattered((d["leaf"] + d["more_leaves"]).to_numpy(np.int64))
        saved = scattered((d["saved"] + d["more_saved"]).to_numpy(np.int64))
        order = np.argsort(-depth, kind="stable")
        for level in np.split(order, np.flatnonzero(np.diff(depth[order])) + 1):
            level = level[parent[level] >= 0]
            for flat, step in ((children, np.ones(len(level), np.int64)), (leaves, leaves[level]), (saved, saved[level])):
                np.add.at(flat, parent[level], step)
        out = d[["depth", "a", "b", "conv_id", "n_convs"]].copy()
        out["parent_conv_id"] = d["parent_conv_id"]
        out["n_children"], out["n_leaves"], out["saved_tokens"] = children[slot], leaves[slot], saved[slot]
        return out

    return dealt.groupBy("shard").applyInPandas(
        accumulate, "depth int, a long, b long, conv_id long, n_convs long, parent_conv_id long, n_children long, "
                    "n_leaves long, saved_tokens long")


def trie(rows: DataFrame, lens: DataFrame, summands: Lanes = lanes, shard_nodes: int = SHARD_NODES) -> DataFrame:
    """All nodes over the turns (conv, depth from 1, t1, t2, bytes) and the
    lengths (conv, len) of conversations.

    Returns conv_id (least member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256.
    """
    rows, lens = materialize(rows), materialize(lens)
    nodes, prefixes = _nodes(rows, lens, summands)
    root_id = lens.agg(F.min("conv")).scalar()
    found = materialize(_accumulated(nodes, shard_nodes)).join(_ends(prefixes), ["depth", "a", "b"], "left")
    out = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    nobody = F.lit(sha256(b"").hexdigest())
    below = found.select(
        "conv_id", F.col("depth").cast("long").alias("depth"),
        F.when(F.col("depth") == 1, root_id).otherwise(F.col("parent_conv_id")).alias("parent_conv_id"), "n_convs",
        "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", nobody).alias("ends_sha256"))
    top = _root(nodes, lens)
    turnless = lens.where("len = 0").select(F.lit(0).alias("depth"), F.lit(0).cast("long").alias("a"),
                                            F.lit(0).cast("long").alias("b"), "conv", F.lit(True).alias("ends"))
    top = top.withColumn("ends_sha256", F.coalesce(_ends(turnless).select("ends_sha256").scalar(), nobody))
    return top.select(*out).union(below.select(*out))


def _root(nodes: DataFrame, lens: DataFrame) -> DataFrame:
    """The node of the empty prefix; no row if there are no conversations."""
    childless = F.col("n_convs") == F.col("n_ends")
    sums = nodes.agg(F.count_if(F.col("depth") == 1).alias("n_children"), F.count_if(childless).alias("n_leaves"),
                     F.coalesce(F.sum((F.col("n_convs") - 1) * F.col("bytes")), F.lit(0)).alias("saved_tokens"))
    return lens.agg(F.min("conv").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")).where("n_convs > 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        sums.select("n_children").scalar().alias("n_children"),
        F.greatest(sums.select("n_leaves").scalar(), F.lit(1)).alias("n_leaves"),
        sums.select("saved_tokens").scalar().alias("saved_tokens"))
