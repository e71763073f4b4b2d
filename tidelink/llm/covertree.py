"""Near-duplicate embeddings by dual traversal of cover trees.

Vectors link when their labels are equal and the cosine of the two, in double
precision, reaches the threshold; on unit vectors that is a largest distance.

Equal vectors are one class with a count. Classes are cut into blocks, by the
nearest of far-apart pivots where a label has more classes than a block, so
that pairs of cells further apart than their radii allow are never compared.
A label has a pivot for each block's worth of its classes, at most the square
root of their number; pivots are chosen label by label inside tasks and reach
the classes by joins, so nothing of them passes the driver. A cover tree is
built once over each block (nested levels of halving radii) and travels with
it. Each remaining pair of blocks is one row of work, whose node pairs are
descended together. A pair is dropped when even its nearest points are too
far apart, and taken whole when even its farthest points are near enough. A
block pair returns link counts and a spanning forest, never its links; counts
are summed and forests meet in distributed connected components.

Defined results: vectors that are null, empty, zero or hold a null or
non-finite component, and vectors without a label, link with nothing; so do
vectors of different length. Repeated rows link with each other as any equal
vectors do. A null id takes no part in the smallest id. An empty table gives
an empty table. Only the named columns are read, so others cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelink.llm.graph import connected_components, local_components
from tidelink.session import materialize

THRESHOLD = 0.98
BLOCK = 1024  # classes of one block
CANDIDATES = 4  # classes drawn for each pivot of a label
PIVOT_ROWS = 256  # pivots compared with all pivots of their label in one row
SLACK = 1e-7  # bounds keep this far from the threshold; cosines decide there
PAIRS_AT_ONCE = 1 << 16
MATRIX_FROM = 256  # child pairs from which one product finds the near ones

NODES = {"centre": "int", "radius": "double", "low": "int", "high": "int", "first": "int", "children": "int"}


@dataclass
class CoverTree:
    """Nodes over rows of unit vectors; a node's points are a range of rows."""

    unit: np.ndarray
    order: np.ndarray
    centre: list[int] = field(default_factory=list)
    radius: list[float] = field(default_factory=list)
    low: list[int] = field(default_factory=list)
    high: list[int] = field(default_factory=list)
    first: list[int] = field(default_factory=list)
    children: list[int] = field(default_factory=list)

    def seal(self) -> CoverTree:
        place = np.empty(len(self.order), np.int64)
        place[self.order] = np.arange(len(self.order))
        self.centre = place[np.array(self.centre, np.int64)]
        self.radius = np.array(self.radius)
        self.low, self.high, self.first, self.children = (
            np.array(x, np.int64) for x in (self.low, self.high, self.first, self.children))
        self.unit = self.unit[self.order]
        return self


def distances(unit: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(2 - 2 * (unit @ centre), 0))


def build_tree(unit: np.ndarray) -> CoverTree:
    """Cover tree of unit vectors: each level's centres are further apart than
    its radius, cover their points within it, and include the level above's.
    Levels that would change nothing are skipped."""
    n = len(unit)
    tree = CoverTree(unit, np.zeros(n, np.int64))

    def node(centre: int, radius: float, low: int, size: int) -> int:
        for col, x in zip((tree.centre, tree.radius, tree.low, tree.high, tree.first, tree.children),
                          (centre, radius, low, low + size, -1, 0)):
            col.append(x)
        return len(tree.centre) - 1

    todo = []
    if n:
        d = distances(unit, unit[0])
        todo.append((node(0, float(d.max()), 0, n), np.arange(n), d))
    while todo:
        at, points, d = todo.pop()
        if len(points) == 1:
            tree.order[tree.low[at]] = points[0]
            continue
        reach = tree.radius[at]
        level = 2.0 ** (np.ceil(np.log2(reach)) - 1) if reach > SLACK else -1.0
        groups = []
        rest, centre, dist = points, tree.centre[at], d
        while len(rest):
            near = dist <= level
            near[rest == centre] = True
            groups.append((centre, rest[near], dist[near]))
            rest = rest[~near]
            if len(rest):
                centre = int(rest[0])
                dist = distances(unit[rest], unit[centre])
        tree.first[at], tree.children[at] = len(tree.centre), len(groups)
        low = tree.low[at]
        for centre, members, dist in groups:
            todo.append((node(centre, float(dist.max()) if len(members) > 1 else 0.0, low, len(members)), members, dist))
            low += len(members)
    return tree.seal()


class BlockLinks:
    """Link counts and components of the points of two trees (or one)."""

    def __init__(self, n: int, m: int):
        self.added = (np.zeros(n + 1), np.zeros(m + 1))  # differences over rows
        self.joined = (np.zeros(n + 1, np.int64), np.zeros(m + 1, np.int64))  # rows i, i + 1 share a component
        self.count = (np.zeros(n), np.zeros(m))
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []
        self.label = np.arange(n + m)


def below(tree: CoverTree, at: int) -> np.ndarray:
    """Children of a node; a leaf stands for itself."""
    many = int(tree.children[at])
    return tree.first[at] + np.arange(many) if many else np.array([at])


def near_children(a: CoverTree, b: CoverTree, x: int, y: int, reach: float, itself: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of children of two nodes that their radii do not rule out."""
    i, j = below(a, x), below(b, y)
    cosine = a.unit[a.centre[i]] @ b.unit[b.centre[j]].T
    apart = np.sqrt(np.maximum(2 - 2 * cosine, 0))
    near = apart <= a.radius[i][:, None] + b.radius[j][None, :] + reach + SLACK
    p, q = np.nonzero(np.triu(near) if itself else near)
    return i[p], j[q]


def dual_traversal(a: CoverTree, b: CoverTree, weight_a: np.ndarray, weight_b: np.ndarray,
                   threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Linked weight of each point of a and of b (tree order), and a component
    label of each (b's points after a's). With ``same``, b is a, and a point
    does not count itself."""
    n, m = len(a.unit), len(b.unit)
    reach = np.sqrt(max(2 - 2 * threshold, 0.0))
    links = BlockLinks(n, m)
    sum_a, sum_b = np.concatenate([[0], np.cumsum(weight_a)]), np.concatenate([[0], np.cumsum(weight_b)])
    todo = [(np.zeros(1, np.int64), np.zeros(1, np.int64))] if n and m else []
    label = np.arange(n + m)
    while todo:
        x, y = todo.pop()
        if len(x) > PAIRS_AT_ONCE:
            todo += [(x[k:k + PAIRS_AT_ONCE], y[k:k + PAIRS_AT_ONCE]) for k in range(0, len(x), PAIRS_AT_ONCE)]
            continue
        cosine = np.einsum("ij,ij->i", a.unit[a.centre[x]], b.unit[b.centre[y]])
        apart = np.sqrt(np.maximum(2 - 2 * cosine, 0))
        spread = a.radius[x] + b.radius[y]
        leaf = (a.children[x] == 0) & (b.children[y] == 0)
        whole = np.where(leaf, cosine >= threshold, apart + spread <= reach - SLACK)
        itself = same & (x == y)
        if whole.any():
            p, q, own = x[whole], y[whole], itself[whole]
            lo, hi, lo_b, hi_b = a.low[p], a.high[p], b.low[q], b.high[q]
            w = sum_b[hi_b] - sum_b[lo_b]
            np.add.at(links.added[0], lo, w)
            np.add.at(links.added[0], hi, -w)
            if not same:
                w = sum_a[hi] - sum_a[lo]
                np.add.at(links.added[1], lo_b, w)
                np.add.at(links.added[1], hi_b, -w)
            else:
                other = ~own
                w = sum_a[hi[other]] - sum_a[lo[other]]
                np.add.at(links.added[0], lo_b[other], w)
                np.add.at(links.added[0], hi_b[other], -w)
                for i, j in zip(lo[own], hi[own]):  # disjoint ranges
                    links.count[0][i:j] -= weight_a[i:j]
            # all rows of two linked ranges share a component (of a range
            # linked with itself, the range); neighbours are marked as runs
            for at, (i, j) in ((0, (lo, hi)), (1, (lo_b, hi_b))):
                np.add.at(links.joined[at], i, 1)
                np.add.at(links.joined[at], j - 1, -1)
            label = local_components(n + m, lo, lo_b + n, label)
        keep = ~whole & ~leaf & (apart - spread <= reach + SLACK)
        x, y, itself = x[keep], y[keep], itself[keep]
        if not len(x):
            continue
        # one more level of both trees; a leaf stands for itself
        down_x, down_y = np.maximum(a.children[x], 1), np.maximum(b.children[y], 1)
        many = down_x * down_y
        large = many >= MATRIX_FROM
        if large.any():
            met = [near_children(a, b, int(i), int(j), reach, bool(k)) for i, j, k in zip(x[large], y[large], itself[large])]
            todo.append((np.concatenate([i for i, _ in met]), np.concatenate([j for _, j in met])))
            x, y, itself, many, down_y = x[~large], y[~large], itself[~large], many[~large], down_y[~large]
        ends = np.cumsum(many)
        start = 0
        while start < len(x):
            stop = max(start + 1, int(np.searchsorted(ends, (ends[start - 1] if start else 0) + 16 * PAIRS_AT_ONCE, "right")))
            part = slice(start, stop)
            size = many[part]
            pair = np.repeat(np.arange(start, stop), size)
            k = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
            i, j = k // down_y[pair], k % down_y[pair]
            next_x = np.where(a.children[x[pair]] > 0, a.first[x[pair]] + i, x[pair])
            next_y = np.where(b.children[y[pair]] > 0, b.first[y[pair]] + j, y[pair])
            half = ~itself[pair] | (next_x <= next_y)
            todo.append((next_x[half], next_y[half]))
            start = stop
    for at, size, offset in ((0, n, 0), (1, m, n)):
        runs = np.flatnonzero(np.cumsum(links.joined[at])[:max(size - 1, 0)] > 0)
        label = local_components(n + m, runs + offset, runs + 1 + offset, label)
    if same:
        label = local_components(n + m, np.arange(n), np.arange(n) + n, label)
    counts = [links.count[k] + np.cumsum(links.added[k])[:-1] for k in (0, 1)]
    return counts[0], counts[1], label


def compare_blocks(a: np.ndarray, b: np.ndarray | None, weight_a: np.ndarray, weight_b: np.ndarray | None,
                   threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Linked weights and component labels of the rows of a, then of b (None:
    a with itself), in the given order."""
    same = b is None
    tree_a = build_tree(a)
    tree_b = tree_a if same else build_tree(b)
    order = tree_a.order if same else np.concatenate([tree_a.order, tree_b.order + len(a)])
    count, label = compare_trees(tree_a, None if same else tree_b, weight_a[tree_a.order],
                                 None if same else weight_b[tree_b.order], threshold)
    out_count, out_label = np.empty(len(order)), np.empty(len(order), np.int64)
    out_count[order], out_label[order] = count, order[label]
    return out_count, out_label


def compare_trees(a: CoverTree, b: CoverTree | None, weight_a: np.ndarray, weight_b: np.ndarray | None,
                  threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """As :func:`compare_blocks`, of rows in the order of their trees."""
    if b is not None:
        count_a, count_b, label = dual_traversal(a, b, weight_a, weight_b, threshold, False)
        return np.concatenate([count_a, count_b]), label
    n = len(a.unit)
    count, _, label = dual_traversal(a, a, weight_a, weight_a, threshold, True)
    return count, label[:n] % n  # places of the copy fold back


def choose_pivots(units: np.ndarray, count: int) -> np.ndarray:
    """Farthest-first rows: a prefix is a net at each halving of the radius."""
    chosen = [0]
    near = distances(units, units[0])
    while len(chosen) < min(count, len(units)):
        far = int(near.argmax())
        if near[far] <= 0:
            break
        chosen.append(far)
        near = np.minimum(near, distances(units, units[far]))
    return units[chosen]


def unit_rows(column: pa.Array) -> np.ndarray:
    """Rows of equal length as unit vectors in double precision."""
    flat = column.flatten().to_numpy().astype(np.float64)
    rows = flat.reshape(len(column), -1)
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return rows / np.sqrt(np.einsum("ij,ij->i", rows, rows))[:, None]


def _classes(vectors: DataFrame, vec_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows (id, key) and classes (key, label, dim, vector, weight, first_id);
    key is null where a vector links with nothing."""
    v = F.col(vec_col)
    # absent or NaN components compare as false
    sound = (F.size(v) > 0) & F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & F.exists(
        v, lambda x: x != 0) & F.col("label").isNotNull()
    key = F.concat_ws(":", F.col("label").cast("string"), F.sha2(F.array_join(v.cast("array<string>"), ","), 256))
    rows = vectors.select("id", "label", v.alias("vector"), F.when(F.coalesce(sound, F.lit(False)), key).alias("key"))
    classes = rows.where("key is not null").groupBy("key").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"),
        F.count(F.lit(1)).alias("weight"), F.min("id").alias("first_id"))
    return rows.select("id", "key"), classes.withColumn("dim", F.size("vector"))


def _lists(rows: np.ndarray, width: int, type_: pa.DataType) -> pa.Array:
    """Rows of ``width`` values each as a list column."""
    flat = pa.array(rows.reshape(-1)).cast(type_)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, rows.size + 1, width), pa.int32()), flat)


def _pivots(sized: DataFrame, label_type: str) -> DataFrame:
    """(label, dim, pivots): the pivots of each label of more than a block,
    one after another. Candidates are drawn by a hash of the class, a few for
    each pivot, so that a task sees at most a multiple of the square root of a
    label's classes."""
    wanted = F.least(F.ceil(F.col("n") / BLOCK), F.ceil(F.sqrt("n"))).cast("int")
    draw = F.pmod(F.xxhash64("key", F.lit("pivot")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = (sized.where(F.col("n") > BLOCK).withColumn("wanted", wanted)
             .where(draw < F.col("wanted") * CANDIDATES / F.col("n"))
             .groupBy("label", "dim").agg(F.first("wanted").alias("wanted"),
                                          F.sort_array(F.collect_list(F.struct("key", "vector"))).alias("drawn"))
             .select("label", "dim", "wanted", F.flatten("drawn.vector").alias("flat")))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim = batch.column("dim")[r].as_py()
                units = unit_rows(pa.FixedSizeListArray.from_arrays(batch.column("flat")[r].values, dim))
                pivots = choose_pivots(units, batch.column("wanted")[r].as_py())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("label").slice(r, 1), batch.column("dim").slice(r, 1),
                     _lists(pivots, pivots.size, pa.float64())], ["label", "dim", "pivots"])

    return drawn.mapInArrow(chosen, f"label {label_type}, dim int, pivots array<double>")


def _members(sized: DataFrame, pivots: DataFrame, label_type: str) -> DataFrame:
    """Classes with their cell (the nearest pivot) and the distance to it.

    Classes meet the pivots in packs of about a block, one row a pack.
    """
    packs = F.ceil(F.col("n") / BLOCK)
    packed = (sized.withColumn("pack", F.pmod(F.xxhash64("key", F.lit("pack")), packs))
              .groupBy("label", "dim", "pack").agg(F.collect_list(F.struct("key", "weight", "vector")).alias("rows"))
              .select("label", "dim", F.col("rows.key").alias("keys"), F.col("rows.weight").alias("weights"),
                      F.flatten("rows.vector").alias("flat")))
    vector_type = sized.schema["vector"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim, flat = batch.column("dim")[r].as_py(), batch.column("flat")[r].values
                n = len(flat) // dim
                cell, far = np.zeros(n, np.int32), np.full(n, 2.0)
                if batch.column("pivots")[r].is_valid:
                    units = unit_rows(pa.FixedSizeListArray.from_arrays(flat, dim))
                    at = batch.column("pivots")[r].values.to_numpy().reshape(-1, dim)
                    far[:] = np.inf
                    for k in range(0, len(at), BLOCK):
                        d = np.sqrt(np.maximum(2 - 2 * (units @ at[k:k + BLOCK].T), 0))
                        low = d.min(axis=1)
                        nearer = low < far
                        cell[nearer], far[nearer] = d.argmin(axis=1)[nearer] + k, low[nearer]
                vector = pa.ListArray.from_arrays(pa.array(np.arange(0, len(flat) + 1, dim), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("keys")[r].values, pa.repeat(batch.column("label")[r], n),
                     pa.repeat(batch.column("dim")[r], n), pa.array(cell), pa.array(far),
                     batch.column("weights")[r].values, vector], ["key", "label", "dim", "cell", "far", "weight", "vector"])

    return packed.join(pivots, ["label", "dim"], "left").mapInArrow(
        placed, f"key string, label {label_type}, dim int, cell int, far double, weight long, vector {vector_type}")


def _near_cells(cells: DataFrame, pivots: DataFrame, label_type: str, reach: float) -> DataFrame:
    """Pairs of two cells whose pivots are near enough for a link between them."""
    listed = (cells.groupBy("label", "dim").agg(F.sort_array(F.collect_list(F.struct("cell", "far", "blocks"))).alias("cells"))
              .where(F.size("cells") > 1).join(pivots, ["label", "dim"])
              .select("label", "dim", F.col("cells.cell").alias("cell"), F.col("cells.far").alias("far"),
                      F.col("cells.blocks").alias("blocks"), "pivots",
                      F.explode(F.sequence(F.lit(0), F.size("cells") - 1, F.lit(PIVOT_ROWS))).alias("start"))
              .repartition("label", "dim", "start"))

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r].values.to_numpy()
                dim, start = batch.column("dim")[r].as_py(), batch.column("start")[r].as_py()
                cell, far, blocks = get("cell"), get("far"), get("blocks")
                at = get("pivots").reshape(-1, dim)[cell]
                rows = np.arange(start, min(start + PIVOT_ROWS, len(cell)))
                apart = np.sqrt(np.maximum(2 - 2 * (at[rows] @ at.T), 0))
                found = apart <= far[rows][:, None] + far[None, :] + reach + SLACK
                i, j = np.nonzero(found & (rows[:, None] < np.arange(len(cell))[None, :]))
                i = rows[i]
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(batch.column("label")[r], len(i)), pa.repeat(batch.column("dim")[r], len(i)),
                     pa.array(cell[i]), pa.array(blocks[i]), pa.array(cell[j]), pa.array(blocks[j])],
                    ["label", "dim", "cell_a", "blocks_a", "cell_b", "blocks_b"])

    return listed.mapInArrow(near, f"label {label_type}, dim int, cell_a int, blocks_a int, cell_b int, blocks_b int")


def _planted(blocks: DataFrame) -> DataFrame:
    """Blocks in the order of their cover trees, with the trees' nodes."""
    def planted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                dim, flat = batch.column("dim")[r].as_py(), batch.column("flat")[r].values
                tree = build_tree(unit_rows(pa.FixedSizeListArray.from_arrays(flat, dim)))
                order = pa.array(tree.order)
                rows = flat.to_numpy().reshape(-1, dim)[tree.order]
                one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
                nodes = [one(pa.array(getattr(tree, c)).cast(pa.float64() if t == "double" else pa.int32()))
                         for c, t in NODES.items()]
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c).slice(r, 1) for c in ("label", "dim", "cell", "block")],
                     *[one(batch.column(c)[r].values.take(order)) for c in ("keys", "weights")],
                     _lists(rows, rows.size, flat.type), *nodes],
                    ["label", "dim", "cell", "block", "keys", "weights", "flat", *NODES])

    given = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema)
    return blocks.mapInArrow(planted, ", ".join([given, *[f"{c} array<{t}>" for c, t in NODES.items()]]))


def _blocks(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Blocks of classes with their trees, and the pairs of blocks to compare."""
    reach = float(np.sqrt(max(2 - 2 * threshold, 0.0)))
    label_type = classes.schema["label"].dataType.simpleString()
    group = ["label", "dim"]
    sizes = materialize(classes.groupBy(*group).agg(F.count(F.lit(1)).alias("n")))
    sized = classes.join(sizes, group)
    pivots = materialize(_pivots(sized, label_type))
    members = materialize(_members(sized, pivots, label_type))
    cells = materialize(members.groupBy(*group, "cell").agg(
        F.max("far").alias("far"), F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks")))
    blocks = (members.join(cells.select(*group, "cell", "blocks"), [*group, "cell"])
              .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
              .groupBy(*group, "cell", "block").agg(F.collect_list(F.struct("key", "weight", "vector")).alias("rows"))
              .select(*group, "cell", "block", F.col("rows.key").alias("keys"), F.col("rows.weight").alias("weights"),
                      F.flatten("rows.vector").alias("flat")))
    own = cells.select(*group, F.col("cell").alias("cell_a"), F.col("blocks").alias("blocks_a"),
                       F.col("cell").alias("cell_b"), F.col("blocks").alias("blocks_b"))
    return _planted(blocks), own.unionByName(_near_cells(cells, pivots, label_type, reach))


def _work(blocks: DataFrame, cell_pairs: DataFrame, threshold: float) -> DataFrame:
    """One row (u, v, weight) of each point of each block pair: its component
    in the pair, and the linked weight."""
    pairs = cell_pairs.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks_a") - 1)).alias("block_a"))
    pairs = pairs.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks_b") - 1)).alias("block_b"))
    pairs = pairs.where("cell_a != cell_b or block_a <= block_b").select("label", "dim", "cell_a", "block_a", "cell_b", "block_b")
    shipped = ["keys", "weights", "flat", *NODES]

    def side(s: str) -> DataFrame:
        return blocks.select("label", "dim", *[F.col(c).alias(f"{c}_{s}") for c in ("cell", "block", *shipped)])

    joined = (pairs.join(side("a"), ["label", "dim", "cell_a", "block_a"])
              .join(side("b"), ["label", "dim", "cell_b", "block_b"]))
    itself = F.expr("cell_a = cell_b and block_a = block_b")
    work = joined.select("dim", itself.alias("itself"), *[f"{c}_a" for c in shipped],
                         *[F.when(~itself, F.col(f"{c}_b")).alias(f"{c}_b") for c in shipped])

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch.column(c)[r].values
                dim, itself = batch.column("dim")[r].as_py(), batch.column("itself")[r].as_py()

                def tree(s: str) -> CoverTree:
                    unit = unit_rows(pa.FixedSizeListArray.from_arrays(get(f"flat_{s}"), dim))
                    nodes = [get(f"{c}_{s}").to_numpy().astype(float if t == "double" else np.int64) for c, t in NODES.items()]
                    return CoverTree(unit, np.arange(len(unit)), *nodes)

                keys = get("keys_a").to_pylist() + ([] if itself else get("keys_b").to_pylist())
                count, label = compare_trees(
                    tree("a"), None if itself else tree("b"), get("weights_a").to_numpy(),
                    None if itself else get("weights_b").to_numpy(), threshold)
                at = np.flatnonzero((count > 0) | (label != np.arange(len(keys))))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([keys[i] for i in at], pa.string()), pa.array([keys[label[i]] for i in at], pa.string()),
                     pa.array(count[at].astype(np.int64))], ["u", "v", "n"])

    return work.mapInArrow(compared, "u string, v string, n long")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD) -> DataFrame:
    """Id column, ``n_links``, ``component_id`` and ``kept`` of every row."""
    named = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vec_col).alias("vector"))
    rows, classes = _classes(named, "vector")
    rows, classes = materialize(rows), materialize(classes)
    blocks, cell_pairs = _blocks(classes, threshold)
    found = materialize(_work(materialize(blocks), cell_pairs, threshold))
    linked = found.groupBy("u").agg(F.sum("n").alias("n")).withColumnRenamed("u", "key")
    roots = connected_components(found.where("u != v").select("u", "v"))
    joined = (classes.select("key", "weight", "first_id").join(linked, "key", "left")
              .join(roots.select(F.col("vertex").alias("key"), "root"), "key", "left")
              .select("key", "first_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                      F.coalesce("root", "key").alias("root")))
    joined = materialize(joined)
    smallest = materialize(joined.groupBy("root").agg(F.min("first_id").alias("component_id")))
    of_class = materialize(joined.join(smallest, "root").select(F.col("key").alias("_key"), "n_links", "component_id"))
    out = rows.join(of_class, F.col("key") == F.col("_key"), "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                      component.alias("component_id"), (F.col("id") == component).alias("kept"))
