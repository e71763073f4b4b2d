"""Embeddings, mixing, sharding, archives and the pipeline."""

import hashlib
import math
from collections import Counter

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

import corpus_pipeline
from tidelink.llm import covertree, graph, mixing, queries, sharding, warc
from tidelink.llm.common import documents, table, workers_import

# --- components --------------------------------------------------------------


def test_connected_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (200, 2))] + [(0, k) for k in range(300, 360)]
    edges += [(400 + k, 401 + k) for k in range(40)]
    label = graph.local_components(500, *map(np.array, zip(*edges)))
    got = {r.vertex: r.root for r in connected(spark, edges)}
    assert got == {v: int(label[v]) for e in edges if e[0] != e[1] for v in e}
    assert connected(spark, []) == []


def connected(spark, edges):
    return graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()


# --- embeddings --------------------------------------------------------------

def brute_links(rows, threshold=0.98):
    ok = [r.label is not None and r.embedding is not None and len(r.embedding) > 0 and any(x for x in r.embedding if x is not None)
          and all(x is not None and math.isfinite(x) for x in r.embedding) for r in rows]
    unit = [np.array(r.embedding, float) / np.linalg.norm(np.array(r.embedding, float)) if o else None for r, o in zip(rows, ok)]
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and rows[i].label == rows[j].label and len(unit[i]) == len(unit[j])
             and unit[i] @ unit[j] >= threshold] for i in range(n)]
    label = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            low = min([label[i], *(label[j] for j in near[i])])
            if low < label[i]:
                label[i], changed = low, True
    ids = {k: min(r.vec_id for r, lab in zip(rows, label) if lab == k) for k in set(label)}
    return Counter((r.vec_id, len(x), ids[lab], r.vec_id == ids[lab]) for r, x, lab in zip(rows, near, label))


def vectors(spark):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(6, 8))
    rows = [(i, [float(x) for x in centres[i % 6] + rng.normal(size=8) * 0.08 * (i % 5)], i % 2) for i in range(160)]
    rows += [(200, rows[0][1], 0), (201, [2 * x for x in rows[0][1]], 0), (202, rows[0][1], 1), (203, rows[0][1], None),
             (204, None, 0), (205, [0.0] * 8, 0), (206, [math.nan] + [1.0] * 7, 0), (207, [math.inf] + [1.0] * 7, 0),
             (208, [None] + [1.0] * 7, 0), (209, [], 0), (210, [1.0, 2.0], 0), (211, [1.0, 2.0], 0), (0, rows[0][1], 0)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("key", F.lit("mine"))


@pytest.mark.parametrize("block", [7, 1024])
def test_cover_tree_matches_brute_force(spark, monkeypatch, block):
    workers_import(spark)
    monkeypatch.setattr(covertree, "BLOCK", block)
    df = vectors(spark)
    got = Counter(tuple(r) for r in covertree.near_duplicates(df).collect())
    assert got == brute_links(df.collect())
    assert covertree.near_duplicates(df.limit(0)).count() == 0


def test_pivots_follow_the_classes_of_every_label(spark, monkeypatch):
    workers_import(spark)
    monkeypatch.setattr(covertree, "BLOCK", 4)
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 16))
    rows = [(f"k{i}", lab, [float(x) for x in centres[i % 20] + rng.normal(size=16) * 0.01], 1, 16)
            for lab, n in (("a", 300), ("b", 60), ("c", 3)) for i in range(n)]
    classes = spark.createDataFrame(rows, "key string, label string, vector array<double>, weight long, dim int")
    classes = classes.withColumn("key", F.concat("label", "key"))
    blocks, pairs = covertree._blocks(classes, 0.98)
    blocks, pairs = blocks.collect(), pairs.collect()
    assert sorted(k for b in blocks for k in b["keys"]) == sorted(r.key for r in classes.collect())
    cells = Counter(label for label, _ in {(b["label"], b["cell"]) for b in blocks})
    assert cells["a"] == math.ceil(math.sqrt(300)) and cells["b"] == math.ceil(math.sqrt(60)) and cells["c"] == 1
    for b in blocks:  # in the order of the tree, whose root covers them
        rows = np.array(b["flat"]).reshape(-1, 16)
        unit = rows / np.linalg.norm(rows, axis=1)[:, None]
        assert covertree.distances(unit, unit[b["centre"][0]]).max() <= b["radius"][0] + 1e-7
        assert (b["low"][0], b["high"][0]) == (0, len(rows)) == (0, len(b["keys"]))
    # tight clusters: a cell meets itself and cells of its own clusters only
    many = Counter(p["label"] for p in pairs)
    assert many["a"] < 3 * cells["a"] and many["c"] == 1
    assert len({(p["label"], p["cell_a"], p["cell_b"]) for p in pairs}) == len(pairs)


@pytest.mark.parametrize("matrix_from", [1, 256, 1 << 40])
def test_cover_tree_levels_and_traversal(monkeypatch, matrix_from):
    monkeypatch.setattr(covertree, "MATRIX_FROM", matrix_from)
    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=(150, 5)), np.repeat(rng.normal(size=(3, 5)), 30, 0) + rng.normal(size=(90, 5)) * 0.02])
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    tree = covertree.build_tree(unit)
    assert sorted(tree.order) == list(range(len(unit)))
    for k in range(len(tree.centre)):
        points = tree.unit[tree.low[k]:tree.high[k]]
        assert covertree.distances(points, tree.unit[tree.centre[k]]).max() <= tree.radius[k] + 1e-7
        kids = range(tree.first[k], tree.first[k] + tree.children[k])
        assert tree.children[k] == 0 or tree.centre[k] in {tree.centre[j] for j in kids}       # nested
        assert all(tree.radius[j] <= 2 ** (np.ceil(np.log2(tree.radius[k])) - 1) + 1e-12 for j in kids)  # halving
    weight = rng.integers(1, 4, len(unit))
    for a, b in ((unit, None), (unit[:140], unit[140:])):
        wa, wb = (weight, None) if b is None else (weight[:140], weight[140:])
        count, label = covertree.compare_blocks(a, b, wa, wb, 0.98)
        near = unit @ unit.T >= 0.98
        if b is None:
            np.fill_diagonal(near, False)
        else:
            near[:140, :140] = near[140:, 140:] = False
        assert (count == near @ weight).all()
        want = graph.local_components(len(unit), *np.nonzero(near))
        assert len(set(zip(label, want))) == len(set(label)) == len(set(want))


# --- mixing ------------------------------------------------------------------

def test_flight_keeps_totals_and_expectations():
    rng = np.random.default_rng(6)
    size = np.sort(rng.lognormal(5, 1.2, 400).astype(int))[::-1]
    p = np.full(400, 0.3)
    taken = []
    for seed in range(60):
        gen = np.random.default_rng(seed)
        q = mixing.fly(p, size, gen)
        assert ((q > 0) & (q < 1)).sum() <= 2 and abs(q @ size - p @ size) < 1e-6 * size.sum()
        assert abs(q.sum() - p.sum()) < 1              # a fraction, where the last sizes are equal
        done = mixing.land(q, size, gen)
        assert set(done) <= {0.0, 1.0}
        assert abs(done @ size - p @ size) <= 0.001 * size.sum()
        taken.append(done)
    assert abs(np.mean(taken) - 0.3) < 0.02


def brute_targets(sizes):
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, (s or "").encode())))}
    total, capped = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in sizes if s not in capped]
        level = (total - sum(capped.values())) / max(1, sum(weight[s] for s in free))
        over = [s for s in free if weight[s] * level > 2 * sizes[s]]
        if not over:
            return {s: capped.get(s, weight[s] * level) for s in sizes}
        capped |= {s: 2.0 * sizes[s] for s in over}


def test_mix_meets_targets_and_reruns_agree(spark):
    rng = np.random.default_rng(8)
    rows = [(i, ["a", "b", "é", None, "Z", "nil"][i % 6], 0 if i % 6 == 5 else int(rng.lognormal(4, 1))) for i in range(3000)]
    rows += [(7, "a", 50)] * 5 + [(None, "b", None)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("target", F.lit("mine"))
    out = mixing.mix(df).select("doc_id", F.col("source").alias("s"), "mix.*").collect()
    assert len(out) == len(rows)
    sizes = Counter()
    for _, s, n in rows:
        sizes[s] += n or 0
    want, taken = brute_targets(dict(sizes)), Counter()
    for r in out:
        assert r.source_size == sizes[r.s] and abs(r.target - want[r.s]) < 1e-6 and r.copies in (0, 1, 2)
        taken[r.s] += r.size * r.copies
    assert all(abs(taken[s] - want[s]) <= 0.005 * sizes[s] + 1e-9 for s in sizes)
    again = mixing.mix(df.repartition(3)).select("doc_id", F.col("source").alias("s"), "mix.*").collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, out))
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.repeat_rows(df, F.lit(2)).count() == 2 * len(rows)


def test_small_blocks_fly_on(spark, monkeypatch):
    rows = [(i, "only", 10 + i % 90) for i in range(900)] + [(2000 + i, "other", 50) for i in range(700)]
    df = spark.createDataFrame(rows, "row long, source string, size long").withColumn("id", F.col("row"))
    targets = mixing.source_targets(df)
    out = mixing.copies(df, targets, block_rows=50, fan_in=3).collect()
    assert len(out) == len(rows)
    size = {r[0]: (r[1], r[2]) for r in rows}
    taken = Counter()
    for r in out:
        taken[size[r["row"]][0]] += size[r["row"]][1] * r.copies
    for r in targets.collect():
        assert abs(taken[r.source] - r.target) <= 100


def test_repeated_rows_are_dealt_over_blocks(spark, monkeypatch):
    rows = [(1, "a", 50)] * 3000 + [(None, "a", 7)] * 2000 + [(i, "ab"[i % 2], i % 90) for i in range(1000)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(4)
    flight, largest = mixing._flight, []

    def watched(flying, *rest):
        largest.append(flying.groupBy("source", "block").count().agg(F.max("count")).first()[0])
        return flight(flying, *rest)

    monkeypatch.setattr(mixing, "_flight", watched)
    assert mixing.mix(df).count() == len(rows)
    assert max(largest) <= mixing.BLOCK_ROWS


# --- sharding ----------------------------------------------------------------

def brute_table(shards, slots, weights):
    order = {}
    for name in shards:
        d = hashlib.sha256(name.encode()).digest()
        start, step = int.from_bytes(d[:8], "big") % slots, int.from_bytes(d[8:16], "big") % (slots - 1) + 1
        order[name] = iter([(start + j * step) % slots for j in range(slots)])
    table = {}
    while True:
        for name in sorted(shards):
            for _ in range(weights[name]):
                slot = next(x for x in order[name] if x not in table)
                table[slot] = name
                if len(table) == slots:
                    return [table[k] for k in range(slots)]


def test_table_is_filled_in_turns():
    names = ["s3", "s1", "s2", "s0"]
    for weights in ([1, 1, 1, 1], [1, 3, 1, 2]):
        got = sharding.fill_table(names, 101, weights)
        assert [names[k] for k in got] == brute_table(names, 101, dict(zip(names, weights)))
    before, after = sharding.fill_table(names, 10007), sharding.fill_table(names[:3], 10007)
    stayed = before != 3
    assert (before[stayed] != after[stayed]).mean() < 0.1
    for bad in (([], 101), (["a", "a"], 101), (["a"], 100)):
        with pytest.raises(ValueError):
            sharding.fill_table(*bad)


def test_place_and_write(spark, tmp_path):
    docs = documents(spark, SF_SMALL).select("doc_id", "text", F.lit("mine").alias("shard"))
    extra = spark.createDataFrame([(None, "x"), (5, "y"), (5, "z")], "doc_id long, text string").withColumn("shard", F.lit("q"))
    placed = sharding.place(docs.unionByName(extra), queries.SHARDS)
    filled = sharding.fill_table(queries.SHARDS)
    for r in placed.collect():
        slot = int(hashlib.md5(("" if r.doc_id is None else str(r.doc_id)).encode()).hexdigest()[:15], 16) % sharding.SLOTS
        assert (r.slot, r.shard) == (slot, queries.SHARDS[filled[slot]])
    sharding.write_shards(placed, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == placed.count()


# --- WARC --------------------------------------------------------------------

def test_archive_round_trip(spark, tmp_path):
    rows = [(1, "http://a", "same"), (2, "http://b\r\nX: y", "same"), (3, None, "é"), (4, "http://d", None), (5, "http://e", ""),
            (6, "http://f", "x" * 200_000), (6, "http://f", "x" * 200_000), (None, "http://g", "same"), (None, "http://h", "lone")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("payload", F.lit("mine"))
    archive = warc.write_archive(pages, str(tmp_path / "warc"))
    assert archive.payloads(spark).count() == 5
    out = warc.read_archive(spark, archive).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        body = {1: "same", 2: "same", 3: "é", 4: "", 5: "", 6: "x" * 200_000, None: None}[r.record_id]
        if body is not None:
            assert r.payload_bytes == len(body.encode()) and bytes(r.payload) == body.encode()
        head, _, rest = bytes(r.record).partition(b"\r\n\r\n")
        block = b"" if r.record_type == "revisit" else bytes(r.payload)
        assert rest == block + b"\r\n\r\n" and head.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode())
        assert f"Content-Length: {len(block)}".encode() in head and b"\r\nX: y" not in head
        by_id.setdefault(r.record_id, []).append((r.record_type, r.refers_to))
    assert by_id[2] == [("response", None)] and by_id[1] == [("revisit", "2")]
    assert by_id[5] == [("response", None)] and by_id[4] == [("revisit", "5")]
    assert by_id[6] == [("response", None)] * 2
    assert sorted(by_id[None], key=str) == [("response", None), ("revisit", "2")]
    empty = warc.write_archive(pages.limit(0), str(tmp_path / "none"))
    assert warc.read_archive(spark, empty).count() == 0


def test_archive_damage_is_noticed(spark, tmp_path):
    pages = spark.createDataFrame([(1, "u", "a")], "page_id long, url string, html string")
    archive = warc.write_archive(pages, str(tmp_path / "warc"))
    bad = archive.payloads(spark).withColumn("payload", F.lit(b"b")).collect()
    spark.createDataFrame(bad, archive.payloads(spark).schema).write.mode("overwrite").parquet(f"{archive.path}/payloads")
    with pytest.raises(Exception, match="damaged payload"):
        warc.read_archive(spark, archive).collect()


def test_minimum_revisit_size(spark, tmp_path):
    rows = [(1, "u", "abc"), (2, "u", "abc"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = warc.read_archive(spark, warc.write_archive(pages, str(tmp_path / "w"), min_revisit_bytes=5)).collect()
    assert {r.record_id: r.record_type for r in out} == {1: "response", 2: "response", 3: "revisit", 4: "response"}


def test_archive_oracle(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF_SMALL}/pages.parquet'")
    rel = con.execute(queries.ORACLES["op10_warc_content_store"])
    names = [d[0] for d in rel.description]
    got = queries.QUERIES["op10_warc_content_store"](spark, SF_SMALL).select(*names).collect()
    assert sorted(map(tuple, got)) == sorted(rel.fetchall())


def test_archive_query_rebuilds_records(spark, monkeypatch):
    read = warc.read_archive
    cut = lambda *a: read(*a).withColumn("record", F.expr("substring(record, 1, octet_length(record) - 5)"))
    monkeypatch.setattr(warc, "read_archive", cut)
    with pytest.raises(Exception, match="record not rebuilt"):
        queries.QUERIES["op10_warc_content_store"](spark, SF_SMALL).collect()


# --- pipeline ----------------------------------------------------------------

def test_pipeline_stages(spark):
    workers_import(spark)
    docs = documents(spark, SF_SMALL)
    copy = docs.limit(1).withColumn("doc_id", F.lit(10 ** 9))
    docs = docs.unionByName(copy)
    ids = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.materialize(stage(spark, docs, SF_SMALL))
        assert out.columns == docs.columns, name
        ids.append([r.doc_id for r in out.select("doc_id").collect()])
        docs = out
    quality = queries.QUERIES["op4_host_rules"](spark, SF_SMALL).where("kept").collect()
    assert set(ids[0]) - {10 ** 9} == {r.doc_id for r in quality}
    assert set(ids[1]) <= set(ids[0]) and len(ids[1]) >= 0.97 * len(ids[0])
    assert 10 ** 9 not in ids[2] and len(set(ids[2])) == len(ids[2])
    assert set(ids[3]) <= set(ids[2]) and max(Counter(ids[3]).values()) <= 2
    last = corpus_pipeline.encode(spark, docs, SF_SMALL)
    assert last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and last.count() == len(ids[3])


def test_pipeline_of_an_empty_table(spark):
    docs = documents(spark, SF_SMALL).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0


def test_every_query_runs_on_its_table(spark):
    n = documents(spark, SF_SMALL).count()
    for name in ("op1_toxicity_severity", "op3_langid_subwords", "op5_cube_mixing", "op8_lookup_sharding"):
        assert queries.QUERIES[name](spark, SF_SMALL).count() == n
    out = Counter(tuple(r) for r in queries.QUERIES["op6_cover_tree"](spark, SF_SMALL).collect())
    assert out == brute_links(table(spark, SF_SMALL, "embeddings").collect())
