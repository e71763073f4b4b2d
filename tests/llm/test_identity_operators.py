"""Block naming, Merkle manifest and prefix trie against plain versions."""

import random
import re
from collections import Counter, defaultdict
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidelink.llm import block_names, merkle, prefix_trie, queries
from tidelink.llm.common import workers_import
from tidelink.llm.perfect_hash import PerfectHash

DOCS = "doc_id long, source string, lang string, n_chars long, text string, name string, row int, idx int"


def digest(*parts):
    return sha256("".join(parts).encode()).hexdigest()


# --- exact duplicates ----------------------------------------------------------

def texts():
    rng = random.Random(4)
    rows = [(k, "".join(rng.choice("ab \t\n") for _ in range(rng.randrange(60)))) for k in range(120)]
    rows += [(200 + k, "hot text " * (1 + k % 2)) for k in range(60)]
    rows += [(300, None), (301, ""), (302, " \n\x0b\x0c\r\t"), (303, "é" * 40), (304, "é " * 40), (305, "é" * 39 + "è")]
    rows += [(400, "x" * 5000), (401, " " + "x" * 5000), (402, "x" * 4999 + "y"), (403, " x"), (404, "x")]
    rows += [(500, "twice"), (500, "twice"), (None, "twice"), (None, "alone"), (501, "twic e")]
    return rows


def brute_groups(rows):
    groups = defaultdict(list)
    for at, (i, text) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]", "", text or "")].append((-len(text or ""), i is None, i or 0, at))
    out = []
    for key, members in groups.items():
        best = min(members)
        keep = None if best[1] else best[2]
        for m in members:
            # of rows equal in length and id one stays, whichever it is
            out.append((None if m[1] else m[2], keep, len(members), m == best, digest(key)))
    return Counter(out)


def weak_hashes(block, salt):
    if salt < 2:
        return F.pmod(F.xxhash64(block), F.lit(5)), F.lit(salt).cast("long")
    return block_names.block_hashes(block, salt)


@pytest.mark.parametrize("size,hashes", [(16, weak_hashes), (2048, block_names.block_hashes)])
def test_exact_duplicates_match_brute_force(spark, size, hashes):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "clash", 1, 2) for i, t in rows],
                                 "doc_id long, text string, name string, row int, h1 int").repartition(3)
    got = block_names.exact_duplicates(docs, block_bytes=size, hashes=hashes)
    assert Counter(map(tuple, got.collect())) == brute_groups(rows)


def test_exact_duplicates_of_nothing(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    got = block_names.exact_duplicates(none)
    assert got.collect() == [] and got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_block_naming_runs_without_python_workers(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    plan = block_names.exact_duplicates(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# --- Merkle manifest -----------------------------------------------------------

def brute_level(level):
    return [digest(*level[i:i + 2]) for i in range(0, len(level), 2)]


def brute_path(level, at):
    path = []
    while len(level) > 1:
        run = level[at // 2 * 2:at // 2 * 2 + 2]
        path.append([(at % 2 == 1, d) for k, d in enumerate(run) if k != at % 2])
        level, at = brute_level(level), at // 2
    return path, level[0]


def brute_fold(leaf, path):
    for step in path:
        leaf = digest(*[d for left, d in step if left], leaf, *[d for left, d in step if not left])
    return leaf


def brute_manifest(rows):
    def leaf(i, source, lang, n, text):
        return digest(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)))

    groups = defaultdict(list)
    for r in rows:
        groups[r[2]].append(r[:5])
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = []
    for g in langs:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
        leaves = [leaf(*r) for r in groups[g]]
        trees.append((leaves, [brute_path(leaves, k) for k in range(len(leaves))]))
    subroots = [paths[0][1] for _, paths in trees]
    out = []
    for at, (g, (leaves, paths)) in enumerate(zip(langs, trees)):
        above, root = brute_path(subroots, at)
        for r, own, (path, subroot) in zip(groups[g], leaves, paths):
            claimed = own
            if r[0] is not None and crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None:
                claimed = leaf(*r[:3], r[3] + 1, r[4])
            proof = digest(*[d for step in path + above for _, d in step])
            fold = brute_fold(claimed, path + above)
            out.append((r[0], own, subroot, root, proof, fold, fold == root))
    return Counter(out)


def manifest_rows():
    rng = random.Random(5)
    rows = [(k, rng.choice(["a", None, "b:1"]), rng.choice(["de", "en", "é", None, "Z"]), rng.choice([None, 5, 77, 2**63 - 1]),
             rng.choice([None, "", "täxt", "x" * 300]), "clash", 1, 2) for k in range(150)]
    rows += [(900, "s", "one", 3, "t", "c", 1, 2)]
    rows += [(901, "s", "de", 3, "t", "c", 1, 2)] * 3 + [(901, "s", "de", 4, "t", "c", 1, 2)]
    rows += [(None, "s", "de", 3, "t", "c", 1, 2), (None, None, None, None, None, "c", 1, 2)]
    return rows


def proven(spark, rows, tmp_path, **kw):
    workers_import(spark)
    spark.createDataFrame(rows, DOCS).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return queries.QUERIES["op12_octopus_manifest"](spark, str(tmp_path))


def test_manifest_matches_brute_force(spark, tmp_path):
    rows = manifest_rows()
    got = Counter(map(tuple, proven(spark, rows, tmp_path).collect()))
    assert got == brute_manifest(rows)
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("rows", [[], manifest_rows()[:1]])
def test_small_manifests(spark, tmp_path, rows):
    assert Counter(map(tuple, proven(spark, rows, tmp_path).collect())) == brute_manifest(rows)


def test_blocks_of_any_size_give_the_same_proofs(spark):
    workers_import(spark)
    rows = spark.range(77).select("id", F.when(F.col("id") < 60, F.lit("hot")).otherwise((F.col("id") % 9).cast("string")).alias("g"),
                                  F.sha2(F.col("id").cast("string"), 256).alias("d"))
    found = []
    for levels in (2, 12):
        made = merkle.build(rows, "g", "id", "d", block_levels=levels)
        found.append({r.row.id: (r.subroot, r.root, tuple(r.proof), r.folded_root)
                      for r in merkle.prove(made, block_levels=levels).collect()})
    assert all(f == found[0] for f in found) and len(found[0]) == 77
    assert all(root == fold for _, root, _, fold in found[0].values())


@pytest.mark.parametrize("n", [1, 2, 5, 8, 13, 64, 100])
def test_multiproof_is_enough_and_least(n):
    rng = random.Random(n)
    leaves = [digest(str(k)) for k in range(n)]
    tree = [dict(enumerate(leaves))]
    while len(tree[-1]) > 1:
        tree.append(merkle.parents(tree[-1]))
    for _ in range(10):
        some = sorted(rng.sample(range(n), rng.randint(1, n)))
        need = merkle.missing_nodes(some, n)
        nodes = merkle.derived({i: leaves[i] for i in some}, {(k, i): tree[k][i] for k, i in need}, n)
        for i in some:
            path = merkle.siblings(nodes, i, n)
            assert merkle.folded(leaves[i], path) == tree[-1][0]
            assert [d for _, d in path if d] == [d for step in brute_path(leaves, i)[0] for _, d in step]
        # every node of every proof that the leaves do not give is asked for once, and no other
        covered = {(k, i >> k) for i in some for k in range(len(tree))}
        asked = {(k, (i >> k) ^ 1) for i in some for k in range(len(tree) - 1) if (i >> k) ^ 1 < len(tree[k])}
        assert sorted(need) == sorted(asked - covered)


# --- prefix trie ---------------------------------------------------------------

def conversations():
    rng = random.Random(6)
    rows = []
    for c in range(-12, 60):
        for t in range(rng.randrange(14)):
            rows.append((c, t, rng.choice(["user", "bot"]), rng.choice(["a", "bé", "", "long text"])))
    for c in range(100, 160):  # equal conversations
        rows += [(c, t, "user", f"same {t}") for t in range(10)]
    rows += [(200, t, "user", "hi" if t < 5 else str(t)) for t in range(400)]  # one long one
    rows += [(300, None, "user", "first"), (300, 0, None, None), (300, 0, None, None), (301, None, None, "x")]
    rows += [(None, 0, "user", "nobody's"), (401, 0, "user", "no base"), (404, 0, "bot", "short")]
    return rows


def brute_trie(rows):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            convs[c].append((turn is not None, turn or 0, digest(f"{len((role or '').encode())}:", role or "", text or ""),
                             role or "", text or ""))
    # turns of one number are ordered as the digests are, by signed halves

    def half(h, k):
        return int.from_bytes(bytes.fromhex(h[16 * k:16 * k + 16]), "big", signed=True)
    own = {c: [x[3:] for x in sorted(v, key=lambda x: (x[0], x[1], half(x[2], 0), half(x[2], 1)))] for c, v in convs.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built = own.get(base, [])[:h] + turns[h:]
        for d in range(len(built) + 1):
            members[tuple(built[:d])].append(c)
        ends[tuple(built)].append(c)
    kids = defaultdict(list)
    for key in members:
        if key:
            kids[key[:-1]].append(key)
    leaves, saved = {}, {}
    for key in sorted(members, key=len, reverse=True):
        leaves[key] = sum(leaves[k] for k in kids[key]) or 1
        saved[key] = sum(saved[k] for k in kids[key]) + (len(members[key]) - 1) * (len(key[-1][1].encode()) if key else 0)
    return Counter((min(m), len(key), min(members[key[:-1]]) if key else None, len(m), len(kids[key]), leaves[key], saved[key],
                    digest(",".join(map(str, sorted(ends[key]))))) for key, m in members.items())


def trie(spark, rows, **kw):
    workers_import(spark)
    df = spark.createDataFrame([(*r, 1, 2) for r in rows],
                               "conv_id long, turn long, role string, text string, depth int, chain int").repartition(3)
    got = prefix_trie.trie(*prefix_trie.with_shared_heads(prefix_trie.turns_of(df)), **kw)
    return Counter(map(tuple, got.collect()))


def test_trie_matches_brute_force(spark, monkeypatch):
    rows = conversations()
    want = brute_trie(rows)
    assert trie(spark, rows) == want
    # chains cut every few turns, shards of few nodes, ids packed by twos
    monkeypatch.setattr(prefix_trie, "CHAIN_TURNS", 16)
    monkeypatch.setattr(prefix_trie, "PACKED_IDS", 2)
    assert trie(spark, rows, shard_nodes=40) == want


def test_colliding_digests_are_found_and_replaced(spark):
    def weak(salt):
        low = [F.lit(0).cast("long")] * 3
        return [F.pmod(F.xxhash64("t1", "t2"), F.lit(3)), *low] if salt == 0 else prefix_trie.lanes(salt)

    rows = [r for r in conversations() if r[0] is not None and r[0] < 30]
    assert trie(spark, rows, summands=weak) == brute_trie(rows)


def test_trie_of_nothing_and_of_one(spark):
    assert trie(spark, []) == Counter()
    for rows in ([(7, 0, "user", "x")], [(5, 0, None, None)], [(None, 1, "a", "b")]):
        assert trie(spark, rows) == brute_trie(rows)


def test_perfect_hash_is_minimal_and_knows_its_keys():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 1000, 30_000):
        a, b = rng.integers(0, 2**63, (2, n)).astype(np.uint64)
        table = PerfectHash(a, b)
        assert sorted(table.slots(a, b).tolist()) == list(range(n))
        assert (table.slots(a + np.uint64(1), b) == -1).all()
    with pytest.raises(ValueError):
        PerfectHash(np.zeros(2, np.uint64), np.zeros(2, np.uint64))
