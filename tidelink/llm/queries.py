"""The queries of this package and their DuckDB SQL, by name."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.llm import (block_names, covertree, host_rules, langid, merkle, mixing, prefix_trie, sharding, simhash,
                          token_counts, toxicity, warc, word_bpe)
from tidelink.llm.common import documents, n_words_of, table, workers_import

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

CRC32 = """
xor(4294967295, list_reduce(
  list_prepend(4294967295::BIGINT, list_transform(range(1, len(%(s)s) + 1), lambda i: ascii(substr(%(s)s, i, 1))::BIGINT)),
  lambda c, byte: list_reduce(list_prepend(xor(c, byte), range(8)),
    lambda x, k: CASE WHEN x %% 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)))
"""


def query(name: str, sql: str | None = None):
    def register(fn):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            workers_import(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql.strip()
        return run
    return register


@query("op2_token_counts")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text; over_limit above 4096."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    return (docs.select("doc_id", n_bytes.alias("n_bytes"), token_counts.token_count(F.col("text")).alias("n_tokens"))
            .withColumn("over_limit", F.col("n_tokens") > 4096))


@query("op4_host_rules", r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM d),
win AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) >= 3)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, k) AS c FROM win) WHERE c > 1),
cover AS (
  SELECT rid, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY rid),
lines AS (
  SELECT rid, count(l) AS n_lines, count(l) - count(DISTINCT l) AS n_dup_lines
  FROM (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY rid),
facts AS (
  SELECT d.rid, doc_id, source, len(w.w) AS n_words,
    length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    coalesce(n_lines, 0) AS n_lines, coalesce(n_dup_lines, 0) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM d JOIN w USING (rid) LEFT JOIN cover USING (rid) LEFT JOIN lines USING (rid)),
fails AS (
  SELECT source AS host, unnest([
    {'r': 'short', 'f': n_words < 50}, {'r': 'repeats', 'f': 100 * n_repeat_words > 50 * n_words},
    {'r': 'symbols', 'f': 10 * n_symbols > n_words}, {'r': 'lines', 'f': 10 * n_dup_lines > 3 * n_lines},
    {'r': 'word_length', 'f': word_chars < 3 * n_words OR word_chars > 10 * n_words}]) AS x
  FROM facts WHERE source IS NOT NULL),
hosts AS (
  SELECT host, x.r AS r, count(*)::DOUBLE AS n, sum(CASE WHEN x.f THEN 1 ELSE 0 END)::DOUBLE AS f
  FROM fails GROUP BY 1, 2),
moments AS (
  SELECT r, sum(n) AS nn, count(*) - 1 AS freedom, sum(n) - sum(n * n) / sum(n) - (count(*) - 1) AS spread,
    sum(f) / sum(n) AS m, sum(f * f / n) AS q
  FROM hosts GROUP BY r),
prior AS (
  SELECT r, m, 1 / least(greatest(CASE WHEN m > 0 AND m < 1 AND spread > 0
      THEN ((q - nn * m * m) / (m * (1 - m)) - freedom) / spread ELSE 0.001 END, 0.001), 0.5) - 1 AS k
  FROM moments),
verdict AS (
  SELECT host, bool_and((f + m * k) / (n + k) <= 0.5) AS host_ok FROM hosts JOIN prior USING (r) GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  (NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND coalesce(host_ok, true)) AS kept
FROM facts LEFT JOIN verdict ON facts.source = verdict.host
""")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base measures, base verdict and host verdict of every document."""
    measured = host_rules.with_measures(documents(spark, sf_dir, "doc_id", "source", "text")).drop("text")
    judged = host_rules.judge(measured)
    return judged.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")])


@query("op7_bpe_lexicon")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids and of the decoded text of every whole text."""
    return word_bpe.digests(word_bpe.encode_decode(documents(spark, sf_dir, "doc_id", "text")))


@query("op9_simhash_tiles")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every whole text."""
    return simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))


@query("op3_langid_subwords")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every whole text."""
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = langid.identify(docs.select("doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", "rejected")


@query("op5_cube_mixing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes from every document."""
    docs = documents(spark, sf_dir, "doc_id", "source", "text")
    mixed = mixing.mix(docs.select("doc_id", "source", n_words_of(F.col("text")).alias("size")))
    return mixed.select("doc_id", "source", "mix.size", "mix.source_size", "mix.target",
                        (F.col("mix.size") * F.col("mix.copies")).alias("taken"))


@query("op10_warc_content_store", r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha1(b) AS h FROM p),
k AS (SELECT *, max(page_id) OVER (PARTITION BY h) AS keeper FROM d),
g AS (
  SELECT k.*, list_transform(range(0, 8), lambda i: ('0x' || substr(h, 5 * i + 1, 5))::BIGINT) AS v FROM k)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
  list_aggregate(list_transform(v, lambda x:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 15) & 31)::INT + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31)::INT + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31)::INT + 1, 1) ||
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31)::INT + 1, 1)), 'string_agg', '') AS payload_digest,
  CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = keeper THEN NULL ELSE keeper END AS refers_to
FROM g
""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a record, and read the records back."""
    archive = warc.write_archive(table(spark, sf_dir, "pages", "page_id", "url", "html"))
    read = warc.read_archive(spark, archive)
    # sizes and digests come from the rebuilt bytes, so every record is rebuilt
    response = F.col("record_type") == "response"
    held = F.when(response, warc.block_of(F.col("record"))).otherwise(F.col("payload"))
    read = read.select("*", held.alias("held"), F.octet_length("record").alias("record_bytes"))
    digest = F.when((warc.base32_sha1(F.col("held")) == F.col("payload_digest")) & (F.col("record_bytes") > 0),
                    F.col("payload_digest")).otherwise(F.raise_error(F.concat(
                        F.lit("record not rebuilt: "), F.coalesce(F.col("record_id").cast("string"), F.lit("null")))))
    return read.select(F.col("record_id").alias("page_id"), F.octet_length("held").cast("long").alias("payload_bytes"),
                       digest.alias("payload_digest"), "record_type",
                       F.col("refers_to").cast("long").alias("refers_to"))


SHARDS = [f"shard-{k:03d}" for k in range(128)]


@query("op1_toxicity_severity")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected toxicity grade of every whole text."""
    docs = documents(spark, sf_dir, "doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).drop("text")


@query("op6_cover_tree")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and keeper of every embedding."""
    return covertree.near_duplicates(table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label"))


@query("op8_lookup_sharding")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document."""
    return sharding.place(documents(spark, sf_dir, "doc_id"), SHARDS)


@query("op11_block_naming", r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, length(coalesce(text, '')) AS n,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS t FROM documents),
g AS (
  SELECT *, count(*) OVER (PARTITION BY t) AS group_size,
    row_number() OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST, rid) AS place,
    first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id NULLS LAST, rid) AS keep_id FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(t) AS text_sha256 FROM g
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return block_names.exact_duplicates(documents(spark, sf_dir, "doc_id", "text"))


def _field_sql(x: str) -> str:
    return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen({x}::VARCHAR) || ':' || {x} END"


def _leaf_sql(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


def _tree_sql(name: str, leaves: str) -> str:
    return f"""{name}(tree, level, i, n, digest) AS (
  {leaves}
  UNION ALL
  SELECT tree, level + 1, i // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY i))
  FROM {name} WHERE n > 1 GROUP BY tree, level, i // 2, n)"""


def _fold_sql(name: str, start: str, nodes: str) -> str:
    return f"""{name}(rid, tree, level, i, digest, proof) AS (
  {start}
  UNION ALL
  SELECT rid, f.tree, f.level + 1, f.i // 2,
    sha256(CASE WHEN s.digest IS NULL THEN f.digest WHEN f.i % 2 = 1 THEN s.digest || f.digest
      ELSE f.digest || s.digest END),
    proof || coalesce(s.digest, '')
  FROM {name} f JOIN {nodes} o ON o.tree = f.tree AND o.level = f.level AND o.i = f.i AND o.n > 1
  LEFT JOIN {nodes} s ON s.tree = f.tree AND s.level = f.level AND s.i = xor(f.i, 1))"""


@query("op12_octopus_manifest", f"""
WITH RECURSIVE d AS (
  SELECT *, {_leaf_sql('n_chars')} AS leaf,
    CASE WHEN {CRC32 % {'s': 'doc_id::VARCHAR'}} % 7 = 0 THEN {_leaf_sql('(n_chars + 1)')} END AS changed FROM documents),
l AS (
  SELECT row_number() OVER () AS rid, doc_id, leaf, coalesce(changed, leaf) AS claimed,
    dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
    count(*) OVER (PARTITION BY lang) AS n FROM d),
{_tree_sql('nodes', 'SELECT g, 0, i, n, leaf FROM l')},
subroots AS (SELECT tree, digest FROM nodes WHERE n = 1),
{_tree_sql('tops', "SELECT -1, 0, tree, (SELECT count(*) FROM subroots), digest FROM subroots")},
{_fold_sql('low', "SELECT rid, g, 0, i, claimed, '' FROM l", 'nodes')},
lang_done AS (
  SELECT low.* FROM low JOIN nodes o ON o.tree = low.tree AND o.level = low.level AND o.i = low.i AND o.n = 1),
{_fold_sql('high', "SELECT rid, -1, 0, tree, digest, proof FROM lang_done", 'tops')},
done AS (
  SELECT high.* FROM high JOIN tops o ON o.level = high.level AND o.i = high.i AND o.n = 1)
SELECT doc_id, leaf, subroots.digest AS subroot, tops.digest AS root, sha256(proof) AS proof_sha256,
  done.digest AS folded_root, done.digest = tops.digest AS verified
FROM l JOIN done USING (rid) JOIN subroots ON subroots.tree = l.g JOIN tops ON tops.n = 1
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, checked after some were changed."""
    docs = documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text")
    changed = (F.col("n_chars").cast("decimal(20,0)") + 1).cast("decimal(20,0)")

    def leaf(n_chars):
        return merkle.leaf_of(F.col("doc_id"), F.col("source"), F.col("lang"), n_chars, F.col("text"))

    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    rows = docs.select("doc_id", "lang", leaf(F.col("n_chars")).alias("leaf"), F.when(tampered, leaf(changed)).alias("claimed"))
    proofs = merkle.prove(merkle.build(rows, "lang", "doc_id", "leaf"), F.col("row.claimed"))
    return proofs.select(
        "row.doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_perfect_hash_trie", f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
u AS (SELECT conv_id, pos, strlen(text) AS bytes, sha256(strlen(role) || ':' || role || text) AS k FROM t),
c AS (
  SELECT conv_id, count(*) AS own, conv_id - conv_id % 5 AS base, {CRC32 % {'s': 'conv_id::VARCHAR'}} % 9 AS h
  FROM u GROUP BY conv_id),
f AS (
  SELECT c.*, least(c.h, coalesce(b.own, 0)) AS taken, greatest(c.own - c.h, 0) + least(c.h, coalesce(b.own, 0)) AS len
  FROM c LEFT JOIN c AS b ON b.conv_id = c.base),
r AS (
  SELECT conv_id, pos - h + taken + 1 AS depth, bytes, k FROM u JOIN f USING (conv_id) WHERE pos >= h
  UNION ALL
  SELECT f.conv_id, pos + 1, bytes, k FROM f JOIN u ON u.conv_id = f.base WHERE pos < h),
p AS (
  SELECT conv_id, depth, bytes, sha256(string_agg(k, '') OVER (
    PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS key FROM r
  UNION ALL SELECT conv_id, 0, 0, '' FROM c),
q AS (
  SELECT p.*, lag(key) OVER (PARTITION BY p.conv_id ORDER BY depth) AS above, depth = len AS ends
  FROM p JOIN f USING (conv_id)),
n AS (
  SELECT depth, key, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, max(bytes) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM q GROUP BY depth, key),
kids AS (SELECT depth - 1 AS depth, above AS key, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1, 2),
m AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (depth, key)),
sums AS (
  SELECT q.depth, q.key, count_if(m.n_children = 0) AS n_leaves, sum((m.n_convs - 1) * m.bytes)::BIGINT AS saved_tokens
  FROM m JOIN q ON q.conv_id = m.conv_id AND q.depth <= m.depth GROUP BY 1, 2)
SELECT m.conv_id, m.depth, up.conv_id AS parent_conv_id, m.n_convs, m.n_children, n_leaves::BIGINT AS n_leaves,
  saved_tokens, m.ends_sha256
FROM m JOIN sums USING (depth, key) LEFT JOIN n AS up ON up.depth = m.depth - 1 AND up.key = m.above
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of rebuilt conversations."""
    turns = prefix_trie.turns_of(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))
    return prefix_trie.trie(*prefix_trie.with_shared_heads(turns))
