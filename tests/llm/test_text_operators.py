"""Text operators against the libraries, and against plain Python."""

import hashlib
import re
from collections import Counter
from zlib import crc32

import duckdb
import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from tidelink.llm import host_rules, langid, queries, simhash, token_counts, toxicity, word_bpe
from tidelink.llm.common import documents, public_path, table, workers_import
from tidelink.llm.lexicon import Lexicon, compile_lexicon

ODD = [None, "", " ", "\n\t\x0b\x0c\r ", "a", "A  b", "é ﬁ", "\x00", "中文 🙂", "x" * 3000, "ab " * 4000, "\n" * 500, "\x1c\x1f \x85",
       "<s> </s>", "<|endoftext|> a<|startoftext|>", "Don't STOP now ½٣", "ΑΣ Σ İ ſ", "é ́", "▁ ▁a", "the the the",
       "1 2 3 1 2 3 1 2 3", "# * | <b> & $5 %", "12 34 !!", "a b c\na b c\n\na b c"]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd texts, a repeated row, a null id and columns named like outputs."""
    workers_import(spark)
    rows = [(i, t, "h1" if i % 3 else None) for i, t in enumerate(ODD)] + [(3, ODD[3], "h1"), (None, "a b c", "h2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = ["n_words", "n_tokens", "ids", "decoded", "fp", "lang_pred", "score", "severity", "toxic", "quality", "slot", "tile"]
    return docs.select("*", F.lit("en").alias("lang"), *[F.lit("mine").alias(c) for c in clash])


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


# --- token counts ------------------------------------------------------------

def test_token_counts_are_the_librarys(spark, odd):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=public_path("piece_bpe_32k.model"))
    got = odd.select("text", token_counts.token_count(F.col("text")).alias("n")).collect()
    assert [r.n for r in got] == [len(lib.encode(r.text or "")) for r in got]
    out = queries.QUERIES["op2_token_counts"](spark, SF_SMALL).collect()
    texts = {r.doc_id: r.text for r in documents(spark, SF_SMALL).collect()}
    assert len(out) == len(texts)
    for r in out:
        n = len(lib.encode(texts[r.doc_id]))
        assert (r.n_tokens, r.n_bytes, r.over_limit) == (n, len(texts[r.doc_id].encode()), n > 4096)


# --- word BPE ----------------------------------------------------------------

def test_lexicon_is_minimal_and_exact(tmp_path):
    entries = {w.encode(): [i, i + 1][: 1 + i % 2] for i, w in enumerate(
        ["a", "ab", "abc", "xabc", "tops", "taps", "top", "tap", "é", "stop", "stops"])}
    data = compile_lexicon(entries.items())
    path = tmp_path / "lexicon.bin"
    path.write_bytes(data)
    lexicon = Lexicon.map_file(str(path))
    assert {w: lexicon.get(w) for w in entries} == entries
    assert all(lexicon.get(w) is None for w in (b"", b"t", b"to", b"topsy", b"zz", b"\xc3"))
    assert np.frombuffer(data[:64], "<i8")[1] < sum(map(len, entries)) // 2  # suffixes are shared
    assert Lexicon(bytearray(compile_lexicon([]))).get(b"a") is None


@pytest.mark.parametrize("limit", [0, 3, 100_000])
def test_encoding_is_the_librarys_with_any_lexicon(spark, odd, limit):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    got = word_bpe.encode_decode(odd.select("text", "doc_id"), lexicon_words=limit).collect()
    want = []
    for r in odd.collect():
        ids = lib.encode(r.text or "", add_special_tokens=False).ids
        want.append((r.doc_id, len(ids), ids, lib.decode(ids, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted((tuple(r) for r in got), key=key) == sorted(want, key=key)


def test_words_with_punctuation_encode_as_the_library_does(monkeypatch):
    """Letters, punctuation, contractions, odd cases and white space, glued
    together; two words a cache generation, so that every path is taken."""
    from random import Random

    from tokenizers import Tokenizer
    monkeypatch.setattr(word_bpe, "CACHE_BYTES", 2 * word_bpe.ENTRY_BYTES)
    path = public_path("word_bpe_49k.json")
    lib, bpe = Tokenizer.from_file(path), word_bpe.rules(path)
    lib.no_truncation()
    lib.no_padding()
    known = Lexicon(bytearray(compile_lexicon((w.encode(), bpe.merge(w)) for w in ("the", "foo", "rean", ".", "'s"))))
    coder, rng = word_bpe.Encoder(bpe, known), Random(11)
    pieces = ["Rean", "\u00dcGEST", "e.", "'s", "'S", "it's", "$$$", "..'s", "_", "a_b", "\u00aa", "\u00bd", "\u03a3", "\u0391\u03a3.",
              "\u0130", "e\u0301", "\u00df", "\u1e9e", "\u01c4", "\x85", "\xa0", "\x1c", "\n", "\u200b", "<|startoftext|>", "<|",
              "|>", "23", "\u6f22", "\u5b57\u3002", "\U0001f600", "\u0345", "\ufb01", "\u212a", ".", ",", "!?", "(", "the", "foo",
              "\u2013", "\x00", "\xad", "=\u0338", "\u0149", "\u01f0"]
    for _ in range(3000):
        text = "".join(rng.choice(pieces) + " " * (rng.random() < 0.3) for _ in range(rng.randint(0, 12)))
        ids = lib.encode(text, add_special_tokens=False).ids
        found = coder.encode(text)
        assert np.frombuffer(found, np.int32).tolist() == ids, text
        assert coder.decode(found) == lib.decode(ids, skip_special_tokens=False)


def test_encoding_digests_on_the_table(spark):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    out = {r.doc_id: r for r in queries.QUERIES["op7_bpe_lexicon"](spark, SF_SMALL).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for r in documents(spark, SF_SMALL).collect():
        ids = lib.encode(r.text, add_special_tokens=False).ids
        o = out[r.doc_id]
        assert (o.n_tokens, o.ids_sha256, o.decoded_sha256) == (
            len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids, skip_special_tokens=False)))


# --- quality rules -----------------------------------------------------------

def brute_measures(t):
    w, t = words(t), t or ""
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {p for i, k in enumerate(zip(w, w[1:], w[2:])) if seen[k] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if words(x)]
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def test_measures_match_plain_python(spark, odd):
    cols = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for df in (odd, documents(spark, SF_SMALL)):
        got = host_rules.with_measures(df).select("text", *[F.col(f"quality.{c}").alias(f"_{c}") for c in cols]).collect()
        for r in got:
            assert tuple(r)[1:] == brute_measures(r.text), r.text


def test_host_verdicts_shrink_and_join_back(spark):
    good, bad = "one two three four five " * 3 + " ".join(f"w{i}" for i in range(60)), "short"
    rows = [(i, "good", good) for i in range(40)] + [(100 + i, "bad", bad) for i in range(40)]
    rows += [(200, "bad", good), (300, "tiny", bad), (301, None, good), (302, None, bad)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {r.doc_id: r.quality for r in host_rules.judge(host_rules.with_measures(docs)).collect()}
    assert len(out) == len(rows)
    assert out[0].kept and not out[100].kept
    assert not out[200].base_failed and not out[200].host_ok and not out[200].kept
    assert out[301].kept and not out[302].kept                 # no host: base rules alone


def test_host_rules_oracle_and_empty_table(spark, odd):
    docs = odd.select("doc_id", "text", "source").toPandas()
    con = duckdb.connect()
    con.register("documents", docs.astype(object).where(docs.notna(), None))
    want = con.execute(queries.ORACLES["op4_host_rules"]).fetchall()
    judged = host_rules.judge(host_rules.with_measures(odd))
    got = judged.select("doc_id", *[f"quality.{c}" for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines",
                                                           "n_repeat_words", "base_failed", "kept")]).collect()
    key = lambda r: tuple((x is None, x or 0) for x in r)
    assert sorted((tuple(r) for r in got), key=key) == sorted(((None if r[0] is None else int(r[0]), *r[1:]) for r in want), key=key)
    assert host_rules.judge(host_rules.with_measures(odd.limit(0))).count() == 0


def test_a_worker_keeps_one_encoder_of_bounded_size(spark, monkeypatch, tmp_path):
    """Runs after the first have a lexicon file of their own."""
    path = public_path("word_bpe_49k.json")
    bpe = word_bpe.rules(path)
    monkeypatch.setattr(word_bpe.SparkFiles, "get", lambda name: str(tmp_path / name))
    monkeypatch.setattr(word_bpe, "CACHE_BYTES", 100_000)
    made = []
    for run in range(3):
        (tmp_path / f"lexicon-{run}").write_bytes(compile_lexicon([(b"the", bpe.merge("the"))]))
        coder = word_bpe.encoder(path, f"lexicon-{run}")
        assert word_bpe.encoder(path, f"lexicon-{run}") is coder
        coder.encode(" ".join(f"w{chr(97 + k % 26)}{k}x" for k in range(5000)))
        assert sum(word_bpe.ENTRY_BYTES + len(w) + len(b) for kept in (coder, coder.older) for w, b in kept.items()) <= 200_000
        assert not made or not made[-1] and not made[-1].older
        made.append(coder)
        assert list(word_bpe._ENCODERS.values()) == [coder]
    word_bpe._ENCODERS.clear()


def test_batches_of_results_are_bounded_by_their_ids(spark, odd, monkeypatch):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(public_path("word_bpe_49k.json"))
    lib.no_truncation()
    monkeypatch.setattr(word_bpe, "BATCH_BYTES", 40)
    docs = odd.select("doc_id", "text").coalesce(1)
    got = word_bpe.encode_decode(docs).select("doc_id", "n_tokens").collect()
    assert Counter(map(tuple, got)) == Counter((r.doc_id, len(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in docs.collect())


# --- language ----------------------------------------------------------------

def test_logits_are_the_average_of_subword_rows():
    """Against windows taken one by one from each word."""
    rng = np.random.default_rng(8)
    model = langid.LanguageModel(["a", "b"], rng.normal(size=(64, 2)).astype(np.float32), np.array([0.5, -0.5]))

    def bucket(window):
        h = 2166136261 + len(window)
        for c in window:
            h = (h ^ c) * 16777619 % 2**32
        return (h ^ h >> 15) % 64

    for text in ("x", "Ab cd", "d\u00e9j\u00e0 vu 12 ok", "a b c", "word " * 50):
        data, rows = langid.letters(text), []
        for n in langid.SIZES:
            for k in range(len(data) - n + 1):
                w = data[k:k + n]
                if b" " not in w[1:-1] and not (w[:1] == b" " == w[-1:]):
                    rows.append(model.table[bucket(w)].astype(float))
        assert np.allclose(model.logits([data])[0], np.mean(rows, axis=0) + model.bias)


def test_language_sample_has_every_language_and_one_row_an_id(spark, monkeypatch):
    drawn = []
    monkeypatch.setattr(langid, "train", drawn.append)
    monkeypatch.setattr(langid, "LANG_ROWS", 10)
    docs = spark.createDataFrame(
        [(1, "again", "aa")] * 3000 + [(k, f"text {k}", "aa") for k in range(2, 3000)]
        + [(k, f"selten {k}", "zz") for k in range(5000, 5012)] + [(None, "no id", "aa"), (7000, None, "aa"), (7001, "x", None)],
        "doc_id long, text string, lang string").repartition(3)
    langid.fit(docs, sample_rows=200)
    counts = Counter(lang for lang, _ in drawn[0])
    trained = [k for k in range(5000, 5012) if crc32(str(k).encode()) % 4 != 2]
    assert counts == {"aa": 100, "zz": len(trained)}


def test_rejection_threshold_is_the_best_cut_of_held_back_samples():
    rng = np.random.default_rng(9)
    samples = []
    for k in range(600):
        lang, text = ("aa", "lala ") if k % 2 else ("bb", "momo ")
        if rng.random() < 0.2:  # texts that tell nothing
            text = "xuxu "
        samples.append((lang, langid.bags([(" " + text * int(rng.integers(1, 4))).encode()])))
    model = langid.train(samples)
    held = [(lang, bags[0]) for i, (lang, bags) in enumerate(samples) if not i % 5]
    z = np.array([n / n.sum() @ model.table[b] + model.bias for _, (b, n) in held]) / model.temperature
    p = np.exp(z) / np.exp(z).sum(axis=1, keepdims=True)
    score, right = p.max(axis=1), np.array([model.langs[k] == lang for k, (lang, _) in zip(p.argmax(axis=1), held)])
    e = langid.EDGE_ACCURACY

    def gain(cut):
        return (1 - e) * (right & (score >= cut - 1e-9)).sum() - e * (~right & (score >= cut - 1e-9)).sum()

    assert gain(model.threshold) >= max(gain(c) for c in score) - 1e-6
    accepted = score >= model.threshold - 1e-9
    assert abs(model.held_accuracy - right[accepted].mean()) < 1e-9 and abs(model.held_accepted - accepted.mean()) < 1e-9
    assert model.held_accuracy > 0.85


def test_language_learns_and_rejects(spark, odd):
    docs = documents(spark, SF_SMALL)
    model = langid.fit(docs)
    out = langid.identify(docs, model).select("*", langid.held_out().alias("h")).where("h and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out)
    assert all(0 <= r.score <= 1 for r in out) and not any(r.rejected for r in out if r.n_chars > 200)
    strange = langid.identify(odd, model).collect()
    for r in strange:
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
    assert len(strange) == odd.count() and "lang_pred" in odd.columns


def test_language_never_trains_on_held_out_rows(spark):
    docs = documents(spark, SF_SMALL).where(langid.held_out())
    assert langid.fit(docs) is None
    assert {r.lang_pred for r in langid.identify(docs, None).collect()} == {"und"}


def test_subwords_of_a_text_do_not_depend_on_its_neighbours(spark):
    docs = documents(spark, SF_SMALL)
    model = langid.fit(docs)
    texts = [langid.letters(r.text) for r in docs.limit(40).collect()] + [b"", langid.letters("word " * 300_000)]
    together = model.logits(texts)
    for t, row in zip(texts, together):
        assert np.allclose(model.logits([t])[0], row)


# --- toxicity ----------------------------------------------------------------

def test_ordinal_fit_orders_thresholds_and_recovers_grades():
    rng = np.random.default_rng(1)
    x = [np.flatnonzero(rng.random(6) < 0.4) for _ in range(600)]
    grade = np.array([min(3, len(set(f) & {0, 1, 2})) for f in x])
    w, t = toxicity.fit_ordinal(x, grade, 6)
    assert (np.diff(t) > 0).all() and w[:3].min() > 1 > np.abs(w[3:]).max()
    model = toxicity.SeverityModel(np.arange(6), w, t)
    expected = model.reach(np.array([w[f].sum() for f in x])).sum(axis=1)
    assert np.abs(expected - grade).mean() < 0.2


def test_toxic_texts_score_higher(spark, odd):
    sf = "/root/testdata/sf0.01"
    labels, docs = table(spark, sf, "labels"), documents(spark, sf)
    model = toxicity.fit(docs, labels)
    seen = toxicity.score(docs, model).join(labels.withColumnRenamed("toxic", "y"), "doc_id").collect()
    flagged = [r for r in seen if r.toxic]
    assert sum(r.y for r in flagged) >= 0.95 * len(flagged)
    assert len(flagged) >= 0.5 * sum(r.y for r in seen)
    out = toxicity.score(odd, model).collect()
    assert len(out) == odd.count() and not any(r.toxic for r in out)
    assert toxicity.fit(docs, labels.where("toxic = 0")) is None
    assert {r.severity for r in toxicity.score(odd, None).collect()} == {0.0}


def test_long_letter_runs_count_to_their_end(spark):
    workers_import(spark)
    run = "abcdefghijklmnopqrstuvwxyz" * 12  # 312 letters without a space
    assert set(toxicity.word_features(run + "vilest")) > {
        crc32(w.encode()) % toxicity.BUCKETS for w in ("vile", "iles", "lest ", "vilest", "=" + run + "vilest")}
    rows = [(i, run[:289 + i % 23] + ("vilest" if i % 4 == 0 else "kindly")) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, docs.select("doc_id", (F.col("doc_id") % 4 == 0).cast("int").alias("toxic")))
    new = spark.createDataFrame([(0, "zq" * 150 + "vilest"), (1, "zq" * 150 + "kindly")], "doc_id long, text string")
    assert {r.doc_id: r.toxic for r in toxicity.score(new, model).collect()} == {0: True, 1: False}


def test_a_repeated_labelled_id_trains_as_one(spark, monkeypatch):
    workers_import(spark)
    rows = [(i, f"number {i} is " + ("vilest" if i % 4 == 0 else "kindly")) for i in range(200)]
    copies = [(0, "vilest indeed" if k % 2 else "number 0") for k in range(5000)]
    sizes, fit_ordinal = [], toxicity.fit_ordinal
    monkeypatch.setattr(toxicity, "fit_ordinal", lambda x, *rest: sizes.append([len(x), *map(len, x)]) or fit_ordinal(x, *rest))
    models = []
    # the repeated id holds the features of all its rows, and none of them twice
    for several in (copies, [(0, "number 0 is vilest vilest indeed")]):
        docs = spark.createDataFrame(rows[1:] + several, "doc_id long, text string").repartition(5)
        labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)], "doc_id long, toxic int")
        models.append(toxicity.fit(docs, labels))
    assert sizes[0][0] == 200 and sizes[0] == sizes[1]
    assert (models[0].buckets == models[1].buckets).all() and np.allclose(models[0].weights, models[1].weights)


# --- SimHash -----------------------------------------------------------------

def brute_fingerprint(t):
    import xxhash
    w = words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    s = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, ids, radius=2):
    label = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if bin(a ^ b).count("1") <= radius and label[j] < label[i]:
                    label[i], changed = label[j], True
    known = {k: [i for i, lab in zip(ids, label) if lab == k and i is not None] for k in set(label)}
    return [min(known[lab], default=None) for lab in label]


def test_simhash_matches_brute_force(spark, odd):
    for docs in (odd, documents(spark, SF_SMALL)):
        rows = docs.select("doc_id", "text").collect()
        prints = [brute_fingerprint(r.text) for r in rows]
        want = Counter(zip([r.doc_id for r in rows], [f"{p:016x}" for p in prints],
                           brute_components(prints, [r.doc_id for r in rows])))
        assert Counter(tuple(r) for r in simhash.near_duplicates(docs).collect()) == want
    assert simhash.near_duplicates(odd.limit(0)).count() == 0


def test_tiles_lose_no_link(spark):
    """Random fingerprints and flips of up to 3 bits, in blocks of 8."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 4), replace=False))) for _ in range(400)]
    values = np.unique(np.concatenate([base, rng.choice(base, 400) ^ np.array(flips)]))
    df = spark.createDataFrame([(int(v),) for v in values.view("i8")], "fp long")
    blocks, directory = simhash.tiles(df, block=8)
    edges = simhash.forests(blocks, simhash.tile_pairs(directory, 2), 2)
    from tidelink.llm.graph import connected_components
    root = {r.vertex: r.root for r in connected_components(edges).collect()}
    got = [root.get(int(v), int(v)) for v in values.view("i8")]
    near = np.bitwise_count(values[:, None] ^ values[None]) <= 2
    label = np.arange(len(values))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    assert len(set(zip(got, label))) == len(set(got)) == len(set(label))


def test_one_of_each_group_stays(spark, odd):
    kept = simhash.first_of_each_group(odd)
    assert kept.columns == odd.columns
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(odd).where("doc_id is not null").collect()}
    assert Counter(r.doc_id for r in kept.collect()) == Counter({*found.values(), None})   # the null id is alone
