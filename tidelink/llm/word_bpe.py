"""BPE encoding and decoding with word ends, through a compiled lexicon.

The most frequent words of the whole corpus are counted, merged once and
compiled into a minimal acyclic transducer, which every executor fetches and
memory-maps; other words are merged exactly where they occur, so the size of
the lexicon changes the speed and never the ids.

Defined results: a null text counts as the empty text, with no ids and an
empty decoded text; special-token strings inside a text get their ids, as
the vocabulary file says; very long texts and words are encoded whole; the
result has the id column and the operator's own columns only, so other
columns cannot clash.
"""

from __future__ import annotations

import json
import re
import uuid
from array import array
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelink.llm.common import public_path
from tidelink.llm.lexicon import Lexicon, compile_lexicon
from tidelink.session import materialize, scratch_dir

LEXICON_WORDS = 131_072
CACHE_BYTES = 56 << 20  # of each of an encoder's two generations of words
CACHE_LENGTH = 64
ENTRY_BYTES = 200  # of a word, its ids and their place, beside their lengths
COUNTED_WORDS = 300_000  # distinct words a counting task holds before it passes them on
BATCH_BYTES = 8 << 20  # of the ids of one batch of results

# white space of the vocabulary's own splitter; str.split() also cuts at the
# four separators \x1c-\x1f, which are ordinary characters there
_SPACES = re.compile("[\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200b), 0x2028, 0x2029, 0x202f, 0x205f, 0x3000))) + "]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
# Up to U+024F nothing composes, and lower() does not depend on what is near
# and agrees with the vocabulary's own but for U+0130.
_BEYOND = re.compile(f"[^{chr(0)}-{chr(0x12f)}{chr(0x131)}-{chr(0x24f)}]")
_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def split_words(text: str) -> list[str]:
    if _SEPARATORS.search(text):
        return [w for w in _SPACES.split(text) if w]
    return text.split()


def lowered(text: str) -> str:
    """The text in lower case where that cannot change its ids."""
    return text if _BEYOND.search(text) else text.lower()


class WordBpe:
    """The merge rules of one vocabulary file."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalize = library.normalizer.normalize_str
        self.pre_tokenize = library.pre_tokenizer.pre_tokenize_str
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        end = model["end_of_word_suffix"]
        self.last = {t[:-len(end)]: i for t, i in self.vocab.items() if t.endswith(end) and len(t) == len(end) + 1}
        # a pair of ids to its rank and the merged id, in one integer
        self.pair: dict[int, int] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            self.pair.setdefault(self.vocab[a] << 16 | self.vocab[b], rank << 16 | self.vocab[a + b])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(re.escape(s) for s in self.special) + ")")
        tokens = self.vocab | self.special
        if max(tokens.values()) >= 1 << 16:
            raise ValueError("token ids over 16 bits")
        self.spelling = np.empty(max(tokens.values()) + 1, object)
        for token, i in tokens.items():
            self.spelling[i] = token
        # Words of printable characters below U+0250 are cut here; the rest by
        # the library's own normalizer and splitter.
        self.simple = re.compile(f"[!-~{chr(0xa1)}-{chr(0x12f)}{chr(0x131)}-{chr(0x24f)}]+").fullmatch
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]).findall
        low = {ord(x) for c in range(0xa1, 0x250) for x in chr(c).lower()}
        self.spelled = {c: self.pre_tokenize(chr(c))[0][0] for c in low}

    def parts(self, word: str) -> list[str]:
        """Normalise and cut one white-space word; neither crosses white space."""
        if word.isascii():
            stem = word.rstrip(_PUNCTUATION)
            if stem.isalpha():
                return [stem.lower()] if stem == word else [stem.lower(), word[len(stem):]]
        if not self.simple(word):
            return [p for p, _ in self.pre_tokenize(self.normalize(word))]
        low = word.lower()
        cut = [low] if low.isalpha() else self.cut(low)
        return cut if low.isascii() else [p.translate(self.spelled) for p in cut]

    def merge(self, part: str) -> list[int]:
        """Exact ids of one part: best rank first, then leftmost."""
        ids = [self.vocab[c] for c in part[:-1]]
        ids.append(self.last[part[-1]])
        if len(ids) > CACHE_LENGTH:
            return self.merge_long(ids)
        get, none = self.pair.get, 1 << 48
        ranks = [get(a << 16 | b, none) for a, b in zip(ids, ids[1:])]
        left = len(ranks)
        while left:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = whole = best & 0xffff
            del ids[i + 1], ranks[i]
            left -= 1
            if i < left:
                ranks[i] = get(whole << 16 | ids[i + 1], none)
            if i:
                ranks[i - 1] = get(ids[i - 1] << 16 | whole, none)
        return ids

    def merge_long(self, ids: list[int]) -> list[int]:
        """The same by a heap over a linked list, for parts of any length."""
        n, pair, ids = len(ids), self.pair, list(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (r := pair.get(ids[i] << 16 | ids[i + 1])) is not None]
        heapify(heap)
        while heap:
            r, i, left, right = heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has been merged since
            whole = ids[i] = r & 0xffff
            ids[j] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (r := pair.get(whole << 16 | ids[k])) is not None:
                    heappush(heap, (r, i, whole, ids[k]))
            b = before[i]
            if b >= 0 and (r := pair.get(ids[b] << 16 | whole)) is not None:
                heappush(heap, (r, b, ids[b], whole))
        return [i for i in ids if i >= 0]

    def sections(self, text: str) -> list[str]:
        """The text cut at special tokens, which stand at the odd places."""
        return self.special_cut.split(text) if "<|" in text else [text]


@lru_cache(maxsize=1)
def rules(path: str) -> WordBpe:
    return WordBpe(path)


class Encoder(dict):
    """Words to ids (as int32 bytes); a missing word's parts are looked up in
    the lexicon, or else merged. Keeps two generations of words, of bounded
    size in bytes.

    The splitter always cuts behind a run of letters, so a word of letters and
    the punctuation at its end are looked up each, and only those are kept.
    """

    def __init__(self, bpe: WordBpe, lexicon: Lexicon):
        self.bpe, self.lexicon, self.older, self.room = bpe, lexicon, {}, CACHE_BYTES

    def __missing__(self, word: str) -> bytes:
        stem = word.rstrip(_PUNCTUATION)
        if stem != word and stem.isalpha() and (stem.isascii() or not _BEYOND.search(stem)):
            return self[stem] + self[word[len(stem):]]
        found = self.older.get(word)
        if found is None:
            ids: list[int] = []
            for part in self.bpe.parts(word):
                known = self.lexicon.get(part.encode("utf-8"))
                part_ids = self.bpe.merge(part) if known is None else known
                ids = ids + part_ids if ids else part_ids
            found = array("i", ids).tobytes()
        if len(word) <= CACHE_LENGTH:
            self.room -= ENTRY_BYTES + 2 * len(word) + len(found)
            if self.room < 0:
                self.older, self.room = dict(self), CACHE_BYTES
                self.clear()
            self[word] = found
        return found

    def encode(self, text: str | None) -> bytes:
        """Ids of a whole text as int32 bytes."""
        found: list[bytes] = []
        for k, section in enumerate(self.bpe.sections(text or "")):
            if k % 2:
                found.append(array("i", [self.bpe.special[section]]).tobytes())
            else:
                found += map(self.__getitem__, split_words(lowered(section)))
        return b"".join(found)

    def decode(self, ids: bytes) -> str:
        """The tokens joined by blanks: the vocabulary file has no decoder."""
        return " ".join(self.bpe.spelling[np.frombuffer(ids, np.int32)].tolist())


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, lexicon_file: str) -> Encoder:
    """A Python worker's one encoder; the file is this executor's fetched copy.
    That of an earlier lexicon goes before the next one is made."""
    if (path, lexicon_file) not in _ENCODERS:
        for old in _ENCODERS.values():
            old.clear()
            old.older.clear()
        _ENCODERS.clear()
        _ENCODERS[path, lexicon_file] = Encoder(rules(path), Lexicon.map_file(SparkFiles.get(lexicon_file)))
    return _ENCODERS[path, lexicon_file]


def frequent_words(docs: DataFrame, path: str, text_col: str = "text", limit: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent parts over all texts, at most ``limit`` of them.

    Tasks pass on partial counts of distinct words, never single words. The
    least count is read off a histogram of counts (a few hundred rows), so
    what reaches the driver does not grow with the number of tasks.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, counts = rules(path), Counter()

        def flush():
            parts = Counter()
            for word, n in counts.items():
                for p in bpe.parts(word):
                    if len(p) <= CACHE_LENGTH:
                        parts[p] += n
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(parts), pa.string()), pa.array(list(parts.values()), pa.int64())], ["part", "n"])

        for batch in batches:
            for text in batch.column(0):
                for section in bpe.sections(text.as_py() or "")[::2]:
                    counts.update(split_words(lowered(section)))
                if len(counts) >= COUNTED_WORDS:
                    yield flush()
        yield flush()

    counted = docs.select(text_col).mapInArrow(partial, "part string, n long").groupBy("part").agg(F.sum("n").alias("n"))
    counted = materialize(counted.withColumn("step", F.floor(8 * F.log2("n")).cast("int")))
    least, total = None, 0
    for row in counted.groupBy("step").count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > limit:
            break
        least = row["step"]
    return counted.where(F.lit(False) if least is None else F.col("step") >= least).select("part", "n")


def publish_lexicon(docs: DataFrame, path: str, text_col: str = "text", limit: int = LEXICON_WORDS) -> str:
    """Compile the frequent words, put the file into the shared folder and
    have Spark hand it to every executor; returns its file name."""
    spark, bpe = docs.sparkSession, rules(path)
    rows = frequent_words(docs, path, text_col, limit).collect()  # at most ``limit`` short words
    data = compile_lexicon((r.part.encode("utf-8"), bpe.merge(r.part)) for r in rows)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    where = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark, "lexicon") + "/" + name)
    out = where.getFileSystem(spark._jsc.hadoopConfiguration()).create(where)
    try:
        out.write(data)
    finally:
        out.close()
    spark.sparkContext.addFile(where.toString())
    return name


def encode_decode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                  lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """Encode whole texts and decode them again.

    Returns the id column, ``n_tokens``, ``ids`` (array of int) and ``decoded``.
    """
    path = path or public_path("word_bpe_49k.json")
    name = publish_lexicon(docs, path, text_col, lexicon_words)
    rows = docs.select(F.col(id_col), F.col(text_col))
    id_type = rows.schema[0].dataType.simpleString()

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(path, name)
        for batch in batches:
            found: list[bytes] = []
            size, first = 0, 0
            for k, text in enumerate(batch.column(1)):
                found.append(coder.encode(text.as_py()))
                size += len(found[-1])
                if size >= BATCH_BYTES or k + 1 == batch.num_rows:
                    yield filled(batch.column(0).slice(first, len(found)), found, coder)
                    found, size, first = [], 0, k + 1

    def filled(keys: pa.Array, found: list[bytes], coder: Encoder) -> pa.RecordBatch:
        sizes = pa.array([0, *(len(b) // 4 for b in found)], pa.int64())
        flat = b"".join(found)
        ids = pa.ListArray.from_arrays(pa.compute.cumulative_sum(sizes).cast(pa.int32()), pa.Array.from_buffers(
            pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)]))
        decoded = pa.array([coder.decode(b) for b in found], pa.string())
        return pa.RecordBatch.from_arrays([keys, sizes.slice(1), ids, decoded], [id_col, "n_tokens", "ids", "decoded"])

    return rows.mapInArrow(encoded, f"`{id_col}` {id_type}, n_tokens long, ids array<int>, decoded string")


def digests(coded: DataFrame) -> DataFrame:
    """``ids`` and ``decoded`` replaced by ``ids_sha256`` (of the decimal ids
    joined by a blank) and ``decoded_sha256``."""
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return (coded.withColumn("ids_sha256", F.sha2(ids, 256)).withColumn("decoded_sha256", F.sha2("decoded", 256))
            .drop("ids", "decoded"))
