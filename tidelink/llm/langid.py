"""Language identification with averaged hashed subword embeddings.

A text's subwords are the 2- to 4-byte windows of its lower-cased words, with
a blank at each word's ends. Each subword hashes to a row of an embedding
table; a text is the average of its rows, and a linear softmax over it gives
the languages. The model is trained by stochastic gradient descent in numpy
on a bounded sample of labelled training rows; a temperature fitted on the
sample's validation part calibrates the scores, and texts below a threshold
chosen there are rejected.

Defined results: a text that is null or has no letter is ``und`` with score
0 and is rejected; whole texts are used, of any length; ties go to the
first language in code-point order; without any labelled training row every
text is ``und``; other columns pass through, and columns already named like
the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidelink.llm.common import without
from tidelink.session import materialize

UNKNOWN = "und"
BUCKETS = 1 << 15
DIM = 16
SIZES = (2, 3, 4)
# The languages learned are the most frequent ones, at most this many. The
# texts drawn are shared out among them, but each language gets at least
# LANG_ROWS (those of least hash), so at most MAX_LANGS * LANG_ROWS are drawn.
SAMPLE_ROWS = 3000
LANG_ROWS = 50
MAX_LANGS = 200
EPOCHS, RATE, SEED = 6, 2.0, 7
# Words in the pieces that a sampled text is trained on, beside its whole.
PIECE_WORDS = (3, 8, 25)
# Texts are accepted down to the score at which this share of them is right: a
# text is turned away where a wrong name is likelier than the right one. (An
# accuracy asked of all accepted texts would follow the wrong labels among the
# clear ones, which no score can tell, and turn away clean texts.)
EDGE_ACCURACY = 0.5
CHUNK_BYTES = 1 << 20

_NOT_LETTERS = None


def letters(text: str | None) -> bytes:
    """Lower-cased words of letters, a blank around each; empty without any."""
    global _NOT_LETTERS
    if _NOT_LETTERS is None:
        import regex
        _NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
    words = _NOT_LETTERS.sub(" ", text or "").strip()
    if not any(map(str.isalpha, words[:64])) and not any(map(str.isalpha, words)):
        return b""
    return b" " + words.lower().encode("utf-8", "surrogatepass") + b" "


def subwords(data: np.ndarray, buckets: int = BUCKETS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size, where the windows start and the buckets they hash to.

    A window may have blanks at its ends only, and not at both.
    """
    blank = data == 32
    x = data.astype(np.uint32)
    for n in SIZES:
        if len(data) < n:
            continue
        last = len(data) - n + 1
        h = np.full(last, 2166136261 + n, np.uint32)
        inner = np.zeros(last, bool)
        for k in range(n):
            h = (h ^ x[k:k + last]) * np.uint32(16777619)
            if 0 < k < n - 1:
                inner |= blank[k:k + last]
        h ^= h >> np.uint32(15)
        start = np.flatnonzero(~(inner | (blank[:last] & blank[n - 1:])))
        yield start, (h[start] & np.uint32(buckets - 1)).astype(np.int32)


def bags(texts: list[bytes], buckets: int = BUCKETS) -> list[tuple[np.ndarray, np.ndarray]]:
    """Bucket numbers and counts of each prepared text."""
    out = []
    for t in texts:
        found = [b for _, b in subwords(np.frombuffer(t, np.uint8), buckets)]
        out.append(np.unique(np.concatenate(found), return_counts=True) if found else (np.zeros(0, np.int32),) * 2)
    return out


@dataclass
class LanguageModel:
    langs: list[str]
    table: np.ndarray  # buckets x languages: the embedding rows times the softmax weights
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.0
    # of the held-back samples: the share accepted, and of those the share named right
    held_accepted: float = 1.0
    held_accuracy: float = 1.0

    def logits(self, texts: list[bytes]) -> np.ndarray:
        """One row per text; the averages are taken in chunks of whole texts."""
        out = np.tile(self.bias, (len(texts), 1))
        at = 0
        while at < len(texts):
            upto, size = at, 0
            while upto < len(texts) and (upto == at or size + len(texts[upto]) <= CHUNK_BYTES):
                size += len(texts[upto])
                upto += 1
            data = np.frombuffer(b"".join(texts[at:upto]), np.uint8)
            ends = np.cumsum([len(t) for t in texts[at:upto]])
            total, count = np.zeros((upto - at, len(self.langs))), np.zeros(upto - at)
            for piece in range(0, len(data), CHUNK_BYTES):  # one very long text
                # texts begin and end with a blank, so no window spans two
                part = data[piece:piece + CHUNK_BYTES + max(SIZES) - 1]
                for start, bucket in subwords(part, len(self.table)):
                    own = start < CHUNK_BYTES
                    row = np.searchsorted(ends, start[own] + piece, "right")
                    for k in range(len(self.langs)):
                        total[:, k] += np.bincount(row, self.table[bucket[own], k], upto - at)
                    count += np.bincount(row, minlength=upto - at)
            out[at:upto] += total / np.maximum(count, 1)[:, None]
            at = upto
        return out

    def probabilities(self, texts: list[bytes]) -> np.ndarray:
        z = self.logits(texts) / self.temperature
        p = np.exp(z - z.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def train(samples: list[tuple[str, list[tuple[np.ndarray, np.ndarray]]]], buckets: int = BUCKETS) -> LanguageModel:
    """Fit on (language, bags of its whole text and pieces), in a fixed order.

    Every fifth sample is held back to fit the temperature and the rejection
    threshold; the others train the embeddings and the softmax.
    """
    langs = sorted({lang for lang, _ in samples})
    number = {lang: k for k, lang in enumerate(langs)}
    fit = [(number[y], b) for i, (y, bs) in enumerate(samples) if i % 5 or len(samples) < 50 for b in bs if len(b[0])]
    held = [(number[y], b) for i, (y, bs) in enumerate(samples) if not i % 5 for b in bs if len(b[0])]
    rng = np.random.default_rng(SEED)
    embed = rng.normal(0, 1 / DIM, (buckets, DIM))
    weight, bias = np.zeros((DIM, len(langs))), np.zeros(len(langs))
    weight += rng.normal(0, 0.1, weight.shape)
    steps, done = EPOCHS * len(fit), 0
    # languages weigh alike, however often they are seen
    seen = np.bincount([y for y, _ in fit], minlength=len(langs)).clip(1)
    scale = np.minimum(len(fit) / (len(langs) * seen), 5.0)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(fit)):
            y, (bucket, n) = fit[i]
            part = n / n.sum()
            mean = part @ embed[bucket]
            z = mean @ weight + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            step = RATE * scale[y] * (1 - done / steps)
            back = weight @ p
            weight -= 0.1 * step * np.outer(mean, p)
            bias -= 0.02 * step * p
            # the average hands each row its share; rows are few per text, so
            # the share is lifted to the order of one row's own gradient
            embed[bucket] -= step * np.outer(np.sqrt(part / len(part)), back)
            done += 1
    model = LanguageModel(langs, (embed @ weight).astype(np.float32), bias)
    if held:
        z = np.array([b[1] / b[1].sum() @ model.table[b[0]] + bias for _, b in held])
        y = np.array([k for k, _ in held])
        loss = []
        grid = np.geomspace(0.05, 20, 61)
        for t in grid:
            q = z / t
            q -= q.max(axis=1, keepdims=True)
            loss.append(float(np.mean(np.log(np.exp(q).sum(axis=1)) - q[np.arange(len(y)), y])))
        model.temperature = float(grid[int(np.argmin(loss))])
        q = z / model.temperature
        p = np.exp(q - q.max(axis=1, keepdims=True))
        score = p.max(axis=1) / p.sum(axis=1)
        order = np.argsort(-score, kind="stable")
        right = (z.argmax(axis=1) == y)[order]
        # a right one gains 1 - EDGE_ACCURACY, a wrong one costs EDGE_ACCURACY:
        # the cut of the greatest sum, of equal ones the lowest score
        gain = np.cumsum(np.where(right, 1 - EDGE_ACCURACY, -EDGE_ACCURACY))
        last = np.append(np.diff(score[order]) != 0, True)  # equal scores stay together
        gain[~last] = -np.inf
        best = np.flatnonzero(gain >= gain.max() - 1e-9)[-1]
        model.threshold = float(score[order[best]])
        accepted = score >= model.threshold
        model.held_accepted = float(accepted.mean())
        model.held_accuracy = float((z.argmax(axis=1) == y)[accepted].mean())
    return model


def held_out(id_col: str = "doc_id") -> Column:
    """Rows kept from training: crc32 of the id as text leaves 2 by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
        sample_rows: int = SAMPLE_ROWS) -> LanguageModel | None:
    """Train on about ``sample_rows`` training texts, as many of each language.

    A language's texts are those of least hash, one for each id, so neither a
    frequent language nor a repeated row crowds out the others. Tasks turn the
    sampled texts into hashed counts, of at most ``BUCKETS`` numbers each
    whatever the text's length; only those reach the driver.
    """
    pick = F.xxhash64(F.col(id_col), F.lit(SEED))
    rows = (docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & ~held_out(id_col))
            .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), pick.alias("_pick"),
                    F.xxhash64(text_col).alias("_tie")))
    # the ids are drawn first, without texts, then those rows are read; hashes
    # are uniform, so about twice the rows wanted of a language lie below its
    # cut, and no more than those are ordered
    ids = materialize(rows.groupBy("lang", "_pick").agg(F.min("_tie").alias("_tie")))
    learned = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGS).collect()
    if not learned:
        return None
    each = max(LANG_ROWS, sample_rows // len(learned))
    cuts = [(r["lang"], min((2 * each + 100 << 64) // r["count"], (1 << 64) - 1) - (1 << 63)) for r in learned]
    cuts = docs.sparkSession.createDataFrame(cuts, "lang string, _cut long")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("_pick"))
    drawn = (ids.join(F.broadcast(cuts), "lang").where("_pick <= _cut").select("lang", "_pick", "_tie", place.alias("_place"))
             .where(F.col("_place") <= each).drop("_place"))
    chosen = (rows.join(F.broadcast(materialize(drawn)), ["lang", "_pick", "_tie"])  # bounded as stated above
              .dropDuplicates(["lang", "_pick", "_tie"]).select("lang", "text", "_pick", "_tie"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for lang, text, pick, tie in zip(*(batch.column(k).to_pylist() for k in range(4))):
                data = letters(text)
                words = data.split()
                rng = np.random.default_rng(abs(pick))
                pieces = [data]
                for n in PIECE_WORDS:
                    if len(words) > n:
                        k = int(rng.integers(len(words) - n))
                        pieces.append(b" " + b" ".join(words[k:k + n]) + b" ")
                found = bags(pieces)
                for col, value in zip(out, (lang, pick, tie, [b.tolist() for b, _ in found], [n.tolist() for _, n in found])):
                    col.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.string()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.int64()),
                 pa.array(out[3], pa.list_(pa.list_(pa.int32()))), pa.array(out[4], pa.list_(pa.list_(pa.int32())))],
                ["lang", "pick", "tie", "buckets", "counts"])

    table = chosen.mapInArrow(
        counted, "lang string, pick long, tie long, buckets array<array<int>>, counts array<array<int>>").toArrow()
    if not table.num_rows:
        return None
    order = np.lexsort((table.column(2).to_numpy(), table.column(1).to_numpy()))
    samples = [(table.column(0)[i].as_py(), [(x.values.to_numpy(), y.values.to_numpy()) for x, y in
                                             zip(table.column(3)[i], table.column(4)[i])]) for i in order.tolist()]
    return train(samples)


def prediction(text: Column, model: LanguageModel | None, spark: SparkSession) -> Column:
    """Struct (lang_pred, score, rejected) of a text column."""
    if model is None:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected"))
    shared = spark.sparkContext.broadcast(model)  # buckets x languages floats, bounded

    @F.pandas_udf("lang_pred string, score double, rejected boolean")
    def predicted(texts: pd.Series) -> pd.DataFrame:
        m = shared.value
        prepared = [letters(t) for t in texts]
        p = m.probabilities(prepared)
        best, none = p.argmax(axis=1), np.array([not t for t in prepared], bool)
        score = np.where(none, 0.0, p.max(axis=1))
        return pd.DataFrame({"lang_pred": [UNKNOWN if n else m.langs[b] for b, n in zip(best, none)], "score": score,
                             "rejected": none | (score < m.threshold)})

    return predicted(text)


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``rejected`` to every row."""
    base = without(docs, "lang_pred", "score", "rejected")
    found = base.select("*", prediction(F.col(text_col), model, base.sparkSession).alias("_language"))
    return found.select(*[F.col(f"`{c}`") for c in base.columns], "_language.*")
