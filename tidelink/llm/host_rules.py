"""Quality rules judged by host, with DataFrame functions only.

Each document is measured once. Rule failures are summed by host (partial
sums before the shuffle, so a host with a third of all rows costs no more
than another), the failure rates are shrunk with a beta prior fitted to all
hosts, and the host verdicts are joined back to the documents.

Defined results: a null text counts as the empty text (it fails for having
under 50 words); a null host belongs to no host and is judged by its own
base rules alone; repeated rows are judged each; an empty table gives an
empty table; a column already named like the output column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelink.llm.common import GAP_CHARS, WORD, WORD_GAP, without
from tidelink.session import materialize

MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
# A host goes when its shrunk rate of one rule's failures is above this.
MAX_HOST_RATE = 0.5
# Bounds of the prior's correlation: strengths from 1 to 999 documents.
MIN_RHO, MAX_RHO = 0.001, 0.5

RULES = ("short", "repeats", "symbols", "lines", "word_length")


def with_measures(docs: DataFrame, text_col: str = "text", out: str = "quality") -> DataFrame:
    """Add the struct ``out`` of per-document counts.

    ``n_repeat_words`` is the number of words that lie in a 3-word window
    found at least twice in the text. Windows are compared by 64-bit hashes
    of their words' hashes, inside the row: no row is exploded or shuffled.
    """
    base = without(docs, out)
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(GAP_CHARS))
    no_words = F.array().cast("array<bigint>")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(WORD))
    step = base.select(
        "*",
        F.when(trimmed == "", no_words).otherwise(
            F.transform(F.split(trimmed, WORD_GAP), lambda w: F.xxhash64(w))).alias("_h"),
        F.char_length(F.regexp_replace(text, WORD_GAP, "")).cast("long").alias("_word_chars"),
        (F.char_length(text) - F.char_length(F.translate(text, SYMBOLS, ""))).cast("long").alias("_n_symbols"),
        lines.alias("_lines"))
    h = F.col("_h")
    # one window per starting word, in text order; empty below three words
    windows = F.slice(F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + 1), F.get(h, i + 2))),
                      F.lit(1), F.greatest(F.size(h) - 2, F.lit(0)))
    step = step.select("*", windows.alias("_w"))
    w = F.col("_w")
    placed = F.when(F.size(F.array_distinct(w)) < F.size(w),
                    F.sort_array(F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("p")))))
    step = step.select("*", placed.alias("_s"))
    s = F.col("_s")
    same = F.filter(s, lambda x, i: F.coalesce(F.get(s, i - 1)["h"] == x["h"], F.lit(False))
                    | F.coalesce(F.get(s, i + 1)["h"] == x["h"], F.lit(False)))
    step = step.select("*", F.sort_array(F.transform(same, lambda x: x["p"])).alias("_p"))
    p = F.col("_p")
    # a window covers three words, fewer where the next one starts inside it
    steps = F.transform(p, lambda x, i: F.least(F.coalesce(F.get(p, i + 1) - x, F.lit(3)), F.lit(3)))
    covered = F.coalesce(F.aggregate(steps, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long")
    n_lines = F.size("_lines").cast("long")
    measures = F.struct(
        F.size(h).cast("long").alias("n_words"), F.col("_word_chars").alias("word_chars"),
        F.col("_n_symbols").alias("n_symbols"), n_lines.alias("n_lines"),
        (n_lines - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        covered.alias("n_repeat_words"))
    return step.select(*[F.col(f"`{c}`") for c in base.columns], measures.alias(out))


def rule_failures(m: Column) -> dict[str, Column]:
    """The rules by name: true where a document with measures ``m`` fails."""
    return {
        "short": m["n_words"] < MIN_WORDS,
        "repeats": m["n_repeat_words"] * 100 > m["n_words"] * 50,
        "symbols": m["n_symbols"] * 10 > m["n_words"],
        "lines": m["n_dup_lines"] * 10 > m["n_lines"] * 3,
        "word_length": (m["word_chars"] < m["n_words"] * 3) | (m["word_chars"] > m["n_words"] * 10),
    }


def host_verdicts(measured: DataFrame, host_col: str = "source", m: str = "quality",
                  max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """One row per host: its rows, shrunk failure rates and ``host_ok``.

    The beta prior of a rule has the corpus failure rate as its mean and
    1 / rho - 1 as its strength, rho being the moment estimate of the
    correlation of two documents of one host.
    """
    fails = rule_failures(F.col(m))
    hosts = materialize(
        measured.where(F.col(host_col).isNotNull()).groupBy(F.col(host_col).alias("host"))
        .agg(F.count(F.lit(1)).alias("n"), *[F.sum(c.cast("long")).alias(r) for r, c in fails.items()]))
    total = hosts.agg(F.sum("n").cast("double").alias("N"), F.count(F.lit(1)).cast("double").alias("H"),
                      F.sum(F.col("n").cast("double") * F.col("n")).alias("NN"),
                      *[(F.sum(r) / F.sum("n")).alias(f"m_{r}") for r in RULES],
                      # sum of n (p - m)^2 is sum of f^2 / n, less N m^2
                      *[F.sum(F.col(r).cast("double") * F.col(r) / F.col("n")).alias(f"q_{r}") for r in RULES])
    freedom = F.col("H") - 1
    spread = F.col("N") - F.col("NN") / F.col("N") - freedom
    prior = []
    for r in RULES:
        mean = F.col(f"m_{r}")
        moment = (F.col(f"q_{r}") - F.col("N") * mean * mean) / (mean * (1 - mean))
        rho = F.when((mean > 0) & (mean < 1) & (spread > 0), (moment - freedom) / spread).otherwise(F.lit(MIN_RHO))
        strength = 1 / F.least(F.greatest(rho, F.lit(MIN_RHO)), F.lit(MAX_RHO)) - 1
        prior += [mean.alias(f"m_{r}"), strength.alias(f"k_{r}")]
    one = total.select(F.struct(*prior).alias("prior")).scalar()
    rated = hosts.select("host", "n", *RULES, one.alias("prior"))
    rate = {r: (F.col(r) + F.col(f"prior.m_{r}") * F.col(f"prior.k_{r}")) / (F.col("n") + F.col(f"prior.k_{r}"))
            for r in RULES}
    return rated.select("host", F.col("n").alias("host_docs"), *[c.alias(f"rate_{r}") for r, c in rate.items()],
                        (F.greatest(*rate.values()) <= max_rate).alias("host_ok"))


def judge(measured: DataFrame, host_col: str = "source", out: str = "quality",
          max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """Extend ``out`` with ``base_failed``, ``host_ok`` and ``kept``.

    The measured rows are written once, since two branches read them.
    """
    rows = materialize(measured)
    verdicts = host_verdicts(rows, host_col, out, max_rate).select(
        F.col("host").alias("_host"), F.col("host_ok").alias("_host_ok"))
    fails = rule_failures(F.col(out))
    failed = fails["short"] | fails["repeats"]
    ok = F.coalesce(F.col("_host_ok"), F.lit(True))
    joined = rows.join(verdicts, F.col(f"`{host_col}`") == F.col("_host"), "left")
    return joined.withColumn(out, F.struct(f"{out}.*", failed.alias("base_failed"), ok.alias("host_ok"),
                                           (~failed & ok).alias("kept"))).drop("_host", "_host_ok")
