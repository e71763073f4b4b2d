"""Raw study-shaped files derived from the tables (inputs of S1-S12).

A distributed writer: lines are shuffled by file name, sorted, and each
task streams its files with ``pyarrow.fs`` (exact names, any file system). The root is a fresh folder under the shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelink.plans import bindings as B
from tidelink.session import scratch_dir
from tidelink.sources.tables import table

ZONES = ("Asia/Dhaka", "Asia/Almaty", "Asia/Calcutta")
_ROOTS: dict[tuple, str] = {}


def _write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    import os
    from itertools import groupby
    from operator import itemgetter

    from pyarrow import fs as pafs
    name, folder, fs, out, n = None, None, None, None, 0
    for b in batches:
        done = []
        # a file's lines follow each other, over as many batches as they take
        for f, g in groupby(zip(b["file"].tolist(), b["line"].tolist()), itemgetter(0)):
            if not isinstance(f, str):  # no file without a name
                continue
            if f != name:
                if out:
                    out.close()
                    done.append((name, n))
                at, base = os.path.split(f)
                if at != folder:
                    fs, p = pafs.FileSystem.from_uri(at)
                    fs.create_dir(p, recursive=True)
                    folder = at
                name, out, n = f, fs.open_output_stream(f"{p}/{base}"), 0
            lines = [line for _, line in g]
            out.write(("\n".join(lines) + "\n").encode())
            n += len(lines)
        if done:
            yield pd.DataFrame(done, columns=["file", "n_lines"])
    if out:
        out.close()
        yield pd.DataFrame([(name, n)], columns=["file", "n_lines"])


def write_text_files(lines: DataFrame, parts: int | None = None) -> int:
    """Write (file, lineno, line) rows as text files; returns the line count.

    Rows of one line number follow in the order of ``at`` and ``seq``, where
    given. Each file is streamed by one task.
    """
    n = parts or lines.sparkSession.sparkContext.defaultParallelism
    order = ["file", "lineno", *[c for c in ("at", "seq") if c in lines.columns]]
    res = (lines.repartition(n, "file").sortWithinPartitions(*order)
                .select("file", "line").mapInPandas(_write, "file string, n_lines long"))
    return res.agg(F.sum("n_lines")).first()[0] or 0


def _ln(no, text):
    """A (lineno, line) struct for preamble lines."""
    return F.struct(F.lit(no).cast("long").alias("lineno"), (text if not isinstance(text, str) else F.lit(text)).alias("line"))


def _pid():
    return F.lpad(F.col("user_id").cast("string"), 5, "0")


def ecg_lines(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """One ECG CSV per user-week of click/view/error events (preamble,
    header, rows). Even users: local wall clock; odd: epoch, seconds for
    even event ids and milliseconds for odd ones."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type").isin(*B.SAMPLE_TYPES))
    week = F.to_date(F.date_trunc("week", "ts")).cast("string")
    tz = F.element_at(F.array(*[F.lit(z) for z in ZONES]), (F.col("user_id") % 3 + 1).cast("int"))
    local = F.col("user_id") % 2 == 0
    f = F.concat_ws("/", F.lit(root), F.lit("ecg"), B.category_of().cast("string"), _pid(),
                    F.concat(week, F.lit("_"), (F.col("user_id") % 13).cast("string"), F.lit("-ecg.csv")))
    us = F.unix_micros("ts")
    secs = F.concat(F.floor(us / 1000000).cast("string"), F.lit("."), F.lpad((us % 1000000).cast("string"), 6, "0"))
    tval = (F.when(local, F.date_format(F.from_utc_timestamp("ts", tz), "yyyy-MM-dd HH:mm:ss.SSSSSS"))
             .when(F.col("event_id") % 2 == 0, secs)
             .otherwise(F.floor(us / 1000).cast("string")))
    rows = ev.select(f.alias("file"), tz.alias("tz"), local.alias("local"), F.col("user_id"),
                     F.concat_ws(",", tval, F.col("value").cast("string"),
                                 (F.col("value") / 1000).cast("string")).alias("line"),
                     F.col("ts"), F.col("event_id"))
    data = rows.select("file", F.lit(10).cast("long").alias("lineno"), "line", F.col("ts").alias("at"), F.col("event_id").alias("seq"))
    heads = rows.select("file", "tz", "local", "user_id").distinct()
    pre = heads.select("file", F.explode(F.array(
        _ln(1, "# Sampling: 1.0s (1000 Hz)"),
        _ln(2, F.concat(F.lit("# Export timezone: "), F.col("tz"))),
        _ln(3, F.concat(F.lit("# Device: BG"), F.lpad(F.col("user_id").cast("string"), 8, "0"))),
        _ln(4, F.when(F.col("local"), F.lit("local_time,ecg,ecg_mV")).otherwise(F.lit("timestamp,ecg,ecg_mV")))
    )).alias("l")).select("file", "l.lineno", "l.line")
    return pre.unionByName(data, allowMissingColumns=True)


def marker_lines(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """One marker CSV per participant (header + rows)."""
    ev = B.marker_events(spark, sf_dir)
    f = F.concat(F.lit(root + "/mirage/"), F.col("mirage_pid"), F.lit("utcmarker.csv"))
    line = F.concat_ws(",", "id", "mirage_pid", "lang", "event", F.col("timecode_utc").cast("string"))
    data = ev.select(f.alias("file"), (F.col("id").cast("long") + 2).alias("lineno"), line.alias("line"))
    head = data.select("file").distinct().select("file", F.lit(1).cast("long").alias("lineno"),
                                                 F.lit("id,participantID,lang,marker,utc_app").alias("line"))
    return head.unionByName(data)


def eda_lines(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """One EDA file per user-week of click events: 27/28 preamble lines,
    SECOND header on line 28 (even users) or 29, rows of elapsed seconds
    with a decimal comma."""
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == B.EDA_TYPE)
    week = F.to_date(F.date_trunc("week", "ts")).cast("string")
    f = F.concat_ws("/", F.lit(root), F.lit("eda"), F.concat(B.category_of().cast("string"), F.lit(".eda")),
                    week, F.concat(_pid(), F.lit(".csv")))
    e = ev.select(f.alias("file"), "user_id", "ts", "event_id")
    heads = e.groupBy("file", "user_id").agg(F.min("ts").alias("_t0"))
    e = e.join(heads.select("file", "_t0"), "file")
    cs = F.floor((F.unix_micros("ts") - F.unix_micros("_t0")) / 10000)   # whole centiseconds
    el_text = F.concat(F.floor(cs / 100).cast("string"), F.lit(","), F.lpad((cs % 100).cast("string"), 2, "0"))
    hdr = F.lit(28) + F.col("user_id") % 2
    data = e.select("file", (hdr + 1).cast("long").alias("lineno"), F.concat(el_text, F.lit(";1;0")).alias("line"),
                    F.col("ts").alias("at"), F.col("event_id").alias("seq"))
    fixed = [_ln(1, F.concat(F.lit("Device: ES"), F.lpad((F.col("user_id") % 7).cast("string"), 4, "0"),
                             F.lit(";v2"))),
             _ln(4, F.concat(F.lit("Start;"), F.date_format("_t0", "dd.MM.yy HH:mm:ss")))]
    filler = [_ln(i, "999999;Hz" if i == 9 else f"Param {i};0") for i in list(range(2, 4)) + list(range(5, 28))]
    pre = heads.select("file", "user_id", "_t0", F.explode(F.array(*fixed, *filler)).alias("l")).select(
        "file", "user_id", "l.lineno", "l.line")
    extra = heads.where(F.col("user_id") % 2 == 1).select("file", F.lit(28).cast("long").alias("lineno"),
                                                          F.lit("Param 28;0").alias("line"))
    head = heads.select("file", hdr.cast("long").alias("lineno"), F.lit("SECOND;SC;X").alias("line"))
    return pre.drop("user_id").unionByName(extra).unionByName(head).unionByName(data, allowMissingColumns=True)


def raw_root(spark: SparkSession, sf_dir: str) -> str:
    """Write (once per session and scale) the raw files; return their root."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _ROOTS:
        root = scratch_dir(spark, "raw")
        lines = (ecg_lines(spark, sf_dir, root).unionByName(marker_lines(spark, sf_dir, root), allowMissingColumns=True)
                 .unionByName(eda_lines(spark, sf_dir, root), allowMissingColumns=True))
        write_text_files(lines)
        _ROOTS[key] = root
    return _ROOTS[key]



def faulty_root(spark: SparkSession, sf_dir: str) -> str:
    """Heads of files, one ECG and one EDA file a user, of which every fifth
    user's lack any data line (device), and the next ones' a known time column
    (data header); return their root."""
    key = (spark.sparkContext.applicationId, sf_dir, "faulty")
    if key not in _ROOTS:
        root = scratch_dir(spark, "faulty")
        users = table(spark, sf_dir, "events").select("user_id").distinct()
        kind = F.col("user_id") % 5
        ecg = users.select(
            F.concat(F.lit(root + "/ecg/"), F.col("user_id").cast("string"), F.lit("-ecg.csv")).alias("file"),
            F.explode(F.array(_ln(1, "# Sampling: 1.0s (1000 Hz)"),
                              _ln(2, F.when(kind == 0, "# end").when(kind == 1, "when,ecg").otherwise("timestamp,ecg")))).alias("l"))
        eda = users.select(
            F.concat(F.lit(root + "/eda/1.eda/"), _pid(), F.lit(".csv")).alias("file"),
            F.explode(F.array(_ln(1, F.when(kind == 0, "ES0001;v2").otherwise("Device: ES0001;v2")),
                              *[_ln(i, f"Param {i};0") for i in range(2, 28)],
                              _ln(28, F.when(kind == 1, "0,01;1;0").otherwise("SECOND;SC;X")))).alias("l"))
        write_text_files(ecg.unionByName(eda).select("file", "l.lineno", "l.line"))
        _ROOTS[key] = root
    return _ROOTS[key]
