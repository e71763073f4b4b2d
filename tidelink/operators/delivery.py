"""Reconciliation of links into the six linkage sheets (L5) and their sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelink.operators.quality import pct_linked
from tidelink.operators.scan import ranked
from tidelink.session import materialize
from tidelink.sources.workbooks import MAX_ROWS, cell, sheet_pieces, write_pieces

SHEETS = ("uniquely_linked", "multiply_linked", "unlinked_recordings", "unlinked_markers",
          "all_markers", "meta")

# Fixed values that must equal the reference's: titles of a workbook's sheets.
SHEET_TITLES = {
    "uniquely_linked": "BG Uniquely Linked to Mirage",
    "multiply_linked": "BG Multiply Linked to Mirage",
    "unlinked_recordings": "BG Not Linked to Mirage",
    "unlinked_markers": "Unlinked Mirage (all rescats)",
    "all_markers": "Mirage",
    "meta": "meta",
}

# What the rows of a sheet are ordered by, before their other cells.
SHEET_ORDER = {
    "uniquely_linked": ("time_start", "id_mirage"),
    "multiply_linked": ("id_mirage", "offset_start"),
    "unlinked_recordings": ("time_start", "time_end"),
    "unlinked_markers": ("start_event", "id_event"),
    "all_markers": ("start_event", "id_event"),
    "meta": ("year", "month"),
}

# Fixed values that must equal the reference's: category folder labels
# (categories without a label use their number).
CATEGORY_FOLDERS = {
    1: "1. Recruitment",
    4: "4. 3rd Trimester followup",
    6: "6. Birth follow up",
    7: "7. 6-month follow up",
    10: "10. 16-month follow up",
}


def marker_sheet(sessions: DataFrame, windows: DataFrame) -> DataFrame:
    """Marker sessions with their window times and (year, month) of the day."""
    w = windows.select(F.col("id").alias("id_event"), F.col("start").alias("start_event"),
                       F.col("end").alias("end_event"))
    return (sessions.join(w, "id_event", "left")
                    .select("id_session", "mirage_pid", "date", "id_event", "start_event", "end_event",
                            "valid_event", F.year("date").alias("year"), F.month("date").alias("month")))


def enrich_links(links: DataFrame, recordings: DataFrame, markers: DataFrame, root: str) -> DataFrame:
    """J12+W5+P11: links with device, relative path, marker session and the
    number of links of the same marker event (before category restriction)."""
    rec = recordings.select(F.col("id").alias("id_recording"), "path", F.col("device_id").alias("id_device"),
                            "respondent_cat", "year", "month")
    mk = markers.select(F.col("id_event").alias("id_mirage"), "id_session", "mirage_pid")
    # links per marker event: a partial aggregation joined back (a marker
    # event with very many links is not gathered into one task)
    mult = links.groupBy("id_mirage").agg(F.count(F.lit(1)).alias("n_mirage_match"))
    return (links.join(rec, "id_recording", "left")
                 .join(mk, "id_mirage", "left")
                 .join(mult, "id_mirage", "left")
                 .withColumn("box_path", F.replace(F.col("path"), F.lit(root), F.lit("")))
                 .select("id_session", "id_recording", "id_mirage", "id_device", "mirage_pid",
                         F.col("n_mirage_match").cast("int").alias("n_mirage_match"),
                         "offset_start", "time_start", "offset_end", "time_end", "box_path",
                         "respondent_cat", "year", "month"))


def unlinked_recordings(recordings: DataFrame, enriched: DataFrame, limits: DataFrame,
                        root: str) -> DataFrame:
    """Recordings (with a lake month) that no link mentions, with limits."""
    lim = limits.select("id_recording", F.col("t_min").alias("time_start"), F.col("t_max").alias("time_end"))
    return (recordings.where(F.col("year").isNotNull() & F.col("month").isNotNull())
                      .withColumnRenamed("id", "id_recording")
                      .join(enriched.select("id_recording"), "id_recording", "left_anti")
                      .join(lim, "id_recording", "left")
                      .select("id_recording", F.col("device_id").alias("id_device"),
                              F.replace(F.col("path"), F.lit(root), F.lit("")).alias("box_path"),
                              "time_start", "time_end", "respondent_cat", "year", "month"))


def unlinked_markers(markers: DataFrame, enriched: DataFrame) -> DataFrame:
    """Marker events no link mentions (all categories)."""
    return markers.join(enriched.select(F.col("id_mirage").alias("id_event")), "id_event", "left_anti") \
                  .select(*markers.columns)


def linkage_sheets(links: DataFrame, recordings: DataFrame, limits: DataFrame, sessions: DataFrame,
                   windows: DataFrame, root: str) -> dict[str, DataFrame]:
    """The six reconciliation tables, each carrying its layout columns.

    The reference builds one workbook per (year, month, category) in a
    driver loop; here every sheet is one DataFrame with (respondent_cat,
    year, month) columns, written partitioned by them. Links are matched on
    time over all months (SURVEY D8); the month is only for layout.
    """
    markers = marker_sheet(sessions, windows)
    enriched = enrich_links(links, recordings, markers, root)
    cells = recordings.where(F.col("year").isNotNull()).select("year", "month", "respondent_cat").distinct()
    um = unlinked_markers(markers, enriched)
    return {
        "uniquely_linked": enriched.where(F.col("n_mirage_match") == 1),
        "multiply_linked": enriched.where(F.col("n_mirage_match") > 1),
        "unlinked_recordings": unlinked_recordings(recordings, enriched, limits, root),
        "unlinked_markers": um,
        "all_markers": markers,
        "meta": pct_linked(markers, um, cells),
    }


def category_folder(cat):
    """Folder label of a category (fixed map, number otherwise)."""
    expr = F.col(cat).cast("string") if isinstance(cat, str) else cat.cast("string")
    c = F.col(cat) if isinstance(cat, str) else cat
    for k, v in CATEGORY_FOLDERS.items():
        expr = F.when(c == k, F.lit(v)).otherwise(expr)
    return expr


def deliver_sheets(sheets: dict[str, DataFrame], out_dir: str, fmt: str = "parquet") -> dict[str, str]:
    """Write each sheet as a dataset partitioned by category folder and
    ``bg_<year>_<MM>`` (month zero-padded). Returns sheet -> path.

    Any Spark file format works; ``deliver_workbooks`` writes spreadsheets.
    """
    paths = {}
    for name, df in sheets.items():
        layout = df
        if "respondent_cat" in df.columns:
            layout = layout.withColumn("folder", category_folder("respondent_cat"))
        if "year" in df.columns:
            layout = layout.withColumn("book", F.format_string("bg_%d_%02d", F.col("year"), F.col("month")))
        parts = [c for c in ("folder", "book") if c in layout.columns]
        path = f"{out_dir.rstrip('/')}/{name}"
        # files of a folder are merged to the advised size, and a large one is split
        layout.hint("rebalance", *parts).write.mode("overwrite").partitionBy(*parts).format(fmt).save(path)
        paths[name] = path
    return paths


def deliver_workbooks(sheets: dict[str, DataFrame], out_dir: str, max_rows: int = MAX_ROWS) -> None:
    """One workbook of six sheets a (category, year, month) of the
    ``meta`` sheet, as ``<category folder>/bg_<year>_<MM>.xlsx``.

    Sheets without a category (markers) go into the workbook of each category
    of their month; markers of months without recordings are in no workbook.
    A null category has the folder ``NA``. Rows are ordered by
    ``SHEET_ORDER``, nulls first, then by their cells. A sheet of more than
    ``max_rows`` rows goes on in ``bg_<year>_<MM>_2.xlsx`` and so on, so a task
    streams a bounded file however large a month is.

    The marker sheets of a month are ordered and rendered once, not once a
    category: the workbooks of its categories take the same pieces.
    """
    folder = F.coalesce(category_folder("respondent_cat"), F.lit("NA"))
    book = F.format_string("bg_%d_%02d", "year", "month")
    books = materialize(sheets["meta"].select(folder.alias("folder"), book.alias("book")).distinct())
    # where a sheet's rows go: into one workbook, or into that month's of each folder
    places = books.select(F.concat_ws("/", "folder", "book").alias("at"), "folder").unionByName(
        books.select(F.col("book").alias("at"), "folder"))
    rows, headers = None, []
    for number, name in enumerate(SHEET_TITLES):
        df = sheets[name]
        headers.append([c for c in df.columns if name == "meta" or c not in ("respondent_cat", "year", "month")])
        types = {f.name: f.dataType for f in df.schema.fields}
        first, second = (F.col(c) if types[c].typeName() != "timestamp" else F.unix_micros(c) for c in SHEET_ORDER[name])
        long = df.select(F.concat_ws("/", folder, book).alias("at") if "respondent_cat" in types else book.alias("at"),
                         book.alias("book"), F.lit(number).alias("sheet"),
                         first.cast("double").alias("_o1"), second.cast("double").alias("_o2"),
                         F.array(*[cell(c, types[c]) for c in headers[-1]]).alias("cells"))
        rows = long if rows is None else rows.unionByName(long)
    wanted = rows.join(places.select("at").distinct(), "at", "left_semi")
    placed = ranked(wanted, ["at", "sheet"], ["_o1", "_o2", "cells"], "place")
    part = F.floor((F.col("place") - 1) / max_rows) + 1
    name = F.concat(F.concat_ws("_", "book", F.when(part > 1, part.cast("string"))), F.lit(".xlsx"))
    numbered = placed.withColumn("name", name).withColumn("row", (F.col("place") - 1) % max_rows + 1)
    pieces = sheet_pieces(numbered, "at", "name").join(places, "at")
    write_pieces(pieces.withColumn("file", F.concat_ws("/", "folder", "name")), out_dir, list(SHEET_TITLES.values()), headers)
