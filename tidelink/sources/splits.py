"""Reading delimited files by byte ranges, header and rows in one open.

A listing of files is cut into byte ranges, one row each, which Spark deals to
tasks; no path passes through the driver and one long file is many tasks. A
task opens a range's file once: it reads the head (preamble and column
header), then the rows whose first byte lies in its range, in blocks, with
Arrow's CSV reader. Rows leave with the listing's own columns beside them, so
facts known of a file need no join with its rows.

Quoted fields may hold separators but no line ends. A row with fewer or more
fields than the header keeps its place: missing ones are null.
"""

from __future__ import annotations

import io
import re
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidelink.session import materialize

SPLIT_BYTES = 64 << 20
BLOCK_BYTES = 4 << 20
OPEN_BYTES = 64 << 10  # what opening a file costs, in bytes read
BATCH_ROWS = 1 << 16   # rows that leave a task together, of many small files
MAX_TASKS = 20_000
SPLIT_ROW_BITS = 36  # a row's number: its range above, its place in the range below


def task_count(files: DataFrame, bytes_read, split_bytes: int = SPLIT_BYTES) -> int:
    """Tasks that read ``bytes_read`` of each file in shares of ``split_bytes``, an open file counted in."""
    cost = files.agg(F.sum(bytes_read)).first()[0] or 1
    return int(min(max(-(-cost // split_bytes), files.sparkSession.sparkContext.defaultParallelism), MAX_TASKS))


def file_splits(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, length, ...) -> one row per byte range: adds ``_split`` and
    ``_lo``, ``_hi``; a task gets about ``split_bytes``, small files together.

    ``files`` is written once, as its sizes and its rows are both read."""
    files = materialize(files)
    n = F.greatest(F.ceil(F.col("length") / split_bytes), F.lit(1)).cast("long")
    tasks = task_count(files, F.col("length") + n * OPEN_BYTES, split_bytes)
    cut = files.withColumn("_split", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    return (cut.withColumn("_lo", F.col("_split") * split_bytes).withColumn("_hi", F.col("_lo") + split_bytes)
            .repartition(tasks))


def filesystem(path: str):
    """The file system of a path as Spark spells it (blanks and % as they are),
    and the path within it."""
    from pyarrow import fs as pafs
    has_scheme = re.match(r"[A-Za-z][A-Za-z0-9+.-]*:/", path)
    return pafs.FileSystem.from_uri(quote(path, safe="/:@") if has_scheme else path)


def open_file(path: str):
    fs, p = filesystem(path)
    return fs.open_input_file(p)


def lines_of(f, lo: int, hi: int, size: int) -> Iterator[bytes]:
    """Blocks of whole lines: those whose first byte lies in [lo, hi)."""
    f.seek(lo)
    left, at = b"", lo
    while at < size:
        got = f.read(BLOCK_BYTES)
        if not got:
            break
        data, at = left + got, at + len(got)
        if at >= hi:  # the line that crosses hi is ours as well
            end = len(data) - (at - hi) - 1  # the last byte before hi
            stop = data.find(b"\n", max(end, 0))
            if stop >= 0:
                yield data[:stop + 1]
                return
            left = data
            continue
        cut = data.rfind(b"\n") + 1
        if cut:
            yield data[:cut]
        left = data[cut:]
    if left:
        yield left


def line_start(f, at: int, size: int) -> int:
    """The first byte at or after ``at`` that begins a line."""
    if at == 0:
        return 0
    f.seek(at - 1)
    before = at - 1
    while before < size:
        got = f.read(1 << 16)
        cut = got.find(b"\n")
        if cut >= 0:
            return before + cut + 1
        if not got:
            break
        before += len(got)
    return size


def head_of(f, comment: bytes | None, header_line: int | None = None) -> tuple[list[str], int]:
    """Lines up to the column header, and the byte behind it.

    The header is the first line that does not begin with ``comment``, or the
    line of that number; without one the last line is empty.
    """
    f.seek(0)
    lines, at, left = [], 0, b""
    while True:
        got = f.read(1 << 16)
        left += got
        while (cut := left.find(b"\n")) >= 0 or (not got and left):
            line = left if cut < 0 else left[:cut + 1]
            left, at = left[len(line):], at + len(line)
            text = line.decode("utf-8", "replace").rstrip("\r\n")
            lines.append(text)
            if len(lines) == header_line if header_line else not (comment and text.startswith(comment.decode())):
                return lines, at
        if not got:
            return [*lines, ""], at


def header_columns(line: str) -> list[str]:
    return [c.replace('"', "").strip() for c in line.split(",")]


def _parsed(block: bytes, columns: list[str], names: dict[str, str], delimiter: str) -> pa.Table:
    """The named columns of a block of lines, as text; null where empty.
    Rows of another width stay in their place."""
    from pyarrow import csv
    other: list[str] = []

    def keep(row) -> str:
        other.append(row.text)
        return "error"

    wanted = {src: pa.string() for src in names}
    unique = [c if c not in columns[:k] else f"{c}#{k}" for k, c in enumerate(columns)]
    options = dict(
        read_options=csv.ReadOptions(column_names=unique, block_size=max(len(block) + 1, 1 << 16), use_threads=False),
        convert_options=csv.ConvertOptions(check_utf8=False, column_types=wanted, include_columns=list(names),
                                           include_missing_columns=True, strings_can_be_null=True, null_values=[""],
                                           quoted_strings_can_be_null=True))
    try:
        return csv.read_csv(io.BytesIO(block), parse_options=csv.ParseOptions(delimiter=delimiter, invalid_row_handler=keep), **options)
    except pa.ArrowInvalid:
        # some row has another width: pad or cut every row to the header's
        import csv as plain
        rows = plain.reader(io.StringIO(block.decode("utf-8", "replace")), delimiter=delimiter)
        cells = [[*r, *[None] * len(columns)][:len(columns)] for r in rows if r]
        place = {c: columns.index(c) for c in names if c in columns}
        return pa.table({c: pa.array([(r[place[c]] or None) if c in place else None for r in cells], pa.string()) for c in names})


def _beside(batch: pa.RecordBatch, keep: list[str], found: list[tuple[int, int, pa.Table]],
            row_number: str | None, names: dict[str, str]) -> Iterator[pa.RecordBatch]:
    """Tables (place of the file in ``batch``, first number, rows) as one, each row with the facts of its file."""
    import numpy as np
    if not found:
        return
    sizes = [t.num_rows for *_, t in found]
    facts = batch.select(keep).take(pa.array(np.repeat([k for k, *_ in found], sizes)))
    cells = [facts.column(c) for c in keep]
    if row_number:
        cells.append(pa.array(np.concatenate([np.arange(at, at + n, dtype=np.int64) for (_, at, _), n in zip(found, sizes)])))
    for src in names:
        cells.append(pa.chunked_array([c for *_, t in found for c in t.column(src).chunks], pa.string()))
    yield from pa.table(cells, [*keep, *([row_number] if row_number else []), *names.values()]).combine_chunks().to_batches(
        max_chunksize=BATCH_ROWS)


def read_columns(files: DataFrame, names: dict[str, str], comment: str | None = None, delimiter: str = ",",
                 row_number: str | None = None, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Rows of the files in ``files`` (path, length, facts...) with the named
    columns as text beside the path and facts: {name in the file: name in the
    result}. Each file's own header says where its columns are.

    ``row_number`` adds a long that is unique in a file and follows its order:
    rows of the first range count from 1, those of range k from k * 2**36 + 1.
    """
    splits = file_splits(files, split_bytes)
    keep = [c for c in splits.columns if c not in ("length", "_split", "_lo", "_hi")]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in splits.select(*keep).schema],
                        *([f"`{row_number}` long"] if row_number else []), *[f"`{n}` string" for n in names.values()]])
    mark = comment.encode() if comment else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, held = [], 0
            for k, split in enumerate(batch.to_pylist()):
                with open_file(split["path"]) as f:
                    size = f.size()
                    lines, body = head_of(f, mark)
                    columns = header_columns(lines[-1])
                    lo = max(line_start(f, split["_lo"], size), body)
                    count = (split["_split"] << SPLIT_ROW_BITS) + 1
                    for block in lines_of(f, lo, split["_hi"], size) if lo < split["_hi"] else ():
                        if mark and (block.startswith(mark) or b"\n" + mark in block):
                            block = re.sub(rb"(?m)^" + re.escape(mark) + rb".*\n?", b"", block)
                        if not block.strip():
                            continue
                        table = _parsed(block, columns, names, delimiter)
                        found.append((k, count, table))
                        count, held = count + table.num_rows, held + table.num_rows
                        if held >= BATCH_ROWS:
                            yield from _beside(batch, keep, found, row_number, names)
                            found, held = [], 0
            yield from _beside(batch, keep, found, row_number, names)

    return splits.select(*keep, "_split", "_lo", "_hi").mapInArrow(read, schema)


def greatest_first_field(files: DataFrame, header_line_col: str, delimiter: str = ";", out: str = "greatest",
                         split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, length, number of the header line) -> (path, out): the greatest
    number in the first field of the rows behind that line, as float; the
    first decimal comma is a point. Null if no row has a number."""
    splits = file_splits(files.select("path", "length", header_line_col), split_bytes)
    number = re.compile(rb"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
    mark = delimiter.encode()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        for batch in batches:
            greatest = []
            for split in batch.to_pylist():
                best = None
                with open_file(split["path"]) as f:
                    size = f.size()
                    _, body = head_of(f, None, split[header_line_col])
                    lo = max(line_start(f, split["_lo"], size), body)
                    for block in lines_of(f, lo, split["_hi"], size) if lo < split["_hi"] else ():
                        first = (line.split(mark, 1)[0].strip().strip(b'"').replace(b",", b".", 1) for line in block.splitlines())
                        found = [float(x) for x in first if number.match(x)]
                        if found:
                            best = max(found) if best is None else max(best, *found)
                greatest.append(None if best is None else np.float32(best))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(greatest, pa.float32())], ["path", "best"])

    parts = splits.select("path", header_line_col, "_split", "_lo", "_hi").mapInArrow(read, "path string, best float")
    return parts.groupBy("path").agg(F.max("best").alias(out))
