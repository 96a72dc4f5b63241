"""File selection and scans of delimited text, workbooks and archives.

Everything is read as text; typing is the cleaning step's work. Delimited files stay
splittable: lines are numbered only inside the split that starts a file, and the JVM parses them.
"""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence

import pandas as pd
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from lakeops.functions.dates import previous_period
from lakeops.functions.text import PAYLOAD_BYTES, header_key_of, payload_kind
from lakeops.session import written
from lakeops.sources.records import ends_open, records

# A workbook as sheet name -> rows of cells.
Workbook = Mapping[str, Sequence[Sequence[object]]]


# --- choosing files -----------------------------------------------------------------------


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, name, modified)`` of a folder; contents are not read."""
    listing = spark.read.format("binaryFile").load(folder)
    return listing.select(
        "path",
        F.substring_index("path", "/", -1).alias("name"),
        F.col("modificationTime").alias("modified"),
    )


def extension(name: Column) -> Column:
    return F.lower(F.substring_index(name, ".", -1))


def newest(files: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The file modified last; equal times go to the greatest name."""
    newest_first = F.struct("modified", "name")
    columns = [c for c in files.columns if c not in by]
    best = F.max_by(F.struct(*columns), newest_first).alias("_f")
    picked = files.groupBy(*by).agg(best) if by else files.agg(best)
    return picked.where(F.col("_f").isNotNull()).select(*by, "_f.*")


def newest_for_period(
    files: DataFrame, base: str | None, as_of: Column, period: Column | None = None, ext: str | None = None
) -> DataFrame:
    """Newest file whose name starts with ``base`` and contains the period (default: last month)."""
    wanted = period if period is not None else previous_period(as_of)
    chosen = files.where(F.col("name").contains(wanted))
    if base:
        chosen = chosen.where(F.col("name").startswith(base))
    if ext:
        chosen = chosen.where(extension(F.col("name")) == ext.lower())
    return newest(chosen)


def period_file_name(base: str, as_of: Column, ext: str = ".xlsx", period: Column | None = None) -> Column:
    """``base_YYYYMM.ext``."""
    return F.concat(F.lit(base + "_"), period if period is not None else previous_period(as_of), F.lit(ext))


def short_period_file_name(base: str, as_of: Column, ext: str = ".xlsx", period: Column | None = None) -> Column:
    """``base-MMYY(e).ext``."""
    wanted = period if period is not None else previous_period(as_of, "MMyy")
    return F.concat(F.lit(base + "-"), wanted, F.lit("(e)" + ext))


def exact_file(files: DataFrame, name: Column) -> DataFrame:
    return files.where(F.col("name") == name)


def newest_containing(files: DataFrame, text: str, ext: str = ".xlsx") -> DataFrame:
    """Newest file whose name contains ``text``, ignoring case, with one extension."""
    name = F.col("name")
    return newest(files.where(F.upper(name).contains(text.upper()) & F.lower(name).endswith(ext)))


def path_of(selection: DataFrame) -> str:
    """Path of the selected file; raises when there is none. Runs a job."""
    row = selection.select("path").first()
    if row is None:
        raise FileNotFoundError("no file matches the selection")
    return row["path"]


def payload_kinds(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, kind)`` of each file, so that login pages saved as workbooks can be refused. A task opens
    its files and reads their first bytes; nothing else of them is read."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch.assign(content=[_beginning(path) for path in batch["path"]])

    opened = _dealt_paths(spark, folder).mapInPandas(heads, "path string, content binary")
    return opened.select("path", payload_kind(F.col("content")).alias("kind"))


def _dealt_paths(spark: SparkSession, paths: Sequence[str] | str) -> DataFrame:
    """Paths of the files, dealt over the session's tasks."""
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return list_files(spark, paths).select("path").repartition(tasks, "path")


def _beginning(path: str, size: int = PAYLOAD_BYTES) -> bytes:
    with _open_ranged(path) as file:
        return file.read(size)


# --- delimited text -----------------------------------------------------------------------


def _text_schema(names: Iterable[str]) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


def _numbered_heads(skip: int, sep: str) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Number a file's lines within the split that starts it, NULL elsewhere. A line after the preamble
    that ends inside a quoted field fails the scan, as its record would be torn."""

    def number(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, int] = {}
        for batch in batches:
            first = batch["start"] == 0
            order = batch[first].groupby("path").cumcount() + batch[first]["path"].map(lambda p: seen.get(p, 0))
            for path, n in batch[first].groupby("path").size().items():
                seen[path] = seen.get(path, 0) + int(n)
            numbered = batch.assign(line_no=order.reindex(batch.index).astype("Int64"))
            quoted = numbered[numbered["line"].str.contains('"', regex=False) & ~(numbered["line_no"] < skip).fillna(False)]
            for line, path in zip(quoted["line"], quoted["path"]):
                if ends_open(line, False, sep):
                    raise ValueError(f"a quoted field spans lines in {path}; read it with multiline")
            yield numbered

    return number


def _lines(spark: SparkSession, paths: Sequence[str] | str, skip: int, sep: str) -> DataFrame:
    """``(line, path, first)`` of every record after the preamble, ``first`` where it is the file's header."""
    lines = spark.read.text(paths).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    numbered = lines.mapInPandas(_numbered_heads(skip, sep), "line string, path string, start long, line_no long")
    kept = numbered.where((F.trim("line") != "") & (F.col("line_no").isNull() | (F.col("line_no") >= skip)))
    return kept.select("line", "path", F.coalesce(F.col("line_no") == skip, F.lit(False)).alias("first"))


def _open_ranged(path: str):
    """A file for reading in pieces, on any file system that pyarrow knows."""
    if path.startswith(("/", "file:")):
        return pafs.LocalFileSystem().open_input_file("/" + path.removeprefix("file:").lstrip("/"))
    system, inside = pafs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def _record_at(path: str, number: int, sep: str, piece: int = 1 << 16) -> str | None:
    """The record that begins on a line near the beginning of a file; no more is read than that takes."""
    head = b""
    with _open_ranged(path) as file:
        while True:
            more = file.read(piece)
            head += more
            lines, is_open = head.splitlines(), False
            for end in range(number, len(lines) - bool(more)):  # the last line may go on
                is_open = ends_open(lines[end].decode("utf-8-sig", "replace"), is_open, sep)
                if not is_open:
                    return b"\n".join(lines[number : end + 1]).decode("utf-8-sig")
            if not more:
                return None


def headers_of(spark: SparkSession, paths: Sequence[str] | str, skip: int = 0, sep: str = ",") -> DataFrame:
    """``(path, headers)`` of each file, headers on line ``skip``. A task opens its files and reads their
    beginnings; nothing else of them is scanned."""

    def heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(path, _record_at(path, skip, sep)) for path in batch["path"]]
            rows = [(path, next(csv.reader(io.StringIO(line), delimiter=sep), [])) for path, line in found if line is not None]
            yield pd.DataFrame(rows, columns=["path", "headers"])

    return _dealt_paths(spark, paths).mapInPandas(heads, "path string, headers array<string>")


def _without_mark(line: Column) -> Column:
    return F.regexp_replace(line, r"^\uFEFF", "")


def _first_file(spark: SparkSession, paths: Sequence[str] | str) -> str:
    """One of the files, from the listing alone."""
    found = list_files(spark, paths).agg(F.min("path")).first()[0]
    if found is None:
        raise FileNotFoundError(f"no file in {paths}")
    return found


_MORE, RAGGED = "_more", "_ragged"
#: Two quotes inside a quoted field stand for one, as most programs write them.
QUOTING = {"quote": '"', "escape": '"'}


def read_delimited(
    spark: SparkSession,
    paths: Sequence[str] | str,
    skip: int = 0,
    sep: str = ",",
    headers: Sequence[str] | None = None,
    multiline: bool = False,
    ragged: str = "fail",
) -> DataFrame:
    """All-text rows of files with one header, ``skip`` preamble lines in each, plus ``archivo``.

    The header is read from one file; a file with another one fails the scan. A row with more
    fields than the header fails it too, or with ``ragged='keep'`` stays, with its whole text in
    ``_ragged`` (NULL elsewhere); missing fields are NULL. A quoted field may span lines only with
    ``multiline``, which goes through the files once before (``records``, runs jobs) and reads them
    in splits all the same; without it, such a field under a preamble fails the scan.
    """
    if ragged not in ("fail", "keep"):
        raise ValueError(f"unknown policy {ragged!r}")
    if headers is None:
        row = headers_of(spark, _first_file(spark, paths), skip, sep).first()
        if row is None:
            raise ValueError("no header line found")
        headers = row["headers"]
    fields = ", ".join(f"`{h}` string" for h in headers)
    wider = f"{fields}, `{_MORE}` string"
    options = {"sep": sep, **QUOTING}

    def judged(rows: DataFrame, whole: Column, more: Column, path: Column, first: Column) -> DataFrame:
        """``_ragged``, or an error that names the file and the row's first field."""
        if ragged == "keep":
            return rows.withColumn(RAGGED, F.when(more, whole))
        row = F.concat_ws(" ", F.lit("a row has more fields than the header in"), path, F.lit("at"), first)
        return rows.where(F.when(more, F.raise_error(row).cast("boolean")).otherwise(F.lit(True)))

    if skip == 0 and not multiline:
        schema = _text_schema([*headers, RAGGED])
        reader = spark.read.schema(schema).option("columnNameOfCorruptRecord", RAGGED).option("columnPruning", False)
        scan = reader.options(**QUOTING).csv(paths, header=True, sep=sep, enforceSchema=False)
        scan = scan.select("*", F.col("_metadata.file_name").alias("archivo"), F.col("_metadata.file_path").alias("_path"))
        more = F.from_csv(RAGGED, wider, options)[_MORE].isNotNull()
        whole = judged(scan, F.col(RAGGED), F.col(RAGGED).isNotNull() & more, F.col("_path"), F.col(f"`{headers[0]}`"))
        return whole.select(*[F.col(f"`{h}`") for h in headers], "archivo", *([RAGGED] if ragged == "keep" else []))
    lines = records(spark, paths, skip, sep) if multiline else _lines(spark, paths, skip, sep)
    record_type = _text_schema([*headers, _MORE])
    record = F.from_csv("line", wider, options)
    title = F.from_csv(_without_mark(F.col("line")), wider, options)
    expected = F.struct(*[F.lit(h).alias(h) for h in headers], F.lit(None).cast("string").alias(_MORE))
    refusal = F.raise_error(F.concat(F.lit("files must share one header; another one is in "), F.col("path")))
    # The header of each file is parsed to be compared, then dropped.
    parsed = F.when(~F.col("first"), record).when(~title.eqNullSafe(expected), refusal.cast(record_type))
    rows = lines.select(parsed.alias("r"), _file_name().alias("archivo"), "line", "path").where(F.col("r").isNotNull())
    whole = judged(rows, F.col("line"), F.col("r")[_MORE].isNotNull(), F.col("path"), F.col("r").getField(headers[0]))
    return whole.select(*[F.col("r").getField(h).alias(h) for h in headers], "archivo", *([RAGGED] if ragged == "keep" else []))


def _file_name() -> Column:
    return F.url_decode(F.substring_index("path", "/", -1))


# --- workbooks and archives -----------------------------------------------------------------


def parse_xlsx(content: bytes) -> Workbook:
    """Parse a workbook with openpyxl, where that is installed."""
    from openpyxl import load_workbook

    book = load_workbook(io.BytesIO(content), data_only=True, read_only=True)
    return {sheet.title: [list(r) for r in sheet.iter_rows(values_only=True)] for sheet in book.worksheets}


def parse_csv(content: bytes) -> Workbook:
    """A delimited file as a workbook of one sheet."""
    return {"0": list(csv.reader(io.StringIO(content.decode("utf-8-sig"))))}


def _texts(cells: Sequence[object], width: int) -> list[str | None]:
    row = [None if v is None else str(v) for v in cells[:width]]
    return row + [None] * (width - len(row))


def _sheet(book: Workbook, sheet: str | int, where: str) -> Sequence[Sequence[object]]:
    names = list(book)
    if isinstance(sheet, int) and sheet < len(names):
        return book[names[sheet]]
    if sheet in book:
        return book[sheet]
    raise ValueError(f"sheet {sheet!r} not found in {where}; it has: {', '.join(names)}")


def _by_header(rows: Sequence[Sequence[object]], columns: Sequence[str], skip: int) -> Iterator[list[str | None]]:
    header = [None if h is None else str(h) for h in rows[skip]] if len(rows) > skip else []
    place = [header.index(c) if c in header else None for c in columns]
    for cells in rows[skip + 1 :]:
        texts = _texts(cells, len(header))
        yield [None if i is None else texts[i] for i in place]


def _batches(rows: Iterator[list], columns: list[str], size: int = 10_000) -> Iterator[pd.DataFrame]:
    held: list[list] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pd.DataFrame(held, columns=columns)
            held = []
    if held:
        yield pd.DataFrame(held, columns=columns)


def read_workbooks(
    spark: SparkSession,
    paths: Sequence[str] | str,
    columns: Sequence[str],
    sheet: str | int = 0,
    skip: int = 0,
    parse: Callable[[bytes], Workbook] = parse_xlsx,
) -> DataFrame:
    """Named columns of one sheet of every workbook as text, plus ``archivo``. A workbook is
    parsed by one task; many workbooks run in parallel."""
    names = [*columns, "archivo"]

    def rows(batch: pd.DataFrame) -> Iterator[list]:
        for path, content in zip(batch["path"], batch["content"]):
            file_name = path.rsplit("/", 1)[-1]
            for row in _by_header(_sheet(parse(content), sheet, file_name), columns, skip):
                yield [*row, file_name]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _batches(rows(batch), names)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(scan, _text_schema(names))


def read_form_cells(
    spark: SparkSession, paths: Sequence[str] | str, parse: Callable[[bytes], Workbook] = parse_xlsx
) -> DataFrame:
    """Every filled cell as ``(archivo, sheet, cell, value)``, cells named A1-style."""

    def letters(i: int) -> str:
        name = ""
        while i >= 0:
            name = chr(65 + i % 26) + name
            i = i // 26 - 1
        return name

    def rows(batch: pd.DataFrame) -> Iterator[list]:
        for path, content in zip(batch["path"], batch["content"]):
            for sheet, lines in parse(content).items():
                for r, cells in enumerate(lines, 1):
                    for c, value in enumerate(cells):
                        if value is not None:
                            yield [path.rsplit("/", 1)[-1], sheet, f"{letters(c)}{r}", str(value)]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _batches(rows(batch), ["archivo", "sheet", "cell", "value"])

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(scan, "archivo string, sheet string, cell string, value string")


def read_tabs(
    spark: SparkSession,
    paths: Sequence[str] | str,
    ids: Sequence[str],
    parse: Callable[[bytes], Workbook] = parse_xlsx,
) -> DataFrame:
    """Every tab of every workbook in long form: ``archivo, tab``, the id columns, ``question, answer``.
    Id columns are found by comparable header; every other column is a question."""
    names = ["archivo", "tab", *ids, "question", "answer"]

    def rows(batch: pd.DataFrame) -> Iterator[list]:
        for path, content in zip(batch["path"], batch["content"]):
            for tab, lines in parse(content).items():
                header = ["" if h is None else str(h) for h in lines[0]] if lines else []
                keys = [header_key_of(h) for h in header]
                place = [keys.index(i) if i in keys else None for i in ids]
                for cells in lines[1:]:
                    texts = _texts(cells, len(header))
                    known = [None if i is None else texts[i] for i in place]
                    for i, title in enumerate(header):
                        if i not in place:
                            yield [path.rsplit("/", 1)[-1], tab, *known, title, texts[i]]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _batches(rows(batch), names)

    files = spark.read.format("binaryFile").load(paths).select("path", "content")
    return files.mapInPandas(scan, _text_schema(names))


def rows_of_archives(
    archives: DataFrame,
    columns: Sequence[str],
    sheet: str | int = 0,
    skip: int = 0,
    parse: Callable[[bytes], Workbook] = parse_xlsx,
    suffixes: tuple[str, ...] = (".xlsx", ".xls"),
) -> DataFrame:
    """As ``read_workbooks`` for the members of zip archives given as ``(path, content)``. An
    unreadable member fails the read, and so does an archive without any."""
    names = [*columns, "archivo"]

    def rows(batch: pd.DataFrame) -> Iterator[list]:
        for path, content in zip(batch["path"], batch["content"]):
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                members = [m for m in archive.namelist() if m.lower().endswith(suffixes)]
                if not members:
                    raise ValueError(f"no readable member in {path}")
                for member in members:
                    for row in _by_header(_sheet(parse(archive.read(member)), sheet, member), columns, skip):
                        yield [*row, member.rsplit("/", 1)[-1]]

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _batches(rows(batch), names)

    return archives.select("path", "content").mapInPandas(scan, _text_schema(names))


def read_archives(spark: SparkSession, paths: Sequence[str] | str, columns: Sequence[str], **options) -> DataFrame:
    """``rows_of_archives`` over zip files."""
    return rows_of_archives(spark.read.format("binaryFile").load(paths), columns, **options)


# --- many files into one ----------------------------------------------------------------------


def file_verdicts(heads: DataFrame, mapping: Mapping[str, str], subset: str) -> DataFrame:
    """``(path, accepted, missing)``: a file needs every mapped column and the subset column.
    ``archivo`` is added by the reader and never missing."""
    wanted = sorted((set(mapping.values()) | {subset}) - {"archivo"})
    missing = F.array_except(F.array(*[F.lit(w) for w in wanted]), F.col("headers"))
    return heads.select(
        "path", "headers", (F.size(missing) == 0).alias("accepted"), F.array_join(F.array_sort(missing), ",").alias("missing")
    )


def consolidate(
    spark: SparkSession,
    folder: str,
    mapping: Mapping[str, str],
    subset: str,
    skip: int = 0,
    sep: str = ",",
    multiline: bool = False,
) -> tuple[DataFrame | None, DataFrame]:
    """Rows of the accepted files of a folder, mapped by target -> source, without rows whose
    ``subset`` is NULL; and the verdict of every file. None when no file is accepted. Runs jobs.

    One scan reads all files, whatever their headers: a record is parsed by position, and the written
    verdict of its file says at which position each source stands. Spark broadcasts the verdicts if
    they are small, and else joins them by path. A row with more fields than its header fails.
    """
    verdicts = written(file_verdicts(headers_of(spark, folder, skip, sep), mapping, subset), "verdicts")
    width = verdicts.where("accepted").agg(F.max(F.size("headers"))).first()[0]
    if width is None:
        return None, verdicts.drop("headers")
    sources = [s for s in dict.fromkeys([*mapping.values(), subset]) if s != "archivo"]
    places = F.transform(F.array(*map(F.lit, sources)), lambda s: F.array_position("headers", s).cast("int"))
    files = verdicts.where("accepted").select(F.col("path").alias("_path"), F.size("headers").alias("_width"), places.alias("_places"))

    lines = records(spark, folder, skip, sep) if multiline else _lines(spark, folder, skip, sep)
    known = lines.where(~F.col("first")).join(files, F.col("path") == F.col("_path"))
    names = [f"c{k}" for k in range(width + 1)]
    record = F.from_csv("line", ", ".join(f"{n} string" for n in names), {"sep": sep, **QUOTING})
    cells = known.select(record.alias("r"), "path", "_width", "_places").withColumn("_cells", F.array(*[F.col("r").getField(n) for n in names]))
    more = F.exists(F.slice("_cells", F.col("_width") + 1, F.lit(width + 1)), lambda c: c.isNotNull())
    refusal = F.raise_error(F.concat(F.lit("a row has more fields than the header in "), F.col("path"))).cast("boolean")
    rows = cells.where(F.when(more, refusal).otherwise(F.lit(True)))
    value = {s: F.get("_cells", F.get("_places", F.lit(k)) - 1) for k, s in enumerate(sources)} | {"archivo": _file_name()}
    kept = rows.where(value[subset].isNotNull())
    return kept.select(*[value[source].alias(target) for target, source in mapping.items()]), verdicts.drop("headers")
