"""Scan a folder of CSV files into records and error rows.

Every value stays text. The files are parsed once, into a staged table that
keeps each row's file, split and place; row numbers, skipped rows, short rows
and cut files all come from that table, so they agree with each other.

A file is read whole by one task, many files side by side, so that a quoted value
may hold line breaks; its lines end as its first line does, whatever its size.
Files declared free of such values are read in splits.
"""

from __future__ import annotations

import codecs
import csv
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from siltgate.fixed_values import SHORT_ROW
from siltgate.functions.text import all_blank, lit, name, strip
from siltgate.session import broadcast_if_small, new_path, stage
from siltgate.sources.files import VISIBLE, Found, Listing, find_files, first_bytes, first_line, input_files, listing_session, literal

# First lines are read by so many threads at once.
HEADER_READERS = 32
# From so many files on, first lines of files of at most so many bytes are read by a job.
MANY_FILES = 500
SMALL_FILE_BYTES = 1 << 20
PATH_PARTS = 256
# Character sets in which a line ends at the bytes \r and \n, wherever they are.
BYTE_LINES = ("iso-8859-1", "us-ascii", "utf-8")
# A row of numbers per split is sent to every task up to this many bytes of parquet; about a
# million splits fit.
SPLITS_BYTES = 32 << 20
# Character sets that Spark's reader takes by these names.
CHARSETS = ("iso-8859-1", "us-ascii", "utf-16", "utf-16be", "utf-16le", "utf-32", "utf-8")


@dataclass(frozen=True)
class CsvOptions:
    """``columns`` declares the header, which is then checked, not discovered.

    ``multi_line`` allows line breaks inside quotes. False declares that there are none: then
    large files are read in splits, and each of \\n, \\r\\n and \\r ends a line. ``encoding`` is
    any name Python knows that the JVM knows too; ``utf-16`` without a mark is little-endian.
    """

    delimiter: str = ","
    encoding: str = "utf-8"
    has_header: bool = True
    columns: tuple[str, ...] | None = None
    pattern: str = "*.csv"
    multi_line: bool = True

    @property
    def charset(self) -> str:
        """The encoding by the name Spark has for it, else by Python's."""
        known = codecs.lookup(self.encoding).name
        spark_name = {"utf-16-le": "utf-16le", "utf-16-be": "utf-16be", "ascii": "us-ascii", "iso8859-1": "iso-8859-1"}
        return spark_name.get(known, known)


@dataclass(frozen=True)
class CsvScan:
    """``records``: lineage plus ``raw_record`` and ``normalized_record`` structs.

    A NULL field means that the row's file has no such column.
    ``errors``: source_file, source_path, row_number (NULL when the file as a whole failed),
    error, row. ``skipped``: number of blank rows per file.
    """

    records: DataFrame
    errors: DataFrame
    skipped: DataFrame
    file_count: int
    source_path: str

    @property
    def rows(self) -> DataFrame:
        """Lineage and the normalized values as flat columns."""
        return self.records.select("source_file", "source_path", "row_number", "normalized_record.*")

    def summary(self, record_count: DataFrame | None = None) -> DataFrame:
        """One row: path, files, records (of ``record_count`` when a filter followed), errors."""
        counted = self.records if record_count is None else record_count
        kinds = counted.selectExpr("1L as good", "0L as bad").unionAll(
            self.errors.selectExpr("0L as good", "1L as bad")
        )
        return kinds.selectExpr(
            f"{lit(self.source_path)} as source_path",
            f"{self.file_count}L as file_count",
            "coalesce(sum(good), 0L) as record_count",
            "coalesce(sum(bad), 0L) as error_count",
        )


def read_csv(
    spark: SparkSession, folder: str, run_ts: datetime, options: CsvOptions = CsvOptions()
) -> CsvScan:
    listing = find_files(spark, folder, options.pattern)
    files = listing.files
    groups = _headers(spark, listing, options)
    columns: list[str] = []
    for header, _ in groups:
        columns += [c for c in header if c not in columns]
    reader = _reading_session(spark, options)
    parsed = None
    for (header, charset), paths in groups.items():
        rows = _read_all(reader, listing, paths, header, charset, options)
        if rows is None:
            rows = _read(reader, [literal(p) for p in paths], header, charset, options)
        part = _parse(rows, header, columns, options)
        parsed = part if parsed is None else parsed.unionByName(part)
    if parsed is None:
        parsed = reader.createDataFrame([], _empty_schema(columns))
    path = new_path(spark, "csv")
    parsed.write.parquet(path)
    staged = _as_found(spark, spark.read.schema(parsed.schema).parquet(path), files)
    undecodable = _undecodable(spark, groups, staged, columns, files, options)
    return _scan(staged, columns, undecodable, len(files), folder, run_ts, options)


def _headers(
    spark: SparkSession, listing: Listing, options: CsvOptions
) -> dict[tuple[tuple[str, ...], str], list[str]]:
    """Files by header and character set. Like schema inference this runs before the query, on
    first lines only."""
    marked = options.charset == "utf-16"
    paths = [f.path for f in listing.files]

    def head(path: str) -> tuple[str, str | None]:
        charset = options.charset
        if marked and first_bytes(spark, path, 2) not in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
            charset = "utf-16le"
        return charset, None if options.columns is not None else first_line(spark, path, charset)

    if options.columns is not None and not marked:
        return {(tuple(options.columns), options.charset): paths} if paths else {}
    known = _first_lines(listing, options.charset) if len(paths) >= MANY_FILES else {}
    with ThreadPoolExecutor(HEADER_READERS) as readers:
        others = [path for path in paths if path not in known]
        heads = known | dict(zip(others, readers.map(head, others)))
    headers: dict[str, tuple[str, ...]] = {}
    found: dict[tuple[tuple[str, ...], str], list[str]] = {}
    for path in paths:
        charset, line = heads[path]
        if options.columns is not None:
            header = tuple(options.columns)
        elif line is None:
            continue
        else:
            if line not in headers:
                fields = next(csv.reader([line], delimiter=options.delimiter), [])
                headers[line] = tuple(fields if options.has_header else (f"_c{i}" for i in range(len(fields))))
            header = headers[line]
        found.setdefault((header, charset), []).append(path)
    return found


def _first_lines(listing: Listing, charset: str) -> dict[str, tuple[str, str | None]]:
    """Character set and first line (None for an empty file) of the small files, by path, read by tasks."""
    if charset not in BYTE_LINES:
        return {}
    # One character a byte, so a broken line stays as it is until it is decoded here.
    line = F.expr("case when length > 0 then regexp_extract(decode(content, 'ISO-8859-1'), '^[^\\\\r\\\\n]*', 0) end")
    heads: dict[str, tuple[str, str | None]] = {}
    for files in listing.listed:
        # By line, so that a line that many files share does not come with each, and in parts, so that no task has all of them.
        small = files.where(F.col("length") <= SMALL_FILE_BYTES).select("path", line.alias("line"))
        parts = small.groupBy("line", F.pmod(F.hash("path"), F.lit(PATH_PARTS)).alias("part"))
        for row in parts.agg(F.collect_list("path").alias("paths")).collect():
            text = row["line"]
            text = None if text is None else text.encode("iso-8859-1").decode(charset, "replace")
            heads |= dict.fromkeys(row["paths"], (charset, text))
    return heads


def _reading_session(spark: SparkSession, options: CsvOptions) -> SparkSession:
    """A sibling session that lists many folders a task, with any of the JVM's character sets
    allowed, if one is needed."""
    sibling = listing_session(spark)
    if options.charset not in CHARSETS:
        sibling.conf.set("spark.sql.legacy.javaCharsets", "true")
    return sibling


def _as_found(spark: SparkSession, staged: DataFrame, files: list[Found]) -> DataFrame:
    """Rows of copied files, whose names Spark hides, under the names they were found by."""
    copied = [(_plain(f.path), f.origin) for f in files if f.path != f.origin]
    if not copied:
        return staged
    origins = spark.createDataFrame(copied, "_copy string, _origin string")
    plain = F.regexp_replace(F.url_decode(F.regexp_replace("_path", r"\+", "%2B")), "^file:/+", "/")
    return (
        # One row for each hidden name.
        staged.withColumn("_copy", plain).join(F.broadcast(origins), "_copy", "left")
        .withColumn("_path", F.coalesce("_origin", "_path"))
        .withColumn("source_file", F.expr(f"case when _origin is null then source_file else substring(source_file, {len(VISIBLE) + 1}) end"))
        .drop("_copy", "_origin")
    )


def _plain(path: str) -> str:
    """file:/x, file:///x and /x alike."""
    return re.sub("^file:/+", "/", path)


def _listed(metadata_path: str) -> str:
    """A row's file path, which is URL-encoded, in the form of the listing."""
    return _plain(unquote(metadata_path))


def _positions(header: tuple[str, ...]) -> list[str]:
    """Fields are read by position, so a repeated name is no conflict: the last one wins."""
    return [f"_f{i}" for i in range(len(header))]


def _text_schema(header: tuple[str, ...]) -> str:
    return ", ".join(f"{p} string" for p in [*_positions(header), "_bad"])


def _read_all(
    spark: SparkSession, listing: Listing, paths: list[str], header: tuple[str, ...], charset: str, options: CsvOptions
) -> DataFrame | None:
    """As ``_read``, by folder, if ``paths`` are many and all files below the listed roots; else None."""
    if len(paths) < MANY_FILES or len(paths) != len(listing.files):
        return None
    rows = _read(spark, [literal(r) for r in listing.roots], header, charset, options, options.pattern)
    # A file that has landed since, or a copied one, is told by the listing.
    return rows if sorted(input_files(rows)) == sorted(paths) else None


def _read(
    spark: SparkSession,
    paths: list[str],
    header: tuple[str, ...],
    charset: str,
    options: CsvOptions,
    pattern: str | None = None,
) -> DataFrame:
    """Fields by position, with each row's file, split and place. ``pattern``: of files below ``paths``."""
    read = (
        spark.read.schema(_text_schema(header))
        .option("header", options.has_header)
        .option("sep", options.delimiter)
        .option("encoding", charset)
        .option("multiLine", options.multi_line)
        .option("escape", '"')
        .option("columnNameOfCorruptRecord", "_bad")
    )
    if pattern:
        read = read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
    read = read.csv(paths)
    return read.select(
        *_positions(header),
        "_bad",
        F.col("_metadata.file_path").alias("_path"),
        F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_place"),
    )


def _parse(
    rows: DataFrame, header: tuple[str, ...], columns: list[str], options: CsvOptions
) -> DataFrame:
    """Rows of files with one header, under the columns of all headers."""
    positions = _positions(header)
    last = {c: positions[i] for i, c in enumerate(header)}
    # Fields the row lacks and fields left blank are both NULL here; only rows
    # marked bad can lack any, so elsewhere NULL is blank.
    values = [
        f"case when _bad is null then coalesce({last[c]}, '') else {last[c]} end as {name(c)}"
        if c in last
        else f"cast(null as string) as {name(c)}"
        for c in columns
    ]
    bare = r"regexp_replace(_bad, '\"([^\"]|\"\")*\"', '')"
    breaks = f"(length({bare}) - length(replace({bare}, {lit(options.delimiter)}, '')))"
    fields = f"{breaks} div {len(options.delimiter)} + 1"
    state = (
        f"case when _bad is not null and {fields} > {len(header)} then 'long'"
        f" when {all_blank([name(p) for p in positions])} then 'blank'"
        " when _bad is not null then 'short' else 'good' end"
    )
    return rows.selectExpr(
        *values, f"{state} as _state", "_bad", "_path", "source_file", "_block", "_place"
    )


def _empty_schema(columns: list[str]) -> str:
    fields = [f"{name(c)} string" for c in columns]
    return ", ".join(
        [*fields, "_state string, _bad string, _path string, source_file string, _block long, _place long"]
    )


def _undecodable(
    spark: SparkSession,
    groups: dict[tuple[tuple[str, ...], str], list[str]],
    staged: DataFrame,
    columns: list[str],
    files: list[Found],
    options: CsvOptions,
) -> list[tuple[str, str]]:
    """Path and name of the files that are not valid in their encoding.

    The reader puts U+FFFD where it cannot decode. In a character set without that character
    this is proof; in the others the file's bytes are decoded once more, strictly.
    """
    if not columns:
        return []
    marked = " or ".join([f"instr({name(c)}, '\ufffd') > 0" for c in [*columns, "_bad"]])
    # Paths as rows carry them: URL-encoded, but for copied files.
    shown = {_listed(r["_path"]): r["_path"] for r in staged.filter(marked).select("_path").distinct().collect()}
    named = {p for (header, _), paths in groups.items() if any("\ufffd" in c for c in header) for p in paths}
    chosen = [f for f in files if f.path in named or _plain(f.origin) in shown]
    if named:
        shown |= {_listed(r["_path"]): r["_path"] for r in staged.select("_path").distinct().collect()}
    if chosen and _can_encode("\ufffd", options.encoding):
        charsets = {_plain(p): charset for (_, charset), paths in groups.items() for p in paths}
        broken: set[str] = set()
        for charset in set(charsets.values()):
            paths = [f.path for f in chosen if charsets.get(_plain(f.path)) == charset]
            if paths:
                found = spark.read.format("binaryFile").load([literal(p) for p in paths]).select("path", "content")
                broken |= {_plain(r["path"]) for r in found.mapInPandas(_broken(charset), "path string").collect()}
        chosen = [f for f in chosen if _plain(f.path) in broken]
    return [(shown.get(_plain(f.origin), f.origin), f.origin.rsplit("/", 1)[1]) for f in chosen]


def _can_encode(character: str, encoding: str) -> bool:
    try:
        return bool(character.encode(encoding))
    except UnicodeEncodeError:
        return False


def _broken(charset: str):
    """Paths of the files whose bytes are not valid, a chunk of a file decoded at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            bad = []
            for path, content in zip(batch["path"], batch["content"]):
                decoder = codecs.getincrementaldecoder(charset)("strict")
                try:
                    for at in range(0, len(content), 1 << 20):
                        decoder.decode(content[at : at + (1 << 20)])
                    decoder.decode(b"", True)
                except UnicodeDecodeError:
                    bad.append(path)
            yield pd.DataFrame({"path": bad}, dtype=object)

    return run


def _scan(
    staged: DataFrame,
    columns: list[str],
    undecodable: list[tuple[str, str]],
    file_count: int,
    folder: str,
    run_ts: datetime,
    options: CsvOptions,
) -> CsvScan:
    spark = staged.sparkSession
    broken = spark.createDataFrame(undecodable, "_path string, source_file string")
    readable = staged.join(F.broadcast(broken), "_path", "left_anti") if undecodable else staged
    numbered = _numbered(readable)
    kept = numbered.filter("_cut is null or row_number < _cut")

    raw = ", ".join(f"{lit(c)}, {name(c)}" for c in columns) or "'_none', null"
    trimmed = {c.strip(): c for c in columns}
    clean = ", ".join(f"{lit(n)}, {strip(name(c))}" for n, c in trimmed.items()) or "'_none', null"
    records = kept.filter("_state = 'good'").selectExpr(
        "source_file",
        "_path as source_path",
        f"{lit(run_ts.isoformat())} as ingestion_timestamp",
        "row_number",
        f"named_struct({raw}) as raw_record",
        f"named_struct({clean}) as normalized_record",
    )
    short = kept.filter("_state = 'short'").selectExpr(
        "source_file", "_path as source_path", "row_number", f"{lit(SHORT_ROW)} as error", "_bad as row"
    )
    cut = numbered.filter("_state = 'long' and row_number = _cut").selectExpr(
        "source_file",
        "_path as source_path",
        "cast(null as bigint) as row_number",
        "concat('Failed to process file: row ', row_number, ' has more values than the header') as error",
        "cast(null as string) as row",
    )
    failed = broken.selectExpr(
        "source_file",
        "_path as source_path",
        "cast(null as bigint) as row_number",
        f"concat('Failed to process file: not valid ', {lit(options.encoding)}) as error",
        "cast(null as string) as row",
    )
    skipped = kept.filter("_state = 'blank'").groupBy("source_file", F.col("_path").alias("source_path")).agg(F.count("*").alias("skipped"))
    return CsvScan(
        records, short.unionByName(cut).unionByName(failed), skipped, file_count, folder
    )


def _numbered(staged: DataFrame) -> DataFrame:
    """Add ``row_number`` (from 1 per file) and ``_cut`` (the file's first long row).

    Rows of a split are consecutive, so a row's number is its distance from the
    first row of its split plus the rows of earlier splits. Only per-split counts
    are aggregated and windowed; rows are joined to them, never sorted per file.
    """
    # Paths are told apart by a hash here, so that a split's row is a few numbers.
    staged = staged.withColumn("_file", F.xxhash64("_path"))
    splits = staged.groupBy("_file", "_block").agg(
        F.min("_place").alias("_first"),
        F.count("*").alias("_rows"),
        F.min(F.expr("case when _state = 'long' then _place end")).alias("_long"),
    )
    earlier = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
    cut = F.min(F.expr("_long - _first + _offset + 1")).over(Window.partitionBy("_file"))
    splits = stage(
        splits.withColumn("_cut", cut).select("_file", "_block", "_first", "_offset", "_cut"), "splits"
    )
    return staged.join(broadcast_if_small(splits, SPLITS_BYTES), ["_file", "_block"]).withColumn(
        "row_number", F.expr("_place - _first + _offset + 1")
    )


def envelope(records: DataFrame) -> DataFrame:
    """The records with their payloads as maps; absent fields have no entry."""

    def as_map(column: str) -> str:
        names = records.schema[column].dataType.names
        pairs = ", ".join(f"{lit(n)}, {column}.{name(n)}" for n in names)
        return f"map_filter(map({pairs}), (k, x) -> x is not null) as {column}"

    return records.selectExpr(
        "source_file",
        "source_path",
        "ingestion_timestamp",
        "row_number",
        as_map("raw_record"),
        as_map("normalized_record"),
    )
