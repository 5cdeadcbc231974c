"""CSV folders: files are written from customer rows, then scanned."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltgate.session import new_path
from siltgate.sources.csv_files import CsvOptions, CsvScan, envelope, read_csv
from workloads.inputs import FILE_LINES, FILE_ROWS, USERS, sql
from workloads.registry import RUN_TEXT, RUN_TS, query

TEXT_FILES = CsvOptions(pattern="*.txt")
# Tasks put their files in place themselves; else the driver moves file after file.
COMMIT_IN_TASKS = {"mapreduce.fileoutputcommitter.algorithm.version": "2"}
FILE_NO = "cast(regexp_extract(source_path, 'file_no=([0-9]+)', 1) as bigint) as file_no"


def write_lines(lines: DataFrame, label: str) -> str:
    """One file per file_no, lines in the order of pos. Files hold bounded key ranges."""
    folder = new_path(lines.sparkSession, label)
    placed = by_file(lines).select("file_no", "line").write
    placed.partitionBy("file_no").options(**COMMIT_IN_TASKS).text(folder)
    return folder


def by_file(lines: DataFrame) -> DataFrame:
    """Rows of a file in one task, in the order of pos. The number of tasks is given: what costs
    here is files, not bytes, by which Spark would put them together."""
    spark = lines.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    return lines.repartition(tasks, "file_no").sortWithinPartitions("file_no", "pos")


def scan(spark: SparkSession, sf_dir: str) -> CsvScan:
    folder = write_lines(sql(spark, sf_dir, FILE_LINES, "customer"), "lines")
    return read_csv(spark, folder, RUN_TS, TEXT_FILES)


# Row numbers count data rows of a file; a long row ends its file.
EXPECTED = f"""
with numbered as (select *, row_number() over (partition by file_no order by pos) as row_number from ({FILE_ROWS}) r),
cuts as (select file_no, min(row_number) as cut from numbered where kind = 'long' group by file_no),
kept as (select n.* from numbered n left join cuts c on n.file_no = c.file_no where cut is null or row_number < cut)
"""
NAME = """case kind when 'quoted' then concat(name, ', "jr"', chr(10), ' second line') else name end"""


@query(
    "row_number_per_file",
    EXPECTED + "select file_no, row_number, cast(pos as varchar) as id from kept where kind not in ('short', 'blank')",
)
def row_number_per_file(spark, sf_dir):
    return scan(spark, sf_dir).rows.selectExpr(FILE_NO, "row_number", "id")


@query(
    "scan_csv_rows",
    EXPECTED
    + f"""select file_no, cast(pos as varchar) as id, {NAME} as name, segment from kept where kind not in ('short', 'blank')""",
)
def scan_csv_rows(spark, sf_dir):
    return scan(spark, sf_dir).rows.selectExpr(FILE_NO, "id", "name", "segment")


@query(
    "skip_blank_rows",
    EXPECTED + "select file_no, count(*) as skipped from kept where kind = 'blank' group by file_no",
)
def skip_blank_rows(spark, sf_dir):
    return scan(spark, sf_dir).skipped.selectExpr(FILE_NO, "skipped")


@query(
    "malformed_rows",
    EXPECTED
    + """select file_no, row_number, 'Row has missing column value(s).' as error, cast(pos as varchar) as row from kept
      where kind = 'short'""",
)
def malformed_rows(spark, sf_dir):
    errors = scan(spark, sf_dir).errors.filter("row_number is not null")
    return errors.selectExpr(FILE_NO, "row_number", "error", "row")


@query(
    "cut_file_at_bad_row",
    EXPECTED
    + """select n.file_no, count(*) as rows, c.cut is not null as was_cut,
      case when c.cut is not null then concat('Failed to process file: row ', c.cut, ' has more values than the header') end as error
      from kept n left join cuts c on n.file_no = c.file_no where kind not in ('short', 'blank') group by all""",
)
def cut_file_at_bad_row(spark, sf_dir):
    found = scan(spark, sf_dir)
    counts = found.rows.selectExpr(FILE_NO).groupBy("file_no").agg(F.count("*").alias("rows"))
    cuts = found.errors.filter("row_number is null").selectExpr(FILE_NO, "error")
    return counts.join(cuts, "file_no", "left").withColumn("was_cut", F.col("error").isNotNull())


# In every third file one line in 400 has a byte that is not UTF-8.
BROKEN_LINES = f"select file_no, pos, line, file_no % 3 = 1 and pos % 400 = 7 as broken from ({FILE_LINES}) l"


@query(
    "file_errors",
    EXPECTED
    + """select file_no, row_number, 'Row has missing column value(s).' as error from kept where kind = 'short' and file_no % 3 != 1
      union all select file_no, null, concat('Failed to process file: row ', cut, ' has more values than the header') from cuts
      where file_no % 3 != 1
      union all select distinct file_no, null, 'Failed to process file: not valid utf-8' from numbered
      where file_no % 3 = 1 and pos % 400 = 7""",
)
def file_errors(spark, sf_dir):
    lines = sql(spark, sf_dir, BROKEN_LINES, "customer")
    spoiled = F.concat(F.col("line"), F.unhex(F.lit("FF")).cast("string"))
    lines = lines.withColumn("line", F.when(F.col("broken"), spoiled).otherwise(F.col("line")))
    found = read_csv(spark, write_lines(lines, "broken"), RUN_TS, TEXT_FILES)
    return found.errors.selectExpr(FILE_NO, "row_number", "error")


@query(
    "csv_envelope",
    EXPECTED
    + f"""select file_no, row_number, '{RUN_TEXT}' as ingestion_timestamp,
      case kind when 'padded' then concat(' ', pos, ' ') else cast(pos as varchar) end as raw_id,
      case kind when 'padded' then concat(name, ' ') else {NAME} end as raw_name,
      cast(pos as varchar) as id, {NAME} as name, 3 as n_fields from kept where kind not in ('short', 'blank')""",
)
def csv_envelope(spark, sf_dir):
    return envelope(scan(spark, sf_dir).records).selectExpr(
        FILE_NO,
        "row_number",
        "ingestion_timestamp",
        "raw_record['id'] as raw_id",
        "raw_record[' name '] as raw_name",
        "normalized_record['id'] as id",
        "normalized_record['name'] as name",
        "size(normalized_record) as n_fields",
    )


@query(
    "scan_summary",
    EXPECTED
    + """select (select count(distinct file_no) from numbered) as file_count,
      (select count(*) from kept where kind not in ('short', 'blank')) as record_count,
      (select count(*) from kept where kind = 'short') + (select count(*) from cuts) as error_count""",
)
def scan_summary(spark, sf_dir):
    return scan(spark, sf_dir).summary().drop("source_path")


USER_FIELDS = "user_id full_name email phone signup_date country age status newsletter_opt_in".split()


def write_users(users: DataFrame, folder: str) -> None:
    users.select(*USER_FIELDS).write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False
    ).option("emptyValue", "").csv(folder)


@query(
    "scan_csv_users",
    f"""select trim(user_id) as user_id, {', '.join(f'trim({c}) as {c}' for c in USER_FIELDS[1:])} from ({USERS}) raw""",
)
def scan_csv_users(spark, sf_dir):
    users = sql(spark, sf_dir, USERS, "customer", "nation")
    folder = new_path(spark, "users")
    write_users(users, folder)
    return read_csv(spark, folder, RUN_TS).rows.select(*USER_FIELDS)


# Files of 4 rows each.
SMALL_FILE = 4
SMALL_LINES = f"""
select cast(floor(c_custkey / {SMALL_FILE}) as bigint) as file_no, c_custkey as pos,
  concat(cast(c_custkey as string), ',', c_name) as line from customer
union all select distinct cast(floor(c_custkey / {SMALL_FILE}) as bigint), -1, 'id,name' from customer
"""


@query(
    "scan_csv_many_files",
    f"""select c_custkey // {SMALL_FILE} as file_no, cast(c_custkey as varchar) as id, c_name as name,
      row_number() over (partition by c_custkey // {SMALL_FILE} order by c_custkey) as row_number,
      (select count(distinct c_custkey // {SMALL_FILE}) from customer) as files from customer""",
)
def scan_csv_many_files(spark, sf_dir):
    """A file for every four customers."""
    folder = write_lines(sql(spark, sf_dir, SMALL_LINES, "customer"), "many-files")
    found = read_csv(spark, folder, RUN_TS, TEXT_FILES)
    return found.rows.selectExpr(FILE_NO, "id", "name", "row_number", f"{found.file_count}L as files")


# A column of letters beyond ASCII, two bytes a character and no mark; values without line breaks.
UTF16_LINES = f"""select file_no, pos, concat(replace(line, chr(10), ' '), case when pos = -1 then ',é' when line = ' , ,' then ','
  else concat(',ü', cast(pos as string)) end) as line from ({FILE_LINES}) l"""


@query(
    "scan_csv_utf16",
    EXPECTED
    + f"""select file_no, row_number, cast(pos as varchar) as id, replace({NAME}, chr(10), ' ') as name, concat('ü', pos) as mark
      from kept where kind not in ('short', 'blank')""",
)
def scan_csv_utf16(spark, sf_dir):
    lines = sql(spark, sf_dir, UTF16_LINES, "customer")
    folder = new_path(spark, "utf16")
    placed = by_file(lines)
    # One column without quotes: the lines as they are.
    writer = placed.select("file_no", "line").write.partitionBy("file_no").option("encoding", "UTF-16LE")
    writer.option("quote", "\u0000").option("escapeQuotes", False).option("sep", "\u0001").option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(folder)
    found = read_csv(spark, folder, RUN_TS, CsvOptions(encoding="utf-16"))
    return found.rows.selectExpr(FILE_NO, "row_number", "id", "name", "`é` as mark")
