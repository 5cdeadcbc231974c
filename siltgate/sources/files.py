"""File listing and small reads through Hadoop's file system, so any store works."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession

from siltgate.session import new_path


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, target = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def read_small(spark: SparkSession, path: str) -> str:
    """A small text file whole, such as a manifest."""
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_small(spark: SparkSession, path: str, text: str) -> None:
    """A small text file that is there whole or not at all; one that is there already stays."""
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    started = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}")
    stream = fs.create(started, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(started, target):
        raise FileExistsError(path)


def remove(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def require_folder(spark: SparkSession, path: str) -> None:
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(f"input path not found: {path}")
    if not fs.getFileStatus(target).isDirectory():
        raise ValueError(f"input path must be a directory: {path}")


@dataclass(frozen=True)
class Found:
    """A file to be read at ``path``, found at ``origin``; the two differ for names Spark hides."""

    path: str
    origin: str


# Spark's file sources leave out names that start with an underscore, but for those with an
# equals sign. Such a file is read from a copy whose name starts like this.
VISIBLE = "silt="
COPIERS = 16
GLOBBERS = 3
# Listing tasks for each core.
LISTERS = 8


@dataclass(frozen=True)
class Listing:
    """``files`` in order of path; ``listed`` are Spark's listings of the ``roots``, which have all
    of them but the copied ones."""

    files: list[Found]
    roots: list[str]
    listed: list[DataFrame]


def find_files(spark: SparkSession, folder: str, pattern: str) -> Listing:
    """Every matching file below ``folder`` whose name does not start with a dot, in order of path.

    Spark lists the folder, many subfolders in parallel, and hides whatever starts with an
    underscore or a dot. So folders it hides are listed as roots of their own, and files it
    hides, which are few, are copied to the shared folder under a name it shows.
    """
    require_folder(spark, folder)
    hidden_folders, hidden = _hidden_below(spark, folder, pattern)
    roots = [folder, *hidden_folders]
    session = listing_session(spark)
    listed = [list_files(session, root, pattern) for root in roots]
    paths = {path for files in listed for path in input_files(files)}
    found = [Found(path, path) for path in paths] + _copies(spark, folder, hidden)
    return Listing(sorted(found, key=lambda f: f.origin), roots, listed)


def listing_session(spark: SparkSession) -> SparkSession:
    """A sibling session with the same settings, but that a task lists many folders, not one of them."""
    sibling = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            sibling.conf.set(key, value)
    sibling.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", LISTERS * spark.sparkContext.defaultParallelism)
    return sibling


def input_files(df: DataFrame) -> list[str]:
    """Paths of the files a frame reads, from its listing, without a job."""
    jvm = df.sparkSession.sparkContext._jvm
    joined = jvm.org.apache.hadoop.util.StringUtils.join("\0", df._jdf.inputFiles())
    # Listings have file:///x as rows show file:/x.
    return [re.sub("^file:/+", "file:/", unquote(path)) for path in joined.split("\0")] if joined else []


def list_files(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """path, length and content of every matching file below the folder, listed by Spark.

    As in every Spark file source, names starting with ``_`` or ``.`` are not seen.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", pattern)
        .load(literal(folder))
        .select("path", "length", "content")
    )


def literal(path: str) -> str:
    """A path that Spark and globs take as it is, special characters and all."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", path)


def _hidden_below(spark: SparkSession, folder: str, pattern: str) -> tuple[list[str], list[str]]:
    """Folders, and matching files that start with an underscore, which Spark would not list."""
    fs, top = _file_system(spark, folder)
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    base = literal(fs.resolvePath(top).toString())
    folders: list[str] = []
    files: list[str] = []
    depth = 0
    # A glob lists folder after folder, so the globs of a depth run side by side.
    with ThreadPoolExecutor(GLOBBERS) as globbers:
        while True:
            at = base + "/*" * depth
            patterns = ("*", "{_*,.*}", _underscored(pattern))
            below, hidden, matching = globbers.map(lambda p: fs.globStatus(path_of(f"{at}/{p}")) or [], patterns)
            if not len(below):
                return folders, files
            folders += [s.getPath().toString() for s in hidden if s.isDirectory()]
            files += [s.getPath().toString() for s in matching if s.isFile() and s.getPath().getName().startswith("_")]
            depth += 1


def _underscored(pattern: str) -> str:
    """A pattern for the same names, as far as it can tell only those that start with an underscore."""
    if pattern.startswith("*"):
        return f"_{pattern}"
    return f"_{pattern[1:]}" if pattern.startswith("?") else pattern


def _copies(spark: SparkSession, folder: str, origins: list[str]) -> list[Found]:
    if not origins:
        return []
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    place = new_path(spark, "hidden-names")

    def copy(number: int) -> Found:
        fs, source = _file_system(spark, origins[number])
        target = f"{place}/{number}/{VISIBLE}{source.getName()}"
        to, target_path = _file_system(spark, target)
        jvm.org.apache.hadoop.fs.FileUtil.copy(fs, source, to, target_path, False, conf)
        return Found(to.resolvePath(target_path).toString(), origins[number])

    with ThreadPoolExecutor(COPIERS) as copiers:
        return list(copiers.map(copy, range(len(origins))))


def first_line(spark: SparkSession, path: str, charset: str) -> str | None:
    fs, target = _file_system(spark, path)
    java = spark.sparkContext._jvm.java.io
    reader = java.BufferedReader(java.InputStreamReader(fs.open(target), charset))
    try:
        return reader.readLine()
    finally:
        reader.close()


def first_bytes(spark: SparkSession, path: str, n: int) -> bytes:
    fs, target = _file_system(spark, path)
    stream = fs.open(target)
    try:
        found = [stream.read() for _ in range(n)]
    finally:
        stream.close()
    return bytes(b for b in found if b >= 0)
