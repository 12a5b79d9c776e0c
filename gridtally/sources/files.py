"""Which delivered files belong to a batch.

``select_batch_files`` works on any listing with ``path``, ``length`` and
``modificationTime``, such as a stored file inventory. Spark's own file sources
leave out empty files, and markers usually are empty, so for a live store
``marked_directories`` finds the markers while listing; the documents of these
directories are then listed once, by the scan that reads them.

Spark skips names that begin with ``_`` or ``.``. Data under such a name would be
lost without a word, so ``refuse_hidden`` fails on it; it looks at a listing of its own,
made by tasks, that has such names too.
"""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally import config
from gridtally.session import work_path
from gridtally.sinks.staging import stage
from gridtally.sources.listing import can_open, list_tree


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings give it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path.rstrip("/") or "/")
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(target).toString()


def escaped(path: str) -> str:
    """The path as a pattern that matches only itself."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def list_files(spark: SparkSession, paths: list[str], name_glob: str = "*") -> DataFrame:
    """All non-empty files under the paths; file contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name_glob)
        .load([escaped(p) for p in paths])
        .select("path", "length", "modificationTime")
    )


def _hidden_by_glob(spark: SparkSession, directories: list[str], ext: str) -> list[str]:
    """Hidden data files below the directories, for file systems that only Spark can open."""
    context = spark.sparkContext
    found: list[str] = []
    by_parent: dict[str, list[str]] = {}
    for directory in directories:
        parent, _, name = directory.rstrip("/").rpartition("/")
        by_parent.setdefault(parent, []).append(escaped(name))
    for parent, names in by_parent.items():
        level = f"{escaped(parent)}/{{{','.join(names)}}}"
        while True:
            pattern = context._jvm.org.apache.hadoop.fs.Path(level + "/*")
            system = pattern.getFileSystem(context._jsc.hadoopConfiguration())
            if not system.globStatus(pattern):
                break
            hidden = context._jvm.org.apache.hadoop.fs.Path(level + "/{_,.}*" + escaped(ext) + "*")
            found += [entry.getPath().toString() for entry in system.globStatus(hidden)]
            level += "/*"
    return found


def _refuse(paths: list[str], n: int) -> None:
    if n:
        raise ValueError(f"{n} data files with hidden names, such as {paths[0]}")


def _is_data(ext: str) -> Column:
    return F.contains(F.substring_index("path", "/", -1), F.lit(ext))


def refuse_hidden(spark: SparkSession, directories: list[str], ext: str = config.DATA_FILE_EXT) -> None:
    """Fails if a data file below the directories has a name that Spark skips, or lies in such a folder.

    The directories are listed by tasks. A file system that Arrow cannot open is searched
    by one pattern for each level instead.
    """
    if not directories:
        return
    if all(map(can_open, directories)):
        lost = list_tree(spark, directories).filter(F.col("hidden") & _is_data(ext))
        seen = lost.agg(F.count("*").alias("n"), F.min("path").alias("path")).first()
        _refuse([seen["path"]], seen["n"])
    else:
        found = _hidden_by_glob(spark, directories, ext)
        _refuse(sorted(found), len(found))


def _below(path: Column, base: str) -> tuple[Column, Column]:
    """The level-1 directory of a path under ``base``, and the path relative to ``base``."""
    root = base.rstrip("/")
    relative = F.substr(path, F.lit(len(root) + 1))
    return F.concat(F.lit(root), F.substring_index(relative, "/", 2)), relative


def select_batch_files(
    listing: DataFrame,
    base: str,
    start: datetime,
    end: datetime,
    marker: str = config.MARKER_FILE,
    max_depth: int = config.MARKER_MAX_DEPTH,
    min_size: int = config.DATA_FILE_MIN_SIZE,
    ext: str = config.DATA_FILE_EXT,
) -> DataFrame:
    """Data files (``dir``, ``path``) of the directories whose marker landed in [start, end).

    ``base`` is written as the listing writes it; ``dir`` is the first level below it. A marker counts down to
    ``max_depth`` separators below the base; a data file is larger than
    ``min_size`` and has ``ext`` anywhere in its name, at any depth.
    Directories without data files do not show up.
    """
    directory, relative = _below(F.col("path"), base)
    depth = F.length(relative) - F.length(F.replace(relative, F.lit("/"), F.lit("")))
    files = listing.filter(F.startswith(F.col("path"), F.lit(base.rstrip("/") + "/"))).withColumns(
        {"dir": directory, "name": F.substring_index(relative, "/", -1), "depth": depth}
    )
    landed = (F.col("modificationTime") >= start) & (F.col("modificationTime") < end)
    is_marker = (F.col("name") == marker) & landed & (F.col("depth") <= max_depth)
    is_data = (F.col("length") > min_size) & F.contains(F.col("name"), F.lit(ext))
    selected = files.filter(is_marker).select("dir")
    return files.filter(~is_marker & is_data).join(selected, "dir", "left_semi").select("dir", "path")


def marked_directories(
    spark: SparkSession,
    base: str,
    start: datetime,
    end: datetime,
    marker: str = config.MARKER_FILE,
    max_depth: int = config.MARKER_MAX_DEPTH,
) -> list[str]:
    """Level-1 directories whose marker landed in [start, end).

    Only paths that can be a marker are listed, and the time window is applied
    while listing.
    """

    def moment(value: datetime) -> str:
        return value.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%f")

    root = qualified(spark, base)
    found = set()
    for level in range(1, max_depth):
        markers = (
            spark.read.format("binaryFile")
            .option("timeZone", "UTC")
            # this bound is exclusive; file times have whole milliseconds
            .option("modifiedAfter", moment(start - timedelta(milliseconds=1)))
            .option("modifiedBefore", moment(end))
        )
        try:
            paths = markers.load(escaped(root) + "/*" * level + "/" + escaped(marker)).inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            continue
        found.update(unquote(path).rsplit("/", level)[0] for path in paths)
    return sorted(found)


def delivered_files(
    spark: SparkSession,
    base: str,
    directories: list[str],
    min_size: int = config.DATA_FILE_MIN_SIZE,
    ext: str = config.DATA_FILE_EXT,
) -> DataFrame:
    """Data files (``dir``, ``path``) of the given directories; fails on hidden ones."""
    if not directories:
        return spark.createDataFrame([], "dir string, path string")
    directory, _ = _below(F.col("path"), qualified(spark, base))
    if not all(map(can_open, directories)):
        refuse_hidden(spark, directories, ext)
        files = list_files(spark, directories, f"*{escaped(ext)}*").filter(F.col("length") > min_size)
        return files.select(directory.alias("dir"), "path")
    # one listing, which the check and the result both read
    tree = stage(list_tree(spark, directories).filter(_is_data(ext)), work_path(spark, "listing"))
    seen = tree.agg(F.count_if("hidden").alias("n"), F.min(F.when(F.col("hidden"), F.col("path"))).alias("path")).first()
    _refuse([seen["path"]], seen["n"])
    return tree.filter(F.col("length") > min_size).select(directory.alias("dir"), "path")


def limit_files(files: DataFrame, n: int) -> DataFrame:
    """The first ``n`` files by directory and path."""
    return files.orderBy("dir", "path").limit(n)
