"""Versioned folders: a write becomes visible at once or not at all.

``path/data/<folder>`` holds the tables, ``path/commits/<number>`` one small file per commit with a JSON
note. A writer fills a new data folder first and then creates the next commit file, which the file system
grants to one writer only; readers take the newest commit, or stay with the one they name. A write that fails
half-way leaves a folder that no commit names. Only commit notes reach the driver.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence

from pyspark.errors.exceptions.base import PySparkException
from pyspark.sql import DataFrame, SparkSession

try:
    from py4j.protocol import Py4JJavaError
except ModuleNotFoundError:  # a client without a JVM of its own
    Py4JJavaError = PySparkException

#: Digits of a commit's file name; names sort as numbers do.
DIGITS = 10


class CommitConflict(RuntimeError):
    """Another writer committed first."""


def file_system(spark: SparkSession, path: str):
    """(file system, path) of the JVM; any store that Spark reads will do."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none where there is no such folder."""
    fs, p = file_system(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def versions(spark: SparkSession, path: str) -> list[int]:
    """The committed versions, oldest first."""
    return [int(n) for n in list_names(spark, f"{path}/commits") if n.isdigit()]


def commit_note(spark: SparkSession, path: str, version: int | None = None) -> dict | None:
    """The note of ``version`` (default: the newest), with its number as ``version``; None where nothing is committed."""
    known = versions(spark, path)
    if version is None:
        version = known[-1] if known else None
    if version is None:
        return None
    if version not in known:
        raise ValueError(f"{path} has no version {version}")
    fs, p = file_system(spark, f"{path}/commits/{version:0{DIGITS}d}")
    stream = fs.open(p)
    try:
        text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return json.loads(text) | {"version": version}


def commit(spark: SparkSession, path: str, note: dict, after: int | None) -> int:
    """Creates the commit that follows version ``after`` (None: the first). Raises ``CommitConflict`` when another writer was faster.

    The note is written to a file of its own and then renamed, so a reader never sees half of one.
    """
    number = 0 if after is None else after + 1
    fs, target = file_system(spark, f"{path}/commits/{number:0{DIGITS}d}")
    _, draft = file_system(spark, f"{path}/drafts/{uuid.uuid4().hex}")
    fs.mkdirs(target.getParent())
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(note, sort_keys=True).encode()))
    out.close()
    if fs.exists(target) or not _rename_new(spark, fs, draft, target):
        fs.delete(draft, False)
        raise CommitConflict(f"{path}: version {number} is taken")
    return number


def _rename_new(spark: SparkSession, fs, draft, target) -> bool:
    """Rename that fails where the target exists (``FileContext``; on file systems that lack it the plain rename, which fails there too)."""
    try:
        context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
        none = spark._jvm.org.apache.hadoop.fs.Options.Rename.NONE
        options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = none
        context.rename(draft, target, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception):
            return False
        if "UnsupportedFileSystem" in str(e.java_exception):
            return bool(fs.rename(draft, target))
        raise


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = (), note: dict | None = None) -> int:
    """Writes ``df`` as the next version of the table at ``path`` and commits it; the version's number.

    ``df`` may read the table itself: the version it reads stays. A write that fails, or that another writer
    overtook, changes nothing that readers see.
    """
    spark = df.sparkSession
    current = commit_note(spark, path)
    folder = uuid.uuid4().hex
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{path}/data/{folder}")
    return commit(spark, path, (note or {}) | {"folder": folder, "schema": df.schema.jsonValue()}, current and current["version"])


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The table at ``path`` as of ``version`` (default: the newest). The frame stays with the version it was made for."""
    from pyspark.sql.types import StructType

    note = commit_note(spark, path, version)
    if note is None:
        raise ValueError(f"{path} holds no committed version")
    return spark.read.schema(StructType.fromJson(note["schema"])).parquet(f"{path}/data/{note['folder']}")


def clean_versions(spark: SparkSession, path: str, keep: int = 2, folders_of: Callable[[dict], list[str]] = lambda note: [note["folder"]]) -> list[str]:
    """Deletes commits but the newest ``keep`` and the data folders that no remaining commit names; the names of the deleted folders.

    Call it when no write is running: a folder that is being filled is named by no commit yet.
    """
    if keep < 1:
        raise ValueError("the newest version must stay")
    known = versions(spark, path)
    named = {f for v in known[-keep:] for f in folders_of(commit_note(spark, path, v))}
    gone = []
    for v in known[:-keep]:
        fs, p = file_system(spark, f"{path}/commits/{v:0{DIGITS}d}")
        fs.delete(p, False)
    for folder in list_names(spark, f"{path}/data"):
        if folder not in named:
            fs, p = file_system(spark, f"{path}/data/{folder}")
            fs.delete(p, True)
            gone.append(folder)
    return gone
