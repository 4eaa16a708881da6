"""Which landed files were read already.

The reference picks files by the day in their name. A ledger of (path, size, modification time) finds every file
that is new or was written again, also late ones; a listing is compared with it before any file is opened.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.sources.files import file_inventory
from reviewlake.sources.versions import commit_note, publish, read_version

IDENTITY = ["path", "length", "modificationTime"]


def pending_files(spark: SparkSession, path: str, ledger: str, glob: str = "*") -> DataFrame:
    """Files under ``path`` that the ledger does not hold with this size and time: path, length, modificationTime, ``state`` (new, rewritten)."""
    listed = file_inventory(spark, path, glob)
    if commit_note(spark, ledger) is None:
        return listed.withColumn("state", F.lit("new"))
    known = read_version(spark, ledger)
    fresh = listed.join(known.select(*IDENTITY), IDENTITY, "left_anti")
    before = known.select("path").distinct().withColumn("_known", F.lit(True))
    return fresh.join(before, "path", "left").select(*IDENTITY, F.when(F.col("_known"), "rewritten").otherwise("new").alias("state"))


def ingest_pending(spark: SparkSession, path: str, ledger: str, read: Callable[[list[str]], DataFrame], write: Callable[[DataFrame, str], None],
                   glob: str = "*", run: str = "") -> DataFrame:
    """Reads the pending files with ``read(paths)``, hands the rows to ``write(rows, run)`` and then records the files; the files of this run.

    The listing is fixed before the read, so a file that lands meanwhile waits for the next run. The ledger commits
    after the write: a run that fails in between is repeated, so ``write`` should replace the run's own rows. The paths go through
    the driver, as in any listing of a folder.
    """
    files = pending_files(spark, path, ledger, glob).persist()
    try:
        paths = [r.path for r in files.select("path").collect()]
        if paths:
            write(read(paths), run)
        named = files.withColumn("run", F.lit(run))
        known = None if commit_note(spark, ledger) is None else read_version(spark, ledger)
        if known is None or paths:
            publish(named if known is None else named.unionByName(known), ledger)
        return read_version(spark, ledger).where(F.col("run") == run)
    finally:
        files.unpersist()
