"""Daily increments as Structured Streaming.

The reference runs a cron job per day over the day's new files. Here the
same increments are streaming queries over the landing folder, run with
``trigger(availableNow=True)``: each run processes exactly the files that
arrived since the last one (the checkpoint records them) and stops.

* R1 ``review_file_stream``: new review files as a stream.
* R2 + R4 ``upsert_batches``: each micro-batch merged into a Parquet table by
  key. A key stored by any earlier run is a duplicate, however old its day:
  a newly charted film brings its whole back catalogue, so nothing may
  depend on a watermark. Stored keys are looked up in a bucketed index
  (``sources.keyindex``); a retried batch replaces its own rows.
* R3 ``counts_to_table`` / ``read_counts``: reviews per film and day. Each
  micro-batch adds its counts, a read sums them, so late and dateless
  reviews count like any other. Counts of equal size are merged as they
  gather, so a read opens as many folders as the number of batches has bits.
* A15 + J3 + F15 ``new_since_latest_batches``: the rows later than their
  film's latest day so far. The latest days are a table of one row a film
  that each batch replaces; no watermark, no row of a film is moved to a
  task of its own, however many reviews it has.

What a stream knows between batches is a table that it commits with the
batch's number (``sources.versions``). Checkpoints and outputs live
under the session's ``spark.checkpoint.dir`` (a shared folder on a cluster).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from reviewlake.functions.dates import parse_review_date
from reviewlake.functions.files import source_file_name
from reviewlake.operators.incremental import latest_per_movie, new_since_latest
from reviewlake.sources import schemas
from reviewlake.sources.files import CSV_OPTIONS, review_glob
from reviewlake.sources.keyindex import merge_into, read_merged
from reviewlake.sources.versions import CommitConflict, clean_versions, commit, commit_note, publish, read_version


def review_file_stream(spark: SparkSession, folder: str, platform: str, max_files: int | None = None) -> DataFrame:
    """A platform's landed review CSVs as a stream (explicit schema)."""
    r = (spark.readStream.schema(schemas.REVIEW_SCHEMAS[platform]).options(**CSV_OPTIONS)
         .option("pathGlobFilter", review_glob(platform)))
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.csv(folder).withColumn("file_name", source_file_name())


def parquet_stream(spark: SparkSession, folder: str, schema, glob: str | None = None) -> DataFrame:
    """A Parquet landing folder as a stream (used for the driver tables)."""
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.parquet(folder)


def with_review_day(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The review day as a date, ``review_date``; null where it cannot be read."""
    return df.withColumn("review_date", parse_review_date(date_col))



def table_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """The Parquet table at ``path``, or None where there is no such folder yet; other errors are raised."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def run_name(checkpoint: str) -> str:
    """A short name for the query that keeps its progress at ``checkpoint``."""
    return hashlib.sha256(checkpoint.encode()).hexdigest()[:12]


def upsert_batches(df: DataFrame, out_path: str, keys: Sequence[str], checkpoint: str,
                   partition_col: str | None = None, buckets: int = 64, expected_keys: int = 10_000_000) -> StreamingQuery:
    """R2 + R4: adds each micro-batch's rows whose keys the table lacks.

    Null keys compare equal. ``out_path/rows`` holds the rows (read them with ``read_merged``), ``out_path/_index``
    the stored keys, so the cost of a batch follows the batch, not the table. A batch's rows lie under the batch's own
    name: rerunning it (after a lost executor or a restart) replaces them. ``partition_col`` divides them further.
    """
    keys = list(keys)
    run = run_name(checkpoint)

    def merge(batch: DataFrame, epoch: int) -> None:
        merge_into(batch, out_path, keys, f"{run}-{epoch}", [partition_col] if partition_col else [], buckets, expected_keys)

    return (df.writeStream.outputMode("append").foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# ------------------------------------------------------------ R3: counts
def add_counts(counts: DataFrame, out_path: str, run: str, epoch: int, keys: Sequence[str]) -> None:
    """Adds one batch's ``counts`` (keys, count) to the table at ``out_path``; a batch that was added already adds nothing.

    The newest commit lists the folders that count, each with its level. A new batch has level 0; while two folders of
    one level are listed, they are summed into one of the next, as when 1 is added to a binary number. A folder is in
    the list or not: what is being merged stays listed until its sum is committed in its place.
    """
    spark = counts.sparkSession
    while True:
        note = commit_note(spark, out_path) or {"folders": [], "epochs": {}, "version": None}
        if note["epochs"].get(run, -1) >= epoch:
            return
        folders = list(note["folders"])
        name, level, parts = uuid.uuid4().hex, 0, [counts]
        while folders and folders[-1]["level"] == level:
            parts.append(spark.read.schema(counts.schema).parquet(f"{out_path}/data/{folders.pop()['name']}"))
            level += 1
        _summed(parts, keys).write.parquet(f"{out_path}/data/{name}")
        new = {"folders": [*folders, {"name": name, "level": level}], "epochs": note["epochs"] | {run: epoch}}
        try:
            commit(spark, out_path, new, note["version"])
            return
        except CommitConflict:  # another stream added its batch meanwhile
            continue


def _summed(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy(*keys).agg(F.sum("count").cast("bigint").alias("count"))


def counts_to_table(df: DataFrame, out_path: str, checkpoint: str, keys: Sequence[str] = ("movieNm",),
                    day_col: str = "review_date") -> StreamingQuery:
    """R3 sink: the counts of each micro-batch's reviews, added to the table at ``out_path``. ``read_counts`` sums them."""
    keys = [*keys, day_col]
    run = run_name(checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        add_counts(batch.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")), out_path, run, epoch, keys)

    return (df.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def count_folders(spark: SparkSession, path: str) -> list[str]:
    """The folders that a read of the counts opens: at most as many as the number of batches has bits."""
    note = commit_note(spark, path)
    return [f"{path}/data/{f['name']}" for f in note["folders"]] if note else []


def read_counts(spark: SparkSession, path: str, keys: Sequence[str] = ("movieNm",),
                day_col: str = "review_date") -> DataFrame:
    """Reviews per film and day over all batches so far (a null day is a day of its own)."""
    return _summed([spark.read.parquet(*count_folders(spark, path))], [*keys, day_col])


def compact_counts(spark: SparkSession, path: str, out_path: str, keys: Sequence[str] = ("movieNm",),
                   day_col: str = "review_date") -> None:
    """Writes the counts at ``path`` as a table of one folder at ``out_path``; a second call there adds nothing."""
    add_counts(read_counts(spark, path, keys, day_col), out_path, run_name(path), 0, [*keys, day_col])


def clean_counts(spark: SparkSession, path: str) -> list[str]:
    """Deletes the folders that merging left behind; call it when no stream writes."""
    return clean_versions(spark, path, 1, lambda note: [f["name"] for f in note["folders"]])


# ------------------------------------------------------------ A15 + J3 + F15: newer than the film's latest day
def new_since_latest_batches(df: DataFrame, out_path: str, checkpoint: str, date_col: str = "date") -> StreamingQuery:
    """The reviews of each micro-batch that are later than their film's latest day before the batch, written to ``out_path/rows``.

    Films never seen and reviews whose day cannot be read are kept, as in the batch rule. ``out_path/latest`` holds one row a
    film (movieNm, latest_date) and commits with the batch's number: a batch that runs again compares with the days
    before it, not with its own, and replaces its rows. Reviews join the small table and are not grouped by film.
    """
    run = run_name(checkpoint)

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        latest_path = f"{out_path}/latest"
        batch = batch.persist()
        try:
            note = commit_note(spark, latest_path)
            done = note is not None and note["run"] == run and note["epoch"] >= epoch
            before = note and (note["before"] if done else note["version"])
            known = read_version(spark, latest_path, before) if before is not None else spark.createDataFrame([], "movieNm string, latest_date date")
            new_since_latest(batch, known, date_col).write.mode("overwrite").parquet(f"{out_path}/rows/batch={run}-{epoch}")
            if not done:
                days = latest_per_movie(batch, date_col).unionByName(known)
                publish(days.groupBy("movieNm").agg(F.max("latest_date").alias("latest_date")), latest_path,
                        note={"run": run, "epoch": epoch, "before": before})
        finally:
            batch.unpersist()

    return (df.writeStream.outputMode("append").foreachBatch(write)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def run_to_table(spark: SparkSession, df: DataFrame, out: str, checkpoint: str, mode: str = "counts",
                 keys: Sequence[str] = (), partition_col: str | None = None) -> DataFrame:
    """Run a stream until the available input is consumed; read the result (``mode``: counts, upsert or latest)."""
    if mode == "counts":
        counts_to_table(df, out, checkpoint, keys or ("movieNm",)).awaitTermination()
        return read_counts(spark, out, keys or ("movieNm",))
    if mode == "latest":
        new_since_latest_batches(df, out, checkpoint).awaitTermination()
        return read_merged(spark, out)
    upsert_batches(df, out, keys, checkpoint, partition_col).awaitTermination()
    return read_merged(spark, out)
