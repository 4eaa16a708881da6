"""Which keys a table holds, without reading or moving the table.

A merge has to know which rows of an increment are stored already. The index beside a table keeps the SHA-256 of
every stored key in files bucketed by that digest, and a Bloom filter of fixed size. An increment is shuffled by
its digests; rows that the filter has never seen need no look-up; the others join the buckets where they lie, so
nothing stored is exchanged or sorted into place again, whatever the history's size.

Keys are recorded per batch, under the batch's name, so a batch that runs again replaces what it recorded.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlake.operators.skew import keep_first, key_digest
from reviewlake.sources.versions import CommitConflict, commit, commit_note, file_system, publish, read_version

#: Bits of one filter chunk (what Spark's bitmap functions hold) and the bits of it that a key sets.
CHUNK_BITS, KEY_BITS = 32768, 3
KEY = "_key"


def _settings(spark: SparkSession, path: str, buckets: int, expected_keys: int) -> dict:
    """Buckets and filter chunks of the index at ``path``; the first caller's choice holds for ever."""
    note = commit_note(spark, f"{path}/settings")
    if note is None:
        chosen = {"buckets": buckets, "chunks": max(1, expected_keys * 10 // CHUNK_BITS)}
        try:
            commit(spark, f"{path}/settings", chosen, None)
        except CommitConflict:
            pass
        note = commit_note(spark, f"{path}/settings")
    return note


def index_table(spark: SparkSession, path: str, buckets: int) -> str:
    """Name of the catalog's table over the index files at ``path`` (registered on first use in a catalog)."""
    name = f"keys_{hashlib.sha256(path.encode()).hexdigest()[:20]}"
    if not spark.catalog.tableExists(name):
        fs, folder = file_system(spark, f"{path}/keys")
        fs.mkdirs(folder)  # partitions are looked for in it
        place = path.replace("'", "''")
        spark.sql(f"CREATE TABLE {name} ({KEY} BINARY, batch STRING) USING parquet PARTITIONED BY (batch) "
                  f"CLUSTERED BY ({KEY}) INTO {buckets} BUCKETS LOCATION '{place}/keys'")
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    return name


def _probes(key: Column) -> Column:
    return F.array(*[F.pmod(F.xxhash64(key, F.lit(i)), F.lit(CHUNK_BITS)) for i in range(KEY_BITS)])


def _chunk(key: Column, chunks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(chunks))


def _bit(bits: Column, place: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def filter_rows(keys: DataFrame, chunks: int) -> DataFrame:
    """(chunk, bits): the Bloom filter of the column ``_key``."""
    places = keys.select(_chunk(F.col(KEY), chunks).alias("chunk"), F.explode(_probes(F.col(KEY))).alias("place"))
    return places.groupBy("chunk").agg(F.bitmap_construct_agg("place").alias("bits"))


def unseen(new: DataFrame, path: str, keys: Sequence[str], batch: str, buckets: int = 64, expected_keys: int = 10_000_000,
           order: Sequence[str] = ()) -> DataFrame:
    """The rows of ``new`` whose key no other batch recorded, one row a key (the first by ``order``, then by the other columns).

    The result carries the digest as ``_key``; hand it to ``record_keys`` once the rows are safe. ``expected_keys`` sizes the
    filter: beyond it more rows are looked up, none is lost.
    """
    spark = new.sparkSession
    chosen = _settings(spark, path, buckets, expected_keys)
    first = keep_first(new.withColumn(KEY, key_digest(keys)), [KEY], order)
    note = commit_note(spark, f"{path}/filter")
    if note is None:
        return first
    bits = read_version(spark, f"{path}/filter", note["version"]).select(F.col("chunk").alias("_chunk"), "bits")
    probed = first.withColumn("_chunk", _chunk(F.col(KEY), chosen["chunks"])).join(bits, "_chunk", "left")
    hit = F.coalesce(F.forall(_probes(F.col(KEY)), lambda p: _bit(F.col("bits"), p)), F.lit(False))
    probed = probed.withColumn("_hit", hit).select(*first.columns, "_hit")
    stored = spark.table(index_table(spark, path, chosen["buckets"])).where(F.col("batch") != batch).select(KEY)
    # merge join by hint: the stored side is read in its buckets and neither broadcast nor exchanged
    looked_up = probed.where("_hit").hint("merge").join(stored, KEY, "left_anti")
    return probed.where("not _hit").unionByName(looked_up).select(*first.columns)


def record_keys(keys: DataFrame, path: str, batch: str, buckets: int = 64, expected_keys: int = 10_000_000) -> None:
    """Records the column ``_key`` of ``keys`` as the keys of ``batch``, in place of what the batch recorded before.

    The filter is committed before the keys: a bit too many costs a look-up, a bit too few would let a row in twice.
    """
    spark = keys.sparkSession
    chosen = _settings(spark, path, buckets, expected_keys)
    fresh = filter_rows(keys.select(KEY), chosen["chunks"])
    while True:
        note = commit_note(spark, f"{path}/filter")
        both = fresh if note is None else fresh.unionByName(read_version(spark, f"{path}/filter", note["version"]))
        try:
            publish(both.groupBy("chunk").agg(F.bitmap_or_agg("bits").alias("bits")), f"{path}/filter")
            break
        except CommitConflict:
            continue
    name = index_table(spark, path, chosen["buckets"])
    view = f"{name}_{hashlib.sha256(batch.encode()).hexdigest()[:12]}"
    keys.select(KEY).repartition(chosen["buckets"], KEY).createOrReplaceTempView(view)
    quoted = batch.replace("'", "''")
    try:
        spark.sql(f"INSERT OVERWRITE TABLE {name} PARTITION (batch = '{quoted}') SELECT {KEY} FROM {view}")
    finally:
        spark.catalog.dropTempView(view)


def merge_into(new: DataFrame, path: str, keys: Sequence[str], batch: str, partition_by: Sequence[str] = (), buckets: int = 64,
               expected_keys: int = 10_000_000, order: Sequence[str] = ()) -> DataFrame:
    """Adds to the table at ``path`` the rows of ``new`` whose keys it lacks; the rows of the table.

    ``path/rows/batch=<batch>`` holds what each batch added, ``path/_index`` the key index (hidden from readers of the folder; a table that has ``path/index`` keeps it there). A batch that runs again (after a
    lost driver, with other rows or with none) replaces its own rows and nothing else; keys of other batches win over it.
    """
    spark = new.sparkSession
    staged = f"{path}/staged/{uuid.uuid4().hex}"  # what follows overwrites a part of the index, which it may not read any more
    old_fs, old = file_system(spark, f"{path}/index")
    index = f"{path}/index" if old_fs.exists(old) else f"{path}/_index"
    unseen(new, index, keys, batch, buckets, expected_keys, order).write.parquet(staged)
    added = spark.read.parquet(staged)
    record_keys(added, index, batch, buckets, expected_keys)
    w = added.drop(KEY).write.mode("overwrite")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(f"{path}/rows/batch={batch}")
    fs, folder = file_system(spark, staged)
    fs.delete(folder, True)
    return read_merged(spark, path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a table that ``merge_into`` fills."""
    return spark.read.parquet(f"{path}/rows").drop("batch")
