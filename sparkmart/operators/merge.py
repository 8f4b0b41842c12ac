"""Keyed tables: incremental upsert from change events, late key repair.

A keyed table is a folder of parquet files partitioned by a bucket that depends on the key
alone, so an upsert reads and rewrites only the buckets its events fall into. The bucket may
be a hash (the default) or, better where new changes concern recent keys, a range of the
key: then an increment touches few buckets however large the table has become.

Rows carry the position of the event they came from. An event is applied only if it is
newer than the row it meets, and deletes stay as marked rows, so increments may be cut,
repeated or delivered out of order without changing the result. With hard deletes a marked
row keeps its key and position alone, and no reader sees it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparkmart.functions.keys import UNKNOWN_KEY
from sparkmart.functions.packing import pack_hex, unpack_hex
from sparkmart.operators.joins import lookup_join
from sparkmart.session import STORED, shuffles_dropped
from sparkmart.sources import versions
from sparkmart.sources.files import children, exists, remove

BUCKET = "bucket"


def hash_bucket(keys: Sequence[str], buckets: int) -> Column:
    """Bucket by hash: even, but every increment touches every bucket."""
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("bigint")


def number_range_bucket(
    text: str, width: int, spare: int = 1024, buckets: int = 16_384
) -> Column:
    """Bucket by ranges of the number at the end of a text key such as ``SO-17``.

    Ranges of ``width`` numbers go round a ring of ``buckets``, so there are never more,
    however far apart the numbers lie. Keys without a number are spread by hash over
    ``spare`` negative buckets.
    """
    number = F.regexp_extract(F.col(text), "([0-9]{1,18})$", 1).try_cast("bigint")
    without = F.lit(-1) - F.pmod(F.xxhash64(text), F.lit(spare))
    ranged = F.floor(number / F.lit(width)).cast("bigint")
    return F.coalesce(F.pmod(ranged, F.lit(buckets)), without)


def dealt_out(
    sizes: Mapping[int, int], rows_per_task: int
) -> tuple[list[tuple[int, int, int]], int]:
    """For each bucket its first task and how many it has, and the number of all tasks."""
    dealt, first, filled = [], 0, 0
    for bucket, rows in sorted(sizes.items()):
        parts = max(1, -(-rows // rows_per_task))
        if filled and (parts > 1 or filled + rows > rows_per_task):
            first, filled = first + 1, 0
        dealt.append((bucket, first, parts))
        if parts > 1:
            first += parts
        else:
            filled += max(1, rows)
    return dealt, first + (1 if filled else 0)


@dataclass(frozen=True)
class KeyedTable:
    """A keyed table at ``path``, with one writer at a time.

    ``bucket`` must be an expression over the key columns. A bucket is written by as many
    tasks as its rows ask for, ``rows_per_file`` each, whatever its size. ``hex_widths`` names
    columns of hexadecimal text and their usual width, which are shuffled as bytes.
    """

    path: str
    schema: T.StructType
    keys: tuple[str, ...]
    bucket: Column
    order_cols: tuple[str, ...] = ("lsn", "seqval")
    rows_per_file: int = 1_000_000
    delete_mode: str = "soft"
    hex_widths: tuple[tuple[str, int], ...] = ()

    def __post_init__(self):
        if self.delete_mode not in ("soft", "hard"):
            raise ValueError(f"unknown delete_mode {self.delete_mode!r}")

    @property
    def _staged(self) -> str:
        return f"{self.path.rstrip('/')}__staged"

    @property
    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.LongType())])

    def _rows(self, spark: SparkSession) -> DataFrame:
        if not exists(spark, self.path):
            return spark.createDataFrame([], self._stored)
        return spark.read.schema(self._stored).parquet(self.path)

    def read(self, spark: SparkSession) -> DataFrame:
        """The table, its bucket column included."""
        rows = self._rows(spark)
        return rows.where(~self._gone) if self.delete_mode == "hard" else rows

    @property
    def _gone(self) -> Column:
        return F.coalesce("is_deleted", F.lit(False))

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        stays = {*self.keys, *self.order_cols, "is_deleted"}
        columns = [
            F.when(~self._gone, F.col(c)).alias(c)
            if self.delete_mode == "hard" and c not in stays
            else F.col(c)
            for c in self.schema.names
        ]
        return rows.select(*columns).withColumn(BUCKET, self.bucket)

    def _sizes(self, keyed: DataFrame) -> dict[int, int]:
        """Rows per bucket, one number for each: combined within the tasks first."""
        counts = keyed.groupBy(self.bucket.alias(BUCKET)).agg(F.count(F.lit(1)))
        return dict(tuple(r) for r in counts.collect())

    def _clustered(self, df: DataFrame, sizes: Mapping[int, int]) -> DataFrame:
        """Bring the rows of each bucket together in enough tasks, each key in one of them.

        The number of tasks follows from the rows, not from the session's settings. Tasks are
        dealt out by number: a large bucket has some of its own, small ones share one, and none
        gets more than about ``rows_per_file`` rows. ``sizes`` holds one entry per bucket.
        """
        dealt, tasks = dealt_out(sizes, self.rows_per_file)
        if tasks <= 1:
            return df.withColumn("_part", F.lit(0)).repartitionById(1, "_part")
        places = df.sparkSession.createDataFrame(
            dealt, f"{BUCKET} bigint, _first int, _parts int"
        )
        hashed = F.pmod(F.xxhash64(F.lit(1), *self.keys), F.col("_parts")).cast("int")
        part = F.coalesce(F.col("_first") + hashed, F.lit(0))
        placed = df.join(F.broadcast(places), BUCKET, "left").select(
            *df.columns, part.alias("_part")
        )
        if not self.hex_widths:
            return placed.repartitionById(tasks, "_part")
        packed = pack_hex(placed, self.hex_widths).repartitionById(tasks, "_part")
        return unpack_hex(packed, self.hex_widths)

    def replace(self, rows: DataFrame, keys_from: DataFrame | None = None) -> None:
        """Full refresh: the table afterwards holds exactly ``rows``, one per key.

        ``keys_from`` is as for ``upsert``.
        """
        sizes = self._sizes(rows if keys_from is None else keys_from)
        self._store(self._clustered(self._bucketed(rows), sizes).drop("_part"), None)

    def _store(self, rows: DataFrame, touched: list[int] | None) -> None:
        """Let ``rows`` take the place of the ``touched`` buckets, or of the whole table."""
        target = self.path if touched is None else self._staged
        with shuffles_dropped(rows.sparkSession):
            (
                rows.write.mode("overwrite")
                .options(**STORED)
                .option("partitionOverwriteMode", "static")
                .partitionBy(BUCKET)
                .parquet(target)
            )
        if touched is not None:
            self._publish(rows.sparkSession)

    def upsert(
        self, events: DataFrame, keys_from: DataFrame | None = None, *, corrects: bool = False
    ) -> None:
        """Apply ``events``: final state per key, with position and ``is_deleted``.

        Where an event meets a row of its own position the row stays, unless the events are
        rows of this table put right (``corrects``).

        1. The touched buckets and their sizes are found: two numbers per bucket.
           ``keys_from`` is a table with the same keys as ``events`` that is cheaper to
           read, such as the log they were reduced from.
        2. The rows of those buckets and the events are brought together by one shuffle on
           the bucket; the newest row per key stays. The result is already laid out as it is
           written.
        3. It goes to a side folder, and only once that is complete to the table.

        A crash in 2 leaves the table as it was. After a crash in 3 the side folder is
        complete, and ``recover``, called first thing here, finishes the job.
        """
        spark = events.sparkSession
        self.recover(spark)
        sizes = self._sizes(events if keys_from is None else keys_from)
        if not sizes:
            return
        touched = list(sizes)
        existing = self._rows(spark).where(F.col(BUCKET).isin(touched))
        stored = existing.groupBy(BUCKET).agg(F.count(F.lit(1)))
        for bucket, rows in stored.collect():
            sizes[bucket] += rows
        both = existing.withColumn("_new", F.lit(0)).unionByName(
            self._bucketed(events).withColumn("_new", F.lit(1))
        )
        # On equal positions the event has been applied before.
        tie = F.col("_new").desc() if corrects else F.col("_new")
        newest = Window.partitionBy(BUCKET, "_part", *self.keys).orderBy(
            *[F.col(c).desc() for c in self.order_cols], tie
        )
        merged = (
            self._clustered(both, sizes)
            .withColumn("_rank", F.row_number().over(newest))
            .where(F.col("_rank") == 1)
            .drop("_rank", "_part", "_new")
        )
        self._store(merged, touched)

    def recover(self, spark: SparkSession) -> bool:
        """Finish an upsert that was cut off after its result was complete."""
        if exists(spark, f"{self._staged}/_SUCCESS"):
            self._publish(spark)
            return True
        return False

    def _publish(self, spark: SparkSession) -> None:
        (
            spark.read.schema(self._stored)
            .parquet(self._staged)
            .write.mode("overwrite")
            .options(**STORED)
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(BUCKET)
            .parquet(self.path)
        )
        remove(spark, self._staged)


@dataclass(frozen=True)
class Summary:
    """Something known of every bucket: per ``key`` the least ``value`` and how many rows.

    Only rows with ``condition`` and a key that is not NULL count.
    """

    name: str
    condition: Column
    key: Column
    value: Column


@dataclass(frozen=True)
class Waiting:
    """Rows whose ``key`` is the ``unknown`` one wait for what their ``reference`` names."""

    name: str
    reference: str
    key: str
    unknown: object

    @property
    def summary(self) -> Summary:
        condition = F.col(self.key) == F.lit(self.unknown)
        return Summary(self.name, condition, F.col(self.reference), F.lit(0))


@dataclass(frozen=True)
class VersionedTable(KeyedTable):
    """A keyed table published by version: see ``sources.versions``.

    An upsert writes the buckets it touches to a folder of their own, once, and a pointer then
    lets them take the place of the old ones. Readers see the version before or the one after.

    With each folder go ``summaries`` of its buckets, made in one pass over the columns they
    need of what was just written. A bucket is replaced together with its summary, so the table's
    is always that of its live buckets, whatever came, went or was deleted; no one has to read
    the table for it. ``waiting`` gives one such summary per rule: ``waiting_rows`` reads only
    buckets that hold rows to repair. With ``number`` set the table is that version, to be read
    only.
    """

    waiting: tuple[Waiting, ...] = ()
    summaries: tuple[Summary, ...] = ()
    number: int | None = None

    _SUMMARY = "name string, key string, least bigint, n bigint, bucket bigint"

    def at(self, number: int) -> VersionedTable:
        return replace(self, number=number)

    def version(self, spark: SparkSession) -> versions.Version | None:
        if self.number is not None:
            return versions.load(spark, self.path, self.number)
        return versions.current(spark, self.path)

    def _rows(self, spark: SparkSession) -> DataFrame:
        found = self.version(spark)
        parts = found.parts if found else ()
        return versions.read_parts(spark, self.path, self._stored, parts, BUCKET)

    def recover(self, spark: SparkSession) -> bool:
        """Nothing to finish: what no pointer names was never part of the table."""
        return False

    def _store(self, rows: DataFrame, touched: list[int] | None) -> None:
        if self.number is not None:
            raise ValueError("a given version can only be read")
        spark, before = rows.sparkSession, versions.current(rows.sparkSession, self.path)
        folder = versions.fresh_folder()
        with shuffles_dropped(spark):
            rows.write.options(**STORED).partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        names = children(spark, f"{self.path}/{folder}")
        written = tuple(
            sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{BUCKET}="))
        )
        part = versions.Part(folder, written, len(written))
        self._summarise(spark, part)
        parts = [part] if written else []
        if touched is not None and before is not None:
            gone = {*touched}
            left = (
                replace(p, buckets=tuple(b for b in p.buckets if b not in gone))
                for p in before.parts
            )
            parts = [p for p in left if p.buckets] + parts
        versions.publish(spark, self.path, self._stored, parts, before.number if before else 0)

    def _summarise(self, spark: SparkSession, part: versions.Part) -> None:
        rules = [w.summary for w in self.waiting] + list(self.summaries)
        if not rules or not part.written:
            return
        rows = versions.read_parts(spark, self.path, self._stored, [part], BUCKET)
        entries = F.array(
            *[
                F.when(
                    r.condition & r.key.isNotNull(),
                    F.struct(
                        F.lit(r.name).alias("name"),
                        r.key.cast("string").alias("key"),
                        r.value.cast("bigint").alias("value"),
                    ),
                )
                for r in rules
            ]
        )
        with shuffles_dropped(spark):
            (
                rows.select(BUCKET, F.inline(F.array_compact(entries)))
                .groupBy("name", "key", BUCKET)
                .agg(F.min("value").alias("least"), F.count(F.lit(1)).alias("n"))
                .select("name", "key", "least", "n", BUCKET)
                .write.options(**STORED)
                .parquet(f"{self.path}/_summary/{part.folder}")
            )

    def summary(self, spark: SparkSession, name: str) -> DataFrame:
        """key, least, n and bucket of the live buckets; keys are text."""
        found = self.version(spark)
        parts = [p for p in found.parts if p.buckets] if found else []
        if not parts:
            return spark.createDataFrame([], self._SUMMARY).drop("name")
        base = f"{self.path}/_summary"
        rows = (
            spark.read.schema(self._SUMMARY)
            .option("basePath", base)
            .parquet(*[f"{base}/{p.folder}" for p in parts])
            .where(F.col("name") == name)
            .withColumn("_folder", F.concat(F.lit("_gen="), F.col("_gen")))
        )
        columns = ["key", "least", "n", BUCKET]
        whole = rows.where(
            F.col("_folder").isin([p.folder for p in parts if len(p.buckets) == p.written])
        )
        # One pair per bucket, of the folders that newer ones have replaced in part.
        pairs = [(p.folder, b) for p in parts if len(p.buckets) < p.written for b in p.buckets]
        some = spark.createDataFrame(pairs, f"_folder string, {BUCKET} bigint")
        partly = rows.join(F.broadcast(some), ["_folder", BUCKET])
        return whole.select(*columns).unionByName(partly.select(*columns))

    def forget(self, spark: SparkSession, below: str) -> None:
        """Drop the marks of deleted rows up to a position below which no event can arrive.

        They only guard against older events. With soft deletes they are rows of the table and
        stay. The buckets that hold some are found in a scan of two columns, and rewritten.
        """
        if self.delete_mode != "hard":
            return
        old = self._gone & (F.col(self.order_cols[0]) <= F.lit(below))
        rows = self._rows(spark)
        sizes = dict(
            tuple(r)
            for r in rows.groupBy(BUCKET).agg(F.count(F.lit(1)), F.count_if(old).alias("_old"))
            .where("_old > 0").drop("_old").collect()
        )
        if sizes:
            kept = rows.where(F.col(BUCKET).isin([*sizes]) & ~old)
            self._store(self._clustered(kept, sizes).drop("_part"), [*sizes])

    def waiting_rows(
        self, spark: SparkSession, name: str, references: DataFrame
    ) -> DataFrame | None:
        """The rows that wait for one of ``references`` (and others of their buckets that wait).

        None if there are none. ``references`` has one column. What reaches the driver is one number per bucket.
        """
        rule = next(w for w in self.waiting if w.name == name)
        known = references.toDF("key").select(F.col("key").cast("string")).distinct()
        index = self.summary(spark, name).select("key", BUCKET)
        found = lookup_join(index, known, ["key"], "left_semi").select(BUCKET).distinct()
        buckets = [r[0] for r in found.collect()]
        if not buckets:
            return None
        rows = self.read(spark).where(F.col(BUCKET).isin(buckets))
        return rows.where(F.col(rule.key) == F.lit(rule.unknown)).drop(BUCKET)


def repair_keys(
    fact: DataFrame,
    dim: DataFrame,
    business_key: str,
    key: str,
    unknown: int = UNKNOWN_KEY,
) -> DataFrame:
    """Give facts on the unknown member their key once the dimension knows it.

    Only facts that carry the unknown key are joined, on their ``business_key``; all others
    pass through. ``business_key`` is unique in ``dim``.
    """
    settled = fact.where(F.col(key).isNull() | (F.col(key) != unknown))
    known = dim.where(F.col(business_key).isNotNull() & (F.col(key) != unknown)).select(
        business_key, F.col(key).alias("_found")
    )
    pending = lookup_join(fact.where(F.col(key) == unknown), known, [business_key], "left")
    repaired = pending.withColumn(key, F.coalesce("_found", key)).drop("_found")
    return settled.unionByName(repaired.select(*fact.columns))
