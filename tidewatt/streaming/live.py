"""Structured Streaming forms of the batch operators.

Keyed state is held by ``transformWithState``; its timers, in event time, end what can't change any
more. They need the RocksDB state store, which :func:`stateful` sets for the session.
"""

from __future__ import annotations

from collections.abc import Iterator
from operator import itemgetter

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidewatt.operators import upsert

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def stateful(spark: SparkSession) -> None:
    """Sets the state store that keyed state and timers need."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def tumbling(stream: DataFrame, ts: str, value: str, keys: list[str], minutes: int = 15, late: str = "3 hours") -> DataFrame:
    """keys, start, value_mean, value_min, value_max, rows of closed buckets. Data later than the
    watermark are left to a batch recomputation."""
    rows = stream.withWatermark(ts, late)
    out = rows.groupBy(*keys, F.window(ts, f"{minutes} minutes").alias("_w")).agg(F.avg(value).alias("value_mean"), F.min(value).alias("value_min"), F.max(value).alias("value_max"), F.count("*").alias("rows"))
    return out.select(*keys, F.col("_w.start").alias("start"), "value_mean", "value_min", "value_max", "rows")


def first_of(stream: DataFrame, keys: list[str], ts: str, late: str = "3 hours") -> DataFrame:
    """The first row of each key within the watermark."""
    return stream.withWatermark(ts, late).dropDuplicatesWithinWatermark(keys)


_EPOCH = "timestamp_ntz '1970-01-01 00:00:00'"


def _with_mark(stream: DataFrame, ts: str, late: str) -> DataFrame:
    """The stream with times as microseconds, which state holds and compares alike in any zone, and
    _mark, its event time under a watermark."""
    made = {"timestamp": lambda c: F.unix_micros(c), "timestamp_ntz": lambda c: F.expr(f"timestampdiff(MICROSECOND, {_EPOCH}, `{c}`)")}
    columns = [made.get(f.dataType.typeName(), F.col)(f.name).alias(f.name) for f in stream.schema]
    return stream.withColumn("_mark", F.col(ts).cast("timestamp")).withWatermark("_mark", late).select(*columns, "_mark")


def _timed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Times again where the schema has them."""
    made = {"timestamp": lambda c: F.timestamp_micros(c), "timestamp_ntz": lambda c: F.expr(f"timestampadd(MICROSECOND, `{c}`, {_EPOCH})")}
    return df.withColumns({f.name: made[kind](f.name) for f in schema if (kind := f.dataType.typeName()) in made})


class Supersession(StatefulProcessor):
    """Keeps the newest version of a key and hands on each version that supersedes another. order:
    (column, descending); nulls come last. until: a column with the instant after which, once the
    watermark passes it by ``keep``, no version of the key can come; its state is dropped."""

    def __init__(self, schema: T.StructType, order: list[tuple[str, bool]], until: str, keep_ms: int):
        self.schema, self.keep = schema, keep_ms
        names = schema.fieldNames()
        self.order, self.end = [(names.index(n), descending) for n, descending in order], names.index(until)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.best = handle.getValueState("best", self.schema)
        self.version, self.out = None, Row(*self.schema.fieldNames())

    def _before(self, a: tuple, b: tuple) -> bool:
        """Whether version a comes before b, so supersedes it."""
        for i, descending in self.order:
            x, y = a[i], b[i]
            if x == y:
                continue
            if x is None or y is None:
                return y is None
            return (x > y) == descending
        return False

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        # Each call to the state or its timers goes to the JVM and back, so only what is needed is asked for.
        held = self.best.get()
        held = best = None if held is None else tuple(held)
        for row in rows:
            if self.version is None:
                self.version = itemgetter(*[row.__fields__.index(n) for n in self.schema.fieldNames()])
            version = self.version(row)
            if best is None or self._before(version, best):
                best = version
        if best != held:
            self.best.update(best)
            end = best[self.end]
            # An earlier version's timer stays, and finds a later end when it goes off.
            if end is not None and (held is None or end != held[self.end]):
                self.handle.registerTimer(max(end // 1000 + self.keep, timerValues.getCurrentWatermarkInMs() + 1))
            yield self.out(*best)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        held = self.best.get()
        end = None if held is None else held[self.end]
        if end is not None and end // 1000 + self.keep <= expiredTimerInfo.getExpiryTimeInMs():
            self.best.clear()
        return iter([])

    def close(self) -> None:
        pass


def superseding(stream: DataFrame, keys: list[str], order: list[tuple[str, bool]], ts: str, until: str, late: str = "14 days", keep: str = "0 days") -> DataFrame:
    """Every version that supersedes what was known of its key, cancellations too; the last one
    that comes out is what intervals.latest gives for all rows, in whatever order they arrive.
    Versions of a key whose state was dropped start anew: give ``late`` and ``keep`` accordingly."""
    stateful(stream.sparkSession)
    days, unit = keep.split()
    if not unit.startswith("day"):
        raise ValueError("superseding: keep is a number of days")
    rows = _with_mark(stream, ts, late)
    schema = T.StructType([f for f in rows.schema if f.name != "_mark"])
    out = rows.groupBy(*keys).transformWithState(Supersession(schema, order, until, int(days) * 86_400_000), schema, "Update", "EventTime")
    return _timed(out, stream.schema)


class Gate(StatefulProcessor):
    """Collects the parts of an hour, hands on its row when the last one is there, and drops what is
    incomplete when the watermark has passed the hour's end."""

    def __init__(self, keys: T.StructType, part: str, values: list[str], whole: int):
        self.keys, self.part, self.values, self.whole = keys, part, values, whole

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        part = T.StructType([T.StructField("part", T.StringType())])
        self.parts = handle.getMapState("parts", part, T.StructType([T.StructField(v, T.DoubleType()) for v in self.values]))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        end, changed = None, False
        for row in rows:
            end, value = row["_end"] // 1000, tuple(row[v] for v in self.values)
            part = (row[self.part],)
            if not self.parts.containsKey(part) or tuple(self.parts.getValue(part)) != value:
                self.parts.updateValue(part, value)
                changed = True
        if not any(True for _ in self.handle.listTimers()):
            self.handle.registerTimer(max(end, timerValues.getCurrentWatermarkInMs() + 1))
        held = sorted((p[0], tuple(v)) for p, v in self.parts.iterator()) if changed else []
        if len(held) == self.whole:
            for name, value in held:
                yield Row(**dict(zip(self.keys.fieldNames(), key)), part=name, **dict(zip(self.values, value)))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.parts.clear()
        return iter([])

    def close(self) -> None:
        pass


def gated_hours(stream: DataFrame, keys: list[str], start: str, values: list[str], late: str, part: str = "time_interval", whole: int = 4) -> DataFrame:
    """Quarters (keys, start, part and double values) of the hours that have all of them, as soon as the
    last one arrives: keys, hour_start, part and values, ``whole`` rows an hour. A quarter that comes again
    with other values, before the watermark has passed the hour, hands the hour on again; hours that
    are incomplete then never come out. Rows later than the watermark are dropped."""
    stateful(stream.sparkSession)
    hours = stream.withColumn("hour_start", F.date_trunc("hour", start)).withColumn("_end", F.col("hour_start") + F.expr("interval 1 hour"))
    rows = _with_mark(hours, start, late)
    by = [*keys, "hour_start"]
    schema = T.StructType([rows.schema[k] for k in by])
    out = T.StructType([*schema.fields, T.StructField("part", T.StringType()), *[T.StructField(v, T.DoubleType()) for v in values]])
    found = rows.groupBy(*by).transformWithState(Gate(schema, part, values, whole), out, "Update", "EventTime")
    return _timed(found, T.StructType([hours.schema[k] for k in by])).withColumnRenamed("part", part)


def emptied(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Runs the stream over all that is there, each batch as a part of the Parquet table at path, and reads the
    table, with batch, the number of the part. A batch that is run again replaces its part."""

    def into(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    query = stream.writeStream.outputMode("update").foreachBatch(into).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    spark = stream.sparkSession
    return spark.read.schema(T.StructType([*stream.schema.fields, T.StructField("batch", T.LongType())])).option("basePath", path).parquet(path)


def replayed(df: DataFrame, path: str, files: int, order: Column, at_once: int = 1, parts: int = 1) -> DataFrame:
    """A stream of df's rows from so many files at path, dealt out by the order's hash; each batch
    takes at_once of them. With parts each file is that many, which are written and read side by side."""
    number = F.pmod(F.xxhash64(order), F.lit(files * parts)).cast("int")
    df.repartitionById(files * parts, number).write.parquet(path)
    return df.sparkSession.readStream.schema(df.schema).option("maxFilesPerTrigger", at_once * parts).parquet(path)


def upserting(stream: DataFrame, path: str, keys: list[str], sequence: str, checkpoint: str, partition: list[str] | None = None, **options: str) -> StreamingQuery:
    """Each micro-batch is merged into the Parquet table at path; with partition columns, which are
    part of the key, only the partitions it touches are read and written. A batch that is run again
    gives the same table."""

    def into(batch: DataFrame, _: int) -> None:
        if partition:
            upsert.merge_partitions(path, batch, keys, partition, sequence)
            return
        spark = batch.sparkSession
        try:
            target = spark.read.parquet(path)
        except Exception as e:  # a table that is not there yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
            target = batch.limit(0)
        upsert.swap_in(upsert.merge(target, batch.select(*target.columns), keys, sequence), path)

    writer = stream.writeStream.foreachBatch(into).option("checkpointLocation", checkpoint).options(**options)
    return writer.trigger(availableNow=True).start()
