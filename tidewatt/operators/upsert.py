"""Keyed writes, as functions of (target, source) that return the new table, and a writer that
swaps it in. Parquet tables have no MERGE; the new table is planned as joins instead.

Sources may repeat a key: the last row by ``sequence`` counts. Keys are compared with ``=``, so a
null key never matches and is appended each time, as with a unique index.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_of(source: DataFrame, keys: list[str], sequence: str | None) -> DataFrame:
    """One row for each key. Rows with a null key all stay."""
    if sequence is None:
        return source
    whole = F.struct(*source.columns)
    anyNull = None
    for k in keys:
        anyNull = F.col(k).isNull() if anyNull is None else anyNull | F.col(k).isNull()
    picked = source.where(~anyNull).groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(F.max_by(whole, sequence).alias("_row")).select("_row.*")
    return picked.unionByName(source.where(anyNull))


def merge(target: DataFrame, source: DataFrame, keys: list[str], sequence: str | None = None) -> DataFrame:
    """Source rows replace target rows of the same key and are added otherwise."""
    new = last_of(source, keys, sequence).select(*target.columns)
    return target.join(new, keys, "left_anti").select(*target.columns).unionByName(new)


def differs(columns: list[str], a: str = "a", b: str = "b") -> Column:
    """Whether any column is distinct; null equals null."""
    return ~F.struct(*[F.col(f"{a}.{c}") for c in columns]).eqNullSafe(F.struct(*[F.col(f"{b}.{c}") for c in columns]))


def merge_changed(target: DataFrame, source: DataFrame, keys: list[str], columns: list[str], stamp: dict[str, Column], sequence: str | None = None) -> DataFrame:
    """As :func:`merge`, but a row whose columns stay the same is left as it is; changed and new
    rows get the stamps. Adds change: same, updated or inserted."""
    new = last_of(source, keys, sequence)
    a, b = target.alias("a"), new.alias("b")
    on = None
    for k in keys:
        on = (F.col(f"a.{k}") == F.col(f"b.{k}")) if on is None else on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    joined = a.withColumn("_t", F.lit(True)).alias("a").join(b.withColumn("_s", F.lit(True)).alias("b"), on, "full_outer")
    change = F.when(F.col("a._t").isNull(), "inserted").when(F.col("b._s").isNull(), "same").when(differs(columns), "updated").otherwise("same")
    joined = joined.withColumn("change", change)
    take = lambda c: F.when(F.col("change") == "same", F.col(f"a.{c}")).otherwise(stamp[c] if c in stamp else F.col(f"b.{c}"))
    return joined.select(*[take(c).alias(c) for c in target.columns], "change")


def insert_absent(target: DataFrame, source: DataFrame, keys: list[str], sequence: str | None = None) -> DataFrame:
    new = last_of(source, keys, sequence).join(target.select(*keys), keys, "left_anti")
    return target.unionByName(new.select(*target.columns))


def replace_range(target: DataFrame, source: DataFrame, column: str, low: Column, high: Column) -> DataFrame:
    """Target rows of [low, high) go; the source comes in."""
    outside = (F.col(column) < low) | (F.col(column) >= high) | F.col(column).isNull()
    return target.where(outside).unionByName(source.select(*target.columns))


def append_newer(target: DataFrame, source: DataFrame, column: str, default: Column, back: Column | None = None) -> DataFrame:
    """Source rows past the target's high-water mark, less ``back``, are added. The mark is one row."""
    mark = target.agg(F.coalesce(F.max(column), default).alias("_mark"))
    limit = F.col("_mark") if back is None else F.col("_mark") - back
    new = source.crossJoin(F.broadcast(mark)).where(F.col(column) > limit).select(*target.columns)
    return target.unionByName(new)


def append_lookback(target: DataFrame, source: DataFrame, column: str, keys: list[str], days: int = 90, default: str = "1970-01-01") -> DataFrame:
    """Source rows from so many days before the target's high-water mark on are added where their
    key is absent. The source's other columns, such as an id, are left behind."""
    low = F.coalesce(F.max(column) - F.make_dt_interval(F.lit(days)), F.lit(default).cast(target.schema[column].dataType))
    mark = target.agg(low.alias("_mark"))
    recent = source.crossJoin(F.broadcast(mark)).where(F.col(column) >= F.col("_mark"))
    return insert_absent(target, recent.select(*target.columns), keys)


def sync(registry: dict[str, tuple[str, list[str]]], targets: dict[str, DataFrame], sources: dict[str, DataFrame], days: int = 90) -> dict[str, DataFrame]:
    """append_lookback for each table of the registry (time column, keys) that has a source."""
    return {n: append_lookback(targets[n], sources[n], at, keys, days) for n, (at, keys) in registry.items() if n in sources and n in targets}


def partitions_of(df: DataFrame, partition: list[str], most: int = 100_000) -> list[tuple]:
    """The values of the partition columns that rows have; a table has far fewer partitions than
    ``most``, beyond which this raises."""
    found = df.select(*partition).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} partitions are touched: write the table as a whole")
    return [tuple(r) for r in found]


def in_partitions(df: DataFrame, partition: list[str], values: list[tuple]) -> DataFrame:
    """The rows of those partitions: filters on each column, which prune files, and where several
    columns go together a semi-join with the values, whose number :func:`partitions_of` bounds."""
    for i, name in enumerate(partition):
        inside = F.col(name).isin(sorted({v[i] for v in values if v[i] is not None}))
        df = df.where(inside | F.col(name).isNull() if any(v[i] is None for v in values) else inside)
    if len(partition) == 1 or not values:
        return df
    wanted = df.sparkSession.createDataFrame(values, df.select(*[F.col(c).alias(f"_{c}") for c in partition]).schema)
    on = None
    for name in partition:
        same = F.col(name).eqNullSafe(F.col(f"_{name}"))
        on = same if on is None else on & same
    return df.join(F.broadcast(wanted), on, "left_semi")


def rewrite_partitions(path: str, source: DataFrame, partition: list[str], plan: Callable[[DataFrame, DataFrame], DataFrame], also: list[tuple] = []) -> list[tuple]:
    """plan(target, source) replaces the partitions of the Parquet table at path that the source
    touches, and those in ``also``; other partitions are neither read nor written. plan must leave
    rows in their partitions. Returns the touched partitions.

    The new files are staged and moved in when all are written, by dynamic partition overwrite, so a
    run that fails before leaves the table as it was, and one that fails between partitions can be
    run again if the plan gives the same when applied twice, as merges do. Partitions that lose all
    rows are deleted last."""
    spark = source.sparkSession
    touched = sorted({*partitions_of(source, partition), *also}, key=repr)
    if not touched:
        return []
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(root):
        target = spark.read.schema(source.schema).parquet(path)
        target = in_partitions(target.select(*source.columns), partition, touched)
    else:
        target = source.limit(0)
    new = plan(target, source).select(*source.columns)
    new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)
    spark.catalog.refreshByPath(path)
    if also:
        there = {*partitions_of(source, partition)}
        left = [v for v in touched if v not in there]
        held = {*partitions_of(in_partitions(new, partition, left), partition)} if left else set()
        for value in [v for v in left if v not in held]:
            where = spark.createDataFrame([value], source.select(*partition).schema).select(*[F.coalesce(F.col(c).cast("string"), F.lit("__HIVE_DEFAULT_PARTITION__")).alias(c) for c in partition]).first()
            fs.delete(jvm.org.apache.hadoop.fs.Path("/".join([path, *[f"{c}={where[c]}" for c in partition]])), True)
        spark.catalog.refreshByPath(path)
    return touched


def merge_partitions(path: str, source: DataFrame, keys: list[str], partition: list[str], sequence: str | None = None) -> list[tuple]:
    """:func:`merge` into the partitioned table at path, on the touched partitions only. The
    partition columns belong to the key: a key never moves between partitions."""
    if not set(partition) <= set(keys):
        raise ValueError("merge_partitions: the partition columns must be part of the key")
    return rewrite_partitions(path, source, partition, lambda target, new: merge(target, new, keys, sequence))


def merge_changed_partitions(path: str, source: DataFrame, keys: list[str], columns: list[str], stamp: dict[str, Column], partition: list[str], sequence: str | None = None) -> list[tuple]:
    """:func:`merge_changed` likewise; partitions where nothing changed are left alone, too."""
    if not set(partition) <= set(keys):
        raise ValueError("merge_changed_partitions: the partition columns must be part of the key")
    spark = source.sparkSession
    new = last_of(source, keys, sequence)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    if root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        touched = partitions_of(new, partition)
        target = in_partitions(spark.read.schema(source.schema).parquet(path).select(*source.columns), partition, touched)
        changed = merge_changed(target, new, keys, columns, stamp).where("change <> 'same'").select(*source.columns)
    else:
        changed = new.withColumns(stamp).select(*source.columns)
    return rewrite_partitions(path, changed, partition, lambda old, rows: merge(old, rows, keys))


def replace_days_partitioned(path: str, source: DataFrame, day: str, first: date, last: date) -> list[tuple]:
    """The days from first to last of a table partitioned by day go, and the source, of those days, comes in."""
    days = [(first + timedelta(days=i),) for i in range((last - first).days + 1)]
    inside = source.where(F.col(day).between(F.lit(first), F.lit(last)))
    return rewrite_partitions(path, inside, [day], lambda target, new: new, days)


def audit_rows(df: DataFrame, payload: list[str], body: list[str], at: Column) -> DataFrame:
    """Rows for a log: the other columns, payload and response_body as JSON, and the time. A body
    whose columns are all null is null."""
    answered = None
    for c in body:
        answered = F.col(c).isNotNull() if answered is None else answered | F.col(c).isNotNull()
    rest = [c for c in df.columns if c not in {*payload, *body}]
    return df.select(*rest, F.to_json(F.struct(*payload)).alias("payload"), F.when(answered, F.to_json(F.struct(*body))).alias("response_body"), at.alias("created_at"))


def delete_without(target: DataFrame, complete: DataFrame, keys: list[str]) -> DataFrame:
    """Only rows whose keys are complete stay."""
    return target.join(complete.select(*keys).distinct(), keys, "left_semi")


def swap_in(df: DataFrame, path: str) -> None:
    """Writes beside the table, then renames twice through the path's own file system. Between the
    renames readers can find no table; otherwise they see the old or the new one. Works where df
    reads from the path itself."""
    spark = df.sparkSession
    jvm = spark._jvm
    to = jvm.org.apache.hadoop.fs.Path(path)
    fs = to.getFileSystem(spark._jsc.hadoopConfiguration())
    staging, old = (jvm.org.apache.hadoop.fs.Path(f"{path}__{x}") for x in ("staging", "old"))
    df.write.mode("overwrite").parquet(f"{path}__staging")
    fs.delete(old, True)
    if fs.exists(to):
        fs.rename(to, old)
    fs.rename(staging, to)
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)
