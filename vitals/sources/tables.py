"""Tables of measurements, errors and aggregates: layout, writes, upserts, compaction, sizes, evolution, drift."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RAW_PARTITIONS = ["start_day", "data_type"]
ERROR_PARTITIONS = ["error_day", "error_type"]
AGGREGATE_PARTITIONS = ["data_type", "year"]
TARGET_BYTES = {"raw": 256 << 20, "errors": 128 << 20, "daily": 128 << 20, "weekly": 128 << 20, "monthly": 128 << 20}
WIDENINGS = {("int", "bigint"), ("float", "double"), ("date", "timestamp")}


def transforms(df: DataFrame, ts: str = "start_ts", user: str = "user_id", buckets: int = 16) -> DataFrame:
    """Derived partition columns: day, hour and user bucket."""
    return df.withColumns({"day": F.to_date(ts), "hour": F.date_trunc("hour", F.col(ts)), "user_bucket": F.pmod(F.hash(user), F.lit(buckets))})


def required(df: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with all required columns, and the others."""
    missing = F.exists(F.array(*[F.col(c).isNull() for c in columns]), lambda x: x)
    return df.where(~missing), df.where(missing)


def write_partitioned(df: DataFrame, path: str, partitions: list[str], mode: str = "append", records_per_file: int = 0, cluster: list[str] | None = None) -> None:
    """Appends, or replaces only the partitions that ``df`` holds. Rows of a partition are gathered and large ones split by AQE before the write.

    With ``records_per_file`` a large partition is dealt to tasks in whole files, so at most one file of a partition is short.
    """
    out = dealt(df, partitions, records_per_file) if records_per_file else df.hint("rebalance", *partitions)
    if cluster:
        out = out.sortWithinPartitions(*partitions, *cluster)
    writer = out.write.mode(mode).partitionBy(*partitions).option("compression", "snappy").option("partitionOverwriteMode", "dynamic")
    (writer.option("maxRecordsPerFile", records_per_file) if records_per_file else writer).parquet(path)


#: Rows that ``dealt`` gives to a task at a time, about.
DEAL = 100_000


def dealt(df: DataFrame, partitions: list[str], records: int) -> DataFrame:
    """``df`` with each partition's rows in deals of whole files of ``records`` rows; the last deal holds the rest.

    Rows are numbered in the tasks that read them, behind the numbers of the tasks before, which a row for each task and
    partition gives. Should a task that is run again meet other rows, files differ in size and no row is lost.
    """
    deal = records * max(1, DEAL // records)
    rows = df.withColumns({"__task": F.spark_partition_id(), "__i": F.monotonically_increasing_id()})
    ahead = Window.partitionBy(*partitions).orderBy("__task").rowsBetween(Window.unboundedPreceding, -1)
    counts = rows.groupBy(*partitions, "__task").agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(ahead), F.lit(0))).drop("__n")
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"n.{c}")) for c in [*partitions, "__task"]]
    rows = rows.withColumn("__i", F.row_number().over(Window.partitionBy(*partitions, "__task").orderBy("__i")) - 1)
    numbered = rows.alias("r").join(F.broadcast(counts.alias("n")), same, "left").select("r.*", F.floor((F.col("__i") + F.coalesce("__before", F.lit(0))) / deal).alias("__deal"))
    return numbered.repartition(*partitions, "__deal").drop("__task", "__i", "__deal")


def write_raw(df: DataFrame, path: str, mode: str = "append") -> None:
    write_partitioned(df.withColumn("start_day", F.to_date(F.timestamp_millis("start_date"))), path, RAW_PARTITIONS, mode, cluster=["user_id"])


def write_errors(df: DataFrame, path: str, mode: str = "append", more: list[str] | None = None) -> None:
    write_partitioned(df.withColumn("error_day", F.to_date(F.timestamp_millis("error_timestamp"))), path, [*ERROR_PARTITIONS, *(more or [])], mode)


def write_aggregates(df: DataFrame, path: str, kind: str, mode: str = "append", records_per_file: int = 0) -> None:
    """Daily, weekly or monthly aggregates by type and year, in order of users, so that a reader of one user skips most of a file."""
    year = F.year("aggregation_date") if kind == "daily" else F.col("year")
    write_partitioned(df.withColumn("year", year), path, AGGREGATE_PARTITIONS, mode, records_per_file, ["user_id"])


def stored(spark: SparkSession, path: str) -> bool:
    """Whether something is stored under ``path``."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def newest(df: DataFrame, keys: list[str], version: str = "updated_at") -> DataFrame:
    """The newest row of each key, whole: an aggregate with partial sums, so a much updated key is no hot task.

    Of rows with one version the largest by their other columns stays (maps aside), so repeated runs agree.
    """
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(version, *[c for c, kind in df.dtypes if c in rest and "map<" not in kind])
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__row")).select(*keys, "__row.*").select(*df.columns)


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partitions: list[str], staging: str | None = None, version: str = "updated_at") -> None:
    """Replaces rows of the same key in the partitions that ``new`` touches.

    The merged partitions are written beside the old ones and take their places when all are there: a failed attempt leaves
    the table as it was and can be repeated. With ``staging`` they are written there first, and stay there.
    """
    merged = new
    if stored(spark, path):
        touched = new.select(*partitions).distinct()
        merged = spark.read.schema(new.schema).parquet(path).join(touched, partitions, "left_semi").unionByName(new)
    merged = newest(merged, keys, version)
    if staging:
        merged.write.mode("overwrite").parquet(staging)
        merged = spark.read.schema(new.schema).parquet(staging)
    write_partitioned(merged, path, partitions, "overwrite")


def create_tables(spark: SparkSession, database: str, tables: dict[str, tuple[str, list[str]]], location: str | None = None, properties: dict[str, dict[str, str]] | None = None) -> None:
    """Creates what is missing of ``tables``: name to (DDL of the columns, partition columns), under ``location`` or the warehouse.

    ``properties``: name to the table's properties; those of the file format hold for what is written to it by name.
    """
    text = lambda x: "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{location}'" if location else ""))
    for name, (columns, partitions) in tables.items():
        own = [(k, f"{text(k)} = {text(v)}") for k, v in (properties or {}).get(name, {}).items()]
        of_format = ", ".join(p for k, p in own if k.startswith("parquet."))  # what writers read
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{name} ({columns}) USING parquet" + (f" OPTIONS ({of_format})" if of_format else "") + f" PARTITIONED BY ({', '.join(partitions)})" + (f" TBLPROPERTIES ({', '.join(p for _, p in own)})" if own else ""))


def table_properties(spark: SparkSession, database: str, table: str) -> DataFrame:
    """(table_name, key, value) of the properties of a table."""
    return spark.sql(f"SHOW TBLPROPERTIES {database}.{table}").select(F.lit(table).alias("table_name"), "key", "value")


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {database}").where("not isTemporary").select(F.col("tableName").alias("table_name"))


def scan(spark: SparkSession, table: str, database: str, where=None, fields: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Rows of a table; a bare name is in ``database``; an unknown one is a LookupError."""
    name = table if "." in table else f"{database}.{table}"
    if not spark.catalog.tableExists(name):
        raise LookupError(f"unknown table {name}")
    df = spark.table(name)
    df = df if where is None else df.where(where)
    df = df.select(*fields) if fields else df
    return df if limit is None else df.limit(limit)


def file_sizes(df: DataFrame) -> DataFrame:
    """(n_files, bytes) of the files behind a table."""
    return df.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.count("*").alias("n_files"), F.sum("file_size").alias("bytes"))


def partition_sizes(df: DataFrame, partitions: list[str]) -> DataFrame:
    """(partitions, n_files, bytes) of a table's partitions, from its files' metadata."""
    files = df.select(*partitions, "_metadata.file_path", "_metadata.file_size").distinct()
    return files.groupBy(*partitions).agg(F.count("*").alias("n_files"), F.sum("file_size").alias("bytes"))


def compact(spark: SparkSession, path: str, partitions: list[str], staging: str, target: int) -> None:
    """Rewrites the partitions that have more files than their bytes need, in files of about ``target`` bytes, by way of ``staging``.

    A large partition is dealt to as many tasks as it gets files; partitions of a good size are left as they are.
    """
    df = spark.read.parquet(path)
    wanted = F.greatest(F.lit(1), F.ceil(F.col("bytes") / target)).cast("int")
    plan = partition_sizes(df, partitions).withColumn("__files", wanted).where("n_files > __files").select(*partitions, "__files").persist()
    try:
        files = plan.agg(F.sum("__files")).first()[0]
        if not files:
            return
        deal = F.pmod(F.xxhash64(*[F.col(f"d.{c}") for c, t in df.dtypes if not t.startswith("map")]), F.col("__files")).alias("__deal")
        same = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in partitions]
        rows = df.alias("d").join(plan.alias("p"), same).select("d.*", deal)
        rows.repartition(files, *partitions, "__deal").drop("__deal").write.mode("overwrite").parquet(staging)
    finally:
        plan.unpersist()
    spark.read.schema(df.schema).parquet(staging).write.mode("overwrite").partitionBy(*partitions).option("partitionOverwriteMode", "dynamic").parquet(path)


def records_for(df: DataFrame, target: int, sample: int = 1000) -> int:
    """Rows that about fill a file of ``target`` bytes, by the text size of some rows: for ``records_per_file``."""
    size = df.limit(sample).agg(F.avg(F.length(F.to_json(F.struct(*df.columns))))).first()[0]
    return max(1, int(target / size)) if size else 0


def records_stored(df: DataFrame, target: int) -> int:
    """The same for a table that is stored already: by the bytes and rows of all its files."""
    rows = df.count()
    size = file_sizes(df).first()["bytes"]
    return max(1, int(target * rows / size)) if rows and size else 0


def migrate(df: DataFrame, operations: list[tuple]) -> tuple[DataFrame, list[tuple[str, str]]]:
    """``df`` after add, drop, rename, widen and optional operations, and the history of them.

    ("add", name, type), ("drop", name), ("rename", name, new), ("widen", name, type), ("optional", name).
    """
    history = []
    for op, name, *rest in operations:
        there = name in df.columns
        if op == "add":
            if there:
                raise ValueError(f"{name} exists")
            df = df.withColumn(name, F.lit(None).cast(rest[0]))
        elif not there:
            raise ValueError(f"{name} does not exist")
        elif op == "drop":
            df = df.drop(name)
        elif op == "rename":
            if rest[0] in df.columns:
                raise ValueError(f"{rest[0]} exists")
            df = df.withColumnRenamed(name, rest[0])
        elif op == "widen":
            old = dict(df.dtypes)[name]
            if (old, rest[0]) not in WIDENINGS:
                raise ValueError(f"{old} can't become {rest[0]}")
            df = df.withColumn(name, F.col(name).cast(rest[0]))
        elif op == "optional":
            df = df.withColumn(name, F.when(F.lit(True), F.col(name)))
        else:
            raise ValueError(f"unknown operation {op}")
        history.append((op, " ".join([name, *rest])))
    return df, history


def fields(spark: SparkSession, schema: StructType, defaults: dict[str, str] | None = None) -> DataFrame:
    rows = [(f.name, f.dataType.simpleString(), f.nullable, (defaults or {}).get(f.name)) for f in schema]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean, default string")


def drift(old: DataFrame, new: DataFrame, mode: str = "BACKWARD") -> DataFrame:
    """(name, change, breaking) between two field tables (name, type, nullable, default).

    BACKWARD: new readers read old data; FORWARD: old readers read new data; FULL: both; NONE: nothing breaks.
    """
    rows = old.alias("o").join(new.alias("n"), F.col("o.name") == F.col("n.name"), "full_outer")
    widened = F.concat_ws(">", "o.type", "n.type").isin(*[f"{a}>{b}" for a, b in WIDENINGS])
    change = (
        F.when(F.col("o.name").isNull(), "added").when(F.col("n.name").isNull(), "removed").when(F.col("o.type") != F.col("n.type"), F.when(widened, "widened").otherwise("type_changed"))
        .when(~F.col("o.default").eqNullSafe(F.col("n.default")), "default_changed").otherwise("none")
    )
    need = lambda side: F.col(f"{side}.default").isNull() & ~F.col(f"{side}.nullable")
    backward = (change == "type_changed") | (change == "removed") | ((change == "added") & need("n"))
    forward = change.isin("type_changed", "widened") | ((change == "removed") & need("o"))
    breaking = {"BACKWARD": backward, "FORWARD": forward, "FULL": backward | forward, "NONE": F.lit(False)}[mode]
    return rows.select(F.coalesce("o.name", "n.name").alias("name"), change.alias("change"), F.coalesce(breaking, F.lit(False)).alias("breaking"))


def gate(report: DataFrame, allow_breaking: bool = False) -> None:
    """Stops on breaking changes unless they are allowed."""
    if not allow_breaking and not report.where("breaking").isEmpty():
        raise ValueError("breaking schema changes")


def write_bucketed(df: DataFrame, table: str, path: str, key: str = "user_id", buckets: int = 16, sort: list[str] | None = None) -> None:
    """Replaces ``table`` by one that is cut into ``buckets`` by ``key`` and sorted: joins and groups by the key need no exchange, and a reader of one key opens one bucket."""
    out = df.repartition(buckets, key)  # one file a bucket
    out.write.mode("overwrite").format("parquet").option("path", path).bucketBy(buckets, key).sortBy(key, *(sort or [])).saveAsTable(table)


class ChangedMeanwhile(RuntimeError):
    """Another writer has exchanged a partition since it was read."""


def _spec(names: list[str], values: tuple) -> str:
    return ", ".join(f"{n} = '{v}'" for n, v in zip(names, values, strict=True))


def _locations(spark: SparkSession, table: str, names: list[str], values: list[tuple]) -> dict[tuple, str | None]:
    """Where each partition lies by the catalog; None for those it doesn't have."""
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect()}
    out: dict[tuple, str | None] = {}
    for v in values:
        there = "/".join(f"{n}={x}" for n, x in zip(names, v, strict=True)) in known
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table} PARTITION ({_spec(names, v)})").collect() if there else []
        out[v] = next((r[1] for r in rows if r[0] == "Location"), None)
    return out


class Swap:
    """An upsert that readers can't see half of: merged partitions lie in new folders, and the catalog is told of them last.

    ``prepare`` writes the merged partitions that ``new`` touches beside the old ones; until ``exchange`` no reader meets
    them, so a failure in between leaves the old rows. ``exchange`` first looks whether each partition still lies where it
    was read, and raises ``ChangedMeanwhile`` if not. Each partition changes whole; a reader that started before keeps the
    old folders, which ``forget`` deletes. The driver handles a row for each touched partition; partition values
    must not be null.
    """

    def __init__(self, spark: SparkSession, table: str, root: str, keys: list[str], partitions: list[str], version: str = "updated_at") -> None:
        self.spark, self.table, self.root, self.keys, self.partitions, self.version = spark, table, root.rstrip("/"), keys, partitions, version
        self.before: dict[tuple, str | None] = {}
        self.made = ""

    def prepare(self, new: DataFrame) -> None:
        touched = new.select(*self.partitions).distinct()
        values = [tuple(str(x) for x in r) for r in touched.collect()]
        self.before = _locations(self.spark, self.table, self.partitions, values)
        self.spark.catalog.refreshTable(self.table)
        old = self.spark.table(self.table).select(*new.columns).join(touched, self.partitions, "left_semi")
        self.made = f"{self.root}/{uuid.uuid4().hex}"
        write_partitioned(newest(old.unionByName(new), self.keys, self.version), self.made, self.partitions, "overwrite")

    def exchange(self) -> None:
        if _locations(self.spark, self.table, self.partitions, list(self.before)) != self.before:
            raise ChangedMeanwhile(self.table)
        for values, place in self.before.items():
            folder = f"{self.made}/" + "/".join(f"{n}={v}" for n, v in zip(self.partitions, values, strict=True))
            if place is None:
                self.spark.sql(f"ALTER TABLE {self.table} ADD PARTITION ({_spec(self.partitions, values)}) LOCATION '{folder}'")
            else:
                self.spark.sql(f"ALTER TABLE {self.table} PARTITION ({_spec(self.partitions, values)}) SET LOCATION '{folder}'")
        self.spark.catalog.refreshTable(self.table)

    def forget(self) -> None:
        """Deletes the folders that the exchange replaced."""
        for place in filter(None, self.before.values()):
            hadoop = self.spark._jvm.org.apache.hadoop.fs.Path(place)
            hadoop.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(hadoop, True)
