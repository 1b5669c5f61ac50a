"""Output layout: file plans, partition replacement, size reports."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trackmetrics.session import TASK_BYTES

FILE_BYTES = 256 * 2**20


def files_for(n: Column, row_bytes: float, target_bytes: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n * F.lit(row_bytes) / F.lit(target_bytes))).cast("int")


def file_plan(df: DataFrame, partitions: Sequence[str], row_bytes: float, target_bytes: int = FILE_BYTES) -> DataFrame:
    """Number of files of each partition, from its row count: one row per partition value."""
    sizes = df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("n"))
    return sizes.select(*partitions, files_for(F.col("n").cast("double"), row_bytes, target_bytes).alias("files"))


def write_planned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str],
    spread: Sequence[str],
    row_bytes: float,
    target_bytes: int = FILE_BYTES,
    rows_per_file: int = 0,
) -> int:
    """Write a partitioned table with as many files per partition as its volume asks for.

    A hot partition is cut in buckets by a hash of ``spread``; partitions present
    in ``df`` are replaced, all others stay.  A bucket is a file, or a task's share of small files, cut by
    rows: what tasks report to the driver follows the bytes and not the files.  Returns the number of planned files.
    """
    per_task = max(1, TASK_BYTES // target_bytes)
    sizes = df.groupBy(*partitions).agg(F.count(F.lit(1)).alias("__n"))
    files = files_for(F.col("__n").cast("double"), row_bytes, target_bytes)
    plan = sizes.withColumn("__files", files).withColumn("__buckets", F.ceil(F.col("__files") / per_task).cast("int"))
    # The last file of each bucket may be short, so all but one of the buckets have a file less to fill.
    rows = F.ceil(F.col("__n") / (F.col("__files") - F.col("__buckets") + 1))
    total, tasks, longest = plan.agg(*[F.coalesce(x, F.lit(1)) for x in (F.sum("__files"), F.sum("__buckets"), F.max(rows))]).first()  # three numbers
    # One plan row per partition value (days or months): the calendar bounds the broadcast.
    buckets = plan.select(*partitions, "__buckets")
    placed = df.join(F.broadcast(buckets), list(partitions)).withColumn("__bucket", F.pmod(F.xxhash64(*spread), F.col("__buckets")))
    shuffled = placed.repartition(int(tasks), *partitions, "__bucket").drop("__buckets", "__bucket")
    writer = shuffled.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    limits = [x for x in (rows_per_file, int(longest) if per_task > 1 else 0) if x]
    if limits:
        writer = writer.option("maxRecordsPerFile", min(limits))
    writer.parquet(path)
    return int(total)


def write_rebalanced(df: DataFrame, path: str, partitions: Sequence[str]) -> None:
    """Write a partitioned table in one pass, files sized by adaptive execution.

    ``rebalance`` splits a hot partition and joins small ones towards
    ``spark.sql.adaptive.advisoryPartitionSizeInBytes``, without a plan computed
    beforehand.  Partitions present in ``df`` are replaced, all others stay.
    """
    balanced = df.hint("rebalance", *[F.col(p) for p in partitions])
    balanced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def shuffle_width(n: Column, row_bytes: int = 80, target_bytes: int = 128 * 2**20, floor: int = 48) -> Column:
    """Shuffle partitions for ``n`` rows; an option for sessions without adaptive sizing."""
    return F.greatest(F.lit(floor), F.ceil(n * F.lit(float(row_bytes)) / F.lit(target_bytes))).cast("int")


def sorted_export(df: DataFrame, path: str, order: Sequence[Column]) -> None:
    """Empty the folder and write globally sorted files, in file-name order.

    The range partitioning of ``orderBy`` is joined by adaptive execution, so a
    small report ends up in one file and a large one never passes through one task.
    """
    df.orderBy(*order).write.mode("overwrite").parquet(path)


def full_reload(tables: dict[str, DataFrame], base: str) -> DataFrame:
    """Overwrite every table, then count what was written; ``ok`` is 0 for an empty table."""
    counted = []
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{base}/{name}")
        stored = df.sparkSession.read.schema(df.schema).parquet(f"{base}/{name}")
        n = F.count(F.lit(1))
        counted.append(stored.agg(F.lit(name).alias("loaded"), n.alias("n"), (n > 0).cast("int").alias("ok")))
    out = counted[0]
    for part in counted[1:]:
        out = out.unionByName(part)
    return out


def has_partitions(spark: SparkSession, path: str) -> bool:
    """Whether a folder holds partition folders, asked of the file system that serves its path."""
    inside = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/*=*")
    found = inside.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(inside)
    return found is not None and len(found) > 0


def partition_paths(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Partition folders of a table with ``depth`` partition columns, as paths below it; no file is opened."""
    base = path.rstrip("/")
    inside = spark._jvm.org.apache.hadoop.fs.Path("/".join([base, *["*=*"] * depth]))
    found = inside.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(inside) or []
    return ["/".join(f.getPath().toUri().getPath().split("/")[-depth:]) for f in found]


def delete_folders(spark: SparkSession, paths: Sequence[str]) -> int:
    """Delete partition folders with their files; returns how many existed."""
    gone = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        gone += bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True))
    return gone


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def publish(spark: SparkSession, staging: str, target: str, filled: Sequence[str], stale: Sequence[str] = ()) -> None:
    """Move checked partitions from a staging folder into a table by rename, and delete the stale ones.

    ``filled`` and ``stale`` are partition paths below both folders.  A marker that names every move is written first and deleted
    last: a publication that was stopped is finished by ``resume_publication``, and one that never began has changed nothing.
    The moves are driver calls, one per partition of a batch, which the calendar bounds; no data passes the driver.
    """
    text = json.dumps({"staging": staging, "filled": sorted(filled), "stale": sorted(stale)})
    marker, fs = _file_system(spark, f"{target.rstrip('/')}/{_MARKER}")
    # Written aside and renamed, so that a marker is whole or absent.
    part, _ = _file_system(spark, f"{target.rstrip('/')}/{_MARKER}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    if not fs.rename(part, marker):
        raise OSError(f"another publication to {target} has not ended")
    resume_publication(spark, target)


#: Folders and files whose names begin with an underscore are not read as data.
_MARKER = "_publication.json"
STAGING = "_staging"


def resume_publication(spark: SparkSession, target: str) -> bool:
    """Finish a publication that was stopped; whether there was one.  Every step may be repeated."""
    marker, fs = _file_system(spark, f"{target.rstrip('/')}/{_MARKER}")
    if not fs.exists(marker):
        return False
    stream = fs.open(marker)
    moves = json.loads(bytes(stream.readAllBytes()))
    stream.close()
    for name in moves["filled"]:
        staged, _ = _file_system(spark, f"{moves['staging']}/{name}")
        if fs.exists(staged):  # else it was moved before the stop
            place, _ = _file_system(spark, f"{target.rstrip('/')}/{name}")
            fs.delete(place, True)
            fs.mkdirs(place.getParent())
            if not fs.rename(staged, place):
                raise OSError(f"could not publish {name}")
    delete_folders(spark, [f"{target.rstrip('/')}/{name}" for name in moves["stale"]] + [moves["staging"]])
    fs.delete(marker, False)
    return True


def partition_folder(base: str, **values: str) -> str:
    """Path of one partition, values written as the Parquet writer escapes them."""
    escape = lambda v: "".join(c if c.isalnum() or c in "_-. " else f"%{ord(c):02X}" for c in v)
    return "/".join([base.rstrip("/"), *[f"{k}={escape(str(v))}" for k, v in values.items()]])


def read_partitioned(spark: SparkSession, path: str) -> DataFrame:
    """Read with partition values kept as text (``2026-09``, ``_ancien``), whatever the session infers."""
    conf = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(conf)
    spark.conf.set(conf, "false")
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(conf, before)


def file_report(df: DataFrame, partition_pattern: str = "") -> DataFrame:
    """Files, bytes, bytes per row and extreme file sizes of a file-backed table, per partition.

    Uses the file metadata columns of the scan, so no driver lists files.
    """
    part = F.regexp_extract("f.file_path", partition_pattern, 1) if partition_pattern else F.lit("")
    files = df.select(F.col("_metadata").alias("f")).groupBy("f.file_path", "f.file_size", part.alias("part")).agg(
        F.count(F.lit(1)).alias("n")
    )
    return files.groupBy("part").agg(
        F.count(F.lit(1)).alias("files"), F.sum("n").alias("n_rows"), F.sum("file_size").alias("bytes"),
        F.round(F.sum("file_size") / F.sum("n"), 2).alias("bytes_per_row"),
        F.min("file_size").alias("smallest"), F.max("file_size").alias("largest"),
    )


def files_beyond_plan(report: DataFrame, plan: DataFrame, partition: str) -> DataFrame:
    """Partitions that hold more files than planned."""
    joined = report.join(plan.withColumnRenamed("files", "planned"), report["part"] == plan[partition])
    return joined.where(F.col("files") > F.col("planned")).select("part", "files", "planned")


def order_probe(df: DataFrame, key: str) -> DataFrame:
    """Spread of a sort key inside each stored file: how well row groups can be skipped."""
    return df.groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min(key).alias("lowest"), F.max(key).alias("highest")
    )


def slices(volumes: DataFrame, lot: str, n: str, target: int) -> DataFrame:
    """Greedy packing of consecutive lots: a slice closes when the next lot would pass the target.

    Greedy packing is sequential, so the ordered series is folded in one array;
    it holds one entry per calendar month.
    """
    ordered = volumes.agg(F.sort_array(F.collect_list(F.struct(F.col(lot).alias("lot"), F.col(n).cast("long").alias("n")))).alias("s"))
    start = F.struct(
        F.lit(0).alias("no"), F.lit(0).cast("long").alias("sum"),
        F.array().cast("array<struct<no:int,lot:string,n:bigint>>").alias("out"),
    )

    def step(acc: Column, x: Column) -> Column:
        opens = (acc["no"] == 0) | (acc["sum"] + x["n"] > target)
        no = F.when(opens, acc["no"] + 1).otherwise(acc["no"])
        total = F.when(opens, x["n"]).otherwise(acc["sum"] + x["n"])
        entry = F.struct(no.alias("no"), x["lot"].alias("lot"), x["n"].alias("n"))
        return F.struct(no.alias("no"), total.alias("sum"), F.concat(acc["out"], F.array(entry)).alias("out"))

    folded = ordered.select(F.inline(F.aggregate("s", start, step)["out"]))
    return folded.groupBy("no").agg(
        F.min("lot").alias("first"), F.max("lot").alias("last"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("lots")
    )


def path_audit(paths: DataFrame, column: str, rules: dict[str, str]) -> DataFrame:
    """Class of each stored path: the first rule whose pattern matches and whose date is real, else ``REFUSE``.

    A pattern captures ``yyyy-MM-dd`` or ``yyyy-MM``.
    """
    found = F.lit(None).cast("string")
    for name, pattern in reversed(list(rules.items())):
        text = F.regexp_extract(column, pattern, 1)
        real = F.try_to_date(F.when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text), "yyyy-MM-dd").isNotNull()
        found = F.when(F.col(column).rlike(pattern) & real, F.lit(name)).otherwise(found)
    return paths.select(column, F.coalesce(found, F.lit("REFUSE")).alias("class"))
