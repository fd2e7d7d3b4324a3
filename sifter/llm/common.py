"""Shared helpers of the operators: table reads, lineage cuts and exact running sums."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sifter.session import checkpoint_root


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder in the cluster's shared checkpoint folder."""
    return checkpoint_root(spark, "llm", f"{name}-{uuid.uuid4().hex}")


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Cut lineage: write ``df`` as Parquet under the shared folder and read it back.

    Every executor sees the folder, so a lost executor costs a re-read and
    never the rows.  The schema is given on the read (no inference job).
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_table(spark: SparkSession, df: DataFrame) -> None:
    """Delete the files of a ``materialize``d table that no later plan reads."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def only(df: DataFrame, *names: str) -> DataFrame:
    """The operator's own columns; extra columns (clashing names included) are left behind."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def utf8(col: str | Column) -> Column:
    """Text as bytes, NULL as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c, F.lit("")).cast("binary")


def input_bytes(df: DataFrame) -> int:
    """Planner's size of the input files (file sizes; no job runs)."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size.toString()))


def shuffle_width(spark: SparkSession, rows: int | None = None, rows_per_task: int = 1_000_000) -> int:
    """Tasks for a dealt-out stage: the session's shuffle width, more when the rows ask for it."""
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(width, -(-rows // rows_per_task)) if rows else width


def part_offsets(ordered: DataFrame, value: str, part: str = "_part", out: str = "_offset") -> DataFrame:
    """Exclusive running sum of ``value`` over the partition numbers: one row per partition."""
    totals = ordered.groupBy(part).agg(F.sum(value).alias("_total"))
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    return totals.select(part, F.coalesce(F.sum("_total").over(before), F.lit(0)).cast("long").alias(out))


def running_sum(df: DataFrame, order: Sequence[Column | str], value: str, out: str, name: str) -> DataFrame:
    """Exclusive running sum of ``value`` over the whole table in ``order``, without one task seeing it all.

    The rows are range-dealt on ``order`` (give enough columns that one hot
    value can be split), each partition sums its own rows, and the few
    partition totals are added up.  The sorted rows are written once, so the
    partition borders are the same for both uses.
    """
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    ordered = materialize(
        df.repartitionByRange(shuffle_width(df.sparkSession), *cols).withColumn("_part", F.spark_partition_id()), name)
    local = Window.partitionBy("_part").orderBy(*cols).rowsBetween(Window.unboundedPreceding, -1)
    # one row per range partition: as many as the shuffle has tasks
    offsets = F.broadcast(part_offsets(ordered, value))
    return (ordered.withColumn("_local", F.coalesce(F.sum(value).over(local), F.lit(0)))
            .join(offsets, "_part")
            .withColumn(out, (F.col("_offset") + F.col("_local")).cast("long"))
            .drop("_part", "_offset", "_local"))
