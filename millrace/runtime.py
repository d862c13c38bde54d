"""Session helpers shared by all operators: tables, shared scratch space and skew-safe ordering."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_scratch_root: str | None = None

#: Sides of joins up to this number of rows (some 10 MB of narrow rows) are broadcast.
BROADCAST_ROWS = 100_000
#: Keys of more rows than this are joined apart from the others.
HOT_ROWS = 100_000
#: Copies of a larger side, over which the rows of a hot key are dealt.
SALTS = 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    On a cluster this is `spark.checkpoint.dir` of the session. Only a local session that has none gets a
    temporary folder of its own; any other session without the setting is refused, because a machine-local folder
    would not survive the loss of an executor.
    """
    global _scratch_root
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return f"{configured.rstrip('/')}/millrace-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if _scratch_root is None:
        _scratch_root = tempfile.mkdtemp(prefix="millrace-")
        atexit.register(shutil.rmtree, _scratch_root, ignore_errors=True)
    return f"file://{_scratch_root}"


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write `df` to the shared scratch folder and return the stored table.

    This cuts the lineage: the table survives lost executors, and later plans read only the columns they need.
    """
    spark = df.sparkSession
    path = f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"
    writer = df.write.mode("errorifexists").option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._millrace_path = path
    return stored


def release(*frames: DataFrame | None) -> None:
    """Delete stored tables that no later plan reads."""
    for df in frames:
        path = getattr(df, "_millrace_path", None)
        if path is None:
            continue
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        with contextlib.suppress(Exception):
            target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(target, True)


def clear(spark: SparkSession) -> None:
    """Delete all stored tables of this application; to be called when its results have been written."""
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch_dir(spark))
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def running_totals(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    totals: dict[str, Column],
    label: str = "ordered",
    part: Column | None = None,
) -> DataFrame:
    """Inclusive running totals within `keys`, in `order`, without gathering a group into one task.

    Rows are range-sorted by key and order, so a group holding a third of all rows spreads over many partitions.
    Each partition's sums are added up first; a row's total is the sum of the earlier partitions of its group plus its
    running sum inside its own partition. `order` must end in a unique column, else equal rows share a partition and
    their mutual order is arbitrary. Keys must not be null.

    Range-sorting reads `df` twice and samples up to 300 keys per shuffle partition into the driver. Where a number that
    never falls along `order` can be computed from the row and deals the rows evenly, `part` is that number and takes the
    place of the ranges: nothing is sampled.
    """
    spread = df.repartitionByRange(*[F.col(k) for k in keys], *order) if part is None else df
    spread = spread.withColumn("_part", F.spark_partition_id() if part is None else part)
    stored = materialize(spread.select("*", *[v.alias(f"_v_{n}") for n, v in totals.items()]), label)
    by_part = stored.groupBy(*keys, "_part").agg(*[F.sum(f"_v_{n}").alias(f"_s_{n}") for n in totals])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = by_part.select(
        *keys, "_part", *[F.coalesce(F.sum(f"_s_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in totals]
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    out = stored.join(offsets, [*keys, "_part"])
    for n in totals:
        out = out.withColumn(n, F.col(f"_o_{n}") + F.sum(f"_v_{n}").over(inside))
    drop = ["_part", *[f"_{p}_{n}" for n in totals for p in "vo"]]
    out = out.drop(*drop)
    out._millrace_path = stored._millrace_path  # so that the caller can release the ordered rows
    return out


def lookup(rows: DataFrame, side: DataFrame, on: Sequence[str], how: str = "inner", most: int = BROADCAST_ROWS) -> DataFrame:
    """`rows` joined with `side`, whose keys are unique or nearly so, although one key may hold a third of `rows`.

    A side of at most `most` rows is broadcast; it is counted first. A larger one is repeated `SALTS` times and the rows
    of a key are dealt over the copies by a hash of the row, so a hot key is joined by as many tasks and a lost task
    deals them alike. `how` is inner, left, left_semi or left_anti; `side` should be a stored table or cheap to compute,
    since it is read twice.
    """
    if side.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(side), list(on), how)
    salt = F.array(*[F.lit(i) for i in range(SALTS)])
    copies = side.withColumn("_salt", F.explode(salt))
    dealt = rows.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c, t in rows.dtypes if "map<" not in t and "variant" not in t]), F.lit(SALTS)).cast("int"))
    return dealt.join(copies, [*on, "_salt"], how).drop("_salt")


def attach(rows: DataFrame, side: DataFrame, key: str, count: str, spread: Column, hot: int = HOT_ROWS, most: int = BROADCAST_ROWS) -> DataFrame:
    """`rows` left-joined with the stored `side` on `key`, where side's column `count` tells how many rows have the key.

    A side of at most `most` rows is broadcast, so the rows do not move at all. Otherwise keys of more than `hot` rows
    are looked up apart (see `lookup`), and in the shuffle of the others their rows are dealt by `spread`, a column
    that tells them apart, so no task gets more than its share of a hot key.
    """
    if side.limit(most + 1).count() <= most:
        return rows.join(F.broadcast(side), key, "left")
    names = [c for c in side.columns if c != key]
    busy = side.filter(F.col(count) > hot).select(key, *[F.col(c).alias(f"_hot_{c}") for c in names])
    calm = side.filter(F.col(count) <= hot).select(F.col(key).alias("_key"), *[F.col(c).alias(f"_calm_{c}") for c in names])
    found = lookup(rows, busy, [key], "left")
    found = found.withColumn("_key", F.when(F.col(f"_hot_{count}").isNull(), F.col(key)).otherwise(F.concat(F.lit("\x00"), F.sha2(spread.cast("string"), 256))))
    out = found.join(calm, "_key", "left")
    return out.select(*rows.columns, *[F.coalesce(f"_hot_{c}", f"_calm_{c}").alias(c) for c in names])


def numbered(df: DataFrame, count: Column, out: str, block: int = 1 << 15) -> DataFrame:
    """Every row repeated `count` times with `out` = 1, 2, ..., in two steps, so that no array grows with the count."""
    n = count.cast("long")
    blocks = df.withColumn("_n", n).filter("_n > 0").withColumn("_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / block))))
    first = F.col("_block") * block + 1
    return blocks.withColumn(out, F.explode(F.sequence(first, F.least(F.col("_n"), first + block - 1)))).drop("_n", "_block")


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str = "rank") -> DataFrame:
    """Position 1, 2, ... of each row in its group, computed as a running count (see `running_totals`)."""
    return running_totals(df, keys, order, {out: F.lit(1).cast("long")}, label="ranked")
