"""What the operators of this subpackage share: tables, shared checkpoints, clash-free joins."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from functools import lru_cache
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@lru_cache(maxsize=None)
def _ship(application: str) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{package.name}", "zip", package.parent, package.name)
    SparkSession.active().sparkContext.addPyFile(archive)


def ship_code(spark: SparkSession) -> None:
    """Hands this package to the Python workers of all executors, once per application."""
    _ship(spark.sparkContext.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in `spark.checkpoint.dir`.

    Only where that is unset and the session is a plain local one (tests) is a folder made; anything else
    is refused, because a folder of one machine is lost with it.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not (context.master == "local" or context.master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoint-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder.rstrip("/")


def checkpoint(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder and read back, with its lineage cut."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """`df` written as Parquet into the shared folder and read back: a checkpoint for many narrow rows."""
    path = f"{shared_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Most bytes of a table that is sent whole to every executor.
BROADCAST_BYTES = 16 << 20


def broadcast_if_small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """`df`, a checkpointed table, marked for broadcast if its rows, counted in bytes, are within `limit`.

    Beyond it the join is left to Spark, which shuffles both sides.
    """
    size = df.agg(F.sum(F.length(F.to_json(F.struct(*df.columns))))).first()[0]
    return F.broadcast(df) if (size or 0) <= limit else df


def attach(left: DataFrame, key: str, right: DataFrame, columns: list[str], how: str = "left") -> DataFrame:
    """`left` as a struct `row`, beside `columns` of `right`, joined where their `key` is equal.

    Columns of `left` cannot clash with those of `right`. NULL keys of `left` match nothing.
    """
    packed = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("row"), F.col(key).alias("_key"))
    other = right.select(F.col(key).alias("_key"), *columns)
    return packed.join(other, "_key", how).drop("_key")


def unpack(df: DataFrame) -> DataFrame:
    """The columns of the struct `row` that `attach` made."""
    return df.select("row.*")


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: the CRC-32 of its id as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def bounded_sample(df: DataFrame, by: str, key: list[str], rows: int) -> DataFrame:
    """About `rows` rows of each value of `by`, or all if there are fewer: those whose hash of `key` is small.

    Each row decides for itself, given how many there are of its value, so nothing is ranked or gathered.
    Rows with equal keys count once.
    """
    counts = checkpoint(df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows")))
    place = F.shiftrightunsigned(F.xxhash64(*key), 1) / F.lit(float(1 << 63))
    chosen = df.withColumn("_place", place).join(broadcast_if_small(counts), by).where(F.col("_place") * F.col("_rows") < rows)
    return chosen.dropDuplicates([by, "_place"]).drop("_rows")
