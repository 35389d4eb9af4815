"""What the operators share: words, tables, and tables kept in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.checkpoints import use_checkpoint_dir

# --- fixed values: a word is a run of anything but these six ASCII blanks ---
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def words(text: Column) -> Column:
    """The words of a text as an array; empty for NULL."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's address below the session's checkpoint folder, which driver and all
    executors share."""
    use_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def kept(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """The table written to the shared folder and read again: it is worked out once, and an
    executor that is lost takes nothing of it away."""
    spark = df.sparkSession
    folder = shared_folder(spark, name)
    df.write.parquet(folder, compression=compression)
    return spark.read.schema(df.schema).parquet(folder)


def parts(df: DataFrame) -> int:
    """The session's number of shuffle partitions."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_place(df: DataFrame, by: list[str], order: list[Column], out: str) -> DataFrame:
    """Add the rows' places, from 1, in an order within each group of plain columns ``by``, or
    within the whole table.

    No task sees a whole group: the rows are dealt out by ranges of group and order, and a row's
    place is its place in its range after the rows of its group in the ranges before. Only the
    number of rows of each group and range meet.
    """
    keys = [F.col(name) for name in by]
    dealt = df.repartitionByRange(parts(df), *keys, *order).withColumn("__range", F.spark_partition_id())
    dealt = kept(dealt, "ranges")
    inside = F.row_number().over(Window.partitionBy("__range", *by).orderBy(*order))
    before = Window.partitionBy(*by).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy("__range", *by).agg(F.count("*").alias("__n"))
    counts = counts.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0))).drop("__n")
    placed = dealt.withColumn("__inside", inside)
    other = counts.withColumnsRenamed({name: f"__{name}" for name in by} | {"__range": "__at"})
    on = [F.col("__range") == F.col("__at"), *[F.col(name).eqNullSafe(F.col(f"__{name}")) for name in by]]
    both = placed.join(other, on)
    return both.select(*df.columns, (F.col("__before") + F.col("__inside")).alias(out))


_PACKAGE = Path(__file__).resolve().parent.parent


def ship(spark: SparkSession) -> None:
    """Send the package to the executors, once per Spark context, as ``--py-files`` does, so
    that their Python workers can import it."""
    context = spark.sparkContext
    if getattr(context, "_plazalens_shipped", False):
        return
    archive = Path(tempfile.mkdtemp(prefix="plazalens-")) / "plazalens.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(_PACKAGE.rglob("*.py")):
            out.write(file, file.relative_to(_PACKAGE.parent))
    context.addPyFile(str(archive))
    context._plazalens_shipped = True
