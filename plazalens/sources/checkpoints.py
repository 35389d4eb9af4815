"""Where iterative operators put the tables that cut their lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession

_SETTING = "spark.checkpoint.dir"


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint` write to the shared folder of the session.

    ``spark.checkpoint.dir`` decides; without it, a folder already set on the context. With
    neither, a session of one process (master ``local``) gets a temporary folder and any other
    gets an error, since a folder on one machine does not outlive its executors. A ``file:``
    address is taken as it is: it can be a mount that all machines share.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    shared = spark.conf.get(_SETTING, None)
    one_process = re.fullmatch(r"local(\[.*\])?", context.master) is not None
    if shared:
        if current is None or not _is_below(current, shared):
            context.setCheckpointDir(shared)
    elif current is None:
        if not one_process:
            raise RuntimeError(f"set {_SETTING} to a folder all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="plazalens-checkpoints-"))


def _is_below(folder: str, parent: str) -> bool:
    """True if a folder lies directly in the other. A parent without a scheme is in the
    default file system, whichever that is."""
    own, other = urlsplit(folder), urlsplit(parent)
    same_system = not other.scheme or (own.scheme, own.netloc) == (other.scheme, other.netloc)
    own_path, other_path = (re.sub("/+", "/", parts.path).rstrip("/") for parts in (own, other))
    return same_system and own_path.rpartition("/")[0] == other_path


def forget_checkpoint(df: DataFrame) -> None:
    """Delete the files of a DataFrame that `DataFrame.checkpoint` gave and nobody reads again."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(file.get())
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The table as Parquet in the shared folder, read again: worked out once, and Spark knows
    its bytes."""
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
