"""Intermediate tables in the shared folder, and names that cannot clash with a caller's columns."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from millrace.session import checkpoint_dir, configure

# One folder per application where the session names none (tests).
_OWN: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``, or a temporary one in a local session."""
    if spark.conf.get("spark.checkpoint.dir", None):
        return spark.conf.get("spark.checkpoint.dir").rstrip("/")
    key = spark.sparkContext.applicationId
    if key not in _OWN:
        _OWN[key] = "file://" + checkpoint_dir(spark)
    return _OWN[key]


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; what is written there goes when the application ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


def saved(frame: DataFrame, label: str) -> DataFrame:
    """Write a frame below the shared folder and read it back: its lineage is cut and no work is repeated."""
    spark = frame.sparkSession
    path = new_folder(spark, label)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def let(value: Column, body) -> Column:
    """``body`` over a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(frame: DataFrame) -> Column:
    """All columns as one struct, so that no name of theirs meets a name of ours."""
    return F.struct(*[F.col(quoted(c)).alias(c) for c in frame.columns])


# Applications that have been sent the package already.
_SHIPPED: set[str] = set()


def arrow(frame: DataFrame, function, schema) -> DataFrame:
    """``mapInArrow``, with this package sent to the executors first, so that they can import it."""
    ship(frame.sparkSession)
    return frame.mapInArrow(function, schema)


def ship(spark: SparkSession) -> None:
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="millrace-"), "millrace.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for at, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(at, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
