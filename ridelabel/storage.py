"""Tables written between the steps of a job."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_own_folders: dict[str, str] = {}
#: With this Spark removes a write's shuffle files when it ends, not when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, which driver and executors share.

    Only a local session without that setting gets a folder of its own, which goes with the process.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    context = spark.sparkContext
    if not context.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _own_folders:
        folder = tempfile.mkdtemp(prefix="ridelabel-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_folders[context.applicationId] = folder
    return _own_folders[context.applicationId]


def written(frame: DataFrame) -> DataFrame:
    """The frame, computed once, written to the shared folder and read from there.

    Lineage ends here; lost executors lose nothing that was written.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/table-{uuid.uuid4().hex}"
    spark.conf.set(CLEANUP, "true")
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


@contextmanager
def held(frame: DataFrame, spark: SparkSession, path: str) -> Iterator[DataFrame]:
    """The frame, computed once and read by ``spark`` from ``path``, which goes at the end.

    Shuffle files of what ``spark`` writes meanwhile go with each write.
    """
    spark.conf.set(CLEANUP, "true")
    frame.write.mode("overwrite").parquet(path)
    try:
        yield spark.read.schema(frame.schema).parquet(path)
    finally:
        context = spark.sparkContext
        place = context._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
