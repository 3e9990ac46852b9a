"""What executors and the driver share: this package, for sessions started without --py-files, and a folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Bytes of a batch that goes to a Python worker; batches of long texts stay small.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20
_sent: set[str] = set()
_own: dict[str, str | None] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one of our own only where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = _own.setdefault(spark.sparkContext.applicationId, None) or tempfile.mkdtemp(prefix="wattlake-")
        _own[spark.sparkContext.applicationId] = folder
    return folder


def materialised(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder: what several branches read is computed once, and a lost executor loses nothing."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ship(spark: SparkSession) -> None:
    """Adds the package, zipped, to the application's Python files, once for each application, and bounds the
    bytes of Arrow batches."""
    spark.conf.set(BATCH, str(BATCH_BYTES))
    app = spark.sparkContext.applicationId
    if app in _sent:
        return
    _sent.add(app)
    root = Path(__file__).resolve().parents[2]
    folder = tempfile.mkdtemp(prefix="wattlake-")
    stage = Path(folder) / "stage"
    shutil.copytree(root / "wattlake", stage / "wattlake", ignore=shutil.ignore_patterns("__pycache__"))
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/wattlake_package", "zip", stage))
