"""Session defaults and the shared folder for written intermediate tables."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

_LOCAL_WORK: dict[str, str] = {}
_SHIPPED: set[str] = set()
_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_PACKAGES = ("geolayer", "workloads")
#: Row groups of tables with long rows. Spark's reader holds up to 4,096 rows of a row group unpacked, however long.
LONG_ROWS = {"parquet.block.size": 8 << 20, "parquet.block.row.count.limit": 64}


def get_session(master: str | None = None, app: str = "geolayer", **conf: str) -> SparkSession:
    """A session with the settings the library expects; existing ones are kept."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: ``spark.checkpoint.dir`` as the cluster names it.

    Only a local-mode session without that setting gets a temporary folder of its own; on a
    cluster a machine-local folder would be lost with the machine, so that is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_WORK:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        _LOCAL_WORK[app] = tempfile.mkdtemp(prefix="geolayer-")
    return _LOCAL_WORK[app]


def written(df: DataFrame, name: str = "cut", long_rows: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    This cuts the lineage: what follows reads files that survive the loss of any executor,
    and sees the same rows however often it is run. ``long_rows`` is for rows that hold thousands of values, as
    long rings do: then a task that reads them has few of them at a time.
    """
    return written_at(df, name, long_rows)[0]


def written_at(df: DataFrame, name: str = "cut", long_rows: bool = False) -> tuple[DataFrame, str]:
    """``written`` and the folder it went to."""
    spark = df.sparkSession
    path = os.path.join(work_dir(spark), f"{name}-{uuid.uuid4().hex}")
    df.write.options(**LONG_ROWS if long_rows else {}).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the Parquet files of a folder; only the list of files is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path)
    return files.agg({"length": "sum"}).first()[0] or 0


def ship_packages(spark: SparkSession) -> None:
    """Send the packages' code to the executors, once per application.

    The archive is code only; the driver serves it, so its own temporary folder will do.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="geolayer-code-"), "geolayer_packages.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for package in _PACKAGES:
            for folder, _, names in os.walk(os.path.join(_ROOT, package)):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        z.write(path, os.path.relpath(path, _ROOT))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)
