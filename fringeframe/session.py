"""Session defaults and durable lineage cuts."""

from __future__ import annotations

import tempfile
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

#: Settings every job wants; partition counts are left to the cluster and to AQE.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "fringeframe", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the package defaults; ``conf`` overrides them."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder for durable checkpoints, as named by the cluster.

    A private temporary folder is used only on a local master that names none;
    on a cluster it would not be visible to the other executors.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="fringeframe-ckpt-")
    sc.setCheckpointDir(folder)
    return folder


def shared_path(spark: SparkSession, kind: str = "table") -> str:
    """A new, unused path in the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/fringeframe-{kind}-{uuid.uuid4().hex}"


#: Tables of this driver that nobody has cleared yet.
_written: list[str] = []
#: Where the tables are that are still in use.
_paths: WeakKeyDictionary[DataFrame, str] = WeakKeyDictionary()


def clear_tables(spark: SparkSession) -> int:
    """Delete the intermediate tables written so far; only when no DataFrame that reads them is used any more."""
    n = len(_written)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(conf).delete(path, True)
    return n


def cut_lineage(df: DataFrame, **options: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and go on from there; ``options`` are of the writer.

    A written table survives lost executors, is read by column, and has a known
    size, so later joins can be planned on it.
    """
    path = shared_path(df.sparkSession)
    df.write.options(**options).parquet(path)
    _written.append(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    _paths[table] = path
    return table


def drop_table(table: DataFrame) -> None:
    """Delete a table that ``cut_lineage`` has returned and that nothing reads any more; other DataFrames stay as they are."""
    path = _paths.pop(table, None)
    if path is not None:
        sc = table.sparkSession.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)
        if path in _written:
            _written.remove(path)
