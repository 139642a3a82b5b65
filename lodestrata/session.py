"""Sessions, and the places that driver and executors share."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def session(app: str = "lodestrata", cores: int | str = "*", partitions: int = 8, **conf: str) -> SparkSession:
    """A local session with the settings that the operators expect; on a cluster use the cluster's own session."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": os.environ.get("LODESTRATA_DRIVER_MEMORY", "8g"),
        "spark.driver.host": "127.0.0.1",
    } | conf
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def workers_import(spark: SparkSession) -> None:
    """Let Python workers that see this folder import the package; elsewhere ship it with --py-files."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in have:
        env["PYTHONPATH"] = os.pathsep.join(x for x in [ROOT, *have] if x)


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir; where that is unset in a local session, as in tests, a temporary one that is then set.

    On a cluster an unset folder raises: executors don't share the driver's disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="lodestrata-")
        spark.sparkContext.setCheckpointDir(folder)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


#: Paths written in the open scopes, innermost last.
_SCOPES: list[list[str]] = []


@contextlib.contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """What `written` writes within goes at the end, but for frames kept; results must have been written, or taken, by then."""
    _SCOPES.append([])
    try:
        yield
    finally:
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        for path in _SCOPES.pop():
            p = path_of(path)
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def written(df: DataFrame, name: str = "step", keep: bool = False) -> DataFrame:
    """df, written once as Parquet in the shared folder and read again.

    Cuts the lineage so that later steps survive lost executors without
    running the earlier ones again, and so that several readers share one run.
    Within a `scope` the folder goes with it, unless it is to be kept.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/written/{name}-{uuid.uuid4().hex}"
    if _SCOPES and not keep:
        _SCOPES[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
