"""Session factory and the few session-level facts operators may rely on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession

#: Settings of every session this package makes; a cluster's own settings win where they are set on submit.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.checkpoint.compress": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, app: str = "millrace", **conf: str) -> SparkSession:
    """A session with this package's defaults; ``conf`` entries override them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; only where none is named (tests, a laptop) make one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if named is None and not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    context.setCheckpointDir(named or tempfile.mkdtemp(prefix="millrace-checkpoint-"))
    if named is None:  # a laptop's own folder goes when its session ends
        _path(spark, os.path.dirname(context._jsc.sc().getCheckpointDir().get())).deleteOnExit()


class _path:
    """A path of any Hadoop file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def delete(self) -> None:
        self.fs.delete(self.path, True)

    def deleteOnExit(self) -> None:
        self.fs.deleteOnExit(self.path)


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage through the shared checkpoint folder, so the result survives a lost executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, **metrics: Column) -> DataFrame:
    """As ``cut``, through a compressed table in the checkpoint folder; ``discard`` deletes it, at the latest the session's end does.

    It takes a tenth of a checkpoint's room and later reads only the columns they need, but forgets how rows were partitioned.
    ``metrics`` are aggregates over all rows, taken on the way; they are in ``seen`` of the result.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    seen = Observation()
    watched = df.observe(seen, *[value.alias(name) for name, value in metrics.items()]) if metrics else df
    watched.write.parquet(path)
    _path(spark, path).deleteOnExit()
    done = spark.read.schema(df.schema).parquet(path)
    done.stored_at, done.seen = path, seen.get if metrics else {}
    return done


def discard(df: DataFrame) -> None:
    """Delete a table that ``stored`` made and that no later action reads."""
    _path(df.sparkSession, df.stored_at).delete()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, for clusters on which it is not installed."""
    context = spark.sparkContext
    if getattr(context, "_millrace_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if os.path.isdir(root):
        path = os.path.join(tempfile.mkdtemp(prefix="millrace-ship-"), "millrace.zip")
        with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as bundle:
            for at, _, names in os.walk(root):
                for name in names:
                    if name.endswith(".py"):
                        bundle.write(os.path.join(at, name), os.path.relpath(os.path.join(at, name), os.path.dirname(root)))
        context.addPyFile(path)
    context._millrace_shipped = True


def release(spark: SparkSession) -> None:
    """Let the driver drop what earlier rounds of an iteration left.

    Shuffle files go once the driver's collector finds their owners gone, and so do checkpoints where
    spark.cleaner.referenceTracking.cleanCheckpoints is set, as in sessions made here; a driver with a large heap may not
    look for hours, and an iteration would fill the disks meanwhile.
    """
    spark.sparkContext._jvm.System.gc()


def cut_observed(df: DataFrame, **metrics: Column) -> tuple[DataFrame, dict]:
    """As ``cut``, with aggregates over all rows taken on the way, without another job."""
    ensure_checkpoint_dir(df.sparkSession)
    seen = Observation()
    done = df.observe(seen, *[value.alias(name) for name, value in metrics.items()]).checkpoint(eager=True)
    return done, seen.get
