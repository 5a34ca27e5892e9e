"""Session defaults and the shared folder for data that must outlive an executor."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def build_session(app_name: str, cores: int | str = "*") -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    partitions = str(cores) if str(cores).isdigit() else "8"
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.sql.shuffle.partitions", partitions)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Recording the call site of every column expression doubles the time it
        # takes to build a plan.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", "12g")
        # Checkpoints go once nothing refers to them any more.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a temporary folder: on a
    cluster such a folder would not be visible to the other machines.  It goes at exit.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = context.getCheckpointDir()
    if configured is None and current is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        configured = tempfile.mkdtemp(prefix="tallyward-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    if current is None:
        context.setCheckpointDir(configured)
    return configured or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh location for `name` below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(frame: DataFrame) -> DataFrame:
    """Write `frame` to the shared folder once and continue from the files."""
    shared_root(frame.sparkSession)
    return frame.checkpoint(eager=True)


def broadcast_if_small(frame: DataFrame, *inputs: DataFrame) -> DataFrame:
    """Hint a broadcast of `frame` if the `inputs` it is joined from are small.

    Spark estimates a join as the product of its sides and so never broadcasts
    one by itself.  Its estimates of the inputs are sound, and their sum has to
    stay below the session's own broadcast threshold.
    """
    conf = frame.sparkSession._jsparkSession.sessionState().conf()
    plans = [each._jdf.queryExecution().optimizedPlan() for each in inputs]
    size = sum(int(str(plan.stats().sizeInBytes())) for plan in plans)
    return F.broadcast(frame) if size <= conf.autoBroadcastJoinThreshold() else frame
