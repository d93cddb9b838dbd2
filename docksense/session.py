"""Session settings and the shared working folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Folder of the present run below the shared one.
_RUN: ContextVar[str] = ContextVar("run", default="")


def build_session(master: str | None = None, app: str = "docksense", **conf) -> SparkSession:
    """A session with a UTC zone, ANSI mode and adaptive execution."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master may fall back to a folder of this machine.
    """
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", "")
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        root = os.environ.get("DOCKSENSE_LOCAL_SCRATCH") or tempfile.mkdtemp(prefix="docksense-")
        os.environ["DOCKSENSE_LOCAL_SCRATCH"] = root
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


@contextmanager
def run_folder(spark: SparkSession, label: str = "run") -> Iterator[str]:
    """Keep the written tables of a job in one folder and drop it at the end.

    The job's result must be written or collected inside: it may read those tables. Without this they stay in the shared
    folder until it is cleared.
    """
    name = f"{label}-{uuid.uuid4().hex[:12]}"
    folder = f"{shared_folder(spark).rstrip('/')}/{name}"
    token = _RUN.set(f"{name}/")
    try:
        yield folder
    finally:
        _RUN.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, in the folder of the run if there is one."""
    return f"{shared_folder(spark).rstrip('/')}/{_RUN.get()}{label}-{uuid.uuid4().hex[:12]}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write to a table in the shared folder and read it back, between the rounds of iterative jobs.

    Unlike a checkpoint, the table carries no inferred constraints of earlier rounds, whose number would grow
    with every round, and its size is known to the planner.
    """
    spark = df.sparkSession
    path = new_path(spark, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
