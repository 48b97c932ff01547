"""Session settings and durable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Shuffle files of an SQL execution go at its end, not when the driver happens to collect its handles.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "urbanweave", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the SQL settings the operators are tuned for.

    Adaptive execution sizes the shuffles and splits skewed join partitions at run time, so no partition
    count is fixed here; callers may pass any other setting as a keyword with ``__`` for the dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per session, so that they need no installed copy."""
    context = spark.sparkContext
    if getattr(context, "_urbanweave_shipped", False):
        return
    home = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="urbanweave-"), "urbanweave.zip")  # the driver serves it from here
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as packed:
        for folder, _, names in os.walk(home):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    packed.write(path, os.path.relpath(path, os.path.dirname(home)))
    context.addPyFile(target)
    context._urbanweave_shipped = True


def use_checkpoint_dir(spark: SparkSession) -> None:
    """Make sure ``checkpoint()`` has a folder: the session's own one, or a scratch folder in local mode only."""
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        context.setCheckpointDir(shared)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="urbanweave-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Plans made inside give their shuffle files back when they have run; only for plans that run once."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, before)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so iterations neither recompute nor grow their plans."""
    use_checkpoint_dir(df.sparkSession)
    with shuffles_freed(df.sparkSession):
        # the plan is made anew, so that the files of a plan the caller may run again stay
        return df.select("*").checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` as a written table in the shared checkpoint folder: compressed, where ``checkpoint()`` is not."""
    spark = df.sparkSession
    use_checkpoint_dir(spark)
    place = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    with shuffles_freed(spark):
        df.write.parquet(place)
    return spark.read.schema(df.schema).parquet(place)
