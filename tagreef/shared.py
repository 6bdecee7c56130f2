"""Folders every executor can see, taken from the session."""

import re
import tempfile
import uuid
from collections.abc import Callable
from typing import TypeVar

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

Value = TypeVar("Value")


def shared_dir(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``, or else the context's own.

    Only a session whose tasks all run in the driver's process, without either
    setting (a test), gets a temporary folder; elsewhere it is an error, since
    no executor could see that folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if context.getCheckpointDir() is None:
        if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
            raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tagreef-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under :func:`shared_dir` that nothing else uses."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame) -> DataFrame:
    """Compute a frame once, in the shared folder, for several later uses."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def sent(spark: SparkSession, value: Value) -> Callable[[], Value]:
    """A broadcast of an object of this package's own classes, of a size that the caller bounds.

    Broadcasts name classes, which the workers would have to import; here the bytes
    of the object hold its class, so that workers need no copy of the package. The
    returned function loads it, once for each copy that a task has of it.
    """
    held = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    loaded: list[Value] = []

    def load() -> Value:
        if not loaded:
            loaded.append(cloudpickle.loads(held.value))
        return loaded[0]

    return load
