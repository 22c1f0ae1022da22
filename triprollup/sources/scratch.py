"""Directories for intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import SparkSession

from triprollup.sinks.files import remove

#: The folder of the run that is open, if one is.
_RUN: ContextVar[str | None] = ContextVar("scratch run", default=None)


def _root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("spark.checkpoint.dir must name a folder all executors share")
    return f"{root.rstrip('/')}/triprollup"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new directory in the shared folder that spark.checkpoint.dir names."""
    folder = _RUN.get()
    return f"{folder or _root(spark)}/{label}-{uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession) -> Iterator[str]:
    """Put all intermediate tables made within into one folder and remove it at the end.

    What reads them must be written to its place within: frames that are returned from here find
    their tables gone. Runs may be nested; each removes its own. A run that is lost leaves its
    folder, `run-` and an id, which nothing reads afterwards.
    """
    folder = f"{_RUN.get() or _root(spark)}/run-{uuid4().hex}"
    token = _RUN.set(folder)
    try:
        yield folder
    finally:
        _RUN.reset(token)
        remove(spark, folder)
