"""Session helpers: shared checkpoint folder and frame materialisation."""

from __future__ import annotations

import tempfile
import time
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

T = TypeVar("T")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The checkpoint folder the cluster names; a temporary one in local mode only."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        # One process only: a cluster on one machine has executors of its own.
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="touchstone-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named


def materialize(frame: DataFrame) -> DataFrame:
    """Reliable checkpoint: computed once, survives the loss of executors."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def entity_jobs(
    spark: SparkSession, names: Iterable[str], work: Callable[[str], T], *, parallel: int = 4
) -> dict[str, tuple[T, float]]:
    """``work(name)`` for every name, a few at a time, with the seconds each took.

    The jobs of a name carry the tag ``touchstone-<name>``, so they can be
    found and cancelled together, and run in a pool of that name: under
    ``spark.scheduler.mode=FAIR`` a long one does not hold up the others.  The
    first error is raised when all have ended.
    """
    context = spark.sparkContext
    ensure_checkpoint_dir(spark)  # once, before there are several threads

    def one(name: str) -> tuple[T, float]:
        began = time.monotonic()
        tag = f"touchstone-{name}"
        context.setLocalProperty("spark.scheduler.pool", name)
        context.addJobTag(tag)
        try:
            return work(name), time.monotonic() - began
        finally:
            context.removeJobTag(tag)

    names = list(names)
    with ThreadPoolExecutor(max_workers=parallel) as threads:
        # Each call copies this thread's properties, so tags and pools don't mix.
        runs = [threads.submit(inheritable_thread_target(spark)(one), name) for name in names]
        return {name: run.result() for name, run in zip(names, runs, strict=True)}
