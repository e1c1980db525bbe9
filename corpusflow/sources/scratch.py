"""Where intermediate results go."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from py4j.java_gateway import is_instance_of
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import ArrayType, DataType, MapType, NullType, StructType

from corpusflow.sources import files

CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLES_CONF = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Scratch folders made since the innermost ``passing`` began; None outside of one.
_passing: ContextVar[list[str] | None] = ContextVar("passing", default=None)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the cluster, else one in the session's warehouse.

    A warehouse on a machine's own disk serves a local session only: on a cluster the
    executors would each write to their own, so that is an error.
    """
    context = spark.sparkContext
    configured = context.getConf().get(CHECKPOINT_CONF)
    configured = configured or spark.conf.get(CHECKPOINT_CONF, None)
    if not configured:
        warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
        configured = context.getCheckpointDir()
        if not configured and warehouse.startswith("file:") and not context.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder; {warehouse} is a local one")
        configured = configured or f"{warehouse}/corpusflow-scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (made := _passing.get()) is not None:
        made.append(path)
    return path


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Scratch folders that are made in here are deleted at its end.

    For work whose results lie elsewhere by then: no frame over them may be read later.
    """
    made: list[str] = []
    token = _passing.set(made)
    try:
        yield
    finally:
        _passing.reset(token)
        for path in made:
            files.delete(spark, path)


@contextmanager
def without_shuffles(spark: SparkSession) -> Iterator[None]:
    """What is written in here leaves no shuffle files behind.

    They would lie on the executors' disks until the driver's JVM collects its garbage.
    """
    before = spark.conf.get(SHUFFLES_CONF, None)
    spark.conf.set(SHUFFLES_CONF, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SHUFFLES_CONF)
        else:
            spark.conf.set(SHUFFLES_CONF, before)


def drop_shuffles(df: DataFrame) -> None:
    """Delete the shuffle files under a frame that is an RDD, as a stream's micro-batch is.

    A later read of the frame would work them out again.
    """
    context, gateway = df.sparkSession._jsc.sc(), df.sparkSession.sparkContext._gateway
    todo, seen = [df._jdf.queryExecution().toRdd()], set()
    while todo:
        rdd = todo.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        dependencies = rdd.dependencies()
        for i in range(dependencies.size()):
            dependency = dependencies.apply(i)
            if is_instance_of(gateway, dependency, "org.apache.spark.ShuffleDependency"):
                context.shuffleDriverComponents().removeShuffle(dependency.shuffleId(), True)
            todo.append(dependency.rdd())


def _storable(kind: DataType) -> bool:
    """Whether Parquet can hold values of this type."""
    if isinstance(kind, StructType):
        return all(_storable(field.dataType) for field in kind.fields)
    if isinstance(kind, ArrayType):
        return _storable(kind.elementType)
    if isinstance(kind, MapType):
        return _storable(kind.keyType) and _storable(kind.valueType)
    return not isinstance(kind, NullType) and kind.typeName() != "interval"


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet, for jobs that read it several times.

    They work nothing out again, and read only the columns that they need.
    """
    path = scratch_path(df.sparkSession, name)
    with without_shuffles(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fixed(df: DataFrame, name: str) -> DataFrame:
    """``kept`` for frames of any columns; those that Parquet cannot hold are checkpointed."""
    return kept(df, name) if _storable(df.schema) else cut_lineage(df)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable storage and go on from there.

    Later jobs see fixed rows in fixed partitions, and a lost executor costs a
    re-read instead of a recomputation.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)
