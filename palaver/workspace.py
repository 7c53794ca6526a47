"""Working tables: intermediate results written once to the cluster's shared folder and read back.

A written table survives the loss of executors, cuts the lineage, and gives Catalyst the true byte size, so the
choice between a broadcast and a shuffled join rests on a measured size.
"""

import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_run: ContextVar[str | None] = ContextVar("run", default=None)


def working_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, else the context's checkpoint folder, else the warehouse."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        context = spark.sparkContext
        folder = context._jsc.sc().getCheckpointDir()
        configured = folder.get() if folder.isDefined() else f"{spark.conf.get('spark.sql.warehouse.dir')}/_working"
    return configured.rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{working_folder(spark)}/palaver/{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the working folder that nothing else uses, inside the folder of the current run if there is one."""
    return f"{_run.get() or _application_folder(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for the working tables that are written inside; it is removed at the end, also of a run that fails."""
    path = f"{_application_folder(spark)}/run-{uuid.uuid4().hex}"
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path of any file system that Spark knows; one that is not there is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """The paths that a pattern matches, of any file system that Spark knows; none is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return [str(status.getPath()) for status in found or []]


def write_once(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as a new Parquet table in the working folder and return the table."""
    path = new_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def concurrently[T](*steps: Callable[[], T]) -> list[T]:
    """Run independent steps at the same time, so that small jobs share the cluster instead of queueing."""
    session = SparkSession.active()
    with ThreadPoolExecutor(max_workers=min(len(steps), 8)) as pool:
        # Each step gets local properties of its own: Spark keeps the execution's id there and clears it when it ends.
        started = [pool.submit(copy_context().run, inheritable_thread_target(session)(step)) for step in steps]
        return [step.result() for step in started]


def literal_table(spark: SparkSession, rows: list[tuple], schema: StructType) -> DataFrame:
    """A few rows as a local relation, whose size Catalyst knows; rows given as a plain list would have no known size."""
    columns = zip(*rows) if rows else ([] for _ in schema)
    table = pa.table({field.name: pa.array(list(values)) for field, values in zip(schema, columns)})
    return spark.createDataFrame(table, schema)
