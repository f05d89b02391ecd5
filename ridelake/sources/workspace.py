"""Folders for tables that a query writes for itself."""

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

# The folders made in the innermost scope, if there is one.
_HELD: ContextVar[list[str] | None] = ContextVar("held", default=None)


def new_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder path that the driver and every executor can reach.

    It lies under the session's ``spark.checkpoint.dir``. Where that is unset it lies under the warehouse folder if the
    session is local; on a cluster that could be a folder of the driver alone, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = spark.conf.get("spark.sql.warehouse.dir")
    path = f"{root.rstrip('/')}/{name}-{uuid4().hex}"
    held = _HELD.get()
    if held is not None:
        held.append(path)
    return path


@contextmanager
def folders_dropped(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, all folders that were made within; write what is to stay, or collect it, before that.

    Operators leave their intermediate tables for as long as their result may be computed; only
    the caller knows how long that is.
    """
    held: list[str] = []
    token = _HELD.set(held)
    try:
        yield
    finally:
        _HELD.reset(token)
        for path in held:
            drop_folder(spark, path)


def _place(spark: SparkSession, path: str):
    """A path and the store it lies in."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there, in whichever store it lies."""
    place, store = _place(spark, path)
    store.delete(place, True)


def move_folder(spark: SparkSession, old: str, new: str) -> None:
    """Gives a folder another place in the same store; does nothing if it is not there."""
    (source, store), (target, _) = _place(spark, old), _place(spark, new)
    if store.exists(source):
        store.mkdirs(target.getParent())
        if not store.rename(source, target):
            raise OSError(f"could not move {old} to {new}")


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """The names of what lies in a folder; none if it is not there."""
    place, store = _place(spark, path)
    return sorted(entry.getPath().getName() for entry in store.listStatus(place)) if store.exists(place) else []


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` as a table in a folder of its own, so that nothing computes them again."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
