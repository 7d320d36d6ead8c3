"""Writers and the layout tables are stored in."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The order each table is read in; "-" marks descending.
DEFAULT_ORDER = ["-date", "autonomous_region"]
ACCESS_ORDER = {
    "population_ar": ["autonomous_region"],
    "death_causes": ["death_cause", "age_range"],
    "outbreaks_description": ["-date", "scope", "subscope"],
    "top_death_causes": ["death_cause"],
    "clinic_description": ["-date", "symptom"],
}

#: Folders of versions, and the file that says one is complete.
VERSION, COMPLETE = "version=", "_complete"


def shared_root(spark: SparkSession) -> str:
    """The folder for intermediate data that the driver and all executors reach.

    It is ``spark.checkpoint.dir``. Only a local master, where driver and executors are
    one process, may leave it unset; the warehouse folder serves then.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root and spark.sparkContext.master.startswith("local") and (
            "cluster" not in spark.sparkContext.master):
        root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    if not root:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
    return root.rstrip("/")


def shared_folder(spark: SparkSession) -> str:
    """A new folder of its own under the shared root."""
    return f"{shared_root(spark)}/episeries-{uuid.uuid4().hex}"


def _files(spark: SparkSession, path):
    """The file system of a path, whichever Spark reads it from."""
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch copy, wherever Spark can write."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _files(spark, folder).delete(folder, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    """Whether something is stored there, wherever Spark can read."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return _files(spark, folder).exists(folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise with ``checkpoint()``, so a lost executor costs no recomputation."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_root(df.sparkSession))
    return df.checkpoint()


def scratch_folder(spark: SparkSession) -> str:
    """A :func:`shared_folder` that goes when the driver's JVM ends."""
    path = shared_folder(spark)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _files(spark, folder).mkdirs(folder)
    _files(spark, folder).deleteOnExit(folder)
    return path


def stored(df: DataFrame) -> DataFrame:
    """A written copy in the shared folder, far smaller than a checkpoint of many rows.

    The copy goes when the driver's JVM ends.
    """
    path = f"{scratch_folder(df.sparkSession)}/copy"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Versions: a layer of tables is written aside and counts from the moment it is complete.

def _versions(spark: SparkSession, root: str) -> dict[int, bool]:
    """The versions under ``root`` and whether each is complete."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = _files(spark, path(root))
    if not files.exists(path(root)):
        return {}
    names = [entry.getPath().getName() for entry in files.listStatus(path(root))]
    return {
        int(name.removeprefix(VERSION)): files.exists(path(f"{root}/{name}/{COMPLETE}"))
        for name in names if name.startswith(VERSION)
    }


def current_version(spark: SparkSession, root: str) -> str:
    """The folder of the newest complete version; ``root`` itself if it has no versions."""
    complete = [n for n, done in _versions(spark, root).items() if done]
    return f"{root}/{VERSION}{max(complete)}" if complete else root


@contextmanager
def new_version(spark: SparkSession, root: str, keep: int = 2) -> Iterator[str]:
    """A folder to write the next version in; readers see it when the block ends without error.

    The last ``keep`` complete versions stay for readers under way. What a lost run left
    unfinished is never read and goes with the next success. One writer at a time.
    """
    number = max(_versions(spark, root), default=-1) + 1
    folder = f"{root}/{VERSION}{number}"
    yield folder
    mark = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/{COMPLETE}")
    _files(spark, mark).create(mark).close()
    complete = sorted(n for n, done in _versions(spark, root).items() if done)[-keep:]
    for n in _versions(spark, root):
        if n not in complete:
            remove_folder(spark, f"{root}/{VERSION}{n}")


def access_order(df: DataFrame, table: str) -> list[str]:
    wanted = ACCESS_ORDER.get(table, DEFAULT_ORDER)
    return [c for c in wanted if c.lstrip("-") in df.columns]


def arranged(df: DataFrame, order: list[str]) -> DataFrame:
    """Range-partition and sort, so row-group statistics prune scans.

    A row hash ends the range key: rows that share one access key can still be
    spread over several files.
    """
    keys = [F.col(c[1:]).desc() if c.startswith("-") else F.col(c).asc() for c in order]
    if not keys:
        return df
    plain = [f.name for f in df.schema.fields if f.dataType.typeName() != "map"]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in plain])
    return df.repartitionByRange(*keys, spread).sortWithinPartitions(*keys)


def write_table(df: DataFrame, path: str, table: str = "", overwrite: bool = True) -> None:
    """Replace the table, or append to it, in its access order."""
    arranged(df, access_order(df, table)).write.mode(
        "overwrite" if overwrite else "append"
    ).parquet(path)


def copy_table(spark: SparkSession, source: str, target: str, table: str = "") -> None:
    """Carry a table over unchanged."""
    write_table(spark.read.parquet(source), target, table)


def json_rows(df: DataFrame) -> DataFrame:
    """Each row as a JSON record; NULL fields stay visible."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))
