"""Small control files (markers, manifests, pointers) in whatever store a path is in, through Hadoop's file API.

They are a few hundred bytes each and are written by the driver alone; tables go through DataFrames.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm.org.apache.hadoop.fs


def _open(spark: SparkSession, path: str):
    target = _hadoop(spark).Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it does not exist. For folders of a few entries."""
    fs, target = _open(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder with all that is in it."""
    fs, target = _open(spark, path)
    fs.delete(target, True)


def delete_if_empty(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target) and not fs.listStatus(target) and fs.delete(target, False)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename a file or folder within one store; raises when the store refuses."""
    fs, old = _open(spark, source)
    new = _hadoop(spark).Path(target)
    fs.mkdirs(new.getParent())
    if not fs.rename(old, new):
        raise OSError(f"{source} could not be moved to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a small file."""
    fs, target = _open(spark, path)
    stream = fs.create(target, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file in one step: readers see the old text or the new one.

    The text is written beside it and renamed over it. A store without such a rename (an object store) replaces a
    file in one step when it is written.
    """
    hadoop, gateway = _hadoop(spark), spark.sparkContext._gateway
    folder, _, name = path.rpartition("/")
    fresh = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_text(spark, fresh, text)
    try:
        options = gateway.new_array(hadoop.Options.Rename, 1)
        options[0] = hadoop.Options.Rename.OVERWRITE
        old, new = hadoop.Path(fresh), hadoop.Path(path)
        context = hadoop.FileContext.getFileContext(new.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(old, new, options)
    except Exception as error:  # py4j wraps the store's "unsupported" in its own type
        if "Unsupported" not in str(error):
            raise
        write_text(spark, path, text)
        delete(spark, fresh)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, None if there is none."""
    if not exists(spark, path):
        return None
    fs, target = _open(spark, path)
    stream = fs.open(target)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read_json(spark: SparkSession, path: str) -> dict | None:
    text = read_text(spark, path)
    return None if text is None else json.loads(text)


def listing(spark: SparkSession, paths: dict[str, str]) -> dict[str, list]:
    """Per named path: number of its files, their bytes, and a sum of hashes of name, size and time.

    Spark lists the folders (in parallel beyond a few) and sums in one aggregation, so no file name comes to the driver's Python.
    """
    parts = None
    for name, path in paths.items():
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        part = files.select(F.lit(name).alias("name"), "length", F.xxhash64("path", "modificationTime", "length").cast("decimal(20,0)").alias("hash"))
        parts = part if parts is None else parts.unionByName(part)
    rows = parts.groupBy("name").agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.sum("hash").alias("sum")).collect()
    found = {r["name"]: [r["files"], r["bytes"], str(r["sum"])] for r in rows}
    return {name: found.get(name, [0, 0, "0"]) for name in paths}


def committed(spark: SparkSession, path: str) -> bool:
    """True when a Parquet write to ``path`` completed (its job commit left the ``_SUCCESS`` marker)."""
    return exists(spark, f"{path}/_SUCCESS")
