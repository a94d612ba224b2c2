"""Bucketed, sorted Parquet tables: written once, then joined, grouped and windowed by their keys without a shuffle or sort.

Rows are hashed to ``buckets`` tasks by the keys, and each task writes its bucket as one sorted file. Spark plans scans of
such a table with the bucketing as partitioning and, with ``ORDERED_SCAN`` on, the files' order as ordering. The
table is external (its files stay where ``path`` says); its catalog entry lasts until ``forget``.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from stockroom.sources import files

#: Lets a scan of one file a bucket count as sorted.
ORDERED_SCAN = "spark.sql.legacy.bucketedTableScan.outputOrdering"


def _name() -> str:
    return f"stockroom_{uuid.uuid4().hex}"


def save_bucketed(df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str], buckets: int, compression: str = "zstd") -> DataFrame:
    """Write ``df`` bucketed by ``by`` and sorted by ``sort`` within buckets; returns the table read from it.

    A bucket is one task: use it where the rows of one key are bounded.
    """
    spark = df.sparkSession
    files.delete(spark, path)  # of an interrupted write
    files.write_text(spark, f"{path}.buckets", json.dumps({"by": list(by), "sort": list(sort), "buckets": buckets, "schema": df.schema.toDDL()}))
    spark.conf.set(ORDERED_SCAN, "true")
    writer = df.repartition(buckets, *by).write.format("parquet").option("path", path).option("compression", compression)
    name = _name()
    writer.bucketBy(buckets, *by).sortBy(*sort).saveAsTable(name)
    return spark.table(name)


def load_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table that an earlier session wrote to ``path``."""
    spec = files.read_json(spark, f"{path}.buckets")
    if spec is None:
        raise FileNotFoundError(f"{path}.buckets")
    quoted = {k: ", ".join(f"`{c}`" for c in spec[k]) for k in ("by", "sort")}
    spark.conf.set(ORDERED_SCAN, "true")
    name, place = _name(), path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE {name} ({spec['schema'].replace(' NOT NULL', '')}) USING parquet "
        f"CLUSTERED BY ({quoted['by']}) SORTED BY ({quoted['sort']}) INTO {spec['buckets']} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)


def forget(spark: SparkSession, *paths: str) -> None:
    """Drop the catalog entries of tables below these paths; the files stay."""
    wanted = [p.rstrip("/") + "/" for p in paths]
    for table in spark.catalog.listTables():
        if table.name.startswith("stockroom_"):
            rows = spark.sql(f"DESCRIBE TABLE EXTENDED `{table.name}`").where("col_name = 'Location'").collect()
            place = rows[0]["data_type"].removeprefix("file:") + "/" if rows else ""
            if any(place.startswith(w.removeprefix("file://").removeprefix("file:")) for w in wanted):
                spark.sql(f"DROP TABLE IF EXISTS `{table.name}`")
