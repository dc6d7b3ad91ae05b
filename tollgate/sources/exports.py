"""S3: a table whose partitions are replaced together, by the switch of one line.

``data`` holds what exports have written, a folder each, ``maps`` a small table for each
export that names the folder of every partition that is live, and ``_current`` the id of
the map that counts. An export writes the partitions it touches to a new folder, then
the new map, and last switches the line. A reader sees the old table or the new one;
an export that fails before the switch has changed nothing.

The driver holds the folders of live partitions, as Spark's own file index does.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .files import _folders, write_clean
from .markers import read_line, remove, switch

EXPORT = "export_id"
_MOMENT = "%Y%m%dT%H%M%S%f"


def write_export(spark: SparkSession, rows: DataFrame, out: str, partition_cols: Sequence[str], replaced: DataFrame | None) -> str:
    """Write ``rows`` beside the live table and return the export's id; nothing is live yet.

    ``replaced`` holds the values of the partitions that the rows stand for; those
    without rows become empty. None replaces the whole table.
    """
    export = f"{datetime.now(timezone.utc).strftime(_MOMENT)}-{uuid.uuid4().hex[:12]}"
    folder = f"{out}/data/{EXPORT}={export}"
    write_clean(rows, folder, partition_cols)
    written = spark.read.schema(rows.schema).parquet(folder).select(*partition_cols, "_metadata.file_path")
    inside = F.regexp_extract("file_path", f"/data/({EXPORT}=.*)/[^/]*$", 1)
    live = written.select(*partition_cols, inside.alias("folder")).distinct()
    if replaced is not None and (last := read_line(spark, f"{out}/_current")):
        old = spark.read.schema(live.schema).parquet(f"{out}/maps/{last}")
        gone = replaced.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(partition_cols)])
        same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(partition_cols)]
        live = old.join(gone, same, "left_anti").unionByName(live)
    live.coalesce(1).write.parquet(f"{out}/maps/{export}")
    return export


def switch_export(spark: SparkSession, out: str, export: str) -> None:
    """Make an export that was written the live one."""
    switch(spark, f"{out}/_current", export)


def read_export(spark: SparkSession, out: str, schema: StructType) -> DataFrame:
    """The live table; empty before the first export. A folder cannot tell an empty text
    in a partition column from null: both come back as null."""
    last = read_line(spark, f"{out}/_current")
    if last is None:
        return spark.createDataFrame([], schema)
    live = spark.read.schema("folder string").parquet(f"{out}/maps/{last}")
    folders = [f"{out}/data/{unquote(r.folder)}" for r in live.toLocalIterator()]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{out}/data").parquet(*folders)


def drop_old_exports(spark: SparkSession, out: str, keep: timedelta) -> list[str]:
    """Delete what exports older than ``keep`` have left and no kept map names.

    The live map is kept, however old it is. ``keep`` must be longer than any reader or
    unfinished export takes. Returns the ids of the maps that were deleted.
    """
    last = read_line(spark, f"{out}/_current")
    bound = (datetime.now(timezone.utc) - keep).strftime(_MOMENT)
    maps = {f.rpartition("/")[2]: f for f in _folders(spark, f"{out}/maps/*")}
    old = sorted(name for name in maps if name < bound and name != last)
    kept = [maps[name] for name in maps if name not in old]
    named = spark.read.schema("folder string").parquet(*kept) if kept else spark.createDataFrame([], "folder string")
    for export in _folders(spark, f"{out}/data/{EXPORT}=*"):
        if export.rpartition("=")[2] >= bound:
            continue
        inside = f"{EXPORT}={export.rpartition('=')[2]}"
        live = named.filter(F.col("folder").startswith(inside)).distinct()
        if live.isEmpty():
            remove(spark, [export])
            continue
        found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(export)
        folder = F.regexp_extract("_metadata.file_path", f"/data/({EXPORT}=.*)/[^/]*$", 1).alias("folder")
        dead = found.select(folder).distinct().join(live, "folder", "left_anti")
        remove(spark, [f"{out}/data/{unquote(r.folder)}" for r in dead.toLocalIterator()])
    remove(spark, [maps[name] for name in old])
    return old
