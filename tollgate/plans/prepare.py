"""Load, clean and store new raw files; export one row per transaction."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.clean import BROKEN, RAW, STATUS, clean_report, dedup, last_loaded
from ..session import stored
from ..sources.exports import read_export, switch_export, write_export
from ..sources.files import clean_schema, load_new, read_clean
from ..spec import DatasetSpec


def prepare(
    spark: SparkSession,
    spec: DatasetSpec,
    raw_path: str,
    checkpoint: str,
    clean_path: str,
    since: date | None = None,
    max_files: int | None = 10_000,
) -> DataFrame:
    """Load what is new; returns the cleaning report of these loads, or of all rows loaded
    since ``since``. Only the partitions of what is reported are listed and read."""
    loads = load_new(spark, raw_path, spec, checkpoint, clean_path, max_files)
    return clean_report(read_clean(spark, spec, clean_path, since, loads if since is None else None))


def export_latest(
    spark: SparkSession, spec: DatasetSpec, clean_path: str, out: str, since: date
) -> None:
    """Write anew the partitions that the keys loaded since ``since`` are or were in.

    A partition gets the last loaded row of each key that now belongs to it, of old
    loads too. A key may move to another partition: the one it leaves is written as
    well, and is gone when nothing is left in it. All partitions switch at once, when
    all are written; `latest` reads the table.
    """
    switch_export(spark, out, write_latest(spark, spec, clean_path, out, since))


def write_latest(
    spark: SparkSession, spec: DatasetSpec, clean_path: str, out: str, since: date
) -> str:
    """The export without the switch; returns its id."""
    kept = read_clean(spark, spec, clean_path).filter(F.col(STATUS) == "kept").drop(STATUS, BROKEN, RAW)
    order = last_loaded(spec)
    if not spec.partition_cols:
        return write_export(spark, dedup(kept, list(spec.key), order), out, (), None)
    fresh = kept.filter(F.col("load_date") >= F.lit(since)).select(*spec.key).distinct()
    places = _semi(kept, fresh, spec.key).select(*spec.partition_cols).distinct()
    places = stored(places, "touched-partitions")
    # every row of each key that has one there, so that its last row is known
    keys = _semi(kept, places, spec.partition_cols).select(*spec.key).distinct()
    last = dedup(_semi(kept, keys, spec.key), list(spec.key), order)
    return write_export(spark, _semi(last, places, spec.partition_cols), out, spec.partition_cols, places)


def latest(spark: SparkSession, spec: DatasetSpec, out: str) -> DataFrame:
    """The table that `export_latest` keeps: one row per key."""
    columns = [f for f in clean_schema(spark, spec) if f.name not in (STATUS, BROKEN, RAW)]
    return read_export(spark, out, StructType(columns))


def _semi(df: DataFrame, other: DataFrame, columns) -> DataFrame:
    """Rows of ``df`` whose ``columns``, nulls too, are in ``other``."""
    other = other.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])
    same = [F.col(c).eqNullSafe(F.col(f"_{i}")) for i, c in enumerate(columns)]
    return df.join(other, same, "left_semi")
