"""Raw text in, partitioned Parquet out."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..operators.clean import BROKEN, CORRUPT, LOAD, RAW, STATUS, cast_columns, tag
from ..spec import DatasetSpec
from .logs import read_log
from .markers import read_line, switch

# A manifest of at most this many paths (some 200 bytes each) is broadcast.
MANIFEST_BROADCAST_ROWS = 100_000

# By default a file stream leaves out files a week older than the newest one.
ANY_AGE = "36500d"
_MOMENT = "%Y%m%dT%H%M%S%f"
_MANIFEST = "file_path string, load bigint"


def scan_text(spark: SparkSession, path: str, spec: DatasetSpec, stream: bool = False, **options):
    """S1, untyped: one string per field, wrong field counts in ``_corrupt``.

    Fields are cast later by C2, so that a reject can name the column at fault.
    The reader must see whole lines: with column pruning on, whether a line counts
    as corrupt would depend on the columns the query happens to use.
    """
    fields = [StructField(f.name, StringType()) for f in spec.schema]
    schema = StructType([*fields, StructField(CORRUPT, StringType())])
    reader = spark.readStream if stream else spark.read
    return (
        reader.schema(schema)
        .options(sep=spec.delimiter, quote=spec.quote, escape=spec.escape, header=spec.header)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("columnPruning", "false")
        .options(**options)
        .csv(path)
    )


def scan_lines(spark: SparkSession, path: str, spec: DatasetSpec, into: str) -> DataFrame:
    """S1, untyped, like `scan_text`, with each line as it stands in the file in ``into``.

    Lines are read as text and parsed from there. A record is one line: a quoted field
    may hold the delimiter, but no line end. With ``header`` in the spec, lines that are
    the column names are left out, as are blank ones.
    """
    line = F.col("value")
    lines = spark.read.text(path).filter(F.trim(line) != "")
    if spec.header:
        lines = lines.filter(line != spec.delimiter.join(spec.columns))
    names = [*spec.columns, CORRUPT]
    options = {
        "sep": spec.delimiter, "quote": spec.quote, "escape": spec.escape,
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT,
    }
    parsed = F.from_csv(line, ", ".join(f"`{c}` string" for c in names), options)
    return lines.select(parsed.alias("_r"), line.alias(into)).select(
        *[F.col("_r").getField(c).alias(c) for c in names], into
    )


def read_raw(spark: SparkSession, path: str, spec: DatasetSpec) -> DataFrame:
    """Typed rows; a line that does not parse is in ``_corrupt``, unchanged."""
    typed = cast_columns(scan_lines(spark, path, spec, "_line"), spec, failures="_uncast")
    bad = F.col(CORRUPT).isNotNull() | (F.size("_uncast") > 0)
    return typed.select(*spec.columns, F.when(bad, F.col("_line")).alias(CORRUPT))


def load_new(
    spark: SparkSession,
    path: str,
    spec: DatasetSpec,
    checkpoint: str,
    out: str,
    max_files: int | None = 10_000,
) -> list[str]:
    """Clean the files not loaded before and add them to ``out``, then stop.

    Kept and rejected rows go to one table under ``_status``, so each raw line is
    parsed once. The checkpoint records the files read, however old they are. A
    load of at most ``max_files`` files has an id, made of the checkpoint's own id
    and the batch, and is a partition of the table: a load that is tried again
    replaces what its first try has left, and another checkpoint's loads stay
    apart. Ids begin with the time of the first try, so they are in order of time over
    all checkpoints. Returns the ids of the loads made.
    """
    options = {"maxFileAge": ANY_AGE}
    if max_files is not None:
        options["maxFilesPerTrigger"] = max_files
    raw = scan_text(spark, path, spec, stream=True, **options)
    tagged = with_partition_columns(tag(raw, spec), spec)
    done: list[str] = []

    def store(batch: DataFrame, number: int) -> None:
        load_id, day = _first_try(spark, checkpoint, number)
        rows = batch.withColumns({"load_date": F.lit(day), LOAD: F.lit(load_id)})
        write_clean(rows, out, [STATUS, "load_date", LOAD, *spec.partition_cols])
        done.append(load_id)

    query = (
        tagged.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done


def _checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gave the query when it made the checkpoint; a reset checkpoint,
    whose batches start at 0 again, has another."""
    return spark.read.json(f"{checkpoint.rstrip('/')}/metadata").first()["id"]


def _first_try(spark: SparkSession, checkpoint: str, number: int) -> tuple[str, date]:
    """Id and day of a load, the same at every try: its time is kept in the checkpoint."""
    mark = f"{checkpoint.rstrip('/')}/loads/{number:08d}"
    began = read_line(spark, mark)
    if began is None:
        began = datetime.now(timezone.utc).strftime(_MOMENT)
        switch(spark, mark, began)
    day = datetime.strptime(began, _MOMENT).date()
    return f"{began}-{_checkpoint_id(spark, checkpoint)}-{number:08d}", day


def clean_schema(spark: SparkSession, spec: DatasetSpec) -> StructType:
    """The columns of a table that ``load_new`` writes. Partition columns are declared
    too: from folder names alone, ``001`` would be read as a number."""
    empty = spark.createDataFrame([], spec.schema)
    derived = with_partition_columns(empty, spec).schema
    added = StructType().add(RAW, "string").add(BROKEN, ArrayType(StringType())).add(STATUS, "string")
    return StructType([*derived, *added.add("load_date", "date").add(LOAD, "string")])


def read_clean(
    spark: SparkSession, spec: DatasetSpec, path: str, since: date | None = None,
    loads: Sequence[str] | None = None,
) -> DataFrame:
    """The table that ``load_new`` writes; rows loaded on or after ``since``, or by ``loads``.

    Only the folders of those days and loads are listed, not the whole table.
    """
    schema = clean_schema(spark, spec)
    if since is None and loads is None:
        return spark.read.schema(schema).parquet(path)
    folders = _folders(spark, f"{path}/{STATUS}=*/load_date=*")
    if since is not None:
        folders = [f for f in folders if date.fromisoformat(f[-10:]) >= since]
    if loads is not None:
        days = {datetime.strptime(x.split("-")[0], _MOMENT).date().isoformat() for x in loads}
        own = [f for f in folders if f[-10:] in days]
        folders = [f"{f}/{LOAD}={x}" for f in own for x in loads]
        folders = [found for f in folders for found in _folders(spark, f)]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(*folders)


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return [f.getPath().toString() for f in found or ()]


def with_partition_columns(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return df.withColumns({c: F.expr(e) for c, e in spec.partition_exprs.items()})


def write_clean(
    df: DataFrame, path: str, partition_cols: Sequence[str] = (), rebalance: bool = True
) -> None:
    """S3: replace the partitions present in ``df``, leave the others as they are.

    The rebalance hint gathers each partition's rows into files of the advisory
    size; adaptive execution splits a partition that holds much of the data.
    """
    if rebalance:
        df = df.hint("rebalance", *[F.col(c) for c in partition_cols])
    writer = df.write.mode("overwrite")
    if partition_cols:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
    writer.parquet(path)


def _small(df: DataFrame, rows: int) -> bool:
    return df.limit(rows + 1).count() <= rows


def anti_manifest(df: DataFrame, manifest: DataFrame, max_broadcast: int | None = None) -> DataFrame:
    """Rows of ``df`` whose source file is not listed in ``manifest(file_path)``.

    Above the broadcast limit the join is left to adaptive execution, which can
    split the rows of one large file over several tasks.
    """
    limit = MANIFEST_BROADCAST_ROWS if max_broadcast is None else max_broadcast
    seen = manifest.select("file_path").distinct()
    if _small(seen, limit):
        seen = F.broadcast(seen)
    tagged = df.withColumn("file_path", F.col("_metadata.file_path"))
    return tagged.join(seen, "file_path", "left_anti")


def new_files(
    spark: SparkSession, path: str, manifest: DataFrame, limit: int | None = None
) -> list[str]:
    """Paths under ``path`` that are not in the manifest, without reading them.

    Opening only these is cheaper than J2 on rows, which scans every old file. With a
    ``limit``, the first of them in order of their names.
    """
    listed = spark.read.format("binaryFile").load(path)
    listed = listed.select("path", F.col("_metadata.file_path").alias("file_path"))
    fresh = listed.join(manifest.select("file_path").distinct(), "file_path", "left_anti")
    if limit is not None:
        fresh = fresh.orderBy("path").limit(limit)
    return [r.path for r in fresh.toLocalIterator()]


def load_unlisted(
    spark: SparkSession, path: str, spec: DatasetSpec, manifest: str, out: str, max_files: int = 10_000
) -> list[str]:
    """J2 by file: clean the files that ``manifest`` does not list and add them to ``out``.

    A batch load for stores where a stream cannot keep a checkpoint. Old files are not
    opened. At most ``max_files`` paths are held at a time: they are listed in the
    manifest first, as one load; then they are loaded, and then the load is marked as
    done. A load that is listed and not done is made again, into the same partition.
    Returns the ids of the loads made. One writer for each manifest.
    """
    done = []
    while True:
        number = int(read_line(spark, f"{manifest}/_last") or -1) + 1
        listed = read_log(spark, f"{manifest}/files", _MANIFEST)
        names = [r.file_path for r in listed.filter(F.col("load") == number).toLocalIterator()]
        if not names:
            names = new_files(spark, path, listed, max_files)
            if not names:
                return done
            files = spark.read.format("binaryFile").load(names).select(F.col("_metadata.file_path").alias("file_path"))
            rows = files.withColumn("load", F.lit(number).cast("long"))
            rows.coalesce(1).write.mode("append").parquet(f"{manifest}/files")
        else:  # listed as URIs
            jvm = spark._jvm
            names = [jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(n)).toString() for n in names]
        mark = f"{manifest}/loads/{number:08d}"
        began = read_line(spark, mark) or datetime.now(timezone.utc).strftime(_MOMENT)
        switch(spark, mark, began)
        load_id, day = f"{began}-manifest-{number:08d}", datetime.strptime(began, _MOMENT).date()
        tagged = with_partition_columns(tag(scan_text(spark, names, spec), spec), spec)
        rows = tagged.withColumns({"load_date": F.lit(day), LOAD: F.lit(load_id)})
        write_clean(rows, out, [STATUS, "load_date", LOAD, *spec.partition_cols])
        switch(spark, f"{manifest}/_last", str(number))
        done.append(load_id)
