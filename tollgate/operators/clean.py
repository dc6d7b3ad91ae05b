"""Cleaning. Everything but dedup is narrow and works on streams too."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, TimestampNTZType, TimestampType

from ..spec import DatasetSpec, Rule

CORRUPT = "_corrupt"
BROKEN = "_rules"
STATUS = "_status"
RAW = "_raw"
LOAD = "load_id"


def _cast(field, spec: DatasetSpec) -> Column:
    fmt = spec.formats.get(field.name)
    if fmt and isinstance(field.dataType, (TimestampType, TimestampNTZType)):
        stamp = F.try_to_timestamp(F.col(field.name), F.lit(fmt))
        return stamp.cast(field.dataType)
    return F.col(field.name).try_cast(field.dataType)


def cast_columns(df: DataFrame, spec: DatasetSpec, failures: str | None = None) -> DataFrame:
    """String columns to their declared types; text that does not fit gives null.

    With ``failures``, the names of the columns that held such text are kept in an
    array column of that name.
    """
    held = {f.name: f.dataType for f in df.schema}
    casts = {
        f.name: _cast(f, spec)
        for f in spec.schema
        if isinstance(held.get(f.name), StringType) and not isinstance(f.dataType, StringType)
    }
    out = [casts[c].alias(c) if c in casts else F.col(c) for c in df.columns]
    if failures:
        lost = [F.when(F.col(c).isNotNull() & x.isNull(), F.lit(c)) for c, x in casts.items()]
        names = F.array_compact(F.array(*lost)) if lost else F.array().cast("array<string>")
        out.append(names.alias(failures))
    return df.select(*out)


def null_policy(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """C4: fill the columns that have a default, then drop rows missing a required one."""
    filled = fill_nulls(df, spec)
    return filled.na.drop(subset=list(spec.required)) if spec.required else filled


def fill_nulls(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    return df.na.fill(dict(spec.fill)) if spec.fill else df


def tag_rejects(df: DataFrame, rules: Iterable[Rule], into: str = BROKEN) -> DataFrame:
    """The names of the rules each row breaks; empty for a good row."""
    broken = [F.when(~F.coalesce(r.test(), F.lit(True)), F.lit(r.name)) for r in rules]
    names = F.array_compact(F.array(*broken)) if broken else F.array().cast("array<string>")
    return df.withColumn(into, names)


def tag(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Typed, filled rows with the rules they broke and ``_status`` kept or rejected.

    A rejected row keeps its fields as they came in, as JSON in ``_raw``.
    """
    present = [c for c in (*spec.columns, CORRUPT) if c in df.columns]
    raw = df.withColumn(RAW, F.to_json(F.struct(*present)))
    typed = fill_nulls(cast_columns(raw, spec, failures="_uncast"), spec)
    rules = [
        Rule(f"null:{c}", lambda c=c: F.col(c).isNotNull() | F.array_contains("_uncast", c))
        for c in spec.required
    ]
    if CORRUPT in df.columns:
        rules.insert(0, Rule("corrupt", lambda: F.col(CORRUPT).isNull()))
    checked = tag_rejects(typed, [*rules, *spec.rules])
    uncast = F.transform("_uncast", lambda c: F.concat(F.lit("cast:"), c))
    checked = checked.withColumn(BROKEN, F.concat(uncast, F.col(BROKEN)))
    bad = F.size(BROKEN) > 0
    return checked.withColumns(
        {
            STATUS: F.when(bad, F.lit("rejected")).otherwise(F.lit("kept")),
            RAW: F.when(bad, F.col(RAW)),
        }
    ).drop("_uncast", CORRUPT)


def clean(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    """Kept rows, and rejected rows with their broken rules.

    The two are filters over one plan. A job that stores both writes ``tag`` once,
    partitioned by status, instead of reading the raw text twice.
    """
    tagged = tag(df, spec)
    kept = tagged.filter(F.col(STATUS) == "kept").drop(BROKEN, STATUS, RAW)
    rejected = tagged.filter(F.col(STATUS) == "rejected").drop(STATUS)
    return kept, rejected


def dedup(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``, which must be total to be repeatable.

    Spark limits each key to one row before the shuffle as well, so copies of one
    hot key are dropped where they are read.
    """
    first = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", first).filter(F.col("_rank") == 1).drop("_rank")


def last_loaded(spec: DatasetSpec) -> list[Column]:
    """The order in which the last loaded row of a key comes first.

    Newest load, then newest event, then by value. Load ids begin with the time of the
    load, so those of two checkpoints are in order too. The export, training and what is
    held out all take this order, and so the same row of each key.
    """
    named = {spec.event_time, *spec.key}
    newest = [F.desc("load_date"), F.desc(LOAD)]
    newest += [F.desc(spec.event_time)] if spec.event_time else []
    return newest + [F.asc(c) for c in spec.columns if c not in named]


def dedup_stream(df: DataFrame, keys: Sequence[str], event_time: str, delay: str) -> DataFrame:
    """C6 on streams: one row per key, forgotten ``delay`` after its event time.

    Rows later than the watermark are dropped; the load log counts them.
    """
    return df.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def clean_report(tagged: DataFrame) -> DataFrame:
    """Rows in, kept, rejected, and per broken rule, in one pass."""
    kept = F.array(F.lit("rows_in"), F.lit("rows_kept"))
    rejected = F.concat(F.array(F.lit("rows_in"), F.lit("rows_rejected")), F.col(BROKEN))
    counted = F.explode(F.when(F.col(STATUS) == "kept", kept).otherwise(rejected))
    return tagged.select(counted.alias("rule")).groupBy("rule").agg(F.count("*").alias("n"))


def observe_clean(tagged: DataFrame, name: str, rules: Sequence[str] = ()) -> DataFrame:
    """C7 on streams: the same counts as observed metrics of every micro-batch.

    They are in the progress report under ``name``. An Observation object would
    give the session a part that cannot be sent to tasks with a fresh model.
    """
    counts = [
        F.count("*").alias("rows_in"),
        F.count_if(F.col(STATUS) == "kept").alias("rows_kept"),
        F.count_if(F.col(STATUS) == "rejected").alias("rows_rejected"),
    ]
    counts += [F.count_if(F.array_contains(BROKEN, r)).alias(r) for r in rules]
    return tagged.observe(name, *counts)


def observed_report(spark: SparkSession, progress: Iterable, name: str) -> DataFrame:
    """C7 on streams: the report of the micro-batches in ``progress``, from what
    `observe_clean` counted; nothing is read again. A rule that no row broke is left out.

    Spark counts a task that ran twice, after a lost executor, twice. Where a report
    must be exact under losses, read the load's own partitions (`prepare` does).
    """
    counts: dict[str, int] = {}
    for p in progress:
        observed = p.observedMetrics.get(name)
        for rule, n in observed.asDict().items() if observed else ():
            counts[rule] = counts.get(rule, 0) + n
    kept = [(rule, n) for rule, n in counts.items() if n or rule.startswith("rows_")]
    return spark.createDataFrame(kept, "rule string, n bigint")
