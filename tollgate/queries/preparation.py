"""Queries on loading and cleaning: S1-S3, C1-C7, J2, P1."""

from __future__ import annotations

from dataclasses import replace
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import (
    clean,
    clean_report,
    dedup,
    null_policy,
    observe_clean,
    observed_report,
    tag,
)
from ..plans.prepare import export_latest, latest, prepare, write_latest
from ..session import scratch, spread, stored
from ..sources.exports import drop_old_exports, switch_export
from ..sources.files import (
    anti_manifest,
    load_new,
    load_unlisted,
    read_clean,
    read_raw,
    scan_text,
    write_clean,
)
from ..sources.markers import read_line, switch
from ..spec import DatasetSpec
from .data import CUSTOMERS, EVENTS, ORDERS, seconds, table

QUERIES = {}
ORACLES = {}


def _as_text(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Fields joined to lines; a null becomes an empty field."""
    fields = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in spec.columns]
    return df.select("*", F.concat_ws(spec.delimiter, *fields).alias("line"))


# Orders below this price are spoilt, each priority's in its own way; orders above
# the other one lose their priority, which has a default.
_SPOILT_BELOW = 11_000
_BARE_ABOVE = 490_000
_PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def _fault(kind: int) -> Column:
    spoilt = F.col("o_totalprice") < _SPOILT_BELOW
    return spoilt & (F.col("o_orderpriority") == _PRIORITIES[kind])


def _fault_sql(kind: int) -> str:
    return f"(o_totalprice < {_SPOILT_BELOW} AND o_orderpriority = '{_PRIORITIES[kind]}')"


def dirty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All orders as text fields, some with a fault."""
    price = F.col("o_totalprice").cast("string")
    spoilt = {
        "o_orderdate": F.when(_fault(0), "notatime").otherwise(seconds("o_orderdate")),
        "o_totalprice": F.when(_fault(1), F.concat(F.lit("x"), price))
        .when(_fault(3), F.concat(F.lit("-"), price))
        .otherwise(price),
        "o_custkey": F.when(~_fault(2), F.col("o_custkey")),
        "o_orderstatus": F.when(_fault(4), "X").otherwise(F.col("o_orderstatus")),
        "o_orderpriority": F.when(F.col("o_totalprice") <= _BARE_ABOVE, F.col("o_orderpriority")),
    }
    orders = table(spark, sf_dir, "orders")
    return orders.select(
        *[spoilt.get(c, F.col(c)).cast("string").alias(c) for c in ORDERS.columns]
    )


def raw_scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as text, some lines broken in one of four ways."""
    lines = _as_text(table(spark, sf_dir, "orders"), ORDERS)
    line = F.col("line")
    broken = (
        F.when(_fault(0), F.replace(line, seconds("o_orderdate"), F.lit("notatime")))
        .when(_fault(1), F.concat(F.lit("x"), line))
        .when(_fault(2), F.substring_index(line, ORDERS.delimiter, 3))
        .when(_fault(3), F.concat(line, F.lit("|extra")))
        .otherwise(line)
    )
    path = scratch(spark, "orders-text")
    lines.select(broken.alias("value")).write.text(path)
    typed = read_raw(spark, path, ORDERS)
    return typed.select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_totalprice",
        seconds("o_orderdate").alias("o_orderdate"),
        "o_orderpriority",
        F.col("_corrupt").isNotNull().cast("int").alias("is_corrupt"),
    )


QUERIES["raw_scan_typed"] = raw_scan_typed
ORACLES["raw_scan_typed"] = f"""
SELECT CASE WHEN {_fault_sql(1)} THEN NULL ELSE o_orderkey END AS o_orderkey,
       o_custkey, o_orderstatus,
       CASE WHEN {_fault_sql(2)} THEN NULL ELSE o_totalprice END AS o_totalprice,
       CASE WHEN {_fault_sql(0)} OR {_fault_sql(2)} THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate,
       CASE WHEN {_fault_sql(2)} THEN NULL ELSE o_orderpriority END AS o_orderpriority,
       CASE WHEN o_totalprice < {_SPOILT_BELOW} AND o_orderpriority <> '5-LOW' THEN 1 ELSE 0 END
       AS is_corrupt
FROM orders"""


def _order_columns() -> list:
    return [seconds(c).alias(c) if c == "o_orderdate" else F.col(c) for c in ORDERS.columns]


def clean_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that pass."""
    kept, _ = clean(dirty_orders(spark, sf_dir), ORDERS)
    return kept.select(*_order_columns())


_FILLED = f"CASE WHEN o_totalprice > {_BARE_ABOVE} THEN '3-MEDIUM' ELSE o_orderpriority END"
QUERIES["clean_kept"] = clean_kept
ORACLES["clean_kept"] = f"""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,
       strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate,
       {_FILLED} AS o_orderpriority
FROM orders WHERE o_totalprice >= {_SPOILT_BELOW}"""


def clean_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that fail, with the rules they broke and their raw fields."""
    _, rejected = clean(dirty_orders(spark, sf_dir), ORDERS)
    return rejected.select(
        *_order_columns(),
        F.array_join("_rules", ",").alias("rules"),
        F.get_json_object("_raw", "$.o_orderkey").alias("raw_key"),
    )


_RULE_SQL = f"""CASE WHEN {_fault_sql(0)} THEN 'cast:o_orderdate'
            WHEN {_fault_sql(1)} THEN 'cast:o_totalprice'
            WHEN {_fault_sql(2)} THEN 'null:o_custkey'
            WHEN {_fault_sql(3)} THEN 'price_range'
            WHEN {_fault_sql(4)} THEN 'status_domain' END"""
QUERIES["clean_rejected"] = clean_rejected
ORACLES["clean_rejected"] = f"""
SELECT o_orderkey,
       CASE WHEN {_fault_sql(2)} THEN NULL ELSE o_custkey END AS o_custkey,
       CASE WHEN {_fault_sql(4)} THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN {_fault_sql(1)} THEN NULL WHEN {_fault_sql(3)} THEN -o_totalprice
            ELSE o_totalprice END AS o_totalprice,
       CASE WHEN {_fault_sql(0)} THEN NULL
            ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS o_orderdate,
       o_orderpriority, {_RULE_SQL} AS rules, CAST(o_orderkey AS VARCHAR) AS raw_key
FROM orders WHERE o_totalprice < {_SPOILT_BELOW}"""


def clean_report_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in, kept, rejected and per rule."""
    return clean_report(tag(dirty_orders(spark, sf_dir), ORDERS))


QUERIES["clean_report"] = clean_report_query
ORACLES["clean_report"] = f"""
WITH r AS (SELECT o_orderkey, {_RULE_SQL} AS rule FROM orders)
SELECT 'rows_in' AS rule, count(*) AS n FROM r
UNION ALL SELECT 'rows_kept', count(*) FROM r WHERE rule IS NULL
UNION ALL SELECT 'rows_rejected', count(*) FROM r WHERE rule IS NOT NULL
UNION ALL SELECT rule, count(*) FROM r WHERE rule IS NOT NULL GROUP BY rule"""


def null_policy_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4: defaults filled in, rows without a required value dropped."""
    filled = null_policy(dirty_orders(spark, sf_dir), ORDERS)
    return filled.select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority")


QUERIES["null_policy"] = null_policy_query
ORACLES["null_policy"] = f"""
SELECT o_orderkey, {_FILLED} AS o_orderpriority FROM orders WHERE NOT {_fault_sql(2)}"""

_LINEITEM_REST = [
    "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of the line items with one order and line number, the last shipped."""
    order = [F.desc("l_shipdate"), *[F.asc(c) for c in _LINEITEM_REST]]
    latest = dedup(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"], order)
    return latest.withColumn("l_shipdate", seconds("l_shipdate"))


QUERIES["dedup_latest"] = dedup_latest
ORACLES["dedup_latest"] = f"""
SELECT l_orderkey, l_linenumber, {", ".join(_LINEITEM_REST)},
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC, {", ".join(_LINEITEM_REST)}) = 1"""

# Events arrive in three drops.
_DROPS = (("click", "purchase"), ("view", "signup"), ("error",))


def _drop(events: DataFrame, kinds: tuple[str, ...], path: str) -> None:
    lines = _as_text(events.filter(F.col("event_type").isin(*kinds)), EVENTS)
    lines.select("line").write.mode("append").text(path)


def _event_columns() -> list:
    return ["event_id", "user_id", "event_type", "value", seconds("ts").alias("ts")]


_EVENTS_SQL = """
SELECT event_id, user_id, event_type, value, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts{more}
FROM events"""


def load_new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load after each drop and one with nothing new; every event once."""
    events = table(spark, sf_dir, "events")
    raw, checkpoint, out = (scratch(spark, f"events-{n}") for n in ("raw", "loads", "clean"))
    for kinds in _DROPS:
        _drop(events, kinds, raw)
        load_new(spark, raw, EVENTS, checkpoint, out)
    load_new(spark, raw, EVENTS, checkpoint, out)
    loaded = spark.read.parquet(out).filter("_status = 'kept'")
    return loaded.select(*_event_columns(), F.col("event_date").cast("string").alias("event_date"))


QUERIES["load_new_files"] = load_new_files
ORACLES["load_new_files"] = _EVENTS_SQL.format(
    more=", strftime(ts, '%Y-%m-%d') AS event_date"
)


def load_late_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second drop bears a time stamp of a month before the first one's."""
    events = table(spark, sf_dir, "events")
    raw, late = scratch(spark, "events-raw"), scratch(spark, "events-late")
    checkpoint, out = scratch(spark, "events-loads"), scratch(spark, "events-clean")
    _drop(events, _DROPS[0], raw)
    load_new(spark, raw, EVENTS, checkpoint, out)
    for kinds in _DROPS[1:]:
        _drop(events, kinds, late)
    files = spark.read.text(late).select("_metadata.file_path", "_metadata.file_name")
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for r in files.distinct().collect():
        old = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r.file_path))
        new = jvm.org.apache.hadoop.fs.Path(f"{raw}/late-{r.file_name}")
        system = old.getFileSystem(conf)
        system.rename(old, new)
        month = 30 * 86_400_000
        system.setTimes(new, system.getFileStatus(new).getModificationTime() - month, -1)
    load_new(spark, raw, EVENTS, checkpoint, out)
    return read_clean(spark, EVENTS, out).filter("_status = 'kept'").select(*_event_columns())


QUERIES["load_late_files"] = load_late_files
ORACLES["load_late_files"] = _EVENTS_SQL.format(more="")


def load_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw folders with a checkpoint each fill one table; a checkpoint that was
    lost loads its folder once more."""
    events = table(spark, sf_dir, "events")
    out = scratch(spark, "events-clean")
    for kinds in _DROPS:
        raw = scratch(spark, "events-raw")
        _drop(events, kinds, raw)
        load_new(spark, raw, EVENTS, scratch(spark, "events-loads"), out)
    load_new(spark, raw, EVENTS, scratch(spark, "events-loads"), out)
    loaded = read_clean(spark, EVENTS, out).filter("_status = 'kept'")
    return loaded.groupBy("event_type").agg(
        F.count("*").alias("n"), F.count_distinct("load_id").alias("loads")
    )


QUERIES["load_two_sources"] = load_two_sources
ORACLES["load_two_sources"] = """
SELECT event_type, count(*) * CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS n,
       CASE WHEN event_type = 'error' THEN 2 ELSE 1 END AS loads
FROM events GROUP BY event_type"""

_MOVED = """CASE WHEN o_orderpriority = '1-URGENT'
            THEN CASE o_orderstatus WHEN 'F' THEN 'O' WHEN 'O' THEN 'P' END ELSE o_orderstatus END"""


def export_latest_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded twice. The second time urgent orders have another status, or
    none, and so another partition."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", seconds("o_orderdate"))
    raw, checkpoint = scratch(spark, "orders-raw"), scratch(spark, "orders-loads")
    clean_path, out = scratch(spark, "orders-clean"), scratch(spark, "orders-export")
    urgent = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.expr(_MOVED))
    for rows in (orders, urgent):
        _as_text(rows, ORDERS).select("line").write.mode("append").text(raw)
        prepare(spark, ORDERS, raw, checkpoint, clean_path)
        export_latest(spark, ORDERS, clean_path, out, date(2000, 1, 1))
    return latest(spark, ORDERS, out).select("o_orderkey", "o_totalprice", "o_orderstatus")


QUERIES["export_latest"] = export_latest_query
ORACLES["export_latest"] = f"""
SELECT o_orderkey, o_totalprice, {_MOVED} AS o_orderstatus FROM orders"""


def export_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: a second export that is written and not yet switched to leaves the table as it
    was; after the switch, keys that moved have left their old partitions. Folders that
    no map names any more are deleted, and nothing else."""
    orders = table(spark, sf_dir, "orders").withColumn("o_orderdate", seconds("o_orderdate"))
    raw, checkpoint = scratch(spark, "orders-raw"), scratch(spark, "orders-loads")
    clean_path, out = scratch(spark, "orders-clean"), scratch(spark, "orders-export")
    urgent = orders.filter("o_orderpriority = '1-URGENT'").withColumn("o_orderstatus", F.expr(_MOVED))
    day, seen = date(2000, 1, 1), []
    for rows in (orders, urgent):
        _as_text(rows, ORDERS).select("line").write.mode("append").text(raw)
        prepare(spark, ORDERS, raw, checkpoint, clean_path)
        export = write_latest(spark, ORDERS, clean_path, out, day)
        if seen:
            seen.append(latest(spark, ORDERS, out).withColumn("seen", F.lit("written")))
        switch_export(spark, out, export)
        seen.append(latest(spark, ORDERS, out).withColumn("seen", F.lit(f"export {len(seen) // 2 + 1}")))
    found = seen[0].unionByName(seen[1]).unionByName(seen[2])
    counted = found.groupBy("seen", "o_orderstatus").agg(
        F.count("*").alias("n"), F.count_distinct("o_orderkey").alias("keys"), F.round(F.sum("o_totalprice"), 2).alias("total")
    )
    counted = stored(counted, "snapshot-counts")
    drop_old_exports(spark, out, timedelta(0))
    return counted.withColumn("left_after", F.lit(latest(spark, ORDERS, out).count()).cast("long"))


QUERIES["export_snapshot"] = export_snapshot
ORACLES["export_snapshot"] = f"""
WITH seen AS (
    SELECT 'export 1' AS seen, o_orderstatus, o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT 'written', o_orderstatus, o_orderkey, o_totalprice FROM orders
    UNION ALL SELECT 'export 2', {_MOVED}, o_orderkey, o_totalprice FROM orders)
SELECT seen, o_orderstatus, count(*) AS n, count(DISTINCT o_orderkey) AS keys,
       round(sum(o_totalprice), 2) AS total, (SELECT count(*) FROM orders) AS left_after
FROM seen GROUP BY seen, o_orderstatus"""


def load_by_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first drop's files are in the manifest; rows of later files come out."""
    events = table(spark, sf_dir, "events")
    raw = scratch(spark, "events-raw")
    _drop(events, _DROPS[0], raw)
    manifest = spark.read.text(raw).select(F.col("_metadata.file_path").alias("file_path"))
    manifest_path = scratch(spark, "manifest")
    manifest.distinct().write.parquet(manifest_path)
    for kinds in _DROPS[1:]:
        _drop(events, kinds, raw)
    fresh = anti_manifest(scan_text(spark, raw, EVENTS), spark.read.parquet(manifest_path))
    kept, _ = clean(fresh, EVENTS)
    return kept.select(*_event_columns())


QUERIES["load_by_manifest"] = load_by_manifest
ORACLES["load_by_manifest"] = (
    _EVENTS_SQL.format(more="") + " WHERE event_type NOT IN ('click', 'purchase')"
)


def load_unlisted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J2 by file: each drop is loaded by a list of the files loaded before, two files at
    a time. A load whose end was lost is made again in its place; old files stay closed."""
    events = table(spark, sf_dir, "events")
    raw, manifest, out = (scratch(spark, f"events-{n}") for n in ("raw", "manifest", "clean"))
    for kinds in _DROPS:
        _drop(events.coalesce(3), kinds, raw)
        load_unlisted(spark, raw, EVENTS, manifest, out, max_files=2)
    switch(spark, f"{manifest}/_last", str(int(read_line(spark, f"{manifest}/_last")) - 1))
    load_unlisted(spark, raw, EVENTS, manifest, out, max_files=2)
    return read_clean(spark, EVENTS, out).filter("_status = 'kept'").select(*_event_columns())


QUERIES["load_unlisted_files"] = load_unlisted_files
ORACLES["load_unlisted_files"] = _EVENTS_SQL.format(more="")

_QUOTED = replace(ORDERS, header=True)


def raw_scan_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a header line and quoted fields that hold the delimiter; a line that
    does not parse comes back as it stands in the file."""
    orders = table(spark, sf_dir, "orders")
    when = F.when(_fault(0), "notatime").otherwise(seconds("o_orderdate"))
    priority = F.concat(F.lit('"'), "o_orderpriority", F.lit('|"'))
    line = F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("string"), when, priority)
    line = F.when(_fault(1), F.concat(F.lit('"'), line)).when(_fault(2), F.substring_index(line, "|", 3)).otherwise(line)
    path, head = scratch(spark, "orders-text"), "|".join(_QUOTED.columns)
    # the lower 33 bits of the id number a partition's rows: every file begins with the header
    begins = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
    value = F.when(begins, F.concat(F.lit(head + "\n"), "line")).otherwise(F.col("line"))
    for k in range(2):
        body = spread(orders.filter(F.col("o_orderkey") % 2 == k)).select(line.alias("line"))
        body.select(value.alias("value")).write.mode("append").text(path)
    return read_raw(spark, path, _QUOTED).select(
        "o_orderkey", "o_orderpriority", F.col("_corrupt").alias("line")
    )


QUERIES["raw_scan_lines"] = raw_scan_lines
ORACLES["raw_scan_lines"] = f"""
WITH written AS (
    SELECT *, concat_ws('|', o_orderkey, o_custkey, o_orderstatus, o_totalprice,
           CASE WHEN {_fault_sql(0)} THEN 'notatime' ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END,
           '"' || o_orderpriority || '|"') AS whole
    FROM orders)
SELECT CASE WHEN NOT {_fault_sql(1)} THEN o_orderkey END AS o_orderkey,
       CASE WHEN NOT {_fault_sql(1)} AND NOT {_fault_sql(2)} THEN o_orderpriority || '|' END AS o_orderpriority,
       CASE WHEN {_fault_sql(0)} THEN whole WHEN {_fault_sql(1)} THEN '"' || whole
            WHEN {_fault_sql(2)} THEN concat_ws('|', o_orderkey, o_custkey, o_orderstatus) END AS line
FROM written"""


def clean_report_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C7 on streams: the report of three micro-batches, counted while they were written;
    the clean table is not read. A batch is the files, however many, that are new since the
    stream last ran."""
    orders, raw = dirty_orders(spark, sf_dir), scratch(spark, "orders-raw")
    out, checkpoint = scratch(spark, "orders-clean"), scratch(spark, "orders-loads")
    rules = [f"cast:{c}" for c in ORDERS.columns] + [f"null:{c}" for c in ORDERS.required]
    rules += ["corrupt", *[r.name for r in ORDERS.rules]]
    progress = []
    for k in range(3):
        part = orders.filter(F.col("o_orderkey").cast("long") % 3 == k)
        _as_text(spread(part), ORDERS).select("line").write.mode("append").text(raw)
        tagged = tag(scan_text(spark, raw, ORDERS, stream=True), ORDERS)
        query = (
            observe_clean(tagged, "clean", rules).writeStream.format("parquet")
            .option("path", out).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start()
        )
        query.awaitTermination()
        progress += query.recentProgress
    return observed_report(spark, progress, "clean")


QUERIES["clean_report_stream"] = clean_report_stream
ORACLES["clean_report_stream"] = ORACLES["clean_report"]


def write_clean_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: all orders written by status, then one status written anew."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    path = scratch(spark, "orders-clean")
    write_clean(orders.withColumn("revision", F.lit(1)), path, ["o_orderstatus"])
    again = orders.filter("o_orderstatus = 'F'").withColumn("revision", F.lit(2))
    write_clean(again, path, ["o_orderstatus"])
    return spark.read.parquet(path)


QUERIES["write_clean_partitions"] = write_clean_partitions
ORACLES["write_clean_partitions"] = """
SELECT o_orderkey, o_totalprice, o_orderstatus,
       CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS revision
FROM orders"""


def second_dataset_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same cleaning on another dataset, all rows with status and rules."""
    tagged = tag(table(spark, sf_dir, "customer"), CUSTOMERS)
    return tagged.select(
        *CUSTOMERS.columns, F.col("_status").alias("status"), F.array_join("_rules", ",").alias("rules")
    )


QUERIES["second_dataset_clean"] = second_dataset_clean
ORACLES["second_dataset_clean"] = """
WITH r AS (
    SELECT *, concat_ws(',',
        CASE WHEN c_acctbal NOT BETWEEN 0 AND 9000 THEN 'balance_range' END,
        CASE WHEN c_nationkey NOT BETWEEN 0 AND 19 THEN 'nation_range' END,
        CASE WHEN c_mktsegment NOT IN ('AUTOMOBILE', 'BUILDING') THEN 'segment_domain' END) AS rules
    FROM customer)
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment,
       CASE WHEN rules = '' THEN 'kept' ELSE 'rejected' END AS status, rules
FROM r"""
