"""Specs of the given tables and the SQL that mirrors their features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import in_domain, in_range
from ..operators.features import attach_labels
from ..session import spread, tune
from ..spec import DatasetSpec, Rule, schema_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return tune(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def seconds(col: str):
    """A timestamp as text, so that engines cannot differ about its type."""
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


ORDERS = DatasetSpec(
    name="orders",
    schema=schema_of(
        o_orderkey="long",
        o_custkey="long",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderdate="timestamp_ntz",
        o_orderpriority="string",
    ),
    key=("o_orderkey",),
    event_time="o_orderdate",
    required=("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"),
    fill={"o_orderpriority": "3-MEDIUM"},
    rules=(
        Rule("price_range", lambda: in_range("o_totalprice", 0.0)),
        Rule("status_domain", lambda: in_domain("o_orderstatus", ["F", "O", "P"])),
    ),
    partition_cols=("o_orderstatus",),
    delimiter="|",
)

CUSTOMERS = DatasetSpec(
    name="customers",
    schema=schema_of(
        c_custkey="long",
        c_name="string",
        c_nationkey="integer",
        c_acctbal="double",
        c_mktsegment="string",
    ),
    key=("c_custkey",),
    required=("c_custkey", "c_name"),
    rules=(
        Rule("balance_range", lambda: in_range("c_acctbal", 0.0, 9_000.0)),
        Rule("nation_range", lambda: in_range("c_nationkey", 0, 19)),
        Rule("segment_domain", lambda: in_domain("c_mktsegment", ["AUTOMOBILE", "BUILDING"])),
    ),
)

EVENTS = DatasetSpec(
    name="events",
    schema=schema_of(
        event_id="long",
        ts="timestamp_ntz",
        user_id="long",
        event_type="string",
        value="double",
    ),
    key=("event_id",),
    event_time="ts",
    required=("event_id", "ts", "value"),
    rules=(Rule("value_range", lambda: in_range("value", 0.0)),),
    partition_cols=("event_date",),
    partition_exprs={"event_date": "to_date(ts)"},
    delimiter="|",
)

# A line item as a transaction; "returned" plays the part of the fraud mark.
LINEITEM = DatasetSpec(
    name="lineitem",
    schema=schema_of(
        l_orderkey="long",
        l_linenumber="integer",
        l_quantity="double",
        l_discount="double",
        l_tax="double",
        l_linestatus="string",
    ),
    key=("l_orderkey", "l_linenumber"),
    label="returned",
    label_expr="cast(l_returnflag = 'R' as int)",
    derived={"disc_pct": "l_discount * 100", "tax_pct": "l_tax * 100"},
    numeric=("l_quantity", "disc_pct", "tax_pct"),
    categorical=("l_linestatus",),
)
LINEITEM_COLUMNS = [*LINEITEM.columns, "l_returnflag"]
LINEITEM_FEATURES = """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS y,
           CASE WHEN l_linestatus = 'F' THEN 1e0 ELSE 0e0 END AS x1,
           CASE WHEN l_linestatus = 'O' THEN 1e0 ELSE 0e0 END AS x2,
           l_quantity AS x3, l_discount * 100 AS x4, l_tax * 100 AS x5
    FROM lineitem"""

# Texts marked as bad quality are the rare positive class: about one in seven.
# Features are characters of a kind per hundred; the patterns, fixed values, match
# runs of all other characters.
CHARACTER_KINDS = {
    "lower_pct": "[^a-z]+",
    "upper_pct": "[^A-Z]+",
    "digit_pct": "[^0-9]+",
    "stop_pct": "[^.,;:!?]+",
    "space_pct": "[^ ]+",
}


def _share(pattern: str, flags: str = "") -> str:
    kept = f"length(regexp_replace(text, '{pattern}', ''{flags}))"
    return f"1e2 * {kept} / greatest(length(text), 1)"


def documents_spec(kinds: tuple[str, ...], **changes) -> DatasetSpec:
    return DatasetSpec(
        name="documents",
        schema=schema_of(doc_id="long", text="string"),
        key=("doc_id",),
        label="bad",
        label_expr="cast(quality = 0 as int)",
        derived={k: _share(CHARACTER_KINDS[k]) for k in kinds},
        numeric=kinds,
        **changes,
    )


DOCUMENTS_PREV = documents_spec(("upper_pct", "stop_pct", "space_pct"))
DOCUMENTS_NEW = documents_spec(tuple(CHARACTER_KINDS))
DOCUMENTS = DOCUMENTS_NEW


def documents_sql(spec: DatasetSpec, table_name: str = "documents JOIN labels USING (doc_id)") -> str:
    xs = ", ".join(
        f"{_share(CHARACTER_KINDS[k], ', ' + chr(39) + 'g' + chr(39))} AS x{i}"
        for i, k in enumerate(spec.numeric, start=1)
    )
    return (
        f"SELECT doc_id, CASE WHEN quality = 0 THEN 1 ELSE 0 END AS y, {xs}, "
        f"{percent_sql('doc_id')} AS percent, {percent_sql('doc_id', word=1, buckets=3)} AS fold "
        f"FROM {table_name}"
    )


def labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return attach_labels(documents, labels, "doc_id")


def word_sql(text: str, word: str) -> str:
    """A 32-bit word of an md5 digest in the checking SQL."""
    return f"CAST('0x' || substr(md5({text}), 1 + 8 * {word}, 8) AS BIGINT)"


def percent_sql(key: str, word: int = 0, buckets: int = 100) -> str:
    return f"CAST({word_sql(f'CAST({key} AS VARCHAR)', str(word))} % {buckets} AS INTEGER)"


def bayes_sql(
    features: str, d: int, smoothing: str = "1e0", train: str = "TRUE", keep: str = "TRUE",
    name: str = "m",
) -> str:
    """CTEs that fit multinomial naive Bayes on ``train`` rows and score ``keep`` rows.

    ``{name}_scored`` has the feature query's columns and ``p``.
    """
    js = range(1, d + 1)
    sums = ", ".join(
        f"sum(CASE WHEN y = {c} THEN x{j} ELSE 0e0 END) AS s{c}_{j}" for c in (0, 1) for j in js
    )
    total = {c: " + ".join(f"s{c}_{j}" for j in js) for c in (0, 1)}
    theta = ", ".join(
        f"ln(s1_{j} + {smoothing}) - ln({total[1]} + {d} * {smoothing}) - ln(s0_{j} + {smoothing}) "
        f"+ ln({total[0]} + {d} * {smoothing}) AS t{j}"
        for j in js
    )
    logit = "prior" + "".join(f" + x{j} * t{j}" for j in js)
    return f"""
    {name}_features AS ({features}),
    {name}_sums AS (
        SELECT count(*) AS n, sum(y) AS n1, count(*) - sum(y) AS n0, {sums}
        FROM {name}_features WHERE {train}),
    {name}_model AS (
        SELECT ln(n1 + {smoothing}) - ln(n0 + {smoothing}) AS prior, {theta} FROM {name}_sums),
    {name}_scored AS (
        SELECT f.*, 1e0 / (1e0 + exp(-({logit}))) AS p
        FROM {name}_features f, {name}_model WHERE {keep})"""


def auc_sql(source: str, by: str, score: str = "p", label: str = "y", weight: str = "1") -> str:
    """Rank-sum ROC AUC with half counts for ties: columns ``by`` and ``auc``."""
    return f"""
    SELECT {by}, sum(pos * (below + 0.5e0 * neg)) / nullif(sum(pos) * sum(neg), 0e0) AS auc
    FROM (
        SELECT *, coalesce(sum(neg) OVER (PARTITION BY {by} ORDER BY {score}
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0e0) AS below
        FROM (
            SELECT {by}, {score}, CAST(sum({weight} * {label}) AS DOUBLE) AS pos,
                   CAST(sum({weight} * (1 - {label})) AS DOUBLE) AS neg
            FROM {source} GROUP BY {by}, {score}))
    GROUP BY {by}"""
