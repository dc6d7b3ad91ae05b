"""K1 and K3: Kafka-shaped rows to typed rows and back."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

MESSAGES = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)
_BAD = "_bad_json"
#: A message's place in its source, under the names that results carry, and its own.
ORIGIN = {"source_topic": "topic", "source_partition": "partition", "source_offset": "offset"}


def ident(key: Sequence[str]) -> Column:
    """The key columns as one text. The sign between them and the escape sign are escaped
    inside, and a null is told from an empty text, so different keys differ."""
    parts = [
        F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"([#\\])", r"\\$1"), F.lit(r"\N"))
        for c in key
    ]
    return F.concat_ws("#", *parts)


def parse(df: DataFrame, schema: StructType) -> DataFrame:
    """Typed fields beside ``bad``, the original ``payload`` and the message's origin.

    A message is bad if it is empty, is not JSON, or has a field of another type.
    """
    full = StructType([*schema, StructField(_BAD, StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD}
    payload = F.col("value").cast("string")
    message = F.from_json(payload, full, options).alias("_m")
    origin = [F.col(c).alias(name) for name, c in ORIGIN.items() if c in df.columns]
    parsed = df.select(payload.alias("payload"), message, *origin)
    bad = F.col("_m").isNull() | F.col(f"_m.{_BAD}").isNotNull()
    fields = [F.col("_m")[f.name].alias(f.name) for f in schema]
    return parsed.select(*fields, F.coalesce(bad, F.lit(True)).alias("bad"), "payload", *[c for c in ORIGIN if c in parsed.columns])


def decode(df: DataFrame, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """K1: good messages as typed rows; bad ones as their ``payload``."""
    parsed = parse(df, schema)
    ok = parsed.filter(~F.col("bad")).select(*schema.fieldNames())
    return ok, parsed.filter("bad").select("payload")


def encode(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """K3: ``key`` from the key columns, ``value`` the whole row as JSON."""
    return df.select(ident(key).alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
