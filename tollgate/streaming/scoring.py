"""K2: a stream of messages scored by one model."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..operators.clean import BROKEN, tag
from ..operators.train import score
from ..spec import DatasetSpec
from .messages import ORIGIN, encode, ident, parse

WHY = "why"


def checked(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Parsed, filled messages with ``why``: what is wrong with each, empty for a good one.

    A message is cleaned like the rows the model was trained on: it may break a rule of
    the spec or lack a required field. Besides, every numeric input of the model must
    be a number, since one that is missing or NaN would end the stream.
    """
    parsed = parse(df, spec.schema)
    carried = [c for c in ("bad", "payload", *ORIGIN) if c in parsed.columns]
    held = parsed.select(*spec.columns, F.struct(*carried).alias("_message"))
    tagged = tag(held, spec)
    inputs = {c: F.expr(spec.derived.get(c, f"`{c}`")).cast("double") for c in spec.numeric}
    missing = [
        F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(f"number:{c}"))
        for c, x in inputs.items()
    ]
    missing = F.array_compact(F.array(*missing)) if missing else F.array().cast("array<string>")
    unread = F.array(F.lit("unreadable"))
    why = F.when(F.col("_message.bad"), unread).otherwise(F.concat(BROKEN, missing))
    return tagged.select(*spec.columns, "_message.*", why.alias(WHY))


def _neutral(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Bad rows get values any model takes: they share a plan with the good ones, and
    what is computed for them is thrown away."""
    bad = F.size(WHY) > 0
    values = {}
    for f in spec.schema:
        if isinstance(f.dataType, NumericType):
            values[f.name] = F.when(bad, F.lit(1).cast(f.dataType)).otherwise(F.col(f.name))
    return df.withColumns(values)


def score_messages(df: DataFrame, spec: DatasetSpec, model: PipelineModel) -> DataFrame:
    """Good messages in, encoded predictions out: K1, K2, K3. Others are left out."""
    rows = checked(df, spec)
    origin = [c for c in ORIGIN if c in rows.columns]
    scored = score(_neutral(rows, spec), model).filter(F.size(WHY) == 0)
    return encode(scored.select(*spec.key, "prediction", "p", *origin), spec.key)


def route_messages(
    df: DataFrame, spec: DatasetSpec, model: PipelineModel, out_topic: str, bad_topic: str
) -> DataFrame:
    """Predictions for one topic and bad messages for another, in one read.

    Two queries would read the source twice. A prediction carries its message's
    topic, partition and offset: a consumer that has seen these has seen the
    message. A bad message goes on as it came, with what is wrong in a header.
    """
    rows = checked(df, spec)
    origin = [c for c in ORIGIN if c in rows.columns]
    scored = score(_neutral(rows, spec), model)
    bad: Column = F.size(WHY) > 0
    result = F.to_json(F.struct(*spec.key, "prediction", "p", *origin))
    header = F.struct(F.lit("why").alias("key"), F.array_join(WHY, ",").cast("binary").alias("value"))
    return scored.select(
        F.when(~bad, ident(spec.key)).alias("key"),
        F.when(bad, F.col("payload")).otherwise(result).alias("value"),
        F.when(bad, F.lit(bad_topic)).otherwise(F.lit(out_topic)).alias("topic"),
        F.when(bad, F.array(header)).alias("headers"),
    )
