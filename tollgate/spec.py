"""Everything an operator has to know about one dataset."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql.types import StructType


def schema_of(**types: str) -> StructType:
    """A schema from names and type names; needs no session, unlike a DDL string."""
    schema = StructType()
    for name, kind in types.items():
        schema.add(name, kind)
    return schema


@dataclass(frozen=True)
class Rule:
    """A named check; ``test`` builds a column that is true for a good row.

    A null result passes: missing values are the null policy's business.
    """

    name: str
    test: Callable[[], Column]


@dataclass(frozen=True)
class DatasetSpec:
    """Declared, never inferred: inference reads the raw text a second time.

    ``derived`` maps a feature name to the SQL expression it is computed from and
    becomes part of the saved model. ``label_expr`` is kept apart from it because
    a stream to be scored has no label. ``categorical`` columns have few values, of
    which each gets a feature of its own; ``hashed`` ones may have any number, dealt out
    over ``hash_buckets`` features.
    """

    name: str
    schema: StructType
    key: tuple[str, ...]
    event_time: str | None = None
    label: str = "label"
    label_expr: str | None = None
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    derived: Mapping[str, str] = field(default_factory=dict)
    scale: bool = False
    max_categories: int = 10_000
    formats: Mapping[str, str] = field(default_factory=dict)
    required: tuple[str, ...] = ()
    fill: Mapping[str, object] = field(default_factory=dict)
    rules: tuple[Rule, ...] = ()
    partition_cols: tuple[str, ...] = ()
    partition_exprs: Mapping[str, str] = field(default_factory=dict)
    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"
    header: bool = False
    hashed: tuple[str, ...] = ()
    hash_buckets: int = 1024

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()
