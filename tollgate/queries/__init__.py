"""Registered queries on the given tables, each with SQL that must give the same rows."""

from . import preparation, serving, training, validation

MODULES = (preparation, training, validation, serving)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
