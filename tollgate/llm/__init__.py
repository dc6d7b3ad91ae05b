"""Operators of a training-data pipeline, each with the query that applies it."""

from . import ann, arc, decontaminate, divergence, langid, mix, neardup, pii, quality, substrings, toxicity, urls, vafile

MODULES = (mix, neardup, langid, toxicity, substrings, urls, pii, quality, ann, decontaminate, arc, divergence, vafile)

QUERIES = {name: query for m in MODULES for name, query in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
