"""The four jobs a scheduler calls."""

from ..operators.train import retrain, score_models
from .prepare import export_latest, latest, prepare
from .serve import serve
from .validate import validate

__all__ = ["export_latest", "latest", "prepare", "retrain", "score_models", "serve", "validate"]
