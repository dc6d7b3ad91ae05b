"""Trained models on shared storage."""

from __future__ import annotations

from pyspark.ml import PipelineModel


def save_model(model: PipelineModel, uri: str) -> str:
    """A saved model is never overwritten: the registry points at it."""
    model.write().save(uri)
    return uri


def load_model(uri: str) -> PipelineModel:
    return PipelineModel.load(uri)
