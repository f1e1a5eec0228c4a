"""Layered pass-through views (``production`` -> ``analysis``)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_layer(spark: SparkSession, layer: str, frames: Mapping[str, DataFrame]) -> dict[str, str]:
    """Register each frame as temp view ``{layer}_{name}``; return name -> view."""
    out = {}
    for name, df in frames.items():
        view = f"{layer}_{name}"
        df.createOrReplaceTempView(view)
        out[name] = view
    return out
