"""Each model built from the feeds rendered out of the source tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .analyses import plain
from .feeds import RenderedFeeds
from .models import MARTS, STAGING


def _query(build: Callable) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        model = plain(build(RenderedFeeds(spark, sf_dir)))
        if "closed_at" in model.columns:
            model = model.withColumn("closed_at", F.date_format("closed_at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
        return model
    return run


MODELS = {f"model_{name}": _query(build) for name, build in {**STAGING, **MARTS}.items()}
