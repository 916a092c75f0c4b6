"""Every named query with the DuckDB statement it is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .analyses import ANALYSES
from .checks import CHECKS
from .conforming import CONFORMING
from .loading import LOADING
from .mart_questions import MART_QUESTIONS
from .model_queries import MODELS
from .oracle_analyses import ANALYSIS_SQL
from .oracle_conforming import CHECK_SQL, CONFORMING_SQL, LOADING_SQL
from .oracle_marts import MART_SQL
from .oracle_models import MODEL_SQL
from .oracle_questions import QUESTION_SQL
from .questions import QUESTIONS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    **ANALYSES, **CONFORMING, **QUESTIONS, **CHECKS, **LOADING, **MODELS, **MART_QUESTIONS}
ORACLES: dict[str, str] = {
    **ANALYSIS_SQL, **CONFORMING_SQL, **QUESTION_SQL, **CHECK_SQL, **LOADING_SQL, **MODEL_SQL, **MART_SQL}
