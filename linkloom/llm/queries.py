"""The registered query of each operator, and SQL where it can express one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .ann import op8_nearest_neighbours
from .chat import op3_chat_format
from .decontam import OP5_SQL, op5_decontamination
from .language import op4_language_id
from .mixing import op7_mixing
from .neardup import OP10_SQL, op10_near_dedup
from .pii import op1_pii
from .quality import op9_quality
from .token_store import op6_token_store
from .toxicity import op2_toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    every = (op1_pii, op2_toxicity, op3_chat_format, op4_language_id, op5_decontamination, op6_token_store, op7_mixing, op8_nearest_neighbours, op9_quality, op10_near_dedup)
    return {f.__name__: f for f in every}


def oracle_sql() -> dict[str, str]:
    return {"op5_decontamination": OP5_SQL, "op10_near_dedup": OP10_SQL}
