"""The corpus operators' queries, and their SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .decontamination import op1_decontamination
from .extraction import op4_extraction
from .licenses import op8_licenses
from .lm import op5_lm
from .neardup import op7_neardup
from .neighbours import op6_neighbours
from .oracles import DECONTAMINATION, NEARDUP
from .packing import op2_packing
from .quality import op3_quality
from .sharding import op10_sharding
from .warc import op9_warc

QUERIES = (op1_decontamination, op2_packing, op3_quality, op4_extraction, op5_lm, op6_neighbours, op7_neardup, op8_licenses, op9_warc, op10_sharding)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": DECONTAMINATION, "op7_neardup": NEARDUP}
