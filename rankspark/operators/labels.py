"""P1 relevance and gain labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import BOOKING_COL, CLICK_COL, GAIN_COL, TARGET_COL


def add_relevance(df: DataFrame) -> DataFrame:
    """relevance = 5 booked / 1 clicked / 0; dcg_gain = 2^relevance - 1 (31/1/0)."""
    if BOOKING_COL not in df.columns or CLICK_COL not in df.columns:
        raise ValueError(f"labels need the columns {CLICK_COL} and {BOOKING_COL}")
    booked = F.col(BOOKING_COL) == 1
    clicked = F.col(CLICK_COL) == 1
    rel = F.when(booked, 5).when(clicked, 1).otherwise(0).cast("int")
    gain = F.when(booked, 31).when(clicked, 1).otherwise(0).cast("int")
    return df.select("*", rel.alias(TARGET_COL), gain.alias(GAIN_COL))
