"""Star score to emotion, and calendar helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def emotion_default(score: Column) -> Column:
    """At most 2 Negative, 3 Neutral, everything else Positive; null Unknown."""
    return (
        F.when(score.isNull(), "Unknown")
        .when(score <= 2, "Negative")
        .when(score == 3, "Neutral")
        .otherwise("Positive")
    )


def emotion_mapped(score: Column, negative_max: int = 2, neutral: int = 3, positive_min: int = 4) -> Column:
    """Thresholds tested in the order negative, neutral, positive; a gap between them is Unknown."""
    return (
        F.when(score <= negative_max, "Negative")
        .when(score == neutral, "Neutral")
        .when(score >= positive_min, "Positive")
        .otherwise("Unknown")
    )


def period(time: Column, granularity: str) -> Column:
    """Start of the Month, Quarter or Year."""
    if granularity.lower() not in ("month", "quarter", "year"):
        raise ValueError(f"granularity must be Month, Quarter or Year, not {granularity!r}")
    return F.date_trunc(granularity.lower(), time)
