"""Quality control of per-minute wearable heart-rate series on Spark."""

from pulsegrid.config import (
    Cohort,
    CollectedDays,
    Duplicates,
    HeartRateStats,
    Missingness,
    Outliers,
    ValidDays,
    ValidParticipants,
    WearCompliance,
)

__all__ = [
    "Cohort",
    "CollectedDays",
    "Duplicates",
    "HeartRateStats",
    "Missingness",
    "Outliers",
    "ValidDays",
    "ValidParticipants",
    "WearCompliance",
]
