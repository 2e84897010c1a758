"""Settings of each quality-control step. They live on the driver and carry no data."""

from __future__ import annotations

from dataclasses import dataclass, field

# The study protocol's defaults.
MINUTE_COLUMNS = ("subject_id", "date", "time", "hr")
MINUTES_PER_DAY = 1440
MIN_HR = 40.0
MAX_HR = 163.0
WEAR_RATIO = 0.80
WEAR_MINUTES = 1152
MIN_CONSECUTIVE_DAYS = 7
DEDUP_KEY = ("subject_id", "date", "time")
HISTOGRAM_BINS = 25

# The metric columns of each daily source.
ACTIVITY_METRICS = ("steps", "distance", "calories")
RESTING_METRICS = ("resting_hr",)
DAILY_HR_METRICS = ("daily_mean", "daily_max", "daily_min")
SLEEP_METRICS = (
    "total_minutes_asleep",
    "total_time_in_bed",
    "stages_deep",
    "stages_light",
    "stages_rem",
    "stages_wake",
    "stages_asleep",
    "stages_restless",
    "stages_awake",
    "cnt_deep",
    "cnt_light",
    "cnt_rem",
    "cnt_wake",
    "cnt_asleep",
    "cnt_restless",
    "cnt_awake",
)
ALL_METRICS = ACTIVITY_METRICS + RESTING_METRICS + DAILY_HR_METRICS + SLEEP_METRICS


def _one_of(name: str, value: str, allowed: tuple[str, ...]) -> None:
    if value not in allowed:
        raise ValueError(f"{name} must be one of {allowed}, not {value!r}")


@dataclass(frozen=True)
class CollectedDays:
    """Which days of a subject count as collected; no end means the last recorded day."""

    day_start: int = 0
    day_end: int | None = None


@dataclass(frozen=True)
class Duplicates:
    """Which columns make two rows the same minute, and which of the rows stays."""

    key: tuple[str, ...] = DEDUP_KEY
    keep: str = "last"

    def __post_init__(self) -> None:
        _one_of("keep", self.keep, ("first", "last"))


@dataclass(frozen=True)
class Outliers:
    """The plausible range, bounds included, and what happens to values outside it."""

    min_hr: float = MIN_HR
    max_hr: float = MAX_HR
    mode: str = "replace_zero"
    normalize_time: bool = True

    def __post_init__(self) -> None:
        _one_of("mode", self.mode, ("replace_zero", "drop"))


@dataclass(frozen=True)
class ValidDays:
    """How much wear makes a day valid. Minutes, when given, win over the ratio."""

    expected_minutes: int = MINUTES_PER_DAY
    threshold_ratio: float = WEAR_RATIO
    threshold_minutes: int | None = None
    start_at_zero: bool = True
    normalize_time: bool = True

    @property
    def threshold(self) -> int:
        if self.threshold_minutes is not None:
            return self.threshold_minutes
        return int(self.expected_minutes * self.threshold_ratio)


@dataclass(frozen=True)
class ValidParticipants:
    """How many valid days in a row a participant needs, within an optional day range."""

    min_consecutive_days: int = MIN_CONSECUTIVE_DAYS
    day_start: int | None = None
    day_end: int | None = None


@dataclass(frozen=True)
class HeartRateStats:
    """Whether the key table still holds invalid days that must be left out."""

    filter_valid_days: bool = True


@dataclass(frozen=True)
class Missingness:
    """Which metrics are reported, and how repeated days of a source are collapsed."""

    metrics: tuple[str, ...] = ALL_METRICS
    filter_valid_days: bool = True
    collapse: str = "mean"

    def __post_init__(self) -> None:
        _one_of("collapse", self.collapse, ("mean", "first"))


@dataclass(frozen=True)
class WearCompliance:
    """Expected wear per day, the reference ratio and the number of histogram bins."""

    expected_minutes: int = MINUTES_PER_DAY
    threshold_ratio: float = WEAR_RATIO
    bins: int = HISTOGRAM_BINS
    normalize_time: bool = True


@dataclass(frozen=True)
class Cohort:
    """All settings of the combined job."""

    collected: CollectedDays = field(default_factory=CollectedDays)
    duplicates: Duplicates = field(default_factory=Duplicates)
    outliers: Outliers = field(default_factory=Outliers)
    valid_days: ValidDays = field(default_factory=lambda: ValidDays(threshold_minutes=WEAR_MINUTES))
    participants: ValidParticipants = field(default_factory=ValidParticipants)
    heart_rate: HeartRateStats = field(default_factory=HeartRateStats)
    missingness: Missingness = field(default_factory=Missingness)
    compliance: WearCompliance = field(default_factory=WearCompliance)
