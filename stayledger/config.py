"""Column roles, fixed rule tables and default operating points.

Every operator takes column names as arguments; the defaults here describe the
hospital schema (patient -> admission -> stay -> long event tables).
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from pathlib import Path

SEED = 42


@dataclass(frozen=True)
class Roles:
    """Names of the columns that carry the entity hierarchy, times and target."""

    patient: str = "subject_id"
    admission: str = "hadm_id"
    stay: str = "stay_id"
    start: str = "intime"
    cutoff: str = "prediction_time"
    end: str = "outtime"
    target: str = "hospital_expire_flag"

    @property
    def ids(self) -> tuple[str, str, str]:
        return (self.patient, self.admission, self.stay)

    @property
    def dates(self) -> tuple[str, str, str]:
        return (self.start, self.cutoff, self.end)


ROLES = Roles()


@dataclass(frozen=True)
class LabelRule:
    """Maps a raw dictionary label to a standard measurement name.

    Matching is on the lower-cased label: any of ``exact``, or containing any
    of ``contains``, or beginning with any of ``prefix``.
    """

    name: str
    exact: tuple[str, ...] = ()
    contains: tuple[str, ...] = ()
    prefix: tuple[str, ...] = ()


@dataclass(frozen=True)
class UnitRule:
    """Fahrenheit-to-Celsius rule for one measurement.

    Readings convert when the unit contains ``unit_contains``, the label
    contains ``label_contains`` or the reading itself is above ``above``.
    """

    label_contains_any: str = "temperature"
    unit_contains: str = "f"
    label_contains: str = "fahrenheit"
    above: float = 70.0


# --- fixed values: label rules, first match wins -----------------------------
VITAL_RULES: tuple[LabelRule, ...] = (
    LabelRule("heart_rate", exact=("heart rate",)),
    LabelRule(
        "respiratory_rate", exact=("respiratory rate", "respiratory rate (total)")
    ),
    LabelRule(
        "spo2",
        exact=("spo2",),
        contains=("o2 saturation pulseoxymetry", "oxygen saturation"),
    ),
    LabelRule(
        "sbp",
        exact=(
            "non invasive blood pressure systolic",
            "arterial blood pressure systolic",
            "nbp systolic",
            "abp systolic",
        ),
    ),
    LabelRule(
        "map",
        exact=(
            "non invasive blood pressure mean",
            "arterial blood pressure mean",
            "nbp mean",
            "abp mean",
        ),
    ),
    LabelRule("temperature_c", contains=("temperature",)),
)

LAB_RULES: tuple[LabelRule, ...] = (
    LabelRule("creatinine", exact=("creatinine",)),
    LabelRule("bun", exact=("urea nitrogen",)),
    LabelRule("sodium", exact=("sodium",)),
    LabelRule("potassium", exact=("potassium",)),
    LabelRule("glucose", exact=("glucose",)),
    LabelRule("wbc", exact=("white blood cells",)),
    LabelRule("platelets", exact=("platelet count",)),
    LabelRule("lactate", exact=("lactate",)),
    LabelRule("bilirubin_total", prefix=("bilirubin, total",)),
    LabelRule("albumin", exact=("albumin",)),
    LabelRule("bicarbonate", exact=("bicarbonate",)),
    LabelRule("hemoglobin", exact=("hemoglobin",)),
)

TEMPERATURE_UNITS = UnitRule()

# Inclusive plausibility bounds; readings outside become NULL.
PLAUSIBLE_BOUNDS: dict[str, tuple[float, float]] = {
    "heart_rate": (20.0, 300.0),
    "respiratory_rate": (3.0, 80.0),
    "spo2": (0.0, 100.0),
    "sbp": (30.0, 300.0),
    "map": (20.0, 250.0),
    "temperature_c": (25.0, 45.0),
}

# Label fragments for browsing the chart-item dictionary.
VITAL_SEARCH_FRAGMENTS: tuple[str, ...] = (
    "heart rate",
    "respiratory rate",
    "oxygen saturation",
    "spo2",
    "temperature",
    "blood pressure systolic",
    "arterial blood pressure mean",
    "non invasive blood pressure mean",
)
# --- end of fixed values -------------------------------------------------------

VITAL_STATS = ("min", "max", "mean")
LAB_STATS = ("first", "min", "max")

PREDICTION_HOURS = 24
MINIMUM_AGE = 18

# Operating points swept by default.
DEFAULT_THRESHOLDS = (0.05, 0.10, 0.15, 0.20, 0.25, 0.30, 0.40, 0.50, 0.60)
REVIEW_CAPACITIES = (0.05, 0.10, 0.20, 0.30, 0.50)
PROBABILITY_FLOOR = 1e-8
MINIMUM_SUBGROUP_SIZE = 20
MINIMUM_SUBGROUP_EVENTS = 5

# Columns that never enter the predictor matrix.
LEAKAGE_COLUMNS = (
    "subject_id",
    "hadm_id",
    "stay_id",
    "hospital_expire_flag",
    "deathtime",
    "dod",
    "dischtime",
    "discharge_location",
    "outtime",
    "los",
    "prediction_time",
)

BASE_COHORT_COLUMNS = (
    "subject_id",
    "hadm_id",
    "stay_id",
    "intime",
    "prediction_time",
    "outtime",
    "gender",
    "anchor_age",
    "admission_type",
    "admission_location",
    "insurance",
    "marital_status",
    "race",
    "first_careunit",
    "hospital_expire_flag",
)

# Context shown beside reviewed cases, where the table has it.
REVIEW_CONTEXT = (
    "anchor_age",
    "gender",
    "first_careunit",
    "admission_type",
    "admission_location",
    "insurance",
    "race",
    "creatinine_first",
    "creatinine_min",
    "creatinine_max",
    "bun_first",
    "bun_min",
    "bun_max",
    "lactate_first",
    "lactate_max",
    "bicarbonate_first",
    "potassium_first",
    "map_min",
    "map_mean",
    "heart_rate_mean",
    "temperature_c_mean",
    "oxygen_saturation_mean",
)

SUBGROUP_COLUMNS = (
    "gender",
    "age_group",
    "race",
    "insurance",
    "first_careunit",
    "admission_type",
)


@dataclass(frozen=True)
class FeatureConfig:
    """Which columns a model reads, kept next to the model as JSON."""

    target_column: str
    retained_feature_columns: tuple[str, ...]
    id_columns: tuple[str, ...] = ROLES.ids
    date_columns: tuple[str, ...] = ROLES.dates
    numeric_features: tuple[str, ...] = ()
    categorical_features: tuple[str, ...] = ()
    extra: dict = field(default_factory=dict)

    REQUIRED = ("target_column", "retained_feature_columns")

    @classmethod
    def load(cls, path: str | Path, spark=None) -> FeatureConfig:
        """Read a saved config; with a session, from any store that Spark reads."""
        if spark is not None:
            rows = spark.read.text(str(path), wholetext=True).take(2)
            if len(rows) != 1:
                raise ValueError(f"{path} holds {len(rows)} files, not one feature config")
            body = rows[0][0]
        elif Path(path).exists():
            body = Path(path).read_text(encoding="utf-8")
        else:
            raise FileNotFoundError(f"feature config not found: {path}")
        raw = json.loads(body)
        absent = sorted(set(cls.REQUIRED) - set(raw))
        if absent:
            raise ValueError(f"feature config lacks required keys: {absent}")
        known = {name for name in cls.__dataclass_fields__ if name != "extra"}
        typed = {
            key: tuple(value) if isinstance(value, list) else value
            for key, value in raw.items()
            if key in known
        }
        rest = {key: value for key, value in raw.items() if key not in known}
        return cls(**typed, extra=rest)

    def save(self, path: str | Path, spark=None) -> None:
        """Write as JSON; with a session, as a one-file folder beside a model it saved."""
        body = asdict(self)
        body.update(body.pop("extra"))
        if spark is not None:
            one = spark.createDataFrame([(json.dumps(body),)], "value string")
            one.coalesce(1).write.mode("overwrite").text(str(path))
            return
        Path(path).write_text(json.dumps(body, indent=2), encoding="utf-8")
