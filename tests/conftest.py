import math
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from stayledger.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4)
    yield session
    session.stop()


FEATURES = ["anchor_age", "creatinine_first", "lactate_first", "gender", "admission_type"]
SCHEMA = (
    "subject_id BIGINT, hadm_id BIGINT, stay_id BIGINT, anchor_age DOUBLE, "
    "creatinine_first DOUBLE, lactate_first DOUBLE, gender STRING, "
    "admission_type STRING, hospital_expire_flag INT"
)


def clinical_rows():
    """80 fixed rows with gaps at known places and a learnable outcome."""
    rows = []
    for i in range(80):
        age = float(18 + (i * 37) % 72)
        creatinine = None if i in (5, 10, 15) else round(0.5 + ((i * 13) % 20) / 10, 2)
        lactate = round(0.8 + ((i * 7) % 25) / 10, 2)
        gender = None if i in (8, 22) else "FM"[i % 2]
        kind = ("EMERGENCY", "URGENT", "ELECTIVE")[(i * 5) % 3]
        risk = -5 + 0.035 * age + 0.9 * (creatinine or 1.1) + 0.7 * lactate
        chance = 1 / (1 + math.exp(-risk))
        died = int(chance > ((i * 29) % 80) / 80)
        if i < 4:
            died = i % 2
        rows.append(
            (1000 + i, 2000 + i, 3000 + i, age, creatinine, lactate, gender, kind, died)
        )
    return rows


@pytest.fixture(scope="session")
def clinical(spark):
    return spark.createDataFrame(clinical_rows(), SCHEMA)


@pytest.fixture(scope="session")
def splits(clinical):
    stay = clinical.stay_id
    return (
        clinical.where(stay < 3050),
        clinical.where((stay >= 3050) & (stay < 3065)),
        clinical.where(stay >= 3065),
    )
