"""Schemas, parameters and the fixed values the results depend on."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# --- fixed values: raw column names, in file order, and their clean names ---
EMPLOYEE_COLUMNS = {
    "jobId": "job_id",
    "companyId": "company_id",
    "jobRole": "job_role",
    "education": "education",
    "major": "major",
    "Industry": "industry",
    "yearsExperience": "years_experience",
    "distanceFromCBD": "distance_from_cbd",
}
SALARY_COLUMNS = {"jobId": "job_id", "salaryInThousands": "salary_k"}

# --- fixed values: text that stands for a missing value in the raw files ---
NA_TOKENS = ("NA", "na", "NaN", "nan", "<NA>")

# --- fixed values: text a default pandas CSV read turns into a missing value ---
CSV_NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- fixed values: ordinal encodings ---
EDUCATION_LEVEL = {"NONE": 0, "HIGH_SCHOOL": 1, "BACHELORS": 2, "MASTERS": 3, "DOCTORAL": 4}
JOB_ROLE_RANK = {
    "CEO": 6, "CTO": 5, "CFO": 5, "VICE_PRESIDENT": 4,
    "MANAGER": 3, "SENIOR": 2, "JUNIOR": 1, "JANITOR": 0,
}
INDUSTRY_SCORE = {
    "EDUCATION": 1, "SERVICE": 1, "AUTO": 2, "HEALTH": 3, "WEB": 4, "FINANCE": 5, "OIL": 5,
}
MAJOR_SCORE = {
    "NONE": 0, "LITERATURE": 1, "BIOLOGY": 2, "CHEMISTRY": 3, "PHYSICS": 4,
    "COMPSCI": 5, "MATH": 6, "BUSINESS": 7, "ENGINEERING": 8,
}

# --- fixed values: invalid rows and the outlier rule ---
OUTLIER_ROLE = "PRESIDENT"
FENCED_ROLE = "JANITOR"
MAX_DISTANCE = 100
INVALID_SALARIES = (0, 10_000_000)
FENCE_FACTOR = 1.5
MEDIAN_SALARY_K = 114

# encoded column -> (source column, dictionary)
ENCODINGS = {
    "education_level": ("education", EDUCATION_LEVEL),
    "job_role_rank": ("job_role", JOB_ROLE_RANK),
    "industry_score": ("industry", INDUSTRY_SCORE),
    "major_score": ("major", MAJOR_SCORE),
}
SCORE_COLUMNS = tuple(ENCODINGS)
# --- fixed values: the raw text columns that the features leave out ---
RAW_CATEGORICALS = ("education", "job_role", "industry", "major", "company_id")
CATEGORICAL_FEATURES = ("edu_major", "industry_role")
# --- fixed values: the columns that models and audits use ---
NUMERIC_FEATURES = (
    "years_experience", "distance_from_cbd", "education_level", "job_role_rank",
    "industry_score", "major_score", "handcrafted_score",
)
AUDITED_FEATURES = (
    "years_experience", "distance_from_cbd", "salary_k", "education_level", "job_role_rank",
    "industry_score", "major_score", "handcrafted_score",
)


def _all_strings(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


# Raw files are read as text: a declared schema saves the inference pass and
# keeps every dirty value for the cleaning step to judge.
RAW_EMPLOYEE = _all_strings(EMPLOYEE_COLUMNS)
RAW_SALARY = _all_strings(SALARY_COLUMNS)

CLEAN = T.StructType([
    T.StructField("job_id", T.LongType()),
    T.StructField("company_id", T.LongType()),
    T.StructField("job_role", T.StringType()),
    T.StructField("education", T.StringType()),
    T.StructField("major", T.StringType()),
    T.StructField("industry", T.StringType()),
    T.StructField("years_experience", T.DoubleType()),
    T.StructField("distance_from_cbd", T.DoubleType()),
    T.StructField("salary_k", T.LongType()),
])


@dataclass(frozen=True)
class NetParams:
    """Settings of the embedding network. The defaults are the published run."""

    cat_cols: tuple[str, ...] = CATEGORICAL_FEATURES
    test_size: float = 0.2
    valid_size: float = 0.2
    random_state: int = 42
    batch_size: int = 256
    lr: float = 1e-3
    weight_decay: float = 1e-2
    epochs: int = 30
    patience: int = 5
    lr_patience: int = 3
    lr_factor: float = 0.5
    max_norm: float = 5.0
    hidden: tuple[int, int] = (128, 64)
    # rows one shard trains on between two averagings
    rows_per_shard: int = 5_000


@dataclass(frozen=True)
class FineTuneParams:
    """The fine-tuning grid; every setting restarts from the base weights. The published grid."""

    grid: tuple[dict, ...] = field(default_factory=lambda: (
        {"lr": 1e-3, "batch_size": 128, "weight_decay": 0.0},
        {"lr": 5e-4, "batch_size": 256, "weight_decay": 1e-5},
    ))
    epochs: int = 3
    patience: int = 2
