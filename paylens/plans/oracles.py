"""SQL that computes the registered queries independently, over the given tables.

Each text starts with the same views: the derived raw tables, then the steps of
the pipeline written as plain SQL.
"""

from __future__ import annotations

from paylens.plans import forest_sql
from paylens.schemas import (
    AUDITED_FEATURES, CATEGORICAL_FEATURES, CSV_NA_TOKENS, EDUCATION_LEVEL, EMPLOYEE_COLUMNS, INDUSTRY_SCORE, JOB_ROLE_RANK,
    MAJOR_SCORE, NA_TOKENS, NUMERIC_FEATURES,
)

RAW = '''
WITH raw_base AS (
SELECT o.o_orderkey AS k, o.o_custkey AS ck, CAST(floor(o.o_totalprice) AS BIGINT) AS tp, c.c_nationkey AS nk,
  (o.o_orderkey * 7 + o.o_custkey) % 8 AS r, (o.o_orderkey * 31 + o.o_custkey * 3) % 6 AS e,
  (o.o_orderkey * 17 + o.o_custkey) % 10 AS m, o.o_custkey % 25 AS y, (o.o_orderkey * 13 + o.o_custkey) % 100 AS d
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
), raw_emp1 AS (
SELECT CASE WHEN k % 997 = 0 THEN NULL ELSE concat('JOB', CAST(k AS STRING)) END AS "jobId",
  CASE WHEN k % 991 = 3 THEN NULL ELSE concat('COMP', CAST(ck % 63 AS STRING)) END AS "companyId",
  CASE WHEN k % 5000 = 17 THEN 'PRESIDENT' WHEN k % 983 = 4 THEN NULL WHEN k % 983 = 5 THEN 'NA'
    ELSE CASE r WHEN 0 THEN 'CEO' WHEN 1 THEN 'CTO' WHEN 2 THEN 'CFO' WHEN 3 THEN 'VICE_PRESIDENT'
      WHEN 4 THEN 'MANAGER' WHEN 5 THEN 'SENIOR' WHEN 6 THEN 'JUNIOR' ELSE 'JANITOR' END END AS "jobRole",
  CASE e WHEN 0 THEN 'NONE' WHEN 1 THEN 'HIGH_SCHOOL' WHEN 2 THEN 'BACHELORS' WHEN 3 THEN 'MASTERS'
    WHEN 4 THEN 'DOCTORAL' ELSE CASE WHEN k % 2 = 0 THEN 'NA' END END AS education,
  CASE m WHEN 0 THEN 'NONE' WHEN 1 THEN 'LITERATURE' WHEN 2 THEN 'BIOLOGY' WHEN 3 THEN 'CHEMISTRY'
    WHEN 4 THEN 'PHYSICS' WHEN 5 THEN 'COMPSCI' WHEN 6 THEN 'MATH' WHEN 7 THEN 'BUSINESS'
    WHEN 8 THEN 'ENGINEERING' ELSE 'nan' END AS major,
  CASE WHEN k % 5000 = 17 THEN 'GOVERNMENT' WHEN k % 971 = 6 THEN NULL
    ELSE CASE nk % 7 WHEN 0 THEN 'EDUCATION' WHEN 1 THEN 'SERVICE' WHEN 2 THEN 'AUTO' WHEN 3 THEN 'HEALTH'
      WHEN 4 THEN 'WEB' WHEN 5 THEN 'FINANCE' ELSE 'OIL' END END AS "Industry",
  CASE WHEN k % 977 = 7 THEN 'NA' ELSE CAST(y AS STRING) END AS "yearsExperience",
  CASE WHEN k % 967 = 8 THEN NULL WHEN k % 7001 = 9 THEN '9999' ELSE CAST(d AS STRING) END AS "distanceFromCBD"
FROM raw_base
), raw_employee AS (
SELECT * FROM raw_emp1
UNION ALL SELECT * FROM raw_emp1 WHERE "jobId" LIKE '%77'
UNION ALL SELECT "jobId", "companyId", "jobRole", education, 'MATH' AS major, "Industry", "yearsExperience", "distanceFromCBD"
  FROM raw_emp1 WHERE "jobId" LIKE '%555'
), raw_salary AS (
SELECT CASE WHEN k % 953 = 10 THEN NULL ELSE concat('JOB', CAST(k AS STRING)) END AS "jobId",
  CASE WHEN k % 947 = 11 THEN NULL WHEN k % 3001 = 12 THEN '0' WHEN k % 9001 = 13 THEN '10000000'
    WHEN r = 7 AND k % 97 = 0 THEN '290'
    ELSE CAST(CAST(floor(40 + 12 * (CASE r WHEN 0 THEN 6 WHEN 1 THEN 5 WHEN 2 THEN 5 WHEN 3 THEN 4 WHEN 4 THEN 3
      WHEN 5 THEN 2 WHEN 6 THEN 1 ELSE 0 END) + 6 * (e % 5) + 2 * y - d / 4.0 + tp % 40) AS BIGINT) AS STRING) END AS "salaryInThousands"
FROM raw_base WHERE k % 941 <> 14
)'''


def _in(tokens) -> str:
    return "(" + ", ".join(f"'{t}'" for t in tokens) + ")"


def _token(column: str, tokens=NA_TOKENS) -> str:
    return f"CASE WHEN {column} IN {_in(tokens)} THEN NULL ELSE {column} END"


def _digits(column: str) -> str:
    return f"TRY_CAST(nullif(regexp_extract({column}, '([0-9]+)', 1), '') AS BIGINT)"


def _encode(column: str, table: dict) -> str:
    whens = " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items())
    return f"CAST(CASE {column} {whens} END AS INTEGER)"


CLEAN_COLUMNS = (
    "job_id, company_id, job_role, education, major, industry, years_experience, distance_from_cbd, salary_k"
)
BUCKET = "CAST('0x' || substr(md5('42:' || CAST(job_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000"
FEATURE_SELECT = f'''SELECT job_id, years_experience, distance_from_cbd, salary_k,
  education_level, job_role_rank, industry_score, major_score,
  industry_score + major_score + job_role_rank + education_level AS handcrafted_score,
  education || '_' || major AS edu_major, industry || '_' || job_role AS industry_role
FROM (SELECT *, {_encode("education", EDUCATION_LEVEL)} AS education_level,
  {_encode("job_role", JOB_ROLE_RANK)} AS job_role_rank,
  {_encode("industry", INDUSTRY_SCORE)} AS industry_score,
  {_encode("major", MAJOR_SCORE)} AS major_score FROM %s)'''

VIEWS = f'''{RAW}, emp_typed AS (
SELECT {_digits('"jobId"')} AS job_id, {_digits('"companyId"')} AS company_id, {_token('"jobRole"')} AS job_role,
  {_token("education")} AS education, {_token("major")} AS major, {_token('"Industry"')} AS industry,
  TRY_CAST({_token('"yearsExperience"')} AS DOUBLE) AS years_experience,
  TRY_CAST({_token('"distanceFromCBD"')} AS DOUBLE) AS distance_from_cbd
FROM raw_employee
), emp AS (
SELECT job_id, company_id, job_role, coalesce(education, 'NONE') AS education, coalesce(major, 'NONE') AS major,
  industry, years_experience, distance_from_cbd FROM emp_typed
WHERE job_id IS NOT NULL AND company_id IS NOT NULL AND job_role IS NOT NULL AND industry IS NOT NULL
  AND years_experience IS NOT NULL AND distance_from_cbd IS NOT NULL
), sal_typed AS (
SELECT {_digits('"jobId"')} AS job_id, TRY_CAST({_token('"salaryInThousands"')} AS BIGINT) AS salary_k FROM raw_salary
), sal AS (
SELECT * FROM sal_typed WHERE job_id IS NOT NULL AND salary_k IS NOT NULL
), merged AS (
SELECT {CLEAN_COLUMNS} FROM emp JOIN sal USING (job_id)
), uniq AS (
SELECT {CLEAN_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY company_id, job_role, education,
  major, industry, years_experience, distance_from_cbd, salary_k) AS rn FROM merged) WHERE rn = 1
), valid AS (
SELECT * FROM uniq WHERE job_role <> 'PRESIDENT' AND distance_from_cbd <= 100 AND salary_k NOT IN (0, 10000000)
), fence AS (
SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_limit, q3 + 1.5 * (q3 - q1) AS upper_limit
FROM (SELECT quantile_cont(salary_k, 0.25) AS q1, quantile_cont(salary_k, 0.75) AS q3 FROM valid WHERE job_role = 'JANITOR')
), clean AS (
SELECT valid.* FROM valid, fence WHERE job_role <> 'JANITOR' OR salary_k BETWEEN lower_limit AND upper_limit
), features AS (
{FEATURE_SELECT % "clean"}
), unfiltered AS (
{FEATURE_SELECT % "uniq"}
), parts AS (
SELECT *, CASE WHEN b < 2000 THEN 'test' WHEN b < 3600 THEN 'valid' ELSE 'train' END AS split
FROM (SELECT *, {BUCKET} AS b FROM features)
), line AS (
SELECT regr_slope(salary_k, years_experience) AS slope, regr_intercept(salary_k, years_experience) AS intercept
FROM parts WHERE split = 'train'
), pred AS (
SELECT job_id, CAST(salary_k AS DOUBLE) AS y_true, intercept + slope * years_experience AS y_pred, split
FROM parts, line WHERE split <> 'train'
), below AS (
SELECT CAST(y_true < 114 AS INTEGER) AS y_true, CAST(y_pred < 114 AS INTEGER) AS y_pred, -y_pred AS score FROM pred
)
'''


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


def _pct(part: str, whole: str) -> str:
    return f"CAST(round_even(CAST(100 * {part} AS DOUBLE) / CAST({whole} AS DOUBLE), 2) AS DOUBLE)"


def _model_checks(key: str, rows: str, flag: str, split: str = "<> 'train'") -> dict[str, str]:
    return {
        f"{key}_rows": f"SELECT job_id, CAST(salary_k AS DOUBLE) AS y_true, split, TRUE AS {flag} FROM {rows} WHERE split {split}",
        f"{key}_beats_line": f"SELECT split, count(*) AS n, TRUE AS beats_line FROM {rows} WHERE split {split} GROUP BY split",
    }


def _profile(by: str, table: str, delta: bool) -> str:
    extra = ", max(salary_k) - min(salary_k) AS salary_delta" if delta else ""
    return f'''SELECT {by}, count(*) AS "count", min(salary_k) AS lowest_salary, median(salary_k) AS median_salary,
  max(salary_k) AS highest_salary{extra} FROM {table} GROUP BY {by}'''


def _describe_numeric(columns, table: str) -> str:
    return _union(f'''SELECT '{c}' AS column_name, count({c}) AS n_rows, round(avg({c}), 6) AS mean_value,
  round(stddev_samp({c}), 6) AS std_value, CAST(min({c}) AS DOUBLE) AS min_value,
  CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q25, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS q50,
  CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q75, CAST(max({c}) AS DOUBLE) AS max_value FROM {table}''' for c in columns)


def _describe_text(columns, table: str) -> str:
    return _union(f'''SELECT '{c}' AS column_name, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_unique,
  arg_min({c}, p) AS top, max(n) AS freq FROM (SELECT {c}, count(*) AS n,
  row_number() OVER (ORDER BY count(*) DESC, {c}) AS p FROM {table} WHERE {c} IS NOT NULL GROUP BY {c})''' for c in columns)


def _value_counts(columns, table: str, nulls: bool = True) -> str:
    keep = "" if nulls else "WHERE value IS NOT NULL"
    return "SELECT * FROM (" + _union(
        f"SELECT '{c}' AS column_name, CAST({_quoted(c)} AS VARCHAR) AS value, count(*) AS n FROM {table} GROUP BY {_quoted(c)}"
        for c in columns
    ) + f") {keep}"


def _quoted(c: str) -> str:
    return f'"{c}"'


def _power_of_cosine(start: str) -> str:
    """Integral of cos(x) ** (df - 1) from ``start`` to pi / 2, by Simpson's rule."""
    step = f"((pi() / 2 - {start}) / 100000)"
    return f"""(SELECT sum(CASE WHEN i IN (0, 100000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
  * exp((df - 1) * ln(greatest(cos({start} + i * {step}), 1e-300)))) * {step} / 3 FROM range(100001) r(i))"""


def _pearson_test(pairs, names: bool) -> str:
    """Student's t as a tangent turns its tails into integrals of a power of the cosine."""
    tests = _union(f"SELECT '{p.split(', ')[0]}' AS col_x, '{p.split(', ')[1]}' AS col_y, count(*) AS n, corr({p}) AS r FROM clean" for p in pairs)
    return f"""SELECT {"col_x, col_y, " if names else ""}n, round(r, 9) AS pearson_r, round(t, 6) AS t_stat, round(p, 9) AS p_value, p < 0.05 AS significant
FROM (SELECT *, {_power_of_cosine("atan(abs(t) / sqrt(df))")} / {_power_of_cosine("0")} AS p
  FROM (SELECT *, n - 2 AS df, r * sqrt((n - 2) / (1 - r * r)) AS t FROM ({tests})))"""


def _below(by: str) -> str:
    return f'''SELECT {by}, "count", below, {_pct("below", '"count"')} AS pct_below_median FROM (SELECT {by},
  count(*) AS "count", count(*) FILTER (WHERE salary_k < 114) AS below FROM clean GROUP BY {by})'''


def _trend(by: str) -> str:
    return f'''SELECT round(regr_slope(m, x), 9) AS slope, round(regr_intercept(m, x), 9) AS intercept
FROM (SELECT {by} AS x, median(salary_k) AS m FROM clean GROUP BY {by})'''


def _box(by: str) -> str:
    return f'''SELECT '{by}' AS dimension, CAST(q.g AS VARCHAR) AS category, q1, median, q3,
  CAST(min(salary_k) FILTER (WHERE salary_k BETWEEN lo AND hi) AS DOUBLE) AS lower_whisker,
  CAST(max(salary_k) FILTER (WHERE salary_k BETWEEN lo AND hi) AS DOUBLE) AS upper_whisker,
  count(*) FILTER (WHERE NOT salary_k BETWEEN lo AND hi) AS n_outliers
FROM (SELECT g, q1, median, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM
  (SELECT {by} AS g, quantile_cont(salary_k, 0.25) AS q1, median(salary_k) AS median, quantile_cont(salary_k, 0.75) AS q3
   FROM clean GROUP BY {by})) q JOIN clean ON clean.{by} = q.g GROUP BY q.g, q1, median, q3'''


def _metrics(table: str, by: str, places: int) -> str:
    return f'''SELECT {by}, count(*) AS n, round(1 - sum((y_true - y_pred) ** 2) / (var_pop(y_true) * count(*)), {places}) AS r2,
  round(avg(abs(y_true - y_pred)), {places}) AS mae, round(sqrt(avg((y_true - y_pred) ** 2)), {places}) AS rmse
FROM {table} GROUP BY {by}'''


def _drop_steps(table: str, steps) -> str:
    parts, kept = [], "TRUE"
    for name, columns in steps:
        after = " AND ".join([kept, *[f"{c} IS NOT NULL" for c in columns]])
        before_n, after_n = f"count(*) FILTER (WHERE {kept})", f"count(*) FILTER (WHERE {after})"
        parts.append(f"SELECT '{name}' AS step, {before_n} AS rows_before, {after_n} AS rows_after, {before_n} - {after_n} AS rows_dropped FROM {table}")
        kept = after
    return _union(parts)


def _line_pred(x: str) -> str:
    return f'''SELECT '{x}' AS model, split, CAST(salary_k AS DOUBLE) AS y_true, i + s * {x} AS y_pred FROM parts,
  (SELECT regr_slope(salary_k, {x}) AS s, regr_intercept(salary_k, {x}) AS i FROM parts WHERE split = 'train') l
  WHERE split <> 'train\''''


def _codes(column: str) -> str:
    """Frequency-ordered codes of the training rows."""
    return f'''(SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS code FROM parts
  WHERE split = 'train' GROUP BY {column})'''


def _least_squares(columns) -> str:
    """Views ending in ``ols``: least squares by removing one feature after the other.

    Each step takes the projection on the current feature, measured on the
    training rows, out of the target and of the remaining features.
    """
    names = [f"x{i}" for i in range(len(columns))]
    views = [f'''ols_rows AS (
SELECT job_id, CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'val' ELSE 'test' END AS split,
  CAST(salary_k AS DOUBLE) AS y_true, {", ".join(f"CAST({c} AS DOUBLE) AS {x}" for c, x in zip(columns, names))} FROM parts
), ols_mean AS (
SELECT avg(y_true) AS my, {", ".join(f"avg({x}) AS m{x}" for x in names)} FROM ols_rows WHERE split = 'train'
), ols_0 AS (
SELECT job_id, split, y_true, my AS y_pred, y_true - my AS rest, {", ".join(f"{x} - m{x} AS {x}" for x in names)} FROM ols_rows, ols_mean
)''']
    for k, x in enumerate(names):
        later = names[k + 1:]
        ratios = "".join(f", sum({x} * {z}) / sum({x} * {x}) AS r{z}" for z in later)
        reduced = "".join(f", {z} - r{z} * {x} AS {z}" for z in later)
        views.append(f'''ols_p{k} AS (
SELECT sum({x} * rest) / sum({x} * {x}) AS slope{ratios} FROM ols_{k} WHERE split = 'train'
), ols_{k + 1} AS (
SELECT job_id, split, y_true, y_pred + slope * {x} AS y_pred, rest - slope * {x} AS rest{reduced} FROM ols_{k}, ols_p{k}
)''')
    views.append(f"ols AS (SELECT job_id, split, y_true, y_pred FROM ols_{len(names)} WHERE split <> 'train')")
    return ", ".join(views)


def _least_squares_onehot(numeric, text) -> str:
    """Views ending in ``oh_pred``: normal equations, solved by elimination, one column a step.

    A column that the earlier ones already span leaves a pivot of zero and gets no weight.
    """
    numbers = _union(f"SELECT job_id, split, salary_k, {i} AS of, '' AS level, CAST({c} AS DOUBLE) AS v FROM parts" for i, c in enumerate(numeric, 1))
    levels = _union(f"SELECT job_id, split, salary_k, {i + len(numeric)}, {c}, 1.0 FROM parts" for i, c in enumerate(text, 1))
    return f"""oh_long AS MATERIALIZED (
SELECT job_id, split, CAST(salary_k AS DOUBLE) AS y, 0 AS of, '' AS level, CAST(1 AS DOUBLE) AS v FROM parts
UNION ALL {numbers}
UNION ALL {levels}
), oh_slots AS MATERIALIZED (
SELECT of, level, row_number() OVER (ORDER BY of, level) AS i FROM (SELECT DISTINCT of, level FROM oh_long WHERE split = 'train')
), oh_train AS MATERIALIZED (
SELECT job_id, y, i, v FROM oh_long JOIN oh_slots USING (of, level) WHERE split = 'train'
), oh_sums AS MATERIALIZED (
SELECT a.i AS i, b.i AS j, sum(a.v * b.v) AS g FROM oh_train a JOIN oh_train b USING (job_id) GROUP BY ALL
UNION ALL SELECT i, (SELECT count(*) + 1 FROM oh_slots), sum(v * y) FROM oh_train GROUP BY i
), oh_rows AS MATERIALIZED (
SELECT i, list(coalesce(g, 0) ORDER BY j) AS r FROM (SELECT a.i, b.j FROM oh_slots a, (SELECT i AS j FROM oh_slots UNION ALL SELECT count(*) + 1 FROM oh_slots) b)
LEFT JOIN oh_sums USING (i, j) GROUP BY i
), oh_solved AS (
WITH RECURSIVE steps(k, i, d, r) AS (
SELECT CAST(0 AS BIGINT), i, r[i], r FROM oh_rows
UNION ALL
SELECT s.k + 1, s.i, s.d, CASE WHEN p.pivot <= 1e-9 * p.d THEN s.r WHEN s.i = p.i THEN list_transform(s.r, lambda x: x / p.pivot)
  ELSE list_transform(list_zip(s.r, p.r), lambda x: x[1] - s.r[s.k + 1] / p.pivot * x[2]) END
FROM steps s JOIN (SELECT k, i, d, r, r[i] AS pivot FROM steps) p ON p.k = s.k AND p.i = s.k + 1
)
SELECT i, CASE WHEN abs(r[i] - 1) < 1e-6 THEN r[-1] ELSE 0 END AS w FROM steps WHERE k = (SELECT count(*) FROM oh_slots)
), oh_pred AS (
SELECT job_id, any_value(y) AS y_true, sum(coalesce(w, 0) * v) AS y_pred, any_value(split) AS split
FROM oh_long LEFT JOIN oh_slots USING (of, level) LEFT JOIN oh_solved USING (i) WHERE split <> 'train' GROUP BY job_id
)"""


_EMPLOYEE = ", ".join(_quoted(c) for c in EMPLOYEE_COLUMNS)
_TEXT = ("job_role", "education", "major", "industry")
_NUMBERS = ("company_id", "years_experience", "distance_from_cbd", "salary_k")
_CORR = ("job_id", "years_experience", "distance_from_cbd", "salary_k", "education_level", "job_role_rank",
         "industry_score", "major_score", "handcrafted_score")
_AVERAGE_RANK = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
_CURVE = '''curve AS (
SELECT score, sum(n) OVER (ORDER BY score DESC) AS tot, sum(p) OVER (ORDER BY score DESC) AS tp, n, p,
  sum(p) OVER () AS pos, sum(n - p) OVER () AS neg
FROM (SELECT score, count(*) AS n, count(*) FILTER (WHERE y_true = 1) AS p FROM below GROUP BY score)
), points AS (
SELECT score, CAST(tp AS DOUBLE) AS tp, CAST(tot - tp AS DOUBLE) AS fp, CAST(tp - p AS DOUBLE) AS tp0,
  CAST(tot - n - tp + p AS DOUBLE) AS fp0, CAST(pos AS DOUBLE) AS pos, CAST(neg AS DOUBLE) AS neg FROM curve
)'''

_BODIES: dict[str, str] = {
    # sources and sinks
    "read_raw_csv": f"SELECT {_EMPLOYEE} FROM raw_employee",
    "read_raw_csv_salary": 'SELECT "jobId", "salaryInThousands" FROM raw_salary',
    "read_csv_na_tokens": "SELECT " + ", ".join(
        f"{_token(_quoted(c), CSV_NA_TOKENS)} AS {_quoted(c)}" for c in EMPLOYEE_COLUMNS
    ) + " FROM raw_employee",
    "write_parquet_overwrite": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "read_parquet_merge_schema": f'''SELECT {CLEAN_COLUMNS.replace("major", "CASE WHEN job_id % 2 = 1 THEN major END AS major")} FROM clean''',
    "read_write_parquet_features": "SELECT * FROM features",
    "write_predictions_csv": "SELECT job_id, y_true, round(y_pred, 6) AS y_pred, split FROM pred",
    "write_metrics_json": _metrics("pred", "split", 6),
    "save_load_model": "SELECT job_id, y_true, round(y_pred, 6) AS y_pred, split FROM pred",
    # cleaning
    "rename_columns": "SELECT " + ", ".join(f"{_quoted(a)} AS {b}" for a, b in EMPLOYEE_COLUMNS.items()) + " FROM raw_employee",
    "extract_id_digits": f'''SELECT "jobId", "companyId", {_digits('"jobId"')} AS job_id, {_digits('"companyId"')} AS company_id FROM raw_employee''',
    "id_format_check": '''SELECT count("jobId") AS n_ids, count(*) FILTER (WHERE NOT regexp_matches("jobId", '^JOB[0-9]+$')) AS n_invalid,
  count(*) FILTER (WHERE NOT regexp_matches("jobId", '^JOB[0-9]+$')) = 0 AS all_match FROM raw_employee''',
    "coerce_numeric": "SELECT job_id, years_experience, distance_from_cbd FROM emp_typed",
    "coerce_numeric_salary": "SELECT job_id, salary_k FROM sal_typed",
    "na_tokens_to_null": "SELECT job_id, job_role, education, major, industry FROM emp_typed",
    "fill_none_label": "SELECT job_id, coalesce(education, 'NONE') AS education, coalesce(major, 'NONE') AS major FROM emp_typed",
    "drop_required_nulls": "SELECT * FROM emp",
    "drop_required_nulls_salary": "SELECT * FROM sal",
    "drop_step_report": _union([
        _drop_steps("emp_typed", [
            ("employee_categories", ["job_role", "industry"]),
            ("employee_numbers", ["job_id", "company_id", "years_experience", "distance_from_cbd"]),
        ]),
        _drop_steps("sal_typed", [("salary", ["job_id", "salary_k"])]),
    ]),
    "sentinel_filters": "SELECT * FROM valid",
    "active_category_domain": _union(f"SELECT DISTINCT '{c}' AS column_name, {c} AS level FROM valid" for c in ("job_role", "industry")),
    "drop_raw_categoricals": '''SELECT job_id, years_experience, distance_from_cbd, salary_k FROM clean''',
    "null_audit": "SELECT column_name, n_null, CAST(sum(n_null) OVER () AS BIGINT) AS total_null FROM (" + _union(
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_null FROM unfiltered" for c in AUDITED_FEATURES
    ) + ")",
    "finite_clean": '''SELECT job_id, CASE WHEN distance_from_cbd = 0 THEN 0.0 ELSE salary_k / distance_from_cbd END AS per_km,
  years_experience, coalesce(CAST(industry_score AS DOUBLE), 0.0) AS industry_score FROM unfiltered''',
    # joins
    "inner_join_job": f"SELECT {CLEAN_COLUMNS} FROM merged",
    "merge_audit": '''SELECT e AS employee_rows, s AS salary_rows, m AS merged_rows, e - m AS employee_rows_lost, s - m AS salary_rows_lost
FROM (SELECT (SELECT count(*) FROM emp) AS e, (SELECT count(*) FROM sal) AS s, (SELECT count(*) FROM merged) AS m)''',
    "key_coverage": '''SELECT e AS employee_keys, s AS salary_keys, e - b AS only_in_employee, s - b AS only_in_salary,
  e = b AS employee_subset_of_salary, s = b AS salary_subset_of_employee
FROM (SELECT (SELECT count(DISTINCT job_id) FROM emp) AS e, (SELECT count(DISTINCT job_id) FROM sal) AS s,
  (SELECT count(DISTINCT job_id) FROM merged) AS b)''',
    "anti_join_remainder": f"SELECT {CLEAN_COLUMNS} FROM clean WHERE NOT ({BUCKET} < 2000)",
    # duplicates and outliers
    "duplicate_counts": '''SELECT (SELECT count(*) FROM emp) - (SELECT count(*) FROM (SELECT DISTINCT * FROM emp)) AS full_duplicates,
  (SELECT count(*) - count(DISTINCT job_id) FROM emp) AS key_duplicates''',
    "merged_duplicate_counts": '''SELECT (SELECT count(*) FROM merged) - (SELECT count(*) FROM (SELECT DISTINCT * FROM merged)) AS full_duplicates,
  (SELECT count(*) - count(DISTINCT job_id) FROM merged) AS key_duplicates''',
    "duplicate_listing": f"SELECT {CLEAN_COLUMNS} FROM (SELECT *, count(*) OVER (PARTITION BY job_id) AS c FROM merged) WHERE c > 1",
    "drop_duplicates_full": f"SELECT DISTINCT {CLEAN_COLUMNS} FROM merged",
    "drop_duplicates_key": f"SELECT {CLEAN_COLUMNS} FROM uniq",
    "iqr_fence": "SELECT 'JANITOR' AS job_role, q1, q3, iqr, lower_limit, upper_limit FROM fence",
    "iqr_outlier_filter": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "union_by_name": f"SELECT {CLEAN_COLUMNS} FROM clean",
    "clean_merge": f"SELECT {CLEAN_COLUMNS} FROM clean",
    # profiling
    "table_shape": _union([
        "SELECT 'raw_employee' AS table_name, count(*) AS n_rows, 8 AS n_columns FROM raw_employee",
        "SELECT 'raw_salary', count(*), 2 FROM raw_salary",
        "SELECT 'merged', count(*), 9 FROM merged",
    ]),
    "preview_rows": f"SELECT {CLEAN_COLUMNS} FROM clean ORDER BY job_id LIMIT 5",
    "schema_info": _union(
        f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS data_type, count({c}) AS n_non_null FROM emp_typed"
        for i, (c, t) in enumerate([
            ("job_id", "bigint"), ("company_id", "bigint"), ("job_role", "string"), ("education", "string"),
            ("major", "string"), ("industry", "string"), ("years_experience", "double"), ("distance_from_cbd", "double"),
        ])
    ),
    "describe_all": f'''SELECT column_name, n_rows, mean_value, std_value, min_value, q25, q50, q75, max_value,
  CAST(NULL AS BIGINT) AS n_unique, CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq FROM ({_describe_numeric(_NUMBERS, "clean")})
UNION ALL SELECT column_name, n_rows, NULL, NULL, NULL, NULL, NULL, NULL, NULL, n_unique, top, freq FROM ({_describe_text(_TEXT, "clean")})''',
    "describe_numeric": _describe_numeric(["salary_k"], "valid"),
    "missing_report": "SELECT * FROM (" + _union(
        f'''SELECT '{c}' AS column_name, count(*) FILTER (WHERE "{c}" IS NULL) AS missing_count,
  {_pct(f'count(*) FILTER (WHERE "{c}" IS NULL)', "count(*)")} AS missing_pct FROM raw_employee''' for c in EMPLOYEE_COLUMNS
    ) + ") WHERE missing_count > 0",
    "value_counts": _value_counts(("companyId", "jobRole", "education", "major", "Industry"), "raw_employee"),
    "nunique_with_null": _union(
        f"SELECT '{c}' AS column_name, count(*) AS n_unique FROM (SELECT DISTINCT \"{c}\" FROM raw_employee)" for c in EMPLOYEE_COLUMNS
    ),
    "predicate_count": "SELECT count(*) AS n FROM valid WHERE education IN ('HIGH_SCHOOL', 'NONE')",
    "outlier_listing": f'''SELECT {CLEAN_COLUMNS}, CASE WHEN distance_from_cbd > 100 THEN 'distance' ELSE 'salary' END AS reason
FROM uniq WHERE distance_from_cbd > 100 OR salary_k = 0''',
    "top_k_salary": f"SELECT {CLEAN_COLUMNS} FROM uniq WHERE salary_k <> 0 ORDER BY salary_k DESC, job_id LIMIT 25",
    "bottom_k_salary": f"SELECT {CLEAN_COLUMNS} FROM valid ORDER BY salary_k, job_id LIMIT 25",
    "skewness": "SELECT count(salary_k) AS n, round(skewness(salary_k), 9) AS skewness FROM clean",
    # questions
    "q_top_role_in_industry": '''SELECT job_role, median(salary_k) AS median_salary, count(*) AS "count" FROM clean
WHERE industry = 'WEB' GROUP BY job_role ORDER BY median_salary DESC, job_role LIMIT 1''',
    "q_roles_in_industry": '''SELECT job_role, median(salary_k) AS median_salary, count(*) AS "count" FROM clean
WHERE industry = 'WEB' GROUP BY job_role''',
    "q_top10_industry_role": '''SELECT industry || ' - ' || job_role AS role_label, median_salary, "count" FROM (
SELECT industry, job_role, median(salary_k) AS median_salary, count(*) AS "count" FROM clean GROUP BY industry, job_role
ORDER BY median_salary DESC, industry, job_role LIMIT 10)''',
    "q_industry_profile": _profile("industry", "clean", True),
    "q_lowest_paid_role": _profile("job_role", "clean", False) + " ORDER BY median_salary, job_role LIMIT 1",
    "q_role_profile": _profile("job_role", "clean", False),
    "q_lowest_paid_industry": _profile("industry", "clean", False) + " ORDER BY median_salary, industry LIMIT 1",
    "q_role_profile_raw": _profile("job_role", "valid", False),
    "q_below_median_by_industry": _below("industry"),
    "q_below_median_by_role": _below("job_role"),
    "q_median_by_experience": 'SELECT years_experience, median(salary_k) AS median_salary, count(*) AS "count" FROM clean GROUP BY years_experience',
    "q_experience_trend": _trend("years_experience"),
    "q_experience_pearson": '''SELECT n, round(r, 9) AS pearson_r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t_stat
FROM (SELECT count(*) AS n, corr(years_experience, salary_k) AS r FROM clean)''',
    "q_experience_pearson_test": _pearson_test(["years_experience, salary_k"], names=False),
    "q_pearson_pairs": _pearson_test(["job_id, salary_k", "company_id, distance_from_cbd", "job_id, years_experience"], names=True),
    "q_education_spearman": f'''SELECT count(*) AS n, round(corr(rx, ry), 9) AS spearman_rho FROM (
SELECT {_AVERAGE_RANK.format(c="education_level")} AS rx, {_AVERAGE_RANK.format(c="salary_k")} AS ry FROM features)''',
    "q_median_by_education": "SELECT l.level, l.education, m.median_salary FROM (VALUES " + ", ".join(
        f"({v}, '{k}')" for k, v in EDUCATION_LEVEL.items()
    ) + ") l(level, education) LEFT JOIN (SELECT education, median(salary_k) AS median_salary FROM clean GROUP BY education) m ON l.education = m.education",
    "q_major_ranking": 'SELECT major, median(salary_k) AS median_salary, count(*) AS "count" FROM clean GROUP BY major',
    "q_median_by_distance": 'SELECT distance_from_cbd, median(salary_k) AS median_salary, count(*) AS "count" FROM clean GROUP BY distance_from_cbd',
    "q_distance_trend": _trend("distance_from_cbd"),
    "q_company_ranking": 'SELECT company_id, median(salary_k) AS median_salary, count(*) AS "count" FROM clean GROUP BY company_id',
    "correlation_matrix": _union(
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 9) AS corr FROM features" for a in _CORR for b in _CORR
    ),
    # chart tables
    "chart_category_counts": _value_counts(_TEXT, "valid", nulls=False),
    "chart_whisker_stats": '''SELECT greatest(lo, q1 - 1.5 * (q3 - q1)) AS lower_whisker, q1, median, q3, least(hi, q3 + 1.5 * (q3 - q1)) AS upper_whisker
FROM (SELECT quantile_cont(salary_k, 0.25) AS q1, median(salary_k) AS median, quantile_cont(salary_k, 0.75) AS q3,
  CAST(min(salary_k) AS DOUBLE) AS lo, CAST(max(salary_k) AS DOUBLE) AS hi FROM clean)''',
    "chart_percentile_marks": _union(
        f"SELECT '{c}' AS column_name, " + ", ".join(
            f"round(quantile_cont({c}, {p}), 9) AS {n}"
            for n, p in [("p01", 0.01), ("q25", 0.25), ("q50", 0.5), ("q75", 0.75), ("p99", 0.99)]
        ) + " FROM uniq" for c in ("years_experience", "distance_from_cbd")
    ),
    "chart_grouped_box_stats": _union(_box(by) for by in ("job_role", "major", "company_id")),
    "chart_bar_values": _union(
        f"SELECT '{e}' AS estimator, {by} AS category, round({f}(salary_k), 6) AS bar_value FROM clean GROUP BY {by}"
        for e, f, by in [("mean", "avg", "industry"), ("median", "median", "major")]
    ),
    "melt_metrics": _union(
        f'''SELECT industry, '{m}' AS "Metric", CAST({m} AS DOUBLE) AS "Value" FROM ({_profile("industry", "clean", True)})'''
        for m in ("median_salary", "highest_salary", "lowest_salary", "salary_delta")
    ),
    "confusion_matrix": '''SELECT t.v AS y_true, p.v AS y_pred, (SELECT count(*) FROM below b WHERE b.y_true = t.v AND b.y_pred = p.v) AS n
FROM (VALUES (0), (1)) t(v), (VALUES (0), (1)) p(v)''',
    "classification_report": '''SELECT label, round(precision_, 9) AS precision, round(recall_, 9) AS recall, round(f1, 9) AS f1, support FROM (
SELECT label, precision_, recall_, f1, support FROM per
UNION ALL SELECT 'accuracy', a, a, a, n FROM (SELECT sum(hits) / sum(support) AS a, CAST(sum(support) AS BIGINT) AS n FROM per)
UNION ALL SELECT 'macro avg', avg(precision_), avg(recall_), avg(f1), CAST(sum(support) AS BIGINT) FROM per
UNION ALL SELECT 'weighted avg', sum(precision_ * support) / sum(support), sum(recall_ * support) / sum(support),
  sum(f1 * support) / sum(support), CAST(sum(support) AS BIGINT) FROM per)''',
    "roc_pr_curves": '''SELECT round(score, 6) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(fp / neg, 9) AS fpr,
  round(tp / pos, 9) AS tpr, round(tp / (tp + fp), 9) AS precision, round(tp / pos, 9) AS recall FROM points''',
    "roc_pr_auc": '''SELECT round(sum((fp - fp0) * (tp + tp0) / 2) / max(pos) / max(neg), 9) AS roc_auc,
  round(sum((tp - tp0) * (tp / (tp + fp) + CASE WHEN tp0 + fp0 = 0 THEN 1 ELSE tp0 / (tp0 + fp0) END) / 2) / max(pos), 9) AS prc_auc FROM points''',
    "residuals": "SELECT job_id, y_true, round(y_pred, 6) AS y_pred, round(y_true - y_pred, 6) AS residual FROM pred",
    "residual_line": '''SELECT round(least(min(y_true), min(y_pred)), 6) AS line_min, round(greatest(max(y_true), max(y_pred)), 6) AS line_max FROM pred''',
    # features
    "encode_ordinals": "SELECT job_id, education_level, job_role_rank, industry_score, major_score FROM unfiltered",
    "handcrafted_score": "SELECT job_id, handcrafted_score FROM unfiltered",
    "interaction_features": "SELECT job_id, edu_major, industry_role FROM unfiltered",
    "downcast_scores": "SELECT job_id, " + ", ".join(
        f"CAST({c} AS TINYINT) AS {c}" for c in ("education_level", "job_role_rank", "industry_score", "major_score")
    ) + " FROM features",
    "build_features": "SELECT * FROM features",
    "category_codes": '''SELECT job_id, CAST(dense_rank() OVER (ORDER BY edu_major) - 1 AS INTEGER) AS edu_major,
  CAST(dense_rank() OVER (ORDER BY industry_role) - 1 AS INTEGER) AS industry_role FROM features''',
    "string_index": f'''SELECT job_id, CAST(coalesce(a.code, (SELECT count(DISTINCT edu_major) FROM parts WHERE split = 'train')) AS INTEGER) AS edu_major,
  CAST(coalesce(c.code, (SELECT count(DISTINCT industry_role) FROM parts WHERE split = 'train')) AS INTEGER) AS industry_role
FROM parts LEFT JOIN {_codes("edu_major")} a ON parts.edu_major = a.edu_major
LEFT JOIN {_codes("industry_role")} c ON parts.industry_role = c.industry_role''',
    "clamp_codes": '''SELECT job_id, CAST(least(dense_rank() OVER (ORDER BY edu_major) - 1, 19) AS INTEGER) AS edu_major,
  CAST(least(dense_rank() OVER (ORDER BY industry_role) - 1, 29) AS INTEGER) AS industry_role FROM features''',
    "one_hot": _union(
        f"SELECT '{c}_' || {c} AS feature_name, count(*) AS n FROM features GROUP BY {c}" for c in ("edu_major", "industry_role")
    ),
    "one_hot_vectors": _union(f"SELECT job_id, '{c}_' || {c} AS feature_name FROM features" for c in ("edu_major", "industry_role")),
    "cast_numeric_features": "SELECT job_id, salary_k, edu_major, industry_role, " + ", ".join(
        f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES
    ) + " FROM unfiltered",
    "median_impute": "SELECT job_id, " + ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT CAST(quantile_disc({c}, 0.5) AS DOUBLE) FROM unfiltered)) AS {c}" for c in NUMERIC_FEATURES
    ) + " FROM unfiltered",
    "minmax_target": '''SELECT job_id, split, round((salary_k - lo) / (hi - lo), 9) AS y_scaled, CAST(salary_k AS DOUBLE) AS y_restored
FROM parts, (SELECT CAST(min(salary_k) AS DOUBLE) AS lo, CAST(max(salary_k) AS DOUBLE) AS hi FROM parts WHERE split = 'train') r''',
    "assemble_features": "SELECT job_id, " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUMERIC_FEATURES) + " FROM features",
    "standard_scale": "SELECT job_id, " + ", ".join(
        f"round(({c} - (SELECT avg({c}) FROM features)) / (SELECT stddev_samp({c}) FROM features), 9) AS {c}" for c in NUMERIC_FEATURES
    ) + " FROM features",
    # splits
    "split_64_16_20": "SELECT job_id, split FROM parts",
    "split_70_15_15": '''SELECT job_id, CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'val' ELSE 'test' END AS split FROM parts''',
    "split_fallbacks": '''SELECT job_id, CASE WHEN b < 100 THEN 'test' WHEN b < 2080 THEN 'valid' ELSE 'train' END AS split FROM parts''',
    "split_sizes": "SELECT split, count(*) AS n FROM parts GROUP BY split",
    # models and evaluation
    "linear_regression": "SELECT job_id, y_true, round(y_pred, 2) AS y_pred, split FROM ols",
    "linear_regression_metrics": _metrics("ols", "split", 4),
    "regression_metrics": _metrics("pred", "split", 6),
    "predictions_table": "SELECT job_id, y_true, round(y_pred, 6) AS y_pred, split FROM pred",
    "linear_regression_onehot": "SELECT job_id, y_true, round(y_pred, 4) AS y_pred, split FROM oh_pred",
    "linear_regression_onehot_metrics": _metrics("oh_pred", "split", 4),
    # forests, grown in SQL
    **{k: v for key in ("random_forest", "random_forest_onehot") for k, v in {
        key: "SELECT job_id, y_true, round(y_pred, 6) AS y_pred, split FROM forest_pred",
        f"{key}_metrics": _metrics("forest_pred", "split", 6),
        f"{key}_weights": "SELECT feature, round(weight, 9) AS weight FROM forest_weights",
    }.items()},
    # models that only fit iteratively: which rows they predict, and that they beat the straight line
    **_model_checks("random_forest", "parts70", "in_range"),
    **_model_checks("linear_regression_onehot", "parts", "finite"),
    **_model_checks("random_forest_onehot", "parts", "in_range"),
    **_model_checks("embedding_regressor", "parts", "finite", "= 'test'"),
    **{f"{key}_replay": "SELECT job_id, TRUE AS replayed FROM parts WHERE split = 'test'" for key in ("embedding_regressor", "finetune_grid")},
    **_model_checks("finetune_grid", "parts", "finite", "= 'test'"),
    "model_comparison": f'''SELECT model, split, rmse, mae, r2 FROM ({_metrics("(" + _union([_line_pred("years_experience"), _line_pred("distance_from_cbd")]) + ")", "model, split", 4)})''',
}

_SPLIT70 = '''parts70 AS (
SELECT * EXCLUDE (split), CASE WHEN b < 7000 THEN 'train' WHEN b < 8500 THEN 'val' ELSE 'test' END AS split FROM parts
)'''
_PER_CLASS = '''per AS (
SELECT CAST(v AS VARCHAR) AS label, hits, support, CASE WHEN named = 0 THEN 0 ELSE hits / named END AS precision_,
  CASE WHEN support = 0 THEN 0 ELSE hits / support END AS recall_,
  CASE WHEN hits = 0 THEN 0 ELSE 2 * (hits / named) * (hits / support) / (hits / named + hits / support) END AS f1
FROM (SELECT v, count(*) FILTER (WHERE y_true = v AND y_pred = v) AS hits, count(*) FILTER (WHERE y_true = v) AS support,
  count(*) FILTER (WHERE y_pred = v) AS named FROM below, (VALUES (0), (1)) l(v) GROUP BY v)
)'''
# the handcrafted score is the sum of the four others, so it adds nothing to the span
_OLS = _least_squares([c for c in NUMERIC_FEATURES if c != "handcrafted_score"])
# fixed values: the published number of trees and depth; a third of the seven columns is drawn at each node
_FOREST = f"{_SPLIT70}, {forest_sql.forest('parts70', NUMERIC_FEATURES, (), 100, 10, 3)}"
_FOREST_ONEHOT = forest_sql.forest("parts", NUMERIC_FEATURES, CATEGORICAL_FEATURES, 100, None, None)
_OLS_ONEHOT = _least_squares_onehot(NUMERIC_FEATURES, CATEGORICAL_FEATURES)
_EXTRA_VIEWS = {
    "linear_regression_onehot": _OLS_ONEHOT, "linear_regression_onehot_metrics": _OLS_ONEHOT,
    **{f"random_forest{part}": _FOREST for part in ("", "_metrics", "_weights")},
    **{f"random_forest_onehot{part}": _FOREST_ONEHOT for part in ("", "_metrics", "_weights")},
    "classification_report": _PER_CLASS, "roc_pr_curves": _CURVE, "roc_pr_auc": _CURVE,
    "linear_regression": _OLS, "linear_regression_metrics": _OLS,
    "random_forest_rows": _SPLIT70, "random_forest_beats_line": _SPLIT70,
}


def oracle_sql() -> dict[str, str]:
    """Complete SQL text per query key."""
    texts = {}
    for key, body in _BODIES.items():
        extra = f", {_EXTRA_VIEWS[key]}" if key in _EXTRA_VIEWS else ""
        texts[key] = f"{VIEWS.rstrip()}{extra}\n{body}"
    return texts
