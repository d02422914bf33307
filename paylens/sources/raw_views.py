"""Raw employee and salary tables derived from ``orders`` and ``customer``.

The two raw files are not published, so tables of the same shape and the same
dirt (missing values, tokens, both kinds of duplicates, invalid rows, ids that
only one side has) are derived from the given tables, row for row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paylens.schemas import EMPLOYEE_COLUMNS

# --- fixed values: labels in code order ---
ROLES = ("CEO", "CTO", "CFO", "VICE_PRESIDENT", "MANAGER", "SENIOR", "JUNIOR", "JANITOR")
DEGREES = ("NONE", "HIGH_SCHOOL", "BACHELORS", "MASTERS", "DOCTORAL")
MAJORS = (
    "NONE", "LITERATURE", "BIOLOGY", "CHEMISTRY", "PHYSICS", "COMPSCI", "MATH", "BUSINESS",
    "ENGINEERING", "nan",
)
INDUSTRIES = ("EDUCATION", "SERVICE", "AUTO", "HEALTH", "WEB", "FINANCE", "OIL")
ROLE_STEPS = (6, 5, 5, 4, 3, 2, 1, 0)


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _pick(values, index: Column) -> Column:
    """Element of a short literal list by zero-based index, null past its end."""
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    customer = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k, ck = F.col("o_orderkey"), F.col("o_custkey")
    return orders.join(customer, ck == F.col("c_custkey")).select(
        k.alias("k"),
        ck.alias("ck"),
        F.floor("o_totalprice").cast("bigint").alias("tp"),
        F.col("c_nationkey").alias("nk"),
        ((k * 7 + ck) % 8).alias("r"),
        ((k * 31 + ck * 3) % 6).alias("e"),
        ((k * 17 + ck) % 10).alias("m"),
        (ck % 25).alias("y"),
        ((k * 13 + ck) % 100).alias("d"),
    )


def raw_employee(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight text columns, one row per employee plus the planted duplicates."""
    k = F.col("k")

    def at(divisor: int, rest: int) -> Column:
        return k % divisor == rest

    one = _base(spark, sf_dir).select(
        F.when(~at(997, 0), F.concat(F.lit("JOB"), k.cast("string"))).alias("jobId"),
        F.when(~at(991, 3), F.concat(F.lit("COMP"), (F.col("ck") % 63).cast("string"))).alias("companyId"),
        F.when(at(5000, 17), "PRESIDENT").when(at(983, 4), None).when(at(983, 5), "NA")
        .otherwise(_pick(ROLES, F.col("r"))).alias("jobRole"),
        F.when(F.col("e") < 5, _pick(DEGREES, F.col("e"))).when(k % 2 == 0, "NA").alias("education"),
        _pick(MAJORS, F.col("m")).alias("major"),
        F.when(at(5000, 17), "GOVERNMENT").when(at(971, 6), None)
        .otherwise(_pick(INDUSTRIES, F.col("nk") % 7)).alias("Industry"),
        F.when(at(977, 7), "NA").otherwise(F.col("y").cast("string")).alias("yearsExperience"),
        F.when(at(967, 8), None).when(at(7001, 9), "9999")
        .otherwise(F.col("d").cast("string")).alias("distanceFromCBD"),
    )
    # duplicates are unrolled from each row, so the join behind it runs once;
    # the flag tells the copies whose major is changed
    copies = F.array_compact(F.array(
        F.lit(False),
        F.when(F.col("jobId").like("%77"), F.lit(False)),
        F.when(F.col("jobId").like("%555"), F.lit(True)),
    ))
    return one.select("*", F.explode(copies).alias("changed")).select(*[
        F.when(F.col("changed"), "MATH").otherwise(F.col("major")).alias("major") if c == "major" else F.col(c)
        for c in EMPLOYEE_COLUMNS
    ])


def raw_salary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two text columns; some ids of the employee side are missing here."""
    k = F.col("k")
    pay = F.floor(
        40 + 12 * _pick(ROLE_STEPS, F.col("r")) + 6 * (F.col("e") % 5) + 2 * F.col("y")
        - F.col("d") / 4.0 + F.col("tp") % 40
    ).cast("bigint").cast("string")
    return _base(spark, sf_dir).where(k % 941 != 14).select(
        F.when(k % 953 != 10, F.concat(F.lit("JOB"), k.cast("string"))).alias("jobId"),
        F.when(k % 947 == 11, None).when(k % 3001 == 12, "0").when(k % 9001 == 13, "10000000")
        .when((F.col("r") == 7) & (k % 97 == 0), "290").otherwise(pay).alias("salaryInThousands"),
    )
