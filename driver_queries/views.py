"""The driver's tables seen as loans and as scored rows, in Spark and in SQL.

``LOANS`` and ``SCORED`` are chains of common table expressions; a query's SQL
is one of them followed by its own SELECT.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loanweft.functions.text import WHITESPACE
from loanweft.operators.labels import BAD_STATUSES, GOOD_STATUSES, UNRESOLVED_STATUSES, add_target, keep_labeled
from loanweft.operators.splits import add_parsed_month, fit_time_split
from loanweft.session import materialize

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round sums of doubles, whose last digits depend on the order of addition."""
    return df.withColumns({name: F.round(name, digits) for name in columns})


def sql_list(values: Sequence[str]) -> str:
    return ", ".join("'" + value.replace("'", "''") + "'" for value in values)


def loans(spark: SparkSession, folder: str) -> DataFrame:
    orders, customer, nation = (table(spark, folder, name) for name in ("orders", "customer", "nation"))
    key, customer_key = F.col("o_orderkey"), F.col("o_custkey")
    joined = orders.join(customer, customer_key == F.col("c_custkey")).join(
        nation, F.col("c_nationkey") == F.col("n_nationkey"))
    status = (
        F.when(key % 97 == 0, F.lit(None))
        .when(F.col("o_orderstatus") == "F", F.when(key % 10 == 0, "  Fully Paid ").otherwise("Fully Paid"))
        .when(F.col("o_orderstatus") == "P",
              F.when(key % 3 == 0, "Charged Off").when(key % 3 == 1, "Default").otherwise("Late (31-120 days)"))
        .otherwise(F.when(key % 2 == 0, "Current").otherwise("Late (16-30 days)")))
    issued = F.when(key % 101 == 0, F.lit(None)).when(key % 103 == 0, "unknown").otherwise(
        F.date_format("o_orderdate", "MMM-yyyy"))
    first_line = F.add_months(F.to_date("o_orderdate"), -(customer_key % 240).cast("int"))
    return joined.select(
        key.alias("id"),
        F.concat(F.lit("https://loans.example/"), key.cast("string")).alias("url"),
        status.alias("loan_status"),
        issued.alias("issue_d"),
        F.col("o_totalprice").alias("loan_amnt"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("annual_inc"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("emp_length"),
        F.col("c_mktsegment").alias("purpose"),
        F.col("n_name").alias("addr_state"),
        F.when(key % 3 == 0, " 60 months").otherwise(" 36 months").alias("term"),
        F.when(customer_key % 20 == 0, "Joint App").otherwise("Individual").alias("application_type"),
        F.col("n_regionkey").cast("double").alias("open_acc"),
        F.when(key % 211 != 0, ((key * 7919) % 4000).cast("double") / F.lit(100.0)).alias("dti"),
        F.when(key % 5 < 2, ((key * 31) % 120).cast("double")).alias("il_util"),
        F.date_format(first_line, "MMM-yyyy").alias("earliest_cr_line"),
        F.concat(F.lit("Loan of "), F.col("c_name")).alias("title"),
        (F.col("o_totalprice") * F.lit(0.5)).alias("total_pymnt"),
        F.when(key % 7 == 0, "Y").otherwise("N").alias("hardship_flag"),
        F.substring(F.lit("ABCDEFG"), (key % 7 + 1).cast("int"), F.lit(1)).alias("grade"),
        F.lit(None).cast("double").alias("member_id"),
        F.lit(1).alias("policy_code"),
    )


# (column, type as Spark names it), in order
LOAN_COLUMNS = (
    ("id", "bigint"), ("url", "string"), ("loan_status", "string"), ("issue_d", "string"), ("loan_amnt", "double"),
    ("annual_inc", "double"), ("emp_length", "string"), ("purpose", "string"), ("addr_state", "string"),
    ("term", "string"), ("application_type", "string"), ("open_acc", "double"), ("dti", "double"),
    ("il_util", "double"), ("earliest_cr_line", "string"), ("title", "string"), ("total_pymnt", "double"),
    ("hardship_flag", "string"), ("grade", "string"), ("member_id", "double"), ("policy_code", "int"),
)
LABELED_COLUMNS = (*LOAN_COLUMNS, ("bad_loan", "int"))


def labeled(spark: SparkSession, folder: str) -> DataFrame:
    return keep_labeled(add_target(loans(spark, folder)))


def dated(spark: SparkSession, folder: str) -> DataFrame:
    """Labeled loans with a usable month."""
    return add_parsed_month(labeled(spark, folder)).where(F.col("issue_month").isNotNull())


def dated_table(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    """``dated`` as a written table, for steps that read it several times."""
    rows = dated(spark, folder)
    return materialize(rows.select("id", "issue_month", *columns) if columns else rows, "dated")


def split_loans(spark: SparkSession, folder: str, *columns: str) -> DataFrame:
    rows = dated_table(spark, folder, *columns)
    return fit_time_split(rows).apply(rows)


def month_sql(column: str) -> str:
    """Month text to date in DuckDB; NULL for anything else."""
    return f"cast(try_strptime({column}, '%b-%Y') as date)"


_TRIM = f"trim(loan_status, {' || '.join(f'chr({ord(c)})' for c in WHITESPACE)})"

LOANS = f"""
WITH loans AS (
  SELECT o_orderkey AS id, 'https://loans.example/' || cast(o_orderkey AS varchar) AS url,
    CASE WHEN o_orderkey % 97 = 0 THEN NULL
         WHEN o_orderstatus = 'F' THEN CASE WHEN o_orderkey % 10 = 0 THEN '  Fully Paid ' ELSE 'Fully Paid' END
         WHEN o_orderstatus = 'P' THEN CASE o_orderkey % 3 WHEN 0 THEN 'Charged Off' WHEN 1 THEN 'Default'
                                       ELSE 'Late (31-120 days)' END
         ELSE CASE WHEN o_orderkey % 2 = 0 THEN 'Current' ELSE 'Late (16-30 days)' END END AS loan_status,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderkey % 103 = 0 THEN 'unknown'
         ELSE strftime(o_orderdate, '%b-%Y') END AS issue_d,
    o_totalprice AS loan_amnt,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS annual_inc,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS emp_length,
    c_mktsegment AS purpose, n_name AS addr_state,
    CASE WHEN o_orderkey % 3 = 0 THEN ' 60 months' ELSE ' 36 months' END AS term,
    CASE WHEN o_custkey % 20 = 0 THEN 'Joint App' ELSE 'Individual' END AS application_type,
    cast(n_regionkey AS double) AS open_acc,
    CASE WHEN o_orderkey % 211 <> 0 THEN cast((o_orderkey * 7919) % 4000 AS double) / 100e0 END AS dti,
    CASE WHEN o_orderkey % 5 < 2 THEN cast((o_orderkey * 31) % 120 AS double) END AS il_util,
    strftime(cast(o_orderdate AS date) - to_months(cast(o_custkey % 240 AS integer)), '%b-%Y') AS earliest_cr_line,
    'Loan of ' || c_name AS title,
    o_totalprice * 0.5e0 AS total_pymnt,
    CASE WHEN o_orderkey % 7 = 0 THEN 'Y' ELSE 'N' END AS hardship_flag,
    substr('ABCDEFG', cast(o_orderkey % 7 + 1 AS integer), 1) AS grade,
    cast(NULL AS double) AS member_id, cast(1 AS integer) AS policy_code
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
), targeted AS (
  SELECT *, CASE WHEN {_TRIM} IN ({sql_list(GOOD_STATUSES)}) THEN 0
                 WHEN {_TRIM} IN ({sql_list(BAD_STATUSES)}) THEN 1 END AS bad_loan,
    CASE WHEN loan_status IS NULL THEN 'missing' WHEN {_TRIM} IN ({sql_list(GOOD_STATUSES)}) THEN 'good'
         WHEN {_TRIM} IN ({sql_list(BAD_STATUSES)}) THEN 'bad'
         WHEN {_TRIM} IN ({sql_list(UNRESOLVED_STATUSES)}) THEN 'unresolved' ELSE 'unmapped' END AS status_category
  FROM loans
), labeled AS (SELECT * FROM targeted WHERE bad_loan IS NOT NULL
), dated AS (SELECT *, {month_sql('issue_d')} AS issue_month FROM labeled WHERE {month_sql('issue_d')} IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (ORDER BY issue_month, id) AS pos, count(*) OVER () AS n FROM dated
), splits AS (
  SELECT *, CASE WHEN pos <= cast(floor(n * 0.7e0) AS bigint) THEN 'train'
                 WHEN pos <= cast(floor(n * 0.7e0) AS bigint) + cast(floor(n * 0.15e0) AS bigint) THEN 'validation'
                 ELSE 'test' END AS modeling_split
  FROM placed
)
"""


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Scores from integer arithmetic, so that ties and bin edges are exact in both engines."""
    key = F.col("o_orderkey")
    step = (key * 7919) % 101
    p = step.cast("double") / F.lit(100.0)
    chance = ((key * 104729) % 997).cast("double") / F.lit(996.0)
    fine = ((key * 7919) % 100003).cast("double") / F.lit(100003.0)
    return table(spark, folder, "orders").select(
        key.alias("id"), p.alias("p"), ((step - 50).cast("double") / F.lit(10.0)).alias("z"),
        F.when(chance < F.lit(0.1) + F.lit(0.4) * p, 1).otherwise(0).alias("bad_loan"),
        (F.year("o_orderdate") * 12 + F.month("o_orderdate")).cast("int").alias("month_no"),
        F.col("o_totalprice").alias("loan_amnt"), fine.alias("p_fine"),
        (p * F.lit(0.5) + F.lit(0.1)).alias("p_shrunk"), (F.floor(p * F.lit(10.0)) / F.lit(10.0)).alias("p_coarse"))


SCORED = """
WITH scored AS (
  SELECT o_orderkey AS id, cast((o_orderkey * 7919) % 101 AS double) / 100e0 AS p,
    cast((o_orderkey * 7919) % 101 - 50 AS double) / 10e0 AS z,
    CASE WHEN cast((o_orderkey * 104729) % 997 AS double) / 996e0
              < 0.1e0 + 0.4e0 * (cast((o_orderkey * 7919) % 101 AS double) / 100e0) THEN 1 ELSE 0 END AS bad_loan,
    cast(year(o_orderdate) * 12 + month(o_orderdate) AS integer) AS month_no, o_totalprice AS loan_amnt,
    cast((o_orderkey * 7919) % 100003 AS double) / 100003e0 AS p_fine,
    (cast((o_orderkey * 7919) % 101 AS double) / 100e0) * 0.5e0 + 0.1e0 AS p_shrunk,
    floor((cast((o_orderkey * 7919) % 101 AS double) / 100e0) * 10e0) / 10e0 AS p_coarse
  FROM orders
)
"""

# candidates of the comparison queries: method -> column of ``scored``
CANDIDATES = {"uncalibrated": "p", "shrunk": "p_shrunk", "coarse": "p_coarse", "fine": "p_fine"}

CANDIDATE_ROWS = SCORED + ", long AS (" + " UNION ALL ".join(
    f"SELECT id, bad_loan, p AS reference_p, {number} AS method_order, '{method}' AS method, {column} AS p FROM scored"
    for number, (method, column) in enumerate(CANDIDATES.items())) + ")"


def named(df: DataFrame, **columns: Column) -> DataFrame:
    return df.select(*[column.alias(name) for name, column in columns.items()])
