"""The derived dirty panel: orders joined to customers, with dirt added by arithmetic on the keys.

The text runs unchanged on any SQL engine, so a second engine can check results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from panelkit.spec import PanelSpec, Ratio

PANEL_SQL = """
WITH b AS (
  SELECT o.o_orderkey AS k, o.o_custkey AS c, o.o_orderdate AS dt, o.o_totalprice AS tp, o.o_orderstatus AS st,
         o.o_orderpriority AS pr, cu.c_mktsegment AS seg,
         (o.o_orderkey * 7919 + o.o_custkey * 104729) % 9973 AS h,
         (o.o_custkey * 7919) % 9973 AS hc
  FROM orders o JOIN customer cu ON cu.c_custkey = o.o_custkey)
SELECT k AS row_id, concat('CUS_', CAST(c AS STRING)) AS customer_id, dt AS as_of,
  CAST(month(dt) AS STRING) AS month,
  concat('Person ', CAST(c AS STRING)) AS name,
  CASE WHEN h % 37 = 5 THEN '-500' WHEN h % 41 = 7 THEN '8698' WHEN h % 20 = 1 THEN concat(CAST(16 + hc % 60 AS STRING), '_')
       ELSE CAST(16 + hc % 60 AS STRING) END AS age,
  CASE WHEN h % 14 = 3 THEN '_______' ELSE seg END AS occupation,
  CASE WHEN h % 15 = 2 THEN concat(CAST(7000 + hc * 18 AS STRING), '_') ELSE CAST(7000 + hc * 18 AS STRING) END AS annual_income,
  CASE WHEN h % 20 IN (0, 7, 13) THEN NULL ELSE (7000 + hc * 18) / 12.0E0 END AS monthly_salary,
  CAST(CASE WHEN h % 50 = 9 THEN 5797 ELSE 1 + (hc + h % 3) % 34 END AS INT) AS interest_rate,
  CASE WHEN h % 25 = 4 THEN '-100' WHEN h % 21 = 6 THEN concat(CAST(hc % 10 AS STRING), '_') ELSE CAST(hc % 10 AS STRING) END AS num_loans,
  CASE WHEN h % 14 = 11 THEN NULL WHEN h % 70 = 8 THEN '4397' WHEN h % 33 = 2 THEN concat(CAST((hc + h % 5) % 28 AS STRING), '_')
       ELSE CAST((hc + h % 5) % 28 AS STRING) END AS num_delayed,
  CAST(h % 70 - 4 AS INT) AS days_past_due,
  CASE WHEN h % 48 = 1 THEN '_' ELSE CAST(hc % 30 - 6 AS STRING) END AS changed_limit,
  CAST(CAST(floor(tp) AS BIGINT) AS STRING) AS outstanding_debt,
  20.0E0 + (h % 3001) / 100.0E0 AS utilization,
  (h % 16001) / 10.0E0 AS emi,
  CASE WHEN h % 22 = 5 THEN NULL WHEN h % 23 = 6 THEN '__10000__' ELSE CAST(h % 1900 AS STRING) END AS invested,
  CASE WHEN h % 83 = 4 THEN NULL WHEN h % 997 = 9 THEN '__-333333333333333333333333333__' ELSE CAST(hc % 1600 + h % 7 AS STRING) END AS balance,
  CASE WHEN h % 5 = 2 THEN '_' WHEN pr = '4-NOT SPECIFIED' THEN 'Standard' WHEN pr IN ('1-URGENT', '2-HIGH') THEN 'Good' ELSE 'Bad' END AS credit_mix,
  CASE WHEN h % 13 = 6 THEN '!@9#%8' ELSE concat('spent_', st) END AS payment_behaviour,
  CASE WHEN h % 11 = 3 THEN NULL ELSE concat(CAST(hc % 33 AS STRING), ' Years and ', CAST(h % 12 AS STRING), ' Months') END AS history_age,
  CASE hc % 8 WHEN 0 THEN NULL WHEN 1 THEN 'Not Specified' WHEN 2 THEN 'Auto Loan, Payday Loan, and Home Equity Loan'
       WHEN 3 THEN 'Auto Loan, Auto Loan, and Student Loan' WHEN 4 THEN 'Credit-Builder Loan'
       WHEN 5 THEN 'Mortgage Loan, and Student Loan' WHEN 6 THEN 'Personal Loan, Not Specified, and Payday Loan'
       ELSE 'Debt Consolidation Loan, and Auto Loan' END AS loan_types,
  CASE WHEN h % 17 = 0 THEN 'Standard' WHEN (hc + h % 3) % 34 >= 24 THEN 'Poor' WHEN (hc + h % 3) % 34 < 6 THEN 'Good' ELSE 'Standard' END AS score
FROM b
"""

PANEL_SPEC = PanelSpec(
    entity="customer_id",
    order=("as_of", "row_id"),
    row_id="row_id",
    label="score",
    placeholders=("_", "_______", "!@9#%8"),
    numeric_text=(
        "age", "annual_income", "num_loans", "num_delayed",
        "changed_limit", "outstanding_debt", "invested", "balance",
    ),
    bounds={"age": (18, 100), "interest_rate": (0, 100), "num_loans": (0, 20), "num_delayed": (0, 100)},
    lower_only={"days_past_due": 0, "balance": 0},
    identifiers=("name",),
    duration="history_age",
    duration_months="history_months",
    multilabel="loan_types",
    multilabel_prefix="Loan_",
    ratios=(
        Ratio("debt_to_income", "outstanding_debt", "annual_income"),
        Ratio("emi_to_salary", "emi", "monthly_salary"),
        Ratio("savings_rate", "invested", "monthly_salary"),
        Ratio("delay_per_loan", "num_delayed", "num_loans"),
    ),
    profile_numeric=(
        "age", "annual_income", "monthly_salary", "interest_rate", "num_loans", "days_past_due",
        "num_delayed", "outstanding_debt", "utilization", "emi", "invested", "balance",
    ),
    profile_categorical=("month", "occupation", "credit_mix", "payment_behaviour"),
    key_features=("outstanding_debt", "interest_rate", "days_past_due", "num_delayed", "utilization", "balance"),
    label_order=("Poor", "Standard", "Good"),
    regression_target="balance",
    cluster_features=(
        "annual_income", "monthly_salary", "emi", "invested", "balance", "outstanding_debt", "utilization",
    ),
)


def derived_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel over ``orders`` and ``customer`` under ``sf_dir``; one lazy plan, no rows left out."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return spark.sql(
        PANEL_SQL.replace("FROM orders o JOIN customer cu", "FROM {orders} o JOIN {customer} cu"),
        orders=orders,
        customer=customer,
    )
