"""Declarative description of a dirty panel table."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

OUTLIER_MODES = ("none", "domain", "domain_percentile")


@dataclass(frozen=True)
class Ratio:
    """``name = numerator / (denominator + 1)``."""

    name: str
    numerator: str
    denominator: str


@dataclass(frozen=True)
class PanelSpec:
    """What the operators need to know about a table.

    Columns named here but absent from a table are skipped, so one spec serves
    a table at every stage of preparation.
    """

    entity: str
    order: tuple[str, ...]
    row_id: str
    label: str
    placeholders: tuple[str, ...] = ()
    numeric_text: tuple[str, ...] = ()
    bounds: dict[str, tuple[float, float]] = field(default_factory=dict)
    lower_only: dict[str, float] = field(default_factory=dict)
    identifiers: tuple[str, ...] = ()
    duration: str | None = None
    duration_months: str | None = None
    multilabel: str | None = None
    multilabel_prefix: str = "Loan_"
    ratios: tuple[Ratio, ...] = ()
    profile_numeric: tuple[str, ...] = ()
    profile_categorical: tuple[str, ...] = ()
    key_features: tuple[str, ...] = ()
    label_order: tuple[str, ...] = ()
    regression_target: str | None = None
    cluster_features: tuple[str, ...] = ()
    trim: tuple[float, float] = (0.005, 0.995)
    month_name: str | None = None  # a column of month names that the first order column numbers where it is absent

    def keys(self) -> tuple[str, ...]:
        """Columns that say which row it is; never filled, trimmed or modelled."""
        return tuple(dict.fromkeys((self.entity, self.row_id, *self.order)))

    def present(self, df: DataFrame, columns: Iterable[str]) -> list[str]:
        have = set(df.columns)
        return [c for c in columns if c in have]


#: Classes of a label beyond which a table of class pairs, or a number per class, stops being small.
MAX_CLASSES = 1_000


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def string_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and f.name not in skip]


# The public credit-score table's column names, placeholder
# tokens and domain limits. Results depend on them, so they are stated as is.
CREDIT_PANEL = PanelSpec(
    entity="Customer_ID",
    order=("Month_Number",),
    row_id="ID",
    label="Credit_Score",
    placeholders=("_", "_______", "!@9#%8"),
    numeric_text=(
        "Age", "Annual_Income", "Num_of_Loan", "Num_of_Delayed_Payment",
        "Changed_Credit_Limit", "Outstanding_Debt", "Amount_invested_monthly", "Monthly_Balance",
    ),
    bounds={
        "Age": (18, 100),
        "Num_Bank_Accounts": (0, 20),
        "Num_Credit_Card": (0, 20),
        "Interest_Rate": (0, 100),
        "Num_of_Loan": (0, 20),
        "Num_of_Delayed_Payment": (0, 100),
        "Num_Credit_Inquiries": (0, 100),
    },
    lower_only={"Delay_from_due_date": 0, "Monthly_Balance": 0},
    identifiers=("Name", "SSN"),
    duration="Credit_History_Age",
    duration_months="Credit_History_Age_Months",
    multilabel="Type_of_Loan",
    multilabel_prefix="Loan_",
    ratios=(
        Ratio("Debt_to_Income", "Outstanding_Debt", "Annual_Income"),
        Ratio("EMI_to_Salary", "Total_EMI_per_month", "Monthly_Inhand_Salary"),
        Ratio("Savings_Rate", "Amount_invested_monthly", "Monthly_Inhand_Salary"),
        Ratio("Delay_per_Loan", "Num_of_Delayed_Payment", "Num_of_Loan"),
    ),
    profile_numeric=(
        "Age", "Annual_Income", "Monthly_Inhand_Salary", "Num_Bank_Accounts", "Num_Credit_Card",
        "Interest_Rate", "Num_of_Loan", "Delay_from_due_date", "Num_of_Delayed_Payment",
        "Num_Credit_Inquiries", "Outstanding_Debt", "Credit_Utilization_Ratio",
        "Total_EMI_per_month", "Amount_invested_monthly", "Monthly_Balance",
    ),
    profile_categorical=("Month", "Occupation", "Credit_Mix", "Payment_of_Min_Amount", "Payment_Behaviour"),
    key_features=(
        "Outstanding_Debt", "Interest_Rate", "Delay_from_due_date",
        "Num_of_Delayed_Payment", "Credit_Utilization_Ratio", "Monthly_Balance",
    ),
    label_order=("Poor", "Standard", "Good"),
    month_name="Month",
    regression_target="Monthly_Balance",
    cluster_features=(
        "Annual_Income", "Monthly_Inhand_Salary", "Total_EMI_per_month", "Amount_invested_monthly",
        "Monthly_Balance", "Outstanding_Debt", "Credit_Utilization_Ratio",
    ),
)

# The public table's columns in their order, as they are read. Columns with dirt in them are text.
CREDIT_COLUMNS = (
    ("ID", "string"), ("Customer_ID", "string"), ("Month", "string"), ("Name", "string"), ("Age", "string"), ("SSN", "string"),
    ("Occupation", "string"), ("Annual_Income", "string"), ("Monthly_Inhand_Salary", "double"), ("Num_Bank_Accounts", "int"),
    ("Num_Credit_Card", "int"), ("Interest_Rate", "int"), ("Num_of_Loan", "string"), ("Type_of_Loan", "string"),
    ("Delay_from_due_date", "int"), ("Num_of_Delayed_Payment", "string"), ("Changed_Credit_Limit", "string"),
    ("Num_Credit_Inquiries", "double"), ("Credit_Mix", "string"), ("Outstanding_Debt", "string"),
    ("Credit_Utilization_Ratio", "double"), ("Credit_History_Age", "string"), ("Payment_of_Min_Amount", "string"),
    ("Total_EMI_per_month", "double"), ("Amount_invested_monthly", "string"), ("Payment_Behaviour", "string"),
    ("Monthly_Balance", "string"), ("Credit_Score", "string"),
)
_KINDS = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType()}
CREDIT_SCHEMA = T.StructType([T.StructField(name, _KINDS[kind]) for name, kind in CREDIT_COLUMNS])
