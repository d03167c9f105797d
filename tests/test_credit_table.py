"""The public table end to end: ten rows of its CSV, read with its schema, prepared with its specification."""

import csv

import pytest

from panelkit.operators.features import prepare
from panelkit.sources.files import read_panel_csv
from panelkit.spec import CREDIT_COLUMNS, CREDIT_PANEL, CREDIT_SCHEMA

MONTHS = ["January", "February", "March", "April", "May"]


@pytest.fixture(scope="module")
def raw(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("credit") / "train.csv"
    usual = {
        "Name": "A B", "SSN": "821-00-0265", "Occupation": "Scientist", "Annual_Income": "19114.12", "Monthly_Inhand_Salary": "1824.8",
        "Num_Bank_Accounts": "3", "Num_Credit_Card": "4", "Interest_Rate": "3", "Num_of_Loan": "4",
        "Type_of_Loan": "Auto Loan, and Home Equity Loan", "Delay_from_due_date": "3", "Num_of_Delayed_Payment": "7",
        "Changed_Credit_Limit": "11.27", "Num_Credit_Inquiries": "4.0", "Credit_Mix": "Good", "Outstanding_Debt": "809.98",
        "Credit_Utilization_Ratio": "26.8", "Credit_History_Age": "22 Years and 1 Months", "Payment_of_Min_Amount": "No",
        "Total_EMI_per_month": "49.5", "Amount_invested_monthly": "80.4", "Payment_Behaviour": "High_spent", "Monthly_Balance": "312.4",
        "Credit_Score": "Good",
    }
    with path.open("w", newline="") as file:
        out = csv.DictWriter(file, [name for name, _ in CREDIT_COLUMNS])
        out.writeheader()
        for i in range(10):
            # months stand in the file from the last to the first; gaps are filled in the order of time
            row = usual | {"ID": f"0x{i:03x}", "Customer_ID": f"CUS_{i % 2}", "Month": MONTHS[4 - i // 2], "Age": "23_" if i else "-500"}
            if MONTHS[4 - i // 2] in ("March", "May"):
                row["Occupation"] = "_______"
            if MONTHS[4 - i // 2] == "April":
                row["Occupation"] = "Lawyer"
            out.writerow(row)
    return read_panel_csv(spark, str(path), CREDIT_SCHEMA)


def test_read_to_prepare(raw):
    assert len(CREDIT_COLUMNS) == 28 and raw.count() == 10
    done = {r["ID"]: r for r in prepare(raw, CREDIT_PANEL).collect()}
    assert len(done) == 10
    months = {f"0x{i:03x}": 5 - i // 2 for i in range(10)}
    for key, row in done.items():
        assert row["Month_Number"] == months[key]
        assert row["Occupation"] == {1: "Scientist", 2: "Scientist", 3: "Scientist", 4: "Lawyer", 5: "Lawyer"}[months[key]]
        assert row["Credit_History_Age_Months"] == 265 and row["Age"] == 23.0 and "Customer_ID" not in row
        assert row["Debt_to_Income"] == pytest.approx(809.98 / 19115.12)
        assert sum(v for k, v in row.asDict().items() if k.startswith("Loan_")) == 2
