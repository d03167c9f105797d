"""Pieces of SQL for the second engine: panel, cleaned panel, filled panel, folds, boards."""

from __future__ import annotations

from panelkit.sources.panel import PANEL_SPEC, PANEL_SQL

S = PANEL_SPEC
TOKENS = "'_', '_______', '!@9#%8'"
ENTITY = "PARTITION BY customer_id ORDER BY as_of, row_id"
BEFORE = f"({ENTITY} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
WHOLE = f"({ENTITY} ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
TEXTS = ["month", "occupation", "credit_mix", "payment_behaviour", "loan_types", "score"]
NATIVE = ["monthly_salary", "interest_rate", "days_past_due", "utilization", "emi"]
NUMBERS = [
    "age", "annual_income", "monthly_salary", "interest_rate", "num_loans", "num_delayed", "days_past_due",
    "changed_limit", "outstanding_debt", "utilization", "emi", "invested", "balance", "history_months",
]
KEYS = ["row_id", "customer_id", "as_of"]
MD5 = "md5(concat(CAST(row_id AS VARCHAR), '|42'))"


def r(x: str, digits: int = 6) -> str:
    """Rounded, without a negative zero."""
    half = "0." + "0" * digits + "5"
    return f"CASE WHEN abs({x}) < {half} THEN 0E0 ELSE round({x}, {digits}) END"


def big(x: str) -> str:
    """Rounded by size, for sums with absurd values in them."""
    return f"CASE WHEN abs({x}) > 1E15 THEN round({x} / 1E20, 2) * 1E20 ELSE {r(x, 4)} END"


def blank(c: str) -> str:
    return f"CASE WHEN {c} IN ({TOKENS}) THEN NULL ELSE {c} END"


def number(c: str) -> str:
    return f"TRY_CAST(replace({c}, '_', '') AS DOUBLE)"


MONTHS = (
    "CASE WHEN history_age IS NULL THEN NULL ELSE CAST(coalesce(TRY_CAST(regexp_extract(history_age, '([0-9]+) Years', 1) AS INT), 0) * 12"
    " + coalesce(TRY_CAST(regexp_extract(history_age, '([0-9]+) Months', 1) AS INT), 0) AS INT) END"
)


def bounded(c: str, x: str) -> str:
    if c in S.bounds:
        lo, hi = S.bounds[c]
        return f"CASE WHEN {x} BETWEEN {lo} AND {hi} THEN CAST({x} AS DOUBLE) END"
    if c in S.lower_only:
        return f"CASE WHEN {x} >= {S.lower_only[c]} THEN CAST({x} AS DOUBLE) END"
    return x


def clean_select(mode: str, source: str = "panel") -> str:
    """The cleaned columns, keys kept, before any percentile trim."""
    parts = list(KEYS)
    for c in TEXTS:
        parts.append(f"{blank(c)} AS {c}")
    for c in NUMBERS:
        x = MONTHS if c == "history_months" else (number(f"({blank(c)})") if c in S.numeric_text else c)
        parts.append(f"{x if mode == 'none' else bounded(c, x)} AS {c}")
    return f"SELECT {', '.join(parts)} FROM {source}"


def trim_select(source: str) -> str:
    lo, hi = S.trim
    limits = ", ".join(f"quantile_cont({c}, {lo}) AS lo_{c}, quantile_cont({c}, {hi}) AS hi_{c}" for c in NUMBERS)
    trimmed = ", ".join(f"CASE WHEN {c} BETWEEN lo_{c} AND hi_{c} THEN {c} END AS {c}" for c in NUMBERS)
    return f"SELECT {', '.join(KEYS + TEXTS)}, {trimmed} FROM {source}, (SELECT {limits} FROM {source}) AS limits"


def filled(c: str, forward_only: bool = False) -> str:
    last = f"last_value({c} IGNORE NULLS) OVER {BEFORE}"
    return last if forward_only else f"coalesce({last}, first_value({c} IGNORE NULLS) OVER {WHOLE})"


LABELS = [
    "Auto Loan", "Credit-Builder Loan", "Debt Consolidation Loan", "Home Equity Loan", "Mortgage Loan",
    "Not Specified", "Payday Loan", "Personal Loan", "Student Loan",
]
TOKENIZED = (
    "list_filter(list_transform(string_split(loan_types, ','), lambda p: replace(trim(p), 'and ', '')), lambda p: p <> '')"
)


def label_flags() -> str:
    return ", ".join(
        f"CAST(coalesce(list_contains({TOKENIZED}, '{v}'), false) AS INT) AS \"Loan_{v.replace(' ', '_')}\"" for v in LABELS
    )


def with_(**tables: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in tables.items()) + " "


PANEL = {"panel": PANEL_SQL}
NONE = {**PANEL, "none_": clean_select("none")}
DOMAIN = {**PANEL, "dom": clean_select("domain")}
TRIMMED = {**DOMAIN, "trimmed": trim_select("dom")}
FILLED = {
    **DOMAIN,
    "fill": f"SELECT {', '.join(KEYS)}, " + ", ".join(f"{filled(c)} AS {c}" for c in TEXTS + NUMBERS) + " FROM dom",
}


def fold(k: int) -> str:
    return f"CAST((row_number() OVER (PARTITION BY score ORDER BY {MD5}, row_id) - 1) % {k} AS INT)"


def rule(column: str = "interest_rate", poor: str = "24", good: str = "6") -> str:
    return f"CASE WHEN {column} >= {poor} THEN 'Poor' WHEN {column} < {good} THEN 'Good' ELSE 'Standard' END"


def class_scores(counts: str, by: str = "") -> str:
    """Per-class scores over a table (by.., actual, predicted, n)."""
    by_ = by + ", " if by else ""
    return (
        f"SELECT {by_}class, CAST(sum(s) AS BIGINT) AS support, CAST(sum(t) AS BIGINT) AS tp,"
        " CASE WHEN sum(p) = 0 THEN 0E0 ELSE sum(t) * 1E0 / sum(p) END AS precision_,"
        " CASE WHEN sum(s) = 0 THEN 0E0 ELSE sum(t) * 1E0 / sum(s) END AS recall,"
        " CASE WHEN sum(s) + sum(p) = 0 THEN 0E0 ELSE 2E0 * sum(t) / (sum(s) + sum(p)) END AS f1_score FROM ("
        f"SELECT {by_}actual AS class, n AS s, 0 AS p, CASE WHEN actual = predicted THEN n ELSE 0 END AS t FROM {counts} UNION ALL "
        f"SELECT {by_}predicted AS class, 0 AS s, n AS p, 0 AS t FROM {counts}) AS sides GROUP BY {by_}class"
    )


def board_tables(configs: list[dict], k: int = 3, modes: bool = False) -> dict[str, str]:
    """Tables ending in ``board``: rule models of ``configs`` scored on ``k`` folds.

    A config names its columns plus ``column``, ``poor`` and ``good``.
    """
    names = [n for n in configs[0] if n not in ("column", "poor", "good")]
    rows = ", ".join(
        "(" + ", ".join([*(f"'{c[n]}'" for n in names), f"'{c['column']}'", str(c["poor"]), str(c["good"])]) + ")"
        for c in configs
    )
    listed = ", ".join(names)
    value = "CASE cfg.col WHEN 'interest_rate' THEN interest_rate WHEN 'num_delayed' THEN num_delayed ELSE days_past_due END"
    if modes:
        base = {**TRIMMED, "none_": clean_select("none")}
        base["source"] = " UNION ALL ".join(
            f"SELECT '{m}' AS mode, row_id, score, CAST(interest_rate AS DOUBLE) AS interest_rate, num_delayed, CAST(days_past_due AS DOUBLE) AS days_past_due FROM {t}"
            for m, t in (("none", "none_"), ("domain", "dom"), ("domain_percentile", "trimmed"))
        )
        on, part = "JOIN cfg ON cfg.outlier_mode = mode", "mode, "
    else:
        base = {**DOMAIN, "source": "SELECT * FROM dom"}
        on, part = "CROSS JOIN cfg", ""
    fold_ = f"CAST((row_number() OVER (PARTITION BY {part}score ORDER BY {MD5}, row_id) - 1) % {k} AS INT)"
    return {
        **base,
        "folded": f"SELECT *, {fold_} AS fold FROM source",
        "cfg": f"SELECT * FROM (VALUES {rows}) AS v({listed}, col, poor, good)",
        "pred": f"SELECT {listed}, fold, score AS actual, CASE WHEN v >= poor THEN 'Poor' WHEN v < good THEN 'Good' ELSE 'Standard' END AS predicted"
        f" FROM (SELECT folded.fold, folded.score, cfg.*, {value} AS v FROM folded {on}) AS x",
        "cnt": f"SELECT {listed}, fold, actual, predicted, count(*) AS n FROM pred GROUP BY ALL",
        "cls": class_scores("cnt", f"{listed}, fold"),
        "fs": f"SELECT {listed}, fold, sum(tp) * 1E0 / sum(support) AS accuracy, avg(f1_score) AS macro_f1, avg(recall) AS macro_recall FROM cls GROUP BY {listed}, fold",
        "board": f"SELECT {listed}, {r('avg(macro_f1)')} AS macro_f1, {r('stddev_pop(macro_f1)')} AS macro_f1_std,"
        f" {r('avg(macro_recall)')} AS macro_recall, {r('avg(accuracy)')} AS accuracy FROM fs GROUP BY {listed}",
    }
