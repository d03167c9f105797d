"""Queries for cleaning, windows, labels, profiles, charts, splits, scores and preparation."""

from __future__ import annotations

from dataclasses import replace

from checks.catalog import *  # noqa: F403
from checks.catalog import S, board, dom, panel, predicted, raw_numbers, register, rounded, rounded_big, rule
from checks import catalog as cat
from checks import sql as q
from panelkit.operators import dictionary, quantiles
from panelkit.plans.search import format_params, param_grid

W = q.with_

# --- cleaning ---------------------------------------------------------------


@register("a2_seeded_sample", W(**q.DOMAIN) + f"SELECT row_id, customer_id, age, score FROM dom ORDER BY {q.MD5}, row_id LIMIT 1000")
def a2(spark, sf):
    return sampling.sample_rows(dom(spark, sf), "row_id", 1000).select("row_id", "customer_id", "age", "score")


@register(
    "b1_placeholders",
    W(**q.PANEL) + "SELECT row_id, " + ", ".join(f"{q.blank(c)} AS {c}" for c in ("occupation", "changed_limit", "credit_mix", "payment_behaviour", "age")) + " FROM panel",
)
def b1(spark, sf):
    return clean.placeholders_to_null(panel(spark, sf), S).select(
        "row_id", "occupation", "changed_limit", "credit_mix", "payment_behaviour", "age"
    )


@register(
    "b2_numeric_text",
    W(**q.PANEL) + "SELECT row_id, " + ", ".join(f"{q.number(c)} AS {c}" for c in S.numeric_text) + " FROM panel",
)
def b2(spark, sf):
    return clean.coerce_numeric_text(panel(spark, sf), S).select("row_id", *S.numeric_text)


@register("b3_duration_months", W(**q.PANEL) + f"SELECT row_id, {q.MONTHS} AS history_months FROM panel")
def b3(spark, sf):
    return clean.parse_duration(panel(spark, sf), S).select("row_id", "history_months")


@register("b4_drop_identifiers", W(**q.PANEL) + "SELECT * EXCLUDE (name) FROM panel")
def b4(spark, sf):
    return clean.drop_identifiers(panel(spark, sf), S, keep_keys=True)


@register(
    "b5_domain_bounds",
    W(**q.NONE) + "SELECT row_id, " + ", ".join(f"{q.bounded(c, c)} AS {c}" for c in S.bounds) + " FROM none_",
)
def b5(spark, sf):
    return clean.apply_bounds(raw_numbers(spark, sf), S).select("row_id", *S.bounds)


@register(
    "b6_lower_bounds",
    W(**q.NONE) + "SELECT row_id, " + ", ".join(f"{q.bounded(c, c)} AS {c}" for c in S.lower_only) + " FROM none_",
)
def b6(spark, sf):
    return clean.apply_lower_bounds(raw_numbers(spark, sf), S).select("row_id", *S.lower_only)


ROUNDED = ", ".join(f"{q.r(c)} AS {c}" for c in ("monthly_salary", "utilization", "emi"))


@register(
    "b7_percentile_trim",
    W(**q.TRIMMED) + f"SELECT row_id, age, annual_income, interest_rate, outstanding_debt, balance, history_months, {ROUNDED} FROM trimmed",
)
def b7(spark, sf):
    out = clean.trim_percentiles(dom(spark, sf), S)
    return rounded(
        out.select("row_id", "age", "annual_income", "interest_rate", "outstanding_debt", "balance", "history_months", "monthly_salary", "utilization", "emi")
    )


@register("b8_clean_data", W(**q.DOMAIN) + f"SELECT * REPLACE ({ROUNDED}) FROM dom")
def b8(spark, sf):
    return rounded(dom(spark, sf), only=["monthly_salary", "utilization", "emi"])


for _id, _r in zip(("b9", "b10", "b11", "b12"), S.ratios):

    @register(
        f"{_id}_{_r.name}",
        W(**q.DOMAIN) + f"SELECT row_id, {q.r(f'({_r.numerator} / ({_r.denominator} + 1))')} AS {_r.name} FROM dom",
    )
    def ratio(spark, sf, name=_r.name):
        return rounded(features.add_ratios(dom(spark, sf), S).select("row_id", name))


FEATURES = [(c, "numeric") for c in q.NUMBERS] + [(c, "categorical") for c in q.TEXTS if c != "score"]


@register(
    "b13_split_features",
    W(**q.DOMAIN) + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", '{k}' AS kind, count({c}) AS filled FROM dom" for c, k in FEATURES),
)
def b13(spark, sf):
    return features.feature_table(dom(spark, sf), S)


@register("b14_drop_missing", W(**q.DOMAIN) + "SELECT row_id, age, balance FROM dom WHERE age IS NOT NULL AND balance IS NOT NULL")
def b14(spark, sf):
    return features.drop_missing(dom(spark, sf), ["age", "balance"]).select("row_id", "age", "balance")


@register("b15_drop_columns", W(**q.DOMAIN) + f"SELECT * EXCLUDE (customer_id, score) REPLACE ({ROUNDED}) FROM dom")
def b15(spark, sf):
    return rounded(dom(spark, sf).drop(S.entity, S.label), only=["monthly_salary", "utilization", "emi"])


PREPARED = (
    "SELECT * EXCLUDE (customer_id, loan_types) REPLACE (" + ROUNDED + "), " + q.label_flags() + ", "
    + ", ".join(f"{q.r(f'({x.numerator} / ({x.denominator} + 1))')} AS {x.name}" for x in S.ratios) + " FROM fill"
)


@register("b16_prepare", W(**q.FILLED) + PREPARED)
def b16(spark, sf):
    out = features.prepare(panel(spark, sf), S)
    return rounded(out, only=["monthly_salary", "utilization", "emi", *[x.name for x in S.ratios]])


# --- windows and labels -----------------------------------------------------
FILL_COLUMNS = [*q.NUMBERS, *q.TEXTS]
FEW_ROWS = 8  # of an entity, from which it is cut into stretches: most entities here are then 'hot'
STRETCH = 250  # rows of a stretch, which is a task and a file: with FEW_ROWS of them most tasks would be their start


def _fill_sql(forward: bool) -> str:
    cells = [q.filled(c, forward) for c in FILL_COLUMNS]
    cells = [q.r(f"({x})") if c in ("monthly_salary", "utilization", "emi") else x for c, x in zip(FILL_COLUMNS, cells)]
    return W(**q.DOMAIN) + "SELECT row_id, " + ", ".join(f"{x} AS {c}" for x, c in zip(cells, FILL_COLUMNS)) + " FROM dom"


@register("c1_forward_fill", _fill_sql(True))
def c1(spark, sf):
    df = dom(spark, sf).select("row_id", "customer_id", "as_of", *FILL_COLUMNS)
    return rounded(impute.forward_fill(df, S, FILL_COLUMNS).select("row_id", *FILL_COLUMNS), only=["monthly_salary", "utilization", "emi"])


@register("c2_forward_backward_fill", _fill_sql(False))
def c2(spark, sf):
    df = dom(spark, sf).select("row_id", "customer_id", "as_of", *FILL_COLUMNS)
    return rounded(impute.fill_both(df, S, FILL_COLUMNS).select("row_id", *FILL_COLUMNS), only=["monthly_salary", "utilization", "emi"])


@register("c3_entity_fill", W(**q.FILLED) + f"SELECT * REPLACE ({ROUNDED}) FROM fill")
def c3(spark, sf):
    return rounded(impute.group_impute(dom(spark, sf), S), only=["monthly_salary", "utilization", "emi"])


@register("c1_forward_fill_in_stretches", _fill_sql(True))
def c1_stretches(spark, sf):
    df = dom(spark, sf).select("row_id", "customer_id", "as_of", *FILL_COLUMNS)
    filled = impute.forward_fill(df, S, FILL_COLUMNS, FEW_ROWS, STRETCH).select("row_id", *FILL_COLUMNS)
    return rounded(filled, only=["monthly_salary", "utilization", "emi"])


@register("c3_entity_fill_in_stretches", W(**q.FILLED) + f"SELECT * REPLACE ({ROUNDED}) FROM fill")
def c3_stretches(spark, sf):
    return rounded(impute.group_impute(dom(spark, sf), S, FEW_ROWS, STRETCH), only=["monthly_salary", "utilization", "emi"])


def _one_entity_sql() -> str:
    ordered = "OVER (ORDER BY row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    cells = {c: f"last_value({c} IGNORE NULLS) {ordered}" for c in FILL_COLUMNS}
    cells |= {c: q.r(f"({cells[c]})") for c in ("monthly_salary", "utilization", "emi")}
    return W(**q.DOMAIN) + "SELECT row_id, " + ", ".join(f"{x} AS {c}" for c, x in cells.items()) + " FROM dom"


@register("c1_forward_fill_one_entity", _one_entity_sql())
def c1_one_entity(spark, sf):
    """All rows as one entity, whose first order key is one value: stretches go by the rest of the order."""
    df = dom(spark, sf).select("row_id", *FILL_COLUMNS).withColumns({"customer_id": F.lit("everyone"), "era": F.lit(1)})
    filled = impute.forward_fill(df, replace(S, order=("era", "row_id")), FILL_COLUMNS, hot_rows=500)
    return rounded(filled.select("row_id", *FILL_COLUMNS), only=["monthly_salary", "utilization", "emi"])


RANKED = "SELECT CAST(row_number() OVER (ORDER BY macro_f1 DESC, scaler, encoder, params) AS INT) AS rank, * FROM board"


@register("c4_leaderboard_rank", W(**q.board_tables(SPLIT_RULES)) + RANKED)
def c4(spark, sf):
    return reshape.rank_board(board(spark, sf, SPLIT_RULES), ties=["scaler", "encoder", "params"])


@register(
    "d1_label_tokens",
    W(**q.PANEL) + f"SELECT row_id, unnest({q.TOKENIZED}) AS label FROM panel WHERE loan_types IS NOT NULL",
)
def d1(spark, sf):
    tokens = labels.tokenize_labels(panel(spark, sf), S)
    return tokens.select("row_id", F.explode("labels").alias("label"))


@register("d2_multilabel_flags", W(**q.PANEL) + f"SELECT row_id, {q.label_flags()} FROM panel")
def d2(spark, sf):
    out, found = labels.encode_multilabel(panel(spark, sf), S)
    return out.select("row_id", *["Loan_" + v.replace(" ", "_") for v in found])


@register(
    "d3_label_dictionary",
    W(**q.PANEL) + "SELECT DISTINCT label, concat('Loan_', replace(label, ' ', '_')) AS \"column\" FROM (SELECT unnest("
    + q.TOKENIZED + ") AS label FROM panel WHERE loan_types IS NOT NULL) AS t",
)
def d3(spark, sf):
    return labels.label_dictionary(panel(spark, sf), S)


@register("d2_label_vectors", W(**q.PANEL) + f"SELECT DISTINCT row_id, unnest({q.TOKENIZED}) AS label FROM panel WHERE loan_types IS NOT NULL")
def d2_vectors(spark, sf):
    vectors, vocabulary = labels.label_vectors(panel(spark, sf).select("row_id", S.multilabel), S)
    return labels.vector_labels(vectors, "label_vector", vocabulary)


@register("d2_many_labels", "SELECT DISTINCT l_orderkey, CAST(l_partkey AS VARCHAR) AS label FROM lineitem WHERE l_partkey IS NOT NULL")
def d2_many(spark, sf):
    """More labels than there may be columns: the parts of each order, listed in one cell."""
    parts = spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_orderkey").agg(F.collect_list(F.col("l_partkey").cast("string")).alias("parts"))
    cells = parts.select("l_orderkey", F.array_join("parts", ", ").alias(S.multilabel))
    vectors, vocabulary = labels.label_vectors(cells, S)
    return labels.vector_labels(vectors, "label_vector", vocabulary)


# --- profile ----------------------------------------------------------------
@register(
    "e1_target_distribution",
    W(**q.PANEL) + f"SELECT score AS class, count(*) AS count, {q.r('(count(*) * 100E0 / sum(count(*)) OVER ())')} AS ratio_pct FROM panel GROUP BY score",
)
def e1(spark, sf):
    return rounded(profile.target_distribution(panel(spark, sf), S.label))


PANEL_COLUMNS = [
    "row_id", "customer_id", "as_of", "month", "name", "age", "occupation", "annual_income", "monthly_salary",
    "interest_rate", "num_loans", "num_delayed", "days_past_due", "changed_limit", "outstanding_debt", "utilization",
    "emi", "invested", "balance", "credit_mix", "payment_behaviour", "history_age", "loan_types", "score",
]


@register(
    "e2_missing_report",
    W(**q.PANEL) + "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, {q.r(f'((count(*) - count({c})) * 100E0 / count(*))')} AS missing_ratio_pct FROM panel"
        for c in PANEL_COLUMNS
    ) + ") AS t WHERE missing_count > 0",
)
def e2(spark, sf):
    return rounded(profile.missing_report(panel(spark, sf)))


PANEL_TEXT = [c for c in PANEL_COLUMNS if c not in ("row_id", "as_of", "monthly_salary", "interest_rate", "days_past_due", "utilization", "emi")]


@register(
    "e3_dirty_values",
    W(**q.PANEL) + "SELECT t AS dirty_value, c AS \"column\", count(*) AS count, "
    + q.r("(count(*) * 100E0 / (SELECT count(*) FROM panel))") + " AS ratio_pct FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS c, {c} AS t FROM panel" for c in PANEL_TEXT)
    + f") AS cells WHERE t IN ({q.TOKENS}) GROUP BY t, c",
)
def e3(spark, sf):
    return rounded(profile.dirty_value_scan(panel(spark, sf), S.placeholders))


def _describe_sql(columns, table):
    stats = (
        ("mean", "avg({c})"), ("std", "stddev_samp({c})"), ("min", "CAST(min({c}) AS DOUBLE)"), ("q25", "quantile_cont({c}, 0.25)"),
        ("q50", "quantile_cont({c}, 0.5)"), ("q75", "quantile_cont({c}, 0.75)"), ("max", "CAST(max({c}) AS DOUBLE)"),
    )
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count({c}) AS count, " + ", ".join(f"{q.big(e.format(c=f'CAST({c} AS DOUBLE)'))} AS {n}" for n, e in stats) + f" FROM {table}"
        for c in columns
    )


@register(
    "e4_describe_raw",
    W(**q.PANEL, num="SELECT " + ", ".join(f"{q.number(c)} AS {c}" for c in S.numeric_text) + " FROM panel") + _describe_sql(S.numeric_text, "num"),
)
def e4(spark, sf):
    return rounded_big(profile.numeric_describe_raw(panel(spark, sf), S))


@register("e5_describe_clean", W(**q.DOMAIN) + _describe_sql(S.profile_numeric, "dom"))
def e5(spark, sf):
    return rounded_big(profile.numeric_describe_after_cleaning(panel(spark, sf), S))


@register(
    "e6_category_top",
    W(**q.PANEL) + f"SELECT occupation AS value, count(*) AS count, {q.r('(count(*) * 100E0 / (SELECT count(*) FROM panel))')} AS ratio_pct"
    " FROM panel GROUP BY occupation ORDER BY count DESC, value NULLS LAST LIMIT 4",
)
def e6(spark, sf):
    return rounded(profile.categorical_distribution(panel(spark, sf), "occupation", 4))


@register(
    "e7_category_stack",
    W(**q.PANEL) + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count, {q.r('(count(*) * 100E0 / (SELECT count(*) FROM panel))')} AS ratio_pct FROM panel GROUP BY {c}"
        for c in (*S.profile_categorical, "history_age")
    ),
)
def e7(spark, sf):
    return rounded(profile.categorical_distributions(panel(spark, sf), [*S.profile_categorical, "history_age"]))


def _corr_sql(extra: str = "") -> str:
    half = [(a, b) for i, a in enumerate(q.NUMBERS) for b in q.NUMBERS[i:]]
    one = "SELECT " + ", ".join(f"corr({a}, {b}) AS \"{a}|{b}\"" for a, b in half) + " FROM dom"
    long = " UNION ALL ".join(
        f"SELECT '{a}' AS column_a, '{b}' AS column_b, {q.r(chr(34) + (f'{a}|{b}' if (a, b) in half else f'{b}|{a}') + chr(34))} AS correlation FROM one"
        for a in q.NUMBERS for b in q.NUMBERS
    )
    return W(**q.DOMAIN, one=one, long=long) + f"SELECT *{extra} FROM long"


@register("e8_pearson", _corr_sql())
def e8(spark, sf):
    return rounded(profile.correlation_matrix(panel(spark, sf), S))


RANK_COLUMNS = list(q.NUMBERS)


def _pairs(columns):
    return [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]


def _spearman_sql(a, b):
    average = "(rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2E0)"
    return (
        f"SELECT corr(ra, rb) FROM (SELECT {average.format(c=a)} AS ra, {average.format(c=b)} AS rb FROM dom WHERE {a} IS NOT NULL AND {b} IS NOT NULL) AS t"
    )


def _mirror_sql(columns, value):
    rows = [f"SELECT '{c}' AS column_a, '{c}' AS column_b, 1E0 AS correlation" for c in columns]
    for a, b in _pairs(columns):
        for x, y in ((a, b), (b, a)):
            rows.append(f"SELECT '{x}' AS column_a, '{y}' AS column_b, {q.r('(' + value(a, b) + ')')} AS correlation")
    return " UNION ALL ".join(rows)


@register("e9_spearman", W(**q.DOMAIN) + _mirror_sql(RANK_COLUMNS, _spearman_sql))
def e9(spark, sf):
    return rounded(profile.correlation_matrix(panel(spark, sf), S, "spearman", RANK_COLUMNS))


KENDALL_COLUMNS = ["interest_rate", "num_delayed", "num_loans"]


def _kendall_sql(a, b):
    cells = f"(SELECT {a} AS x, {b} AS y, count(*) * 1E0 AS n FROM dom WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2)"
    net = f"SELECT sum(p.n * o.n * sign(p.x - o.x) * sign(p.y - o.y)) / 2 AS net, sum(p.n * o.n) AS sq FROM {cells} AS p, {cells} AS o"
    every = f"(SELECT sum(n) * (sum(n) - 1) / 2 FROM {cells} AS e)"

    def ties(k):
        return f"(SELECT sum(t * (t - 1)) / 2 FROM (SELECT sum(n) AS t FROM {cells} AS c GROUP BY {k}) AS g)"

    return f"SELECT net / sqrt(({every} - {ties('x')}) * ({every} - {ties('y')})) FROM ({net}) AS k"


@register("e9_kendall", W(**q.DOMAIN) + _mirror_sql(KENDALL_COLUMNS, _kendall_sql))
def e9k(spark, sf):
    return rounded(profile.correlation_matrix(panel(spark, sf), S, "kendall", KENDALL_COLUMNS))


RAW_SIDE = "SELECT " + ", ".join(
    f"{q.number(c) if c in S.numeric_text else f'CAST({c} AS DOUBLE)'} AS {c}" for c in S.profile_numeric
) + " FROM panel"


@register(
    "e10_outlier_summary",
    W(**q.DOMAIN, num=RAW_SIDE) + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {q.big('raw_min')} AS raw_min, {q.big('raw_median')} AS raw_median, {q.big('raw_max')} AS raw_max,"
        f" {q.big('clean_min')} AS clean_min, {q.big('clean_median')} AS clean_median, {q.big('clean_max')} AS clean_max,"
        f" {q.r('((raw_n - clean_n) * 100E0 / n)', 4)} AS dropped_pct FROM"
        f" (SELECT CAST(min({c}) AS DOUBLE) AS raw_min, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS raw_median, CAST(max({c}) AS DOUBLE) AS raw_max, count({c}) AS raw_n, count(*) AS n FROM num) AS a,"
        f" (SELECT CAST(min({c}) AS DOUBLE) AS clean_min, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS clean_median, CAST(max({c}) AS DOUBLE) AS clean_max, count({c}) AS clean_n FROM dom) AS b"
        for c in S.profile_numeric
    ),
)
def e10(spark, sf):
    return rounded_big(profile.outlier_summary(panel(spark, sf), S))


# --- chart tables -----------------------------------------------------------
@register(
    "f1_target_bars",
    W(**q.PANEL, c="SELECT score AS class, count(*) AS count FROM panel GROUP BY score",
      d="SELECT class, count, count * 100E0 / (SELECT sum(count) FROM c) AS ratio_pct FROM c")
    + f"SELECT class, count, {q.r('ratio_pct')} AS ratio_pct, concat(CAST(count AS VARCHAR), ' (', printf('%.1f', ratio_pct), '%)') AS text FROM d",
)
def f1(spark, sf):
    return rounded(charts.target_bars(panel(spark, sf), S.label))


HIST_COLUMNS = list(S.profile_numeric)


@register(
    "f2_histogram",
    W(**q.DOMAIN) + "SELECT \"column\", bin, " + q.r("(lo + bin * w)") + " AS bin_start, count(*) AS count FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", lo, w, CAST(least(floor((x - lo) / w), 49) AS INT) AS bin FROM (SELECT {c} AS x, e.lo, (e.hi - e.lo) / 50 AS w"
        f" FROM dom, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM dom) AS e WHERE {c} IS NOT NULL) AS t"
        for c in HIST_COLUMNS
    ) + ") AS u GROUP BY \"column\", bin, lo, w",
)
def f2(spark, sf):
    return rounded(charts.numeric_histograms(panel(spark, sf), S, HIST_COLUMNS))


BOX_COLUMNS = list(S.profile_numeric)


def _box_sql(c, table, by="", where=""):
    by_ = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    on = f"JOIN qs USING ({by})" if by else ", qs"
    fence = f"{c} BETWEEN q1 - 1.5E0 * (q3 - q1) AND q3 + 1.5E0 * (q3 - q1)"
    return (
        f"SELECT {by_}'{c}' AS \"column\", {q.r('max(q1)')} AS q1, {q.r('max(med)')} AS median, {q.r('max(q3)')} AS q3,"
        f" {q.r(f'min(CASE WHEN {fence} THEN CAST({c} AS DOUBLE) END)')} AS whisker_low, {q.r(f'max(CASE WHEN {fence} THEN CAST({c} AS DOUBLE) END)')} AS whisker_high,"
        f" count(CASE WHEN NOT ({fence}) THEN 1 END) AS outliers FROM {table} {on} {group}"
    ), (
        f"SELECT {by_}CAST(quantile_cont({c}, 0.25) AS DOUBLE) AS q1, CAST(quantile_cont({c}, 0.5) AS DOUBLE) AS med, CAST(quantile_cont({c}, 0.75) AS DOUBLE) AS q3 FROM {table} {group}"
    )


def _boxes(table, by="", extra="", columns=BOX_COLUMNS):
    parts = []
    for c in columns:
        body, qs = _box_sql(c, table, by)
        parts.append(f"SELECT *{extra} FROM (WITH qs AS ({qs}) {body}) AS t")
    return " UNION ALL ".join(parts)


@register(
    "f3_box_before_after",
    W(**q.DOMAIN, num=RAW_SIDE) + _boxes("num", extra=", 'before' AS stage") + " UNION ALL " + _boxes("dom", extra=", 'after' AS stage"),
)
def f3(spark, sf):
    return rounded(charts.box_before_after(panel(spark, sf), S, BOX_COLUMNS))


@register("f4_correlation_heatmap", _corr_sql(f", {q.r('correlation', 2)} AS annotation"))
def f4(spark, sf):
    out = rounded(charts.correlation_heatmap(panel(spark, sf), S))
    return out.withColumn("annotation", F.when(F.abs("correlation") < 0.005, F.lit(0.0)).otherwise(F.round("correlation", 2)))


@register(
    "f5_category_bars",
    W(**q.PANEL) + "SELECT *, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY count DESC, value) AS INT) AS position FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS count FROM panel WHERE {c} IS NOT NULL GROUP BY {c}" for c in S.profile_categorical)
    + ") AS t",
)
def f5(spark, sf):
    return charts.category_bars(panel(spark, sf), S.profile_categorical)


@register(
    "f5_many_categories",
    "SELECT *, CAST(row_number() OVER (PARTITION BY \"column\" ORDER BY count DESC, value) AS INT) AS position FROM ("
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM lineitem WHERE {c} IS NOT NULL GROUP BY {c}" for c in ("l_orderkey", "l_partkey"))
    + ") AS t",
)
def f5_many(spark, sf):
    """Bars of columns whose categories grow with the table."""
    return charts.category_bars(spark.read.parquet(f"{sf}/lineitem.parquet"), ["l_orderkey", "l_partkey"])


PLACE = "CAST(CASE score WHEN 'Poor' THEN 0 WHEN 'Standard' THEN 1 ELSE 2 END AS BIGINT)"


@register("f6_box_by_target", W(**q.DOMAIN) + _boxes("dom", "score", f", {PLACE} AS position", S.key_features))
def f6(spark, sf):
    return rounded(charts.box_by_target(panel(spark, sf), S, list(S.key_features)))


def _position_sql(column, order):
    return "CAST(CASE " + column + "".join(f" WHEN '{o}' THEN {i}" for i, o in enumerate(order)) + " END AS BIGINT)"


@register(
    "f7_outlier_bars",
    W(**q.board_tables(MODE_RULES, modes=True)) + f"SELECT outlier_mode, model, macro_f1, {_position_sql('outlier_mode', ('none', 'domain', 'domain_percentile'))} AS position FROM board",
)
def f7(spark, sf):
    return charts.outlier_bars(board(spark, sf, MODE_RULES, modes=True))


STRATEGY_PLACE = _position_sql("strategy", ("none", "class_weight", "smote"))


@register(
    "f8_imbalance_bars",
    W(**q.board_tables(STRATEGY_RULES)) + " UNION ALL ".join(
        f"SELECT strategy, model, '{m}' AS metric, {m} AS value, {STRATEGY_PLACE} AS position FROM board" for m in ("macro_f1", "macro_recall")
    ),
)
def f8(spark, sf):
    return charts.imbalance_bars(board(spark, sf, STRATEGY_RULES))


PIVOT_SQL = W(**q.board_tables(SPLIT_RULES)) + "SELECT scaler, " + ", ".join(
    f"max(CASE WHEN encoder = '{e}' THEN macro_f1 END) AS \"{e}\"" for e in ("onehot", "ordinal", "target")
) + " FROM board GROUP BY scaler"


@register("f9_scaler_encoder_pivot", PIVOT_SQL)
def f9(spark, sf):
    return charts.scaler_encoder_pivot(board(spark, sf, SPLIT_RULES), ["onehot", "ordinal", "target"])


@register(
    "f10_model_bars",
    W(**q.board_tables(MODEL_RULES, 5)) + f"SELECT model, macro_f1, macro_f1_std, {q.r('(macro_f1 - macro_f1_std)')} AS low,"
    f" {q.r('(macro_f1 + macro_f1_std)')} AS high, macro_f1 >= 0.75E0 AS meets_target FROM board",
)
def f10(spark, sf):
    return rounded(charts.model_bars(board(spark, sf, MODEL_RULES, 5)))


PREDICTED = {**q.DOMAIN, "pred": f"SELECT *, {q.rule()} AS predicted FROM dom"}
COUNTS = {**PREDICTED, "cnt": "SELECT score AS actual, predicted, count(*) AS n FROM pred GROUP BY 1, 2"}
CLASSES = {**COUNTS, "cls": q.class_scores("cnt")}


@register(
    "f11_confusion_matrix",
    W(**COUNTS, names="SELECT actual AS c FROM cnt UNION SELECT predicted FROM cnt")
    + "SELECT a.c AS actual, b.c AS predicted, coalesce(n, 0) AS count FROM names AS a CROSS JOIN names AS b LEFT JOIN cnt ON cnt.actual = a.c AND cnt.predicted = b.c",
)
def f11(spark, sf):
    return metrics.confusion_matrix(predicted(spark, sf), "score", "predicted")


@register(
    "f12_per_class_bars",
    W(**CLASSES) + f"SELECT class, 'precision' AS metric, {q.r('precision_')} AS value, CAST(NULL AS BOOLEAN) AS meets_target FROM cls"
    f" UNION ALL SELECT class, 'recall', {q.r('recall')}, recall >= 0.70E0 FROM cls UNION ALL SELECT class, 'f1_score', {q.r('f1_score')}, NULL FROM cls",
)
def f12(spark, sf):
    return rounded(charts.per_class_bars(predicted(spark, sf), "score", "predicted"))


@register(
    "f14_sweep_bars",
    W(**q.board_tables(SPLIT_RULES), ranked=RANKED)
    + "SELECT rank, concat('#', CAST(rank AS VARCHAR), ' ', model, ' | ', scaler, '+', encoder, chr(10), params) AS label, macro_f1, macro_f1_std FROM ranked WHERE rank <= 5",
)
def f14(spark, sf):
    ranked = reshape.rank_board(board(spark, sf, SPLIT_RULES), ties=["scaler", "encoder", "params"])
    return charts.sweep_bars(reshape.top_n(ranked, "macro_f1", 5, "rank"))


# --- preparation ------------------------------------------------------------
PREP_NUMBERS = list(q.NUMBERS)
PREP_TEXTS = ["occupation", "credit_mix", "payment_behaviour", "month"]
MEDIAN = {
    **q.DOMAIN,
    "med": "SELECT " + ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in PREP_NUMBERS) + " FROM dom",
    "imp": "SELECT row_id, " + ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in PREP_NUMBERS) + " FROM dom, med",
}


def _stats(spark, sf, label=None, numeric=PREP_NUMBERS, categorical=()):
    df = dom(spark, sf)
    if label:
        folded = sampling.stratified_folds(df, "row_id", label, prep.INNER_FOLDS)
        df = folded.withColumn("inner_fold", F.col("fold"))
    return df, prep.fit_stats(df, numeric, categorical, label)[prep.WHOLE]


@register("g1_median_impute", W(**MEDIAN) + "SELECT row_id, " + ", ".join(f"{q.r(c)} AS {c}" for c in PREP_NUMBERS) + " FROM imp")
def g1(spark, sf):
    df, stats = _stats(spark, sf)
    filled = stats.prep().numeric_expressions(scaled=False)
    return rounded(df.select("row_id", *[F.expr(e).alias(c) for c, e in filled.items()]))


@register(
    "g1_quartiles_by_range",
    W(**q.DOMAIN)
    + " UNION ALL ".join(f"SELECT '{c}' AS \"column\", " + ", ".join(f"{q.r(f'quantile_cont({c}, {p})')} AS {n}" for n, p in (("q1", 0.25), ("median", 0.5), ("q3", 0.75))) + " FROM dom" for c in q.NUMBERS),
)
def g1_ranges(spark, sf):
    """The search by value ranges that large tables need, on every numeric column."""
    found = quantiles.exact_quantiles(dom(spark, sf), q.NUMBERS, [0.25, 0.5, 0.75], direct_rows=0, range_rows=500, sample_rows=2_000).values()
    rows = [(c, *map(float, found[(), c])) for c in q.NUMBERS]
    return rounded(spark.createDataFrame(rows, "column string, q1 double, median double, q3 double"))


MODES = {
    **q.DOMAIN,
    **{
        f"mode_{c}": f"SELECT {c} AS v FROM dom WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1" for c in PREP_TEXTS
    },
    "cats": "SELECT row_id, score, " + ", ".join(f"coalesce({c}, (SELECT v FROM mode_{c})) AS {c}" for c in PREP_TEXTS) + " FROM dom",
}


@register("g2_mode_impute", W(**MODES) + f"SELECT row_id, {', '.join(PREP_TEXTS)} FROM cats")
def g2(spark, sf):
    df, stats = _stats(spark, sf, numeric=[], categorical=PREP_TEXTS)
    fitted = stats.prep()
    return df.select("row_id", *[F.expr(fitted.imputed_category(c)).alias(c) for c in PREP_TEXTS])


SCALED = {
    "standard": "({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER ()",
    "minmax": "({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ())",
    "robust": "({c} - quantile_cont({c}, 0.5) OVER ()) / (quantile_cont({c}, 0.75) OVER () - quantile_cont({c}, 0.25) OVER ())",
}
for _id, _name in (("g3", "standard"), ("g4", "minmax"), ("g5", "robust")):

    @register(
        f"{_id}_{_name}_scale",
        W(**MEDIAN, sc="SELECT row_id, " + ", ".join(f"{SCALED[_name].format(c=c)} AS {c}" for c in PREP_NUMBERS) + " FROM imp")
        + "SELECT row_id, " + ", ".join(f"{q.r(c)} AS {c}" for c in PREP_NUMBERS) + " FROM sc",
    )
    def scale(spark, sf, name=_name):
        df, stats = _stats(spark, sf)
        return rounded(stats.prep(scaler=name).transform(df, ["row_id"]))


CATEGORY_VALUES = {
    "occupation": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "credit_mix": ["Bad", "Good", "Standard"],
    "payment_behaviour": ["spent_F", "spent_O", "spent_P"],
    "month": sorted(str(m) for m in range(1, 13)),
}


@register(
    "g6_onehot",
    W(**MODES) + "SELECT row_id, " + ", ".join(
        f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS \"{c}_{v}\"" for c in PREP_TEXTS for v in CATEGORY_VALUES[c]
    ) + " FROM cats",
)
def g6(spark, sf):
    df, stats = _stats(spark, sf, numeric=[], categorical=PREP_TEXTS)
    return stats.prep(encoder="onehot").transform(df, ["row_id"])


@register(
    "g7_ordinal",
    W(**MODES) + "SELECT row_id, " + ", ".join(f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS DOUBLE) AS {c}" for c in PREP_TEXTS) + " FROM cats",
)
def g7(spark, sf):
    df, stats = _stats(spark, sf, numeric=[], categorical=PREP_TEXTS)
    return stats.prep(encoder="ordinal").transform(df, ["row_id"])


def _target_tables(columns):
    classes = ("Good", "Poor", "Standard")
    y = {k: f"CAST(CASE WHEN score = '{k}' THEN 1 ELSE 0 END AS DOUBLE)" for k in classes}
    tables = {**MODES, "fd": f"SELECT *, {q.fold(5)} AS fold FROM cats"}
    tables["folds"] = "SELECT DISTINCT fold FROM fd"
    tables["overall"] = "SELECT folds.fold, " + ", ".join(f"avg({y[k]}) AS all_{k}" for k in classes) + " FROM folds JOIN fd ON fd.fold <> folds.fold GROUP BY folds.fold"
    for c in columns:
        tables[f"own_{c}"] = (
            f"SELECT folds.fold, fd.{c} AS v, count(*) AS n, " + ", ".join(f"avg({y[k]}) AS m_{k}" for k in classes)
            + f" FROM folds JOIN fd ON fd.fold <> folds.fold GROUP BY folds.fold, fd.{c}"
        )
    weight = "({a}.n / ({a}.n + {a}.m_{k} * (1 - {a}.m_{k}) / (o.all_{k} * (1 - o.all_{k}))))"
    cells = []
    for i, c in enumerate(columns):
        for k in classes:
            w = weight.format(a=f"t{i}", k=k)
            cells.append(f"{q.r(f'coalesce({w} * t{i}.m_{k} + (1 - {w}) * o.all_{k}, o.all_{k})')} AS \"{c}_{k}\"")
    joins = " ".join(f"LEFT JOIN own_{c} AS t{i} ON t{i}.fold = fd.fold AND t{i}.v = fd.{c}" for i, c in enumerate(columns))
    return W(**tables) + f"SELECT fd.row_id, {', '.join(cells)} FROM fd JOIN overall AS o ON o.fold = fd.fold {joins}"


@register("g8_target_encode", _target_tables(PREP_TEXTS))
def g8(spark, sf):
    df, stats = _stats(spark, sf, "score", [], PREP_TEXTS)
    return rounded(stats.prep(encoder="target").transform(df, ["row_id"], inner=F.col("inner_fold")))


@register(
    "g9_column_transformer",
    W(**MODES, **{k: v for k, v in MEDIAN.items() if k in ("med", "imp")},
      sc="SELECT row_id, " + ", ".join(f"{SCALED['robust'].format(c=c)} AS {c}" for c in PREP_NUMBERS) + " FROM imp")
    + "SELECT sc.row_id, " + ", ".join(f"{q.r('sc.' + c)} AS {c}" for c in PREP_NUMBERS) + ", "
    + ", ".join(f"CAST(CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS DOUBLE) AS \"{c}_{v}\"" for c in PREP_TEXTS for v in CATEGORY_VALUES[c])
    + " FROM sc JOIN cats ON cats.row_id = sc.row_id",
)
def g9(spark, sf):
    df, stats = _stats(spark, sf, categorical=PREP_TEXTS)
    return rounded(stats.prep("robust", "onehot").transform(df, ["row_id"]), only=PREP_NUMBERS)


# --- balance ----------------------------------------------------------------
@register("h1_unweighted", W(**q.PANEL) + "SELECT row_id, score, 1E0 AS weight FROM panel")
def h1(spark, sf):
    return balance.unweighted(panel(spark, sf).select("row_id", "score"))


@register(
    "h2_balanced_weight",
    W(**q.PANEL, c="SELECT score, count(*) AS n FROM panel GROUP BY score")
    + f"SELECT row_id, panel.score, {q.r('((SELECT sum(n) FROM c) * 1E0 / ((SELECT count(*) FROM c) * c.n))')} AS weight FROM panel JOIN c ON c.score = panel.score",
)
def h2(spark, sf):
    return rounded(balance.balanced_weights(panel(spark, sf).select("row_id", "score"), "score"))


# --- splits and scores ------------------------------------------------------
@register("j1_stratified_folds", W(**q.PANEL) + f"SELECT row_id, score, {q.fold(5)} AS fold FROM panel")
def j1(spark, sf):
    df = panel(spark, sf).select("row_id", "score")
    return sampling.stratified_folds(df, "row_id", "score", 5).drop("inner_fold")


@register(
    "j2_stratified_holdout",
    W(**q.PANEL) + f"SELECT row_id, score, row_number() OVER (PARTITION BY score ORDER BY {q.MD5}, row_id) <= floor(0.2E0 * count(*) OVER (PARTITION BY score) + 0.5E0) AS is_test FROM panel",
)
def j2(spark, sf):
    return sampling.stratified_split(panel(spark, sf).select("row_id", "score"), "row_id", "score")


@register(
    "j3_random_split",
    W(**q.PANEL) + f"SELECT row_id, row_number() OVER (ORDER BY {q.MD5}, row_id) <= floor(0.2E0 * count(*) OVER () + 0.5E0) AS is_test FROM panel",
)
def j3(spark, sf):
    return sampling.random_split(panel(spark, sf).select("row_id"), "row_id")


SCORE_SQL = {
    "j4_accuracy": "SELECT " + q.r("(sum(tp) * 1E0 / sum(support))") + " AS accuracy FROM cls",
    "j5_macro_f1": "SELECT " + q.r("avg(f1_score)") + " AS macro_f1 FROM cls",
    "j7_macro_recall": "SELECT " + q.r("avg(recall)") + " AS macro_recall FROM cls",
}
for _name, _sql in SCORE_SQL.items():

    @register(_name, W(**CLASSES) + _sql)
    def score(spark, sf, column=_name.split("_", 1)[1]):
        counts = metrics.confusion_counts(predicted(spark, sf), "score", "predicted")
        return rounded(metrics.summary_scores(counts).select(column))


@register(
    "j6_classification_report",
    W(**CLASSES)
    + " UNION ALL ".join(f"SELECT class, '{n}' AS metric, {q.r(c)} AS value FROM cls" for n, c in (("precision", "precision_"), ("recall", "recall"), ("f1_score", "f1_score"), ("support", "CAST(support AS DOUBLE)")))
    + f" UNION ALL SELECT 'accuracy', 'accuracy', {q.r('(sum(tp) * 1E0 / sum(support))')} FROM cls"
    + "".join(
        f" UNION ALL SELECT 'macro avg', '{n}', {q.r(f'avg({c})')} FROM cls UNION ALL SELECT 'weighted avg', '{n}', {q.r(f'(sum({c} * support) / sum(support))')} FROM cls"
        for n, c in (("precision", "precision_"), ("recall", "recall"), ("f1_score", "f1_score"))
    )
    + "".join(f" UNION ALL SELECT '{a} avg', 'support', CAST(sum(support) AS DOUBLE) FROM cls" for a in ("macro", "weighted")),
)
def j6(spark, sf):
    return rounded(metrics.classification_report(predicted(spark, sf), "score", "predicted"))


@register("j8_fold_mean_std", W(**q.board_tables(MODEL_RULES, 5)) + "SELECT * FROM board")
def j8(spark, sf):
    return board(spark, sf, MODEL_RULES, 5)


REGRESSED = {**q.DOMAIN, "reg": "SELECT balance AS y, outstanding_debt / 500E0 AS p FROM dom WHERE balance IS NOT NULL AND outstanding_debt IS NOT NULL"}


def regressed(spark, sf):
    return dom(spark, sf).select(F.col("balance").alias("y"), (F.col("outstanding_debt") / 500).alias("p")).na.drop()


@register(
    "j9_r2",
    W(**REGRESSED, m="SELECT avg(y) AS a FROM reg") + f"SELECT {q.r('(1 - sum((y - p) * (y - p)) / sum((y - a) * (y - a)))')} AS r2 FROM reg, m",
)
def j9(spark, sf):
    return rounded(metrics.regression_scores(regressed(spark, sf), "y", "p").select("r2"))


@register("j10_mae", W(**REGRESSED) + f"SELECT {q.r('avg(abs(y - p))')} AS mae FROM reg")
def j10(spark, sf):
    return rounded(metrics.regression_scores(regressed(spark, sf), "y", "p").select("mae"))


CLUSTER = list(S.cluster_features)
POINTS = {
    **q.DOMAIN,
    "pts": f"SELECT row_id, score, {', '.join(CLUSTER)} FROM dom WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in CLUSTER),
    "std": "SELECT row_id, score, " + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS {c}" for c in CLUSTER) + " FROM pts",
    "cen": "SELECT score, count(*) AS n, " + ", ".join(f"avg({c}) AS c_{c}" for c in CLUSTER) + " FROM std GROUP BY score",
}


def points(spark, sf):
    df = features.drop_missing(dom(spark, sf).select("row_id", "score", *CLUSTER), CLUSTER)
    fitted = prep.fit_stats(df, CLUSTER, [], scalers=("standard",))[prep.WHOLE].prep("standard")
    return df, fitted.transform(df, ["row_id", "score"]), fitted


@register(
    "j11_silhouette",
    W(
        **POINTS,
        sums="SELECT score, count(*) AS n, sum(" + " + ".join(f"{c} * {c}" for c in CLUSTER) + ") AS q, "
        + ", ".join(f"sum({c}) AS s_{c}" for c in CLUSTER) + " FROM std GROUP BY score",
        near="SELECT a.row_id, a.score AS own, b.score AS other, b.n, b.n * (" + " + ".join(f"a.{c} * a.{c}" for c in CLUSTER) + ") - 2 * ("
        + " + ".join(f"a.{c} * b.s_{c}" for c in CLUSTER) + ") + b.q AS total FROM std AS a, sums AS b",
        ab="SELECT row_id, max(CASE WHEN own = other THEN total / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN total / n END) AS b FROM near GROUP BY row_id",
    )
    + f"SELECT {q.r('avg(CASE WHEN a IS NULL THEN 0E0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette FROM ab",
)
def j11(spark, sf):
    _, scaled, _ = points(spark, sf)
    return rounded(cluster_scores.silhouette(scaled, "score", CLUSTER))


@register(
    "j11_silhouette_euclidean",
    W(
        **POINTS,
        pick="SELECT * FROM std WHERE score IS NOT NULL ORDER BY md5(concat(row_id, '|42')) LIMIT 20000",
        size="SELECT score, count(*) AS n FROM pick GROUP BY score",
        away="SELECT a.row_id, a.score AS own, b.score AS other, sum(sqrt(" + " + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in CLUSTER) + ")) AS d "
        "FROM pick AS a, pick AS b GROUP BY a.row_id, a.score, b.score",
        ab="SELECT row_id, max(CASE WHEN own = other THEN d / nullif(n - 1, 0) END) AS a, min(CASE WHEN own <> other THEN d / n END) AS b "
        "FROM away JOIN size ON size.score = away.other GROUP BY row_id",
    )
    + f"SELECT {q.r('avg(CASE WHEN a IS NULL THEN 0E0 ELSE (b - a) / greatest(a, b) END)')} AS silhouette FROM ab",
)
def j11_euclidean(spark, sf):
    _, scaled, _ = points(spark, sf)
    return rounded(cluster_scores.euclidean_silhouette(scaled, "score", CLUSTER, "row_id"))


@register(
    "j12_inertia",
    W(**POINTS, dist="SELECT row_id, min(" + " + ".join(f"({c} - c_{c}) * ({c} - c_{c})" for c in CLUSTER) + ") AS d FROM std, cen GROUP BY row_id")
    + f"SELECT {q.r('sum(d)', 4)} AS inertia FROM dist",
)
def j12(spark, sf):
    _, scaled, _ = points(spark, sf)
    centres = cluster_scores.centroids(scaled, "score", CLUSTER)
    return rounded(cluster_scores.inertia(scaled, CLUSTER, [[r[c] for c in CLUSTER] for r in centres.collect()]), 4)


@register("j13_cluster_sizes", W(**POINTS) + "SELECT score AS cluster, n AS size FROM cen")
def j13(spark, sf):
    return cluster_scores.cluster_sizes(points(spark, sf)[1], "score").withColumnRenamed("score", "cluster")


@register("j14_centroids", W(**POINTS) + "SELECT score, " + ", ".join(f"{q.r(f'avg({c})')} AS {c}" for c in CLUSTER) + " FROM pts GROUP BY score")
def j14(spark, sf):
    _, scaled, fitted = points(spark, sf)
    return rounded(cluster_scores.original_units(cluster_scores.centroids(scaled, "score", CLUSTER), fitted, CLUSTER))


# --- search tables ----------------------------------------------------------
GRID = {"poor": [20, 24, 28], "good": [4, 6]}
GRID_RULES = [
    {"config": str(i), "params": format_params(p), "column": "interest_rate", **p} for i, p in enumerate(param_grid(GRID))
]


@register("k1_param_grid", W(**q.board_tables([{k: v for k, v in c.items() if k != "params"} for c in GRID_RULES])) + "SELECT * FROM board")
def k1(spark, sf):
    return board(spark, sf, [{k: v for k, v in c.items() if k != "params"} for c in GRID_RULES])


@register("k2_params_text", W(**q.board_tables(GRID_RULES)) + "SELECT config, params, macro_f1 FROM board")
def k2(spark, sf):
    return board(spark, sf, GRID_RULES).select("config", "params", "macro_f1")


@register("k8_top_k", W(**q.board_tables(SPLIT_RULES)) + "SELECT * FROM board ORDER BY macro_f1 DESC, scaler, encoder LIMIT 5")
def k8(spark, sf):
    return reshape.top_n(board(spark, sf, SPLIT_RULES), "macro_f1", 5, "scaler", "encoder")


# --- reshaping --------------------------------------------------------------
@register("l1_sort_desc", W(**q.DOMAIN) + "SELECT row_id, outstanding_debt FROM dom ORDER BY outstanding_debt DESC, row_id")
def l1(spark, sf):
    return reshape.sort_desc(dom(spark, sf).select("row_id", "outstanding_debt"), "outstanding_debt", "row_id")


@register("l2_top_n", W(**q.DOMAIN) + "SELECT row_id, outstanding_debt FROM dom ORDER BY outstanding_debt DESC, row_id LIMIT 20")
def l2(spark, sf):
    return reshape.top_n(dom(spark, sf).select("row_id", "outstanding_debt"), "outstanding_debt", 20, "row_id")


@register(
    "l3_union_all",
    W(**q.PANEL) + "SELECT 'credit_mix' AS \"column\", credit_mix AS value, count(*) AS count FROM panel GROUP BY credit_mix"
    " UNION ALL SELECT 'month', month, count(*) FROM panel GROUP BY month",
)
def l3(spark, sf):
    df = panel(spark, sf)
    parts = [profile.categorical_distribution(df, c).select(F.lit(c).alias("column"), "value", "count") for c in ("credit_mix", "month")]
    return reshape.union_all(*parts)


@register("l4_distinct", W(**q.PANEL) + "SELECT DISTINCT payment_behaviour FROM panel")
def l4(spark, sf):
    return reshape.distinct_values(panel(spark, sf), "payment_behaviour")


@register(
    "l5_pivot",
    W(**q.PANEL) + "SELECT occupation, " + ", ".join(f"count(CASE WHEN score = '{k}' THEN 1 END) AS \"{k}\"" for k in ("Good", "Poor", "Standard")) + " FROM panel GROUP BY occupation",
)
def l5(spark, sf):
    counts = panel(spark, sf).groupBy("occupation", "score").agg(F.count("*").alias("n"))
    return reshape.pivot(counts, "occupation", "score", "n", ["Good", "Poor", "Standard"]).na.fill(0)


@register(
    "l6_melt",
    W(**q.DOMAIN) + " UNION ALL ".join(f"SELECT row_id, '{c}' AS \"column\", {c} AS value FROM dom" for c in ("age", "num_loans", "num_delayed")),
)
def l6(spark, sf):
    return reshape.melt(dom(spark, sf), ["row_id"], ["age", "num_loans", "num_delayed"])


# --- dictionaries of any size -----------------------------------------------
def _orders_of_lines(spark, sf):
    """A text column whose number of values grows with the table (150,000 at sf0.1), next to a class."""
    return spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber", F.col("l_orderkey").cast("string").alias("order"), F.col("l_returnflag").alias("flag"))


@register(
    "g7_ordinal_any_size",
    "SELECT l_orderkey, l_linenumber, CAST(dense_rank() OVER (ORDER BY CAST(l_orderkey AS VARCHAR)) - 1 AS DOUBLE) AS code FROM lineitem",
)
def g7_any(spark, sf):
    lines = _orders_of_lines(spark, sf)
    return dictionary.fit(lines, "order").ordinal(lines, "code").select("l_orderkey", "l_linenumber", "code")


@register(
    "g8_target_any_size",
    "WITH o AS (SELECT l_returnflag AS flag, count(*) AS n, count(*) / sum(count(*)) OVER () AS base FROM lineitem GROUP BY l_returnflag), "
    "v AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey), "
    "c AS (SELECT v.l_orderkey, o.flag, o.base, v.n, (SELECT count(*) FROM lineitem AS l WHERE l.l_orderkey = v.l_orderkey AND l.l_returnflag = o.flag) / v.n AS own FROM v, o), "
    "m AS (SELECT l_orderkey, flag, base, own, n / (n + own * (1 - own) / (base * (1 - base))) AS w FROM c) "
    f"SELECT l_orderkey, flag, {q.r('w * own + (1 - w) * base')} AS mean FROM m",
)
def g8_any(spark, sf):
    lines = _orders_of_lines(spark, sf)
    held = dictionary.fit(lines, "order", "flag")
    means = held.target(lines.select("l_orderkey", "order").distinct(), "means")
    each = means.select("l_orderkey", F.posexplode("means").alias("at", "mean"))
    return rounded(each.select("l_orderkey", F.get(F.array(*[F.lit(k) for k in held.classes]), F.col("at")).alias("flag"), "mean"))
