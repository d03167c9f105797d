import random

from panelkit.operators import impute
from panelkit.spec import PanelSpec

SPEC = PanelSpec(entity="e", order=("t", "id"), row_id="id", label="y")


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    out = []
    for entity, members in groups.items():
        members.sort(key=lambda r: (r[2], r[0]))
        for i, r in enumerate(members):
            filled = list(r)
            for c in (3, 4):
                before = [m[c] for m in members[: i + 1] if m[c] is not None]
                after = [m[c] for m in members if m[c] is not None]
                if entity is not None:
                    filled[c] = before[-1] if before else (after[0] if after else None)
            out.append(tuple(filled))
    return sorted(out, key=lambda r: r[0])


def rows(n, hot):
    pick = random.Random(3)
    made = []
    for i in range(n):
        # one entity holds a third of all rows; order keys tie; some rows have no entity
        e = "hot" if pick.random() < hot else pick.choice(["a", "b", "c", None, "lonely" if i == 7 else "d"])
        made.append((i, e, pick.randrange(n // 4), pick.choice([None, None, pick.random()]), pick.choice([None, None, None, "x", "y"])))
    return made


SCHEMA = "id long, e string, t int, v double, s string"


def test_fill_matches_brute_force(spark):
    data = rows(300, 0.33)
    out = impute.group_impute(spark.createDataFrame(data, SCHEMA), SPEC)
    assert sorted(map(tuple, out.collect())) == brute(data)


def test_hot_entity_in_chunks_gives_the_same(spark):
    data = rows(600, 0.4)
    df = spark.createDataFrame(data, SCHEMA)
    assert [h[0] for h in impute.hot_entities(df, SPEC, 150)[0]] == ["hot"]
    for hot_rows in (150, 20):
        out = impute.fill_both(df, SPEC, ["v", "s"], hot_rows)
        assert sorted(map(tuple, out.collect())) == brute(data)


def test_one_entity_with_one_order_key(spark):
    """Every row has the same entity and the same order key: stretches follow the row id and stay even."""
    spec = PanelSpec(entity="e", order=("t",), row_id="id", label="y")
    data = [(i, "all", 1, None if i % 7 else float(i), None if i != 1500 else "x") for i in range(3000)]
    random.Random(5).shuffle(data)
    df = spark.createDataFrame(data, SCHEMA).repartition(6)
    hot, stretches = impute.hot_entities(df, spec, 200)
    assert hot == [("all", 3000)] and stretches == 30
    sizes = sorted(r["count"] for r in impute.stretched(df, spec, stretches).groupBy("__chunk").count().collect())
    assert len(sizes) > 20 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert sorted(map(tuple, impute.fill_both(df, spec, ["v", "s"], 200).collect())) == brute(data)


def test_forward_fill_in_stretches_leaves_the_start_empty(spark):
    data = [(i, e, i % 3, None if i < 40 else 1.0 * i, None) for i in range(120) for e in ("a", "b")]
    df = spark.createDataFrame([(2 * i + (e == "b"), e, t, v, s) for i, e, t, v, s in data], SCHEMA)
    plain = impute.forward_fill(df, SPEC, ["v", "s"])
    assert impute.forward_fill(df, SPEC, ["v", "s"], 10).exceptAll(plain).count() == 0
    assert plain.where("v IS NULL").count() > 0


def test_fill_is_idempotent_and_keeps_values(spark):
    df = spark.createDataFrame(rows(200, 0.3), SCHEMA)
    once = impute.group_impute(df, SPEC)
    assert once.exceptAll(impute.group_impute(once, SPEC)).count() == 0
    joined = df.alias("a").join(once.alias("b"), "id").where("a.v IS NOT NULL AND NOT (a.v <=> b.v)")
    assert joined.count() == 0


def test_plan_has_one_shuffle(spark):
    df = spark.createDataFrame(rows(100, 0.3), SCHEMA)
    plan = impute.group_impute(df, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "SortMergeJoin" not in plan


def test_no_entity_column(spark):
    df = spark.range(3)
    assert impute.group_impute(df, SPEC) is df


def test_stretches_are_more_than_tasks(spark):
    """Hundreds of stretches of a few rows each come from one task and lie in one file; the result is that of the plain fill."""
    spec = PanelSpec(entity="e", order=("t",), row_id="id", label="y")
    data = [(i, "all" if i % 9 else "other", 1, None if i % 40 else float(i), None if i != 700 else "x") for i in range(2000)]
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    dealt = impute.stretched(df, spec, 400)
    assert dealt.select("__chunk").distinct().count() == 400 and len(dealt.inputFiles()) == 1
    assert dealt.groupBy("__chunk").count().agg({"count": "max"}).first()[0] == 5
    assert sorted(map(tuple, impute.fill_both(df, spec, ["v", "s"], 10, 5).collect())) == brute(data)
