from dataclasses import replace

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Window
from pyspark.sql import functions as F

from yearloom.operators import panel
from yearloom.operators.reconcile import name_lookup, reconcile, unmatched, with_period
from yearloom.specs import FactSpec, Measure, PanelSpec, PeriodSpec

SPEC = PanelSpec(
    entity="place",
    period="year",
    facts=(
        FactSpec(
            "offers",
            (Measure("avg_price", "avg", "price"), Measure("n_offers", "count")),
            in_spine=False,
            gap_fill=True,
        ),
        FactSpec("cases", (Measure("n_cases", "count"),)),
        FactSpec("wealth", (Measure("avg_wealth", "avg", "index"),)),
    ),
)


@pytest.fixture(scope="module")
def facts(spark):
    offers = [
        ("a", 2020, 10.0),
        ("a", 2020, 20.0),
        ("a", 2020, None),
        ("a", 2021, None),  # a group without any value: filled, but keeps its count
        ("a", 1990, 90.0),  # a year with offers only: not in the master table
        ("a", None, 40.0),
        ("b", 2020, None),
        (None, 2020, 999.0),
    ]
    cases = [("a", 2020), ("a", 2020), ("a", 2022), ("a", None), ("c", 2020), (None, 2020)]
    wealth = [("a", 2020, "1.5"), ("a", 2020, "-"), ("b", 2021, "-"), ("a", 2021, "2"),
              ("a", 2021, "4"), ("a", None, "8")]
    return {
        "offers": spark.createDataFrame(offers, "place string, year int, price double"),
        "cases": spark.createDataFrame(cases, "place string, year int"),
        "wealth": spark.createDataFrame(wealth, "place string, year int, index string"),
    }


MASTER = {
    # avg_price, n_offers, n_cases, avg_wealth; the overall price of a is (10+20+90+40)/4
    ("a", 2020): (15.0, 3, 2, 1.5),
    ("a", 2021): (40.0, 1, None, 3.0),
    ("a", 2022): (40.0, 6, 1, None),
    ("a", None): (40.0, 6, None, None),
    ("b", 2021): (None, 1, None, None),
    ("c", 2020): (None, None, 1, None),
}


def as_dict(df):
    rows = [tuple(r) for r in df.collect()]
    result = {r[:2]: r[2:] for r in rows}
    assert len(result) == len(rows), "keys are not unique"
    return result


def test_master_table(facts):
    master = panel.master_table(facts, SPEC)
    assert master.columns == ["place", "year", "avg_price", "n_offers", "n_cases", "avg_wealth"]
    assert as_dict(master) == MASTER


def test_master_table_does_not_depend_on_layout(facts):
    moved = {n: df.repartition(5).orderBy(F.desc("year")) for n, df in facts.items()}
    assert as_dict(panel.master_table(moved, SPEC)) == MASTER


def test_master_of_one_fact(facts):
    keys = [SPEC.entity, SPEC.period]
    states = {f.name: panel.fact_state(facts[f.name], f, keys) for f in SPEC.facts}
    only = as_dict(panel.master_of_states(states, SPEC, only="offers"))
    assert only == {k: v[:2] for k, v in MASTER.items()}


@pytest.mark.parametrize("rule, filled", [("total", 6), ("mean", 2), ("zero", 0)])
def test_count_fill(facts, rule, filled):
    # offers of a: 3 in 2020, 1 each in 2021, 1990 and without a year: 6 in 4 periods
    master = as_dict(panel.master_table(facts, replace(SPEC, count_fill=rule)))
    assert master["a", 2022][1] == filled and master["a", 2020][1] == 3


def test_sorted_master(facts):
    master = panel.sorted_master(panel.master_table(facts, SPEC), SPEC)
    keys = [(r["place"], r["year"] or 0) for r in master.collect()]
    assert keys == sorted(keys)


def test_spine_and_kpis(facts):
    spine = {tuple(r) for r in panel.period_spine(facts, SPEC).collect()}
    assert spine == set(MASTER)
    kpis = as_dict(panel.fact_kpis(facts["offers"], SPEC.fact("offers"), SPEC))
    assert kpis["a", 2021] == (None, 1) and kpis["a", None] == (40.0, 1)
    state = panel.fact_state(facts["offers"], SPEC.fact("offers"), ["place", "year"])
    whole = {
        r[0]: tuple(r)[1:] for r in panel.entity_kpis(state, SPEC.fact("offers"), SPEC).collect()
    }
    assert whole == {"a": (40.0, 6), "b": (None, 1)}


@pytest.mark.parametrize("fits", [True, False])
def test_aggregating_before_the_lookup_changes_nothing(spark, folder, fits):
    from yearloom.catalog import star

    early = panel.master_of_states(
        {
            name: panel.named_state(
                rows(spark, folder),
                star.PANEL.fact(name),
                star.PANEL,
                star.NAME,
                star.names(spark, folder),
                fits,
            )
            for name, rows in star.ROWS.items()
        },
        star.PANEL,
    )
    late = panel.master_table(star.facts(spark, folder), star.PANEL)
    assert as_dict(early) == as_dict(late)


def test_each_fact_is_scanned_once_and_only_aggregates_are_combined(spark, folder, plan):
    from yearloom.catalog import star

    text = plan(star.master(spark, folder))
    assert text.count("lineitem.parquet") == 1
    # Items by supplier, by name; orders by name; customers and years distinct, then by name;
    # and all states by entity.  What else is shuffled or sent belongs to joins.
    grouped = [x for x in text.split("\n") if "Exchange hashpartitioning" in x]
    assert len([x for x in grouped if "key" not in x]) <= 8
    assert "SortAggregate" not in text
    for forbidden in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "UDF"):
        assert forbidden not in text


@pytest.mark.parametrize("fits", [True, False])
def test_mean_fill_equals_the_window(spark, fits):
    i = F.col("id")
    group = F.when(i % 3 == 0, F.lit("hot")).when(i % 7 == 1, F.lit(None)).otherwise(
        F.concat(F.lit("g"), i % 40)
    )
    value = F.when(i % 5 < 3, (i % 11).cast("double"))
    rows = spark.range(5000).select("id", group.alias("g"), value.alias("x"))
    mean = F.avg("x").over(Window.partitionBy("g"))
    expected = rows.withColumn("x", F.coalesce("x", mean))
    filled = panel.mean_fill(rows, "g", ["x"], fits=fits)
    assert filled.columns == ["id", "g", "x"]
    assert sorted(map(tuple, filled.collect()), key=str) == sorted(
        map(tuple, expected.collect()), key=str
    )


def test_reconcile(spark):
    lookup = spark.createDataFrame(
        [("Gràcia", "Q1"), (" gràcia ", "Q1"), ("Sarrià - Sant Gervasi", "Q2"), (None, "Q3")],
        "district string, id string",
    )
    names = name_lookup(lookup, "district", "id")
    rows = [("GRÀCIA",), ("sarrià-sant gervasi",), ("Horta Guinardó",), (None,), ("",), (" ",)]
    df = spark.createDataFrame(rows, "n string")
    for fits in (True, False):
        found = reconcile(df, names, "n", fits)
        assert found.columns == ["n", "id"]
        assert {tuple(r) for r in found.collect()} == {
            ("GRÀCIA", "Q1"),
            ("sarrià-sant gervasi", "Q2"),
            ("Horta Guinardó", None),
            (None, None),
            ("", None),
            (" ", None),
        }
        assert unmatched(found, "id").count() == 4


def test_two_identifiers_for_one_name(spark):
    lookup = spark.createDataFrame([("A - b", "Q2"), ("a-B", "Q1")], "district string, id string")
    with pytest.raises(PySparkException, match="two identifiers for the name a-b"):
        name_lookup(lookup, "district", "id").collect()
    assert name_lookup(lookup, "district", "id", "min").first()["id"] == "Q1"


def test_periods(spark):
    df = spark.createDataFrame([(2014, 2, 30), (2014, 2, 3)], "y int, m int, d int")
    parts = with_period(df, PeriodSpec("parts", ("y", "m", "d"), date_column="opened"))
    assert parts.columns == ["y", "m", "d", "opened", "year"]
    assert [r["year"] for r in parts.orderBy("d").collect()] == [2014, None]
    assert with_period(df, PeriodSpec("column", ("y",))).columns == ["year", "m", "d"]
    with pytest.raises(ValueError):
        PeriodSpec("parts", ("y",))


def test_specs_refuse_nonsense():
    with pytest.raises(ValueError):
        Measure("m", "avg")
    with pytest.raises(ValueError):
        PanelSpec(facts=(FactSpec("f", (Measure("m", "count"), Measure("m", "count"))),))
    with pytest.raises(ValueError):
        PanelSpec(facts=(), count_fill="median")
