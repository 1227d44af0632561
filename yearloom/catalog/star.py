"""The star-schema tables in the roles of lookup and facts.

Entity = nation, period = year.  All rows of all tables take part:

* lookup: every nation in two spellings, ``NATION - 3`` and ``nation-3``;
* listings: line items by the supplier's nation, snapshotted three years after
  shipping, so that early years have none and late years have nothing else;
* incidents: orders by the customer's nation.  Names come in several spellings;
  the segment MACHINERY leaves the hyphen out (no match) and the priority
  ``4-NOT SPECIFIED`` has no name.  Priority ``5-LOW`` books everything on day 31,
  which gives impossible dates in short months;
* income: one row per customer and year with an order, two years earlier, with an
  index given as text, ``-`` for the segment FURNITURE.

Amounts are whole cents, so sums and averages are exact in any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.operators.joins import fits_broadcast
from yearloom.operators.panel import (
    fact_state,
    master_of_states,
    named_state,
    renamed_state,
)
from yearloom.operators.reconcile import matched, name_lookup, reconcile, with_period
from yearloom.session import store
from yearloom.specs import FactSpec, Measure, PanelSpec, PeriodSpec

NAME = "raw_name"
ENTITY = "entity_id"
LISTINGS, INCIDENTS, INCOME = "listings", "incidents", "income"

PANEL = PanelSpec(
    facts=(
        FactSpec(
            LISTINGS,
            (
                Measure("avg_price", "avg", "price"),
                Measure("avg_size", "avg", "size"),
                Measure("avg_price_per_sqm", "avg", "price_by_area"),
                Measure("property_count", "count"),
            ),
            in_spine=False,
            gap_fill=True,
        ),
        FactSpec(INCIDENTS, (Measure("incidence_count", "count"),)),
        FactSpec(INCOME, (Measure("avg_income_index", "avg", "income_index"),)),
    ),
)
INCIDENT_PERIOD = PeriodSpec("parts", ("opened_year", "opened_month", "opened_day"))


# Declared, so that building a plan does not open files to find out.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def cents(amount: str) -> Column:
    return F.floor(F.col(amount) * 100 + F.lit(0.5)).cast("double")


def lookup_rows(spark: SparkSession, folder: str) -> DataFrame:
    nation = table(spark, folder, "nation")
    identifier = F.concat(F.lit("E"), F.col("n_nationkey")).alias(ENTITY)
    spaced = F.replace(F.col("n_name"), F.lit("_"), F.lit(" - "))
    tight = F.lower(F.replace(F.col("n_name"), F.lit("_"), F.lit("-")))
    return nation.select(F.explode(F.array(spaced, tight)).alias(NAME), identifier)


def names(spark: SparkSession, folder: str) -> DataFrame:
    return name_lookup(lookup_rows(spark, folder), NAME, ENTITY)


def _spelled(spaced: Column, loose: Column) -> Column:
    """A nation's name with a hyphen, with blanks around it, or without one."""
    hyphen = F.when(loose, F.lit(" ")).when(spaced, F.lit(" - ")).otherwise(F.lit("-"))
    return F.concat(F.lit(" "), F.replace(F.col("n_name"), F.lit("_"), hyphen))


def _listed_items(spark: SparkSession, folder: str) -> DataFrame:
    price = cents("l_extendedprice")
    return table(spark, folder, "lineitem").select(
        "l_suppkey",
        (F.col("l_returnflag") == "R").alias("spaced"),
        (F.year("l_shipdate") + 3).alias("year"),
        price.alias("price"),
        F.col("l_quantity").alias("size"),
        F.floor(price / F.col("l_quantity")).cast("double").alias("price_by_area"),
    )


def _with_nation(items: DataFrame, spark: SparkSession, folder: str) -> DataFrame:
    """Items, or states of items, with the name of their supplier's nation."""
    supplier, nation = table(spark, folder, "supplier"), table(spark, folder, "nation")
    joined = items.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    kept = [c for c in items.columns if c not in ("l_suppkey", "spaced")]
    return joined.select(_spelled(F.col("spaced"), F.lit(False)).alias(NAME), *kept)


def listing_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _with_nation(_listed_items(spark, folder), spark, folder)


def _listing_state(spark: SparkSession, folder: str) -> DataFrame:
    """Sums and counts by supplier and year, and only then the names: no items are joined."""
    fact = PANEL.fact(LISTINGS)
    state = fact_state(_listed_items(spark, folder), fact, ["l_suppkey", "spaced", "year"])
    return _with_nation(state, spark, folder)


def incident_rows(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    priority = F.col("o_orderpriority")
    spelled = _spelled(priority == "1-URGENT", F.col("c_mktsegment") == "MACHINERY")
    return (
        table(spark, folder, "orders")
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "o_orderkey",
            F.when(priority != "4-NOT SPECIFIED", spelled).alias(NAME),
            F.year("o_orderdate").alias("opened_year"),
            F.month("o_orderdate").alias("opened_month"),
            F.when(priority == "5-LOW", 31)
            .otherwise(F.dayofmonth("o_orderdate"))
            .alias("opened_day"),
        )
    )


def income_rows(spark: SparkSession, folder: str) -> DataFrame:
    customer, nation = table(spark, folder, "customer"), table(spark, folder, "nation")
    segment = F.col("c_mktsegment")
    index = F.when(segment == "FURNITURE", F.lit("-")).otherwise(
        cents("c_acctbal").cast("long").cast("string")
    )
    return (
        table(spark, folder, "orders")
        .select("o_custkey", (F.year("o_orderdate") - 2).alias("year"))
        .distinct()
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            "c_custkey",
            _spelled(segment == "HOUSEHOLD", F.lit(False)).alias(NAME),
            "year",
            index.alias("income_index"),
        )
    )


def _incidents_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return with_period(incident_rows(spark, folder), INCIDENT_PERIOD)


ROWS = {LISTINGS: listing_rows, INCIDENTS: _incidents_by_year, INCOME: income_rows}


def facts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The facts, row by row, with identifiers and years; rows without identifier drop out."""
    lookup, fits = _checked_names(spark, folder)
    return {
        name: matched(reconcile(rows(spark, folder), lookup, NAME, fits), ENTITY)
        for name, rows in ROWS.items()
    }


def states(
    spark: SparkSession, folder: str, wanted: tuple[str, ...] = (LISTINGS, INCIDENTS, INCOME)
) -> dict[str, DataFrame]:
    """The facts' sums and counts per name and year, with the entity."""
    lookup, fits = _checked_names(spark, folder)

    def state(name: str) -> DataFrame:
        fact = PANEL.fact(name)
        if name == LISTINGS:
            reduced = _listing_state(spark, folder)
            return renamed_state(reduced, fact, PANEL, NAME, lookup, fits)
        return named_state(ROWS[name](spark, folder), fact, PANEL, NAME, lookup, fits)

    return {name: state(name) for name in wanted}


def _checked_names(spark: SparkSession, folder: str) -> tuple[DataFrame, bool]:
    """The cleaned lookup, stored once for all facts, and whether it may be broadcast."""
    lookup = store(names(spark, folder), "names")
    return lookup, fits_broadcast(lookup)


def master(spark: SparkSession, folder: str) -> DataFrame:
    return master_of_states(states(spark, folder), PANEL)
