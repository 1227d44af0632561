"""Queries over the star-schema tables, each on the whole of its tables."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from yearloom.catalog import star
from yearloom.catalog.star import ENTITY, INCIDENTS, INCOME, LISTINGS, NAME, PANEL, table
from yearloom.functions import safe_double, year_from_filename
from yearloom.operators import frames, panel, reconcile, registry
from yearloom.plans import increments
from yearloom.session import scratch_path, store
from yearloom.sources import landing, ledger, readers, sketches, writers
from yearloom.specs import DatasetSpec, FactSpec, LookupSpec, Measure, PanelSpec, PeriodSpec

INCIDENT_LABEL, INCOME_LABEL = "incidence_count", "avg_income_index"


def entity_year_kpis(spark: SparkSession, folder: str) -> DataFrame:
    """Per nation and year: prices, sizes, listings, incidents and income."""
    return panel.sorted_master(star.master(spark, folder), PANEL)


def reconcile_names(spark, folder):
    orders = star.incident_rows(spark, folder)
    found = reconcile.reconcile(orders, star.names(spark, folder), NAME)
    return found.select("o_orderkey", NAME, ENTITY)


def unmatched_names(spark, folder):
    orders = star.incident_rows(spark, folder)
    found = reconcile.reconcile(orders, star.names(spark, folder), NAME)
    lost = reconcile.unmatched(found, ENTITY)
    return lost.groupBy(NAME).agg(F.count(F.lit(1)).alias("n_rows"))


def date_from_parts_year(spark, folder):
    orders = reconcile.with_period(star.incident_rows(spark, folder), star.INCIDENT_PERIOD)
    return orders.select("o_orderkey", "opened_date", "year")


FILE_PATTERN = r"(\d{4})_\d{2}_\d{2}_orders\.json"


def _file_name(stem: str):
    """A dated file name per order; orders of status P come from an undated file."""
    dated = F.concat(F.date_format("o_orderdate", "yyyy_MM_dd"), F.lit(f"_{stem}.json"))
    return F.when(F.col("o_orderstatus") == "P", F.lit(f"{stem}.json")).otherwise(dated)


def year_of_filename(spark, folder):
    named = table(spark, folder, "orders").select("o_orderkey", _file_name("orders").alias("file"))
    year = year_from_filename("file", FILE_PATTERN)
    return named.select("o_orderkey", year.alias("year")).where(F.col("year").isNotNull())


def safe_income_cast(spark, folder):
    income = star.income_rows(spark, folder)
    return income.select("c_custkey", "year", safe_double("income_index").alias("income_index"))


def _kpis(name: str):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        fact = PANEL.fact(name)
        state = panel.merged_state(star.states(spark, folder, (name,))[name], fact, PANEL)
        return panel.state_kpis(state, fact, [PANEL.entity, PANEL.period])

    return query


def entity_wide_kpis(spark, folder):
    state = star.states(spark, folder, (LISTINGS,))[LISTINGS]
    return panel.entity_kpis(state, PANEL.fact(LISTINGS), PANEL)


def period_spine(spark, folder):
    return panel.period_spine(star.states(spark, folder, (INCIDENTS, INCOME)), PANEL)


def gap_filled_kpis(spark, folder):
    return panel.master_of_states(star.states(spark, folder), PANEL, only=LISTINGS)


def window_mean_fill(spark, folder):
    """Quantities of open line items replaced by the mean of the supplier's others."""
    known = F.when(F.col("l_linestatus") == "F", F.col("l_quantity"))
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", known.alias("quantity")
    )
    return panel.mean_fill(items, "l_suppkey", ["quantity"])


def dataset_profile(spark, folder):
    """Every column of three tables, with its exact number of values."""

    def profile(name: str) -> DataFrame:
        rows = table(spark, folder, name)
        found = landing.profile(rows, distinct=False).join(landing.exact_distinct(rows), "column_name")
        return found.withColumn("dataset", F.lit(name))

    return reduce(DataFrame.unionByName, map(profile, ("lineitem", "orders", "customer")))


def approximate_distinct(spark, folder):
    """Whether the approximate numbers of values are within a tenth of the exact ones."""

    def checked(name: str) -> DataFrame:
        rows = table(spark, folder, name)
        both = landing.profile(rows).join(landing.exact_distinct(rows), "column_name")
        off = F.abs(F.col("approx_distinct") - F.col("n_distinct")) / F.col("n_distinct")
        return both.select(F.lit(name).alias("dataset"), "column_name", (off <= 0.1).alias("close"))

    return reduce(DataFrame.unionByName, map(checked, ("lineitem", "orders", "customer")))


def raw_manifest(spark, folder):
    """The bytes of the table files, landed as ranges: files, lengths and digests."""
    globs = {name: f"{folder}/{name}.parquet" for name in ("lineitem", "orders", "customer")}
    ranges = landing.raw_ranges(landing.raw_manifest(spark, globs))
    return ranges.select("dataset", "file_name", "length", "range_no", "offset", "sha256")


def complete_rows(spark, folder):
    master = star.master(spark, folder)
    return frames.complete_rows(master, [INCIDENT_LABEL, INCOME_LABEL])


def mean_imputed(spark, folder):
    """Prices of orders of status P imputed by the mean of the others."""
    known = F.when(F.col("o_orderstatus") != "P", star.cents("o_totalprice"))
    orders = table(spark, folder, "orders").select("o_orderkey", known.alias("price"))
    return frames.mean_imputed(orders, ["price"])


def _split_orders(spark, folder):
    bucket = F.pmod(F.col("o_orderkey") * 31 + 7, F.lit(100))
    return frames.key_split(table(spark, folder, "orders"), ["o_orderkey"], bucket=bucket)


def key_split_counts(spark, folder):
    return frames.split_counts(_split_orders(spark, folder))


def random_split_total(spark, folder):
    """The two parts of a random split together are the whole table, once."""
    keys = table(spark, folder, "orders").select("o_orderkey")
    train, validation = frames.random_split(keys)
    return train.unionByName(validation).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("o_orderkey").alias("sum_key"),
    )


def rmse_by_model(spark, folder):
    """Errors of two fixed guesses of a line item's quantity."""
    guesses = F.array(
        F.struct(F.lit("constant").alias("model"), F.lit(25.0).alias("prediction")),
        F.struct(
            F.lit("by_line").alias("model"),
            (F.col("l_linenumber") * 7).cast("double").alias("prediction"),
        ),
    )
    scored = table(spark, folder, "lineitem").select("l_quantity", F.inline(guesses))
    return frames.rmse_by(scored, ["model"], "l_quantity", "prediction")


def small_data_checks(spark, folder):
    master = star.master(spark, folder)

    def rows_with(*columns):
        return F.count_if(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns]))

    counts = master.agg(
        rows_with(INCIDENT_LABEL, INCOME_LABEL).alias("incident_rows"),
        rows_with(INCOME_LABEL, INCIDENT_LABEL, "avg_price").alias("income_rows"),
        F.count(F.lit(1)).alias("all_rows"),
    )
    limits = {"incident_rows": 50, "income_rows": 20, "all_rows": 1_000_000}
    return frames.small_data_check(counts, limits)


def champion_runs(spark, folder):
    """Orders as runs: experiment = customer, score = price, with NaN for status P."""
    score = F.when(F.col("o_orderstatus") == "P", F.lit(float("nan"))).otherwise(
        F.floor(F.col("o_totalprice") / 1000).cast("double")
    )
    runs = table(spark, folder, "orders").select(
        F.col("o_custkey").alias("experiment"),
        F.col("o_orderkey").alias("run_order"),
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"),
        score.alias("rmse"),
    )
    return registry.champions(runs)


def registry_promote(spark, folder):
    """Orders as model versions; each customer brings a new version of its model."""
    status = F.col("o_orderstatus")
    versions = table(spark, folder, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey")).alias("name"),
        F.col("o_orderkey").alias("version"),
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"),
        F.when(status == "F", F.lit(registry.PRODUCTION))
        .when(status == "O", F.lit(registry.ARCHIVED))
        .otherwise(F.lit(registry.NO_STAGE))
        .alias("stage"),
    )
    candidates = table(spark, folder, "customer").select(
        F.concat(F.lit("model_"), F.col("c_custkey")).alias("name"),
        F.concat(F.lit("new_"), F.col("c_custkey")).alias("run_id"),
    )
    return registry.register_and_promote(versions, candidates)


def partitioned_round_trip(spark, folder):
    """Line items written by ship year and read back, with the year from the directories.

    The year of seventh lines is not known.
    """
    path = scratch_path(spark, "items-by-year")
    writers.write_by_period(_items_by_year(spark, folder), path)
    return _by_year(readers.read_table(spark, path))


def _items_by_year(spark: SparkSession, folder: str) -> DataFrame:
    year = F.when(F.col("l_linenumber") < 7, F.year("l_shipdate"))
    return table(spark, folder, "lineitem").withColumn("year", year)


def _by_year(items: DataFrame) -> DataFrame:
    return items.groupBy("year").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("l_quantity").alias("sum_quantity"),
        F.min("l_shipdate").alias("first_date"),
        F.max("l_shipdate").alias("last_date"),
    )


def pruned_years(spark, folder):
    """Two years of the line items; the other directories are not read."""
    path = scratch_path(spark, "items-by-year")
    writers.write_by_period(_items_by_year(spark, folder), path)
    return _by_year(readers.read_table(spark, path, years=(1994, 1996)))


def overwritten_years(spark, folder):
    """Line items written twice, the second time the first lines of one year only."""
    path, items = scratch_path(spark, "items-by-year"), _items_by_year(spark, folder)
    writers.write_by_period(items, path, "orc")
    again = items.where("year = 1995 AND l_linenumber = 1")
    writers.write_by_period(again, path, "orc", overwrite=True, only_given=True)
    return _by_year(readers.read_table(spark, path, "orc"))


def sorted_preview(spark, folder):
    orders = table(spark, folder, "orders").select("o_custkey", "o_orderkey", "o_totalprice")
    return landing.preview(orders, 5, ["o_custkey", "o_orderkey"])


ORDER_FILES = DatasetSpec(
    name="orders",
    format="json",
    glob="orders/*",
    schema=star.SCHEMAS["orders"],
    name_column="o_custkey",
    period=PeriodSpec("filename", pattern=FILE_PATTERN),
)
CUSTOMER_FILES = DatasetSpec(
    name="customers",
    format="csv",
    glob="customers/*.csv",
    schema=star.SCHEMAS["customer"],
    name_column="c_name",
    period=PeriodSpec("column", ("c_nationkey",)),
)


def csv_json_round_trip(spark, folder):
    """Orders as JSON in dated places and customers as CSV, read back with schemas.

    The year of an order comes from the path of its file.
    """
    base = scratch_path(spark, "landing")
    snapshot = F.date_format(F.trunc("o_orderdate", "month"), "yyyy_MM_dd")
    order_files = table(spark, folder, "orders").withColumn(
        "snapshot", F.concat(snapshot, F.lit("_orders.json"))
    )
    writers.by_period(order_files, "snapshot").write.partitionBy("snapshot").json(f"{base}/orders")
    writers.write_table(table(spark, folder, "customer"), f"{base}/customers", "csv")

    landed = readers.read_landing(spark, [ORDER_FILES, CUSTOMER_FILES], base)
    orders = reconcile.with_period(landed["orders"], ORDER_FILES.period)
    return (
        orders.join(landed["customers"], F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("year")
        .agg(
            F.count(F.lit(1)).alias("n_orders"),
            F.sum(star.cents("o_totalprice")).alias("sum_cents"),
            F.sum(star.cents("c_acctbal")).alias("sum_balance_cents"),
            F.max("c_custkey").alias("last_customer"),
            F.count_if(F.col("c_mktsegment") == "FURNITURE").alias("n_furniture"),
            F.max("o_orderdate").alias("last_date"),
        )
    )


def text_columns(spark, folder):
    """The customers' CSV read without a schema: every column is text."""
    base = scratch_path(spark, "landing")
    writers.write_table(table(spark, folder, "customer"), f"{base}/customers", "csv")
    rows = readers.preview_dataset(spark, CUSTOMER_FILES, base)
    texts = [f.name for f in rows.schema.fields if f.dataType.simpleString() == "string"]
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(",".join(texts)).alias("text_columns"),
        F.sum(F.length("c_custkey") + F.length("c_name")).alias("n_characters"),
    )


LOOKUP_FILE = LookupSpec(
    file="nations/*.csv",
    name_column=NAME,
    id_column=ENTITY,
    schema=f"{NAME} string, {ENTITY} string",
)


def lookup_file(spark, folder):
    """The lookup of names, written as CSV and read back."""
    base = scratch_path(spark, "lookup")
    writers.write_table(star.lookup_rows(spark, folder), f"{base}/nations", "csv")
    raw = readers.read_lookup(spark, LOOKUP_FILE, base)
    found = reconcile.name_lookup(raw, LOOKUP_FILE.name_column, LOOKUP_FILE.id_column)
    return found.withColumnRenamed(found.columns[0], "name_key")


CHECKED_FILES = replace(ORDER_FILES, corrupt_column="bad_record")


def quarantined_records(spark, folder):
    """Orders as JSON, those of status P with text for a price; what fits and what does not."""
    base = scratch_path(spark, "landing")
    bad = F.when(F.col("o_orderstatus") == "P", F.lit("n/a"))
    price = F.coalesce(bad, F.col("o_totalprice").cast("string"))
    plain = F.to_json(F.struct(*star.table(spark, folder, "orders").columns))
    spoiled = F.to_json(F.struct("o_orderkey", "o_orderstatus", price.alias("o_totalprice")))
    lines = table(spark, folder, "orders").select(F.coalesce(F.when(bad.isNotNull(), spoiled), plain))
    lines.write.text(f"{base}/orders")
    landed = readers.read_dataset(spark, CHECKED_FILES, base)
    good = readers.good_records(landed, CHECKED_FILES)
    corrupt = readers.corrupt_records(landed, CHECKED_FILES)
    kinds = [
        good.select(F.lit("good").alias("kind"), "o_totalprice", F.lit(None).cast("string").alias("record")),
        corrupt.select(F.lit("corrupt").alias("kind"), F.lit(None).cast("double").alias("o_totalprice"), "record"),
    ]
    return kinds[0].unionByName(kinds[1]).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(star.cents("o_totalprice")).alias("sum_cents"),
        F.count_if(F.contains("record", F.lit("n/a"))).alias("n_spoiled"),
    )


def landed_round_trip(spark, folder):
    """Customers as CSV files, landed as ranges of bytes, restored to files, and parsed."""
    base = scratch_path(spark, "source")
    writers.write_table(table(spark, folder, "customer"), f"{base}/customers", "csv")
    landed = scratch_path(spark, "landed")
    landing.ingest_raw(spark, {"customers": f"{base}/customers/*.csv"}, landed)
    restored = scratch_path(spark, "restored")
    files = landing.restore_files(spark.read.parquet(f"{landed}/customers/raw"), restored)
    assert files.count() > 0
    return readers.read_dataset(spark, CUSTOMER_FILES, restored).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(star.cents("c_acctbal")).alias("sum_cents"),
        F.max("c_custkey").alias("last_customer"),
    )


# Orders as files of bounded size, by year and range of keys, and a master table kept from them.
YEARLY_FILES = DatasetSpec(
    name="orders",
    format="csv",
    glob="orders/*.csv",
    schema="entity_id string, year int, price double, status string",
    name_column="entity_id",
    period=PeriodSpec("column", ("year",)),
    multi_line=False,
)
YEARLY_PANEL = PanelSpec(
    facts=(FactSpec("orders", (Measure("avg_price", "avg", "price"), Measure("n_orders", "count"))),)
)
FILE_ORDERS = 10_000  # keys of a file


def _order_files(orders: DataFrame) -> DataFrame:
    """The contents of the files, as landed ranges."""
    name = F.format_string("orders-%d-%05d.csv", F.year("o_orderdate"), F.expr(f"o_orderkey div {FILE_ORDERS}"))
    entity = F.concat(F.lit("E"), F.col("o_custkey") % 40)
    line = F.concat_ws(",", entity, F.year("o_orderdate"), star.cents("o_totalprice").cast("long"), "o_orderstatus")
    # No more lines than a file has keys.
    lines = orders.groupBy(name.alias("file_name")).agg(F.sort_array(F.collect_list(line)).alias("lines"))
    text = F.concat(F.lit("entity_id,year,price,status\n"), F.array_join("lines", "\n"), F.lit("\n"))
    return lines.select(F.lit("orders").alias("dataset"), "file_name", F.lit(0).alias("range_no"), F.encode(text, "UTF-8").alias("content"))


def _read_orders(folder: str, name: str) -> DataFrame:
    spark = SparkSession.getActiveSession()
    rows = readers.read_dataset(spark, YEARLY_FILES, folder)
    return rows.select("entity_id", "year", "price", F.col("_metadata.file_name").alias(increments.FILE))


CHECKED_CSV = replace(CUSTOMER_FILES, corrupt_column="bad_record")


def quarantined_csv(spark, folder):
    """Customers as CSV, those of segment FURNITURE with text for a balance; what fits and what does not."""
    base = scratch_path(spark, "landing")
    bad = F.when(F.col("c_mktsegment") == "FURNITURE", F.lit("n/a"))
    rows = table(spark, folder, "customer").withColumn("c_acctbal", F.coalesce(bad, F.col("c_acctbal").cast("string")))
    writers.write_table(rows, f"{base}/customers", "csv")
    landed = readers.read_dataset(spark, CHECKED_CSV, base)
    good = readers.good_records(landed, CHECKED_CSV).select("c_mktsegment", F.lit(None).cast("string").alias("record"))
    corrupt = readers.corrupt_records(landed, CHECKED_CSV).select(F.lit(None).cast("string").alias("c_mktsegment"), "record")
    return good.unionByName(corrupt).groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.contains("record", F.lit("n/a"))).alias("n_spoiled")
    )


def _three_runs(spark: SparkSession, folder: str, update: bool = True) -> str:
    """A ledger and a master table after files were landed, replaced and withdrawn; the folder of both.

    At first there are no files of 1997.  Then those are added, and the files of 1995 lose the
    orders of status P.  Then the files of 1999 are withdrawn.  A fourth run finds nothing new.
    """
    orders, year = table(spark, folder, "orders"), F.year("o_orderdate")
    source, base = scratch_path(spark, "order-files"), scratch_path(spark, "increments")
    second = ((year == 1995) & (F.col("o_orderstatus") != "P")) | (year == 1997)
    globs = ["orders/*.csv", "orders/*.csv", "orders/orders-???[0-8]-*.csv", "orders/orders-???[0-8]-*.csv"]
    for rows, glob in zip((orders.where(year != 1997), orders.where(second), None, None), globs, strict=True):
        if rows is not None:
            landing.restore_files(_order_files(rows), source).count()
        ledger.land_changes(spark, {"orders": f"{source}/{glob}"}, base)
        if update:
            increments.update(spark, base, YEARLY_PANEL, _read_orders, buckets=16)
    return base


def landing_ledger(spark, folder):
    """How many files each run landed and withdrew."""
    events = ledger.events(spark, _three_runs(spark, folder, update=False))
    return events.groupBy("run", "event").agg(F.count(F.lit(1)).alias("n_files"))


def incremental_master(spark, folder):
    """The master table after files were landed, replaced and withdrawn."""
    base = _three_runs(spark, folder)
    return increments.master(spark, base, YEARLY_PANEL, "entity_id string, year int, avg_price double, n_orders bigint")


def event_registry(spark, folder):
    """Orders as events of a model registry, every third one noted twice.

    All register a version of their customer's model, those of status F promote it three days later.
    """
    orders = table(spark, folder, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey")).alias("name"),
        F.concat(F.lit("run_"), F.col("o_orderkey")).alias("run_id"),
        F.col("o_orderdate").cast("date").alias("at"),
        "o_orderkey",
        "o_orderstatus",
    )
    event = lambda rows, kind, at: rows.select("name", "run_id", F.lit(kind).alias("event"), at.cast("timestamp").alias("at"))
    first = event(orders, registry.REGISTERED, F.col("at"))
    again = event(orders.where(F.col("o_orderkey") % 3 == 0), registry.REGISTERED, F.date_add("at", 9))
    promoted = event(orders.where(F.col("o_orderstatus") == "F"), registry.PROMOTED, F.date_add("at", 3))
    return registry.state_of_events(first.unionByName(again).unionByName(promoted).unionByName(promoted))


def exact_split_counts(spark, folder):
    """Orders split by arithmetic hashes, exactly four fifths of each status."""
    number = F.col("o_orderkey") * 48271 % 2147483647
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    split = frames.exact_split(orders, ["o_orderkey"], ["o_orderstatus"], number=number)
    return split.groupBy("o_orderstatus", "split").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("o_orderkey").alias("sum_keys"), F.max("o_orderkey").alias("last_key")
    )


def carried_quantities(spark, folder):
    """Quantities of line items, those of open ones carried from the item before with the same flag."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_returnflag",
        F.when(F.col("l_linestatus") == "F", F.col("l_quantity")).alias("quantity"),
    )
    items = items.groupBy("l_returnflag", "l_orderkey", "l_linenumber").agg(F.max("quantity").alias("quantity"))
    return panel.carried_forward(items, "l_returnflag", ["l_orderkey", "l_linenumber"], ["quantity"])


def merged_profile(spark, folder):
    """Line items profiled by ship year; the profiles of all years, and of two, against exact counts and ranks."""
    items = table(spark, folder, "lineitem").withColumn("year", F.year("l_shipdate"))
    kept = store(sketches.part_profiles(items, "year"), "part-profiles")
    quantiles, numbers = (0.1, 0.5, 0.9), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice"]

    def checked(years: list[int] | None) -> DataFrame:
        chosen = lambda df, c: df if years is None else df.where(F.col(c).isin(years))
        merged = store(sketches.merged_profile(chosen(kept, "part"), quantiles), "merged-profile")
        rows = chosen(items, "year").drop("year")
        # Six columns with three quantiles each.
        found = {r["column_name"]: r["quantiles"] for r in merged.select("column_name", "quantiles").collect()}
        shares = []
        for c in numbers:
            fits = F.lit(True)
            for q, value in zip(quantiles, found.get(c) or [], strict=False):
                below, upto = F.avg((F.col(c) < value).cast("int")), F.avg((F.col(c) <= value).cast("int"))
                fits = fits & (below <= q + 0.02) & (upto >= q - 0.02)
            shares.append(F.struct(F.lit(c).alias("column_name"), fits.alias("ranks_close")))
        ranks = rows.agg(F.array(*shares).alias("all")).select(F.inline("all"))
        both = merged.join(landing.exact_distinct(rows), "column_name").join(ranks, "column_name", "left")
        off = F.abs(F.col("approx_distinct") - F.col("n_distinct")) <= 0.08 * F.col("n_distinct")
        return both.select(
            F.lit("all" if years is None else "some").alias("years"), "column_name", "row_count", "null_count",
            off.alias("values_close"), "ranks_close",
        )

    return checked(None).unionByName(checked([1996, 1998]))


QUERIES = {
    "exact_split_counts": exact_split_counts,
    "carried_quantities": carried_quantities,
    "merged_profile": merged_profile,
    "event_registry": event_registry,
    "quarantined_csv": quarantined_csv,
    "landing_ledger": landing_ledger,
    "incremental_master": incremental_master,
    "entity_year_kpis": entity_year_kpis,
    "reconcile_names": reconcile_names,
    "unmatched_names": unmatched_names,
    "date_from_parts_year": date_from_parts_year,
    "year_from_filename": year_of_filename,
    "safe_income_cast": safe_income_cast,
    "listing_kpis": _kpis(LISTINGS),
    "incident_kpis": _kpis(INCIDENTS),
    "income_kpis": _kpis(INCOME),
    "entity_wide_kpis": entity_wide_kpis,
    "period_spine": period_spine,
    "gap_filled_kpis": gap_filled_kpis,
    "window_mean_fill": window_mean_fill,
    "dataset_profile": dataset_profile,
    "approximate_distinct": approximate_distinct,
    "raw_manifest": raw_manifest,
    "complete_rows": complete_rows,
    "mean_imputed": mean_imputed,
    "key_split_counts": key_split_counts,
    "random_split_total": random_split_total,
    "rmse_by_model": rmse_by_model,
    "small_data_checks": small_data_checks,
    "champion_runs": champion_runs,
    "registry_promote": registry_promote,
    "partitioned_round_trip": partitioned_round_trip,
    "pruned_years": pruned_years,
    "overwritten_years": overwritten_years,
    "text_columns": text_columns,
    "lookup_file": lookup_file,
    "quarantined_records": quarantined_records,
    "landed_round_trip": landed_round_trip,
    "sorted_preview": sorted_preview,
    "csv_json_round_trip": csv_json_round_trip,
}
