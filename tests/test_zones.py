"""The zone stages on a small landing zone of our own.

With the environment variable ``CITY_ZONES`` naming a folder that holds ``landing`` and
``lookup`` with the published sample of the city data, they also run on that.
"""

import json
import os

import pytest
from pyspark.sql import functions as F

from yearloom import cli, session
from yearloom.plans import city, zones
from yearloom.sources import landing, readers, writers

SAMPLE = os.environ.get("CITY_ZONES", "")


def listing(district, price, size):
    return {
        "district": district,
        "price": price,
        "size": size,
        "priceByArea": price / size,
        "propertyCode": "p",
        "detailedType": {"typology": "flat"},
    }


def names_of(schema):
    return [c.split()[0] if c[0] != "`" else c.split("`")[1] for c in zones._split_columns(schema)]


@pytest.fixture(scope="module")
def base(tmp_path_factory):
    base = tmp_path_factory.mktemp("zones")
    for folder in ("landing/idealista", "landing/incidences", "landing/income", "lookup"):
        (base / folder).mkdir(parents=True)
    listings = {
        "2020_01_02_idealista.json": [
            listing("Gràcia", 100.0, 10.0),
            listing("gràcia ", 300.0, 10.0),
        ],
        "2021_01_02_idealista.json": [listing("Sarrià - Sant Gervasi", 50.0, 10.0)],
        "2020_11_11_idealista.json": [],
        "listing.json": [listing("Gràcia", 9999.0, 1.0)],  # no date: drops out
    }
    for name, rows in listings.items():
        (base / "landing/idealista" / name).write_text(json.dumps(rows, ensure_ascii=False))

    columns = names_of(city.INCIDENTS.schema)
    incidents = [
        ("GRÀCIA", 2019, 1, 5),
        ("Gràcia", 2020, 12, 31),
        ("Gràcia", 2020, 2, 30),  # no such day
        ("Horta Guinardó", 2020, 1, 1),  # not in the lookup
        (None, 2020, 1, 1),
    ]
    lines = [",".join(columns)]
    for district, year, month, day in incidents:
        values = {"ANY_DATA_ALTA": year, "MES_DATA_ALTA": month, "DIA_DATA_ALTA": day,
                  "DISTRICTE": district, "DETALL": '"a, b"', "_id": 1}
        lines.append(",".join(str(values.get(c) or "") for c in columns))
    text = "\r\n".join(lines) + "\r\n"
    (base / "landing/incidences/2020_x.csv").write_bytes(text.encode())

    income = [
        (2019, "Gràcia", "100.5"),
        (2019, "Gràcia", "99.5"),
        (2020, "Sarrià-Sant Gervasi", "180"),
        (2020, "No consta", "-"),
    ]
    lines = [",".join(f'"{c}"' for c in names_of(city.INCOME.schema))]
    lines += [f'{y},1,"{d}",1,"b",10,"{v}"' for y, d, v in income]
    (base / "landing/income/2020_y.csv").write_bytes(("\r\n".join(lines) + "\r\n").encode())

    columns = names_of(city.LOOKUP.schema)
    lines = [",".join(columns)]
    for district, identifier in [("Gràcia", "Q1"), ("Gràcia", "Q1"), ("Sarrià-Sant Gervasi", "Q2")]:
        values = {"district": district, "district_id": identifier}
        lines.append(",".join(values.get(c, "x") for c in columns))
    (base / "lookup" / city.LOOKUP.file).write_text("\n".join(lines) + "\n")
    return base


EXPECTED = {
    ("Q1", 2019): (200.0, 10.0, 20.0, 2, 1, 100.0),
    ("Q1", 2020): (200.0, 10.0, 20.0, 2, 1, None),
    ("Q1", None): (200.0, 10.0, 20.0, 2, None, None),
    ("Q2", 2020): (50.0, 10.0, 5.0, 1, None, 180.0),
}


def stages(spark, base, target, fmt):
    formatted, exploited = f"{target}/formatted", f"{target}/exploitation"
    cli.main(["format", "-l", f"{base}/landing", "-k", f"{base}/lookup", "-f", formatted,
              "--format", fmt], spark)
    cli.main(["exploit", "-f", formatted, "-e", exploited, "--format", fmt], spark)
    return formatted, f"{exploited}/{city.MASTER}"


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_zones(spark, base, tmp_path, fmt):
    formatted, master = stages(spark, base, tmp_path, fmt)
    schema = zones.master_schema(city.PANEL) if fmt == "json" else None
    rows = readers.read_table(spark, master, fmt, schema=schema).collect()
    assert {tuple(r)[:2]: tuple(r)[2:] for r in rows} == EXPECTED
    assert len(rows) == len(EXPECTED)

    schemas = {s.name: zones.formatted_schema(s, city.LOOKUP) for s in city.DATASETS}
    tables = readers.read_tables(
        spark, formatted, schemas, fmt, schemas=schemas if fmt == "json" else None
    )
    counts = {n: (t.count(), t.where("district_id is null").count()) for n, t in tables.items()}
    assert counts == {"idealista": (3, 0), "incidences": (5, 2), "income": (4, 1)}
    assert "Any" not in tables["income"].columns
    assert tables["idealista"].select("detailedType.typology").distinct().first()[0] == "flat"
    assert "__HIVE_DEFAULT_PARTITION__" in "".join(os.listdir(f"{formatted}/incidences"))


def test_csv_master_from_a_parquet_zone(spark, base, tmp_path):
    formatted, _ = stages(spark, base, tmp_path, "parquet")
    target = str(tmp_path / "csv")
    cli.main(["exploit", "-f", formatted, "-e", target, "--format", "csv"], spark)
    schema = zones.master_schema(city.PANEL)
    rows = readers.read_table(spark, f"{target}/{city.MASTER}", "csv", schema=schema).collect()
    assert {tuple(r)[:2]: tuple(r)[2:] for r in rows} == EXPECTED


def test_nested_columns_are_refused_for_csv_before_anything_is_written(spark, base, tmp_path):
    with pytest.raises(ValueError, match="detailedType"):
        cli.run_format(spark, f"{base}/landing", f"{base}/lookup", str(tmp_path / "f"), "csv")
    assert not (tmp_path / "f").exists()


def test_existing_target(spark, base, tmp_path):
    arguments = (spark, f"{base}/landing", f"{base}/lookup", str(tmp_path / "f"))
    cli.run_format(*arguments)
    with pytest.raises(Exception, match="(?i)already exists"):
        cli.run_format(*arguments)
    cli.run_format(*arguments, overwrite=True)


def test_overwriting_only_the_given_years(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, 2019), (2, 2020), (3, 2020)], "v int, year int")
    writers.write_by_period(df, path)
    update = df.where("v = 3")
    writers.write_by_period(update, path, overwrite=True, only_given=True)
    assert {r["v"] for r in readers.read_table(spark, path).collect()} == {1, 3}
    writers.write_by_period(update, path, overwrite=True)
    assert {r["v"] for r in readers.read_table(spark, path).collect()} == {3}


def test_years_prune_partitions_and_columns(spark, tmp_path, plan):
    path = str(tmp_path / "t")
    year = (2000 + F.col("id") % 5).cast("int").alias("year")
    df = spark.range(100).select("id", F.lit("x").alias("unused"), year)
    writers.write_by_period(df, path)
    some = readers.read_table(spark, path, years=[2001, 2003])
    assert some.count() == 40
    text = plan(some.select("id"))
    assert "PartitionFilters: [year" in text and "ReadSchema: struct<id:bigint>" in text


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_a_hot_year_is_written_by_several_tasks(spark, tmp_path, adaptive):
    settings = {
        "spark.sql.adaptive.enabled": adaptive,
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    }
    previous = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        year = F.when(F.col("id") % 10 < 8, 2020).otherwise(2011 + F.col("id") % 10).cast("int")
        df = spark.range(0, 400_000, 1, 8).select(F.xxhash64("id").alias("v"), year.alias("year"))
        writers.write_by_period(df, str(tmp_path / "t"))
        written = readers.read_table(spark, str(tmp_path / "t"))
        assert written.count() == 400_000
        files = written.groupBy("year").agg(F.countDistinct("_metadata.file_path").alias("n"))
        found = {r["year"]: r["n"] for r in files.collect()}
        assert found[2020] > 1 and found[2019] <= 8
    finally:
        for name, value in previous.items():
            spark.conf.set(name, value)


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unknown format"):
        writers.write_table(spark.range(1), "/nowhere", "avro")


def test_preview_stage(spark, base, capfd):
    cli.main(["land", "-s", f"{base}/landing"], spark)
    assert "propertyCode" in capfd.readouterr().out


def test_required_arguments():
    for arguments in (["format"], ["exploit", "-f", "x"], ["land"], ["land", "-s", "x", "-m", "copy"], ["train"]):
        with pytest.raises(SystemExit):
            cli.main(arguments)


def test_copied_files_can_be_formatted(spark, base, tmp_path):
    """Landed as ranges, restored, and formatted: the same master table."""
    landed, restored = f"{tmp_path}/landed", f"{tmp_path}/restored"
    cli.main(["land", "-s", f"{base}/landing", "-l", landed, "-m", "copy"], spark)
    for name in ("idealista", "incidences", "income"):
        files = landing.restore_files(spark.read.parquet(f"{landed}/{name}/raw"), restored)
        assert files.count() == len(os.listdir(base / "landing" / name))
    (tmp_path / "zones").mkdir()
    (tmp_path / "zones" / "landing").symlink_to(restored)
    (tmp_path / "zones" / "lookup").symlink_to(base / "lookup")
    _, master = stages(spark, tmp_path / "zones", tmp_path / "out", "parquet")
    rows = readers.read_table(spark, master).collect()
    assert {tuple(r)[:2]: tuple(r)[2:] for r in rows} == EXPECTED


def test_stages_leave_nothing_in_the_shared_folder(spark, base, tmp_path, monkeypatch):
    shared = tmp_path / "shared"
    monkeypatch.setattr(session, "shared_folder", lambda spark: str(shared))
    _, master = stages(spark, base, tmp_path, "parquet")
    rows = spark.range(60).selectExpr(
        "concat('Q', id % 6) AS district_id", "cast(2000 + id AS int) AS year",
        "rand(1) AS avg_price", "rand(2) AS avg_size", "rand(3) AS avg_price_per_sqm",
        "id AS property_count", "id % 7 AS incidence_count", "rand(4) AS avg_income_index",
    )
    rows.write.mode("overwrite").parquet(master)
    arguments = ["train", "--exploitation-path", f"{tmp_path}/exploitation", "--tracking-path"]
    cli.main([*arguments, f"{tmp_path}/tracking", "--model", "income", "--all-null", "zero"], spark)
    assert os.path.isdir(f"{tmp_path}/tracking/runs")
    assert [p for p in shared.rglob("*") if p.is_file()] == []


def test_only_given_years_needs_no_other_flag(spark, base, tmp_path):
    arguments = ["format", "-l", f"{base}/landing", "-k", f"{base}/lookup", "-f", str(tmp_path / "f")]
    for _ in range(2):
        cli.main([*arguments, "--only-given-years"], spark)


if os.path.isdir(SAMPLE):

    def test_sample_data(spark, tmp_path):
        _, master_path = stages(spark, SAMPLE, tmp_path, "parquet")
        master = spark.read.parquet(master_path)
        counts = master.agg(
            F.count("*"), F.count("incidence_count"), F.sum("incidence_count"),
            F.count("avg_income_index"), F.sum("avg_income_index"), F.count("avg_price"),
        ).first()
        assert tuple(counts)[:4] == (151, 80, 462, 100) and counts[5] == 16
        assert counts[4] == pytest.approx(10155.35331168831, rel=1e-12)
        rows = {r["year"]: r for r in master.where("district_id = 'Q753075'").collect()}
        assert rows[2020]["avg_price"] == pytest.approx(316227.9569892473, rel=1e-12)
        assert rows[2021]["property_count"] == 7
        assert (rows[2014]["avg_price"], rows[2014]["property_count"]) == (307592.0, 100)
        incidents = city.INCIDENT_MODEL.required
        assert master.dropna(subset=list(incidents)).count() == 29
        assert master.dropna(subset=list(city.INCOME_MODEL.required)).count() == 3
