"""Ledger and incremental master table."""

import pytest
from pyspark.sql import functions as F

from yearloom.operators.panel import master_table
from yearloom.plans import increments, zones
from yearloom.sources import landing, ledger, readers
from yearloom.specs import DatasetSpec, FactSpec, Measure, PanelSpec, PeriodSpec

PANEL = PanelSpec(
    facts=(
        FactSpec("sales", (Measure("n_sales", "count"),)),
        FactSpec("prices", (Measure("avg_price", "avg", "price"), Measure("n_prices", "count")), in_spine=False, gap_fill=True),
    ),
)
SCHEMA = zones.master_schema(PANEL)


def spec(name):
    return DatasetSpec(
        name=name, format="csv", glob=f"{name}/*.csv", schema="entity_id string, year int, price double",
        name_column="entity_id", period=PeriodSpec("column", ("year",)), multi_line=False,
    )


@pytest.fixture
def zone(spark, tmp_path):
    class Zone:
        source, base = tmp_path / "source", str(tmp_path / "kept")
        opened = []

        def put(self, dataset, name, rows):
            (self.source / dataset).mkdir(parents=True, exist_ok=True)
            lines = [",".join("" if v is None else str(v) for v in row) for row in rows]
            (self.source / dataset / name).write_text("\n".join(["entity_id,year,price", *lines]) + "\n")

        def take(self, dataset, name):
            (self.source / dataset / name).unlink()

        def globs(self):
            return {d.name: f"{d}/*.csv" for d in sorted(self.source.iterdir()) if any(d.iterdir())}

        def read(self, folder, name):
            self.opened.append(folder)
            rows = readers.read_dataset(spark, spec(name), folder)
            return rows.select("*", F.col("_metadata.file_name").alias(increments.FILE))

        def land(self, globs=None):
            return ledger.land_changes(spark, globs or self.globs(), self.base)

        def update(self):
            return increments.update(spark, self.base, PANEL, self.read, buckets=4096)

        def check(self):
            """Equal to a rebuild from the files that are there."""
            facts = {}
            for f in PANEL.facts:
                try:
                    facts[f.name] = readers.read_dataset(spark, spec(f.name), str(self.source)).cache()
                    facts[f.name].count()
                except Exception:  # noqa: BLE001 - no files
                    facts[f.name] = spark.createDataFrame([], "entity_id string, year int, price double")
            expected = sorted(map(str, master_table(facts, PANEL).collect()))
            found = sorted(map(str, increments.master(spark, self.base, PANEL, SCHEMA).collect()))
            for f in facts.values():
                f.unpersist()
            assert found == expected
            return len(found)

    return Zone()


def test_files_are_landed_replaced_and_withdrawn(zone, spark):
    zone.put("sales", "a.csv", [("x", 2001, 1), ("x", 2001, 2), ("y", 2002, 3)])
    zone.put("sales", "b.csv", [("z", 2001, 1)])
    zone.put("prices", "p.csv", [("x", 2001, 10), ("x", 2000, 20), ("y", 1999, 7)])
    assert zone.land() == 1 and len(zone.update()) == 3
    assert zone.check() == 3
    # Nothing new: no run, no bucket, no file is opened.
    opened = len(zone.opened)
    assert zone.land() is None and zone.update() == [] and len(zone.opened) == opened

    # A new file touches the buckets of its entities only, and reads no other file.
    zone.put("sales", "c.csv", [("w", 2003, None), ("z", 2001, 5)])
    assert zone.land() == 2
    assert len(zone.update()) == 2 and zone.opened[opened:] == [ledger.run_folder(zone.base, 2)]
    assert zone.check() == 4

    # A file with other rows takes its old ones along, also those of entities that it no longer has.
    zone.put("sales", "a.csv", [("y", 2002, 3), ("y", 2003, 4)])
    assert zone.land() == 3 and len(zone.update()) == 2
    assert zone.check() == 4

    # Withdrawn files: one entity loses all rows; another fact changes what fills gaps.
    zone.take("sales", "b.csv")
    zone.put("prices", "q.csv", [("w", 2003, 100), ("y", 2003, 9)])
    assert zone.land() == 4
    zone.update()
    assert zone.check() == 4
    events = ledger.events(spark, zone.base).orderBy("run", "file_name").collect()
    assert [(r["run"], r["file_name"], r["event"]) for r in events] == [
        (1, "a.csv", "landed"), (1, "b.csv", "landed"), (1, "p.csv", "landed"), (2, "c.csv", "landed"),
        (3, "a.csv", "landed"), (4, "b.csv", "withdrawn"), (4, "q.csv", "landed"),
    ]
    assert all(r["modification_time"] is not None for r in events)


def test_a_run_that_breaks_off_is_done_again(zone, monkeypatch, spark):
    zone.put("sales", "a.csv", [("x", 2001, 1)])
    zone.put("prices", "p.csv", [("x", 2001, 10)])
    whole = landing.restore_files

    def broken(ranges, target):
        whole(ranges, target).count()  # files are there, the ledger is not
        raise OSError("lost")

    monkeypatch.setattr(landing, "restore_files", broken)
    with pytest.raises(OSError):
        zone.land()
    monkeypatch.undo()
    assert ledger.events(spark, zone.base).count() == 0
    zone.put("sales", "a.csv", [("x", 2001, 1), ("y", 2001, 2)])
    assert zone.land() == 1

    # The same between the states and the master table.
    def fails(*args, **options):
        raise OSError("lost")

    monkeypatch.setattr(increments, "master_of_states", fails)
    with pytest.raises(OSError):
        zone.update()
    monkeypatch.undo()
    zone.put("sales", "b.csv", [("z", 2001, 2)])
    assert zone.land() == 2 and len(zone.update()) == 3  # both runs at once
    assert zone.check() == 3


def test_all_files_of_a_bucket_go(zone):
    zone.put("sales", "a.csv", [("x", 2001, 1)])
    zone.put("sales", "b.csv", [("y", 2001, 1)])
    zone.put("prices", "p.csv", [("x", 2001, 10)])
    zone.land()
    zone.update()
    zone.take("sales", "a.csv")
    zone.land()
    assert len(zone.update()) == 1
    assert zone.check() == 1
