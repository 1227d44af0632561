import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

ORACLE = contract.oracle_sql()
ROWS_ONLY = {"raw_manifest", "cv_scores", "validation_scores", "tracked_runs"}


def test_every_query_is_checked_or_known_to_have_no_sql():
    own = set(contract.queries()) - set(contract.LLM_QUERIES)
    assert own == (set(ORACLE) - set(contract.LLM_ORACLE)) | ROWS_ONLY


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, folder, name):
    df = contract.queries()[name](spark, folder)
    assert differences(df, connect(folder), ORACLE[name]) == []


def test_entry(spark, folder):
    assert contract.entry(spark).count() > 0


def test_raw_manifest_lists_the_files(spark, folder):
    import hashlib
    from pathlib import Path

    rows = contract.queries()["raw_manifest"](spark, folder).collect()
    for row in rows:
        content = Path(folder, row["file_name"]).read_bytes()
        part = content[row["offset"] : row["offset"] + 8 * 1024 * 1024]
        assert hashlib.sha256(part).hexdigest() == row["sha256"]
        assert len(content) == row["length"]
    assert {r["dataset"] for r in rows} == {"lineitem", "orders", "customer"}
