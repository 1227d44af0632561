import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tests.llm.conftest import MESSY
from yearloom.llm import catalog

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """The documents before the first stage and after each one."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        found.append(docs)
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return [*found, docs]


def ids(df):
    return {r["doc_id"] for r in df.select("doc_id").collect()}


def test_stages_keep_the_columns_of_documents(steps):
    for df in steps[:-1]:
        assert df.dtypes == steps[0].dtypes
    assert steps[-1].columns[: len(steps[0].columns)] == steps[0].columns


def test_quality_keeps_good_documents(spark, folder, steps):
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    left = ids(steps[1])
    good = [r["doc_id"] in left for r in labels if r["quality"] == 1]
    bad = [r["doc_id"] in left for r in labels if r["quality"] == 0]
    assert sum(good) >= 0.97 * len(good) and sum(bad) <= 0.5 * len(bad)


def test_copies_lose_their_text_and_go(steps):
    seen, copies = set(), set()
    for row in steps[1].orderBy("doc_id").collect():
        (copies if row["text"] in seen and len(row["text"].split()) >= 50 else set()).add(row["doc_id"])
        seen.add(row["text"])
    assert copies and not copies & ids(steps[2])
    assert all(r["n_chars"] == len(r["text"]) for r in steps[2].collect())


def test_one_document_of_each_group_stays(steps):
    from tests.llm.test_near_copies import brute

    rows = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    assert ids(steps[3]) == {int(i) for i, _, _, kept in brute(rows, 5) if kept}


def test_no_benchmark_window_is_left(spark, folder, steps):
    from tests.llm.test_decontaminate import expected

    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r["doc_id"] for r in steps[3].collect() if expected(r["text"], items)[1] == 0}
    assert ids(steps[4]) == clean and clean != ids(steps[3])


def test_ids_decode_to_the_text(steps):
    for row in steps[5].collect():
        assert row["decoded"].replace("</w>", "").count(" ") == len(row["ids"]) - 1


def test_registered_query_runs_all_stages(spark, folder, steps):
    found = contract.queries()["pipeline"](spark, folder)
    assert ids(found) == ids(steps[5]) and found.columns == steps[5].columns


@pytest.mark.parametrize("rows", [[], [(i, t, None, None, None) for i, t in MESSY]])
def test_messy_and_empty_tables(spark, folder, rows):
    docs = spark.createDataFrame(rows, COLUMNS).selectExpr("*", "'x' AS id", "'y' AS score")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(stage(spark, docs, folder).collect(), stage(spark, docs, folder).schema)
        assert {"id", "score"} <= set(docs.columns)
    assert docs.count() <= len(rows)


def test_every_operator_has_its_query():
    names = [name for name in catalog.QUERIES if name.startswith("op")]
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
