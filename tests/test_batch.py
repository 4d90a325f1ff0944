"""Runs that are repeated, fed by a stream of files, or given verified addresses."""

import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from checks.documents import write_landing
from custofold.errors import NoRecords
from custofold.operators import Lookup, best_answers
from custofold.plans import BatchConfig, batch, documents, fold_values, run
from custofold.plans.sections.address import address_requests, address_rows
from custofold.schemas import BATCH, LANDING, LOOKUP, VERIFIED, Tags
from custofold.sources import Store, stage_load, staged_records
from custofold.sources.landing import read_records
from custofold.sources.store import CLEANUP
from custofold.streaming import stage_new_files, staging
from tests.helpers import VALUE_SETS, data_of, record, value_sets


@pytest.fixture
def store(spark, tmp_path):
    made = Store(spark, str(tmp_path / "tables"))
    made.append(spark.createDataFrame(VALUE_SETS, LOOKUP), "value_sets")
    return made


def write_json(folder, name, records, tail=""):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in records) + tail)
    return str(folder)


def people(*ids):
    return [record("individual", CUSTOMER_ID=i, MOBILE_PHONE_NO=f"0{i}", BANK_ID="B", CUSTOMER_OWNED_BY="1") for i in ids]


def customers(df):
    return sorted(r.CUSTOMER_ID for r in df.collect())


# ------------------------------------------------------------------ staging by a stream


def staged(store):
    return sorted(r.CUSTOMER_ID for r in staged_records(store, "stage").collect())


def test_every_file_is_staged_once(spark, store, tmp_path):
    folder, progress = write_json(tmp_path / "in", "1.json", people("1", "2"), "\n{broken\n"), str(tmp_path / "progress")
    assert stage_new_files(store, folder, progress, "stage", Tags()) == {"": 2, "malformed line": 1}
    assert stage_new_files(store, folder, progress, "stage", Tags()) == {}
    write_json(tmp_path / "in", "2.json", people("2", "3"))
    write_json(tmp_path / "in", "3.json", people("4") + [{"x": 1}])
    assert stage_new_files(store, folder, progress, "stage", Tags(), files_per_load=1) == {"": 3, "no tag": 1}
    assert staged(store) == ["1", "2", "2", "3", "4"]


def test_a_load_that_died_before_its_commit_is_staged_once(spark, store, tmp_path, monkeypatch):
    folder, progress = write_json(tmp_path / "in", "1.json", people("1", "2")), str(tmp_path / "progress")
    stage_new_files(store, folder, progress, "stage", Tags())
    write_json(tmp_path / "in", "2.json", people("3") + [record("zzz")])

    def dies(*args, **more):
        stage_load(*args, **more)
        raise RuntimeError("lost after the write")

    monkeypatch.setattr(staging, "stage_load", dies)
    with pytest.raises(Exception, match="lost after the write"):
        stage_new_files(store, folder, progress, "stage", Tags())
    assert staged(store) == ["1", "2", "3"]  # written, but not known to be
    monkeypatch.undo()
    write_json(tmp_path / "in", "3.json", people("4"))
    assert stage_new_files(store, folder, progress, "stage", Tags())[""] == 2
    assert staged(store) == ["1", "2", "3", "4"]
    assert store.read("stage").where("REASON = 'unknown tag'").count() == 1


def test_runs_fed_by_a_stream(spark, store, tmp_path, monkeypatch):
    config = BatchConfig(write_json(tmp_path / "in", "1.json", people("1", "2")), checkpoint=str(tmp_path / "progress"))
    assert customers(run(spark, config, store)) == ["1", "2"]
    with pytest.raises(NoRecords, match="landing batch holds no records"):
        run(spark, config, store)  # nothing new
    write_json(tmp_path / "in", "2.json", people("3"))
    monkeypatch.setattr(batch, "fold_values", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, config, store)
    monkeypatch.undo()
    assert customers(run(spark, config, store)) == ["1", "2", "3"]  # its file is staged, though no longer new
    write_json(tmp_path / "in", "3.json", people("4"))
    assert customers(run(spark, config, store)) == ["1", "2", "3", "4"]


# ------------------------------------------------------------------ runs that die


@pytest.mark.parametrize("shape", ["array", "rows"])
def test_dying_between_documents_and_reset_repeats_nothing(spark, store, tmp_path, monkeypatch, shape):
    def config(name, *ids):
        return BatchConfig(write_json(tmp_path / name, "1.json", people(*ids), "\n{broken\n"), shape=shape)

    run(spark, config("a", "1"), store)
    monkeypatch.setattr(batch, "reset_stage", lambda *_, **__: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        run(spark, config("b", "2", "3"), store)
    assert set(customers(store.read("documents"))) == {"1", "2", "3"}  # they are there, and the stage is still full
    monkeypatch.undo()
    docs = run(spark, config("c", "4"), store)
    each = 1 if shape == "array" else 2
    assert customers(docs) == sorted(["1", "2", "3", "4"] * each)
    assert docs.columns == [c for c in store.read("documents").columns if c != BATCH]
    assert store.read("rejects").groupBy(BATCH).count().collect().__len__() == 2
    assert store.read("rejects").count() == 3  # one a file


def test_dying_inside_the_append_repeats_nothing(spark, store, tmp_path, monkeypatch):
    path = write_json(tmp_path / "a", "1.json", people("1"))
    plain = Store.replace

    def dies(self, df, table, partition_by):
        plain(self, df, table, partition_by)
        if table == "documents":
            raise RuntimeError("lost after the write")

    monkeypatch.setattr(Store, "replace", dies)
    with pytest.raises(RuntimeError):
        run(spark, BatchConfig(path), store)
    monkeypatch.undo()
    assert customers(run(spark, BatchConfig(path), store)) == ["1"]


def test_replace_leaves_other_partitions(spark, store):
    def rows(batch, *ids):
        return spark.createDataFrame([(i, batch) for i in ids], "id int, b int")

    for df in (rows(0, 1, 2), rows(1, 3), rows(1, 4, 5), rows(0, 6)):
        store.replace(df, "t", ["b"])
    assert sorted(map(tuple, store.read("t").select("id", "b").collect())) == [(4, 1), (5, 1), (6, 0)]


# ------------------------------------------------------------------ what lies on the disk meanwhile


def files(folder, table):
    return [f for f in Path(folder).glob(f"{table}*/**/*.parquet")]


def test_landing_files_are_packed_and_bounded(spark, store, tmp_path):
    records = [record("individual", CUSTOMER_ID=str(i), PLACE_OF_BIRTH="a town of some length") for i in range(3000)]
    rows = spark.createDataFrame([tuple(r.get(f) for f in LANDING.names) for r in records], LANDING).coalesce(1)
    write_landing(rows, str(tmp_path / "in"), 1000)
    written = [f for f in (tmp_path / "in").iterdir() if f.name.startswith("part")]
    assert len(written) == 3 and sum(f.stat().st_size for f in written) < 3000 * 20  # some 200 bytes a record as text
    assert stage_load(store, read_records(spark, str(tmp_path / "in")), "stage", Tags(), "x") == {"": 3000}
    assert sorted(staged(store)) == sorted(r["CUSTOMER_ID"] for r in records)
    assert all(f.name.endswith(".zstd.parquet") for f in files(tmp_path / "tables", "stage"))


def test_no_dataset_is_left_when_documents_are_folded(spark, store, tmp_path, monkeypatch):
    records = people("1", "2") + [record("gurn", CUSTOMER_ID="1", GURN="7")]
    left = {}

    def folds(values, *more):
        left.update({n: store.read(f"unique_{n}").count() for n in batch.SHARED} | {"partial": values.count()})
        return fold_values(values, *more)

    monkeypatch.setattr(batch, "fold_values", folds)
    docs = run(spark, BatchConfig(write_json(tmp_path / "in", "1.json", records)), store)
    assert left.pop("partial") > 2 and set(left.values()) == {0}
    assert sorted((r.CUSTOMER_ID, tuple(r.GURN or ())) for r in docs.collect()) == [("1", ("7",)), ("2", ())]


def test_shuffles_of_a_stored_step_are_removed(spark, store, tmp_path):
    def shuffled():  # not those of the few bytes of the table's log
        found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        found = [found.apply(i) for i in range(found.size())]
        return {f.getName() for f in found if f.getName().endswith(".data") and f.length() > 2000}

    rows = spark.range(20_000).selectExpr("id % 7 AS k", "id").repartition(3, "k")
    before = shuffled()
    rows.write.format("noop").mode("overwrite").save()
    assert shuffled() - before  # a write of another kind leaves them
    before |= shuffled()
    store.materialize(rows, "t")
    for _ in range(50):
        if not (kept := shuffled() - before):
            break
        time.sleep(0.1)
    assert not kept and spark.conf.get(CLEANUP, "false") == "false"
    assert store.read("t").count() == 20_000


# ------------------------------------------------------------------ one parse, counts on the way


class Jobs:
    """The plans that run while it is watched."""

    def __init__(self, spark):
        self.spark, self.store = spark, spark._jsparkSession.sharedState().statusStore()

    def __enter__(self):
        self.seen = self.store.executionsCount()
        return self

    def __exit__(self, *_):
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        found = self.store.executionsList()
        plans = [found.apply(i) for i in range(found.size())]
        self.plans = [p.physicalPlanDescription() for p in plans[self.seen :]]


def test_a_run_parses_the_landing_files_once(spark, store, tmp_path):
    folder = write_json(tmp_path / "in", "1.json", people("1", "2") + [record("email", CUSTOMER_ID="1", E_ADDR="a")], "\n{x\n")
    for config in (BatchConfig(folder), BatchConfig(folder, checkpoint=str(tmp_path / "progress"))):
        with Jobs(spark) as jobs:
            run(spark, config, store)
        scans = [p for p in jobs.plans if "Scan json" in p and f"{tmp_path.name}/in" in p]
        assert len(scans) == 1, [p[:300] for p in scans]
        text = "\n".join(jobs.plans)
        # no job only looks whether a table is empty, and none counts one: sizes of lookup and crowded keys are measured
        assert "CollectLimit 1" not in text and "CollectLimit (" not in text
    audit = {(r.status, r.message) for r in store.read("audit").collect()}
    assert {("REJECTED", "malformed line: 1 records"), ("SUCCESS", "PHONE: 2 values"), ("SUCCESS", "EMAIL: 1 values"),
            ("NO_RECORDS", "PASSPORT: 0 values"), ("SUCCESS", "batch stored")} <= audit


def test_counts_of_a_load(spark, store, tmp_path):
    path = write_json(tmp_path / "in", "1.json", people("1") + [record("gurn", SRC_EVT_TYP_FLG=None), record("individual")])
    for _ in range(2):
        counts = stage_load(store, read_records(spark, path), "stage", Tags(), "x", again=True)
        assert counts == {"": 1, "no event flag": 1, "no CUSTOMER_ID": 1}
    assert store.read("stage").count() == 3
    assert staged_records(store, "stage").columns == [*LANDING.names, "CHANGE_KIND"]


# ------------------------------------------------------------------ verified addresses


def answer(spark, key, **fields):
    rows = [tuple({"request_key": key, **fields}.get(n) for n in VERIFIED.names)]
    return spark.createDataFrame(rows, VERIFIED)


def test_best_answers(spark):
    answers = (
        answer(spark, "k", match_code="?", result_percent="100", addressLine1="unmatched")
        .union(answer(spark, "k", match_code="M1", result_percent="90", addressLine1="b"))
        .union(answer(spark, "k", match_code="M2", result_percent="100", addressLine1="c"))
        .union(answer(spark, "k", match_code="M2", result_percent="100", addressLine1="a"))
        .union(answer(spark, "k", match_code="M2", result_percent="none", addressLine1="d"))
        .union(answer(spark, "other", addressLine1="alone"))
        .union(answer(spark, None, addressLine1="nobody's"))
    )
    for df in (answers, answers.orderBy(F.desc("addressLine1"))):
        assert {(r.request_key, r.addressLine1) for r in best_answers(df).collect()} == {("k", "a"), ("other", "alone")}
    assert best_answers(answers).columns == answers.columns
    assert best_answers(answers.limit(0)).count() == 0


PLACES = {
    "individual": [{"CUSTOMER_ID": "1"}, {"CUSTOMER_ID": "2"}],
    "street_address": [
        {"CUSTOMER_ID": "1", "ADDRESS_LINE_1": "one", "POSTCODE": "P"},
        {"CUSTOMER_ID": "2", "ADDRESS_LINE_1": "two", "POSTCODE": "P"},
    ],
    "agreement": [{"CUSTOMER_ID": "1", "CUST_ADDR_STATUS": "C"}, {"CUSTOMER_ID": "2", "CUST_ADDR_STATUS": "C"}],
}


def test_answers_reach_the_documents_once(spark):
    data, table = data_of(spark, **PLACES), value_sets(spark)
    asked = {r.payload.split("AddressLine1>")[1][:3]: r.request_key for r in address_requests(address_rows(data, table)).collect()}
    answers = answer(spark, asked["one"], match_code="M", addressLine1="ONE").union(
        answer(spark, asked["one"], match_code="M", addressLine1="ONE AGAIN")
    )
    docs = documents(data, table, verified=answers).collect()
    assert {(d.CUSTOMER_ID, tuple(a.addressLine1 for a in d.ADDRESS)) for d in docs} == {("1", ("ONE",)), ("2", ("two",))}


def test_answers_reach_the_run(spark, store, tmp_path):
    records = [record(n, **r) for n, rows in PLACES.items() for r in rows]
    data, table = data_of(spark, **PLACES), Lookup.of(store.read("value_sets"))
    keys = [r.request_key for r in address_requests(address_rows(data, table)).collect()]
    for key in keys:
        store.append(answer(spark, key, match_code="M", addressLine1="found"), "answers")
    config = BatchConfig(write_json(tmp_path / "in", "1.json", records), verified="answers")
    docs = run(spark, config, store).collect()
    assert [[a.addressLine1 for a in d.ADDRESS] for d in docs] == [["found"], ["found"]]
