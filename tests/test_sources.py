import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from custofold.__main__ import main
from custofold.errors import NoRecords
from custofold.operators import reconcile_all
from custofold.plans import BatchConfig, run
from custofold.schemas import DATASETS, LANDING, LOOKUP, TAG, Tags
from custofold.sources import (
    Store,
    audit_append,
    conform,
    empty_dataset,
    publish,
    publish_payload,
    read_landing,
    reset_stage,
    split_all,
    stage_batch,
)
from tests.helpers import VALUE_SETS, landing, record


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "tables"))


def write_json(path, records, extra=""):
    path.write_text("\n".join(json.dumps(r) for r in records) + extra)
    return str(path)


# ------------------------------------------------------------------ store


def test_store_versions(spark, store):
    assert not store.exists("t")
    with pytest.raises(LookupError):
        store.read("t")
    store.append(spark.range(3), "t")
    store.append(spark.range(3, 5), "t")
    before = store.read("t")
    store.overwrite(store.read("t").where("id > 1"), "t")  # reads the table it replaces
    assert sorted(r.id for r in store.read("t").collect()) == [2, 3, 4]
    assert before.count() == 5  # a reader keeps its version
    store.append(spark.range(1), "t")
    assert store.read("t").count() == 4 and store.version("t") == 1
    store.expire("t")
    assert spark.read.parquet(store._folder("t", 0)).count() == 0 and store.read("t").count() == 4
    store.clear("t", store.read("t").schema)
    assert store.read("t").columns == ["id"] and store.read("t").count() == 0


def test_partitions_of_a_failed_attempt_do_not_survive(spark, store):
    spark.range(1).select("id", F.lit("stale").alias("p")).write.partitionBy("p").parquet(store._folder("t", 0))
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        store.overwrite(spark.range(2).select("id", F.lit("new").alias("p")), "t", ["p"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert {r.p for r in store.read("t").collect()} == {"new"}


def test_expiring_a_version_without_files(spark, store):
    schema = spark.createDataFrame([], "id long, p string").schema
    store.clear("t", schema, ["p"])
    store.overwrite(spark.createDataFrame([(1, "a")], schema), "t", ["p"])
    store.expire("t")
    assert store.read("t").count() == 1


def test_every_old_version_is_freed_once(spark, store):
    for n in range(5):
        store.overwrite(spark.range(n + 1), "t")
    store.expire("t")
    assert [spark.read.schema("id long").parquet(store._folder("t", v)).count() for v in range(5)] == [0, 0, 0, 0, 5]
    store.overwrite(spark.range(9), "t")
    store.expire("t")
    assert store.read("t").count() == 9 and store.version("t") == 5


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json"])
def test_materialized_frames_keep_their_schema(spark, tmp_path, fmt):
    kept = Store(spark, str(tmp_path / fmt), fmt)
    df = spark.createDataFrame([(1, None), (2, None)], "a long, b string")
    assert kept.materialize(df, "t").schema == df.schema
    assert kept.materialize(df.where("a > 5"), "t").columns == ["a", "b"]


def test_tags_are_checked():
    with pytest.raises(ValueError, match="unknown"):
        Tags({**Tags().values, "indvidual": "X"})
    with pytest.raises(ValueError, match="same tag"):
        Tags({**Tags().values, "gurn": "email"})


def test_failed_overwrite_changes_nothing(spark, store):
    store.append(spark.range(3), "t")
    with pytest.raises(Exception, match="boom"):
        store.overwrite(spark.range(3).select(F.raise_error(F.lit("boom")).cast("long").alias("id")), "t")
    assert store.read("t").count() == 3


def test_other_formats_pass_through(spark, tmp_path):
    # "noop" stands for any connector: options and table name go to it unchanged.
    Store(spark, fmt="noop", options={"uri": "x"}).append(spark.range(1), "c")
    Store(spark, fmt="noop").overwrite(spark.range(1), "c")
    orc = Store(spark, str(tmp_path), "orc")
    assert orc.materialize(spark.range(4), "t").count() == 4


def test_publish(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert [r.value for r in publish_payload(df).collect()] == ['{"a":1}', '{"a":2,"b":"x"}']
    publish(df, "topic", {"path": str(tmp_path / "out")}, fmt="text")
    assert {r.value for r in spark.read.text(str(tmp_path / "out")).collect()} == {'{"a":1}', '{"a":2,"b":"x"}'}


def test_audit(store):
    audit_append(store, "audit", "f.json", "customer", [("OK", "m1"), ("BAD", "m2")], dt.date(2024, 1, 1))
    audit_append(store, "audit", "f.json", "customer", [("OK", "m3")])
    rows = store.read("audit").collect()
    assert {r.message for r in rows} == {"m1", "m2", "m3"}
    assert ("f.json", "OK", dt.date(2024, 1, 1), "customer", "m1") in {tuple(r) for r in rows}


# ------------------------------------------------------------------ landing and stage


def test_landing_reads_text_and_drops_broken_lines(spark, tmp_path):
    path = write_json(tmp_path / "in.json", [record("individual", CUSTOMER_ID=7), {"CUSTOMER_ID": "no tag"}], "\n{broken\n")
    (row,) = read_landing(spark, path).collect()
    assert row.CUSTOMER_ID == "7" and row.GURN is None


def test_conform_and_empty(spark):
    df = conform(spark.createDataFrame([(1, "x")], "CUSTOMER_ID int, other string"), DATASETS["gurn"].schema)
    assert df.first().asDict() == {"GURN": None, "CUSTOMER_ID": "1", "SRC_SYS_INST_ID": None, "SRC_SYS_ID": None}
    assert set(dict(df.dtypes).values()) == {"string"}
    empty = empty_dataset(spark, "email")
    assert empty.columns == list(DATASETS["email"].columns) and empty.isEmpty()


def test_split(spark):
    df = landing(spark, [record("individual", CUSTOMER_ID="1"), record("individual"), record("gurn", GURN="g"), record("zzz")])
    data = split_all(df, Tags())
    assert data["individual"].first().CUSTOMER_TITLE == "" and data["individual"].count() == 1
    assert data["gurn"].first().GURN == "g" and data["email"].isEmpty()
    assert all(data[n].columns == list(d.columns) for n, d in DATASETS.items())


def test_reconcile_cases(spark, store):
    def person(i, flag, ts, name=""):
        return record("individual", CUSTOMER_ID=i, SRC_EVT_TYP_FLG=flag, SRC_EXTRACT_TS=ts, CUSTOMER_SURNAME=name)

    records = [
        person("in only", "IN", "2020-01-01T00:00:00"), person("in only", "IN", "2020-01-01T00:00:00"),
        person("one up", "UP", "2020-01-01T00:00:00"),
        person("in+2", "IN", "2020-01-01T00:00:00"), person("in+2", "UP", "2020-01-02T00:00:00"), person("in+2", "DL", "2020-01-03T00:00:00"),
        person("two up", "UP", "2020-01-02T00:00:00"), person("two up", "UP", "2020-01-01T00:00:00"),
        person("tie", "UP", "2020-01-01T00:00:00", "b"), person("tie", "UP", "2020-01-01T00:00:00", "a"),
        person("bad time", "UP", "zzz", "bad"), person("bad time", "UP", "2020-01-01T00:00:00", "good"),
        person("no flag", None, "2020-01-01T00:00:00"),
        record("relationship", CUSTOMER_ID_1="1", CUSTOMER_ID_2="2", REL_TYPE="SB", SRC_EVT_TYP_FLG="UP", DATE_CREATED="1"),
        record("relationship", CUSTOMER_ID_1="1", CUSTOMER_ID_2="2", REL_TYPE="SB", SRC_EVT_TYP_FLG="UP",
               SRC_EXTRACT_TS="2021-01-01T00:00:00", DATE_CREATED="2"),
        record("relationship", CUSTOMER_ID_1="1", CUSTOMER_ID_2="3", REL_TYPE="SB", SRC_EVT_TYP_FLG="DL", DATE_CREATED="3"),
    ]
    expected = sorted([
        ("in only", "IN", ""), ("one up", "UP", ""), ("in+2", "IN", ""), ("in+2", "DL", ""), ("two up", "UP", ""),
        ("tie", "UP", "a"), ("bad time", "UP", "good")])
    batch = landing(spark, records)
    for source in (batch, batch.repartition(7), stage_batch(store, batch, "stage")):
        data = reconcile_all(source, Tags())
        assert sorted((r.CUSTOMER_ID, r.SRC_EVT_TYP_FLG, r.CUSTOMER_SURNAME) for r in data["individual"].collect()) == expected
        assert {r.SRC_EXTRACT_TS for r in data["individual"].where("CUSTOMER_ID = 'two up'").collect()} == {"2020-01-02T00:00:00"}
        assert sorted(r.DATE_CREATED for r in data["relationship"].collect()) == ["2", "3"]


def test_stage_keeps_a_backlog_once(spark, store):
    first, second = [record("gurn", GURN="1"), {"GURN": "untagged"}], [record("gurn", GURN="2", SRC_EVT_TYP_FLG=None)]
    assert stage_batch(store, landing(spark, first), "s").count() == 1
    staged = stage_batch(store, landing(spark, second), "s")
    assert sorted(r.GURN for r in staged.collect()) == ["1", "2"]
    reset_stage(store, "s")
    assert [r.GURN for r in stage_batch(store, landing(spark, second), "s").collect()] == ["2"]
    assert stage_batch(store, landing(spark, [record("7", GURN="3")]), "s").where(F.col(TAG) == "7").count() == 1


# ------------------------------------------------------------------ whole runs


def people(*ids):
    return [record("individual", CUSTOMER_ID=i, MOBILE_PHONE_NO=f"0{i}", BANK_ID="B", CUSTOMER_OWNED_BY="1") for i in ids]


def test_run_twice(spark, store, tmp_path):
    store.append(spark.createDataFrame(VALUE_SETS, LOOKUP), "value_sets")
    one = write_json(tmp_path / "1.json", people("1", "2") + [record("email", CUSTOMER_ID="1", E_ADDR="a")])
    docs = run(spark, BatchConfig(one), store)
    assert {(r.CUSTOMER_ID, len(r.PHONE), len(r.EMAIL or [])) for r in docs.collect()} == {("1", 1, 1), ("2", 1, 0)}
    two = write_json(tmp_path / "2.json", people("3"))
    assert {r.CUSTOMER_ID for r in run(spark, BatchConfig(two), store).collect()} == {"1", "2", "3"}
    audit = {(r.status, r.message.split(":")[0]) for r in store.read("audit").collect()}
    assert {("INITIATED", "batch started"), ("SUCCESS", "PHONE"), ("SUCCESS", "EMAIL"), ("NO_RECORDS", "EMAIL"),
            ("NO_RECORDS", "PASSPORT"), ("SUCCESS", "batch stored")} <= audit


def test_records_that_cannot_be_used_are_kept(spark, store, tmp_path):
    store.append(spark.createDataFrame(VALUE_SETS, LOOKUP), "value_sets")
    odd = [{"x": 1}, record("nobody's"), record("gurn", SRC_EVT_TYP_FLG=None), record("individual", CUSTOMER_TITLE="Dr")]
    path = write_json(tmp_path / "1.json", people("1") + odd, "\n{broken\n")
    assert run(spark, BatchConfig(path), store).count() == 1
    kept = {r.REASON: r.RECORD for r in store.read("rejects").collect()}
    assert kept.keys() == {"no tag", "unknown tag", "no event flag", "no CUSTOMER_ID", "malformed line"}
    assert kept["malformed line"] == "{broken" and json.loads(kept["no CUSTOMER_ID"])["CUSTOMER_TITLE"] == "Dr"
    assert [r.message for r in store.read("audit").where("status = 'REJECTED'").collect()].count("no tag: 1 records") == 1


@pytest.mark.parametrize("fmt", ["orc", "json"])
def test_whole_run_with_other_formats(spark, tmp_path, fmt):
    kept = Store(spark, str(tmp_path / fmt), fmt)
    kept.append(spark.createDataFrame(VALUE_SETS, LOOKUP), "value_sets")
    docs = run(spark, BatchConfig(write_json(tmp_path / "1.json", people("1", "2"))), kept)
    assert {(r.CUSTOMER_ID, len(r.PHONE), r.GURN, r.ADDRESS) for r in docs.collect()} == {("1", 1, None, None), ("2", 1, None, None)}


def test_an_error_without_text_is_noted(spark, store, tmp_path, monkeypatch):
    def broken(*_):
        raise RuntimeError

    monkeypatch.setattr("custofold.plans.batch.read_records", broken)
    with pytest.raises(RuntimeError):
        run(spark, BatchConfig("nowhere"), store)
    assert "RuntimeError()" in {r.message for r in store.read("audit").collect()}


def test_command_line(spark, store, tmp_path):
    store.append(spark.createDataFrame(VALUE_SETS, LOOKUP), "codes")
    path = write_json(tmp_path / "1.json", [{**r, TAG: "P"} for r in people("1")])
    main([path, "--base", store.base, "--lookup", "codes", "--target", "out", "--tag", "individual=P"])
    assert [r.CUSTOMER_ID for r in store.read("out").collect()] == ["1"]


def test_failed_run_leaves_the_batch_staged(spark, store, tmp_path):
    one = write_json(tmp_path / "1.json", people("1"))
    with pytest.raises(LookupError):
        run(spark, BatchConfig(one), store)  # no value sets yet
    assert not store.exists("documents")
    store.append(spark.createDataFrame([], LOOKUP), "value_sets")
    with pytest.raises(NoRecords):
        run(spark, BatchConfig(write_json(tmp_path / "2.json", people("2"))), store)
    assert {"ABORT", "ERROR"} <= {r.status for r in store.read("audit").collect()}
    store.overwrite(spark.createDataFrame(VALUE_SETS, LOOKUP), "value_sets")
    docs = run(spark, BatchConfig(write_json(tmp_path / "3.json", people("3"))), store)
    assert {r.CUSTOMER_ID for r in docs.collect()} == {"1", "2", "3"}


def test_empty_batches_abort(spark, store, tmp_path):
    with pytest.raises(NoRecords):
        run(spark, BatchConfig(write_json(tmp_path / "0.json", [{"x": 1}])), store)
    with pytest.raises(NoRecords):
        run(spark, BatchConfig(write_json(tmp_path / "1.json", [record("gurn", GURN="g")])), store)


def test_run_in_rows_with_own_tags(spark, store, tmp_path):
    store.append(spark.createDataFrame(VALUE_SETS, LOOKUP), "value_sets")
    tags = Tags({n: f"FEED.{n.upper()}" for n in DATASETS})
    path = write_json(tmp_path / "1.json", [{**r, TAG: "FEED.INDIVIDUAL"} for r in people("1")])
    docs = run(spark, BatchConfig(path, tags=tags, shape="rows"), store)
    assert docs.count() == 2 and dict(docs.dtypes)["CLASS"].startswith("struct")  # two classes
    with pytest.raises(ValueError):
        Tags({"individual": "x"})
    assert LANDING.names[0] == TAG
