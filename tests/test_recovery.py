"""Runs that are stopped, or meet errors, at any step."""

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tidemark.contracts import registry_frame
from tidemark.plans import api, execute
from tidemark.sources import landing
from tidemark.sources import standins as S

NOW, LATER = "2024-06-01 00:00:00", "2024-06-01 05:00:00"


class Stop(BaseException):
    pass


def stop_at(step):
    def told(name):
        if name == step:
            raise Stop(name)
    return told


def store_of(spark, folder):
    store = api.LogStore(spark, f"{folder}/logs")
    at = F.lit(NOW).cast("timestamp_ntz")
    store.write("ingestion_checkpoints", S.checkpoint_seed(spark).withColumns(
        {"last_successful_run_id": F.lit(None).cast("string"), "updated_at": at}), seq=0, changed_at=at)
    return store


def call(store, folder, run_id, seq, now=NOW, **more):
    spark = store.spark
    return execute.run(store, S.source_records(spark, SF_SMALL), registry_frame(spark, S.source_contracts()), run_id=run_id,
                       root=folder, to_json=S.raw_json, now=now, seq=seq, native_time="o_orderdate", **more)


def state(store, folder, runs):
    """What a run leaves: marks, batch rows, run rows, landed rows."""
    cps = sorted(tuple(r) for r in store.read("ingestion_checkpoints").select("table_name", "current_watermark", "last_id").collect())
    logs = sorted(tuple(r) for r in store.read("batch_logs").where("status = 'SUCCESS'").select("table_name", "cursor_value",
                                                                                              "records_count").collect())
    landed = execute.landed_runs(store.spark, folder, runs)
    return cps, logs, sorted(tuple(r) for r in landed.select("table_name", "id", "updated_at").collect())


def statuses(store, name="ingestion_runs"):
    return {r[0]: r.status for r in store.read(name).collect()}


@pytest.fixture(scope="module")
def unbroken(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("run-whole"))
    store, steps = store_of(spark, folder), []
    assert call(store, folder, "a", 1, on_step=steps.append) == ("incremental", "COMPLETED")
    return state(store, folder, ["a"]), steps


def test_steps_are_stored_in_order(unbroken):
    tables = sorted(S.SOURCE_TABLES)
    assert unbroken[1] == ["opened", "staged", *[f"{k} {t}" for t in tables for k in ("landed", "committed")], "logged", "moved"]


@pytest.mark.parametrize("step", ["landed 1-URGENT", "committed 5-LOW", "logged"])
def test_called_again_after_a_stop(spark, scratch, unbroken, step):
    store = store_of(spark, scratch)
    with pytest.raises(Stop):
        call(store, scratch, "a", 1, on_step=stop_at(step))
    assert statuses(store) == {"a": "RUNNING"}
    assert call(store, scratch, "a", 2, LATER) == ("incremental", "COMPLETED")
    assert state(store, scratch, ["a"]) == unbroken[0] and statuses(store) == {"a": "COMPLETED"}


@pytest.mark.parametrize("step", ["landed 3-MEDIUM"])
def test_recovered_by_another_run(spark, scratch, unbroken, step):
    store = store_of(spark, scratch)
    with pytest.raises(Stop):
        call(store, scratch, "a", 1, on_step=stop_at(step))
    assert call(store, scratch, "b", 2, LATER) == ("incremental", "COMPLETED")
    assert statuses(store) == {"a": "FAILED", "b": "COMPLETED"}
    cps, _, landed = state(store, scratch, ["a", "b"])
    assert cps == unbroken[0][0] and set(landed) == set(unbroken[0][2])


def test_errors_leave_no_open_run(spark, scratch, monkeypatch, unbroken):
    """Whatever fails, the run is closed, and called again it completes."""
    def fails(*args, **kwargs):
        raise RuntimeError("disk gone")

    real = api.LogStore.insert

    def no_batches(self, name, *args, **kwargs):
        return fails() if name == "batch_logs" else real(self, name, *args, **kwargs)

    broken = [(execute.select, "incremental_select", fails), (landing, "landed_keys", fails), (api.LogStore, "insert", no_batches)]
    for n, (where, name, how) in enumerate(broken):
        folder = f"{scratch}/{n}"
        store = store_of(spark, folder)
        with monkeypatch.context() as m:
            m.setattr(where, name, how)
            assert call(store, folder, "a", 1) == ("incremental", "FAILED"), name
        row = store.read("ingestion_runs").collect()[0]
        assert row.status == "FAILED" and "disk gone" in row.error_message
        assert call(store, folder, "a", 2, LATER) == ("incremental", "COMPLETED"), name
        assert state(store, folder, ["a"]) == unbroken[0], name


def test_replay_stops_and_errors(spark, scratch, monkeypatch):
    def begun(folder):
        store = store_of(spark, folder)
        store.insert("fallback_events", S.replay_windows(spark, SF_SMALL), seq=0, changed_at=F.lit(NOW).cast("timestamp_ntz"))
        return store

    def events(store):
        return sorted((r.event_id, r.status, r.records_processed) for r in store.read("fallback_events").collect())

    steps = []
    store = begun(f"{scratch}/whole")
    assert call(store, f"{scratch}/whole", "a", 1, on_step=steps.append) == ("replay", "COMPLETED")
    want = events(store)
    assert steps == ["opened", "chosen", "claimed", "landed", "changed", "logged"]
    for step in ("claimed", "landed"):
        store = begun(f"{scratch}/{step}")
        with pytest.raises(Stop):
            call(store, f"{scratch}/{step}", "a", 1, on_step=stop_at(step))
        assert "IN_PROGRESS" in {s for _, s, _ in events(store)}
        # The claimed run is called again, the landed one is left to another run.
        next_id = "a" if step == "claimed" else "b"
        assert call(store, f"{scratch}/{step}", next_id, 3, LATER) == ("replay", "COMPLETED")
        assert events(store) == want
        assert statuses(store) == ({"a": "COMPLETED"} if next_id == "a" else {"a": "FAILED", "b": "COMPLETED"})
    store = begun(f"{scratch}/bad")
    with monkeypatch.context() as m:
        m.setattr(execute.select, "replay_select", lambda *a: 1 / 0)
        assert call(store, f"{scratch}/bad", "a", 1) == ("replay", "FAILED")
    assert {s for _, s, _ in events(store)} == {"FAILED", "PENDING"}


def test_a_table_whose_source_fails(spark, scratch, unbroken):
    """The scan for all tables fails: each is read by itself, the others land."""
    source = S.source_records(spark, SF_SMALL)
    bad = F.when(F.col("table_name") == "3-MEDIUM", F.raise_error(F.lit("source gone")).cast("long")).otherwise(F.col("id"))
    store = store_of(spark, scratch)
    reg = registry_frame(spark, S.source_contracts())
    args = dict(root=scratch, to_json=S.raw_json, native_time="o_orderdate")
    assert execute.run(store, source.withColumn("id", bad), reg, run_id="a", now=NOW, seq=1, **args) == ("incremental", "FAILED")
    found = {r.table_name: r.status for r in store.read("batch_logs").collect()}
    assert found == {t: "FAILED" if t == "3-MEDIUM" else "SUCCESS" for t in S.SOURCE_TABLES}
    assert execute.run(store, source, reg, run_id="a", now=LATER, seq=2, **args) == ("incremental", "COMPLETED")
    assert state(store, scratch, ["a"]) == unbroken[0]
