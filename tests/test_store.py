"""The store: whole batches, counted rejects, runs and their status, and the commands over it."""

import json
from dataclasses import dataclass

import pytest
from pyspark.sql import functions as F

from ledgermill import __main__ as commands
from ledgermill.plans import store as stores
from ledgermill.sources import config, registry

GOOD = {"source_url": "https://example.com/1", "company": "A", "title": "T", "description": "D", "source_job_id": "1"}


def lines(path, *rows):
    path.write_text("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def counts(store):
    return {r["table"]: r["rows"] for r in store.stats().collect()}


def test_runs_replay_and_failures(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "store"))
    assert store.log().count() == 0 and not store.exists() and store.runs().count() == 0  # a missing store is empty
    with pytest.raises(FileNotFoundError):
        stores.export_store(spark, store.path, str(tmp_path / "x.json"))
    good = lines(tmp_path / "a.jsonl", GOOD, "", GOOD | {"source_job_id": "2"}, GOOD)
    assert stores.run_import(spark, "jsonl", store.path, path=good, query="q").processed == 3
    assert counts(store) == {"unique_jobs": 2, "snapshots": 2, "search_runs": 1, "search_hits": 2}
    stores.run_import(spark, "jsonl", store.path, path=good)
    assert counts(store) == {"unique_jobs": 2, "snapshots": 2, "search_runs": 2, "search_hits": 4}
    bad = lines(tmp_path / "b.jsonl", GOOD | {"source_job_id": "3"}, "[secret]", GOOD | {"source_job_id": "4"})
    with pytest.raises(ValueError, match="line 2") as told:
        stores.run_import(spark, "jsonl", store.path, path=bad)
    assert "secret" not in str(told.value) and counts(store)["unique_jobs"] == 3
    runs = {r["run_id"]: r for r in store.runs().collect()}
    assert sorted(r["status"] for r in runs.values()) == ["failed", "finished", "finished"] and {r["query"] for r in runs.values()} == {"q", None}
    n = stores.export_store(spark, store.path, str(tmp_path / "out.json"), complete_only=True)
    assert n == 3 and [r["job_id"] for r in json.loads((tmp_path / "out.json").read_text())] is not None
    with pytest.raises(ValueError):
        stores.export_store(spark, store.path, store.path)


def test_batches_are_whole_and_rejects_counted(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "store"))
    rows = [GOOD | {"source": "x"}, GOOD | {"source": "y"}, {"source": "x", "source_job_id": None, "source_url": None}]
    batch = registry.records_of(spark, rows).withColumn("run_id", F.lit("r"))
    assert store.append(batch, "1", "x") == stores.Counts(1, 2, 1, 1)
    assert sorted(r["reason"] for r in store.rejects().collect()) == ["another source", "no valid identity"]
    failing = batch.withColumn("title", F.raise_error(F.lit("broken")))
    with pytest.raises(Exception, match="broken"):
        store.append(failing, "2", "x")
    assert store.log().count() == 1  # nothing of the failed batch is seen
    store.append(batch, "1", "x")
    assert store.log().count() == 1  # a batch that is run again replaces itself
    with store.writing(0), pytest.raises(TimeoutError):
        with store.writing(0.2):
            pass
    with store.writing(0):  # given back
        pass


def test_record_kinds(spark):
    @dataclass
    class Item:
        source: str
        title: str

    class Dumped:
        def model_dump(self):
            return {"source": "s", "n": 5, "tags": ["a"], "ok": True}

    rows = registry.records_of(spark, [{"source": "a"}, Item("b", "t"), Dumped(), [("source", "p")]]).orderBy("seq").collect()
    assert [r["source"] for r in rows] == ["a", "b", "s", "p"] and (rows[2]["n"], rows[2]["tags"], rows[2]["ok"]) == ("5", '["a"]', "true")
    with pytest.raises(TypeError):
        registry.records_of(spark, [5])


def test_sources_own_their_records(spark):
    registry.register(registry.Source("impostor", "says it is another", lambda s, **o: s.createDataFrame([("demo",)], "source string")))
    try:
        with pytest.raises(ValueError, match="another source"):
            registry.load(spark, "impostor")
    finally:
        del registry._sources["impostor"]


def test_settings_and_paths(tmp_path, monkeypatch):
    assert config.setting("store", environ={}) == "data/listings" and config.setting("store", environ={"LEDGERMILL_STORE": "e"}, configured="c") == "e"
    assert config.setting("store", "g", "c", {"LEDGERMILL_STORE": "e"}) == "g" and config.setting("store", None, "c", {}) == "c"
    o = config.run_options({"keywords": "k", "query": "", "limit": 3, "max_results": 5, "profile_id": "p"})
    assert (o["source"], o["query"], o["requested_limit"], o["search_profile_id"], o["location"]) == ("other", "k", 5, "p", None)
    (tmp_path / "config").mkdir()
    (tmp_path / "pyproject.toml").write_text("")
    assert config.resolved_path("/a/b") == config.resolved_path("/a/b", "/c/d.yaml") and str(config.resolved_path("/a/b")) == "/a/b"
    assert config.resolved_path("d", str(tmp_path / "config/c.yaml")) == tmp_path / "d" and config.resolved_path("d", str(tmp_path / "x.yaml")) == tmp_path / "d"
    monkeypatch.chdir(tmp_path)
    assert config.resolved_path("d") == tmp_path / "d"
    for bad in ("browser: {wait_timeout: 1}", "browser: {scroll_pause_min: 5, scroll_pause_max: 4}", "browser: {nope: 1}"):
        (tmp_path / "c.yaml").write_text(bad)
        with pytest.raises(ValueError):
            config.load(str(tmp_path / "c.yaml"))


def test_commands(spark, tmp_path, monkeypatch, capsys):
    monkeypatch.setattr(commands, "session", lambda: spark)
    where = str(tmp_path / "demo")
    assert commands.main(["list-sources"]) == 0 and "jsonl" in capsys.readouterr().out
    assert commands.main(["stats", "--store", where]) == 0 and "No store yet" in capsys.readouterr().out
    assert commands.main(["demo", "--store", where, "--output", str(tmp_path / "demo.json")]) == 0 and "Processed: 4 records; exported: 3" in capsys.readouterr().out
    assert commands.main(["stats", "--store", where]) == 0 and "unique_jobs      3" in capsys.readouterr().out
    assert commands.main(["export", "--store", where, "--output", str(tmp_path / "x.csv"), "--format", "csv", "--limit", "2"]) == 0 and "Exported 2" in capsys.readouterr().out
    assert commands.main(["import", "--store", where]) == 1 and "needs an input" in capsys.readouterr().err
    assert commands.main(["demo", "--store", where, "--output", where]) == 1
