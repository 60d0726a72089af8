"""The store under several writers: leases, fences, pinned readers, exactly-once streams, folds that go on."""

import threading
import time

import pytest
from pyspark.sql import functions as F

from ledgermill.operators import folds, history
from ledgermill.plans import export, store as stores, versions
from ledgermill.sources import registry
from ledgermill.streaming import ingest


def listing(i, **more):
    return {"source": "x", "source_job_id": str(i), "source_url": f"https://example.com/{i}", "company": "A", "title": f"T{i}", "description": "D", "capture_status": "complete", "captured_at": f"2024-01-{i % 28 + 1:02d}T00:00:00Z"} | more


def batch(spark, *rows, run="r"):
    return registry.records_of(spark, list(rows)).withColumn("run_id", F.lit(run))


def test_a_file_is_made_once(spark, tmp_path):
    folder, made = versions.Folder(spark, str(tmp_path / "f")), []
    threads = [threading.Thread(target=lambda i=i: made.append((folder.create("a", f"text {i}"), i))) for i in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    won = [i for ok, i in made if ok]
    assert len(won) == 1 and folder.read("a") == f"text {won[0]}" and folder.names() == ["a"] and len(made) == 8


def test_a_dead_writers_lease_runs_out(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "s"))
    dead = versions.Lease(spark, store.path, seconds=1.5, beat=False)
    dead.take(0)  # and is never heard of again
    with pytest.raises(TimeoutError):
        with store.writing(0.2):
            pass
    began = time.monotonic()
    with store.writing(20):
        assert time.monotonic() - began < 10
        assert store.append(batch(spark, listing(1)), "1").processed == 1
    with store.writing(0):  # given back: no waiting
        pass


def test_a_living_writer_keeps_its_lease(spark, tmp_path):
    store, other = (stores.Store(spark, str(tmp_path / "s")) for _ in range(2))
    with store.writing(0, seconds=1):
        time.sleep(2.5)
        with pytest.raises(TimeoutError):
            with other.writing(0.2):
                pass
        store.append(batch(spark, listing(1)), "1")


def test_a_late_writers_commit_is_refused(spark, tmp_path):
    late, other = (stores.Store(spark, str(tmp_path / "s")) for _ in range(2))
    with late.writing(0, seconds=0.5, beat=False):
        time.sleep(1)
        with other.writing(5):
            with pytest.raises(versions.LeaseLost):
                late.append(batch(spark, listing(1), listing(2)), "late")
            other.append(batch(spark, listing(3)), "in time")
        with pytest.raises(versions.LeaseLost):
            late.append(batch(spark, listing(1)), "late again")
    assert [r["source_job_id"] for r in other.log().collect()] == ["3"] and list(other.state()["batches"]) == ["in time"]
    live = {p["folder"].rsplit("/", 1)[-1] for parts in other.state()["tables"].values() for p in parts}
    gone = other.cleaned()
    assert gone and not set(gone) & live and other.log().count() == 1 and other.cleaned() == []


def test_a_pinned_reader_sees_its_version(spark, tmp_path):
    a, b = (stores.Store(spark, str(tmp_path / "s")) for _ in range(2))
    a.append(batch(spark, listing(1), {"source": "x"}), "a1")
    pinned = stores.Store(spark, a.path, version=a.newest())
    before = [sorted(map(str, f().collect())) for f in (pinned.log, pinned.rejects, pinned.stats, pinned.listings, pinned.batches)]
    frame = pinned.log()
    errors = []

    def write(store, name):
        try:
            for i in range(3):
                store.append(batch(spark, listing(10 + i, title=name)), f"{name}{i}")
        except Exception as error:
            errors.append(error)

    threads = [threading.Thread(target=write, args=(s, n)) for s, n in ((a, "p"), (b, "q"))]
    [t.start() for t in threads], [t.join() for t in threads]
    assert not errors and a.log().count() == 7 and a.log().select("seq").distinct().count() == 7
    assert before == [sorted(map(str, f().collect())) for f in (pinned.log, pinned.rejects, pinned.stats, pinned.listings, pinned.batches)] and frame.count() == 1
    with pytest.raises(ValueError):
        stores.Store(spark, a.path, version=999).log()


def test_log_and_rejects_appear_together(spark, tmp_path, monkeypatch):
    """At every version the figures noted are those of the tables; a writer that dies before its commit leaves nothing to see."""
    store = stores.Store(spark, str(tmp_path / "s"))
    for i in range(3):
        store.append(batch(spark, listing(i), {"source": "x"}, listing(i + 1)), str(i))
    for v in range(store.newest() + 1):
        at = stores.Store(spark, store.path, version=v)
        noted = at.state(v)["batches"].values()
        assert (at.log().count(), at.rejects().count()) == (sum(b["processed"] for b in noted), sum(b["rejected"] for b in noted))
    monkeypatch.setattr(store, "_commit", lambda change, opening=False: versions.Versions._commit(store, change, opening) if opening else (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        store.append(batch(spark, listing(9), {"source": "x"}), "dying")
    after = stores.Store(spark, store.path)
    assert (after.log().count(), after.rejects().count()) == (6, 3)
    assert after.append(batch(spark, listing(9), {"source": "x"}), "dying") == stores.Counts(1, 1, 1, 1)
    assert [(r["new_listings"], r["new_contents"]) for r in after.batches().orderBy("version").collect()] == [(2, 2), (1, 1), (1, 1), (1, 1)]


def test_empty_and_repeated_batches(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "s"))
    assert store.append(batch(spark, listing(1)).where("false"), "none") == stores.Counts(0, 0)
    assert store.append(batch(spark, {"source": "x"}), "bad") == stores.Counts(0, 1)
    first = store.append(batch(spark, listing(1), listing(2)), "b")
    assert first == stores.Counts(2, 0, 2, 2) == store.append(batch(spark, listing(5)), "b")  # a batch is stored once
    assert store.log().count() == 2 and store.listings().count() == 2


def test_many_versions(spark, tmp_path):
    store = versions.Versions(spark, str(tmp_path / "s"))
    with store.writing(0):
        for i in range(40):
            store._commit({"add": {"t": [{"folder": f"f{i}", "rows": i}]}, "remove": {"t": [f"f{i - 1}"]} if i % 2 else {}, "next_seq": i})
    for v in (1, 5, 16, 17, 33, 41):
        assert [p["folder"] for p in store.state(v)["tables"].get("t", [])] == [f"f{i}" for i in range(v - 1) if i % 2 or i == v - 2]
    newer = store._folder()
    newer.put(f"{store.newest() + 1:012d}.json", '{"format": 99, "fence": 1}')
    with pytest.raises(ValueError, match="format"):
        store.state()


def test_a_store_without_versions_is_adopted(spark, tmp_path):
    made = stores.Store(spark, str(tmp_path / "made"))
    made.append(batch(spark, listing(1), listing(2)), "1")
    old = tmp_path / "old"
    for i, n in enumerate(("a", "b")):  # a column less than today's
        made.log().where(F.col("seq") % 2 == i).drop("stream", "place", "search_url").write.parquet(str(old / f"log/batch={n}"))
    store = stores.Store(spark, str(old))
    assert store.exists() and store.log().count() == 2 and store.listings().count() == 2
    assert store.append(batch(spark, listing(2), listing(3)), "new") == stores.Counts(2, 0, 1, 1)
    assert store.log().count() == 4 and store.log().select("seq").distinct().count() == 4 and store.listings().count() == 3


def stream(spark, path, rows):
    """Rows (seq, id) as a file of a stream's folder."""
    made = spark.createDataFrame([(s, "r", *listing(i).values()) for s, i in rows], "seq long, run_id string, " + ", ".join(f"{c} string" for c in listing(0)))
    made.coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(made.schema).option("maxFilesPerTrigger", 1).parquet(path)


def run(records, store, checkpoint, **options):
    query = ingest.append_to_log(records, store, checkpoint, **options)
    assert query.awaitTermination(120) and query.exception() is None


def test_two_streams_and_a_new_checkpoint_keep_every_row_once(spark, tmp_path):
    where = str(tmp_path / "store")
    one, two = (stream(spark, str(tmp_path / n), [(i, 10 * k + i) for i in range(5)]) for k, n in enumerate(("one", "two")))
    run(one, where, str(tmp_path / "c1"), name="one")
    run(two, where, str(tmp_path / "c2"))
    store = stores.Store(spark, where)
    assert store.log().count() == 10 and store.log().select("seq").distinct().count() == 10
    one = stream(spark, str(tmp_path / "one"), [(5, 77)])
    run(one, where, str(tmp_path / "c3"), name="one")  # reads all six again
    assert sorted(r["source_job_id"] for r in store.log().collect()) == sorted(str(i) for i in [0, 1, 2, 3, 4, 10, 11, 12, 13, 14, 77])
    last = store.log().orderBy(F.desc("seq")).first()
    assert (last["source_job_id"], last["seq"]) == ("77", 10)  # goes on behind earlier runs
    run(one, where, str(tmp_path / "c3"), name="one")  # nothing new
    assert store.log().count() == 11
    with pytest.raises(ValueError):
        ingest.append_to_log(one.drop("seq"), where, str(tmp_path / "c4"), name="one")


def test_commit_interval_and_an_epoch_run_again(spark, tmp_path):
    where, rows = str(tmp_path / "store"), batch(spark, *[listing(i) for i in range(10)], {"source": "x"})
    rows = rows.withColumn("seq", F.col("seq") * 3 + 100)
    sink = ingest.Sink(spark, where, "s", "q1", commit_items=4)
    sink.put(rows, 0)
    store = stores.Store(spark, where)
    assert [b["processed"] + b["rejected"] for b in store.state()["batches"].values()] == [4, 4, 3]
    sink.put(rows, 0)
    ingest.Sink(spark, where, "s", "q1", commit_items=100).put(rows, 0)  # the epoch is known to be whole
    assert store.log().count() == 10 and store.rejects().count() == 1

    class Dies(ingest.Sink):
        def _append(self, rows, part, mark):
            if part.endswith(".2"):
                raise RuntimeError("killed")
            super()._append(rows, part, mark)

    more = batch(spark, *[listing(i) for i in range(20, 30)], {"source": "x"}).withColumn("seq", F.col("seq") + 1000)
    with pytest.raises(RuntimeError, match="killed"):
        Dies(spark, where, "s", "q1", commit_items=4).put(more, 1)
    assert store.log().count() == 18
    for size in (3, None):  # the rest is stored, in parts of another size; then there is nothing left
        ingest.Sink(spark, where, "s", "q1", commit_items=size).put(more, 1)
        assert store.log().count() == 20 and store.rejects().count() == 2 and store.log().select("place").distinct().count() == 20
    assert [r["source_job_id"] for r in store.log().orderBy("seq").collect()][10:] == [str(i) for i in range(20, 30)]


def everything(spark, n):
    """Observations with changes, repeats, partial ones and several runs, in order."""
    rows = [listing(i * 7 % 5, title=f"t{i * 3 % 4}", capture_status="partial" if i % 3 == 0 else "complete", canonical_url=None if i % 2 else f"https://c.example.com/{i}", company=" " if i % 5 == 1 else "A") for i in range(n)]
    return registry.records_of(spark, rows).withColumn("seq", F.col("seq") - 1).withColumn("run_id", F.concat(F.lit("run"), F.floor(F.col("seq") / 6).cast("string")))


@pytest.mark.parametrize("cuts", [[1, 2, 9, 24], [12, 24]])
def test_folds_batch_by_batch_equal_the_whole(spark, tmp_path, cuts):
    rows, store, begin = everything(spark, 24).cache(), stores.Store(spark, str(tmp_path / "s")), 0
    for end in cuts:
        store.append(rows.where((F.col("seq") >= begin) & (F.col("seq") < end)), str(end))
        begin = end
    log, plain = store.log(), lambda df: sorted(map(str, df.select(*sorted(df.columns)).collect()))
    drop = [c for c in ("written_at", "updated_at")]
    assert plain(store.identities().drop(*drop)) == plain(history.identities(log).drop(*drop))
    assert plain(store.hits()) == plain(history.hits(stores.hit_rows(log)))
    assert plain(store.latest()) == plain(history.latest(log))
    assert plain(store.listings()) == plain(export.latest_listings(log))
    parts = store.state()["tables"]["contents"]
    assert sum(b["new_listings"] for b in store.state()["batches"].values()) == 5 == store.identities().count()
    assert sum(b["new_contents"] for b in store.state()["batches"].values()) == store.fold("contents").count()
    assert all(a["rows"] >= stores.TIER * b["rows"] for a, b in zip(parts, parts[1:]))  # few parts, each far smaller than the last


def test_an_export_reads_no_log(spark, tmp_path):
    store = stores.Store(spark, str(tmp_path / "s"))
    for i in range(3):
        store.append(batch(spark, listing(i), listing(i, title="other")), str(i))
    for df in (store.listings(), store.latest(), store.identities(), store.hits()):
        assert not any("/data/log-" in f for f in df.inputFiles())


def test_merging_states_is_folding(spark):
    log = everything(spark, 18).withColumns({c: F.lit(None).cast("string") for c in ("written_at", "content_hash", "dedup_key")} | {"content_hash": F.col("title"), "dedup_key": F.col("source_job_id")})
    a, b = log.where("seq < 7"), log.where("seq >= 7")
    fold = folds.IDENTITIES
    plain = lambda df: sorted(map(str, df.collect()))
    assert plain(fold.values(fold.merged(fold.of(b).unionByName(fold.of(a))))) == plain(fold.values(fold.of(log)))
