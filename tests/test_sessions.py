"""Search sessions as streams: each reason to stop, and a restart in mid-session; the table form gives the same."""

import pytest

from ledgermill.streaming import ingest

SCHEMA = "session string, round long, seq long, identity string"
#: session, round, ids in order; None: a page without cards.
PAGES = [
    [("enough", 0, ["a", "b", "a"]), ("empty", 0, [None]), ("rounds", 0, ["x"]), ("open", 0, ["p"])],
    [("enough", 1, ["b", "c"]), ("empty", 1, ["late"]), ("rounds", 1, ["x", None]), ("open", 1, ["q"])],
    [("enough", 2, ["d", "e", "f"]), ("rounds", 2, ["y"]), ("rounds", 3, ["z", "x"])],
    [("enough", 3, ["g"]), ("rounds", 4, ["w"])],
]
CARDS = {("enough", "a", 1, 0), ("enough", "b", 2, 0), ("enough", "c", 3, 1), ("enough", "d", 4, 1), ("rounds", "x", 1, 0), ("rounds", "y", 2, 0), ("rounds", "z", 3, 1), ("open", "p", 1, 0), ("open", "q", 2, 0)}
STOPS = {("enough", 6, 4, 2, "max_results"), ("empty", 0, 0, 0, "empty_search"), ("rounds", 3, 3, 3, "max_scroll_rounds")}


def rows(pages):
    return [(s, n, i, x) for s, n, ids in pages for i, x in enumerate(ids)]


def test_stream_with_a_restart(spark, tmp_path):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        for cut in ((0, 2), (2, 4)):  # two runs of the same query: the second goes on in mid-session
            for page in PAGES[cut[0] : cut[1]]:
                spark.createDataFrame(rows(page), SCHEMA).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
            stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
            run = ingest.sessions(stream, target=4, max_rounds=3, chunk=2).writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
            assert run.awaitTermination(180) and run.exception() is None
        got = spark.read.schema(ingest.SESSION_ROWS).parquet(str(tmp_path / "out")).collect()
    finally:
        spark.conf.set(key, before)
    assert sorted((r["session"], r["identity"], r["rank"], r["chunk"]) for r in got if r["identity"]) == sorted(CARDS)
    assert sorted((r["session"], r["total_unique"], r["returned_total"], r["scrolls_completed"], r["stop_reason"]) for r in got if not r["identity"]) == sorted(STOPS)


def test_table_form(spark):
    df = spark.createDataFrame([r for page in PAGES for r in rows(page)], SCHEMA)
    found, sessions = ingest.session_results(df, target=4, max_rounds=3, chunk=2)
    assert set(map(tuple, found.collect())) == CARDS
    assert {tuple(r)[:5] for r in sessions.where("not can_continue").collect()} == STOPS
    assert [tuple(r) for r in sessions.where("can_continue").collect()] == [("open", 2, 2, 1, None, True)]
    for wrong in ({"target": 0}, {"target": 1, "max_rounds": 0}, {"target": 1, "max_rounds": 5001}, {"target": 1, "chunk": 0}):
        with pytest.raises(ValueError):
            ingest.session_results(df, **wrong)
