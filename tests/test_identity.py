"""Old identities: the fold against a loop over a table of identities that is kept up to date record by record."""

import random

import pytest

from ledgermill.operators import identity

SCHEMA = "seq long, source string, dedup_key string, default_key string, source_job_id string, canonical_url string, title string"


def loop(rows):
    """Record by record, with every identity's id (first known), URL (last known) and number."""
    jobs, out = {}, {}
    for seq, source, key, default, job_id, url, _ in sorted(rows):
        if key == default:
            mine = [k for k, j in jobs.items() if j["source"] == source and (k == key or (j["id"] == job_id if job_id is not None else j["id"] is None and j["url"] is not None and j["url"] == url))]
            for k in sorted(mine, key=lambda k: (k != key, jobs[k]["n"])):
                if k == key or (job_id is not None and k == f"{source}:{job_id}") or k.startswith((f"{source}:https://", f"{source}:http://")):
                    key = k
                    break
        j = jobs.setdefault(key, {"source": source, "id": None, "url": None, "n": len(jobs)})
        j["id"] = job_id if j["id"] is None else j["id"]
        j["url"] = j["url"] if url is None else url
        out[seq] = key
    return out


def record(seq, source, key, job_id, url):
    default = f"{source}:id:{job_id}" if job_id is not None else f"{source}:url:{url}"
    return seq, source, key or default, default, job_id, url, "t"


def resolved(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = identity.resolved_keys(df)
    assert got.columns == df.columns
    return {r["seq"]: r["dedup_key"] for r in got.collect()}


def test_an_identity_whose_url_changed_between(spark):
    a, b, old = "https://e.com/a", "https://e.com/b", "s:https://e.com/a"
    rows = [record(1, "s", old, None, a), record(2, "s", None, None, a), record(3, "s", old, None, b), record(4, "s", None, None, b), record(5, "s", None, None, a), record(6, "s", old, None, a), record(7, "s", None, None, a), record(8, "s", None, None, b)]
    got = resolved(spark, rows)
    assert got == loop(rows)
    assert [got[i] for i in (2, 4, 5, 7, 8)] == [old, old, f"s:url:{a}", f"s:url:{a}", "s:url:https://e.com/b"]  # 8: b has been left


def test_an_identity_that_gets_an_id_is_found_by_it_only(spark):
    a, old = "https://e.com/a", "s:http://e.com/a"
    rows = [record(1, "s", old, None, a), record(2, "s", old, "7", None), record(3, "s", None, None, a), record(4, "s", None, "7", "https://e.com/z"), record(5, "s", "s:8", "9", None), record(6, "s", None, "8", a), record(7, "s", None, "9", a)]
    got = resolved(spark, rows)
    assert got == loop(rows) and got[3] == f"s:url:{a}" and got[4] == old and got[6] == "s:id:8"


@pytest.mark.parametrize("seed", range(6))
def test_against_the_loop(spark, seed):
    """Half the seeds have few values, so that identities meet often."""
    r = random.Random(seed)
    ids, urls = [None, "1", "2", "3"][: 2 + seed % 3], [None, "https://e.com/a", "https://e.com/b", "http://e.com/c"]
    rows = []
    for seq in range(250):
        source, job_id, url = r.choice("st"), r.choice(ids), r.choice(urls)
        if job_id is None and url is None:
            url = urls[1]
        old = [f"{source}:{r.choice(['1', '2', '3'])}", f"{source}:{r.choice(urls[1:])}", f"{source}:mine", f"t:{r.choice(urls[1:])}" if source == "t" else f"s:{job_id}"]
        rows.append(record(seq, source, r.choice(old) if r.random() < 0.3 else None, job_id, url))
    assert resolved(spark, rows) == loop(rows)


def test_no_rows_and_records_without_anything(spark):
    assert identity.resolved_keys(spark.createDataFrame([], SCHEMA)).collect() == []
    odd = [(1, "s", None, None, None, None, "t"), (2, None, "s:1", "s:id:1", "1", None, "t"), (3, "s", "k", None, None, None, "t")]
    assert resolved(spark, odd) == {1: None, 2: "s:1", 3: "k"}
