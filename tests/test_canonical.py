"""Canonical JSON and content hashes byte for byte as Python's standard library gives them."""

import hashlib
import json
import random

from pyspark.sql import functions as F

from ledgermill.functions import canonical, text as T
from ledgermill.operators import normalize

VALUES = [
    None, "", " ", "1.50", "1.0", "1", "1e3", "1E-7", "-0", "-0.0", "0.1", "123456789012345678901234567890", "1" * 400, "1e400", "NaN", "-Infinity", "true", "null", "nothing",
    '{"b": 1.50, "a": [1.0, 1, 1e3, {"z": -0.0, "y": 12345678901234567890123}]}', '[[[1.10], 2.0], "x"]', '{"a": 1, "a": 2.5}', '"text  With Case"', "Text  With\tCase", "Straße ΣΊΣΥΦΟΣ ı İ", "3.5 years",
    '{"é": "漢字 🙂", "q": "a\\"b\\\\c\\u001f\\u007f"}', "[1, 2", '"\\ud800"', '{"a": 1}  ', " 1", "[0.30000000000000004, 1e22, 1e21, 123456789.123456789, 5e-324]", "2024-01-02", "１２",
]


def loop_token(v):
    if v is None:
        return "null"
    try:
        parsed = json.loads(v)
        out = json.dumps(parsed, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        out.encode()
        return out
    except ValueError:
        return json.dumps(" ".join(v.split()).casefold(), ensure_ascii=False)


def test_tokens_and_json_of_odd_values(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(VALUES)], "i int, v string").repartition(3)
    rows = df.select("i", T.hash_token(F.col("v")).alias("token"), T.json_text(F.col("v")).alias("text"), T.decode_json(F.col("v")).alias("decoded")).collect()
    for r in rows:
        v = VALUES[r["i"]]
        assert canonical.token(v) == loop_token(v), v
        found = canonical.canonical(v)
        if v and v != '{"a": 1, "a": 2.5}' and "ß" not in v and "Σ" not in v:  # those: the JVM's folding, and no repeated names, tested elsewhere
            assert r["token"] == loop_token(v), v
        stripped = v.strip() if v else None
        inner = canonical.canonical(stripped)
        if stripped and v != '{"a": 1, "a": 2.5}':
            assert r["text"] == (json.dumps(stripped, ensure_ascii=False) if inner is None else inner), v
            assert r["decoded"] == (v if found is None else found), v


def test_hashes_of_random_records(spark):
    r = random.Random(2)
    fields = normalize.SNAPSHOT_FIELDS

    def value(depth=0):
        kind = r.randrange(9 if depth < 3 else 6)
        if kind == 6:
            return [value(depth + 1) for _ in range(r.randrange(4))]
        if kind > 6:
            return {r.choice(["b", "a", "é", "Z"]): value(depth + 1) for _ in range(r.randrange(4))}
        return [r.random() * 10 ** r.randrange(-20, 20), r.randrange(-(10**25), 10**25), r.randrange(100), None, True, r.choice(["Text", "x  Y", "1.0", "漢"])][kind]

    rows = [tuple(r.choice([None, "Plain  Text", json.dumps(value()), json.dumps(value(), indent=1), str(r.random())]) for _ in fields) for _ in range(80)]
    df = spark.createDataFrame(rows, ", ".join(f"{f} string" for f in fields)).withColumn("applicants_count", F.lit(7).cast("long"))
    got = df.select(*fields, canonical.content_hash(fields).alias("h")).collect()
    for row in got:
        body = "{" + ",".join(f'"{f}":{loop_token(None if row[f] is None else str(row[f]))}' for f in sorted(fields)) + "}"
        assert row["h"] == hashlib.sha256(body.encode()).hexdigest()


def test_markup_is_not_repeated(spark):
    df = spark.createDataFrame([("s", "1", "<p>a</p>", "<html>", "T")], "source string, source_job_id string, description_html string, raw_html string, title string")
    for include, names in ((True, {"source", "source_job_id", "description_html", "raw_html", "title"}), (False, {"source", "source_job_id", "title"})):
        row = normalize.normalized(df, include_raw=include).first()
        assert set(json.loads(row["raw_json"])) == names and row["description_html"] == "<p>a</p>"
    assert set(normalize.without_raw(df).columns) == {"source", "source_job_id", "title"}
