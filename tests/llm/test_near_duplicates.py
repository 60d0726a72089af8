"""near_duplicates() against brute force over all pairs."""

import random

import pytest

from ledgermill.llm import fingerprints


def words(rng, n):
    return "".join(rng.choice("abcdefghijklmnop ") for _ in range(n))


def brute(rows, least=fingerprints.LEAST_LIKENESS):
    """The smallest id that a chain of likeness joins each id to."""
    prints = fingerprints.fingerprints([t for _, t in rows])
    root = {i: i for i, _ in rows}
    for x, (i, _) in enumerate(rows):
        for y, (j, _) in enumerate(rows[:x]):
            if root[i] != root[j] and fingerprints.likeness(prints[x], prints[y]) >= least:
                low, high = sorted((root[i], root[j]))
                root = {k: low if r == high else r for k, r in root.items()}
    return root


@pytest.mark.parametrize("group", [512, 5])
def test_members_of_a_band_value_that_others_stand_between(spark, monkeypatch, group):
    """Documents with one opening, where a copy's ids are never neighbours nor the smallest."""
    monkeypatch.setattr(fingerprints, "GROUP", group)
    rng = random.Random(3)
    opening = words(rng, 300)
    bodies = [opening + words(rng, 1500) for _ in range(8)]
    rows = [(0, opening + words(rng, 1500))] + [(1 + 10 * turn + k, body[:-20] + words(rng, 20)) for turn in range(3) for k, body in enumerate(bodies)]
    want = brute(rows)
    assert len(set(want.values())) == 9
    got = fingerprints.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: r["class_id"] for r in got} == want


def test_links_connect_what_all_pairs_connect():
    rng = random.Random(5)
    texts = []
    for n in (3, 12, 40, 300, 1500, 4500, 9000):
        base = words(rng, n)
        texts += [base[: n - cut] + words(rng, cut // 2) for cut in range(0, n // 2 + 1, max(1, n // 12))]
    rows = list(enumerate(texts))
    prints = fingerprints.fingerprints(texts)
    root = list(range(len(texts)))
    for a, b in fingerprints.links(prints, [0] * len(texts), fingerprints.LEAST_LIKENESS):
        low, high = sorted((root[a], root[b]))
        root = [low if r == high else r for r in root]
    assert dict(enumerate(root)) == brute(rows) and 7 <= len(set(root)) < len(texts)


@pytest.mark.parametrize("low, high, turns", [(1, 15, 100), (15, 60, 100), (60, 400, 60), (400, 3000, 60), (3000, 12000, 12)])
def test_bands_find_texts_edited_at_the_start(low, high, turns):
    rng = random.Random(low)
    alike = missed = 0
    for _ in range(turns):
        n = rng.randrange(low, high)
        text = words(rng, n)
        few = list(text)
        for _ in range(n // 40 + 1):
            few[rng.randrange(n)] = "!"
        first, *rest = fingerprints.fingerprints([text, words(rng, 20) + text, words(rng, n // 8) + text[n // 7 :], text[min(20, n // 8) :], "".join(few)])
        for other in rest:
            if fingerprints.likeness(first, other) >= fingerprints.LEAST_LIKENESS:
                alike += 1
                missed += not set(fingerprints.bands(first)) & set(fingerprints.bands(other))
    assert alike >= 10 and missed <= alike / 50


def walked(text):
    """A fingerprint step by step."""
    moves, at, _, salts = fingerprints._walk()
    out, salt = [], dict(zip(at.tolist(), salts.tolist()))
    for start in range(0, len(text), fingerprints.SEGMENT):
        c, p, row = [*fingerprints._classes(text[start : start + fingerprints.SEGMENT]).tolist(), 0, 0, 0], 0, ""
        for step in range(3 * (len(c) - 3)):
            if c[p] == 0:
                break
            if step in salt:
                h = ((c[p] * 65_537 + c[p + 1]) * 65_537 + c[p + 2] + 1) * salt[step] % 2**64
                row += "%x" % (((h ^ (h >> 29)) * 0xBF58476D1CE4E5B9 % 2**64) >> 60)
            p += int(moves[step][c[p]])
        out.append(row)
    return ".".join(out)


def test_fingerprints_are_the_walk_step_by_step():
    rng = random.Random(21)
    texts = ["", "a", "ab", "é🙂漢", *(words(rng, n) for n in (5, 31, 400, 4095, 4096, 4097, 9000))]
    assert fingerprints.fingerprints(texts) == [walked(t) for t in texts]


def test_recall_at_the_stated_edit_rate():
    """Of copies with 0.2 % of their characters substituted, inserted or deleted, 0.9 or more are candidates and verified."""
    rng = random.Random(22)
    texts = [words(rng, rng.randrange(400, 6000)) for _ in range(200)]
    found = 0
    for text in texts:
        s = list(text)
        for _ in range(max(1, round(len(s) / 500))):
            i = rng.randrange(len(s))
            s[i : i + 1] = rng.choice(([rng.choice("abcd")], [s[i], "x"], []))
        a, b = fingerprints.fingerprints([text, "".join(s)])
        found += fingerprints.likeness(a, b) >= fingerprints.LEAST_LIKENESS and bool(set(fingerprints.bands(a)) & set(fingerprints.bands(b)))
    assert found >= 0.9 * len(texts)
