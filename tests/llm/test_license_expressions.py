"""Licence expressions whose alternatives are too many to list."""

import itertools
import random

import pytest

from ledgermill.llm import licenses


def test_expressions_of_many_alternatives_are_evaluated():
    pairs = [f"(mit or gpl-{k})" for k in range(40)]
    found = licenses.parse(" and ".join(pairs))
    assert found.names == {"mit", *(f"gpl-{k}" for k in range(40))} and found.permitted({"mit"})
    assert not licenses.parse(" and ".join([*pairs, "gpl-3.0"])).permitted({"mit"})
    tags, bad, names, permitted = licenses.Scanner({}).tags(b"SPDX-License-Identifier: " + " AND ".join(pairs).encode())
    assert (tags, bad, permitted) == (1, 0, True) and names == found.names


def test_permitted_is_that_of_the_alternatives():
    rng = random.Random(1)

    def made(depth):
        return rng.choice("abcd") if depth == 0 or rng.random() < 0.2 else f"({made(depth - 1)} {rng.choice(('and', 'or'))} {made(depth - 1)})"

    for _ in range(100):
        found = licenses.parse(made(3))
        for n in range(5):
            for have in itertools.combinations("abcd", n):
                assert found.permitted(have) == any(x <= set(have) for x in found.alternatives)


def test_with_takes_one_name():
    assert licenses.parse("(a or a) with e").names == {"a with e"}
    for bad in ("(a or b) with e", "a with e with f", "a with (e and f)"):
        with pytest.raises(ValueError):
            licenses.parse(bad)
