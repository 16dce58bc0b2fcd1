"""The choice of summary tables against all choices."""

from __future__ import annotations

import itertools
import math
import random

import pytest

from adevents.operators.advice import advise, candidates, choose, cost, grain_rows, needed
from adevents.plans.reports import SPECS


def test_needs_and_their_unions():
    assert needed(SPECS["q2"]) == ("country", "day", "publisher_id", "type")
    assert candidates([("a",), ("b",), ("a", "c"), ()]) == [("a",), ("b",), ("a", "b"), ("a", "c"), ("a", "b", "c")]


def test_grain_rows_are_exact(events):
    grains = candidates([needed(q) for q in SPECS.values()])
    rows = grain_rows(events, grains)
    for g in grains[:6]:
        assert rows[g] == events.select(*g).distinct().count()


@pytest.mark.parametrize("seed", range(25))
def test_the_greedy_choice_is_near_the_best(seed):
    rng = random.Random(seed)
    columns = {c: rng.randrange(2, 60) for c in "abcde"}
    needs = [tuple(sorted(rng.sample("abcde", rng.randrange(1, 4)))) for _ in range(4)]
    n_events = 5000
    grains = candidates(needs)
    rows = {g: min(n_events, math.prod(columns[c] for c in g)) for g in grains}
    weights = [rng.randrange(1, 5) for _ in needs]
    budget = rng.randrange(10, 6000)
    chosen = choose(needs, weights, rows, n_events, budget)
    assert sum(c.rows for c in chosen) <= budget
    nothing = cost(needs, weights, rows, n_events, ())
    got = nothing - cost(needs, weights, rows, n_events, [c.grain for c in chosen])
    assert got == pytest.approx(sum(c.saved for c in chosen))
    best = max(
        nothing - cost(needs, weights, rows, n_events, pick)
        for k in range(min(len(grains), 4) + 1)
        for pick in itertools.combinations(grains, k)
        if sum(rows[g] for g in pick) <= budget
    )
    assert got >= 0.5 * (1 - 1 / math.e) * best


def test_advice_for_the_reports(events):
    advised = advise(events, list(SPECS.values()), 3000).collect()
    assert advised and sum(r.n_rows for r in advised) <= 3000 and [r.nth for r in advised] == list(range(1, len(advised) + 1))
    assert advise(events, list(SPECS.values()), 0).count() == 0
