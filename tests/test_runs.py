import random

import pytest
from conftest import rows

from pulsegrid.config import ValidParticipants
from pulsegrid.operators import runs
from pulsegrid.plans import steps


def daily(spark, days):
    """A day table, as text, from {subject: [(day, valid)]}."""
    cells = [(s, None if d is None else str(d), str(v)) for s, pairs in days.items() for d, v in pairs]
    return spark.createDataFrame(cells, "subject_id string, day_index string, is_valid_day string")


def longest(days):
    """Brute force: extend every start as far as the sorted days go up by one."""
    days = sorted(days)
    best = (0, None, None)
    for at in range(len(days)):
        end = at
        while end + 1 < len(days) and days[end + 1] == days[end] + 1:
            end += 1
        if end - at + 1 > best[0]:
            best = (end - at + 1, days[at], days[end])
    return best


@pytest.mark.parametrize(
    "days, expected",
    [
        ([1, 2, 3, 7, 8, 9], (3, 1, 3)),
        ([1, 2, 2, 4], (2, 1, 2)),
        ([1, 2, 2, 3], (2, 1, 2)),
        ([1, 2, 2, 3, 4], (3, 2, 4)),
        ([1, 2, 2, 2, 2, 3, 4], (3, 2, 4)),
        ([5], (1, 5, 5)),
        ([], (0, None, None)),
        ([-2, -1, 0, 1], (4, -2, 1)),
        (list(range(1000, 4000)), (3000, 1000, 3999)),
        ([*range(0, 1024), 1023, *range(1024, 1030)], (1024, 0, 1023)),
        ([*range(1020, 1025), 1024, *range(1025, 1040)], (16, 1024, 1039)),
    ],
)
def test_longest_run(spark, days, expected):
    assert longest(days) == expected
    table = daily(spark, {"a": [(d, True) for d in days] + [(50_000, False), (50_001, "no")]})
    assert rows(runs.longest_runs(runs.typed_days(table))) == [("a", *expected)]


def test_longest_runs_against_brute_force(spark, monkeypatch):
    for module in ("runs", "days"):
        monkeypatch.setattr(f"pulsegrid.operators.{module}.BLOCK_DAYS", 4)
    pick = random.Random(11)
    days = {}
    for n in range(250):
        span = pick.randrange(1, 40)
        listed = [(d, pick.random() < 0.8) for d in range(-5, span) for _ in range(pick.choice([0, 1, 1, 1, 1, 1, 1, 2, 3]))]
        days[f"s{n}"] = listed or [(None, True)]
    found = {r[0]: tuple(r[1:]) for r in runs.longest_runs(runs.typed_days(daily(spark, days))).collect()}
    assert found == {s: longest([d for d, v in pairs if v and d is not None]) for s, pairs in days.items()}


def test_participants(spark):
    table = daily(
        spark,
        {
            "a": [(0, "True"), (1, "1"), (2, "true"), (3, "False")],
            "b": [(0, True), (2, True)],
            "c": [(0, False)],
            None: [(0, True), (1, True), (2, True)],
        },
    )
    found = steps.find_valid_participants(table, ValidParticipants(3))
    assert rows(found.summary) == [("a", 3, 0, 2, True), ("b", 1, 0, 0, False), ("c", 0, None, None, False)]
    assert rows(found.daily, "subject_id", "day_index") == [("a", 0), ("a", 1), ("a", 2), ("a", 3)]
    assert (rows(found.passing, "subject_id"), rows(found.failing, "subject_id")) == ([("a",)], [("b",), ("c",)])
    assert rows(found.counts) == [(3, 1, 2, 1 / 3 * 100, 3.0, 3.0, 3, 3)]
    ranged = steps.find_valid_participants(table, ValidParticipants(2, day_start=1, day_end=2))
    assert rows(ranged.summary) == [("a", 2, 1, 2, True), ("b", 1, 2, 2, False)]
    assert rows(ranged.daily, "subject_id", "day_index") == [("a", 1), ("a", 2)]


def test_no_participants(spark):
    found = steps.find_valid_participants(daily(spark, {}), ValidParticipants(3))
    assert rows(found.summary) == []
    assert rows(found.counts) == [(0, 0, 0, 0.0, None, None, None, None)]
