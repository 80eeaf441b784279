"""Set-based operators against plain statements of what they mean, on random small cases."""

from __future__ import annotations

import datetime as dt
import random

import pytest

from windrow.operators.dedup import collapse_counters, keep_latest
from windrow.operators.replace import replace_metrics, replace_windows
from windrow.operators.work_items import WorkItems

DAY = dt.date(2020, 1, 1)


def install_rank(row):
    return -1 if row[1] is None else row[1]


def holder(earlier):
    """Who stands for a key after some rows: the last of those with the highest rank."""
    top = max(map(install_rank, earlier))
    return [r for r in earlier if install_rank(r) == top][-1]


def expected(rows):
    """Survivors and counters of one scope, each row judged by the prefix of its key alone."""
    by_key = {}
    for place, row in enumerate(rows):
        by_key.setdefault(row[0], []).append((place, row[:4]))
    pairs = [  # every later row of a key with the holder of the rows before it
        (place, row, holder([r for _, r in placed[:i]]))
        for placed in by_key.values()
        for i, (place, row) in enumerate(placed)
        if i
    ]
    clashes = [(place, row, held) for place, row, held in pairs if row != held]
    losers = [min((held, row), key=install_rank) for _, row, held in clashes]  # held loses a tie
    counts = {
        "dup": len(pairs) - len(clashes),
        "conflict": len(clashes),
        "tie": sum(install_rank(row) == install_rank(held) for _, row, held in clashes),
        "lost": sum(r[2] or 0 for r in losers),
        "first": min(clashes, key=lambda c: c[0])[1][0] if clashes else None,
    }
    return {key: holder([r for _, r in placed]) for key, placed in by_key.items()}, counts


@pytest.mark.parametrize("hot_key_rows", [1, 3, 7, 1_000_000])
def test_counters_and_survivors_match_the_prefixes(spark, hot_key_rows):
    rng = random.Random(hot_key_rows)
    data, scopes = [], {}
    for scope in ("a", "b", "c", "d"):
        rows = []
        for _ in range(120):
            # One key takes a third of the rows.
            key = 0 if rng.random() < 0.34 else rng.randrange(1, 25)
            install = rng.choice([None, 1, 1, 2, 3])
            money = rng.choice([None, 1, 2, 2])
            rows.append((key, install, money, rng.choice("xy"), rng.randrange(10**6)))
        for i, row in enumerate(rows):
            data.append((scope, *row[:4], i * 3 + rng.randrange(3)))
        scopes[scope] = expected(rows)
    # Row ordinals with gaps; every scope counts from zero, like files do.
    df = spark.createDataFrame(
        data, "scope string, key int, install_time int, event_revenue int, other string, row_ord long"
    )
    got = collapse_counters(df, ["scope"], ["key"], hot_key_rows=hot_key_rows).collect()
    assert len(got) == 4
    for c in got:
        want = scopes[c.scope][1]
        assert (c.exact_duplicates, c.conflicts, c.ties, c.discarded_revenue) == (
            want["dup"], want["conflict"], want["tie"], want["lost"],
        )
        assert c.first_conflict.key == want["first"]
    for row in keep_latest(df, ["scope"], ["key"]).collect():
        want = scopes[row.scope][0][row.key]
        assert (row.install_time, row.event_revenue, row.other) == want[1:4]


def test_null_key_parts_match_each_other(spark):
    df = spark.createDataFrame(
        [("a", None, 1, 5, 0), ("a", None, 1, 5, 1), ("a", None, 2, 6, 2), ("a", 1, 1, 1, 3)],
        "scope string, key int, install_time int, event_revenue int, row_ord long",
    )
    for hot in (1, 100):
        c = collapse_counters(
            df, ["scope"], ["key"], hot_key_rows=hot, nullable_key=["key"]
        ).first()
        assert (c.exact_duplicates, c.conflicts, c.ties, c.discarded_revenue) == (1, 1, 0, 5)


def simulate(existing, windows, incoming):
    """Load window after window: delete what it owns, insert its rows."""
    table, deleted = [(r, None) for r in existing], {}
    for seq, (app, start, end) in enumerate(windows):
        owns = lambda r: r[0] == app and start <= r[1] <= end
        deleted[seq] = sum(owns(r) for r, _ in table)
        table = [(r, s) for r, s in table if not owns(r)]
        table += [(r, seq) for r, s in incoming if s == seq]
    return sorted(r[2] for r, _ in table), deleted


@pytest.mark.parametrize("disjoint", [True, False])
@pytest.mark.parametrize("bounded", [True, False])
def test_replace_matches_loading_one_by_one(spark, disjoint, bounded):
    rng = random.Random(disjoint * 2 + bounded)
    for case in range(3):
        windows = []
        for app in ("p", "q"):
            day = 0
            for _ in range(rng.randrange(1, 5)):
                length = rng.randrange(1, 4)
                start = day if disjoint else rng.randrange(12)
                windows.append((app, start, start + length - 1))
                day += length + rng.randrange(2)
        ident = iter(range(10**6))
        row = lambda app: (app, rng.randrange(14), next(ident))
        existing = [row(rng.choice("pqr")) for _ in range(40)]
        incoming = []
        for seq, (app, start, end) in enumerate(windows):
            for _ in range(rng.choice([0, 3, 6])):
                r = row(app)
                inside = rng.random() < 0.6
                r = (app, rng.randint(start, end), r[2]) if inside else r
                incoming.append((r, seq))
        want, want_deleted = simulate(existing, windows, incoming)

        at = lambda n: dt.datetime.combine(DAY + dt.timedelta(days=n), dt.time(23, 59, 59))
        on = lambda n: DAY + dt.timedelta(days=n)
        cols = "app_id string, attribution_type string, event_time timestamp_ntz, ident long"
        old = spark.createDataFrame([(a, "x", at(d), i) for a, d, i in existing], cols)
        new = spark.createDataFrame(
            [(a, "x", at(d), i, s) for (a, d, i), s in incoming], cols + ", seq long"
        )
        items = WorkItems(
            spark.createDataFrame(
                [(s, a, "x", on(b), on(e)) for s, (a, b, e) in enumerate(windows)],
                "seq long, app_id string, attribution_type string, start_date date, end_date date",
            ),
            *((len(windows), 200) if bounded else (None, None)),
        )
        after = replace_windows(old, new, items)
        assert sorted(r.ident for r in after.collect()) == want
        metrics = {r.seq: r for r in replace_metrics(old, new, items).collect()}
        assert {s: m.deleted for s, m in metrics.items()} == want_deleted
        for s, m in metrics.items():
            mine = [r for r, seq in incoming if seq == s]
            _, start, end = windows[s]
            assert m.inserted == len(mine)
            assert m.out_of_window == sum(not start <= r[1] <= end for r in mine)
            assert m.wiped == (want_deleted[s] > 0 and not mine)
