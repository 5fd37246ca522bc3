"""Line history against the rule applied feed by feed."""

import random
from datetime import date, timedelta

from busgrid.operators import history


def one_by_one(versions):
    """[(seq, from, to)] to {seq: (accepted, current, valid_to)} for one line."""
    state, current = {}, None
    for seq, start, end in sorted(versions):
        if current is None:
            current = seq
            state[seq] = [True, True, start, end]
            continue
        c = state[current]
        if (c[2], c[3]) == (start, end) or c[2] > start:
            state[seq] = [False, False, start, end]
        else:
            c[1], c[3] = False, start
            current = seq
            state[seq] = [True, True, start, end]
    return {s: (a, c, e) for s, (a, c, _, e) in state.items()}


def chains(n, seed):
    rng = random.Random(seed)
    for line in range(n):
        base = date(2020, 1, 1)
        yield f"{line:06d}", [
            (seq, base + timedelta(30 * rng.randrange(6)), base + timedelta(300 + 30 * rng.randrange(3)))
            for seq in rng.sample(range(50), rng.randrange(1, 9))
        ]


SCHEMA = "line_number string, feed_seq int, line_no int, line_discriminator int, valid_from date, valid_to date"


def rows(chains):
    return [(line, s, 1, 1, a, b) for line, versions in chains for s, a, b in versions]


def result(df):
    return {
        (r.line_number, r.feed_seq): (r.is_accepted, r.is_current, r.valid_to) for r in df.collect()
    }


def test_history_equals_the_sequential_rule(spark):
    all_chains = list(chains(600, 5))
    df = spark.createDataFrame(rows(all_chains), SCHEMA)
    expected = {
        (line, seq): v for line, vs in all_chains for seq, v in one_by_one(vs).items()
    }
    full = history.line_history(df)
    assert result(full) == expected
    # Split by lots into two loads: the later one may bring older feeds.
    parts = df.randomSplit([0.5, 0.5], seed=3)
    kept = history.line_history(parts[0])
    assert result(history.extend_history(kept, parts[1])) == expected


def test_blocks_give_the_same_history(spark):
    """A line in very many feeds is worked out in blocks of feeds."""
    all_chains = list(chains(300, 6))
    df = spark.createDataFrame(rows(all_chains), SCHEMA)
    assert result(history.line_history(df, hot_feeds=2)) == result(history.line_history(df))


def test_variants_of_one_feed_stay_together(spark):
    d = date
    data = [
        ("1", 1, 1, 1, d(2020, 1, 1), d(2020, 12, 31)),
        ("1", 2, 1, 1, d(2020, 6, 1), d(2020, 12, 31)),
        ("1", 2, 2, 2, d(2020, 6, 1), d(2020, 12, 31)),
    ]
    found = history.line_history(spark.createDataFrame(data, SCHEMA)).collect()
    assert {(r.feed_seq, r.line_discriminator): r.is_current for r in found} == {
        (1, 1): False, (2, 1): True, (2, 2): True,
    }


def test_without_history_all_are_current(spark):
    df = spark.createDataFrame(rows(chains(5, 1)), SCHEMA)
    assert all(r.is_current and r.is_accepted for r in history.without_history(df).collect())
