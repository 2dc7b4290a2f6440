import random
from datetime import datetime, timedelta

import pytest

from annolytics.operators.sessions import sessions

SCHEMA = "user_id string, inserted_at timestamp_ntz, record_id string, task string, us string"
T0 = datetime(2026, 1, 1, 23, 40)


def brute(rows, gap=1800):
    seen = {(u.strip().lower(), t, r, k) for u, t, r, k, _ in rows if u and u.strip() and t}
    by = {}
    for u, t, r, k in seen:
        by.setdefault(u, []).append((t, str(r), str(k)))
    out = []
    for u, ev in by.items():
        ev.sort()
        cur = [ev[0]]
        for e in ev[1:]:
            if (e[0] - cur[-1][0]).total_seconds() > gap:
                out.append((u, cur[0][0], cur[-1][0], len(cur)))
                cur = []
            cur.append(e)
        out.append((u, cur[0][0], cur[-1][0], len(cur)))
    return sorted(out)


def got(spark, rows, **kw):
    df = sessions(spark.createDataFrame(rows, SCHEMA), **kw)
    us = lambda x: datetime(1970, 1, 1) + timedelta(microseconds=x)
    return sorted((r.user_id, us(r.start_us), us(r.end_us), r.n_events) for r in df.collect())


def test_gap_of_exactly_the_limit_stays(spark):
    rows = [("A ", T0, "r1", "t", ""), ("a", T0 + timedelta(seconds=1800), "r2", "t", ""), ("a", T0 + timedelta(seconds=3600, microseconds=1), "r3", "t", "")]
    assert got(spark, rows) == [("a", T0, T0 + timedelta(seconds=1800), 2), ("a", T0 + timedelta(seconds=3600, microseconds=1), T0 + timedelta(seconds=3600, microseconds=1), 1)]


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(None, T0, "r", "t", ""), ("\t", T0, "r", "t", ""), ("a", None, "r", "t", ""), ("a", T0, "r", "t", "x"), ("A", T0, "r", "t", "y"), ("a", T0, "s", "t", ""), ("a", T0, None, None, ""), ("a", T0, None, None, "")]
    assert got(spark, rows) == [("a", T0, T0, 3)]
    assert got(spark, []) == []


@pytest.mark.parametrize("bucket", [1800, 6 * 3600, 10**7])
def test_against_brute_force_with_a_hot_user(spark, bucket):
    rnd = random.Random(bucket)
    rows = [(rnd.choice(["hot", "HOT", "b", "c ", None]), T0 + timedelta(seconds=rnd.choice([0, 600, 1800, 1801]) * rnd.randint(0, 60)), f"r{rnd.randint(0, 3)}", rnd.choice(["x", None]), "") for _ in range(400)]
    assert got(spark, rows, bucket_s=bucket) == brute(rows)


def test_bucket_below_the_gap_is_refused(spark):
    with pytest.raises(ValueError):
        sessions(spark.createDataFrame([], SCHEMA), bucket_s=10)
