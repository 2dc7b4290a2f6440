"""The two ways through the rounds of problem 4, and what is said about convergence."""

import random

import pytest

from annolytics.llm import consensus as C

COLS = "label_name string, record_uuid string, chunk_id string, annotator_id string, vote int"


def some_votes(n, seed=3):
    rnd = random.Random(seed)
    skill = {f"a{i}": 0.55 + 0.04 * i for i in range(11)}
    rows = []
    for i in range(n):
        truth = rnd.random() < 0.4
        for a in rnd.sample(sorted(skill), rnd.randint(1, 5)):
            rows.append((f"l{i % 2}", f"r{i}", "", a, int(truth if rnd.random() < skill[a] else not truth)))
    return rows


@pytest.mark.parametrize("limit", [1000, 2])
def test_one_task_and_jobs_agree(spark, limit):
    v = spark.createDataFrame(some_votes(300), COLS)
    a, ra = C.consensus(v)
    b, rb = C.consensus(v, one_task=0, limit=limit)
    x, y = ({(r.label_name, r.record_uuid): r for r in t.collect()} for t in (a, b))
    assert set(x) == set(y) and all(abs(x[k].p_true - y[k].p_true) < 1e-9 and x[k][3:5] == y[k][3:5] for k in x)
    p, q = ({(r.label_name, r.annotator_id): r for r in t.collect()} for t in (ra, rb))
    assert set(p) == set(q) and all(abs(p[k].reliability - q[k].reliability) < 1e-9 and p[k].n_rounds == q[k].n_rounds and p[k].converged and q[k].converged for k in p)


def test_rounds_that_end_early_say_so(spark):
    v = spark.createDataFrame(some_votes(200), COLS)
    for kw in ({}, {"one_task": 0}):
        _, ann = C.consensus(v, rounds=2, **kw)
        assert {(r.n_rounds, r.converged) for r in ann.collect()} == {(2, False)}


def test_no_votes(spark):
    for kw in ({}, {"one_task": 0}):
        items, ann = C.consensus(spark.createDataFrame([], COLS), **kw)
        assert items.count() == 0 and ann.count() == 0


def test_forest_with_wide_ids_and_hot_keys(spark, monkeypatch):
    from annolytics.llm import related

    rnd = random.Random(4)
    edges = [(f"r:{i}", "d:hot") for i in range(300)] + [(f"r:{rnd.randrange(900)}", f"d:{rnd.randrange(700)}") for _ in range(800)] + [(f"p:{i}", f"p:{i + 1}") for i in range(120)]
    df = spark.createDataFrame(edges, "a string, b string")

    def groups(labels):
        out = {}
        for r in labels.collect():
            out.setdefault(bytes(r.root) if not isinstance(r.root, int) else r.root, set()).add(r.node)
        return sorted(map(sorted, out.values()))

    labels, forest = related.spanning_forest(df)
    want = groups(labels)
    nodes = sum(map(len, want))
    assert forest.count() == nodes - len(want)
    real = related.join_unique
    monkeypatch.setattr(related, "join_unique", lambda *a, **k: real(*a, **{**k, "limit": 20}))
    labels, forest = related.spanning_forest(df, wide=True)
    assert groups(labels) == want and forest.count() == nodes - len(want)
