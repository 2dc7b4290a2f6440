from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from annolytics.functions import scalars as X
from annolytics.functions.intervals import wilson
from annolytics.operators import agreement as A, cadence, clean as C, consolidate as K, evaluator as E, lineage as L, metrics as M


def us(minutes):
    return int((datetime(2026, 1, 1) + timedelta(minutes=minutes) - datetime(1970, 1, 1)).total_seconds() * 1e6)


def test_cadence_golden_numbers(spark):
    ev = spark.createDataFrame([("u", us(m), f"r{m}") for m in (0, 5, 10, 960, 964)], "user string, us long, rec string")
    r = cadence.summary(ev, ("user",), "us", "rec", 1800).first()
    assert (r.n_gaps_total, r.n_gaps_used, r.n_sessions, r.median_s, r.mean_s, r.p25_s, r.p75_s) == (4, 3, 2, 300.0, 280.0, 270.0, 300.0)
    r = cadence.summary(ev.limit(3), ("user",), "us", "rec", 1800).first()
    assert r.median_s is None and r.n_gaps_used == 2
    p = spark.createDataFrame([("u", us(m), f"r{m}") for m in (0, 5, 10, 15, 20, 25, 31)], "user string, us long, rec string")
    r = cadence.pooled(p, (), "user", "us", "rec", 1800).first()
    assert (r.n_gaps_used, r.median_s, r.mean_s) == (6, 300.0, 310.0)


def test_alpha_golden_numbers(spark):
    units = [(1, [1, 1]), (2, [0, 1]), (3, [0, 0]), (4, [1])]
    r = spark.createDataFrame([("l", i, v) for i, vs in units for v in vs], "label string, item int, value int")
    a = A.alpha(A.item_counts(r, ("label",), ("item",)), ("label",)).first()
    assert (a.n_items, a.n_ratings, a.degenerate) == (3, 6, False) and abs(a.alpha - 4 / 9) < 1e-6
    same = spark.createDataFrame([("l", 1, 1), ("l", 1, 1)], r.schema)
    a = A.alpha(A.item_counts(same, ("label",), ("item",)), ("label",)).first()
    assert a.degenerate and a.alpha == 1.0


@pytest.mark.parametrize("rows,want", [([(1, 0), (0, 1), (0, 0), (1, 0)], (1, 0)), ([(0, 1), (1, 0), (0, 0), (0, 0)], (0, 0)), ([(0, 1), (1, 0), (0, 0), (1, 0)], (1, 0)), ([(1, 1), (0, 0)], (1, 1))])
def test_majority_ties(spark, rows, want):
    df = spark.createDataFrame([("k", i, a, b) for i, (a, b) in enumerate(rows)], "k string, ord int, a int, b int")
    r = K.majority(df, ("k",), ("a", "b"), ("ord",)).first()
    assert (r.a, r.b, r.n_votes) == (*want, len(rows))


def test_calibration_grain(spark):
    df = spark.createDataFrame([("A", True), ("A", True), ("B", True), ("B", False), ("C", None)], "record_uuid string, calibration boolean")
    assert sorted(r.record_uuid for r in C.drop_wholly_calibration(df).collect()) == ["B", "B", "C"]


def test_catalogue_scalars(spark):
    df = spark.createDataFrame([("[2019]", "XII, 340 Seiten", "¬The¬ Future", "Meyer, Anna-Lena (Hrsg.)"), ("2019/2020", "ca. 100 S.", " x ", "Meyer"), (None, "2013", None, None)], "y string, p string, t string, n string")
    year = F.nullif(F.regexp_extract("y", r"(1[89]\d\d|20\d\d)", 1), F.lit("")).cast("int")
    got = df.select(year.alias("y"), X.parse_pages(F.col("p")).alias("p"), X.clean_title(F.col("t")).alias("t"), X.first_name(F.col("n")).alias("n")).collect()
    assert [tuple(r) for r in got] == [(2019, 340, "The Future", "Anna"), (2019, 100, "x", None), (None, None, None, None)]


def test_bins_accuracy_and_wilson(spark):
    df = spark.createDataFrame([(0.0, True), (0.1, False), (1.0, True), (None, True)], "p double, y boolean")
    assert [r.bin for r in E.calibration_bins(df, "p", "y").orderBy("bin").collect()] == ["[0.0,0.1)", "[0.1,0.2)", "[0.9,1.0]"]
    d = spark.createDataFrame([(10, 0.4, 0.5, 0.3), (10, 0.4, 0.5, 0.0)], "n int, p double, r double, q double")
    got = E.derived_accuracy(d, "n", "p", "r", "q").collect()
    assert got[0].accuracy == 0.7 and got[1].accuracy is None and got[1].note
    with pytest.raises(Exception, match="whole"):
        E.derived_accuracy(spark.createDataFrame([(10, 0.4, 0.55, 0.3)], d.schema), "n", "p", "r", "q").collect()
    lo, hi = wilson("k", "n")
    r = spark.createDataFrame([(0, 0), (5, 10)], "k int, n int").select(lo.alias("lo"), hi.alias("hi")).collect()
    assert r[0].lo is None and abs(r[1].lo - 0.2366) < 1e-3 and abs(r[1].hi - 0.7634) < 1e-3


def test_interspersion(spark):
    assert K.edge_positions(30, 3) == [10, 11, 12]
    base, edge = spark.range(30).withColumn("kind", F.lit("b")), spark.range(100, 103).withColumn("kind", F.lit("e"))
    rows = K.intersperse(base, edge, "id").orderBy("position").collect()
    assert [r.position for r in rows] == list(range(33)) and [r.position for r in rows if r.kind == "e"] == [10, 11, 12]
    assert [r.id for r in rows if r.kind == "b"] == list(range(30))


def test_as_of_keep_lists_and_diff(spark):
    ex = spark.createDataFrame([(us(759),)], "at long")
    snap = lambda *m: spark.createDataFrame([(us(x),) for x in m], "run long")
    assert L.next_snapshot(ex, snap(750, 761), "at", "run", 7200).first().snapshot_us == us(761)
    assert L.next_snapshot(ex, snap(900), "at", "run", 7200).first().snapshot_us is None
    lists = spark.createDataFrame([("d", "2026-01", "a"), ("d", "2026-02", "b")], "ds string, bundle string, id string")
    assert [r.id for r in L.latest_wins(lists, "ds", "bundle").collect()] == ["b"]
    a, b = (spark.createDataFrame(x, "k int, v string") for x in ([(1, None), (2, "x"), (3, "y")], [(1, None), (2, "z"), (4, "w")]))
    assert {(r.k, r.status, r.changed) for r in L.diff(a, b, "k", ("v",)).collect()} == {(1, "identical", ""), (2, "updated", "v"), (3, "extra", ""), (4, "new", "")}


def test_pseudonyms_and_refusals(spark):
    m = spark.createDataFrame([("bob", "p1")], "k string, v string")
    df = spark.createDataFrame([("bob",), (" ",), (None,), ("a9c62028-8c02-41d0-a464-76d30bab0228",)], "u string")
    assert [r.u for r in C.pseudonymise(df, "u", m, "k", "v").collect()] == ["p1", " ", None, "a9c62028-8c02-41d0-a464-76d30bab0228"]
    with pytest.raises(Exception, match="unmapped identity") as e:
        C.pseudonymise(spark.createDataFrame([("secretname",)], "u string"), "u", m, "k", "v").collect()
    assert "secretname" not in str(e.value).split("SQLSTATE")[0]
    with pytest.raises(ValueError):
        C.require(df, ("nope",))


def test_panel_metrics_skip_incomplete(spark):
    items = spark.createDataFrame([("a", "c1", 1, 2, 0, 1, 0), ("a", "c2", 2, 2, 1, 0, 0), ("b", "c1", 1, 2, 1, 1, 1)], "r string, c string, chunk_rank int, k int, topically_relevant int, evidence_sufficient int, misleading int")
    r = M.panel_metrics(items, "r", "c", "chunk_rank", "k").first()
    assert (r.n_panels, r.n_panels_skipped, r.topical_precision_at_k, r.mean_reciprocal_rank_at_k) == (1, 1, 0.5, 0.5)
