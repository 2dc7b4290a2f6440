"""Readers, writers and guards on small files: what is missing, broken, blank or stale."""

import json
import os

import pytest
from pyspark.sql import functions as F

from annolytics.operators import governance as G, staging as S
from annolytics.sinks import writers as W
from annolytics.sources import readers as R


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)
    return str(path)


HEAD = "record_uuid,annotator_id,response_status,calibration,discard_reason,notes,support_present\n"


def test_task_csv(spark, tmp_path):
    p = put(f"{tmp_path}/g.csv", HEAD + 'r1,a,submitted,True,,"two\nlines, ""quoted""",false\nr2,b,discarded,nonsense,unclear,,\n')
    rows = {r.record_uuid: r for r in R.read_task(spark, p, "grounding").collect()}
    assert rows["r1"].notes == 'two\nlines, "quoted"' and rows["r1"].calibration is True and rows["r1"].support_present is False
    assert rows["r2"].calibration is None and rows["r2"].notes is None and rows["r2"].support_present is None and rows["r2"].fabricated_source is None
    assert R.csv_columns(spark, p)[:2] == ["record_uuid", "annotator_id"]


def test_task_csv_missing_empty_and_wrong(spark, tmp_path):
    none = R.read_task(spark, f"{tmp_path}/none.csv", "retrieval")
    assert none.count() == 0 and R.read_task(spark, put(f"{tmp_path}/e.csv", ""), "retrieval").columns == none.columns
    with pytest.raises(ValueError, match="calibration"):
        R.read_task(spark, put(f"{tmp_path}/w.csv", "record_uuid,annotator_id,response_status\nr,a,submitted\n"), "retrieval")
    with pytest.raises(Exception, match="null in annotator_id"):
        R.read_task(spark, put(f"{tmp_path}/n.csv", "record_uuid,annotator_id,response_status,calibration\nr,,submitted,true\n"), "retrieval").collect()


def test_partitions(spark, tmp_path):
    for name in ("a", "b", "_test"):
        put(f"{tmp_path}/x/{name}/grounding.csv", HEAD + f"r,{name},submitted,true,,,true\n")
    os.makedirs(f"{tmp_path}/x/c")
    got = R.read_partitions(spark, f"{tmp_path}/x", "grounding")
    assert sorted((r.programme, r.annotator_id) for r in got.collect()) == [("a", "a"), ("b", "b")]


def test_jsonl_snapshots_pins_ids(spark, tmp_path):
    p = put(f"{tmp_path}/q.jsonl", '{"query": "x", "chunks": [{"chunk_id": "c", "chunk_rank": 1, "extra": 2}]}\n\n{"query": "y"}\n')
    rows = {r.query: r.chunks for r in R.read_jsonl(spark, p, R.GROUP_SCHEMA).collect()}
    assert rows["x"][0].chunk_id == "c" and rows["y"] is None
    with pytest.raises(Exception):
        R.read_jsonl(spark, put(f"{tmp_path}/b.jsonl", '{"query": \n'), R.GROUP_SCHEMA).collect()
    line = lambda t, v: json.dumps({"run_at": t, "schema_version": v, "domains": {"d": {"count": {"total_records": 3}}}})
    s = R.read_snapshots(spark, put(f"{tmp_path}/log.jsonl", line("2026-01-01", 3) + "\n\n" + line("2026-01-02", 3) + "\n"))
    assert R.snapshot_at(s).first().run_at == "2026-01-02" and R.snapshot_at(s, "2026-01-01").count() == 1 and R.snapshot_at(s, "x").count() == 0
    with pytest.raises(Exception, match="older schema"):
        R.read_snapshots(spark, put(f"{tmp_path}/old.jsonl", line("2026-01-01", 2))).collect()
    pins = R.read_pins(spark, put(f"{tmp_path}/pins", "# head\n" + "a" * 64 + "  a b.csv\nshort  x\n"))
    assert [(r.path, r.digest) for r in pins.collect()] == [("a b.csv", "a" * 64)]
    assert [r.id for r in R.read_ids(spark, put(f"{tmp_path}/ids", " x \n\ny\n")).collect()] == ["x", "y"]
    assert R.read_meta(spark, f"{tmp_path}/none.json").first().n_panels is None
    put(f"{tmp_path}/pool/s.jsonl", "")
    put(f"{tmp_path}/pool/s_batch2.jsonl", "")
    put(f"{tmp_path}/pool/s_edgecase.jsonl", "")
    assert [os.path.basename(x) for x in R.file_pool(spark, f"{tmp_path}/pool", "s")] == ["s.jsonl", "s_batch2.jsonl"]


def test_tagged_stream(spark):
    raw = ['<data>[{"id": "", "url": "u", "text": "t", "ref": "0"}, {"id": "7", "text": " "}, {"text": "z", "ref": "9"}]</data>rest', "<data>broken</data>a", "<data>[]", "plain", None]
    docs, answer = R.tagged_stream("v")
    got = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, v string").select("i", R.chunks_of(docs).alias("c"), answer.alias("a")).orderBy("i").collect()
    assert [(c.chunk_id, c.chunk_rank) for c in got[0].c] == [("u-c1", 1), ("doc2-c1", 9)] and got[0].a == "rest"
    assert got[1].c == [] and got[1].a == "a" and got[2].a == "<data>[]" and got[3].a == "plain" and got[4].a is None


def test_contract_csv_and_provenance(spark, tmp_path):
    df = spark.createDataFrame([(1, " x,\"y\"\nz ", None), (2, "", 2.5)], "a int, b string, c double")
    back = W.write_contract_csv(df, f"{tmp_path}/out", ["c", "b", "a"], W.provenance(spark, "s", [f"{tmp_path}/none"], grain="row"), "# words")
    rows = {r.a: r for r in back.collect()}
    assert back.columns == ["c", "b", "a"] and rows[1].b == " x,\"y\"\nz " and rows[1].c is None
    prov = json.load(open(f"{tmp_path}/out.provenance.json"))
    assert prov["n_rows"] == 2 and prov["inputs"] == [{"path": f"{tmp_path}/none", "sha256": None, "missing": True}] and len(prov["output_sha256"]) == 64
    assert os.path.exists(f"{tmp_path}/out.dictionary.md")
    with pytest.raises(ValueError):
        W.write_contract_csv(df, f"{tmp_path}/o2", ["d"])
    with pytest.raises(Exception):
        W.write_contract_csv(df, f"{tmp_path}/out", ["a"])


def test_rewrite_and_freeze(spark, tmp_path):
    spark.range(5).write.parquet(f"{tmp_path}/t")
    W.rewrite(spark.read.parquet(f"{tmp_path}/t").where("id > 1"), f"{tmp_path}/t")
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3 and sorted(os.listdir(tmp_path)) == ["t"]
    put(f"{tmp_path}/src/a.txt", "1")
    put(f"{tmp_path}/src/sub/b.txt", "2")
    d = W.freeze(spark, f"{tmp_path}/src", f"{tmp_path}/2026-01-01", f"{tmp_path}/pins")
    assert sorted(r.path for r in d.collect()) == ["a.txt", "sub/b.txt"]
    assert sorted(r.path for r in R.read_pins(spark, f"{tmp_path}/pins").collect()) == ["a.txt", "sub/b.txt"]
    with pytest.raises(FileExistsError):
        W.freeze(spark, f"{tmp_path}/src", f"{tmp_path}/2026-01-01", f"{tmp_path}/p2")


def test_small_tables(spark):
    df = spark.createDataFrame([("a|b", None)], "x string, y int")
    assert W.markdown_table(df, ["x", "y"]) == "| x | y |\n|---|---|\n| a\\|b | - |"
    assert "<td>a|b</td><td>-</td>" in W.html_table(df, ["x", "y"]) and W.collapsible("t", "b").startswith("<details>")
    with pytest.raises(ValueError):
        W.markdown_table(df, ["x"], most=0)


def test_guards(spark):
    ok = {"population": "corpus", "freeze_date": "2026-07-30", "output_sha256": "d"}
    G.fresh(ok, "corpus", "2026-07-30", "d")
    for bad in (None, {**ok, "population": "x"}, {**ok, "freeze_date": "x"}, {**ok, "output_sha256": "x"}):
        with pytest.raises(ValueError):
            G.fresh(bad, "corpus", "2026-07-30", "d")
    names = ["2026-07-30-a", "2026-08-06", "latest", "2026-99-99"]
    G.stale_pin(names, "2026-08-06")
    with pytest.raises(ValueError):
        G.stale_pin(names, "2026-07-30-a")
    assert G.freeze_pin(["2026-07-30T12:39:00"], ["2026-07-30T12:30:00", "2026-07-30T12:41:00"]) == "2026-07-30T12:41:00"
    with pytest.raises(ValueError):
        G.freeze_pin(["2026-07-30T12:39:00"], ["2026-07-30T15:00:00"])
    assert G.merge_config({"a": {"b": 1, "c": 2}, "d": 1}, {"a": {"c": 3}, "d": {"e": 1}}) == {"a": {"b": 1, "c": 3}, "d": {"e": 1}}
    assert G.known_keys({"a": 1, "b": 2}, {"a"}) == {"a": 1} and G.with_edge_cases(["x"]) == ["x", "x_edgecase"]
    G.same_run("r", "r")
    with pytest.raises(ValueError):
        G.same_run("r", "s")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "w string, n int")
    assert G.in_scope(df, w=["a"], n=[1]).count() == 1
    with pytest.raises(ValueError, match="c"):
        G.in_scope(df, w=["a", "c"])
    with pytest.raises(Exception, match="more than one run"):
        G.one_run_per(spark.createDataFrame([("t", "r1"), ("t", "r2")], "t string, run string"), ("t",), "run").collect()
    none = spark.createDataFrame([], "path string, digest string")
    assert G.pin_verdict(none, none, "path", "digest").first().exit_code == 3


def test_broken_links(spark):
    pages = spark.createDataFrame([("a.md", "# Head Two!\n[x](b.md) [y](#head-two) [z](b.md#none) [w](https://x.y)"), ("b.md", "## In\n[q](./a.md#head-two)")], "path string, text string")
    assert [(r.path, r.target) for r in G.broken_links(pages).collect()] == [("a.md", "b.md#none")]


def test_index_join_refuses_gaps_and_repeats(spark):
    p = spark.createDataFrame([(0, 0.1), (1, 0.2)], "row_index long, p double")
    assert S.join_on_index(p, p.select("row_index", F.lit(True).alias("y"))).count() == 2
    for bad in (p.limit(1), p.unionAll(p.limit(1))):
        with pytest.raises(Exception, match="exactly once"):
            S.join_on_index(p, bad.select("row_index", F.lit(True).alias("y"))).collect()
    t = S.with_index(spark.createDataFrame([(5, "x", True), (3, "y", False)], "id long, t string, label_a boolean"), "id")
    assert sorted((r.id, r.row_index) for r in t.collect()) == [(3, 0), (5, 1)] and "label_a" not in t.columns
