"""Extra columns with names that the operators use themselves, nulls everywhere, repeated rows: nothing changes."""

from datetime import datetime

from pyspark.sql import functions as F

from annolytics.llm import consensus, defects, encode, mix, overlap, pii, related, split
from annolytics.operators.sessions import sessions

CLASH = ["u", "n", "h", "bucket", "sig", "qid", "cid", "word", "defect", "p", "votes", "pattern", "who", "root", "id", "node", "a", "b", "cell", "us", "rank", "block", "slot", "__text", "__id", "kind", "x", "size", "band", "own", "e", "d", "k"]


def odd(df):
    """df with every clashing name, a row of nulls, and everything twice."""
    wide = df.select("*", *[F.lit("clash").alias(c) for c in CLASH if c not in df.columns])
    nulls = df.sparkSession.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in wide.schema])
    return wide.unionAll(wide).unionAll(nulls)


def rows(df):
    return sorted(map(str, df.collect()))


def test_records(spark):
    text = "Die Auswertung der Kulturkarte zeigt in Obertal einen klaren Zuwachs. "
    q = spark.createDataFrame(
        [("r1", "train", "Was zeigt die Karte?", text, text * 60, "de", "d"), ("r2", "test", "Was zeigt die Karte?", text, None, None, "d"), ("r3", "test", "Und nun?", "", "", "xx", None)],
        "record_uuid string, split string, query string, answer string, context_set string, language string, source_domain string",
    )
    assert rows(overlap.overlaps(odd(q))) == rows(overlap.overlaps(q)) and overlap.overlaps(q).count() == 1
    assert rows(overlap.overlap_counts(odd(q))) == rows(overlap.overlap_counts(q))
    assert rows(defects.defects(odd(q))) == rows(defects.defects(q)) and defects.defects(q).count() == 1
    a, b = (split.pieces(x, ("record_uuid",), ("context_set", "answer")) for x in (odd(q), q))
    assert rows(a) == rows(b) and a.count() > 1


def test_votes_and_groups(spark):
    t = datetime(2026, 1, 1)
    r = spark.createDataFrame(
        [(f"r{i}", f"dok-{i // 2}-c1", f"a{j}", "submitted", True, t, bool(i % 2), "dom") for i in range(6) for j in range(3)],
        "record_uuid string, chunk_id string, annotator_id string, response_status string, calibration boolean, inserted_at timestamp_ntz, topically_relevant boolean, source_domain string",
    )
    votes = lambda x: consensus.consensus(consensus.votes(x, "topically_relevant", True))
    for x, y in zip(votes(odd(r)), votes(r)):
        assert rows(x) == rows(y) and x.count()
    q = r.select("record_uuid", "source_domain").distinct()
    assert rows(related.related_records(odd(r), odd(q))) == rows(related.related_records(r, q))


def test_documents(spark):
    docs = spark.createDataFrame([(1, "Bei Anna Schneider, Tel. 030 1234567.", "s"), (2, "", "s"), (3, None, None), (4, "x " * 40_000, "s")], "doc_id long, text string, source string")
    hints = spark.createDataFrame([("Anna",)], "given_name string")
    assert rows(pii.mentions(odd(docs), odd(hints)).where("doc_id IS NOT NULL")) == rows(pii.mentions(docs, hints)) and pii.mentions(docs, hints).count() == 2
    assert set(rows(pii.mask(odd(docs), hints))) >= set(rows(pii.mask(docs, hints)))
    assert set(rows(encode.encode(odd(docs)))) >= set(rows(encode.encode(docs)))
    sized = encode.encode(docs, count_only=True, keep=("source",))
    targets = spark.createDataFrame([("s", 1.0, 2)], "source string, target_share double, max_repeats int")
    wide = sized.select("*", *[F.lit("clash").alias(c) for c in CLASH if c not in sized.columns])
    for x, y in zip(mix.mixed(wide, targets), mix.mixed(sized, targets)):
        assert rows(x) == rows(y)


def test_sessions(spark):
    t = datetime(2026, 1, 1)
    e = spark.createDataFrame([("u1", t, "r", "x"), ("u1", t, "r2", "x"), (None, t, "r", "x"), ("u2", None, "r", "x")], "user_id string, inserted_at timestamp_ntz, record_id string, task string")
    assert rows(sessions(odd(e))) == rows(sessions(e)) and sessions(e).count() == 1
