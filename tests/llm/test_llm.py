"""Small fixtures of the operators for training data: brute force, round trips, and the defined results of odd input."""

import os
import random
from datetime import datetime

import numpy as np
import pytest

from annolytics.llm import consensus, defects, encode, mix, overlap, pii, pii_rules, related, split

HAVE_VOCAB = os.path.exists(os.path.join(encode.TOKENIZER_DIR, "byte_bpe_50k.tiktoken"))
T = datetime(2026, 1, 1)


# --- problem 1
def _match(a, b):
    from collections import Counter

    x, y = Counter(defects.tokens(a)), Counter(defects.tokens(b))
    n = max(sum(x.values()), sum(y.values()))
    return n > 0 and 5 * sum((x & y).values()) >= 4 * n


QA = "record_uuid string, split string, query string, answer string, source_domain string"


def test_overlaps_against_brute_force(spark):
    rnd = random.Random(3)
    words = [f"wort{chr(97 + i)}{chr(97 + j)}" for i in range(6) for j in range(6)]
    rows = []
    for i in range(120):
        if i % 3 and rows:
            q, a = rnd.choice(rows)[2:4]
            q, a = q.rstrip("?").split(), a.rstrip(".").split()
            for part in (q, a):
                for _ in range(rnd.randint(0, 3)):
                    part[rnd.randrange(len(part))] = rnd.choice(words)
                rnd.shuffle(part)
        else:
            q, a = [[rnd.choice(words) for _ in range(rnd.choice([1, 2, 3, 5, 12, 30]))], [rnd.choice(words) for _ in range(rnd.randint(10, 25))]]
        rows.append((f"r{i:03d}", rnd.choice(["train", "train", "test", "validation"]), " ".join(q) + "?", " ".join(a) + ".", "d"))
    df = spark.createDataFrame(rows + rows[:5], QA)
    got = {(r.train_uuid, r.eval_uuid) for r in overlap.overlaps(df).collect()}
    bad = {r[0] for r in rows if defects.judge(r[2], r[3])[0]}
    want = {(a[0], b[0]) for a in rows for b in rows if a[1] == "train" != b[1] and a[0] not in bad and b[0] not in bad and _match(a[2], b[2]) and _match(a[3], b[3])}
    assert got == want and want


def test_overlaps_odd_input(spark):
    same = "Die Auswertung der Kulturkarte zeigt in Obertal einen klaren Zuwachs."
    rows = [("A ", "train", "Was zeigt die Kulturkarte in Obertal?", same, None), ("b", "test", "WAS zeigt die **Kulturkarte** in Obertal", same.replace("ä", "ae"), None), ("c", "train", None, None, None), ("d", None, "x", "y", None), (None, "test", "Was zeigt die Kulturkarte in Obertal?", same, None), ("e", "test", "", "", None)]
    assert [(r.train_uuid, r.eval_uuid) for r in overlap.overlaps(spark.createDataFrame(rows, QA)).collect()] == [("a", "b")]
    assert overlap.overlaps(spark.createDataFrame([], QA)).count() == 0


# --- problem 2
def _check(t, g, limit, ov, sl):
    assert g[0][0] == 0 and g[-1][1] == len(t) and all(0 < b - a <= limit for a, b in g)
    for (a, b), (c, d) in zip(g, g[1:]):
        assert max(0, b - ov) <= c <= max(0, b - ov + sl) and d > b


def test_pieces_keep_limit_overlap_and_text():
    rnd = random.Random(1)
    texts = ["".join(rnd.choice("ab .\n\réё‍") for _ in range(rnd.randint(1, 500))) for _ in range(500)] + ["x" * 5000, " " * 300, "a b\n\n" * 2000]
    for limit, ov, sl in ((40, 10, 4), (30, 0, 0), (2000, 200, 40)):
        for t, g in zip(texts, split.cut(texts, limit, ov, sl)):
            _check(t, g, limit, ov, sl)
    assert split.cut(["", "a"]) == [[], [(0, 1)]]
    text = ("Ein Satz mit mehreren Wörtern. " * 40).strip() + "\n\n" + "Noch ein Satz. " * 100
    first = split.cut([text])[0][0]
    assert text[: first[1]].endswith("\n\n")
    with pytest.raises(ValueError):
        split.cut(["a"], 10, 8, 0)


def test_piece_table(spark):
    df = spark.createDataFrame([("a", "x " * 1500, None), ("a", "x " * 1500, None), ("b", "k" * 2000, "y" * 2001), (None, None, "")], "record_uuid string, answer string, context_set string")
    p = split.pieces(df, ("record_uuid",), ("answer", "context_set")).collect()
    assert {(r.record_uuid, r.field_name) for r in p} == {("a", "answer"), ("b", "context_set")}
    assert sum(r.record_uuid == "a" for r in p) == 2 and all(len(r.piece) == r.end_pos - r.start_pos + 1 <= 2000 for r in p)


# --- problem 3
ROWS3, REC3 = "record_uuid string, source_domain string, chunk_id string, extra int", "record_uuid string, source_domain string, split string"


def _groups(spark, rows, recs):
    return {(r.record_uuid, r.group_uuid) for r in related.related_records(spark.createDataFrame(rows, ROWS3), spark.createDataFrame(recs, REC3)).where("size > 1").collect()}


def test_groups_against_union_find(spark):
    rnd = random.Random(5)
    recs = [(f"r{i:03d}", rnd.choice(["x", "y"]), "train") for i in range(150)]
    rows = [(r, None, f"dok-{rnd.randint(1, 90):08d}-c{rnd.randint(1, 4)}", 1) for r, _, _ in recs for _ in range(rnd.randint(0, 2))]
    rows += [(r, None, "dok-99999999-c1", 1) for r, _, _ in recs[:50]]  # a document of a third of all records
    dom, parent = {r: d for r, d, _ in recs}, {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for r, _, c, _ in rows:
        parent[find(r)] = find((dom[r], c.rsplit("-", 1)[0]))
    groups = {}
    for r in {x[0] for x in rows}:
        groups.setdefault(find(r), set()).add(r)
    assert _groups(spark, rows, recs) == {(r, min(g)) for g in groups.values() if len(g) > 1 for r in g}


def test_groups_odd_input(spark):
    recs = [("a", "Süd-ost", "train"), ("b", "sued_ost ", "test"), ("c", "nord", "test")]
    rows = [("A\t", None, " DOK-1-c1", 0), ("b", "x", "dok-1-c2", 0), ("c", None, "dok-1-c1", 0), ("d", None, "n/a", 0), ("e", None, None, 0), (None, None, "dok-1-c1", 0), ("f", "Süd Ost", "dok-1-c9", 0)]
    assert _groups(spark, rows, recs) == {("a", "a"), ("b", "a"), ("f", "a")}
    assert _groups(spark, [], []) == set()
    # a long chain takes several rounds
    chain = [(f"r{i:03d}", None, f"dok-{i + j}-c1", 0) for i in range(40) for j in (0, 1)]
    assert len({g for _, g in _groups(spark, chain, [(f"r{i:03d}", "x", "t") for i in range(40)])}) == 1


def test_dealt_shares(spark):
    g = spark.createDataFrame([("huge", 700)] + [(f"g{i}", 1 + i % 5) for i in range(900)], "group_uuid string, size long")
    got = {r.split: r.n for r in related.deal(g).groupBy("split").sum("size").withColumnRenamed("sum(size)", "n").collect()}
    total = sum(got.values())
    assert abs(got["train"] / total - 0.8) < 0.03 and abs(got["test"] / total - 0.1) < 0.03
    assert related.deal(g.limit(0)).count() == 0


# --- problem 4
def test_consensus_trusts_reliable_annotators(spark):
    rnd = random.Random(2)
    truth = {f"i{i}": rnd.random() < 0.5 for i in range(200)}
    rows = []
    for i, t in truth.items():
        for a in rnd.sample(["good1", "good2", "good3", "bad1", "bad2"], 4):
            v = t if rnd.random() < 0.95 else not t
            rows.append(("l", i, "", a, int(v if a.startswith("good") else not v)))
    v = spark.createDataFrame(rows, "label_name string, record_uuid string, chunk_id string, annotator_id string, vote int")
    items, ann = consensus.consensus(v)
    got = {r.record_uuid: r.p_true > 0.5 for r in items.collect()}
    rel = {r.annotator_id: r.reliability for r in ann.collect()}
    assert sum(got[i] == t for i, t in truth.items()) > 0.97 * len(truth) and rel["good1"] > 0.85 and rel["bad1"] < 0.2
    assert consensus.consensus(v.limit(0))[0].count() == 0


def test_votes_latest_non_null(spark):
    rows = [("R ", "c", "a", "submitted", datetime(2026, 1, 1), True), ("r", "c", "A", "submitted", datetime(2026, 1, 2), False), ("r", "c", "a", "submitted", datetime(2026, 1, 3), None), ("r", "c", "b", "discarded", T, True), ("r", "x", None, "submitted", T, True)]
    rows = [(r, f"dok-1-{c}1" if c == "c" else "n/a", a, s, t, v) for r, c, a, s, t, v in rows]
    df = spark.createDataFrame(rows, "record_uuid string, chunk_id string, annotator_id string, response_status string, inserted_at timestamp_ntz, topically_relevant boolean")
    assert [(r.record_uuid, r.annotator_id, r.vote) for r in consensus.votes(df, "topically_relevant", True).collect()] == [("r", "a", 0)]


# --- problem 6
Q = "Welche Rolle spielte die Kulturkarte für Pendler in Obertal seit 2014, und wie unterscheidet sie sich von der Sportquote?"


@pytest.mark.parametrize("answer,want", [
    (None, "empty"), ("", "empty"), ("<p></p>", "empty"), ("Antwort: n/a", "empty"), ("- \n- \n", "empty"), ("```\n```", "empty"), ("​", "empty"), ("(keine Antwort)", "empty"),
    ("Dazu liegen mir keine Informationen vor. Ich bitte um Verständnis.", "refusal"), ("I'm sorry, but I cannot answer this question.", "refusal"), ("Désolé, je ne peux pas répondre à cette question.", "refusal"), ("Hierover heb ik geen informatie.", "refusal"),
    ("Zur Höhe kann ich keine Auskunft geben, wohl aber zum Rest. Die Kulturkarte wirkt in Obertal.", None),
    (Q, "copy"), (Q.upper(), "copy"), ("Ihre Frage lautet: " + Q, "copy"), (f"{Q} {Q}", "copy"), (Q + "\n\n" + "Die Auswertung zeigt, dass die Kulturkarte im Vergleich zu den anderen Orten deutlich stärker wirkt und von vielen genutzt wird.", None),
    ("The report from Obertal shows that the card works for commuters and that it is used by many of them.", "other_language"), ("Отчёт показывает, что карта работает хорошо.", "other_language"),
    ("Die Kulturkarte wirkt, weil die", "truncated"), ("Die Karte (im Jahr", "truncated"), ("Die Karte wirkt.\n\n| A | B |\n|---|---|\n| Ober | 1", "truncated"), ("Die Karte wirkt.\n\n- Kulturkarte – Obertal (2013)\n- Sportquote – Ober", "truncated"), ("Die Karte wirkt in …", "truncated"), ("Die Karte wirkt.\n\n###", "truncated"),
    ("Die Kulturkarte wirkt [1].", None), ("Die Karte wirkt.\n\n- Kulturkarte – Obertal (2013)\n- Sportquote – Wolfstal (2014)", None), ("Die Karte wirkt und zwar gut.\n\nQuelle: Sportquote 2022, S. 51", None), ("<p>Die Karte wirkt.</p>", None), ("Die Karte wirkt. (Stand 2020)", None), ("„Die Karte wirkt.“", None),
])
def test_defects_of_pairs(answer, want):
    assert defects.judge(Q, answer)[0] == want


def test_defect_table(spark):
    rows = [("A", Q, None), ("a", Q, None), (None, Q, ""), ("b", None, "Die Karte wirkt."), ("c", Q, "Die Karte wirkt.\n- Karte, Pendler, 12 Obertal\n- Quote, Eltern, 13 Oberrode\n- Plan, Eltern, 14 Ober"), ("d", Q, "x " * 30000 + ".")]
    got = {(r.record_uuid, r.defect) for r in defects.defects(spark.createDataFrame(rows, "record_uuid string, query string, answer string")).collect()}
    assert got == {("a", "empty"), ("c", "truncated")}


# --- problems 7 and 8
@pytest.mark.skipif(not HAVE_VOCAB, reason="no vocabulary")
def test_encoding_matches_the_library_and_comes_back(spark):
    import tiktoken

    ranks = encode.load_ranks()
    pat = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    ref, mine, rnd = tiktoken.Encoding("t", pat_str=pat, mergeable_ranks=ranks, special_tokens={}), encode.Encoder(ranks), random.Random(0)
    texts = ["".join(rnd.choice("ab1 \n\t'sdtmlvre. é٣''  -　😀́ſ<|endoftext|>") for _ in range(rnd.randint(0, 20))) for _ in range(5000)]
    texts += ["a" * 3000, " " * 999, "\r\n" * 50, "", "don't we'LL they've 'tis"]
    for t, ids in zip(texts, mine.encode_batch(texts)):
        assert ids == ref.encode_ordinary(t) and mine.decode(ids) == t
    df = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "  ", "z"), (3, "  ", "z"), (None, "Hallo", "ids")], "doc_id long, text string, ids string")
    got = [(r.doc_id, list(r.ids)) for r in encode.encode(df).collect()]
    assert got == [(1, []), (2, []), (3, ref.encode_ordinary("  ")), (3, ref.encode_ordinary("  ")), (None, ref.encode_ordinary("Hallo"))]


def test_schedule_stays_within_one_block():
    rnd = random.Random(4)
    for _ in range(40):
        w = {f"s{i}": rnd.randint(0, 50) for i in range(rnd.randint(1, 9))}
        total = sum(w.values())
        out, served = mix.schedule(w, 600), dict.fromkeys(w, 0)
        for slot, s, k in out:
            assert k == served[s]
            served[s] += 1
            assert all(abs(served[x] - w[x] / total * (slot + 1)) < 1 for x in w)
        assert len(out) == (600 if total else 0)


def test_mixing(spark):
    docs = spark.createDataFrame([(i, "big" if i % 3 else "small", 10) for i in range(300)] + [(900, None, 5), (901, "other", 5), (902, "small", 0)], "doc_id long, source string, n_tokens int")
    targets = spark.createDataFrame([("big", 0.5, 1), ("small", 0.4, 2), ("none", 0.1, 3), (None, 0.5, 1)], "source string, target_share double, max_repeats int")
    texts, report = mix.mixed(docs, targets)
    rep = {r.source: r for r in report.collect()}
    assert set(rep) == {"big", "small", "none"} and rep["none"].mixed_tokens == 0
    assert abs(rep["big"].actual_share - 5 / 9) < 0.02 and abs(rep["small"].actual_share - 4 / 9) < 0.02
    rows = texts.collect()
    assert max(r.use_no for r in rows if r.source == "small") <= 2 and all(r.use_no == 1 for r in rows if r.source == "big") and all(r.slot is not None for r in rows)
    assert len({(r.doc_id, r.use_no) for r in rows}) == len(rows)
    assert mix.mixed(docs.limit(0), targets)[0].count() == 0


# --- problem 9
HINTS = {"Jonas", "Frauke", "Käthe"}


def test_mentions_and_placeholders(spark):
    text = "Hallo zusammen,\n\nDie Karte wirkt.\n\nViele Grüße\nDr. Frauke Haselbrock\nTel. +49 (0)30 23125-403\nMail frauke.haselbrock@lernort.invalid\nFärberallee 104\nIBAN DE60 0000 0000 0029 9633 53"
    found = pii.find([text, None, "", "Auf Platz 4 der Liste steht die Karte. Vgl. Haselbrock 2011, S. 25."], HINTS)
    assert [(text[a:b].split("\n")[0], k) for a, b, k in found[0]] == [("Frauke Haselbrock", "name"), ("+49 (0)30 23125-403", "phone"), ("frauke.haselbrock@lernort.invalid", "email"), ("Färberallee 104", "address"), ("DE60 0000 0000 0029 9633 53", "identity")]
    assert found[1:] == [[], [], []]
    masked = pii.replaced(text, found[0])
    assert "[NAME]" in masked and "Haselbrock" not in masked and masked.startswith("Hallo zusammen,\n\nDie Karte wirkt.")
    docs = spark.createDataFrame([(1, text, "x"), (1, text, "x"), (2, None, "y"), (3, "", "z")], "doc_id long, text string, kind string")
    hints = spark.createDataFrame([(h, "de") for h in sorted(HINTS)] + [(None, "de")], "given_name string, lang string")
    assert pii.mentions(docs, hints).count() == 5
    assert {r.doc_id: r.masked for r in pii.mask(docs, hints).collect()}[2] is None


def test_positions_count_code_points_of_the_stored_text():
    import unicodedata

    text = "😀 Viele Grüße\nKäthe Nüssbrock\n"
    low = unicodedata.normalize("NFD", text)
    for t in (text, low):
        (a, b, k), = pii.find([t], HINTS)[0]
        assert k == "name" and unicodedata.normalize("NFC", t[a:b]) == "Käthe Nüssbrock"


def test_windows_join_over_long_texts():
    filler = "Die Auswertung der Kulturkarte stützt sich auf 104 Fragebögen. " * 6
    texts = [filler[: 300 + i] + "\nRückfragen: frauke.haselbrock@lernort.invalid\n" + filler for i in range(0, 60, 5)]
    for t, f in zip(texts, pii.find(texts, HINTS)):
        assert ("email", t.index("frauke.")) in {(k, a) for a, _, k in f}


def test_gradient_of_the_tagger():
    from annolytics.llm import pii_train

    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) for k, v in pii_train.init(5, rng).items()}
    x, g, y = rng.integers(0, pii.VOCAB, (2, 6)), rng.integers(0, 2, (2, 6)), rng.integers(0, 11, (2, 6))
    _, grad = pii_train.loss_and_grad(p, x, g, y)
    for k in ("Wh", "Wo", "trans"):
        i = tuple(0 for _ in p[k].shape)
        old = p[k][i]
        p[k][i] = old + 1e-3
        hi = pii_train.loss_and_grad(p, x, g, y)[0]
        p[k][i] = old - 1e-3
        lo = pii_train.loss_and_grad(p, x, g, y)[0]
        p[k][i] = old
        assert abs((hi - lo) / 2e-3 - grad[k][i]) < 1e-3


def test_shapes():
    found = {(t, k) for t in ("x@y.org", "annotate@4.2.7", "a(at)b punkt de", "0171-392 0000", "ISBN 978-0-3405-4708-4", "79c Millpond Road", "66d rue Basse", "St.-Nr. 00/267/85174", "Az. 00-374/2025") for _, _, k in pii_rules.shaped(t)}
    assert found == {("x@y.org", "email"), ("a(at)b punkt de", "email"), ("0171-392 0000", "phone"), ("79c Millpond Road", "address"), ("66d rue Basse", "address"), ("St.-Nr. 00/267/85174", "identity")}
