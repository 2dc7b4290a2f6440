
from annolytics.llm import defects

Q = "Welche Rolle spielte die Kulturkarte für Pendler in Obertal seit 2014, und wie unterscheidet sie sich von der Sportquote?"
PAIRS = "record_uuid string, query string, answer string"


def test_words_cut_inside_items_of_any_form(spark):
    rows = [
        ("cut", Q, "Die Karte wirkt.\r\n\r\n- Schulung der Mitarbeiter\r\n- Aufbau der Verwalt"),
        ("short", Q, "Die Karte wirkt.\n\n- Schulung der Mitarbeiter\n- Aufbau der Ve"),
        ("whole", Q, "Die Karte wirkt.\n\n- Schulung der Mitarbeiter\n- Aufbau der Verwaltung"),
        ("prose", Q, "Die Verwaltung lobt die Mitarbeiter, und die Verwaltungsreform wirkt."),
    ]
    df = spark.createDataFrame(rows, PAIRS)
    assert {(r.record_uuid, r.defect) for r in defects.defects(df).collect()} == {("cut", "truncated"), ("short", "truncated")}
    assert {r.record_uuid for r in defects.defects(df.where("record_uuid <> 'prose'"), words_of=df).collect()} == {"cut", "short"}


def test_long_defects_have_no_limit_of_length():
    decline = "Zu dieser Frage kann ich leider keine Auskunft geben. Dazu liegen mir keine Informationen vor. "
    assert defects.judge(Q, decline * 30)[0] == "refusal"
    assert defects.judge(Q, decline * 30 + "Die Karte wirkt in Obertal seit 2014 sehr gut.")[0] is None
    assert defects.judge(Q, '<div class="antwort-block antwort-block-leer rahmen">\n' * 12)[0] == "empty"
    assert defects.judge(Q, "keine Angabe\n" * 3)[0] == defects.judge(Q, "keine Angabe, keine Angabe, keine Angabe")[0] == "empty"
    assert defects.judge(Q, "| n/a | n/a |\n" * 40)[0] == "empty"
    assert defects.judge(Q, "1. \n2. \n3. \n10. Die Karte wirkt.")[0] != "empty" and not defects.is_empty("42.") and defects.is_empty("1. keine Angabe")
    assert defects.judge(Q, "\n".join([Q] * 7))[0] == defects.judge(Q, "\n".join([Q] * 500))[0] == "copy"
    # long sentences take another way to the same verdict
    for s in ("I regret that we " + "really " * 500 + "cannot say", "ich " + "und so weiter " * 500 + "weiß es nicht", "wir " * 2000):
        assert defects.declines(s) == bool(defects.DECLINE.search(s))


def test_tiles_against_all_tilings():
    import random

    rnd = random.Random(6)
    for _ in range(300):
        q, a = [rnd.choice("abc") for _ in range(rnd.randint(1, 9))], [rnd.choice("abcd") for _ in range(rnd.randint(1, 14))]
        best = [0]
        for i in range(1, len(a) + 1):
            runs = [best[j] + i - j for j in range(i - 2) if " ".join(a[j:i]) in " ".join(q)]
            best.append(max([best[-1], *runs]))
        assert defects.tile_cover(a, q) == best[-1] / len(a)


def test_schedule_gives_every_source_all_its_blocks():
    import random

    from annolytics.llm import mix

    rnd = random.Random(8)
    for _ in range(200):
        quota = {f"s{i}": rnd.choice([0, rnd.randint(1, 30), rnd.randint(1, 3000)]) for i in range(rnd.randint(1, 12))}
        block = rnd.randint(1, 60)
        need, total = {s: -(-q // block) for s, q in quota.items()}, sum(quota.values())
        out = mix.schedule(quota, sum(need.values()), need)
        assert [x[0] for x in out] == list(range(sum(need.values())))
        assert {(s, k) for _, s, k in out} == {(s, k) for s, n in need.items() for k in range(n)}
        served = dict.fromkeys(quota, 0)
        for slot, s, k in out:
            assert k == served[s]
            served[s] += 1
            if any(served[x] == need[x] for x in quota if quota[x]):
                break
            assert all(abs(served[x] - quota[x] / total * (slot + 1)) < 1 for x in quota)


def test_every_text_of_the_mix_has_a_slot(spark):
    from annolytics.llm import mix

    docs = [(i, s, 7) for s, n in (("a", 400), ("b", 100), ("c", 3), ("d", 2), ("e", 1)) for i in range(n)]
    docs = spark.createDataFrame([(n, s, t) for n, (_, s, t) in enumerate(docs)], "doc_id long, source string, n_tokens int")
    shares = spark.createDataFrame([("a", 0.6, 1), ("b", 0.2, 1), ("c", 0.1, 1), ("d", 0.06, 1), ("e", 0.04, 1)], "source string, target_share double, max_repeats int")
    for blocks in (3, 10, 40):
        rows = mix.mixed(docs, shares, blocks=blocks)[0].collect()
        assert {r.source for r in rows} == set("abcde") and all(r.slot is not None for r in rows)


def test_language_of_undecided_queries_and_scripts(spark):
    english = "The report from the town shows that the card works for commuters and that it is used by many of them."
    greek = "Η κάρτα λειτουργεί πολύ καλά στην πόλη in Obertal και χρησιμοποιείται από πολλούς."
    assert defects.judge("Kulturkarte Obertal 2014", english) == (None, None)
    for named in ("de", " DE-de", "German", "deutsch"):
        assert defects.judge("Kulturkarte Obertal 2014", english, named)[0] == "other_language"
    assert defects.judge("Kulturkarte Obertal 2014", english, "en")[0] is defects.judge("Kulturkarte Obertal 2014", english, "?")[0] is None
    assert defects.judge(Q, greek)[0] == defects.judge("Kulturkarte Obertal", greek, "de")[0] == "other_language"
    assert defects.judge("Kulturkarte Obertal", greek, "el")[0] is None
    df = spark.createDataFrame([("a", "Kulturkarte Obertal", english, "de"), ("b", "Kulturkarte Obertal", english, "EN"), ("c", None, english, "de")], PAIRS + ", language string")
    assert {(r.record_uuid, r.defect) for r in defects.defects(df).collect()} == {("a", "other_language"), ("c", "other_language")}


def test_two_large_groups_leave_the_shares_in_reach(spark):
    from annolytics.llm import related

    g = spark.createDataFrame([("first", 300), ("second", 257)] + [(f"g{i}", 1) for i in range(443)], "group_uuid string, size long")
    rows = related.deal(g).collect()
    got = {k: sum(r.size for r in rows if r.split == k) for k, _ in related.SHARES}
    assert len(rows) == 445 and {r.split for r in rows if r.size > 1} == {"train"}
    assert abs(got["train"] - 800) <= 10 and abs(got["validation"] - 100) <= 10 and abs(got["test"] - 100) <= 10
