"""Truncation by parser states, and lists of other layouts than the tables' own."""

import pytest

from annolytics.llm import defects as D


@pytest.mark.parametrize("text", [
    "Das ist <b>wichtig und gut.", "Er sagte \"das reicht.", "Er sagte “that is enough.", "Nutze `pip install.", "Das ist **sehr wichtig.", "```\ncode.", "Siehe (Anhang A.",
    "Ein <a href=\"x\">Verweis. Mehr.", "Ein Satz. <div class=", "Er sagte „nun gut.", "<ul><li>eins.</li>", "Ein Satz. <!-- nur", "{\"a\": [1, 2.",
])
def test_what_is_left_open(text):
    assert D.left_open(text) and D.truncation(text)[0] == "cut"


@pytest.mark.parametrize("text", [
    "Ja", "Die Antwort ist 42", "Siehe www.example.org", "Das ist <b>wichtig</b> und gut.", "Er sagte: \"Das reicht.\"", "Er sagte: „Das reicht.“", "Nutze `pip install`.", "Das ist **sehr** wichtig.",
    "```\ncode\n```", "<p>Ein Absatz.<br>Zeile zwei.", "5\" Rohr passt.", "rock 'n' roll.", "snake__case__name ist erlaubt.", "2 < 3 gilt.", "„Außen ‚innen‘ außen“ stimmt.", "a) eins.\nb) zwei.",
    "Ein `Zeichen offen.\n\nNeuer Absatz.", "Alle (fast alle.\n\nNeuer Absatz.",
])
def test_what_is_closed(text):
    assert not D.left_open(text) and D.truncation(text)[0] != "cut"


def test_refusals_in_other_words():
    for a in ("Diese Frage übersteigt mein Wissen.", "Keine Ahnung.", "That is beyond my knowledge.", "Cela dépasse mes connaissances.", "Dat gaat mijn kennis te boven."):
        assert D.judge("Wie viele Schulen gibt es in Neustadt?", a)[0] == "refusal", a
    for n in (1, 38, 39, 400):
        assert D.judge("Wie hoch ist der Turm?", "Dazu kann ich leider keine Auskunft geben. " * n)[0] == "refusal", n
    for n in (1, 5, 40, 4000):
        assert D.judge("Wie hoch ist der Turm?", '<div class="x"></div>' * n)[0] == "empty", n


LISTS = {
    "colon": ["Berlin: 3,6 Mio. Einwohner", "Hamburg: 1,8 Mio. Einwohner", "München: 1,5 Mio. Einwohner", "Köln: 1,1 Mio. Einwohner"],
    "bracket first": ["[A1] Antrag stellen", "[A2] Unterlagen beilegen", "[A3] Gebühr bezahlen", "[A4] Bescheid abwarten"],
    "price": ["Mantel, 49,90 EUR", "Hose, 29,90 EUR", "Schal, 9,90 EUR", "Hemd, 19,90 EUR"],
    "slash": ["Montag / 8-12 Uhr", "Dienstag / 9-13 Uhr", "Mittwoch / 8-12 Uhr", "Freitag / 8-11 Uhr"],
    "plain": ["Schulung der Mitarbeiter", "Aufbau der Verwaltung", "Prüfung der Unterlagen", "Pflege der Bestände"],
}


@pytest.mark.parametrize("bullet", ["- ", "* ", "1. ", "• "])
@pytest.mark.parametrize("name", LISTS)
def test_lists_of_other_layouts(spark, name, bullet):
    rows = LISTS[name]
    whole = ["\n".join(bullet + x for x in rows[:k]) for k in (3, 4)] + ["\n".join(bullet + x for x in rows[::-1])]
    cut = []
    for k in (3, 4):
        last = rows[k - 1]
        places = {len(last) - 2, len(last) - 3, last.find(" ") + 3}
        cut += ["\n".join(bullet + x for x in [*rows[: k - 1], last[:p]]) for p in places]
    data = [(f"w{i}", "Welche gibt es?", "Es gibt:\n" + t, "de") for i, t in enumerate(whole)] + [(f"c{i}", "Welche gibt es?", "Es gibt:\n" + t, "de") for i, t in enumerate(cut)]
    got = {r.record_uuid for r in D.defects(spark.createDataFrame(data, "record_uuid string, query string, answer string, language string")).collect() if r.defect == "truncated"}
    assert not {g for g in got if g[0] == "w"}, got
    assert len(got) >= 0.9 * len(cut) - 1, (name, cut, got)
