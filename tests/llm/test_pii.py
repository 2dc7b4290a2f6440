"""The tagger of problem 9 on names it was never trained on, its windows and their reconciliation."""

import random

from annolytics.llm import pii, pii_rules, pii_train

HINTS = pii.Hints({"Anna", "Thomas", "Maria", "Emily", "John", "Claire", "Pieter", "Peter"})


def test_recall_on_names_never_trained_on():
    names = pii_train.Names(random.Random(5), pii_train.HELD_GIVEN, pii_train.HELD_FAMILY, 0.0)
    made = [pii_train.frame(names) for _ in range(600)]
    got = pii_train.measure(pii.load(), [t for t, _ in made], [s for _, s in made], HINTS)
    for kind, (recall, precision, n) in got.items():
        assert n > 50 and recall >= 0.93 and precision >= 0.95, (kind, recall, precision, n)
    assert not set(pii_train.HELD_GIVEN) & set(pii_train.GIVEN) and not set(pii_train.HELD_FAMILY) & set(pii_train.FAMILY)


def test_ordinary_names_and_addresses():
    for name in ("Anna Schneider", "Emily Clarke", "Štefan Černý", "Álvaro Núñez", "Anna Maria Schmidt", "Pieter de Vries"):
        for frame in ("Bei {}, Tel. 030 1234567, nachfragen.", "Ich habe gestern mit {} gesprochen.", "Kind regards\n{}\n", "Le dossier est suivi par {}."):
            t = frame.format(name)
            assert [t[a:b] for a, b, k in pii.find([t], HINTS)[0] if k == "name"] == [name], t
    for address in ("Am Alten Markt 5", "221b Baker Street", "12, rue de Rivoli", "Lange Gasse 7a", "Anna-Seghers-Straße 5"):
        t = f"Er wohnt {address}, sagt man."
        assert [(t[a:b], k) for a, b, k in pii.find([t], HINTS)[0]] == [(address, "address")], t


def test_limits_come_from_the_spans():
    t = "Herr Prof. Dr. Müller-Braun kam."
    assert pii.checked(t, [(5, 27, "name")]) == [(15, 27, "name")]
    assert pii.checked(t, [(16, 25, "name")]) == [(15, 27, "name")]
    assert pii.checked("Frau Holle", [(0, 4, "name")]) == []
    assert pii.checked("am 10.5.2013 da", [(3, 12, "phone")]) == []
    assert pii.checked("T (030) 1234-56.", [(3, 14, "phone")]) == [(2, 15, "phone")]


def test_choice_of_places_loses_nothing():
    names = pii_train.Names(random.Random(8))
    filler = "die lage bleibt im ganzen ruhig, und niemand weiß genau, wie es nun weitergehen soll. " * 4
    texts = [filler + pii_train.frame(names)[0] + filler for _ in range(150)]
    chosen, whole = pii.load().spans(texts, HINTS), pii.load().spans(texts, HINTS, everywhere=True)
    a = {(i, *s) for i, x in enumerate(chosen) for s in pii.checked(texts[i], x)}
    b = {(i, *s) for i, x in enumerate(whole) for s in pii.checked(texts[i], x)}
    assert len(a & b) >= 0.97 * len(b)
    for t in texts:  # every labelled place lies in a stretch that is read
        x = pii.Text([t], HINTS)
        lo, hi = x.segments()
        for s, e, _ in pii_rules.shaped(t):
            assert any(p < e and s < q for p, q in zip(lo, hi))


def test_long_texts_have_their_mentions_wherever_windows_meet():
    mention = "Bitte an Peter Fischer, peter.fischer@example.org, Tel. 030 1234567, wenden. "
    for shift in range(0, 260, 37):
        t = "X Y " * 30 + "Haus " * (shift // 5) + mention * 9
        got = [(t[a:b], k) for a, b, k in pii.find([t], HINTS)[0]]
        assert got.count(("Peter Fischer", "name")) >= 8 and got.count(("peter.fischer@example.org", "email")) == 9 and got.count(("030 1234567", "phone")) == 9


def test_reconciliation():
    whole, cut_r, cut_l = (10, 30, "name", 9.0, False, False), (10, 20, "name", 4.0, False, True), (15, 30, "name", 5.0, True, False)
    assert pii.reconciled([cut_r, whole]) == pii.reconciled([whole, cut_r]) == [(10, 30, "name")]
    assert pii.reconciled([cut_l, whole]) == [(10, 30, "name")]
    assert pii.reconciled([cut_r, cut_l]) == [(10, 30, "name")]
    assert pii.reconciled([(0, 9, "phone", 3.0, False, False), (5, 12, "identity", 4.0, False, False), (11, 15, "phone", 2.0, False, False)]) == [(0, 9, "phone"), (11, 15, "phone")]
    assert pii.reconciled([]) == []


def test_unreadable_places():
    assert pii.find([None, "", "  \n", "\ud800".encode("utf-16", "surrogatepass").decode("utf-16", "replace"), "a" * 50_000, "1 " * 20_000], HINTS)[:3] == [[], [], []]


def test_what_is_no_mention():
    for t in ("Die Universität Maria Theresia liegt im Osten.", "Die Robert Bosch Stiftung fördert das.", "Das Anna Schneider Gymnasium ist zu.", "Die Kosten trägt Hohenrode zu 54,2 Prozent.", "Eine Haushaltslücke allein genügt nicht."):
        assert pii.find([t], HINTS) == [[]], t
    assert pii.checked("Ausweis-Nr. PYW28VYRG da", [(12, 21, "identity")]) == [(12, 21, "identity")]
    assert pii.checked("À Rosenbüren, la", [(0, 16, "name")]) == [] and pii.checked("aside 678 euros", [(0, 9, "address")]) == []
