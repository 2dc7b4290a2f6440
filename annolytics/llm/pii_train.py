"""Trains the tagger of pii.py: python -m annolytics.llm.pii_train DOCUMENTS NAME_HINTS OUT.npz [STEPS].

Labels. Everything but names: exact shapes (pii_rules.shaped). Names: two lists grown from the texts themselves. Words
behind forms of address and behind given names of the hints are family names where that is seen twice or more; words
before family names are given names where that is seen with two or more of them; two rounds. No part of a name is given.

So that the network learns contexts and forms rather than these texts' names, most names are exchanged for common ones
of four languages (GIVEN, FAMILY) or made-up ones, numbers for others, streets for made-up ones; frames of everyday
sentences (FRAMES), names inside institutions among them, are mixed in. HELD_GIVEN and HELD_FAMILY are never trained on;
with them the recall of unseen names is measured, on documents that are held out as well. The sample is bounded (SAMPLE).
"""

from __future__ import annotations

import random
import re
import sys
import time
from collections import Counter, defaultdict
from multiprocessing import Pool

import numpy as np
import pandas as pd

from annolytics.llm import pii, pii_rules as R

SAMPLE, BATCH, LENGTH, WORKERS, RATE, HIDDEN = 10_000, 32, 96, 8, 1e-2, 24

# fixed values: common given and family names of German, English, French and Dutch, to be put in the place of others
GIVEN = """Anna Maria Peter Thomas Sabine Michael Andreas Stefan Ursula Monika Claudia Martin Daniel Julia Christian Sandra Petra Karin Helga Wolfgang Klaus Jürgen Dieter Manfred Uwe Renate Birgit Gabriele Susanne Heike
Nicole Stefanie Melanie Christine Felix Leon Paul Lukas Finn Elias Emma Mia Hannah Lena Sophie Lea Ben Noah Matthias Markus Oliver Florian Jan Sebastian Philipp Emily James John William Mary Elizabeth Sarah Charles
Thomas David Richard Susan Linda Patricia Jennifer Jessica Karen Nancy Lisa Margaret Ashley Donald Steven Kevin Brian George Edward Pierre Jean Marie Luc Camille Chloé Nathalie Isabelle François Michel Philippe Alain
Jacques Sylvie Valérie Élodie Mathilde Julien Antoine Étienne Johan Pieter Willem Kees Jeroen Sander Daan Sanne Femke Lotte Anouk Marieke Hendrik Gerrit Fatma Mehmet Mustafa Zeynep Aleksandra Piotr Ivan Olga Álvaro José
Štefan Łukasz Jürgen-Peter Anne-Marie Karl-Friedrich Eva-Maria Jean-Pierre Marie-Claire""".split()
FAMILY = """Müller Schmidt Schneider Fischer Weber Meyer Wagner Becker Schulz Hoffmann Schäfer Koch Bauer Richter Klein Wolf Schröder Neumann Schwarz Zimmermann Braun Krüger Hofmann Hartmann Lange Schmitt Werner Krause Meier
Lehmann Schmid Schulze Maier Köhler Herrmann König Walter Mayer Huber Kaiser Fuchs Peters Lang Scholz Möller Weiß Jung Hahn Schubert Vogel Friedrich Keller Günther Frank Berger Winkler Roth Beck Lorenz Baumann Franke
Albrecht Schuster Simon Ludwig Böhm Winter Kraus Martin Schumacher Krämer Vogt Stein Jäger Otto Sommer Groß Seidel Heinrich Brandt Haas Schreiber Graf Dietrich Ziegler Kuhn Kühn Pohl Engel Horn Busch Bergmann Thomas
Smith Jones Taylor Brown Williams Wilson Johnson Davies Robinson Wright Thompson Evans Walker White Roberts Green Hall Wood Jackson Clarke Hughes Edwards Hill Cooper Ward Turner Carter Baker Parker Cook Dubois Durand
Moreau Laurent Lefebvre Leroy Roux Fournier Girard Lambert Rousseau Mercier Jansen Bakker Visser Smit Mulder Bos Vos Dekker Dijkstra Hendriks Yılmaz Kaya Nowak Kowalski Novák Černý Núñez García O'Brien McDonald
Müller-Lüdenscheidt Schmidt-Braun""".split()
# fixed values: names that are only used to measure the recall of unseen names
HELD_GIVEN = "Brigitte Katrin Heinz Ralf Tanja Jörg Ingrid Lothar Nadine Ole Greta Theo Harriet Simon Victoria Eleanor Oscar Aurélie Bernard Margaux Guillaume Ruben Mieke Joris Noor Bram Selin Hakan Marek Agnieszka".split()
HELD_FAMILY = """Lindner Arnold Kramer Sauer Ernst Ullrich Pfeiffer Voigt Barth Heinze Reuter Noack Thiele Eberhardt Wilke Fleischer Morgan Bennett Collins Murphy Sutherland Fletcher Blanchard Chevalier Garnier Perrin
Verhoeven Kuipers Hoekstra Scholten Demir Aydın Zieliński Dvořák Ruiz""".split()

# fixed values: everyday sentences; N a name, S a family name, G a given name, I an institution, A an address, E a mail
# address, T a telephone number, D an identity number
FRAMES = """Bei N, Tel. T, melden.|Ansprechpartnerin ist N.|N wohnt in der A.|Sehr geehrte Frau S,|Sehr geehrter Herr S,|Herr S und Frau S kamen.|Bitte wenden Sie sich an N (E).|Von: N <E>|Cc: N; N; N|Der Brief ging an N, A, 12345 Neustadt.
N sagte gestern, die I werde helfen.|Die I fördert das Projekt.|An der I lehrt N.|Gegründet wurde die I 1998.|N, G und die anderen|Der Vertrag mit N läuft aus.|Protokoll: N|gez. N|i. A. N|Dear Mr S,|Dear N,|Please contact N on T or at E.
N wrote to Mrs S about it.|The I was founded in 1901.|N lives at A.|Signed by N on Monday.|Meet N, our new colleague.|Professor S teaches at I.|Madame S vous répondra.|Contactez N au T.|N habite A.|M. S est absent.|L'I soutient N.
Mevrouw S belt u terug.|De heer S woont A.|Neem contact op met N via E.|N werkt bij I.|Anruf von N unter T.|Rückfragen an N, T.|Anschrift: A|Adresse: A, 04109 Leipzig|Der Umzug in die A ist im Mai.|Die Sitzung ist in der A.
Wie N mitteilt, bleibt die A gesperrt.|Teilnehmer: N, N, N und N|Autorin: S, G|S, G: Bericht über die Lage. Berlin 2010.|Kontakt: N - T - E|Telefon T, Fax T|Mobil: T|E-Mail: E|Schreiben Sie an E oder rufen Sie T an.
Steuer-ID: D|Die IBAN lautet D.|Reisepass D, ausgestellt in Bonn|Ausweisnummer D liegt vor.|Sozialversicherungsnummer D|My passport number is D.|National Insurance number: D|SSN D|Numéro de sécurité sociale : D|BSN D|N, Steuernummer D|Konto D bei der Sparkasse
Frau N hat angerufen.|Herr N ist verreist.|Le dossier est suivi par N.|N, A, 12345 Altstadt, Tel.: T, E|Mme N sera présente.|Mr N will chair the meeting.|De brief is van N.|N (56) ist neu im Amt.|Der Antrag wurde von N vorgelegt.|Selon N, tout va bien.|Er wohnt A in Köln.|A, 10115 Berlin|They moved to A, London.|Elle vit A à Lyon.|A Amsterdam|N|N|A|Die Wohnung A ist frei.
Wir haben mit N telefoniert.|Das Treffen mit N fällt aus.|Ein Geschenk für N ist da.|Wir sprachen über N und die Folgen.|Ohne N geht es nicht.|Heute ist N krank.|I spoke with N yesterday.|A letter for N arrived.|Nous avons parlé avec N hier.|Une lettre pour N.
Ik heb met N gebeld.|Dat is voor N bedoeld.|Gestern hat N gekündigt, und N übernimmt.|Das weiß N am besten.|N, A, T, E, D|Die Tochter von N heißt G.|Mail an E, danke|E|T|Schreib mir: E
N leitet die Abteilung Haushalt und Personal.|Am Montag sprach N mit Dr. S.|Frau Dr. S ist verreist.|Herrn Prof. Dr. S zur Kenntnis|G kommt später.|Grüße von G|Der Bundestag hat das Gesetz beschlossen.|Neue Regelung für das Ehrenamt
Zentrale Ergebnisse der Studie|Stadt Leipzig, Amt für Statistik|Bundesministerium für Bildung und Forschung|Europäische Union und Vereinte Nationen|Der Rat von Neustadt tagt.|Haus der Jugend, Raum 12|Tabelle 4 zeigt Ort und Zeit.""".replace("\n", "|").split("|")
_HEADS = "Universität Hochschule Stiftung Akademie Schule Grundschule Gesamtschule Klinik Bibliothek Kirche Firma Gesellschaft Kanzlei Verlag Haus Preis Institut Zentrum Université Fondation Lycée Stichting Museum".split()
_TAILS = "Stiftung Universität Schule Institut Preis Haus Gymnasium Foundation University Institute Museum Library College School Trust Verlag Klinik Gesellschaft Stadion Platz Award".split()

# fixed values: words of greeting, which are no given names
GREETINGS = "hallo hello dear bonjour lieber liebe cher chère beste guten tag dag".split()

_SYL = "ba be bi bo bu da de do dra el fa fe flo ga ger go ha hei ho in ja ka ker kla ko la lei li lo ma mei mo na nei no o pe pfei ra rei ri ro sa schu sei si stei ta te ti to u va ve wa wei wi zo".split()
_END = "er mann ner ke le stein berg ski ert ing hof beck el lich ers sen bach son ton ley ier eau ard oux stra sma hagen horst loh wig ow itz".split()
_STREETS = "straße str. weg platz allee gasse ring ufer damm steig pfad promenade".split()
GAP = r"[ \t ]{1,3}"
WORD = rf"(?:[^\W\d_a-zß-öø-ÿ][\w’']*(?:-[^\W\d_a-zß-öø-ÿ][\w’']*)*)"


def name_lists(texts: list[str], hints: set[str]) -> tuple[set[str], set[str]]:
    """(given, family): names that the texts show to be such, grown from the hints and the forms of address."""
    no = {x for w in (*R.FUNCTION_WORDS, *GREETINGS) for x in (w, w.capitalize())}
    titled = re.compile(rf"(?<![\w@.+\-]){R.TITLE}(?:[\s\-]*{R.TITLE})*{GAP}(?:({WORD}){GAP})?(?:{R.PARTICLE}{GAP})?({WORD})(?![\w@\-])")
    pair = re.compile(rf"(?<![\w@.+\-])(?=({WORD})(?:{GAP}[A-Z]\.)?(,?){GAP}(?:{R.PARTICLE}{GAP})?({WORD})(?![\w@\-]))")
    seen: dict[str, set[str]] = defaultdict(set)  # family name: what stood before it
    for t in texts:
        for m in titled.finditer(t):
            if m.group(2) not in no and not re.fullmatch(R.TITLE, m.group(2)):
                seen[m.group(2)].add("title:" + (m.group(1) or ""))
    pairs = Counter()
    for t in texts:
        for a, comma, b in pair.findall(t):
            if a not in no and b not in no and not re.fullmatch(R.TITLE, a) and not re.fullmatch(R.TITLE, b):
                pairs[(b, a) if comma else (a, b)] += 1
    given = set(hints)
    for _ in range(3):
        around = defaultdict(set)
        for (a, b), _n in pairs.items():
            if a in given:
                around[b].add(a)
        family = {w for w, x in seen.items() if len(x | around[w]) > 1} | {w for w, x in around.items() if len(x) > 1}
        family |= {w for w in seen if "-" in w} | {w for w in around if "-" in w and any(p in family for p in w.split("-"))}
        family -= given
        before = defaultdict(set)
        for (a, b), _n in pairs.items():
            if b in family:
                before[a].add(b)
        given = hints | {w for w, x in before.items() if len(x) > 2 and w not in family}
    return given, family


def name_labels(text: str, given: set[str], family: set[str]) -> list[tuple[int, int]]:
    low_g, low_f = {g.lower() for g in given}, {f.lower() for f in family}
    is_g, is_f = (lambda w: w.lower() in low_g), (lambda w: w.lower() in low_f or "-" in w and any(p in low_f for p in w.lower().split("-")))
    out: list[tuple[int, int]] = []
    for rx, two in _NAME_RX:
        for m in rx.finditer(text):
            a, b = m.span("x")
            fits = is_g(m.group("g")) and is_f(m.group("s")) if two else m.group("s").lower() not in low_g
            if fits and not any(a < y and x < b for x, y in out):
                out.append((a, b))
    return out


_NO_MORE = r"(?![\w@\-]|\.\w)"
_NAME_RX = [
    (re.compile(rf"(?<![\w@.+\-])(?=(?P<x>(?:{R.PARTICLE}{GAP})?(?P<s>{WORD}),{GAP}(?P<g>{WORD})){_NO_MORE})"), True),
    (re.compile(rf"(?<![\w@.+\-])(?=(?P<x>(?P<g>{WORD})(?:{GAP}[A-Z]\.)?(?:{GAP}{R.PARTICLE}){{0,2}}{GAP}(?P<s>{WORD})){_NO_MORE})"), True),
    (re.compile(rf"(?<![\w@.+\-]){R.TITLE}(?:[\s\-]*{R.TITLE})*{GAP}(?P<x>(?:{R.PARTICLE}{GAP})?(?!{R.TITLE})(?P<s>{WORD})){_NO_MORE}(?!{GAP}{WORD})"), False),
]


def label(text: str, given: set[str], family: set[str]) -> list[tuple[int, int, str]]:
    spans = R.shaped(text)
    spans += [(a, b, "name") for a, b in name_labels(text, given, family) if not any(a < y and x < b for x, y, _ in spans)]
    return sorted(spans)


def tags(n: int, spans) -> np.ndarray:
    t = np.zeros(n, np.int8)
    for a, b, k in spans:
        i = R.KINDS.index(k)
        t[a], t[a + 1 : b] = 1 + 2 * i, 2 + 2 * i
    return t


def made_up(rnd: random.Random) -> str:
    return ("".join(rnd.choice(_SYL) for _ in range(rnd.randint(1, 2))) + rnd.choice(_END)).capitalize()


class Names:
    """Names to draw: from the lists, or made up."""

    def __init__(self, rnd: random.Random, given=GIVEN, family=FAMILY, invent: float = 0.35):
        self.rnd, self.g, self.f, self.invent = rnd, given, family, invent

    def given(self) -> str:
        return made_up(self.rnd) if self.rnd.random() < self.invent / 3 else self.rnd.choice(self.g)

    def family(self) -> str:
        one = lambda: made_up(self.rnd) if self.rnd.random() < self.invent else self.rnd.choice(self.f)
        return f"{one()}-{one()}" if self.rnd.random() < 0.06 else one()

    def name(self) -> str:
        r, g, f = self.rnd.random(), self.given(), self.family()
        if self.rnd.random() < 0.08:
            f = self.rnd.choice(("von", "van", "de", "zu", "van der", "von der")) + " " + f
        if r < 0.05:
            g += " " + self.rnd.choice("ABDEFGHJKLMPRSTW") + "."
        elif r < 0.11:
            g += " " + self.given()
        elif r < 0.14:
            g = self.rnd.choice("ABDEFGHJKLMPRSTW") + "."
        elif r < 0.17:
            f = f.upper()
        return f"{f}, {g}" if self.rnd.random() < 0.1 else f"{g} {f}"

    def institution(self) -> str:
        r, inner = self.rnd.random(), f"{self.given()} {self.family()}"
        if r < 0.4:
            return f"{self.rnd.choice(_HEADS)} {inner}"
        return f"{inner} {self.rnd.choice(_TAILS)}" if r < 0.6 else inner.replace(" ", "-") + "-" + self.rnd.choice(_TAILS)

    def address(self) -> str:
        r, n, w = self.rnd.random(), str(self.rnd.randint(1, 250)), made_up(self.rnd)
        n += self.rnd.choice(("", "", "", "", "a", " b"))
        big = self.rnd.choice(("Alten", "Neuen", "Großen", "Kleinen", "Langen", "Hohen"))
        if r < 0.06:
            return f"{self.rnd.choice(('Am', 'Zum', 'An der', 'Im'))} {big} {self.rnd.choice(('Markt', 'Brunnen', 'Graben', 'Hof', 'Tor', 'Kirche', w))} {n}"
        if r < 0.12:
            return f"{big[:-1]} {self.rnd.choice(('Gasse', 'Straße', 'Allee', 'Zeile'))} {n}"
        if r < 0.16:
            return f"{n}{self.rnd.choice('abc')} {made_up(self.rnd)} {self.rnd.choice(('Street', 'Road', 'Lane', 'Court'))}"
        if r < 0.45:
            return f"{self.rnd.choice((w, self.family()))}{self.rnd.choice(_STREETS)} {n}"
        if r < 0.6:
            return f"{self.rnd.choice((w, self.given() + '-' + self.family()))}-{self.rnd.choice(('Straße', 'Platz', 'Weg', 'Allee', 'Ring'))} {n}"
        if r < 0.68:
            return f"{self.rnd.choice(('Am', 'Im', 'An der', 'Zur', 'Auf dem', 'Unter den'))} {w} {n}"
        if r < 0.75:
            return f"{w}er {self.rnd.choice(('Straße', 'Weg', 'Allee', 'Platz'))} {n}"
        if r < 0.88:
            return f"{n} {w} {self.rnd.choice(('Street', 'Road', 'Lane', 'Avenue', 'Close', 'Drive', 'Square'))}"
        if r < 0.95:
            return f"{n}{self.rnd.choice((', ', ' '))}{self.rnd.choice(('rue', 'avenue', 'place', 'boulevard', 'chemin'))} {self.rnd.choice(('de la ', 'du ', 'des ', 'de ', ''))}{w}"
        return f"{w}{self.rnd.choice(('straat', 'laan', 'plein', 'kade', 'gracht', 'weg', 'dijk'))} {n}"

    def mail(self) -> str:
        at, dot = self.rnd.choice((("@", "."),) * 6 + ((" (at) ", "."), ("[at]", "[dot]"), (" at ", " dot "), (" at ", ".")))
        local = f"{self.given()}{self.rnd.choice('._-')}{self.family()}".lower().replace(" ", "")
        return local + at + made_up(self.rnd).lower() + dot + self.rnd.choice(("de", "com", "org", "net", "fr", "example"))

    def phone(self) -> str:
        form = self.rnd.choice(("030 #######", "0### / ######", "+49 ### #######", "+49 (0)## ####-###", "(0##) ######", "0###-#######", "0## ## ## ## ##", "+44 20 #### ####", "+33 # ## ## ## ##", "0049 ## #####"))
        return re.sub("#", lambda m: str(self.rnd.randint(1, 9)), form)

    def identity(self) -> str:
        """A number of a common form: # a digit, A a letter."""
        forms = "## ### ### ###|###########|##/###/###/###|###/###/#####|DE## #### #### #### #### ##|DE####################|NL## AAAA #### #### ##|A########|A##A##A##|AA ## ## ## A|AA######A|###-##-####|## ###### A ###|# ## ## ## ### ###|#########"
        return re.sub("#|A", lambda m: str(self.rnd.randint(0, 9)) if m.group() == "#" else self.rnd.choice("ABCFGHJKLMNPRTVWXYZ"), self.rnd.choice(forms.split("|")))


_SLOT = re.compile(r"(?<![^\W_])[NSGIAETD](?![^\W_'’.\-])|(?<=L')I|(?<![^\W_])[NSGIAETD](?=[.'’](?:\s|$))")


def frame(names: Names) -> tuple[str, list[tuple[int, int, str]]]:
    """One to three everyday sentences with their spans."""
    out, spans, size = [], [], 0
    for _ in range(names.rnd.randint(1, 3)):
        text, at = names.rnd.choice(FRAMES), 0
        for m in _SLOT.finditer(text):
            s = m.group()
            piece = {"N": names.name, "S": names.family, "G": names.given, "I": names.institution, "A": names.address, "E": names.mail, "T": names.phone, "D": names.identity}[s]()
            out.append(text[at : m.start()])
            size += m.start() - at
            titled = s == "S" and re.search(rf"(?:{R.TITLE}|heer)\s?$", "".join(out)[-20:])
            both = s == "S" and text[m.end() : m.end() + 3] == ", G" and text[m.end() + 3 : m.end() + 4] in ("", ":")
            k = {"N": "name", "A": "address", "E": "email", "T": "phone", "D": "identity"}.get(s) or ("name" if titled or both else None)
            if s == "G" and text[max(0, m.start() - 3) : m.start()] == "S, ":
                spans[-1] = (spans[-1][0], size + len(piece), "name")
                k = None
            if k:
                spans.append((size, size + len(piece), k))
            out.append(piece)
            size += len(piece)
            at = m.end()
        out.append(text[at:])
        size += len(text) - at
        sep = names.rnd.choice((" ", "\n", "\n", "\n\n"))
        out.append(sep)
        size += len(sep)
    return "".join(out), spans


_ID_DIGITS = re.compile(r"\d")


def exchange(text: str, spans, names: Names, given: set[str], part: float):
    """A copy of the text in which names, numbers and streets are others."""
    rnd = names.rnd
    out, new, at, shift = [], [], 0, 0
    for a, b, k in spans:
        piece = text[a:b]
        if rnd.random() < part:
            if k == "name":
                words = re.split(rf"(,?{GAP})", piece)
                for i in range(0, len(words), 2):
                    w = words[i]
                    if not w[:1].isupper() or len(w) < 3 or re.fullmatch(R.PARTICLE, w, re.I):
                        continue
                    fresh = names.given() if w in given or w.capitalize() in given else names.family()
                    words[i] = fresh.upper() if w.isupper() else fresh
                piece = "".join(words)
            elif k in ("phone", "identity"):
                piece = _ID_DIGITS.sub(lambda m: m.group() if m.start() < 2 else str(rnd.randint(0, 9)), piece)
            elif k == "address" and rnd.random() < 0.5:
                piece = names.address() if rnd.random() < 0.5 else re.sub(r"\d+", lambda m: str(rnd.randint(1, 199)), piece)
            elif k == "email" and rnd.random() < 0.4:
                piece = names.mail()
        out += [text[at:a], piece]
        new.append((a + shift, a + shift + len(piece), k))
        shift += len(piece) - (b - a)
        at = b
    text = "".join(out) + text[at:]
    if rnd.random() < 0.05:  # every blank twice
        wide = np.concatenate([[0], np.cumsum([c == " " for c in text])])
        text, new = text.replace(" ", "  "), [(int(a + wide[a]), int(b + wide[b]), k) for a, b, k in new]
    return text, new


#: How often a round shows the texts that hold a kind; the rarer ones are shown in several forms.
SHOWN = {"email": 2, "phone": 3, "identity": 5, "address": 3, "name": 1}


def windows(texts, all_spans, hints, names: Names, given):
    """One round of (ids, flags, tags) windows: around spans, in other places where a mention could be, and frames."""
    X, G, Y = [], [], []
    rnd, todo = names.rnd, []
    for t, spans in zip(texts, all_spans):
        for _ in range(max((SHOWN[k] for _, _, k in spans), default=1)):
            todo.append(exchange(t, spans, names, given, 0.7) if spans else (t, spans))
    todo += [frame(names) for _ in range(len(texts) // 3)]
    for t, spans in todo:
        x = pii.Text([t], hints)
        y = tags(len(t), spans)
        starts = {max(0, a - rnd.randint(8, LENGTH - 24)) for a, _, _ in spans}
        lo, hi = x.segments()
        free = [int(s) for s in lo if not any(a < s + LENGTH and s < b for a, b, _ in spans)]
        starts |= set(rnd.sample(free, min(len(free), 3)))
        for s in starts:
            row = np.zeros((3, LENGTH), np.int16)
            k = min(LENGTH, len(t) - s)
            row[0, :k], row[1, :k], row[2, :k] = x.ids[s : s + k], x.flags[s : s + k], y[s : s + k]
            if row[2, 0] and row[2, 0] % 2 == 0:
                row[2, 0] -= 1
            X.append(row[0])
            G.append(row[1])
            Y.append(row[2])
    return np.array(X), np.array(G), np.array(Y)


def lse(x, axis):
    m = x.max(axis, keepdims=True)
    return (m + np.log(np.exp(x - m).sum(axis, keepdims=True))).squeeze(axis)


def loss_and_grad(p, x, g, y):
    """CRF negative log-likelihood per window and its gradient; backpropagation through both directions."""
    B, T = x.shape
    H, K = p["Wh"].shape[1], len(p["b"])
    xt, gt, yt = x.T, g.T, y.T.astype(np.int64)
    pre = np.stack([p["emb"][0][xt] + p["hint"][0][gt], (p["emb"][1][xt] + p["hint"][1][gt])[::-1]])  # 2,T,B,4H
    h = np.zeros((2, B, H), np.float32)
    c = np.zeros((2, B, H), np.float32)
    hs, cs, gates = np.empty((T, 2, B, H), np.float32), np.empty((T, 2, B, H), np.float32), np.empty((T, 2, B, 4 * H), np.float32)
    for t in range(T):
        z = np.tanh(pre[:, t] + h @ p["Wh"])
        z[..., : 3 * H] = 0.5 + 0.5 * z[..., : 3 * H]
        c = z[..., H : 2 * H] * c + z[..., :H] * z[..., 3 * H :]
        h = z[..., 2 * H : 3 * H] * np.tanh(c)
        hs[t], cs[t], gates[t] = h, c, z
    em = hs[:, 0] @ p["Wo"][0] + hs[::-1, 1] @ p["Wo"][1] + p["b"]  # T,B,K
    A = p["trans"]
    alpha = np.empty_like(em)
    alpha[0] = em[0] + p["start"]
    for t in range(1, T):
        alpha[t] = lse(alpha[t - 1][:, :, None] + A[None], 1) + em[t]
    logz = lse(alpha[-1], 1)
    beta = np.zeros_like(em)
    dA = np.zeros_like(A)
    for t in range(T - 2, -1, -1):
        nxt = em[t + 1] + beta[t + 1]
        m = A[None] + nxt[:, None]
        beta[t] = lse(m, 2)
        dA += np.exp(alpha[t][:, :, None] + m - logz[:, None, None]).sum(0)
    post = np.exp(alpha + beta - logz[None, :, None])
    b_i, t_i = np.meshgrid(np.arange(B), np.arange(T))
    gold = em[t_i, b_i, yt].sum() + p["start"][yt[0]].sum() + A[yt[:-1], yt[1:]].sum()
    loss = (logz.sum() - gold) / B
    dem = post
    dstart = post[0].sum(0)
    np.subtract.at(dstart, yt[0], 1)
    np.subtract.at(dA, (yt[:-1], yt[1:]), 1)
    dem[t_i, b_i, yt] -= 1
    dem = dem.astype(np.float32)
    gr = {k: np.zeros_like(v) for k, v in p.items()}
    gr["trans"], gr["start"], gr["b"] = dA.astype(np.float32), dstart.astype(np.float32), dem.sum((0, 1))
    gr["Wo"][0] = hs[:, 0].reshape(-1, H).T @ dem.reshape(-1, K)
    gr["Wo"][1] = hs[::-1, 1].reshape(-1, H).T @ dem.reshape(-1, K)
    dh_out = np.stack([dem @ p["Wo"][0].T, (dem @ p["Wo"][1].T)[::-1]], 1)  # T,2,B,H
    dh, dc = np.zeros((2, B, H), np.float32), np.zeros((2, B, H), np.float32)
    dpre = np.empty((2, T, B, 4 * H), np.float32)
    WhT = p["Wh"].transpose(0, 2, 1)
    for t in range(T - 1, -1, -1):
        z, th = gates[t], np.tanh(cs[t])
        i, f, o, u = z[..., :H], z[..., H : 2 * H], z[..., 2 * H : 3 * H], z[..., 3 * H :]
        dh = dh + dh_out[t]
        dc = dc + dh * o * (1 - th * th)
        prev_c = cs[t - 1] if t else 0.0
        d = np.concatenate([dc * u * i * (1 - i) * 2, dc * prev_c * f * (1 - f) * 2, dh * th * o * (1 - o) * 2, dc * i * (1 - u * u)], -1)
        dpre[:, t] = d
        if t:
            gr["Wh"] += hs[t - 1].transpose(0, 2, 1) @ d
        dh, dc = d @ WhT, dc * f
    dpre[1] = dpre[1, ::-1].copy()
    for k in range(2):
        flat = dpre[k].reshape(-1, 4 * H)
        order = np.argsort(xt.reshape(-1), kind="stable")
        sx = xt.reshape(-1)[order]
        first = np.flatnonzero(np.concatenate([[True], sx[1:] != sx[:-1]]))
        gr["emb"][k][sx[first]] = np.add.reduceat(flat[order], first)
        for v in range(len(p["hint"][k])):
            gr["hint"][k][v] = flat[gt.reshape(-1) == v].sum(0)
    return loss, {k: v / B for k, v in gr.items()}


def init(hidden: int, rng) -> dict[str, np.ndarray]:
    K = 1 + 2 * len(R.KINDS)
    p = {
        "emb": rng.normal(0, 0.1, (2, pii.VOCAB, 4 * hidden)), "hint": rng.normal(0, 0.1, (2, 2, 4 * hidden)), "Wh": rng.normal(0, 1 / np.sqrt(hidden), (2, hidden, 4 * hidden)) * 0.5,
        "Wo": rng.normal(0, 0.2, (2, hidden, K)), "b": np.zeros(K), "trans": np.zeros((K, K)), "start": np.zeros(K),
    }
    p["emb"][:, :, hidden : 2 * hidden] += 0.5  # gates begin by remembering
    return {k: v.astype(np.float32) for k, v in p.items()}


def _work(args):
    return loss_and_grad(*args)


def measure(model: pii.Model, texts, spans, hints) -> dict[str, tuple[float, float, int]]:
    """kind: recall and precision of (start, kind), number of labels; with the check behind the tagger."""
    hit = Counter()
    for t, want_spans, got in zip(texts, spans, model.spans(list(texts), hints)):
        have_all = pii.checked(t, got)
        for k in R.KINDS:
            w, h = {a for a, _, x in want_spans if x == k}, {a for a, _, x in have_all if x == k}
            hit[k, "both"] += len(w & h)
            hit[k, "want"] += len(w)
            hit[k, "have"] += len(h)
    return {k: (round(hit[k, "both"] / max(1, hit[k, "want"]), 4), round(hit[k, "both"] / max(1, hit[k, "have"]), 4), hit[k, "want"]) for k in R.KINDS}


def main(docs: str, hints_path: str, out: str, steps: int = 2000, hidden: int = HIDDEN) -> None:
    rnd, rng = random.Random(7), np.random.default_rng(7)
    hint_names = {h.strip() for h in pd.read_parquet(hints_path)["given_name"].dropna()}
    texts = pd.read_parquet(docs, columns=["text"])["text"].dropna().drop_duplicates().head(SAMPLE)
    texts = [R.composed(t)[0] for t in texts if t.strip()]
    given, family = name_lists(texts, hint_names)
    spans = [label(t, given, family) for t in texts]
    print(len(texts), "texts,", len(given), "given and", len(family), "family names,", Counter(k for s in spans for _, _, k in s), flush=True)
    held = [i for i in range(len(texts)) if i % 20 == 0]
    train = [i for i in range(len(texts)) if i % 20]
    hints, names = pii.Hints(hint_names), Names(rnd)
    p = init(hidden, rng)
    m, v = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}
    t0, done, seen = time.time(), 0, []
    with Pool(WORKERS) as pool:
        while done < steps:
            # some of the common given names are hints as well, in another choice each round
            mixed = pii.Hints(hint_names | set(rnd.sample(GIVEN, len(GIVEN) // 2)))
            X, G, Y = windows([texts[i] for i in train], [spans[i] for i in train], mixed, names, given)
            order = rng.permutation(len(X))
            per = BATCH * WORKERS
            for at in range(0, len(order) - per, per):
                idx = order[at : at + per].reshape(WORKERS, BATCH)
                got = pool.map(_work, [(p, X[i], G[i], Y[i]) for i in idx])
                done += 1
                lr = RATE * min(1, done / 50) * (0.5 * (1 + np.cos(np.pi * min(1, done / steps))) + 0.02)
                norm = np.sqrt(sum(float((sum(g[k] for _, g in got) / WORKERS).__pow__(2).sum()) for k in p))
                clip = min(1.0, 5.0 / (norm + 1e-6))
                for k in p:
                    g = sum(x[k] for _, x in got) / WORKERS * clip
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    p[k] -= (lr * (m[k] / (1 - 0.9**done)) / (np.sqrt(v[k] / (1 - 0.99**done)) + 1e-8)).astype(np.float32)
                seen.append(float(np.mean([x for x, _ in got])))
                if done % 200 == 0:
                    print(done, round(np.mean(seen[-200:]), 3), round(time.time() - t0), "s", flush=True)
                if done >= steps:
                    break
    np.savez_compressed(out, **{k: x.astype(np.float16) for k, x in p.items()})
    model = pii.Model({k: x.astype(np.float16).astype(np.float32) for k, x in p.items()})
    t, s = [texts[i] for i in held], [spans[i] for i in held]
    print("held-out texts: recall, precision, labels", measure(model, t, s, hints))
    other = Names(random.Random(11), HELD_GIVEN, HELD_FAMILY, 0.0)
    new = [exchange(a, b, other, given, 1.0) for a, b in zip(t, s)]
    print("held-out texts with names never trained on", measure(model, [a for a, _ in new], [b for _, b in new], hints))
    made = [frame(other) for _ in range(1000)]
    print("frames with names never trained on", measure(model, [a for a, _ in made], [b for _, b in made], hints))


if __name__ == "__main__":
    main(*sys.argv[1:4], *map(int, sys.argv[4:]))
