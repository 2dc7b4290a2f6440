"""Word lists of the tagger, the check that follows its spans, and exact shapes that label its training texts.

At run time only `composed` and `trimmed` work on texts: the tagger (pii.py) finds the spans and their limits, `trimmed`
moves these to the edges of words and refuses what can't be of its kind. `shaped` gives labels to train on.
"""

from __future__ import annotations

import re
import unicodedata

KINDS = ("email", "phone", "identity", "address", "name")

# fixed values: function words, which begin no name even where they are capitalised
FUNCTION_WORDS = """der die das den dem des ein eine einen einem einer eines und oder aber nicht mit von zu zum zur im in ist sind war wurde werden wird hat haben auf aus bei bis für über unter nach vor seit
durch gegen ohne um als wie dass weil wenn auch sich es er sie wir ich nur noch mehr sowie was wer wo warum kann soll muss ihre ihr unser unsere kein keine davon dabei laut erst trotz gemeinsam rund offen
the a an and or but not of to from on at by for is are was were be been has have had that this these those which what who how why when where it its they their he she we you while because if some only both
le la les un une et ou mais ne pas avec pour par sur sous dans en au aux est sont ont que qui quoi où ce cette ces il elle ils elles nous vous je on se sa son ses leur leurs plus selon afin
het een maar niet met voor naar aan uit om dat die dit deze wat wie welke hoe waarom zijn waren wordt werd heeft er ook zich ik wij zij hun haar dan te""".split()
# fixed values: particles of family names
PARTICLES = "von vom van zu zum zur de du des den dem der ten ter af di da del le la und y d'".split()
# fixed values: forms of address and titles that are written small as well
LOWER_TITLES = "mevrouw mevr meneer dhr monsieur madame mademoiselle prof dr med herr herrn frau".split()
# fixed values: words for streets that stand behind the number
STREET_WORDS_BEHIND = "rue avenue quai allée place boulevard chemin impasse cours route passage square sentier ruelle bis ter quater".split()
# fixed values: spellings of the at-sign and the dot
AT_WORDS, DOT_WORDS = "at ät arobase apenstaartje ad".split(), "dot punkt point punt".split()

_B, _E = r"(?<![\w@.+\-/])", r"(?![\w@])"
_AT = r"(?:\s?[@＠]\s?|\s?[(\[{<]\s?(?:at|ät|a|@)\s?[)\]}>]\s?|\s(?:at|ät|arobase|apenstaartje)\s)"
_DOT = r"(?:\.|\s?[(\[{]\s?(?:dot|punkt|point|punt|\.)\s?[)\]}]\s?|\s(?:dot|punkt|point|punt)\s)"
EMAIL = re.compile(rf"(?<![\w.+\-])(?P<x>[\w+\-](?:[\w.+\-]*[\w+\-])?){_AT}(?P<d>[^\W_][\w\-]*(?:{_DOT}[\w\-]+)*{_DOT}[^\W\d_]{{2,}})(?![\w@])", re.I)

_SEP = r"[ \t /.\-–‑()]{0,3}"
PHONE = re.compile(
    rf"(?<![\w+/@#=\-.,])(?:(?:\+\d{{1,3}}|00\d{{2}})(?:{_SEP}\d){{6,13}}|\(\+\d{{2,3}}\)(?:{_SEP}\d){{6,13}}|\(0\d{{1,5}}\)(?:{_SEP}\d){{4,11}}|0\d(?:{_SEP}\d){{6,12}}|\(\d{{3}}\)\s?\d{{3}}-\d{{4}}|\d{{3}}[-.]\d{{3}}[-.]\d{{4}})(?![\w/]|[.,]\d|-\d)"
)
_NOT_PHONE = re.compile(r"^\d{1,2}\.\d{1,2}\.\d{2,4}$|^\d{2,3}/\d{3}/\d{3,5}(?:/\d{3})?$|^\d{5}\s*$")
# fixed values: what announces another number than a telephone's
_OTHER_NUMBER = re.compile(
    r"(?:ISBN|ISSN|Az\.?|Aktenzeichen|Bestell\w*|Grant|Vorgang|Version|Seiten?|doi|Beleg\w*|Rechnung\w*|Kunden\w*|Projekt\w*|Ticket|Signatur|Inventar\w*|Steuer[\w\-]*|St\.-?\s?Nr\.?|Id-?Nr\.?|TIN|NIR|SSN|BSN|UTR|NINO?|number|sociale|RVNR|SV-Nr\.?|versichert\w*|\w*versicherung\w*\.?|IBAN|Konto|Pass\w*|\w*ausweis\w*|Reisepass)\s*(?:[:.#]|Nr\.?|No\.?|no\.?|n°|unter|is|ist|est)*\s*:?\s*$",
    re.I,
)

# fixed values: labels of identity numbers
ID_LABEL = (
    r"(?:Steuer(?:nummer|identifikationsnummer|-?\s?ID(?:-?Nr\.?)?)|St\.?-?\s?Nr\.?|Id-?Nr\.?|TIN|Tax\s(?:ID|number|no\.?)|tax\sidentification\snumber|UTR|NIR|num[ée]ro\s(?:fiscal|de\ss[ée]curit[ée]\ssociale)|n°\s(?:fiscal|de\ss[ée]curit[ée]\ssociale)|SSN|social\ssecurity\s(?:number|no\.?)"
    r"|BSN|burgerservicenummer|NI\s(?:no\.?|number)|NINO|National\sInsurance\s(?:number|no\.?)|RVNR|SV-?\s?Nr\.?|Sozialversicherungs(?:nummer|nr\.?)|Rentenversicherungs(?:nummer|nr\.?)|versichert\sunter|Versichertennummer"
    r"|(?:Reise)?Pass(?:nummer|-?\s?Nr\.?)?|passport(?:\s(?:number|no\.?))?|passeport(?:\sn°)?|paspoort(?:nummer)?|(?:Personal)?Ausweis(?:nummer|-?\s?Nr\.?)?|Perso(?:nummer|-?Nr\.?)?|identity\scard|ID\scard|carte\sd['’]identit[ée]|CNI|identiteitskaart(?:nummer)?|IBAN|Konto)"
)
_ID_VALUE = r"(?:[A-Za-z]{0,3}\d|[A-Z]{1,9}\d|(?=[A-Z0-9]{8,10}(?![A-Za-z0-9]))[A-Z0-9])[A-Za-z0-9]*(?:[ \-/.](?:[A-Za-z](?![^\W\d_])|[A-Za-z0-9]{0,4}\d[A-Za-z0-9]*|[A-Z]{4}(?= \d)))*"
LABELLED_ID = re.compile(rf"(?<![^\W_]){ID_LABEL}\s?(?:Nr\.?|No\.?|no\.?|n°|number|nummer|is|ist|est)?\s?:?\s{{0,2}}(?P<x>{_ID_VALUE})(?![\w])", re.I)
SHAPED_ID = re.compile(
    rf"{_B}(?P<x>[A-Za-z]{{2}}\d{{2}}(?:\s?[A-Za-z]{{4}})?(?:\s?\d{{4}}){{2,6}}(?:\s?\d{{1,3}})?|\d{{2}}[ \-]?\d{{6}}[ \-]?[A-Za-z][ \-]?\d{{3}}|\d{{2,3}}/\d{{3}}/\d{{4,5}}|\d{{2}}/\d{{3}}/\d{{3}}/\d{{3}}|\d{{3}}-\d{{2}}-\d{{4}}|[A-Z]{{2}} ?\d{{2}} ?\d{{2}} ?\d{{2}} ?[A-D])(?![\w/]|-\d)"
)

# fixed values: words that end or begin the names of streets
_STREET_END = r"(?:straße|strasse|str\.|weg|platz|allee|gasse|ring|ufer|damm|stieg|steig|pfad|chaussee|promenade|zeile|markt|kamp|graben|wall|hof|berg|grund|winkel|straat|laan|plein|kade|gracht|dijk|singel|steeg)"
_NO = r"(?:(?:Nr\.|Nr|No\.|Nummer|n°)\s?)?\d{1,4}(?!\d)(?![.,]\d)(?!\s?(?:%|Prozent|Euro|Uhr|procent|pour|percent))"
_CAP = r"[A-ZÄÖÜÉ][\w'’\-]*"
STREET_DE = re.compile(
    rf"(?<![\w\-@.])(?P<x>(?:{_CAP}\s)?{_CAP}(?<=[a-zäöüß̈A-ZÄÖÜ])(?i:{_STREET_END})|{_CAP}{_STREET_END}|(?:(?:Alte[rn]?|Neue[rn]?|Lange|Kurze|Große|Kleine|Breite|Obere|Untere)\s)(?:Straße|Weg|Gasse|Allee|Platz|Markt|Ring)|(?:Am|Im|Zum|Zur|Beim|An\sde[rmn]|Auf\sde[rmn]|In\sde[rmn]|Unter\sde[rmn]|Hinter\sde[rmn]|Vor\sde[rmn]|Aan\sde|Bij\sde|Op\sde)\s(?:{_CAP}\s)?{_CAP}),?\s{_NO}"
)
STREET_EN = re.compile(rf"(?<![\w\-@.,/])(?P<x>\d{{1,4}}\s?[a-z]?),?\s(?:{_CAP}\s){{1,3}}(?:Street|St\.|Road|Rd\.|Lane|Avenue|Mews|Terrace|Close|Drive|Way|Place|Square|Court|Crescent|Row|Hill|Gardens|Walk|Grove|Park|Yard)(?!\w)")
STREET_FR = re.compile(r"(?<![\w\-@.,/])(?P<x>\d{1,4}\s?[a-z]?(?:\s(?:bis|ter|quater))?),?\s(?:rue|avenue|quai|allée|place|boulevard|chemin|impasse|cours|route|passage|square|sentier|ruelle)\s(?:(?:de|du|des|la|le|les)\s|d['’]|l['’])*[A-ZÉÈÀÂÎÔ]")
_NO_STREET = re.compile(r"^(?:Am|Im|Zum|Zur|In\sde[rmn])\s(?:Jahr\w*|Montag|Dienstag|Mittwoch|Donnerstag|Freitag|Samstag|Sonntag|Januar|Februar|März|April|Mai|Juni|Juli|August|September|Oktober|November|Dezember|Quartal|Zeitraum|Vergleich\w*|Punkt|Abschnitt|Kapitel|Anhang)\b")

PARTICLE = r"(?:von\sder|von\sden|von\sdem|van\sder|van\sden|van\sde|de\sla|vom|von|van|zum|zur|zu|de|du|des|den|der|ten|ter|af|di|da|del|le|la|d['’])"
TITLE = r"(?:(?:Herrn|Herr|Frau|Fräulein|Madame|Monsieur|Mademoiselle|Mme|Mlle|Mr|Mrs|Ms|Miss|Mevrouw|mevrouw|Mevr|Meneer|meneer|Dhr|dhr|Sir|Lady|M|Dr|Prof|Professor|Professorin|Doktor|Dipl|Ing|Mag|med|phil|jur|rer|nat)\b\.?)"
_TITLE_END = re.compile(rf"(?:{TITLE}[\s\-]*)+$")


_MARKS = re.compile(r"[\u0300-\u036f]")


def composed(text: str) -> tuple[str, list[int] | None]:
    """The text with base signs and their marks joined, and where each of its signs began (None: nowhere else)."""
    if text.isascii() or not _MARKS.search(text):
        return text, None
    out, at, i, n = [], [], 0, len(text)
    while i < n:
        j = i + 1
        while j < n and "̀" <= text[j] <= "ͯ":
            j += 1
        c = unicodedata.normalize("NFC", text[i:j])
        out.append(c)
        at += [i] * len(c)
        i = j
    return "".join(out), [*at, n]


def shaped(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of everything but names that has an exact shape, without overlaps; earlier kinds go first."""
    found: list[tuple[int, int, str]] = []

    def add(a: int, b: int, kind: str) -> None:
        if not any(a < y and x < b for x, y, _ in found):
            found.append((a, b, kind))

    for m in EMAIL.finditer(text):
        sign = text[m.end("x") : m.start("d")]
        if re.search(r"[@＠]", sign) or re.search(r"[(\[{<]", sign) or re.search(r"\s(?:dot|punkt|point|punt)\s|[(\[{]", m.group("d"), re.I):
            if not (m.group("x").isdigit() and sign.strip() != sign):
                add(m.start("x"), m.end(), "email")
    for m in LABELLED_ID.finditer(text):
        if sum(c.isdigit() for c in m.group("x")) >= 2 and len(m.group("x")) >= 7:
            add(m.start("x"), m.end("x"), "identity")
    for m in SHAPED_ID.finditer(text):
        if sum(c.isdigit() for c in m.group("x")) >= 6:
            add(m.start("x"), m.end("x"), "identity")
    for m in PHONE.finditer(text):
        p = m.group()
        if not _NOT_PHONE.match(p) and p.count("/") < 2 and not _OTHER_NUMBER.search(text[max(0, m.start() - 40) : m.start()]):
            add(m.start(), m.end(), "phone")
    for m in STREET_DE.finditer(text):
        x, s = m.group("x"), m.start("x")
        if _NO_STREET.match(x):
            continue
        head = re.match(rf"{_CAP}\s(?={_CAP}$)", x)
        if head and not re.match(r"(?:Alte|Neue|Lange|Kurze|Große|Kleine|Breite|Obere|Untere|Am|Im|Zum|Zur|An|Auf|In|Unter|Hinter|Vor|Beim|Aan|Bij|Op|[A-Z]\w+er\s)", x):
            s += head.end()
            x = x[head.end() :]
        if re.fullmatch(r"(?:Platz|Weg|Berg|Hof|Ring|Markt|Grund)", x):
            continue
        add(s, m.end(), "address")
    for rx in (STREET_EN, STREET_FR):
        for m in rx.finditer(text):
            add(m.start("x"), m.end(), "address")
    return sorted(found)

# --- the check behind the tagger --------------------------------------------------------------------------------------
_TITLES_AHEAD = re.compile(rf"(?:(?:{TITLE})[\s\-]*)+", re.I)
_AT_SIGN = re.compile(r"[@＠]|[(\[{<]\s?(?:at|ät|a|@)\s?[)\]}>]|\s(?:at|ät|arobase|apenstaartje|ad)\s", re.I)
_DATE = re.compile(r"\d{1,2}\.\d{1,2}\.\d{2,4}|\d{4}-\d\d-\d\d")
_LINKS = "-'’‐‑"
# fixed values: words of institutions, which may bear a person's name before or behind them
_BEFORE = re.compile(r"(?:Universität|Hochschule|Stiftung|Akademie|\w*[Ss]chule|Klinik|Bibliothek|Gymnasium|Museum|Université|Fondation|Lycée|École|Stichting)\s$")
_BEHIND = re.compile(r"[\s-](?:Stiftung|Universität|\w*[Ss]chule|Institut|Preis|Haus|Gymnasium|Foundation|University|Institute|Museum|Library|College|School|Trust|Klinik|Stadion|Award)\b")
_MORE_NUMBER = re.compile(r"[.,]\d|\s?(?:%|Prozent|Euro|percent|euros?|procent)\b")
_FUNCTION, _PARTICLE = frozenset(w for w in FUNCTION_WORDS if len(w) > 1) - frozenset(PARTICLES), frozenset(PARTICLES)


def _word_sign(c: str) -> bool:
    return c.isalnum() or unicodedata.category(c)[0] == "M"


def _to_words(text: str, a: int, b: int, extra: str) -> tuple[int, int]:
    """The range without other signs at its ends, and grown to whole words (of letters, digits and the extra signs)."""
    while a < b and not _word_sign(text[a]):
        a += 1
    while a < b and not _word_sign(text[b - 1]):
        b -= 1
    inside = lambda i: 0 <= i < len(text) and (_word_sign(text[i]) or text[i] in extra and 0 < i < len(text) - 1 and _word_sign(text[i - 1]) and _word_sign(text[i + 1]))
    while a < b and inside(a - 1):
        a -= 1
    while a < b and inside(b):
        b += 1
    return a, b


def trimmed(text: str, a: int, b: int, kind: str) -> tuple[int, int] | None:
    """The span's limits at the edges of words, None where it can't be of its kind.

    A name needs a capital and two words, or one behind a form of address, no function word, and nothing small but
    particles; forms of address and titles at its beginning are left out. A telephone number takes plus signs and brackets before it and needs five digits that aren't a date; an
    identity number has seven signs, two of them digits; an address a capital and a number that isn't part of a larger one; a mail address an at-sign,
    however written, with something on either side."""
    if kind == "phone":
        while a < b and not (text[a].isdigit() or text[a] in "+("):
            a += 1
        while b > a and not text[b - 1].isdigit():
            b -= 1
        while a > 0 and (text[a - 1].isdigit() or text[a - 1] in "+("):
            a -= 1
        while b < len(text) and text[b].isdigit():
            b += 1
        return (a, b) if sum(c.isdigit() for c in text[a:b]) >= 5 and not _DATE.fullmatch(text[a:b]) else None
    if kind == "email":
        a, b = _to_words(text, a, b, ".+-_")
        while a > 0 and text[a - 1] in "_-":
            a -= 1
        m = _AT_SIGN.search(text, a, b)
        return (a, b) if m and m.start() > a and m.end() < b else None
    a, b = _to_words(text, a, b, _LINKS)
    if kind == "identity":
        return (a, b) if b - a >= 7 and sum(c.isdigit() for c in text[a:b]) >= 2 else None
    if kind == "address":
        number = any(c.isdigit() for c in text[a:b]) and not (text[b - 1].isdigit() and _MORE_NUMBER.match(text, b))
        return (a, b) if number and sum(c.isalpha() for c in text[a:b]) > 1 and any(c.isupper() for c in text[a:b]) else None
    if m := _TITLES_AHEAD.match(text, a, b):
        if m.end() < b:
            a = m.end()
    words = [w for w in re.split(r"[\s,]+", text[a:b]) if w]
    capital = [w for w in words if w[0].isupper() or unicodedata.category(w[0]) == "Lt"]
    if any(w.lower() in _FUNCTION for w in capital) or any(w.lower() not in _PARTICLE for w in words if w not in capital and w[0].islower()):
        return None
    if any(len(w) == 1 for w in capital) or words and words[-1] not in capital or _BEFORE.search(text[max(0, a - 40) : a]) or _BEHIND.match(text, b):
        return None
    if not capital or len(capital) == 1 and not _TITLE_END.search(text[max(0, a - 40) : a]):
        return None
    return a, b
