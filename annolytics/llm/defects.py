"""Problem 6: broken prompt and response pairs.

Each pair is judged once, in this order: empty, refusal, copy, other_language, truncated.

* empty: nothing is left of the answer without markup, labels and placeholders.
* refusal: a grammar per language tells sentences that decline and sentences of courtesy; an answer of nothing else, with
  one of the former at least, only declines.
* copy: common runs of words of query and answer are laid over the answer as tiles; where the best tiling covers nearly
  all of it, the answer only repeats the query. The query may be used again, as often as it is repeated.
* other_language: scripts first, then function words of each sentence; the query's language is that of its own words or,
  where they don't tell, the one that the language column names; an answer is in another language when sentences of
  other languages outweigh those of the query's language.
* truncated: a pushdown parser walks over the answer as it is stored: fences, inline code, tags, emphasis, brackets and
  quotations of four languages are pushed and popped on one stack, and so is the unit at hand, a sentence, an item or a
  row. What is left open at the end tells that the answer breaks off. Of a closed stack the last unit is judged: a row
  by its bar and its number of cells, a sentence by its final sign (answers that use no final signs at all by their last
  word), an item by its siblings: it lacks parts that all of them have, or, alone of its kind, has a form that no whole
  item of the table has but that whole ones begin with. Whether the last word is a whole one is decided against the
  words of all answers, the last ones of answers that may be cut left out: a word that never stands alone and begins
  another one was cut. A cut word or form that begins no other of the table stays undetected.

Scale: one map over the rows, which also gives each batch's distinct words and forms, then joins with those of all
answers and with the beginnings of those that start like a word in question. No caps.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from annolytics.session import persist_table
from annolytics.sources.tables import clean_key

COPY_COVER, MIN_TILE = 0.8, 3
#: Longer strings without a blank are codes, not words of a language.
LONG_TOKEN = 40
LONG = re.compile(r"\S{%d,}" % LONG_TOKEN)

# fixed values: what stands for no answer
PLACEHOLDERS = frozenset("""n/a na n.a. none null nil nan nat undefined empty missing leer vide leeg tbd todo k.a. ka keine angabe keine angaben ohne angabe
keine antwort no answer no response aucune réponse aucune reponse pas de réponse sans réponse geen antwoord entfällt nicht vorhanden not available not applicable""".replace("\n", " ").split())
PLACEHOLDER_PHRASES = frozenset(
    ("n a", "k a", "keine antwort", "keine angabe", "keine angaben", "ohne angabe", "no answer", "no response", "no data", "not available", "not applicable", "aucune reponse", "pas de reponse",
     "sans reponse", "sans objet", "geen antwoord", "geen gegevens", "nicht vorhanden", "noch offen", "antwort fehlt", "empty answer", "empty response")
)
# fixed values: labels in front of an answer
LABEL = re.compile(r"^\W*(?:antwort|answer|réponse|reponse|antwoord|response|reply|assistant|bot|output|ausgabe|a|frage|question|vraag|query|ihre frage(?: lautet)?|you asked|sie möchten wissen|sie fragen|vous demandez|votre question|u vroeg|uw vraag)\s*:\s*", re.I)
TAG = re.compile(r"<[^<>\n]{0,200}>")
WORD = re.compile(r"[^\W_]+")
SENTENCE_END = re.compile(r"(?<=[.!?…。！？])[\"'”“’»)\]*_]*\s+|\n+")

# fixed values: the grammar of sentences that decline, by language
DECLINE = re.compile(
    r"""
    \b(?:kann|kannst|können|könnte|darf|dürfen|möchte|will|werde|vermag)\b.*\b(?:nicht|keine[nrms]?|nichts)\b.*\b(?:beantworten|antworten|helfen|weiterhelfen|äußern|auskunft|einschätzung|stellung|angaben?|informationen|sagen|geben|dienen|machen|mitteilen|beurteilen|bearbeiten)\b
  | \bgebe\s+ich\b.*\b(?:keine?n?|nicht)\b | \bich\b.*\b(?:weiß|habe|finde|verfüge|sehe)\b.*\b(?:nicht|keine[nrms]?|nichts)\b | \bhabe\s+ich\b.*\bkeine[nrms]?\b
  | \bliegen\b.*\b(?:mir|uns)\b.*\bkeine\b | \b(?:mir|uns)\b.*\b(?:fehlt|fehlen|unbekannt|unmöglich|nicht\s+(?:möglich|bekannt|erlaubt|gestattet))\b | \bfehlt\s+mir\b
  | \b(?:auszüge|quellen|unterlagen|dokumente|textstellen|kontext|material)\b.*\b(?:nichts|keine[nrms]?|nicht)\b | \baußerhalb\s+dessen\b | \b(?:übersteigt|übersteigen)\b.*\b(?:wissen|kenntnisse|möglichkeiten|fähigkeiten|zuständigkeit)\b | \bkeine\s+ahnung\b | \bals\s+(?:sprachmodell|ki|assistent)\b.*\bkeine?n?\b
  | \b(?:i|we)\b.*(?:\b(?:cannot|unable|not\s+able|no\s+(?:information|answer|data|knowledge|access)|rather\s+not|prefer\s+not|not\s+(?:have|know|answer|comment|allowed|permitted))\b|(?:can|don|won|couldn|am|isn|aren)['’]t\b)
  | \boutside\s+(?:what|of|my|the)\b | \bbeyond\s+(?:my|our|what)\b | \bno\s+idea\b | \b(?:excerpts?|sources?|documents?|passages?|context)\b.*\b(?:say|says|hold|holds|contain|contains|offer|give|gives|mention|mentions)\b.*\b(?:nothing|no|not)\b | \b(?:do|does)\s+not\s+(?:contain|mention|cover|say)\b | \bas\s+an?\s+(?:ai|language\s+model|assistant)\b
  | \b(?:je|nous)\b.*\bne\b.*\b(?:pas|rien|aucun|aucune)\b | \bje\s+n['’].*\b(?:pas|rien|aucune?)\b | \bimpossible\s+de\b | \b(?:extraits?|sources?|documents?)\b.*\bn(?:e\b|['’]).*\b(?:pas|rien|aucune?)\b | \bpréfère\s+ne\s+pas\b | \bdépass(?:e|ent)\b.*\b(?:connaissances|compétences|capacités)\b | \baucune\s+idée\b | \ben\s+tant\s+que\s+modèle\b
  | \b(?:ik|wij|we)\b.*\b(?:niet|geen|niets)\b | \bheb\s+ik\s+geen\b | \bkan\s+ik\b.*\b(?:niet|geen|niets)\b | \b(?:bronnen|fragmenten|documenten|passages)\b.*\b(?:niets|geen|niet)\b | \bals\s+taalmodel\b | \bgaat\b.*\b(?:kennis|mogelijkheden)\b.*\bte\s+boven\b | \bgeen\s+idee\b | \bbuiten\s+wat\b
    """, re.I | re.X | re.S)  # fmt: skip
# fixed values: sentences of courtesy, which carry no substance
COURTESY = re.compile(
    r"""^\W*(?:
    (?:es\s+)?tut\s+mir\s+leid | leider | entschuldig | verzeih | hinweis\b\W*$ | vielen\s+dank | danke | ich\s+bitte\s+um | bitte\s+(?:wenden|formulieren|haben|versuchen|fragen|kontaktieren|stellen) | formulieren\s+sie | kann\s+ich\s+(?:sonst|ihnen)
  | vielleicht\s+(?:hilft|kann) | versuchen\s+sie | gern(?:e)?\s+ | wenden\s+sie | guten\s+tag | hallo | sie\s+können\s+(?:sich|gern)
  | sorry | i['’]?\s*a?m\s+sorry | apolog | unfortunately | thank | please | feel\s+free | is\s+there\s+anything | perhaps | maybe\s+ | you\s+(?:may|might|can|could)\b | hello | try\s+
  | désolé | je\s+suis\s+désolé | malheureusement | merci | veuillez | adressez | n['’]hésitez | puis-je | peut-être | bonjour | essayez
  | helaas | het\s+spijt | bedankt | dank | probeer | neem\s+contact | kan\s+ik\s+(?:u\s+)?(?:verder|nog|anders) | misschien | hallo | gelieve | stel\s+
  )""", re.I | re.X)  # fmt: skip
#: A declining sentence that goes on to answer all the same.
CONCEDES = re.compile(r"\b(?:wohl\s+aber|jedoch|allerdings|dagegen|but|however|mais|toutefois|cependant|maar|echter)\b", re.I)
APOLOGY = re.compile(r"^\W*(?:(?:es\s+)?tut\s+mir\s+leid|leider(?:\s+gilt)?|entschuldigung|hinweis|sorry|i['’]?\s*a?m\s+sorry|apologies|unfortunately|désolée?|je\s+suis\s+désolée?|malheureusement|helaas|het\s+spijt\s+me)\b[\s,:;–—-]*(?:aber|but|mais|maar)?\s*", re.I)

# fixed values: function words by language
FUNCTION_WORDS = {
    "de": "der die das den dem des ein eine einen einem einer eines und oder aber nicht mit von zu zum zur im in ist sind war wurde wurden wird werden hat haben auf aus bei bis für über unter nach vor seit durch gegen ohne um als wie dass weil wenn auch sich es er sie wir ich nur noch noch mehr sowie welche welcher was wer wo warum kann soll muss sein ihre ihr kein keine davon dabei wovon",
    "en": "the a an and or but not with of to from in on at by for is are was were be been has have had that this these those which what who how why when where it its they their he she we you i as than more most will would can could should there about into over under after before between while because if some only both",
    "fr": "le la les l un une des du de et ou mais ne pas avec pour par sur sous dans en au aux est sont été a ont que qui quoi quel quelle quels quelles dont où ce cette ces il elle ils elles nous vous je on se sa son ses leur leurs plus moins très aussi comme depuis entre pendant sans selon afin surtout d qu",
    "nl": "de het een en of maar niet met van voor naar in op aan bij uit over onder door tegen zonder om als dat die dit deze wat wie welke hoe waarom is zijn was waren wordt worden werd werden heeft hebben had er ook nog meer zich ik wij we u hij zij ze hun haar dan te tot sinds tussen tijdens omdat hoewel kan moet zal geen blijft",
    "es": "el la los las un una y o pero no con de del para por en sobre es son fue que quien como más muy su sus se al lo",
    "it": "il lo la gli le un una e o ma non con di del della per in su è sono che chi come più si al nel nella",
    "pl": "i w z na do nie się że to jest są był dla od przez po o jak ale tak ich jego",
}
_WORD_LANGS: dict[str, tuple[tuple[str, float], ...]] = {}


# fixed values: names of languages in the language column, by the function words that stand for them; other: another script
LANGUAGE_NAMES = {
    "de": "de deu ger german deutsch allemand duits", "en": "en eng english englisch anglais engels", "fr": "fr fra fre french französisch franzoesisch français francais frans",
    "nl": "nl nld dut dutch niederländisch niederlaendisch nederlands néerlandais neerlandais", "es": "es spa spanish spanisch español espanol espagnol spaans", "it": "it ita italian italienisch italiano italien italiaans",
    "pl": "pl pol polish polnisch polski polonais pools",
    "other": "ru rus russian russisch русский uk ukr ukrainian ukrainisch українська bg bul bulgarian bulgarisch el ell gre greek griechisch ελληνικά ar ara arabic arabisch fa fas per persian persisch he heb hebrew hebräisch zh zho chi chinese chinesisch 中文 ja jpn japanese japanisch 日本語 ko kor korean koreanisch hi hin hindi th tha thai",
}
_LANGUAGE_OF = {n: k for k, names in LANGUAGE_NAMES.items() for n in names.split()}
#: A letter of another script than Latin.
NOT_LATIN = re.compile(r"[^\W\d_A-Za-zª-ɏḀ-ỿ]")


def named_language(value: str | None) -> str | None:
    """The language that a value of the language column names ('DE', 'de-DE', 'german'), None for others."""
    words = WORD.findall(unicodedata.normalize("NFC", value).lower()) if isinstance(value, str) else []
    return _LANGUAGE_OF.get(words[0]) if words else None


def _word_langs() -> dict:
    if not _WORD_LANGS:
        found: dict[str, set[str]] = {}
        for lang, words in FUNCTION_WORDS.items():
            for w in set(words.split()):
                found.setdefault(w, set()).add(lang)
        for w, langs in found.items():
            _WORD_LANGS[w] = tuple((k, 1.0 / len(langs)) for k in langs)
    return _WORD_LANGS


def language(text: str) -> str | None:
    """'other' where most letters are of another script than Latin, else the language whose function words outweigh the
    others', None where nothing tells."""
    votes: dict[str, float] = {}
    table = _word_langs()
    low = text.lower()
    if len(low) > LONG_TOKEN and not (not low.isascii() and NOT_LATIN.search(low)):
        low = LONG.sub(" ", low)
    if not low.isascii() and (n := len(NOT_LATIN.findall(low))) and 2 * n > sum(c.isalpha() for c in low):
        return "other"
    told = False
    for w in filter(table.__contains__, WORD.findall(low)):
        for k, v in table[w]:
            votes[k] = votes.get(k, 0.0) + v
        told = told or len(w) > 1
    if not told:  # single letters alone may be parts of words
        return None
    best = sorted(votes.values(), reverse=True)
    if len(best) > 1 and best[0] - best[1] < 0.34:
        return None
    return max(votes, key=votes.get)


@lru_cache(maxsize=8)
def plain(text: str) -> str:
    """The text without entities, tags, zero-width signs and markup signs."""
    t = html.unescape(text) if "&" in text else text
    t = TAG.sub(" ", t) if "<" in t else t
    return t if t.isascii() else re.sub(r"[​-‏⁠﻿­]", "", t)


_PHRASES = re.compile("(?:(?:%s)(?: |$))+" % "|".join(sorted((*PLACEHOLDER_PHRASES, "none", "null", "nil", "nan", "undefined", "empty", "leer", "tbd", "todo", "entfällt"), key=len, reverse=True)))


def _is_placeholder(t: str) -> bool:
    while (m := LABEL.match(t)) and m.end():
        t = t[m.end() :]
    words = WORD.findall(t.lower())
    bare = t.lower().strip("()[]{}<>*_`'\"„“”.- \t\n")
    return not words or bare in PLACEHOLDERS or bool(_PHRASES.fullmatch(" ".join(words))) or all(re.fullmatch(r"\d", w) for w in words)


def is_empty(answer: str | None) -> bool:
    if answer is None:
        return True
    t = unicodedata.normalize("NFKC", plain(answer)).strip()
    t = re.sub(r"^```\w*|```$", "", t).strip()
    if _is_placeholder(t):
        return True
    # more of them, on lines or in cells of their own; a list's numbers count as its signs
    numbers: list[int] = []
    for part in re.split(r"[\n|]", t):
        part = part.strip()
        if m := re.match(r"(\d{1,3})[.)](?:\s+|$)", part):
            part = part[m.end() :]
            if not WORD.search(part):
                numbers.append(int(m.group(1)))
        if not _is_placeholder(part) and not all(map(_is_placeholder, SENTENCE_END.split(part))):
            return False
    return not numbers or len(numbers) > 1 and numbers == list(range(numbers[0], numbers[0] + len(numbers)))


def _chains(pattern: str) -> list[list[re.Pattern]]:
    """The alternatives of a pattern, each cut at its `.*` (outside groups) into parts that follow one another."""
    chains, part, depth, i = [[]], "", 0, 0
    pattern = re.sub(r"\s+", "", pattern)
    while i <= len(pattern):
        two, c = pattern[i : i + 2], pattern[i : i + 1]
        if depth == 0 and (c in ("", "|") or two == ".*"):
            chains[-1].append(re.compile(part, re.I | re.S))
            part = ""
            if c == "|":
                chains.append([])
            i += 2 if two == ".*" else 1
            continue
        step = 2 if c == "\\" else 1
        depth += (c == "(") - (c == ")")
        part += pattern[i : i + step]
        i += step
    return chains


_DECLINE_CHAINS = _chains(DECLINE.pattern)


def declines(sentence: str) -> bool:
    """Whether the grammar finds a decline in a sentence; part after part in long ones, in time linear in their length."""
    if len(sentence) <= 1500:
        return bool(DECLINE.search(sentence))
    for chain in _DECLINE_CHAINS:
        at = 0
        for part in chain:
            m = part.search(sentence, at)
            if not m:
                break
            at = m.end()
        else:
            return True
    return False


def is_refusal(answer: str) -> bool:
    t = plain(answer).strip().strip("*_`#> \n")
    while (m := LABEL.match(t)) and m.end():
        t = t[m.end() :]
    declined = False
    for s in SENTENCE_END.split(t):
        s = s.strip(" \t*_`\"'„“”»«")
        if not WORD.search(s):
            continue
        core = APOLOGY.sub("", s)
        if declines(core) and not CONCEDES.search(core):
            declined = True
        elif WORD.search(core) and not COURTESY.match(s):
            return False
    return declined


def tokens(text: str) -> list[str]:
    """Words for comparisons: compatibility forms, lower case, umlauts written out, accents dropped."""
    return WORD.findall(fold(plain(text)))


# fixed values: letters written out
_WRITTEN_OUT = (("ä", "ae"), ("ö", "oe"), ("ü", "ue"), ("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("ø", "o"), ("ł", "l"), ("đ", "d"))
_COMBINING: re.Pattern | None = None


def _combining() -> re.Pattern:
    """Signs that combine with the one before, as one class, from the Unicode tables."""
    global _COMBINING
    if _COMBINING is None:
        _COMBINING = re.compile("[" + "".join(re.escape(chr(c)) for c in range(sys.maxunicode + 1) if unicodedata.combining(chr(c))) + "]+")
    return _COMBINING


def fold(text: str) -> str:
    if text.isascii():
        return text.lower()
    t = unicodedata.normalize("NFKC", text).lower()
    for a, b in _WRITTEN_OUT:
        t = t.replace(a, b)
    return t if t.isascii() else _combining().sub("", unicodedata.normalize("NFD", t))


def tile_cover(answer: list[str], query: list[str], least: int = MIN_TILE) -> float:
    """The largest share of the answer's words under tiles of at least `least` words that the query holds in a row.

    The query may be used any number of times. A suffix automaton of the query gives the longest run that ends at each
    word of the answer; the best tiling follows from left to right, in time linear in both texts.
    """
    if not answer or not query:
        return 0.0
    step: list[dict[str, int]] = [{}]
    link, size, last = [-1], [0], 0
    for w in query:
        new = len(step)
        step.append({})
        link.append(0)
        size.append(size[last] + 1)
        p = last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            q = step[p][w]
            if size[q] == size[p] + 1:
                link[new] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                link.append(link[q])
                size.append(size[p] + 1)
                while p >= 0 and step[p].get(w) == q:
                    step[p][w] = twin
                    p = link[p]
                link[q] = link[new] = twin
        last = new
    covered, at, run = [0], 0, 0
    for i, w in enumerate(answer, 1):
        while at and w not in step[at]:
            at = link[at]
            run = size[at]
        if w in step[at]:
            at, run = step[at][w], run + 1
        covered.append(max(covered[-1], covered[i - run] + run if run >= least else 0))
    return covered[-1] / len(answer)


def is_copy(answer: str, query: str) -> bool:
    q = tokens(query)
    t = answer.strip()
    while (m := LABEL.match(t)) and m.end():
        t = t[m.end() :]
    a = tokens(t)
    if len(q) < MIN_TILE or not a:
        return bool(a and q) and a == q * (len(a) // len(q))
    shared = set(q)
    if sum(w in shared for w in a) < COPY_COVER * len(a):
        return False
    return tile_cover(a, q) >= COPY_COVER


def other_language(answer: str, query: str, named: str | None = None) -> bool:
    """Whether most of the answer is in another language than the query, or, where that doesn't tell, than the named one."""
    own = language(query) or named_language(named)
    if own is None:
        return False
    mine = foreign = 0
    for s in SENTENCE_END.split(plain(answer)):
        k = language(s)
        if k == own:
            mine += len(s)
        elif k is not None:
            foreign += len(s)
    return foreign > mine


# --- truncation ---------------------------------------------------------------------------------------------------
BULLET = re.compile(r"^\s*(?:[-*•–—+▪◦·]|\d{1,3}[.)]|\(?[a-z]\))\s+")
BARE_BULLET = re.compile(r"^\s*(?:[-*•–—+▪◦·]|\d{1,3}[.)]|#{1,6}|\*\*|__|>|\||```\w*)\s*$")
CITES = re.compile(r"(?:\s*(?:\[\d+(?:\s*[,;–-]\s*\d+)*\]|\(\d{1,3}\)|[¹²³⁴-⁹]))+\s*$")
#: A remark in brackets behind the end.
NOTE = re.compile(r"\s+\([^()\n]{1,60}\)\s*$")
# fixed values: a line that names a source
SOURCE_LINE = re.compile(r"^\W*(?:quellen?|ref(?:erenz(?:en)?|erences?|s)?|sources?|bron(?:nen)?|vgl|siehe|see|voir|zie)\b\.?\s*:?.*$", re.I)
FINAL = ".!?。！？"
BRACKETS = {"(": ")", "[": "]", "{": "}"}
#: Quotation signs that only open, with what closes them; “ and " open where no other one is to be closed.
QUOTES = {"„": "“”\"", "«": "»", "‚": "‘’'", "“": "”\"", '"': '"'}
# fixed values: tags that needn't be closed
OPEN_TAGS = frozenset("p li td tr th dt dd option br hr img input meta link wbr source col html body".split())
# fixed values: short forms that can't end a sentence
UNENDING = re.compile(r"(?:^|\s)(?:z\.\s?b|d\.\s?h|u\.\s?a|bzw|ca|nr|abs|art|vgl|inkl|ggf|sog|insb|dr|prof|e\.\s?g|i\.\s?e|vs|p\.\s?ex|bijv|mr|mrs|ms)\.$", re.I)


_MARKS = re.compile(r"```|`|\*\*|__|<(/?)([A-Za-z][A-Za-z0-9]*)((?:\s[^<>]*)?)(/?)>|\n[ \t\r]*\n|[(\[{)\]}„«»‚‘’'“”\"]")
_TAG_BEGUN = re.compile(r"<(?:/?[A-Za-z][A-Za-z0-9]*(?:\s[^<>]*)?)?$|<!--(?:(?!-->).)*$", re.S)


def left_open(text: str) -> list[str]:
    """What a pushdown parser has on its stack at the end: fences, code, tags, emphasis, brackets, quotations.

    Only a fence ends inside a fence, only a backtick inside code. A blank line ends code, emphasis, brackets and
    quotations with straight signs, which don't reach over paragraphs; a closing sign without its opener is no error, one
    that closes an outer level closes the inner ones with it."""
    stack: list[str] = []

    def close(what: str) -> bool:
        if what in stack:
            del stack[len(stack) - 1 - stack[::-1].index(what) :]
            return True
        return False

    for m in _MARKS.finditer(text):
        c, i = m.group(), m.start()
        if "```" in stack:
            if c == "```":
                close("```")
            continue
        if c == "```":
            stack.append(c)
            continue
        if c[0] == "\n":
            stack[:] = [s for s in stack if s in "„«“" or s[0] == "<"]
            continue
        if "`" in stack:
            if c == "`":
                close("`")
            continue
        before, behind = text[i - 1 : i] if i else "", text[m.end() : m.end() + 1]
        if c == "`":
            stack.append(c)
        elif c in ("**", "__"):
            if not close(c) and behind.strip() and not (before.isalnum() and c == "__"):
                stack.append(c)
        elif c[0] == "<":
            tag = m.group(2).lower()
            if m.group(1):
                close("<" + tag)
            elif tag not in OPEN_TAGS and not m.group(4):
                stack.append("<" + tag)
        elif c in BRACKETS:
            stack.append(c)
        elif c in ")]}":
            close({v: k for k, v in BRACKETS.items()}[c])
        else:
            opener = next((s for s in reversed(stack) if s in QUOTES and c in QUOTES[s]), None)
            if opener and not (opener == "‚" and before.isalnum() and behind.isalnum()):
                close(opener)
            elif c in "„«‚":
                stack.append(c)
            elif c in "“\"" and not before.isalnum() and behind.strip():
                stack.append(c)
    if "`" not in stack and "```" not in stack and _TAG_BEGUN.search(text, max(0, text.rfind("<"))):
        stack.append("<")
    return stack


def _stray_number(lines: list[str]) -> bool:
    """A number alone on the last line that doesn't go on with the numbers before it: lines out of order, not a cut."""
    m = re.fullmatch(r"\s*(\d{1,3})[.)]\s*", lines[-1])
    if not m:
        return False
    before = [int(x.group(1)) for x in (re.match(r"\s*(\d{1,3})[.)](?:\s|$)", y) for y in lines[:-1]) if x]
    return not before or int(m.group(1)) != before[-1] + 1


def _lines(text: str) -> list[str]:
    return [x for x in text.rstrip().splitlines() if x.strip()]


@lru_cache(maxsize=8)
def _body(answer: str) -> tuple[list[str], list[str]]:
    """The answer's lines that aren't blank, up to the one that tells whether it breaks off, and those behind it."""
    lines = _lines(unicodedata.normalize("NFC", plain(answer)))
    end = len(lines)
    while end > 1 and (SOURCE_LINE.match(lines[end - 1]) and not BULLET.match(lines[end - 1]) or not CITES.sub("", lines[end - 1]).strip() or _stray_number(lines[:end])):
        end -= 1
    return lines[:end], lines[end:]


#: A word that stands alone: no digits, no hyphen behind it.
ALONE = re.compile(r"(?<!\w)[^\W\d_]++(?![\w\-‐‑])")


#: In front of the form of an item, to tell it from words.
FORM = "\u00b6"
_FORM_TOKENS = re.compile(r"\d+(?:[.,\u00a0\u202f ]?\d+)*|[^\W\d_]+(?:[-'’/.&+][^\W\d_]+)*|\s[–—-]\s|[,;:()\[\]|/=%]")


@lru_cache(maxsize=512)
def form(item: str) -> str:
    """The form of an item: w for words in a row, n for numbers, its separators and brackets as they are."""
    out: list[str] = []
    for t in _FORM_TOKENS.findall(item):
        k = "n" if t[0].isdigit() else "–" if t[0].isspace() else t if not t[0].isalpha() else "w"
        if k != "w" or out[-1:] != ["w"]:
            out.append(k)
    return "".join(out)


def whole_words(answer: str | None, whole: bool) -> set[str]:
    """The words of an answer in lower case that are surely whole, and the forms of its items that are: all but the last
    one where the answer may be cut."""
    if not answer:
        return set()
    body, behind = _body(answer)
    words = ALONE.findall("\n".join(body).lower())
    if words and not whole:
        words.pop()
    forms = {FORM + form(BULLET.sub("", x).strip()) for x in (body if whole else body[:-1]) if BULLET.match(x)}
    return {*words, *ALONE.findall("\n".join(behind).lower())} | forms


_SENTENCE_SIGN = re.compile(r"(?:[^\W\d_]|[\])\"”»%])[.!?。！？][\"'”“’»)\]*_]*(?:\s|$)")


def truncation(answer: str) -> tuple[str, tuple[str, ...]]:
    """('cut' | 'whole' | 'ask', words): 'ask' leaves the verdict to whether each of the words (or the form) is a whole one."""
    lines, behind = _body(answer)
    if not lines:
        return "whole", ()
    stored = unicodedata.normalize("NFC", html.unescape(answer)).rstrip()
    if left_open(stored) or BARE_BULLET.match(lines[-1]) and lines[-1].strip() != "```":
        return "cut", ()
    if behind and SOURCE_LINE.match(behind[-1]):
        # the line that names a source may break off too
        last = behind[-1].rstrip(" *_")
        tail = WORD.findall(last.lower())
        if last[-1:] in ",;:(–-&/" and len(tail) > 1 or len(tail) > 1 and tail[-1] in _word_langs():
            return "cut", ()
    last = lines[-1].strip()
    items = [x.strip() for x in lines if BULLET.match(x)]
    noted = NOTE.sub("", last)
    if noted != last and noted and (noted[-1] in FINAL + "|" or CITES.search(noted) or BULLET.match(last) and form(BULLET.sub("", noted)) in {form(BULLET.sub("", x)) for x in items[:-1]}):
        last = noted
    if last.startswith("|"):
        if not last.endswith("|"):
            return "cut", ()
        width = [x.count("|") for x in lines if x.strip().startswith("|")]
        return ("cut" if width[-1] != max(set(width), key=width.count) else "whole"), ()
    core = last
    while True:
        shorter = CITES.sub("", core).rstrip()
        if shorter == core or not shorter:
            break
        core = shorter
    bare = core.rstrip("*_`~ ")
    ended = bare.rstrip("\"'”“’»)]*_ ")
    if ended and ended[-1] in FINAL:
        dots = re.search(r"\s*\.{2,}$", ended)
        return ("cut" if UNENDING.search(ended) or dots and ended[: dots.start()][-1:] not in FINAL else "whole"), ()
    if not ended:
        return "whole", ()
    if ended[-1] in ",;:-–—/&+=(…‐":
        return "cut", ()
    m = BULLET.match(last)
    if not m:
        words = WORD.findall(ended)
        if _SENTENCE_SIGN.search("\n".join([*lines[:-1], ended])) or not words or words[-1].lower() in _word_langs():
            return "cut", ()
        return ("ask", (words[-1].lower(),)) if ALONE.findall(words[-1]) else ("whole", ())
    sign = m.group().strip()
    peers = [x for x in items[:-1] if BULLET.match(x).group().strip() == sign or sign[:1].isdigit()]
    return _item(bare[m.end() :].strip() if bare.startswith(last[: m.end()]) else bare, [BULLET.sub("", p) for p in peers])


def _item(item: str, peers: list[str]) -> tuple[str, tuple[str, ...]]:
    words = WORD.findall(item)
    if not words:
        return "cut", ()
    if peers and sum(p.rstrip("*_` ")[-1:] in FINAL for p in peers) > len(peers) / 2:
        return "cut", ()  # its siblings are sentences
    if words[-1].lower() in _word_langs() and not item.endswith(")"):
        return "cut", ()
    mine, others = form(item), [form(CITES.sub("", p).strip("*_` ")) for p in peers]
    ask = () if item.endswith(")") or not ALONE.findall(words[-1]) else (words[-1].lower(),)
    if mine in others:
        return ("ask", ask) if ask else ("whole", ())
    # a form that all siblings go on from
    if others and all(o.startswith(mine) for o in others):
        return "cut", ()
    return "ask", (FORM + mine, *ask)


def judge(query: str | None, answer: str | None, named: str | None = None) -> tuple[str | None, tuple[str, ...] | None]:
    """(defect or None, words and form that decide about truncation) of a pair; named: its language column."""
    if is_empty(answer):
        return "empty", None
    query = query or ""
    if is_refusal(answer):
        return "refusal", None
    if is_copy(answer, query):
        return "copy", None
    if other_language(answer, query, named):
        return "other_language", None
    kind, words = truncation(answer)
    return ("truncated", None) if kind == "cut" else (None, words or None)


def defects(df: DataFrame, words_of: DataFrame | None = None, key: str = "record_uuid") -> DataFrame:
    """(key, defect) of the defective pairs of df (key, query, answer, language if there), keys clean, one row per key.

    A null answer is empty; a null query can't be copied and has the language that the column names, if any. Rows with a null or blank key are left
    out; of a key's rows with different verdicts the first by name holds. words_of (by default df) gives the words that
    end items. An empty table gives no rows; extra columns are ignored.
    """
    base = df.select(clean_key(key).alias(key), "query", "answer", F.col("language").cast("string").alias("language") if "language" in df.columns else F.lit(None).cast("string").alias("language"))

    own_words = words_of is None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [judge(q, a, k) for q, a, k in zip(b["query"], b["answer"], b["language"])]
            rows = [(k, d, w) for k, (d, words) in zip(b[key], got) if k is not None for w in ([None] if d else words or ())]
            yield pd.DataFrame(rows, columns=[key, "defect", "word"], dtype=object)
            if own_words:
                # rows without key: the words of the table
                words = set().union(*(whole_words(a, g == (None, None)) for a, g in zip(b["answer"], got)))
                yield pd.DataFrame({key: None, "defect": None, "word": sorted(words)}, dtype=object)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"word": sorted(set().union(*(whole_words(a, bool(a) and truncation(a) == ("whole", ())) for a in b["answer"])))}, dtype=object)

    # written once: the branches below read it
    judged = persist_table(base.mapInPandas(run, f"{key} string, defect string, word string"), "judged")
    sure = judged.where(F.col(key).isNotNull() & F.col("defect").isNotNull()).select(key, "defect")
    unsure = judged.where(F.col(key).isNotNull() & F.col("defect").isNull()).select(key, "word")
    told = judged.where(F.col(key).isNull()).select("word") if own_words else persist_table(words_of.select("answer").mapInPandas(read, "word string"), "words")
    alone = told.distinct()
    asked = unsure.select("word").distinct().join(alone, "word", "left_anti")
    # beginnings of words, of the lengths and first letters that are asked for
    first = asked.select(F.substring("word", 1, 1).alias("first"), F.length("word").alias("n")).distinct()
    begun = alone.select("word", F.substring("word", 1, 1).alias("first")).join(F.broadcast(first), "first").where(F.length("word") > F.col("n")).select(F.expr("substring(word, 1, n)").alias("word")).distinct()
    cut = unsure.join(asked.join(begun, "word", "left_semi"), "word", "left_semi").select(key, F.lit("truncated").alias("defect"))
    return sure.unionAll(cut).groupBy(key).agg(F.min("defect").alias("defect"))
