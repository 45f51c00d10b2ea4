"""Personal information inside free text: detection, typed placeholders and keyed surrogates (problem 4).

Detection: e-mail addresses by form, also spelled out and escaped; phone numbers by form or by a word for them; identity
numbers by a form with its own checksum, or by the document's name before them; addresses by a street word with a house
number; names by title, initial or listed given name, and else by a model of form and context (names.py). Bank accounts and
payment cards, told by their checksums, are replaced too, as kind `account`. Each distinct entity gets a replacement drawn
by a keyed hash: of its kind, its script, its format and, for given names, its gender. Replacements that collide with one
another or with a real entity are drawn again, from a space that widens with each round, until all are distinct, so
different people stay different and the same person stays the same wherever they occur.
"""

from __future__ import annotations

import hashlib
import hmac
import re
import secrets
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepress.llm import names
from linepress.llm.lookalikes import SAME_SHAPE
from linepress.llm.names import NameFinder, NameModel, is_cased, may_hold
from linepress.session import collect_small, discard, materialise, spread

KINDS = ("email", "phone", "id", "address", "name")
#: Fixed value: what the sums of weights over parts count in.
_UNIT = 1 << 24
#: Pairs of a part of the corpus that a model of names is fitted on at once, about; every pair is in one part.
PART_PAIRS = 20_000
#: Tasks that the parts are dealt out to, at most.
MOST_TASKS = 2_000

# -- wording, by language (fixed values) ------------------------------------------------------------------------------
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Herrn Frau M. Mme Mlle Monsieur Madame Sr Sra Srta Don Doña Dona Hr Fru Frk Dhr Mevr Mevrouw Meneer Me Drs Ing Mej D.ª Dª г-н г-жа д-р проф господин госпожа".split()
FEMALE_TITLES = "mrs ms miss frau mme mlle madame sra srta doña dona fru frk mevr mevrouw mej d.ª dª г-жа госпожа".split()
#: Titles that are also written small before a name.
_SMALL_TITLES = frozenset("dr prof mr mrs frau herr herrn monsieur madame doña dona señor hr fru frk dhr mevr mevrouw meneer drs господин госпожа г-н г-жа д-р проф".split())
ID_WORDS = [
    "passport", "identity number", "identity card", "id card", "id no", "social security", "national insurance", "tax id", "tax number",
    "personalausweis", "ausweis", "reisepass", "steuer-id", "steuernummer", "sozialversicherungsnummer", "steueridentifikationsnummer",
    "passeport", "sécurité sociale", "pièce d'identité", "carte d'identité", "numéro fiscal",
    "pasaporte", "documento de identidad", "dni", "nif", "nie", "seguridad social", "passaporte", "identificação", "cartão de cidadão", "bilhete de identidade", "segurança social", "contribuinte",
    "pas", "cpr", "cpr-nr", "cpr-nummer", "personnummer", "pass", "id-kort", "samordningsnummer", "paspoort", "bsn", "burgerservicenummer", "identiteitskaart", "identiteitsbewijs",
    "паспорт", "удостоверение", "снилс", "инн", "полис",
]
PHONE_WORDS = ["tel", "tél", "tlf", "tfn", "telefon", "telefono", "teléfono", "telefone", "téléphone", "phone", "call us on", "rufen sie uns an", "appelez-nous au", "llámenos al", "ligue para", "ligue-nos", "telefone-nos", "ring til os på", "ring oss på", "bel ons op", "звоните нам", "тел", "телефон", "fax", "mobile", "mobil", "móvil"]
# -- streets ----------------------------------------------------------------------------------------------------------
_CAP = r"[A-ZÀ-ÖØ-ÞŒА-ЯЁ]"
_NUM = r"\d{1,4}(?:\s?[a-zA-Z]\b)?"
STREETS = [
    rf"(?<![\w-]){_NUM},?\s(?:[^\W\d][\w'’-]*\s){{1,3}}(?:street|st\.|st\b|road|rd\.|rd\b|lane|avenue|ave\b|close|court|drive|terrace|crescent|row|hill|gardens|mews|square)",
    rf"\b[\w-]*\w(?:straße|strasse|str\.|gasse|platz|allee|ufer|damm|stieg|steig|chaussee|winkel|wall|kamp|stiege)\s{_NUM}",
    rf"\b[\w-]*\w(?:weg|straat|gracht|laan|plein|kade|dijk|steeg|singel|hof|markt)\s{_NUM}",
    rf"\b[\w-]*\w(?:vej|gade|stræde|allé|plads|vænge|vænget|stien|gatan|vägen|gränd|gränden|stigen|stig|torget|backen|väg|gata|plan)\s{_NUM}",
    rf"\b{_NUM}(?:\s?(?:bis|ter))?,?\s(?:rue|bd|av|avenue|quai|chemin|place|boulevard|impasse|allée|cours|route|passage|square)\s(?:(?:de|du|des|la|le|les|d'|l')\s?)*[\w'’-]+",
    rf"\b(?:calle|c/|avda\.?|avenida|av\.|plaza|paseo|camino|carrera|ronda|travesía|glorieta|rua|r\.|travessa|largo|praça|estrada|alameda|beco)\s(?:[\w'’-]+\s){{0,4}}[\w'’-]+,?\s(?:n\.?\s?º\.?\s?|nº\s?|núm\.?\s?|número\s)?{_NUM}",
    rf"(?:улица|ул\.|пр-т|проспект|пр\.|переулок|пер\.|набережная|наб\.|площадь|пл\.|шоссе|бульвар|проезд)\s(?:[\w-]+\s?){{1,3}},?\s(?:д\.|дом|д)?\s?\d{{1,4}}",
    rf"(?:(?<=lives at )|(?<=wohnhaft )|(?<=domicilié )|(?<=domiciliée )|(?<=domicilio en )|(?<=residente na )|(?<=residente em )|(?<=bor på )|(?<=bor )(?!på )|(?<=woont op )|(?<=woont aan )|(?<=visitors: )|(?<=besucher: )|(?<=accueil : )|(?<=visitas: )|(?<=besøg: )|(?<=besök: )|(?<=bezoekers: )|(?<=приём: ))(?:[\w'’.-]+\s){{1,4}}{_NUM}(?!\w)",
]
_STREET = re.compile("|".join(STREETS), re.I)
#: Those that need no word of STREET_ENDS before a number; letters that re.I takes for others than lower() does.
_STREET_WITHOUT_END, _FOLDED_BY_RE = re.compile("|".join(STREETS[:1] + STREETS[4:]), re.I), re.compile("[ſıİ]")
#: Words and word ends that tell a street; the first find candidates cheaply, STREETS decides.
STREET_WORDS = frozenset(
    "street st road rd lane avenue ave close court drive terrace crescent row hill gardens mews square rue bd av quai chemin place boulevard impasse allée cours route passage calle c avda avenida plaza paseo camino carrera ronda travesía glorieta rua r travessa largo praça estrada alameda beco улица ул пр проспект переулок пер набережная наб площадь пл шоссе бульвар проезд "
    "lives wohnhaft domicilié domiciliée domicilio residente bor woont visitors besucher accueil visitas besøg besök bezoekers приём".split()
)
STREET_ENDS = ("straße", "strasse", "str", "gasse", "platz", "allee", "ufer", "damm", "stieg", "steig", "chaussee", "winkel", "wall", "kamp", "stiege", "weg", "straat", "gracht", "laan", "plein", "kade", "dijk", "steeg", "singel", "hof", "markt", "vej", "gade", "stræde", "allé", "plads", "vænge", "vænget", "stien", "gatan", "vägen", "gränd", "gränden", "stigen", "stig", "torget", "backen", "väg", "gata", "plan")
_STREET_PART = re.compile("|".join(sorted(STREET_WORDS | set(STREET_ENDS), key=len, reverse=True)), re.I)
_NUMBER = re.compile(r"\s\d")
_LONGEST_END = max(map(len, STREET_ENDS))
#: Street words that are also ordinary words where they are written small.
_COMMON = re.compile(r"largo\b|camino\b|paseo\b|ronda\b|plaza\b|estrada\b|carrera\b|alameda\b|beco\b")
# -- other forms ------------------------------------------------------------------------------------------------------
_AT = r"(?:\s?@\s?|&#64;|&commat;|%40|\s?[\[({]\s?(?:at|@|arroba|собака)\s?[\])}]\s?|\s+at\s+)"
_DOT = r"(?:\.|\s?[\[({]\s?(?:dot|\.|punkt|punto|точка)\s?[\])}]\s?|\s+dot\s+)"
_EMAIL = re.compile(rf"[\w.+-]*[\w+-]{_AT}[\w-]+(?:{_DOT}[\w-]+)*{_DOT}[^\W\d_]{{2,}}", re.I)
_PLAIN_AT = re.compile(r"\s+at\s+", re.I)
_DOT_WORD = re.compile(r"\s+dot\s+", re.I)
_CLUSTER = re.compile(r"(?:\(?\+\s?)?\(?\b\d(?:[\d().\-/ ‑]|\s?№\s?)*\d\b")


def _words(ws: list[str]) -> str:
    return "|".join(re.escape(w).replace(r"\ ", r"\s+") for w in sorted(ws, key=len, reverse=True))


_ID = re.compile(rf"(?<!\w)(?:{_words(ID_WORDS)})(?:[\s-]*(?:no|nr|number|nummer|numéro|número|n\.?º|n°|номер|№))?\.?\s*[:#№]?\s*(?P<v>[A-Z0-9](?:[A-Z0-9]|[ .\-/](?=[A-Z0-9№])|\s?№\s?){{4,}})", re.I)
_MANY_DIGITS = re.compile(r"(?:\d[().\-/ ‑№]{0,3}){5}\d")
_FIRST = lambda ws: frozenset(re.findall(r"\w+", w)[0] for w in ws)
_ID_FIRST, _TITLE_WORDS = _FIRST(ID_WORDS), _FIRST([t.lower() for t in TITLES])
#: Words that stand beside contact details.
_FORM_WORDS = frozenset(x for w in (*PHONE_WORDS, *ID_WORDS) for x in w.split() if len(x) > 2) | STREET_WORDS
_DIGIT, _NO_DIGITS = re.compile(r"\d"), bytes(set(range(256)) - set(b"0123456789"))
_TOKEN = re.compile(r"\w+")
_ONE_INITIAL = re.compile(r"[A-ZÀ-ÞА-ЯЁ](?<=\b.)\.")
_UNEVEN = re.compile(r"[\t\n\r]|  |[\u00a0\u00ad\u0300-\u036f\u1680\u2000-\u200f\u2028-\u202f\u205f-\u206f\u217c\u3000\ufb00-\ufb06\ufeff\uff01-\uff5e]|[A-Za-z][\u0370-\u058f]|[\u0370-\u058f][A-Za-z]|[ɑɡı]")
#: One character of which any match of _UNEVEN in text beyond ASCII has, or two blanks.
_ODD = re.compile(r"[\t\n\r\u00a0\u00ad\u0300-\u036f\u1680\u2000-\u200f\u2028-\u202f\u205f-\u206f\u217c\u3000\ufb00-\ufb06\ufeff\uff01-\uff5e\u0370-\u058fɑɡı]")
_PHONE_BEFORE = re.compile(rf"(?:(?<!\w)(?:{_words(PHONE_WORDS)})\.?\s*:?\s*)$", re.I)
_PHONE_FORM = re.compile(
    r"(?:\(?\+\d{1,3}\)?(?:[\s.\-]|\s?/\s?)?(?:\(?\d+\)?(?:[\s.\-]|\s?/\s?)?)+|00\d{2,3}[\s\-]\d[\d\s\-]{6,}|00[1-9]\d{8,12}|0[1-9](?:[.\- ]\d\d){4}|0[1-9]\d{0,3}[\s/]\d{3,8}(?:[\s\-]\d{2,4}){0,2}|8[\s\-]?\(\d{3,5}\)\s?\d{1,3}(?:[\s\-]\d\d){2}|\(\d{3}\)\s?\d{3}[\s.\-]\d{4}|1[\s.\-]\d{3}[\s.\-]\d{3}[\s.\-]\d{4}|\d{3}[.\-]\d{3}[.\-]\d{4}|0\d{1,4}[\s\-]\d{3,4}[\s\-]?\d{2,4}(?:[\s\-]\d{2})?|0\d{4}[\s\-]\d{6}|0\d{2}-\d{7}|\d{2} \d{2} \d{2} \d{2}|[5-9]\d{2} \d{2} \d{2} \d{2}|[5-9]\d{2} \d{3} \d{3})$"
)
_NAME_WORD = r"[^\W\d_]+(?:['’\-][^\W\d_]+)*"
_TITLE = re.compile(rf"(?<![\w-])(?:{'|'.join(re.escape(t.rstrip('.')) for t in sorted(TITLES, key=len, reverse=True))})(?:\.\s?|\s)(?=\w)", re.I)
_INITIAL = re.compile(rf"(?<![\w.-])(?:{_CAP}\.\s?){{1,2}}(?P<f>{_CAP}{_NAME_WORD})")
_TAKE = re.compile(rf"(?:(?P<w>{_NAME_WORD})(?P<dot>\.)?)")
_PAIR = re.compile(rf"(?P<a>{_NAME_WORD})(?P<sep>\s|,\s?)(?P<b>{_NAME_WORD})")
PARTICLES = {"de", "da", "do", "dos", "das", "van", "von", "der", "den", "del", "la", "le", "du", "af"}


def _is_uneven(text: str) -> bool:
    if "  " in text:
        return True
    if text.isascii():
        return "\n" in text or "\t" in text or "\r" in text
    return _ODD.search(text) is not None and _UNEVEN.search(text) is not None


def flat(text: str) -> tuple[str, list[int] | None]:
    """text as detection reads it (one blank for any, width and look-alike forms undone, format characters gone) and the
    place of each of its characters in text; None if they are the same."""
    if not _is_uneven(text):
        return text, None
    out, at = [], []
    latin = sum("a" <= c <= "z" for c in text.lower())
    same = latin * 3 > len(text)
    for i, c in enumerate(text):
        if c > "\x7f":
            cat = unicodedata.category(c)
            if cat == "Cf":
                continue
            if cat == "Zs":
                c = " "
            elif "ﬀ" <= c <= "ﬆ" or "！" <= c <= "～" or c == "ⅼ":
                for x in unicodedata.normalize("NFKC", c):
                    out.append(x)
                    at.append(i)
                continue
            elif same and c in SAME_SHAPE and SAME_SHAPE[c] < "\x80":
                c = SAME_SHAPE[c]
            elif cat == "Mn" and out and len(n := unicodedata.normalize("NFC", out[-1] + c)) == 1:
                out[-1] = n
                continue
        elif c in "\t\n\r":
            c = " "
        if c == " " and out and out[-1] == " ":
            continue
        out.append(c)
        at.append(i)
    return "".join(out), at


def _luhn(digits: str) -> bool:
    d = [int(c) for c in reversed(digits)]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(d)) % 10 == 0


def _date(day: str, month: str) -> bool:
    return 1 <= int(day) <= 31 and 1 <= int(month) <= 12


def _mod97(iban: str) -> bool:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def _snils(d: str) -> bool:
    total = sum(int(c) * (9 - i) for i, c in enumerate(d[:9]))
    return (total if total < 100 else total % 101 % 100) == int(d[9:])


#: Numbers that tell by form what they are: (kind, pattern, check of its letters and digits).
CHECKED = [
    ("account", re.compile(r"(?<![\w-])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![\w-])"), lambda d: 15 <= len(d) <= 34 and _mod97(d)),
    ("account", re.compile(r"(?<![\w.,/-])[3-6]\d{3}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w/-])"), lambda d: 13 <= len(d) <= 19 and _luhn(d)),
    ("id", re.compile(r"(?<![\w.-])(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}(?![\w-])"), lambda d: True),  # US
    ("id", re.compile(r"(?<![\w.-])(?:\d{8}|[XYZ]-?\d{7})-?[A-HJ-NP-TV-Z](?![\w-])"), lambda d: "TRWAGMYFPDXBNJZSQVHLCKE"[int(d[:-1].translate(str.maketrans("XYZ", "012"))) % 23] == d[-1]),  # Spain
    ("id", re.compile(r"(?<![\w.-])\d{3}-\d{3}-\d{3}[ -]\d\d(?![\w-])"), _snils),  # Russia
    ("id", re.compile(r"(?<![\w.-])\d{6}-\d{4}(?![\w-])"), lambda d: _date(d[:2], d[2:4]) or _date(d[4:6], d[2:4]) and _luhn(d)),  # Denmark, Sweden
    ("id", re.compile(r"(?<![\w.-])[12][ ]?\d\d[ ]?\d\d[ ]?\d\d[ ]?\d{3}[ ]?\d{3}[ ]?\d\d(?![\w-])"), lambda d: 97 - int(d[:13]) % 97 == int(d[13:])),  # France
    ("id", re.compile(r"(?<![\w.-])(?!BG|GB|NK|KN|TN|NT|ZZ)[A-CEGHJ-PR-TW-Z][A-CEGHJ-NPR-TW-Z] ?\d\d ?\d\d ?\d\d ?[A-D](?![\w-])"), lambda d: True),  # United Kingdom
]


def _street_end(t: str) -> bool:
    """Whether a word with an end that tells a street stands before a number."""
    for m in _NUMBER.finditer(t):
        at = m.start()
        at -= t[at - 1 : at] in (".", ",")
        if t[max(0, at - _LONGEST_END) : at].lower().endswith(STREET_ENDS):
            return True
    return False


class Detector:
    """known: words of ordinary language in lower case; given: given names in lower case; model: of other names."""

    def __init__(self, known: set[str], given: set[str], model: NameModel | None = None):
        self.known, self.given = (known | _FORM_WORDS) - given, given
        self.finder = NameFinder(model or NameModel(), self.known, given)

    def _name_after(self, t: str, at: int, cased: bool, one: bool) -> tuple[tuple[int, int] | None, tuple[int, int]] | None:
        """Spans (given or None, family) of a name that starts at at; one: a family name alone will do."""
        p = _PAIR.match(t, at)
        if p and "," in p["sep"] and all(len(w) > 2 and w.lower() not in self.known and (not cased or w[0].isupper()) for w in (p["a"], p["b"])):
            return p.span("b"), p.span("a")
        words, pos = [], at
        while len(words) < 4:
            m = _TAKE.match(t, pos)
            if not m:
                break
            w = m["w"]
            low = w.lower()
            initial = len(w) == 1 and bool(m["dot"])
            particle = low in PARTICLES and words and not initial
            if not initial and not particle and (low in self.known or cased and not w[0].isupper()):
                break
            words.append((m.start("w"), m.end("w"), "i" if initial else "p" if particle else "w"))
            pos = m.end()
            if not initial and m["dot"] or pos >= len(t) or t[pos] != " " and not initial:
                break
            pos += t[pos] == " "
        while words and words[-1][2] != "w":
            words.pop()
        full = [w for w in words if w[2] == "w"]
        if len(full) >= 2:
            return (words[0][0], words[0][1]), full[1][:2]
        if full and (one or words[0][2] == "i"):
            return None, full[0][:2]
        return None

    def told(self, t: str, cased: bool, tokens: set[str]) -> Iterator[tuple[tuple[int, int] | None, tuple[int, int]]]:
        """Spans (given or None, family) of names that a title or an initial tells."""
        if not tokens.isdisjoint(_TITLE_WORDS):
            for m in _TITLE.finditer(t):
                if not cased or m.group()[0].isupper() or "." in m.group() or m.group().strip() in _SMALL_TITLES:
                    if (n := self._name_after(t, m.end(), cased, True)) and n[1][1] - n[1][0] > 2:
                        yield n
        if cased and _ONE_INITIAL.search(t):
            for m in _INITIAL.finditer(t):
                if m["f"].lower() not in self.known and m["f"][1:].islower():
                    yield None, m.span("f")

    def names(self, t: str, tokens: set[str], near: bool = True) -> Iterator[tuple[int, int, str]]:
        """Spans of given and family names; tokens: the words of t in lower case; near: see find_in."""
        listed, may = not tokens.isdisjoint(self.given), near and may_hold(t)
        if not (may or listed or not tokens.isdisjoint(_TITLE_WORDS) or _ONE_INITIAL.search(t)):
            return
        cased = is_cased(t)
        for given, family in self.told(t, cased, tokens):
            if given:
                yield (*given, "given")
            yield (*family, "family")
        if listed:
            for m in re.finditer(rf"(?<![\w-]){_NAME_WORD}", t):
                if m.group().lower() not in self.given or cased and not m.group()[0].isupper():
                    continue
                p = _PAIR.match(t, m.start())
                if p and p["a"] == m.group() and p["sep"] == " " and self._family(p["b"], cased):
                    yield (*p.span("a"), "given")
                    yield (*p.span("b"), "family")
                    continue
                b = re.search(rf"(?P<a>{_NAME_WORD}),\s?$", t[max(0, m.start() - 40) : m.start()])
                if b and self._family(b["a"], cased):
                    o = max(0, m.start() - 40)
                    yield o + b.start("a"), o + b.end("a"), "family"
                    yield (*m.span(), "given")
        for given, family in self.finder.find(t, cased) if may else ():
            yield (*given, "given")
            yield (*family, "family")

    def _family(self, w: str, cased: bool) -> bool:
        return len(w) > 2 and w.lower() not in self.known and (not cased or w[0].isupper())

    def find(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, part) of the entities, in order, not overlapping; part tells given from family names."""
        return self.find_in(*flat(text))

    def find_all(self, texts: list[str]) -> list[list[tuple[int, int, str, str]]]:
        """find() in all texts."""
        ts = [flat(t) for t in texts]
        return [self.find_in(*t, near) for t, near in zip(ts, self.finder.full.near_in(names.Texts([t for t, _ in ts])).tolist())]

    def find_in(self, t: str, at: list[int] | None, near: bool = True) -> list[tuple[int, int, str, str]]:
        """find() in a text as flat() gives it; near: whether a name that only the model tells may be in it (FullWords.near_in)."""
        got: list[tuple[int, int, str, str]] = []

        def free(a: int, b: int) -> bool:
            return all(b <= x or a >= y for x, y, _, _ in got)

        def add(a: int, b: int, kind: str, part: str = "") -> None:
            if free(a, b):
                got.append((a, b, kind, part or kind))

        tokens = set(_TOKEN.findall(t.lower()))
        # `at` between blanks counts with `dot` only, else it stands in brackets
        if "@" in t or "%40" in t or "&#64;" in t or not tokens.isdisjoint(("commat", "arroba", "собака")) or "at" in tokens and ("dot" in tokens or "[" in t or "(" in t or "{" in t):
            for m in _EMAIL.finditer(t):
                s = m.group()
                if not _PLAIN_AT.search(s) or _DOT_WORD.search(s):
                    add(m.start(), m.end(), "email")
        if _DIGIT.search(t):
            many = (not t.isascii() or len(t.encode().translate(None, _NO_DIGITS)) > 5) and _MANY_DIGITS.search(t)
            for kind, form, holds in CHECKED if many else ():
                for m in form.finditer(t):
                    if holds("".join(filter(str.isalnum, m.group()))):
                        add(m.start(), m.end(), kind)
            if not tokens.isdisjoint(_ID_FIRST):
                for m in _ID.finditer(t):
                    v = m["v"]
                    stop = re.search(r"\s(?![A-Z0-9№]{1,4}(?![a-z]))|\s[A-Z][a-z]|[.]\s", v)
                    v = v[: stop.start()] if stop else v
                    if sum(c.isdigit() for c in v) >= 5:
                        add(m.start("v"), m.start("v") + len(v), "id")
            end = _street_end(t)
            if end or not tokens.isdisjoint(STREET_WORDS):
                for m in (_STREET if end or _FOLDED_BY_RE.search(t) else _STREET_WITHOUT_END).finditer(t):
                    if not _COMMON.match(m.group()):
                        add(m.start(), m.end(), "address")
            for m in _CLUSTER.finditer(t) if many else ():
                s = m.group()
                if not 7 <= sum(c.isdigit() for c in s) <= 15 or not free(m.start(), m.end()):
                    continue
                before, after = t[max(0, m.start() - 30) : m.start()], t[m.end() : m.end() + 12]
                if _PHONE_BEFORE.search(before) or _PHONE_FORM.match(s) and not s.endswith("000 000") and not (before[-1:].isalnum() or before.endswith(("€", "$", "£")) or after.startswith(("/", "€", "%")) or re.match(r"[-–]\w|\s?[€$£%]", after)):
                    add(m.start(), m.end(), "phone")
        for a, b, part in self.names(t, tokens, near):
            add(a, b, "name", part)
        got.sort()
        if at is None:
            return got
        return [(at[a], at[b - 1] + 1, k, p) for a, b, k, p in got]


def entity_key(surface: str, part: str) -> str:
    """Equal for two mentions of one entity."""
    s = unicodedata.normalize("NFKC", surface).casefold()
    s = "".join(c for c in s if unicodedata.category(c) != "Cf")
    if part in ("phone", "id"):
        return re.sub(r"[^\w+]", "", s)
    if part == "email":
        return re.sub(_DOT, ".", re.sub(_AT, "@", s, count=1, flags=re.I), flags=re.I)
    return re.sub(r"\s+", " ", s).strip(" .,")


_SYLLABLES = {
    "latin": ["ba", "del", "fi", "gor", "han", "jo", "kel", "lum", "mar", "nes", "or", "pel", "ri", "sol", "tam", "ul", "ver", "win", "yl", "zen"],
    "cyrillic": ["ба", "дел", "фи", "гор", "хан", "ёл", "кел", "лум", "мар", "нес", "ор", "пел", "ри", "сол", "там", "ул", "вер", "вин", "ял", "зен"],
}
_GIVEN = {  # fixed values: replacements by script and gender
    ("latin", "f"): ["Alma", "Clara", "Edda", "Flora", "Greta", "Ida", "Livia", "Mira", "Olga", "Petra", "Rosa", "Stella", "Tilda", "Vilma"],
    ("latin", "m"): ["Anton", "Bruno", "Carlo", "Edgar", "Felix", "Hugo", "Ivo", "Leo", "Otto", "Pavel", "Rufus", "Stefan", "Tobias", "Viktor"],
    ("cyrillic", "f"): ["Анна", "Дарья", "Зоя", "Ирина", "Ксения", "Лидия", "Майя", "Нина", "Ольга", "Полина", "Раиса", "Софья"],
    ("cyrillic", "m"): ["Антон", "Борис", "Виктор", "Глеб", "Денис", "Егор", "Захар", "Кирилл", "Лев", "Максим", "Никита", "Олег"],
}


def gender(given: str) -> str:
    """By ending: most given names of the nine languages that end in a, e or я are women's."""
    return "f" if re.search(r"[aeéяё]$|[íî]s$|ès$|ção$|[lrd]otte$", given.lower()) and given.lower() not in ("elías",) else "m"


def surrogate(surface: str, part: str, key: str, secret: bytes, attempt: int) -> str:
    """A replacement of the same kind, script and format, drawn by a keyed hash of the entity and the attempt."""
    stream = b"".join(hmac.new(secret, f"{part}|{key}|{attempt}|{i}".encode(), hashlib.sha256).digest() for i in range(1 + (len(surface) + 8 * attempt) // 16))
    n = iter(stream * 2)
    script = "cyrillic" if re.search(r"[А-яЁё]", surface) else "latin"

    def like(c: str) -> str:
        if c.isdigit():
            return str(next(n) % 10)
        if c.isascii() and c.isalpha():
            x = chr(97 + next(n) % 26)
            return x.upper() if c.isupper() else x
        return c

    def cased(word: str) -> str:
        return word.upper() if len(surface) > 1 and surface.isupper() else word.title() if surface[:1].isupper() else word

    if part == "given":
        names = _GIVEN[script, gender(surface)]
        extra = "".join(_SYLLABLES[script][next(n) % 20] for _ in range(attempt))  # before the name, whose end tells the gender
        return cased((extra + names[next(n) % len(names)]).lower())
    if part == "family":
        return cased("".join(_SYLLABLES[script][next(n) % 20] for _ in range(3 + attempt)))
    more = "".join(str(next(n) % 10) for _ in range(attempt // 2))  # widens the space of a format that is used up
    if part == "email":
        m = re.match(rf"(.*?)({_AT})(.*)$", surface, re.I | re.S)
        user, sign, domain = m.groups() if m else (surface, "@", "example.org")
        tail = re.search(rf"{_DOT}[^\W\d_]+$", domain, re.I)
        end = tail.group() if tail else ".org"
        return "".join(map(like, user)) + "".join(chr(97 + int(c)) for c in more) + sign + "".join(map(like, domain[: len(domain) - len(end)])) + end
    if part == "phone":
        m = re.match(r"\(?\+\d{1,2}\)?|00\d\d", surface)
        head = m.group() if m else ""
        return head + "".join(map(like, surface[len(head) :])) + more
    if part == "address":
        def word(m: re.Match) -> str:
            w = m.group()
            if w.isdigit():
                return str(1 + (next(n) * 256 + next(n)) % 199)
            if _STREET_PART.search(w) or not w[0].isupper() or len(w) < 4:
                if (t := re.match(rf"(\w*?)({_STREET_PART.pattern}\w*)$", w, re.I)) and len(t[1]) > 1 and t[1].isalpha():
                    return "".join(_SYLLABLES[script][next(n) % 20] for _ in range(2 + attempt)).title() + t[2]
                return w
            return "".join(_SYLLABLES[script][next(n) % 20] for _ in range(2 + attempt)).title()

        return re.sub(r"\d+|[^\W\d_]+", word, surface) + (f"-{more}" if more else "")
    return "".join(map(like, surface)) + more


def detect(pairs: DataFrame, known: set[str], given: set[str], model: NameModel | None = None, source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id") -> DataFrame:
    """row_id, field, text, found (kind, part, start, end, surface, key) of each segment that holds an entity."""
    sc = pairs.sparkSession.sparkContext
    lexicon = sc.broadcast((known, given, model))
    segs = spread(pairs.select(row_id, source, target)).select(F.col(row_id).alias("row_id"), F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("text")) for n in (source, target)])).alias("x"))
    segs = segs.select("row_id", "x.field", "x.text").filter("row_id IS NOT NULL AND text <> ''")
    kind = dict(pairs.dtypes)[row_id]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        d = Detector(*lexicon.value)
        for b in batches:
            got = d.find_all(b["text"].tolist())
            keep = [k for k, g in enumerate(got) if g]
            if keep:  # strings and lists of an empty selection can't be sent back
                out = b.iloc[keep].reset_index(drop=True)
                out["found"] = [[{"kind": k, "part": p, "start": s, "end": e, "surface": t[s:e], "key": entity_key(t[s:e], p)} for s, e, k, p in g] for t, g in zip(out["text"], (g for g in got if g))]
                yield out

    return segs.mapInPandas(run, f"row_id {kind}, field STRING, text STRING, found ARRAY<STRUCT<kind: STRING, part: STRING, start: INT, `end`: INT, surface: STRING, key: STRING>>")


def fit_names(pairs: DataFrame, known: set[str], given: set[str], source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id", part_pairs: int = PART_PAIRS) -> NameModel:
    """The model of names for a corpus: words counted in all its segments, weights fitted on all its candidates.

    Each part of about part_pairs pairs, by hash, gives weights; those of a feature are averaged by how sure each part is of
    them, after either round. The sums are of integers: the same at every size of cluster.
    """
    spark = pairs.sparkSession
    rows = pairs.select(row_id, source, target).filter(F.col(row_id).isNotNull())
    parts = max(1, -(-rows.count() // part_pairs))
    h, side = F.xxhash64(row_id), lambda k, name: F.struct(F.lit(k).alias("side"), F.col(name).alias("text"))
    segs = spread(rows).select(F.pmod(F.xxhash64(row_id, source, target), F.lit(parts)).alias("part"), h.alias("h"), F.explode(F.array(side(0, source), side(1, target))).alias("x")).select("part", "h", "x.side", "x.text").filter("text <> ''")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, small = Counter(), Counter()
        for b in batches:
            words, n, low = names.count_words([flat(t)[0] for t in b["text"]])
            seen.update(dict(zip(words, n)))
            small.update(dict(zip(words, low)))
            if len(seen) > names.WORDS_KEPT:
                yield pd.DataFrame({"word": list(seen), "n": list(seen.values()), "small": [small[w] for w in seen]})
                seen, small = Counter(), Counter()
        if seen:
            yield pd.DataFrame({"word": list(seen), "n": list(seen.values()), "small": [small[w] for w in seen]})

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"key": [names.word_key(w) for w in b["word"]], "code": [names.word_code(n, s) for n, s in zip(b["n"].tolist(), b["small"].tolist())]})

    counted = segs.select("text").mapInPandas(count, "word STRING, n LONG, small LONG").groupBy("word").agg(F.sum("n").alias("n"), F.sum("small").alias("small"))
    table = counted.mapInPandas(code, "key LONG, code SHORT").toArrow()
    model = NameModel(words=names.Words(table["key"].to_numpy(), table["code"].to_numpy()))
    d = Detector(known, given)
    made = names.made_examples(model, names.plain_words(model.words, d.known, given), given)
    shared = spark.sparkContext.broadcast((known, given, model))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, given, model = shared.value
        d = Detector(known, given)
        full = names.FullWords(names.plain_words(model.words, d.known, given))
        titled = lambda t: [f for f in d.told(t, is_cased(t), set(_TOKEN.findall(t.lower())))]
        for b in batches:
            got = [(p, h, s, k, *x) for p, h, s, xs in zip(b["part"], b["h"], b["side"], names.all_examples([flat(t)[0] for t in b["text"]], model, full, given, titled)) for k, x in enumerate(xs)]
            if got:
                yield pd.DataFrame(got, columns=["part", "h", "side", "k", "told", "a", "b"])

    found = materialise(segs.mapInPandas(find, "part LONG, h LONG, side INT, k INT, told BOOLEAN, a ARRAY<INT>, b ARRAY<INT>"), "names-found")

    def averaged(first: np.ndarray | None) -> np.ndarray:
        sent = spark.sparkContext.broadcast((made, first))

        def weigh(rows: pd.DataFrame) -> pd.DataFrame:
            rows = rows.sort_values(["h", "side", "k"], kind="stable")
            w, sure = names.fit_round(sent.value[0], list(zip(rows["told"], rows["a"], rows["b"])), sent.value[1])
            at = np.flatnonzero(w)
            return pd.DataFrame({"bucket": at, "ws": np.rint(w[at] * sure[at] * _UNIT).astype(np.int64), "s": np.rint(sure[at] * _UNIT).astype(np.int64)})

        got = found.repartition(min(parts, MOST_TASKS), "part").groupBy("part").applyInPandas(weigh, "bucket INT, ws LONG, s LONG").groupBy("bucket").agg(F.sum("ws").alias("ws"), F.sum("s").alias("s")).toArrow()
        out = np.zeros(names.BUCKETS)
        out[got["bucket"].to_numpy()] = got["ws"].to_numpy() / got["s"].to_numpy()
        sent.unpersist()
        return out

    if found.isEmpty():  # no candidate: the sentences alone
        first = names.fit_round(made, [])[0]
        weights = names.fit_round(made, [], first)[0]
    else:
        weights = averaged(averaged(None))
    discard(found)
    return NameModel(weights.astype(np.float32), model.words)


def assign_surrogates(entities: DataFrame, secret: str) -> DataFrame:
    """part, key, surface -> part, key, new, n: distinct for distinct entities of a part, never a real entity's own key; n mentions.

    Drawn for all entities at once, then in rounds for those whose draw is a real entity's or another's (the smallest key
    keeps it). The space that is drawn from widens with each round, so the rounds end for any number of entities.
    """
    secret_bytes = secret.encode()
    if not secret_bytes:
        raise ValueError("surrogates need a secret key")

    def draw(attempt: int):
        @F.pandas_udf("struct<new: string, new_key: string>")
        def f(surface: pd.Series, part: pd.Series, key: pd.Series) -> pd.DataFrame:
            new = [surrogate(s, p, k, secret_bytes, attempt) for s, p, k in zip(surface, part, key)]
            return pd.DataFrame({"new": new, "new_key": [entity_key(x, p) for x, p in zip(new, part)]})

        return f

    todo = entities = materialise(entities.groupBy("part", "key").agg(F.min("surface").alias("surface"), F.count(F.lit(1)).alias("n")), "pii-entities")
    taken = entities.select("part", F.col("key").alias("new_key"), F.lit(None).cast("struct<key: string, new: string, n: bigint>").alias("own"))
    done, attempt = [], 0
    while True:
        drawn = todo.withColumn("d", draw(attempt)("surface", "part", "key")).select("part", "d.new_key", F.struct("key", "d.new", "n").alias("own"))
        won = taken.unionByName(drawn).groupBy("part", "new_key").agg(F.count_if(F.col("own").isNull()).alias("before"), F.min("own").alias("own"))
        won = materialise(won.filter("before = 0").select("part", "own.key", "own.new", "own.n", "new_key"), "pii-won")
        done.append(won)
        left = materialise(todo.join(won.select("part", "key"), ["part", "key"], "left_anti"), "pii-left")
        if todo is not entities:
            discard(todo)
        todo = left
        if todo.isEmpty():
            break
        taken = taken.unionByName(won.select("part", "new_key", F.lit(None).cast("struct<key: string, new: string, n: bigint>").alias("own")))
        attempt += 1
    out = done[0]
    for d in done[1:]:
        out = out.unionByName(d)
    return out.select("part", "key", "new", "n")


#: An entity with more mentions than this and than a thousandth of all is joined by a broadcast: there are a thousand of them at most.
HOT_MENTIONS = 10_000


def _with_surrogates(mentions: DataFrame, new: DataFrame) -> DataFrame:
    """mentions with their new, split so that no entity's mentions are one task's."""
    total = new.agg(F.sum("n")).first()[0] or 0
    hot = new.filter(F.col("n") > max(HOT_MENTIONS, total // 1000)).select("part", "key", F.col("new").alias("hot_new"))
    new = new.select("part", "key", "new")
    if hot.isEmpty():
        return mentions.join(new, ["part", "key"])
    marked = mentions.join(F.broadcast(hot), ["part", "key"], "left")
    rest = marked.filter("hot_new IS NULL").drop("hot_new").join(new, ["part", "key"])
    return marked.filter("hot_new IS NOT NULL").withColumnRenamed("hot_new", "new").unionByName(rest)


def replace_entities(pairs: DataFrame, known: set[str], given: set[str], secret: str, model: NameModel | None = None, source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id") -> DataFrame:
    """row_id, field, kinds, masked, surrogated: each segment with an entity, with typed placeholders ([EMAIL] ...) and with surrogates.

    secret: the key of the surrogates; who has it can find out which entity a surrogate stands for by trying. model: of names
    (fit_names); without one only titles, initials and given tell names. Null and empty segments hold none; rows without an id
    are left out; a row that comes twice gives one. Texts are read whole; extra columns are ignored. The order of rows, of
    copies and of partitions changes nothing: a surrogate depends on the secret and the set of entities only.
    """
    hits = materialise(detect(pairs, known, given, model, source, target, row_id).dropDuplicates(["row_id", "field", "text"]).withColumn("digest", F.md5("text")), "pii-hits")
    mentions = hits.select("row_id", "field", "digest", F.explode("found").alias("m")).select("row_id", "field", "digest", "m.*")
    new = assign_surrogates(mentions.select("part", "key", "surface"), secret)
    marks = _with_surrogates(mentions, new).groupBy("row_id", "field", "digest").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind", "new"))).alias("marks"))
    rows = hits.select("row_id", "field", "digest", "text").join(marks, ["row_id", "field", "digest"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            masked, other = [], []
            for text, ms in zip(b["text"], b["marks"]):
                x, y, at, last = [], [], 0, None
                for m in ms:
                    gap = text[at : m["start"]]
                    if not (m["kind"] == "name" and last == "name" and not gap.strip(" ,.")):
                        x += [gap, f"[{m['kind'].upper()}]"]
                    y += [gap, m["new"]]
                    at, last = m["end"], m["kind"]
                masked.append("".join(x) + text[at:])
                other.append("".join(y) + text[at:])
            yield pd.DataFrame({"row_id": b["row_id"], "field": b["field"], "kinds": [sorted({m["kind"] for m in ms}) for ms in b["marks"]], "masked": masked, "surrogated": other})

    kind = dict(pairs.dtypes)[row_id]
    return rows.mapInPandas(run, f"row_id {kind}, field STRING, kinds ARRAY<STRING>, masked STRING, surrogated STRING").withColumnRenamed("row_id", row_id)


def lexicon(spark: SparkSession, sf_dir: str) -> tuple[set[str], set[str]]:
    """Ordinary words (of the fixed sample, stop word and orthography tables, a few thousand) and given names."""
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+(?:['’\-]\p{L}+)*)"), 1))
    # a word that only ever occurs once, capitalised, in the samples is rather an invented name
    words = {r[0] for r in collect_small(read("lang_samples").select(word.alias("w")).groupBy("w").count().filter("count > 1"))}
    words |= {r[0].lower() for r in collect_small(read("stopwords").select("word")) if r[0]}
    words |= {x.lower() for r in collect_small(read("orthography").select("wrong", "correct")) for x in r if x}
    given = {r[0].lower() for r in collect_small(read("given_names").select("given_name").distinct()) if r[0]}
    return words, given


def secret_of(spark: SparkSession) -> str:
    """The setting spark.linepress.secret; where it isn't set, a key made for this run and forgotten after it."""
    return spark.conf.get("spark.linepress.secret", None) or secrets.token_hex(32)


def replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = spark.read.parquet(f"{sf_dir}/bifixer.parquet")
    known, given = lexicon(spark, sf_dir)
    return replace_entities(pairs, known, given, secret_of(spark), fit_names(pairs, known, given))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replaced(spark, sf_dir).select("pair_id", "field", F.explode("kinds").alias("kind")).filter(F.col("kind").isin(*KINDS)).distinct()
