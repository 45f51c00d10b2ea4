"""Names of persons among sequences of words that no lexicon knows: candidates scored by a linear model of form and context.

A candidate is a run of two to four words, particles and initials aside, none of which is an ordinary word. Its features are
the words and marks around it, the form of its words, and what the whole corpus says of them (how often a word occurs, how often
in lower case). The model is a logistic regression over hashed features, fitted on all candidates of the corpus and on the
sentences below. In the corpus, candidates that a title or a listed given name tells are positive; the rest are unlabelled, as
the list of given names isn't complete, so they are fitted in two rounds: first as negative at a low weight, then those that
the first model finds likely as positive, those it finds unlikely as negative, and those between not at all.
"""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections.abc import Iterable
from dataclasses import dataclass, field
from math import exp

import numpy as np

from linepress.llm.arrays import characters, kinds, numbered, runs

BUCKETS = 1 << 15
#: Words whose codes a worker remembers; beyond it the memory is emptied (results don't depend on it).
WORDS_KEPT = 200_000
#: Confidence from which a candidate is a name.
SURE = 0.3
#: Weight of an unlabelled candidate of the corpus in the first round; what it must score to count as a name or as none in the second.
UNLABELLED_WEIGHT, LIKELY, UNLIKELY = 0.2, 0.3, 0.04

#: Words in names of persons that aren't names themselves.
PARTICLES = frozenset("de da do dos das van von der den del la le du af ter ten zu y e di della el al bin ibn".split())
#: Fixed values, by language: words that stand before places or things rather than persons.
DETERMINERS = frozenset("the a an this that every der die das dem den des ein eine jeder diese le la les un une cette ce el los las una este esta o os as um uma den det en ett de het een in im at near from to into nach aus bei à dans en vers depuis em no na nos nas para i på fra från til till te bij naar uit в на из под к".split())
#: Words of which names of bodies, places, works and days consist.
BODIES = re.compile(
    r"universit|institut|ministe|council|committee|commission|kommission|ausschuss|rat$|bank$|group|gruppe|gmbh|^inc|^ltd|^corp|compan|society|gesellschaft|association|verein|museum|musée|museo|school|schule|college|church|kirche|hospital|klinik|theat|orchest|party|partei|partido|union|office|amt$|court|street|straße|straat|strasse|^rua$|travessa|^calle$|avenida|^plaza$|praça|^rue$|gatan$|road|avenue|platz|park$|garden|garten|river|fluss|lake|^see$|sea$|ocean|mount|berg$|island|insel|valley|north|south|east|west|nord|süd|sur$|norte|new$|neu|nouve|nuev|novo|nova|nya|nieuw|saint|sankt|^san$|santa|^são|port$|city|ville$|stadt|ciudad|cidade|republi|kingdom|state|staat|estado|federa|europ|international|national|central|royal|festival|award|prize|cup$|league|liga$|act$|report|treaty|agreement"
    r"|monday|tuesday|wednesday|thursday|friday|saturday|sunday|january|february|march|april|june|july|august|september|october|november|december|montag|januar|lundi|janvier|lunes|enero|понедельник|января|универс|институт|министер|комитет|совет|банк|общество|музей|школа|театр|партия|союз|улица|река|озеро|остров|город|республик|федерац|европ|новый|новая|северн|южн",
    re.I,
)

# -- labelled sentences: {N} a name of a person, {X} two words that are none -------------------------------------------------
SENTENCES = {
    "en": (["My name is {N}.", "I am {N} and I live here.", "Best regards, {N}", "Kind regards\n{N}", "The patient, {N}, was seen on Monday.", "Contact: {N}", "{N} said that the plan was late.", "According to {N}, it is over.", "We met {N} yesterday.", "The book by {N} was sold.", "His wife {N} came later.", "Dear {N},", "Please call {N} at home.", "{N} was born in the village.", "Author: {N}", "a letter from {N}", "{N} and {N} were married."], ["We went to {X} by train.", "The {X} was opened last year.", "It was made by the {X}.", "They live near {X}.", "He works at {X}.", "{X} is a large town.", "The new {X} costs more.", "from {X} to the coast", "in {X}, where it rains"]),
    "de": (["Mein Name ist {N}.", "Ich heiße {N}.", "Mit freundlichen Grüßen {N}", "Der Patient {N} wurde entlassen.", "Kontakt: {N}", "{N} sagte, dass es zu spät sei.", "Wir haben {N} getroffen.", "Ansprechpartner ist {N}.", "Das Buch von {N} wurde verkauft.", "Seine Frau {N} kam später.", "Liebe {N},", "Laut {N} ist das vorbei."], ["Wir fuhren nach {X}.", "Die {X} wurde eröffnet.", "Sie wohnen bei {X}.", "Der {X} ist neu.", "in {X} am Fluss", "Das {X} kostet mehr."]),
    "fr": (["Je m'appelle {N}.", "Mon nom est {N}.", "Cordialement, {N}", "Le patient {N} est sorti.", "Contact : {N}", "{N} a dit que non.", "Selon {N}, c'est fini.", "Nous avons rencontré {N}.", "Sa femme {N} est venue.", "Cher {N},"], ["Nous allons à {X}.", "La {X} a été ouverte.", "Le {X} coûte plus.", "Ils habitent près de {X}.", "dans {X} en hiver"]),
    "es": (["Mi nombre es {N}.", "Me llamo {N}.", "Saludos, {N}", "El paciente {N} salió.", "Contacto: {N}", "{N} dijo que no.", "Según {N}, se acabó.", "Conocimos a {N}.", "Su mujer {N} llegó.", "Estimada {N}:"], ["Fuimos a {X} en tren.", "La {X} fue abierta.", "El {X} cuesta más.", "Viven cerca de {X}.", "en {X} llueve"]),
    "pt": (["O meu nome é {N}.", "Chamo-me {N}.", "Cumprimentos, {N}", "O doente {N} saiu.", "Contacto: {N}", "{N} disse que não.", "Segundo {N}, acabou.", "A mulher dele, {N}, chegou.", "Cara {N},"], ["Fomos a {X} de comboio.", "A {X} foi aberta.", "O {X} custa mais.", "Vivem perto de {X}.", "em {X} chove"]),
    "da": (["Mit navn er {N}.", "Jeg hedder {N}.", "Venlig hilsen {N}", "Patienten {N} blev udskrevet.", "Kontakt: {N}", "{N} sagde nej.", "Ifølge {N} er det forbi.", "Vi mødte {N}.", "Hans kone {N} kom senere.", "Kære {N}"], ["Vi rejste til {X}.", "Den nye {X} blev åbnet.", "De bor nær {X}.", "i {X} om vinteren"]),
    "sv": (["Mitt namn är {N}.", "Jag heter {N}.", "Vänliga hälsningar {N}", "Patienten {N} skrevs ut.", "Kontakt: {N}", "{N} sade nej.", "Enligt {N} är det slut.", "Vi träffade {N}.", "Hans fru {N} kom senare.", "Kära {N}"], ["Vi reste till {X}.", "Den nya {X} öppnades.", "De bor nära {X}.", "i {X} på vintern"]),
    "nl": (["Mijn naam is {N}.", "Ik heet {N}.", "Met vriendelijke groet, {N}", "De patiënt {N} is ontslagen.", "Contact: {N}", "{N} zei nee.", "Volgens {N} is het voorbij.", "Wij ontmoetten {N}.", "Zijn vrouw {N} kwam later.", "Beste {N},"], ["Wij gingen naar {X}.", "Het {X} werd geopend.", "De {X} kost meer.", "Zij wonen bij {X}.", "in {X} regent het"]),
    "ru": (["Меня зовут {N}.", "Моё имя {N}.", "С уважением, {N}", "Пациент {N} выписан.", "Контакт: {N}", "{N} сказал, что нет.", "По словам {N}, всё кончено.", "Мы встретили {N}.", "Его жена {N} пришла.", "Уважаемый {N}!"], ["Мы поехали в {X}.", "Новый {X} был открыт.", "Они живут у {X}.", "из {X} до моря"]),
}
_PARTS = ("ba be bar ber bor bran cal cor dal den dor el fen fer gar gor hal har hol il jan kar kel lan len lor mal mar mel nar nel nor or pal pen per ran rel ric ros sal sen sol tal tan ter tor ul val ven ver vol wen wil yor zan".split(), "бар бер бор вал вер гор дал ден дор кар кел лан лен лор мал мар мел нар нел пал пен ран рел рос сал сен сол тал тан тер тор ул".split())
_ENDS = ("son sen man berg stein ton ley er ers ez es ard eau etti ini ström lund qvist dal gaard huis mans ker feld ova wood field worth shaw by well smith ford".split(), "ов ев ин ский ова ева ина ская енко ук".split())
_GIVEN_ENDS = ("a e o us an el in on ia ine ette ard ric ert old win is as y ie".split(), "а я ий ей ил ан ор ина ия ена".split())
_PLACES = ("City North Port Bay Museum University Council Bank River Island Valley Institute Group Festival".split(), "Город Река Остров Музей Банк Союз".split())

_WORD = r"[^\W\d_]+(?:['’\-][^\W\d_]+)*"
_WORDS = re.compile(_WORD)
#: Characters as _WORD and what may stand between the words of a name tell them apart.
_KINDS = (r"[^\W\d_]", r"['’\-]", r"[ \n,.]")
_LETTER, _JOINT, _GAP = range(1, 4)
#: Characters as is_cased tells them apart.
_CASES = (str.isspace, str.isupper, str.islower)
_BLANK, _CAPITAL, _SMALL = range(1, 4)
_TOKEN = re.compile(rf"(?P<w>{_WORD})(?P<dot>\.)?")
#: Letters of one script, the apostrophe and the hyphen.
_LETTERS = re.compile(r"[A-Za-zÀ-ÖØ-öø-ɏ'’\-]+|[\u0400-\u052f'’\-]+")
_INNER_CAPITAL = re.compile(r"(?:[^\W\d_]+['’\-])+[^\W\d_]+$|(?:Mc|Mac|De|Di|Le|La|Van|Fitz)[^\W\d_a-z][a-z]+$")
#: Letters that _TWO_CAPITALS takes for capitals, any beyond the basic plane, as one set, which is searched faster; two of them.
_CAPITALS = "".join(map(re.escape, re.findall(r"[^\W\d_a-zß-öø-ÿа-яё]", "".join(map(chr, range(0x10000)))))) + "\U00010000-\U0010ffff"
_FAR_CAPITALS = re.compile(f"[{_CAPITALS}][^{_CAPITALS}]*+[{_CAPITALS}]")
_UPPER = re.compile("[" + "".join(re.escape(c) for c in map(chr, range(0x10000)) if c.isupper()) + "]")
_BEYOND = re.compile("[\U00010000-\U0010ffff]")
_NOT_UPPER, _NOT_LOWER = (bytes(set(range(256)) - set(x)) for x in (b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"))
_TWO_CAPITALS = re.compile(rf"(?<![\w'’-])[^\W\d_a-zß-öø-ÿа-яё]{_WORD}(?:\.?\s+(?:[^\W\d_]\.\s*|\w{{1,3}}\s+){{0,3}}|,\s?)[^\W\d_a-zß-öø-ÿа-яё]")


def word_key(word: str) -> int:
    return int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def word_code(n: int, small: int) -> int:
    """What the model keeps of a word that occurs in n texts, in small of them in lower case: their ratio, the magnitude of n,
    and whether it is usually written small."""
    return 1 + 3 * small // n | min(12, n.bit_length()) << 3 | (small >= 2 and small >= 0.3 * n) << 7


class Words:
    """The words of a corpus by their hashes of 64 bits, nine bytes each; word in words: whether it is usually written small."""

    def __init__(self, keys: np.ndarray = (), codes: np.ndarray = ()):
        keys, codes = np.asarray(keys, np.int64), np.asarray(codes, np.uint8)
        order = np.argsort(keys)
        self.keys, self.codes, self.kept = keys[order], codes[order], {}

    def __reduce__(self):
        return Words, (self.keys, self.codes)

    def code(self, word: str) -> int:
        """0 for a word that doesn't occur."""
        if (c := self.kept.get(word)) is None:
            if len(self.kept) > WORDS_KEPT:
                self.kept.clear()
            key = word_key(word)
            i = int(np.searchsorted(self.keys, key))
            c = self.kept[word] = int(self.codes[i]) if i < len(self.keys) and self.keys[i] == key else 0
        return c

    def __contains__(self, word: str) -> bool:
        return self.code(word) > 127


@dataclass
class NameModel:
    """weights of the hashed features; words: what the corpus says of its words."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    words: Words = field(default_factory=Words)

    def score(self, features: Iterable[str]) -> float:
        z = float(sum(self.weights[zlib.crc32(f.encode()) % BUCKETS] for f in features))
        return 1 / (1 + np.exp(-max(-30.0, min(30.0, z))))


def is_cased(t: str) -> bool:
    """Whether capitals tell something in t: it isn't written in capitals, nor every word with one."""
    plain = t.encode("utf-8", "surrogatepass")
    small = len(plain.translate(None, _NOT_LOWER))
    if t.isascii():
        upper = len(plain.translate(None, _NOT_UPPER))
    else:
        upper = sum(map(str.isupper, t)) if _BEYOND.search(t) else len(_UPPER.findall(t))
        if upper >= 0.43 * small:  # not all small letters are counted
            small = sum(map(str.islower, t))
    if upper >= 0.43 * small:
        return False
    words = t.split()
    return not (len(words) > 3 and upper > 0.8 * len(words) and sum(w[0].isupper() for w in words) > 0.8 * len(words))


def may_hold(t: str) -> bool:
    """A cheap test that texts with a candidate pass."""
    return _FAR_CAPITALS.search(t) is not None and _TWO_CAPITALS.search(t) is not None or t.islower() or t.isupper()


def full_word(w: str, cased: bool, ordinary) -> bool:
    """Whether w could be one of the words of a name that are no particle."""
    return len(w) > 2 and _LETTERS.fullmatch(w) is not None and (not cased or w[0].isupper() and (w[1:].islower() or w.isupper() or _INNER_CAPITAL.match(w) is not None)) and w.lower() not in PARTICLES and not ordinary(w.lower())


class FullWords:
    """full_word() of many texts at once; remembers the words met (results don't depend on it)."""

    def __init__(self, ordinary):
        self.ordinary, self.kept = ordinary, {}

    def _kind(self, w: str) -> int:
        """1: full in text where capitals tell nothing; 2: in other text; 4: may stand between two words of a name."""
        return full_word(w, False, self.ordinary) + 2 * (w[0].isupper() and full_word(w, True, self.ordinary)) + 4 * (len(w) == 1 or w.lower() in PARTICLES)

    def near_in(self, ts: Texts) -> np.ndarray:
        """Whether each of the texts has two such words with nothing but blanks, commas, full stops, initials and particles between
        them, as any with a candidate has."""
        if len(self.kept) > WORDS_KEPT:
            self.kept.clear()
        for w in ts.distinct:
            if w not in self.kept:
                self.kept[w] = self._kind(w)
        kind = np.fromiter(map(self.kept.__getitem__, ts.distinct), np.uint8, len(ts.distinct))[ts.number]
        at = np.flatnonzero(kind < 4)
        full, text = kind[at] & np.where(ts.cased, 2, 1)[ts.text[at]] > 0, ts.text[at]
        near = full[1:] & full[:-1] & (text[1:] == text[:-1])
        near[near] = ts.marks[at[1:][near]] == ts.marks[at[:-1][near]]
        return np.bincount(text[1:][near], minlength=len(ts.texts)) > 0


def candidates(t: str, cased: bool, ordinary) -> list[tuple[tuple[int, int], tuple[int, int], bool]]:
    """(span of the first word, span of the last, family first?) of the runs of words in t that could be a name; ordinary(word)
    tells words that are no part of one."""
    if cased and not may_hold(t):
        return []

    # a run has two such words at least; most texts don't, which is told faster from the words alone
    if sum(1 for w in _WORDS.findall(t) if (w[0].isupper() or not cased) and full_word(w, cased, ordinary)) < 2:
        return []
    out = []
    tokens = list(_TOKEN.finditer(t))
    n = len(tokens)
    full = lambda m: full_word(m["w"], cased, ordinary)
    for i in range(n - 1):
        a = tokens[i]
        if cased and not t[a.start()].isupper() or not full(a) or a["dot"] and i + 1 < n and t[a.end() : a.end() + 1] == " " and len(a["w"]) > 3:
            continue
        j, given = i + 1, 1
        last = a
        while j < n and j - i < 5:
            m = tokens[j]
            gap = t[last.end() : m.start()]
            if gap == "," or gap == ", ":
                if last is a and full(m) and not (m["dot"] and len(m["w"]) == 1):
                    out.append((a.span("w"), m.span("w"), True))
                break
            if gap.strip(" \n") or last["dot"] and len(last["w"]) > 3:
                break
            if full(m):
                given += 1
                out.append((a.span("w"), m.span("w"), False))
                if given == 3:
                    break
            elif not (len(m["w"]) == 1 and m["dot"] or m["w"].lower() in PARTICLES):
                break
            last = m
            j += 1
    return out


def features_of(t: str, first: tuple[int, int], last: tuple[int, int], swapped: bool, cased: bool, model: NameModel, given: bool = True) -> list[str]:
    """given: with the letters of the given name."""
    a, b = t[first[0] : first[1]], t[last[0] : last[1]]
    before = re.findall(r"\w+|[^\w\s]", t[max(0, first[0] - 40) : first[0]].lower())[-3:]
    after = re.findall(r"\w+|[^\w\s]", t[last[1] : last[1] + 24].lower())[:2]
    words = [w for w in before if w[0].isalpha()]
    middle = t[first[1] : last[0]]
    p1 = before[-1] if before else "^"
    out = ["bias", f"p1={p1}", f"n1={after[0] if after else '$'}", f"p2={' '.join(before[-2:])}", f"pw={words[-1] if words else '^'}", f"n2={' '.join(after)}"]
    out += [f"cased={cased}", f"swapped={swapped}", f"words={1 + len(middle.split())}", f"particle={bool(re.search(r'[a-z]{2}', middle))}", f"initial={'.' in middle}"]
    if p1 in DETERMINERS:
        out.append("determiner")
    if before and not p1[0].isalnum():
        out.append("mark before")
    if any(BODIES.search(w) for w in re.findall(r"\w+", t[first[0] : last[1]])):
        out += ["body", "body"]
    for name, w in (("a", a), ("b", b)):
        low = w.lower()
        code = model.words.code(low)
        out += [f"{name}small={code & 7}", f"{name}case={w[1:].islower()}{w.isupper()}"]
        if not given and (name == "b") == swapped:
            continue
        out += [f"{name}s2={low[-2:]}", f"{name}s3={low[-3:]}", f"{name}s4={low[-4:]}", f"{name}p3={low[:3]}", f"{name}n={code >> 3 & 15}"]
    return out


def buckets(features: Iterable[str]) -> list[int]:
    return [zlib.crc32(f.encode()) % BUCKETS for f in features]


def fit(rows: list[tuple[list[int], float, float]], seed: int = 3, epochs: int = 8, rate: float = 0.25) -> tuple[np.ndarray, np.ndarray]:
    """Logistic regression over hashed features of rows (buckets, label, weight), by Adagrad: the weights, and how sure they are
    (the sums of squared gradients)."""
    rng = np.random.default_rng(seed)
    w, g2 = np.zeros(BUCKETS), np.full(BUCKETS, 1e-2)
    xs = [np.array(sorted(set(x))) for x, _, _ in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)).tolist():
            x, (_, y, k) = xs[i], rows[i]
            wx, gx = w.take(x), g2.take(x)
            g = k * (1 / (1 + exp(-max(-30.0, min(30.0, wx.sum())))) - y) + 1e-4 * wx
            gx += g * g
            g2[x] = gx
            w[x] = wx - rate * g / np.sqrt(gx)
    return w, g2


def _made(rng: random.Random, cyrillic: bool, given: list[str]) -> tuple[str, str]:
    """A made-up name of a person and one of a place or body."""
    k = int(cyrillic)
    coin = lambda ends: ("".join(rng.choices(_PARTS[k], k=rng.randint(1, 2))) + rng.choice(ends[k])).capitalize()
    first = rng.choice(given) if given and rng.random() < 0.2 else coin(_GIVEN_ENDS)
    middle = rng.choice(["", "", "", "", " " + coin(_GIVEN_ENDS)[0] + ".", "" if cyrillic else " " + rng.choice(["de", "van", "von", "del"])])
    person = f"{first}{middle} {coin(_ENDS)}"
    kind = rng.random()
    thing = coin(_ENDS) + " " + rng.choice(_PLACES[k]) if kind < 0.4 else rng.choice(_PLACES[k]) + " " + coin(_ENDS) if kind < 0.7 else coin(_ENDS) + " " + coin(_ENDS)
    return person, thing


class Texts:
    """Many texts at once: their words as _WORDS.findall() finds them, one after another, as distinct ones and the number of each
    among them; the text of each word; whether is_cased() each text."""

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.codes, self.last = characters(texts)
        self.kind = kinds(self.codes, _KINDS)
        own = self.kind == _LETTER
        at = np.flatnonzero(self.kind == _JOINT)
        own[at[own[at - 1] & own[at + 1]]] = True
        words, first = runs(self.codes, own)
        self.distinct, self.number = numbered(words)
        self.text = np.searchsorted(self.last, first)
        #: Marks, digits and the like before each word, counted from the first text on; full stops, commas and blanks are none.
        self.marks = np.searchsorted(np.flatnonzero((self.kind != _GAP) & ~own), first)
        case = kinds(self.codes, _CASES)
        first = (case != _BLANK) & (np.roll(case, 1) == _BLANK)
        # a text and the line end before it
        begin = np.append(0, self.last)[:-1] if texts else self.last
        upper, small, n = (np.add.reduceat(x.view(np.uint8), begin, dtype=np.int64) for x in (case == _CAPITAL, case == _SMALL, first))
        self.cased = upper < 0.43 * small
        for i in np.flatnonzero(self.cased & (n > 3) & (upper > 0.8 * n)).tolist():
            self.cased[i] = is_cased(texts[i])


def _texts_of(number: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """number, from 0 to n, and text without those that come again, by number, and how many are left of each number."""
    by = np.argsort(number.astype(np.uint16) if n < 1 << 16 else number, kind="stable")  # small integers are sorted faster
    number, text = number[by], text[by]
    new = (np.diff(number, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0)
    return number[new], text[new], np.bincount(number[new], minlength=n)


def count_words(texts: list[str]) -> tuple[list[str], list[int], list[int]]:
    """The words in lower case, in how many texts each occurs, and in how many of them in lower case; words as in words_of."""
    ts = Texts(texts)
    cased = ts.cased[ts.text]
    # texts come in order, so that the numbers of a text are together after a stable sort
    number, text, times = _texts_of(ts.number[cased], ts.text[cased], len(ts.distinct))
    lower, low = numbered([w.lower() for w in ts.distinct])
    by = np.argsort(text, kind="stable")
    n = _texts_of(low[number][by], text[by], len(lower))[2]
    # a word that is small is its own lower case
    small = {w: k for w, k in zip(ts.distinct, times.tolist()) if w.islower()}
    met = [(w, k, small.get(w, 0)) for w, k in zip(lower, n.tolist()) if k]
    return [w for w, _, _ in met], [k for _, k, _ in met], [k for _, _, k in met]


def words_of(t: str) -> set[str]:
    """The words of a text as the corpus counts them, each once; none where capitals tell nothing."""
    return set(_WORDS.findall(t)) if is_cased(t) else set()


def plain_words(words: Words, known: set[str], given: set[str]):
    """The test of a word that is no part of a name."""
    return lambda w: w not in given and (w in known or w in words)


def examples(t: str, model: NameModel, plain, given: set[str], titled) -> list[tuple[bool, list[int], list[int]]]:
    """(told to be a name, buckets, buckets without the letters of the given name) of the candidates in t that are told or
    overlap with none that is. titled(text): spans of the names that a title tells."""
    cased = is_cased(t)
    cs = candidates(t, cased, plain)
    if not cs:
        return []
    told = {b for _, b in titled(t)}
    taken = [c for c in cs if t[slice(*(c[1] if c[2] else c[0]))].lower() in given or c[1][1] in told]
    return [
        (c in taken, *(buckets(features_of(t, *c, cased, model, k)) for k in (True, False)))
        for c in cs
        if c in taken or not any(c[0][0] < x[1][1] and x[0][0] < c[1][1] for x in taken)
    ]


def all_examples(texts: list[str], model: NameModel, full: FullWords, given: set[str], titled) -> list[list[tuple[bool, list[int], list[int]]]]:
    """examples() of all texts; full: of the test of plain words."""
    return [examples(t, model, full.ordinary, given, titled) if m else [] for t, m in zip(texts, full.near_in(Texts(texts)).tolist())]


def made_examples(model: NameModel, plain, given: set[str], seed: int = 3) -> list[tuple[float, list[int], list[int]]]:
    """(label, buckets, buckets without the letters of the given name) of the candidates in the labelled sentences."""
    rng = random.Random(seed)
    names = sorted(given)
    rows = []
    for lang, (good, bad) in SENTENCES.items():
        cyrillic = lang == "ru"
        own = [n.title() for n in names if (n[0] > "Ѐ") == cyrillic]
        for y, sentences in ((1.0, good), (0.0, bad)):
            for s in sentences:
                for _ in range(12):
                    person, thing = _made(rng, cyrillic, own)
                    t = re.sub(r"\{N\}|\{X\}", lambda m: person if m.group() == "{N}" else thing, s)
                    for c in candidates(t, True, plain):
                        whole = t[c[0][0] : c[1][1]]
                        rows.append((1.0 if y and whole == person else 0.0, *(buckets(features_of(t, *c, True, model, k)) for k in (True, False))))
    return rows


def fit_round(made: list, found: list[tuple[bool, list[int], list[int]]], first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """One round's weights from the made examples and those found in a part of the corpus; first: the first round's weights."""
    told, rest = [x for x in found if x[0]], [x for x in found if not x[0]]
    if first is None:  # without the letters of given names, which would tell the listed from the others
        return fit([(b, y, 1.0) for y, _, b in made] + [(b, 1.0, 1.0) for _, _, b in told] + [(b, 0.0, UNLABELLED_WEIGHT) for _, _, b in rest])
    scored = [(a, 1 / (1 + np.exp(-np.clip(first[b].sum(), -30, 30)))) for _, a, b in rest]
    likely, unlikely = [a for a, p in scored if p >= LIKELY], [a for a, p in scored if p < UNLIKELY]
    return fit([(a, y, 1.0) for y, a, _ in made] + [(a, 1.0, 1.0) for _, a, _ in told] + [(a, 1.0, 1.0) for a in likely] + [(a, 0.0, 1.0) for a in unlikely])


class NameFinder:
    """Finds names by a model; what it remembers between texts changes no result."""

    def __init__(self, model: NameModel, known: set[str], given: set[str]):
        self.model, self.given = model, given
        self.plain = lambda w: w not in given and (w in known or w in model.words)
        self.full = FullWords(self.plain)

    def find(self, t: str, cased: bool) -> list[tuple[tuple[int, int], tuple[int, int]]]:
        """(span of the given name, span of the family name), not overlapping, the likeliest first choice."""
        scored = []
        for first, last, swapped in candidates(t, cased, self.plain):
            p = self.model.score(features_of(t, first, last, swapped, cased, self.model))
            if p >= SURE:
                scored.append((-p, -(last[1] - first[0]), first, last, swapped))
        out: list[tuple[tuple[int, int], tuple[int, int]]] = []
        taken: list[tuple[int, int]] = []
        for _, _, first, last, swapped in sorted(scored):
            if all(last[1] <= a or first[0] >= b for a, b in taken):
                taken.append((first[0], last[1]))
                out.append((last, first) if swapped else (first, last))
        return out
