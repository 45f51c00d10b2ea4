"""Language of segments and of the parts of mixed ones (problem 2).

The model averages hashed subword embeddings (words and their character n-grams) and feeds the average to a linear
softmax; both are trained by stochastic gradient descent in numpy, first on the driver from the fixed sample table, then from
there on every segment of the corpus whose label the first model confirms: each part of the corpus, by hash, gives scores, and
those of a bucket are averaged by how many words of each part fall into it. As the model is linear in the averaged features, a word's
contribution is nine numbers, computed once per distinct word and worker; a part's scores are sums over its words.
Parts below the threshold found on held-out sentences are rejected: they take the language of their neighbours or, alone,
none (`und`). A text found to be in several languages is judged again without contact details, addresses and names, and its
short parts by a threshold fitted on held-out cuts of their length. The confidence reported is that of the final decision: the
log-odds of all of a language's parts together and their number of words, mapped by a logistic curve fitted on held-out
cuts of one to twenty words, so that of the answers given with confidence c a share of about c is right.
"""

from __future__ import annotations

import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain, compress

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linepress.llm.arrays import characters, kinds, numbered, runs
from linepress.llm.encodings import MISREAD, SHOWN_AS, _byte_to_char, undo_utf8
from linepress.llm.lookalikes import mapping
from linepress.llm.names import NameModel
from linepress.llm.personal import MOST_TASKS, PART_PAIRS, Detector, fit_names
from linepress.llm.personal import lexicon as personal_lexicon
from linepress.session import broadcast_if_small, collect_small, spread

LANGS = ["da", "de", "en", "es", "fr", "nl", "pt", "ru", "sv"]
#: Three-letter codes of the nine languages.
THREE = {"dan": "da", "deu": "de", "ger": "de", "eng": "en", "spa": "es", "fra": "fr", "fre": "fr", "nld": "nl", "dut": "nl", "por": "pt", "rus": "ru", "swe": "sv"}
BUCKETS, DIM = 1 << 15, 16
#: Words of a run that a corpus segment is cut into to learn from, one after another; runs that are learnt at once; the rate at first.
RUN, RUNS_AT_ONCE, CORPUS_RATE = 5, 2048, 0.1
#: Runs of those learnt at once that move a word, or the softmax, at most: more count as so many, lest the steps grow too long.
AT_MOST = 32
#: A run's weight, at most, where its language is rarer in a part of the corpus than others.
MOST_WEIGHT = 4.0
#: Fixed value: what the sums of scores over parts count in.
_UNIT = 1 << 20
#: Words whose scores a worker remembers; beyond it the memory is emptied (results don't depend on it).
WORDS_KEPT = 400_000
#: Texts whose characters are told apart at once (results don't depend on it).
TEXTS_AT_ONCE = 4_000
#: Cost, in nats, of changing language between two parts.
SWITCH_COST = 4.0
#: Evidence a word gives, as a share of a part's log-probability; words beyond WORDS_COUNTED of a part give none.
EVIDENCE_PER_WORD, WORDS_COUNTED = 0.5, 8
#: The answer for segments whose language is rejected or that have no words.
UNDETERMINED = "und"
#: Words of the held-out cuts that the confidence is fitted on.
CUTS = range(1, 21)
#: A language beside the main one with fewer words than these is judged by the threshold for short parts.
WORDS_SURE = 8

_FROM, _TO = mapping()
_FOLD = {ord(c): (_TO[i] if i < len(_TO) else None) for i, c in enumerate(_FROM)}
_FOLDED = re.compile("[" + re.escape("".join(c for c in _FROM if c <= "\uffff")) + "]|[\U00010000-\U0001ffff]")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
_CONTACT = re.compile(r"\S*(?:@|&#64;|%40)\S*|\S+\s+(?:@|at|\[at\]|\(at\))\s+\S+(?:\s+(?:dot|\[dot\]|\(dot\))\s+\S+)+|\S+\.(?:test|invalid|example|com|net|org)\b", re.I)
_TITLE = re.compile(r"[“„«»‘”\"‹’](?=\w)[^“„«»‘”\"‹›\n]{1,60}?[”“»«’\"›‘]")
_CONTACT_HINT = re.compile(r"@|%40|#64|\bat\b|\.(?:test|invalid|example)", re.I)
#: `at` alone, from its letters on, which are searched faster than a border; letters that re.I takes for those of _CONTACT_HINT.
_AT, _FOLDED_BY_RE = re.compile(r"at\b(?<=\bat)"), re.compile("[ſıİ]")
_QUOTE = re.compile("[“„«»‘”\"‹’]")
#: What follows a street address: number of the house, code and name of the place.
_PLACE = re.compile(r"(?:[,\s]+(?:n\.?\s?[º°]\.?|№|(?=\S*\d)[\w-]+|[A-ZÀ-ÖØ-ÞА-ЯЁ][\w'’-]*))*")
#: Stands for a contact detail that was taken out; words of a clause that belong to the detail in it, at most.
_MARK, WORDS_AROUND = "\ue000", 3
#: Signs of documents, such as A/12/345.
_SIGN = re.compile(r"(?<![\w/])[A-Z]+(?:/[A-Z\d.]+)*/\d[A-Z\d./]*")
_PART = re.compile(r"[.!?…;]\s+|,\s|\s[–—/|-]\s|[()\[\]]")


def _may_hold_contact(t: str) -> bool:
    if not t.isascii() and _FOLDED_BY_RE.search(t):
        return _CONTACT_HINT.search(t) is not None
    low = t.lower()
    return "@" in t or "%40" in t or "#64" in t or ".test" in low or ".invalid" in low or ".example" in low or "at" in low and _AT.search(low) is not None


def _bare_of_contacts(text: str) -> str:
    """text in usual letters, without short quoted titles and contact details."""
    return _without_contacts(text if text.isascii() or not _FOLDED.search(text) else text.translate(_FOLD))


def _without_contacts(t: str) -> str:
    if _may_hold_contact(t):
        t = _CONTACT.sub(" ", t)
    if '"' in t or not t.isascii() and _QUOTE.search(t):
        t = _TITLE.sub(lambda m: " " if len(_WORD.findall(m.group())) <= 3 else m.group(), t)
    return t


def parts_of(text: str) -> list[list[str]]:
    """The words, in lower case, of each sentence or clause; short quoted titles and contact details are left out."""
    return [w for p in _PART.split(_bare_of_contacts(text)) if (w := _WORD.findall(p.lower()))]


@dataclass
class Parts:
    """parts_of() many texts at once: the words one after another, how many each part has, and how many parts each text has."""

    words: list[str]
    sizes: np.ndarray
    counts: np.ndarray

    @property
    def starts(self) -> np.ndarray:
        """The first word of each part."""
        return np.cumsum(self.sizes) - self.sizes

    def of(self, texts: np.ndarray) -> Parts:
        """Those of the texts that are true in texts."""
        parts = np.repeat(texts, self.counts)
        return Parts(list(compress(self.words, np.repeat(parts, self.sizes).tolist())), self.sizes[parts], self.counts[texts])


#: Characters as _WORD and _PART tell them apart.
_KINDS = (r"[^\W\d_]", "['’]", r"\s", "[.!?…;,]", "[–—/|-]", r"[()\[\]]")
_LETTER, _APOSTROPHE, _BLANK, _STOP, _DASH, _BRACKET = range(1, 7)


def all_parts(texts: list[str]) -> Parts:
    """parts_of() all texts, told by arrays over their characters."""
    some = [_some_parts(texts[at : at + TEXTS_AT_ONCE]) for at in range(0, max(1, len(texts)), TEXTS_AT_ONCE)]
    return Parts(list(chain.from_iterable(p.words for p in some)), np.concatenate([p.sizes for p in some]), np.concatenate([p.counts for p in some]))


@lru_cache(maxsize=1)
def _folds() -> np.ndarray:
    """What _FOLD makes of each code point; of those that it takes out, the first that is none."""
    out = np.arange(0x110000, dtype=np.uint32)
    out[list(_FOLD)] = [0x110000 if c is None else ord(c) for c in _FOLD.values()]
    return out


def _folded(texts: list[str]) -> list[str]:
    """texts as _FOLD makes them."""
    codes, last = characters(texts)
    codes = _folds()[codes]
    codes[last], codes[0] = 10, 10
    kept = codes != 0x110000
    ends = np.cumsum(kept)[last] - 1
    text = codes[kept].tobytes().decode("utf-32-le", "surrogatepass")
    return [text[a + 1 : b] for a, b in zip([0, *ends.tolist()], ends.tolist())]


#: Characters that _bare_of_contacts looks for first, in text beyond ASCII.
_SPECIAL = (_QUOTE.pattern, _FOLDED_BY_RE.pattern, _FOLDED.pattern)


def _some_parts(texts: list[str]) -> Parts:
    texts = list(texts)
    beyond = [i for i, t in enumerate(texts) if not t.isascii()]
    codes, last = characters([texts[i] for i in beyond])
    found = kinds(codes, _SPECIAL)
    at = np.flatnonzero(found)
    special, kind = np.searchsorted(last, at), found[at]
    fold = np.unique(special[kind == 3]).tolist()
    for i, t in zip(fold, _folded([texts[beyond[i]] for i in fold])):
        texts[beyond[i]] = t
    # what has none of these, nor a contact's letters, stays as it is
    bare = set(beyond).difference(beyond[i] for i in set(special.tolist()))
    lower = []
    for i, t in enumerate(texts):
        low = t.lower()
        if i not in bare or "@" in t or "%40" in t or "#64" in t or "at" in low or ".test" in low or ".invalid" in low or ".example" in low:
            low = _without_contacts(t).lower()
        lower.append(low)
    codes, last = characters(lower)
    kind = kinds(codes, _KINDS)
    own = kind == _LETTER
    at = np.flatnonzero(kind == _APOSTROPHE)
    own[at[own[at - 1] & own[at + 1]]] = True
    words, first = runs(codes, own)
    # a part ends where _PART matches between two words
    ends = np.flatnonzero(kind >= _STOP)
    blank = kind == _BLANK
    ends = ends[(kind[ends] == _BRACKET) | blank[ends + 1] & ((kind[ends] == _STOP) | blank[ends - 1])]
    text = np.searchsorted(last, first)
    begin = np.flatnonzero(np.diff(np.searchsorted(ends, first) + text, prepend=-1))
    return Parts(words, np.diff(begin, append=len(words)), np.bincount(text[begin], minlength=len(texts)))


def features(word: str) -> list[int]:
    w = f"<{word}>"
    out = [zlib.crc32(w.encode())]
    for n in (2, 3, 4, 5):
        out += [zlib.crc32(w[i : i + n].encode()) for i in range(len(w) - n + 1)]
    return [x % BUCKETS for x in out]


@lru_cache(maxsize=1)
def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = out >> 1 ^ np.where(out & 1, np.uint32(0xEDB88320), np.uint32(0))
    return out


def all_features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """features() of all words one after another, and how many each word has."""
    if not words:
        return np.zeros(0, np.uint16), np.zeros(0, np.int64)
    ws = [f"<{w}>".encode() for w in words]
    data, size, table = np.frombuffer(b"".join(ws), np.uint8), np.fromiter(map(len, ws), np.int64, len(ws)), _crc_table()
    # the first byte of each character and its word; behind the last character of all comes the end
    char = np.flatnonzero(data & 0xC0 != 0x80)
    of = np.repeat(np.arange(len(ws)), size)[char]
    long = np.bincount(of, minlength=len(ws))
    start, edge = np.cumsum(long) - long, np.append(char, len(data))
    many = 1 + sum(np.maximum(long - n + 1, 0) for n in (2, 3, 4, 5))
    put, own = np.cumsum(many) - many, np.arange(len(char)) - start[of]
    out = np.empty(many.sum(), np.uint16)
    out[put] = np.fromiter(map(zlib.crc32, ws), np.uint32, len(ws)) % BUCKETS
    put = put + 1
    for n in (2, 3, 4, 5):
        at = np.flatnonzero(own + n <= long[of])
        a, b = edge[at], edge[at + n]
        crc = np.full(len(at), 0xFFFFFFFF, np.uint32)
        for k in range(int((b - a).max(initial=0))):
            some = slice(None) if k < n else np.flatnonzero(a + k < b)  # a character has a byte at least
            c = crc[some]
            crc[some] = table[(c ^ data[a[some] + k]) & 0xFF] ^ c >> np.uint32(8)
        out[put[of[at]] + own[at]] = (crc ^ np.uint32(0xFFFFFFFF)) % BUCKETS
        put = put + np.maximum(long - n + 1, 0)
    return out, many


@dataclass
class Model:
    """scores: of each bucket for each language (embedding times softmax weights); threshold, short: of the share of the best
    language, for parts as they come and for parts of fewer than WORDS_SURE words in another language than the rest; odds: the
    factors of a decision's log-odds and of the logarithm of its words, and the constant, whose sum is the confidence's logit."""

    scores: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    threshold: float = 0.5
    short: float = 0.9
    odds: tuple[float, float, float] = (1.0, 0.0, 0.0)


def _garble(text: str, rng: random.Random) -> str:
    """text as a wrong encoding would show it."""
    shown = rng.choice(["cp1252", "cp1252", "cp1252", *SHOWN_AS])
    table = str.maketrans({chr(b): c for b, c in enumerate(_byte_to_char(shown))})
    k = rng.random()
    if k < 0.6:
        return text.encode("utf-8").decode("latin-1").translate(table)
    if k < 0.75:
        return text.encode("utf-8").decode("latin-1").translate(table).encode("utf-8").decode("latin-1").translate(table)
    shown, really = rng.choice(MISREAD)
    return text.encode(really, "ignore").decode("latin-1").translate(str.maketrans({chr(b): c for b, c in enumerate(_byte_to_char(shown))}))


def held_out(samples: list[tuple[str, str]], seed: int = 7) -> tuple[list[tuple[str, str]], list[tuple[str, str]]]:
    """A tenth of (lang, sentence) to fit temperature, thresholds and confidence on, and the rest to learn."""
    samples = sorted({(a, t) for a, t in samples if a in LANGS and t})
    random.Random(seed).shuffle(samples)
    return samples[: len(samples) // 10], samples[len(samples) // 10 :]


def learn(fit: list[tuple[str, str]], seed: int = 7, epochs: int = 6, rate: float = 0.6) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The embeddings of buckets, the weights of the softmax and its constants, from (lang, sentence)."""
    rng, nrng = random.Random(seed), np.random.default_rng(seed)
    xs, ys = [], []
    for lang, text in fit:
        for t in (text, _garble(text, rng)):
            for ws in parts_of(t):
                cuts = [ws]
                for _ in range(2):
                    n = rng.randint(2, 7)
                    a = rng.randint(0, max(0, len(ws) - n))
                    cuts.append(ws[a : a + n])
                for c in cuts:
                    xs.append(np.fromiter((f for w in c for f in features(w)), np.int64))
                    ys.append(LANGS.index(lang))
    ys = np.array(ys)
    emb = nrng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out = np.zeros((DIM, len(LANGS)), np.float32)
    bias = np.zeros(len(LANGS), np.float32)
    order = np.arange(len(xs))
    batch = 32
    steps = epochs * (-(-len(xs) // batch))
    step = 0
    for _ in range(epochs):
        nrng.shuffle(order)
        for at in range(0, len(order), batch):
            ids = order[at : at + batch]
            lens = np.array([len(xs[i]) for i in ids])
            flat = np.concatenate([xs[i] for i in ids])
            starts = np.concatenate([[0], np.cumsum(lens)[:-1]])
            h = np.add.reduceat(emb[flat], starts) / lens[:, None]
            z = h @ out + bias
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(ids)), ys[ids]] -= 1
            lr = rate * (1 - step / steps)
            gh = (p @ out.T) / lens[:, None]
            out -= lr * 0.3 * (h.T @ p)
            bias -= lr * 0.1 * p.mean(0)
            np.add.at(emb, flat, -lr * 4 * np.repeat(gh, lens, axis=0).astype(np.float32))
            step += 1
    return emb, out, bias


def _sums(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The sums of rows from each of starts to the next; two columns at once as one complex number."""
    return np.add.reduceat(rows.view(np.complex64 if rows.dtype == np.float32 else np.complex128), starts).view(rows.dtype)


def learn_on(start: tuple[np.ndarray, np.ndarray, np.ndarray], langs: np.ndarray, parts: Parts, seed: int = 7) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Goes on from start over every word of texts once, all languages alike: the scores of each bucket, the constants, and how
    many words fall into each bucket. langs: index of the language of each text; parts: of all texts."""
    emb, out, bias = (x.copy() for x in start)
    distinct, said = numbered(parts.words)
    flat, many = all_features(distinct)
    first = np.cumsum(many) - many
    # the runs of each part
    cut = -(-parts.sizes // RUN)
    of = np.repeat(np.arange(len(cut)), cut)
    at = RUN * (np.arange(len(of)) - (np.cumsum(cut) - cut)[of])
    begins, sizes, ys = parts.starts[of] + at, np.minimum(RUN, parts.sizes[of] - at), np.repeat(langs, parts.counts)[of]
    share = np.bincount(ys, sizes, len(LANGS))
    weight = share.sum() / (np.count_nonzero(share) or 1) / np.maximum(share, 1)
    order = np.random.default_rng(seed).permutation(len(sizes))
    for at in range(0, len(order), RUNS_AT_ONCE):
        now = order[at : at + RUNS_AT_ONCE]
        n = sizes[now]
        begin = np.cumsum(n) - n
        words, place = np.unique(said[np.repeat(begins[now] - begin, n) + np.arange(n.sum())], return_inverse=True)
        own = many[words]
        starts = np.cumsum(own) - own
        buckets = flat[np.repeat(first[words] - starts, own) + np.arange(own.sum())]
        lens = np.add.reduceat(own[place], begin)[:, None]
        h = _sums(_sums(emb.take(buckets, 0), starts).take(place, 0), begin) / lens
        z = h @ out + bias
        p = np.exp(z - z.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(len(now)), ys[now]] -= 1
        p *= np.minimum(weight[ys[now]], MOST_WEIGHT)[:, None]
        lr = CORPUS_RATE * (1 - at / len(order))
        gh = np.repeat((p @ out.T) / lens, n, axis=0)
        by = np.argsort(place, kind="stable")
        often = np.bincount(place, minlength=len(words))
        g = _sums(gh.take(by, 0), np.cumsum(often) - often) * np.minimum(1, AT_MOST / often)[:, None]
        out -= (lr * 0.3 * min(1, AT_MOST / len(now)) * (h.T @ p)).astype(np.float32)
        bias -= (lr * 0.1 * p.mean(0)).astype(np.float32)
        # the steps of a bucket are added up first, which takes a tenth of the time of adding each by itself
        steps, buckets = -lr * 4 * g, buckets.astype(np.int64)
        for k in range(DIM):
            emb[:, k] += np.bincount(buckets, np.repeat(steps[:, k], own), BUCKETS)
    return emb @ out, bias, np.bincount(flat, np.repeat(np.bincount(said, minlength=len(distinct)), many), BUCKETS).astype(np.int64)


def train(samples: list[tuple[str, str]], seed: int = 7, epochs: int = 6, rate: float = 0.6) -> Model:
    """Fits the model on (lang, sentence). A tenth of samples is held out for temperature, thresholds and confidence."""
    held, fit = held_out(samples, seed)
    emb, out, bias = learn(fit, seed, epochs, rate)
    return calibrated(Model(emb @ out, bias), held, seed)


def calibrated(model: Model, held: list[tuple[str, str]], seed: int = 7) -> Model:
    """model with temperature, thresholds and confidence fitted on the sentences held out."""
    hx, hy = [], []
    for lang, text in held:
        for ws in parts_of(text):
            hx.append(np.fromiter((f for w in ws for f in features(w)), np.int64))
            hy.append(LANGS.index(lang))
    hy = np.array(hy)
    if len(hx):
        z = np.stack([model.scores[x].mean(0) + model.bias for x in hx])
        best = (np.inf, 1.0)
        for t in (0.25, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0):
            q = z * t - (z * t).max(1, keepdims=True)
            nll = -(q[np.arange(len(hy)), hy] - np.log(np.exp(q).sum(1))).mean()
            best = min(best, (nll, t))
        model.temperature = best[1]
        words = np.array([len(p) for _, t in held for p in parts_of(t)], np.float32)
        q = z * best[1]
        q = (q - q.max(1, keepdims=True)) * (np.minimum(words, WORDS_COUNTED)[:, None] * EVIDENCE_PER_WORD)
        q = np.exp(q)
        q /= q.sum(1, keepdims=True)
        top, right = q.max(1), q.argmax(1) == hy
        # the lowest threshold above which held-out parts are right nearly always
        model.threshold = next((thr for thr in (0.5, 0.6, 0.7, 0.8, 0.9) if right[top >= thr].mean() >= 0.995), 0.9)
        model.short = _short_threshold(model, held, random.Random(seed))
        model.odds = _fit_odds(model, held, random.Random(seed))
    return model


def cuts_of(held: list[tuple[str, str]], rng: random.Random) -> list[tuple[str, str]]:
    """(lang, text): of each sentence the whole and a run of words of each length in CUTS."""
    out = []
    for lang, text in held:
        ws = [w for p in parts_of(text) for w in p]
        out.append((lang, text))
        for n in CUTS:
            if n <= len(ws):
                at = rng.randint(0, len(ws) - n)
                out.append((lang, " ".join(ws[at : at + n])))
    return out


def _fit_odds(model: Model, held: list[tuple[str, str]], rng: random.Random) -> tuple[float, float, float]:
    """Logistic regression, by Newton's method, of whether a decision on a held-out cut is right."""
    cuts = cuts_of(held, rng)
    said = Identifier(model).decisions([t for _, t in cuts])
    rows = [(s, np.log(n), 1.0, LANGS[k] == a) for (a, _), (k, s, n) in zip(cuts, said) if n]
    if not rows:
        return model.odds
    x, y = np.array([r[:3] for r in rows]), np.array([r[3] for r in rows], float)
    w, ridge = np.array([0.5, 0.0, 0.0]), np.diag([0.1, 0.1, 0.01])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        w = w - np.linalg.solve(x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (p - y) + ridge @ w)
    return tuple(map(float, w))


def _short_threshold(model: Model, held: list[tuple[str, str]], rng: random.Random) -> float:
    """The lowest threshold above which held-out cuts of fewer than WORDS_SURE words are right nearly always."""
    cuts, ys = [], []
    for lang, text in held:
        for ws in parts_of(text):
            for n in range(2, min(WORDS_SURE - 1, len(ws)) + 1):
                at = rng.randint(0, len(ws) - n)
                cuts.append(ws[at : at + n])
                ys.append(LANGS.index(lang))
    if not cuts:
        return model.short
    e = Identifier(model).score(cuts) * (np.array([len(c) for c in cuts])[:, None] * EVIDENCE_PER_WORD)
    q = np.exp(e - e.max(1, keepdims=True))
    top, right = q.max(1) / q.sum(1), q.argmax(1) == np.array(ys)
    return next((thr for thr in (0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 0.98) if right[top >= thr].mean() >= 0.995), 0.98)


class Identifier:
    """Scores parts; keeps the words met so far. known, given, names: words, given names and a model that tell names of persons."""

    def __init__(self, model: Model, known: set[str] = frozenset(), given: set[str] = frozenset(), names: NameModel | None = None):
        self.m = model
        self.entities = Detector(set(known), set(given), names)
        self.ids: dict[str, int] = {}
        self.sums = np.zeros((1024, len(LANGS)), np.float32)
        self.counts = np.zeros(1024, np.float32)

    def _learn(self, words: list[str]) -> None:
        if len(self.ids) + len(words) > WORDS_KEPT:
            self.ids.clear()
        need = len(self.ids) + len(words)
        if need > len(self.counts):
            size = max(need, 2 * len(self.counts))
            self.sums = np.resize(self.sums, (size, len(LANGS)))
            self.counts = np.resize(self.counts, size)
        flat, many = all_features(words)
        at = slice(len(self.ids), need)
        self.sums[at] = np.add.reduceat(self.m.scores[flat], np.cumsum(many) - many)
        self.counts[at] = many
        self.ids.update(zip(words, range(len(self.ids), need)))

    def score(self, parts: list[list[str]]) -> np.ndarray:
        """Log-probabilities of each part (of at least one word)."""
        return self._scores([w for p in parts for w in p], np.fromiter(map(len, parts), np.int64, len(parts)))

    def _scores(self, flat: list[str], lens: np.ndarray) -> np.ndarray:
        """score() of parts that come as all their words and how many each has."""
        if not flat:
            return np.zeros((0, len(LANGS)), np.float32)
        new = set(flat).difference(self.ids)
        if new:
            self._learn(list(set(flat) if len(self.ids) + len(new) > WORDS_KEPT else new))
        idx = np.fromiter(map(self.ids.__getitem__, flat), np.int64, len(flat))
        starts = np.cumsum(lens) - lens
        z = np.add.reduceat(self.sums[idx], starts) / np.add.reduceat(self.counts[idx], starts)[:, None] + self.m.bias
        z = z * self.m.temperature
        z = z - z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def _confidence(self, log_odds: float, words: int) -> float:
        a, b, c = self.m.odds
        return float(1 / (1 + np.exp(-np.clip(a * log_odds + b * np.log(words) + c, -30, 30))))

    def _evidence(self, parts: list[list[str]]) -> np.ndarray:
        """What each part says for each language, in nats."""
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        return self.score(parts) * (np.minimum(sizes, WORDS_COUNTED)[:, None] * EVIDENCE_PER_WORD)

    def decisions(self, texts: list[str]) -> list[tuple[int, float, int]]:
        """(index of the language, log-odds, words) of the main language of each text, whatever its confidence; no words: (0, 0, 0)."""
        out = []
        for t in texts:
            parts = parts_of(t)
            if not parts:
                out.append((0, 0.0, 0))
                continue
            got = self._groups([len(p) for p in parts], self._evidence(parts))
            k = max(got, key=lambda k: got[k][1])
            out.append((k, _log_odds(got[k][0], k), int(got[k][1])))
        return out

    def languages(self, texts: list[str], parts: Parts | None = None) -> list[list[tuple[str, float, int]]]:
        """For each text its (language, confidence, words), in order of first occurrence; und where there is none to name. parts:
        those of all texts, if they are known."""
        out: list[list[tuple[str, float, int]]] = [[(UNDETERMINED, 1.0, 0)] for _ in texts]
        if not texts:
            return out
        parts = all_parts(texts) if parts is None else parts
        some = np.flatnonzero(parts.counts)
        if not len(some):
            return out
        sizes, counts = parts.sizes, parts.counts[some]
        lp = self._scores(parts.words, sizes)
        e = lp * (np.minimum(sizes, WORDS_COUNTED)[:, None] * EVIDENCE_PER_WORD)  # what each part says, in nats
        top = lp.argmax(1)
        starts = np.cumsum(counts) - counts
        # texts whose parts agree, or so nearly that a change of language costs more than it could give, all at once
        z = np.add.reduceat(e, starts)
        q = np.exp(z - z.max(1, keepdims=True))
        same = (np.minimum.reduceat(top, starts) == np.maximum.reduceat(top, starts)) | (np.add.reduceat(e.max(1), starts) - z.max(1) < SWITCH_COST - 0.01)
        first, at = z.argmax(1), np.arange(len(some))
        best, total = q[at, first], q.sum(1)
        sure = (best / total).tolist()
        q[at, first] = 0
        words = np.add.reduceat(sizes, starts)
        a, b, c = self.m.odds
        logit = a * (np.log(np.maximum(best, 1e-30)) - np.log(np.maximum(q.sum(1), 1e-30))) + b * np.log(words) + c
        confidence = (1 / (1 + np.exp(-np.clip(logit, -30, 30)))).tolist()
        several: dict[int, str] = {}
        for i, k, at, n, share, conf, one, w in zip(some.tolist(), first.tolist(), starts.tolist(), counts.tolist(), sure, confidence, same.tolist(), words.tolist()):
            if not one:
                got = self._groups(sizes[at : at + n].tolist(), e[at : at + n])
                if len(got) > 1:
                    several[i] = self._bare(texts[i])
                else:
                    out[i] = self._verdict(got)
            elif share >= self.m.threshold and w >= 2:
                out[i] = [(LANGS[k], conf, w)]
            else:
                out[i] = [(UNDETERMINED, 1 - conf, w)]
        # those in several languages again without what is in none, all at once
        if several:
            parts = all_parts(list(several.values()))
            e = self._scores(parts.words, parts.sizes) * (np.minimum(parts.sizes, WORDS_COUNTED)[:, None] * EVIDENCE_PER_WORD)
            ends = np.cumsum(parts.counts)
            for i, at, end in zip(several, (ends - parts.counts).tolist(), ends.tolist()):
                out[i] = self._verdict(self._groups(parts.sizes[at:end].tolist(), e[at:end])) if end > at else [(UNDETERMINED, 1.0, 0)]
        return out

    def _bare(self, text: str) -> str:
        """text without contact details, addresses, names and signs of documents, put right where it was read as another encoding than UTF-8."""
        for _ in range(2):
            text = next((t for e in SHOWN_AS if (t := undo_utf8(text, e)) != text), text)
        out, at = [], 0
        for start, end, kind, _ in self.entities.find(text):
            if start >= at:
                out += [text[at:start], " " if kind == "name" else _MARK]
                at = _PLACE.match(text, end).end() if kind == "address" else end
        clauses = _PART.split("".join([*out, text[at:]]))
        # the few words around a contact detail, such as `or … after six`, belong to it
        own = [c.replace(_MARK, " ") for c in clauses if _MARK not in c or len(_WORD.findall(c)) > WORDS_AROUND]
        return _SIGN.sub(" ", ". ".join(own))

    def _groups(self, sizes: list[int], e: np.ndarray) -> dict[int, tuple[np.ndarray, int, int]]:
        """What all parts of a language say, their words and those of the longest, for each language of a text."""
        # the likeliest sequence of languages, given what a change costs
        cost, back = -e[0], []
        for row in e[1:]:
            best = cost.argmin()
            stay = cost <= cost[best] + SWITCH_COST
            back.append(np.where(stay, np.arange(len(LANGS)), best))
            cost = np.where(stay, cost, cost[best] + SWITCH_COST) - row
        path = [int(cost.argmin())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        path.reverse()
        got: dict[int, tuple[np.ndarray, int, int]] = {}
        for k, s, row in zip(path, sizes, e):
            z, n, most = got.get(k, (0, 0, 0))
            got[k] = (z + row, n + s, max(most, s))
        return got

    def _verdict(self, got: dict[int, tuple[np.ndarray, int, int]]) -> list[tuple[str, float, int]]:
        main = max(got, key=lambda k: got[k][1])
        out = []
        for k, (z, n, most) in got.items():
            q = np.exp(z - z.max())
            c = float(q[k] / q.sum())
            sure = k == main or n >= WORDS_SURE  # else a word alone, here and there, makes no clause
            if (n if sure else most) >= 2 and c >= (self.m.threshold if sure else self.m.short):
                out.append((LANGS[k], self._confidence(_log_odds(z, k), n), int(n)))
        z, n, _ = got[main]
        return out or [(UNDETERMINED, 1 - self._confidence(_log_odds(z, main), n), int(n))]


def _log_odds(z: np.ndarray, k: int) -> float:
    """Of language k against all others, of what the parts say."""
    others = np.delete(z, k)
    most = others.max()
    return float(z[k] - most - np.log(np.exp(others - most).sum()))


def label_of(label: Column | str) -> Column:
    """The language a label names, whatever its case, blanks, region or three letters; null if none of the nine."""
    x = F.trim(F.element_at(F.split(F.lower(F.trim(F.col(label) if isinstance(label, str) else label)), "[-_]"), 1))
    code = F.coalesce(F.try_element_at(F.create_map(*[F.lit(y) for kv in THREE.items() for y in kv]), x), x)
    return F.when(code.isin(LANGS), code)


def stated(datasets: DataFrame, source: str = "source_segment", target: str = "target_segment") -> DataFrame:
    """ds, field, stated: the language that the catalog states for either side of each dataset, null where none."""
    side = lambda name, column: F.struct(F.lit(name).alias("field"), label_of(column).alias("stated"))
    return datasets.select("ds", F.explode(F.array(side(source, "src_lang"), side(target, "tgt_lang"))).alias("x")).select("ds", "x.field", "x.stated")


def fit(pairs: DataFrame, datasets: DataFrame, samples: DataFrame, part_pairs: int = PART_PAIRS) -> Model:
    """The model for a corpus: trained on the samples, then on with all corpus segments that the first model finds to be in the
    language that their dataset states, whole.

    Each part of about part_pairs pairs, by hash, starts from the first model and gives scores; those of a bucket are averaged
    by the words of each part in it. The sums are of integers: the same at every size of cluster.
    """
    held, base = held_out([(r[0], r[1]) for r in collect_small(samples.select("lang", "text"))])
    start = learn(base)
    first = calibrated(Model(start[0] @ start[1], start[2]), held)
    labels = broadcast_if_small(stated(datasets, "s", "t").filter("stated IS NOT NULL").select("ds", F.col("field").alias("side"), F.col("stated").alias("lang")))
    pairs = pairs.select("pair_id", "ds", "source_segment", "target_segment").filter("pair_id IS NOT NULL")
    parts = max(1, -(-pairs.count() // part_pairs))
    side = lambda k, name: F.struct(F.lit(k).alias("side"), F.col(name).alias("text"))
    rows = pairs.select("ds", F.pmod(F.xxhash64("pair_id", "source_segment", "target_segment"), F.lit(parts)).alias("part"), F.xxhash64("pair_id").alias("h"), F.explode(F.array(side("s", "source_segment"), side("t", "target_segment"))).alias("x"))
    rows = rows.select("ds", "part", "h", "x.side", "x.text").filter("text <> ''").join(labels, ["ds", "side"]).select("part", "h", "side", "lang", "text")
    shared = pairs.sparkSession.sparkContext.broadcast((start, first, {t for _, t in held}))

    def go_on(rows: pd.DataFrame) -> pd.DataFrame:
        start, first, unseen = shared.value
        rows = rows.sort_values(["h", "side", "text", "lang"], kind="stable")
        langs, texts = rows["lang"].tolist(), rows["text"].tolist()
        parts = all_parts(texts)
        said = Identifier(first).languages(texts, parts)
        own = np.array([len(ls) == 1 and ls[0][0] == a and t not in unseen for a, t, ls in zip(langs, texts, said)])
        scores, bias, n = learn_on(start, np.array([LANGS.index(a) for a in langs])[own], parts.of(own))
        at = np.flatnonzero(n)
        # the constants stand behind the buckets
        scores, at, n = np.vstack([scores[at], bias[None]]), np.append(at, BUCKETS), np.append(n[at], own.sum())
        return pd.DataFrame({"bucket": at, "n": n, **{a: np.rint(scores[:, i].astype(np.float64) * n * _UNIT).astype(np.int64) for i, a in enumerate(LANGS)}})

    got = rows.repartition(min(parts, MOST_TASKS), "part").groupBy("part").applyInPandas(go_on, "bucket INT, n LONG, " + ", ".join(f"{a} LONG" for a in LANGS))
    got = got.groupBy("bucket").agg(*[F.sum(x).alias(x) for x in ("n", *LANGS)]).filter("n > 0").toArrow()  # at most BUCKETS + 1 rows
    scores = np.vstack([first.scores, first.bias[None]])
    scores[got["bucket"].to_numpy()] = np.stack([got[a].to_numpy() for a in LANGS], 1) / (got["n"].to_numpy()[:, None] * _UNIT)
    return calibrated(Model(scores[:-1], scores[-1]), held)


def identify(pairs: DataFrame, model: Model, source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id", keep: tuple[str, ...] = ("ds",), lexicon: tuple = (frozenset(), frozenset())) -> DataFrame:
    """row_id, keep, field, lang, confidence, n_words: one row for each language of each segment.

    A segment whose language is rejected, or that has no words in a language, gives one row und, with the confidence that no
    language can be named. Null and empty segments and rows without an id give no row; a row that comes twice gives its rows
    twice. Texts are read whole; extra columns are ignored. lexicon: common words, given names and perhaps a model of names, by which
    names are told from short parts in another language. Narrow.
    """
    shared = pairs.sparkSession.sparkContext.broadcast((model, *lexicon))
    segs = spread(pairs.select(row_id, *keep, source, target)).select(F.col(row_id).alias("row_id"), *keep, F.explode(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("text")) for n in (source, target)])).alias("x"))
    segs = segs.select("row_id", *keep, "x.field", "x.text").filter("row_id IS NOT NULL AND text <> ''")
    kinds = dict(pairs.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        who = Identifier(*shared.value)
        for b in batches:
            got = who.languages(b["text"].tolist())
            idx = np.repeat(np.arange(len(b)), [len(g) for g in got])
            out = b[["row_id", *keep, "field"]].iloc[idx].reset_index(drop=True)
            flat = [x for g in got for x in g]
            out["lang"] = [x[0] for x in flat]
            out["confidence"] = [x[1] for x in flat]
            out["n_words"] = [x[2] for x in flat]
            yield out

    schema = f"row_id {kinds[row_id]}, " + "".join(f"`{k}` {kinds[k]}, " for k in keep) + "field STRING, lang STRING, confidence DOUBLE, n_words INT"
    return segs.mapInPandas(run, schema).withColumnRenamed("row_id", row_id)


def identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = lambda t: spark.read.parquet(f"{sf_dir}/{t}.parquet")
    pairs = read("bifixer")
    lexicon = personal_lexicon(spark, sf_dir)
    return identify(pairs, fit(pairs, read("datasets"), read("lang_samples")), lexicon=(*lexicon, fit_names(pairs, *lexicon)))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The languages of each segment that its dataset doesn't state for that side."""
    labels = broadcast_if_small(stated(spark.read.parquet(f"{sf_dir}/datasets.parquet")).dropDuplicates(["ds", "field"]))
    got = identified(spark, sf_dir).filter(F.col("lang") != UNDETERMINED).join(labels, ["ds", "field"], "left")
    return got.filter("stated IS NULL OR stated <> lang").select("pair_id", "field", "lang").distinct()
