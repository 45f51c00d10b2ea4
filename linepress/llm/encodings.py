"""Text that was decoded with a wrong character encoding (problem 3).

A candidate is a chain of steps "these characters came from bytes shown as X that were really Y". Every candidate text is
compressed with a zstandard dictionary of each language; its description length is the smallest compressed size plus the
chain's cost, and the chain of the least description length wins. The text as stored is the candidate with the empty
chain, so text that no chain shortens is left unchanged. Steps that undo a misread UTF-8 work on the byte sequences that
form valid UTF-8, so a segment of which only parts are garbled is restored in those parts.

Text in languages without a dictionary is restored by the validity of UTF-8 alone, or left unchanged: a misreading is undone
whatever its length where all of the text's characters beyond ASCII are valid UTF-8 and give words of one script. A
single-byte misreading, which always "fits", is undone only in text of which a good part are words of the dictionaries.
"""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linepress.session import spread

#: Encodings in which bytes are commonly shown by mistake.
SHOWN_AS = ["cp1252", "cp1250", "cp1251", "koi8_r", "cp437", "cp850", "mac_roman"]
#: Single-byte misreadings that happen, as (shown as, really).
MISREAD = [
    ("cp1250", "cp1252"), ("cp1251", "cp1252"), ("koi8_r", "cp1252"), ("cp437", "cp1252"), ("cp850", "cp1252"), ("mac_roman", "cp1252"),
    ("cp1252", "cp1251"), ("koi8_r", "cp1251"), ("cp437", "cp1251"), ("cp850", "cp1251"), ("mac_roman", "cp1251"),
    ("cp1251", "koi8_r"), ("cp1252", "koi8_r"), ("cp1252", "cp850"), ("cp1252", "cp437"), ("cp1252", "mac_roman"),
]
#: Description length, in bytes, of a step; a UTF-8 reading rarely fits by accident, a single-byte one always does.
UTF8_COST, SINGLE_COST = 1, 5
#: Bytes that speak for a UTF-8 reading for each character it saves, as long as there are MOST_EVIDENCE: valid sequences that give usual characters are no accident.
EVIDENCE_PER_CHAR, MOST_EVIDENCE = 2, 6
#: Bytes by which a single-byte chain must be shorter for each character it changes.
GAIN_PER_CHAR = 0.25
#: Description length, in bytes, of each different character that no text of the nine languages uses.
UNUSUAL_COST = 6
#: Bytes of sample text in one dictionary, about: zstandard leaves out what lies beyond its window, so a language with more has several.
DICTIONARY_BYTES = 1 << 19

#: Share of the words (of three letters or more) of a single-byte reading that the dictionaries must know.
KNOWN_SHARE = 0.1

#: Words whose verdicts a worker remembers; beyond it the memory is emptied (results don't depend on it).
WORDS_KEPT = 300_000
#: Characters beyond ASCII that text of the nine languages uses.
USUAL = set("äöüÄÖÜßéèêëàâîïôûùçœæÉÈÊËÀÂÎÏÔÛÙÇŒÆáíóúñÁÍÓÚÑüÜ¿¡ãõÃÕòìåÅøØĳĲ«»“”„‘’‚–—…•€£§°±²³×·→©®™ºª№½¼¾    　") | {chr(c) for c in range(0x410, 0x450)} | set("Ёё")


def _byte_to_char(enc: str) -> list[str]:
    """The character each byte is shown as; bytes without one are shown as the control character of the same number."""
    out = []
    for b in range(256):
        try:
            out.append(bytes([b]).decode(enc))
        except UnicodeDecodeError:
            out.append(chr(b))
    return out


@lru_cache(maxsize=1)
def _tables():
    to_byte, patterns = {}, {}
    for enc in SHOWN_AS:
        chars = _byte_to_char(enc)
        t = {c: b for b, c in enumerate(chars)}
        if enc == "cp1252":  # Latin-1 shows the bytes 80 to 9F as control characters
            t |= {chr(b): b for b in range(0x80, 0xA0)}
        to_byte[enc] = t
        by = defaultdict(list)
        for c, b in t.items():
            by[b].append(c)

        def some(lo: int, hi: int, by=by) -> str:
            return "[" + "".join(re.escape(c) for b in range(lo, hi + 1) for c in by[b]) + "]"

        cont = some(0x80, 0xBF)
        patterns[enc] = re.compile(f"(?:{some(0xC2, 0xDF)}{cont}|{some(0xE0, 0xEF)}{cont}{{2}}|{some(0xF0, 0xF4)}{cont}{{3}})+")
    swaps = {}
    for shown, really in MISREAD:
        chars = _byte_to_char(really)
        swaps[shown, really] = {ord(c): chars[b] for c, b in to_byte[shown].items() if b >= 0x80 and chars[b] != c and not "ﬀ" <= c <= "ﬆ" and unicodedata.category(c) not in ("Cf", "Zs")}
    return to_byte, patterns, swaps


@lru_cache(maxsize=1)
def _shown() -> frozenset[str]:
    return frozenset(chr(c) for t in _tables()[2].values() for c in t)


def undo_utf8(text: str, enc: str, deeper: bool = True) -> str:
    """text with every run of characters that are, shown in enc, the bytes of valid UTF-8 put right.

    A run counts only if it gives characters that texts use, at once or after another such step, and, for an encoding
    whose bytes are Cyrillic letters, if it isn't part of a longer Cyrillic word and doesn't give a word of two scripts.
    """
    to_byte, patterns, _ = _tables()
    table = to_byte[enc]
    cyrillic = enc in ("cp1251", "koi8_r")

    def put(m: re.Match) -> str:
        if cyrillic and (_CYRILLIC.match(text, m.end()) or m.start() and _CYRILLIC.match(text, m.start() - 1)):
            return m.group()
        try:
            new = bytes(table[c] for c in m.group()).decode("utf-8")
        except UnicodeDecodeError:
            return m.group()
        if cyrillic and _CLASH.search(text[max(0, m.start() - 1) : m.start()] + new + text[m.end() : m.end() + 1]):
            return m.group()
        if _usual(new) or deeper and any(n != new and _usual(n) for n in (undo_utf8(new, e, False) for e in SHOWN_AS)):
            return new
        return m.group()

    return patterns[enc].sub(put, text)


def _as_utf8(text: str, enc: str) -> str | None:
    """text read as UTF-8 shown in enc, if all its characters beyond ASCII are such; else null."""
    to_byte, patterns, _ = _tables()
    table, runs = to_byte[enc], _RUN.findall(text)
    if not runs or not all(patterns[enc].fullmatch(r) for r in runs):
        return None
    try:
        return _RUN.sub(lambda m: bytes(table[c] for c in m.group()).decode("utf-8"), text)
    except UnicodeDecodeError:
        return None


def _clean(text: str) -> bool:
    """At least two characters beyond ASCII, all of them letters or signs that texts have, and no word of two scripts."""
    got = [c for c in text if c >= "\x80"]
    if len(got) < 2 or any(unicodedata.category(c) in ("Cn", "Co", "Cc", "Cs", "Mn", "No") for c in got):
        return False
    return all(len({unicodedata.name(c, "?").split()[0] for c in w if c.isalpha()}) < 2 for w in _WORD.findall(text))


def whole_utf8(text: str) -> tuple[str, str] | None:
    """(text put right, chain) where all of text beyond ASCII is UTF-8 misread once or twice, whatever its language: valid
    sequences all over a text are no accident. Null where it isn't, or where a reading has usual characters only, so that the
    dictionaries can decide; the text itself where two encodings give different clean readings."""
    once = {e: t for e in SHOWN_AS if (t := _as_utf8(text, e))}
    twice = {f"{e}>utf8 {f}>utf8": x for e, t in once.items() for f in SHOWN_AS if (x := _as_utf8(t, f))}
    readings = twice or {f"{e}>utf8": t for e, t in once.items()}
    if any(map(_usual, readings.values())):
        return None
    good = {chain: t for chain, t in readings.items() if _clean(t)}
    if not good:
        return None
    chain = next(iter(good))
    return (good[chain], chain) if len(set(good.values())) == 1 else (text, "")


def _usual(text: str) -> bool:
    return all(c < "\x80" or c in USUAL for c in text)


#: Letters shown in the wrong single-byte encoding: a small letter before an accented capital, three accented letters on end, an unusual sign inside a word.
_SIGNS = "©®±²³´¹º¼½¾·¸¨¬¦°×÷£§ª™№•€¯ˆ˙˚˜˘ˇ˝ƒ"
_ODD = re.compile(
    r"[a-zß-öø-ÿ][À-ÖØ-Þ]|[À-ÖØ-öø-ÿ]{3}|[Â-ÎÐ-ÛÝÞ][a-z]|[а-яё][А-ЯЁ]{2}|[ЂЃѓЉЊЌЋЏђљњќћџЎўҐґЄєЇї]|[¤´¨¸¯¦¬þðÞÐÝýÿŸ÷]|[Ă-ŉŌ-őŔ-ťƒˆ-˝]|[\u2200-\u22ff\u2300-\u23ff\u2500-\u25ff]|[\x80-\x9f]"
    rf"|[^\W\d_][{_SIGNS}]|[{_SIGNS}][^\W\d_]|[a-z\u2039\u203a][‚‡†‰‹›]|[‚‡†‰‹›][a-z]|[a-z]‘[a-z]|‡ "
)
#: Signs that stand next to no letter in a word as it should be.
_MISFIT = re.compile(rf"[^\W\d_][{_SIGNS}¡¿]|[{_SIGNS}][^\W\d_]|[A-Za-zÀ-ÿ][А-яЁё]|[А-яЁё][A-Za-zÀ-ÿ]")
_WORD = re.compile(r"[^\W\d_]+")
_RUN = re.compile(r"[^\x00-\x7f]+")
_CYRILLIC = re.compile(r"[А-яЁё]")
_CLASH = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿａ-ｚＡ-Ｚ][А-яЁё]|[А-яЁё][A-Za-zÀ-ÖØ-öø-ÿａ-ｚＡ-Ｚ]|[²³¹¼½¾±§©®][^\W\d_]")
_CYRILLIC_WORD = re.compile(r"[А-яЁё]{2,}")


def _pieces(sentences: list[str]) -> Iterator[bytes]:
    """All sentences, in texts of about DICTIONARY_BYTES."""
    got, n = [], 0
    for s in sentences:
        raw = s.encode("utf-8", "surrogatepass")
        if got and n + len(raw) > DICTIONARY_BYTES:
            yield b"\n".join(got)
            got, n = [], 0
        got.append(raw)
        n += len(raw) + 1
    if got:
        yield b"\n".join(got)


class Restorer:
    """Holds the dictionaries of one worker."""

    def __init__(self, sentences: dict[str, list[str]]):
        import zstandard

        self.packers = []
        for text in (t for lang in sorted(sentences) for t in _pieces(sentences[lang])):
            d = zstandard.ZstdCompressionDict(text, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(level=3)
            self.packers.append(zstandard.ZstdCompressor(level=3, dict_data=d, write_content_size=False, write_checksum=False, write_dict_id=False))
        self.words = {w.lower() for ss in sentences.values() for s in ss for w in _WORD.findall(s)}
        self.odd: dict[str, bool] = {}
        self.runs: dict[str, bool] = {}

    def size(self, text: str) -> int:
        raw = text.encode("utf-8", "surrogatepass")
        # a character counts alike whether UTF-8 writes it in two bytes or three
        return min(len(p.compress(raw)) for p in self.packers) - sum(c > "\u07ff" for c in text)

    def _fits(self, old: str, new: str) -> bool:
        return new != old and _usual(new) and not _MISFIT.search(new) and any(a != b and (b.isalpha() or b == "€") for a, b in zip(old, new))

    def _single_byte(self, text: str) -> list[tuple[str, str]]:
        """(text, chain) of the single-byte readings that make every changed word look usual: of the odd words, and of all."""
        words = re.split(r"(\s+)", text)
        plain = [w.isascii() for w in words]
        unknown = not any(self._known(w) for w, p in zip(words, plain) if not p)
        out = []
        sense = lambda t: (ws := [w for w in _WORD.findall(t.lower()) if len(w) > 2]) and sum(w in self.words for w in ws) >= KNOWN_SHARE * len(ws)
        for (shown, really), table in _tables()[2].items():
            better = {}
            for w, p in zip(words, plain):
                if not p and w not in better and (self._odd(w) or unknown):
                    new = w.translate(table)
                    if self._fits(w, new) and not _ODD.search(new) and (self._odd(w) or self._known(new)):
                        better[w] = new
            if better:
                whole = [w if p or not self._fits(w, n := w.translate(table)) else n for w, p in zip(words, plain)]
                out += [(new, f"{shown}>{really}") for new in ("".join(better.get(w, w) for w in words), "".join(whole)) if sense(new)]
        return out

    def _known(self, word: str) -> bool:
        return any(w in self.words for w in _WORD.findall(word.lower()))

    def _odd(self, word: str) -> bool:
        """Signs of a wrong encoding in a word whose letters don't spell known words."""
        if (o := self.odd.get(word)) is None:
            if len(self.odd) > WORDS_KEPT:
                self.odd.clear()
            o = bool(_ODD.search(word)) or not _usual(word) and any(not _usual(c) and c in _shown() for c in word)
            if o and (ws := _WORD.findall(word.lower())):
                o = not (all(w in self.words for w in ws) and not re.search(rf"[{_SIGNS}\x80-\x9f]", word))
            self.odd[word] = o
        return o

    def _utf8(self, run: str) -> bool:
        if (u := self.runs.get(run)) is None:
            if len(self.runs) > WORDS_KEPT:
                self.runs.clear()
            u = self.runs[run] = any(undo_utf8(run, e) != run or _tables()[1][e].fullmatch(run) for e in SHOWN_AS)
        return u

    def suspicious(self, text: str) -> bool:
        if any(map(self._utf8, _RUN.findall(text))):
            return True
        words = [w for w in text.split() if not w.isascii()]
        if any(map(self._odd, words)):
            return True
        ru = [w for w in words if _CYRILLIC_WORD.search(w)]
        return len(ru) > 2 and not any(map(self._known, ru))

    def restore(self, text: str) -> tuple[str, str]:
        """(restored text, chain); chain '' if the text is best left as it is, 'lost' if only replacement marks tell."""
        lost = "�" in text
        if not self.suspicious(text):
            return text, "lost" if lost else ""
        if whole := whole_utf8(text):
            return whole
        layers = {text: ("", 0.0)}
        front = [text]
        for _ in range(2):
            nxt = []
            for t in front:
                chain, cost = layers[t]
                for enc in SHOWN_AS:
                    new = undo_utf8(t, enc)
                    if new != t and new not in layers:
                        layers[new] = (f"{chain} {enc}>utf8".strip(), cost + UTF8_COST - min(MOST_EVIDENCE, EVIDENCE_PER_CHAR * (len(t) - len(new))))
                        nxt.append(new)
            front = nxt
        candidates = dict(layers)
        for t in [text] if len(layers) == 1 or not _usual(text) else []:
            for new, step in self._single_byte(t):
                n = sum(a != b for a, b in zip(t, new))
                candidates.setdefault(new, (step, SINGLE_COST + GAIN_PER_CHAR * n))
        if len(candidates) == 1:
            return text, "lost" if lost else ""
        best = min(candidates, key=lambda c: (self.size(c) + candidates[c][1] + UNUSUAL_COST * sum(ch not in USUAL for ch in set(c) if ch >= "\x80"), c))
        return best, candidates[best][0] or ("lost" if lost else "")


def restored_segments(pairs: DataFrame, samples: DataFrame, source: str = "source_segment", target: str = "target_segment", row_id: str = "pair_id") -> DataFrame:
    """row_id, field, restored, chain of every segment that holds wrongly decoded text.

    chain names the steps undone; 'lost' where replacement characters show that bytes are gone for good and nothing else
    can be put right. Null and empty segments, segments in ASCII and rows without an id are no cases; a row that comes twice is found twice. samples (lang, text) gives the
    dictionaries: all its sentences, in order of text; the table is fixed and doesn't grow with the corpus.
    Extra columns are ignored. Narrow but for reading the samples.
    """
    rows = samples.filter("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text").collect()
    sentences: dict[str, list[str]] = defaultdict(list)
    for lang, text in sorted(map(tuple, rows)):
        sentences[lang].append(text)
    shared = pairs.sparkSession.sparkContext.broadcast(dict(sentences))
    names = [source, target]
    segs = spread(pairs.select(row_id, *names)).select(
        F.col(row_id).alias("row_id"),
        F.explode(F.filter(F.array(*[F.struct(F.lit(n).alias("field"), F.col(n).alias("text")) for n in names]), lambda x: F.octet_length(x.text) > F.char_length(x.text))).alias("x"),
    ).select("row_id", "x.field", "x.text").filter("row_id IS NOT NULL")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        r = Restorer(shared.value)
        for b in batches:
            got = [r.restore(t) for t in b["text"]]
            keep = [k for k, (_, c) in enumerate(got) if c]
            if keep:  # strings of an empty selection have no chunk, which Spark can't send back
                out = b[["row_id", "field"]].iloc[keep].reset_index(drop=True)
                out["restored"] = [got[k][0] for k in keep]
                out["chain"] = [got[k][1] for k in keep]
                yield out

    kind = dict(pairs.dtypes)[row_id]
    return segs.mapInPandas(run, f"row_id {kind}, field STRING, restored STRING, chain STRING").withColumnRenamed("row_id", row_id)


def restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored_segments(spark.read.parquet(f"{sf_dir}/bifixer.parquet"), spark.read.parquet(f"{sf_dir}/lang_samples.parquet"))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored(spark, sf_dir).select("pair_id", "field").distinct()
