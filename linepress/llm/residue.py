"""Template residue, filler, error pages and script notices in place of content (problem 8).

Documents are cut into units (sentences of lines; lines `key = text` of interface strings are left out). A unit gets a
trusted label where its wording leaves no doubt, at its start, so that sentences about errors or scripts aren't taken for
them; a weak one (`Something went wrong.`, a bare code) counts only beside another sign in its document. Trusted labels are
then propagated through the connected components of near-duplicates (similarity of word five-shingles MIN_SIMILARITY):

* Every unit has a 64-bit SimHash of its shingles, cut into six blocks; each of twenty tables is keyed by three of them, so
  that two units within MAX_HAMMING differing bits meet in one table at least. Hits are verified by Hamming distance and by
  the shingles themselves.
* At similarity 0.8 most links of sentences lie beyond any radius that tables can cover (README), so each unit also has an
  exact way: a prefix of its shingle hashes in order, so long that two similar units share one of them. These hits are
  verified by the shingles too. No link is lost.

Labelled units are the frontier; what it reaches is labelled and becomes the next one, until nothing new is found. Only
components with a trusted label matter, so unlabelled units need not be compared with each other. A unit with an open
placeholder is labelled for itself only: its near-duplicates are the same sentences with the value filled in. A document
holds residue if it has an open placeholder, or if its labelled units stand in place of the content: beside no more than
MAX_OWN sentences of its own, or at least as many labelled as others.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from linepress.session import discard, materialise, spread

#: Mark of units without common words: filler if their words are those of filler elsewhere in the corpus.
BARE = "bare"
LABELS = ("error", "filler", "placeholder", "script")
#: Similarity of word five-shingles from which two units are near-duplicates.
SHINGLE, MIN_SIMILARITY = 5, 0.8
#: Sentences of its own (of three words or more) that a document may have around its residue: a heading, a line or a sentence.
MAX_OWN = 3
#: Bits in which two SimHashes may differ; each table leaves out as many of the six blocks, so none within it is missed.
MAX_HAMMING = 3
BLOCKS = (11, 11, 11, 11, 10, 10)
TABLES = list(combinations(range(len(BLOCKS)), len(BLOCKS) - MAX_HAMMING))
#: Bits of the Bloom filter of probed keys that workers get: 24 to 48 for each key, within these bounds (128 kB and 32 MB), and the
#: number of bits a key sets. It only spares shuffling: a key that isn't probed passes at 0.2 %, at the bound and 8 bits a key at 3 %.
FILTER_BITS, FILTER_HASHES = (1 << 20, 1 << 28), 3
#: Odd factors of the words of a shingle in its hash, by place, and of the final mixing.
_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)

_WORD = re.compile(r"[^\W\d_]+")
_KEY_VALUE = re.compile(r"^\s*[\w.\-]+\s?=\s")
_SENTENCE = re.compile(r"(?<=[.!?…])\s+")
_TAG = re.compile(r"</?\s*(?:noscript|title|h\d|p|div|br|body|html|head|span|doc|seg|b|i|a|script)\b[^>]*>", re.I)

# -- fixed values: forms of placeholders -------------------------------------------------------------------------------
_SLOT = re.compile(
    r"\{\{[^{}\n]{0,60}\}\}|\{%[^%\n]{0,60}%\}|<%[^%\n]{0,60}%>|[$#]\{[^{}\n]{1,40}\}|(?<![{$#\w])\{(?:\d{1,2}|[a-z_]+)\}(?!\})|%[A-Z][A-Z_]{2,}%|@@\w+@@|(?<!\w)__[A-Z][A-Z_]*?__(?!\w)"
    r"|\[(?:[A-ZÀ-ÖØ-ÞА-ЯЁ]{3,}[A-ZÀ-ÖØ-ÞА-ЯЁ _]*|(?:insert|enter|your|name|einsetzen|einfügen|insérer|nom|insertar|nombre|inserir|nome|indsæt|navn|infoga|namn|invoegen|naam|вставить|имя|место)\b[^\]\n]{0,30}|[^\]\n]{0,30}\b(?:einsetzen|einfügen|here|hier|ici|aquí|aqui|her|här|здесь))\]"
    r"|\[\[[^\[\]\n]{1,40}\]\]|\$[A-Za-z_]\w*\$|%(?:\d\$)?[sd](?!\w)|%\(\w+\)[sd]|«[A-Z_]{2,}»\w*|\*\|\w+\|\*|(?<![#\w])#{1,2}[A-Za-z_]+#{1,2}(?!\w)|~[A-Z_]{3,}~|\|[A-Z_]{3,}\||<<[^<>\n]{1,40}>>|<(?:[A-Z]{2,}[A-Z _]*)>|(?<!\w)X{4,}(?!\w)|_{5,}|(?<!\w)(?:TODO|TBD|FIXME)(?!\w)|(?<![\w?!.…])\?{3,}"
)
_SLOT_HINT = re.compile(r"[{\[<%$«#|~_]|@@|XXXX|T(?:ODO|BD)|FIXME|\?\?\?")
#: Words of sentences that write about placeholders instead of holding one.
_ABOUT_SLOTS = re.compile(r"\b(?:value|placeholder|variable|wert|platzhalter|valeur|valor|variável|variabel|variabele|värde|værdi|waarde|pladsholder|platshållare|значени\w+|заполнитель|filled in|eingesetzt|inserted)\b", re.I)
# -- fixed values: wording of filler, by language; at the start of a unit, before other filler or nothing ------------------
_FILLER = re.compile(
    r"^\W*(?:(?:your |the |some )?(?:text|content|copy|title) (?:goes )?here|(?:placeholder|sample|dummy) text|platzhaltertext|blindtext|mustertext|beispieltext|(?:hier )?(?:steht )?ihr text(?: hier)?|votre texte ici|texte (?:d'exemple|factice|ici)|su texto aquí|texto (?:de ejemplo|de prueba|aquí)|o seu texto aqui|texto (?:de exemplo|aqui)|exempeltext|platshållartext|din text här|eksempeltekst|pladsholdertekst|din tekst her|voorbeeldtekst|uw tekst hier|jouw tekst hier|plaatshouder|образец текста|ваш текст(?: здесь)?|пример текста|текст[- ]заполнитель)(?!\w)",
    re.I,
)
_LOREM = frozenset("lorem ipsum dolor amet consectetur adipiscing elit eiusmod tempor incididunt labore dolore magna aliqua".split())
#: Words that are filler where a unit repeats nothing but them.
_DUMMY = frozenset("test text tekst texto texte tbd bla asdf qwerty foo blindtext dummy lorem xxxxx xxxx тест текст".split())
#: What may stand before a message: the name of the program, a code.
_LEAD = re.compile(r"^\W*(?:(?:nginx|https?(?:/[\d.]+)?|(?:\w*error)|e|fehler|erreur|fout|fejl|fel|erro|ошибка|code|status|oops|sorry)\b\W*)?(?:(?:[45]\d\d|0x[0-9a-f]+|\d{3,5})\b\W*)*", re.I)
# -- fixed values: error messages, by language; at the start of a unit ------------------------------------------------------
_END = r"(?=\W*(?:\W(?:http|error|e)?\W*(?:0x)?\d+\W*)?$)"
_ERROR = re.compile(
    r"(?:fatal error:|traceback \(most recent call last|(?:uncaught|unhandled) exception|internal server error|bad gateway|gateway time-?out|service (?:temporarily )?unavailable"
    rf"|(?:the )?page (?:was |could )?not (?:be )?found{_END}|(?:the |this |our )?(?:\w+ ){{0,2}}server (?:took too long to respond|did not respond in time|is not responding{_END})|you (?:do not|don't) have permission to (?:view|see|open|access|read)|access (?:is )?denied{_END}|(?:(?:we|this site|the site|this page|the server) (?:are|is) |we're )?(?:currently |temporarily )?(?:down|closed|offline) for (?:scheduled )?maintenance"
    rf"|(?:die |diese )?seite (?:wurde )?(?:leider )?nicht gefunden{_END}|(?:der |unser )?\w*server (?:hat (?:zu lange nicht|nicht rechtzeitig) geantwortet|antwortet nicht{_END})|sie (?:dürfen dies\w+ \w+ nicht (?:ansehen|öffnen|lesen)|haben keine berechtigung)|zugriff verweigert{_END}|wegen wartung(?:sarbeiten)? (?:sind wir|geschlossen{_END}|ist (?:diese|die) (?:seite|website))"
    rf"|(?:la |cette )?page (?:demandée )?(?:est )?(?:introuvable|non trouvée){_END}|le serveur(?: \S+)? (?:met trop de temps à répondre|ne répond pas{_END})|vous n['’]avez pas (?:le droit|l['’]autorisation|la permission) (?:de |d['’])(?:consulter|accéder|voir|lire)|accès refusé{_END}|(?:site |page )?en maintenance(?=\W*$|\s*[,;–—])"
    rf"|(?:la )?página no (?:encontrada|se ha encontrado){_END}|el servidor(?: del? \w+)? (?:tarda demasiado en responder|no responde{_END})|no tiene permisos? para (?:ver|acceder|leer|abrir)|acceso denegado{_END}|(?:estamos )?en mantenimiento(?=\W*$|\s*[,;–—])"
    rf"|(?:a )?página não (?:foi )?encontrada{_END}|o servidor(?: d[eo] \w+)? (?:demorou demasiado a responder|não responde{_END})|não tem permissão para (?:ver|aceder|acessar|ler|abrir)|acesso negado{_END}|(?:estamos )?em manutenção(?=\W*$|\s*[,;–—])"
    rf"|siden (?:blev ikke fundet|findes ikke|kunne ikke (?:findes|vises)){_END}|\w*serveren (?:svarede ikke i tide|svarer ikke{_END})|du har ikke (?:adgang|tilladelse) til (?:at se |at læse )?(?:denne|dette|siden|teksten)|adgang nægtet{_END}|(?:midlertidigt )?lukket (?:for|på grund af|pga\.?) vedligehold\w*"
    rf"|sidan (?:hittades inte|finns inte|kunde inte (?:hittas|visas)){_END}|\w*servern (?:svarade inte i tid|svarar inte{_END})|du har inte (?:behörighet|åtkomst)|åtkomst nekad{_END}|(?:tillfälligt )?stängt (?:för|på grund av|pga\.?) underhåll"
    rf"|(?:de |deze )?pagina (?:is |werd )?niet gevonden{_END}|(?:de )?\w*server (?:reageerde niet op tijd|reageert niet{_END})|u (?:hebt|heeft) geen (?:toegang tot|toestemming om)|toegang geweigerd{_END}|wegens onderhoud (?:gesloten|zijn we|is (?:deze|de) (?:site|pagina|website))"
    rf"|страница не найдена{_END}|сервер(?: \w+)? (?:слишком )?долго не отвечает|сервер(?: \w+)? не отвечает{_END}|у вас нет (?:доступа к|прав на)|доступ (?:запрещён|запрещен|закрыт){_END}|ведутся (?:технические |профилактические )?работы(?=\W*$|\s*[,;–—]))",
    re.I,
)
#: Messages that people say as well; they count beside another sign of an error only.
_ERROR_WEAK = re.compile(
    rf"(?:something went wrong|an error (?:has )?occurred|(?:please )?try again (?:later|in a few \w+)|(?:da |hier |leider )?ist (?:leider )?etwas schief\s?gelaufen|es ist ein fehler aufgetreten|(?:bitte )?(?:versuchen sie es )?(?:bitte )?später (?:erneut|noch einmal)(?: versuchen)?|(?:un problème|une erreur) est survenue?|(?:veuillez|merci de) réessayer (?:plus tard|ultérieurement)|algo ha (?:fallado|salido mal)|(?:se ha producido|ha ocurrido) un error|(?:vuelva a intentarlo|inténtelo de nuevo) más tarde|ocorreu um (?:problema|erro)|(?:por favor,? )?tente (?:novamente|de novo)(?: mais tarde)?|der (?:skete|opstod) en fejl|noget gik galt|(?:prøv|forsøg) igen senere|något gick fel|ett fel (?:uppstod|inträffade)|försök igen senare|er (?:ging iets mis|is iets misgegaan|is een fout opgetreden)|probeer het later (?:opnieuw|nog eens)|что-то пошло не так|произошла ошибка|(?:повторите попытку|попробуйте(?: ещё раз| снова)?) позже){_END}",
    re.I,
)
_CODE_LINE = re.compile(r"^\W*(?:(?:http(?:/\d(?:\.\d)?)?|error|e|fehler|erreur|fout|fejl|fel|erro|ошибка|code|status)[\s\-:#]*)?(?:[45]\d\d|0x[0-9a-f]{2,}|\d+x\d+)\W*$|^(?:e-\d{3,5}|nginx(?:/[\d.]+)?)$", re.I)
# -- fixed values: script notices, by language; at the start of a unit ------------------------------------------------------
_SCRIPT = re.compile(
    r"(?:please )?(?:enable|allow|activate|turn on) (?:javascript|scripts|active content)|(?:you need to|you must) (?:enable|allow|turn on) javascript|(?:this|the) (?:page|site|app|application|website) (?:(?:does not|doesn't|will not|cannot|can't) work without|requires) (?:java)?scripts?|your browser (?:blocks|does not support|doesn't support) (?:java)?scripts?|javascript (?:is )?(?:required|disabled)(?=\W*$)"
    r"|(?:bitte )?(?:javascript|skripte|aktive inhalte) (?:einschalten|aktivieren|zulassen|erlauben)|(?:bitte )?(?:aktivieren|erlauben) sie (?:javascript|skripte|aktive inhalte)|(?:bitte )?lassen sie aktive inhalte zu|(?:diese|die) (?:seite|anwendung|website) (?:funktioniert|läuft) nicht ohne (?:javascript|skripte?)|ihr browser blockiert (?:javascript|skripte)"
    r"|(?:veuillez )?(?:activez|activer|autorisez|autoriser) (?:le )?(?:javascript|les scripts|le contenu actif|contenu actif)|cette (?:page|application) ne (?:marche|fonctionne) pas sans (?:les )?(?:java)?scripts?|votre navigateur bloque (?:le |les )?(?:java)?scripts?"
    r"|(?:por favor,? )?(?:active|habilite|permita) (?:el )?(?:javascript|los scripts|contenido activo)|esta (?:página|aplicación) no funciona sin (?:java)?scripts?|su navegador bloquea (?:los )?(?:java)?scripts?"
    r"|(?:por favor,? )?(?:ative|habilite|permita) (?:o )?(?:javascript|os scripts|conteúdo ativo)|esta (?:página|aplicação) não funciona sem (?:java)?scripts?|(?:o )?seu navegador bloqueia (?:os )?(?:java)?scripts?"
    r"|slå javascript til|aktiver javascript|tillad aktivt indhold|(?:siden|denne side) virker ikke uden (?:java)?scripts?|din browser blokerer (?:java)?scripts?"
    r"|slå på javascript|aktivera javascript|tillåt aktivt innehåll|(?:sidan|denna sida) fungerar inte utan (?:java)?s[ck]ript|din webbläsare blockerar (?:java)?s[ck]ript"
    r"|(?:zet javascript aan|schakel javascript in|sta actieve inhoud toe)|deze pagina werkt niet zonder (?:java)?scripts?|uw browser blokkeert (?:java)?scripts?"
    r"|(?:пожалуйста, )?включите javascript|разрешите активное содержимое|эта страница не работает без (?:javascript|скриптов)|ваш браузер блокирует (?:javascript|скрипты)",
    re.I,
)
#: Words of the wordings above that their patterns write in parts.
_WRITTEN_OUT = frozenset("vedligeholdelse wartungsarbeiten script scripts skript skripte server serveren servern permission permisos".split())
#: Everyday words of the wordings above; no phrase consists of them alone.
_EVERYDAY = frozenset("her ihr seu din most again have down some non sie geen keine kunde kunne could bad this that page title text texto texte tekst the your uw finns inte ikke".split())


def units_of(text: str) -> Iterator[str]:
    """The sentences of a text, tags aside, without lines of interface strings."""
    for line in text.split("\n"):
        if line and not _KEY_VALUE.match(line):
            yield from _SENTENCE.split(line)


class Labeller:
    """known: common words of the languages in lower case, short: the short ones every sentence has; filler has neither."""

    def __init__(self, known: set[str], short: set[str]):
        self.known, self.short = known | short, short
        #: a unit without any of these can match no wording: every phrase has a word that isn't common
        phrases = " ".join(p.pattern for p in (_FILLER, _ERROR, _ERROR_WEAK, _SCRIPT)).lower()
        self.hints = frozenset(w for w in _WORD.findall(re.sub(r"\\\w|\?:", " ", phrases)) if len(w) > 2) - self.known - _EVERYDAY | _WRITTEN_OUT
        self.hashes: dict[str, int] = {}

    def _hashed(self, units: list[list[str]]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """Of each unit the hashes that near-duplicates share one of at least (odd), its number of shingles, and its SimHash.

        Two sets of m and n elements with a similarity of t or more have t * m and t * n in common at least; in any order that
        holds for all, the first m - ceil(t * m) + 1 of the one then meet the like prefix of the other. A unit of fewer words
        than a shingle resembles only itself and has no hash.
        """
        import xxhash

        lens = np.fromiter(map(len, units), np.int64, len(units))
        none = np.zeros(len(units), np.int64)
        if lens.sum() < SHINGLE:
            return [np.zeros(0, np.int64)] * len(units), none, none
        flat = [w for u in units for w in u]
        new = set(flat).difference(self.hashes)
        if len(self.hashes) + len(new) > 300_000:
            self.hashes.clear()
            new = set(flat)
        self.hashes.update((w, xxhash.xxh64_intdigest(w)) for w in new)
        h = np.fromiter(map(self.hashes.__getitem__, flat), np.uint64, len(flat))
        n = len(h) - SHINGLE + 1
        x = sum(h[j : j + n] * _FACTORS[j] for j in range(SHINGLE))
        x = (x ^ (x >> np.uint64(32))) * _FACTORS[0]
        x ^= x >> np.uint64(29)
        owner = np.repeat(np.arange(len(units)), lens)
        whole = owner[:n] == owner[SHINGLE - 1 :]
        x, owner = x[whole], owner[:n][whole]
        if not len(x):
            return [np.zeros(0, np.int64)] * len(units), none, none
        order = np.lexsort((x, owner))
        x, owner = x[order], owner[order]
        once = np.ones(len(x), bool)
        once[1:] = (x[1:] != x[:-1]) | (owner[1:] != owner[:-1])
        x, owner = x[once], owner[once]
        sizes = np.bincount(owner, minlength=len(units))
        before = np.cumsum(sizes) - sizes
        place = np.arange(len(x)) - before[owner]
        first = place < (sizes - np.ceil(MIN_SIMILARITY * sizes - 1e-9).astype(np.int64) + 1)[owner]
        ends = np.cumsum(np.bincount(owner[first], minlength=len(units)))
        some = np.flatnonzero(sizes)
        ones = np.add.reduceat(np.unpackbits(x[:, None].view(np.uint8), axis=1).astype(np.int32), before[some], axis=0)
        simhash = none.copy()
        simhash[some] = np.packbits(2 * ones > sizes[some, None], axis=1).view(np.int64)[:, 0]
        return np.split((x[first] | np.uint64(1)).view(np.int64), ends[:-1]), sizes, simhash

    def label(self, unit: str, words: list[str], slots: bool) -> tuple[str | None, bool]:
        """The unit's label, and whether its wording alone is enough for it."""
        bare = _TAG.sub(" ", unit) if "<" in unit else unit
        if slots and _SLOT_HINT.search(unit) and (m := _SLOT.search(bare)) and not _ABOUT_SLOTS.search(unit):
            return "placeholder" if len(words) > 1 or m.end() - m.start() < len(unit) else "filler", True
        n = len(words)
        if n <= 3 and _CODE_LINE.match(bare.strip()):
            return "error", False
        if not self.hints.isdisjoint(words):
            message = bare[_LEAD.match(bare).end() :]
            if _SCRIPT.match(message):
                return "script", True
            if _ERROR.match(message) or _ERROR.match(bare.lstrip()):
                return "error", True
            if _ERROR_WEAK.match(message):
                return "error", False
            if (m := _FILLER.match(bare)) and self.short.isdisjoint(_WORD.findall(bare[m.end() :].lower())):
                return "filler", True
        if n == 0:
            return ("filler", True) if re.fullmatch(r"\W*(?:\.{4,}\s*){2,}\W*", unit) else (None, False)
        if n >= 2 and len(set(words)) == 1 and (words[0] in _DUMMY or len(words[0]) > 3 and words[0] not in self.known):
            return "filler", words[0] in _DUMMY
        if n >= 5 and words[0] < "ɐ":
            if not _LOREM.isdisjoint(words) and sum(w in _LOREM for w in words) >= 0.5 * n:
                return "filler", True
            if self.short.isdisjoint(words) and sum(w in self.known for w in words) <= 0.3 * n:
                return BARE, False
        return None, False

    def document(self, text: str) -> list[tuple[str, list[str], str | None, bool]]:
        """(unit, words, label, trusted) of a text; a weak label stays where another unit has one of its kind, or no unit has none."""
        slots = any(x in text for x in ("{", "[", "<", "%", "$", "«", "#", "|", "~", "@@", "__", "XXXX", "TODO", "TBD", "???", "FIXME"))
        out = []
        for u in units_of(text):
            ws = _WORD.findall(_TAG.sub(" ", u).lower() if "<" in u else u.lower())
            if ws or len(u) > 3 or u.strip("() ").isdigit():
                out.append((u, ws, *self.label(u, ws, slots)))
        signs = [x[2] for x in out if x[2]]
        if any(x[2] and not x[3] and x[2] != BARE for x in out):
            alone = len(signs) == len(out)
            out = [(u, ws, x if sure or x in (None, BARE) or alone or signs.count(x) > 1 or x == "filler" and BARE in signs else None, sure) for u, ws, x, sure in out]
        return out

    def batch(self, ids: list, texts: list[str]) -> pd.DataFrame:
        import xxhash

        out_id, out_text, out_label, out_words, trusted, n_long = [], [], [], [], [], []
        for i, t in zip(ids, texts):
            units = self.document(t)
            long = sum(len(ws) >= 3 for _, ws, _, _ in units)
            for _, ws, x, sure in units:
                out_id.append(i)
                out_words.append(ws)
                out_label.append(x)
                trusted.append(sure)
                out_text.append(" ".join(ws))
                n_long.append(long)
        h = np.fromiter((xxhash.xxh64_intdigest(t) for t in out_text), np.uint64, len(out_text)).view(np.int64)
        keys, sizes, simhash = self._hashed(out_words)
        return pd.DataFrame({"row_id": out_id, "n_long": n_long, "unit": h, "n_shingles": sizes, "simhash": simhash, "keys": keys, "label": out_label, "trusted": trusted, "words": out_text})


def table_keys(simhash: np.ndarray) -> np.ndarray:
    """The keys of each 64-bit SimHash, one per table; a key tells its table and is even."""
    u = simhash.astype(np.int64).view(np.uint64)
    blocks, at = [], 0
    for size in BLOCKS:
        blocks.append((u >> np.uint64(at)) & np.uint64((1 << size) - 1))
        at += size
    out = []
    for t, chosen in enumerate(TABLES):
        key = np.full(len(u), t, np.uint64)
        for b in chosen:
            key = (key << np.uint64(BLOCKS[b])) | blocks[b]
        out.append(key << np.uint64(1))
    return np.stack(out, axis=1).view(np.int64)


def _slot_of(keys: np.ndarray, bits: int, which: int = 0) -> np.ndarray:
    x = keys.view(np.uint64) * _FACTORS[which]
    x = (x ^ (x >> np.uint64(31))) * _FACTORS[which + 1]
    return (x >> np.uint64(64 - (bits.bit_length() - 1))).astype(np.int64)


def shingles(words: str) -> set[str]:
    w = words.split()
    n = min(SHINGLE, len(w))
    return {" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def similarity(a: str, b: str) -> float:
    x, y = shingles(a), shingles(b)
    return len(x & y) / len(x | y) if x or y else 0.0


def _keys_of(bits: np.ndarray | None, spark: SparkSession):
    """A UDF of a unit's SimHash and prefix: the keys of both by which others find it; with a filter, those that it holds."""
    shared = spark.sparkContext.broadcast(bits) if bits is not None else None

    @F.pandas_udf("array<bigint>")
    def f(simhash: pd.Series, keys: pd.Series) -> pd.Series:
        if not len(keys):
            return keys
        tables = table_keys(simhash.to_numpy(np.int64))
        lens = keys.map(len).to_numpy(np.int64) + len(TABLES)
        ends = np.cumsum(lens)
        flat = np.empty(ends[-1], np.int64)
        own = np.ones(len(flat), bool)
        at = ((ends - lens)[:, None] + np.arange(len(TABLES))).ravel()
        flat[at], own[at] = tables.ravel(), False
        flat[own] = np.concatenate(keys.to_list()).astype(np.int64)
        if shared is None:
            return pd.Series(np.split(flat, ends[:-1]), index=keys.index)
        left = np.arange(len(flat))
        for k in range(FILTER_HASHES):
            at = _slot_of(flat[left], 64 * len(shared.value), k)
            left = left[(shared.value[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1]
        keep = np.zeros(len(flat), bool)
        keep[left] = True
        kept = np.concatenate([[0], np.cumsum(keep)])[ends]
        return pd.Series(np.split(flat[keep], kept[:-1]), index=keys.index)

    return f


def _filter_of(keyed: DataFrame) -> np.ndarray:
    """A bit for each key, collected in 64-bit words of which there are at most FILTER_BITS[1] / 64, whatever the number of keys."""
    low, high = FILTER_BITS
    bits = min(high, max(low, 1 << (24 * keyed.count()).bit_length()))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            at = np.unique(np.concatenate([_slot_of(b["key"].to_numpy(), bits, k) for k in range(FILTER_HASHES)]))
            yield pd.DataFrame({"word": at >> 6, "bits": np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)).view(np.int64)})

    words = keyed.select("key").mapInPandas(run, "word BIGINT, bits BIGINT").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    out = np.zeros(bits // 64, np.uint64)
    out[words["word"].to_numpy(np.int64)] = words["bits"].to_numpy(np.int64).view(np.uint64)
    return out


def _judge_bare(units: DataFrame, least_rate: float = 0.5, least_share: float = 0.7) -> DataFrame:
    """units with BARE replaced: filler where least_share of the words are filler words, else null. A word is one if
    least_rate of the different units without common words that hold it also hold a word of the best-known filler text:
    a rate, so that it doesn't depend on the size of the corpus. Only these units are taken apart."""
    odd = units.filter(F.col("label").isin("filler", BARE)).select("unit", "label", F.split("words", " ").alias("ws")).dropDuplicates(["unit"])
    odd = materialise(odd.withColumn("lorem", F.arrays_overlap("ws", F.array(*map(F.lit, sorted(_LOREM))))), "residue-odd")
    words = odd.select("unit", "label", "lorem", F.explode(F.array_distinct("ws")).alias("word"))
    filler_words = words.groupBy("word").agg(F.avg(F.col("lorem").cast("int")).alias("rate")).filter(F.col("rate") >= least_rate).select("word", F.lit(1).alias("hit"))
    bare = words.filter(F.col("label") == BARE).join(filler_words, "word", "left")
    filler = bare.groupBy("unit").agg((F.count("hit") / F.count(F.lit(1))).alias("share")).filter(F.col("share") >= least_share).select("unit", F.lit("filler").alias("judged"))
    filler = materialise(filler, "residue-bare")
    rest = units.filter(F.col("label").isNull() | (F.col("label") != BARE))
    judged = units.filter(F.col("label") == BARE).join(filler, "unit", "left").withColumn("label", F.col("judged")).withColumn("trusted", F.col("judged").isNotNull()).select(*units.columns)
    return rest.unionByName(judged)


@F.pandas_udf(DoubleType())
def _alike(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([similarity(x, y) for x, y in zip(a, b)])


def _one(d: DataFrame) -> DataFrame:
    return d.groupBy("unit").agg(*[F.min(c).alias(c) for c in ("n_shingles", "simhash", "keys", "label", "words")])


def near_labelled(units: DataFrame, frontier: DataFrame) -> DataFrame:
    """The unlabelled units that are near-duplicates of units of the frontier, once each, with the (smallest) label they get.

    Both have unit, n_shingles, simhash, keys, label, words. A key that many units share is split among tasks by the
    adaptive join; no group is gathered.
    """
    spark = units.sparkSession
    probes = materialise(frontier.select("unit", "n_shingles", "simhash", "label", F.explode(_keys_of(None, spark)("simhash", "keys")).alias("key")).toDF("p_unit", "p_shingles", "p_simhash", "p_label", "key"), "residue-probes")
    near = units.filter("label IS NULL AND n_shingles > 0").select("unit", "n_shingles", "simhash", "keys", "words", F.explode(_keys_of(_filter_of(probes), spark)("simhash", "keys")).alias("key"))
    near = near.groupBy("key", "unit").agg(*[F.min(c).alias(c) for c in ("n_shingles", "simhash", "keys", "words")])
    hits = near.join(probes, "key").filter(F.least("n_shingles", "p_shingles") >= MIN_SIMILARITY * F.greatest("n_shingles", "p_shingles") - 1e-9)
    by_prefix, close = F.col("key").bitwiseAND(1) == 1, F.bit_count(F.col("simhash").bitwiseXOR(F.col("p_simhash"))) <= MAX_HAMMING
    hits = hits.filter(by_prefix | close).dropDuplicates(["unit", "p_unit"]).join(frontier.select(F.col("unit").alias("p_unit"), F.col("words").alias("p_words")), "p_unit")
    hits = hits.filter(_alike("words", "p_words") >= MIN_SIMILARITY)
    new = materialise(_one(hits.select("unit", "n_shingles", "simhash", "keys", F.col("p_label").alias("label"), "words")), "residue-near")
    discard(probes)
    return new


def label_documents(docs: DataFrame, known: set[str], short: set[str], row_id: str = "doc_id", text: str = "text") -> DataFrame:
    """row_id, label: one row for each document that holds residue (the first of its labels in order of LABELS).

    Null, empty and blank texts hold none; rows without an id are left out. Texts are read whole; repeated texts get the same
    label; a row that comes twice counts as one document; extra columns are ignored. Exact copies of a unit count as one in
    the comparison.
    """
    spark = docs.sparkSession
    lexicon = spark.sparkContext.broadcast((known, short))
    kind = dict(docs.dtypes)[row_id]

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lab = Labeller(*lexicon.value)
        for b in batches:
            for i in range(0, len(b), 1000):
                p = b.iloc[i : i + 1000]
                yield lab.batch(p["row_id"].tolist(), p["text"].tolist())

    texts = spread(docs.select(F.col(row_id).alias("row_id"), F.col(text).alias("text"))).filter((F.trim("text") != "") & F.col("row_id").isNotNull())
    schema = f"row_id {kind}, n_long BIGINT, unit BIGINT, n_shingles BIGINT, simhash BIGINT, keys ARRAY<BIGINT>, label STRING, trusted BOOLEAN, words STRING"
    units = _judge_bare(materialise(texts.mapInPandas(cut, schema), "residue-units"))

    frontier = materialise(_one(units.filter("trusted AND label <> 'placeholder' AND words <> ''")), "residue-trusted")
    reached = frontier.select("unit", "label")
    rounds = 0
    while not frontier.isEmpty():
        new = near_labelled(units, frontier)
        frontier = materialise(new.join(reached.select("unit"), "unit", "left_anti"), "residue-frontier")
        discard(new)
        reached = reached.unionByName(frontier.select("unit", "label"))
        rounds += 1
        if rounds % 10 == 0:
            reached = materialise(reached, "residue-reached")

    own = units.filter("label IS NOT NULL").select("row_id", "n_long", "label", "words")
    by_copy = units.filter("label IS NULL").select("row_id", "n_long", "unit", "words").join(reached, "unit").select("row_id", "n_long", "label", "words")
    long = F.size(F.split("words", " ")) >= 3
    by = own.unionByName(by_copy).groupBy("row_id").agg(
        F.min("label").alias("any_label"), F.min(F.when(F.col("label") == "placeholder", F.col("label"))).alias("slot"), F.max("n_long").alias("n_long"), F.count_if(long).alias("n_labelled")
    )
    stands = F.col("n_long") - F.col("n_labelled") <= F.greatest(F.lit(MAX_OWN), F.col("n_labelled"))
    return by.withColumn("label", F.when(stands, F.col("any_label")).otherwise(F.col("slot"))).filter("label IS NOT NULL").select(F.col("row_id").alias(row_id), "label")


def common_words(spark: SparkSession, sf_dir: str) -> tuple[set[str], set[str]]:
    """Words of the fixed sample table, and of the fixed stop word table."""
    word = F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1))
    words = {r[0] for r in spark.read.parquet(f"{sf_dir}/lang_samples.parquet").select(word.alias("w")).groupBy("w").count().filter("count > 1").collect()}
    return words, {r[0].lower() for r in spark.read.parquet(f"{sf_dir}/stopwords.parquet").select("word").collect() if r[0]}


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return label_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"), *common_words(spark, sf_dir))


def found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels(spark, sf_dir).select("doc_id")


def kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without residue: doc_id, n_chars."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "n_chars").join(found(spark, sf_dir), "doc_id", "left_anti")
