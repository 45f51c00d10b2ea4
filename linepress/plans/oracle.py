"""The same queries in SQL for DuckDB, written from their definitions.

RE2 has neither look-behind nor Unicode properties beyond general categories: Alphabetic is written [\\p{L}\\p{Nl}], and
title case as two patterns of neighbours.
"""

from __future__ import annotations

from linepress.functions import text as T
from linepress.operators import repair, rules, spans, tags

ALPHA, UPPER, LOWER, CASED = r"[\p{L}\p{Nl}]", r"\p{Lu}", r"[\p{Ll}ªº\x{2170}-\x{217f}]", r"[\p{Lu}\p{Ll}\p{Lt}ªº\x{2160}-\x{217f}]"
WS = r"[ \t\n\x0b\f\r]"
BLANKS = r"[ \t\n\x0b\f\r\p{Z}\x{85}\x1c-\x1f]"
CLEAN = "replace(replace(replace({}, chr(13), ''), chr(0), ''), '‌', '')"


def q(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


def count(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {q(pattern)}))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {q(f'^{BLANKS}+|{BLANKS}+$')}, '', 'g')"


def fold(x: str) -> str:
    for a, b in {"ß": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ς": "σ"}.items():
        x = f"replace({x}, '{a}', '{b}')" if x.startswith("replace") else f"replace(lower({x}), '{a}', '{b}')"
    return x


def loose(x: str) -> str:
    """Small letters in Latin without accents, blanks, ASCII punctuation and digits."""
    source, target, long = T.ascii_tables()
    table = "MAP {" + ", ".join(f"{q(a)}: {q(b)}" for a, b in long.items()) + "}"
    x = f"lower(coalesce({x}, ''))"
    x = f"CASE WHEN regexp_matches({x}, '{T.char_class(long)}') THEN array_to_string(list_transform(string_split({x}, ''), lambda c: coalesce({table}[c], c)), '') ELSE {x} END"
    return f"regexp_replace(regexp_replace(translate({x}, {q(source)}, {q(target)}), '\\p{{Mn}}+', '', 'g'), '[ [:punct:]0-9]', '', 'g')"


def draw(*key: str) -> str:
    return f"('0x' || substr(md5({' || chr(58) || '.join(key)}), 1, 8))::UBIGINT / 4294967296.0"


def code(x: str) -> str:
    return f"coalesce(regexp_extract(lower(trim({x})), '^([a-z]*)', 1), '')"


DATASETS = f"SELECT ds, {code('src_lang')} src_lang, {code('tgt_lang')} tgt_lang, weight FROM datasets"
PAIRS = f"SELECT pair_id, b.ds, line_no, coalesce(source_segment, '') s, coalesce(target_segment, '') g, coalesce(src_lang, '') src_lang, coalesce(tgt_lang, '') tgt_lang FROM bifixer b LEFT JOIN ({DATASETS}) d ON b.ds = d.ds"
LINES = "SELECT doc_id, doc_kind, unnest(range(0, len(l))) line_no, unnest(l) AS text FROM (SELECT doc_id, doc_kind, string_split(text, chr(10)) l FROM documents WHERE text IS NOT NULL)"
ONCE = "SELECT * FROM bifixer QUALIFY row_number() OVER (PARTITION BY ds, line_no ORDER BY pair_id) = 1"
SIZED = f"SELECT d.ds, src_lang, tgt_lang, weight, coalesce(n, 0) AS size FROM ({DATASETS}) d LEFT JOIN (SELECT ds, count(*) n FROM bifixer GROUP BY ds) c ON d.ds = c.ds"


def title(x: str) -> str:
    return f"NOT regexp_matches({x}, {q(f'{CASED}[{UPPER}' + chr(92) + 'p{Lt}]')}) AND NOT regexp_matches({x}, {q(f'(^|[^{CASED[1:-1]}]){LOWER}')}) AND regexp_matches({x}, {q(f'[{UPPER}' + chr(92) + 'p{Lt}]')})"


URL = r"((?:https?://|www\d{0,3}[.]|[a-z0-9.\-]+[.][a-z]{2,4}/)(?:[^\s()<>]|\((:?[^\s()<>]+|(\([^\s()<>]+\)))*\))+(?:\(([^\s()<>]+|(\([^\s()<>]+\)))*\)|[^\s`!()\[\]{};:'" + r'".,<>?«»“”‘’]))'


def url_chars(x: str) -> str:
    """Characters in all five groups of all URLs."""
    return "(" + " + ".join(f"coalesce(length(array_to_string(regexp_extract_all({x}, {q(URL)}, {k}), '')), 0)" for k in range(1, 6)) + ")"


def rule_list(minimal_length: bool = True) -> list[tuple[str, str]]:
    """(reason, SQL) of each rule over columns s, g, src_lang, tgt_lang."""
    two = lambda name, f: [(f"{name}(left)", f("s")), (f"{name}(right)", f("g"))]
    ratio = lambda f: f"({f}(s)::DOUBLE / nullif({f}(g), 0) BETWEEN 0.5 AND 2)"
    langs = ", ".join(f"'{x}'" for x in rules.SAFE_NOISE_LANGS)
    without = lambda p: fold(f"regexp_replace(s, {q(p)}, '', 'g')") + " = " + fold(f"regexp_replace(g, {q(p)}, '', 'g')")
    blank = r"[ \x{a0}]"
    literal = lambda x, ws: "(" + " OR ".join(f"contains({x}, {q(w)})" for w in ws) + ")"
    out = [("len(left) >= 1024", "length(s) >= 1024"), ("len(right) >= 1024", "length(g) >= 1024")]
    out += [("c_no_literals(['Re:'], left)", literal("s", ["Re:"])), ("c_no_literals(['Re:'], right)", literal("g", ["Re:"]))]
    if minimal_length:
        out.append(("c_minimal_length(left) and c_minimal_length(right)", f"{count('s', blank)} < 2 AND {count('g', blank)} < 2"))
    out += [
        ("c_length or c_length_bytes", f"NOT ({ratio('length')} OR {ratio('strlen')})"),
        ("c_identical", f"{fold('s')} = {fold('g')}"),
        ("c_identical_wo_digits", without("[0-9]")),
        ("c_identical_wo_punct", without(r"[\p{P}\p{S}]")),
    ]
    out += two("c_majority_alpha", lambda x: f"{count(x, ALPHA)}::DOUBLE / nullif(length({x}), 0) < 0.5")
    out += two("c_no_urls", lambda x: f"{url_chars(x)} >= 15")
    out += two("c_no_breadcrumbs1", lambda x: f"{count(x, '( [-/] |[<>*]| : )')} >= 3")
    out += two("c_no_breadcrumbs2", lambda x: f"{count(x, '( » |[|→←•·¬])')} >= 2")
    out += two("c_no_glued_words", lambda x: f"regexp_matches({x}, {q(f'({ALPHA}*{UPPER}{LOWER}+){{3}}')})")
    noise = r"[\x{80}-\x{ff}]{3,}"
    out += [
        ("args.source_lang in safe_noise_detection_langs and not c_no_noise(left)", f"src_lang IN ({langs}) AND regexp_matches(s, {q(noise)})"),
        ("args.target_lang in safe_noise_detection_langs and not c_no_noise(right)", f"tgt_lang IN ({langs}) AND regexp_matches(g, {q(noise)})"),
    ]
    out += two("c_no_space_noise", lambda x: f"regexp_matches({x}, {q('( [^' + chr(92) + 'n]){4,} ')})")
    out += two("c_no_paren", lambda x: f"{count(x, r'[' + chr(92) + '[' + chr(92) + r'](){}]')} >= 10")
    out += two("c_unwanted", lambda x: f"{count(x, '[+*]')} >= 5")
    out += two("c_inconditional", lambda x: f"contains({x}, '=\"')")
    out += two("c_no_escaped_unicode", lambda x: f"regexp_matches({x}, {q(chr(92) * 2 + 'u[0-9a-fA-F]{3,}')})")
    names = '["{{", "%s", "}}"]'
    out += [(f"c_no_literals({names}, left)", literal("s", rules.PLACEHOLDERS)), (f"c_no_literals({names}, right)", literal("g", rules.PLACEHOLDERS))]
    out.append(("left.istitle() and right.istitle()", f"{title('s')} AND {title('g')}"))
    return out


def with_urls() -> str:
    at = "coalesce(ds, '') || '/' || line_no"
    s = ["''", f"' https://example.org/' || {at}", f"' www.example.org/' || {at} || '_(a(b))'", f"' http://a.org/x ' || {at}", f"' data.example.net/' || {at} || '/(x)(y(z)w).'", "' ftp:/none'"]
    g = [f"' www2.example.com/(b(c)d) ' || {at}", "''", "' a.org/'", f"' http://a.org/x ' || {at}", "' https://'", "' ftp:/none'"]
    return f"SELECT * REPLACE (s || [{', '.join(s)}][(pair_id % 6 + 1)::INT] AS s, g || [{', '.join(g)}][(pair_id % 6 + 1)::INT] AS g) FROM ({PAIRS})"


def verdicts(source: str = PAIRS, columns: str = "pair_id") -> str:
    cases = " ".join(f"WHEN coalesce({e}, false) THEN {q(r)}" for r, e in rule_list())
    return f"SELECT {columns}, CASE WHEN trim(s) = '' OR trim(g) = '' THEN 'empty_side' {cases} ELSE 'keep' END AS reason FROM ({source})"


def hits(x: str, source: str) -> str:
    """pair_id, lang, hits of the stop word scorer for column x of source."""
    return f"SELECT pair_id, lang, len(list_filter(regexp_extract_all(lower({x}), '\\p{{L}}+'), lambda t: list_contains(ws, t))) hits FROM ({source}), (SELECT lang, list(DISTINCT word) ws FROM stopwords WHERE word IS NOT NULL GROUP BY lang)"


def top(x: str, source: str, k: int = 3) -> str:
    return f"SELECT pair_id, lang, hits, row_number() OVER (PARTITION BY pair_id ORDER BY hits DESC, lang) r FROM ({hits(x, source)}) WHERE hits > 0 QUALIFY r <= {k}"


def verdicts_lang() -> str:
    det = lambda x, n: f"{n} AS (SELECT pair_id, max(CASE WHEN r = 1 THEN lang END) lang, coalesce(max(CASE WHEN r = 1 THEN hits END) >= 3 AND max(CASE WHEN r = 1 THEN hits END) >= 2 * coalesce(max(CASE WHEN r = 2 THEN hits END), 0), false) ok FROM (SELECT pair_id, lang, hits, row_number() OVER (PARTITION BY pair_id ORDER BY hits DESC, lang) r FROM ({hits(x, PAIRS)}) WHERE hits > 0) GROUP BY pair_id)"
    similar = "(VALUES " + ", ".join(f"('{a}+{b}')" for a, b in rules.SIMILAR_PAIRS) + ")"
    no = lambda x: f"(CASE {x} WHEN 'nb' THEN 'no' ELSE {x} END)"
    pair = lambda a, b: f"(least({a}, {b}) || '+' || greatest({a}, {b})) IN (SELECT * FROM {similar})"
    s, t = no("src_lang"), no("tgt_lang")
    differ = f"NOT coalesce(NOT (s_ok AND t_ok) OR s_det <> t_det OR ((s_det = {s} OR s_det = {t}) AND {pair(s, t)}), false)"
    long = lambda x, ok, det, lang: f"length({x}) > 30 AND {ok} AND {no(det)} <> {no(lang)} AND NOT {pair(no(det), no(lang))}"
    rs = rule_list()
    at = next(i for i, (r, _) in enumerate(rs) if r == "c_majority_alpha(left)")
    rs = rs[:at] + [("c_different_language", differ)] + rs[at:]
    rs += [("c_reliable_long_language(left, sourcelang)", long("s", "s_ok", "s_det", "src_lang")), ("c_reliable_long_language(right, targetlang)", long("g", "t_ok", "t_det", "tgt_lang"))]
    cases = " ".join(f"WHEN coalesce({e}, false) THEN {q(r)}" for r, e in rs)
    src = f"SELECT p.*, coalesce(a.ok, false) s_ok, a.lang s_det, coalesce(b.ok, false) t_ok, b.lang t_det FROM ({PAIRS}) p LEFT JOIN a ON p.pair_id = a.pair_id LEFT JOIN b ON p.pair_id = b.pair_id"
    return f"WITH {det('s', 'a')}, {det('g', 'b')}, v AS (SELECT pair_id, CASE WHEN trim(s) = '' OR trim(g) = '' THEN 'empty_side' {cases} ELSE 'keep' END AS reason FROM ({src})) SELECT pair_id, reason, reason = 'keep' AS keep FROM v"


def fixed_native() -> str:
    x = f"regexp_replace({strip('source_segment')}, ' +', ' ', 'g')"
    x = f"regexp_replace({x}, '^[ \\n]+|[ \\n]+$', '', 'g')"
    x = f"regexp_replace({x}, '& *# *([0-9]{{2,6}}) *;', '&#\\1;', 'g')"
    for r in (r"[\x{E000}-\x{FFFF}]", r"[\x{2000}-\x{200F}]", r"[\x{7F}-\x{A0}]"):
        x = f"regexp_replace({x}, '{r}', '', 'g')"
    x = f"regexp_replace({x}, {q(f'({ALPHA})' + chr(39) * 2 + f'((?:{repair.CONTRACTIONS})' + chr(92) + 'W)')}, '\\1''\\2', 'g')"
    before = "|".join(chr(92) + c if c in "!?:;,)}]º" else c.replace(".", chr(92) + ".") for c in (m[1:] for m in repair.CLOSE_UP if m[0] == " "))
    before = before.replace(chr(92) + "º", "º")
    after = "|".join(chr(92) + c if c in "({[" else c for c in (m[:-1] for m in repair.CLOSE_UP if m[-1] == " "))
    return strip(f"regexp_replace({x}, ' ({before})|({after}) ', '\\1\\2', 'g')")


def distribution(method: str) -> str:
    if method == "original":
        p = f"SELECT *, size::DOUBLE p FROM ({SIZED})"
    elif method == "uniform":
        p = f"SELECT *, CASE WHEN size > 0 THEN 1.0 ELSE 0.0 END p FROM ({SIZED})"
    else:
        by = f"SELECT lang, sum(size) n FROM (SELECT src_lang lang, size FROM ({SIZED}) UNION ALL SELECT tgt_lang, size FROM ({SIZED})) WHERE lang <> '' GROUP BY lang"
        p = f"SELECT z.*, coalesce(q, 0) p FROM ({SIZED}) z LEFT JOIN (SELECT lang, pow(n, 0.2) / sum(pow(n, 0.2)) OVER () q FROM ({by})) l ON z.tgt_lang = l.lang"
    w = f"SELECT ds, src_lang, tgt_lang, size, CASE WHEN size > 0 THEN p * coalesce(weight, 1) ELSE 0 END w FROM ({p})"
    return f"SELECT ds, src_lang, tgt_lang, size, w / sum(w) OVER () prob FROM ({w})"


def cumulative(source: str, order: str, by: str = "") -> str:
    part = f"PARTITION BY {by} " if by else ""
    return f"SELECT *, coalesce(lag(run) OVER ({part}ORDER BY {order}), 0) lo, CASE WHEN row_number() OVER ({part}ORDER BY {order} DESC) = 1 THEN 2.0 ELSE run END hi FROM (SELECT *, sum(prob) OVER ({part}ORDER BY {order} ROWS UNBOUNDED PRECEDING) run FROM ({source}) WHERE prob > 0)"


def resampled(method: str) -> str:
    broken = lambda x: strip(f"replace({CLEAN.format(x)}, '﻿', '')")
    clean = f"SELECT ds, line_no FROM ({ONCE}) WHERE {broken('coalesce(source_segment, chr(32))')} <> '' AND {broken('coalesce(target_segment, chr(32))')} <> ''"
    sized = f"SELECT d.*, coalesce(n, 0) AS size FROM ({DATASETS}) d LEFT JOIN (SELECT ds, count(*) n FROM clean GROUP BY ds) c ON d.ds = c.ds"
    dist = distribution(method).replace(SIZED, sized)
    d = f"SELECT i draw_no, ds, size, row_number() OVER (PARTITION BY ds ORDER BY i) k FROM (SELECT i, {draw(q('r6'), 'i')} u FROM range(1, 5001) t(i)) JOIN ({cumulative(dist, 'ds')}) ON u >= lo AND u < hi"
    return f"WITH clean AS ({clean}), d AS ({d}), n AS (SELECT *, row_number() OVER (PARTITION BY ds ORDER BY line_no) o FROM clean) SELECT draw_no, d.ds, line_no FROM d JOIN n ON d.ds = n.ds AND n.o = (k - 1) % size + 1"


def resampled_mono(method: str) -> str:
    weight = {"uniform": "1.0", "original": "size::DOUBLE", "temperature": "pow(size::DOUBLE, 0.2)"}[method]
    ds = f"SELECT d.ds, src_lang lang, n AS size FROM ({DATASETS}) d JOIN (SELECT ds, count(*) n FROM once GROUP BY ds) c ON d.ds = c.ds WHERE src_lang <> ''"
    langs = cumulative(f"SELECT lang, {weight} / sum({weight}) OVER () prob FROM (SELECT lang, sum(size) size FROM ({ds}) GROUP BY lang)", "lang")
    within = cumulative(f"SELECT lang, ds, size, {weight} / sum({weight}) OVER (PARTITION BY lang) prob FROM ({ds})", "ds", "lang")
    u = f"SELECT i, {draw(q('r7'), q('lang'), 'i')} u, {draw(q('r7'), q('ds'), 'i')} v FROM range(1, 5001) t(i)"
    d = f"SELECT i draw_no, w.lang, w.ds, size, row_number() OVER (PARTITION BY w.ds ORDER BY i) k FROM ({u}) x JOIN ({langs}) l ON u >= l.lo AND u < l.hi JOIN ({within}) w ON w.lang = l.lang AND v >= w.lo AND v < w.hi"
    return f"WITH once AS ({ONCE}), d AS ({d}), n AS (SELECT ds, line_no, row_number() OVER (PARTITION BY ds ORDER BY line_no) o FROM once) SELECT draw_no, lang, d.ds, line_no FROM d JOIN n ON d.ds = n.ds AND n.o = (k - 1) % size + 1"


def protected_pairs(pattern: str, url: str, max_id: int = 5, dropout: float = 0.1) -> str:
    """Matches of the source replaced one after the other on both sides, by recursion over their number."""
    kind = f"CASE WHEN regexp_full_match(m, {q(tags.TAG)}) THEN ' [TAG' WHEN regexp_full_match(m, {q(url)}) THEN ' [URL' ELSE ' [EML' END"
    number = f"CASE WHEN n = 1 THEN floor({draw(q('tags'), q('id'), 'pair_id')} * {max_id})::INT::VARCHAR WHEN i > {max_id} THEN '' ELSE i::VARCHAR END"
    put = lambda x: f"CASE WHEN strpos({x}, m) > 0 THEN substr({x}, 1, strpos({x}, m) - 1) || repl || substr({x}, strpos({x}, m) + length(m)) ELSE {x} END"
    found = f"SELECT pair_id, s, g, regexp_extract_all(s, {q(pattern)}) ms FROM ({PAIRS})"
    one = f"SELECT pair_id, i, m, {kind} || ({number}) || '] ' repl, {draw(q('tags'), 'i', 'pair_id')} >= {dropout} used FROM (SELECT pair_id, len(ms) n, unnest(range(0, len(ms))) i, unnest(ms) m FROM f)"
    step = f"SELECT w.pair_id, w.i + 1, CASE WHEN used THEN {put('s')} ELSE s END, CASE WHEN used THEN {put('g')} ELSE g END, CASE WHEN used THEN list_append(r, [repl, m]) ELSE r END FROM w JOIN o ON o.pair_id = w.pair_id AND o.i = w.i"
    return f"WITH RECURSIVE f AS ({found}), o AS MATERIALIZED ({one}), w(pair_id, i, s, g, r) AS (SELECT pair_id, 0::BIGINT, s, g, []::VARCHAR[][] FROM f WHERE len(ms) > 0 UNION ALL {step}) SELECT pair_id, s source_segment, g target_segment, to_json(r)::VARCHAR repls FROM w WHERE i = (SELECT len(ms) FROM f WHERE f.pair_id = w.pair_id) AND len(r) > 0"


def sharded(limit: int) -> str:
    sizes = f"SELECT ds, count(*) n FROM ({ONCE}) GROUP BY ds"
    k = f"SELECT ds, n, least(greatest(n // greatest(min(n) OVER (), 1), 1), {limit})::INT n_shards FROM ({sizes})"
    i = f"SELECT o.ds, line_no, n, n_shards, row_number() OVER (PARTITION BY o.ds ORDER BY line_no) - 1 i FROM ({ONCE}) o JOIN ({k}) k ON o.ds = k.ds"
    return f"SELECT ds, line_no, n_shards, (CASE WHEN i < (n // n_shards) * n_shards THEN i // (n // n_shards) + 1 ELSE (i - (n // n_shards) * n_shards) % n_shards + 1 END)::INT shard FROM ({i})"


def query_span() -> str:
    tokens = f"SELECT pair_id, tgt_lang, list_filter(string_split_regex({strip('g')}, {q(WS + '+')}), lambda w: w <> '') tk, [1, 2, 3][floor({draw(q('span'), q('n'), 'pair_id')} * 3)::INT + 1] n FROM ({PAIRS})"
    at = lambda i: f"array_to_string(tk[floor({draw(q('span'), i, 'pair_id')} * room)::INT + 1 : floor({draw(q('span'), i, 'pair_id')} * room)::INT + n], ' ')"
    tries = f"list_transform(range(1, room + 1), lambda i: translate({at('i')}, {q(spans.STRIPPED)}, ''))"
    good = "list_filter(tries, lambda x: NOT list_contains(ws, lower(string_split(x, ' ')[-1])))"
    a = f"SELECT pair_id, tk, n, len(tk) - n room, ws FROM ({tokens}) t LEFT JOIN (SELECT lang, list(word) ws FROM stopwords GROUP BY lang) w ON t.tgt_lang = w.lang"
    b = f"SELECT *, CASE WHEN room > 0 THEN {tries} END tries FROM ({a})"
    return f"SELECT pair_id, CASE WHEN {draw(q('span'), q('drop'), 'pair_id')} < 0.2 THEN '' WHEN room < 0 THEN '' WHEN room = 0 THEN array_to_string(tk, ' ') WHEN ws IS NULL THEN {at('1')} ELSE coalesce({good}[1], tries[-1]) END AS query FROM ({b})"


def discovery() -> str:
    langs = "'da', 'de', 'en', 'es', 'fr', 'nl', 'pt', 'ru', 'sv'"
    files = r"SELECT DISTINCT p, regexp_extract(p, '\.([^./]+)$', 1) lang, regexp_replace(p, '\.[^./]+$', '') base, string_split(p, '/')[-1] name FROM (SELECT unnest([src, tgt]) p FROM datasets) WHERE p <> ''"
    below = "replace(substr({}, 6), '/', '-')"
    a = f"SELECT a.lang || '2' || b.lang || '_' || {below.format('a.base')} ds, a.lang src_lang, b.lang tgt_lang, a.p src, b.p tgt FROM f a JOIN f b ON a.base = b.base AND a.lang <> b.lang AND a.lang IN ({langs}) AND b.lang IN ({langs}) WHERE NOT contains(a.p, 'Crawl') AND NOT contains(b.p, 'Crawl')"
    m = f"SELECT lang || '_mono_' || {below.format('base')}, lang, '', p, '' FROM f WHERE lang IN ({langs}) AND NOT contains(p, 'Crawl') QUALIFY row_number() OVER (PARTITION BY name ORDER BY p) = 1"
    return f"WITH f AS ({files}) {a} UNION ALL {m}"


def sql() -> dict[str, str]:
    v = f"SELECT pair_id, reason, reason = 'keep' AS keep FROM ({verdicts()})"
    seg = lambda lang: CLEAN.format(f"split_part(list_filter(tuv, lambda x: x.lang = d.{lang})[-1].seg, '<', 1)")
    units = f"SELECT tu_id, source_segment, target_segment FROM (SELECT tu_id, replace({seg('src_lang')}, chr(10), ' ') source_segment, replace({seg('tgt_lang')}, chr(10), ' ') target_segment FROM tmx_units u JOIN datasets d ON u.ds = d.ds) WHERE source_segment <> '' AND target_segment <> ''"
    tsv = f"SELECT doc_id, line_no, string_split({strip(CLEAN.format('text'))}, chr(9)) c FROM ({LINES}) WHERE doc_kind = 'tsv'"
    sgm = f"SELECT doc_id, line_no, {strip(CLEAN.format('text'))} t FROM ({LINES}) WHERE doc_kind = 'sgm'"
    key = lambda b: f"{strip(f'coalesce({b}source_segment, chr(32))')} || chr(9) || {strip(f'coalesce({b}target_segment, chr(32))')}"
    spelled = lambda x, m: f"array_to_string(list_transform(regexp_extract_all({x}, {q(f'[-' + chr(39) + ALPHA[1:-1] + ']+|[^-' + chr(39) + ALPHA[1:-1] + ']+')}), lambda w: coalesce({m}[w], w)), '')"
    zip_parts = f"WITH o AS ({ONCE}), a AS (SELECT ds, line_no, source_segment t FROM o WHERE source_segment IS NOT NULL), b AS (SELECT ds, line_no + 1 line_no, target_segment t FROM o WHERE target_segment IS NOT NULL)"
    mean = "CASE WHEN length(s || g) = 0 THEN 0.0 ELSE ((200 * list_sum(list_transform(regexp_extract_all(s || g, '(?s).'), lambda c: unicode(c)))::BIGINT + length(s || g)) // (2 * length(s || g))) / 100.0 END"
    fixed = PAIRS.replace("coalesce(source_segment, '')", "replace(coalesce(source_segment, ''), chr(13), '')").replace("coalesce(target_segment, '')", "replace(coalesce(target_segment, ''), chr(13), '')")
    url = tags.URL.replace(r"\p{Punct}", "[:punct:]")
    protected = f"{tags.TAG}|{url}|{tags.EMAIL}"
    one_line = "translate(coalesce(source_segment, ''), chr(10) || chr(13), '  ')"
    last = lambda lang: f"split_part(trim(regexp_replace(list_filter(tuv, lambda x: x.lang = '{lang}')[-1].seg, '{WS}+', ' ', 'g')), '<', 1)"
    tmx = lambda lang: CLEAN.format(last(lang))
    sides = "SELECT pair_id, 'src' lang, coalesce(source_segment, '') t FROM bifixer UNION ALL SELECT pair_id, 'tgt', coalesce(target_segment, '') FROM bifixer"
    numbered = f"SELECT lang, t, row_number() OVER (PARTITION BY lang ORDER BY pair_id) - 1 i FROM ({sides})"
    at = "coalesce(sum(strlen(t) + 1) OVER (PARTITION BY lang ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT"
    meta = f"WITH n AS MATERIALIZED ({numbered}) SELECT 'files' kind, 'src' AS key, 'all.src' AS value UNION ALL SELECT 'files', 'tgt', 'all.tgt' UNION ALL SELECT 'lang_to_idx', lang || ':' || i // 100000, to_json(list(i ORDER BY i))::VARCHAR FROM n WHERE trim(t) <> '' GROUP BY lang, i // 100000 UNION ALL SELECT 'idx_to_lang', i::VARCHAR, to_json(coalesce(list(lang ORDER BY lang) FILTER (WHERE trim(t) <> ''), []))::VARCHAR FROM n GROUP BY i UNION ALL SELECT 'offsets', 'all.' || lang || ':' || i // 100000, to_json(list(o ORDER BY o))::VARCHAR FROM (SELECT lang, i, {at} o FROM n) GROUP BY lang, i // 100000"
    return {
        "rule_report": f"SELECT reason, count(*) n FROM ({verdicts()}) GROUP BY reason",
        "rule_verdicts": v,
        "rule_verdicts_lang": verdicts_lang(),
        "rule_flags": " UNION ALL ".join(f"SELECT {q(r)} AS rule, count(*) FILTER (WHERE coalesce({e}, false)) n FROM p" for r, e in rule_list()).join([f"WITH p AS ({PAIRS}) ", ""]),
        "url_lengths": f"SELECT pair_id, {url_chars('s')} source_chars, {url_chars('g')} target_chars FROM ({with_urls()})",
        "rule_verdicts_urls": f"SELECT pair_id, reason, reason = 'keep' AS keep FROM ({verdicts(with_urls())})",
        "charfix": f"SELECT pair_id, replace(source_segment, chr(13), '') source_segment, replace({CLEAN.format('target_segment')}, '﻿', '') target_segment, {CLEAN.format('source_segment')} extracted FROM bifixer",
        "scalar_functions": f"SELECT pair_id, length(source_segment) chars, strlen(source_segment) octets, {count('source_segment', '[  ]')} blanks, {count('source_segment', '[0-9]')} digits, round({draw(q('s'), 'pair_id')}, 9) u, '<2de> ' || source_segment tagged, md5(replace(source_segment, chr(13), '')) digest FROM bifixer",
        "rankings": f"SELECT pair_id, {mean} AS ranking FROM ({PAIRS})",
        "line_counts": "SELECT ds, count(*) n FROM bifixer GROUP BY ds",
        "size_matrix": f"WITH m AS (SELECT src_lang, tgt_lang, sum(size)::BIGINT n FROM ({SIZED}) GROUP BY ALL) SELECT * FROM m UNION ALL SELECT NULL, NULL, sum(n)::BIGINT FROM m",
        "size_pivot": f"SELECT src_lang, " + ", ".join(f"coalesce(sum(size) FILTER (WHERE tgt_lang = '{x}'), 0)::BIGINT AS {x}" for x in ("de", "en", "fr")) + f" FROM ({SIZED}) WHERE tgt_lang IN ('de', 'en', 'fr') GROUP BY src_lang",
        "language_sizes": f"SELECT lang, n AS size, round(n / sum(n) OVER (), 9) share FROM (SELECT lang, sum(size)::BIGINT n FROM (SELECT src_lang lang, size FROM ({SIZED}) UNION ALL SELECT tgt_lang, size FROM ({SIZED})) WHERE lang <> '' GROUP BY lang)",
        "dedup_exact": "SELECT DISTINCT source_segment, target_segment FROM bifixer",
        "dedup_first": f"SELECT pair_id, ds, line_no FROM ({PAIRS}) QUALIFY row_number() OVER (PARTITION BY s, g ORDER BY pair_id) = 1",
        "dedup_groups": "SELECT md5(coalesce(source_segment, '') || chr(9) || coalesce(target_segment, '')) pair_hash, count(*) n, min(pair_id) first_id FROM bifixer GROUP BY 1",
        "zip_pad": f"{zip_parts} SELECT ds, line_no, coalesce(a.t, '') source_segment, coalesce(b.t, '') target_segment FROM a FULL JOIN b USING (ds, line_no)",
        "zip_left": f"{zip_parts} SELECT ds, line_no, a.t source_segment, coalesce(b.t, '') target_segment FROM a LEFT JOIN b USING (ds, line_no)",
        "decontaminate": f"SELECT pair_id FROM bifixer b WHERE ds LIKE '%Books%' AND {key('b.')} NOT IN (SELECT {key('')} FROM bifixer WHERE ds NOT LIKE '%Books%')",
        "extract_units": units,
        "extract_units_report": f"SELECT u.ds, count(*) total, count(*) FILTER (WHERE g.tu_id IS NULL) skipped FROM tmx_units u LEFT JOIN ({units}) g ON u.tu_id = g.tu_id GROUP BY u.ds",
        "extract_tsv": f"SELECT doc_id, line_no, c[1] source_segment, c[2] target_segment FROM ({tsv}) WHERE len(c) > 1",
        "extract_sgm": f"SELECT doc_id, line_no, {strip('u')} AS text FROM (SELECT *, replace(regexp_replace(t, '<seg id=\"[0-9]+\">', '', 'g'), '</seg>', '') u FROM ({sgm})) WHERE t LIKE '<seg id=%' AND t LIKE '%</seg>'",
        "extract_docs": "SELECT doc_id, unnest(range(0, len(e))) element, unnest(e) AS text FROM (SELECT doc_id, regexp_extract_all(text, '(?s)<doc[^>]*>(.*?)</doc>', 1) e FROM documents WHERE doc_kind = 'doc_xml' AND text IS NOT NULL)",
        "orthography_fix": f"WITH m AS (SELECT lang, map_from_entries(list((trim(wrong), trim(correct)))) m FROM (SELECT DISTINCT lang, wrong, correct FROM orthography WHERE wrong IS NOT NULL AND correct IS NOT NULL QUALIFY row_number() OVER (PARTITION BY lang, trim(wrong) ORDER BY trim(correct) DESC) = 1) GROUP BY lang) SELECT pair_id, {spelled('s', 'a.m')} source_segment, {spelled('g', 'b.m')} target_segment FROM ({PAIRS}) p LEFT JOIN m a ON a.lang = src_lang LEFT JOIN m b ON b.lang = tgt_lang",
        "fix_native": f"SELECT pair_id, {fixed_native()} AS fixed FROM bifixer",
        "tag_roundtrip": f"SELECT doc_id, line_no, regexp_replace(text, {q(WS + '+')}, '', 'g') AS text FROM ({LINES})",
        "tag_counts": f"SELECT doc_id, line_no, n FROM (SELECT doc_id, line_no, {count('text', protected)} n FROM ({LINES})) WHERE n > 0",
        "query_spans": query_span(),
        "paste_queries": f"SELECT p.pair_id, {strip('s')} || CASE WHEN {strip('q.query')} <> '' THEN ' ||| ' || {strip('q.query')} ELSE '' END AS text FROM ({PAIRS}) p JOIN ({query_span()}) q ON q.pair_id = p.pair_id",
        "tag_protect": protected_pairs(protected, url),
        "dedup_near": f"SELECT n, best_id, ranking FROM (SELECT count(*) OVER (PARTITION BY h) n, row_number() OVER (PARTITION BY h ORDER BY ranking DESC, pair_id) o, pair_id best_id, ranking FROM (SELECT pair_id, md5({loose('s')} || chr(9) || {loose('g')}) h, {mean} ranking FROM ({PAIRS}))) WHERE o = 1",
        "clean_checked": f"WITH clean AS (SELECT ds, line_no, pair_id, s, g, src_lang, tgt_lang FROM ({verdicts(fixed, 'ds, line_no, pair_id, s, g, src_lang, tgt_lang')}) WHERE reason = 'keep' QUALIFY row_number() OVER (PARTITION BY s, g ORDER BY ds, line_no) = 1) SELECT p.ds, p.line_no FROM clean p WHERE EXISTS (SELECT 1 FROM ({top('s', 'SELECT * FROM clean')}) x WHERE x.pair_id = p.pair_id AND x.lang = p.src_lang) AND EXISTS (SELECT 1 FROM ({top('g', 'SELECT * FROM clean')}) y WHERE y.pair_id = p.pair_id AND y.lang = p.tgt_lang)",
        "extract_sgms": f"WITH x AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id, line_no) line_no, {strip('u')} t FROM (SELECT d.lang, l.doc_id, line_no, replace(regexp_replace(t, '<seg id=\"[0-9]+\">', '', 'g'), '</seg>', '') u, t FROM ({sgm}) l JOIN documents d ON d.doc_id = l.doc_id) WHERE t LIKE '<seg id=%' AND t LIKE '%</seg>' AND lang IN ('en', 'de')) SELECT line_no, coalesce(a.t, '') source_segment, coalesce(b.t, '') target_segment FROM (SELECT * FROM x WHERE lang = 'en') a FULL JOIN (SELECT * FROM x WHERE lang = 'de') b USING (line_no)",
        "multiway_meta": meta,
        "roundtrip_lines": f"SELECT row_number() OVER (ORDER BY pair_id) line_no, {one_line} AS text FROM bifixer",
        "roundtrip_json": "SELECT pair_id, ds, source_segment, target_segment FROM bifixer",
        "roundtrip_shards": f"SELECT ds, line_no, shard FROM ({sharded(10)})",
        "roundtrip_by_dataset": "SELECT pair_id, ds, source_segment FROM bifixer",
        "roundtrip_units": f"SELECT source_segment, target_segment, count(*) n FROM (SELECT {tmx('en')} source_segment, {tmx('de')} target_segment FROM tmx_units WHERE len(tuv) > 0) WHERE source_segment <> '' AND target_segment <> '' GROUP BY ALL",
        "roundtrip_matrix": "SELECT src_lang, " + ", ".join(f"coalesce(sum(size) FILTER (WHERE tgt_lang = '{x}'), 0)::DOUBLE AS {x}" for x in ("de", "en", "fr")) + f" FROM ({SIZED}) WHERE tgt_lang IN ('de', 'en', 'fr') GROUP BY src_lang",
        "roundtrip_docs": "SELECT doc_id, md5(trim(regexp_replace(regexp_replace(text, '[^\\x20-\\x{d7ff}]+', ' ', 'g'), '\\s+', ' ', 'g'))) digest FROM documents WHERE text IS NOT NULL",
        "langid_topk": f"SELECT pair_id, (r - 1)::INT AS rank, lang FROM ({top('source_segment', 'SELECT pair_id, source_segment FROM bifixer')})",
        "langid_reliable": f"WITH h AS ({top('source_segment', 'SELECT pair_id, source_segment FROM bifixer', 2)}) SELECT detected, reliable, count(*) n FROM (SELECT b.pair_id, a.lang detected, coalesce(a.hits >= 3 AND a.hits >= 2 * coalesce(c.hits, 0), false) reliable FROM bifixer b LEFT JOIN h a ON a.pair_id = b.pair_id AND a.r = 1 LEFT JOIN h c ON c.pair_id = b.pair_id AND c.r = 2) GROUP BY ALL",
        "langcheck": f"SELECT p.pair_id, EXISTS (SELECT 1 FROM ({top('s', PAIRS)}) x WHERE x.pair_id = p.pair_id AND x.lang = p.src_lang) AND EXISTS (SELECT 1 FROM ({top('g', PAIRS)}) y WHERE y.pair_id = p.pair_id AND y.lang = p.tgt_lang) AS lang_ok FROM ({PAIRS}) p",
        "resample_parallel": resampled("uniform"),
        "resample_counts": f"SELECT ds, count(*) n FROM ({resampled('temperature')}) GROUP BY ds",
        "shard_assign": sharded(10),
        "shard_replicate": f"WITH x AS ({sharded(4)}), c AS (SELECT ds, line_no, shard FROM x UNION ALL SELECT ds, line_no, t.c::INT FROM x, range(1, 5) t(c) WHERE t.c > n_shards AND (t.c - n_shards - 1) % n_shards + 1 = shard) SELECT ds, shard, count(*) n, min(line_no) first_line FROM c GROUP BY ds, shard",
        "line_offsets": f'SELECT ds, line_no, coalesce(sum(strlen(coalesce(source_segment, \'\')) + 1) OVER (PARTITION BY ds ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM ({ONCE})',
        "multimeta": "SELECT line_no, string_agg(lang, ',' ORDER BY lang) langs FROM (SELECT lang, text, row_number() OVER (PARTITION BY lang ORDER BY doc_id) line_no FROM documents WHERE lang IS NOT NULL) WHERE trim(coalesce(text, '')) <> '' GROUP BY line_no",
        "catalog_discovery": discovery(),
        "stopword_table": "SELECT lang, string_agg(word, ' ' ORDER BY word) words FROM (SELECT DISTINCT lang, word FROM stopwords WHERE word <> '') GROUP BY lang",
        "pipe_docs": "SELECT doc_id, md5(text) digest FROM documents WHERE text IS NOT NULL",
        "clean_pipeline": f"SELECT ds, line_no FROM ({verdicts(fixed, 'ds, line_no, s, g')}) WHERE reason = 'keep' QUALIFY row_number() OVER (PARTITION BY s, g ORDER BY ds, line_no) = 1",
        "hourly_events": "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) n FROM events GROUP BY ALL",
    } | {f"sample_{m}": f"SELECT ds, round(prob, 9) prob FROM ({distribution(m)})" for m in ("original", "uniform", "temperature")} | {f"resample_mono_{m}": resampled_mono(m) for m in ("original", "uniform", "temperature")}
