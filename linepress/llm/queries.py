"""The queries of this subpackage and, where SQL can say the same over whole tables, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from linepress.functions.text import char_class
from linepress.llm import copies, encodings, languages, lookalikes, mixing, personal, residue, tokens

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "p1_found": copies.found,
        "p1_distinct": copies.distinct_records,
        "p2_found": languages.found,
        "p2_languages": languages.identified,
        "p3_found": encodings.found,
        "p3_restored": encodings.restored,
        "p4_found": personal.found,
        "p4_replaced": personal.replaced,
        "p5_found": lookalikes.found,
        "p5_canonical": lookalikes.canonical,
        "p5_classes": lookalikes.classes,
        "p6_ids": tokens.ids,
        "p7_mix": mixing.mixture,
        "p7_shares": mixing.shares,
        "p8_found": residue.found,
        "p8_labels": residue.labels,
        "p8_kept": residue.kept,
    }


def _folded() -> str:
    """The canonical key in DuckDB: letters, marks and digits only, lower then upper case; its upper() is a simple mapping, so letters whose capital is several are written out."""
    x = "lower(replace(coalesce({}, ''), 'ı', 'ꟷ'))"
    for a, b in {"ß": "ss", "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "ŉ": "ʼn"}.items():
        x = f"replace({x}, '{a}', '{b}')"
    return rf"upper(regexp_replace({x}, '[^\p{{{{L}}}}\p{{{{M}}}}\p{{{{N}}}}]+', '', 'g'))"


_KEY = _folded()


def _written(x: str) -> str:
    """Compatibility characters of several letters written out."""
    table = "MAP {" + ", ".join(f"'{c}': '" + t.replace("'", "''") + "'" for c, t in lookalikes.written_out().items()) + "}"
    return f"CASE WHEN regexp_matches({x}, '{char_class(lookalikes.written_out())}') THEN array_to_string(list_transform(string_split({x}, ''), lambda c: coalesce({table}[c], c)), '') ELSE {x} END"


def _normal(x: str) -> str:
    """Width and compatibility forms, blanks and accents in their usual form, in DuckDB."""
    source, target = (t.replace("'", "''") for t in lookalikes._own_script())
    return f"nfc_normalize(translate({_written(x)}, '{source}', '{target}'))"


def _look(x: str) -> str:
    """Look-alikes mapped and accents composed, in DuckDB: equal where the collation finds equal."""
    quoted = lambda t: "'" + t.replace("'", "''") + "'"
    x = _written(f"coalesce({x}, '')")
    source, target = lookalikes.mapping()
    nul = source.index("\0")
    source, target = source[:nul] + source[nul + 1 :], target[:nul] + target[nul + 1 :]
    return f"nfc_normalize(translate({x}, {quoted(source)}, {quoted(target)}))"


def oracle_sql() -> dict[str, str]:
    keyed = f"SELECT pair_id, {_KEY.format('source_segment')} a, {_KEY.format('target_segment')} b FROM bifixer"
    grouped = f"SELECT pair_id, min(pair_id) OVER (PARTITION BY least(a, b), greatest(a, b)) f, count(*) OVER (PARTITION BY least(a, b), greatest(a, b)) n FROM ({keyed}) WHERE regexp_matches(a || b, '[\\p{{L}}\\p{{N}}]')"
    looks = f"SELECT pair_id, coalesce(source_segment, '') s, coalesce(target_segment, '') t, {_look('source_segment')} a, {_look('target_segment')} b FROM bifixer"
    linked = f"SELECT l.pair_id, (SELECT min(pair_id) FROM x r WHERE r.a = l.a AND r.b = l.b) first_pair_id, (SELECT count(*) FROM x r WHERE r.a = l.a AND r.b = l.b AND (r.s <> l.s OR r.t <> l.t)) n_links FROM x l"
    return {
        "p5_canonical": f"WITH x AS ({looks}), y AS (SELECT pair_id, first_value(s) OVER w c, first_value(t) OVER w d FROM x WINDOW w AS (PARTITION BY a, b ORDER BY s, t)) SELECT pair_id, {_normal('c')} canon_src, {_normal('d')} canon_tgt FROM y",
        "p5_classes": f"WITH x AS ({looks}) SELECT * FROM ({linked}) WHERE n_links > 0",
        "p5_found": f"WITH x AS ({looks}) SELECT l.pair_id pair_id_a, r.pair_id pair_id_b FROM x l JOIN x r ON l.a = r.a AND l.b = r.b AND l.pair_id < r.pair_id AND (l.s <> r.s OR l.t <> r.t)",
        "p1_found": f"SELECT f AS first_pair_id, pair_id AS copy_pair_id FROM ({grouped}) WHERE pair_id <> f",
        "p1_distinct": f"SELECT f AS first_pair_id, n AS n_copies FROM ({grouped}) WHERE pair_id = f",
    }
