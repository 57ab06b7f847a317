"""DuckDB SQL fragments mirroring ``functions/text.py`` for the oracle queries."""

from __future__ import annotations

from ..functions.text import UNIT_REWRITES, WORD_TOKEN, WS, accent_table, spark_stop_words


def fill(c: str) -> str:
    return f"coalesce(cast({c} as varchar), '')"


def normalize(c: str) -> str:
    return f"trim(regexp_replace(lower({fill(c)}), '{WS}+', ' ', 'g'))"


def unit_normalize(c: str) -> str:
    out = c
    for pat, rep in UNIT_REWRITES:
        out = f"regexp_replace({out}, '\\b{pat}\\b', '{rep}', 'g')"
    return out


def preprocess(c: str) -> str:
    return f"trim(regexp_replace({unit_normalize(f'lower({fill(c)})')}, '{WS}+', ' ', 'g'))"


def strip_accents(c: str) -> str:
    src, dst = accent_table()
    return f"regexp_replace(translate({c}, '{src}', '{dst}'), '[\\x{{300}}-\\x{{36F}}]', '', 'g')"


def analyzer_text(c: str) -> str:
    return strip_accents(f"lower({fill(c)})")


def word_tokens(c: str) -> str:
    return f"regexp_extract_all({c}, '{WORD_TOKEN}')"


def stop_list() -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in spark_stop_words()) + "]"


def remove_stop_words(tokens: str) -> str:
    return f"list_filter({tokens}, lambda t: not list_contains({stop_list()}, t))"


def words(c: str) -> str:
    return f"list_filter(regexp_split_to_array({c}, '{WS}+'), lambda x: x <> '')"


def _ratio(num: str, t: str) -> str:
    return f"case when length({t}) = 0 then 0.0e0 else ({num})::double / length({t}) end"


def char_count(c: str) -> str:
    return f"length({fill(c)})::double"


def word_count(c: str) -> str:
    return f"len({words(fill(c))})::double"


def unique_char_ratio(c: str) -> str:
    t = fill(c)
    return _ratio(f"len(list_distinct(string_split({t}, '')))", t)


def punct_ratio(c: str) -> str:
    t = fill(c)
    return _ratio(f"length(regexp_replace({t}, '[\\p{{L}}\\p{{N}}]', '', 'g'))", t)


def digit_ratio(c: str) -> str:
    t = fill(c)
    return _ratio(f"length({t}) - length(regexp_replace({t}, '\\p{{Nd}}', '', 'g'))", t)


def sentence_count(c: str) -> str:
    return f"len(list_filter(regexp_split_to_array({fill(c)}, '[.!?]+'), lambda x: trim(x) <> ''))"


def text_stats(c: str) -> str:
    return ", ".join([
        f"{char_count(c)} char_count",
        f"{word_count(c)} word_count",
        f"{unique_char_ratio(c)} unique_char_ratio",
        f"{punct_ratio(c)} punct_ratio",
        f"{digit_ratio(c)} digit_ratio",
    ])


def smape(p: str, y: str) -> str:
    return (f"100.0e0 * avg(case when abs({y}) + abs({p}) = 0 then 0.0e0 "
            f"else 2.0e0 * abs({p} - {y}) / (abs({y}) + abs({p})) end)")


def smape_drop_zero(p: str, y: str) -> str:
    return (f"coalesce(100.0e0 * avg(case when {y} <> 0 or {p} <> 0 then "
            f"abs({y} - {p}) / greatest((abs({y}) + abs({p})) / 2.0e0, 1e-8) end), 0.0e0)")


def fold(key: str, k: int = 5, seed: int | None = 42) -> str:
    s = f"cast({key} as varchar)" if seed is None else f"'{seed}:' || cast({key} as varchar)"
    return f"(('0x' || substr(md5({s}), 1, 8))::bigint % {k})::int"


def uniform01(key: str) -> str:
    return f"('0x' || substr(md5(cast({key} as varchar)), 1, 8))::bigint::double / 4294967296e0"


def balanced_fold(key: str, k: int, seed: int) -> str:
    """Rank by the seeded hash of the id, dealt out in turn, over the selected rows."""
    return (f"((row_number() over (order by ('0x'||substr(md5('{seed}:' || {key}),1,8))::bigint, {key}) - 1) % {k})::int")
