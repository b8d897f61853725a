"""SQL fragments over texts; words are longest runs without space, tab, \\n, \\v, \\f, \\r."""

from __future__ import annotations

_BLANK = r"[\\x20\\x09-\\x0D]+"
_ENDS = r"\t\n\u000B\u000C\r "


def words(text: str) -> str:
    """The words of a text in order; none for a null."""
    inner = f"trim(BOTH '{_ENDS}' FROM {text})"
    return f"CASE WHEN {inner} <> '' THEN split({inner}, '{_BLANK}') ELSE CAST(array() AS array<string>) END"


def normalised_lines(text: str) -> str:
    """The lines that have a word: lower case, single spaces, no blanks at the ends."""
    flat = rf"lower(regexp_replace({text}, '[\\x20\\x09\\x0B-\\x0D]+', ' '))"
    return f"filter(transform(split({flat}, '\\n'), l -> trim(l)), l -> l <> '')"


def let(value: str, name: str, body: str) -> str:
    """``body`` with ``value``, computed once, under ``name``."""
    return f"transform(array({value}), {name} -> {body})[0]"
