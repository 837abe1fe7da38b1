"""Guards for texts that become SQL."""

from __future__ import annotations

import re

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_$]*")
_QUOTED = re.compile(r"'(?:[^']|'')*'|\"(?:[^\"]|\"\")*\"|--[^\n]*|/\*.*?\*/", re.S)


def identifier(name: str) -> str:
    """A plain identifier; anything else is an error."""
    if not _NAME.fullmatch(name):
        raise ValueError(f"not an identifier: {name!r}")
    return name


def single_select(sql: str) -> str:
    """One SELECT or WITH statement without its closing semicolons."""
    text = sql.strip()
    while text.endswith(";"):
        text = text[:-1].rstrip()
    bare = _QUOTED.sub(" ", text)
    if ";" in bare:
        raise ValueError("more than one statement")
    if not re.match(r"(?i)\s*(select|with)\b", bare):
        raise ValueError("not a SELECT or WITH")
    return text


def user_filter(text: str | None) -> str | None:
    """A filter typed by a user: WHERE and semicolons go, 'null' and 'true' mean none, subqueries are errors."""
    if text is None:
        return None
    t = re.sub(r"(?i)^\s*where\b", "", text.strip().rstrip(";")).strip()
    if t.lower() in ("", "null", "true"):
        return None
    bare = _QUOTED.sub(" ", t)
    if ";" in bare or re.search(r"(?i)\b(select|insert|update|delete|drop|merge|with)\b", bare):
        raise ValueError("a filter is one condition without subqueries")
    return t
