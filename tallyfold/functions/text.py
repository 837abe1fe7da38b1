"""Text and code functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_skipping_null(*cols: Column) -> Column:
    return F.concat_ws("", *cols)


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def text_key(*parts: Column, separator: str = "-") -> Column:
    """Composite text key; NULL if a part is NULL."""
    null = F.lit(False)
    for p in parts:
        null |= p.isNull()
    return F.when(~null, F.concat_ws(separator, *[p.cast("string") for p in parts]))


def split_key(key: Column, n: int, separator: str = "-") -> list[Column]:
    """Parts of a composite text key, split from the right: the first part may hold the separator."""
    rest = [F.substring_index(key, separator, -i) for i in range(1, n)]
    lasts = [F.substring_index(r, separator, 1) for r in rest]
    head = F.substring(key, F.lit(1), F.char_length(key) - F.char_length(rest[-1]) - len(separator)) if rest else key
    return [head, *reversed(lasts)]


def code_label(code: Column, labels: dict, default: str | None = None) -> Column:
    out = None
    for k, v in labels.items():
        out = F.when(code == k, v) if out is None else out.when(code == k, v)
    return out.otherwise(default)


def status_ladder(*steps: tuple[Column, str], default: str) -> Column:
    """First condition that is true wins; an unknown condition does not."""
    out = F.when(steps[0][0], steps[0][1])
    for c, label in steps[1:]:
        out = out.when(c, label)
    return out.otherwise(default)


def not_deleted_strict(status: Column, mark: str = "X") -> Column:
    """``status <> 'X'``: a NULL status drops the row."""
    return status != mark


def not_deleted(status: Column, mark: str = "X") -> Column:
    """``status IS DISTINCT FROM 'X'``: a NULL status keeps the row."""
    return ~status.eqNullSafe(F.lit(mark))


def header_version(c: Column, word: str = "version") -> Column:
    """Version number after ``word:`` in a document header."""
    return F.nullif(F.regexp_extract(c, rf"(?i){word}:\s*([0-9]+)", 1), F.lit("")).try_cast("int")


def letter_prefix(c: Column) -> Column:
    return F.regexp_extract(c, "^[A-Z]+", 0)


def plausible_year(later: Column, built: Column) -> Column:
    """A renovation before the building year, or a zero year, is unknown."""
    year = F.nullif(later, F.lit(0))
    return F.when(year >= built, year)


def parse_array_literal(c: Column) -> Column:
    """``{a,"b, c",NULL}`` -> array of strings; NULL words become NULL."""
    body = F.substring(c, F.lit(2), F.char_length(c) - 2)
    items = F.regexp_extract_all(body, F.lit(r'\s*("(?:[^"\\]|\\.)*"|[^,]*)(?:,|$)'), F.lit(1))
    items = F.when(body == "", F.array().cast("array<string>")).otherwise(F.when(body.endswith(","), items).otherwise(F.slice(items, 1, F.greatest(F.size(items) - F.when(F.element_at(items, -1) == "", 1).otherwise(0), F.lit(0)))))
    bare = lambda x: F.when(x.startswith('"'), F.regexp_replace(F.substring(x, F.lit(2), F.char_length(x) - 2), r"\\(.)", "$1")).when(F.upper(x).isin("NULL", ""), None).otherwise(F.trim(x))
    return F.transform(items, bare)


def zip_components(keys: Column, values: Column) -> Column:
    """Map of parallel arrays; unequal lengths are an error."""
    return F.when(keys.isNull() | values.isNull(), None).when(F.size(keys) == F.size(values), F.map_from_arrays(keys, values)).otherwise(F.raise_error(F.lit("component arrays differ in length")).cast("map<string,string>"))
