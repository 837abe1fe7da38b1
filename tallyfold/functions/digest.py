"""Digests of rows and identifiers that reruns reproduce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def payload_digest(*columns: str) -> Column:
    """SHA-256 of a row: every field as its type, its length and its text, so NULLs and types are told apart and
    no value can shift into its neighbour."""

    def part(c: str) -> Column:
        value = F.col(c).cast("string")
        return F.coalesce(F.concat(F.typeof(F.col(c)), F.lit(":"), F.char_length(value).cast("string"), F.lit(":"), value), F.lit("null"))

    return F.sha2(F.concat_ws(";", *[part(c) for c in columns]).cast("binary"), 256)


def row_digest(*columns: str) -> Column:
    """SHA-256 of the JSON of a row; NULL fields count."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).cast("binary"), 256)


def stable_uuid(namespace: str, name: Column) -> Column:
    """A version-5 shaped UUID from SHA-1 of a namespace and a name."""
    h = F.sha1(F.concat(F.lit(namespace), F.lit(":"), name).cast("binary"))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat(F.substring(h, 1, 8), F.lit("-"), F.substring(h, 9, 4), F.lit("-5"), F.substring(h, 14, 3), F.lit("-"), variant, F.substring(h, 18, 3), F.lit("-"), F.substring(h, 21, 12))
