"""Geometry as text: type prefixes, promotion to multi types, repair of joined polygons, bounds.

Topology (validity, unions, reprojection) needs a geometry library and is not offered.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_NUMBER = r"[-+]?[0-9]*\.?[0-9]+(?:[eE][-+]?[0-9]+)?"


def geometry_type(wkt: Column) -> Column:
    return F.upper(F.nullif(F.regexp_extract(wkt, r"(?i)^\s*(?:SRID=\d+;)?([A-Z]+)", 1), F.lit("")))


def to_multipolygon(wkt: Column) -> Column:
    """POLYGON becomes MULTIPOLYGON; everything else stays."""
    body = F.regexp_replace(wkt, r"(?i)^\s*POLYGON\s*", "")
    return F.when(geometry_type(wkt) == "POLYGON", F.concat(F.lit("MULTIPOLYGON ("), body, F.lit(")"))).otherwise(wkt)


def join_polygons(wkt: Column) -> Column:
    """Several POLYGON texts in one string become one MULTIPOLYGON."""
    parts = F.regexp_extract_all(wkt, F.lit(r"(?is)POLYGON\s*(\(\(.*?\)\s*\))"), F.lit(1))
    return F.when((geometry_type(wkt) == "POLYGON") & (F.size(parts) > 1), F.concat(F.lit("MULTIPOLYGON ("), F.array_join(parts, ", "), F.lit(")"))).otherwise(wkt)


def coordinates(wkt: Column) -> Column:
    """All numbers of a 2-D geometry text in order."""
    return F.transform(F.regexp_extract_all(wkt, F.lit(f"({_NUMBER})"), F.lit(1)), lambda x: x.try_cast("double"))


def bounds(wkt: Column) -> Column:
    """``xmin ymin xmax ymax`` of a 2-D geometry text, NULL if it has no coordinates."""
    c = coordinates(F.regexp_replace(wkt, r"(?i)SRID=\d+;", ""))
    xs = F.filter(c, lambda x, i: i % 2 == 0)
    ys = F.filter(c, lambda x, i: i % 2 == 1)
    return F.when(F.size(c) >= 2, F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax")))


def is_box(wkt: Column) -> Column:
    """Whether a text is one polygon of four corners, closed, with sides along both axes: it fills its bounds."""
    c = coordinates(F.regexp_replace(wkt, r"(?i)SRID=\d+;", ""))
    same = lambda *pairs: F.forall(F.array(*[c[i] == c[j] for i, j in pairs]), lambda x: x)
    closed = same((0, 8), (1, 9))
    turns = same((1, 3), (2, 4), (5, 7), (6, 0)) | same((0, 2), (3, 5), (4, 6), (7, 1))
    ring = wkt.rlike(r"(?i)^\s*(?:SRID=\d+;)?\s*POLYGON\s*\(\s*\([^(),]+(?:,[^(),]+){4}\)\s*\)\s*$")
    return F.when(ring & (F.size(c) == 10), F.coalesce(closed & turns, F.lit(False))).otherwise(F.lit(False))


def finite(wkt: Column) -> Column:
    """Whether a text has coordinates and all of them are finite numbers."""
    c = coordinates(wkt)
    inf = float("inf")
    return (F.size(c) >= 2) & F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & ~wkt.rlike(r"(?i)\b(nan|inf)")


def point_square(x: Column, y: Column, side: float = 0.05) -> Column:
    """A square polygon around a point."""
    h = side / 2
    at = lambda a, b: F.concat(F.round(x + a, 3).cast("decimal(18,3)").cast("string"), F.lit(" "), F.round(y + b, 3).cast("decimal(18,3)").cast("string"))
    ring = F.concat_ws(", ", at(-h, -h), at(h, -h), at(h, h), at(-h, h), at(-h, -h))
    return F.concat(F.lit("POLYGON (("), ring, F.lit("))"))


def quarantine(df, wkt: str, types: tuple[str, ...]):
    """(valid rows, rows whose geometry is missing, of another type or not finite)."""
    good = F.coalesce(geometry_type(F.col(wkt)).isin(*types) & finite(F.col(wkt)), F.lit(False))
    return df.where(good), df.where(~good)
