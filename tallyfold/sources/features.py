"""A remote feature layer, staged as files: inventories as CSV, pages as GeoJSON, counts as XML.

Pages are files, so ties across page boundaries and repeated rows vanish by set semantics; a live
service can be read through Spark's Python Data Source API with :class:`PagedFeatures`.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from ..operators.quality import collapse_identical
from .guards import identifier


@dataclass(frozen=True)
class LayerSpec:
    """Fields of a layer by kind."""

    name: str
    integers: tuple[str, ...] = ()
    dates: tuple[str, ...] = ()
    texts: tuple[str, ...] = ()
    geometry: str = "MULTIPOLYGON"
    id_field: str = "feature_id"
    extra: dict = field(default_factory=dict, hash=False)

    @property
    def schema(self) -> StructType:
        fields = [StructField(self.id_field, StringType(), False)]
        fields += [StructField(c, LongType()) for c in self.integers] + [StructField(c, TimestampType()) for c in self.dates] + [StructField(c, StringType()) for c in self.texts]
        return StructType(fields + [StructField("geom_wkt", StringType())])

    def fingerprint(self) -> str:
        body = {"dates": sorted(self.dates), "geometry": self.geometry, "integers": sorted(self.integers), "name": self.name, "texts": sorted(self.texts)}
        return hashlib.sha256(json.dumps(body, sort_keys=True).encode()).hexdigest()


def inventory_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A geometry-free inventory; a row that does not fit the schema is an error."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def geojson_pages(spark: SparkSession, path: str, layer: LayerSpec) -> DataFrame:
    """Features of GeoJSON pages with the layer's columns, repeated ones collapsed, conflicting ones refused."""
    props = ", ".join(f"`{c}`: string" for c in (*layer.integers, *layer.dates, *layer.texts))
    raw = spark.read.schema(f"features array<struct<id: string, properties: struct<{props}>, geometry: struct<type: string, coordinates: string>>>").option("multiLine", True).json(path)
    f = raw.select(F.explode("features").alias("f"))
    cols = [F.col("f.id").alias(layer.id_field), *[F.col(f"f.properties.{c}").cast("bigint").alias(c) for c in layer.integers], *[F.to_timestamp(F.col(f"f.properties.{c}")).alias(c) for c in layer.dates], *[F.col(f"f.properties.{c}").alias(c) for c in layer.texts]]
    return collapse_identical(f.select(*cols, F.col("f.geometry.type").alias("geom_type"), F.col("f.geometry.coordinates").alias("geom_coordinates")), [layer.id_field])


def matched_count(xml: DataFrame, column: str = "value") -> DataFrame:
    """The service's ``numberMatched`` of a hits response."""
    return xml.select(F.expr(f"xpath_string({column}, '/*/@numberMatched')").try_cast("bigint").alias("matched"))


def element_names(xml: DataFrame, column: str = "value") -> DataFrame:
    """Element names that a schema response declares, in order."""
    names = F.expr(f"xpath({column}, '//*[local-name()=\"sequence\"]/*[local-name()=\"element\"]/@name')")
    return xml.select(F.posexplode(names).alias("position", "name"))


def assert_exact_ids(wanted: DataFrame, got: DataFrame, key: str) -> None:
    """Exactly the wanted ids came, each once."""
    w, g = wanted.select(key).distinct(), got.groupBy(key).count()
    odd = w.join(g, key, "full").where(F.col("count").isNull() | (F.col("count") > 1))
    if not odd.isEmpty() or not g.join(w, key, "left_anti").isEmpty():
        raise ValueError("features do not match the wanted ids")


def xml_rows(xml: DataFrame, element: str, schema: str, column: str = "value") -> DataFrame:
    """An XML text column as a table: one row per ``element`` below the root, with columns of a declared schema (children
    by name, attributes with an underscore in front); what is not there is NULL."""
    carry = [c for c in xml.columns if c != column]
    parsed = F.from_xml(F.col(column), f"`{element}` array<struct<{schema}>>")
    return xml.select(*carry, F.inline(parsed[element]))


class _Span(InputPartition):
    """A range of keys: ``low`` exclusive, ``high`` inclusive, None without an end; ``nulls`` for the rows without a key."""

    def __init__(self, number: int, low, high, nulls: bool = False):
        super().__init__(number)
        self.low, self.high, self.nulls = low, high, nulls


class PagedFeatures(DataSource):
    """``spark.read.format("paged_features")``: a layer behind a paged service.

    Options: ``schema``; ``fetch``, a callable ``module:function`` that takes ``(low, high, nulls)`` and returns rows of that
    range of keys (``low`` exclusive, ``high`` inclusive); ``bounds``, a JSON list of keys at which to cut; ``counts``, a JSON
    list of how many rows the service announces for the group without a key and for each range.  Rows without a key come
    first, as a group of their own; cuts are keys, so rows that share one are never torn apart; a group that is not as
    large as announced is an error.
    """

    @classmethod
    def name(cls) -> str:
        return "paged_features"

    def schema(self) -> str:
        return self.options["schema"]

    def reader(self, schema: StructType) -> DataSourceReader:
        return _PagedReader(self.options)


class _PagedReader(DataSourceReader):
    def __init__(self, options: dict):
        self.fetch, self.bounds = options["fetch"], json.loads(options.get("bounds", "[]"))
        self.counts = json.loads(options["counts"]) if "counts" in options else None

    def partitions(self) -> list[InputPartition]:
        ends = [None, *self.bounds, None]
        return [_Span(0, None, None, True), *[_Span(i + 1, a, z) for i, (a, z) in enumerate(zip(ends, ends[1:], strict=False))]]

    def read(self, partition: _Span):
        import importlib

        module, _, function = self.fetch.partition(":")
        rows = list(getattr(importlib.import_module(module), function)(partition.low, partition.high, partition.nulls))
        if self.counts is not None and len(rows) != self.counts[partition.value]:
            raise ValueError(f"group {partition.value}: {len(rows)} rows, {self.counts[partition.value]} announced")
        yield from rows


def geopackage(spark: SparkSession, path: str, table: str, schema: str, rows: int = 10_000) -> DataFrame:
    """A table of GeoPackage (SQLite) files with its geometry as binary; ``functions.wkb`` reads that.

    Files come through Spark, so any store will do; one task a file, which holds the file's bytes (a file is at most what
    Spark reads as one binary value) and hands rows on in chunks.
    """
    from pyspark.sql.types import _parse_datatype_string

    identifier(table)
    names = [f.name for f in _parse_datatype_string(schema).fields]
    for c in names:
        identifier(c)
    wanted = ", ".join(f'"{c}"' for c in names)

    def run(batches):
        import sqlite3

        import pyarrow as pa

        for batch in batches:
            for data in batch.column(0).to_pylist():
                with sqlite3.connect(":memory:") as db:
                    db.deserialize(data)
                    found = db.execute(f'SELECT {wanted} FROM "{table}" ORDER BY rowid')
                    while chunk := found.fetchmany(rows):
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in chunk], t) for i, t in enumerate(kinds)], names)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = [to_arrow_type(f.dataType) for f in _parse_datatype_string(schema).fields]
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(run, schema)
