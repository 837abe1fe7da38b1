"""Contracts of tables, definitions and runs, checked on the driver before any job starts."""

from __future__ import annotations

import hashlib
import json
from dataclasses import asdict, dataclass

from pyspark.sql.types import StructType

from ..operators.quality import schema_drift
from ..sources.guards import identifier

MANAGED = ("id", "created_at", "created_by", "updated_at", "updated_by")


@dataclass(frozen=True)
class TableSpec:
    """What is loaded where: one membership key, ordered page keys, an optional change column."""

    name: str
    target: str
    membership_key: str
    page_keys: tuple[str, ...]
    changed: str | None = None

    def __post_init__(self) -> None:
        for c in (self.membership_key, *self.page_keys, *([self.changed] if self.changed else [])):
            identifier(c)
        if not self.page_keys or len(set(self.page_keys)) != len(self.page_keys):
            raise ValueError("page keys must be given, each once")

    def check(self, source: StructType, target: StructType) -> list[str]:
        """Columns to write: source and target agree but for managed and page columns."""
        have, want = source.fieldNames(), [c for c in target.fieldNames() if c not in MANAGED]
        if len(set(have)) != len(have):
            raise ValueError("repeated source column")
        missing = [c for c in want if c not in have]
        extra = [c for c in have if c not in want and c not in self.page_keys]
        if missing or extra:
            raise ValueError(f"missing {missing}, extra {extra}")
        return want


@dataclass(frozen=True)
class FieldMapping:
    source: str
    target: str
    kind: str
    is_key: bool = False
    is_changed: bool = False


@dataclass(frozen=True)
class Definition:
    """A mapping of fields: exactly one key and one change time, at most one geometry."""

    name: str
    fields: tuple[FieldMapping, ...]

    def __post_init__(self) -> None:
        for what in ("source", "target"):
            names = [getattr(f, what) for f in self.fields]
            if len(set(names)) != len(names):
                raise ValueError(f"repeated {what} field")
        for what, n in (("key", sum(f.is_key for f in self.fields)), ("change time", sum(f.is_changed for f in self.fields))):
            if n != 1:
                raise ValueError(f"{n} {what} mappings; exactly one is needed")
        if sum(f.kind == "geometry" for f in self.fields) > 1:
            raise ValueError("more than one geometry")

    @property
    def key(self) -> FieldMapping:
        return next(f for f in self.fields if f.is_key)

    @property
    def changed(self) -> FieldMapping:
        return next(f for f in self.fields if f.is_changed)

    def rename(self, df):
        return df.select(*[df[f.source].alias(f.target) for f in self.fields])


@dataclass(frozen=True)
class RunIdentity:
    """What a resumed run must share with the one it resumes."""

    integration: str
    source: str
    target: str
    schema_json: str

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True).encode()).hexdigest()


def schema_fingerprint(schema: StructType) -> str:
    return hashlib.sha256(json.dumps(json.loads(schema.json()), sort_keys=True).encode()).hexdigest()


def require_same_schema(left: StructType, right: StructType) -> None:
    if drift := schema_drift(left, right):
        raise ValueError(f"schemas differ: {drift}")


def single_watermark(mappings: list[dict]) -> dict:
    """Exactly one watermark mapping, and it is the UTC one."""
    marks = [m for m in mappings if m.get("is_watermark")]
    if len(marks) != 1 or not marks[0].get("utc"):
        raise ValueError("exactly one watermark mapping, in UTC, is needed")
    return marks[0]
