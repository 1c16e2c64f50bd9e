"""Declared schemas and quality rules.  Plain data, no Spark session needed.

A contract file (YAML or JSON) has ``sources: [{source, system, format, refresh, ingestion, entities}]`` where an
entity lists ``name``, ``primary_key``, ``order_by``, ``columns`` and optionally ``pii`` and ``restricted``.
A rules file has ``rules: {"system.entity": [{rule, column, severity, ...}]}``.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql.types import StructType

IDENTIFIER = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")

# How old a source may be, in hours, by its declared refresh.
SLA_HOURS = {"daily": 26, "weekly": 192}


def check_identifier(name: str) -> str:
    """Names reach SQL text, so only plain identifiers are accepted."""
    if not IDENTIFIER.match(name):
        raise ValueError(f"not a plain identifier: {name!r}")
    return name


@dataclass(frozen=True)
class TableContract:
    """One table: declared column types, its key, and the column that says which version is newest."""

    name: str
    columns: dict[str, str]
    primary_key: tuple[str, ...]
    order_by: str
    system: str = "source"
    change_column: str | None = "_load_date"
    pii: tuple[str, ...] = ()
    restricted: tuple[str, ...] = ()

    def __post_init__(self):
        for identifier in (self.name, *self.columns):
            check_identifier(identifier)
        unknown = set(self.primary_key) - set(self.columns)
        if unknown:
            raise ValueError(f"{self.name}: key columns not declared: {sorted(unknown)}")

    @property
    def key(self) -> str:
        return f"{self.system}.{self.name}"

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in self.columns.items()))


@dataclass(frozen=True)
class SourceContract:
    """One source: where it lands, how often it refreshes and which tables it brings."""

    source: str
    system: str
    refresh: str = "daily"
    format: str = "csv"
    lands_in: str = "files"
    tables: tuple[TableContract, ...] = ()

    @property
    def sla_hours(self) -> int:
        return SLA_HOURS[self.refresh]


@dataclass(frozen=True)
class Rule:
    """One quality rule.  ``error`` sets the row aside, ``warn`` only counts it."""

    rule: str
    severity: str = "error"
    column: str | None = None
    values: tuple[Any, ...] = ()
    pattern: str | None = None
    allow_null: bool = False
    min: Any = None
    max: Any = None
    check: str | None = None
    ref_entity: str | None = None
    ref_column: str | None = None

    KINDS = ("not_null", "regex", "accepted_values", "range", "not_future", "expression", "foreign_key")

    def __post_init__(self):
        if self.rule not in self.KINDS:
            raise ValueError(f"unknown rule {self.rule!r}")
        if self.severity not in ("error", "warn"):
            raise ValueError(f"unknown severity {self.severity!r}")

    @property
    def label(self) -> str:
        """Name of the rule in a quarantine record."""
        return f"{self.rule}:{self.column}"


@dataclass(frozen=True)
class Contracts:
    sources: tuple[SourceContract, ...] = ()
    rules: dict[str, tuple[Rule, ...]] = field(default_factory=dict)

    def tables(self) -> dict[str, TableContract]:
        return {t.key: t for s in self.sources for t in s.tables}


def _load(path: str) -> dict:
    text = Path(path).read_text(encoding="utf-8")
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as missing:  # pragma: no cover - depends on the installation
            raise RuntimeError("YAML contracts need PyYAML; use JSON instead") from missing
        return yaml.safe_load(text)
    return json.loads(text)


def _as_list(value) -> tuple[str, ...]:
    if value is None:
        return ()
    return (value,) if isinstance(value, str) else tuple(value)


def parse_sources(document: dict) -> tuple[SourceContract, ...]:
    out = []
    for src in document["sources"]:
        system = src.get("system") or src["source"]
        ingestion = src.get("ingestion") or {}
        tables = tuple(
            TableContract(
                name=ent["name"],
                columns=dict(ent["columns"]),
                primary_key=_as_list(ent["primary_key"]),
                order_by=ent["order_by"],
                system=system,
                change_column=ingestion.get("change_column", "_load_date"),
                pii=_as_list(ent.get("pii")),
                restricted=_as_list(ent.get("restricted")),
            )
            for ent in src.get("entities", [])
        )
        out.append(SourceContract(src["source"], system, src.get("refresh", "daily"), src.get("format", "csv"),
                                  ingestion.get("lands_in", "files"), tables))
    return tuple(out)


def parse_rules(document: dict) -> dict[str, tuple[Rule, ...]]:
    def one(raw: dict) -> Rule:
        fields = dict(raw)
        fields["values"] = tuple(fields.get("values", ()))
        return Rule(**fields)

    return {entity: tuple(one(r) for r in rules) for entity, rules in (document.get("rules") or {}).items()}


def load_contracts(sources_path: str, rules_path: str | None = None) -> Contracts:
    rules = parse_rules(_load(rules_path)) if rules_path else {}
    return Contracts(parse_sources(_load(sources_path)), rules)
