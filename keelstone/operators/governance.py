"""Scopes, clearances and roles: what may be written where, and who may read it."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..errors import AccessError, BoundaryError

#: Scopes, the namespaces of their topics and event types, and their internal labels.
PREFIXES = {
    "platform": ("ports.", "ferries.", "vessels.", "stamps."),
    "cvff": ("cvff.",),
    "seafarer": ("seafarer.",),
    "fisheries": ("fisheries.", "coldchain.", "export."),
    "isr": ("maritime.isr.", "maritime.behaviour.", "maritime.outcome."),
    "mrv": ("mrv.",),
    "bluecarbon": ("bluecarbon.",),
}
LABELS = {
    "platform": ("public", "internal", "confidential", "restricted", "highly_restricted"),
    "cvff": ("fiduciary_segregated",),
    "seafarer": ("seafarer_confidential",),
    "fisheries": ("fisheries_operational",),
    "isr": ("isr_classified",),
    "mrv": ("mrv_confidential",),
    "bluecarbon": ("bluecarbon_internal",),
}
#: Clearances from low to high, and the least one for each scope's layers.
CLEARANCES = ("UNCLASSIFIED", "RESTRICTED", "CONFIDENTIAL", "SECRET")
LAYERS = ("bronze", "silver", "gold")
FLOORS = {
    "platform": ("UNCLASSIFIED", "UNCLASSIFIED", "UNCLASSIFIED"),
    "cvff": ("UNCLASSIFIED", "UNCLASSIFIED", "UNCLASSIFIED"),
    "seafarer": ("CONFIDENTIAL", "CONFIDENTIAL", "CONFIDENTIAL"),
    "fisheries": ("RESTRICTED", "RESTRICTED", "RESTRICTED"),
    "isr": ("SECRET", "SECRET", "CONFIDENTIAL"),
    "mrv": ("CONFIDENTIAL", "CONFIDENTIAL", "CONFIDENTIAL"),
    "bluecarbon": ("CONFIDENTIAL", "CONFIDENTIAL", "UNCLASSIFIED"),
}

#: The floor of each schema ("scope_layer").
SCHEMAS = {f"{scope}_{layer}": floor for scope, floors in FLOORS.items() for layer, floor in zip(LAYERS, floors, strict=True)}


def _first(cases: list[tuple[Column, str]]) -> Column:
    return F.coalesce(*[F.when(c, F.lit(v)) for c, v in cases])


def scope_of(name: Column, prefixes: dict[str, tuple[str, ...]] = PREFIXES) -> Column:
    """The scope of a topic or event type by its namespace, else null."""
    return _first([(name.startswith(p), scope) for scope, ps in prefixes.items() for p in ps])


def scope_of_label(label: Column) -> Column:
    return _first([(label.isin(*labels), scope) for scope, labels in LABELS.items()])


def internal_label(classification: Column, event_type: Column) -> Column:
    """The label inside the scope that an envelope's classification becomes; null where the two don't go together."""
    scope = F.coalesce(scope_of(event_type), F.lit("platform"))
    fiduciary = classification == "FIDUCIARY_SEGREGATED"
    own = _first([(scope == s, labels[0]) for s, labels in LABELS.items() if s not in ("platform", "cvff")])
    plain = F.when(classification.isin("PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"), F.lower(classification))
    return F.when(fiduciary, F.when(scope == "cvff", F.lit("fiduciary_segregated"))).when(scope != "cvff", F.when(plain.isNotNull(), F.coalesce(own, plain)))


def rank(label: Column) -> Column:
    """0 to 3, null for an unknown label; capitals don't matter."""
    return F.array_position(F.lit(list(CLEARANCES)), F.upper(label)) - 1 + F.when(F.upper(label).isin(*CLEARANCES), 0)


def visible(rows: DataFrame, clearance: str, label_col: str = "record_classification") -> DataFrame:
    """The rows that a reader of this clearance may see; unlabelled rows and unknown labels are withheld."""
    return rows.where(rank(F.col(label_col)) <= clearance_level(clearance))


def clearance_level(label: str) -> int:
    if not isinstance(label, str) or label.upper() not in CLEARANCES:
        raise AccessError(f"not a clearance: {label!r}")
    return CLEARANCES.index(label.upper())


@dataclass(frozen=True)
class Scope:
    """A scope under a root: its layers' tables, and checks that nothing leaves it."""

    name: str
    root: str

    def __post_init__(self):
        if self.name not in PREFIXES:
            raise BoundaryError(f"no such scope: {self.name}")
        declared = declared_scopes(self.root)
        if declared - {self.name}:
            raise BoundaryError(f"{self.root} belongs to {sorted(declared)}")

    def table(self, layer: str, name: str = "events") -> str:
        if layer not in LAYERS or not re.fullmatch(r"[a-z][a-z0-9_]*", name):
            raise BoundaryError(f"no such table: {layer}/{name}")
        return f"{self.root.rstrip('/')}/{self.name}_{layer}/{name}"

    def check(self, events: DataFrame, topic: str | None = None) -> DataFrame:
        """One pass over a batch: not empty, and every label and the topic within the scope; isr rows have to carry a clearance."""
        if topic is not None and not topic.startswith(PREFIXES[self.name]):
            raise BoundaryError(f"topic {topic} is outside {self.name}")
        found = events.groupBy(scope_of_label(F.col("data_classification")).alias("s")).agg(F.count(F.lit(1)).alias("n"), F.count_if(rank(F.col("record_classification")).isNull()).alias("bare")).collect()
        if not found or {r.s for r in found} != {self.name}:
            raise BoundaryError(f"a batch for {self.name} holds {sorted(str(r.s) for r in found)}")
        if self.name == "isr" and found[0].bare:
            raise BoundaryError(f"{found[0].bare} isr rows carry no clearance")
        return events


def declared_scopes(uri: str) -> set[str]:
    """The scopes that a path's components name."""
    return {s for s in PREFIXES for part in uri.split("/") if re.match(rf"{s}($|[_-])", part)}


@dataclass(frozen=True)
class Policy:
    """Which layers ("scope_layer") each role may read. Roles are a deployment's own, and they only read."""

    grants: dict[str, frozenset[str]] = field(default_factory=dict)

    def known(self, roles: list[str]) -> set[str]:
        """The roles claimed; refused if there is none, or one isn't named exactly as granted."""
        odd = [r for r in roles if not isinstance(r, str) or r not in self.grants]
        if odd or not roles:
            raise AccessError(f"unknown roles: {odd}")
        return set(roles)

    def readable(self, roles: list[str]) -> frozenset[str]:
        """The schemas that any of the roles may read, given the clearance."""
        return reduce(frozenset.union, (self.grants[r] for r in self.known(roles)))

    def authorize(self, roles: list[str], schema: str, clearance: str | None = None) -> None:
        """Refused unless a role may read the schema and the clearance reaches its floor; the lowest floor asks for none."""
        if schema not in SCHEMAS:
            raise AccessError(f"no such schema: {schema}")
        if schema not in self.readable(roles):
            raise AccessError(f"{sorted(set(roles))} may not read {schema}")
        level = 0 if clearance is None else clearance_level(clearance)
        if level < clearance_level(SCHEMAS[schema]):
            raise AccessError(f"{clearance} is below the floor of {schema}")

    def authorize_write(self, roles: list[str], schema: str) -> None:
        """Always refused: writing is for the jobs of a scope, through `Scope`."""
        raise AccessError(f"{sorted(self.known(roles))} only read; {schema} isn't written by them")

    def read(self, table, roles: list[str], schema: str, clearance: str | None = None) -> DataFrame:
        """The rows of a table that the reader may see, without a clearance the unclassified ones; refused before anything is read."""
        self.authorize(roles, schema, clearance)
        rows = table.read()
        return visible(rows, clearance or CLEARANCES[0]) if "record_classification" in rows.columns else rows


def whole_scope(name: str, *layers: str) -> frozenset[str]:
    return frozenset(f"{name}_{layer}" for layer in layers or LAYERS)
