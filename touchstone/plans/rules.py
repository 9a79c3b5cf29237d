"""What a rule pack is made of.

A pack lists rule metadata, entities and foreign-key links.  An entity states
its row checks as column expressions and its set rules as functions of frames;
the engine turns all row checks of an entity into one projection.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

ROW = "_row_index"
RECORD = "_record_id"

SEVERITIES = ("Critical", "Warning", "Info")


@dataclass(frozen=True)
class Rule:
    rule_id: str
    entity: str
    severity: str
    silver_action: str
    error_code: str


@dataclass(frozen=True)
class Check:
    """A row-level condition; every listed rule is reported when it is true."""

    rule_ids: tuple[str, ...]
    message: str | Column
    fails: Column


@dataclass(frozen=True)
class Link:
    """A foreign key, with the parent attributes other checks compare against.

    The engine adds ``found`` (a flag column) and one column per attribute to
    the child rows, so all checks of the child share a single join per link.
    """

    source: str
    field: str
    target: str
    target_field: str
    nullable: bool = False
    rule_ids: tuple[str, ...] = ()
    attributes: dict[str, str] = field(default_factory=dict)

    @property
    def found(self) -> str:
        return f"_found_{self.field}"

    @property
    def message(self) -> str:
        return (
            f"{self.source}.{self.field} does not resolve to {self.target}.{self.target_field}"
        )


Checks = Callable[[], Sequence[Check]]
Prepare = Callable[[DataFrame], DataFrame]
SetRule = Callable[[DataFrame, dict[str, DataFrame]], DataFrame]


@dataclass(frozen=True)
class Unique:
    """Columns whose values must not repeat; rows that share them are reported.

    ``entries`` are pairs of a rule and its message; with ``shown`` the value
    follows the message.  A missing key is no key, but with ``null_safe`` nulls
    are values like others.
    """

    keys: tuple[str, ...]
    entries: tuple[tuple[str, str], ...]
    shown: bool = False
    null_safe: bool = False


@dataclass(frozen=True)
class Entity:
    """One table: its columns, key, row checks, unique keys and set rules.

    ``prepare`` adds parsed helper columns.  A set rule gets the prepared rows
    and all tables and returns ``_row_index, _record_id, rule_id, message,
    occurrences``; ``set_columns`` names the columns that set rules read.
    """

    name: str
    columns: tuple[str, ...]
    required: tuple[str, ...]
    primary_key: str
    checks: Checks = tuple
    prepare: Prepare | None = None
    set_rules: tuple[SetRule, ...] = ()
    unique: tuple[Unique, ...] = ()
    set_columns: tuple[str, ...] = ()


class Pack:
    """Rules, entities in their order, and links."""

    def __init__(
        self,
        rules: Sequence[Rule],
        entities: Sequence[Entity],
        links: Sequence[Link] = (),
        scopes: dict[str, tuple[str, ...]] | None = None,
    ) -> None:
        self.rules = tuple(rules)
        self.entities = {e.name: e for e in entities}
        self.links = tuple(links)
        self.scopes = {"all": tuple(self.entities), **(scopes or {})}
        self._by_id = {r.rule_id: r for r in self.rules}
        if len(self._by_id) != len(self.rules):
            raise RuntimeError("rule pack contains duplicate rule ids")
        if len({r.error_code for r in self.rules}) != len(self.rules):
            raise RuntimeError("rule pack contains duplicate error codes")
        unknown = {r.severity for r in self.rules} - set(SEVERITIES)
        if unknown:
            raise RuntimeError(f"rule pack contains unknown severities: {sorted(unknown)}")

    def rule(self, rule_id: str) -> Rule:
        try:
            return self._by_id[rule_id]
        except KeyError as exc:
            raise ValueError(f"Rule {rule_id!r} is not implemented") from exc

    def entity(self, name: str) -> Entity:
        if not isinstance(name, str) or not name.strip():
            raise ValueError("entity name must be a non-empty string")
        try:
            return self.entities[name.strip().lower()]
        except KeyError as exc:
            known = ", ".join(self.entities)
            raise ValueError(f"Unknown entity {name!r}; approved entities: {known}") from exc

    def links_of(self, name: str) -> list[Link]:
        return [link for link in self.links if link.source == name]

    def rules_frame(self, spark: SparkSession) -> DataFrame:
        """The metadata as a table: one row per rule, fixed in size."""
        rows = [(r.rule_id, r.error_code, r.severity, r.silver_action) for r in self.rules]
        schema = T.StructType(
            [
                T.StructField(n, T.StringType(), False)
                for n in ("rule_id", "error_code", "severity", "silver_action")
            ]
        )
        return spark.createDataFrame(rows, schema)


def flagged(
    rows: DataFrame, rule_ids: Sequence[str], message: str | Column, occurrences: Column | None = None
) -> DataFrame:
    """Findings of a set rule: every row of ``rows`` under every listed rule."""
    text = F.lit(message) if isinstance(message, str) else message
    return rows.select(
        ROW,
        RECORD,
        F.explode(F.array(*[F.lit(r) for r in rule_ids])).alias("rule_id"),
        text.alias("message"),
        (F.lit(1) if occurrences is None else occurrences).cast("long").alias("occurrences"),
    )
