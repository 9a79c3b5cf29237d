"""Validation as one plan: findings, disposition, evidence and summaries."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchstone.functions import missing, present, quoted
from touchstone.operators.keys import lookup
from touchstone.operators.scan import running_before
from touchstone.plans.rules import RECORD, ROW, Check, Entity, Link, Pack, Unique
from touchstone.session import entity_jobs, materialize


#: Columns that landing adds; everything else is source data.
_LANDING = (ROW, "_source_file")

#: Checks that share one column of bits.
_WORD = 62


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _record_id(entity: Entity) -> Column:
    key = F.col(entity.primary_key).cast("string")
    return F.when(present(key), key).otherwise(F.concat(F.lit("row:"), F.col(ROW).cast("string")))


def prepared(table: DataFrame, entity: Entity) -> DataFrame:
    """Declared columns (absent ones as null), identity, and parsed helper columns."""
    have = set(table.columns)
    rows = table.select(
        F.col(ROW),
        *[
            F.col(c) if c in have else F.lit(None).cast("string").alias(c)
            for c in entity.columns
        ],
    ).withColumn(RECORD, _record_id(entity))
    return entity.prepare(rows) if entity.prepare else rows


def _link_check(link: Link) -> Check:
    fails = ~F.col(link.found)
    if link.nullable:
        fails = fails & ~missing(F.col(link.field).cast("string"))
    return Check(link.rule_ids, link.message, fails)


def _decided(rows: DataFrame, checks: Sequence[Check], links: Sequence[Link]) -> tuple[DataFrame, list[Check]]:
    """``rows`` with a bit for every check that names no column of a link, and the checks, which then read these bits.

    Joins that follow carry the bits, not the columns that the checks read.
    """
    added = {name for link in links for name in (link.found, *link.attributes)}
    settled = [i for i, check in enumerate(checks) if not any(name in str(check.fails) for name in added)]
    out, words = list(checks), {}
    for start in range(0, len(settled), _WORD):
        name = f"_failed_{start // _WORD}"
        bits = []
        for place, i in enumerate(settled[start : start + _WORD]):
            bit = F.lit(1 << place).cast("long")
            bits.append(F.when(checks[i].fails, bit).otherwise(F.lit(0).cast("long")))
            out[i] = replace(checks[i], fails=F.col(name).bitwiseAND(bit) != 0)
        words[name] = reduce(Column.bitwiseOR, bits)
    return rows.withColumns(words) if words else rows, out


def row_findings(rows: DataFrame, checks: list[Check]) -> DataFrame:
    """All row checks of one entity in one projection over one scan."""
    entries = [
        F.when(
            check.fails,
            F.struct(
                F.lit(rule_id).alias("rule_id"),
                (F.lit(check.message) if isinstance(check.message, str) else check.message).alias("message"),
            ),
        )
        for check in checks
        for rule_id in check.rule_ids
    ]
    hit = F.explode(F.array_compact(F.array(*entries)))
    return rows.select(ROW, RECORD, hit.alias("_hit")).select(
        ROW, RECORD, "_hit.rule_id", "_hit.message", F.lit(1).cast("long").alias("occurrences")
    )


def duplicate_findings(rows: DataFrame, rules: Sequence[Unique]) -> DataFrame:
    """Findings of all unique keys of an entity, from one grouping.

    Each row gives a small mark per key, the number of the key and a hash of its
    value.  Marks that are alone are done with; the values themselves are only
    compared, exactly, where hashes repeat.
    """

    def mark(number: int, rule: Unique) -> Column:
        if rule.null_safe:
            value = F.to_json(F.struct(*rule.keys), {"ignoreNullFields": "false"})
            usable = F.lit(True)
        else:
            value = F.concat_ws("\x1f", *[F.col(k).cast("string") for k in rule.keys])
            usable = reduce(Column.__and__, (present(F.col(k).cast("string")) for k in rule.keys))
        return F.when(usable, F.struct(F.lit(number).alias("rule"), F.xxhash64(value).alias("hash"), value.alias("value")))

    every = F.inline(F.array_compact(F.array(*[mark(i, rule) for i, rule in enumerate(rules)])))
    marks = rows.select(ROW, RECORD, every).withColumn("_spread", F.hash("rule", "hash"))

    def alike(frame: DataFrame, by: str) -> DataFrame:
        repeated = (
            frame.groupBy(F.col("rule").alias("_rule"), F.col(by).alias("_by")).count().where("count > 1")
            .select("_rule", "_by", F.hash("_rule", F.xxhash64("_by") if by == "value" else F.col("_by")).alias("_same"))
        )
        same = (frame["rule"] == repeated["_rule"]) & (frame[by] == repeated["_by"]) & (frame["_spread"] == repeated["_same"])
        return frame.join(repeated, same, "left_semi")

    found = alike(alike(marks, "hash"), "value")

    def entries(rule: Unique) -> Column:
        def text(message: str) -> Column:
            return F.concat(F.lit(message), quoted(F.col("value"))) if rule.shown else F.lit(message)

        return F.array(*[F.struct(F.lit(r).alias("rule_id"), text(m).alias("message")) for r, m in rule.entries])

    hits = F.when(F.col("rule") == 0, entries(rules[0]))
    for number, rule in enumerate(rules[1:], 1):
        hits = hits.when(F.col("rule") == number, entries(rule))
    return found.select(ROW, RECORD, F.inline(hits)).withColumn("occurrences", F.lit(1).cast("long"))


def set_rows(rows: DataFrame, entity: Entity, links: Sequence[Link]) -> DataFrame:
    """What unique keys, set rules and links into the entity itself read, parsed and kept once."""
    own = [c for link in links if link.target == entity.name for c in (link.target_field, *link.attributes.values())]
    columns = dict.fromkeys([*(k for rule in entity.unique for k in rule.keys), *entity.set_columns, *own])
    return materialize(rows.select(ROW, RECORD, *[c for c in columns if c not in (ROW, RECORD)]))


def entity_findings(tables: Mapping[str, DataFrame], pack: Pack, name: str) -> DataFrame:
    """Findings of one entity: row checks, links, unique keys and set rules.

    The entity is read twice: once whole, by all row checks and links in one
    pass, and once narrow, for whatever compares rows with each other.
    """
    entity, links = pack.entity(name), pack.links_of(name)
    rows = prepared(tables[name], entity)
    compares = entity.unique or entity.set_rules
    narrow = set_rows(rows, entity, links) if compares else rows
    linked, checks = rows, list(entity.checks())
    if links:
        linked, checks = _decided(rows, checks, links)
    for link in links:
        if link.target not in tables:
            raise ValueError(f"dataset is missing required entities: {link.target}")
        linked = lookup(
            linked,
            link.field,
            narrow if link.target == name and compares else tables[link.target],
            link.target_field,
            link.attributes,
            found=link.found,
            order=ROW,
        )
        checks.append(_link_check(link))
    parts = [row_findings(linked, checks)] if checks else []
    if entity.unique:
        parts.append(duplicate_findings(narrow, entity.unique))
    parts += [rule(narrow, tables) for rule in entity.set_rules]
    return _union(parts).select(F.lit(name).alias("entity"), *parts[0].columns)


@dataclass(frozen=True)
class Result:
    """The outcome of a validation run; every member is a DataFrame."""

    run_id: str
    pack: Pack
    entities: tuple[str, ...]
    tables: dict[str, DataFrame]
    identifiers: dict[str, str]
    findings: DataFrame
    duration_seconds: float
    #: Seconds of each entity's own jobs; entities overlap, so these don't add up.
    durations: dict[str, float]

    def _of(self, entity: str) -> DataFrame:
        return self.findings.where(F.col("entity") == entity)

    def _critical_rows(self, entity: str) -> DataFrame:
        return self._of(entity).where("severity = 'Critical'").select(ROW).distinct()

    def accepted(self, entity: str) -> DataFrame:
        """Unchanged source rows without a critical finding."""
        table = self.tables[entity]
        return table.join(self._critical_rows(entity), ROW, "left_anti").select(*table.columns)

    def _records(self, entity: str) -> DataFrame:
        table = self.tables[entity]
        columns = sorted(c for c in table.columns if c not in _LANDING)
        record = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})
        return table.select(ROW, record.alias("source_record"))

    def evidence(self) -> DataFrame:
        """One row per finding with its source record; see ``expanded`` for copies."""
        parts = [
            self._of(name).join(self._records(name), ROW) for name in self.entities
        ]
        return _union(parts).select(
            "run_id", "entity", "record_id", "rule_id", "error_code", "severity", "silver_action",
            "outcome", "message", "source_identifier", "source_record", "validation_timestamp",
            "occurrences", ROW,
        )

    def quarantine(self, entity: str | None = None) -> DataFrame:
        """Rows with a critical finding, with their record and rule ids as JSON.

        The list of one row is bounded by the rules and fields of its entity; it
        names a repeated finding once, and ``finding_count`` counts each.
        """
        parts = []
        for name in (entity,) if entity else self.entities:
            ordered = F.array_sort(F.collect_list(F.struct("rule_id", "message", "severity")))
            grouped = (
                self._of(name)
                .groupBy(ROW, "record_id")
                .agg(ordered.alias("_all"), F.sum("occurrences").alias("finding_count"))
                .where(F.exists("_all", lambda r: r["severity"] == "Critical"))
            )
            ids = F.transform("_all", lambda r: r["rule_id"])
            critical = F.transform(
                F.filter("_all", lambda r: r["severity"] == "Critical"), lambda r: r["rule_id"]
            )
            parts.append(
                grouped.join(self._records(name), ROW).select(
                    F.lit(self.run_id).alias("run_id"),
                    F.lit(name).alias("entity"),
                    "record_id",
                    F.lit(self.identifiers.get(name, name)).alias("source_identifier"),
                    F.col("source_record").alias("source_record_json"),
                    F.to_json(critical).alias("critical_rule_ids"),
                    F.to_json(ids).alias("all_rule_ids"),
                    "finding_count",
                )
            )
        return _union(parts)

    def summary(self) -> DataFrame:
        """Counters, status and duration per entity; an entity without rows succeeded."""
        times = F.create_map(*[F.lit(x) for pair in self.durations.items() for x in pair])
        return entity_summary(
            {name: self.tables[name] for name in self.entities}, self.findings
        ).withColumn("duration_seconds", times[F.col("entity")])

    def run_summary(self) -> DataFrame:
        return run_summary(self.summary()).withColumn(
            "duration_seconds", F.lit(self.duration_seconds)
        )


def _status(quarantined: Column, accepted: Column) -> Column:
    return (
        F.when((quarantined > 0) & (accepted == 0), "FAILED")
        .when(quarantined > 0, "PARTIAL_SUCCESS")
        .otherwise("SUCCEEDED")
    )


_COUNTERS = (
    "rows_read", "rows_accepted", "rows_quarantined",
    "critical_result_count", "warning_result_count", "info_result_count",
)


def entity_summary(tables: Mapping[str, DataFrame], findings: DataFrame) -> DataFrame:
    sizes = _union(
        [
            table.agg(F.count(F.lit(1)).alias("rows_read")).select(F.lit(name).alias("entity"), "rows_read")
            for name, table in tables.items()
        ]
    )

    per_row = findings.groupBy("entity", ROW).agg(
        *[
            F.sum(F.when(F.col("severity") == s, F.col("occurrences")).otherwise(0)).alias(s)
            for s in ("Critical", "Warning", "Info")
        ]
    )
    counts = per_row.groupBy("entity").agg(
        F.count_if(F.col("Critical") > 0).alias("rows_quarantined"),
        F.sum("Critical").alias("critical_result_count"),
        F.sum("Warning").alias("warning_result_count"),
        F.sum("Info").alias("info_result_count"),
    )
    return (
        sizes.join(counts, "entity", "left")
        .na.fill(0)
        .withColumn("rows_accepted", F.col("rows_read") - F.col("rows_quarantined"))
        .withColumn("status", _status(F.col("rows_quarantined"), F.col("rows_accepted")))
        .select("entity", *_COUNTERS, "status")
    )


def run_summary(summary: DataFrame) -> DataFrame:
    totals = summary.agg(*[F.sum(c).alias(c) for c in _COUNTERS])
    return totals.withColumn("status", _status(F.col("rows_quarantined"), F.col("rows_accepted")))


def enrich(findings: DataFrame, pack: Pack) -> DataFrame:
    """Attach severity, action and code; the metadata table has a fixed size."""
    metadata = F.broadcast(pack.rules_frame(findings.sparkSession))
    outcome = (
        F.when(F.col("severity") == "Critical", "FAILED")
        .when(F.col("severity") == "Warning", "FLAGGED")
        .otherwise("LOGGED")
    )
    return findings.join(metadata, "rule_id").withColumn("outcome", outcome)


def expanded(findings: DataFrame) -> DataFrame:
    """One row per single occurrence, for readers that count rows."""
    return findings.withColumn(
        "occurrence", F.explode(F.sequence(F.lit(1).cast("long"), F.col("occurrences")))
    ).drop("occurrences")


def _position(entities: tuple[str, ...]) -> Column:
    return F.array_position(F.array(*[F.lit(e) for e in entities]), F.col("entity"))


def ordered(findings: DataFrame, entities: tuple[str, ...]) -> DataFrame:
    """Stable reading order; sinks stay unordered."""
    return findings.orderBy(_position(entities), ROW, "rule_id", "message")


def ranked(findings: DataFrame, entities: tuple[str, ...]) -> DataFrame:
    """Findings with ``place``, their number from 1 in the stable reading order, whatever their number."""
    placed = findings.withColumns({"_position": _position(entities), "_one": F.lit(1).cast("long")})
    numbered = running_before(placed, ["_position", ROW, "rule_id", "message"], "_one", "place")
    return numbered.withColumn("place", F.col("place") + 1).drop("_position", "_one")


def validate(
    tables: Mapping[str, DataFrame],
    pack: Pack,
    run_id: str,
    *,
    scope: str = "all",
    source_identifiers: Mapping[str, str] | None = None,
    validation_timestamp: datetime | None = None,
    keep: bool = True,
) -> Result:
    """Run every rule of the scope over the tables.

    Each table carries ``_row_index``.  Entities are judged a few at a time, each
    under a job tag of its own.  ``keep`` checkpoints the findings once,
    because accepted rows, quarantine, evidence and summaries all read them.
    """
    entities = pack.scopes[scope]
    absent = [e for e in entities if e not in tables]
    if absent:
        raise ValueError(f"dataset is missing required entities: {', '.join(absent)}")
    if not isinstance(run_id, str) or not run_id:
        raise ValueError("run_id must be a non-empty string")
    identifiers = dict(source_identifiers or {})
    began = time.monotonic()
    names = [part for e in entities for part in (F.lit(e), F.lit(identifiers.get(e, e)))]
    moment = validation_timestamp or datetime.now(timezone.utc)

    def judge(name: str) -> DataFrame:
        result = enrich(entity_findings(tables, pack, name), pack).select(
            F.lit(run_id).alias("run_id"),
            "entity",
            F.col(RECORD).alias("record_id"),
            "rule_id",
            "error_code",
            "severity",
            "silver_action",
            "outcome",
            "message",
            F.create_map(*names)[F.col("entity")].alias("source_identifier"),
            F.lit(moment).cast("timestamp").alias("validation_timestamp"),
            "occurrences",
            ROW,
        )
        return materialize(result) if keep else result

    spark = next(iter(tables.values())).sparkSession
    judged = entity_jobs(spark, entities, judge)
    return Result(
        run_id,
        pack,
        entities,
        dict(tables),
        identifiers,
        _union([findings for findings, _ in judged.values()]),
        time.monotonic() - began,
        {name: seconds for name, (_, seconds) in judged.items()},
    )
