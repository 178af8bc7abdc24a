"""Data-quality checks, each counted in one pass without a shuffle of rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import hash_number


@dataclass(frozen=True)
class DependencyRule:
    """``condition`` holds exactly where ``consequence`` holds; ``reads`` names the columns of both."""

    name: str
    condition: Column
    consequence: Column
    reads: Sequence[str] = ()

    @property
    def columns(self) -> set[str]:
        return set(self.reads)


@dataclass(frozen=True)
class DomainRule:
    """Non-null values of ``column`` are among ``allowed``."""

    column: str
    allowed: Sequence

    @property
    def name(self) -> str:
        return f"{self.column} in domain"

    @property
    def columns(self) -> set[str]:
        return {self.column}

    def holds(self) -> Column:
        return F.col(self.column).isin(list(self.allowed))

    def applies(self) -> Column:
        return F.lit(True)


@dataclass(frozen=True)
class RangeRule:
    """Non-null values of ``column`` lie in ``[low, high]``, where ``scope`` holds (default: everywhere).

    ``reads`` names the columns of ``scope``.
    """

    column: str
    low: float
    high: float
    scope: Column | None = None
    note: str = ""
    reads: Sequence[str] = ()

    @property
    def columns(self) -> set[str]:
        return {self.column, *self.reads}

    @property
    def name(self) -> str:
        return f"{self.column} in [{self.low:g}, {self.high:g}]{' if ' + self.note if self.note else ''}"

    def holds(self) -> Column:
        return F.col(self.column).between(self.low, self.high)

    def applies(self) -> Column:
        return F.lit(True) if self.scope is None else self.scope


def rule_violations(df: DataFrame, rules: Sequence[DependencyRule]) -> DataFrame:
    """Rows (rule, rows, missing, unexpected, violations), one per rule.

    ``missing``: the condition holds without its consequence; ``unexpected``:
    the reverse. A null condition or consequence counts as not holding.
    """
    totals = []
    for position, rule in enumerate(rules):
        condition = F.coalesce(rule.condition, F.lit(False))
        consequence = F.coalesce(rule.consequence, F.lit(False))
        totals += [
            F.count_if(condition & ~consequence).alias(f"missing_{position}"),
            F.count_if(~condition & consequence).alias(f"unexpected_{position}"),
        ]
    lines = [
        F.struct(
            F.lit(rule.name).alias("rule"),
            F.col("rows"),
            F.col(f"missing_{position}").alias("missing"),
            F.col(f"unexpected_{position}").alias("unexpected"),
            (F.col(f"missing_{position}") + F.col(f"unexpected_{position}")).alias("violations"),
        )
        for position, rule in enumerate(rules)
    ]
    none = F.array().cast("array<struct<rule:string,rows:bigint,missing:bigint,unexpected:bigint,violations:bigint>>")
    listed = F.array(*lines) if lines else none
    return df.agg(F.count("*").alias("rows"), *totals).select(F.inline(listed))


def domain_violations(df: DataFrame, rules: Sequence[DomainRule | RangeRule]) -> DataFrame:
    """Rows (check, rows, nulls, violations), one per rule; ``rows`` are those the rule applies to."""
    totals = []
    for position, rule in enumerate(rules):
        applies = F.coalesce(rule.applies(), F.lit(False))
        totals += [
            F.count_if(applies).alias(f"rows_{position}"),
            F.count_if(applies & F.col(rule.column).isNull()).alias(f"nulls_{position}"),
            F.count_if(applies & ~rule.holds()).alias(f"violations_{position}"),
        ]
    lines = [
        F.struct(
            F.lit(rule.name).alias("check"),
            F.col(f"rows_{position}").alias("rows"),
            F.col(f"nulls_{position}").alias("nulls"),
            F.col(f"violations_{position}").alias("violations"),
        )
        for position, rule in enumerate(rules)
    ]
    none = F.array().cast("array<struct<check:string,rows:bigint,nulls:bigint,violations:bigint>>")
    listed = F.array(*lines) if lines else none
    return df.agg(F.count("*"), *totals).select(F.inline(listed))


def check_report(
    df: DataFrame, rules: Sequence[DependencyRule | DomainRule | RangeRule], key: Column, evidence: int = 5
) -> DataFrame:
    """Rows (check, rows, nulls, violations, keys), one per rule, dependencies and domains in one aggregation.

    ``keys`` are up to ``evidence`` keys of violating rows, as text in order: of those whose hash leaves a given
    remainder the one with the least hash. Such minima merge, so a task keeps a few keys per rule however many rows
    violate it, and the same keys are shown on any layout.
    """
    text = F.coalesce(key.cast("string"), F.lit("null"))
    marked = df.withColumns({"_key": text, "_hash": hash_number(text)})
    totals, lines = [], []
    for position, rule in enumerate(rules):
        if isinstance(rule, DependencyRule):
            condition, consequence = (F.coalesce(c, F.lit(False)) for c in (rule.condition, rule.consequence))
            applies, null, violated = F.lit(True), F.lit(False), condition != consequence
        else:
            applies = F.coalesce(rule.applies(), F.lit(False))
            null = applies & F.col(rule.column).isNull()
            violated = applies & F.coalesce(~rule.holds(), F.lit(False))
        shown = F.struct("_hash", "_key")
        minima = [
            F.min(F.when(violated & (F.col("_hash") % evidence == part), shown)).alias(f"key_{position}_{part}")
            for part in range(evidence)
        ]
        totals += [
            F.count_if(applies).alias(f"rows_{position}"),
            F.count_if(null).alias(f"nulls_{position}"),
            F.count_if(violated).alias(f"violations_{position}"),
            *minima,
        ]
        keys = F.array_compact(F.array(*[F.col(f"key_{position}_{part}._key") for part in range(evidence)]))
        lines.append(
            F.struct(
                F.lit(rule.name).alias("check"),
                F.col(f"rows_{position}").alias("rows"),
                F.col(f"nulls_{position}").alias("nulls"),
                F.col(f"violations_{position}").alias("violations"),
                F.array_join(F.array_sort(keys), ", ").alias("keys"),
            )
        )
    none = F.array().cast("array<struct<check:string,rows:bigint,nulls:bigint,violations:bigint,keys:string>>")
    return marked.agg(F.count("*"), *totals).select(F.inline(F.array(*lines) if lines else none))
