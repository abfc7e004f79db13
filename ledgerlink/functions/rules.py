"""Ordered text rules as data (B27, B28): a table of patterns, tried in order on each text."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import strip

MOST_RULES = 1_000


@dataclass(frozen=True)
class Rule:
    """``group`` of ``pattern`` is the name if it is longer than ``longer_than`` and holds none of ``stop_words`` (in any
    case); ``label`` is given instead, with the name for '{}'."""

    pattern: str
    group: int = 0
    longer_than: int = 0
    stop_words: tuple[str, ...] = ()
    label: str | None = None


def rules_of(table: DataFrame) -> list[Rule]:
    """The rules of a caller's table (priority, pattern, group, longer_than, stop_words: array, label), in order.

    Patterns become literals of the plan, compiled once a task, so their number is bounded; texts are never joined."""
    rows = table.orderBy("priority", "pattern").limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    return [Rule(r["pattern"], r["group"], r["longer_than"], tuple(r["stop_words"] or ()), r["label"]) for r in rows]


def by_rule(text, rule: Rule) -> Column:
    """What one rule makes of a text, or null."""
    t = F.col(text) if isinstance(text, str) else text
    name = strip(F.regexp_extract(t, rule.pattern, rule.group))
    ok = t.rlike(rule.pattern) & (F.length(name) > rule.longer_than)
    for word in rule.stop_words:
        ok = ok & ~F.lower(name).contains(word.lower())
    return F.when(ok, name if rule.label is None else F.replace(F.lit(rule.label), F.lit("{}"), name))


def first_rule(text, rules: list[Rule]) -> Column:
    """What the first rule that fits makes of a text; null where none does."""
    return F.coalesce(*[by_rule(text, r) for r in rules], F.lit(None).cast("string"))


def sql_rule(text: str, rule: Rule) -> str:
    """DuckDB twin of ``by_rule``; for patterns that both engines read alike."""
    quoted = rule.pattern.replace("'", "''")
    name = f"trim(regexp_extract({text}, '{quoted}', {rule.group}))"
    ok = f"regexp_matches({text}, '{quoted}') AND length({name}) > {rule.longer_than}"
    for word in rule.stop_words:
        ok += f" AND NOT contains(lower({name}), '{word.lower()}')"
    label = rule.label.replace("'", "''") if rule.label is not None else ""
    return f"CASE WHEN {ok} THEN " + (name if rule.label is None else f"replace('{label}', '{{}}', {name})") + " END"


def sql_first_rule(text: str, rules: list[Rule]) -> str:
    return "coalesce(" + ", ".join(sql_rule(text, r) for r in rules) + ")"
