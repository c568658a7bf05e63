"""Rules as data: patterns with guards on the text around a match, evaluated inside the row.

Matches and their offsets come from the JVM's regular expressions (functions.dates.places), so that no text leaves it. A rule
is tried only on texts that its pattern matches anywhere.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkfolio.functions.dates import places
from sparkfolio.functions.text import let


@dataclass(frozen=True)
class Guard:
    """A pattern that must (or, if not wanted, must not) occur in a part of the text: `before` and `after` characters around
    the match; the match alone with inside; all of it with whole; with upto, from `before` characters ahead to its end; with
    ahead, the `before` characters ahead of it alone."""

    pattern: str
    wanted: bool = True
    before: int = 0
    after: int = 0
    where: str = "around"

    def holds(self, text: Column, m: Column) -> Column:
        part = {"around": lambda: window(text, m.start, m.end, self.before, self.after), "inside": lambda: m.mention, "whole": lambda: text,
                "upto": lambda: window(text, m.start, m.end, self.before, 0), "ahead": lambda: window(text, m.start, m.start, self.before, 0)}[self.where]()
        hit = part.rlike(self.pattern)
        return hit if self.wanted else ~hit


@dataclass(frozen=True)
class Rule:
    rule_id: str
    category: str
    pattern: str
    strength: str = "supporting"
    guards: tuple[Guard, ...] = ()
    most: int | None = None
    facts: dict = field(default_factory=dict, hash=False)


def window(text: Column, start: Column, end: Column, before: int, after: int) -> Column:
    low = F.greatest(start - before, F.lit(0))
    return F.substring(text, low + 1, end + after - low)


def check_rules(rules) -> None:
    names = [r.rule_id for r in rules]
    if len(names) != len(set(names)):
        raise ValueError("a rule id occurs twice")
    for r in rules:
        re.compile(re.sub(r"\(\?<([A-Za-z]\w*)>", r"(?P<\1>", r.pattern))


def matches(text: Column, rule: Rule) -> Column:
    """[(mention, start, end)] of a rule's matches that its guards let pass, the first `most` of them."""
    found = F.when(text.rlike(rule.pattern), places(text, rule.pattern)).otherwise(F.array().cast("array<struct<mention:string,start:int,end:int>>"))
    if rule.most is not None:
        found = F.slice(found, 1, rule.most)
    for g in rule.guards:
        found = _passing(found, text, g)
    return found


def _passing(found: Column, text: Column, guard: Guard) -> Column:
    return F.filter(found, lambda m: guard.holds(text, m))


def spans(texts: DataFrame, key: str, rules: list[Rule], text: str = "text") -> DataFrame:
    """(key, rule_id, category, strength, char_start, char_end, span_text) of all matches of all rules."""
    check_rules(rules)
    parts = []
    for r in rules:
        head = [F.lit(v).alias(n) for n, v in (("rule_id", r.rule_id), ("category", r.category), ("strength", r.strength))]
        parts.append(F.transform(matches(F.col(text), r), _row(head)))
    out = texts.select(key, F.explode(F.concat(*parts)).alias("x"))
    return out.select(key, "x.rule_id", "x.category", "x.strength", "x.char_start", "x.char_end", "x.span_text")


def _row(head: list[Column]):
    return lambda m: F.struct(*head, m.start.alias("char_start"), m.end.alias("char_end"), m.mention.alias("span_text"))


__all__ = ["Guard", "Rule", "check_rules", "let", "matches", "spans", "window"]
