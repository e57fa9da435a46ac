"""Lexical gates: cheap predicates that run before any scorer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import contains_any, hit_count, matched, ustrip

#: Fixed value: a shorter message (after stripping) carries no signal.
MIN_LENGTH = 20


@dataclass(frozen=True)
class DomainPack:
    """The word lists of one domain; lists are data, loaded from files or tables."""

    terms: tuple[str, ...] = ()
    signals: tuple[str, ...] = ()
    stop: tuple[str, ...] = ()
    generic: tuple[str, ...] = ()
    mode: str = "or"
    patterns: tuple[str, ...] = field(default=())

    def usable_terms(self) -> list[str]:
        """Terms without the generic ones, which alone say nothing."""
        return [t for t in dict.fromkeys(self.terms) if t not in set(self.generic)]


def gate(text: Column, pack: DomainPack) -> Column:
    """NOT stop AND (term OR signal); ``mode="and"`` asks for both."""
    term, signal = contains_any(text, pack.usable_terms()), contains_any(text, pack.signals)
    both = (term & signal) if pack.mode == "and" else (term | signal)
    return ~contains_any(text, pack.stop) & both


def explain_gate(text: Column, pack: DomainPack) -> Column:
    """The terms, signals and stop words found, as a struct of arrays."""
    return F.struct(
        matched(text, pack.usable_terms()).alias("terms"),
        matched(text, pack.signals).alias("signals"),
        matched(text, pack.stop).alias("stop"),
    )


def anti_filter_blocks(text: Column, stop: Sequence[str], terms: Sequence[str] | None) -> Column:
    """Blocked if a stop word is present and no glossary term redeems it; empty text passes."""
    blocked = contains_any(text, stop)
    return blocked & ~contains_any(text, terms) if terms else blocked


def regex_gate(text: Column, wanted: Sequence[str], unwanted: Sequence[str] = ()) -> Column:
    """At least one wanted pattern and no unwanted one."""
    hit = hit_count(text, wanted) > 0
    return hit & (hit_count(text, unwanted) == 0) if unwanted else hit


def first_pattern(text: Column, patterns: Sequence[str]) -> Column:
    """The first pattern that matches, or null."""
    found = F.lit(None).cast("string")
    for pattern in reversed(patterns):
        found = F.when(F.rlike(text, F.lit(pattern)), F.lit(pattern)).otherwise(found)
    return found


def long_enough(text: Column, least: int = MIN_LENGTH) -> Column:
    return F.coalesce(F.length(ustrip(text)) >= least, F.lit(False))


def eligible(messages: DataFrame, text: str = "text", author: str = "username", excluded: Sequence[str] = (), least: int = MIN_LENGTH) -> DataFrame:
    """Messages long enough whose author isn't excluded; unknown authors stay."""
    kept = messages.where(long_enough(F.col(text), least))
    return kept.where(~F.coalesce(F.col(author).isin(*excluded), F.lit(False))) if excluded else kept


def without_banned(messages: DataFrame, banned: DataFrame, author: str = "username") -> DataFrame:
    """Anti join on the author, case-sensitive; messages without an author pass."""
    names = banned.select(F.col(banned.columns[0]).alias("__banned")).where("__banned is not null").distinct()
    return messages.join(names, F.col(author) == F.col("__banned"), "left_anti")


def ban_set(file_names: DataFrame, table_names: DataFrame, reload: bool = False) -> DataFrame:
    """Union of both lists; a reload replaces what the file said."""
    both = table_names if reload else file_names.unionByName(table_names)
    return both.distinct()


def first_of(*stages: tuple[str, Column]) -> Column:
    """Name of the first stage whose predicate holds: an ordered cascade over the remainder."""
    name = F.lit(None).cast("string")
    for label, holds in reversed(stages):
        name = F.when(holds, F.lit(label)).otherwise(name)
    return name
