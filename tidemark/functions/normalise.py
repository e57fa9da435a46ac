"""Closed vocabularies: verticals and traffic types."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import ustrip

# The closed set of verticals, and what other names of them map to.
VERTICALS = (
    "igaming", "casino", "betting", "forex", "crypto", "adult", "nutra", "dating",
    "trading", "mlm", "subscription", "call_centers", "resale", "esports", "other", "unknown",
)
VERTICAL_ALIASES = {
    "igaming": ("gambling", "гемблинг", "гамблинг", "gaming", "mobile gaming", "i-gaming", "igambling", "online gambling"),
    "casino": ("poker", "покер", "slots", "live casino", "table games"),
    "betting": ("sportsbook", "sports betting", "беттинг", "ставки", "bookmaker", "sport", "sports"),
    "forex": ("fx", "currency", "p2p", "exchange"),
    "crypto": ("web3", "vasp", "crypto/vasp", "blockchain", "cryptocurrency"),
    "nutra": ("pharma", "peptides", "пептиды", "medicine", "drugs", "supplements", "health", "weight loss"),
    "trading": ("binary options", "cfd", "options"),
    "subscription": ("subscriptions", "saas"),
    "call_centers": ("кц", "сс", "колл-центр", "call center", "telemarketing"),
    "esports": ("киберспорт", "cybersport", "e-sport", "e-sports", "esport"),
}
TRAFFIC_TYPES = ("live_traffic", "database", "infra", "unclear", "none")


def flatten_aliases(groups: Mapping[str, Sequence[str]]) -> dict[str, str]:
    return {alias: name for name, aliases in groups.items() for alias in aliases}


def normalise_list(values: Column, known: Sequence[str], aliases: Mapping[str, str], fallback: str) -> Column:
    """Stripped, lower-cased, mapped into the closed set; blanks dropped, first occurrences kept.

    Whatever is neither known nor an alias is the fallback.
    """
    pairs = [F.lit(x) for name in known for x in (name, name)] + [F.lit(x) for pair in aliases.items() if pair[0] not in known for x in pair]
    mapping = F.create_map(*pairs)
    low = F.filter(F.transform(values, lambda v: F.lower(ustrip(v))), lambda v: v != "")
    return F.array_distinct(F.transform(low, lambda v: F.coalesce(F.try_element_at(mapping, v), F.lit(fallback))))


def normalise_verticals(values: Column) -> Column:
    return normalise_list(values, VERTICALS, flatten_aliases(VERTICAL_ALIASES), "other")


def normalise_traffic_types(values: Column) -> Column:
    """Known types in order without repeats; unknown ones are dropped."""
    low = F.transform(values, lambda v: F.lower(ustrip(v)))
    return F.array_distinct(F.filter(low, lambda v: v.isin(*TRAFFIC_TYPES)))


def collapse_traffic_type(types: Column) -> Column:
    """none, else unclear if alone, else live over database over infra; null for no annotation."""
    has = lambda name: F.array_contains(types, name)
    rest = F.size(F.array_except(types, F.array(F.lit("unclear"))))
    return (
        F.when(F.size(types) == 0, F.lit(None).cast("string"))
        .when(has("none"), "none")
        .when(rest == 0, "unclear")
        .when(has("live_traffic"), "live_traffic")
        .when(has("database"), "database")
        .when(has("infra"), "infra")
    )
