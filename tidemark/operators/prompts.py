"""Blocks of a prompt as column expressions; templates and headings are parameters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank, truncated, ustrip
from tidemark.operators.context import prior_share

SNIPPET = 200
#: Labels that make a group one about traffic, and the share from which it is.
TRAFFIC_LABELS, HEAVY_SHARE = ("seeking_traffic", "traffic_provider"), 0.6


def snippet(text: Column, limit: int = SNIPPET) -> Column:
    """One line, cut with dots."""
    return truncated(ustrip(F.regexp_replace(F.coalesce(text, F.lit("")), "\n", " ")), limit)


def _numbered(texts: Column) -> Column:
    return F.array_join(F.transform(texts, lambda t, i: F.concat(F.lit("  "), (i + 1).cast("string"), F.lit(". "), snippet(t))), "\n")


def few_shot(negative: Column, positive: Column, heading: str = "SIMILAR EXAMPLES:", no: str = "NOT LEAD:", yes: str = "LEAD:") -> Column:
    """Both kinds of examples (arrays of texts), numbered, the negative ones first; empty without any."""

    def part(name: str, texts: Column) -> Column:
        return F.when(F.size(texts) > 0, F.concat(F.lit(f"\n\n{name}\n"), _numbered(texts))).otherwise(F.lit(""))

    some = (F.size(negative) > 0) | (F.size(positive) > 0)
    return F.when(some, F.concat(F.lit(heading), part(no, negative), part(yes, positive), F.lit("\n"))).otherwise(F.lit(""))


def glossary_block(entries: Column, none: str = "  (no terms)") -> Column:
    """Entries (array of term, senses) as lines of term and first definition."""
    first = lambda e: F.coalesce(F.get(e["senses"], 0)["definition"], F.lit(""))
    lines = F.transform(entries, lambda e: F.concat(F.lit("  - "), e["term"], F.lit(": "), first(e)))
    return F.when(F.size(entries) > 0, F.array_join(lines, "\n")).otherwise(F.lit(none))


def context_block(context: Column, none: str = "  (no context)") -> Column:
    """Messages (array of message_id, username, at, text) as lines; the list is taken as it is given."""
    line = lambda m: F.concat(
        F.lit("  [msg_id="), F.coalesce(m["message_id"].cast("string"), F.lit("?")), F.lit(" @"), F.coalesce(F.nullif(m["username"], F.lit("")), F.lit("anon")),
        F.lit(" "), F.coalesce(m["at"].cast("string"), F.lit("?")), F.lit("] "), snippet(m["text"]),
    )
    return F.when(F.size(context) > 0, F.array_join(F.transform(context, line), "\n")).otherwise(F.lit(none))


def shares(distribution: Column) -> Column:
    """A map of shares as text: names in order, percent with one digit."""
    entries = F.array_sort(F.map_entries(distribution))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit(": "), F.format_number(e["value"] * 100, 1), F.lit("%"))), ", ")


def filled(template: str, values: dict[str, Column]) -> Column:
    """The template with each {name} replaced; null values leave it empty."""
    made = F.lit(template)
    for name, value in values.items():
        made = F.replace(made, F.lit("{" + name + "}"), F.coalesce(value.cast("string"), F.lit("")))
    return made


def group_block(name: Column, distribution: Column, total: Column, confidence: Column, template: str, heavy: str, labels: Sequence[str] = TRAFFIC_LABELS) -> Column:
    """What is known of a message's group: empty unless trusted, another template where ``labels`` dominate."""
    values = {"group": name, "distribution": shares(distribution), "total": total, "confidence": confidence}
    chosen = F.when(prior_share(distribution, labels) >= HEAVY_SHARE, filled(heavy, values)).otherwise(filled(template, values))
    return F.when((confidence == "high") & ~is_blank(name), chosen).otherwise(F.lit(""))


def bio_block(bio: Column, template: str) -> Column:
    """The author's profile text in its template; empty without one."""
    return F.when(is_blank(bio), F.lit("")).otherwise(filled(template, {"bio": ustrip(bio)}))


def extra_blocks(*blocks: Column) -> Column:
    """Blocks that aren't empty, a blank line between them and a new line at the end."""
    some = F.filter(F.array(*blocks), lambda b: b != "")
    return F.when(F.size(some) > 0, F.concat(F.array_join(some, "\n\n"), F.lit("\n"))).otherwise(F.lit(""))
