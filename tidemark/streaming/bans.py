"""The ban list as a stream of changes: additions and whole reloads reach running queries without being read anew."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

_STAMP = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
CHANGES = "username string, banned boolean, generation bigint, at timestamp"


def reload_changes(old: DataFrame, new: DataFrame, generation: int, at: Column) -> DataFrame:
    """The change rows of a reload from list ``old`` to ``new`` (column username): all names of the new list, releases of the others.

    Null names are none, repeated ones count once; names are case-sensitive as in the batch operator; an empty new list releases everybody.
    """
    was, now = (rows.select("username").where("username is not null").distinct() for rows in (old, new))
    changes = now.withColumn("banned", F.lit(True)).unionByName(was.join(now, "username", "left_anti").withColumn("banned", F.lit(False)))
    return changes.select("username", "banned", F.lit(generation).cast("bigint").alias("generation"), at.cast("timestamp").alias("at"))


def flag_banned(messages: DataFrame, changes: DataFrame, author: str, at: str, spread: int = 16) -> DataFrame:
    """The messages of a stream, all columns kept, with ``banned``: what the ban list said of the author at that moment.

    ``changes`` is a stream of (username, banned, generation, at). Of a micro-batch, changes and messages
    take effect in the order of their times, a change before messages of its time; of changes of one
    time the highest generation holds, then the ban. A change of a lower generation than the one that
    holds is a leftover of an older list and is ignored. A message that comes in a later batch
    than a change is judged by that change, whatever its time. Messages without time come last in their
    batch, messages without author are not banned, and changes without name, time or generation are ignored.

    State is one small row for a name that was ever in a change, none for other authors, and is restored
    from the checkpoint on a restart. Changes are few and go to ``spread`` copies of their name; messages are dealt to
    these by hash, so an author of a third of all messages is ``spread`` tasks' work. Columns travel as JSON, so maps need string keys.
    """
    whole = F.to_json(F.struct(*[F.col(f"`{c}`") for c in messages.columns]), _STAMP)
    said = messages.select(F.col(author).cast("string").alias("name"), F.unix_micros(F.col(at).cast("timestamp")).alias("us"), F.lit(None).cast("boolean").alias("ban"), F.lit(None).cast("bigint").alias("generation"), whole.alias("row"))
    known = said.where("name is not null").withColumn("part", F.pmod(F.xxhash64("row"), F.lit(spread)).cast("int"))
    told = changes.select(F.col("username").alias("name"), F.unix_micros(F.col("at").cast("timestamp")).alias("us"), F.col("banned").alias("ban"), "generation", F.lit(None).cast("string").alias("row"))
    told = told.where("name is not null and us is not null and generation is not null and ban is not null")
    copies = told.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(spread - 1))))

    def fold(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        generation, banned = state.get if state.exists else (None, False)
        frames = list(frames)
        rows = frames[0] if len(frames) == 1 else pd.concat(frames)
        change = rows["row"].isna()
        if not change.any():
            yield pd.DataFrame({"row": rows["row"], "banned": bool(banned)})
            return
        # plain tuples: a group is small, and sorting a frame costs more than the fold
        numbers = rows["generation"].where(change, 0).tolist()
        late, message = rows["us"].isna().tolist(), (~change).tolist()
        order = zip(late, rows["us"].fillna(0).tolist(), message, numbers, (rows["ban"] == True).tolist(), range(len(rows)), rows["row"].tolist(), strict=True)  # noqa: E712
        kept, flags = [], []
        for _, _, said_here, number, ban, _, text in sorted(order):
            if said_here:
                kept.append(text)
                flags.append(banned)
            elif generation is None or int(number) >= generation:
                generation, banned = int(number), ban
        state.update((generation, banned))
        yield pd.DataFrame({"row": pd.Series(kept, dtype=object), "banned": pd.Series(flags, dtype=bool)})

    judged = known.unionByName(copies).groupBy("name", "part").applyInPandasWithState(fold, "row string, banned boolean", "generation bigint, banned boolean", "append", GroupStateTimeout.NoTimeout)
    free = said.where("name is null").select("row", F.lit(False).alias("banned"))
    read = judged.unionByName(free).select(F.from_json("row", messages.schema, _STAMP).alias("m"), "banned")
    return read.select(*[F.col("m")[c].alias(c) for c in messages.columns], "banned")


def without_banned_stream(messages: DataFrame, changes: DataFrame, author: str, at: str, spread: int = 16) -> DataFrame:
    """The messages of a stream whose author isn't banned at their moment; see ``flag_banned``."""
    return flag_banned(messages, changes, author, at, spread).where("not banned").drop("banned")
