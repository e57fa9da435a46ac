"""Containment join of texts with a table of surface forms, through an automaton in arrays.

The forms become one Aho-Corasick automaton with a complete transition table, so the work for a
text grows with its length and not with the number of forms. A batch of texts is one row of
characters, cut into windows that step through the table together; windows overlap by the
longest form, so nothing is lost at their edges.

The table is the only thing sent to executors. Its size is bounded before anything is fetched:
forms whose table could exceed ``TABLE_BYTES`` are dealt into blocks by their term, one pass
over the texts for each, and the driver holds one block at a time.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut, ship

#: Bytes of one automaton's transition table.
TABLE_BYTES = 64 << 20
WINDOW = 512
#: Characters of texts that a task steps through at once (a longer text is a piece of its own); rows of an Arrow batch.
PIECE, BATCH_ROWS = 1 << 19, 1000
FORMS = "term string, kind string, form string, at bigint, alone boolean"
_PLAIN = r"^[A-Za-z0-9_.+ /-]*$"


class Automaton:
    """All occurrences of many strings; equal strings count as the first of them."""

    def __init__(self, forms: Sequence[str]) -> None:
        spelled = [np.frombuffer(f.encode("utf-32-le"), dtype=np.uint32) for f in forms]
        self.codes = np.unique(np.concatenate(spelled)) if spelled else np.empty(0, dtype=np.uint32)
        self.lengths = np.array([len(s) for s in spelled], dtype=np.int64)
        width = len(self.codes) + 1  # 0 stands for every other character
        edges: dict[int, int] = {}
        parents, letters, depths, own = [0], [0], [0], [-1]
        for i, s in enumerate(spelled):
            state = 0
            for letter in (np.searchsorted(self.codes, s) + 1).tolist():
                step = state * width + letter
                if step not in edges:
                    edges[step] = len(parents)
                    parents.append(state)
                    letters.append(letter)
                    depths.append(depths[state] + 1)
                    own.append(-1)
                state = edges[step]
            if state and own[state] < 0:
                own[state] = i
        self.own, depth = np.array(own), np.array(depths)
        parent, letter = np.array(parents), np.array(letters)
        self.table = np.zeros((len(own), width), dtype=np.int32)
        self.shorter = np.zeros(len(own), dtype=np.int32)  # the longest proper suffix that ends a form, 0 if none
        fallback = np.zeros(len(own), dtype=np.int64)
        self.longest = int(depth.max())
        for level in range(self.longest + 1):
            here, below = np.flatnonzero(depth == level), np.flatnonzero(depth == level + 1)
            if level:
                back = fallback[here]
                self.table[here] = self.table[back]
                self.shorter[here] = np.where(self.own[back] >= 0, back, self.shorter[back])
                fallback[below] = self.table[fallback[parent[below]], letter[below]]
            self.table[parent[below], letter[below]] = below
        # one number for each step: where the next state's row begins, and in the lowest bit whether a form ends there
        ends = (self.own >= 0) | (self.shorter > 0)
        self.width, self.steps = width, ((self.table * width) << 1 | ends[self.table]).ravel().astype(np.int32)
        del self.table
        self.letters = np.zeros(int(self.codes[-1]) + 2 if len(self.codes) else 1, dtype=np.int32)
        self.letters[self.codes] = np.arange(1, width)

    def find(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end, form) of every occurrence in an array of character codes."""
        lead = max(0, self.longest - 1)
        rows = max(1, math.ceil(len(chars) / WINDOW))
        padded = np.zeros(lead + rows * WINDOW, dtype=np.int32)
        padded[lead : lead + len(chars)] = self.letters[np.minimum(chars, len(self.letters) - 1)]
        windows = np.lib.stride_tricks.sliding_window_view(padded, lead + WINDOW)[::WINDOW]
        columns = np.ascontiguousarray(windows.T)
        starts = np.arange(rows) * WINDOW
        state = np.zeros(rows, dtype=np.int32)
        found_at, found_state = [], []
        for step, letters in enumerate(columns):
            state = self.steps.take((state >> 1) + letters)
            if step >= lead:
                hit = np.flatnonzero(state & 1)
                if len(hit):
                    found_at.append(starts[hit] + step - lead)
                    found_state.append((state[hit] >> 1) // self.width)
        if not found_at:
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        end, state = np.concatenate(found_at), np.concatenate(found_state).astype(np.int64)
        ends, forms = [], []
        while len(end):  # an occurrence's suffixes that are forms too
            named = self.own[state] >= 0
            ends.append(end[named])
            forms.append(self.own[state[named]])
            state = self.shorter[state].astype(np.int64)
            end, state = end[state > 0], state[state > 0]
        return np.concatenate(ends), np.concatenate(forms)


def _letter_or_digit(chars: np.ndarray) -> np.ndarray:
    return ((chars >= 48) & (chars <= 57)) | ((chars >= 97) & (chars <= 122)) | ((chars >= 65) & (chars <= 90))


@dataclass(frozen=True)
class Around:
    """Which occurrences of a term count, and how much of the text around them is wanted.

    ``after`` is a Python pattern that the lower-cased sequel matches. With ``alone`` a term that
    begins or ends with an ASCII letter or digit doesn't touch another. ``reach`` characters that are no
    spaces are wanted after the term, with the spaces among them, and one character before it; null
    means the whole text, which is also wanted where one of the words ``heads`` precedes the term.
    """

    after: str
    alone: bool = False
    reach: int | None = None
    heads: tuple[str, ...] = ()


class Gazetteer:
    """One block of forms; ``hits`` names the forms that texts hold, the first of each term."""

    def __init__(self, rows: Sequence) -> None:
        rows = sorted(rows, key=lambda r: (r["at"], r["form"]))
        self.rows = [(r["term"], r["kind"], r["form"], r["at"]) for r in rows]
        lowered = [r["form"].lower() for r in rows]
        spelled = {f: i for i, f in reversed(list(enumerate(dict.fromkeys(lowered))))}
        names = list(spelled)[::-1]
        self.automaton = Automaton(names)
        same: list[list[int]] = [[] for _ in spelled]
        for i, form in enumerate(lowered):
            same[spelled[form]].append(i)
        self.alone = np.array([r["alone"] for r in rows], dtype=bool)
        terms = {t: i for i, t in enumerate(dict.fromkeys(r[0] for r in self.rows))}
        self.term = np.array([terms[r[0]] for r in self.rows], dtype=np.int64)
        self.same, self.first = np.array([i for own in same for i in own], dtype=np.int64), np.cumsum([0, *map(len, same)])
        self.only_alone = np.array([all(self.alone[own]) for own in same], dtype=bool)
        ends = np.array([[ord(f[0]), ord(f[-1])] for f in names], dtype=np.int64).reshape(-1, 2)
        self.plain_ends = _letter_or_digit(ends)

    def _found(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(text, form, first character, whether the character before and the one after are letters or digits) of every occurrence."""
        spelled = [np.frombuffer(t.encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
        starts = np.cumsum([0, *[len(s) + 1 for s in spelled]])
        chars = np.zeros(starts[-1] + 1, dtype=np.uint32)  # a zero between texts ends every match
        for start, s in zip(starts, spelled, strict=False):
            chars[start : start + len(s)] = s
        end, form = self.automaton.find(chars)
        begin = end - self.automaton.lengths[form] + 1
        text = np.searchsorted(starts, begin, "right") - 1
        return text, form, begin - starts[text], _letter_or_digit(chars[begin - 1]), _letter_or_digit(chars[end + 1])  # index -1 is the last zero

    def _rows(self, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(occurrence, row) for all rows that are spelled like the occurrences' forms."""
        sizes = self.first[form + 1] - self.first[form]
        which = np.repeat(np.arange(len(form)), sizes)
        return which, self.same[np.repeat(self.first[form], sizes) + np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)]

    def hits(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, form) for the first form of every term that a lower-cased text holds."""
        text, form, _, before, behind = self._found(texts)
        free = ~before & ~behind
        kept = np.flatnonzero(free | ~self.only_alone[form])
        found = np.unique((text[kept] * len(self.only_alone) + form[kept]) * 2 + free[kept])
        free, found = found % 2 == 1, found // 2
        at, which = self._rows(found % len(self.only_alone))
        fits = free[at] | ~self.alone[which]
        rows, which = found[at[fits]] // len(self.only_alone), which[fits]
        if not len(rows):
            return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        order = np.lexsort((which, self.term[which], rows))
        rows, which = rows[order], which[order]
        first = np.concatenate(([True], (np.diff(rows) != 0) | (np.diff(self.term[which]) != 0)))
        return rows[first], which[first]

    def places(self, texts: Sequence[str], said: Sequence[str], around: Around, after: re.Pattern) -> list[tuple[int, int, str | None, list[str] | None]]:
        """(text, form, whole text, pieces): for every form of a lower-cased text its occurrences that count, in their order, or the whole text.

        Pieces begin with the character before the term, a line break where there is none. The whole
        text is given where cutting it could matter: see ``Around``, and where letters have other cases than lower-casing tells.
        """
        text, form, begin, before, behind = self._found(texts)
        if around.alone:
            kept = ~(before & self.plain_ends[form, 0]) & ~(behind & self.plain_ends[form, 1])
            text, form, begin = text[kept], form[kept], begin[kept]
        order = np.lexsort((begin, form, text))
        stop = begin + self.automaton.lengths[form]
        matched: dict[tuple[int, int], bool] = {}
        pieces: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for t, f, low, high in np.column_stack((text, form, begin, stop))[order].tolist():
            if (fits := matched.get((t, high))) is None:
                fits = matched[t, high] = after.match(texts[t], high) is not None
            if fits:
                pieces.setdefault((t, f), []).append((low, high))
        sequel = None if around.reach is None else re.compile(rf"(?:\s*\S){{0,{around.reach}}}\s*.?", re.DOTALL)
        made = []
        for (t, f), at in pieces.items():
            cuts = None
            if sequel and len(said[t]) == len(texts[t]) and not _odd_cases().search(said[t]) and not any(self._led(said[t], low, around.heads) for low, _ in at):
                cuts = [(said[t][low - 1] if low else "\n") + said[t][low : sequel.match(said[t], high).end()] for low, high in at]
                cuts = cuts if sum(map(len, cuts)) < len(said[t]) or len(cuts) == 1 else None
            for i in self.same[self.first[f] : self.first[f + 1]].tolist():
                made.append((t, i, said[t] if cuts is None else None, cuts))
        return made

    @staticmethod
    def _led(said: str, at: int, heads: Sequence[str]) -> bool:
        """Whether one of the words stands before a place, spaces between them left out."""
        if not heads or not at or not said[at - 1].isspace():
            return False
        while at and said[at - 1].isspace():
            at -= 1
        return said[max(0, at - max(map(len, heads))) : at].upper().lower().endswith(tuple(heads))


_odd: list[re.Pattern] = []


def _odd_cases() -> re.Pattern:
    """Characters that equal others in any case, but not once lower-cased, such as the long s."""
    if not _odd:
        odd = [c for c in map(chr, range(128, sys.maxunicode + 1)) if c.upper().lower() != c.lower() or c.lower().upper() != c.upper()]
        _odd.append(re.compile("[" + "".join(map(re.escape, odd)) + "]"))
    return _odd[0]


def forms_of(spark: SparkSession, entries: Sequence[Mapping]) -> DataFrame:
    """A table of forms from curated entries (canonical, forms, category), in their order."""
    rows = [(e["canonical"], f"gazetteer:{e['category']}", f) for e in entries for f in e["forms"]]
    made = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "term string, kind string, form string, at bigint")
    return made.withColumn("alone", F.rlike("form", F.lit(_PLAIN)))


def plain_forms(spark: SparkSession, words: Sequence[str]) -> DataFrame:
    """A table of words that count wherever they stand, each its own term."""
    return spark.createDataFrame([(w, "", w, i, False) for i, w in enumerate(dict.fromkeys(words))], FORMS)


def _blocks(forms: DataFrame, table_bytes: int) -> Iterator[Gazetteer]:
    held = forms.where("term is not null and form is not null and form <> ''").select("term", "kind", "form", "at", "alone")
    size = held.agg(F.sum(F.length("form"))).first()[0] or 0
    letters = held.select(F.explode(F.array_distinct(F.split(F.lower("form"), ""))).alias("c")).distinct().count()
    blocks = max(1, math.ceil((size + 1) * (letters + 1) * 4 / table_bytes))
    for i in range(blocks):
        part = held.where(F.pmod(F.xxhash64("term"), F.lit(blocks)) == i) if blocks > 1 else held
        if rows := part.collect():  # at most about table_bytes / 4 / letters characters
            yield Gazetteer(rows)


def form_hits(messages: DataFrame, forms: DataFrame, keep: Sequence[str], text: str = "text", table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(keep, term, kind, form, at): for every message and term the first form (by ``at``) that the message holds.

    ``forms`` is (term, kind, form, at, alone). Forms and texts meet in lower case; a form
    marked ``alone`` must not touch an ASCII letter or digit. Null texts hold nothing; null and
    empty forms are none; repeated messages each count; no forms give no rows.
    """
    source = messages.where(F.col(text).isNotNull()).select(*keep, F.lower(F.col(text)).alias("__low"))
    fields = source.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["term string", "kind string", "form string", "at bigint"])
    names = [*[f.name for f in fields], "term", "kind", "form", "at"]

    def pass_of(block: Gazetteer) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for low, texts in _pieces(batch.column(batch.num_columns - 1)):
                    rows, which = block.hits(texts)
                    if len(rows):
                        together = np.argsort(block.term[which], kind="stable")  # hits of a term in a row
                        rows, which = rows[together], which[together]
                        taken = batch.slice(low, len(texts)).take(pa.array(rows))
                        found = list(zip(*[block.rows[i] for i in which.tolist()], strict=True))
                        columns = [taken.column(i) for i in range(len(fields))]
                        columns += [pa.array(c, pa.int64() if n == 3 else pa.string()) for n, c in enumerate(found)]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

        return source.mapInArrow(run, schema)

    return _passes(messages.sparkSession, forms, table_bytes, pass_of, schema)


def form_places(messages: DataFrame, forms: DataFrame, keep: Sequence[str], text: str, around: Around, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """(keep, term, kind, said, places): for every message and form the text around the occurrences that count.

    ``places`` are pieces of the text, in their order, each with the term behind its first
    character; where pieces don't do, ``said`` is the whole text instead. Otherwise like ``form_hits``.
    """
    source = messages.where(F.col(text).isNotNull()).select(*keep, F.col(text).alias("__said"), F.lower(F.col(text)).alias("__low"))
    fields = source.select(*keep).schema
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["term string", "kind string", "said string", "places array<string>"])
    names = [*[f.name for f in fields], "term", "kind", "said", "places"]

    def pass_of(block: Gazetteer) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            after = re.compile(around.after, re.IGNORECASE)
            for batch in batches:
                found, size = [], 0
                for low, texts in _pieces(batch.column(batch.num_columns - 1)):
                    said = batch.column(batch.num_columns - 2).slice(low, len(texts)).to_pylist()
                    made = block.places(texts, said, around, after)
                    found += [(low + t, *rest) for t, *rest in made]
                    size += sum(len(whole or "") + sum(map(len, cuts or ())) for _, _, whole, cuts in made)
                    if size >= 8 * PIECE or low + len(texts) == batch.num_rows:
                        found.sort(key=lambda r: block.term[r[1]])  # hits of a term in a row: what follows compiles by term
                        if found:
                            taken = batch.take(pa.array([r[0] for r in found]))
                            columns = [taken.column(i) for i in range(len(fields))]
                            columns += [pa.array([block.rows[r[1]][n] for r in found], pa.string()) for n in (0, 1)]
                            columns += [pa.array([r[2] for r in found], pa.string()), pa.array([r[3] for r in found], pa.list_(pa.string()))]
                            yield pa.RecordBatch.from_arrays(columns, names=names)
                        found, size = [], 0

        return source.mapInArrow(run, schema)

    return _passes(messages.sparkSession, forms, table_bytes, pass_of, schema)


def _pieces(texts: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts), some ``PIECE`` characters at a time."""
    sizes = np.cumsum(np.asarray(pc.utf8_length(texts))) if len(texts) else np.empty(0)
    edges = np.searchsorted(sizes, np.arange(PIECE, sizes[-1] + PIECE, PIECE)) + 1 if len(texts) else []
    low = 0
    for high in sorted({*(min(int(e), len(texts)) for e in edges), *([len(texts)] if len(texts) else [])}):
        yield low, texts.slice(low, high - low).to_pylist()
        low = high


def _passes(spark: SparkSession, forms: DataFrame, table_bytes: int, pass_of: Callable[[Gazetteer], DataFrame], schema: str) -> DataFrame:
    """The rows of all blocks of forms."""
    ship(spark)
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    made, waiting = None, None
    for block in _blocks(forms, table_bytes):
        if waiting is not None:  # more than one block: each pass is written before the next is fetched
            done = cut(pass_of(waiting), "gazetteer-pass")
            made = done if made is None else made.unionByName(done)
        waiting = block
    if waiting is None:
        return spark.createDataFrame([], schema)
    last = pass_of(waiting)
    return last if made is None else made.unionByName(cut(last, "gazetteer-pass"))
