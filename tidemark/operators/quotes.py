"""Which documents hold which quotes: every document against every quote."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import quote_norm

#: Bytes of quotes that one pass over the documents takes; documents in an Arrow batch; rows written at once.
BLOCK_BYTES, BATCH_ROWS, OUT_ROWS = 4 << 20, 1000, 100_000
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _windows(text: str, size: int) -> np.ndarray:
    """A hash of every ``size`` characters, built by doubling: that of a + b is that of a times a power, plus that of b."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
    if len(codes) < size:
        return codes[:0]
    made, length = codes, 1
    for bit in bin(size)[3:]:
        for other, more in ((made, length), (codes, 1))[: 1 + int(bit)]:
            count = len(codes) - length - more + 1
            made = made[:count] * _BASE ** np.uint64(more) + other[length : length + count]
            length += more
    return made


class QuoteIndex:
    """Normalised quotes, found in normalised texts as a whole or by any ``run`` characters.

    Any such run covers a block of half its size that starts at a multiple of that size, so
    texts are searched for these blocks, and around each one found characters are compared.
    """

    def __init__(self, quotes: Sequence[str | None], run: int = 25) -> None:
        self.quotes, self.run, self.half = [q or "" for q in quotes], run, (run + 1) // 2
        self.short = [i for i, q in enumerate(self.quotes) if 0 < len(q) < run]
        self.blocks: dict[str, list[tuple[int, int]]] = {}
        for i, q in enumerate(self.quotes):
            if len(q) >= run:
                for at in range(0, len(q) - self.half + 1, self.half):
                    self.blocks.setdefault(q[at : at + self.half], []).append((i, at))
        self.shift = np.uint64(64 - max(16, int(math.log2(len(self.blocks) + 1)) + 6))
        self.maybe = np.zeros(1 << (64 - int(self.shift)), dtype=bool)
        for block in self.blocks:
            self.maybe[self._slot(_windows(block, self.half))] = True

    def _slot(self, hashes: np.ndarray) -> np.ndarray:
        return ((hashes ^ (hashes >> np.uint64(29))) * _BASE >> self.shift).astype(np.int64)

    def _long(self, text: str, p: int, quote: str, at: int) -> bool:
        """Whether the equal characters around a common block are ``run`` or more."""
        left, right = 0, self.half
        while left + right < self.run and p > left and at > left and text[p - left - 1] == quote[at - left - 1]:
            left += 1
        while left + right < self.run and p + right < len(text) and at + right < len(quote) and text[p + right] == quote[at + right]:
            right += 1
        return left + right >= self.run

    def held(self, text: str) -> set[int]:
        """Positions of the quotes that the text holds."""
        found = {i for i in self.short if self.quotes[i] in text}
        for p in np.flatnonzero(self.maybe[self._slot(_windows(text, self.half))]).tolist():
            for i, at in self.blocks.get(text[p : p + self.half], ()):
                if i not in found and self._long(text, p, self.quotes[i], at):
                    found.add(i)
        return found


def supported(docs: DataFrame, quotes: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(key, item_id, supported) for every document and every quote.

    More than ``block_bytes`` of quotes take one pass over the documents for each such block.
    A null or blank quote or text supports nothing.
    """
    conf = docs.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > BATCH_ROWS:
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    source = docs.select(F.col(key), quote_norm(F.coalesce(F.col(text), F.lit(""))).alias("__t"))
    items = quotes.select(F.col(item_key).cast("bigint").alias("id"), quote_norm(F.col(item_text)).alias("q"))
    size = items.agg(F.sum(F.octet_length("q"))).first()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    schema = f"`{key}` {source.schema[0].dataType.simpleString()}, item_id bigint, supported boolean"

    def scan(asked: list[tuple[int, str | None]]) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = QuoteIndex([q for _, q in asked])
            ids = pa.array([i for i, _ in asked], pa.int64())
            step = max(1, OUT_ROWS // max(1, len(asked)))
            for whole in batches:
                for low in range(0, whole.num_rows, step):
                    batch = whole.slice(low, step)
                    holds = np.zeros((batch.num_rows, len(asked)), dtype=bool)
                    for row, value in enumerate(batch.column(1).to_pylist()):
                        holds[row, list(index.held(value))] = True
                    rows, columns = np.indices(holds.shape).reshape(2, -1)
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), ids.take(pa.array(columns)), pa.array(holds.ravel())], names=[key, "item_id", "supported"])

        return source.mapInArrow(run, schema)

    result = None
    for i in range(blocks):
        part = items.where(F.pmod(F.xxhash64("id", "q"), F.lit(blocks)) == i) if blocks > 1 else items
        made = scan([(r["id"], r["q"]) for r in part.orderBy("id", "q").collect()])
        result = made if result is None else result.unionByName(made)
    return result
