"""Language identification: averaged hashed subword embeddings under a linear softmax.

Every text is lower-cased and read as character 1-, 2- and 3-grams hashed to buckets. The
model averages the buckets' embeddings and applies a softmax, trained in numpy by mini-batch
stochastic gradient descent on a bounded, repeatable sample of labelled rows: at most
``sample`` rows, drawn per language by hash so that rare languages take part. No other limit
holds for the number of languages. Since the
model is linear after averaging, scoring a text of any length is one histogram of its grams
times a (buckets x languages) table; long texts are counted in chunks.

Calibrated rejection: every row of the sample is scored by a model that didn't see it (five
folds), a temperature is fitted on these scores by likelihood, and the threshold is the
score below which only ``reject_share`` of the correct ones fall: the share of right answers
that rejection may cost (less in fact, as the final model has learned from more rows). Rejected
texts keep their best language in ``lang_pred`` and are marked in ``rejected``.

Edge cases: null texts and texts without a letter are ``und`` with score 0 and rejected;
rows with null lang or null id are never learned from; with no labelled row at all every
text is ``und``; repeated rows each get a row; lang, source and id are never inputs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, fold, map_texts
from tidemark.session import cut, dimension, table

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
SAMPLE = 3000
CHUNK = 1 << 20
FOLDS, HELD = 4, 2
REJECT_SHARE = 0.002
CALIBRATION_FOLDS = 5


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def gram_counts(text: str) -> np.ndarray:
    """How often each bucket occurs among the character 1-, 2- and 3-grams of the text's words.

    Runs of anything but letters count as one space, so digits, symbols and layout say
    nothing. Letters are a-z and what lies above them outside the symbol blocks.
    """
    total = np.zeros(BUCKETS, dtype=np.int64)
    lowered = text.lower()
    shift = np.uint32(32 - BUCKET_BITS)
    carry = np.array([32], dtype=np.uint32)  # the last kept codes, at first a word's border
    for at in range(0, len(lowered), CHUNK):
        codes = np.frombuffer(lowered[at : at + CHUNK].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        letters = ((codes >= 97) & (codes <= 122)) | ((codes >= 0xC0) & ((codes < 0x2000) | (codes > 0x2BFF)))
        codes = np.where(letters, codes, np.uint32(32))
        border = codes == 32
        after = np.concatenate(([carry[-1] == 32], border[:-1]))
        chain = np.concatenate((carry, codes[~(border & after)]))
        new = len(carry)
        one = chain * np.uint32(2654435761)
        two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * np.uint32(2246822519) + chain[1:]
        two *= np.uint32(3266489917)
        three = (two[:-1] ^ (two[:-1] >> np.uint32(13))) * np.uint32(668265263) + chain[2:]
        three *= np.uint32(374761393)
        for grams in (one[new:], two[new - 1 :], three[max(0, new - 2) :]):
            total += np.bincount(grams >> shift, minlength=BUCKETS)
        carry = chain[-2:]
    return total


@dataclass
class LanguageModel:
    languages: list[str]
    table: np.ndarray  # buckets x languages: embeddings times output weights
    bias: np.ndarray
    temperature: float
    threshold: float

    def score(self, text: str | None) -> tuple[str, float, bool]:
        """(language, calibrated probability, rejected)."""
        if not self.languages or not has_letter(text):
            return "und", 0.0, True
        counts = gram_counts(text)
        chances = softmax((counts @ self.table / max(1, counts.sum()) + self.bias) / self.temperature)
        best = int(np.argmax(chances))
        return self.languages[best], float(chances[best]), bool(chances[best] < self.threshold)


def softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return raised / raised.sum(axis=-1, keepdims=True)


def fit(shares: np.ndarray, labels: list[str], dim: int = 24, epochs: int = 30, rate: float = 2.0, reject_share: float = REJECT_SHARE) -> LanguageModel:
    """Train on gram shares (rows x buckets, float32) by stochastic gradient descent, then calibrate."""
    languages = sorted(set(labels))
    if not languages:
        return LanguageModel([], np.zeros((BUCKETS, 0)), np.zeros(0), 1.0, 0.0)
    truth = np.searchsorted(languages, labels)
    classes, rows = len(languages), np.arange(len(truth))
    fold_of = np.random.default_rng(5).permutation(len(truth)) % CALIBRATION_FOLDS
    used = np.flatnonzero(shares.any(axis=0))  # other grams keep the embedding zero
    shares = np.ascontiguousarray(shares[:, used])
    logits = np.zeros((len(truth), classes))
    for fold in range(CALIBRATION_FOLDS):
        aside, own = rows[fold_of == fold], rows[fold_of != fold]
        if len(aside):
            merged, bias = _descend(shares, truth, own if len(own) else aside, classes, dim, epochs, rate)
            logits[aside] = shares[aside] @ merged + bias
    grid = np.geomspace(0.2, 5, 41)
    losses = [-np.log(softmax(logits / t)[rows, truth] + 1e-12).mean() for t in grid]
    temperature = float(grid[int(np.argmin(losses))])
    chances = softmax(logits / temperature)
    sure = chances.max(axis=1)[np.argmax(chances, axis=1) == truth]
    threshold = float(np.quantile(sure, reject_share)) if len(sure) else 0.0
    table = np.zeros((BUCKETS, classes))
    table[used], bias = _descend(shares, truth, rows, classes, dim, epochs, rate)
    return LanguageModel(languages, table, bias, temperature, threshold)


def _descend(shares: np.ndarray, truth: np.ndarray, own: np.ndarray, classes: int, dim: int, epochs: int, rate: float) -> tuple[np.ndarray, np.ndarray]:
    """(embeddings times output weights, bias) after mini-batch descent on the rows ``own``."""
    random = np.random.default_rng(7)
    weight = 1.0 / np.maximum(1, np.bincount(truth[own], minlength=classes))
    weight /= weight[truth[own]].mean()
    embed = np.zeros((shares.shape[1], dim), dtype=np.float32)  # grams never seen say nothing
    out = random.normal(0, 0.3, (dim, classes)).astype(np.float32)
    bias = np.zeros(classes, dtype=np.float32)
    for epoch in range(epochs):
        step = rate * (1 - epoch / epochs)
        shuffled = random.permutation(own)
        for at in range(0, len(shuffled), 32):
            rows = shuffled[at : at + 32]
            x = shares[rows]
            hidden = x @ embed
            error = softmax(hidden @ out + bias)
            error[np.arange(len(rows)), truth[rows]] -= 1
            error *= weight[truth[rows]][:, None].astype(np.float32) / len(rows)
            back = error @ out.T
            out -= step * (hidden.T @ error)
            bias -= step * error.sum(axis=0)
            embed -= step * 20 * (x.T @ back)  # a bucket's share is small; its own larger rate
    return (embed @ out).astype(np.float64), bias.astype(np.float64)


def labelled_sample(docs: DataFrame, key: str, text: str, label: str, rows: int) -> DataFrame:
    """At most about ``rows`` labelled rows outside the held-out fold, spread over the languages."""
    ids = docs.where(F.col(label).isNotNull() & F.col(text).isNotNull() & (fold(key, FOLDS) != HELD)).select(key, F.col(label).alias("label"))
    sizes = cut(ids.groupBy(F.col("label").alias("__label")).agg(F.count(F.lit(1)).alias("n")), "lang-sizes")
    each = max(1, rows // max(1, sizes.count()))
    unit = F.pmod(F.xxhash64(F.col(key), F.lit(29)), F.lit(1 << 40))
    ids = ids.join(dimension(sizes), F.col("label") == F.col("__label"))
    limit = F.lit(float(1 << 40)) * F.least(F.lit(1.0), F.lit(float(each)) / F.col("n"))
    chosen = ids.where(unit <= limit).orderBy(unit, key).limit(rows).select(F.col(key).alias("__id")).distinct()
    return docs.select(key, text, label).join(F.broadcast(chosen), F.col(key) == F.col("__id"), "left_semi")  # at most `rows` ids


def train(docs: DataFrame, key: str = "doc_id", text: str = "text", label: str = "lang", sample: int = SAMPLE) -> LanguageModel:
    """Fit on a bounded sample; executors send gram counts, never texts."""
    picked = labelled_sample(docs, key, text, label, sample)

    def rows(texts: list[bytes | None]) -> list[pa.Array]:
        made = []
        for text in texts:
            value = text.decode("utf-8", "replace") if text else ""
            counts = gram_counts(value) if has_letter(value) else np.zeros(BUCKETS, dtype=np.int64)
            used = np.flatnonzero(counts)
            pairs = np.stack((used, np.minimum(counts[used], 2**31 - 1))).astype(np.int32)
            made.append(pairs.T.ravel())
        return [pa.array(made, pa.list_(pa.int32()))]

    counted = map_texts(picked, [key, label], text, "grams array<int>", rows).where(F.size("grams") > 0)
    seen = counted.orderBy(F.xxhash64(key, F.lit(31)), key).limit(sample).select(label, "grams").toArrow()
    grams = seen.column("grams").combine_chunks() if seen.num_rows else []
    shares = np.zeros((seen.num_rows, BUCKETS), dtype=np.float32)
    for i in range(seen.num_rows):
        pairs = grams[i].values.to_numpy().reshape(-1, 2)
        shares[i, pairs[:, 0]] = pairs[:, 1] / pairs[:, 1].sum(dtype=np.float64)
    return fit(shares, seen.column(label).to_pylist())


def identify(docs: DataFrame, model: LanguageModel, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, lang_pred, score, rejected) for every document."""

    def rows(texts: list[bytes | None]) -> list[pa.Array]:
        found = [model.score(t.decode("utf-8", "replace") if t is not None else None) for t in texts]
        lang, score, rejected = zip(*found, strict=True)
        return [pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(rejected, pa.bool_())]

    scored = map_texts(docs, [key], text, "lang_pred string, score double, rejected boolean", rows)
    held = F.coalesce(fold(key, FOLDS) == HELD, F.lit(False))
    return scored.select(key, held.alias("held_out"), "lang_pred", "score", "rejected")


def keep_identified(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents whose language is not rejected; all columns stay, nothing is shuffled."""
    model = train(docs)

    def sure(texts: pa.Array) -> pa.Array:
        return pa.array([not model.score(t.as_py())[2] for t in texts], pa.bool_())

    return bounded_batches(docs).where(F.arrow_udf(sure, "boolean")(F.col(text)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return identify(docs, train(docs))
