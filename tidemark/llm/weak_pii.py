"""Personal data by weak supervision, in DataFrame functions alone.

Fixed base rules find e-mail addresses, IP numbers, payment cards and telephone numbers;
their spans always stand. Looser patterns propose further candidates of the same kinds
(addresses with a spelled-out ``at``, long-form network addresses, numbers without a country
prefix, and card or telephone numbers that a neighbouring number runs into, so that the base
rule's longest match has too many digits and is dropped). Five labelers vote +1, 0 or -1 on every candidate,
base ones included: the strict rule, a gazetteer (address endings, set-aside networks, issuer
prefixes with their lengths, calling codes), context words before the span, the span's shape, and the characters beside it.

Expectation-maximisation estimates each labeler's vote distribution given "is personal" and
"is not" from vote-pattern counts (at most kinds x 3^5 x buckets rows reach the driver,
whatever the corpus), and a logistic span classifier is trained on the posteriors with the
votes and surface features as inputs. Its weights return to Spark as a plain expression.

Texts are scanned once. Candidates, reduced to offsets and votes, are written to the shared
folder; both the counting and the final decision read them from there. No shuffle but that
of the pattern counts.

Offsets are code points, end exclusive. Patterns use possessive loops and look-behind so
that long runs of word characters or digits cost linear time and no regex stack.

Edge cases: null text is empty and has no span; repeated rows each get a row; an empty
table or one without candidates yields no model and only base spans; other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tidemark.session import cut, table

KINDS = ("email", "ip", "card", "phone")
#: What the base definitions find, in linear time: a match begins where a run begins or the last match ended.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9]){12,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[({]at[\])}]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[({]dot[\])}]\x20?)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:(?:[0-9]{4}[\x20-]?){3}[0-9]{4}|[0-9]{4}[\x20-]?[0-9]{6}[\x20-]?[0-9]{5}|[0-9]{13,19})(?![0-9])",
    "phone": r"\+1[\x20.-]?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-]?[0-9]{4}(?![0-9])"
    r"|\+[2-9][0-9]{0,2}(?:[\x20.-]?(?:\([0-9]{1,4}\)|[0-9]{2,4})){2,4}(?![0-9])"
    r"|(?<![0-9+().-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}
#: A text without any of these has no candidate.
SIGN = r"[0-9@]|[\[({]at[\])}]"
#: Gazetteers. Address endings: any country code (two letters) or one of these generic ones.
GENERIC_ENDINGS = (
    "com", "net", "org", "edu", "gov", "mil", "int", "info", "biz", "name", "pro", "mobi", "aero", "coop", "museum",
    "jobs", "travel", "tel", "asia", "cat", "post", "app", "dev", "cloud", "online", "site", "store", "shop", "tech",
    "xyz", "blog", "email", "live", "club", "agency", "company", "digital", "group", "media", "news", "space", "studio",
)
#: Country codes of two letters that are assigned to no country and no other use.
UNUSED_COUNTRIES = "aa|q[m-z]|x[a-z]|zz"
#: First network octets that are set aside: this network, loop-back, multicast and reserved.
RESERVED_OCTETS = "0|127|22[4-9]|2[34][0-9]|25[0-5]"
#: Issuer prefixes with the lengths that the issuer gives out.
ISSUERS = (
    (r"4", (13, 16, 19)),
    (r"5[1-5]|222[1-9]|22[3-9]|2[3-6]|27[01]|2720", (16,)),
    (r"3[47]", (15,)),
    (r"30[0-5]|309|36|3[89]", (14, 15, 16, 17, 18, 19)),
    (r"6011|64[4-9]|65", (16, 17, 18, 19)),
    (r"62|81", (16, 17, 18, 19)),
    (r"352[89]|35[3-8]", (16, 17, 18, 19)),
    (r"50|5[6-9]|6[0137-9]", (12, 13, 14, 15, 16, 17, 18, 19)),
    (r"220[0-4]", (16, 17, 18, 19)),
)
#: Country calling codes by their length.
CALLING = (
    r"1[2-9]|7[3-9]",
    r"2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]",
    r"21[12368]|22[0-9]|23[0-9]|24[0-9]|25[0-8]|26[0-9]|29[01789]|35[0-9]|37[0-8]|38[0-35-79]|42[013]|50[0-9]|59[0-9]|67[02-9]|68[0-35-9]|69[0-2]|85[02356]|88[06]|96[0-8]|97[0-7]|99[2-68]",
)
#: Words that announce a kind, and words that announce some other number.
ANNOUNCES = {
    "email": r"mail|contact|write|kontakt|correo|courriel",
    "ip": r"\bip|host|server|addr|login|client",
    "card": r"card|visa|credit|karte|tarjeta|carte|debit",
    "phone": r"phone|tel|call|mobil|fax|anruf|llam|appel",
}
OTHERWISE = r"version|isbn|order|invoice|serial|sku|build|release|ticket|section"
VOTES = ("rule", "gazetteer", "context", "shape", "edge")
BLOCK = 64
#: Code points in a chunk of a text that is redacted.
CHUNK = 1024
ACCEPT = 0.9
CANDIDATES = "array<struct<kind:int,start:int,end:int,base:boolean,rule:int,gazetteer:int,context:int,shape:int,edge:int,size:int>>"


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def located(text: Column, pattern: str, kind: str, judge) -> Column:
    """``judge`` of each leftmost non-overlapping match: an array of its structs.

    Offsets come from the lengths of matches and of the pieces between them, summed in two
    levels so that many matches don't cost their square. One-element transforms bind the
    intermediate arrays to names, so that each is computed once.
    """

    def steps(s: Column) -> Column:
        made = F.transform(s["found"], lambda m, i: F.length(F.get(s["pieces"], i)) + F.length(m))
        return F.struct(s["found"].alias("found"), s["pieces"].alias("pieces"), made.alias("steps"))

    def sums(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.greatest(F.size(s["steps"]) - 1, F.lit(0)).bitwiseAND(F.lit(~(BLOCK - 1))), F.lit(BLOCK))
        made = F.transform(blocks, lambda b: _total(F.slice(s["steps"], b + 1, F.lit(BLOCK))))
        return F.struct(s["found"].alias("found"), s["pieces"].alias("pieces"), s["steps"].alias("steps"), made.alias("sums"))

    def spans(s: Column) -> Column:
        def one(m: Column, i: Column) -> Column:
            low = i.bitwiseAND(F.lit(~(BLOCK - 1)))
            done = _total(F.slice(s["sums"], F.lit(1), F.shiftright(i, 6))) + _total(F.slice(s["steps"], low + 1, i - low))
            piece = F.get(s["pieces"], i)
            start = done + F.length(piece)
            near = F.lower(F.substring(piece, F.greatest(F.length(piece) - 39, F.lit(1)), F.lit(40)))
            left = F.substring(piece, F.greatest(F.length(piece), F.lit(1)), F.lit(1))
            return judge(start, start + F.length(m), m, near, left, F.substring(F.get(s["pieces"], i + 1), 1, 1))

        return F.transform(s["found"], one)

    first = F.array(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.split(text, pattern, -1).alias("pieces")))
    whole = F.transform(F.transform(F.transform(first, steps), sums), spans)
    return F.when(F.rlike(text, F.lit(pattern)), F.get(whole, 0)).otherwise(F.array().cast(CANDIDATES))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the check-sum from its right end."""

    def add(total: Column, i: Column) -> Column:
        digit = F.ascii(F.substring(digits, F.length(digits) - i + 1, F.lit(1))) - 48
        twice = digit * 2 - F.when(digit > 4, F.lit(9)).otherwise(F.lit(0))
        return total + F.when(i % 2 == 0, twice).otherwise(digit)

    return (F.length(digits) > 0) & (F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(digits), F.lit(1))), F.lit(0), add) % 10 == 0)


def ip_parts_ok(value: Column) -> Column:
    """Every dot-separated part is at most 255, however many zeros lead it."""
    return F.forall(F.split(value, r"\."), lambda p: F.rlike(p, F.lit("^0*(?:[0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$")))


def _sign(yes: Column, no: Column) -> Column:
    return F.when(yes, F.lit(1)).when(no, F.lit(-1)).otherwise(F.lit(0))


def _judge(kind: str, strict: bool):
    """Votes on one candidate, and whether it is a base span."""

    def votes(start: Column, end: Column, value: Column, near: Column, left: Column, right: Column) -> Column:
        digits = digits_of(value)
        n = F.length(digits)
        if kind == "email":
            rule = F.rlike(value, F.lit(r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+$"))
            base, rule = F.lit(strict), _sign(rule, F.lit(False))
            known = F.rlike(F.lower(F.regexp_extract(value, r"([A-Za-z]+)$", 1)), F.lit(rf"^(?:(?!(?:{UNUSED_COUNTRIES})$)[a-z]{{2}}|{'|'.join(GENERIC_ENDINGS)})$"))
            shape = _sign(~F.rlike(value, F.lit(r"\.\.|^\.|\.@|@-")), F.lit(True))
        elif kind == "ip":
            base = F.lit(strict) & ip_parts_ok(value)
            rule = _sign(base, F.lit(strict))
            known = ~F.rlike(value, F.lit(rf"^0*(?:{RESERVED_OCTETS})\.|^0+:"))
            shape = _sign(~F.rlike(value, F.lit(r"(?:^|\.)0[0-9]")), F.lit(True))
        elif kind == "card":
            passes = luhn(digits)
            base = F.lit(strict) & n.between(14, 19) & passes
            rule = _sign(n.between(13, 19) & passes, F.lit(True))
            known = F.lit(False)
            for prefix, sizes in ISSUERS:
                known = known | (n.isin(*sizes) & F.rlike(digits, F.lit(f"^(?:{prefix})")))
            shape = _sign(n.isin(15, 16), F.lit(True))
        else:
            base = F.lit(strict) & n.between(10, 15)
            rule = _sign(value.startswith("+") & n.between(10, 15), ~n.between(10, 15))
            dialled = F.rlike(digits, F.lit(rf"^(?:{CALLING[0]})[0-9]{{9}}$|^(?:{CALLING[1]})[0-9]{{6,13}}$|^(?:{CALLING[2]})[0-9]{{5,12}}$"))
            known = F.when(value.startswith("+"), dialled).otherwise(F.rlike(digits, F.lit("^[2-9][0-9]{9}$")))
            shape = _sign(F.rlike(value, F.lit(r"\(|[0-9][\x20.-][0-9]")) & n.between(10, 12), ~n.between(10, 15))
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"),
            start.cast("int").alias("start"),
            end.cast("int").alias("end"),
            base.alias("base"),
            rule.alias("rule"),
            _sign(known, F.lit(True)).alias("gazetteer"),
            _sign(F.rlike(near, F.lit(ANNOUNCES[kind])), F.rlike(near, F.lit(OTHERWISE))).alias("context"),
            shape.alias("shape"),
            _sign(
                F.rlike(left, F.lit(r"^$|[\s(\[{<\x22':;,=]")) & F.rlike(right, F.lit(r"^$|[\s)\]}>\x22':;,.!?]")),
                F.rlike(left, F.lit(r"[\p{L}\p{N}]")) | F.rlike(right, F.lit(r"[\p{L}\p{N}]")),
            ).alias("edge"),
            F.least(F.shiftright(F.length(value), 2), F.lit(7)).alias("size"),
        )

    return votes


def candidates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, found): every base match and every loose one that no base span of its kind overlaps."""
    value = F.coalesce(F.col(text), F.lit(""))
    strict = [located(value, BASE[kind], kind, _judge(kind, True)) for kind in KINDS]
    loose = [located(value, LOOSE[kind], kind, _judge(kind, False)) for kind in KINDS]
    empty = F.array().cast(CANDIDATES)
    gate = F.rlike(value, F.lit(SIGN))
    rows = docs.select(
        key,
        F.when(gate, F.concat(*strict)).otherwise(empty).alias("strict"),
        F.when(gate, F.concat(*loose)).otherwise(empty).alias("loose"),
    )
    rows = rows.withColumn("base", F.filter("strict", lambda c: c["base"]))
    return rows.select(key, F.concat("base", F.when(F.size("loose") > 0, free(F.col("base"), F.col("loose"))).otherwise(empty)).alias("found"))


def free(base: Column, loose: Column) -> Column:
    """The loose candidates that no base span of their kind overlaps.

    Base spans of a kind don't overlap, so in order of kind and start their ends rise too: the
    first that ends after a candidate's start is in the first block whose last one does. Only
    that block is searched, so many spans in a text don't cost their square.
    """

    def place(kind: Column, at: Column) -> Column:
        return F.shiftleft(kind.cast("bigint"), 40) + at

    def tops(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), (F.size(s["held"]) - 1).bitwiseAND(F.lit(~(BLOCK - 1))), F.lit(BLOCK))
        made = F.transform(blocks, lambda b: F.get(s["held"], F.least(b + BLOCK, F.size(s["held"])) - 1)["end"])
        return F.struct(s["held"].alias("held"), made.alias("tops"))

    def kept(s: Column) -> Column:
        def clear(c: Column) -> Column:
            start, end = place(c["kind"], c["start"]), place(c["kind"], c["end"])
            block = F.size(F.filter(s["tops"], lambda t: t <= start))
            near = F.slice(s["held"], block * BLOCK + 1, F.lit(BLOCK))
            return ~F.exists(near, lambda b: (b["end"] > start) & (b["start"] < end))

        return F.filter(loose, clear)

    held = F.array_sort(F.transform(base, lambda b: F.struct(place(b["kind"], b["start"]).alias("start"), place(b["kind"], b["end"]).alias("end"))))
    whole = F.transform(F.transform(F.array(F.struct(held.alias("held"))), tops), kept)
    return F.when(F.size(base) > 0, F.get(whole, 0)).otherwise(loose)


def expectation_maximisation(votes: np.ndarray, kinds: np.ndarray, counts: np.ndarray, rounds: int = 60) -> np.ndarray:
    """Posterior of "is personal" for each vote pattern, votes in -1, 0, 1 by labeler.

    Smoothed towards labelers that are better than chance, which also fixes which class is which.
    """
    labelers = votes.shape[1]
    belief = 1 / (1 + np.exp(-votes.sum(axis=1)))
    trust = np.array([[2.0, 2.0, 1.0], [1.0, 2.0, 4.0]]) * 4  # pseudo-counts of votes -1, 0, 1 given no, given yes
    for _ in range(rounds):
        log = np.zeros((len(votes), 2))
        for side, weight in enumerate((1 - belief, belief)):
            mass = weight * counts
            for kind in np.unique(kinds):
                here = kinds == kind
                log[here, side] += np.log((mass[here].sum() + 2) / (counts[here].sum() + 4))
            for k in range(labelers):
                seen = np.bincount(votes[:, k] + 1, mass, 3) + trust[side]
                log[:, side] += np.log(seen / seen.sum())[votes[:, k] + 1]
        after = 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -40, 40)))
        if np.abs(after - belief).max() < 1e-9:
            break
        belief = after
    return belief


def _features(votes: np.ndarray, kinds: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    columns = [np.ones(len(votes))]
    for k in range(votes.shape[1]):
        columns += [votes[:, k] == 1, votes[:, k] == -1]
    columns += [kinds == k for k in range(len(KINDS))]
    columns.append(sizes / 8)
    return np.stack(columns, axis=1).astype(np.float64)


def fit_classifier(x: np.ndarray, target: np.ndarray, counts: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> np.ndarray:
    """Logistic regression on soft targets, by Newton steps.

    Above 1e6 all counts are scaled alike, so the patterns keep their proportions.
    """
    weights = np.zeros(x.shape[1])
    mass = counts * min(1.0, 1e6 / counts.max())
    for _ in range(rounds):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        slope = x.T @ (mass * (target - chance)) - ridge * weights
        curve = (x * (mass * chance * (1 - chance))[:, None]).T @ x + ridge * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        weights += step * min(1.0, 5.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return weights


def train(found: DataFrame) -> np.ndarray | None:
    """Classifier weights from the vote patterns of all candidates; None without any."""
    one = found.select(F.explode("found").alias("c")).select("c.*")
    rows: Sequence[Row] = one.groupBy("kind", *VOTES, "size").agg(F.count(F.lit(1)).alias("n")).orderBy("kind", *VOTES, "size").collect()
    if not rows:
        return None
    votes = np.array([[r[v] for v in VOTES] for r in rows], dtype=np.int64)
    kinds, sizes = np.array([r["kind"] for r in rows]), np.array([r["size"] for r in rows])
    counts = np.array([r["n"] for r in rows], dtype=np.float64)
    belief = expectation_maximisation(votes, kinds, counts)
    return fit_classifier(_features(votes, kinds, sizes), belief, counts)


def chance(c: Column, weights: np.ndarray) -> Column:
    """The classifier as an expression over a candidate struct."""
    w = [float(x) for x in weights]
    total = F.lit(w[0])
    for k, name in enumerate(VOTES):
        total = total + F.when(c[name] == 1, F.lit(w[1 + 2 * k])).when(c[name] == -1, F.lit(w[2 + 2 * k])).otherwise(F.lit(0.0))
    own = F.lit(0.0)
    for k in range(len(KINDS)):
        own = F.when(c["kind"] == k, F.lit(w[11 + k])).otherwise(own)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-(total + own + c["size"] / F.lit(8.0) * F.lit(w[15]))))


def decide(found: DataFrame, weights: np.ndarray | None, accept: float = ACCEPT) -> DataFrame:
    """The candidates kept, ordered by start and kind: all base ones and those the classifier accepts."""

    def keep(c: Column) -> Column:
        return c["base"] if weights is None else c["base"] | (chance(c, weights) >= F.lit(accept))

    kept = F.filter("found", keep)
    order = F.array_sort(F.transform(kept, lambda c: F.struct(c["start"], c["kind"], c["end"], c["base"])))
    return found.withColumn("found", order)


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", F.get(names, c["kind"]), c["start"].cast("string"), c["end"].cast("string"))), ",")


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_added) for every document; counts are of base spans."""
    found = cut(candidates(docs, key, text), "pii")
    kept = decide(found, train(found), accept)
    base = F.filter("found", lambda c: c["base"])

    def count(number: int) -> Column:
        return F.size(F.filter("base", lambda c: c["kind"] == number)).cast("bigint")

    return kept.select(key, "found", base.alias("base")).select(
        key,
        *[count(i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)],
        F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        _joined(F.col("found")).alias("spans"),
        (F.size("found") - F.size("base")).cast("bigint").alias("n_added"),
    )


def redacted(text: Column, spans: Column) -> Column:
    """The text with every kept span replaced by its kind; overlapping spans make one replacement.

    A substring by code points walks from the text's start, so the text is first cut into
    chunks; many spans in a long text then cost their number, not their number times its length.
    """
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def between(chunks: Column, a: Column, b: Column) -> Column:
        first, last = F.floor(a / F.lit(CHUNK)).cast("int"), F.floor(b / F.lit(CHUNK)).cast("int")
        head, tail = F.coalesce(F.get(chunks, first), F.lit("")), F.coalesce(F.get(chunks, last), F.lit(""))
        inner = F.array_join(F.slice(chunks, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        across = F.concat(F.substring(head, a % CHUNK + 1, F.lit(CHUNK)), inner, F.substring(tail, F.lit(1), b % CHUNK))
        return F.when(first == last, F.substring(head, a % CHUNK + 1, b - a)).otherwise(across)

    def tops(s: Column) -> Column:
        blocks = F.sequence(F.lit(0), (F.size(s["ends"]) - 1).bitwiseAND(F.lit(~(BLOCK - 1))), F.lit(BLOCK))
        made = F.transform(blocks, lambda b: F.array_max(F.slice(s["ends"], b + 1, F.lit(BLOCK))))
        return F.struct(s["chunks"].alias("chunks"), s["ends"].alias("ends"), made.alias("tops"))

    def join(s: Column) -> Column:
        def gap(c: Column, i: Column) -> Column:
            low = i.bitwiseAND(F.lit(~(BLOCK - 1)))
            before = F.greatest(
                F.array_max(F.slice(s["tops"], F.lit(1), F.shiftright(i, 6))),
                F.array_max(F.slice(s["ends"], low + 1, i - low)),
                F.lit(0),
            )
            return F.struct(before.alias("from"), c["start"].alias("to"), c["kind"].alias("kind"))

        fresh = F.filter(F.transform(spans, gap), lambda g: g["from"] <= g["to"])
        pieces = F.transform(fresh, lambda g: F.concat(between(s["chunks"], g["from"], g["to"]), F.get(names, g["kind"])))
        rest = between(s["chunks"], F.array_max(s["tops"]), F.length(text))
        return F.array_join(F.concat(pieces, F.array(rest)), "")

    first = F.struct(
        F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}+"), F.lit(0)).alias("chunks"),
        F.transform(spans, lambda c: c["end"]).alias("ends"),
    )
    whole = F.transform(F.transform(F.array(first), tops), join)
    return F.when(F.size(spans) > 0, F.get(whole, 0)).otherwise(text)


def redact(docs: DataFrame, key: str = "doc_id", text: str = "text", accept: float = ACCEPT) -> DataFrame:
    """Every document with its personal data replaced; all columns stay, no document is shuffled.

    A first pass writes candidates to learn from; the second finds them again beside the
    text and replaces what the classifier accepts.
    """
    weights = train(cut(candidates(docs, key, text), "pii"))
    plain = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    spotted = candidates(plain.select("row", F.col(f"row.`{text}`").alias("text")), "row", "text")
    kept = decide(spotted, weights, accept)
    clean = redacted(F.col(f"row.`{text}`"), F.col("found"))
    return kept.select(*[(clean if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect(table(spark, sf_dir, "documents").select("doc_id", "text"))
