"""Readers for the message, glossary and label formats."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import is_blank, norm_key, ustrip
from tidemark.session import cut

MESSAGE_COLUMNS = {"message_id": "bigint", "date": "timestamp", "text": "string", "group_id": "bigint", "user_id": "bigint", "username": "string", "first_name": "string", "last_name": "string"}
#: Columns that a corpus may have besides; absent ones are left out.
OPTIONAL_COLUMNS = {"phone": "string", "reply_to_msg_id": "bigint"}
#: What counts as a true label.
TRUTHY = ("1", "true", "yes", "y", "t", "lead")
DATE_FORMATS = ("yyyy-MM-dd HH:mm:ss", "dd.MM.yyyy HH:mm")


def messages_of(raw: DataFrame, only_with_text: bool = True) -> DataFrame:
    """Lenient casts by header name in any case; bad numbers and dates become null, missing columns too."""
    named = {c.strip().lower().lstrip("﻿"): c for c in raw.columns}
    if missing := {"message_id", "text"} - set(named):
        raise ValueError(f"no column {sorted(missing)}")
    columns = []
    for name, kind in {**MESSAGE_COLUMNS, **{n: k for n, k in OPTIONAL_COLUMNS.items() if n in named}}.items():
        if name not in named:
            columns.append(F.lit(None).cast(kind).alias(name))
            continue
        value = F.col(f"`{named[name]}`").cast("string")
        if kind == "timestamp":
            made = F.coalesce(*[F.try_to_timestamp(value, F.lit(f)) for f in DATE_FORMATS], value.try_cast("timestamp"))
        elif kind == "bigint":
            made = F.coalesce(value.try_cast("bigint"), value.try_cast("double").try_cast("bigint"))
        else:
            made = F.when(~is_blank(value), value)
        columns.append(made.alias(name))
    rows = raw.select(*columns)
    return rows.where("text is not null") if only_with_text else rows


def read_messages_csv(spark: SparkSession, path: str, sep: str | None = ";") -> DataFrame:
    """A message CSV with header; ``sep=None`` sniffs the delimiter."""
    return messages_of(spark.read.csv(path, sep=sep or sniff(spark, path), header=True, encoding="UTF-8", multiLine=True, escape='"'))


def sniff(spark: SparkSession, path: str, choices: str = ";,\t|") -> str:
    """The commonest delimiter of the header line."""
    head = spark.read.text(path).first()
    line = head[0] if head else ""
    return max(choices, key=line.count)


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; malformed ones are dropped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(value): stripped lines without blanks and # comments, such as ban and pattern lists."""
    lines = spark.read.text(path).select(ustrip(F.col("value")).alias("value"))
    return lines.where((F.col("value") != "") & ~F.startswith("value", F.lit("#")))


def read_json_config(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path, multiLine=True)


def truth_of(raw: DataFrame) -> DataFrame:
    """(message_id, is_lead) from whichever id and label columns there are."""
    ids = [c for c in ("message_id", "id") if c in raw.columns]
    labels = [c for c in ("is_lead", "lead", "label") if c in raw.columns]
    if not ids or not labels:
        raise ValueError("no id or label column")
    value = norm_key(F.coalesce(*[F.col(c).cast("string") for c in labels]))
    key = F.coalesce(*[F.col(c).cast("string").try_cast("bigint") for c in ids])
    return raw.select(key.alias("message_id"), F.coalesce(value.isin(*TRUTHY), F.lit(False)).alias("is_lead")).where("message_id is not null")


def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Ground truth from a CSV, or from JSON: an object of id to label, or a list of objects.

    Label files are small (a person wrote them); a JSON one is a single document.
    """
    if not path.endswith(".json"):
        return truth_of(spark.read.csv(path, sep=sniff(spark, path), header=True))
    whole = spark.read.text(path, wholetext=True)
    pairs = F.from_json("value", "map<string,string>")
    listed = F.from_json("value", "array<struct<message_id:string,id:string,is_lead:string,lead:string,label:string>>")
    is_list = F.startswith(ustrip(F.col("value")), F.lit("["))
    rows = whole.where(~is_list).select(F.explode(pairs).alias("id", "label"))
    items = whole.where(is_list).select(F.explode(listed).alias("e")).select(F.coalesce("e.message_id", "e.id").alias("id"), F.coalesce("e.is_lead", "e.lead", "e.label").alias("label"))
    return truth_of(rows.unionByName(items))


def read_sqlite(spark: SparkSession, path: str, table: str, arrays: Sequence[str] = ("surface_forms",), batch: int = 10_000) -> DataFrame:
    """A table of an SQLite file; ``arrays`` names columns that hold JSON lists.

    The file is read on the driver in batches and written to the shared folder, so a large
    glossary is never whole in memory. Every value arrives as text, but for the lists.
    """
    import sqlite3

    if not table.replace("_", "").isalnum():
        raise ValueError(f"no table name: {table!r}")
    with sqlite3.connect(f"file:{path}?mode=ro", uri=True) as base:
        cursor = base.execute(f'SELECT * FROM "{table}"')  # the name was checked
        names = [d[0] for d in cursor.description]
        schema = ", ".join(f"`{n}` string" for n in names)
        made = None
        while rows := cursor.fetchmany(batch):
            text = [tuple(None if v is None else str(v) for v in r) for r in rows]
            part = cut(spark.createDataFrame(text, schema), "sqlite")
            made = part if made is None else made.unionByName(part)
    made = spark.createDataFrame([], schema) if made is None else made
    return made.withColumns({n: F.from_json(n, "array<string>") for n in arrays if n in names})


def sqlite_glossary(spark: SparkSession, path: str, enriched: str, raw: str, least: float | None = None, generic: Sequence[str] = ()) -> DataFrame:
    """(term) of a glossary file: the enriched table where it has rows, else the raw one."""

    def typed(name: str) -> DataFrame:
        rows = read_sqlite(spark, path, name)
        missing = {c: F.lit(None).cast("string") for c in ("confidence",) if c not in rows.columns}
        return rows.withColumns(missing).withColumns({"relevant": F.lower("relevant").isin("1", "true"), "confidence": F.col("confidence").try_cast("double")})

    return glossary_terms(typed(enriched), typed(raw), least, generic)


def glossary_terms(enriched: DataFrame | None, raw: DataFrame | None, least: float | None = None, generic: Sequence[str] = ()) -> DataFrame:
    """(term): relevant terms and surface forms, lower-cased; the raw glossary where the enriched one is empty."""
    source = raw if enriched is None or enriched.isEmpty() else enriched
    kept = source.where("relevant")
    kept = kept.where(F.col("confidence") >= least) if least is not None else kept
    forms = F.concat(F.array("term"), F.coalesce("surface_forms", F.array().cast("array<string>")))
    terms = kept.select(F.explode(forms).alias("t")).select(norm_key(F.col("t")).alias("term")).where("term <> ''").distinct()
    return terms.where(~F.col("term").isin(*generic)) if generic else terms


def with_senses(terms: DataFrame) -> DataFrame:
    """Entries by falling frequency; those without senses get one that is the term itself."""
    own = F.array(F.struct(F.col("term").alias("definition"), F.array().cast("array<string>").alias("context_clues"), F.array().cast("array<bigint>").alias("example_message_ids")))
    return terms.withColumn("senses", F.when(F.size(F.coalesce("senses", F.array().cast(terms.schema["senses"].dataType))) > 0, F.col("senses")).otherwise(own.cast(terms.schema["senses"].dataType))).orderBy(F.desc("frequency"), "term")
