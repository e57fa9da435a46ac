"""Command line: python -m tidemark query|list|show|mine|extract|judge|report|index|evaluate ...

Messages are CSV files or, by their ending, workbooks.
Commands that ask a model replay recorded replies: JSON lines of message_id, stage, raw.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.evaluate import graded
from tidemark.operators.gates import DomainPack
from tidemark.operators.outcomes import append_new, judged, listing
from tidemark.operators.pipelines import extract, judge
from tidemark.operators.scoring import ReplayScorer
from tidemark.operators.textindex import build_index, with_vectors
from tidemark.plans import catalogue
from tidemark.plans.jobs import GlossaryPlan, build_glossary
from tidemark.session import build_session
from tidemark.sources.readers import read_messages_csv, read_truth, sniff
from tidemark.sources.sinks import export_glossary, marked_csv
from tidemark.sources.workbooks import Sheet, read_messages_xlsx, write_report

REPLIES = "message_id bigint, stage string, raw string"
DECISIONS = "message_id bigint, text string, stage string, is_lead boolean, confidence double, lead_type string, verdict string, rationale string"


def _messages(spark: SparkSession, path: str) -> DataFrame:
    return read_messages_xlsx(spark, path) if path.endswith(".xlsx") else read_messages_csv(spark, path, None)


def main(args: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    commands = parser.add_subparsers(dest="command", required=True)
    one = commands.add_parser("query", help="run a catalogue query over a folder of tables")
    one.add_argument("name", choices=sorted(catalogue.QUERIES))
    one.add_argument("tables")
    one.add_argument("--out")
    show = commands.add_parser("list", help="list or export the entries of a stored glossary")
    show.add_argument("glossary")
    show.add_argument("--least", type=float, default=0.0)
    show.add_argument("--limit", type=int, default=50)
    show.add_argument("--export")
    mine = commands.add_parser("mine", help="candidate terms of messages (dry run of a build)")
    mine.add_argument("messages")
    mine.add_argument("out")
    mine.add_argument("--least", type=int, default=3)
    shown = commands.add_parser("show", help="one entry of a stored glossary")
    shown.add_argument("glossary")
    shown.add_argument("term")
    taken = commands.add_parser("extract", help="decisions of a gated extraction over messages, as JSON lines; a rerun adds what is missing")
    taken.add_argument("messages")
    taken.add_argument("replies")
    taken.add_argument("out")
    taken.add_argument("--signals", default="need,looking for")
    asked = commands.add_parser("judge", help="verdicts on extracted leads, as JSON lines")
    asked.add_argument("decisions")
    asked.add_argument("replies")
    asked.add_argument("out")
    told = commands.add_parser("report", help="leads with their verdicts: a workbook (.xlsx) of leads, all decisions and a summary, or else a CSV of leads")
    told.add_argument("decisions")
    told.add_argument("verdicts")
    told.add_argument("out")
    held = commands.add_parser("index", help="a retrieval index from labelled examples (CSV of text and label)")
    held.add_argument("examples")
    held.add_argument("out")
    grade = commands.add_parser("evaluate", help="decisions (JSON lines) against ground truth (CSV)")
    grade.add_argument("decisions")
    grade.add_argument("truth")
    given = parser.parse_args(args)
    spark = build_session()
    if given.command == "query":
        result = catalogue.QUERIES[given.name](spark, given.tables)
        result.write.mode("overwrite").parquet(given.out) if given.out else result.show(50, truncate=80)
    elif given.command == "list":
        terms = spark.read.parquet(given.glossary)
        export_glossary(terms, given.export, given.least) if given.export else listing(terms, given.least, given.limit).show(given.limit, truncate=60)
    elif given.command == "show":
        spark.read.parquet(given.glossary).where(F.lower("term") == given.term.lower()).show(1, truncate=False, vertical=True)
    elif given.command == "extract":
        scorer = ReplayScorer(spark.read.schema(REPLIES).json(given.replies))
        pack = DomainPack(signals=tuple(w for w in given.signals.split(",") if w))
        rows = extract(_messages(spark, given.messages).where("message_id is not null").select("message_id", "text"), pack, scorer)
        print(append_new(rows, given.out, "message_id"))
    elif given.command == "judge":
        rows = judge(spark.read.schema(DECISIONS).json(given.decisions), ReplayScorer(spark.read.schema(REPLIES).json(given.replies)))
        print(append_new(rows.where("is_lead").select("message_id", "verdict"), given.out, "message_id"))
    elif given.command == "report":
        said = spark.read.schema(DECISIONS).json(given.decisions).drop("verdict")
        verdicts = spark.read.schema("message_id bigint, verdict string").json(given.verdicts).withColumn("judged_at", F.monotonically_increasing_id())
        rows = judged(said, verdicts).withColumn("verdict", F.when(F.col("is_lead"), F.col("verdict")))
        leads = rows.where("is_lead")
        if given.out.endswith(".xlsx"):
            summary = rows.groupBy("stage").agg(F.count(F.lit(1)).alias("messages"), F.avg("confidence").alias("confidence")).orderBy("stage")
            write_report([Sheet("leads", leads.withColumn("__shade", F.col("verdict") == "REAL_LEAD"), "__shade"), Sheet("all", rows.withColumn("__shade", F.col("is_lead")), "__shade"), Sheet("summary", summary)], given.out)
        else:
            marked_csv(leads, given.out)
    elif given.command == "index":
        rows = spark.read.csv(given.examples, sep=sniff(spark, given.examples), header=True, multiLine=True, escape='"')
        known = F.lower(F.trim("label")).isin("true", "1", "yes", "provider", "lead")
        labelled = rows.where("text is not null").select(F.xxhash64("text").alias("id"), "text", F.coalesce(known, F.lit(False)).alias("label")).dropDuplicates(["id"])
        build_index(with_vectors(labelled), given.out, "id")
    elif given.command == "mine":
        build_glossary(_messages(spark, given.messages), GlossaryPlan(least=given.least)).write.mode("overwrite").parquet(given.out)
    else:
        said = spark.read.json(given.decisions).withColumn("__at", F.monotonically_increasing_id())
        graded(said, read_truth(spark, given.truth).withColumnRenamed("is_lead", "actual"), ["__at"]).show()


if __name__ == "__main__":
    main()
