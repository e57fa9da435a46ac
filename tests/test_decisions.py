"""Readers, fixed patterns, error isolation, streams and the command line on invented rows."""

from __future__ import annotations

import json
import re
import sqlite3

import pytest
from pyspark.sql import functions as F

from tidemark import __main__ as command
from tidemark import patterns
from tidemark.functions import text
from tidemark.operators import classifiers, context, dedup, evaluate, gates, mining, scoring
from tidemark.sources import readers, sinks, workbooks
from tidemark.streaming.dedup import dedup_stream, upsert_sink

PHRASES = [
    "Открыть счёт в банке для компании", "need a bank account, SEPA or SWIFT", "IBAN database for sale, cash only", "Куплю usdt ежедневно, OTC",
    "buying 500 usdt in person", "запустить казино под ключ, white label", "igaming platform with casino license", "платежный провайдер, эквайринг и процессинг",
    "PSP with high approve rate", "лично, наличные, разовая сделка", "ничего интересного", "", "wise заблокировал счет", "альтернатива Revolut", "EMI license for crypto", "курьер довезёт",
]


@pytest.mark.parametrize("name", ["CASINO", "ACCOUNTS", "NOT_ACCOUNTS", "PROCESSORS", "COINS", "NOT_COINS"])
def test_fixed_patterns_match_as_python_reads_them(spark, name):
    own = getattr(patterns, name)
    rows = spark.createDataFrame(list(enumerate(PHRASES)), "i int, text string")
    got = {r["i"]: r["n"] for r in rows.select("i", text.hit_count(F.col("text"), patterns.ready(own)).alias("n")).collect()}
    assert got == {i: sum(bool(re.search(p, t, re.IGNORECASE)) for p in own) for i, t in enumerate(PHRASES)}
    assert len(set(own)) == len(own) and sum(got.values()) > 0


SAYINGS = [
    ("em_dash_tse", "FTD — це перший депозит"), ("tse", "FTD це перший депозит"), ("tobto", "FTD, тобто перший депозит"), ("oznachaie", "FTD означає перший депозит"),
    ("en_means", "FTD means first deposit"), ("en_stands_for", "FTD stands for first deposit"), ("en_is", "FTD is a first deposit"), ("en_ie", "FTD, i.e. first deposit"),
    ("parenthetical", "FTD (first deposit)"), ("em_dash_eto", "FTD - это первый депозит"), ("eto", "FTD это первый депозит"), ("te", "FTD, т.е. первый депозит"),
    ("pod_imeyu", "под FTD имею в виду первый депозит"), ("rasshifr", "FTD расшифровывается как первый депозит"), ("equals", "FTD = first deposit"), ("aka", "FTD aka first deposit"), ("colon", "FTD: first deposit"),
]


def test_definition_templates(spark):
    rows = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(SAYINGS)] + [(99, "xFTD means nothing here")], "id bigint, text string")
    for i, (label, said) in enumerate(SAYINGS):
        got = mining.self_definitions(rows.where(F.col("id") == i), ["FTD", "other"], "id").collect()
        assert label in [r["pattern"] for r in got], said
    assert mining.self_definitions(rows.where("id = 99"), ["FTD"], "id").count() == 0


def test_brand_patterns(spark):
    said = ["хто працював з Fastpay вчора", "Кто работал с Moneta Ltd", "anyone worked with Stripex here", "Paymix - скам", "провайдер Acmebank ок", "see paymix.io now", "experience with Google only"]
    rows = spark.createDataFrame([(t,) for t in said], "text string")
    made = {r["brand"]: r["contexts"] for r in mining.mine_brands(rows, patterns.brand_patterns(), skip=patterns.NOT_BRANDS).collect()}
    expected = {}
    skipped = {s.lower() for s in patterns.NOT_BRANDS}
    for t in said:
        for label, fold, pattern in patterns.BRANDS:
            for m in re.finditer(pattern, t, re.IGNORECASE if fold else 0):
                brand = m[1].strip(".,;:'\" \t-")
                if len(brand) >= 4 and brand.lower() not in skipped:
                    expected.setdefault(brand.lower(), {}).setdefault(label, 0)
                    expected[brand.lower()][label] += 1
    assert {k.lower(): v for k, v in made.items()} == expected and len(expected) >= 5


def test_readers_of_labels_and_glossaries(spark, tmp_path):
    (tmp_path / "pairs.json").write_text(json.dumps({"1": True, "2": "no", "x": True, "3": "Lead"}))
    assert {tuple(r) for r in readers.read_truth(spark, f"{tmp_path}/pairs.json").collect()} == {(1, True), (2, False), (3, True)}
    (tmp_path / "list.json").write_text(json.dumps([{"message_id": 5, "is_lead": "yes"}, {"id": 6, "label": 0}]))
    assert {tuple(r) for r in readers.read_truth(spark, f"{tmp_path}/list.json").collect()} == {(5, True), (6, False)}
    (tmp_path / "t.csv").write_text("id;label\n7;1\n8;\n")
    assert {tuple(r) for r in readers.read_truth(spark, f"{tmp_path}/t.csv").collect()} == {(7, True), (8, False)}
    base = sqlite3.connect(tmp_path / "g.db")
    base.executescript("CREATE TABLE rich (term TEXT, surface_forms TEXT, relevant INT, confidence REAL); CREATE TABLE plain (term TEXT, surface_forms TEXT, relevant INT);")
    base.executemany("INSERT INTO plain VALUES (?, ?, ?)", [("PSP", '["psps", "Psp "]', 1), ("noise", None, 0)])
    base.commit()
    assert {r[0] for r in readers.sqlite_glossary(spark, f"{tmp_path}/g.db", "rich", "plain").collect()} == {"psp", "psps"}
    base.executemany("INSERT INTO rich VALUES (?, ?, ?, ?)", [("MID", "[]", 1, 0.9), ("low", "[]", 1, 0.2)])
    base.commit()
    base.close()
    assert {r[0] for r in readers.sqlite_glossary(spark, f"{tmp_path}/g.db", "rich", "plain", 0.7).collect()} == {"mid"}
    with pytest.raises(ValueError):
        readers.read_sqlite(spark, f"{tmp_path}/g.db", 'x"; drop')
    raw = spark.createDataFrame([("1", "t", "9", "+1")], "message_id string, text string, reply_to_msg_id string, phone string")
    assert readers.messages_of(raw).first()["reply_to_msg_id"] == 9 and "phone" in readers.messages_of(raw).columns
    config = tmp_path / "c.json"
    config.write_text('{"stopwords": [{"term": "a"}]}')
    assert readers.read_json_config(spark, str(config)).first()["stopwords"][0]["term"] == "a"
    sense = "array<struct<definition:string,context_clues:array<string>,example_message_ids:array<bigint>>>"
    terms = spark.createDataFrame([("a", 1, []), ("b", 2, [("d", ["c"], [1])])], f"term string, frequency int, senses {sense}")
    assert [(r["term"], r["senses"][0]["definition"]) for r in readers.with_senses(terms).collect()] == [("b", "d"), ("a", "a")]


def test_a_failing_pipeline_stops_no_other(spark):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "message_id bigint, text string")
    broken = lambda frame: frame.withColumn("x", F.raise_error(F.lit("model is down")).cast("string"))
    made, errors = classifiers.isolated(rows, {"good": lambda frame: frame.withColumn("is_lead", F.lit(True)), "bad": broken, "worse": lambda frame: 1 / 0})
    assert made.count() == 2 and set(errors) == {"bad", "worse"}


def test_regex_gate_and_prices(spark):
    rows = spark.createDataFrame([("buy btc",), ("buy btc for cash",), ("hello",), (None,)], "text string")
    gate = gates.regex_gate(F.col("text"), patterns.ready(patterns.COINS), patterns.ready(patterns.NOT_COINS))
    assert [r[0] for r in rows.select(gate).collect()] == [True, False, False, False]
    many = spark.range(12_000).select(F.col("id").alias("model"), F.lit("s").alias("stage"), F.lit(1).alias("units"))
    prices = many.select("model", F.lit(3).alias("price"))
    assert evaluate.usage(many, "stage", "units", prices.unionByName(prices)).where("stage = 'TOTAL'").first()["cost"] == 36_000
    assert [r[0] for r in rows.select(gates.first_of(("a", F.contains("text", F.lit("cash"))), ("b", F.contains("text", F.lit("buy"))))).collect()] == ["b", "a", None, None]


def test_sinks_with_ties_and_buckets(spark, tmp_path):
    tied = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (2, None, "c")], "k int, at int, v string")
    for parts in (1, 3):
        assert {r["k"]: r["v"] for r in sinks.latest_wins(tied.repartition(parts), ["k"], ["at"]).collect()} == {1: "b", 2: "c"}
    maps = tied.withColumn("m", F.create_map("v", "at"))
    assert sinks.latest_wins(maps, ["k"], ["at"]).where("k = 1").first()["m"] == {"b": 5}
    path = str(tmp_path / "t")
    merge = upsert_sink(path, ["k"], ["at"], buckets=4)
    merge(tied, 0)
    before = {str(p) for p in (tmp_path / "t").rglob("*.parquet")}
    merge(spark.createDataFrame([(1, 9, "z")], "k int, at int, v string"), 1)
    after = {str(p) for p in (tmp_path / "t").rglob("*.parquet")}
    assert before & after  # the other bucket's files were left alone
    assert {r["k"]: r["v"] for r in spark.read.parquet(path).collect()} == {1: "z", 2: "c"}
    artifacts = str(tmp_path / "stages")
    sinks.stage_artifacts({"one": tied, "two": tied.limit(1)}, artifacts)
    assert spark.read.parquet(f"{artifacts}/01_two").count() == 1


def test_first_values_equal_first_rows(spark):
    rows = spark.createDataFrame([(3, "A "), (1, "a"), (2, "b"), (4, None), (5, None), (6, "B")], "id bigint, text string")
    whole = {tuple(r) for r in dedup.first_per_text(rows, ["id"]).collect()}
    slim = {r["i"] for r in dedup.first_values(rows, ["id"], {"i": F.col("id")}).collect()}
    assert {i for i, _ in whole} == slim == {1, 2, 4}


def test_stream_with_a_watermark_marks_late_rows(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    kind = "id bigint, user string, text string, ts timestamp"
    from datetime import datetime, timedelta

    start = datetime(2024, 1, 1)
    batches = [[(1, "a", "x", 0), (2, "a", "x", 60)], [(3, "a", "y", 3600), (4, None, "z", 0), (5, "b", "q", 90_000)], [(6, "a", "w", 1800), (7, "a", "x", 7300)]]
    for rows in batches:
        spark.createDataFrame([(i, u, t, start + timedelta(seconds=s)) for i, u, t, s in rows], kind).coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(source).withColumn("at", F.unix_timestamp("ts"))
    made = dedup_stream(stream, "id", "user", "text", "at", at="ts", delay="30 days")
    run = made.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start()
    run.awaitTermination()
    got = {r["id"]: (r["verdict"], r["late"]) for r in spark.read.parquet(out).collect()}
    assert got == {1: ("keep", False), 2: ("hold", False), 3: ("keep", False), 4: ("keep", False), 5: ("keep", False), 6: ("keep", True), 7: ("keep", False)}


def test_command_line(spark, tmp_path, capsys):
    (tmp_path / "m.csv").write_text("message_id;text\n1;we need a provider at once\n2;nothing of interest in here\n3;short\n")
    replies = [(1, "stage1", "YES"), (1, "extract", '{"is_lead": true, "lead_type": "x", "confidence": 0.5}'), (1, "judge", '{"verdict": "REAL_LEAD"}')]
    (tmp_path / "r.jsonl").write_text("\n".join(json.dumps(dict(zip(("message_id", "stage", "raw"), r, strict=True))) for r in replies))
    path = {n: str(tmp_path / n) for n in ("m.csv", "r.jsonl", "d", "j", "t.csv", "i", "e.csv", "g", "c", "t")}
    command.main(["extract", path["m.csv"], path["r.jsonl"], path["d"]])
    command.main(["extract", path["m.csv"], path["r.jsonl"], path["d"]])
    command.main(["judge", path["d"], path["r.jsonl"], path["j"]])
    assert spark.read.json(path["d"]).count() == 3 and spark.read.json(path["j"]).first()["verdict"] == "REAL_LEAD"
    command.main(["report", path["d"], path["j"], str(tmp_path / "leads.xlsx")])
    rows = lambda sheet: workbooks.read_messages_xlsx(spark, str(tmp_path / "leads.xlsx"), sheet)
    assert [r["message_id"] for r in rows("leads").collect()] == [1] and rows("all").count() == 3
    command.main(["report", path["d"], path["j"], path["c"]])
    assert "REAL_LEAD" in [r["verdict"] for r in spark.read.csv(path["c"], sep=";", header=True).collect()]
    command.main(["mine", str(tmp_path / "leads.xlsx"), path["t"], "--least", "1"])
    assert spark.read.parquet(path["t"]).where("term = 'provider'").count() == 1
    (tmp_path / "t.csv").write_text("id,label\n1,yes\n2,no\n")
    command.main(["evaluate", path["d"], path["t.csv"]])
    (tmp_path / "e.csv").write_text("text,label\nfoo,true\nbar,0\nfoo,true\n")
    command.main(["index", path["e.csv"], path["i"]])
    assert {(r["text"], r["label"]) for r in spark.read.parquet(path["i"]).collect()} == {("foo", True), ("bar", False)}
    spark.createDataFrame([("PSP", True, 0.9, ["s"])], "term string, relevant boolean, confidence double, senses array<string>").write.parquet(path["g"])
    command.main(["show", path["g"], "psp"])
    shown = capsys.readouterr().out
    assert "PSP" in shown and "tp" in shown


def test_replayed_scorer_reads_by_stage(spark):
    recorded = spark.createDataFrame([(1, "a", "x"), (1, "b", "y")], "message_id bigint, stage string, raw string")
    rows = spark.createDataFrame([(1,), (2,)], "message_id bigint")
    assert {r["message_id"]: r["raw"] for r in scoring.ReplayScorer(recorded).score(rows, "b").collect()} == {1: "y", 2: None}


def test_neighbours_of_hot_groups_equal_windows(spark):
    rows = spark.range(700).select(F.when(F.col("id") % 50 == 49, F.lit(None).cast("string")).when(F.col("id") % 3 == 0, F.lit("a")).when(F.col("id") > 600, F.lit("tiny")).otherwise(F.lit("hot")).alias("g"), ((F.col("id") * 37) % 701).alias("at"), F.concat(F.lit("t"), "id").alias("text"))
    for before, after in ((5, 1), (3, 0), (1, 4)):
        plain = context.with_context(rows, ["g"], ["at"], F.col("text"), before, after)
        cut = context.with_context(rows, ["g"], ["at"], F.col("text"), before, after, hot_rows=10, chunk_rows=25)
        assert sorted(map(str, plain.collect())) == sorted(map(str, cut.select(*plain.columns).collect()))
    plain, cut = (context.author_history(rows, ["g"], ["at"], last=4, cap=11, **more) for more in ({}, {"hot_rows": 10, "chunk_rows": 9}))
    assert sorted(map(str, plain.collect())) == sorted(map(str, cut.select(*plain.columns).collect()))


def test_replies_are_written_once_and_only_for_survivors(spark):
    rows = spark.range(10).withColumn("raw_text", F.lit("x"))
    made = scoring.asked(rows, F.when(F.col("id") < 7, F.col("id") % 2 == 0), scoring.RuleScorer({"s": F.uuid()}), "s")
    first, second = ({r["id"]: r["raw"] for r in made.collect()} for _ in range(2))
    assert first == second and {k for k, v in first.items() if v} == {0, 2, 4, 6} and len(first) == 10


def test_marked_csv_has_one_header_for_each_part(spark, tmp_path):
    rows = spark.range(6).repartition(3).select(F.col("id"), F.lit('say "x";\r\ny').alias("a b"), F.array(F.lit(1), F.col("id")).alias("l"), F.lit(None).cast("string").alias("n"))
    sinks.marked_csv(rows, str(tmp_path / "m"))
    parts = [p.read_bytes() for p in (tmp_path / "m").glob("part-*")]
    assert all(p.startswith('\ufeff"id";"a b";"l";"n"\n'.encode()) and p.count(b"\xef\xbb\xbf") == 1 for p in parts)
    got = spark.read.csv(str(tmp_path / "m"), sep=";", header=True, escape='"').collect()
    assert {(r["id"], r["a b"], r["l"]) for r in got} == {(str(i), 'say "x"; | y', f"1; {i}") for i in range(6)}
    sinks.marked_csv(rows.limit(0), str(tmp_path / "e"))
    assert [r[0].lstrip("\ufeff") for r in spark.read.text(str(tmp_path / "e")).collect()] == ['"id";"a b";"l";"n"']
