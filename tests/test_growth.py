"""Plans whose work is shared by all tasks and done once for each row."""

from pyspark.sql import functions as F

from tidemark import patterns
from tidemark.functions import text
from tidemark.operators import gazetteer, mining
from tidemark.plans import catalogue


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_self_definitions_are_dealt_to_all_cores_and_tried_once(spark, small):
    plan = plan_of(catalogue.QUERIES["self_definitions"](spark, small))
    assert "RoundRobinPartitioning" in plan
    rows = spark.createDataFrame([(1, "FTD means a first deposit.")], "id bigint, text string")
    plan = plan_of(mining.self_definitions(rows, ["FTD", "CPA"], "id"))
    assert not [line for line in plan.splitlines() if "Filter" in line and "regexp_extract" in line and "explode" not in line]


def test_hits_of_a_term_come_together(spark):
    rows = spark.createDataFrame([(i, "one two") for i in range(6)], "id bigint, text string").coalesce(1)
    got = [r["term"] for r in gazetteer.form_hits(rows, gazetteer.plain_forms(spark, ["one", "two"]), ["id"]).collect()]
    assert got == ["one"] * 6 + ["two"] * 6


def test_a_gate_reads_a_text_once_for_all_patterns(spark):
    """Of every pattern's own hits none is lost or added, and the gate's plan holds one match for each list."""
    pools = (patterns.CASINO, patterns.ACCOUNTS, patterns.NOT_ACCOUNTS, patterns.PROCESSORS, patterns.COINS, patterns.NOT_COINS, (r"ab|cd", r"a[|b]c", r"a?b", r"a\|d", r"(?:x|y)z"))
    said = ["", "ab", "cd", "xcd", "a|c", "a|d", "b", "yz", "Куплю USDT", "ИЩУ поставщиков", "we NEED eth", "продам", "нужен счёт для компании", "open casino platform", "cash for a bank account", "processing and merchant routing", "good morning all", None]
    said += [p.replace("\\b", "").replace("\\s+", " ").replace("\\w+", "а").replace("\\w*", "x") for pool in pools for p in pool]
    rows = spark.createDataFrame([(s,) for s in dict.fromkeys(said)], "text string")
    for pool in pools:
        got = rows.select("text", text.any_hit(F.col("text"), pool).alias("one"), (text.hit_count(F.col("text"), patterns.ready(pool)) > 0).alias("each"))
        assert got.where("one <> each or one is null").collect() == [] and got.where("one").count()
