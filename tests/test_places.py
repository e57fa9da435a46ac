"""Templates read what surrounds a term, not the whole text, and find the same."""

from tidemark.operators import gazetteer, mining
from tidemark.patterns import DEFINITIONS

SAID = [
    "FTD means one thing. xFTD means no. FTD means another thing here", "İ FTD means with dotted i", "by   FTD  we mean  a thing", "x by FTD: we mean  a thing, FTD means thing two",
    "\U0001d41bFTD means nope. \U0001f600FTD means after smiley", "the ſhe: long s stays. She: capital", "FTD " + " " * 5000 + "means far away", "FTD: abc. FTD: longer words",
    "-$x = 5000 \n a$x = 60000", "FTD=" + "a" * 300, "FTD (" + " " * 900 + "first   deposit" + " " * 900 + ") x", "FTD:" + "the: " * 200, "под FTD имею в виду депозит. Под\nFTD имею в виду другой",
    "éFTD means nope", "FTDs means nope, FTD_x means nope, _FTD means nope, FTD: ok then", "FTD", "", None,
]


def test_pieces_find_what_whole_texts_do(spark, monkeypatch):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(SAID)], "id bigint, text string")
    terms = ["FTD", "the", "she", "$x"]

    def found():
        return sorted(map(tuple, mining.self_definitions(rows, terms, "id", per_term=1000).collect()))

    made = found()
    monkeypatch.setattr(mining, "_around", lambda templates: gazetteer.Around(mining._sequels(templates)))
    assert made == found() and len({r[3] for r in made}) >= 12


def test_templates_get_pieces(spark):
    """A long text goes to the templates once no more for every term that it defines."""
    text = "word and some more of them. " * 2000 + "FTD means one thing. CPA: cost per action. ROI = return on investment."
    rows = spark.createDataFrame([(1, text)], "id bigint, text string")
    around = mining._around([t for _, t in DEFINITIONS])
    hits = gazetteer.form_places(rows, gazetteer.plain_forms(spark, ["FTD", "CPA", "ROI", "some"]), ["id"], "text", around).collect()
    assert {r["term"] for r in hits} == {"FTD", "CPA", "ROI"}
    assert all(r["said"] is None and sum(map(len, r["places"])) < 500 for r in hits)
    assert mining._around([r"\b{term}\b means (.*)"]).reach is None  # of no known reach: the whole text


def test_tokens_are_taken_once(spark):
    rows = spark.createDataFrame([(1, "Skrill skrill a1"), (2, ""), (3, None), (4, "!")], "id bigint, text string")
    units = mining.message_tokens(rows, "id")
    assert sorted(map(tuple, units.collect())) == [(1, "Skrill"), (1, "a1"), (1, "skrill")]
    plan = mining.classified(units.select("surface").distinct())._jdf.queryExecution().executedPlan().toString()
    assert not [line for line in plan.splitlines() if line.lstrip("+-: *()0123456789").startswith("Filter") and ("regexp" in line or "RLIKE" in line)]
