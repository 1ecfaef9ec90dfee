"""Template decontamination: re-parameterised questions, inconsistent slots and odd rows."""

import pytest
from pyspark.sql import functions as F

from finloom.llm import decontaminate

QUESTION = ("Alice buys 12 red apples and 7 green pears at the market while Bob carries 12 heavy baskets for 3 km "
            "before supper; how many fruits does Alice hold in the end?")
ITEMS = [(1, QUESTION), (2, "too short to match"), (3, None), (4, "Np Rq St Uv Wx Yz Ab Cd Ef Gh")]
PAD = "some words that come first and say nothing at all about this, then: "


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string").withColumn("usable", F.lit("x"))


def found(spark, items, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("item_id", F.lit("x"))
    rows = decontaminate.leaks(docs, items).collect()
    kept = {r.doc_id for r in decontaminate.drop_leaked(docs, items).collect()}
    assert kept == set(range(len(texts))) - {r.doc_id for r in rows}
    return {(r.doc_id, r.item_id) for r in rows}


def test_verbatim_and_exchanged_parameters(spark, items):
    changed = QUESTION.replace("12", "31").replace("7", "8").replace("Alice", "Zoe").replace("Bob", "Max").replace(
        "km", "miles")
    texts = [PAD + QUESTION + " and more after it", PAD + changed, changed.replace("supper", "lunch"),
             PAD + changed.replace("Zoe", "Eve", 1), PAD + changed.replace("31", "32", 1), PAD * 3]
    # One word changed leaves windows enough; a name or number that stands for two values does not agree.
    assert found(spark, items, texts) == {(0, 1), (1, 1), (2, 1)}


def test_broadcast_and_shuffle_agree(spark, items, monkeypatch):
    texts = [PAD + QUESTION, "nothing " * 30, QUESTION]
    first = found(spark, items, texts)
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert found(spark, items, texts) == first == {(0, 1), (2, 1)}


def test_odd_rows(spark, items):
    docs = spark.createDataFrame([(None, QUESTION), (1, None), (2, ""), (3, QUESTION), (3, QUESTION), (3, "clean"),
                                  (4, "word " * 100000 + QUESTION), (5, QUESTION + " " + QUESTION)],
                                 "doc_id long, text string")
    rows = decontaminate.leaks(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in rows) == [(0, 1), (3, 1), (4, 1), (5, 1)]
    assert {r.first_word for r in rows if r.doc_id == 5} == {0}
    kept = decontaminate.drop_leaked(docs, items).collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [(3, "clean")] and len(kept) == 3
    assert decontaminate.leaks(docs.limit(0), items).count() == 0
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0


def test_main_path_has_no_python(spark, items):
    docs = spark.createDataFrame([(1, QUESTION)], "doc_id long, text string")
    plan = decontaminate.drop_leaked(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_copies_in_other_case(spark, items):
    changed = QUESTION.replace("12", "31").replace("km", "miles")
    texts = [PAD + QUESTION.upper(), PAD + QUESTION.lower(), changed.upper(), PAD + QUESTION.title(), PAD.upper() * 3,
             changed.upper().replace("31", "32", 1).replace("7", "8")]
    assert found(spark, items, texts) == {(0, 1), (1, 1), (2, 1), (3, 1)}


def test_an_item_of_names_alone(spark, items):
    assert found(spark, items, [PAD + ITEMS[3][1], ITEMS[3][1].lower(), PAD]) == {(0, 4), (1, 4)}


def test_values_that_coincide_or_change_in_one_place(spark, items):
    verbatim = "The farmer walks slowly along the river and sings about old ships in the cold harbour every morning. "
    long = spark.createDataFrame([(1, QUESTION), (7, f"The man saw 5 boats. {verbatim}The end of 5 days is 5 far away")],
                                 "item_id long, text string").withColumn("usable", F.lit("x"))
    texts = [PAD + QUESTION.replace("12", "4").replace("7", "4"),  # two values become one
             PAD + QUESTION.replace("12", "31", 1),  # one of two equal numbers
             f"A man saw 6 boats. {verbatim}One end of 7 days is 8 far away",  # slots clash beside verbatim windows
             PAD + QUESTION.replace("12", "31", 1).replace("12", "32").replace("7", "8").replace("many", "few")]
    assert found(spark, long, texts) == {(0, 1), (1, 1), (2, 7)}
