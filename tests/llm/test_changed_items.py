"""Benchmark items whose values changed their form."""

import pytest

from postmill.llm import decontam_templates

CASES = {
    "separator": ("A shop sells 1,200 red pens for the school each year.", "A shop sells 950 red pens for the school each year."),
    "decimals": ("A rope of 2.5 m is cut by the farmer in two parts.", "A rope of 3 m is cut by the farmer in two parts."),
    "first name": ("Anna buys seven ripe apples for the old teacher.", "Carla buys seven ripe apples for the old teacher."),
    "name behind a sentence": ("It was late. Anna went home by the last train.", "It was late. Carla went home by the last train."),
    "name behind a line break": ("On the way home\nAnna met seven loud geese.", "On the way home\nCarla met seven loud geese."),
    "white space": ("By then Anna met seven loud geese at home.", "By  then\tCarla met seven\nloud geese at home."),
    "run of names": ("The nurse Anna Smith met seven loud geese at home.", "The nurse Carla met seven loud geese at home."),
    "lower case": ("The nurse Anna met seven loud geese in Leeds.", "the nurse anna met seven loud geese in leeds."),
    "lower-cased run": ("The nurse Anna Smith met seven loud geese.", "the nurse anna smith met seven loud geese."),
    "equal values": ("They took 3 apples and 5 pears on the way.", "They took 4 apples and 4 pears on the way."),
    "now first": ("geese met seven loud nurses on the way.", "Geese met seven loud nurses on the way."),
    "no longer first": ("Reading takes 7 hours of the whole day.", "so reading takes 8 hours of the whole day."),
}
OTHERS = {
    "two values for one": ("They took 3 apples and 3 pears on the way.", "They took 4 apples and 5 pears on the way."),
    "other words": ("Anna buys seven ripe apples for the old teacher.", "Carla sells seven ripe apples for the old teacher."),
    "first word replaced": ("geese met seven loud nurses on the way.", "Ducks met seven loud nurses on the way."),
}


@pytest.mark.parametrize("lead", ["", "Some words before. "])
def test_changed_items(spark, lead):
    cases = [*CASES.items(), *OTHERS.items()]
    for_spark = lambda side: [(i, (lead if side else "") + pair[side]) for i, (_, pair) in enumerate(cases)]
    benchmark = spark.createDataFrame(for_spark(0), "item_id int, text string")
    docs = spark.createDataFrame(for_spark(1), "doc_id int, text string")
    got = {(r.doc_id, r.item_id) for r in decontam_templates.matches(docs, benchmark).collect()}
    assert {name for i, (name, _) in enumerate(cases) if (i, i) in got} == set(CASES)
