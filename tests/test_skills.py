"""Phrases of a dictionary and pairs of items against brute force."""

import random
import re
from collections import Counter
from itertools import combinations

import pytest

from postmill.operators.cooccurrence import associations, pair_counts
from postmill.operators.phrases import demand, find_phrases, opening_words, words

SKILLS = [("Python", "python"), ("python 3", "python"), ("machine learning", "ml"), ("ML", "ml"), ("machine learning engineer", "role"), ("C++", "c++"),
          ("C#", "c#"), (".NET", "dotnet"), ("Node.js", "node"), ("C", "c"), ("sql server", "sql"), ("SQL", "sql"), (None, "x"), ("--", "y"), ("z", None)]
TEXTS = [(1, "Python, python 3; and Machine-Learning engineer."), (2, "C++/C#/C, .NET and node.js"), (2, "SQL Server or SQL"), (3, None), (4, ""),
         (None, "ML!"), (5, "no skill here"), (6, "machine learning machine learning engineers")]


def brute(text, terms):
    tokens = re.findall(r"\.?[^\W_]+(?:\.[^\W_]+)*[+#]*", (text or "").lower())
    at, out = 0, []
    while at < len(tokens):
        for n in range(5, 0, -1):
            label = terms.get(tuple(tokens[at:at + n])) if at + n <= len(tokens) else None
            if label is not None:
                out.append((at, n, label))
                at += n
                break
        else:
            at += 1
    return out


def compiled(rows):
    terms = {}
    for phrase, label in rows:
        key = tuple(re.findall(r"\.?[^\W_]+(?:\.[^\W_]+)*[+#]*", (phrase or "").lower()))
        if key and label is not None:
            terms[key] = min(terms.get(key, label), label)
    return terms


@pytest.mark.parametrize("broadcast_rows", [10**6, 0])
def test_phrases_equal_brute_force(spark, broadcast_rows):
    rng = random.Random(3)
    vocabulary = [f"w{i}" for i in range(12)]
    phrases = SKILLS + [(" ".join(rng.choices(vocabulary, k=rng.randint(1, 4))), f"l{i % 9}") for i in range(40)]
    texts = TEXTS + [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randint(0, 60)))) for i in range(80)]
    found = find_phrases(spark.createDataFrame(texts, "id int, text string"), "text", spark.createDataFrame(phrases, "phrase string, label string"),
                         ["id"], broadcast_rows)
    terms = compiled(phrases)
    expected = Counter((i, *hit) for i, t in texts for hit in brute(t, terms))
    assert Counter((r.id, r.first_word, r.n_words, r.label) for r in found.collect()) == expected
    per = Counter(label for i, t in {i: t for i, t in texts}.items() for label in {h[2] for h in brute(t, terms)} if i is not None and i >= 100)
    counted = {r.label: r.n_rows for r in demand(found.where("id >= 100"), "id").collect()}
    assert counted == per


def test_a_large_dictionary(spark):
    phrases = spark.range(100_000).selectExpr("concat('term', id, ' of ', id % 7) phrase", "concat('s', id) label")
    texts = spark.createDataFrame([(1, "term99999 of 4, term5 of 5 and term5 of 6")], "id int, text string")
    found = find_phrases(texts, "text", phrases, ["id"])
    assert sorted((r.first_word, r.label) for r in found.collect()) == [(0, "s99999"), (3, "s5")]
    assert find_phrases(texts, "text", phrases.where("false"), ["id"]).collect() == []


def test_pairs_equal_brute_force(spark):
    rng = random.Random(7)
    baskets = {i: {f"s{min(int(rng.expovariate(0.1)), 60)}" for _ in range(rng.randint(0, 12))} for i in range(300)}
    rows = [(i, s) for i, items in baskets.items() for s in (items or {None})] + [(3, s) for s in baskets[3]]
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "id int, skill string")
    single = Counter(s for items in baskets.values() for s in items)
    both = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    for tile, shares, least in ((512, 3, 4), (7, 2, 2), (1, 1, 30)):
        got = {(r.a, r.b): (r.n_a, r.n_b, r.n_both) for r in pair_counts(frame, "id", "skill", least, tile, shares).collect()}
        assert got == {p: (single[p[0]], single[p[1]], n) for p, n in both.items() if n >= least}
    r = associations(frame, "id", "skill", 4).orderBy("a", "b").first()
    assert (r.support, r.confidence_ab) == (r.n_both / 300, r.n_both / r.n_a) and r.lift == pytest.approx(r.n_both * 300 / r.n_a / r.n_b)


def test_a_row_of_ten_thousand_skills(spark):
    wide = spark.range(10_000).selectExpr("0 id", "concat('s', id) skill")
    few = spark.createDataFrame([(1, "s1"), (1, "s2"), (2, "s1"), (2, "s2"), (3, "s2")], "id int, skill string")
    got = [tuple(r) for r in pair_counts(wide.union(few), "id", "skill", 2).collect()]
    assert got == [("s1", "s2", 3, 4, 3)]


def test_mixed_baskets_equal_brute_force(spark):
    """Small baskets go by pairs, large dense ones by tiles, and both add up."""
    rng = random.Random(9)
    baskets = {i: set(rng.sample(range(90), rng.choice([2, 5, 50, 80]))) for i in range(60)} | {None: set(range(45))}
    rows = [(i, s) for i, items in baskets.items() for s in items]
    single = Counter(s for items in baskets.values() for s in items)
    both = Counter(p for items in baskets.values() for p in combinations(sorted(items), 2))
    frame = spark.createDataFrame(rows, "id int, item int")
    for tile, shares in ((512, 1), (16, 3), (4, 2)):
        got = {(r.a, r.b): (r.n_a, r.n_b, r.n_both) for r in pair_counts(frame, "id", "item", 3, tile, shares).collect()}
        assert got == {p: (single[p[0]], single[p[1]], n) for p, n in both.items() if n >= 3}


def test_small_baskets_need_no_tiles(spark, capsys):
    """Baskets of few items are counted as rows of pairs, so the work does not follow the number of pairs of tiles."""
    frame = spark.range(3_000).selectExpr("id basket", "explode(array(id % 1500, id % 1500 + 1500, id % 1500 + 3000)) item")
    pairs = pair_counts(frame, "basket", "item", 2)
    assert pairs.where("n_both = 2 AND n_a = 2 AND n_b = 2").count() == pairs.count() == 4_500
    pairs.explain("simple")
    assert "Union" in capsys.readouterr().out


def test_opening_words_equal_the_first_words(spark):
    texts = [None, "", "one", "--", "one two", ".net  c++ (c#) more", "a.b..c.d\ne+#f", "ÄÖ ß3 x y", "İx K9", "x" * 100_000, "- " * 50_000 + "a b", "a..b"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    for n in (1, 2, 3):
        for r in frame.select("t", words(frame.t).alias("all"), opening_words(frame.t, n).alias("some")).collect():
            expected = r.all if r.all is None else r.all[:n] if len(r.all) >= n else []
            assert r.some == expected, (r.t or "")[:30]


def test_the_dictionary_is_made_once(spark):
    """Its phrases are not computed again for the join."""
    made = spark.sparkContext.accumulator(0)

    def seen(batches):
        for b in batches:
            made.add(b.num_rows)
            yield b

    phrases = spark.createDataFrame([("machine learning", "ml"), ("sql", "sql")], "phrase string, label string").mapInArrow(seen, "phrase string, label string")
    texts = spark.createDataFrame([(1, "SQL and Machine Learning")], "id int, text string")
    assert sorted(r.label for r in find_phrases(texts, "text", phrases, ["id"]).collect()) == ["ml", "sql"]
    assert made.value == 2
