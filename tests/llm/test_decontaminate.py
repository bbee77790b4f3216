import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import decontaminate as dec

ITEM = "Anna has 12 apples and buys 5 more apples at the market in Berlin for 3 euros each day. How many apples does Anna have?"


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def caught(docs, its):
    return {(r["doc_id"], r["item_id"]): r for r in dec.contaminated(docs, its).collect()}


def test_copies_and_new_parameters(spark, make_docs):
    other = ITEM.replace("Anna", "Maria").replace("12", "7").replace("5", "9").replace("Berlin", "Paris").replace("3 euros", "4 dollars")
    # the same slot must always get the same value: here one name stands for two
    mixed_up = "has 12 apples and buys 12 more apples at the market in Berlin for 3 euros each day. How many"
    docs = make_docs([(1, "Some words here. " + ITEM + " and more"), (2, other), (3, "Nothing of the kind, at all, in this one, is here."), (4, None), (5, ""),
                      (6, ITEM.upper()), (7, ITEM.replace(" ", "\n\n")), (8, " ".join(ITEM.split()[:7])), (1, "again " + ITEM), (None, ITEM)])
    got = caught(docs, items(spark, [(1, ITEM), (2, None), (3, ""), (4, "in this"), (5, mixed_up)]))
    assert {k for k in got if k[1] == 1} == {(1, 1), (2, 1), (6, 1), (7, 1), (None, 1)}
    assert got[2, 1]["reparameterised"] and not got[1, 1]["reparameterised"]
    assert (2, 5) not in got and (1, 5) not in got


def test_slot_consistency(spark, make_docs):
    item = "Take 5 red balls and 5 blue balls then add 5 green balls to the box of 5 yellow balls now"
    docs = make_docs([(1, item.replace("5", "8")), (2, "Take 1 red balls and 2 blue balls then add 3 green balls to the box of 4 yellow balls now")])
    assert {k[0] for k in caught(docs, items(spark, [(1, item)]))} == {1}


def test_short_items_match_whole(spark, make_docs):
    docs = make_docs([(1, "well the cat sat down here"), (2, "the cat"), (3, "the cat sat")])
    assert set(caught(docs, items(spark, [(1, "the cat sat down"), (2, "the cat")]))) == {(1, 1)}


@pytest.mark.parametrize("few", [True, False])
def test_both_joins_agree(spark, make_docs, monkeypatch, few):
    if not few:
        monkeypatch.setattr(dec, "BROADCAST_WINDOWS", 0)
    docs = make_docs([(i, ("x y z w " * i) + (ITEM if i % 3 == 0 else "")) for i in range(20)])
    assert {k[0] for k in caught(docs, items(spark, [(1, ITEM)]))} == {i for i in range(20) if i % 3 == 0}


def test_clean_keeps_columns_and_empty_tables(spark, make_docs):
    docs = make_docs([(1, ITEM), (2, "fine text of many words that nobody ever saw before"), (None, None)])
    left = dec.clean(docs, items(spark, [(1, ITEM)]))
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {2, None}
    assert dec.clean(docs, items(spark, [])).count() == 3
    assert caught(make_docs([]), items(spark, [(1, ITEM)])) == {}


def test_first_words_and_long_runs(spark, make_docs):
    short, long = "What is the capital of France?", " ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200))
    its = items(spark, [(1, short), (2, "Anna has 3 red apples and pears"), (3, long)])
    docs = make_docs([(1, "quiz: " + short), (2, "A heading\n" + short), (3, "- " + short), (4, "So. " + short), (5, "quiz what is the capital of France"),
                      (6, "Maria has 4 red apples and pears"), (7, "quiz: Maria has 4 red apples and pears"), (8, "x " + " ".join(long.split()[50:80]) + " y"),
                      (9, " ".join(long.split()[50:65])), (10, "quiz: What is the price of bread?")])
    got = caught(docs, its)
    assert set(got) == {(i, 1) for i in range(1, 6)} | {(6, 2), (7, 2), (8, 3)}
    assert got[6, 2]["reparameterised"] and not got[1, 1]["reparameterised"]


def test_rows_without_or_of_one_id_are_their_own(spark, make_docs):
    fine = "fine text of many words that nobody ever saw before"
    docs = make_docs([(None, ITEM), (None, fine), (None, ITEM.replace("12", "7")), (1, fine), (1, ITEM.replace("Anna", "Maria")), (1, ITEM.replace("Anna", "Laura"))])
    assert sorted((r["doc_id"] is None, r["text"]) for r in dec.clean(docs, items(spark, [(1, ITEM)])).collect()) == [(False, fine), (True, fine)]
    assert dec.contaminated(docs, items(spark, [(1, ITEM), (1, "other words that stand for nothing here")])).count() == 4


def test_readings_of_odd_words(spark):
    """Both readings and the plain words against the definitions."""
    stop, other = ".!?", dec._PUNCTUATION + "\t\n\x0b\f\r"
    rng = random.Random(4)
    parts = ["Anna", "anna", "ANNA", ".", "!", " ", "   ", "    ", ",", "\n", "5", "Zwei", "cent", "Cents", "Km", "\x1e", "\x1fZo", "a.Bo", "A.bo", "Bo.Co",
             "$5", "Éa", "<name>", "…", "“Ab”", "\U0001f600Ab", "the", "ℂn", "ℂnA"]
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", " "]) for _ in range(rng.randrange(0, 25))) for _ in range(400)] + [None, "", " ", "."]

    def expected(text):
        marked = "".join("\x1f" if c in stop else " " if c in other else c for c in text or "")
        named = re.sub(r"(?:(?<=[^\x1f ] )|(?<=[^\x1f ]  )|(?<=[^\x1f ]   ))(?=\w)[^\W\d_]+[^ \x1f]*",
                       lambda m: dec.NAME if m[0][0].isupper() and m[0][1:2].islower() else m[0], marked)
        cut = lambda t: re.split(" +", t.replace("\x1f", "").strip(" "))
        kind = lambda w: dec.NUMBER if "0" <= w < ":" or w in dec.NUMBER_WORDS else dec.UNIT if w in dec.UNITS else w
        canon = [kind(w.lower()) for w in cut(named)]
        cased = cut(marked)
        return canon, [dec.NAME if a != c and c[:1].isupper() and c[1:2].islower() else a for a, c in zip(canon, cased)], [w.lower() for w in cased]
    df = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("words", dec.cut_words(F.col("text")))
    for r in df.select("text", dec.template_words(F.col("words"), 0), dec.template_words(F.col("words"), 1), dec.raw_words(F.col("text"))).collect():
        assert tuple(r[1:]) == expected(r[0]), r[0]


def test_a_document_is_cut_into_words_once(spark, make_docs):
    """Twice before, and a third time for the plain words of documents with
    windows of an item."""
    windows = dec.document_windows(make_docs([(1, ITEM)]), [6], np.zeros(256, np.int64))
    plan = windows._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\bsplit\(", plan)) == 2
