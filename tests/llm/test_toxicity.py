import random

import pytest

from tallyspark.llm import toxicity as tox

LEX = tox.lexicon_transducer({"blorf*": 3.0, "zog": 2.0})
PARTS = tox._machine_parts({"blorf*": 3.0, "zog": 2.0})


def ev(text):
    return tox.evidence(text, *PARTS)[0]


def test_grammar():
    plain = ev("what an idiot")
    assert plain == 2.0
    assert ev("you are an idiot") == ev("that idiot is you") == plain * tox.TARGETED
    assert ev("you are not an idiot") == pytest.approx(plain * tox.TARGETED * tox.NEGATED)
    assert ev("she said: what an idiot") == plain                               # the clause ended
    assert ev("the paper reported what an idiot was") == pytest.approx(plain * tox.REPORTED)
    assert ev("such idiot") == pytest.approx(plain * tox.INTENSE)
    assert ev("not today. what an idiot") == plain                              # negation stays in its clause
    assert ev("they will kill you") == 2.0 and ev("kill time here") == 0.5      # a threat wants a target
    assert ev("BLORFIAN!! zog,") == 5.0 and ev("blorf") == 0.0                  # a beginning needs more behind it
    assert ev(None) == ev("") == ev("nothing here") == 0.0


def test_learns_words_and_beginnings(spark, make_docs):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "ka re mi to su ve lo".split() for b in "nd st ra ble ing or".split()]
    rows, labels = [], []
    for i in range(400):
        w = [rng.choice(words) for _ in range(60)]
        bad = i % 6 == 0
        for _ in range(3 if bad else 0):
            w[rng.randrange(60)] = "qixx" + rng.choice(words)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(bad)))
    docs = make_docs(rows + [(900, None), (901, ""), (5, rows[5][1])])
    judged = tox.op1_toxicity(docs, spark.createDataFrame(labels + [(None, 1, 1)], "doc_id long, quality int, toxic int")).collect()
    assert len(judged) == 403
    for r in judged:
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert r["predicted"] == int(r["doc_id"] < 400 and r["doc_id"] % 6 == 0)
    assert len({r["score"] for r in judged if r["doc_id"] in (900, 901)}) == 1
    assert sum(r["held_out"] for r in judged) > 40


def test_without_labels_and_empty(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in tox.op1_toxicity(make_docs([(1, "you are an idiot and scum"), (2, "fine"), (None, None)]), none).collect()}
    assert got == {1: 1, 2: 0, None: 0}
    assert tox.op1_toxicity(make_docs([]), none).count() == 0


def test_reports_on_both_sides_and_punctuated_words():
    said = 2.0 * tox.TARGETED * tox.REPORTED
    assert ev("he said you idiot") == ev("you idiot, he said") == ev('"you idiot!" said the man') == pytest.approx(said)
    assert ev("you idiot! he said nothing") == 2.0 * tox.TARGETED               # the clause ended, no quotation mark
    assert ev("you idiot, zog moron he said") == 3 * 2.0 * tox.TARGETED         # no comma before the tag
    assert ev("you are no idiot") == ev("you are no, idiot") == pytest.approx(2.0 * tox.TARGETED * tox.NEGATED)
    assert ev("he, idiot") == ev("he idiot") == ev("HE: she, idiot") == 2.0 * tox.TARGETED


def test_composition_equals_the_machines_in_turn_and_the_rules():
    """Composed transducers against one machine after the other, and against
    the rules read off positions, on random class strings."""
    rng = random.Random(11)
    left = [tox.within(tox.TARGET, tox.REACH, tox.AIMED, once=True), tox.report_behind()]
    right = [tox.within(tox.NEGATION, tox.REACH, weight=tox.NEGATED), tox.report_before(),
             tox.within(tox.INTENSIFIER, tox.NEAR, weight=tox.INTENSE), tox.within(tox.TARGET, tox.REACH, tox.AIMED), tox.clause()]
    leftward, rightward = tox.grammar()

    def in_turn(machines, symbols):
        weights = [1.0] * len(symbols)
        for m in machines:
            ran = m.run(symbols)
            symbols, weights = [s for s, _ in ran], [w * f for w, (_, f) in zip(weights, ran)]
        return symbols, weights

    words = [k for k in range(10) if k not in (tox.COMMA, tox.QUOTE_END, tox.END)]
    for _ in range(3000):
        s = rng.choices(range(10), weights=[4, 3, 2, 3, 1, 1, 1, 1, 1, 1], k=rng.randrange(14))
        marked = leftward.run(s[::-1])
        got = rightward.run([m for m, _ in marked][::-1])
        one, w1 = in_turn(left, s[::-1])
        two, w2 = in_turn(right, one[::-1])
        assert [x for x, _ in got] == two and [w for _, w in got] == pytest.approx(w2) and set(w1) <= {1.0}
        for i, kind in enumerate(s):
            if kind not in (tox.INSULT, tox.THREAT):
                continue
            a = max([j + 1 for j in range(i) if s[j] in (tox.QUOTE_END, tox.END)], default=0)
            e = min([j for j in range(i, len(s)) if s[j] in (tox.QUOTE_END, tox.END)], default=len(s))
            before, behind = [k for k in s[a:i] if k in words], [k for k in s[i + 1:e] if k in words]
            until = next((j for j, k in enumerate(behind) if k in (tox.INSULT, tox.THREAT)), len(behind))
            aimed = tox.TARGET in before[-tox.REACH:] or tox.TARGET in behind[:min(until, tox.REACH)]
            quoted = tox.REPORT in before or any(
                s[j] in (tox.COMMA, tox.QUOTE_END) and _tag(s[j + 1:], words)
                for j in range(i + 1, min(e + 1, len(s))) if s[j] in (tox.COMMA, tox.QUOTE_END))
            want = (tox.TARGETED if aimed else 1.0) if kind == tox.INSULT else (1.0 if aimed else tox.AIMLESS)
            want *= tox.NEGATED if tox.NEGATION in before[-tox.REACH:] else 1.0
            want *= tox.INTENSE if tox.INTENSIFIER in before[-tox.NEAR:] else 1.0
            want *= tox.REPORTED if quoted else 1.0
            assert got[i][1] == pytest.approx(want), (s, i)


def _tag(rest, words):
    """Whether a reporting verb follows within TAG words, nothing but plain words before it."""
    for n, k in enumerate(rest[:tox.TAG]):
        if k == tox.REPORT:
            return True
        if k not in words or k in (tox.INSULT, tox.THREAT):
            return False
    return False


def test_long_and_tied_texts(spark, make_docs):
    text = "word " * 200_000 + "you are an idiot. "
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r["doc_id"]: r["score"] for r in tox.op1_toxicity(make_docs([(1, text), (2, "you are an idiot."), (3, text)]), none).collect()}
    assert got[1] == got[2] == got[3] >= 0.5
