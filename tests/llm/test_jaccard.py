import itertools
import random
import re

import numpy as np
import pytest

from tallyspark.llm import jaccard, textcodes


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k, percent):
    sets = [shingles(t, k) for _, t in rows]
    name = list(range(len(rows)))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        i = len(sets[a] & sets[b])
        if sets[a] and sets[b] and 100 * i >= percent * len(sets[a] | sets[b]):
            name[find(a)] = find(b)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(doc_id)
    return sorted((doc_id, len(s), min(groups[find(i)])) for i, ((doc_id, _), s) in enumerate(zip(rows, sets)))


def corpus(seed, base_kept=True):
    rng = random.Random(seed)
    word = lambda: rng.choice("ka re mi to su ve lo na bi du".split()) + rng.choice("nd st ra ble ing or el as".split())
    rows, passage = [], [word() for _ in range(40)]
    for base in range(12):
        w = [word() for _ in range(rng.randrange(30, 160))]
        for copy in range(rng.randrange(1, 14)):
            v = list(w)
            for _ in range(copy if base_kept else copy + 1):
                v[rng.randrange(len(v))] = word() + str(rng.randrange(3))
            rows.append(" ".join(v + passage if base % 3 == 0 else v))
    hot = [word() for _ in range(100)]                                          # one large group of near copies
    for i in range(120):
        v = list(hot)
        for _ in range(rng.randrange(0 if base_kept else 1, 5)):
            v[rng.randrange(100)] = word() + str(i)
        rows.append(" ".join(v))
    rows += ["one two"] * 3 + ["One\tTWO", "", None, "   ", "x", "one two three", "a " * 500, "a " * 400]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed, k, percent, kept, rare", [(1, 3, 90, True, 32), (2, 3, 90, False, 2), (3, 5, 80, True, 1), (4, 2, 70, False, 4)])
def test_against_brute_force(spark, make_docs, monkeypatch, seed, k, percent, kept, rare):
    monkeypatch.setattr(jaccard, "RARE", rare)   # small: nearly all signatures are combinations
    rows = corpus(seed, kept)
    got = jaccard.near_duplicates(make_docs(rows), k, percent).select("doc_id", "n_shingles", "component_id")
    assert sorted(map(tuple, got.collect())) == brute(rows, k, percent)


def test_repeats_nulls_and_empty(make_docs):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (7, "A b c d e\nf"), (None, None), (9, "")]
    got = sorted(map(str, (tuple(r) for r in jaccard.op6_jaccard(make_docs(rows)).collect())))
    assert got == sorted(map(str, [(5, 4, 5), (5, 4, 5), (None, 4, 5), (7, 4, 5), (None, 0, None), (9, 0, 9)]))
    docs = make_docs(rows)
    kept = jaccard.deduplicate(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["5", "9", "None", "None"]
    assert jaccard.op6_jaccard(make_docs([])).count() == 0


def test_codes():
    texts = ["The  cat\tSAT", "the", None, "", "x" * 70000 + " the", "É é"]
    codes, counts = textcodes.word_codes(texts)
    assert counts.tolist() == [3, 1, 0, 0, 2, 2]
    assert codes[0] == codes[3] == codes[5] and codes[6] != codes[7]
    long = " ".join(f"w{i}" for i in range(300000))                             # over several pieces
    many, n = textcodes.word_codes([long, "w7"])
    assert n.tolist() == [300000, 1] and len(np.unique(many)) == 300000 and many[7] == many[-1]


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(200, 201), (201, 200), (202, 201)] + [(3, 3)]
    rng.shuffle(edges)
    got = {r["node"]: r["root"] for r in jaccard.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 140)}, 201: 200, 202: 200}


def test_open_signatures_meet_their_components_once(make_docs, monkeypatch):
    """The rows of open signatures are joined with what is known of their
    signature once, and grow with a near-copy group, not with its square."""
    written = {}

    def keep(df, name, stash=jaccard.stash):
        out = stash(df, name)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        written.setdefault(name, []).append((out.columns, out.count(), plan.count("Join Inner, (sig")))
        return out
    monkeypatch.setattr(jaccard, "stash", keep)
    monkeypatch.setattr(jaccard, "RARE", 2)
    for size in (40, 80):
        rng, base = random.Random(3), [f"w{i}" for i in range(100)]
        rows = []
        for i in range(size):                                                    # every 8th is just out of reach
            v = list(base)
            at = rng.randrange(10, 50)
            for at in (at, at + 30) if i % 8 == 0 else (at,):
                v[at] = f"x{i}-{at}"
            rows.append((i, " ".join(v)))
        got = jaccard.near_duplicates(make_docs(rows)).select("doc_id", "n_shingles", "component_id")
        assert sorted(map(tuple, got.collect())) == brute(rows, 5, 80)
    columns, joins = ([x[at] for x in written["jaccard-open"]] for at in (0, 2))
    rows = [x[1] for x in written["jaccard-open"]]
    assert all("outside" in c for c in columns) and joins == [1, 1]
    assert 0 < rows[1] <= 2.5 * rows[0]
