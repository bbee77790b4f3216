import hashlib
import random
import zlib

import numpy as np
import pytest

from tallyspark.llm import runs


def brute_runs(words, least=12):
    """Maximal stretches of every period, then those of the smallest period."""
    n, best = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, 2 * q):
                best.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in best.items())


def found(*documents):
    got = runs.find_runs(*runs._numbered([list(d) for d in documents])).tolist()
    return [sorted(tuple(r[1:]) for r in got if r[0] == k) for k in range(len(documents))]


def test_against_brute_force():
    rng = random.Random(5)
    documents = []
    for _ in range(400):
        size, letters = rng.choice([(30, 1), (60, 2), (90, 3), (120, 5)])
        doc = [rng.randrange(letters) for _ in range(rng.randrange(size))]
        if rng.random() < .6:  # planted repeats, now and then of a repeat
            unit = doc[:rng.randrange(1, 12)] * rng.randrange(1, 4)
            at = rng.randrange(len(doc) + 1)
            doc[at:at] = unit * rng.randrange(2, 7) + unit[:rng.randrange(len(unit) + 1)]
        documents.append(doc)
    assert found(*documents) == [brute_runs(d) for d in documents]


def test_shapes():
    a = list("ab") * 3
    assert found(a, list("ab") * 6, ["x"] * 12, ["x"] * 11, [], ["x"]) == [[], [(0, 12, 2)], [(0, 12, 1)], [], [], []]
    square = list(range(9)) * 2
    assert found(square + [99], square[:-1]) == [[(0, 18, 9)], []]
    # equal documents side by side share nothing
    assert found(["x"] * 8, ["x"] * 8) == [[], []]


def test_suffix_array_and_lcp():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 3, 300)
    sa, isa, levels = runs.suffix_array(codes)
    suffixes = [tuple(codes[i:]) for i in range(300)]
    assert sa.tolist() == sorted(range(300), key=lambda i: suffixes[i])
    assert (isa[sa] == np.arange(300)).all()
    shared = [0] + [next((k for k, (x, y) in enumerate(zip(suffixes[i], suffixes[j])) if x != y), min(len(suffixes[i]), len(suffixes[j])))
                    for i, j in zip(sa[:-1], sa[1:])]
    assert runs.lcp_values(sa, levels).tolist() == shared


def expected(doc_id, text):
    words = [w for w in (text or "").encode().split()]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    own = brute_runs(words)
    gone = {i for s, length, q in own for i in range(s + q, s + length)}
    top = min(own, key=lambda r: (-r[1], r[0], r[2])) if own else (None,) * 3
    sha = lambda t: hashlib.sha256(t).hexdigest()
    return (doc_id, len(own), *top, 1000 * top[1] // top[2] if own else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in sorted(own, key=lambda r: (r[0], r[2]))).encode()),
            sha(b" ".join(w for i, w in enumerate(words) if i not in gone)))


def test_query_against_brute_force(spark, make_docs):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice("the cat sat on a mat".split()) for _ in range(rng.randrange(80)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (None, "x " * 20), (203, "no runs here"), (203, "x " * 13), (203, "x " * 13),
             (204, "A a " * 9), (205, "café x \x1c " * 8), (206, "line one two\nline\tone\x0btwo " * 5)]
    got = runs.op12_runs(make_docs(rows))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((expected(*r) for r in rows), key=str)


@pytest.mark.parametrize("kind", ["one word", "period", "fibonacci"])
def test_long_texts(spark, make_docs, kind):
    if kind == "one word":
        words, want = ["x"] * 60000, [(0, 60000, 1)]
    elif kind == "period":
        unit = [f"w{i}" for i in range(7001)]
        words, want = unit * 9 + unit[:5], [(0, 9 * 7001 + 5, 7001)]
    else:
        a, b = ["a"], ["a", "b"]
        while len(b) < 3000:
            a, b = b, b + a
        words, want = b, brute_runs(b)
    row, = runs.periodic_runs(make_docs([(1, " ".join(words))])).collect()
    assert [tuple(r) for r in row["runs"]] == sorted(want, key=lambda r: (r[0], r[2]))


def test_empty_table(spark, make_docs):
    assert runs.op12_runs(make_docs([]).where("false")).count() == 0
