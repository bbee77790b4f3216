import collections
import math
import re
import zlib

import numpy as np
import pytest

from tallyspark.llm import lm_score as lm


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")) + ["\n"]


ROWS = [(i, " ".join(["the", "cat", "sat", "Sat", f"w{i % 9}", "on", "the", "mat", f"rare{i}"] * (1 + i % 4))) for i in range(120)]
ROWS += [(200, None), (201, ""), (202, "never seen"), (203, "x" * 20000), (None, "the cat"), (3, ROWS[3][1])]


@pytest.mark.parametrize("top, bucket", [(1 << 20, 1 << 24), (3, 500), (0, 500)])
def test_exact_base_and_close_score(make_docs, monkeypatch, top, bucket):
    monkeypatch.setattr(lm, "TOP", top)              # 0 and 3: counts come by the join
    monkeypatch.setattr(lm, "BUCKET_BYTES", bucket)  # 500: many segments
    got = lm.op5_lm(make_docs(ROWS)).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 10 == 0
    train = [words(t) for i, t in ROWS if not held(i)]
    c = collections.Counter(w for t in train for w in t)
    pairs = collections.Counter(p for t in train for p in zip(["\n"] + t, t))
    n, v = sum(c.values()), len(c)
    uni = lambda w: (c[w] + 0.1) / (n + 0.1 * (v + 1))
    want = collections.defaultdict(list)
    for i, t in ROWS:
        want[i].append((held(i), words(t)))
    assert len(got) == len(ROWS)
    for r in got:
        h, w = want[r["doc_id"]][0]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (h, len(w), sum(c[x] > 0 for x in w), n)
        assert r["base_score"] == pytest.approx(sum(math.log10(uni(x)) for x in w))
        exact = sum(math.log10((pairs[p] + lm.PRIOR * uni(p[1])) / (c[p[0]] + lm.PRIOR)) for p in zip(["\n"] + w, w))
        assert abs(r["score"] - exact) / len(w) < 0.25 and r["score"] < 0


def test_filter_reads_counts_back():
    codes = np.arange(1, 5001, dtype=np.uint64) * np.uint64(2654435761)
    counts = np.arange(1, 5001)
    size, bits = lm.build_segment(codes, counts)
    level = lm.probe(codes, size, bits)
    read = lm.level_count(level)
    assert (level >= lm._level(counts)).all()                       # a stored count is never lost
    assert (read <= counts * lm.BASE + 1).mean() > 0.97                # and rarely read too high
    absent = lm.probe(codes + np.uint64(1), size, bits)
    assert (absent > 0).mean() < 0.03


def test_very_frequent_and_single_grams_keep_their_levels():
    counts = np.array([1, 1, 2, 50_000_000, 2 ** 33, 2 ** 62])
    codes = np.arange(1, 7, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    size, bits = lm.build_segment(codes, counts)
    stored, read = lm._level(counts), lm.probe(codes, size, bits)
    # a false positive may add a step, nothing takes one away
    assert (stored <= read).all() and (read <= stored + 1).all() and stored[0] == 1 and lm._level(np.array([2 ** 63 - 1]))[0] <= lm.LEVELS
    low = lm.level_count(stored)
    assert (low <= counts).all() and (counts <= low * lm.BASE).all()


def test_empty_and_only_held_out(make_docs):
    assert lm.op5_lm(make_docs([])).count() == 0
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    r = lm.op5_lm(make_docs([(alone, "a b")])).first()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (3, 0, 0)
    assert r["base_score"] == pytest.approx(0.0, abs=1e-9)             # 0.1 / 0.1 for every token


@pytest.mark.parametrize("bucket", [500, 5000])
def test_driver_gets_totals_only_however_many_segments(make_docs, spark, monkeypatch, bucket):
    monkeypatch.setattr(lm, "BUCKET_BYTES", bucket)
    docs, sent, fetched = make_docs(ROWS), [], []
    context, frame = type(spark.sparkContext), type(spark.range(0))
    broadcast = context.broadcast
    monkeypatch.setattr(context, "broadcast", lambda self, value: sent.append(value) or broadcast(self, value))
    for name in ("collect", "toLocalIterator"):
        def fetch(self, *args, real=getattr(frame, name), kind=list if name == "collect" else iter, **kwargs):
            rows = list(real(self, *args, **kwargs))
            fetched.extend(rows)
            return kind(rows)
        monkeypatch.setattr(frame, name, fetch)
    out = lm.op5_lm(docs)
    assert not sent and len(fetched) <= 70 and not any(isinstance(v, (bytes, bytearray)) for r in fetched for v in r)
    assert out.count() == len(ROWS)


def test_blocks_and_buckets_change_no_exact_column(make_docs, monkeypatch):
    rows = ROWS + [(2 ** 62 + 1, "the cat sat"), (300, " \t"), (301, "the été \U0001f600 the")]
    whole = {(r["doc_id"], r["n_tokens"]): r for r in lm.op5_lm(make_docs(rows)).collect()}
    monkeypatch.setattr(lm, "BLOCK_WORDS", 50)       # a few rows a block
    monkeypatch.setattr(lm, "SEND_BYTES", 100)
    got = lm.op5_lm(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = whole[r["doc_id"], r["n_tokens"]]
        assert (r["held_out"], r["n_known"], r["train_tokens"]) == (want["held_out"], want["n_known"], want["train_tokens"])
        assert r["base_score"] == pytest.approx(want["base_score"]) and r["score"] == pytest.approx(want["score"])


def test_held_out_texts_spread_over_segments_too(make_docs, monkeypatch):
    monkeypatch.setattr(lm, "BUCKET_BYTES", 500)
    alone = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 10 == 0)
    docs = make_docs([(alone, f"never seen {i} " * 9) for i in range(100)] + [(None, "the cat"), (None, ""), (alone, None)])
    got = lm.op5_lm(docs).collect()
    assert len(got) == 103 and {r["train_tokens"] for r in got} == {4}
    assert lm.train(docs, ~lm.held_out(docs["doc_id"])).buckets >= 10
