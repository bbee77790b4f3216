import numpy as np
import pytest

from tallyspark.llm import token_shards as ts

ROWS = [(i, f"Text number {i} of the corpus. " * (i % 13)) for i in range(60)] + [(70, None), (71, ""), (72, "é😀 <|endoftext|> \n\t x"), (73, "word " * 9000), (3, "again"), (None, "no id")]


@pytest.mark.parametrize("n", [1, 2, 3, 5, 17, 1000, 4097])
def test_permutation(n):
    p = ts.permute(np.arange(n), n)
    assert sorted(p) == list(range(n))
    assert n < 17 or (p != ts.permute(np.arange(n), n, "other")).any()


def test_round_trip_resume_and_stride(spark, make_docs, tmp_path):
    seqs = ts.stash(ts.sequences(make_docs(ROWS).repartition(3), length=64), "seqs")
    placed, count = ts.assign_slots(seqs)
    made = ts.shards(placed, count, 64, 8).cache()
    rows = made.orderBy("shard").collect()
    assert [r["shard"] for r in rows] == list(range(-(-count // 8)))
    assert all(r["first_slot"] == 8 * r["shard"] and len(r["payload"]) == 128 * r["sequences"] == 128 * min(8, count - r["first_slot"]) for r in rows)
    ts.write_shards(made, str(tmp_path / "shards"))
    every = ts.read_from(spark, str(tmp_path / "shards"), 0, count, 8)
    assert every.shape == (count, 64)
    assert (ts.read_from(spark, str(tmp_path / "shards"), 13, 20, 8) == every[13:33]).all()
    stream = every[ts.permute(np.arange(count), count)].reshape(-1).tolist()
    with open(ts.TOKENIZER, "rb") as f:
        coder = ts.encoding(f.read())
    texts, ids = [], []
    for i in stream:
        if i == ts.SEPARATOR:
            texts.append(coder.decode(ids))
            ids = []
        else:
            ids.append(i)
    assert not ids and sorted(t for t in texts if t) == sorted(t for _, t in ROWS if t)
    owners = {d for r in rows for s in r["doc_ids"] for d in s}
    assert owners == {i for i, _ in ROWS}


def test_empty(make_docs):
    assert ts.op7_shards(make_docs([])).count() == 0
