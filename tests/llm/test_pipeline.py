import inspect
import random

import corpus_pipeline as cp

import __spark_entry__ as entry
from tallyspark.llm import token_shards

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    rng = random.Random(4)
    word = lambda: rng.choice("ka re mi to su ve lo na bi du".split()) + rng.choice("nd st ra ble ing or el as".split())
    text = lambda n: " ".join(word() + word() for _ in range(n))
    docs = [(i, text(80)) for i in range(60)]
    docs += [(100, docs[0][1]), (101, docs[1][1] + " end"), (102, None), (103, ""), (104, "")]
    item = text(20)
    docs += [(110, text(30) + " " + item + " " + text(30))]
    docs += [(120 + i, text(20) + " you are a scum and an idiot and a moron " + text(20)) for i in range(8)]
    rows = [(i, t, "en", f"s{i % 2}", len(t) if t is not None else None) for i, t in docs]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i >= 120)) for i, _ in docs], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in cp.STAGES:
        out = stage(spark, now, str(tmp_path))
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        if name != cp.STAGES[-1][0]:
            assert now.columns == COLUMNS
            seen[name] = {r["doc_id"] for r in now.select("doc_id").collect()}
    every = {i for i, _ in docs}
    assert seen["toxicity"] == every - set(range(120, 128))
    assert seen["near_duplicates"] == seen["toxicity"] - {100, 101}
    assert seen["decontamination"] == seen["near_duplicates"] - {110}
    assert seen["mixing"] <= seen["decontamination"]
    assert now.agg({"sequences": "sum"}).first()[0] > 0
    whole = cp.run(spark, str(tmp_path))
    assert whole.columns == [c.split()[0] for c in token_shards.SHARD.replace("array<array<long>>", "x").split(", ")]


def test_registered():
    names = entry.queries()
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert names["pipeline"] is cp.run
    assert [list(inspect.signature(f).parameters) for _, f in cp.STAGES] == [["spark", "docs", "sf_dir"]] * 5


def test_empty_documents(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert cp.run(spark, str(tmp_path)).count() == 0
