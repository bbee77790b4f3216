import duckdb
import pytest
from pyspark.sql import functions as F

from tallyspark.llm import mixing
from tallyspark.llm.common import word_count


def test_quotas_are_the_highest_quotients(spark):
    targets = spark.createDataFrame([(0, 530.0), (1, 240.0), (2, 230.0)], "place int, target double")
    got = {(r["place"], r["shard"]): r["quota"] for r in mixing.shard_quotas(targets, block=100, shards=2).collect()}
    seats = sorted(((t / (2 * k + 1), -p) for p, t in ((0, 530), (1, 240), (2, 230)) for k in range(20)), reverse=True)
    for shard in (1, 2):
        for place in (0, 1, 2):
            assert sum(got[place, s] for s in range(1, shard + 1)) == sum(-p == place for _, p in seats[:shard * 5])


def test_oracle_agrees_on_ties_nulls_and_tiny_sources(spark, make_docs, tmp_path):
    docs = make_docs([(i, "w " * (i % 7 * 9), ["a", "b", None, "tiny"][i % 4] if i % 20 else "tiny") for i in range(300)]
                     + [(1, "w " * 9, "b"), (1, "w " * 9, "b"), (None, None, "empty"), (400, "", "empty")])
    docs.toPandas().to_parquet(tmp_path / "documents.parquet")
    con = duckdb.connect()
    con.execute(f"create view documents as from '{tmp_path}/documents.parquet'")
    key = lambda r: tuple(map(str, r))
    want = sorted(con.execute(f"select doc_id, size, source_size, target, taken from ({mixing.ORACLE})").fetchall(), key=key)
    got = sorted((tuple(r) for r in mixing.op8_mix(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()), key=key)
    assert got == want


def test_targets_shares_and_caps(spark, make_docs):
    docs = make_docs([(i, "w " * 100, "a" if i < 90 else "b" if i < 98 else "c") for i in range(100)])
    mixed = mixing.mix(docs).cache()
    rows = {r["source"]: r for r in mixed.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("n"), F.first("source_size").alias("s")).collect()}
    # c wants half, b a third: both stop at three times their size and a takes the rest
    assert (rows["c"]["t"], rows["b"]["t"], rows["a"]["t"]) == (600.0, 2400.0, 7000.0)
    assert all(abs(r["n"] - r["t"]) <= 2 * mixing.BLOCK for r in rows.values())
    assert mixed.where("taken > 3 * size").count() == 0
    assert mixing.mix(docs).select("doc_id", "taken").exceptAll(mixed.select("doc_id", "taken")).count() == 0
    text = mixing.materialise(docs, mixed)
    assert text.columns == docs.columns
    words = {r[0]: r[1] for r in text.groupBy("doc_id").agg(F.sum(word_count(F.col("text")))).collect()}
    assert {r["doc_id"]: r["taken"] for r in mixed.collect() if r["taken"]} == words


def test_cut_keeps_white_space(spark, make_docs):
    docs = make_docs([(1, "  a\tb\n c d", "s")])
    part = spark.createDataFrame([(1, 4, 0, [(1, 3)])], "doc_id long, size long, passes long, cuts array<struct<from:long,to:long>>")
    assert [r["text"] for r in mixing.materialise(docs, part).collect()] == ["b\n c "]


def test_empty(spark, make_docs):
    assert mixing.op8_mix(make_docs([])).count() == 0


@pytest.mark.parametrize("text, n", [(None, 0), ("", 0), (" \t\n", 0), ("a\u00a0b c", 2), ("x" * 100000, 1)])
def test_words(spark, make_docs, text, n):
    assert mixing.sizes(make_docs([(1, text)])).first()["size"] == n


def test_rows_without_or_of_one_id_are_their_own(spark, make_docs):
    rows = [(None if i % 3 else 7, " ".join(f"{'nv'[i % 2]}{i}x{j}" for j in range(20 + i)), "ab"[i % 2]) for i in range(30)]
    rows += [rows[1]] * 3 + [(None, None, "a")] * 2
    docs = make_docs(rows)
    mixed = mixing.mix(docs)
    out = mixing.materialise(docs, mixed)
    words = {r[0]: r[1] for r in out.where("text is not null").groupBy(F.substring_index(F.trim("text"), "x", 1)).agg(F.sum(word_count(F.col("text")))).collect()}
    taken = mixed.join(docs.select(F.xxhash64("doc_id", "source", "text").alias("row"), "text").distinct(), "row").where("taken > 0")
    assert words == {r[0]: r[1] for r in taken.groupBy(F.substring_index("text", "x", 1)).agg(F.sum("taken")).collect()}
    assert out.where("text is null").count() == 2 and out.columns == docs.columns
