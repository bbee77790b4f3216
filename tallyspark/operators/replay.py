"""Replay picks (R30) and the pick purge."""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyspark.session import ensure_checkpoint_dir


def pick_best(replay: DataFrame, buckets: Iterable[str] | None = None, min_arena: int = 2,
              bucket_pred: Column | None = None) -> DataFrame:
    """Per (bucket, arena) with ``arena >= min_arena``: the replay with the
    highest score, ties to the smallest ``uniqueKey``, NULL scores last. The
    full replay row is returned. ``buckets`` lists bucket keys;
    ``bucket_pred`` selects them by predicate instead (a long series).

    The winner of a group is found with a ``min`` over a small ranking
    struct, which Spark pre-aggregates in every task: a bucket or arena
    holding a third of all replays still shuffles one row per task. The
    full rows of the winners are then fetched by key (semi-join), so wide
    documents never travel through the aggregate.
    """
    src = replay
    if buckets is not None:
        src = src.where(F.col("dateHour").isin(list(buckets)))
    if bucket_pred is not None:  # a bucket series given as a predicate
        src = src.where(bucket_pred)
    src = src.where(F.col("arena") >= F.lit(min_arena))
    return _documents(src, winners(src))


def winners(src: DataFrame) -> DataFrame:
    """(uniqueKey, dateHour, arena) of the best replay of each bucket and arena."""
    rank = F.struct(F.col("score").isNull().alias("no_score"),
                    (-F.col("score").cast("bigint")).alias("neg_score"),
                    F.col("uniqueKey").alias("key"))
    best = src.groupBy("dateHour", "arena").agg(F.min(rank).alias("best"))
    return best.select(F.col("best.key").alias("uniqueKey"), "dateHour", "arena")


def _documents(src: DataFrame, best: DataFrame) -> DataFrame:
    s, w = src.alias("s"), best.alias("w")
    same = ((F.col("s.uniqueKey") == F.col("w.uniqueKey")) & (F.col("s.arena") == F.col("w.arena"))
            & F.col("s.dateHour").eqNullSafe(F.col("w.dateHour")))
    return s.join(w, same, "left_semi").select("s.*")


#: Bits of the winners' filter per winner, and at most.
FILTER_BITS, MOST_FILTER_BITS = 16, 1 << 20
#: Seeds of its two probes.
PROBES = (17, 91)


def fetch_best(replay: DataFrame, bucket_pred: Column, min_arena: int = 2) -> DataFrame:
    """The rows of ``pick_best``, for tables with wide documents.

    A first pass reads the four narrow columns only and leaves the winners'
    keys in a small table under the checkpoint folder. Two hash bits of each
    make a Bloom filter of at most ``MOST_FILTER_BITS`` (128 KB), whatever
    the number of winners. The second pass tests it in the scan of the full
    documents, so only winners and a few others (2 % at 12 bits a winner) go
    into the exact join: unpicked documents are never exchanged, whether
    Spark broadcasts or not.
    """
    spark = replay.sparkSession
    src = replay.where(bucket_pred & (F.col("arena") >= F.lit(min_arena)))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/winners-{uuid.uuid4().hex[:12]}"
    found = winners(src.select("uniqueKey", "dateHour", "arena", "score"))
    found.write.parquet(path)
    best = spark.read.schema(found.schema).parquet(path)
    n = best.count()
    if not n:
        return src.limit(0)
    words = min(MOST_FILTER_BITS, 1 << (n * FILTER_BITS - 1).bit_length()) // 64
    words = max(words, 1)

    def bit(key: str, probe: int) -> Column:
        return F.pmod(F.xxhash64(key, F.lit(probe)), F.lit(words * 64))
    bits = best.select(F.explode(F.array(*[bit("uniqueKey", p) for p in PROBES])).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    filled = {r["word"]: r["mask"] for r in bits.groupBy(F.expr("cast(bit div 64 as int)").alias("word")).agg(F.bit_or(one).alias("mask")).collect()}
    mask = F.split(F.lit(",".join(str(filled.get(i, 0)) for i in range(words))), ",").cast("array<bigint>")  # folded into one literal

    def has(probe: int) -> Column:
        at = bit("uniqueKey", probe)
        word = F.get(mask, F.floor(at / 64).cast("int"))
        return F.call_function("shiftrightunsigned", word, (at % 64).cast("int")).bitwiseAND(F.lit(1)) == 1
    maybe = has(PROBES[0])
    for probe in PROBES[1:]:
        maybe = maybe & has(probe)
    return _documents(src.where(maybe), best)


def purge_picks(picks: DataFrame, first_bucket: str) -> DataFrame:
    """Picks kept by the purge: ``dateHour`` not before the first bucket's
    day (text order on ``yyyyMMdd``)."""
    return picks.where(F.col("dateHour") >= F.lit(first_bucket[:8]))
