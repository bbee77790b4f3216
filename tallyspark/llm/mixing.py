"""Mixing sources to target weights by Sainte-Lague apportionment (native).

Every document has a size in words. Sources get integer numbers of
equal-token blocks by highest quotients ``target / (2k + 1)``; the seats are
dealt shard by shard, so each shard gets its own integer quotas. Within a
source the documents are laid out in a seeded order (md5 of seed and id); the
source's word line is cut into blocks, and its quota of blocks is filled by
whole passes over the line plus one circular run from a seeded block on (the
last block of a line may be short, so the quota is counted in words there).

Defined results: null text has size 0 and is taken 0 times; a null source is a
source of its own, ordered last; a source without words has target 0; repeated
rows each count; an empty table gives an empty mix. Extra columns are ignored
by ``mix`` and kept by ``materialise``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash, word_count

BLOCK = 64
SHARDS = 8
MAX_EPOCHS = 3
WEIGHTS = (1, 2, 3)
SEED = "mix-1"
#: Documents of one source that one window task orders, about.
BUCKET_ROWS = 20_000


def sizes(docs: DataFrame, seed: str = SEED) -> DataFrame:
    """(doc_id, source, row, size, key): the words of each document, the hash
    that tells it from others of its id, and its place in the seeded order."""
    return docs.select(
        "doc_id", "source", F.xxhash64("doc_id", "source", "text").alias("row"), word_count(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"))


def source_targets(sized: DataFrame, weights: tuple = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, place, weight, target). Targets share the total
    by weight, none above ``max_epochs`` times its source.

    Capping and resharing until none is above is water filling: with sources
    ordered by cap per weight, the capped ones are the first, and the level of
    the rest is what is left over the weights that are left. The table has a
    row per source, so the windows over it are small."""
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("place", F.row_number().over(by_name) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("place") % len(weights) + 1))
    per = per.withColumn("cap", F.col("source_size") * max_epochs)
    rising = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before, rest = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    per = per.withColumn("level", (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                         / F.sum("weight").over(rest))
    free = F.min(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level")))
    per = per.withColumn("water", free.over(every)["level"])
    return per.select("source", "source_size", "place", "weight",
                      F.least(F.col("water") * F.col("weight"), F.col("cap").cast("double")).alias("target"))


def shard_quotas(targets: DataFrame, block: int = BLOCK, shards: int = SHARDS) -> DataFrame:
    """(place, shard, quota): blocks of each source in each shard.

    Seats of the first m blocks are the m highest quotients. All but a few
    seats are certain: a source surely has the seats whose quotient is above
    the mean quotient of m + n sources and surely none below that of m - n;
    only those between (three a source on average) are ranked. Sainte-Lague
    never takes a seat back when m grows, so a shard's quota is the difference
    of two apportionments."""
    total = F.sum("target").over(Window.partitionBy(F.lit(0)))
    t = targets.where("target > 0").select("place", "target", total.alias("total"),
                                           F.count("*").over(Window.partitionBy(F.lit(0))).alias("n"))
    blocks = F.round(F.col("total") / block).cast("long")
    t = t.withColumn("shard", F.explode(F.sequence(F.lit(1), F.lit(shards))))
    t = t.withColumn("m", F.expr(f"shard * cast(round(total / {block}) as long) div {shards}"))
    seats = lambda m: F.floor(F.col("target") * m / F.col("total") + F.lit(0.5))
    sure = F.when(F.col("m") > F.col("n"), F.greatest(seats(F.col("m") - F.col("n")) - 1, F.lit(0))).otherwise(F.lit(0)).cast("long")
    t = t.withColumn("sure", sure).withColumn("most", seats(F.col("m") + F.col("n")).cast("long") + 1)
    seat = (t.withColumn("k", F.explode(F.sequence(F.col("sure"), F.col("most"))))
            .withColumn("quotient", F.col("target") / (2 * F.col("k") + 1)))
    open_seats = F.col("m") - F.sum(F.when(F.col("k") == F.col("sure"), F.col("sure")).otherwise(0)).over(Window.partitionBy("shard"))
    seat = seat.withColumn("open", open_seats).withColumn(
        "rank", F.row_number().over(Window.partitionBy("shard").orderBy(F.desc("quotient"), "place", "k")))
    upto = seat.groupBy("place", "shard").agg(
        (F.first("sure") + F.sum((F.col("rank") <= F.col("open")).cast("long"))).alias("upto"))
    earlier = F.lag("upto", 1, 0).over(Window.partitionBy("place").orderBy("shard"))
    return upto.select("place", "shard", (F.col("upto") - earlier).alias("quota"))


def _hex_digits(rows: int) -> int:
    digits = 1
    while 16 ** digits * BUCKET_ROWS < rows:
        digits += 1
    return digits


def _overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.least(a1, b1) - F.greatest(a0, b0), F.lit(0))


def mix(docs: DataFrame, weights: tuple = WEIGHTS, block: int = BLOCK, shards: int = SHARDS,
        max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per document: doc_id, source, row, copy (its number among equal
    rows), key, size, source_size, target, passes (whole passes), cuts (array of [from, to) word ranges of the last,
    partial pass), taken (words in all)."""
    sized = stash(sizes(docs, seed), "mix-sizes")
    targets = source_targets(sized, weights, max_epochs)
    quota = shard_quotas(targets, block, shards).groupBy("place").agg(F.sum("quota").alias("quota"))
    of_source = targets.join(quota, "place", "left").withColumn("blocks", F.ceil(F.col("source_size") / block))
    of_source = of_source.select(
        F.col("source").alias("s"), "source_size", "target", "blocks",
        F.least(F.coalesce("quota", F.lit(0)) * block, F.col("source_size") * max_epochs).alias("words"))
    # The circular run starts at a seeded block of the source.
    start = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:start:"), F.coalesce("s", F.lit("")))), 1, 12), 16, 10).cast("long")
    of_source = (of_source.withColumn("passes", F.expr("case when source_size > 0 then words div source_size else 0L end"))
                 .withColumn("extra", F.col("words") - F.col("passes") * F.col("source_size"))
                 .withColumn("first", F.when(F.col("blocks") > 0, start % F.greatest(F.col("blocks"), F.lit(1)) * block).otherwise(0)))

    digits = _hex_digits(sized.count())
    sized = sized.withColumn("bucket", F.substring("key", 1, digits))
    sums = sized.groupBy("source", "bucket").agg(F.sum("size").alias("words"))
    along = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select(F.col("source").alias("of"), F.col("bucket").alias("b"), F.coalesce(F.sum("words").over(along), F.lit(0)).alias("base"))
    bases = bases.join(of_source, F.col("of").eqNullSafe(F.col("s")))
    inside = (Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = sized.withColumn("inner_at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = (placed.join(bases, placed["source"].eqNullSafe(bases["s"]) & (placed["bucket"] == bases["b"]))
              .withColumn("at", F.col("base") + F.col("inner_at")))
    return _taken(placed)


def _taken(placed: DataFrame) -> DataFrame:
    """Words of each document inside the source's circular run."""
    at, end, n = F.col("at"), F.col("at") + F.col("size"), F.col("source_size")
    run = F.col("first") + F.col("extra")
    wraps = run > n
    one = (F.greatest(at, F.col("first")), F.least(end, run, n))
    two = (at, F.least(end, run - n))
    cut = lambda x: F.struct((x[0] - at).alias("from"), (x[1] - at).alias("to"))
    cuts = F.filter(F.array(F.when(wraps, cut(two)), cut(one)), lambda c: c.isNotNull() & (c["to"] > c["from"]))
    placed = placed.withColumn("cuts", cuts)
    part = F.aggregate("cuts", F.lit(0).cast("long"), lambda a, c: a + c["to"] - c["from"])
    copy = F.row_number().over(Window.partitionBy("row").orderBy("at"))
    return placed.select("doc_id", "source", "row", copy.alias("copy"), "key", "size", "source_size", "target", "passes", "cuts",
                         (F.col("size") * F.col("passes") + part).alias("taken"))


def _met(docs: DataFrame, m: DataFrame) -> DataFrame:
    """Each row of ``docs`` with its own row of the mix."""
    docs = docs.withColumn("m_row", F.xxhash64("doc_id", "source", "text"))
    again = m.where("m_copy > 1").select("m_row").distinct()
    if not again.take(1):
        return docs.join(m, "m_row")
    # Equal rows are rare: only these are numbered and go through a further shuffle.
    numbered = docs.join(again, "m_row", "left_semi").withColumn("m_copy", F.row_number().over(Window.partitionBy("m_row").orderBy("m_row")))
    return docs.join(again, "m_row", "left_anti").join(m, "m_row").unionByName(numbered.join(m, ["m_row", "m_copy"]))


def materialise(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The mix as documents: a row of the whole document for each whole pass,
    and one for each word range of the partial pass (text cut at words). A
    document that no pass takes is left out; one without words is kept once.
    Rows meet by the mix's row and copy, or by doc_id in a mix without them."""
    keyed = "row" in mixed.columns
    keys = [F.col("row").alias("m_row"), F.col("copy").alias("m_copy")] if keyed else [F.col("doc_id").alias("m_id")]
    m = mixed.select(*keys, F.col("size").alias("m_size"), F.col("passes").alias("m_passes"), F.col("cuts").alias("m_cuts"))
    whole = F.when(F.col("m_size") == 0, F.lit(1)).otherwise(F.col("m_passes")).cast("int")
    full = F.struct(F.lit(0).cast("long").alias("from"), F.col("m_size").alias("to"))
    parts = F.concat(F.array_repeat(full, whole), F.when(F.col("m_size") > 0, F.col("m_cuts")).otherwise(F.array().cast("array<struct<from:bigint,to:bigint>>")))
    both = _met(docs, stash(m, "mix-cuts")) if keyed else docs.join(m, docs["doc_id"].eqNullSafe(m["m_id"]))
    both = both.withColumn("m_part", F.explode(parts))
    # Pieces are a word and the white space behind it; the first keeps what stands before it.
    pieces = F.split("text", r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    lead = F.when(F.col("text").rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    first = F.when(F.col("m_part")["from"] == 0, F.lit(1)).otherwise((F.col("m_part")["from"] + lead + 1).cast("int"))
    last = (F.col("m_part")["to"] + lead).cast("int")
    cut = F.array_join(F.slice(pieces, first, F.greatest(last - first + 1, F.lit(0))), "")
    text = F.when(F.col("m_part")["to"] - F.col("m_part")["from"] == F.col("m_size"), F.col("text")).otherwise(cut)
    both = both.withColumn("text", text)
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long")))
    return both.select(*docs.columns)


def op8_mix(docs: DataFrame) -> DataFrame:
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = f"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::bigint as size,
         md5('{SEED}:' || coalesce(doc_id::varchar, '')) as key
  from documents),
per as (
  select source, sum(size)::bigint as source_size,
         row_number() over (order by source nulls last) - 1 as place
  from sized group by source),
weighted as (select *, ([{', '.join(map(str, WEIGHTS))}])[place % {len(WEIGHTS)} + 1] as weight, source_size * {MAX_EPOCHS} as cap from per),
levels as (
  select *, ((sum(source_size) over ()) - coalesce(sum(cap) over (order by cap::double / weight, place rows between unbounded preceding and 1 preceding), 0))::double
            / (sum(weight) over (order by cap::double / weight, place rows between current row and unbounded following))::double as level
  from weighted),
water as (select level from levels where level * weight <= cap order by cap::double / weight, place limit 1),
targets as (select l.source, l.source_size, l.place, least(w.level * l.weight, l.cap::double) as target from levels l, water w),
seats as (
  select place, row_number() over (order by target / (2 * k + 1) desc, place, k) as r, m
  from (select t.place, t.target, (select round(sum(target) / {BLOCK})::bigint from targets) as m,
               unnest(range(0, (t.source_size * {MAX_EPOCHS} // {BLOCK}) + 3)) as k
        from targets t where t.target > 0)),
quotas as (select place, count(*) as quota from seats where r <= m group by place),
runs as (
  select t.*, ceil(source_size / {BLOCK})::bigint as blocks,
         least(coalesce(quota, 0) * {BLOCK}, source_size * {MAX_EPOCHS}) as q,
         ('0x' || substr(md5('{SEED}:start:' || coalesce(source, '')), 1, 12))::bigint as start
  from targets t left join quotas using (place)),
placed as (
  select s.doc_id, s.size, r.source_size, r.target, r.blocks,
         case when r.blocks > 0 then r.q // r.source_size else 0 end as passes,
         case when r.blocks > 0 then r.q % r.source_size else 0 end as extra,
         case when r.blocks > 0 then r.start % r.blocks * {BLOCK} else 0 end as head,
         coalesce(sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0) as pos
  from sized s join runs r on s.source is not distinct from r.source)
select doc_id, size, source_size, target,
       (size * passes
        + greatest(least(pos + size, head + extra, source_size) - greatest(pos, head), 0)
        + greatest(least(pos + size, head + extra - source_size) - pos, 0))::bigint as taken
from placed
"""
