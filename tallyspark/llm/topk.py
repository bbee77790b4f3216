"""Exact top-k by inner product over an impact-ordered index.

Vectors are dealt into index blocks. A block's components are postings (row,
dimension, value), kept in segments by quantised impact: segment L holds the
values whose absolute value has bit length L. With each segment goes, per row,
the norm of the components in lower segments.

Each query starts with a floor: its k-th best exact score among ``SEEDS`` rows.
A batch of queries goes through a block's segments from the highest impact
down, score at a time. After each segment a row's score lies within (norm of
the query) x (norm of the row's rest) of the partial one; for each query, a row
that stays below the query's floor (without one: below its k-th lower bound in
the block) is proven out. Postings of rows that no query of the batch may want are
skipped; queries of like direction make a batch. Once few (query, row) pairs are open, the lower segments are not read
for scores any more: the open pairs are rescored exactly. Blocks' winners are
merged by score, then id.

Defined results: a vector that is null or holds a null or non-finite component
takes no part, nor does a null id; shorter vectors count as padded with zeros;
rows with the query's own id are not its candidates; ties go to the smaller id;
fewer than k candidates give fewer rows; an empty table gives no rows. Extra
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

SCALE = 256
K = 5
INDEX_ROWS = 4096
#: Queries of a block: the index is shuffled once per block of queries.
QUERY_ROWS = 16_384
#: Queries of like direction that are scored together within a block.
BATCH = 64
#: Queries by whose nearest one the others are put in order.
PIVOTS = 128
#: With this share of a batch's (query, row) pairs open, these are rescored exactly.
RESCORE_SHARE = 0.1
#: Rows whose exact scores give each query its first floor.
SEEDS = 8192
#: (query, row) pairs that are rescored at once.
PAIRS = 1 << 16

_PACKED = "kind string, block long, level int, ids binary, shape array<int>, rows binary, dims binary, vals binary, rest binary"


def quantise(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """(vec_id, q): floor(scale * x) of each component as double."""
    x = F.transform("embedding", lambda v: v.cast("double"))
    # An unordered comparison with null or NaN is not true, so these fail the test too.
    good = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return (vectors.where(F.col("embedding").isNotNull() & F.col("vec_id").isNotNull() & good)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * scale)).alias("q")))


def _matrix(vectors: pd.Series) -> np.ndarray:
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), dtype=np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def _index_block(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("vec_id")
    m = _matrix(pdf["q"])
    bits = np.frexp(np.abs(m).astype(np.float64))[1]
    made = []
    for level in sorted(set(bits[m != 0].tolist()) | {0}, reverse=True):
        rows, dims = np.nonzero(bits == level) if level else (np.empty(0, int),) * 2
        lower = np.where(bits < level, m, 0).astype(np.float64)
        # Rounded up a little: a bound must never fall short.
        rest = np.sqrt((lower * lower).sum(axis=1)) * (1 + 1e-9)
        made.append(("index", int(pdf["block"].iloc[0]), level, pdf["vec_id"].to_numpy(np.int64).tobytes(), list(m.shape),
                     rows.astype(np.int32).tobytes(), dims.astype(np.int32).tobytes(), m[rows, dims].tobytes(), rest.tobytes()))
    return pd.DataFrame(made, columns=[c.split()[0] for c in _PACKED.split(", ")])


def _query_block(k: int, seeds):
    """Packs a block of queries with their floors; ``seeds`` broadcasts (ids, matrix)."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("vec_id")
        m, ids = _matrix(pdf["q"]), pdf["vec_id"].to_numpy(np.int64)
        empty = b""
        return pd.DataFrame([("query", int(pdf["block"].iloc[0]), 0, ids.tobytes(), list(m.shape), empty, empty, m.tobytes(),
                              first_floors(ids, m, *seeds.value, k).tobytes())], columns=[c.split()[0] for c in _PACKED.split(", ")])
    return run


def _fit(m: np.ndarray, width: int) -> np.ndarray:
    return m[:, :width] if m.shape[1] >= width else np.pad(m, ((0, 0), (0, width - m.shape[1])))


def _number_type(queries: np.ndarray, largest: int):
    """The narrowest type that holds every partial inner product exactly."""
    reach = max(int(np.abs(queries).max(initial=0)), 1) * max(largest, 1) * max(queries.shape[1], 1)
    return np.float32 if reach < 2**24 else np.float64 if reach < 2**53 else np.int64


def first_floors(query_ids, queries, seed_ids, seeds, k):
    """Each query's k-th best score among the seeds other than itself, which
    are candidates too; minus infinity where there are fewer. As a double not
    above the exact score."""
    floors = np.full(len(query_ids), -np.inf)
    width = max(queries.shape[1], seeds.shape[1])
    queries, seeds = _fit(queries, width), _fit(seeds, width)
    kind = _number_type(queries, int(np.abs(seeds).max(initial=0)))
    low = -np.inf if kind != np.int64 else np.iinfo(np.int64).min
    for at in range(0, len(query_ids), BATCH):
        own = query_ids[at:at + BATCH, None] == seed_ids[None, :]
        found = np.where(own, low, queries[at:at + BATCH].astype(kind) @ seeds.astype(kind).T)
        enough = (~own).sum(axis=1) >= k
        if enough.any():
            kth = np.partition(found[enough], len(seed_ids) - k, axis=1)[:, len(seed_ids) - k]
            floors[at:at + BATCH][enough] = np.nextafter(kth.astype(np.float64), -np.inf)
    return floors


def search_block(query_ids, queries, ids, segments, k, floors=None, work=None):
    """Yield (query id, ids, scores) of the k best rows of one index block, of
    those that reach the query's floor.

    ``segments``: (level, rows, dims, values, rest) in any order. ``work``, if
    given, counts the postings scored, the pairs rescored and all pairs."""
    segments = sorted(segments, key=lambda s: -s[0])
    floors = np.full(len(query_ids), -np.inf) if floors is None else floors
    kind = _number_type(queries, max((int(np.abs(s[3]).max(initial=0)) for s in segments), default=0))
    exact = np.zeros((len(ids), queries.shape[1]), dtype=kind)
    for _, rows, dims, values, _ in segments:
        inside = dims < exact.shape[1]
        exact[rows[inside], dims[inside]] = values[inside]
    work = {} if work is None else work
    like = _by_direction(queries)
    for at in range(0, len(query_ids), BATCH):
        part = like[at:at + BATCH]
        yield from _search_batch(query_ids[part], queries[part].astype(kind), ids, segments, exact, k, floors[part], work)


def _by_direction(queries: np.ndarray) -> np.ndarray:
    """Order in which queries of like direction stand together: they drop the same rows."""
    unit = queries / np.maximum(np.sqrt((queries.astype(np.float64) ** 2).sum(axis=1)), 1)[:, None]
    pivots = unit[np.unique(np.linspace(0, len(unit) - 1, PIVOTS).astype(int))]
    return np.argsort((unit @ pivots.T).argmax(axis=1), kind="stable")


def _search_batch(query_ids, q, ids, segments, exact, k, floors, work):
    n, asked = len(ids), len(query_ids)
    norm = np.sqrt((q.astype(np.float64) ** 2).sum(axis=1))[:, None] * (1 + 1e-9)
    opened = query_ids[:, None] != ids[None, :]
    score = np.zeros((asked, n), dtype=q.dtype)
    left = np.arange(n)
    for level, rows, dims, values, rest in segments:
        if opened.sum() <= max(asked * (k + 1), asked * n * RESCORE_SHARE):
            break
        at = np.full(n, -1)
        at[left] = np.arange(len(left))
        keep = (at[rows] >= 0) & (dims < q.shape[1])
        part = np.zeros((len(left), q.shape[1]), dtype=q.dtype)
        part[at[rows[keep]], dims[keep]] = values[keep]
        work["postings"] = work.get("postings", 0) + int(keep.sum()) * asked
        score[:, left] += q @ part.T
        slack = norm * rest[left][None, :] + 1e-6
        best = score[:, left].astype(np.float64)
        least = floors[:, None]
        if len(left) > k and np.isinf(floors).any():
            bound = np.where(opened[:, left], best - slack, -np.inf)
            least = np.maximum(least, np.partition(bound, len(left) - k, axis=1)[:, len(left) - k][:, None])
        opened[:, left] &= best + slack >= least
        left = left[opened[:, left].any(axis=0)]
    # Exact scores of the pairs that are still possible, a bounded number at a time.
    at_query, at_row = np.nonzero(opened)
    work["rescored"] = work.get("rescored", 0) + len(at_query)
    work["pairs"] = work.get("pairs", 0) + asked * n
    final = np.empty(len(at_query), dtype=np.int64)
    for at in range(0, len(at_query), PAIRS):
        some = slice(at, at + PAIRS)
        final[some] = np.einsum("ij,ij->i", q[at_query[some]], exact[at_row[some]]).astype(np.int64)
    order = np.lexsort((ids[at_row], -final, at_query))
    bounds = np.searchsorted(at_query[order], np.arange(asked + 1))
    for i, qid in enumerate(query_ids):
        best = order[bounds[i]:bounds[i + 1]][:k]
        best = best[final[best] >= floors[i]]
        if len(best):
            yield int(qid), ids[at_row[best]], final[best]


def _search(k: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ints = lambda b, t=np.int32: np.frombuffer(b, dtype=t)
        asked, segs = pdf[pdf["kind"] == "query"], pdf[pdf["kind"] == "index"]
        out = []
        if len(asked) and len(segs):
            row = asked.iloc[0]
            queries = ints(row["vals"], np.int64).reshape(tuple(row["shape"]))
            ids, width = ints(segs.iloc[0]["ids"], np.int64), max(segs.iloc[0]["shape"][1], queries.shape[1])
            segments = [(s.level, ints(s.rows), ints(s.dims), ints(s.vals, np.int64), ints(s.rest, np.float64)) for s in segs.itertuples()]
            floors = ints(row["rest"], np.float64)
            for qid, found, scores in search_block(ints(row["ids"], np.int64), _fit(queries, width), ids, segments, k, floors):
                out.append(pd.DataFrame({"query_id": qid, "vec_id": found, "score": scores}))
        return pd.concat(out) if out else pd.DataFrame({c: pd.Series(dtype="int64") for c in ("query_id", "vec_id", "score")})
    return run


def build_index(vectors: DataFrame, blocks: int) -> DataFrame:
    """Segments of every block of the quantised ``vectors``."""
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks)))
    return dealt.groupBy("block").applyInPandas(_index_block, _PACKED)


def _per_block(rows: DataFrame, column: str, blocks: int) -> DataFrame:
    return rows.withColumn(column, F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K, index_rows: int = INDEX_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) for quantised (vec_id, q) frames."""
    rows = vectors.count()
    blocks = max(1, -(-rows // index_rows))
    parts = max(1, -(-queries.count() // query_rows))
    index = stash(build_index(vectors, blocks), "topk-index")
    # About SEEDS rows are left before they are put in order, so tasks send few to the driver.
    some = vectors.where(F.pmod(F.xxhash64("vec_id"), F.lit(max(1, rows // SEEDS))) == 0)
    seeds = some.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SEEDS).toPandas()  # at most SEEDS rows
    box = vectors.sparkSession.sparkContext.broadcast((seeds["vec_id"].to_numpy(np.int64), _matrix(seeds["q"])))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(parts))).groupBy("block").applyInPandas(_query_block(k, box), _PACKED)
    # Each index block meets each query block once: rows of both go to the pair's task.
    pairs = _per_block(index, "query_block", parts).unionByName(_per_block(asked.withColumnRenamed("block", "query_block"), "block", blocks))
    found = pairs.groupBy("block", "query_block").applyInPandas(_search(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op2_topk(embeddings: DataFrame) -> DataFrame:
    vectors = quantise(embeddings)
    return top_k(vectors, vectors.where("vec_id % 50 = 0"))


ORACLE = f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as q
  from embeddings
  where embedding is not null and vec_id is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select a.vec_id as query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::bigint as score
  from v a join v b on a.vec_id <> b.vec_id where a.vec_id % 50 = 0),
ranked as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= {K}
"""
