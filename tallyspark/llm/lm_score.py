"""Language-model scores from a log-frequency Bloom filter.

Word and word-pair counts of all training texts are gathered by code bucket.
Each bucket becomes a filter segment: an n-gram of count c is stored as the
keys (code, 1) ... (code, q) with q = 1 + floor(log_BASE(c)), so probing
(code, 1), (code, 2), ... until one is absent reads its count back, rounded
down. Segments have about ``BUCKET_BYTES`` of text behind them (twice that at
most, training or not). No filter leaves its task: texts are packed into blocks,
each block sends its distinct codes to their buckets' tasks, which build the
segment, probe it for every block and send a byte a code back. The driver sees
totals only, and a task one segment or one block at a time.

Every word and pair is stored, those seen once too, and there is a level for
every count that 64 bits hold. The smoothed probability of word w
after h (h: the end token before the first word) is::

    (pair(h, w) + PRIOR * (word(w) + ADD) / (N + ADD * (V + 1))) / (word(h) + PRIOR)

with rounded counts from the filter; word(h) is taken one step up, so that the
probabilities after h never sum to more than 1 (but for false positives).

The at most ``TOP`` most frequent words enter with their exact counts.

``base_score`` is the exact add-``ADD`` unigram score; the exact counts of words
come back beside their levels.

Defined results: null text is empty; an empty text has the end token alone; a
null id is not held out; repeated rows are scored each; without training texts
N and V are 0; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash
from .textcodes import mix, word_codes

ADD = 0.1
PRIOR = 8.0
BASE = 1.5
#: No count of 63 bits is beyond this level.
LEVELS = 108
HASHES, BITS_PER_KEY = 5, 10
TOP = 1 << 19
BUCKET_BYTES = 16 << 20
#: Words that a block holds, at some six characters a word.
BLOCK_WORDS = 2_000_000
#: Bytes that a task sends at once.
SEND_BYTES = 4 << 20
END = np.uint64(0x5EED_0E7D_0E7D_5EED)

_BLOCKS = "block long, ids binary, named binary, known binary, sizes binary, octets long, known_octets long, texts binary"
_GRAMS = "block long, kind int, bucket long, codes binary, counts binary"
_FOUND = "block long, kind int, bucket long, levels binary, counts binary, types long, tokens long, at_least array<long>"
_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def held_out(doc_id: Column, parts: int = 10) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % parts == 0, F.lit(False))


def _tokens(texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all tokens (each text's words and the end), those of the token
    before each, and the number of tokens of each text."""
    codes, counts = word_codes(texts)
    ends = np.cumsum(counts)
    tokens = np.insert(codes, ends, END)
    before = np.empty_like(tokens)
    before[:1], before[1:] = END, tokens[:-1]
    return tokens, before, counts + 1


def _pairs(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(tokens))


def _level(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE) + 1e-9).astype(np.int64)


def level_count(level: np.ndarray) -> np.ndarray:
    """Least count of a level; 0 for level 0."""
    return np.where(level > 0, np.ceil(BASE ** (level - 1.0) - 1e-9), 0.0)


def _places(codes: np.ndarray, level: int | np.ndarray, size: int) -> Iterator[np.ndarray]:
    with np.errstate(over="ignore"):
        one = mix(codes + np.uint64(0x94D049BB133111EB) * np.asarray(level, dtype=np.uint64))
        two = mix(one) | np.uint64(1)
        for i in range(HASHES):
            yield (one + np.uint64(i) * two) % np.uint64(size)


def build_segment(codes: np.ndarray, counts: np.ndarray) -> tuple[int, bytes]:
    level = _level(counts)
    keys = np.repeat(codes, level)
    steps = np.arange(len(keys)) - np.repeat(np.cumsum(level) - level, level) + 1
    size = max(64, 8 * -(-len(keys) * BITS_PER_KEY // 8))
    bits = np.zeros(size // 8, dtype=np.uint8)
    for place in _places(keys, steps, size):
        np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
    return size, bits.tobytes()


def probe(codes: np.ndarray, size: int, bits: bytes) -> np.ndarray:
    """Level of each code in a segment."""
    held = np.frombuffer(bits, dtype=np.uint8)
    level, active = np.zeros(len(codes), np.int64), np.arange(len(codes))
    for step in range(1, LEVELS + 1):
        ok = np.ones(len(active), bool)
        for place in _places(codes[active], step, size):
            ok &= (held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
        active = active[ok]
        if not len(active):
            break
        level[active] = step
    return level


def pack(docs: DataFrame, known: Column) -> DataFrame:
    """``docs`` as blocks (rows of _BLOCKS): ids, whether they are given,
    whether the row is for training, bytes of each text and all texts."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        block, held, size = np.int64(TaskContext.get().partitionId()) << 40, [], 0
        for pdf in batches:
            for row in zip(pdf["doc_id"], pdf["named"], pdf["known"], pdf["text"]):
                held.append(row)
                size += len(row[3]) + 64  # rows without text fill a block, too
                if size >= 6 * BLOCK_WORDS:
                    yield one(block, held)
                    block, held, size = block + 1, [], 0
        if held:
            yield one(block, held)

    def one(block: int, held: list[tuple]) -> pd.DataFrame:
        ids, named, known, texts = zip(*held)
        coded = [t.encode("utf-8", "surrogatepass") for t in texts]
        sizes, train = np.array([len(t) for t in coded], np.int64), np.array(known, bool)
        return pd.DataFrame({"block": block, "ids": [np.array(ids, np.int64).tobytes()], "named": [np.array(named, bool).tobytes()], "known": [train.tobytes()],
                             "sizes": [sizes.tobytes()], "octets": sizes.sum(), "known_octets": sizes[train].sum(),
                             "texts": [pa.compress(b"".join(coded), codec="zstd", asbytes=True)]})

    doc_id = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(doc_id, F.lit(0)).alias("doc_id"), doc_id.isNotNull().alias("named"), F.coalesce(known, F.lit(False)).alias("known"),
                       F.coalesce("text", F.lit("")).alias("text")).mapInPandas(emit, _BLOCKS)


def _unpack(sizes: bytes, texts: bytes) -> list[str]:
    ends = np.cumsum(np.frombuffer(sizes, np.int64)).tolist()
    data = pa.decompress(texts, decompressed_size=ends[-1], codec="zstd", asbytes=True)
    return [data[a:b].decode("utf-8", "surrogatepass") for a, b in zip([0, *ends], ends)]


def _spread(codes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes, the place of each of ``codes`` among them, their order by
    bucket and code, and where in that order buckets begin."""
    distinct, back = np.unique(codes, return_inverse=True)
    bucket = distinct % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return distinct, back, order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def _squeeze(codes: np.ndarray, buckets: int) -> bytes:
    """Rising codes of one bucket as steps, most significant bytes together:
    these are mostly 0 and cost nothing once compressed."""
    steps = np.diff(codes // np.uint64(buckets), prepend=np.uint64(0))
    return np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes()


def _expand(data: bytes, bucket: int, buckets: int) -> np.ndarray:
    steps = np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64) * np.uint64(buckets) + np.uint64(bucket)


def count_grams(blocks: DataFrame, buckets: int) -> DataFrame:
    """The distinct words (kind 0) and pairs (kind 1) of each block by bucket
    (rows of _GRAMS), with their counts in the block's training texts."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for pdf in batches:
            for block, known, sizes, texts in zip(pdf["block"], pdf["known"], pdf["sizes"], pdf["texts"]):
                tokens, before, counts = _tokens(_unpack(sizes, texts))
                train = np.repeat(np.frombuffer(known, bool), counts)
                for kind in (0, 1):
                    codes, back, order, cuts = _spread(tokens if kind == 0 else _pairs(before, tokens), buckets)
                    times = np.bincount(back[train], minlength=len(codes)).astype(np.uint32)
                    for b in np.flatnonzero(np.diff(cuts)).tolist():
                        part = order[cuts[b]:cuts[b + 1]]
                        held.append((block, kind, b, _squeeze(codes[part], buckets), times[part].tobytes()))
                        size += 12 * len(part)
                        if size >= SEND_BYTES:
                            yield pd.DataFrame(held, columns=[c.split()[0] for c in _GRAMS.split(", ")])
                            held, size = [], 0
        if held:
            yield pd.DataFrame(held, columns=[c.split()[0] for c in _GRAMS.split(", ")])

    return blocks.select("block", "known", "sizes", "texts").mapInPandas(run, _GRAMS)


def look_up(grams: DataFrame, buckets: int) -> DataFrame:
    """The level of each block's codes in their bucket's segment, for words also
    the exact counts (rows of _FOUND); for a bucket of words a row of its types,
    tokens and numbers of words by least count, without a block."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        kind, bucket = int(pdf["kind"].iloc[0]), int(pdf["bucket"].iloc[0])
        asked = [_expand(b, bucket, buckets) for b in pdf["codes"]]
        cuts = np.cumsum([0] + [len(a) for a in asked]).tolist()
        codes, back = np.unique(np.concatenate(asked), return_inverse=True)
        counts = np.bincount(back, weights=np.concatenate([np.frombuffer(b, np.uint32) for b in pdf["counts"]])).astype(np.int64)
        stored = counts > 0
        level = probe(codes, *build_segment(codes[stored], counts[stored])).astype(np.uint8)[back]
        times = counts[back] if kind == 0 else counts[:0]
        out = [(block, kind, bucket, level[a:b].tobytes(), times[a:b].tobytes(), None, None, None) for block, a, b in zip(pdf["block"], cuts, cuts[1:])]
        if kind == 0:
            out.append((None, kind, bucket, b"", b"", int(stored.sum()), int(counts.sum()), [int((counts >= _threshold(i)).sum()) for i in range(64)]))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _FOUND.split(", ")]).astype({"block": "Int64", "types": "Int64", "tokens": "Int64"})

    return grams.groupBy("kind", "bucket").applyInPandas(run, _FOUND)


def _threshold(i: int) -> int:
    return math.ceil(2 ** (i / 2))


class Model:
    """What scoring needs: written tables of the blocks and of what their codes
    found, and on the driver totals only."""

    def __init__(self, blocks: DataFrame, buckets: int):
        self.blocks, self.buckets = blocks, buckets
        found = stash(look_up(count_grams(blocks, buckets), buckets), "lm-found")
        self.found = found.where("block is not null").select("block", "kind", "bucket", "levels", "counts")
        words = found.where("block is null")
        total = words.agg(F.sum("types"), F.sum("tokens")).first()
        self.types, self.tokens = total[0] or 0, total[1] or 0
        ranks = words.select(F.posexplode("at_least").alias("i", "n")).groupBy("i").agg(F.sum("n").alias("n")).collect()  # 64 rows
        #: Words of this count or more, TOP at most, enter with their exact counts.
        self.least = min((_threshold(r["i"]) for r in ranks if r["n"] <= TOP), default=1)


def train(docs: DataFrame, known: Column) -> Model:
    """The model of the rows of ``docs`` that are ``known``, and what all rows find in it."""
    blocks = stash(pack(docs, known), "lm-blocks")
    size = blocks.agg(F.sum("known_octets"), F.sum("octets")).first()
    # The second: texts that are not for training must not crowd few segments.
    return Model(blocks, max(1, int((size[0] or 0) // BUCKET_BYTES), int((size[1] or 0) // (2 * BUCKET_BYTES))))


def score(model: Model) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, base_score, score) of each row of the model's blocks."""
    buckets, least = model.buckets, model.least
    total = model.tokens + ADD * (model.types + 1)

    def put(found: pd.DataFrame, column: str, dtype: type, order: np.ndarray) -> np.ndarray:
        values = np.frombuffer(b"".join(found[column]), dtype)
        if len(values) != len(order):
            raise ValueError(f"{len(values)} {column} for {len(order)} codes")
        out = np.empty(len(order), np.int64)
        out[order] = values
        return out

    def judge(blocks: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        ids, named, sizes, texts = blocks[["ids", "named", "sizes", "texts"]].iloc[0]
        tokens, before, counts = _tokens(_unpack(sizes, texts))
        found = found.sort_values("bucket")
        words, pairs = found[found["kind"] == 0], found[found["kind"] == 1]
        word, back, order, _ = _spread(tokens, buckets)
        level, true = put(words, "levels", np.uint8, order), put(words, "counts", np.int64, order)
        exact = (true > 0) & (true >= least)
        low = np.where(exact, true, level_count(level))
        high = np.where(exact, true, np.where(level > 0, level_count(level + 1) - 1, 0.0))
        _, pair_back, order, _ = _spread(_pairs(before, tokens), buckets)
        seen = level_count(put(pairs, "levels", np.uint8, order))[pair_back]
        # The first token of each text follows the end token, which is among the words.
        owner = np.repeat(np.arange(len(counts)), counts)
        previous = np.searchsorted(word, before)
        p = (np.minimum(seen, high[previous]) + PRIOR * (low[back] + ADD) / total) / (high[previous] + PRIOR)
        add = lambda x: np.bincount(owner, weights=x, minlength=len(counts))
        return pd.DataFrame({"doc_id": pd.arrays.IntegerArray(np.frombuffer(ids, np.int64).copy(), ~np.frombuffer(named, bool)), "n_tokens": counts,
                             "n_known": add(true[back] > 0).astype(np.int64), "base_score": add(np.log10((true + ADD) / total)[back]), "score": add(np.log10(p))})

    blocks = model.blocks.select("block", "ids", "named", "sizes", "texts")
    rows = blocks.groupBy("block").cogroup(model.found.groupBy("block")).applyInPandas(judge, _SCORES)
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", "n_known", "base_score", "score")


def op5_lm(docs: DataFrame) -> DataFrame:
    model = train(docs, ~held_out(F.col("doc_id")))
    return score(model).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
