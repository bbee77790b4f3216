"""Training-order materialisation of token ids.

Texts are tokenised in place; each task joins its documents, with a separator
after each, to one stream and cuts it into sequences of ``LENGTH`` ids (only a
task's last sequence is padded). Numbered densely, task by task, sequence s
gets the global slot ``permute(s)``: a keyed Feistel network over the next
power of four, walked along its cycle until the value is below the number of
sequences. Rows are then range-partitioned by shard and written as records of a
fixed stride, so slot k lies at byte ``(k % per_shard) * stride`` of shard
``k // per_shard``: reading is sequential and can resume at any slot.

Defined results: null and empty texts give the separator alone; repeated rows
are repeated in the stream; an empty table gives no shards; a null id is kept
as null; extra columns are ignored. A text of any length is cut over as many
sequences as it needs.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stash

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Split pattern of that vocabulary, and the free id used as separator and padding.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SEPARATOR = 50256
LENGTH, PER_SHARD, KEY = 2048, 256, "order-1"
ROUNDS = 6

_SEQUENCE = "task long, place long, doc_ids array<long>, payload binary"
SHARD = "shard long, first_slot long, sequences int, stride int, doc_ids array<array<long>>, payload binary"


def encoding(ranks_file: bytes):
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines())}
    return tiktoken.Encoding("training", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def permute(values: np.ndarray, count: int, key: str = KEY) -> np.ndarray:
    """The keyed permutation of range(count), applied to ``values``."""
    half = max(1, (max(int(count) - 1, 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    keys = [np.uint64(int.from_bytes(hashlib.sha256(f"{key}:{r}".encode()).digest()[:8], "big")) for r in range(ROUNDS)]

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> np.uint64(half), x & mask
        for k in keys:
            mixed = (right + k) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed >> np.uint64(32)) & mask)
        return (left << np.uint64(half)) | right

    with np.errstate(over="ignore"):
        out = once(np.asarray(values, dtype=np.uint64))
        while (outside := out >= np.uint64(count)).any():
            out[outside] = once(out[outside])
    return out.astype(np.int64)


def sequences(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH) -> DataFrame:
    """(task, place, doc_ids, payload): a row per sequence, the payload being
    ``length`` compressed little-endian 16-bit ids."""
    with open(tokenizer, "rb") as f:  # on the driver; tasks get it by broadcast
        ranks = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        coder, pack = encoding(ranks.value), zstandard.ZstdCompressor(level=3).compress
        task, place = TaskContext.get().partitionId(), 0
        ids, owners = [], []  # the open stream, and (position, doc_id) of its documents
        for pdf in batches:
            made = []
            for doc_id, text in zip(pdf["doc_id"].astype("Int64"), pdf["text"]):
                owners.append((len(ids), None if pd.isna(doc_id) else int(doc_id)))
                ids.extend(coder.encode_ordinary(text or ""))
                ids.append(SEPARATOR)
                at = 0
                while len(ids) - at >= length:
                    made.append((task, place, [o for p, o in owners if p < at + length], pack(np.array(ids[at:at + length], "<u2").tobytes())))
                    at, place = at + length, place + 1
                    owners = [(max(p, at), o) for p, o in owners[-1:] if at < len(ids)]
                if at:
                    ids = ids[at:]
                    owners = [(p - at, o) for p, o in owners]
                if len(made) >= 256:
                    yield pd.DataFrame(made, columns=["task", "place", "doc_ids", "payload"])
                    made = []
            if made:
                yield pd.DataFrame(made, columns=["task", "place", "doc_ids", "payload"])
        if ids:
            ids += [SEPARATOR] * (length - len(ids))
            yield pd.DataFrame([(task, place, [o for _, o in owners], pack(np.array(ids, "<u2").tobytes()))],
                               columns=["task", "place", "doc_ids", "payload"])

    return docs.select("doc_id", "text").mapInPandas(cut, _SEQUENCE)


def assign_slots(seqs: DataFrame, key: str = KEY) -> tuple[DataFrame, int]:
    """(slot, sequence, doc_ids, payload) and the number of sequences. ``seqs``
    must be a written table: its rows are counted here and read later."""
    per_task = seqs.groupBy("task").agg(F.count("*").alias("n"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    # A row per task of the tokenising stage.
    offsets = per_task.select("task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    count = seqs.count()

    @F.pandas_udf("long")
    def slot(numbers: pd.Series) -> pd.Series:
        return pd.Series(permute(numbers.to_numpy(), count, key))

    numbered = seqs.join(F.broadcast(offsets), "task").withColumn("sequence", F.col("first") + F.col("place"))
    return numbered.select(slot("sequence").alias("slot"), "sequence", "doc_ids", "payload"), count


def shards(placed: DataFrame, count: int, length: int = LENGTH, per_shard: int = PER_SHARD) -> DataFrame:
    """Rows of SHARD, one per shard, from (slot, doc_ids, payload) rows."""
    number = max(1, -(-count // per_shard))
    parts = min(number, max(int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")), number // 256))

    def assemble(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        open_shard, first, body, owners = None, 0, [], []

        def closed():
            return pd.DataFrame([(open_shard, first, len(body), 2 * length, owners, b"".join(body))],
                                columns=["shard", "first_slot", "sequences", "stride", "doc_ids", "payload"])
        for pdf in batches:
            for shard, slot, docs, payload in zip(pdf["shard"], pdf["slot"], pdf["doc_ids"], pdf["payload"]):
                if shard != open_shard:
                    if body:
                        yield closed()
                    open_shard, first, body, owners = shard, slot, [], []
                body.append(unpack(payload, max_output_size=2 * length))
                owners.append(docs)
        if body:
            yield closed()

    dealt = placed.withColumn("shard", F.expr(f"slot div {per_shard}")).select("shard", "slot", "doc_ids", "payload")
    return dealt.repartitionByRange(parts, "shard").sortWithinPartitions("slot").mapInPandas(assemble, SHARD)


def materialise(docs: DataFrame, tokenizer: str = TOKENIZER, length: int = LENGTH, per_shard: int = PER_SHARD, key: str = KEY) -> DataFrame:
    placed, count = assign_slots(stash(sequences(docs, tokenizer, length), "token-sequences"), key)
    return shards(placed, count, length, per_shard)


def write_shards(made: DataFrame, folder: str) -> None:
    """One row per shard, in shard order, uncompressed: a record is a fixed
    byte range of its row."""
    made.write.option("compression", "none").parquet(folder)


def read_from(spark: SparkSession, folder: str, slot: int, count: int, per_shard: int = PER_SHARD) -> np.ndarray:
    """Up to ``count`` sequences from ``slot`` on, in slot order (resuming)."""
    stored = spark.read.parquet(folder)
    last = (slot + count - 1) // per_shard
    rows = stored.where(F.col("shard").between(slot // per_shard, last)).orderBy("shard").collect()
    if not rows:
        return np.empty((0, 0), "<u2")
    stride = rows[0]["stride"]
    ids = np.frombuffer(b"".join(r["payload"] for r in rows), "<u2").reshape(-1, stride // 2)
    return ids[slot - rows[0]["first_slot"]:][:count]


def op7_shards(docs: DataFrame) -> DataFrame:
    return materialise(docs)
