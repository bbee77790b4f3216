"""The corpus pipeline: raw documents to training shards.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and reread as the next
one's ``docs``. All but the last return the columns of ``documents``.

1. toxicity: rejects documents that score one half or more.
2. near_duplicates: keeps one document of each component (word 5-shingles,
   Jaccard similarity 0.8 or more).
3. decontamination: drops documents that hold benchmark items, reworded slots
   included.
4. mixing: repeats or cuts sources to their target weights.
5. token_shards: token ids in training order, one row per shard.

The stages call the operators of ``tallyspark.llm``; null and empty texts pass
all filters (they hold nothing to reject), and an empty table gives an empty
result.
"""

from __future__ import annotations

from tallyspark.llm import decontaminate, jaccard, mixing, token_shards, toxicity
from tallyspark.llm.common import read, stash


def drop_toxic(spark, docs, sf_dir):
    judged = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return judged.where("toxicity < 0.5").select(*docs.columns)


def drop_near_duplicates(spark, docs, sf_dir):
    return jaccard.deduplicate(docs)


def drop_contaminated(spark, docs, sf_dir):
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark, docs, sf_dir):
    return mixing.materialise(docs, mixing.mix(docs))


def write_shards(spark, docs, sf_dir):
    return token_shards.materialise(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_shards", write_shards),
]

#: The grammar, the components and the tokenizer have no SQL form; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
