"""N-gram Jaccard join by token-combination prefixes.

A text is its set of distinct word shingles (64-bit codes). Texts with the same
set are one *node*. Two nodes link when |x & y| * 100 >= percent * |x | y|.
With a = ceil(percent / 100 * |x|), linked nodes share at least a tokens, so in
any global order of tokens the first |x| - a + k tokens of each hold the first
k shared ones.

1. Survivors: in the order of the codes, a node needs enough tokens that some
   other node's prefix holds too. Copies of passages alone do not get there.
2. Among survivors tokens are counted exactly and ordered rare first. A node
   with fewer than a tokens that others hold too links with nothing.
3. Index: each rare token (held by at most ``RARE`` nodes) of the prefix is a
   signature. For frequent tokens the prefix is extended by c, the tokens are
   dealt into c classes by code, and every pair of tokens of one class is a
   signature: of c + 1 shared frequent tokens two fall into one class. c goes
   with the size band, and a node is indexed for its band and the next.
4. Candidates: first each signature's most central node (fewest tokens of its
   own) with the others. Verified links give components; only signatures whose
   nodes are then still in several components give further pairs, those across
   components. No link is lost: a pair within one component changes nothing.
   A pair is left out where a node has too few tokens that others hold for a
   link of these two sizes.
5. Components by alternating large and small stars.

Nothing is quadratic in the copies of a text or in a near-copy group round one
base. Defined results: null and wordless texts are empty sets that link with
nothing; repeated rows fall into one node; a null id is never a component's
name unless it is alone (then null); an empty table gives no rows; extra
columns are ignored. Codes of two different shingles or sets collide with
probability 2**-64.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash, unstash
from .textcodes import chunks, mix, shingle_sets

#: Tokens held by more nodes than this are indexed as combinations.
RARE = 32
#: Prefix tokens that one class of frequent tokens holds, about.
CLASS_TOKENS = 6
#: Tokens a survivor needs beyond the plain prefix, as a share of its size.
EXTENSION = 0.1
#: Tokens of one bucket of the survivors' count.
BUCKET_TOKENS = 400_000


def _node(tokens: np.ndarray) -> int:
    """Code of a set; 0 for the empty one."""
    if not len(tokens):
        return 0
    with np.errstate(over="ignore"):
        both = np.array([tokens.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(tokens)) + np.uint64(len(tokens))], dtype=np.uint64)
        return int(mix(mix(both[:1]) + both[1:]).view(np.int64)[0]) or 1


def _least_shared(n, percent: int):
    return -(-n * percent // 100)


def _extension(n: int) -> int:
    return max(1, int(n * EXTENSION))


def document_nodes(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, n_shingles, node) of every row."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block in chunks(pdf):
                sets = shingle_sets(block["text"].tolist(), width)
                yield pd.DataFrame({"doc_id": block["doc_id"].astype("Int64"), "n_shingles": [len(s) for s in sets], "node": [_node(s) for s in sets]})
    return docs.select(F.col("doc_id").cast("long"), "text").mapInPandas(run, "doc_id long, n_shingles long, node long")


def survivors(docs: DataFrame, width: int, percent: int, buckets: int) -> DataFrame:
    """Nodes that may link: (node, held) with held at least their need."""
    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block in chunks(pdf):
                sets = [s for s in shingle_sets(block["text"].tolist(), width) if len(s)]
                if sets:
                    yield from deal(sets)

    def deal(sets: list) -> Iterator[pd.DataFrame]:
        prefixes = [s[:len(s) - _least_shared(len(s), percent) + _extension(len(s))] for s in sets]
        token = np.concatenate(prefixes)
        node = np.repeat(np.array([_node(s) for s in sets], np.int64), [len(p) for p in prefixes])
        order = np.lexsort((node, token))
        token, node = token[order], node[order]
        new = np.ones(len(token), bool)
        new[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node = token[new], node[new]
        first = np.flatnonzero(np.diff(token, prepend=token[0] ^ np.uint64(1)) != 0)
        size = np.diff(first, append=len(token))
        many = np.repeat(size > 1, size)
        # Held by several nodes of this block: counted here, and one row tells the bucket that the token is shared.
        held, count = np.unique(node[many], return_counts=True)
        yield pd.DataFrame({"bucket": -1, "tokens": [held.tobytes()], "nodes": [count.astype(np.int64).tobytes()]})
        known = token[first[size > 1]]
        token, node = np.concatenate([token[~many], known]), np.concatenate([node[~many], np.zeros(len(known), np.int64)])
        bucket = (token >> np.uint64(11)) % np.uint64(buckets)
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order], prepend=bucket[order[0]] ^ np.uint64(1)) != 0) if len(order) else []
        for a, b in zip(cuts, [*cuts[1:], len(order)]):
            part = order[a:b]
            yield pd.DataFrame({"bucket": int(bucket[part[0]]), "tokens": [token[part].tobytes()], "nodes": [node[part].tobytes()]})

    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        a = np.concatenate([np.frombuffer(b, np.uint64) for b in pdf["tokens"]])
        b = np.concatenate([np.frombuffer(x, np.int64) for x in pdf["nodes"]])
        order = np.lexsort((b, a))
        a, b = a[order], b[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        a, b = a[new], b[new]
        first = np.flatnonzero(np.diff(a, prepend=a[0] ^ np.uint64(1)) != 0)
        size = np.diff(first, append=len(a))
        # Node 0 stands for "several": a token it holds is shared.
        several = np.minimum.reduceat(np.where(b == 0, 0, 1), first) == 0
        shared = np.repeat((size > 1) | several, size) & (b != 0)
        held, n = np.unique(b[shared], return_counts=True)
        return pd.DataFrame({"node": held, "held": n})

    def unpack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for nodes, counts in zip(pdf["tokens"], pdf["nodes"]):
                yield pd.DataFrame({"node": np.frombuffer(nodes, np.int64), "held": np.frombuffer(counts, np.int64)})

    dealt = stash(docs.select("text").mapInPandas(emit, "bucket int, tokens binary, nodes binary"), "jaccard-prefixes")
    met = dealt.where("bucket >= 0").groupBy("bucket").applyInPandas(count, "node long, held long")
    own = dealt.where("bucket < 0").mapInPandas(unpack, "node long, held long")
    able = stash(met.unionByName(own).groupBy("node").agg(F.sum("held").alias("held")), "jaccard-able")
    unstash(dealt)
    return able


def _bands(n: Column, percent: int) -> Column:
    return F.floor(F.log(n.cast("double")) / F.lit(math.log(100 / percent) * 1.000001)).cast("int")


def _classes(band: Column, percent: int) -> Column:
    """Number of token classes of a size band."""
    largest = F.exp((band + 1) * F.lit(math.log(100 / percent) * 1.000001))
    return F.greatest(F.lit(1), F.ceil(largest * (100 - percent) / 100 / CLASS_TOKENS)).cast("int")


def signatures(held: DataFrame, percent: int) -> DataFrame:
    """(sig, node, n, own): the index; own is the number of the node's tokens
    that no partner under this signature shares with it (a partner that shares
    a rarer token is met under that one's signature). ``held``: (node, n, own, shared) with
    shared the sorted structs (df, token) of tokens that others hold too."""
    h = held.withColumn("plain", F.col("n") - F.expr(f"(n * {percent} + 99) div 100") + 1)
    h = h.withColumn("band", _bands(F.col("n"), percent))
    # Tokens of the node alone come first in the order and take up the prefix.
    room = F.greatest(F.col("plain") - F.col("own"), F.lit(0)).cast("int")
    rare = F.filter(F.transform(F.slice("shared", 1, room), lambda t, i: F.struct(
        F.when(t["df"] <= RARE, t["token"]).alias("sig"), (F.col("own") + i).cast("long").alias("own"))), lambda r: r["sig"].isNotNull())
    light = (F.col("own") + F.size(F.filter("shared", lambda t: t["df"] <= RARE))).cast("long")

    def combinations(band: Column) -> Column:
        classes = _classes(band, percent)
        extended = F.greatest(F.col("plain") + classes - F.col("own"), F.lit(0)).cast("int")
        frequent = F.transform(F.filter(F.slice("shared", 1, extended), lambda t: t["df"] > RARE), lambda t: t["token"])
        return F.flatten(F.transform(frequent, lambda a: F.transform(
            F.filter(frequent, lambda b: (b > a) & (F.pmod(F.shiftright(a, 7), classes) == F.pmod(F.shiftright(b, 7), classes))),
            lambda b: F.struct(F.xxhash64(band, a, b).alias("sig"), F.col("light").alias("own")))))

    h = h.withColumn("light", light)
    sigs = F.concat(rare, combinations(F.col("band")), combinations(F.col("band") + 1))
    return h.select("node", "n", F.explode_outer(sigs).alias("s")).where("s is not null").select("s.sig", "node", "n", "s.own")


def _enough(n: Column, own: Column, other: Column, percent: int) -> Column:
    """Whether a node's tokens that others hold suffice for a link with a node
    of size ``other``: the shared ones must be percent / (100 + percent) of
    both sizes."""
    return (n - own) * (100 + percent) >= (n + other) * percent


def _verified(pairs: DataFrame, held: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link."""
    side = held.select("node", "n", F.transform("shared", lambda t: t["token"]).alias("tokens"))
    left = side.select(F.col("node").alias("a"), F.col("n").alias("an"), F.col("tokens").alias("at"))
    right = side.select(F.col("node").alias("b"), F.col("n").alias("bn"), F.col("tokens").alias("bt"))
    both = pairs.join(left, "a").join(right, "b")
    sized = both.where((F.col("an") * 100 >= F.col("bn") * percent) & (F.col("bn") * 100 >= F.col("an") * percent))
    inter = F.size(F.array_intersect("at", "bt"))
    return sized.where(inter * 100 >= (F.col("an") + F.col("bn") - inter) * percent).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of ``edges`` (a, b): root is the smallest
    node that can be reached."""
    now = stash(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "components")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        met = large.join(least, "u")
        small = met.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        old, now = now, stash(small, "components")
        unstash(old)
        seen = now.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if seen == mark:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        mark = seen


def links(docs: DataFrame, reps: DataFrame, width: int, percent: int, shingles: int) -> DataFrame:
    """Verified links (a, b) between nodes, enough to connect all that link.
    ``reps``: (node, doc_id) one document of each node."""
    buckets = max(1, shingles // BUCKET_TOKENS)
    able = survivors(docs, width, percent, buckets)

    def sets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block in chunks(pdf):
                found = shingle_sets(block["text"].tolist(), width)
                keep = [i for i, (s, node) in enumerate(zip(found, block["node"])) if _node(s) == node]
                yield pd.DataFrame({"node": block["node"].iloc[keep].to_numpy(), "n": [len(found[i]) for i in keep],
                                    "tokens": [found[i].view(np.int64) for i in keep]})

    # Need of the smallest partner: its extension is what it surely has in its prefix.
    need = F.greatest(F.lit(1), F.floor(F.expr(f"(n_shingles * {percent} + 99) div 100") * EXTENSION))
    chosen = reps.join(able, "node").where(F.col("held") >= need).select("node", F.col("doc_id").alias("rep"))
    texts = docs.select("doc_id", "text").join(chosen, F.col("doc_id") == F.col("rep")).select("node", "text")
    full = stash(texts.mapInPandas(sets, "node long, n long, tokens array<long>").dropDuplicates(["node"]), "jaccard-sets")

    # Nodes that hold at least as many shared tokens as a link takes; counting once more after the others are gone.
    rows = full.select("node", "n", F.explode("tokens").alias("token"))
    df = rows.groupBy("token").agg(F.count("*").alias("df")).where("df > 1")
    held = rows.join(df, "token").groupBy("node", "n").agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("shared"))
    held = held.withColumn("own", F.col("n") - F.size("shared")).where(F.expr(f"size(shared) * 100 >= n * {percent}"))
    held = stash(held.select("node", "n", "own", "shared"), "jaccard-held")
    unstash(full)

    # Rows of a signature that suffice for no node of it, not even its smallest, go before pairs are made.
    index = signatures(held, percent)
    least = index.groupBy("sig").agg(F.min("n").alias("least_n"), F.count("*").alias("size")).where("size > 1").select("sig", "least_n")
    index = index.join(least, "sig").where(_enough(F.col("n"), F.col("own"), F.col("least_n"), percent))
    index = stash(index.select("sig", "node", "n", "own"), "jaccard-index")
    centre = index.groupBy("sig").agg(F.min(F.struct("own", "node", "n")).alias("c"), F.count("*").alias("size")).where("size > 1")
    centre = centre.select("sig", F.col("c.node").alias("a"), F.col("c.n").alias("a_n"), F.col("c.own").alias("a_own"))
    both = (F.col("node") != F.col("a")) & _enough(F.col("n"), F.col("own"), F.col("a_n"), percent) & _enough(F.col("a_n"), F.col("a_own"), F.col("n"), percent)
    stars = index.join(centre, "sig").where(both).select(F.least("a", "node").alias("a"), F.greatest("a", "node").alias("b")).distinct()
    first = stash(_verified(stars, held, percent), "jaccard-links")
    roots = components(first)

    placed = index.join(roots, "node", "left").select("sig", "node", "n", "own", F.coalesce("root", "node").alias("root"))
    # Of two nodes of different components at least one lies outside the signature's largest component. These few
    # travel as one list per signature; each node gathers its lists, so that a pair that meets under many signatures
    # is made once and the rows of the join are those of the index: one count finds the signatures still in several
    # components and the largest of these, so each row meets its signature's one row once.
    top = placed.groupBy("sig", "root").count().groupBy("sig").agg(F.max(F.struct("count", "root"))["root"].alias("top"), F.count("*").alias("roots"))
    top = top.where("roots > 1").select("sig", "top")
    open_ = stash(placed.join(top, "sig").withColumn("outside", F.col("root") != F.col("top")), "jaccard-open")
    lists = open_.where("outside").groupBy("sig").agg(F.collect_list(F.struct("node", "n", "own", "root")).alias("others"))
    partners = F.transform(F.filter("others", lambda o: (o["root"] != F.col("root")) & (~F.col("outside") | (o["node"] < F.col("node")))
                                    & _enough(F.col("n"), F.col("own"), o["n"], percent) & _enough(o["n"], o["own"], F.col("n"), percent)), lambda o: o["node"])
    met = open_.join(lists, "sig").select("node", partners.alias("partners")).where(F.size("partners") > 0)
    met = met.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("partners"))).alias("partners"))
    across = met.select("node", F.explode("partners").alias("partner")).select(F.least("node", "partner").alias("a"), F.greatest("node", "partner").alias("b")).distinct()
    across = across.join(stars, ["a", "b"], "left_anti")
    more = stash(_verified(across, held, percent), "jaccard-links")
    unstash(index)
    unstash(held)
    return first.unionByName(more)


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, node, component_id) of every row."""
    named = stash(document_nodes(docs, width), "jaccard-nodes")
    reps = named.where("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n_shingles"))
    total = named.agg(F.sum("n_shingles")).first()[0] or 0
    roots = components(links(docs, reps, width, percent, total))
    grouped = reps.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = grouped.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    of_node = grouped.join(names, "root").select(F.col("node").alias("of"), F.col("component_id").alias("found_id"))
    out = named.join(of_node, (F.col("node") == F.col("of")) & (F.col("n_shingles") > 0), "left")
    return out.select("doc_id", "n_shingles", "node", F.coalesce("found_id", "doc_id").alias("component_id"))


def deduplicate(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each component, that with the smallest
    id (of rows that repeat id and text one), and all wordless or id-less ones."""
    found = near_duplicates(docs, width, percent)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id")).distinct()
    kept = docs.join(gone, F.col("doc_id") == F.col("gone_id"), "left_anti")
    # Rows repeated under one id are rare: only these go through a shuffle by text.
    again = found.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("rows")).where("rows > 1")
    if not again.take(1):
        return kept
    again = again.select(F.col("doc_id").alias("again_id"))
    same = F.col("doc_id") == F.col("again_id")
    return kept.join(again, same, "left_anti").unionByName(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def op6_jaccard(docs: DataFrame) -> DataFrame:
    return near_duplicates(docs, 3, 90).select("doc_id", "n_shingles", "component_id")
