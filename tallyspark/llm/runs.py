"""Periodic runs of words, by the branching-tandem test on an enhanced suffix array.

A run is a stretch of words with smallest period q and a length of at least
max(12, 2q) that no neighbouring word extends keeping that period. Its last 2q
words are a square whose halves stop agreeing right behind it, a branching
tandem: with i its start, suffixes i and i+q agree in exactly q words, so both
lie in the LCP interval of depth q and in different children of it. For each
LCP interval the suffixes of all children but the largest therefore look up
ISA[i+q] and ISA[i-q]; one inside the interval is a square. Squares are rotated
leftwards as long as words agree, which gives the run's start; squares of a
multiple of a found run's period that end where it ends are merged into it.

Tasks work on batches of whole documents. Words are numbered per document, so
that suffixes of different documents share nothing and one suffix array serves
a batch; arrays are built by prefix doubling over the suffixes not yet told
apart, LCP values from the kept ranks. A batch needs some 200 bytes a word.

Defined results: words are runs of anything but space, tab, line feed, vertical
tab, form feed, carriage return and are compared as they are, case included; a
null, empty or blank text has no words, no runs and an empty collapsed text;
every row is a document of its own, whatever its id, and extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .textcodes import chunks

#: Least length of a run, in words.
MIN_LENGTH = 12

RUNS = "doc_id long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def suffix_array(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """SA, ISA and the ranks by the first 1, 2, 4, ... codes (each with one
    more entry, -1, for the end)."""
    n = len(codes)
    sa = np.argsort(codes, kind="stable")
    head = np.flatnonzero(np.diff(codes[sa], prepend=codes[sa[0]] - 1))
    rank = np.empty(n + 1, np.int64)
    rank[sa] = np.repeat(head, np.diff(head, append=n))
    rank[n] = -1
    levels, width, at = [], 1, np.arange(n)
    while True:
        levels.append(rank.astype(np.int32))
        group = rank[sa[at]]
        size = np.bincount(np.cumsum(np.diff(group, prepend=-1) != 0) - 1)
        at = at[np.repeat(size > 1, size)]
        if not len(at):
            return sa, rank[:n], levels
        suffix = sa[at]
        group, following = rank[suffix], rank[np.minimum(suffix + width, n)]
        order = np.lexsort((following, group))
        suffix, group, following = suffix[order], group[order], following[order]
        sa[at] = suffix
        first = (np.diff(group, prepend=-1) != 0) | (np.diff(following, prepend=-2) != 0)
        rank[suffix] = at[np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))]
        width *= 2


def lcp_values(sa: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Words that each suffix of ``sa`` shares with the one before it."""
    n = len(sa)
    out = np.zeros(n, np.int64)
    at = np.flatnonzero(levels[0][sa[1:]] == levels[0][sa[:-1]]) + 1
    a, b, shared = sa[at - 1].copy(), sa[at].copy(), np.zeros(len(at), np.int64)
    for level in range(len(levels) - 1, -1, -1):
        rank = levels[level]
        ra = rank[np.minimum(a, n)]
        step = ((ra == rank[np.minimum(b, n)]) & (ra >= 0)).astype(np.int64) << level
        a, b, shared = a + step, b + step, shared + step
    out[at] = shared
    return out


def smaller_children(lcp: np.ndarray) -> np.ndarray:
    """Rows (from, to, depth, lb, rb): for each LCP interval lb..rb of that
    depth, the ranges of its children but the largest. A stack of open
    intervals holds only their depth and where their children begin."""
    bounds = np.flatnonzero(lcp)
    if not len(bounds):
        return np.empty((0, 5), np.int64)
    # A boundary of depth 0 closes everything: only stretches of shared words matter.
    first = np.flatnonzero(np.diff(bounds, prepend=-1) != 1)
    low, size = bounds[first] - 1, np.diff(first, append=len(bounds))
    depth = lcp[bounds]
    flat = np.minimum.reduceat(depth, first) == np.maximum.reduceat(depth, first)
    # A stretch of one depth is one interval whose children are single suffixes.
    single = np.flatnonzero(np.repeat(flat, size))
    begin, end = np.repeat(low, size)[single], np.repeat(low + size + 1, size)[single]
    plain = np.stack([bounds[single] - 1, bounds[single], depth[single], begin, end], axis=1)
    found: list[tuple] = []
    for low, end in zip(low[~flat].tolist(), (low + size + 1)[~flat].tolist()):
        values = lcp[low + 1:end].tolist()
        values.append(0)
        stack: list[tuple[int, list[int]]] = []
        for k, depth in enumerate(values, low + 1):
            begin = k - 1
            while stack and stack[-1][0] > depth:
                closed, starts = stack.pop()
                begin = starts[0]
                if len(starts) == 2:
                    cut = starts[1]
                    found.append((begin, cut, closed, begin, k) if cut - begin <= k - cut else (cut, k, closed, begin, k))
                else:
                    ends = starts[1:] + [k]
                    largest = max(range(len(starts)), key=lambda c: ends[c] - starts[c])
                    found.extend((s, e, closed, begin, k) for c, (s, e) in enumerate(zip(starts, ends)) if c != largest)
            if not depth:
                continue
            if stack and stack[-1][0] == depth:
                stack[-1][1].append(k)
            else:
                stack.append((depth, [begin, k]))
    return np.concatenate([plain, np.array(found, np.int64).reshape(-1, 5)])


def branching_tandems(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, q) of every square of two equal q-word halves that does not go
    on by one more equal word."""
    sa, isa, levels = suffix_array(codes)
    ranges = smaller_children(lcp_values(sa, levels))
    del levels
    n, starts, halves = len(codes), [], []
    padded = np.append(codes, -1)
    size = ranges[:, 1] - ranges[:, 0]
    # Blocks of ranges, so that the looked-up suffixes (n log n at most) need bounded memory.
    for block in np.split(np.arange(len(size)), np.flatnonzero(np.diff(np.cumsum(size) // (1 << 20))) + 1):
        own = ranges[block]
        reps = size[block]
        depth, lb, rb = (np.repeat(own[:, c], reps) for c in (2, 3, 4))
        place = np.arange(reps.sum()) - np.repeat(np.cumsum(reps) - reps, reps) + np.repeat(own[:, 0], reps)
        i = sa[place]
        for left in (i, i - depth):
            right = left + depth
            able = (left >= 0) & (right < n)
            other = np.where(left < i, left, right)
            met = isa[np.clip(other, 0, n - 1)]
            able &= (met >= lb) & (met < rb)
            able &= padded[np.minimum(right, n)] != padded[np.minimum(right + depth, n)]
            starts.append(left[able])
            halves.append(depth[able])
    pairs = np.unique(np.stack([np.concatenate(starts), np.concatenate(halves)], axis=1), axis=0)
    return pairs[:, 0], pairs[:, 1]


def _agreeing(codes: np.ndarray, start: int, q: int, low: int) -> int:
    """First position from which the words up to ``start`` equal those q later."""
    step = 32
    while start > low:
        begin = max(low, start - step)
        differ = np.flatnonzero(codes[begin:start] != codes[begin + q:start + q])
        if len(differ):
            return begin + int(differ[-1]) + 1
        start, step = begin, step * 2
    return low


def find_runs(codes: np.ndarray, doc: np.ndarray, first: np.ndarray, min_length: int = MIN_LENGTH) -> np.ndarray:
    """Rows (document, start, length, period), starts within the document.

    ``codes``: words of documents one after the other, numbered apart per
    document; ``doc``: each word's document; ``first``: where documents begin."""
    if not len(codes):
        return np.empty((0, 4), np.int64)
    start, q = branching_tandems(codes)
    # Squares shorter than a run must rotate some words to the left: most do not.
    short = min_length - 2 * q
    keep = np.ones(len(start), bool)
    for t in range(1, min_length - 1):
        check = np.flatnonzero(keep & (short >= t))
        at = start[check] - t
        keep[check] = (at >= 0) & (codes[np.maximum(at, 0)] == codes[at + q[check]])
    start, q = start[keep], q[keep]
    order = np.lexsort((q, start + 2 * q))
    out, end_of, runs_here = [], -1, []
    for i, period in zip(start[order].tolist(), q[order].tolist()):
        end = i + 2 * period
        if end != end_of:
            end_of, runs_here = end, []
        if any(period % p == 0 and i >= s for s, p in runs_here):
            continue  # a square of a found run's rotation, repeated
        own = int(doc[i])
        s = _agreeing(codes, i, period, int(first[own]))
        runs_here.append((s, period))
        if end - s >= min_length:
            out.append((own, s - int(first[own]), end - s, period))
    return np.array(sorted(out), np.int64).reshape(-1, 4)


def _numbered(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    codes: list[int] = []
    first, size, base = [], [], 0
    for words in documents:
        first.append(len(codes))
        size.append(len(words))
        own: dict[bytes, int] = {}
        codes.extend([own.setdefault(w, base + len(own)) for w in words])
        base += len(own)
    return np.array(codes, np.int64), np.repeat(np.arange(len(documents)), size), np.array(first, np.int64)


def periodic_runs(docs: DataFrame, min_length: int = MIN_LENGTH,
                  rewrite: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs``: the runs by start
    and period, and the text with one space between words and without the
    words that repeat a run's first period. ``rewrite`` may change a
    document's words before the search."""
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for block in chunks(pdf):
                ids = [None if pd.isna(i) else int(i) for i in block["doc_id"]]
                # Without an argument, bytes split at exactly the six characters named above.
                words = [(t or "").encode("utf-8", "surrogatepass").split() for t in block["text"]]
                if rewrite:
                    words = [rewrite(i, w) for i, w in zip(ids, words)]
                found = find_runs(*_numbered(words), min_length)
                runs: list[list[tuple]] = [[] for _ in words]
                for own, start, length, period in found.tolist():
                    runs[own].append((start, length, period))
                texts = []
                for own, all_words in zip(runs, words):
                    if own:
                        drop = np.zeros(len(all_words), bool)
                        for start, length, period in own:
                            drop[start + period:start + length] = True
                        all_words = [w for w, gone in zip(all_words, drop.tolist()) if not gone]
                    texts.append(b" ".join(all_words).decode("utf-8", "surrogatepass"))
                yield pd.DataFrame({"doc_id": pd.Series(ids, dtype="Int64"), "collapsed": texts, "runs": [
                    [{"start": s, "length": n, "period": p} for s, n, p in sorted(own, key=lambda r: (r[0], r[2]))] for own in runs]})
    return docs.select("doc_id", "text").mapInPandas(work, RUNS)


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic tail in a tenth of the documents, chosen by
    the id's CRC-32 (none without an id)."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def op12_runs(documents: DataFrame) -> DataFrame:
    found = periodic_runs(documents, rewrite=periodic_tail)
    best = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("back"), (-r["period"]).alias("less"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    out = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.back"), F.col("best.length"), -F.col("best.less")
    return out.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                      F.expr("(1000 * best.length) div (-best.less)").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")
