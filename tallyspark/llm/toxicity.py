"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer maps words to classes and weights (insult, threat, target,
negation, report, intensifier) and punctuation to commas and clause ends. The
class string is read by two transducers, each composed from machines of states
and weighted arcs; what one machine writes, the next reads.

From right to left:

* target: an insult or threat with a target within reach behind it is aimed,
* report: what stands before ", he said" or before the closing quotation mark
  of such a tag is quoted, back to the clause's start.

From left to right:

* negation: an insult or threat within reach after a negation counts little,
* report: after a reporting verb, up to the clause end, matches are quoted,
* intensifier: one just before a match raises it,
* target: a match within reach after a target is aimed,
* clause: aimed insults count more, threats in full only if aimed, quoted
  matches less.

A match weighs its word's weight times the weights of the arcs it took; a
text's evidence is the sum over its matches, squashed to a score in (0, 1).

Insults are learned: words and word beginnings that labelled toxic texts hold
significantly more often than others (likelihood ratio), from at most
``SAMPLE`` labelled texts, the first by a hash of their id; every significant
one is kept. The curve from evidence to score is fitted on the same texts. The
remaining classes are small fixed word lists. Scores use the text alone.

Defined results: null and empty texts have no evidence and the lowest score;
every row gets a score, repeated rows the same one; without labels of both
kinds only the fixed lists count; a label of a null id is not used; extra
columns are ignored.
"""

from __future__ import annotations

import math
import re
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

#: Most labelled texts the lexicon is learned from.
SAMPLE = 20_000
STEMS = (4, 5, 6, 7)
#: Least ratio of an entry's rate among toxic texts to that among others.
LIFT = 30
#: Words in which a negation or a target, an intensifier, and a reporting verb behind a comma bear on others.
REACH, NEAR, TAG = 4, 2, 3
NEGATED, REPORTED, INTENSE, TARGETED = 0.1, 0.4, 1.3, 1.5
#: Score = logistic(a + b * log(1 + evidence)); these hold where there are no labels to fit them.
DEFAULT_CURVE = (-2.5, 2.5)

# Small closed word classes.
THREATS = "kill hurt destroy attack murder beat crush töten umbringen schlagen tuer frapper détruire matar golpear destruir".split()
TARGETS = ("you your yours he him she her they them people "
           "du dich dir ihr sie er ihn tu toi vous il elle ils elles te tú usted ustedes él ella ellos ellas").split()
NEGATIONS = "not no never neither nor without don't isn't aren't nicht kein keine nie weder pas jamais aucun ni sin nunca jamás".split()
REPORTS = ("said says say told reported reportedly quoted claimed claims wrote called "
           "sagte sagt berichtete behauptete dit disait déclaré dijo dice afirmó según").split()
INTENSIFIERS = "very so such really utterly total complete sehr so total très si vraiment muy tan".split()
SEED_INSULTS = "idiot moron scum".split()

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, INTENSIFIER, COMMA, QUOTE_END, END = range(10)
#: Marks that the machines add to an insult or a threat.
AIMED, QUOTED = 16, 32
MATCHES = [kind | mark for kind in (INSULT, THREAT) for mark in (0, AIMED, QUOTED, AIMED | QUOTED)]
ALPHABET = sorted({*range(10), *MATCHES})
#: A threat that nobody is the target of.
AIMLESS = 0.25
_EDGE = "\"'()[]{}<>«»“”‘’¡¿*_~`-.,;:!?…"
_CLAUSE_END = re.compile(r"[.!?;:\n]")
_QUOTE_END = re.compile(r"[.!?,]['\"”’»]$")


def labelled_sample(labels: DataFrame, usable: Column, size: int = SAMPLE) -> DataFrame:
    """At most ``size`` (doc_id, toxic) rows among the usable labels."""
    rows = labels.where(usable & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    rows = rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(size)


def _features(text: str) -> set:
    words = {w.strip(_EDGE) for w in text.lower().split()}
    words.discard("")
    return words | {w[:n] + "*" for w in words for n in STEMS if len(w) > n}


def _feature_counts(batches):
    for pdf in batches:
        seen: dict = {}
        for text, toxic in zip(pdf["text"], pdf["toxic"]):
            for f in _features(text or ""):
                pair = seen.setdefault(f, [0, 0])
                pair[toxic] += 1
        yield pd.DataFrame([(f, a, b) for f, (a, b) in seen.items()], columns=["feature", "clean", "toxic"])


def _ratio(a: Column, b: Column, n1: int, n0: int) -> Column:
    """Likelihood ratio (G2) of a of n1 against b of n0."""
    pooled = (a + b) / F.lit(n1 + n0)

    def part(k: Column, expected: Column) -> Column:
        return F.when(k > 0, k * F.log(k / expected)).otherwise(0.0)
    return 2 * (part(a, n1 * pooled) + part(n1 - a, n1 * (1 - pooled)) + part(b, n0 * pooled) + part(n0 - b, n0 * (1 - pooled)))


def _labelled_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    picked = F.broadcast(sample.withColumnRenamed("doc_id", "label_id"))  # at most SAMPLE rows
    return docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("label_id")).select("doc_id", "text", "toxic")


def _without_copies(texts: DataFrame) -> DataFrame:
    """One text of those that share a minimum hash of their word triples, for
    three hashes in turn: a text copied many times would pass off its chance
    words as evidence."""
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[\x20\x09-\x0D]+"), lambda w: w != "")
    texts = texts.withColumn("words", words)
    triples = F.when(F.size("words") > 3, F.transform(F.sequence(F.lit(1), F.size("words") - 2), lambda i: F.slice("words", i, 3))).otherwise(F.array("words"))
    texts = texts.withColumn("triples", triples)
    def least_hash(n: int) -> Column:
        return F.array_min(F.transform("triples", lambda t: F.xxhash64(F.lit(n), t))).alias(f"h{n}")

    texts = texts.select("doc_id", "text", "toxic", *map(least_hash, range(3)))
    rest = ["text", "toxic", "h0", "h1", "h2"]
    for n in range(3):
        first = F.min_by(F.struct("doc_id", *rest), F.struct("toxic", "doc_id")).alias("row")
        texts = texts.groupBy(F.col(f"h{n}").alias("key")).agg(first).select("row.*")
    return texts.select("text", "toxic")


def learn_lexicon(texts: DataFrame) -> dict:
    """{word or 'beginning*': weight} of insults from (text, toxic) rows: every
    entry that passes the tests and no more general entry covers."""
    totals = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = totals.get(0, 0), totals.get(1, 0)
    if not n0 or not n1:
        return {}
    counts = texts.mapInPandas(_feature_counts, "feature string, clean long, toxic long").groupBy("feature").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # Rate among toxic texts at least LIFT times that among clean ones (a half count is added).
    lift = (F.col("toxic") / F.lit(n1)) / ((F.col("clean") + 0.5) / F.lit(n0))
    tested = stash(counts.where((F.col("toxic") >= 4) & (lift >= LIFT)), "toxicity-entries")
    need = 2 * math.log(200 * (1 + tested.count()))
    rows = tested.where(_ratio(F.col("toxic"), F.col("clean"), n1, n0) >= need).collect()  # of a bounded sample
    entries: dict = {}
    # Purest first; among equals the more general.
    purity = lambda r: r["toxic"] / (r["clean"] + 0.5)
    for r in sorted(rows, key=lambda r: (-min(purity(r), 20.0), len(r["feature"].rstrip("*")), r["feature"])):
        f, a, b = r["feature"], r["toxic"], r["clean"]
        if not any(f[:n] + "*" in entries for n in STEMS if n < len(f.rstrip("*")) or f == f[:n] + "*"):
            entries[f] = round(min(4.0, math.log(((a + 0.5) / (n1 + 1)) / ((b + 0.5) / (n0 + 1)))), 6)
    return entries


def lexicon_transducer(insults: dict) -> dict:
    """Word (or beginning with '*') to (class, weight)."""
    out = {}
    for words, kind, weight in ((INTENSIFIERS, INTENSIFIER, INTENSE), (REPORTS, REPORT, REPORTED), (NEGATIONS, NEGATION, NEGATED),
                                (TARGETS, TARGET, TARGETED), (THREATS, THREAT, 2.0), (SEED_INSULTS, INSULT, 2.0)):
        out.update({w: (kind, weight) for w in words})
    out.update({w: (INSULT, weight) for w, weight in insults.items()})
    return out


class Transducer:
    """Deterministic and weighted: ``arcs`` maps (state, symbol read) to
    (symbol written, weight, next state). It starts in state 0; a symbol
    without an arc passes unchanged and the state stays."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def step(self, state: int, symbol: int) -> tuple:
        return self.arcs.get((state, symbol)) or (symbol, 1.0, state)

    def run(self, symbols) -> list:
        """(symbol written, weight) of each symbol read."""
        out, state = [], 0
        for symbol in symbols:
            written, weight, state = self.step(state, symbol)
            out.append((written, weight))
        return out


def compose(first: Transducer, second: Transducer) -> Transducer:
    """What ``first`` writes, ``second`` reads; states are the reachable pairs."""
    numbers, arcs, todo = {(0, 0): 0}, {}, [(0, 0)]
    while todo:
        pair = todo.pop()
        for symbol in ALPHABET:
            between, weight, to_first = first.step(pair[0], symbol)
            written, factor, to_second = second.step(pair[1], between)
            to = (to_first, to_second)
            if to not in numbers:
                numbers[to] = len(numbers)
                todo.append(to)
            arcs[numbers[pair], symbol] = (written, weight * factor, numbers[to])
    return Transducer(arcs)


def within(opener: int, words: int, mark: int = 0, weight: float = 1.0, once: bool = False) -> Transducer:
    """Matches among the ``words`` words after ``opener`` get the mark and the
    weight, with ``once`` the first only. A state is the number of words left."""
    arcs = {}
    for left in range(words + 1):
        for symbol in ALPHABET:
            after = max(0, left - 1)
            if symbol in (QUOTE_END, END):
                arcs[left, symbol] = (symbol, 1.0, 0)
            elif symbol == COMMA:
                arcs[left, symbol] = (symbol, 1.0, left)
            elif symbol == opener:
                arcs[left, symbol] = (symbol, 1.0, words)
            elif symbol in MATCHES:
                arcs[left, symbol] = (symbol | mark, weight, 0 if once else after) if left else (symbol, 1.0, 0)
            else:
                arcs[left, symbol] = (symbol, 1.0, after)
    return Transducer(arcs)


def report_before() -> Transducer:
    """Matches after a reporting verb are quoted up to the clause end."""
    arcs = {(0, REPORT): (REPORT, 1.0, 1), (1, END): (END, 1.0, 0), (1, QUOTE_END): (QUOTE_END, 1.0, 0)}
    return Transducer(arcs | {(1, s): (s | QUOTED, 1.0, 1) for s in MATCHES})


def report_behind() -> Transducer:
    """Read from the right: a reporting verb at most TAG words behind a comma or
    a closing quotation mark makes the clause before it quoted. States 1 to TAG
    are the words left to the comma, TAG + 1 is inside the quoted clause."""
    inside = TAG + 1
    arcs = {(state, REPORT): (REPORT, 1.0, TAG) for state in range(inside)}
    for left in range(1, inside):
        arcs |= {(left, s): (s, 1.0, left - 1) for s in (OTHER, TARGET, NEGATION, INTENSIFIER)}
        arcs |= {(left, s): (s, 1.0, 0) for s in (END, *MATCHES)}
        arcs |= {(left, s): (s, 1.0, inside) for s in (COMMA, QUOTE_END)}
    arcs |= {(inside, s): (s, 1.0, 0) for s in (END, QUOTE_END)}
    return Transducer(arcs | {(inside, s): (s | QUOTED, 1.0, inside) for s in MATCHES})


def clause() -> Transducer:
    """The weight of a match by its marks."""
    arcs = {}
    for s in MATCHES:
        kind, aimed = (THREAT if s & 15 == THREAT else INSULT), bool(s & AIMED)
        weight = (TARGETED if aimed else 1.0) if kind == INSULT else (1.0 if aimed else AIMLESS)
        arcs[0, s] = (kind, weight * (REPORTED if s & QUOTED else 1.0), 0)
    return Transducer(arcs)


def grammar() -> tuple:
    """The composed transducers: from right to left, from left to right."""
    return (compose(within(TARGET, REACH, AIMED, once=True), report_behind()),
            reduce(compose, (within(NEGATION, REACH, weight=NEGATED), report_before(), within(INTENSIFIER, NEAR, weight=INTENSE),
                             within(TARGET, REACH, AIMED), clause())))


def _boundary(words: list) -> int:
    """What closes between the first of ``words`` and the word behind them."""
    found = OTHER
    for w in words:
        if _QUOTE_END.search(w):
            found = max(found, QUOTE_END)
        elif _CLAUSE_END.search(w):
            return END
        elif w[-1] == ",":
            found = max(found, COMMA)
    return found


def class_string(text: str, lexicon: dict, heads: set, stems: tuple) -> list:
    """(class, weight) of the words that matter, the commas and clause ends
    between them, and as many other words as any machine counts."""
    raw = text.split()
    hits = [i for i, w in enumerate(raw) if w[:3] in heads or w[:3].lower() in heads or not w[0].isalnum()]
    events, weighty = [], False
    for i in hits:
        word = raw[i].lower().strip(_EDGE)
        entry = lexicon.get(word)
        if entry is None:
            for n in stems:
                if len(word) > n and (entry := lexicon.get(word[:n] + "*")):
                    break
        if entry:
            events.append((i, entry))
            weighty |= entry[0] in (INSULT, THREAT)
    if not weighty:
        return []
    out, last = [], 0
    for i, entry in events:
        boundary = END if i - last > 24 else _boundary(raw[last:i])
        if boundary:
            out.append((boundary, 1.0))
        out += [(OTHER, 1.0)] * min(i - last - 1, REACH)
        out.append(entry)
        last = i
    return out


def evidence(text: str | None, lexicon: dict, heads: set, stems: tuple, leftward: Transducer, rightward: Transducer) -> tuple:
    """(evidence, matches) of a text."""
    read = class_string(text or "", lexicon, heads, stems)
    marked = leftward.run(kind for kind, _ in reversed(read))
    weighed = rightward.run(symbol for symbol, _ in reversed(marked))
    found = [entry[1] * left[1] * right[1] for entry, left, right in zip(read, reversed(marked), weighed)
             if entry[0] in (INSULT, THREAT)]
    return sum(found), len(found)


def _heads(word: str) -> set:
    """First three characters a word may have in a text; shorter words may
    have punctuation behind them."""
    heads = {word[:3]}
    for _ in range(3 - len(word)):
        heads |= {h + e for h in heads if len(h) < 3 for e in _EDGE}
    return heads


def _machine_parts(insults: dict) -> tuple:
    lexicon = lexicon_transducer(insults)
    return (lexicon, set().union(*(_heads(w.rstrip("*")) for w in lexicon)),
            tuple(sorted({len(w) - 1 for w in lexicon if w.endswith("*")})), *grammar())


def fit_curve(found: list) -> tuple:
    """(a, b) of the logistic curve over log(1 + evidence), by Newton steps
    with a slight pull to the default. ``found``: (evidence, toxic, texts)."""
    if len({t for _, t, _ in found}) < 2:
        return DEFAULT_CURVE
    x = np.array([(1.0, math.log1p(e)) for e, _, _ in found])
    y, n = (np.array([float(row[i]) for row in found]) for i in (1, 2))
    start = np.array(DEFAULT_CURVE)
    w = start.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + np.eye(2), x.T @ (n * (y - p)) - (w - start))
        w = w + np.clip(step, -1, 1)
    return float(w[0]), max(float(w[1]), 0.1)


def learn(docs: DataFrame, sample: DataFrame) -> dict:
    """The model: insults (lexicon) and curve."""
    texts = stash(_without_copies(_labelled_texts(docs, stash(sample, "toxicity-labels"))), "toxicity-texts")
    insults = learn_lexicon(texts)
    parts = _machine_parts(insults)

    def weigh(batches):
        for pdf in batches:
            yield pd.DataFrame({"evidence": [round(evidence(t, *parts)[0], 1) for t in pdf["text"]], "toxic": pdf["toxic"]})

    rows = texts.mapInPandas(weigh, "evidence double, toxic int")
    rows = rows.groupBy(F.least("evidence", F.lit(100.0)).alias("evidence"), "toxic").agg(F.count("*").alias("n")).collect()
    return {"insults": insults, "curve": fit_curve(sorted((r["evidence"], r["toxic"], r["n"]) for r in rows))}


def score(docs: DataFrame, model: dict) -> DataFrame:
    """``docs`` with the columns toxicity (0 to 1) and clauses (matched)."""
    box = docs.sparkSession.sparkContext.broadcast((_machine_parts(model["insults"]), model["curve"]))

    @F.pandas_udf("struct<toxicity: double, clauses: int>")
    def judge(texts: pd.Series) -> pd.DataFrame:
        parts, (a, b) = box.value
        found = [evidence(t, *parts) for t in texts]
        total = np.array([x[0] for x in found], dtype=float)
        toxicity = 1 / (1 + np.exp(-np.clip(a + b * np.log1p(total), -30, 30)))
        return pd.DataFrame({"toxicity": toxicity, "clauses": [x[1] for x in found]})

    return docs.withColumn("judged_toxicity", judge("text")).select(
        *docs.columns, F.col("judged_toxicity.toxicity").alias("toxicity"), F.col("judged_toxicity.clauses").alias("clauses"))


def held_out(doc_id: Column, parts: int = 5) -> Column:
    return F.crc32(doc_id.cast("string")) % parts == 0


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> dict:
    """The model learned from labels outside the held-out fifth."""
    return learn(docs, labelled_sample(labels, ~F.coalesce(held_out(F.col("doc_id")), F.lit(True)), sample))


def op1_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    judged = score(docs.select("doc_id", "text"), fit(docs, labels))
    return judged.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), F.col("toxicity").alias("score"),
                         (F.col("toxicity") >= 0.5).cast("int").alias("predicted"), "clauses")
