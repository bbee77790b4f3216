"""Benchmark decontamination by template canonicalisation (native).

Words are lower-cased without punctuation; numbers, names and units become
typed placeholders, so a question and its re-parameterised copy give the same
template. Windows of ``WINDOW`` template words (every position of a document,
every ``STRIDE``-th and the last of an item) are joined by hash. Where windows
of an item and a document meet on the same diagonal, the slots' values must be
consistent: one value of the item always stands for one value in the document.
A document is contaminated by an item when the windows of consistent diagonals
cover at least ``COVERAGE`` of the item's, at least two if it has two, or when
one consistent diagonal covers ``RUN_WORDS`` words in a row.

Templates have two readings, and windows meet within one: names are the
capitalised words inside a sentence (0), or all capitalised words (1), so that
a sentence's first word meets its copy behind a colon, a heading or a list
mark, and may be a new name. Consistency is that of one reading. Items shorter than a window are
matched as a whole; items of fewer than ``LEAST_WORDS`` words match nothing.

Defined results: null and empty texts match nothing; repeated documents and
items are each matched; rows of one id (or none) with different texts are
documents of their own, told apart by the text's hash, and so are items;
empty tables give no rows; extra columns are ignored (``clean`` keeps them).
"""

from __future__ import annotations

import functools
import re

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash

WINDOW, STRIDE, COVERAGE, LEAST_WORDS, RUN_WORDS = 6, 3, 0.5, 4, 24
#: Item windows up to which they are broadcast (some 200 bytes each); more are joined by shuffle.
BROADCAST_WINDOWS = 100_000
#: Words beside placeholders that a window needs.
LEAST_PLAIN = 2
#: Bits of the filter over the items' window hashes, at most (8 MB).
MOST_BITS = 1 << 26

_STOP = "\x1f"
# Sentence ends, other punctuation, number words, units.
_SENTENCE_END = ".!?"
_PUNCTUATION = ",;:()[]{}<>\"“”„«»¿¡*_#|~`…%&$€£+="
NUMBER_WORDS = ("zero one two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million "
                "zwei drei vier fünf sechs sieben acht neun zehn hundert tausend deux trois quatre cinq sept huit neuf dix cent mille "
                "dos tres cuatro cinco seis siete ocho nueve diez cien mil").split()
UNITS = ("km m cm mm mile miles meter meters metre metres foot feet inch inches kg g mg gram grams kilogram kilograms pound pounds lb lbs "
         "l ml liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years "
         "dollar dollars euro euros cent cents percent degree degrees mph kmh").split()
NUMBER, NAME, UNIT = "<number>", "<name>", "<unit>"
#: Stands before a capital; a sentence end, so no word has it.
_CAPITAL = "."
#: A word that begins with a capital but is its own lower-case form (such capitals have no small letter).
_SAME_SMALL = r"[N](?:[N]|[^ \p{Lu}\p{Lt}Ⅰ-ⅯⒶ-Ⓩ])*+(?: |\z)".replace("N", r"ϒ-ϔℂℇℋ-ℍℐ-ℒℕℙ-ℝℤℨℬℭℰℱℳℾℿⅅ\x{1D400}-\x{1D7CA}&&\p{Lu}")


def _marked(text: Column) -> Column:
    """The text with punctuation as spaces and sentence ends as marks."""
    out = F.coalesce(text, F.lit(""))
    # One pattern for the many characters of a byte, plain replacements for the others.
    other = _PUNCTUATION + "\t\n\x0b\f\r"
    out = F.regexp_replace(out, f"[{re.escape(''.join(c for c in other if c < '\x80'))}]", " ")
    for c in _SENTENCE_END + "".join(c for c in other if c >= "\x80"):
        out = F.replace(out, F.lit(c), F.lit(_STOP if c in _SENTENCE_END else " "))
    return out


def _cut(marked: Column) -> Column:
    return F.split(F.trim(F.lower(F.replace(marked, F.lit(_STOP), F.lit("")))), " +")


def raw_words(text: Column) -> Column:
    return _cut(_marked(text))


def cut_words(text: Column) -> Column:
    """As many words as ``raw_words`` has: names inside a sentence are
    placeholders, other words with a capital have a mark before them."""
    # A name begins with a capital and goes on small, and the word before ends no sentence. The capital is looked for
    # first: few places have one.
    canon = F.regexp_replace(_marked(text), rf"(?=\p{{Lu}})(?<=[^{_STOP} ] {{1,3}})\p{{Lu}}\p{{Ll}}[^ {_STOP}]*", NAME)
    whole = F.replace(canon, F.lit(_STOP), F.lit(""))
    return _cut(F.regexp_replace(whole, rf"(?=\p{{Lu}})(?<![^ ])(?!{_SAME_SMALL})(?=\p{{Lu}}\p{{Ll}})", _CAPITAL))


def _read(word: Column, reading: int, number: Column, name: Column, unit: Column, other) -> Column:
    """The word of ``cut_words`` in a reading: one of the three placeholders
    given, or what ``other`` makes of it."""
    def kind(w: Column) -> Column:
        listed = F.when(w.isin(NUMBER_WORDS), number).otherwise(unit)
        return F.when((w >= "0") & (w < ":"), number).when(w.isin(NUMBER_WORDS + UNITS), listed).otherwise(other(w))
    if reading == 0:
        return F.when(word.startswith(_CAPITAL), kind(F.substring(word, 2, 1 << 30))).otherwise(kind(word))
    return F.when(word.startswith(_CAPITAL) | word.startswith(NAME), name).otherwise(kind(word))


def template_words(words: Column, reading: int) -> Column:
    """The template words of ``cut_words``: names are those inside a sentence
    (0), or all words with a capital (1)."""
    return F.transform(words, lambda w: _read(w, reading, F.lit(NUMBER), F.lit(NAME), F.lit(UNIT), lambda x: x))


def _window_hashes(words: str, df: DataFrame, lengths: list) -> DataFrame:
    """``df`` with a column ``<words>_<length>`` for each length: the hashes of
    the runs of so many words, by place. Runs of 1, 2, 4 words are hashed
    from the halves' hashes, others from these."""
    if f"{words}_1" not in df.columns:
        df = df.withColumn(f"{words}_1", F.transform(words, lambda w: F.xxhash64(w)))
    size = F.size(f"{words}_1")

    def joined(left: int, right: int) -> Column:
        both = F.zip_with(f"{words}_{left}", F.slice(f"{words}_{right}", left + 1, F.greatest(size, F.lit(1))), lambda a, b: F.xxhash64(a, b))
        # zip_with fills the shorter side up with nulls: only whole runs count.
        return F.slice(both, 1, F.greatest(size - (left + right - 1), F.lit(0)))
    done, width = {1}, 1
    while width * 2 <= max(lengths):
        df, width = df.withColumn(f"{words}_{width * 2}", joined(width, width)), width * 2
        done.add(width)
    for length in sorted(set(lengths) - done):
        parts = [p for p in sorted(done, reverse=True) if p & length and p & (p - 1) == 0]
        have = parts[0]
        for part in parts[1:]:
            if have + part not in done:
                df = df.withColumn(f"{words}_{have + part}", joined(have, part))
                done.add(have + part)
            have += part
    return df


def _plain(words: Column) -> Column:
    return F.size(F.filter(words, lambda w: ~w.isin(NUMBER, NAME, UNIT)))


def item_windows(items: DataFrame) -> DataFrame:
    """(item_id, item_row, length, windows, item_at, hash, item_readings, item_raw): an
    item's joined windows in their readings, and their number. Windows of
    fewer than ``LEAST_PLAIN`` words beside placeholders say nothing and are left out."""
    t = items.select("item_id", F.xxhash64("text").alias("item_row"), cut_words(F.col("text")).alias("words"), raw_words(F.col("text")).alias("raw"))
    t = t.select("item_id", "item_row", "raw", *[template_words(F.col("words"), r).alias(c) for r, c in enumerate(("canon", "named"))])
    t = t.withColumn("n", F.size("canon")).where(F.col("n") >= LEAST_WORDS)
    t = t.withColumn("length", F.least(F.col("n"), F.lit(WINDOW)))
    last = F.col("n") - F.col("length") + 1
    starts = F.array_distinct(F.concat(F.sequence(F.lit(1), last, F.lit(STRIDE)), F.array(last)))
    t = t.withColumn("starts", F.filter(starts, lambda s: _plain(F.slice("canon", s, F.col("length"))) >= LEAST_PLAIN))
    t = t.select("*", F.size("starts").alias("windows"), F.explode("starts").alias("item_at"))
    plain, named = (F.slice(c, F.col("item_at"), F.col("length")) for c in ("canon", "named"))
    reading = lambda words, *of: F.struct(words.alias("words"), F.array(*map(F.lit, of)).alias("of"))
    t = t.withColumn("reading", F.explode(F.when(plain == named, F.array(reading(plain, 0, 1))).otherwise(F.array(reading(plain, 0), reading(named, 1)))))
    t = t.withColumn("words", F.col("reading.words")).where(_plain(F.col("words")) >= LEAST_PLAIN)
    lengths = list(range(LEAST_WORDS, WINDOW + 1))
    t = _window_hashes("words", t, lengths)
    hash = F.coalesce(*[F.when(F.col("length") == n, F.get(f"words_{n}", F.lit(0))) for n in lengths])
    return t.select("item_id", "item_row", "length", "windows", "item_at", hash.alias("hash"), F.col("reading.of").alias("item_readings"),
                    F.slice("raw", F.col("item_at"), F.col("length")).alias("item_raw"))


def _hash_bits(hashes: DataFrame, n: int) -> np.ndarray:
    """Two bits for each of the ``n`` hashes, as an array of longs with 128
    bits to a hash, ``MOST_BITS`` at most: a bounded array at any size of the
    benchmark (a fuller one lets more windows on to the join)."""
    size = min(1 << max(14, (128 * n).bit_length()), MOST_BITS)
    at = F.explode(F.array(*[F.pmod(h, F.lit(size)) for h in (F.col("hash"), F.shiftright("hash", 32))])).alias("at")
    words = hashes.select(at).groupBy(F.expr("at div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("mask"))
    bits = np.zeros(size // 64, dtype=np.int64)
    for r in words.collect():
        bits[r["word"]] = r["mask"]
    return bits


def _among(hash: Column, bits: np.ndarray) -> Column:
    """Whether the hash may be among those of ``bits``."""
    def bit(h: Column) -> Column:
        # The number of bits is a power of two.
        at = F.shiftright(h.bitwiseAND(F.lit(64 * len(bits) - 1)), 6)
        return F.getbit(F.get(F.lit(bits), at.cast("int")), h.bitwiseAND(F.lit(63)).cast("int")) == 1
    return bit(hash) & bit(F.shiftright(hash, 32))


def document_windows(docs: DataFrame, lengths: list, bits: np.ndarray) -> DataFrame:
    """(doc_id, row, at, hash, readings, canon, raw) of the windows of the given
    lengths, in both readings where they differ, whose hash may be among those
    of ``bits`` (so that the others make no rows)."""
    # What a lambda reads again and again is a column used twice, so that it is worked out once a row. For the
    # same reason no filter stands on these columns (it would be pushed below them, words and all): the outer
    # explode gives a null row instead.
    t = docs.select("doc_id", F.xxhash64("text").alias("row"), "text", cut_words(F.col("text")).alias("words"))
    number, name, unit = (F.xxhash64(F.lit(w)) for w in (NUMBER, NAME, UNIT))
    t = t.withColumn("canon_1", F.transform("words", lambda w: _read(w, 0, number, name, unit, F.xxhash64)))
    # The readings differ in names only, so reading 1 takes most word hashes over.
    t = t.withColumn("named_1", F.zip_with("canon_1", "words", lambda h, w: F.when(w.startswith(_CAPITAL) | w.startswith(NAME), name).otherwise(h)))
    for reading in ("canon", "named"):
        t = _window_hashes(reading, t, lengths)

    def starts_of(length: int, reading: int) -> Column:
        def start(h: Column, i: Column) -> Column:
            wanted = _among(h, bits) if not reading else (h != F.get(f"canon_{length}", i)) & _among(h, bits)
            return F.when(wanted, F.struct((i + 1).alias("at"), F.lit(length).alias("length"), F.lit(reading).alias("reading"), h.alias("hash")))
        return F.array_compact(F.transform(f"{'named' if reading else 'canon'}_{length}", start))

    # Few documents have such windows: only these need their places and the words themselves.
    met = functools.reduce(Column.__or__, [F.exists(f"{c}_{n}", lambda h: _among(h, bits)) for n in lengths for c in ("canon", "named")])
    t = t.withColumn("starts", F.when(met, F.concat(*[starts_of(n, r) for n in lengths for r in (0, 1)])))
    some = lambda c: F.when(F.size("starts") > 0, c)
    t = t.select("doc_id", "row", "starts", some(raw_words(F.col("text"))).alias("raw"),
                 *[some(template_words(F.col("words"), r)).alias(c) for r, c in enumerate(("canon", "named"))])

    def window(s: Column) -> Column:
        plain, named = F.slice("canon", s["at"], s["length"]), F.slice("named", s["at"], s["length"])
        words = F.when(s["reading"] == 0, plain).otherwise(named)
        readings = F.when(plain == named, F.array(F.lit(0), F.lit(1))).otherwise(F.array(s["reading"]))
        return F.struct(s["at"].alias("at"), s["hash"].alias("hash"), readings.alias("readings"), words.alias("canon"),
                        F.slice("raw", s["at"], s["length"]).alias("raw"))

    t = t.select("doc_id", "row", F.when(F.size("raw") > 0, F.transform("starts", window)).alias("windows"))
    return t.select("doc_id", "row", F.explode_outer("windows").alias("w")).where("w is not null").select("doc_id", "row", "w.*")


def _longest_run(places: Column, length: Column) -> Column:
    """Most words in a row under windows at the given sorted places."""
    none = F.struct(F.lit(None).cast("int").alias("from"), F.lit(None).cast("int").alias("at"), F.lit(0).alias("most"))

    def step(s: Column, p: Column) -> Column:
        start = F.when(p - s["at"] <= STRIDE, s["from"]).otherwise(p)
        return F.struct(start.alias("from"), p.alias("at"), F.greatest(s["most"], p + length - start).alias("most"))
    return F.aggregate(places, none, step, lambda s: s["most"])


def matches(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, row, item_id, matched, windows, coverage, reparameterised) of each
    contaminated document and item."""
    wanted = stash(item_windows(items), "benchmark-windows")
    lengths = sorted(r[0] for r in wanted.select("length").distinct().collect()) or [WINDOW]  # at most WINDOW values
    n = wanted.count()
    bits = _hash_bits(wanted.select("hash"), n)
    met = document_windows(docs, lengths, bits).join(F.broadcast(wanted) if n <= BROADCAST_WINDOWS else wanted, "hash")
    met = met.withColumn("reading", F.explode(F.array_intersect("readings", "item_readings")))
    slots = F.filter(F.zip_with("canon", F.arrays_zip("item_raw", "raw"), lambda c, v: F.struct(
        c.alias("kind"), v["item_raw"].alias("a"), v["raw"].alias("b"))), lambda p: p["kind"].isin(NUMBER, NAME, UNIT))
    diagonals = met.groupBy("doc_id", "row", "item_id", "item_row", "windows", "length", "reading", (F.col("at") - F.col("item_at")).alias("diagonal")).agg(
        F.collect_set("item_at").alias("places"), F.array_distinct(F.flatten(F.collect_set(slots))).alias("pairs"))
    consistent = F.size(F.array_distinct(F.transform("pairs", lambda p: F.struct(p["kind"], p["a"])))) == F.size("pairs")
    found = diagonals.where(consistent).groupBy("doc_id", "row", "item_id", "item_row", "windows").agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("places")))).cast("long").alias("matched"),
        F.max(F.exists("pairs", lambda p: p["a"] != p["b"])).alias("reparameterised"),
        F.max(_longest_run(F.array_sort("places"), F.col("length"))).alias("run"))
    found = found.withColumn("coverage", F.col("matched") / F.col("windows"))
    whole = (F.col("coverage") >= COVERAGE) & (F.col("matched") >= F.least(F.col("windows"), F.lit(2)))
    return found.where(whole | (F.col("run") >= RUN_WORDS)).select(
        "doc_id", "row", "item_id", "matched", F.col("windows").cast("long").alias("windows"), "coverage", "reparameterised")


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``matches`` without the row's hash."""
    return matches(docs, items).drop("row")


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated documents."""
    bad = matches(docs, items).select(F.col("doc_id").alias("bad_id"), F.col("row").alias("bad_row")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.xxhash64("text") == F.col("bad_row")), "left_anti")


def op3_decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    return contaminated(docs, items)
