r"""PII surrogates (native).

Entities are found by one pattern (e-mail, secrets, IBAN, IP, phone, card and
other long numbers, names with a title or a listed first name) and replaced by
keyed surrogates of the same type and format: digits stay digits in the same
places, letters stay letters of the same case and script, a card that passes
the Luhn check passes it again, an IP has four valid octets, a first name keeps
its gender and script, a reserved example domain stays one.

A surrogate depends on the key, the type and the normalised value (an e-mail in
small letters, a phone's digits), so every mention of an entity gets the same
one, whatever its layout, and an e-mail's name or domain in capitals stays in
capitals (mixed case becomes small); each word of a name is an entity of its own, and a document's surnames are found again
where they stand alone. Distinct entities get distinct surrogates: surrogates of
all distinct entities that look alike (all names; all numbers) are compared with
each other and with all originals, and an entity that collides is moved to its
next round, until none does. From round ``WIDEN`` on a surrogate is some signs
longer than its format (an IP becomes one of the IPv6 documentation range), and
longer with every round, so that a format whose values are all taken ends too.
Only moved entities are joined back to documents; all other surrogates are
computed in place.

Names are found by a title or a listed first name only; others stay.

Defined results: null text stays null; a text without entities is unchanged;
rows keep their other columns and repeated rows stay; documents are matched
with moved entities by doc_id (null ids too); an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

KEY = "surrogate-1"
#: The round from which surrogates are longer than their format, and by how many signs more each round.
WIDEN, WIDER = 4, 4

# Titles by gender, and first names by gender (all lower-case).
TITLES = {"f": "Mrs Ms Miss Madame Mme Mlle Frau Señora Sra Señorita г-жа".split(),
          "m": "Mr Mister Monsieur Herr Señor Sr г-н".split(), "n": "Dr Prof Professor Doctor Judge Captain".split()}
FIRST_NAMES = {
    "f": "mary patricia jennifer linda elizabeth susan jessica sarah karen anna maria emma sophie marie julia laura carmen lucía ana анна мария елена ольга".split(),
    "m": "james john robert michael william david richard joseph thomas peter hans karl jean pierre paul josé juan carlos иван сергей дмитрий алексей".split()}
_SYLLABLES = {"latin": "ba be bo ca co da de do fa fe ga go ha jo ka ke la le li lo ma me mi mo na ne ni no pa po ra re ri ro sa se so ta te to va ve vi za".split(),
              "cyrillic": "ба бе бо ва ве га да де до за ка ко ла ле ли ло ма ме ми мо на не ни но па по ра ре ро са со та те то".split()}
_ENDINGS = {"f": {"latin": "na la ra ia".split(), "cyrillic": "на ла ра ия".split()},
            "m": {"latin": "nus ton ric mir".split(), "cyrillic": "мир тон рик нус".split()},
            "last": {"latin": "son man ler vic".split(), "cyrillic": "ов ин ский енко".split()}}

_ANY_TITLE = "|".join(t for group in TITLES.values() for t in group)
_ANY_FIRST = "|".join(n.capitalize() for group in FIRST_NAMES.values() for n in group)
_NAME = r"\p{Lu}\p{Ll}+"
#: What introduces a secret; it stays.
_LABEL = r"(?:password|passwd|token|secret|api_key|apikey)\s{0,2}[=:]\s{0,2}\"?"
_EMAIL = r"[\w.%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"
_IP = r"(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d.]?\d)"
#: Patterns by what they begin with, in order of precedence, each with its own look back. Only an IP may begin behind
#: an ASCII word character, so that inside words nothing else is tried; the others look back at what they exclude beyond.
_BY_DIGIT = (
    rf"(?<!\.){_IP}",
    r"(?<!\+)\+\d{1,3}(?:[ .-]?\(\d{1,4}\)|[ .-]?\d{1,4}){2,5}(?!\w)",                       # phone
    r"(?<![.-])(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}(?![\w-])",                            # phone
    r"(?<![.-])\d{3}-\d{2}-\d{4}(?![\w-])",                                                  # number
    r"(?<![.-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?![\w-])",                                  # card
)
_BY_CAPITAL = (
    r"AKIA[0-9A-Z]{16}(?!\w)",                                                                # secret
    r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?!\w)",                         # IBAN
    rf"(?:(?:{_ANY_TITLE})\.? {_NAME}(?: {_NAME})?|(?:{_ANY_FIRST}) {_NAME})(?!\w)",           # name
)
_LOWER_TITLES = "|".join(rf"{t}\.? {_NAME}(?: {_NAME})?(?!\w)" for t in ("г-н", "г-жа"))
_ALL = (rf"(?<!\w)(?:(?<![.%+-]){_EMAIL}|(?=[past]){_LABEL}[^\s\"]{{6,}}|(?=sk-|gh[pousr]_)(?:sk-|gh._)[A-Za-z0-9]{{20,}}(?!\w)"
        r"|[0-9a-f]{32,64}+(?!\w)|(?=[\d+(])(?:" + "|".join(_BY_DIGIT) + r")|(?=\p{Lu})(?:" + "|".join(_BY_CAPITAL)
        + rf")|(?=г-)(?:{_LOWER_TITLES}))|(?=\d)(?<=[A-Za-z_]){_IP}")
_DIGITS = ("phone", "number", "card")


def pattern_of(text: Column) -> Column:
    """The pattern for a text: its own surnames count wherever they stand alone."""
    names = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({_ALL})"), F.lit(1))
    last = F.array_distinct(F.transform(F.filter(names, lambda m: kind_of(m) == "name"), lambda m: F.element_at(_name_words(m), -1)))
    return F.when(F.size(last) > 0, F.concat(F.lit(_ALL + r"|(?<!\w)(?:"), F.array_join(last, "|"), F.lit(r")(?!\w)"))).otherwise(F.lit(_ALL))


def mentions(text: Column, pattern: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.concat(F.lit("("), pattern, F.lit(")")), F.lit(1))


def kind_of(mention: Column) -> Column:
    """A mention's type by its own form."""
    return (F.when(mention.rlike(f"^{_LABEL}"), "secret").when(F.contains(mention, F.lit("@")), "email").when(mention.rlike(r"^[A-Z]{2}\d{2}[ A-Z0-9]*$") & ~mention.startswith("AKIA"), "iban")
            .when(mention.rlike(r"^\d{1,3}(\.\d{1,3}){3}$"), "ip").when(mention.rlike(r"^\d{3}-\d{2}-\d{4}$"), "number")
            .when(mention.rlike(r"^(\+|\(\d{3}\)|\d{3}[.-]\d{3}[.-])[\d ().-]*$"), "phone").when(mention.rlike(r"^\d[\d -]*$"), "card")
            .when(mention.rlike(rf"^(?:(?:{_ANY_TITLE})\.? )?{_NAME}(?: {_NAME})?$"), "name").otherwise("secret"))


def _name_words(mention: Column) -> Column:
    return F.split(F.regexp_replace(mention, rf"^(?:{_ANY_TITLE})\.? ", ""), " ")


def _gender(mention: Column) -> Column:
    """f or m; by the title, else by the first name, else m or f by its end."""
    first = F.lower(F.get(_name_words(mention), 0))
    title = lambda g: mention.rlike(rf"^(?:{'|'.join(TITLES[g])})\.? ")
    return (F.when(first.isin(FIRST_NAMES["f"]), "f").when(first.isin(FIRST_NAMES["m"]), "m").when(title("f"), "f").when(title("m"), "m")
            .when(first.rlike("[aая]$"), "f").otherwise("m"))


def entities(mention: Column, kind: Column) -> Column:
    """The mention's entities: array of struct(type, value)."""
    words = _name_words(mention)
    entity = lambda t, v: F.struct(t.alias("type"), F.lower(v).alias("value"))
    value = F.when(kind.isin(*_DIGITS), F.regexp_replace(mention, r"\D", "")).when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).when(
        kind == "secret", F.regexp_replace(mention, f"^{_LABEL}", "")).otherwise(mention)
    # A secret's case is part of it.
    other = F.struct(kind.alias("type"), F.when(kind == "email", F.lower(value)).otherwise(value).alias("value"))
    return F.when(kind != "name", F.array(other)).when(
        F.size(words) > 1, F.array(entity(_gender(mention), F.get(words, 0)), entity(F.lit("last"), F.get(words, 1)))).otherwise(
        F.array(entity(F.lit("last"), F.get(words, 0))))


def _pick(digest: Column, i: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(digest, i), F.lit(n)).cast("int")


def _choose(digest: Column, i: int, words: list) -> Column:
    return F.element_at(F.array(*map(F.lit, words)), _pick(digest, F.lit(i), len(words)) + 1)


def _like(value: Column, digest: Column) -> Column:
    """Each letter and digit replaced by one of its kind and case."""
    def one(char: Column, i: Column) -> Column:
        draw = lambda alphabet: F.substring(F.lit(alphabet), _pick(digest, i, len(alphabet)) + 1, F.lit(1))
        return (F.when((char >= "0") & (char <= "9"), draw("0123456789")).when((char >= "a") & (char <= "z"), draw("abcdefghijklmnopqrstuvwxyz"))
                .when((char >= "A") & (char <= "Z"), draw("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
                .when((char >= "а") & (char <= "я"), draw("абвгдежзиклмнопрстуфхцчшэюя")).when((char >= "А") & (char <= "Я"), draw("АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЭЮЯ"))
                .when((char >= "α") & (char <= "ω"), draw("αβγδεζηθικλμνξοπρστυφχψω")).when(char.rlike(r"^\p{Ll}$"), draw("abcdefghijklmnopqrstuvwxyz"))
                .when(char.rlike(r"^\p{Lu}$"), draw("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(char))
    return F.array_join(F.transform(F.filter(F.split(value, ""), lambda c: c != ""), one), "")


def _luhn(digits: Column) -> Column:
    """Luhn sum modulo 10 of a string of digits."""
    reversed_ = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    doubled = F.transform(reversed_, lambda c, i: F.when(i % 2 == 1, F.element_at(
        F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x) % 10


def look_alikes(kind: Column) -> Column:
    """Types whose values could be taken for each other, as one."""
    return F.when(kind.isin("f", "m", "last"), "name").when(kind.isin(*_DIGITS), "digits").otherwise(kind)


def surrogate(kind: Column, value: Column, round_: Column, key: str = KEY) -> Column:
    """The entity's surrogate value in its given round."""
    more = F.greatest(round_ - (WIDEN - 1), F.lit(0)) * WIDER
    longer = lambda sign: _like(F.repeat(F.lit(sign), more.cast("int")), F.sha2(F.concat(digest, F.lit("|longer")), 256))
    digest = F.sha2(F.concat(F.lit(f"{key}|"), kind, F.lit("|"), value, F.lit("|"), round_.cast("string")), 256)
    name_like = lambda part: F.concat(
        *[F.when(value.rlike(r"\p{IsCyrillic}"), _choose(digest, i, _SYLLABLES["cyrillic"])).otherwise(_choose(digest, i, _SYLLABLES["latin"])) for i in range(2)],
        # Later rounds have more syllables, so that names never run out.
        F.array_join(F.transform(F.sequence(F.lit(0), F.floor(round_ / 3).cast("int")), lambda i: F.when(i > 0, _choose_at(digest, i, value)).otherwise("")), ""),
        F.when(value.rlike(r"\p{IsCyrillic}"), _choose(digest, 90, _ENDINGS[part]["cyrillic"])).otherwise(_choose(digest, 90, _ENDINGS[part]["latin"])))
    digits = F.concat(F.substring(value, 1, 1), _like(F.substring(value, 2, 100), digest), longer("0"))
    card = F.when(_luhn(value) != 0, digits).otherwise(_with_luhn(digits))
    ip = F.array_join(F.array((_pick(digest, F.lit(1), 223) + 1).cast("string"), *[_pick(digest, F.lit(i), 256).cast("string") for i in (2, 3)],
                              (_pick(digest, F.lit(4), 254) + 1).cast("string")), ".")
    ip = F.when(more > 0, F.concat(F.lit("2001:db8"), *[x for i in range(6) for x in (F.lit(":"), F.substring(digest, 4 * i + 1, 4))])).otherwise(ip)
    local, domain = F.substring_index(value, "@", 1), F.regexp_extract(value, "@(.*)$", 1)
    # A domain is an entity of its own: its digest leaves the local part out. Its last label stays, a reserved name's last two.
    tail = F.regexp_extract(domain, r"((?:\.|^)(?:example\.(?:com|org|net)|[^.]+))$", 1)
    of_domain = F.sha2(F.concat(F.lit(f"{key}|domain|"), domain), 256)
    head = F.substring(domain, F.lit(1), F.length(domain) - F.length(tail))
    email = F.concat(_like(local, digest), longer("a"), F.lit("@"), _like(head, of_domain), tail)
    iban = F.concat(F.substring(value, 1, 2), _like(F.substring(value, 3, 100), digest), longer("0"))
    secret = F.when(value.startswith("AKIA"), F.concat(F.lit("AKIA"), _like(F.substring(value, 5, 100), digest), longer("A"))).when(
        value.rlike("^[0-9a-f]+$"), F.concat(_hex_like(value, digest), longer("0"))).otherwise(F.concat(_like(value, digest), longer("a")))
    return (F.when(kind == "email", email).when(kind == "ip", ip).when(kind == "card", card).when(kind.isin("phone", "number"), digits)
            .when(kind == "iban", iban).when(kind == "f", name_like("f")).when(kind == "m", name_like("m")).when(kind == "last", name_like("last"))
            .otherwise(secret))


def _choose_at(digest: Column, i: Column, value: Column) -> Column:
    pick = lambda words: F.element_at(F.array(*map(F.lit, words)), _pick(digest, i + 100, len(words)) + 1)
    return F.when(value.rlike(r"\p{IsCyrillic}"), pick(_SYLLABLES["cyrillic"])).otherwise(pick(_SYLLABLES["latin"]))


def _hex_like(value: Column, digest: Column) -> Column:
    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), lambda i: F.substring(
        F.lit("0123456789abcdef"), _pick(digest, i, 16) + 1, F.lit(1))), "")


def _with_luhn(digits: Column) -> Column:
    body = F.substring(digits, F.lit(1), F.length(digits) - 1)
    return F.concat(body, F.pmod(10 - _luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))


def _cased(value: Column, model: Column) -> Column:
    """``value`` in capitals if ``model`` has no small letters."""
    return F.when(model == F.upper(model), F.upper(value)).otherwise(value)


def lay_out(mention: Column, kind: Column, values: Column) -> Column:
    """The surrogate values in the mention's layout."""
    chars = F.filter(F.split(mention, ""), lambda c: c != "")
    # Digits (and an IBAN's signs) go one by one into the places of the mention's own.
    fill = lambda cls: F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), lambda s, c: F.when(
        c.rlike(cls), F.struct(F.concat(s["out"], F.substring(F.get(values, 0), s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(
        F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at"))), lambda s: F.concat(s["out"], F.substring(F.get(values, 0), s["at"], F.lit(1 << 20))))
    email = F.concat_ws("@", *[_cased(F.substring_index(F.get(values, 0), "@", n), F.substring_index(mention, "@", n)) for n in (1, -1)])
    title = F.regexp_extract(mention, rf"^((?:{_ANY_TITLE})\.? )", 1)
    named = F.concat(title, F.array_join(F.transform(values, lambda v: F.initcap(v)), " "))
    return F.when(kind.isin(*_DIGITS), fill("[0-9]")).when(kind == "iban", fill("[A-Z0-9]")).when(kind == "name", named).when(kind == "email", email).otherwise(
        F.concat(F.regexp_extract(mention, f"^({_LABEL})?", 0), F.get(values, 0)))


def detect(docs: DataFrame) -> DataFrame:
    """(doc_id, mention, kind): a row per mention."""
    found = docs.select("doc_id", mentions(F.col("text"), pattern_of(F.col("text"))).alias("found"))
    rows = found.select("doc_id", F.explode_outer("found").alias("mention")).where("mention is not null")
    return rows.withColumn("kind", kind_of(F.col("mention")))


def moved_entities(found: DataFrame, key: str = KEY) -> DataFrame:
    """(type, value, round) of the entities whose first surrogate collides."""
    every = found.select(F.explode(entities(F.col("mention"), F.col("kind"))).alias("e")).select("e.*").distinct()
    now = stash(every.withColumn("round", F.lit(0)), "pii-entities")
    originals = now.select(look_alikes(F.col("type")).alias("of"), F.col("value").alias("original")).distinct()
    while True:
        given = now.withColumn("given", surrogate(F.col("type"), F.col("value"), F.col("round"), key)).withColumn("alike", look_alikes(F.col("type")))
        # Who came first keeps the surrogate.
        order = Window.partitionBy("alike", "given").orderBy("round", "value", "type")
        given = given.withColumn("turn", F.row_number().over(order))
        given = given.join(originals, (F.col("alike") == F.col("of")) & (F.col("given") == F.col("original")), "left")
        clash = (F.col("turn") > 1) | F.col("original").isNotNull()
        now = stash(given.select("type", "value", F.when(clash, F.col("round") + 1).otherwise(F.col("round")).alias("round"), clash.alias("clash")), "pii-entities")
        if not now.where("clash").take(1):
            return now.where("round > 0").select("type", "value", "round")
        now = now.drop("clash")


def replace_pii(docs: DataFrame, key: str = KEY) -> DataFrame:
    """``docs`` with surrogates in text, and the column n_entities."""
    found = stash(detect(docs), "pii-mentions")
    moved = moved_entities(found, key)
    columns = docs.columns
    if moved.take(1):
        per = found.select("doc_id", F.explode(entities(F.col("mention"), F.col("kind"))).alias("e")).select("doc_id", "e.type", "e.value")
        per = per.join(moved, ["type", "value"]).groupBy(F.col("doc_id").alias("pii_id")).agg(
            F.map_from_entries(F.collect_set(F.struct(F.concat("type", F.lit("|"), "value"), "round"))).alias("pii_rounds"))
        docs = docs.join(per, F.col("doc_id").eqNullSafe(F.col("pii_id")), "left")
        round_of = lambda e: F.coalesce(F.get(F.array(F.element_at("pii_rounds", F.concat(e["type"], F.lit("|"), e["value"]))), 0), F.lit(0))
    else:
        round_of = lambda e: F.lit(0)

    def replaced(mention: Column) -> Column:
        kind = kind_of(mention)
        values = F.transform(entities(mention, kind), lambda e: surrogate(e["type"], e["value"], round_of(e), key))
        return lay_out(mention, kind, values)

    with_found = docs.withColumn("pii_pattern", pattern_of(F.col("text"))).withColumn("pii_found", mentions(F.col("text"), F.col("pii_pattern")))
    gaps = F.split("text", F.col("pii_pattern"), -1)
    news = F.concat(F.transform("pii_found", replaced), F.array(F.lit("")))
    text = F.when(F.size("pii_found") > 0, F.array_join(F.zip_with(gaps, news, lambda g, n: F.concat(g, n)), "")).otherwise(F.col("text"))
    return with_found.select(*[text.alias(c) if c == "text" else F.col(c) for c in columns], F.size("pii_found").alias("n_entities"))


def op4_pii(docs: DataFrame) -> DataFrame:
    return replace_pii(docs.select("doc_id", "text"))
