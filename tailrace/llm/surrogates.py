"""Keyed surrogates for personal data, by DataFrame functions alone.

Mentions are found by one pattern. Each names an identity (its kind and its value without what may vary between
mentions: case, separators). An identity's core is drawn from a keyed digest; it has the kind's form: the same
classes of characters, a card number of the same network that passes or fails the check sum as before, an address with valid parts,
a name of the same gender and script. The core then fills a mention's letters and digits in its own case and with
its own separators, so mentions of one identity stay mentions of one.

A name is found by its title and taken word by word: each word is an identity of its own. So a person stays the same
under another title, and different names stay different. Where a text has a titled name, its words are replaced
without a title too. A word's gender is what titles with a gender say before it in all of the corpus, none if they disagree.

Cores are checked over the corpus: where two identities would share one, or one equals a real identity, all but
the first draw again with the next attempt number. What a kind's forms have no room for after all attempts trades
values among itself: these are distinct, as no core equals a real identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tailrace.llm.tables import Tables

# Titles by the gender they tell; the last group tells none.
TITLES = {
    "m": "Mr Herr Monsieur Señor Sr Signor Господин Κύριος",
    "f": "Mrs Ms Miss Frau Madame Mme Señora Sra Signora Госпожа Κυρία",
    "n": "Dr Prof Доктор",
}
_TITLE = "(?:" + "|".join(t for g in TITLES.values() for t in g.split()) + ")"
# What may stand before a family name or at its beginning.
_PARTICLE = "(?:von|van|zu|de|der|den|del|della|da|di|du|la|le|al|bin)"
_WORD = r"(?:Mc|Mac|[OD]['’])?\p{Lu}\p{Ll}++"
_NAME = rf"(?<![\p{{L}}\p{{N}}]){_TITLE}\.? (?:{_PARTICLE} ){{0,2}}{_WORD}(?:[ -](?:{_PARTICLE} ){{0,2}}{_WORD}){{0,2}}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_HEX4 = "[0-9A-Fa-f]{1,4}"
_ALONE, _END = r"(?<![\p{L}\p{N}_.+-])", r"(?![\p{L}\p{N}_])"
# Kinds in the order in which they are tried at a place. A repeated group is bounded or possessive: Java keeps a frame
# of its stack for each turn of any other, and a long text of short parts would use it up.
KINDS = {
    "email": r"(?<![\p{L}\p{N}_.%+-])[\p{L}\p{N}_%+-]++(?:\.[\p{L}\p{N}_%+-]++)*+@(?:[\p{L}\p{N}-]{1,63}+\.){1,126}\p{L}{2,}+",
    "secret": r"(?<=(?i:password|passwd|secret|token|api_key|apikey)\s{0,3}[=:]\s{0,3}[\"']{0,1})[^\s\"'<>]{5,}[\p{L}\p{N}_/+=-]"
    rf"|{_ALONE}(?:AKIA|ASIA)[0-9A-Z]{{16}}{_END}",
    "ip6": rf"(?<![\p{{L}}\p{{N}}_.:])(?=[A-Fa-f:]{{0,30}}[0-9])(?:(?:{_HEX4}:){{7}}{_HEX4}|(?:{_HEX4}:){{1,7}}(?::{_HEX4}){{1,6}})(?![\p{{L}}\p{{N}}_:])",
    "ip": rf"(?<![\p{{L}}\p{{N}}_.-]){_OCTET}(?:\.{_OCTET}){{3}}(?![\p{{L}}\p{{N}}_]|\.\d)",
    "iban": rf"{_ALONE}[A-Z]{{2}}\d{{2}}(?:[A-Z0-9]{{11,30}}|(?: [A-Z0-9]{{4}}){{2,7}}(?: [A-Z0-9]{{1,3}})?){_END}",
    "card": rf"{_ALONE}(?:\d{{16}}|\d{{4}}([ -])\d{{4}}\1\d{{4}}\1\d{{4}}|3\d{{14}}){_END}",
    "phone": rf"(?:(?<![\p{{L}}\p{{N}}_+])\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)|\d{{1,4}})(?:[ .-]?\d{{2,4}}){{2,4}}"
    rf"|(?<![\p{{L}}\p{{N}}_])\(\d{{3}}\) ?\d{{3}}[ .-]\d{{4}}|{_ALONE}\d{{3}}[.-]\d{{3}}[.-]\d{{4}}){_END}",
    "ssn": rf"{_ALONE}\d{{3}}-\d{{2}}-\d{{4}}{_END}",
    "name": _NAME,
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())
# In a text with a titled name any capitalised word is looked at; group 1 is the separator within a card number.
_WORD_GROUP = 2
PATTERN_WITH_WORDS = rf"{PATTERN}|((?<![\p{{L}}\p{{N}}]){_WORD})"
# Any mention has one of these, which are quick to look for.
HINT = rf"[0-9@]|::|(?i:password|passwd|secret|token|api_key|apikey)|{_TITLE}\.? (?:\p{{Lu}}|{_PARTICLE} )"
_SCRIPTS = {  # first letters, and how many follow
    r"\p{IsCyrillic}": (0x430, 32),
    r"\p{IsGreek}": (0x3B1, 17),
    r"\p{IsHan}": (0x4E00, 2000),
    r"\p{IsHiragana}": (0x3042, 60),
    r"\p{IsKatakana}": (0x30A2, 60),
    r"\p{IsHangul}": (0xAC00, 2000),
    r"\p{IsArabic}": (0x627, 30),
    r"\p{IsHebrew}": (0x5D0, 27),
}
_ONSETS = {"latin": "bdfgklmnprstvz", "cyrillic": "бдгклмнпрствз", "greek": "βδγκλμνπρστ"}
_VOWELS = {"latin": "aeiou", "cyrillic": "аеиоу", "greek": "αειο"}
_CLOSING = {"latin": {"m": "n", "f": "a", "n": "l"}, "cyrillic": {"m": "н", "f": "а", "n": "л"}, "greek": {"m": "ς", "f": "α", "n": "ν"}}
_ATTEMPTS = 64


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _stream(key: str, kind: Column, identity: Column, attempt: Column) -> Column:
    """512 hex digits that only the key can tell."""
    seed = F.concat_ws("\x00", F.lit(key), kind, attempt.cast("string"), identity)
    return F.concat(*[F.sha2(F.concat(F.lit(f"{i}\x00"), seed, F.lit(f"\x00{key}")).cast("binary"), 512) for i in range(4)])


def _number(stream: Column, i: Column) -> Column:
    """The ``i``-th number below 65,536 of a stream."""
    return F.conv(F.substr(stream, F.pmod(i, F.lit(128)) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _drawn(char: Column, n: Column, hexadecimal: Column) -> Column:
    """A character of the same class: digit, or lower-case letter of the same script."""
    pick = lambda start, size: F.char(start + F.pmod(n, F.lit(size))) if start < 128 else F.decode(F.unhex(F.lpad(F.hex(start + F.pmod(n, F.lit(size))), 4, "0")), "UTF-16BE")
    letter = F.when(hexadecimal, pick(97, 6))
    for script, (start, size) in _SCRIPTS.items():
        letter = letter.when(char.rlike(script), pick(start, size))
    return F.when(char.rlike(r"^\p{N}$"), F.pmod(n, F.lit(10)).cast("string")).when(char.rlike(r"^\p{L}$"), letter.otherwise(pick(97, 26))).otherwise(char)


def _luhn(digits: Column) -> Column:
    """Sum of the check: from the right, every second digit doubled."""
    values = F.transform(F.reverse(_chars(digits)), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def _mod97(chars: Column) -> Column:
    """Remainder by 97 of the number that letters (A is 10) and digits make."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.try_cast("int")).otherwise(F.ascii(c) - 55)
    return F.aggregate(_chars(F.upper(chars)), F.lit(0), lambda a, c: F.pmod(a * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97)))


def _iban(plain: Column, identity: Column) -> Column:
    """An account number with check digits as good as the identity's."""
    country, rest = F.substr(plain, F.lit(1), F.lit(2)), F.substr(plain, F.lit(5))
    right = _mod97(F.concat(F.substr(identity, F.lit(5)), F.substr(identity, F.lit(1), F.lit(4)))) == 1
    digits = F.lpad((98 - _mod97(F.concat(rest, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(right, F.concat(country, digits, rest)).otherwise(plain)


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _person(name: Column, gender: Column, stream: Column, attempt: Column) -> Column:
    """A word of invented syllables in the name's script, whose ending tells the gender; later attempts give longer ones."""

    def build(script: str) -> Column:
        on, vo = _ONSETS[script], _VOWELS[script]
        end = F.when(gender == "m", _CLOSING[script]["m"]).when(gender == "f", _CLOSING[script]["f"]).otherwise(_CLOSING[script]["n"])
        letter = lambda s, i: F.substr(F.lit(s), F.pmod(_number(stream, i), F.lit(len(s))) + 1, F.lit(1))
        last = 2 + F.call_function("div", attempt, F.lit(8)).cast("int")
        syllables = F.transform(F.sequence(F.lit(0), last), lambda i: F.concat(letter(on, i * 2 + 1), letter(vo, i * 2 + 2)))
        return F.concat(F.array_join(syllables, ""), letter(on, F.lit(0)), end)

    script = _script(name)
    return F.when(script == "cyrillic", build("cyrillic")).when(script == "greek", build("greek")).otherwise(build("latin"))


def _bare(mention: Column) -> Column:
    return F.upper(F.regexp_replace(mention, r"[^\p{L}\p{N}]", ""))


def _described(mentions: DataFrame) -> DataFrame:
    """A row per part of each ``mention``: kind, identity, gender, ``fixed``, which stays as it is, and ``rest``, which does not.

    A titled name has a part per word; anything else has one. ``word`` is filled where nothing but a capital letter speaks for a mention.
    """
    m = F.col("mention")
    kind = F.lit("secret")  # only a key's context tells it, which the mention is without
    for k in reversed([k for k in KINDS if k != "secret"]):
        kind = F.when(m.rlike(f"^(?:{KINDS[k]})$"), k).otherwise(kind)
    mentions = mentions.withColumn("kind", F.when(F.col("word") != "", "word").otherwise(kind))
    # A country code stays; without a separator it is known as what stands before ten digits.
    code = F.regexp_extract(m, r"^\+\d{1,3}(?=[ .(-])", 0)
    code = F.when(code != "", code).otherwise(F.regexp_extract(m, r"^\+\d{1,3}(?=[0-9]{10}$)", 0))
    lead = F.when(F.col("kind") == "phone", code).when(F.col("kind") == "name", F.regexp_extract(m, rf"^{_TITLE}\.? ", 0)).otherwise("")
    mentions = mentions.withColumn("lead", lead).withColumn("rest", F.substr(m, F.length("lead") + 1))
    joints = F.split("rest", _WORD, -1)
    first = lambda i: F.when(i == 0, F.col("lead")).otherwise("")
    words = F.transform(
        F.regexp_extract_all("rest", F.lit(_WORD), F.lit(0)),
        lambda w, i: F.struct(F.concat(first(i), F.get(joints, i)).alias("fixed"), w.alias("rest")),
    )
    whole = F.array(F.struct(F.col("lead").alias("fixed"), F.col("rest").alias("rest")))
    parts = F.posexplode(F.when(F.col("kind") == "name", words).otherwise(whole)).alias("part", "p")
    mentions = mentions.select("uid", "pos", "mention", "kind", "lead", parts).select("*", "p.fixed", "p.rest").drop("p")
    title = F.regexp_extract("lead", rf"^({_TITLE})\.? $", 1)
    gender = F.when(title.isin(TITLES["m"].split()), "m").when(title.isin(TITLES["f"].split()), "f").otherwise("")
    rest = F.col("rest")
    identity = F.when(F.col("kind").isin("card", "phone", "ssn", "iban"), _bare(rest)).when(F.col("kind").isin("email", "name", "word", "ip6"), F.lower(rest)).otherwise(rest)
    return mentions.withColumn("gender", F.when((F.col("kind") == "name") & (F.col("part") == 0), gender).otherwise("")).withColumn("identity", identity).drop("lead")


def _identities(found: DataFrame) -> DataFrame:
    """kind, identity and the gender that all of its titles with a gender tell."""
    told = found.groupBy("kind", "identity").agg(F.bool_or(F.col("gender") == "m").alias("m"), F.bool_or(F.col("gender") == "f").alias("f"))
    gender = F.when(F.col("m") & ~F.col("f"), "m").when(F.col("f") & ~F.col("m"), "f").otherwise("n")
    return told.select("kind", "identity", gender.alias("gender"))


def _core(key: str) -> Column:
    """The surrogate of an identity in its plainest form, from kind, identity and attempt."""
    kind, identity = F.col("kind"), F.col("identity")
    stream = F.col("stream")
    hexadecimal = (kind == "ip6") | (kind == "secret") & identity.rlike("^[0-9a-fA-F]+$")
    tail = F.when(kind == "email", F.length(F.regexp_extract(identity, r"\.\p{L}+$", 0))).otherwise(0)
    chars, size = _chars(identity), F.length(identity)
    lead = F.when(kind == "iban", 2).when(kind == "card", 1).when((kind == "secret") & identity.rlike("^A[KS]IA"), 4).otherwise(0)
    plain = F.array_join(F.transform(chars, lambda c, i: F.when((i < lead) | (i >= size - tail), c).otherwise(_drawn(c, _number(stream, i), hexadecimal))), "")
    octets = F.split(identity, r"\.")
    private = identity.rlike(r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\.")
    first = F.when(private, 10).otherwise(11 + F.pmod(_number(stream, F.lit(0)), F.lit(115)))
    address = F.concat_ws(".", first, *[F.when(octets[i].isNotNull(), 1 + F.pmod(_number(stream, F.lit(i)), F.lit(254))) for i in (1, 2, 3)])
    short = F.substr(plain, F.lit(1), F.length(plain) - 1)
    check = F.pmod(10 - F.pmod(_luhn(F.concat(short, F.lit("0"))), F.lit(10)), F.lit(10))
    valid = F.pmod(_luhn(identity), F.lit(10)) == 0
    card = F.concat(short, F.when(valid, check).otherwise(F.pmod(check + 1 + F.pmod(_number(stream, F.lit(99)), F.lit(9)), F.lit(10))).cast("string"))
    person = _person(identity, F.col("gender"), stream, F.col("attempt"))
    return F.when(kind == "ip", address).when(kind == "card", card).when(kind == "iban", _iban(plain, identity)).when(kind == "name", person).otherwise(plain)


def _drawn_for(identities: DataFrame, key: str) -> DataFrame:
    return identities.withColumn("stream", _stream(key, F.col("kind"), F.col("identity"), F.col("attempt"))).withColumn("core", _core(key)).drop("stream")


def surrogate_table(identities: DataFrame, key: str, tables: Tables, attempts: int = _ATTEMPTS) -> DataFrame:
    """kind, identity and core, one distinct core for each identity of a kind and none that is an identity itself.

    Only where a kind has more identities than free forms after all attempts, the rest gets each other's values.
    """
    real = identities.select("kind", F.lower("identity").alias("plain")).distinct()
    columns = ["kind", "identity", "gender", "attempt"]
    drawn = tables.keep(_drawn_for(identities.withColumn("attempt", F.lit(0)), key), "draw0")
    for attempt in range(1, attempts + 1):
        same = F.row_number().over(Window.partitionBy("kind", F.lower("core")).orderBy("attempt", "identity"))
        marked = drawn.withColumn("again", same > 1).withColumn("plain", F.lower("core"))
        marked = marked.join(real.withColumn("is_real", F.lit(True)), ["kind", "plain"], "left")
        again = F.col("again") | F.coalesce("is_real", F.lit(False))
        marked = tables.keep(marked.select(*columns, "core", again.alias("again")), f"marked{attempt}")
        if marked.where("again").isEmpty():
            return marked.select("kind", "identity", "core")
        if attempt == attempts:
            break
        redrawn = _drawn_for(marked.where("again").select("kind", "identity", "gender", (F.col("attempt") + 1).alias("attempt")), key)
        drawn = tables.keep(marked.where("not again").select(*columns, "core").unionByName(redrawn), f"draw{attempt}")
    traded = tables.keep(_traded(marked.where("again").select("kind", "identity"), key), "traded")
    if not traded.where("core = identity").isEmpty():
        raise ValueError("an identity found no distinct surrogate and is alone in its form")
    return tables.keep(marked.where("not again").select("kind", "identity", "core").unionByName(traded), "cores")


def _traded(identities: DataFrame, key: str) -> DataFrame:
    """Each identity gets the value of the next one of its form, in keyed order; the last one gets the first's."""
    form = F.regexp_replace(F.regexp_replace(F.regexp_replace("identity", r"\p{Lu}", "A"), r"\p{Ll}", "a"), r"\p{N}", "0")
    country = F.substr("identity", F.lit(1), F.lit(2))
    right = _mod97(F.concat(F.substr("identity", F.lit(5)), F.substr("identity", F.lit(1), F.lit(4)))) == 1
    checked = F.when(F.col("kind") == "card", (F.pmod(_luhn(F.col("identity")), F.lit(10)) == 0).cast("string"))
    checked = checked.when(F.col("kind") == "iban", F.concat(country, right.cast("string")))
    private = F.regexp_extract("identity", r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\.", 0) != ""
    form = F.when(F.col("kind") == "ip", private.cast("string")).otherwise(form)
    among = Window.partitionBy("kind", form, checked).orderBy(F.sha2(F.concat_ws("\x00", F.lit(key), "identity").cast("binary"), 256))
    everyone = among.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return identities.select("kind", "identity", F.coalesce(F.lead("identity").over(among), F.first("identity").over(everyone)).alias("core"))


def _poured(rest: Column, kind: Column, fixed: Column, core: Column) -> Column:
    """The core in the form of a mention: its fixed part, its separators, its case."""
    slots = _chars(rest)
    letters = F.regexp_replace(core, r"[^\p{L}\p{N}]", "")
    place = lambda i: F.length(F.regexp_replace(F.substr(rest, F.lit(1), i + 1), r"[^\p{L}\p{N}]", ""))
    cased = lambda c, x: F.when(c.rlike(r"^\p{Lu}$"), F.upper(x)).when(c.rlike(r"^\p{Ll}$"), F.lower(x)).otherwise(x)
    filled = F.array_join(F.transform(slots, lambda c, i: F.when(c.rlike(r"^[\p{L}\p{N}]$"), cased(c, F.substr(letters, place(i), F.lit(1)))).otherwise(c)), "")
    return F.concat(fixed, F.when(kind == "ip", core).when(kind == "name", F.initcap(core)).otherwise(filled))


def surrogated(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with every mention in ``text`` replaced, and n_entities, the number of mentions.

    A text without mentions, an empty and a null one stay as they are, with 0. Repeated rows are treated alike; no id is
    needed. A column n_entities of ``docs`` is replaced, all others are kept. Texts that may hold a mention are
    written once with a number each, so it does not matter how later readings are split over tasks.
    """
    tables = Tables(docs.sparkSession, "surrogates")
    docs = docs.select([F.col(f"`{c}`") for c in docs.columns if c.lower() != "n_entities"])
    taken = {c.lower() for c in docs.columns}
    uid, subs = (next(n for i in range(99) if (n := f"{base}{i}") not in taken) for base in ("uid", "subs"))
    touched = tables.keep(docs.where(F.col("text").rlike(HINT)).withColumn(uid, F.monotonically_increasing_id()), "touched")
    plain = docs.where(F.col("text").isNull() | ~F.col("text").rlike(HINT)).withColumn("n_entities", F.lit(0))
    matches = lambda pattern, group: F.regexp_extract_all("text", F.lit(pattern), F.lit(group))
    named = F.col("text").rlike(_NAME)
    with_words = F.zip_with(matches(PATTERN_WITH_WORDS, 0), matches(PATTERN_WITH_WORDS, _WORD_GROUP), lambda m, w: F.struct(m.alias("mention"), w.alias("word")))
    without = F.transform(matches(PATTERN, 0), lambda m: F.struct(m.alias("mention"), F.lit("").alias("word")))
    found = touched.select(F.col(uid).alias("uid"), F.posexplode(F.when(named, with_words).otherwise(without)).alias("pos", "p"))
    found = tables.keep(_described(found.select("uid", "pos", "p.mention", "p.word")), "found")
    names = found.where("kind = 'name'").select("uid", "identity").distinct().withColumn("kind", F.lit("name"))
    words = found.where("kind = 'word'").drop("kind").join(names, ["uid", "identity"], "left")  # no kind: not a name of this text
    sure = found.where("kind <> 'word'")
    cores = surrogate_table(_identities(sure), key, tables)
    known = sure.unionByName(words).join(cores, ["kind", "identity"], "left")
    new = F.when(F.col("core").isNull(), F.col("mention")).otherwise(_poured(F.col("rest"), F.col("kind"), F.col("fixed"), F.col("core")))
    known = known.select(F.col("uid").alias(uid), "pos", F.struct("part", new.alias("new")).alias("sub"), F.col("core").isNotNull().alias("entity"))
    joined = lambda subs_: F.array_join(F.transform(F.array_sort(subs_), lambda s: s["new"]), "")
    known = known.repartition(F.col(uid)).groupBy(uid, "pos").agg(joined(F.collect_list("sub")).alias("new"), F.bool_or("entity").cast("int").alias("entity"))
    known = known.groupBy(uid).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda s: s["new"]).alias(subs), F.sum("entity").cast("int").alias("n_entities"))
    known = tables.keep(known, "replacements")
    between = F.when(named, F.split("text", PATTERN_WITH_WORDS, -1)).otherwise(F.split("text", PATTERN, -1))
    rebuilt = F.array_join(F.transform(between, lambda gap, i: F.concat(gap, F.coalesce(F.get(subs, i), F.lit("")))), "")
    joined = touched.join(known, uid, "left").withColumn("text", F.when(F.col(subs).isNull(), F.col("text")).otherwise(rebuilt))
    joined = joined.withColumn("n_entities", F.coalesce("n_entities", F.lit(0)))
    return joined.select([F.col(f"`{c}`") for c in plain.columns]).union(plain)
