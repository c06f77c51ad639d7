"""Personal data replaced by surrogates, in DataFrame operations only.

A detected entity gets a keyed replacement of its type: letters stay letters of the same case and
script, digits stay digits, other signs stay as they are; card numbers stay valid; a name keeps its
title and particles, and a given name gets an ending of its gender. Equal entities, also in other documents, get
equal surrogates, and each word of a name has its own, so ``Ms. Ada Lind`` and ``Ms. Lind`` still meet, and
so do ``Lind``, ``Ada`` or ``LIND`` by themselves anywhere in a document that names her.

Persons are found after a title, by a common given name, or where somebody is introduced; whoever is
mentioned in no such way stays.

All distinct entities of the corpus are drawn together. A surrogate that two entities drew, or that
is itself an entity of the corpus, is drawn again until every one is distinct and new.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.once import with_once
from tidemark.llm.tables import looked_up, numbered, stored

ROUNDS, WIDER_AFTER = 40, 20

# Titles, common given names, and letters, in natural order.
MALE_TITLES = ["Don", "Herr", "Mister", "Monsieur", "Mr", "Señor", "Sir", "Κύριος", "господин"]
FEMALE_TITLES = ["Doña", "Frau", "Madame", "Miss", "Mme", "Mrs", "Ms", "Señora", "Κυρία", "госпожа"]
OTHER_TITLES = ["Dr", "Prof"]
TITLES_AFTER = ["先生", "女士", "小姐", "博士", "教授"]
# Of the titles, those that are taken in capitals, too.
LOUD_TITLES = ["DR", "FRAU", "HERR", "MME", "MR", "MRS", "MS", "PROF", "SEÑOR", "SEÑORA", "ГОСПОДИН", "ГОСПОЖА", "ΚΥΡΙΟΣ", "ΚΥΡΙΑ"]
INTRODUCTIONS = ["full name:", "ich heiße", "je m'appelle", "je m’appelle", "me llamo", "mein name ist", "mi nombre es", "my name is", "меня зовут"]
PARTICLES = ["al", "bin", "da", "de", "del", "den", "der", "di", "dos", "du", "ibn", "la", "van", "von", "zu"]
MALE_NAMES = [
    "Carlos", "Daniel", "David", "Hans", "Ivan", "James", "Jean", "John", "José", "Juan", "Karl", "Klaus",
    "Louis", "Michael", "Michel", "Paul", "Peter", "Pierre", "Robert", "Thomas", "Wolfgang", "Иван", "Сергей",
]
FEMALE_NAMES = [
    "Anna", "Barbara", "Carmen", "Claire", "Elizabeth", "Emily", "Emma", "Helga", "Ingrid", "Isabel", "Jennifer", "Linda",
    "Lucía", "Maria", "Marie", "Mary", "Monika", "Sarah", "Sophie", "Susan", "Ursula", "Анна", "Мария",
]
ALPHABETS = {
    "digit": "0123456789",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "accented lower": "àáâãäåçèéêëìíîïñòóôõöùúûüý",
    "accented upper": "ÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖÙÚÛÜÝ",
    "Cyrillic lower": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "Cyrillic upper": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "Greek lower": "αβγδεζηθικλμνξοπρστυφχψω",
    "Greek upper": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
}
VOWELS = {"Latin": "aeiou", "Cyrillic": "аеиоу", "Greek": "αειου"}
CONSONANTS = {"Latin": "bdfgklmnprstv", "Cyrillic": "бвгдклмнпрстф", "Greek": "βγδκλμνπρστφ"}
ENDINGS = {
    "Latin": {"male": "n", "female": "a"},
    "Cyrillic": {"male": "н", "female": "а"},
    "Greek": {"male": "ς", "female": "α"},
}
#: A block of Chinese characters, of which names in them are drawn.
HAN = "".join(chr(code) for code in range(0x5E00, 0x5F00))

_TITLES = "|".join(MALE_TITLES + FEMALE_TITLES + OTHER_TITLES)
_GIVEN = "|".join(MALE_NAMES + FEMALE_NAMES)
# A word of a name: Lind, O'Brien, McDonald, Anne-Marie; in capitals; in Chinese characters the whole name.
_WORD = r"\p{Lu}(?:['’]\p{Lu})?\p{Ll}+(?:['’]\p{Lu}\p{Ll}+|-\p{Lu}?\p{Ll}+|\p{Lu}\p{Ll}+)*+"
_LOUD = r"\p{Lu}(?:['’]?\p{Lu})+(?:-\p{Lu}{2,})*+(?!\p{Ll})"
_HAN = r"\p{IsHan}{2,4}"
_PARTICLE = rf"(?:(?:{'|'.join(PARTICLES)}) ){{0,2}}"
_NAME = rf"{_WORD}(?: {_PARTICLE}{_WORD}){{0,2}}"
_TITLE = rf"(?:{_TITLES}|{'|'.join(LOUD_TITLES)})\.?(?: |(?=\p{{IsHan}}))"
_PERSONS = [
    rf"{_TITLE}(?:{_PARTICLE}{_NAME}|{_LOUD}(?: {_LOUD}){{0,2}}|{_HAN})",
    rf"(?:{_GIVEN}) {_PARTICLE}{_WORD}",
    rf"(?={_WORD} )(?<=(?i:{'|'.join(INTRODUCTIONS)}) ){_WORD}(?: {_PARTICLE}{_WORD}){{1,2}}",
]
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
_CARD = r"(?<!\d)(?:\d{4}(?:\d{12}|(?: \d{4}){3}|(?:-\d{4}){3})|3[47]\d{2}(?:\d{11}| \d{6} \d{5}|-\d{6}-\d{5}))(?!\d)"
_NUMBER = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
# What stands between the name of a secret and the secret, and the secrets that follow the one name or the other.
_IS = r"[\"']?\s{0,4}(?::=|=>|==|[:=])\s{0,4}[\"']?"
_PASSWORD = rf"(?<=(?i:password|passwd|pwd){_IS})(?=[^\s\"']*[\p{{L}}\p{{N}}])[^\s\"']{{6,}}"
_TOKEN = rf"(?<=(?i:api[ _-]?key|access[ _-]?key|secret(?:[ _-]?key)?|token){_IS})(?:[0-9A-Za-z][\w+/.~-]{{14,}}[0-9A-Za-z]|(?=[\w+/.~-]*\d)[\w+/.~-]{{8,}})"
_KEYED = rf"(?<=[\s\"':=>])(?=[^\s\"'])(?<=[:=>][\s\"']{{0,5}})(?:{_PASSWORD}|{_TOKEN})"
# Phone numbers: of North America, with or without +1; with a country's code, up to what is an entity of its own; with a leading 0.
_PHONES = [
    r"(?:\+?\d{1,3}[ .-]?)?\(\d{3}\)[ -]?\d{3}[ .-]?\d{4}(?!\d)",
    r"\+1[ .-]?\d{3}[ .-]?\d{3}[ .-]?\d{4}(?!\d)",
    rf"\+\d{{1,3}}[ -]?(?:\(\d{{1,4}}\)[ -]?)?\d{{2,4}}(?:[ -]?(?!{_IP}|{_CARD}(?! \d{{4}}(?!\d))|{_NUMBER})\d{{2,4}}){{1,4}}(?!\d|\.\d)",
    r"(?:1[.-])?[2-9]\d{2}[.-][2-9]\d{2}[.-]\d{4}(?!\d|[.-]\d)",
    r"(?<!\d )[2-9]\d{2} [2-9]\d{2}[ -]\d{4}(?!\d|[ .-]\d)",
    r"(?=(?:[ ()/-]{0,2}\d){9,12}(?!\d))(?:\(0\d{1,4}\) ?|0\d{1,4}[ /-])\d{2,8}(?:[ -]\d{2,4}){0,4}(?![ -]?\d|\.\d)",
]
_HEX = "[0-9A-Fa-f]{1,4}"
_IPV6 = (
    rf"(?<![\w:.])(?=[0-9A-Fa-f]{{0,4}}:)(?:(?:{_HEX}:){{7}}{_HEX}|(?!(?:[0-9A-Fa-f]*:){{9}})"
    rf"(?=[0-9A-Fa-f:]*\d|(?:[0-9A-Fa-f]+:+){{2}}[0-9A-Fa-f])(?:{_HEX}(?::{_HEX}){{0,6}})?::(?:{_HEX}(?::{_HEX}){{0,6}})?)(?![\w:]|\.\d)"
)
#: What each type looks like, tried in this order.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}_.%+-])[\p{L}\p{N}_.%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+",
    "secret": rf"(?<![A-Za-z0-9])(?i:AKIA[0-9A-Z]{{16}})(?![A-Za-z0-9])|{_KEYED}",
    "ip": _IP,
    "ipv6": _IPV6,
    "phone": rf"(?<![\d+])(?<!\d[.-])(?=[+(\d])(?:{'|'.join(_PHONES)})",
    "iban": r"(?<![A-Za-z0-9])(?=[A-Z]{2}(?:[A-Z ]{0,8}\d){10})[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "card": _CARD,
    "number": _NUMBER,
    "person": rf"(?<!\p{{L}})(?=\p{{Lu}}|г)(?:{'|'.join(_PERSONS)})|(?<!\p{{IsHan}})\p{{IsHan}}{{2,3}}(?={'|'.join(TITLES_AFTER)})",
}
#: Names that only their surroundings tell, by themselves.
BARE_NAME = rf"{_WORD}(?: {_PARTICLE}{_WORD}){{1,2}}|{_HAN}"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A text without any of these can hold names only.
SIGNS = "[0-9@=]|:[0-9A-Fa-f:]|(?i:AKIA|api.?key|access.?key|secret|token|passw|pwd)"


def _entities(text: Column) -> Column:
    some = F.regexp_like(text, F.lit(SIGNS))
    return F.when(some, F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).otherwise(
        F.regexp_extract_all(text, F.lit(PATTERNS["person"]), F.lit(0))
    )


def _type(entity: Column) -> Column:
    """The type of a detected entity; the secrets that only their surroundings tell are what is left."""
    found = F.when(F.regexp_like(entity, F.lit(f"^(?:{BARE_NAME})$")), "person").otherwise(F.lit("secret"))
    for name in reversed([p for p in PATTERNS if p != "secret"]):
        found = F.when(F.regexp_like(entity, F.lit(f"^(?:{PATTERNS[name]})$")), name).otherwise(found)
    return found


def _plain(word: Column) -> Column:
    """A word of a name as it is when not in capitals."""
    return F.when(_loud(word), F.initcap(word)).otherwise(word)


def _loud(word: Column) -> Column:
    return (F.length(word) > 1) & (word == F.upper(word)) & (word != F.lower(word))


def _title(person: Column) -> Column:
    return F.regexp_extract(person, f"^({_TITLE})", 1)


def _words(person: Column) -> Column:
    """kind, entity (the word, not in capitals) and is_loud of each word of a name, without its title."""
    title = _title(person)
    bare = F.upper(F.regexp_replace(title, r"\.? ?$", ""))
    gender = F.when(bare.isin([t.upper() for t in MALE_TITLES]), "male").when(bare.isin([t.upper() for t in FEMALE_TITLES]), "female")
    words = F.split(F.substring(person, F.length(title) + 1, F.length(person)), " ")

    def one(word: Column, i: Column) -> Column:
        given = F.when(_plain(word).isin(MALE_NAMES), "male").when(_plain(word).isin(FEMALE_NAMES), "female")
        leads = (i == 0) & (F.size(words) > 1)
        kind = F.when(word.isin(PARTICLES), PARTICLE).when(leads, F.coalesce(given, gender, F.lit("surname"))).otherwise("surname")
        return F.struct(kind.alias("kind"), _plain(word).alias("entity"), _loud(word).alias("is_loud"))

    return F.transform(words, one)


PARTICLE = "particle"
#: Marks a word of a name that stands by itself; its kind and the word follow. No text that the patterns find begins with it.
MENTION = "\0"


def _with_mentions(texts: DataFrame, text: str) -> DataFrame:
    """Add ``_found``, the entities of each text in order, and ``_pattern``, what finds them if ``ANY`` alone does not.

    Where a text names persons, the words of their names are entities there, too, tagged with the kind
    that the first name with the word gives it. All other texts are searched once.
    """
    first = with_once(texts, "_first", _entities(F.col(text)))
    persons = F.filter("_first", lambda e: F.regexp_like(e, F.lit(f"^(?:{PATTERNS['person']}|{BARE_NAME})$")) & (_type(e) == "person"))
    named = F.filter(F.flatten(F.transform(persons, _words)), lambda w: w["kind"] != PARTICLE)
    named = with_once(first, "_named", F.when(F.size("_first") > 0, F.array_distinct(named)))
    forms = F.array_distinct(F.flatten(F.transform("_named", lambda w: F.array(w["entity"], F.upper(w["entity"])))))
    # Longer forms first, so that Anne does not hide Anne-Marie.
    forms = F.transform(F.reverse(F.array_sort(F.transform(forms, lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))))), lambda x: x["w"])
    formed = with_once(named, "_forms", F.when(F.size("_named") > 0, forms))
    alone = F.transform("_forms", lambda w: F.when(F.regexp_like(w, F.lit(r"^\p{IsHan}")), w).otherwise(F.concat(F.lit(r"(?<![\p{L}\p{N}])"), w, F.lit(r"(?![\p{L}\p{N}])"))))
    pattern = F.concat(F.lit(f"{ANY}|"), F.array_join(alone, "|"))
    searched = with_once(formed, "_pattern", F.when(F.col("_forms").isNotNull(), pattern))

    def tagged(entity: Column) -> Column:
        kind = F.get(F.filter("_named", lambda w: w["entity"] == _plain(entity)), F.lit(0))["kind"]
        is_alone = F.array_contains("_forms", entity) & ~F.array_contains("_first", entity)
        return F.when(is_alone, F.concat(F.lit(MENTION), kind, F.lit(MENTION), entity)).otherwise(entity)

    again = F.transform(F.regexp_extract_all(F.col(text), F.col("_pattern"), F.lit(0)), tagged)
    found = with_once(searched, "_found", F.when(F.col("_pattern").isNull(), F.col("_first")).otherwise(again))
    return found.drop("_first", "_named", "_forms")


def _byte(at: Column | int) -> Column:
    """A byte of the hexadecimal column ``digest``, which repeats."""
    place = F.pmod(F.lit(at) if isinstance(at, int) else at, F.lit(64)) * 2 + 1
    return F.conv(F.substring(F.col("digest"), place, F.lit(2)), 16, 10).cast("int")


def _letter(alphabet: str, number: Column) -> Column:
    return F.substring(F.lit(alphabet), F.pmod(number, F.lit(len(alphabet))) + 1, F.lit(1))


def _masked(text: Column) -> Column:
    """Each letter or digit replaced by another of its alphabet, everything else kept."""

    def one(c: Column, i: Column) -> Column:
        found = c
        for alphabet in ALPHABETS.values():
            found = F.when(F.instr(F.lit(alphabet), c) > 0, _letter(alphabet, _byte(i))).otherwise(found)
        return found

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _luhn(digits: Column, size: Column) -> Column:
    """Sum of the digits of a number of ``size`` digits, or its first ones: every second from its last but one backwards is doubled."""
    twice = F.transform(F.split(digits, ""), lambda c, i: c.cast("int") * F.when((i + size) % 2 == 0, 2).otherwise(1))
    return F.aggregate(twice, F.lit(0), lambda total, x: total + F.when(x > 9, x - 9).otherwise(x))


def _card() -> Column:
    """Another number with the same first digit and layout; valid if the old one is."""
    entity = F.col("entity")
    size = F.length(entity)
    drawn = F.concat(F.substring(entity, F.lit(1), F.lit(1)), F.substring(F.col("masked"), F.lit(2), size - 2))
    digits = F.regexp_replace(drawn, "[^0-9]", "")
    whole = F.regexp_replace(entity, "[^0-9]", "")
    valid = _luhn(whole, F.length(whole)) % 10 == 0
    check = F.when(valid, F.pmod(F.lit(10) - _luhn(digits, F.length(whole)) % 10, F.lit(10)).cast("string"))
    return F.concat(drawn, F.coalesce(check, F.substring(F.col("masked"), size, F.lit(1))))


def _invented(script: str, ending: str | None) -> Column:
    """A word of two syllables and an ending, which for a surname is drawn, too."""
    first = F.upper(_letter(CONSONANTS[script], _byte(0)))
    parts = [first, _letter(VOWELS[script], _byte(1))]
    for i in (2, 4, 6):
        parts += [_letter(CONSONANTS[script], _byte(i)), _letter(VOWELS[script], _byte(i + 1))]
    return F.concat(*parts, F.lit(ENDINGS[script][ending]) if ending else _letter(CONSONANTS[script], _byte(8)))


def _drawn() -> Column:
    """The surrogate that the columns kind, entity, masked and digest make."""

    def word(script: str) -> Column:
        found = F.when(F.col("kind") == "male", _invented(script, "male")).when(F.col("kind") == "female", _invented(script, "female"))
        return found.otherwise(_invented(script, None))

    han = F.array_join(F.transform(F.split("entity", ""), lambda c, i: _letter(HAN, _byte(i))), "")
    name = F.when(F.regexp_like("entity", F.lit(r"^\p{IsHan}")), han).otherwise(word("Latin"))
    for script in ("Cyrillic", "Greek"):
        name = F.when(F.regexp_like("entity", F.lit(rf"^\p{{Is{script}}}")), word(script)).otherwise(name)
    octets = F.concat_ws(".", *((_byte(i) % 254 + 1).cast("string") for i in range(4)))
    groups = F.concat_ws(":", *(F.substring(F.col("digest"), F.lit(4 * i + 1), F.lit(4)) for i in range(8)))
    found = F.when(F.col("kind") == "ip", octets).when(F.col("kind") == "ipv6", groups).when(F.col("kind") == "card", _card())
    found = found.when(F.col("kind").isin("male", "female", "surname"), name)
    prefix = F.when(F.col("kind") == "secret", F.regexp_extract("entity", "^((?i)AKIA)", 1))
    prefix = prefix.when(F.col("kind") == "iban", F.substring("entity", 1, 2))
    prefix = prefix.when(F.col("kind") == "phone", F.regexp_extract("entity", r"^(\+\d{1,3})[ -(]", 1)).otherwise(F.lit(""))
    kept = F.concat(prefix, F.substring(F.col("masked"), F.length(prefix) + 1, F.length("masked")))
    is_hex = (F.col("kind") == "secret") & F.regexp_like("entity", F.lit("^[0-9a-f]{1,128}$"))
    # Of a secret with few letters and digits nothing is kept: there would be too few surrogates.
    few = (F.col("kind") == "secret") & (F.length(F.regexp_replace("entity", "[^0-9A-Za-z]", "")) < 6)
    digits = F.substring(F.col("digest"), F.lit(1), F.length("entity"))
    is_upper = (F.col("kind") == "secret") & F.regexp_like("entity", F.lit("^[0-9A-F]{1,128}$"))
    found = found.when(is_hex | few, digits).when(is_upper, F.upper(digits))
    return found.when(F.col("kind") == "email", _mail()).otherwise(kept)


def _mail() -> Column:
    """All but the last label of the address is drawn."""
    last = F.regexp_extract("entity", r"(\.[\p{L}\p{N}-]+)$", 1)
    return F.concat(F.substring(F.col("masked"), F.lit(1), F.length("entity") - F.length(last)), last)


def _draw(names: DataFrame, key: str) -> DataFrame:
    """kind, entity, attempt and the surrogate of that attempt."""
    digest = F.sha2(F.concat_ws("\0", F.lit(key), F.col("kind"), F.col("entity"), F.col("attempt").cast("string")), 512)
    drawn = names.select("kind", "entity", "attempt", digest.alias("digest"))
    drawn = drawn.withColumn("masked", _masked(F.col("entity")))
    more = F.translate(F.substring("digest", 101, 4), "abcdef", "012345")
    surrogate = F.concat(F.when(F.col("attempt") >= WIDER_AFTER, more).otherwise(F.lit("")), _drawn())
    return drawn.select("kind", "entity", "attempt", surrogate.alias("surrogate"))


def surrogates(names: DataFrame, key: str) -> DataFrame:
    """kind, entity, surrogate for every distinct kind and entity: no surrogate is shared, and none is an entity.

    Of those that drew the same, the first by attempt and entity keeps it. An entity whose form has too few
    surrogates gets one with four digits more in front after ``WIDER_AFTER`` attempts; should these be too few, it ends in an error.
    """
    taken = stored(names.select("kind", "entity").distinct(), "entities")
    known = taken.select(F.col("entity").alias("surrogate")).distinct().withColumn("is_real", F.lit(True))
    drawn = stored(_draw(taken.withColumn("attempt", F.lit(0)), key), "surrogates")
    for _ in range(ROUNDS):
        # One row for each surrogate that clashes: the one that may keep it.
        order = F.struct("attempt", "kind", "entity")
        groups = drawn.groupBy("surrogate").agg(F.min(order).alias("keeper"), F.count(F.lit(1)).alias("n"))
        clashes = groups.join(known, "surrogate", "left").where("n > 1 or is_real")
        clashes = stored(clashes.select("surrogate", F.when(F.col("is_real").isNull(), F.col("keeper")).alias("keeper")), "clashes")
        if not clashes.limit(1).count():
            return drawn.select("kind", "entity", "surrogate")
        marked = drawn.join(clashes.withColumn("clash", F.lit(True)), "surrogate", "left")
        again = F.col("clash").isNotNull() & (F.col("keeper").isNull() | (F.col("keeper") != order))
        marked = stored(marked.select("kind", "entity", "attempt", "surrogate", again.alias("again")), "marked")
        redrawn = _draw(marked.where("again").select("kind", "entity", (F.col("attempt") + 1).alias("attempt")), key)
        drawn = stored(marked.where("not again").select("kind", "entity", "attempt", "surrogate").union(redrawn), "surrogates")
    raise RuntimeError("too few surrogates for the entities of one form")


def _parts(found: DataFrame) -> DataFrame:
    """Every distinct entity: its title, and what is drawn for it: itself, or the words of a name, with their kinds."""
    is_mention = F.col("entity").startswith(MENTION)
    typed = found.withColumn("type", F.when(is_mention, "mention").otherwise(_type(F.col("entity"))))
    tag = F.split("entity", MENTION)
    mention = F.struct(tag[1].alias("kind"), _plain(tag[2]).alias("entity"), _loud(tag[2]).alias("is_loud"))
    itself = F.struct(F.col("type").alias("kind"), F.col("entity"), F.lit(False).alias("is_loud"))
    parts = F.when(is_mention, F.array(mention)).when(F.col("type") == "person", _words(F.col("entity"))).otherwise(F.array(itself))
    title = F.when(F.col("type") == "person", _title(F.col("entity"))).otherwise(F.lit(""))
    return typed.select("entity", title.alias("title"), parts.alias("parts"))


@dataclass
class Replaced:
    """``documents``: the rows with their texts replaced, and n_entities. ``surrogates``: kind, entity, surrogate."""

    documents: DataFrame
    surrogates: DataFrame


def replace_entities(docs: DataFrame, key: str) -> Replaced:
    """Replace all detected entities in ``docs`` (text and any other columns) by surrogates drawn with ``key``.

    The same key and corpus give the same surrogates. A null text stays null, with no entities, and an
    empty one empty; every row comes out, repeated ones alike; an empty table gives an empty one. A
    column named n_entities is replaced; others may have any names.
    """
    docs = docs.drop("n_entities") if "n_entities" in docs.columns else docs
    plain, text = numbered(docs, "text")
    keyed = _with_mentions(plain.withColumn("_text", F.xxhash64(text)), text)
    listed = keyed.where(F.size("_found") > 0).select("_text", F.explode(F.array_distinct("_found")).alias("entity"))
    listed = stored(listed.distinct(), "text-entities")
    cut = stored(_parts(listed.select("entity").distinct()), "entity-parts")
    placed = cut.select(F.col("entity").alias("whole"), "title", F.posexplode("parts").alias("i", "part"))
    placed = placed.select("whole", "title", "i", "part.*")
    drawn = surrogates(placed.where(F.col("kind") != PARTICLE).select("kind", "entity"), key)
    joined = placed.join(drawn, ["kind", "entity"], "left")
    word = F.coalesce(F.when(F.col("is_loud"), F.upper("surrogate")).otherwise(F.col("surrogate")), F.col("entity"))
    words = joined.groupBy("whole", "title").agg(F.sort_array(F.collect_list(F.struct("i", word.alias("word")))).alias("words"))
    whole = words.select(F.col("whole").alias("entity"), F.concat("title", F.array_join(F.col("words.word"), " ")).alias("surrogate"))
    by_text = looked_up(listed, stored(whole, "entity-surrogates"), "entity", "left").groupBy("_text")
    by_text = by_text.agg(F.map_from_entries(F.collect_list(F.struct("entity", "surrogate"))).alias("_map"))
    found = looked_up(keyed, stored(by_text, "text-surrogates"), "_text", "left")
    gaps = F.when(F.col("_pattern").isNull(), F.split(text, ANY, -1)).otherwise(F.split(F.col(text), F.col("_pattern"), -1))
    pieces = F.transform(gaps, lambda gap, i: F.concat(F.when(i > 0, F.col("_map")[F.get("_found", i - 1)]).otherwise(F.lit("")), gap))
    replaced = F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(F.col(text))
    n = F.when(F.col(text).isNull(), 0).otherwise(F.size("_found")).cast("long")
    columns = [replaced if f"c{i}" == text else F.col(f"c{i}") for i in range(len(docs.columns))]
    return Replaced(found.select(*[c.alias(f"c{i}") for i, c in enumerate([*columns, n])]).toDF(*docs.columns, "n_entities"), drawn)
