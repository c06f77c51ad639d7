"""JSON text in and out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.json_spans import all_elements, members, value_of, whole

BROKEN = "_broken"
_READ = {"mode": "PERMISSIVE", "allowUnquotedFieldNames": "true"}
_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"' + "|" + r"'[^'\\]*+(?:\\.[^'\\]*+)*+'"
_NUMBER = r"(?<![\w$.+-])-?\d+(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w$.])"


def read_fields(text: Column | str, fields: str) -> Column:
    """Struct of ``fields`` (DDL) plus ``_broken``, which holds the text unless the whole of it is one object.

    Only the named fields are read, and the last of a repeated one; single quotes and bare field
    names are accepted. The text is read as the first of two elements of an array, so that whatever
    follows the object, up to the mark at the end, is noticed.
    """
    text = F.col(text) if isinstance(text, str) else text
    found = F.from_json(F.concat(F.lit("["), text, F.lit(",{}]")), f"array<struct<{fields}>>", _READ)
    # Bound by a lambda, the parsed array is worked out once.
    whole = F.transform(F.array(found), lambda two: F.when((F.size(two) == 2) & two[0].isNotNull(), two[0]))[0]
    return F.transform(F.array(whole), lambda one: one.withField(BROKEN, F.lit(None).cast("string")))[0]


def is_broken(parsed: str) -> Column:
    return F.col(parsed).isNull() | F.col(f"{parsed}.{BROKEN}").isNotNull()


def read_object(text: Column | str, fields: str) -> Column:
    """Struct of ``fields`` plus ``_broken``, which holds a text that is no object or whose fields have other types."""
    options = {**_READ, "columnNameOfCorruptRecord": BROKEN}
    return F.from_json(text, f"{fields}, {BROKEN} string", options)


#: Names of the members around a text that ``read_flat`` reads, and what a text holds that might name them itself.
_TEXTS, _END = "tidemark_texts", "tidemark_end"
_NAMED = ("tidemark_", r"\u")
#: Fields whose values come out the same whether an element is read in place or from its own text.
_FLAT = (T.StringType, T.DoubleType, T.LongType, T.IntegerType, T.BooleanType)


def read_flat(text: Column | str, fields: str, name: str, of: str) -> Column:
    """Struct of ``fields`` and ``name``, an array of structs of the fields ``of``: all of an object in one reading.

    Null unless the text is surely one object, with nothing after it, and each element of the array an object without a field
    of another type, so that ``read_fields`` and ``read_object`` would find the same. They must read the others.
    """
    text = F.col(text) if isinstance(text, str) else text
    kinds = T.StructType.fromDDL(of).fields
    if not all(isinstance(kind.dataType, _FLAT) for kind in kinds):
        return F.lit(None).cast(f"struct<{fields}, {name} array<struct<{of}>>>")
    around = F.concat(F.lit(f'{{"{_TEXTS}":['), text, F.lit(f',{{}}],"{_END}":true}}'))
    schema = f"{_TEXTS} array<struct<{fields}, {name} array<struct<{of}>>>>, {_END} boolean, {BROKEN} string"
    found = F.from_json(around, schema, {**_READ, "columnNameOfCorruptRecord": BROKEN})
    # A bare number that no double holds becomes a word, in quotes only where it is read in place.
    quoted = [kind.name for kind in kinds if isinstance(kind.dataType, T.StringType)]

    def odd(element: Column) -> Column:
        return reduce(Column.__or__, [F.coalesce(F.startswith(element[n], F.lit('"')), F.lit(False)) for n in quoted], element.isNull())

    def sure(read: Column) -> Column:
        ended = read[BROKEN].isNull() & F.coalesce(read[_END], F.lit(False)) & (F.size(read[_TEXTS]) == 2)
        return F.when(ended & ~F.coalesce(F.exists(read[_TEXTS][0][name], odd), F.lit(True)), read[_TEXTS][0])

    unnamed = reduce(Column.__and__, [~F.contains(text, F.lit(part)) for part in _NAMED])
    # Bound by a lambda, the parsed struct is worked out once.
    return F.when(unnamed, F.transform(F.array(found), sure)[0])


def _marks(text: Column) -> tuple[Column, Column]:
    """What stands around a number that is kept as text: a hash of the whole text, which the text doesn't hold."""
    own = F.hex(F.xxhash64(text))
    return F.concat(F.lit("\ue000"), own, F.lit(":")), F.concat(F.lit(":"), own, F.lit("\ue001"))


def _marked(text: Column) -> Column:
    """The same JSON with every number in marked quotes, so that parsing leaves its text as it is."""
    opening, closing = _marks(text)
    marked = F.regexp_replace(text, F.lit(f"(?s)({_STRING})|({_NUMBER})"), F.concat(F.lit("$1"), opening, F.lit("$2"), closing))
    marked = F.replace(marked, F.concat(opening, closing), F.lit(""))
    return F.replace(F.replace(marked, opening, F.concat(F.lit('"'), opening)), closing, F.concat(closing, F.lit('"')))


def _unmarked(text: Column, whole_text: Column) -> Column:
    opening, closing = _marks(whole_text)
    return F.replace(F.replace(text, F.concat(F.lit('"'), opening), F.lit("")), F.concat(closing, F.lit('"')), F.lit(""))


def last_member(spans: Column, name: str) -> Column:
    """The text of the last member called ``name``, null if there is none; ``name`` needs no escapes."""
    return value_of(F.get(F.reverse(F.filter(spans, lambda span: F.regexp_like(span, F.lit(rf'\A\s*+[{{,]\s*+"{name}"\s*+:')))), F.lit(0)))


def plain_members(text: Column, spans: Column) -> Column:
    """Whether ``spans`` are all members of the object ``text``, and none of their names has an escape."""
    escaped = F.exists(spans, lambda span: F.regexp_like(span, F.lit(r'\A\s*+[{,]\s*+"[^"\\]*+\\')))
    return whole(text, spans, "{", "}") & ~escaped


def elements(text: Column, spans: Column, name: str) -> Column:
    """The elements of the array that the object ``text`` calls ``name``, each as it is written; null if it has no such array.

    ``spans`` are the object's members. A null element is null, a string is what it says. A text that isn't strict JSON, with
    single quotes or bare names, or is nested deeper than a hundred levels, is written anew, but for
    its numbers.
    """

    def one(item: Column) -> Column:
        decoded = F.from_json(F.concat(F.lit("["), item, F.lit("]")), "array<string>")[0]
        return F.when(F.startswith(item, F.lit('"')), decoded).when(item != "null", item)

    def of(all_of: Column) -> Column:
        good, array, found = all_of["good"], all_of["array"], all_of["found"]
        nothing = F.when(good & ~F.coalesce(F.startswith(array, F.lit("[")), F.lit(False)), True)
        n = F.size(found) - 1
        spelt = F.transform(F.slice(found, F.lit(1), n), one)
        return F.when(nothing, None).when(good & (n >= 0) & (F.get(found, n) == "]"), spelt).otherwise(_rewritten(text, name))

    # Bound by a lambda each, the test and the array's text are worked out once.
    bound = F.struct(plain_members(text, spans).alias("good"), last_member(spans, name).alias("array"))
    split = F.transform(F.array(bound), lambda own: own.withField("found", F.when(own["good"], all_elements(own["array"]))))
    return F.transform(split, of)[0]


def _rewritten(text: Column, name: str) -> Column:
    found = F.from_json(_marked(text), f"{name} array<string>", _READ)[name]
    return F.transform(found, lambda item: _unmarked(item, text))


def put_fields(text: Column, new: dict[str, Column]) -> Column:
    """The JSON object ``text`` with string fields set or overwritten; null if it is no object.

    Top-level null fields are left out, and of fields with one name all but the last. All else stays as
    it is written: the new fields are put before the closing brace, after members that go are cut out.
    Only an object nested deeper than a hundred levels is taken apart and written anew.
    """
    names = F.json_object_keys(text)
    added = F.to_json(F.struct(*[value.cast("string").alias(name) for name, value in new.items()]))
    comma = F.when(F.size(names) > 0, ",").otherwise("")
    spliced = F.concat(F.substring(text, F.lit(1), F.length(text) - 1), comma, F.substring(added, F.lit(2), F.length(added)))
    spliced = F.when(added == "{}", text).otherwise(spliced)
    simple = ~F.contains(text, F.lit("null")) & ~F.arrays_overlap(names, F.array(*map(F.lit, new)))
    simple = simple & (F.size(F.array_distinct(names)) == F.size(names)) & F.endswith(text, F.lit("}"))

    def cut(own: Column) -> Column:
        found, kinds, put, n = own["found"], own["names"], own["added"], F.size(own["names"])
        kept = F.filter(
            F.slice(found, F.lit(1), n),
            lambda member, i: _stays(member, F.get(kinds, i), new) & (own["distinct"] | ~F.array_contains(F.slice(kinds, i + 2, n), F.get(kinds, i))),
        )
        joined = F.concat_ws(",", kept, F.nullif(F.substring(put, F.lit(2), F.length(put) - 2), F.lit("")))
        aligned = (F.size(found) == n + 1) & (F.get(found, n) == "}")
        return F.when(aligned, F.concat(F.lit("{"), joined, F.lit("}"))).otherwise(_rebuilt(text, new))

    # Bound by a lambda, what all members need is worked out once.
    bound = F.array(F.struct(members(text).alias("found"), names.alias("names"), added.alias("added")))
    counted = F.transform(bound, lambda own: own.withField("distinct", F.size(F.array_distinct(own["names"])) == F.size(own["names"])))
    return F.when(names.isNull(), None).when(simple, spliced).otherwise(F.transform(counted, cut)[0])


def _stays(member: Column, name: Column, new: dict[str, Column]) -> Column:
    """Whether a member is neither overwritten nor null."""
    return ~name.isin(*new) & ~F.endswith(member, F.lit("null"))


def _rebuilt(text: Column, new: dict[str, Column]) -> Column:
    own = [F.struct(F.lit(name).alias("key"), value.cast("string").cast("variant").alias("value")) for name, value in new.items()]

    def build(fields: Column) -> Column:
        names = F.map_keys(fields)
        last = F.filter(F.map_entries(fields), lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]))
        # A string cast to variant is a plain SQL null when the string is null, hence both tests.
        kept = F.filter(last, lambda e: e["value"].isNotNull() & ~F.is_variant_null(e["value"]) & ~e["key"].isin(*new))
        return F.to_json(F.map_from_entries(F.concat(kept, F.filter(F.array(*own), lambda e: e["value"].isNotNull()))))

    # Bound by a lambda, the fields are parsed once.
    return F.transform(F.array(F.from_json(text, "map<string,variant>")), build)[0]
