"""Strict JSON and the parsing ladders for model responses.

Values are VARIANT columns: NULL means "does not parse", which differs from a
JSON null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip

# --- fixed values: patterns of the ladders -------------------------------------
FENCE_OPEN = r"(?md)^```json"
FENCE = r"(?md)^```"
OBJECT_TO_END = r"(?s)\{.*\}\z"
OBJECT_GREEDY = r"(?s)\{.*\}"
OBJECT_FIRST = r"(?s)\{.*?\}"
NESTED_ARRAY_TO_END = r"(?Us)\[\s*\[.*\]\s*\]\z"
NESTED_ARRAY = r"(?Us)\[\s*\[.*\]\s*\]"
ARRAY_GREEDY = r"(?s)\[.*\]"
# --- end of fixed values -------------------------------------------------------

# Numbers that a VARIANT shows otherwise than Python, looked for before a text is taken apart.
ODD_NUMBER = r"NaN|Infinity|-0|\d[eE]|\d{8}\.\d|\.\d{9}|\d{38}|0\.000"
STRING_OR_NOT = r'"(?:[^"\\]|\\.)*+"?|[^"]+'
NUMBER_OR_NOT = r"[^\s,:\[\]{}]+|[\s,:\[\]{}]+"
JSON_FLOAT = r"^-?(?:0|[1-9][0-9]*)(?:\.[0-9]+(?:[eE][+-]?[0-9]+)?|[eE][+-]?[0-9]+)\z"
#: Floats that keep their value and look in a VARIANT: few digits, not zero, not below 1e-4.
PLAIN_FLOAT = r"^(?:-?[1-9][0-9]{0,6}\.[0-9]{1,8}|-?0\.(?:[1-9]|0[1-9]|00[1-9]|000[1-9])[0-9]{0,8}|0\.0)\z"
LONG_INTEGER = r"^-?[1-9][0-9]{37,}\z"
#: An array with items, the first of which is no array.
FLAT_ARRAY = r"^\[[ \t\r\n]*[^\[\] \t\r\n]"
#: The same key before a colon twice, strings taken whole.
REPEATED_KEY = r'(?s)"((?:[^"\\]|\\.)*+)"\s*:.*"\1"\s*:'


def variant_items(value: Column) -> Column:
    """Items of a JSON array as array<variant>, NULL for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")


def strict_json(text: Column) -> Column:
    """Parse a whole string as one JSON value; NULL if anything is left over.

    What ``json.loads`` of Python takes is taken: a text with numbers that a
    VARIANT shows otherwise, or that are no JSON, is spelled anew first (see
    ``python_numbers``), and of equal keys of the outermost object the last one counts.
    """
    spelled = lambda s: F.when(s.rlike(ODD_NUMBER), python_numbers(s)).otherwise(s)
    parsed = lambda s: let(spelled(s), lambda t: F.coalesce(_exactly_one(t), _last_keys(t)))
    return let(text, lambda s: F.when(_may_be_json(s), parsed(s)))


def _may_be_json(text: Column) -> Column:
    """Whether the ends of a text may be those of a JSON value; most prose around an answer is told by them, without a parse."""
    bare = F.btrim(text, F.lit(" \t\r\n"))
    first, last = F.left(bare, F.lit(1)), F.right(bare, F.lit(1))
    return (first == "[") & (last == "]") | (first == "{") & (last == "}") | ~first.isin("[", "{", "")


def _exactly_one(text: Column) -> Column:
    """The JSON functions accept trailing text, so the value is put in an array
    in front of a hash of the string: only if both come back, and nothing
    else, was the string exactly one value.
    """

    def guarded(s: Column) -> Column:
        mark = F.xxhash64(s).cast("string")
        wrapped = F.try_parse_json(F.concat(F.lit("["), s, F.lit(',"'), mark, F.lit('"]')))
        return let(
            variant_items(wrapped),
            lambda a: F.when(
                (F.size(a) == 2) & (F.try_variant_get(F.get(a, F.lit(1)), "$", "string") == mark),
                F.get(a, F.lit(0)),
            ),
        )

    return let(text, guarded)


def _last_keys(text: Column) -> Column:
    """An object whose keys repeat, with the last value of each; NULL for anything else."""

    def kept(s: Column) -> Column:
        mark = F.xxhash64(s).cast("string")
        whole = F.from_json(F.concat(F.lit('{"v":'), s, F.lit(',"m":"'), mark, F.lit('"}')), "v map<string,variant>, m string")
        return let(whole, lambda w: F.when(w["m"] == mark, let(F.map_entries(w["v"]), last)))

    def last(entries: Column) -> Column:
        rest = lambda i: F.slice(entries, i + 2, F.size(entries))
        kept = F.filter(entries, lambda e, i: ~F.exists(rest(i), lambda x: x["key"] == e["key"]))
        return F.try_parse_json(F.to_json(F.map_from_entries(kept)))

    # a key before a colon, twice; all other texts are spared the second parse
    return F.when(F.startswith(text, F.lit("{")) & text.rlike(REPEATED_KEY), let(text, kept))


def python_numbers(text: Column) -> Column:
    """JSON text whose odd numbers are replaced by strings of what Python's ``str`` shows for them.

    Odd are ``NaN``, ``Infinity``, a negative zero, exponents, long decimals
    and very small ones; numbers that a VARIANT shows as Python does stay numbers.
    Strings are passed over; what is no number after Python's grammar is left as it is.
    """

    def outside(part: Column) -> Column:
        """A stretch outside strings: its numbers stand between separators."""

        def spelled(token: Column) -> Column:
            special = F.when(token == "NaN", "nan").when(token == "Infinity", "inf").when(token == "-Infinity", "-inf")
            return F.when(special.isNotNull(), F.concat(F.lit('"'), special, F.lit('"'))).when(
                token.rlike(JSON_FLOAT) & ~token.rlike(PLAIN_FLOAT), F.concat(F.lit('"'), python_float(token), F.lit('"'))
            ).when(token.rlike(LONG_INTEGER), F.concat(F.lit('"'), token, F.lit('"'))).otherwise(token)

        return F.array_join(F.transform(F.regexp_extract_all(part, F.lit(NUMBER_OR_NOT), F.lit(0)), spelled), "")

    tokens = F.regexp_extract_all(text, F.lit(STRING_OR_NOT), F.lit(0))
    return F.array_join(F.transform(tokens, lambda t: F.when(F.startswith(t, F.lit('"')), t).otherwise(outside(t))), "")


def python_float(token: Column) -> Column:
    """What Python shows for the double that a number's text stands for: fixed from 1e-4 to below 1e16, else with an exponent."""

    def laid_out(d: Column) -> Column:
        digits, point = d["digits"], d["point"]
        fixed = F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits)).when(
            F.length(digits) <= point, F.concat(digits, F.repeat(F.lit("0"), point - F.length(digits)), F.lit(".0"))
        ).otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, F.length(digits))))
        power = point - 1
        rest = F.when(F.length(digits) > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), F.length(digits)))).otherwise("")
        sized = F.when(F.abs(power) < 10, F.lit("0")).otherwise("")
        wide = F.concat(F.substring(digits, F.lit(1), F.lit(1)), rest, F.when(power < 0, "e-").otherwise("e+"), sized, F.abs(power).cast("string"))
        return F.when((point > -4) & (point <= 16), fixed).otherwise(wide)

    def parts(shown: Column) -> Column:
        """Digits without zeros at either end, and where the point stands before them."""
        mantissa, power = F.substring_index(shown, "E", 1), F.when(F.contains(shown, F.lit("E")), F.substring_index(shown, "E", -1).cast("int")).otherwise(0)
        whole = F.replace(mantissa, F.lit("."), F.lit(""))
        bare = F.regexp_replace(whole, "^0+", "")
        point = F.instr(mantissa, ".") - 1 + power - (F.length(whole) - F.length(bare))
        return F.struct(F.regexp_replace(bare, "0+$", "").alias("digits"), point.cast("int").alias("point"))

    def shortest(x: Column) -> Column:
        """Sixteen digits where they give the same double as what Java shows, and never more than seventeen."""
        java = x.cast("string")
        sixteen, seventeen = (F.regexp_replace(F.format_string(f"%.{n}e", x), "e\\+?", "E") for n in (15, 16))
        digits = lambda t: F.length(F.replace(F.substring_index(t, "E", 1), F.lit("."), F.lit("")))
        return let(java, lambda s: F.when(digits(s) <= 16, s).when(sixteen.cast("double") == x, sixteen).when(digits(s) > 17, seventeen).otherwise(s))

    value = token.try_cast("double")
    sign = F.when(F.startswith(token, F.lit("-")), "-").otherwise("")

    def shown(x: Column) -> Column:
        return F.when(x == 0, F.concat(sign, F.lit("0.0"))).when(F.abs(x) == float("inf"), F.concat(sign, F.lit("inf"))).otherwise(
            F.concat(sign, let(let(F.abs(x), shortest), lambda s: let(parts(s), laid_out)))
        )

    return let(value, shown)


def _first_json(*texts: Column) -> Column:
    """The first of some texts that is one JSON value; later ones are not parsed."""
    return F.aggregate(F.array(*texts), F.lit(None).cast("variant"), lambda found, t: F.coalesce(found, strict_json(t)))


def _part(text: Column, pattern: str) -> Column:
    return F.regexp_extract(text, pattern, 0)


def strip_code_fences(text: Column) -> Column:
    """Remove fence marks at line starts."""
    return F.regexp_replace(F.regexp_replace(text, FENCE_OPEN, ""), FENCE, "")


def parse_object_strict(raw: Column) -> Column:
    """Whole string, object at the end, nested array at the end, first object."""
    return let(strip(raw), lambda s: _first_json(s, _part(s, OBJECT_TO_END), _part(s, NESTED_ARRAY_TO_END), _part(s, OBJECT_FIRST)))


def parse_object_lenient(raw: Column) -> Column:
    """Fences removed, whole string, widest object, else an empty object."""
    found = let(strip_code_fences(strip(raw)), lambda s: _first_json(s, _part(s, OBJECT_GREEDY)))
    return F.coalesce(found, F.try_parse_json(F.lit("{}")))


def parse_array_strict(raw: Column) -> Column:
    """Whole string, else the widest nested array."""
    return let(strip(raw), lambda s: _first_json(s, _part(s, NESTED_ARRAY)))


def _wrapped_once(text: Column) -> Column:
    """The widest array; put in another one if its first item is no array."""
    return let(_part(text, ARRAY_GREEDY), lambda a: F.when(a.rlike(FLAT_ARRAY), F.concat(F.lit("["), a, F.lit("]"))).otherwise(a))


def parse_array_lenient(raw: Column) -> Column:
    """Fences removed, whole string, nested array, widest array (wrapped once if flat), else []."""
    found = let(strip_code_fences(strip(raw)), lambda s: _first_json(s, _part(s, NESTED_ARRAY), _wrapped_once(s)))
    return F.coalesce(found, F.try_parse_json(F.lit("[]")))


def text_of(value: Column) -> Column:
    """Text of a JSON scalar; null, booleans and whole numbers with a point in their usual Python spelling.

    A number written with a point comes as a decimal, without the zeros at
    its end; up to 18 digits only such a number has no decimals left.
    """
    shown = F.try_variant_get(value, "$", "string")
    truth = F.try_variant_get(value, "$", "boolean")
    kind = F.schema_of_variant(value)
    whole = kind.rlike(r"^DECIMAL\(([1-9]|1[0-8]),0\)$")
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.initcap(truth.cast("string"))), F.when(whole, F.concat(shown, F.lit(".0"))), shown, F.lit("None")
    )


def triple_items(value: Column) -> Column:
    """Triple list of a record: array<struct<pos, ok, head, rel, tail>>.

    ``ok`` is false for an item that is no list or has fewer than three parts.
    NULL, JSON null and empty lists give an empty array. Any other value that
    is no list counts as one malformed item, except an error object.
    """

    def item(x: Column, pos: Column) -> Column:
        def shaped(parts: Column) -> Column:
            ok = F.coalesce(F.size(parts) >= 3, F.lit(False))
            part = lambda i: F.when(ok, text_of(F.get(parts, F.lit(i))))
            return F.struct(
                pos.cast("int").alias("pos"), ok.alias("ok"),
                part(0).alias("head"), part(1).alias("rel"), part(2).alias("tail"),
            )

        return let(variant_items(x), shaped)

    kind = "array<struct<pos:int,ok:boolean,head:string,rel:string,tail:string>>"
    none = F.array().cast(kind)
    broken = F.array(F.struct(F.lit(0), F.lit(False), *[F.lit(None).cast("string")] * 3)).cast(kind)
    return F.coalesce(
        F.transform(variant_items(value), item).cast(kind),
        F.when(is_falsy(value) | has_error(value), none),
        broken,
    )


def is_falsy(value: Column) -> Column:
    """NULL, or a JSON null, false, zero, empty string, list or object."""
    return F.coalesce(
        value.isNull() | F.is_variant_null(value) | F.to_json(value).isin("[]", "{}", '""', "false", "0", "0.0"),
        F.lit(True),
    )


def has_error(value: Column) -> Column:
    """Whether the value is an object with the key ``error``, whatever stands there."""
    fields = F.try_variant_get(value, "$", "map<string,variant>")
    return F.coalesce(F.map_contains_key(fields, "error"), F.lit(False))


def relation_items(value: Column) -> Column:
    """Second parts of all list items that have one: array<struct<pos, rel>>."""

    def item(x: Column, pos: Column) -> Column:
        second = lambda parts: F.struct(pos.cast("int").alias("pos"), F.when(F.size(parts) >= 2, text_of(F.get(parts, F.lit(1)))).alias("rel"))
        return let(variant_items(x), second)

    kind = "array<struct<pos:int,rel:string>>"
    items = F.coalesce(F.transform(variant_items(value), item).cast(kind), F.array().cast(kind))
    return F.filter(items, lambda t: t["rel"].isNotNull())


def error_of(value: Column) -> Column:
    """The ``error`` field of an error object, else NULL."""
    return F.try_variant_get(value, "$.error", "string")


def entity_map(value: Column) -> Column:
    """Object of lists as map<string, array<string>>; other fields are dropped."""
    lists = F.transform_values(
        F.try_variant_get(value, "$", "map<string,variant>"),
        lambda k, v: F.transform(variant_items(v), text_of),
    )
    return F.map_filter(lists, lambda k, v: v.isNotNull())


def json_string(s: Column) -> Column:
    """Text as a JSON string, NULL for NULL."""
    return F.when(s.isNotNull(), let(F.to_json(F.array(s)), lambda j: F.substring(j, F.lit(2), F.length(j) - 2)))


def python_json(entities: Column) -> Column:
    """Map of string lists as JSON text with a blank after ',' and ':'."""

    def field(entry: Column) -> Column:
        values = F.array_join(F.transform(entry["value"], json_string), ", ")
        return F.concat(json_string(entry["key"]), F.lit(": ["), values, F.lit("]"))

    return F.concat(F.lit("{"), F.array_join(F.transform(F.map_entries(entities), field), ", "), F.lit("}"))
