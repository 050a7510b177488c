"""JSON record predicates and JSON value comparison.

A parser stops at the end of the first value and overlooks what comes after it. So a text
is parsed as the first item of a list that ends in a mark of this process, which no text
knows: the mark comes out as the second and last item only if the text is one whole value.
"""

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

from tierline.schemas import REQUIRED_KEYS

MARK = uuid.uuid4().hex

# A number that Variant would hold as a double (it has an exponent, or may have over 38
# digits), outside of strings, in which the same letters mean nothing.
_INEXACT_NUMBER = r"[0-9][eE][+-]?[0-9]|[0-9.]{38}"
_STRING = r'"(?:\\.|[^"\\])*+"'
# Only numbers JSON allows, as a whole: what looks like another stays as it is.
_NUMBER = r"(?<![0-9.eE+-])-?(?:0|[1-9][0-9]*)(?:\.[0-9]+)?(?:[eE][+-]?[0-9]+)?(?![0-9.eE+-])"


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once however often it is used."""
    return F.transform(F.array(value), use)[0]


def followed_by_mark(text: Column, mark: str) -> Column:
    """The text as the first item of a list, the mark (JSON) behind it."""
    return F.concat(F.lit("["), text, F.lit(f",{mark}]"))


def _object(payload: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of the payload as a map of its top-level keys to texts, which is null unless
    it is one JSON object and nothing else. Parsed once."""
    parsed = F.from_json(followed_by_mark(payload, f'{{"{MARK}":null}}'), "array<map<string,string>>")

    def whole(items: Column) -> Column:
        complete = (F.size(items) == 2) & F.map_contains_key(F.get(items, F.lit(1)), F.lit(MARK))
        return F.when(complete, F.get(items, F.lit(0)))

    return bound(bound(parsed, whole), use)


def _missing(record: Column, keys: Sequence[str]) -> Column:
    return F.when(record.isNotNull(), F.array_except(F.array(*[F.lit(k) for k in keys]), F.map_keys(record)))


def _last(record: Column, key: str) -> Column:
    """A value; of a repeated key the last one, as a JSON parser has it."""
    named = F.filter(F.map_entries(record), lambda e: e["key"] == key)
    return F.get(named, F.size(named) - 1)["value"]


def missing_keys(payload: Column, keys: Sequence[str] = REQUIRED_KEYS) -> Column:
    """Required keys the JSON object lacks; NULL when it is no JSON object.

    The key set is parsed once per record, however many keys are required.
    """
    return _object(payload, lambda record: _missing(record, keys))


def has_keys(payload: Column, keys: Sequence[str] = REQUIRED_KEYS) -> Column:
    """Key *presence*: an explicit null passes, an absent key does not."""
    return F.coalesce(F.size(missing_keys(payload, keys)) == 0, F.lit(False))


def record_id(payload: Column, key: str = "id") -> Column:
    """Text of a top-level key; with a repeated key the last one counts."""
    return F.from_json(payload, f"`{key}` STRING").getField(key)


def findings(payload: Column, keys: Sequence[str] = REQUIRED_KEYS, id_key: str = "id") -> Column:
    """A struct of the record's ``id`` and its ``missing`` keys, from one parse."""
    return _object(payload, lambda record: F.struct(_last(record, id_key).alias("id"), _missing(record, keys).alias("missing")))


def canonical_json(text: Column) -> Column:
    """Same text for equal JSON values whose numbers have no exponent and at most 38 digits:
    key order, spacing and ``1.0`` vs ``1`` vanish. NULL unless it is one JSON value."""
    parsed = F.try_parse_json(followed_by_mark(text, f'"{MARK}"'))
    return bound(parsed, lambda v: F.when(F.try_variant_get(v, "$[1]", "string") == MARK, F.to_json(v)))


def _has_inexact(payload: Column) -> Column:
    # Strings are looked at only where there is something to find.
    return payload.rlike(_INEXACT_NUMBER) & F.regexp_replace(payload, _STRING, "").rlike(_INEXACT_NUMBER)


def _scientific(number: Column) -> Column:
    """A number token as its digits without outer zeros, and a power of ten: the same text
    for the same number. A power beyond 38 digits keeps the token."""

    def read(parts: Column) -> Column:
        # The token cut at its exponent: the digits after the point lower the power.
        fraction = F.length(F.substring_index(parts[0], ".", -1)) * F.contains(parts[0], F.lit(".")).cast("int")
        power = F.coalesce(F.get(parts, F.lit(1)), F.lit("0")).try_cast("decimal(38,0)") - fraction
        return F.struct(F.ltrim(F.translate(parts[0], "-.", ""), F.lit("0")).alias("digits"), power.alias("power"))

    def written(of: Column) -> Column:
        return bound(F.rtrim(of["digits"], F.lit("0")), lambda short: F.when(short == "", F.lit("0")).otherwise(F.coalesce(
            F.concat(F.when(F.startswith(number, F.lit("-")), "-").otherwise(""), short, F.lit("e"), (of["power"] + F.length(of["digits"]) - F.length(short)).cast("string")),
            number,
        )))

    return bound(bound(F.split(number, "[eE]"), read), written)


def _numbers_as_text(payload: Column) -> Column:
    """JSON in which each number is a marked string that equals that of the same number."""
    tokens = F.regexp_extract_all(payload, F.lit(rf'{_STRING}|{_NUMBER}|[^"0-9\-]+|.'), F.lit(0))
    marked = F.transform(tokens, lambda t: F.when(t.rlike("^-?[0-9]"), F.concat(F.lit(f'"{MARK}'), _scientific(t), F.lit('"'))).otherwise(t))
    return F.array_join(marked, "")


def json_distinct(left: Column, right: Column) -> Column:
    """``IS DISTINCT FROM`` on JSON values, numbers compared exactly: ``1e2``, ``100.0`` and
    ``100`` are one number, ones that differ in the fiftieth digit are two. Text that is no
    JSON value equals only itself.

    Equal text decides at once; only differing text is parsed, and number by number only
    where a number has an exponent or very many digits.
    """

    by_number = F.coalesce(_has_inexact(left), F.lit(False)) | F.coalesce(_has_inexact(right), F.lit(False))

    def differ(form: Callable[[Column], Column]) -> Column:
        sides = F.struct(form(left).alias("l"), form(right).alias("r"))
        return bound(sides, lambda s: F.coalesce(s["l"] != s["r"], F.lit(True)))

    exact = differ(lambda text: canonical_json(_numbers_as_text(text)))
    return F.when(left.eqNullSafe(right), F.lit(False)).when(by_number, exact).otherwise(differ(canonical_json))


def text_distinct(left: Column, right: Column) -> Column:
    """``IS DISTINCT FROM`` on plain values."""
    return ~left.eqNullSafe(right)
