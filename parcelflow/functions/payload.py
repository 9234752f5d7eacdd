"""Strict JSON parsing into VARIANT, and typed access to payload fields."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelflow.schemas import CONTRACTS, Field

_PYTHON_LIKE = {"allowNonNumericNumbers": "true", "allowSingleQuotes": "false"}


def _in_list(text: Column) -> Column:
    return F.concat(F.lit("["), text, F.lit("]"))


def _in_object(text: Column) -> Column:
    return F.concat(F.lit('{"v":'), text, F.lit(',"end":1}'))


def parse_in_list(text: Column) -> Column:
    """``[text]`` as VARIANT, NULL where malformed: the input of :func:`only_element`.

    Give it a column of its own, so that it is computed once and used twice.
    """
    return F.try_parse_json(_in_list(text))


def only_element(listed: Column, text: Column) -> Column:
    """The text as VARIANT, NULL unless it is exactly one JSON value.

    Spark's parser stops after the first value and ignores what follows. Inside
    ``[text]`` trailing text breaks the list, gives a second element, or - only
    when the text itself holds a ``]`` - closes the list early. Texts with a
    ``]`` must therefore also parse inside ``{"v":text,"end":1}``, where an
    early ``]`` is an error. Most payloads hold none and are parsed once.
    """
    boxed = F.try_parse_json(_in_object(text))
    closes_late = F.when(
        F.contains(text, F.lit("]")),
        F.coalesce(F.try_variant_get(boxed, "$.end", "int") == 1, F.lit(False)),
    ).otherwise(F.lit(True))
    single = F.try_variant_get(listed, "$[1]", "variant").isNull() & closes_late
    return F.when(single, F.try_variant_get(listed, "$[0]", "variant"))


def with_strict_json(df: DataFrame, text: str, name: str) -> DataFrame:
    """Add ``text`` parsed as exactly one JSON value, NULL where it is not."""
    return df.withColumn("_listed", parse_in_list(F.col(text))).select(
        *df.columns, only_element(F.col("_listed"), F.col(text)).alias(name)
    )


def is_non_finite_json(text: Column) -> Column:
    """True for text that is JSON but for the number words NaN and Infinity."""
    listed = F.from_json(_in_list(text), "array<string>", _PYTHON_LIKE)
    boxed = F.from_json(_in_object(text), "v string, end int", _PYTHON_LIKE)
    lenient = (F.size(listed) == 1) & (boxed["end"] == 1)
    return F.when(text.rlike("NaN|Infinity"), F.coalesce(lenient, F.lit(False))).otherwise(F.lit(False))


def _without_escaped_backslashes(text: Column) -> Column:
    r"""Valid JSON text in which every ``\\u`` left is an escape, not an escaped backslash."""
    return F.replace(text, F.lit("\\\\"), F.lit(""))


def has_nul_character(text: Column) -> Column:
    """True where a JSON string escapes the NUL character, which no text column can hold."""
    escape = F.lit("\\u0000")  # the first test is cheap and decides nearly all texts
    return F.contains(text, escape) & F.contains(_without_escaped_backslashes(text), escape)


def has_lone_surrogate(text: Column) -> Column:
    """True where a JSON string escapes half a surrogate pair, which is no character."""
    suspect = F.contains(text, F.lit("\\ud")) | F.contains(text, F.lit("\\uD"))
    pair = r"(?i)\\ud[89ab][0-9a-f]{2}\\ud[c-f][0-9a-f]{2}"
    rest = F.regexp_replace(_without_escaped_backslashes(text), pair, "")
    return F.when(suspect, rest.rlike(r"(?i)\\ud[89a-f][0-9a-f]{2}")).otherwise(F.lit(False))


def field(payload: Column, name: str) -> Column:
    """One payload field as text; NULL when missing, JSON null, or not an object.

    Reading as text first keeps quoted numbers usable and stops 2.5 from
    silently becoming 2.
    """
    return F.variant_get(payload, f"$.{name}", "string")


# Whole types; a field of such a type is refused when its number was written with a decimal point.
WHOLE_TYPES = ("tinyint", "smallint", "int", "bigint")
_WHOLE_FIELDS = sorted({f.json for fields in CONTRACTS.values() for f in fields if f.type in WHOLE_TYPES})
# Up to here a double is exactly the whole number it was written as.
_EXACT_DOUBLE = float(1 << 53)


def _spelling(value: Column) -> Column:
    """A number written with point or exponent as a cast to a whole type should see it; NULL for all else.

    A variant that was just parsed tells a point (decimal) from an exponent (double). ``7.0`` stays ``7.0``, ``1e3`` is
    ``1000``. A double beyond 2^53 need not be the number that was written, and stays as it is printed.
    """
    text, kind = value.cast("string"), F.schema_of_variant(value)
    number = text.try_cast("double")
    exact = (F.abs(number) <= F.lit(_EXACT_DOUBLE)) & (number == F.floor(number))
    with_point = F.when(F.contains(text, F.lit(".")), text).otherwise(F.concat(text, F.lit(".0")))
    return F.when(F.startswith(kind, F.lit("DECIMAL")), with_point).when(
        (kind == "DOUBLE") & exact, number.try_cast("bigint").cast("string")
    )


def spelled_numbers(text: Column, parsed: Column, names: list[str] = _WHOLE_FIELDS) -> Column:
    """Field -> spelling, of the named fields whose number is written with a point or an exponent; NULL for none.

    Take it from the text and its freshly parsed variant: storage does not keep how a number was written, because
    shredding turns the integers of a file that holds one ``7.0`` into decimals too. One pattern over the
    text decides for nearly all messages that there is nothing to keep.
    """
    suspect = rf'"({"|".join(names)})"\s*:\s*-?[0-9]+[.eE]|\\u'
    found = F.create_map(*[x for n in names for x in (F.lit(n), _spelling(F.variant_get(parsed, f"$.{n}", "variant")))])
    kept = F.map_filter(found, lambda _, spelling: spelling.isNotNull())
    is_object = F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT"))
    return F.when(text.rlike(suspect) & is_object & (F.size(kept) > 0), kept)


def castable_text(payload: Column, spec: Field, spelled: Column | None = None) -> Column:
    """The text of a field that the cast to its type is applied to."""
    text = field(payload, spec.json)
    if spelled is None or spec.type not in WHOLE_TYPES:
        return text
    return F.coalesce(F.try_element_at(spelled, F.lit(spec.json)), text)


def typed_field(payload: Column, spec: Field, strict: bool = True, spelled: Column | None = None) -> Column:
    """A contract field in its declared type.

    Malformed text raises (ANSI cast); with ``strict=False`` it becomes NULL. ``spelled`` are the kept
    :func:`spelled_numbers`; with them ``7.0`` is no whole number and ``1e3`` is one.
    """
    text = castable_text(payload, spec, spelled)
    value = text.cast(spec.type) if strict else text.try_cast(spec.type)
    if spec.default is not None:
        value = F.coalesce(value, F.lit(spec.default).cast(spec.type))
    return value.alias(spec.column)
