"""JSON texts as VARIANT: parsed once, then each field is read by its own rule, whatever type it has.

A field of another type costs that field, not its item. Texts stay texts: other values give their JSON text. Numbers
are read from numbers only, so a text or a list in a number's place is NULL. Objects and lists have no such rule: what
is not one, where one belongs, makes the whole item unusable.
"""

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

NUMBERS = "^(BIGINT|DECIMAL|DOUBLE|FLOAT)"
# Numbers that JSON does not have, but some writers do.
BARE_NUMBERS = r"(?<=[:\[,\s])(NaN|-?Infinity)(?=[\s,}\]])"


def parse_variant(text):
    """The text as VARIANT, NULL if it is not JSON. Numbers that are none become null."""
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(F.regexp_replace(text, BARE_NUMBERS, "null")))


def _at(name, path="$"):
    return f"{path}['{name}']"


def _get(value, path, kind):
    return F.try_variant_get(value, path, kind)


def _kind(value, path):
    """The type's name; VOID for null, NULL for nothing."""
    return F.schema_of_variant(_get(value, path, "variant"))


def is_object(value, path="$"):
    # A map of variants is made of any object and of nothing else; the type's name would spell out all that is in it.
    return _get(value, path, "map<string,variant>").isNotNull()


def _present(part):
    return part.isNotNull() & ~F.is_variant_null(part)


def has_field(value, name):
    """Whether an object has a field that is not null."""
    return _present(_get(value, _at(name), "variant"))


def _any(conditions):
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def typed_fields(value, schema, path="$"):
    """The columns of ``schema`` out of an object, or out of the object at a path in it."""
    return [_typed(value, _at(f.name, path), f.dataType).alias(f.name) for f in schema.fields]


def _typed(value, path, kind):
    if isinstance(kind, StringType):
        return _get(value, path, "string")
    if isinstance(kind, StructType):
        return F.when(is_object(value, path), F.struct(*typed_fields(value, kind, path)))
    if isinstance(kind, ArrayType):
        return F.transform(_get(value, path, "array<variant>"),
                           lambda entry: F.struct(*typed_fields(entry, kind.elementType)))
    return F.when(_kind(value, path).rlike(NUMBERS), _get(value, path, kind.simpleString()))


def misshapen(value, schema, path="$"):
    """Whether an object or a list of objects is something else; NULL and missing ones are not."""
    found = []
    for f in schema.fields:
        at = _at(f.name, path)
        part = _get(value, at, "variant")
        if isinstance(f.dataType, StructType):
            found.append(_present(part) & (~is_object(value, at) | misshapen(value, f.dataType, at)))
        elif isinstance(f.dataType, ArrayType):
            entries = _get(value, at, "array<variant>")
            found.append(_present(part) & (entries.isNull() | F.exists(entries, lambda e: ~is_object(e))))
    return F.coalesce(_any(found), F.lit(False))


def odd_fields(value, schema, within=""):
    """Names of the texts and numbers that have another type, as an array."""
    return F.filter(F.array(*_odd(value, schema, within)), lambda name: name.isNotNull())


def _odd(value, schema, within, path="$"):
    out = []
    for f in schema.fields:
        at = _at(f.name, path)
        part = _get(value, at, "variant")
        if isinstance(f.dataType, StructType):
            out += _odd(value, f.dataType, f"{within}{f.name}.", at)
        elif not isinstance(f.dataType, ArrayType):
            right = "^STRING$" if isinstance(f.dataType, StringType) else NUMBERS
            out.append(F.when(_present(part) & ~_kind(value, at).rlike(right), F.lit(within + f.name)))
    return out
