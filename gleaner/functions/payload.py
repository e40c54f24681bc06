"""Reading raw payloads: JSON objects whose fields may be a string, a number, a list or an object. Parsed once into a
variant; every function is a Column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import clean_items, distinct_ignoring_case, let

#: The keys under which an object carries its label, in this order.
LABEL_KEYS = ("name", "title", "label", "value")
_NO_TEXTS = "array<string>"


def parsed(json: Column | str) -> Column:
    """The payload as a variant; null where it isn't JSON."""
    return F.try_parse_json(json)


def at(v: Column, *path: str) -> Column:
    """A field, or a field of a field."""
    return F.try_variant_get(v, "$" + "".join(f"['{p}']" for p in path), "variant")


def kind(v: Column) -> Column:
    """object, array, string, other (numbers and booleans) or null."""
    name = F.schema_of_variant(v)
    return (
        F.when(v.isNull() | (name == "VOID"), F.lit(None).cast("string"))
        .when(F.startswith(name, F.lit("OBJECT")), "object")
        .when(F.startswith(name, F.lit("ARRAY")), "array")
        .when(name == "STRING", "string")
        .otherwise("other")
    )


def is_a(v: Column, name: str) -> Column:
    """Whether a field is an OBJECT, an ARRAY or a STRING. This looks at a field once, where kind does so for each of its cases."""
    return F.startswith(F.schema_of_variant(v), F.lit(name))


def is_object(v: Column) -> Column:
    return F.coalesce(is_a(v, "OBJECT"), F.lit(False))


def scalar(v: Column) -> Column:
    """The text of a string, number or boolean; null for lists and objects."""
    return F.when(~F.substring(F.schema_of_variant(v), 1, 5).isin("OBJEC", "ARRAY", "VOID"), F.try_variant_get(v, "$", "string"))


def truthy(text: Column) -> Column:
    """The text, or null if it stands for nothing (blank, zero, false)."""
    return _first_truthy(text)


def _first_truthy(*texts: Column) -> Column:
    return F.get(F.filter(F.array(*texts), lambda x: ~F.trim(x).isin("", "0", "0.0", "false")), 0)


def first_true(*values: Column) -> Column:
    """The first scalar that stands for something."""
    return _first_truthy(*[scalar(v) for v in values])


def elements(v: Column) -> Column:
    """The members of a list, the values of an object, or the thing itself, as an array of variants."""
    listed, values = F.try_variant_get(v, "$", "array<variant>"), F.map_values(F.try_variant_get(v, "$", "map<string,variant>"))
    return F.when(is_a(v, "ARRAY"), listed).when(is_a(v, "OBJECT"), values).when(F.schema_of_variant(v) != "VOID", F.array(v)).otherwise(F.array().cast("array<variant>"))


def _label(x: Column) -> Column:
    named = _first_truthy(*[F.try_variant_get(x, f"$.{k}", "string") for k in LABEL_KEYS])
    return F.when(is_a(x, "OBJECT"), named).otherwise(F.try_variant_get(x, "$", "string"))


def texts(v: Column) -> Column:
    """The texts of a field, each once without regard to case: parts of a string (by comma, semicolon, bar or line), members
    of a list, values of an object; objects among them count by their label."""
    parts = F.split(F.try_variant_get(v, "$", "string"), r"[,;|\n]")
    found = F.when(is_a(v, "STRING"), parts).when(v.isNotNull(), F.transform(elements(v), _label))
    return distinct_ignoring_case(clean_items(F.coalesce(found, F.array().cast(_NO_TEXTS))))


def members(v: Column) -> Column:
    """The members of a list, or the object itself as the only member; none for anything else."""
    listed = F.try_variant_get(v, "$", "array<variant>")
    return F.when(is_a(v, "ARRAY"), listed).when(is_a(v, "OBJECT"), F.array(v)).otherwise(F.array().cast("array<variant>"))


def nested_texts(v: Column) -> Column:
    """Nonblank strings of a field: itself, those in its list, and the labels of objects in it, two levels down."""
    text = lambda x: F.when(is_a(x, "STRING"), F.array(F.try_variant_get(x, "$", "string")))
    none = F.array().cast(_NO_TEXTS)
    own = lambda x: text(x).otherwise(none)
    labels = lambda x: text(x).when(is_a(x, "OBJECT"), F.flatten(F.array(*[own(at(x, k)) for k in LABEL_KEYS]))).otherwise(none)
    found = F.when(v.isNull(), none).when(is_a(v, "ARRAY"), F.flatten(F.transform(F.try_variant_get(v, "$", "array<variant>"), labels))).otherwise(labels(v))
    return F.filter(F.coalesce(found, none), lambda x: F.trim(x) != "")


def instant(v: Column, date_only: bool = False) -> Column:
    """The moment that a field names: seconds or milliseconds since 1970, or an ISO text with an offset. With date_only, a
    bare date or a text without an offset is local time at +07:00; else such texts are null."""
    number = F.when((kind(v) == "other") & ~F.schema_of_variant(v).isin("BOOLEAN"), F.try_variant_get(v, "$", "double"))
    seconds = F.when(number > 10_000_000_000, number / 1000).otherwise(number)
    text = F.trim(F.when(kind(v) == "string", F.try_variant_get(v, "$", "string")))
    return F.coalesce(F.timestamp_micros((seconds * 1_000_000).cast("long")), instant_of_text(text, date_only))


def instant_of_text(text: Column, date_only: bool = False) -> Column:
    """As instant, for texts alone."""
    day, clock, offset = r"\d{4}-\d{2}-\d{2}", r"[T ]\d{2}:\d{2}(?::\d{2}(?:[.,]\d{1,6})?)?", r"(?:Z|[+-]\d{2}:?\d{2})"
    t = F.trim(text)
    whole = F.when(t.rlike(f"^{day}{clock}{offset}$"), t)
    if date_only:
        local = F.when(t.rlike(f"^{day}$"), F.concat(t, F.lit("T00:00:00+07:00"))).when(t.rlike(f"^{day}{clock}$"), F.concat(t, F.lit("+07:00")))
        whole = F.coalesce(whole, local)
    whole = F.regexp_replace(F.replace(whole, F.lit(","), F.lit(".")), r"([+-]\d{2})(\d{2})$", "$1:$2")
    return whole.try_cast("timestamp")


def positive_decimal(*values: Column) -> Column:
    """The first of the fields that stands for something, as a positive number; blanks and commas in it are dropped."""
    number = lambda text: F.when(text != "true", text.try_cast("decimal(20,4)"))
    return let(let(F.regexp_replace(first_true(*values), "[ ,]", ""), number), lambda n: F.when(n > 0, n))
