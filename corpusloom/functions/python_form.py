"""The text that Python gives a value, as column expressions built from the value's type.

Numbers, texts, bytes, dates, arrays, maps and records come out as ``repr`` writes them, so nothing runs per row in Python. NULL is
``None``. A float is written as the double it equals. Which characters are printable follows the JVM's Unicode tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNPRINTABLE = r"[\p{C}\p{Z}&&[^ ]]"
LEAST_EXPONENT, EXPONENT_FROM = -4, 16  # fixed values: between them, Python writes a float without exponent


def python_form(value: Column, kind: T.DataType) -> Column:
    """``repr`` of a value of the given type."""
    return F.coalesce(_form(value, kind), F.lit("None"))


def _form(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(value, F.lit("True")).otherwise(F.when(~value, F.lit("False")))
    if isinstance(kind, T.IntegralType):
        return value.cast("string")
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return float_form(value.cast("double"))
    if isinstance(kind, T.DecimalType):
        return F.concat(F.lit("Decimal('"), value.cast("string"), F.lit("')"))
    if isinstance(kind, T.BinaryType):
        return bytes_form(value)
    if isinstance(kind, T.DateType):
        return _call("datetime.date", F.year(value), F.month(value), F.day(value))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return _time_form(value)
    if isinstance(kind, T.ArrayType):
        return _between("[", F.transform(value, lambda v: python_form(v, kind.elementType)), "]")
    if isinstance(kind, T.MapType):
        entry = F.transform(
            F.map_entries(value),
            lambda e: F.concat(python_form(e["key"], kind.keyType), F.lit(": "), python_form(e["value"], kind.valueType)),
        )
        return _between("{", entry, "}")
    if isinstance(kind, T.StructType):
        fields = [F.concat(F.lit(f"{f.name!r}: "), python_form(value.getField(f.name), f.dataType)) for f in kind.fields]
        return F.when(value.isNotNull(), _between("{", F.array(*fields), "}"))
    return text_form(value.cast("string"))


def _between(left: str, items: Column, right: str) -> Column:
    return F.concat(F.lit(left), F.array_join(items, ", "), F.lit(right))


def _call(name: str, *parts: Column) -> Column:
    """A call with the parts that are not NULL; NULL without the first."""
    inner = F.concat_ws(", ", *[p.cast("string") for p in parts])
    return F.when(parts[0].isNotNull(), F.concat(F.lit(f"{name}("), inner, F.lit(")")))


def _time_form(value: Column) -> Column:
    """Seconds and microseconds are left out where they are zero, seconds only if both are."""
    second = F.second(value)
    micros = F.date_format(value, "SSSSSS").cast("int")
    return _call(
        "datetime.datetime", F.year(value), F.month(value), F.day(value), F.hour(value), F.minute(value),
        F.when((second > 0) | (micros > 0), second), F.when(micros > 0, micros),
    )


def float_form(value: Column) -> Column:
    """The fewest digits that give the value back. Python has its own bounds for the exponent and writes it with two digits.

    Some JVMs write a digit too many, so shorter forms are tried first.
    """
    fewer = [F.format_string(f"%.{n - 1}e", value) for n in (1, 15, 16, 17)]
    text = F.coalesce(*[F.when(t.try_cast("double") == value, t) for t in fewer], value.cast("string"))
    mantissa = F.regexp_extract(text, r"^-?([0-9.]+)", 1)
    whole = F.substring_index(mantissa, ".", 1)
    written = F.regexp_replace(mantissa, r"\.", "")
    zeros = F.length(F.regexp_extract(written, r"^(0*)", 1))
    digits = F.regexp_replace(written, r"^0+|0+$", "")
    power = F.coalesce(F.nullif(F.regexp_extract(text, r"[eE]([-+]?\d+)$", 1), F.lit("")).cast("int"), F.lit(0))
    exponent = power + F.length(whole) - 1 - zeros
    count = F.length(digits)
    plain = (
        F.when(exponent < 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -exponent - 1), digits))
        .when(count <= exponent + 1, F.concat(digits, F.repeat(F.lit("0"), exponent + 1 - count), F.lit(".0")))
        .otherwise(F.concat(F.substring(digits, F.lit(1), exponent + 1), F.lit("."), F.substring(digits, exponent + 2, count)))
    )
    tail = F.when(count > 1, F.concat(F.lit("."), F.substring(digits, F.lit(2), count))).otherwise(F.lit(""))
    sign = F.when(exponent < 0, F.lit("e-")).otherwise(F.lit("e+"))
    size = F.abs(exponent).cast("string")
    scientific = F.concat(F.substring(digits, 1, 1), tail, sign, F.lpad(size, F.greatest(F.length(size), F.lit(2)), F.lit("0")))
    number = F.when(count == 0, F.lit("0.0")).when((exponent < LEAST_EXPONENT) | (exponent >= EXPONENT_FROM), scientific).otherwise(plain)
    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(F.abs(value) == F.lit(float("inf")), F.when(value > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .otherwise(F.concat(F.when(text.startswith("-"), F.lit("-")).otherwise(F.lit("")), number))
    )


def _quoted(text: Column, escaped: Column) -> Column:
    """Single quotes, but double ones around a text that holds single ones only."""
    single, double = text.contains("'"), text.contains('"')
    inner = F.when(single & double, F.replace(escaped, F.lit("'"), F.lit("\\'"))).otherwise(escaped)
    quote = F.when(single & ~double, F.lit('"')).otherwise(F.lit("'"))
    return F.concat(quote, inner, quote)


def text_form(text: Column) -> Column:
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for char, name in (("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(char), F.lit(name))

    def visible(c: Column) -> Column:
        code = F.ascii(c)
        digits = F.lower(F.hex(code))
        form = (
            F.when(code < 1 << 8, F.concat(F.lit("\\x"), F.lpad(digits, 2, "0")))
            .when(code < 1 << 16, F.concat(F.lit("\\u"), F.lpad(digits, 4, "0")))
            .otherwise(F.concat(F.lit("\\U"), F.lpad(digits, 8, "0")))
        )
        return F.when(c.rlike(UNPRINTABLE), form).otherwise(c)

    characters = F.regexp_extract_all(escaped, F.lit("(?s)."), F.lit(0))
    shown = F.when(escaped.rlike(UNPRINTABLE), F.array_join(F.transform(characters, visible), "")).otherwise(escaped)
    return _quoted(text, shown)


def bytes_form(value: Column) -> Column:
    """Bytes as ``b'...'``: what is no printable ASCII character is written as its two hexadecimal digits."""
    named = {9: "\\t", 10: "\\n", 13: "\\r", 92: "\\\\"}

    def shown(pair: Column) -> Column:
        code = F.conv(pair, 16, 10).cast("int")
        form = F.when((code >= 32) & (code < 127), F.char(code)).otherwise(F.concat(F.lit("\\x"), F.lower(pair)))
        for number, name in named.items():
            form = F.when(code == number, F.lit(name)).otherwise(form)
        return form

    text = F.array_join(F.transform(F.regexp_extract_all(F.hex(value), F.lit(".."), F.lit(0)), shown), "")
    return F.concat(F.lit("b"), _quoted(text, text))
