"""Text encodings of typed values, as native Spark expressions.

The online store keeps every field as text, in the form a Python producer
would write it: booleans ``true``/``false``, doubles like Python's ``repr``,
timestamps in ISO-8601. Everything is a native Column expression.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _let(x: Column, use) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(x), use), 1)


def _layout(digits: Column, exp: Column) -> Column:
    """Text of 0.d1d2... times 10^(exp + 1), without sign: fixed notation for 1e-4 <= x < 1e16, else ``d.ddde+XX``."""
    nd = F.length(digits)
    sci_mant = F.when(nd == 1, digits).otherwise(
        F.concat(F.substr(digits, F.lit(1), F.lit(1)), F.lit("."), F.substr(digits, F.lit(2))))
    sci = F.concat(sci_mant, F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.abs(exp) < 10, F.lit("0")).otherwise(F.lit("")), F.abs(exp).cast("string"))
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -exp - 1), digits)
    big = F.when(nd <= exp + 1, F.concat(digits, F.repeat(F.lit("0"), exp + 1 - nd), F.lit(".0"))).otherwise(
        F.concat(F.substr(digits, F.lit(1), exp + 1), F.lit("."), F.substr(digits, exp + 2)))
    return F.when((exp < -4) | (exp >= 16), sci).when(exp < 0, small).otherwise(big)


def _whole(v: Column) -> Column:
    """(d, x): the first 18 digits of a whole |v| from 2^53 to 1e26, multiplied out exactly.

    If more follow, a last digit 0 or 5 is raised by one, so that d rounds to fewer digits as the whole number does.
    """
    scaled = lambda k: (v / F.lit(2.0 ** k)).cast("long").cast("decimal(19,0)") * F.lit(2 ** k).cast("decimal(11,0)")
    exact = F.when(v < 2.0 ** 63, scaled(0)).when(v < 2.0 ** 74, scaled(11)).when(v < 2.0 ** 85, scaled(22)).otherwise(scaled(33))

    def cut(e: Column) -> Column:
        x = F.greatest(F.length(e.cast("string")) - 18, F.lit(0))
        unit = F.element_at(F.array(*[F.lit(10 ** k).cast("decimal(9,0)") for k in range(9)]), x + 1)
        d = F.call_function("div", e, unit)
        more = (d.cast("decimal(18,0)") * unit < e) & (d % 5 == 0)
        return F.struct((d + more.cast("long")).alias("d"), x.alias("x"))
    return _let(exact, cut)


def _digits(v: Column, exact: bool) -> Column:
    """(d, x) with v = d * 10^x in the fewest digits, for positive v < 1e-3 or >= 1e7.

    The JVM's text has digits too many for some values (JDK 17: 2^-44, 4.9E-324). Digits go as long as
    the rounded rest, or its other neighbour, still reads as the same double. Large whole numbers, where the JVM's last digits
    may also be wrong, start from their exact digits.
    """
    text = F.split(v.cast("string"), "E")
    mant = F.regexp_replace(F.element_at(text, 1), r"\.", "")
    jvm = F.struct(mant.cast("long").alias("d"), (F.element_at(text, 2).cast("int") - F.length(mant) + 1).alias("x"))
    if not exact:
        return jvm
    whole = (v >= 2.0 ** 53) & (v < 1e26)

    def shorten(first: Column) -> Column:
        def shorter(now: Column, drop: Column) -> Column:
            unit = F.element_at(F.array(*[F.lit(10 ** k).cast("long") for k in range(1, 5)]), drop)
            near = F.call_function("div", first["d"] + F.call_function("div", unit, F.lit(2).cast("long")), unit)
            other = near + F.when(near * unit < first["d"], 1).otherwise(-1)
            at = lambda d: F.struct(d.cast("long").alias("d"), (first["x"] + drop).alias("x"))
            reads = lambda c: F.concat(c["d"].cast("string"), F.lit("E"), c["x"].cast("string")).cast("double") == v
            kept = (now["x"] == first["x"] + drop - 1)  # every digit so far could go
            return _let(F.array(at(near), at(other)), lambda c: F.when(~kept, now).when(reads(c[0]), c[0]).when(reads(c[1]), c[1]).otherwise(now))
        return F.aggregate(F.array(*[F.lit(k) for k in range(1, 5)]), first, shorter)
    return _let(F.when(whole, _whole(v)).otherwise(jvm), shorten)


def _float_text(x, exact: bool) -> Column:
    v = _c(x).cast("double")
    s = v.cast("string")
    sign = F.when(s.startswith("-"), F.lit("-")).otherwise(F.lit(""))
    relaid = _let(_digits(F.abs(v), exact), lambda t: _let(t["d"].cast("string"), lambda d: F.concat(
        sign, _layout(F.regexp_replace(d, "0+$", ""), t["x"] + F.length(d) - 1))))
    return (F.when(v.isNull(), F.lit(None).cast("string"))
             .when(F.isnan(v), F.lit("nan"))
             .when(v == float("inf"), F.lit("inf"))
             .when(v == float("-inf"), F.lit("-inf"))
             .when(~s.contains("E"), s)
             .otherwise(relaid))


def py_float_text(x) -> Column:
    """Double -> text with Python ``repr`` layout and the JVM's digits.

    The JVM prints fixed notation for 1e-3 <= |x| < 1e7, where its digits are Python's; other values are
    re-laid out from mantissa and exponent. JDK 17 may print a digit too many there; :func:`py_float_text_exact` does not.
    """
    return _float_text(x, False)


def py_float_text_exact(x) -> Column:
    """Python ``repr`` of any double, in native expressions. Only values that the JVM prints with an exponent cost more than a cast."""
    return _float_text(x, True)


def utc(x, dtype: T.DataType) -> Column:
    """A timestamp as zone-less UTC time, whatever the session's zone; zone-less ones are UTC already."""
    ts = _c(x)
    if isinstance(dtype, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), ts.cast("timestamp_ntz"))
    if isinstance(dtype, T.StringType):  # ISO text: with an offset it names an instant, without one it is UTC
        marked = F.when(ts.rlike(r"(Z|[+-]\d\d:?\d\d)$"), ts).otherwise(F.concat(ts, F.lit("Z")))
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), marked.cast("timestamp").cast("timestamp_ntz"))
    return ts.cast("timestamp_ntz")


def iso_timestamp(x, dtype: T.DataType) -> Column:
    """Timestamp -> ``isoformat()`` text.

    Fraction is omitted when zero, else 6 digits. A zone-aware timestamp is
    rendered in UTC with ``+00:00``; a zone-less one without offset.
    """
    ts = _c(x)
    if isinstance(dtype, T.TimestampType):
        ts = utc(ts, dtype)
        suffix = F.lit("+00:00")
    else:
        suffix = F.lit("")
    frac = F.date_format(ts, "SSSSSS")
    base = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    body = F.when(frac == "000000", base).otherwise(F.concat(base, F.lit("."), frac))
    return F.when(ts.isNull(), F.lit(None).cast("string")).otherwise(F.concat(body, suffix))


def iso_millis_z(x, dtype: T.DataType) -> Column:
    """Event-time text ``YYYY-MM-DDTHH:MM:SS.mmmZ`` in UTC (milliseconds truncated)."""
    return F.date_format(utc(x, dtype), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def field_text(x, dtype: T.DataType, exact_floats: bool = True) -> Column:
    """Any atomic value -> its online text form (null stays null)."""
    col = _c(x)
    if isinstance(dtype, T.BooleanType):
        return F.when(col, F.lit("true")).when(~col, F.lit("false"))
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return py_float_text_exact(col) if exact_floats else py_float_text(col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return iso_timestamp(col, dtype)
    if isinstance(dtype, T.StringType):
        return col
    return col.cast("string")


def parse_number(x) -> Column:
    """Stored text -> double for NUMERIC fields (``nan``, ``inf``, ``1e-05`` parse)."""
    return _c(x).try_cast("double")
