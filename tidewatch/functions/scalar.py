"""Column expressions (all JVM-side, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schema import BENIGN, BENIGN_CATEGORY, CATEGORY_RULES, OTHER_CATEGORY


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_double(c: str | Column) -> Column:
    """Text to double; bad text becomes NULL (never fails the query).
    ``inf``/``-inf``/``nan`` spellings give the IEEE values."""
    return _c(c).try_cast("double")


def to_int(c: str | Column) -> Column:
    """Text to int with truncation (``'0.500000'`` -> 0, ``'6.9'`` -> 6);
    bad text, infinities, NaN and out-of-range values become NULL."""
    return _c(c).try_cast("double").try_cast("int")


def attack_category(label: str | Column) -> Column:
    """Category of a decoded label: first matching rule on the upper-cased label."""
    up = F.upper(_c(label))
    expr = F.when(up == F.lit(BENIGN), F.lit(BENIGN_CATEGORY[0]))
    for name, _colour, words in CATEGORY_RULES:
        cond = None
        for w in words:
            cond = up.contains(w) if cond is None else (cond | up.contains(w))
        expr = expr.when(cond, F.lit(name))
    return expr.otherwise(F.lit(OTHER_CATEGORY[0]))


def category_colour(label: str | Column) -> Column:
    """Display colour of the label's category (same rule order)."""
    up = F.upper(_c(label))
    expr = F.when(up == F.lit(BENIGN), F.lit(BENIGN_CATEGORY[1]))
    for _name, colour, words in CATEGORY_RULES:
        cond = None
        for w in words:
            cond = up.contains(w) if cond is None else (cond | up.contains(w))
        expr = expr.when(cond, F.lit(colour))
    return expr.otherwise(F.lit(OTHER_CATEGORY[1]))


def is_benign(label: str | Column) -> Column:
    return F.upper(_c(label)) == F.lit(BENIGN)


def traffic_status(label: str | Column) -> Column:
    return F.when(is_benign(label), F.lit("benign")).otherwise(F.lit("attack"))


def _let(value: Column, body) -> Column:
    """``body(v)`` with ``v`` bound to ``value``: evaluated once, and referenced once
    by the plan however often ``body`` uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def fixed(c: str | Column, digits: int = 6) -> Column:
    """``%.<digits>f`` text of a double, rounded the way C and Python round:
    the exact binary value, ties to even. (``format_string`` rounds the
    shortest decimal form half-up, which differs on values such as
    5741.4489335.) At most 7 digits.

    The fraction times 10^digits is held exactly as a sum of two doubles (its
    two 26-bit halves times the scale), whose rounding error decides ties.
    """
    if not 0 <= digits <= 7:
        raise ValueError("0 to 7 digits")
    scale = float(10**digits)
    point = "." if digits else ""

    def exact_sum(p: Column) -> Column:
        s = p["fa"] + p["b"]
        t = s - p["fa"]
        return F.struct(p["n"].alias("n"), s.alias("s"), ((p["fa"] - (s - t)) + (p["b"] - t)).alias("err"))

    def rounded(r: Column) -> Column:
        low = F.floor(r["s"])
        part, units = r["s"] - low, r["n"] + low
        odd = F.pmod(units, F.lit(2)) == 1
        up = (part > 0.5) | ((part == 0.5) & ((r["err"] > 0) | ((r["err"] == 0) & odd)))
        return units + F.when(up, 1).otherwise(0)

    def units_of(fraction: Column) -> Column:
        def halves(hi: Column) -> Column:
            return _let(
                hi * scale,
                lambda a: F.struct(F.floor(a).alias("n"), (a - F.floor(a)).alias("fa"), ((fraction - hi) * scale).alias("b")),
            )

        hi = _let(fraction * 134217729.0, lambda t: t - (t - fraction))
        return _let(_let(_let(hi, halves), exact_sum), rounded)

    def written(whole: Column, units: Column) -> Column:
        text = (whole + F.floor(units / scale)).cast("bigint").cast("string")
        return F.concat(text, F.lit(point), F.lpad(F.pmod(units, F.lit(10**digits)).cast("string"), digits, "0"))

    def small(ax: Column) -> Column:  # below 2^52
        return _let(F.floor(ax), lambda whole: _let(_let(ax - whole, units_of), lambda units: written(whole, units)))

    def large(ax: Column) -> Column:  # an integer: two parts that are exact as longs
        dec, two62 = "decimal(38,0)", float(2**62)
        high = F.floor(ax / two62).cast("double")
        whole = high.cast("bigint").cast(dec) * F.lit(2**62).cast(dec) + (ax - high * two62).cast("bigint").cast(dec)
        return F.concat(whole.cast("string"), F.lit(point + "0" * digits))

    def text(x: Column) -> Column:
        ax = F.abs(x)
        body = (
            F.when(ax < float(2**52), _let(ax, small))
            .when(ax < 1e37, _let(ax, large))
            .otherwise(F.format_string(f"%.{digits}f", ax))
        )
        return (
            F.when(x.isNull(), F.lit(None).cast("string"))
            .when(F.isnan(x), F.lit("nan"))
            .when(x == float("inf"), F.lit("inf"))
            .when(x == float("-inf"), F.lit("-inf"))
            .when(x < 0, F.concat(F.lit("-"), body))
            .otherwise(body)
        )

    return _let(_c(c).cast("double"), text)


def percent1(c: str | Column) -> Column:
    """``12.3%`` text of a percentage."""
    return F.concat(fixed(c, 1), F.lit("%"))


def once(df, name: str, value: Column):
    """``df`` with ``value`` as column ``name``, computed once a row: it stands behind a
    generator of one row, through which Catalyst pushes no filter on its output,
    so later filters and projections read the result instead of a copy of the expression."""
    row = F.inline(F.array(F.struct(value.alias(name))))
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != name], row)
