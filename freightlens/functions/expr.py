"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"
_SHORT_DATE = r"^[0-9]{1,19}-[A-Za-z]{3}-[0-9]{2}\z"


def flag(condition: Column) -> Column:
    """0/1 with an unknown comparison counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def flag_if(applies: Column, condition: Column) -> Column:
    """0/1 where ``applies``, NULL elsewhere."""
    return F.when(applies, flag(condition))


def count_if(condition: Column) -> Column:
    """Number of rows where ``condition`` holds, as BIGINT, 0 when there are none."""
    return F.count(F.when(condition, 1))


def money_sum(column: Column | str, digits: int = 2) -> Column:
    """Exact decimal total, rounded, handed out as DOUBLE (NULL over no rows)."""
    c = F.col(column) if isinstance(column, str) else column
    return F.round(F.sum(c), digits).cast("double")


def money_sum_if(condition: Column, column: Column | str, digits: int = 2) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    zero = F.lit(0).cast("decimal(1,0)")
    return F.round(F.sum(F.when(condition, c).otherwise(zero)), digits).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Floating division that is NULL on a zero or missing denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def pct(numerator: Column, denominator: Column, digits: int = 2) -> Column:
    return F.round(numerator.cast("double") * 100.0
                   / F.nullif(denominator.cast("double"), F.lit(0.0)), digits)


def pct_of_flag(name: str, digits: int = 2) -> Column:
    """Share of rows with the 0/1 flag set, over rows where the flag applies."""
    return F.round(F.avg(name) * 100, digits)


def mean(name: str, digits: int = 2) -> Column:
    return F.round(F.avg(F.col(name).cast("double")), digits)


def mean_of_hundredths(name: str) -> Column:
    """Average of a non-negative DECIMAL of two digits, rounded half up to two digits.

    Sum, count and rounding are whole numbers, so that no order of rows changes it.
    """
    hundredths, n = (F.sum(name) * 100).cast("bigint"), F.count(name)
    doubled, twice = hundredths * 2 + n, F.nullif(n * 2, F.lit(0).cast("bigint"))
    return ((doubled - doubled % twice) / twice).cast("double") / 100


def spread_of_whole(column: Column) -> Column:
    """Population standard deviation of whole numbers from exact sums."""
    x = column.cast("bigint")
    n, total, squares = F.count(x), F.sum(x), F.sum(x * x)
    return F.sqrt((n * squares - total * total).cast("double")) / F.nullif(n, F.lit(0).cast("bigint"))


def lookup(mapping: Mapping[str, object], key: Column, cast: str | None = None) -> Column:
    """Value of ``key`` in a fixed mapping, NULL when absent.

    The mapping is a literal in the plan, so no join or broadcast is needed.
    """
    pairs: list[Column] = []
    for k, v in mapping.items():
        value = F.lit(v)
        pairs += [F.lit(k), value.cast(cast) if cast else value]
    return F.try_element_at(F.create_map(*pairs), key)


def first_hit(text: Column, keywords: Iterable[tuple[str, str]]) -> Column:
    """Value of the first keyword contained in ``text``, NULL when none is."""
    hits = [F.when(text.contains(word), F.lit(value)) for word, value in keywords]
    return F.coalesce(*hits)


def bucket(value: Column, bounds: list[int], open_label: str | None = None) -> Column:
    """Label of the inclusive upper-bound bucket holding ``value`` ("0-7", "8-14", ...)."""
    out, low = None, 0
    for bound in bounds:
        label = F.lit(f"{low}-{bound}")
        out = F.when(value <= bound, label) if out is None else out.when(value <= bound, label)
        low = bound + 1
    return out.otherwise(F.lit(open_label or f"{bounds[-1]}+"))


def bucket_order(value: Column, bounds: list[int]) -> Column:
    out = None
    for i, bound in enumerate(bounds):
        out = F.when(value <= bound, i + 1) if out is None else out.when(value <= bound, i + 1)
    return out.otherwise(len(bounds) + 1)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(later, earlier)


def parse_short_date(text: Column) -> Column:
    """``2-Jun-06`` as a date; anything else is NULL.

    Month names match in any case, and two-digit years from 69 on belong to the
    last century.
    """
    tidy = F.trim(text)
    # The pattern fixes the length of month and year. Letters alone never match across a blank
    # between two names, and a name that is none of them gives month 0, which is no date.
    year, day = F.substring(tidy, -2, 2), F.ltrim(F.substr(tidy, F.lit(1), F.length(tidy) - 7), F.lit("0"))
    month = F.shiftright(F.call_function("instr", F.lit(_MONTHS), F.lower(F.substring(tidy, -6, 3))) + 3, 2).cast("string")
    century = F.when(year >= "69", "19").otherwise("20")
    # Every day of 2069 to 2099 is one of 1969 to 1999, so that the century may come first.
    iso = F.concat(century, year, F.lit("-"), month, F.lit("-"), day)
    return F.when(tidy.rlike(_SHORT_DATE), iso.try_cast("date"))


def padded(number: Column, width: int) -> Column:
    """A whole number as ``format_string("%0<width>d")`` writes it, which costs far more a row."""
    text, minus = number.cast("string"), number < 0
    short = F.when(minus, F.concat(F.lit("-"), F.lpad(F.substring(text, 2, 20), width - 1, "0"))).otherwise(F.lpad(text, width, "0"))
    return F.coalesce(F.when(F.length(text) < width, short).otherwise(text), F.lit("null".rjust(width)))


def number(text: Column, kind: str = "double") -> Column:
    """Numeric value of a text, NULL when it is not a number (NaN is none)."""
    value = text.try_cast(kind)
    return F.when(~F.isnan(value), value) if kind == "double" else value


def hash48(seed: int, salt: str, key: Column) -> Column:
    """Order-independent 48-bit hash of (seed, salt, key)."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(salt), key.cast("string")))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("bigint")


def uniform(seed: int, salt: str, key: Column) -> Column:
    """Deterministic draw in [0, 1) for one record."""
    return hash48(seed, salt, key).cast("double") / F.lit(float(1 << 48))


def weighted_choice(draw: Column, weights: Mapping[str, float]) -> Column:
    """Option whose cumulative-weight interval holds ``draw``."""
    total = sum(weights.values())
    options = list(weights)
    out, running = None, 0.0
    for option in options[:-1]:
        running += weights[option] / total
        edge = F.lit(running)
        out = F.when(draw < edge, option) if out is None else out.when(draw < edge, option)
    return F.lit(options[-1]) if out is None else out.otherwise(options[-1])


def dollars(amount: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.coalesce(amount, F.lit(0.0)), 2))
