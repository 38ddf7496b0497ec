"""Column expressions used across the catalogue.

Sums of doubles do not depend on the order in which partitions are merged; a plain double sum
changes from run to run. Each value is split without error into whole multiples of fixed steps,
22 bits apart from 2**-68 to 2**63, and the multiples are added up as BIGINTs, which leaves
room for 2**41 rows of a group. The six totals are put together without intermediate rounding, so
the sum is the exact one rounded once, as close as a double gets.

What lies below 2**-68 or beyond 2**63 goes to one double sum beside them. It is exact as well for
remainders of values of some 1e-12 or more; NaN and infinities give what IEEE addition gives. So
every double can be summed.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits between two steps, and the upper exponent of each step taken at once: two steps are
# 2**(e) and 2**(e + STEP).
STEP = 22
EXPONENTS = (20, -24, -68)
# The largest part of a value that is split.
MOST = float(1 << 63)

# Fixed order of the weekdays.
WEEK = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _scaled(x: str, exponent: int) -> str:
    return f"(({x}) * {2.0**exponent!r}D)"


def _pieces_sql(x: str) -> tuple[list[str], str]:
    """`x` as whole multiples of 2**20, 2**-24 and 2**-68, and what is left of it.

    There is no branch in them, so that each part is computed once for all sums that take it.
    For NULL the multiples are 0 and what is left is NULL.
    """
    split = f"greatest(least(coalesce({x}, 0D), {MOST!r}D), {-MOST!r}D)"
    rest, multiples = split, []
    for exponent in EXPONENTS:
        # Cut towards zero: both the multiple and the remainder are exact.
        multiple = f"cast({_scaled(rest, -exponent)} as bigint)"
        multiples.append(multiple)
        rest = f"({rest} - {_scaled(multiple, exponent)})"
    return multiples, f"{rest} + ({x} - {split})"


def _totals_sql(expression: str) -> str:
    """Aggregate of the totals of all steps and of what is left, as a struct."""
    multiples, rest = _pieces_sql(f"cast({expression} as double)")
    totals = []
    for i, multiple in enumerate(multiples):
        totals += [
            f"'s{2 * i}', sum(shiftright({multiple}, {STEP}))",
            f"'s{2 * i + 1}', sum({multiple} & {(1 << STEP) - 1})",
        ]
    return f"named_struct({', '.join(totals)}, 'rest', sum({rest}))"


def _put_together_sql(totals: str) -> str:
    """The double a struct of totals stands for."""
    low_bits, wide = (1 << STEP) - 1, 1 << STEP
    # Carry what exceeds STEP bits upwards, so that the totals no longer overlap.
    digits, carried = [], "t.s5"
    for i in range(4, -1, -1):
        digits.insert(0, f"({carried} & {low_bits})")
        carried = f"(t.s{i} + shiftright({carried}, {STEP}))"
    parts = {
        "a": _scaled(carried, EXPONENTS[0] + STEP),
        "b": _scaled(f"{digits[0]} * {wide} + {digits[1]}", EXPONENTS[1] + STEP),
        "c": _scaled(f"{digits[2]} * {wide} + {digits[3]}", EXPONENTS[2] + STEP),
        "d": f"{_scaled(digits[4], EXPONENTS[2])} + t.rest",
    }
    apart = ", ".join(f"'{name}', {part}" for name, part in parts.items())
    # Each part is smaller than a unit of the one before: what an addition rounds off is exact.
    whole = "u.a + u.b + u.c + ((u.b - (u.a + u.b - u.a)) + (u.c - (u.a + u.b + u.c - (u.a + u.b))) + u.d)"
    return f"get(transform(transform(array({totals}), t -> named_struct({apart})), u -> {whole}), 0)"


def exact_sum_sql(expression: str) -> str:
    """Order-independent sum of doubles as SQL text, NULL for a group without values."""
    return _put_together_sql(_totals_sql(expression))


def exact_totals(column: str) -> Column:
    """What exact_sum adds up, as a struct: totals of groups can be joined by `sum_of_totals`."""
    return F.expr(_totals_sql(f"`{column}`"))


def sum_of_totals(column: str) -> Column:
    """exact_sum over all rows behind the `exact_totals` of several groups."""
    sums = ", ".join(f"'{name}', sum(`{column}`.{name})" for name in [*(f"s{i}" for i in range(6)), "rest"])
    return F.expr(_put_together_sql(f"named_struct({sums})"))


def exact_sum(column: str) -> Column:
    """Order-independent sum of a column of numbers, NULL for a group without values."""
    return F.expr(exact_sum_sql(f"`{column}`"))


def exact_avg_sql(expression: str) -> str:
    """Order-independent mean as SQL text, NULL for a group without values."""
    return f"try_divide({exact_sum_sql(expression)}, count({expression}))"


def exact_avg(column: str) -> Column:
    """Order-independent mean of a column of numbers, NULL for a group without values."""
    return F.expr(exact_avg_sql(f"`{column}`"))


def sum_or_zero(column: str) -> Column:
    """exact_sum with 0 for a group without values (dashboard roll-ups)."""
    return F.coalesce(exact_sum(column), F.lit(0.0))


def count_or_zero(column: str) -> Column:
    """Integer sum with 0 for a group without values (dashboard roll-ups)."""
    return F.coalesce(F.sum(column), F.lit(0))


def holiday_label(flag: str | Column) -> Column:
    """'Holiday' for true, 'Non-Holiday' for everything else, NULL included."""
    return F.when(_col(flag), "Holiday").otherwise("Non-Holiday")


def holiday_label_or_null(flag: str | Column) -> Column:
    """Dictionary form of the label: an unknown flag stays unknown."""
    c = _col(flag)
    return F.when(c, "Holiday").when(~c, "Non-Holiday")


def day_name(ts: str | Column) -> Column:
    return F.date_format(_col(ts), "EEEE")


def year_month(ts: str | Column) -> Column:
    return F.date_format(_col(ts), "yyyy-MM")


def weekday_position(name: str | Column) -> Column:
    """1 for Monday to 7 for Sunday, 0 for anything else."""
    return F.array_position(F.array(*[F.lit(d) for d in WEEK]), _col(name))


def within_days(ts: str | Column, first: dt.date | str, last: dt.date | str) -> Column:
    """Inclusive range of days as a half-open range on the raw column.

    The column is not wrapped in to_date, so the comparison reaches the scan.
    """
    c = _col(ts)
    upper = _as_date(last) + dt.timedelta(days=1)
    return (c >= F.lit(_as_date(first).isoformat()).cast("timestamp_ntz")) & (
        c < F.lit(upper.isoformat()).cast("timestamp_ntz")
    )


def one_of(column: str, chosen: Sequence[str] | None) -> Column:
    """Membership in `chosen`; nothing chosen, or 'All', means no restriction."""
    if not chosen or "All" in chosen:
        return F.lit(True)
    return F.col(column).isin(list(chosen))


def _as_date(value: dt.date | str) -> dt.date:
    return value if isinstance(value, dt.date) else dt.date.fromisoformat(value)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
