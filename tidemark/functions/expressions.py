"""Column expressions shared by the operators and the reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Commission rate by tier, ladder order, CPF format and its masked form.
TIER_RATES = {
    "semente": "0.0200",
    "bronze": "0.0300",
    "prata": "0.0500",
    "ouro": "0.0800",
    "diamante": "0.1200",
}
TIER_LADDER = ("semente", "bronze", "prata", "ouro", "diamante")
CPF_FORMAT = "^[0-9]{11}$"
CPF_MASK = "***.***.***-**"

START, END = "__START_AT", "__END_AT"  # the half-open window of a type 2 row


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rate_lookup(col, mapping: Mapping[str, str] = TIER_RATES, type: str = "decimal(5,4)") -> Column:
    """The rate for a value; NULL for a NULL or unknown value, so drift shows as missing data."""
    value, rate = _col(col), None
    for key, number in mapping.items():
        lit = F.lit(Decimal(str(number))).cast(type)
        rate = F.when(value == key, lit) if rate is None else rate.when(value == key, lit)
    return F.lit(None).cast(type) if rate is None else rate


def ladder_step(col, ladder: Sequence[str] = TIER_LADDER) -> Column:
    """One rung up; the top rung stays, a value off the ladder becomes NULL."""
    value, step = _col(col), None
    for here, above in zip(ladder, [*ladder[1:], ladder[-1]]):
        step = F.when(value == here, F.lit(above)) if step is None else step.when(value == here, F.lit(above))
    return step


def align_ts(col) -> Column:
    """Zoneless time as TIMESTAMP (session zone UTC), so both sides of a join share a type."""
    return _col(col).cast("timestamp")


def month_of(col) -> Column:
    """First day of the month, as DATE whichever timestamp type comes in."""
    return F.date_trunc("month", _col(col)).cast("date")


def money(col) -> Column:
    return _col(col).cast("decimal(18,2)")


def required(col, type, what: str) -> Column:
    """The value, failing the job where it is NULL."""
    c = _col(col)
    return F.coalesce(c, F.raise_error(F.lit(f"{what} must not be NULL")).cast(type))


# --- draws that depend on (seed, purpose, id) only, never on the partitioning ---------------

UNIFORM_STEPS = 2**52  # 13 hexadecimal digits


def draw(seed: int, purpose: str, *parts) -> Column:
    """A whole number in [0, 2**52) from the MD5 of seed, purpose and ids."""
    text = F.concat_ws(":", F.lit(str(seed)), F.lit(purpose), *[_col(p).cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")


def uniform(seed: int, purpose: str, *parts) -> Column:
    """A double in [0, 1)."""
    return draw(seed, purpose, *parts) / F.lit(float(UNIFORM_STEPS))


def draw_below(n, seed: int, purpose: str, *parts) -> Column:
    """A whole number in [0, n)."""
    return F.floor(uniform(seed, purpose, *parts) * F.lit(n)).cast("bigint")


def weighted_pick(u: Column, weights: Mapping[str, float]) -> Column:
    """The value whose cumulative share covers ``u``; the last value closes the range."""
    names, reached, pick = list(weights), Decimal(0), None
    for name in names[:-1]:
        reached += Decimal(str(weights[name]))
        hit = u < F.lit(float(reached))
        pick = F.when(hit, F.lit(name)) if pick is None else pick.when(hit, F.lit(name))
    return F.lit(names[-1]) if pick is None else pick.otherwise(F.lit(names[-1]))


def lognormal(mu: float, sigma: float, seed: int, purpose: str, *parts) -> Column:
    """Lognormal draw (Box-Muller on two uniforms), rounded to cents."""
    radius = F.sqrt(F.lit(-2.0) * F.log(F.lit(1.0) - uniform(seed, f"{purpose}/r", *parts)))
    angle = F.cos(F.lit(2.0) * F.pi() * uniform(seed, f"{purpose}/a", *parts))
    return F.round(F.exp(F.lit(mu) + F.lit(sigma) * radius * angle), 2)


# --- CPF check digits -------------------------------------------------------------------------


def _weighted(base: Column, top_weight: int) -> Column:
    """Sum of the nine base digits weighted top_weight, top_weight-1, ..."""
    return sum(
        (F.substring(base, i + 1, 1).cast("int") * F.lit(top_weight - i) for i in range(9)),
        start=F.lit(0),
    )


def _check_digit(total: Column) -> Column:
    """11 minus the rest by 11, where 10 and 11 count as 0."""
    return (F.lit(11) - total % 11) % 11 % 10


def cpf_from_base(base: Column) -> Column:
    """Nine digits to a full CPF of eleven."""
    first = _check_digit(_weighted(base, 10))
    second = _check_digit(_weighted(base, 11) + first * 2)
    return F.concat(base, first.cast("string"), second.cast("string"))


def cpf_is_valid(col) -> Column:
    """Eleven digits of which the last two are the right check digits."""
    c = _col(col)
    return F.coalesce(F.when(c.rlike(CPF_FORMAT), c == cpf_from_base(F.substring(c, 1, 9))), F.lit(False))
