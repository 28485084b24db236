"""Money, split and label expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from fundlens import constants as K


def money(c, strict: bool = True) -> Column:
    """'$1,234.50' to double. Bad text raises, or gives NULL when not strict."""
    digits = F.regexp_replace(c, K.MONEY_SYMBOLS, "")
    return digits.cast("double") if strict else digits.try_cast("double")


def safe_div(a: Column, b: Column) -> Column:
    """Quotient as double; NULL for a zero divisor."""
    return a.cast("double") / F.nullif(b, F.lit(0))


def credits_to_usd(total: Column) -> Column:
    return total.cast("double") / K.CREDITS_PER_UNIT * K.USD_PER_UNIT


def match_usd(percentage: Column, pool: Column, round_id: Column) -> Column:
    """Pool share in USD; one round stores its percentages 10^12 too large."""
    share = percentage.cast("double") * pool.cast("double")
    return F.when(round_id == K.RESCALED_ROUND_ID, share / K.RESCALE_DIVISOR).otherwise(share)


def strategy_or_default(c: Column) -> Column:
    """A blank strategy means the first quadratic funding contract."""
    return F.when(c == "", K.QF_V1).otherwise(c)


def strategy_title(c: Column) -> Column:
    titles = F.create_map(*[F.lit(x) for pair in K.STRATEGY_TITLES.items() for x in pair])
    return F.coalesce(F.element_at(titles, c), c)


def chain_of_checkout(c: Column) -> Column:
    out = F.lit(0)
    for kind, chain_id in K.CHECKOUT_CHAINS.items():
        out = F.when(c == kind, chain_id).otherwise(out)
    return out


def null_to_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))
