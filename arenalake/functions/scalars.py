"""Column-to-Column helpers. Catalyst sees through them, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Source team codes and their names.
TEAM_CODES = {"100": "BLUE", "200": "RED"}

# Item categories in upgrade order; the rank is the position, starting at 1.
ITEM_TIERS = ["Trinket", "Consumable", "Starter", "Basic", "Boots", "Epic", "Legendary"]


def _c(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def pascal_to_title_case(value: Column | str) -> Column:
    """`TwistedFate` -> `Twisted Fate`."""
    spaced = F.regexp_replace(_c(value), "([a-z])([A-Z])", "$1 $2")
    return F.initcap(F.trim(spaced))


def safecast_to_int(value: Column | str) -> Column:
    """Numeric text to INT, rounded half away from zero; NULL when it does not fit."""
    return F.round(_c(value).try_cast("double"), 0).try_cast("int")


def within(value: Column | str, low: Column, high: Column) -> Column:
    """The value when `low <= value <= high`, else NULL."""
    value = _c(value)
    return F.when(value.between(low, high), value)


def valid_num_range(value: Column | str, low: float | Column, high: float | Column) -> Column:
    """Range guard on DOUBLE."""
    bounds = [x if isinstance(x, Column) else F.lit(float(x)) for x in (low, high)]
    return within(_c(value).cast("double"), *bounds)


def valid_ts_range(value: Column | str, low: Column, high: Column) -> Column:
    """Range guard on TIMESTAMP."""
    return within(_c(value).cast("timestamp"), low.cast("timestamp"), high.cast("timestamp"))


def nullify_caplen(value: Column | str, max_len: int | Column) -> Column:
    """NULL when the text is longer than `max_len` characters."""
    value = _c(value)
    return F.when(F.length(value) <= (max_len if isinstance(max_len, Column) else F.lit(max_len)), value)


def code_map(value: Column | str, mapping: dict) -> Column:
    """Code to label; codes outside the mapping give NULL."""
    value = _c(value)
    chain = F
    for code, label in mapping.items():
        chain = chain.when(value == F.lit(code), F.lit(label))
    return chain


def team_from_code(value: Column | str) -> Column:
    return code_map(value, TEAM_CODES)


def team_from_position(position: Column | str) -> Column:
    """Seats 1-5 are BLUE, 6-10 RED, anything else NULL."""
    position = _c(position)
    return F.when(position.between(1, 5), F.lit("BLUE")).when(position.between(6, 10), F.lit("RED"))


def cyclic_position(player_id: Column) -> Column:
    """Seat 1..10 from a running player number.

    The truncated remainder leaves 0 and negative numbers outside 1..10 on purpose: such
    rows fail the seat rule and are dropped.
    """
    return (player_id - 1) % 10 + 1


def normalise_role(role: Column | str) -> Column:
    role = F.upper(_c(role))
    return F.when(role == "UTILITY", F.lit("SUPPORT")).otherwise(role)


def tier_rank(category: Column | str) -> Column:
    """1..7 by upgrade order; other categories have no rank."""
    return code_map(category, {name: rank for rank, name in enumerate(ITEM_TIERS, start=1)})


def ban_list(value: Column | str) -> Column:
    """Comma text to INT array; the -1 "no ban" mark becomes 0, bad entries NULL."""
    as_int = lambda part: part.try_cast("int")
    return F.transform(F.split(_c(value), ","), lambda part: F.when(as_int(part) == -1, F.lit(0)).otherwise(as_int(part)))


def held_items(slots: list[str]) -> Column:
    """Filled inventory slots as an array."""
    return F.array_compact(F.array(*[F.col(slot) for slot in slots]))


def kda(kills: str = "kills", deaths: str = "deaths", assists: str = "assists") -> Column:
    """(kills + assists) / (deaths + 1); NULL instead of a division error."""
    return F.try_divide(F.col(kills) + F.col(assists), F.col(deaths) + 1)


def rate(part: Column, whole: Column, digits: int = 4) -> Column:
    """Rounded ratio; NULL when the denominator is 0 or NULL."""
    return F.round(F.try_divide(part, whole), digits)


def unlogged_duration(duration: Column, last_minute: Column) -> Column:
    """Seconds after the last snapshot. `greatest` skips NULL, so an unknown duration gives 0."""
    return F.greatest(duration - last_minute * 60, F.lit(0))


def key_fraction(*keys: str, seed: int = 42) -> Column:
    """Repeatable number in [0, 1) from seed and row key, for splits, folds and samples."""
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(float(2**32))
