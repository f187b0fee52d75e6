"""Column-level helpers. All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.schemas import (
    PITCH_LENGTH,
    POSITION_GROUPS,
    SAFE_INT_DEFAULT,
    ZONE_CUTS,
)


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def zone_of(x="x", cuts=ZONE_CUTS) -> Column:
    """Third of the pitch along x. Null x falls through to 'ataque', as the
    original job's ``otherwise`` does."""
    x = _c(x)
    return (F.when(x <= cuts[0], "defensa")
            .when(x <= cuts[1], "medio")
            .otherwise("ataque"))


def zone_relative(x="x", team="player_equipo", cuts=ZONE_CUTS,
                  length=PITCH_LENGTH, mirrored_team="B") -> Column:
    """Zone seen from the player's own goal: team B attacks towards x=0,
    so its x is mirrored before bucketing."""
    x, team = _c(x), _c(team)
    return zone_of(F.when(team == mirrored_team, F.lit(length) - x).otherwise(x), cuts)


def pct(num, den, scale: int = 1) -> Column:
    """round(num / den * 100, scale) with 0.0 when the denominator is not
    positive; the guard also keeps ANSI mode from raising on /0."""
    num, den = _c(num), _c(den)
    return F.round(F.when(den > 0, num / den * 100).otherwise(F.lit(0.0)), scale)


#: Doubles closer to zero than 2^-170 have the code of zero, so that a code and
#: a 64-bit tiebreak together fit a decimal(38,0).
_LEAST_EXPONENT = -170
_DEC = "decimal(38,0)"


def order_code(x) -> Column:
    """An integer that orders doubles as they are ordered: sign, binary
    exponent and all 52 bits of the fraction, so unlike doubles (beyond
    2^-170) have unlike codes. Null and NaN give null."""
    x = _c(x).cast("double")
    a = F.abs(x)
    # the logarithm may be off in its last places: with the surplus, the
    # exponent is right or one too high, which the fraction tells
    guess = F.floor(F.log2(a) + 1e-9)
    part = a / F.pow(F.lit(2.0), guess)
    high = (part < 1).cast("bigint")
    code = (guess - high - _LEAST_EXPONENT + 1) * F.lit(1 << 52) + ((part * (high + 1) - 1) * F.lit(float(1 << 52))).cast("bigint")
    top = F.lit((1024 - _LEAST_EXPONENT + 1) * (1 << 52))
    size = F.when(a < 2.0 ** _LEAST_EXPONENT, F.lit(0)).when(a > 1.7976931348623157e308, top).otherwise(code)
    return F.when(~F.isnan(x), F.signum(x).cast("bigint") * size)


def time_part(ts="timestamp") -> Column:
    """The time's share of ``time_order_key``: its order code times 2^64. A
    null time counts as the earliest. Project it once where several keys need
    it: Spark would evaluate it for each."""
    least = F.lit(-(1024 - _LEAST_EXPONENT + 2) * (1 << 52))
    return (F.coalesce(order_code(ts), least).cast(_DEC) * F.lit(str(1 << 64)).cast(_DEC)).cast(_DEC)


def time_order_key(ts="timestamp", tiebreak=None, value=None, time: Column | None = None) -> Column:
    """(event time, tiebreak) packed into one ``decimal(38,0)``: the order code
    of the time times 2^64, plus the tiebreak as an unsigned number. Where the
    tiebreak is null or not given, the order code of ``value`` takes its place,
    so of several rows at one time the largest value counts, in whatever order
    they come. A null time counts as the earliest, so an event of unknown time
    never overrides a known one. A single decimal (unlike a struct) is a valid
    buffer type for hash aggregation, so ``max_by`` over it stays a
    HashAggregate instead of sorting every map partition. ``time`` is the
    projected ``time_part`` of ``ts``, where there is one."""
    ties = [t for t in (None if tiebreak is None else _c(tiebreak).cast("bigint"), None if value is None else order_code(value)) if t is not None]
    tie = F.coalesce(*ties, F.lit(-(1 << 63))).cast(_DEC) + F.lit(str(1 << 63)).cast(_DEC)
    return ((time_part(ts) if time is None else time) + tie).cast(_DEC)


def latest(value, ts="timestamp", tiebreak=None, time: Column | None = None) -> Column:
    """Value of the latest row (by event time, then tiebreak, then value)
    among rows where the value is not null. Order-independent (unlike
    ``last``), so the answer does not depend on partitioning or arrival order;
    a partial hash aggregate that also works in streaming state."""
    value = _c(value)
    return F.max_by(value, F.when(value.isNotNull(), time_order_key(ts, tiebreak, value, time)))


def count_where(cond: Column) -> Column:
    """Number of rows where ``cond`` is true; null counts as false."""
    return F.count(F.when(cond, F.lit(1)))


def safe_int(c, default: int = SAFE_INT_DEFAULT) -> Column:
    """Integer parse with a default: ' 85 ' -> 85, '85.0'/''/'x' -> default."""
    return F.coalesce(F.trim(_c(c).cast("string")).try_cast("bigint"),
                      F.lit(default).cast("bigint"))


def position_group(pos="posicion") -> Column:
    """GK/DEF/MID/FWD for a position code; null when in no group."""
    pos = F.trim(_c(pos))
    expr = None
    for grp, codes in POSITION_GROUPS.items():
        expr = (F.when(pos.isin(*codes), grp) if expr is None
                else expr.when(pos.isin(*codes), grp))
    return expr


def clamp(c, lo: float, hi: float) -> Column:
    return F.least(F.greatest(_c(c), F.lit(lo)), F.lit(hi))


def dist2(x="x", y="y", bx="ball_x", by="ball_y") -> Column:
    """Squared distance, written as products so every engine rounds alike."""
    dx = _c(x) - _c(bx)
    dy = _c(y) - _c(by)
    return dx * dx + dy * dy


def tenths(c) -> Column:
    """A one-decimal double as an exact integer number of tenths."""
    return F.round(_c(c) * 10).cast("bigint")


def avg_tenths(c) -> Column:
    """Mean of a one-decimal column, summed as integers and divided once,
    so the result does not depend on summation order."""
    c = _c(c)
    n = F.count(c)
    return F.when(n > 0, F.sum(tenths(c)) / (F.lit(10.0) * n))


def doc_id(match="match_id", player="player_id", faithful: bool = True) -> Column:
    """Document id ``<match>_<player>``. Faithful mode prints a missing part
    as 'None' (the original formats a Python None)."""
    m, p = _c(match), _c(player)
    if faithful:
        return F.concat(F.coalesce(m, F.lit("None")), F.lit("_"), F.coalesce(p, F.lit("None")))
    return F.concat_ws("_", m, p)


def iso_utc(ts: Column | None = None) -> Column:
    """ISO-8601 seconds in UTC, e.g. 2024-01-31T00:00:00Z; processing time
    by default. Shifted from the session zone so the text is UTC whatever
    ``spark.sql.session.timeZone`` says."""
    ts = F.current_timestamp() if ts is None else ts
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()),
                         "yyyy-MM-dd'T'HH:mm:ss'Z'")
