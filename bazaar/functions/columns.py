"""Column-level building blocks (pure ``Column -> Column`` functions).

Everything here compiles to built-in Catalyst expressions, so it stays in
whole-stage codegen; no Python runs per row.

Numeric policy
--------------
* Integer cents are scaled to exact decimals (``scale_cents``).
* Sums run on decimals, so the total does not depend on row order; a rate
  that is the same for all rows of a group divides the sum once.
* Ratios and rates are computed on doubles (IEEE division is the same on
  every engine) and rounded half-up with ``round_half_up``.
* Money leaves a mart as DOUBLE (``to_money``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_DEC = "decimal(22,2)"     # scaled cents, exact
MONEY_SUM = "decimal(32,2)"     # their sum
# Numbers out of JSON text: 16 digits before and 12 after the point.  Their sum
# has type decimal(38,12), so up to 10 billion rows a group cannot overflow.
JSON_DEC = "decimal(28,12)"
JSON_OPTIONS = {"allowUnquotedControlChars": "true", "allowNonNumericNumbers": "false"}


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def scale_cents(c: str | Column) -> Column:
    """Integer cents -> exact decimal units (``x / 100``)."""
    return (col(c).cast("decimal(20,0)") * F.lit(Decimal("0.01"))).cast(MONEY_DEC)


def sum_cents(c: str | Column) -> Column:
    """Aggregate: ``F.sum(scale_cents(c))`` of a bigint column, of the same value and type.

    The sum is taken in two bigint halves, exact for up to 2^31 rows a group:
    adding decimals of more than 18 digits costs many times as much.
    """
    x = col(c)
    high, low = F.sum(F.shiftright(x, 32)), F.sum(x.bitwiseAND(F.lit(0xFFFFFFFF)))
    total = high.cast("decimal(20,0)") * F.lit(Decimal(1 << 32)) + low.cast("decimal(20,0)")
    return (total * F.lit(Decimal("0.01"))).cast(MONEY_SUM)


def cents_to_money(c: str | Column) -> Column:
    """Integer cents -> units as DOUBLE, for per-row use (no sum).

    Equal to ``to_money(scale_cents(c))``: the division of an exact integer
    by 100 is correctly rounded, i.e. the nearest double to the decimal.
    """
    return col(c).cast("double") / F.lit(100.0)


def to_money(c: str | Column) -> Column:
    """Final representation of a money column in a mart contract."""
    return col(c).cast("double")


def to_double(c: str | Column) -> Column:
    return col(c).cast("double")


def round_half_up(c: str | Column, scale: int = 2) -> Column:
    """ROUND(x, scale), half away from zero, on the decimal form of x.

    For doubles Spark's ``round`` already rounds the shortest decimal
    representation half-up, which is what a reader of the number expects
    (1.005 -> 1.01).
    """
    return F.round(col(c), scale)


def round_double(c: str | Column, scale: int = 2) -> Column:
    """``round_half_up`` of a DOUBLE, equal in every case.

    Where the next whole unit is clear (less than 0.49 of the last place away,
    and few enough digits for exact arithmetic), it is taken; only near a tie
    the decimal form decides.  Reads ``c`` several times: give a column.
    """
    x, unit = col(c), F.lit(10.0 ** scale)
    near = F.rint(x * unit)
    clear = (F.abs(x) < 1e11) & (F.abs(x * unit - near) < 0.49)
    return F.when(clear, near / unit + F.lit(0.0)).otherwise(round_half_up(x, scale))  # + 0.0: no negative zero


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``, 0 when the denominator is 0 or NULL (as a double)."""
    n, d = to_double(num), to_double(den)
    return F.when(d.isNull() | (d == 0), F.lit(0.0)).otherwise(n / d)


def net_of_rate(amount: str | Column, rate: str | Column) -> Column:
    """``amount / (1 + rate)`` with NULL (not an error) for a zero divisor."""
    return F.try_divide(to_double(amount), F.lit(1.0) + to_double(rate))


def composite_id(*parts: str | Column, null_safe: bool = False) -> Column:
    """String id from parts.

    ``null_safe=False`` is CONCAT (any NULL part gives NULL);
    ``null_safe=True`` is CONCAT_WS('') (NULL parts are skipped, all-NULL
    gives '').
    """
    cols = [col(p).cast("string") for p in parts]
    return F.concat_ws("", *cols) if null_safe else F.concat(*cols)


def json_fields(doc: str | Column) -> Column:
    """A JSON object parsed once into a map of its top-level fields' texts.

    Read fields with ``json_field``: together they follow
    ``get_json_object(doc, '$.key')``, which parses once per path.  A document
    that is no complete JSON object gives NULL.
    """
    return F.from_json(col(doc), "map<string, string>", JSON_OPTIONS)


def json_field(fields: str | Column, key: str) -> Column:
    """Text of a field: its first value that is not null where the key is
    repeated (the map keeps repeated keys in order), nested values as JSON."""
    m = col(fields)
    told = F.filter(F.map_entries(m), lambda e: (e["key"] == F.lit(key)) & e["value"].isNotNull())
    return F.coalesce(F.try_element_at(m, F.lit(key)), F.try_element_at(told, F.lit(1))["value"])


def json_pick(doc: str | Column, *keys: str) -> Column:
    """Some fields of a JSON object as a struct of texts: for every key what
    ``json_field(json_fields(doc), key)`` gives.

    An object that holds no escape and the text of each key once at most
    cannot repeat a key: it is parsed for these fields alone.  Text that
    begins with a letter is no object and is not parsed.
    """
    d = col(doc)
    kind = T.StructType([T.StructField(k, T.StringType()) for k in keys])
    plain = F.startswith(d, F.lit("{")) & ~F.contains(d, F.lit("\\"))
    for k in keys:
        plain = plain & (F.position(F.lit(k), d, F.instr(d, k) + 1) == 0)  # no second occurrence
    first = F.ascii(d)
    letter = first.between(65, 90) | first.between(97, 122)
    whole = F.transform(F.array(json_fields(d)), lambda m: F.struct(*[json_field(m, k).alias(k) for k in keys]))[0]
    return (F.when(letter, F.lit(None).cast(kind)).when(plain, F.from_json(d, kind, JSON_OPTIONS)).otherwise(whole))


def json_decimal(fields: str | Column, key: str) -> Column:
    """Number of a field as an exact decimal, rounded half up to 12 places;
    NULL for a missing field, for text that is no finite number, and for
    numbers of more than 16 digits before the point."""
    return decimal_text(json_field(fields, key))


def decimal_text(text: str | Column) -> Column:
    return col(text).try_cast(JSON_DEC)


def first_nonempty(*cs: str | Column) -> Column:
    """First argument that is neither NULL nor ''."""
    return F.coalesce(*[F.nullif(col(c), F.lit("")) for c in cs])


def first_nonempty_json(doc: str | Column, *keys: str) -> Column:
    """First non-empty of several JSON paths of the same document (one parse)."""
    # transform over a one-element array names the parsed document, so it is parsed once
    return F.transform(F.array(json_fields(doc)), lambda m: first_nonempty(*[json_field(m, k) for k in keys]))[0]


def value_map(c: str | Column, mapping: Mapping, default=None) -> Column:
    """Simple CASE: ``CASE c WHEN k1 THEN v1 ... ELSE default END``."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(col(c) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col(c) == F.lit(k), F.lit(v)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def level_of(c: str | Column, levels: Mapping[str, int]) -> Column:
    """Name -> level (NULL for names outside the map)."""
    expr = None
    for name, lvl in levels.items():
        cond = col(c) == F.lit(name)
        expr = F.when(cond, F.lit(lvl)) if expr is None else expr.when(cond, F.lit(lvl))
    return expr if expr is not None else F.lit(None).cast("int")


def parse_day(c: str | Column, formats: Iterable[str] = ("yyyyMMdd", "yyyy-MM-dd")) -> Column:
    """Day string in any of ``formats`` -> DATE; NULL when none parses."""
    return F.coalesce(*[F.try_to_date(col(c), f) for f in formats])


def day_key(d) -> str:
    """A day given as date / 'yyyy-MM-dd' / 'yyyyMMdd' -> 'yyyyMMdd'."""
    s = str(d)
    return s.replace("-", "")[:8]


def day_between(c: str | Column, start=None, end=None) -> Column:
    """Bounds on a raw day string in either form (``yyyyMMdd`` or
    ``yyyy-MM-dd``), both ends included, None for open.

    Each form is compared with the bound in its own form.  A dashed key sorts
    before the plain one of the same day, so ``dt >= dashed start`` and
    ``dt <= plain end`` hold for either form too: these plain comparisons are
    what the scan gets pushed down.
    """
    d, out = col(c).cast("string"), F.lit(True)  # partition values may be read as numbers
    dashed = F.substring(d, 5, 1) == F.lit("-")
    if start is not None:
        plain = day_key(start)
        own = f"{plain[:4]}-{plain[4:6]}-{plain[6:]}"
        out = (d >= F.lit(own)) & (dashed | (d >= F.lit(plain)))
    if end is not None:
        plain = day_key(end)
        own = f"{plain[:4]}-{plain[4:6]}-{plain[6:]}"
        upper = (d <= F.lit(plain)) & (~dashed | (d <= F.lit(own)))
        out = upper if start is None else out & upper
    return out


def epoch_millis(ts: str | Column) -> Column:
    """Milliseconds since 1970-01-01 of a wall-clock timestamp.

    Computed from the date and the time-of-day fields, so the result does
    not depend on the session time zone (TIMESTAMP_NTZ semantics).
    """
    t = col(ts)
    secs = F.extract(F.lit("SECOND"), t)            # decimal(8,6), with fraction
    return (F.unix_date(F.to_date(t)).cast("bigint") * F.lit(86_400_000)
            + F.hour(t).cast("bigint") * F.lit(3_600_000)
            + F.minute(t).cast("bigint") * F.lit(60_000)
            + F.floor(secs * F.lit(1000)).cast("bigint"))

