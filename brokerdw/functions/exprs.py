"""Pure ``Column -> Column`` builders. No UDFs: every expression stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values of the input formats -------------------------------------
STATUS_NAMES = {
    "ACTV": "Active",
    "CMPT": "Completed",
    "CNCL": "Canceled",
    "PNDG": "Pending",
    "SBMT": "Submitted",
    "INAC": "Inactive",
}
TRADE_TYPE_NAMES = {
    "TMB": "Market Buy",
    "TMS": "Market Sell",
    "TSL": "Stop Loss",
    "TLS": "Limit Sell",
    "TLB": "Limit Buy",
}
ACTION_STATUS = {
    "NEW": "Active",
    "ADDACCT": "Active",
    "UPDACCT": "Active",
    "UPDCUST": "Active",
    "CLOSEACCT": "Inactive",
    "INACT": "Inactive",
}
# Investment grades first, low grades second.
HIGH_GRADES = ["AAA", "AA+", "AA", "AA-", "A+", "A", "A-", "BBB+", "BBB", "BBB-"]
LOW_GRADES = ["BB+", "BB", "BB-", "B+", "B", "B-", "CCC+", "CCC", "CCC-", "CC", "C", "D"]
RATINGS = HIGH_GRADES + LOW_GRADES
# Open end of a validity interval.
OPEN_END = "9999-12-31"
# ---------------------------------------------------------------------------


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def decode(c: Column | str, table: dict[str, str]) -> Column:
    """Code to name, null for an unknown code."""
    pairs = [part for code, name in table.items() for part in (F.lit(code), F.lit(name))]
    return F.element_at(F.create_map(*pairs), col(c))


def decode_status(c: Column | str) -> Column:
    return decode(c, STATUS_NAMES)


def decode_trade_type(c: Column | str) -> Column:
    return decode(c, TRADE_TYPE_NAMES)


def decode_action(c: Column | str) -> Column:
    return decode(c, ACTION_STATUS)


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def format_phone(country, area, local, ext) -> Column:
    """``+country (area) local`` followed by the extension; null without a local number."""
    prefix = F.concat(
        F.coalesce(F.concat(F.lit("+"), blank_to_null(country), F.lit(" ")), F.lit("")),
        F.coalesce(F.concat(F.lit("("), blank_to_null(area), F.lit(") ")), F.lit("")),
    )
    return F.concat(prefix, blank_to_null(local), F.coalesce(col(ext), F.lit("")))


def nameplate(networth, income, children, cards, age, cars, credit) -> Column:
    """Marketing tags of a prospect joined by ``+``; empty text when no rule fires."""
    worth, income, children = col(networth), col(income).try_cast("long"), col(children)
    cards, age, cars, credit = col(cards), col(age), col(cars), col(credit)
    rules = [
        ("HighValue", (worth > 1000000) | (income > 200000)),
        ("Expenses", (children > 3) | (cards > 5)),
        ("Boomer", age > 45),
        ("MoneyAlert", (income < 50000) | (credit < 600) | (worth < 100000)),
        ("Spender", (cars > 3) | (cards > 7)),
        ("Inherited", (age < 25) & (worth > 1000000)),
    ]
    return F.concat_ws("+", *[F.when(rule, F.lit(tag)) for tag, rule in rules])


def rating(c: Column | str) -> Column:
    """The credit rating if it is a known one, else null."""
    return F.when(col(c).isin(RATINGS), col(c))


def is_low_grade(c: Column | str) -> Column:
    return F.when(col(c).isin(HIGH_GRADES), F.lit(False)).when(col(c).isin(LOW_GRADES), F.lit(True))


def norm_gender(c: Column | str) -> Column:
    letter = F.upper(col(c))
    return F.when(letter.isin("M", "F"), letter).otherwise(F.lit("U"))


# Keys of days and times are calculated: formatting a date and reading the text back costs several times as much.
def date_key(c: Column | str) -> Column:
    """The day as the number ``yyyyMMdd``; a year before 0 makes it negative."""
    year, rest = F.year(col(c)).cast("bigint"), F.month(col(c)) * 100 + F.dayofmonth(col(c))
    return year * 10000 + F.when(year < 0, -rest).otherwise(rest)


def time_key(c: Column | str) -> Column:
    return (F.hour(col(c)) * 10000 + F.minute(col(c)) * 100 + F.second(col(c))).cast("bigint")


def smart_key(date: Column | str, key: Column | str) -> Column:
    """Surrogate key: the day written as ``yyyyMMdd`` followed by the natural key."""
    return F.concat(date_key(date).cast("string"), col(key).cast("string")).cast("bigint")


def stable_key(*cols: Column | str) -> Column:
    """Reproducible 60-bit surrogate key of a natural key."""
    text = F.concat_ws("|", *[col(c).cast("string") for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def try_long(text: Column) -> Column:
    """``text`` as a number, null if it is none.

    A failing cast raises and catches an error for each row, which costs more than the rest of a
    row's work; a text that begins with a letter or with a sign behind the digits is not tried.
    """
    return F.when(~F.ascii(text).between(ord("9") + 1, ord("~")), text.try_cast("bigint"))


def try_date8(text: Column) -> Column:
    """``yyyyMMdd`` as a date, null if it is none; eight digits are cut and cast, other texts are not tried."""
    iso = F.concat_ws("-", F.substring(text, 1, 4), F.substring(text, 5, 2), F.substring(text, 7, 2))
    return F.when(text.rlike(r"\A[0-9]{8}\z"), iso.try_cast("date"))


def norm_company_ref(c: Column | str) -> Column:
    """Company name, or company number without leading zeros."""
    text = F.trim(col(c))
    return F.coalesce(try_long(text).cast("string"), text)


def full_years(start: Column | str, end: Column | str) -> Column:
    """Whole years from ``start`` to ``end``."""
    return F.timestamp_diff("YEAR", col(start).cast("timestamp"), col(end).cast("timestamp"))


def match_key(c: Column | str, nullable: bool = False) -> Column:
    """Case-insensitive comparison form; ``nullable`` treats null as blank."""
    base = F.coalesce(col(c), F.lit("")) if nullable else col(c)
    return F.upper(base)
