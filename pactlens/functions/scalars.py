"""Spark SQL expressions for loosely typed source values.

Each function takes SQL text and returns SQL text, to be used in ``selectExpr`` or ``expr``.
One parsed expression is far cheaper to build than the same tree made node by node from Python.
"""

from __future__ import annotations

# Types of money and earning factors.
MONEY = "decimal(18,4)"
MONEY_SUM = "decimal(28,4)"
FACTOR = "decimal(14,10)"
EARNED = "decimal(33,14)"

# Labels written when a source value is missing.
NO_AGENT = "Unassigned"
NO_DEALER = "Unknown Dealer"
NO_PRODUCT = "Unmapped Product Type"
NO_MAKE = "UNMAPPED MAKE"
NO_LOSS_CODE = "UNMAPPED"
NO_LOSS_TEXT = "Description unavailable"
NO_COVERAGE_NAME = "Unmapped Coverage Name"
SENTINELS = ["Unassigned", "Unknown Dealer", "Unmapped", "Unmapped Product Type"]

# What counts as blank at the ends of a text and inside keys and amounts.
_BLANKS = (
    r" \t\n\r\u000b\u000c\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008"
    r"\u2009\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def quoted(*values: str) -> str:
    """String literals, separated by commas."""
    return ", ".join("'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in values)


def unwrapped(value: str) -> str:
    """Text of a value; of an extended-JSON object (number or date) the value it holds (SQL text)."""
    at = lambda key: f"get_json_object({value}, '$.{key}')"
    moment = f"cast(timestamp_millis(try_cast({at('$date.$numberLong')} AS bigint)) AS string)"
    held = [moment, *[at(k) for k in ("$date", "$numberDecimal", "$numberDouble", "$numberLong", "$numberInt")]]
    return f"CASE WHEN startswith({value}, '{{\"$') THEN coalesce({', '.join(held)}) ELSE {value} END"


def text(value: str) -> str:
    """Trimmed text, empty for NULL. Blanks of all kinds are taken off both ends."""
    return f"coalesce({trimmed(f'cast({value} AS string)')}, '')"


def trimmed(value: str) -> str:
    return f"trim(BOTH '{_BLANKS}' FROM {value})"


def trimmed_element(value: str) -> str:
    """``trimmed`` inside a lambda, which is not compiled. Trimming tries every blank on both ends, so a text that
    begins and ends with a visible ASCII character is told by comparison. Outside of lambdas the optimiser
    would multiply the cases in every filter."""
    visible = " AND ".join(f"{c} >= '!' AND {c} < '\\u007f'" for c in (value, f"substr({value}, -1)"))
    return f"CASE WHEN {visible} THEN {value} ELSE {trimmed(value)} END"


def business_id(value: str) -> str:
    return f"upper({without_blanks(value)})"


def without_blanks(value: str) -> str:
    """Text with no blanks at all, empty for NULL."""
    return f"translate(coalesce(cast({value} AS string), ''), '{_BLANKS}', '')"


def or_else(*values: str) -> str:
    """First value that is not empty; the last one is taken as it is."""
    return f"coalesce({', '.join(f'''nullif({v}, '')''' for v in values[:-1])}, {values[-1]})"


def lenient_number(value: str, dtype: str = MONEY) -> str:
    """Number with currency signs, commas, percent signs and blanks ignored; 0 if it is none.

    A decimal cast takes neither ``1d`` nor ``NaN`` nor ``Infinity``, which are 0 here. An amount is
    read with all its digits first: one that does not fit the type stops the query with an overflow
    error and is never taken for 0.
    """
    bare = f"translate(cast({value} AS string), '$,%{_BLANKS}', '')"
    return _number(bare, dtype)


def lenient_element(value: str) -> str:
    """``lenient_number`` of a text inside a lambda: a bare number needs no look at each of its characters."""
    bare = f"translate({value}, '$,%{_BLANKS}', '')"
    return _number(f"CASE WHEN {value} RLIKE '^[-+.0-9]+\\\\z' THEN {value} ELSE {bare} END", MONEY)


def _number(bare: str, dtype: str) -> str:
    wide = f"try_cast({bare} AS decimal(38,4))" if dtype == MONEY else f"try_cast({bare} AS {dtype})"
    return f"coalesce(cast({wide} AS {dtype}), cast(0 AS {dtype}))"


# Usual shapes of dates, and the pattern of their day; ISO forms are cast instead.
_DAY_SHAPES = [
    ("^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}([^0-9]|$)", "M/d/yyyy"),
    ("^[0-9]{4}/[0-9]{1,2}/[0-9]{1,2}([^0-9]|$)", "yyyy/M/d"),
    ("^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}([^0-9]|$)", "M-d-yyyy"),
    ("^[A-Za-z]{3} [0-9]{1,2} [0-9]{4}([^0-9]|$)", "MMM d yyyy"),
    ("^[A-Za-z]{4,9} [0-9]{1,2} [0-9]{4}([^0-9]|$)", "MMMM d yyyy"),
]
_SHORT_YEAR = "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{2}([^0-9]|$)"
_ISO = "^[0-9]{4}(-[0-9]{2}(-[0-9]{2}([T ].*)?)?)?$"


def _plain_day(value: str) -> str:
    """Timestamp of a bare US or ISO day, the most usual spellings: read by casts, without a formatter."""
    part = lambda text_, n: f"substring_index({text_}, '/', {n})"
    us = f"concat({part(value, -1)}, '-', {part(value, 1)}, '-', {part(part(value, 2), -1)})"
    return (
        f"CASE WHEN {value} RLIKE '^[0-9]{{1,2}}/[0-9]{{1,2}}/[1-9][0-9]{{3}}\\\\z' THEN try_cast({us} AS timestamp)"
        f" WHEN {value} RLIKE '^[1-9][0-9]{{3}}-[0-9]{{2}}-[0-9]{{2}}\\\\z' THEN try_cast({value} AS timestamp) END"
    )


def _usual_timestamp(value: str) -> str:
    """Timestamp of the spellings that feeds are full of, in generated code."""
    raw = trimmed(value)
    plain = f"replace({raw}, ',', '')"

    def read(day: str) -> str:
        return (
            f"CASE WHEN upper({plain}) LIKE '%M'"
            f" THEN try_to_timestamp({plain}, '{day} h:mm[:ss[.SSS]] a')"
            f" ELSE try_to_timestamp({plain}, '{day}[ H:mm[:ss[.SSS]]]') END"
        )

    short = read("M/d/yy")
    cases = " ".join(f"WHEN {plain} RLIKE '{shape}' THEN {read(day)}" for shape, day in _DAY_SHAPES)
    return (
        f"date_trunc('second', CASE {cases} WHEN {raw} RLIKE '{_ISO}' THEN CASE WHEN upper({raw})"
        f" LIKE '%M' THEN {read('yyyy-MM-dd')} ELSE try_cast({raw} AS timestamp) END"
        f" WHEN {plain} RLIKE '{_SHORT_YEAR}' THEN CASE WHEN year({short}) >= 2050"
        f" THEN {short} - INTERVAL '100' YEAR ELSE {short} END END)"
    )


# One pattern for all other spellings: a word such as the weekday, a day in one of five orders, a time
# of day with an offset, a zone that means UTC, a remark in brackets. Its groups are put in one order:
# year; month; day; hour; minute; second; AM or PM; offset.
_DATE = (
    "^(?:[A-Za-z]+[.]? +)?"
    "(?:([0-9]{4})[-/ ]([0-9]{1,2})[-/ ]([0-9]{1,2})"
    "|([0-9]{1,2})[-/ ]([0-9]{1,2})[-/ ]([0-9]{4}|[0-9]{2})"
    "|([A-Za-z]{3,})[-./ ]*([0-9]{1,2})[-/ ]+([0-9]{4}|[0-9]{2})"
    "|([0-9]{1,2})[-/ ]*([A-Za-z]{3,})[-./ ]*([0-9]{4}|[0-9]{2})"
    "|([0-9]{4})(?:-([0-9]{2}))?)"
    "(?:(?:[Tt]| +)([0-9]{1,2}):([0-9]{2})(?::([0-9]{2})(?:[.][0-9]*)?)? *([AaPp][Mm])?"
    " *(?:Z|z|UTC|GMT)? *([-+][0-9]{2}:?[0-9]{2})?)?"
    " *(?:Z|UTC|GMT)?(?: *[(][^)]*[)])?$"
)
_DATE_PARTS = "$1$6$9$12$13;$2$4$7$11$14;$3$5$8$10;$15;$16;$17;$18;$19"
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


def _rare_timestamp(value: str) -> str:
    """Timestamp of any spelling: the text is read once, all else is arithmetic on its parts.

    Lambdas are not compiled, so this is some twenty times as dear as a usual spelling.
    """
    plain = f"translate({trimmed(value)}, ',;', ' ?')"
    parts = f"split(regexp_replace({plain}, '{_DATE}', '{_DATE_PARTS}'), ';')"
    number = lambda i: f"try_cast(get(p, {i}) AS int)"
    year = (
        f"{number(0)} + CASE WHEN length(get(p, 0)) > 2 THEN 0 WHEN {number(0)} >= 50 THEN 1900 ELSE 2000 END"
    )
    # a year alone has an empty month, found at the first place: January
    month = f"coalesce({number(1)}, (locate(lower(left(get(p, 1), 3)), '{_MONTHS}') + 3) div 4)"
    hour = (
        f"CASE WHEN get(p, 6) = '' THEN coalesce({number(3)}, 0) WHEN {number(3)} > 12 THEN 25"
        f" ELSE {number(3)} % 12 + CASE WHEN lower(get(p, 6)) = 'pm' THEN 12 ELSE 0 END END"
    )
    offset = "coalesce(try_cast(replace(get(p, 7), ':', '') AS int), 0)"
    fields = (
        f"named_struct('y', {year}, 'm', {month}, 'd', coalesce({number(2)}, 1), 'h', {hour},"
        f" 'i', coalesce({number(4)}, 0), 's', coalesce({number(5)}, 0), 'o', {offset})"
    )
    moment = (
        "CASE WHEN t.m BETWEEN 1 AND 12 AND t.d BETWEEN 1 AND 31 AND t.i < 60 AND t.s < 60"
        " AND t.h * 3600 + t.i * 60 + t.s <= 86400 THEN timestamp_seconds("
        "(unix_date(make_date(t.y, t.m, 1)) + t.d - 1) * 86400L + t.h * 3600 + t.i * 60 + t.s"
        " - (t.o div 100) * 3600 - (t.o % 100) * 60) END"
    )
    # lambdas over one element, so that the parts and the numbers are worked out once
    read = f"filter(array({parts}), p -> size(p) = 8)"
    return f"get(transform(transform({read}, p -> {fields}), t -> {moment}), 0)"


def lenient_timestamp(value: str) -> str:
    """Timestamp to the second of a date in ISO, US or year-first order or with an English month, with or
    without a time of day; else NULL. A time of day alone is no date.

    Parts are joined by dashes, slashes or blanks, commas count as blanks, and a weekday before the day is
    ignored. Days up to 31 run over into the next month (30 February is 1 or 2 March). Two-digit
    years from 50 on are of the last century. Without an offset the time is UTC.
    """
    return (
        f"coalesce({_plain_day(value)}, CASE WHEN {value} RLIKE '[0-9]' THEN"
        f" coalesce({_usual_timestamp(value)}, {_rare_timestamp(value)}) END)"
    )


def lenient_date(value: str) -> str:
    return f"cast({lenient_timestamp(value)} AS date)"


def object_id_timestamp(value: str) -> str:
    """Creation time held in the first eight hex digits of a 24-digit object id."""
    return (
        f"CASE WHEN {value} RLIKE '^[a-fA-F0-9]{{24}}$'"
        f" THEN timestamp_seconds(cast(conv(substr({value}, 1, 8), 16, 10) AS bigint)) END"
    )


def snapshot_timestamp(candidates: str, source_id: str) -> str:
    """First usable one of an array of extraction dates, else the object id's time, else the epoch."""
    # lambdas are not compiled
    usual = f"{_plain_day(f'get({candidates}, 0)')}, {_usual_timestamp(f'get({candidates}, 0)')}"
    first = (
        f"aggregate({candidates}, cast(NULL AS timestamp),"
        f" (found, d) -> coalesce(found, {lenient_timestamp('d')}))"
    )
    return f"coalesce({usual}, {first}, {object_id_timestamp(source_id)}, timestamp_seconds(0))"


def classify_transaction(type_text: str, status: str) -> str:
    kind = f"lower({without_blanks(type_text)})"
    code = f"upper({text(status)})"
    return (
        f"CASE {kind} WHEN 'newbusiness' THEN 'NewBusiness' WHEN 'cancellation' THEN 'Cancellation'"
        f" WHEN 'adjustment' THEN 'Adjustment' WHEN 'upgrade' THEN 'Upgrade'"
        f" ELSE CASE {code} WHEN 'C' THEN 'Cancellation' WHEN 'A' THEN 'NewBusiness'"
        f" WHEN 'E' THEN 'NewBusiness' ELSE 'Unknown' END END"
    )


def mentions_test(*values: str) -> str:
    """True if any of the values names a test entity."""
    return f"contains(lower(concat_ws('|', {', '.join(values)})), 'test')"


def is_sentinel(value: str) -> str:
    return f"({value} IS NULL OR {value} = '' OR {value} IN ({quoted(*SENTINELS)}))"


def half_up(value: str) -> str:
    """Nearest whole number, halves towards plus infinity."""
    return f"floor({value} + 0.5)"


def ratio(part: str, whole: str) -> str:
    """Quotient as double, NULL unless the divisor is positive."""
    return f"CASE WHEN {whole} > 0 THEN cast({part} AS double) / cast({whole} AS double) END"


def variance(current: str, prior: str) -> str:
    """Relative change, NULL if there is nothing to compare with."""
    return f"CASE WHEN {prior} <> 0 THEN ({current} - {prior}) / abs({prior}) END"


def loss_ratio_band(value: str) -> str:
    return (
        f"CASE WHEN {value} IS NULL THEN 'none' WHEN {value} >= 1.0 THEN 'red'"
        f" WHEN {value} >= 0.85 THEN 'amber' ELSE 'green' END"
    )


def loss_ratio_alert(value: str, warning: float, high: float) -> str:
    return (
        f"CASE WHEN {value} > {high}D THEN 'high'"
        f" WHEN {value} BETWEEN {warning}D AND {high}D THEN 'warning' ELSE 'normal' END"
    )


def low_admin_flag(value: str, limit: float = 20.0) -> str:
    return f"coalesce({value} > 0 AND {value} < {limit}, false)"


# Measures for which a rise is bad news.
RISE_IS_BAD = ["earned_loss_ratio", "cancellation_rate", "claims_paid"]


def change_is_good(measure: str, change: str) -> str:
    """NULL when there is no change to judge."""
    return (
        f"CASE WHEN {change} <> 0 THEN"
        f" CASE WHEN {measure} IN ({quoted(*RISE_IS_BAD)}) THEN {change} < 0 ELSE {change} > 0 END"
        f" END"
    )


def dollars(value: str) -> str:
    """Whole dollars with thousands commas."""
    return f"format_number(cast({half_up(value)} AS decimal(28,0)), 0)"


def percent(value: str) -> str:
    return f"format_string('%.1f%%', coalesce({value}, 0D) * 100)"
