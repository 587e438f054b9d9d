"""Mixed date and time notations brought to one instant.

A value passes an ordered cascade: the zone mark is split off, then the time of day, then the rest must match
one of the anchored date patterns as a whole. Parsing is strict (30 February is no date). A value without zone
takes the zone its source has in a lookup, and local times that occur twice or never follow a stated policy.
Everything is a column expression, so the whole cascade runs inside code generation next to the scan.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Month names by their first three letters.
MONTHS = {
    "січ": 1, "лют": 2, "бер": 3, "кві": 4, "тра": 5, "чер": 6, "лип": 7, "сер": 8, "вер": 9, "жов": 10, "лис": 11, "гру": 12,
    "jan": 1, "feb": 2, "mar": 3, "apr": 4, "may": 5, "jun": 6, "jul": 7, "aug": 8, "sep": 9, "oct": 10, "nov": 11, "dec": 12,
}
# Zone abbreviations as offsets.
ABBREVIATIONS = {"Z": "+00:00", "UTC": "+00:00", "GMT": "+00:00", "EET": "+02:00", "EEST": "+03:00", "CET": "+01:00", "CEST": "+02:00", "MSK": "+03:00"}
# Region names accepted as zone marks. Kyiv's older spelling is known to every tzdata release.
REGIONS = {"Europe/Kiev": "Europe/Kiev", "Europe/Kyiv": "Europe/Kiev", "Europe/Warsaw": "Europe/Warsaw", "Europe/Berlin": "Europe/Berlin", "Europe/London": "Europe/London", "America/New_York": "America/New_York"}
KYIV = "Europe/Kiev"
# Zone of the values that name none, by source; sources not listed take the operator's default zone.
SOURCE_ZONES = {"edrsr": KYIV, "edr": KYIV, "vat_payers": KYIV, "court_portal": KYIV}

_UA = "|".join(k for k in MONTHS if k > "z")
_EN = "|".join(k for k in MONTHS if k < "z")
#: (pattern of the date part, replacement giving yyyy-M-d, or None where the month is a word in group 2)
DATE_PATTERNS: list[tuple[str, str]] = [
    (r"^(\d{4})([-/.])(\d{1,2})\2(\d{1,2})$", "$1-$3-$4"),
    (r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{4})$", "$4-$3-$1"),
    (r"^(\d{1,2})([-/.])(\d{1,2})\2(\d{2})$", "20$4-$3-$1"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (rf"(?i)^(\d{{1,2}})\s+((?:{_UA})[а-яіїєґ]*)\.?,?\s+(\d{{4}})(?:\s*(?:року|рік|р\.?))?$", "$3-#-$1"),
    (rf"(?i)^((?:{_EN})[a-z]*)\.?\s+(\d{{1,2}}),?\s+(\d{{4}})$", "$3-#-$2"),
    (rf"(?i)^(?:[a-z]{{3,9}},\s*)?(\d{{1,2}})[\s-]+((?:{_EN})[a-z]*)\.?,?[\s-]+(\d{{4}})$", "$3-#-$1"),
]
_ZONE = r"(?:(?<=:\d{2})|(?<=[.,]\d{1,9})|(?<=\d{6})|(?<=\s))\s*(Z|" + "|".join(k for k in ABBREVIATIONS if k != "Z") + r"|(?<=[:.T]\d{2,9}\s?)[+-]\d{2}:?\d{2}|[A-Z][A-Za-z]+/[A-Z][A-Za-z_]+)$"
_TIME = r"[T\s,]\s*(\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d{1,9})?)?)$"


def _lookup(values: Mapping[str, object]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def with_instant(df: DataFrame, column: str, out: str, zone: Column | str = KYIV, overlap: str = "earlier", gap: str = "before", years: tuple[int, int] = (1900, 2100)) -> DataFrame:
    """Add ``out``: the UTC instant (TIMESTAMP) that the written date or time in ``column`` means, or null.

    ``zone``: the zone of values that name none. ``overlap``: reading of a local time that occurs twice, ``earlier``,
    ``later`` or ``null``; ``gap``: offset for one that never occurs, ``before``, ``after`` or ``null``.
    Null, blank, impossible or undated values, unknown zones and years outside ``years`` give null.
    The steps are separate projections, so each part of a value is computed once.
    """
    if overlap not in ("earlier", "later", "null") or gap not in ("before", "after", "null"):
        raise ValueError(f"unknown policy: overlap {overlap!r}, gap {gap!r}")
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]

    def step(**new: Column) -> None:
        nonlocal df
        df = df.withColumns({f"__ts_{k}": v for k, v in new.items()})

    c = lambda name: F.col(f"__ts_{name}")
    months = _lookup({k: str(v) for k, v in MONTHS.items()})
    step(zone=F.lit(zone) if isinstance(zone, str) else zone, text=F.regexp_replace(F.trim(F.regexp_replace(F.col(f"`{column}`"), r"(?U)\s+", " ")), r"(?i)(\d) (AM|PM)\b", "$1$2"))
    step(mark=F.regexp_extract(c("text"), _ZONE, 1))
    step(rest=F.rtrim(F.substring(c("text"), F.lit(1), F.length(c("text")) - F.length(c("mark")))))
    step(half=F.upper(F.regexp_extract(c("rest"), r"(?i)\d(AM|PM)$", 1)))
    step(body=F.regexp_replace(F.regexp_replace(c("rest"), r"(?i)(\d)(AM|PM)$", "$1"), r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})$", "$1$2$3 $4:$5:$6"))
    step(time=F.regexp_extract(c("body"), _TIME, 1), date=F.regexp_replace(F.regexp_replace(c("body"), _TIME, ""), ",$", ""))
    step(month=F.element_at(months, F.lower(F.regexp_extract(c("date"), rf"(?i)(?:^|[\s-])({_UA}|{_EN})[a-zа-яіїєґ]*\.?,?[\s-]+\d", 1))))
    day = F.lit(None).cast("string")
    for pattern, to in reversed(DATE_PATTERNS):
        written = F.regexp_replace(c("date"), pattern, to)
        day = F.when(c("date").rlike(pattern), F.replace(written, F.lit("#"), c("month")) if "#" in to else written).otherwise(day)
    step(day=day, hour=F.regexp_extract(c("time"), r"^(\d{1,2})", 1).try_cast("int"))
    shown = F.when(c("half") == "", c("hour")).when(c("hour").between(1, 12), c("hour") % 12 + F.when(c("half") == "PM", 12).otherwise(0))
    clock = F.concat(shown.cast("string"), F.regexp_replace(F.regexp_replace(F.regexp_replace(c("time"), r"^\d{1,2}", ""), r"[.,](\d{1,6})\d*$", r".$1"), r"^(:\d{2})$", "$1:00"))
    step(clock=F.when(c("time") != "", clock).when(c("half") == "", "00:00:00"))
    offset = F.coalesce(F.element_at(_lookup(ABBREVIATIONS), F.upper(c("mark"))), F.when(c("mark").rlike(r"^[+-]"), F.regexp_replace(c("mark"), r"^([+-]\d{2}):?(\d{2})$", "$1:$2")))
    step(local=F.concat(c("day"), F.lit(" "), c("clock"), F.lit("Z")).try_cast("timestamp"), offset=offset)  # the wall clock, kept as if it were UTC
    hours, minutes = F.substring(c("offset"), 2, 2).try_cast("int"), F.substring(c("offset"), 5, 2).try_cast("int")
    seconds = F.when((hours <= 18) & (minutes < 60), (hours * 3600 + minutes * 60).cast("long") * F.when(F.substring(c("offset"), 1, 1) == "-", -1).otherwise(1))
    step(seconds=seconds, region=F.when(c("mark") == "", c("zone")).otherwise(F.element_at(_lookup(REGIONS), c("mark"))))
    shift = lambda at, by: F.timestamp_micros(F.unix_micros(at) + by.cast("long") * F.lit(1_000_000))
    step(there=F.to_utc_timestamp(c("local"), c("region")))  # a double reading is the earlier one, a skipped one keeps the offset before
    there, hour_s = c("there"), F.lit(3600)
    if overlap != "earlier":
        twice = F.from_utc_timestamp(shift(c("there"), hour_s), c("region")) == c("local")
        there = F.when(twice, shift(c("there"), hour_s) if overlap == "later" else F.lit(None)).otherwise(there)
    if gap != "before":
        never = F.from_utc_timestamp(c("there"), c("region")) != c("local")
        there = F.when(never, shift(c("there"), -hour_s) if gap == "after" else F.lit(None)).otherwise(there)
    stamp = F.when(F.length(c("text")) == 10, F.timestamp_seconds(c("text").try_cast("long"))).otherwise(F.timestamp_millis(c("text").try_cast("long")))
    step(at=F.when(c("text").rlike(r"^(\d{10}|\d{13})$"), stamp).when(c("offset").isNotNull(), shift(c("local"), -c("seconds"))).otherwise(there))
    first, last = (F.lit((y - 1970) * 31_556_952 * 1_000_000) for y in (years[0], years[1] + 1))
    return df.select(*kept, F.when(F.unix_micros(c("at")).between(first, last), c("at")).alias(out))


def _plain(at: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss.SSSSSS of a timestamp read as UTC, whatever the session's zone."""
    micros = F.unix_micros(at)
    rest = F.pmod(micros, F.lit(86_400_000_000))
    two = lambda per, of: F.lpad(F.pmod(F.floor(rest / F.lit(per)), F.lit(of)).cast("string"), 2, "0")
    clock = F.concat_ws(":", two(3_600_000_000, 24), two(60_000_000, 60), two(1_000_000, 60))
    day = F.date_from_unix_date(((micros - rest) / F.lit(86_400_000_000)).cast("int"))
    return F.concat(day.cast("string"), F.lit("T"), clock, F.lit("."), F.lpad(F.pmod(rest, F.lit(1_000_000)).cast("string"), 6, "0"))


def utc_text(at: Column) -> Column:
    """yyyy-MM-ddTHH:mm:ss.SSSSSSZ, always six decimals."""
    return F.concat(_plain(at), F.lit("Z"))


def local_date_text(at: Column, zone: str = KYIV) -> Column:
    """The calendar date (yyyy-MM-dd) an instant has in a zone."""
    local = F.unix_micros(F.from_utc_timestamp(at, zone))
    return F.date_from_unix_date(((local - F.pmod(local, F.lit(86_400_000_000))) / F.lit(86_400_000_000)).cast("int")).cast("string")


def normalize(df: DataFrame, column: str, out: str, form: str = "instant", source: str | None = None, zones: Mapping[str, str] | None = None, default_zone: str = KYIV, **policy) -> DataFrame:
    """Add ``out`` (string, null where the value is unusable) with ``column`` in one form.

    ``form`` is ``instant`` (UTC, six decimals) or ``date`` (calendar date in ``default_zone``). ``source`` names a
    column whose values ``zones`` maps to the zone of marks that name none; others take ``default_zone``.
    A column named ``out`` is replaced; all other columns, rows, ties and repeats stay as they are.
    """
    zone = F.coalesce(F.element_at(_lookup(dict(zones)), F.col(source)), F.lit(default_zone)) if source and zones else F.lit(default_zone)
    at = F.col("__ts_instant")
    made = with_instant(df, column, "__ts_instant", zone, **policy)
    kept = [F.col(f"`{c}`") for c in df.columns if c != out]
    # a generator is a barrier: a filter on the result would else be pushed down with the whole cascade written out once more a step
    return made.select(*kept, F.explode(F.array(utc_text(at) if form == "instant" else local_date_text(at, default_zone))).alias(out))


def unusual(df: DataFrame, key: str, column: str, form: str, field: str, **how) -> DataFrame:
    """(field, row_key, norm_value) of each value that is resolvable and not yet in the one form."""
    there = r"^\d{4}-\d{2}-\d{2}$" if form == "date" else r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{6}Z$"
    open_rows = df.where(F.col(column).isNotNull() & ~F.col(column).rlike(there))
    done = normalize(open_rows, column, "__norm", form, **how)
    return done.where("__norm is not null").select(F.lit(field).alias("field"), F.col(key).cast("string").alias("row_key"), F.col("__norm").alias("norm_value"))
