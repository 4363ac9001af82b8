"""Mixed timestamp notations and time zones, normalised to one UTC instant (problem 7).

Everything runs as native expressions. A notation is recognised by one regular expression and rewritten into a
fixed row of fields; the wall-clock value is then as-of joined to the zone-offset intervals of its zone, exploded by
year: two matching intervals mean the clock showed that time twice, none that it skipped it, one gives the offset.
"""

from __future__ import annotations

import datetime as dt
import functools
import zoneinfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Intervals are exploded for these years. Before them a zone has one offset, in a bucket of its own; the rules behind them
#: are those of the time-zone database's last line, which repeat with the calendar every 400 years.
YEAR_FROM, YEAR_TO = 1850, 2437
CYCLE_YEARS, CYCLE_DAYS = 400, 146_097
#: Abbreviations are those in use between these years.
SHORT_FROM, SHORT_TO = 1990, 2070
#: The time-zone database has under 600 names, and a zone under 1,400 rows.
MAX_ZONES = 600

# Month names and usual short forms in English, French, German, Spanish, Italian, Portuguese.
MONTHS = {
    1: "january jan janvier janv januar jänner enero ene gennaio gen janeiro",
    2: "february feb février févr fevrier februar febrero febbraio fevereiro fev",
    3: "march mar mars märz mrz marzo março marco",
    4: "april apr avril avr abril abr aprile",
    5: "may mai mayo maggio mag maio",
    6: "june jun juin juni junio giugno giu junho",
    7: "july jul juillet juil juli julio luglio lug julho",
    8: "august aug août aout agosto ago",
    9: "september sep sept septembre septiembre setiembre settembre set setembro",
    10: "october oct octobre oktober okt octubre ottobre ott outubro out",
    11: "november nov novembre noviembre novembro",
    12: "december dec décembre dezember dez diciembre dic dicembre dezembro déc decembre",
}

_CLOCK = r"(\d{1,2})[:hH](\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?"
_ZONE = r"(?:\s*([Zz]|[+-]\d{2}(?::?\d{2})?|[A-Z]{2,5}))?(?:\s*\[([A-Za-z]+(?:[/_+-][A-Za-z0-9]+)*)\])?"
_HALF = r"(?:\s*([AaPp])\.?[Mm]\.?)?"
#: name, pattern, rewriting into y|mo|d|h|mi|s|fraction|half of day|zone|region
_NOTATIONS = [
    ("iso", rf"^(\d{{4}})[-/](\d{{2}})[-/](\d{{2}})[Tt ]\s*{_CLOCK}{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8|$9"),
    ("compact", r"^(\d{4})(\d{2})(\d{2})([Tt]?)(\d{2})(\d{2})(\d{2})(?:\.0+)?([Zz]|[+-]\d{2}:?\d{2})?$", "$1|$2|$3|$5|$6|$7|||$8|$4"),
    ("day_first", rf"^(?:\p{{L}}+\.?,?\s+)?(\d{{1,2}})(?:\.|er|º|st|nd|rd|th)?\s+(?:de\s+)?(\p{{L}}+)\.?\s+(?:de\s+|del\s+)?(\d{{4}}),?\s+(?:(?:à|a|às|as|ore|um|at|alle|a las|às)\s+)?{_CLOCK}(?:\s*(?:Uhr|h))?{_HALF}{_ZONE}$", "$3|$2|$1|$4|$5|$6|$7|$8|$9|$10"),
    ("month_first", rf"^(?:\p{{L}}+day,?\s+)?(\p{{L}}+)\.?\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}}),?\s+(?:at\s+)?{_CLOCK}{_HALF}{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|$10"),
    ("numeric", rf"^(\d{{1,2}})[/.-](\d{{1,2}})[/.-](\d{{4}}),?\s+{_CLOCK}{_HALF}{_ZONE}$", "$3|$1|$2|$4|$5|$6|$7|$8|$9|$10"),
]


def zone_intervals(spark: SparkSession, zones: list[str]) -> DataFrame:
    """Rows (zone, year, abbreviation, local_from, local_to, offset_us): offsets by local time, exploded by year.

    `local_from` and `local_to` are local microseconds; neighbours overlap where the clock was set back and leave a
    gap where it was set forward. Names unknown to the time-zone database have no rows.
    """
    rows: list[tuple] = []
    epoch = dt.datetime(1970, 1, 1)
    for name in sorted(set(zones)):
        try:
            zone = zoneinfo.ZoneInfo(name)
        except Exception:  # noqa: BLE001 - unknown names have no interval
            continue
        for k, (start, end, offset, abbreviation) in enumerate(_offsets(zone)):
            local_from, local_to = (start + offset) * 1_000_000, (end + offset) * 1_000_000
            first = max(YEAR_FROM, (epoch + dt.timedelta(microseconds=local_from)).year)
            last = min(YEAR_TO, (epoch + dt.timedelta(microseconds=local_to - 1)).year)
            if not k:
                first, local_from = YEAR_FROM - 1, -(1 << 62)
            for year in range(first, last + 1):
                rows.append((name, year, abbreviation, local_from, local_to, offset * 1_000_000))
    schema = "zone string, year int, abbreviation string, local_from long, local_to long, offset_us long"
    if not rows:
        return spark.createDataFrame([], schema)
    import pandas as pd

    return spark.createDataFrame(pd.DataFrame(rows, columns=[c.split()[0] for c in schema.split(", ")]), schema)


@functools.lru_cache(maxsize=MAX_ZONES)
def _offsets(zone: zoneinfo.ZoneInfo) -> list[tuple[int, int, int, str]]:
    """UTC intervals (from, to, offset seconds, abbreviation), found by bisection between days of differing offset."""
    utc = dt.timezone.utc

    def at(second: int) -> tuple[int, str]:
        local = dt.datetime.fromtimestamp(second, utc).astimezone(zone)
        return int(local.utcoffset().total_seconds()), local.tzname() or ""

    begin = int(dt.datetime(YEAR_FROM - 1, 12, 1, tzinfo=utc).timestamp())
    stop = int(dt.datetime(YEAR_TO + 1, 2, 1, tzinfo=utc).timestamp())
    day, modern = 86_400, 315_532_800  # in earlier years offsets changed at times twice in a fortnight
    found, since, here = [], begin, at(begin)
    second = begin
    while second < stop:
        following = min(second + (14 if second >= modern else 4) * day, stop)
        there = at(following)
        if there != here:
            low, high = second, following
            while high - low > 1:
                middle = (low + high) // 2
                low, high = (middle, high) if at(middle) == here else (low, middle)
            found.append((since, high, *here))
            since, here = high, at(high)
            second = high
            continue
        second = following
    found.append((since, stop, *here))
    return found


def _trimmed(text: Column) -> Column:
    return F.regexp_replace(text, r"(?U)^[\s\p{Z}﻿]+|[\s\p{Z}﻿]+$", "")


def parse_notation(text: Column) -> Column:
    """A row y|mo|d|h|mi|s|fraction|half|zone|region|notation for a recognised notation, else NULL."""
    out = None
    for name, pattern, row in _NOTATIONS:
        value = F.regexp_replace(text, pattern, f"{row}|{name}")
        out = F.when(text.rlike(pattern), value) if out is None else out.when(text.rlike(pattern), value)
    return out


def _month_number(text: Column) -> Column:
    names = {word: number for number, words in MONTHS.items() for word in words.split()}
    pairs = [F.lit(x) for word, number in names.items() for x in (word, number)]
    return F.create_map(*pairs)[F.lower(text)]


def normalise_timestamps(
    df: DataFrame,
    sources: DataFrame,
    id_col: str = "id",
    text_col: str = "published_date",
    source_col: str = "source",
) -> DataFrame:
    """One row (id, epoch_us) for each id whose text determines an instant.

    `sources` gives home_zone and day_first by source. A zone, offset or Unix count in the text decides; 14 digits
    without a zone are UTC; a zone abbreviation is one of the home zone's since 1990, if it has one meaning; other text is
    the home zone's clock, in any of the years 1 to 9999.

    Nulls, blanks, relative or impossible dates, dates without a time of day, skipped or repeated clock times, and
    clock times without a known source give no row. Equal repeated rows give one row; rows of one id that determine
    different instants contradict each other and give none. Extra columns are ignored, whatever their names, and an
    empty table gives an empty result.
    """
    spark = df.sparkSession
    zones = [r[0] for r in sources.select("home_zone").where("home_zone is not null").distinct().limit(MAX_ZONES + 1).collect()]
    if len(zones) > MAX_ZONES:
        raise ValueError("more zone names than the time-zone database has")
    intervals = zone_intervals(spark, zones)
    by_year = F.broadcast(intervals)  # bounded by the time-zone database: under 600 zones x 1,400 rows of some 60 bytes
    abbreviations = F.broadcast(
        intervals.where(F.col("year").between(SHORT_FROM, SHORT_TO)).groupBy(F.col("zone").alias("a_zone"), F.col("abbreviation").alias("a_name"))
        .agg(F.min("offset_us").alias("a_min"), F.max("offset_us").alias("a_max")).where("a_min = a_max").select("a_zone", "a_name", F.col("a_min").alias("a_offset"))
    )

    rows = df.select(F.col(id_col).alias("id"), _trimmed(F.col(text_col)).alias("text"), F.col(source_col).alias("source")).where("id is not null and text <> ''")
    # Unix counts by their number of digits: seconds, milliseconds, microseconds, nanoseconds.
    whole = F.regexp_extract("text", r"^(\d+)(?:\.\d+)?$", 1)
    scale = F.when(F.length(whole).isin(9, 10), 1_000_000).when(F.length(whole).isin(12, 13), 1_000).when(F.length(whole) == 16, 1)
    count = F.col("text").try_cast(T.DecimalType(38, 9))
    rows = rows.withColumn("unix_us", F.when(F.col("text").rlike(r"^\d+(\.\d{1,9})?$"), F.when(F.length(whole) == 19, F.floor(count / 1000)).otherwise(F.floor(count * scale))).cast("long"))
    rows = rows.withColumn("f", F.split(F.when(F.col("unix_us").isNull(), parse_notation(F.col("text"))), r"\|"))
    home = sources.select(F.col("source").alias("s_source"), "home_zone", "day_first").where("s_source is not null").dropDuplicates(["s_source"])
    rows = rows.where("unix_us is not null or f is not null").join(home, F.col("source") == F.col("s_source"), "left")

    f = F.col("f")
    part = lambda i: F.nullif(f[i], F.lit(""))
    kind = f[10]
    swapped = (kind == "numeric") & F.col("day_first")
    month_text = F.when(swapped, part(2)).otherwise(part(1))
    day_text = F.when(swapped, part(1)).otherwise(part(2))
    month = F.coalesce(month_text.try_cast("int"), _month_number(month_text))
    known_order = (kind != "numeric") | F.col("day_first").isNotNull()
    hour = part(3).cast("int")
    hour = F.when(part(7).isNull(), hour).when(~hour.between(1, 12), F.lit(None)).otherwise(hour % 12 + F.when(F.lower(part(7)) == "p", 12).otherwise(0))
    second = F.coalesce(part(5).cast("int"), F.lit(0))
    stamp = F.when(
        known_order & (hour < 24) & (part(4).cast("int") < 60) & (second < 60),
        F.try_make_timestamp(part(0).cast("int"), month, day_text.try_cast("int"), hour, part(4).cast("int"), second.cast("decimal(16,6)"), F.lit("UTC")),
    )
    micros = F.rpad(F.substring(F.coalesce(part(6), F.lit("0")), 1, 6), 6, "0").cast("long")
    zone = part(8)
    sign = F.when(F.substring(zone, 1, 1) == "-", -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    hours, minutes = F.substring(digits, 1, 2).try_cast("int"), F.coalesce(F.nullif(F.substring(digits, 3, 2), F.lit("")).try_cast("int"), F.lit(0))
    fixed = F.when(zone.rlike(r"^(?:[Zz]|UTC|GMT|UT)$"), F.lit(0).cast("long")).when(
        zone.rlike(r"^[+-]") & (hours <= 18) & (minutes < 60), sign * (hours * 3600 + minutes * 60).cast("long") * 1_000_000
    )
    fixed = F.when((kind == "compact") & zone.isNull() & (part(9).isNull()), F.lit(0).cast("long")).otherwise(fixed)
    region = F.when(kind != "compact", part(9))
    parsed = rows.select(
        "id", "unix_us", (F.unix_micros(stamp) + micros).alias("local_us"), fixed.alias("fixed_us"),
        F.when(zone.rlike("^[A-Z]{2,5}$") & fixed.isNull(), zone).alias("short_name"),
        F.when(zone.isNull(), F.coalesce(region, F.col("home_zone"))).alias("clock_zone"), "home_zone",
    )
    parsed = parsed.where("unix_us is not null or local_us is not null")
    parsed = parsed.join(abbreviations, (F.col("home_zone") == F.col("a_zone")) & (F.col("short_name") == F.col("a_name")), "left")
    parsed = parsed.withColumn("fixed_us", F.coalesce("fixed_us", "a_offset"))
    need = F.col("unix_us").isNull() & F.col("fixed_us").isNull() & F.col("short_name").isNull()
    year = F.year(F.timestamp_micros("local_us"))
    cycles = F.greatest(F.floor((year - (YEAR_TO + 1 - CYCLE_YEARS)) / CYCLE_YEARS), F.lit(0))
    parsed = parsed.select(
        "id", "unix_us", "local_us", "fixed_us", F.when(need, F.col("clock_zone")).alias("clock_zone"),
        F.greatest(year - cycles * CYCLE_YEARS, F.lit(YEAR_FROM - 1)).cast("int").alias("clock_year"), (F.col("local_us") - cycles * F.lit(CYCLE_DAYS * 86_400_000_000)).alias("clock_us"),
    )
    joined = parsed.join(
        by_year,
        (F.col("clock_zone") == F.col("zone")) & (F.col("clock_year") == F.col("year")) & (F.col("clock_us") >= F.col("local_from")) & (F.col("clock_us") < F.col("local_to")),
        "left",
    )
    instant = F.coalesce("unix_us", F.col("local_us") - F.coalesce("fixed_us", "offset_us"))
    return (
        joined.select("id", instant.alias("epoch_us")).groupBy("id")
        .agg(F.min("epoch_us").alias("epoch_us"), F.max("epoch_us").alias("other"))
        .where("epoch_us = other").select("id", "epoch_us")
    )


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    from presswerk.session import read_table

    return normalise_timestamps(read_table(spark, sf_dir, "articles"), read_table(spark, sf_dir, "sources"))
