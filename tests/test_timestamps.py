import datetime as dt

from presswerk.operators.timestamps import normalise_timestamps

UTC = dt.timezone.utc


def us(*a, micro=0):
    return int(dt.datetime(*a, tzinfo=UTC).timestamp()) * 1_000_000 + micro


SOURCES = [("paris", "Europe/Paris", True), ("york", "America/New_York", False), ("india", "Asia/Kolkata", True)]
CASES = [
    ("2025-03-10T16:50:40-04:00", "york", us(2025, 3, 10, 20, 50, 40)),
    ("2025-03-10t16:50:40z", None, us(2025, 3, 10, 16, 50, 40)),
    ("2025-03-10 16:50:40,5Z", None, us(2025, 3, 10, 16, 50, 40, micro=500_000)),
    ("2025-03-10T16:50:40.123456+0530", "paris", us(2025, 3, 10, 11, 20, 40, micro=123_456)),
    ("2024-12-28T11:43:34+05:30[Asia/Kolkata]", None, us(2024, 12, 28, 6, 13, 34)),
    ("20251225042715", None, us(2025, 12, 25, 4, 27, 15)),
    ("20251225042715.0", "york", us(2025, 12, 25, 4, 27, 15)),
    ("20251225T042715Z", "york", us(2025, 12, 25, 4, 27, 15)),
    ("1761435798", None, 1761435798 * 1_000_000),
    ("1761435798.0", None, 1761435798 * 1_000_000),
    ("1761435798123", None, 1761435798123 * 1_000),
    ("Thu, 14 Nov 2024 03:28:06 +0100", None, us(2024, 11, 14, 2, 28, 6)),
    ("Thu, 14 Nov 2024 03:28:06 GMT", "york", us(2024, 11, 14, 3, 28, 6)),
    ("26/05/2025 1:55 AM", "paris", us(2025, 5, 25, 23, 55)),
    ("02/09/2026 12:49", "york", us(2026, 2, 9, 17, 49)),
    ("02/09/2026 12:49", "india", us(2026, 9, 2, 7, 19)),
    ("April 11, 2025 12:11 PM CEST", "paris", us(2025, 4, 11, 10, 11)),
    ("November 3, 2024 1:24 AM EDT", "york", us(2024, 11, 3, 5, 24)),
    ("29 janvier 2026 à 22h52", "paris", us(2026, 1, 29, 21, 52)),
    ("26 de febrero de 2026, 23:26", "paris", us(2026, 2, 26, 22, 26)),
    ("25. März 2025, 09:36 Uhr", "paris", us(2025, 3, 25, 8, 36)),
    (" 2025-06-10T18:21:11 ", "paris", us(2025, 6, 10, 16, 21, 11)),
    ("2025-03-30 01:59:59", "paris", us(2025, 3, 30, 0, 59, 59)),
    ("2025-03-30 02:30:00", "paris", None),  # skipped
    ("2024-10-27T02:30:00", "paris", None),  # shown twice
    ("2025-06-31 11:20", "paris", None),
    ("2025-02-30T10:15:00Z", "paris", None),
    ("13/13/2025 10:00", "york", None),
    ("2025-06-10 24:10:00Z", None, None),
    ("2025-06-10 23:59:60Z", None, None),
    ("June 3, 2025 13:10 PM", "york", None),
    ("2025-06-10", "paris", None),
    ("20250610", "paris", None),
    ("2 hours ago", "paris", None),
    ("2025-06-10 10:00", None, None),
    ("2025-06-10 10:00", "unknown", None),
    ("", "paris", None),
    (None, "paris", None),
]


def test_notations(spark):
    rows = [(f"r{i:02}", text, source, "x") for i, (text, source, _) in enumerate(CASES)]
    # Clashing extra columns, repeated rows and a null id change nothing.
    df = spark.createDataFrame(rows + rows[:3] + [(None, "1761435798", None, "x")], "id string, published_date string, source string, text string").withColumnRenamed("text", "zone")
    found = {r.id: r.epoch_us for r in normalise_timestamps(df, spark.createDataFrame(SOURCES, "source string, home_zone string, day_first boolean")).collect()}
    for i, (text, source, want) in enumerate(CASES):
        assert found.get(f"r{i:02}") == want, (text, source)
    assert len(found) == sum(c[2] is not None for c in CASES)


def test_contradiction_and_empty(spark):
    sources = spark.createDataFrame(SOURCES, "source string, home_zone string, day_first boolean")
    schema = "id string, published_date string, source string"
    assert normalise_timestamps(spark.createDataFrame([], schema), sources).count() == 0
    two = spark.createDataFrame([("a", "1761435798", None), ("a", "1761435799", None), ("b", "x" * 100_000, "paris")], schema)
    assert normalise_timestamps(two, sources).count() == 0


def test_clock_times_of_any_year(spark):
    """Years before and behind the exploded intervals agree with the time-zone database."""
    import datetime as dt
    import zoneinfo

    from presswerk.operators.timestamps import normalise_timestamps

    zones = ["Europe/Paris", "America/New_York", "Asia/Tokyo", "Africa/Casablanca", "UTC"]
    sources = spark.createDataFrame([(z, z, True) for z in zones], "source string, home_zone string, day_first boolean")
    years = [1, 900, 1849, 1850, 1891, 1911, 1940, 1945, 1976, 2037, 2038, 2071, 2100, 2400, 2437, 2438, 2500, 2800, 2838, 4000, 9998]
    rows, want = [], {}
    for z in zones:
        for y in years:
            for month, day in ((1, 15), (7, 15), (3, 29), (12, 31)):
                key = f"{z}{y}-{month}-{day}"
                rows.append((key, f"{y:04d}-{month:02d}-{day:02d} 12:30:00", z))
                local = dt.datetime(y, month, day, 12, 30, tzinfo=zoneinfo.ZoneInfo(z))
                naive = (local.replace(tzinfo=None) - dt.datetime(1970, 1, 1)).total_seconds()
                want[key] = round((naive - local.utcoffset().total_seconds()) * 1_000_000)
    out = normalise_timestamps(spark.createDataFrame(rows, "id string, published_date string, source string"), sources)
    assert {r.id: r.epoch_us for r in out.collect()} == want
