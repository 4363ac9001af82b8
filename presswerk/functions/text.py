"""Native text expressions: normal forms, tokens, keys, urls and dates. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"[\s\p{Z}]"


def nz(col: Column, default: str = "") -> Column:
    """NULL and empty alike become the default."""
    return F.coalesce(F.nullif(col, F.lit("")), F.lit(default))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, rf"^{SPACE}+|{SPACE}+$", "")


def norm_text(col: Column) -> Column:
    """Lower-cased, trimmed, each run of white space one blank."""
    return F.lower(strip(F.regexp_replace(F.coalesce(col, F.lit("")), rf"{SPACE}+", " ")))


def unicode_tokens(col: Column) -> Column:
    """Runs of letters, digits and underscores of the lower-cased text."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def ascii_tokens(col: Column) -> Column:
    """Tokens of ASCII letters, digits, quote, underscore and hyphen, longer than one character; accents split."""
    return F.filter(F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(r"[a-z0-9][a-z0-9'_-]*"), F.lit(0)), lambda x: F.length(x) > 1)


def joined_words(col: Column) -> Column:
    """Tokens that may hold quotes and hyphens."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(r"[\p{L}\p{N}_'-]*[\p{L}\p{N}_][\p{L}\p{N}_'-]*"), F.lit(0))


def word_count(col: Column) -> Column:
    return F.regexp_count(F.coalesce(col, F.lit("")), F.lit(r"[\p{L}\p{N}_]+"))


def title_tokens(col: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(joined_words(col), lambda x: F.length(x) >= 3)))


def tidy_lines(col: Column) -> Column:
    """Each line's white space collapsed, blank lines dropped."""
    lines = F.transform(F.split(F.regexp_replace(F.coalesce(col, F.lit("")), r"\r\n?", "\n"), "\n"), lambda x: strip(F.regexp_replace(x, rf"{SPACE}+", " ")))
    return F.array_join(F.filter(lines, lambda x: x != ""), "\n")


def uuid_of(col: Column) -> Column:
    h = F.md5(col)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))


def article_id(url: Column, title: Column, content: Column) -> Column:
    """md5 of the trimmed url, else of title and lead, written as a uuid."""
    u = strip(F.coalesce(url, F.lit("")))
    lead = strip(F.concat(F.coalesce(title, F.lit("")), F.lit("||"), F.substring(F.coalesce(content, F.lit("")), 1, 400)))
    return uuid_of(F.when(u != "", u).otherwise(lead))


def ingest_fingerprint(url: Column, title: Column, content: Column) -> Column:
    part = lambda c: F.lower(strip(F.coalesce(c, F.lit(""))))
    return F.md5(F.concat(part(url), F.lit("||"), part(title), F.lit("||"), F.substring(part(content), 1, 400)))


def retrieval_fingerprint(url: Column, title: Column, content: Column) -> Column:
    """As above with inner white space collapsed and the parts in the order title, url, lead."""
    return F.md5(F.concat(norm_text(title), F.lit("||"), norm_text(url), F.lit("||"), F.substring(norm_text(content), 1, 400)))


_URL = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*).*$"


def url_authority(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), _URL, 2))


def url_domain(url: Column) -> Column:
    return F.regexp_replace(url_authority(url), r"^www\.", "")


def normal_url(url: Column) -> Column:
    """Scheme and authority lower-cased, query and fragment dropped, no slash at the end; other text only trimmed."""
    u = strip(F.coalesce(url, F.lit("")))
    whole = F.concat(F.lower(F.regexp_extract(u, _URL, 1)), F.lit("://"), F.lower(F.regexp_extract(u, _URL, 2)), F.regexp_extract(u, _URL, 3))
    return F.regexp_replace(F.when(u.rlike(_URL), whole).otherwise(F.regexp_replace(u, r"[?#].*$", "")), r"/+$", "")


def wall_clock(text: Column) -> Column:
    """'yyyy-MM-dd HH:mm:ss' of an ISO stamp; the offset is dropped, not applied."""
    pattern = r"^(\d{4}-\d{2}-\d{2})[T ](\d{2}:\d{2}:\d{2}).*$"
    return F.when(text.rlike(pattern), F.regexp_replace(text, pattern, "$1 $2"))


def iso_instant(text: Column) -> Column:
    """UTC timestamp of an ISO stamp, NULL if it cannot be read; without an offset it is UTC."""
    shaped = strip(text)
    full = F.regexp_replace(F.regexp_replace(shaped, r"([+-]\d{2})(\d{2})$", "$1:$2"), r"([T ]\d{2}:\d{2})(Z|[+-]\d{2}:\d{2})?$", "$1:00$2")
    return F.when(shaped.rlike(r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})?)?$"), F.try_to_timestamp(full))


def column_instant(text: Column) -> Column:
    """First as 14 digits, then as an ISO stamp."""
    return F.coalesce(F.when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss"))), iso_instant(text))


def charset_of(content_type: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?i)charset\s*=\s*[\"']?([A-Za-z0-9._-]+)", 1)), F.lit(""))


def themes_of(text: Column) -> Column:
    """Distinct prefixes before the first underscore of themes separated by semicolons."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), ";"), lambda x: F.substring_index(strip(x), "_", 1)), lambda x: x != "")))


def slug(text: Column, longest: int = 80) -> Column:
    s = F.regexp_replace(F.lower(strip(F.coalesce(text, F.lit("")))), r"[^a-z0-9]+", "_")
    return F.substring(F.regexp_replace(s, r"^_+|_+$", ""), 1, longest)


def stable_excerpt(text: Column, longest: int) -> Column:
    """The text, or its first 70 % and last 30 % of `longest` characters around a mark."""
    head, tail = int(longest * 0.7), int(longest * 0.3)
    t = strip(F.coalesce(text, F.lit("")))
    return F.when(F.length(t) <= longest, t).otherwise(F.concat(F.substring(t, 1, head), F.lit("\n...\n"), F.right(t, F.lit(tail))))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    either = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / either)
