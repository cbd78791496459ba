"""Scalar, array and text expressions. All are native column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

IMAGE_BASE = "https://image.tmdb.org/t/p"  # fixed value: public image CDN prefix

# One Unicode whitespace character / run, as a Java regex.
WS = r"[\p{Z}\t-\r\x{1c}-\x{1f}\x{85}]"
# What stands between tokens: anything but word characters and apostrophes.
_BETWEEN = r"[^\p{L}\p{N}_']+"


def day(value: date | str | Column) -> Column:
    """A date literal (columns pass through)."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def days_before(as_of: date | str | Column, n: int) -> Column:
    return F.date_sub(day(as_of), n)


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def safe_int(c: Column) -> Column:
    """Integer parse that yields null on anything unparsable."""
    return c.try_cast("bigint")


def iso_timestamp(c: Column) -> Column:
    """ISO-8601 instant such as ``2024-01-02T03:04:05Z``; null when blank, malformed or shorter than a day."""
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    return F.when(c.rlike(shape), c.try_cast("timestamp"))


def iso_date(c: Column) -> Column:
    return F.try_to_timestamp(blank_to_null(c), F.lit("yyyy-MM-dd")).cast("date")


def duration_seconds(c: Column) -> Column:
    """``PT#H#M#S`` to seconds: null when malformed, 0 for a bare ``PT``."""
    shape = r"^PT(\d+H)?(\d+M)?(\d+S)?$"

    def part(unit: str) -> Column:
        return F.coalesce(safe_int(F.regexp_extract(c, rf"(\d+){unit}", 1)), F.lit(0))

    return F.when(
        c.rlike(shape), part("H") * 3600 + part("M") * 60 + part("S")
    ).cast("bigint")


def image_url(path: Column, size: str = "w500") -> Column:
    return F.when(path != "", F.concat(F.lit(f"{IMAGE_BASE}/{size}"), path))


# Thumbnail sizes, best first.
THUMBNAILS = ("maxres", "standard", "high", "medium", "default")


def pick_thumbnail(thumbs: str) -> Column:
    """Best available size; an empty url counts as missing."""
    return F.coalesce(*[blank_to_null(F.col(f"{thumbs}.{size}.url")) for size in THUMBNAILS])


def or_unknown(countries: Column) -> Column:
    """The country list, or ``['UNKNOWN']`` when it is null or empty."""
    return F.when(F.coalesce(F.size(countries), F.lit(0)) > 0, countries).otherwise(
        F.array(F.lit("UNKNOWN"))
    )


def genres(c: Column) -> Column:
    shaped = F.transform(
        c,
        lambda g: F.struct(
            g["id"].alias("id"), F.coalesce(g["name"], F.lit("")).alias("name")
        ),
    )
    return _or_empty(shaped, "array<struct<id:bigint,name:string>>")


def companies(c: Column) -> Column:
    from crestline.schemas import COMPANY

    shaped = F.transform(
        c, lambda x: F.struct(x["id"], x["name"], x["logo_path"], x["origin_country"])
    )
    return _or_empty(shaped, f"array<{COMPANY}>")


def languages(c: Column) -> Column:
    from crestline.schemas import LANGUAGE

    shaped = F.transform(c, lambda x: F.struct(x["iso_639_1"], x["english_name"], x["name"]))
    return _or_empty(shaped, f"array<{LANGUAGE}>")


def _or_empty(c: Column, ddl: str) -> Column:
    return F.coalesce(c.cast(ddl), F.array().cast(ddl))


def origin_countries(listed: Column, produced_in: Column) -> Column:
    """A present ``origin_country`` list wins, even when empty; else producing countries."""
    codes = F.transform(produced_in, lambda c: c["iso_3166_1"])
    chosen = F.when(listed.isNotNull(), listed).otherwise(codes)
    return _or_empty(F.filter(chosen, lambda x: F.coalesce(x != "", F.lit(False))), "array<string>")


def is_tracked_video(site: Column, kind: Column) -> Column:
    return F.coalesce((F.lower(site) == "youtube") & kind.isin("Teaser", "Trailer"), F.lit(False))


def video_class(name: Column, kind: Column) -> Column:
    return F.when(F.lower(name).contains("official trailer"), "Official Trailer").otherwise(kind)


def strip_ws(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WS}+|{WS}+$", "")


def words(c: Column) -> Column:
    """Whitespace-separated words, no empty ones."""
    return F.array_remove(F.split(c, f"{WS}+"), "")


def word_count(c: Column) -> Column:
    return F.when(c != "", F.size(words(c)).cast("bigint"))


def char_count(c: Column) -> Column:
    return F.when(c != "", F.length(c).cast("bigint"))


def short_error(c: Column) -> Column:
    """Leading tag of an error text, up to the first colon; 'None' for a missing one."""
    head = blank_to_null(strip_ws(F.substring_index(c, ":", 1)))
    return F.when(c.isNull(), F.lit("None")).otherwise(F.coalesce(head, c))


def tokens(c: Column) -> Column:
    return F.array_remove(F.split(F.lower(c), _BETWEEN), "")


def jaccard(a: Column, b: Column) -> Column:
    """Similarity of two arrays of distinct tokens: both empty 1, one empty 0."""
    na, nb = F.size(a), F.size(b)
    shared = F.size(F.array_intersect(a, b))
    return F.when((na == 0) & (nb == 0), F.lit(1.0)).otherwise(
        F.try_divide(shared, na + nb - shared)
    )


def salience_scale(peak: Column) -> Column:
    """Audience weight: log10 of the peak, floored at 10."""
    return F.log10(F.greatest(F.coalesce(peak, F.lit(0)), F.lit(10)).cast("double"))


def percent_text(share: Column) -> Column:
    return F.concat(F.round(share * 100).cast("bigint").cast("string"), F.lit("%"))


def is_safe_id(c: Column) -> Column:
    return c.rlike("^[A-Za-z0-9_-]+$")


def preview(text: Column, limit: int = 200) -> Column:
    return F.when(F.length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("…"))).otherwise(
        text
    )


def preview_list(arr: Column, limit: int = 5) -> Column:
    return F.slice(arr, 1, limit)


def window_starts(duration: Column, width: int = 15, margin: int = 5) -> Column:
    """Starts of back-to-back windows with more than ``margin`` seconds left after them."""
    last = (duration - margin - 1).cast("int")
    return F.when(
        duration > margin, F.sequence(F.lit(0), last, F.lit(width))
    ).otherwise(F.array().cast("array<int>"))


def unit_vector(c: Column) -> Column:
    """L2-normalised array; an all-zero vector stays zero."""
    norm = F.sqrt(F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))
    return F.transform(c, lambda x: x.cast("double") / F.greatest(norm, F.lit(1e-9)))
