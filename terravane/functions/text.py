"""Text expressions: cleaning, slugs, distances, colours, lineage patterns, partial dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fills of unknown tags, forbidden lineage, and values that stand for a missing property.
UNKNOWN_FILL = "#8a8a8a"
UNKNOWN_TAG = "UNK"
FORBIDDEN_LINEAGE = {"restricted-gadm": r"(?i)\bgadm\b", "odbl-openstreetmap": r"(?i)\b(odbl|openstreetmap|open\s*street\s*map)\b", "restricted-generic": r"(?i)\brestricted\b", "share-alike": r"(?i)share[\s-]*alike"}
MISSING_MARKS = ["", "-99"]
PLACEHOLDERS = ["pending", "placeholder", "todo", "tbd", "unknown"]


def cleaned(value: Column | str) -> Column:
    """Text without NULs and outer blanks; null where nothing, or a mark for missing, is left."""
    value = F.col(value) if isinstance(value, str) else value
    text = F.trim(F.replace(value.cast("string"), F.lit("\0"), F.lit("")))
    return F.when(~text.isin(MISSING_MARKS), text)


def first_present(*values: Column | str) -> Column:
    """The first of several properties that is present after cleaning."""
    return F.coalesce(*[cleaned(v) for v in values])


def slug(value: Column | str) -> Column:
    """Lower-case ASCII letters and digits with hyphens between; accents of the Latin letters below are dropped, other letters go."""
    value = F.col(value) if isinstance(value, str) else value
    accented, plain = "àáâãäåçèéêëìíîïñòóôõöùúûüýÿāăąćčďēęěğīłńňōőřśşšťūůűźżž", "aaaaaaceeeeiiiinooooouuuuyyaaaccdeeegilnnoorssstuuuzzz"
    text = F.translate(F.lower(value), accented, plain)
    return F.trim(F.regexp_replace(F.regexp_replace(text, "[^\\x00-\\x7F]", ""), "[^a-z0-9]+", "-"), F.lit("-"))


def distance_text(km: Column) -> Column:
    """Six decimals with the zeros at the end, and a point that then stands last, stripped."""
    return F.regexp_replace(F.regexp_replace(F.format_string("%.6f", km.cast("double")), "0+$", ""), "\\.$", "")


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once; without this nested uses double an expression again and again."""
    return F.transform(F.array(value), body)[0]


def _byte(digest: Column, i: int) -> Column:
    return F.conv(F.substring(digest, 2 * i + 1, 2), 16, 10).cast("int")


def _channel(low: Column, high: Column, hue: Column) -> Column:
    h = hue - F.floor(hue)
    x = F.when(h < 1 / 6, low + (high - low) * h * 6).when(h < 0.5, high).when(h < 2 / 3, low + (high - low) * (2 / 3 - h) * 6).otherwise(low)
    return F.lpad(F.lower(F.hex(F.floor(x * 255).cast("int"))), 2, "0")


def tag_fill(tag: Column | str) -> Column:
    """A fill that follows from a tag's SHA-256: its bytes give hue, saturation 0.48-0.76 and lightness 0.40-0.56; grey without a tag."""
    tag = F.col(tag) if isinstance(tag, str) else tag

    def shades(c: Column) -> Column:
        high = F.when(c.light <= 0.5, c.light * (1 + c.saturation)).otherwise(c.light + c.saturation - c.light * c.saturation)
        return F.struct(c.hue.alias("hue"), (2 * c.light - high).alias("low"), high.alias("high"))

    def fill(c: Column) -> Column:
        return F.concat(F.lit("#"), *[_let(c.hue + F.lit(k / 3), lambda hue: _channel(c.low, c.high, hue)) for k in (1, 0, -1)])

    def hsl(digest: Column) -> Column:
        saturation, light = F.lit(0.48) + _byte(digest, 1) / F.lit(255.0) * F.lit(0.28), F.lit(0.40) + _byte(digest, 2) / F.lit(255.0) * F.lit(0.16)
        return F.struct((_byte(digest, 0) / F.lit(255.0)).alias("hue"), saturation.alias("saturation"), light.alias("light"))

    def whole(t: Column) -> Column:
        color = _let(_let(_let(F.sha2(t.cast("binary"), 256), hsl), shades), fill)
        return F.when(t.isNull() | (t == "") | (t == UNKNOWN_TAG), UNKNOWN_FILL).otherwise(color)

    return _let(tag, whole)


def identity_fill(value: Column | str) -> Column:
    """tag_fill of a culture, religion or area; grey for a blank one."""
    value = F.col(value) if isinstance(value, str) else value
    return tag_fill(F.trim(value))


def certified_fill(value: Column | str) -> Column:
    """Three channels of 64 + byte % 160."""
    value = F.col(value) if isinstance(value, str) else value
    digest = F.sha2(value.cast("binary"), 256)
    return F.concat(F.lit("#"), *[F.lpad(F.lower(F.hex(F.lit(64) + _byte(digest, i) % 160)), 2, "0") for i in range(3)])


def sheet_fill(value: Column | str) -> Column:
    """The first six hex digits of the SHA-256."""
    value = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit("#"), F.substring(F.sha2(value.cast("binary"), 256), 1, 6))


def forbidden_lineage(text: Column) -> Column:
    """Names of the forbidden patterns that a lineage text matches."""
    return F.filter(F.array(*[F.when(text.rlike(p), F.lit(n)) for n, p in FORBIDDEN_LINEAGE.items()]), lambda x: x.isNotNull())


def placeholder(value: Column) -> Column:
    text = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return text.isin(PLACEHOLDERS) | F.startswith(text, F.lit("pending-"))


def date_bound(value: Column, last: bool) -> Column:
    """A date from YYYY, YYYY-MM or YYYY-MM-DD: the first or the last day that it can mean; null for other text."""
    year, month, day = (F.try_to_number(F.regexp_extract(value, "^(\\d{4})(?:-(\\d{2})(?:-(\\d{2}))?)?$", i), F.lit("9999")).cast("int") for i in (1, 2, 3))
    first = F.make_date(year, F.coalesce(month, F.lit(12 if last else 1)), F.coalesce(day, F.lit(1)))
    return F.when(value.rlike("^\\d{4}(-\\d{2}(-\\d{2})?)?$"), F.when(day.isNotNull(), F.make_date(year, month, day)).otherwise(F.last_day(first) if last else first))


def holds_on(day: Column, valid_from: Column, valid_to: Column) -> Column:
    """Whether a day lies in a range of partial dates; an open end holds for ever."""
    low, high = date_bound(valid_from, False), date_bound(valid_to, True)
    return (low.isNull() | (low <= day)) & (high.isNull() | (day <= high))


def measurement(value: Column) -> Column:
    """A double to twelve significant digits."""
    return F.when(value.isNull() | F.isnan(value) | (F.abs(value) == float("inf")), value).otherwise(F.format_string("%.11e", value).cast("double"))
