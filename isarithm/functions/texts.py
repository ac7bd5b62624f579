"""Text expressions of reports, file names, sheet numbers and addresses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def slug(name: Column, default: str = "shot") -> Column:
    """Lower case, everything but letters and digits a single hyphen, none at the ends."""
    plain = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", "-")
    return F.coalesce(F.nullif(F.regexp_replace(plain, "^-+|-+$", ""), F.lit("")), F.lit(default))


def stem(path: Column) -> Column:
    """File name without folder and suffix."""
    return F.regexp_replace(F.regexp_replace(path, r"^.*/", ""), r"\.[^.]*$", "")


def title(path: Column, prefix: Column) -> Column:
    """Words of a picture's name behind its prefix and number, with a capital first letter."""
    tail = F.replace(stem(path), prefix, F.lit(""))
    words = F.replace(F.regexp_replace(tail, r"^[^-]*-", ""), F.lit("-"), F.lit(" "))
    return F.concat(F.upper(F.substring(words, 1, 1)), F.substr(words, F.lit(2)))


def natural_number(path: Column) -> Column:
    """The digits behind the last hyphen of a file's stem, 0 if that part is not a number."""
    return F.coalesce(F.regexp_extract(stem(path), r"(?:^|-)(\d{1,18})$", 1).try_cast("long"), F.lit(0))


def numbered_after(path: Column, marker: str) -> Column:
    """The digits between the marker and the next hyphen, 0 if that part is not a number."""
    return F.coalesce(F.regexp_extract(stem(path), marker + r"(\d{1,18})(?:-|$)", 1).try_cast("long"), F.lit(0))


def sheet_1km(east: Column, north: Column) -> Column:
    """Six digits: kilometres north of 6000, kilometres east."""
    return F.format_string("%03d%03d", (F.floor(north / 1000.0) - 6000).cast("int"), F.floor(east / 1000.0).cast("int"))


def sheet_5km(east: Column, north: Column) -> Column:
    """Row and column of the 100 km and the 10 km block, then the quadrant: 1 SW, 2 SE, 3 NW, 4 NE."""
    half = lambda v: (F.pmod(v, F.lit(10000.0)) >= 5000.0).cast("int")
    return F.format_string(
        "%d%d%d%d%d",
        (F.floor(north / 100000.0) - 59).cast("int"),
        (F.floor(east / 100000.0) - 2).cast("int"),
        F.pmod(F.floor(north / 10000.0), F.lit(10)).cast("int"),
        F.pmod(F.floor(east / 10000.0), F.lit(10)).cast("int"),
        1 + half(east) + 2 * half(north),
    )


def listed(html: Column, pattern: str) -> Column:
    """Sorted distinct captures of a pattern in a page, after &amp; is undone."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.replace(html, F.lit("&amp;"), F.lit("&")), F.lit(pattern), F.lit(1))))


def query_url(base: str, params: list[tuple[str, Column]]) -> Column:
    """An address with percent-encoded parameters in the given order."""
    return F.concat(F.lit(base + "?"), F.concat_ws("&", *[F.concat(F.lit(k + "="), F.url_encode(v)) for k, v in params]))


def tile_level(name: Column) -> Column:
    """The level in names that end in _L<level>_<number>.b3dm, else null."""
    return F.regexp_extract(name, r"_L(\d+)_\d+\.b3dm$", 1).try_cast("int")


def owner_and_name(remote: Column) -> Column:
    """owner/name of a remote address in either notation."""
    return F.nullif(F.regexp_extract(remote, r"[:/]([^:/]+/[^/]+?)(?:\.git)?/?$", 1), F.lit(""))


def dash(value: Column, shown: Column) -> Column:
    """Shown, or "-" where the value is missing or zero."""
    return F.when(value.isNull() | (value == 0), "-").otherwise(shown)


def valid_name(name: Column) -> Column:
    return F.coalesce(name.rlike(r"^[\p{L}\p{N}_-]+$"), F.lit(False))


def first_keyword(name: Column, values: dict[str, str], default: str) -> Column:
    """The value of the first keyword, in order, that a name contains."""
    out = F.lit(default)
    for word, value in reversed(values.items()):
        out = F.when(F.contains(name, F.lit(word)), value).otherwise(out)
    return out
