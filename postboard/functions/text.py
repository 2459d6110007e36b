"""Column functions on text, keys and timestamps."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: what stands for null in a surrogate key.
NULL_KEY = "_dbt_utils_surrogate_key_null_"


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def surrogate_key(*columns: Column) -> Column:
    """md5 of the columns as text, joined by a dash."""
    return F.md5(F.concat_ws("-", *[F.coalesce(c.cast("string"), F.lit(NULL_KEY)) for c in columns]))


def strip_html(c: Column) -> Column:
    """Each tag becomes a space; entities stay."""
    return F.regexp_replace(c, r"<[^>]+>", " ")


def hours_before(ts: Column, hours: int) -> Column:
    return ts - F.make_dt_interval(hours=F.lit(hours))


def redact_ref(c: Column) -> Column:
    return F.concat(F.lit("redacted:"), F.substring(F.sha2(c, 256), 1, 8))


def landed_version(c: Column) -> Column:
    return F.concat(F.lit("2."), F.substring(F.sha2(c, 256), 1, 12))


def parse_timestamp(c: Column) -> Column:
    """ISO text with Z or an offset, a bare date (midnight), or text ending in UTC; blank or unreadable gives null."""
    return F.try_to_timestamp(blank_to_null(F.trim(c)))


def parse_epoch_ms(c: Column) -> Column:
    return F.timestamp_millis(c)


#: The references that make up nearly all of escaped markup; they are looked for first.
COMMON = {"lt;": "<", "gt;": ">", "amp;": "&", "quot;": '"', "#39;": "'", "nbsp;": "\xa0"}
#: What HTML5 puts in the place of numbers that name no character.
REPLACED = {0: "\ufffd", 13: "\r"} | {n: bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)}


def nothing(n: Column) -> Column:
    """Numbers of control characters and non-characters, which leave nothing behind."""
    last = n.bitwiseAND(F.lit(0xFFFF))
    return n.between(1, 8) | (n == 11) | n.between(14, 31) | n.between(0x7F, 0x9F) | n.between(0xFDD0, 0xFDEF) | last.isin(0xFFFE, 0xFFFF)


def character(n: Column) -> Column:
    """The character of an HTML5 numeric reference."""
    plain = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    replaced = F.create_map(*[F.lit(x) for pair in REPLACED.items() for x in pair])
    return F.when(n.isin(*REPLACED), replaced[n]).when(n.between(0xD800, 0xDFFF) | (n > 0x10FFFF), "\ufffd").when(nothing(n), "").otherwise(plain)


def decoded(part: Column) -> Column:
    """What follows an ampersand, up to the next one, with the reference that it begins with decoded."""
    after = lambda found: F.substr(part, F.length(found) + 1)
    low, hexed, name = (F.regexp_extract(part, p, 0) for p in (r"^#[0-9]+;?", r"^#[xX][0-9a-fA-F]+;?", "^[^\t\n\f <&#;]{1,32};?"))
    digits = lambda found, skip: F.ltrim(F.rtrim(F.substr(found, F.lit(skip)), F.lit(";")), F.lit("0"))
    number = lambda d, base: F.when(F.length(d) > 8, 0x7FFFFFFF).otherwise(F.coalesce(F.conv(F.nullif(d, F.lit("")), base, 10), F.lit("0")).cast("long"))
    names = F.create_map(*[F.lit(x) for k in sorted(html5, key=lambda k: (k not in COMMON, k)) for x in (k, html5[k])])
    # names that need no semicolon also count as the beginning of a longer word, the longest first
    open_names = sorted((k for k in html5 if not k.endswith(";")), key=lambda k: (-len(k), k))
    begun = F.regexp_extract(part, "^(" + "|".join(open_names) + ")", 0)
    case = F.when(part == "", "&")
    for k, v in COMMON.items():
        case = case.when(F.startswith(part, F.lit(k)), F.concat(F.lit(v), F.substr(part, F.lit(len(k) + 1))))
    case = case.when(low != "", F.concat(character(number(digits(low, 2), 10)), after(low))).when(hexed != "", F.concat(character(number(digits(hexed, 3), 16)), after(hexed)))
    whole = F.try_element_at(names, name)
    return case.when(whole.isNotNull(), F.concat(whole, after(name))).when(begun != "", F.concat(F.try_element_at(names, begun), after(begun))).otherwise(F.concat(F.lit("&"), part))


def unescape_html(c: Column) -> Column:
    """One pass of HTML5 entity decoding: no reference reaches over an ampersand, so each is decoded on its own."""
    parts = F.split(c, "&", -1)
    return F.when(~F.contains(c, F.lit("&")), c).otherwise(F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), decoded), "")))


def tidy_location(c: Column) -> Column:
    """Runs of commas become one, commas and spaces at the ends go, nothing left gives null."""
    return blank_to_null(F.btrim(F.regexp_replace(c, r"(,\s*)+,", ","), F.lit(", ")))


def join_parts(*parts: Column) -> Column:
    """The parts that are not blank, joined by a comma; null if there are none."""
    return blank_to_null(F.concat_ws(", ", *[blank_to_null(p) for p in parts]))


def join_sections(first: Column, *others: Column, keep_first: bool = False) -> Column:
    """The sections that are not blank, one a line. keep_first: the first one has its line even if it is empty, but not if null."""
    return F.concat_ws("\n", first if keep_first else blank_to_null(first), *[blank_to_null(s) for s in others])


def headed(header: Column, body: Column, keep_empty: bool = False) -> Column:
    """A section under its header, if it has one; null without a body. keep_empty: an empty body is one, null is none."""
    return F.when((body if keep_empty else blank_to_null(body)).isNotNull(), F.concat(F.coalesce(F.concat(F.lit("<h3>"), blank_to_null(header), F.lit("</h3>")), F.lit("")), body))


def squeeze(c: Column) -> Column:
    """White space runs become a space, none at the ends; blank gives null."""
    return blank_to_null(F.btrim(F.regexp_replace(c, r"(?U)\s+", " ")))


def round_score(c: Column) -> Column:
    """Half away from zero."""
    return F.round(c).cast("long")
