"""Artist texts: 'name (nationality, dates)' or name and details on two lines, to structs with a status.

All expressions are built in; the pairing of lines is a fold over the lines.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import let
from ..schema import ARTIST

#: Words that say that a name is no primary maker's (fixed values).
ATTRIBUTION = ("workshop", "circle of", "follower of", "manner of", "style of", "attributed to", "after ", "school of", "copy")
ROLES = r"(?:workshop of|circle of|follower of|manner of|style of|attributed to|after|school of|copy after|imitator of|designed by|made by|published by|printed by|publisher|printer|designer|manufacturer)"
#: Nationalities that show a text without dates to be a place and no person.
PLACES = ("china", "japan", "india", "egypt", "greece", "italy", "france", "germany", "spain", "england", "netherlands", "persia", "iran", "korea", "mexico", "peru", "united states", "chinese", "japanese", "indian", "egyptian", "greek", "roman", "italian", "french", "german", "spanish", "english", "dutch", "flemish", "american", "british", "persian", "korean", "mexican", "peruvian")


def life_dates(text: Column) -> Column:
    """(begin, end) as strings: ranges with abbreviated ends, one side only, centuries counted from 0 (19th: 1800-1899), active decades and ranges, founded."""
    s = F.lower(F.regexp_replace(F.translate(text, "–—−", "---"), r"\s+", " "))
    year = r"(\d{4})(?:/\d{1,4})?"
    get = lambda p, k: F.nullif(F.regexp_extract(s, p, k), F.lit(""))
    ranged = rf"(?:active|born)?\s*(?:ca?\.?\s*)?{year}\s*-\s*(?:ca?\.?\s*)?(\d{{4}}|\d{{2}})(?:/\d{{1,4}})?"
    b, e = get(ranged, 1), get(ranged, 2)
    end = F.when(F.length(e) == 2, F.when(F.concat(F.substring(b, 1, 2), e) >= b, F.concat(F.substring(b, 1, 2), e)).otherwise(F.concat((F.substring(b, 1, 2).cast("int") + 1).cast("string"), e))).otherwise(e)
    century = r"(\d{1,2})(?:st|nd|rd|th)(?:[\s\-]+(\d{1,2})(?:st|nd|rd|th))? century"
    c1, c2 = get(century, 1).cast("int"), F.coalesce(get(century, 2), get(century, 1)).cast("int")
    decade = r"active\s*(?:ca?\.?\s*)?(\d{3}0)s"
    single = lambda word: rf"{word}\s*(?:ca?\.?\s*)?(\d{{4}})"
    pair = lambda x, y: F.struct(x.cast("string").alias("begin"), y.cast("string").alias("end"))
    none = F.lit(None).cast("string")
    return (
        F.when(s.rlike(ranged), pair(b, end))
        .when(s.rlike(decade), pair(get(decade, 1), get(decade, 1).cast("int") + 9))
        .when(s.rlike(century), pair((c1 - 1) * 100, (c2 - 1) * 100 + 99))
        .when(s.rlike(single("(?:born|founded|established)")), pair(get(single("(?:born|founded|established)"), 1), none))
        .when(s.rlike(single("died")), pair(none, get(single("died"), 1)))
        .when(s.rlike(r"\b\d{4}\b"), pair(get(r"\b(\d{4})\b", 1), none))
        .otherwise(pair(none, none))
    )


def _details(text: Column) -> tuple[Column, Column]:
    """(nationality, dates struct) of 'nationality, dates'."""
    nationality = F.nullif(F.trim(F.regexp_replace(F.regexp_extract(text, r"^([^,\d]*)", 1), r"(?i)\b(?:active|born|founded|died|ca?\.?)\s*$", "")), F.lit(""))
    return nationality, life_dates(text)


_INLINE = rf"^(?i)(?:({ROLES})\s+)?([^()]+?)\s*\(([^()]*)\)$"
_DETAIL = r"^[^()]*(?:\d{4}|\d{1,2}(?:st|nd|rd|th) century).*$"
_FIELDS = "struct<artist_name:string,artist_role:string,artist_nationality:string,artist_date_begin:string,artist_date_end:string>"


def _record(role: Column, name: Column, details: Column) -> Column:
    nationality, dates = _details(details)
    named = lambda d: F.struct(name.alias("artist_name"), F.coalesce(F.nullif(F.lower(role), F.lit("")), F.lit("primary")).alias("artist_role"), nationality.alias("artist_nationality"), d["begin"].alias("artist_date_begin"), d["end"].alias("artist_date_end")).cast(_FIELDS)
    return let(dates, named)


def valid(a: Column) -> Column:
    """A primary maker whose name and nationality look like such: no attribution words, no stray brackets, not too long."""
    name = F.lower(a["artist_name"])
    words = reduce(lambda x, w: x | name.contains(w), ATTRIBUTION, F.lit(False))
    return (a["artist_role"] == "primary") & ~words & ~a["artist_name"].rlike(r"[()]") & (F.length(a["artist_name"]).between(1, 100)) & (F.length(F.coalesce(a["artist_nationality"], F.lit(""))) <= 50)


def parse_artist(text: Column) -> Column:
    """(status, artists): parsed with its list, non_artist for pure places and nationalities, unparsed otherwise; null for blank texts.

    Texts with several makers are not parsed. One unreadable line leaves the whole text unparsed.
    """
    lines = F.filter(F.transform(F.split(text, "\n"), lambda x: F.trim(x)), lambda x: x != "")

    def step(state: Column, line: Column) -> Column:
        inline = line.rlike(_INLINE)
        detail = ~inline & (state["pending"] != "") & line.rlike(_DETAIL)
        bare = ~inline & ~detail & (state["pending"] == "") & ~line.rlike(r"[()\d]")
        new = F.when(inline, _record(F.regexp_extract(line, _INLINE, 1), F.regexp_extract(line, _INLINE, 2), F.regexp_extract(line, _INLINE, 3))).when(detail, _record(F.lit(""), state["pending"], line))
        return F.struct(
            F.when(inline | detail, F.concat(state["found"], F.array(new))).otherwise(state["found"]).alias("found"),
            F.when(bare, line).otherwise("").alias("pending"),
            (state["bad"] | ~(inline | detail | bare) | (inline & (state["pending"] != ""))).alias("bad"),
        )

    start = F.struct(F.array().cast(f"array<{_FIELDS}>").alias("found"), F.lit("").alias("pending"), F.lit(False).alias("bad"))
    several = F.lower(text).rlike(r" and | with | ; ")
    place = F.lower(F.trim(text)).isin(*PLACES)
    empty = F.array().cast(ARTIST)

    def judged(folded: Column) -> Column:
        good = ~several & ~folded["bad"] & (folded["pending"] == "") & (F.size(folded["found"]) > 0) & F.forall(folded["found"], valid)
        return F.struct(F.when(place, "non_artist").when(good, "parsed").otherwise("unparsed").alias("status"), F.when(~place & good, folded["found"]).otherwise(empty).alias("artists"))

    return F.when(F.trim(text) != "", let(F.reduce(lines, start, step), judged))
