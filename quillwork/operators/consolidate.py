"""Consolidation: nested parse results unwrapped into the canonical columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lists import clean_role, clean_year
from ..functions.text import real
from ..schema import CANONICAL_COLUMNS


def unwrap_date(parsed: Column, begin: Column, end: Column) -> dict[str, Column]:
    """Bounds and flags from the struct, else from the source's own years; negative years become positive with a flag."""
    b, e = F.coalesce(parsed["date_begin"], begin.cast("string").try_cast("double").cast("int")), F.coalesce(parsed["date_end"], end.cast("string").try_cast("double").cast("int"))
    flag = lambda f, y: F.when(y.isNotNull(), F.coalesce(f, F.lit(False)) | (y < 0))
    return {"date_begin": F.abs(b), "date_end": F.abs(e), "date_begin_bce": flag(parsed["date_begin_bce"], b), "date_end_bce": flag(parsed["date_end_bce"], e)}


def unwrap_list(items: Column) -> Column:
    """Without empty items; null if none is left."""
    kept = F.filter(items, lambda x: x.isNotNull() & (F.trim(x) != ""))
    return F.when(F.size(kept) > 0, kept)


def unwrap_dimensions(text: Column) -> Column:
    """The JSON text without a scratchpad; other text as it is."""
    v = F.try_parse_json(text)
    clean = F.to_json(F.map_filter(F.from_json(text, "map<string,string>"), lambda k, _: k != "scratchpad"))
    return F.when(v.isNotNull() & text.contains('"scratchpad"'), clean).otherwise(text)


def unwrap_artist(artists: Column, source: dict[str, Column]) -> dict[str, Column]:
    """The first parsed artist's fields, each falling back to the source's own."""
    first = F.try_element_at(artists, F.lit(1))
    pick = lambda c: F.coalesce(real(first[c]), real(source[c]))
    return {
        "artist_name": pick("artist_name"), "artist_role": clean_role(pick("artist_role")), "artist_nationality": pick("artist_nationality"),
        "artist_date_begin": clean_year(pick("artist_date_begin")).try_cast("int"), "artist_date_end": clean_year(pick("artist_date_end")).try_cast("int"),
    }


def location(country: Column, region: Column, city: Column, parsed: list[Column] = ()) -> Column:
    """The first place there is: country, region, city, then what a parser found."""
    return F.coalesce(*[real(c) for c in (country, region, city, *parsed)])


def consolidate(df: DataFrame) -> DataFrame:
    """The 24 canonical columns of parsed records (parsed_date, parsed_medium, parsed_artist structs, parsed_dimensions)."""
    out = unwrap_date(F.col("parsed_date"), F.col("date_begin"), F.col("date_end"))
    out |= {"materials": unwrap_list(F.col("parsed_medium.materials")), "techniques": unwrap_list(F.col("parsed_medium.techniques")), "dimensions_json": F.col("parsed_dimensions")}
    out |= unwrap_artist(F.col("parsed_artist.artists"), {c: F.col(c) for c in ("artist_name", "artist_role", "artist_nationality", "artist_date_begin", "artist_date_end")})
    out |= {"location": location(F.col("country"), F.col("region"), F.col("city")), "culture": real(F.col("culture"))}
    return df.select([out[c].alias(c) if c in out else F.col(c) for c in CANONICAL_COLUMNS])
