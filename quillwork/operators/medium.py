"""Media: dictionary terms found in free text, longest first, split into materials and techniques."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

#: term: (type, canonical name). A small dictionary; pass another for real collections.
DICTIONARY: dict[str, tuple[str, str]] = {
    "oil": ("material", "oil"), "canvas": ("material", "canvas"), "oil paint": ("material", "oil paint"), "paper": ("material", "paper"),
    "bronze": ("material", "bronze"), "marble": ("material", "marble"), "wood": ("material", "wood"), "silk": ("material", "silk"), "ink": ("material", "ink"),
    "etching": ("technique", "etching"), "engraving": ("technique", "engraving"), "lithograph": ("technique", "lithography"), "lithography": ("technique", "lithography"), "woodcut": ("technique", "woodcut"),
    "gouache": ("ambiguous", "gouache"), "watercolor": ("ambiguous", "watercolor"), "watercolour": ("ambiguous", "watercolor"), "tempera": ("ambiguous", "tempera"),
}
#: Most terms that one dictionary may have: it becomes one pattern and one literal map in the plan.
MOST_TERMS = 5_000
#: Ways in which a sheet is fixed to a support; dropped before terms are looked for.
NOISE = tuple(f"{w} down" for w in ("laid", "pasted", "mounted", "glued", "stuck", "tipped", "set", "fixed", "lined", "nailed"))


def _found(text: Column, dictionary: dict) -> Column:
    terms = "|".join(re.escape(t) for t in sorted(dictionary, key=lambda t: (-len(t), t)))
    return F.array_distinct(F.regexp_extract_all(text, F.lit(rf"\b({terms})\b"), F.lit(1)))


def _of_type(terms: Column, dictionary: dict, kind: str) -> Column:
    entries = {t: name for t, (k, name) in dictionary.items() if k in (kind, "ambiguous")}
    if not entries:
        return F.array().cast("array<string>")
    table = F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])
    return F.filter(F.transform(terms, lambda t: F.try_element_at(table, t)), lambda x: x.isNotNull())


def extract_medium(text: Column, dictionary: dict[str, tuple[str, str]] | None = None) -> Column:
    """(materials, techniques), sorted and distinct; null if neither has any.

    Terms in brackets count as techniques only. The leftmost term wins, at one place the longest, and what it
    covers is used up.
    """
    d = dictionary or DICTIONARY
    low = F.lower(text)
    low = F.regexp_replace(low, r"\b(?:" + "|".join(NOISE) + r")\b", " ")
    inside = F.translate(F.array_join(F.regexp_extract_all(low, F.lit(r"\(([^()]*)\)"), F.lit(1)), " "), "-", " ")
    outside = F.translate(F.regexp_replace(low, r"\([^()]*\)", " "), "-", " ")
    out, brackets = _found(outside, d), _found(inside, d)
    materials = F.array_sort(F.array_distinct(_of_type(out, d, "material")))
    techniques = F.array_sort(F.array_distinct(F.concat(_of_type(out, d, "technique"), _of_type(brackets, d, "technique"))))
    return F.when((F.size(materials) > 0) | (F.size(techniques) > 0), F.struct(materials.alias("materials"), techniques.alias("techniques")))


def route_terms(materials: Column, techniques: Column, dictionary: dict[str, tuple[str, str]] | None = None) -> Column:
    """Comma lists of terms, brackets removed, each put where the dictionary has it; unknown terms stay where they came from."""
    d = dictionary or DICTIONARY
    split = lambda c: F.filter(F.transform(F.split(F.lower(F.regexp_replace(F.coalesce(c, F.lit("")), r"\([^()]*\)|[\[\]'\"]", "")), ","), lambda x: F.trim(x)), lambda x: x != "")
    m, t = split(materials), split(techniques)
    kinds = {k: F.array(*[F.lit(x) for x, (kind, _) in d.items() if kind in (k, "ambiguous")]) for k in ("material", "technique")}
    known = F.array(*map(F.lit, d))
    both = F.array_distinct(F.concat(m, t))
    to = lambda kind, own: F.array_sort(F.array_distinct(F.concat(F.array_intersect(both, kinds[kind]), F.array_except(own, known))))
    mats, techs = to("material", m), to("technique", t)
    return F.when((F.size(mats) > 0) | (F.size(techs) > 0), F.struct(mats.alias("materials"), techs.alias("techniques")))
