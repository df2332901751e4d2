"""Dates: normalisation to a small grammar, parsing to year bounds, anomaly sweep."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.lists import lunar_to_ce
from ..functions.text import finite_compat, let, squeeze, unify_dashes
from ..schema import DATE

ORDINALS = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth", "eleventh", "twelfth", "thirteenth", "fourteenth", "fifteenth", "sixteenth", "seventeenth", "eighteenth", "nineteenth", "twentieth", "twenty-first")


def ordinal(n: int) -> str:
    return f"{n}{'th' if 10 <= n % 100 <= 20 else {1: 'st', 2: 'nd', 3: 'rd'}.get(n % 10, 'th')}"


#: "in or before" and "in or after" a year of three or four digits, whose month and day don't count.
_BOUND = r"in\s+or\s+%s\s+(\d{3,4})(?:-\d{2}-\d{2})?"
_UNSURE = ("possibly", "probably", "perhaps", "maybe", "about", "circa")
#: The rewrites of the normaliser in order: name, pattern, replacement. Java syntax.
RULES: list[tuple[str, str, str]] = [
    ("bounded begin", r"(?i)^in\s+or\s+(?:before|after)\s+(\d{4})\s*-\s*(?!\d{2}-\d{2}$)", "$1-"),
    ("bounded end", rf"(?i)^(\d{{3,4}})\s*-\s*{_BOUND % '(?:before|after)'}$", "$1-$2"),
    ("bounded alone", rf"(?i)^{_BOUND % '(before|after)'}$", "$1 $2"),
    ("leading doubt", rf"(?i)^(?:{'|'.join(_UNSURE)}|ca?\.?)\s+(?=\S)", "ca. "),
    ("centuries", r"(?i)\bcenturies\b", "century"),
    ("dash blanks", r"\s*-\s*", "-"),
    ("century pair", r"(?i)(\d+(?:st|nd|rd|th))\s+century-(\d+(?:st|nd|rd|th))", "$1-$2"),
    ("bce", r"(?i)\bB\.?\s?C\.?(?:\s?E\.?)?(?=[\s\-)]|$)", "BCE"),
    ("ce", r"(?i)\b(?:A\.?\s?D\.?|C\.\s?E\.?|CE)(?=[\s\-)]|$)", "CE"),
    ("doubt in brackets", r"\(\?\)", "?"),
    ("inner doubt", rf"(?i)\b(?:{'|'.join(_UNSURE)})\b", "ca."),
    ("trailing doubt", r"^(.*?)\s*\?\s*$", "ca. $1"),
    *[(f"ordinal {word}", rf"(?i)\b{word}(?=[\s\-]+(?:century|millennium|quarter|half)|-\d+(?:st|nd|rd|th) century)", ordinal(k + 1)) for k, word in sorted(enumerate(ORDINALS), key=lambda x: -len(x[1]))],
    ("quarter of the", r"(?i)\b(quarter|half)\s+(?:of\s+)?(?:the\s+)?(?=\d+(?:st|nd|rd|th))", "$1 of the "),
    ("decade", r"(?i)\b(\d{2,3})0'?s\b", "$10-$19"),
    ("repeated ca", r"(?i)\bca\.?(?:\s+ca\.?)+", "ca."),
    ("ca glued", r"(?i)\bca\.?\s*(?=\d)", "ca. "),
    ("ca twice in range", r"(?i)^(ca\. \S+)-ca\. ", "$1-"),
    ("stray c", r"(?i)\bc\.\s*(?=\d)", "ca. "),
    ("mid", r"(?i)\bmid-(?=\d|the)", "mid "),
    ("century case", r"(?i)\bcentury\b", "century"),
]

_C = r"\d{1,2}(?:st|nd|rd|th)"
_M = r"(?:early|middle|mid|late)(?: of the)?"
_Y = r"\d{1,4}"
_E = r"(?: (?:BCE|CE))"
_SHAPES = (
    rf"{_Y}(?:-{_Y})?",
    rf"(?:1st|2nd|3rd|4th|last) (?:quarter|half) of the {_C} century",
    rf"{_M} {_C} century",
    rf"{_C}(?:-{_C})? century",
    rf"(?:{_M} )?{_C}(?: century)?-(?:{_M} )?{_C} century",
    rf"{_Y}{_E}-{_Y}",
    rf"(?:{_C} century{_E})-(?:{_C} century)",
)
#: What a normalised date looks like.
VALID = rf"^(?:ca\. )?(?:(?:before|after) )?(?:{'|'.join(_SHAPES)}){_E}?$"


def normalize_date(raw: Column) -> Column:
    """The date in the canonical grammar, or null."""
    decade = next(k for k, rule in enumerate(RULES) if rule[0] == "decade") + 1

    def apply(c: Column, rules: list[tuple[str, str, str]]) -> Column:
        return reduce(lambda x, rule: F.regexp_replace(x, rule[1], rule[2]), rules, c)

    start = apply(squeeze(unify_dashes(finite_compat(raw))), RULES[:decade])
    end = let(start, lambda s: F.regexp_replace(F.trim(apply(_expand_ranges(s), RULES[decade:])), r"\.$", ""))
    return let(end, lambda s: F.when(s.rlike(VALID), s))


def _expand_ranges(s: Column) -> Column:
    """Abbreviated ends: '1736-95' and '2001-5' in full; an end that would come before the begin rolls over. Not beside BCE."""
    pattern = r"\b(\d{3,4})-(\d{1,2})\b(?!\d|(?:st|nd|rd|th))"
    begin, end = F.regexp_extract(s, pattern, 1), F.regexp_extract(s, pattern, 2)
    digits = F.length(end)
    scale = F.pow(F.lit(10), digits).cast("int")
    b, e = begin.try_cast("int"), end.try_cast("int")
    full = (b - b % scale + e).cast("int")
    full = F.when(full < b, full + scale).otherwise(full)
    changed = F.replace(s, F.concat(begin, F.lit("-"), end), F.concat(begin, F.lit("-"), full.cast("string")))
    return F.when((begin != "") & ~s.contains("BCE"), changed).otherwise(s)


def _int(c: Column) -> Column:
    return c.try_cast("int")


def _mod_bounds(mod: Column, start: Column, bce: Column, cuts: tuple[tuple[int, int], tuple[int, int], tuple[int, int]], span: int) -> tuple[Column, Column]:
    """Bounds of the early, mid or late part, or of the whole, of a period."""
    low = F.when(mod == "early", cuts[0][0]).when(mod.isin("mid", "middle"), cuts[1][0]).when(mod == "late", cuts[2][0]).otherwise(0)
    high = F.when(mod == "early", cuts[0][1]).when(mod.isin("mid", "middle"), cuts[1][1]).when(mod == "late", cuts[2][1]).otherwise(span - 1)
    return F.when(bce, start - low).otherwise(start + low), F.when(bce, start - high).otherwise(start + high)


_CENTURY = ((0, 32), (33, 65), (66, 99))
_MILLENNIUM = ((0, 332), (333, 666), (667, 999))


def _start(n: Column, span: int, bce: Column) -> Column:
    """The first year, in reading order, of the n-th century or millennium."""
    return F.when(bce, n * span).otherwise((n - 1) * span + 1)


def parse_date(text: Column) -> Column:
    """Year bounds of a date as a struct (see schema.DATE), or null. Shapes are tried in a fixed order.

    'before' and 'after' don't change the bounds; the qualifier field tells them.
    """
    lead = r"(?i)^(?:ca\.?\s+)?(?:before\s+|after\s+)?"

    def of(s: Column) -> Column:
        circa = s.rlike(r"(?i)^ca\.?\s")
        qualifier = F.nullif(F.lower(F.regexp_extract(s, r"(?i)^(?:ca\.?\s+)?(before|after)\s", 1)), F.lit(""))
        body = F.regexp_replace(F.regexp_replace(s, lead, ""), r"\s*\([^()]*\)\s*$", "")
        era = F.upper(F.regexp_extract(body, r"(?i)\s(BCE|CE)$", 1))
        core = F.lower(F.trim(F.regexp_replace(body, r"(?i)\s(?:BCE|CE)$", "")))
        return let(F.struct(core.alias("core"), (era == "BCE").alias("bce")), lambda x: let(_bounds(x["core"], x["bce"]), lambda found: _date(found, circa, s, qualifier)))

    return let(squeeze(text), of)


def _date(found: Column, circa: Column, text: Column, qualifier: Column) -> Column:
    """The date struct of found bounds, their ends in the order of their era."""
    swap = F.when(found["bb"] & found["eb"], found["b"] < found["e"]).when(~found["bb"] & ~found["eb"], found["b"] > found["e"]).otherwise(False)
    first, second = F.when(swap, found["e"]).otherwise(found["b"]), F.when(swap, found["b"]).otherwise(found["e"])
    return F.when(found["b"].isNotNull() & found["e"].isNotNull(), F.struct(first.alias("date_begin"), second.alias("date_end"), found["bb"].alias("date_begin_bce"), found["eb"].alias("date_end_bce"), circa.alias("circa"), text.alias("notes"), qualifier.alias("qualifier")).cast(DATE))


def _bounds(core: Column, bce: Column) -> Column:
    """(b, e, bb, eb) of the first shape that fits, else null."""

    def group(pattern: str, k: int) -> Column:
        return F.regexp_extract(core, pattern, k)

    def struct(b: Column, e: Column, b_bce: Column, e_bce: Column) -> Column:
        return F.struct(b.cast("int").alias("b"), e.cast("int").alias("e"), b_bce.alias("bb"), e_bce.alias("eb"))

    # text behind a century or millennium doesn't matter
    mod = r"(?:(early|middle|mid|late)[\s\-]+(?:of\s+the\s+)?)?"
    nth = r"(\d{1,2})(?:st|nd|rd|th)"
    side = r"(?:\s+(bce|ce))?"
    branches: list[tuple[str, Column]] = []

    p = r"^(\d{4})-(\d{2})-(\d{2})$|^(\d{4})-(0[1-9]|1[0-2])-?$"
    iso = _int(F.coalesce(F.nullif(group(p, 1), F.lit("")), group(p, 4)))
    branches.append((r"^\d{4}-\d{2}-\d{2}$", struct(iso, iso, bce, bce)))

    p = rf"^(1st|2nd|3rd|4th|last)\s+(quarter|half)\s+of\s+the\s+{nth}\s+century"
    span = F.when(group(p, 2) == "quarter", 25).otherwise(50)
    k = F.when(group(p, 1) == "last", F.when(group(p, 2) == "quarter", 4).otherwise(2)).otherwise(_int(F.substring(group(p, 1), 1, 1)))
    start = _start(_int(group(p, 3)), 100, bce)
    at = F.when(bce, start - (k - 1) * span).otherwise(start + (k - 1) * span)
    branches.append((p, struct(at, F.when(bce, at - span + 1).otherwise(at + span - 1), bce, bce)))

    for unit, size, cuts in (("millennium", 1000, _MILLENNIUM), ("century", 100, _CENTURY)):
        if unit == "century":
            p = rf"^{mod}{nth}(?:\s+century)?{side}-{mod}{nth}\s+century"
            own = rf"^{mod}{nth}\s+century\s+(?:bce|ce)-{mod}{nth}\s+century"
            b1 = F.when(group(p, 3) != "", group(p, 3) == "bce").otherwise(bce)
            two = struct(
                _mod_bounds(group(p, 1), _start(_int(group(p, 2)), size, b1), b1, cuts, size)[0],
                _mod_bounds(group(p, 4), _start(_int(group(p, 5)), size, bce), bce, cuts, size)[1], b1, bce)
            branches.append((own, two))
            branches.append((p, two))
        else:
            p = rf"^{mod}{nth}(?:\s+millennium)?-{mod}{nth}\s+millennium"
            branches.append((p, struct(
                _mod_bounds(group(p, 1), _start(_int(group(p, 2)), size, bce), bce, cuts, size)[0],
                _mod_bounds(group(p, 3), _start(_int(group(p, 4)), size, bce), bce, cuts, size)[1], bce, bce)))
    for unit, size, cuts in (("millennium", 1000, _MILLENNIUM), ("century", 100, _CENTURY)):
        p = rf"^(?:the\s+)?{mod}{nth}\s+{unit}"
        low, high = _mod_bounds(group(p, 1), _start(_int(group(p, 2)), size, bce), bce, cuts, size)
        branches.append((p, struct(low, high, bce, bce)))

    p = r"^(\d{2,3}0)'?s(?:-(\d{2,3}0)'?s)?$"
    last = F.coalesce(_int(F.nullif(group(p, 2), F.lit(""))), _int(group(p, 1))) + 9
    branches.append((p, struct(_int(group(p, 1)), last, bce, bce)))

    p = r"^(\d{1,4})\s+(bce|ce)-(\d{1,4})$"
    branches.append((p, struct(_int(group(p, 1)), _int(group(p, 3)), group(p, 2) == "bce", bce)))

    p = r"^(\d{1,4})-(\d{1,4})$"
    b, e = _int(group(p, 1)), _int(group(p, 2))
    scale = F.pow(F.lit(10), F.length(group(p, 2))).cast("int")
    full = (b - b % scale + e).cast("int")
    short = F.length(group(p, 2)) < F.length(group(p, 1))
    end_ce = F.when(short, F.when(full > b, full).when(full + scale > b, full + scale).otherwise(e)).otherwise(e)
    end_bce = F.when(short & (full < b), full).otherwise(e)
    branches.append((p, struct(b, F.when(bce, end_bce).otherwise(end_ce), bce, bce)))

    branches.append((r"^\d{1,4}$", struct(_int(core), _int(core), bce, bce)))

    return reduce(lambda chain, x: F.when(core.rlike(x[0]), x[1]).otherwise(chain), reversed(branches), F.lit(None))


def parse_with_fallback(raw: Column, normalized: Column) -> Column:
    """The normalised text's bounds, else the raw text's; only where there is a raw text."""
    return F.when(raw.isNotNull(), F.coalesce(parse_date(normalized), parse_date(raw)))


def anomalous(d: Column, latest: int = 2026, widest: int = 3000) -> Column:
    """Whether bounds contradict each other or are out of reach; missing ends are fine."""
    b, e, bb, eb = d["date_begin"], d["date_end"], F.coalesce(d["date_begin_bce"], F.lit(False)), F.coalesce(d["date_end_bce"], F.lit(False))
    span = F.when(bb & ~eb, b + e).otherwise(F.abs(e - b))
    bad = F.when(~bb & ~eb, (b > e) | (b > latest) | (e > latest)).when(bb & eb, b < e).when(~bb & eb, F.lit(True)).otherwise(False)
    return F.when(b.isNull() | e.isNull(), False).otherwise(bad | (span > widest))


def sweep(d: Column, **limits: int) -> Column:
    """The bounds, or null where they are anomalous."""
    return F.when(d.isNotNull() & ~anomalous(d, **limits), d)


def widest_span(ranges: Column) -> Column:
    """Several date structs in one: from the least signed begin to the greatest signed end."""
    sign = lambda y, f: F.when(f, -y).otherwise(y)
    low = F.array_min(F.transform(ranges, lambda r: sign(r["date_begin"], r["date_begin_bce"])))
    high = F.array_max(F.transform(ranges, lambda r: sign(r["date_end"], r["date_end_bce"])))
    return F.struct(F.abs(low).alias("date_begin"), F.abs(high).alias("date_end"), (low < 0).alias("date_begin_bce"), (high < 0).alias("date_end_bce"))


def open_ended(d: Column) -> Column:
    """The bounds with a null where 'before' or 'after' leaves a side open."""
    return d.withField("date_begin", F.when(d["qualifier"] == "before", F.lit(None).cast("int")).otherwise(d["date_begin"])).withField("date_end", F.when(d["qualifier"] == "after", F.lit(None).cast("int")).otherwise(d["date_end"]))


def lunar_date(text: Column) -> Column:
    """CE year of 'AH 1255' or '1255 AH'; with both calendars given, the CE year as written; null otherwise."""
    ce = F.regexp_extract(text, r"(?i)(?:A\.?H\.?\s*\d{1,4}|\d{1,4}\s*A\.?H\.?)\s*/\s*(?:A\.?D\.?\s*|CE\s*)?(\d{3,4})", 1).try_cast("int")
    ah = F.coalesce(F.regexp_extract(text, r"(?i)A\.?H\.?\s*(\d{1,4})", 1).try_cast("int"), F.regexp_extract(text, r"(?i)(\d{1,4})\s*A\.?H\.?", 1).try_cast("int"))
    return F.coalesce(ce, lunar_to_ce(ah))
