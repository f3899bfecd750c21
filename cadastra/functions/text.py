"""Address text as Column expressions: streets, house numbers, splits and parses.

All patterns carry (?U) so that word borders and white space are Unicode's; matching is
in the JVM, inside whole-stage code. Null in, null out, unless said otherwise."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Street abbreviations, in the order in which they are replaced.
STREET_WORDS = [
    ("u", "utca"),
    ("krt", "körút"),
    ("stny", "sétány"),
    ("rkp", "rakpart"),
    ("fs", "fasor"),
    ("sgt", "sugárút"),
    ("ltp", "lakótelep"),
    ("udv", "udvar"),
    ("hrsz", "helyrajzi szám"),
    ("st", "utca"),
    ("rd", "út"),
    ("ave", "sugárút"),
    ("blvd", "körút"),
]
# Abbreviations that are not written with a dot.
DOTLESS = {"hrsz"}
# Words from which on a house number is cut off.
BUILDING_TAIL = r"épület|epulet|l[eé]pcs[őo]h[áa]z|lph\.?|lh\.?|emelet|ajt[óo]|szint|building"
# Words that are taken out of a registry's house number.
BUILDING_WORDS = r"building|bldg\.?|block|blokk|épület|epulet"
# Letters of the Hungarian alphabet.
LETTERS = "A-Za-zÁÉÍÓÖŐÚÜŰáéíóöőúüű"
# A house number is low [- high] [letter].
HOUSE = r"(?U)^\s*(\d+)\s*(?:-\s*(\d+))?\s*([A-Za-z])?\s*$"
# Accented letters and what they fold to.
ACCENTED = "áàâäãåéèêëíìîïóòôöõőúùûüűýÿçñÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕŐÚÙÛÜŰÝÇÑ"
FOLDED = "aaaaaaeeeeiiiioooooouuuuuyycnAAAAAAEEEEIIIIOOOOOOUUUUUYCN"


def replace(c: Column, *steps: tuple[str, str]) -> Column:
    """Regular-expression replacements one after the other."""
    return reduce(lambda x, s: F.regexp_replace(x, s[0], s[1]), steps, c)


def squeeze(c: Column) -> Column:
    """White space runs to one space, none at the ends."""
    return replace(c, (r"(?U)\s+", " "), (r"^ | $", ""))


def expand_street(c: Column) -> Column:
    """Abbreviated street words in full, spaces squeezed, dots at the end dropped."""
    words = [(rf"(?iU)\b{short}{'' if short in DOTLESS else '\\.?'}\b", full) for short, full in STREET_WORDS]
    return F.regexp_replace(squeeze(replace(c, *words)), r"\.+$", "")


def street_key(c: Column) -> Column:
    """First-generation street key: invisible characters out, a final u or ut. in full, lower case."""
    seen = F.translate(F.replace(c, F.lit("\u00a0"), F.lit(" ")), "\u200b\u200c\u200d\u2060\ufeff", "")
    ends = replace(seen, (r"(?U)\s+", " "), (r"(?iU)\bu\s*\.?\s*$", " utca"), (r"(?iU)\bút\.\s*$", " út"), (r"(?iU)\but\.\s*$", " út"))
    return F.lower(squeeze(ends))


def number_key(c: Column) -> Column:
    """First-generation house number key: text, no trailing .0, no white space."""
    return replace(c.cast("string"), (r"(?U)^\s+|\s+$", ""), (r"\.0$", ""), (r"(?U)\s+", ""))


def fold_ascii(c: Column) -> Column:
    """Accents dropped from Latin letters."""
    return F.translate(c, ACCENTED, FOLDED)


def is_blank(c: Column) -> Column:
    """Null, empty or white space only; never null."""
    return c.isNull() | (squeeze(F.coalesce(c, F.lit(""))) == "")


def move_misplaced(street: Column, number: Column) -> tuple[Column, Column]:
    """A parcel number (hrsz), or any number without a street, is the street; the number is then null.
    Both results come from the old values."""
    parcel = F.coalesce(number.rlike(r"(?iU)\bhrsz\b"), F.lit(False))
    street1, number1 = F.when(parcel, number).otherwise(street), F.when(~parcel, number)
    alone = is_blank(street1) & ~is_blank(number1)
    return F.when(alone, number1).otherwise(street1), F.when(~alone, number1)


def standard_number(c: Column) -> Column:
    """A house number in standard form; blanks are left as they are."""
    steps = replace(
        replace(c, (r"(?U)^\s+|\s+$", "")),
        (rf"(?iU)\s*({BUILDING_TAIL})\b.*$", ""),
        (r"/", " "),
        (r"(?U)(?<!\d)-|-(?!\d)", " "),
        (rf"(?U)(\d)([{LETTERS}])", "$1 $2"),
    )
    return F.when(is_blank(c), c).otherwise(F.upper(squeeze(steps)))


def strip_zeros(c: Column) -> Column:
    """Leading zeros off every run of digits."""
    return F.regexp_replace(c, r"(?<!\d)0+(?=\d)", "")


def repair_number(c: Column) -> Column:
    """A registry's house number with stray marks, building words, zeros and doubled letters out."""
    clean = squeeze(replace(c, (r"[{}=]", " "), (r"[<>]", " "), (rf"(?iU)\b({BUILDING_WORDS})\b", " ")))
    doubled = [r"(?U)(\b\d+/\w)\s+[A-Z]\b", r"(?U)(\b\d+\s+[A-Z])\s+[A-Z]\b", r"(?U)(\b\d+-\d+[A-Z])\s+[A-Z]\b"]
    return replace(squeeze(strip_zeros(clean)), *((p, "$1") for p in doubled))


def split_at_digit(c: Column) -> tuple[Column, Column]:
    """Street and house number, parted before the first digit; both null where there is none."""
    pattern = r"^([^0-9]*)([0-9].*)$"
    has = c.rlike(pattern)
    return F.when(has, replace(F.regexp_extract(c, pattern, 1), (r"(?U)^\s+|\s+$", ""))), F.when(has, replace(F.regexp_extract(c, pattern, 2), (r"(?U)^\s+|\s+$", "")))


def split_last_number(c: Column) -> tuple[Column, Column]:
    """Street and the last token if it starts with a digit (else null)."""
    pattern = r"(?U)^(.*?)(?:\s+(\d+\S*))?$"
    number = F.regexp_extract(c, pattern, 2)
    return replace(F.regexp_extract(c, pattern, 1), (r"(?U)^\s+|\s+$", "")), F.when(number != "", number)


def parse_house(c: Column) -> Column:
    """struct(lo, hi, letter) of a house number; null where it does not parse or hi <= lo."""
    lo = F.regexp_extract(c, HOUSE, 1).try_cast("int")
    hi = F.regexp_extract(c, HOUSE, 2).try_cast("int")
    letter = F.upper(F.nullif(F.regexp_extract(c, HOUSE, 3), F.lit("")))
    return F.when(lo.isNotNull() & (hi.isNull() | (hi > lo)), F.struct(lo.alias("lo"), F.coalesce(hi, lo).alias("hi"), letter.alias("letter")))


def parse_house_lenient(c: Column) -> Column:
    """As parse_house, but a range given backwards is turned round."""
    lo = F.regexp_extract(c, HOUSE, 1).try_cast("int")
    hi = F.coalesce(F.regexp_extract(c, HOUSE, 2).try_cast("int"), lo)
    letter = F.upper(F.nullif(F.regexp_extract(c, HOUSE, 3), F.lit("")))
    return F.when(lo.isNotNull(), F.struct(F.least(lo, hi).alias("lo"), F.greatest(lo, hi).alias("hi"), letter.alias("letter")))


def houses_overlap(a: Column, b: Column, letters: bool = True) -> Column:
    """Whether two parsed house numbers share a number, and with `letters` the letter too."""
    meet = F.greatest(a["lo"], b["lo"]) <= F.least(a["hi"], b["hi"])
    return meet & a["letter"].eqNullSafe(b["letter"]) if letters else meet


def letter_and_digit(c: Column) -> Column:
    """Whether a text has a letter and a digit; false for null."""
    return F.coalesce(c.rlike(r"\p{L}") & c.rlike(r"\p{Nd}"), F.lit(False))


def has_name(names: Column) -> Column:
    """Whether an array of names has one that is not blank; false for null."""
    return F.coalesce(F.exists(names, lambda x: ~is_blank(x)), F.lit(False))


def edge_colour(names: Column) -> Column:
    return F.when(has_name(names), "white").otherwise("red")


def first_place_name(city: Column, town: Column, village: Column, municipality: Column, river: Column, asked: Column) -> Column:
    """The name that a place lookup gives: the first of its levels, or what was asked for."""
    return F.coalesce(city, town, village, municipality, river, asked)


def repair_coordinates(cells: Column, lat: Column, lon: Column) -> Column:
    """struct(lat, lon): a pair outside 45-49 N, 16-23 E is looked for among all cells of the row.
    A missing latitude takes the first cell in the latitude window, a missing longitude the first
    in the longitude window but for that cell."""
    numbers = F.transform(cells, lambda x: x.try_cast("double"))
    good_lat, good_lon = F.coalesce(lat.between(45, 49), F.lit(False)), F.coalesce(lon.between(16, 23), F.lit(False))
    at = F.transform(numbers, lambda x, i: F.struct(i.alias("i"), x.alias("x")))
    lat_cell = F.get(F.filter(at, lambda c: c["x"].between(45, 49)), 0)
    used = F.when(~good_lat, lat_cell["i"])
    lon_cell = F.get(F.filter(at, lambda c: c["x"].between(16, 23) & ~F.coalesce(c["i"] == used, F.lit(False))), 0)
    new_lat = F.when(good_lat, lat).otherwise(lat_cell["x"])
    new_lon = F.when(good_lon, lon).otherwise(lon_cell["x"])
    return F.struct(new_lat.alias("lat"), new_lon.alias("lon"))
