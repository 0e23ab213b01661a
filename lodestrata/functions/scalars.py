"""Column functions: vocabularies, text normalisation, index arithmetic, keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stage vocabulary; anything else is "other".
STAGES = {
    "Operating": "operating",
    "Care and Maintenance": "care_and_maintenance",
    "Shut": "closed",
    "Undeveloped": "deposit",
    "Proposed": "prospect",
    "Under Development": "other",
}
STATUSES = ("operating", "care_and_maintenance", "closed", "deposit", "prospect", "other")

# Commodity codes, in the order in which groups are tried.
COMMODITY_RULES = (
    ("iron_ore", ("Fe", "FeOre", "Mag", "Hem", "Hem-MIO", "Fe-DRI", "Fe-Pellets", "FeSpec", "Fe2O3")),
    ("bauxite_alumina", ("Bx", "Al2O3Bayer", "Alu", "Al")),
    ("nickel", ("Ni", "MgsNi")),
    ("mineral_sands", ("HM", "Ilm", "Zrn", "Leu", "Rt", "Mnz", "Grt", "IlmRt-syn", "Xen")),
    ("gold", ("Au",)),
)
COMMODITY_GROUPS = ("iron_ore", "gold", "bauxite_alumina", "nickel", "mineral_sands", "other")
SHAPES = ("elongated", "intermediate", "compact")
NO_OWNER_NAME = "(owner name not stated)"
FILL_INDEX, FILL_SHARE, COVERAGE_START = -999, 255, 1937


def classify_stage(stage: Column) -> Column:
    table = F.create_map(*[F.lit(x) for pair in STAGES.items() for x in pair])
    return F.coalesce(F.try_element_at(table, stage), F.lit("other"))


def is_blank(c: Column) -> Column:
    """True for null and for nothing but blanks."""
    return F.coalesce(F.trim(c) == "", F.lit(True))


def sort_name(c: Column) -> Column:
    """Lower case, single blanks; null is empty. For ordering only."""
    return F.coalesce(F.lower(F.trim(F.regexp_replace(c, r"\s+", " "))), F.lit(""))


def format_owner_name(c: Column) -> Column:
    return F.when(is_blank(c), NO_OWNER_NAME).otherwise(F.trim(c))


def format_pct(c: Column) -> Column:
    """The number as stated without trailing zeros, never rounded; blank and Unknown are null, other text stays."""
    t = F.trim(c)
    plain = F.when(F.instr(t, ".") > 0, F.regexp_replace(F.regexp_replace(t, "0+$", ""), r"\.$", "")).otherwise(t)
    plain = F.regexp_replace(plain, r"^([+-]?)0+(?=[0-9])", "$1")
    plain = F.regexp_replace(plain, r"^\+", "")
    plain = F.when(plain.isin("", "-", "-0"), "0").otherwise(F.regexp_replace(plain, r"^(-?)\.", "$10."))
    scaled = F.regexp_replace(F.regexp_replace(t.try_cast("decimal(38,18)").cast("string"), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    number = t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$")
    exponent = t.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)[eE][+-]?[0-9]+$")
    return F.when(is_blank(c) | (F.lower(t) == "unknown"), F.lit(None).cast("string")).when(number, plain).when(exponent, F.coalesce(scaled, t)).otherwise(t)


def render_owner(name: Column, pct: Column) -> Column:
    shown = format_pct(pct)
    return F.concat(format_owner_name(name), F.when(shown.isNull(), " (holding not stated)").otherwise(F.concat(F.lit(" ("), shown, F.lit("%)"))))


def classify_commodity(codes: Column, rules: Sequence[tuple[str, Sequence[str]]] = COMMODITY_RULES) -> Column:
    """First group one of whose codes is among the comma-separated tokens, whole and in any case; blank is null, a violation."""
    tokens = F.transform(F.split(codes, ","), lambda t: F.lower(F.trim(t)))
    out = F.when(is_blank(codes), F.lit(None).cast("string"))
    for group, members in rules:
        out = out.when(F.arrays_overlap(tokens, F.array(*[F.lit(m.lower()) for m in members])), group)
    return out.otherwise("other")


def compactness(area: Column, perimeter: Column) -> Column:
    """4 pi A / P^2: 1 for a disc; null where the perimeter is zero."""
    return F.try_divide(F.lit(4.0) * F.pi() * area, perimeter * perimeter)


def shape_class(c: Column) -> Column:
    """Null, a violation, where the compactness is no number in (0, 1]."""
    fine = c.isNotNull() & ~F.isnan(c) & (c > 0) & (c <= 1 + 1e-9)
    return F.when(~fine, F.lit(None).cast("string")).when(c < 0.20, "elongated").when(c < 0.50, "intermediate").otherwise("compact")


def decode_index_band(c: Column) -> Column:
    return F.when(c == FILL_INDEX, F.lit(None)).otherwise(c / 10000.0)


def decode_share(c: Column) -> Column:
    """255 is no value; values beyond 100 stay and are counted by out_of_range."""
    return F.when(c == FILL_SHARE, F.lit(None)).otherwise(c.cast("double"))


def out_of_range(share: Column) -> Column:
    return F.coalesce(share > 100, F.lit(False))


def finite(*bands: Column) -> Column:
    out = F.lit(True)
    for b in bands:
        out = out & b.isNotNull() & ~F.isnan(b)
    return out


def valid_index_pixel(nir: Column, swir: Column, swir2: Column | None = None) -> Column:
    """All bands there, and neither index divides by zero."""
    bands = [nir, swir] + ([swir2] if swir2 is not None else [])
    ok = finite(*bands)
    for other in bands[1:]:
        ok = ok & F.coalesce(nir + other != 0, F.lit(False))
    return ok


def norm_diff(a: Column, b: Column) -> Column:
    return F.try_divide(a - b, a + b)


DATE_PATTERNS = ("d/M/yyyy", "d-M-yyyy", "yyyy-MM-dd", "d/M/yyyy H:mm:ss", "yyyy-MM-dd HH:mm:ss")


def normalise_date(c: Column) -> Column:
    """ISO date of a day-first date; text that is none stays, so that it shows as a value of its own."""
    t = F.trim(c)
    return F.coalesce(*[F.date_format(F.try_to_timestamp(t, F.lit(p)), "yyyy-MM-dd") for p in DATE_PATTERNS], t)


def normalise_code(c: Column) -> Column:
    return F.upper(F.trim(F.coalesce(c, F.lit(""))))


def item_year(c: Column) -> Column:
    """The first four characters as a year; null, a violation, where they are no digits."""
    return F.when(c.rlike("^[0-9]{4}"), F.substring(c, 1, 4).cast("int"))


def in_coverage_window(year: Column, snapshot_year: int) -> Column:
    return year.between(COVERAGE_START, snapshot_year - 1)


def expected_days(year: Column) -> Column:
    return F.dayofyear(F.make_date(year, F.lit(12), F.lit(31)))


def cell_id(lat: Column, lon: Column) -> Column:
    return F.format_string("%.3f_%.3f", lat, lon)


def window_side(span: Column) -> Column:
    """Pixels of a square window around a span in metres, 67 at least."""
    return F.greatest(F.ceil((span + 600) / 30.0) + 1, F.lit(67).cast("long"))


def window_basis(span: Column) -> Column:
    return F.when(F.ceil((span + 600) / 30.0) + 1 > 67, "footprint").otherwise("floor")


def stratum_key(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def content_id(c: Column) -> Column:
    """Twelve hex digits that name the content."""
    return F.substring(F.sha2(c, 256), 1, 12)


GEOMETRY_EXACT = frozenset({"lon", "lat", "longitude", "latitude", "x", "y"})
GEOMETRY_PART = ("geom", "wkt", "wkb", "easting", "northing")


def is_wkt(c: Column) -> Column:
    t = F.upper(F.trim(F.regexp_replace(c, r"(?i)^\s*SRID=[0-9]+;", "")))
    return F.coalesce(t.rlike(r"^(MULTI)?(POINT|LINESTRING|POLYGON)\s*(Z|M|ZM)?\s*(\(|EMPTY)|^GEOMETRYCOLLECTION\s*(\(|EMPTY)"), F.lit(False))


def is_wkb(c: Column) -> Column:
    """Byte order and one of the seven geometry types at the start of a binary value."""
    return F.coalesce(F.hex(F.substring(c, 1, 5)).rlike("^(010[1-7]000000|000000000[1-7])$"), F.lit(False))


def has_geometry_name(name: str) -> bool:
    low = name.lower()
    return low in GEOMETRY_EXACT or any(p in low for p in GEOMETRY_PART)


# The four products of the pixel series.
SOURCES = (("fc", "share", None), ("gm5", "index", "sensor 5"), ("gm7", "index", "sensor 7"), ("gm8", "index", "sensors 8 and 9"))
METRICS_OF = {"share": ("bare", "pv", "npv"), "index": ("nbr", "ndmi")}


def sensor_for(source: Column) -> Column:
    """Null for the product of several sensors, and for names that are none."""
    table = F.create_map(*[F.lit(x) for name, _, sensor in SOURCES for x in (name, sensor)])
    return F.try_element_at(table, source)


def kind_of(source: Column) -> Column:
    table = F.create_map(*[F.lit(x) for name, kind, _ in SOURCES for x in (name, kind)])
    return F.try_element_at(table, source)
