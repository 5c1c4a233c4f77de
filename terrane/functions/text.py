"""Text, id and status Columns. Templates compile to one Column; everything stays in generated code."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings that stand for no id.
NULL_IDS = ("", "0", "nan", "none", "null", "na", "n/a")
#: Fixed value: names that stand for no name.
PLACEHOLDER = r"^(no common name|unnamed|unknown|no name|n/?a)\b"
#: Crosswalk column and id pattern by id prefix.
ID_PREFIXES = {"MRGID": ("mrgid", r"^(\d+)"), "PSGID": ("psgid", r"^(.+)$"), "MPAINV": ("mpainv_site_id", r"^(.+)$"), "MPA": ("mpainv_site_id", r"^(.+)$")}
#: Which copy of a place search shows first, by collection.
SEARCH_RANKS = {"mpa_inventory": 1, "noaa_hapc": 1}
OWN_RANK = 2
SEARCH_RANK_PREFIXES = {"protectedseas_": 1}
#: Group names.
GROUP_LABELS = {
    "fish": "fish", "hardCorals": "hard corals", "seaTurtles": "sea turtles", "marineMammals": "marine mammals", "seabirds": "seabirds",
    "seagrasses": "seagrasses", "mangroves": "mangroves", "macroalgae": "macroalgae", "zooplankton": "zooplankton", "phytoplankton": "phytoplankton",
}
#: Letters that decompose into one letter and combining marks, and that letter; the marks themselves follow and have none.
_BARE = {chr(i): "".join(x for x in unicodedata.normalize("NFD", chr(i)) if not unicodedata.combining(x)) for i in range(0xC0, 0x30000) if not 0xD800 <= i < 0xE000}
_FOLDED = [c for c, x in _BARE.items() if x != c and len(x) == 1]
ACCENTED = "".join(_FOLDED) + "".join(c for c, x in _BARE.items() if not x)
PLAIN = "".join(_BARE[c] for c in _FOLDED)

Filter = Callable[[Column, str, Callable[[str], Column]], Column]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """The value as stripped text, null as empty."""
    return F.coalesce(F.trim(col(c).cast("string")), F.lit(""))


def squash(c: Column | str) -> Column:
    """White space runs made one space; blank is null."""
    return F.nullif(F.trim(F.regexp_replace(col(c).cast("string"), r"\s+", " ")), F.lit(""))


def slug(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(col(c), F.lit(""))), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def unaccented(c: Column | str) -> Column:
    """Letters without their accents: what canonical decomposition leaves when combining marks are dropped. Hangul syllables, which decompose into letters, stay whole."""
    return F.translate(col(c), ACCENTED, PLAIN)


def slug_part(c: Column | str) -> Column:
    return slug(unaccented(c))


def norm_name(c: Column | str) -> Column:
    """The key that two copies of a name share: no accents, lower case, single spaces."""
    return F.trim(F.regexp_replace(F.lower(unaccented(F.coalesce(col(c), F.lit("")))), r"\s+", " "))


def is_placeholder(c: Column | str) -> Column:
    return norm_name(c).rlike(PLACEHOLDER)


def lease_number(c: Column | str) -> Column:
    """The formal lease number: letter and at least four digits."""
    v = text(c)
    padded = lambda letter, digits: F.concat(F.lit("OCS-"), letter, F.lit(" "), F.when(F.length(digits) < 4, F.lpad(digits, 4, "0")).otherwise(digits))
    part = lambda p, i: F.regexp_extract(v, p, i)
    legacy, formal = r"^([A-Z])0*(\d+)$", r"^OCS-([A-Z])(?:\s+|-)0*(\d+)\b"
    return F.when(v.rlike(legacy), padded(part(legacy, 1), part(legacy, 2))).when(v.rlike(formal), padded(part(formal, 1), part(formal, 2))).otherwise(v)


def rounded(c: Column | str) -> Column:
    """The nearest integer as text, ties to even; text that is no number stays."""
    v = col(c)
    number = v.try_cast("double")
    return F.when(number.isNull() | F.isnan(number), v).otherwise(F.rint(number).cast("bigint").cast("string"))


def lookup(c: Column, table: dict) -> Column:
    """The table's value for the key, a missing key keeps the value."""
    if not table:
        return c
    entries = F.create_map(*[F.lit(str(x)) for kv in table.items() for x in kv])
    return F.coalesce(F.try_element_at(entries, c), c)


FILTERS: dict[str, Filter] = {
    "strip": lambda v, arg, field: F.trim(v),
    "lease_number": lambda v, arg, field: lease_number(v),
    "prefix": lambda v, arg, field: F.when(v != "", F.concat(F.lit(arg), v)).otherwise(""),
    "slug": lambda v, arg, field: slug(v),
    "round": lambda v, arg, field: rounded(v),
    "default": lambda v, arg, field: F.when(v != "", v).otherwise(arg),
    "blank": lambda v, arg, field: F.when(F.lower(v) == arg.lower(), "").otherwise(v),
    "else": lambda v, arg, field: F.when(v != "", v).otherwise(field(arg)),
}


def template(pattern: str, fields: dict[str, Column] | None = None, maps: dict[str, dict] | None = None) -> Column:
    """``"{FIELD|filter:arg} text"`` as one Column. Null fields are empty; white space runs collapse. An unknown filter is an error."""
    field = lambda name: text((fields or {}).get(name, name))
    out, at = [], 0
    for m in re.finditer(r"\{([^{}|]+)((?:\|[^{}|]+)*)\}", pattern):
        out.append(F.lit(pattern[at : m.start()]))
        value = field(m.group(1))
        for f in filter(None, m.group(2).split("|")):
            name, _, arg = f.partition(":")
            if name == "map":
                value = lookup(value, (maps or {})[arg])
            elif name in FILTERS:
                value = FILTERS[name](value, arg, field)
            else:
                raise ValueError(f"unknown template filter: {f}")
        out.append(value)
        at = m.end()
    out.append(F.lit(pattern[at:]))
    return F.trim(F.regexp_replace(F.concat(*out), r"\s+", " "))


def clean_id(c: Column | str) -> Column:
    """A source's id as text: 1234.0 is 1234; spellings of nothing are null."""
    v = F.regexp_replace(F.trim(col(c).cast("string")), r"^(\d+)\.0+$", "$1")
    return F.when(~F.lower(v).isin(*NULL_IDS), v)


def prefix_id(place_id: Column | str, column: str) -> Column:
    """The external id of one crosswalk column that a place id implies by its prefix."""
    v = col(place_id)
    before, after = F.upper(F.split_part(v, F.lit(":"), F.lit(1))), F.trim(F.regexp_replace(v, "^[^:]*:", ""))
    out = F.lit(None).cast("string")
    for prefix, (name, pattern) in ID_PREFIXES.items():
        if name == column:
            out = F.when(v.contains(":") & (before == prefix) & after.rlike(pattern), F.regexp_extract(after, pattern, 1)).otherwise(out)
    return out


def keywords(fields: list[Column], name: Column) -> Column:
    """Distinct values that are not already whole words of the name, joined by a middle dot; null if none."""
    quoted = lambda v: F.concat(F.lit("(?<!\\w)\\Q"), F.lower(v), F.lit("\\E(?!\\w)"))
    values = F.array_distinct(F.array_compact(F.array(*map(squash, fields))))
    fresh = F.filter(values, lambda v: ~F.rlike(F.lower(F.coalesce(name, F.lit(""))), quoted(v)))
    return F.nullif(F.array_join(fresh, " · "), F.lit(""))


def place_link(pattern: str, fields: dict[str, Column]) -> Column:
    """The rendered link, null if a field is null or the result is no web address."""
    names = re.findall(r"\{([^{}|]+)", pattern)
    link = template(pattern, fields)
    known = F.lit(True)
    for n in names:
        known = known & fields[n].isNotNull()
    return F.when(known & link.rlike(r"^https?://\S+$"), link)


def resolved_status(value: str, default: str = "unknown", fields: dict[str, Column] | None = None) -> Column:
    """A literal, or ``field:NAME``: that field in lower case, the default when empty."""
    if not value.startswith("field:"):
        return F.lit(value)
    v = F.lower(text((fields or {}).get(value[6:], value[6:])))
    return F.when(v != "", v).otherwise(default)


def status_date(spec: str, last_edit: Column, fields: dict[str, Column] | None = None) -> Column:
    """A literal, ``field:NAME``, or ``data_last_edit``: the edit day, empty when there is none, never the retrieval day."""
    if spec == "data_last_edit":
        return F.coalesce(F.substring(last_edit.cast("string"), 1, 10), F.lit(""))
    if spec.startswith("field:"):
        return iso_date((fields or {}).get(spec[6:], F.col(spec[6:])))
    return F.lit(spec)


def upstream_status(c: Column | str) -> Column:
    """The source's own status verbatim, blank is null."""
    return F.nullif(F.trim(col(c).cast("string")), F.lit(""))


def valid_partial_date(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$"), F.lit(False))


def iso_date(c: Column) -> Column:
    """Epoch milliseconds, as digits, to a day; other text passes; null is empty."""
    v = c.cast("string")
    return F.coalesce(F.when(v.rlike(r"^-?\d{9,}$"), F.date_format(F.timestamp_millis(v.try_cast("bigint")), "yyyy-MM-dd")).otherwise(v), F.lit(""))


def history_json(events: Column) -> Column:
    """The event array as JSON text with all keys; empty is null."""
    return F.when(F.size(events) > 0, F.to_json(events, {"ignoreNullFields": "false"}))


def month_of(c: Column | str) -> Column:
    """2024-07-15 as 2024-07, 2024 as 2024-01, else null."""
    v = F.trim(F.coalesce(col(c).cast("string"), F.lit("")))
    m = F.substring(v, 1, 7)
    return F.when(v.rlike(r"^\d{4}$"), F.concat(v, F.lit("-01"))).when(m.rlike(r"^\d{4}-(0[1-9]|1[0-2])$"), m)


def years_before(month: Column, years: int = 8) -> Column:
    m = month_of(month)
    return F.concat(F.lpad((F.substring(m, 1, 4).cast("int") - years).cast("string"), 4, "0"), F.substring(m, 5, 3))


def step_date(date: Column, months: int) -> Column:
    return F.add_months(date, months)


def period_label(time: Column, grain: Column) -> Column:
    return F.when(grain == "year", F.date_format(time, "yyyy")).when(grain == "month", F.date_format(time, "yyyy-MM")).otherwise(F.date_format(time, "yyyy-MM-dd"))


def unit_label(unit: Column) -> Column:
    """Units of one are left out; exponents are written with a caret."""
    u = F.trim(F.coalesce(unit, F.lit("")))
    return F.when(u.isin("1", "", "none"), "").otherwise(F.regexp_replace(u, r"\*\*", "^"))


def geom_kind(c: Column | str) -> Column:
    t = F.lower(F.coalesce(col(c), F.lit("")))
    return F.when(t.contains("point"), "point").when(t.contains("line"), "line").when(t.contains("polygon"), "polygon").otherwise(t)


def kind_of_all(kinds: Column) -> Column:
    """The one kind of an array of types, or mixed."""
    distinct = F.array_distinct(F.transform(kinds, geom_kind))
    return F.when(F.size(distinct) > 1, "mixed").otherwise(F.get(distinct, F.lit(0)))


def search_rank(slug_: Column | str, own: str | None = None) -> Column:
    """The collection's place among copies of one site; ``own`` is the slug of the catalogue's own collection."""
    s = col(slug_)
    out = F.lit(0) if own is None else F.when(s == own, OWN_RANK).otherwise(F.lit(0))
    for prefix, rank in SEARCH_RANK_PREFIXES.items():
        out = F.when(s.startswith(prefix), rank).otherwise(out)
    for name, rank in SEARCH_RANKS.items():
        out = F.when(s == name, rank).otherwise(out)
    return out


def station_key(line: Column, station: Column) -> Column:
    """Line and station as zero-padded numbers with one decimal."""
    return F.concat_ws(" ", F.format_string("%05.1f", line.cast("double")), F.format_string("%05.1f", station.cast("double")))


def dir_to_id(c: Column | str) -> Column:
    """A directory name to its id: the first hyphen stands for a colon."""
    return F.regexp_replace(col(c), r"^([^-]+)-", "$1:")


def ulid_valid(c: Column | str) -> Column:
    return F.coalesce(F.upper(col(c)).rlike("^[0-7][0-9A-HJKMNP-TV-Z]{25}$"), F.lit(False))


def orcid_valid(c: Column | str) -> Column:
    """Form and check digit (modulo 11, 2)."""
    v = F.regexp_replace(F.coalesce(col(c), F.lit("")), r"^https?://orcid\.org/", "")
    digits = F.regexp_replace(v, "-", "")
    total = F.aggregate(F.sequence(F.lit(1), F.lit(15)), F.lit(0), lambda a, i: (a + F.substr(digits, i, F.lit(1)).try_cast("int")) * 2)
    check = F.pmod(F.lit(12) - F.pmod(total, F.lit(11)), F.lit(11))
    return v.rlike(r"^\d{4}-\d{4}-\d{4}-\d{3}[\dX]$") & (F.substring(v, 19, 1) == F.when(check == 10, "X").otherwise(check.cast("string")))


def size_label(c: Column) -> Column:
    """Bytes with a unit: plain below 1000, then one decimal."""
    v = c.cast("double")
    out = F.concat(c.cast("bigint").cast("string"), F.lit(" B"))
    for unit, least in (("kB", 1e3), ("MB", 1e6), ("GB", 1e9), ("TB", 1e12)):
        out = F.when(v >= least, F.concat(F.format_string("%.1f", v / least), F.lit(f" {unit}"))).otherwise(out)
    return out


def citation(own: Column, attribution: Column, title: Column, version: Column, year: Column) -> Column:
    """The own text, else attribution, title, version and year."""
    made = F.concat(F.coalesce(F.concat(squash(attribution), F.lit(" ")), F.lit("")), title, F.coalesce(F.concat(F.lit(", version "), squash(version)), F.lit("")), F.coalesce(F.concat(F.lit(" ("), year.cast("string"), F.lit(")")), F.lit("")))
    return F.coalesce(squash(own), made)


def hash_of(ledger: Column, multihash: Column) -> Column:
    """The ledger's hash, else the multihash without its prefix."""
    return F.coalesce(ledger, F.when(multihash.startswith("1220") & (F.length(multihash) == 68), F.substring(multihash, 5, 64)))


def csv_cell(c: Column) -> Column:
    v = F.coalesce(c.cast("string"), F.lit(""))
    return F.when(v.rlike('[",\n]'), F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(v)


def group_of(eov: Column, cls: Column) -> Column:
    """The group's name, else the class, else other."""
    return F.when(F.coalesce(eov, F.lit("")) != "", lookup(eov, GROUP_LABELS)).otherwise(F.coalesce(cls, F.lit("other")))


def count_label(c: Column) -> Column:
    return F.format_number(c, 0)


def attribution_text(own: Column, names: Column, processor: str) -> Column:
    """The own text, else the providers' names and the processor's sentence."""
    joined = F.array_join(names, ", ")
    return F.coalesce(squash(own), F.concat(F.when(F.size(names) > 0, F.concat(joined, F.lit(". "))).otherwise(""), F.lit(f"Processed by {processor}.")))


#: File types that anyone may read, classes of data types, and data types that may last.
OPEN_TYPES = ("json", "md", "html", "png", "jpg", "jpeg", "txt", "csv", "svg", "atom", "xml")
DATA_TYPES = {"parquet": "parquet", "pmtiles": "pmtiles", "tif": "tif", "tiff": "tif", "duckdb": "data", "zip": "data", "gz": "data", "fgb": "data"}
LASTING_TYPES = ("parquet", "pmtiles", "tif", "tiff", "fgb")


def extension(path: Column) -> Column:
    """Lower-case extension of the last path segment, empty if it has none or starts with its only dot."""
    return F.regexp_extract(F.lower(path), r"[^/]\.([^./]*)$", 1)


def access_class(path: Column, store: Column | None = None, open_prefix: str = "index/", restricted: tuple[str, ...] = (), released: tuple[str, ...] = (), hashed: tuple[str, ...] = (), versioned: tuple[str, ...] = ()) -> Column:
    """``class gate immutable`` of an object key, by store (public or unlisted), prefix and extension.

    Keys are immutable by the layout of their first segment: a version folder next (``released``), a hash as file name
    (``hashed``), or a version folder anywhere below the collection (``versioned``)."""
    store = F.lit("public") if store is None else store
    low, kind = F.lower(path), extension(path)
    index, unlisted = low.startswith(open_prefix), store == "unlisted"
    locked = reduce(lambda a, p: a | low.startswith(f"{p}/"), restricted, F.lit(False))
    page = kind.isin(*OPEN_TYPES) | low.endswith("/credits")
    data = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in DATA_TYPES.items() for x in pair]), kind), F.lit("data"))
    name = F.when(unlisted | locked, "unlisted").when(kind == "json", "stac").when(page, "other").otherwise(data)
    gate = F.when(unlisted, F.when(index, "open").otherwise("key")).when(locked, "key").when(page | index, "open").otherwise("anonymous")
    steps = F.split(path, "/")
    first, folders = F.get(steps, F.lit(0)), F.slice(steps, 3, F.greatest(F.size(steps) - 3, F.lit(0)))
    version = lambda x: x.rlike(r"^v\d+$")
    layout = (first.isin(*released) & version(F.get(steps, F.lit(1)))) | (first.isin(*hashed) & F.element_at(steps, -1).rlike(r"^[0-9a-f]{16,64}(_3857)?\.(tif|tiff|pmtiles)$")) | (first.isin(*versioned) & F.exists(folders, version))
    whole = (store == "public") & (F.size(steps) >= 3) & ~F.exists(steps, lambda x: x.isin("", "_history")) & kind.isin(*LASTING_TYPES)
    return F.struct(name.alias("class"), gate.alias("gate"), (whole & layout).alias("immutable"))


# sentences ----
def whole(n: Column) -> Column:
    """A number with thousands separators."""
    return F.format_number(n, 0)


def expected_text(es: Column) -> Column:
    return F.when(es.isNull(), "ES(50) not defined (under 50 records)").otherwise(F.concat(F.lit("ES(50) "), F.format_number(es, 1)))


def records_line(n: Column, species: Column, es: Column, decade: Column, n_latest: Column, species_latest: Column, es_latest: Column) -> Column:
    """Records and species in every year and in the latest decade; null counts say that there are none, a null decade leaves it out."""
    said = lambda n, sp, es: F.concat(whole(n), F.lit(" records of "), whole(sp), F.lit(" species ("), expected_text(es), F.lit(")"))
    every = F.when(n.isNull(), "No records in every year").otherwise(F.concat(said(n, species, es), F.lit(" in every year")))
    latest = F.when(decade.isNull(), "").otherwise(F.concat(F.lit("; in the "), decade.cast("string"), F.lit("s, "), said(n_latest, species_latest, es_latest)))
    return F.concat(every, latest, F.lit("."))


def species_line(n: Column, decade: Column, n_latest: Column) -> Column:
    """Species with records in a place, and those of the latest decade."""
    latest = F.when(decade.isNull(), "").otherwise(F.concat(F.lit(", "), whole(n_latest), F.lit(" in the latest decade (the "), decade.cast("string"), F.lit("s)")))
    return F.concat(whole(n), F.lit(" species with records in the place (exact)"), latest, F.lit("."))


def suited_line(groups: Column, cells: Column, degrees: Column) -> Column:
    """Species suitable in a place's cells, by group. ``groups`` is an array of (label, n); the largest comes first, then by label."""
    largest = F.array_sort(F.transform(groups, lambda g: F.struct((-g["n"]).alias("minus"), g["label"].alias("label"))))
    names = F.array_join(F.transform(largest, lambda g: F.concat(g["label"], F.lit(" "), whole(-g["minus"]))), ", ")
    total = F.aggregate(groups, F.lit(0).cast("bigint"), lambda a, g: a + g["n"])
    listed = F.when(F.size(groups) > 0, F.concat(F.lit(" ("), names, F.lit(")"))).otherwise("")
    return F.concat(whole(total), F.lit(" species"), listed, F.lit(" suitable in at least one of the place's "), whole(cells), F.lit(" cells of "), degrees.cast("string"), F.lit("°."))


def indicators_line(above: Column, within: Column, below: Column, none: Column, nodata: Column, cells: Column, latest: Column) -> Column:
    """Indicators by their place in the record; null without any value."""
    n = cells - nodata
    counted = F.concat(n.cast("string"), F.when(n == 1, " indicator").otherwise(" indicators"), F.lit(" with a value: "))
    states = F.array_join(F.array(*[F.concat(c.cast("string"), F.lit(f" {word}")) for c, word in ((above, "above"), (within, "within"), (below, "below"))]), ", ")
    rest = F.when(none > 0, F.concat(F.lit(", "), none.cast("string"), F.lit(" without a status"))).otherwise("")
    last = F.when(latest.isNotNull(), F.concat(F.lit("; latest "), latest)).otherwise("")
    return F.when(n > 0, F.concat(counted, states, F.lit(" the place's own record"), rest, last, F.lit(".")))
