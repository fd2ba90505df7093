"""Scalar functions of the engine as column expressions: identifiers, phones, addresses, dates, names. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_S = r"[\s\x0b\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Formats of ids, dates, phones and links.
FUZZY_DATE = r"^[0-9]{4}(-[0-9]{2}){0,2}$"
FUZZY_DATETIME = r"^[0-9]{4}(-[0-9]{2}){0,2}(T[0-9]{2}(:[0-9]{2}){0,2}(Z|[+-][0-9]{2}(:?[0-9]{2})?))?$"
PHONE = r"^(1-)?[0-9]{3}-[0-9]{3}-[0-9]{4}( ext\. [0-9]+)?$"
URL = r"^(https?|ftp)://"
OCD_ID = r"^ocd-{kind}/[0-9a-f]{{8}}-([0-9a-f]{{4}}-){{3}}[0-9a-f]{{12}}$"
JURISDICTION_ID = r"^ocd-jurisdiction/country:us(/(state|territory|district):[a-z]{2})?(/(county|place):[a-z_~-]+)*/(government|legislature)$"
PARTIES = {"d": "Democratic", "dem": "Democratic", "democrat": "Democratic", "r": "Republican", "rep": "Republican", "ind": "Independent"}
#: Ten digits with anything but digits before and between them, a leading 1, anything after, an extension at the end; a number in the form ``(ddd) ddd-dddd``.
PHONE_PARTS = r"^[^0-9]*(1?)[^0-9]*([0-9]{3})[^0-9]*([0-9]{3})[^0-9]*([0-9]{4}).*?(?:(?:ext|Ext|EXT)\.?\s*([0-9]{1,4}))?$"
OFFICE_PHONE = r"\(([0-9]{3})\)\s*([0-9]{3})-([0-9]{4})"


def fix_bill_id(text: Column) -> Column:
    """Upper case; one blank between letters and number, leading zeros gone: ``hb 0012`` is ``HB 12``, ``SJRA`` is ``SJR A``."""
    up = F.upper(text)
    letters = rf"^(SJR|HJR){_S}*([A-Z]+){_S}*$"
    spaced = F.regexp_replace(up, rf"(?s)^(.*?)([A-Z]*){_S}*0*([-0-9]+)(.*)$", "$1$2 $3$4")
    return clean_whitespace(F.when(up.rlike(letters), F.regexp_replace(up, letters, "$1 $2")).otherwise(spaced))


def collapse_whitespace(text: Column) -> Column:
    """Every run of blanks as one blank, ends included."""
    return F.regexp_replace(text, f"{_S}+", " ")


def clean_whitespace(text: Column) -> Column:
    return F.regexp_replace(text, f"^{_S}+|{_S}+$", "")


def truncate(text: Column, length: int = 300) -> Column:
    return F.substring(text, 1, length)


def clean_text(text: Column) -> Column:
    """NUL dropped, no-break blank and each tab as a blank, CRLF as a line feed."""
    return F.translate(F.replace(F.replace(text, F.lit("\x00"), F.lit("")), F.lit("\r\n"), F.lit("\n")), "\u00a0\t", "  ")


def phone(text: Column) -> Column:
    """``[1-]ddd-ddd-dddd[ ext. n]`` of the first ten digits, whatever stands before, between or after them; else the text."""
    g = [F.nullif(F.regexp_extract(text, PHONE_PARTS, i), F.lit("")) for i in range(1, 6)]
    return F.when(text.rlike(PHONE_PARTS), F.concat(F.concat_ws("-", *g[:4]), F.coalesce(F.concat(F.lit(" ext. "), g[4]), F.lit("")))).otherwise(text)


def office_phone(text: Column) -> Column:
    """``n/a`` and ``same as above`` as empty; the first ``(ddd) ddd-dddd`` as ``ddd-ddd-dddd``; else the text with en dashes as hyphens."""
    g = [F.regexp_extract(text, OFFICE_PHONE, i) for i in (1, 2, 3)]
    return F.when(F.lower(text).isin("n/a", "same as above"), "").when(text.rlike(OFFICE_PHONE), F.concat_ws("-", *g)).otherwise(F.replace(text, F.lit("\u2013"), F.lit("-")))


def address(text: Column) -> Column:
    """Line breaks with the blanks around them as ``;``, other runs of blanks as one."""
    return F.regexp_replace(F.regexp_replace(text, f"{_S}*\n{_S}*", ";"), f"{_S}+", " ")


def namespaced_bill_id(jurisdiction: Column, session: Column, identifier: Column) -> Column:
    """``ocd-bill-xx-session-id`` with the hyphens of session and identifier as underscores."""
    place = F.regexp_extract(jurisdiction, r"([a-z]{2})(?:/government|/legislature)?$", 1)
    under = lambda x: F.replace(F.replace(x, F.lit("-"), F.lit("_")), F.lit(" "), F.lit(""))
    return F.concat_ws("-", F.lit("ocd-bill"), place, under(session), under(identifier))


def uuid5(namespace_hex: str, name: Column) -> Column:
    """The version 5 UUID of a name in a namespace."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace_hex)), F.encode(name, "UTF-8")))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def safe_filename(name: Column, ident: Column) -> Column:
    """The name with every run of blanks as a hyphen and without other signs, then what follows the kind in the id, then ``.yml``."""
    plain = F.regexp_replace(F.regexp_replace(name, f"{_S}+", "-"), "[^a-zA-Z-]", "")
    return F.concat(plain, F.lit("-"), F.try_element_at(F.split(ident, "/"), F.lit(2)), F.lit(".yml"))


def pseudo_field(text: Column, field: str) -> Column:
    """A field of a pseudo id ``~{json}``; null for other ids."""
    return F.when(text.startswith("~"), F.get_json_object(F.substring(text, F.lit(2), F.length(text)), f"$.{field}"))


def pseudo_organization(organization: Column, classification: Column, default: Column) -> Column:
    """The organization if given, else a pseudo id of the classification or of the default."""
    spec = lambda c: F.concat(F.lit('~{"classification": "'), c, F.lit('"}'))
    return F.coalesce(F.nullif(organization, F.lit("")), spec(F.nullif(classification, F.lit(""))), spec(F.nullif(default, F.lit(""))))


def overlaps(start: Column, end: Column, from_: Column, to: Column) -> Column:
    """Whether the period (strings, empty: unbounded) meets the other one; both ends strict, compared as text."""
    s, e = F.coalesce(start, F.lit("")), F.coalesce(end, F.lit(""))
    return ((e == "") | (e > from_)) & ((s == "") | (s < to))


def is_current(start: Column, end: Column, today: Column, inclusive: bool = True) -> Column:
    """Whether the period holds today: its end included (memberships) or not (time-scoped documents)."""
    s, e = F.coalesce(start, F.lit("")), F.coalesce(end, F.lit(""))
    return ((s == "") | (s <= today) if inclusive else F.lit(True)) & ((e == "") | (e >= today if inclusive else e > today))


def is_uuid(text: Column) -> Column:
    """Lenient: braces, urn prefix and missing hyphens are allowed."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "^urn:uuid:", ""), r"[{}-]", "")
    return plain.rlike("^[0-9a-f]{32}$")


def office_name(name: Column, classification: Column) -> Column:
    return F.coalesce(F.nullif(name, F.lit("")), F.concat(F.upper(F.substring(classification, 1, 1)), F.substring(classification, F.lit(2), F.length(classification)), F.lit(" Office")))


def party_name(text: Column) -> Column:
    """The full name of a party's abbreviation, in any letter case; other texts as they are, blanks included."""
    names = F.create_map(*(F.lit(x) for kv in PARTIES.items() for x in kv))
    return F.coalesce(F.try_element_at(names, F.lower(text)), text)


def district_label(chamber: Column, state: Column, state_name: Column, district: Column) -> Column:
    """Senate: the state's name; house: ``ST-AL`` at large or ``ST-n``."""
    return F.when(chamber == "upper", state_name).otherwise(F.concat_ws("-", F.upper(state), F.when(district.isin("0", "At-Large", "at-large"), "AL").otherwise(district)))


def as_list(text: Column, default: str | None = None) -> Column:
    """A scalar as a list of one, an empty value as the default."""
    empty = F.array(F.lit(default)) if default is not None else F.array().cast("array<string>")
    return F.when(F.coalesce(text, F.lit("")) == "", empty).otherwise(F.array(text))


def utc_text(moment: Column) -> Column:
    """ISO form in UTC to the second."""
    return F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def numbered_lines(text: Column, after: bool = True) -> Column:
    """The text after the numbers that lines begin with, or before the first number after a blank; other lines are left out; joined by line feeds."""
    lines = F.split(text, "\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]")
    rx = rf"^{_S}*[0-9]+{_S}+(.*)" if after else rf"^(.*?){_S}+[0-9]+"
    return F.array_join(F.transform(F.filter(lines, lambda x: x.rlike(rx)), lambda x: F.regexp_extract(x, rx, 1)), "\n")


def sometimes_numbered(text: Column, share: float = 0.1) -> Column:
    """numbered_lines() if more than a share of the lines are numbered, else the text."""
    numbered = F.size(F.filter(F.split(text, "\n"), lambda x: x.rlike(r"^\s*[0-9]+\s+\S")))
    return F.when(numbered / F.size(F.split(text, "\n")) > share, numbered_lines(text)).otherwise(text)


def division_part(division: Column, level: int) -> tuple[Column, Column]:
    """(kind, value) at a level after the country of ``ocd-division/country:us/state:xx/...``; null where there is none."""
    piece = F.try_element_at(F.split(division, "/"), F.lit(level + 2))
    return F.split(piece, ":", 2)[0], F.try_element_at(F.split(piece, ":", 2), F.lit(2))


def children_of(division: Column, parent: str, kind: str | None = None, depth: int = 1) -> Column:
    """Divisions below the parent, down to depth levels (the parent itself excluded), of a kind at the first of them."""
    level = parent.count("/")
    levels = F.size(F.split(division, "/")) - 1
    below = division.startswith(parent + "/") & (levels > level) & (levels <= level + depth)
    return below & (division_part(division, level)[0] == kind) if kind else below


def make_pseudo_id(fields: dict[str, Column]) -> Column:
    """``~{json}`` of the fields that are not null, sorted by name, with a blank after each colon and comma."""
    quoted = lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", "")
    pairs = [F.when(x.isNotNull(), F.concat(F.lit(f'"{n}": '), quoted(x))) for n, x in sorted(fields.items())]
    return F.concat(F.lit("~{"), F.concat_ws(", ", *pairs), F.lit("}"))


def both_given(organization: Column, classification: Column) -> Column:
    """Whether an organization and a classification are given, which is an error."""
    return (F.coalesce(organization, F.lit("")) != "") & (F.coalesce(classification, F.lit("")) != "")


def slug(text: Column) -> Column:
    """Lower case, runs of other signs than letters and digits as one hyphen, none at the ends."""
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))
