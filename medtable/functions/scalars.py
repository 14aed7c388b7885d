"""Scalar functions (C01-C41) as native Column expressions. ``as_of`` is always an argument."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import codes
from .paths import strip_tags

__all__ = ["strip_tags"]


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """Literal map lookup, null when absent."""
    pairs = [F.lit(x) for kv in mapping.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), key)


def blank_to_null(col: Column) -> Column:
    return F.nullif(F.trim(col), F.lit(""))


# --- ages, durations and encounter flags -------------------------------------------------------


def age_years(birth: Column, as_of: Column) -> Column:
    """Whole years, aware of the birthday."""
    return F.floor(F.months_between(as_of, birth) / 12).cast("int")


def age_by_year(birth: Column, as_of: Column) -> Column:
    """Difference of the calendar years."""
    return (F.year(as_of) - F.year(birth)).cast("int")


def age_by_days(birth: Column, as_of: Column) -> Column:
    """Elapsed days over 365."""
    return F.floor(F.datediff(as_of, birth) / 365).cast("int")


def age_group3(age: Column) -> Column:
    """Pediatric / adult / senior, unknown without an age."""
    return (F.when(age.isNull(), "unknown").when(age < 18, "pediatric").when(age < 65, "adult")
            .otherwise("senior"))


def age_group5(age: Column) -> Column:
    """Five bands."""
    return (F.when(age.isNull(), "Unknown").when(age < 18, "Under 18").when(age < 30, "18-29")
            .when(age < 45, "30-44").when(age < 65, "45-64").otherwise("65+"))


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))) / 1e6


def stay_hours(start: Column, end: Column) -> Column:
    """Whole seconds over 3600; the hours themselves are not rounded."""
    return F.round(seconds_between(start, end)) / 3600


def stay_days(hours: Column) -> Column:
    return F.round(hours / 24, 1)


def stay_minutes(start: Column, end: Column) -> Column:
    return seconds_between(start, end) / 60.0


def is_active(end: Column, status: Column) -> Column:
    """Open-ended with a running status."""
    return end.isNull() & status.isin(codes.ACTIVE_ENCOUNTER)


def class_category(code: Column) -> Column:
    """Encounter class to category."""
    return F.coalesce(lookup(codes.CLASS_CATEGORY, code), F.lit("other"))


def is_long_stay(category: Column, hours: Column, days: Column) -> Column:
    """Inpatient over 7 days, emergency over 24 hours."""
    return F.when(category == "inpatient", days > 7).when(category == "emergency", hours > 24).otherwise(False)


# --- dates ----------------------------------------------------------------------------------------


def parse_datetime(text: Column) -> Column:
    """Y, Y-M, Y-M-D or a full instant; fractional seconds are dropped, partial dates widen to the first day."""
    whole = F.regexp_replace(text, r"(:\d{2})\.\d+", "$1")
    widened = (F.when(whole.rlike(r"^\d{4}$"), F.concat(whole, F.lit("-01-01")))
               .when(whole.rlike(r"^\d{4}-\d{2}$"), F.concat(whole, F.lit("-01"))).otherwise(whole))
    return F.try_to_timestamp(widened)


def is_datetime_text(text: Column) -> Column:
    """Date or instant by shape."""
    return text.rlike(r"^\d{4}(-\d{2}(-\d{2})?)?$|^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})?$")


def is_date_text(text: Column) -> Column:
    """Parses in one of six layouts."""
    layouts = ["yyyy-MM-dd", "yyyy-MM", "yyyy", "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ssXXX",
               "yyyy-MM-dd'T'HH:mm:ss.SSSXXX"]
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(x)) for x in layouts]).isNotNull()


def birth_date(value: Column, extension_value: Column) -> Column:
    """C11: extension fallback, time part dropped, kept only in Y-M-D shape."""
    day = F.split_part(F.coalesce(value, extension_value), F.lit("T"), F.lit(1))
    return F.when(day.rlike(r"^\d{4}-\d{2}-\d{2}$"), day)


def fix_date(text: Column) -> Column:
    """Rewrite to ISO where one of the known layouts gives a valid date, else leave alone.

    A text that begins with year and month fits only the last layout, an instant at midnight, and needs no other test; one without a digit fits
    none. The others are tried in a lambda over a list of one, as code generated for all of them is longer than what the JVM compiles.
    """
    def tried(text: Column) -> Column:
        options = []
        for pattern, target in codes.DATE_FIXES:
            iso = F.regexp_replace(text, pattern, target)
            options.append(F.when(text.rlike(pattern) & F.try_to_timestamp(iso, F.lit("yyyy-MM-dd")).isNotNull(), iso))
        # Layouts a lenient reader also accepts; month first, then day first.
        for layout in ("M/d/yyyy", "d/M/yyyy", "M-d-yyyy", "yyyy/M/d", "d MMM yyyy", "MMM d, yyyy"):
            options.append(F.date_format(F.try_to_timestamp(text, F.lit(layout)), "yyyy-MM-dd"))
        return F.coalesce(*options, text)

    day, dated = F.substring(text, 1, 10), text.rlike(r"^\d{4}-\d{2}")
    midnight = text.rlike(r"^\d{4}-\d{2}-\d{2}T00:00:00(\.\d+)?(Z|[+-]\d{2}:\d{2})?\z") & day.try_cast("date").isNotNull()
    return F.when(midnight, day).when(text.isNull() | dated | ~text.rlike("[0-9]"), text).otherwise(F.get(F.transform(F.array(text), tried), F.lit(0)))


# --- people ---------------------------------------------------------------------------------------


def gender_norm(value: Column, extension: Column | None = None, misplaced: Column | None = None) -> Column:
    """M / f / o or the full word, else unknown; null when no source has a value.

    A value outside the set yields to the extension; a missing one also to a language text that
    holds a gender by mistake.
    """
    raw = blank_to_null(value)
    if extension is not None:
        raw = F.when(raw.isin(codes.GENDERS), raw).otherwise(F.coalesce(extension, raw))
    if misplaced is not None:
        raw = F.coalesce(raw, F.when(misplaced.isin(codes.GENDERS), misplaced))
    low = F.lower(raw)
    return (F.when(low.isin("m", "male"), "male").when(low.isin("f", "female"), "female")
            .when(low.isin("o", "other"), "other").when(low.isNotNull(), "unknown"))


def preferred_language(communication: Column) -> Column:
    """The preferred entry, else the first; code, else display, else text."""
    preferred = F.get(F.filter(communication, lambda x: x["preferred"] == F.lit(True)), F.lit(0))
    language = F.coalesce(preferred, F.get(communication, F.lit(0)))["language"]
    coding = F.get(language["coding"], F.lit(0))
    return F.coalesce(coding["code"], coding["display"], language["text"])


def digits(text: Column) -> Column:
    """Digits only."""
    return F.regexp_replace(text, "[^0-9]", "")


def patient_sentence(name: Column, birth: Column, gender: Column) -> Column:
    """Short summary from what is known."""
    return F.concat_ws(". ", F.concat(F.lit("Patient: "), name), F.concat(F.lit("DOB: "), birth.cast("string")),
                       F.concat(F.lit("Gender: "), gender))


# --- concepts, references, identifiers --------------------------------------------------------


def coding_in(concept: Column, system: str) -> Column:
    return F.get(F.filter(concept["coding"], lambda x: x["system"] == system), F.lit(0))


def concept_display(concept: Column) -> Column:
    """C14: text, else first coding's display, else its code."""
    coding = F.get(concept["coding"], F.lit(0))
    return F.coalesce(blank_to_null(concept["text"]), blank_to_null(coding["display"]), blank_to_null(coding["code"]))


def coding_details(concept: Column, system: str | None = None) -> Column:
    """Code, system, display and system name; a preferred system wins when present."""
    first = F.get(concept["coding"], F.lit(0))
    coding = first if system is None else F.coalesce(coding_in(concept, system), first)
    return F.struct(coding["code"].alias("code"), coding["system"].alias("system"),
                    F.coalesce(coding["display"], concept_display(concept)).alias("display"),
                    lookup(codes.SYSTEM_NAMES, coding["system"]).alias("system_name"))


def concept_code(concept: Column, system: str | None = None) -> Column:
    """Code of the first coding, or of the first one in a system."""
    coding = F.get(concept["coding"], F.lit(0)) if system is None else coding_in(concept, system)
    return coding["code"]


def has_coding(concept: Column, system: str, code: str | None = None) -> Column:
    """F16: any coding in the system, optionally with the code."""
    def hit(x):
        return (x["system"] == system) if code is None else (x["system"] == system) & (x["code"] == code)
    return F.coalesce(F.exists(concept["coding"], hit), F.lit(False))


def build_concept(system: Column, code: Column, display: Column) -> Column:
    """C17: concept with a single coding."""
    return F.struct(F.array(F.struct(system.alias("system"), code.alias("code"), display.alias("display"))).alias("coding"),
                    display.alias("text"))


def normalise_term(value: Column) -> Column:
    """Synonym map on the trimmed lower-case text, unknown text unchanged."""
    return F.coalesce(lookup(codes.TERMS, F.lower(F.trim(value))), value)


def reference_parts(ref: Column) -> Column:
    """(type, id) of ``Type/id`` or of a URL whose path is that; null in any other shape."""
    is_url = ref.contains("://")
    url_path = F.trim(F.regexp_replace(ref, r"^\w+://[^/]+", ""), F.lit("/"))
    parts = F.split(F.when(is_url, url_path).otherwise(ref), "/")
    return F.when(F.size(parts) == 2, F.struct(F.get(parts, F.lit(0)).alias("type"), F.get(parts, F.lit(1)).alias("id")))


def last_segment(ref: Column) -> Column:
    """Text after the last slash."""
    return F.substring_index(ref, "/", -1)


def identifier_value(identifiers: Column, system_part: str) -> Column:
    """First identifier whose system contains a word."""
    return F.get(F.filter(identifiers, lambda x: x["system"].contains(system_part)), F.lit(0))["value"]


def identifier_pair(identifier: Column) -> Column:
    """``system|value``."""
    return F.concat_ws("|", identifier["system"], identifier["value"])


def row_key(*cols: Column) -> Column:
    """SHA-256 of the concatenated keys."""
    return F.sha2(F.concat(*[c.cast("string") for c in cols]), 256)


def valid_type(name: Column) -> Column:
    """Known record type."""
    return F.coalesce(name.isin(codes.RESOURCE_TYPES), F.lit(False))


# --- value[x] -------------------------------------------------------------------------------------


def value_type(o: str = "") -> Column:
    """Which value field is filled, as a normalised type name."""
    c = _field(o)
    return (F.when(c("valueQuantity").isNotNull(), "quantity").when(c("valueString").isNotNull(), "string")
            .when(c("valueCodeableConcept").isNotNull(), "codeableConcept").when(c("valueBoolean").isNotNull(), "boolean")
            .when(c("valueInteger").isNotNull(), "integer").when(c("valueDateTime").isNotNull(), "dateTime")
            .when(c("valuePeriod").isNotNull(), "period").when(c("valueReference").isNotNull(), "reference"))


def value_parts(o: str = "") -> Column:
    """Value, unit, system and display of whichever value field is filled."""
    c = _field(o)
    q, cc = c("valueQuantity"), c("valueCodeableConcept")
    coding = F.get(cc["coding"], F.lit(0))
    value = F.coalesce(q["value"].cast("string"), c("valueString"), coding["code"], cc["text"],
                       c("valueBoolean").cast("string"), c("valueInteger").cast("string"), c("valueDateTime"),
                       c("valuePeriod")["start"], c("valueReference")["reference"])
    return F.struct(value.alias("value"), q["unit"].alias("unit"),
                    F.coalesce(q["system"], coding["system"]).alias("system"), value_text(o).alias("display"))


def value_text(o: str = "") -> Column:
    """Display text of the value."""
    c = _field(o)
    flag = c("valueBoolean")
    return F.coalesce(quantity_text(c("valueQuantity")), c("valueString"), concept_display(c("valueCodeableConcept")),
                      F.when(flag, "Yes").when(~flag, "No"), c("valueInteger").cast("string"), c("valueDateTime"),
                      period_text(c("valuePeriod")), c("valueReference")["reference"])


def quantity_text(q: Column) -> Column:
    """Value and unit."""
    return F.when(q["value"].isNotNull(), F.concat_ws(" ", q["value"].cast("string"), q["unit"]))


def period_text(p: Column) -> Column:
    """Start to end, either side optional."""
    return F.when(p["start"].isNotNull() | p["end"].isNotNull(),
                  F.concat(F.coalesce(p["start"], F.lit("")), F.lit(" to "), F.coalesce(p["end"], F.lit("ongoing"))))


def range_text(r: Column) -> Column:
    """``>= low unit, <= high unit``."""
    low, high = r["low"], r["high"]
    return F.nullif(F.concat_ws(", ", F.concat(F.lit(">= "), quantity_text(low)), F.concat(F.lit("<= "), quantity_text(high))),
                    F.lit(""))


def _field(prefix: str):
    return lambda name: F.col(f"{prefix}.{name}" if prefix else name)


# --- extensions -----------------------------------------------------------------------------------


def extension_value(e: Column) -> Column:
    """Whichever value the extension carries, as text."""
    return F.coalesce(e["valueString"], e["valueCode"], e["valueDate"], e["valueDateTime"], e["valueCoding"]["display"],
                      e["valueCoding"]["code"], concept_display(e["valueCodeableConcept"]))


def extensions(exts: Column, url: str) -> Column:
    return F.filter(exts, lambda e: e["url"] == url)


def extension_first(exts: Column, url: str) -> Column:
    """First value under a URL."""
    return extension_value(F.get(extensions(exts, url), F.lit(0)))


def extension_child(exts: Column, url: str, child: str) -> Column:
    """Value of a nested child of the first extension under a URL."""
    children = F.get(extensions(exts, url), F.lit(0))["extension"]
    return extension_value(F.get(F.filter(children, lambda e: e["url"] == child), F.lit(0)))


def extension_map(exts: Column, names: dict[str, str] | None = None) -> Column:
    """Flat map ``name`` or ``name.child`` to value; the last one wins on a repeated name.

    ``names`` gives short names to known URLs; others use the last path segment.
    """
    def name(e):
        short = last_segment(e["url"])
        return F.coalesce(lookup(names, e["url"]), short) if names else short

    def entry(k, v):
        return F.struct(k.alias("key"), v.alias("value"))

    own = F.transform(exts, lambda e: entry(name(e), extension_value(e)))
    nested = F.flatten(F.transform(exts, lambda e: F.coalesce(
        F.transform(e["extension"], lambda c: entry(F.concat(name(e), F.lit("."), last_segment(c["url"])), extension_value(c))),
        F.array().cast("array<struct<key:string,value:string>>"))))
    kept = F.filter(F.concat(own, nested), lambda x: x["value"].isNotNull())
    merged = F.aggregate(kept, F.create_map().cast("map<string,string>"),
                         lambda acc, x: F.map_concat(F.map_filter(acc, lambda k, _: k != x["key"]),
                                                     F.create_map(x["key"], x["value"])))
    return merged


def build_extension(url: str, value: Column, kind: str = "valueString") -> Column:
    """Extension with one typed value."""
    return F.struct(F.lit(url).alias("url"), value.alias(kind))


# --- text, issues, thresholds -----------------------------------------------------------------


def mask_pii(text: Column) -> Column:
    """Mask numbers and addresses in the fixed order."""
    for pattern, mask in codes.PII_MASKS:
        text = F.regexp_replace(text, pattern, mask)
    return text


def issue_category(message: Column) -> Column:
    """First keyword group found in the message."""
    low = F.lower(message)
    chain = F.when(F.lit(False), "")
    for name, words in codes.ISSUE_WORDS:
        chain = chain.when(low.rlike(words), name)
    return chain.otherwise("unknown")


def crosses(op: Column, value: Column, lower: Column, upper: Column | None = None, tolerance: float = 1e-4) -> Column:
    """Threshold test chosen per row by its operator name."""
    upper = F.lit(None).cast("double") if upper is None else upper
    inside, strictly = (value >= lower) & (value <= upper), (value > lower) & (value < upper)
    return F.coalesce(
        F.when(op == "lt", value < lower).when(op == "lte", value <= lower).when(op == "gt", value > lower)
        .when(op == "gte", value >= lower).when(op == "eq", F.abs(value - lower) <= tolerance)
        .when(op == "between", inside).when(op == "between_excl", strictly)
        .when(op == "not_between", ~inside).when(op == "not_between_excl", ~strictly), F.lit(False))


def timeliness(updated: Column, as_of: Column) -> Column:
    """1 / (1 + hours / 24), clipped to [0, 1]."""
    hours = seconds_between(updated, as_of) / 3600
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), 1 / (1 + F.greatest(hours, F.lit(0.0)) / 24)))


def is_stale(updated: Column, as_of: Column, days: int = 365) -> Column:
    """Older than a year."""
    return F.datediff(as_of, updated) > days


def bp_category(systolic: Column, diastolic: Column) -> Column:
    """High / Low / Normal."""
    return (F.when((systolic >= 140) | (diastolic >= 90), "High").when((systolic <= 90) | (diastolic <= 60), "Low")
            .otherwise("Normal"))


def attachment_text(data: Column) -> Column:
    """Text of a base64 attachment."""
    return F.decode(F.try_to_binary(data, F.lit("base64")), "UTF-8")


def list_phrase(items: Column, short: str, long: str) -> Column:
    """D-U7: ``short a, b`` for up to three items, else ``long a, b, c and n more``; null when empty."""
    n = F.size(items)
    head = F.array_join(F.slice(items, 1, 3), ", ")
    return (F.when(n.between(1, 3), F.concat(F.lit(short), head))
            .when(n > 3, F.concat(F.lit(long), head, F.lit(" and "), (n - 3).cast("string"), F.lit(" more"))))
