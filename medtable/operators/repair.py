"""Correction, enrichment and privacy (E01-E15): nested edits with ``transform`` and ``withField``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes
from ..functions import scalars as S
from ..functions import walk
from ..functions.paths import path

_CHANGE = "array<struct<path:string,reason:string>>"
XHTML = "<div xmlns='http://www.w3.org/1999/xhtml'>"


def _struct(kind: T.StructType, **values: Column) -> Column:
    """Struct literal of a declared type; fields not given are null."""
    return F.struct(*[(values[f.name] if f.name in values else F.lit(None)).cast(f.dataType).alias(f.name) for f in kind.fields])


def _field_type(df: DataFrame, *names: str) -> T.DataType:
    kind: T.DataType = df.schema
    for n in names:
        if isinstance(kind, T.ArrayType):
            kind = kind.elementType
        kind = kind[n].dataType  # type: ignore[index]
    return kind


# --- automatic correction -----------------------------------------------------------------------


def fix_system(system: Column) -> Column:
    """Written code system to the correct one."""
    return F.coalesce(S.lookup(codes.SYSTEM_FIXES, system), system)


def fix_concept(concept: Column) -> Column:
    """Every coding of a concept."""
    return F.when(concept.isNotNull(), concept.withField("coding", F.transform(concept["coding"], lambda c: c.withField("system", fix_system(c["system"])))))


def fix_datetime(text: Column) -> Column:
    """Known date layouts to ISO, midnight instants to the date, ``Z`` to an explicit offset."""
    day = S.fix_date(text)
    instant = day.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?Z$")
    return F.when(instant, F.regexp_replace(day, "Z$", "+00:00")).otherwise(day)


def fix_reference(ref: Column) -> Column:
    """A bare UUID becomes a patient reference, ``Type123`` becomes ``Type/123``; anything with a slash is left alone."""
    uuid = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
    return (F.when(ref.contains("/"), ref).when(ref.rlike(uuid), F.concat(F.lit("Patient/"), ref))
            .when(ref.rlike("^[A-Za-z]+[0-9]+$"), F.regexp_replace(ref, "^([A-Za-z]+)([0-9]+)$", "$1/$2")).otherwise(ref))


def correction_rule(name: str, kind: T.DataType, around: T.StructType):
    """What to do with a field, by its name, its type and the struct it stands in; None leaves it alone.

    Coded elements have a system and a code; dates have ``date`` in their name or are one of three others.
    """
    if not isinstance(kind, T.StringType):
        return None
    low = name.lower()
    if low == "reference":
        return lambda value, _: fix_reference(value)
    if "date" in low or low in ("issued", "authored", "recorded"):
        return lambda value, _: fix_datetime(value)
    if low == "system" and {"system", "code"} <= set(around.names) and "resourceType" not in around.names:
        return lambda value, element: F.when(element["code"].isNotNull(), fix_system(value)).otherwise(value)
    return None


def correction_test(name: str, kind: T.DataType, around: T.StructType):
    """Whether a list of texts may hold one that the rule of a field changes; all that change pass, some others may."""
    low = name.lower()
    if low == "system":
        return lambda texts: F.arrays_overlap(texts, F.split(F.lit("\n".join(codes.SYSTEM_FIXES)), "\n"))
    if low == "reference":
        return lambda texts: F.array_join(texts, "\n").rlike(r"(^|\n)[^/\n]+(\n|\z)")
    return lambda texts: F.array_join(texts, "") != ""


def _logged(path: Column, name: str) -> Column:
    """A corrected element is logged under its own path, other fields under theirs."""
    return path if name == "system" else F.concat(path, F.lit(f".{name}"))


def correct(df: DataFrame) -> DataFrame:
    """Every coded element, date and reference of a whole record, at any depth, and a ``corrections`` list of (path, old, new).

    Corrected leaves and lists are made once; lists are walked only where they may hold something to correct.
    """
    made = walk.makings(df.schema, correction_rule, correction_test)
    columns = {at: f"_made_{n}" for n, at in enumerate(made)}
    both = df.withColumns({columns[at]: v for at, v in made.items()})
    have = {at: F.col(c) for at, c in columns.items()}
    new = walk.rewrite(df.schema, correction_rule, have)
    listed = walk.changes(df.schema, correction_rule, have, _logged)
    return both.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns], listed.alias("corrections"))


# Valid status values per type. Fixed values.
STATUS_VALUES = {
    "Patient": ["active", "inactive", "unknown"], "Observation": codes.OBSERVATION_STATUS, "Encounter": codes.ENCOUNTER_STATUS, "MedicationRequest": codes.MEDICATION_STATUS,
    "Condition": ["active", "recurrence", "relapse", "inactive", "remission", "resolved", "unknown"],
}


def suggest_values(kind: Column, field: Column, value: Column) -> Column:
    """List of (value, explanation) for a wrong date, code system, status or reference."""
    low, leaf = F.lower(field), F.lower(F.substring_index(field, ".", -1))

    def item(v, text):
        return F.struct(v.alias("value"), F.concat(F.lit(text), v).alias("explanation"))

    is_date = low.contains("date") | leaf.isin("issued", "authored", "recorded")
    date = fix_datetime(value)
    out = [F.when(is_date & (date != value), item(date, "ISO 8601 format: "))]
    lowered = {k.lower(): v for k, v in codes.SYSTEM_FIXES.items()}
    system = S.lookup(lowered, F.lower(value))
    out.append(F.when(low.contains("system"), item(system, "Correct system URL: ")))
    for name, values in STATUS_VALUES.items():
        for v in values:
            near = F.lower(value).contains(v) | F.lit(v).contains(F.lower(value))
            out.append(F.when(F.endswith(field, F.lit(".status")) & (kind == name) & near, item(F.lit(v), f"Valid status for {name}: ")))
    ref = fix_reference(value)
    out.append(F.when(F.endswith(field, F.lit(".reference")) & (ref != value), item(ref, "Properly formatted reference: ")))
    return F.filter(F.array_compact(F.array(*out)), lambda x: x["value"].isNotNull())


# --- tiers ----------------------------------------------------------------------------------------


def set_tier(df: DataFrame, tier: str) -> DataFrame:
    """Quality-tier tag, replacing an earlier one."""
    meta, coding = F.col("meta"), _field_type(df, "meta", "tag")
    tags = F.coalesce(meta["tag"], F.array().cast(coding))
    kept = F.filter(tags, lambda t: ~F.coalesce((t["system"] == codes.TIER_SYSTEM) & t["code"].isin("BRONZE", "SILVER", "GOLD"), F.lit(False)))
    tag = _struct(coding.elementType, system=F.lit(codes.TIER_SYSTEM), code=F.lit(tier), display=F.lit(f"{tier.capitalize()} Quality Tier"))
    base = F.coalesce(meta, _struct(_field_type(df, "meta")))
    return df.withColumn("meta", base.withField("tag", F.concat(kept, F.array(tag))))


def _log(df: DataFrame, *entries: tuple[Column, Column | str, str] | Column) -> DataFrame:
    """Append (path, reason) rows whose condition holds to the ``modifications`` list."""
    items = [e if isinstance(e, Column) else F.when(F.coalesce(e[0], F.lit(False)), F.array(F.struct((F.lit(e[1]) if isinstance(e[1], str) else e[1]).alias("path"), F.lit(e[2]).alias("reason"))))
             .otherwise(F.array().cast(_CHANGE)) for e in entries]
    before = F.col("modifications") if "modifications" in df.columns else F.array().cast(_CHANGE)
    return df.withColumn("modifications", F.concat(before, *items))


def _each(items: Column, test, at: str, reason: str) -> Column:
    """Log entries of the list elements that pass a test."""
    numbered = F.transform(items, lambda x, i: F.struct(F.coalesce(test(x), F.lit(False)).alias("hit"), F.concat(F.lit(at.split("[]")[0] + "["), i.cast("string"), F.lit("]" + at.split("[]")[1])).alias("path")))
    listed = F.transform(F.filter(numbered, lambda x: x["hit"]), lambda x: F.struct(x["path"].alias("path"), F.lit(reason).alias("reason")))
    return F.coalesce(listed, F.array().cast(_CHANGE))


def patient_to_silver(df: DataFrame) -> DataFrame:
    """Consistent gender, usable names, an identifier, a marked bad birth date, valid telecom codes."""
    def no_label(n):
        return S.blank_to_null(n["family"]).isNull() & S.blank_to_null(n["text"]).isNull() & (F.size(n["given"]) > 0)

    def bad_use(n):
        return n["use"].isNotNull() & ~n["use"].isin(codes.NAME_USE)

    bad_birth = F.col("birthDate").isNotNull() & F.try_to_timestamp("birthDate", F.lit("yyyy-MM-dd")).isNull()
    no_ident = F.col("identifier").isNull() | (F.size("identifier") == 0)

    def bad_system(t):
        return t["system"].isNotNull() & ~t["system"].isin(codes.TELECOM_SYSTEM)

    def bad_telecom_use(t):
        return t["use"].isNotNull() & ~t["use"].isin(codes.TELECOM_USE)

    logged = _log(df, _each(F.col("name"), lambda n: n["use"].isNull(), "name[].use", "Added default name.use"),
                  _each(F.col("name"), no_label, "name[].text", "Added name.text from given name"), _each(F.col("name"), bad_use, "name[].use", "Corrected invalid name.use"),
                  (no_ident, "identifier", "Added minimal identifier"), (bad_birth, "_birthDate.extension", "Added validation warning for birthDate"),
                  _each(F.col("telecom"), bad_system, "telecom[].system", "Corrected invalid telecom.system value"),
                  _each(F.col("telecom"), bad_telecom_use, "telecom[].use", "Corrected invalid telecom.use value"))
    name = F.transform("name", lambda n: n.withField("text", F.when(no_label(n), F.array_join(n["given"], " ")).otherwise(n["text"])).withField(
        "use", F.when(n["use"].isNull() | bad_use(n), F.lit("usual")).otherwise(n["use"])))
    telecom = F.transform("telecom", lambda t: t.withField("system", F.when(bad_system(t), F.lit("other")).otherwise(t["system"])).withField(
        "use", F.when(bad_telecom_use(t), F.lit("temp")).otherwise(t["use"])))
    ident_kind, mark_kind = _field_type(df, "identifier"), _field_type(df, "_birthDate")
    temp = F.array(_struct(ident_kind.elementType, system=F.lit("http://example.org/fhir/temp-identifiers"), value=F.concat(F.lit("TEMP-"), F.coalesce("id", F.lit("UNKNOWN")))))
    ext_kind = mark_kind["extension"].dataType.elementType
    mark = F.struct(F.array(_struct(ext_kind, url=F.lit("http://example.org/fhir/StructureDefinition/validation-issue"),
                                    valueString=F.lit("Invalid date format, should be YYYY-MM-DD"))).alias("extension"))
    gender_ext = F.filter(F.col("_gender")["extension"], lambda e: ~(F.coalesce(e["url"] == codes.ABSENT_URL, F.lit(False)) & F.col("gender").isNotNull()))
    return logged.withColumns({"name": name, "telecom": telecom, "identifier": F.when(no_ident, temp).otherwise(F.col("identifier")),
                               "_birthDate": F.when(bad_birth, mark).otherwise(F.col("_birthDate")),
                               "_gender": F.when(F.col("_gender").isNotNull(), F.col("_gender").withField("extension", gender_ext))})


def observation_to_silver(df: DataFrame) -> DataFrame:
    """Status and code defaults, patient reference without a type."""
    ref = F.col("subject")["reference"]
    bare = ref.isNotNull() & ~ref.contains("/")
    logged = _log(df, (F.col("status").isNull(), "status", "Added missing required status"), (F.col("code").isNull(), "code", "Added missing required code"),
                  (bare, "subject.reference", "Fixed subject reference format"))
    kind = _field_type(df, "code")
    coding = _struct(kind["coding"].dataType.elementType, system=F.lit("http://terminology.hl7.org/CodeSystem/data-absent-reason"), code=F.lit("unknown"), display=F.lit("Unknown"))
    unknown = _struct(kind, coding=F.array(coding))
    return logged.withColumns({"status": F.coalesce("status", F.lit("unknown")), "code": F.coalesce("code", unknown),
                               "subject": F.when(F.col("subject").isNotNull(), F.col("subject").withField("reference", F.when(bare, F.concat(F.lit("Patient/"), ref)).otherwise(ref)))})


def encounter_to_silver(df: DataFrame) -> DataFrame:
    """Status set, ``T`` between date and time."""
    bad = F.col("status").isNotNull() & ~F.col("status").isin(codes.ENCOUNTER_STATUS)
    entries: list = [(F.col("status").isNull(), "status", "Added missing required status"), (bad, "status", "Corrected invalid status value")]
    period = F.col("period")
    for side in ("start", "end"):
        spaced = F.col("period")[side].contains(" ") & ~F.col("period")[side].contains("T")
        entries.append((spaced, f"period.{side}", "Fixed datetime format"))
        period = period.withField(side, F.when(spaced, F.replace(F.col("period")[side], F.lit(" "), F.lit("T"))).otherwise(F.col("period")[side]))
    return _log(df, *entries).withColumns({"status": F.when(F.col("status").isNull() | bad, F.lit("unknown")).otherwise(F.col("status")),
                                           "period": F.when(F.col("period").isNotNull(), period)})


def generic_to_silver(df: DataFrame, as_of: str) -> DataFrame:
    """``meta.lastUpdated`` default."""
    missing = path("meta.lastUpdated").isNull()
    base = F.coalesce("meta", _struct(_field_type(df, "meta")))
    return _log(df, (missing, "meta.lastUpdated", "Added missing lastUpdated timestamp")).withColumn(
        "meta", base.withField("lastUpdated", F.coalesce(path("meta.lastUpdated"), F.lit(as_of))))


def to_silver(df: DataFrame, kind: str, as_of: str = "2002-01-01") -> DataFrame:
    """Bronze to silver of one type."""
    steps = {"Patient": patient_to_silver, "Observation": observation_to_silver, "Encounter": encounter_to_silver}
    fixed = steps[kind](df) if kind in steps else generic_to_silver(df, as_of)
    return set_tier(fixed, "SILVER")


def _claim(df: DataFrame, profile: str, eligible: Column, reason: str) -> DataFrame:
    have = F.coalesce(path("meta.profile"), F.array().cast("array<string>"))
    add = eligible & ~F.array_contains(have, profile)
    base = F.coalesce("meta", _struct(_field_type(df, "meta")))
    return _log(df, (add, "meta.profile", reason)).withColumn(
        "meta", F.when(add, base.withField("profile", F.concat(have, F.array(F.lit(profile))))).otherwise(F.col("meta")))


def _complete_race(df: DataFrame) -> DataFrame:
    """A race extension gets the missing OMB category and text."""
    kind = _field_type(df, "extension").elementType
    child, coding = kind["extension"].dataType.elementType, kind["valueCoding"].dataType

    def is_race(e):
        return F.coalesce(e["url"] == codes.RACE_URL, F.lit(False))

    def has(e, url):
        return F.coalesce(F.exists(e["extension"], lambda c: F.coalesce(c["url"] == url, F.lit(False))), F.lit(False))

    unk = _struct(child, url=F.lit("ombCategory"), valueCoding=_struct(coding, system=F.lit("urn:oid:2.16.840.1.113883.6.238"), code=F.lit("UNK"), display=F.lit("Unknown")))

    def completed(e):
        omb = F.get(F.filter(e["extension"], lambda c: c["url"] == "ombCategory"), F.lit(0))["valueCoding"]["display"]
        text = _struct(child, url=F.lit("text"), valueString=F.coalesce(omb, F.lit("Unknown")))
        none = F.array().cast(T.ArrayType(child))
        return F.concat(F.coalesce(e["extension"], none), F.when(has(e, "ombCategory"), none).otherwise(F.array(unk)), F.when(has(e, "text"), none).otherwise(F.array(text)))

    logged = _log(df, _each(F.col("extension"), lambda e: is_race(e) & ~has(e, "ombCategory"), "extension[].extension", "Added missing OMB category to race extension"),
                  _each(F.col("extension"), lambda e: is_race(e) & ~has(e, "text"), "extension[].extension", "Added missing text to race extension"))
    return logged.withColumn("extension", F.transform("extension", lambda e: F.when(is_race(e), e.withField("extension", completed(e))).otherwise(e)))


def phi_tags(df: DataFrame) -> DataFrame:
    """PHI security tags."""
    coding = _field_type(df, "meta", "security")
    tags = F.array(_struct(coding.elementType, system=F.lit(codes.ACT_CODE), code=F.lit("PHI"), display=F.lit("Protected Health Information")),
                   _struct(coding.elementType, system=F.lit("http://example.org/fhir/security-tags"), code=F.lit("PHI-RESTRICTED"),
                           display=F.lit("Contains PHI - Handle according to privacy policies")))
    base = F.coalesce("meta", _struct(_field_type(df, "meta")))
    return df.withColumn("meta", base.withField("security", F.concat(F.coalesce(path("meta.security"), F.array().cast(coding)), tags)))


def _cap(col: Column) -> Column:
    return F.concat(F.upper(F.substring(col, 1, 1)), F.lower(F.substring(col, 2, 2**31 - 1)))


def _list(title: str, items: Column) -> Column:
    return F.when(F.size(items) > 0, F.concat(F.lit(f"<h2>{title}</h2><ul>"), F.array_join(F.transform(items, lambda x: F.concat(F.lit("<li>"), x, F.lit("</li>"))), ""), F.lit("</ul>"))).otherwise("")


def patient_xhtml() -> Column:
    """E12."""
    def label(n):
        full = F.trim(F.concat(F.coalesce(F.array_join(n["given"], " "), F.lit("")), F.lit(" "), F.coalesce(n["family"], F.lit(""))))
        return F.coalesce(S.blank_to_null(n["text"]), F.when(n["family"].isNotNull() | n["given"].isNotNull(), full))

    shown = F.get(F.filter(F.transform("name", label), lambda x: x.isNotNull()), F.lit(0))
    idents = F.transform("identifier", lambda i: F.concat(
        F.coalesce(F.get(F.filter(F.transform(i["type"]["coding"], lambda c: c["display"]), lambda d: d.isNotNull()), F.lit(0)), F.lit("ID")), F.lit(": "),
        F.coalesce(i["value"], F.lit("")), F.lit(" ("), F.coalesce(i["system"], F.lit("Unknown system")), F.lit(")")))
    contacts = F.transform("telecom", lambda t: F.concat(_cap(F.coalesce(t["system"], F.lit("unknown"))), F.coalesce(F.concat(F.lit(" ("), t["use"], F.lit(")")), F.lit("")),
                                                         F.lit(": "), F.coalesce(t["value"], F.lit(""))))
    addresses = F.transform("address", lambda a: F.concat(F.coalesce(_cap(a["use"]), F.lit("Unknown")), F.lit(" Address: "),
                                                          F.concat_ws(", ", a["line"], a["city"], a["state"], a["postalCode"], a["country"])))
    return F.concat(F.lit(XHTML + "<h1>Patient: "), F.coalesce(shown, F.lit("Unknown")), F.lit("</h1><p><b>Gender:</b> "), F.coalesce(_cap(F.col("gender")), F.lit("Unknown")),
                    F.lit("</p><p><b>Date of Birth:</b> "), F.coalesce("birthDate", F.lit("Unknown")), F.lit("</p>"), _list("Identifiers", idents),
                    _list("Contact Information", contacts), _list("Addresses", addresses), F.lit("</div>"))


def _part(label: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(f"<p><b>{label}:</b> "), value, F.lit("</p>")), F.lit(""))


def observation_xhtml() -> Column:
    """E12."""
    first = F.get(F.filter(F.transform(path("code.coding"), lambda c: c["display"]), lambda d: d.isNotNull()), F.lit(0))
    cc = path("valueCodeableConcept")
    q = F.col("valueQuantity")
    value = F.coalesce(F.when(q.isNotNull(), F.concat(F.coalesce(q["value"].cast("string"), F.lit("")), F.lit(" "), F.coalesce(q["unit"], F.lit("")))),
                       F.when(cc.isNotNull(), F.coalesce(cc["text"], F.get(cc["coding"], F.lit(0))["display"], F.lit(""))), F.col("valueString"), F.lit("No value recorded"))
    return F.concat(F.lit(XHTML + "<h1>Observation: "), F.coalesce(path("code.text"), first, F.lit("Unknown Observation")), F.lit("</h1>"),
                    _part("Status", _cap(F.coalesce("status", F.lit("unknown")))), _part("Effective Date", F.col("effectiveDateTime")),
                    _part("Subject", path("subject.reference")), _part("Value", value), F.lit("</div>"))


def encounter_xhtml() -> Column:
    """The title comes from the first type with a text or display."""
    shown = F.get(F.filter(F.transform("type", lambda t: F.coalesce(t["text"], F.get(t["coding"], F.lit(0))["display"])), lambda x: x.isNotNull()), F.lit(0))
    period = F.when(F.col("period").isNotNull(), F.concat(F.coalesce(path("period.start"), F.lit("Unknown")), F.lit(" to "), F.coalesce(path("period.end"), F.lit("Ongoing"))))
    return F.concat(F.lit(XHTML + "<h1>Encounter: "), F.coalesce(shown, F.lit("Unknown Encounter")), F.lit("</h1>"), _part("Status", _cap(F.coalesce("status", F.lit("unknown")))),
                    _part("Class", F.coalesce(path("class.display"), path("class.code"))), _part("Period", period), _part("Subject", path("subject.reference")), F.lit("</div>"))


def generic_xhtml() -> Column:
    """E12."""
    return F.concat(F.lit(XHTML + "<p>"), "resourceType", F.lit(" resource with ID: "), F.coalesce("id", F.lit("Unknown")), F.lit("</p></div>"))


def _narrate(df: DataFrame, div: Column, reason: str, only_missing: bool = False) -> DataFrame:
    write = F.col("text").isNull() if only_missing else F.lit(True)
    text = F.struct(F.lit("generated").alias("status"), div.alias("div"))
    return _log(df, (write, "text", reason)).withColumn("text", F.when(write, text).otherwise(F.col("text")))


def to_gold(df: DataFrame, kind: str) -> DataFrame:
    """Silver to gold of one type."""
    out = set_tier(df, "GOLD")
    if kind == "Patient":
        named = F.coalesce(F.exists("name", lambda n: S.blank_to_null(n["family"]).isNotNull() | S.blank_to_null(n["text"]).isNotNull()), F.lit(False))
        out = _claim(out, codes.US_CORE + "us-core-patient", F.coalesce(F.size("identifier") > 0, F.lit(False)) & named, "Added US Core profile")
        return phi_tags(_narrate(_complete_race(out), patient_xhtml(), "Added comprehensive narrative"))
    if kind == "Observation":
        full = F.coalesce(F.size("category") > 0, F.lit(False)) & F.col("code").isNotNull() & F.col("status").isNotNull() & F.col("subject").isNotNull()
        out = _claim(out, codes.US_CORE + "us-core-observation-lab", full, "Added US Core Observation profile")
        return _narrate(out, observation_xhtml(), "Added comprehensive narrative")
    if kind == "Encounter":
        return _narrate(out, encounter_xhtml(), "Added comprehensive narrative")
    return _narrate(out, generic_xhtml(), "Added basic narrative", only_missing=True)


def modification_log(df: DataFrame, as_of: str) -> DataFrame:
    """One row per modification."""
    return df.select(F.col("resourceType").alias("resource_type"), F.col("id").alias("resource_id"), F.inline("modifications"), F.lit(as_of).alias("timestamp"))


def tier_report(frames: dict[str, DataFrame]) -> DataFrame:
    """Records and modifications per type and tier after a run."""
    out = None
    for kind, df in frames.items():
        tag = F.get(F.filter(path("meta.tag"), lambda t: t["system"] == codes.TIER_SYSTEM), F.lit(0))["code"]
        part = df.groupBy(tag.alias("tier")).agg(F.count(F.lit(1)).alias("records"), F.sum(F.size("modifications")).alias("modifications")).withColumn("resource_type", F.lit(kind))
        out = part if out is None else out.unionByName(part)
    return out


def fill_required(df: DataFrame, kind: str, tier: str, default_subject: str | None = None, tier_system: str = "http://example.org/fhir/data-tier",
                  tier_url: str = "http://example.org/fhir/StructureDefinition/data-quality-tier") -> DataFrame:
    """E13 (D19): defaults per type, tier tag, tier extension of patients and a default text in gold."""
    def concept(name, system, code):
        kind_ = _field_type(df, name)
        return _struct(kind_, coding=F.array(_struct(kind_["coding"].dataType.elementType, system=F.lit(system), code=F.lit(code))))

    new: dict[str, Column] = {}
    if kind == "Patient":
        ident, names = _field_type(df, "identifier"), _field_type(df, "name")
        new["identifier"] = F.coalesce("identifier", F.array(_struct(ident.elementType, system=F.lit("http://example.org/fhir/identifier/patient"), value=F.coalesce("id", F.lit("unknown")))))
        new["name"] = F.coalesce("name", F.array(_struct(names.elementType, use=F.lit("official"), family=F.lit("Unknown"))))
    else:
        if default_subject:
            new["subject"] = F.coalesce("subject", _struct(_field_type(df, "subject"), reference=F.lit(f"Patient/{default_subject}")))
        if kind == "Observation":
            new.update(status=F.coalesce("status", F.lit("final")), code=F.coalesce("code", concept("code", codes.LOINC, "unknown")))
        elif kind == "Condition":
            new["clinicalStatus"] = F.coalesce("clinicalStatus", concept("clinicalStatus", "http://terminology.hl7.org/CodeSystem/condition-clinical", "active"))
            new["verificationStatus"] = F.coalesce("verificationStatus", concept("verificationStatus", "http://terminology.hl7.org/CodeSystem/condition-ver-status", "confirmed"))
            new["code"] = F.coalesce("code", concept("code", codes.SNOMED, "unknown"))
        elif kind == "Encounter":
            new["status"] = F.coalesce("status", F.lit("finished"))
            new["class"] = F.coalesce("class", _struct(_field_type(df, "class"), system=F.lit(codes.ACT_CODE), code=F.lit("AMB")))
    coding = _field_type(df, "meta", "tag")
    tags = F.coalesce(path("meta.tag"), F.array().cast(coding))
    there = F.exists(tags, lambda t: F.coalesce((t["system"] == tier_system) & (t["code"] == tier), F.lit(False)))
    tag = _struct(coding.elementType, system=F.lit(tier_system), code=F.lit(tier), display=F.lit(tier.capitalize()))
    new["meta"] = F.coalesce("meta", _struct(_field_type(df, "meta"))).withField("tag", F.when(there, tags).otherwise(F.concat(tags, F.array(tag))))
    if tier == "gold":
        new["text"] = F.coalesce("text", _struct(_field_type(df, "text"), status=F.lit("generated"),
                                                 div=F.lit(f'<div xmlns="http://www.w3.org/1999/xhtml"><p>{kind} resource</p></div>')))
    if kind == "Patient" and tier in ("silver", "gold"):
        ext = _field_type(df, "extension")
        kept = F.filter(F.coalesce("extension", F.array().cast(ext)), lambda e: ~F.coalesce(e["url"] == tier_url, F.lit(False)))
        new["extension"] = F.concat(kept, F.array(_struct(ext.elementType, url=F.lit(tier_url), valueString=F.lit(tier))))
    return df.withColumns(new)


def deidentify(df: DataFrame, kind: str) -> DataFrame:
    """Names and identifiers masked, telecom and address emptied, narrative replaced."""
    new: dict[str, Column] = {}
    mask = F.lit("XXXXX")
    if kind == "Patient":
        new["name"] = F.transform("name", lambda n: n.withField("given", F.transform(n["given"], lambda _: mask)).withField("family", F.when(n["family"].isNotNull(), mask)))
        new["identifier"] = F.transform("identifier", lambda i: i.withField("value", F.when(i["value"].isNotNull(), mask)))
        for c in ("telecom", "address"):
            new[c] = F.when(F.col(c).isNotNull(), F.array().cast(_field_type(df, c)))
    new["text"] = F.when(path("text.div").isNotNull(), F.col("text").withField("div", F.lit("<div>De-identified</div>"))).otherwise(F.col("text"))
    return df.withColumns(new)
