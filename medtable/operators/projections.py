"""Resource-level projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import codes, types
from ..functions import scalars as S
from ..functions.paths import both, nav, path, text_of, union_values

_TEXTS = "array<string>"


def _pick(items: Column, use: str | None = None) -> Column:
    """First element with the given use, else the first one."""
    head = F.get(items, F.lit(0))
    return head if use is None else F.coalesce(F.get(F.filter(items, lambda x: x["use"] == use), F.lit(0)), head)


def _strict(items: Column, test) -> Column:
    """First element that passes the test (filter, then first: D5)."""
    return F.get(F.filter(items, test), F.lit(0))


def _ts(spec: str) -> Column:
    return S.parse_datetime(path(spec))


def _id(ref: Column) -> Column:
    return S.reference_parts(ref)["id"]


# --- generic shapes -------------------------------------------------------------------------------


def _flat_columns(schema: T.StructType, base: Column | None, prefix: str) -> list[Column]:
    out: list[Column] = []
    for f in schema.fields:
        col, name = (F.col(f"`{f.name}`") if base is None else base.getField(f.name)), prefix + f.name
        kind = f.dataType
        if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType):
            out += _flat_columns(kind.elementType, F.get(col, F.lit(0)), name + ".")
        elif isinstance(kind, T.ArrayType):
            out.append(F.when(F.size(col) > 0, F.array_join(col.cast(_TEXTS), ",")).alias(name))
        elif isinstance(kind, T.StructType):
            out += _flat_columns(kind, col, name + ".")
        else:
            out.append(col.alias(name))
    return out


def flatten_first(df: DataFrame) -> DataFrame:
    """Every leaf as a column; first element of object lists, scalar lists joined by a comma."""
    return df.select(*_flat_columns(df.schema, None, ""))


def _leaves(col: Column, kind: T.DataType, at: Column, depth: int) -> Column:
    entry = "array<struct<path:string,value:string>>"
    if isinstance(kind, T.StructType) and depth > 0:
        parts = [_leaves(col.getField(f.name), f.dataType, F.concat(at, F.lit("." + f.name)), depth - 1) for f in kind.fields]
        return F.when(col.isNotNull(), F.concat(*parts)).otherwise(F.array().cast(entry))
    if isinstance(kind, T.ArrayType) and depth > 0:
        inner = F.transform(F.coalesce(col, F.array().cast(kind)), lambda x, i: _leaves(
            x, kind.elementType, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")), depth - 1))
        return F.flatten(inner)
    value = text_of(col, not isinstance(kind, (T.StructType, T.ArrayType)))
    return F.when(col.isNotNull(), F.array(F.struct(at.alias("path"), value.alias("value")))).otherwise(F.array().cast(entry))


def flatten_long(df: DataFrame, key: str, cols: list[str] | None = None, depth: int = 10) -> DataFrame:
    """Long form (key, path with every index, value), up to ``depth`` levels; no null leaves."""
    fields = [f for f in df.schema.fields if f.name != key and (cols is None or f.name in cols)]
    leaves = F.concat(*[_leaves(F.col(f"`{f.name}`"), f.dataType, F.lit(f.name), depth) for f in fields])
    return df.select(key, F.inline(leaves))


def scalars_only(df: DataFrame) -> DataFrame:
    """P20: atomic fields with the id, type and last update."""
    simple = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType))]
    return df.select(*simple, path("meta.lastUpdated").alias("lastUpdated"))


# --- catalogue of path expressions (P16) -----------------------------------------------------------


def _race_text(child_url: str) -> Column:
    return S.extension_child(F.col("extension"), codes.US_CORE + child_url, "text")


def _home_phone() -> Column:
    home = _strict(F.col("telecom"), lambda x: (x["system"] == "phone") & (x["use"] == "home"))["value"]
    return F.coalesce(home, path("telecom[?system='phone'].value"))


def patient_catalogue(df: DataFrame) -> DataFrame:
    """Patient demographics by path expressions (unions, nested where, implicit flatten)."""
    official, anywhere = nav("name").where("use", "official"), nav("name").all()
    home = _pick(F.col("address"), "home")
    return df.select(
        "id", "active", "gender", "birthDate", F.coalesce(F.col("deceasedBoolean").cast("string"), "deceasedDateTime").alias("deceased"),
        S.coding_in(F.col("maritalStatus"), "http://terminology.hl7.org/CodeSystem/v3-MaritalStatus")["code"].alias("maritalStatus"),
        F.coalesce(official.f("family").first(), anywhere.f("family").first()).alias("familyName"),
        F.coalesce(official.flat("given").values(), anywhere.flat("given").values()).alias("givenNames"),
        union_values(anywhere.f("family").col).alias("familyNames"), _home_phone().alias("phone"),
        nav("telecom").where("system", "email").f("value").first().alias("email"), F.array_join(home["line"], ", ").alias("line"),
        home["city"].alias("city"), home["state"].alias("state"), home["postalCode"].alias("postalCode"), home["country"].alias("country"),
        S.preferred_language(F.col("communication")).alias("language"), _race_text("us-core-race").alias("race"),
        _race_text("us-core-ethnicity").alias("ethnicity"), nav("extension").all().exists().alias("has_extension"))


def observation_catalogue(df: DataFrame) -> DataFrame:
    """Observation values with the component list."""
    unit = F.coalesce(path("valueQuantity.unit"), path("valueQuantity.code"))
    parts = F.transform(F.col("component"), lambda c: F.concat_ws(
        "=", S.concept_code(c["code"]), F.coalesce(c["valueQuantity"]["value"].cast("string"), c["valueString"])))
    return df.select(
        "id", "status", nav("category").all().flat("coding").f("code").first().alias("category"), path("code.coding[0].code").alias("code"),
        F.coalesce(path("code.coding[0].display"), path("code.text")).alias("codeDisplay"),
        F.coalesce("effectiveDateTime", path("effectivePeriod.start")).alias("effectiveDateTime"),
        path("valueQuantity.value").alias("value"), unit.alias("unit"), path("valueCodeableConcept.coding[0].code").alias("valueCode"),
        F.col("valueString").alias("valueString"), both(path("valueQuantity.value").cast("string"), F.concat(F.lit(" "), unit)).alias("valueQuantityString"),
        path("subject.reference").alias("patientId"), parts.alias("components"))


def encounter_catalogue(df: DataFrame) -> DataFrame:
    """Encounter expressions."""
    return df.select(
        "id", "status", path("class.code").alias("class"), path("type[0].coding[0].code").alias("type"),
        F.coalesce(path("type[0].coding[0].display"), path("type[0].text")).alias("typeDisplay"), path("subject.reference").alias("subject"),
        nav("participant").all().flat("type").flat("coding").f("code").values().alias("participantTypes"), path("period.start").alias("start"),
        path("period.end").alias("end"), nav("diagnosis").all().f("condition").f("reference").values().alias("diagnosis"),
        path("location[0].location.reference").alias("location"), path("serviceProvider.reference").alias("serviceProvider"))


# --- silver ---------------------------------------------------------------------------------------


def patient_flat_row(raw: DataFrame, source: str = "source") -> DataFrame:
    """Raw JSON to 19 flat columns; rows without an id are dropped."""
    r = raw.select(F.from_json("json_data", types.SCHEMAS["Patient"]).alias("r")).select("r.*").where("id IS NOT NULL")
    return r.select(
        "id", S.identifier_pair(path("identifier[0]")).alias("identifier"), F.col("active").cast("string").alias("active"),
        F.array_join(path("name[0].given"), " ").alias("name_given"), path("name[0].family").alias("name_family"), path("name[0].text").alias("name_text"),
        "gender", F.col("birthDate").try_cast("date").alias("birthDate"), F.array_join(path("address[0].line"), ", ").alias("address_line"),
        path("address[0].city").alias("address_city"), path("address[0].state").alias("address_state"), path("address[0].postalCode").alias("address_postalCode"),
        path("address[0].country").alias("address_country"), path("telecom[?system='phone'].value").alias("telecom_phone"),
        path("telecom[?system='email'].value").alias("telecom_email"), path("maritalStatus.coding[0].code").alias("maritalStatus"),
        nav("communication").all().f("language").flat("coding").f("code").first().alias("communication_language"),
        _ts("meta.lastUpdated").alias("meta_lastUpdated"), F.lit(source).alias("source"))


def _provenance(kind: str, run_time: str) -> Column:
    return F.struct(F.lit(kind).alias("resourceType"), F.lit(run_time).alias("processed_at")).alias("_source")


def patient_silver(df: DataFrame, run_time: str = "2002-01-01") -> DataFrame:
    """R02, R07."""
    name, address = _pick(F.col("name"), "official"), _pick(F.col("address"), "home")
    given = F.get(name["given"], F.lit(0))
    return df.select(
        "id", F.struct(name["family"].alias("family"), given.alias("given"), F.get(name["given"], F.lit(1)).alias("middle"),
                       F.concat_ws(" ", given, name["family"]).alias("full")).alias("name"),
        "gender", "birthDate", F.struct(F.get(address["line"], F.lit(0)).alias("street"), address["city"].alias("city"), address["state"].alias("state"),
                                        address["postalCode"].alias("postalCode")).alias("address"),
        F.struct(path("telecom[?system='email'].value").alias("email"), path("telecom[?system='phone'].value").alias("phone")).alias("contact"),
        F.struct(S.identifier_value(F.col("identifier"), "mrn").alias("mrn")).alias("identifiers"), _provenance("Patient", run_time))


def observation_silver(df: DataFrame, run_time: str = "2002-01-01") -> DataFrame:
    """First coding and the typed value, Quantity before String before CodeableConcept."""
    q, cc = F.col("valueQuantity"), path("valueCodeableConcept.coding[0]")
    kind = F.when(q.isNotNull(), "Quantity").when(F.col("valueString").isNotNull(), "String").when(F.col("valueCodeableConcept").isNotNull(), "CodeableConcept")
    value = F.when(q.isNotNull(), q["value"].cast("string")).when(F.col("valueString").isNotNull(), F.col("valueString")).otherwise(cc["code"])
    unit = F.when(q.isNotNull(), q["unit"]).when(F.col("valueString").isNull(), cc["display"])
    return df.select("id", "status", F.struct(path("code.coding[0].code").alias("code"), path("code.coding[0].system").alias("system"),
                                              path("code.coding[0].display").alias("display")).alias("code"),
                     F.struct(value.alias("value"), unit.alias("unit"), kind.alias("type")).alias("value"), path("subject.reference").alias("subject"),
                     "effectiveDateTime", "issued", _provenance("Observation", run_time))


def medication_silver(df: DataFrame, run_time: str = "2002-01-01") -> DataFrame:
    """Concept or reference, first dosage and the timing phrase."""
    rep = path("dosageInstruction[0].timing.repeat")
    timing = F.concat(rep["frequency"].cast("string"), F.lit(" times per "), rep["period"].cast("string"), F.lit(" "), rep["periodUnit"])
    return df.select("id", "status", "intent", F.coalesce(path("medicationCodeableConcept.coding[0].code"), S.last_segment(path("medicationReference.reference"))).alias("medication"),
                     path("medicationCodeableConcept.coding[0].display").alias("display"), path("subject.reference").alias("subject"), "authoredOn",
                     F.struct(path("dosageInstruction[0].text").alias("text"), timing.alias("timing"),
                              path("dosageInstruction[0].route.coding[0].display").alias("route")).alias("dosage"), _provenance("MedicationRequest", run_time))


def condition_silver(df: DataFrame, run_time: str = "2002-01-01") -> DataFrame:
    """Statuses, category list and first code."""
    return df.select("id", path("clinicalStatus.coding[0].code").alias("clinicalStatus"), path("verificationStatus.coding[0].code").alias("verificationStatus"),
                     nav("category").all().flat("coding").f("code").values().alias("categories"), path("code.coding[0]").alias("code"),
                     path("subject.reference").alias("subject"), "onsetDateTime", "recordedDate", _provenance("Condition", run_time))


def encounter_silver(df: DataFrame, run_time: str = "2002-01-01") -> DataFrame:
    """Class, first type and the participant list."""
    people = F.transform(F.col("participant"), lambda p: F.struct(p["individual"]["reference"].alias("reference"),
                                                                  F.get(F.get(p["type"], F.lit(0))["coding"], F.lit(0))["code"].alias("type")))
    return df.select("id", "status", path("class.code").alias("class"), path("type[0].coding[0].code").alias("type"), path("subject.reference").alias("subject"),
                     path("period.start").alias("start"), path("period.end").alias("end"), people.alias("participants"), _provenance("Encounter", run_time))


SILVER = {"Patient": patient_silver, "Observation": observation_silver, "MedicationRequest": medication_silver,
          "Condition": condition_silver, "Encounter": encounter_silver}


#: The fields of a record that its projection reads; only these are parsed from the text of a frame.
SILVER_FIELDS = {
    "Patient": ("id", "name", "gender", "birthDate", "address", "telecom", "identifier"),
    "Observation": ("id", "status", "code", "subject", "effectiveDateTime", "issued", "valueQuantity", "valueString", "valueCodeableConcept"),
    "MedicationRequest": ("id", "status", "intent", "medicationCodeableConcept", "medicationReference", "subject", "authoredOn", "dosageInstruction"),
    "Condition": ("id", "clinicalStatus", "verificationStatus", "category", "code", "subject", "onsetDateTime", "recordedDate"),
    "Encounter": ("id", "status", "class", "type", "subject", "period", "participant")}


def silver_schema(name: str) -> T.StructType:
    """The part of a type's declared schema that its silver projection reads."""
    declared = T.StructType.fromDDL(types.SCHEMAS[name])
    return T.StructType([f for f in declared.fields if f.name in SILVER_FIELDS[name]])


def _typed(raw: DataFrame) -> DataFrame:
    """A raw frame with its ``resource_type`` and the ``frame`` a row belongs to.

    The generator keeps the optimiser from looking for the type once for every use of it.
    """
    rows = raw.select(*raw.columns, F.explode(F.array(F.get_json_object("json_data", "$.resourceType"))).alias("resource_type"))
    return rows.withColumn("frame", F.when(F.col("resource_type").isin(list(SILVER)), F.col("resource_type")).otherwise("other"))


def silver_rows(raw: DataFrame) -> DataFrame:
    """A mixed raw frame in one pass: ``resource_type``, the ``frame`` a row belongs to, and a column for each
    type with a projection, which holds the parsed record of its own rows.
    """
    return _typed(raw).withColumns({name: F.when(F.col("frame") == name, F.from_json("json_data", types.SCHEMAS[name])) for name in SILVER})


def silver_by_type(raw: DataFrame, run_time: str = "2002-01-01") -> dict[str, DataFrame]:
    """Split a mixed raw frame by record type and project each.

    Records of other types, and texts without a type, are not parsed: they are the frame ``other``, as they came and
    with their type, so every row of the input is in one of the frames. Each frame is a pass of its own over the
    input; ``silver_rows`` has them all in one.
    """
    rows = _typed(raw)
    out = {name: fn(rows.where(F.col("resource_type") == name).select(F.from_json("json_data", silver_schema(name)).alias("r")).select("r.*"), run_time) for name, fn in SILVER.items()}
    out["other"] = rows.where("frame = 'other'").select(*raw.columns, "resource_type")
    return out


# --- gold -----------------------------------------------------------------------------------------

_PLAN = "array<struct<plan_id:string,plan_name:string,coverage_type:string,start_date:date,end_date:date>>"
_RELATED = "array<struct<related_id:string,relationship_type:string>>"


def _lineage(source_system: str) -> list[Column]:
    updated = _ts("meta.lastUpdated")
    return [updated.alias("created_at"), updated.alias("updated_at"), F.lit(source_system).alias("source_system"),
            F.coalesce(path("meta.versionId"), F.lit("1")).alias("source_version")]


def patient_gold(df: DataFrame, source_system: str = "source") -> DataFrame:
    """R09, D-U6 (D5, D6): 27 columns; filter-then-first on every list."""
    def use(*allowed):
        return lambda x: x["use"].isin(*allowed) | x["use"].isNull()

    name, home = _strict(F.col("name"), use("official")), _strict(F.col("address"), use("home"))
    race = F.get(F.get(S.extensions(F.col("extension"), codes.RACE_URL), F.lit(0))["extension"], F.lit(0))
    ethnicity = F.get(F.get(S.extensions(F.col("extension"), codes.US_CORE + "us-core-ethnicity"), F.lit(0))["extension"], F.lit(0))
    gp = _strict(F.col("generalPractitioner"), lambda x: x["reference"].startswith("Practitioner/"))
    phone = _strict(F.col("telecom"), lambda x: (x["system"] == "phone") & ((x["use"] == "home") | x["use"].isNull()))
    language = S.preferred_language(F.col("communication"))
    return df.select(
        F.col("id").alias("patient_id"), S.identifier_value(F.col("identifier"), "mrn").alias("mrn"), F.get(name["given"], F.lit(0)).alias("first_name"),
        name["family"].alias("last_name"), F.col("birthDate").try_cast("date").alias("birth_date"), "gender", F.get(home["line"], F.lit(0)).alias("address_line1"),
        F.get(home["line"], F.lit(1)).alias("address_line2"), home["city"].alias("city"), home["state"].alias("state"), home["postalCode"].alias("postal_code"),
        home["country"].alias("country"), phone["value"].alias("phone"), path("telecom[?system='email'].value").alias("email"),
        path("maritalStatus.coding[0].display").alias("marital_status"), language.alias("language"), race["valueCoding"]["display"].alias("race"),
        ethnicity["valueCoding"]["display"].alias("ethnicity"), F.coalesce("deceasedBoolean", F.col("deceasedDateTime").isNotNull()).alias("is_deceased"),
        F.to_date(_ts("deceasedDateTime")).alias("deceased_date"), _id(gp["reference"]).alias("primary_care_provider_id"),
        gp["display"].alias("primary_care_provider_name"), F.array().cast(_PLAN).alias("insurance_plans"), *_lineage(source_system))


def encounter_gold(df: DataFrame, source_system: str = "source") -> DataFrame:
    """R10 (D5-D7): 35 columns with diagnoses and related encounters."""
    start, end = _ts("period.start"), _ts("period.end")
    diagnoses = F.transform(F.col("diagnosis"), lambda d: F.struct(
        _id(d["condition"]["reference"]).alias("diagnosis_code"), d["condition"]["display"].alias("diagnosis_display"),
        F.get(d["use"]["coding"], F.lit(0))["code"].alias("diagnosis_type"), d["rank"].cast("string").alias("diagnosis_rank")))
    practitioner = _strict(F.col("participant"), lambda p: p["individual"]["reference"].startswith("Practitioner/"))

    def coded(spec, name):
        return [path(f"{spec}.coding[0].code").alias(f"{name}_code"), path(f"{spec}.coding[0].display").alias(f"{name}_display")]

    related = F.when(path("partOf.reference").isNotNull(), F.array(F.struct(_id(path("partOf.reference")).alias("related_id"), F.lit("part-of").alias("relationship_type"))))
    return df.select(
        F.col("id").alias("encounter_id"), _id(path("subject.reference")).alias("patient_id"), start.alias("start_datetime"), end.alias("end_datetime"),
        S.stay_minutes(start, end).alias("duration_minutes"), "status", path("class.code").alias("class_code"), path("class.display").alias("class_display"),
        *coded("type[0]", "type"), *coded("serviceType", "service_type"), *coded("priority", "priority"), _id(path("location[0].location.reference")).alias("location_id"),
        path("location[0].location.display").alias("location_name"), _id(path("serviceProvider.reference")).alias("department_id"),
        path("serviceProvider.display").alias("department_name"), _id(practitioner["individual"]["reference"]).alias("provider_id"),
        practitioner["individual"]["display"].alias("provider_name"), F.get(F.get(practitioner["type"], F.lit(0))["coding"], F.lit(0))["display"].alias("provider_role"),
        *coded("reasonCode[0]", "reason"), path("reasonCode[0].text").alias("chief_complaint"),
        F.coalesce(diagnoses, F.array().cast("array<struct<diagnosis_code:string,diagnosis_display:string,diagnosis_type:string,diagnosis_rank:string>>")).alias("diagnoses"),
        *coded("hospitalization.dischargeDisposition", "discharge_disposition"), *coded("hospitalization.admitSource", "admission_source"),
        F.datediff(end, start).cast("double").alias("length_of_stay_days"), F.coalesce(related, F.array().cast(_RELATED)).alias("related_encounters"),
        *_lineage(source_system))


def observation_gold(df: DataFrame, source_system: str = "source") -> DataFrame:
    """R11 (D5): 29 columns."""
    q, rng = F.col("valueQuantity"), F.get(F.col("referenceRange"), F.lit(0))
    performer = S.reference_parts(path("performer[0].reference"))
    related = F.transform("related", lambda r: F.struct(_id(r["target"]["reference"]).alias("related_id"), r["type"].alias("relationship_type")))
    return df.select(
        F.col("id").alias("observation_id"), _id(path("subject.reference")).alias("patient_id"), _id(path("encounter.reference")).alias("encounter_id"),
        F.coalesce(_ts("effectiveDateTime"), _ts("effectivePeriod.start"), _ts("issued")).alias("observation_datetime"),
        path("code.coding[0].code").alias("observation_code"), path("code.coding[0].system").alias("observation_code_system"),
        path("code.coding[0].display").alias("observation_code_display"), path("category[0].coding[0].code").alias("observation_category"),
        F.col("status").alias("observation_status"), F.col("valueString").alias("observation_value_string"), q["value"].alias("observation_value_numeric"),
        q["unit"].alias("observation_value_unit"), path("valueCodeableConcept.coding[0].code").alias("observation_value_coded"),
        F.col("valueBoolean").alias("observation_value_boolean"), path("interpretation[0].coding[0].code").alias("observation_interpretation"),
        rng["low"]["value"].alias("reference_range_low"), rng["high"]["value"].alias("reference_range_high"), rng["text"].alias("reference_range_text"),
        performer["id"].alias("performer_id"), path("performer[0].display").alias("performer_name"), performer["type"].alias("performer_type"),
        _id(path("device.reference")).alias("device_id"), path("device.display").alias("device_name"), path("note[0].text").alias("note"),
        F.coalesce(related, F.array().cast(_RELATED)).alias("related_observations"), *_lineage(source_system))


# --- row outputs ------------------------------------------------------------------------------------


def _blank(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def _yes(cond: Column) -> Column:
    return F.when(F.coalesce(cond, F.lit(False)), "yes").otherwise("no")


def demographics_row(df: DataFrame, as_of: str) -> DataFrame:
    """R12 (C01, C11-C13, C24): demographics with blanks for missing values and has_* flags."""
    name, home = _pick(F.col("name"), "official"), _pick(F.col("address"), "home")
    exts = F.col("extension")
    birth = S.birth_date(F.col("birthDate"), S.extension_first(exts, "birthDate"))
    gender = S.gender_norm(F.col("gender"), S.extension_first(exts, "gender"), path("communication[0].language.text"))
    phone, email = path("telecom[?system='phone'].value"), path("telecom[?system='email'].value")
    mobile = F.get(F.filter("telecom", lambda x: (x["system"] == "phone") & (x["use"] == "mobile")), F.lit(0))["value"]
    home_phone = F.get(F.filter("telecom", lambda x: (x["system"] == "phone") & (x["use"] == "home")), F.lit(0))["value"]
    return df.select(
        F.col("id").alias("patient_id"), _yes(F.col("active")).alias("active"), _blank(birth).alias("birth_date"),
        _blank(S.age_years(birth.try_cast("date"), F.lit(as_of).cast("date"))).alias("age"), _blank(gender).alias("gender"),
        _blank(S.preferred_language(F.col("communication"))).alias("language"), _blank(_race_text("us-core-ethnicity")).alias("ethnicity"),
        _blank(F.coalesce(_race_text("us-core-race"), S.extension_child(exts, codes.RACE_URL, "ombCategory"))).alias("race"),
        _blank(name["family"]).alias("name_family"), _blank(F.array_join(name["given"], " ")).alias("name_given"),
        _blank(F.get(name["given"], F.lit(0))).alias("name_first"), _blank(F.get(name["given"], F.lit(1))).alias("name_middle"),
        _blank(F.array_join(name["prefix"], " ")).alias("name_prefix"), _blank(F.array_join(name["suffix"], " ")).alias("name_suffix"),
        _blank(F.array_join(home["line"], ", ")).alias("address_line"), _blank(home["city"]).alias("address_city"), _blank(home["state"]).alias("address_state"),
        _blank(home["postalCode"]).alias("address_postal_code"), _blank(home["country"]).alias("address_country"), _blank(home_phone).alias("phone_home"),
        _blank(mobile).alias("phone_mobile"), _blank(phone).alias("phone"), _blank(email).alias("email"), _yes(birth.isNotNull()).alias("has_birth_date"),
        _yes(gender.isNotNull()).alias("has_gender"), _yes(F.size("address") > 0).alias("has_address"), _yes(phone.isNotNull() | email.isNotNull()).alias("has_contact"))


def observation_row(df: DataFrame) -> DataFrame:
    """R13 (C14, C21-C23, C41): value, range text, joined categories and interpretation."""
    rng = F.get(F.col("referenceRange"), F.lit(0))
    parts = S.value_parts()
    return df.select(
        F.col("id").alias("observation_id"), _blank(S.last_segment(path("subject.reference"))).alias("patient_id"), _blank(S.concept_display(F.col("code"))).alias("code"),
        _blank(path("code.coding[0].system")).alias("code_system"), _blank(path("code.coding[0].code")).alias("code_value"), _blank(F.col("status")).alias("status"),
        _blank(F.coalesce("effectiveDateTime", path("effectivePeriod.start"))).alias("effective_date"), _blank(F.col("issued")).alias("issued_date"),
        _blank(parts["value"]).alias("value"), _blank(parts["unit"]).alias("value_unit"), _blank(S.value_type()).alias("value_type"),
        _blank(parts["display"]).alias("display_text"), _blank(S.concept_display(F.get("interpretation", F.lit(0)))).alias("interpretation"),
        F.coalesce(F.array_join(F.transform("category", S.concept_display), "; "), F.lit("")).alias("category"),
        _blank(F.coalesce(rng["text"], S.range_text(rng))).alias("reference_range"))


def generic_row(df: DataFrame, kind: str) -> DataFrame:
    """Id, type, patient, first date of five and the raw JSON, for types without their own layout."""
    dates = [c for c in ("issued", "date", "recordedDate", "authoredOn", "recorded") if c in df.columns]
    return df.select("id", F.lit(kind).alias("resource_type"), S.last_segment(path("subject.reference")).alias("patient_id"),
                     F.coalesce(*dates, F.lit(None).cast("string")).alias("date"), F.to_json(F.struct("*")).alias("raw_json"))


def encounter_csv_row(df: DataFrame) -> DataFrame:
    """Encounter layout with its length in hours."""
    start, end = _ts("period.start"), _ts("period.end")
    return df.select("id", S.last_segment(path("subject.reference")).alias("patient_id"), "status", path("class.code").alias("class"),
                     path("type[0].coding[0].code").alias("type"), path("period.start").alias("start_date"), path("period.end").alias("end_date"),
                     S.stay_hours(start, end).alias("length"), path("serviceProvider.reference").alias("service_type"),
                     path("reasonCode[0].coding[0].display").alias("reason"))


def slim(flat: DataFrame, columns: dict[str, str], patient_ref: str | None = None) -> DataFrame:
    """Slim gold from already flat columns; only those present are kept."""
    cols = [F.col(f"`{src}`").alias(dst) for dst, src in columns.items() if src in flat.columns]
    if patient_ref and patient_ref in flat.columns:
        cols.append(F.regexp_extract(F.col(f"`{patient_ref}`"), "Patient/(.+)", 1).alias("patient_id"))
    return flat.select(*cols)


def patient_post(flat: DataFrame, as_of: str) -> DataFrame:
    """R18 (C01, C03, C28, C40, D16): summary text when empty, phone digits, age and age group."""
    age = S.age_years(F.col("birth_date").cast("date"), F.lit(as_of).cast("date"))
    summary = F.coalesce(S.blank_to_null(F.col("patient_summary_text")),
                         S.blank_to_null(S.patient_sentence(F.col("name_text"), F.col("birth_date"), F.col("gender"))))
    return flat.withColumns({"patient_summary_text": summary, "phone": S.digits(F.col("phone")), "age_years": age, "age_group": S.age_group3(age)})


def with_lineage(df: DataFrame, run_time: str, source: str) -> DataFrame:
    """Source path, processing and ingestion time, source name; needs a frame read from files."""
    return df.withColumns({"_source_path": F.col("_metadata.file_path"), "_processing_time": F.lit(run_time).cast("timestamp"),
                           "_ingestion_timestamp": F.col("_metadata.file_modification_time"), "_source": F.lit(source)})
