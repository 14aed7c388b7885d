"""Mapping specs (P06-P14, P21-P23): a dict of target -> rule becomes one ``select``."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions import types, walk
from ..functions.paths import first_of, path, strip_tags

_CALL = re.compile(r"^(.*)\.(replace|substring|first|toString|exists)\((.*)\)$")


def rule(text: str | Column, root: Column | None = None) -> Column:
    """P07, P21, D-U1, D-U2, D-U3: one mapping rule as a Column.

    Forms: a path, ``a | b`` (first non-null), ``"literal"``, ``path.replace('x','y')``, ``.substring(n)``,
    ``.first()``, ``.toString()``, ``.exists()`` and ``{{path}} text`` templates. ``text.div`` loses its markup.
    """
    if isinstance(text, Column):
        return text
    text = text.strip()
    if "{{" in text:
        pieces = re.split(r"\{\{(.+?)\}\}", text)
        return F.concat(*[rule(p, root).cast("string") if i % 2 else F.lit(p) for i, p in enumerate(pieces)])
    if " | " in text:
        return F.coalesce(*[rule(t, root).cast("string") for t in text.split(" | ")])
    if text.startswith('"') and text.endswith('"'):
        return F.lit(text[1:-1])
    call = _CALL.match(text)
    if call:
        inner, name, args = call.groups()
        col = rule(inner, root)
        if name == "replace":
            old, new = re.findall(r"'([^']*)'", args)
            return F.replace(col, F.lit(old), F.lit(new))
        if name == "substring":
            return F.substring(col, int(args) + 1, 2**31 - 1)
        if name == "first":
            return F.get(col, F.lit(0))
        return col.isNotNull() if name == "exists" else col.cast("string")
    col = path(text, root)
    return strip_tags(col) if text.endswith("text.div") else col


def apply_spec(df: DataFrame, spec: dict[str, str | Column], keep: Sequence[str] = ()) -> DataFrame:
    """Project the targets in one select; ``keep`` names source columns to carry (``*`` for all)."""
    return df.select(*keep, *[rule(r).alias(t) for t, r in spec.items()])


def map_fields(df: DataFrame, expressions: dict[str, str], fields: dict[str, tuple[str, object]], kind: str, key: str = "id") -> DataFrame:
    """SQL expressions and fields with defaults, plus the row key ``_hash_id``."""
    cols = [F.expr(e).alias(t) for t, e in expressions.items()]
    cols += [F.coalesce(rule(src), F.lit(default)).alias(t) for t, (src, default) in fields.items()]
    return df.select(*cols, S.row_key(F.lit(kind), F.col(key)).alias("_hash_id"))


def parse_raw(df: DataFrame, kind: str, spec: dict[str, str | Column] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """P21, J07, D-U4: typed parse of ``json_data``, then the spec, with the ingest columns carried in the same select."""
    parsed = df.select(*keep, F.from_json("json_data", types.SCHEMAS[kind]).alias("_r")).select(*keep, "_r.*")
    return parsed if spec is None else apply_spec(parsed, spec, keep)


def extract_dataset(df: DataFrame, columns: dict[str, str | Column], where: Column | None = None) -> DataFrame:
    """Filtered tabular extract."""
    return apply_spec(df if where is None else df.where(where), columns)


def flat_dataset(index: DataFrame, key: str, columns: Sequence[tuple[str, DataFrame, str, str, object]]) -> DataFrame:
    """One column per (name, frame, path, order column, default), newest value per index key.

    Each source is reduced to one row per key before it meets the index.
    """
    out = index.select(key)
    for name, df, source, order, default in columns:
        value = rule(source)
        side = df.where(value.isNotNull()).groupBy(key).agg(F.max_by(value, F.struct(F.col(order), value)).alias(name))
        out = out.join(side, key, "left").withColumn(name, F.coalesce(F.col(name), F.lit(default)))
    return out


def transform_template(df: DataFrame, spec: dict[str, str | Column], pre: Callable[[DataFrame], DataFrame] | None = None,
                       post: Callable[[DataFrame], DataFrame] | None = None) -> tuple[DataFrame, Observation, Observation]:
    """Pre hook, mapping, post hook; row counts are observed while the result is computed."""
    seen, kept = Observation("rows_in"), Observation("rows_out")
    rows = df.observe(seen, F.count(F.lit(1)).alias("n"))
    rows = pre(rows) if pre else rows
    rows = apply_spec(rows, spec)
    rows = post(rows) if post else rows
    return rows.observe(kept, F.count(F.lit(1)).alias("n")), seen, kept


def check_loss(seen: Observation, kept: Observation, limit: float = 0.05, strict_empty: bool = False) -> float:
    """Q32: after the write, raise when more than ``limit`` of the rows were lost, or on empty input in strict mode."""
    n_in, n_out = seen.get["n"], kept.get["n"]
    if n_in == 0:
        if strict_empty:
            raise ValueError("no input rows")
        return 0.0
    loss = (n_in - n_out) / n_in
    if loss > limit:
        raise ValueError(f"lost {loss:.1%} of {n_in} rows")
    return loss


def union_drifting(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of frames whose columns, and the fields inside them, are added, left out or widened."""
    wanted = reduce(walk.widest, [p.schema for p in parts])
    return reduce(DataFrame.unionByName, [p.select(*_conformed(p.schema, wanted)) for p in parts])


def _conformed(have: T.StructType, want: T.StructType) -> list[Column]:
    own = {f.name: f.dataType for f in have.fields}
    return [(walk.conform(F.col(f"`{f.name}`"), own[f.name], f.dataType) if f.name in own else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]


_SUBJECT = "subject.reference.replace('Patient/','')"
_ENCOUNTER = "encounter.reference.replace('Encounter/','')"

# Flatten specs of six record types. Targets and source paths.
FLATTEN: dict[str, dict[str, str | Column]] = {
    "Patient": {
        "patient_id": "id", "birth_date": "birthDate", "gender": "gender", "name_family": "name[0].family", "name_given": "name[0].given[0]",
        "name_text": "name[0].text | name[0].family", "email": "telecom[?system='email'].value", "phone": "telecom[?system='phone'].value",
        "address_line": "address[0].line[0]", "address_city": "address[0].city", "address_state": "address[0].state",
        "address_postal_code": "address[0].postalCode", "address_country": "address[0].country",
        "marital_status_code": "maritalStatus.coding[0].code", "marital_status_text": "maritalStatus.text",
        "language": "communication[0].language.coding[0].code", "active": "active", "patient_summary_text": "text.div"},
    "Observation": {
        "observation_id": "id", "patient_id": _SUBJECT, "code_code": "code.coding[0].code", "code_system": "code.coding[0].system",
        "code_display": "code.coding[0].display", "code_text": "code.text", "issued_datetime": "issued",
        "effective_datetime": "effectiveDateTime | effectivePeriod.start", "status": "status", "value_quantity": "valueQuantity.value",
        "value_quantity_unit": "valueQuantity.unit", "value_quantity_code": "valueQuantity.code", "value_string": "valueString",
        "value_codeable_concept_text": "valueCodeableConcept.text", "value": "valueQuantity.value | valueString | valueCodeableConcept.text",
        "encounter_reference": "encounter.reference", "clinical_text": "text.div"},
    "Encounter": {
        "encounter_id": "id", "patient_id": _SUBJECT, "status": "status", "class_code": "class.code", "class_display": "class.display",
        "start_datetime": "period.start", "end_datetime": "period.end", "type_code": "type[0].coding[0].code", "type_display": "type[0].coding[0].display",
        "reason_code": "reasonCode[0].coding[0].code", "reason_display": "reasonCode[0].coding[0].display",
        "primary_performer": "participant[0].individual.reference", "location": "location[0].location.reference",
        "service_provider": "serviceProvider.reference", "admission_status": "hospitalization.admitSource.coding[0].code",
        "discharge_disposition": "hospitalization.dischargeDisposition.coding[0].code", "clinical_text": "text.div"},
    "Condition": {
        "condition_id": "id", "patient_id": _SUBJECT, "encounter_id": _ENCOUNTER, "clinical_status": "clinicalStatus.coding[0].code",
        "verification_status": "verificationStatus.coding[0].code", "code_code": "code.coding[0].code", "code_system": "code.coding[0].system",
        "code_display": "code.coding[0].display", "code_text": "code.text", "category_code": "category[0].coding[0].code",
        "category_display": "category[0].coding[0].display", "severity_code": "severity.coding[0].code",
        "severity_display": "severity.coding[0].display", "onset_datetime": "onsetDateTime", "onset_period_start": "onsetPeriod.start",
        "onset_period_end": "onsetPeriod.end", "recorded_date": "recordedDate", "abatement_datetime": "abatementDateTime",
        "recorder_id": "recorder.reference.replace('Practitioner/','')", "recorder_display": "recorder.display", "clinical_text": "text.div"},
    "MedicationRequest": {
        "medication_request_id": "id", "patient_id": _SUBJECT, "encounter_id": _ENCOUNTER, "status": "status", "intent": "intent",
        "priority": "priority", "medication_reference": "medicationReference.reference",
        "medication_id": "medicationReference.reference.replace('Medication/','')", "medication_code": "medicationCodeableConcept.coding[0].code",
        "medication_system": "medicationCodeableConcept.coding[0].system", "medication_display": "medicationCodeableConcept.coding[0].display",
        "medication_text": "medicationCodeableConcept.text", "dosage_text": "dosageInstruction[0].text",
        "dosage_route": "dosageInstruction[0].route.coding[0].display", "dosage_timing": "dosageInstruction[0].timing.code.text",
        "authored_datetime": "authoredOn", "requester_id": "requester.reference.replace('Practitioner/','')", "requester_display": "requester.display",
        "reason_code": "reasonCode[0].coding[0].code", "reason_display": "reasonCode[0].coding[0].display", "reason_text": "reasonCode[0].text",
        "clinical_text": "text.div"},
    "DiagnosticReport": {
        "report_id": "id", "patient_id": _SUBJECT, "encounter_id": _ENCOUNTER, "status": "status", "category_code": "category[0].coding[0].code",
        "category_system": "category[0].coding[0].system", "category_display": "category[0].coding[0].display", "code_code": "code.coding[0].code",
        "code_system": "code.coding[0].system", "code_display": "code.coding[0].display", "code_text": "code.text", "issued_datetime": "issued",
        "effective_datetime": "effectiveDateTime | effectivePeriod.start", "conclusion": "conclusion", "has_results": "result.exists()",
        "result_references": "result[*].reference", "imaging_study": "imagingStudy[0].reference",
        "performer_id": "performer[0].reference.replace('Practitioner/','')", "performer_display": "performer[0].display", "clinical_text": "text.div"},
}

# Extract spec of the raw observation. Fixed values.
OBSERVATION_EXTRACT: dict[str, str | Column] = {
    "id": "id", "status": "status", "patient_reference": "subject.reference", "patient_id": "subject.reference.substring(8)",
    "encounter_reference": "encounter.reference", "encounter_id": "encounter.reference.substring(10)",
    "effective_date_time": "effectiveDateTime.toString()", "effective_period_start": "effectivePeriod.start.toString()",
    "effective_period_end": "effectivePeriod.end.toString()", "issued_date": "issued.toString()", "code_system": "code.coding[0].system",
    "code": "code.coding[0].code", "code_display": "code.coding[0].display", "code_text": "code.text",
    "category_code": "category[0].coding[0].code", "category_display": "category[0].coding[0].display",
    "quantity_value": "valueQuantity.value", "quantity_unit": "valueQuantity.unit", "quantity_system": "valueQuantity.system",
    "quantity_code": "valueQuantity.code", "string_value": "valueString", "concept_code": "valueCodeableConcept.coding[0].code",
    "concept_display": "valueCodeableConcept.coding[0].display", "concept_text": "valueCodeableConcept.text", "boolean_value": "valueBoolean",
    "interpretation_code": "interpretation[0].coding[0].code", "interpretation_display": "interpretation[0].coding[0].display",
    "note": "note[0].text", "last_updated": "meta.lastUpdated.toString()",
}

# Fallback paths per (record type, field). Fixed values.
FALLBACKS: dict[tuple[str, str], list[str]] = {
    ("Patient", "name"): ["name[?use='official'].text", "name[?use='official'].family", "name[0].text", "name[0].family"],
    ("Patient", "birthDate"): ["birthDate"],
    ("Patient", "phone"): ["telecom[?use='home'].value", "telecom[?system='phone'].value"],
    ("Observation", "date"): ["effectiveDateTime", "effectivePeriod.start", "issued"],
    ("Observation", "value"): ["valueString", "valueCodeableConcept.text", "valueCodeableConcept.coding[0].display"],
    ("Encounter", "date"): ["period.start", "meta.lastUpdated"],
    ("Condition", "date"): ["recordedDate", "onsetDateTime", "onsetPeriod.start"],
    ("MedicationRequest", "medication"): ["medicationCodeableConcept.text", "medicationCodeableConcept.coding[0].display", "medicationReference.reference"],
}


def fallback(kind: str, field: str) -> Column:
    """First non-null of the declared fallback paths."""
    return first_of(*FALLBACKS[(kind, field)])
