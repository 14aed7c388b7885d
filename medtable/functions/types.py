"""Declared read schemas (DDL) of the nested record types."""

CODING = "STRUCT<system:STRING,code:STRING,display:STRING>"
CONCEPT = f"STRUCT<coding:ARRAY<{CODING}>,text:STRING>"
REF = "STRUCT<reference:STRING,display:STRING>"
QUANTITY = "STRUCT<value:DOUBLE,unit:STRING,system:STRING,code:STRING>"
PERIOD = "STRUCT<start:STRING,end:STRING>"
META = (f"STRUCT<versionId:STRING,lastUpdated:STRING,profile:ARRAY<STRING>,tag:ARRAY<{CODING}>,"
        f"security:ARRAY<{CODING}>>")
TEXT = "STRUCT<status:STRING,div:STRING>"
_EXT = (f"url:STRING,valueString:STRING,valueCode:STRING,valueDate:STRING,valueDateTime:STRING,"
        f"valueCoding:{CODING},valueCodeableConcept:{CONCEPT}")
EXT1 = f"STRUCT<{_EXT}>"
EXTENSION = f"STRUCT<{_EXT},extension:ARRAY<{EXT1}>>"
COMMON = f"resourceType STRING, id STRING, meta {META}, text {TEXT}"

NAME = "STRUCT<use:STRING,family:STRING,given:ARRAY<STRING>,text:STRING,prefix:ARRAY<STRING>,suffix:ARRAY<STRING>>"
IDENTIFIER = f"STRUCT<system:STRING,value:STRING,type:{CONCEPT}>"
TELECOM = "STRUCT<system:STRING,value:STRING,use:STRING>"
ADDRESS = "STRUCT<use:STRING,text:STRING,line:ARRAY<STRING>,city:STRING,state:STRING,postalCode:STRING,country:STRING>"

# One entry per record type. Every field an operator may fill or repair is listed, because
# withField can only replace what the struct already has.
SCHEMAS = {
    "Patient": f"""{COMMON}, active BOOLEAN, gender STRING, birthDate STRING,
        name ARRAY<STRUCT<use:STRING,family:STRING,given:ARRAY<STRING>,text:STRING,prefix:ARRAY<STRING>,
            suffix:ARRAY<STRING>>>,
        identifier ARRAY<STRUCT<system:STRING,value:STRING,type:{CONCEPT}>>,
        telecom ARRAY<STRUCT<system:STRING,value:STRING,use:STRING>>,
        address ARRAY<STRUCT<use:STRING,text:STRING,line:ARRAY<STRING>,city:STRING,state:STRING,
            postalCode:STRING,country:STRING>>,
        maritalStatus {CONCEPT}, communication ARRAY<STRUCT<language:{CONCEPT},preferred:BOOLEAN>>,
        generalPractitioner ARRAY<{REF}>, deceasedBoolean BOOLEAN, deceasedDateTime STRING,
        extension ARRAY<{EXTENSION}>, _gender STRUCT<extension:ARRAY<{EXT1}>>,
        _birthDate STRUCT<extension:ARRAY<{EXT1}>>""",
    "Observation": f"""{COMMON}, status STRING, category ARRAY<{CONCEPT}>, code {CONCEPT}, subject {REF},
        encounter {REF}, effectiveDateTime STRING, effectivePeriod {PERIOD}, issued STRING,
        valueQuantity {QUANTITY}, valueString STRING, valueBoolean BOOLEAN, valueInteger INT,
        valueDateTime STRING, valueCodeableConcept {CONCEPT}, valuePeriod {PERIOD}, valueReference {REF},
        interpretation ARRAY<{CONCEPT}>,
        referenceRange ARRAY<STRUCT<low:{QUANTITY},high:{QUANTITY},text:STRING>>,
        component ARRAY<STRUCT<code:{CONCEPT},valueQuantity:{QUANTITY},valueString:STRING,
            valueCodeableConcept:{CONCEPT},valueBoolean:BOOLEAN>>,
        performer ARRAY<{REF}>, device {REF}, note ARRAY<STRUCT<text:STRING>>, dataAbsentReason {CONCEPT},
        related ARRAY<STRUCT<type:STRING,target:{REF}>>""",
    "Encounter": f"""{COMMON}, status STRING, class {CODING}, type ARRAY<{CONCEPT}>, serviceType {CONCEPT},
        priority {CONCEPT}, subject {REF}, period {PERIOD},
        participant ARRAY<STRUCT<type:ARRAY<{CONCEPT}>,individual:{REF}>>, reasonCode ARRAY<{CONCEPT}>,
        diagnosis ARRAY<STRUCT<condition:{REF},use:{CONCEPT},rank:INT>>,
        location ARRAY<STRUCT<location:{REF}>>, serviceProvider {REF}, partOf {REF},
        hospitalization STRUCT<admitSource:{CONCEPT},dischargeDisposition:{CONCEPT}>""",
    "Condition": f"""{COMMON}, clinicalStatus {CONCEPT}, verificationStatus {CONCEPT}, severity {CONCEPT},
        code {CONCEPT}, category ARRAY<{CONCEPT}>, subject {REF}, encounter {REF}, recorder {REF},
        onsetDateTime STRING, onsetPeriod {PERIOD}, recordedDate STRING, abatementDateTime STRING""",
    "MedicationRequest": f"""{COMMON}, status STRING, intent STRING, priority STRING,
        medicationCodeableConcept {CONCEPT}, medicationReference {REF}, subject {REF}, encounter {REF},
        requester {REF}, authoredOn STRING,
        dosageInstruction ARRAY<STRUCT<text:STRING,route:{CONCEPT},
            timing:STRUCT<code:{CONCEPT},repeat:STRUCT<frequency:INT,period:DOUBLE,periodUnit:STRING>>,
            doseAndRate:ARRAY<STRUCT<doseQuantity:{QUANTITY}>>>>,
        reasonCode ARRAY<{CONCEPT}>""",
    "DiagnosticReport": f"""{COMMON}, status STRING, category ARRAY<{CONCEPT}>, code {CONCEPT}, subject {REF},
        encounter {REF}, issued STRING, effectiveDateTime STRING, effectivePeriod {PERIOD}, conclusion STRING,
        result ARRAY<{REF}>, imagingStudy ARRAY<{REF}>,
        presentedForm ARRAY<STRUCT<contentType:STRING,data:STRING>>, performer ARRAY<{REF}>""",
    "AllergyIntolerance": f"""{COMMON}, clinicalStatus {CONCEPT}, verificationStatus {CONCEPT}, type STRING,
        category ARRAY<STRING>, criticality STRING, code {CONCEPT}, patient {REF}, encounter {REF},
        onsetDateTime STRING, recordedDate STRING, recorder {REF}, asserter {REF},
        reaction ARRAY<STRUCT<substance:{CONCEPT},manifestation:ARRAY<{CONCEPT}>,severity:STRING,onset:STRING>>""",
    "Procedure": f"""{COMMON}, status STRING, category {CONCEPT}, code {CONCEPT}, subject {REF}, encounter {REF},
        performedDateTime STRING, performedPeriod {PERIOD}, performer ARRAY<STRUCT<function:{CONCEPT},actor:{REF}>>,
        location {REF}, reasonCode ARRAY<{CONCEPT}>, bodySite ARRAY<{CONCEPT}>, outcome {CONCEPT}""",
    "Immunization": f"""{COMMON}, status STRING, vaccineCode {CONCEPT}, patient {REF}, encounter {REF},
        occurrenceDateTime STRING, primarySource BOOLEAN, lotNumber STRING, site {CONCEPT}, route {CONCEPT},
        doseQuantity {QUANTITY}, performer ARRAY<STRUCT<actor:{REF}>>""",
    "DocumentReference": f"""{COMMON}, status STRING, type {CONCEPT}, category ARRAY<{CONCEPT}>, subject {REF},
        date STRING, author ARRAY<{REF}>, description STRING,
        content ARRAY<STRUCT<attachment:STRUCT<contentType:STRING,data:STRING,url:STRING,title:STRING>>>,
        context STRUCT<encounter:ARRAY<{REF}>,period:{PERIOD}>""",
    "CarePlan": f"""{COMMON}, status STRING, intent STRING, title STRING, description STRING,
        category ARRAY<{CONCEPT}>, subject {REF}, encounter {REF}, period {PERIOD}, created STRING, author {REF},
        activity ARRAY<STRUCT<detail:STRUCT<status:STRING,code:{CONCEPT},description:STRING>>>, goal ARRAY<{REF}>""",
    "RelatedPerson": f"""{COMMON}, active BOOLEAN, patient {REF}, relationship ARRAY<{CONCEPT}>, name ARRAY<{NAME}>,
        telecom ARRAY<{TELECOM}>, gender STRING, birthDate STRING, address ARRAY<{ADDRESS}>""",
    "Practitioner": f"""{COMMON}, active BOOLEAN, identifier ARRAY<{IDENTIFIER}>, name ARRAY<{NAME}>,
        telecom ARRAY<{TELECOM}>, gender STRING, birthDate STRING, address ARRAY<{ADDRESS}>,
        qualification ARRAY<STRUCT<code:{CONCEPT},issuer:{REF}>>""",
    "Organization": f"""{COMMON}, active BOOLEAN, identifier ARRAY<{IDENTIFIER}>, type ARRAY<{CONCEPT}>, name STRING,
        telecom ARRAY<{TELECOM}>, address ARRAY<{ADDRESS}>, partOf {REF}""",
}
