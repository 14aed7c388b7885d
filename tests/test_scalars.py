import datetime as dt

from pyspark.sql import functions as F

from medtable.functions import scalars as S
from medtable.operators import repair as E


def lit(x, t="string"):
    return F.lit(x).cast(t)


def test_ages(one):
    day, now = lit("2000-06-15", "date"), lit("2020-06-14", "date")
    out = one(a=S.age_years(day, now), y=S.age_by_year(day, now), d=S.age_by_days(day, now), g=S.age_group3(lit(None, "int")), h=S.age_group5(lit(None, "int")), k=S.age_group5(F.lit(17)), s=S.age_group3(F.lit(65)))
    assert out == {"a": 19, "y": 20, "d": 20, "g": "unknown", "h": "Unknown", "k": "Under 18", "s": "senior"}  # D16: no age is unknown


def test_stay(one):
    """Seconds over 3600; hours keep their fraction, days have one decimal."""
    a, b = lit("2020-01-01 00:00:00", "timestamp"), lit("2020-01-03 07:20:00", "timestamp")
    out = one(h=S.stay_hours(a, b), d=S.stay_days(S.stay_hours(a, b)), m=S.stay_minutes(a, b))
    assert round(out["h"], 4) == 55.3333 and out["d"] == 2.3 and out["m"] == 3320.0


def test_long_stay(one):
    out = one(a=S.is_long_stay(F.lit("inpatient"), F.lit(200.0), F.lit(8.3)), b=S.is_long_stay(F.lit("emergency"), F.lit(24.0), F.lit(1.0)), c=S.is_long_stay(F.lit("other"), lit(None, "double"), lit(None, "double")),
              d=S.is_long_stay(F.lit("inpatient"), lit(None, "double"), lit(None, "double")))
    assert out == {"a": True, "b": False, "c": False, "d": None}


def test_datetimes(one):
    cases = {"y": "2020", "m": "2020-05", "d": "2020-05-06", "z": "2020-05-06T01:02:03.999Z", "o": "2020-05-06T01:02:03+02:00", "bad": "May", "worse": "2020-13-45"}
    out = one(**{k: S.parse_datetime(F.lit(v)) for k, v in cases.items()})
    assert out == {"y": dt.datetime(2020, 1, 1), "m": dt.datetime(2020, 5, 1), "d": dt.datetime(2020, 5, 6), "z": dt.datetime(2020, 5, 6, 1, 2, 3), "o": dt.datetime(2020, 5, 5, 23, 2, 3), "bad": None, "worse": None}


def test_date_fixes(one):
    cases = {"a": "12/25/2020", "b": "25-12-2020", "c": "2020/12/25", "d": "20201225", "e": "2020-12-25T00:00:00Z", "f": "25/12/2020", "g": "2020-12-25", "h": "later", "i": "3/4/2020", "j": "2020-12-25T10:00:00Z"}
    out = one(**{k: E.fix_datetime(F.lit(v)) for k, v in cases.items()})
    day = "2020-12-25"
    assert out == {"a": day, "b": day, "c": day, "d": day, "e": day, "f": day, "g": day, "h": "later", "i": "2020-03-04", "j": "2020-12-25T10:00:00+00:00"}


def test_references(one):
    """The id never keeps the slash."""
    def parts(x):
        return S.reference_parts(F.lit(x))
    out = one(a=parts("Practitioner/123")["id"], t=parts("https://h.org/Patient/9")["type"], u=parts("https://h.org/r4/Patient/9"), b=parts("123"), l=S.last_segment(F.lit("a/b/c")), n=parts("a/b/c"))
    assert out == {"a": "123", "t": "Patient", "u": None, "b": None, "l": "c", "n": None}


def test_fix_reference(one):
    uuid = "123e4567-e89b-12d3-a456-426614174000"
    out = one(a=E.fix_reference(F.lit(uuid)), b=E.fix_reference(F.lit("Patient12")), c=E.fix_reference(F.lit("Patient/12")), d=E.fix_reference(F.lit("??")))
    assert out == {"a": f"Patient/{uuid}", "b": "Patient/12", "c": "Patient/12", "d": "??"}


def test_terms_and_gender(one):
    none = lit(None)
    out = one(a=S.normalise_term(F.lit(" MEDIUM ")), b=S.normalise_term(F.lit("odd")), c=S.gender_norm(F.lit("F")), d=S.gender_norm(none), e=S.gender_norm(F.lit("zz"), F.lit("male")),
              f=S.gender_norm(none, none, F.lit("female")), g=S.gender_norm(none, none, F.lit("en")))
    assert out == {"a": "moderate", "b": "odd", "c": "female", "d": None, "e": "male", "f": "female", "g": None}


def test_masks(one):
    out = one(a=S.mask_pii(F.lit("ssn 123-45-6789 mail a.b@c.org phone 555-123-4567 card 1234 5678 9012 3456")))
    assert out["a"] == "ssn XXX-XX-XXXX mail EMAIL@MASKED phone PHONE-MASKED card XXXX-XXXX-XXXX-XXXX"


def test_thresholds(one):
    def c(op, v, lo, hi=None):
        return S.crosses(F.lit(op), F.lit(v), F.lit(lo), None if hi is None else F.lit(hi))
    out = one(a=c("lt", 1.0, 2.0), b=c("gte", 2.0, 2.0), c=c("eq", 1.00005, 1.0), d=c("between", 2.0, 1.0, 2.0), e=c("between_excl", 2.0, 1.0, 2.0), f=c("not_between", 3.0, 1.0, 2.0), g=c("?", 1.0, 1.0))
    assert out == {"a": True, "b": True, "c": True, "d": True, "e": False, "f": True, "g": False}


def test_phrase(one):
    def p(*x):
        return S.list_phrase(F.array(*[F.lit(i) for i in x]), "of ", "including ")
    assert one(a=p("a", "b"), b=p("a", "b", "c", "d", "e")) == {"a": "of a, b", "b": "including a, b, c and 2 more"}


def test_bp_and_category(one):
    out = one(a=S.bp_category(F.lit(140), F.lit(70)), b=S.bp_category(F.lit(90), F.lit(70)), c=S.bp_category(F.lit(120), F.lit(80)), d=S.issue_category(F.lit("Unknown TARGET")), e=S.issue_category(F.lit("hm")))
    assert out == {"a": "High", "b": "Low", "c": "Normal", "d": "reference", "e": "unknown"}


def test_attachment(one):
    assert one(a=S.attachment_text(F.lit("SGVsbG8=")), b=S.attachment_text(F.lit("%%%"))) == {"a": "Hello", "b": None}
