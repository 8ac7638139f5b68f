"""Scalar functions as Column expressions: text parsing, units, kidney and geography formulas, dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

RUN = "[0-9]+(?:[.,]+[0-9]+)*"
MARK = "\x01"


def extract_number(text: Column) -> Column:
    """The number of a result text, or null.

    Every run of digits, with points and commas between them, is a number: commas group its digits, several points
    count as one, and what follows a second point is not read. The rest is decided on the text's shape, in which each
    number is one mark. Two numbers joined by a dash give their mean, longer chains (dates) null; a fraction is null;
    otherwise the first of up to three counts. A dash is a sign unless some dash stands between a letter and a number
    ("B-12" is 12); "neg" before an only number turns its sign.
    """
    shape = F.regexp_replace(text, RUN, MARK)
    runs = F.regexp_extract_all(text, F.lit(RUN), F.lit(0))
    sizes = F.transform(runs, lambda x: F.regexp_extract(F.regexp_replace(F.replace(x, F.lit(","), F.lit("")), r"\.+", "."), r"^[0-9]+(?:\.[0-9]+)?", 0).try_cast("double"))
    n, first, second = F.size(runs), F.get(sizes, 0), F.get(sizes, 1)
    after_letter = shape.rlike(f"[A-Za-z]-{MARK}")
    minus = ~after_letter & shape.rlike(f"^[^{MARK}]*-{MARK}")
    in_words = (n == 1) & shape.rlike(rf"(?i)neg(?:ative)?\s?{MARK}")
    signed = F.when(minus, 0.0 - first).otherwise(first)
    mean = F.when(n == 2, (signed + second) / 2)
    fraction = ~after_letter & shape.contains(f"{MARK}/{MARK}")
    return F.when(shape.contains(f"{MARK}-{MARK}"), mean).when(~fraction & n.between(1, 3), F.when(in_words, 0.0 - signed).otherwise(signed))


def extract_operator(text: Column) -> Column:
    """Comparison sign of a result text, or null."""
    op = F.regexp_extract(text, "([<>=≥≤]+)", 1)
    return F.when(op != "", op)


# Grades of semi-quantitative results, with common misspellings; first match wins.
GRADES = (
    ("Large", r"\blar[^sy]|\b3\+|\b4\+"),
    ("Moderate", r"\bmod[^y]|2\+"),
    ("Small", r"\bsm[^eiu]|\btr$|^trac[^hu]|1\+"),
    ("Normal", r"^norm|\bnml|noraml|nomral|\bnrom|\bnoremal|\bnomal|\bno\sabnorm"),
    ("Negative", r"\bneg|\bneeg|\sneg|\bnreg|\bnehgative|\bneagative|^nedg$|^neb$|^ned$|/bneative|n\se\sg\sa\st\si\sv\se|^\-$"),
    ("Positive", r"\bpositive|^\+$|^pos$"),
)
# Grades of numbers by kind of test, as (upper bound, bound included, grade); the last holds above all.
CUTS: dict[str, tuple[tuple[float, bool, str], ...]] = {
    "glucose_urine": ((499, True, "Small"), (1000, False, "Moderate"), (float("inf"), True, "Large")),
    "protein_urine": ((30, False, "Small"), (300, False, "Moderate"), (float("inf"), True, "Large")),
    "red_cells_urine": ((4, True, "Negative"), (30, True, "Small"), (50, True, "Moderate"), (float("inf"), True, "Large")),
}


def grade_text(text: Column) -> Column:
    low, out = F.lower(text), None
    for name, pattern in GRADES:
        out = F.when(low.rlike(pattern), name) if out is None else out.when(low.rlike(pattern), name)
    return out


def grade_number(value: Column, kind: str) -> Column:
    """Grade of a number by the cut-offs of its kind of test; null between them and without a number."""
    out = F.when(value.isNull(), None)
    # glucose between 499 and 500 belongs to no grade
    if kind == "glucose_urine":
        out = out.when((value > 499) & (value < 500), None)
    for bound, included, grade in CUTS[kind]:
        out = out.when(value <= bound if included else value < bound, grade)
    return out


def postal_code(text: Column, digits: int = 5) -> Column:
    """First five or nine digits of a postal code, or null."""
    plain = F.regexp_replace(text, "[^0-9]", "")
    return F.when(F.length(plain) >= digits, F.substring(plain, 1, digits))


def convert_unit(value: Column, unit: Column, factors: dict[str, float]) -> Column:
    """Value in the standard unit by a factor for each unit; units without one give null."""
    table = F.create_map(*(F.lit(x) for pair in factors.items() for x in pair))
    return value * F.try_element_at(table, F.lower(F.trim(unit)))


#: Amount types of unit parts with their multipliers.
MASS = {"kg": 1e3, "g": 1.0, "mg": 1e-3, "ug": 1e-6, "mcg": 1e-6, "ng": 1e-9, "pg": 1e-12}
MOLE = {"mol": 1.0, "mmol": 1e-3, "umol": 1e-6, "nmol": 1e-9, "pmol": 1e-12}
EQUIVALENT = {"eq": 1.0, "meq": 1e-3, "ueq": 1e-6}
VOLUME = {"l": 1.0, "dl": 1e-1, "ml": 1e-3, "ul": 1e-6, "fl": 1e-15}


def unit_ratio(unit: Column, target: str, molar_mass: Column | None = None, valence: Column | None = None) -> Column:
    """Factor from a unit such as mg/dL to another: numerators by mass, mole or equivalent, denominators by volume.

    Mass and mole convert by molar mass, equivalents by valence; null where the units do not convert.
    """
    table = lambda m: F.create_map(*(F.lit(x) for pair in m.items() for x in pair))
    parts = F.split(F.lower(F.regexp_replace(unit, r"\s", "")), "/")
    mass, valence = molar_mass if molar_mass is not None else F.lit(None).cast("double"), valence if valence is not None else F.lit(None).cast("double")
    moles = F.coalesce(F.try_element_at(table(MOLE), parts[0]), F.try_element_at(table(MASS), parts[0]) / mass, F.try_element_at(table(EQUIVALENT), parts[0]) / valence)
    grams = F.coalesce(F.try_element_at(table(MASS), parts[0]), F.try_element_at(table(MOLE), parts[0]) * mass, F.try_element_at(table(EQUIVALENT), parts[0]) / valence * mass)
    volume = F.try_element_at(table(VOLUME), F.try_element_at(parts, F.lit(2)))
    num, den = target.lower().split("/")
    top = grams / MASS[num] if num in MASS else moles / MOLE[num] if num in MOLE else moles * valence / EQUIVALENT[num]
    return top / (volume / VOLUME[den])


FAHRENHEIT = ("f", "°f", "degf", "deg f", "fahrenheit", "degree fahrenheit", "degrees fahrenheit")


def fahrenheit_to_celsius(value: Column, unit: Column) -> Column:
    return F.when(F.lower(F.trim(unit)).isin(*FAHRENHEIT), (value - 32) * 5 / 9).otherwise(value)


#: Lactate in mmol/L by this factor from mg/dL; what a unit is taken for by kind of test.
LACTATE = 0.111
SCORING_UNITS: dict[str, dict[str, str]] = {
    "creatinine": {"": "mg/dl", "mg/ml": "mg/dl"},
    "bilirubin": {"": "mg/dl"},
    "lactate": {"": "mg/dl"},
    "platelets": {"": "thousand/ul", "thousandth/ul": "thousand/ul", "10*/ul": "thousand/ul", "thousand/mm3": "thousand/ul"},
    "saturation": {"": "%", "% sat": "%"},
}


def scoring_lab(value: Column, unit: Column, kind: str) -> tuple[Column, Column]:
    """Value and unit of a laboratory result as scores read them: synonyms and likely slips mapped, lactate in mg/dL."""
    known = F.coalesce(F.lower(F.trim(unit)), F.lit(""))
    names = F.create_map(*(F.lit(x) for pair in SCORING_UNITS[kind].items() for x in pair))
    unified = F.coalesce(F.try_element_at(names, known), known)
    if kind != "lactate":
        return value, unified
    return F.when(unified == "mmol/l", value / LACTATE).otherwise(value), F.when(unified == "mmol/l", "mg/dl").otherwise(unified)


def red_cell_volume(value: Column, unit: Column) -> Column:
    """Millilitres of red cells: units of 250 ml, unless the unit is ml or, without a unit, the number is over ten."""
    millilitres = F.coalesce(F.lower(F.trim(unit)) == "ml", F.lit(False)) | (unit.isNull() & (value > 10))
    return F.when(millilitres, value).otherwise(value * 250)


def haversine_miles(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; Earth radius 6371.009 km, 1.609 km a mile."""
    a = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * 6371.009 / 1.609 * F.asin(F.least(F.lit(1.0), F.sqrt(a)))


def egfr_2021(creatinine: Column, age: Column, female: Column) -> Column:
    """Estimated filtration rate, 2021 equation without race."""
    k, a = F.when(female, 0.7).otherwise(0.9), F.when(female, -0.241).otherwise(-0.302)
    r = creatinine / k
    return 142 * F.pow(F.least(r, F.lit(1.0)), a) * F.pow(F.greatest(r, F.lit(1.0)), F.lit(-1.2)) * F.pow(F.lit(0.9938), age) * F.when(female, 1.012).otherwise(1.0)


def egfr_2009(creatinine: Column, age: Column, female: Column, black: Column) -> Column:
    """Estimated filtration rate, 2009 equation."""
    k, a = F.when(female, 0.7).otherwise(0.9), F.when(female, -0.329).otherwise(-0.411)
    r = creatinine / k
    return 141 * F.pow(F.least(r, F.lit(1.0)), a) * F.pow(F.greatest(r, F.lit(1.0)), F.lit(-1.209)) * F.pow(F.lit(0.993), age) * F.when(female, 1.018).otherwise(1.0) * F.when(black, 1.159).otherwise(1.0)


def baseline_creatinine(age: Column, female: Column, rate: float = 75.0) -> Column:
    """Creatinine at which the 2021 equation gives ``rate`` (on its branch above the threshold)."""
    k = F.when(female, 0.7).otherwise(0.9)
    return k * F.pow(rate / (142 * F.pow(F.lit(0.9938), age) * F.when(female, 1.012).otherwise(1.0)), F.lit(-1 / 1.2))


def kinetic_egfr(baseline: Column, rate: Column, before: Column, after: Column, hours: Column, most_rise: float = 1.5) -> Column:
    """Filtration rate while creatinine changes: baseline clearance, corrected for the change a day."""
    mean = (before + after) / 2
    return baseline * rate / mean * (1 - 24 * (after - before) / (hours * most_rise))


def dose_per_kg_minute(amount_mg: Column, weight: Column, minutes: Column) -> Column:
    """Micrograms per kilogram and minute; at least a minute."""
    return amount_mg * 1000 / weight / F.greatest(minutes, F.lit(1.0))


def creatinine_fallback(age: Column, female: Column) -> Column:
    return 0.74 - F.when(female, 0.2).otherwise(0.0) + 0.003 * age


def pf_ratio(pao2: Column, fio2: Column) -> Column:
    return pao2 / (F.coalesce(fio2, F.lit(21.0)) / 100)


def sf_ratio(spo2: Column, fio2: Column) -> Column:
    return (spo2 / (F.coalesce(fio2, F.lit(21.0)) / 100) - 64) / 0.84


def age_years(birth: Column, at: Column, exact: bool = False) -> Column:
    """Whole years, or years of 365.2425 days."""
    return F.datediff(at, birth) / 365.2425 if exact else F.floor(F.months_between(F.to_date(at), F.to_date(birth)) / 12)


def bmi(kg: Column, cm: Column) -> Column:
    return kg / F.pow(cm / 100, F.lit(2))


def night(at: Column) -> Column:
    return ((F.hour(at) < 7) | (F.hour(at) > 18)).cast("int")


def datediff_boundary(unit: str, start: Column, end: Column) -> Column:
    """How many boundaries of a unit lie between two times (not the elapsed time)."""
    if unit == "year":
        return F.year(end) - F.year(start)
    if unit == "month":
        return (F.year(end) - F.year(start)) * 12 + F.month(end) - F.month(start)
    if unit == "day":
        return F.datediff(end, start)
    seconds = {"hour": 3600, "minute": 60, "second": 1}[unit]
    return ((F.unix_seconds(F.date_trunc(unit, end)) - F.unix_seconds(F.date_trunc(unit, start))) / seconds).cast("long")


def nearest_second(at: Column) -> Column:
    """Seconds since 1970, rounded to the nearest; half a second goes to the even one."""
    return F.rint(F.unix_micros(at) / 1e6).cast("long")


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole elapsed units."""
    micros = {"day": 86_400_000_000, "hour": 3_600_000_000, "minute": 60_000_000}[unit]
    return F.floor((F.unix_micros(end) - F.unix_micros(start)) / micros)


def ladder(value: Column, name: str, steps: range) -> list[Column]:
    """Flags <name>_<k>_plus: value at least k."""
    return [F.coalesce((value >= k).cast("int"), F.lit(0)).alias(f"{name}_{k}_plus") for k in steps]


# Where a discharge text leads, first match wins.
PLACES = (("dead", "expired|death|died"), ("hospice", "hospice"), ("home", "home"), ("facility", "nursing|rehab|skilled|facility|hospital"), ("against advice", "against"))


def discharge_place(text: Column) -> Column:
    low, out = F.lower(text), F.when(text.isNull(), None)
    for name, pattern in PLACES:
        out = out.when(low.rlike(pattern), name)
    return out.otherwise("other")
