"""Normalising columns: dates, numbers, currency tokens, governing law."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from clauselens.functions import vocab as V
from clauselens.functions.text import any_of, fold_latin, let, squeeze

_YMD = r"^([0-9]{4})[/-]([0-9]{1,2})[/-]([0-9]{1,2})\z"
_AB_Y = r"^([0-9]{1,2})[/-]([0-9]{1,2})[/-]([0-9]{4})\z"
_D_MONTH_Y = r"^([0-9]{1,2})\s+([A-Za-zÀ-ÿ]+)\s+([0-9]{4})\z"
_MONTH_D_Y = r"^([A-Za-zÀ-ÿ]+)\s+([0-9]{1,2}),?\s+([0-9]{4})\z"


def _iso(parts: Column) -> Column:
    """``yyyy-MM-dd`` of (y, m, d) strings when they form a real date, else null."""
    text = F.concat(
        F.lpad(parts["y"], 4, "0"), F.lit("-"), F.lpad(parts["m"], 2, "0"), F.lit("-"), F.lpad(parts["d"], 2, "0"))
    return let(text, lambda t: F.when((t >= "0001") & t.try_cast("date").isNotNull(), t))


def _month_number(name: Column) -> Column:
    months = F.create_map(*[F.lit(x) for pair in V.MONTHS.items() for x in pair])
    return F.try_element_at(months, fold_latin(name)).cast("string")


def parse_date(raw: Column) -> Column:
    """ISO date string from common English and French spellings, else null."""

    def ymd(y: Column, m: Column, d: Column) -> Column:
        return F.struct(y.alias("y"), m.alias("m"), d.alias("d"))

    def numeric(x: Column) -> Column:
        a, b = x["m"].cast("int"), x["d"].cast("int")
        return F.when((a > 12) & (b <= 12), ymd(x["y"], x["d"], x["m"])).when((b > 12) & (a <= 12), x)

    def by_shape(v: Column) -> Column:
        def part(pattern: str, n: int) -> Column:
            return F.regexp_extract(v, pattern, n)

        parts = (
            F.when(v.rlike(_YMD), ymd(part(_YMD, 1), part(_YMD, 2), part(_YMD, 3)))
            .when(v.rlike(_AB_Y), let(ymd(part(_AB_Y, 3), part(_AB_Y, 1), part(_AB_Y, 2)), numeric))
            .when(v.rlike(_D_MONTH_Y),
                  ymd(part(_D_MONTH_Y, 3), _month_number(part(_D_MONTH_Y, 2)), part(_D_MONTH_Y, 1)))
            .when(v.rlike(_MONTH_D_Y),
                  ymd(part(_MONTH_D_Y, 3), _month_number(part(_MONTH_D_Y, 1)), part(_MONTH_D_Y, 2)))
        )
        return let(parts, _iso)

    ordinals = F.regexp_replace(raw, r"(?iU)(\d)(st|nd|rd|th)\b", "$1")
    return let(F.btrim(squeeze(ordinals), F.lit(".,;:()[]")), by_shape)


def parse_number(raw: Column) -> Column:
    """Money text to double; commas and dots are read as decimal or grouping marks."""

    def by_marks(v: Column) -> Column:
        commas = F.length(v) - F.length(F.replace(v, F.lit(","), F.lit("")))
        dots = F.length(v) - F.length(F.replace(v, F.lit("."), F.lit("")))
        no_commas = F.replace(v, F.lit(","), F.lit(""))
        no_dots = F.replace(v, F.lit("."), F.lit(""))
        comma_is_last = F.instr(F.reverse(v), ",") < F.instr(F.reverse(v), ".")
        short_fraction = v.rlike(r"[.,][0-9]{1,2}\z")
        text = (
            F.when((commas > 0) & (dots > 0) & comma_is_last, F.replace(no_dots, F.lit(","), F.lit(".")))
            .when((commas > 0) & (dots > 0), no_commas)
            .when(commas > 1, no_commas)
            .when(dots > 1, no_dots)
            .when(short_fraction, F.replace(v, F.lit(","), F.lit(".")))
            .otherwise(F.translate(v, ",.", ""))
        )
        return F.when(v != "", text.try_cast("double"))

    return let(F.regexp_replace(raw, "[^0-9,.]", ""), by_marks)


def currency_code(token: Column) -> Column:
    """ISO code of a currency token, null when unknown (a bare ``$`` is unknown)."""
    codes = F.create_map(*[F.lit(x) for pair in V.CURRENCY_CODES.items() for x in pair])
    return F.try_element_at(codes, F.upper(token))


def law_category(raw: Column) -> Column:
    """Coarse governing-law category; null for null or empty text."""
    lowered = F.lower(raw)
    category = F.when(raw.isNull() | (raw == ""), F.lit(None).cast("string"))
    for name, words in V.LAW_CATEGORIES:
        category = category.when(lowered.rlike(any_of(words)), name)
    return category.otherwise("other")


def round_exact(x: Column, digits: int) -> Column:
    """Round a double by its exact binary value, halves to even.

    ``round`` works on the decimal spelling, so it rounds 0.50245 up although the stored
    number lies below the half.  The distance to that half is computed without error:
    the number is split in two short halves whose products with the scale are exact.
    """
    return let(x, lambda v: round_exact_ref(v, digits))


def round_exact_ref(x: Column, digits: int) -> Column:
    """:func:`round_exact` for a plain column or lambda variable (it is read repeatedly)."""
    scale = float(10**digits)
    rounded = F.round(x, digits)
    high = x.cast("float").cast("double")
    units = F.round(rounded * scale)
    distance = (high * scale - (units - 0.5)) + (x - high) * scale
    down = (distance < 0) | ((distance == 0) & (F.pmod(units, F.lit(2.0)) == 1))
    return F.when(down, F.round((units - 1) / scale, digits)).otherwise(rounded)
