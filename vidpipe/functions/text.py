"""Parsers of bilingual free text: counts, durations and ages, as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .values import let

# Words, patterns and formats that the results depend on.
NO_VIEWS = ("no views", "sin vistas")
VIEW_WORDS = ("views", "view", "vistas", "visualizaciones", "reproducciones", "de", "•")
NUMBER = r"((?:\d{1,3}(?:[.,]\d{3})+|\d+)(?:[.,]\d+)?)"
SUFFIX_FIRST_LETTER = "[kmb]|mil|millon|millones|millón|billones|billon|bn"
SUFFIX_LONGEST = "millones|millón|millon|mil|billones|billon|bn|[kmb]"
MULTIPLIERS = {"k": 1e3, "mil": 1e3, "m": 1e6, "millon": 1e6, "millón": 1e6, "millones": 1e6, "b": 1e9, "bn": 1e9, "billon": 1e9, "billones": 1e9}
HOURS = ("h", "hr", "hrs", "hour", "hours", "hora", "horas")
MINUTES = ("m", "min", "mins", "minute", "minutes", "minuto", "minutos")
SECONDS = ("s", "sec", "secs", "second", "seconds", "segundo", "segundos")
AGE_PREFIXES = ("premiered", "streamed", "hace", "emitido", "estrenado", "transmitido", "se emitió")
YESTERDAY = ("yesterday", "ayer")
AGE_EN = "minute|min|hour|day|week|month|year"
AGE_ES = "minuto|hora|d[ií]a|dia|semana|mes|a[nñ]o"
UNIT_SECONDS = {
    "minute": 60, "min": 60, "minuto": 60, "hour": 3600, "hora": 3600, "day": 86400, "dia": 86400,
    "week": 604800, "semana": 604800, "month": 2592000, "mes": 2592000, "year": 31536000, "ano": 31536000,
}
DATES = (
    (r"^\d{4}-\d{1,2}-\d{1,2}$", "yyyy-M-d"),
    (r"^\p{L}{3} \d{1,2}, \d{4}$", "MMM d, yyyy"),
    (r"^\p{L}+ \d{1,2}, \d{4}$", "MMMM d, yyyy"),
    (r"^\d{1,2} \p{L}{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} \p{L}+ \d{4}$", "d MMMM yyyy"),
)


def _group(text: Column, pattern: str, group: int) -> Column:
    """A group of the first match, null without one; ``text`` stands in the expression only once."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)), F.lit(0))


def _without(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda c, w: F.replace(c, F.lit(w), F.lit(" ")), words, text)


def _any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def squeeze(text: Column) -> Column:
    """White space runs, Unicode ones too, become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, r"(?U)[\s\x1c-\x1f]+", " "))


def normalize_text(text: Column) -> Column:
    """``squeeze``, and null where nothing is left."""
    return F.nullif(squeeze(text), F.lit(""))


def human_number(digits: Column, has_suffix: Column) -> Column:
    """A number whose separators depend on the locale.

    Of both separators the last is the decimal one.  A comma alone is decimal only before a suffix; a dot alone
    marks thousands only without suffix and as the single dot before three digits.
    """
    comma, dot = F.contains(digits, F.lit(",")), F.contains(digits, F.lit("."))
    drop = lambda c, s: F.replace(c, F.lit(s), F.lit(""))
    point = lambda c: F.replace(c, F.lit(","), F.lit("."))
    comma_last = F.length(F.substring_index(digits, ",", -1)) < F.length(F.substring_index(digits, ".", -1))
    plain = (
        F.when(comma & dot & comma_last, point(drop(digits, ".")))
        .when(comma & dot, drop(digits, ","))
        .when(comma & has_suffix, point(digits))
        .when(comma, drop(digits, ","))
        .when(dot & ~has_suffix & digits.rlike(r"^[^.]*\.[^.]{3}$"), drop(digits, "."))
        .otherwise(digits)
    )
    return plain.try_cast("double")


def parse_views(text: Column, longest_suffix: bool = False) -> Column:
    """A view count as bigint, null if there is none.

    A suffix is recognised by its first letter, so ``mil`` counts as millions; ``longest_suffix`` reads it as
    thousands.
    """
    pattern = rf"(?iU){NUMBER}\s*({SUFFIX_LONGEST if longest_suffix else SUFFIX_FIRST_LETTER})?"
    factor = F.create_map(*(F.lit(x) for kv in {"": 1.0, **MULTIPLIERS}.items() for x in kv))

    def number(found: Column) -> Column:
        digits, suffix = F.regexp_extract(found, pattern, 1), F.regexp_extract(found, pattern, 2)
        parts = F.struct(digits.alias("digits"), suffix.alias("suffix"))
        return let(parts, lambda p: (human_number(p["digits"], p["suffix"] != "") * F.try_element_at(factor, p["suffix"])).try_cast("bigint"))

    def count(lower: Column) -> Column:
        value = let(_group(squeeze(_without(lower, VIEW_WORDS)), pattern, 0), number)
        return F.when(_any(lower, NO_VIEWS), F.lit(0).cast("bigint")).otherwise(value)

    return let(F.lower(squeeze(text)), count)


def _seconds(hours: Column, minutes: Column, seconds: Column) -> Column:
    times = lambda c, n: F.try_multiply(c, F.lit(n).cast("bigint"))
    return F.try_add(F.try_add(times(hours, 3600), times(minutes, 60)), seconds)


def parse_duration(text: Column) -> Column:
    """Seconds of ``MM:SS``, ``HH:MM:SS`` or worded hours, minutes and seconds; a worded zero is null.

    Of several amounts of a unit the one whose word stands first in the unit's list counts, and of these the first.
    """
    zero = F.lit(0).cast("bigint")
    words = sorted((*HOURS, *MINUTES, *SECONDS), key=len, reverse=True)
    pattern = rf"(?U)(\d+)\s*({'|'.join(words)})\b"

    def colon(parts: Column) -> Column:
        part = lambda k: F.try_element_at(parts, F.lit(k)).try_cast("bigint")
        return F.when(F.size(parts) == 2, _seconds(zero, part(1), part(2))).otherwise(_seconds(part(1), part(2), part(3)))

    def worded(amounts: Column) -> Column:
        def unit(names: tuple[str, ...]) -> Column:
            listed = F.array(*map(F.lit, names))
            ranked = F.transform(amounts, lambda a, i: F.struct(F.array_position(listed, a["word"]).alias("rank"), i.alias("i"), a["n"].alias("n")))
            return F.coalesce(F.array_min(F.filter(ranked, lambda r: r["rank"] > 0))["n"].try_cast("bigint"), zero)

        return let(_seconds(unit(HOURS), unit(MINUTES), unit(SECONDS)), lambda total: F.when(total != 0, total))

    def amounts(clean: Column) -> Column:
        found = F.regexp_extract_all(squeeze(F.translate(F.lower(clean), ",·", "  ")), F.lit(pattern), F.lit(0))
        return F.transform(found, lambda m: F.struct(F.regexp_extract(m, pattern, 1).alias("n"), F.regexp_extract(m, pattern, 2).alias("word")))

    def seconds(clean: Column) -> Column:
        return F.when(clean.rlike(r"(?U)^\d+(:\d+){1,2}$"), let(F.split(clean, ":"), colon)).otherwise(let(amounts(clean), worded))

    return let(squeeze(text), seconds)


def parse_published(text: Column, now: Column, fix_plural_months: bool = False) -> Column:
    """The time that a published text names, relative to ``now`` or absolute; null if it names none.

    Spanish plural months are not understood unless ``fix_plural_months``.  Absolute dates are read from the
    text as it is, so a phrase before them hides them.
    """
    spanish = AGE_ES.replace("mes", "mes(?:e(?=s))?") if fix_plural_months else AGE_ES
    en, es = rf"(?U)(\d+)\s*({AGE_EN})s?\b", rf"(?U)(\d+)\s*({spanish})s?\b"
    lengths = F.create_map(*(F.lit(x) for kv in UNIT_SECONDS.items() for x in kv))

    def relative(age: Column) -> Column:
        # an English phrase is matched by both patterns or by its own; the pattern that found it reads it again
        of = lambda k: F.when(age["english"], F.regexp_extract(age["phrase"], en, k)).otherwise(F.regexp_extract(age["phrase"], es, k))
        unit = F.translate(of(2), "íñáéóú", "inaeou")
        if fix_plural_months:
            unit = F.when(unit == "mese", F.lit("mes")).otherwise(unit)
        back = F.try_multiply(of(1).try_cast("bigint"), F.try_element_at(lengths, unit).cast("bigint") * 1_000_000)
        return let(F.try_subtract(F.unix_micros(now), back), lambda then: F.when(then >= F.lit(-62_135_596_800_000_000), F.timestamp_micros(then)))

    def absolute(clean: Column) -> Column:
        return F.coalesce(*(F.try_to_timestamp(F.when(clean.rlike(f"(?U){p}"), clean), F.lit(f)) for p, f in DATES))

    def aged(lower: Column) -> Column:
        first, other = _group(lower, en, 0), _group(lower, es, 0)
        return let(first, lambda e: F.struct(F.coalesce(e, other).alias("phrase"), e.isNotNull().alias("english")))

    def time(p: Column) -> Column:
        day = F.timestamp_micros(F.unix_micros(now) - 86_400_000_000)
        found = let(aged(p["lower"]), lambda a: F.struct(a["phrase"].isNotNull().alias("yes"), relative(a).alias("at")))
        otherwise = let(found, lambda r: F.when(r["yes"], r["at"]).otherwise(absolute(p["clean"])))
        return F.when(_any(p["lower"], YESTERDAY), day).otherwise(otherwise)

    both = let(squeeze(text), lambda c: F.struct(c.alias("clean"), squeeze(_without(F.lower(c), AGE_PREFIXES)).alias("lower")))
    return let(both, time)
