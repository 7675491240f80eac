"""Labels of facet options and locale settings by language."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Facet, option, English label, Spanish label.
CATALOGUE = """
upload_date | last_hour | Last hour | Última hora
upload_date | today | Today | Hoy
upload_date | this_week | This week | Esta semana
upload_date | this_month | This month | Este mes
upload_date | this_year | This year | Este año
duration | under_4 | Under 3 minutes | Menos de 3 minutos
duration | 4_20 | 3 - 20 minutes | De 3 a 20 minutos
duration | over_20 | Over 20 minutes | Más de 20 minutos
features | live | Live | En directo
features | 4k | 4K | 4K
features | hd | HD | HD
features | subtitles | Subtitles/CC | Subtítulos
features | creative_commons | Creative Commons | Creative Commons
features | 360 | 360° | 360°
features | vr180 | VR180 | VR180
features | 3d | 3D | 3D
features | hdr | HDR | HDR
features | location | Location | Ubicación
features | purchased | Purchased | Comprado
sort_by | relevance | Relevance | Relevancia
sort_by | upload_date | Upload date | Fecha de subida
sort_by | view_count | View count | Recuento de visualizaciones
sort_by | rating | Rating | Calificación
"""

# Language, locale, time zone, accepted languages.
LOCALES = """
en | en-US | America/New_York | en-US,en;q=0.9
es | es-MX | America/Mexico_City | es-MX,es;q=0.9
"""


def _rows(text: str) -> list[list[str]]:
    return [[x.strip() for x in line.split("|")] for line in text.strip().splitlines()]


def options(facet: str) -> list[str]:
    """The options of a facet, in order."""
    return [o for f, o, *_ in _rows(CATALOGUE) if f == facet]


def label_table(spark: SparkSession) -> DataFrame:
    """``(lang, facet, option, label)``: two rows for each option, a table of fixed size."""
    rows = [(lang, f, o, label) for f, o, *both in _rows(CATALOGUE) for lang, label in zip(("en", "es"), both, strict=True)]
    return spark.createDataFrame(rows, "lang string, facet string, option string, label string")


def locale_table(spark: SparkSession) -> DataFrame:
    """``(lang, locale, timezone, accept_language)``, a row for each language."""
    return spark.createDataFrame(_rows(LOCALES), "lang string, locale string, timezone string, accept_language string")
