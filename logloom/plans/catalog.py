"""What tasks can say: all modes, types and formats, as a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..functions.formats import MASKS
from ..operators.parsers import PARSERS
from ..operators.prefilters import MODES
from .settings import SUFFIXES

SECTIONS = {
    "pre_function": MODES,
    "pre_extract": (*PARSERS, "geoip"),
    "transform_type": ("format", "append", "delete", "clone", "rename", "clone_and_format"),
    "format_field_parser": ("allmatch", "regexp", "regexp_mapping", "uripath", "desensitize"),
    "desensitize_type": (*MASKS, "md5", "keep_first_last", "keep_last_four", "custom"),
    "extract_type": ("submatch", "append", "remove", "graft"),
    "preset_filter": ("allmatch", "uripath"),
    "value_type": ("text", "long", "float", "date"),
    "index_suffix_format": SUFFIXES,
    "retention_duration": ("1d", "2d", "7d", "14d", "30d", "90d", "180d", "0"),
}


def catalog(spark: SparkSession) -> DataFrame:
    """section, position and mode."""
    rows = [(section, i, mode) for section, modes in SECTIONS.items() for i, mode in enumerate(modes)]
    return spark.createDataFrame(rows, "section string, position int, mode string")
