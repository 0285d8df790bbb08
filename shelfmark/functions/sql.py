"""The text and number functions of the listing's locale under names for SQL.

    register(spark)
    spark.sql("SELECT locale_number('14.902'), issn('P-ISSN : 12345678', 'P')")

They are SQL functions, which Spark puts into the plan in place of their calls; tests hold them against functions.text.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfmark.functions.text import NUMBER, PAGINATION
from shelfmark.functions.web import WAITS

_TRIMMED = r"regexp_replace({}, r'(?U)^\s+|\s+$', '')"
_PLAIN = "replace(replace(" + _TRIMMED.format("t") + ", '.', ''), ',', '.')"
#: Name and parameters, type, and what it is.
FUNCTIONS = {
    "collapse_space(t STRING)": ("STRING", r"regexp_replace(regexp_replace(t, r'(?U)\s+', ' '), '^ | $', '')"),
    "trim_space(t STRING)": ("STRING", _TRIMMED.format("t")),
    "locale_number(t STRING)": ("DOUBLE", f"CASE WHEN {_TRIMMED.format('t')} = '' THEN 0.0D WHEN {_PLAIN} RLIKE r'{NUMBER}' THEN try_cast({_PLAIN} AS DOUBLE) END"),
    "profile_id(t STRING)": ("BIGINT", r"nullif(try_cast(regexp_extract(t, r'/profile/(\d+)', 1) AS BIGINT), 0L)"),
    "link_kind(t STRING)": ("STRING", "CASE WHEN contains(lower(t), 'google scholar') THEN 'google_scholar' WHEN contains(lower(t), 'editor url') THEN 'editor' WHEN contains(lower(t), 'website') THEN 'website' END"),
    "issn(t STRING, kind STRING)": ("STRING", r"regexp_extract(t, kind || r'-ISSN\s*:\s*([0-9Xx]*)', 1)"),
    "subject_area(t STRING)": ("STRING", _TRIMMED.format(r"regexp_extract(t, r'Subject Area\s*:\s*(.+)$', 1)")),
    "pagination_total(t STRING, part INT)": ("INT", f"coalesce(try_cast(replace(regexp_extract(t, r'{PAGINATION}', part), '.', '') AS INT), 0)"),
    "retry_wait(attempt BIGINT)": ("INT", f"element_at(array({', '.join(map(str, WAITS))}), CAST(least(attempt, {len(WAITS)}) AS INT))"),
}


def register(spark: SparkSession) -> None:
    """Makes FUNCTIONS known to the session, in place of temporary functions of their names."""
    for call, (kind, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {call} RETURNS {kind} RETURN {body}")
