"""The shared expressions as SQL functions of a session, for queries written as text."""

from __future__ import annotations

import unicodedata

from pyspark.sql import SparkSession

#: Lower-case Latin letters with marks that come apart into a plain letter and its marks.
MARKED = {chr(o): unicodedata.normalize("NFD", chr(o))[0] for o in range(0xDF, 0x250) if unicodedata.normalize("NFD", chr(o))[0] != chr(o) and chr(o).islower()}

FUNCTIONS = {
    "link_tokens(s STRING) RETURNS ARRAY<STRING>": "array_distinct(filter(split(coalesce(s, ''), ' '), x -> x <> ''))",
    "link_jaccard(a ARRAY<STRING>, b ARRAY<STRING>) RETURNS DOUBLE": "CASE WHEN size(a) > 0 AND size(b) > 0 THEN size(array_intersect(a, b)) / size(array_union(a, b)) END",
    "link_grams(s STRING) RETURNS ARRAY<STRING>": "CASE WHEN length(s) > 0 THEN array_distinct(transform(sequence(1, length(s)), i -> substring(concat('#', s, '#'), i, 3))) ELSE CAST(array() AS ARRAY<STRING>) END",
    "norm_basic(s STRING) RETURNS STRING": r"trim(regexp_replace(lower(s), '[ \\t\\n\\r]+', ' '))",
    "has_indic(s STRING) RETURNS BOOLEAN": r"s RLIKE '[\\x{0900}-\\x{0DFF}]'",
    "plain_latin(s STRING) RETURNS STRING": "translate(s, '{}', '{}')".format("".join(MARKED), "".join(MARKED.values())),
    "norm_alnum(s STRING) RETURNS STRING": r"regexp_replace(CASE WHEN has_indic(s) THEN lower(s) ELSE plain_latin(lower(s)) END, '[^\\p{L}\\p{M}\\p{N}]+', '')",
}


def register(spark: SparkSession) -> None:
    """Make the functions known to a session, over what it may have under their names."""
    for head, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")
