"""Column functions that the linkage operators share; all are built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

ID_SPAN = 10**9


def entity_id(raw: Column) -> Column:
    """S1-n to n, S2-n and S3-n to source * 10**9 + n; null for anything else or n of 10**9 and more."""
    n = F.try_to_number(F.regexp_extract(raw, r"^S[123]-(\d{1,9})$", 1), F.lit("999999999")).cast("long")
    source = F.regexp_extract(raw, r"^S([123])-\d{1,9}$", 1)
    return F.when(source == "1", n).when(source != "", source.cast("long") * F.lit(ID_SPAN) + n)


WIDE_SPAN = 10**10


def wide_id(raw: Column) -> Column:
    """The other id code: Sd-n to d * 10**10 + n, for any digit d, in either case and between spaces; null for anything else."""
    whole = F.regexp_extract(raw, r"^\s*[sS](\d)-(\d{1,10})\s*$", 2)
    source = F.regexp_extract(raw, r"^\s*[sS](\d)-\d{1,10}\s*$", 1)
    return F.when(whole != "", F.nullif(source, F.lit("")).cast("long") * F.lit(WIDE_SPAN) + F.nullif(whole, F.lit("")).cast("long"))


def wide_entity(rid: Column) -> Column:
    """The text of a wide id."""
    return F.concat(F.lit("S"), F.floor(rid / WIDE_SPAN).cast("string"), F.lit("-"), F.pmod(rid, F.lit(WIDE_SPAN)).cast("string"))


def country_label(raw: Column) -> Column:
    """Lower case without outer spaces; null and blank are the empty label. Any other label is its own partition."""
    return F.lower(F.trim(F.coalesce(raw, F.lit(""))))


def stable_bucket(key: Column, salt: int, parts: int) -> Column:
    """A bucket that other engines compute alike: the first 32 bits of an MD5 of the key and a salt."""
    return F.conv(F.substring(F.md5(F.concat(key.cast("string"), F.lit(f"|{salt}")).cast("binary")), 1, 8), 16, 10).cast("long") % parts


def tokens(text: Column, separator: str = " ") -> Column:
    """Distinct non-empty tokens; null gives none."""
    return F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), "\\Q" + separator + "\\E", -1), lambda x: x != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Share of the union that both have; null where one has nothing."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.size(F.array_union(a, b)))


def grams(text: Column, n: int = 3) -> Column:
    """Distinct n-grams of the text between # marks; none for an empty text."""
    padded = F.concat(F.lit("#"), text, F.lit("#"))
    at = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - (n - 1)))
    return F.when(F.length(text) > 0, F.array_distinct(F.transform(at, lambda i: F.substring(padded, i, n)))).otherwise(F.array().cast("array<string>"))


def byte_levenshtein(a: Column, b: Column) -> Column:
    """Edit distance over UTF-8 bytes: each byte is taken as one Latin-1 letter."""
    narrow = lambda x: F.decode(F.encode(x, "UTF-8"), "ISO-8859-1")
    return F.levenshtein(narrow(a), narrow(b))


def share(x: Column) -> Column:
    return F.round(x.cast("double"), 6)


#: Keys that are numbered together.
SPAN = 4096


def numbered(frame: DataFrame, key: str) -> DataFrame:
    """``frame`` with number, 1 and on in the order of a long ``key``; rows of one key are in no order.

    Rows are numbered within spans of keys, and spans by the counts before them: what is in one task
    is a span, or one row for each span.
    """
    span = F.floor(F.col(key) / SPAN)
    x = frame.withColumn("span", span)
    before = W.orderBy("span").rowsBetween(W.unboundedPreceding, -1)
    offsets = x.groupBy("span").agg(F.count("*").alias("n")).select("span", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    inside = F.row_number().over(W.partitionBy("span").orderBy(key))
    return x.withColumn("inside", inside).join(offsets, "span").withColumn("number", F.col("before") + F.col("inside")).drop("span", "before", "inside")
