"""Text normalisation over columns: Arrow functions of names and addresses, and the records that linkage works on.

The functions of one value are in ``scripts``, ``names`` and ``addresses``. Distinct values of a
batch are parsed once, and a worker keeps what it has parsed.
"""

from __future__ import annotations

import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions import addresses as A
from kindred.functions import fixed_values as V
from kindred.functions import names as N
from kindred.functions.addresses import address_descriptors, address_parts, state_code
from kindred.functions.names import digits_read, name_descriptors, name_parts
from kindred.functions.scripts import SOUND_STEPS, absent, basic, char_grams, missing, number_runs, script_family, scripts, site, sound_key, transliterated, without_accents, words_of

__all__ = ["absent", "basic", "char_grams", "digits_read", "missing", "name_descriptors", "name_parts", "address_descriptors", "address_parts", "number_runs", "script_family", "scripts", "site", "sound_key", "state_code", "transliterated", "without_accents", "words_of"]

STRING, FLAG, NUMBER, STRINGS = T.StringType(), T.BooleanType(), T.IntegerType(), T.ArrayType(T.StringType())


def struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(n, k) for n, k in fields.items()])


NAME = struct(**dict.fromkeys(N.TEXTS, STRING), **dict.fromkeys(N.LISTS, STRINGS))
ADDRESS = struct(**dict.fromkeys(A.TEXTS, STRING), **dict.fromkeys(A.LISTS, STRINGS), is_missing=FLAG, noise_removed=NUMBER)
KINDS = {str: STRING, bool: FLAG, int: NUMBER}
NAME_FACTS = struct(**{k: KINDS[type(v)] for k, v in name_descriptors("x").items()})
ADDRESS_FACTS = struct(**{k: KINDS[type(v)] for k, v in address_descriptors("x").items()})


def names(raw: Column | str) -> Column:
    """The name ladder as a struct."""
    return F.pandas_udf(names_values, NAME)(raw)


def names_values(raw: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([name_parts(x) for x in raw], columns=NAME.names)


def addresses(raw: Column | str, country: Column | str) -> Column:
    """The fields of an address as a struct."""
    return F.pandas_udf(addresses_values, ADDRESS)(raw, country)


def addresses_values(raw: pd.Series, country: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([address_parts(x, basic(c)) for x, c in zip(raw, country)], columns=ADDRESS.names)


def name_facts(raw: Column | str) -> Column:
    """Seventeen descriptors of a name as a struct."""
    return F.pandas_udf(lambda raw: pd.DataFrame([name_descriptors(x) for x in raw], columns=NAME_FACTS.names), NAME_FACTS)(raw)


def address_facts(raw: Column | str, country: Column | str) -> Column:
    """Eighteen descriptors of an address as a struct."""
    return F.pandas_udf(lambda raw, country: pd.DataFrame([address_descriptors(x, basic(c)) for x, c in zip(raw, country)], columns=ADDRESS_FACTS.names), ADDRESS_FACTS)(raw, country)


def text_column(kind: str, raw: Column | str) -> Column:
    """basic, without_accents, script_family, transliterated or sound_key as an Arrow function."""
    f = {"basic": basic, "without_accents": lambda s: without_accents(s or ""), "script_family": lambda s: script_family(basic(s)), "transliterated": lambda s: transliterated(basic(s)), "sound_key": lambda s: sound_key(basic(s))}[kind]
    return F.pandas_udf(lambda x: x.map(f), STRING)(raw)


def script_counts(raw: Column | str) -> Column:
    """Letters by script as a map."""
    return F.pandas_udf(lambda x: x.map(lambda s: scripts("" if absent(s) else s)), T.MapType(STRING, NUMBER))(raw)


def ascii_sound_key(text: Column) -> Column:
    """``sound_key`` of lower-case ASCII text in built-in functions only."""
    for pattern, put in SOUND_STEPS:
        text = F.regexp_replace(text, pattern, put.replace("\\1", "$1"))
    return F.trim(F.regexp_replace(text, " +", " "))


def flat_records(source: DataFrame) -> DataFrame:
    """``source`` (id, business_name, business_address, country) as twenty flat columns beside the id."""
    x = source.select("id", names("business_name").alias("n"), addresses("business_address", "country").alias("a"))
    fields = {f"name_{c}": f"n.{c}" for c in ("basic", "core", "core_latin", "compact", "phonetic", "script", "website_label")} | {f"addr_{k}": f"a.{c}" for k, c in (("normalized", "normalized"), ("house_number", "house"), ("house_number_core", "house_core"), ("street", "street"), ("city", "city"), ("state", "state"), ("unit", "unit"), ("po_box", "po_box"), ("is_missing", "is_missing"))}
    joined = {"name_legal_forms": F.array_join("n.legal", "|"), "name_aliases": F.array_join("n.aliases", "|"), "addr_components": F.array_join("a.components", "|"), "addr_numbers": F.array_join("a.numbers", " ")}
    return x.select("id", *(F.col(c).alias(n) for n, c in fields.items()), *(c.alias(n) for n, c in joined.items()))


def padded_grams(text: Column) -> Column:
    """Distinct trigrams of each word between # marks, in order; shorter words whole."""
    of = lambda w: F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(w))), lambda k: F.substring(F.concat(F.lit("#"), w, F.lit("#")), k, 3))
    return F.array_distinct(F.flatten(F.transform(F.filter(F.split(text, " "), lambda w: w != ""), of)))


def wide_records(source: DataFrame) -> DataFrame:
    """The other blocking record, of 21 fields, from (entity_id, business_name, business_address, country): empty texts are null, lists have no empty items."""
    from kindred.functions.columns import wide_id

    country = F.nullif(F.trim("country"), F.lit(""))
    x = source.select("entity_id", country.alias("country"), names("business_name").alias("n"), addresses("business_address", F.coalesce(country, F.lit(""))).alias("a"))
    text = lambda c, n: F.nullif(F.col(c), F.lit("")).alias(n)
    some = lambda c: F.array_distinct(F.filter(c, lambda v: v != ""))
    return x.select(
        wide_id(F.col("entity_id")).alias("rid"), F.nullif(F.regexp_extract("entity_id", r"^\s*[sS](\d)-", 1), F.lit("")).cast("int").alias("src"), "country",
        F.nullif(text_column("transliterated", "n.canonical"), F.lit("")).alias("name_canon"), text("n.core_latin", "name_core"), text("n.compact", "name_compact"), text("n.website_label", "name_web"),
        some(F.col("n.aliases")).alias("name_aliases"), text("n.phonetic", "name_phon"), some(F.split("n.core_latin", " ")).alias("name_tokens"), padded_grams(F.col("n.core_latin")).alias("name_grams"),
        F.col("n.script").alias("name_script"), F.array_join("n.legal", "|").alias("name_legal"), text("a.state", "addr_state"), text("a.house_core", "addr_house"), text("a.street", "addr_street"), text("a.city", "addr_city"),
        some(F.col("a.places")).alias("addr_places"), some(F.col("a.numbers")).alias("addr_numbers"), text("a.normalized", "addr_norm"), F.col("a.is_missing").alias("addr_missing"),
    )


def records(source: DataFrame) -> DataFrame:
    """Linkage records of (id, business_name, business_address, country), as the blocking operators take them.

    Nulls become empty values.
    """
    x = source.withColumn("country", F.lower(F.trim(F.coalesce("country", F.lit(""))))).withColumn("n", names("business_name")).withColumn("a", addresses("business_address", "country"))
    split = lambda c: F.array_distinct(F.filter(F.split(c, " "), lambda w: w != ""))
    joined = lambda v: F.array_join(F.filter(F.split(v, " "), lambda w: w != "and"), "")
    long = lambda c: F.when(F.length(c) >= 3, c).otherwise("")
    stop = F.array(*map(F.lit, sorted(V.STOP_WORDS)))
    sides = F.concat(F.array("n.core_latin"), F.col("n.aliases"))
    label = F.filter(F.array("n.website_label"), lambda w: w != "")
    keys = F.array_distinct(F.filter(F.concat(F.transform(sides, joined), label), lambda k: F.length(k) >= 3))
    phon = F.array_sort(F.filter(split(F.col("n.phonetic")), lambda w: F.length(w) >= 2))
    tokens = F.array_distinct(F.concat(F.array_except(F.filter(split(F.array_join(sides, " ")), lambda w: F.length(w) >= 2), stop), label))
    words = F.array_distinct(F.filter(F.split(F.array_join(F.filter("a.components", lambda c: c != F.col("a.state")), " "), " "), lambda w: w.rlike(r"^[\p{L}]{3,}$")))
    return x.select(
        "id", "country", F.col("a.state").alias("state"), F.lower("business_name").alias("name_lc"), F.col("n.core_latin").alias("core"), long(F.col("n.compact")).alias("name_key"), keys.alias("keys"),
        F.array_join(phon, " ").alias("phon_key"), phon.alias("phon_tokens"), tokens.alias("name_tokens"), words.alias("addr_tokens"), F.col("a.house_core").alias("hn"), F.col("a.street").alias("street"),
        F.col("a.places").alias("places"), F.col("a.numbers").alias("numbers"), F.col("n.script").isin("indic", "mixed").alias("name_indic"),
        (F.coalesce(F.lower(F.trim("business_address")), F.lit("")).isin("", "null", "<null>", "none", "nan", "n/a")).alias("addr_missing"),
    )
