"""All registered queries of the library and their SQL."""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from kindred.plans import diagnostics, linkage, profile


def by_sql(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    """A profiling query over the tables that its text names, as temporary views."""
    text = profile.QUERIES[name][0]
    known = "region nation customer supplier part orders lineitem events documents pages labels".split()
    for t in known:
        if re.search(rf"\b{t}\b", text):
            spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    return spark.sql(text)


def queries() -> dict:
    return {n: partial(by_sql, n) for n in profile.QUERIES} | linkage.queries() | diagnostics.queries()


def oracle_sql() -> dict[str, str]:
    return {n: other or text for n, (text, other) in profile.QUERIES.items()} | linkage.oracle_sql() | diagnostics.oracle_sql()
