"""Tab-separated sources and id-list outputs, their validation and publication."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kindred.functions.columns import entity_id
from kindred.sources import files
from kindred.sources.files import SubmissionError, check_disk, materialise, pin, ready

__all__ = ["SubmissionError", "check_disk", "materialise", "pin", "ready"]

RECORD = T.StructType([T.StructField(n, T.StringType()) for n in ("entity_id", "business_name", "business_address", "country")])


def read_records(spark: SparkSession, path: str | list[str], where: str | None = None) -> DataFrame:
    """Entity records with their integer id; all text, no quoting. Several files make one relation. ``where`` is pushed into the scan's plan."""
    found = spark.read.schema(RECORD).csv(path, sep="\t", header=True, quote="", escape="")
    found = found.where(where) if where else found
    return found.withColumn("id", entity_id(F.col("entity_id")))


def sniffed(spark: SparkSession, path: str) -> str:
    """The separator of a file with a header: the one of tab, comma, semicolon and bar that splits its first line most."""
    head = files.read_bytes(spark, path, 0, 1 << 16).split(b"\n")[0].decode("utf-8", "replace")
    return max("\t,;|", key=head.count)


def described(spark: SparkSession, path: str) -> DataFrame:
    """(column_name, column_type) of a file, inferred from all its rows."""
    found = spark.read.csv(path, sep=sniffed(spark, path), header=True, inferSchema=True)
    return spark.createDataFrame([(f.name, f.dataType.simpleString()) for f in found.schema], "column_name string, column_type string")


def read_numbered(spark: SparkSession, path: str, schema: T.StructType = RECORD) -> DataFrame:
    """Records of one file with rn, which grows with their place in it.

    rn is the byte where the line's split begins, and the line's number within it: a split has no
    more lines than bytes.
    """
    if not files.is_file(spark, path):
        raise ValueError(f"{path} is not one file, and several have no order")
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    lines = spark.read.option("lineSep", "\n").text(path).select("value", (F.col("_metadata.file_block_start") + inside).alias("rn"))
    cells = F.split("value", "\t", -1)
    head = "\t".join(schema.names)
    return lines.where(F.col("value") != head).select("rn", *(F.nullif(cells[k], F.lit("")).alias(n) for k, n in enumerate(schema.names)))


def read_truth(spark: SparkSession, path: str, only: DataFrame | None = None) -> DataFrame:
    """(s1, t) pairs from comma lists; blanks go. ``only``: an (s1) table to keep."""
    raw = spark.read.csv(path, sep="\t", header=True, quote="", schema="source1_entity_id string, matched_entity_ids string")
    pairs = raw.select(entity_id(F.trim("source1_entity_id")).alias("s1"), F.explode(F.split("matched_entity_ids", ",")).alias("m")).where(F.trim("m") != "").select("s1", entity_id(F.trim("m")).alias("t"))
    return pairs.join(only, "s1", "left_semi") if only is not None else pairs


def first_column(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(id): the trimmed first cells of all lines but headers and blank ones."""
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.trim(F.split_part("value", F.lit("\t"), F.lit(1))).alias("id")).where(F.col("id") != "entity_id")


def check_load(spark: SparkSession, path: str, records: DataFrame) -> int:
    """Rows of a source; an error if its raw lines say otherwise."""
    lines, rows = first_column(spark, path).count(), records.count()
    if lines != rows:
        raise SubmissionError(f"{path} has {lines} lines, {rows} rows were loaded")
    return rows


def check_ids(records: DataFrame) -> DataFrame:
    """Malformed and repeated ids, in one pass."""
    return records.agg(F.count("*").alias("rows"), F.count_if(F.col("id").isNull()).alias("malformed"), (F.count("id") - F.count_distinct("id")).alias("repeated"))


def checked_ids(records: DataFrame) -> int:
    """The number of records; an error if there is none, or ids are malformed or repeated."""
    n = check_ids(records).first()
    if not n.rows or n.malformed or n.repeated:
        raise SubmissionError(f"{n.rows} records, {n.malformed} malformed and {n.repeated} repeated ids")
    return n.rows


def write_id_lists(universe: DataFrame, pairs: DataFrame, path: str, header: str) -> dict:
    """One line for each row of ``universe`` (rn, s1 text) in the order of rn: its sorted target ids, or nothing.

    ``pairs``: (s1 text, t text). Raises on repeated pairs, pairs outside the universe, malformed or
    unresolved ids, or a line count that differs. Lines are sorted and written by Spark; the driver
    only joins the part files byte by byte.
    """
    spark = universe.sparkSession
    n = pairs.agg(F.count("*").alias("n"), F.count_distinct("s1", "t").alias("d"), F.count_if(F.col("s1").isNull() | F.col("t").isNull() | ~F.col("t").rlike(r"^S[23]-\d+$")).alias("bad")).first()
    if n.bad:
        raise SubmissionError(f"{n.bad} pairs with malformed or unresolved ids")
    if n.n != n.d:
        raise SubmissionError(f"{n.n - n.d} repeated pairs")
    if outside := pairs.join(universe, "s1", "left_anti").count():
        raise SubmissionError(f"{outside} pairs outside the universe")
    ids = pairs.groupBy("s1").agg(F.array_join(F.sort_array(F.collect_list("t")), ",").alias("ids"), F.count("*").alias("k"))
    lines = universe.join(ids, "s1", "left").select("rn", F.concat("s1", F.lit("\t"), F.coalesce("ids", F.lit(""))).alias("value"))
    parts = f"{path}.parts"
    lines.orderBy("rn").select("value").write.mode("overwrite").option("lineSep", "\n").text(parts)
    files.joined(spark, parts, path, f"source1_entity_id\t{header}\n")
    files.remove(spark, parts)
    told = spark.read.option("lineSep", "\n").text(path)
    rows, total = told.agg(F.count("*"), F.sum(F.size(F.filter(F.split(F.split_part("value", F.lit("\t"), F.lit(2)), ","), lambda x: x != "")))).first()
    if rows - 1 != universe.count() or total - 1 != n.n:  # the header has one cell of its own
        raise SubmissionError("line or pair count differs")
    return {"rows": rows - 1, "pairs": n.n}


def publish(spark: SparkSession, moved: dict[str, str], validators: list[Callable[[dict], tuple[bool, dict]]]) -> list[dict]:
    """Rename temporary files to their names, in order, only after every validator agrees."""
    if any(a.rpartition("/")[0] != b.rpartition("/")[0] for a, b in moved.items()):
        raise SubmissionError("temporary and final files must share a folder")
    told = []
    for check in validators:
        good, details = check(moved)
        told.append(details)
        if not good:
            raise SubmissionError(f"validator refused: {details}")
    for temporary, final in moved.items():
        files.move(spark, temporary, final)
    return told


#: What no list may hold.
ARTEFACTS = r"(?i)nan|none|null|[\[\]'\" ]"


def line_faults(cells: Column, ids: Column, line: Column) -> dict[str, Column]:
    """The kinds of fault that a line shows by itself."""
    two = F.size(cells) == 2
    return {
        "crlf": line.endswith("\r"),
        "no_tab": (F.size(cells) == 1) & (F.regexp_replace(line, "\r$", "") != ""),
        "extra_columns": F.size(cells) > 2,
        "malformed_entity": two & ~F.get(cells, 0).rlike(r"^S1-[0-9]+$"),
        "artefact": two & F.get(cells, 1).rlike(ARTEFACTS),
        "spaces": two & F.get(cells, 1).rlike(r"\s"),
        "empty_id": F.exists(ids, lambda x: x == ""),
        "malformed_id": F.exists(ids, lambda x: (x != "") & ~x.rlike(r"^S[23]-[0-9]+$")),
        "repeated_id": F.size(ids) != F.size(F.array_distinct(ids)),
        "not_utf8": ~F.is_valid_utf8(line),
    }


def audit(spark: SparkSession, matching: str, candidates: str, universe: DataFrame, targets: DataFrame) -> dict[str, int]:
    """Counts of what is wrong in two id-list files; all 0 for a valid pair.

    Whole files: empty, byte order mark, header, last line's end. Lines: see ``line_faults``, and
    repeated, unknown and missing entities. Ids: unknown targets (ids are compared as texts, so that
    S2-012 is not S2-12), matches that are no candidates, entities with matches but no candidate line.
    """
    found: dict[str, int] = {"universe_repeated": universe.count() - universe.select("s1").distinct().count()}
    pairs, entities = {}, {}
    for name, path, header in (("matching", matching, "matched_entity_ids"), ("candidates", candidates, "candidate_entity_ids")):
        length, raw = files.size(spark, path), files.read_bytes(spark, path, 0, 4096)
        first = f"source1_entity_id\t{header}"
        bom = raw.startswith(b"\xef\xbb\xbf")
        found[f"{name}_empty_file"] = int(length == 0)
        found[f"{name}_bom"] = int(bom)
        found[f"{name}_header"] = int(raw[3 * bom :].split(b"\n")[0].rstrip(b"\r") != first.encode())
        found[f"{name}_end"] = int(length > 0 and files.read_bytes(spark, path, length - 1) != b"\n")
        lines = spark.read.option("lineSep", "\n").text(path).where(~F.col("value").isin(first, first + "\r", "﻿" + first))
        rows = lines.select("value", F.split(F.regexp_replace("value", "\r$", ""), "\t", -1).alias("cells")).where("value != ''")
        rows = rows.withColumn("ids", F.when((F.size("cells") == 2) & (F.get("cells", 1) != ""), F.split(F.get("cells", 1), ",", -1)).otherwise(F.array().cast("array<string>"))).withColumn("s1", F.get("cells", 0))
        t = rows.agg(*(F.count_if(c).alias(k) for k, c in line_faults(F.col("cells"), F.col("ids"), F.col("value")).items()), (F.count("*") - F.count_distinct("s1")).alias("repeated_entity")).first()
        found |= {f"{name}_{k}": v for k, v in t.asDict().items()}
        found[f"{name}_unknown_entity"] = rows.join(universe, "s1", "left_anti").count()
        found[f"{name}_missing_entity"] = universe.join(rows, "s1", "left_anti").count()
        entities[name] = rows.select("s1", F.size("ids").alias("n"))
        pairs[name] = rows.select("s1", F.explode("ids").alias("t")).where("t <> ''")
        found[f"{name}_unknown_target"] = pairs[name].join(targets, "t", "left_anti").count()
    found["matching_not_candidate"] = pairs["matching"].join(pairs["candidates"], ["s1", "t"], "left_anti").count()
    found["matching_without_candidate_line"] = entities["matching"].where("n > 0").join(entities["candidates"], "s1", "left_anti").count()
    return found


def write_shards(spark: SparkSession, path: str, out: str, n: int) -> DataFrame:
    """The lines of a file, byte by byte, in ``n`` folders (out/shard=k) by crc32 of the first cell; (shard, lines) of what was written."""
    lines = spark.read.option("lineSep", "\n").text(path)
    shard = F.crc32(F.split_part("value", F.lit("\t"), F.lit(1)).cast("binary")) % n
    lines.withColumn("shard", shard).repartition(n, "shard").write.mode("overwrite").partitionBy("shard").option("lineSep", "\n").text(out)
    return spark.read.option("lineSep", "\n").text(out).groupBy("shard").agg(F.count("*").alias("lines"))


def write_report(frame: DataFrame, path: str) -> None:
    """A small table as one CSV file with a header."""
    spark, parts = frame.sparkSession, f"{path}.parts"
    frame.coalesce(1).write.mode("overwrite").option("emptyValue", "").csv(parts)
    files.joined(spark, parts, path, ",".join(frame.columns) + "\n")
    files.remove(spark, parts)


def text_side_table(records: DataFrame, source_rows: int, path: str, settings: dict | None = None) -> DataFrame:
    """(id, entity_id, name_lc, name_indic, addr_missing) beside the blocking records, written once and checked.

    As many rows as the source has, no null id, no repeated id; else it is an error.
    """
    side = materialise(records.select("id", "entity_id", "name_lc", "name_indic", "addr_missing"), path, settings=settings)
    n = side.agg(F.count("*").alias("rows"), F.count_if(F.col("id").isNull()).alias("nulls"), (F.count("id") - F.count_distinct("id")).alias("repeated")).first()
    if (n.rows, n.nulls, n.repeated) != (source_rows, 0, 0):
        raise SubmissionError(f"{path}: {n.rows} of {source_rows} rows, {n.nulls} null and {n.repeated} repeated ids")
    return side
