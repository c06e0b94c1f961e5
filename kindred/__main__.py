"""python -m kindred train|link|audit|preflight: linkage over tab-separated files.

train S1 TARGETS TRUTH OUT: fit a model and choose a rule; link S1 TARGETS OUT: write the id lists
with them; audit MATCHES CANDIDATES S1 TARGETS: report what is wrong in two id-list files;
preflight S1 TARGETS OUT: look whether a link run can begin. TARGETS: files separated by commas.
"""

from __future__ import annotations

import json
import sys
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from kindred.functions.columns import stable_bucket
from kindred.operators import blocking as B
from kindred.operators import matching as M
from kindred.operators import model as G
from kindred.plans import link
from kindred.sources import files, tsv

CHUNKS = 4


def split(paths: str) -> list[str]:
    return [p for p in paths.split(",") if p]


def train(spark: SparkSession, s1: str, targets: str, truth: str, out: str) -> dict:
    q, t = link.prepared(spark, s1, f"{out}/train/s1"), link.prepared(spark, split(targets), f"{out}/train/targets")
    real = tsv.read_truth(spark, truth)
    pairs, report = link.candidates(q, t, f"{out}/train", chunks=CHUNKS)
    features = link.features(pairs, q, t, f"{out}/train", {"chunks": CHUNKS, "caps": asdict(B.Caps())})
    model = G.train(link.train_rows(features, real))
    model.write().overwrite().save(f"{out}/model")
    held = stable_bucket(F.col("s1"), 42, 100) < 20
    universe = q.select(F.col("id").alias("s1")).where(held)
    rule = link.best_rule(G.score(model, features.where(held)), real.where(held), universe)
    recall = M.candidate_recall(pairs, real).first().asDict()
    files.write_json(spark, f"{out}/rule.json", asdict(rule))
    files.write_json(spark, f"{out}/metrics.json", {"recall": recall, "chunks": report})
    tsv.write_report(M.recall_by(pairs, real, q, "country"), f"{out}/recall.csv")
    return {"rule": asdict(rule), "recall": recall}


def run(spark: SparkSession, s1: str, targets: str, out: str) -> dict:
    q, t = link.prepared(spark, s1, f"{out}/test/s1"), link.prepared(spark, split(targets), f"{out}/test/targets")
    pairs, _ = link.candidates(q, t, f"{out}/test", chunks=CHUNKS)
    rule = M.Rule(**files.read_json(spark, f"{out}/rule.json"))
    told = link.infer_chunked(PipelineModel.load(f"{out}/model"), rule, pairs, q, t, f"{out}/test/predictions", CHUNKS)
    found = link.predictions(spark, f"{out}/test/predictions")
    gate = M.forced_matches(found, pairs, rule.threshold).first()
    if any(gate):
        raise files.SubmissionError(f"forced matches: {gate.asDict()}")
    name = lambda x, a, b: x.join(q.select(F.col("id").alias("s1"), F.col("entity_id").alias(a)), "s1").join(t.select(F.col("id").alias("t"), F.col("entity_id").alias(b)), "t").select(F.col(a).alias("s1"), F.col(b).alias("t"))
    universe = tsv.read_numbered(spark, s1).select("rn", F.col("entity_id").alias("s1"))
    moved = {f"{out}/candidates.tmp": f"{out}/candidates.tsv", f"{out}/matches.tmp": f"{out}/matches.tsv"}
    lists = [tsv.write_id_lists(universe, name(p, "a", "b"), f, h) for p, f, h in zip((pairs, found), moved, ("candidate_entity_ids", "matched_entity_ids"))]
    valid = lambda _: (not any((bad := tsv.audit(spark, f"{out}/matches.tmp", f"{out}/candidates.tmp", universe, t.select(F.col("entity_id").alias("t")))).values()), bad)
    tsv.publish(spark, moved, [valid])
    return {"candidates": lists[0], "matches": lists[1], "parts": told}


def preflight(spark: SparkSession, s1: str, targets: str, out: str, least_gb: float = 3.0) -> dict:
    """What a link run needs: sources, a model that fits the features, a rule, a folder that can be written, free space."""
    told: dict = {"spark": spark.version}
    for p in (s1, *split(targets)):
        told[p] = files.size(spark, p) if files.exists(spark, p) else None
    told["rule"] = files.read_json(spark, f"{out}/rule.json") if files.exists(spark, f"{out}/rule.json") else None
    fits = files.exists(spark, f"{out}/model") and G.inputs(PipelineModel.load(f"{out}/model")) == len(M.FEATURES)
    told["model_fits"] = fits
    files.write_text(spark, f"{out}/_probe", "x")
    files.remove(spark, f"{out}/_probe")
    try:
        told["free_gb"] = round(files.check_disk(spark, out, least_gb), 1)
    except OSError as e:
        told["free_gb"], told["fault"] = 0.0, str(e)
    told["all_ok"] = fits and told["rule"] is not None and "fault" not in told and all(told[p] for p in (s1, *split(targets)))
    return told


def main(args: list[str]) -> int:
    spark = SparkSession.builder.appName("kindred").getOrCreate()
    if args[:1] == ["train"] and len(args) == 5:
        print(json.dumps(files.plain(train(spark, *args[1:]))))
    elif args[:1] == ["link"] and len(args) == 4:
        print(json.dumps(files.plain(run(spark, *args[1:]))))
    elif args[:1] == ["preflight"] and len(args) == 4:
        told = preflight(spark, *args[1:])
        print(json.dumps(files.plain(told)))
        return int(not told["all_ok"])
    elif args[:1] == ["audit"] and len(args) == 5:
        first = lambda p, n: tsv.first_column(spark, p).select(F.col("id").alias(n))
        bad = tsv.audit(spark, args[1], args[2], first(args[3], "s1"), first(split(args[4]), "t"))
        print(json.dumps(bad))
        return int(any(bad.values()))
    else:
        print(__doc__)
        return 2
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
