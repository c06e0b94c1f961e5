import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from kindred.operators import blocking as B
from kindred.operators import matching as M
from kindred.operators import model as G
from kindred.sources import tsv

SCHEMA = "id long, country string, state string, name_lc string, core string, name_key string, keys array<string>, phon_key string, phon_tokens array<string>, name_tokens array<string>, addr_tokens array<string>, hn string, street string, places array<string>, numbers array<string>, name_indic boolean, addr_missing boolean"


def record(i, name, country="us", state="tx", hn="1", street="main st", places=("austin",), tokens=None):
    words = name.split()
    return (i, country, state, name, name, name.replace(" ", ""), [name.replace(" ", "")] if name else [], name, words, tokens or words, list(places), hn, street, list(places), [hn] if hn else [], False, not state)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def pairs(df):
    return {(r.s1, r.t) for r in df.collect()}


def test_two_tiers_fall_back_to_the_state(spark):
    q = frame(spark, [record(1, "acme")])
    t = frame(spark, [record(10 + k, "acme", state=s) for k, s in enumerate(["tx", "ny", "ca", "wa", ""])])
    caps = B.Caps(name=2, name_state=2)
    assert pairs(B.strategy("name", q, t, caps)) == {(1, 10), (1, 14)}
    assert pairs(B.strategy("name", q, t, B.Caps(name=2, name_state=2, stateless=False))) == {(1, 10)}
    assert len(pairs(B.strategy("name", q, t, B.Caps(name=5)))) == 5
    assert not pairs(B.strategy("name", q, frame(spark, [record(10, "acme", country="in")]), caps))


def test_structured_refines_large_blocks(spark):
    q = frame(spark, [record(1, "a")])
    t = frame(spark, [record(10, "b"), record(11, "c", street="oak", places=("waco",)), record(12, "d", street="elm", places=("austin",))])
    assert pairs(B.strategy("structured", q, t, B.Caps(hn=2))) == {(1, 10), (1, 12)}
    assert len(pairs(B.strategy("structured", q, t, B.Caps(hn=3)))) == 3


def test_rare_tokens_and_grams(spark):
    q = frame(spark, [record(1, "blue zeta")])
    t = frame(spark, [record(10, "blue one"), record(11, "blue two"), record(12, "zeta three"), record(13, "blue zeta")])
    assert pairs(B.strategy("rare_name", q, t, B.Caps(token_k=1))) == {(1, 12), (1, 13)}
    assert pairs(B.strategy("ngram", q, t, B.Caps(gram_top=1))) == {(1, 13)}
    assert pairs(B.strategy("compound", q, t)) == {(1, k) for k in (10, 11, 12, 13)}
    assert (1, 13, 1.0) in {tuple(r) for r in B.trigram_join(q, t).collect()}


def made_rows(frame):
    """The most rows that an operator of the frame's plan made."""
    frame.collect()
    import re

    text = frame._jdf.queryExecution().executedPlan()
    rows, todo = [0], [text]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() in ("AdaptiveSparkPlanExec",):
            todo.append(node.executedPlan())
        if re.search("QueryStageExec", node.getClass().getSimpleName()):
            todo.append(node.plan())
        found = node.metrics().get("numOutputRows")
        rows += [found.get().value()] if found.isDefined() else []
        todo += [node.children().apply(k) for k in range(node.children().size())]
    return max(rows)


def test_records_of_one_name_meet_by_grams_once(spark):
    """100 queries and 300 targets of one name made 100 x 300 rows for each gram."""
    q = frame(spark, [record(k, "blue zeta") for k in range(100)])
    t = frame(spark, [record(1000 + k, "blue zeta" if k % 2 else "blue zetas") for k in range(300)])
    for found in (B.strategy("ngram", q, t, B.Caps(gram_top=3)), B.trigram_join(q, t, top=3)):
        assert {(r.s1, r.t) for r in found.collect()} == {(s, n) for s in range(100) for n in (1001, 1003, 1005)}
        assert made_rows(found) < 3000


def test_classes_fill_up_the_nearest(spark):
    """A class of few targets leaves places for the next ones; ties between classes go by id."""
    q = frame(spark, [record(1, "blue zeta"), record(2, "blue zeta")])
    t = frame(spark, [record(10 + k, n) for k, n in enumerate(["blue zets", "blue zeta", "blue zetx", "blue zets", "blue zetx"])])
    assert pairs(B.strategy("ngram", q, t, B.Caps(gram_top=3))) == {(s, n) for s in (1, 2) for n in (10, 11, 12)}
    assert pairs(B.trigram_join(q, t, top=4)) == {(s, n) for s in (1, 2) for n in (10, 11, 12, 13)}


def test_masks_are_dealt_out_once(spark):
    """pairs went through two exchanges, by strategy and by pair."""
    q, t = frame(spark, [record(1, "blue zeta")]), frame(spark, [record(10, "blue zeta")])
    u = B.union_mask(q, t)
    plan = u._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in u.collect()] == [(1, 10, 255 - 16)] and "hashpartitioning(s1" in plan and "hashpartitioning(s1#" in plan
    assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(s1#" in x and ", t#" in x]


def test_union_cap_and_guard(spark):
    q = frame(spark, [record(1, "acme")])
    t = frame(spark, [record(10 + k, "acme", hn=str(k)) for k in range(4)])
    u = B.union_mask(q, t)
    best = u.where("t = 11").first()
    assert best["mask"] & 1 and best["mask"] & 4 and u.count() == 4
    assert pairs(B.capped(u, 1)) == {(1, 11)}
    index = B.Index(t, ("name", "structured"))
    assert B.guarded(B.probes(q, index)) == {"name": 4, "structured": 1}
    with pytest.raises(B.CandidateExplosion):
        B.guarded(B.probes(q, index), 3)


def test_an_exploding_strategy_is_stopped_and_reported(spark):
    q = frame(spark, [record(1, "acme")])
    t = frame(spark, [record(10 + k, "acme", hn=str(k)) for k in range(4)])
    found, report = B.generate(q, B.Index(t, ("name", "structured", "ngram")), limit=3)
    assert {n: r["status"] for n, r in report.items()} == {"name": "stopped", "structured": "ok", "ngram": "stopped"} and "4 raw pairs" in report["name"]["reason"]
    assert {(r.s1, r.t, r["mask"]) for r in found.collect()} == {(1, 11, 4)}
    found, report = B.generate(q, B.Index(t, ("name",)), limit=0)
    assert found.count() == 0 and report["name"]["raw_pairs"] == 4


def test_chunks_resume_and_refuse_other_settings(spark, tmp_path):
    rows = [record(k, f"n{k % 7} m{k % 5}", hn=str(k % 3)) for k in range(60)]
    q, t, out = frame(spark, rows[:20]), frame(spark, rows[20:]), f"file://{tmp_path}/parts"
    index = B.Index(t, folder=f"file://{tmp_path}/index")
    assert {r["status"] for r in B.generate_chunked(q, index, out, 3).values()} == {"made"}
    import shutil

    whole = {tuple(r) for r in B.capped(B.union_mask(q, t), 200).collect()}
    read = lambda: {(r.s1, r.t, r["mask"]) for r in spark.read.parquet(out).collect()}
    assert read() == whole and len(whole) > 20
    shutil.rmtree(tmp_path / "parts/chunk=1")
    assert [r["status"] for r in B.generate_chunked(q, index, out, 3).values()] == ["kept", "made", "kept"] and read() == whole
    with pytest.raises(tsv.SubmissionError, match="chunks was 3, is 4"):
        B.generate_chunked(q, index, out, 4)
    with pytest.raises(tsv.SubmissionError, match="other settings"):
        B.Index(t, caps=B.Caps(name=5), folder=f"file://{tmp_path}/index")
    with pytest.raises(OSError, match="needed"):
        B.generate_chunked(q, index, f"file://{tmp_path}/other", 2, least_gb=1e9)


def test_results_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(1)
    rows = [record(k, f"n{rng.integers(9)} m{rng.integers(9)}", state=["tx", "", "ny"][rng.integers(3)], hn=str(rng.integers(5))) for k in range(150)]
    q, t = frame(spark, rows[:50]), frame(spark, rows[50:])
    caps = B.Caps(name=2, hn=3, per_entity=4)
    one = {tuple(r) for r in B.capped(B.union_mask(q, t, caps=caps), 4).collect()}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        assert one == {tuple(r) for r in B.capped(B.union_mask(q.repartition(7), t.repartition(5), caps=caps), 4).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_features(spark):
    q = frame(spark, [record(1, "acme one"), record(2, "")])
    t = frame(spark, [record(2_000_000_010, "acme one"), record(3_000_000_011, "acme two", hn="", places=())])
    p = spark.createDataFrame([(1, 2_000_000_010, 5), (1, 3_000_000_011, 1), (2, 2_000_000_010, 4)], "s1 long, t long, mask int")
    x = {(r.s1, r.t): r for r in M.features(p, q, t).collect()}
    same, other, empty = x[1, 2_000_000_010], x[1, 3_000_000_011], x[2, 2_000_000_010]
    assert len(same) - 2 == 47
    assert same.f_name_jw == 1 and same.f_key_eq == 1 and same.f_src == 2 and other.f_src == 3 and same.m_name == 1 and same.m_structured == 1 and same.f_n_strategies == 2
    assert other.f_hn_eq is None and other.f_place_jacc is None and other.f_place_shared == 0 and other.f_name_jw_rank == 2
    assert empty.f_name_jw is None and empty.f_key_eq == 0 and empty.f_tok_jacc is None


def test_rules_and_scores(spark):
    s = spark.createDataFrame([(1, 10, 0.9), (1, 11, 0.9), (1, 12, 0.5), (2, 13, 0.4), (3, 14, 0.95)], "s1 long, t long, p double")
    assert pairs(M.decide(s, M.Rule(0.5))) == {(1, 10), (1, 11), (1, 12), (3, 14)}
    assert pairs(M.decide(s, M.Rule(0.5, top_k=1))) == {(1, 10), (3, 14)}
    assert pairs(M.decide(s, M.Rule(0.5, relative=0.9))) == {(1, 10), (1, 11), (3, 14)}
    truth = spark.createDataFrame([(1, 10), (1, 12)], "s1 long, t long")
    universe = spark.createDataFrame([(1,), (2,), (3,), (4,)], "s1 long")
    r = M.evaluate(M.decide(s, M.Rule(0.5, top_k=1)), truth, universe).first()
    assert r.macro_f05 == pytest.approx((1.25 * 1 * 0.5 / (0.25 + 0.5) + 1 + 0 + 1) / 4, abs=1e-6)
    assert (r.false_positives, r.false_negatives, r.singletons, r.singletons_right) == (1, 1, 3, 2)
    grid = M.search_rules(s, M.rule_grid(spark, [0.5], [0, 1], [0.0]), truth, universe).collect()
    assert {g.top_k: g.macro_f05 for g in grid}[1] == r.macro_f05
    assert tuple(M.forced_matches(M.decide(s, M.Rule(0.5)), s, 0.6).first()) == (1, 0)


def test_model_keeps_nulls_apart(spark):
    rows = [(k, k, float(k % 2), 1.0, 0.9 if k % 2 else None) for k in range(200)]
    x = spark.createDataFrame(rows, "s1 long, t long, label double, weight double, f_a double")
    m = G.train(x, G.GbtParams(trees=3, depth=2, least=1))
    p = {r.s1: r.p for r in G.score(m, x).collect()}
    assert p[1] > 0.7 > 0.3 > p[0]

    class Plug:
        def predict_proba(self, v):
            return np.stack([1 - np.isnan(v[:, 0]), np.isnan(v[:, 0])], axis=1).astype(float)

    assert {r.s1 % 2: r.p for r in G.score_plugin(Plug(), x).collect()} == {0: 1.0, 1: 0.0}
    drop = dict(G.permutation_importance(m, x, ["f_a"]))
    assert drop["f_a"] > 0.1
    assert G.inputs(m) == 1


def test_fixed_trees_score_as_computed_by_hand(spark):
    """One split by one tree: the scores are the logistic of twice the two leaf means."""
    x = spark.createDataFrame([(k, k, float(k % 4 == 0), 1.0, float(k % 2)) for k in range(400)], "s1 long, t long, label double, weight double, f_a double")
    m = G.train(x, G.GbtParams(trees=1, depth=1, least=1, patience=0))
    p = {r.s1 % 2: r.p for r in G.score(m, x).collect()}
    assert p[1] == pytest.approx(1 / (1 + np.exp(2)), abs=1e-6) and p[0] == pytest.approx(0.5, abs=1e-6)


def test_fuzzy_ratios_equal_brute_force():
    from kindred.functions.similarity import matching_share, token_set_share, token_sort_share

    def common(a, b):
        from functools import lru_cache

        @lru_cache(None)
        def f(i, j):
            return 0 if i == len(a) or j == len(b) else 1 + f(i + 1, j + 1) if a[i] == b[j] else max(f(i + 1, j), f(i, j + 1))

        return f(0, 0)

    rng = np.random.default_rng(6)
    for _ in range(300):
        a, b = ("".join(rng.choice([*"ab c"], int(rng.integers(0, 12)))) for _ in "ab")
        want = 100.0 if not a and not b else 200 * common(a, b) / (len(a) + len(b))
        assert matching_share(a, b) == pytest.approx(want)
        u, v = " ".join(sorted(a.split())), " ".join(sorted(b.split()))
        assert token_sort_share(a, b) == pytest.approx(100.0 if not u and not v else 200 * common(u, v) / (len(u) + len(v)))
        x, y = set(a.split()), set(b.split())
        if x and y and (x <= y or y <= x):
            assert token_set_share(a, b) == 100


def test_sources_and_sinks(spark, tmp_path):
    src = tmp_path / "s1.tsv"
    src.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS1-2\t\"Q\" Co\t\tUS\nS1-0001\tB\tx\tUS\n")
    r = tsv.read_records(spark, str(src))
    assert {(x.entity_id, x.id, x.business_name, x.business_address) for x in r.collect()} == {("S1-2", 2, '"Q" Co', None), ("S1-0001", 1, "B", "x")}
    assert tuple(tsv.check_ids(r).first()) == (2, 0, 0)
    gt = tmp_path / "gt.tsv"
    gt.write_text("source1_entity_id\tmatched_entity_ids\nS1-2\tS2-5, S3-7,\nS1-1\t\n")
    assert pairs(tsv.read_truth(spark, str(gt))) == {(2, 2_000_000_005), (2, 3_000_000_007)}
    universe = tsv.read_numbered(spark, str(src)).select("rn", F.col("entity_id").alias("s1"))
    found = spark.createDataFrame([("S1-2", "S3-7"), ("S1-2", "S2-5")], "s1 string, t string")
    m, c = str(tmp_path / "m.tmp"), str(tmp_path / "c.tmp")
    assert tsv.write_id_lists(universe, found, m, "matched_entity_ids") == {"rows": 2, "pairs": 2}
    tsv.write_id_lists(universe, found, c, "candidate_entity_ids")
    assert open(m).read() == "source1_entity_id\tmatched_entity_ids\nS1-2\tS2-5,S3-7\nS1-0001\t\n"
    targets = spark.createDataFrame([("S2-5",), ("S3-7",)], "t string")
    clean = tsv.audit(spark, m, c, universe, targets)
    assert not any(clean.values()), json.dumps(clean)
    worse = str(tmp_path / "worse.tsv")
    open(worse, "w").write(open(m).read() + "S1-9\tS2-5,S2-5, S2-8,\n")
    bad = tsv.audit(spark, worse, c, universe, targets)
    assert bad["matching_unknown_entity"] and bad["matching_repeated_id"] and bad["matching_spaces"] and bad["matching_empty_id"] and bad["matching_not_candidate"]
    with pytest.raises(tsv.SubmissionError):
        tsv.publish(spark, {m: str(tmp_path / "m.tsv")}, [lambda f: (False, {"bad": 1})])
    with pytest.raises(tsv.SubmissionError):
        tsv.publish(spark, {m: str(tmp_path / "other" / "m.tsv")}, [])
    tsv.publish(spark, {m: str(tmp_path / "m.tsv"), c: str(tmp_path / "c.tsv")}, [lambda f: (True, {})])
    assert (tmp_path / "m.tsv").exists() and not (tmp_path / "m.tmp").exists()
    with pytest.raises(tsv.SubmissionError):
        tsv.write_id_lists(universe, found.union(found), m, "x")
    with pytest.raises(tsv.SubmissionError, match="malformed"):
        tsv.write_id_lists(universe, spark.createDataFrame([("S1-2", None)], "s1 string, t string"), m, "x")
    with pytest.raises(tsv.SubmissionError, match="outside"):
        tsv.write_id_lists(universe, spark.createDataFrame([("S1-7", "S2-5")], "s1 string, t string"), m, "x")


KINDS = [
    ("S1-2\tS2-5\r", "crlf"), ("S1-2", "no_tab"), ("S1-2\tS2-5\tx", "extra_columns"), ("S1-2\tS2-5\nS1-2\t", "repeated_entity"), ("T1-2\tS2-5", "malformed_entity"), ("S1-8\tS2-5", "unknown_entity"),
    ("S1-2\tnan", "artefact"), ("S1-2\tS2-5,,S3-7", "empty_id"), ("S1-2\tS2-5,S2-5", "repeated_id"), ("S1-2\tS4-5", "malformed_id"), ("S1-2\tS2-005", "unknown_target"), ("S1-2\tS2-5, S3-7", "spaces"), ("", "missing_entity"),
]


def test_audit_tells_each_kind(spark, tmp_path):
    universe, targets = spark.createDataFrame([("S1-2",)], "s1 string"), spark.createDataFrame([("S2-5",), ("S3-7",)], "t string")
    good = tmp_path / "c.tsv"
    good.write_text("source1_entity_id\tcandidate_entity_ids\nS1-2\tS2-5,S3-7\n")
    for k, (line, kind) in enumerate(KINDS):
        f = tmp_path / f"m{k}.tsv"
        f.write_bytes(f"source1_entity_id\tmatched_entity_ids\n{line}\n".encode())
        found = tsv.audit(spark, str(f), str(good), universe, targets)
        assert found[f"matching_{kind}"] > 0, (kind, found)
    f = tmp_path / "whole.tsv"
    for raw, kind in ((b"", "empty_file"), (b"\xef\xbb\xbfsource1_entity_id\tmatched_entity_ids\nS1-2\t\n", "bom"), (b"a\tb\nS1-2\t\n", "header"), (b"source1_entity_id\tmatched_entity_ids\nS1-2\t", "end"), (b"source1_entity_id\tmatched_entity_ids\nS1-2\t\xff\n", "not_utf8")):
        f.write_bytes(raw)
        assert tsv.audit(spark, str(f), str(good), universe, targets)[f"matching_{kind}"] > 0, kind


def test_sources(spark, tmp_path):
    from kindred.sources import files

    a, b = tmp_path / "a.tsv", tmp_path / "b.tsv"
    a.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS2-1\tx\ty\tUS\n")
    b.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\nS3-1\tx\ty\tUS\n\nS3-2\tz\t\t\n")
    both = tsv.read_records(spark, [str(a), str(b)])
    assert sorted(r.id for r in both.collect()) == [2_000_000_001, 3_000_000_001, 3_000_000_002]
    assert {r.id for r in tsv.first_column(spark, [str(a), str(b)]).collect()} == {"S2-1", "S3-1", "S3-2"} and tsv.check_load(spark, str(b), tsv.read_records(spark, str(b))) == 2
    with pytest.raises(tsv.SubmissionError):
        tsv.check_load(spark, str(b), both)
    with pytest.raises(tsv.SubmissionError):
        tsv.checked_ids(both.union(both))
    with pytest.raises(ValueError, match="not one file"):
        tsv.read_numbered(spark, str(tmp_path))
    n = tmp_path / "n.csv"
    n.write_text("id;share\n1;0.5\n2;1\n")
    assert tsv.sniffed(spark, str(n)) == ";" and [tuple(r) for r in tsv.described(spark, str(n)).collect()] == [("id", "int"), ("share", "double")]
    files.write_json(spark, str(tmp_path / "m.json"), {"a": float("nan"), "b": [1, 2.5]})
    assert files.read_json(spark, str(tmp_path / "m.json")) == {"a": None, "b": [1, 2.5]}
    tsv.write_report(spark.createDataFrame([(1, "x,y"), (2, None)], "n int, t string"), str(tmp_path / "r.csv"))
    assert (tmp_path / "r.csv").read_text().splitlines() == ["n,t", '1,"x,y"', "2,"]
    shards = {r.shard: r.lines for r in tsv.write_shards(spark, str(b), str(tmp_path / "shards"), 3).collect()}
    assert sum(shards.values()) == 4
    big = tmp_path / "big.tsv"
    big.write_text("entity_id\tbusiness_name\tbusiness_address\tcountry\n" + "".join(f"S1-{k}\tname {k}\t\t\n" for k in range(9000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = tsv.read_numbered(spark, str(big)).orderBy("rn").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.entity_id for r in rows] == [f"S1-{k}" for k in range(9000)]


def test_tables_say_how_they_were_made(spark, tmp_path):
    x, place = spark.range(5), f"file://{tmp_path}/t"
    assert tsv.materialise(x, place, settings={"a": 1}).count() == 5 and tsv.materialise(spark.range(9), place, settings={"a": 1}).count() == 5
    with pytest.raises(tsv.SubmissionError, match="a was 1, is 2"):
        tsv.materialise(x, place, settings={"a": 2})
    tsv.materialise(x, f"{place}2")
    with pytest.raises(tsv.SubmissionError, match="does not say"):
        tsv.materialise(x, f"{place}2", settings={"a": 1})
    rows = frame(spark, [record(1, "a"), record(2, "b")]).withColumn("entity_id", F.lit("S1-1"))
    assert tsv.text_side_table(rows, 2, f"{place}3").count() == 2
    for source, n in ((rows, 3), (rows.union(rows), 4)):
        with pytest.raises(tsv.SubmissionError):
            tsv.text_side_table(source, n, f"{place}-{n}")


def plug(low=0.1):
    """Any object that scores a matrix of features; its class goes to workers by value."""

    class Plug:
        def __init__(self, low):
            self.low = low

        def predict_proba(self, v):
            p = np.where(np.isnan(v[:, 3]), self.low, np.nan_to_num(v[:, 3]))
            return np.stack([1 - p, p], axis=1)

    return Plug(low)


def test_inference_resumes_and_refuses_other_settings(spark, tmp_path):
    import shutil

    from kindred.plans import link

    rows = [record(k, f"n{k % 7} m{k % 5}", hn=str(k % 3)) for k in range(60)]
    q, t, out = (frame(spark, r).withColumn("entity_id", F.lit("")) for r in (rows[:20], rows[20:])), None, f"file://{tmp_path}/pred"
    q, t = q
    p = B.union_mask(q.drop("entity_id"), t.drop("entity_id"))
    whole = {tuple(r) for r in M.decide(G.score_plugin(plug(), M.features(p, q.drop("entity_id"), t.drop("entity_id"))), M.Rule(0.9, 2)).collect()}
    run = lambda **k: link.infer_chunked(**{"model": plug(), "rule": M.Rule(0.9, 2), "pairs": p, "query": q, "targets": t, "out": out, "chunks": 3, "score": G.score_plugin} | k)
    assert run() == {"made": 3, "kept": 0, "predicted": len(whole)} and {tuple(r) for r in link.predictions(spark, out).collect()} == whole and whole
    shutil.rmtree(tmp_path / "pred/part=2")
    assert run() == {"made": 1, "kept": 2, "predicted": len(whole)}
    for other in ({"rule": M.Rule(0.8, 2)}, {"chunks": 4}, {"model": plug(0.2)}):
        with pytest.raises(tsv.SubmissionError, match="other settings"):
            run(**other)


def test_stream_equals_batch(spark, tmp_path):
    from kindred.streaming.incremental import candidates_stream

    q, t = frame(spark, [record(1, "acme"), record(2, "beta")]), frame(spark, [record(10, "acme"), record(11, "beta")])
    q.write.parquet(str(tmp_path / "in"))
    live = spark.readStream.schema(q.schema).parquet(str(tmp_path / "in"))
    candidates_stream(live, t, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(120)
    assert pairs(spark.read.parquet(str(tmp_path / "out"))) == pairs(B.capped(B.union_mask(q, t), 200))


def repeated_parts(spark, small, path, times: int) -> str:
    """A folder whose parts are those of ``small``, repeated with shifted keys."""
    part = spark.read.parquet(f"{small}/part.parquet")
    more = part.crossJoin(spark.range(times).withColumnRenamed("id", "k")).withColumn("p_partkey", F.col("p_partkey") + F.col("k") * 200)
    more.drop("k").write.parquet(f"{path}/part.parquet")
    return str(path)


def test_classes_give_the_pairs_and_features_of_records(spark, small, tmp_path):
    """every pair moved with the columns of both records; what is the same for two classes is computed once."""
    from kindred.sources.adapters import parts

    q, t = parts(spark, repeated_parts(spark, small, tmp_path, 6))
    caps = B.Caps(gram_top=4, gram_shared=2, name=2, name_state=9, phonetic=1, phonetic_state=1, compound=3)
    whole = M.features(B.union_mask(q, t, caps=caps), q, t)
    a, b = B.Alike(q), B.Alike(t)
    pairs = B.class_masks(a, b, caps=caps)
    made = M.features_of_classes(M.class_features(pairs, a, b), a, b)
    assert made.columns == ["s1", "t", *M.FEATURES]
    rows = lambda x: sorted(tuple(r) for r in x.select("s1", "t", *(F.coalesce(F.col(c), F.lit(-1.0)).alias(c) for c in M.FEATURES)).collect())
    found = rows(made)
    assert found == rows(whole) and 0 < 4 * pairs.count() < len(found)


def test_pairs_are_counted_by_class(spark, small, tmp_path):
    """counts were taken from pairs made one by one."""
    from kindred.plans import diagnostics, link, linkage
    from kindred.sources.adapters import part_truth

    sf = repeated_parts(spark, small, tmp_path, 6)
    x = linkage.pair_features(spark, sf).join(part_truth(spark, sf).withColumn("label", F.lit(1)), ["s1", "t"], "left")
    want = x.groupBy(F.coalesce("label", F.lit(0)), F.coalesce(link.hard_negative().cast("string"), F.lit("unknown"))).count()
    made = diagnostics.hard_negative_counts(spark, sf)
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, want.collect()))
    assert made.agg(F.sum("pairs")).first()[0] == linkage.cand_union_mask(spark, sf).count()


def test_trees_read_written_rows(spark, small, monkeypatch):
    """each pass of the fit made candidates and features anew."""
    from kindred.plans import linkage

    seen = []
    monkeypatch.setattr(linkage.gbt, "train", lambda rows: seen.append(rows))
    monkeypatch.setattr(linkage.gbt, "score", lambda model, rows: rows.withColumn("p", F.lit(0.5)))
    rows = linkage.gbt_scores(spark, small)
    assert all("/rows" in f for f in seen[0].inputFiles()) and rows.inputFiles()
    plain = linkage.pair_features(spark, small)
    assert rows.count() == plain.count() and set(M.FEATURES) | {"label", "weight"} <= set(seen[0].columns)
    assert rows.where("label = 1").count() == rows.join(linkage.part_truth(spark, small), ["s1", "t"], "left_semi").count()


def test_scores_are_made_by_kind(spark, small, tmp_path, monkeypatch):
    """F1: trees were fitted on, and scores made from, a row of features for each pair."""
    from kindred.functions.columns import stable_bucket
    from kindred.plans import linkage

    sf, seen = repeated_parts(spark, small, tmp_path, 6), []
    mark = F.abs(F.xxhash64(*M.FEATURES, "label")) % 1000
    monkeypatch.setattr(linkage.gbt, "train", lambda rows: seen.append(rows))
    monkeypatch.setattr(linkage.gbt, "score", lambda model, rows: rows.select("s1", "t", "mask", "near", "label", mark.alias("p")))
    made = linkage.gbt_scores(spark, sf)
    q, t = linkage.alike(spark, sf)
    whole = M.features_of_classes(linkage.class_features(q, t, label=linkage.truth_label().cast("double")), q, t, ("label",)).withColumn("p", mark.cast("double"))
    assert sorted(map(tuple, made.select("s1", "t", "label", "p").collect())) == sorted(map(tuple, whole.select("s1", "t", "label", "p").collect()))
    fit = whole.where(stable_bucket(F.col("s1"), 42, 100) >= 20)
    by = lambda x, held, n: {tuple(r) for r in x.groupBy("label", held).agg(n).collect()}
    assert by(seen[0], "held", F.sum("weight").cast("long")) == by(fit.withColumn("held", G.held_out(F.col("s1"))), "held", F.count("*"))
    assert 0 < 2 * seen[0].count() < fit.count()


def test_trees_of_grouped_rows_are_those_of_pairs(spark):
    """a node's least number of pairs and its errors count the pairs that a row stands for."""
    x = spark.range(4000).select(F.col("id").alias("s1"), F.col("id").alias("t"), (F.col("id") % 7).cast("float").alias("f_a"), F.when(F.col("id") % 5 > 0, F.col("id") % 3).cast("float").alias("f_b"), ((F.col("id") * 31) % 97 < 5 * (F.col("id") % 7) + 20 * (F.col("id") % 3)).cast("double").alias("label"))
    held = G.held_out(F.col("s1"))
    g = G.grouped(x.withColumns({"fit": (~held).cast("long"), "held": held.cast("long")}))
    assert g.count() <= 7 * 4 * 2 * 2
    for least in (40, 300, 3000):
        params = G.GbtParams(trees=4, depth=3, least=least)
        one, other = (G.score(G.train(rows, params), x) for rows in (x.withColumn("weight", F.lit(1.0)), g))
        a, b = ({r.s1: r.p for r in p.collect()} for p in (one, other))
        assert a.keys() == b.keys() and max(abs(a[k] - b[k]) for k in a) < 1e-9 and (len(set(a.values())) > 1) == (least < 3000)


def test_trigram_join_loses_no_names(spark):
    """only four grams of a name, none that many targets have, and twenty targets were looked at."""
    import itertools
    import random

    rng = random.Random(5)
    names = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(0, 14))) for _ in range(150)})
    q = frame(spark, [record(k, n, country="us" if k % 3 else "in") for k, n in enumerate(names[::2] * 2)])
    t = frame(spark, [record(1000 + k, n, country="us" if k % 3 else "in") for k, n in enumerate(names[1::2] + names[::4] + names[60:61] * 40)]).unionByName(frame(spark, [(2000, "us", *[None] * 15), (2001, "us", *[None] * 15)]))
    whole = lambda n: {f"#{n}#"[i : i + 3] for i in range(len(n))}
    alike = lambda a, b: len(whole(a) & whole(b)) / len(whole(a) | whole(b)) if a and b else 0
    left, right = q.select("id", "country", "name_key").collect(), t.select("id", "country", "name_key").collect()
    want = {(a.id, b.id): alike(a.name_key, b.name_key) for a, b in itertools.product(left, right) if a.country == b.country}
    want = {k: round(v, 9) for k, v in want.items() if v >= 0.35}
    got = B.trigram_join(q, t).collect()
    assert {(r.s1, r.t): round(r.similarity, 9) for r in got} == want and len(got) == len(want)
    assert max(sum(a == s for a, _ in want) for s, _ in want) > 20
    rows = [tuple(r) for r in B.trigram_classes(q, t).collect()]
    of = {kind: {a: b for k, a, b, _ in rows if k == kind} for kind in ("query", "target")}
    assert set(of["query"]) == {r.id for r in left} and set(of["target"]) == {r.id for r in right} and of["target"][2001] == of["target"][2000]
    pairs_of = {(a, b): s for k, a, b, s in rows if k == "pair"}
    assert {(a.id, b.id): round(pairs_of[of["query"][a.id], of["target"][b.id]], 9) for a, b in itertools.product(left, right) if (of["query"][a.id], of["target"][b.id]) in pairs_of} == want
    assert len(pairs_of) < len(want) and len(rows) == len(pairs_of) + len(left) + len(right)
