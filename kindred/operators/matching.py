"""Pair features, decision rules, evaluation and gates."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kindred.functions.columns import ID_SPAN, byte_levenshtein, grams, jaccard
from kindred.functions.similarity import jaro_winklers
from kindred.operators.blocking import BITS, Alike, frequency, kinds, spelled_out

#: The feature columns in their order: what a model reads.
FEATURES = (
    "f_name_lc_eq f_key_eq f_keys_overlap f_name_jw f_name_lev f_core_jw f_raw_jw f_tok_jacc f_tok_shared f_tok_contain f_phon_eq f_phon_jacc f_gram_jacc f_len_diff f_ntok_diff "
    "f_a_indic f_b_indic f_script_mismatch f_key_freq_log f_a_addr_missing f_b_addr_missing f_both_addr_missing f_state_eq f_hn_eq f_hn_absdiff_log f_street_eq f_street_jw "
    "f_place_jacc f_place_shared f_addr_jacc f_addr_shared f_num_jacc f_num_shared f_src m_name m_phonetic m_structured m_rare_name m_rare_addr m_ngram m_compound f_n_strategies "
    "f_n_cands_log f_name_jw_rank f_name_jw_gap f_addr_jacc_rank f_addr_jacc_gap"
).split()
MASKED = ("name", "phonetic", "structured", "rare_name", "rare_addr", "ngram", "compound")


def both_present(a: str, b: str, value: Column) -> Column:
    """``value`` where both texts are there, else null."""
    return F.when((F.coalesce(F.col(a), F.lit("")) != "") & (F.coalesce(F.col(b), F.lit("")) != ""), value)


#: Features that records of one class need not have alike.
OF_RECORDS = ("f_a_indic", "f_b_indic", "f_script_mismatch", "f_a_addr_missing", "f_b_addr_missing", "f_both_addr_missing", "f_src", *(f"m_{n}" for n in MASKED), "f_n_strategies")


def flag(c: Column) -> Column:
    return F.coalesce(c, F.lit(False)).cast("int")


def both_sides(pairs: DataFrame, s1: DataFrame, targets: DataFrame, a_id: str, b_id: str) -> DataFrame:
    """Pairs with the columns of both records, as a_ and b_, and the number of targets of b's country and name."""
    side = lambda x, p: x.select(*(F.col(c).alias(f"{p}_{c}") for c in x.columns))
    a, b = side(s1, "a"), side(targets, "b")
    known = frequency(targets.withColumn("k", F.col("name_key")).where("k <> ''"), "country", "k").withColumnRenamed("n", "freq")
    b = b.join(known, (b.b_country == known.country) & (b.b_name_key == known.k), "left").drop("country", "k")
    return pairs.join(a, pairs[a_id] == a.a_id).join(b, pairs[b_id] == b.b_id)


def compared(x: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """Pairs of ``both_sides`` with their similarities, and the features that follow from the records but for ``OF_RECORDS``.

    Distinct pairs of strings are compared once in a batch, in one pass for all four similarities.
    """
    compared = {"f_name_jw": "name_key", "f_core_jw": "core", "f_raw_jw": "name_lc", "f_street_jw": "street"}
    x = x.withColumn("jw", jaro_winklers(**{n: (f"a_{c}", f"b_{c}") for n, c in compared.items()}))
    x = x.withColumns({n: both_present(f"a_{c}", f"b_{c}", F.col(f"jw.{n}")) for n, c in compared.items()})
    size = lambda c: F.size(F.col(c)).cast("double")
    shared = lambda c: F.size(F.array_intersect(f"a_{c}", f"b_{c}"))
    jacc = lambda c: jaccard(F.col(f"a_{c}"), F.col(f"b_{c}"))
    equal = lambda c: both_present(f"a_{c}", f"b_{c}", (F.col(f"a_{c}") == F.col(f"b_{c}")).cast("int"))
    longest = F.greatest(F.octet_length("a_name_key"), F.octet_length("b_name_key"))
    return x, {
        "f_name_lc_eq": flag(F.col("a_name_lc") == F.col("b_name_lc")),
        "f_key_eq": flag((F.col("a_name_key") == F.col("b_name_key")) & (F.col("a_name_key") != "")),
        "f_keys_overlap": flag(F.arrays_overlap("a_keys", "b_keys")),
        "f_name_jw": F.col("f_name_jw"),
        "f_name_lev": both_present("a_name_key", "b_name_key", 1 - byte_levenshtein(F.col("a_name_key"), F.col("b_name_key")) / longest),
        "f_core_jw": F.col("f_core_jw"),
        "f_raw_jw": F.col("f_raw_jw"),
        "f_tok_jacc": jacc("name_tokens"),
        "f_tok_shared": shared("name_tokens"),
        "f_tok_contain": F.when((F.size("a_name_tokens") > 0) & (F.size("b_name_tokens") > 0), shared("name_tokens") / F.least(size("a_name_tokens"), size("b_name_tokens"))),
        "f_phon_eq": equal("phon_key"),
        "f_phon_jacc": jacc("phon_tokens"),
        "f_gram_jacc": jaccard(grams(F.col("a_name_key")), grams(F.col("b_name_key"))),
        "f_len_diff": F.abs(F.length("a_name_key") - F.length("b_name_key")),
        "f_ntok_diff": F.abs(F.size("a_name_tokens") - F.size("b_name_tokens")),
        "f_key_freq_log": F.log1p(F.coalesce("freq", F.lit(0))),
        "f_state_eq": equal("state"),
        "f_hn_eq": equal("hn"),
        "f_hn_absdiff_log": F.log1p(F.abs(F.expr("try_cast(a_hn AS bigint)") - F.expr("try_cast(b_hn AS bigint)"))),
        "f_street_eq": equal("street"),
        "f_street_jw": F.col("f_street_jw"),
        "f_place_jacc": jacc("places"),
        "f_place_shared": shared("places"),
        "f_addr_jacc": jacc("addr_tokens"),
        "f_addr_shared": shared("addr_tokens"),
        "f_num_jacc": jacc("numbers"),
        "f_num_shared": shared("numbers"),
    }


def of_records() -> dict[str, Column]:
    """``OF_RECORDS``, from the mask, t and the own columns of both records."""
    return {
        "f_a_indic": flag(F.col("a_name_indic")),
        "f_b_indic": flag(F.col("b_name_indic")),
        "f_script_mismatch": flag(F.col("a_name_indic") != F.col("b_name_indic")),
        "f_a_addr_missing": flag(F.col("a_addr_missing")),
        "f_b_addr_missing": flag(F.col("b_addr_missing")),
        "f_both_addr_missing": flag(F.col("a_addr_missing") & F.col("b_addr_missing")),
        "f_src": F.expr(f"t div {ID_SPAN}"),
        **{f"m_{n}": (F.col("mask").bitwiseAND(BITS[n]) > 0).cast("int") for n in MASKED},
        "f_n_strategies": F.bit_count("mask"),
    }


def features(pairs: DataFrame, s1: DataFrame, targets: DataFrame) -> DataFrame:
    """47 columns for each pair (s1, t, mask): null means that a side is missing.

    Records as for blocking, and name_lc (raw name in lower case), name_indic, addr_missing and
    core. The windows over s1 share one exchange.
    """
    x, made = compared(both_sides(pairs, s1, targets, "s1", "t"))
    made |= of_records()
    x = x.select("s1", "t", *(made[n].cast("float").alias(n) for n in FEATURES if n in made))
    group = W.partitionBy("s1")
    ranked = {"f_n_cands_log": F.log(F.count("*").over(group))}
    for short, c in (("f_name_jw", "f_name_jw"), ("f_addr_jacc", "f_addr_jacc")):
        ranked[f"{short}_rank"] = F.rank().over(group.orderBy(F.col(c).desc_nulls_last()))
        ranked[f"{short}_gap"] = F.max(c).over(group) - F.col(c)
    return x.select("*", *(c.cast("float").alias(n) for n, c in ranked.items()))


def class_features(pairs: DataFrame, query: Alike, targets: Alike, **more: Column) -> DataFrame:
    """The features of pairs of classes (q, cls, mask, near) but for ``OF_RECORDS``, copies (queries of q) and found (targets of cls), and ``more`` columns of the records, a_ and b_.

    A row stands for ``found`` pairs of each query of q, which ranks and counts over its pairs take in.
    """
    x, made = compared(both_sides(pairs, query.heads, targets.heads, "q", "cls"))
    found = F.when(F.col("mask").isNotNull(), F.col("b_copies")).otherwise(F.array_size("near")).cast("long")
    x = x.select("q", "cls", "mask", "near", F.col("a_copies").alias("copies"), found.alias("found"), *(c.alias(n) for n, c in more.items()), *(c.cast("float").alias(n) for n, c in made.items()))
    group = W.partitionBy("q")
    ranked = {"f_n_cands_log": F.log(F.sum("found").over(group))}
    for c in ("f_name_jw", "f_addr_jacc"):
        ranked[f"{c}_rank"] = 1 + F.sum("found").over(group.orderBy(F.col(c).desc_nulls_last())) - F.sum("found").over(W.partitionBy("q", c))
        ranked[f"{c}_gap"] = F.max(c).over(group) - F.col(c)
    return x.select("*", *(c.cast("float").alias(n) for n, c in ranked.items()))


def features_of_classes(found: DataFrame, query: Alike, targets: Alike, further: tuple[str, ...] = ()) -> DataFrame:
    """(s1, t, features, further columns) of each pair, from ``class_features``; a feature's type is kept."""
    x = spelled_out(found.drop("copies", "found"), query, targets)
    own = of_records()
    return x.select("s1", "t", *((own[n].cast(found.schema["f_name_jw"].dataType) if n in own else F.col(n)).alias(n) for n in FEATURES), *further)


def target_kinds(targets: Alike) -> DataFrame:
    """``kinds`` of targets, whose source is a feature."""
    return kinds(targets, F.expr(f"id div {ID_SPAN}"))


def features_of_kinds(found: DataFrame, query: DataFrame, targets: DataFrame, further: tuple[str, ...] = (), **counts: Column) -> DataFrame:
    """(s1, t, mask, near, features, further columns, counts) of pairs of kinds, from ``class_features`` and the ``kinds`` of both sides.

    A row stands for all pairs of query kind s1 and target kind t that ``pairs_of_kinds`` makes of it;
    ``counts``: what to sum up over the queries, then times the row's targets.
    """
    owned = lambda x: [c for c in x.columns if c not in ("id", "cls", "kind")]
    a = query.groupBy(F.col("cls").alias("q"), F.col("kind").alias("s1"), *(F.col(c).alias(f"a_{c}") for c in owned(query))).agg(*(c.alias(n) for n, c in counts.items()))
    b = targets.groupBy("cls", F.col("kind").alias("t"), *(F.col(c).alias(f"b_{c}") for c in owned(targets))).agg(F.count("*").alias("members"))
    x = found.drop("copies", "found").join(b, "cls")

    def of_kind(m: Column) -> Column:
        same = F.floor(m["t"] / ID_SPAN) == F.floor(F.col("t") / ID_SPAN)
        for c in owned(targets):
            same &= m[c].eqNullSafe(F.col(f"b_{c}"))
        return same

    near = F.coalesce(F.transform(F.filter("near", of_kind), lambda m: m["t"]), F.array().cast("array<bigint>"))
    x = x.withColumn("near", near)
    part = lambda mask, n: F.struct(mask.alias("mask"), n.cast("long").alias("n"))
    plain = F.when(F.col("mask").isNotNull(), part(F.col("mask"), F.col("members") - F.size("near")))
    listed = part(F.coalesce("mask", F.lit(0)).bitwiseOR(BITS["ngram"]), F.size("near"))
    x = x.withColumn("part", F.explode(F.filter(F.array(plain, listed), lambda p: p["n"] > 0))).drop("mask").select("*", "part.mask", "part.n").join(a, "q")
    own = of_records()
    kind = found.schema["f_name_jw"].dataType
    return x.select("s1", "t", "mask", "near", *((own[n].cast(kind) if n in own else F.col(n)).alias(n) for n in FEATURES), *further, *((F.col(n) * F.col("n")).alias(n) for n in counts))


@dataclass(frozen=True)
class Rule:
    """Keep p >= threshold and, if set, the top_k best and those within ``relative`` of the best; 0 means not set."""

    threshold: float
    top_k: int = 0
    relative: float = 0.0


def decide(scores: DataFrame, rule: Rule) -> DataFrame:
    group = W.partitionBy("s1")
    x = scores.withColumn("rank", F.row_number().over(group.orderBy(F.desc("p"), "t"))).withColumn("most", F.max("p").over(group))
    keep = F.col("p") >= rule.threshold
    if rule.top_k:
        keep &= F.col("rank") <= rule.top_k
    if rule.relative:
        keep &= F.col("p") >= rule.relative * F.col("most")
    return x.where(keep).select("s1", "t", "p")


def rule_grid(spark, thresholds, top_ks, relatives) -> DataFrame:
    return spark.createDataFrame([(float(t), int(k), float(r)) for t in thresholds for k in top_ks for r in relatives], "threshold double, top_k int, relative double")


def f05(n_true: Column, n_pred: Column, hits: Column) -> Column:
    """Entity F0.5; an entity without truth scores 1 if nothing is predicted for it."""
    p, r = hits / F.nullif(n_pred, F.lit(0)), hits / F.nullif(n_true, F.lit(0))
    return F.when(n_true == 0, (n_pred == 0).cast("double")).when((n_pred == 0) | (hits == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def entity_counts(predicted: DataFrame, truth: DataFrame, universe: DataFrame, *by: str) -> DataFrame:
    """(by, s1, n_true, n_pred, hits) for every s1 of the universe (with the columns ``by``)."""
    real = truth.groupBy("s1").agg(F.count("*").alias("n_true"))
    made = predicted.join(truth.select("s1", "t", F.lit(1).alias("hit")), ["s1", "t"], "left").groupBy(*by, "s1").agg(F.count("*").alias("n_pred"), F.count("hit").alias("hits"))
    zero = F.lit(0).cast("long")
    return universe.join(real, "s1", "left").join(made, [*by, "s1"], "left").select(*by, "s1", *(F.coalesce(c, zero).alias(c) for c in ("n_true", "n_pred", "hits")))


def evaluate(predicted: DataFrame, truth: DataFrame, universe: DataFrame, *by: str) -> DataFrame:
    """Macro F0.5, pair precision and recall, errors and singletons over the universe."""
    n = entity_counts(predicted, truth, universe, *by)
    s = F.sum
    return n.groupBy(*by).agg(
        F.count("*").alias("entities"),
        F.round(F.avg(f05(F.col("n_true"), F.col("n_pred"), F.col("hits"))), 6).alias("macro_f05"),
        F.round(F.try_divide(s("hits"), s("n_pred")), 6).alias("pair_precision"),
        F.round(F.try_divide(s("hits"), s("n_true")), 6).alias("pair_recall"),
        (s("n_pred") - s("hits")).alias("false_positives"),
        (s("n_true") - s("hits")).alias("false_negatives"),
        F.count_if(F.col("n_true") == 0).alias("singletons"),
        F.count_if((F.col("n_true") == 0) & (F.col("n_pred") == 0)).alias("singletons_right"),
    )


def search_rules(scores: DataFrame, rules: DataFrame, truth: DataFrame, universe: DataFrame) -> DataFrame:
    """All rules in one job: the scores meet the (few, broadcast) rules, ranks are taken once.

    Only entities with a prediction become rows; those without one add to a rule by their counts,
    which are the same for all rules.
    """
    group = W.partitionBy("s1")
    x = scores.withColumn("rank", F.row_number().over(group.orderBy(F.desc("p"), "t"))).withColumn("most", F.max("p").over(group))
    grid, by = F.broadcast(rules), ["threshold", "top_k", "relative"]
    kept = x.join(grid, (F.col("p") >= F.col("threshold")) & ((F.col("top_k") == 0) | (F.col("rank") <= F.col("top_k"))) & ((F.col("relative") == 0) | (F.col("p") >= F.col("relative") * F.col("most"))))
    made = kept.join(truth.select("s1", "t", F.lit(1).alias("hit")), ["s1", "t"], "left").groupBy("s1", *by).agg(F.count("*").alias("n_pred"), F.count("hit").alias("hits"))
    real = universe.join(truth.groupBy("s1").agg(F.count("*").alias("n_true")), "s1", "left").withColumn("n_true", F.coalesce("n_true", F.lit(0).cast("long")))
    n = made.join(real, "s1")
    told = n.groupBy(*by).agg(F.sum(f05(F.col("n_true"), F.col("n_pred"), F.col("hits"))).alias("score"), F.sum("n_pred").alias("predicted"), F.sum("hits").alias("found"), F.count_if(F.col("n_true") == 0).alias("wrong_singletons"))
    whole = real.agg(F.count("*").alias("entities"), F.sum("n_true").alias("true_pairs"), F.count_if(F.col("n_true") == 0).alias("singletons"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    y = rules.join(told, by, "left").join(F.broadcast(whole))
    right = F.col("singletons") - zero("wrong_singletons")
    return y.select(
        *by,
        "entities",
        F.round(F.try_divide(F.coalesce("score", F.lit(0.0)) + right, F.col("entities")), 6).alias("macro_f05"),
        F.round(F.try_divide(zero("found"), zero("predicted")), 6).alias("pair_precision"),
        F.round(F.try_divide(zero("found"), F.col("true_pairs")), 6).alias("pair_recall"),
        (zero("predicted") - zero("found")).alias("false_positives"),
        (F.coalesce("true_pairs", F.lit(0).cast("long")) - zero("found")).alias("false_negatives"),
        "singletons",
        right.alias("singletons_right"),
    )


def recall_by(pairs: DataFrame, truth: DataFrame, query: DataFrame, *by: str) -> DataFrame:
    """(by, source, true_pairs, found, recall): recall of candidates by columns of the query record and the source of the target."""
    x = truth.join(query.select(F.col("id").alias("s1"), *by), "s1").join(pairs.select("s1", "t", F.lit(1).alias("hit")), ["s1", "t"], "left")
    return x.groupBy(*by, F.expr(f"t div {ID_SPAN}").alias("source")).agg(F.count("*").alias("true_pairs"), F.count("hit").alias("found"), F.round(F.avg(F.coalesce("hit", F.lit(0))), 6).alias("recall"))


def candidate_statistics(pairs: DataFrame, universe: DataFrame) -> DataFrame:
    n = universe.join(pairs.groupBy("s1").agg(F.count("*").alias("n")), "s1", "left").select(F.coalesce("n", F.lit(0)).alias("n"))
    return n.agg(F.count("*").alias("entities"), F.sum("n").cast("long").alias("pairs"), F.round(F.avg("n"), 6).alias("average"), F.round(F.percentile("n", F.lit(0.5)), 6).alias("p50"), F.round(F.percentile("n", F.lit(0.95)), 6).alias("p95"), F.max("n").alias("most"), F.count_if(F.col("n") == 0).alias("without"))


def candidate_recall(pairs: DataFrame, truth: DataFrame) -> DataFrame:
    """Recall over all and by strategy, in one pass over the truth joined with the masks."""
    x = truth.join(pairs, ["s1", "t"], "left").withColumn("mask", F.coalesce("mask", F.lit(0)))
    return x.agg(F.count("*").alias("true_pairs"), F.count_if(F.col("mask") > 0).alias("found"), *(F.count_if(F.col("mask").bitwiseAND(b) > 0).alias(f"found_{n}") for n, b in BITS.items()))


def forced_matches(predicted: DataFrame, pairs: DataFrame, threshold: float) -> DataFrame:
    """Gate: predictions below the threshold, and those that are no candidates. Both must be 0."""
    below = predicted.agg(F.count_if(F.col("p") < threshold).alias("below_threshold"))
    outside = predicted.join(pairs, ["s1", "t"], "left_anti").agg(F.count("*").alias("not_candidates"))
    return below.join(outside)


def id_lists(universe: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s1, ids): the targets of each s1 as one sorted comma list, empty if none."""
    ids = pairs.groupBy("s1").agg(F.array_join(F.sort_array(F.collect_list(F.col("t").cast("string"))), ",").alias("ids"))
    return universe.join(ids, "s1", "left").select("s1", F.coalesce("ids", F.lit("")).alias("ids"))
