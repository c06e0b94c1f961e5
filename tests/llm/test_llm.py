import re
import time
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

pytest.importorskip("kindred.llm")

from kindred.llm import components as K
from kindred.llm import decontaminate, gif_media, html_blocks, jaccard_join, langid, lm_scoring, quality_knn, quote_chat, token_counts, trie_bpe
from kindred.llm.queries import ORACLES_TABLES, oracle_sql, queries, vocabulary
from kindred.llm.shared import Scratch

LONG = "alpha beta gamma delta " * 30_000
TEXTS = [None, "", " \t\n", "word", "Two words", "déjà vu <|endoftext|> it's 🙂", LONG, "same text again here now", "same text again here now", "***"]
DOCS = "doc_id long, text string, score string, n_tokens string, extra int, held_out string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, repeated rows, a null id, and columns with clashing names."""
    rows = [(k, t, "s", "n", None, None) for k, t in enumerate(TEXTS)] + [(None, "no id", None, None, 1, "h"), (3, "word", "s", "n", None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def by_text(df, column="text"):
    return {r[column]: r for r in df.collect()}


# ---- 1

def test_scoring_equals_brute_force(spark):
    rows = [(1, "a b a b", True), (2, "b c", False), (3, None, None), (4, "c c a b", True), (5, "zz", False), (6, "b c", True), (7, "b c", None), (8, "zz zz zz", True)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    s = lm_scoring.LmSettings()
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(docs.repartition(3), "good", s).collect()}

    def fit(texts):
        one, two = {}, {}
        for t in texts:
            w = t.split()
            for k, x in enumerate(w):
                one[x] = one.get(x, 0) + 1
                if k:
                    two[w[k - 1], x] = two.get((w[k - 1], x), 0) + 1
        return one, two

    v = len({w for _, t, _ in rows for w in (t or "").split()})

    def loss(model, text):
        one, two = model
        out = []
        for k, w in enumerate(x := text.split()):
            p = (one.get(w, 0) + s.alpha) / (sum(one.values()) + s.alpha * v)
            if k:
                p = (two.get((x[k - 1], w), 0) + s.beta * p) / (one.get(x[k - 1], 0) + s.beta)
            out.append(-np.log(p))
        return np.mean(out)

    for k, t, mine in rows:
        if t:  # a document's own counts are left out
            base, goal = fit([u for i, u, _ in rows if u and i != k]), fit([u for i, u, g in rows if u and g and i != k])
            assert got[k].loss_background == pytest.approx(loss(base, t), rel=1e-9)
            assert got[k].score == pytest.approx(loss(goal, t) - loss(base, t), rel=1e-9, abs=1e-9)
    assert got[3].n_tokens == 0 and got[3].score is None


def test_scoring_keeps_words_and_pairs_apart(spark):
    """More distinct pairs than a table of 2^22 cells can hold apart: a lone word's pair has probability under one, as counted."""
    n = 60_000
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(100)), k % 2 == 0) for k in range(n)]
    docs = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "text", "good"])).repartition(16)
    s = lm_scoring.LmSettings()
    got = lm_scoring.cross_entropy_difference(docs, "good", s).toPandas()
    v = total = n * 100
    p = s.alpha / (total - 100 + s.alpha * v)  # nothing but its own counts, which are left out
    want = (-np.log(p) - 99 * np.log(s.beta * p / s.beta)) / 100
    assert (got.n_tokens == 100).all() and np.allclose(got.loss_background, want, rtol=1e-9)


def test_scoring_does_not_depend_on_shards(spark, odd):
    rows = [(k, " ".join(f"w{(k * j * j) % 37}" for j in range(k % 50)), k % 3 == 0) for k in range(200)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    few, many = (sorted(map(tuple, lm_scoring.cross_entropy_difference(docs.repartition(3), "good", s).collect()), key=str) for s in (lm_scoring.LmSettings(frequent=1, spread=1), lm_scoring.LmSettings(shard_tokens=50, spread=5, held_texts=40, frequent=20, broadcast_rows=0)))
    assert len(few) == 400 and [r[:2] for r in few] == [r[:2] for r in many]
    assert all(a == b or a == pytest.approx(b, rel=1e-9, abs=1e-9) for x, y in zip(few, many) for a, b in zip(x[2:], y[2:]))


def test_scoring_edges(odd, none):
    r = lm_scoring.cross_entropy_difference(odd.withColumn("m", F.lit(None).cast("boolean")), "m")
    assert r.count() == len(TEXTS) + 2 and "extra" in r.columns
    assert lm_scoring.cross_entropy_difference(none.withColumn("m", F.lit(True)), "m").count() == 0


# ---- 2

def test_language_held_out_accuracy(spark, small):
    r = queries()["op2_language_id"](spark, "/root/testdata/sf0.01").toPandas()
    lang = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang").toPandas()
    x = r[r.held_out].merge(lang, on="doc_id")
    assert (x.lang_pred == x.lang).mean() > 0.95
    assert all(h == (zlib.crc32(str(i).encode()) % 5 == 0) for h, i in zip(r.held_out, r.doc_id))


def test_language_edges(odd, none, spark):
    fitted = langid.train(["the cat and the dog sat"] * 20 + ["der hund und die katze"] * 20, ["en"] * 20 + ["de"] * 20)
    got = by_text(langid.predict(odd, fitted))
    assert got[None].lang_pred == got[""].lang_pred == got["***"].lang_pred == "und" and got["word"].lang_pred in ("en", "de") and 0 <= got["word"]["score"] <= 1
    assert langid.predict(none, fitted).count() == 0
    empty = langid.learn(none.withColumn("lang", F.lit("x")))
    assert {r.lang_pred for r in langid.predict(odd, empty).collect()} == {"und"}


# ---- 3

def test_edited_counts_equal_full_encoding(spark):
    tokenizers = pytest.importorskip("tokenizers")
    full = tokenizers.Tokenizer.from_file(vocabulary())
    encoder = trie_bpe.TrieEncoder(trie_bpe.Vocabulary.load(vocabulary()))
    rng = np.random.default_rng(4)
    for text in [t for t in TEXTS if t is not None and len(t) < 1000] + [" ".join(f"w{k}'re  x" for k in range(400))]:
        tree, now = token_counts.TokenTree(encoder, text), text
        for _ in range(25):
            at, drop = int(rng.integers(0, len(now) + 2)), int(rng.choice([0, 1, 3, 200]))
            put = str(rng.choice(["", " ", "'s", "re", "<|endoftext|>", "\n\n x", "long word here " * 20]))
            tree.replace(at, drop, put)
            now = now[:at] + put + now[at + drop :]
            assert tree.text() == now and tree.total == len(full.encode(now, add_special_tokens=False).ids)


def test_edited_counts_edges(odd, none):
    edits = F.when(F.col("extra").isNull(), F.expr(f"cast(null as {token_counts.EDIT})")).otherwise(F.expr(f"cast(array(named_struct('at', 99, 'drop', null, 'put', ' x')) as {token_counts.EDIT})"))
    r = token_counts.edited_counts(odd.withColumn("edits", edits), vocabulary()).collect()
    assert len(r) == len(TEXTS) + 2 and all(x.n_tokens == x.n_tokens_edited for x in r if x.extra is None)
    assert [x.n_tokens_edited - x.n_tokens for x in r if x.extra == 1] == [1]
    assert token_counts.edited_counts(none.withColumn("edits", edits), vocabulary()).count() == 0


# ---- 4

def brute(docs, width, percent):
    sets = []
    for i, t in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())))
    up = {i: i for i, _ in sets}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, x in sets:
        for b, y in sets:
            if a < b and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(a), top(b)
                up[max(p, q)] = min(p, q)
    return {i: (len(s), top(i)) for i, s in sets}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (2, 60)])
def test_jaccard_equals_brute_force(spark, width, percent):
    rng = np.random.default_rng(width)
    docs = []
    for g in range(25):
        base = [f"w{x}" for x in rng.integers(0, 400, int(rng.integers(1, 160)))]
        for _ in range(int(rng.integers(1, 7))):
            w = list(base)
            for _ in range(int(rng.integers(0, 7))):
                w[int(rng.integers(len(w)))] = f"W{rng.integers(400)}"
            docs.append((len(docs), " ".join(w)))
    docs += [(1000 + k, t) for k, t in enumerate([None, "", " ", "x", "X", "a b"])]
    got = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(5), jaccard_join.JaccardSettings(width=width, percent=percent))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs, width, percent)


def test_jaccard_edges(odd, none):
    r = jaccard_join.jaccard_components(odd).collect()
    assert len(r) == len(TEXTS) + 2
    got = {x.doc_id: x for x in r}
    assert got[8].component_id == 7 and got[0].n_shingles == 0 and got[0].component_id == 0 and got[None].component_id is None
    assert jaccard_join.jaccard_components(none).count() == 0


def test_jaccard_ids_with_several_texts(spark):
    """An id's rows are one document: they connect what their texts are linked with."""
    a, b, c, d = ("a b c d e f g", "h i j k l m n", "o p q r s t u", "h i j k l m n x")
    rows = [(1, a), (9, a), (9, b), (2, b), (9, c), (3, c), (7, d), (8, "v w"), (8, "y z"), (8, None)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), jaccard_join.JaccardSettings(width=3, percent=80)).collect()
    assert len(got) == len(rows) and {r.doc_id: r.component_id for r in got} == {1: 1, 9: 1, 2: 1, 3: 1, 7: 1, 8: 8}


def test_jaccard_long_texts_of_one_id(spark):
    """Pipeline: of an id's texts only the first was compared with what met them."""
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    for rows in ([(1, a), (1, b)], [(1, b), (1, a)]):
        rows = [*rows, (5, b + " x"), (6, a + " y")]
        got = jaccard_join.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"), jaccard_join.JaccardSettings(width=3, percent=80)).collect()
        assert len(got) == 4 and {r.component_id for r in got} == {1}


def test_jaccard_pairs_of_several_buckets_are_given_once(spark):
    """Pipeline: a pair across components came once for each bucket in which it met."""
    drawn = jaccard_join.sketch(np.arange(300, dtype=np.uint64) << np.uint64(55))
    row = lambda sig, doc, least, hub=9: (sig, doc, hub, doc, 300, drawn, least, 0, 0, 0)
    schema = "signature long, doc_id long, hub long, component long, n long, sketch binary, least array<long>, block int, low int, high int"
    whole, cut = [-3, 5, 8], [[-9, -3], [4, 5]]
    got = lambda rows: sorted(map(tuple, jaccard_join.near_pairs(spark.createDataFrame(rows, schema), jaccard_join.JaccardSettings()).collect()))
    assert got([row(s, d, whole) for s in whole for d in (1, 2, 3)]) == [(1, 2), (1, 3), (2, 3)]
    assert set(got([row(s, d, least) for s in whole for d, least in zip((1, 2), cut)])) == {(1, 2)}
    assert got([row(s, d, whole, hub=1 if s == -3 else 9) for s in whole for d in (1, 2, 3)]) == [(2, 3)]


def test_jaccard_hot_groups(spark):
    """Heavy keys and several blocks in a bucket: the same result as of small ones."""
    base = [f"t{k}" for k in range(40)]
    docs = [(k, "same text of many documents here") for k in range(1500)] + [(2000 + k, " ".join(base + [f"z{k}"])) for k in range(300)]
    docs += [(5000 + k, " ".join(base[:30] + [f"y{k % 40}x{i}" for i in range(6)])) for k in range(200)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), jaccard_join.JaccardSettings(width=3, percent=80))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs, 3, 80)


def test_jaccard_deals_out_only_texts_that_are_compared(spark):
    """Pipeline: each comparison dealt out the texts of all candidates, for a few pairs."""
    rng = np.random.default_rng(1)
    docs = [(k, " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, 400))) for k in range(400)]
    docs += [(1000, docs[0][1] + " more"), (1001, "other")]
    texts = spark.createDataFrame(docs, "doc_id long, text string")
    store, jvm = spark.sparkContext._jsc.sc().statusStore(), spark._jvm
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        before = spark.sparkContext._jsc.sc().dagScheduler().nextStageId()
        got = jaccard_join.verified(spark.createDataFrame([(0, 1000), (0, 1001)], "a long, b long"), texts, jaccard_join.JaccardSettings()).collect()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stages = store.stageList(jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    written = sum(x.shuffleWriteBytes() for x in (stages.apply(k) for k in range(stages.size())) if x.stageId() >= before)
    assert [tuple(r) for r in got] == [(0, 1000)] and 0 < written < 100_000


def test_kept_tables_leave_no_shuffle_files(spark):
    """Pipeline: shuffle files of finished steps lay on disk beside those of the next."""
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for x in manager.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}
    before, setting = files(), dict(spark.conf.getAll)
    kept = Scratch(spark, "t").keep("a", spark.range(100_000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    until = time.time() + 3
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before and kept.count() == 7 and dict(spark.conf.getAll) == setting


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(1, 60)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in K.components(edges, Scratch(spark, "t"), "c").collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), 100: 100, 101: 100}


# ---- 5

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><nav><ul><li><a href=x>Home</a></li></ul></nav>
<div class="cookie-notice">We use cookies</div><article><h1>A  big
title</h1><p>One &amp; two, and some more words follow here.<br>next <b>bold</b></p><script>var t="<p>no</p>"</script><p>Second &eacute; para<p>Third one</article>
<aside class="sidebar"><p>Related things</p></aside><div id="comments"><p>I like it</p></div><form><input><label>Mail</label></form><footer>Copyright</footer>"""


def test_extraction(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "c"), (2, None, None, None), (3, "u", "", "c"), (4, "u", "plain < text", None), (5, "u", "<p" * 500, None), (6, "u", "<div>" * 2000 + "deep", None)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_blocks.main_text(pages).collect()}
    assert got[1].text == "A big title\nOne & two, and some more words follow here. next bold\nSecond é para\nThird one" and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[2].n_chars == 0 and len(got) == 6
    assert html_blocks.main_text(pages.where("false")).count() == 0


def test_labels_of_fresh_layouts():
    rng = np.random.default_rng(77)
    made = [m for m in (html_blocks.laid_out(rng) for _ in range(300)) if m[0]]
    got = html_blocks.labels(html_blocks.trained(), [m[0] for m in made])
    assert np.mean(np.concatenate(got) == np.concatenate([np.array(m[1], bool) for m in made])) > 0.98


# ---- 6

def test_overlaps(spark, odd, none):
    words = [f"bench{k}" for k in range(30)]
    bench = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "short one")], "item_id long, text string")
    swapped = [w if k % 7 else "XX" for k, w in enumerate(words)]
    rows = [(1, "Intro, " + " ".join(words).upper() + "! end"), (2, "a b " + " ".join(swapped)), (3, " ".join(words[:9])), (4, " ".join(words[10:22])), (5, "nothing of it " * 50), (6, None), (None, " ".join(words))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.run_score for r in decontaminate.overlaps(docs, bench).collect()}.keys() == {1, 2, 4, None}
    assert {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()} == {3, 5, 6}
    few = decontaminate.SeedSettings(broadcast_rows=0)
    assert {r.doc_id for r in decontaminate.overlaps(docs, bench, few).collect()} == {1, 2, 4, None}
    assert decontaminate.overlaps(odd, bench).count() == decontaminate.overlaps(none, bench).count() == 0
    assert decontaminate.without_leaks(odd.withColumn("leak_id", F.lit(1)), bench.where("false")).count() == len(TEXTS) + 2


# ---- 7

def test_quality_held_out(spark):
    r = queries()["op7_quality_classifier"](spark, "/root/testdata/sf0.01").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas()
    x = r[r.held_out].merge(labels, on="doc_id")
    assert (x.predicted == x.quality).mean() > 0.9 and ((r.score >= 0.7) == (r.predicted == 1)).all()


def test_quality_equals_brute_force_vote():
    s = quality_knn.KnnSettings(neighbours=3)
    m = quality_knn.fit(["good plain words here", "fine plain words too", "bad### ugly###", "worse### ugly!!! ###"], [1, 1, 0, 0], s)
    some = np.concatenate([quality_knn.vectors(d, o, m["idf"], m["basis"], s) for d, o in quality_knn.blocks(["plain words", "ugly### bad", ""])])
    got = quality_knn.vote(m, some, s)
    assert (m["counts"] == 1).all()
    for v, g in zip(some, got):
        near = sorted(((float(np.dot(v, w)), y) for w, y in zip(m["vectors"], m["labels"])), reverse=True)[:3]
        total = sum(max(0, c) ** 4 for c, _ in near)
        assert g == pytest.approx(sum(max(0, c) ** 4 * y for c, y in near) / total if total > 1e-9 else m["prior"], abs=1e-4)


def test_repeated_labelled_rows_vote_together():
    s = quality_knn.KnnSettings(neighbours=4)
    texts = ["good plain words here"] * 10 + ["fine plain words too"] * 3 + ["bad### ugly###"] * 5
    labels = [1] * 5 + [0] * 5 + [1] * 3 + [0] * 5
    some = lambda m: np.concatenate([quality_knn.vectors(d, o, m["idf"], m["basis"], s) for d, o in quality_knn.blocks(["good plain words here", "fine plain words too", "x"])])
    rng, found = np.random.default_rng(1), []
    for order in (np.arange(18), *(rng.permutation(18) for _ in range(3))):
        m = quality_knn.fit([texts[k] for k in order], [labels[k] for k in order], s)
        assert sorted(m["counts"]) == [3, 5, 10] and m["labels"].max() == 1
        found.append(quality_knn.vote(m, some(m), s))
    assert np.allclose(found, found[0], atol=1e-4)
    assert found[0][0] == pytest.approx(0.5, abs=1e-6) and found[0][1] > 0.75  # all four votes of the ten; three good ones and one vote of the next


def test_quality_edges(odd, none, spark):
    labels = spark.createDataFrame([(3, 1), (6, 0), (None, 1), (4, None)], "doc_id long, quality int")
    fitted = quality_knn.learn(odd, labels)
    assert fitted["counts"].sum() == 3 and quality_knn.score(odd, fitted).count() == len(TEXTS) + 2
    nothing = quality_knn.learn(none, labels)
    assert {r["score"] for r in quality_knn.score(odd, nothing).collect()} == {0.5} and quality_knn.score(none, fitted).count() == 0


# ---- 8

def test_encoding_equals_the_library(spark, odd, none):
    tokenizers = pytest.importorskip("tokenizers")
    full = tokenizers.Tokenizer.from_file(vocabulary())
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += [t for t in TEXTS if t is not None] + ["<|endoftext|><|endoftext|> a\x1c\x85　 b \r\n  c", "'s 't 'LL x'll", "日本語のテスト 12٣ ½"]
    e = trie_bpe.TrieEncoder(trie_bpe.Vocabulary.load(vocabulary()), cache=500)
    for t, ids in zip(texts, e.encode(texts)):
        want = full.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert e.decode(ids).decode() == full.decode(want, skip_special_tokens=False)
    got = trie_bpe.encode_decode(odd, vocabulary(), ids=True).collect()
    assert len(got) == len(TEXTS) + 2 and all(r.decoded == (r.text or "") and r.n_tokens == len(r.ids) for r in got)
    assert trie_bpe.encode_decode(none, vocabulary()).count() == 0
    assert e.decode(np.array([167], "<u4").tobytes()).decode() == full.decode([167], skip_special_tokens=False)


# ---- 9

def lzw(samples, least):
    """A plain growing-table LZW writer, for the decoder's general loop."""
    clear = 1 << least
    table, width, bits = {bytes((k,)): k for k in range(clear)}, least + 1, []
    put = lambda c: bits.extend(c >> k & 1 for k in range(width))
    put(clear)
    size, now = clear + 2, b""
    for s in samples:
        if now + bytes((s,)) in table:
            now += bytes((s,))
            continue
        put(table[now])
        if size < 4096:
            table[now + bytes((s,))] = size
            size += 1
            if size > 1 << width and width < 12:
                width += 1
        else:
            put(clear)
            table, width, size = {bytes((k,)): k for k in range(clear)}, least + 1, clear + 2
        now = bytes((s,))
    put(table[now])
    put(clear + 1)
    return np.packbits(np.array(bits, np.uint8), bitorder="little").tobytes()


def test_lzw_streams():
    rng = np.random.default_rng(2)
    for least, n in ((2, 50), (4, 3000), (8, 30_000)):
        s = np.sort(rng.integers(0, 1 << least, n)).astype(np.uint8) if n < 3000 else rng.integers(0, 1 << least, n).astype(np.uint8)
        assert (gif_media.lzw_decode(lzw(s.tolist(), least), least, n) == s).all()
    for n in (*range(4), *range(250, 262), 576, 5000):
        for row in (rng.integers(0, 256, n).astype(np.uint8), np.full(n, 7, np.uint8), np.sort(rng.integers(90, 110, n)).astype(np.uint8)):
            coded = gif_media.lzw_encode(row.tobytes())
            assert (gif_media.lzw_decode(coded, 8, n) == row).all()
            assert not n or coded == lzw(row.tolist(), 8)  # the plain writer's stream


def test_streams_together_equal_the_loop():
    """Damaged streams too: the same samples, or both fail."""
    rng = np.random.default_rng(5)

    def read(f):
        try:
            return f().tolist()
        except ValueError:
            return None

    for least in (2, 8):
        rows = [np.sort(rng.integers(0, 1 << least, n)).astype(np.uint8) if n % 2 else rng.integers(0, 1 << least, n).astype(np.uint8) for n in (0, 1, 2, 77, 576, 577, 3000, 3901, 9000)]
        coded = gif_media.lzw_encode_all([r.tobytes() for r in rows], least)
        assert all((g == r).all() for g, r in zip(gif_media.lzw_decode_all(coded, least, [len(r) for r in rows]), rows))
        for c, r in zip(coded, rows):
            for _ in range(8):
                cut = bytearray(c[: int(rng.integers(1, len(c) + 1))])
                cut[int(rng.integers(len(cut)))] ^= 1 << int(rng.integers(8))
                assert read(lambda: gif_media.lzw_decode(bytes(cut), least, len(r))) == read(lambda: gif_media.lzw_decode_all([bytes(cut)], least, [len(r)])[0])  # noqa: B023


def test_media_path_composes_frames(monkeypatch):
    """The texts' way back goes through table, palette, disposal and histogram of each frame."""
    seen = []
    for name in ("lzw_decode_all", "grown", "furthest", "frames", "shown", "histogram"):
        real = getattr(gif_media, name)
        monkeypatch.setattr(gif_media, name, lambda *a, _real=real, _name=name, **k: (seen.append(_name), _real(*a, **k))[1])
    text = "a text of several frames, which repeats itself; " * 60
    payload, bins, delays = gif_media.read_back(gif_media.stored_text(text.encode()))
    assert payload.rstrip(b"\xff").decode() == text and len(delays) == 5 and bins.shape == (5, 64) and bins.sum() == len(payload)
    assert set(seen) == {"lzw_decode_all", "grown", "furthest", "frames", "shown", "histogram"} and seen.count("histogram") == 5


def test_frame_rows(spark):
    gifs = [(1, gif_media.stored_text(b"x" * 1000), "a"), (2, None, "b"), (3, b"no gif", "c"), (4, gif_media.stored_text(b"")[:300], "d"), (5, b"GIF89a\x01\0\x01\0\0\0\0;", "e")]
    rows = gif_media.gif_frames(spark.createDataFrame(gifs, "doc_id long, gif binary, width string")).orderBy("doc_id", "frame").collect()
    assert [(r.doc_id, r.frame, r.starts_ms, r.width, r.fault is None) for r in rows] == [(1, 0, 0, 24, True), (1, 1, 100, 24, True), (2, None, None, None, False), (3, None, None, None, False), (4, None, None, None, False), (5, None, None, None, False)]
    assert bytes(rows[0].rgba)[:4] == b"xxx\xff" and sum(rows[1].histogram) == 576 and rows[5].fault == "no frame"


def test_frames_disposal_and_transparency():
    import struct

    palette = bytes([255, 0, 0, 0, 255, 0, 0, 0, 255, 0, 0, 0])

    def image(cells, w, h, left=0, disposal=0, clear=None, delay=5):
        body = lzw(cells, 2)
        return b"\x21\xf9\x04" + bytes([disposal << 2 | (clear is not None)]) + struct.pack("<H", delay) + bytes([clear or 0, 0]) + b"\x2c" + struct.pack("<4HB", left, 0, w, h, 0) + b"\x02" + bytes([len(body)]) + body + b"\0"

    data = b"GIF89a" + struct.pack("<2H3B", 2, 1, 0x81, 0, 0) + palette + image([0, 1], 2, 1) + image([3, 2], 2, 1, clear=3, disposal=3) + image([2], 1, 1, disposal=2) + image([1], 1, 1, left=1) + b"\x3b"
    shown = gif_media.decode(data)
    colours = [[tuple(p) for p in f[1][0].tolist()] for f in shown]
    red, green, blue = (255, 0, 0, 255), (0, 255, 0, 255), (0, 0, 255, 255)
    assert colours == [[red, green], [red, blue], [blue, green], [(0, 0, 0, 0), green]] and [f[0] for f in shown] == [50] * 4
    assert gif_media.histogram(shown[0][1])[48] == 1
    for cut in (0, 5, 20, 60):
        with pytest.raises(ValueError):
            gif_media.decode(data[:cut])


def test_media_columns(odd, none):
    import hashlib

    got = gif_media.media_columns(odd.withColumn("t", F.col("text")), media=True).collect()
    assert len(got) == len(TEXTS) + 2
    for r in got:
        raw = (r.t or "").encode()
        payload = raw.ljust(max(576, -(-len(raw) // 576) * 576), b"\xff")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]))
        assert r.media_sha256 == hashlib.sha256(bytes(r.gif)).hexdigest() and r.media_bytes == len(r.gif)
    assert gif_media.media_columns(none).count() == 0


# ---- 10

def test_quotes_link_and_order(spark):
    rows = [(1, 0, "user", "Hello there\nfriend\n\nHow are you?", 1), (1, 1, "assistant", "Bob wrote:\n> hello  There\n> friend\nfine", 1), (1, 2, "user", ">> Hello there friend\n> fine\nok then", 1), (1, 3, "user", "> nothing\nx", 1), (1, 4, "user", "> ok then\nend", 1), (2, 9, "user", "> ok then\nother", 1), (None, 1, None, None, None), (1, None, "u", "> fine", 1), (1, 4, "user", "> ok then\nend", 1)]
    got = quote_chat.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, depth int").repartition(4)).collect()
    assert len(got) == len(rows)
    one = {r.turn: (r.reply_to, r.thread, r.depth, r.body) for r in got if r.conv_id == 1 and r.turn is not None}
    assert one == {0: (None, 0, 0, "Hello there\nfriend\n\nHow are you?"), 1: (0, 0, 1, "fine"), 2: (1, 0, 2, "ok then"), 3: (None, 3, 0, "> nothing\nx"), 4: (2, 0, 3, "end")}
    assert [(r.reply_to, r.body) for r in got if r.conv_id == 2] == [(None, "> ok then\nother")]
    chain = [(5, k, "u", f"message {k}" if not k else f"> message {k - 1}\nmessage {k}") for k in range(40)]
    deep = {r.turn: r.depth for r in quote_chat.reply_ordered(spark.createDataFrame(chain, "conv_id long, turn long, role string, text string")).collect()}
    assert deep == {k: k for k in range(40)}
    assert quote_chat.reply_ordered(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


def test_excerpts_find_their_original(spark):
    first = "The first line of all\nsecond line goes here\nand the third line. It ends\nwith a fourth one"
    rows = [
        (1, 0, "u", first),
        (1, 1, "u", "nothing like it"),
        (1, 2, "u", "> second line goes here\n> and the third line. It ends\nlines two and three"),
        (1, 3, "u", "> and the third line.\na sentence"),
        (1, 4, "u", "> goes here and the\n> third line. It ends with a\nwrapped anew"),
        (1, 5, "u", "> here third\nwords apart"),
        (1, 6, "u", "> lines two\nof a reply"),
        (2, 1, "u", "> goes here and the\nother conversation"),
    ]
    got = quote_chat.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)).collect()
    assert {(r.conv_id, r.turn): r.reply_to for r in got} == {(1, 0): None, (1, 1): None, (1, 2): 0, (1, 3): 0, (1, 4): 0, (1, 5): None, (1, 6): 2, (2, 1): None}


# ---- queries and pipeline

@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_equals_sql(spark, small, name):
    con = duckdb.connect()
    for t in ORACLES_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    made, want = queries()[name](spark, small).toPandas(), con.execute(oracle_sql()[name]).df()
    key = lambda d: sorted(map(tuple, d[sorted(d.columns)].astype("int64").itertuples(index=False)))
    assert sorted(made.columns) == sorted(want.columns) and key(made) == key(want)


def test_pipeline_stages(spark, small):
    corpus_pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = [(r.doc_id, r.text) for r in docs.collect()]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, small).collect()}
    assert kept == {i for i, (_, top) in brute(held, 5, 80).items() if top == i}
    twice = docs.union(docs.where("doc_id < 3"))
    assert corpus_pipeline.near_duplicates(spark, twice, small).count() == len(kept)
    out = corpus_pipeline.run(spark, small)
    assert out.columns[: len(docs.columns)] == docs.columns
    r = out.toPandas()
    assert 0 < len(r) <= len(kept) and r.doc_id.is_unique and pd.notna(r.ids_sha256).all()
    nothing = corpus_pipeline.quality(spark, docs.where("false"), small)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing.where("false"), small).count() == 0
