"""Queries and operators against plain versions of the same, and edge cases."""

import hashlib
import random
import time
from collections import defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

pytest.importorskip("kindred.llm")

from kindred.llm import arrowtext, decontaminate, gif_media, html_blocks, langid, layouts, lm_scoring, markup, quality_knn, quote_chat, shared
from kindred.llm.queries import queries, vocabulary

SF = "/root/testdata/sf0.001"


def word_hash(word: bytes) -> int:
    """The hash of one word alone."""
    data = np.frombuffer(word, np.uint8)
    return int(arrowtext.range_hash(arrowtext.prefix_hash(data), np.array([0]), np.array([len(data)]))[0])


# ---- 1


def test_target_of_labels_with_nulls_and_repeats(spark):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, None), (None, "d"), (4, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, 1), (1, 0), (2, 0), (3, 1), (None, 1), (4, None), (9, 1)], "doc_id long, quality int")
    got = lm_scoring.labelled_target(docs, labels).collect()
    assert sorted((str(r.doc_id), str(r.text), r.in_target) for r in got) == [("1", "a", True), ("1", "b", True), ("2", "c", False), ("3", "None", True), ("4", "e", False), ("None", "d", False)]


def test_copies_with_and_without_a_label_are_scored_apart(spark):
    rows = [(1, "x y z", True), (2, "x y z", False), (3, "x y q", True), (4, "long other text", None)]
    got = {r.doc_id: r for r in lm_scoring.cross_entropy_difference(spark.createDataFrame(rows, "doc_id long, text string, m boolean"), "m").collect()}
    assert got[1].loss_background == pytest.approx(got[2].loss_background) and got[1].loss_target > got[2].loss_target and got[1].n_tokens == got[2].n_tokens == 3


# ---- 2


def test_language_scores_equal_brute_force(spark):
    s = langid.LangIdSettings(buckets=1 << 10, dim=4, epochs=2)
    texts = ["the cat and the dog sat on the mat"] * 12 + ["der hund und die katze saßen"] * 12 + ["le chat et le chien sont là"] * 12
    m = langid.train(texts, ["en"] * 12 + ["de"] * 12 + ["fr"] * 12, s)
    rows = [*set(texts), "Ünïcode Words, 12 there", "x", "a b c", "the\nthe", "Été?"]
    got = {r.text: r for r in langid.predict(spark.createDataFrame([(t,) for t in rows], "text string"), m, s).collect()}
    for t in rows:
        clean = bytes(c if 97 <= c <= 122 or c >= 128 else 32 for c in t.lower().encode())
        words = clean.split()
        # words with one space after each that is followed by something that is no letter
        joined, at = b"", 0
        for w in words:
            at = clean.index(w, at) + len(w)
            joined += w + (b" " if at < len(clean) else b"")
        grams = [joined[k : k + n] for n in (3, 4) for k in range(len(joined) - n + 1) if joined[k + 1 : k + 2] != b" "]
        cells = [(word_hash(g) + len(g)) & (s.buckets - 1) for g in grams] + [word_hash(w) & (s.buckets - 1) for w in words]
        z = np.mean([m["table"][c] for c in cells], axis=0)
        p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
        assert got[t].lang_pred == m["classes"][int(p.argmax())] and got[t].score == pytest.approx(p.max(), rel=1e-5), t


# ---- 3


def test_edited_counts_query_equals_the_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    full = tokenizers.Tokenizer.from_file(vocabulary())
    n = lambda t: len(full.encode(t, add_special_tokens=False).ids)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries()["op3_token_counts"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        t = docs[r.doc_id]
        a, b = len(t) // 3, len(t) * 2 // 3
        edited = t[:a] + t[a + 7 :]
        edited = edited[:b] + " it's edited 42 times" + edited[b:]
        assert (r.n_tokens, r.n_tokens_edited) == (n(t), n(edited))


# ---- 5


def test_labels_equal_a_plain_lstm():
    """Batches, shared paths and padding give what one block after the other gives."""
    net = html_blocks.trained()
    made = [layouts.laid_out(np.random.default_rng(k))[0] for k in range(12)]
    made = [m for m in made if m]
    got = html_blocks.labels(net, made)
    size, sigmoid = net.h, lambda v: 1 / (1 + np.exp(-v))
    for blocks, flags in zip(made, got):
        x = []
        for b in blocks:
            words = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c > 127 else 32 for c in b.text.encode()).split()
            vector = np.mean([net.p["word"][word_hash(w) & (html_blocks.CELLS - 1)] for w in words], axis=0) if words else np.zeros(html_blocks.WORD)
            n = len(b.text)
            plain = [min(1, b.linked / n), np.log1p(n) / 6, np.log1p(b.text.count(" ") + 1) / 4, b.text.count(",") * 4 / n, float(b.text[-1] in ".!?"), len(b.path) / 8]
            x.append(np.concatenate([html_blocks.path_vector(b.path), vector, plain]) @ net.p["in"] + net.p["bias"])
        states = []
        for cut, u, order in ((slice(0, 4 * size), net.p["uf"], range(len(x))), (slice(4 * size, 8 * size), net.p["ub"], range(len(x) - 1, -1, -1))):
            h, c, out = np.zeros(size), np.zeros(size), [None] * len(x)
            for t in order:
                g = x[t][cut] + h @ u
                i, f, o, q = sigmoid(g[:size]), sigmoid(g[size : 2 * size]), sigmoid(g[2 * size : 3 * size]), np.tanh(g[3 * size :])
                c = f * c + i * q
                h = o * np.tanh(c)
                out[t] = h
            states.append(out)
        z = [np.concatenate([a, b]) @ net.p["o"] + v[-1] for a, b, v in zip(*states, x)]
        assert all((v > 0) == k for v, k in zip(z, flags) if abs(v) > 1e-3)


def test_words_decide_where_names_say_nothing():
    net = html_blocks.trained()
    page = "<body><div class='x1'><h1>On rivers</h1><p>The water of the river runs to the sea, and in spring it rises.</p><p>It was for that a road was built.</p></div><div class='x2'>{}</div>"
    labels = lambda text: html_blocks.labels(net, [markup.blocks(page.format(text))])[0].tolist()
    assert labels("We use cookies to improve your experience. Accept all cookies or decline, see our privacy policy.")[-1] is False
    blind = html_blocks.BiLstm()
    blind.p = net.p | {"word": np.zeros_like(net.p["word"])}
    made = [layouts.laid_out(np.random.default_rng(1000 + k))[0] for k in range(200)]
    made = [m for m in made if m]
    moved = np.mean(np.concatenate(html_blocks.labels(net, made)) != np.concatenate(html_blocks.labels(blind, made)))
    assert moved > 0.005


@pytest.mark.parametrize("page", ["<p" + " " * 22 + 'title="abc', "<p" + " " * 60 + 'title="abc', "<div\n" + '   class="a"\n' * 3 + '  id="x y\n', "text <a" + " " * 3000])
def test_unfinished_tags_cost_nothing(page):
    began = time.time()
    markup.blocks(page)
    assert time.time() - began < 0.01


@pytest.mark.parametrize("piece", ["<p ", '<a b="> ', "<a b='x\" c> ", "<div>x", "<b>", "<button>x", "<", "<!--", "<script>", '<a ="' + " " * 50, "<li>x", "<table><tr><td>x", "</p>", "&amp", "<svg><g>", "</b></i>"])
def test_a_megabyte_of_malformed_markup(piece):
    began = time.time()
    found = markup.blocks(piece * (1_000_000 // len(piece)))
    assert time.time() - began < 5
    if piece in ("<div>x", "<li>x", "<button>x"):
        assert sum(len(b.text) for b in found) == 1_000_000 // len(piece)


def test_scanner_cases():
    text = lambda page: [b.text for b in markup.blocks(page)]
    assert text('<p title="abc>kept<p class="x">second</p>') == ["kept", "second"]
    assert text("<svg-icon>in icon</svg-icon><svg a='b'/>after <svg><text>no</text></svg>end <video-js>too</video-js>") == ["in icon", "after end", "too"] or text("<svg-icon>in icon</svg-icon>") == ["in icon"]
    assert text("<p>Hello <button><div>x</div></button> world</p>") == ["Hello world"]
    assert text("<p>Hello <button>never closed</p><p>last") == ["Hello", "never closed", "last"]
    assert text("<p>One <script>if (a < b) '</p>'</script>two</p><style>p{}</style>") == ["One two"]
    assert text("<head><title>t</title><p>body text") == ["body text"]
    assert text("<noscript><p>no</p></noscript><p a='>'>yes &lt;b&gt; &#233;</p>") == ["yes <b> é"]
    assert text("a < b <c") == ["a < b"] and text("") == text("   ") == []


# ---- 6


def test_short_items_equal_sql(spark):
    """Items of 1 to 30 tokens, half of the copies with a substitution, against the SQL."""
    random.seed(3)
    words = [f"w{k}" for k in range(40)]
    items = [(k, " ".join(random.choice(words) for _ in range(n))) for k, n in enumerate([1, 2, 3, 5, 7, 8, 8, 9, 10, 12, 13, 20, 30])] + [(99, None), (98, "!!")]
    docs = [(1000, None), (1001, "")]
    for k in range(200):
        w = (random.choice(items)[1] or "").split()
        if len(w) > 3 and random.random() < 0.5:
            w[random.randrange(len(w))] = "zz"
        docs.append((k, " ".join([f"q{random.randrange(99)}" for _ in range(random.randrange(6))] + w + ["tail"])))
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(docs, columns=["doc_id", "text"]))
    con.register("benchmark", pd.DataFrame(items, columns=["item_id", "text"]))
    got = decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(map(tuple, got)) == sorted(con.execute(decontaminate.ORACLE).fetchall()) and len(got) > 100


def test_any_one_substitution_leaves_a_seed(spark):
    """Items of 8 to 40 tokens with one token replaced, at every place: all are found."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in (8, 9, 10, 11, 12, 13, 17, 40)]
    docs = []
    for n, t in items:
        for k in range(n):
            w = t.split()
            w[k] = "other"
            docs.append((100 * n + k, "before it " + " ".join(w) + " and after"))
    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    missed = {(d, d // 100) for d, _ in docs} - found
    assert not missed


def test_seed_recall_under_many_substitutions():
    """Random substitutions at rates of 5 to 20 %: of the overlaps that score enough, nearly all have a seed."""
    rng = np.random.default_rng(8)
    hits = total = 0
    for n in (13, 16, 20, 30, 40):
        for rate in (0.05, 0.1, 0.2):
            for _ in range(300):
                same = rng.random(n) >= rate
                best = now = 0
                for e in same:
                    now = max(0, now + (1 if e else -2))
                    best = max(best, now)
                if best >= 10:
                    total += 1
                    hits += any(all(same[a + k] for k in mask) for mask in decontaminate.MASKS[:2] for a in range(n - decontaminate.SPAN + 1))
    assert total > 2000 and hits / total > 0.999


# ---- 7


def test_quality_features_and_scores_equal_brute_force(spark):
    s = quality_knn.KnnSettings(word_cells=64, class_cells=64, dim=3, neighbours=3)
    texts = ["Good plain words here, 12", "fine fine words\ntoo", "bad### UGLY### x", "worse### ugly!!! ###", "more plain words", "", "é à"]
    data, offsets = arrowtext.flat(__import__("pyarrow").array(texts))
    got = quality_knn.features(data, offsets, s)
    for row, t in zip(got, texts):
        want = np.zeros(128)
        words = [w for w in bytes(c + 32 if 65 <= c <= 90 else c for c in t.encode()).split()]
        for w in words:
            want[word_hash(w) & 63] += 1
        for a, b in zip(words, words[1:]):
            want[64] += a == b
        kinds = bytes(quality_knn.CLASS[np.frombuffer(t.encode(), np.uint8)])
        for n in (2, 3, 4):
            for k in range(len(kinds) - n + 1):
                want[64 + ((word_hash(kinds[k : k + n]) + n) & 63)] += 1
        assert (row == want).all(), t
    m = quality_knn.fit(texts, [1, 1, 0, 0, 1, 0, 1], s)
    rows = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    scored = {r.text: r for r in quality_knn.score(rows, m, s).collect()}
    counts = np.log1p(got) * m["idf"]
    for part in (counts[:, :64], counts[:, 64:]):
        part /= np.maximum(1e-12, np.linalg.norm(part, axis=1, keepdims=True))
    latent = counts @ m["basis"]
    for v, t in zip(latent, texts):
        v = v / max(1e-12, np.linalg.norm(v))
        votes = sorted(((float(v @ w), k) for k, w in enumerate(m["vectors"])), key=lambda x: -x[0])[:3]
        total = sum(max(0, c) ** 4 for c, _ in votes)
        want = sum(max(0, c) ** 4 * m["labels"][k] for c, k in votes) / total if total > 1e-9 else m["prior"]
        assert scored[t]["score"] == pytest.approx(want, abs=1e-3) and scored[t].predicted == int(scored[t]["score"] >= 0.7)
    assert scored[None]["score"] == scored[""]["score"]


# ---- 9


def test_media_features_equal_plain_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string"))
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    for r in gif_media.media_columns(docs).collect():
        raw = text[r.doc_id].encode()
        payload = np.frombuffer(raw.ljust(max(576, -(-len(raw) // 576) * 576), b"\xff"), np.uint8)
        frames = payload.reshape(-1, 576)
        grey = np.stack([np.bincount(f >> 6, minlength=4) for f in frames])
        change = np.abs(np.diff(grey, axis=0)).max(initial=0) / 576
        assert [float(x) for x in r.feature.split()] == pytest.approx([*(grey.sum(axis=0) / len(payload)), change], abs=1e-6)
        assert (r.n_frames, r.duration_ms, sum(r.histogram)) == (len(frames), 100 * len(frames), len(payload)) and [r.histogram[k] for k in (0, 21, 42, 63)] == grey.sum(axis=0).tolist()


# ---- 10


def linked(rows):
    """Reply links and bodies by comparing each quote with each earlier message."""
    out = {}
    told = {(c, t): quote_chat.parsed(x or "") for c, t, _, x in rows}
    for (c, t), p in told.items():
        earlier = sorted((u for k, u in told if k == c and u < t), reverse=True)
        found = {}
        for k, (level, words) in enumerate(p.quotes):
            whole = next((u for u in earlier if words in told[c, u].pieces), None)
            part = next((u for u in earlier if any(f" {words} " in f" {x} " for x in passages(told[c, u]))), None)
            if (origin := whole if whole is not None else part) is not None:
                found[k] = (-level, origin)
        out[c, t] = (max(found.values())[1] if found else None, p.body(set(found)))
    return out


def passages(p):
    held, out = [], []
    for line in [*p.own().split("\n"), ""]:
        if line.split():
            held += line.lower().split()
        elif held:
            out.append(" ".join(held))
            held = []
    return out


def test_replies_equal_brute_force(spark):
    rng = np.random.default_rng(12)
    rows, said = [], defaultdict(list)
    words = [f"w{k}" for k in range(12)]
    for c in range(12):
        for t in range(0, 30, 1 + c % 3):
            lines = []
            for _ in range(int(rng.integers(1, 4))):
                kind = rng.random()
                if kind < 0.5 and said[c]:
                    old = said[c][int(rng.integers(len(said[c])))].split("\n")
                    some = [x for x in old if x.strip()] or ["x"]
                    a = int(rng.integers(len(some)))
                    cut = some[a : a + int(rng.integers(1, 4))]
                    if rng.random() < 0.3:
                        cut = [" ".join(cut[0].split()[1:-1]) or "none"]
                    lines += (["Ann wrote:"] if rng.random() < 0.3 else []) + ["> " + x for x in cut] + ([""] if rng.random() < 0.3 else [])
                elif kind < 0.6:
                    lines.append(">>> print(1)")
                else:
                    lines += [" ".join(rng.choice(words, int(rng.integers(1, 8)))) for _ in range(int(rng.integers(1, 4)))] + ([""] if rng.random() < 0.4 else [])
            rows.append((c, t, "user", "\n".join(lines)))
            said[c].append("\n".join(lines))
    got = quote_chat.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)).collect()
    want = linked(rows)
    assert {(r.conv_id, r.turn): (r.reply_to, r.body) for r in got} == want
    assert sum(w[0] is not None for w in want.values()) > 40
    up = {k: w[0] for k, w in want.items()}
    for r in got:
        chain, at = 0, r.turn
        while up[r.conv_id, at] is not None:
            at, chain = up[r.conv_id, at], chain + 1
        assert (r.thread, r.depth) == (at, chain)


def test_quotes_of_a_long_conversation(spark):
    """Spans of turns, a line that all turns quote, a very long text, and lines that link to nothing."""
    rows = [(1, t, "u", "the first line" if not t else f"> the first line\nturn {t}") for t in range(0, 5000, 7)] + [(1, -5, "u", None), (2, 1, "u", "word " * 200_000), (2, 2, "u", "> " + "word " * 50 + "\nyes"), (2, 3, "u", ">>> print(1)\nAnn wrote:\n> never said\nend")]
    got = {(r.conv_id, r.turn): r for r in quote_chat.reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert all(got[1, t].reply_to == 0 and got[1, t].depth == 1 and got[1, t].body == f"turn {t}" for t in range(7, 5000, 7))
    assert got[2, 2].reply_to == 1 and got[2, 2].body == "yes" and got[2, 3].body == ">>> print(1)\nAnn wrote:\n> never said\nend" and (got[2, 3].n_quotes, got[2, 3].n_linked) == (2, 0)


# ---- shared folder


def test_shared_folder_and_scratch(spark):
    class Cluster:
        conf, sparkContext = type("C", (), {"get": staticmethod(lambda *a: None)}), type("S", (), {"master": "spark://x"})

    with pytest.raises(ValueError, match="checkpoint.dir"):
        shared.shared_dir(Cluster)
    s = shared.Scratch(spark, "t")
    assert s.keep("a", spark.range(3)).count() == 3 and shared.finished(spark, f"{s.root}/a")
    s.drop("a")
    assert not shared.finished(spark, f"{s.root}/a")
    s.keep("b", spark.range(3))
    s.clear()
    assert not shared.finished(spark, f"{s.root}/b")


def test_digests_are_of_the_stored_form(spark):
    r = gif_media.media_columns(spark.createDataFrame([(1, "abc")], "doc_id long, text string"), media=True).first()
    assert hashlib.sha256(bytes(r.gif)).hexdigest() == r.media_sha256 and len(r.gif) == r.media_bytes
    assert gif_media.gif_frames(spark.createDataFrame([(1, bytes(r.gif))], "doc_id long, gif binary")).select(F.sum(F.size("histogram"))).first()[0] == 64


# ---- pipeline


def test_pipeline_stages_bear_odd_rows(spark):
    """Nulls in any column, empty and very long texts, repeated rows, and columns with clashing names."""
    pipeline = pytest.importorskip("corpus_pipeline")
    base = spark.read.parquet(f"{SF}/documents.parquet")
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string, component_id long, leak_id string, ids_sha256 string"
    odd = [(None, "no id", None, None, None, "s", 1, "x", None), (-1, None, "en", None, None, None, None, None, None), (-2, "", "en", "a", 0, "s", 1, "x", "y"), (-3, "long words again " * 40_000, "en", "a", 1, "s", 1, "x", "y"), (-4, " \n", None, "a", 1, "s", 1, "x", "y")]
    known = [(r.doc_id, r.text, r.lang, r.source, r.n_chars, "s", 1, "x", "y") for r in base.limit(30).collect()]
    docs = spark.createDataFrame(odd + known + known[:3], schema).repartition(3)
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, SF)
        rows = out.collect()
        assert set(docs.columns) <= set(out.columns) and len(out.columns) == len(set(out.columns)), name
        if name in ("decontamination", "encoding"):
            assert len(rows) >= len(odd) and {r.doc_id for r in rows} >= {None, -1, -2, -3, -4}, name
        if name == "near_duplicates":
            assert {-1, -2, -3, -4, None} <= {r.doc_id for r in rows} and len(rows) == len({r.doc_id for r in rows})
