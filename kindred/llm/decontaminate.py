"""Benchmark decontamination by spaced-seed hashing, in DataFrame and SQL functions only.

Texts become lower-case runs of letters and digits. At each token position each fixed mask
hashes four of the eight tokens from there on; the tokens between may be anything. Training
hashes meet benchmark hashes in a join on the hash; a hit names a document, an item and the
diagonal (document position less item position). On each diagonal that was hit, the whole item
is compared with the document token by token: a match counts 1, a substitution -2, and the best
run of tokens must reach ``reach``, or for items of eight to twelve tokens three less than the item
has, so that one substitution within them is tolerated. For these a third mask is in use: of the
three, one passes over any one position. Items under eight tokens have one seed, of all their
tokens, and match where the document has all of them in a row.

Seeds, hits and items are broadcast only where their counted rows and bytes keep within bounds;
beyond them the same joins are shuffled ones. Hits follow the overlaps found, never pairs of
documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kindred.llm.shared import Scratch, small_or_shuffled

#: Token offsets that each mask looks at, all within eight tokens. The last one is for items of up to ``SHORT`` tokens.
MASKS = ((0, 1, 4, 7), (0, 2, 3, 7), (1, 3, 5, 6))
SPAN = 8
SHORT = 12


@dataclass(frozen=True)
class SeedSettings:
    reach: int = 10
    penalty: int = 2
    broadcast_rows: int = 500_000
    broadcast_bytes: int = 64 << 20


def tokens(text: str) -> F.Column:
    clean = F.trim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), r"[^\p{L}\p{N}]+", " "))
    return F.when(clean == "", F.array().cast("array<string>")).otherwise(F.split(clean, " "))


def patterns(items: DataFrame) -> dict[int, tuple[int, ...]]:
    """The seeds that these items need: masks by number, and -n for all of n tokens where an item has n < 8. Ten at most."""
    sizes = {r.n for r in items.select(F.least(F.size("words"), F.lit(SHORT + 1)).alias("n")).distinct().collect()}
    found = {-n: tuple(range(n)) for n in sorted(sizes) if n < SPAN}
    if any(n >= SPAN for n in sizes):
        found |= {0: MASKS[0], 1: MASKS[1]}
    if any(SPAN <= n <= SHORT for n in sizes):
        found[2] = MASKS[2]
    return found


def seeds(frame: DataFrame, key: str, used: dict[int, tuple[int, ...]], own: bool = False) -> DataFrame:
    """(key, at, seed) for every position of the column ``words`` and every pattern in use.

    ``own``: of each item only the patterns for its length. Rows of positions, not array functions,
    so that hashing and the join stay in generated code.
    """
    least = min((-n if n < 0 else SPAN) for n in used)
    places = frame.where(F.size("words") >= least).select(key, "words", F.explode(F.sequence(F.lit(0), F.size("words") - least)).alias("at"))
    hashed = []
    for name, offsets in used.items():
        span = -name if name < 0 else SPAN
        seed = F.expr(f"xxhash64({name}, " + ", ".join(f"words[at + {k}]" for k in offsets) + ")")
        fits = [] if span == least else [F.col("at") + span <= F.size("words")]
        if own:
            fits += [F.size("words") == -name] if name < 0 else [F.size("words") >= SPAN] + [F.size("words") <= SHORT] * (name == 2)
        for f in fits:
            seed = F.when(f, seed)
        hashed.append(seed)
    return places.select(key, "at", F.explode(F.array(*hashed)).alias("seed")).where("seed IS NOT NULL")


def overlaps(docs: DataFrame, benchmark: DataFrame, s: SeedSettings = SeedSettings(), text: str = "text") -> DataFrame:
    """(doc_id, item_id, run_score, n_matched): overlaps that reach far enough, the best for each document and item.

    n_matched counts equal tokens on the best diagonal. A text or item that is null or has no token
    overlaps with nothing. Rows of one id, null included, count as one document with several texts.
    """
    scratch = Scratch(docs.sparkSession, "seeds")
    items = scratch.keep("items", benchmark.select("item_id", tokens(text).alias("words")).where(F.size("words") > 0).distinct())
    n_items, item_bytes = items.agg(F.count("*"), F.coalesce(F.sum(F.length(F.array_join("words", " ")) * 2 + F.size("words") * 40), F.lit(0))).first()
    used = patterns(items) or {0: MASKS[0]}
    planted = scratch.keep("bench", seeds(items, "item_id", used, own=True).withColumnsRenamed({"at": "item_at"}).distinct())
    source = docs.select("doc_id", F.col(text).alias("text"))
    lines = source.select("doc_id", tokens("text").alias("words"))
    hits = seeds(lines, "doc_id", used).join(small_or_shuffled(planted, planted.count(), s.broadcast_rows), "seed")
    hits = scratch.keep("hits", hits.select("doc_id", "item_id", (F.col("at") - F.col("item_at")).alias("shift")).distinct())

    n = hits.count()
    ids = hits.select(F.col("doc_id").alias("hit_id")).distinct()
    held = source.join(small_or_shuffled(ids, n, s.broadcast_rows), F.col("doc_id").eqNullSafe(F.col("hit_id")), "left_semi").select("doc_id", tokens("text").alias("words"))
    tried = held.join(small_or_shuffled(hits.withColumnRenamed("doc_id", "hit_id"), n, s.broadcast_rows), F.col("doc_id").eqNullSafe(F.col("hit_id"))).drop("hit_id")
    small = n_items <= s.broadcast_rows and item_bytes <= s.broadcast_bytes
    whole = items.withColumnRenamed("words", "item")
    tried = tried.join(F.broadcast(whole) if small else whole, "item_id")
    # positions of the item that the document covers on this diagonal
    tried = tried.withColumn("low", F.greatest(F.lit(0), -F.col("shift"))).withColumn("high", F.least(F.size("item"), F.size("words") - F.col("shift")))
    step = f"if(words[i + shift] = item[i], 1, -{s.penalty})"
    run = f"aggregate(sequence(low, high - 1), named_struct('now', 0, 'best', 0, 'same', 0), (x, i) -> named_struct('now', greatest(0, x.now + {step}), 'best', greatest(x.best, x.now + {step}), 'same', x.same + if(words[i + shift] = item[i], 1, 0)))"
    size = F.size("item")
    enough = F.when(size < SPAN, size).otherwise(F.least(F.lit(s.reach), size - 1 - s.penalty))
    found = tried.where("high > low").withColumn("run", F.expr(run)).where(F.col("run.best") >= enough)
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct(F.col("run.best").alias("b"), F.col("run.same").alias("m"))).alias("top"))
    return best.select("doc_id", "item_id", F.col("top.b").cast("long").alias("run_score"), F.col("top.m").cast("long").alias("n_matched"))


def without_leaks(docs: DataFrame, benchmark: DataFrame, s: SeedSettings = SeedSettings(), text: str = "text") -> DataFrame:
    """``docs`` less the documents that overlap with the benchmark."""
    scratch = Scratch(docs.sparkSession, "leaks")
    bad = scratch.keep("ids", overlaps(docs, benchmark, s, text).select(F.col("doc_id").alias("leak_id")).distinct())
    return docs.join(small_or_shuffled(bad, bad.count(), s.broadcast_rows), docs.doc_id.eqNullSafe(bad.leak_id), "left_anti")


#: The same result in SQL, by comparing seeds as strings.
ORACLE = """
WITH norm AS (
  SELECT 'd' AS kind, doc_id AS id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) AS t FROM documents
  UNION ALL SELECT 'b', item_id, trim(regexp_replace(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+', ' ', 'g')) FROM benchmark),
word AS (SELECT kind, id, string_split(t, ' ') AS words FROM norm WHERE t <> ''),
place AS (SELECT kind, id, words, unnest(range(1, len(words) + 1)) AS i FROM word),
seed AS (
  SELECT kind, id, i, 1 AS mask, words[i] || ' ' || words[i + 1] || ' ' || words[i + 4] || ' ' || words[i + 7] AS s FROM place WHERE i + 7 <= len(words)
  UNION ALL SELECT kind, id, i, 2, words[i] || ' ' || words[i + 2] || ' ' || words[i + 3] || ' ' || words[i + 7] FROM place WHERE i + 7 <= len(words)
  UNION ALL SELECT kind, id, i, 3, words[i + 1] || ' ' || words[i + 3] || ' ' || words[i + 5] || ' ' || words[i + 6] FROM place
    WHERE i + 7 <= len(words) AND (kind = 'b' AND len(words) <= 12 OR kind = 'd' AND EXISTS (SELECT 1 FROM word b WHERE b.kind = 'b' AND len(b.words) BETWEEN 8 AND 12))
  UNION ALL SELECT kind, id, 1, -len(words), array_to_string(words, ' ') FROM word WHERE kind = 'b' AND len(words) < 8
  UNION ALL SELECT kind, id, i, -n, array_to_string(words[i : i + n - 1], ' ') FROM place JOIN (SELECT DISTINCT len(words) AS n FROM word WHERE kind = 'b' AND len(words) < 8) ON i + n - 1 <= len(words) WHERE kind = 'd'),
hit AS (
  SELECT DISTINCT d.id AS doc_id, b.id AS item_id, d.i - b.i AS shift
  FROM seed d JOIN seed b ON d.kind = 'd' AND b.kind = 'b' AND d.mask = b.mask AND d.s = b.s),
cell AS (
  SELECT h.doc_id, h.item_id, h.shift, x.words AS words, y.words AS item, unnest(range(1, len(y.words) + 1)) AS i
  FROM hit h JOIN word x ON x.kind = 'd' AND x.id = h.doc_id JOIN word y ON y.kind = 'b' AND y.id = h.item_id),
same AS (
  SELECT doc_id, item_id, shift, i, len(item) AS n, CASE WHEN words[i + shift] = item[i] THEN 1 ELSE 0 END AS eq
  FROM cell WHERE i + shift BETWEEN 1 AND len(words)),
total AS (
  SELECT *, sum(CASE WHEN eq = 1 THEN 1 ELSE -2 END) OVER (PARTITION BY doc_id, item_id, shift ORDER BY i) AS p FROM same),
run AS (
  SELECT *, p - least(0, coalesce(min(p) OVER (PARTITION BY doc_id, item_id, shift ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS score FROM total),
line AS (SELECT doc_id, item_id, shift, greatest(0, max(score)) AS best, sum(eq) AS matched, max(n) AS n FROM run GROUP BY doc_id, item_id, shift)
SELECT doc_id, item_id, CAST(max(best) AS BIGINT) AS run_score, CAST(arg_max(matched, best * 100000 + matched) AS BIGINT) AS n_matched
FROM line WHERE best >= CASE WHEN n < 8 THEN n ELSE least(10, n - 3) END GROUP BY doc_id, item_id
"""
