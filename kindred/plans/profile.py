"""Profiling and relational queries as SQL that Spark plans; the text is portable to other engines.

Where dialects differ there is a second text for the oracle.
"""

from __future__ import annotations

TEXT = "lower(text)"
#: Flags of a text: name and a pattern that both engines read alike.
FLAGS = {
    "digits": "[0-9]", "shouting": "[A-Z]{4}", "marks": r"\p{M}", "indic": r"[\x{0900}-\x{0DFF}]", "license": "(?i)license", "accents": "[À-ÿ]", "email": r"[a-z0-9._]+@[a-z0-9-]+\.[a-z]+", "site": r"(?i)(^|[^a-z0-9])(www\.|https?://)", "ampersand": "&", "hashes": "##",
    "plus": r"\+", "slash": "/", "brackets": r"[()]", "square": r"[\[\]]", "quotes": '"', "apostrophe": "'", "comma": ",", "dots": r"\.\.\.", "dash": "-", "underscore": "_",
    "stars": r"\*\*", "percent": "%", "money": "[$€£]", "long_number": "[0-9]{6}", "ordinal": r"(?i)[0-9](st|nd|rd|th)( |$)", "one_letter": r"(^| )[A-Za-z]( |$)", "padded_zero": r"(^|[^0-9])0[0-9]", "other_letters": r"[^\x{0000}-\x{024F}]",
}
SHARES = ", ".join("count_if(text RLIKE '{}') AS {}".format(p.replace("\\", "\\\\").replace("'", "\\'"), n) for n, p in FLAGS.items())
DUCK_SHARES = ", ".join("CAST(count(*) FILTER (WHERE regexp_matches(text, '{}')) AS BIGINT) AS {}".format(p.replace("'", "''"), n) for n, p in FLAGS.items())

#: name: (SQL for Spark, SQL for the oracle where it differs)
QUERIES: dict[str, tuple[str, str | None]] = {
    "row_counts": ("SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'customer', count(*) FROM customer", None),
    "null_blank_profile": ("SELECT count(*) AS n, sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS null_text, sum(CASE WHEN trim(text) = '' THEN 1 ELSE 0 END) AS blank_text, sum(CASE WHEN lang IS NULL OR trim(lang) = '' THEN 1 ELSE 0 END) AS no_lang FROM documents", "SELECT count(*) AS n, CAST(sum(CASE WHEN text IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS null_text, CAST(sum(CASE WHEN trim(text) = '' THEN 1 ELSE 0 END) AS BIGINT) AS blank_text, CAST(sum(CASE WHEN lang IS NULL OR trim(lang) = '' THEN 1 ELSE 0 END) AS BIGINT) AS no_lang FROM documents"),
    "key_uniqueness": ("SELECT count(*) AS n, count(DISTINCT doc_id) AS ids, count(*) - count(DISTINCT text) AS repeated_texts, round(100 * CAST(count(*) - count(DISTINCT text) AS DOUBLE) / count(*), 4) AS repeated_percent FROM documents", None),
    "tuple_duplicates": ("SELECT count(*) AS n, count(DISTINCT struct(p_name, p_brand)) AS name_brand, count(DISTINCT struct(p_name, p_brand, p_type)) AS with_type FROM part", "SELECT count(*) AS n, count(DISTINCT (p_name, p_brand)) AS name_brand, count(DISTINCT (p_name, p_brand, p_type)) AS with_type FROM part"),
    "category_share": ("SELECT lang, count(*) AS n, round(100 * CAST(count(*) AS DOUBLE) / sum(count(*)) OVER (), 4) AS share FROM documents GROUP BY lang", None),
    "category_overlap": ("SELECT (SELECT count(*) FROM (SELECT c_nationkey FROM customer INTERSECT SELECT s_nationkey FROM supplier)) AS both_sides, (SELECT count(*) FROM (SELECT c_nationkey FROM customer EXCEPT SELECT s_nationkey FROM supplier)) AS customers_only, (SELECT count(*) FROM (SELECT s_nationkey FROM supplier EXCEPT SELECT c_nationkey FROM customer)) AS suppliers_only", None),
    "length_profile": (
        "SELECT lang, CAST(min(length(text)) AS BIGINT) AS low, CAST(max(length(text)) AS BIGINT) AS high, round(avg(length(text)), 4) AS mean, round(percentile(length(text), 0.5), 4) AS p50, round(percentile(length(text), 0.95), 4) AS p95, sum(CASE WHEN octet_length(text) > length(text) THEN 1 ELSE 0 END) AS not_ascii FROM documents GROUP BY lang",
        "SELECT lang, CAST(min(length(text)) AS BIGINT) AS low, CAST(max(length(text)) AS BIGINT) AS high, round(avg(length(text)), 4) AS mean, round(quantile_cont(length(text), 0.5), 4) AS p50, round(quantile_cont(length(text), 0.95), 4) AS p95, CAST(sum(CASE WHEN strlen(text) > length(text) THEN 1 ELSE 0 END) AS BIGINT) AS not_ascii FROM documents GROUP BY lang",
    ),
    "length_disc": ("SELECT lang, CAST(percentile_disc(0.99) WITHIN GROUP (ORDER BY n_chars) AS BIGINT) AS p99, round(median(n_chars), 4) AS mid FROM documents GROUP BY lang", "SELECT lang, CAST(quantile_disc(n_chars, 0.99) AS BIGINT) AS p99, round(median(n_chars), 4) AS mid FROM documents GROUP BY lang"),
    "regex_flags": (f"SELECT lang, {SHARES} FROM documents GROUP BY lang", f"SELECT lang, {DUCK_SHARES} FROM documents GROUP BY lang"),
    "last_token_top": (f"SELECT element_at(split({TEXT}, ' '), -1) AS token, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, token LIMIT 20", f"SELECT list_last(string_split({TEXT}, ' ')) AS token, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, token LIMIT 20"),
    "top_tokens_per_group": (
        f"SELECT lang, token, n FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) AS r FROM (SELECT lang, token, count(*) AS n FROM (SELECT lang, explode(split({TEXT}, ' ')) AS token FROM documents) GROUP BY lang, token)) WHERE r <= 12",
        f"SELECT lang, token, n FROM (SELECT lang, token, count(*) AS n FROM (SELECT lang, unnest(string_split({TEXT}, ' ')) AS token FROM documents) GROUP BY lang, token) QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n DESC, token) <= 12",
    ),
    "heaviest_keys": ("SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 10", None),
    "match_count_hist": ("SELECT matches, count(*) AS entities FROM (SELECT o_custkey, count(*) AS matches FROM orders GROUP BY o_custkey) GROUP BY matches", None),
    "match_source_combo": ("SELECT CASE WHEN c AND s THEN 'both' WHEN c THEN 'customer' WHEN s THEN 'supplier' ELSE 'none' END AS combo, count(*) AS nations FROM (SELECT n_nationkey, n_nationkey IN (SELECT c_nationkey FROM customer) AS c, n_nationkey IN (SELECT s_nationkey FROM supplier) AS s FROM nation) GROUP BY 1", None),
    "gt_integrity": ("SELECT (SELECT count(*) FROM orders) AS truth_rows, (SELECT count(DISTINCT o_custkey) FROM orders) AS entities, (SELECT count_if(o_custkey IS NULL OR o_orderkey IS NULL) FROM orders) AS nulls, (SELECT count(*) FROM orders o LEFT ANTI JOIN customer c ON o.o_custkey = c.c_custkey) AS orphans, (SELECT count(*) FROM customer c LEFT ANTI JOIN orders o ON o.o_custkey = c.c_custkey) AS without, (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS repeated, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(DISTINCT o_custkey) > 1)) AS claimed_twice, (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)) AS most", "SELECT (SELECT count(*) FROM orders) AS truth_rows, (SELECT count(DISTINCT o_custkey) FROM orders) AS entities, (SELECT count(*) FROM orders WHERE o_custkey IS NULL OR o_orderkey IS NULL) AS nulls, (SELECT count(*) FROM orders o ANTI JOIN customer c ON o.o_custkey = c.c_custkey) AS orphans, (SELECT count(*) FROM customer c ANTI JOIN orders o ON o.o_custkey = c.c_custkey) AS without, (SELECT count(*) - count(DISTINCT o_orderkey) FROM orders) AS repeated, (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY o_orderkey HAVING count(DISTINCT o_custkey) > 1)) AS claimed_twice, (SELECT max(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey)) AS most"),
    "joint_match_hist": ("SELECT x, y, count(*) AS n FROM (SELECT c.c_custkey, count(CASE WHEN o_orderstatus = 'O' THEN 1 END) AS x, count(CASE WHEN o_orderstatus = 'F' THEN 1 END) AS y FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey) GROUP BY x, y", None),
    "unmatched_targets": ("SELECT p.p_brand, count(*) AS parts, count(l.k) AS sold FROM part p LEFT JOIN (SELECT DISTINCT l_partkey AS k FROM lineitem) l ON p.p_partkey = l.k GROUP BY p.p_brand", None),
    "decoy_rate": ("SELECT a.p_brand, count(*) AS n, sum(CASE WHEN b.p_name IS NOT NULL THEN 1 ELSE 0 END) AS decoys FROM part a LEFT JOIN (SELECT p_brand, p_name FROM part GROUP BY p_brand, p_name HAVING count(DISTINCT p_size) > 1) b ON a.p_brand = b.p_brand AND a.p_name = b.p_name GROUP BY a.p_brand", "SELECT a.p_brand, count(*) AS n, CAST(sum(CASE WHEN b.p_name IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS decoys FROM part a LEFT JOIN (SELECT p_brand, p_name FROM part GROUP BY p_brand, p_name HAVING count(DISTINCT p_size) > 1) b ON a.p_brand = b.p_brand AND a.p_name = b.p_name GROUP BY a.p_brand"),
    "pair_field_agreement": ("SELECT round(avg(CAST(c_nationkey = s_nationkey AS INT)), 6) AS same_nation, round(avg(CAST(c_acctbal > s_acctbal AS INT)), 6) AS richer, round(avg(CAST(p_size = l_linenumber AS INT)), 6) AS same_number, round(avg(CAST(c_custkey % 10 = s_suppkey % 10 AS INT)), 6) AS same_digit, round(avg(CAST(l_linestatus = o_orderstatus AS INT)), 6) AS same_status, round(avg(CAST(nullif(l_returnflag, 'N') = o_orderstatus AS INT)), 6) AS same_known_flag, count(*) AS n FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN customer c ON o.o_custkey = c.c_custkey JOIN supplier s ON l.l_suppkey = s.s_suppkey JOIN part p ON l.l_partkey = p.p_partkey", None),
    "exact_key_volume": ("SELECT sum(a.n * b.n) AS pairs, count(*) AS keys FROM (SELECT p_brand, p_name, count(*) AS n FROM part WHERE p_partkey % 4 = 0 GROUP BY p_brand, p_name) a JOIN (SELECT p_brand, p_name, count(*) AS n FROM part WHERE p_partkey % 4 <> 0 GROUP BY p_brand, p_name) b ON a.p_brand = b.p_brand AND a.p_name = b.p_name", "SELECT CAST(sum(a.n * b.n) AS BIGINT) AS pairs, count(*) AS keys FROM (SELECT p_brand, p_name, count(*) AS n FROM part WHERE p_partkey % 4 = 0 GROUP BY p_brand, p_name) a JOIN (SELECT p_brand, p_name, count(*) AS n FROM part WHERE p_partkey % 4 <> 0 GROUP BY p_brand, p_name) b ON a.p_brand = b.p_brand AND a.p_name = b.p_name"),
    "self_collisions": ("SELECT lang, sum(n * (n - 1) div 2) AS pairs, max(n) AS most FROM (SELECT lang, " + TEXT + " AS k, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY lang", "SELECT lang, CAST(sum(n * (n - 1) // 2) AS BIGINT) AS pairs, max(n) AS most FROM (SELECT lang, " + TEXT + " AS k, count(*) AS n FROM documents GROUP BY 1, 2) GROUP BY lang"),
    "union_volume_incl_excl": tuple(
        "WITH a AS (SELECT p_partkey % 4 = 0 AS q, p_brand, p_name, p_size FROM part), one AS (SELECT p_brand, p_name, sum(CASE WHEN q THEN 1 ELSE 0 END) AS x, sum(CASE WHEN q THEN 0 ELSE 1 END) AS y FROM a GROUP BY 1, 2), two AS (SELECT p_brand, p_size, sum(CASE WHEN q THEN 1 ELSE 0 END) AS x, sum(CASE WHEN q THEN 0 ELSE 1 END) AS y FROM a GROUP BY 1, 2), three AS (SELECT p_brand, p_name, p_size, sum(CASE WHEN q THEN 1 ELSE 0 END) AS x, sum(CASE WHEN q THEN 0 ELSE 1 END) AS y FROM a GROUP BY 1, 2, 3) SELECT CAST((SELECT sum(x * y) FROM one) + (SELECT sum(x * y) FROM two) - (SELECT sum(x * y) FROM three) AS BIGINT) AS either"
        for _ in range(2)
    ),
    "semi_join_hot_keys": ("WITH hot AS (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 30) SELECT p_brand, count(*) AS n FROM part p LEFT SEMI JOIN hot h ON p.p_name = h.p_name GROUP BY p_brand", "WITH hot AS (SELECT p_name FROM part GROUP BY p_name HAVING count(*) > 30) SELECT p_brand, count(*) AS n FROM part p SEMI JOIN hot h ON p.p_name = h.p_name GROUP BY p_brand"),
    "anti_missing": ("SELECT c.c_mktsegment, count(*) AS n FROM customer c LEFT ANTI JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY 1", "SELECT c.c_mktsegment, count(*) AS n FROM customer c ANTI JOIN orders o ON c.c_custkey = o.o_custkey GROUP BY 1"),
    # an anti join that can be shuffled, and what a null among the values, or no value at all, means for NOT IN
    "not_in_nullaware": ("WITH s AS (SELECT o_custkey FROM orders WHERE o_totalprice > 100000) SELECT count(*) AS n FROM customer c LEFT ANTI JOIN s ON c.c_custkey = s.o_custkey WHERE (SELECT count(*) FROM s) = 0 OR (c.c_custkey IS NOT NULL AND (SELECT count_if(o_custkey IS NULL) FROM s) = 0)", "SELECT count(*) AS n FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)"),
    "not_exists_missed": ("SELECT o_orderpriority, count(*) AS n FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey AND l.l_returnflag = 'R') GROUP BY 1", None),
    "multi_col_in": ("SELECT count(*) AS n FROM part WHERE (p_brand, p_name) IN (SELECT p_brand, p_name FROM part WHERE p_size = 1)", None),
    "null_safe_diff": ("SELECT count(*) AS n FROM customer a JOIN supplier b ON a.c_nationkey = b.s_nationkey WHERE nullif(a.c_acctbal, 0) IS DISTINCT FROM nullif(b.s_acctbal, 0)", None),
    "lateral_product": ("SELECT w, n, count(*) AS k FROM (SELECT split(p_name, ' ') AS ws, array(p_size % 3, p_size % 5) AS ns FROM part) LATERAL VIEW explode(ws) AS w LATERAL VIEW explode(ns) AS n GROUP BY w, n", "SELECT w, n, count(*) AS k FROM (SELECT w, unnest(ns) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS w, [p_size % 3, p_size % 5] AS ns FROM part)) GROUP BY w, n"),
    "outer_residual": ("SELECT c.c_mktsegment, count(*) AS n, count(o.o_orderkey) AS dear FROM customer c LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_totalprice > 200000 GROUP BY 1", None),
    "except_symdiff": ("SELECT (SELECT count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R' EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A')) AS only_r, (SELECT count(*) FROM (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A' EXCEPT SELECT l_partkey FROM lineitem WHERE l_returnflag = 'R')) AS only_a", None),
    "union_distinct": ("SELECT count(*) AS n FROM (SELECT c_nationkey AS k FROM customer UNION SELECT s_nationkey FROM supplier)", None),
    "first_only_regex": (r"SELECT doc_id, md5(regexp_replace(text, '^(.*?)[ \\t\\n\\r]+', '$1_')) AS once, md5(lower(regexp_replace(text, '[ \\t\\n\\r]+', '_'))) AS every_run FROM documents", r"SELECT doc_id, md5(regexp_replace(text, '^(.*?)[ \t\n\r]+', '\1_')) AS once, md5(lower(regexp_replace(text, '[ \t\n\r]+', '_', 'g'))) AS every_run FROM documents"),
    "full_match_regex": (r"SELECT count_if(c_name RLIKE '^(?:Customer#[0-9]+)$') AS whole, count_if(c_name LIKE 'Customer#%') AS prefixed FROM customer", r"SELECT CAST(count(*) FILTER (WHERE regexp_full_match(c_name, 'Customer#[0-9]+')) AS BIGINT) AS whole, CAST(count(*) FILTER (WHERE c_name LIKE 'Customer#%') AS BIGINT) AS prefixed FROM customer"),
    "block_size_rows": ("SELECT p_partkey, count(*) OVER (PARTITION BY p_brand, p_name) AS block, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS r, rank() OVER (PARTITION BY p_brand ORDER BY p_size DESC) AS k, round(max(p_retailprice) OVER (PARTITION BY p_brand) - p_retailprice, 4) AS gap FROM part", None),
    "list_audit": ("SELECT count(*) AS lists, count_if(size(ids) <> size(array_distinct(ids))) AS with_repeats, max(size(ids)) AS longest FROM (SELECT split(string_agg(CAST(o_orderkey AS STRING), ',') WITHIN GROUP (ORDER BY CAST(o_orderkey AS STRING)), ',') AS ids FROM orders GROUP BY o_custkey)", "SELECT count(*) AS lists, CAST(count(*) FILTER (WHERE len(ids) <> len(list_distinct(ids))) AS BIGINT) AS with_repeats, max(len(ids)) AS longest FROM (SELECT string_split(string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY CAST(o_orderkey AS VARCHAR)), ',') AS ids FROM orders GROUP BY o_custkey)"),
    "host_labels": (r"SELECT host, count(*) AS n FROM (SELECT regexp_extract(url, '^https?://(?:www[.]|m[.])?([^/:?#]+)', 1) AS host FROM pages) GROUP BY host", None),
    "in_list": ("SELECT p_brand, count_if(p_size IN (1, 7, 49)) AS listed, count_if(p_size NOT IN (1, 7, 49)) AS others, count_if(p_type NOT IN ('LARGE', 'SMALL')) AS other_types FROM part GROUP BY p_brand", "SELECT p_brand, CAST(count(*) FILTER (WHERE p_size IN (1, 7, 49)) AS BIGINT) AS listed, CAST(count(*) FILTER (WHERE p_size NOT IN (1, 7, 49)) AS BIGINT) AS others, CAST(count(*) FILTER (WHERE p_type NOT IN ('LARGE', 'SMALL')) AS BIGINT) AS other_types FROM part GROUP BY p_brand"),
    "between": ("SELECT p_type, count(*) AS n FROM part WHERE p_size BETWEEN 10 AND 20 AND p_retailprice NOT BETWEEN 950 AND 1000 GROUP BY p_type", None),
    "distinct_lists": ("SELECT p_name, array_join(array_sort(collect_set(p_type)), ',') AS types, CAST(size(collect_set(p_size)) AS BIGINT) AS sizes FROM part GROUP BY p_name", "SELECT p_name, array_to_string(list_sort(list(DISTINCT p_type)), ',') AS types, len(list(DISTINCT p_size)) AS sizes FROM part GROUP BY p_name"),
    "pivot_counts": ("SELECT * FROM (SELECT p_brand, p_type FROM part) PIVOT (count(*) FOR p_type IN ('LARGE' AS large, 'SMALL' AS small, 'PROMO' AS promo))", "SELECT p_brand, nullif(count(*) FILTER (WHERE p_type = 'LARGE'), 0) AS large, nullif(count(*) FILTER (WHERE p_type = 'SMALL'), 0) AS small, nullif(count(*) FILTER (WHERE p_type = 'PROMO'), 0) AS promo FROM part GROUP BY p_brand"),
    "summary": ("SELECT count(p_size) AS n, round(avg(p_size), 6) AS mean, round(stddev_samp(p_size), 6) AS deviation, min(p_size) AS least, percentile(p_size, 0.25) AS p25, percentile(p_size, 0.5) AS p50, percentile(p_size, 0.75) AS p75, max(p_size) AS most FROM part", "SELECT count(p_size) AS n, round(avg(p_size), 6) AS mean, round(stddev_samp(p_size), 6) AS deviation, min(p_size) AS least, quantile_cont(p_size, 0.25) AS p25, quantile_cont(p_size, 0.5) AS p50, quantile_cont(p_size, 0.75) AS p75, max(p_size) AS most FROM part"),
    "number_runs": (r"SELECT doc_id, CAST(size(runs) AS BIGINT) AS n, md5(array_join(transform(runs, x -> regexp_replace(x, '^0+([0-9])', '$1')), ' ')) AS runs FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '([0-9]+)', 1) AS runs FROM documents)", r"SELECT doc_id, len(runs) AS n, md5(array_to_string(list_transform(runs, lambda x: regexp_replace(x, '^0+([0-9])', '\1')), ' ')) AS runs FROM (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[0-9]+') AS runs FROM documents)"),
    "list_prepend": ("SELECT p_partkey, array_join(array_prepend(split(p_name, ' '), p_type), '|') AS ladder FROM part", "SELECT p_partkey, array_to_string(list_prepend(p_type, string_split(p_name, ' ')), '|') AS ladder FROM part"),
    "address_profile": (
        "WITH a AS (SELECT concat_ws(', ', concat(lpad(CAST(c_custkey AS STRING), 6, '0'), ' Main St'), lower(c_mktsegment), n_name) AS a FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT count(*) AS n, round(avg(size(split(a, ','))), 6) AS components, sum(CASE WHEN a RLIKE '[0-9]' THEN 1 ELSE 0 END) AS with_digits, sum(CASE WHEN a RLIKE '(^|[^0-9])0[0-9]' THEN 1 ELSE 0 END) AS padded, sum(CASE WHEN a RLIKE '^[0-9]' THEN 1 ELSE 0 END) AS number_first, count(DISTINCT trim(element_at(split(a, ','), -1))) AS last_parts FROM a",
        "WITH a AS (SELECT concat_ws(', ', lpad(CAST(c_custkey AS VARCHAR), 6, '0') || ' Main St', lower(c_mktsegment), n_name) AS a FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT count(*) AS n, round(avg(len(string_split(a, ','))), 6) AS components, CAST(count(*) FILTER (WHERE regexp_matches(a, '[0-9]')) AS BIGINT) AS with_digits, CAST(count(*) FILTER (WHERE regexp_matches(a, '(^|[^0-9])0[0-9]')) AS BIGINT) AS padded, CAST(count(*) FILTER (WHERE regexp_matches(a, '^[0-9]')) AS BIGINT) AS number_first, count(DISTINCT trim(string_split(a, ',')[-1])) AS last_parts FROM a",
    ),
    "number_range": ("SELECT id % 22 AS chunk, count(*) AS n, max(id) AS last FROM range(0, 200000) GROUP BY 1", "SELECT range % 22 AS chunk, count(*) AS n, max(range) AS last FROM range(0, 200000) GROUP BY 1"),
    "here": ("SELECT current_database() IS NOT NULL AS known, count(*) AS regions FROM region", None),
    "missing_values": ("SELECT c_mktsegment, count_if(coalesce(lower(trim(CASE c_custkey % 5 WHEN 0 THEN ' N/A' WHEN 1 THEN NULL WHEN 2 THEN '--' ELSE c_name END)), '') IN ('', 'null', '<null>', 'none', 'nan', 'n/a', 'na', '-', '--', 'nil')) AS missing FROM customer GROUP BY 1", "SELECT c_mktsegment, CAST(count(*) FILTER (WHERE coalesce(lower(trim(CASE c_custkey % 5 WHEN 0 THEN ' N/A' WHEN 1 THEN NULL WHEN 2 THEN '--' ELSE c_name END)), '') IN ('', 'null', '<null>', 'none', 'nan', 'n/a', 'na', '-', '--', 'nil')) AS BIGINT) AS missing FROM customer GROUP BY 1"),
    "token_overlap": ("WITH a AS (SELECT DISTINCT explode(split(lower(p_name), ' ')) AS w FROM part WHERE p_partkey % 4 = 0), b AS (SELECT DISTINCT explode(split(lower(p_name), ' ')) AS w FROM part WHERE p_partkey % 4 <> 0) SELECT count(*) AS either, count(a.w) AS first, count(b.w) AS second, sum(CASE WHEN a.w = b.w THEN 1 ELSE 0 END) AS both FROM a FULL JOIN b ON a.w = b.w", "WITH a AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS w FROM part WHERE p_partkey % 4 = 0), b AS (SELECT DISTINCT unnest(string_split(lower(p_name), ' ')) AS w FROM part WHERE p_partkey % 4 <> 0) SELECT count(*) AS either, count(a.w) AS first, count(b.w) AS second, CAST(sum(CASE WHEN a.w = b.w THEN 1 ELSE 0 END) AS BIGINT) AS both FROM a FULL JOIN b ON a.w = b.w"),
}
