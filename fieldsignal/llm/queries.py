"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldsignal.llm import (
    clusters, decontaminate, lexical, licenses, packing, pages, quality, simhash, suffixdedup, tokens, toxicity, urls,
    worddedup,
)
from fieldsignal.llm.common import table

OVER_LIMIT = 1024


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > OVER_LIMIT)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.extract(table(spark, sf_dir, "pages"))


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), urls.rules_table(spark, urls.RULES))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.drop("passages")


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    trusted = table(spark, sf_dir, "labels").where("quality = 1")
    return quality.judge(table(spark, sf_dir, "documents"), trusted)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.dedup_digest(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = clusters.cluster(table(spark, sf_dir, "embeddings"))
    return found.withColumn("centroid_sha256", F.sha2(F.array_join("centroid", ","), 256)).drop("centroid")


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = worddedup.remove_repeated(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_license_scan, op3_decontamination, op4_html_extraction, op5_url_filter,
        op6_packing, op7_toxicity, op8_quality_rules, op9_suffix_dedup, op10_simhash, op11_clusters,
        op12_lexical_search, op13_substring_dedup,
    )
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(repr(x) for x in row) + ")" for row in rows)


def _list(words: list[str]) -> str:
    return "[" + ", ".join(repr(w) for w in words) + "]"


def _license_sql() -> str:
    starts = " UNION ALL ".join(
        f"SELECT doc_id, unnest(list_filter(range(1, len(w) - {len(p) - 2}), lambda i: w[i:i + {len(p) - 1}] = {_list(p)}))"
        f" - 1 AS place, '{label}' AS label FROM words"
        for p, label in ((phrase.split(), label) for phrase, label in licenses.PHRASES)
    )
    templates = ", ".join(
        f"({_list(sorted(set(t.split())))}, '{label}', {_list(needed)}::VARCHAR[], {_list(barred)}::VARCHAR[])"
        for t, label, (needed, barred) in ((t, label, licenses.naming(t, label)) for t, label in licenses.TEMPLATES)
    )
    line_words = _WORDS.replace("coalesce(text, '')", "line")
    return f"""
    WITH words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    base AS (SELECT doc_id, count(*) AS n, min(place) AS first, max(place) AS last, list(DISTINCT label) AS labels
             FROM ({starts}) GROUP BY doc_id),
    lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents),
    blocks AS (SELECT doc_id, list_distinct({line_words}) AS b FROM lines),
    fits AS (SELECT doc_id, label, len(list_intersect(t, b)) / len(t) AS part
             FROM blocks, (VALUES {templates}) AS templates(t, label, needed, barred)
             WHERE len(list_intersect(t, b)) >= {licenses.THRESHOLD} * len(t) - 1e-9
               AND list_has_all(b, needed) AND NOT list_has_any(b, barred)),
    found AS (SELECT doc_id, list(DISTINCT label) AS labels, max(part) AS part FROM fits GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_base, first AS first_word, last AS last_word,
           coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
           coalesce(array_to_string(list_sort(list_distinct(list_concat(base.labels, found.labels))), ','), '') AS labels,
           CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0)::DOUBLE END AS score
    FROM words LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
    """


def _decontamination_sql() -> str:
    n = decontaminate.WINDOW
    return f"""
    WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
    windows AS (
        SELECT DISTINCT item_id, least(len(w), {n}) AS size,
               array_to_string(w[i:i + least(len(w), {n}) - 1], ' ') AS win
        FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - {n - 1}, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
    words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
    sizes AS (SELECT DISTINCT size FROM windows),
    places AS (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size),
    hits AS (SELECT doc_id, i, p.size, item_id FROM places p
             JOIN windows v ON v.size = p.size AND v.win = array_to_string(p.w[i:i + p.size - 1], ' ')),
    covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit
                FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM (SELECT DISTINCT doc_id, i, size FROM hits))
                GROUP BY doc_id),
    named AS (SELECT doc_id, count(DISTINCT item_id) AS n_items,
                     array_to_string(list_sort(list(DISTINCT item_id::VARCHAR)), ',') AS names FROM hits GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(names, '')) AS items_sha256,
           coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
    FROM words LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """


def _url_sql() -> str:
    return rf"""
    WITH parts AS (
        SELECT page_id,
               translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
        FROM pages),
    rules AS (SELECT * FROM (VALUES {_values(urls.RULES)}) AS r(rule_host, rule_path, rule_verdict)),
    best AS (
        SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
               arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
        FROM (SELECT DISTINCT host, path FROM parts)
        JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
        GROUP BY host, path)
    SELECT page_id, host, path, rule, coalesce(rule_verdict, '{urls.DEFAULT_VERDICT}') AS verdict
    FROM parts LEFT JOIN best USING (host, path)
    """


def _clusters_sql() -> str:
    k, dim = clusters.CENTROIDS, clusters.DIM
    steps = []
    for r in range(clusters.ROUNDS + 1):
        steps.append(f"""
    far{r} AS (SELECT nr, cluster, sum((v.x - c.x) * (v.x - c.x))::BIGINT AS distance
               FROM parts v JOIN c{r} c USING (place) GROUP BY nr, cluster),
    near{r} AS (SELECT nr, cluster, distance FROM far{r}
                QUALIFY row_number() OVER (PARTITION BY nr ORDER BY distance, cluster) = 1)""")
        if r < clusters.ROUNDS:
            steps.append(f"""
    sums{r} AS (SELECT cluster, place, sum(x)::BIGINT AS total, count(*) AS n FROM near{r} JOIN parts USING (nr) GROUP BY cluster, place),
    c{r + 1} AS (SELECT cluster, place, CASE WHEN n > 0 THEN (total - ((total % n) + n) % n) // n ELSE x END AS x
                 FROM c{r} LEFT JOIN sums{r} USING (cluster, place))""")
    last = clusters.ROUNDS
    return f"""
    WITH kept AS (
        SELECT row_number() OVER () AS nr, vec_id, sha256('1:' || vec_id) AS key,
               list_transform(embedding, lambda x: floor({clusters.SCALE} * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
    parts AS (SELECT nr, unnest(v) AS x, unnest(range({dim})) AS place FROM kept),
    c0 AS (SELECT number AS cluster, unnest(v) AS x, unnest(range({dim})) AS place
           FROM (SELECT v, row_number() OVER (ORDER BY key) - 1 AS number FROM kept QUALIFY number < {k})),
    {",".join(steps)},
    hashes AS (SELECT cluster, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM c{last} GROUP BY cluster)
    SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
           sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
    FROM near{last} JOIN kept USING (nr) JOIN hashes USING (cluster)
    """


def _lexical_sql() -> str:
    return f"""
    WITH texts AS (SELECT row_number() OVER () AS nr, doc_id, {_WORDS} AS w FROM documents),
    tf AS (SELECT nr, doc_id, term, count(*) AS tf FROM (SELECT nr, doc_id, unnest(w) AS term FROM texts) GROUP BY ALL),
    df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
    sizes AS (SELECT nr, len(w) AS n FROM texts WHERE len(w) > 0),
    totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM sizes),
    items AS (SELECT DISTINCT item_id, unnest({_WORDS}) AS term FROM benchmark),
    scores AS (
        SELECT item_id, nr, doc_id,
               sum(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT
                   * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
        FROM items JOIN tf USING (term) JOIN df USING (term) JOIN sizes USING (nr), totals
        GROUP BY item_id, nr, doc_id)
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
    FROM scores WHERE score > 0 QUALIFY rank <= {lexical.TOP}
    """


def _word_dedup_sql() -> str:
    n = worddedup.WINDOW
    return rf"""
    WITH texts AS (SELECT row_number() OVER () AS nr, doc_id,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    places AS (SELECT nr, w, unnest(range(1, len(w) - {n - 2})) AS i FROM texts WHERE len(w) >= {n}),
    windows AS (SELECT nr, i, array_to_string(w[i:i + {n - 1}], ' ') AS win FROM places),
    again AS (SELECT nr, i FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1),
    gone AS (SELECT DISTINCT nr, unnest(range(i, i + {n})) AS k FROM again),
    words AS (SELECT nr, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM texts),
    kept AS (SELECT nr, count(*) AS n, string_agg(word, ' ' ORDER BY k) AS kept
             FROM words ANTI JOIN gone USING (nr, k) GROUP BY nr)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
    FROM texts LEFT JOIN kept USING (nr)
    """


SQL = {
    "op2_license_scan": _license_sql(),
    "op3_decontamination": _decontamination_sql(),
    "op5_url_filter": _url_sql(),
    "op11_clusters": _clusters_sql(),
    "op12_lexical_search": _lexical_sql(),
    "op13_substring_dedup": _word_dedup_sql(),
}
