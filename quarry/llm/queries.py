"""The registered queries of this subpackage, one per operator, with production
parameters over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.llm import (centroids, hard_negatives, masked_lm, ngram_join, order_minhash, piece_bpe, quality_rules,
                        source_mix, toxicity, url_filter, warc, weak_labels)
from quarry.llm.digest_index import DigestIndex
from quarry.llm.scratch import table, written
from quarry.session import run_path

URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def model_path() -> str:
    """The vocabulary of op9; a parameter of the operator."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_source_mix(spark, sf_dir):
    sized = written(source_mix.sizes(table(spark, sf_dir, "documents")), "sizes")
    return source_mix.plan(sized).select("doc_id", "source", "size", "source_size", "target", "taken")


def op2_warc_normaliser(spark, sf_dir):
    # Damage shows: a payload that does not agree with its record has no digest.
    return warc.round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", F.when(F.col("sound"), F.col("payload_digest")).alias("payload_digest"), "record_type", "refers_to")


def op3_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), only=~toxicity.held_out())
    return written(toxicity.scored(docs, model, ["doc_id"]), "scores").select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op4_ngram_jaccard(spark, sf_dir):
    return ngram_join.join_components(table(spark, sf_dir, "documents"))


def op5_masked_lm(spark, sf_dir):
    return masked_lm.score_corpus(table(spark, sf_dir, "documents"))


def op6_order_minhash(spark, sf_dir):
    return order_minhash.fingerprinted(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark, sf_dir):
    measured = written(quality_rules.measure(table(spark, sf_dir, "documents"), ["doc_id", "lang"]), "measures")
    cuts = quality_rules.fit(measured, table(spark, sf_dir, "labels"))
    return quality_rules.judge(measured, cuts).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


def op9_piece_bpe(spark, sf_dir):
    return written(piece_bpe.digests(table(spark, sf_dir, "documents"), model_path()), "encoded")


def op10_weak_labels(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return written(weak_labels.scored(docs, weak_labels.fit(docs)), "scores")


def op11_hard_negatives(spark, sf_dir):
    # Every seventh label is moved on, so that labels and neighbourhoods differ.
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mined(table(spark, sf_dir, "embeddings"), label)


def op12_centroids(spark, sf_dir):
    return centroids.clustered(table(spark, sf_dir, "embeddings"))


def op13_digest_index(spark, sf_dir):
    index = DigestIndex(spark, run_path(spark, "digest-index"))
    return index.ingest(table(spark, sf_dir, "documents"), "documents").select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {f.__name__: f for f in (op1_source_mix, op2_warc_normaliser, op3_toxicity, op4_ngram_jaccard, op5_masked_lm,
                                   op6_order_minhash, op7_quality_rules, op8_url_filter, op9_piece_bpe, op10_weak_labels, op11_hard_negatives, op12_centroids,
                                   op13_digest_index)}



def _centroid_sql(k: int = 40, rounds: int = 5) -> str:
    """The rounds of op12, written out."""
    steps = [f"""WITH x AS (SELECT row_number() OVER () AS r, vec_id, v FROM (
                SELECT vec_id, list_transform(embedding, lambda e: CAST(floor(256 * CAST(e AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
                WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = 64)),
            c0 AS (SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1 AS INTEGER) AS c, v AS m FROM x
                   WHERE vec_id IS NOT NULL QUALIFY c < {k})"""]
    for i in range(rounds + 1):
        steps.append(f"""d{i} AS (SELECT r, c, list_sum(list_transform(range(1, 65), lambda j: (v[j] - m[j]) * (v[j] - m[j]))) AS d FROM x, c{i}),
            a{i} AS (SELECT r, arg_min(c, (d, c)) AS c, CAST(min(d) AS BIGINT) AS d FROM d{i} GROUP BY r)""")
        if i < rounds:
            steps.append(f"""s{i} AS (SELECT c, j, sum(v[j]) AS s, count(*) AS n FROM a{i} JOIN x USING (r), range(1, 65) t(j) GROUP BY c, j),
            n{i} AS (SELECT c, list(CAST((s - ((s % n + n) % n)) // n AS BIGINT) ORDER BY j) AS m FROM s{i} GROUP BY c),
            c{i + 1} AS (SELECT o.c, coalesce(n.m, o.m) AS m FROM c{i} o LEFT JOIN n{i} n ON n.c = o.c)""")
    return ",".join(steps) + f"""
        SELECT x.vec_id, a.c AS cluster, a.d AS distance, CAST(sum(a.d) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
               CAST(sum(a.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m.m, ',')) AS centroid_sha256
        FROM a{rounds} a JOIN x USING (r) JOIN c{rounds} m ON m.c = a.c"""


_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_warc_normaliser": """
        WITH p AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest FROM pages),
        f AS (SELECT payload_digest, max(page_id) AS first_id FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, p.payload_digest,
               CASE WHEN first_id IS NULL OR first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN first_id <> page_id THEN first_id END AS refers_to
        FROM p LEFT JOIN f ON p.payload_digest = f.payload_digest AND payload_bytes >= 1000""",
    "op4_ngram_jaccard": rf"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
        s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
              ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS g FROM w),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        t AS (SELECT doc_id, g FROM s WHERE g IN (SELECT g FROM s GROUP BY g HAVING count(*) > 1)),
        o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY x, y),
        l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * k >= 80 * (a.n + b.n - k)),
        e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
        r AS (SELECT DISTINCT x AS doc_id, x AS c FROM e UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.doc_id)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id
        FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY doc_id) m ON m.doc_id = d.doc_id""",
    "op8_url_filter": rf"""
        WITH u AS (SELECT page_id, {_LOWER.format(r"coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')")} AS host,
                          coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
        r(verdict, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
        f AS (SELECT u.page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(r.verdict, length(r.host || r.path)) AS verdict
              FROM u JOIN r ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path) GROUP BY u.page_id)
        SELECT u.page_id, u.host, u.path, f.rule, coalesce(f.verdict, 'allow') AS verdict FROM u LEFT JOIN f ON u.page_id = f.page_id""",
    "op11_hard_negatives": """
        WITH x AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                          list_transform(embedding, lambda e: floor(256 * CAST(e AS DOUBLE))) AS v FROM embeddings
                   WHERE label IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NOT NULL AND isfinite(e))) = len(embedding)),
        s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
              FROM x a JOIN x b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
              QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INTEGER) AS rank,
               s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
        FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
        QUALIFY rank <= 3""",
    "op12_centroids": _centroid_sql(),
    "op13_digest_index": f"""
        WITH t AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, text_sha256
        FROM t WINDOW g AS (PARTITION BY text_sha256)""",
}
