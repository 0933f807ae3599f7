"""Registered queries of the operators (``opN_<name>``) and their SQL."""

from __future__ import annotations

import functools
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterlake.llm import (
    alignment,
    decontaminate,
    exact_dedup,
    fixity,
    hard_negatives,
    host_reputation,
    html_text,
    licences,
    minhash,
    pieces,
    quality,
    simhash,
    token_counts,
)

from meterlake.llm.tables import batches_of_texts, text_files_for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sized(out: DataFrame, source: DataFrame, text_col: str = "text") -> DataFrame:
    """A result made from the source's texts, in as many partitions (files) as
    their bytes ask for."""
    return out.coalesce(text_files_for(source, text_col))


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def op1_merkle_fixity(spark, sf_dir):
    """The pages as WARC files and a replica with known damage: by the first
    two hex digits of md5(page_id), 00: the replica's payload is changed, 01:
    the replica lacks the record, 02: the primary lacks it."""
    pages = table(spark, sf_dir, "pages")
    # pages without an id are audited too, and are sound
    mark = F.coalesce(F.substring(F.md5(F.col("page_id").cast("string").cast("binary")), 1, 2), F.lit(""))
    sound = fixity.lay_out(fixity.page_records(pages))
    # the damaged copies keep their places
    changed = pages.where(mark == "00").withColumn("html", F.concat(F.lit("#"), F.expr("substring(coalesce(html, ''), 2)")))
    digests = fixity.page_records(changed).select("record_id", F.col("length").alias("_length"), F.col("digest").alias("_digest")).distinct()
    replica = sound.where(mark != "01").join(digests, "record_id", "left")
    replica = replica.withColumn("length", F.coalesce("_length", "length")).withColumn("digest", F.coalesce("_digest", "digest"))
    found = fixity.audit(sound.where(mark != "02"), replica)
    return found.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("primary_length", "replica_length")})


def op2_simhash_near_dedup(spark, sf_dir):
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id"
    )


def op3_sentencepiece(spark, sf_dir):
    model = tokenizer_file("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # the texts stay behind: the decoded ones are compared by length and hash
    marked = docs.select("doc_id", "text", F.octet_length("text").alias("n_bytes"), F.xxhash64("text").alias("hash"))
    encoded = pieces.encode(marked, model).select("doc_id", "n_bytes", "hash", "ids")
    decoded = pieces.decode(encoded, model)
    same = (F.xxhash64("decoded") == F.col("hash")) & (F.octet_length("decoded") == F.col("n_bytes"))
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.xxhash64("ids").alias("ids_xxh64"),
        F.coalesce(same, F.lit(True)).alias("round_trip"),  # a null text decodes to an empty one
    )


def op4_exact_dedup(spark, sf_dir):
    groups = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", F.col("_sha").alias("text_sha256"))


def op5_token_counts(spark, sf_dir):
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op6_html_extraction(spark, sf_dir):
    return html_text.extract_pages(table(spark, sf_dir, "pages"))


def op7_licence_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return licences.scan(docs, licences.train(docs))


def op8_quality_classifier(spark, sf_dir):
    return quality.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_benchmark_decontamination(spark, sf_dir):
    found = decontaminate.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.groupBy("doc_id", "item_id").agg(
        F.max("containment").alias("containment"),
        F.max("n_shared").alias("n_shared"),
        F.max("n_shingles").alias("n_shingles"),
    )


def op10_url_filter(spark, sf_dir):
    pages, docs, labels = (table(spark, sf_dir, t) for t in ("pages", "documents", "labels"))
    return host_reputation.judge_urls(pages, host_reputation.labelled_pages(pages, docs, labels))


def op11_cross_tokenizer_alignment(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_hard_negatives(spark, sf_dir):
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"))


def op13_minhash_near_dedup(spark, sf_dir):
    groups = minhash.near_groups(table(spark, sf_dir, "documents"))
    kept = F.col("doc_id").eqNullSafe(F.col("component_id"))
    return groups.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def _sized_by(name: str, query):
    """The query, its result sized by the table that it goes through."""

    @functools.wraps(query)
    def run(spark, sf_dir):
        batches_of_texts(spark)
        return sized(query(spark, sf_dir), table(spark, sf_dir, name), "html" if name == "pages" else "text")

    return run


QUERIES = {
    "op1_merkle_fixity": _sized_by("pages", op1_merkle_fixity),
    "op2_simhash_near_dedup": _sized_by("documents", op2_simhash_near_dedup),
    "op3_sentencepiece": _sized_by("documents", op3_sentencepiece),
    "op4_exact_dedup": _sized_by("documents", op4_exact_dedup),
    "op5_token_counts": _sized_by("documents", op5_token_counts),
    "op6_html_extraction": _sized_by("pages", op6_html_extraction),
    "op7_licence_scan": _sized_by("documents", op7_licence_scan),
    "op8_quality_classifier": _sized_by("documents", op8_quality_classifier),
    "op9_benchmark_decontamination": _sized_by("documents", op9_benchmark_decontamination),
    "op10_url_filter": _sized_by("pages", op10_url_filter),
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_minhash_near_dedup": op13_minhash_near_dedup,
}

ORACLE_SQL = {
    "op1_merkle_fixity": r"""
        WITH r AS (
            SELECT *, substr(md5(CAST(page_id AS VARCHAR)), 1, 2) AS mark, 'urn:page:' || page_id AS record_id,
                   'crawl-' || lpad(CAST(page_id // 1000 AS VARCHAR), 8, '0') || '.warc' AS file,
                   coalesce(html, '') AS body, '#' || substr(coalesce(html, ''), 2) AS broken, chr(13) || chr(10) AS nl
            FROM pages),
        t AS (
            SELECT *, 'WARC/1.0' || nl || 'WARC-Type: response' || nl || 'WARC-Record-ID: <' || record_id || '>' || nl
                      || 'WARC-Target-URI: ' || coalesce(url, '') || nl || 'Content-Length: ' AS head FROM r),
        w AS (
            SELECT *, head || strlen(body) || nl || nl || body || nl || nl AS a,
                      head || strlen(broken) || nl || nl || broken || nl || nl AS b FROM t),
        p AS (
            SELECT *, CAST(coalesce(sum(strlen(a)) OVER (PARTITION BY file ORDER BY page_id, sha256(a)
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM w)
        SELECT file, "offset", record_id,
               CASE mark WHEN '00' THEN 'changed' WHEN '01' THEN 'missing' ELSE 'extra' END AS status,
               CASE WHEN mark != '02' THEN strlen(a) ELSE 0 END AS primary_length,
               CASE WHEN mark != '02' THEN sha256(a) END AS primary_digest,
               CASE mark WHEN '00' THEN strlen(b) WHEN '02' THEN strlen(a) ELSE 0 END AS replica_length,
               CASE mark WHEN '00' THEN sha256(b) WHEN '02' THEN sha256(a) END AS replica_digest
        FROM p WHERE mark IN ('00', '01', '02')""",
    "op10_url_filter": r"""
        WITH u AS (
            SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
        p AS (
            SELECT page_id, html, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        shown AS (
            SELECT host, regexp_replace(regexp_replace(regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1),
                   '(?s)<h1.*?</h1>|<[^>]*>|&[#0-9A-Za-z]+;', '', 'g'), '[^\p{L}\p{N}]+', '', 'g') AS t FROM p),
        quality AS (SELECT doc_id, min(quality) AS q, max(quality) AS q2 FROM labels WHERE quality IN (0, 1) GROUP BY doc_id),
        sure AS (
            SELECT t, min(q) AS q FROM (SELECT regexp_replace(coalesce(text, ''), '[^\p{L}\p{N}]+', '', 'g') AS t, q, q2
            FROM documents JOIN quality USING (doc_id)) GROUP BY t HAVING min(q) = max(q2)),
        outcomes AS (SELECT host, 1 - q AS bad FROM shown JOIN sure USING (t) WHERE t != ''),
        hosts AS (
            SELECT host, count(*) AS n, sum(bad) AS b, string_split(host, '.') AS l,
                   CASE WHEN len(l[-1]) = 2 AND coalesce(l[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org'), false) THEN 2 ELSE 1 END AS k,
                   array_to_string(l[-least(len(l), k + 1):], '.') AS domain, array_to_string(l[-least(len(l), k):], '.') AS suffix
            FROM outcomes GROUP BY host),
        domains AS (SELECT domain, suffix, sum(n) AS n, sum(b) AS b FROM hosts GROUP BY ALL),
        suffixes AS (SELECT suffix, sum(n) AS n, sum(b) AS b FROM domains GROUP BY ALL),
        spread AS (
            SELECT level, sum(n)::DOUBLE AS n, sum(b) / sum(n) AS m, sum(n * n) AS nn, sum(b * b / n) AS bb, count(*) AS k FROM (
                SELECT 's' AS level, n, b FROM suffixes UNION ALL SELECT 'd', n, b FROM domains UNION ALL SELECT 'h', n, b FROM hosts)
            GROUP BY level),
        between_ AS (SELECT level, k, m, CASE WHEN n - nn / n > 0 THEN (bb - n * m * m - (k - 1) * m * (1 - m)) / (n - nn / n) ELSE 0 END AS v FROM spread),
        strength AS (
            SELECT level, CASE WHEN k < 2 OR v <= 0 THEN 1000.0 ELSE least(greatest(m * (1 - m) / v - 1, 1.0), 1000.0) END AS s FROM between_),
        ks AS (SELECT (SELECT s FROM strength WHERE level = 's') AS s, (SELECT s FROM strength WHERE level = 'd') AS d,
                      (SELECT s FROM strength WHERE level = 'h') AS h, (SELECT sum(n) FROM suffixes) AS total, (SELECT (sum(b) + 1) / (sum(n) + 2) FROM suffixes) AS top),
        means AS (
            SELECT host, hosts.n, least(ks.h, ks.total) AS kh,
                   (((( ks.top * ks.s + suffixes.b) / (suffixes.n + ks.s)) * ks.d + domains.b) / (domains.n + ks.d) * ks.h + hosts.b)
                   / (hosts.n + ks.h) AS mean
            FROM hosts JOIN domains USING (domain) JOIN suffixes ON suffixes.suffix = domains.suffix, ks),
        blocked AS (SELECT host FROM means WHERE mean - 1.645 * sqrt(mean * (1 - mean) / (n + kh + 1)) > 0.25),
        ruled AS (
            SELECT page_id, host, path,
                   CASE WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
                        WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
                        WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
                        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule FROM p)
        SELECT page_id, host, path, rule,
               CASE rule WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block' WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
                    ELSE CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END END AS verdict
        FROM ruled""",
    "op12_hard_negatives": r"""
        WITH taken AS (
            SELECT row_number() OVER () AS r, vec_id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.r AS ar, a.vec_id AS anchor_id, c.r AS cr, c.vec_id, a.label = c.label AS same,
                   CAST(list_dot_product(a.v, c.v) AS BIGINT) AS score
            FROM taken a JOIN taken c ON a.vec_id % 100 = 0 AND a.r != c.r),
        positives AS (
            SELECT * FROM scored WHERE same
            QUALIFY row_number() OVER (PARTITION BY ar ORDER BY score DESC, vec_id NULLS LAST, cr) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
               CAST(row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY n.score DESC, n.vec_id NULLS LAST, n.cr) AS INTEGER) AS rank,
               n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n
          ON n.ar = p.ar AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
        QUALIFY row_number() OVER (PARTITION BY p.ar, p.cr ORDER BY n.score DESC, n.vec_id NULLS LAST, n.cr) <= 5""",
    "op9_benchmark_decontamination": r"""
        WITH words AS (
            SELECT 0 AS kind, doc_id AS id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
            UNION ALL
            SELECT 1, item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') FROM benchmark),
        lengths AS (SELECT DISTINCT least(len(w), 5) AS k FROM words WHERE kind = 1 AND len(w) > 0),
        cuts AS (
            SELECT kind, id, w, least(len(w), 5) AS k FROM words WHERE kind = 1 AND len(w) > 0
            UNION ALL
            SELECT kind, id, w, k FROM words JOIN lengths ON kind = 0 AND len(w) >= k),
        starts AS (SELECT kind, id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM cuts),
        shingles AS (SELECT DISTINCT kind, id, array_to_string(w[i:i + k - 1], ' ') AS s FROM starts),
        sizes AS (SELECT id, count(*) AS n FROM shingles WHERE kind = 1 GROUP BY id)
        SELECT d.id AS doc_id, b.id AS item_id, count(*) / any_value(z.n) AS containment, count(*) AS n_shared,
               any_value(z.n) AS n_shingles
        FROM shingles d JOIN shingles b ON d.s = b.s AND d.kind = 0 AND b.kind = 1 JOIN sizes z ON z.id = b.id
        GROUP BY d.id, b.id HAVING count(*) >= 0.8 * any_value(z.n) - 1e-9""",
    "op4_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
               doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY t)
                 AND row_number() OVER (PARTITION BY t, doc_id) = 1 AS kept,
               sha256(t) AS text_sha256
        FROM n""",
}
