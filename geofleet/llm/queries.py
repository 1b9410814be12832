"""Registered queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geofleet.llm import (
    cover_tree, decontaminate, exact_dedup, langid, mixing, packing, periodic_runs, pii, prefix_trie, secrets, simhash, toxicity, warc)
from geofleet.llm.common import table


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, mixing.smoothed_weights(docs))


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


def op3_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = warc.resolve_revisits(warc.captures(table(spark, sf_dir, "pages")))
    listed = F.array_sort(F.transform(F.map_entries("headers"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return resolved.withColumn("headers", F.array_join(listed, ";"))


def op4_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"))


def op7_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents")).drop("findings")


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.scan(table(spark, sf_dir, "documents")).drop("findings")


def op9_embedding_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, convs = prefix_trie.graft(prefix_trie.number_turns(table(spark, sf_dir, "conversations")))
    return prefix_trie.trie(turns, convs)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, text): where crc32(doc_id) is divisible by ten, the words from a on repeat the p words there (a and p from the
    checksum); other texts as they are. A null id leaves its text as it is."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")
    n, g = F.size(words), F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    block = F.slice(words, a + 1, p)
    again = F.slice(F.concat(F.slice(words, 1, a), F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))), 1, n)
    planted = (h % 10 == 0) & F.col("text").rlike(r"[^\x20\x09-\x0D]")
    return docs.select("doc_id", F.when(planted, F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.periodic_runs(planted_repeats(table(spark, sf_dir, "documents")))
    rank = lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))
    best = found.withColumn("top", F.array_max(F.transform("runs", rank)))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    listed = F.concat(F.array_join(lines, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
        (-F.col("top.q")).alias("period"), F.floor(1000 * F.col("top.length") / -F.col("top.q")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_mix_sources, op2_pack_sequences, op3_warc_revisits, op4_language_mixture, op5_toxicity, op6_exact_duplicates,
    op7_secret_ownership, op8_personal_data, op9_embedding_links, op10_simhash_groups, op11_prefix_trie, op12_decontaminate,
    op13_periodic_runs)}

#: Host and so on of a URL, as RE2 reads it.
URL = r"^\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::([0-9]*))?([^?#]*)(?:\?([^#]*))?"

#: Kind and pattern of secrets; a run of hex digits, or what follows AKIA, is one match at any length.
SECRETS = (
    ("assign", r"""(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""),
    ("access", "AKIA[A-Z0-9]{16,}"), ("hex", "[0-9a-f]{24,}"),
    ("vendor", r"-----BEGIN [A-Z ]*PRIVATE KEY-----|gh[pousr]_[A-Za-z0-9]{36}|xox[abprs]-[A-Za-z0-9-]{10,}"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
)

SQL = {
    "op3_warc_revisits": f"""
        WITH parts AS (
            SELECT page_id, page_id % 5003 AS hour, page_id % 5003 + 1 + page_id * 31 % 1009 AS later, md5(html) AS digest, strlen(html) AS size,
                   regexp_extract(url, '{URL}', 1) AS host, regexp_extract(url, '{URL}', 2) AS port,
                   regexp_extract(url, '{URL}', 3) AS path, regexp_extract(url, '{URL}', 4) AS query
            FROM pages),
        captured AS (
            SELECT *, 'day ' || (hour // 24) AS modified,
                   regexp_replace(lower(host), '^www[0-9]*\\.|\\.$', '', 'g') || CASE WHEN port IN ('', '80', '443') THEN '' ELSE ':' || port END
                   || rtrim(path, '/') || coalesce('?' || nullif(array_to_string(list_sort(list_filter(string_split(query, '&'),
                       lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(utm_[a-z]+|gclid|fbclid|msclkid|ref|sessionid|sid|phpsessid)(=|$)'))), '&'), ''), '') AS site
            FROM parts),
        found AS (
            SELECT v.page_id, max(struct_pack(h := r.hour, page := r.page_id)).page AS source
            FROM captured v JOIN captured r ON r.site = v.site AND r.hour < v.later GROUP BY v.page_id),
        judged AS (
            SELECT v.*, f.source, r.digest AS r_digest, r.size AS r_size, r.modified AS r_modified, v.page_id % 10 AS kind,
                   CASE WHEN f.source IS NULL THEN 'no_earlier_response' WHEN v.page_id % 10 = 9 THEN 'no_validator'
                        WHEN v.page_id % 10 < 6 AND v.digest = r.digest OR v.page_id % 10 >= 6 AND v.modified = r.modified THEN 'resolved'
                        ELSE 'validator_mismatch' END AS status
            FROM captured v LEFT JOIN found f USING (page_id) LEFT JOIN captured r ON r.page_id = f.source)
        SELECT page_id * 2 + 1 AS record_id, site AS canonical_url, source * 2 AS response_id, status,
               CASE WHEN kind < 6 THEN 'etag' WHEN kind < 9 THEN 'last-modified' END AS validator,
               CASE WHEN status = 'resolved' THEN r_digest END AS payload_digest,
               CASE WHEN status = 'resolved' AND kind < 6
                    THEN 'cache-control=max-age=3600;content-length=' || r_size || ';content-type=text/html;etag=W/"' || digest || '";last-modified=' || r_modified
                    WHEN status = 'resolved'
                    THEN 'cache-control=max-age=60;content-length=' || r_size || ';content-type=text/html;etag="' || r_digest || '";last-modified=' || modified
                    WHEN kind < 6 THEN 'cache-control=max-age=3600;content-length=0;etag=W/"' || digest || '"'
                    WHEN kind < 9 THEN 'age=5;connection=Age;last-modified=' || modified
                    ELSE 'date=' || modified END AS headers
        FROM judged""",
    "op7_secret_ownership": f"""
        WITH d AS (SELECT doc_id, source, min(doc_id) OVER (PARTITION BY source, coalesce(text, '')) AS repo, coalesce(text, '') AS t FROM documents),
        cut AS (
            {" UNION ALL ".join(f"SELECT doc_id, source, repo, {n} AS no, '{kind}' AS kind, regexp_extract_all(t, '{p}') AS ms, regexp_split_to_array(t, '{p}') AS gaps FROM d"
                                for n, (kind, p) in enumerate(SECRETS))}),
        each AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM cut),
        placed AS (
            SELECT doc_id, source, repo, no, kind, ms[i] AS m, CASE WHEN no = 0 THEN regexp_extract(ms[i], '{SECRETS[0][1]}', 2) ELSE ms[i] END AS value,
                   (list_sum(list_transform(gaps[1:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0))::BIGINT AS first
            FROM each),
        found AS (SELECT *, kind || ':' || first || ':' || (first + length(m)) AS span FROM placed WHERE no <> 0 OR length(value) >= 6),
        held AS (SELECT value, count(DISTINCT source) AS owners, count(DISTINCT repo) AS repos FROM found GROUP BY value),
        judged AS (
            SELECT f.*, CASE WHEN h.owners >= 3 OR h.owners = 2 AND h.repos >= 10 THEN 'copied'
                             WHEN length(value) >= 16 AND regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]')
                                  AND len(list_distinct(string_split(value, ''))) >= 8 THEN 'live' ELSE 'unclear' END AS verdict
            FROM found f JOIN held h USING (value))
        SELECT d.doc_id, count(*) FILTER (no = 0) AS n_assign, count(*) FILTER (no = 1) AS n_access, count(*) FILTER (no = 2) AS n_hex,
               sha256(coalesce(string_agg(span, ',' ORDER BY first, no) FILTER (no < 3), '')) AS base_sha256,
               coalesce(string_agg(span, ',' ORDER BY first, no), '') AS spans, count(*) FILTER (verdict = 'live') AS n_live,
               count(*) FILTER (verdict = 'copied') AS n_copied, count(*) FILTER (verdict = 'unclear') AS n_unclear
        FROM d LEFT JOIN judged j ON j.doc_id = d.doc_id GROUP BY d.doc_id""",
    "op9_embedding_links": """
        WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
        link AS (SELECT a.vec_id AS u, b.vec_id AS w FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
        reach AS (SELECT vec_id AS u, vec_id AS w FROM e UNION SELECT r.u, l.w FROM reach r JOIN link l ON l.u = r.w)
        SELECT e.vec_id, (SELECT count(*) FROM link WHERE u = e.vec_id) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
        FROM e JOIN (SELECT u, min(w) AS component_id FROM reach GROUP BY u) c ON c.u = e.vec_id""",
    "op6_exact_duplicates": """
        WITH d AS (
            SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents)
        SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
               sha256(norm) AS text_sha256
        FROM d WINDOW g AS (PARTITION BY norm)""",
    # crc32 of the decimal id, bit by bit; a prefix is known by a digest of its turns' digests.
    "op11_prefix_trie": """
        WITH turned AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                   row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
            FROM conversations WHERE conv_id IS NOT NULL),
        whole AS (
            SELECT c, list(struct_pack(m := md5(strlen(role) || ':' || role || text), l := length(text)) ORDER BY p) AS own,
                   xor(list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
                       lambda s, x: list_reduce([xor(s, x), 0, 0, 0, 0, 0, 0, 0, 0]::UBIGINT[], lambda y, z: xor(y >> 1, 3988292384::UBIGINT * (y & 1)))),
                       4294967295::UBIGINT) % 6 AS h
            FROM turned GROUP BY c),
        rebuilt AS (
            SELECT w.c, list_concat(coalesce(b.own, [])[1:w.h], w.own[w.h + 1:]) AS t FROM whole w LEFT JOIN whole b ON b.c = w.c - w.c % 100),
        prefixed AS (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt),
        keyed AS (
            SELECT c, d, len(t) AS n, CASE WHEN d = 0 THEN '' ELSE md5(array_to_string(list_transform(t[1:d], lambda x: x.m), '')) END AS k,
                   CASE WHEN d = 1 THEN '' WHEN d > 1 THEN md5(array_to_string(list_transform(t[1:d - 1], lambda x: x.m), '')) END AS up,
                   CASE WHEN d = 0 THEN 0 ELSE t[d].l END AS l
            FROM prefixed),
        nodes AS (
            SELECT d, k, any_value(up) AS up, min(c) AS c, count(*) AS n_convs, (count(*) - 1) * any_value(l) AS v,
                   sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (n = d), '')) AS ends_sha256
            FROM keyed GROUP BY d, k),
        kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY ALL),
        counted AS (SELECT x.*, coalesce(y.n, 0) AS n_children FROM nodes x LEFT JOIN kids y USING (d, k)),
        chains AS (SELECT DISTINCT a.d AS ad, a.k AS ak, x.d, x.k FROM keyed a JOIN keyed x ON x.c = a.c AND x.d >= a.d),
        sums AS (
            SELECT ad AS d, ak AS k, sum(y.v)::BIGINT AS saved_tokens, count(*) FILTER (y.n_children = 0) AS n_leaves
            FROM chains z JOIN counted y ON y.d = z.d AND y.k = z.k GROUP BY ALL)
        SELECT x.c AS conv_id, x.d AS depth, p.c AS parent_conv_id, x.n_convs, x.n_children, s.n_leaves, s.saved_tokens, x.ends_sha256
        FROM counted x JOIN sums s USING (d, k) LEFT JOIN nodes p ON p.d = x.d - 1 AND p.k = x.up""",
    "op12_decontaminate": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (
            SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        cut AS (SELECT item, w, least(len(w), 10) AS t, unnest(range(0, len(w) - least(len(w), 10) + 1)) AS s FROM items WHERE len(w) > 0),
        known AS (SELECT DISTINCT item, t, array_to_string(w[s + 1:s + t], ' ') AS k FROM cut),
        sized AS (SELECT r, w, t, unnest(range(0, len(w) - t + 1)) AS s FROM docs, (SELECT DISTINCT t FROM known) WHERE len(w) >= t),
        hits AS (SELECT r, s, t, item FROM (SELECT r, s, t, array_to_string(w[s + 1:s + t], ' ') AS k FROM sized) JOIN known USING (t, k)),
        covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(s, s + t)) AS p FROM (SELECT DISTINCT r, s, t FROM hits)) GROUP BY r),
        named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
        SELECT doc_id, len(w) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items, sha256(coalesce(i.l, '')) AS items_sha256,
               coalesce(c.n, 0) > 0 AS contaminated
        FROM docs LEFT JOIN covered c USING (r) LEFT JOIN named i USING (r)""",
}
