"""The thin queries of this package's operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from siftwell.llm.common import fold_of, table

#: The rank file that the queries encode with; the operators take any.
RANKS = "byte_bpe_multi_50k.tiktoken"
#: The score from which a row is predicted to have label 1.
LIMIT = 0.7


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _judged(docs: DataFrame, scores: DataFrame, parts: int, held: int) -> DataFrame:
    return scores.select("doc_id", (fold_of(F.col("doc_id"), parts) == held).alias("held_out"), "score", (F.col("score") >= LIMIT).cast("int").alias("predicted"))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import ngram_join

    return ngram_join.join(table(spark, sf_dir, "documents"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), ranks_path())


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import toxicity

    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, toxicity.score(docs, model), 3, 1)


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import html_extract

    return html_extract.extract(table(spark, sf_dir, "pages"), html_extract.train())


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import quality_ftrl

    docs = table(spark, sf_dir, "documents")
    weights = quality_ftrl.train(docs, table(spark, sf_dir, "labels"))
    return _judged(docs, quality_ftrl.score(docs, weights), 4, 2)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import quality_rules

    return quality_rules.judge(table(spark, sf_dir, "documents"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import warc

    archive = warc.write(table(spark, sf_dir, "pages"), least=0)
    return warc.read(spark, archive).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import decontam

    return decontam.flags(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of each line of every document."""
    from siftwell.llm import token_counts

    return token_counts.count(table(spark, sf_dir, "documents"), ranks_path())


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import secrets

    return secrets.digests(table(spark, sf_dir, "documents"))


def op11_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from siftwell.llm import simhash

    return simhash.join(table(spark, sf_dir, "documents"))


def op12_dimension_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Client versions from client_changes; changes with an id of crc32 divisible by 5 took effect 720 hours earlier."""
    from siftwell.llm import dimension

    changes = table(spark, sf_dir, "client_changes")
    at = dimension.micros(changes, "valid_at") - F.when(fold_of(F.col("change_id"), 5) == 0, 720 * 3_600_000_000).otherwise(0)
    attributes = {x: F.col(x) for x in ("source", "segment", "city")} | {"balance_cents": F.floor(100 * F.col("balance") + 0.5).cast("long")}
    return dimension.versions(changes, "client_id", "change_id", "seq", "op", at, attributes)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, held against texts that lost their line breaks where crc32 of the id is even."""
    from siftwell.llm import merkle

    docs = table(spark, sf_dir, "documents")
    fields = [F.col(x) for x in ("doc_id", "source", "lang", "n_chars", "text")]
    harmed = F.when(fold_of(F.col("doc_id"), 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    out = merkle.proofs(docs, "source", "doc_id", merkle.leaf(*fields), merkle.leaf(*fields[:-1], harmed))
    return out.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


QUERIES = {f.__name__: f for f in (op1_ngram_jaccard_join, op2_byte_bpe, op3_toxicity, op4_html_extraction, op5_quality_classifier, op6_quality_rules, op7_warc, op8_benchmark_decontamination, op9_token_counts, op10_secret_scan, op11_simhash_dedup, op12_dimension_merge, op13_merkle_manifest)}

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT doc_id, list_distinct(CASE
        WHEN len(w) = 0 THEN []
        WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s
    FROM words
), classes AS (
    SELECT min(doc_id) AS id, len(s) AS n, s FROM (SELECT doc_id, list_sort(s) AS s FROM shingles WHERE len(s) > 0) GROUP BY s
), tokens AS (
    SELECT id, n, unnest(s) AS token FROM classes
), shared AS (
    SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS n
    FROM tokens a JOIN tokens b ON a.token = b.token AND a.id < b.id
    GROUP BY ALL
), edges AS (
    SELECT a, b FROM shared WHERE 100 * n >= 85 * (na + nb - n)
    UNION ALL SELECT b, a FROM shared WHERE 100 * n >= 85 * (na + nb - n)
), reach(id, other) AS (
    SELECT id, id FROM classes
    UNION SELECT r.id, e.b FROM reach r JOIN edges e ON r.other = e.a
), component AS (
    SELECT id, min(other) AS component_id FROM reach GROUP BY id
)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(k.component_id, s.doc_id) AS component_id
FROM shingles s LEFT JOIN classes c ON len(s.s) > 0 AND c.s = list_sort(s.s) LEFT JOIN component k ON k.id = c.id
"""

ORACLE_SQL["op7_warc"] = r"""
WITH p AS (
    SELECT page_id, coalesce(html, '') AS h, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages
), d AS (
    SELECT page_id, top, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS x FROM p
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(x, CAST(k // 4 AS INTEGER) * 5 + 1, 5) AS INTEGER) >> CAST(15 - 5 * (k % 4) AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> top THEN top END AS refers_to
FROM d
"""

ORACLE_SQL["op8_benchmark_decontamination"] = r"""
WITH d AS (
    SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), b AS (
    SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark
), dw AS (
    SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM d
), bw AS (
    SELECT item_id, len(w) AS n, unnest(w) AS w, unnest(range(len(w))) AS j FROM b
), same AS (
    SELECT doc_id, item_id, i - j AS shift, j, least(13, n) AS run, CAST(ceil(least(13, n) * 11.0 / 13) AS BIGINT) AS need FROM dw JOIN bw USING (w)
), runs AS (
    SELECT doc_id, item_id, shift, run, need, list_sort(list(j)) AS js FROM same GROUP BY ALL HAVING count(*) >= any_value(need)
), hit AS (
    SELECT DISTINCT doc_id, item_id FROM runs WHERE len(list_filter(range(1, len(js) - need + 2), lambda k: js[k + need - 1] - js[k] < run)) > 0
), found AS (
    SELECT doc_id, count(*) AS n_items, min(item_id) AS first_item FROM hit GROUP BY doc_id
)
SELECT documents.doc_id, n_items IS NOT NULL AS contaminated, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, first_item FROM documents LEFT JOIN found USING (doc_id)
"""

ORACLE_SQL["op12_dimension_merge"] = r"""
WITH crc AS (
    SELECT change_id, xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(change_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda acc, x: xor(xor(acc, x) >> 1, 3988292384 * (xor(acc, x) & 1)), 4294967295)) AS crc
    FROM (SELECT DISTINCT change_id FROM client_changes)
), moved AS (
    SELECT DISTINCT client_id, change_id, seq, op, source, segment, city, CAST(floor(100 * balance + 0.5) AS BIGINT) AS balance_cents,
        epoch_us(valid_at) - CASE WHEN crc % 5 = 0 THEN 2592000000000 ELSE 0 END AS t
    FROM client_changes LEFT JOIN crc USING (change_id) WHERE valid_at IS NOT NULL
), by_seq AS (
    SELECT * FROM moved QUALIFY row_number() OVER (PARTITION BY client_id, seq ORDER BY change_id DESC NULLS LAST, t DESC) = 1
), kept AS (
    SELECT * FROM (SELECT * FROM by_seq QUALIFY row_number() OVER (PARTITION BY client_id, t ORDER BY seq DESC NULLS LAST, change_id DESC NULLS LAST) = 1) WHERE op IN ('D', 'I', 'U')
), epochs AS (
    SELECT *, sum(CASE WHEN op IN ('D', 'I') THEN 1 ELSE 0 END) OVER (PARTITION BY client_id ORDER BY t) AS epoch FROM kept
), states AS (
    SELECT client_id, t, seq, {'gone': op = 'D',
        'source': last_value(CASE WHEN op <> 'D' THEN source END IGNORE NULLS) OVER e, 'segment': last_value(CASE WHEN op <> 'D' THEN segment END IGNORE NULLS) OVER e,
        'city': last_value(CASE WHEN op <> 'D' THEN city END IGNORE NULLS) OVER e, 'cents': last_value(CASE WHEN op <> 'D' THEN balance_cents END IGNORE NULLS) OVER e} AS state
    FROM epochs WINDOW e AS (PARTITION BY client_id, epoch ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
), starts AS (
    SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY t) AS version, lead(t) OVER (PARTITION BY client_id ORDER BY t) AS until
    FROM (SELECT *, lag(state) OVER (PARTITION BY client_id ORDER BY t) AS before FROM states) WHERE before IS DISTINCT FROM state
), held AS (
    SELECT s.client_id, s.version, count(DISTINCT m.change_id) AS n_changes
    FROM starts s LEFT JOIN moved m ON m.client_id IS NOT DISTINCT FROM s.client_id AND m.t >= s.t AND (s.until IS NULL OR m.t < s.until)
    GROUP BY ALL
)
SELECT s.client_id, CAST(s.version AS INTEGER) AS version, CAST(floor(s.t / 1000000) AS BIGINT) AS valid_from, CAST(floor(s.until / 1000000) AS BIGINT) AS valid_to, state.gone AS is_deleted,
    state.source AS source, state.segment AS segment, state.city AS city, state.cents AS balance_cents, s.seq AS first_seq, h.n_changes
FROM starts s JOIN held h ON s.client_id IS NOT DISTINCT FROM h.client_id AND s.version = h.version
"""

ORACLE_SQL["op13_merkle_manifest"] = r"""
WITH RECURSIVE crc AS (
    SELECT doc_id, xor(4294967295, list_reduce(flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda acc, x: xor(xor(acc, x) >> 1, 3988292384 * (xor(acc, x) & 1)), 4294967295)) AS crc
    FROM (SELECT DISTINCT doc_id FROM documents)
), parts AS (
    SELECT doc_id, coalesce('=' || source, '') AS grp, text, CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS harmed,
        concat(coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-'), coalesce(octet_length(encode(source)) || ':' || source, '-'),
            coalesce(octet_length(encode(lang)) || ':' || lang, '-'), coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-')) AS head
    FROM documents LEFT JOIN crc USING (doc_id)
), leaves AS (
    SELECT doc_id, grp, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf, sha256(head || coalesce(octet_length(encode(harmed)) || ':' || harmed, '-')) AS claimed
    FROM parts
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank FROM leaves
), low(level, grp, rank, digest, n) AS (
    SELECT 0, grp, rank, leaf, count(*) OVER (PARTITION BY grp) FROM ranked
    UNION ALL
    SELECT any_value(level) + 1, grp, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 2) // 3 FROM low WHERE n > 1 GROUP BY grp, rank // 3
), subroots AS (
    SELECT grp, digest, row_number() OVER (ORDER BY encode(grp)) - 1 AS rank FROM low WHERE n = 1
), high(level, rank, digest, n) AS (
    SELECT 0, rank, digest, count(*) OVER () FROM subroots
    UNION ALL
    SELECT any_value(level) + 1, rank // 3, sha256(string_agg(digest, '' ORDER BY rank)), (any_value(n) + 2) // 3 FROM high WHERE n > 1 GROUP BY rank // 3
), nodes AS (
    SELECT level, grp, rank, digest, n FROM low UNION ALL SELECT 1000 + level, NULL, rank, digest, n FROM high
), runs AS (
    SELECT level, grp, rank // 3 AS run, any_value(n) AS n, list(digest ORDER BY rank) AS run_nodes FROM nodes GROUP BY ALL
), climb(doc_id, leaf, grp, level, rank, siblings, folded, done) AS (
    SELECT doc_id, leaf, grp, 0, rank, '', claimed, false FROM ranked
    UNION ALL
    SELECT c.doc_id, c.leaf, c.grp,
        CASE WHEN r.n > 1 THEN c.level + 1 ELSE 1000 END, CASE WHEN r.n > 1 THEN c.rank // 3 ELSE s.rank END,
        CASE WHEN r.n > 1 THEN c.siblings || array_to_string(r.run_nodes[1:c.rank % 3], '') || array_to_string(r.run_nodes[c.rank % 3 + 2:3], '') ELSE c.siblings END,
        CASE WHEN r.n > 1 THEN sha256(array_to_string(r.run_nodes[1:c.rank % 3], '') || c.folded || array_to_string(r.run_nodes[c.rank % 3 + 2:3], '')) ELSE c.folded END,
        r.n = 1 AND c.level >= 1000
    FROM climb c JOIN runs r ON r.level = c.level AND r.run = c.rank // 3 AND (r.grp = c.grp OR c.level >= 1000) JOIN subroots s ON s.grp = c.grp
    WHERE NOT c.done
)
SELECT c.doc_id, c.leaf, s.digest AS subroot, t.digest AS root, sha256(c.siblings) AS proof_sha256, c.folded AS folded_root, c.folded = t.digest AS verified
FROM climb c JOIN subroots s USING (grp) JOIN (SELECT digest FROM high WHERE n = 1) t ON true
WHERE c.done
"""
