"""The operators over their whole tables, with production parameters, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    chat,
    cover_tree,
    decontaminate,
    lexical,
    ngram_join,
    packing,
    quality,
    simhash,
    token_counts,
    topk,
    toxicity,
    url_filter,
    warc,
)
from ledgerloom.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer(name: str) -> str:
    """The place of a public vocabulary file, as the installed ``public_tokenizers`` has it."""
    import public_tokenizers

    return public_tokenizers.path(name)


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(make: Query) -> Query:
    QUERIES[make.__name__] = make
    return make


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents: five words, similarity 0.75."""
    return ngram_join.near_duplicates(table(spark, sf_dir, "documents")).drop("class")


ORACLES["op8_ngram_jaccard_join"] = r"""
WITH RECURSIVE
split AS (
    SELECT doc_id, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\x20\x09-\x0D]+') AS parts
    FROM documents
),
words AS (SELECT doc_id, [p FOR p IN parts IF p <> ''] AS w FROM split),
shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS shingle
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM words WHERE len(w) >= 5)
    UNION
    SELECT doc_id, array_to_string(w, ' ') FROM words WHERE len(w) BETWEEN 1 AND 4
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
meets AS (
    SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id
),
links AS (
    SELECT a, b FROM meets m JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
    WHERE 100 * m.n >= 75 * (x.n + y.n - m.n)
),
reach(doc_id, other) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.doc_id, l.b FROM reach r JOIN links l ON r.other = l.a
)
SELECT d.doc_id, coalesce(s.n, 0)::BIGINT AS n_shingles,
       least(d.doc_id, coalesce(r.low, d.doc_id)) AS component_id
FROM documents d
LEFT JOIN sizes s ON s.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS low FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""


@query
def op7_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.packed_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


@query
def op9_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts.token_counts(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


@query
def op4_kneser_ney_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learned from the labels outside fold 0."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: host, path, verdict
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
_RULE_ROWS = ", ".join(map(str, URL_RULES))


@query
def op10_bloom_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL against the rules."""
    rules = spark.sql(f"SELECT * FROM VALUES {_RULE_ROWS} AS rules(host, path, verdict)")
    return url_filter.judged(table(spark, sf_dir, "pages"), rules)


ORACLES["op10_bloom_url_filter"] = f"""
WITH rules(rule_host, rule_path, verdict) AS (VALUES {_RULE_ROWS}),
rests AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS raw_host FROM rests),
parts AS (
    SELECT page_id, rest,
           translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(substr(rest, length(raw_host) + 1), '^[^?#]*') AS path
    FROM hosts
),
pairs AS (SELECT DISTINCT host, path FROM parts),
fits AS (
    SELECT p.host, p.path, rule_host || rule_path AS rule, r.verdict,
           row_number() OVER (PARTITION BY p.host, p.path
                              ORDER BY length(rule_host || rule_path) DESC, length(rule_host) DESC) AS place
    FROM pairs p
    JOIN rules r ON (p.host = rule_host OR ends_with(p.host, '.' || rule_host)) AND starts_with(p.path, rule_path)
)
SELECT page_id, p.host, p.path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fits f ON p.host = f.host AND p.path = f.path AND place = 1
"""


@query
def op6_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents hold, whatever values fill their slots."""
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op5_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade and tail probabilities of all documents, learned outside fold 0."""
    return quality.rated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op2_content_addressed_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page archived, read back and checked."""
    return warc.read_archive(warc.write_archive(table(spark, sf_dir, "pages")))


ORACLES["op2_content_addressed_warc"] = """
WITH own AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
           sha256(coalesce(html, '')) AS strong
    FROM pages
),
kept AS (SELECT *, max(page_id) OVER (PARTITION BY strong) AS keeper FROM own)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes < 1000 OR page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM kept
"""


#: A conversation that looks like the template itself.
CLASH_ID, CLASH_TEXT = -7, r"\### Assistant: </turn> ok"


@query
def op3_chat_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that clashes with the template, formatted and read back."""
    columns = ["conv_id", "turn", "role", "text"]
    clash = spark.range(2).select(
        F.lit(CLASH_ID).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CLASH_TEXT).alias("text"),
    )
    return chat.formatted_conversations(table(spark, sf_dir, "conversations").select(columns).union(clash))


ORACLES["op3_chat_round_trip"] = rf"""
WITH own AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT {CLASH_ID}, 0, 'user', '{CLASH_TEXT}'
    UNION ALL SELECT {CLASH_ID}, 1, 'assistant', '{CLASH_TEXT}'
),
written AS (
    SELECT *, regexp_replace(text, '(\\*(?:### |</turn>))', '\\\1', 'g') AS body,
           regexp_replace(regexp_replace(role, '\\', '\\\\', 'g'), '[\n\r]', '\\n', 'g') AS role_line
    FROM own
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(4 + length(role_line) + 2 + length(body) + 9)::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""


@query
def op1_uniform_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best inner products of every hundredth vector."""
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


ORACLES["op1_uniform_threshold_topk"] = """
WITH whole AS (
    SELECT row_number() OVER () AS place, vec_id, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scores AS (
    SELECT q.place AS own, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
    FROM whole q JOIN whole c ON q.place <> c.place AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY own ORDER BY score DESC, vec_id) AS rank FROM scores)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""


@query
def op11_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three hard negatives for each of the five positives of every fiftieth vector; every seventh label is wrong."""
    rows = table(spark, sf_dir, "embeddings")
    wrong = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return cover_tree.hard_negatives(rows.withColumn("label", wrong), F.col("vec_id") % 50 == 0)


ORACLES["op11_cover_tree_negatives"] = """
WITH whole AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scores AS (
    SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, list_inner_product(a.v, c.v)::BIGINT AS score
    FROM whole a JOIN whole c ON a.vec_id <> c.vec_id AND len(a.v) = len(c.v) WHERE a.vec_id % 50 = 0
),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id))::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


@query
def op12_simhash_pivot_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, linked at four or fewer differing bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_hybrid_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents of every benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_hybrid_lexical_search"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents WHERE text IS NOT NULL
),
sizes AS (SELECT doc_id, len(w) AS n FROM words WHERE len(w) > 0),
totals AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
held AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term FROM words) GROUP BY doc_id, term),
asked AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
),
weights AS (
    SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM held, totals GROUP BY term, docs
),
scores AS (
    SELECT item_id, doc_id,
           sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))))::BIGINT AS score
    FROM asked JOIN held USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), totals
    GROUP BY item_id, doc_id
),
placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM placed WHERE place <= 50
"""
