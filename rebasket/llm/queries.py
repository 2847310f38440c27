"""The registered queries of this package, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rebasket.llm.align import align_texts
from rebasket.llm.decontaminate import contamination_digest, find_contamination
from rebasket.llm.licences import scan_licences
from rebasket.llm.lm import score_texts
from rebasket.llm.minhash import near_duplicates
from rebasket.llm.mixing import mix, mixed_words
from rebasket.llm.paragraphs import repeated_passages
from rebasket.llm.phrases import phrases
from rebasket.llm.sharding import shard_documents
from rebasket.llm.tokens import count_tokens
from rebasket.llm.topk import top_k
from rebasket.llm.toxicity import fit, held_out, score_toxicity
from rebasket.llm.warc import archived_pages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]):
    QUERIES[build.__name__] = build
    return build


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op1_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return mixed_words(mix(table(spark, folder, "documents"), "doc_id"))


@query
def op2_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), width=2)


ORACLES["op2_near_duplicates"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[k:k + 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS k FROM docs WHERE len(w) > 0)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id, doc_id AS other FROM docs
  UNION SELECT doc_id, b FROM reach JOIN both_ways ON a = other
), classes AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM docs LEFT JOIN sizes USING (doc_id) JOIN classes USING (doc_id)
"""


@query
def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = table(spark, folder, "documents"), table(spark, folder, "benchmark")
    return contamination_digest(find_contamination(docs, items))


_PLAIN = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

ORACLES["op3_decontamination"] = f"""
WITH docs AS (SELECT doc_id, {_PLAIN} AS w FROM documents
), items AS (SELECT item_id, {_PLAIN} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM items WHERE len(w) > 0)
), places AS (
  SELECT doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k
    FROM docs, (SELECT DISTINCT n FROM windows))
), hits AS (
  SELECT doc_id, item_id, k, p.n FROM places p JOIN windows w ON w.s = p.s AND w.n = p.n
), words AS (
  SELECT doc_id, count(*) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(k, k + n)) AS place FROM hits) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""


@query
def op4_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(table(spark, folder, "documents"))


@query
def op5_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(table(spark, folder, "documents"))


@query
def op6_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


ORACLES["op6_exact_top_k"] = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NOT NULL AND isfinite(x)]) = len(embedding)
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum([q.v[i] * c.v[i] FOR i IN range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id AND len(q.v) = len(c.v)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@query
def op7_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = score_toxicity(docs, fit(docs, labels, ~held_out()))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op8_sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shard_documents(table(spark, folder, "documents"), 16)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    file = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, folder, "documents"), file)


@query
def op10_repeated_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


@query
def op11_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    texts, _ = align_texts(table(spark, folder, "documents"), *files)
    return texts


@query
def op12_web_archives(spark: SparkSession, folder: str) -> DataFrame:
    return archived_pages(table(spark, folder, "pages"))


ORACLES["op12_web_archives"] = """
WITH payloads AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest FROM pages
), heads AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes)
    ELSE page_id END AS head FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN head <> page_id THEN head END AS refers_to
FROM heads
"""


@query
def op13_phrases(spark: SparkSession, folder: str) -> DataFrame:
    return phrases(table(spark, folder, "documents"))


ORACLES["op13_phrases"] = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM documents
), sizes AS (
  SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang
), frequent AS (
  SELECT lang, w[k:k + m - 1] AS words, count(*) AS f
  FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS k FROM pieces, range(1, 5) AS t(m))
  GROUP BY ALL HAVING count(*) >= 30
), cuts AS (
  SELECT c.lang, c.words, c.f AS a, x.f AS l, y.f AS r, cut,
    CAST(CAST(2000000 AS HUGEINT) * c.f // (CAST(x.f AS HUGEINT) + y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, len(words))) AS cut FROM frequent WHERE len(words) > 1) c
  JOIN frequent x ON x.lang = c.lang AND x.words = c.words[:cut]
  JOIN frequent y ON y.lang = c.lang AND y.words = c.words[cut + 1:]
), scored AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, words ORDER BY score, cut) AS place FROM cuts)
  WHERE place = 1
), around AS (
  SELECT lang, inner_words AS words, max(a) AS around
  FROM (SELECT lang, a, words[k:k + m - 1] AS inner_words
    FROM (SELECT lang, a, words, m, unnest(range(1, len(words) - m + 2)) AS k
      FROM scored, range(2, 4) AS t(m) WHERE m < len(words)))
  GROUP BY ALL
), ranked AS (
  SELECT lang, array_to_string(words, ' ') AS phrase, a, l, r, score,
    row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(words, ' ')) AS rank
  FROM scored LEFT JOIN around USING (lang, words)
  WHERE NOT coalesce(100 * around >= 80 * a, false)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000
"""
