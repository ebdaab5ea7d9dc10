"""Registered queries of the operators, with the SQL that checks them where it can."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from curbair.llm import align, caps, jaccard, langid, lexical, mixture, pieces, pii, secrets, tokenfile, topk, urlrules, warc
from curbair.session import pin_session

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def _query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(pin_session(spark), folder)

        run.__name__, run.__doc__ = function.__name__, function.__doc__
        QUERIES[function.__name__] = run
        if sql is not None:
            ORACLE[function.__name__] = sql
        return run

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """A public tokenizer's file on this machine; executors have the same files."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_query()
def op1_language_id(spark, folder):
    """Language of every document, learned from those not held out."""
    docs = _table(spark, folder, "documents")
    found = langid.identify(docs.select("doc_id", "text"), docs.filter(~langid.held_out()))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@_query("""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN m.first IS NOT NULL AND m.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN m.first <> p.page_id THEN m.first END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM p LEFT JOIN m USING (payload_digest)
""")
def op2_warc(spark, folder):
    """Pages written to archives and read back."""
    return warc.archived(_table(spark, folder, "pages")).select(
        "page_id", F.col("length").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.col("type").alias("record_type"), "refers_to", "problem")


@_query("""
WITH v AS (
  SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) for x in embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
""")
def op3_exact_topk(spark, folder):
    """The ten highest integer inner products of every hundredth vector."""
    return topk.top_inner_products(_table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0)


URL_RULES = (
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"), ("com", "/de/", "block"),
)


@_query(rf"""
WITH rules(rhost, rpath, rverdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
u AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
f AS (
  SELECT u.*, rhost || rpath AS rule, rverdict,
    row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC NULLS LAST) AS place
  FROM u LEFT JOIN rules
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath))
SELECT page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict FROM f WHERE place = 1
""")
def op4_url_filters(spark, folder):
    """Every page's url under the rules, allowed unless a rule blocks it."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(_table(spark, folder, "pages"), rules)


@_query()
def op5_sentencepiece(spark, folder):
    """Ids of every document by the model's own segmentation, and whether they decode back."""
    return pieces.piece_digests(_table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


@_query()
def op6_token_files(spark, folder):
    """Documents in token files, read back with their offsets."""
    return tokenfile.token_files(_table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


#: Present shares are taken to this power, which lifts small sources, languages, topics.
TEMPER = 0.7
#: Words from which a document is of the topic; there is no topic column in the table.
TOPICS = (("treatise", 1000), ("article", 200))


def topic_of(text):
    """A stand-in for a topic, by the length of a text in words."""
    words = mixture.word_count(text)
    out = F.lit("note")
    for name, least in reversed(TOPICS):
        out = F.when(words >= least, name).otherwise(out)
    return out


def margins():
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text"))}


def _mixture_sql(rounds: int = 15) -> str:
    """The raking unrolled: one step per marginal and round."""
    names = ("source", "lang", "topic")
    parts = [r"""d AS MATERIALIZED (
  SELECT *, CASE WHEN tokens >= 1000 THEN 'treatise' WHEN tokens >= 200 THEN 'article' ELSE 'note' END AS topic
  FROM (SELECT doc_id, source, lang, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS tokens
        FROM documents)),
c0 AS MATERIALIZED (SELECT source, lang, topic, sum(tokens) AS tokens, CAST(1 AS DOUBLE) AS factor FROM d GROUP BY ALL)"""]
    for name in names:
        parts.append(f"""t_{name} AS MATERIALIZED (
  SELECT {name} AS v, pow(CAST(n AS DOUBLE), {TEMPER}) / sum(pow(CAST(n AS DOUBLE), {TEMPER})) OVER () AS target
  FROM (SELECT {name}, sum(tokens) AS n FROM c0 GROUP BY 1) WHERE n > 0)""")
    step = 0
    for _ in range(rounds):
        for name in names:
            parts.append(f"""c{step + 1} AS MATERIALIZED (
  SELECT source, lang, topic, tokens, factor * coalesce(target / nullif(
    sum(tokens * factor) OVER (PARTITION BY {name}) / sum(tokens * factor) OVER (), 0), 0) AS factor
  FROM c{step} LEFT JOIN t_{name} ON {name} IS NOT DISTINCT FROM v)""")
            step += 1
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, d.source, d.lang, d.topic, d.tokens,
  CAST(('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':0'), 1, 13)) AS BIGINT) / 4503599627370496.0
    < CASE WHEN d.tokens > 0 THEN factor / (SELECT max(factor) FROM c{step} WHERE tokens > 0) ELSE 1 END AS kept
FROM d JOIN c{step} c ON d.source IS NOT DISTINCT FROM c.source AND d.lang IS NOT DISTINCT FROM c.lang
  AND d.topic = c.topic
"""


@_query(_mixture_sql())
def op7_mixture(spark, folder):
    """Documents drawn towards tempered shares of source, language and topic."""
    docs = _table(spark, folder, "documents").withColumn("topic", topic_of(F.col("text")))
    mixed = mixture.mix(docs, {m: F.col(m) for m in ("source", "lang", "topic")}, TEMPER)
    return mixed.select("doc_id", "source", "lang", "topic", "tokens", "kept")


@_query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
o AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b USING (shingle) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (
  SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 80 * (p.n + q.n - k)),
r AS (SELECT x AS node, x AS seen FROM l UNION SELECT r.node, l.y FROM r JOIN l ON l.x = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least(c.component_id, d.doc_id), d.doc_id) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) LEFT JOIN c ON c.node = d.doc_id
""")
def op8_ngram_jaccard(spark, folder):
    """Components of documents whose five-word shingles are alike."""
    return jaccard.near_duplicates(_table(spark, folder, "documents")).select("doc_id", "n_shingles", "component_id")


@_query()
def op9_secret_scan(spark, folder):
    """Spans of secrets in every document."""
    return secrets.scan_secrets(_table(spark, folder, "documents"))


@_query("""
WITH RECURSIVE v AS (
  SELECT vec_id, label, [CAST(x AS DOUBLE) for x in embedding] AS x FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
l AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.x, b.x) >= 0.98),
r AS (SELECT x AS node, x AS seen FROM l UNION SELECT r.node, l.y FROM r JOIN l ON l.x = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY 1),
k AS (SELECT x, count(*) AS n FROM l GROUP BY 1)
SELECT e.vec_id, coalesce(k.n, 0) AS n_links, coalesce(c.component_id, e.vec_id) AS component_id,
       coalesce(c.component_id, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN k ON k.x = e.vec_id LEFT JOIN c ON c.node = e.vec_id
""")
def op10_cap_filters(spark, folder):
    """Near-duplicate vectors within a label."""
    return caps.near_vectors(_table(spark, folder, "embeddings"))


@_query()
def op11_personal_data(spark, folder):
    """Spans of personal data in every document."""
    return pii.personal_data_digests(_table(spark, folder, "documents"))


@_query(r"""
WITH d AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents),
i AS (
  SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
q AS (SELECT item_id, term, count(*) AS times FROM i GROUP BY ALL),
f AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY 1),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n),
m AS (SELECT doc_id, 100 - 25 + ((25 * n * docs) // total) AS m FROM n, g),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, g GROUP BY term, docs),
s AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM q JOIN f USING (term) JOIN w USING (term) JOIN m USING (doc_id) GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM r WHERE rank <= 20
""")
def op12_lexical_search(spark, folder):
    """The twenty highest-scoring documents of every benchmark item."""
    return lexical.search(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"), 20)


@_query()
def op13_token_alignment(spark, folder):
    """Two tokenizers aligned over all documents, each distinct text once."""
    return align.alignments(
        _table(spark, folder, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
