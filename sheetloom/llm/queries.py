"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from sheetloom.llm.chat import rotate
from sheetloom.llm.decontaminate import find_contamination
from sheetloom.llm.divergence import audit_sources
from sheetloom.llm.html_text import extract_text
from sheetloom.llm.language import fit_languages, identify
from sheetloom.llm.language_model import score_texts
from sheetloom.llm.lexical import search
from sheetloom.llm.line_dedup import dedup_lines
from sheetloom.llm.minhash import near_duplicates
from sheetloom.llm.packing import pack
from sheetloom.llm.private_data import KINDS, personal_data, span_text
from sheetloom.llm.vectors import near_duplicate_vectors
from sheetloom.llm.warc import captures, write_archives
from sheetloom.session import scratch_path


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a model of six sevenths of them."""
    training = F.crc32(F.col("doc_id").cast("string")) % 7 != 2
    return score_texts(_table(spark, sf_dir, "documents"), training)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in optimal length buckets and token-budget batches."""
    return pack(_table(spark, sf_dir, "documents"))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article text of every page."""
    pages = extract_text(_table(spark, sf_dir, "pages"))
    return pages.select("page_id", "url", "text", "n_chars")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, as it is or with other numbers, names and units."""
    return find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives, read back and assembled."""
    path = scratch_path(spark, "warc")
    write_archives(_table(spark, sf_dir, "pages"), path, min_bytes=0)
    return captures(spark, path).select(
        "page_id", "response.payload_bytes", "response.payload_digest", F.col("response.type").alias("record_type"), "refers_to"
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages learned from four fifths of the documents, predicted for all."""
    docs = _table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(True))
    model = fit_languages(docs.where(~held_out))
    found = identify(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of 20 characters or more in 3 or more documents stay in the last of them only."""
    kept = dedup_lines(_table(spark, sf_dir, "documents"), min_chars=20, min_docs=3)
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at a cosine of 0.95."""
    return near_duplicate_vectors(_table(spark, sf_dir, "embeddings"), threshold=0.95)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from the perspective of each participant."""
    rotated = rotate(_table(spark, sf_dir, "conversations"))
    spans = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return rotated.select("conv_id", "speaker", "part", "n_turns", "text", spans.alias("spans"), "n_trained")


def op10_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near duplicates by 3-word shingles at a similarity of 0.85."""
    return near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85, bands=8, rows=3)


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: the base spans, and those the trees add."""
    found = personal_data(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)),
        F.sha2(span_text(base).cast("binary"), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sources of each language compared by their words."""
    return audit_sources(_table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    f.__name__: f
    for f in (
        op1_lm_scoring, op2_packing, op3_html_extraction, op4_decontamination, op5_warc, op6_language_id,
        op7_line_dedup, op8_embedding_dedup, op9_chat_formatting, op10_minhash_dedup, op11_pii,
        op12_source_divergence, op13_lexical_search,
    )
}

ORACLES = {
    "op5_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, sha1(html) AS hex,
             min(page_id) OVER (PARTITION BY html) AS first FROM p),
g AS (SELECT *, list_transform(range(8), lambda g: CAST(concat('0x', substr(hex, CAST(1 + 5 * g AS INT), 5)) AS INT)) AS groups FROM d)
SELECT page_id, payload_bytes,
       list_aggregate(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((groups[k // 4 + 1] >> CAST(15 - 5 * (k % 4) AS INT)) & 31) + 1, 1)), 'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first THEN NULL ELSE first END AS refers_to
FROM g
""",
    "op7_line_dedup": """
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS line_key FROM l),
r AS (SELECT line_key, max(doc_id) AS last_doc FROM k WHERE length(line_key) >= 20
      GROUP BY line_key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, coalesce(r.last_doc <> k.doc_id, false) AS gone FROM k LEFT JOIN r USING (line_key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op9_chat_formatting": """
WITH t AS (SELECT conv_id, turn, coalesce(nullif(role, ''), 'unknown') AS role,
                  replace(coalesce(text, ''), '<|', '< |') AS content, coalesce(turn // 256, -1) AS part FROM conversations),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
r AS (SELECT t.*, speaker, role = speaker AS own,
             CASE WHEN role = 'system' THEN concat('<|system|>', chr(10)) WHEN role = speaker THEN concat('<|assistant|>', chr(10))
                  ELSE concat('<|user name=', replace(role, '<|', '< |'), '|>', chr(10)) END AS head
      FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
w AS (SELECT *, CAST(sum(length(head) + length(content) + 8) OVER (PARTITION BY conv_id, speaker, part
             ORDER BY turn NULLS FIRST, role, content ROWS UNBOUNDED PRECEDING) AS BIGINT) AS stop FROM r)
SELECT conv_id, speaker, part, count(*) AS n_turns,
       string_agg(concat(head, content, '<|end|>', chr(10)), '' ORDER BY stop) AS text,
       coalesce(string_agg(concat(stop - 8 - length(content), '-', stop), ',' ORDER BY stop) FILTER (own), '') AS spans,
       CAST(coalesce(sum(length(content) + 8) FILTER (own), 0) AS BIGINT) AS n_trained
FROM w GROUP BY conv_id, speaker, part
""",
    "op12_source_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                  translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN k USING (lang, term) GROUP BY lang, source, term),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
s AS (SELECT DISTINCT lang, source FROM d),
sn AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM s LEFT JOIN c USING (lang, source) GROUP BY lang, source),
ln AS (SELECT lang, sum(n) AS total FROM c GROUP BY lang),
lc AS (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term),
p AS (SELECT lang, source, term, coalesce(n, 0) AS n,
             1 + (CAST(1000000000 AS HUGEINT) * (coalesce(n, 0) + 5)) // (total + 5 * v) AS p
      FROM sn JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
q AS (SELECT lang, term, 1 + (CAST(1000000000 AS HUGEINT) * (n + 5)) // (total + 5 * v) AS q
      FROM lc JOIN ln USING (lang) JOIN v USING (lang)),
pv AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
       FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pr AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
       FROM s AS a JOIN s AS b ON a.lang = b.lang AND a.source <> b.source
       LEFT JOIN pv ON pv.lang = a.lang AND pv.source = a.source AND pv.item = b.source),
t AS (SELECT lang, source, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
u AS (SELECT 'pair' AS part, * FROM pr UNION ALL SELECT 'term', * FROM t),
z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM u)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM z WHERE part = 'pair' OR rank <= 50
""",
    "op13_lexical_search": r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (SELECT r, doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
n AS (SELECT r, doc_id, count(*) AS n FROM w GROUP BY r, doc_id),
a AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
i AS (SELECT DISTINCT item_id, term FROM (SELECT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)),
tf AS (SELECT r, term, count(*) AS tf FROM w WHERE term IN (SELECT term FROM i) GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
wt AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS weight FROM df, a),
s AS (SELECT item_id, doc_id, r,
             sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms)))) AS score
      FROM i JOIN tf USING (term) JOIN wt USING (term) JOIN n USING (r), a GROUP BY item_id, doc_id, r),
k AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM k WHERE rank <= 10
""",
}
