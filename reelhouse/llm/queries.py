"""One query per operator over its whole table, and DuckDB SQL where it can say the same."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelhouse.llm.op1_lines import line_dedup
from reelhouse.llm.op2_neardup import near_duplicates
from reelhouse.llm.op3_bpe import bpe_documents
from reelhouse.llm.op4_quality import quality_scores
from reelhouse.llm.op5_exact import exact_dedup
from reelhouse.llm.op6_counts import token_counts
from reelhouse.llm.op7_lm import lm_scores
from reelhouse.llm.op8_warc import warc_pages
from reelhouse.llm.op9_html import extract_pages
from reelhouse.llm.op10_decontam import decontaminate
from reelhouse.llm.op11_toxic import toxicity_scores
from reelhouse.llm.op12_variants import spelling_variants
from reelhouse.llm.op13_divergence import source_divergence


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe_documents(docs).select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_pages(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest",
                                                            "record_type", "refers_to")


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "contaminated", "item_ids",
                                                                         "longest_match", "short_item_ids")


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity_scores(docs, table(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents").select("text", "lang", "source"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_line_dedup, op2_near_dedup, op3_bpe, op4_quality, op5_exact_dedup, op6_token_counts,
                            op7_lm_score, op8_warc, op9_html_text, op10_decontaminate, op11_toxicity, op12_spelling_variants,
                            op13_source_divergence)}

_LOW = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLE: dict[str, str] = {
    "op1_line_dedup": f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM split),
keyed AS (SELECT *, {_LOW.format(f"trim(line, {_SPACE})")} AS k FROM lines),
often AS (SELECT k, max(doc_id) AS top FROM keyed WHERE length(k) >= 20
          GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, line, i, top IS NOT NULL AND top <> doc_id AS gone FROM keyed LEFT JOIN often USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op5_exact_dedup": f"""
WITH d AS (SELECT doc_id, sha256({_LOW.format("coalesce(text, '')")}) AS text_sha256 FROM documents),
g AS (SELECT text_sha256, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)""",
    "op8_warc": """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
           FROM pages),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS top FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
FROM t""",
    "op13_source_divergence": f"""
WITH d AS (SELECT row_number() OVER () AS id, {_LOW.format("coalesce(text, '')")} AS t, coalesce(lang, '') AS lang,
                  coalesce(source, '') AS source FROM documents),
found AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
uses AS (SELECT lang, source, term, count(*) AS n FROM found JOIN kept USING (lang, term) GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT lang, source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM d)
      LEFT JOIN uses USING (lang, source) GROUP BY lang, source),
full_p AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n,
                  1 + (1000000000::HUGEINT * (coalesce(n, 0) + 1)) // (total + v)::HUGEINT AS p
           FROM g JOIN kept k ON g.lang = k.lang JOIN v ON v.lang = g.lang
           LEFT JOIN uses u ON u.lang = g.lang AND u.source = g.source AND u.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
         FROM full_p a JOIN full_p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
lang_uses AS (SELECT lang, term, sum(n) AS n FROM uses GROUP BY lang, term),
lang_total AS (SELECT lang, sum(n) AS total FROM lang_uses GROUP BY lang),
lang_q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 1)::HUGEINT) // (total + v)::HUGEINT AS q
           FROM lang_uses JOIN lang_total USING (lang) JOIN v USING (lang)),
terms AS (SELECT lang, source, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
          FROM full_p JOIN lang_q USING (lang, term) WHERE n > 0 AND p > q)
SELECT lang, source, 'pair' AS part, item, value,
       (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT AS rank FROM pairs
UNION ALL
SELECT lang, source, 'term', item, value, (row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item))::INT
FROM terms QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) <= 200""",
}
