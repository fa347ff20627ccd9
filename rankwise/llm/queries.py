"""The registered queries of this subpackage: production parameters, whole tables.

Each callable takes ``(spark, sf_dir)``.  ``oracle_sql`` holds DuckDB SQL for
those that SQL can express on whole tables; the others are tested against
brute force, round trips or held-out accuracy in ``tests/llm``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankwise.llm import (bpe, exact_dedup, gated_lm, html_wrappers, line_dedup, mixing, periodic_runs, quality_gam,
                          quality_rules, shingle_join, suffix_dedup, url_filter, whitening)
from rankwise.llm.tables import scan

VOCABULARY = "byte_bpe_50k.tiktoken"


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN
    encoded = bpe.encode(scan(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode(encoded, path, pattern).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(scan(spark, sf_dir, "documents"), weights=[1, 2, 3], max_repeat=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op3_suffix_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(scan(spark, sf_dir, "documents"))


def op4_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = scan(spark, sf_dir, "documents")
    return quality_gam.score(docs, quality_gam.train(docs, scan(spark, sf_dir, "labels")))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.suffix_dedup(scan(spark, sf_dir, "documents"), length=200, keep="none")
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.line_dedup(scan(spark, sf_dir, "documents"), edits=1, min_chars=20)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


#: host, path, verdict of the rule list
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(scan(spark, sf_dir, "pages"), rules).select("page_id", "host", "path", "rule", "verdict")


def op8_html_wrappers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrappers.extract(scan(spark, sf_dir, "pages"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(scan(spark, sf_dir, "documents"))


def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.shingle_join(scan(spark, sf_dir, "documents"), size=5, percent=80)


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(scan(spark, sf_dir, "embeddings"), k=16, scale=64, shift=1_000_000)


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(scan(spark, sf_dir, "documents"), min_words=6, min_periods=4,
                                       rewrite=periodic_runs.looped)


def op13_gated_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gated_lm.lm_scores(scan(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_byte_bpe, op2_source_mix, op3_suffix_quality, op4_quality_gam,
                                   op5_suffix_dedup, op6_line_dedup, op7_url_filter, op8_html_wrappers, op9_exact_dedup,
                                   op10_shingle_join, op11_whitening, op12_periodic_runs, op13_gated_lm)}


# -- DuckDB statements -------------------------------------------------------

_SIZES = r"""
docs AS (SELECT doc_id, source,
                len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
sources AS (SELECT source, sum(size)::BIGINT AS source_size,
                   row_number() OVER (ORDER BY source NULLS LAST) - 1 AS ordinal FROM docs GROUP BY source),
weighted AS (SELECT source, source_size, (ordinal % 3) + 1 AS weight FROM sources),
-- sources in the order in which they reach three times their size
ordered AS (SELECT *, row_number() OVER (ORDER BY source_size::DOUBLE / weight, source NULLS LAST) AS place FROM weighted),
sums AS (SELECT *, coalesce(sum(3 * source_size) OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                     AS capped_size,
                sum(weight) OVER (ORDER BY place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
                sum(source_size) OVER () AS total FROM ordered),
-- the first source that stays below its ceiling sets the level of all that do
level AS (SELECT (total - capped_size)::DOUBLE AS left_size, open_weight::DOUBLE AS open_weight FROM sums
          WHERE weight * (total - capped_size) <= 3 * source_size * open_weight ORDER BY place LIMIT 1),
shares AS (SELECT source, source_size,
                  least(weight::DOUBLE * left_size / open_weight, (3 * source_size)::DOUBLE) AS target
           FROM weighted, level)"""

ORACLE_SQL = {
    "op2_source_mix": f"""
WITH {_SIZES},
rates AS (SELECT doc_id, size, source_size, target,
                 CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
                 ('0x' || md5(coalesce(doc_id::VARCHAR, '') || ':20')[1:13])::BIGINT / 4503599627370496.0::DOUBLE AS draw
          FROM docs JOIN shares ON docs.source IS NOT DISTINCT FROM shares.source)
SELECT doc_id, size, source_size, target,
       (size * (floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT))::BIGINT AS taken FROM rates""",
    # a pair of lines one edit apart has equal halves before or after the edit;
    # then one place p splits both into equal beginnings and equal ends
    "op6_line_dedup": r"""
WITH line AS (SELECT doc_id, i, string_split(coalesce(text, ''), chr(10))[i] AS v, len(string_split(coalesce(text, ''), chr(10))) AS n
              FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i)),
firsts AS (SELECT v, min(row(doc_id, i)) AS spot, length(v) AS l FROM line
           WHERE length(v) >= 20 AND regexp_matches(v, '[^\x20\x09-\x0D]') GROUP BY v),
half AS (SELECT firsts.*, d FROM firsts, (VALUES (0), (1)) AS t(d)),
probe AS (SELECT v, spot, l - d AS l, left(v, (l - d) // 2) AS head, right(v, (l - d) - (l - d) // 2) AS tail FROM half),
pairs AS (SELECT a.v AS a, b.v AS b, a.spot AS spot_a, b.spot AS spot_b FROM firsts a JOIN probe b
              ON a.l = b.l AND left(a.v, a.l // 2) = b.head AND a.v <> b.v
          UNION SELECT a.v, b.v, a.spot, b.spot FROM firsts a JOIN probe b
              ON a.l = b.l AND right(a.v, a.l - a.l // 2) = b.tail AND a.v <> b.v),
near AS (SELECT CASE WHEN spot_a < spot_b THEN b ELSE a END AS v FROM pairs
         WHERE len(list_filter(range(0, length(a)::BIGINT + 1), lambda p: left(a, p) = left(b, p)
               AND substr(a, p + 1 + (length(a) = length(b))::BIGINT) = substr(b, p + 2))) > 0),
gone AS (SELECT line.doc_id, line.i FROM line JOIN firsts USING (v)
         WHERE row(line.doc_id, line.i) <> firsts.spot OR v IN (SELECT v FROM near)),
kept AS (SELECT line.doc_id, line.i, v, n, gone.i IS NULL AS stays FROM line LEFT JOIN gone
         ON line.doc_id = gone.doc_id AND line.i = gone.i)
SELECT doc_id, any_value(n)::BIGINT AS n_lines, count(*) FILTER (NOT stays)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(v, chr(10) ORDER BY i) FILTER (stays), '')) AS kept_sha256 FROM kept GROUP BY doc_id""",
    # pages without a rule: no page of the tables links to another host, so no
    # distrust reaches a host that is not itself a blocked seed
    "op7_url_filter": r"""
WITH place AS (SELECT page_id,
                      translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                      regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM pages),
rules(rule_host, rule_path, rule_verdict) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'),
    ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
places AS (SELECT DISTINCT host, path FROM place),
best AS (SELECT host, path, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                arg_max(rule_verdict, length(rule_host || rule_path)) AS rule_verdict
         FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
         GROUP BY host, path),
judged AS (SELECT page_id, host, path, rule, rule_verdict FROM place LEFT JOIN best USING (host, path)),
seeds AS (SELECT host, avg((coalesce(rule_verdict, '') = 'block')::INT) - avg((coalesce(rule_verdict, '') = 'allow')::INT)
                 AS banned FROM judged GROUP BY host)
SELECT page_id, host, path, rule, coalesce(rule_verdict, CASE WHEN banned > 0.5 THEN 'block' ELSE 'allow' END) AS verdict
FROM judged JOIN seeds USING (host)""",
    "op9_exact_dedup": r"""
WITH norm AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
grouped AS (SELECT t, min(doc_id) AS keep_id, count(*)::BIGINT AS group_size FROM norm GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM norm JOIN grouped USING (t)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
