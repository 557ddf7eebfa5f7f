"""Query of the URL filters.

Outcomes are the labels of the same number (``labels.doc_id`` = ``page_id``): a page is bad if it
is marked as of low quality or toxic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricevault.llm.registry import query, table
from pricevault.llm.url_filter import judge_urls, url_host

RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}

URLS_SQL = r"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (SELECT host, count(doc_id) AS n, coalesce(sum(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END), 0)::BIGINT AS bad
      FROM p LEFT JOIN labels ON doc_id = page_id GROUP BY host),
h AS (SELECT *, CASE WHEN s2 IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'org.uk')
                     THEN array_to_string(string_split(host, '.')[-3:], '.') ELSE s2 END AS domain
      FROM (SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS s2 FROM o)),
d AS (SELECT domain, sum(n) AS n, sum(bad) AS bad,
             CASE WHEN array_to_string(string_split(domain, '.')[-2:], '.') IN ('ac.uk', 'co.jp', 'co.nz', 'co.uk', 'com.au', 'com.br', 'org.uk')
                  THEN array_to_string(string_split(domain, '.')[-2:], '.') ELSE string_split(domain, '.')[-1] END AS suffix
      FROM h GROUP BY domain),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
sp AS (SELECT s.*, (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) FROM s) AS m FROM s),
sk AS (SELECT greatest(1.0, least(1000.0, CASE WHEN spread - within > 0 THEN noise / (spread - within) - 1 ELSE 1000.0 END)) AS k FROM
       (SELECT sum(n * m * (1 - m)) AS noise, sum(CASE WHEN n > 0 THEN m * (1 - m) END) AS within,
               sum(n * pow(CASE WHEN n > 0 THEN bad / n ELSE m END - m, 2)) AS spread FROM sp)),
dp AS (SELECT d.*, (sp.bad + k * sp.m) / (sp.n + k) AS m FROM d JOIN sp USING (suffix), sk),
dk AS (SELECT greatest(1.0, least(1000.0, CASE WHEN spread - within > 0 THEN noise / (spread - within) - 1 ELSE 1000.0 END)) AS k FROM
       (SELECT sum(n * m * (1 - m)) AS noise, sum(CASE WHEN n > 0 THEN m * (1 - m) END) AS within,
               sum(n * pow(CASE WHEN n > 0 THEN bad / n ELSE m END - m, 2)) AS spread FROM dp)),
hp AS (SELECT h.*, (dp.bad + k * dp.m) / (dp.n + k) AS m FROM h JOIN dp USING (domain), dk),
hk AS (SELECT greatest(1.0, least(1000.0, CASE WHEN spread - within > 0 THEN noise / (spread - within) - 1 ELSE 1000.0 END)) AS k FROM
       (SELECT sum(n * m * (1 - m)) AS noise, sum(CASE WHEN n > 0 THEN m * (1 - m) END) AS within,
               sum(n * pow(CASE WHEN n > 0 THEN bad / n ELSE m END - m, 2)) AS spread FROM hp)),
r AS (SELECT host, q - 1.645 * sqrt(q * (1 - q) / (n + k + 1)) > 0.5 AS blocked
      FROM (SELECT host, n, k, (bad + k * m) / (n + k) AS q FROM hp, hk)),
v AS (SELECT p.*, blocked, CASE
        WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
        WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
        WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
        WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
      FROM p JOIN r USING (host))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
       WHEN blocked THEN 'block' ELSE 'allow' END AS verdict
FROM v
"""


@query("op5_host_reputation", URLS_SQL)
def op5_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    bad = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.coalesce(bad, F.lit(False)).alias("bad"))
    outcomes = pages.join(labels, "page_id", "left").select(F.coalesce(url_host(F.col("url")), F.lit("")).alias("host"), "bad")
    return judge_urls(pages, outcomes, RULES).drop("url")
