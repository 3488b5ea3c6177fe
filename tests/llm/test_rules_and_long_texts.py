"""URL rules against SQL, and texts, URLs and payloads far beyond the usual."""

import hashlib

import duckdb
import public_tokenizers as P
from pyspark.sql import functions as F

from wayfold.llm import queries, token_count, toxicity, url_filter, warc_zip
from wayfold.llm.common import new_path

RULES_SQL = """
WITH parts AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), split AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM parts
), placed AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM split
), rules(verdict, rule) AS (VALUES ('allow', 'org/'), ('block', 'example.org/es/'), ('block', 'example.org/en/1'), ('allow', 'com/fr/'), ('block', 'com/de/')
), fits AS (SELECT page_id, rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC) AS place FROM placed JOIN rules
  ON (host = split_part(rule, '/', 1) OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, substr(rule, strpos(rule, '/'))))
SELECT page_id, host, path, f.rule, f.verdict FROM placed LEFT JOIN (SELECT * FROM fits WHERE place = 1) f USING (page_id)
"""


def test_op8_hosts_paths_and_rules_by_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{sf}/pages.parquet'")
    want = {r[0]: r[1:] for r in con.sql(RULES_SQL).fetchall()}
    got = queries.op8_url_filter(spark, sf).collect()
    assert len(got) == len(want) and sum(w[2] is not None for w in want.values()) > 20
    for r in got:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert rule is None or r.verdict == verdict


def test_long_texts_urls_and_payloads(spark):
    from tokenizers import Tokenizer

    long = "A word of prose, 12 and more; " * 12_000
    docs = spark.createDataFrame([(1, long), (2, "z" * 90_000), (3, "short")], "doc_id long, text string")
    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = {r.doc_id: r.n_tokens for r in token_count.count_tokens(docs, P.path("byte_bpe_50k.json"), P.PATTERN).collect()}
    assert got == {r.doc_id: len(t.encode(r.text, add_special_tokens=False).ids) for r in docs.collect()}
    labels = spark.createDataFrame([(1, 0), (3, 1)], "doc_id long, toxic int")
    scores = toxicity.score(docs, toxicity.learn(docs, labels, F.lit(True))).collect()
    assert len(scores) == 3 and all(0 <= r.score <= 1 for r in scores)
    pages = spark.createDataFrame([(1, "http://a.org/" + "x/" * 40_000, long), (2, "http://b.net/?q=" + "y" * 60_000, long), (3, None, None)], "page_id long, url string, html string")
    judged = {r.page_id: r for r in url_filter.judge(pages.select("page_id", "url"), queries.URL_RULES).collect()}
    assert judged[1].rule == "org/" and len(judged[1].path) == 80_001 and judged[2].path == "/" and judged[3].host == ""
    folder = new_path(spark, "packages")
    told = {r.page_id: r for r in warc_zip.read_packages(warc_zip.write_packages(pages, folder), folder, "bigint").collect()}
    digest = hashlib.sha256(long.encode()).hexdigest()
    assert (told[1].record_type, told[1].payload_digest, told[1].payload_bytes) == ("response", digest, len(long))
    assert (told[2].record_type, told[2].refers_to, told[2].payload_digest) == ("revisit", 1, digest) and told[3].payload_bytes == 0
