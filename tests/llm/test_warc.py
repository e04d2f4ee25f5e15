import base64
import hashlib

import duckdb
from pyspark.sql import functions as F

from tessera.llm import warc
from tests.util import canon

SCHEMA = "page_id long, url string, html string"
DIGEST = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def brute_force(rows, least=0):
    out, first = [], {}
    for i, _, html in rows:
        body = (html or "").encode()
        if i is not None and len(body) >= least:
            first[body] = min(i, first.get(body, i))
    for i, _, html in rows:
        body = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        refers = first.get(body)
        refers = None if refers is None or refers == i else refers
        out.append((i, len(body), digest, "response" if refers is None else "revisit", refers))
    return sorted(out, key=str)


def records(df):
    return sorted((tuple(r) for r in df.select(*DIGEST).collect()), key=str)


def test_whole_table_equals_the_oracle(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{sf_dir}/pages.parquet')")
    df = warc.archive_and_read(spark.read.parquet(f"{sf_dir}/pages.parquet")).select(*DIGEST)
    res = con.execute(warc.oracle_sql())
    cols = [c[0] for c in res.description]
    assert canon(df.columns, [tuple(r) for r in df.collect()]) == canon(cols, res.fetchall())


def test_copies_nulls_ties_and_odd_urls(spark):
    rows = [(i, f"http://h{i % 7}.example.org/p/{i}", f"<p>{i % 5}</p>" * (1 + i % 3)) for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "not a url\r\nX: y", "ä日"), (103, "HTTP://User@Host.EXAMPLE.com:81/A?b#c", "ä日")]
    rows += [(104, "http://x.org/", "same"), (104, "http://x.org/", "same"), (None, "http://x.org/", "same"), (None, None, "lone"), (105, "http://x.org/", "same")]
    pages = spark.createDataFrame(rows, SCHEMA).withColumns({"key": F.lit("k"), "digest": F.lit(1), "offset": F.lit("o")})
    assert records(warc.archive_and_read(pages)) == brute_force(rows)
    for least in (8, 10**6):
        archive = warc.write_archive(pages, min_revisit_bytes=least, block_entries=3)
        assert records(warc.lookup(archive, pages.select("url", "page_id"))) == brute_force(rows, least)


def test_lookup_by_url_reads_every_capture_and_its_payload(spark):
    rows = [(i, f"http://www.example.org/{i % 4}", f"v{i // 2}") for i in range(40)]
    archive = warc.write_archive(spark.createDataFrame(rows, SCHEMA), block_entries=4)
    wanted = spark.createDataFrame([("http://WWW.example.org/2",), ("http://www.example.org/none",)], "url string")
    got = warc.lookup(archive, wanted, payloads=True).collect()
    assert sorted(r.page_id for r in got) == [i for i in range(40) if i % 4 == 2]
    assert all(bytes(r.payload).decode() == f"v{r.page_id // 2}" for r in got if r.record_type == "response")
    assert archive.files.count() >= 1


def test_sort_key_and_empty_table(spark):
    urls = [("https://u:p@www.Example.org:8080/a?b=c#d", "org,example,www)/a?b=c#d"), ("http://example.org", "org,example)"), (None, "")]
    for url, want in urls:
        assert spark.createDataFrame([(url,)], "url string").select(warc.host_key(F.col("url"))).first()[0] == want
    empty = spark.createDataFrame([], SCHEMA)
    assert warc.archive_and_read(empty).count() == 0
