import duckdb
import pytest
from pyspark.sql import functions as F

from fraudlake.llm import warc, warc_files
from fraudlake.llm.common import table
from fraudlake.llm.warc import OP6_SQL, find_captures, new_folder, op6_warc, read_captures, url_key, write_archive, write_index
from fraudlake.llm.warc_files import IndexReader, IndexWriter, make_record, read_record


@pytest.mark.parametrize("page, url, payload, refers", [(1, "http://a/b c\r\n", b"x" * 5000, None), (None, None, b"", None), (2, "u", "é\r\n\r\nz".encode(), None), (3, "u", b"y" * 1000, 9)])
def test_record_round_trip(page, url, payload, refers):
    got = read_record(make_record(page, url, payload, refers))
    assert (got["page_id"], got["payload_bytes"], got["refers_to"]) == (page, len(payload), refers)
    assert got["payload"] == (None if refers else payload) and got["record_type"] == ("revisit" if refers else "response")


def test_a_damaged_payload_is_found():
    record = warc_files.gzip.decompress(make_record(1, "u", b"abc", None)).replace(b"abc", b"abd")
    with pytest.raises(ValueError):
        read_record(warc_files.member(record))


def test_index_over_many_blocks(tmp_path, monkeypatch):
    monkeypatch.setattr(warc_files, "LINES", 3)
    rows = sorted((f"k{i // 4:02d}", i % 5, f"f{i}", i, i) for i in range(50)) + [("z", 1, "a", 0, n) for n in range(8)]
    parts = []
    for name, part in (("p0", rows[:24]), ("p1", rows[24:])):
        writer = IndexWriter(str(tmp_path), name)
        for row in part:
            writer.add(*row)
        writer.close()
        parts.append((warc_files.index_key(*part[0][:2]), name))
    reader = IndexReader(str(tmp_path), parts)
    for key in {r[:2] for r in rows} | {("a", 1), ("k05", 99), ("zz", 0), ("k03", None)}:
        assert sorted(map(tuple, reader.find(*key))) == sorted(r for r in rows if r[:2] == key)


def test_keys(spark):
    urls = ["http://WWW.Example.com/a?b#c", "https://u@x.org:443", "http://h:8080?q=1#f", "mailto:x", None, ""]
    got = [r[0] for r in spark.createDataFrame([(u,) for u in urls], "url string").select(url_key("url")).collect()]
    assert got == ["com,example,www)/a?b", "org,x)/", "h:8080)?q=1", "mailto:x", "", ""]


def test_revisits_and_hard_rows(spark):
    big = "p" * 1000
    rows = [(1, "http://a.b/c", big), (2, "http://a.b/c", big), (7, "http://z/", big), (3, "u", big[:-1]), (4, "u", big[:-1]), (5, None, None), (5, None, None), (None, "u", big), (8, "v", "é" * 600), (8, "v", "é" * 600), (None, "n", "w" * 1200), (None, "n", "w" * 1200), (9, "l", "t" * 300_000)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("_digest", F.lit(1)).withColumn("file", F.lit("x"))
    pages = frame.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    folder = new_folder(spark)
    parts = write_index(write_archive(pages, folder), folder)
    keys = pages.select(url_key("url").alias("surt"), "page_id")
    got = read_captures(find_captures(keys, folder, parts), folder)
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    want = con.execute(OP6_SQL).fetchall()
    assert sorted(map(tuple, got.drop("url", "payload").collect()), key=str) == sorted(want, key=str)
    texts = {(r.page_id, bytes(r.payload)) for r in got.where("record_type = 'response'").collect()}
    assert (9, b"t" * 300_000) in texts
    strange = spark.createDataFrame([("no,such)/", 1)], "surt string, page_id long")
    assert find_captures(strange, folder, parts).count() == 0


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, payload binary")
    folder = new_folder(spark)
    parts = write_index(write_archive(pages, folder), folder)
    assert parts == [] and find_captures(pages.select(F.col("url").alias("surt"), "page_id"), folder, parts).count() == 0


def test_query_against_sql(spark, sf_dir):
    duckdb.sql(f"CREATE OR REPLACE VIEW pages AS SELECT * FROM '{sf_dir}/pages.parquet'")
    assert sorted(map(tuple, op6_warc(spark, sf_dir).collect())) == sorted(duckdb.sql(OP6_SQL).fetchall())
