"""WARC records in ZIP archives: round trips, ZIP64, damage, odd pages; and the pipeline."""

from __future__ import annotations

import base64
import hashlib
import io
import os
import zipfile

import pytest

from lakestream.llm import warc

PAGES = "page_id long, url string, html string, page string, digest string, first long, record string, copy int"


def page(i, html, url="http://a/b"):
    return (i, url, html, "x", "x", 9, "x", 1)


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(pages):
    first = {}
    for i, _, html, *_ in pages:
        key = html or ""
        if key not in first or (i is not None and (first[key] is None or i < first[key])):
            first[key] = i
    out, given = [], set()
    for i, _, html, *_ in pages:
        key = html or ""
        if first[key] == i and key not in given:
            given.add(key)
            out.append((i, len(key.encode()), digest(html), "response", None))
        else:
            out.append((i, len(key.encode()), digest(html), "revisit", first[key]))
    return out


def read_back(spark, pages, folder, **settings):
    table = spark.createDataFrame(pages, PAGES)
    archives = warc.write_archives(warc.records(table), folder, **settings)
    rows = warc.read_archives(archives, range_bytes=4000).collect()

    def number(text):
        return int(text) if text is not None else None

    return archives, [
        (number(r.page), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in rows
    ], rows


ODD = [
    page(5, "<p>one</p>"),
    page(3, "<p>one</p>"),
    page(9, "<p>one</p>"),
    page(9, "<p>one</p>"),
    page(1, None),
    page(2, ""),
    page(None, "only here"),
    page(None, "<p>one</p>"),
    page(7, "né 漢\r\n\r\nx" * 3, None),
    page(8, "long " * 100_000, "http://x/ \r\ny"),
]


def test_round_trip(spark, tmp_path):
    archives, found, rows = read_back(spark, ODD, str(tmp_path / "a"))
    assert sorted(map(str, found)) == sorted(map(str, expected(ODD)))
    payloads = {r.page: r.payload for r in rows if r.record_type == "response"}
    assert payloads["8"] == b"long " * 100_000 and payloads["7"] == ("né 漢\r\n\r\nx" * 3).encode()
    assert all(r.payload is None for r in rows if r.record_type == "revisit")
    assert not [name for name in os.listdir(tmp_path / "a") if not name.endswith(".zip")]


def test_a_third_of_all_pages_alike_and_many_archives(spark, tmp_path):
    pages = [page(i, "same" if i % 3 == 0 else f"page {i}") for i in range(300)]
    archives, found, _ = read_back(spark, pages, str(tmp_path / "a"), archive_bytes=2000)
    assert sorted(found, key=str) == sorted(expected(pages), key=str)
    assert archives.count() > 8 and archives.agg({"n": "sum"}).first()[0] == 300


def test_no_pages(spark, tmp_path):
    archives, found, _ = read_back(spark, [], str(tmp_path / "a"))
    assert archives.count() == 0 and found == []


def archive(folder, records, comment=b""):
    writer = warc.ArchiveWriter(str(folder), "one")
    for record in records:
        writer.add(record)
    writer.zip.comment = comment
    return writer.close()[0]


@pytest.mark.parametrize("limit", [zipfile.ZIP64_LIMIT, 10])
def test_directories_with_and_without_zip64(tmp_path, monkeypatch, limit):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", min(limit, 65535) if limit > 10 else 1)
    data = [warc.warc_record("response", i, "u", digest(f"p{i}"), 2, f"p{i}".encode()) for i in range(5)]
    path = archive(tmp_path, data, comment=b"PK\x05\x06 is not the end")
    raw = open(path, "rb").read()
    assert (warc.END_RECORD_64 in raw) == (limit == 10)
    reader = warc.ZipReader(path)
    start, size = reader.data_at(warc.DATA_MEMBER)
    assert reader.read(start, size) == b"".join(data)
    assert reader.read(*reader.data_at(warc.INDEX_MEMBER)).count(b"\n") == 5
    plain = open(archive(tmp_path, data), "rb").read()
    with zipfile.ZipFile(io.BytesIO(plain)) as known:  # the standard reader agrees
        assert {i.filename: i.file_size for i in known.infolist()} == {m.name: m.size for m in reader.members.values()}


def test_damage_is_told(tmp_path, spark):
    path = str(tmp_path / "not.zip")
    open(path, "wb").write(b"nothing of the kind")
    with pytest.raises(ValueError, match="not a ZIP"):
        warc.ZipReader(path)
    packed = str(tmp_path / "packed.zip")
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr(warc.DATA_MEMBER, "x" * 100)
    with pytest.raises(ValueError, match="stored"):
        warc.ZipReader(packed).data_at(warc.DATA_MEMBER)
    wrong = archive(tmp_path, [warc.warc_record("response", 1, "u", digest("other"), 2, b"p1")])
    with pytest.raises(Exception, match="damaged record"):
        warc.read_archives(spark.createDataFrame([(wrong,)], "path string")).collect()


# ---- registry and pipeline ----

DATA = "/root/testdata/sf0.001"
tables = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@tables
def test_query_of_pages_agrees_with_its_sql(spark):
    import duckdb
    from lakestream.llm import queries

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    theirs = connection.execute(queries.ORACLES["op6_warc"]).fetchall()
    df = queries.QUERIES["op6_warc"](spark, DATA)
    assert df.columns == ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    assert sorted(tuple(r) for r in df.collect()) == sorted(theirs)


@tables
def test_every_operator_is_registered_and_answers(spark):
    from lakestream.llm import queries

    assert sorted(queries.QUERIES, key=lambda q: int(q[2:].split("_")[0])) == [
        "op1_toxicity", "op2_packing", "op3_simhash", "op4_quality", "op5_sharding", "op6_warc", "op7_ann",
        "op8_langid", "op9_bpe", "op10_secrets", "op11_substrings", "op12_manifest", "op13_periodic",
    ]
    docs = spark.read.parquet(f"{DATA}/documents.parquet").count()
    for name in ("op1_toxicity", "op3_simhash", "op4_quality", "op5_sharding", "op8_langid", "op9_bpe"):
        assert queries.QUERIES[name](spark, DATA).select("doc_id").distinct().count() == docs


@tables
@pytest.mark.parametrize("name", ["op11_substrings", "op12_manifest", "op13_periodic"])
def test_queries_against_their_sql(spark, name):
    import duckdb

    from lakestream.llm import queries

    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{DATA}/documents.parquet'")
    df = queries.QUERIES[name](spark, DATA)
    result = connection.execute(queries.ORACLES[name])
    assert df.columns == [c[0] for c in result.description]
    assert sorted(map(str, map(tuple, df.collect()))) == sorted(map(str, result.fetchall()))


@tables
def test_stages_hand_on_documents(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language id", "toxicity", "near dedup", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, DATA)
        assert after.dtypes == docs.dtypes
        assert 0 < after.count() <= docs.count()
        docs = after
    last = corpus_pipeline.run(spark, DATA)
    assert {r.doc_id for r in last.select("doc_id").distinct().collect()} == {
        r.doc_id for r in docs.select("doc_id").collect()
    }
    assert last.agg({"length": "max"}).first()[0] <= 1024


@tables
def test_stages_take_odd_documents(spark, odd, empty):
    import corpus_pipeline

    wanted = spark.read.parquet(f"{DATA}/documents.parquet").columns
    for table in (odd.select(wanted), empty.select(wanted)):
        for name, stage in corpus_pipeline.STAGES:
            assert stage(spark, table, DATA).count() <= 10 * odd.count() + 400
