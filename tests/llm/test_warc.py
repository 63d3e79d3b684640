from hashlib import sha256

import pytest

from stridewise.llm.warc import page_records, page_summary, parse_head, read_warc, record_bytes, write_pages

BIG = "<p>" + "x" * 200 + "é</p>"


@pytest.fixture
def pages(spark):
    rows = [
        (5, "http://a.example/5", BIG), (3, "http://a.example/3", BIG), (9, "http://b.example/9", BIG), (1, None, "short"), (2, "http://c.example/2", "short"),
        (4, "http://c.example/4", None), (6, "x\r\nWARC/1.1\r\n\r\n", "WARC/1.1\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 9), (None, "n", BIG), (None, None, None),
        (7, "http://d.example/ü", "y" * 3_000_000), (8, "http://d.example/8", "z" * 99), (10, "http://d.example/10", "z" * 99), (3, "http://a.example/3", BIG),
    ]
    return spark.createDataFrame([(*r, "clash") for r in rows], "page_id long, url string, html string, record_type string")


def expected(rows):
    first = {}
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        if len(body) >= 100 and page is not None:
            first[body] = min(first.get(body, page), page)
    out = []
    for page, _, html, *_ in rows:
        body = (html or "").encode()
        of = first.get(body)
        again = of is not None and of != page
        out.append((page, len(body), sha256(body).hexdigest(), "revisit" if again else "response", of if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_round_trip(spark, pages, tmp_path, compression):
    write_pages(pages, str(tmp_path / "w"), compression)
    rows = page_summary(spark, str(tmp_path / "w")).collect()
    assert all(r["digest_ok"] for r in rows)
    assert sorted((tuple(r)[:5] for r in rows), key=str) == expected([tuple(r) for r in pages.collect()])


def test_given_pages(spark, tmp_path):
    given = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    write_pages(given, str(tmp_path / "w"))
    back = read_warc(spark, str(tmp_path / "w"), ["target_uri", "payload"])
    assert back.count() == given.count()
    assert {(r[0], bytes(r[1]).decode()) for r in back.collect()} == {(r["url"], r["html"]) for r in given.collect()}


@pytest.mark.parametrize("compression", ["none", "gzip"])
def test_pushed_predicates_give_the_rows_of_a_full_read(spark, pages, tmp_path, compression):
    path = str(tmp_path / "w")
    write_pages(pages, path, compression)
    everything = read_warc(spark, path).collect()
    light = read_warc(spark, path, ["record_type", "target_uri", "payload_length"])
    for where, keep in (
        ("record_type = 'revisit'", lambda r: r["record_type"] == "revisit"),
        ("record_type in ('response')", lambda r: r["record_type"] == "response"),
        ("target_uri like 'http://a.%'", lambda r: (r["target_uri"] or "").startswith("http://a.")),
        ("payload_length > 150 and target_uri is not null", lambda r: r["payload_length"] > 150 and r["target_uri"]),
        ("target_uri is null", lambda r: r["target_uri"] is None),
    ):
        found = light.where(where)
        assert found.count() == sum(bool(keep(r)) for r in everything), where
        assert " Filter " not in found._jdf.queryExecution().executedPlan().toString() or "null" in where or "payload_length" in where


def test_small_files_and_empty_tables(spark, pages, tmp_path):
    path = str(tmp_path / "w")
    write_pages(pages.coalesce(1), path)
    assert read_warc(spark, path, ["record_id"], partitionBytes="1").count() == 13
    write_pages(pages.where("page_id = -1"), str(tmp_path / "none"))
    assert page_summary(spark, str(tmp_path / "none")).count() == 0


def test_records():
    record = record_bytes({"record_id": "<urn:page:1>", "record_type": "response", "target_uri": "a\r\nb", "payload": b"hi"})
    head = parse_head(record.partition(b"\r\n\r\n")[0])
    assert head["warc-target-uri"] == "a%0D%0Ab" and record.endswith(b"hi\r\n\r\n")
    with pytest.raises(ValueError):
        parse_head(b"HTTP/1.1 200 OK")


def test_appends_hide_no_archive(spark, tmp_path):
    page = lambda i: spark.createDataFrame([(i, f"http://a.example/{i}", f"page {i}")], "page_id long, url string, html string")
    ids = lambda: sorted(r["record_id"] for r in read_warc(spark, path, ["record_id"]).collect())
    path = str(tmp_path / "warc")
    for n in (1, 2, 3):
        write_pages(page(n), path)
        assert ids() == [f"<urn:page:{i}>" for i in range(1, n + 1)]
    for manifest in (tmp_path / "warc").glob("_manifest*"):
        manifest.unlink()
    write_pages(page(4), path)  # onto archives without a manifest
    assert ids() == [f"<urn:page:{i}>" for i in (1, 2, 3, 4)]
    page_records(page(5)).write.format("warc").mode("overwrite").save(path)
    assert ids() == ["<urn:page:5>"]
