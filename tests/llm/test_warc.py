import glob
import gzip
import hashlib
import random
import zlib

import pytest

from headingflow.llm import warc
from headingflow.llm.queries import op10_warc

SCHEMA = "page_id long, url string, html string, payload_bytes long, refers_to string, _file string"


def expected_rows(pages):
    """What the archives hold, by id; equal payloads of 1000 bytes or more refer to the largest id."""
    last = {}
    for key, _, html in pages:
        data = (html or "").encode()
        if key is not None:
            last[data] = max(last.get(data, key), key)
    rows = []
    for key, _, html in pages:
        data = (html or "").encode()
        other = len(data) >= 1000 and data in last and last[data] != key
        digest = hashlib.sha1(data).hexdigest()
        rows.append((key, len(data), digest, "revisit" if other else "response", last[data] if other else None))
    return sorted(rows, key=repr)


def found_rows(read):
    def number(text):
        return None if text is None else int(text)

    return sorted(
        ((number(r.record_id), r.payload_bytes, r.payload_digest, r.record_type, number(r.refers_to)) for r in read.collect()),
        key=repr,
    )


@pytest.fixture(scope="module")
def pages():
    chance = random.Random(2)
    noise = "".join(chr(chance.randint(33, 0x24F)) for _ in range(60_000))
    return [
        (1, "http://a/", None),
        (2, None, ""),
        (3, "http://b/\r\nX: y", "<p>short</p>"),
        (4, "http://c/", "<p>short</p>"),
        (5, "http://d/", "long " * 300),
        (6, "http://e/", "long " * 300),
        (7, "http://f/", "long " * 300),
        (7, "http://f/", "long " * 300),
        (8, "http://g/é", noise),
        (None, "http://h/", "x" * 2000),
        (None, None, None),
        *[(100 + i, f"http://i/{i}", noise[: 50 * i] + "\r\n\r\nWARC/1.1\r\n\x1f") for i in range(30)],
    ]


def table(spark, pages):
    return spark.createDataFrame([(*p, 1, "r", "f") for p in pages], SCHEMA).repartition(2)


@pytest.mark.parametrize("range_bytes", ["3000", "128m"])
def test_round_trip(spark, pages, tmp_path, range_bytes):
    path = str(tmp_path / "archives")
    warc.write_warc(table(spark, pages), path)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", range_bytes)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        read = warc.read_warc(spark, path, payloads=True)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert found_rows(read) == expected_rows(pages)
    assert all(len(r.payload) == (r.payload_bytes if r.record_type == "response" else 0) for r in read.collect())


def test_other_tools_read_the_files(spark, pages, tmp_path):
    path = str(tmp_path / "archives")
    warc.write_warc(table(spark, pages), path)
    data = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/part-*"))
    # Every payload of the fixture but the short ones holds a false head too.
    assert data.count(b"WARC-Record-ID: ") == len(pages)


def test_magic_bytes_inside_members_are_mended(spark, tmp_path):
    """Stored members hold their payload as it is, magic bytes included; ranges cut them everywhere."""
    chance = random.Random(5)
    members, rows = [], []
    for key in range(40):
        payload = b"".join(warc.GZIP + chance.randbytes(chance.randint(0, 90)) for _ in range(chance.randint(0, 9)))
        head = warc._header(
            [("WARC-Type", "response"), ("WARC-Record-ID", warc.record_id(key)), ("Content-Length", str(len(payload)))]
        )
        pack = zlib.compressobj(0, zlib.DEFLATED, 31)
        members.append(pack.compress(head + payload + b"\r\n\r\n") + pack.flush())
        rows.append((key, len(payload), hashlib.sha1(payload).hexdigest(), "response", None))
    folder = tmp_path / "made"
    folder.mkdir()
    (folder / "one.warc").write_bytes(b"".join(members))
    for size in ("97", "400", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        try:
            assert found_rows(warc.read_warc(spark, str(folder))) == sorted(rows, key=repr)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_damaged_record_is_an_error(spark, tmp_path):
    member = warc.record(1, "u", b"x" * 5000, "00" * 20, 5000, None, "d")
    (tmp_path / "bad.warc").write_bytes(member[: len(member) // 2])
    with pytest.raises(Exception, match="damaged"):
        warc.read_warc(spark, str(tmp_path / "bad.warc")).collect()


def test_long_members_end_in_a_zero_byte(monkeypatch):
    data = bytes(1 << 24)
    assert warc._member(data)[-1] == 1 and warc._member(b"")[-1] == 0
    assert warc.parse(b"") is None


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_warc(spark.createDataFrame([], SCHEMA), path)
    assert warc.read_warc(spark, path).collect() == []


def test_pages(spark, sf_dir):
    pages = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html").collect()]
    assert sorted(map(tuple, op10_warc(spark, sf_dir).collect()), key=repr) == expected_rows(pages)
