"""Byte fingerprints of files against hashlib."""

import gzip
import hashlib
import random

import pytest

from contrail.sources import file_fingerprints

CHUNK, FAN = 64, 3


def digest(data: bytes) -> str:
    level = [hashlib.sha256(data[i:i + CHUNK]).hexdigest() for i in range(0, len(data), CHUNK)]
    while len(level) > 1:
        level = [hashlib.sha256("".join(level[i:i + FAN]).encode()).hexdigest() for i in range(0, len(level), FAN)]
    return level[0] if level else hashlib.sha256(b"").hexdigest()


@pytest.fixture
def small_splits(spark):
    """Splits of 100 bytes, so that lines and chunks lie across them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_digests_equal_hashlib(spark, tmp_path, small_splits):
    rng = random.Random(1)
    noise = bytes(rng.randrange(256) for _ in range(2000))
    cases = {
        "empty": b"", "feed": b"\n", "feeds": b"\n" * 700, "short": b"abc", "no end": b"a\nb\nc" * 50,
        "noise": noise, "ended noise": noise + b"\n", "returns": b"a\r\nb\rc\r\n" * 60, "one long line": b"x" * 900,
        "mark": b"\xef\xbb\xbf", "mark and feed": b"\xef\xbb\xbf\n", "mark and text": b"\xef\xbb\xbfa\nb" * 40,
        "marked end": b"\xef\xbb\xbfa\n", "two marks": b"\xef\xbb\xbf" * 2, "exactly one chunk": b"y" * 63 + b"\n",
        "ünï %20+ö": b"name\n", "three": b"abc"[:3],
    }
    for name, data in cases.items():
        (tmp_path / "in" / "deep").mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / "deep" / name).write_bytes(data)
    rows = file_fingerprints(spark, str(tmp_path / "in"), CHUNK, FAN).collect()
    del cases["empty"]  # has no row
    assert len(rows) == len(cases)
    from urllib.parse import unquote

    got = {unquote(r.file).rsplit("/", 1)[1]: (r.n_bytes, r.n_chunks, r.digest) for r in rows}
    assert got == {n: (len(b), -(-len(b) // CHUNK), digest(b)) for n, b in cases.items()}


def test_same_bytes_in_other_chunks_of_work(spark, tmp_path, small_splits):
    data = b"".join(b"%d,%d\n" % (i, i * i) for i in range(300))
    (tmp_path / "a").write_bytes(data)
    (tmp_path / "b").write_bytes(data)
    small = file_fingerprints(spark, str(tmp_path), CHUNK, FAN).collect()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100000")
    large = file_fingerprints(spark, str(tmp_path), CHUNK, FAN).collect()
    assert {r.digest for r in small + large} == {digest(data)}


def test_one_changed_byte_shows(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"line\n" * 100)
    (tmp_path / "b").write_bytes(b"line\n" * 99 + b"lime\n")
    a, b = file_fingerprints(spark, str(tmp_path), CHUNK, FAN).orderBy("file").collect()
    assert a.n_bytes == b.n_bytes and a.digest != b.digest


def test_unpacked_files_are_an_error(spark, tmp_path):
    (tmp_path / "a.gz").write_bytes(gzip.compress(b"line\n" * 100))
    with pytest.raises(Exception, match="not read as bytes"):
        file_fingerprints(spark, str(tmp_path), CHUNK, FAN).collect()


def test_parameters(spark, tmp_path):
    with pytest.raises(ValueError):
        file_fingerprints(spark, str(tmp_path), 0)
    with pytest.raises(ValueError):
        file_fingerprints(spark, str(tmp_path), fan=1)
