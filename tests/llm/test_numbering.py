import pytest

from contrail.llm import passages, simhash, suffixes
from contrail.session import cut_lineage

from helpers import docs
from test_passages import words
from test_suffixes import brute


@pytest.fixture
def shifting(spark, tmp_path, monkeypatch):
    """A stored table whose scans are split otherwise after each written table, as when executors come or go."""
    import random
    rng = random.Random(9)
    texts = [" ".join(words(rng, 120)) for _ in range(40)]
    rows = [(i, texts[i % 40] + (f" tail{i}" if i % 3 else "")) for i in range(80)]
    docs(spark, rows).repartitionByRange(8, "doc_id").write.parquet(str(tmp_path / "d"))
    key, layouts = "spark.sql.files.maxPartitionBytes", ["2k", "1k"] * 20
    opened = "spark.sql.files.openCostInBytes"
    was = spark.conf.get(key), spark.conf.get(opened)

    def shift(df):
        out = cut_lineage(df)
        spark.conf.set(key, layouts.pop())
        return out
    spark.conf.set(opened, "1")
    for module in (simhash, suffixes, passages):
        monkeypatch.setattr(module, "cut_lineage", shift)
    yield spark.read.parquet(str(tmp_path / "d")), rows
    spark.conf.set(key, was[0])
    spark.conf.set(opened, was[1])


def test_keep_one(shifting):
    frame, rows = shifting
    got = sorted(r["doc_id"] for r in simhash.keep_one(frame, distance=4).collect())
    assert got == sorted({min(j for j, u in rows if simhash.fingerprint(t) == simhash.fingerprint(u)
                              or (simhash.fingerprint(t) ^ simhash.fingerprint(u)).bit_count() <= 4) for _, t in rows})


def test_repeated_bytes(shifting):
    frame, rows = shifting
    assert sorted(map(tuple, suffixes.remove_repeats(frame).collect()), key=str) == brute(rows, suffixes.SPAN)


def test_passages(shifting):
    frame, rows = shifting
    got = passages.passages(frame).collect()
    assert sorted(tuple(sorted((r["doc_id"], r["other_id"]))) for r in got) == [(i, i + 40) for i in range(40)]
