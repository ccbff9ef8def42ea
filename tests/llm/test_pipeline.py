import corpus_pipeline
from contrail.llm import quality, simhash

from helpers import SF_SMALL, clashing, docs, stored, EDGE
from test_decontaminate import ITEMS
from test_pii import brute as spans
from test_simhash import brute_print, brute_roots
from contrail.llm.common import table


def test_run_equals_brute_force(spark):
    model = quality.fit(table(spark, SF_SMALL, "documents"), table(spark, SF_SMALL, "labels"))
    rows = [r for r in stored("documents") if model.scores([r[1]])[0] >= 0.5]
    prints = {r[0]: brute_print(r[1]) for r in rows}
    root = brute_roots(prints.values())
    first = {}
    for i in sorted(prints):
        first.setdefault(root[prints[i]], i)
    rows = [r for r in rows if r[0] in first.values()]
    items = stored("benchmark")
    exact = {r[0] for r in rows if any(t in r[1] for _, t in items)}
    rows = [r for r in rows if r[0] not in exact]
    got = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert sorted(r["doc_id"] for r in got) == [r[0] for r in rows]
    text = {r["doc_id"]: r["text"] for r in got}
    for r in rows:
        want, at = "", 0
        for a, b, k in spans(r[1]):
            if a >= at:
                want += r[1][at:a] + f"[{k.upper()}]"
            at = max(at, b)
        assert text[r[0]] == want + r[1][at:]
    assert {c for c in got[0].asDict()} >= {"doc_id", "text", "lang", "source", "n_chars", "mix_slot", "mix_rank"}


def test_stages_keep_columns_and_take_edge_rows(spark, tmp_path):
    spark.createDataFrame([(1, 0, 0)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "a b c d e f")], ITEMS).write.parquet(str(tmp_path / "benchmark.parquet"))
    for k, rows in enumerate((EDGE, [])):
        frame = clashing(docs(spark, rows))
        columns = frame.columns
        for name, stage in corpus_pipeline.STAGES:
            path = str(tmp_path / f"{k}{name}")
            stage(spark, frame, str(tmp_path)).write.parquet(path)
            frame = spark.read.parquet(path)
            assert set(columns) <= set(frame.columns)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert frame.columns == columns


def test_near_duplicates_broadcast_no_cells(spark, monkeypatch):
    seen, whole = [], simhash.components

    def watched(links):
        seen.append(links._jdf.queryExecution().executedPlan().toString())
        return whole(links)
    monkeypatch.setattr(simhash, "components", watched)
    frame = docs(spark, [(i, f"{i} {i % 7} one two three four") for i in range(500)])
    assert corpus_pipeline.near_duplicate_stage(spark, frame, None).count() > 1
    assert "SortMergeJoin" in seen[0] and "Broadcast" not in seen[0]
