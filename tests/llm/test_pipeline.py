"""The pipeline: each stage against a plain version of its operator on its own input."""

import corpus_pipeline
from palaver.llm import op3_packing, op4_quality
from palaver.workspace import matching, working_folder, write_once
from tests.llm.cases import shingles
from tests.llm.test_decontamination import greedy, words
from tests.llm.test_lines import brute

SF = "/root/testdata/sf0.001"


def test_every_stage_keeps_what_its_plain_version_keeps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    held = [docs]
    for _, stage in corpus_pipeline.STAGES:
        held.append(write_once(stage(spark, held[-1], SF), "stage"))
    rows = [{r.doc_id: r for r in df.collect()} for df in held[:-1]]
    assert all(df.columns == columns for df in held[:-1])

    model = op4_quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = dict(zip(rows[0], model.scores([r.text or "" for r in rows[0].values()])))
    assert rows[1].keys() == {i for i, s in scores.items() if s >= 0.3}

    lines = brute([(i, r.text) for i, r in rows[1].items()])
    expected = {i: text for i, (n, kept, text) in lines.items() if n == kept or text.strip()}
    assert {i: r.text for i, r in rows[2].items()} == expected
    assert all(r.n_chars == len(r.text) for r in rows[2].values())

    sets = {i: shingles(r.text) for i, r in rows[2].items()}
    least = {i: i for i in sets}
    for _ in sets:
        for a in sets:
            for b in sets:
                if a != b and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                    least[a] = least[b] = min(least[a], least[b])
        break
    assert rows[3].keys() == {i for i, j in least.items() if i == j}

    items = [words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    seeds = [{tuple(x[k : k + 5]) for k in range(len(x) - 4)} for x in items]

    def leaks(text):
        w = words(text)
        mine = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        return any(mine & s and sum(greedy(w, x)) >= 0.6 * len(x) for x, s in zip(items, seeds))

    assert rows[4].keys() == {i for i, r in rows[3].items() if not leaks(r.text)}

    packed = held[-1].collect()
    pieces = op3_packing.pieces(held[4]).selectExpr("doc_id", "piece", "start", "length", "crc32(ids)").collect()
    assert sorted(tuple(r)[:5] for r in packed) == sorted(map(tuple, pieces))
    used = {}
    for r in sorted(packed, key=lambda x: x.offset):
        assert used.get(r.sequence_id, 0) == r.offset
        used[r.sequence_id] = r.offset + r.length
    assert max(used.values()) <= 1024 and len(used) <= sum(used.values()) / 1024 * 1.05 + 1


def test_run_leaves_only_its_result(spark):
    found = corpus_pipeline.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = write_once(stage(spark, docs, SF), "stage")
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(found.select(columns).collect()) == sorted(docs.select(columns).collect())
    folder = f"{working_folder(spark)}/palaver/{spark.sparkContext.applicationId}"
    assert matching(spark, f"{folder}/run-*") == [] and matching(spark, f"{folder}/quality-classifier-*") == []
    assert len(matching(spark, f"{folder}/best-fit-packing-*")) == 1
