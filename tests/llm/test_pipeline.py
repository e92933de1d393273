from __future__ import annotations

import pytest

import corpus_pipeline

WORDS = {"aa": "bana lopa miru tanako sela doru vina", "zz": "krzt vlsk grmpf strv prsk dvrl mnk"}


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(WORDS[k].split(), 60)), k) for i, k in enumerate(["aa", "zz"] * 30)]
    leak = "the question of this item has these very words in it"
    rows += [(100, rows[4][1], "aa"), (101, rows[6][1].replace(" ", "  "), None), (102, "12345 678 ---", None), (103, None, None), (103, None, None),
             (104, rows[8][1][::-1] + " " + leak, None), (105, " ".join(rng.choice(WORDS["aa"].split(), 60)) + " bana.lopa@miru.example", "aa")]
    path = tmp_path_factory.mktemp("tables")
    docs(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(1, leak)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path), rows


def test_each_stage_does_its_part(spark, folder):
    path, rows = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, path)
        assert after.columns == docs.columns
        docs = after
        kept[name] = {r.doc_id: r for r in docs.collect()}
    first = {i for i, *_ in rows}
    assert first - set(kept["language ID"]) == {102, 103}
    assert set(kept["language ID"]) - set(kept["SimHash near-dedup"]) == {100, 101}
    assert set(kept["SimHash near-dedup"]) - set(kept["benchmark decontamination"]) == {104}
    assert set(kept["PII"]) == set(kept["benchmark decontamination"])
    assert kept["PII"][105].text.endswith(" <EMAIL>") and kept["PII"][105].n_chars == len(kept["PII"][105].text)


def test_run_packs_what_the_stages_keep(spark, folder):
    path, rows = folder
    pieces = corpus_pipeline.run(spark, path).collect()
    assert {p.doc_id for p in pieces} == {i for i, *_ in rows} - {100, 101, 102, 103, 104}


def test_an_empty_table_runs_through(spark, folder, tmp_path, nothing):
    nothing.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{folder[0]}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
