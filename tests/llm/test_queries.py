import pytest

import __spark_entry__ as entry
import corpus_pipeline
from stpanel.llm.queries import ORACLES, QUERIES
from tests.compare import connect, differences
from tests.llm.test_jaccard import plain_components
from tests.llm.test_mixing import plain as plain_mix
from tests.llm.test_pii import plain as plain_pii

SF = "/root/testdata/sf0.01"


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), connect(SF), ORACLES[name]) == []


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, steps[-1], SF).write.parquet(f"{tmp_path}/{name}")
        steps.append(spark.read.parquet(f"{tmp_path}/{name}"))
    _, language, single, clean, mixed, coded = ([r.asDict() for r in s.collect()] for s in steps)
    assert all(set(s.columns) == set(docs.columns) for s in steps[:-1])
    # Every document of the table has letters and a language: none goes.
    assert len(language) == docs.count()
    groups = plain_components([(r["doc_id"], r["text"]) for r in language])
    assert sorted(r["doc_id"] for r in single) == sorted({c for _, _, c in groups})
    was = {r["doc_id"]: r for r in single}
    for r in clean:
        assert plain_pii(r["text"]) == []
        assert r == was[r["doc_id"]] or plain_pii(was[r["doc_id"]]["text"])
    taken = {d: t for d, _, _, _, t in plain_mix([(r["doc_id"], r["text"], r["source"]) for r in clean]) if t}
    words = {}
    for r in mixed:
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(r["text"].split())
    assert words == taken
    assert len(coded) == len(mixed) and all(len(r["ids"]) == 4 * r["n_tokens"] for r in coded)


def test_run_gives_the_stages_rows(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)] * 2, [(1, "", "en", "a", 0), (1, "the cat sat", None, None, 11)]])
def test_small_pipelines(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() <= len(rows)
