"""The pipeline's stages against brute force, each on its own input."""

import corpus_pipeline
import pytest

from docketry.llm import decontaminate, mixing, neardup, quality, toxicity
from docketry.llm.common import table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def ids(df):
    return sorted(r["doc_id"] for r in df.select("doc_id").collect())


@pytest.fixture(scope="module")
def stages(spark, data, tmp_path_factory):
    top = tmp_path_factory.mktemp("stages")
    docs = [table(spark, data, "documents")]
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, docs[-1], data).write.parquet(str(top / str(k)))
        docs.append(spark.read.parquet(str(top / str(k))))
    return docs


def test_order_and_columns(stages):
    assert [f for _, f in corpus_pipeline.STAGES] == [quality.pipeline_stage, toxicity.pipeline_stage, neardup.one_of_each, decontaminate.pipeline_stage, mixing.pipeline_stage]
    assert all(d.columns == COLUMNS for d in stages[1:5])


def test_filters(spark, data, stages):
    labels = table(spark, data, "labels")
    kept = set(ids(stages[1]))
    good = {r["doc_id"]: r["quality"] for r in labels.join(stages[0], "doc_id").collect()}
    assert sum(q == (d in kept) for d, q in good.items()) >= 0.97 * len(good)
    scored = quality.score(stages[0], quality.train(stages[0], labels), ["doc_id"])
    assert ids(scored.where("score >= 0.3")) == ids(stages[1])
    scored = toxicity.score(stages[1], toxicity.train(stages[1], labels), ["doc_id"])
    assert ids(scored.where("score < 0.5")) == ids(stages[2])
    leaked = {r["doc_id"] for r in decontaminate.leaks(stages[3], table(spark, data, "benchmark")).collect()}
    assert ids(stages[4]) == sorted(set(ids(stages[3])) - leaked)


def test_near_duplicates(stages):
    from test_neardup import brute

    rows = [(r["doc_id"], r["text"]) for r in stages[2].select("doc_id", "text").collect()]
    assert ids(stages[3]) == sorted(i for i, x in brute(rows, 80).items() if x[2])


def test_mix(stages):
    out = stages[5].toPandas()
    assert set(out.doc_id) <= set(ids(stages[4])) and (out.copies > 0).all() and (out.taken <= 2 * out["size"]).all()


def test_run(spark, data, stages):
    assert ids(corpus_pipeline.run(spark, data)) == ids(stages[5])
