"""Every stage of the pipeline against a plain reading of its rule, on what its predecessor kept."""

import corpus_pipeline as P
from tidemark.llm import packing, toxicity
from tidemark.session import stage
from test_operators import LOWER, brute_components, check_packing, plain_spans, text_of


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [name for name, _ in P.STAGES]
    assert len(names) == 5
    kept = [docs]
    for _, function in P.STAGES[:-1]:
        kept.append(stage(function(spark, kept[-1], sf)))
        assert kept[-1].columns == docs.columns
    rows = [{r.doc_id: r for r in df.collect()} for df in kept]
    fitted = toxicity.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(docs, fitted).collect() if r.score >= 0.5}
    assert set(rows[1]) == set(rows[0]) - toxic
    last = {}
    for i, r in rows[1].items():
        key = text_of(r.text).translate(LOWER)
        last[key] = max(i, last.get(key, i))
    assert set(rows[2]) == set(last.values())
    assert set(rows[3]) == set(brute_components([(i, r.text) for i, r in rows[2].items()]).values())
    assert set(rows[4]) == set(rows[3])
    for i, r in rows[4].items():
        assert not plain_spans(text_of(r.text)) and r.n_chars == len(r.text)
        assert plain_spans(text_of(rows[3][i].text)) or r.text == rows[3][i].text
    check_packing(packing.pack(kept[4]).collect(), [(i, r.text) for i, r in rows[4].items()])
    out = P.run(spark, sf)
    assert sum(r.length for r in out.collect()) == sum(r.length for r in packing.pack(kept[4]).collect())
