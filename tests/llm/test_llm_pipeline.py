"""The pipeline's stages against plain versions on the smallest documents."""

import llm_brute as brute
from conftest import SF_SMALL

import corpus_pipeline
from pulsegrid.llm.common import materialise, read_table


def test_stages(spark):
    docs = read_table(spark, SF_SMALL, "documents")
    columns = docs.columns
    frames = {"input": docs.toPandas()}
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF_SMALL), "test-stage")
        frames[name] = docs.toPandas()
        if name != "packing":
            assert docs.columns == columns
    first, clean, single, masked, mixed, packed = frames.values()
    assert set(clean["doc_id"]) < set(first["doc_id"]) or len(clean) == len(first)
    texts = list(clean.sort_values("doc_id")[["doc_id", "text"]].itertuples(index=False, name=None))
    assert sorted(single["doc_id"]) == [i for i, _, _, kept in brute.near_duplicates(texts, 5) if kept]
    before = single.set_index("doc_id")["text"]
    assert list(masked["doc_id"].sort_values()) == list(single["doc_id"].sort_values())
    for r in masked.itertuples():
        assert not brute.base_spans(r.text)
        assert r.n_chars == len(r.text) and (r.text == before[r.doc_id]) == (not brute.base_spans(before[r.doc_id]))
    assert mixed["doc_id"].value_counts().max() <= 3 and set(mixed["doc_id"]) <= set(masked["doc_id"])
    assert packed.groupby("sequence_id")["length"].sum().max() <= 2048
    assert (packed[packed["start"] == 0].groupby("doc_id").size() == mixed.groupby("doc_id").size()).all()
    assert corpus_pipeline.run(spark, SF_SMALL).count() == len(packed)
