"""A bucket of the repeat search holds a bounded share of the hashes at any input size."""

import numpy as np
from pyspark.sql import functions as F

import llm_brute as brute
from pulsegrid.llm import substring


def test_buckets_follow_the_bytes(spark, monkeypatch):
    rng = np.random.default_rng(4)
    passage = " ".join(f"p{i}" for i in range(40))
    docs = [(i, " ".join(f"w{k}" for k in rng.integers(0, 10**6, 300)) + (" " + passage if i % 3 == 0 else "")) for i in range(120)]
    held = 20_000
    anchors, owners = substring._shared_anchors, substring._window_owners

    def bounded(run):
        def checked(key, table):
            n = sum(map(len, table.column("hashes").to_pylist()))
            assert n <= held, f"one bucket holds {n} bytes of hashes"
            return run(key, table)

        return checked

    monkeypatch.setattr(substring, "BUCKET_BYTES", held, raising=False)
    monkeypatch.setattr(substring, "_shared_anchors", bounded(anchors))
    monkeypatch.setattr(substring, "_window_owners", bounded(owners))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = substring.remove_repeats(df).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256)).collect()
    assert sorted(map(tuple, got)) == sorted(brute.repeats(docs)) and sum(r["n_removed"] for r in got) == 39 * 40
