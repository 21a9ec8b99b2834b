"""Token counts of whole texts by a public tokenizer.

Texts are encoded in Arrow batches and only lengths leave the task: no id is ever a row. Rows are taken in runs of
about a megabyte; within a run, texts longer than ``encoding.PART_CHARS`` are cut at boundaries that no token crosses,
and the parts go to the library in calls balanced by bytes. So the memory of a task follows the size of a call, not
that of the longest text. Nothing is shuffled; Spark splits the table by bytes of its files.

Defined results: null and empty texts have no bytes and no tokens; repeated rows are counted each; special strings in
a text are what the library makes of them by default (the ``.json`` file's are one token each); a null doc_id stays
null; extra columns are ignored. No documents give no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsegrid.llm import encoding
from pulsegrid.llm.common import offsets_of, prepare, slices, texts

LIMIT = 512


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _counter(path: str):
    def run(batches):
        lib = encoding.tokenizer(path)
        for batch in batches:
            for rows in slices(batch, "text"):
                text = texts(rows.column("text"))
                n = encoding.count_ids(lib, text.to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), pa.array(np.diff(offsets_of(text))), pa.array(n)], names=["doc_id", "n_bytes", "n_tokens"])

    return run


def count_tokens(docs: DataFrame, tokenizer_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: doc_id, n_bytes (UTF-8), n_tokens, over_limit (n_tokens > limit).

    ``tokenizer_path`` is a ``.json`` file of the tokenizers library or a ``.model`` file of sentencepiece.
    """
    prepare(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counted = docs.mapInArrow(_counter(tokenizer_path or default_tokenizer()), "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
