"""Lengths in tokens of a public tokenizer."""

from __future__ import annotations

import base64
import importlib.util
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Where the public vocabularies are, and which is used; both are parameters.
TOKENIZERS, VOCABULARY = "/opt/tokenizers", "byte_bpe_multi_50k.tiktoken"


@lru_cache(maxsize=2)
def encoding(folder: str, vocabulary: str):
    """The tokenizer, loaded once per Python worker; the pattern is the one that comes with the vocabularies."""
    import tiktoken

    spec = importlib.util.spec_from_file_location("tokenizer_folder", Path(folder, "__init__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    with Path(folder, vocabulary).open("rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=module.PATTERN, mergeable_ranks=ranks, special_tokens={})


def token_counts(documents: DataFrame, doc_id: str = "doc_id", text: str = "text", keep: tuple[str, ...] = (), folder: str = TOKENIZERS, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id``, ``keep`` (strings), ``n_tokens`` of the whole text; null and empty texts have 0. Rows without an id are
    left out. One narrow pass; texts aren't shuffled."""
    rows = documents.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).cast("bigint").alias("doc_id"), *[F.col(k).cast("string").alias(k) for k in keep], F.col(text).cast("string").alias("__text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = encoding(folder, vocabulary)
        for b in batches:
            n = [len(tokenizer.encode_ordinary(t)) if t else 0 for t in b.column("__text").to_pylist()]
            yield pa.record_batch([b.column(c) for c in ("doc_id", *keep)] + [pa.array(n, pa.int64())], ["doc_id", *keep, "n_tokens"])

    return rows.mapInArrow(run, ", ".join(["doc_id bigint", *(f"{k} string" for k in keep), "n_tokens bigint"]))
