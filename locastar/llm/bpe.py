"""Byte-level BPE encoding and decoding (operator 10)."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from locastar.llm.common import texts_of
from locastar.llm.tokens import byte_encoder, rest


def encode(docs: DataFrame, path: str, pattern: str, digests: bool = False, offsets: bool = False) -> DataFrame:
    """(doc_id, ids array<int>[, starts, stops array<int>]), or with ``digests``
    (doc_id, n_tokens, ids_sha256, decoded_sha256) without the long arrays.

    One row for each input row, repeated rows and null ids too; a null or
    empty text has no ids. A batch holds a bounded number of rows and a
    worker a bounded table of pieces, however large the corpus is. With
    ``offsets`` each id has the characters that its bytes touch; a character
    split between ids lies in both spans.
    """
    if digests:
        schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    else:
        schema = "doc_id long, ids array<int>" + (", starts array<int>, stops array<int>" if offsets else "")

    def run(batches):
        coder = byte_encoder(path, pattern)
        for batch in batches:
            ids_column, rows = batch.column(0).cast(pa.int64()), []
            for text in batch.column(1).to_pylist():
                if digests:
                    n, decimals, decoded = coder.digest(text)
                    rows.append((n, hashlib.sha256(decimals.encode()).hexdigest(), hashlib.sha256(decoded).hexdigest()))
                    continue
                ids = coder.encode(text)
                if offsets:
                    spans = coder.offsets(text, ids)
                    rows.append((ids, [a for a, _ in spans], [b for _, b in spans]))
                else:
                    rows.append((ids,))
            columns = list(zip(*rows)) or [()] * (3 if digests or offsets else 1)
            kinds = [pa.int64(), pa.string(), pa.string()] if digests else [pa.list_(pa.int32())] * 3
            names_out = [f.split()[0] for f in schema.replace("<int>", "").split(", ")]
            yield pa.RecordBatch.from_arrays([ids_column, *(pa.array(list(c), k) for c, k in zip(columns, kinds))], names_out)
        rest(coder.words, coder.pieces)

    return texts_of(docs).mapInArrow(run, schema)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids) -> (doc_id, decoded binary, text): bytes that are no whole
    character become U+FFFD in the text only. Null ids decode to nothing."""

    def run(batches):
        coder = byte_encoder(path, pattern)
        for batch in batches:
            parts = [coder.decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(parts, pa.binary()),
                 pa.array([p.decode("utf-8", "replace") for p in parts], pa.string())], ["doc_id", "decoded", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary, text string")
