"""Token counts: batch encoding inside an Arrow function that returns lengths only.

Rows are walked in slices of at most ``slice_bytes`` text bytes, so calls to the encoder are balanced by bytes and not by
rows; whole texts are cut at safe boundaries (see token_units) and the pieces' lengths added up.  The plan has no shuffle.

Defined cases: a null or empty text has no bytes and no tokens; a null id is kept; repeated rows give repeated rows; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import bytetext as B
from .shared import map_batches, text_column
from .token_units import UnitEncoder

SLICE_BYTES = 1 << 20


def count_tokens(docs: DataFrame, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text", limit: int = 2048, slice_bytes: int = SLICE_BYTES) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row; tokenizer: the path of a file whose pre-tokenizer drops white space."""
    kind = dict(docs.dtypes)[id_col]

    def count(batch: pa.RecordBatch):
        encoder = UnitEncoder.of(tokenizer, "word", True)
        column = batch.column(1)
        _, offsets = B.utf8_buffers(column)
        for lo, hi in B.row_slices(offsets, slice_bytes):
            tokens = np.array(encoder.lengths([t or "" for t in column.slice(lo, hi - lo).to_pylist()]), dtype=np.int64)
            yield {id_col: batch.column(0).slice(lo, hi - lo), "n_bytes": np.diff(offsets[lo : hi + 1]), "n_tokens": tokens, "over_limit": tokens > limit}

    return map_batches(text_column(docs, text_col).select(id_col, text_col), count, f"{id_col} {kind}, n_bytes long, n_tokens long, over_limit boolean")
