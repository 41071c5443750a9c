"""Texts cut into slices of bounded tokens at safe boundaries."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import scratch
from ..functions import columns as C
from ..functions.boundaries import Tokens, boundary

#: Characters of a window for each token that may fit in a slice.
CHARS = 10
#: Characters of texts whose slices are held at once, beside the batch that Spark sends.
HELD = 1 << 20


def slices_of(text: str, most: int, soft: bool = True, shift: int = 500, tokens: Callable[[str], Tokens] = Tokens, strict: bool = False) -> list[tuple[str, int, int]]:
    """(text, first token, end token) of each slice; together they are the text.

    A window of the text is tokenized at a time. strict keeps a fault of the original rule: a window that fits in one
    slice ends the text even where more follows.
    """
    if not text or not text.strip():
        return []
    out, at, offset = [], 0, 0
    width = CHARS * (most + (shift if soft else 0))
    while at < len(text):
        window = tokens(text[at : at + width])
        if len(window) <= most:
            out.append((window.text, offset, offset + len(window)))
            if strict:
                break
            cut = len(window)
        else:
            cut = boundary(window, most, shift, most) if soft and shift > 0 else most
            cut = max(1, cut)
            out.append((window.text[: window.at[cut]], offset, offset + cut))
        at += window.at[cut]
        offset += cut
    return out


def normalised(text: str) -> str:
    return unicodedata.normalize("NFC", text)


def preprocess(files: DataFrame) -> DataFrame:
    """files (source_file, text) in NFC without script and style elements."""

    @F.pandas_udf("string")
    def nfc(s: pd.Series) -> pd.Series:
        return s.map(lambda t: None if t is None else normalised(t))

    return files.withColumn("text", C.strip_scripts(nfc("text")))


def slice_files(files: DataFrame, most: int = 5000, soft: bool = True, shift: int = 500, strict: bool = False) -> DataFrame:
    """SLICE rows for files (source_file, text), numbered over all files in the order of their names.

    Files are independent, so each is cut where it lies, once: the slices are settled. Only the numbering needs the counts
    of the files before, which are summed in the order of a global sort.
    """
    kinds = pa.schema([("source_file", pa.string()), ("k", pa.int32()), ("text", pa.string()), ("slice_token_start", pa.int32()), ("slice_token_end", pa.int32())])

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds, strict=True)], schema=kinds)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows, held = [], 0
            for f, t in zip(b.column(0), b.column(1), strict=True):
                name, text = f.as_py(), t.as_py() or ""
                rows += [(name, k, *s) for k, s in enumerate(slices_of(text, most, soft, shift, strict=strict))]
                held += len(text)
                if held > HELD:
                    yield batch(rows)
                    rows, held = [], 0
            yield batch(rows)

    cuts = files.select("source_file", "text").mapInArrow(cut, "source_file string, k int, text string, slice_token_start int, slice_token_end int")
    cuts = scratch.settle(cuts, "cuts")
    counts = scratch.sums_before(cuts.groupBy("source_file").agg(F.count(F.lit(1)).alias("n")), "n", "source_file").withColumnRenamed("__n", "before")
    order = (F.col("before") + F.col("k") + 1).cast("int")
    return cuts.join(counts.select("source_file", "before"), "source_file").select(F.format_string("slice_%03d", order).alias("id"), order.alias("order"), "source_file", C.slug(F.col("source_file")).alias("slug"), "text", "slice_token_start", "slice_token_end")
