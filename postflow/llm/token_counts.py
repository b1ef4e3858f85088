"""Token counts of fields and sections by offset mapping."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postflow.llm.chunks import byte_bpe, pieces
from postflow.llm.common import free_name

_OUT = pa.schema([
    ("row", pa.int64()), ("id", pa.int64()), ("field", pa.string()), ("section", pa.int32()), ("char_start", pa.int64()), ("char_end", pa.int64()),
    ("n_tokens", pa.int64()), ("n_crossing", pa.int64()),
])


def line_starts(text: str) -> np.ndarray:
    """Where the lines of a text start; a line keeps its line feed. An empty text has one empty line."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    starts = np.append(0, np.flatnonzero(codes == 10) + 1)
    return starts[:-1] if len(starts) > 1 and starts[-1] == len(codes) else starts


def attribute(token_start: np.ndarray, token_end: np.ndarray, section_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, does it cross a boundary?).

    Sections are given by their ends and cover the text without gaps. A token belongs to the section that holds
    most of its characters; among equals to the first of them. Both sides are sorted, so the
    join of the intervals is one binary search per token, and crossing tokens alone are looked at further.
    """
    first = np.searchsorted(section_end, token_start, "right")
    last = np.searchsorted(section_end, token_end - 1, "right")
    owner, crossing = first.copy(), last > first
    for t in np.flatnonzero(crossing):
        inner = section_end[first[t] : last[t]]
        bounds = np.concatenate([[token_start[t]], inner, [token_end[t]]])
        owner[t] = first[t] + int(np.argmax(np.diff(bounds)))
    return owner, crossing


def _counts(vocabulary: str, fields: Sequence[str], joint: str, lines: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_bpe(vocabulary)
        for batch in batches:
            values = [[v or "" for v in batch.column(2 + i).to_pylist()] for i in range(len(fields))]
            whole = [joint.join(parts) for parts in zip(*values)]
            for a, b in pieces(whole):
                n, _, starts, ends = encoder.encode_spans(whole[a:b])
                upto = np.cumsum(n)
                columns: list[list] = [[] for _ in range(6)]
                for d in range(a, b):
                    lo, hi = upto[d - a] - n[d - a], upto[d - a]
                    names, section, first = [], [], []
                    at = 0
                    for i, field in enumerate(fields):
                        text = values[i][d] + (joint if i + 1 < len(fields) else "")
                        own = line_starts(values[i][d]) if lines else np.zeros(1, np.int64)
                        first.append(own + at)
                        names += [field] * len(own)
                        section.append(np.arange(len(own)))
                        at += len(text)
                    first = np.concatenate(first)
                    end = np.append(first[1:], at)
                    owner, crossing = attribute(starts[lo:hi], ends[lo:hi], end)
                    total = np.bincount(owner, minlength=len(end))[: len(end)]
                    crossed = np.bincount(owner[crossing], minlength=len(end))[: len(end)]
                    for column, new in zip(columns, (np.full(len(end), d), names, np.concatenate(section), first, end, np.stack([total, crossed]))):
                        column.append(new)
                doc = np.concatenate(columns[0])
                made = np.concatenate(columns[5], axis=1)
                arrays = [
                    batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)), pa.array([x for own in columns[1] for x in own]),
                    *(pa.array(np.concatenate(columns[i])) for i in (2, 3, 4)), pa.array(made[0]), pa.array(made[1]),
                ]
                yield pa.RecordBatch.from_arrays([x.cast(f.type) for x, f in zip(arrays, _OUT)], schema=_OUT)

    return run


def section_tokens(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", fields: Sequence[str] = ("text",), *, joint: str = "\n\n", lines: bool = True, row_col: str | None = None
) -> DataFrame:
    """Tokens of every field and line of every row, from one encoding of the whole document.

    The fields are joined by ``joint`` (which counts to the field before it) and encoded once, as a model would
    see them; each token is attributed to one section, so the counts of a document add up to its tokens.
    Sections are lines, with their line feed, or whole fields (``lines=False``). A token over a boundary goes to
    the section that holds most of its characters, among equals to the first; a token that holds part of
    a character counts as having it. ``n_crossing`` says how many of ``n_tokens`` came by that rule.

    Returns (row, id, field, section, char_start, char_end, n_tokens, n_crossing), one row per section, places
    in the joined text. NULL fields count as empty; an empty field is one empty section. Repeated rows are
    counted each, a NULL id stays NULL. Other columns are not read. Nothing is shuffled.
    """
    row = row_col or free_name(docs.columns, "row_no")
    source = docs if row_col else docs.withColumn(row, F.monotonically_increasing_id())
    narrow = source.select(F.col(row).alias("row"), F.col(id_col).cast("long").alias("id"), *[F.col(f).cast("string").alias(f"field_{i}") for i, f in enumerate(fields)])
    return narrow.mapInArrow(
        _counts(vocabulary, tuple(fields), joint, lines),
        "row long, id long, field string, section int, char_start long, char_end long, n_tokens long, n_crossing long",
    )
