"""Fill-in-middle transformation by displacement scatter.

The texts of a batch lie in one byte buffer. A scan finds the line ends and so the two cuts of every
text. A difference array holds, at the first byte of each prefix, middle and suffix, by how much more
that part moves than the part before it; its cumulative sum is the shift of every byte, and one
scatter writes the output buffer. The way back scans an output for its marks, builds the shifts of
the parts in the same way and gathers the text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geolayer.llm.common import map_slices, text_of

#: The marks before prefix, suffix and middle.
MARKS = (b"<P>", b"<S>", b"<M>")
MARK = 3
FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
SEED = 7
MIDDLE_PERCENT = 100
SPM_PERCENT = 50
#: Bytes whose shifts are held at once.
BLOCK = 1 << 20


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a binary column without nulls, and where each text starts (and the last one ends)."""
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    start, end = int(offsets[0]), int(offsets[-1])
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8)[start:end] if data is not None else np.zeros(0, np.uint8)
    return held, offsets.astype(np.int64) - start


def binary_array(data: np.ndarray, starts: np.ndarray) -> pa.Array:
    """A binary column from its bytes and starts."""
    return pa.Array.from_buffers(pa.binary(), len(starts) - 1, [
        None, pa.py_buffer(starts.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def marks_in(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, rows and kinds (0 prefix, 1 suffix, 2 middle) of the marks in each text."""
    at = np.flatnonzero(data[:-2] == ord("<")) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[data[at + 2] == ord(">")]
    kind = np.full(len(at), -1, np.int8)
    for k, mark in enumerate(MARKS):
        kind[data[at + 1] == mark[1]] = k
    at, kind = at[kind >= 0], kind[kind >= 0]
    row = np.searchsorted(starts, at, "right") - 1
    inside = at + MARK <= starts[row + 1]
    return at[inside], row[inside], kind[inside]


def shifts(places: np.ndarray, moves: np.ndarray, size: int):
    """``(low, high, shift)`` of the bytes in blocks: ``places`` (ascending) start parts that move by
    ``moves``. The difference array of a block carries on from the sum so far."""
    steps = np.diff(moves, prepend=0)
    total, low = 0, 0
    for low in range(0, size, BLOCK):
        high = min(low + BLOCK, size)
        a, b = np.searchsorted(places, [low, high])
        change = np.zeros(high - low, np.int64)
        np.add.at(change, places[a:b] - low, steps[a:b])
        shift = np.cumsum(change) + total
        total = int(shift[-1])
        yield low, high, shift


def cuts(
    data: np.ndarray, starts: np.ndarray, draws: tuple[np.ndarray, np.ndarray],
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Number of lines of each text, and the bytes after which its prefix and its middle end.

    A line ends with its newline, or at the end of the text.
    """
    breaks = np.flatnonzero(data == ord("\n"))
    first = np.searchsorted(breaks, starts)
    held = first[1:] - first[:-1]
    ends = starts[1:]
    filled = ends > starts[:-1]
    closed = np.zeros(len(held), bool)
    closed[filled] = data[ends[filled] - 1] == ord("\n")
    n = held + (filled & ~closed)

    def place(units: np.ndarray) -> np.ndarray:
        out = np.where(units > 0, ends, starts[:-1])
        broken = (units > 0) & (units <= held)
        out[broken] = breaks[first[:-1][broken] + units[broken] - 1] + 1
        return out

    a, b = (d.astype(np.int64) % (n + 1) for d in draws)
    return n, place(np.minimum(a, b)), place(np.maximum(a, b))


def code_points(data: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Number of code points between two places of each text (UTF-8 bytes that start one)."""
    heads = np.append((data & 0xC0) != 0x80, False).view(np.uint8)
    edges = np.stack([low, high], axis=1).ravel()
    counts = np.add.reduceat(heads, edges, dtype=np.int64)[::2] if len(edges) else np.zeros(0, np.int64)
    return np.where(high > low, counts, 0)


def scatter(
    data: np.ndarray, starts: np.ndarray, low: np.ndarray, high: np.ndarray, form: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Output bytes and starts: parts between the cuts moved to their places behind the marks."""
    begin, end = starts[:-1], starts[1:]
    size = end - begin + np.where(form == PLAIN, 0, 3 * MARK)
    to = np.concatenate([[0], np.cumsum(size)])
    head, prefix, middle, suffix = to[:-1], low - begin, high - low, end - high
    # Where each part lands; the mark lies before it.
    put_p = np.select([form == PSM, form == SPM], [head + MARK, head + 2 * MARK + suffix], head)
    put_m = np.where(form == PLAIN, head + prefix, head + 3 * MARK + prefix + suffix)
    put_s = np.select([form == PSM, form == SPM], [head + 2 * MARK + prefix, head + MARK],
                      head + prefix + middle)
    put_m = np.where(form == SPM, head + 3 * MARK + suffix + prefix, put_m)
    places = np.stack([begin, low, high], axis=1).ravel()
    moves = (np.stack([put_p, put_m, put_s], axis=1) - np.stack([begin, low, high], axis=1)).ravel()
    out = np.empty(int(to[-1]), np.uint8)
    for a, b, shift in shifts(places, moves, len(data)):
        out[np.arange(a, b) + shift] = data[a:b]
    marked = form != PLAIN
    for mark, put in zip(MARKS, (put_p, put_s, put_m)):
        for k in range(MARK):
            out[put[marked] - MARK + k] = mark[k]
    return out, to


def gather(data: np.ndarray, starts: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The texts of outputs: the parts behind the marks are read in the order of the text."""
    at, row, kind = marks_in(data, starts)
    mine = form[row] != PLAIN
    at, row, kind = at[mine], row[mine], kind[mine]
    n = len(starts) - 1
    found = np.zeros((n, 3), np.int64)
    found[row, kind] = at
    marked = form != PLAIN
    if len(at) != 3 * marked.sum():
        raise ValueError("an output has not one mark of each kind")
    begin, end = starts[:-1], starts[1:]
    p, s, m = found.T
    # A part ends at the mark that follows it.
    after_p, after_s = np.where(form == PSM, s, m), np.where(form == PSM, m, p)
    plain = form == PLAIN
    lengths = [np.where(plain, end - begin, after_p - p - MARK), np.where(plain, 0, end - m - MARK),
               np.where(plain, 0, after_s - s - MARK)]
    size = sum(lengths)
    to = np.concatenate([[0], np.cumsum(size)])
    put = np.stack([to[:-1], to[:-1] + lengths[0], to[:-1] + lengths[0] + lengths[1]], axis=1)
    source = np.stack([np.where(plain, begin, p + MARK), np.where(plain, end, m + MARK),
                       np.where(plain, end, s + MARK)], axis=1)
    out = np.empty(int(to[-1]), np.uint8)
    for a, b, shift in shifts(put.ravel(), (source - put).ravel(), len(out)):
        out[a:b] = data[np.arange(a, b) + shift]
    return out, to


def draw(doc_id: str, k: int, seed: int = SEED) -> Column:
    """The ``k``-th draw of a document: eight hexadecimal digits of a digest of seed and id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    digest = F.sha2(key.cast("binary"), 256)
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def fill_in_middle(
    docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", seed: int = SEED,
    middle_percent: int = MIDDLE_PERCENT, spm_percent: int = SPM_PERCENT,
) -> DataFrame:
    """``doc_id, n, form, prefix_chars, middle_chars, output`` of every document.

    A text is cut at two drawn line ends. ``middle_percent`` of the documents are transformed, and
    of these ``spm_percent`` have the suffix first; the others, empty texts and texts holding a mark
    stay ``plain`` with null lengths. A null text counts as empty, a null id as an empty one; equal
    ids have equal draws, so repeated rows have equal outputs. An empty table gives no rows. Other
    columns are not read. Rows are independent, so nothing is shuffled; batches are cut by bytes and
    shifts are held in blocks, so a very long text takes a few times its own size.
    """
    def run(batch: pa.RecordBatch) -> dict:
        texts = batch.column("_text")
        data, starts = buffer_of(texts)
        h1, h2, h3, h4 = (batch.column(f"_h{k}").to_numpy() for k in (1, 2, 3, 4))
        n, low, high = cuts(data, starts, (h1, h2))
        form = np.where(h4 % 100 < spm_percent, SPM, PSM)
        form[(starts[1:] == starts[:-1]) | (h3 % 100 >= middle_percent)] = PLAIN
        form[marks_in(data, starts)[1]] = PLAIN
        out, to = scatter(data, starts, low, high, form)
        plain = form == PLAIN
        return {
            "doc_id": batch.column("doc_id"), "n": n, "form": pa.array(FORMS).take(pa.array(form)),
            "prefix_chars": pa.array(code_points(data, starts[:-1], low), pa.int64(), mask=plain),
            "middle_chars": pa.array(code_points(data, low, high), pa.int64(), mask=plain),
            "output": binary_array(out, to).cast(pa.string())}

    rows = docs.select(
        F.col(doc_id).alias("doc_id"), *(draw(doc_id, k, seed).alias(f"_h{k}") for k in (1, 2, 3, 4)),
        text_of(text).cast("binary").alias("_text"))
    return map_slices(
        rows, run, f"doc_id {rows.dtypes[0][1]}, n long, form string, prefix_chars long, "
        "middle_chars long, output string")


def restored(outputs: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``columns`` of the rows and ``restored``, the text rebuilt from ``output`` and ``form`` alone.

    ``columns`` are those of ``outputs`` if not named. An output that lacks a mark is an error.
    """
    rows = outputs.select(
        *(columns or outputs.columns), F.col("form").alias("_form"),
        F.col("output").cast("binary").alias("_output"))

    def run(batch: pa.RecordBatch) -> dict:
        data, starts = buffer_of(batch.column(batch.num_columns - 1))
        names = batch.column(batch.num_columns - 2).to_pylist()
        out, to = gather(data, starts, np.array([FORMS.index(f) for f in names], np.int8))
        return {n: batch.column(i) for i, n in enumerate(batch.schema.names[:-2])} | {
            "restored": binary_array(out, to).cast(pa.string())}

    head = ", ".join(f"`{c}` {k}" for c, k in rows.dtypes[:-2])
    return map_slices(rows, run, f"{head}, restored string")
