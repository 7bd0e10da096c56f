"""Fill-in-the-middle by displacement scatter.

A text is cut twice between its units (a run of Latin letters, or any other single code
point) and its parts change places: prefix, suffix, middle (psm) or suffix, prefix, middle
(spm), each behind its marker; a share of the texts stays plain. Arrow hands over a batch of
texts as one run of bytes. A scan over these bytes finds the units and turns the drawn cuts
into byte positions. Each part of a text moves as a whole, so a difference array that holds
at every part's first byte how much its shift differs from that of the part before gives, by
a running sum, the shift of every byte of the batch; the bytes are scattered to their places
in one step. ``restore`` reads the outputs alone: it finds the markers, builds the same kind
of difference array over the restored bytes, and gathers.

Cuts and forms are drawn from the sha256 of "1:" and the decimal id (of "1:" alone where the
id is null), so every run gives the same result, rows of one id draw alike, and repeated rows
give a row each. A null text counts as empty. An empty text, or one that holds a marker, stays
plain. An empty table gives an empty result. Other columns than id and text are not read.
Memory is bounded by slices of some megabytes; a longer text is a slice of its own, and its
bytes are moved in windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
#: Order of the parts (0 prefix, 1 middle, 2 suffix) in an output.
ORDER = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
MARK = (PREFIX, MIDDLE, SUFFIX)  # by part
MARK_BYTES = 3
#: Bytes that are worked on at once: texts of a slice, and of a window while bytes move.
SLICE, WINDOW = 4 << 20, 1 << 20

_LETTER = np.zeros(256, bool)
_LETTER[ord("A"):ord("Z") + 1] = _LETTER[ord("a"):ord("z") + 1] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column, one text behind another, and the texts' bounds.
    Nulls have no bytes."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0]:at[-1]], at - at[0]


def bytes_column(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """The inverse of :func:`text_bytes`."""
    return pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(data))


def _slices(bounds: np.ndarray) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``SLICE`` bytes, or of one row."""
    lo, n = 0, len(bounds) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + SLICE, side="right")) - 1)
        yield lo, hi
        lo = hi


def shifts(starts: np.ndarray, shift: np.ndarray, total: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """Shift of every byte, in windows (low, high, shifts). ``starts`` (ascending) and ``shift``
    are the parts' first bytes and shifts; parts may be empty: the differences add up."""
    step = np.diff(shift, prepend=0)
    carry = 0
    for low in range(0, total, WINDOW):
        high = min(total, low + WINDOW)
        a, b = np.searchsorted(starts, (low, high))
        difference = np.zeros(high - low, np.int64)
        np.add.at(difference, starts[a:b] - low, step[a:b])
        difference[0] += carry
        moved = np.cumsum(difference, out=difference)
        carry = int(moved[-1])
        yield low, high, moved


def _find_marks(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and letters of all markers that lie inside one text."""
    if len(data) < MARK_BYTES:
        return np.zeros(0, np.int64), np.zeros(0, np.uint8)
    at = np.flatnonzero((data[:-2] == PREFIX[0]) & (data[2:] == PREFIX[2]))
    letter = data[at + 1]
    at = at[np.isin(letter, [m[1] for m in MARK])]
    end = bounds[np.searchsorted(bounds, at, side="right")]
    at = at[at + MARK_BYTES <= end]
    return at, data[at + 1]


def _rows_of(positions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The text that holds each byte position."""
    return np.searchsorted(bounds, positions, side="right") - 1


def _mix(data: np.ndarray, bounds: np.ndarray, draws: np.ndarray, plain_from: int, spm_below: int):
    """Outputs of a slice: bytes, bounds, units, forms, and code points of prefix and middle."""
    rows, total = len(bounds) - 1, len(data)
    low, high = bounds[:-1], bounds[1:]
    letter, first = _LETTER[data], (data & 0xC0) != 0x80
    inside = np.zeros(total, bool)
    inside[1:] = letter[1:] & letter[:-1]
    inside[low[low < high]] = False  # a text's first byte begins a unit
    begins = np.flatnonzero(first & ~inside)
    before = np.searchsorted(begins, low)
    n = np.searchsorted(begins, high) - before
    one, two = draws[:, 0] % (n + 1), draws[:, 1] % (n + 1)
    cuts = np.stack([np.minimum(one, two), np.maximum(one, two)])
    at = np.append(begins, total)
    places = np.where(cuts < n, at[np.minimum(before + cuts, len(at) - 1)], high)

    form = np.where(draws[:, 2] % 100 >= plain_from, PLAIN, np.where(draws[:, 3] % 100 < spm_below, SPM, PSM))
    form[low == high] = PLAIN
    marked, _ = _find_marks(data, bounds)
    form[_rows_of(marked, bounds)] = PLAIN

    begin = np.stack([low, *places])  # prefix, middle, suffix
    size = np.stack([*places, high]) - begin
    out_bounds = np.append(0, np.cumsum(high - low + np.where(form == PLAIN, 0, 3 * MARK_BYTES)))
    target = begin - low + out_bounds[:-1]  # plain: nothing moves inside the text
    out = np.empty(out_bounds[-1], np.uint8)
    for kind, order in ORDER.items():
        of = np.flatnonzero(form == kind)
        place = out_bounds[of].copy()
        for part in order:
            for k in range(MARK_BYTES):
                out[place + k] = MARK[part][k]
            target[part, of] = place + MARK_BYTES
            place += MARK_BYTES + size[part, of]
    for lo, hi, moved in shifts(begin.T.ravel(), (target - begin).T.ravel(), total):
        out[np.arange(lo, hi) + moved] = data[lo:hi]
    points = np.append(0, np.cumsum(first)) if total else np.zeros(1, np.int64)
    chars = points[begin + size] - points[begin]
    return out, out_bounds, n, form, chars[0], chars[1]


def _unmix(data: np.ndarray, bounds: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of the texts, from outputs and forms only."""
    rows = len(bounds) - 1
    low, high = bounds[:-1], bounds[1:]
    out_bounds = np.append(0, np.cumsum(high - low - np.where(form == PLAIN, 0, 3 * MARK_BYTES)))
    at, _ = _find_marks(data, bounds)
    at = at[form[_rows_of(at, bounds)] != PLAIN]
    mixed = np.flatnonzero(form != PLAIN)
    if len(at) != 3 * len(mixed):
        raise ValueError("an output that is not plain must hold its three markers, once each")
    at = at.reshape(-1, 3)
    source = np.broadcast_to(low, (3, rows)).copy()
    size = np.stack([high - low, np.zeros(rows, np.int64), np.zeros(rows, np.int64)])
    end = np.concatenate([at[:, 1:], high[mixed][:, None]], 1)
    for kind, order in ORDER.items():
        of = form[mixed] == kind
        for k, part in enumerate(order):
            source[part, mixed[of]] = at[of, k] + MARK_BYTES
            size[part, mixed[of]] = end[of, k] - at[of, k] - MARK_BYTES
    begin = out_bounds[:-1] + np.cumsum(size, 0) - size
    out = np.empty(out_bounds[-1], np.uint8)
    for lo, hi, moved in shifts(begin.T.ravel(), (source - begin).T.ravel(), len(out)):
        out[lo:hi] = data[np.arange(lo, hi) + moved]
    return out, out_bounds


def draws(id_col: str | Column) -> Column:
    """Four unsigned 32-bit numbers of a row: the first 8-digit groups of its id's sha256."""
    decimal = F.coalesce((F.col(id_col) if isinstance(id_col, str) else id_col).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit("1:"), decimal), 256)
    group = lambda d, k: F.conv(F.substring(d, 1 + 8 * k, 8), 16, 10).cast("long")
    return F.transform(F.array(digest), lambda d: F.array(*(group(d, k) for k in range(4))))[0]


def fill_in_middle(docs: DataFrame, fim_percent: int = 90, spm_percent: int = 20, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars and middle_chars (code points;
    null if plain) and output, one row for each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    fields = ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = text_bytes(b.column(2))
            drawn = b.column(1).flatten().to_numpy().reshape(-1, 4)
            for lo, hi in _slices(bounds):
                out, at, n, form, prefix, middle = _mix(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo], drawn[lo:hi],
                                                        fim_percent, spm_percent)
                plain = form == PLAIN
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(n), pa.DictionaryArray.from_arrays(form, list(FORMS)).cast(pa.string()),
                     pa.array(prefix, mask=plain), pa.array(middle, mask=plain), bytes_column(out, at).cast(pa.string())], names=fields)

    return docs.select(F.col(id_col).cast("long"), draws(id_col), F.col(text_col)).mapInArrow(
        run, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restore(mixed: DataFrame) -> DataFrame:
    """``mixed`` with one more column, restored: the exact text, from output and form."""
    bounded_batches(mixed.sparkSession)
    columns = mixed.columns
    form_at, output_at = columns.index("form"), columns.index("output")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            data, bounds = text_bytes(b.column(output_at))
            form = np.array([FORMS.index(f) for f in b.column(form_at).to_pylist()], np.int64)
            for lo, hi in _slices(bounds):
                out, at = _unmix(data[bounds[lo]:bounds[hi]], bounds[lo:hi + 1] - bounds[lo], form[lo:hi])
                yield pa.RecordBatch.from_arrays([*b.slice(lo, hi - lo).columns, bytes_column(out, at).cast(pa.string())],
                                                 names=[*columns, "restored"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in mixed.dtypes)
    return mixed.mapInArrow(run, f"{schema}, restored string")
