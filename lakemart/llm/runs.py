"""Periodic runs of words, detected on a grammar.

A run is a stretch of words with smallest period q (words q apart are equal), at least four
periods and at least six words long, that no neighbouring word extends. The words of a slice
of documents become numbers, and Re-Pair builds a grammar over them: adjacent pairs that occur
more than once are replaced by nonterminals, the most frequent first (in rounds: all pairs
that are more frequent than both their neighbours go at once, ties by hash). What is left of
a document is joined by a balanced tree of pairs.

Every run lies whole in the expansion of the lowest node that holds it and crosses that
node's boundary, so runs are sought there only: once for each nonterminal, however often it
occurs. A run of four periods has two of them on one side of the boundary. A candidate period
p is therefore a square of length 2p that begins or ends there; a few single comparisons rule
out nearly all periods, the rest is extended word by word, and multiples of a period found
are skipped. The runs are moved to all positions from which their nonterminal was derived,
and merged to maximal intervals, of which the smallest period is kept.

Words are stretches without ASCII white space. A null or empty text has no words and no runs;
rows without an id and repeated rows get a result each, as does every text, whatever its
length: a long document is a slice of its own, with some hundred bytes of memory a word. An
empty table gives an empty result. Other columns than id and text are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence
from itertools import chain, compress, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakemart.llm.common import bounded_batches

#: Least length of a run in periods and in words.
PERIODS, LEAST = 4, 6
#: Words of the documents that share a grammar (or one longer document); candidates tested at once.
SLICE_WORDS, CANDIDATES = 150_000, 1 << 18

Nodes = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # start, boundary, end, name


def _numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key, its number among the distinct keys and how often it occurs."""
    order = np.argsort(keys, kind="stable")
    new = np.diff(keys[order], prepend=keys[order[:1]] - 1) != 0
    group = np.cumsum(new) - 1
    counts = np.bincount(group)
    number = np.empty(len(keys), np.int64)
    number[order] = group
    return number, counts[number]


def grammar(words: np.ndarray, doc: np.ndarray) -> Iterator[Nodes]:
    """Derivation nodes over the numbered ``words`` of documents (``doc``, ascending): Re-Pair
    rounds, then the balanced tree. All occurrences of a nonterminal come together; in a round
    one name is one nonterminal."""
    sym, start = words.astype(np.int64), np.arange(len(words))
    length, fresh_id = np.ones(len(words), np.int64), int(words.max(initial=0)) + 1
    single = np.zeros(max(0, len(sym) - 1), bool)  # pairs known to occur once
    while len(sym) > 1:
        live = np.flatnonzero((doc[start[1:]] == doc[start[:-1]]) & ~single)
        key = (sym[live] << 31) | sym[live + 1]
        if not len(key):
            break
        number, times = _numbered(key)
        single[live[times == 1]] = True
        if times.max() < 2:
            break
        often = np.zeros(len(sym) + 1, np.int64)  # of the pair at i, at place i + 1
        tie = np.zeros(len(sym) + 1, np.uint64)
        often[live + 1] = np.where(times > 1, times, 0)
        tie[live + 1] = key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        at = live[times > 1]
        here, there = often[at + 1], tie[at + 1]
        chosen = np.ones(len(at), bool)
        for side in (at, at + 2):
            chosen &= (here > often[side]) | ((here == often[side]) & (there >= tie[side]))
        at, name = at[chosen], number[times > 1][chosen]
        # Neighbours among the chosen are the same pair ("aaa"): every other one of a stretch.
        stretch = np.diff(at, prepend=-2) != 1
        first = at[np.maximum.accumulate(np.where(stretch, np.arange(len(at)), 0))]
        even = (at - first) % 2 == 0
        at, name = at[even], name[even]
        yield start[at], start[at + 1], start[at + 1] + length[at + 1], name
        sym[at], fresh_id = fresh_id + name, fresh_id + int(name.max()) + 1
        length[at] += length[at + 1]
        single[at] = False
        single[at[at > 0] - 1] = False
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        # The pair that began at a removed symbol now begins at the one before it.
        single = single[keep[:-1]] if keep[-1] else single[keep[:-1]][:-1]
        sym, start, length = sym[keep], start[keep], length[keep]
    while len(start) > 1:
        same = doc[start[1:]] == doc[start[:-1]]
        begins = np.append(True, ~same)
        nth = np.arange(len(start)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
        at = np.flatnonzero(same & (nth[:-1] % 2 == 0))
        if not len(at):
            break
        yield start[at], start[at + 1], start[at + 1] + length[at + 1], np.arange(len(at))
        length[at] += length[at + 1]
        keep = np.ones(len(start), bool)
        keep[at + 1] = False
        start, length = start[keep], length[keep]


def _matches(x: np.ndarray, at: np.ndarray, apart: np.ndarray, room: np.ndarray, step: int) -> np.ndarray:
    """How many words from ``at`` on, in direction ``step``, equal those ``apart`` further right;
    at most ``room``."""
    found, live, width = np.zeros(len(at), np.int64), np.flatnonzero(room > 0), 8
    while len(live):
        reach = np.minimum(width, room[live] - found[live])
        offset = np.arange(int(reach.max()))
        i = at[live, None] + step * np.minimum(found[live, None] + offset, room[live, None] - 1)
        differ = (x[i] != x[i + apart[live, None]]) | (offset >= reach[:, None])
        stop = np.where(differ.any(1), differ.argmax(1), reach)
        found[live] += stop
        live = live[(stop == reach) & (found[live] < room[live])]
        width = min(2 * width, max(8, CANDIDATES // max(1, len(live))))
    return found


def _squares(x: np.ndarray, left: np.ndarray, middle: np.ndarray, right: np.ndarray, forward: bool):
    """Runs (node, start, end, period) that cross ``middle`` within [left, right) and have two
    periods behind it (``forward``) or before it."""
    side = right - middle if forward else middle - left
    most = np.minimum(side // 2, (right - left) // PERIODS)
    sign = 1 if forward else -1
    zero = middle if forward else middle - 1
    lo, found = 0, []
    ends = np.cumsum(most)
    while lo < len(most):
        hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CANDIDATES, side="right")))
        n = most[lo:hi]
        node = np.repeat(np.arange(lo, hi), n)
        period = np.arange(1, len(node) + 1) - np.repeat(np.cumsum(n) - n, n)
        probe = 0
        while len(node):
            test = np.flatnonzero(period > probe)
            if not len(test):
                break
            i = zero[node[test]] + sign * probe
            same = np.ones(len(node), bool)
            same[test] = x[i] == x[i + sign * period[test]]
            node, period = node[same], period[same]
            probe = max(1, 2 * probe)
        while len(node):  # the smallest period left of each node
            head = np.diff(node, prepend=-1) != 0
            a, p = node[head], period[head]
            b, e, s = middle[a], right[a], left[a]
            if forward:
                far, back = _matches(x, b, p, e - b - p, 1), _matches(x, b - 1, p, b - s, -1)
                begin, end, reach = b - back, b + p + far, p + far
            else:
                far, back = _matches(x, b - p, p, e - b, 1), _matches(x, b - p - 1, p, b - p - s, -1)
                begin, end, reach = b - p - back, b + far, p + back
            square = reach >= 2 * p
            good = square & (begin < b) & (end > b) & (end - begin >= np.maximum(PERIODS * p, LEAST))
            found.append((a[good], begin[good], end[good], p[good]))
            skip = np.zeros(hi - lo, np.int64)  # multiples of the period as far as it reaches
            skip[a - lo] = np.where(square, reach // 2, p)
            left_over = period > skip[node - lo]
            node, period = node[left_over], period[left_over]
        lo = hi
    if not found:
        return (np.zeros(0, np.int64),) * 4
    return tuple(np.concatenate(c) for c in zip(*found))


def _merged(doc: np.ndarray, begin: np.ndarray, end: np.ndarray, period: np.ndarray):
    """Maximal intervals of each period, then the smallest period of each interval."""
    order = np.lexsort((-end, begin, period, doc))
    doc, begin, end, period = doc[order], begin[order], end[order], period[order]
    keep = np.ones(len(doc), bool)
    top, last = -1, None
    for i, (d, b, e, p) in enumerate(zip(doc.tolist(), begin.tolist(), end.tolist(), period.tolist())):
        if last == (d, p) and b <= end[top] - p:  # pieces of one run share a period at least
            end[top] = max(int(end[top]), e)
            keep[i] = False
        else:
            top, last = i, (d, p)
    doc, begin, end, period = doc[keep], begin[keep], end[keep], period[keep]
    order = np.lexsort((period, end, begin, doc))
    doc, begin, end, period = doc[order], begin[order], end[order], period[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (begin[1:] != begin[:-1]) | (end[1:] != end[:-1])
    doc, begin, end, period = doc[new], begin[new], end[new], period[new]
    order = np.lexsort((period, begin, doc))
    return doc[order], begin[order], end[order], period[order]


def find_runs(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, start, end, period) of all runs of the numbered ``words``, by document, start
    and period; positions count over all words."""
    pieces = []
    for start, middle, end, name in grammar(words, doc):
        wide = np.flatnonzero(end - start >= LEAST)
        if not len(wide):
            continue
        name, of = np.unique(name[wide], return_inverse=True)
        one = np.empty(len(name), np.int64)
        one[of[::-1]] = wide[::-1]  # an occurrence of each nonterminal: the first
        for forward in (True, False):
            node, b, e, p = _squares(words, start[one], middle[one], end[one], forward)
            if not len(node):
                continue
            moved = start[wide] - start[one][of]  # to all derivation positions
            per = np.argsort(node, kind="stable")
            has = np.bincount(node, minlength=len(name))
            first = np.cumsum(has) - has
            times = has[of]
            occurrence = np.repeat(np.arange(len(wide)), times)
            nth = np.arange(len(occurrence)) - np.repeat(np.cumsum(times) - times, times)
            run = per[first[of[occurrence]] + nth]
            shift = moved[occurrence]
            pieces.append((b[run] + shift, e[run] + shift, p[run]))
    if not pieces:
        return (np.zeros(0, np.int64),) * 4
    begin, end, period = (np.concatenate(c) for c in zip(*pieces))
    whole = np.unique(np.stack([begin, end, period]), axis=1)
    return _merged(doc[whole[0]], *whole)


def _slices(texts: Sequence[list[bytes]]) -> Iterator[tuple[int, int]]:
    lo, held = 0, 0
    for i, words in enumerate(texts):
        if held and held + len(words) > SLICE_WORDS:
            yield lo, i
            lo, held = i, 0
        held += len(words)
    if lo < len(texts):
        yield lo, len(texts)


def _analyse(texts: Sequence[list[bytes]]) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs (start, length, period) and the collapsed text of each document of a slice."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    first = np.cumsum(size) - size
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(size.sum()))
    doc, begin, end, period = find_runs(words, np.repeat(np.arange(len(texts)), size))
    out: list = [([], None) for _ in texts]
    bounds = np.searchsorted(doc, np.arange(len(texts) + 1))
    for i in np.unique(doc).tolist():
        own = slice(bounds[i], bounds[i + 1])
        b, e, p = begin[own] - first[i], end[own] - first[i], period[own]
        dropped = np.zeros(size[i] + 1, np.int64)
        np.add.at(dropped, b + p, 1)
        np.add.at(dropped, e, -1)
        kept = (np.cumsum(dropped)[:-1] == 0).tolist()
        out[i] = list(zip(b.tolist(), (e - b).tolist(), p.tolist())), b" ".join(compress(texts[i], kept))
    return [(runs, b" ".join(t) if text is None else text) for t, (runs, text) in zip(texts, out)]


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, runs (start, length and period of each, by start, then period) and
    collapsed: the words joined by single spaces, without those that any run holds after its
    first period; one row for each row of ``docs``."""
    bounded_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [(t or b"").split() for t in b.column(1).cast(pa.binary()).to_pylist()]  # ASCII white space
            for lo, hi in _slices(texts):
                runs, collapsed = zip(*_analyse(texts[lo:hi]))
                at = np.append(0, np.cumsum([len(r) for r in runs]))
                flat = np.array([r for own in runs for r in own], np.int64).reshape(-1, 3)
                every = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.StructArray.from_arrays(
                    [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], fields=list(_RUNS.value_type)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array([len(t) for t in texts[lo:hi]], pa.int64()), every,
                     pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
