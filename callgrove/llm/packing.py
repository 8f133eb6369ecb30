"""Packing documents into windows by non-negative least squares.

Every document is its ids and an end id. Whole windows are cut off first; what is left has
a length below the window. Shallow combinations of lengths that fill a window exactly are
enumerated, their repeat counts fitted to the histogram of lengths by non-negative least
squares, rounded and clipped to the supply. The residual documents are packed greedily one
after the other, by descending length, and cut where a window ends; the last rest goes to
windows of power-of-two lengths, so no id is padding.

Each task packs its own documents, in chunks of ``CHUNK`` ids with a plan each. So nothing
is shuffled, sent to the driver or kept beyond a chunk, and a task that runs again gives the
same sequences. A chunk ends in at most one window less than full, cut at powers of two.

Nulls: a null text counts as empty and gives its end id alone; a null ``doc_id`` stays
null. Repeated rows are packed each. Texts are packed whole at any length. An empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from callgrove.llm.common import code_on_workers, in_batches, table
from callgrove.llm.tokens import encoder

WINDOW = 4096
TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Ids that a task holds and packs together.
CHUNK = 1 << 23
#: Lengths that may be the middle member of a combination of three.
MIDDLES = 16


def combinations(lengths: np.ndarray, counts: np.ndarray, window: int) -> np.ndarray:
    """Rows (a, b, c), a >= b >= c, that sum to the window; c is 0 for two members."""
    present = np.zeros(window + 1, bool)
    present[lengths] = True
    a = lengths[(2 * lengths >= window) & present[window - lengths]]
    found = [np.column_stack([a, window - a, np.zeros_like(a)])]
    for middle in lengths[np.argsort(-counts, kind="stable")[:MIDDLES]]:
        last = window - middle - lengths
        ok = (last > 0) & present[np.maximum(last, 0)]
        three = np.column_stack([lengths[ok], np.full(ok.sum(), middle), last[ok]])
        found.append(-np.sort(-three, axis=1))
    return np.unique(np.concatenate(found), axis=0)


def least_squares(members: np.ndarray, target: np.ndarray, steps: int = 200) -> np.ndarray:
    """Non-negative repeat counts whose use of each length is nearest to ``target``.

    Accelerated projected gradient; column j of the matrix counts the members of
    combination j, length 0 is free.
    """
    size = len(target)

    def use(x: np.ndarray) -> np.ndarray:
        out = sum(np.bincount(members[:, k], x, size) for k in range(members.shape[1]))
        out[0] = 0
        return out

    def back(r: np.ndarray) -> np.ndarray:
        r = r.copy()
        r[0] = 0
        return r[members].sum(axis=1)

    probe = np.ones(len(members))
    for _ in range(20):
        probe = back(use(probe))
        norm = np.linalg.norm(probe)
        probe /= norm
    x = y = np.zeros(len(members))
    t = 1.0
    for _ in range(steps):
        following = np.maximum(0, y - back(use(y) - target) / norm)
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = following + (t - 1) / t_next * (following - x)
        x, t = following, t_next
    return x


@dataclass(frozen=True)
class Plan:
    """Intervals of ranks for each length, sorted by (length, first rank).

    ``kind`` 0: members of repeated combinations; 1: residual, ``base`` its stream position.
    """

    window: int
    length: np.ndarray
    first: np.ndarray
    each: np.ndarray
    base: np.ndarray
    offset: np.ndarray
    kind: np.ndarray
    combined: int
    stream: int

    def tail(self) -> np.ndarray:
        """Ends of the stream's sequences after its last whole window."""
        rest, at, ends = self.stream % self.window, self.stream // self.window * self.window, []
        for bit in range(self.window.bit_length(), -1, -1):
            if rest >> bit & 1:
                at += 1 << bit
                ends.append(at)
        return np.array(ends, np.int64)

    def sequences(self) -> int:
        return self.combined + self.stream // self.window + len(self.tail())


def plan_for(histogram: dict[int, int], window: int = WINDOW) -> Plan:
    """Plan of all rests; ``histogram`` has the number of documents by length."""
    lengths = np.array(sorted(length for length in histogram if 0 < length < window), np.int64)
    left = np.zeros(window + 1, np.int64)
    for length in lengths:
        left[length] = histogram[int(length)]
    used = np.zeros(window + 1, np.int64)
    intervals: list[tuple] = []
    sequences = 0
    if len(lengths):
        members = combinations(lengths, left[lengths], window)
        if len(members):
            repeats = np.rint(least_squares(members, left.astype(float))).astype(np.int64)
            for j in np.argsort(-repeats, kind="stable"):
                if repeats[j] <= 0:
                    break
                need = Counter(int(v) for v in members[j] if v)
                times = min(int(repeats[j]), *(int(left[v]) // k for v, k in need.items()))
                if times <= 0:
                    continue
                offset = 0
                for v, k in sorted(need.items(), reverse=True):
                    intervals.append((v, used[v], k, sequences, offset, 0))
                    used[v] += k * times
                    left[v] -= k * times
                    offset += k * v
                sequences += times
    stream = 0
    for length in lengths[::-1]:
        if left[length]:
            intervals.append((length, used[length], 1, stream, 0, 1))
            stream += int(left[length]) * int(length)
    intervals.sort(key=lambda r: (r[0], r[1]))
    columns = np.array(intervals, np.int64).reshape(-1, 6).T
    return Plan(window, *columns, combined=sequences, stream=stream)


Piece = tuple[int, int, int, int]


def pieces_of(plan: Plan, n: int, rank: int, whole: int) -> list[Piece]:
    """(start, length, sequence, offset) of a document's pieces, in order.

    ``rank`` counts the documents before it with a rest of the same length, ``whole`` is the
    sequence of its first whole window.
    """
    window = plan.window
    rest = n % window
    out = [(k * window, window, whole + k, 0) for k in range(n // window)]
    if not rest:
        return out
    low = np.searchsorted(plan.length, rest)
    high = np.searchsorted(plan.length, rest, side="right")
    i = low + np.searchsorted(plan.first[low:high], rank, side="right") - 1
    start, nth = n - rest, rank - int(plan.first[i])
    if plan.kind[i] == 0:
        each = int(plan.each[i])
        out.append((start, rest, int(plan.base[i]) + nth // each, int(plan.offset[i]) + nth % each * rest))
        return out
    at, stop = int(plan.base[i]) + nth * rest, int(plan.base[i]) + (nth + 1) * rest
    ends, whole_end = plan.tail(), plan.stream // window * window
    while at < stop:
        if at < whole_end:
            number, begin, end = at // window, at // window * window, (at // window + 1) * window
        else:
            j = int(np.searchsorted(ends, at, side="right"))
            number, begin, end = whole_end // window + j, whole_end if j == 0 else int(ends[j - 1]), int(ends[j])
        taken = min(stop, end) - at
        out.append((start, taken, plan.combined + number, at - begin))
        start, at = start + taken, at + taken
    return out


def packed_chunk(sizes: list[int], window: int = WINDOW) -> tuple[list[list[Piece]], int]:
    """Pieces of documents of the given sizes, and the number of sequences they fill."""
    plan = plan_for(Counter(n % window for n in sizes), window)
    whole, seen, out = plan.sequences(), Counter(), []
    for n in sizes:
        out.append(pieces_of(plan, n, seen[n % window], whole))
        seen[n % window] += 1
        whole += n // window
    return out, whole


def packed(
    docs: DataFrame,
    tokenizer: str = TOKENIZER,
    end_id: int = END_ID,
    window: int = WINDOW,
    with_ids: bool = True,
    chunk: int = CHUNK,
) -> DataFrame:
    """One row for each piece, with its ids (little-endian unsigned 32-bit) if ``with_ids``."""
    code_on_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "start", "length", "sequence_id", "offset", "ids_crc32", "doc_tokens"] + ["ids"] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, end = encoder(tokenizer), np.array([end_id], "<u4").tobytes()
        # Sequences of different tasks have different ids.
        sequence = TaskContext.get().partitionId() << 36
        parts: list[pa.Array] = []
        texts: list[bytes] = []
        held = 0

        def closed() -> Iterator[pa.RecordBatch]:
            nonlocal sequence
            names_of = pa.concat_arrays(parts)
            pieces, filled = packed_chunk([len(t) // 4 for t in texts], window)
            for first in range(0, len(texts), 512):
                rows = [(k, piece) for k in range(first, min(first + 512, len(texts))) for piece in pieces[k]]
                own = [texts[k][4 * p[0] : 4 * (p[0] + p[1])] for k, p in rows]
                columns = np.array([p for _, p in rows], np.int64).reshape(-1, 4)
                yield pa.RecordBatch.from_arrays(
                    [
                        names_of.take(pa.array([k for k, _ in rows], pa.int64())),
                        pa.array(columns[:, 0]), pa.array(columns[:, 1]), pa.array(columns[:, 2] + sequence),
                        pa.array(columns[:, 3]), pa.array([zlib.crc32(ids) for ids in own], pa.int64()),
                        pa.array([len(texts[k]) // 4 for k, _ in rows], pa.int64()),
                        *([pa.array(own, pa.binary())] if with_ids else []),
                    ],
                    names,
                )
            sequence += filled

        for batch in batches:
            for part in in_batches(batch, 64):
                found = units.many([text or "" for text in part.column("text").to_pylist()])
                parts.append(part.column("doc_id"))
                texts += [ids + end for ids in found]
                held += sum(map(len, found)) // 4 + len(found)
                if held >= chunk:
                    yield from closed()
                    parts, texts, held = [], [], 0
        if texts:
            yield from closed()

    return docs.select("doc_id", "text").mapInArrow(
        run,
        f"doc_id {kind}, start long, length long, sequence_id long, offset long, ids_crc32 long,"
        " doc_tokens long" + ", ids binary" * with_ids,
    )


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"), with_ids=False)
