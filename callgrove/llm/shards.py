"""Token-id files: blocks of an adaptive context-mixing range coder.

Ids are cut into blocks of at most BLOCK ids. Each block starts from a fresh model, has
its own checksum and can be read alone. Order-2 and order-1 tables predict the next id
from the ids before it and learn from each id. Order 0 holds the block's ids with their
frequencies, counted anew at a few growing numbers of ids, and an escape; what escapes follows
the words flat in 16 bits. Confidences, learned at fixed numbers of ids, mix the orders into
one interval of 24 bits for each id, which a 64-bit carry-less range coder writes as 32-bit
words. As the mix stays between two such numbers, a writer has the intervals of all ids there
at once. Up to 2048 blocks are coded side by side, one numpy lane each. A width that vanishes
would be an error of the coder and is one when writing, not when reading.

A file row is a segment: its documents' ids and sizes in ascending ``doc_id`` order (nulls
first, ties by the texts' hashes), and the bytes of its blocks. A block is ``CMR3``, the
numbers of ids, of words and of escaped ids and the crc32 of the ids (little-endian unsigned
32-bit each), then the words and the escaped ids. Documents never span segments; blocks may hold parts of several.

Nulls: a null text counts as empty, so its document is the end id alone; a null ``doc_id``
is kept. Texts are written whole at any length. Repeated rows are written each. An empty
table gives no rows; other columns are ignored. An id of 65536 or more, a checksum or a
length that does not fit raise ValueError.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callgrove.llm.common import code_on_workers, table
from callgrove.llm.tokens import encoder
from callgrove.plans.lineage import scratch_folder
from callgrove.plans.lookup import lookup, measured_bytes

TOKENIZER = "byte_bpe_50k.json"
END_ID = 0
MAGIC = b"CMR3"
BLOCK = 4096
#: Ids of one segment, unless a single document has more.
SEGMENT = 12_000_000
#: Bytes of text that are encoded at once.
TEXT_BYTES = 24_000_000
#: Blocks that are coded side by side at most.
_LANES = 2048
#: Slots of a table of guesses, levels of confidence, bits of the sum of order 0's frequencies.
_SLOT_BITS, _LEVELS, _BITS = 10, 3, 12
_SLOTS, _SUM = 1 << _SLOT_BITS, 1 << _BITS
#: What a reader finds in place of an id that escapes.
_ESCAPE = 1 << 16
#: Numbers of ids after which a block's order 0 is counted anew, and after which confidences are learned.
_RECOUNTS = (64, 256, 512, 1024, 2048)
_POINTS = frozenset([64, *range(128, BLOCK, 128)])
_U, _U16 = np.uint64, np.uint16
_WORD, _TOTAL = _U(1 << 32), _U(12 + _BITS)


class Model:
    """Orders 0 to 2 of many blocks side by side, one lane each; ids are below 65536.

    Orders 2 and 1 are the two rows of what concerns both. Their guesses change with each id;
    how far they are trusted, and order 0, only at points that writer and reader share.
    """

    def __init__(self, lanes: int, writing: bool):
        self.lane = np.arange(lanes)
        both = np.arange(2 * lanes).reshape(2, lanes)
        # A slot holds the last id that followed its context and, above it, 0 if none did,
        # 1 if the guess before it was wrong, 2 if it was right.
        self.slots, self.slot_base = np.zeros(2 * lanes * _SLOTS, np.int32), both * _SLOTS
        self.shares, self.level_base = np.full(2 * lanes * _LEVELS, 200, np.int32), both * _LEVELS
        self.guessed = np.zeros((2 * lanes * _LEVELS, 2), np.int64)
        # A lane's cells are the escape and its ids in order; at first it has the escape alone.
        self.cell_base, self.sum_base = self.lane, self.lane * _SUM
        # A writer looks for the cell of an id and its part of the sum, a reader for what holds a place in it.
        self.cells = np.full(lanes, _SUM, np.int32)
        self.cell_of = np.zeros(lanes * BLOCK if writing else 0, np.int16)
        self.parts = np.full(0 if writing else lanes * _SUM, _ESCAPE | _SUM << 32, np.int64)

    def recount(self, seen: np.ndarray) -> None:
        """Order 0 of the first lanes from the ids that each has seen; a writer gives their ranks."""
        k, steps = seen.shape
        ids = np.sort(seen.astype(np.uint16), axis=1)
        first = np.ones(ids.shape, bool)
        first[:, 1:] = ids[:, 1:] != ids[:, :-1]
        at = np.flatnonzero(first)
        ids, count, lane = ids.ravel()[at].astype(np.int64), np.diff(at, append=k * steps), at // steps
        kinds = np.bincount(lane, minlength=k)
        escape = np.clip(_SUM * np.bincount(lane[count == 1], minlength=k) // steps, 32, _SUM // 2)
        found = 1 + count * (_SUM - escape - kinds)[lane] // steps
        begin = np.cumsum(kinds) - kinds
        self.cell_base = begin + self.lane[:k]
        cell = np.arange(len(lane)) + lane + 1
        freq = np.empty(len(lane) + k, np.int64)
        freq[cell] = found
        freq[self.cell_base] = _SUM - np.add.reduceat(found, begin)
        cum = (np.cumsum(freq) - freq) & (_SUM - 1)
        if len(self.cell_of):
            self.cells = (cum << 16 | freq).astype(np.int32)
            # What a lane has seen once it has seen at the next count too, so no cell is left behind.
            self.cell_of[lane * BLOCK + ids] = cell - self.cell_base[lane]
        else:
            names = np.full(len(freq), _ESCAPE, np.int64)
            names[cell] = ids
            self.parts[: k * _SUM] = np.repeat(names | cum << 17 | freq << 32, freq)

    @staticmethod
    def contexts(one: np.ndarray, two: np.ndarray, base: np.ndarray) -> np.ndarray:
        """Slots of both orders after the ids ``one`` and, before it, ``two``; hashes wrap at 16 bits."""
        hashes = np.empty((2, *one.shape), np.uint16)
        np.multiply(two, _U16(0x6F4F), out=hashes[0])
        hashes[0] += one * _U16(0x9E35)
        np.multiply(one, _U16(0xA3B5), out=hashes[1])
        hashes >>= _U16(16 - _SLOT_BITS)
        return base + hashes

    @staticmethod
    def followed(guess: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which guesses were right, and what slots hold after the ids."""
        hit = guess == ids
        return hit, (hit.astype(np.int32) << 16) + (ids + (1 << 16))

    def shares_of(self, guess: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Shares of orders 2 and 1 out of 4096; the rest goes to order 0."""
        share2, share1 = self.shares.take(level)
        return share2, ((4096 - share2) * share1 >> 12) * (guess[0] != guess[1])

    def learn(self, level: np.ndarray, hit: np.ndarray, now: bool) -> None:
        """Count wrong and right guesses; where it is time, trust the orders as often as they were right, of late above all."""
        self.guessed += np.bincount((2 * level + hit).ravel(), minlength=self.guessed.size).reshape(-1, 2)
        if now:
            wrong, right = self.guessed.T
            self.shares = np.clip((self.shares * 32 + 4096 * right) // (32 + wrong + right), 1, 4000).astype(np.int32)
            self.guessed[:] = 0


def _spans(sizes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """From, to and the number of lanes at work, which stays between the two; sizes descend.

    Lanes learn at the same numbers of ids whichever others end before, so that each block can be read alone.
    """
    points = sorted({*(p for p in _POINTS if p < sizes[0]), 0, *sizes.tolist()})
    for start, stop in zip(points, points[1:]):  # noqa: B905
        yield start, stop, int(np.searchsorted(-sizes, -stop, side="right"))


def _settled(low: np.ndarray, width: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lanes that give off a word, and the widths that all lanes then have.

    A lane gives off its high word once all of its interval shares it, or the interval is
    cut so that it does. What is kept has to fit the low word, so it is less than 2^32 wide.
    """
    same = (low ^ (low + width - _U(1))) >> _U(32) == 0
    small = width < _WORD
    width = np.where(small & ~same, (~low + _U(1)) & (_WORD - _U(1)), width)
    out = same | small
    width = np.where(out, np.minimum(width, _WORD - _U(1)) << _U(32), width)
    if not width.all():
        raise ValueError("an interval of the coder is empty")
    return out, width


def _narrow(low: np.ndarray, width: np.ndarray, unit: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple:
    """Move each interval to its part; the lanes that give off a word, and those words.

    Wider intervals than a word cannot lie in one high word, so only the others are settled.
    """
    low += unit * start
    np.multiply(unit, size, out=width)
    near = (width <= _WORD).nonzero()[0]
    ends = low.take(near)
    out, span = _settled(ends, width.take(near))
    width[near] = span
    if not out.all():
        near, ends = near[out], ends[out]
    low[near] = ends << _U(32)
    return near, ends >> _U(32)


def _by_lanes(sizes: list[int]) -> list[np.ndarray]:
    """Numbers of blocks that are coded side by side, longest first, in even groups."""
    order = np.argsort(-np.array(sizes, np.int64), kind="stable")
    return np.array_split(order, -(-len(order) // _LANES)) if sizes else []


def encode_blocks(blocks: list[np.ndarray]) -> list[bytes]:
    """Bytes of each block of ids, header and checksum included."""
    if any(len(b) and int(b.max()) > 0xFFFF for b in blocks):
        raise ValueError("ids of 65536 and more cannot be written")
    if any(len(b) > BLOCK for b in blocks):
        raise ValueError(f"a block has at most {BLOCK} ids")
    out: list[bytes] = [b""] * len(blocks)
    for group in _by_lanes([len(b) for b in blocks]):
        for i, data in zip(group, _encode_lanes([blocks[i] for i in group]), strict=True):
            out[i] = data
    return out


def _ranks(ids: np.ndarray) -> np.ndarray:
    """Rank of each id among the distinct ids of its row."""
    out = np.empty_like(ids)
    # A few rows at a time stay near the processor.
    for start in range(0, len(ids), 64):
        rows = ids[start : start + 64]
        keys = rows.astype(np.uint32) << np.uint32(16) | np.arange(rows.shape[1], dtype=np.uint32)
        keys.sort(axis=1)
        named = keys >> np.uint32(16)
        ranks = np.zeros(rows.shape, np.uint16)
        np.cumsum(named[:, 1:] != named[:, :-1], axis=1, out=ranks[:, 1:])
        np.put_along_axis(out[start : start + 64], (keys & np.uint32(0xFFFF)).astype(np.int64), ranks, axis=1)
    return out


def _encode_lanes(blocks: list[np.ndarray]) -> Iterator[bytes]:
    """Bytes of blocks of descending sizes."""
    lanes, sizes = len(blocks), np.array([len(b) for b in blocks], np.int64)
    steps = int(sizes[0])
    by_lane = np.zeros((lanes, steps), np.uint16)
    for row, block in zip(by_lane, blocks, strict=True):
        row[: len(block)] = block
    # Two rows of zeros stand before the first step.
    ids = np.concatenate([np.zeros((2, lanes), np.uint16), by_lane.T])
    by_lane = _ranks(by_lane)
    model = Model(lanes, True)
    low, width = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    words, first = np.zeros(lanes * (steps + 4), np.uint32), model.lane * (steps + 4)
    used = first.copy()
    escapes: list[tuple[np.ndarray, np.ndarray]] = [(np.zeros(0, np.int64), np.zeros(0, np.int32))]
    for begin, end, k in _spans(sizes):
        if begin in _RECOUNTS:
            model.recount(by_lane[:k, :begin])
        x = ids[begin + 2 : end + 2, :k].astype(np.int32)
        places = model.contexts(ids[begin + 1 : end + 1, :k], ids[begin:end, :k], model.slot_base[:, None, :k])
        slot, hit = np.empty(places.shape, np.int32), np.empty(places.shape, bool)
        for row in range(end - begin):
            at = places[:, row]
            slot[:, row] = found = model.slots.take(at)
            hit[:, row], model.slots[at] = model.followed(found & 0xFFFF, x[row])
        guess, level = slot & 0xFFFF, model.level_base[:, None, :k] + (slot >> 16)
        share2, share1 = model.shares_of(guess, level)
        rank = model.cell_of.take(model.lane[:k, None] * BLOCK + by_lane[:k, begin:end])
        cell = model.cells.take(model.cell_base[:k, None] + rank).T
        rest = 4096 - share2 - share1
        start = (share2 + share1 << _BITS) + rest * (cell >> 16)
        size = rest * (cell & 0xFFFF)
        in2, in1 = hit[0], hit[1] & (share1 > 0)
        share2 <<= _BITS
        np.copyto(start, share2, where=in1)
        np.copyto(size, share1 << _BITS, where=in1)
        np.copyto(start, 0, where=in2)
        np.copyto(size, share2, where=in2)
        step, lane = np.nonzero((rank == 0).T & ~(in1 | in2))
        escapes.append((lane, x[step, lane]))
        starts, parts = start.astype(_U), size.astype(_U)
        for row in range(end - begin):
            near, high = _narrow(low[:k], width[:k], width[:k] >> _TOTAL, starts[row], parts[row])
            at = used[near]
            words[at] = high
            used[near] = at + 1
        model.learn(level, hit, end in _POINTS)
    for shift in (32, 0):
        words[used] = low >> _U(shift) & _U(0xFFFFFFFF)
        used += 1
    lane, names = (np.concatenate(part) for part in zip(*escapes, strict=True))
    names = names[np.argsort(lane.astype(np.int16), kind="stable")].astype("<u2")
    ends = np.cumsum(np.bincount(lane, minlength=lanes))
    for lane, block in enumerate(blocks):
        own, coded = names[ends[lane - 1] if lane else 0 : ends[lane]], words[first[lane] : used[lane]]
        crc = zlib.crc32(block.astype("<u4").tobytes())
        head = np.array([len(block), len(coded), len(own), crc], "<u4")
        yield MAGIC + head.tobytes() + coded.astype("<u4").tobytes() + own.tobytes()


def decode_blocks(data: bytes) -> list[np.ndarray]:
    """Ids of the blocks that ``data`` holds one after the other, checked."""
    heads, bodies, at = [], [], 0
    while at < len(data):
        if data[at : at + 4] != MAGIC or at + 20 > len(data):
            raise ValueError("not a block")
        n, length, escapes, crc = (int(v) for v in np.frombuffer(data, "<u4", 4, at + 4))
        if n > BLOCK:
            raise ValueError(f"a block has at most {BLOCK} ids")
        at += 20
        if at + 4 * length + 2 * escapes > len(data):
            raise ValueError("block is cut short")
        heads.append((n, crc))
        bodies.append((np.frombuffer(data, "<u4", length, at), np.frombuffer(data, "<u2", escapes, at + 4 * length)))
        at += 4 * length + 2 * escapes
    out: list[np.ndarray] = [np.zeros(0, np.int64)] * len(heads)
    for group in _by_lanes([n for n, _ in heads]):
        for i, ids in zip(group, _decode_lanes([heads[i][0] for i in group], [bodies[i] for i in group]), strict=True):
            if zlib.crc32(ids.astype("<u4").tobytes()) != heads[i][1]:
                raise ValueError("checksum of a block does not fit")
            out[i] = ids
    return out


def _side_by_side(rows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All rows, two zeros behind each, and where each begins."""
    zeros = np.zeros(2, rows[0].dtype)
    ends = np.cumsum([len(row) + 2 for row in rows])
    return np.concatenate([part for row in rows for part in (row, zeros)]), np.append(0, ends[:-1])


def _decode_lanes(counts: list[int], bodies: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray]:
    """Ids of blocks of descending sizes from their words and escaped ids.

    Damaged words may ask for more than a lane has; they get what lies behind, or the last.
    """
    lanes, sizes = len(counts), np.array(counts, np.int64)
    words, used = _side_by_side([words for words, _ in bodies])
    flat, flat_used = _side_by_side([escapes for _, escapes in bodies])
    ids = np.zeros((int(sizes[0]) + 2, lanes), np.uint16)
    model = Model(lanes, False)
    low, width = np.zeros(lanes, _U), np.full(lanes, 0xFFFFFFFFFFFFFFFF, _U)
    code = words[used].astype(_U) << _U(32) | words[used + 1]
    used += 2
    most = _U((1 << int(_TOTAL)) - 1)
    for begin, end, k in _spans(sizes):
        if begin in _RECOUNTS:
            model.recount(ids[2 : begin + 2, :k].T)
        low, width, code = low[:k], width[:k], code[:k]
        slot_base, level_base, sum_base = model.slot_base[:, :k], model.level_base[:, :k], model.sum_base[:k]
        levels, hits = np.empty((end - begin, 2, k), np.int64), np.empty((end - begin, 2, k), bool)
        for step in range(begin, end):
            places = model.contexts(ids[step + 1, :k], ids[step, :k], slot_base)
            slot = model.slots.take(places)
            guess, level = slot & 0xFFFF, np.add(level_base, slot >> 16, out=levels[step - begin])
            share2, share1 = model.shares_of(guess, level)
            rest = 4096 - share2
            rest -= share1
            end2 = share2 << _BITS
            end1 = end2 + (share1 << _BITS)
            unit = width >> _TOTAL
            value = np.minimum((code - low) // unit, most).view(np.int64)
            over = value - end1
            # Exact in doubles: the quotient of numbers this small is never rounded to the next.
            inner = (np.maximum(over, 0) / rest).astype(np.int64)
            inner += sum_base
            part = model.parts.take(inner)
            x = (part & 0x1FFFF).astype(np.int32)
            size = (part >> 32) * rest
            part >>= 17
            part &= _SUM - 1
            part *= rest
            part += end1
            hit = (over < 0).nonzero()[0]
            if len(hit):
                by2, by1 = end2.take(hit), end1.take(hit)
                in2 = value.take(hit) < by2
                x[hit] = np.where(in2, guess[0].take(hit), guess[1].take(hit))
                part[hit] = np.where(in2, 0, by2)
                size[hit] = np.where(in2, by2, by1 - by2)
            escaped = (x == _ESCAPE).nonzero()[0]
            if len(escaped):
                at = flat_used.take(escaped)
                x[escaped] = flat.take(at, mode="clip")
                flat_used[escaped] = at + 1
            ids[step + 2, :k] = x
            hits[step - begin], model.slots[places] = model.followed(guess, x)
            near, _ = _narrow(low, width, unit, part.view(_U), size.view(_U))
            at = used.take(near)
            code[near] = code.take(near) << _U(32) | words.take(at, mode="clip")
            used[near] = at + 1
        model.learn(levels, hits, end in _POINTS)
    return (ids[2 : n + 2, lane].astype(np.int64) for lane, n in enumerate(counts))


def encode_ids(ids: np.ndarray) -> bytes:
    return b"".join(encode_blocks([ids[i : i + BLOCK] for i in range(0, len(ids), BLOCK)]))


def decode_ids(data: bytes) -> np.ndarray:
    blocks = decode_blocks(data)
    return np.concatenate(blocks) if blocks else np.zeros(0, np.int64)


def _by_bytes(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about TEXT_BYTES of text, or a longer one alone."""
    lengths = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy().astype(np.int64)
    cuts = (np.flatnonzero(np.diff(np.cumsum(lengths) // TEXT_BYTES)) + 1).tolist()
    for start, stop in zip([0, *cuts], [*cuts, batch.num_rows]):  # noqa: B905
        yield batch.slice(start, stop - start)


def segments(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, shard: int) -> Iterator[pa.RecordBatch]:
    """Rows of one file: whole documents of at most SEGMENT ids together, or a longer one alone."""
    units, end = encoder(tokenizer), np.array([end_id], "<u4")
    names, sizes, parts, total, segment = [], [], [], 0, 0

    def closed() -> pa.RecordBatch:
        lists = [
            pa.ListArray.from_arrays(pa.array([0, sum(map(len, part))], pa.int32()), pa.concat_arrays(part))
            for part in (names, sizes)
        ]
        coded = pa.array([encode_ids(np.concatenate(parts))], pa.binary())
        columns = [pa.array([shard], pa.int32()), pa.array([segment], pa.int32()), *lists, coded]
        return pa.RecordBatch.from_arrays(columns, ["shard", "segment", "doc_ids", "sizes", "blocks"])

    for batch in (part for batch in batches for part in _by_bytes(batch)):
        ids, counts = units.flat(batch.column("text"))
        ends = np.cumsum(counts)
        ids, counts = np.insert(ids, ends, end), counts + 1
        ends += np.arange(1, len(ends) + 1)
        done = 0
        while done < len(counts):
            before = ends[done] - counts[done]
            fits = int(np.searchsorted(ends, before + SEGMENT - total, side="right"))
            stop = fits if total else max(fits, done + 1)
            if stop > done:
                names.append(batch.column("doc_id")[done:stop])
                sizes.append(pa.array(counts[done:stop]))
                parts.append(ids[before : ends[stop - 1]])
                total += len(parts[-1])
            if stop < len(counts):
                yield closed()
                names, sizes, parts, total, segment = [], [], [], 0, segment + 1
            done = stop
    if names:
        yield closed()


def write_shards(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID) -> None:
    """Write all documents in ascending ``doc_id`` order as files under ``path``."""
    code_on_workers(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return segments(batches, tokenizer, end_id, TaskContext.get().partitionId())

    # The last key only spreads rows that are equal in the others, so that no id fills a task.
    keys = ["doc_id", F.xxhash64(F.coalesce("text", F.lit("")))]
    rows = docs.select("doc_id", "text").repartitionByRange(*keys, F.monotonically_increasing_id())
    rows.sortWithinPartitions(*keys).mapInArrow(
        run, f"shard int, segment int, doc_ids array<{kind}>, sizes array<long>, blocks binary"
    ).write.option("compression", "none").parquet(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, ids) of every document, ids as little-endian unsigned 32-bit."""
    code_on_workers(spark)
    files = spark.read.parquet(path)
    sizes = files.select("shard", "segment", F.aggregate("sizes", F.lit(0).cast("long"), lambda n, x: n + x).alias("n"))
    inside = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each file, so the running sum over files is small.
    shards = sizes.groupBy("shard").agg(F.sum("n").alias("n")).select(
        "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_shard_base")
    )
    bases = sizes.withColumn("_in", F.coalesce(F.sum("n").over(inside), F.lit(0))).join(shards, "shard").select(
        "shard", "segment", (F.col("_in") + F.col("_shard_base")).alias("base")
    )
    rows = lookup(
        files, bases, ["shard", "segment"], table_bytes=measured_bytes(files, 48), spread=["segment"]
    )
    kind = files.schema["doc_ids"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids = decode_ids(batch.column("blocks")[row].as_py()).astype("<u4")
                counts = batch.column("sizes")[row].values.to_numpy()
                if counts.sum() != len(ids):
                    raise ValueError("a segment does not hold its documents' ids")
                ends = np.cumsum(counts)
                names = batch.column("doc_ids")[row].values
                starts = batch.column("base")[row].as_py() + ends - counts
                for at in range(0, len(counts), 512):
                    part = slice(at, at + 512)
                    texts = [ids[e - n : e].tobytes() for e, n in zip(ends[part], counts[part], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [names[part], pa.array(starts[part]), pa.array(texts, pa.binary())], ["doc_id", "start", "ids"]
                    )

    return rows.select("doc_ids", "sizes", "blocks", "base").mapInArrow(run, f"doc_id {kind}, start long, ids binary")


def op10_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "llm")
    write_shards(table(spark, sf_dir, "documents"), path)
    read = read_shards(spark, path)
    return read.select(
        "doc_id",
        "start",
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
