"""SimHash near-duplicates by Golay-code fuzzy hashing.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits, the last one padded with
zeros. The binary Golay code is perfect: every 23-bit word decodes to exactly one of 4096
codewords, the one within three bits. If two segments differ in at most one bit, the
codeword of one is among the codewords of the other and of its single-bit neighbours.
With at most three differing bits in all, at least two of the three segments differ in
at most one bit each (two segments with two or more would make four). So every link
shares, for some pair of segments, a key of two codeword indices, where one side gives
its own codewords and the other side all neighbouring ones. Candidates are verified.

Keys with very many members are not joined: the fingerprints under them meet in balls
instead. Two fingerprints differ in at most three bits exactly when some word is within
one bit of the first and two bits of the second, so each announces the words of its
radius-2 ball, and all that reach a word link to one that lies within one bit of it. That
gives stars, a fixed number of rows for each fingerprint, whatever the group's size, and
keeps every link's two ends connected.

Nulls: a null text counts as empty, and a text without words has fingerprint zero. Rows
of equal text share a fingerprint, however often they occur. Rows without ``doc_id`` take
part; where a whole component has none, its ``component_id`` is null. Other columns are
ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from callgrove.llm.common import stored, table
from callgrove.llm.components import connected_components
from callgrove.plans.lineage import cut

#: The SimHash contract's hash seed, and the generator x^11 + x^9 + x^7 +
#: x^6 + x^5 + x + 1 of the binary Golay code.
SEED = 42
GENERATOR = 0b101011100011

MAX_BITS = 3
SHINGLE = 3
SEGMENTS = ((0, 23), (23, 23), (46, 18))
PAIRS = ((0, 1), (0, 2), (1, 2))

#: A key with more own-codeword members than this is resolved by balls, not by a join.
HOT_MEMBERS = 1000


def fingerprint_of(text: str | None, shingle: int = SHINGLE) -> int:
    """Unsigned 64-bit SimHash of the word shingles of a text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    hashes = np.fromiter((xxhash.xxh64_intdigest(s, SEED) for s in shingles), np.uint64)
    set_bits = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 15):
        part = hashes[start : start + (1 << 15)]
        bits = np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.uint32)
    majority = np.packbits(2 * set_bits > len(hashes), bitorder="little")
    return int(majority.view(np.uint64)[0])


def text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed long with the same bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint_of(text.as_py()) for text in batch.column("text")]
            values = np.array(prints, np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(values)], ["doc_id", "text_hash", "fp"]
            )

    rows = docs.select("doc_id", text_hash().alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {_type(docs, 'doc_id')}, text_hash long, fp long")


def _type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


@lru_cache(1)
def codewords() -> np.ndarray:
    """Index of the nearest Golay codeword of every 23-bit word."""

    def syndrome(words: np.ndarray) -> np.ndarray:
        words = words.copy()
        for bit in range(22, 10, -1):
            words ^= np.where(words >> bit & 1, GENERATOR << (bit - 11), 0).astype(words.dtype)
        return words

    errors = np.zeros(2048, np.int32)
    singles = [0, *(1 << i for i in range(23))]
    for a in singles:
        for b in singles:
            for c in singles:
                if (a <= b <= c) and (a != b or a == 0) and (b != c or b == 0):
                    errors[syndrome(np.array([a | b | c], np.int32))[0]] = a | b | c
    words = np.arange(1 << 23, dtype=np.int32)
    return ((words ^ errors[syndrome(words)]) >> 11).astype(np.int16)


def golay_keys(prints: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each segment: own codeword, and the distinct codewords within one bit (-1: none)."""
    table_ = codewords()
    own, near = [], []
    for first, width in SEGMENTS:
        segment = (prints >> np.uint64(first) & np.uint64((1 << width) - 1)).astype(np.int64)
        flips = np.array([0, *(1 << i for i in range(width))], np.int64)
        found = np.sort(table_[segment[:, None] ^ flips].astype(np.int64), axis=1)
        found[:, 1:][found[:, 1:] == found[:, :-1]] = -1
        own.append(table_[segment].astype(np.int64))
        near.append(found)
    return own, near


def keys(prints: DataFrame) -> DataFrame:
    """(key, fp, own): the key of every segment pair, of own and of neighbouring codewords."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("fp").to_numpy(zero_copy_only=False)
            for start in range(0, len(signed), 4096):
                part = signed[start : start + 4096]
                own, near = golay_keys(part.view(np.uint64))
                out_key, out_fp, out_own = [], [], []
                for number, (x, y) in enumerate(PAIRS):
                    out_key.append((number << 24) | (own[x] << 12) | own[y])
                    out_fp.append(part)
                    out_own.append(np.ones(len(part), bool))
                    there = (near[x][:, :, None] >= 0) & (near[y][:, None, :] >= 0)
                    rows, i, j = np.nonzero(there)
                    out_key.append((number << 24) | (near[x][rows, i] << 12) | near[y][rows, j])
                    out_fp.append(part[rows])
                    out_own.append(np.zeros(len(rows), bool))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate(out_key).astype(np.int32)),
                        pa.array(np.concatenate(out_fp)),
                        pa.array(np.concatenate(out_own)),
                    ],
                    ["key", "fp", "own"],
                )

    return prints.select("fp").mapInArrow(run, "key int, fp long, own boolean")


def balls(prints: DataFrame) -> DataFrame:
    """(word, fp, one): all words within two bits of each fingerprint, ``one`` if within one.

    A column ``seed`` of ``prints`` is carried along.
    """
    seeded = "seed" in prints.columns
    bits = [1 << i for i in range(64)]
    ones = np.array([0, *bits], np.uint64)
    twos = np.array([a | b for k, a in enumerate(bits) for b in bits[k + 1 :]], np.uint64)
    flips = np.concatenate([ones, twos])
    inner = np.arange(len(flips)) < len(ones)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            signed = batch.column("fp").to_numpy(zero_copy_only=False)
            for start in range(0, len(signed), 64):
                part = signed[start : start + 64]
                words = part.view(np.uint64)[:, None] ^ flips
                columns = [
                    pa.array(words.ravel().view(np.int64)),
                    pa.array(np.repeat(part, len(flips))),
                    pa.array(np.tile(inner, len(part))),
                ]
                names = ["word", "fp", "one"]
                if seeded:
                    seeds = batch.column("seed").to_numpy(zero_copy_only=False)[start : start + 64]
                    columns.append(pa.array(np.repeat(seeds, len(flips)).astype(np.int32)))
                    names.append("seed")
                yield pa.RecordBatch.from_arrays(columns, names)

    kind = "word long, fp long, one boolean" + ", seed int" * seeded
    return prints.select("fp", *["seed"] * seeded).mapInArrow(run, kind)


def links(prints: DataFrame, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """(u, v) of distinct fingerprints (fp) whose components are those of all links."""
    keyed = stored(keys(prints))
    crowded = cut(
        keyed.groupBy("key").agg(F.count_if("own").alias("n")).where(F.col("n") > hot_members).select("key")
    )
    # A crowded key has over hot_members of 3 own keys for each fingerprint, so these are few.
    marked = keyed.join(crowded, "key", "left_anti")
    own = marked.where("own").select("key", F.col("fp").alias("u"))
    near = marked.where("not own").select("key", F.col("fp").alias("v"))
    joined = own.join(near, "key").where(
        (F.col("u") != F.col("v")) & (F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= MAX_BITS)
    )
    found = joined.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    if crowded.isEmpty():
        return found
    dense = keyed.join(crowded, "key", "left_semi").select("fp").distinct()
    ball = balls(dense)
    hubs = ball.groupBy("word").agg(
        F.min(F.when(F.col("one"), F.col("fp"))).alias("hub"), F.collect_set("fp").alias("fps")
    )
    spokes = (
        hubs.where("hub is not null and size(fps) > 1")
        .select("hub", F.explode("fps").alias("fp"))
        .where("hub <> fp")
        .select(F.greatest("hub", "fp").alias("u"), F.least("hub", "fp").alias("v"))
    )
    return found.unionByName(spokes)


def _classed(docs: DataFrame, hot_members: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text_hash, fp) of every row, and (fp, root, component_id) of every fingerprint."""
    prints = stored(fingerprints(docs))
    distinct = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(links(distinct, hot_members)).withColumnRenamed("node", "fp")
    classed = cut(distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp")))
    named = classed.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return prints, classed.join(named, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``."""
    prints, classes = _classed(docs, hot_members)
    return prints.join(classes, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, rooted: DataFrame) -> DataFrame:
    """Rows of ``docs`` with one of each group; ``rooted`` is (doc_id, text_hash, root) by row.

    The smallest id stays. Where it is on several rows, or the whole group has none, the row
    whose text has the smallest hash stays; rows equal in both count once.
    """
    # Nulls sort last: a row without an id stays only if its group has no other.
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    picks = cut(
        rooted.groupBy("root").agg(F.min(rank).alias("r"))
        .select(F.col("r.doc_id").alias("_id"), F.col("r.text_hash").alias("_hash"))
    )
    several = cut(
        rooted.groupBy("doc_id", "text_hash").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"))
    )

    def of(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        same = rows["doc_id"].eqNullSafe(keys["_id"]) & (F.xxhash64(F.coalesce(rows["text"], F.lit(""))) == keys["_hash"])
        return rows.join(keys, same, how)

    kept = of(docs, picks, "left_semi")
    if several.isEmpty():
        return kept
    whole = of(kept, several, "left_semi")
    once = whole.groupBy(whole["doc_id"].alias("_k"), text_hash().alias("_h")).agg(
        F.min(F.struct(*docs.columns)).alias("_r")
    )
    once = once.select(*(F.col("_r")[name].alias(name) for name in docs.columns))
    return of(kept, several, "left_anti").unionByName(once)


def one_of_each(docs: DataFrame, hot_members: int = HOT_MEMBERS) -> DataFrame:
    """Rows of ``docs`` with one document of each group: that of :func:`keep_one`."""
    prints, classes = _classed(docs, hot_members)
    return keep_one(docs, prints.join(classes.select("fp", "root"), "fp"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
