"""Order MinHash fingerprints, with Spark expressions only.

The words of a text give k-mers; a k-mer that occurs again gets the number of its
occurrence, so every element of the multiset is distinct. Each element is hashed; its hash
also deals it to one of TUPLES x PICK bins, and each bin keeps its minimal element (one
permutation, dealt to bins, stands for that many independent ones). The PICK minima of
neighbouring bins form a tuple: they are put back into text order and hashed together, so
a tuple changes when its k-mers change or swap their order. An empty bin takes the minimum
of the next filled bin. Two fingerprints are as alike as the share of equal tuples.

Nulls: a null text counts as empty. A text without words has the empty fingerprint; two of
them are alike (1), one against a filled one is not (0). A text of fewer words than a k-mer
is one k-mer. Rows are ordered by descending ``doc_id``, nulls last, ties by text; each
row's next one follows in that order, after the last comes the first. Repeated rows stay.
An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from callgrove.llm.common import table, words_of

K = 2
TUPLES = 32
PICK = 2
#: Ids of one block of neighbouring ids, where that makes at most MAX_BLOCKS blocks.
BLOCK_IDS = 1024
MAX_BLOCKS = 1 << 16


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def elements(words: Column, k: int = K) -> Column:
    """Structs (h, pos) of the occurrence-numbered k-mers of a word array."""

    def kmers(w: Column) -> Column:
        spans = F.sequence(F.lit(0), F.greatest(F.size(w) - k, F.lit(0)))
        return F.transform(spans, lambda i: F.struct(
            F.xxhash64(*(F.get(w, i + j) for j in range(k))).alias("h"), i.alias("pos")
        ))

    def numbered(s: Column) -> Column:
        runs = F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == 0) | (F.get(s, i)["h"] != F.get(s, i - 1)["h"]),
        )
        numbers = _let(
            runs,
            lambda r: F.flatten(F.transform(
                r, lambda x, j: F.sequence(F.lit(0), F.coalesce(F.get(r, j + 1), F.size(s)) - x - 1)
            )),
        )
        return F.zip_with(
            s, numbers, lambda e, n: F.struct(F.xxhash64(e["h"], n).alias("h"), e["pos"].alias("pos"))
        )

    return F.when(F.size(words) > 0, _let(F.sort_array(_let(words, kmers)), numbered))


def tuples(text: Column, k: int = K, count: int = TUPLES, pick: int = PICK) -> Column:
    """Array of ``count`` tuple hashes; empty for a text without words."""
    bins = count * pick

    def of_words(w: Column) -> Column:
        dealt = F.transform(
            elements(w, k),
            lambda e: F.struct(
                F.pmod(e["h"], F.lit(bins)).cast("int").alias("bin"), e["h"].alias("h"), e["pos"].alias("pos")
            ),
        )
        return F.when(F.size(w) > 0, _let(F.sort_array(dealt), minima))

    def minima(s: Column) -> Column:
        firsts = F.filter(s, lambda e, i: (i == 0) | (e["bin"] != F.get(s, i - 1)["bin"]))
        return _let(firsts, filled)

    def filled(m: Column) -> Column:
        # Bin b takes the first minimum at or after b, around the end; gaps repeat it.
        around = F.flatten(F.transform(m, lambda e, i: F.array_repeat(
            e, F.when(i == 0, e["bin"] + 1).otherwise(e["bin"] - F.get(m, i - 1)["bin"])
        )))
        rest = F.array_repeat(F.get(m, F.lit(0)), F.lit(bins - 1) - F.element_at(m, -1)["bin"])
        return _let(F.concat(around, rest), signed)

    def signed(b: Column) -> Column:
        def one(t: Column) -> Column:
            chosen = F.transform(
                F.slice(b, t * pick + 1, pick), lambda e: F.struct(e["pos"].alias("pos"), e["h"].alias("h"))
            )
            return F.xxhash64(F.transform(F.sort_array(chosen), lambda e: e["h"]))

        return F.transform(F.sequence(F.lit(0), F.lit(count - 1)), one)

    return F.coalesce(_let(words_of(text), of_words), F.array().cast("array<bigint>"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal tuples of two fingerprints, from 0 to 1."""
    same = F.aggregate(
        F.zip_with(a, b, lambda x, y: F.when(x == y, 1).otherwise(0)), F.lit(0), lambda n, x: n + F.coalesce(x, F.lit(0))
    )
    both = F.greatest(F.size(a), F.size(b))
    return F.when(both == 0, F.lit(1.0)).otherwise(same / both)


def as_text(fingerprint: Column) -> Column:
    """A fingerprint as hex, eight digits a tuple."""
    return F.array_join(F.transform(fingerprint, lambda h: F.lpad(F.hex(h.bitwiseAND(0xFFFFFFFF)), 8, "0")), "")


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (doc_id, *columns) with ``next_*`` of the next row by descending ``doc_id``.

    Rows are dealt to blocks of neighbouring ids, at most MAX_BLOCKS of them. The highest
    id of a block is the one after the lowest of the block above; its rows are sent to that
    block too, as guests behind all others, so a lead inside the blocks is enough. The
    table of highest ids has one row for each block, a proven bound for its broadcast.
    Rows without an id share one block.
    """
    ids = docs.select("doc_id")
    low, high = ids.agg(F.min("doc_id"), F.max("doc_id")).first()
    width = max(BLOCK_IDS, ((high or 0) - (low or 0)) // MAX_BLOCKS + 1)

    def block(doc_id: Column) -> Column:
        return F.coalesce(F.floor((doc_id - F.lit(low or 0)) / width), F.lit(-1))

    heads = ids.groupBy(block(F.col("doc_id")).alias("_b")).agg(F.max("doc_id").alias("_head"))
    order = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    above = F.lag("_b").over(Window.orderBy(F.col("_b").desc()))
    guests = heads.select("_head", F.coalesce(above, F.last("_b").over(order)).alias("_guest_of"))
    sent = docs.join(F.broadcast(guests), F.col("doc_id").eqNullSafe(F.col("_head")), "left")
    places = F.when(
        F.col("_guest_of").isNull(), F.array(F.struct(F.lit(0).alias("g"), block(F.col("doc_id")).alias("b")))
    ).otherwise(F.array(
        F.struct(F.lit(0).alias("g"), block(F.col("doc_id")).alias("b")),
        F.struct(F.lit(1).alias("g"), F.col("_guest_of").alias("b")),
    ))
    dealt = sent.select("doc_id", *columns, F.explode(places).alias("_at"))
    window = Window.partitionBy("_at.b").orderBy(
        F.col("_at.g"), F.col("doc_id").desc_nulls_last(), *(F.col(c) for c in columns)
    )
    lead = [F.lead(c).over(window).alias(f"next_{c}") for c in columns]
    return dealt.select("doc_id", *columns, "_at", *lead).where("_at.g = 0").drop("_at")


def op3_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text")
    )
    printed = docs.select("doc_id", "text", tuples(F.col("text")).alias("f"))
    rows = with_next(printed, ["text", "f"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substr("text", F.lit(1), n - cut), F.substr("next_text", F.lit(1), cut)
    )
    rows = rows.select("doc_id", n.cast("long").alias("n_chars"), edited.alias("_edited"), "f", "next_f")
    rows = rows.withColumn("e", tuples(F.col("_edited")))
    return rows.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("e")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("e")).alias("near_edited"),
        likeness(F.col("f"), F.col("next_f")).alias("near_next"),
    )
