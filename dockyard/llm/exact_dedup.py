r"""Exact dedup by content-defined chunk recipes.

1. Each text is cut into chunks where its content says so: a chunk ends where a hash of the eight bytes before has
   `1 / MEAN` chance to be zero, after `least` bytes at the earliest and `most` at the latest. Equal texts are cut alike.
2. A chunk's identifier is a hash of its bytes. Identifiers are verified: the corpus' distinct (identifier, bytes) are
   found with map-side combining, so each chunk's bytes move once per task that holds it, and no identifier may stand
   for two of them. If one does, all identifiers are made `WIDER` times as wide and verified anew.
3. A text's recipe is the ordered list of its identifiers. Verified identifiers make equal recipes equal texts, so
   texts are grouped, counted and joined by recipe alone: 16 bytes for some kilobytes of text, and no document moves.

A group with a third of all rows is reduced within each task before recipes are shuffled; where rows get their group's
values back, it is a skewed key of a sort-merge join of two stored tables, which Spark splits. A document's chunks are
never gathered from others' tasks.

Defined cases: a null text counts as empty, and empty texts are equal (their recipe has no chunk). Of rows with equal
text, the one with the largest doc_id stays; null doc_ids come last; of rows with equal doc_id and text, one stays.
An empty table gives no rows. Further columns pass through `deduped` and do not matter elsewhere. A text is cut within
one row, its chunks are at most `most` bytes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import packed, stored, unpacked

LEAST, MEAN_BITS, MOST = 2_048, 12, 32_768
WIDTH, WIDER, WIDEST = 16, 2, 128
_MIX = np.uint64(0x9E3779B97F4A7C15)


def cuts(raw: bytes, least: int = LEAST, bits: int = MEAN_BITS, most: int = MOST) -> list[int]:
    """Ends of the chunks of `raw`, ascending; the last one is its length. No bytes, no chunks."""
    n = len(raw)
    if n <= least:
        return [n] if n else []
    window = np.ndarray((n - 7,), "<u8", raw, strides=(1,))  # the eight bytes from each place on
    with np.errstate(over="ignore"):
        ends = np.flatnonzero(window * _MIX >> np.uint64(64 - bits) == 0) + 8
    out, start = [], 0
    while n - start > least:
        i = np.searchsorted(ends, start + least)
        end = int(ends[i]) if i < len(ends) else n
        start = min(end, start + most, n)
        out.append(start)
    if start < n:
        out.append(n)
    return out


def identifier(chunk: bytes, width: int = WIDTH) -> bytes:
    seeds = range(-(-width // 16))
    return b"".join(xxhash.xxh3_128_digest(chunk, seed) for seed in seeds)[:width]


def _chunks(raw: bytes) -> list[bytes]:
    ends = cuts(raw)
    return [raw[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def recipe_of(width: int):
    @F.arrow_udf("array<binary>")
    def recipe(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            raws = texts.cast(pa.binary())
            yield pa.array([[identifier(c, width) for c in _chunks(x.as_py() or b"")] for x in raws], pa.list_(pa.binary()))

    return recipe


def chunks_of(width: int):
    kind = pa.list_(pa.struct([("id", pa.binary()), ("chunk", pa.binary())]))

    @F.arrow_udf("array<struct<id: binary, chunk: binary>>")
    def chunks(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            for i in range(0, len(texts), 256):
                raws = texts[i : i + 256].cast(pa.binary())
                found = [[{"id": identifier(c, width), "chunk": c} for c in _chunks(x.as_py() or b"")] for x in raws]
                yield pa.array(found, kind)

    return chunks


def ambiguous(docs: DataFrame, width: int) -> DataFrame:
    """Identifiers of `width` bytes that stand for more than one chunk, with their number of chunks."""
    held = docs.select(F.explode(chunks_of(width)(F.col("text"))).alias("c"))
    distinct = held.select("c.id", "c.chunk").distinct()
    return distinct.groupBy("id").agg(F.count(F.lit(1)).alias("n_chunks")).where("n_chunks > 1")


def verified_width(docs: DataFrame, width: int = WIDTH) -> int:
    """The least of width, width * WIDER, ... at which every identifier stands for one chunk of the corpus."""
    while ambiguous(docs, width).limit(1).count():
        width *= WIDER
        if width > WIDEST:
            raise RuntimeError(f"identifiers of {WIDEST} bytes are still ambiguous")
    return width


def _groups(docs: DataFrame, width: int, *more: str) -> tuple[DataFrame, DataFrame]:
    """Both stored: (recipe, doc_id, n) of the distinct documents, and each recipe's keep_id, group_size and `more`."""
    recipes = docs.select("doc_id", *more, recipe_of(width)(F.col("text")).alias("recipe"))
    own = recipes.groupBy("recipe", "doc_id", *more).agg(F.count(F.lit(1)).alias("n"))
    own = stored(own, "exact-documents")
    groups = own.groupBy("recipe", *more).agg(F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"))
    return own.drop(*more), stored(groups, "exact-groups")


def digest(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every row."""
    docs = docs.select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    own, groups = _groups(docs, verified_width(docs, width), "text_sha256")
    joined = own.join(groups.hint("merge"), "recipe")
    rows = joined.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))))
    return rows.select(
        "doc_id",
        "keep_id",
        "group_size",
        (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"),
        "text_sha256",
    )


def deduped(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """The rows that stay, with the columns they came with.

    Rows go by (doc_id, recipe) of those to drop, which are few or many as the corpus has it: a sort-merge join.
    """
    width = verified_width(docs, width)
    own, groups = _groups(docs.select("doc_id", "text"), width)
    joined = own.join(groups.hint("merge"), "recipe")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    named = lambda rows: rows.select(F.col("recipe").alias("r"), F.col("doc_id").alias("d"))
    gone = stored(named(joined.where(~stays)), "exact-gone")
    twice = stored(named(joined.where(stays & (F.col("n") > 1))), "exact-twice")
    rows = packed(docs).withColumn("recipe", recipe_of(width)(F.col("row.text")))
    is_it = (F.col("recipe") == F.col("r")) & F.col("row.doc_id").eqNullSafe(F.col("d"))
    kept = rows.join(gone.hint("merge"), is_it, "left_anti")
    once = kept.join(twice.hint("merge"), is_it, "left_anti").select("row")
    first = kept.join(twice.hint("merge"), is_it, "left_semi").withColumn("doc_id", F.col("row.doc_id"))
    return unpacked(once.unionByName(first.dropDuplicates(["doc_id", "recipe"]).select("row")), docs)
