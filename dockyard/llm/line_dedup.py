r"""Line dedup: lines that many documents share go, but for one copy.

A line's key is the line with `[\x20\x09-\x0D]` stripped at both ends and A-Z lower-cased. Keys of at least
`min_chars` code points that at least `min_docs` documents hold lose all their lines, except in the largest doc_id
that holds them.

1. Every text's distinct long keys become 128-bit hashes (hash, doc_id, hash of the text); no line text is shuffled.
2. Rows per hash are counted with map-side sums; only hashes with `min_docs` rows or more are looked at again, and
   for these documents are counted exactly (a repeated doc_id counts once).
3. The hashes to drop are joined back to these rows, gathered by text (as many as it has lines at most), and each
   text's remaining lines are joined again by position. A doc_id of very many texts is a key for each of them.

Every join is a sort-merge join at every size: what a small table would broadcast grows with the corpus.
A hash that a third of all documents hold is one row per task after step 2's map side, and in step 3 a skewed key of
a plain join, which Spark splits.

Defined cases: a null or empty text is one empty line, kept; rows with equal doc_id count as one document and lose
the same lines; null doc_ids count as one document, smaller than any other; further columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import discard, packed, sliced, stored, unpacked

MIN_CHARS = 40
MIN_DOCS = 5
_HASHES = pa.list_(pa.binary())


def key_hash(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's key; None for keys under `min_chars` code points."""
    key = line.strip(b" \t\n\v\f\r")
    if len(key) < min_chars or not key.isascii() and len(key.decode()) < min_chars:
        return None
    return xxhash.xxh3_128_digest(key.lower())  # bytes.lower() changes A-Z alone


def line_hashes(min_chars: int):
    @F.arrow_udf("array<binary>")
    def hashes(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches):
            found = []
            for text in texts:
                lines = (text.as_py() or "").encode().split(b"\n")
                found.append(list({h for x in lines if (h := key_hash(x, min_chars)) is not None}))
            yield pa.array(found, _HASHES)

    return hashes


def remaining(min_chars: int):
    @F.arrow_udf("struct<text: string, n_lines: bigint, n_dropped: bigint>")
    def rest(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        kind = pa.struct([("text", pa.string()), ("n_lines", pa.int64()), ("n_dropped", pa.int64())])
        for texts, drops in sliced(batches):
            out = []
            for text, drop in zip(texts, drops, strict=True):
                lines = (text.as_py() or "").encode().split(b"\n")
                gone = set(drop.as_py() or ())
                kept = [x for x in lines if key_hash(x, min_chars) not in gone] if gone else lines
                out.append((b"\n".join(kept).decode(), len(lines), len(lines) - len(kept)))
            yield pa.array([dict(zip(("text", "n_lines", "n_dropped"), x, strict=True)) for x in out], kind)

    return rest


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, `text_hash` and `drop`: the key hashes that this text of the document loses. One row per text that loses any."""
    held = docs.select("doc_id", _text_hash("text"), F.explode(line_hashes(min_chars)(F.col("text"))).alias("h"))
    held = stored(held, "line-hashes")
    often = held.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_docs).select("h")
    often = stored(often, "line-often")  # read anew, so that a skewed hash of the join below can be split
    hits = stored(held.join(often.hint("merge"), "h"), "line-hits")
    bad = (
        hits.select("h", "doc_id")
        .distinct()
        .groupBy("h")
        .agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
        .where(F.col("n") >= min_docs)
        .select("h", "keeper")
    )
    bad = stored(bad, "line-bad")
    drops = (
        hits.join(bad.hint("merge"), "h")
        .where(~F.col("doc_id").eqNullSafe(F.col("keeper")))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set("h").alias("drop"))
    )
    drops = stored(drops, "line-drops")
    discard(held, often, hits, bad)
    return drops


def _text_hash(text: str) -> Column:
    """Spreads the texts of one doc_id. Two of them with equal hashes share their lists, which hold no other's loss:
    whether a document loses a line hangs on doc_id and line alone."""
    return F.xxhash64(text).alias("text_hash")


def line_dedup(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """`row` (all columns of `docs`) and `kept`: the remaining text, `n_lines` before and `n_dropped`."""
    drops = dropped_lines(docs, min_chars, min_docs).withColumnsRenamed({"doc_id": "drop_id", "text_hash": "drop_hash"})
    rows = packed(docs).withColumn("text_hash", _text_hash("row.text"))
    own = F.col("row.doc_id").eqNullSafe(F.col("drop_id")) & (F.col("text_hash") == F.col("drop_hash"))
    joined = rows.join(drops.hint("merge"), own, "left")
    return joined.select("row", remaining(min_chars)(F.col("row.text"), F.col("drop")).alias("kept"))


def deduped(docs: DataFrame) -> DataFrame:
    """All documents, with their remaining lines as text."""
    kept = line_dedup(docs).select("row", F.col("kept.text").alias("text"))
    return unpacked(kept, docs, "text").select(docs.columns)


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_lines, n_dropped and the SHA-256 of the remaining text, one row per row of `docs`."""
    return line_dedup(docs.select("doc_id", "text")).select(
        F.col("row.doc_id").alias("doc_id"),
        F.col("kept.n_lines").alias("n_lines"),
        F.col("kept.n_dropped").alias("n_dropped"),
        F.sha2(F.col("kept.text"), 256).alias("kept_sha256"),
    )
