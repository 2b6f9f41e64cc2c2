r"""Cross-tokenizer alignment, Arrow-native.

Each text is encoded by tokenizer A (byte-level BPE, on a space and the text) and by tokenizer B (sentencepiece, on
the text; it adds that space itself). Token bytes add up to the same bytes for both, so byte offsets where tokens of
both end cut a text into groups, and tokens whose byte ranges overlap are linked. A link's count is the number of
documents of the corpus that hold its pair of ids linked.

1. Texts are encoded in batches of about `BATCH_BYTES`. List columns of ids are flattened with their parent indices;
   cumulative sums of the token sizes, restarted at each document, give token ends. An Acero hash join (full outer) of
   the two token tables on the keys (document, end) gives all ends: rows that match on both sides end a group, and
   after filling unmatched sides backwards, every row is one link, as two tokens overlap in one run without ends.
2. `Table.group_by` counts links per (document, pair) and documents per pair. Batches of about `BLOCK_BYTES` of text
   form a block with one list of its distinct pairs; documents refer to their pairs by place in it.
3. Spark adds up the blocks' partial counts by pair and finds each A id's highest count (a row per A id at most: the
   vocabulary bounds what is broadcast), and sends each block the totals of its own pairs, where they are added up by
   document. What is shuffled grows with the pairs of blocks, not with links.

A very frequent pair has one row per block at the most, wherever its links come from.

Defined cases: null and empty texts, and texts whose joined token bytes differ from space+text (characters that a
tokenizer changes or drops), have no tokens: all numbers 0, groups ''. Repeated rows count as documents of their own and get equal
results; special strings inside texts are plain text; an empty table gives no rows; further columns pass by, only
doc_id and text are read. One text is encoded whole, in one batch; a text longer than a block is a block by itself.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.shared import stored
from dockyard.llm.token_counts import LATIN, _ranks_encoder

BATCH_BYTES = 1 << 20
BLOCK_BYTES = 16 << 20
#: A pair of ids as one number: A's id times this, plus B's id.
PAIR = 1 << 32

_ALIGNED = pa.schema([
    ("block", pa.int64()),
    ("doc_id", pa.int64()),
    ("n_a", pa.int64()),
    ("n_b", pa.int64()),
    ("n_groups", pa.int64()),
    ("n_links", pa.int64()),
    ("groups", pa.string()),
    ("places", pa.list_(pa.int32())),
    ("times", pa.list_(pa.int32())),
    ("pairs", pa.list_(pa.struct([("pair", pa.int64()), ("n", pa.int32())]))),
])
_DDL = (
    "block bigint, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "places array<int>, times array<int>, pairs array<struct<pair: bigint, n: int>>"
)


class ByteLevel:
    """Tokenizer A: ids of texts and the bytes of each id."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tokenizers

        self.model = tokenizers.Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        self.model.no_truncation()
        self.model.no_padding()
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that byte-level files write as they are
        other = [b for b in range(256) if b not in plain]
        byte_of = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}
        vocabulary = self.model.get_vocab(with_added_tokens=True)
        self.bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(byte_of[c] for c in token)
        self.fast = _ranks_encoder(path.removesuffix(".json") + ".tiktoken")
        if self.fast:
            encoding, _ = self.fast
            id_of = {token: i for i, token in enumerate(self.bytes)}
            self.ids = np.array([id_of[encoding.decode_single_token_bytes(r)] for r in range(encoding.n_vocab)], np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        out: list = [None] * len(texts)
        slow = []
        for i, text in enumerate(texts):
            if self.fast and (text.isascii() or max(text) <= chr(LATIN)):
                out[i] = self.ids[self.fast[0].encode_to_numpy(text, disallowed_special=())]
            else:
                slow.append(i)
        found = self.model.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False)
        for i, e in zip(slow, found, strict=True):
            out[i] = np.array(e.ids, np.int32)
        return out


class Pieces:
    """Tokenizer B."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        piece = lambda i: self.model.id_to_piece(i)
        self.bytes = [
            bytes([int(piece(i)[3:-1], 16)]) if self.model.is_byte(i) else piece(i).replace("▁", " ").encode()
            for i in range(n)
        ]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int32) for x in self.model.encode(texts, num_threads=1)]


def _flat(lists: list[np.ndarray]) -> pa.ListArray:
    sizes = np.cumsum([0, *map(len, lists)], dtype=np.int32)
    values = np.concatenate(lists) if lists else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(sizes), pa.array(values, pa.int32()))


def _offsets(array: pa.LargeBinaryArray) -> np.ndarray:
    return np.frombuffer(array.buffers()[1], np.int64)[array.offset : array.offset + len(array) + 1]


class Aligner:
    """The alignment of one batch of texts after another."""

    def __init__(self, path_a: str, path_b: str) -> None:
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        tables = [pa.array(t.bytes, pa.large_binary()) for t in (self.a, self.b)]
        self.bytes = tables
        self.sizes = [pc.binary_length(t).cast(pa.int64()) for t in tables]
        ids_a, ids_b = (range(len(t)) for t in tables)
        shown = [f"{i}{end}" for i in ids_a for end in ",|"] + [f"{i}{end}" for i in ids_b for end in (",", ";", "")]
        self.shown, self.shown_b = pa.array(shown, pa.large_binary()), 2 * len(ids_a)

    def _same(self, lists: pa.ListArray, k: int, raws: list[bytes]) -> np.ndarray:
        """Which documents' joined token bytes are theirs."""
        joined = pc.take(self.bytes[k], pc.list_flatten(lists))
        data = memoryview(joined.buffers()[2] or b"").cast("B")
        ends = _offsets(joined)[np.asarray(lists.offsets)]
        return np.array([data[s:e] == r for s, e, r in zip(ends[:-1], ends[1:], raws, strict=True)], bool)

    def _tokens(self, lists: pa.ListArray, k: int) -> tuple[np.ndarray, pa.Table]:
        """Flat ids, and a table of the document and end of each token with its place among all."""
        ids, doc = pc.list_flatten(lists), pc.list_parent_indices(lists).cast(pa.int64())
        run = pc.cumulative_sum(pc.take(self.sizes[k], ids))
        before = pa.array(np.concatenate([[0], np.asarray(run)])[np.asarray(lists.offsets)[:-1]], pa.int64())
        end = pc.subtract(run, pc.take(before, doc))  # the sum restarts at each document
        place = pa.array(np.arange(len(ids)), pa.int64())
        return np.asarray(ids), pa.table({"doc": doc, "end": end, ("a", "b")[k]: place})

    def align(self, texts: list[str]) -> dict[str, np.ndarray | list]:
        """Per text n_a, n_b, n_groups, n_links and `groups`; and (doc, pair, times) of the links, by doc and pair."""
        n = len(texts)
        spaced = [" " + t for t in texts]
        raws = [t.encode() for t in spaced]
        lists = [self.a.encode(spaced), self.b.encode(texts)]
        good = self._same(_flat(lists[0]), 0, raws) & self._same(_flat(lists[1]), 1, raws)
        none = np.empty(0, np.int32)
        flat = [_flat([x if ok and t else none for x, ok, t in zip(xs, good, texts, strict=True)]) for xs in lists]
        (ids_a, left), (ids_b, right) = (self._tokens(x, k) for k, x in enumerate(flat))
        starts = pa.array(np.cumsum([0, *map(len, raws)])[:-1], pa.int64())
        ends = left.join(right, ["doc", "end"], join_type="full outer", use_threads=False).combine_chunks()
        ends = ends.take(pc.sort_indices(pc.add(pc.take(starts, ends["doc"]), ends["end"])))
        both = np.asarray(pc.and_(ends["a"].is_valid(), ends["b"].is_valid()))
        doc = np.asarray(ends["doc"])
        at_a, at_b = (np.asarray(pc.fill_null_backward(ends[c])).astype(np.int64) for c in "ab")
        pair = ids_a[at_a].astype(np.int64) * PAIR + ids_b[at_b]
        links = pa.table({"doc": doc, "pair": pair})
        held = links.group_by(["doc", "pair"], use_threads=False).aggregate([([], "count_all")])
        held = held.take(pc.sort_indices(held, [("doc", "ascending"), ("pair", "ascending")]))
        group = np.cumsum(both) - both
        of_a, of_b = (group[np.asarray(ends[c].is_valid())] for c in "ab")
        return {
            "n_a": np.diff(np.asarray(flat[0].offsets)),
            "n_b": np.diff(np.asarray(flat[1].offsets)),
            "n_groups": np.bincount(doc[both], minlength=n),
            "n_links": np.bincount(doc, minlength=n),
            "groups": self._shown(flat, ids_a, ids_b, of_a, of_b),
            "doc": np.asarray(held["doc"]),
            "pair": np.asarray(held["pair"]),
            "times": np.asarray(held["count_all"]),
        }

    def _shown(self, flat, ids_a, ids_b, of_a, of_b) -> list[bytes]:
        """Each document's groups: A's ids, `|`, B's ids, groups apart by `;`."""
        groups = int(of_a[-1]) + 1 if len(of_a) else 0
        n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        last_a, last_b = np.diff(of_a, append=-1) != 0, np.diff(of_b, append=-1) != 0
        closing = np.zeros(len(of_b), bool)
        offsets = [np.asarray(x.offsets).astype(np.int64) for x in flat]
        ends = offsets[1][1:][np.diff(offsets[1]) > 0] - 1
        closing[ends] = True
        order = np.empty(len(of_a) + len(of_b), np.int64)
        order[np.arange(len(of_a)) + (np.cumsum(n_b) - n_b)[of_a]] = ids_a * np.int64(2) + last_a
        order[np.arange(len(of_b)) + np.cumsum(n_a)[of_b]] = self.shown_b + ids_b * np.int64(3) + last_b + closing
        shown = pc.take(self.shown, pa.array(order))
        data = memoryview(shown.buffers()[2] or b"").cast("B")
        at = _offsets(shown)[offsets[0] + offsets[1]]
        return [bytes(data[s:e]) for s, e in zip(at[:-1], at[1:], strict=True)]


class _Block:
    """Rows of one block: documents with places in the block's pairs, and those pairs with their documents."""

    def __init__(self, number: int, hashed: bool) -> None:
        self.number, self.hashed, self.size = number, hashed, 0
        self.doc_ids: list = []
        self.parts: list[dict] = []

    def add(self, doc_ids: list, texts: list[str], aligner: Aligner) -> None:
        part = aligner.align(texts)
        if self.hashed:
            part["groups"] = [hashlib.sha256(g).hexdigest() if g else "" for g in part["groups"]]
        else:
            part["groups"] = [g.decode() for g in part["groups"]]
        part["doc"] = part["doc"] + len(self.doc_ids)
        self.doc_ids += doc_ids
        self.parts.append(part)
        self.size += sum(map(len, texts))

    def rows(self) -> Iterator[pa.RecordBatch]:
        n = len(self.doc_ids)
        joined = {k: np.concatenate([p[k] for p in self.parts]) for k in self.parts[0] if k != "groups"}
        table = pa.table({"pair": joined["pair"], "doc": joined["doc"]})
        counts = table.group_by("pair", use_threads=False).aggregate([("doc", "count")]).sort_by("pair")
        pairs = np.asarray(counts["pair"])
        places = np.searchsorted(pairs, joined["pair"]).astype(np.int32)
        cuts = pa.array(np.searchsorted(joined["doc"], np.arange(n + 1)).astype(np.int32))
        number = lambda m: pa.array(np.full(m, self.number), pa.int64())
        columns = {
            "block": number(n),
            "doc_id": pa.array(self.doc_ids, pa.int64()),
            **{k: pa.array(joined[k].astype(np.int64)) for k in ("n_a", "n_b", "n_groups", "n_links")},
            "groups": pa.array([g for p in self.parts for g in p["groups"]], pa.string()),
            "places": pa.ListArray.from_arrays(cuts, pa.array(places)),
            "times": pa.ListArray.from_arrays(cuts, pa.array(joined["times"].astype(np.int32))),
            "pairs": pa.nulls(n, _ALIGNED.field("pairs").type),
        }
        for batch in pa.table(columns, _ALIGNED).to_batches(max_chunksize=4096):
            yield batch
        if len(pairs):
            n_docs = pa.array(np.asarray(counts["doc_count"]).astype(np.int32))
            value = pa.StructArray.from_arrays([pa.array(pairs), n_docs], ["pair", "n"])
            step = 1 << 16  # pairs in a row at most; a row's first place follows from the rows before
            for i in range(0, len(pairs), step):
                part = value[i : i + step]
                whole = {f.name: pa.nulls(1, f.type) for f in _ALIGNED}
                whole |= {"block": number(1), "n_a": pa.array([i], pa.int64())}
                whole["pairs"] = pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), part)
                yield from pa.table(whole, _ALIGNED).to_batches()


_LOADED: dict[tuple, Aligner] = {}


def _aligner(path_a: str, path_b: str, batch_bytes: int, block_bytes: int, hashed: bool):
    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = (path_a, path_b)
        aligner = _LOADED.get(key) or _LOADED.setdefault(key, Aligner(*key))
        first = TaskContext.get().partitionId() << 32
        block = _Block(first, hashed)
        for batch in batches:
            sizes = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch["text"]), 0), np.int64))
            start = 0
            while start < len(sizes):
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + batch_bytes, "right")))
                part = batch.slice(start, stop - start)
                texts = [t or "" for t in part["text"].to_pylist()]
                if block.parts and block.size + sizes[stop - 1] - done > block_bytes:
                    yield from block.rows()
                    block = _Block(block.number + 1, hashed)
                block.add(part["doc_id"].to_pylist(), texts, aligner)
                start = stop
        if block.parts:
            yield from block.rows()

    return align


def _summed(docs: pa.Table, pairs: pa.Table) -> pa.Table:
    """The documents of one block with the sums over their links; `pairs` has the totals by place."""
    pairs = pairs.sort_by("place")
    count, best = (np.asarray(pairs[c]).astype(np.int64) for c in ("count", "is_best"))
    rows = []
    for chunk in docs.combine_chunks().to_batches():
        places, times = chunk["places"], np.asarray(pc.list_flatten(chunk["times"])).astype(np.int64)
        at = np.asarray(pc.list_flatten(places))
        cut = np.concatenate([[0], np.cumsum(np.asarray(pc.list_value_length(places)))])
        add = lambda x, cut=cut: np.diff(np.concatenate([[0], np.cumsum(x)])[cut])
        out = chunk.select(["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups"])
        out = pa.Table.from_batches([out]).append_column("n_best", pa.array(add(best[at] * times), pa.int64()))
        rows.append(out.append_column("count_sum", pa.array(add(count[at] * times), pa.int64())))
    return pa.concat_tables(rows) if rows else _SUMMED.empty_table()


_SUMMED = pa.schema([
    *[(c, pa.int64()) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
    ("groups", pa.string()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
])


def pair_counts(aligned: DataFrame) -> DataFrame:
    """block, place, pair, a, count: each block's pairs with the number of documents of the corpus that hold them."""
    listed = aligned.where("pairs is not null").select("block", F.col("n_a").alias("first"), F.posexplode("pairs"))
    pairs = listed.select(
        "block", (F.col("first") + F.col("pos")).cast("int").alias("place"), F.col("col.pair").alias("pair"), F.col("col.n").alias("n")
    )
    total = F.sum("n").over(Window.partitionBy("pair"))
    return pairs.select("block", "place", F.expr("int(shiftright(pair, 32))").alias("a"), "pair", total.alias("count"))


def alignments(
    docs: DataFrame,
    path_a: str,
    path_b: str,
    hashed: bool = False,
    batch_bytes: int = BATCH_BYTES,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, groups, n_best and count_sum of every row.

    `groups` is the alignment as text (`a1,a2|b1;a3|b2,b3`), or its SHA-256 if `hashed`. Both paths must be readable
    on every executor.
    """
    aligned = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _aligner(path_a, path_b, batch_bytes, block_bytes, hashed), _DDL
    )
    aligned = stored(aligned, "alignment")
    counted = stored(pair_counts(aligned).select("block", "place", "a", "count"), "alignment-pairs")
    best = counted.groupBy("a").agg(F.max("count").alias("most"))
    totals = counted.join(F.broadcast(best), "a").select("block", "place", "count", (F.col("count") == F.col("most")).alias("is_best"))
    own = aligned.where("pairs is null").drop("pairs")
    out = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, n_best bigint, count_sum bigint"
    return own.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(_summed, out)


def digest(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    return alignments(docs, path_a, path_b, hashed=True).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", F.col("groups").alias("groups_sha256")
    )
