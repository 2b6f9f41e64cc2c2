r"""Benchmark decontamination: pigeonhole edit matching.

A test item of m characters may occur in a text with up to k = max(1, m * error_rate) edits (insertions, deletions,
substitutions). Cut into k + 1 pieces, one piece at least must then occur unchanged: every exact piece hit names a
place, and Myers' bit-parallel distance over that place's surroundings decides. Nothing within the budget is missed.

Texts and items are compared lower-cased, with each run of white space as one space. The pieces of a group of items
form one Aho-Corasick automaton per Python worker. A group holds at most about `group_chars` characters of items,
whatever the benchmark's size: a larger benchmark takes more passes over the texts, one after another, and never makes
a broadcast or a worker larger. Each pass stores its hits alone, by doc_id and a digest of the text. Each text is read
whole by one call; only the windows around hits are measured.

Items under `min_chars` characters after normalising have no budget: an edit or two makes another question of them.
They are looked for exactly, at word boundaries (no letter, digit or mark on either side), through the same automaton.

Defined cases: null or empty texts and items match nothing; repeated items report each item_id; an item without
item_id is looked for like any other and reported as null; repeated rows get equal results; an empty benchmark leaves
all documents clean; further columns pass through.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import packed, sliced, stored, unpacked

ERROR_RATE = 0.05
MIN_CHARS = 40
GROUP_CHARS = 4_000_000
_HIT = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32())]))


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def budget(m: int, error_rate: float) -> int:
    return max(1, int(m * error_rate))


def bounded(text: str, start: int, end: int) -> bool:
    """Whether text[start:end] begins and ends at a word boundary, as far as it has word characters there."""
    joined = lambda i: 0 < i < len(text) and _in_word(text[i - 1]) and _in_word(text[i])
    return not joined(start) and not joined(end)


def _in_word(c: str) -> bool:
    return c == "_" or unicodedata.category(c)[0] in "LNM"


def pieces(item: str, k: int) -> list[tuple[int, str]]:
    """`item` cut into k + 1 pieces of even length, each with its start."""
    n, m = k + 1, len(item)
    cuts = [i * m // n for i in range(n + 1)]
    return [(a, item[a:b]) for a, b in zip(cuts, cuts[1:], strict=False) if b > a]


def myers(item: str, text: str) -> int:
    """The least edit distance of `item` to any substring of `text` (bit-parallel, one word of len(item) bits)."""
    m = len(item)
    if not m:
        return 0
    eq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        eq[c] |= 1 << i
    full, last = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = full, 0, m
    best = m
    for c in text:
        e = eq.get(c, 0)
        xv = e | mv
        xh = (((e & pv) + pv) ^ pv) | e
        ph = mv | (full & ~(xh | pv))
        mh = pv & xh
        if ph & last:
            score += 1
        elif mh & last:
            score -= 1
            if score < best:
                best = score
                if not best:
                    return 0
        ph <<= 1
        mh <<= 1
        pv = (mh | ~(xv | ph)) & full
        mv = ph & xv & full
    return best


class Matcher:
    """The items of one group, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]], error_rate: float, min_chars: int = 0) -> None:
        self.ids: dict[str, list[int]] = defaultdict(list)
        for item_id, text in items:
            self.ids[text].append(item_id)
        self.items = list(self.ids)
        self.budgets = [budget(len(x), error_rate) if len(x) >= min_chars else 0 for x in self.items]
        self.short = [len(x) < min_chars for x in self.items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for i, (item, k) in enumerate(zip(self.items, self.budgets, strict=True)):
            for start, piece in pieces(item, k):
                places[piece].append((i, start))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def find(self, text: str | None) -> dict[int, int]:
        """item index -> least distance, of the items within their budgets."""
        text = normal(text)
        found: dict[int, int] = {}
        if not text or not self.items:
            return found
        seen: set[tuple[int, int]] = set()
        for end, (n, where) in self.automaton.iter(text):
            for i, start in where:
                if self.short[i]:  # its one piece is the item
                    if i not in found and bounded(text, end + 1 - n, end + 1):
                        found[i] = 0
                    continue
                k = self.budgets[i]
                begin = end + 1 - n - start  # where the item would begin without edits before the piece
                step = begin // (k + 1)
                if found.get(i) == 0 or (i, step) in seen:
                    continue
                seen.add((i, step))  # hits in one step of k + 1 places share one window
                low, m = step * (k + 1), len(self.items[i])
                window = text[max(0, low - k) : low + k + m + k + 1]
                d = myers(self.items[i], window)
                if d <= k and d < found.get(i, k + 1):
                    found[i] = d
        return found


def _finder(items, error_rate: float, min_chars: int):
    @F.arrow_udf("array<struct<item_id: bigint, distance: int>>")
    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        matcher = Matcher(items.value, error_rate, min_chars)
        for texts in sliced(batches):
            out = []
            for text in texts:
                found = matcher.find(text.as_py())
                hits = [(x, d) for i, d in found.items() for x in matcher.ids[matcher.items[i]]]
                hits.sort(key=lambda h: (h[0] is not None, h))
                out.append([{"item_id": x, "distance": d} for x, d in hits])
            yield pa.array(out, _HIT)

    return find.asNondeterministic()  # else a filter on its result would run it once more


def _groups(bench: DataFrame, group_chars: int) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark in groups by hash, each read on its own: the driver holds two at most."""
    bench = bench.select("item_id", "text").where(F.length("text") > 0)
    total = bench.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-total // group_chars))
    for g in range(n):
        part = bench.where(F.pmod(F.xxhash64("text"), F.lit(n)) == g) if n > 1 else bench
        items = [(r.item_id, x) for r in part.collect() if (x := normal(r.text))]
        if items:
            yield items


_HITS = "array<struct<item_id: bigint, distance: int>>"


def contaminations(
    docs: DataFrame,
    bench: DataFrame,
    error_rate: float = ERROR_RATE,
    min_chars: int = MIN_CHARS,
    group_chars: int = GROUP_CHARS,
) -> DataFrame:
    """`row` (all columns of `docs`) and `hits`: an array of (item_id, distance), by item_id."""
    text, first, passes = F.col("row.text"), None, []
    for items in _groups(bench, group_chars):
        if first is not None and not passes:  # a second group: the first becomes a pass of its own as well
            passes.append(_hits_of(first, packed(docs), error_rate, min_chars))
        if first is not None:
            passes.append(_hits_of(items, packed(docs), error_rate, min_chars))
        first = first or items
    if not passes:
        shared = docs.sparkSession.sparkContext.broadcast(first)
        hits = _finder(shared, error_rate, min_chars)(text) if first else F.array().cast(_HITS)
        return packed(docs).select("row", hits.alias("hits"))
    found = passes[0]
    for more in passes[1:]:
        found = found.unionByName(more)
    hits = found.groupBy("of", "digest").agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits"))
    rows = packed(docs).withColumn("own", F.sha2(text, 256))
    joined = rows.join(
        stored(hits, "benchmark-hits").hint("merge"), F.col("row.doc_id").eqNullSafe(F.col("of")) & (F.col("own") == F.col("digest")), "left"
    )
    return joined.select("row", F.coalesce("hits", F.array().cast(_HITS)).alias("hits"))


def _hits_of(items: list, rows: DataFrame, error_rate: float, min_chars: int) -> DataFrame:
    """The texts with hits of one group of items; once this is written, its broadcast and its workers are free."""
    shared = rows.sparkSession.sparkContext.broadcast(items)
    text = F.col("row.text")
    hits = _finder(shared, error_rate, min_chars)(text).alias("hits")
    found = rows.select(F.col("row.doc_id").alias("of"), F.sha2(text, 256).alias("digest"), hits).where(F.size("hits") > 0)
    out = stored(found.dropDuplicates(["of", "digest"]), "benchmark-pass")
    shared.unpersist()
    return out


def clean(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """The documents that hold no test item, with the columns they came with."""
    return unpacked(contaminations(docs, bench).where(F.size("hits") == 0), docs)


def digest(docs: DataFrame, bench: DataFrame) -> DataFrame:
    """doc_id, contaminated, n_items, item_ids (comma-joined) and the least distance, one row per document."""
    return contaminations(docs.select("doc_id", "text"), bench).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.size("hits") > 0).alias("contaminated"),
        F.size("hits").alias("n_items"),
        F.array_join(F.transform("hits", lambda h: h["item_id"].cast("string")), ",").alias("item_ids"),
        F.array_min(F.transform("hits", lambda h: h["distance"])).alias("min_distance"),
    )
