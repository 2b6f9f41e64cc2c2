r"""Phrase collocation mining with weighted acyclic automata.

Texts are lower-cased (A-Z), cut at `[.,;:!?\x0A-\x0D]` into pieces, and these into words `[^\x20\x09]+`. Within each
language, f(phrase) counts a phrase's contiguous occurrences within pieces, n all words. Phrases of 2 to `max_words`
words with f >= `min_count` are candidates. Cutting one after k words into parts with frequencies l and r gives the
score floor(1000000 * f * f / (l * r)); the lowest-scoring cut counts (ties: least k). A candidate is dropped if a
longer one contains it and has at least `cover` percent of its frequency. The best `top` of each language are ranked.

1. Each task counts the n-grams of about `SHARD_BYTES` of text at a time, sorted: a language, then words. From the
   sorted n-grams a minimal count transducer is built incrementally (`automata.minimal`) and stored, one row a shard.
2. Some evenly spaced n-grams of each shard, of which a bounded sample is read, give bounds of prefix ranges with
   about `RANGE_ARCS` arcs. Each transducer is cut at them, in rounds of `FANOUT` parts at most; the parts of a range
   are shuffled to one task and united with summed weights, some at a time. Arcs under `min_count` go: what remains is stored, one row a range.
3. Candidates are read off the ranges. Their distinct parts are sent to the ranges that hold them and composed, as an
   acceptor, with the range's transducer: that gives l and r. Scores, containment and ranks are joins, minima and
   windows over candidates alone.

A phrase's weights meet as one arc per shard that holds it, so a phrase with a third of all occurrences costs no
more than any other. Bounds may fall within the phrases of one beginning, so a very frequent beginning is spread over
ranges too. Numbers are exact: 64-bit counts, decimals of 38 digits for the products.

Defined cases: a null text has no words, a null language is `und`; repeated rows count each; ties of score and
frequency go by the phrase's UTF-8 bytes; an empty table gives no rows; further columns pass by, only lang and text are read. Texts longer
than a shard are counted in portions cut between pieces (one piece is never cut).
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.automata import (
    Path, Transducer, Trie, acceptor, composed, cut, grouped, minimal, pruned, sorted_symbols, union,
)
from dockyard.llm.shared import stored

MAX_WORDS, MIN_COUNT, COVER, TOP = 3, 10, 50, 2_000
SHARD_BYTES = 2 << 20
RANGE_ARCS = 1_000_000
#: Parts that one transducer is cut into at most; more ranges take more rounds.
FANOUT = 256
#: N-grams that a shard proposes as bounds, bytes of each symbol in a bound, and the most proposals and ranges.
MARKS, MARK_BYTES, MAX_MARKS, MAX_RANGES = 64, 64, 50_000, 10_000
#: Parts of a language that are ranked on their own before the language is.
RANK_PARTS = 64
_SEPARATOR = re.compile(rb"[.,;:!?\n-\r]")
_CLASS = np.zeros(256, np.uint8)  # 0 within words, 1 between words, 2 between pieces
_CLASS[list(b" \t")] = 1
_CLASS[list(b".,;:!?\n\v\f\r")] = 2


def counted(texts: list[tuple[bytes, bytes]], max_words: int = MAX_WORDS) -> Trie:
    """Sorted n-grams of (language, text) with counts: a language, then up to `max_words` words."""
    texts = sorted(texts, key=lambda x: x[0])
    buf = b"\n".join(raw for _, raw in texts) + b"\n"
    b = np.frombuffer(buf.lower(), np.uint8)  # of bytes: changes A-Z alone
    kind = _CLASS[b]
    inside = kind == 0
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    piece = np.cumsum(kind == 2, dtype=np.int32)[start]
    offsets = np.concatenate([[0], np.cumsum(end - start)])
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(start), [None, pa.py_buffer(offsets), pa.py_buffer(b[inside])]
    )
    langs = pa.array([lang for lang, _ in texts], pa.large_binary())
    symbols, label = sorted_symbols(pa.concat_arrays([words, langs]))
    label, lang = label[: len(words)], label[len(words) :]
    ends = np.cumsum([len(raw) + 1 for _, raw in texts])
    lang = lang[np.searchsorted(ends, start, "right")]
    one = np.ones(len(words), np.int64)
    level, node = grouped(np.zeros(len(words), np.int64), lang, one, len(symbols))
    levels, at = [level], np.arange(len(words))
    for k in range(max_words):
        ok = at + k < len(words)
        ok[ok] = piece[at[ok]] == piece[at[ok] + k]
        at, node = at[ok], node[ok]
        level, node = grouped(node, label[at + k], one[: len(at)], len(symbols))
        levels.append(level)
    return Trie(symbols, levels)


def marks(trie: Trie, n: int = MARKS) -> list[list[bytes]]:
    """Evenly spaced n-grams of the longest kind that there is."""
    d = max((d for d, x in enumerate(trie.levels) if len(x)), default=None)
    if d is None:
        return []
    places = np.unique(np.linspace(0, len(trie.levels[d]) - 1, n).astype(np.int64))
    return [[s[:MARK_BYTES] for s in trie.path(d, int(i))] for i in places]


def _portions(raw: bytes, most: int) -> Iterator[bytes]:
    """A text in portions of at least `most` bytes, cut between pieces."""
    while len(raw) > most and (found := _SEPARATOR.search(raw, most)):
        yield raw[: found.end()]
        raw = raw[found.end() :]
    yield raw


_SHARDS = "shard bigint, arcs bigint, automaton binary, marks array<array<binary>>"


def _sharder(max_words: int, shard_bytes: int):
    kind = pa.schema([
        ("shard", pa.int64()), ("arcs", pa.int64()), ("automaton", pa.binary()), ("marks", pa.list_(pa.list_(pa.binary())))
    ])

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, size, texts = TaskContext.get().partitionId() << 32, 0, []

        def built() -> pa.RecordBatch:
            trie = counted(texts, max_words)
            row = {"shard": number, "arcs": len(trie), "automaton": minimal(trie).dumps(), "marks": marks(trie)}
            return pa.RecordBatch.from_pylist([row], kind)

        for batch in batches:
            rows = zip(batch["lang"].cast(pa.binary()), batch["text"].cast(pa.binary()), strict=True)
            for lang, text in rows:
                for raw in _portions(text.as_py() or b"", shard_bytes):
                    texts.append((lang.as_py(), raw))
                    size += len(raw) + 1
                    if size >= shard_bytes:
                        yield built()
                        number, size, texts = number + 1, 0, []
        if texts:
            yield built()

    return shards


def transducers(docs: DataFrame, max_words: int = MAX_WORDS, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One minimal count transducer per shard, stored."""
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    return stored(texts.mapInArrow(_sharder(max_words, shard_bytes), _SHARDS), "phrase-shards")


def bounds(shards: DataFrame, depth: int, range_arcs: int = RANGE_ARCS) -> list[Path]:
    """Bounds of the prefix ranges, ascending, at most MAX_RANGES; they steer the work and change no result."""
    arcs, n = shards.agg(F.sum("arcs"), F.sum(F.size("marks"))).first()
    ranges = min(MAX_RANGES, -(-(arcs or 0) // range_arcs))
    if ranges <= 1 or not n:
        return []
    proposed = shards.select("shard", F.posexplode("marks"))
    some = proposed.where(F.pmod(F.xxhash64("shard", "pos"), F.lit(-(-n // MAX_MARKS))) == 0)
    found = sorted(tuple(map(bytes, r.col)) + (b"",) * (depth - len(r.col)) for r in some.select("col").collect())
    return sorted({found[i * len(found) // ranges] for i in range(1, ranges)}) if found else []


def _cutter(at, step: int, fanout: int):
    """Parts of transducers of coarse ranges, by the bounds of the `fanout` ranges within each."""
    kind = pa.schema([("range", pa.int32()), ("automaton", pa.binary())])

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fine = at.value[step - 1 :: step]
        for batch in batches:
            for coarse, raw in zip(batch["range"].to_pylist(), batch["automaton"], strict=True):
                trie = Transducer.loads(raw.as_py()).trie()
                base = coarse * fanout
                for r, part in enumerate(cut(trie, fine[base : base + fanout - 1]), base):
                    if part is not None:
                        yield pa.RecordBatch.from_pylist([{"range": r, "automaton": minimal(part).dumps()}], kind)

    return parts


_RANGES = "range int, automaton binary, totals array<struct<lang: binary, n: bigint>>"


def _united(batches: Iterator[pa.RecordBatch], most_arcs: int) -> Trie:
    held: list[Trie] = []
    for batch in batches:
        for raw in batch["automaton"]:
            held.append(Transducer.loads(raw.as_py()).trie())
            if len(held) > 1 and sum(map(len, held[1:])) > max(most_arcs // 4, len(held[0])):
                held = [union(held)]
    return union(held)


def _uniter(min_count: int, most_arcs: int):
    totals = pa.list_(pa.struct([("lang", pa.binary()), ("n", pa.int64())]))
    kind = pa.schema([("range", pa.int32()), ("automaton", pa.binary()), ("totals", totals)])

    def unite(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _united(batches, most_arcs)
        words = [
            {"lang": trie.symbols[int(i)].as_py(), "n": int(n)}
            for i, n in zip(trie.levels[0].label, trie.levels[0].weight, strict=True) if n
        ]
        row = {"range": key[0].as_py(), "automaton": minimal(pruned(trie, min_count)).dumps(), "totals": words}
        yield pa.RecordBatch.from_pylist([row], kind)

    return unite


def _some_uniter(most_arcs: int):
    kind = pa.schema([("range", pa.int32()), ("automaton", pa.binary())])

    def unite(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = {"range": key[0].as_py(), "automaton": minimal(_united(batches, most_arcs)).dumps()}
        yield pa.RecordBatch.from_pylist([row], kind)

    return unite


def united(
    shards: DataFrame, at, min_count: int = MIN_COUNT, range_arcs: int = RANGE_ARCS, fanout: int = FANOUT
) -> DataFrame:
    """One transducer per prefix range with all sequences of weight `min_count` or more, and the languages' words.

    With R ranges and S shards, S * R parts would grow with the square of the corpus. So no transducer is cut into
    more than `fanout` parts: coarse ranges first, whose parts are united to transducers of about `range_arcs`, then
    these by the ranges within.
    """
    ranges, rounds = len(at.value) + 1, 1
    while fanout**rounds < ranges:
        rounds += 1
    fanout = next(f for f in range(1, fanout + 1) if f**rounds >= ranges)
    pieces, name = shards.select(F.lit(0).alias("range"), "automaton"), "range int, automaton binary"
    for i in range(1, rounds):
        parts = pieces.mapInArrow(_cutter(at, fanout ** (rounds - i), fanout), name)
        total = shards.agg(F.sum("arcs")).first()[0]
        bucket = F.pmod(F.xxhash64("automaton"), F.lit(max(1, total // fanout**i // range_arcs))).alias("bucket")
        pieces = stored(parts.groupBy("range", bucket).applyInArrow(_some_uniter(range_arcs), name), "phrase-coarse")
    parts = pieces.mapInArrow(_cutter(at, 1, fanout), name)
    return stored(parts.groupBy("range").applyInArrow(_uniter(min_count, range_arcs), _RANGES), "phrase-ranges")


def _phrases(max_words: int, min_count: int):
    kind = pa.schema([("lang", pa.string()), ("words", pa.list_(pa.string())), ("a", pa.int64())])

    def phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch["automaton"]:
                trie = Transducer.loads(raw.as_py()).trie()
                for (lang, *words), weight in trie.paths(min_count, range(2, max_words + 1)):
                    n, k = len(weight), len(words)
                    flat = pa.concat_arrays(words).take(pa.array(np.arange(n * k).reshape(k, n).T.ravel()))
                    lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * k, pa.int32()), flat.cast(pa.string()))
                    table = pa.table([lang.cast(pa.string()), lists, pa.array(weight)], schema=kind)
                    yield from table.to_batches(max_chunksize=10_000)

    return phrases


def _range_of(at):
    @F.arrow_udf("int")
    def place(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for langs, parts in batches:
            found = []
            for lang, part in zip(langs.to_pylist(), parts.to_pylist(), strict=True):
                path = tuple(x.encode() for x in (lang, *part))
                depth = len(at.value[0]) if at.value else len(path)
                found.append(bisect_right(at.value, path + (b"",) * (depth - len(path))))
            yield pa.array(found, pa.int32())

    return place


def _composer(depth: int):
    kind = pa.schema([("lang", pa.string()), ("part", pa.list_(pa.string())), ("f", pa.int64())])

    def compose(ranges: pa.Table, wanted: pa.Table) -> pa.Table:
        if not len(ranges) or not len(wanted):
            return kind.empty_table()
        paths = [
            tuple(x.encode() for x in (lang, *part))
            for lang, part in zip(wanted["lang"].to_pylist(), wanted["part"].to_pylist(), strict=True)
        ]
        sequences, places = acceptor(paths, depth)
        weights = composed(sequences, Transducer.loads(ranges["automaton"][0].as_py()))
        f = pa.array([int(weights[d][i]) for d, i in places], pa.int64())
        return pa.table([wanted["lang"], wanted["part"], f], schema=kind)

    return compose


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    whole = lambda c: c.cast("decimal(18,0)")
    over, under = F.lit(1_000_000).cast("decimal(7,0)") * whole(a) * whole(a), whole(left) * whole(right)
    return F.call_function("div", over, under)


def phrases(
    docs: DataFrame,
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    cover: int = COVER,
    top: int = TOP,
    shard_bytes: int = SHARD_BYTES,
    range_arcs: int = RANGE_ARCS,
    fanout: int = FANOUT,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's best phrases."""
    depth = max_words + 1
    shards = transducers(docs, max_words, shard_bytes)
    at = docs.sparkSession.sparkContext.broadcast(bounds(shards, depth, range_arcs))
    ranges = united(shards, at, min_count, range_arcs, fanout)
    found = ranges.select("automaton").mapInArrow(_phrases(max_words, min_count), "lang string, words array<string>, a bigint")
    found = stored(found, "phrase-candidates")

    # Parts of every cut, and their frequencies by composition.
    places = F.sequence(F.lit(1), F.size("words") - 1)
    cuts = found.select("lang", "words", "a", F.explode(places).alias("k"))
    parts = F.array(
        F.struct(F.lit(0).alias("side"), F.slice("words", F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(1).alias("side"), F.expr("slice(words, k + 1, size(words) - k)").alias("part")),
    )
    cuts = stored(cuts.select("lang", "words", "a", "k", F.inline(parts)), "phrase-cuts")
    wanted = cuts.select("lang", "part").distinct().withColumn("range", _range_of(at)(F.col("lang"), F.col("part")))
    known = ranges.groupBy("range").cogroup(wanted.groupBy("range"))
    known = stored(known.applyInArrow(_composer(depth), "lang string, part array<string>, f bigint"), "phrase-parts")

    # A word that many phrases hold is a skewed key of a join of two stored tables, which Spark splits.
    with_f = cuts.join(known.hint("merge"), ["lang", "part"])
    sides = [F.max(F.when(F.col("side") == i, F.col("f"))).alias(c) for i, c in enumerate("lr")]
    scored = with_f.groupBy("lang", "words", "a", "k").agg(*sides)
    scored = scored.withColumn("score", _score(F.col("a"), F.col("l"), F.col("r")))
    least = F.min(F.struct("score", "k", "l", "r")).alias("cut")
    scored = scored.groupBy("lang", "words", "a").agg(least)

    # Shorter candidates within longer ones.
    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    inner = F.flatten(F.transform(sizes, lambda m: F.transform(
        F.sequence(F.lit(1), F.size("words") - m + 1), lambda i: F.slice("words", i, m))))
    longer = found.where(F.size("words") > 2).select("lang", F.explode(inner).alias("words"), "a")
    longer = longer.groupBy("lang", "words").agg(F.max("a").alias("longest"))
    kept = scored.join(longer.hint("merge"), ["lang", "words"], "left").where(
        F.coalesce(F.lit(100) * F.col("longest") < F.lit(cover) * F.col("a"), F.lit(True))
    )
    kept = kept.select("lang", F.array_join("words", " ").alias("phrase"), "a", "cut.l", "cut.r", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS)))
    for keys in (("lang", "part"), ("lang",)):  # first within parts, so that no task ranks a whole language
        rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
        kept = kept.withColumn("rank", rank).where(F.col("rank") <= top)
    totals = ranges.select(F.inline("totals")).groupBy("lang").agg(F.sum("n").alias("n"))
    totals = totals.select(F.col("lang").cast("string").alias("lang"), "n")
    return kept.join(totals.hint("merge"), "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )


def digest(docs: DataFrame) -> DataFrame:
    return phrases(docs)
