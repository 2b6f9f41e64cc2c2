r"""N-gram Jaccard join: MinHash bands propose, full n-gram sets decide.

Two texts are linked if the Jaccard similarity of their sets of 5-word n-grams is at least the threshold. Words are
`[^\x20\x09-\x0D]+`, taken as they are; a text of 1 to 4 words has one n-gram, all its words.

1. Texts with equal n-gram sets (128-bit hash of the set) become one representative, the least doc_id and a number of
   its own, with a count of documents. All later steps see representatives only, so exact copies cost nothing.
2. Each representative gets `bands` band hashes of `rows` MinHash values each; `bands_for` picks the fewest values
   that find a pair at the threshold with the target recall. Shuffled on the band hash, every bucket links its
   members to its least one: a star, not all pairs. The stars' connected components are candidate groups, and any
   two representatives that share a bucket are in one group.
3. A group that fills more than one block falls apart first, without losing a link: with n-grams ordered by how many
   of the group hold them, two linked sets share one among the rarest |set| - threshold * |set| + 1 of each. Stars on
   these n-grams and their components are the groups that remain. Texts that share much (a template, a licence) but
   less than the threshold have rare n-grams of their own in front, share none of them, and are compared with nobody.
4. Each group is verified on full n-gram sets. Its members are dealt by hash into blocks of bounded size, and each
   pair of blocks is one task's work: a matrix product over shared n-grams gives all intersections at once. Out come
   each member's number of links and a spanning forest of the links, at most one row per member and pair of blocks.
   Pairs are never rows.
5. Components of the forests, and of the different texts of one doc_id, are the classes.

Every join is a sort-merge join at every size: what a small table would broadcast grows with the corpus.

A group of copies with a third of all rows is one representative if the copies are exact; if they differ, its
blocks are spread over tasks of bounded size, and only distinct n-gram sets are compared.

Defined cases: null and empty texts and texts without a word have no n-grams, hence no links and classes of their
own; rows with equal doc_id are one document, in one class, and `deduped` keeps or drops them together: a text that it
repeats counts once, and the links of its different texts are added up; rows without
doc_id have class null, no links, and stay; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.components import components
from dockyard.llm.shared import packed, sliced, stored, unpacked

N = 5
THRESHOLD = 0.8
RECALL = 0.9999
#: Members and n-grams in a block at most (one larger set is a block by itself).
BLOCK_ROWS, BLOCK_GRAMS = 1024, 1_000_000
_MIX = np.uint64(0x9E3779B97F4A7C15)


def bands_for(threshold: float, recall: float, rows: int = 5) -> tuple[int, int]:
    """(bands, rows): the fewest bands of `rows` values that find a pair at `threshold` with chance `recall`."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)), rows


def _mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: spreads every input bit over the word."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def ngrams(text: str | None, n: int = N) -> np.ndarray:
    """The distinct 64-bit hashes of a text's word n-grams, ascending."""
    words = (text or "").encode().split()  # of bytes: splits at the six ASCII characters alone
    if not words:
        return np.empty(0, np.uint64)
    n = min(n, len(words))
    w = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        g = np.full(len(w) - n + 1, n, np.uint64)
        for i in range(n):
            g = _mixed(g * _MIX + w[i : len(w) - n + 1 + i])
    return np.unique(g)


def _family(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    draw = lambda: rng.integers(1, 2**32, k, dtype=np.uint32)
    return draw() | np.uint32(1), draw()


def band_hashes(grams: np.ndarray, bands: int, rows: int, family: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """One 64-bit hash per band of the MinHash values in it; the band's number is part of the hash."""
    a, b = family
    low = grams.astype(np.uint32)  # mixed hashes: any 32 of their bits are as good
    with np.errstate(over="ignore"):
        least = np.full(bands * rows, np.iinfo(np.uint32).max, np.uint32)
        for s in range(0, len(low), 512):  # scratch that stays in the processor's cache
            part = low[None, s : s + 512] * a[:, None]
            part += b[:, None]
            np.minimum(least, part.min(axis=1), out=least)
        h = np.arange(1, bands + 1, dtype=np.uint64)
        for values in least.astype(np.uint64).reshape(bands, rows).T:
            h = _mixed(h * _MIX + values)
    return h.view(np.int64)


def signed(n: int, bands: int, rows: int):
    kind = pa.struct([("set_hash", pa.binary()), ("grams", pa.int32()), ("bands", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<set_hash: binary, grams: int, bands: array<bigint>>")
    def sign(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        family = _family(bands * rows)
        for texts in sliced(batches):
            out = []
            for text in texts:
                g = ngrams(text.as_py(), n)
                if len(g):
                    h = band_hashes(g, bands, rows, family).tolist()
                    out.append({"set_hash": xxhash.xxh3_128_digest(g.tobytes()), "grams": len(g), "bands": h})
                else:
                    out.append(None)
            yield pa.array(out, kind)

    return sign.asNondeterministic()  # else the filter on its result would run it once more


def gram_sets(n: int):
    kind = pa.struct([("set_hash", pa.binary()), ("sets", pa.list_(pa.int64()))])

    @F.arrow_udf("struct<set_hash: binary, sets: array<bigint>>")
    def sets(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in sliced(batches):
            grams = [ngrams(x.as_py(), n) for x in texts]
            out = [{"set_hash": xxhash.xxh3_128_digest(g.tobytes()), "sets": g.view(np.int64)} for g in grams]
            yield pa.array(out, kind)

    return sets.asNondeterministic()  # keeps it above the join that picks the texts it is needed for


def _links(sets: list[np.ndarray], split: int, threshold: float) -> np.ndarray:
    """Boolean matrix: which of the first `split` sets is linked with which of the sets from `split` on.

    With split 0, all sets with all.
    """
    sizes = np.array([len(s) for s in sets], np.float64)
    left, right = slice(0, split or len(sets)), slice(split, len(sets))
    values, ids = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes.astype(np.int64))
    shared = np.bincount(ids, minlength=len(values)) > 1  # an n-gram of one set is in no intersection
    rank = np.cumsum(shared) - 1
    keep = shared[ids]
    ids, owner = rank[ids[keep]], owner[keep]
    order = np.argsort(ids, kind="stable")
    ids, owner = ids[order], owner[order]
    common = np.zeros((split or len(sets), len(sets) - split), np.float32)
    width = 4096
    for start in range(0, int(shared.sum()), width):
        lo, hi = np.searchsorted(ids, (start, start + width))
        x = np.zeros((len(sets), width), np.float32)
        x[owner[lo:hi], ids[lo:hi] - start] = 1
        common += x[left] @ x[right].T
    union = sizes[left][:, None] + sizes[right][None, :] - common
    return common >= threshold * union - 1e-9


def verifier(threshold: float):
    """For one pair of blocks of a group: each member's links, and a forest of them as (node, to)."""

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "rep"], ignore_index=True)
        reps, copies, sides = pdf["rep"].to_numpy(), pdf["copies"].to_numpy(), pdf["side"].to_numpy()
        split = int((sides == 0).sum())
        if pdf["i"].iloc[0] != pdf["j"].iloc[0]:
            if split in (0, len(reps)):  # the other block is empty
                return pd.DataFrame({"rep": reps, "links": np.zeros(len(reps), np.int64), "to": np.full(len(reps), None, object)})
        else:
            split = 0
        linked = _links(list(pdf["sets"]), split, threshold)
        if split:
            n = np.concatenate([linked @ copies[split:], copies[:split] @ linked])
            at_l, at_r = np.nonzero(linked)
            at_r = at_r + split
        else:
            np.fill_diagonal(linked, False)
            n = linked @ copies
            at_l, at_r = np.nonzero(np.triu(linked))
        root = np.arange(len(reps))
        to = np.full(len(reps), None, object)

        def find(i: int) -> int:
            while root[i] != i:
                root[i] = root[root[i]]
                i = root[i]
            return i

        for i, j in zip(at_l.tolist(), at_r.tolist(), strict=True):
            i, j = find(i), find(j)
            if i != j:
                i, j = (i, j) if reps[i] < reps[j] else (j, i)
                root[j] = i
                to[j] = reps[i]
        return pd.DataFrame({"rep": reps, "links": n.astype(np.int64), "to": to})

    return verify


def _signatures(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    signs = docs.select("doc_id", signed(n, bands, rows)(F.col("text")).alias("s")).where("s is not null")
    return stored(signs.select("doc_id", "s.set_hash", "s.grams", "s.bands"), "ngram-signatures")


def _candidate_groups(reps: DataFrame) -> DataFrame:
    """rep, grp: representatives that share a band bucket with another, by component of the buckets' stars."""
    banded = stored(reps.select("rep", F.explode("bands").alias("band")), "ngram-bands")
    buckets = banded.groupBy("band").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    buckets = stored(buckets.select("band", "least"), "ngram-buckets")
    stars = banded.join(buckets.hint("merge"), "band").where("rep != least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    return components(stars, "ngram-candidates").select(F.col("node").alias("rep"), F.col("root").alias("grp"))


def _parts(members: DataFrame) -> DataFrame:
    """`members` with `parts`, the number of blocks of their group."""
    size = members.groupBy("grp").agg(F.count(F.lit(1)).alias("n"), F.sum("grams").alias("g"))
    parts = F.ceil(F.greatest(F.col("n") / BLOCK_ROWS, F.col("g") / BLOCK_GRAMS)).cast("int")
    size = stored(size.select(F.col("grp").alias("of"), parts.alias("parts")), "ngram-groups")
    return stored(members.join(size.hint("merge"), F.col("grp") == F.col("of")).drop("of"), "ngram-dealt")


def _split(wide: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The members of groups with more than one block, in smaller groups; those that can have no link are left out.

    Of a set's n-grams, those that nobody else in the group holds come first in the order, so the prefix has
    size(shared) - threshold * grams + 1 of the shared ones.
    """
    held = stored(wide.select("grp", "rep", "grams").join(sets.select("rep", "sets").hint("merge"), "rep"), "ngram-wide")
    rows = held.select("grp", "rep", "grams", F.explode("sets").alias("gram"))
    often = rows.groupBy("grp", "gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    often = stored(often.select(F.col("grp").alias("of"), F.col("gram").alias("common"), "n"), "ngram-often")
    ranked = (
        rows.join(often.hint("merge"), (F.col("grp") == F.col("of")) & (F.col("gram") == F.col("common")))
        .groupBy("grp", "rep", "grams")
        .agg(F.sort_array(F.collect_list(F.struct("n", "gram"))).alias("shared"))
        .withColumn("take", F.size("shared") - F.ceil(F.col("grams") * threshold - 1e-9) + 1)
        .where("take > 0")
    )
    rarest = F.slice(F.col("shared.gram"), F.lit(1), F.col("take").cast("int"))
    prefixes = stored(ranked.select("grp", "rep", F.explode(rarest).alias("gram")), "ngram-prefixes")
    least = prefixes.groupBy("grp", "gram").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    least = stored(least.select(F.col("grp").alias("of"), F.col("gram").alias("common"), "least"), "ngram-rarest")
    stars = prefixes.join(least.hint("merge"), (F.col("grp") == F.col("of")) & (F.col("gram") == F.col("common")))
    stars = stars.where("rep != least").select(F.col("rep").alias("a"), F.col("least").alias("b"))
    fine = components(stars, "ngram-splits").select(F.col("node").alias("rep"), F.col("root").alias("grp"))
    return stored(wide.drop("grp", "parts").join(fine.hint("merge"), "rep"), "ngram-fine")


def _blocks(dealt: DataFrame) -> DataFrame:
    """One row per member and pair of blocks i <= j that its block is in: grp, i, j, side, rep, set_hash, copies."""
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int"))
    pairs = F.when(
        F.col("parts") == 1, F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit(0).alias("side")))
    ).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("parts") - 1),
            lambda o: F.struct(
                F.least("block", o).alias("i"),
                F.greatest("block", o).alias("j"),
                F.when(F.col("block") <= o, 0).otherwise(1).alias("side"),
            ),
        )
    )
    rows = dealt.select("grp", "rep", "set_hash", "copies", F.explode(pairs).alias("p"))
    return rows.select("grp", "p.i", "p.j", "p.side", "rep", "set_hash", "copies")


def _own_texts(nodes: DataFrame) -> DataFrame:
    """a, b: links between the representatives of one document's different texts, as stars."""
    least = nodes.groupBy("doc_id").agg(F.min("rep").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
    least = stored(least.select(F.col("doc_id").alias("of"), "least"), "ngram-own")
    stars = nodes.join(least.hint("merge"), F.col("doc_id") == F.col("of")).where("rep != least")
    return stars.select(F.col("rep").alias("a"), F.col("least").alias("b"))


def _named(roots: DataFrame, reps: DataFrame) -> DataFrame:
    """rep, class_doc: the least doc_id of its component."""
    docs = reps.select("rep", "doc").hint("merge")
    roots = stored(roots.withColumnRenamed("node", "rep").join(docs, "rep"), "ngram-roots")
    least = stored(roots.groupBy("root").agg(F.min("doc").alias("class_doc")), "ngram-least")
    return roots.join(least.hint("merge"), "root").select("rep", "class_doc")


def classes(
    docs: DataFrame,
    n: int = N,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
) -> DataFrame:
    """One row per document: doc_id, class_id (the least doc_id of its class), n_links and n_copies.

    n_links counts the (document, text) that are linked with one of its texts, n_copies those with the same n-gram
    set, itself included. Documents without n-grams are missing here.
    """
    bands, rows = bands_for(threshold, recall)
    own = docs.select("doc_id", "text").where(F.col("doc_id").isNotNull())
    signs = _signatures(own, n, bands, rows)
    entries = stored(signs.select("doc_id", "set_hash").distinct(), "ngram-entries")
    held = entries.groupBy("set_hash").agg(F.min("doc_id").alias("doc"), F.count(F.lit(1)).alias("copies"))
    reps = signs.groupBy("set_hash").agg(F.first("grams").alias("grams"), F.first("bands").alias("bands"))
    # Of two texts of one document both may have it as their least doc_id, so a representative has its own number.
    reps = reps.join(held.hint("merge"), "set_hash").withColumn("rep", F.monotonically_increasing_id())
    reps = stored(reps, "ngram-reps")
    groups = _candidate_groups(reps)
    members = reps.select("rep", "doc", "set_hash", "copies", "grams").hint("merge")
    members = stored(groups.join(members, "rep"), "ngram-members")
    wanted = stored(members.select(F.col("doc").alias("wanted")).distinct(), "ngram-wanted")
    texts = own.join(wanted.hint("merge"), F.col("doc_id") == F.col("wanted"), "left_semi")
    sets = texts.select("doc_id", gram_sets(n)(F.col("text")).alias("s"))
    sets = sets.select(F.col("doc_id").alias("doc"), "s.set_hash", "s.sets").dropDuplicates(["doc", "set_hash"])
    sets = sets.join(members.select("doc", "set_hash", "rep").hint("merge"), ["doc", "set_hash"])
    sets = stored(sets.select("rep", "set_hash", "sets"), "ngram-sets")
    dealt = _parts(members)
    wide = dealt.where("parts > 1")
    if not wide.isEmpty():
        dealt = dealt.where("parts = 1").unionByName(_parts(_split(wide, sets, threshold)))
    work = _blocks(dealt).join(sets.hint("merge"), ["rep", "set_hash"])
    checked = work.groupBy("grp", "i", "j").applyInPandas(verifier(threshold), "rep bigint, links bigint, to bigint")
    checked = stored(checked, "ngram-checked")
    links = checked.groupBy("rep").agg(F.sum("links").alias("links"))
    forest = checked.where("to is not null").select(F.col("rep").alias("a"), F.col("to").alias("b"))
    nodes = stored(entries.join(reps.select("set_hash", "rep").hint("merge"), "set_hash").select("doc_id", "rep"), "ngram-nodes")
    named = _named(components(forest.union(_own_texts(nodes)), "ngram-classes"), reps)
    of_rep = (
        reps.select("rep", "doc", "copies")
        .join(links.hint("merge"), "rep", "left")
        .join(named.hint("merge"), "rep", "left")
        .select(
            "rep",
            F.coalesce("class_doc", "doc").alias("class_id"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.col("copies").alias("n_copies"),
        )
    )
    # A document's own other copies are no copies: its different texts have different sets.
    return (
        nodes.join(stored(of_rep, "ngram-of-rep").hint("merge"), "rep")
        .groupBy("doc_id")
        .agg(
            F.min("class_id").alias("class_id"),
            F.sum("n_links").alias("n_links"),
            (F.sum(F.col("n_copies") - 1) + 1).alias("n_copies"),
        )
    )


def digest(docs: DataFrame, **options) -> DataFrame:
    """doc_id, class_id, n_links and n_copies of every row, as in `classes`; the rows of one document get equal values."""
    found = classes(docs, **options).withColumnRenamed("doc_id", "id")
    return (
        docs.select("doc_id")
        .join(found.hint("merge"), F.col("doc_id") == F.col("id"), "left")
        .select(
            "doc_id",
            F.coalesce("class_id", "doc_id").alias("class_id"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("n_copies", F.lit(1)).cast("long").alias("n_copies"),
        )
    )


def deduped(docs: DataFrame) -> DataFrame:
    """One document of each class, the one with the least doc_id, with the columns it came with."""
    found = classes(docs)
    gone = stored(found.where("doc_id != class_id").select(F.col("doc_id").alias("gone_id")).distinct(), "ngram-gone")
    kept = packed(docs).join(gone.hint("merge"), F.col("row.doc_id") == F.col("gone_id"), "left_anti")
    return unpacked(kept, docs)
