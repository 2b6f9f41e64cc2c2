"""Places of pattern matches in a text, with built-in functions only.

Built-in functions give the matches and the pieces between them but no places; these follow from running sums of
lengths. All places are code points, ends exclusive.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from dockyard.llm.shared import let

#: Code points of a text in each of the blocks that `around` reads from.
BLOCK = 1024
SPANS = "array<struct<s:int,e:int,v:string>>"
AROUND = "array<struct<s:int,e:int,v:string,before:string,after:string>>"


def _scan(values: Column, start: Column) -> Column:
    def add(acc: Column, v: Column) -> Column:
        t = acc["t"] + v
        return F.struct(t.alias("t"), F.concat(acc["out"], F.array(t)).alias("out"))

    zero = F.struct(start.cast("int").alias("t"), F.array().cast("array<int>").alias("out"))
    return F.aggregate(values, zero, add, lambda acc: acc["out"])


def running(values: Column, block: int = 256) -> Column:
    """Running sums of an array of ints, by blocks, so that a text with very many matches stays cheap."""
    n_blocks = F.ceil(F.size(values) / F.lit(block)).cast("int")
    blocks = F.transform(F.sequence(F.lit(1), n_blocks), lambda b: F.slice(values, (b - 1) * block + 1, block))
    total = lambda x: F.aggregate(x, F.lit(0), lambda a, v: a + v)

    def joined(bs: Column) -> Column:
        def within(tops: Column) -> Column:
            ahead = lambda i: F.when(i == 0, F.lit(0)).otherwise(tops[F.greatest(i - 1, F.lit(0))])
            return F.flatten(F.transform(bs, lambda x, i: _scan(x, ahead(i))))

        return let(_scan(F.transform(bs, total), F.lit(0)), within)

    return let(blocks, joined)


def located(text: Column, pattern: str) -> Column:
    """All matches of `pattern`, leftmost and non-overlapping: start, end and value."""

    def places(hits: Column) -> Column:
        n = F.size(hits)

        def from_pieces(gaps: Column) -> Column:
            lengths = F.zip_with(hits, F.slice(gaps, 1, n), lambda h, g: F.length(g) + F.length(h))
            one = lambda i, ends: F.struct(
                (ends[i] - F.length(hits[i])).alias("s"),
                ends[i].alias("e"),
                hits[i].alias("v"),
            )
            return let(running(lengths), lambda ends: F.transform(F.sequence(F.lit(0), n - 1), lambda i: one(i, ends)))

        return F.when(n > 0, let(F.split(text, pattern, -1), from_pieces)).otherwise(F.array().cast(SPANS))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), places)


def around(text: Column, spans: Column, n: int) -> Column:
    """`spans` with the `n` code points of the text (BLOCK at most) before and after each, whatever matches there.

    Read from blocks: a substring of the text itself would be counted out from its beginning for every span.
    """

    def read(blocks: Column) -> Column:
        def joined(at: Column) -> Column:
            first = F.floor(at / BLOCK).cast("int")
            return F.array_join(F.slice(blocks, first + 1, 2), "")

        def piece(start: Column, end: Column) -> Column:
            return F.substring(joined(start), F.pmod(start, F.lit(BLOCK)) + 1, end - start)

        one = lambda x: F.struct(
            x["s"].alias("s"),
            x["e"].alias("e"),
            x["v"].alias("v"),
            piece(F.greatest(x["s"] - n, F.lit(0)), x["s"]).alias("before"),
            piece(x["e"], x["e"] + n).alias("after"),
        )
        return F.transform(spans, one)

    blocks = F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{BLOCK}}}+"), F.lit(0))
    return F.when(F.size(spans) > 0, let(blocks, read)).otherwise(F.array().cast(AROUND))


def tagged(spans: Column, kind: int) -> Column:
    """(start, kind's place in the list, end) of each span, which is also the order of spans in a result."""
    return F.transform(spans, lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"), x["e"].alias("e")))


def listed(spans: Column, kinds: tuple[str, ...]) -> Column:
    """`kind:start:end` of sorted tagged spans, comma-joined."""
    name = lambda x: reduce(lambda c, i: c.when(x["k"] == i, kinds[i]), range(len(kinds)), F)
    one = lambda x: F.concat_ws(":", name(x), x["s"].cast("string"), x["e"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")
