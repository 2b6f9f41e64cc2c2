"""Phrase mining and its automata against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockyard.llm import phrase_mining, queries
from dockyard.llm.automata import Transducer, acceptor, composed, cut, minimal, pruned, union
from dockyard.llm.phrase_mining import counted
from dockyard.llm.shared import documents

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ngrams(rows, max_words=3):
    """rows (text, lang) -> language -> phrase -> count."""
    out: dict = defaultdict(Counter)
    for text, lang in rows:
        for piece in re.split(r"[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            w = [x for x in re.split(r"[ \t]+", piece) if x]
            for k in range(1, max_words + 1):
                for i in range(len(w) - k + 1):
                    out["und" if lang is None else lang][tuple(w[i : i + k])] += 1
    return out


def brute(rows, max_words=3, least=10, cover=50, top=2000):
    result = []
    for lang, f in ngrams(rows, max_words).items():
        n = sum(c for p, c in f.items() if len(p) == 1)
        candidates = {p: c for p, c in f.items() if len(p) > 1 and c >= least}
        gone = set()
        for p, c in candidates.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    q = p[i : i + k]
                    if 100 * c >= cover * f[q]:
                        gone.add(q)
        scored = []
        for p, a in candidates.items():
            if p not in gone:
                score, _, l, r = min((10**6 * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1):
            result.append((lang, i, p.decode(), -a, l, r, n, -s))
    return sorted(result)


def corpus(n=260):
    rng = random.Random(11)
    vocabulary = ["the", "The", "dock", "bike", "New", "york", "city", "of", "é", "É", "漢字", "x\x00", "a-b", "_", "ſ", "nbsp x"]
    ends = [". ", ", ", "\n", "\r\n", " ", "  ", "\t", "; ", "! ", "\v", ":"]
    rows = []
    for i in range(n):
        words = "".join(rng.choice(vocabulary[: 4 + i % 13]) + rng.choice(ends + [" "] * 12) for _ in range(rng.randrange(40)))
        rows.append((words, rng.choice(["en", "de", None, "und", "", "a\tb"])))
    return rows + [(None, "en"), ("", "en"), ("...", "fr"), ("once only", "fr"), ("new york city " * 300, "en")] * 2


@pytest.mark.parametrize(
    "options",
    [{}, {"shard_bytes": 400, "range_arcs": 300}, {"shard_bytes": 300, "range_arcs": 150, "fanout": 3}, {"max_words": 4, "shard_bytes": 3000, "range_arcs": 1000}, {"top": 5, "min_count": 3, "cover": 80}],
)
def test_phrases(spark, options):
    rows = corpus()
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "text string, lang string, score string").repartition(5)
    found = phrase_mining.phrases(docs, **options)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    want = {"max_words": "max_words", "min_count": "least", "cover": "cover", "top": "top"}
    assert sorted(map(tuple, found.collect())) == brute(rows, **{want[k]: v for k, v in options.items() if k in want})


def test_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.text, r.lang) for r in documents(spark, sf).select("text", "lang").collect()]
    assert sorted(map(tuple, queries.op11_phrase_mining(spark, sf).collect())) == brute(rows)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "text string, lang string")
    assert phrase_mining.phrases(docs).count() == 0
    assert phrase_mining.phrases(spark.createDataFrame([(None, None), ("...", "en")], "text string, lang string")).count() == 0


def test_scores_are_exact(spark):
    rng = random.Random(2)
    rows = [(3_000_000_019, 3_000_000_019, 3_000_000_021), (10, 10, 10), (10**10, 10**10 + 7, 10**11), (2**40, 2**41, 2**40 + 1)]
    rows += [(a := rng.randrange(10, 10**9), a + rng.randrange(10**6), a + rng.randrange(10**9)) for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = df.select("a", "l", "r", phrase_mining._score(F.col("a"), F.col("l"), F.col("r")).alias("s")).collect()
    assert all(x.s == 10**6 * x.a * x.a // (x.l * x.r) for x in got)


def as_dict(trie):
    out = {}
    for d, level in enumerate(trie.levels):
        for i in range(len(level)):
            if level.weight[i]:
                out[trie.path(d, i)] = int(level.weight[i])
    return out


def shard(rows):
    return counted([(b"und" if lang is None else lang.encode(), (text or "").encode()) for text, lang in rows])


def test_automata():
    rows = corpus(120)
    a, b = shard(rows[:60]), shard(rows[60:])
    want = {}
    for lang, f in ngrams(rows).items():
        for p, c in f.items():
            want[tuple(x.encode() for x in (lang, *p))] = c
            if len(p) == 1:
                want[(lang.encode(),)] = want.get((lang.encode(),), 0) + c
    both = union([a, b])
    assert as_dict(both) == want
    small = minimal(both)
    assert len(small) < len(both)  # right languages are shared
    back = Transducer.loads(small.dumps())
    assert as_dict(back.trie()) == want
    # Minimal: no two states of a level have the same arcs.
    for x in back.levels:
        arcs = [tuple(zip(x.label[s:e], x.target[s:e], x.weight[s:e], strict=True)) for s, e in zip(x.first, x.first[1:], strict=False)]
        assert len(set(arcs)) == len(arcs)
    assert as_dict(pruned(both, 7)) == {p: c for p, c in want.items() if c >= 7}
    rng = random.Random(4)
    asked = rng.sample(sorted(want), 80) + [(b"en", b"nowhere"), (b"xx",), (b"en", b"the", b"nowhere", b"the")]
    sequences, places = acceptor(asked, 4)
    weights = composed(sequences, back)
    assert [int(weights[d][i]) for d, i in places] == [want.get(p, 0) for p in asked]


@pytest.mark.parametrize("n", [1, 2, 17])
def test_cut_by_prefix_ranges(n):
    rng = random.Random(n)
    tries = [shard(corpus(30 + 40 * i)[20 * i :]) for i in range(3)]
    whole = as_dict(union(tries))
    bounds = sorted({(p + (b"",) * 4)[:4] for p in rng.sample(sorted(whole), n)} | {(b"en", b"zz", b"", b""), (b"fr", b"a", b"b", b"")})
    parts = [cut(t, bounds) for t in tries]
    ranges = []
    for r in range(len(bounds) + 1):
        some = [p[r] for p in parts if p[r] is not None]
        held = as_dict(union(some)) if some else {}
        low, high = (bounds[r - 1] if r else ()), (bounds[r] if r < len(bounds) else None)
        padded = [(p + (b"",) * 4)[:4] for p in held]
        assert all(p >= low and (high is None or p < high) for p in padded)
        ranges.append(held)
    merged: dict = {}
    for held in ranges:
        assert not merged.keys() & held.keys()
        merged |= held
    assert merged == whole


def test_long_texts_are_cut_between_pieces():
    raw = b"one two three. " * 50 + b"four" * 100 + b" five, six"
    parts = list(phrase_mining._portions(raw, 64))
    assert b"".join(parts) == raw and len(parts) > 5
    whole, apart = counted([(b"en", raw)]), union([counted([(b"en", p)]) for p in parts])
    assert as_dict(whole) == as_dict(apart)
    assert as_dict(counted([])) == {} and isinstance(counted([]).symbols, pa.LargeBinaryArray)
