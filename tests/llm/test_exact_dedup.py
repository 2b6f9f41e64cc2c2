"""Exact dedup against plain Python; identifiers that are too narrow are widened."""

from __future__ import annotations

import hashlib
import random

import pytest

from dockyard.llm import exact_dedup, queries
from dockyard.llm.shared import documents


def brute(rows):
    groups: dict[str, list] = {}
    for d, t in rows:
        groups.setdefault(t or "", []).append(d)
    out = []
    for t, ids in groups.items():
        ids.sort(key=lambda d: (d is not None, d or 0), reverse=True)
        sha = hashlib.sha256(t.encode()).hexdigest()
        out += [(d, ids[0], len(ids), i == 0, sha) for i, d in enumerate(ids)]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=str)


def rows():
    rng = random.Random(3)
    word = lambda: rng.choice(["dock", "bike", "point", "été", "漢字", "x\x00y", "\n"])
    base = [" ".join(word() for _ in range(n)) for n in (3, 300, 3000, 20_000)]
    base += ["z" * 100_000, "z" * 100_001, "", " ", None, base[3][:-1], base[3] + " ", "A", "a"]
    out = [(i, rng.choice(base)) for i in range(90)]
    out += [(7, base[1]), (7, base[1]), (8, base[2]), (None, base[1]), (None, None), (None, "only without id")]
    return out


@pytest.mark.parametrize("width", [16, 1])
def test_groups(make, width):
    assert got(exact_dedup.digest(make(*rows()), width)) == brute(rows())


def test_narrow_identifiers_are_widened(make):
    docs = make(*[(i, f"text {i}") for i in range(400)])
    assert exact_dedup.ambiguous(docs, 1).count() > 0
    assert exact_dedup.verified_width(docs, 1) > 1 and exact_dedup.verified_width(docs) == 16


def test_chunks_are_the_text_and_follow_content():
    rng = random.Random(1)
    raw = rng.randbytes(300_000)
    ends = exact_dedup.cuts(raw)
    sizes = [b - a for a, b in zip([0, *ends], ends, strict=False)]
    assert ends[-1] == len(raw) and max(sizes) <= exact_dedup.MOST and min(sizes[:-1]) >= exact_dedup.LEAST
    assert b"".join(exact_dedup._chunks(raw)) == raw
    moved = {c for c in exact_dedup._chunks(b"some bytes before" + raw)}
    assert len(moved & set(exact_dedup._chunks(raw))) >= len(sizes) - 2  # an insertion changes the chunks around it alone
    assert exact_dedup.cuts(b"") == [] and exact_dedup.cuts(b"a") == [1]


def test_deduped_keeps_one_row_of_each_text(make):
    given = rows()
    kept = exact_dedup.deduped(make(*given)).collect()
    want = sorted(((d, t or "") for d, t in {(x[0], x[4]) for x in brute(given) if x[3]}), key=str)
    assert sorted(((r.doc_id, hashlib.sha256((r.text or "").encode()).hexdigest()) for r in kept), key=str) == want
    assert all(r.kept == "k" and r.hits == "h" for r in kept)
    assert exact_dedup.deduped(make((1, "a")).limit(0)).count() == 0 == exact_dedup.digest(make((1, "a")).limit(0)).count()


def test_query_on_whole_table(spark):
    sf = "/root/testdata/sf0.001"
    given = [(r.doc_id, r.text) for r in documents(spark, sf).select("doc_id", "text").collect()]
    assert got(queries.op13_exact_dedup(spark, sf)) == brute(given)
