"""Token alignment against plain Python over the tokenizers' own libraries."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
import tokenizers

from dockyard.llm import queries, token_alignment
from dockyard.llm.shared import documents

PATHS = [public_tokenizers.path(x) for x in queries.ALIGNED]


@pytest.fixture(scope="module")
def libraries():
    a = tokenizers.Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def byte_of():
    plain = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    out, n = {chr(b): b for b in plain}, 0
    for b in range(256):
        if b not in plain:
            out[chr(256 + n)] = b
            n += 1
    return out


def brute(rows, libraries):
    """rows (doc_id, text) -> sorted digest rows."""
    a, b = libraries
    to_byte, names = byte_of(), a.get_vocab()
    name_of = {i: t for t, i in names.items()}
    docs = []
    for doc_id, text in rows:
        raw = (" " + (text or "")).encode()
        ids_a = a.encode(raw.decode(), add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        size_a = [bytes(to_byte[c] for c in name_of[i]) for i in ids_a]
        size_b = [bytes([int(p[3:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
                  for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
        if not text or b"".join(size_a) != raw or b"".join(size_b) != raw:
            docs.append((doc_id, [], [], [], ""))
            continue
        spans = []
        for sizes in (size_a, size_b):
            at, out = 0, []
            for s in sizes:
                out.append((at, at + len(s)))
                at += len(s)
            spans.append(out)
        links, j = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while j < len(spans[1]) and spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((ids_a[i], ids_b[k]))
                k += 1
        common = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        groups, low = [], 0
        for high in common:
            inside = [[str(i) for i, (s, e) in zip(ids, sp, strict=True) if low < e <= high]
                      for ids, sp in ((ids_a, spans[0]), (ids_b, spans[1]))]
            groups.append("|".join(",".join(x) for x in inside))
            low = high
        docs.append((doc_id, ids_a, ids_b, links, ";".join(groups)))
    held = Counter(p for _, _, _, links, _ in docs for p in set(links))
    best: Counter = Counter()
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return sorted(
        (
            (d, len(x), len(y), g.count(";") + 1 if g else 0, len(links),
             sum(held[p] == best[p[0]] for p in links), sum(held[p] for p in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "")
            for d, x, y, links, g in docs
        ),
        key=str,
    )


COLUMNS = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


HARD = [
    None, "", " ", "a", "  two  spaces ", "\n\nlines\t tabs\r\n", "naïve café — “quotes” … 12,345.67", "日本語のテキスト 漢字",
    "emoji 👩‍👩‍👧 and 👍🏽", "<|endoftext|> inside <s> </s> <unk> <0x0A> text", "a▁b", "▁", "x" * 3000, "ab" * 700,
    " leading", "Ünïcödé ǅ ﬁ ſ", " nbsp​zero", "\x00nul\x01", "The quick brown fox. " * 40, "١٢٣ ½ ²",
]


@pytest.mark.parametrize("batch_bytes,block_bytes", [(1 << 20, 16 << 20), (200, 900)])
def test_hard_texts(make, libraries, batch_bytes, block_bytes):
    rows = [(i, t) for i, t in enumerate(HARD)] + [(3, "a"), (6, HARD[6]), (None, "no id")]
    found = token_alignment.alignments(make(*rows), *PATHS, hashed=True, batch_bytes=batch_bytes, block_bytes=block_bytes)
    assert got(found.withColumnRenamed("groups", "groups_sha256")) == brute(rows, libraries)


def test_random_texts(make, libraries):
    rng = random.Random(5)
    parts = ["the", " ", "  ", "\n", "cafe", "é", "Straße", "ab", ".", ",", "123", "漢", "\t", "_", "()", "ing", "👍", "A"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(80)))) for i in range(300)]
    assert got(token_alignment.digest(make(*rows), *PATHS)) == brute(rows, libraries)


def test_query_on_whole_table(spark, libraries):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in documents(spark, sf).select("doc_id", "text").collect()]
    assert got(queries.op12_token_alignment(spark, sf)) == brute(rows, libraries)


def test_groups_as_text_and_empty_table(make, spark, libraries):
    text = token_alignment.alignments(make((1, "Hello world")), *PATHS).first().groups
    a, b = libraries
    assert text == "|".join([",".join(map(str, a.encode(" Hello").ids)), ",".join(map(str, b.encode("Hello")))]) + ";" + \
        "|".join([",".join(map(str, a.encode(" world").ids)), ",".join(map(str, b.encode("world")))])
    assert token_alignment.digest(make((1, "a")).limit(0), *PATHS).count() == 0
