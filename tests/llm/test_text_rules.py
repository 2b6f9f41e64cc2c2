"""Quality rules, line dedup, secrets, personal data and token counts against plain Python."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from dockyard.llm import line_dedup, pii, quality_rules, secret_scan, spans, token_counts

ODD = [None, "", " ", "\n\n", "é", "a b\x0bc\x0cd\re", "word " * 30_000]


def measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + j for i, g in enumerate(grams) if often[g] > 1 for j in range(3)}
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return len(words), sum(map(len, words)), symbols, dup, len(covered)


def test_quality_counts(make):
    rng = random.Random(1)
    texts = ODD + [
        "".join(rng.choices(["the ", "of ", "a ", "b\n", "é# ", "\t", "|", "x y z ", "\n"], k=rng.randint(1, 200)))
        for _ in range(60)
    ]
    docs = make(*enumerate(texts))
    got = {r.doc_id: r for r in quality_rules.digest(docs).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        want = measures(text or "")
        r = got[i]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, i
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_quality_keeps_prose_and_drops_junk(make):
    rng = random.Random(2)
    prose = " ".join(rng.choices(["the", "of", "and"], k=60) + [f"w{rng.random()}x"[:6] for _ in range(80)])
    clean = " ".join(f"the {w}y{i} of" for i, w in enumerate(prose.split()))
    junk = " ".join(f"{w}$$$" for w in clean.split())
    out = quality_rules.filtered(make((1, clean), (2, junk), (2, junk), (3, None)))
    assert [r.doc_id for r in out.collect()] == [1]
    assert out.columns == make((1, "")).columns


def test_quality_filter_weighs_duplicate_lines_by_characters(make):
    long = [" ".join(f"the w{c}{i}y of" for i in range(40)) for c in "abcd"]
    short = "one short line said twice"
    few = f"{long[0]}\n{short}\n{short}"  # 1 of 3 lines, a few characters
    most = "\n".join([long[0], long[1], long[1], *[f"so {i}" for i in range(9)]])  # 1 of 12 lines, a third of the text
    rules = quality_rules.FILTER_RULES
    docs = make((1, few), (2, most), (3, few))
    assert sorted(r.doc_id for r in quality_rules.filtered(docs).collect()) == [1, 3]
    judged = quality_rules.quality_rules(docs, rules=rules).selectExpr("row.doc_id", "failed").collect()
    assert {r.doc_id: r.failed for r in judged} == {1: [], 2: ["repeated", "dup_lines"], 3: []}
    assert {r.doc_id: r.failed for r in quality_rules.digest(docs).collect()}[1] == "dup_lines"  # as in op10's SQL


def test_quality_empty_table(make, spark):
    assert quality_rules.digest(make((1, "x")).where("false")).count() == 0


def dedup(rows, min_chars=40, min_docs=5):
    key = lambda x: x.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    held = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        best = lambda ids: max((i for i in ids if i is not None), default=None)
        kept = [
            x for x in lines if len(ids := held.get(key(x), ())) < min_docs or best(ids) == doc_id
        ]
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def test_line_dedup(make):
    rng = random.Random(3)
    lines = [c * 45 for c in "abcdefgh"] + ["É" * 39, "É" * 40, "é" * 40, " " * 50, "short", "", "  " + "A" * 45 + "\t"]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 6)))) for i in range(40)]
    rows += [(3, "a" * 45), (3, "a" * 45), (100, None), (101, ""), (None, "b" * 45), (None, "c" * 45)]
    got = sorted((tuple(r) for r in line_dedup.digest(make(*rows)).collect()), key=str)
    assert got == dedup(rows)


def test_line_dedup_of_one_doc_id_with_many_texts(make):
    """A doc_id of very many texts: its drops are rows by text, none gathers them all."""
    shared = [c * 45 for c in "abcdef"]
    rows = [(7, f"{shared[i % 6]}\nown line {i}\n{shared[(i + 1) % 6]}") for i in range(300)]
    rows += [(i, "\n".join(shared)) for i in range(20, 30)]
    docs = make(*rows)
    assert sorted((tuple(r) for r in line_dedup.digest(docs).collect()), key=str) == dedup(rows)
    drops = line_dedup.dropped_lines(docs).where("doc_id = 7").collect()
    assert len(drops) == 300 and max(len(r.drop) for r in drops) <= 2


def test_line_dedup_keeps_columns(make):
    docs = make(*[(i, "x" * 50 + f"\nown {i}") for i in range(6)])
    out = line_dedup.deduped(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        **{i: f"own {i}" for i in range(5)}, 5: "x" * 50 + "\nown 5"
    }
    assert line_dedup.digest(docs.where("false")).count() == 0


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def luhn(digits):
    odd = sum(int(c) for c in digits[-1::-2])
    return (odd + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])) % 10 == 0


def base_spans(text, personal):
    find = lambda p, ok: [m.span() for m in re.finditer(p, text) if ok(m[0])]
    digits = lambda x: re.sub("[^0-9]", "", x)
    if not personal:
        kinds = {
            "assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 12],
            "access": find("AKIA[A-Z0-9]+", lambda x: len(x) >= 18),
            "hex": find("[0-9a-f]+", lambda x: len(x) >= 16),
        }
    else:
        kinds = {
            "email": find(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", bool),
            "ip": find(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: max(map(int, x.split("."))) <= 255),
            "card": find(r"[0-9]([\x20-]?[0-9])+", lambda x: 12 <= len(digits(x)) <= 19 and luhn(digits(x))),
            "phone": find(r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
        }
    found = sorted((s, i, e, k) for i, (k, spans) in enumerate(kinds.items()) for s, e in spans)
    return [f"{k}:{s}:{e}" for s, _, e, k in found], {k: len(v) for k, v in kinds.items()}


PARTS = [
    "password", "Token", "api_key", "API_KEY", "=", ":", " ", '"', "'", "abcdefghijklmn", "AKIA", "ABCDEFGHIJKLMNOP", "é",
    "deadbeefdeadbeef", "DEAD", "a@b.c", "_d@e.f", "@", ".", "1.2.3.4", "256.1.1.1", "000255.0.0.1", "+1 (415) 555-2671",
    "4111 1111 1111 1111", "4111111111111112", "-", "+", "12345678901234567890", "user: bob", "https://a.example/x",
    "GB82 WEST 1234 5698 7654 32", "123-45-6789 ssn", "\n",
]


@pytest.mark.parametrize("scan, personal", [(secret_scan, False), (pii, True)])
def test_spans(make, scan, personal):
    rng = random.Random(4)
    texts = [*ODD[:-1], "9" * 5000, "a.b" * 3000, "a1.b@c.de " * 400]
    texts += ["".join(rng.choices(PARTS, k=rng.randint(1, 30))) for _ in range(250)]
    texts += ["token=secret=abcdefghijklmnop token:password: abcdefghijkl", "1.2.3.4.5.6.7.8", "a@b.c_d@e.f x@y..z"]
    rows = [*enumerate(texts), (7, texts[7])]
    got = scan.digest(make(*rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        want, counts = base_spans(texts[r.doc_id] or "", personal)
        every = r.spans.split(",") if r.spans else []
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest(), texts[r.doc_id]
        assert [x for x in every if x.split(":")[0] in counts] == want
        assert {k: r[f"n_{k}"] for k in counts} == counts
        assert [int(x.split(":")[1]) for x in every] == sorted(int(x.split(":")[1]) for x in every)


def test_weak_parts_need_a_complement(make):
    opaque = "ZXhhbXBsZVRva2VuMTIzNDU2"
    alone, paired = f"{opaque} and nothing", f"login: robert9 then {opaque}"
    far = f"login: robert9 {'.. ' * 200}{opaque}"
    got = {r.doc_id: r.spans for r in secret_scan.digest(make((1, alone), (2, paired), (3, far), (2, paired))).collect()}
    assert got == {1: "", 2: "ident:0:14,opaque:20:44", 3: ""}


def test_weak_parts_over_strong_spans_stay_parts(make):
    opaque = "ZXhhbXBsZVRva2VuMTIzNDU2"
    texts = {
        f"client_id: 0123456789abcdef0123 key {opaque}": [("ident", 0, 31), ("hex", 11, 31), ("opaque", 36, 60)],
        f"https://h.example/0123456789abcdef01 {opaque}": [("endpoint", 0, 36), ("hex", 18, 36), ("opaque", 37, 61)],
        f"https://h.example/?token=abcdefghijklm {opaque}": [("endpoint", 0, 38), ("assign", 19, 38), ("opaque", 39, 63)],
        f"token={opaque}": [("assign", 0, 30)],  # an opaque part within a strong span is none
    }
    got = {r.doc_id: r.spans for r in secret_scan.digest(make(*enumerate(texts))).collect()}
    for i, (text, want) in enumerate(texts.items()):
        assert sorted(got[i].split(",")) == sorted(f"{k}:{s}:{e}" for k, s, e in want), text


def test_checksums_and_context(make):
    iban, bad = "iban GB82 WEST 1234 5698 7654 32", "iban GB82 WEST 1234 5698 7654 33"
    rows = [(1, iban), (2, bad), (3, "ssn 123-45-6789"), (4, "of 123-45-6789"), (5, "order 123-45-6789")]
    got = {r.doc_id: (r.spans, r.scores) for r in pii.digest(make(*rows)).collect()}
    assert got[1] == ("iban:5:32", "1.0") and got[3] == ("ssn:4:15", "0.6")
    assert all(got[i] == ("", "") for i in (2, 4, 5))


def test_ibans_end_where_they_pass(make):
    de, spaced, gb = "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"
    texts = {
        f"iban {de} Please pay": [de],
        f"IBAN {spaced} BIC COBADEFFXXX": [spaced],
        f"account {de} 2024": [de],
        f"bank {spaced} 2024 AND MORE CAPITALS 123456": [spaced],
        f"iban {de} {gb} {spaced}, {de}": [de, gb, spaced, de],
        f"{'é🙂' * 510} iban {gb} {gb}": [gb, gb],
        "iban NO93 8601 1117 947 X": ["NO93 8601 1117 947"],
        "iban LC55HEMM000100010012001200023015 Is": ["LC55HEMM000100010012001200023015"],
        f"iban {de}a": [],
        f"iban X{de}": [],
        "iban DE89 3704 0044 0532 0130 01 Please": [],
    }
    got = {r.doc_id: r.spans for r in pii.digest(make(*enumerate(texts))).collect()}
    for i, (text, ibans) in enumerate(texts.items()):
        want, at = [], 0
        for x in ibans:
            at = text.index(x, at)
            want.append(f"iban:{at}:{at + len(x)}")
            at += len(x)
        assert [x for x in got[i].split(",") if x.startswith("iban")] == want, text


def test_context_goes_beyond_neighbouring_matches(make):
    ssns = ["123-45-6789", "987-65-4321", "111-22-3333"]
    close = "SSN list: " + ", ".join(ssns)
    far = f"ssn {'é' * 2040} {ssns[0]} and é🙂 {ssns[1]} ssn {ssns[2]}"  # over the edges of blocks
    got = {r.doc_id: (r.spans, r.scores) for r in pii.digest(make((1, close), (2, far), (3, ", ".join(ssns)))).collect()}
    assert got[1] == ("ssn:10:21,ssn:23:34,ssn:36:47", "0.6,0.6,0.6") and got[3] == ("", "")
    places = [far.index(x) for x in ssns]
    assert got[2][0] == ",".join(f"ssn:{i}:{i + 11}" for i in places)


def test_around_is_the_text_itself(spark):
    rng = random.Random(6)
    texts = ["".join(rng.choices("ab7é🙂\n", k=n)) for n in (1, 30, 1023, 1024, 1025, 5000)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = docs.select("text", spans.around(F.col("text"), spans.located(F.col("text"), "7+"), 40).alias("x"))
    for r in found.collect():
        assert [(x.s, x.e) for x in r.x] == [m.span() for m in re.finditer("7+", r.text)]
        assert all((x.before, x.after) == (r.text[max(0, x.s - 40) : x.s], r.text[x.e : x.e + 40]) for x in r.x)


tokens = pytest.importorskip("public_tokenizers")


def test_token_counts_equal_the_library(make):
    from tokenizers import Tokenizer

    path = tokens.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    whole = lambda t: len(library.encode(t, add_special_tokens=False))
    rng = random.Random(5)
    bits = ["a", "é", "  ", "\n", "'s", "'ll", "12", "x9", "½", "...", "<|endoftext|>", "<|", "\x85", "日本", "🙂", " the"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 300))) for _ in range(150)] + ["", "a" * 3000, "日" * 900, "ab1" * 900]
    for chunk, overlap in ((64, 16), (40, 4), (16_384, 1_024)):
        fast = token_counts.Tokenizer(path, chunk, overlap)
        assert fast.counts(texts) == [whole(t) for t in texts]
        fast.fast = None  # the library itself, in chunks
        assert fast.counts(texts) == [whole(t) for t in texts]
    rows = [*enumerate(texts), (0, None), (500, "the " * 30_000)]
    got = token_counts.digest(make(*rows), path).collect()
    want = sorted((i, len((t or "").encode()), whole(t or ""), whole(t or "") > 1024) for i, t in rows)
    assert sorted(tuple(r) for r in got) == want


def test_other_vocabularies():
    texts = ["Hello  World, this is\na test.", "", "日本語 text"]
    import sentencepiece
    from tokenizers import Tokenizer

    word = Tokenizer.from_file(tokens.path("word_bpe_49k.json"))
    assert token_counts.Tokenizer(tokens.path("word_bpe_49k.json")).counts(texts) == [
        len(word.encode(t, add_special_tokens=False)) for t in texts
    ]
    piece = sentencepiece.SentencePieceProcessor(model_file=tokens.path("piece_bpe_32k.model"))
    assert token_counts.Tokenizer(tokens.path("piece_bpe_32k.model")).counts(texts) == [len(piece.encode(t)) for t in texts]
