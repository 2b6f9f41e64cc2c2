"""Near duplicates, decontamination, mixing, components and the pipeline against plain Python."""

from __future__ import annotations

import hashlib
import random
import re

import pytest

import corpus_pipeline
from dockyard.llm import decontaminate, mixing, ngram_join, queries
from dockyard.llm.components import components


def roots(nodes, pairs):
    of = {n: n for n in nodes}

    def find(n):
        while of[n] != n:
            n = of[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        of[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(5000, 5000 + i) for i in range(200)] + pairs[:5] + [(7, 7)]
    got = components(spark.createDataFrame(pairs, "a long, b long"))
    nodes = {n for a, b in pairs if a != b for n in (a, b)}
    assert sorted(tuple(r) for r in got.collect()) == sorted(roots(nodes, [p for p in pairs if p[0] != p[1]]).items())
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def grams(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def near(rows, threshold=0.8):
    sets = [(i, grams(t)) for i, t in rows]
    links, pairs = [0] * len(rows), []
    for x, (a, s) in enumerate(sets):
        for y in range(x):
            b, t = sets[y]
            if s and len(s & t) >= threshold * len(s | t) - 1e-9:
                links[x] += 1
                links[y] += 1
                pairs.append((a, b))
    root = roots({i for i, _ in rows}, pairs)
    return sorted((i, root[i], n) for (i, _), n in zip(rows, links, strict=True))


def copies(rng, n_base=12, n_copies=8, words=60):
    rows, i = [], 0
    for b in range(n_base):
        base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
        for c in range(n_copies):
            text = list(base)
            for _ in range(c % 4):
                text[rng.randrange(words)] = f"x{rng.randrange(10**6)}"
            rows.append((i, " ".join(text)))
            i += 1
    return rows


@pytest.mark.parametrize("block", [1024, 5])
def test_ngram_join(make, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)  # small blocks: pairs of blocks and empty blocks
    rng = random.Random(2)
    rows = copies(rng) + [(900, None), (901, ""), (902, "one"), (903, "one"), (904, "a b"), (905, "a b c d e f")]
    rng.shuffle(rows)
    got = ngram_join.digest(make(*rows))
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in got.collect()) == near(rows)


def test_ngram_join_of_repeated_documents(make):
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(40)) for x in "abcd")
    near_c = c + " end"
    rows = [(7, a), (7, a), (7, a), (7, b), (9, b), (3, near_c), (3, near_c), (5, c), (4, a), (1, d), (1, d), (6, None)]
    rows += [(8, c), (8, None), (2, d)]
    got = sorted(tuple(r) for r in ngram_join.digest(make(*rows)).collect())
    want = {  # doc_id: class_id, n_links, n_copies
        7: (4, 2, 3), 9: (4, 1, 2), 4: (4, 1, 2), 3: (3, 2, 1), 5: (3, 2, 2), 8: (3, 2, 2), 1: (1, 1, 2), 2: (1, 1, 2),
        6: (6, 0, 1),
    }
    assert got == sorted((i, *want[i]) for i, _ in rows)
    assert {r.doc_id for r in ngram_join.deduped(make(*rows)).collect()} == {1, 3, 4, 6}


def test_ngram_join_keeps_one_of_each_class(make):
    rows = copies(random.Random(3), 4, 6) + [(None, "x y"), (800, "alone here"), (801, None)]
    docs = make(*rows)
    out = ngram_join.deduped(docs)
    assert out.columns == docs.columns
    least = {c for _, c, _ in near([r for r in rows if r[0] is not None])}
    assert {r.doc_id for r in out.collect()} == least | {None}
    assert ngram_join.digest(docs.where("false")).count() == 0
    assert ngram_join.deduped(docs.where("doc_id = 800")).count() == 1


def templates(rng, n, shared=120, own=80):
    """Texts with a common template: any two have a similarity of about 0.41."""
    base = " ".join(f"t{i}" for i in range(shared))
    return [(i, base + " " + " ".join(f"u{rng.randrange(10**9)}" for _ in range(own))) for i in range(n)]


def test_ngram_join_of_templates_is_linear(make, monkeypatch):
    """Texts that share a template and no link are compared with nobody; near copies among them keep all links."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 16)
    compared, blocks = [], ngram_join._blocks

    def counted(dealt):
        out = blocks(dealt)
        compared.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "_blocks", counted)
    rng = random.Random(11)
    sizes = (150, 300)
    for n in sizes:
        rows = templates(rng, n)
        rows += [(n + i, text.replace("t60 ", f"v{i} ")) for i, text in rows[:20]]  # a template with a slot: links of 0.95
        rng.shuffle(rows)
        got = ngram_join.digest(make(*rows)).collect()
        assert sorted((r.doc_id, r.class_id, r.n_links) for r in got) == near(rows)
    assert compared == [40, 40]  # the 20 pairs alone, whatever the number of templates


def test_ngram_join_of_mixed_passages_loses_no_link(make, monkeypatch):
    """Texts out of few passages, so that rare n-grams overlap in all ways: splitting groups changes no result."""
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", 8)
    rng = random.Random(13)
    passages = [" ".join(f"p{i}w{k}" for k in range(rng.randrange(5, 40))) for i in range(14)]
    rows = []
    for i in range(160):
        picked = sorted(rng.sample(range(14), rng.choice([7, 11, 12, 13])))
        if i % 5 == 0:
            rng.shuffle(picked)
        rows.append((i, " ".join(passages[x] for x in picked)))
    want = near(rows)
    assert 0 < sum(n > 0 for _, _, n in want) < len(rows)
    assert sorted((r.doc_id, r.class_id, r.n_links) for r in ngram_join.digest(make(*rows)).collect()) == want


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_ngram_join_finds_all_links_of_the_given_documents(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in queries.QUERIES["op5_ngram_join"](spark, f"/root/testdata/{sf}").collect())
    want = near([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert sum(n for _, _, n in want) > 0
    assert got == want


def test_bands_reach_the_recall():
    bands, rows = ngram_join.bands_for(0.8, 0.9999)
    assert 1 - (1 - 0.8**rows) ** bands >= 0.9999 > 1 - (1 - 0.8**rows) ** (bands - 1)


def distance(item, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row = row, [i] + [0] * len(text)
        for j, d in enumerate(text, 1):
            row[j] = min(last[j - 1] + (c != d), last[j] + 1, row[j - 1] + 1)
    return min(row)


def edited(rng, text, n):
    text = list(text)
    for _ in range(n):
        if not text:
            break
        at = rng.randrange(len(text))
        match rng.randrange(3):
            case 0:
                text[at] = "z"
            case 1:
                del text[at]
            case _:
                text.insert(at, "q")
    return "".join(text)


def test_myers_is_the_edit_distance():
    rng = random.Random(4)
    for _ in range(150):
        item = "".join(rng.choices("abc ", k=rng.randint(1, 90)))
        text = "".join(rng.choices("abc ", k=rng.randint(0, 60)))
        if rng.random() < 0.5:
            text += edited(rng, item, 3) + text
        assert decontaminate.myers(item, text) == distance(item, text)


def test_decontamination(make, spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefgh", k=rng.randint(2, 7)))
    items = [(i, " ".join(word() for _ in range(rng.randint(12, 40)))) for i in range(12)]
    items += [(50, None), (51, ""), (52, "short"), (53, items[0][1]), (None, "n" * 60)]
    rows = [(900, None), (901, ""), (902, "short"), (903, "n" * 60)]
    for i in range(60):
        item = rng.choice(items[:12])[1]
        inside = edited(rng, item, rng.randrange(0, len(item) // 8))
        inside = inside.upper().replace(" ", "\n ") if i % 3 == 0 else inside
        rows.append((i, " ".join(word() for _ in range(30)) + " " + inside + " " + word()))
    bench = spark.createDataFrame(items, "item_id long, text string")
    want = {}
    for i, text in rows:
        hits = []
        for item_id, item in items:
            item = decontaminate.normal(item)
            if item and (len(item) >= 40 or f" {item} " in f" {decontaminate.normal(text)} "):
                d = distance(item, decontaminate.normal(text)) if len(item) >= 40 else 0
                if d <= decontaminate.budget(len(item), 0.05):
                    hits.append((item_id, d))
        want[i] = sorted(hits, key=lambda h: (h[0] is not None, h))
    docs = make(*rows)
    for size in (4_000_000, 600):  # one group, several groups
        found = decontaminate.contaminations(docs, bench, group_chars=size)
        # However many groups there are, at most one automaton is alive in a task.
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("ArrowEvalPython") <= 1
        got = found.select("row.doc_id", "hits").collect()
        assert {r.doc_id: [tuple(h) for h in r.hits] for r in got} == want
    assert any(d for h in want.values() for _, d in h) and not all(want.values())
    clean = decontaminate.clean(docs, bench)
    assert {r.doc_id for r in clean.collect()} == {i for i, h in want.items() if not h}
    assert clean.columns == docs.columns
    assert decontaminate.clean(docs, bench.where("false")).count() == len(rows)


def test_decontamination_in_many_groups(make, spark):
    """Rows that share a doc_id, repeated rows and rows without doc_id, in one pass and in many."""
    items = [(i, f"item number {i} " + "abcdefghij klmnop " * 3 + str(i) * 20) for i in range(12)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(1, f"before {items[3][1]} after {items[7][1]}"), (1, "clean text"), (1, items[5][1]), (2, items[5][1]), (2, items[5][1])]
    rows += [(None, items[0][1]), (None, "clean"), (3, None), (4, "")]
    docs = make(*rows)
    key = lambda df: sorted((str(r.doc_id), r.n_items, r.item_ids, r.contaminated) for r in df.collect())
    one, many = (
        decontaminate.contaminations(docs, bench, group_chars=n).select("row.doc_id", "row.text", "hits") for n in (10**6, 60)
    )
    as_set = lambda df: sorted((str(r.doc_id), str(r.text), tuple(map(tuple, r.hits))) for r in df.collect())
    assert as_set(one) == as_set(many) and one.count() == len(rows)
    assert [x[1:] for x in key(decontaminate.digest(docs, bench)) if x[0] == "1"] == [(0, "", False), (1, "5", True), (2, "3,7", True)]


def test_short_items_are_found_exactly(make, spark, tmp_dir):
    long = "a question that is long enough to be looked for with edits"
    items = [(1, "Who  wrote Hamlet?"), (2, "abba"), (3, "abab"), (4, "C++"), (5, long), (6, None), (7, " "), (8, "été")]
    texts = {
        "so: who wrote\nhamlet? nobody": [1], "who wrote hamlet": [], "x abba y": [2], "xabba abbay": [], "ababab": [],
        "abab abab": [3], "in c++, and": [4], "abc++": [], long.replace("long", "lng"): [5], "étés": [], "(été)": [8],
        "xabba abba": [2],
    }
    bench = spark.createDataFrame(items, "item_id long, text string")
    make(*enumerate(texts), (99, None)).write.parquet(f"{tmp_dir}/documents.parquet")
    bench.write.parquet(f"{tmp_dir}/benchmark.parquet")
    got = {r.doc_id: r.item_ids for r in queries.op2_decontamination(spark, tmp_dir).collect()}
    want = {i: ",".join(map(str, ids)) for i, ids in enumerate(texts.values())} | {99: ""}
    assert got == want
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.benchmark(spark, docs, tmp_dir).collect()}
    assert kept == {i for i, x in want.items() if not x}


def mix(rows, weights=(5, 2, 1), most=3):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for _, _, s in rows}, key=lambda s: (s is None, s or ""))
    total = {n: sum(z for z, (_, _, s) in zip(size, rows, strict=True) if s == n) for n in names}
    weight = {n: weights[i % len(weights)] for i, n in enumerate(names)}
    target, open_ = {}, list(names)
    while open_:
        left = sum(total.values()) - sum(target.values())
        rate = left / sum(weight[n] for n in open_)
        full = [n for n in open_ if rate * weight[n] > most * total[n]]
        if not full:
            target |= {n: rate * weight[n] for n in open_}
            break
        target |= {n: most * total[n] for n in full}
        open_ = [n for n in open_ if n not in full]
    return size, total, target


def test_mixing(make):
    rng = random.Random(6)
    rows = [(i, "w " * rng.randint(0, 40), rng.choice(["a", "b", "c", "d", "É", None])) for i in range(300)]
    rows += [(i, "hot " * 30, "b") for i in range(300, 500)] + [(900, None, "zero"), (901, "", "zero"), (902, "x", "one")]
    rows += [(950, "same same", "a")] * 3 + [(None, "no id", "c")]
    got = mixing.digest(make(*rows)).collect()
    size, total, target = mix(rows)
    assert len(got) == len(rows)
    source = {(i, len((t or "").split())): s for i, t, s in rows}
    taken = {n: 0 for n in total}
    for r in got:
        s = source[r.doc_id, r.size]
        taken[s] += r.taken
        assert r.source_size == total[s] and r.target == pytest.approx(target[s]) and 0 <= r.taken <= 3 * r.size
    for n, words in taken.items():
        assert target[n] - 4 <= words <= target[n] + 1e-6
    assert sorted(map(str, got)) == sorted(map(str, mixing.digest(make(*rows[::-1])).collect()))
    # random order: the documents of the last epoch are the first ones by hash
    last = [r for r in got if source[r.doc_id, r.size] == "b"]
    epochs = min(r.taken // r.size for r in last if r.size)
    key = lambda r: hashlib.md5(f"{mixing.SEED}{r.doc_id}".encode()).hexdigest()
    more = [r.taken > epochs * r.size for r in sorted(last, key=key) if r.size]
    assert more == sorted(more, reverse=True)


def test_mixture_repeats_and_cuts(make):
    rows = [(i, "a  b\nc d e", s) for i, s in enumerate("xxxyyyyyyyyz")]
    docs = make(*rows)
    share = {r.doc_id: r.taken for r in mixing.digest(docs).collect()}
    out = mixing.mixture(docs)
    words = {}
    for r in out.collect():
        words[r.doc_id] = words.get(r.doc_id, 0) + len(r.text.split())
        assert "a  b\nc d e".startswith(r.text)
    assert words == {i: n for i, n in share.items() if n}
    assert mixing.mixture(docs.where("false")).count() == 0


def test_pipeline(spark, tmp_dir):
    rng = random.Random(7)
    stop = ["the", "of", "and", "a", "is", "to"]
    text = lambda n=90: " ".join(x for _ in range(n) for x in (rng.choice(stop), f"w{rng.randrange(10**5)}y"))
    item = text(20)
    rows = [(i, text(), f"s{i % 3}") for i in range(30)]
    rows += [(100 + i, rows[i][1] + (" end" if i % 2 else ""), "s0") for i in range(5)]  # copies
    rows += [(200, "too short", "s1"), (201, None, "s1"), (202, text() + " " + item + " " + text(), "s2")]
    line = "a line that many of the documents share, word by word"
    rows += [(300 + i, text() + "\n" + line, "s2") for i in range(6)]
    full = [(i, t, "en", s, len(t or "")) for i, t, s in rows]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(full, schema).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    kept = {*range(30), *range(300, 306)}
    docs = spark.read.parquet(f"{tmp_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, tmp_dir)
        assert docs.columns == columns, name
    before = {r.doc_id: r for r in docs.collect()}
    assert set(before) == kept
    assert [i for i, r in before.items() if line in r.text] == [305]
    assert all(r.n_chars == len(r.text) for r in before.values())
    out = corpus_pipeline.run(spark, tmp_dir).collect()
    got, want = {}, {r.doc_id: r.taken for r in mixing.digest(docs).collect()}
    for r in out:
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {i: n for i, n in want.items() if n}
