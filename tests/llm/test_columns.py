"""Further columns whose names clash with the operators' own, in other letter cases, and repeated doc_ids."""

from __future__ import annotations

import pytest

from dockyard.llm import (
    decontaminate,
    exact_dedup,
    language_crf,
    line_dedup,
    mixing,
    ngram_join,
    phrase_mining,
    pii,
    quality_model,
    quality_rules,
    secret_scan,
    token_alignment,
    token_counts,
)
from dockyard.llm.queries import ALIGNED, VOCABULARY

NAMES = [
    "Row", "SIZE", "Kept", "REP", "Grp", "GRAM", "Of", "S", "Hits", "Spans", "CLASS_ID", "Doc", "Score", "Held_Out",
    "KEY", "Taken", "N_Tokens", "Epoch", "Part", "LEAST", "Band", "W", "Text_2", "Wanted", "Gone_Id", "Line", "Hash",
]
WORDS = "the of and to in that with for some words are here so this text is long enough for every rule and window".split()


@pytest.fixture(scope="module")
def tables(spark):
    def text(i):
        return " ".join(f"{w}{'abcdefghijklmnop'[i] * 2}" for w in WORDS * 4)

    rows = [(i, text(i // 2), "en" if i % 2 else None, f"s{i % 3}", 9, *["c"] * len(NAMES)) for i in range(24)]
    rows += [rows[3], rows[3], (5, "another text of the document", None, None, None, *["c"] * len(NAMES))]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
    docs = spark.createDataFrame(rows, kinds).repartition(3)
    items = spark.createDataFrame([(1, text(3), "x"), (None, text(4), "x"), (2, None, "x")], "item_id long, text string, Row string")
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(24)] * 2, "doc_id long, quality int, OF string")
    return docs, items, labels


def path(name):
    import public_tokenizers

    return public_tokenizers.path(name)


DIGESTS = {
    "op1": lambda d, i, q: token_counts.digest(d, path(VOCABULARY)),
    "op2": lambda d, i, q: decontaminate.digest(d, i),
    "op3": lambda d, i, q: secret_scan.digest(d),
    "op4": lambda d, i, q: mixing.digest(d),
    "op5": lambda d, i, q: ngram_join.digest(d),
    "op6": lambda d, i, q: quality_model.digest(d, q),
    "op7": lambda d, i, q: pii.digest(d),
    "op8": lambda d, i, q: line_dedup.digest(d),
    "op9": lambda d, i, q: language_crf.digest(d),
    "op10": lambda d, i, q: quality_rules.digest(d),
    "op12": lambda d, i, q: token_alignment.digest(d, *map(path, ALIGNED)),
    "op13": lambda d, i, q: exact_dedup.digest(d),
}


@pytest.mark.parametrize("name", DIGESTS)
def test_digests_do_not_see_further_columns(tables, name):
    docs, items, labels = tables
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    got = sorted(map(str, DIGESTS[name](docs, items, labels).collect()))
    assert got == sorted(map(str, DIGESTS[name](plain, items.drop("Row"), labels.drop("OF")).collect()))
    assert len(got) == 27  # one row for every row


def test_phrases_do_not_see_further_columns(tables):
    docs = tables[0]
    got = sorted(map(str, phrase_mining.digest(docs).collect()))
    assert got and got == sorted(map(str, phrase_mining.digest(docs.select("text", "lang")).collect()))


@pytest.mark.parametrize(
    "change",
    [quality_rules.filtered, line_dedup.deduped, ngram_join.deduped, mixing.mixture],
    ids=lambda f: f.__module__.split(".")[-1],
)
def test_further_columns_pass_through(tables, change):
    docs = tables[0]
    out = change(docs)
    mixed = ("epoch", "size", "target", "taken", "text") if change is mixing.mixture else ()
    kept = [c for c in docs.columns if c.lower() not in mixed]
    assert [c for c in out.columns if c in kept] == kept
    assert all(r[c] == "c" for r in out.collect() for c in NAMES if c in kept)


def test_clean_passes_further_columns(tables):
    docs, items, _ = tables
    out = decontaminate.clean(docs, items)
    assert out.columns == docs.columns
    assert {r.doc_id for r in out.collect()} == set(range(24)) - {6, 7, 8, 9}  # both items, with item_id and without
