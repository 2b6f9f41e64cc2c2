"""Language ID: a linear-chain conditional random field over the words of a text.

Words are runs of letters (Unicode category L) of the lower-cased text. Each word's features are its prefixes and suffixes of 1 to 4 bytes,
its byte trigrams, the word itself (all hashed into one weight table) and, for each language, whether the word is in
that language's learned lexicon. Transitions and start weights are learned too. Forward-backward gives each word's
probabilities; a text's language is the one with the largest sum, its score that sum's share, and a code-switched
text thus gets the language of most of its words.

Forward-backward runs on all words of a batch as one chain that restarts at each text: the chain is cut into blocks,
every block's transfer matrix is computed for all blocks at once, a short loop joins the blocks, and a second pass
fills them in. The result is exact; a text of any length costs the same per word. A text of more than `MAX_BYTES` is
passed twice in portions: once for their transfer matrices, which give the messages at each portion's ends, and once
to fill them in with these, so its chain is one chain too.

The fit takes a bounded sample: per language, of the distinct (doc_id, text) that are not held out and have at most
`MAX_FIT_CHARS` code points, the `MAX_FIT` first in the order of a hash of both, and `MAX_ROWS` in all: with very many
languages each gives fewer, and beyond `MAX_ROWS` languages the rarest are not learned. Lines of different documents are mixed into
training sequences, so that transitions between languages are seen. Only text and lang are learned from; lang,
source and doc_id are never inputs of a prediction.

Defined cases: a null text or one without a letter is `und` with score 0; ties go to the language first by name;
rows without doc_id are neither held out nor learned from; without any language to learn from, every text is `und`;
number signs, marks and symbols are no letters; repeated rows get equal results and count once in the fit.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.shared import sliced, stored

MAX_FIT = 300
MAX_ROWS = 6_000
MAX_FIT_CHARS = 20_000
MAX_BYTES = 500_000
#: Parts of a language that are ranked on their own before its fitting sample is taken.
PARTS = 64
#: Size of the hashed weight table (a power of two) and words per language in the lexicon.
BUCKETS, LEXICON = 1 << 16, 300
EPOCHS, STEP, DECAY = 6, 0.3, 1e-4
LINES = 6
BLOCK = 128
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")
_OTHER = regex.compile(r"[^\p{L}\x00-\x7f]+")
_WORD_END = regex.compile(rb"[^a-z\x80-\xff]")
_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[list(range(97, 123)) + list(range(128, 256))] = True
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _bucket(x: np.ndarray, kind: int, buckets: int) -> np.ndarray:
    x = (x.astype(np.uint64) * np.uint64(32) + np.uint64(kind)) * _MIX
    return (x >> np.uint64(64 - (buckets.bit_length() - 1))).astype(np.int32)


def raw_of(text: str) -> bytes:
    """The text's bytes, lower-cased; bytes over 127 are letters' alone."""
    text = text.lower()
    return (text if text.isascii() else _OTHER.sub(" ", text)).encode()


@dataclass
class Words:
    """The words of joined texts, with hashed features."""

    affix: np.ndarray  # (words, 8) buckets of prefixes and suffixes
    grams: np.ndarray  # buckets of all trigrams
    first: np.ndarray  # of each word, its first trigram; one more at the end
    whole: np.ndarray  # 64-bit word hashes
    at: np.ndarray  # byte at which each word starts


def words_of(raw: bytes, buckets: int = BUCKETS) -> Words:
    b = np.frombuffer(raw, np.uint8)
    letter = np.concatenate([[False], _IS_LETTER[b], [False]])
    edge = np.flatnonzero(letter[1:] != letter[:-1])
    start, end = edge[::2], edge[1::2]
    size = end - start
    with np.errstate(over="ignore"):
        wide = np.concatenate([b, np.zeros(4, np.uint8)]).astype(np.uint64)
        four = wide[:-4] | wide[1:-3] << np.uint64(8) | wide[2:-2] << np.uint64(16) | wide[3:-1] << np.uint64(24)
        affix = np.empty((len(start), 8), np.int32)
        for k in range(1, 5):
            mask = np.uint64((1 << 8 * k) - 1)
            n = np.minimum(size, k).astype(np.uint64) * np.uint64(8)
            short = (np.uint64(1) << n) - np.uint64(1)
            affix[:, k - 1] = _bucket(four[start] & mask & short, k, buckets)
            affix[:, k + 3] = _bucket(four[np.maximum(end - k, start)] & mask & short, k + 4, buckets)
        # Trigrams of the word with one mark on either side: every letter with both neighbours.
        inside = np.flatnonzero(letter[1:-1])
        spread = np.where(letter[1:-1], b, 32).astype(np.uint64)
        prior, later = np.roll(spread, 1), np.roll(spread, -1)
        if len(b):
            prior[0], later[-1] = 32, 32
        code = spread[inside] | prior[inside] << np.uint64(8) | later[inside] << np.uint64(16)
        grams = _bucket(code, 9, buckets)
        first = np.concatenate([[0], np.cumsum(size)])
        # Whole words: a polynomial hash by running sums, with the power at the start divided out.
        power = np.full(len(b) + 1, 0x100000001B3, np.uint64)
        power[0] = 1
        power = np.cumprod(power)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:-1])])
        inverse = np.full(len(b) + 1, pow(0x100000001B3, -1, 1 << 64), np.uint64)
        inverse[0] = 1
        whole = (sums[end] - sums[start]) * np.cumprod(inverse)[start]
    return Words(affix, grams, first, whole, start)


def _transfers(emit: np.ndarray, fresh: np.ndarray, trans: np.ndarray, begin: np.ndarray, block: int):
    """Weights and restarts by block, linear transition weights, and each block's transfer matrix."""
    n, k = emit.shape
    nb = -(-n // block)
    em = np.ones((nb * block, k))
    em[:n] = np.exp(emit - emit.max(axis=1, keepdims=True))
    new = np.zeros(nb * block, bool)
    new[:n], new[n:] = fresh, True
    a, s = np.exp(trans - trans.max()), np.exp(begin - begin.max())
    em, new = em.reshape(nb, block, k), new.reshape(nb, block)
    transfer = np.broadcast_to(np.eye(k), (nb, k, k)).copy()
    restarts = [np.flatnonzero(new[:, t]) for t in range(block)]
    for t in range(block):
        step = (transfer.reshape(-1, k) @ a).reshape(nb, k, k)
        if len(r := restarts[t]):
            step[r] = transfer[r].sum(axis=2, keepdims=True) * s
        step *= em[:, t, None, :]
        transfer = step / step.sum(axis=(1, 2), keepdims=True)
    return em, new, restarts, a, s, transfer


def transfer_of(emit: np.ndarray, fresh: np.ndarray, trans: np.ndarray, begin: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """The transfer matrix of all words together, up to a factor."""
    *_, transfer = _transfers(emit, fresh, trans, begin, block)
    whole = np.eye(emit.shape[1])
    for t in transfer:
        whole = whole @ t
        whole /= whole.sum()
    return whole


def posteriors(
    emit: np.ndarray,
    fresh: np.ndarray,
    trans: np.ndarray,
    begin: np.ndarray,
    block: int = BLOCK,
    pairs: bool = False,
    before: np.ndarray | None = None,
    after: np.ndarray | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Probabilities of each word's labels, and with `pairs` the expected transitions and starts.

    `emit` has log weights (words, labels), `fresh` marks words that begin a sequence; `trans` and `begin` are log
    weights. The words may be a part of a longer chain: `before` and `after` are the messages at its ends, and with
    `after` the words must fill their blocks.
    """
    n, k = emit.shape
    if before is None:
        fresh = np.concatenate([[True], fresh[1:]])
    em, new, restarts, a, s, transfer = _transfers(emit, fresh, trans, begin, block)
    nb = len(em)
    into, out = np.empty((nb, k)), np.empty((nb, k))
    v = np.full(k, 1 / k) if before is None else before
    for i in range(nb):
        into[i] = v
        v = v @ transfer[i]
        v = v / v.sum()
    v = np.full(k, 1 / k) if after is None else after
    for i in range(nb - 1, -1, -1):
        out[i] = v
        v = transfer[i] @ v
        v = v / v.sum()
    alpha, beta = np.empty_like(em), np.empty_like(em)
    v = into
    for t in range(block):
        step = v @ a
        if len(r := restarts[t]):
            step[r] = v[r].sum(axis=1, keepdims=True) * s
        step *= em[:, t]
        v = alpha[:, t] = step / step.sum(axis=1, keepdims=True)
    v = out
    for t in range(block - 1, -1, -1):
        beta[:, t] = v
        u = em[:, t] * v
        step = u @ a.T
        if len(r := restarts[t]):
            step[r] = 1.0
        v = step / step.sum(axis=1, keepdims=True)
    alpha, beta = alpha.reshape(-1, k)[:n], beta.reshape(-1, k)[:n]
    p = alpha * beta
    p /= p.sum(axis=1, keepdims=True)
    if not pairs:
        return p, a, s
    em, new = em.reshape(-1, k)[:n], new.reshape(-1)[:n]
    on = np.flatnonzero(~new)
    x = alpha[on - 1][:, :, None] * a * (em[on] * beta[on])[:, None, :]
    x /= x.sum(axis=(1, 2), keepdims=True)
    return p, x.sum(axis=0), p[new].sum(axis=0)


@dataclass
class LanguageField:
    """The fitted field. `lexicon` has sorted word hashes, `listed` which languages list each."""

    labels: list[str]
    table: np.ndarray
    lexicon: np.ndarray
    listed: np.ndarray
    lexical: np.ndarray
    trans: np.ndarray
    begin: np.ndarray

    def in_lexicon(self, w: Words) -> np.ndarray:
        if not len(self.lexicon):
            return np.zeros((len(w.whole), len(self.labels)), np.float32)
        i = np.minimum(np.searchsorted(self.lexicon, w.whole), len(self.lexicon) - 1)
        return self.listed[i] * (self.lexicon[i] == w.whole)[:, None]

    def emissions(self, w: Words) -> np.ndarray:
        table = self.table
        out = self.in_lexicon(w) @ self.lexical.astype(table.dtype)
        for ids in (*w.affix.T, _bucket(w.whole, 10, len(table))):
            out += table.take(ids, axis=0)
        return out + np.add.reduceat(table.take(w.grams, axis=0), w.first[:-1], axis=0)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text."""
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        some, size = [], 0
        for i, t in enumerate(texts):
            if t and self.labels and _LETTER.search(t):
                raw = raw_of(t)
                if len(raw) > MAX_BYTES:
                    out[i] = self._named(self.long_sums(raw))
                    continue
                if size + len(raw) > MAX_BYTES:
                    self._predict(some, out)
                    some, size = [], 0
                some.append((i, raw))
                size += len(raw)
        if some:
            self._predict(some, out)
        return out

    def _named(self, total: np.ndarray) -> tuple[str, float]:
        if not total.any():
            return UNKNOWN, 0.0
        best = int(total.argmax())
        return self.labels[best], float(total[best] / total.sum())

    def _predict(self, some: list[tuple[int, bytes]], out: list[tuple[str, float]]) -> None:
        w = words_of(b"\n".join(raw for _, raw in some) + b"\n")
        if not len(w.at):
            return
        ends = np.cumsum([len(raw) + 1 for _, raw in some])
        owner = np.searchsorted(ends, w.at, "right")
        fresh = np.concatenate([[True], owner[1:] != owner[:-1]])
        p, _, _ = posteriors(self.emissions(w), fresh, self.trans, self.begin)
        begins = np.flatnonzero(fresh)
        for o, total in zip(owner[begins], np.add.reduceat(p, begins, axis=0), strict=True):
            out[some[o][0]] = self._named(total)

    def long_sums(self, raw: bytes, size: int | None = None, block: int = BLOCK) -> np.ndarray:
        """The sums of the words' probabilities of one text, passed in portions of about `size` bytes."""
        k = len(self.labels)
        cuts = _portions(raw, size or MAX_BYTES, block)
        ends = list(zip(cuts, cuts[1:], strict=False))
        fresh = lambda i, n: np.concatenate([[i == 0], np.zeros(n - 1, bool)])
        transfers = []
        for i, (a, b) in enumerate(ends):
            e = self.emissions(words_of(raw[a:b]))
            transfers.append(transfer_of(e, fresh(i, len(e)), self.trans, self.begin, block))
        before, after = [np.full(k, 1 / k)], [np.full(k, 1 / k)]
        for t in transfers[:-1]:
            v = before[-1] @ t
            before.append(v / v.sum())
        for t in transfers[:0:-1]:
            v = t @ after[-1]
            after.append(v / v.sum())
        total = np.zeros(k)
        for i, (a, b) in enumerate(ends):
            e = self.emissions(words_of(raw[a:b]))
            ends_ = {"before": before[i] if i else None, "after": after[-1 - i] if i < len(ends) - 1 else None}
            total += posteriors(e, fresh(i, len(e)), self.trans, self.begin, block, **ends_)[0].sum(axis=0)
        return total


def _portions(raw: bytes, size: int, block: int) -> list[int]:
    """Places that cut `raw` into portions of about `size` bytes; all but the last have whole blocks of words."""
    cuts, wide = [0], size
    while True:
        found = _WORD_END.search(raw, cuts[-1] + wide)
        words = words_of(raw[cuts[-1] : found.end() if found else len(raw)])
        n = len(words.at) // block * block
        if found and n:
            cuts.append(cuts[-1] + (int(words.at[n]) if n < len(words.at) else found.end() - cuts[-1]))
            wide = size
        elif found:
            wide *= 2  # fewer words than a block
        else:
            if len(words.at) or len(cuts) == 1:
                return [*cuts, len(raw)]
            return [*cuts[:-1], len(raw)]  # no word follows the last cut


def _lexicon(rows: list[tuple[str, str]], labels: list[str], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words that most documents of a language hold, and which languages list each."""
    listed: dict[int, set[int]] = {}
    for k, lang in enumerate(labels):
        held: Counter = Counter()
        for text, own in rows:
            if own == lang:
                held.update(set(words_of(raw_of(text) + b"\n").whole.tolist()))
        top = sorted(((n, h) for h, n in held.items() if n > 1), reverse=True)[:size]
        for _, h in top:
            listed.setdefault(h, set()).add(k)
    words = np.array(sorted(listed), np.uint64)
    marks = np.zeros((len(words), len(labels)), np.float32)
    for i, h in enumerate(words.tolist()):
        marks[i, list(listed[h])] = 1
    return words, marks


def train(rows: list[tuple[str, str]], epochs: int = EPOCHS) -> LanguageField:
    """Maximum likelihood with AdaGrad over mixed lines of the (text, lang) rows."""
    labels = sorted({lang for _, lang in rows})
    k = len(labels)
    words, marks = _lexicon(rows, labels, LEXICON)
    zero = lambda *shape: np.zeros(shape)
    field = LanguageField(labels, zero(BUCKETS, k), words, marks, zero(k, k), zero(k, k), zero(k))
    lines = [(raw_of(x), labels.index(lang)) for text, lang in rows for x in text.split("\n") if x.strip()]
    lines.sort(key=lambda x: xxhash.xxh64_intdigest(x[0]))  # a fixed shuffle
    size, part, parts = 0, [], []
    for line in lines:
        part.append(line)
        size += len(line[0])
        if size > 100_000:
            parts.append(part)
            part, size = [], 0
    parts += [part] if part else []
    ready = []
    for part in parts:
        w = words_of(b"\n".join(raw for raw, _ in part) + b"\n")
        if len(w.at):
            owner = np.searchsorted(np.cumsum([len(raw) + 1 for raw, _ in part]), w.at, "right")
            first = np.concatenate([[True], owner[1:] != owner[:-1]])
            ready.append((w, np.array([y for _, y in part])[owner], first & (owner % LINES == 0)))
    weights = [field.table, field.lexical, field.trans, field.begin]
    past = [np.full_like(x, 1e-6) for x in weights]
    for _ in range(epochs):
        for w, y, fresh in ready:
            fresh = fresh.copy()
            fresh[0] = True
            p, pair, begins = posteriors(field.emissions(w), fresh, field.trans, field.begin, pairs=True)
            d = -p
            d[np.arange(len(y)), y] += 1
            on = np.flatnonzero(~fresh)
            seen = np.zeros((k, k))
            np.add.at(seen, (y[on - 1], y[on]), 1)
            of_gram = np.repeat(np.arange(len(y)), np.diff(w.first))
            ids = np.concatenate([w.affix.T.ravel(), _bucket(w.whole, 10, BUCKETS), w.grams])
            rows_of = np.concatenate([np.tile(np.arange(len(y)), 9), of_gram])
            table = np.stack([np.bincount(ids, d[rows_of, c], BUCKETS) for c in range(k)], axis=1)
            grads = [table, field.in_lexicon(w).T @ d, seen - pair, np.bincount(y[fresh], minlength=k) - begins]
            for x, g, h in zip(weights, grads, past, strict=True):
                g = g / len(y) - DECAY * x / len(ready)
                h += g * g
                x += STEP * g / np.sqrt(h)
    field.table = field.table.astype(np.float32)
    return field


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, max_fit: int = MAX_FIT, max_chars: int = MAX_FIT_CHARS, max_rows: int = MAX_ROWS) -> LanguageField:
    """The field of `max_fit` documents per language and `max_rows` in all at most, none of them held out."""
    ok = F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & ~held_out(F.col("doc_id"))
    short = (F.length("text") <= max_chars) & F.col("text").rlike(r"\p{L}")
    fits = docs.where(ok & short).select("doc_id", "lang", F.xxhash64("doc_id", "text").alias("h"), "text")
    ids = fits.select("doc_id", "lang", "h")
    langs = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    langs = langs.orderBy(F.desc("n"), "lang").limit(max_rows).select(F.col("lang").alias("of"))
    quota = min(max_fit, max_rows // max(1, langs.count()))
    ids = ids.join(F.broadcast(langs), F.col("lang") == F.col("of")).drop("of")  # max_rows languages at most
    ids = ids.distinct().withColumn("part", F.pmod("h", F.lit(PARTS)))
    for keys in (("lang", "part"), ("lang",)):  # first within parts, so that no task ranks a whole language
        place = F.row_number().over(Window.partitionBy(*keys).orderBy("h", "doc_id"))
        ids = ids.withColumn("place", place).where(F.col("place") <= quota)
    ids = stored(ids.select(F.col("doc_id").alias("of"), F.col("lang").alias("y"), F.col("h").alias("of_h")), "language-fit")
    own = (F.col("doc_id") == F.col("of")) & (F.col("lang") == F.col("y")) & (F.col("h") == F.col("of_h"))
    # max_rows ids at most; a row that stands there many times is reduced to one in each task first.
    rows = fits.join(F.broadcast(ids), own).groupBy("doc_id", "lang", "h").agg(F.min("text").alias("text"))
    found = rows.select("doc_id", "text", "lang").collect()
    return train([(r.text, r.lang) for r in sorted(found, key=lambda r: (r.lang, r.doc_id, r.text))])


def predicted(docs: DataFrame, field: LanguageField) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    @F.arrow_udf("struct<lang: string, score: double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = shared.value
        for texts in sliced(batches, 512):
            found = model.predict(texts.to_pylist())
            yield pa.array([{"lang": lang, "score": score} for lang, score in found], kind)

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text")).alias("p"))
    return rows.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"), F.col("p.score").alias("score"))


def digest(docs: DataFrame) -> DataFrame:
    return predicted(docs, fit(docs))
