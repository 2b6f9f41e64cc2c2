r"""Token counts by overlap resynchronisation.

A text longer than `chunk` code points is encoded in chunks that overlap by `overlap`. Both chunks at an overlap give
token ends (from the tokens' offsets); the texts are spliced at a place that is

* a token end in both chunks, and
* proven stable: the encoder always ends a piece there, whatever stands before or after.

From such a place on, both chunks and the whole text are encoded alike, so counts on either side add up exactly. If
an overlap has no such place (a very long run without one), the left chunk is extended by twice the overlap, then
four times and so on, until one is found or the text ends: the result is exact in every case, and only texts without
any stable place are ever encoded in one piece.

Stable places of byte-level BPE, whose pieces are runs of letters, of digits, of other characters (each with one
space before it at most) or of white space: between a letter or digit and any character that is neither, and between
a character that is not white space and white space. No piece crosses them. Special strings are cut out of the text
before anything else, as the library does by default, and each counts one token.

Encoders: a byte-level BPE file for `tokenizers` (.json) is run with `tiktoken` on the vocabulary's ranks where the
file's twin (.tiktoken) stands beside it and the text is within Latin code points, where both libraries agree; other
texts and other .json files use `tokenizers` itself, .model files `sentencepiece`. Files without byte-level pieces
have no proven places and are encoded whole.

Defined cases: a null or empty text has 0 bytes and 0 tokens; repeated rows get equal results; further columns pass
by, only doc_id and text are read. A text is handled within one row; its chunks bound the encoder's memory.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import sliced

CHUNK = 16_384
OVERLAP = 1_024
LIMIT = 1_024
#: Code points up to here (Latin letters, marks and signs) belong to the same classes in all Unicode versions in use.
LATIN = 0x24F
#: Code points at a chunk's end that the encoder may still see differently (it looks at most three ahead).
MARGIN = 8

#: Ends of the tokens of a text, in code points, ascending; the last one is the text's length.
Ends = Callable[[str], np.ndarray]


def stable(before: str, after: str) -> bool:
    """Whether byte-level pieces always end between these two characters."""
    if before.isalnum():
        return not after.isalnum() and (before + after).isascii()
    return after.isspace() and not before.isspace() and (before + after).isascii()


def _splice(text: str, start: int, left: np.ndarray, end: int, right: np.ndarray, at: int) -> int | None:
    """The last common stable place of chunk [start, end) and the chunk from `at`; ends are absolute."""
    common = np.intersect1d(left[(left > max(at, start)) & (left <= end - MARGIN)], right, assume_unique=False)
    for p in common[::-1].tolist():
        if stable(text[p - 1], text[p]):
            return p
    return None


def count(text: str, ends: Ends, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """The number of tokens of `text`."""
    n = len(text)
    if n <= chunk:
        return len(ends(text)) if n else 0
    total, start, stop, wide = 0, 0, chunk, overlap
    left = ends(text[:stop])  # the chunk that begins at `start`, a true piece boundary
    while stop < n:
        at = max(start, stop - wide)
        to = min(n, at + chunk + wide)
        right = at + ends(text[at:to])
        p = _splice(text, start, left, stop, right, at)
        if p is None:  # alignment failed: the left chunk and the overlap grow
            wide *= 2
            stop = min(n, stop + wide)
            left = start + ends(text[start:stop])
            continue
        total += int(np.searchsorted(left, p, "right"))
        start, stop, wide = p, to, overlap
        left = right[right > p]
    return total + len(left)


class Tokenizer:
    """Counts the tokens of whole texts as the file's library does."""

    def __init__(self, path: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> None:
        self.chunk, self.overlap = chunk, overlap
        self.specials: list[str] = []
        self.fast = None
        self.bytewise = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.whole = lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
            return
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import tokenizers

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = tokenizers.Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        self.model = model
        self.whole = lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]
        kind = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        plain = all(not a[k] for a in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        self.bytewise = (
            kind.get("type") == "ByteLevel" and kind.get("use_regex", True) and not kind.get("add_prefix_space")
        ) and plain and spec.get("normalizer") is None
        if self.bytewise:
            self.specials = [a["content"] for a in added]
            self.fast = _ranks_encoder(path.removesuffix(".json") + ".tiktoken")

    def _ends(self, text: str) -> np.ndarray:
        """By the file's own library; a token that ends within a character gets that character's end."""
        encoded = self.model.encode(text, add_special_tokens=False)
        return np.fromiter((e for _, e in encoded.offsets), np.int64, len(encoded))

    def _fast_ends(self, text: str) -> np.ndarray:
        encoding, sizes = self.fast
        last = np.cumsum(sizes[encoding.encode_ordinary(text)])
        if text.isascii():
            return last
        raw = np.frombuffer(text.encode(), np.uint8)
        return np.cumsum((raw & 0xC0) != 0x80)[last - 1]

    def _pieces(self, text: str) -> tuple[list[str], int]:
        """The text without its special strings, and how many there were."""
        parts, n = [text], 0
        for s in self.specials:
            parts = [q for p in parts for q in p.split(s)] if s in text else parts
            n = len(parts) - 1
        return [p for p in parts if p], n

    def counts(self, texts: list[str]) -> list[int]:
        if not self.bytewise:
            return self.whole(texts)
        out, slow = [0] * len(texts), []
        for i, text in enumerate(texts):
            parts, out[i] = self._pieces(text)
            for part in parts:
                if self.fast and (part.isascii() or max(part) <= chr(LATIN)):
                    if len(part) <= self.chunk:
                        out[i] += len(self.fast[0].encode_ordinary(part))
                    else:
                        out[i] += count(part, self._fast_ends, self.chunk, self.overlap)
                elif len(part) <= self.chunk:
                    slow.append((i, part))
                else:
                    out[i] += count(part, self._ends, self.chunk, self.overlap)
        for (i, _), n in zip(slow, self.whole([p for _, p in slow]), strict=True):
            out[i] += n
        return out


def _ranks_encoder(path: str):
    """tiktoken's encoder and its tokens' sizes in bytes; None without the file."""
    if not os.path.exists(path):
        return None
    import tiktoken
    from public_tokenizers import PATTERN

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), sizes


_LOADED: dict[tuple, Tokenizer] = {}


def counter(path: str, chunk: int, overlap: int, step: int = 64):
    kind = pa.struct([("n_bytes", pa.int64()), ("n_tokens", pa.int64())])

    @F.arrow_udf("struct<n_bytes: bigint, n_tokens: bigint>")
    def tokens(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        key = (path, chunk, overlap)
        model = _LOADED.get(key) or _LOADED.setdefault(key, Tokenizer(*key))
        for texts in sliced(batches):
            out = []
            for i in range(0, len(texts), step):
                some = [t or "" for t in texts[i : i + step].to_pylist()]
                sizes = [len(t) if t.isascii() else len(t.encode()) for t in some]
                out += [{"n_bytes": b, "n_tokens": n} for b, n in zip(sizes, model.counts(some), strict=True)]
            yield pa.array(out, kind)

    return tokens


def digest(
    docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document. `path` must be readable on every executor."""
    counted = docs.select("doc_id", counter(path, chunk, overlap)(F.col("text")).alias("c"))
    return counted.select("doc_id", "c.n_bytes", "c.n_tokens", (F.col("c.n_tokens") > limit).alias("over_limit"))
