r"""Secret scan: credentials by pattern, and weak parts only where complementary parts stand close.

Strong kinds are reported wherever they stand (leftmost, non-overlapping per kind):

* assign `(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)`, the key in either
  case, with a value of 12 or more characters;
* access `AKIA[A-Z0-9]+` of 18 or more; hex `[0-9a-f]+` of 16 or more.

Weak kinds prove nothing alone: ident (a user, login or client id assigned), opaque (a run of 20 or more characters
with letters and digits) and endpoint (a URL or an address with a port). Parts play a role (identifier, secret or
endpoint). A weak part is reported when a part of another role stands in the same scope: the same document, `reach`
code points or fewer between them. That is an interval join: parts are rows, in buckets of `reach` code points, and
a semi-join on (document, bucket) looks at the buckets that a weak part can reach. It never makes pairs, and a
document with very many parts is spread over its buckets.

Only built-in functions. Defined cases: a null or empty text has no spans; repeated rows get equal results; an
opaque part that overlaps a strong span is not a part (an ident or endpoint that does is one); further columns pass by, only doc_id and text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import stored
from dockyard.llm.spans import listed, located, tagged

KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint")
BASE = 3
REACH = 200
#: Role of each kind, in the order of KINDS: i identifier, s secret, e endpoint.
ROLES = ("s", "i", "s", "i", "s", "e")
#: Possessive forms of the patterns above: the same matches, without backtracking.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?+[A-Za-z0-9+/_.=-]++"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*+[:=]\x20*+["']?+([A-Za-z0-9+/_.=-]++)"""
ACCESS = r"AKIA[A-Z0-9]{14,}+"
HEX = r"(?<![0-9a-f])[0-9a-f]{16,}+"
IDENT = r"""(?i:user(?:name)?|login|client_?id|account)["']?\x20*+[:=]\x20*+["']?+[A-Za-z0-9@._-]{3,}+"""
OPAQUE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}+"
ENDPOINT = r"""[a-z][a-z0-9+.-]{1,12}://[^\x20\x09-\x0D"'<>]++|(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}:[0-9]{2,5}(?![0-9])"""


def _apart(spans: Column, others: Column) -> Column:
    hit = lambda x: F.exists(others, lambda o: (o["s"] < x["e"]) & (x["s"] < o["e"]))
    return F.when(F.size(spans) > 0, F.filter(spans, lambda x: ~hit(x))).otherwise(spans)


def parts(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (hash of the text) and the sorted (s, k, e) of `base` and of the weak parts `weak`."""
    text = F.coalesce("text", F.lit(""))
    long_value = lambda x: F.length(F.regexp_extract(x["v"], ASSIGN_VALUE, 1)) >= 12
    mixed = lambda x: x["v"].rlike("[0-9]") & x["v"].rlike("[A-Za-z]")
    base = F.array_sort(
        F.concat(
            tagged(F.filter(located(text, ASSIGN), long_value), 0),
            tagged(located(text, ACCESS), 1),
            tagged(located(text, HEX), 2),
        )
    )
    opaque = tagged(F.filter(located(text, OPAQUE), mixed), 4)
    named = F.concat(tagged(located(text, IDENT), 3), tagged(located(text, ENDPOINT), 5))
    found = docs.select(
        "doc_id", F.md5(text).alias("text_key"), base.alias("base"), named.alias("named"), opaque.alias("opaque")
    )
    weak = F.concat("named", _apart(F.col("opaque"), F.col("base")))
    return found.select("doc_id", "text_key", "base", F.array_sort(weak).alias("weak"))


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, text_key and `more`: the weak parts with a part of another role within reach."""
    role = F.element_at(F.lit(list(ROLES)), F.col("p.k") + 1)
    own = ["doc_id", "text_key"]
    able = found.where((F.size("weak") > 0) & (F.size("base") + F.size("weak") > 1)).distinct()
    rows = lambda parts: able.select(*own, F.explode(parts).alias("p")).select(*own, "p", role.alias("role"))
    within = lambda lo, hi: F.explode(F.sequence((lo / reach).cast("int"), (hi / reach).cast("int")))
    low, high = F.greatest(F.col("p.s") - reach, F.lit(0)), F.col("p.e") + reach
    weak = rows(F.col("weak")).withColumn("bucket", within(low, high))
    every = rows(F.concat("base", "weak")).withColumn("bucket", within(F.col("p.s"), F.col("p.e") - 1))
    w, o = weak.alias("w"), every.alias("o")
    gap = F.greatest(F.col("o.p.s") - F.col("w.p.e"), F.col("w.p.s") - F.col("o.p.e"))
    near = (
        F.col("w.doc_id").eqNullSafe(F.col("o.doc_id"))
        & (F.col("w.text_key") == F.col("o.text_key"))
        & (F.col("w.bucket") == F.col("o.bucket"))
        & (F.col("w.role") != F.col("o.role"))
        & (gap <= reach)
    )
    kept = w.join(o, near, "left_semi").select(*own, "p").distinct()
    return kept.groupBy(*own).agg(F.array_sort(F.collect_list("p")).alias("more"))


def secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """doc_id, `base` and `spans`: arrays of (s, k, e) by start, then kind as in KINDS. One row per row of `docs`."""
    found = stored(parts(docs), "secret-parts")
    more = linked(found, reach).select(F.col("doc_id").alias("of"), F.col("text_key").alias("key"), "more")
    same = F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("text_key") == F.col("key"))
    every = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return found.join(more, same, "left").select("doc_id", "base", every.alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the strong kinds, SHA-256 of their list, and the list of all spans."""
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return secrets(docs.select("doc_id", "text")).select(
        "doc_id",
        n(0).alias("n_assign"),
        n(1).alias("n_access"),
        n(2).alias("n_hex"),
        F.sha2(listed(F.col("base"), KINDS), 256).alias("base_sha256"),
        listed(F.col("spans"), KINDS).alias("spans"),
    )
