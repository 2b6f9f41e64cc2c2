r"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Base kinds (leftmost, non-overlapping per kind) are always reported:

* email `[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+`;
* ip `[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)` with parts of at most 255;
* card `[0-9]([\x20-]?[0-9])+` of 12 to 19 digits that pass Luhn's check;
* phone `\+[0-9][\x20().0-9-]+[0-9]` of 9 to 15 digits.

Further kinds start from a score of their own: iban (two letters, two digits, 11 to 30 more; mod 97 must be 1), ssn
(3-2-4 digits) and phone_local (3-3-4 digits). An iban is proposed by its first characters, and what follows is tried
in parts that end at a word's end: what passes with the length of its country, else the whole run of capitals and
digits, else (countries without a known length) the longest part that passes. Words in the 40 code points on either
side move the score up or down, and a span counts if its score reaches `MIN_SCORE`. Base spans get scores too but stay whatever they are.

Only built-in functions: one projection, no shuffle. Defined cases: a null or empty text has no spans; repeated rows
get equal results; further columns pass by, only doc_id and text are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockyard.llm.shared import let
from dockyard.llm.spans import SPANS, around, listed, located

MIN_SCORE = 0.5
#: Code points on either side whose words move a score.
CONTEXT = 40


@dataclass(frozen=True)
class Kind:
    """A pattern without backtracking, a check of the value, a score, and words that move it by `STEP`."""

    name: str
    pattern: str
    score: float
    words: str
    against: str = r"order|invoice|version|serial|ticket|isbn|build"


STEP = 0.3
BASE = 4
KINDS = (
    # \G lets a match begin right after the one before, as the plain pattern would.
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        "mail|contact|write to",
    ),
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.7, "ip|host|server|address"),
    Kind("card", r"[0-9](?:[\x20-]?+[0-9])++", 0.8, "card|visa|credit|payment|karte|tarjeta|carte"),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.8, "phone|call|tel|mobile|fax"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?+[A-Z0-9]){11})", 0.8, "iban|account|bank"),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", 0.3, "ssn|social|security"),
    Kind("phone_local", r"(?<![0-9+().-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9-])", 0.3, "phone|call|tel|mobile|fax"),
)
NAMES = tuple(k.name for k in KINDS)
_BYTE = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])?"
_IP = rf"^{_BYTE}(?:\.{_BYTE}){{3}}$"
#: Code points of text that 30 characters with a space before each, and what ends them, can take.
IBAN_REACH = 61
#: Code and length of each country in the register of ibans.
IBAN_LENGTHS = (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 "
    "FI18 FK18 FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HN28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 "
    "LI21 LT20 LU20 LV21 LY25 MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 "
    "RS22 RU33 SA24 SC31 SD18 SE24 SI19 SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30"
).split()


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right doubled, sum of digits divisible by 10."""

    def total(d: Column) -> Column:
        n = F.length(d)
        digit = lambda i: d.substr(n - i + 1, F.lit(1)).cast("int")
        twice = lambda x: F.when(x > 4, 2 * x - 9).otherwise(2 * x)
        add = lambda acc, i: acc + F.when(i % 2 == 0, twice(digit(i))).otherwise(digit(i))
        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)

    return let(digits, total) % 10 == 0


def mod97(value: Column) -> Column:
    """The remainder of an account number: its first four characters moved to the end, letters as 10 to 35."""
    plain = F.regexp_replace(value, r"\x20", "")
    turned = F.concat(F.substring(plain, 5, 100), F.substring(plain, 1, 4))
    code = lambda c: F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), c) - 1
    add = lambda acc, v: (acc * F.when(v > 9, 100).otherwise(10) + v) % 97
    codes = F.transform(F.split(turned, ""), code)
    return F.aggregate(codes, F.lit(0), add)


def _iban_rest(first: Column, after: Column) -> Column:
    """What of the text `after` belongs to the iban that begins with `first`; empty if nothing passes."""
    sizes = F.create_map(*[F.lit(v) for x in IBAN_LENGTHS for v in (x[:2], int(x[2:]))])
    size = F.try_element_at(sizes, F.substring(first, 1, 2))

    def rest(n: Column) -> Column:
        pattern = F.concat(F.lit(r"^(?:\x20?+[A-Z0-9]){"), n.cast("string"), F.lit("}+(?![A-Za-z0-9])"))
        return F.call_function("regexp_extract", after, pattern, F.lit(0))

    run = F.regexp_extract(after, r"^(?:\x20?+[A-Z0-9]){11,30}+(?![A-Za-z0-9])", 0)
    parts = F.transform(F.sequence(F.lit(30), F.lit(11), F.lit(-1)), rest)
    tried = let(size, lambda n: F.when(n.isNull(), F.concat(F.array(run), parts)).otherwise(F.array(rest(n - 4), run)))
    passed = F.filter(tried, lambda x: (x != "") & (mod97(F.concat(first, x)) == 1))
    return F.coalesce(F.get(passed, F.lit(0)), F.lit(""))


def _ibans(text: Column, heads: Column) -> Column:
    """The ibans that begin with `heads`, leftmost and non-overlapping."""

    def whole(x: Column) -> Column:
        grown = lambda rest: F.struct(
            x["s"].alias("s"), (x["e"] + F.length(rest)).alias("e"), F.concat(x["v"], rest).alias("v")
        )
        return let(_iban_rest(x["v"], x["after"]), grown)

    def apart(found: Column) -> Column:
        last = lambda acc: F.when(F.size(acc) > 0, F.element_at(acc, -1)["e"]).otherwise(0)
        add = lambda acc, x: F.when(x["s"] >= last(acc), F.concat(acc, F.array(x))).otherwise(acc)
        crossed = lambda i: found[i]["e"] > found[i + 1]["s"]
        steps = F.when(F.size(found) > 1, F.sequence(F.lit(0), F.size(found) - 2)).otherwise(F.array().cast("array<int>"))
        one_by_one = F.aggregate(found, F.array().cast(SPANS), add)
        return F.when(F.exists(steps, crossed), one_by_one).otherwise(found)

    grown = F.transform(around(text, heads, IBAN_REACH), whole)
    return let(F.filter(grown, lambda x: x["e"] - x["s"] > 4), apart)


def _valid(kind: str, value: Column) -> Column:
    n = F.length(_digits(value))
    if kind == "ip":
        return value.rlike(_IP)
    if kind == "card":
        return F.when(n.between(12, 19), luhn(_digits(value))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _score(kind: Kind, span: Column) -> Column:
    near = F.lower(F.concat_ws(" ", span["before"], span["after"]))
    up = F.when(near.rlike(rf"\b(?:{kind.words})"), STEP).otherwise(0.0)
    down = F.when(near.rlike(rf"\b(?:{kind.against})"), STEP).otherwise(0.0)
    return F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.lit(kind.score) + up - down))


def _spans(text: Column, place: int, min_score: float) -> Column:
    kind = KINDS[place]
    valid = lambda spans: F.filter(spans, lambda x: _valid(kind.name, x["v"]))
    if kind.name == "iban":
        valid = lambda spans: let(spans, lambda heads: _ibans(text, heads))
    one = lambda x: F.struct(
        x["s"].alias("s"), F.lit(place).alias("k"), x["e"].alias("e"), _score(kind, x).alias("score")
    )
    scored = let(valid(located(text, kind.pattern)), lambda x: F.transform(around(text, x, CONTEXT), one))
    return scored if place < BASE else F.filter(scored, lambda x: x["score"] >= min_score)


def personal_data(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """doc_id, `base` and `spans`: arrays of (s, k, e, score) by start, then kind as in KINDS."""
    text = F.coalesce("text", F.lit(""))
    found = [_spans(text, i, min_score) for i in range(len(KINDS))]
    split = docs.select("doc_id", F.concat(*found[:BASE]).alias("b"), F.concat(*found[BASE:]).alias("m"))
    return split.select("doc_id", F.array_sort("b").alias("base"), F.array_sort(F.concat("b", "m")).alias("spans"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, counts of the base kinds, SHA-256 of their list, the list of all spans and their scores."""
    n = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return personal_data(docs).select(
        "doc_id",
        *[n(i).alias(f"n_{NAMES[i]}") for i in range(BASE)],
        F.sha2(listed(F.col("base"), NAMES), 256).alias("base_sha256"),
        listed(F.col("spans"), NAMES).alias("spans"),
        F.array_join(F.transform("spans", lambda x: F.format_number(x["score"], 1)), ",").alias("scores"),
    )
