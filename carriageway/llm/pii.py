"""Personal data in texts: patterns propose spans, checksums confirm them, context words adjust the score.

Column functions only; a text is searched where its row lies and nothing is
shuffled. A place in the text follows from the pieces between the matches of a
pattern: ``split`` and ``regexp_extract_all`` walk through the text alike, so
the lengths of pieces and matches add up to code-point positions. Sums go over
blocks, so that a text with very many matches stays near linear. The patterns
start at the border of a run and use possessive repeats: a long run of letters
or digits is tried once, not once from each of its characters.

Base kinds: email, ip, card (Luhn), phone. Added kinds: iban (mod 97 of the
rearranged number) and ssn, which only counts next to a context word.

Defined results: a null text is empty and has no spans; repeated rows are
searched one by one; an empty table gives no rows; further columns are carried
by ``redacted`` and dropped by ``report``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carriageway.llm.common import whole_text

NEAR = 48
CONTEXT_GAIN = 0.3
ACCEPT = 0.5
BLOCK = 64


@dataclass(frozen=True)
class Kind:
    name: str
    pattern: str
    context: str
    score: float
    #: Only texts that contain this are searched.
    needs: str | None = None


_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_LOCAL = r"[A-Za-z0-9._%+-]"

KINDS = (
    Kind("email", rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "e-?mail|mail|contact|write|reply|address", 0.8, "@"),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "ip|host|server|address|login|connect", 0.6, "."),
    # A run of digits with single separators, taken only if it has 16 to 19 digits in all.
    Kind("card", r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])", "card|visa|credit|debit|payment|karte|carte|tarjeta", 0.7),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "phone|tel|call|mobile|fax|telefon|appel|llam", 0.6, "+"),
    Kind("iban", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", "iban|account|bank|konto|compte|cuenta", 0.7),
    Kind("ssn", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "ssn|social|security|taxpayer", 0.3, "-"),
)
BASE = ("email", "ip", "card", "phone")


def luhn_holds(digits: Column) -> Column:
    """The Luhn sum over decimal digits, from the right, is a multiple of ten."""
    back = F.reverse(digits)

    def term(i: Column) -> Column:
        d = F.substring(back, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when(i % 2 == 0, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda a, i: a + term(i)) % 10 == 0


def mod_97_holds(code: Column) -> Column:
    """The number, its first four characters moved to the end and letters read as 10 to 35, is 1 modulo 97."""
    moved = F.concat(F.substring(code, F.lit(5), F.char_length(code)), F.substring(code, 1, 4))

    def step(a: Column, i: Column) -> Column:
        c = F.ascii(F.substring(moved, i, F.lit(1)))
        return F.when(c >= 65, (a * 100 + (c - 55)) % 97).otherwise((a * 10 + (c - 48)) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.char_length(code)), F.lit(0), step) == 1


def holds(kind: str, match: Column) -> Column:
    """Whether a match passes the validator of its kind."""
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "ip":
        return match.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        return luhn_holds(digits)
    if kind == "phone":
        return F.char_length(digits).between(8, 15)
    if kind == "iban":
        return mod_97_holds(F.replace(match, F.lit(" "), F.lit("")))
    return F.lit(True)


def proposed(df: DataFrame, kind: Kind, text: str) -> DataFrame:
    """Columns ``_m`` (matches), ``_p`` (pieces around them) for one kind; both empty without a match."""
    found = F.regexp_extract_all(F.col(text), F.lit(kind.pattern), F.lit(0))
    if kind.needs:
        found = F.when(F.contains(F.col(text), F.lit(kind.needs)), found).otherwise(F.array().cast("array<string>"))
    matched = df.withColumn(f"_m_{kind.name}", found)
    cut = F.when(F.size(f"_m_{kind.name}") > 0, F.split(F.col(text), kind.pattern, -1)).otherwise(F.array().cast("array<string>"))
    return matched.withColumn(f"_p_{kind.name}", cut)


def score_of(kind: Kind, before: Column, after: Column) -> Column:
    """Base score, and more if a context word stands near."""
    near = F.concat(F.lower(F.right(before, F.lit(NEAR))), F.lit(" "), F.lower(F.left(after, F.lit(NEAR))))
    return F.lit(kind.score) + F.when(near.rlike(rf"\b(?:{kind.context})"), CONTEXT_GAIN).otherwise(0.0)


def accepted(kind: Kind, match: Column, before: Column, after: Column) -> Column:
    passed = holds(kind.name, match)
    return passed if kind.name in BASE else passed & (score_of(kind, before, after) >= ACCEPT)


def total(a: Column) -> Column:
    return F.aggregate(a, F.lit(0), lambda s, x: s + x)


def span_of(kind: Kind, pieces: str, lengths: str, offsets: str) -> Callable[[Column, Column], Column]:
    """Function of a match and its number that gives its span, or null if it is not accepted."""

    def span(x: Column, i: Column) -> Column:
        block = F.floor(i / BLOCK).cast("int")
        before, after = F.get(F.col(pieces), i), F.get(F.col(pieces), i + 1)
        start = F.get(F.col(offsets), block) + total(F.slice(F.col(lengths), block * BLOCK + 1, i % BLOCK)) + F.char_length(before)
        return F.when(accepted(kind, x, before, after), F.struct(
            start.alias("start"), (start + F.char_length(x)).alias("end"), score_of(kind, before, after).alias("score")))

    return span


def with_spans(df: DataFrame, text: str) -> DataFrame:
    """Column ``_s_<kind>`` per kind: array of (start, end, score), code points, end exclusive."""
    for kind in KINDS:
        m, p, n, b, o = (f"_{x}_{kind.name}" for x in "mpnbo")
        df = proposed(df, kind, text)
        df = df.withColumn(n, F.transform(m, lambda x, i: F.char_length(x) + F.char_length(F.get(F.col(p), i))))
        # In each step the array is named twice, so that the optimizer keeps it as a column of its own.
        df = df.withColumn(b, F.when(F.size(n) > 0, F.transform(
            F.sequence(F.lit(0), F.floor((F.size(n) - 1) / BLOCK).cast("int")), lambda k: total(F.slice(F.col(n), k * BLOCK + 1, F.lit(BLOCK))))))
        df = df.withColumn(o, F.when(F.size(b) > 0, F.transform(
            F.sequence(F.lit(0), F.size(b) - 1), lambda k: total(F.slice(F.col(b), F.lit(1), k)))))
        spans = F.when(F.size(o) > 0, F.filter(F.transform(m, span_of(kind, p, n, o)), lambda s: s.isNotNull()))
        df = df.withColumn(f"_s_{kind.name}", spans).drop(m, p, n, b, o)
    return df


def listed(kinds: tuple[str, ...]) -> Column:
    """kind:start:end of all spans, by kind, then start."""

    def named(k: str) -> Column:
        spans = F.coalesce(F.col(f"_s_{k}"), F.array().cast("array<struct<start:int,end:int,score:double>>"))
        return F.transform(spans, lambda s: F.concat_ws(":", F.lit(k), s["start"].cast("string"), s["end"].cast("string")))

    return F.array_join(F.concat(*[named(k) for k in kinds]), ",")


def report(docs: DataFrame) -> DataFrame:
    """Counts, digest and list of spans per document, and the mean score."""
    found = with_spans(docs.select("doc_id", whole_text().alias("_text")), "_text")
    count = lambda k: F.coalesce(F.size(f"_s_{k}"), F.lit(0)).cast("long").alias(f"n_{k}")
    sized = found.withColumns({f"_s_{k.name}": F.when(F.size(f"_s_{k.name}") > 0, F.col(f"_s_{k.name}")) for k in KINDS})
    scores = F.flatten(F.array(*[F.coalesce(F.transform(f"_s_{k.name}", lambda s: s["score"]), F.array().cast("array<double>")) for k in KINDS]))
    return sized.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(listed(BASE).cast("binary"), 256).alias("base_sha256"),
        listed(tuple(k.name for k in KINDS)).alias("spans"), F.array_join(F.transform(scores, lambda x: F.round(x, 2).cast("string")), ",").alias("scores"))


def masked(kind: Kind, pieces: Column) -> Callable[[Column, Column], Column]:
    """Function of a match and its number that gives the piece before it and the match, or its kind instead."""

    def mask(x: Column, i: Column) -> Column:
        before, after = F.get(pieces, i), F.get(pieces, i + 1)
        return F.concat(before, F.when(accepted(kind, x, before, after), F.lit(f"[{kind.name.upper()}]")).otherwise(x))

    return mask


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with every accepted span replaced by its kind in brackets; ``n_chars`` follows the new text.

    Kind after kind, each on the text that the one before left.
    """
    df = docs.withColumn("_text", F.col("text"))
    for kind in KINDS:
        df = proposed(df, kind, "_text")
        m, p = F.col(f"_m_{kind.name}"), F.col(f"_p_{kind.name}")
        mask = F.transform(m, masked(kind, p))
        df = df.withColumn("_text", F.when(F.size(m) > 0, F.concat(F.array_join(mask, ""), F.element_at(p, -1))).otherwise(F.col("_text")))
        df = df.drop(f"_m_{kind.name}", f"_p_{kind.name}")
    out = {"text": F.col("_text")}
    if "n_chars" in docs.columns:
        length = F.when(F.col("_text").eqNullSafe(F.col("text")), F.col("n_chars")).otherwise(F.char_length("_text"))
        out["n_chars"] = length.cast(docs.schema["n_chars"].dataType)
    return df.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])
