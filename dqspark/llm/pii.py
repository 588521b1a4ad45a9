"""Personal data in texts: patterns propose spans, checksums confirm them, words nearby adjust the score."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from dqspark.llm.common import Rows

#: Code points on either side of a span that are searched for context words.
NEARBY = 40
_SPAN = "struct<start:int,end:int,text:string>"


@dataclass(frozen=True)
class Kind:
    """A kind of personal data. ``score`` is what a confirmed span has; context adds ``CONTEXT`` to it."""

    name: str
    pattern: str
    confirmed: Callable[[Column], Column]
    score: float
    context: str
    guard: str = ""


CONTEXT = 0.3


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes the Luhn check: every second digit from the right counts double."""
    digits = F.split(F.reverse(number), "")
    values = F.transform(
        digits,
        lambda d, i: F.when(i % 2 == 0, d.cast("int")).otherwise(
            (2 * d.cast("int")) % 10 + F.when(d.cast("int") > 4, 1).otherwise(0)
        ),
    )
    return F.aggregate(values, F.lit(0), lambda total, v: total + v) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number passes the mod-97 check: first four signs last, letters as 10 to 35."""
    bare = F.regexp_replace(account, "\\x20", "")
    signs = F.split(F.concat(F.substring(bare, 5, 99), F.substring(bare, 1, 4)), "")
    return (
        F.aggregate(
            signs,
            F.lit(0),
            lambda rest, s: F.when(s.between("0", "9"), (rest * 10 + F.ascii(s) - 48) % 97).otherwise(
                (rest * 100 + F.ascii(s) - 55) % 97
            ),
        )
        == 1
    )


_PART = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

#: The base kinds, in their order. The patterns find what the plain ones do (``[A-Za-z0-9._%+-]+@...`` and so on),
#: leftmost and without overlap, but take runs of signs whole and start only where a run starts or a match has
#: ended: so the time is in proportion to the text, whatever it holds. ``CARD`` matches a run of 16 to 19 digits
#: only, as shorter and longer ones fail anyway.
BASE = [
    Kind(
        "email",
        "(?:\\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\\.[A-Za-z0-9-]++)++",
        lambda t: F.lit(True),
        0.7,
        "mail|contact|kontakt|correo|courriel|write",
        "@",
    ),
    Kind(
        "ip",
        "(?:\\G|(?<![0-9]))[0-9]++\\.[0-9]++\\.[0-9]++\\.[0-9]++",
        lambda t: t.rlike(f"^{_PART}(?:\\.{_PART}){{3}}$"),
        0.6,
        "\\bip\\b|address|host|server|login",
        ".",
    ),
    Kind(
        "card",
        "(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){15,18}+(?![\\x20-]?[0-9])",
        lambda t: luhn(_digits(t)),
        0.7,
        "card|visa|credit|karte|tarjeta|carte",
    ),
    Kind(
        "phone",
        "\\+[0-9][\\x20().0-9-]+[0-9]",
        lambda t: F.length(_digits(t)).between(8, 15),
        0.6,
        "phone|call|tel|mobil|fax|number",
        "+",
    ),
]

#: Further kinds: a span counts if its score reaches ``LEAST``, so some need context.
LEAST = 0.6
FURTHER = [
    Kind(
        "iban",
        "(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\\x20?[A-Z0-9]{4}){2,7}(?:\\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
        mod97,
        0.8,
        "iban|account|konto|cuenta|compte|bank",
    ),
    Kind(
        "shortcard",
        "(?<![0-9])(?<![0-9][\\x20-])[0-9](?:[\\x20-]?[0-9]){12,14}+(?![\\x20-]?[0-9])",
        lambda t: luhn(_digits(t)),
        0.4,
        "card|visa|credit|amex|karte|tarjeta|carte",
    ),
    Kind(
        "ssn",
        "(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        lambda t: ~t.rlike("^(?:000|666|9)|-00-|-0000$"),
        0.3,
        "ssn|social|security|\\bss\\b",
        "-",
    ),
]


def _spans(matches: Column, gaps: Column) -> Column:
    """Start and end of matches, from what lies between them; in code points, the end exclusive."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{_SPAN}>").alias("found"))

    def step(so_far: Column, i: Column) -> Column:
        begin = so_far["at"] + F.length(F.get(gaps, i))
        end = begin + F.length(F.get(matches, i))
        span = F.struct(begin.alias("start"), end.alias("end"), F.get(matches, i).alias("text"))
        return F.struct(end.alias("at"), F.concat(so_far["found"], F.array(span)).alias("found"))

    every = F.sequence(F.lit(0), F.size(matches) - 1)
    return F.aggregate(every, start, step, lambda done: done["found"])


def _scored(spans: Column, text: Column, kind: Kind, base: bool) -> Column:
    def scored(span: Column) -> Column:
        nearby = F.concat(
            F.substring(text, F.greatest(span["start"] - NEARBY, F.lit(0)) + 1, F.least(span["start"], F.lit(NEARBY))),
            F.lit(" "),
            F.substring(text, span["end"] + 1, F.lit(NEARBY)),
        )
        bonus = F.when(F.lower(nearby).rlike(kind.context), CONTEXT).otherwise(0.0)
        return F.struct(
            F.lit(kind.name).alias("kind"),
            span["start"].alias("start"),
            span["end"].alias("end"),
            F.round(F.lit(kind.score) + bonus, 2).alias("score"),
            span["text"].alias("text"),
        )

    found = F.transform(F.filter(spans, lambda s: kind.confirmed(s["text"])), scored)
    return found if base else F.filter(found, lambda s: s["score"] >= LEAST)


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with ``pii``: an array of (kind, start, end, score, text), by kind and then start.

    Spans count code points, the end is exclusive. A span of a base kind stays when its check holds (parts of an
    address at most 255, Luhn, number of digits), however low its score; of the further kinds (IBAN by mod-97, 13
    to 15 digit cards by Luhn, social security numbers) those whose score, with context, reaches ``LEAST``.

    A null or empty text has no spans. Texts are searched whole. Rows are independent: repeated ones come
    out alike, no rows give none. An input column named ``pii`` is replaced.
    """
    rows = Rows(docs)
    kinds, own = [*BASE, *FURTHER], F.coalesce(F.col(rows.of[text]), F.lit(""))
    frame = rows.frame.withColumn("own", own)
    matches = {
        k.name: F.when(F.contains("own", F.lit(k.guard)), F.regexp_extract_all("own", F.lit(k.pattern), F.lit(0)))
        if k.guard
        else F.regexp_extract_all("own", F.lit(k.pattern), F.lit(0))
        for k in kinds
    }
    frame = frame.withColumns({f"{name}_found": m for name, m in matches.items()})
    gaps = {
        f"{k.name}_gaps": F.when(F.size(f"{k.name}_found") > 0, F.split("own", k.pattern, -1)) for k in kinds
    }
    frame = frame.withColumns(gaps)
    spans = {
        f"{k.name}_spans": F.when(
            F.size(f"{k.name}_found") > 0, _spans(F.col(f"{k.name}_found"), F.col(f"{k.name}_gaps"))
        ).otherwise(F.array().cast(f"array<{_SPAN}>"))
        for k in kinds
    }
    frame = frame.withColumns(spans)
    scored = [_scored(F.col(f"{k.name}_spans"), F.col("own"), k, k in BASE) for k in kinds]
    return rows.back(frame.withColumn("pii", F.concat(*scored)), "pii")


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every span of ``find`` replaced by its kind in brackets, all but the text unchanged.

    Spans that overlap are one: the kind of the first counts.
    """
    rows = Rows(docs)
    found = find(docs.select(F.col(f"`{text}`").alias("text"), F.struct("*").alias("row")))
    ordered = F.array_sort(F.transform("pii", lambda s: F.struct(s["start"], s["end"], s["kind"])))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("done"))

    def step(so_far: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), so_far["at"] + 1, span["start"] - so_far["at"])
        longer = F.struct(
            span["end"].alias("at"), F.concat(so_far["done"], gap, F.lit("["), span["kind"], F.lit("]")).alias("done")
        )
        later = F.struct(F.greatest(so_far["at"], span["end"]).alias("at"), so_far["done"].alias("done"))
        return F.when(span["start"] >= so_far["at"], longer).otherwise(later)

    clean = F.aggregate(
        ordered, start, step, lambda s: F.concat(s["done"], F.substring(F.col("text"), s["at"] + 1, F.length("text")))
    )
    return found.select(*[
        F.when(F.col("text").isNotNull(), clean).alias(n) if n == text else F.col("row").getField(n).alias(n)
        for n in rows.names
    ])
