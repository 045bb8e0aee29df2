"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust their score.

Built from column functions only. A text is split at the matches of a pattern; the lengths of the pieces
and of the matches give every position, so no position is searched twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import carried

# The patterns match what the plain ones of the contract match, leftmost and not overlapping. Possessive
# loops and look-behinds (a match starts where a run of its characters starts, or where the last match
# ended) keep them linear on very long runs and free of recursion.
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}+(?![\x20-]?[0-9])"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
LOCAL_PHONE = r"(?<![0-9+(.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9-])"

CONTEXT = 48  # characters looked at on either side of a match


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of a text pass the Luhn test."""
    reverse = F.split(F.reverse(_digits(text)), "")

    def weigh(digit: Column, place: Column) -> Column:
        value = digit.cast("int")
        double = value * 2
        return F.when(place % 2 == 0, value).otherwise(F.when(double > 9, double - 9).otherwise(double))

    values = F.transform(F.filter(reverse, lambda c: c != ""), weigh)
    return F.aggregate(values, F.lit(0), lambda a, v: a + v) % 10 == 0


def mod_97(text: Column) -> Column:
    """Whether an IBAN has the right check digits: moved to the end and read as a number, it leaves 1."""
    plain = F.regexp_replace(text, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))
    values = F.transform(F.filter(F.split(moved, ""), lambda c: c != ""), lambda c: F.ascii(c))

    def step(rest: Column, code: Column) -> Column:
        digit = code <= 57
        return F.when(digit, rest * 10 + code - 48).otherwise(rest * 100 + code - 55) % 97

    return F.aggregate(values, F.lit(0), step) == 1


def _small_parts(text: Column) -> Column:
    """Each dotted part is at most 255."""
    plain = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", ""))
    return F.forall(plain, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))


def _phone_length(text: Column) -> Column:
    return F.length(_digits(text)).between(8, 15)


@dataclass(frozen=True)
class Kind:
    """A kind of personal data: its pattern, a check, its score before and the words that raise it."""

    name: str
    pattern: str
    valid: object
    score: float
    words: str
    base: bool = True


KINDS = [
    Kind("email", EMAIL, lambda m: F.lit(True), 0.9, "mail|contact|write"),
    Kind("ip", IP, _small_parts, 0.7, r"\bip\b|address|server|host"),
    Kind("card", CARD, luhn, 0.9, "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", PHONE, _phone_length, 0.7, r"phone|\btel|call|fax|mobile|telefon|téléphone|teléfono"),
    Kind("iban", IBAN, mod_97, 0.9, "iban|account|bank|konto|compte|cuenta", False),
    Kind("ssn", SSN, lambda m: ~m.rlike("^(000|666|9)|-00-|-0000$"), 0.4, "ssn|social security", False),
    Kind("local_phone", LOCAL_PHONE, lambda m: F.lit(True), 0.4, r"phone|\btel|call|fax|mobile", False),
]
BONUS = 0.3  # added where one of a kind's words is near, up to a score of 1


def _prefix_sums(lengths: Column) -> Column:
    """Sum of the elements before each one, in blocks so that the work stays near linear."""
    block = 256
    n = F.ceil(F.size(lengths) / block).cast("int")
    pieces = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.slice(lengths, i * block + 1, F.lit(block)))

    def running(values: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.expr("array()").cast("array<int>").alias("all"))
        done = F.aggregate(
            values, start, lambda a, v: F.struct((a["at"] + v).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all"))
        )
        return done["all"]

    sums = F.transform(pieces, lambda p: F.aggregate(p, F.lit(0), lambda a, v: a + v))
    starts = running(sums)
    full = F.flatten(F.zip_with(pieces, starts, lambda p, s: F.transform(running(p), lambda v: v + s)))
    return F.when(F.size(lengths) == 0, F.expr("array()").cast("array<int>")).otherwise(full)


def find_pii(docs: DataFrame, kinds: list[Kind] = KINDS, least_score: float = 0.6, text: str = "text") -> DataFrame:
    """Every row with ``pii`` and ``pii_masked`` added.

    ``pii`` is an array of structs (kind, start, end, score, value) by kind in the given order, then start; positions
    count code points, the end is exclusive. A match that fails its check is dropped and not tried again in
    parts. Base kinds always stay, the others if their score with the bonus for nearby words reaches
    ``least_score``. ``pii_masked`` is the text with each kept span replaced by its kind in brackets; where
    spans of two kinds overlap, the one of the earlier kind is replaced.

    A null text has no spans and stays null; an empty one stays empty. Whole texts are searched. Repeated rows
    are treated one by one; an empty table gives no rows. Other columns are kept; columns named like the
    added ones are replaced.
    """
    return carried(docs, [text], lambda rows: _with_spans(rows, kinds, least_score, text))


def _with_spans(docs: DataFrame, kinds: list[Kind], least_score: float, text: str) -> DataFrame:
    frame = docs.withColumn("pii_masked", F.col(text))
    whole = F.coalesce(F.col(text), F.lit(""))
    # One projection per step: what a step uses several times is then computed once.
    steps = [
        {f"_found_{k.name}": F.regexp_extract_all(whole, F.lit(k.pattern), F.lit(0)) for k in kinds},
        {f"_gaps_{k.name}": _if_found(k, F.split(whole, k.pattern, -1), "string") for k in kinds},
        {f"_score_{k.name}": _if_found(k, _scores(k), "double") for k in kinds}
        | {f"_step_{k.name}": _if_found(k, _steps(k), "int") for k in kinds},
        {f"_at_{k.name}": _prefix_sums(F.col(f"_step_{k.name}")) for k in kinds},
        {f"_span_{k.name}": _if_found(k, _spans(k, 0.0 if k.base else least_score), SPAN) for k in kinds},
        {"pii": F.concat(*[F.col(f"_span_{k.name}") for k in kinds])}
        | {
            f"_values_{k.name}": F.array_distinct(F.transform(f"_span_{k.name}", lambda x: x["value"]))
            for k in kinds
            if not k.base
        },
    ]
    for step in steps:
        frame = frame.withColumns(step)
    for kind in kinds:
        kept = F.size(f"_span_{kind.name}") > 0
        frame = frame.withColumn("pii_masked", F.when(kept, _masked(kind)).otherwise(F.col("pii_masked")))
    return frame.drop(*[f"_{a}_{k.name}" for k in kinds for a in ("found", "gaps", "score", "step", "at", "span", "values")])


SPAN = "struct<kind:string,start:bigint,end:bigint,score:double,value:string>"


def _if_found(kind: Kind, value: Column, element: str) -> Column:
    return F.when(F.size(f"_found_{kind.name}") > 0, value).otherwise(F.expr("array()").cast(f"array<{element}>"))


def _scores(kind: Kind) -> Column:
    """Score of each match, null where it fails its check; there is one piece more than there are matches."""
    found, gaps = F.col(f"_found_{kind.name}"), F.col(f"_gaps_{kind.name}")
    around = F.zip_with(
        F.slice(gaps, 1, F.size(found)),
        F.slice(gaps, 2, F.size(found)),
        lambda a, b: F.lower(F.concat(F.right(a, F.lit(CONTEXT)), F.lit(" "), F.left(b, F.lit(CONTEXT)))),
    )

    def score(match: Column, context: Column) -> Column:
        bonus = F.when(context.rlike(kind.words), F.lit(BONUS)).otherwise(F.lit(0.0))
        return F.when(kind.valid(match), F.least(F.lit(1.0), F.lit(kind.score) + bonus))

    return F.zip_with(found, around, score)


def _steps(kind: Kind) -> Column:
    """From the start of each match to the start of the next: its own length and that of the piece after it."""
    found, gaps = F.col(f"_found_{kind.name}"), F.col(f"_gaps_{kind.name}")
    after = F.zip_with(found, F.slice(gaps, 2, F.size(found)), lambda m, g: F.length(m) + F.length(g))
    return F.concat(F.array(F.length(F.get(gaps, F.lit(0)))), after)


def _spans(kind: Kind, least: float) -> Column:
    """The kept spans. Match i starts at the sum of the first i + 1 steps."""
    found, score = F.col(f"_found_{kind.name}"), F.col(f"_score_{kind.name}")
    starts = F.slice(F.col(f"_at_{kind.name}"), 2, F.size(found))
    spans = F.zip_with(
        F.arrays_zip(found.alias("m"), score.alias("s")),
        starts,
        lambda x, at: F.struct(
            F.lit(kind.name).alias("kind"),
            at.cast("long").alias("start"),
            (at + F.length(x["m"])).cast("long").alias("end"),
            x["s"].alias("score"),
            x["m"].alias("value"),
        ),
    )
    return F.filter(spans, lambda x: x["score"] >= least)


def _masked(kind: Kind) -> Column:
    """The text so far with the values of the kept spans replaced; it is split anew, as earlier kinds are gone."""
    so_far = F.col("pii_masked")
    found = F.regexp_extract_all(so_far, F.lit(kind.pattern), F.lit(0))

    def chosen(match: Column) -> Column:
        return kind.valid(match) if kind.base else F.array_contains(F.col(f"_values_{kind.name}"), match)

    put = F.transform(found, lambda m: F.when(chosen(m), F.lit(f"[{kind.name.upper()}]")).otherwise(m))
    pieces = F.zip_with(F.split(so_far, kind.pattern, -1), put, lambda p, m: F.concat(p, F.coalesce(m, F.lit(""))))
    return F.array_join(pieces, "")


def span_list(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def base_spans(spans: Column, kinds: list[Kind] = KINDS) -> Column:
    return F.filter(spans, lambda x: x["kind"].isin([k.name for k in kinds if k.base]))
