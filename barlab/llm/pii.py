"""Personal data: fixed patterns, and looser spans that voters and a trained classifier decide. DataFrame functions only.

Candidates are the spans of the fixed patterns and of ``LOOSE``: addresses with the signs written out, and runs of digits
with separators; a run of more digits than any number has is cut at its separators into parts that may be numbers. Three voters look at each: its format, lists of known prefixes and endings (the
gazetteer), and the words before it. They say personal, not personal, or nothing. What they are worth is estimated
without labels (``votes.fit``); candidates then count, with their posterior, in the training of a
naive Bayes classifier on votes and shape of a span. A loose span outside of the fixed patterns' spans is
personal if the classifier's probability is at least ``PERSONAL_AT``. Spans of the fixed patterns always stay.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import whole_text
from barlab.llm.spans import bind, find, n_of, overlaps, written
from barlab.llm.votes import ABSTAIN, ALARM, CALM, Voters, beginners, fit, patterns
from barlab.session import stage

# Fixed values of the contract, in its order. The patterns are written so that no search goes over a run of
# characters twice: a match begins at the run's start or where the last match ended, and loops do not step back.
KINDS = ["email", "ip", "card", "phone"]
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
PARTS = rf"^{PART}(?:\.{PART}){{3}}\z"

#: An address with "at" and "dot" in brackets, or 7 or more digits with up to two separators between them.
LOOSE = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[(\[]at[)\]]\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[(\[]dot[)\]]\x20?)[A-Za-z0-9-]++)++"
    r"|\+?[0-9](?:[\x20().-]{0,2}[0-9])++"
)
LOOSE_DIGITS = (7, 19)
#: Parts of a longer run: card numbers with their check digit, and telephone numbers.
CARD_DIGITS = (13, 19)
PHONE_DIGITS = (7, 15)
#: The voters' lists: issuer prefixes of cards, beginnings of telephone numbers, endings of addresses.
ISSUERS = "^(?:4|5[1-5]|2[2-7]|3[47]|6011|65|35)"
DIALLED = r"^(?:\+|00[1-9]|\(?[2-9][0-9]{2}\)?[\x20.-])"
ENDINGS = r"(?i:com|org|net|edu|gov|info|io|de|fr|es|uk|eu)\z"
FORMATS = r"^(?:[0-9]{3}-[0-9]{2}-[0-9]{4}|\+?1?[\x20.-]?\(?[2-9][0-9]{2}\)?[\x20.-]{1,2}[0-9]{3}[\x20.-][0-9]{4}|[0-9]{4}(?:[\x20-][0-9]{4}){3})\z"
PERSONAL_WORDS = r"(?i)\b(?:e-?mail|contact|call|phone|tel|telephone|mobile|fax|card|visa|ssn|social security|whatsapp|write to)\b[^\n]{0,12}\z"
OTHER_WORDS = r"(?i)\b(?:order|invoice|isbn|issn|version|page|article|item|serial|figure|table|total|ref)\b[^\n]{0,12}\z"
BEFORE = 32

VOTES = ["v_format", "v_list", "v_context"]
SHAPES = ["f_digits", "f_groups", "f_sign"]
START = beginners(VOTES, calm=0.6, own=0.9, other=0.5, false=0.1, edge=4.0)
PERSONAL_AT = 0.9
SMOOTHING = 1.0


def digits_of(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check digit of a string of digits is right."""
    doubled = F.transform(
        F.split(F.reverse(digits), ""),
        lambda c, i: (F.instr(F.lit("0123456789"), c) - 1) * (1 + i % 2),
    )
    total = F.aggregate(doubled, F.lit(0), lambda held, x: held + F.when(x > 9, x - 9).otherwise(x))
    return total % 10 == 0


def _in(size: Column, least: int, most: int) -> Column:
    return size.between(least, most)


def _kept(kind: int) -> Callable[[Column], Column]:
    """The test that a match of a fixed pattern has to pass."""
    digits = lambda m: digits_of(m["match"])
    return [
        lambda m: F.lit(True), lambda m: m["match"].rlike(PARTS),
        lambda m: _in(F.length(digits(m)), 12, 19) & luhn(digits(m)), lambda m: _in(F.length(digits(m)), 9, 15),
    ][kind]


def _vote(alarm: Column, calm: Column) -> Column:
    return F.when(alarm, ALARM).when(calm, CALM).otherwise(ABSTAIN)


def described(start: Column, end: Column, match: Column, before: Column, kind: Column) -> Column:
    """A span with its votes and its shape."""
    digits, size = digits_of(match), F.length(digits_of(match))
    address = match.contains("@") | match.rlike("[A-Za-z]")
    dotted = match.rlike(PARTS)
    strict = match.rlike(FORMATS) | dotted | match.contains("@") | ((size >= 13) & luhn(digits))
    listed = F.when(address, match.rlike(ENDINGS)).when(size >= 13, digits.rlike(ISSUERS)).otherwise(match.rlike(DIALLED))
    context = F.right(before, F.lit(BEFORE))
    groups = F.length(F.regexp_replace(F.regexp_replace(match, r"[A-Za-z0-9@_%+]+", "x"), "[^x]", "")) - 1
    return F.struct(
        start.alias("start"), kind.alias("kind"), end.alias("end"),
        _vote(strict, ~address).alias("v_format"), _vote(listed, F.lit(True)).alias("v_list"),
        _vote(context.rlike(PERSONAL_WORDS), context.rlike(OTHER_WORDS)).alias("v_context"),
        F.when(size < 7, 0).when(size < 10, 1).when(size < 12, 2).when(size < 16, 3).otherwise(4).alias("f_digits"),
        F.least(F.greatest(groups, F.lit(0)), F.lit(3)).alias("f_groups"),
        F.when(address, 2).when(match.startswith("+"), 1).otherwise(0).alias("f_sign"),
    )


_FIELDS = [*VOTES, *SHAPES]
DESCRIBED = "struct<" + ",".join(["start:bigint", "kind:int", "end:bigint", *(f"{f}:int" for f in _FIELDS)]) + ">"


def _matches(text: Column, pattern: str) -> Column:
    return find(text, pattern, lambda start, end, match, before: F.struct(
        start.alias("start"), end.alias("end"), match.alias("match"), before.alias("before")
    ), MATCH)


def _described(matches: Column, kind: int) -> Column:
    return F.transform(matches, lambda m: described(m["start"], m["end"], m["match"], m["before"], F.lit(kind)))


MATCH = "struct<start:bigint,end:bigint,match:string,before:string>"
_PART = "struct<group:int,start:bigint,end:bigint,match:string>"
_GROUP = "struct<start:bigint,end:bigint,text:string,lead:int,size:int>"
#: Groups of digits that are looked at before their parts are put aside, so that a long run costs in proportion to its length.
GROUPS = 256


def _best_part(every: Column, k: Column) -> Column:
    """The part that begins with group ``k``: null if none does."""
    first = F.get(every, k)

    def wider(wide: Column, j: Column) -> Column:
        last = F.get(every, j)
        size = wide["size"] + last["size"]

        def judged(text: Column) -> Column:
            made = F.struct(j.alias("group"), (first["start"] + first["lead"]).alias("start"), last["end"].alias("end"), text.alias("match"))
            card = _in(size, *CARD_DIGITS) & luhn(digits_of(text))
            phone = _in(size, *PHONE_DIGITS)
            rank = F.when((card | phone) & text.rlike(FORMATS) & (card | (size < 16)), 1).when(card, 2).when(phone, 3).otherwise(4)
            return bind(rank, lambda r: F.struct(
                size.alias("size"), F.least(r, wide["rank"]).alias("rank"), F.when(r < wide["rank"], made).otherwise(wide["part"]).alias("part")
            ))

        # Groups are joined as they stand, a few at a time; the run itself is never cut.
        text = F.array_join(F.transform(F.slice(every, k + 1, j - k + 1), lambda g: g["text"]), "")
        unjudged = F.struct(size.alias("size"), wide["rank"].alias("rank"), wide["part"].alias("part"))
        return F.when(_in(size, PHONE_DIGITS[0], CARD_DIGITS[1]), bind(F.substr(text, first["lead"] + 1), judged)).otherwise(unjudged)

    none = F.struct(F.lit(0).alias("size"), F.lit(4).alias("rank"), F.lit(None).cast(_PART).alias("part"))
    last = F.least(k + CARD_DIGITS[1] - 1, F.size(every) - 1)
    return F.aggregate(F.sequence(k, last), none, wider, lambda wide: wide["part"])


def parts_of(m: Column) -> Column:
    """The parts of a run of digits that may be numbers by themselves, from the left, as matches with the run's context.

    A part is one or more whole groups of digits. Of those that begin with a group, one written like a known format is
    taken, else the shortest card number, else the shortest telephone number; the next begins behind it. Groups are taken in
    blocks, and only a block's own parts are carried from group to group.
    """
    groups = find(m["match"], r"[^0-9+]*+\+?[0-9]++", lambda start, end, text, _: F.struct(
        start.alias("start"), end.alias("end"), text.alias("text"),
        F.length(F.regexp_extract(text, "^[^0-9+]*", 0)).alias("lead"), F.length(digits_of(text)).alias("size"),
    ), _GROUP)
    empty = F.array().cast(f"array<{_PART}>")

    def in_block(every: Column, free: Column, b: Column) -> Column:
        last = F.least((b + 1) * GROUPS, F.size(every)) - 1

        def step(held: Column, k: Column) -> Column:
            return F.when(k < held["free"], held).otherwise(bind(_best_part(every, k), lambda part: F.when(part.isNull(), held).otherwise(
                F.struct((part["group"] + 1).alias("free"), F.concat(held["parts"], F.array(part)).alias("parts"))
            )))

        return F.aggregate(F.sequence(b * GROUPS, last), F.struct(free.alias("free"), empty.alias("parts")), step)

    def over_blocks(every: Column) -> Column:
        none = F.struct(F.lit(0).alias("free"), F.array().cast(f"array<array<{_PART}>>").alias("blocks"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / GROUPS).cast("int"))
        found = F.aggregate(blocks, none, lambda held, b: bind(in_block(every, held["free"], b), lambda done: F.struct(
            done["free"].alias("free"), F.concat(held["blocks"], F.array(done["parts"])).alias("blocks")
        )))
        return F.flatten(found["blocks"])

    return F.transform(bind(groups, over_blocks), lambda p: F.struct(
        (m["start"] + p["start"]).alias("start"), (m["start"] + p["end"]).alias("end"), p["match"].alias("match"), m["before"].alias("before")
    ))


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id``, ``known`` (spans of the fixed patterns) and ``loose`` (other candidates) per row."""
    texts = docs.select("doc_id", whole_text(text).alias("text"))
    body, none = F.col("text"), F.array().cast(f"array<{DESCRIBED}>")
    known = []
    for kind, (pattern, sign) in enumerate(((EMAIL, "@"), (IP, "."), (CARD, None), (PHONE, "+"))):
        kept = F.filter(_matches(body, pattern), _kept(kind))
        found = _described(kept, kind)
        known.append(F.when(body.contains(sign), found).otherwise(none) if sign else found)
    with_known = texts.select("doc_id", "text", F.sort_array(F.concat(*known)).alias("known"))
    few, many = LOOSE_DIGITS
    size = lambda m: F.length(digits_of(m["match"]))
    digits_only = lambda m: ~m["match"].rlike("[A-Za-z]")
    whole = F.transform(_matches(body, LOOSE), lambda m: F.when(digits_only(m) & (size(m) > many), parts_of(m)).otherwise(F.array(m).cast(f"array<{MATCH}>")))
    free = F.filter(
        F.flatten(whole),
        lambda m: (m["match"].rlike("[A-Za-z]") | _in(size(m), few, many)) & ~overlaps(F.col("known"), m["start"], m["end"]),
    )
    return with_known.select("doc_id", "known", _described(free, len(KINDS)).alias("loose"))


def log_odds(counted: DataFrame, voters: Voters) -> tuple[float, dict[str, list[float]]]:
    """The span classifier: log-odds of personal, in all and per value of each vote and shape.

    ``counted`` is the table of candidates by votes and shape, with ``n``; its size has a bound.
    """
    yes = F.col("n") * (1 - voters.calm())
    sums = [F.sum("n").alias("n"), F.sum(yes).alias("yes")]
    for f in _FIELDS:
        for v in range(5):
            hit = F.col(f) == v
            sums += [F.sum(F.when(hit, F.col("n")).otherwise(0)).alias(f"{f}_{v}_n"), F.sum(F.when(hit, yes).otherwise(0.0)).alias(f"{f}_{v}_yes")]
    got = counted.coalesce(1).agg(*sums).first()
    n, yes = got["n"] or 0, got["yes"] or 0.0
    ratio = lambda a, b: math.log((a + SMOOTHING) / (b + SMOOTHING))
    everywhere = ratio(yes, n - yes)
    terms = {
        f: [ratio(got[f"{f}_{v}_yes"] or 0.0, (got[f"{f}_{v}_n"] or 0) - (got[f"{f}_{v}_yes"] or 0.0)) - everywhere for v in range(5)]
        for f in _FIELDS
    }
    return everywhere, terms


def personal(span: Column, everywhere: float, terms: dict[str, list[float]]) -> Column:
    """The classifier's probability that a described span is personal."""
    total = F.lit(everywhere)
    for f, values in terms.items():
        total = total + F.get(F.array(*[F.lit(x) for x in values]), span[f])
    return 1 / (1 + F.exp(-total))


def find_personal(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``, an array of ``start, kind, end`` by start, then kind, per row of ``docs``.

    Kinds are numbers into ``[*KINDS, "other"]``; positions are code points, ends exclusive. A null or empty text has
    none. Rows count by themselves, whether they repeat or lack an id; other columns are ignored; an
    empty table gives an empty one.
    """
    found = stage(candidates(docs, text), "candidates")
    every = found.select(F.explode(F.concat("known", "loose")).alias("s")).select(*[F.col(f"s.{f}").alias(f) for f in _FIELDS])
    counted = stage(patterns(every, _FIELDS), "patterns")
    voters = fit(counted, START)
    everywhere, terms = log_odds(counted, voters)
    more = F.filter("loose", lambda s: personal(s, everywhere, terms) >= PERSONAL_AT)
    plain = lambda spans: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))
    return found.select("doc_id", F.sort_array(F.concat(plain(F.col("known")), plain(more))).alias("spans"))


def personal_report(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the fixed patterns' spans, and all spans as text."""
    found = find_personal(docs)
    base = F.filter("spans", lambda s: s["kind"] < len(KINDS))
    return found.select("doc_id", "spans", base.alias("base")).select(
        "doc_id", *[n_of(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(written(F.col("base"), KINDS), 256).alias("base_sha256"), written(F.col("spans"), [*KINDS, "other"]).alias("spans"),
    )
