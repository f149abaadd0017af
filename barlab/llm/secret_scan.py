"""Secrets in texts: fixed patterns, and strings that a Markov model finds random. DataFrame functions only.

First-order Markov models over characters, of random strings in three forms (hexadecimal, capitals, any characters), of
ordinary words and of identifiers, give every candidate string a log-likelihood ratio per character: its likeliest random
form against the likelier of the other two. Where a model has seen little of what follows a character, it falls back to how frequent characters
are. A candidate is a run of 12 or more characters of base64 or identifiers outside of the spans of the fixed patterns, with
letters and digits if it is shorter than 20; one whose ratio is above ``THRESHOLD`` a pair of characters, and above ``EVIDENCE`` in
all, is a span of kind ``random``. A short run thus needs a higher ratio per character.

Training data are labelled by where they come from. Random strings: digests written as hexadecimal, base64
and capital letters, and the values that the fixed patterns found in the sampled texts. Ordinary
ones: all other words of these texts that are no candidates; identifiers: verbs and nouns put together, in the cases that
names are written in, and dates and times. The sample are the ``TRAINING_TEXTS`` different texts with the smallest hash, a bound on the work and not
on what is scanned. Its counts are a table of pairs of characters, 5 x 68 x 68 at most, and that is all the driver sees.
"""

from __future__ import annotations

import math
import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barlab.llm.common import whole_text
from barlab.llm.spans import SPAN, base_spans, bind, find, n_of, overlaps, written

# Fixed values of the contract, in its order.
KINDS = ["assign", "access", "hex"]
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LEAST = 6
#: A run of too few characters holds no other match, so the least length may stand in the pattern.
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"

CHARACTERS = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_=-."
LEAST = 12
CANDIDATE = f"[A-Za-z0-9+/_=-]{{{LEAST},}}"
#: From so many characters on, a run may be of letters alone.
LONG = 20
WORD = "[A-Za-z0-9+/_=-]{4,}"
TRAINING_TEXTS = 400
TRAINING_STRINGS = 1_500
#: Weight, in pairs, of a character's frequency in the estimate of what follows a character.
BACK_OFF = 5.0
#: Added to every count of a character.
SMOOTHING = 0.5
#: The least log-likelihood ratio per pair of characters; see the held-out test.
THRESHOLD = 1.0
#: The least log-likelihood ratio of a whole string.
EVIDENCE = 19.0
# Parts of which identifiers are made for the training.
VERBS = [
    "get", "set", "make", "read", "write", "load", "save", "parse", "build", "find", "count", "update", "create", "delete", "check", "open",
    "close", "send", "fetch", "index", "max", "min", "is", "to", "from", "new", "current", "default", "array", "string", "regexp", "date",
]
NOUNS = [
    "user", "file", "name", "value", "table", "column", "record", "session", "config", "request", "response", "buffer", "thread", "client",
    "server", "database", "connection", "timeout", "version", "counter", "handler", "size", "seconds", "factory", "parser", "element",
    "timestamp", "schema", "position", "distinct", "percentile", "format",
]
ORDINARY = ("words", "identifiers")
FORMS = {"hex": "^[0-9a-f]+$", "capitals": "^[A-Z0-9]+$", "any": "."}


def known_spans(text: Column) -> Column:
    """Spans of the fixed patterns, by start, then kind."""
    long_enough = lambda m: F.char_length(F.regexp_extract(m, ASSIGN, 2)) >= ASSIGN_LEAST
    found = [base_spans(text, ASSIGN, 0, long_enough), base_spans(text, ACCESS, 1), base_spans(text, HEX, 2)]
    return F.sort_array(F.concat(*found))


def _judged(run: Column) -> Column:
    """Whether a run is a candidate: long enough, and with digits among its letters if it is not very long."""
    letters, size = run.rlike("[A-Za-z]"), F.length(run)
    return letters & ((size >= LONG) | ((size >= LEAST) & run.rlike("[0-9]")))


def _pairs(strings: DataFrame) -> DataFrame:
    """``form, a, b, count`` of the characters that follow each other in ``strings(form, s)``."""
    cut = strings.select("form", F.split("s", "").alias("c"))
    nexts = F.transform("c", lambda x, i: F.struct(x.alias("a"), F.get(F.col("c"), i + 1).alias("b")))
    pairs = cut.select("form", F.explode_outer(nexts).alias("p")).select("form", "p.a", "p.b")
    known = [F.lit(CHARACTERS).contains(F.col(c)) & (F.col(c) != "") for c in ("a", "b")]
    return pairs.where(known[0] & known[1]).groupBy("form", "a", "b").count()


def training_strings(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Labelled strings ``form, s``: random ones in their forms, and ordinary ones."""
    hashed = texts.select(F.xxhash64("text").alias("h"), "text")
    last = hashed.select("h").distinct().orderBy("h").limit(TRAINING_TEXTS).agg(F.max("h")).first()[0]
    sample = hashed.where(F.col("h") <= F.lit(last if last is not None else 0)).dropDuplicates(["h"])
    values = sample.select(F.explode_outer(F.concat(
        F.regexp_extract_all("text", F.lit(ASSIGN), F.lit(2)), F.regexp_extract_all("text", F.lit(ACCESS), F.lit(0)),
        F.regexp_extract_all("text", F.lit(HEX), F.lit(0)),
    )).alias("s")).where(F.length("s") >= 16)
    digest = F.sha2(F.col("id").cast("string"), 256)
    base64 = F.base64(F.unhex(digest))
    forms = F.array(F.substring(digest, 1, 40), F.substring(base64, 1, 40), F.upper(F.regexp_replace(base64, "[^A-Za-z0-9]", "")))
    made = texts.sparkSession.range(TRAINING_STRINGS).select(F.explode(forms).alias("s"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    words = sample.select(F.explode_outer(F.regexp_extract_all(rest, F.lit(WORD), F.lit(0))).alias("s")).where("s is not null")
    words = words.where(~_judged(F.col("s")))
    form = F.coalesce(*[F.when(F.col("s").rlike(pattern), F.lit(name)) for name, pattern in FORMS.items()])
    verb, noun, second = (F.explode(F.array(*[F.lit(x) for x in parts])) for parts in (VERBS, NOUNS, ["", *NOUNS[::5]]))
    made_up = texts.sparkSession.range(1).select(verb.alias("verb")).select("verb", noun.alias("noun")).select("verb", "noun", second.alias("second"))
    names = made_up.select(F.concat_ws("_", "verb", "noun", F.nullif("second", F.lit(""))).alias("function"))
    spaced = F.initcap(F.replace(F.col("function"), F.lit("_"), F.lit(" ")))
    joined = F.replace(spaced, F.lit(" "), F.lit(""))
    number = F.length("function") % 10
    cases = F.array("function", F.upper("function"), joined, F.concat("function", F.lit("_"), F.reverse(F.split("function", "_"))[0]),
                    F.concat("function", number.cast("string")), F.concat(joined, number.cast("string")))
    known = names.select(F.lit("identifiers").alias("form"), F.explode(cases).alias("s"))
    day = F.expr("timestamp_seconds(600000000 + id * 7654321)")
    stamps = texts.sparkSession.range(200).select(F.explode(F.array(
        *[F.date_format(day, f) for f in ("yyyy-MM-dd'T'HH-mm-ss", "yyyyMMddHHmmss", "'build'-yyyy-MM-dd-'rc'd", "'v'y-M-d_HHmm")]
    )).alias("s"))
    known = known.unionByName(stamps.select(F.lit("identifiers").alias("form"), "s"))
    return made.unionByName(values).select(form.alias("form"), "s"), words.select(F.lit("words").alias("form"), "s").unionByName(known)


def log_likelihoods(counts: dict[tuple[str, str], int]) -> list[float]:
    """The log of what follows each character, row by row, with back-off to the characters' frequency."""
    seen = {b: SMOOTHING + sum(n for (_, second), n in counts.items() if second == b) for b in CHARACTERS}
    every = sum(seen.values())
    found = []
    for a in CHARACTERS:
        row = [counts.get((a, b), 0) for b in CHARACTERS]
        found += [math.log((n + BACK_OFF * seen[b] / every) / (sum(row) + BACK_OFF)) for n, b in zip(row, CHARACTERS)]
    return found


def train(random: DataFrame, ordinary: DataFrame) -> dict[str, list[float]]:
    """Per form of string, the log-likelihoods of pairs of characters."""
    counts: dict[str, dict[tuple[str, str], int]] = {form: {} for form in (*FORMS, *ORDINARY)}
    for r in _pairs(random.unionByName(ordinary)).collect():  # at most one row per form and pair of the alphabet
        counts[r["form"]][r["a"], r["b"]] = r["count"]
    return {form: log_likelihoods(c) for form, c in counts.items()}


def randomness(word: Column, models: dict[str, list[float]]) -> Column:
    """Mean log-likelihood ratio of the pairs of a string of ``CHARACTERS``: random against ordinary."""

    def total(pairs: Column, form: str) -> Column:
        numbers = F.expr(f"array({', '.join(f'{x:.6f}D' for x in models[form])})")
        return F.aggregate(pairs, F.lit(0.0), lambda held, p: held + F.coalesce(F.get(numbers, p), F.lit(0.0)))

    index = F.transform(F.split(word, ""), lambda c: F.instr(F.lit(CHARACTERS), c) - 1)
    pairs = bind(index, lambda at: F.transform(at, lambda x, i: x * len(CHARACTERS) + F.get(at, i + 1)))
    ratio = bind(pairs, lambda p: F.greatest(*[total(p, f) for f in FORMS]) - F.greatest(*[total(p, f) for f in ORDINARY]))
    return ratio / (F.length(word) - 1)


def random_spans(text: Column, known: Column, models: dict[str, list[float]]) -> Column:
    """Candidates outside of the ``known`` spans that the models call random."""
    made = find(
        text, CANDIDATE, lambda start, end, match, _: F.struct(
            start.alias("start"), F.lit(len(KINDS)).alias("kind"), end.alias("end"), match.alias("match")
        ), "struct<start:bigint,kind:int,end:bigint,match:string>",
    )
    free = F.filter(made, lambda s: _judged(s["match"]) & ~overlaps(known, s["start"], s["end"]))
    least = lambda m: F.greatest(F.lit(THRESHOLD), EVIDENCE / (F.length(m) - 1))
    found = F.filter(free, lambda s: randomness(s["match"], models) > least(s["match"]))
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end")))


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and ``secrets``, an array of ``start, kind, end``, per row of ``docs``.

    Kinds are numbers into ``[*KINDS, "random"]``; spans are ordered by start, then kind, in code points, ends
    exclusive. Spans of the fixed patterns always stay. A null or empty text has none. Rows count by
    themselves, whether they repeat or lack an id; other columns are ignored; an empty table gives an empty one.
    """
    texts = docs.select("doc_id", whole_text(text).alias("text"))
    models = train(*training_strings(texts))
    known = texts.select("doc_id", "text", known_spans(F.col("text")).alias("known"))
    more = random_spans(F.col("text"), F.col("known"), models)
    return known.select("doc_id", F.sort_array(F.concat("known", more)).cast(f"array<{SPAN}>").alias("secrets"))


def secret_report(docs: DataFrame) -> DataFrame:
    """The contract's columns: counts and digest of the fixed patterns' spans, and all spans as text."""
    found = scan_secrets(docs)
    base = F.filter("secrets", lambda s: s["kind"] < len(KINDS))
    return found.select("doc_id", "secrets", base.alias("base")).select(
        "doc_id", *[n_of(F.col("base"), k).alias(f"n_{name}") for k, name in enumerate(KINDS)],
        F.sha2(written(F.col("base"), KINDS), 256).alias("base_sha256"), written(F.col("secrets"), [*KINDS, "random"]).alias("spans"),
    )
