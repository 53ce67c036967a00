"""Secrets in text: fixed formats, and a randomness test battery, in DataFrame operations only.

Fixed formats are assignments to names of secrets, access keys and long hex runs. The
battery looks at all other long runs of token characters, which hold '=' at their end only,
so that the value in NAME=VALUE is a run of its own. A run that mixes the signs of base64
and base64url is cut into its longest parts that do not. A run's encoding is inferred
from its characters, which become numbers 0 to m - 1. Three tests ask whether the numbers
could be random: chi-squared uniformity over the alphabet, runs above and below its middle,
and serial correlation of neighbours. The smallest of the three p-values, times three, is
the run's. Over all runs of one encoding and one class of length the Benjamini-Hochberg
step-up rule picks those that are not random, with a share of false picks below ``rate``.
What is left is reported if it is long enough for its alphabet: below ``least_length`` even
plain words would pass the chi-squared test.

Upper-case or lower-case hex is its own class and never read in a wider alphabet. Words
rarely fit it, but numbers do, so a fourth test asks whether its letters are 6 in 16.

Step-up needs only how many p-values lie below each other: they are counted in bins of a
fixed number per class, and the counts alone come to the driver.

Defined cases: NULL text is an empty one, without spans. Positions are code points. Runs
that overlap a fixed format are not tested. Rows with one doc_id are rows of their own.
Extra columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import text_of
from wardflow.sources.shared import materialised

#: Fixed patterns. Java's (?i) folds ASCII letters only.
#: An assignment's value needs 6 characters; shorter ones are dropped after the match.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: The run is as long as it can be, so asking for the least length finds the same spans.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
TOKEN = r"[A-Za-z0-9+/_-]{20,}(?:=+(?![A-Za-z0-9+/_=-]))?"
#: Within a run: from the first to the last of neighbouring signs of one encoding.
SIGNS = r"[+/](?:[A-Za-z0-9+/]*[+/])?|[_-](?:[A-Za-z0-9_-]*[_-])?"
KINDS = ["assign", "access", "hex", "random"]

LOW, UP, DIGIT = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings from narrow to wide: pattern of a run, and its alphabet.
ENCODINGS = [
    ("hex", "[0-9a-f]+|[0-9A-F]+", DIGIT + "abcdef"),
    ("base32", "[A-Z2-7]+=*", UP + "234567"),
    ("lower36", "[a-z0-9]+", DIGIT + LOW),
    ("upper36", "[A-Z0-9]+", DIGIT + UP),
    ("base62", "[A-Za-z0-9]+", UP + LOW + DIGIT),
    ("base64", "[A-Za-z0-9+/]+=*", UP + LOW + DIGIT + "+/"),
    ("base64url", "[A-Za-z0-9_-]+=*", UP + LOW + DIGIT + "-_"),
]
#: Words rarely fit hex, so this length suffices there.
LEAST_HEX = 20
#: Chance that two letters of plain text are equal.
COINCIDENCE = 0.066
#: Bins of -log10 p per class, and their width.
BINS, WIDTH = 400, 0.05


def least_length(alphabet: int) -> int:
    """Length from which plain words fail the chi-squared test at 5 % four times in five.

    At length n their statistic exceeds its mean by about (m * coincidence - 1) * n, in
    deviations of sqrt(2 (m - 1)); 2.5 deviations are asked for.
    """
    lift = abs(alphabet * COINCIDENCE - 1)
    return max(20, math.ceil(2.5 * math.sqrt(2 * (alphabet - 1)) / max(lift, 0.2)))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _running(values: Column, join) -> Column:
    """``join`` of all values up to each place, by strides that double: n log n steps at any length."""

    def scan(known: Column) -> Column:
        rounds = F.ceil(F.log2(F.greatest(F.size(known), F.lit(2)))).cast("int")
        strides = F.transform(F.sequence(F.lit(0), rounds - 1), lambda k: F.pow(F.lit(2), k).cast("int"))
        return F.aggregate(strides, known, further)

    def further(sums: Column, stride: Column) -> Column:
        return F.transform(
            sums, lambda x, i: F.when(i < stride, x).otherwise(join(x, F.get(sums, i - stride)))
        )

    return _let(values, scan)


def _sum_of_two(x: Column, y: Column) -> Column:
    return x + y


NO_SPANS = "array<struct<start:int,kind:int,end:int,value:string>>"


def _span(start: Column, kind, end: Column, value: Column) -> Column:
    return F.struct(start.alias("start"), kind.alias("kind"), end.alias("end"), value.alias("value"))


def _found(pattern: str, kind: int, group: int = 0, least: int = 0) -> Column:
    """Array of (start, kind, end, value) of all matches with ``least`` characters in ``group``.

    The text between the matches tells their places.
    """
    gaps = F.transform(F.split("text", pattern, -1), lambda x: F.length(x))
    whole = F.transform(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)), lambda w: F.length(w))
    named = F.regexp_extract_all("text", F.lit(pattern), F.lit(group))

    def placed(sizes: Column) -> Column:
        # there is one gap more than there are matches
        steps = F.zip_with(gaps, sizes, lambda g, n: g + F.coalesce(n, F.lit(0)))
        return _let(_running(steps, _sum_of_two), lambda ends: matched(sizes, ends))

    def matched(sizes: Column, ends: Column) -> Column:
        spans = F.transform(
            named,
            lambda v, i: _span(F.get(ends, i) - F.get(sizes, i), F.lit(kind), F.get(ends, i), v),
        )
        return F.filter(spans, lambda s: F.length(s["value"]) >= least) if least else spans

    # most texts hold no match, and need one look
    return F.when(F.regexp_like("text", F.lit(pattern)), _let(whole, placed)).otherwise(F.array().cast(NO_SPANS))


def _apart(base: Column, runs: Column) -> Column:
    """The runs that overlap no base span.

    In the order of their starts, a run lies apart if no base span before it ends beyond its
    start and none after it starts before its end.
    """

    def held(spans: Column) -> Column:
        ends = F.transform(spans, lambda s: F.when(s["kind"] == 3, F.lit(-1)).otherwise(s["end"]))
        starts = F.transform(
            F.reverse(spans), lambda s: F.when(s["kind"] == 3, F.lit(2**31 - 1)).otherwise(s["start"])
        )
        return _let(
            _running(ends, F.greatest),
            lambda e: _let(F.reverse(_running(starts, F.least)), lambda b: chosen(spans, e, b)),
        )

    def chosen(spans: Column, ends: Column, starts: Column) -> Column:
        def free(s: Column, i: Column) -> Column:
            return (s["kind"] == 3) & (F.get(ends, i) <= s["start"]) & (F.get(starts, i) >= s["end"])

        return F.filter(spans, free)

    both = F.array_sort(F.concat(base, runs))
    return F.when((F.size(base) == 0) | (F.size(runs) == 0), runs).otherwise(_let(both, held))


def _tail(z: Column) -> Column:
    """P(Z > z) of a normal deviate, by a rational approximation (error below 1e-7)."""
    x = F.abs(z)
    t = 1 / (1 + 0.2316419 * x)
    poly = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    upper = F.exp(-x * x / 2) / math.sqrt(2 * math.pi) * poly
    return F.when(z >= 0, upper).otherwise(1 - upper)


def _sum(values: Column, of) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + of(x))


def _p_value(codes: Column, m: Column) -> Column:
    """The smallest p-value of the battery times the number of its tests, four for hex."""
    n, middle = F.size(codes).cast("double"), F.floor(m / 2)
    counts = F.transform(F.sequence(F.lit(0), m - 1), lambda k: F.size(F.filter(codes, lambda c: c == k)))
    chi = _sum(counts, lambda c: c * c.cast("double")) * m / n - n
    z_uniform = (chi - (m - 1)) / F.sqrt(2 * (m - 1) * (n - 1) / n)
    ups = F.size(F.filter(codes, lambda c: c >= middle)).cast("double")
    pairs = F.zip_with(
        F.slice(codes, 1, F.size(codes) - 1),
        F.slice(codes, 2, F.size(codes) - 1),
        lambda x, y: F.struct(x.alias("x"), y.alias("y")),
    )
    turns = F.size(F.filter(pairs, lambda p: (p["x"] >= middle) != (p["y"] >= middle))).cast("double") + 1
    twice = 2 * ups * (n - ups)
    spread = F.sqrt(F.greatest(twice * (twice - n), F.lit(0.0)) / (n * n * (n - 1)))
    z_runs = F.when(spread > 0, (turns - twice / n - 1) / spread).otherwise(F.lit(9.0))

    def serial(mean: Column) -> Column:
        power = _sum(codes, lambda c: (c - mean) * (c - mean))
        lag = _sum(pairs, lambda p: (p["x"] - mean) * (p["y"] - mean))
        return F.when(power > 0, lag / power * F.sqrt(n)).otherwise(F.lit(9.0))

    z_serial = _let(_sum(codes, lambda c: c.cast("double")) / n, serial)
    p = F.least(_tail(z_uniform), 2 * _tail(F.abs(z_runs)), 2 * _tail(F.abs(z_serial)))
    letters = F.size(F.filter(codes, lambda c: c >= 10)).cast("double")
    z_letters = (letters - n * 6 / 16) / F.sqrt(n * 6 / 16 * 10 / 16)
    hexed = F.when(m == 16, 4 * F.least(p, 2 * _tail(F.abs(z_letters)))).otherwise(3 * p)
    return F.least(F.lit(1.0), hexed)


def _tested(span: Column) -> Column:
    """The span with its encoding's number (-1: none), its class and the bin of its p-value."""
    bare = F.regexp_replace(span["value"], "=+$", "")
    mixed = bare.rlike("[0-9]") & bare.rlike("[A-Za-z]")
    number = F.lit(-1)
    for i, (name, pattern, alphabet) in reversed(list(enumerate(ENCODINGS))):
        least = LEAST_HEX if name == "hex" else least_length(len(alphabet))
        own = F.when(F.length(bare) >= least, i).otherwise(-1)
        number = F.when(span["value"].rlike(f"^({pattern})$"), own).otherwise(number)
    number = F.when(mixed, number).otherwise(-1)
    return _let(number, lambda known: _weighed(span, bare, known))


def _weighed(span: Column, bare: Column, number: Column) -> Column:
    alphabet = F.get(F.array(*[F.lit(a) for _, _, a in ENCODINGS]), number)
    folded = F.when(number == 0, F.lower(bare)).otherwise(bare)
    codes = F.transform(F.split(folded, ""), lambda c: F.instr(alphabet, c) - 1)
    tested = _let(codes, lambda c: _let(F.length(alphabet), lambda m: _p_value(c, m)))
    p = F.when(number >= 0, tested).otherwise(F.lit(1.0))
    length_class = F.floor(F.log2(F.greatest(F.length(bare), F.lit(1)))).cast("int")
    weight = F.least(F.lit(BINS - 1), F.floor(-F.log10(F.greatest(p, F.lit(1e-30))) / WIDTH).cast("int"))
    return F.struct(
        span["start"].alias("start"),
        span["kind"].alias("kind"),
        span["end"].alias("end"),
        (number * 100 + length_class).alias("cls"),
        weight.alias("bin"),
        (number >= 0).alias("known"),
    )


def _parts(run: Column) -> Column:
    """The run, or if no encoding fits it the longest parts that one fits.

    Neighbouring parts could both hold the letters and digits between them; the longer
    one does.
    """

    def cut(words: Column, signs: Column) -> Column:
        sizes = F.transform(
            signs, lambda x, i: F.length(F.get(words, i)) + F.length(x) + F.length(F.get(words, i + 1))
        )
        return _let(sizes, lambda n: F.transform(signs, lambda x, i: joined(words, n, x, i)))

    def joined(words: Column, n: Column, sign: Column, i: Column) -> Column:
        before = (i == 0) | (F.get(n, i) > F.get(n, i - 1))
        after = (i == F.size(n) - 1) | (F.get(n, i) >= F.get(n, i + 1))
        none = F.lit("")
        return F.concat(
            F.when(before, F.get(words, i)).otherwise(none), sign, F.when(after, F.get(words, i + 1)).otherwise(none)
        )

    def placed(parts: Column) -> Column:
        lengths = F.transform(parts, lambda part: F.length(part))
        return _let(_running(lengths, _sum_of_two), lambda ends: spanned(parts, ends))

    def spanned(parts: Column, ends: Column) -> Column:
        def span(part: Column, i: Column) -> Column:
            end = run["start"] + F.get(ends, i)
            return _span(end - F.length(part), run["kind"], end, part)

        return F.filter(F.transform(parts, span), lambda s: F.length(s["value"]) >= 20)

    value = run["value"]
    words, signs = F.split(value, SIGNS, -1), F.regexp_extract_all(value, F.lit(SIGNS), F.lit(0))
    parts = _let(words, lambda w: _let(signs, lambda s: _let(cut(w, s), placed)))
    return F.when(value.rlike("[+/]") & value.rlike("[_-]"), parts).otherwise(F.array(run))


def _spans(docs: DataFrame) -> DataFrame:
    """doc_id, the base spans, and the tested runs beside them; written once."""
    base = F.concat(_found(ASSIGN, 0, 2, 6), _found(ACCESS, 1), _found(HEX, 2))
    found = docs.select("doc_id", text_of().alias("text")).select(
        "doc_id", base.alias("base"), F.flatten(F.transform(_found(TOKEN, 3), _parts)).alias("runs")
    )
    bare = F.transform(
        "base", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    )
    tested = F.filter(F.transform(_apart(F.col("base"), F.col("runs")), _tested), lambda r: r["known"])
    return materialised(found.select("doc_id", F.array_sort(bare).alias("base"), tested.alias("runs")))


def _rejected_from(spans: DataFrame, rate: float) -> dict[int, int]:
    """Per class the lowest bin whose runs are picked as not random.

    At most BINS counts per class of encoding and length.
    """
    runs = spans.select(F.explode("runs").alias("r")).groupBy("r.cls", "r.bin").count().collect()
    bins: dict[int, dict[int, int]] = {}
    for cls, at, n in runs:
        bins.setdefault(cls, {})[at] = n
    lowest = {}
    for cls, counts in bins.items():
        whole, rank, bound = sum(counts.values()), 0, BINS
        for at in sorted(counts, reverse=True):  # rising p
            rank += counts[at]
            if 10 ** (-at * WIDTH) <= rate * rank / whole:  # the bin's largest p-value
                bound = at
        lowest[cls] = bound
    return lowest


def find_secrets(docs: DataFrame, rate: float = 0.05) -> DataFrame:
    """doc_id, ``base`` and ``spans``: arrays of (start, kind, end) in order; kind counts KINDS."""
    spans = _spans(docs)
    lowest = _rejected_from(spans, rate)
    kept: Column = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    if lowest:
        bound = F.create_map(*[F.lit(x) for pair in lowest.items() for x in pair])
        random = F.filter("runs", lambda r: r["bin"] < F.element_at(bound, r["cls"]))
        kept = F.transform(
            random, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
        )
    return spans.select("doc_id", "base", F.array_sort(F.concat("base", kept)).alias("spans"))


def as_text(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"], s["end"])), ","
    )


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint")
