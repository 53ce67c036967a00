"""Exact URL filters by cascades of Bloom filters, in DataFrame operations only.

A cascade answers whether a key is listed, for every key that the corpus can ask for: its
first filter holds the listed keys, the next one the unlisted keys that the first lets
through, the next one the listed keys that those two let through, and so on until none is
left. A key's answer is that of the first filter that does not hold it, so each URL is
judged by bits alone, where it is read: no join, no shuffle. The first filter lets through
about n / u of the u unlisted keys for n listed ones, later ones 1 in 2^LATER_HASHES.

Keys are ``suffix of the host + start of the path``, for each pair of (number of labels,
length of the path) that occurs among the rules, and the whole host. There are two
cascades, of what is to be blocked and of what is to be allowed; each holds its rules, and
the first the block list of whole hosts too. Of the rules that fit a URL the longest wins,
and a URL that no rule fits is blocked if its host is on the list.

Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case, a
port included; path: from there up to ``?``, ``#`` or the end. A rule fits its host and
all subdomains, if the path starts with the rule's.

The bits of a cascade are bounded by MAX_BITS; they reach the driver and the tasks as
literals. A list that needs more is dealt into shards by a hash of the key: each shard has
its own cascade over its part of the universe, and the pages are read once per shard.

Defined cases: NULL or no ``://`` gives an empty host and path, which no rule fits. Equal
URLs and rows are judged alike. Empty tables give no rows. ``host``, ``path``, ``rule``
and ``verdict`` of the input give way, all other columns are kept.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from math import ceil, log, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardflow.sources.shared import materialised

#: verdict, host, path
Rule = tuple[str, str, str]
ALLOW, BLOCK = "allow", "block"
RULES: tuple[Rule, ...] = (
    (BLOCK, "net", "/"),
    (ALLOW, "example.net", "/en/"),
    (BLOCK, "example.com", "/de/"),
    (ALLOW, "org", "/fr/"),
)
#: Stand-in for a block list: hosts with one of these as a part of a label.
SPAM_WORDS = ("ads", "bets", "casino", "pills", "spam")
ADDED = ["host", "path", "rule", "verdict"]

#: Hash functions of the filters after the first: each keeps 1 key in 2^LATER_HASHES by mistake.
LATER_HASHES = 4
MAX_BITS = 1 << 26
WORD = 64


@dataclass(frozen=True)
class Filter:
    bits: int
    hashes: int
    words: list[int]  # 64 bits each


@dataclass
class Cascade:
    filters: list[Filter] = field(default_factory=list)

    def listed(self, key: Column) -> Column:
        """Whether ``key`` of the universe is listed."""
        answer = F.lit(len(self.filters) % 2 == 1)
        for level in reversed(range(len(self.filters))):
            held = _held(key, level, self.filters[level])
            answer = F.when(held, answer).otherwise(F.lit(level % 2 == 1))
        return answer


def _place(key: Column, level: int, i: int, bits: int) -> Column:
    """Place i of ``key``: two halves of one hash, the second one odd."""
    h = F.xxhash64(key, F.lit(level))
    first, second = h.bitwiseAND(F.lit((1 << 32) - 1)), F.shiftrightunsigned(h, 32).bitwiseOR(F.lit(1))
    return (first + second * i) % bits


def _held(key: Column, level: int, f: Filter) -> Column:
    words = F.split(F.lit(",".join(map(str, f.words))), ",").cast("array<bigint>")
    held = F.lit(True)
    for i in range(f.hashes):
        at = _place(key, level, i, f.bits)
        word = F.get(words, F.shiftright(at, 6).cast("int"))
        # F.get reads the constant array; the bit is moved to the lowest place
        held = held & (F.call_function("shiftrightunsigned", word, (at % WORD).cast("int")) % 2 != 0)
    return held


def _encode(keys: DataFrame, n: int, level: int, hashes: int) -> Filter:
    bits = ceil(n * hashes / log(2) / WORD) * WORD
    places = F.explode(F.array(*[_place(F.col("key"), level, i, bits) for i in range(hashes)]))
    words = (
        keys.select(places.alias("_at"))
        .groupBy(F.shiftright("_at", 6).cast("int").alias("_word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(_at % 64 as int))")).alias("_bits"))
        .collect()
    )
    values = [0] * (bits // WORD)
    for row in words:
        values[row["_word"]] = row["_bits"]
    return Filter(bits, hashes, values)


def _first_hashes(n: int, others: int) -> int:
    return max(1, min(32, round(log2(max(2, others / max(1, n))))))


def build(universe: DataFrame) -> Cascade:
    """The cascade of a table of all keys, each once: ``key`` and ``listed``."""
    cascade, alive = Cascade(), universe.select("key", "listed")
    while True:
        level = len(cascade.filters)
        encode = F.col("listed") if level % 2 == 0 else ~F.col("listed")
        n, others = alive.agg(F.count_if(encode), F.count_if(~encode)).collect()[0]
        if n == 0:
            return cascade
        one = _encode(alive.where(encode), n, level, LATER_HASHES if level else _first_hashes(n, others))
        cascade.filters.append(one)
        # what the next filters must tell apart: all encoded here, and the others let through by mistake
        alive = materialised(alive.where(encode | _held(F.col("key"), level, one)))


def with_answers(df: DataFrame, asked: dict[str, Column], universe: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``df`` with a boolean column per name of ``asked``: whether its key, one of ``universe``, is listed."""
    n, others = universe.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).collect()[0]
    shards = 1 + ceil(n * (_first_hashes(n, others) + 2 * LATER_HASHES) / log(2)) // max_bits
    for shard in range(shards):

        def here(key: Column) -> Column:
            return F.pmod(F.xxhash64(key, F.lit("shard")), F.lit(shards)) == shard if shards > 1 else F.lit(True)

        cascade = build(universe.where(here(F.col("key"))))
        before = {name: F.col(name) if shard else F.lit(False) for name in asked}
        df = df.withColumns({x: F.when(here(k), cascade.listed(k)).otherwise(before[x]) for x, k in asked.items()})
        if shard + 1 < shards:
            df = materialised(df)
    return df


def parsed(url: Column) -> tuple[Column, Column]:
    """Host and path."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def shapes(rules: tuple[Rule, ...]) -> list[tuple[int, int]]:
    """Number of labels of the host and length of the path of the rules, each pair once."""
    return sorted({(host.count(".") + 1, len(path)) for _, host, path in rules})


def rule_key(labels: int, length: int) -> Column:
    """The key of this shape of a row with host and path; NULL if it has none."""
    # more labels than the host has give the whole host
    enough = (F.length("path") >= length) & (F.size(F.split("host", r"\.")) >= labels)
    suffix = F.substring_index("host", ".", -labels)
    return F.when(enough & (suffix != ""), F.concat(suffix, F.substring("path", 1, length)))


def spam_hosts(pages: DataFrame, words: tuple[str, ...] = SPAM_WORDS) -> DataFrame:
    """Hosts of the pages of which a label has one of ``words`` between hyphens or its ends."""
    host, _ = parsed(F.col("url"))
    hosts = pages.select(host.alias("host")).distinct()
    return hosts.where(F.col("host").rlike(rf"(\A|[.-])({'|'.join(words)})([.-]|\z)"))


def judge(pages: DataFrame, listed: DataFrame, rules: tuple[Rule, ...] = RULES, max_bits: int = MAX_BITS) -> DataFrame:
    """The pages with ADDED. ``listed`` has a column host: whole hosts that are to be blocked."""
    host, path = parsed(F.col("url"))
    kept = [c for c in pages.columns if c not in ADDED]
    placed = pages.select(*kept, host.alias("host"), path.alias("path"))
    # keys of rules and of whole hosts never meet
    keys = [F.concat(F.lit("rule:"), rule_key(*shape)) for shape in shapes(rules)]
    whole = F.concat(F.lit("host:"), "host")
    asked = placed.select(F.explode(F.array(*keys, whole)).alias("key")).where("key is not null").distinct()
    named = [(f"rule:{h}{p}", v == ALLOW, v == BLOCK) for v, h, p in rules]
    marks = asked.select("key", F.lit(False).alias(ALLOW), F.lit(False).alias(BLOCK))
    marks = marks.unionByName(pages.sparkSession.createDataFrame(named, f"key string, {ALLOW} boolean, {BLOCK} boolean"))
    marks = marks.unionByName(
        listed.where("host is not null").select(
            F.concat(F.lit("host:"), "host").alias("key"), F.lit(False).alias(ALLOW), F.lit(True).alias(BLOCK)
        )
    )
    universe = materialised(marks.groupBy("key").agg(*[F.bool_or(v).alias(v) for v in (ALLOW, BLOCK)]))
    answered = placed
    for verdict, more in ((ALLOW, {}), (BLOCK, {"_listed": whole})):
        asked_for = {f"_{verdict}{i}": k for i, k in enumerate(keys)} | more
        of_list = universe.select("key", F.col(verdict).alias("listed"))
        answered = with_answers(answered, asked_for, of_list, max_bits)

    def found(i: int, shape: tuple[int, int]) -> Column:
        verdict = F.when(F.col(f"_{ALLOW}{i}"), ALLOW).when(F.col(f"_{BLOCK}{i}"), BLOCK)
        key = rule_key(*shape)
        return F.when(key.isNotNull() & verdict.isNotNull(), F.struct(F.length(key).alias("n"), key.alias("rule"), verdict.alias("verdict")))

    fitting = F.array(*[found(i, shape) for i, shape in enumerate(shapes(rules))])
    longest = F.array_max(fitting.cast("array<struct<n:int,rule:string,verdict:string>>"))
    return answered.withColumn("_rule", longest).select(
        *kept,
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("_listed"), BLOCK).otherwise(ALLOW)).alias("verdict"),
    )
