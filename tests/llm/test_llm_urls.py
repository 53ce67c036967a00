import random

import pytest
from edge_cases import rows_of
from pyspark.sql import functions as F

from wardflow.llm import urls
from wardflow.sources.shared import materialised

SCHEMA = "page_id long, url string, html string"
CASES = [
    "https://a.example.net/en/1",
    "https://a.example.net/de/1",
    "http://example.com/de/x?y#z",
    "http://example.com/de",
    "HTTP://WWW.Example.COM/de/",
    "http://notexample.com/de/",
    "http://fr.org/fr/1",
    "http://org/fr/",
    "http://x.net",
    "http://x.net?/en/",
    "http://.net/",
    "http://x.net./",
    "http://a://b.net/",
    "no scheme.net/en/",
    "://net/",
    "",
    None,
    "http://cheap-pills.info/a",
    "http://cheappills.info/a",
    "http://casino-win.example.org/fr/1",
    "http://example.com:80/de/",
    "http://ÉCOLE.net/\n",
    "http://" + "a." * 50_000 + "net/" + "b/" * 50_000,
    "https://a.example.net/en/1",
]


def pages(spark, cases=None):
    rows = [(i, u, None) for i, u in enumerate(CASES if cases is None else cases)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_force(rows, listed, rules=urls.RULES):
    out = []
    for page_id, url in rows:
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
            stop = next((i for i, c in enumerate(rest) if c in "?#" and i >= end), len(rest))
            host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:stop]
        fits = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=(0, None, "block" if host in listed else "allow"))
        out.append((page_id, host, path, *best[1:]))
    return sorted(out, key=str)


def hosts(spark, names):
    return spark.createDataFrame([(n,) for n in names], "host string")


def test_edge_cases_against_brute_force(spark):
    more = pages(spark).select("*", *[F.lit(i).alias(c) for i, c in enumerate([*urls.ADDED, "key", "listed", "n"])])
    got = urls.judge(more, urls.spam_hosts(more))
    assert set(got.columns) == set(more.columns)
    listed = {"cheap-pills.info", "casino-win.example.org"}
    assert rows_of(got.select("page_id", *urls.ADDED)) == brute_force(list(enumerate(CASES)), listed)


@pytest.mark.parametrize("rules", [urls.RULES, ()])
def test_empty_tables(spark, rules):
    assert urls.judge(pages(spark, []), hosts(spark, ["a"]), rules).collect() == []
    got = urls.judge(pages(spark, ["http://b.info/", "http://c.info/"]), hosts(spark, []), rules)
    assert [r.verdict for r in got.collect()] == ["allow", "allow"]


@pytest.mark.parametrize("max_bits", [urls.MAX_BITS, 4000])
def test_many_rules_and_hosts_against_brute_force(spark, max_bits):
    """With few bits the list is dealt into shards; the answers stay."""
    draw = random.Random(3)
    names = [f"h{i}.{draw.choice('abc')}.example.{draw.choice(['com', 'net', 'org'])}" for i in range(3000)]
    made = [f"http://{n}/{draw.choice(['en', 'de', 'fr'])}/{draw.randrange(9)}" for n in names]
    rules = tuple({(n, p): (draw.choice(["allow", "block"]), n, p) for n in ["net", "a.example.com", *names[:40]] for p in ["/", "/en/"]}.values())
    listed = set(draw.sample(names, 700))
    got = urls.judge(pages(spark, made), hosts(spark, [*listed, "elsewhere.info", None]), rules, max_bits)
    assert rows_of(got.select("page_id", *urls.ADDED)) == brute_force(list(enumerate(made)), listed, rules)


def test_cascade_is_exact_over_its_universe(spark):
    universe = spark.range(20_000).select(F.concat(F.lit("k"), "id").alias("key"), (F.col("id") % 50 == 0).alias("listed"))
    cascade = urls.build(universe)
    assert len(cascade.filters) > 2 and sum(f.bits for f in cascade.filters) < 40 * 400
    assert universe.where(cascade.listed(F.col("key")) != F.col("listed")).isEmpty()
    for share, answer in ((F.lit(False), False), (F.lit(True), True)):
        same = universe.select("key", share.alias("listed"))
        assert same.where(urls.build(same).listed(F.col("key")) != answer).isEmpty()


def test_judging_is_native_and_moves_nothing(spark, capsys):
    got = urls.judge(materialised(pages(spark)), hosts(spark, ["cheap-pills.info"]))
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Exchange", "Join", "Python", "Arrow"))
