"""How document filters act in each order, from decision diagrams over their failure masks.

Each document gets the set of filters that it fails. Documents are counted per part and
mask before anything moves, so a part is at most 2^k rows whatever its size. From these a
diagram with counts on its nodes is built per part; swaps of adjacent levels lead it
through all orders, and in each order the path on which all filters pass reads off what
every step removes and keeps. A swap touches two levels only.

Filters: A under 200 words; B less than half of the words distinct; C over 3 % of the code
points in A-Z; D any of # $ % & * |; E equal to the text of a smaller doc_id. Equal texts
are found by their SHA-256.

Defined cases: a NULL text is empty, a NULL lang is the part ''. A NULL doc_id is never
smaller than another and has no labels; rows that repeat the smallest doc_id of a text
pass E alike. Several labels of one document count once, as 1 if any is 1. Words are
counted in whole texts of any length. Without documents there are no rows. Extra columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardflow.llm.common import text_of
from wardflow.sources.shared import materialised

FILTERS = "ABCDE"
MIN_WORDS = 200
BLANKS = " \t\n\x0b\x0c\r"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WEIGHTS = ["n", "good", "toxic"]
MEASURES = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
ROWS = "part string, filter_order string, step int, " + ", ".join(f"{m} long" for m in MEASURES)

Weight = tuple[int, ...]


def failure_masks(docs: DataFrame) -> DataFrame:
    """doc_id, part and ``mask``, whose bit i says that filter i of FILTERS fails."""
    trimmed = F.btrim("t", F.lit(BLANKS))
    words = F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, f"[{BLANKS}]+"))
    size, distinct = F.size("w"), F.size(F.array_distinct("w"))
    capitals = F.length("t") - F.length(F.translate("t", CAPITALS, ""))
    alone = [
        size < MIN_WORDS,
        100 * distinct < 50 * size,
        100 * capitals > 3 * F.length("t"),
        F.col("t").rlike("[#$%&*|]"),
    ]
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(alone)), F.lit(0))
    texts = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("part"), text_of().alias("t"))
    narrow = materialised(
        texts.select("*", words.alias("w")).select(
            "doc_id", "part", bits.alias("_alone"), F.unhex(F.sha2(F.col("t").cast("binary"), 256)).alias("_text")
        )
    )
    held = narrow.groupBy("_text").agg(F.min("doc_id").alias("_first"), F.count("*").alias("_n"))
    repeated = held.where("_n > 1").select("_text", "_first")
    later = F.coalesce(F.col("doc_id") > F.col("_first"), F.lit(False))
    mask = F.col("_alone") + F.when(later, 1 << len(alone)).otherwise(0)
    return narrow.join(repeated, "_text", "left").select("doc_id", "part", mask.alias("mask"))


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part and mask the documents, and those labelled good and toxic."""
    known = labels.groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("_good"),
        F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"),
    )
    joined = masks.join(known, "doc_id", "left")
    total = [F.coalesce(F.sum(c), F.lit(0)).alias(n) for c, n in (("_good", "good"), ("_toxic", "toxic"))]
    return joined.groupBy("part", "mask").agg(F.count("*").alias("n"), *total)


class Diagram:
    """Levels of nodes (pass child, fail child); equal nodes are one, no level is skipped.

    Level i tests filter ``order[i]``; children are places in the level below, whose last
    one holds the weights of single masks. ``totals`` are the weights below each node.
    """

    def __init__(self, weights: dict[int, Weight], filters: int) -> None:
        self.order = list(range(filters))
        self.levels: list[list] = [[] for _ in range(filters + 1)]
        places: list[dict] = [{} for _ in self.levels]
        zero = (0,) * len(next(iter(weights.values()), (0,)))

        def place(level: int, node: tuple) -> int:
            at = places[level].setdefault(node, len(places[level]))
            if at == len(self.levels[level]):
                self.levels[level].append(node)
            return at

        def build(level: int, masks: list[int]) -> int:
            if level == filters:
                return place(level, weights[masks[0]] if masks else zero)
            passing = [m for m in masks if not m >> level & 1]
            failing = [m for m in masks if m >> level & 1]
            return place(level, (build(level + 1, passing), build(level + 1, failing)))

        build(0, list(weights))
        self.totals: list[list[Weight]] = [[] for _ in self.levels]
        self.totals[filters] = self.levels[filters]
        for level in reversed(range(filters)):
            self._add_up(level)

    def _add_up(self, level: int) -> None:
        below = self.totals[level + 1]
        self.totals[level] = [tuple(map(sum, zip(below[p], below[f]))) for p, f in self.levels[level]]

    def swap(self, i: int) -> None:
        """Exchange the filters of levels i and i + 1; the nodes of level i keep their places."""
        below, fresh = self.levels[i + 1], {}
        for at, (p, f) in enumerate(self.levels[i]):
            (pp, pf), (fp, ff) = below[p], below[f]
            self.levels[i][at] = tuple(fresh.setdefault(x, len(fresh)) for x in ((pp, fp), (pf, ff)))
        self.levels[i + 1] = list(fresh)
        self._add_up(i + 1)
        self.order[i], self.order[i + 1] = self.order[i + 1], self.order[i]

    def all_pass(self) -> Iterator[tuple[int, Weight, Weight]]:
        """Per level its filter, the weight that fails there, and the weight that passes on."""
        node = 0
        for level, filter_ in enumerate(self.order):
            passing, failing = self.levels[level][node]
            yield filter_, self.totals[level + 1][failing], self.totals[level + 1][passing]
            node = passing

    def only(self, filter_: int) -> Weight:
        """The weight that fails this filter and no other."""
        node = 0
        for level, tested in enumerate(self.order):
            node = self.levels[level][node][tested == filter_]
        return self.totals[-1][node]


def plain_changes(n: int) -> Iterator[int]:
    """Swaps of adjacent places that lead through all orders of n things, each once."""
    if n < 2:
        return
    for turn, inner in enumerate([*plain_changes(n - 1), None]):
        leftwards = turn % 2 == 0
        yield from range(n - 2, -1, -1) if leftwards else range(n - 1)
        if inner is not None:
            yield inner + leftwards


def audit_orders(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """A row per part, order and step from ``part``, ``mask`` and the WEIGHTS of the mask."""

    def of_part(rows: pd.DataFrame) -> pd.DataFrame:
        weights = {int(m): tuple(map(int, w)) for m, w in zip(rows["mask"], rows[WEIGHTS].to_numpy())}
        diagram = Diagram(weights, len(filters))
        paths = [(list(diagram.order), list(diagram.all_pass()))]
        for at in plain_changes(len(filters)):
            diagram.swap(at)
            paths.append((list(diagram.order), list(diagram.all_pass())))
        fails, shapley = [0] * len(filters), [0] * len(filters)
        for _, path in paths:
            first, failing, _ = path[0]
            fails[first] = failing[0]
            for f, failing, _ in path:
                shapley[f] += failing[0]
        only = [diagram.only(f)[0] for f in range(len(filters))]
        found = [
            ("".join(filters[f] for f in order), step, passing[0], failing[0], fails[f] - failing[0], only[f])
            + (failing[1], failing[2], shapley[f])
            for order, path in paths
            for step, (f, failing, passing) in enumerate(path, 1)
        ]
        out = pd.DataFrame(found, columns=["filter_order", "step", *MEASURES])
        out.insert(0, "part", rows["part"].iloc[0])
        return out

    return counts.groupBy("part").applyInPandas(of_part, ROWS)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """All orders of the five filters over all documents of each part."""
    return audit_orders(mask_counts(failure_masks(docs), labels))
