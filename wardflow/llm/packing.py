"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

Documents become token ids inside the tasks and are cut into pieces: whole windows first,
the rest into pieces of at most ``piece`` tokens. Pieces are dealt by a hash into groups
of about ``windows`` windows. Inside a group, differencing starts with one partial
partition per piece and always merges the two with the largest imbalance, the largest
windows of one with the smallest of the other. If the fullest window then exceeds the
capacity, the number of windows rises by one and the group is partitioned anew.

Defined cases: NULL or empty text is one id, the end. Rows with one doc_id are packed as
documents of their own. Extra columns do not take part.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardflow.llm.common import rows_of, text_of
from wardflow.sources.shared import materialised

#: A blank that follows white space may belong to what is before it.
ODD_BLANK = re.compile(r"\s ")
ODD_ASCII = tuple(c + " " for c in " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f")
#: Words that a Python worker remembers; those that come later are encoded batch by batch.
KEPT_WORDS = 500_000
#: Marks that may end a word; the vocabulary's word pattern parts them from a letter before.
MARKS = ".,!?;:%*&#$|()[]{}<>/-+=_~@^\""
KEPT_MARKS = 10_000
#: New words that are encoded as one text.
TOGETHER = 500
BLANK = "\u0120"  # fixed value: how the vocabulary writes a blank


class Tokens:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    The vocabulary's word pattern never joins a blank with a character before it unless
    that is white space too, nor a letter with a mark after it. So a text is cut before such
    blanks, and a new word before the marks at its end. Each part is encoded once, many of
    them as one text, which is cut again where a token begins with a blank. Texts with
    other blanks, or with an added token such as <|endoftext|>, are encoded as a whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        vocabulary = self.model.get_vocab()
        self.begins = np.zeros(max(vocabulary.values()) + 1, bool)
        self.begins[[i for token, i in vocabulary.items() if token.startswith(BLANK)]] = True
        self.added = tuple(t.content for t in self.model.get_added_tokens_decoder().values())
        self.kept: dict[str, bytes] = {}  # ids of a blank and the word
        self.marks: dict[str, bytes] = {}  # ids of marks alone

    def _encode(self, texts: list[str]) -> Iterator[np.ndarray]:
        for at in range(0, len(texts), 100):
            for one in self.model.encode_batch_fast(texts[at : at + 100], add_special_tokens=False):
                yield np.array(one.ids, "<u4")

    def _new(self, words: set[str]) -> dict[str, bytes]:
        # at its end, a blank or other white space would join the blank of the next word
        alone = [w for w in words if not w or w[-1].isspace()]
        found = {w: ids.tobytes() for w, ids in zip(alone, self._encode([" " + w for w in alone]))}
        bodies = {}
        for word in words:
            body = word.rstrip(MARKS)
            if len(body) < len(word) and body and body[-1].isalpha():
                bodies[word] = body
        plain = list(words.difference(found, bodies).union(set(bodies.values()).difference(self.kept)))
        groups = [plain[at : at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        for group, ids in zip(groups, self._encode([" " + " ".join(g) for g in groups])):
            raw, starts = ids.tobytes(), (4 * np.flatnonzero(self.begins[ids])).tolist()
            found.update(zip(group, [raw[a:b] for a, b in zip(starts, [*starts[1:], len(raw)])]))
        ends = {word: word[len(body) :] for word, body in bodies.items()}
        if len(self.marks) > KEPT_MARKS:
            self.marks.clear()
        fresh = list(set(ends.values()).difference(self.marks))
        self.marks.update(zip(fresh, [ids.tobytes() for ids in self._encode(fresh)]))
        for word, body in bodies.items():
            found[word] = (found.get(body) or self.kept[body]) + self.marks[ends[word]]
        return found

    def of(self, texts: list[str]) -> list[bytes]:
        heads, tails = [], []
        for text in texts:
            odd = any(x in text for x in ODD_ASCII) if text.isascii() else ODD_BLANK.search(text)
            odd = odd or any(x in text for x in self.added)
            head, *tail = [text] if odd else text.split(" ")
            heads.append(head)
            tails.append(tail)
        known = self.kept
        new = self._new(set().union(*tails).difference(known))
        known.update(new)
        starts = self._encode(heads)
        ids = [s.tobytes() + b"".join(map(known.__getitem__, tail)) for s, tail in zip(starts, tails)]
        if len(known) > KEPT_WORDS:
            for word in new:
                del known[word]
        return ids


@lru_cache(maxsize=2)
def tokens_of(path: str) -> Tokens:
    """One memory of words for all tasks that a Python worker runs."""
    return Tokens(path)


def cut(n: int, capacity: int, piece: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens."""
    whole = n - n % capacity
    pieces = [(at, capacity) for at in range(0, whole, capacity)]
    return pieces + [(at, min(piece, n - at)) for at in range(whole, n, piece)]


def token_pieces(
    docs: DataFrame, tokenizer: str, end_id: int = 0, capacity: int = 1024, piece: int = 256, with_ids: bool = True
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens and, if asked for, the ids of each piece."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, end = tokens_of(tokenizer), np.array([end_id], "<u4").tobytes()
        for batch in rows_of(batches, 300):
            rows, starts, lengths, crcs, totals, ids = [], [], [], [], [], []
            for row, raw in enumerate(tokens.of(batch.column(1).to_pylist())):
                raw += end
                n = len(raw) // 4
                for start, length in cut(n, capacity, piece):
                    part = raw[4 * start : 4 * (start + length)]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(length)
                    crcs.append(zlib.crc32(part))
                    totals.append(n)
                    if with_ids:
                        ids.append(np.frombuffer(part, "<u4").astype(np.int64))
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                flat = np.concatenate(ids) if ids else np.empty(0, np.int64)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.astype(np.int32))))
            yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema.fields])

    fields = [T.StructField("doc_id", docs.schema["doc_id"].dataType)]
    fields += [T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32", "doc_tokens")]
    if with_ids:
        fields.append(T.StructField("ids", T.ArrayType(T.IntegerType())))
    schema = T.StructType(fields)
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(pieces, schema)


def differencing(sizes: np.ndarray, k: int) -> np.ndarray:
    """The window, 0 to k - 1, of each item: Karmarkar-Karp differencing in k ways.

    A partial partition is its windows' sums in falling order with the tree of items in
    each; windows without items are left out and count as 0. Items that have not been
    merged are partitions of their own. While the largest partition has empty windows it
    stays the largest, so the items that it would take one after the other are taken at
    once.
    """
    n, trees = len(sizes), []  # trees beyond the items: what was merged
    order = np.argsort(-sizes, kind="stable")
    falling = sizes[order].astype(np.int64)
    heap: list[tuple[int, int, np.ndarray, np.ndarray]] = []
    taken = serial = 0

    def push(sums: np.ndarray, tags: np.ndarray) -> None:
        nonlocal serial
        serial += 1
        spread = int(sums[0]) - (int(sums[-1]) if len(sums) == k else 0)
        heapq.heappush(heap, (-spread, serial, sums, tags))

    def items(most: int) -> tuple[np.ndarray, np.ndarray]:
        """The next items that are no smaller than the other partitions' imbalance."""
        nonlocal taken
        bound = -heap[0][0] if heap else 0
        end = taken + min(most, int(np.searchsorted(-falling[taken:], -bound, side="right")))
        at, taken = taken, end
        return falling[at:end], order[at:end]

    while len(heap) + n - taken > 1:
        if taken < n and (not heap or falling[taken] > -heap[0][0]):
            push(*items(k))
            continue
        _, _, a, at = heapq.heappop(heap)
        if len(a) < k and taken < n and (not heap or falling[taken] >= -heap[0][0]):
            more, tags = items(k - len(a))
            push(np.concatenate([a, more]), np.concatenate([at, tags]))
            continue
        if taken < n and (not heap or falling[taken] >= -heap[0][0]):
            b, bt = items(1)
        else:
            _, _, b, bt = heapq.heappop(heap)
        if len(a) < len(b):
            a, at, b, bt = b, bt, a, at
        over = max(0, len(a) + len(b) - k)
        keep = len(a) - over
        both = np.arange(n + len(trees), n + len(trees) + over)
        trees.extend(zip(at[keep:].tolist(), bt[:over][::-1].tolist()))
        sums = np.concatenate([a[:keep], a[keep:] + b[:over][::-1], b[over:]])
        tags = np.concatenate([at[:keep], both, bt[over:]])
        rank = np.argsort(-sums, kind="stable")
        push(sums[rank], tags[rank])
    window = np.zeros(n, np.int64)
    for number, root in enumerate(heap[0][3].tolist() if heap else []):
        stack = [root]
        while stack:
            node = stack.pop()
            if node < n:
                window[node] = number
            else:
                stack.extend(trees[node - n])
    return window


def windows_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Near-equal windows; their number rises until none exceeds the capacity."""
    if not len(sizes):
        return np.empty(0, np.int64)
    k = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        window = differencing(sizes, k)
        if np.bincount(window, weights=sizes).max() <= capacity:
            return window
        k += 1


def pack_pieces(pieces: DataFrame, capacity: int = 1024, windows: int = 128) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``.

    A sequence id is the group's number times 2^32 plus the place in the group.
    """
    tokens = pieces.agg(F.sum("length")).collect()[0][0] or 0
    groups = 1 + tokens // (windows * capacity)
    dealt = pieces.withColumn("_group", F.expr(f"pmod(xxhash64(doc_id, start), {groups})"))
    columns = pieces.columns

    def pack(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ids = group["doc_id"].fillna(0).to_numpy(np.int64)
        sizes, start, crc = (group[c].to_numpy(np.int64) for c in ("length", "start", "ids_crc32"))
        order = np.lexsort((crc, start, ids, -sizes))  # the same whatever the order of arrival
        sizes = sizes[order]
        full = int((sizes == capacity).sum())
        window = np.concatenate([np.arange(full), full + windows_of(sizes[full:], capacity)])
        place = np.argsort(window, kind="stable")
        window, sizes = window[place], sizes[place]
        before = np.cumsum(sizes) - sizes
        first = np.r_[True, window[1:] != window[:-1]]
        out = group[columns].iloc[order[place]]
        out["sequence_id"] = (int(key[0]) << 32) + window
        out["offset"] = before - np.maximum.accumulate(np.where(first, before, 0))
        return out

    schema = T.StructType(
        [*pieces.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    )
    return dealt.groupBy("_group").applyInPandas(pack, schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    end_id: int = 0,
    capacity: int = 1024,
    piece: int = 256,
    windows: int = 128,
    with_ids: bool = True,
) -> DataFrame:
    """Every piece of every document with its sequence; ``tokenizer`` is a vocabulary file
    of the tokenizers library that each executor has."""
    pieces = materialised(token_pieces(docs, tokenizer, end_id, capacity, piece, with_ids))
    return pack_pieces(pieces, capacity, windows)
