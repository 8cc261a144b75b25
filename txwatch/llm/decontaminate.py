"""Benchmark decontamination with a generalised suffix automaton of the test items.

The normalised items are put into one automaton over word numbers (state 0 is the root;
every item starts there, so no match runs across items).  Each training text is streamed
through it once; the length of the longest match that ends at each word is tracked.
Where it reaches the window length, the last ``window`` words are hit; an item shorter
than the window is hit where the match covers the whole item.

The items are bounded per pass, not in total: a block of at most ``BLOCK_WORDS`` item
words makes one automaton, sent to the tasks; with more blocks the texts are streamed
once for each, and a document's hits are merged.  One block (the usual case) needs no
shuffle at all.

Null and blank texts have no words, no hits and are clean; items without words never
occur; items with equal texts are each counted; a null item_id reads as ``null``.
Repeated rows are judged each; empty tables on either side work; other columns pass.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import LOWER, UPPER, received, sent, staged

# Fixed values of the contract.
WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
WINDOW = 13
COVERAGE = 20            # contaminated: hit words are at least 1/20 of all words

BLOCK_WORDS = 1_000_000  # item words of one automaton (a broadcast of some 100 MB at most)

_FOLD = str.maketrans(UPPER, LOWER)


def words(text: str | None) -> list[str]:
    return WORD.findall(text.translate(_FOLD)) if text else []


class Automaton:
    """Generalised suffix automaton over the word numbers of (item_id, words) pairs."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int = WINDOW) -> None:
        self.window = window
        self.vocabulary: dict[str, int] = {}
        self.item_ids = [item for item, _ in items]
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        texts = [[self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws] for _, ws in items]
        for text in texts:
            last = 0
            for c in text:
                last = self._extend(last, c)
        # items of each state that a hit can end in: those whose text holds the window (or
        # the whole short item) that ends there
        self.items: dict[int, set[int]] = {}
        self.short: dict[int, tuple[int, set[int]]] = {}
        for n, text in enumerate(texts):
            state = size = 0
            for c in text:
                state, size = self.step(state, size, c)
                if size >= window:
                    self.items.setdefault(self.cut(state, window), set()).add(n)
            if 0 < len(text) < window:
                at = self.cut(state, len(text))
                self.short.setdefault(at, (len(text), set()))[1].add(n)
        self.short_sizes = sorted({size for size, _ in self.short.values()})
        self.pairs = np.unique(np.array([a * len(self.vocabulary) + b for t in texts for a, b in zip(t, t[1:])],
                                        dtype=np.int64))

    def _extend(self, last: int, c: int) -> int:
        if c in self.next[last]:
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._clone(last, c, q)
        state = self._state(self.length[last] + 1)
        p = last
        while p != -1 and c not in self.next[p]:
            self.next[p][c] = state
            p = self.link[p]
        if p != -1:
            q = self.next[p][c]
            self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return state

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        return len(self.length) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.length[p] + 1)
        self.next[twin] = dict(self.next[q])
        self.link[twin], self.link[q] = self.link[q], twin
        while p != -1 and self.next[p].get(c) == q:
            self.next[p][c] = twin
            p = self.link[p]
        return twin

    def step(self, state: int, size: int, c: int) -> tuple[int, int]:
        """State and length of the longest match after one more word."""
        while state and c not in self.next[state]:
            state = self.link[state]
            size = self.length[state]
        if c in self.next[state]:
            return self.next[state][c], size + 1
        return 0, 0

    def cut(self, state: int, size: int) -> int:
        """The state that holds the last ``size`` words of a match in ``state``."""
        while self.length[self.link[state]] >= size:
            state = self.link[state]
        return state

    def scan(self, tokens: list[str]) -> tuple[np.ndarray, set[int]]:
        """Mask of hit words and the items whose windows occur."""
        ids = np.fromiter((self.vocabulary.get(w, -1) for w in tokens), np.int64, len(tokens))
        hit = np.zeros(len(tokens) + 1, np.int32)  # +1 at a start, -1 past an end
        found: set[int] = set()
        if len(ids) and self.vocabulary:
            # stretches whose neighbouring pairs all occur in items; no match leaves them
            pair = np.zeros(len(ids), bool)
            known = ids >= 0
            pair[1:] = known[1:] & known[:-1]
            code = ids[:-1] * len(self.vocabulary) + ids[1:]
            at = np.searchsorted(self.pairs, code)
            pair[1:] &= (at < len(self.pairs)) & (self.pairs[np.minimum(at, len(self.pairs) - 1)] == code) \
                if len(self.pairs) else False
            starts = np.flatnonzero(known & ~pair)
            follow = np.concatenate((np.flatnonzero(~pair), [len(ids)]))
            ends = follow[np.searchsorted(follow, starts, "right")]
            least = min([self.window, *self.short_sizes])
            long = ends - starts >= least
            for lo, hi in zip(starts[long].tolist(), ends[long].tolist()):
                state = size = 0
                for i, c in enumerate(ids[lo:hi].tolist(), lo):
                    state, size = self.step(state, size, c)
                    if size >= self.window:
                        hit[i + 1 - self.window] += 1
                        hit[i + 1] -= 1
                        found |= self.items[self.cut(state, self.window)]
                    for n in self.short_sizes:
                        if size >= n:
                            least_state = self.cut(state, n)
                            if self.short.get(least_state, (0, ()))[0] == n:
                                hit[i + 1 - n] += 1
                                hit[i + 1] -= 1
                                found |= self.short[least_state][1]
        return np.cumsum(hit[:-1]) > 0, found


def _blocks(benchmark: DataFrame, block_words: int) -> Iterator[list[tuple[str, list[str]]]]:
    """Items in blocks, streamed through the driver one partition at a time."""
    block: list[tuple[str, list[str]]] = []
    held = 0
    for row in benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("i"), "text") \
            .toLocalIterator():
        own = words(row["text"])
        if own:
            block.append((row["i"], own))
            held += len(own)
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


def _spans(mask: np.ndarray) -> list[list[int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
    return edges.reshape(-1, 2).tolist()


def _summary(n_words: int, n_hit: int, items: list[str]) -> tuple:
    listed = ",".join(sorted(items))
    return (n_words, n_hit, len(items), hashlib.sha256(listed.encode()).hexdigest(),
            n_hit > 0 and COVERAGE * n_hit >= n_words)


_SUMMARY = ("n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean")


_NAMES = [c.split()[0] for c in _SUMMARY.split(", ")]


def _without(text: str, spans: list[list[int]]) -> str:
    """``text`` without the words of the spans; text around and between spans stays."""
    at = [m.span() for m in WORD.finditer(text.translate(_FOLD))]  # folding keeps places
    out, pos = [], 0
    for a, b in spans:
        out.append(text[pos:at[a][0]])
        pos = at[b - 1][1]
    return "".join([*out, text[pos:]])


def judged(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
           block_words: int = BLOCK_WORDS) -> DataFrame:
    """Every row of ``docs`` with n_words, n_hit, n_items, items_sha256, contaminated, and
    ``clean_text``: the text without its hit words (the text itself where none is hit)."""
    own = docs.select([c for c in docs.columns if c not in _NAMES
                       and c != "clean_text"])
    schema = own.schema
    automata = [Automaton(block, window) for block in _blocks(benchmark, block_words)] or [Automaton([], window)]
    spark = docs.sparkSession
    if len(automata) == 1:
        only = sent(spark, automata[0])

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            automaton = received(only)
            for b in batches:
                rows, clean = [], []
                for text in b["text"]:
                    text = text if isinstance(text, str) else None
                    tokens = words(text)
                    mask, found = automaton.scan(tokens)
                    rows.append(_summary(len(tokens), int(mask.sum()), [automaton.item_ids[i] for i in found]))
                    clean.append(_without(text, _spans(mask)) if mask.any() else text)
                more = pd.DataFrame(rows, columns=_NAMES, index=b.index)
                yield pd.concat([b, more, pd.Series(clean, index=b.index, name="clean_text", dtype=object)], axis=1)

        out = T.StructType([*schema, *T.StructType.fromDDL(_SUMMARY + ", clean_text string")])
        return own.mapInPandas(run, out)

    # several automata: hits of each block as spans, merged per row
    keyed = staged(own.withColumn("d_row", F.struct(
        F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("i"))), "rows")
    parts = None
    for automaton in automata:
        of_block = sent(spark, automaton)

        def hits(batches: Iterator[pd.DataFrame], of_block=of_block) -> Iterator[pd.DataFrame]:
            automaton = received(of_block)
            for b in batches:
                rows = []
                for key, text in zip(b["k"], b["text"]):
                    mask, found = automaton.scan(words(text if isinstance(text, str) else None))
                    if found:
                        rows.append((key, _spans(mask), [automaton.item_ids[i] for i in found]))
                yield pd.DataFrame(rows, columns=["k", "spans", "items"])

        part = keyed.select(F.col("d_row.i").alias("k"), "text").mapInPandas(
            hits, "k bigint, spans array<array<int>>, items array<string>")
        parts = part if parts is None else parts.unionByName(part)
    merged = parts.groupBy("k").agg(F.flatten(F.collect_list("spans")).alias("d_spans"),
                                    F.flatten(F.collect_list("items")).alias("d_items"))
    joined = keyed.join(merged, keyed["d_row.i"] == merged["k"], "left").drop("k", "d_row")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, clean = [], []
            for text, spans, items in zip(b["text"], b["d_spans"], b["d_items"]):
                text = text if isinstance(text, str) else None
                mask = np.zeros(len(words(text)), bool)
                for span in spans if spans is not None else ():
                    mask[span[0]:span[1]] = True
                rows.append(_summary(len(mask), int(mask.sum()), list(items) if items is not None else []))
                clean.append(_without(text, _spans(mask)) if mask.any() else text)
            more = pd.DataFrame(rows, columns=_NAMES, index=b.index)
            yield pd.concat([b.drop(columns=["d_spans", "d_items"]), more,
                             pd.Series(clean, index=b.index, name="clean_text", dtype=object)], axis=1)

    return joined.mapInPandas(finish, T.StructType([*schema, *T.StructType.fromDDL(_SUMMARY + ", clean_text string")]))


def decontaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without contaminated documents (coverage limit); of the others the hit
    spans are cut (length limit) and ``n_chars``, if there, is counted anew."""
    others = [c for c in docs.columns if c != "text"]
    plain = docs.select("text", *[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(others)])
    df = judged(plain, benchmark, window).where(~F.col("contaminated"))
    columns = []
    for c in docs.columns:
        if c == "text":
            columns.append(F.col("clean_text").alias(c))
        elif c == "n_chars":
            own = F.col(f"d_{others.index(c)}")
            columns.append(F.when(F.col("n_hit") > 0, F.length("clean_text").cast(docs.schema[c].dataType))
                           .otherwise(own).alias(c))
        else:
            columns.append(F.col(f"d_{others.index(c)}").alias(c))
    return df.select(columns)
