"""Spelling variants by finite-state composition: vocabulary o one edit o vocabulary.

The vocabulary's acceptor is composed with a transducer that makes exactly one edit and with
the acceptor again; the pairs that the composition accepts are the near words.  Before its
edit the transducer copies, so a composed state is (q, q): all pairs whose words agree up to
q lie behind one initial state.  That gives the partitions: a word pair that differs by one
edit agrees in the front half of the shorter word or in its back half, so each word is dealt
to the state after its front half, and to the state of the reversed acceptor after its back
half.  A state with more than ``GROUP`` words is cut again: the part that may hold the edit is
halved, each half with the rest as a longer agreed part, until no state is too large (words of
a state differ, so this ends).  No pair is lost, and a pair is accepted behind one state only,
because its first differing place decides.  In a task the words behind a state become a
minimised acceptor, whose composition is enumerated.

Defined results: null text has no runs; a null doc_id writes as the empty text; repeated rows
count again; very long texts are read whole.  An empty table gives no rows.  Extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .tokens import worker_state

# Fixed values of the contract.
RUN = "[A-Za-zÀ-ÿ]+"
CHANGED, MIN_LENGTH, MIN_COUNT, FORM_SHARE = 97, 5, 3, 2
#: Words behind one initial state that a task composes at once; counts a task holds.
GROUP, HELD = 2000, 400_000
_FOLD = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def written_word(run: str, prefix: int, known: dict) -> str:
    """The word that a run of a document counts as; ``prefix`` is the crc32 of what stands
    before the run in the hashed text."""
    if run not in known:
        if len(known) >= HELD:
            known.clear()
        word = run.translate(_FOLD)
        known[run] = word, word.encode()
    word, raw = known[run]
    h = zlib.crc32(raw, prefix)
    if h % CHANGED:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1:]


def counted(docs: DataFrame) -> DataFrame:
    """All words of ``docs`` (doc_id, text) with their occurrences: word, n.  Tasks count
    first, so a word of every document is one row a task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        runs, known = re.compile(RUN).findall, worker_state(("spelling words",), dict)
        held: Counter = Counter()

        def handed() -> pd.DataFrame:
            out = pd.DataFrame({"word": list(held), "n": list(held.values())})
            held.clear()
            return out

        for b in batches:
            for key, text in zip(b["key"], b["text"]):
                if not isinstance(text, str):
                    continue
                prefix = zlib.crc32(f"{key}:".encode())
                for own, n in Counter(runs(text)).items():
                    held[written_word(own, prefix, known)] += n
                if len(held) >= HELD:
                    yield handed()
        if held:
            yield handed()

    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return (docs.select(key.alias("key"), "text").mapInPandas(run, "word string, n bigint")
            .groupBy("word").agg(F.sum("n").alias("n")))


# ---- initial states ---------------------------------------------------------------------

def _state(rows: DataFrame, length: Column, front: Column, back: Column) -> DataFrame:
    """``rows`` (word, n) behind the state of an agreed front and back of so many code points;
    ``length`` is that of the shorter words there."""
    agreed = F.concat_ws("|", length.cast("string"), front.cast("string"),
                         F.substring("word", F.lit(1), front), F.substring("word", F.length("word") - back + 1, back))
    return rows.select("word", "n", length.alias("length"), front.alias("front"), back.alias("back"),
                       agreed.alias("state"))


def _halved(rows: DataFrame) -> DataFrame:
    """Each state in two: the edit in the back half of what is not agreed, or in the front."""
    half = F.floor((F.col("length") - F.col("front") - F.col("back")) / 2).cast("int")
    later = _state(rows, F.col("length"), F.col("front") + half, F.col("back"))
    return later.unionByName(_state(rows, F.col("length"), F.col("front"), F.col("length") - F.col("front") - half))


def states(vocabulary: DataFrame, group: int = GROUP, shortest: int = MIN_LENGTH) -> DataFrame:
    """Words dealt to initial states: word, n, length, front, back, state."""
    length, none = F.length("word"), F.lit(0)
    words = vocabulary.select("word", "n")
    roles = _state(words, length, none, none).unionByName(          # as the longer word of a pair
        _state(words.where(length > shortest), length - 1, none, none))
    dealt, done = staged(_halved(roles), "states"), []
    while True:
        # what is one code point wide has at most as many words as there are letters
        wide = F.col("length") - F.col("front") - F.col("back") > 1
        large = dealt.where(wide).groupBy("state").count().where(F.col("count") > group).select("state")
        large = staged(large, "large-states")           # at most rows / group of them
        if large.isEmpty():
            break
        done.append(dealt.join(large, "state", "left_anti"))
        dealt = staged(_halved(dealt.join(large, "state", "left_semi")), "states")
    for part in done:
        dealt = dealt.unionByName(part.select(*dealt.columns))
    return dealt


# ---- acceptors and their composition ----------------------------------------------------

class Acceptors:
    """Minimised acceptors of sets of words of one length each, in one register: states with
    equal continuations are one state.  State 0 accepts the empty word and has no arcs."""

    def __init__(self) -> None:
        self.arcs: list[tuple[tuple[str, int], ...]] = [()]
        self.register: dict[tuple, int] = {(): 0}
        self.met: dict[tuple[int, int], list[str]] = {}

    def build(self, words: list[str], at: int = 0) -> int:
        """The state that accepts the rests from ``at`` on of sorted words of one length."""
        if at == len(words[0]):
            return 0
        arcs, first = [], 0
        for i in range(1, len(words) + 1):
            if i == len(words) or words[i][at] != words[first][at]:
                arcs.append((words[first][at], self.build(words[first:i], at + 1)))
                first = i
        key = tuple(arcs)
        state = self.register.setdefault(key, len(self.arcs))
        if state == len(self.arcs):
            self.arcs.append(key)
        return state

    def common(self, p: int, q: int) -> list[str]:
        """The words that both states accept."""
        if not p and not q:
            return [""]
        key = (p, q) if p < q else (q, p)
        if key not in self.met:
            other = dict(self.arcs[q])
            self.met[key] = [c + rest for c, to in self.arcs[p] if c in other for rest in self.common(to, other[c])]
        return self.met[key]

    def composed(self, p: int | None, q: int | None, at_end: bool, copied: str = "") -> Iterator[tuple[str, str]]:
        """Pairs that differ by the transducer's one edit: a replaced code point within the
        words of ``p``, or one inserted into a word of ``p`` to give one of ``q``.  An
        insertion stands as far back as it can; at the very end only if ``at_end``."""
        if p is None:
            return
        arcs = self.arcs[p]
        for i, (c, to) in enumerate(arcs):
            for d, other in arcs[i + 1:]:
                for rest in self.common(to, other):
                    yield copied + c + rest, copied + d + rest
        onward = dict(self.arcs[q]) if q else {}
        if arcs or at_end:
            for c, to in onward.items():
                for rest in self.common(p, to):
                    if rest[:1] != c:
                        yield copied + rest, copied + c + rest
        for c, to in arcs:
            if len(self.arcs[to]) > 1 or c in onward or self.branches(to):
                yield from self.composed(to, onward.get(c), at_end, copied + c)

    def branches(self, p: int) -> bool:
        """Whether more than one word lies behind a state."""
        while self.arcs[p]:
            if len(self.arcs[p]) > 1:
                return True
            p = self.arcs[p][0][1]
        return False


def pairs_behind(rests: list[str], longer: list[str], back: int) -> Iterator[tuple[str, str]]:
    """Near pairs among the rests behind one initial state; ``longer`` have one code point more.
    Where a back part is agreed, an insertion at the very end of the rest lies in the next
    state's part."""
    own = Acceptors()
    p = own.build(sorted(rests))
    yield from own.composed(p, own.build(sorted(longer)) if longer else None, not back)


def summed_links(dealt: DataFrame) -> DataFrame:
    """What each task finds for a word: word, n_near, and its near word of largest n."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, list] = {}

        def handed() -> pd.DataFrame:
            out = pd.DataFrame([(w, k, -n, near) for w, (k, n, near) in held.items()],
                               columns=["word", "n_near", "near_n", "near"])
            held.clear()
            return out

        def linked(word: str, near: str, n: int) -> None:
            got = held.setdefault(word, [0, 1, ""])
            got[0] += 1
            if (-n, near) < (got[1], got[2]):
                got[1], got[2] = -n, near

        def behind(rows: list[tuple]) -> None:
            _, length, front, back, _, _ = rows[0]
            rests, longer = {}, {}
            for *_, word, n in rows:
                (longer if len(word) > length else rests)[word[front:len(word) - back]] = word, n
            if not rests or len(rows) < 2:
                return
            for a, b in pairs_behind(list(rests), list(longer), back):
                w, n = rests[a]
                x, m = rests[b] if len(a) == len(b) else longer[b]
                linked(w, x, m)
                linked(x, w, n)

        at, rows = None, []
        for b in batches:
            for row in zip(*(b[c].tolist() for c in ("state", "length", "front", "back", "word", "n"))):
                if row[0] != at:
                    if rows:
                        behind(rows)
                        if len(held) >= HELD:
                            yield handed()
                    at, rows = row[0], []
                rows.append(row)
        if rows:
            behind(rows)
        if held:
            yield handed()

    ordered = dealt.repartition("state").sortWithinPartitions("state") \
        .select("state", "length", "front", "back", "word", "n")
    return ordered.mapInPandas(run, "word string, n_near bigint, near_n bigint, near string")


def _roots(formed: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): pointers are doubled until none moves.  n at least doubles
    from a word to its form, so a chain has at most 63 steps: at most six rounds move."""
    to = staged(formed.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = to.select(F.col("word").alias("root"), F.col("root").alias("next"))
        to = staged(to.join(onward, "root", "left")
                    .select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                    "roots")
        if to.where("moved").isEmpty():
            return to.select("word", "root")
        to = to.select("word", "root")


def grouped(docs: DataFrame, group: int = GROUP, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
            share: int = FORM_SHARE) -> DataFrame:
    """One row per word of ``docs`` (doc_id, text): word, form, root, n, n_near, form_n."""
    long_enough = (F.length("word") >= min_length) & (F.col("n") >= min_count)
    vocabulary = staged(counted(docs).where(long_enough), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), "near"))
    near = (summed_links(states(vocabulary, group, min_length)).groupBy("word")
            .agg(F.sum("n_near").alias("n_near"), best.alias("best")))
    links = staged(vocabulary.join(near, "word", "left")
                   .withColumn("form_n", F.when(-F.col("best.minus") >= F.col("n") * share, -F.col("best.minus")))
                   .select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
                           F.when(F.col("form_n").isNotNull(), F.col("best.near")).alias("form"), "form_n"), "links")
    roots = _roots(links.where(F.col("form").isNotNull()))
    return (links.join(roots, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
