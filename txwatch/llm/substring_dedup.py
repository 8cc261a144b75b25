"""Suffix-array dedup: removes bytes covered by long strings that also occur elsewhere.

A byte goes if some ``LENGTH``-byte string that covers it starts at two or more places of
the corpus (the same document included; matches never cross documents; overlaps count).

Sorting the suffixes of every byte of a corpus would move each of them.  Repeats are
therefore found where they can be, and only undecided places are suffix sorted:

1. Anchors.  Among the ``GRAM``-byte grams of each ``LENGTH``-byte string, the one with the
   least hash (the first of equals) is its anchor.  The choice depends on the string alone,
   so equal strings have the same anchor at the same place: an anchor stands for the run
   of starts that chose it, and its context is the bytes those strings cover.
2. An anchor gram that occurs once proves that none of its strings repeats.  If all
   contexts of a gram are equal (gram hash, an independent hash of the bytes and both
   lengths agree), all of its strings repeat.
3. The rest, mostly the edges of repeats, are decided by sorting: one copy of each
   different context is fetched, and the suffixes at its starts are merge sorted.  The
   comparison finds the common extension of two suffixes by binary search on prefix
   polynomial hashes; neighbours that share ``LENGTH`` bytes repeat.  Equal hashes are
   verified byte by byte.
4. A gram with over ``HOT`` different contexts never meets in one task: its strings are
   counted by (gram, place, two independent hashes) with partial aggregation.

Documents are known by a hash of id and text plus their length; rows that repeat are
places of their own.  Null text is an empty text.  Empty tables give no rows; further
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged

LENGTH = 200
GRAM = 32
HOT = 4000               # different contexts of one gram that a task takes
POOL = 12_000            # contexts that a task sorts at a time

_BASE, _BASE2 = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F   # odd, so invertible modulo 2**64


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, base, np.uint64))))


class Powers:
    """Powers of a base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int = _BASE) -> None:
        self.base, self.up, self.down = base, _powers(base, 1), _powers(base, 1)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            n = max(n, 2 * len(self.up))
            self.up = _powers(self.base, n)
            self.down = _powers(pow(self.base, -1, 1 << 64), n)
        return self.up, self.down

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        """``out[i]``: polynomial hash of the first i bytes."""
        up, _ = self.upto(len(data))
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=out[1:])
        return out


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def anchors(data: bytes, powers: Powers, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Gram hash, place, first and last start of each anchor of a text."""
    n = len(data)
    if n < length:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64),) * 3
    prefix = powers.prefixes(np.frombuffer(data, np.uint8))
    _, down = powers.upto(n)
    h = _mixed((prefix[gram:] - prefix[:-gram]) * down[:n - gram + 1])
    bits = np.uint64(max(1, n.bit_length()))
    least = (h >> bits << bits) | np.arange(len(h), dtype=np.uint64)  # the place breaks ties
    window, span = length - gram + 1, 1
    while span * 2 <= window:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    least = np.minimum(least[:len(least) - (window - span)], least[window - span:])
    at = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    last = np.concatenate((first[1:] - 1, [len(at) - 1]))
    return h[at[first]], at[first], first, last


def _raw(text: object) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select("doc_id", text.alias("text"), F.xxhash64("doc_id", text).alias("key"))


def _anchor_rows(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Rows (key, g, ctx, place): ``place`` packs start, anchor distance and last start."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import xxhash

        powers, digest = Powers(), xxhash.xxh3_64_intdigest
        for b in batches:
            parts = []
            for key, text in zip(b["key"].tolist(), b["text"]):
                data = _raw(text)
                g, at, first, last = anchors(data, powers, length, gram)
                if len(g):
                    ctx = np.array([digest(data[a:z], s) for a, z, s in zip(
                        first.tolist(), (last + length).tolist(), (at - first).tolist())], np.uint64)
                    place = (first << 16) | ((at - first) << 8) | (last - first)
                    parts.append((np.full(len(g), key), g.view(np.int64), ctx.view(np.int64), place))
            if parts:
                yield pd.DataFrame(dict(zip(("key", "g", "ctx", "place"), map(np.concatenate, zip(*parts)))))

    return _keyed(docs).select("key", "text").mapInPandas(run, "key bigint, g bigint, ctx bigint, place bigint")


# ---- hash-compared suffix sort ----------------------------------------------------------

class Pool:
    """Bytes whose suffixes are compared by prefix hashes."""

    def __init__(self, data: bytes, powers: Powers, length: int) -> None:
        self.data = np.frombuffer(data + b"\0" * length, np.uint8)
        self.prefix = powers.prefixes(self.data)
        self.up, self.down = powers.upto(len(self.data))
        self.length = length

    def hashes(self, at: np.ndarray, size: int) -> np.ndarray:
        return (self.prefix[at + size] - self.prefix[at]) * self.down[at]

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of suffixes (at most ``length``), by binary search."""
        a, b, same = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        step = 1 << (self.length.bit_length() - 1)
        while step:
            fits = same + step <= self.length
            # a step past the limit is not taken; clip so that it reads inside the pool
            equal = fits & (self.hashes(np.where(fits, a, 0), step) == self.hashes(np.where(fits, b, 0), step))
            a[equal] += step
            b[equal] += step
            same[equal] += step
            step >>= 1
        return same

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        """Whether suffix a comes before suffix b."""
        same = self.extension(a, b)
        equal = same >= self.length
        return np.where(equal, or_equal, self.data[a + np.minimum(same, self.length - 1)]
                        < self.data[b + np.minimum(same, self.length - 1)])

    def merge_sorted(self, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Suffixes sorted within each of the consecutive classes of the given sizes."""
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        total = np.repeat(sizes, sizes)
        out, run = starts.copy(), 1
        while run < (sizes.max() if len(sizes) else 0):
            local = np.arange(len(out)) - begin
            block = local // (2 * run) * (2 * run)
            right = local - block >= run
            # each element's rank in the other run of its block, by binary search
            lo = np.where(right, block, np.minimum(block + run, total))
            hi = np.where(right, np.minimum(block + run, total), np.minimum(block + 2 * run, total))
            base = lo.copy()
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) // 2
                other = out[begin[open_] + mid]
                r = right[open_]
                less = np.empty(len(open_), bool)   # a left one stays before its equals on the right
                less[r] = self.before(other[r], out[open_][r], or_equal=True)
                less[~r] = self.before(other[~r], out[open_][~r], or_equal=False)
                lo[open_[less]] = mid[less] + 1
                hi[open_[~less]] = mid[~less]
            place = begin + block + (local - block - np.where(right, run, 0)) + (lo - base)
            merged = np.empty_like(out)
            merged[place] = out
            out, run = merged, run * 2
        return out


def repeated_starts(group: np.ndarray, contexts: list[bytes], lead: np.ndarray, count: np.ndarray,
                    powers: Powers, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(context number, start in it) of all strings that occur in more than one context of
    the same group.  ``lead``: bytes from a context's first start to its anchor; ``count``:
    starts of a context."""
    sizes = np.array([len(c) for c in contexts])
    base = np.cumsum(sizes) - sizes
    pool = Pool(b"".join(contexts), powers, length)
    owner = np.repeat(np.arange(len(contexts)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    start = base[owner] + inner
    # only strings with the same anchor gram at the same distance can be equal
    cls = group[owner].astype(np.int64) * 256 + (lead[owner] - inner)
    h = pool.hashes(start, length)
    order = np.lexsort((h, cls))
    edge = np.concatenate(([True], (cls[order][1:] != cls[order][:-1]) | (h[order][1:] != h[order][:-1])))
    number = np.cumsum(edge) - 1
    sizes = np.bincount(number)
    order, number = order[sizes[number] > 1], number[sizes[number] > 1]   # a hash that is alone proves no repeat
    if not len(order):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    head = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    # two suffixes stand for each set of equal hashes in the sort
    two = np.sort(np.concatenate((head, head + 1)))
    own = cls[order[two]]
    size = np.diff(np.concatenate((np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1]))), [len(own)])))
    ranked = pool.merge_sorted(start[order[two]], size)
    ends = np.zeros(len(ranked), bool)
    ends[np.cumsum(size) - 1] = True
    twins = ~ends[:-1] & (pool.extension(ranked[:-1], ranked[1:]) >= length)
    proven = np.zeros(len(pool.data), bool)
    proven[ranked[:-1][twins]] = proven[ranked[1:][twins]] = True
    # every member is verified against the first of its set, byte by byte
    first = start[order[head]][np.cumsum(np.concatenate(([True], number[1:] != number[:-1]))) - 1]
    good = np.zeros(len(order), bool)
    for lo in range(0, len(order), 1 << 15):
        a, b = start[order[lo:lo + (1 << 15)]], first[lo:lo + (1 << 15)]
        span = np.arange(length)
        good[lo:lo + (1 << 15)] = (pool.data[a[:, None] + span] == pool.data[b[:, None] + span]).all(1)
    if not good.all():   # a collision: its sets are compared as bytes
        bad = np.isin(number, number[~good])
        seen: dict[tuple[int, bytes], list[int]] = {}
        for i in np.flatnonzero(bad).tolist():
            s = start[order[i]]
            seen.setdefault((int(cls[order[i]]), pool.data[s:s + length].tobytes()), []).append(i)
        good[bad] = False
        for same in seen.values():
            good[same] = len(same) > 1
    else:
        good &= proven[first]
    chosen = order[good]
    return owner[chosen], inner[chosen]


def _runs(numbers: np.ndarray) -> list[list[int]]:
    """Sorted distinct numbers as [first, last] runs."""
    cut = np.flatnonzero(np.diff(numbers) != 1)
    return np.column_stack((numbers[np.concatenate(([0], cut + 1))], numbers[np.concatenate((cut, [len(numbers) - 1]))])).tolist()


def _sorted_contexts(contexts: DataFrame, length: int) -> DataFrame:
    """Rows (g, ctx, runs) from contexts (g, ctx, lead, data), grams whole in a task."""

    def solve(df: pd.DataFrame, powers: Powers) -> pd.DataFrame:
        data = [bytes(d) for d in df["data"]]
        count = np.array([len(d) for d in data]) - length + 1
        group = np.cumsum(np.concatenate(([True], df["g"].to_numpy()[1:] != df["g"].to_numpy()[:-1])))
        who, start = repeated_starts(group, data, df["lead"].to_numpy(), count, powers, length)
        rows = []
        order = np.lexsort((start, who))
        who, start = who[order], start[order]
        cut = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1]))) if len(who) else []
        for lo, hi in zip(cut, [*cut[1:], len(who)]):
            rows.append((df["g"].iat[who[lo]], df["ctx"].iat[who[lo]], _runs(start[lo:hi])))
        return pd.DataFrame(rows, columns=["g", "ctx", "runs"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        powers, held, n = Powers(), [], 0
        for b in batches:
            while len(b):
                # a pool ends where a gram ends
                room = b.iloc[:max(1, POOL - n)]
                rest = b.iloc[len(room):]
                last = room["g"].iat[-1]
                held.append(room)
                n += len(room)
                if n >= POOL:
                    whole = pd.concat(held)
                    done = whole["g"].to_numpy() != last
                    if done.any():
                        yield solve(whole[done], powers)
                        held = [whole[~done]]
                        n = len(held[0])
                    elif len(rest) and rest["g"].iat[0] == last or not len(rest):
                        take = rest["g"].to_numpy() == last
                        held.append(rest[take])
                        n += int(take.sum())
                        rest = rest[~take]
                b = rest
        if n:
            yield solve(pd.concat(held), powers)

    return (contexts.repartition("g").sortWithinPartitions("g")
            .mapInPandas(run, "g bigint, ctx bigint, runs array<array<bigint>>"))


def _counted_strings(contexts: DataFrame, length: int) -> DataFrame:
    """The same rows for hot grams: strings counted by hashes, no gram meets in one task."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one, two = Powers(_BASE), Powers(_BASE2)
        for b in batches:
            for row in b.itertuples(index=False):
                data = bytes(row.data)
                start = np.arange(len(data) - length + 1)
                yield pd.DataFrame({
                    "g": row.g, "ctx": row.ctx, "start": start, "far": row.lead - start,
                    "h1": Pool(data, one, length).hashes(start, length).view(np.int64),
                    "h2": Pool(data, two, length).hashes(start, length).view(np.int64)})

    rows = staged(contexts.mapInPandas(
        run, "g bigint, ctx bigint, start bigint, far bigint, h1 bigint, h2 bigint"), "strings")
    same = ["g", "far", "h1", "h2"]
    often = rows.groupBy(*same).agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return (rows.join(often, same, "left_semi").groupBy("g", "ctx")
            .agg(F.transform(F.array_sort(F.collect_set("start")), lambda s: F.array(s, s)).alias("runs")))


# ---- the whole job ----------------------------------------------------------------------

def repeated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """Rows (key, runs): starts [first, last] of each document's repeated strings."""
    if not gram <= length <= gram + 255:
        raise ValueError("a context's distances have to fit a byte")
    found = _anchor_rows(docs, length, gram)
    grams = staged(found.groupBy("g").agg(F.count(F.lit(1)).alias("n"), F.min("ctx").alias("lo"), F.max("ctx").alias("hi"))
                   .where("n > 1").select("g", (F.col("lo") != F.col("hi")).alias("mixed")), "grams")
    shared = staged(found.join(grams, "g"), "anchors")
    first = F.call_function("shiftright", F.col("place"), F.lit(16))
    last = first + F.col("place").bitwiseAND(F.lit(255))
    lead = F.call_function("shiftright", F.col("place"), F.lit(8)).bitwiseAND(F.lit(255))
    mixed = shared.where("mixed")
    kinds = staged(mixed.groupBy("g", "ctx").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place")).alias("one")), "contexts")
    sizes = kinds.groupBy("g").agg(F.count(F.lit(1)).alias("kinds"))
    wanted = (kinds.join(sizes, "g").select("g", "ctx", "kinds", "one.*")
              .groupBy("key").agg(F.collect_list(F.struct(
                  "g", "ctx", "kinds", first.alias("first"), lead.alias("lead"), last.alias("last"))).alias("wanted")))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, own in zip(b["text"], b["wanted"]):
                data = _raw(text)
                rows += [(w["g"], w["ctx"], w["kinds"], w["lead"], data[w["first"]:w["last"] + length]) for w in own]
            yield pd.DataFrame(rows, columns=["g", "ctx", "kinds", "lead", "data"])

    # rows that repeat give their contexts once: copies go before the shuffle
    texts = _keyed(docs).groupBy("key").agg(F.first("text").alias("text")).join(wanted, "key")
    contexts = staged(texts.mapInPandas(cut, "g bigint, ctx bigint, kinds bigint, lead bigint, data binary"), "cut")
    cold = _sorted_contexts(contexts.where(F.col("kinds") <= hot).select("g", "ctx", "lead", "data"), length)
    warm = _counted_strings(contexts.where(F.col("kinds") > hot).select("g", "ctx", "lead", "data"), length)
    decided = staged(cold.unionByName(warm), "decided")
    whole = shared.where("not mixed").select("key", F.array(F.array(first, last)).alias("runs"))
    several = mixed.join(kinds.where("n > 1").select("g", "ctx"), ["g", "ctx"], "left_semi").select(
        "key", F.array(F.array(first, last)).alias("runs"))
    edges = mixed.join(decided, ["g", "ctx"]).select(
        "key", F.transform("runs", lambda r: F.array(r[0] + first, r[1] + first)).alias("runs"))
    # a key's runs are a set, also before the shuffle: copies of a row have the same ones
    return (whole.unionByName(several).unionByName(edges)
            .groupBy("key").agg(F.flatten(F.collect_set("runs")).alias("runs")))


def deduplicated(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot: int = HOT,
                 with_bytes: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans
    (removed [start, end) runs), and the remaining bytes if asked for."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for text, runs in zip(b["text"], b["runs"]):
                data, spans = _raw(text), []
                for lo, hi in sorted((int(r[0]), int(r[1]) + length) for r in (runs if runs is not None else ())):
                    if spans and lo <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], hi)
                    else:
                        spans.append([lo, hi])
                edges = [0, *(x for s in spans for x in s), len(data)]
                kept = b"".join(data[edges[i]:edges[i + 1]] for i in range(0, len(edges), 2))
                rows.append((len(data), len(data) - len(kept), len(spans), hashlib.sha256(kept).hexdigest(), spans)
                            + ((kept,) if with_bytes else ()))
            out = pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
                               + ["kept"] * with_bytes)
            out.insert(0, "doc_id", b["doc_id"].to_numpy())
            yield out

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = _keyed(docs).join(repeated(docs, length, gram, hot), "key", "left")
    return rows.select("doc_id", "text", "runs").mapInPandas(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
             f"spans array<array<bigint>>{', kept binary' if with_bytes else ''}")
