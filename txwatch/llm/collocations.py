"""Phrase collocations from a weighted de Bruijn graph of words, one graph per language.

Edges are the longest grams (three words), weighted by their occurrences; an edge leads from
the node of its first two words to the node of its last two.  Only edges are counted in the
corpus, and with them where pieces end: the last two words of a piece, or its only word.
Shorter counts follow from flow: what leaves a node, plus the pieces that end there, are the
node's occurrences; what leaves all nodes that begin with a word, plus the pieces that end
with it, are the word's.

Edges travel in packed blocks.  A task numbers the words of what it reads, counts edges as
64-bit integers, and hands each bucket of nodes its edges with a word list; a bucket's task
adds the blocks up, so flows are complete there, and passes on frequent nodes and edges, and
its part of the words' flows.  A node of two very frequent words is dealt to buckets by the
edge's last word as well, and its part flows are added later, so no node is one task's load.

Unary paths of the frequent graph (nodes with one edge in and one out) are compacted into
rows; along a path an edge's two nodes and a node's two edges stand side by side, so cuts and
containment are read off the row, and only the paths' two ends are joined.

Defined results: null text is empty, null lang is ``und``; repeated rows count again; ties
are broken by a, then by the phrase's bytes.  Texts are read whole, whatever their length.
An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, UPPER, staged

# Fixed values of the contract.
MIN_COUNT, ABSORBED, TOP = 10, 50, 2000
#: Words of a task's block, and about as many of a bucket; a text is read in segments.
CHUNK, BUCKET, SEGMENT = 1 << 22, 1 << 22, 1 << 19
#: A word with more than 1/SHARE of all words counts as very frequent: at most SHARE of them.
SHARE = 2048
#: Edges of a compacted path in one row.
PATH = 512
#: Separators become a byte that UTF-8 never has, a tab a space.  Another such byte stands
#: where a segment ends and its text goes on.
_BREAK, _OPEN = b"\xff", b"\xfe"
_TABLE = bytes.maketrans((UPPER + ".,;:!?\n\x0b\x0c\r\t").encode(), LOWER.encode() + _BREAK * 10 + b" ")
_EDGES = ("bucket bigint, lang string, words binary, a binary, b binary, c binary, n binary")


def tokens(text: str) -> list[bytes]:
    """Words of a text in turn, and between its pieces the break byte."""
    return text.encode("utf-8", "replace").translate(_TABLE).replace(_BREAK, b" \xff ").split()


class Numbers(dict):
    """Words by number as they are met; 0 stands for a break, 1 for an open end."""

    def __init__(self) -> None:
        super().__init__({_BREAK: 0, _OPEN: 1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


def _joined(words: list[bytes]) -> bytes:
    return zlib.compress(b" ".join(words), 1)


def _split(packed: bytes) -> list[bytes]:
    return zlib.decompress(packed).split(b" ")


def edges_of(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a sequence of word numbers (0 between pieces, and at both ends) as packed
    numbers (a, b, c) of 21 bits, and their counts.  c = 0: a piece that ends with a, b;
    b = c = 0: a piece of the word a alone.  What leads to an open end (1) is counted where
    the text goes on."""
    ids = ids.astype(np.uint64)
    a, b = ids[:-1], ids[1:]
    c = np.append(ids[2:], np.uint64(0))
    alone = (b == 0) & (np.append(np.uint64(0), ids[:-2]) == 0)
    keep = (a > 1) & (((b > 1) & (c != 1)) | alone)
    c = np.where(b > 0, c, 0)[keep]
    return np.unique((a[keep] << np.uint64(42)) | (b[keep] << np.uint64(21)) | c, return_counts=True)


def _word_hash(words: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(w) for w in words], np.uint64)


def _bucket_of(own: np.ndarray, a: np.ndarray, b: np.ndarray, c: np.ndarray, salted: np.ndarray, lang: str,
               buckets: int) -> np.ndarray:
    mixed = own[a] * np.uint64(0x9E3779B97F4A7C15) + own[b] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(
        zlib.crc32(lang.encode()))
    mixed = np.where(salted, mixed + (own[c] + np.uint64(1)) * np.uint64(0x165667B19E3779F9), mixed)
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text").where(F.col("text").isNotNull())


def frequent_words(docs: DataFrame, share: int = SHARE) -> tuple[int, list[tuple[str, bytes]]]:
    """All words' number, and the (lang, word) with more than 1/share of them.  A task passes
    on the words with half that share of its own, so only such are added up; they serve to
    spread work alone, no count comes from them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        seen = gone = 0

        def shrunk() -> int:
            return sum(held.pop(w) for w in [w for w, n in held.items() if 2 * share * n < seen])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                for w, n in Counter(tokens(text)).items():
                    if w != _BREAK:
                        held[lang, w] += n
                        seen += n
                if len(held) > 1 << 20:       # keep what can still matter
                    gone += shrunk()
        gone += shrunk()
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([None, *(lang for lang, _ in held)], pa.string()),
            "word": pa.array([b"", *(w for _, w in held)], pa.binary()),
            "n": pa.array([gone, *held.values()], pa.int64())})

    found = staged(_texts(docs).mapInArrow(run, "lang string, word binary, n bigint")
                   .groupBy("lang", "word").agg(F.sum("n").alias("n")), "frequent-words")
    total = found.agg(F.sum("n")).first()[0] or 0
    rows = found.where(F.col("lang").isNotNull() & (F.col("n") * share > total)).select("lang", "word").collect()
    return total, [(r["lang"], bytes(r["word"])) for r in rows]       # at most ``share`` rows


def _blocks(docs: DataFrame, buckets: int, frequent: list[tuple[str, bytes]]) -> DataFrame:
    """Edges of ``docs`` counted by task and dealt to buckets of nodes."""
    hot = {}
    for lang, word in frequent:
        hot.setdefault(lang, set()).add(word)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, held, n_held = Numbers(), {}, 0
        end, onward = np.zeros(1, np.uint32), np.ones(1, np.uint32)

        def handed() -> Iterator[pa.RecordBatch]:
            words = list(numbers)
            own = _word_hash(words)
            for lang, parts in held.items():
                keys, n = edges_of(np.concatenate([np.zeros(1, np.uint32), *parts]))
                if not len(keys):
                    continue
                mask = np.uint64((1 << 21) - 1)
                a, b, c = (x.astype(np.int64) for x in (keys >> np.uint64(42), (keys >> np.uint64(21)) & mask, keys & mask))
                is_hot = np.zeros(len(words), bool)
                is_hot[[numbers[w] for w in hot.get(lang, ()) if w in numbers]] = True
                bucket = _bucket_of(own, a, b, c, is_hot[a] & is_hot[b], lang, buckets)
                order = np.argsort(bucket, kind="stable")
                bounds = np.flatnonzero(np.diff(bucket[order])) + 1
                for at in np.split(order, bounds):
                    met, back = np.unique(np.concatenate([a[at], b[at], c[at], [0]]), return_inverse=True)
                    x, y, z = np.split(back[:-1].astype("<u4"), 3)
                    row = {"bucket": [int(bucket[at[0]])], "lang": [lang], "words": [_joined([words[i] for i in met[1:]])],
                           **{k: [zlib.compress(v.tobytes(), 1)]
                              for k, v in (("a", np.diff(x, prepend=np.uint32(0))), ("b", y), ("c", z), ("n", n[at].astype("<i8")))}}
                    yield pa.RecordBatch.from_pydict(row, schema=pa.schema(
                        [("bucket", pa.int64()), ("lang", pa.string())] + [(k, pa.binary()) for k in ("words", "a", "b", "c", "n")]))
            numbers.clear()
            numbers.update({_BREAK: 0, _OPEN: 1})
            held.clear()

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                words = tokens(text)
                for at in range(0, max(1, len(words) - 2), SEGMENT):      # each goes two words into the next
                    own = words[at:at + SEGMENT + 2]
                    if n_held + len(own) > CHUNK or len(numbers) + len(own) >= 1 << 21:
                        yield from handed()
                        n_held = 0
                    ids = np.array(list(map(numbers.__getitem__, own)), np.uint32)
                    last = at + SEGMENT + 2 >= len(words)
                    edge = (onward[:0] if last else onward, end)
                    held.setdefault(lang, []).extend((onward if at else onward[:0], ids, *edge))
                    n_held += len(ids) + 3
        yield from handed()

    return _texts(docs).mapInArrow(run, _EDGES)


def _flows(blocks: DataFrame, min_count: int, frequent: list[tuple[str, bytes]]) -> DataFrame:
    """Each bucket's blocks added up: rows (lang, phrase, size, n) of frequent edges (size 3),
    of frequent nodes and part flows of salted ones (2), and part flows of words (1)."""
    hot = {}
    for lang, word in frequent:
        hot.setdefault(lang, set()).add(word)

    def added(lang: str, rows: list[dict]) -> Iterator[pa.RecordBatch]:
        numbers, parts = Numbers(), []
        for row in rows:
            own = np.array([0, *map(numbers.__getitem__, _split(row["words"]))], np.int64)
            x, y, z = (np.frombuffer(zlib.decompress(row[k]), "<u4") for k in "abc")
            parts.append((own[np.cumsum(x, dtype=np.uint32)], own[y], own[z], np.frombuffer(zlib.decompress(row["n"]), "<i8")))
        a, b, c, n = map(np.concatenate, zip(*parts))
        nodes, at = np.unique((a << 32) | b, return_inverse=True)
        edges, where = np.unique((at.astype(np.int64) << 32) | c, return_inverse=True)
        n = _summed(where, n, len(edges))
        at, c = edges >> 32, edges & 0xFFFFFFFF
        flow = _summed(at, n, len(nodes))
        a, b = nodes >> 32, nodes & 0xFFFFFFFF
        # words: what leaves the nodes they begin, and the pieces they end
        ends = (c == 0) & (b[at] > 0)
        of_word = _summed(a, flow, len(numbers)) + _summed(b[at[ends]], n[ends], len(numbers))
        words = pa.array(["", "", *(w.decode() for w in list(numbers)[2:])])
        is_hot = np.zeros(len(numbers), bool)
        is_hot[[numbers[w] for w in hot.get(lang, ()) if w in numbers]] = True
        heavy = (c > 0) & (n >= min_count)
        pairs = (b > 0) & ((flow >= min_count) | (is_hot[a] & is_hot[b]))
        met = np.flatnonzero(of_word)
        take = lambda i: words.take(pa.array(i))
        for size, cols, counts in ((1, (met,), of_word[met]), (2, (a[pairs], b[pairs]), flow[pairs]),
                                   (3, (a[at[heavy]], b[at[heavy]], c[heavy]), n[heavy])):
            if len(counts):
                yield from pa.Table.from_pydict({
                    "lang": pa.array([lang] * len(counts), pa.string()),
                    "phrase": pc.binary_join_element_wise(*map(take, cols), " ") if size > 1 else take(met),
                    "size": pa.array(np.full(len(counts), size, np.int32)),
                    "n": pa.array(counts)}).to_batches(max_chunksize=20_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, rows = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["bucket"], row["lang"]) != at:
                    if rows:
                        yield from added(at[1], rows)
                    at, rows = (row["bucket"], row["lang"]), []
                rows.append(row)
        if rows:
            yield from added(at[1], rows)

    return (blocks.repartition("bucket").sortWithinPartitions("bucket", "lang")
            .mapInArrow(run, "lang string, phrase string, size int, n bigint"))


def _summed(at: np.ndarray, n: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, np.int64)
    np.add.at(out, at, n)
    return out


# ---- the frequent graph -----------------------------------------------------------------

def _first(phrase: str) -> Column:
    return F.substring_index(phrase, " ", 1)


def _last(phrase: str) -> Column:
    return F.substring_index(phrase, " ", -1)


def _left(phrase: str) -> Column:
    return F.substring_index(phrase, " ", 2)


def _right(phrase: str) -> Column:
    return F.substring_index(phrase, " ", -2)


def _heads(links: DataFrame) -> DataFrame:
    """(lang, phrase, before) -> (lang, phrase, head, steps): pointers to the edge before are
    doubled until they reach a path's head.  What goes round in a circle for ever is cut at
    the circle's least edge."""
    key = ["lang", "phrase"]

    def doubled(links: DataFrame) -> DataFrame:
        at = staged(links.select(*key, F.coalesce("before", "phrase").alias("head"),
                                 F.col("before").isNotNull().cast("bigint").alias("steps"),
                                 F.col("before").isNull().alias("done"),
                                 F.least("phrase", F.coalesce("before", "phrase")).alias("least")), "heads")
        while True:
            onward = at.select("lang", F.col("phrase").alias("head"), F.col("head").alias("h"),
                               F.col("steps").alias("s"), F.col("done").alias("d"), F.col("least").alias("l"))
            at = staged(at.join(onward, ["lang", "head"]).select(
                *key, F.when(F.col("done"), F.col("head")).otherwise(F.col("h")).alias("head"),
                (F.col("steps") + F.when(F.col("done"), 0).otherwise(F.col("s"))).alias("steps"),
                (F.col("done") | F.col("d")).alias("done"), F.least("least", "l").alias("least"),
                ((~F.col("done") & F.col("d")) | (F.col("l") < F.col("least"))).alias("moved")), "heads")
            if at.where("moved").isEmpty():
                return at.drop("moved")
            at = at.drop("moved")

    at = doubled(links)
    if at.where("not done").isEmpty():
        return at.select(*key, "head", "steps")
    circles = at.where("not done").select(*key, "least").join(links, key)
    cut = doubled(circles.select(*key, F.when(F.col("phrase") != F.col("least"), F.col("before")).alias("before")))
    return at.where("done").unionByName(cut).select(*key, "head", "steps")


def paths(nodes: DataFrame, edges: DataFrame, path: int = PATH) -> DataFrame:
    """The graph with its unary paths compacted: lang, words, edge_n (of the edges along the
    path), node_n (of their nodes, one more).  A path of over ``path`` edges takes several
    rows that share a node."""
    ins = edges.select("lang", _right("phrase").alias("node"), _first("phrase").alias("before"), F.lit(None).cast("string").alias("after"))
    outs = edges.select("lang", _left("phrase").alias("node"), F.lit(None).cast("string").alias("before"), _last("phrase").alias("after"))
    unary = (ins.unionByName(outs).groupBy("lang", "node")
             .agg(F.count("before").alias("i"), F.count("after").alias("o"), F.max("before").alias("before"), F.max("after").alias("after"))
             .where("i = 1 and o = 1").select("lang", F.concat_ws(" ", "node", "after").alias("phrase"),
                                              F.concat_ws(" ", "before", "node").alias("before")))
    links = edges.join(unary.where("before != phrase"), ["lang", "phrase"], "left")
    heads = _heads(links.select("lang", "phrase", "before"))
    flow = nodes.select("lang", F.col("phrase").alias("node"), F.col("n").alias("flow"))
    along = (links.select("lang", "phrase", "n", _left("phrase").alias("node")).join(flow, ["lang", "node"])
             .join(heads, ["lang", "phrase"]))
    rows = (along.groupBy("lang", "head", F.floor(F.col("steps") / path).alias("part"))
            .agg(F.sort_array(F.collect_list(F.struct("steps", "phrase", "n", "flow"))).alias("e")))
    rows = rows.withColumn("tail", F.element_at("e", -1)["phrase"]).withColumn("node", _right("tail"))
    words = F.concat(F.transform("e", lambda x: F.substring_index(x["phrase"], " ", 1)), F.split("node", " "))
    return (rows.join(flow.withColumnRenamed("flow", "end_flow"), ["lang", "node"])
            .select("lang", words.alias("words"), F.col("e")["n"].alias("edge_n"),
                    F.concat(F.col("e")["flow"], F.array("end_flow")).alias("node_n")))


def _candidates(compact: DataFrame, nodes: DataFrame, absorbed: int) -> DataFrame:
    """lang, phrase, a, and the counts of the two-word parts of three-word phrases: l2, r2.
    Two-word phrases go that a longer one takes up."""
    i = F.col("i")
    edge = (compact.select("*", F.posexplode("edge_n").alias("i", "a"))
            .select("lang", F.array_join(F.slice("words", i + 1, F.lit(3)), " ").alias("phrase"), "a",
                    F.get("node_n", i).alias("l2"), F.get("node_n", i + 1).alias("r2")))
    # the heaviest edge beside each node, along the path; only the two ends meet other paths
    beside = F.greatest(F.get("edge_n", i - 1), F.get("edge_n", i))
    along = (compact.select("*", F.posexplode("node_n").alias("i", "a"))
             .select("lang", F.array_join(F.slice("words", i + 1, F.lit(2)), " ").alias("phrase"), "a", beside.alias("most"),
                     ((i == 0) | (i == F.size("edge_n"))).alias("is_end")))
    ends = along.where("is_end").groupBy("lang", "phrase").agg(F.max("a").alias("a"), F.max("most").alias("most"))
    lone = nodes.join(along.select("lang", "phrase"), ["lang", "phrase"], "left_anti") \
        .select("lang", "phrase", F.col("n").alias("a"), F.lit(0).cast("bigint").alias("most"))
    pair = (along.where("not is_end").drop("is_end").unionByName(ends).unionByName(lone)
            .where(100 * F.col("most") < absorbed * F.col("a")).drop("most"))
    none = F.lit(None).cast("bigint")
    return edge.unionByName(pair.select("*", none.alias("l2"), none.alias("r2")))


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 a a / (l r)), exactly: products have up to 38 digits."""
    wide = lambda c: f"cast({c} as decimal(19, 0))"
    return F.expr(f"cast((1000000 * {wide(a)} * {wide(a)}) div ({wide(left)} * {wide(right)}) as bigint)")


def mined(docs: DataFrame, min_count: int = MIN_COUNT, absorbed: int = ABSORBED, top: int = TOP,
          bucket: int = BUCKET, share: int = SHARE) -> DataFrame:
    """Best phrases of each language of ``docs`` (lang, text): lang, rank, phrase, a, l, r, n,
    score."""
    total, frequent = frequent_words(docs, share)
    blocks = _blocks(docs, max(1, -(-total // bucket)), frequent)
    counts = staged(_flows(blocks, min_count, frequent), "flows")
    words = staged(counts.where("size = 1").groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    nodes = staged(counts.where("size = 2").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))
                   .where(F.col("n") >= min_count), "nodes")
    edges = counts.where("size = 3").select("lang", "phrase", "n")
    compact = staged(paths(nodes, edges), "paths")
    first = words.select("lang", F.col("phrase").alias("w1"), F.col("n").alias("l1"))
    last = words.select("lang", F.col("phrase").alias("w2"), F.col("n").alias("r1"))
    scored = (_candidates(compact, nodes, absorbed).withColumns({"w1": _first("phrase"), "w2": _last("phrase")})
              .join(first, ["lang", "w1"]).join(last, ["lang", "w2"])
              .withColumn("s1", score("a", "l1", "coalesce(r2, r1)")).withColumn("s2", score("a", "l2", "r1"))
              .withColumn("second", F.coalesce(F.col("s2") < F.col("s1"), F.lit(False))))
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = (scored.select("lang", "phrase", "a", F.when(F.col("second"), F.col("l2")).otherwise(F.col("l1")).alias("l"),
                            F.when(F.col("second"), F.col("r1")).otherwise(F.coalesce("r2", "r1")).alias("r"),
                            F.least("s1", "s2").alias("score"))
              .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
