"""Nearest vectors, spelling groups and collocations against brute force, and odd rows."""
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from txwatch.llm import collocations, nearest, spelling

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# ---- nearest ----------------------------------------------------------------------------

def brute_nearest(vectors, k):
    def product(u, v):
        s = 0.0
        for x, y in zip(u, v):
            s += x * y
        return s

    def usable(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    kept = {}
    for i, v in vectors:
        if i is not None and usable(v):
            kept[i] = min(kept.get(i, v), v)
    out = []
    for q in kept:
        if q % 20 == 0:
            near = sorted((-product(kept[q], v), c) for c, v in kept.items() if c != q and len(v) == len(kept[q]))[:k]
            out += [(q, rank, c, -s) for rank, (s, c) in enumerate(near, 1)]
    return sorted(out, key=repr)


def vector_table(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, "x", 1, 2) for i, v in rows],
                                 f"vec_id bigint, embedding array<{kind}>, v string, h int, score int")


@pytest.mark.parametrize("kind", ["float", "double"])
@pytest.mark.parametrize("cells", [{}, {"query_bytes": 300, "candidate_bytes": 2000}])
def test_nearest_vectors(spark, kind, cells, monkeypatch):
    monkeypatch.setattr(nearest, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = [(i, [float(np.float32(x)) for x in rng.normal(size=6) * rng.choice([1e-6, 1, 1000])]) for i in range(300)]
    rows += [(i, [1.0, 2.0, 3.0, 0.0, 0.0, 0.0]) for i in range(400, 500)]                 # copies: ties by id
    rows += [(700 + i, [float(i), 1.0]) for i in range(40)]                                # other length
    rows += [(2000, None), (2020, []), (2040, [0.0] * 6), (2060, [1.0, None]), (2080, [math.nan, 1.0]),
             (2100, [math.inf, 1.0]), (None, [1.0] * 6), (40, rows[40][1]), (60, [0.5] * 6), (800, [1.0] * 5)]
    got = nearest.nearest(vector_table(spark, rows, kind), nearest.F.col("vec_id") % 20 == 0, k=4, **cells)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows_of(got) == brute_nearest(rows, 4)


def test_no_vectors(spark):
    for rows in ([], [(20, [1.0, 2.0])], [(1, [1.0])], [(20, None)]):
        assert nearest.nearest(vector_table(spark, rows), nearest.F.col("vec_id") % 20 == 0).count() == 0


def test_int8_tiles_bound_the_product():
    rng = np.random.default_rng(1)
    for dim in (1, 7, 64, 2100):                                 # the last one takes three slabs
        u, v = rng.normal(size=(20, dim)), rng.normal(size=(30, dim)) * rng.lognormal(size=(30, 1)) ** 4
        near, off = nearest.Quantised(u).tile(nearest.Quantised(v), 0, 20)
        assert (np.abs(near - u @ v.T) <= off).all()
        if dim >= 64:                                            # and it is worth having
            assert np.median(off / (np.linalg.norm(u, axis=1)[:, None] * np.linalg.norm(v, axis=1))) < 0.03


# ---- spelling ---------------------------------------------------------------------------

def brute_words(docs):
    n = Counter()
    for key, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOW)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return n


def brute_spelling(docs, min_count=3):
    n = {w: k for w, k in brute_words(docs).items() if len(w) >= 5 and k >= min_count}
    deleted = {}
    for w in n:
        for key in {w[:i] + w[i + 1:] for i in range(len(w))} | {w}:
            deleted.setdefault(key, set()).add(w)

    def one_edit(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:i] + b[i + 1:] == a for i in range(len(b)))

    near = {w: set() for w in n}
    for own in deleted.values():
        for a in own:
            near[a].update(b for b in own if one_edit(a, b))
    form = {}
    for w, own in near.items():
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [2, 7, spelling.GROUP])
def test_spelling_groups(spark, docs, group):
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = spelling.grouped(docs, group=group)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert rows_of(got) == brute_spelling(rows)


def test_spelling_of_crowded_states_and_chains(spark):
    rng = np.random.default_rng(8)
    words = {"aaaaa" + "".join(rng.choice(list("abü"), rng.integers(0, 5))) for _ in range(400)}
    words |= {"".join(rng.choice(list("ab"), rng.integers(5, 9))) for _ in range(300)}
    text = [(i, " ".join([w] * int(2 ** rng.integers(2, 8)))) for i, w in enumerate(sorted(words))]
    text += [(None, "Straße straße STRASSE ×÷×÷× nothing " * 5), (9999, None), (9998, ""), (0, text[0][1])]
    df = spark.createDataFrame([(a, b, "x", 1) for a, b in text], "doc_id bigint, text string, word string, n int")
    for group in (3, spelling.GROUP):
        assert rows_of(spelling.grouped(df, group=group)) == brute_spelling(text)


def test_composition_is_each_pair_once():
    rng = np.random.default_rng(2)
    for size in (1, 2, 3, 4):
        rests = sorted({"".join(rng.choice(list("abc"), size)) for _ in range(30)})
        longer = sorted({"".join(rng.choice(list("abc"), size + 1)) for _ in range(40)})
        found = list(spelling.pairs_behind(rests, longer, 0))
        want = {(a, b) for a in rests for b in rests if a < b and sum(x != y for x, y in zip(a, b)) == 1}
        want |= {(a, b) for a in rests for b in longer if any(b[:i] + b[i + 1:] == a for i in range(len(b)))}
        assert sorted(found) == sorted(want)
        inner = {(a, b) for a, b in want if len(a) == len(b) or not b.startswith(a)}
        assert set(spelling.pairs_behind(rests, longer, 1)) == inner


def test_acceptors_are_minimal():
    own = spelling.Acceptors()
    p = own.build(sorted(["cat", "bat", "rat"]))
    assert len(own.arcs) == 4 and len(own.arcs[p]) == 3          # the rest "at" stands once


# ---- collocations -----------------------------------------------------------------------

def brute_collocations(docs, min_count, absorbed=50, top=2000):
    f, n = Counter(), Counter()
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(LOW)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for size in (1, 2, 3):
                for i in range(len(words) - size + 1):
                    f[lang, tuple(words[i:i + size])] += 1
    found = {}
    for (lang, p), a in f.items():
        if len(p) > 1 and a >= min_count:
            cuts = []
            for k in range(1, len(p)):
                left, right = f[lang, p[:k]], f[lang, p[k:]]
                cuts.append((1_000_000 * a * a // (left * right), k, left, right))
            found[lang, p] = a, min(cuts)
    taken = {(lang, part) for (lang, p), (a, _) in found.items() if len(p) == 3 for part in (p[:2], p[1:])
             if 100 * a >= absorbed * f[lang, part]}
    out = []
    for lang in n:
        own = sorted((-s, -a, " ".join(p).encode(), left, right) for (key, p), (a, (s, _, left, right)) in found.items()
                     if key == lang and (lang, p) not in taken)
        out += [(lang, rank, p.decode(), -a, left, right, n[lang], -s)
                for rank, (s, a, p, left, right) in enumerate(own[:top], 1)]
    return sorted(out, key=repr)


def text_table(spark, rows):
    return spark.createDataFrame([(lang, text, "x", 1, 2) for lang, text in rows],
                                 "lang string, text string, phrase string, n int, rank int")


@pytest.mark.parametrize("sizes", [{}, {"bucket": 500, "share": 20}])
def test_collocations(spark, sizes, monkeypatch):
    monkeypatch.setattr(collocations, "PATH", 3)
    rng = np.random.default_rng(6)
    words = [f"w{i}" for i in range(60)]
    rows = [(str(rng.choice(["en", "de"])), " ".join(rng.choice(words, 40, p=np.arange(60, 0, -1) / 1830))) for _ in range(60)]
    rows += [("en", "one two three four five six seven eight nine ten eleven, over. ") for _ in range(12)]     # a long path
    rows += [("fr", "ab cd " * 30), ("fr", "x y z " * 40 + ";x"), ("fr", "a a a a a a a a a a a a a a a")]     # circles
    rows += [(None, "Nul nul\tNUL, lone. é è \u0085x: 1!2?3\r\n" * 11), ("und", "nul nul lone"), ("en", None), ("en", ""),
             (None, " .,; "), ("es", "of the " + " of the ".join(f"u{i}" for i in range(300)))]              # a hot node
    got = collocations.mined(text_table(spark, rows), **sizes)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert rows_of(got) == brute_collocations(rows, 10)
    few = collocations.mined(text_table(spark, rows), min_count=2, top=5, absorbed=80, **sizes)
    assert rows_of(few) == brute_collocations(rows, 2, 80, 5)


def test_long_texts_are_read_in_segments(spark, monkeypatch):
    monkeypatch.setattr(collocations, "SEGMENT", 7)
    monkeypatch.setattr(collocations, "CHUNK", 20)
    rng = np.random.default_rng(7)
    rows = [("en", " ".join(rng.choice(["a", "b", "c,", "d."], n))) for n in (0, 1, 2, 3, 7, 8, 9, 10, 14, 15, 16, 17, 200, 400)]
    assert rows_of(collocations.mined(text_table(spark, rows), min_count=2)) == brute_collocations(rows, 2)


def test_scores_beyond_64_bits(spark):
    df = spark.createDataFrame([(2_000_000_011, 3_000_000_019, 4_000_000_007)], "a bigint, l bigint, r bigint")
    a, left, right = df.first()
    assert df.select(collocations.score("a", "l", "r")).first()[0] == 1_000_000 * a * a // (left * right)


def test_empty_tables(spark, no_docs):
    assert spelling.grouped(no_docs).count() == 0
    assert collocations.mined(no_docs).count() == 0


def test_odd_documents(spark, edge_docs):
    rows = [(r["doc_id"], r["lang"], r["text"]) for r in edge_docs.collect()]
    assert rows_of(spelling.grouped(edge_docs)) == brute_spelling([(i, t) for i, _, t in rows])
    assert rows_of(collocations.mined(edge_docs)) == brute_collocations([(lang, t) for _, lang, t in rows], 10)
