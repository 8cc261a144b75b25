"""Operators against plain Python on the smallest documents table."""
import hashlib
import math
import random
import re
import struct
import tracemalloc
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from txwatch.llm import (decontaminate, language_id, license_scans, lm_scoring, packing, quality_rules,
                         secret_scans, simhash_dedup, substring_dedup, token_files)
from txwatch.llm.tokens import BARE, SPACED, Encoder

SMALL = "/root/testdata/sf0.001"
BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
SPACES = re.compile("[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize("hot,pool", [(substring_dedup.HOT, substring_dedup.POOL), (1, 40)])
def test_substrings(docs, hot, pool, monkeypatch):
    monkeypatch.setattr(substring_dedup, "POOL", pool)
    got = rows(substring_dedup.deduplicated(docs, hot=hot))
    texts = {r["doc_id"]: r["text"].encode() for r in docs.collect()}
    size, count = substring_dedup.LENGTH, Counter()
    for b in texts.values():
        count.update(b[i:i + size] for i in range(len(b) - size + 1))
    for key, b in texts.items():
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - size + 1):
            if count[b[i:i + size]] > 1:
                gone[i] += 1
                gone[i + size] -= 1
        gone = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        r = got[key]
        assert (r.n_bytes, r.n_removed, r.n_spans) == (len(b), gone.sum(), spans)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_suffix_sort():
    rng = random.Random(3)
    data = bytes(rng.choice(b"ab") for _ in range(2000))
    pool = substring_dedup.Pool(data, substring_dedup.Powers(), 20)
    starts = np.array(rng.sample(range(1900), 700))
    sizes, at = np.array([300, 1, 399]), 0
    got = pool.merge_sorted(starts, sizes)
    for n in sizes:
        want = sorted(data[i:i + 20] for i in starts[at:at + n])
        assert [data[i:i + 20] for i in got[at:at + n]] == want
        at += n


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").withColumn(
        "held_out", language_id.held_out(F.col("doc_id")))
    model = language_id.fit(docs.where("not held_out"))
    got = language_id.predicted(docs.where("held_out").select("doc_id", "text", "lang"), model)
    joined = got.toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    lang = joined["lang_y"] if "lang_y" in joined else joined["lang"]
    assert (lang == joined.lang_pred).mean() > 0.97
    assert joined.score.between(0, 1).all()


def test_tokens_equal_whole_texts(docs):
    rng = random.Random(5)
    odd = ["".join(rng.choice("a A\n\t  's'11é́ñΣσ　\x85\x1c​|<>{}endoftext中😀ß\r\x0b") for _ in range(rng.randint(0, 60)))
           for _ in range(800)] + ["<|endoftext|> a<|endoftext|>b", "x <|startoftext|>"]
    texts = odd + [r["text"] for r in docs.collect()]
    for path, chunks in ((BYTES, SPACED), (WORDS, BARE)):
        whole, encoder = Tokenizer.from_file(path), Encoder(path, chunks, cache=500)
        for text in texts:
            assert np.frombuffer(encoder.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("n,universe", [(0, 0), (1, 0), (1, 9), (200, 200), (300, 70_000), (64, 1 << 33)])
def test_elias_fano(n, universe):
    values = np.sort(np.random.default_rng(n).integers(0, universe + 1, n)).astype(np.int64)
    got = token_files.EliasFano(token_files.EliasFano.encode(values, universe))
    assert got.values().tolist() == values.tolist()
    assert [got.select(i) for i in range(n)] == values.tolist()
    with pytest.raises(IndexError):
        got.select(n)


def test_token_files(spark, docs, tmp_path):
    path = str(tmp_path / "files")
    token_files.write(docs, path, BYTES, block_ids=5000)
    assert spark.read.parquet(path).count() > 8
    got, whole, start = rows(token_files.read(spark, path)), Tokenizer.from_file(BYTES), 0
    for r in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = whole.encode(r["text"], add_special_tokens=False).ids + [0]
        g = got[r["doc_id"]]
        assert (g.start, g.n_tokens, g.ids_crc32) == (start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids)))
        start += len(ids)


@pytest.mark.parametrize("block_words", [decontaminate.BLOCK_WORDS, 150])
def test_decontamination(spark, docs, block_words):
    some = [" ".join(docs.first()["text"].split()[:5]), "nothing at all", ""]
    extra = spark.createDataFrame([(900 + i, t) for i, t in enumerate(some)], "item_id bigint, text string")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").unionByName(extra)
    got = rows(decontaminate.judged(docs, items, block_words=block_words))
    windows = {}
    for r in items.collect():
        w = tuple(decontaminate.words(r["text"]))
        n = min(13, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(w[k:k + n], set()).add(str(r["item_id"]))
    for r in docs.collect():
        w = tuple(decontaminate.words(r["text"]))
        hit, found = np.zeros(len(w), bool), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if w[k:k + n] in windows:
                    hit[k:k + n] = True
                    found |= windows[w[k:k + n]]
        g = got[r["doc_id"]]
        assert (g.n_words, g.n_hit, g.n_items) == (len(w), hit.sum(), len(found))
        assert g.items_sha256 == hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        assert g.contaminated == bool(hit.any() and 20 * hit.sum() >= len(w))
        if hit.any():
            assert decontaminate.words(g.clean_text) == [x for x, h in zip(w, hit) if not h] or hit.all()


def test_licences_are_inherited(spark):
    files = spark.createDataFrame([
        ("a/LICENSE", "Released under the MIT License."), ("a/b/c/x.py", "code"), ("a/b/LICENSE", "All rights reserved.\n"),
        ("d/y.py", "code\nLicensed under the Apache License, Version 2.0.\n" + "more code " * 9), ("d/z.py", "code"),
        ("a/e/f/g/h.py", "plain license words"), (None, "nothing"), ("top.py", None)], "path string, text string")
    got = {r["path"]: (r["license"], r["license_from"]) for r in license_scans.scanned(files).collect()}
    assert got["a/b/c/x.py"] == ("proprietary", "a/b/LICENSE")
    assert got["a/e/f/g/h.py"] == ("MIT", "a/LICENSE")
    assert got["d/y.py"] == ("Apache-2.0", "d/y.py")
    assert got["d/z.py"] == got["top.py"] == got[None] == (None, None)


def test_heavy_words_lose_no_line(docs):
    lines = [x for r in docs.collect() for x in r["text"].split("\n")]
    total, df = license_scans.document_frequencies(docs)
    found = license_scans.Templates(df, total)
    for line in lines + [t for _, t in license_scans.TEMPLATES]:
        own = license_scans.words(line)
        if found.best(own)[0] >= found.threshold:
            assert not found.heavy.isdisjoint(own)


def test_lm_gradients():
    rng = np.random.default_rng(0)
    cls = rng.integers(0, 5, 50)
    p = {k: v.astype(np.float64) for k, v in lm_scoring.initial(50, cls, np.ones(50), 8).items()}
    ids, target = rng.integers(0, 50, (3, lm_scoring.WINDOW)), rng.integers(-1, 5, (3, lm_scoring.WINDOW))
    _, g = lm_scoring.gradients(p, ids, target)
    for name in set(p) - {"emb"}:
        at = tuple(rng.integers(0, n) for n in p[name].shape)
        p[name][at] += 1e-5
        up = lm_scoring.gradients(p, ids, target)[0]
        p[name][at] -= 2e-5
        down = lm_scoring.gradients(p, ids, target)[0]
        p[name][at] += 1e-5
        assert math.isclose((up - down) / 2e-5, g[name][at], rel_tol=1e-3, abs_tol=1e-8)


def _lm_batch():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 100, 300)
    cls, _ = lm_scoring.classes_of(counts)
    windows = rng.integers(0, 300, (lm_scoring.BATCH, lm_scoring.WINDOW + 1)).astype(np.int32)
    target = np.where(rng.random((lm_scoring.BATCH, lm_scoring.WINDOW)) < 0.9, cls[windows[:, 1:]], -1)
    return lm_scoring.initial(300, cls, counts), windows[:, :-1], target


@pytest.mark.parametrize("name, value", [("PART", 3), ("SAFE", -1.0)])
def test_lm_gradients_do_not_depend_on_parts_or_shifts(monkeypatch, name, value):
    p, ids, target = _lm_batch()
    p = {k: v.astype(np.float64) for k, v in p.items()}
    loss, g = lm_scoring.gradients(p, ids, target)
    monkeypatch.setattr(lm_scoring, name, value)
    again, found = lm_scoring.gradients(p, ids, target)
    assert math.isclose(loss, again, rel_tol=1e-12) and set(g) == set(found) == set(p)
    assert all(np.allclose(g[k], found[k], rtol=1e-9, atol=1e-14) for k in g)


def test_lm_large_logits():
    p, ids, target = _lm_batch()
    p = {k: v.astype(np.float64) * (40 if k in ("wq", "out") else 1) for k, v in p.items()}
    loss, g = lm_scoring.gradients(p, ids, target)
    logits, _ = lm_scoring.forward(p, ids)
    assert np.abs(logits).max() > lm_scoring.SAFE            # these have to be shifted
    logs = logits - np.logaddexp.reduce(logits, -1, keepdims=True)
    own = np.take_along_axis(logs, np.maximum(target, 0)[..., None], -1)[..., 0]
    assert math.isclose(loss, -own[target >= 0].mean(), rel_tol=1e-9)
    assert all(np.isfinite(d).all() for d in g.values())


def test_lm_attention_with_merged_weights():
    """Weights that meet no bend between them are multiplied once a batch, not at each place."""
    p, ids, target = _lm_batch()
    p = {k: v.astype(np.float64) for k, v in p.items()}
    width = lm_scoring.WIDTH
    x = p["emb"][ids] + p["pos"]
    q, k, v = (x @ p[name] for name in ("wq", "wk", "wv"))
    a = np.where(np.tri(lm_scoring.WINDOW), np.exp(q @ k.transpose(0, 2, 1) / math.sqrt(width)), 0)
    h = x + a / a.sum(-1, keepdims=True) @ v @ p["wo"]
    assert np.allclose(lm_scoring.forward(p, ids)[0], h @ p["out"] + p["bias"], rtol=1e-10)
    _, g = lm_scoring.gradients(p, ids, target)
    rng = np.random.default_rng(9)
    for name in ("wq", "wk", "wv", "wo"):
        along = rng.standard_normal((width, width))
        up, down = (lm_scoring.gradients({**p, name: p[name] + d * along}, ids, target)[0] for d in (1e-5, -1e-5))
        assert math.isclose((up - down) / 2e-5, (g[name] * along).sum(), rel_tol=1e-5, abs_tol=1e-10)
    assert lm_scoring._projection(p).shape == (width, 2 * width)


def test_lm_batches_use_their_arrays_again():
    p, ids, target = _lm_batch()
    room = lm_scoring.Buffers()
    lm_scoring.gradients(p, ids, target, room)
    tracemalloc.start()
    lm_scoring.gradients(p, ids, target, room)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < target.size * lm_scoring.CLASSES * 4 / 2   # less than half of one array of logits


def test_lm_scores_each_id_once():
    rng = np.random.default_rng(1)
    counts = rng.integers(0, 100, 60)
    cls, within = lm_scoring.classes_of(counts, 6)
    assert np.allclose(np.bincount(cls, 10.0 ** within), 1.0)      # p(id | class) adds up
    p = lm_scoring.initial(60, cls, counts)
    half = lm_scoring.WINDOW // 2
    for size in (2, 5, half, half + 1, lm_scoring.WINDOW + 1, 150):
        seq = rng.integers(0, 60, size).astype(np.int32)
        want = 0.0
        for t in range(1, size):
            begin = max(0, ((t - 1) // half - 1) * half)
            logits, _ = lm_scoring.forward(p, seq[None, begin:t])
            own = logits[0, -1].astype(np.float64)
            prob = np.exp(own - own.max())
            want += math.log10(prob[cls[seq[t]]] / prob.sum()) + within[seq[t]]
        got = lm_scoring.sequence_scores(p, cls, within, [seq, seq[:2]])[0]
        assert math.isclose(got, want, rel_tol=1e-4)


@pytest.mark.parametrize("frequent", [lm_scoring.FREQUENT, 50])
def test_lm_base_score(docs, frequent):
    got, count = rows(lm_scoring.scored(docs, WORDS, rounds=1, frequent=frequent)), Counter()
    texts = {r["doc_id"]: SPACES.findall(lower(r["text"])) + ["\0"] for r in docs.collect()}
    for key, own in texts.items():
        if zlib.crc32(str(key).encode()) % 7 != 2:
            count.update(own)
    n, v = sum(count.values()), len(count)
    for key, own in texts.items():
        r = got[key]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(count[w] > 0 for w in own), n)
        assert math.isclose(r.base_score, sum(math.log10((count[w] + 1) / (n * (v + 1))) for w in own), rel_tol=1e-9)
        assert r.held_out == (zlib.crc32(str(key).encode()) % 7 == 2)
    assert sum(r.score for r in got.values()) > sum(r.base_score for r in got.values())


def test_packing(docs):
    got, whole, total = packing.packed(docs, WORDS).toPandas(), Tokenizer.from_file(WORDS), 0
    own = {(r.doc_id, r.piece): r for r in got.itertuples()}
    for r in docs.collect():
        ids = whole.encode(r["text"], add_special_tokens=False).ids + [0]
        total += len(ids)
        for n, at in enumerate(range(0, len(ids), 2048)):
            part, g = ids[at:at + 2048], own.pop((r["doc_id"], n))
            assert (g.start, g.length, g.ids_crc32) == (at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))
    assert not own
    for _, part in got.sort_values("offset").groupby("sequence_id"):
        assert part.offset.tolist() == [0, *part.length.cumsum().tolist()[:-1]] and part.length.sum() <= 2048
    assert got.sequence_id.nunique() <= -(-total // 2048) + 1


def test_crossover_keeps_every_piece():
    rng = random.Random(2)
    histogram = dict(Counter(rng.randint(1, 90) for _ in range(3000)))
    one = packing.best_fit({}, dict(histogram), 100)
    other = packing.mutated(one, histogram, 100, rng)
    for child in (one, other, packing.crossover(one, other, histogram, 100, rng)):
        held = Counter()
        for bin_, many in child.items():
            assert sum(bin_) <= 100
            for size in bin_:
                held[size] += many
        assert held == Counter(histogram)


@pytest.mark.parametrize("tree", [{}, {"leaf": 4, "shard_rows": 3}])
def test_simhash(spark, tree):
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(60)]
    for _ in range(240):
        x = rng.choice(base)
        for _ in range(rng.randint(0, 3)):
            x ^= 1 << rng.randrange(64)
        base.append(x)
    own = sorted(set(base))
    fps = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in own], "fp bigint")
    labels = {r["node"] % (1 << 64): r["label"] % (1 << 64) for r in simhash_dedup.components(simhash_dedup.links(fps, **tree)).collect()}
    parent = {x: x for x in own}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(own):
        for b in own[:i]:
            if (a ^ b).bit_count() <= 4:
                parent[root(a)] = root(b)
    groups = {}
    for x in own:
        groups.setdefault(root(x), set()).add(labels.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_fingerprints(docs):
    for text in ["", None, "One", "one two three four five five five five", "É a b c d e"] + [r["text"] for r in docs.limit(5).collect()]:
        w = SPACES.findall(lower(text or ""))
        grams = [" ".join(w[i:i + 4]) for i in range(max(1, len(w) - 3))] if w else []
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0
        assert simhash_dedup.fingerprint(text) == want


def secret_spans(text):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def test_secrets(spark, docs):
    odd = ["password=secret: abcdefghijklmnop", "PASSWORD: 'abcdefghijkl' token=abcdefghijklmn", "AKIA" + "B" * 14 + " AKIAB",
           "😀😀 api_key = \"0123456789abcdef0123\" é 0123456789abcdef", "a" * 16 + "g" + "b" * 15, "",
           "ghp_" + "a1" * 18 + " -----BEGIN RSA PRIVATE KEY-----", "token=" + "deadbeef" * 2000]
    extra = spark.createDataFrame([(10_000 + i, t) for i, t in enumerate(odd)], "doc_id bigint, text string")
    every = docs.select("doc_id", "text").unionByName(extra)
    got = rows(secret_scans.scanned(every))
    for r in every.collect():
        own = secret_spans(r["text"])
        listed = ",".join(f"{k}:{a}:{z}" for a, _, z, k in own)
        g = got[r["doc_id"]]
        assert g.base_sha256 == hashlib.sha256(listed.encode()).hexdigest(), r["doc_id"]
        assert (g.n_assign, g.n_access, g.n_hex) == tuple(sum(k == x for *_, k in own) for x in ("assign", "access", "hex"))
        assert set(listed.split(",")) <= {*g.spans.split(","), ""}
    assert "git_host" in got[10_006].spans and "private_key" in got[10_006].spans
    masked = rows(secret_scans.masked(every))
    for r in every.collect():
        assert not secret_spans(masked[r["doc_id"]].text)


def test_trigram_queries():
    assert secret_scans.trigram_query("ab[0-9]") == [frozenset()]
    assert secret_scans.trigram_query("(foo|bars?)x+") == [frozenset({"foo", "oox"}), frozenset({"bar", "arx"}),
                                                            frozenset({"bar", "ars", "rsx"})]


def test_quality_counts(spark, docs):
    odd = ["a b c d e a b c d e", "a a a a a a a a a a a a", "x\n\nx\n x\nx", "#*$ %&|<> é#", "\n".join(["same line here"] * 9)]
    extra = spark.createDataFrame([(10_000 + i, t, "en") for i, t in enumerate(odd)], "doc_id bigint, text string, lang string")
    every = docs.select("doc_id", "text", "lang").unionByName(extra)
    got = rows(quality_rules.judged(every))
    for r in every.collect():
        w = SPACES.findall(r["text"])
        grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
        often, inside = Counter(grams), set()
        for i, g in enumerate(grams):
            if often[g] > 1:
                inside.update(range(i, i + 5))
        lines = [x for x in r["text"].split("\n") if SPACES.search(x)]
        g = got[r["doc_id"]]
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words) == (
            len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in r["text"]), len(lines) - len(set(lines)), len(inside))
        assert g.base_failed == (len(w) < 10 or 100 * len(inside) > 20 * len(w))
        assert not (g.kept and g.base_failed)


def test_quality_windows_that_share_cut_hashes(spark):
    # equal in all bits but the top ones: alike after the cut, in an order that alternates
    top = 1 << 62
    cases = [[5, 5 + top, 5, 5 + top], [5, 5 + top, 7, 5 - top], [5, 5 + top, 5 - top, 5], [1, 2, 1], [9], [], None]
    df = spark.createDataFrame(list(enumerate(cases)), "id int, q_gram array<bigint>").withColumn("q_bits", F.lit(4))
    got = {r.id: r.q_at for r in quality_rules.twin_positions(df).collect()}
    for n, case in enumerate(cases):
        want = case and [i for i, h in enumerate(case) if case.count(h) > 1]
        assert got[n] == want, case


def test_quality_common_words_of_any_length(spark):
    docs = spark.createDataFrame([(1, "extraordinary " * 9 + "a b c", "en"), (2, None, "en"), (3, "a", None)],
                                 "doc_id int, text string, lang string")
    got = {r.q_lang: r.q_common for r in quality_rules.common_words(docs, 2).collect()}
    assert got == {"en": ["extraordinary", "a"], quality_rules.NO_LANG: ["a"]}


def test_quality_rejects_strange_text(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    noise = " ".join("zq#x9 |" for _ in range(20)) + " " + " ".join(f"w{i}#k{i * 7}" for i in range(200))
    extra = spark.createDataFrame([(10_000, noise, "en")], "doc_id bigint, text string, lang string")
    got = quality_rules.judged(docs.unionByName(extra)).toPandas().set_index("doc_id")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").toPandas().set_index("doc_id").quality
    assert not got.kept[10_000]
    good = got.loc[labels[labels == 1].index]
    assert (good.kept | good.base_failed).mean() > 0.99


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    judged = rows(quality_rules.judged(docs))
    kept = corpus_pipeline.quality(spark, docs, SMALL)
    assert {r["doc_id"] for r in kept.collect()} == {k for k, r in judged.items() if r.kept}
    groups = rows(simhash_dedup.grouped(kept))
    one = corpus_pipeline.near_duplicates(spark, kept, SMALL)
    assert {r["doc_id"] for r in one.collect()} == {r.component_id for r in groups.values()}
    clean = corpus_pipeline.benchmark(spark, one, SMALL)
    bad = {r["doc_id"] for r in decontaminate.judged(one, spark.read.parquet(f"{SMALL}/benchmark.parquet")).collect() if r.contaminated}
    assert {r["doc_id"] for r in clean.collect()} == {r["doc_id"] for r in one.collect()} - bad
    safe = corpus_pipeline.secrets(spark, clean, SMALL)
    assert safe.columns == docs.columns and safe.count() == clean.count()
    assert not any(secret_spans(r["text"]) for r in safe.collect())
    final = corpus_pipeline.run(spark, SMALL)
    assert {r["doc_id"] for r in final.select("doc_id").distinct().collect()} == {r["doc_id"] for r in safe.collect()}


def test_encoder_keeps_frequent_chunks():
    encoder = Encoder(WORDS, BARE, cache=20)
    encoder.ids("often")
    for i in range(200):
        encoder.ids(f"often once{i}")
        assert len(encoder) + len(encoder.older) <= 20 and ("often" in encoder or "often" in encoder.older)


def test_marked_words_and_line_ends_use_held_words():
    rng = random.Random(11)
    texts = ["".join(rng.choice(["ab", "Cé", "\u0130x", "\u03a3", " ", " ", "\n", "  ", "\t", "\x1c", "\u3000", ",", "##", "%%%%",
                                 "'s", "_", "<|endoftext|>"]) for _ in range(rng.randint(0, 16))) for _ in range(1500)]
    for path, chunks in ((BYTES, SPACED), (WORDS, BARE)):
        whole, encoder = Tokenizer.from_file(path), Encoder(path, chunks)
        for text in texts:
            assert np.frombuffer(encoder.ids(text), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids
        seen, model = [], encoder.tokenize
        encoder.tokenize = lambda piece: seen.append(piece) or model(piece)
        encoder.ids("to wordywordy wordywordy, wordywordy### and wordywordy%%\nwordywordy. wordywordy")
        assert sum("wordy" in piece for piece in seen) == (2 if chunks is SPACED else 1)
