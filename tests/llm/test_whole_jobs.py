"""The operators do the whole job: nothing is cut to save time."""
import math
import zlib
from collections import Counter

import numpy as np
import public_tokenizers

from txwatch.llm import catalog, language_id, license_scans, lm_scoring, secret_scans, substring_dedup, token_files

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def test_lm_model_is_not_reduced():
    assert (lm_scoring.WINDOW, lm_scoring.CLASSES, lm_scoring.ROUNDS) == (32, 64, 3)


def test_lm_attention_scores_are_not_clipped():
    a = lm_scoring._masked_softmax(np.array([[[60.0, 0.0], [31.0, 40.0]]]), 0)
    assert np.allclose(a, [[[1, 0], [1 / (1 + np.e ** 9), 1 / (1 + np.e ** -9)]]])


def test_lm_trains_on_every_id(spark):
    text = " ".join(f"word{i} text" for i in range(3000))
    docs = spark.createDataFrame([(1, text), (2, "short one"), (None, None)], "doc_id bigint, text string")
    subwords = lm_scoring.Subwords(WORDS)
    kind = lm_scoring.stored_kind(subwords.size)
    got = [np.frombuffer(bytes(r["ids"]), kind) for r in lm_scoring.segments(docs, WORDS).collect()]
    assert len(got) > 4                                      # the long text is several segments
    half, width, want = lm_scoring.WINDOW // 2, lm_scoring.WINDOW + 1, []
    for t in (text, "short one", None):
        seq = subwords.sequence(lm_scoring.words(t))
        want += [seq[at:at + width].tolist() for at in range(0, max(1, len(seq) - 1 - half), half)]
    cut = [[int(i) for i in w if i >= 0] for w in lm_scoring._windows(got)]
    assert sorted(cut) == sorted(want)


def test_lm_learns_from_rows_without_id(spark):
    docs = spark.createDataFrame([(None, "one two three")], "doc_id bigint, text string")
    row = lm_scoring.scored(docs, WORDS, rounds=1).first()
    assert (row.held_out, row.train_tokens, row.n_known) == (False, 4, 4)


def test_lm_query_base_score(spark, tmp_path):
    texts = {0: "One two two \x0bthree", 1: None, 6: "two four  UNSEEN", 3: "", 4: "\u00c9t\u00e9 one", 9: "seven two"}
    docs = [*texts.items(), (0, texts[0])]                   # one row comes twice
    spark.createDataFrame(docs, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    tokens = {k: [w.lower() if w.isascii() else w for w in (t or "").split()] + [""] for k, t in texts.items()}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    assert 0 < sum(held.values()) < len(held)
    count = Counter(w for k, _ in docs if not held[k] for w in tokens[k])
    n, v = sum(count.values()), len(count)
    got = catalog.op6_lm_scoring(spark, str(tmp_path)).collect()
    assert sorted(r.doc_id for r in got) == sorted(k for k, _ in docs)
    for r in got:
        own = tokens[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (
            held[r.doc_id], len(own), sum(count[w] > 0 for w in own), n)
        want = sum(math.log10((count[w] + 1) / (n + 1 * (v + 1))) for w in own)
        assert math.isclose(r.base_score, want, rel_tol=1e-9)


def test_lm_beats_unigram_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = lm_scoring.scored(docs, WORDS).where("held_out").select("doc_id", "score").collect()
    train = docs.where("crc32(cast(cast(doc_id as string) as binary)) % 7 != 2").toPandas()
    subwords = lm_scoring.Subwords(WORDS)
    counts = np.ones(subwords.size)
    for t in train.text:
        counts += np.bincount(subwords.sequence(lm_scoring.words(t))[1:], minlength=subwords.size)
    logs = np.log10(counts / counts.sum())
    texts = {r.doc_id: r.text for r in docs.collect()}
    plain = sum(logs[subwords.sequence(lm_scoring.words(texts[r.doc_id]))[1:]].sum() for r in rows)
    assert rows and sum(r.score for r in rows) > 0.97 * plain     # log10 values are negative


def test_lm_rare_id_keeps_its_update():
    p = lm_scoring.initial(6, np.array([0, 0, 1, 1, 1, 1]), np.ones(6))
    windows = np.full((2, lm_scoring.WINDOW + 1), 1, np.int32)
    rare = windows.copy()
    rare[0, 3] = 4
    moved = {k: v + 1 for k, v in p.items()}
    total = lm_scoring._summand(moved, rare) + 999 * lm_scoring._summand(p, windows)
    new = lm_scoring._averaged(p, total)
    assert np.allclose(new["emb"][4], p["emb"][4] + 1) and np.allclose(new["emb"][5], p["emb"][5])
    assert np.allclose(new["emb"][1], p["emb"][1] + 1e-3, atol=1e-4) and np.allclose(new["wq"], p["wq"] + 1e-3, atol=1e-6)


def test_every_language_is_learned(spark):
    rng, rows = np.random.default_rng(4), []
    for lang in range(70):
        letters = [chr(0x4E00 + 40 * lang + i) for i in range(20)]
        for i in range(7 if lang < 60 else 3):
            text = " ".join("".join(rng.choice(letters, 4)) for _ in range(40))
            rows.append((1 if lang == 66 else 100 * lang + i, text, f"l{lang:02}"))
    rows += [(8000 + i, "12 34", "l69") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(2)
    model = language_id.fit(docs)
    assert model.langs == [f"l{i:02}" for i in range(70)]
    got = language_id.predicted(docs.where("text != '12 34'"), model).collect()
    assert sum(r["lang_pred"] == r["lang"] for r in got) >= 0.98 * len(got)


def test_notices_are_found_anywhere():
    prose = "lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod "
    scan = license_scans.Templates({}, 1000).scan
    gpl = ("# This program is free software: you can redistribute it and/or modify\n# it under the terms of the GNU General "
           "Public License as published by\n# the Free Software Foundation, either version {} of the License, or\n"
           "# (at your option) any later version.\n")
    for text, want, line in (
            (prose + "Released under the MIT License. " + prose + "\n" + prose, "MIT", 0),
            (prose * 40 + "This work is licensed under the GNU General Public License, version 3.", "GPL-3.0", 0),
            (prose + "\n" + gpl.format(3) + prose, "GPL-3.0", 1), (gpl.format(2), "GPL-2.0", 0),
            (gpl.format(3).replace("General", "Affero General"), "AGPL-3.0", 0),
            ("Copyright (c) 2020 Example Corp. All rights reserved.", "proprietary", 0),
            ("Copyright 2020 X. All rights reserved.\n" + license_scans._BSD + license_scans._AS_IS_BSD, "BSD-2-Clause", 1),
            ("x = 1\n// SPDX-License-Identifier: Zlib OR MIT\n", "Zlib OR MIT", 1),
            ("Released under the Foo License.", None, -1), (prose, None, -1), ("", None, -1)):
        got = scan(text)
        assert (got[0], got[2]) == (want, line), (text, got)
    body = next(t for name, t in license_scans.TEMPLATES if name == "MIT" and len(t) > 500)
    assert scan("Copyright 2020 X.\n\n" + body.replace("persons", "people"))[3] > 0.9


def test_token_offsets_come_from_the_directory(spark, docs, tmp_path):
    rng = np.random.default_rng(5)
    for n, universe in ((0, 10), (1, 1), (5, 7), (token_files.SAMPLE, 90_000), (3 * token_files.SAMPLE + 7, 900_000)):
        values = np.sort(rng.integers(0, universe + 1, n))
        kept = token_files.EliasFano(token_files.EliasFano.encode(values, universe))
        for lo, hi in {(0, n), (n // 3, n // 2), (n // 2, n), (n, n)}:
            assert kept.selected(lo, hi).tolist() == values[lo:hi].tolist()
    token_files.write(docs, str(tmp_path / "files"), BYTES, block_ids=5000)
    blocks = spark.read.parquet(str(tmp_path / "files")).collect()

    row = blocks[0].asDict()
    shifted = bytearray(row["bounds"])
    shifted[-4:] = (int.from_bytes(shifted[-4:], "little") + 1).to_bytes(4, "little")   # the last directory entry
    schema = spark.read.parquet(str(tmp_path / "files")).schema
    spark.createDataFrame([row], schema).write.parquet(str(tmp_path / "good"))
    spark.createDataFrame([row | {"bounds": bytes(shifted)}], schema).write.parquet(str(tmp_path / "bad"))
    assert token_files.read(spark, str(tmp_path / "good")).count() == len(row["doc_ids"])
    try:
        bad = token_files.read(spark, str(tmp_path / "bad")).collect()
    except Exception:
        return      # what lies behind the entry does not fit any more
    assert bad != token_files.read(spark, str(tmp_path / "good")).collect()


def test_many_secrets_in_one_text(spark):
    docs = spark.createDataFrame([(n, " ".join(f"é{i % 7} {i:016x}" for i in range(n))) for n in (63, 64, 65, 32_000)],
                                 "doc_id bigint, text string")
    for row in secret_scans.scanned(docs).collect():
        own = row.spans.split(",")
        assert row.n_hex == len(own) == row.doc_id
        assert own == [f"hex:{20 * i + 3}:{20 * i + 19}" for i in range(row.doc_id)]
    for row in secret_scans.masked(docs).collect():
        assert row.text == " ".join(f"é{i % 7} [secret]" for i in range(row.doc_id))


def test_copies_of_one_row_give_their_runs_once(spark):
    text = " ".join(f"word{i * i % 1009} and{i}" for i in range(200))
    docs = spark.createDataFrame([(1, text)] * 2000 + [(2, "short")], "doc_id bigint, text string")
    assert all(len(r.runs) <= len(text) for r in substring_dedup.repeated(docs).collect())
    got = substring_dedup.deduplicated(docs).collect()
    assert len(got) == 2001
    for r in got:
        assert (r.n_removed, r.n_spans) == ((len(text), 1) if r.doc_id == 1 else (0, 0))
