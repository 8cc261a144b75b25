"""Every operator on odd rows, on an empty table, and next to clashing column names."""
import public_tokenizers
import pytest

from txwatch.llm import (decontaminate, language_id, license_scans, lm_scoring, packing, quality_rules,
                         secret_scans, simhash_dedup, substring_dedup, token_files)

BYTES, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def runs(docs, spark):
    items = spark.createDataFrame([(1, "some words here"), (2, None), (None, "x")], "item_id int, text string")
    yield "substring", substring_dedup.deduplicated(docs)
    yield "language", language_id.predicted(docs, language_id.fit(docs))
    yield "token files", token_files.written(docs, BYTES)
    yield "decontaminate", decontaminate.judged(docs, items)
    yield "licences", license_scans.scanned(docs, path="source")
    yield "scores", lm_scoring.scored(docs, WORDS, rounds=1)
    yield "simhash", simhash_dedup.grouped(docs)
    yield "secrets", secret_scans.scanned(docs)
    yield "quality", quality_rules.judged(docs)


def test_odd_rows_give_one_row_each(spark, edge_docs):
    n = edge_docs.count()
    for name, df in runs(edge_docs, spark):
        got = df.toPandas()
        assert len(got) == n, name


def test_empty_tables(spark, no_docs):
    for name, df in runs(no_docs, spark):
        assert df.count() == 0, name
    assert packing.packed(no_docs, WORDS).count() == 0


def test_filters_keep_columns(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, "some words here")], "item_id int, text string")
    for docs in (edge_docs, no_docs):
        for out in (quality_rules.filtered(docs), simhash_dedup.deduplicated(docs),
                    decontaminate.decontaminated(docs, items), secret_scans.masked(docs)):
            assert out.columns == docs.columns
            assert out.count() <= docs.count()


def test_packing_of_odd_rows(edge_docs):
    got = packing.packed(edge_docs, WORDS).toPandas()
    assert (got[got.doc_id == 1].length == 1).all()          # null text: the end id alone
    assert len(got) >= edge_docs.count() and got.length.max() <= packing.CAPACITY
    for _, own in got.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum().tolist()[:-1]]


def test_near_duplicate_stage_keeps_one_of_each_group(edge_docs):
    kept = simhash_dedup.deduplicated(edge_docs).toPandas().doc_id.dropna().tolist()
    assert sorted(kept) == [1, 4, 5, 6, 8]                   # 1, 2, 3 have no words; 6 and 7 are copies


def test_unknown_language(edge_docs):
    got = language_id.predicted(edge_docs, language_id.fit(edge_docs)).toPandas().set_index("doc_id").lang_pred
    assert got[1] == got[2] == got[3] == got[4] == "und" and got[8] != "und"


@pytest.mark.parametrize("module", [substring_dedup, token_files])
def test_reserved_rows_keep_order(edge_docs, module):
    out = (module.deduplicated(edge_docs) if module is substring_dedup else module.written(edge_docs, BYTES)).toPandas()
    assert out.doc_id.isna().sum() == 2
