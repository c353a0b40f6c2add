"""Every stage of the pipeline on odd rows: nulls, repeats, empty texts and tables, clashing names."""

import pytest

import corpus_pipeline

FIELDS = "doc_id long, text string, lang string, source string, n_chars long, `a.b` int, _base string, class long, `print` string, w string"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    for name in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet").write.parquet(f"{at}/{name}.parquet")
    return at


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_takes_odd_rows(spark, tables, name, stage):
    text = "one plain sentence of some words that stays as it is " * 3
    rows = [(1, text, "en", "s", 5), (1, text, "en", "s", 5), (None, text, None, None, None), (None, None, None, None, None), (2, None, "en", None, 0), (3, "", "en", "s", 0), (4, " \n\t ", None, "s", 4), (5, "long " * 40_000, "en", "s", 200_000), (6, "Ünï çödé text, " * 3, "fr", "", -1)]
    docs = spark.createDataFrame([(*r, 1, "b", 2, "p", "w") for r in rows], FIELDS)
    got = stage(spark, docs, tables)
    if name != "byte_level_bpe":
        assert got.columns == docs.columns
        kept = sorted((tuple(r) for r in got.collect()), key=repr)
        left = [r for r in rows if name != "ngram_jaccard_join" or r[0] != 1]
        want = sorted(((*r, 1, "b", 2, "p", "w") for r in left), key=repr)
        assert [r for r in kept if r[0] != 1] == [r for r in want if r[0] != 1] and any(r[0] == 1 for r in kept)
    else:
        assert got.count() == len(rows)
    assert stage(spark, docs.limit(0), tables).count() == 0
