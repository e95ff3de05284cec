import brute
import pytest

import corpus_pipeline as C
from tessera.llm import langid, pii
from tessera.llm.common import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Input and output rows of each stage over the small documents."""
    base = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, SF, "documents"), {}
    for name, f in C.STAGES:
        f(spark, docs, SF).write.parquet(f"{base}/{name}")
        after = spark.read.parquet(f"{base}/{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_stages_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["language_id", "near_dedup", "decontamination", "pii", "packing"]
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.columns == before.columns and after.dtypes == before.dtypes, name


def test_language_id_keeps_all_but_unknown(spark, stages):
    before, after = stages["language_id"]
    kept = {r.doc_id for r in after.collect()}
    model = langid.fit(before.where(langid.fold() != 2))
    rows = before.collect()
    langs, scores = langid.score_texts(model, [r.text.encode() for r in rows])
    assert kept == {r.doc_id for r, k, s in zip(rows, langs, scores) if k != "und" and s >= C.LEAST_SCORE}
    extra = spark.createDataFrame([(-1, None, "en", "s", 0), (-2, "12 34", "en", "s", 5), (-3, "", None, None, None)], before.schema)
    assert {r.doc_id for r in C.language_id(spark, before.unionByName(extra), SF).collect()} == kept


def test_near_dedup_keeps_the_first_of_each_group(stages):
    before, after = stages["near_dedup"]
    groups = brute.simhash_groups([(r.doc_id, r.text) for r in before.collect()])
    assert sorted(r.doc_id for r in after.collect()) == sorted({g for _, g in groups.values()})


def test_decontamination_drops_the_contaminated_only(spark, stages):
    before, after = stages["decontamination"]
    items = [tuple(r) for r in table(spark, SF, "benchmark").collect()]
    rows = {r.doc_id: r.text for r in before.collect()}
    want = {i for i, *_, bad, _ in brute.decontaminated(list(rows.items()), items) if not bad}
    assert {r.doc_id: r.text for r in after.collect()} == {i: rows[i] for i in want}


def test_pii_moves_every_value(stages):
    import re
    before, after = (dict((r.doc_id, r.text) for r in df.collect()) for df in stages["pii"])
    assert before.keys() == after.keys()
    for i, t in before.items():
        found = [m[0] for m in re.finditer(pii.PATTERNS["email"] + "|" + pii.PATTERNS["phone"], t)]
        assert not any(x in after[i] for x in found)
        assert found or re.search("[0-9]", t) or after[i] == t


def test_run_over_empty_and_odd_rows(spark, tmp_path):
    docs = table(spark, SF, "documents")
    odd = [(None, None, None, None, None), (1, None, "en", "s", 0), (1, "the cat and the dog", "en", "s", 3), (1, "the cat and the dog", "en", "s", 3), (None, "the end", "en", None, 1)]
    for k, df in enumerate((docs.limit(0), spark.createDataFrame(odd, docs.schema))):
        df.coalesce(1).write.parquet(f"{tmp_path}/{k}/documents.parquet")
        table(spark, SF, "benchmark").write.parquet(f"{tmp_path}/{k}/benchmark.parquet")
        got = C.run(spark, f"{tmp_path}/{k}").collect()
        assert (len(got) == 0) == (k == 0)


def test_columns_named_like_results_pass(spark):
    docs = table(spark, SF, "documents")
    names = ["n_words", "N_Hit", "contaminated", "hit_spans", "lang_pred", "lang_score", "n_email", "n_ip", "root", "fp", "__fp"]
    docs = docs.select("*", *(C.F.concat(C.F.lit(f"{n} of "), C.F.col("doc_id").cast("string")).alias(n) for n in names))
    for name, f in C.STAGES[:-1]:
        out = f(spark, docs, SF)
        assert out.dtypes == docs.dtypes, name
        rows = out.select("doc_id", *names).collect()
        assert rows and all(tuple(r)[1:] == tuple(f"{n} of {r.doc_id}" for n in names) for r in rows), name
