"""The pipeline, stage by stage, against brute force on what each stage was given."""

import hashlib

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from quarry.llm import quality_mil
from quarry.llm.common import kept_table, table
from tests.llm import test_decontaminate, test_near_dedup, test_secrets
from tests.llm.data import SCHEMA, nothing, odd_documents, prose

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """[(name, documents in, documents out)]"""
    docs, out = table(spark, sf_dir, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        after = kept_table(stage(spark, docs, sf_dir), "t-stage")
        out.append((name, docs, after))
        docs = after
    return {name: (a, b) for name, a, b in out}


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_names_and_columns(spark, sf_dir, stages):
    assert list(stages) == ["quality", "near_dedup", "decontamination", "secret_scan", "tokenise"]
    columns = table(spark, sf_dir, "documents").columns
    for name in list(stages)[:-1]:
        assert stages[name][1].columns == columns
    assert corpus_pipeline.ORACLE_SQL is None and entry.queries()["pipeline"] is corpus_pipeline.run


def test_quality_keeps_what_the_classifier_accepts(spark, sf_dir, stages):
    before, after = stages["quality"]
    got = quality_mil.classify(before, table(spark, sf_dir, "labels"))
    assert set(rows(after)) == {r.doc_id for r in got.collect() if r.predicted == 1}
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    good = [i for i in rows(before) if labels.get(i) == 1]
    assert sum(i in rows(after) for i in good) >= 0.97 * len(good)


def test_near_dedup_keeps_one_of_each_group(stages):
    before, after = stages["near_dedup"]
    want = test_near_dedup.brute([(i, r.text) for i, r in rows(before).items()], size=5)
    assert set(rows(after)) == {i for i, n, c in want if i == c}


def test_decontamination_drops_the_contaminated(spark, sf_dir, stages):
    before, after = stages["decontamination"]
    bench = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    want = test_decontaminate.brute([(i, r.text) for i, r in rows(before).items()], bench)
    assert set(rows(after)) == {r[0] for r in want if not r[-1]}


def test_secrets_are_masked(stages):
    before, after = map(rows, stages["secret_scan"])
    assert set(before) == set(after)
    for i, r in after.items():
        spans = test_secrets.brute(before[i].text)
        assert (r.text == before[i].text) == (not spans) and not test_secrets.brute(r.text)
        assert r.n_chars == len(r.text)


def test_tokens(stages):
    from quarry.llm.bpe import read_ranks

    before, after = map(rows, stages["tokenise"])
    ranks = read_ranks(P.path("byte_bpe_50k.tiktoken"))
    coder = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for i, r in after.items():
        ids = coder.encode_ordinary(before[i].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()


def test_run_gives_the_last_stage(spark, sf_dir, stages):
    got = corpus_pipeline.run(spark, sf_dir)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, stages["tokenise"][1].collect()))


def test_odd_rows_pass_every_stage(spark, sf_dir):
    docs = odd_documents(spark)
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        assert name == "tokenise" or after.columns == docs.columns
        assert after.count() <= docs.count()
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing(spark), sf_dir).count() == 0


def test_decontamination_judges_rows_not_ids(spark, sf_dir):
    """Clean rows stay beside contaminated ones without an id or with theirs; null texts stay."""
    leaked = max((r.text for r in table(spark, sf_dir, "benchmark").collect()), key=len)
    clean = [prose(200 + k, 40) for k in range(3)]
    own = [(None, leaked), (None, clean[0]), (None, clean[1]), (None, None), (7, leaked), (7, clean[0]), (7, clean[2]), (8, clean[0])]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in own], SCHEMA)
    after = corpus_pipeline.decontamination(spark, docs, sf_dir)
    assert after.columns == docs.columns
    got = sorted([(r.doc_id, r.text) for r in after.collect()], key=str)
    assert got == sorted([x for x in own if x[1] != leaked], key=str)
