from collections import Counter

import pytest

pytest.importorskip("tokenizers")
public_tokenizers = pytest.importorskip("public_tokenizers")

from test_minhash import by_hand as groups_by_hand  # noqa: E402
from test_mixture import by_hand as mix_by_hand  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from gridtally.llm import queries, secrets  # noqa: E402
from gridtally.llm.tables import staged  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source", "n_chars").collect()]


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before and after every stage, as the pipeline hands them on."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        after = staged(stage(spark, docs, SF), f"test-{name}")
        out[name] = (docs, after)
        docs = after
    return out


def test_order_and_columns(stages):
    assert list(stages) == ["language", "near_duplicates", "secrets", "mixture", "bpe"]
    for name, (before, after) in stages.items():
        assert before.columns == COLUMNS
        assert name == "bpe" or after.columns == COLUMNS


def test_language_keeps_what_it_can_name(spark, stages):
    before, after = stages["language"]
    found = {r.doc_id: r for r in queries.QUERIES["op5_language"](spark, SF).collect()}
    sure = [r for r in rows(before) if found[r[0]].lang_pred != "und" and found[r[0]].score >= 0.5]
    assert sorted(rows(after)) == sorted(sure)
    odd = spark.createDataFrame([(1, None, "en", "s", 0), (2, "12 34 !", "en", "s", 7), (3, "", None, None, 0)], before.schema)
    kept = corpus_pipeline.identify(spark, before.union(odd), SF)
    assert sorted(rows(kept)) == sorted(sure)


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near_duplicates"]
    kept = {d for d, _, _, k in groups_by_hand([(r[0], r[1]) for r in rows(before)]) if k}
    assert sorted(rows(after)) == sorted(r for r in rows(before) if r[0] in kept)


def test_repeated_rows_and_clashing_ids(spark, stages):
    before, _ = stages["near_duplicates"]
    odd = [(7, "one two three four five six", "en", "s", 27)] * 3 + [(7, "quite another text than before", "en", "s", 30)]
    odd += [(None, "no id but a text of its own", None, None, 0)] * 2
    docs = spark.createDataFrame(odd, before.schema)
    assert sorted(rows(corpus_pipeline.deduplicate(spark, docs, SF)), key=repr) == sorted(set(odd), key=repr)


def test_secrets_are_masked(stages):
    before, after = stages["secrets"]
    want = [(d, secrets.masked(t), lang, s, len(secrets.masked(t))) for d, t, lang, s, _ in rows(before)]
    assert sorted(rows(after)) == sorted(want)


def test_mix_takes_documents_as_often_as_planned(stages):
    before, after = stages["mixture"]
    plan = mix_by_hand([(r[0], r[1], r[3]) for r in rows(before)])
    want = {d: taken // n for d, n, _, _, taken in plan if n}
    got = Counter(r[0] for r in rows(after))
    assert all(got[d] == n for d, n in want.items())
    assert set(rows(after)) <= set(rows(before))


def test_ids_equal_the_library(spark, stages):
    before, after = stages["bpe"]
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter((r[0], tuple(library.encode(r[1], add_special_tokens=False).ids)) for r in rows(before))
    assert Counter((r.doc_id, tuple(r.ids)) for r in after.collect()) == want
    assert all(r.n_tokens == len(r.ids) for r in after.collect())


def test_run_gives_the_last_stage(spark, stages):
    _, after = stages["bpe"]
    assert Counter(map(str, corpus_pipeline.run(spark, SF).collect())) == Counter(map(str, after.collect()))


def test_empty_table(spark, stages):
    docs = stages["language"][0].limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0
