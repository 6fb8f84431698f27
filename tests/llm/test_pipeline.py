"""Each stage against a plain version of it, on the input it gets in the pipeline."""

import re

import pytest
from test_jaccard import brute
from tokenizers import Tokenizer

import corpus_pipeline
from paytide.llm import langid, secrets
from paytide.llm.queries import TOKENIZER
from paytide.llm.tables import table

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = table(spark, SF, "documents")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stages") / name)
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_shape(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_duplicates", "decontaminate", "redact_secrets", "encode"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_language_id(stages):
    before, after = by_id(stages[0]), by_id(stages[1])
    assert set(after) == {i for i, r in before.items() if re.search(r"[^\W\d_]", r["text"] or "")}
    assert all(after[i] == before[i] for i in after)


def test_near_duplicates(stages):
    before, after = by_id(stages[1]), by_id(stages[2])
    groups = brute([(i, r["text"]) for i, r in before.items()], 5, 80)
    assert set(after) == {i for i, (_, least) in groups.items() if i == least}


def test_decontaminate(spark, stages):
    before, after = by_id(stages[2]), by_id(stages[3])
    items = [re.findall(r"\w+", r["text"].lower()) for r in table(spark, SF, "benchmark").collect()]

    def leaks(text):
        words = re.findall(r"\w+", text.lower())
        return any(
            5 * sum(a == b for a, b in zip(words[p : p + len(item)], item)) >= 4 * len(item)
            for item in items for p in range(len(words) - len(item) + 1)
        )

    assert set(before) - set(after) == {i for i, r in before.items() if leaks(r["text"])}


def test_redact_secrets(stages):
    before, after = by_id(stages[3]), by_id(stages[4])
    assert set(before) == set(after)
    for i, r in after.items():
        assert not secrets.matches(r["text"].replace("[SECRET]", ""))
        assert r["n_chars"] == len(r["text"])
        if not secrets.matches(before[i]["text"]):
            assert r == before[i]


def test_encode_and_run(spark, stages):
    library = Tokenizer.from_file(TOKENIZER)
    before, after = by_id(stages[4]), by_id(stages[5])
    assert set(before) == set(after)
    for i, r in after.items():
        assert r["ids"] == library.encode(before[i]["text"], add_special_tokens=False).ids
        assert r["decoded"] == library.decode(r["ids"], skip_special_tokens=False) and r["n_tokens"] == len(r["ids"])
    assert by_id(corpus_pipeline.run(spark, SF)) == after


def test_empty_table(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
        docs = docs if "text" in docs.columns else table(spark, SF, "documents").limit(0)


def test_learned_languages_cover_all_documents(stages):
    assert langid.UNKNOWN not in {r["lang"] for r in stages[1].select("lang").distinct().collect()}
