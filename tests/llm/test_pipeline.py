"""Each pipeline stage, on what the stage before kept, against a plain version."""

from collections import Counter, defaultdict

import corpus_pipeline
import pytest
from strandwise.llm.common import BATCH, fold, written
from strandwise.llm.queries import table
from strandwise.llm.toxicity import fit, score
from tests.llm.test_contamination import plain as contaminated
from tests.llm.test_mixing import WORDS, plain_targets
from tests.llm.test_shingle_dedup import plain_kept
from tests.llm.test_token_store import plain as plain_ids

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def kept(spark):
    """The input and the output of every stage."""
    frames = [table(spark, SF, "documents")]
    for _, stage in corpus_pipeline.STAGES:
        frames.append(written(stage(spark, frames[-1], SF)))
    return frames


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_columns_stay(kept):
    assert len({tuple(df.dtypes) for df in kept[:-1]}) == 1


def test_toxic_documents_go(spark, kept):
    model = fit(kept[0], table(spark, SF, "labels"), fold("doc_id") != 0)
    bad = {r.doc_id for r in score(kept[0], model).where("predicted = 1").collect()}
    assert bad and rows(kept[1]) == [r for r in rows(kept[0]) if r[0] not in bad]


def test_one_of_each_group_stays(kept):
    before = rows(kept[1])
    first = plain_kept([(r[0], r[1]) for r in before])
    assert len(first) < len(before) and rows(kept[2]) == [r for r in before if r[0] in first]


def test_benchmark_passages_go(spark, kept):
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    bad = {r[0] for r in contaminated([(r[0], r[1]) for r in rows(kept[2])], items)}
    assert bad and rows(kept[3]) == [r for r in rows(kept[2]) if r[0] not in bad]


def test_the_mix_has_its_words(kept):
    before = {r.doc_id: r for r in kept[3].collect()}
    sizes, taken, per_doc = defaultdict(int), Counter(), Counter()
    for r in before.values():
        sizes[r.source] += len(WORDS.findall(r.text or ""))
    for r in kept[4].collect():
        words, whole = WORDS.findall(r.text), WORDS.findall(before[r.doc_id].text)
        taken[r.source] += len(words)
        per_doc[r.doc_id] += len(words)
        assert r.text == before[r.doc_id].text or not Counter(words) - Counter(whole)
        assert r.n_chars == len(r.text)
    assert all(n <= 2 * len(WORDS.findall(before[d].text)) for d, n in per_doc.items())
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 64


def test_ids_are_those_of_the_library(kept):
    assert rows(kept[5]) == plain_ids([(r.doc_id, r.text) for r in kept[4].collect()])


def test_run_agrees_with_its_stages(spark, kept):
    first, second = corpus_pipeline.run(spark, SF), corpus_pipeline.run(spark, SF)
    assert rows(first) == rows(second) == rows(kept[5])


def test_odd_rows(spark, tmp_path):
    text = "alpha beta gamma delta epsilon zeta eta theta"
    odd = [(1, None, None, None, None), (None, "", "en", "a", 0), (2, text, "en", None, len(text)), (2, text, "en", None, len(text)),
           (3, text + " iota", "en", "b", len(text) + 5), (4, "w " * 60_000, None, "b", 120_000)]
    schema = table(spark, SF, "documents").schema
    docs = spark.createDataFrame(odd, schema)
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, None), (2, "too short")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            frame = written(stage(spark, frame, str(tmp_path)))
            if name == "near_duplicates" and frame.count():
                assert sorted(r.doc_id for r in frame.collect() if r.doc_id) == [1, 2, 4]
        assert frame.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_python_workers_get_few_texts_at_once(spark):
    docs = table(spark, SF, "documents")
    spark.conf.unset(BATCH)
    for name, stage in corpus_pipeline.STAGES[:2]:
        docs = stage(spark, docs, SF)
        assert int(spark.conf.get(BATCH)) <= 1000
    rows = docs.sparkSession.range(2500, numPartitions=1).mapInArrow(lambda batches: (b.slice(0, 1) for b in batches), "id long")
    assert rows.count() == 3
    spark.conf.unset(BATCH)
