"""The pipeline's stages against plain versions, on the small tables."""

import brute
import corpus_pipeline as P
import pytest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in P.STAGES:
        path = f"file://{tmp_path_factory.mktemp('stage')}/{name}"
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append((name, docs))
    return out


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark, stages):
    assert [n for n, _ in stages[1:]] == [n for n, _ in P.STAGES] and len(P.STAGES) == 5 and P.ORACLE_SQL is None
    docs, lang, lines, near, clean, packed = (df for _, df in stages)
    for df in (lang, lines, near, clean):
        assert df.dtypes == docs.dtypes
    assert lang.count() >= docs.count() - 2
    gone = brute.removed_lines(sorted(texts(lang).items()))
    want = {}
    for d, t in texts(lang).items():
        left = "\n".join(x for k, x in enumerate(t.split("\n")) if k not in gone.get(d, []))
        if d not in gone or brute.words(left):
            want[d] = left
    assert texts(lines) == want and all(r.n_chars == len(r.text) for r in lines.collect() if r.doc_id in gone)
    found = brute.components(sorted(texts(lines).items()))
    assert texts(near) == {d: t for d, t in texts(lines).items() if found[d][1] == d}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    bad = {d for d, _ in brute.contaminated(sorted(texts(near).items()), items)}
    assert texts(clean) == {d: t for d, t in texts(near).items() if d not in bad}
    assert {r.doc_id for r in packed.collect()} == set(texts(clean))


def test_run_is_the_stages_together(spark, stages):
    rows = lambda df: sorted(tuple(r) for r in df.select("doc_id", "piece", "start", "length", "ids_crc32").collect())
    assert rows(P.run(spark, SF)) == rows(stages[-1][1])


def test_stages_on_odd_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, extra string"
    texts = [None, "", " \n", "a b c d e f g", "a b c d e f g", "A b c d e f g", "12 34", "word " * 5000]
    odd = spark.createDataFrame([(d if d else None, t, None, None, None, "x") for d, t in enumerate(texts)] + [(4, texts[4], None, None, None, "x")], schema)
    none = spark.createDataFrame([], schema)
    for name, stage in P.STAGES:
        out, left = stage(spark, odd, SF), stage(spark, none, SF)
        assert left.count() == 0 and out.count() > 0
        if name != P.STAGES[-1][0]:
            assert out.columns == left.columns == odd.columns, name
    assert {r.doc_id for r in P.STAGES[-1][1](spark, odd, SF).collect()} == {r.doc_id for r in odd.collect()}
