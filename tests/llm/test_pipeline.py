"""The whole pipeline over the smallest tables, stage by stage against brute force."""

import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm.test_text_ops import brute_groups, brute_lines
from tidemark.llm.common import materialize, table

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")


def texts(df):
    return {r.doc_id: r.text or "" for r in df.select("doc_id", "text").collect()}


def test_stages(spark):
    docs = table(spark, DATA, "documents")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "packing"]
    kept = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept.append(materialize(stage(spark, kept[-1], DATA)))
        assert kept[-1].columns == docs.columns
    verdicts = {r.doc_id for r in entry.queries()["op3_quality_rules"](spark, DATA).filter("kept").collect()}
    assert set(texts(kept[1])) == verdicts
    assert texts(kept[2]) == {d: t for d, (_, _, t) in brute_lines(texts(kept[1]), 10).items()}
    assert set(texts(kept[3])) == {d for d, (_, c) in brute_groups(texts(kept[2])).items() if c == d}
    assert set(texts(kept[4])) < set(texts(kept[3]))
    packed = corpus_pipeline.STAGES[-1][1](spark, kept[4], DATA)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == set(texts(kept[4]))


ODD = "doc_id long, text string, lang string, source string, n_chars int, head string, stratum string, `a b` string, rest int"


def odd_tables(spark, folder, rows):
    good = " ".join(f"word{i} of{i}" for i in range(80))
    texts = [good, good, good + " and more", None, "", " \n", "short", good + " other end", "\n".join([good[:100], "Same line", good]), "x " * 30_000, good.replace("word", "term")]
    texts += [" ".join(f"w{k}x{i}" for i in range(80)) + "\nSame line\n" for k in range(12)]
    texts.append(" ".join(f"q{i}" for i in range(60)) + " " + " ".join(f"bench{i}" for i in range(20)))
    docs = [((None, 5, 5)[i] if i < 3 else 100 + i, t, (None, "en")[i % 2], None, None if i % 3 else len(t or ""), "h", None, "odd", i) for i, t in enumerate(texts)][: rows if rows is not None else None]
    spark.createDataFrame(docs, ODD).repartition(3).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(100, None, None), (None, 1, 0), (107, 1, None)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(None, " ".join(f"bench{i}" for i in range(20))), (1, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder), texts


def test_odd_rows_pass_all_stages(spark, tmp_path):
    folder, texts = odd_tables(spark, tmp_path, None)
    docs = table(spark, folder, "documents")
    stages = dict(corpus_pipeline.STAGES)
    kept = materialize(stages["quality_rules"](spark, docs, folder))
    assert kept.columns == docs.columns and kept.schema == docs.schema
    assert kept.filter("text is null or trim(text) = '' or text = 'short'").isEmpty() and kept.count() == len([t for t in texts if t and len(t.split()) >= 50 and not t.startswith("x x")])
    lined = materialize(stages["line_dedup"](spark, kept, folder))
    assert lined.columns == docs.columns and lined.filter("text like '%Same line%'").isEmpty() and lined.filter("n_chars <> length(text)").isEmpty()
    single = materialize(stages["near_dedup"](spark, lined, folder))
    good = [r for r in single.collect() if r.text.startswith("word0 of0")]
    assert single.columns == docs.columns and len(good) == 1 and good[0].doc_id == 5  # null ids are never smaller
    clean = materialize(stages["decontamination"](spark, single, folder))
    assert clean.columns == docs.columns and clean.filter("text like '%bench%'").isEmpty() and clean.count() == single.count() - 1
    assert stages["packing"](spark, clean, folder).select("doc_id").distinct().count() == clean.select("doc_id").distinct().count()
    assert corpus_pipeline.run(spark, folder).count() == stages["packing"](spark, clean, folder).count()


def test_empty_tables_pass_all_stages(spark, tmp_path):
    folder, _ = odd_tables(spark, tmp_path, 0)
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, folder))
        assert docs.count() == 0 and docs.schema == table(spark, folder, "documents").schema
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11)) and "pipeline" in entry.queries()
