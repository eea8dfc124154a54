import random

import corpus_pipeline
from corvox.llm import queries


def test_stages_keep_clean_documents_and_columns(spark, tmp_path):
    rng = random.Random(3)
    plain = [a + b for a in ("ta", "ro", "mi", "ke", "lu", "so") for b in ("na", "ri", "den", "pol", "mus")]
    text = lambda n: " ".join(rng.choice(plain) + rng.choice(plain) for _ in range(n))
    rows = [(k, text(80) + (" vilnak" if k % 5 == 0 else ""), "en", f"s{k % 3}", 0) for k in range(200)]
    passage = text(25)
    rows += [(300, rows[1][1], "en", "s", 0), (301, rows[2][1] + " x", "en", "s", 0), (302, f"{text(40)} {passage} {text(40)}", "en", "s", 0), (303, text(30) + " token=abcdefghijklmnop", "en", "s", 0), (304, None, "en", "s", 0), (305, "", "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 1, int(k % 5 == 0)) for k in range(200)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    df = spark.read.parquet(str(tmp_path / "documents.parquet"))
    kept = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        df = spark.createDataFrame(stage(spark, df, str(tmp_path)).collect(), df.schema)
        assert df.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        kept.append({r.doc_id: r.text for r in df.collect()})
    assert set(kept[0]) == {r[0] for r in rows} - set(range(0, 200, 5))
    assert set(kept[1]) == set(kept[0]) - {300, 301, 305}
    assert passage not in kept[2][302] and all(kept[2][k] == kept[1][k] for k in kept[2] if k != 302)
    assert kept[3][303].endswith("[secret]") and all(kept[3][k] == kept[2][k] for k in kept[3] if k != 303)
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == set(kept[3])
    assert corpus_pipeline.ORACLE_SQL is None and [int(q[2:].split("_")[0]) for q in queries.queries()] == list(range(1, 14))


def test_stages_take_empty_tables_nulls_and_clashing_columns(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, node long, kept string, hits string, score double, doc struct<text: string>"
    odd = [(1, None, None, None, None, 1, "k", None, None, None), (None, "a b c", None, None, 5, 1, "k", "h", 0.1, ("x",)), (1, None, None, None, None, 1, "k", None, None, None), (2, "w " * 60_000, "en", "s", 0, 1, "k", "h", 0.1, ("x",)), (3, "", "en", "s", 0, 1, "k", "h", 0.1, ("x",))]
    spark.createDataFrame([(None, 1, None), (1, None, 1), (2, 1, 0), (2, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(None, "x"), (1, None), (2, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for rows in (odd, []):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES:
            got = stage(spark, docs, str(tmp_path))
            n = got.count()
            if name == "packing":
                assert got.where("length <= 0 or length > 2048").isEmpty()
            else:
                assert got.columns == docs.columns and n <= len(rows), name
            assert n > 0 or not rows, name
