import duckdb
from pyspark.sql import functions as F

from tradeloom.llm import mixing
from tradeloom.llm.queries import ORACLE_SQL

SMALL = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def test_query_equals_sql_and_reruns_agree(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    cursor = con.execute(ORACLE_SQL["op5_mix_sources"])
    names = [d[0] for d in cursor.description]
    want = sorted(cursor.fetchall())
    for _ in range(2):
        assert sorted(tuple(r) for r in mixing.op5_mix_sources(spark, SMALL).select(names).collect()) == want
    sizes = names.index("size"), names.index("taken")
    assert all(r[sizes[1]] <= 2 * r[sizes[0]] for r in want)


def test_targets_share_out_the_excess(spark):
    rows = [(i, s, "w " * n) for i, (s, n) in enumerate([("a", 10), ("b", 100), ("c", 1000), ("d", 0), (None, 50)])]
    got = {r.source: r for r in mixing.targets(frame(spark, rows)).collect()}
    assert {s: r.weight for s, r in got.items()} == {"a": 5.0, "b": 2.0, "c": 1.0, "d": 5.0, None: 2.0}
    # a, b and the null source stop at twice their size; c gets the rest.
    assert {s: r.target for s, r in got.items()} == {"a": 20.0, "b": 200.0, "c": 1.5 * 1160 - 320, "d": 0.0, None: 100.0}


def test_words_null_empty_and_repeated_rows(spark):
    rows = [(1, "a", None), (2, "a", ""), (3, "a", " x\ty z\x0bq "), (3, "a", " x\ty z\x0bq "), (None, None, "u")]
    docs = frame(spark, rows)
    got = mixing.mix(docs, mixing.targets(docs), keep=["doc_id"]).select("doc_id", "mix.*").collect()
    assert sorted((r.doc_id or 0, r.size) for r in got) == [(0, 1), (1, 0), (2, 0), (3, 3), (3, 3)]
    assert len({r.copies for r in got if r.doc_id == 3}) == 1
    assert mixing.emit(docs.limit(0)).collect() == []


def test_emitted_rows_and_clashing_columns(spark):
    docs = frame(spark, [(i, "s" if i % 3 else "t", "one two three") for i in range(300)])
    for name in ("copy", "size", "target", "copies", "mix", "weight", "mix_source"):
        docs = docs.withColumn(name, F.lit(7))
    out = mixing.emit(docs)
    assert out.columns == [*docs.columns, "_copy"]
    many = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert set(many.values()) <= {1, 2} and out.where("copy = 7 and size = 7").count() == sum(many.values())


def test_a_very_long_text_is_counted_whole(spark):
    docs = frame(spark, [(1, "a", "word " * 1_000_000), (2, "a", "x" * 3_000_000), (3, "b", "one")])
    got = {r.doc_id: r.size for r in mixing.mix(docs, mixing.targets(docs), keep=["doc_id"]).select("doc_id", "mix.size").collect()}
    assert got == {1: 1_000_000, 2: 1, 3: 1}
