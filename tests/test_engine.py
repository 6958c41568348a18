"""Column functions, sources and streams in Spark, and the registered queries against DuckDB."""

import pytest
from pyspark.sql import functions as F

import glyphmill.queries as Q
from glyphmill.functions import columns as C
from glyphmill.operators.transcoder import Transcoder, register_codecs
from glyphmill.sources.files import convert_files, guess_files, read_lines, read_pieces, write_files
from glyphmill.streaming.chunks import convert_chunks, convert_messages, decode_chunks, encode_chunks, write_encoded

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_match_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, SF)
    got = sorted(map(tuple, df.collect()), key=str)
    if name in Q.ORACLE_SQL:
        rel = duck.sql(Q.ORACLE_SQL[name])
        order = [rel.columns.index(c) for c in df.columns]
        assert got == sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=str)
    else:
        assert got


def test_nulls_and_empty(spark):
    df = spark.createDataFrame([(None,), (b"",), (b"\x82\xa0",)], "b binary")
    rows = df.select(C.transcode("b", "-S", "-w").alias("t"), C.guess_detail("b").alias("g"), C.eol_kind("b").alias("e")).collect()
    assert [r.t if r.t is None else bytes(r.t) for r in rows] == [None, b"", "あ".encode()]
    assert rows[0].g is None or rows[0].g.encoding is None
    assert rows[1].g.encoding == "ASCII"


def test_python_gets_few_texts_at_once(spark):
    """Columns lower the session's batches, and the five conversions of guess_documents share a worker."""
    for key in ("maxRecordsPerBatch", "maxBytesPerBatch"):
        spark.conf.unset(f"spark.sql.execution.arrow.{key}")
    for make in (C.transcode, C.guess_detail):
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        make("b", "-S")
        assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 1000
        assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch").rstrip("B")) <= 4 << 20
    plan = Q.guess_documents(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") + plan.count("ArrowEvalPython (") + plan.count("ArrowEvalPython(") <= 2, plan  # a worker process each


def test_native_path_equals_kernel(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    from glyphmill.plans.plan import compile_plan

    for options in (["-W", "-w", "-m0", "-x", "-Lw"], ["-W", "-w16", "-m0", "-x"], ["-W", "-w", "-m0", "-r"], ["-W", "-w8", "-m0", "-Z3"]):
        both = df.select(C.transcode("text", *options).alias("a"), C.convert_with(F.col("text").cast("binary"), compile_plan(options)).alias("b"))
        assert both.where(~F.col("a").eqNullSafe(F.col("b"))).count() == 0


def test_transcoder(spark):
    df = spark.createDataFrame([("日本",)], "t string")
    t = Transcoder("-m0", "-x", encoding="EUC-JP")
    row = df.select(t.encode("t").alias("e")).select("e", t.decode("e.value").alias("d")).first()
    assert bytes(row.e.value) == "日本".encode("euc_jp") and row.e.consumed == 2
    assert (row.d.value, row.d.consumed) == ("日本", 4)
    with pytest.raises(ValueError):
        Transcoder(encoding="klingon")
    with pytest.raises(TypeError):
        Transcoder(encoding=3)
    with pytest.raises(TypeError):
        Transcoder().encode("t")
    names = register_codecs(spark)
    assert names["sjis"].encode == "shift_jis_encode"
    assert bytes(spark.sql("SELECT shift_jis_encode('日本') AS b").first().b) == "日本".encode("shift_jis")
    assert spark.sql("SELECT euc_jp_decode(X'C6FC') AS t").first().t == "日"


def test_files(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes("一\n二\n".encode("shift_jis"))
    (tmp_path / "b.txt").write_bytes(b"plain\r\n")
    paths = [str(tmp_path / "a.txt"), str(tmp_path / "b.txt")]
    assert [bytes(r.content) for r in convert_files(spark, paths, "-w").orderBy("arg").collect()] == ["一\n二\n".encode(), b"plain\r\n"]
    assert [bytes(r.content) for r in convert_files(spark, paths).orderBy("arg").collect()][0] == "一\n二\n".encode("shift_jis")
    assert [(r.encoding, r.eol) for r in guess_files(spark, paths).orderBy("arg").collect()] == [("Shift_JIS", "LF"), ("ASCII", "CRLF")]
    assert [r.line for r in read_lines(spark, paths[:1], "-S").orderBy("number").collect()] == ["一\n", "二\n"]
    assert [r.line for r in read_lines(spark, paths[1:], all_separators=True).collect()] == ["plain\r\n"]
    assert [r.piece for r in read_pieces(spark, paths[:1], 3, "-S").orderBy("number").collect()] == ["一\n二", "\n"]
    write_files(convert_files(spark, paths, "-e").withColumn("name", F.concat(F.col("arg").cast("string"), F.lit(".euc"))), str(tmp_path / "out"))
    assert (tmp_path / "out" / "0.euc").read_bytes() == "一\n二\n".encode("euc_jp")


def test_chunks(spark, tmp_path):
    raw = "日本語".encode("shift_jis")
    rows = [("x", 0, raw[:1], False), ("x", 1, raw[1:3], False), ("y", 0, b"abc", True), ("x", 2, raw[3:], True)]
    spark.createDataFrame(rows, "stream_id string, seq int, chunk binary, final boolean").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("stream_id string, seq int, chunk binary, final boolean").parquet(str(tmp_path / "in"))
    q = convert_chunks(stream, "-S", "-w").writeStream.format("memory").queryName("chunks").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.key, bytes(r.content).decode()) for r in spark.table("chunks").collect()) == [("x", "日本語"), ("y", "abc")]


def ended(query):
    query.awaitTermination(120)
    assert not query.isActive and query.exception() is None


def test_text_chunks(spark, tmp_path):
    """Text in pieces to bytes, and bytes in pieces, cut within a character, back to text."""
    spark.createDataFrame([("x", 0, "日", False), ("x", 1, "本語", True), ("y", 0, None, False), ("y", 1, "", True)], "stream_id string, seq int, chunk string, final boolean").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("stream_id string, seq int, chunk string, final boolean").parquet(str(tmp_path / "in"))
    ended(encode_chunks(stream, "-e").writeStream.format("memory").queryName("encoded").option("checkpointLocation", str(tmp_path / "a")).trigger(availableNow=True).start())
    assert sorted((r.key, bytes(r.content)) for r in spark.table("encoded").collect()) == [("x", "日本語".encode("euc_jp")), ("y", b"")]
    raw = "日本語".encode("euc_jp")
    spark.createDataFrame([("x", 0, raw[:3], False), ("x", 1, raw[3:], True)], "stream_id string, seq int, chunk binary, final boolean").write.parquet(str(tmp_path / "bytes"))
    stream = spark.readStream.schema("stream_id string, seq int, chunk binary, final boolean").parquet(str(tmp_path / "bytes"))
    ended(decode_chunks(stream, "-E").writeStream.format("memory").queryName("decoded").option("checkpointLocation", str(tmp_path / "b")).trigger(availableNow=True).start())
    assert [tuple(r) for r in spark.table("decoded").collect()] == [("x", "日本語")]


def test_messages_and_sink(spark, tmp_path):
    spark.createDataFrame([(1, "日本".encode("shift_jis")), (2, None)], "id int, body binary").write.parquet(str(tmp_path / "in"))
    batch = spark.read.parquet(str(tmp_path / "in"))
    assert {r.id: r.body and bytes(r.body) for r in convert_messages(batch, "body", "-S", "-w").collect()} == {1: "日本".encode(), 2: None}
    for _ in range(2):  # a query that is started again from its checkpoint adds nothing
        query = write_encoded(spark.readStream.schema("id int, body binary").parquet(str(tmp_path / "in")), "body", str(tmp_path / "out"), str(tmp_path / "cp"), "-S", "-e")
        query.processAllAvailable()
        query.stop()
    assert {r.id: r.body and bytes(r.body) for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: "日本".encode("euc_jp"), 2: None}


def test_error_handling(spark):
    df = spark.createDataFrame([(b"\x82\xa0\xff\x41\x80",)], "b binary")
    rows = [df.select(C.decode_text("b", "-S", errors=e).alias("t")).first().t for e in ("strict", "ignore", "replace")]
    assert len(set(rows)) == 1 and rows[0].startswith("あ")
    with pytest.raises(ValueError):
        C.decode_text("b", errors="klingon")


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() == 200
    assert set(entry.oracle_sql()) <= set(entry.queries())
