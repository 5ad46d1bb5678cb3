from quiremill.streaming import ingest


def test_blocks_of_arriving_documents(spark, tmp_path):
    schema = "doc_id long, text string"
    for i in range(2):
        spark.createDataFrame([(i, "one\ntwo")], schema).write.parquet(str(tmp_path / f"in/{i}"))
    stream = ingest.arriving(spark, str(tmp_path / "in/*"), schema, 1)
    q = stream.writeStream.foreachBatch(ingest.blocks_sink(str(tmp_path / "out"))).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 4 and got.select("batch").distinct().count() == 2
