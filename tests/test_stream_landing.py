"""The files that a stream takes: one pass over the table, in key order."""

def test_the_source_is_landed_in_one_pass_and_in_order(spark, tmp_path, monkeypatch):
    from wordmill.streaming import vocab_stream as vs

    docs = spark.createDataFrame([(k, f"w{k}") for k in (7, 3, None, 1, 9, 5, 3, 8)], "doc_id bigint, text string")
    writes, plain = [], type(docs).write.fget
    monkeypatch.setattr(type(docs), "write", property(lambda df: writes.append(1) or plain(df)))
    paths = vs.write_in_order(docs, str(tmp_path / "src"), 4)
    assert len(writes) == 1 and 1 < len(paths) <= 4
    parts = [sorted(-1 if r.doc_id is None else r.doc_id for r in spark.read.parquet(p).collect()) for p in paths]
    assert [k for part in parts for k in part] == [-1, 1, 3, 3, 5, 7, 8, 9]
    dates = [max(f.stat().st_mtime for f in (tmp_path / "src" / p.rsplit("/", 1)[1]).glob("*.parquet")) for p in paths]
    assert dates == sorted(dates) and len(set(dates)) == len(dates)
