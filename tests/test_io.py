"""Readers and writers: id lists, header lines, GeoJSON collections."""

import glob
import json
import os

from cobble.session import shared_scratch
from cobble.sources import io
from pyspark.sql import types as T


def test_id_list_lines_are_bounded_with_a_hot_repeated_id(spark):
    ids = spark.createDataFrame([(5,)] * 2500 + [(i,) for i in range(100)], "pid long")
    path = shared_scratch(spark, "ids_hot")
    io.write_id_list(ids, path, per_line=1000)
    lines = [l for p in glob.glob(os.path.join(path, "part-*")) for l in open(p).read().splitlines()]
    assert max(len(l.split(",")) for l in lines) <= 1000
    back = [r["pid"] for r in io.read_id_list(spark, path).collect()]
    assert sorted(back) == sorted([5] * 2500 + list(range(100)))


def test_header_lines_dropped_anywhere(spark):
    path = shared_scratch(spark, "hdr")
    os.makedirs(path)
    for name, body in [("a.txt", "DBN,X\n1,a\n"), ("b.txt", "2,b\nDBN,X\n3,c\n")]:
        with open(os.path.join(path, name), "w") as f:
            f.write(body)
    rows = io.drop_header_lines(io.read_text(spark, path + "/*.txt"), "DBN,")
    assert sorted(r["value"] for r in rows.collect()) == ["1,a", "2,b", "3,c"]


def test_geojson_collection_keeps_feature_order(spark):
    path = shared_scratch(spark, "gj")
    os.makedirs(path)
    feats = [{"type": "Feature", "geometry": {"type": "Point"}, "properties": {"name": n}} for n in "cab"]
    with open(os.path.join(path, "f.json"), "w") as f:
        json.dump({"type": "FeatureCollection", "features": feats}, f, indent=2)
    props = T.StructType([T.StructField("name", T.StringType())])
    df = io.read_geojson_features(spark, path + "/f.json", props, collection=True, ordinal="ord")
    assert [r["name"] for r in df.orderBy("ord").collect()] == ["c", "a", "b"]


def test_id_list_lines_are_full_and_in_order(spark):
    from cobble.session import shared_scratch
    from cobble.sources.io import read_id_list, write_id_list

    ids = [i * 7919 % 10_007 for i in range(10_000)] + [5] * 3000
    path = shared_scratch(spark, "ids_test")
    write_id_list(spark.createDataFrame([(i,) for i in ids], "pid long").coalesce(1), path, per_line=100)
    lines = sorted(spark.read.text(path).collect(), key=lambda r: ids.index(int(r[0].split(",")[0])))
    assert len(lines) == 130 and all(len(r[0].split(",")) == 100 for r in lines)
    assert lines[0][0] == ",".join(map(str, ids[:100]))
    assert sorted(r["pid"] for r in read_id_list(spark, path).collect()) == sorted(ids)


def test_one_long_id_line_is_cut(spark, tmp_path):
    from cobble.sources.io import read_id_list

    (tmp_path / "ids.txt").write_text(",".join(map(str, range(200_000))) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        df = read_id_list(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 3
        assert sorted(r["pid"] for r in df.collect()) == list(range(200_000))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def _lines(spark, tmp_path):
    """Files of lines of very different lengths, one of them without a last line end, one empty."""
    want = []
    for k, n in enumerate((40, 0, 700, 3)):
        body = [f"{k}:{i} " + "x" * (i * 37 % 90) for i in range(n)]
        (tmp_path / f"f{k}.txt").write_text("\n".join(body) + ("" if k == 3 or not n else "\n"))
        want += body
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    return want


def test_lines_are_numbered_without_a_shuffle(spark, tmp_path):
    from cobble.operators.ordered import number_lines

    try:
        want = _lines(spark, tmp_path)
        df = number_lines(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 20
        assert [r["value"] for r in df.orderBy("ordinal").collect()] == want
        assert sorted(r["ordinal"] for r in df.collect()) == list(range(len(want)))
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan and "rangepartitioning" not in plan
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_first_lines_open_the_files_they_need(spark, tmp_path, monkeypatch):
    from cobble.operators import ordered

    opened, real = [], ordered._text
    monkeypatch.setattr(ordered, "_text", lambda s, paths, sep: opened.append(paths) or real(s, paths, sep))
    try:
        want = _lines(spark, tmp_path)
        for n, files in ((0, 1), (5, 1), (41, 4), (743, 4), (10_000, 4)):
            opened.clear()
            got = ordered.first_text_lines(spark, str(tmp_path), n).orderBy("ordinal").collect()
            assert [r["value"] for r in got] == want[:n]
            assert len(opened[-1]) == files
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
