"""CSV with line ends inside quotes and FeatureCollections, read by many tasks from small splits."""

import csv
import json
import random
from io import StringIO

import pyarrow as pa
import pytest
from pyspark.sql import types as T

from cobble.session import shared_scratch
from cobble.sources import io, splits


@pytest.fixture(params=[256])
def small_splits(spark, request):
    conf = {"spark.sql.files.maxPartitionBytes": str(request.param), "spark.sql.files.openCostInBytes": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield request.param
    for k in conf:
        spark.conf.unset(k)


FIELDS = [
    "plain", "", "1", "two words", "a,b", 'say ""hi""', "line\nbreak", "\n", ",\n,", '""', "x\r\ny", '"",""', "é日", " lead", "trail ",
    '\n""\n', "a" * 70 + "\n" + "b" * 70,
]


def _csv(rnd, rows, end="\n"):
    out = ["id,a,b"]
    for i in range(rows):
        cells = []
        for _ in range(2):
            v = rnd.choice(FIELDS)
            quote = any(c in v for c in '",\n\r') or (v and rnd.random() < 0.3)
            cells.append(f'"{v}"' if quote else v)
        out.append(f"{i}," + ",".join(cells))
        if rnd.random() < 0.05:
            out.append("")
    return end.join(out) + end


def _whole(spark, path, schema):
    return spark.read.csv(path, schema=schema, header=True, multiLine=True, escape='"', quote='"')


SCHEMA = "id INT, a STRING, b STRING"


def _rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_equals_a_reader_of_whole_files(spark, tmp_path, small_splits, end):
    rnd = random.Random(small_splits)
    for k in range(2):
        (tmp_path / f"f{k}.csv").write_bytes(_csv(rnd, 40, end).encode())
    got = io.read_multiline_csv(spark, str(tmp_path), SCHEMA)
    want = _rows(_whole(spark, str(tmp_path), SCHEMA))
    assert len(want) == 80 and _rows(got) == want
    # The header and every record are cut by as many tasks as there are splits.
    assert splits.pieces(spark, str(tmp_path), "\n").rdd.getNumPartitions() > 10


def test_csv_odd_ends(spark, tmp_path, small_splits):
    cases = {
        "no_end": 'id,a,b\n1,x,"y\nz"',
        "open": 'id,a,b\n1,x,y\n2,"open, to the\nvery end\n3,a,b\n' + "more text\n" * 30,
        "header_only": "id,a,b\n",
        "empty": "",
        "quoted_header": '"id","a\n\nlong name of the column, over several lines",b\n1,2,3\n',
        "quote_inside": '1,a,b\n1,5" pipe,"q"\n2,it"s,x\n3,"a"b,c\n',
    }
    for name, text in cases.items():
        path = tmp_path / name
        path.mkdir()
        (path / "f.csv").write_text(text)
        want = _rows(_whole(spark, str(path), SCHEMA))
        if name == "open":  # the file's last line end, inside the open quotes, is not kept
            want = [tuple(x.rstrip("\n") if isinstance(x, str) else x for x in r) for r in want]
        assert _rows(io.read_multiline_csv(spark, str(path), SCHEMA)) == want, name


def test_csv_records_keep_their_order(spark, tmp_path, small_splits):
    (tmp_path / "f.csv").write_text(_csv(random.Random(1), 60))
    got = [int(r["value"].split(",")[0]) for r in splits.csv_records(spark, str(tmp_path), True).orderBy("file", "pos").collect()]
    assert got == list(range(60))


def test_states_when_too_many_to_broadcast(spark, tmp_path, monkeypatch):
    """Without a broadcast the pieces are sorted back into order."""
    from cobble.operators import joins

    real = joins.broadcast_if_bounded
    monkeypatch.setattr(splits, "broadcast_if_bounded", lambda df: real(df, max_rows=0))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    try:
        (tmp_path / "f.csv").write_text(_csv(random.Random(2), 60))
        got = io.read_multiline_csv(spark, str(tmp_path), SCHEMA)
        assert _rows(got) == _rows(_whole(spark, str(tmp_path), SCHEMA))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


TEXTS = ["a", "} { ] [", 'q"uote', "back\\slash", '\\"', "{\"features\": [", "é日", "", "x" * 90, "line\nend", "}}}}"]


def _features(rnd, n, start=0):
    for i in range(start, start + n):
        shape = {"type": "Polygon", "coordinates": [[[rnd.random(), i] for _ in range(rnd.randrange(4))]]}
        props = {"name": rnd.choice(TEXTS), "n": i, "nested": {"features": [{"n": -1, "t": rnd.choice(TEXTS)}]}}
        yield {"type": "Feature", "properties": props, "geometry": rnd.choice([shape, None, {"type": "Point"}])}


PROPS = T.StructType([T.StructField("name", T.StringType()), T.StructField("n", T.LongType())])


def _document(rnd, features, indent):
    doc = {
        "type": "FeatureCollection",
        "crs": {"type": "name", "properties": {"name": "features", "list": [{"n": -2}]}},
        "other": [{"type": "Feature", "properties": {"name": "no", "n": -3}}, [{"n": -4}]],
        "features": features,
        "after": [{"type": "Feature", "properties": {"name": "no", "n": -5}}],
        "end": {"x": {"y": "features"}},
    }
    return json.dumps(doc, indent=indent, ensure_ascii=rnd.random() < 0.5)


@pytest.mark.parametrize("indent", [None])
def test_collections_are_cut_into_features(spark, tmp_path, small_splits, indent):
    rnd = random.Random(small_splits)
    want = []
    for k in range(3):
        features = list(_features(rnd, (9, 0, 5)[k], 100 * k))
        want += [(f["properties"]["name"], f["properties"]["n"]) for f in features]
        (tmp_path / f"f{k}.json").write_text(_document(rnd, features, indent))
    df = io.read_geojson_features(spark, str(tmp_path), PROPS, collection=True, ordinal="ord")
    got = [(r["name"], r["n"]) for r in df.orderBy("ord").collect()]
    assert got == want
    assert splits.pieces(spark, str(tmp_path), "}").rdd.getNumPartitions() > 10
    lines = shared_scratch(spark, "feature_lines")
    io.split_feature_collections(spark, str(tmp_path), lines)
    assert sorted((r["name"], r["n"]) for r in io.read_geojson_features(spark, lines, PROPS).collect()) == sorted(want)


def _batch(parts, **states):
    rows = [("f", b, piece) for b, own in parts for piece in own]
    columns = {"file": [r[0] for r in rows], "block": [r[1] for r in rows], "value": [r[2] for r in rows]}
    return iter([pa.RecordBatch.from_pydict(columns | {k: [v[r[1]] for r in rows] for k, v in states.items()})])


def _cut_anywhere(machine, pieces, size):
    """The three runs over splits of a few bytes, put together in plain Python."""
    blocks, at = {}, 0
    for piece in pieces:
        blocks.setdefault(at // size * size, []).append(piece)
        at += len(piece.encode()) + 1
    parts = sorted(blocks.items())
    lines = isinstance(machine, splits.CsvLines)
    state, deep, inside, depth, flag = 0, 0, {}, {}, {}
    for r in next(splits._maps(machine)(_batch(parts))).to_pylist():
        inside[r["block"]], depth[r["block"]] = state, deep
        deep += (r["d0"], r["d1"])[state]
        state = (r["s0"], r["s1"])[state]
    edges = next(splits._edges(machine)(_batch(parts, inside=inside, depth=depth))).to_pylist()
    known = lines
    for e in edges:
        flag[e["block"]] = known
        known = known if e["end_flag"] is None else e["end_flag"]
    out = [(r["pos"], r["value"]) for b in splits._records(machine, False)(_batch(parts, inside=inside, depth=depth, flag=flag)) for r in b.to_pylist()]
    held = None
    for e in edges:
        if e["tail"] is not None and held:
            held[1].append(e["tail"])
            if e["tail_closes"]:
                out.append((held[0], machine.joint.join(held[1])))
                held = None
        if e["head"] is not None and (flag[e["block"]] if e["head_flag"] is None else e["head_flag"]):
            held = (e["block"] + e["n"], [e["head"]])
    if held and lines:
        out.append((held[0], machine.joint.join(held[1])))
    return [splits.CsvLines.plain(v) for _, v in sorted(out)]


@pytest.mark.parametrize("size", [20, 48, 100, 300])
def test_machines_on_splits_of_any_size(size):
    for seed in range(60):
        rnd = random.Random(seed)
        lines = _csv(rnd, 60).split("\n")[:-1]
        machine = splits.CsvLines()
        whole = [w[0] for kind, *w in machine.run(iter(lines), 0, 0, True) if kind == "record"]
        assert _cut_anywhere(machine, lines, size) == whole
        assert [next(csv.reader([r])) if "\n" not in r else next(csv.reader(StringIO(r, newline=""))) for r in whole] == [
            r for r in csv.reader(StringIO("\n".join(lines) + "\n", newline="")) if r
        ]
        features = list(_features(rnd, 20))
        text = _document(rnd, features, rnd.choice([None, 2]))
        assert [json.loads(t) for t in _cut_anywhere(splits.Features(), text.split("}"), size)] == features


def test_maps_compose(spark):
    """The states from the windows equal a run over the maps one by one."""
    rnd = random.Random(9)
    rows = [(f, b, rnd.randrange(2), rnd.randrange(2), rnd.randrange(-3, 4), rnd.randrange(-3, 4)) for f in "xy" for b in range(0, 400, 10)]
    got = {(r["file"], r["block"]): (r["inside"], r["depth"]) for r in splits.split_states(spark.createDataFrame(rows, splits.MAPS)).collect()}
    for f in "xy":
        state, depth = 0, 0
        for _, b, *m in sorted(r for r in rows if r[0] == f):
            assert got[f, b] == (state, depth)
            depth += m[2 + state]
            state = m[state]


def test_no_piece_is_shuffled(spark, tmp_path):
    (tmp_path / "f.csv").write_text(_csv(random.Random(2), 50))
    plan = splits.csv_records(spark, str(tmp_path), True)._jdf.queryExecution().optimizedPlan().toString()
    # Above the text's scan: the join with the splits' states and the run, and nothing that deals pieces out.
    assert plan.count("MapInArrow") == 1 and "Repartition" not in plan and "Sort" not in plan.split("Window")[0]
