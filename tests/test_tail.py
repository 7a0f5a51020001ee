"""A single growing file as a stream: every line once, over restarts."""

import random

import pytest

from cobble.session import shared_scratch
from cobble.sources import tail


def _run(spark, path, out, ckpt, part_bytes=50):
    df = spark.readStream.format("cobble_tail").option("path", path).option("partBytes", str(part_bytes)).load()
    q = df.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    q.awaitTermination()
    return [r["value"] for r in spark.read.schema("value string, at bigint").parquet(out).orderBy("at").collect()]


def test_restart_goes_on_from_the_offset(spark, tmp_path):
    tail.register_tail(spark)
    path, out, ckpt = str(tmp_path / "feed.txt"), shared_scratch(spark, "tail-out"), shared_scratch(spark, "tail-ckpt")
    rnd = random.Random(2)
    lines = ["x" * rnd.randrange(0, 90) + f" é {i}" for i in range(200)]
    whole = "".join(x + "\n" for x in lines).encode()
    at = 0
    # Cut anywhere, also inside a line or a character: what lacks its end waits.
    for end in (0, 37, 38, 3000, 3000, 7001, len(whole) - 1, len(whole)):
        with open(path, "ab") as f:
            f.write(whole[at:end])
        at = end
        done = whole[:end].count(b"\n")
        assert _run(spark, path, out, ckpt) == lines[:done]
    # The stored offset is the end of the last whole line; nothing is read twice.
    assert spark.read.parquet(out).count() == len(lines)


@pytest.mark.parametrize("read", [1, 7, 1 << 20])
def test_parts_give_every_line_once(tmp_path, monkeypatch, read):
    monkeypatch.setattr(tail, "READ_BYTES", read)
    rnd = random.Random(read)
    path = str(tmp_path / "f.txt")
    data = b"".join(b"y" * rnd.choice([0, 0, 1, 5, 60]) + b"\n" for _ in range(120)) + b"no end"
    with open(path, "wb") as f:
        f.write(data)
    end = tail.last_line_end(path, 0)
    assert end == len(data) - 6
    for size in (1, 3, 17, 1000):
        parts = tail.TailReader(path, size).partitions({"at": 0}, {"at": end})
        got = [row for p in parts for row in tail.lines_between(path, p.start, p.end)]
        assert [x for _, x in got] == data[:end].split(b"\n")[:-1]
        assert [a for a, _ in got] == [0, *[i + 1 for i, c in enumerate(data[: end - 1]) if c == 10]]


def test_a_file_that_shrinks_is_an_error(tmp_path):
    path = tmp_path / "f.txt"
    path.write_text("a\nb\n")
    assert tail.last_line_end(str(path), 2) == 4
    path.write_text("a\n")
    with pytest.raises(ValueError):
        tail.last_line_end(str(path), 4)
