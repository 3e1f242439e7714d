"""Zip and gzip files on disk: what is unpacked, what is lost to a cut, and how much is held at a time."""

import gzip
import json
import random
import tracemalloc
import zipfile
import zlib

import pytest

from sparkwell.sources import archives, readers


def unpacked(found):
    """path -> (complete, lines in order), and the count that the row of the file gives."""
    rows = found.collect()
    lines = {}
    for r in sorted((r for r in rows if r.complete is None), key=lambda r: r.line_no):
        lines.setdefault(r.path, []).append(r.line)
        assert r.line_no == len(lines[r.path])
    ends = {r.path: (r.complete, r.line_no) for r in rows if r.complete is not None}
    assert all(n == len(lines.get(p, [])) for p, (_, n) in ends.items())
    return {p: (complete, lines.get(p, [])) for p, (complete, _) in ends.items()}


def test_zip_and_gzip_files(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "1.events.csv.zip", "w") as z:
        z.writestr("1.events.csv", 'event_id,name\n1,"a, b"\n2,c\n')
    rows = archives.unzip_csv(archives.read_binary(spark, str(tmp_path), "*.zip"), ["event_id", "name"])
    assert sorted(map(tuple, rows.drop("path").collect())) == [("1", "a, b"), ("2", "c")]
    body = [f"{random.random()}" for _ in range(500)]
    whole = gzip.compress("".join(f"{x}\n" for x in body).encode())
    (tmp_path / "2024-01-01-5.json.gz").write_bytes(whole)
    (tmp_path / "2024-01-01-6.json.gz").write_bytes(whole[: int(len(whole) * 0.7)])
    (tmp_path / "2024-01-01-7.json.gz").write_bytes(b"")
    found = {p[-9]: x for p, x in unpacked(archives.gunzip_lines(archives.read_binary(spark, str(tmp_path), "*.gz"))).items()}
    assert found["5"] == (True, body)
    complete, lines = found["6"]
    assert not complete and 0 < len(lines) < 500 and lines == body[: len(lines)]
    assert "7" not in found  # the reader lists no empty files; the manifest tells


def test_members_padding_and_damage(spark):
    two = gzip.compress(b"a\nb\n") + gzip.compress(b"c\nd")
    broken = gzip.compress(b"a\nb\n")[:-8] + bytes([1]) * 8
    rows = [("two", two), ("broken", broken), ("padded", two + bytes(9)), ("tail", two + b"x"), ("none", gzip.compress(b""))]
    found = unpacked(archives.gunzip_lines(spark.createDataFrame(rows, "path STRING, content BINARY")))
    assert found["two"] == found["padded"] == (True, ["a", "b", "c", "d"])
    assert found["broken"] == (False, ["a", "b"])
    assert found["tail"] == (False, ["a", "b", "c"])  # the last line has no end of its own
    assert found["none"] == (True, [])


def test_delivered_files_are_the_published_ones(spark, folder):
    names = {"a b=1.zip": bytes(range(256)) * 5, "c": b"\r\n\xff", "d": b""}
    rows = [(n, bytearray(c)) for n, c in names.items()]
    archives.publish(spark.createDataFrame(rows, "path STRING, content BINARY"), folder)
    found = {r.path: bytes(r.content) for r in archives.delivered(spark, folder).collect()}
    assert found == {n: c + b"\0" for n, c in names.items()}


@pytest.mark.parametrize("cut", [0, 1, 9, 5000])
def test_what_is_held_does_not_grow_with_the_file(cut):
    """128 MB that pack into 128 kB: parts and lines are handed on as they come."""
    packer = zlib.compressobj(9, zlib.DEFLATED, 31)
    block = (b"x" * 99 + b"\n") * 10_000
    content = b"".join(packer.compress(block) for _ in range(128)) + packer.flush()
    content = content[: len(content) - cut]
    tracemalloc.start()
    lines = complete = 0
    for part in archives.whole_lines(content):
        if isinstance(part, bool):
            complete = part
        else:
            lines += len(part)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20
    assert complete == (cut == 0) and (lines == 1_280_000) == (cut < 9) and lines > 1_200_000


def test_a_line_longer_than_many_parts():
    line = random.Random(1).randbytes(3 << 20).replace(b"\n", b" ")
    parts = list(archives.whole_lines(gzip.compress(line + b"\nend")))
    assert parts == [[line], [b"end"], True]


def test_files_of_orders(spark, tmp_path):
    good = {"id": 1, "customer_id": 2, "amount": 3.5, "status": "pending"}
    bad = good | {"status": "lost"}
    for name, text in {"a": json.dumps([good, bad]), "b": json.dumps(good, indent=2), "c": "[]", "d": json.dumps([good, good])[:-9], "e": "x"}.items():
        (tmp_path / f"name={name}").mkdir()
        (tmp_path / f"name={name}" / "part-0.txt").write_text(text)
    rows = readers.read_order_files(spark, str(tmp_path)).collect()
    assert sorted((r.id, r.reasons) for r in rows if not r.unreadable) == [(1, []), (1, []), (1, ["status"])]
    assert [r.id for r in rows if r.unreadable] == [None, None]
