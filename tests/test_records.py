"""SRC3: records over several lines, from splits of any size, against Python's csv reader."""

import csv
import io
import random

import pytest

from ledgerspark.sources import exports, records


def _states(data):
    """The automaton byte by byte: the definition that ``walk`` must keep to."""
    def step(state, b):
        if state == records.QUOTED:
            return records.AFTER_QUOTE if b == 34 else records.QUOTED
        if state == records.AFTER_QUOTE and b == 34:
            return records.QUOTED
        if b in b",\r\n":
            return records.FIELD_START
        return records.QUOTED if state == records.FIELD_START and b == 34 else records.PLAIN

    def run(state):
        ends = []
        for i, b in enumerate(data):
            state = step(state, b)
            if b == 10 and state != records.QUOTED:
                ends.append(i)
        return ends, state

    return [run(s) for s in range(4)]


def test_walk_is_the_automaton():
    r = random.Random(1)
    for _ in range(3000):
        data = bytes(r.choices(b'a,"\n\r', k=r.randrange(14)))
        for state, (ends, after) in enumerate(_states(data)):
            got, to = records.walk(data, state)
            assert (got.tolist(), to) == (ends, after), (data, state)


def _file(rng, rows, mark):
    out = io.StringIO()
    w = csv.writer(out, lineterminator=rng.choice(["\n", "\r\n"]))
    w.writerow(["Documento", "Dev\nedor", "Unique ID"])
    for i in range(rows):
        w.writerow([str(i), "".join(rng.choices('ab ,"\né', k=rng.randrange(12))) + "x", f"U{i}"])
    return (b"\xef\xbb\xbf" if mark else b"") + out.getvalue().encode()


@pytest.mark.parametrize("size", [3, 64, 1000, 1 << 20])
def test_records_from_splits(spark, tmp_path, size):
    rng = random.Random(size)
    want = {}
    for k in range(3):
        data = _file(rng, 60, k == 1)
        path = tmp_path / f"part {k}%.csv"
        path.write_bytes(data)
        want[k] = list(csv.reader(io.StringIO(data.decode("utf-8-sig"), newline="")))[1:]
    listing = spark.read.format("binaryFile").load(str(tmp_path)).select("path", "length")
    if size == 3:
        listing = listing.where("path like '%part 0%'")
    got = records.records(listing, split_bytes=size).collect()
    for k in (range(1) if size == 3 else range(3)):
        mine = sorted((r.pos, r.value) for r in got if f"part {k}" in r.path)
        assert [next(csv.reader(io.StringIO(v, newline=""))) for _, v in mine] == want[k]
    if size < 1000:
        assert len({(r.path, r.block) for r in got}) > 3  # one file over several tasks


def test_scan_reads_line_breaks_by_default(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(records, "SPLIT_BYTES", 32)
    a, b = str(tmp_path / "a b.csv"), str(tmp_path / "b.csv")
    with open(a, "w", newline="") as f:
        f.write('Documento,Devedor,Unique ID\n1,"An""a\r\nMaria, x",U1\n2,5" pipe,\n\n3,"",nan\n4\n')
    with open(b, "w") as f:
        f.write("Unique ID,Documento,Devedor\nU9,9,plain\n")
    got = exports.scan_csv(spark, [a, b]).orderBy("documento").collect()
    assert [(r.documento, r.devedor, r.unique_id) for r in got] == [
        ("1", 'An"a\r\nMaria, x', "U1"), ("2", '5" pipe', None), ("3", None, None), ("4", None, None), ("9", "plain", "U9")]
    order = [r.documento for r in sorted(got[:4], key=lambda r: (r._file, r._block, r._pos))]
    assert order == ["1", "2", "3", "4"]
    with pytest.raises(Exception, match="quote left open"):
        exports.scan_csv(spark, [a], multi_line=False).collect()
    wide, cut = str(tmp_path / "wide.csv"), str(tmp_path / "cut.csv")
    with open(wide, "w") as f:
        f.write('Documento,Devedor\n1,"a\nb"\n2,"x\ny",z\n')
    with pytest.raises(Exception, match="more than the header's 2 cells"):
        exports.scan_csv(spark, [wide]).collect()
    with open(cut, "w") as f:
        f.write('Documento,Devedor\n1,"a\nb\n2,x\n')
    with pytest.raises(Exception, match="left open at the end"):
        exports.scan_csv(spark, [cut]).collect()
