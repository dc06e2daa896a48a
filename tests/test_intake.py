"""SRC9: workbooks verified member by member, as streams."""

import os
import random
import tracemalloc
import zipfile

from ledgerspark.sources import landing


def _zip(path, members, zip64=False):
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for name, data in members:
            with zf.open(name, "w", force_zip64=zip64) as f:
                f.write(data)


def _spoil_last_byte(path, name):
    """Flip the last stored byte of one member."""
    with zipfile.ZipFile(path) as zf:
        m = zf.getinfo(name)
        at = m.header_offset + 30 + len(name) + m.compress_size
        with open(path, "rb") as f:
            f.seek(m.header_offset + 28)
            at += int.from_bytes(f.read(2), "little")
    with open(path, "r+b") as f:
        f.seek(at - 1)
        b = f.read(1)
        f.seek(at - 1)
        f.write(bytes([b[0] ^ 0xFF]))


def test_every_member_is_verified_over_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(landing, "UNIT_BYTES", 6000)
    r = random.Random(1)
    members = [(f"xl/part{i}.xml", r.randbytes(5000)) for i in range(7)]
    d = str(tmp_path)
    _zip(f"{d}/good.xlsx", members)
    _zip(f"{d}/zip64.xlsx", members, zip64=True)
    for k, name in (("late", "xl/part6.xml"), ("early", "xl/part1.xml")):
        _zip(f"{d}/{k}.xlsx", members)
        _spoil_last_byte(f"{d}/{k}.xlsx", name)
    _zip(f"{d}/both.xlsx", members)
    for name in ("xl/part5.xml", "xl/part2.xml"):
        _spoil_last_byte(f"{d}/both.xlsx", name)
    _zip(f"{d}/small.xlsx", members[:1])
    with open(f"{d}/cut.xlsx", "wb") as f, open(f"{d}/good.xlsx", "rb") as g:
        f.write(g.read()[:20_000])
    with open(f"{d}/text.xlsx", "w") as f:
        f.write("x" * 20_000)
    _zip(f"{d}/half.xlsx.crdownload", members)
    assert len(list(landing._units(f"{d}/good.xlsx", os.path.getsize(f"{d}/good.xlsx")))) == 4
    got = {os.path.basename(x.path): (x.ok, x.reason) for x in landing.intake_check(spark, d).collect()}
    assert got == {"good.xlsx": (True, "ok"), "zip64.xlsx": (True, "ok"), "late.xlsx": (False, "bad_crc:xl/part6.xml"),
                   "early.xlsx": (False, "bad_crc:xl/part1.xml"), "both.xlsx": (False, "bad_crc:xl/part2.xml"),
                   "small.xlsx": (False, "too_small"), "cut.xlsx": (False, "bad_zip"), "text.xlsx": (False, "not_zip")}
    assert landing.intake_check(spark, f"{d}/absent").collect() == []


def test_memory_does_not_grow_with_a_member(tmp_path):
    path = str(tmp_path / "large.xlsx")
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf, zf.open("xl/sheet.xml", "w", force_zip64=True) as f:
        for _ in range(300):
            f.write(bytes(1 << 20))
    tracemalloc.start()
    assert landing._verify(path, 0, 1) == (1, "ok")
    assert tracemalloc.get_traced_memory()[1] < 16 << 20
    tracemalloc.stop()
