"""Decode checks and sizes."""

import math
import struct
import sys
import types
import zlib
from urllib.parse import unquote

import pytest
from hypothesis import Phase, given, settings
from hypothesis import strategies as st

from pairloom.sources import images
from pairloom.sources.listing import whole_file


def chunk(kind, body):
    return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))


def png(width, height, depth=8, color=2, interlace=0, rows=None):
    bits = depth * {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[color]
    rows = rows if rows is not None else bytes((1 + (width * bits + 7) // 8) * height)
    head = chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, depth, color, 0, 0, interlace))
    data = zlib.compress(rows)
    half = len(data) // 2
    return b"\x89PNG\r\n\x1a\n" + head + chunk(b"IDAT", data[:half]) + chunk(b"IDAT", data[half:]) + chunk(b"IEND", b"")


def jpeg(width, height, end=b"\xff\xd9"):
    frame = b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, height, width, 1) + b"\x01\x11\x00"
    scan = b"\xff\xda" + struct.pack(">HB", 8, 1) + b"\x01\x00\x00\x3f\x00" + b"\x12\x34"
    return b"\xff\xd8\xff\xe0\x00\x04ab" + frame + scan + end


GOOD = png(7, 5)
CASES = {
    "good.png": (GOOD, (7, 5)),
    "gray name.png": (png(9, 2, 1, 0), (9, 2)),
    "interlaced.png": (png(3, 3, interlace=1), (3, 3)),
    "cut.png": (GOOD[:-30], None),
    "no_end.png": (GOOD[:-12], None),
    "flipped.png": (GOOD[:45] + bytes([GOOD[45] ^ 1]) + GOOD[46:], None),
    "few_rows.png": (png(7, 5, rows=b"\0" * 10), None),
    "no_end.jpg": (jpeg(640, 480, b""), None),
    "no_tables.jpg": (jpeg(640, 480), None),
    "text.jpg": (b"not an image", None),
    "empty.png": (b"", None),
}
# Formats that nobody has decoded before the image source does. The first is a JPEG with arithmetic codes, of which nothing else is right.
UNDECODED = {"junk.jpg": jpeg(640, 480).replace(b"\xff\xc0", b"\xff\xc9"), "good.bmp": b"", "good.gif": b"", "torn.gif": b"GIF89a\1"}


@pytest.mark.skipif(images.Image is not None, reason="the built-in checks are used without Pillow only")
def test_checks(spark, tmp_path):
    for name, (data, _) in CASES.items():
        (tmp_path / name).write_bytes(data)
    paths = spark.createDataFrame([(n,) for n in [*CASES, "gone.png"]], "path string")
    located = paths.selectExpr("path", f"{whole_file('path')} AS segments")
    got = {r.path: r for r in images.image_validity(located, str(tmp_path)).collect()}
    for name, (_, size) in CASES.items():
        assert got[name].valid == (size is not None), name
        assert size is None or (got[name].width, got[name].height) == size
    assert got["gone.png"].checked_by == got["empty.png"].checked_by == "missing"
    assert got["text.jpg"].checked_by == "unsupported"
    content = {r.path: r.content for r in images.scan_image_bytes(located, str(tmp_path)).collect()}
    assert bytes(content["good.png"]) == GOOD and content["empty.png"] is None and content["gone.png"] is None


@pytest.mark.skipif(images.Image is not None, reason="the built-in checks are used without Pillow only")
def test_undecoded_images_are_settled_by_the_image_source(spark, tmp_path):
    jvm = spark.sparkContext._jvm
    picture = jvm.java.awt.image.BufferedImage(6, 4, 1)
    for name, data in UNDECODED.items():
        (tmp_path / name).write_bytes(data)
        if not data:
            jvm.javax.imageio.ImageIO.write(picture, name.rpartition(".")[2], jvm.java.io.File(str(tmp_path / name)))
    (tmp_path / "good.png").write_bytes(GOOD)
    (tmp_path / "pack.tar").write_bytes(b"x" * 100)
    located = spark.createDataFrame([(n,) for n in [*UNDECODED, "good.png"]], "path string").selectExpr("path", f"{whole_file('path')} AS segments")
    checked = images.image_validity(located, str(tmp_path))
    first = {r.path: (r.valid, r.checked_by) for r in checked.collect()}
    assert first == dict.fromkeys(UNDECODED, (None, "unchecked")) | {"good.png": (True, "png")}
    got = {r.path: (r.valid, r.checked_by) for r in images.decode_unchecked(spark, checked, str(tmp_path)).collect()}
    good = dict.fromkeys(["good.bmp", "good.gif"], (True, "jvm")) | {"good.png": (True, "png")}
    assert got == good | dict.fromkeys(["junk.jpg", "torn.gif"], (False, "jvm"))


def test_image_source_agrees_on_png(spark, tmp_path):
    for name in ("good.png", "gray name.png", "text.jpg", "empty.png"):
        (tmp_path / name).write_bytes(CASES[name][0])
    got = {r.path.rpartition("/")[2]: (r.valid, r.width, r.height) for r in images.decode_folder(spark, str(tmp_path)).collect()}
    assert got == {"good.png": (True, 7, 5), "gray name.png": (True, 9, 2), "text.jpg": (False, None, None)}


def fitted(w, h, limit):
    """Size that keeps the aspect best, as a search over both roundings."""
    if max(w, h) <= limit:
        return w, h
    exact = limit * min(w, h) / max(w, h)
    options = [n for n in (math.floor(exact), math.ceil(exact))]
    if w >= h:
        near = min(options, key=lambda n: 0 if n == 0 else abs(w / h - limit / n))
        return limit, max(1, near)
    near = min(options, key=lambda n: abs(w / h - n / limit))
    return max(1, near), limit


@settings(max_examples=3, deadline=None, phases=[Phase.generate])
@given(st.lists(st.tuples(st.integers(1, 9000), st.integers(1, 9000)), min_size=300, max_size=300), st.sampled_from([1, 100, 2048]))
def test_fit(spark, sizes, limit):
    sizes += [(5000, 1), (1, 5000), (2048, 2048), (4000, 4000)]
    df = spark.createDataFrame([(i, *s) for i, s in enumerate(sizes)], "i int, w int, h int")
    w, h = images.image_fit("w", "h", limit)
    got = [(r.w, r.h) for r in df.selectExpr("i", f"{w} AS w", f"{h} AS h").orderBy("i").collect()]
    assert got == [fitted(*s, limit) for s in sizes]
    assert images.image_fit("w", "h", 0) == ("w", "h")


def test_reencoding_needs_pillow(monkeypatch):
    monkeypatch.setattr(images, "Image", None)
    with pytest.raises(RuntimeError):
        images.to_jpeg(GOOD, 95, 2048)


def test_reencoding_calls(monkeypatch):
    """With a stand-in for Pillow: RGB, shrunk, saved with the quality asked for."""
    calls = []

    class Picture:
        size = (4000, 10)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            return None

        def convert(self, mode):
            calls.append(mode)
            return self

        def thumbnail(self, size, how):
            calls.append((size, how))

        def save(self, out, kind, quality):
            calls.append((kind, quality))
            out.write(b"jpeg")

    fake = types.SimpleNamespace(open=lambda f: Picture(), Resampling=types.SimpleNamespace(LANCZOS="lanczos"))
    monkeypatch.setattr(images, "Image", fake)
    assert images.to_jpeg(b"x", 95, 2048) == b"jpeg"
    assert calls == ["RGB", ((2048, 2048), "lanczos"), ("JPEG", 95)]
    calls.clear()
    images.to_jpeg(b"x", 80, 0)
    assert calls == ["RGB", ("JPEG", 80)]
    assert "PIL" not in sys.modules


def test_listing_tasks_do_not_grow_with_folders(spark, tmp_path):
    for i in range(150):
        (tmp_path / f"d{i}").mkdir()
        (tmp_path / f"d{i}" / "x.png").write_bytes(b"no image")
    before = spark.conf.get(images.LISTING)
    spark.sparkContext.setJobGroup("listing", "listing")
    found = images.decode_folder(spark, str(tmp_path))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(j).stageIds]
    assert stages and max(s.numTasks for s in stages) <= 4 * spark.sparkContext.defaultParallelism
    assert found.count() == 150 and spark.conf.get(images.LISTING) == before


def test_the_image_source_gets_a_bounded_number_of_files(spark, tmp_path, monkeypatch):
    """The driver holds the listing of a round only; the same files are read as by one listing of all."""
    odd = ["a b+c%20.png", "g[1]*{x}.PNG", "ä#?.jpg", "_x.png", ".x.png", "y._COPYING_", "_metadata.png", "_k=1.png", "empty.png"]
    folders = ["d1", "_hidden/d", ".dot", "_k=2", "_metadata_dir", "w/x/y/z/deep"]
    for folder in folders:
        (tmp_path / folder).mkdir(parents=True)
        for name in [*odd, *(f"{i}.png" for i in range(10))]:
            data = b"" if name == "empty.png" else b"no image" if name == "3.png" else GOOD
            (tmp_path / folder / name).write_bytes(data)
    asked, decoded = [], images._decoded
    monkeypatch.setattr(images, "FILES_AT_ONCE", 8)
    monkeypatch.setattr(images, "_decoded", lambda spark, paths: asked.append(len(paths)) or decoded(spark, paths))
    for names in ("*", "*.{png,jpg}"):
        whole = spark.read.format("image").option("recursiveFileLookup", True).option("pathGlobFilter", names).load(str(tmp_path))
        wanted = sorted((r.image.origin, r.image.height > 0) for r in whole.collect())
        asked.clear()
        got = images.decode_folder(spark, str(tmp_path), names).collect()
        assert sorted((r.path, r.valid) for r in got) == sorted((unquote(o), ok) for o, ok in wanted)
        assert len(asked) > 3 and sum(asked) >= len(wanted) and max(asked) < 30
    (tmp_path / "none").mkdir()
    assert images.decode_folder(spark, str(tmp_path / "none")).collect() == []
