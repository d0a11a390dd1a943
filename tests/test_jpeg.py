"""The walk over JPEG scans, against files that the JVM's own encoder makes."""

import random
import re
import struct
import tarfile
import time

import pytest

from pairloom.plans import inputs
from pairloom.sources import archives, images, jpeg
from pairloom.sources.listing import list_tree

TYPES = {"rgb": 1, "gray": 10}


def encode(spark, path, width, height, kind="rgb", progressive=False, quality=0.8, optimised=False, noise=True, seed=1):
    """A JPEG of random pixels, or of a plain area with some lines, as ImageIO writes it."""
    jvm = spark.sparkContext._jvm
    path.unlink(missing_ok=True)  # the stream would keep what lies behind the new end
    picture = jvm.java.awt.image.BufferedImage(width, height, TYPES[kind])
    pen, rng = picture.createGraphics(), random.Random(seed)
    for _ in range(300 if noise else 3):
        pen.setColor(jvm.java.awt.Color(rng.randrange(1 << 24)))
        pen.drawLine(rng.randrange(width), rng.randrange(height), rng.randrange(width), rng.randrange(height))
    writer = jvm.javax.imageio.ImageIO.getImageWritersByFormatName("jpeg").next()
    how = writer.getDefaultWriteParam()
    mode = jvm.javax.imageio.ImageWriteParam
    how.setCompressionMode(mode.MODE_EXPLICIT)
    how.setCompressionQuality(quality)
    how.setOptimizeHuffmanTables(optimised)
    if progressive:
        how.setProgressiveMode(mode.MODE_DEFAULT)
    out = jvm.javax.imageio.ImageIO.createImageOutputStream(jvm.java.io.File(str(path)))
    writer.setOutput(out)
    writer.write(None, jvm.javax.imageio.IIOImage(picture, None, None), how)
    out.close()
    return path.read_bytes()


def verdict(data):
    try:
        return jpeg.walk(data)
    except jpeg.Broken:
        return None


SHAPES = [(1, 1), (8, 8), (17, 9), (64, 48), (250, 131)]


@pytest.mark.parametrize("progressive", [False, True])
@pytest.mark.parametrize("kind", list(TYPES))
def test_whole_and_cut(spark, tmp_path, kind, progressive):
    for n, (w, h) in enumerate(SHAPES):
        for quality, optimised, noise in ((0.95, False, True), (0.2, True, True), (0.8, True, False)):
            data = encode(spark, tmp_path / "x.jpg", w, h, kind, progressive, quality, optimised, noise, seed=n)
            assert (b"\xff\xc2" in data) == progressive
            assert verdict(data) == (w, h)
            assert verdict(data + b"junk behind the end") == (w, h)
            scan = data.rindex(b"\xff\xda")
            for at in {2, 30, scan, scan + 9, (scan + len(data)) // 2, len(data) - 2}:
                assert verdict(data[:at]) is None, at


def test_scan_that_ends_early(spark, tmp_path):
    """Data is missing before the end marker: tables and markers are all there."""
    for progressive in (False, True):
        data = encode(spark, tmp_path / "x.jpg", 250, 131, progressive=progressive)
        scan = data.rindex(b"\xff\xda") if not progressive else data.index(b"\xff\xda")
        following = re.compile(rb"\xff[\x01-\xcf\xd8-\xfe]").search(data, scan + 2).start()
        gone = (following - scan) // 2
        assert verdict(data[: following - gone] + data[following:]) is None


def test_every_block_counts(spark, tmp_path):
    """The header promises more blocks than the scan has, or fewer."""
    data = encode(spark, tmp_path / "x.jpg", 64, 48)
    at = data.index(b"\xff\xc0") + 5
    taller = data[:at] + struct.pack(">H", 64) + data[at + 2 :]
    shorter = data[:at] + struct.pack(">H", 32) + data[at + 2 :]
    assert verdict(taller) is None
    assert verdict(shorter) == (64, 32)


def test_flipped_bits(spark, tmp_path):
    """Flips in tables and headers break a file, or change its size; flips in a scan do where codes get lost."""
    rng, found = random.Random(4), 0
    for progressive in (False, True):
        data = encode(spark, tmp_path / "x.jpg", 250, 131, progressive=progressive, noise=True)
        scan = data.index(b"\xff\xda") + 14
        for _ in range(60):
            at = rng.randrange(scan, len(data) - 2)
            changed = bytearray(data)
            for k in range(at, min(at + 40, len(data) - 2)):
                changed[k] ^= 0xFE if changed[k] != 0xFF else 0
            found += verdict(bytes(changed)) is None
        tables = data.index(b"\xff\xc4") + 6
        assert verdict(data[:tables] + b"\x09" + data[tables + 1 :]) is None
        assert verdict(data.replace(b"\xff\xdb", b"\xff\xfe")) is None
    assert found > 30


def test_kinds_that_are_not_walked(spark, tmp_path):
    data = encode(spark, tmp_path / "x.jpg", 16, 16)
    for frame in (0xC3, 0xC9, 0xCA, 0xC5):
        other = data.replace(b"\xff\xc0", bytes([0xFF, frame]), 1)
        with pytest.raises(jpeg.NotWalked):
            jpeg.walk(other)
        if images.Image is None:
            assert images.image_size(other) == (None, images.UNCHECKED)
    at = data.index(b"\xff\xc0") + 5
    with pytest.raises(jpeg.NotWalked):
        jpeg.walk(data[:at] + b"\0\0" + data[at + 2 :])
    assert verdict(data[:at] + b"\xff\xff\xff\xff" + data[at + 4 :]) is None
    for junk in (b"\xff\xd8", b"\xff\xd8\xff\xd9", b"\xff\xd8\xff", b"\xff\xd8\xff\xda\x00\x02\xff\xd9", b"\xff\xd8" + b"\0" * 50):
        assert verdict(junk) is None


def test_restart_markers():
    """Files with restart markers: every interval must hold its units, in order."""
    levels = bytes(range(1, 200))
    for interval in (1, 3, 8, 1000):
        data = inputs.gray_jpeg(90, 70, levels, interval)
        assert verdict(data) == (90, 70)
        marks = [m.start() for m in re.finditer(rb"\xff[\xd0-\xd7]", data)]
        assert len(marks) == max(0, -(-12 * 9 // interval) - 1)
        if len(marks) > 1:
            assert verdict(data[: marks[0]] + data[marks[1] :]) is None
            assert verdict(data[: marks[0] + 1] + b"\xd3" + data[marks[0] + 2 :]) is None


def test_encoder_of_the_inputs_is_read_by_the_jvm(spark, tmp_path):
    for n, (w, h) in enumerate([(1, 1), (9, 70), (400, 33)]):
        (tmp_path / f"{n}.jpg").write_bytes(inputs.gray_jpeg(w, h, b"some text \xff\x00\x80" * 9, 5))
    got = {(r.width, r.height) for r in images.decode_folder(spark, str(tmp_path)).collect() if r.valid}
    assert got == {(1, 1), (9, 70), (400, 33)}


@pytest.mark.skipif(images.Image is not None, reason="the built-in checks are used without Pillow only")
def test_members_of_archives_get_verdicts(spark, tmp_path):
    whole = encode(spark, tmp_path / "x.jpg", 40, 30)
    progressive = encode(spark, tmp_path / "x.jpg", 41, 30, progressive=True)
    (tmp_path / "x.jpg").unlink()
    members = {"whole.jpg": whole, "progressive.jpg": progressive, "cut.jpg": whole[:-40], "torn.jpg": progressive[:-60] + b"\xff\xd9", "text.jpg": b"text"}
    with tarfile.open(tmp_path / "pack.tar", "w") as tar:
        for name, data in members.items():
            (tmp_path / name).write_bytes(data)
            tar.add(tmp_path / name, name)
            (tmp_path / name).unlink()
    manifest = archives.archive_manifest(archives.index_archives(archives.list_archives(list_tree(spark, str(tmp_path))), str(tmp_path)))
    got = {r.path.rpartition("/")[2]: (r.valid, r.width, r.checked_by) for r in images.image_validity(manifest, str(tmp_path)).collect()}
    assert got == {"whole.jpg": (True, 40, "jpeg"), "progressive.jpg": (True, 41, "jpeg"), "cut.jpg": (False, None, "jpeg"), "torn.jpg": (False, None, "jpeg"), "text.jpg": (False, None, "unsupported")}


def test_encoder_and_walk_take_time_in_proportion():
    """Of a long text the encoder of the inputs took the square of its length."""

    def seconds(n):
        start = time.perf_counter()
        data = inputs.gray_jpeg(8 * 400, 8 * (n // 400), bytes(range(256)))
        return time.perf_counter() - start, data

    seconds(4000)
    short, long = (min((seconds(n) for _ in range(3)), key=lambda x: x[0]) for n in (20_000, 320_000))
    assert long[0] < 50 * short[0]
    assert jpeg.walk(long[1]) == (3200, 6400)


@pytest.mark.parametrize("interval", [0, 7])
def test_jumps_over_blocks_change_no_verdict(monkeypatch, interval):
    whole = inputs.gray_jpeg(90, 70, bytes(range(0, 250, 7)), interval)
    at = whole.index(b"\xff\xda") + 10
    torn = [whole[:n] for n in range(at, len(whole))] + [whole[:n] + whole[-2:] for n in range(at, len(whole), 3)]
    torn += [whole[:i] + bytes([whole[i] ^ 1 << b]) + whole[i + 1 :] for i in range(at, len(whole)) for b in (0, 5)]

    def verdicts():
        found = []
        for data in [whole, *torn]:
            try:
                found.append(jpeg.walk(data))
            except jpeg.Broken:
                found.append(None)
        return found

    plain = verdicts()  # too few blocks for a table of jumps
    monkeypatch.setattr(jpeg, "JUMP_BLOCKS", 1)
    assert verdicts() == plain and plain[0] == (90, 70) and None in plain
