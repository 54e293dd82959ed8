import struct
import zlib

import numpy as np
import pytest

from terravane.sources import raster


def tiff(values, order="<", compress=False, tile=None, predictor=1, blank=None, bands=1):
    """A GeoTIFF of an array; its corner lies at (10, 50), cells are half a degree."""
    height, width = values.shape
    across, down = tile or (width, 2)
    blocks = []
    for top in range(0, height, down):
        for left in range(0, width, across):
            rows = down if tile else min(down, height - top)
            block = np.zeros((rows, across, bands), values.dtype)
            part = values[top : top + rows, left : left + across]
            block[: part.shape[0], : part.shape[1], 0] = part
            if predictor == 2:
                block[:, 1:] = block[:, 1:] - block[:, :-1]
            raw = block.astype(values.dtype.newbyteorder(order)).tobytes()
            blocks.append(zlib.compress(raw) if compress else raw)
    kind = {"u": 1, "i": 2, "f": 3}[values.dtype.kind]
    tags = [(256, "I", [width]), (257, "I", [height]), (258, "H", [values.dtype.itemsize * 8] * bands), (259, "H", [8 if compress else 1]), (277, "H", [bands]), (317, "H", [predictor]), (339, "H", [kind] * bands), (33550, "d", [0.5, 0.5, 0]), (33922, "d", [0, 0, 0, 10, 50, 0])]
    if blank is not None:
        tags.append((42113, "s", [blank.encode() + b"\0"]))
    place = 8 + sum(map(len, blocks))
    starts = np.cumsum([8, *map(len, blocks)])[:-1].tolist()
    names = (324, 325) if tile else (273, 279)
    tags += [(names[0], "I", starts), (names[1], "I", [len(b) for b in blocks])]
    tags += [(322, "I", [across]), (323, "I", [down])] if tile else [(278, "I", [down])]
    tags.sort()
    entries, more, at = b"", b"", place + 2 + 12 * len(tags) + 4
    for tag, code, xs in tags:
        raw = xs[0] if code == "s" else struct.pack(order + code * len(xs), *xs)
        n = len(raw) if code == "s" else len(xs)
        field = raw.ljust(4, b"\0") if len(raw) <= 4 else struct.pack(order + "I", at + len(more))
        more += raw if len(raw) > 4 else b""
        entries += struct.pack(order + "HHI", tag, {"s": 2, "H": 3, "I": 4, "d": 12}[code], n) + field
    return {"<": b"II", ">": b"MM"}[order] + struct.pack(order + "HI", 42, place) + b"".join(blocks) + struct.pack(order + "H", len(tags)) + entries + b"\0" * 4 + more


@pytest.mark.parametrize("order", "<>")
@pytest.mark.parametrize("compress", [False, True])
@pytest.mark.parametrize("tile", [None, (4, 4)])
@pytest.mark.parametrize("kind,predictor", [("u1", 1), ("i2", 2), ("f4", 1), ("f8", 1), ("u4", 2)])
def test_forms(order, compress, tile, kind, predictor):
    values = (np.arange(35).reshape(5, 7) % 11).astype(kind)
    r = raster.decode(tiff(values, order, compress, tile, predictor, "3", bands=2))
    assert np.array_equal(r.values.data, values) and np.array_equal(r.values.mask, values == 3)
    assert (r.x, r.y, r.dx, r.dy) == (10, 50, 0.5, 0.5)


def test_faults():
    with pytest.raises(ValueError, match="not a TIFF"):
        raster.decode(b"GIF89a")


def test_zones(spark, tmp_path):
    values = np.array([[1, 2, -9, 4], [5, np.nan, 7, -1]], "f4")
    (tmp_path / "a.tif").write_bytes(tiff(values, compress=True, blank="-9"))
    cells = raster.read_raster(spark, str(tmp_path / "a.tif"))
    assert sorted((r.x, r.y, r.value) for r in cells.collect()) == [(10.25, 49.25, 5), (10.25, 49.75, 1), (10.75, 49.75, 2), (11.25, 49.25, 7), (11.75, 49.25, -1), (11.75, 49.75, 4)]
    box = lambda a, b, c, d: [(a, b), (c, b), (c, d), (a, d), (a, b)]
    zones = spark.createDataFrame([("w", box(10.0, 49.0, 11.0, 50.0)), ("e", box(11.0, 49.0, 12.0, 50.0)), ("n", box(0.0, 0.0, 1.0, 1.0))], "id string, ring array<struct<x:double,y:double>>")
    found = {r.id: (r.total, r.n, [t.value for t in r.top]) for r in raster.zonal_sums(cells, zones, 1.0, 2).collect()}
    assert found == {"w": (8, 3, [5, 2]), "e": (11, 3, [7, 4])}
