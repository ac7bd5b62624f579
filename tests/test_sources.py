"""Readers and writers on small synthetic files."""

import json
import os
import struct
import zipfile

import numpy as np
import pytest

from isarithm.operators import mesh, tree
from isarithm.sources import files, gltf, las, obj

OBJ = """# two buildings
f 1 2 3
usemtl Box
v 0 0 0
v 10 0 0
v 10 10 0
v 0 10 0
f 1/1 2/2 3/3 4/4
usemtl Roof
v 0 0 5
v 4 0 5
v 2 3 8
f 5 6 7
usemtl Empty
"""


def test_obj_blocks(spark, tmp_path):
    (tmp_path / "a.obj").write_text(OBJ)
    vertices, faces = obj.read_obj(spark, str(tmp_path / "a.obj"), (1000.0, 2000.0, 0.0))
    rows = sorted((r["name"], r["a"], r["b"], r["c"]) for r in faces.collect())
    assert rows == [("Box", 0, 1, 2), ("Box", 0, 2, 3), ("Roof", 4, 5, 6)]
    got = {(r["name"], r["vid"]): (r["x"], r["y"], r["z"]) for r in vertices.collect()}
    assert got[("Box", 2)] == (1010.0, 2010.0, 0.0) and len(got) == 7
    centre = {r["name"]: (r["x"], r["y"]) for r in mesh.centroids(faces, vertices, ["name"]).collect()}
    assert centre["Box"] == (1005.0, 2005.0)


def test_offsets(spark, tmp_path):
    (tmp_path / "m.fwt").write_text("1 0 0 654513.288\n0 1 0 6475676.235\n0 0 1 62.645\n")
    (tmp_path / "n.fwt").write_text("1.5 -2\n3\n")
    (tmp_path / "bad.fwt").write_text("1 2\n")
    got = {os.path.basename(r["file"]): tuple(r)[1:] for r in obj.read_offset(spark, str(tmp_path)).collect()}
    assert got == {"m.fwt": (654513.288, 6475676.235, 62.645), "n.fwt": (1.5, -2.0, 3.0), "bad.fwt": (None, None, None)}


def test_las_ranges(spark, tmp_path):
    rng = np.random.default_rng(0)
    x, y, z = rng.uniform(657000, 657020, 25), rng.uniform(6477000, 6477020, 25), rng.uniform(0, 40, 25)
    kind, rgb = rng.integers(1, 19, 25), rng.integers(0, 256, (25, 3))
    path = str(tmp_path / "a.las")
    las.write_las(path, x, y, z, kind, rgb)
    spark.dataSource.register(las.LasSource)
    df = spark.read.format("las").option("files", path).option("points", "10").load()
    assert df.rdd.getNumPartitions() == 3
    rows = df.orderBy("point_ord").collect()
    assert np.allclose([r["x"] for r in rows], x, atol=1e-3) and np.allclose([r["z"] for r in rows], z, atol=1e-3)
    assert [r["classification"] for r in rows] == kind.tolist() and [r["green"] for r in rows] == rgb[:, 1].tolist()
    with pytest.raises(ValueError):
        las.header(b"nope" + bytes(400))


def test_gltf_roundtrip(spark, tmp_path):
    p = np.array([[0, 0, 0], [1, 0, 0], [0, 2, 0], [1, 2, 3]], float)
    f = np.array([[0, 1, 2], [1, 3, 2]])
    path = str(tmp_path / "m.glb")
    size = gltf.write_glb(path, {"ground-col": (p, np.zeros((4, 2)), f), "b": (p + 5, np.zeros((0, 2)), f[:1])})
    row = gltf.stats(gltf.documents(spark, path)).first()
    assert (row["size_bytes"], row["nodes"], row["meshes"], row["triangles"], row["vertices"]) == (size, 2, 2, 3, 8)
    assert row["bounds_min"] == [0, 0, 0] and row["bounds_max"] == [6, 7, 8] and row["suffixes"] == {"-col": 1}
    raw = open(path, "rb").read()
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "t_L16_1.b3dm").write_bytes(struct.pack("<4sIIIIII", b"b3dm", 1, 0, 0, 0, 0, 0) + raw)
    got = gltf.meshes(spark, str(tmp_path / "t")).orderBy("mesh").collect()
    assert [len(r["faces"]) for r in got] == [1, 2] and got[1]["uv"][0] == [0, 1] and np.allclose(got[0]["positions"], p + 5)


def test_tile_tree_with_links(spark, tmp_path):
    root = tmp_path / "site" / "BlockA"
    root.mkdir(parents=True)
    leaf = lambda n: {"geometricError": 0.1, "content": {"uri": f"{n}.b3dm"}}
    (root / "tileset.json").write_text(json.dumps({"root": {"geometricError": 2.0, "content": {"uri": "a_L15_1.b3dm"}, "children": [{"geometricError": 1e10, "content": {"uri": "sub.json"}}, leaf("a_L16_2")]}}))
    (root / "sub.json").write_text(json.dumps({"root": {"geometricError": 0.5, "content": {"uri": "a_L16_1.b3dm"}, "children": [leaf("a_L17_1"), leaf("a_L17_2")]}}))
    nodes = files.tile_nodes(spark, str(tmp_path / "site"))
    assert nodes.count() == 5 and nodes.where("parent IS NULL").count() == 1
    cut = lambda e: tree.tree_cut(nodes, e).count()
    assert (cut(2.0), cut(0.5), cut(0.1), cut(0)) == (1, 2, 3, 3)


def test_zip_listing_and_reports(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("deep/one.obj", "v 1 2 3")
        z.writestr("two.txt", "no")
    got = files.zipped(spark, str(tmp_path / "a.zip"), (".obj",)).collect()
    assert [(r["name"], bytes(r["content"])) for r in got] == [("one.obj", b"v 1 2 3")]
    (tmp_path / "p").mkdir()
    for n in ("b.jpg", "a.PNG", "c.gif"):
        (tmp_path / "p" / n).write_bytes(b"x")
    assert files.numbered(files.listing(spark, str(tmp_path / "p"))).count() == 2
    (tmp_path / "r").mkdir()
    (tmp_path / "r" / "good.json").write_text(json.dumps({"map": "m", "glb": {"triangles": 5}}))
    (tmp_path / "r" / "bad.json").write_text("{nope")
    assert sorted((r["map"] or "", r["triangles"] or 0) for r in files.reports(spark, str(tmp_path / "r")).collect()) == [("", 0), ("m", 5)]


def test_tiff(spark, tmp_path):
    a = np.arange(12, dtype="<f4").reshape(3, 4)
    tags = [(256, 3, 4), (257, 3, 3), (258, 3, 32), (259, 3, 1), (273, 4, 200), (277, 3, 1), (278, 3, 3), (279, 4, a.nbytes), (339, 3, 3)]
    raw = b"II*\0" + struct.pack("<I", 8) + struct.pack("<H", len(tags)) + b"".join(struct.pack("<HHII", t, k, 1, v) for t, k, v in tags)
    (tmp_path / "a.tif").write_bytes(raw.ljust(200, b"\0") + a.tobytes())
    cells = files.raster_cells(files.read_tiff(spark, str(tmp_path / "a.tif")), nodata=5.0)
    assert cells.count() == 11 and cells.agg({"h": "sum"}).first()[0] == 61.0


CONFIG = """
[map]
name = "old-town"
[area]
bbox = [662000, 6473000, 663000, 6474000]
[buildings]
municipalities = ["t"]
[course]
size_m = 4.0
[[course.gate]]
at = [662100, 6473100]
"""


def test_config(spark):
    c = files.load_config(spark, CONFIG)
    assert c["origin"] == (662500.0, 6473500.0) and not c["lidar"]["enabled"] and c["terrain"]["step_m"] == 2.0
    assert files.gates(spark, c).first()["size_m"] == 4.0
    for bad in (CONFIG.replace("old-town", "old town"), CONFIG.replace('["t"]', "[]"), CONFIG + "[lidar]\nres_m = 0.0\n", CONFIG + "[facades]\nlevel = 7\n"):
        with pytest.raises(ValueError):
            files.load_config(spark, bad)
    centred = files.load_config(spark, CONFIG.replace("bbox = [662000, 6473000, 663000, 6474000]", "center_wgs84 = [58.3747, 26.7726]\nsize_m = [1000, 500]"))
    assert abs(centred["origin"][0] - 662180.6) < 0.5


def test_photo_records(spark):
    html = "x pilt('1','img_a',1) y pilt('2','img_b',0)"
    df = spark.createDataFrame([(7, html), (8, "")], "page int, html string")
    got = files.photo_records(df, "html", r"pilt\('(\d+)','([^']+)',(\d)\)", ["id", "image", "tiled"]).collect()
    assert sorted(map(tuple, got)) == [(7, "1", "img_a", "1"), (7, "2", "img_b", "0")]
