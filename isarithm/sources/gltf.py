"""glTF binaries and b3dm tiles: statistics, meshes, and a writer."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the formats.
MAGIC, JSON_CHUNK, BIN_CHUNK = 0x46546C67, 0x4E4F534A, 0x004E4942
COMPONENT = {5121: "u1", 5123: "<u2", 5125: "<u4", 5126: "<f4"}
WIDTH = {"SCALAR": 1, "VEC2": 2, "VEC3": 3, "VEC4": 4}
SUFFIXES = ("-col", "-colonly", "-convcol", "-navmesh", "-rigid", "-noimp", "-occ")

_ACCESSOR = "struct<count: bigint, min: array<double>, max: array<double>>"
_PRIMITIVE = "struct<attributes: struct<POSITION: int>, indices: int>"
DOCUMENT = (
    f"asset struct<generator: string>, accessors array<{_ACCESSOR}>, meshes array<struct<name: string, primitives: array<{_PRIMITIVE}>>>, nodes array<struct<name: string>>, "
    "materials array<struct<name: string>>, images array<struct<bufferView: int, mimeType: string>>, bufferViews array<struct<byteLength: bigint>>"
)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """(path, size_bytes, js): the parsed JSON chunk of every binary under a path; other files give null."""
    raw = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size_bytes"), "content")
    size = F.expr("cast(conv(concat(hex(substring(content, 16, 1)), hex(substring(content, 15, 1)), hex(substring(content, 14, 1)), hex(substring(content, 13, 1))), 16, 10) as int)")
    ok = F.expr("hex(substring(content, 1, 4)) = '676C5446'")
    text = F.when(ok, F.decode(F.substr("content", F.lit(21), size), "utf-8"))
    return raw.select("path", "size_bytes", F.from_json(text, DOCUMENT).alias("js"))


def stats(docs: DataFrame) -> DataFrame:
    """One row of counts per file: nodes, meshes, triangles, vertices, bounds, images, suffixes, mime types."""
    none = lambda c, kind: F.coalesce(c, F.array().cast(kind))
    accessors = F.col("js.accessors")
    prims = none(F.flatten(F.transform("js.meshes", lambda m: m["primitives"])), f"array<{_PRIMITIVE}>")
    rows = docs.select("*", prims.alias("_p"), accessors.alias("_a"), F.transform(none(F.col("js.nodes"), "array<struct<name: string>>"), lambda n: F.coalesce(n["name"], F.lit(""))).alias("_n"), none(F.col("js.images"), "array<struct<bufferView: int, mimeType: string>>").alias("_i"))
    at = lambda k: F.get(F.col("_a"), k)
    total = lambda f: F.aggregate(F.transform("_p", f), F.lit(0).cast("long"), lambda s, v: s + v)
    position = lambda p: at(p["attributes"]["POSITION"])
    triangles = total(lambda p: F.floor(F.coalesce(at(p["indices"])["count"], position(p)["count"]) / 3))
    corner = lambda end, pick: F.when(F.size("_p") > 0, F.transform(F.sequence(F.lit(0), F.lit(2)), lambda k: pick(F.transform("_p", lambda p: F.get(position(p)[end], k)))))
    counted = lambda keys: F.map_from_entries(F.transform(F.array_sort(F.array_distinct(keys)), lambda k: F.struct(k, F.size(F.filter(keys, lambda x: x == k)))))
    ends = F.flatten(F.transform("_n", lambda n: F.filter(F.array(*[F.lit(s) for s in SUFFIXES]), lambda s: n.endswith(s))))
    views = F.transform(F.filter("_i", lambda i: i["bufferView"].isNotNull()), lambda i: F.get(F.col("js.bufferViews"), i["bufferView"])["byteLength"])
    return rows.select(
        "path", "size_bytes", F.coalesce("js.asset.generator", F.lit("")).alias("generator"), F.size("_n").alias("nodes"), F.coalesce(F.size("js.meshes"), F.lit(0)).alias("meshes"),
        F.coalesce(F.size("js.materials"), F.lit(0)).alias("materials"), F.size("_i").alias("images"), F.aggregate(views, F.lit(0).cast("long"), lambda s, v: s + v).alias("image_bytes"),
        triangles.alias("triangles"), total(lambda p: position(p)["count"]).alias("vertices"), corner("min", F.array_min).alias("bounds_min"), corner("max", F.array_max).alias("bounds_max"),
        F.col("_n").alias("node_names"), counted(ends).alias("suffixes"), counted(F.transform("_i", lambda i: F.coalesce(i["mimeType"], F.lit("?")))).alias("image_mime_types"),
    )


def chunks(raw: bytes) -> tuple[dict, bytes]:
    """JSON and binary chunk of a binary or of the one inside a b3dm tile."""
    if raw[:4] == b"b3dm":
        raw = raw[28 + sum(struct.unpack_from("<4I", raw, 12)) :]
    if len(raw) < 20 or struct.unpack_from("<I", raw)[0] != MAGIC:
        raise ValueError("no glTF binary")
    size = struct.unpack_from("<I", raw, 12)[0]
    return json.loads(raw[20 : 20 + size]), raw[28 + size :]


def accessor(js: dict, data: bytes, index: int) -> np.ndarray:
    a = js["accessors"][index]
    view = js["bufferViews"][a["bufferView"]]
    width = WIDTH[a["type"]]
    flat = np.frombuffer(data, COMPONENT[a["componentType"]], a["count"] * width, view.get("byteOffset", 0) + a.get("byteOffset", 0))
    return flat.reshape(a["count"], width)


MESH = "path string, mesh string, positions array<array<double>>, uv array<array<double>>, faces array<array<int>>, mesh_index int, part int"


def meshes(spark: SparkSession, path: str) -> DataFrame:
    """One row per primitive of all binaries and tiles under a path; compressed primitives are an error."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in batches:
            rows = []
            for name, raw in zip(part["path"], part["content"], strict=True):
                js, data = chunks(bytes(raw))
                for i, m in enumerate(js.get("meshes", [])):
                    for j, p in enumerate(m["primitives"]):
                        if "KHR_draco_mesh_compression" in p.get("extensions", {}):
                            raise ValueError(f"{name} holds compressed primitives, which need a decoder that is not part of this library")
                        positions = accessor(js, data, p["attributes"]["POSITION"]).astype(float)
                        uv = accessor(js, data, p["attributes"]["TEXCOORD_0"]).astype(float) if "TEXCOORD_0" in p["attributes"] else np.zeros((0, 2))
                        faces = accessor(js, data, p["indices"]).astype(np.int32) if "indices" in p else np.arange(len(positions), dtype=np.int32)
                        rows.append((name, m.get("name", ""), positions.tolist(), uv.tolist(), faces.reshape(-1, 3).tolist(), i, j))
            yield pd.DataFrame(rows, columns=["path", "mesh", "positions", "uv", "faces", "mesh_index", "part"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, MESH)


def write_glb(path: str, named: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> int:
    """One binary of meshes given as positions, texture coordinates and faces; v is flipped once. Returns its bytes."""
    blob, views, accessors, found = bytearray(), [], [], []

    def add(a: np.ndarray, component: int, kind: str, bounds: bool = False) -> int:
        views.append({"buffer": 0, "byteOffset": len(blob), "byteLength": a.nbytes})
        accessors.append({"bufferView": len(views) - 1, "componentType": component, "count": len(a) if kind != "SCALAR" else a.size, "type": kind})
        if bounds and len(a):
            accessors[-1] |= {"min": a.min(0).tolist(), "max": a.max(0).tolist()}
        blob.extend(a.tobytes())
        blob.extend(b"\0" * (-len(blob) % 4))
        return len(accessors) - 1

    for name, (positions, uv, faces) in named.items():
        flipped = np.asarray(uv, "<f4").reshape(-1, 2).copy()
        flipped[:, 1] = 1 - flipped[:, 1]
        p = {"attributes": {"POSITION": add(np.asarray(positions, "<f4").reshape(-1, 3), 5126, "VEC3", True)}, "indices": add(np.asarray(faces, "<u4").ravel(), 5125, "SCALAR")}
        if len(flipped):
            p["attributes"]["TEXCOORD_0"] = add(flipped, 5126, "VEC2")
        found.append({"name": name, "primitives": [p]})
    js = {"asset": {"version": "2.0", "generator": "isarithm"}, "scene": 0, "scenes": [{"nodes": list(range(len(found)))}], "nodes": [{"name": m["name"], "mesh": i} for i, m in enumerate(found)], "meshes": found, "accessors": accessors, "bufferViews": views, "buffers": [{"byteLength": len(blob)}]}
    text = json.dumps(js).encode()
    text += b" " * (-len(text) % 4)
    out = struct.pack("<III", MAGIC, 2, 12 + 8 + len(text) + 8 + len(blob)) + struct.pack("<II", len(text), JSON_CHUNK) + text + struct.pack("<II", len(blob), BIN_CHUNK) + bytes(blob)
    with open(path, "wb") as f:
        f.write(out)
    return len(out)


def write_tables(vertices: DataFrame, faces: DataFrame, path: str, most: int = 20_000_000) -> int:
    """One binary of named meshes given as vertices (mesh, vid, x, y, z, u, v) and faces (mesh, a, b, c) that hold vertex ids.

    A binary is one file, so the meshes pass through the driver: more than `most` vertices and faces are an error, and
    belong in tables. Meshes come in order of name; faces with unknown vertices are an error. Returns its bytes.
    """
    rows = vertices.count() + faces.count()
    if rows > most:
        raise ValueError(f"{rows} vertices and faces are more than one binary is written of ({most})")
    v, f = vertices.select("mesh", "vid", "x", "y", "z", "u", "v").toPandas(), faces.select("mesh", "a", "b", "c").toPandas()
    of = dict(iter(f.groupby("mesh")))
    named = {}
    for name, part in sorted(v.groupby("mesh")):
        part = part.sort_values("vid")
        ids = part["vid"].to_numpy()
        corners = of[name][["a", "b", "c"]].to_numpy() if name in of else np.zeros((0, 3), np.int64)
        if not np.isin(corners, ids).all():
            raise ValueError(f"faces of {name} name vertices that it does not have")
        named[name] = (part[["x", "y", "z"]].to_numpy(), part[["u", "v"]].to_numpy(), np.searchsorted(ids, corners))
    return write_glb(path, named)
