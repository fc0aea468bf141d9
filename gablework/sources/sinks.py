"""Outputs: JSON documents, viewer tables and GLB meshes."""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_documents(documents: DataFrame, path: str) -> None:
    """One JSON document a line (column document), dealt to folders by building."""
    documents.select("building", "document").write.partitionBy("building").text(path)


def write_viewer_tables(tables: dict[str, DataFrame], path: str) -> None:
    for name, table in tables.items():
        table.write.parquet(f"{path}/{name}")


def glb(meshes: list[tuple[str, np.ndarray, np.ndarray]]) -> bytes:
    """A binary glTF 2.0 of named meshes (vertices as float32 triples, faces as index triples); none gives no bytes."""
    if not meshes:
        return b""
    data, views, accessors, nodes, shapes = b"", [], [], [], []
    for name, vertices, faces in meshes:
        for array, target, kind, size in ((np.asarray(vertices, "<f4"), 34962, 5126, "VEC3"), (np.asarray(faces, "<u4").reshape(-1), 34963, 5125, "SCALAR")):
            views.append({"buffer": 0, "byteOffset": len(data), "byteLength": array.nbytes, "target": target})
            span = {"min": array.min(axis=0).tolist(), "max": array.max(axis=0).tolist()} if size == "VEC3" else {}
            accessors.append({"bufferView": len(views) - 1, "componentType": kind, "count": len(array), "type": size} | span)
            data += array.tobytes()
        shapes.append({"name": name, "primitives": [{"attributes": {"POSITION": len(accessors) - 2}, "indices": len(accessors) - 1}]})
        nodes.append({"name": name, "mesh": len(shapes) - 1})
    doc = {"asset": {"version": "2.0"}, "scene": 0, "scenes": [{"nodes": [*range(len(nodes))]}], "nodes": nodes, "meshes": shapes, "accessors": accessors, "bufferViews": views, "buffers": [{"byteLength": len(data)}]}
    text = json.dumps(doc).encode()
    text += b" " * (-len(text) % 4)
    data += b"\0" * (-len(data) % 4)
    body = struct.pack("<I4s", len(text), b"JSON") + text + struct.pack("<I4s", len(data), b"BIN\0") + data
    return struct.pack("<4sII", b"glTF", 2, 12 + len(body)) + body


def wall_meshes(walls: DataFrame) -> DataFrame:
    """A GLB file for each building of walls (building, wall_index, b1, t1, b2, t2, nx, ny, nz): two triangles a wall, wound so that they face
    along the normal. building, glb."""

    def scene(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in parts:
            rows = []
            for building, quads in zip(part["building"], part["quads"], strict=True):
                meshes = []
                for q in sorted(quads, key=lambda r: r["wall_index"]):
                    corners = np.array([[q[n][c] for c in "xyz"] for n in ("b1", "b2", "t2", "t1")])
                    faces = np.array([[0, 1, 2], [0, 2, 3]])
                    if np.dot(np.cross(corners[1] - corners[0], corners[3] - corners[0]), [q["nx"], q["ny"], q["nz"]]) < 0:
                        faces = faces[:, ::-1]
                    meshes.append((f"wall_{q['wall_index']}", corners, faces))
                rows.append((building, glb(meshes)))
            yield pd.DataFrame(rows, columns=["building", "glb"])

    quads = walls.where("b1 is not null and b2 is not null").groupBy("building").agg(F.collect_list(F.struct("wall_index", "b1", "b2", "t1", "t2", "nx", "ny", "nz")).alias("quads"))
    kind = dict(walls.dtypes)["building"]
    return quads.mapInPandas(scene, f"building {kind}, glb binary")
