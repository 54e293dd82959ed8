"""A compiled pack: fixed-width little-endian tables, CSR rows, status deltas and a manifest with checksums, and its reader.

Each table is one file: an 8-byte magic, the count as unsigned 64 bits, then the rows. Ids are dense indices (graph.dense_index);
the names in order of their indices stand in names.json.
"""

from __future__ import annotations

import hashlib
import json
import struct
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terravane.operators import fabric, graph, measure

HEAD = struct.Struct("<8sQ")


def write_table(path: Path, magic: bytes, row: struct.Struct, rows) -> int:
    """Rows in the order given; the count is filled in at the end."""
    n = 0
    with open(path, "wb") as out:
        out.write(HEAD.pack(magic, 0))
        for r in rows:
            out.write(row.pack(*r))
            n += 1
        out.seek(0)
        out.write(HEAD.pack(magic, n))
    return n


def read_table(path: Path, magic: bytes, row: struct.Struct) -> list[tuple]:
    data = Path(path).read_bytes()
    found, n = HEAD.unpack_from(data)
    if found != magic or len(data) != HEAD.size + n * row.size:
        raise ValueError(f"{path} is not a whole {magic!r} table")
    return list(row.iter_unpack(data[HEAD.size :]))


def rows_of(df: DataFrame, *order: str):
    return df.orderBy(*order).toLocalIterator(prefetchPartitions=True)


STATUS, OFFSET, NODE, UNION = struct.Struct("<IHI"), struct.Struct("<Q"), struct.Struct("<I"), struct.Struct("<IQI")
MAGIC = {"offsets": b"TVOFFS01", "neighbours": b"TVNEIG01", "base": b"TVBASE01", "removed": b"TVREMV01", "added": b"TVADDD01", "unions": b"TVUNIO01", "members": b"TVMEMB01"}


def compile_pack(folder: str, nodes: DataFrame, edges: DataFrame, statuses: dict[str, DataFrame], base: str, unions: DataFrame | None = None) -> dict:
    """Write the pack of a graph (nodes: node; edges: a, b) and of scenarios' statuses (subject, relation, actor; names of nodes).

    The statuses of `base` are written whole, the others as deltas against it. unions: actor, members (names of nodes), as a table of (actor, offset,
    count) and one of members. Returns the manifest.
    """
    root = Path(folder)
    root.mkdir(parents=True, exist_ok=True)
    rows = graph.cut(graph.csr(nodes, edges))
    (root / "names.json").write_text(json.dumps([r.node for r in rows_of(rows.select("node", "idx"), "idx")]), encoding="utf-8")
    total = write_table(root / "neighbours.bin", MAGIC["neighbours"], NODE, ((r.n,) for r in rows_of(rows.select("idx", F.posexplode("neighbours").alias("i", "n")), "idx", "i")))
    write_table(root / "offsets.bin", MAGIC["offsets"], OFFSET, (x for part in (((r.offset,) for r in rows_of(rows.select("idx", "offset"), "idx")), [(total,)]) for x in part))
    index = rows.select("node", "idx")
    dense = {}
    for name, table in statuses.items():
        ends = table.join(index.select(F.col("node").alias("subject"), F.col("idx").alias("s")), "subject").join(index.select(F.col("node").alias("actor"), F.col("idx").alias("a")), "actor")
        dense[name] = graph.cut(ends.select("s", F.col("relation").cast("int").alias("r"), "a").distinct())
    tuples = lambda df: ((r.s, r.r, r.a) for r in rows_of(df, "s", "r", "a"))
    write_table(root / "status-base.bin", MAGIC["base"], STATUS, tuples(dense[base]))
    for name in sorted(dense):
        if name != base:
            change = measure.delta(dense[base], dense[name])
            for op in ("removed", "added"):
                write_table(root / f"status-{name}-{op}.bin", MAGIC[op], STATUS, tuples(change.where(F.col("op") == op).drop("op")))
    if unions is not None:
        table = graph.cut(fabric.union_rows(unions, index))
        write_table(root / "unions.bin", MAGIC["unions"], UNION, ((r.actor, r.offset, r.n) for r in rows_of(table, "offset", "actor")))
        write_table(root / "union-members.bin", MAGIC["members"], NODE, ((r.m,) for r in rows_of(table.select("offset", F.posexplode("members").alias("i", "m")), "offset", "i")))
    files = {p.name: {"bytes": p.stat().st_size, "sha256": hashlib.sha256(p.read_bytes()).hexdigest()} for p in sorted(root.iterdir()) if p.name != "manifest.json"}
    manifest = {"base": base, "scenarios": sorted(dense), "files": files}
    (root / "manifest.json").write_text(json.dumps(manifest, indent=2, sort_keys=True) + "\n", encoding="utf-8")
    return manifest


class Pack:
    """A pack to look things up in; every file's checksum is tested on opening."""

    def __init__(self, folder: str):
        self.root = Path(folder)
        self.manifest = json.loads((self.root / "manifest.json").read_text(encoding="utf-8"))
        for name, about in self.manifest["files"].items():
            if hashlib.sha256((self.root / name).read_bytes()).hexdigest() != about["sha256"]:
                raise ValueError(f"{name} differs from the manifest")
        self.names = json.loads((self.root / "names.json").read_text(encoding="utf-8"))
        self.index = {n: i for i, n in enumerate(self.names)}
        self.offsets = [r[0] for r in read_table(self.root / "offsets.bin", MAGIC["offsets"], OFFSET)]
        self.near = [r[0] for r in read_table(self.root / "neighbours.bin", MAGIC["neighbours"], NODE)]

    def neighbours(self, name: str) -> list[str]:
        i = self.index[name]
        return [self.names[j] for j in self.near[self.offsets[i] : self.offsets[i + 1]]]

    def statuses(self, scenario: str) -> set[tuple[str, int, str]]:
        rows = set(read_table(self.root / "status-base.bin", MAGIC["base"], STATUS))
        if scenario != self.manifest["base"]:
            rows -= set(read_table(self.root / f"status-{scenario}-removed.bin", MAGIC["removed"], STATUS))
            rows |= set(read_table(self.root / f"status-{scenario}-added.bin", MAGIC["added"], STATUS))
        return {(self.names[s], r, self.names[a]) for s, r, a in rows}

    def unions(self) -> dict[str, list[str]]:
        """The members of each actor's union; none where the pack has no such table."""
        if "unions.bin" not in self.manifest["files"]:
            return {}
        members = [r[0] for r in read_table(self.root / "union-members.bin", MAGIC["members"], NODE)]
        return {self.names[a]: [self.names[m] for m in members[at : at + n]] for a, at, n in read_table(self.root / "unions.bin", MAGIC["unions"], UNION)}
