"""Merkle manifest of a dataset: a tree a group, and a tree over the groups' roots.

Nodes are lowercase hex SHA-256 digests; a parent is the digest of its two children's, or
of one where the last has no partner.  The leaves of a group are numbered and cut into
aligned blocks of ``1 << LEVELS``; a task hashes a block up to one node, and the block
nodes are cut into blocks again, so a tree of any size takes a few jobs and no task holds
more than a block.

A proof is folded in the task that holds the leaf's block.  Every parent there keeps a
copied hash state before each child slot; folding resumes the state of its slot with the
replaced digest and feeds the right sibling only.  What lies above a block is one path
for all its leaves, whose states are made once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.numbering import numbered
from marketlake.session import materialize

#: Levels of the tree that one task hashes; a block has ``1 << LEVELS`` nodes at most.
LEVELS = 10
NODE = "lot string, pos long, size long, digest string"
PATH = "lot string, pos long, path string"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 byte count, a colon and the value as text."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest_of(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _lot(group: Column) -> Column:
    """The group as a text that is never null; null groups come first, others in byte order."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def _depth(size: int) -> int:
    """Levels above a row of ``size`` nodes."""
    return max(size - 1, 0).bit_length()


class Level:
    """The parents of a row of nodes, each with the hash states before its child slots."""

    def __init__(self, nodes: list[str]):
        self.nodes = nodes
        self.states, self.parents = [], []
        for at in range(0, len(nodes), 2):
            empty = hashlib.sha256()
            state = empty.copy()
            state.update(nodes[at].encode())
            kept = [empty, state.copy()]
            if at + 1 < len(nodes):
                state.update(nodes[at + 1].encode())
            self.states.append(kept)
            self.parents.append(state.hexdigest())

    def step(self, at: int) -> tuple:
        """(state before the slot, right sibling or '', the sibling's token) of child ``at``."""
        state = self.states[at // 2][at % 2]
        if at % 2:
            return state, b"", "L" + self.nodes[at - 1]
        if at + 1 < len(self.nodes):
            return state, self.nodes[at + 1].encode(), "R" + self.nodes[at + 1]
        return state, b"", ""


def _tree(nodes: list[str], levels: int) -> list[Level]:
    out = []
    for _ in range(levels):
        out.append(Level(nodes))
        nodes = out[-1].parents
    return out


def _levels(size: int, height: int) -> int:
    """Levels that a block at ``height`` adds in a group of ``size`` leaves."""
    return min(LEVELS, max(_depth(size) - height, 0))


def _rise(height: int):
    """Block of nodes -> its top node."""
    def run(block: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        size = block["size"][0].as_py()
        nodes = block["digest"].to_pylist()
        levels = _tree(nodes, _levels(size, height))
        top = levels[-1].parents[0] if levels else nodes[0]
        return pa.table({"lot": block["lot"][:1], "pos": [block["pos"][0].as_py() >> LEVELS],
                         "size": [size], "digest": [top]})

    return run


def _descend(height: int):
    """Block of nodes and the path above its top -> the path above every node."""
    def run(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        upper = above["path"][0].as_py()
        levels = _tree(block["digest"].to_pylist(), _levels(block["size"][0].as_py(), height))
        paths = []
        for k in range(len(block)):
            own = ["-" if not (token := level.step(k >> n)[2]) else token for n, level in enumerate(levels)]
            paths.append(",".join([*own, upper] if upper else own))
        return pa.table({"lot": block["lot"], "pos": block["pos"], "path": paths})

    return run


def _blocks(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.shiftright("pos", LEVELS))


@dataclass
class Forest:
    """Written rows of nodes, from the leaves to one node a group."""

    rows: list[DataFrame]

    def tops(self) -> DataFrame:
        """(lot, pos 0, size, digest): the root of every group's tree."""
        return self.rows[-1]


def build(leaves: DataFrame) -> Forest:
    """Trees over ``leaves`` (lot, pos, size, digest), a written table with ``pos`` from 0 in each lot."""
    largest = leaves.agg(F.max("size")).first()[0] or 0
    rows = [leaves]
    for height in range(0, max(_depth(largest), 1), LEVELS):
        top = _blocks(rows[-1].select("lot", "pos", "size", "digest")).groupBy("lot", "block").applyInArrow(
            _rise(height), NODE)
        rows.append(materialize(top, "merkle-row"))
    return Forest(rows)


def block_paths(forest: Forest, above: DataFrame) -> DataFrame:
    """(lot, pos, path) of the first row of blocks; ``above`` (lot, pos, path) is what lies above the trees.

    A path is one token a level, upwards: ``L`` or ``R`` and the sibling on that side, or ``-``.
    """
    paths = above
    for level in range(len(forest.rows) - 2, 0, -1):
        nodes = _blocks(forest.rows[level].select("lot", "pos", "size", "digest"))
        down = nodes.groupBy("lot", "block").cogroup(
            paths.withColumnRenamed("pos", "block").groupBy("lot", "block")).applyInArrow(
            _descend(level * LEVELS), PATH)
        paths = materialize(down, "merkle-paths")
    return paths


def _resume(steps: list[tuple], node: str) -> str:
    for state, right, _ in steps:
        state = state.copy()
        state.update(node.encode())
        state.update(right)
        node = state.hexdigest()
    return node


def _path_steps(path: str) -> list[tuple]:
    steps = []
    for token in path.split(",") if path else []:
        state = hashlib.sha256()
        if token[0] == "L":
            state.update(token[1:].encode())
        steps.append((state, token[1:].encode() if token[0] == "R" else b"", token if token != "-" else ""))
    return steps


def _fold(keep: list[str], full_proofs: bool):
    def run(block: pa.Table, above: pa.Table) -> pa.Table:
        block = block.sort_by("pos")
        nodes = block["digest"].to_pylist()
        levels = _tree(nodes, _levels(block["size"][0].as_py(), 0))
        upper = _path_steps(above["path"][0].as_py())
        folded, proofs, digests = [], [], []
        for k, given in enumerate(block["given"].to_pylist()):
            steps = [level.step(k >> n) for n, level in enumerate(levels)] + upper
            folded.append(_resume(steps, nodes[k] if given is None else given))
            digests.append(hashlib.sha256("".join(token[1:] for _, _, token in steps).encode()).hexdigest())
            proofs.append([token or "-" for _, _, token in steps])
        out = {c: block[c] for c in keep}
        out |= {"leaf": block["digest"], "subroot": [above["subroot"][0]] * len(nodes),
                "root": [above["root"][0]] * len(nodes), "proof_sha256": digests, "folded_root": folded}
        if full_proofs:
            out["proof"] = pa.array(proofs, pa.list_(pa.string()))
        return pa.table(out)

    return run


def manifest(docs: DataFrame, fields: list[str], group: str, key: str, given: Column | None = None,
             full_proofs: bool = False) -> DataFrame:
    """(key, leaf, subroot, root, proof_sha256, folded_root, verified), a row a row of ``docs``.

    A leaf is the digest of ``fields``; leaves of a group ascend by ``key``, nulls first, and
    rows with equal keys by leaf.  ``given`` is the leaf that a holder of the row presents,
    null for the original one: it is folded with the original siblings, and ``verified`` tells
    whether the root comes out.  ``proof_sha256`` digests the siblings up to the root; with
    ``full_proofs`` the column ``proof`` lists them, each behind ``L`` or ``R`` for its side, and
    ``-`` for a level where the node has none.

    Null values, groups and keys are values like others; a null group is one group, which
    comes first.  Repeated rows are leaves of their own.  An empty table gives no rows.
    Texts are hashed as they are read, whatever their length; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()
    leaves = materialize(docs.select(
        _lot(docs[group]).alias("lot"), docs[key].alias("key"), digest_of([docs[c] for c in fields]).alias("digest"),
        (F.lit(None) if given is None else given).cast("string").alias("given")), "merkle-leaves")
    leaves = materialize(numbered(leaves, "lot", ["key", "digest"]), "merkle-leaves")
    trees = build(leaves)
    tops = trees.tops()
    lots = materialize(tops.select(F.lit("").alias("lot"), F.col("lot").alias("of"), "digest"), "merkle-lots")
    lots = materialize(numbered(lots, "lot", ["of"]), "merkle-lots")
    over = build(lots)
    root = over.tops().select(F.col("digest").alias("root"))
    nothing = lots.select("lot").distinct().select("lot", F.lit(0).cast("long").alias("pos"), F.lit("").alias("path"))
    lot_blocks = block_paths(over, nothing)
    down = _blocks(lots.select("lot", "pos", "size", "digest")).groupBy("lot", "block").cogroup(
        lot_blocks.withColumnRenamed("pos", "block").groupBy("lot", "block")).applyInArrow(_descend(0), PATH)
    of_lot = lots.join(down.select("pos", "path"), "pos").select(
        F.col("of").alias("lot"), F.lit(0).cast("long").alias("pos"), "path")
    paths = block_paths(trees, materialize(of_lot, "merkle-paths"))
    # One row holds the root; the blocks get it with their group's.
    ends = tops.select("lot", F.col("digest").alias("subroot")).withColumn("one", F.lit("")).join(
        over.tops().select(F.col("lot").alias("one"), F.col("digest").alias("root")), "one").drop("one")
    paths = paths.withColumnRenamed("pos", "block").join(ends, "lot")
    schema = (f"key {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
              + (", proof array<string>" if full_proofs else ""))
    out = _blocks(leaves).groupBy("lot", "block").cogroup(paths.groupBy("lot", "block")).applyInArrow(
        _fold(["key"], full_proofs), schema)
    return out.withColumn("verified", F.col("folded_root") == F.col("root")).withColumnRenamed("key", key)


def tampered_leaf(docs: DataFrame, fields: list[str], changed: str, key: str) -> Column:
    """The leaf after 1 is added to ``changed`` where 7 divides the CRC-32 of the key's text; else null."""
    hit = (F.crc32(docs[key].cast("string").cast("binary")) % 7 == 0) & docs[changed].isNotNull()
    more = (docs[changed].cast("decimal(20,0)") + 1).cast("decimal(21,0)")
    return F.when(hit, digest_of([more if c == changed else docs[c] for c in fields]))


#: The trees level by level, and every leaf folded by the plain rule.
SQL = """
with recursive d as (
 select doc_id, coalesce('=' || lang, '') as lot, crc32 % 7 = 0 and n_chars is not null as hit,
  sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::varchar) || ':' || n_chars, '-')
   || coalesce(strlen(text) || ':' || text, '-')) as leaf,
  sha256(coalesce(strlen(doc_id::varchar) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen((n_chars + 1)::varchar) || ':' || (n_chars + 1), '-')
   || coalesce(strlen(text) || ':' || text, '-')) as changed
 from (select *, xor(list_reduce(list_prepend(4294967295::bigint,
    list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
     lambda x, i: case when x & 1 = 1 then xor(x >> 1, 3988292384) else x >> 1 end)), 4294967295) as crc32
  from documents)),
l as (select *, row_number() over (partition by lot order by doc_id nulls first, leaf) - 1 as pos from d),
sub(level, lot, pos, digest, n) as (
 select 0, lot, pos, leaf, count(*) over (partition by lot) from l
 union all
 select any_value(level) + 1, lot, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(n) + 1) // 2
 from sub where n > 1 group by lot, pos // 2),
subroots as (select lot, digest from sub where n = 1),
top(level, pos, digest, n) as (
 select 0, row_number() over (order by lot) - 1, digest, count(*) over () from subroots
 union all
 select any_value(level) + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (any_value(n) + 1) // 2
 from top where n > 1 group by pos // 2),
lots as (select lot, digest as subroot, row_number() over (order by lot) - 1 as pos from subroots),
fold(lot, doc, level, in_top, pos, here, siblings) as (
 select lot, pos, 0, false, pos, case when hit then changed else leaf end, '' from l
 union all
 select f.lot, f.doc, case when f.in_top or s.n > 1 then f.level + 1 else 0 end, f.in_top or s.n = 1,
  case when f.in_top or s.n > 1 then f.pos // 2 else x.pos end,
  case when not f.in_top and s.n = 1 then f.here
   when f.pos % 2 = 1 then sha256(coalesce(b.digest, t.digest) || f.here)
   else sha256(f.here || coalesce(b.digest, t.digest, '')) end,
  f.siblings || case when not f.in_top and s.n = 1 then '' else coalesce(b.digest, t.digest, '') end
 from fold f join lots x on x.lot = f.lot
 left join sub s on not f.in_top and s.lot = f.lot and s.level = f.level and s.pos = f.pos
 left join sub b on not f.in_top and b.lot = f.lot and b.level = f.level and b.pos = xor(f.pos, 1)
 left join top u on f.in_top and u.level = f.level and u.pos = f.pos
 left join top t on f.in_top and t.level = f.level and t.pos = xor(f.pos, 1)
 where not f.in_top or u.n > 1),
ends as (select f.* from fold f join top u on f.in_top and u.level = f.level and u.pos = f.pos and u.n = 1)
select l.doc_id, l.leaf, x.subroot, r.digest as root, sha256(e.siblings) as proof_sha256, e.here as folded_root,
 e.here = r.digest as verified
from l join ends e on e.lot = l.lot and e.doc = l.pos join lots x on x.lot = l.lot
join (select digest from top where n = 1) r on true
"""
