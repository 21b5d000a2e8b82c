"""Merkle manifest of a dataset, with the hash state kept before each child slot.

Every row is a leaf; rows of a key form a tree, and the roots of all keys a tree
above them. A parent hashes the hex text of its children, so before each slot its
SHA-256 is in a state of eight words (``sha_state``). These states are stored
with the tree. Folding a changed leaf into the root resumes the state before its
slot with the new digest and the siblings to its right; those to its left are in
the state already and are read by proofs alone.

Nothing is sorted or grouped by key as a whole: rows are numbered over range
partitions, and a run of ``fan ** depth`` places (a page, ``PAGE`` at most) is
built in one task and stored as one row. Page roots are the leaves of the next
tier, so there are log(rows) / log(PAGE) tiers. Paths go the other way, from the
root down, a row per page; each page's rows are folded with its path at once.

Edge cases: null fields hash as ``-``; null keys are a key of their own, before
all others, as are null ids within a key; rows of equal id stand by leaf digest,
equal rows count each; a key with one row has its leaf as root, and one key's
root is the root; an empty table gives no rows; columns outside ``fields``, the
key and the id aren't read.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barlab.llm import sha_state as S
from barlab.llm.workspace import Workspace, shuffle_partitions

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 2
#: Most places of a page; 64 bytes a place and level-sum of twice that.
PAGE = 2048

PAGES = "key string, block long, m long, n int, levels int, digests binary, states binary, digest binary"
STEP = "array<struct<state: binary, left: binary, right: binary>>"
PATHS = f"key string, pos long, path {STEP}"
FOLDED = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def digest(columns: list[Column]) -> Column:
    """Binary SHA-256 over the columns, each as ``-`` or its byte length, ``:`` and value."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.unhex(F.sha2(F.concat(*map(field, columns)), 256))


def key_text(c: Column) -> Column:
    """Never null, in the order of ``c`` with null first."""
    return F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit(""))


def numbered(ws: Workspace, rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, the place within ``key`` by ``order``, and ``m``, the key's rows.

    Range partitions hold runs of the order; a table of one row per partition
    and key carries what lies before.
    """
    cols = ["key", *order]
    parts = rows.repartitionByRange(shuffle_partitions(rows.sparkSession), *cols).withColumn("part", F.spark_partition_id())
    parts = ws.stage(parts, "ordered")
    counts = parts.groupBy("part", "key").agg(F.count(F.lit(1)).alias("here"))
    earlier = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ws.stage(counts.select("part", "key", F.coalesce(F.sum("here").over(earlier), F.lit(0)).alias("before"),
                                    F.sum("here").over(Window.partitionBy("key")).alias("m")), "counts")
    nth = F.row_number().over(Window.partitionBy("part", "key").orderBy(*order)) - 1
    return parts.join(counts, ["part", "key"]).withColumn("pos", F.col("before") + nth).drop("part", "before")


def depth_of(fan: int, page: int = PAGE) -> int:
    """Levels of a page."""
    if fan < 2 or page < fan:
        raise ValueError("a parent needs two slots or more, and a page a parent")
    depth = 1
    while fan ** (depth + 1) <= page:
        depth += 1
    return depth


def height(m: int, fan: int) -> int:
    """Levels from ``m`` nodes to one."""
    h = 0
    while m > 1:
        m, h = -(-m // fan), h + 1
    return h


def raise_page(leaves: np.ndarray, levels: int, fan: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Digests of every level, and for each child the state of its parent before its slot."""
    digests, states = [leaves], []
    for _ in range(levels):
        children = digests[-1]
        n = children.shape[1]
        parents = -(-n // fan)
        state, before = S.start(parents), np.empty((8, n), S.W)
        blocks = S.hex_block(children)
        for slot in range(fan):
            at = np.arange(slot, n, fan)
            if len(at):
                before[:, at] = state[:, :len(at)]
                state[:, :len(at)] = S.absorb(state[:, :len(at)], blocks[:, at])
        sizes = np.minimum(fan, n - fan * np.arange(parents))
        states.append(before)
        digests.append(S.absorb(state, S.closing_block(sizes)))
    return digests, states


def page_builder(fan: int, depth: int):
    def build(key, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        m = int(pdf["m"].iloc[0])
        levels = min(depth, height(m, fan))
        digests, states = raise_page(S.unpack(b"".join(pdf["digest"])), levels, fan)
        return pd.DataFrame({"key": [key[0]], "block": [key[1]], "m": [m], "n": [len(pdf)], "levels": [levels],
                             "digests": [b"".join(map(S.pack, digests))], "states": [b"".join(map(S.pack, states))],
                             "digest": [S.pack(digests[-1])]})
    return build


def open_page(page: pd.Series, fan: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Digests and states by level, as ``raise_page`` made them."""
    sizes = [int(page["n"])]
    for _ in range(int(page["levels"])):
        sizes.append(-(-sizes[-1] // fan))
    cuts = np.cumsum(sizes)[:-1]
    states = S.unpack(page["states"]) if sizes[1:] else np.empty((8, 0), S.W)
    return np.split(S.unpack(page["digests"]), cuts, axis=1), np.split(states, cuts[:-1], axis=1) if sizes[1:] else []


@dataclass
class Tree:
    """Stored pages, lowest tier first, and (key, digest) of the roots."""

    tiers: list[DataFrame]
    roots: DataFrame
    fan: int
    depth: int


def grow(ws: Workspace, leaves: DataFrame, fan: int = FAN, page: int = PAGE) -> Tree:
    """Trees over (key, pos, m, digest) rows."""
    depth = depth_of(fan, page)
    per = fan ** depth
    tiers, rows = [], leaves.select("key", "pos", "m", "digest")
    while True:
        paged = rows.withColumn("block", F.floor(F.col("pos") / per).cast("long"))
        tier = ws.stage(paged.groupBy("key", "block").applyInPandas(page_builder(fan, depth), PAGES), f"pages{len(tiers)}")
        tiers.append(tier)
        if (tier.agg(F.max("m")).first()[0] or 0) <= per:
            return Tree(tiers, tier.select("key", "digest"), fan, depth)
        rows = tier.select("key", F.col("block").alias("pos"), F.ceil(F.col("m") / per).alias("m"), "digest")


def descend(fan: int):
    """Task: the path from each place of a page to the root, the page's own path behind it."""
    def run(pages):
        for pdf in pages:
            out = []
            for _, page in pdf.iterrows():
                digests, states = open_page(page, fan)
                above = list(page["path"])
                first = int(page["block"]) * page["per"]
                for i in range(int(page["n"])):
                    steps, at = [], i
                    for level, before in zip(digests, states):
                        base = at - at % fan
                        steps.append({"state": S.pack(before[:, at: at + 1]), "left": S.pack(level[:, base: at]),
                                      "right": S.pack(level[:, at + 1: base + fan])})
                        at //= fan
                    out.append((page["key"], first + i, steps + above))
            yield pd.DataFrame(out, columns=["key", "pos", "path"])
    return run


def paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """(key, block, path) of each lowest page, given (key, path) of the roots."""
    at = tops.withColumn("block", F.lit(0).cast("long"))
    for tier in reversed(tree.tiers[1:]):
        pages = tier.join(at, ["key", "block"]).withColumn("per", F.lit(tree.fan ** tree.depth))
        at = pages.mapInPandas(descend(tree.fan), PATHS).withColumnRenamed("pos", "block")
    return at


def leaf_paths(tree: Tree, tops: DataFrame) -> DataFrame:
    """(key, pos, path) of every leaf; for trees whose leaves are few, such as those of keys."""
    pages = tree.tiers[0].join(paths(tree, tops), ["key", "block"]).withColumn("per", F.lit(tree.fan ** tree.depth))
    return pages.mapInPandas(descend(tree.fan), PATHS)


def resume(state: np.ndarray, new: np.ndarray, right: list[tuple[np.ndarray, np.ndarray]], size: np.ndarray) -> np.ndarray:
    """Parents' digests from the state before a slot, its new digest and (which rows, digests) to the right."""
    state = S.absorb(state, S.hex_block(new))
    for rows, sibling in right:
        state[:, rows] = S.absorb(state[:, rows], S.hex_block(sibling))
    return S.absorb(state, S.closing_block(size))


def fold_page(places: np.ndarray, new: np.ndarray, digests: list[np.ndarray], states: list[np.ndarray], fan: int):
    """The page's root for each replaced leaf, and the siblings met: (digests, which exist), lowest first, left to right."""
    at, met = places, []
    for level, before in zip(digests, states):
        n, slot = level.shape[1], at % fan
        base = at - slot
        size = np.minimum(fan, n - base)
        right = []
        for k in range(fan):
            other = base + k
            there = (k < size) & (k != slot)
            met.append((S.unpack(S.pack(level[:, np.minimum(other, n - 1)])), there))
            after = np.flatnonzero(there & (k > slot))
            if len(after):
                right.append((after, level[:, other[after]]))
        new = resume(before[:, at], new, right, size)
        at = at // fan
    return new, met


def folder(fan: int):
    """Task: rows of a page with its stored levels and path, folded to the root."""
    def fold(key, rows: pd.DataFrame, pages: pd.DataFrame) -> pd.DataFrame:
        if not len(rows):
            return pd.DataFrame({c.split()[0]: [] for c in FOLDED.split(", ")})
        page = pages.iloc[0]
        digests, states = open_page(page, fan)
        per = page["per"]
        new = S.unpack(b"".join(rows["replacement"]))
        root, met = fold_page(rows["pos"].to_numpy() - int(page["block"]) * per, new, digests, states, fan)
        above = b""
        every = np.arange(len(rows))
        for step in page["path"]:
            left, right = S.unpack(step["left"]), S.unpack(step["right"])
            siblings = [(every, right[:, [i]]) for i in range(right.shape[1])]
            size = np.full(len(rows), left.shape[1] + 1 + right.shape[1])
            root = resume(np.repeat(S.unpack(step["state"]), len(rows), axis=1), root, siblings, size)
            above += step["left"] + step["right"]
        raw = np.stack([np.frombuffer(S.pack(d), f"V{S.DIGEST_BYTES}") for d, _ in met], axis=1) if met else None
        there = np.stack([e for _, e in met], axis=1) if met else None
        proofs = [((raw[i][there[i]].tobytes() if met else b"") + above).hex() for i in range(len(rows))]
        folded = S.pack(root)
        return pd.DataFrame({
            "doc_id": rows["doc_id"], "leaf": [d.hex() for d in rows["digest"]], "subroot": page["subroot"].hex(),
            "proof_sha256": [hashlib.sha256(p.encode()).hexdigest() for p in proofs],
            "folded_root": [folded[i: i + S.DIGEST_BYTES].hex() for i in range(0, len(folded), S.DIGEST_BYTES)]})
    return fold


def verify(ws: Workspace, rows: DataFrame, fan: int = FAN, page: int = PAGE) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of (key, doc_id, digest, replacement) rows.

    ``replacement`` is the leaf as found now (null: as it was); its fold must give the manifest's root.
    """
    rows = ws.stage(rows.withColumn("row", F.monotonically_increasing_id()), "leaves")
    leaves = ws.stage(numbered(ws, rows, ["doc_id", "digest", "row"]), "numbered")
    tree = grow(ws, leaves, fan, page)
    keys = ws.stage(numbered(ws, tree.roots.select(F.lit("").alias("key"), F.col("key").alias("of"), "digest"), ["of"]), "keys")
    top = grow(ws, keys, fan, page)
    found = top.roots.first()  # one row
    root = found["digest"].hex() if found else None
    nothing = top.roots.select("key", F.array().cast(STEP).alias("path"))
    tops = keys.join(leaf_paths(top, nothing), ["key", "pos"]).select(F.col("of").alias("key"), "path")
    tops = ws.stage(tops, "key-paths")
    per = tree.fan ** tree.depth
    lowest = tree.tiers[0].drop("digest").join(paths(tree, tops), ["key", "block"]).join(
        tree.roots.withColumnRenamed("digest", "subroot"), "key").withColumn("per", F.lit(per))
    placed = leaves.withColumns({"block": F.floor(F.col("pos") / per).cast("long"), "replacement": F.coalesce("replacement", "digest")})
    out = placed.groupBy("key", "block").cogroup(lowest.groupBy("key", "block")).applyInPandas(folder(fan), FOLDED)
    root = F.lit(root).cast("string")
    return out.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"))


def leaves(docs: DataFrame, tampered: Column, key: str = "lang", fields=FIELDS, changed: str = "n_chars") -> DataFrame:
    """Leaf rows of ``docs``; where ``tampered``, the replacement has one more in ``changed`` (null stays)."""
    more = (F.col(changed).cast("decimal(38,0)") + 1).cast("string")
    before = digest([F.col(f) for f in fields])
    after = digest([more if f == changed else F.col(f) for f in fields])
    touched = F.coalesce(tampered & F.col(changed).isNotNull(), F.lit(False))
    return docs.select(key_text(F.col(key)).alias("key"), F.col("doc_id").cast("long").alias("doc_id"), before.alias("digest"),
                       F.when(touched, after).alias("replacement"))


def every_seventh(doc_id: Column) -> Column:
    """Ids whose CRC-32 (of the decimal text) seven divides."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0
