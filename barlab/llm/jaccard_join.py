"""N-gram Jaccard join: rare-first prefix filtering, verified once per pair.

A document's set holds its distinct 5-word shingles. Equal sets form a class and
go on as one. In each set shingles are ordered rare first; two sets of Jaccard
at least t share a shingle among their first n - ceil(t n) + 1, so classes are
joined on those alone, then thinned by set length, by the positions of the
shared shingle (what precedes it counts only where another prefix has it too), and,
with both texts at hand, by a suffix filter (shingle counts per hash cell bound the
overlap) before the one exact intersection.

Rarity comes from a counting sketch of all shingles (``CELLS`` counters however
large the input, broadcast as one byte each). Any order common to all documents
gives the same links; a coarser one only costs candidates.

A group that shares a shingle isn't expanded into all pairs. Two rounds test
each member against one pivot of the group and against its neighbour; what is
linked by then needs no further test inside its component. Groups that still
span several components are then compared across components, completely, so no
link between components is missed. Pairs are tested once: later rounds leave out
tested ones.

Edge cases: null, empty and wordless texts have no shingles and link with
nothing; a text of fewer than five words is one shingle of all its words; rows of
equal ``doc_id`` may lie in different components; a component of null ids alone
has a null id; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from barlab.llm import vectors as V
from barlab.llm.components import components
from barlab.llm.workspace import Workspace, join_by_share, text_key

SHINGLE = 5
PERCENT = 80
#: Counters of the rarity sketch; fixed, so its broadcast is CELLS bytes.
CELLS = 1 << 20
CELL_ROWS = 256
#: Text ids up to this many are broadcast to fetch texts (16 bytes each); beyond, the join shuffles.
BROADCAST_IDS = 1 << 20
SUFFIX_CELLS = 64

SETS = V.struct("doc long, th long, tk long, a long, b long, n long, chunk int, counts binary")
GRAMS = V.struct("g long, id long, n int, pos int")
TESTED = V.struct("u long, v long, linked boolean")


def shingle_sets(buf: np.ndarray, offs: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    buf = V.lower_ascii(buf)
    starts, ends, doc = V.words(buf, offs)
    roll = V.Rolling(V.word_hashes(buf, starts, ends))
    first = np.searchsorted(doc, np.arange(len(offs)))
    runs = roll.windows(size)
    out = []
    for s, e in zip(first[:-1].tolist(), first[1:].tolist()):
        if e - s >= size:
            out.append(np.unique(runs[s: e - size + 1]))
        elif e > s:
            out.append(roll.runs(np.array([s]), np.array([e])))
        else:
            out.append(runs[:0])
    return out


def _ids(sets: list[np.ndarray], seed: int) -> np.ndarray:
    salt = V.U(seed)
    return np.array([V.mix(np.array([V.mix(s ^ salt).sum() + V.U(len(s))], V.U))[0] if len(s) else 0 for s in sets], V.U).view(np.int64)


def set_rows(size: int):
    """Task: a row per document (two hashes of its set, its size), then the task's shingle counts."""
    schema = to_arrow_schema(SETS)

    def run(batches):
        counts = np.zeros(CELLS, np.uint32)
        for b in batches:
            docs, hashes, more = (b.column(c) for c in ("doc", "th", "tk"))
            for i, j, buf, offs in V.text_chunks(b.column("text")):
                sets = shingle_sets(buf, offs, size)
                every = np.concatenate(sets)
                counts += np.bincount((every & V.U(CELLS - 1)).astype(np.int64), minlength=CELLS).astype(np.uint32)
                none = [None] * (j - i)
                yield V.record_batch(schema, doc=docs.slice(i, j - i), th=hashes.slice(i, j - i), tk=more.slice(i, j - i), a=_ids(sets, 1), b=_ids(sets, 2),
                                     n=np.array([len(s) for s in sets], np.int64), chunk=none, counts=none)
        width = CELLS // CELL_ROWS
        rows = [k for k in range(CELL_ROWS) if counts[k * width: (k + 1) * width].any()]
        none = [None] * len(rows)
        yield V.record_batch(schema, doc=none, th=none, tk=none, a=none, b=none, n=none, chunk=rows,
                             counts=[counts[k * width: (k + 1) * width].tobytes() for k in rows])
    return run


def add_counts(batches):
    """Task: counters of equal rows added up, one row at a time."""
    total: dict[int, np.ndarray] = {}
    schema = None
    for b in batches:
        schema = b.schema
        for k, c in zip(b.column("chunk").to_pylist(), b.column("counts")):
            part = np.frombuffer(c.as_buffer(), np.uint32).astype(np.uint64)
            total[k] = total[k] + part if k in total else part
    if total:
        yield V.record_batch(schema, chunk=list(total), counts=[np.minimum(v, 0xFFFFFFFF).astype(np.uint32).tobytes() for v in total.values()])


def rarity(rows: DataFrame) -> np.ndarray:
    """Frequency class (a step per quarter power of two) of each sketch cell."""
    parts = rows.filter("chunk is not null").select("chunk", "counts").repartition("chunk")
    counts, width = np.zeros(CELLS, np.float64), CELLS // CELL_ROWS
    for r in parts.mapInArrow(add_counts, parts.schema).toLocalIterator():  # CELLS counters in all
        counts[r["chunk"] * width: (r["chunk"] + 1) * width] = np.frombuffer(r["counts"], np.uint32)
    return np.minimum(255, 8 * np.log2(counts + 1)).astype(np.uint8)


def prefix_grams(size: int, percent: int, classes, use_a: bool):
    """Task: each set's rare-first prefix; a set already seen in the task is skipped."""
    schema = to_arrow_schema(GRAMS)

    def run(batches):
        seen, order = set(), classes.value
        for b in batches:
            for _, _, buf, offs in V.text_chunks(b.column("text")):
                sets = shingle_sets(buf, offs, size)
                g, who, n, pos = [], [], [], []
                for s, key in zip(sets, _ids(sets, 1 if use_a else 2).tolist()):
                    if not len(s) or key in seen:
                        continue
                    seen.add(key)
                    keep = len(s) - (percent * len(s) + 99) // 100 + 1
                    rare = order[(s & V.U(CELLS - 1)).astype(np.int64)]
                    g.append(s[np.argsort(rare, kind="stable")[:keep]])
                    who.append(key)
                    n.append(len(s))
                    pos.append(np.arange(1, keep + 1, dtype=np.int32))
                if g:
                    lens = [len(x) for x in g]
                    yield V.record_batch(schema, g=np.concatenate(g).view(np.int64), id=np.repeat(np.array(who, np.int64), lens),
                                         n=np.repeat(np.array(n, np.int32), lens), pos=np.concatenate(pos))
    return run


def verify(size: int, percent: int):
    """Task: suffix filter, then the exact intersection, of (u, v, text_u, text_v) rows."""
    schema = to_arrow_schema(TESTED)

    def cells(s):
        return np.bincount((s >> V.U(64 - 6)).astype(np.int64), minlength=SUFFIX_CELLS)

    def sets_of(col, ids):
        """One set per run of equal ids."""
        new = np.append(True, ids[1:] != ids[:-1])
        at = np.flatnonzero(new)
        sets = []
        for _, _, buf, offs in V.text_chunks(col.take(at)):
            sets += shingle_sets(buf, offs, size)
        return sets, np.cumsum(new) - 1

    def run(batches):
        for b in batches:
            for k in range(0, b.num_rows, 512):
                part = b.slice(k, 512)
                u, v = part.column("u").to_numpy(), part.column("v").to_numpy()
                su, iu = sets_of(part.column("text_u"), u)
                sv, iv = sets_of(part.column("text_v"), v)
                cu, cv = [cells(s) for s in su], [cells(s) for s in sv]
                linked = np.zeros(len(u), bool)
                for r, (x, y) in enumerate(zip(iu.tolist(), iv.tolist())):
                    p, q = su[x], sv[y]
                    need = -(-percent * (len(p) + len(q)) // (100 + percent))
                    if len(p) + len(q) - int(np.abs(cu[x] - cv[y]).sum()) < 2 * need:
                        continue
                    both = len(np.intersect1d(p, q, assume_unique=True))
                    linked[r] = 100 * both >= percent * (len(p) + len(q) - both)
                yield V.record_batch(schema, u=u, v=v, linked=linked)
    return run


def _may_link(a: str, b: str, percent: int) -> Column:
    """Length and positional filters for a shingle shared by rows a and b.

    A shingle of both sets that precedes it is in both prefixes, so it counts in
    ``before`` of either; behind it, the shorter rest bounds the overlap.
    """
    n1, n2 = F.col(f"{a}n"), F.col(f"{b}n")
    need = F.ceil(percent * (n1 + n2) / F.lit(100 + percent))
    most = F.least(F.col(f"{a}before"), F.col(f"{b}before")) + 1 + F.least(n1 - F.col(f"{a}pos"), n2 - F.col(f"{b}pos"))
    return (100 * F.least(n1, n2) >= percent * F.greatest(n1, n2)) & (most >= need)


def _ordered_pairs(df: DataFrame) -> DataFrame:
    return df.select(F.least("id", "other").alias("u"), F.greatest("id", "other").alias("v")).distinct()


def star_pairs(shared: DataFrame, order: list[Column], percent: int) -> DataFrame:
    """Each member with its group's first one and with the one before it; shared has g, id, n, pos, before, root."""
    w = Window.partitionBy("g").orderBy(*order)
    at = F.struct("id", "n", "pos", "before", "root")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = shared.withColumns({"pivot": F.first(at).over(upto), "last": F.lag(at).over(w)})
    near = near.withColumn("o", F.explode(F.array("pivot", "last")))
    near = near.filter((F.col("o.root") != F.col("root")) & _may_link("", "o.", percent))
    return _ordered_pairs(near.select("id", F.col("o.id").alias("other")))


def cross_pairs(shared: DataFrame, percent: int) -> DataFrame:
    """All pairs of a group that lie in different components."""
    a, b = shared.alias("a"), shared.alias("b")
    hit = a.join(b, (F.col("a.g") == F.col("b.g")) & (F.col("a.root") < F.col("b.root"))
                 & _may_link("a.", "b.", percent))
    return _ordered_pairs(hit.select(F.col("a.id").alias("id"), F.col("b.id").alias("other")))


class _Texts:
    """Texts of set classes by id, each from one document of the class."""

    def __init__(self, ws: Workspace, docs: DataFrame, sets: DataFrame):
        self.ws, self.docs = ws, docs
        self.rep = sets.groupBy("id").agg(F.min(F.struct("doc", "th", "tk")).alias("at"))

    def of(self, pairs: DataFrame) -> DataFrame:
        ids = pairs.select(F.explode(F.array("u", "v")).alias("id")).distinct()
        want = self.ws.stage(self.rep.join(ids, "id").select("id", "at.doc", "at.th", "at.tk"), "text-ids")
        n = want.count()
        if n <= BROADCAST_IDS:
            want = F.broadcast(want)
        texts = self.ws.stage(self.docs.join(want, ["doc", "th", "tk"]).select("id", "text"), "texts")
        # equal rows come once; a stored table, so that AQE can split the pairs of a frequent pivot
        return texts if texts.count() == n else self.ws.stage(texts.dropDuplicates(["id"]), "texts-once")


def link(ws: Workspace, keyed: DataFrame, sets: DataFrame, grams: DataFrame, size: int, percent: int) -> DataFrame:
    """id, root of every class that links with another."""
    w = Window.partitionBy("g")
    shared = grams.repartition("g").withColumns({"lo": F.min("id").over(w), "hi": F.max("id").over(w)})
    shared = ws.stage(shared.filter("lo < hi").select("g", "id", "n", "pos").distinct(), "prefix-shared")
    ws.release()
    # shared shingles of the set before this one; a set that can't reach the threshold with any other goes
    before = F.row_number().over(Window.partitionBy("id").orderBy("pos")) - 1
    counted = shared.withColumn("before", before).filter(
        100 * (F.col("before") + 1 + F.col("n") - F.col("pos")) >= percent * F.col("n"))
    counted = ws.stage(counted, "shared")
    ws.release(shared)
    shared = counted
    texts = _Texts(ws, keyed, sets)
    # first pivot: the member with the fewest shingles of its own, the likeliest origin of near copies
    rounds = [lambda s: star_pairs(s, [F.col("pos") - F.col("before"), F.col("n"), F.col("id")], percent),
              lambda s: star_pairs(s, [F.xxhash64("id"), F.col("id")], percent),
              lambda s: cross_pairs(s, percent)]
    roots = tested = None
    for pairs_of in rounds:
        if roots is None:
            rooted = shared.withColumn("root", F.col("id"))
        else:
            rooted = (shared.join(roots, F.col("id") == F.col("node"), "left")
                      .withColumn("root", F.coalesce("root", "id")).drop("node"))
            rooted = rooted.withColumns({"lo": F.min("root").over(w), "hi": F.max("root").over(w)}).filter("lo < hi").drop("lo", "hi")
        pairs = pairs_of(rooted)
        if tested is not None:
            pairs = pairs.join(tested.select("u", "v"), ["u", "v"], "left_anti")
        pairs = ws.stage(pairs, "pairs")
        if pairs.isEmpty() and roots is not None:
            continue
        text = texts.of(pairs)
        ws.release()
        # merge joins at every size: texts are never broadcast, and a pivot's rows stand together
        both = pairs.hint("merge").join(text.withColumnsRenamed({"id": "v", "text": "text_v"}), "v").hint("merge").join(
            text.withColumnsRenamed({"id": "u", "text": "text_u"}), "u").select("u", "v", "text_u", "text_v")
        done = ws.stage(both.mapInArrow(verify(size, percent), TESTED), "tested")
        tested = done if tested is None else tested.union(done)
        ws.release(pairs)
        roots = components(ws, tested.filter("linked").select("u", "v"))
    return roots


def near_duplicates(ws: Workspace, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest linked doc_id) of every row."""
    return rooted(ws, docs, size, percent).drop("root")


def rooted(ws: Workspace, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``near_duplicates`` with the ``root`` of each row's component, which no other has."""
    # documents with a null id are told apart by their text alone
    th, tk = text_key(F.col("doc_id"), F.col("text"))
    keyed = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("doc"), th.alias("th"), tk.alias("tk"), "text")
    rows = ws.stage(keyed.mapInArrow(set_rows(size), SETS), "sets")
    classes = docs.sparkSession.sparkContext.broadcast(rarity(rows))
    sets = rows.filter("chunk is null")
    # one 64-bit hash names a class unless two sets share it; then the other hash does
    clash = sets.groupBy("a").agg(F.min("b").alias("b0"), F.max("b").alias("b1")).filter("b0 != b1").limit(1).count()
    sets = sets.select("doc", "th", "tk", F.col("b" if clash else "a").alias("id"), "n")
    grams = keyed.select("text").mapInArrow(prefix_grams(size, percent, classes, not clash), GRAMS)
    roots = link(ws, keyed.filter("text is not null"), sets.filter("n > 0"), grams, size, percent)
    placed = sets.join(roots, F.col("id") == F.col("node"), "left").withColumn("root", F.coalesce("root", "id"))
    known = F.when(F.col("tk") % 2 == 0, F.col("doc"))
    placed = ws.stage(placed.select(known.alias("doc_id"), "th", "tk", "n", "root"), "placed")
    least = ws.stage(placed.filter("n > 0").groupBy("root").agg(F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("weight")), "least")
    out = join_by_share(placed.filter("n > 0"), least, "root", placed.count())
    out = out.unionByName(placed.filter("n = 0").withColumn("component_id", F.col("doc_id")))
    return out.select("doc_id", F.col("th").alias("text_hash"), F.col("tk").alias("text_hash2"), F.col("n").alias("n_shingles"), "component_id",
                      "root")


def keep_one(ws: Workspace, docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` less all but the document of smallest id of each component; among several
    texts of that id, or in a component without ids, the one of smallest text hash.

    Rows without shingles stay. Repeated rows of the kept document are one document
    several times; the first of them, in no particular order, stays.
    """
    cols = docs.columns
    found = rooted(ws, docs, size, percent)
    at = ["doc_id", "text_hash", "text_hash2"]
    first = found.filter((F.col("n_shingles") > 0) & F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(
        F.min(F.struct(*at, "n_shingles")).alias("first")).select("first.*")
    keep = found.filter("n_shingles = 0").select(*at, "n_shingles").distinct().union(first.distinct())
    keep = ws.stage(keep.toDF("__doc", "__th", "__tk", "__n"), "keep")
    th, tk = text_key(F.col("doc_id"), F.col("text"))
    base = docs.withColumns({"__th2": th, "__tk2": tk})
    out = base.join(keep, F.col("doc_id").cast("long").eqNullSafe(F.col("__doc")) & (F.col("__th2") == F.col("__th"))
                    & (F.col("__tk2") == F.col("__tk")))
    once = out.filter("__n > 0").dropDuplicates(["__doc", "__th", "__tk"]).select(*cols)
    return once.union(out.filter("__n = 0").select(*cols))
