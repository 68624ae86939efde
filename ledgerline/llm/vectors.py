"""Near-duplicate vectors by NN-descent.

Equal vectors are one class.  A neighbour graph of the classes starts from the
leaves of random-projection trees and is refined by NN-descent: every class
introduces its neighbours, forward and reverse, to each other and each keeps its
best.  Refining ranks by 8-bit vectors, a sixth of the bytes; links are decided by
cosine in double precision.

* A neighbour list that is full of links is saturated and may have lost some: it
  is enlarged to all saturated classes of its component, and of every component that
  shares a leaf with it and is not too far by its radius, compared in blocks.
  Components that new links join are compared in turn.  Such a comparison gives a
  count per class and a spanning forest, never a row per link.
* Recall is audited: a hashed, bounded set of classes is compared with all rows;
  below the target, further trees and rounds follow.  If that does not help, all
  classes of a label are compared in blocks.

Defined results: rows with a null label, or a vector that is null, empty, zero or
holds null or non-finite components, are linked with nothing; vectors of other
length are not compared; repeated ids count as vectors of their own; a null id
gets its row with a null component; other columns are not read; an empty table
gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import components, cut, mix

NEIGHBOURS = 12
TREES = 10
LEAF = 48
#: members that one group compares in full; larger leaves are dealt by hash
GROUP = 96
#: rounds of refinement at most, and the share of changed lists that ends them
ROUNDS = 3
SETTLED = 0.01
#: classes that the audit compares with all rows, and the recall it asks for
AUDIT = 512
RECALL = 0.99
#: classes of one block of a comparison of all
BLOCK = 2048
#: a pair this far under the threshold by 8-bit vectors is still decided exactly
SLACK = 0.02


def _unit(column: pa.Array) -> np.ndarray:
    """Rows of a list column of equal length as unit vectors."""
    x = np.asarray(column.values.slice(column.offset and column.offsets[0].as_py()) if column.offset else column.flatten(), np.float64)
    x = x.reshape(len(column), -1)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _byte(x: np.ndarray) -> np.ndarray:
    """8-bit vectors: every component over the largest of its row."""
    top = np.abs(x).max(axis=1, keepdims=True)
    return np.rint(x / top * 127).astype(np.int8)


def _from_bytes(values, count: int) -> np.ndarray:
    q = np.frombuffer(b"".join(values), np.int8).reshape(count, -1).astype(np.float32)
    return q / np.sqrt((q * q).sum(axis=1, keepdims=True))


def _leaves(trees: int, seed: int):
    """Per class and tree the key of its leaf and its 8-bit vector; as many
    hyperplanes as bring the label's classes to about ``LEAF`` a leaf."""

    def run(batches):
        for batch in batches:
            size = np.asarray(batch.column(2))
            dim = np.diff(np.asarray(batch.column(3).offsets))
            for d in np.unique(dim):
                rows = np.flatnonzero(dim == d)
                part = batch.take(pa.array(rows))
                x = _unit(part.column(3))
                q = _byte(x)
                depth = np.ceil(np.log2(np.maximum(size[rows] / LEAF, 1))).astype(np.int64)
                planes = np.random.default_rng([seed, int(d)]).standard_normal((trees, 40, int(d)))
                group = np.asarray(part.column(1)).view(np.uint64)
                for t in range(trees):
                    bits = (x @ planes[t].T > 0).astype(np.uint64)
                    kept = np.arange(40) < np.minimum(depth, 40)[:, None]
                    leaf = (bits * kept * (np.uint64(1) << np.arange(40, dtype=np.uint64))).sum(axis=1)
                    key = mix(group ^ mix(leaf + np.uint64((t + 1) << 44) + np.uint64(seed << 56)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key.view(np.int64)), part.column(0), pa.array([r.tobytes() for r in q], pa.binary())], names=["leaf", "id", "q"]
                    )

    return run


def _introduce(keep: int):
    """Of each listed group, every member's ``keep`` nearest others."""
    schema = pa.schema([("id", pa.int64()), ("other", pa.int64()), ("near", pa.float32())])

    def run(batches):
        for batch in batches:
            out = [[], [], []]
            lists = batch.column(0)
            offsets = np.asarray(lists.offsets)
            for i in range(len(lists)):
                members = lists.values.slice(offsets[i], offsets[i + 1] - offsets[i])
                ids, first = np.unique(np.asarray(members.field(0)), return_index=True)
                n = len(ids)
                if n < 2:
                    continue
                x = _from_bytes(members.field(1).take(pa.array(first)).to_pylist(), n)
                s = x @ x.T
                np.fill_diagonal(s, -2)
                k = min(keep, n - 1)
                best = np.argpartition(-s, k - 1, axis=1)[:, :k]
                out[0].append(np.repeat(ids, k))
                out[1].append(ids[best].ravel())
                out[2].append(np.take_along_axis(s, best, axis=1).ravel())
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(t)) for c, t in zip(out, (np.int64, np.int64, np.float32), strict=True)], schema=schema)

    return run


def _best(pairs: DataFrame, keep: int) -> DataFrame:
    """Each id's ``keep`` nearest; Spark limits every group before it shuffles."""
    rank = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("near"), "other"))
    return pairs.dropDuplicates(["id", "other"]).withColumn("rank", rank).where(F.col("rank") <= keep).drop("rank")


def _seed(classes: DataFrame, trees: int, seed: int, keep: int) -> tuple[DataFrame, DataFrame]:
    """A first neighbour graph, and the leaves ``(leaf, id)`` that it comes from."""
    sizes = cut(classes.groupBy("grp").agg(F.count("*").alias("n")))
    leaves = cut(classes.join(sizes, "grp").select("id", "grp", "n", "x").mapInArrow(_leaves(trees, seed), "leaf bigint, id bigint, q binary"))
    size = cut(leaves.groupBy("leaf").agg(F.count("*").alias("n")).where("n > 1"))
    dealt = leaves.join(size, "leaf").withColumn("deal", F.when(F.col("n") > GROUP, F.pmod(F.xxhash64("id", "leaf"), F.ceil(F.col("n") / (GROUP // 2)))).otherwise(0))
    lists = dealt.groupBy("leaf", "deal").agg(F.collect_list(F.struct("id", "q")).alias("m")).select("m")
    return _best(lists.mapInArrow(_introduce(keep), "id bigint, other bigint, near float"), keep), leaves.select("leaf", "id")


def _refine(graph: DataFrame, sketches: DataFrame, keep: int) -> DataFrame:
    """One round: every class introduces its forward and reverse neighbours."""
    reverse = graph.select(F.col("other").alias("id"), F.col("id").alias("other"), "near")
    lists = graph.unionByName(_best(reverse, keep))
    members = lists.select("id", F.col("other").alias("member")).unionByName(lists.select("id", F.col("id").alias("member"))).distinct()
    seen = members.join(sketches.withColumnRenamed("id", "member"), "member")
    groups = seen.groupBy("id").agg(F.collect_list(F.struct(F.col("member").alias("id"), "q")).alias("m")).select("m")
    return _best(graph.unionByName(groups.mapInArrow(_introduce(max(4, keep // 2)), "id bigint, other bigint, near float")), keep)


def _decide(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    """Of ``pairs(a, b)`` those with cosine of at least ``threshold`` in double precision."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, y = (batch.column(i) for i in (2, 3))
                cosine = (_unit(x) * _unit(y)).sum(axis=1) if _one_size(x, y) else np.array([float((_unit(x[i : i + 1]) * _unit(y[i : i + 1])).sum()) for i in range(len(x))])
                yield batch.select([0, 1]).filter(pa.array(cosine >= threshold))

    a = classes.select(F.col("id").alias("a"), F.col("x").alias("xa"))
    b = classes.select(F.col("id").alias("b"), F.col("x").alias("xb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "xa", "xb").mapInArrow(run, "a bigint, b bigint")


def _one_size(*columns: pa.Array) -> bool:
    return len(np.unique(np.concatenate([np.diff(np.asarray(c.offsets)) for c in columns]))) == 1


def _links(graph: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    near = graph.where(F.col("near") >= threshold - SLACK).select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b")).distinct()
    return cut(_decide(cut(near), classes, threshold))


def _degrees(links: DataFrame, classes: DataFrame) -> DataFrame:
    """``(id, linked)``: the vectors in the classes that each class is linked with."""
    both = links.select(F.col("a").alias("id"), F.col("b").alias("other")).unionByName(links.select(F.col("b").alias("id"), F.col("a").alias("other")))
    return both.join(classes.select(F.col("id").alias("other"), "size"), "other").groupBy("id").agg(F.sum("size").alias("linked"))


def _enlarge(links: DataFrame, graph: DataFrame, classes: DataFrame, leaves: DataFrame, threshold: float, keep: int) -> tuple[DataFrame, DataFrame]:
    """Edges ``(a, b)`` with the components of all links, and the degrees: of the known
    links, and of all among the saturated classes of each component and of components
    near each other."""
    full = cut(graph.where(F.col("near") >= threshold - SLACK).groupBy("id").agg(F.count("*").alias("k")).where(F.col("k") >= keep).select("id"))
    if full.isEmpty():
        return links, cut(_degrees(links, classes))
    part = cut(components(links).join(full, "id").select("id", F.col("component_id").alias("part")))
    inside = cut(part.join(classes.select("id", "size", "x"), "id"))
    size = cut(part.groupBy("part").agg(F.count("*").alias("n"), F.min("id").alias("lead")))
    balls = _balls(inside, size)
    homes = cut(leaves.join(part, "id").select("leaf", "part").distinct())
    meet = homes.select("leaf", F.col("part").alias("a")).join(homes.select("leaf", F.col("part").alias("b")), "leaf").where("a < b").select("a", "b").distinct()
    own = size.select(F.col("part").alias("a"), F.col("part").alias("b"))
    pairs = done = cut(own.unionByName(_touching(cut(meet), balls, threshold)))
    # two saturated classes are counted in the blocks, where every pair of parts meets once
    marked = links.join(part.select(F.col("id").alias("a"), F.lit(True).alias("sa")), "a", "left").join(part.select(F.col("id").alias("b"), F.lit(True).alias("sb")), "b", "left")
    degrees = [_degrees(marked.where("sa is null or sb is null").select("a", "b"), classes)]
    while True:
        found = cut(_blocks(pairs, inside, size, threshold))
        degrees.append(found.where("not is_edge").select(F.col("a").alias("id"), F.col("b").alias("linked")))
        links = cut(links.unionByName(found.where("is_edge").select("a", "b")).distinct())
        # parts that are one component by now are compared with each other as well
        joined = part.select("part").distinct().join(components(links), F.col("part") == F.col("id")).select("part", "component_id")
        joined = cut(joined)
        both = joined.select("component_id", F.col("part").alias("a")).join(joined.select("component_id", F.col("part").alias("b")), "component_id")
        new = cut(both.where("a < b").select("a", "b").join(done, ["a", "b"], "left_anti"))
        pairs = cut(_touching(new, balls, threshold))
        if pairs.isEmpty():
            every = degrees[0]
            for more in degrees[1:]:
                every = every.unionByName(more)
            return links, cut(every.groupBy("id").agg(F.sum("linked").alias("linked")))
        done = cut(done.unionByName(new))


def _balls(inside: DataFrame, size: DataFrame) -> DataFrame:
    """Per part a member's vector and the largest angle of any member to it."""
    leads = cut(size.select("part", F.col("lead").alias("id")).join(inside.select("id", "x"), "id").select("part", F.col("x").alias("y")))

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(_angles(batch.column(1), batch.column(2)))], names=["part", "angle"])

    angles = inside.join(leads, "part").select("part", "x", "y").mapInArrow(run, "part bigint, angle double")
    return cut(leads.join(cut(angles.groupBy("part").agg(F.max("angle").alias("radius"))), "part"))


def _angles(x: pa.Array, y: pa.Array) -> np.ndarray:
    if _one_size(x, y):
        return np.arccos(np.clip((_unit(x) * _unit(y)).sum(axis=1), -1, 1))
    return np.concatenate([_angles(x.take(pa.array([i])), y.take(pa.array([i]))) for i in range(len(x))])


def _touching(pairs: DataFrame, balls: DataFrame, threshold: float) -> DataFrame:
    """Of ``pairs(a, b)`` of parts those that can hold a link, by the triangle inequality of angles."""
    reach = float(np.arccos(min(1.0, max(-1.0, threshold)))) + 1e-6

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                room = np.asarray(batch.column(4)) + np.asarray(batch.column(5)) + reach
                yield batch.select([0, 1]).filter(pa.array(_angles(batch.column(2), batch.column(3)) <= room))

    a = balls.select(F.col("part").alias("a"), F.col("y").alias("ya"), F.col("radius").alias("ra"))
    b = balls.select(F.col("part").alias("b"), F.col("y").alias("yb"), F.col("radius").alias("rb"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "ya", "yb", "ra", "rb").mapInArrow(run, "a bigint, b bigint")


def _blocks(pairs: DataFrame, inside: DataFrame, size: DataFrame, threshold: float, block: int = 256) -> DataFrame:
    """The members ``inside(id, part, size, x)`` of each pair of parts ``(a, b)``, compared
    block by block.  A block gives no row per link: per member the vectors it is linked
    with (``a``, ``b`` with ``is_edge`` false), and for each group of linked members the
    edges from its first one (``is_edge`` true)."""
    count = size.select("part", F.ceil(F.col("n") / F.lit(block)).cast("bigint").alias("k"))
    sides = cut(pairs.join(count.select(F.col("part").alias("a"), F.col("k").alias("ka")), "a").join(count.select(F.col("part").alias("b"), F.col("k").alias("kb")), "b"))
    # a member of a meets every block of b and the other way round; a part meets
    # itself in pairs of blocks p <= q
    mine = F.pmod(F.xxhash64("id"), F.col("k"))
    every = lambda k: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(k) - 1))
    dealt = inside.join(count, "part").select("id", "size", "x", "part", mine.alias("mine"))
    apart = sides.where("a <> b")
    left = dealt.join(apart, F.col("part") == F.col("a")).withColumn("q", every("kb")).select("a", "b", F.col("mine").alias("p"), "q", F.lit(True).alias("left"), F.lit(False).alias("right"), "id", "size", "x")
    right = dealt.join(apart, F.col("part") == F.col("b")).withColumn("p", every("ka")).select("a", "b", "p", F.col("mine").alias("q"), F.lit(False).alias("left"), F.lit(True).alias("right"), "id", "size", "x")
    same = dealt.join(sides.where("a = b"), F.col("part") == F.col("a")).withColumn("other", every("ka"))
    p, q = F.least("mine", "other"), F.greatest("mine", "other")
    same = same.select("a", "b", p.alias("p"), q.alias("q"), (F.col("mine") == p).alias("left"), (F.col("mine") == q).alias("right"), "id", "size", "x")

    def run(table: pa.Table) -> pa.Table:
        x = _unit(table.column("x").combine_chunks())
        ids, weight = table.column("id").to_numpy(), table.column("size").to_numpy()
        left, right = (np.flatnonzero(table.column(c).to_numpy(zero_copy_only=False)) for c in ("left", "right"))
        r, c = np.nonzero(_cosine(x[left], x[right]) >= threshold)
        r, c = left[r], right[c]
        other = ids[r] != ids[c]
        r, c = r[other], c[other]
        linked = np.bincount(r, weights=weight[c], minlength=len(ids))
        if not np.array_equal(left, right):  # else each pair is there in both orders
            linked += np.bincount(c, weights=weight[r], minlength=len(ids))
        group = _groups(r, c, len(ids))
        edge, some = np.flatnonzero(group != np.arange(len(ids))), np.flatnonzero(linked)
        a = np.concatenate((ids[group[edge]], ids[some]))
        b = np.concatenate((ids[edge], linked[some].astype(np.int64)))
        return pa.table([pa.array(np.arange(len(a)) < len(edge)), pa.array(a), pa.array(b)], names=["is_edge", "a", "b"])

    return left.unionByName(right).unionByName(same).groupBy("a", "b", "p", "q").applyInArrow(run, "is_edge boolean, a bigint, b bigint")


def _groups(r: np.ndarray, c: np.ndarray, n: int) -> np.ndarray:
    """The first member of each member's connected group."""
    group = np.arange(n)
    while True:
        low = group.copy()
        np.minimum.at(low, r, group[c])
        np.minimum.at(low, c, group[r])
        low = low[low]
        if np.array_equal(low, group):
            return group
        group = low


def _exact(classes: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Edges and degrees of all links: every class with every other of its label and length."""
    inside = classes.select("id", "size", F.col("grp").alias("part"), "x")
    size = cut(inside.groupBy("part").agg(F.count("*").alias("n")))
    pairs = size.select(F.col("part").alias("a"), F.col("part").alias("b"))
    found = cut(_blocks(pairs, inside, size, threshold, BLOCK))
    degrees = found.where("not is_edge").groupBy(F.col("a").alias("id")).agg(F.sum("b").alias("linked"))
    return found.where("is_edge").select("a", "b").distinct(), cut(degrees)


def _cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return x @ y.T


def audit(classes: DataFrame, degrees: DataFrame, threshold: float, sample: int = AUDIT) -> tuple[int, int]:
    """Vectors linked with a hashed set of at most about ``sample`` classes by comparison
    with all rows, and how many of those ``degrees`` has.  The set reaches every task; it
    is a documented number of rows."""
    n = classes.count()
    chosen = classes.where(F.pmod(F.xxhash64("id", F.lit("audit")), F.lit(max(1, n // sample))) == 0).select("id", "grp", "x")
    rows = chosen.collect()
    if not rows:
        return 0, 0
    by_group: dict = {}
    for r in rows:
        by_group.setdefault((r["grp"], len(r["x"])), []).append((r["id"], r["x"]))

    def run(batches):
        units, total = {}, {}
        for k, v in by_group.items():
            x = np.array([y for _, y in v], np.float64)
            units[k] = (np.array([i for i, _ in v], np.int64), x / np.sqrt((x * x).sum(axis=1, keepdims=True)))
            total[k] = np.zeros(len(v), np.int64)
        for batch in batches:
            grp, ids, size = (np.asarray(batch.column(i)) for i in (1, 0, 3))
            dim = np.diff(np.asarray(batch.column(2).offsets))
            for g, d in set(zip(grp.tolist(), dim.tolist(), strict=True)):
                if (g, d) in units:
                    at = np.flatnonzero((grp == g) & (dim == d))
                    qi, qx = units[g, d]
                    r, c = np.nonzero(_cosine(_unit(batch.column(2).take(pa.array(at))), qx) >= threshold)
                    apart = ids[at[r]] != qi[c]
                    np.add.at(total[g, d], c[apart], size[at[r]][apart])
        for k, n in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(units[k][0]), pa.array(n)], names=["id", "true"])

    truth = classes.select("id", "grp", "x", "size").mapInArrow(run, "id bigint, true bigint").groupBy("id").agg(F.sum("true").alias("true"))
    held = truth.join(degrees, "id", "left").agg(F.sum("true"), F.sum(F.least("true", F.coalesce("linked", F.lit(0))))).first()
    return held[0] or 0, held[1] or 0


def near_duplicates(
    rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", threshold: float = 0.98,
    neighbours: int = NEIGHBOURS, trees: int = TREES, recall: float = RECALL,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` per row of ``rows``."""
    good = F.col("label").isNotNull() & (F.size("x") > 0) & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0)
    source = rows.select(F.col(key).alias("vec_id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("x"))
    source = source.withColumn("good", F.coalesce(good, F.lit(False)))
    # components beyond the range of squares are scaled, which leaves the cosine as it is
    top = F.array_max(F.transform("x", lambda v: F.abs(v)))
    source = source.withColumn("x", F.when(F.col("good"), F.transform("x", lambda v: v / top)))
    prints = ["fp1", "fp2"]
    source = source.withColumns({"grp": F.xxhash64("label", F.size("x")), "fp1": F.when(F.col("good"), F.xxhash64("label", "x")), "fp2": F.when(F.col("good"), F.xxhash64("x", "label", F.lit(2)))})
    source = cut(source)
    # a number per row stands for it, so that repeated and null ids stay apart
    numbered = cut(source.withColumn("row", F.monotonically_increasing_id()))
    sets = cut(numbered.where("good").groupBy(*prints).agg(F.min("row").alias("id"), F.count("*").alias("size"), F.min("vec_id").alias("least")))
    classes = cut(sets.select("id", "size").join(numbered.select(F.col("row").alias("id"), "grp", "x"), "id"))
    links, degree = _search(classes, threshold, neighbours, trees, recall)
    comps = cut(components(links))
    named = comps.join(sets.select("id", "least"), "id").groupBy("component_id").agg(F.min("least").alias("c"))
    named = comps.join(cut(named), "component_id").select("id", "c")
    facts = sets.join(degree, "id", "left").join(cut(named), "id", "left")
    facts = cut(facts.select(*prints, (F.coalesce("linked", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("c", "least").alias("c")))
    out = numbered.select("vec_id", *prints).join(facts, prints, "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("c", "vec_id"))
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"),
        F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"),
    )


def _search(classes: DataFrame, threshold: float, keep: int, trees: int, recall: float) -> tuple[DataFrame, DataFrame]:
    """Edges with the components of all links, and every class's degree."""
    sketch = lambda batches: (
        pa.RecordBatch.from_arrays([b.column(0).take(pa.array([i])), pa.array([_byte(_unit(b.column(1).take(pa.array([i]))))[0].tobytes()], pa.binary())], names=["id", "q"])
        for b in batches
        for i in range(b.num_rows)
    )
    sketches = cut(classes.select("id", "x").mapInArrow(sketch, "id bigint, q binary"))
    graph = homes = None
    for attempt in range(3):
        seeds, leaves = _seed(classes, trees * (1 + attempt), 1 + attempt, keep)
        homes = leaves if homes is None else homes.unionByName(leaves)
        graph = cut(seeds if graph is None else _best(graph.unionByName(seeds), keep))
        for _ in range(ROUNDS):
            better = cut(_refine(graph, sketches, keep))
            changed = better.join(graph, ["id", "other"], "left_anti").select("id").distinct().count()
            graph = better
            if changed <= SETTLED * max(1, graph.select("id").distinct().count()):
                break
        links, degrees = _enlarge(_links(graph, classes, threshold), graph, classes, homes, threshold, keep)
        true, found = audit(classes, degrees, threshold)
        if found >= recall * true:
            return links, degrees
    return _exact(classes, threshold)
