"""Near-duplicate documents by a chosen-path set similarity join.

Documents are sets of five-word shingles.  Each of several independent trees
branches the documents by selected minwise tokens: a node's children share one
more minwise value.  Nodes of one class die at once, small nodes are compared
exhaustively, large ones branch on.  Links are confirmed on the full sets.

* Equal sets are one class from the start, so copies never meet as pairs.  A class has
  a number of its own; a key whose rows have different texts links its classes.
* In each node every class is first compared with the node's smallest class
  only; classes that are then connected need no further comparison, so a large
  group of near copies costs one comparison a member instead of all pairs.
* Nodes that still hold two unconnected components go on.  Large ones branch on
  two further minwise tokens; a child that holds one component is dropped before it is written.  Small ones are compared exhaustively, by sketches
  first: a member stays open if its sketch agrees with one of another component.
  The full sets of a node's open members are then compared in blocks, and only a
  spanning forest of the links leaves the task.  A pair that meets in several
  small nodes is looked at in the first.
* A node that is large on the last level is compared in blocks as well, so no
  pair is lost to a size limit.

A pair at similarity s meets in a tree's root children with probability s, and
passes each later level with 1 - (1 - s)**2.  With the default eight trees the
chance that no tree finds a pair is 3e-7 at 0.85 and 3e-6 at 0.80 on the first level.

Defined results: null, empty and white-space-only texts have the empty set and
are linked with nothing; rows that repeat a key are one document, linked with
whatever any of its texts is linked with; ties go to the smallest key; other columns
are not read; a null key is linked with nothing and kept.  An empty table gives an
empty result.
"""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import components, cut, few_or_shuffled, give_back, giving_back, map_text, mix, shingle_sets

TREES = 8
SKETCH = 128
#: a node of at most so many classes is compared exhaustively
SMALL = 4096
#: members of one block of full sets
BLOCK = 256
#: levels of branching after the roots' children
LEVELS = 4
#: probability that the sketches of a pair just at the threshold agree in too few
#: bytes for its full sets to be read
MISS = 1e-5

_SALT = np.random.default_rng(85).integers(1, 1 << 63, SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def agreement(percent: int) -> int:
    """Of SKETCH minwise bytes, those that a pair must share before its full sets are
    read: a pair at ``percent`` shares fewer with a probability of at most ``MISS``."""
    # unequal minwise values still agree in one byte of 256
    p = percent / 100 + (1 - percent / 100) / 256
    tail = 0.0
    for k in range(SKETCH):
        tail += comb(SKETCH, k) * p**k * (1 - p) ** (SKETCH - k)
        if tail > MISS:
            return k
    return SKETCH


def _fingerprints(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and 128-bit fingerprint of every set."""
    sizes = np.array([len(s) for s in sets], np.int64)
    a, b = np.zeros(len(sets), np.uint64), np.zeros(len(sets), np.uint64)
    full = np.flatnonzero(sizes)
    if len(full):
        everything = np.concatenate(sets)
        at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
        a[full] = np.add.reduceat(mix(everything), at)
        b[full] = np.add.reduceat(mix(everything ^ _SALT[0]), at)
    return sizes, a, b


def _signatures(width: int):
    def run(data: np.ndarray, offsets: np.ndarray):
        sets = shingle_sets(data, offsets, width)
        sizes, a, b = _fingerprints(sets)
        n = len(sets)
        low = np.zeros((n, SKETCH), np.uint64)
        full = np.flatnonzero(sizes)
        if len(full):
            everything = np.concatenate(sets)
            at = np.concatenate(([0], np.cumsum(sizes[full])[:-1]))
            for k in range(SKETCH):
                x = everything * _SALT[k]
                x ^= x >> np.uint64(32)
                x *= _SALT[k - 1]
                low[full, k] = np.minimum.reduceat(x, at)
        roots = mix(low[:, :TREES] + np.arange(1, TREES + 1, dtype=np.uint64) * _SALT[1])
        lists = pa.ListArray.from_arrays(np.arange(0, n * TREES + 1, TREES, dtype=np.int32), pa.array(roots.ravel().view(np.int64)))
        sketch = (low >> np.uint64(40)).astype(np.uint8)
        return [sizes, a.view(np.int64), b.view(np.int64), lists, [row.tobytes() for row in sketch]]

    return run


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5) -> DataFrame:
    """Per row: set size, a 128-bit fingerprint of the set, the node keys under the
    roots, and the sketch of minwise values."""
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    return map_text(source, "text", _signatures(width), "n_shingles bigint, fp1 bigint, fp2 bigint, roots array<bigint>, sketch binary").drop("text")


def _bytes(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _whole_nodes(batches):
    """Batches cut at node borders; the rows come sorted by node."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
        node = table.column(0).to_numpy()
        if not len(node):
            continue
        last = int(np.searchsorted(node, node[-1]))
        if last:
            yield table.slice(0, last).combine_chunks()
        rest = table.slice(last)
    if rest is not None and rest.num_rows:
        yield rest.combine_chunks()


def _open(agree: int):
    """Members of each node whose sketch agrees with that of a member of another
    component, unless both meet in an earlier small node under the roots."""
    schema = pa.schema([("node", pa.int64()), ("id", pa.int64()), ("component_id", pa.int64())])

    def run(batches):
        for table in _whole_nodes(batches):
            node, comp = table.column("node").to_numpy(), table.column("component_id").to_numpy()
            sketch, tree = _bytes(table.column("sketch").combine_chunks()), table.column("tree").to_numpy()
            roots = np.asarray(table.column("met").combine_chunks().flatten()).reshape(len(node), -1)
            is_open = np.zeros(len(node), bool)
            edge = np.flatnonzero(np.diff(node)) + 1
            for lo, hi in zip(np.concatenate(([0], edge)), np.concatenate((edge, [len(node)])), strict=True):
                t = int(tree[lo])
                for p in range(lo, hi - 1):
                    rest = slice(p + 1, hi)
                    q = np.flatnonzero(((sketch[rest] == sketch[p]).sum(axis=1) >= agree) & (comp[rest] != comp[p])) + p + 1
                    if len(q) and t:
                        q = q[~((roots[q, :t] == roots[p, :t]) & (roots[p, :t] != 0)).any(axis=1)]
                    if len(q):
                        is_open[p] = True
                        is_open[q] = True
            if is_open.any():
                yield from table.select(schema.names).filter(pa.array(is_open)).to_batches()

    return run


def _children(level: int):
    """Two child keys of a node: two further minwise values of the member, chosen by
    the node, so that members which agree on one meet again."""

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.asarray(batch.column(0)).view(np.uint64)
            sketch = _bytes(batch.column(3))
            first = (mix(key + np.uint64(level)) % np.uint64(SKETCH)).astype(np.int64)
            keys = []
            for step in (0, 1 + level * 2):
                at = (first + step) % SKETCH
                value = sketch[np.arange(len(key)), at].astype(np.uint64)
                keys.append(mix(key * _SALT[2] + value * _SALT[3] + at.astype(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(keys).view(np.int64)), *(pa.concat_arrays([batch.column(c)] * 2) for c in (1, 2))], names=["node", "id", "component_id"]
            )

    return run


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Which of the edges (a, b) a spanning forest takes."""
    up = list(range(n))

    def top(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    take = np.zeros(len(a), bool)
    for i, (x, y) in enumerate(zip(a.tolist(), b.tolist(), strict=True)):
        x, y = top(x), top(y)
        if x != y:
            up[max(x, y)] = min(x, y)
            take[i] = True
    return take


def _compare(percent: int):
    """Full sets of the members of a block pair: a spanning forest of their links."""

    def run(table: pa.Table) -> pa.Table:
        ids, comp = table.column("id").to_numpy(), table.column("component_id").to_numpy()
        sets = table.column("shingles").combine_chunks()
        size = np.diff(np.asarray(sets.offsets))
        _, code, count = np.unique(np.asarray(sets.flatten()), return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(ids)), size)
        # only shingles of two members count, in column blocks of bounded width
        shared = count[code] > 1
        row, code = row[shared], (np.cumsum(count > 1) - 1)[code[shared]]
        order = np.argsort(code, kind="stable")
        row, code = row[order], code[order]
        common = np.zeros((len(ids), len(ids)), np.float32)
        width = 4096
        for c in range(0, int(code[-1]) + 1 if len(code) else 0, width):
            lo, hi = np.searchsorted(code, (c, c + width))
            m = np.zeros((len(ids), width), np.float32)
            m[row[lo:hi], code[lo:hi] - c] = 1
            common += m @ m.T
        union = size[:, None] + size[None, :] - common
        linked = (100 * common.astype(np.int64) >= percent * union.astype(np.int64)) & (comp[:, None] != comp[None, :])
        a, b = np.nonzero(np.triu(linked, 1))
        # members of one component count as one
        _, group = np.unique(comp, return_inverse=True)
        take = _forest(group[a], group[b], len(ids))
        a, b = ids[a[take]], ids[b[take]]
        out = pa.table([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])
        give_back()
        return out

    return run


FP = ["fp1", "fp2", "n_shingles"]


def _sets(width: int):
    def run(data, offsets):
        sets = shingle_sets(data, offsets, width)
        ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
        values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        sizes, a, b = _fingerprints(sets)
        return [pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64))), sizes, a.view(np.int64), b.view(np.int64)]

    return run


class _Texts:
    """The texts of classes: ``docs(key, text)`` and ``classes(id, class_doc, fp..)``."""

    def __init__(self, docs: DataFrame, classes: DataFrame, width: int):
        self.docs, self.classes, self.width = docs, classes, width

    def sets(self, ids: DataFrame) -> DataFrame:
        """``(id, shingles)`` of the classes with the given ids."""
        wanted = cut(ids.distinct().join(self.classes, "id"))
        texts = self.docs.join(few_or_shuffled(wanted.select(F.col("class_doc").alias("key")).distinct()), "key", "left_semi")
        sets = map_text(texts, "text", _sets(self.width), "shingles array<bigint>, n_shingles bigint, fp1 bigint, fp2 bigint").drop("text")
        # a key may have further texts: the class is the one with its fingerprint
        return sets.join(wanted.withColumnRenamed("class_doc", "key"), ["key", *FP]).select("id", "shingles")


def verified(pairs: DataFrame, texts: _Texts, percent: int) -> DataFrame:
    """Of ``pairs(a, b)`` those whose full sets have 100 * intersection >= percent * union."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id")))
    sets = cut(texts.sets(ids))
    a = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    b = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    inter = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(a, "a")
        .join(b, "b")
        .select("a", "b", inter.alias("i"), (F.size("sa") + F.size("sb") - inter).alias("u"))
        .where(F.col("i") * 100 >= F.col("u") * percent)
        .select("a", "b")
        .distinct()
    )


def _one_text_a_row(docs: DataFrame, sig: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``docs(key, text)`` with rows of one key and text once, and the keys that have
    different sets."""
    lo, hi = F.min(F.struct(*FP)), F.max(F.struct(*FP))
    again = cut(sig.groupBy(F.col("doc_id").alias("key")).agg(F.count("*").alias("n"), (lo != hi).alias("differs")).where("n > 1").select("key", "differs"))
    if again.isEmpty():
        return docs, again.select("key")
    ids = few_or_shuffled(again.select("key"))
    once = docs.join(ids, "key", "left_semi").dropDuplicates(["key", "text"])
    return docs.join(ids, "key", "left_anti").unionByName(once), again.where("differs").select("key")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = 85, width: int = 5) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` per row of ``docs``: links are pairs
    with 100 * intersection >= percent * union, components their closure."""
    agree = agreement(percent)
    sig = cut(signatures(docs, key, text, width))
    named = sig.where("doc_id is not null")
    linked = named.where("n_shingles > 0")
    docs, several = _one_text_a_row(docs.select(F.col(key).alias("key"), F.col(text).alias("text")).where("key is not null"), named)
    classes = cut(linked.groupBy(*FP).agg(F.min("doc_id").alias("class_doc")).withColumn("id", F.monotonically_increasing_id()))
    texts = _Texts(docs, classes, width)
    # a class's smallest key and fingerprint name one row, or equal ones
    rows = linked.select(F.col("doc_id").alias("class_doc"), *FP, "roots", "sketch")
    members = cut(classes.join(rows, ["class_doc", *FP]).select("id", "roots", "sketch").dropDuplicates(["id"]))
    nodes = _alive(members.select(F.posexplode("roots").alias("tree", "node"), "id"))
    stars = _agree(nodes.where("id <> lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), members.select("id", "sketch"), agree)
    # a class first meets the smallest of its leads
    stars = cut(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    links = cut(verified(stars, texts, percent).unionByName(_same_key(several, linked, classes)))
    comps = cut(components(links))

    nodes = _mixed(nodes, comps)
    small_roots = nodes.where(F.col("n") <= SMALL).groupBy("id").agg(F.collect_set("node").alias("small"))
    met = F.transform("roots", lambda r: F.when(F.array_contains("small", r), r).otherwise(F.lit(0)))
    known = members.join(small_roots, "id", "left").select("id", "sketch", F.when(F.col("small").isNull(), F.transform("roots", lambda r: F.lit(0).cast("bigint"))).otherwise(met).alias("met"))
    known = cut(known)
    found = []
    for level in range(LEVELS + 1):
        if nodes.isEmpty():
            break
        last = level == LEVELS
        held = nodes.join(known, "id")
        # what is still large on the last level goes in blocks, each meeting each other
        small = _blocks(held) if last else held.where(F.col("n") <= SMALL)
        small = small.select("node", "id", "component_id", "tree", "sketch", "met")
        small = small.repartition("node").sortWithinPartitions("node", "id")
        found.append(cut(small.mapInArrow(giving_back(_open(agree)), "node bigint, id bigint, component_id bigint")))
        if last:
            break
        large = held.where(F.col("n") > SMALL).select("node", "id", "component_id", "sketch")
        # pairs under later nodes are skipped if they meet in any small node under the roots
        nodes = _apart(large.mapInArrow(giving_back(_children(level)), "node bigint, id bigint, component_id bigint"))
    links = links.unionByName(_exhaustive(found, texts, percent))
    comps = cut(components(links))

    # a component's id is its smallest key
    joined = cut(classes.join(comps, "id", "left").withColumn("component_id", F.coalesce("component_id", "id")))
    least = cut(joined.groupBy("component_id").agg(F.min("class_doc").alias("c")))
    own = cut(joined.join(least, "component_id").select(*FP, "c"))
    # the signatures are the side that may hold one class a third of the time; both
    # sides are shuffled straight from files, so the join can split it
    out = sig.select("doc_id", *FP).join(own, FP, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "doc_id"))
    if not several.isEmpty():  # a text without words belongs to its key's other texts
        mine = linked.join(several.withColumnRenamed("key", "doc_id"), "doc_id", "left_semi").select("doc_id", *FP).join(own, FP)
        out = out.join(cut(mine.groupBy("doc_id").agg(F.min("c").alias("of_key"))), "doc_id", "left")
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("c", "of_key", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def _same_key(several: DataFrame, linked: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of keys that have different texts."""
    if several.isEmpty():
        return several.sparkSession.createDataFrame([], "a bigint, b bigint")
    own = cut(linked.join(several.withColumnRenamed("key", "doc_id"), "doc_id", "left_semi").select("doc_id", *FP).distinct().join(classes, FP).select("doc_id", "id"))
    first = cut(own.groupBy("doc_id").agg(F.min("id").alias("a")))
    return own.join(first, "doc_id").where("id <> a").select("a", F.col("id").alias("b")).distinct()


def _alive(nodes: DataFrame) -> DataFrame:
    """Nodes of two or more classes, with their size and smallest class."""
    alive = cut(nodes.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("lead")).where("n > 1"))
    return cut(nodes.join(alive, "node"))  # both sides are shuffled straight: a hot node can be split


def _mixed(nodes: DataFrame, comps: DataFrame) -> DataFrame:
    """Members of the nodes that still hold more than one component."""
    held = cut(nodes.join(comps, "id", "left").withColumn("component_id", F.coalesce("component_id", "id")))
    apart = held.groupBy("node").agg(F.min("component_id").alias("c0"), F.max("component_id").alias("c1"))
    return cut(held.join(cut(apart.where("c0 <> c1").select("node")), "node"))


def _apart(children: DataFrame) -> DataFrame:
    """Children with members of two components, as ``_mixed`` gives the roots' children."""
    held = children.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("lead"), F.min("component_id").alias("c0"), F.max("component_id").alias("c1"))
    kept = cut(held.where("c0 <> c1").select("node", "n", "lead"))
    return cut(children.join(kept, "node").select(F.lit(TREES).alias("tree"), "node", "id", "component_id", "n", "lead"))


def _exhaustive(found: list[DataFrame], texts: _Texts, percent: int) -> DataFrame:
    """Links among the open members of every node, from their full sets."""
    spark = texts.docs.sparkSession
    if not found:
        return spark.createDataFrame([], "a bigint, b bigint")
    members = found[0]
    for more in found[1:]:
        members = members.unionByName(more)
    # a node whose open members are one component has nothing left to compare
    size = members.groupBy("node").agg(F.count("*").alias("n"))
    members = members.join(cut(size), "node")
    members = cut(_blocks(members, BLOCK))
    sets = cut(texts.sets(members.select("id")))
    return cut(members.select("node", "id", "component_id").join(sets, "id").groupBy("node").applyInArrow(_compare(percent), "a bigint, b bigint").distinct())


def _blocks(held: DataFrame, size: int = 256) -> DataFrame:
    """Split nodes of more than ``size`` members so that each pair of blocks is one group."""
    blocks = F.ceil(F.col("n") / F.lit(size))
    mine = F.pmod(F.xxhash64("id"), blocks)
    other = F.explode(F.sequence(F.lit(0).cast("bigint"), blocks.cast("bigint") - 1))
    # a single block keeps the node's key
    return (
        held.withColumn("mine", mine.cast("bigint"))
        .withColumn("other", other)
        .withColumn("node", F.when(blocks == 1, F.col("node")).otherwise(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other"))))
        .drop("mine", "other")
    )


def _agree(pairs: DataFrame, sketches: DataFrame, agree: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield batch.select([0, 1]).filter(pa.array((_bytes(batch.column(2)) == _bytes(batch.column(3))).sum(axis=1) >= agree))

    a = sketches.select(F.col("id").alias("a"), F.col("sketch").alias("x"))
    b = sketches.select(F.col("id").alias("b"), F.col("sketch").alias("y"))
    both = pairs.join(a, "a").join(b, "b").select("a", "b", "x", "y")
    return both.mapInArrow(giving_back(run), "a bigint, b bigint")
