"""Near-duplicate detection with bottom-k sketches.

1. Every document gets the k smallest hashes of its word shingles, by one hash function. Documents with equal shingle sets
   are one class, and go on as one node.
2. Inverted lists of the retained values bring nodes together. A node is listed under its rarest values only: two sketches
   that overlap as much as a link needs must share one of those (prefix filter), and values of boilerplate drop out.
3. Inside a list, pairs are kept whose Jaccard similarity, estimated on the sketch of their union, is not clearly too low.
   A list only reports how its nodes hang together, never its pairs. Together the lists give families.
4. Inside each family the links are confirmed on the full shingle sets, and the components of confirmed links are returned.

Both filters ask for so few common values that a pair just at the threshold misses one with a chance of ``LOSS`` at most.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from placefolio.llm.common import fresh, grouped
from placefolio.llm.components import components
from placefolio.llm.words import mix, one_array, slices, windows, words
from placefolio.session import staged

SHINGLE = 5
THRESHOLD = 85  # per cent
SKETCH = 40
LOSS = 1e-9
SLICE_BYTES = 4 << 20
# A longer list, or a family with more shingles, is dealt out in blocks of about this size.
LIST_NODES = 20_000
FAMILY_SHINGLES = 4_000_000


def least_overlap(kept: int, threshold: int = THRESHOLD, sketch: int = SKETCH) -> int:
    """Values that a sketch with ``kept`` of ``sketch`` places used shares at least with that of a linked document.

    If all linked sets fit into a sketch, that is the threshold itself. Else each retained value of the union is common
    with a chance of the similarity, and the binomial tail below the result is at most ``LOSS``.
    """
    if 100 * kept <= threshold * sketch:
        return -(-threshold * kept // 100)
    t, least, tail = threshold / 100, 0, 0.0
    while True:
        tail += math.comb(kept, least) * t ** least * (1 - t) ** (kept - least)
        if tail > LOSS or least == kept:
            return max(1, least)
        least += 1


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; shorter texts are one shingle, texts without words have none."""
    w = words(texts, lower=True)
    hashes = w.hashes()
    long = windows(hashes, shingle, 11)
    out = []
    for a, b in zip(w.first.tolist(), w.first.tolist()[1:]):
        if b - a >= shingle:
            out.append(np.unique(long[a:b - shingle + 1]))
        elif b > a:
            # The length is mixed in, so that a short text never equals a shingle.
            out.append(mix(windows(hashes[a:b], b - a, 11)[:1], np.uint64(b - a), 13))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _sketcher(shingle: int, size: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(one_array(part["text"]), shingle)
                yield pa.RecordBatch.from_arrays([
                    one_array(part["doc_id"]), one_array(part["row"]), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([set_digest(s) for s in sets], pa.binary()),
                    pa.array([s[:size].view(np.int64) for s in sets], pa.list_(pa.int64())),
                    # The upper halves keep the order of the values.
                    pa.array([(s[:size] >> np.uint64(32)).astype(np.uint32).tobytes() for s in sets], pa.binary())],
                    ["doc_id", "row", "n", "digest", "retained", "sketch"])
    return run


def _estimates(one: np.ndarray, others: np.ndarray, size: int) -> np.ndarray:
    """Jaccard similarity of one sketch with others, on the bottom-k of each union. Missing values are the largest."""
    both = np.sort(np.concatenate([np.broadcast_to(one, others.shape), others], axis=1), axis=1)
    missing = both[:, 1:] == np.uint32(0xFFFFFFFF)
    twice = (both[:, 1:] == both[:, :-1]) & ~missing
    rank = np.arange(1, both.shape[1]) - np.cumsum(twice, axis=1)
    union = np.minimum(both.shape[1] - np.count_nonzero(twice, axis=1)
                       - np.count_nonzero(both == np.uint32(0xFFFFFFFF), axis=1), size)
    return np.count_nonzero(twice & (rank < size), axis=1) / np.maximum(union, 1)


def _parts(n: int, near) -> np.ndarray:
    """Component of each of ``n`` members; ``near(i, others)`` says which of the others are linked to ``i``.

    Whoever is linked to a member already placed needs no comparison with the others placed there.
    """
    part = np.full(n, -1)
    open_ = np.arange(n)
    while len(open_):
        queue, open_ = [open_[0]], open_[1:]
        first = queue[0]
        part[first] = first
        while queue and len(open_):
            found = near(queue.pop(), open_)
            new = open_[found]
            part[new] = first
            queue.extend(new.tolist())
            open_ = open_[~found]
    return part


def _list_edges(size: int, threshold: int):
    least = least_overlap(size, threshold, 0) / size

    def run(table: pa.Table):
        node = table["node"].to_numpy()
        n = table["n"].to_numpy()
        raw = table["sketch"].to_pylist()
        sketch = np.full((len(raw), size), 0xFFFFFFFF, np.uint32)
        for i, s in enumerate(raw):
            v = np.frombuffer(s, np.uint32)
            sketch[i, :len(v)] = v
        keys = [table[c].to_numpy() for c in ("value", "i", "j")]
        new = np.ones(len(node), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = np.append(np.flatnonzero(new), len(node))
        us, vs = [], []
        for a, b in zip(starts.tolist(), starts.tolist()[1:]):
            if b - a < 2:
                continue

            def near(i, others, a=a):
                # Sizes of linked sets differ by the threshold at most.
                fits = (100 * np.minimum(n[a + others], n[a + i]) >= threshold * np.maximum(n[a + others], n[a + i]))
                fits[fits] = _estimates(sketch[a + i], sketch[a + others[fits]], size) >= least
                return fits

            part = _parts(b - a, near)
            moved = np.flatnonzero(part != np.arange(b - a))
            us.append(node[a + moved])
            vs.append(node[a + part[moved]])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
    return run


def _confirmed_edges(shingle: int, threshold: int):
    def run(table: pa.Table):
        sets = shingle_sets(one_array(table["text"]), shingle)
        node, digest = table["node"].to_numpy(), table["digest"].to_pylist()
        # An id with several texts: only the text of the class counts.
        own = np.array([set_digest(s) == d for s, d in zip(sets, digest)], bool)
        keys = [table[c].to_numpy() for c in ("family", "i", "j")]
        new = np.ones(len(node), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        starts = np.append(np.flatnonzero(new), len(node))
        us, vs = [], []
        for a, b in zip(starts.tolist(), starts.tolist()[1:]):
            rows = np.flatnonzero(own[a:b]) + a
            rows = rows[np.unique(node[rows], return_index=True)[1]]
            if len(rows) < 2:
                continue
            sizes = np.array([len(sets[r]) for r in rows])
            members = np.repeat(np.arange(len(rows)), sizes)
            _, code = np.unique(np.concatenate([sets[r] for r in rows]), return_inverse=True)
            order = np.argsort(code, kind="stable")
            listed, ends = members[order], np.concatenate([[0], np.cumsum(np.bincount(code))])
            begins = np.concatenate([[0], np.cumsum(sizes)])

            def near(i, others, sizes=sizes, code=code, listed=listed, ends=ends, begins=begins, m=len(rows)):
                mine = code[begins[i]:begins[i + 1]]
                low, width = ends[mine], ends[mine + 1] - ends[mine]
                at = np.repeat(low - np.cumsum(width) + width, width) + np.arange(width.sum())
                shared = np.bincount(listed[at], minlength=m)[others]
                return 100 * shared >= threshold * (sizes[i] + sizes[others] - shared)

            part = _parts(len(rows), near)
            moved = np.flatnonzero(part != np.arange(len(rows)))
            us.append(node[rows[moved]])
            vs.append(node[rows[part[moved]]])
        if us:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], ["u", "v"])
    return run


def _block_pairs(df: DataFrame, blocks: str, node: str = "node") -> DataFrame:
    """Rows with their block pairs ``i <= j``. Groups of one block stay as they are."""
    own = F.pmod(F.xxhash64(node), F.col(blocks)).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col(blocks).cast("int") - 1))
    return (df.withColumn("own", own).withColumn("other", other)
            .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")}).drop("own", "other"))


def _linked(rows: DataFrame, group: str, capacity: int, link: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Edges ``u, v`` that hold the nodes of each group together just as all links inside it do.

    ``rows`` has ``group, node, weight, blocks``, where ``blocks`` is the weight of the group by ``capacity``, rounded up,
    and maybe more columns; ``link`` finds the edges inside each ``(group, i, j)``. Only groups of several blocks need
    more than one step: each block is linked alone, then one node of each component found so far, in pairs of blocks.
    Of what is still apart all but the largest component are compared with everything. A giant group that hangs together
    thus moves each row a few times; only one of strangers takes the square of its blocks.
    """
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    edges = link(rows.withColumns({"i": own, "j": own}))
    big = rows.where("blocks > 1")
    if big.isEmpty():
        return edges
    edges = staged(edges, "edges")
    others = [c for c in rows.columns if c not in (group, "node", "blocks")]
    blocks = lambda weight: F.ceil(weight / capacity).cast("int")

    def placed():
        found = components(edges).select(F.col("u").alias("node"), F.col("v").alias("root"))
        return big.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))

    heads = (placed().groupBy(group, "root").agg(F.min(F.struct("node", *others)).alias("head"))
             .select(group, "head.*"))
    sizes = heads.groupBy(group).agg(blocks(F.sum("weight")).alias("blocks"), F.count("*").alias("parts")).where("parts > 1")
    edges = edges.unionByName(staged(link(_block_pairs(heads.join(sizes.drop("parts"), group), "blocks")), "edges"))

    rest = staged(placed(), "placed")
    parts = rest.groupBy(group, "root").agg(F.sum("weight").alias("part"))
    sizes = (parts.groupBy(group).agg(F.max(F.struct("part", "root")).alias("main"), F.sum("part").alias("all"))
             .where(F.col("all") > F.col("main.part"))
             .select(group, F.col("main.root").alias("main"), blocks(F.col("main.part")).alias("n_main"),
                     blocks(F.col("all") - F.col("main.part")).alias("n_rest")))
    rest = rest.join(sizes, group)
    at = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    each = lambda n, fn: F.transform(F.sequence(F.lit(0), F.col(n) - 1), fn)
    pair = lambda i, j: F.struct(i.alias("i"), j.alias("j"))
    mine = at("n_rest")
    # Pairs of blocks outside the largest component have negative numbers.
    dealt = F.when(F.col("root") == F.col("main"), each("n_rest", lambda x: pair(at("n_main"), x))).otherwise(
        F.concat(each("n_main", lambda x: pair(x, mine)),
                 each("n_rest", lambda x: pair(-1 - F.least(x, mine), F.greatest(x, mine)))))
    rest = rest.select(group, "node", *others, F.explode(dealt).alias("pair")).select(group, "node", *others, "pair.*")
    return components(edges.unionByName(link(rest)))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    threshold: int = THRESHOLD, sketch: int = SKETCH) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_shingles, component_id, kept``.

    Two documents are linked if ``100 * shared >= threshold * union`` on their sets of lower-cased word shingles; a
    component is named after its smallest id, and that row is kept (of repeated rows, one). Null and empty texts have no
    shingles and are linked with nothing. Null ids are larger than all others.
    """
    return _decided(docs, doc_id, text, shingle, threshold, sketch).drop("digest")


def _decided(docs, doc_id, text, shingle, threshold, size) -> DataFrame:
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    id_type = dict(texts.dtypes)["doc_id"]
    rows = staged(texts.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _sketcher(shingle, size),
        f"doc_id {id_type}, row long, n long, digest binary, retained array<long>, sketch binary"), "sketches")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first")
    classes = rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("node"), first)
    classes = staged(classes, "classes")
    nodes = staged(rows.where("n > 0").join(classes.select(F.col("node").alias("row")), "row")
                   .select(F.col("row").alias("node"), "n", "retained", "sketch"), "nodes")

    # Inverted lists of the rarest retained values.
    listed = nodes.select("node", F.size("retained").alias("kept"), F.explode("retained").alias("value"))
    shared = listed.groupBy("value").agg(F.count("*").alias("df")).where("df > 1")
    listed = listed.join(shared, "value")
    prefixes = F.create_map(*[F.lit(x) for k in range(1, size + 1) for x in (k, k - least_overlap(k, threshold, size) + 1)])
    per_node, rarest = W.partitionBy("node"), W.partitionBy("node").orderBy("df", "value")
    # Values of a node alone come first in the order and need no list.
    rank = F.row_number().over(rarest) + F.col("kept") - F.count("*").over(per_node)
    listed = (listed.withColumn("rank", rank).where(F.col("rank") <= F.element_at(prefixes, F.col("kept")))
              .select("value", "node", F.lit(1).alias("weight"), F.ceil(F.col("df") / LIST_NODES).alias("blocks")))

    def in_lists(dealt):
        dealt = dealt.select("value", "i", "j", "node").join(nodes.select("node", "n", "sketch"), "node")
        return grouped(dealt, ["value", "i", "j"], ["node"], _list_edges(size, threshold), "u long, v long", 5000)

    families = components(_linked(staged(listed, "lists"), "value", LIST_NODES, in_lists))

    # Full sets inside the families.
    members = families.select(F.col("u").alias("node"), F.col("v").alias("family")).unionByName(
        families.select(F.col("v").alias("node"), F.col("v").alias("family")).distinct())
    members = members.join(nodes.select("node", "n"), "node")
    blocks = members.groupBy("family").agg(F.ceil(F.sum("n") / FAMILY_SHINGLES).alias("blocks"))
    members = staged(members.select("node", "family", F.col("n").alias("weight")).join(blocks, "family")
                     .join(classes.select("node", "digest", F.col("first.doc_id").alias("first_id")), "node"), "members")

    def in_families(dealt):
        # The same join at every size: a list of members that is broadcast today is not tomorrow.
        dealt = dealt.hint("merge").join(texts, F.col("first_id").eqNullSafe(F.col("doc_id")))
        return grouped(dealt.select("family", "i", "j", "node", "digest", "text"), ["family", "i", "j"], ["node"],
                       _confirmed_edges(shingle, threshold), "u long, v long", 200)

    # A family in one block reports finished components.
    links = staged(_linked(members, "family", FAMILY_SHINGLES, in_families), "links")

    found = classes.join(links.select(F.col("u").alias("node"), F.col("v").alias("root")), "node", "left")
    found = found.withColumn("root", F.coalesce("root", "node"))
    heads = found.groupBy("root").agg(F.min("first").alias("head"))
    found = found.select("digest", "root").join(heads, "root").select("digest", "head")
    head = F.coalesce("head", F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    return (rows.select("doc_id", "row", "n", "digest").join(found, "digest", "left").withColumn("head", head)
            .select("doc_id", F.col("n").alias("n_shingles"), F.col("head.doc_id").alias("component_id"),
                    (F.col("row") == F.col("head.row")).alias("kept"), "digest"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each component, and the same columns.

    Rows that repeat a kept row (same id, equal shingles) stay with it; exact de-duplication takes those.
    """
    key = fresh("near_id", docs.columns)
    sketch = {"shingle": SHINGLE, "threshold": THRESHOLD, "sketch": SKETCH} | options
    judged = _decided(docs, doc_id, text, sketch["shingle"], sketch["threshold"], sketch["sketch"])
    dropped = judged.where(~F.col("kept")).select(F.col("doc_id").alias(key)).distinct()
    kept = judged.where("kept").select(F.col("doc_id").alias(key))
    # An id with both kept and dropped rows stays, so that no text without a partner is lost.
    dropped = dropped.join(kept.withColumnRenamed(key, "k2"), F.col(key).eqNullSafe(F.col("k2")), "left_anti")
    return docs.join(dropped, F.col(doc_id).eqNullSafe(F.col(key)), "left_anti")
