"""Near-duplicate texts by a chosen-path join on sets of word shingles.

Texts with equal sets are one node. A node's set is embedded into COORDINATES minima of one
random permutation, one from each part of it, and a finer sketch of BINS such minima. A run
starts with one coordinate, and no two runs with the same; nodes with the same value there
are a bucket. Buckets up to LIMIT nodes are compared pair by pair on their sketches. Larger
ones compare LEADERS of their nodes with all others, and split further by coordinates that
the path samples at random, until no large one is left. Runs repeat until pairs at the
threshold are missed with no more than 1 - RECALL. Pairs whose sketches come near the
threshold make candidate components; in these, texts of like size are compared exactly,
block by block, so that no bucket's or group's size is capped.
"""

from __future__ import annotations

import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom.llm.common import bound_batches, cut_lineage, keyed_text, release, slices
from ledgerloom.llm.components import components
from ledgerloom.llm.stream import groups, mixed, word_hashes

WORDS = 5
COORDINATES, BINS = 64, 256
LIMIT, LEADERS, RECALL = 4096, 1024, 0.9999
#: How far a sketch's share of equal bins may be under the threshold: 4 standard deviations of it at 0.8.
SLACK = 0.1
#: Members of a large bucket that a task compares with its leaders at once; pairs whose sketches are compared at once.
CHUNK, PAIRS = 4096, 1 << 15
#: Shingles and texts of a block that is compared exactly with another.
BLOCK_SHINGLES, BLOCK = 1 << 19, 1024
COLUMNS = 1 << 12
NOTHING = -(1 << 63)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """Each text's sorted distinct hashes of five words; a shorter text's only one is all its words."""
    out = []
    for a, b in groups(texts):
        h, counts = word_hashes(texts[a:b])
        with np.errstate(over="ignore"):
            rolled = h.copy()
            for j in range(1, WORDS):
                rolled *= np.uint64(0x100000001B3)
                rolled[: len(h) - j] += h[j:]
            rolled = mixed(rolled, 5)
        at = 0
        for n in counts.tolist():
            if n >= WORDS:
                out.append(np.unique(rolled[at : at + n - WORDS + 1]))
            elif n:
                whole = np.uint64(n)
                with np.errstate(over="ignore"):
                    for x in h[at : at + n]:
                        whole = whole * np.uint64(0x100000001B3) + x
                out.append(mixed(np.array([whole]), 6))
            else:
                out.append(np.zeros(0, np.uint64))
            at += n
    return out


EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(56)
#: Each coordinate's order of others whose minimum it takes where its own part of a set is empty.
DONORS = np.argsort(mixed(np.arange(COORDINATES * COORDINATES), 13).reshape(COORDINATES, COORDINATES), 1)


def sketches(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Minima of COORDINATES equal parts of a sorted set's range, and four bits of those of BINS parts (0: empty)."""
    if not len(s):
        return np.zeros(COORDINATES, np.int32), np.zeros(BINS // 2, np.uint8)
    at = np.append(np.searchsorted(s, EDGES), len(s))
    first = s[np.minimum(at[:-1], len(s) - 1)]
    fine = np.where(at[:-1] < at[1:], first % np.uint64(15) + np.uint64(1), np.uint64(0)).astype(np.uint8)
    step = BINS // COORDINATES
    full = at[:-1:step] < at[step::step]
    own = np.where(full, np.arange(COORDINATES), DONORS[np.arange(COORDINATES), full[DONORS].argmax(1)])
    return (first[::step][own] & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32), fine[::2] << 4 | fine[1::2]


def packed(column) -> np.ndarray:
    """Sketches as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, BINS // 16)


def filled(words: np.ndarray) -> np.ndarray:
    """How many groups of four bits aren't 0."""
    words = words | words >> np.uint64(1)
    words |= words >> np.uint64(2)
    words &= np.uint64(0x1111111111111111)
    return np.bitwise_count(words).sum(-1, dtype=np.int32)


def near(x: np.ndarray, y: np.ndarray, threshold: float) -> np.ndarray:
    """Whether bins agree as often as those of sets at the threshold do, but for SLACK."""
    either = filled(x | y)
    return either - filled(x ^ y) >= (threshold - SLACK) * either


def sketch(texts: DataFrame) -> DataFrame:
    """key and the text's hash, two halves of the set's digest, its size and its sketches."""

    def run(batches):
        for b in batches:
            sets = shingle_sets(b.column("text").to_pylist())
            with np.errstate(over="ignore"):
                d1 = np.array([mixed(s, 7).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                d2 = np.array([mixed(s, 8).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
            size = np.array([len(s) for s in sets], np.int64)
            made = [sketches(s) for s in sets]
            flat = np.concatenate([m for m, _ in made]) if made else np.zeros(0, np.int32)
            where = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * COORDINATES)
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("text_hash"), pa.array(d1), pa.array(d2), pa.array(size), pa.ListArray.from_arrays(where, pa.array(flat, pa.int32())), pa.array([f.tobytes() for _, f in made], pa.binary())], names=["key", "text_hash", "d1", "d2", "size", "minima", "fine"])

    return bound_batches(texts).mapInArrow(run, "key long, text_hash long, d1 long, d2 long, size long, minima array<int>, fine binary")


def runs_for(recall: float, levels: int, threshold: float = 0.8) -> int:
    """Runs that find a pair at the threshold with probability recall at least, if its buckets split levels - 1 times.

    The pair agrees on a run's first coordinate with the threshold's probability. Further
    down a path samples 1 / threshold coordinates on average, so that one on which the pair
    agrees is among them with probability 1 - e^-p, p being that of the levels below.
    """
    p = 1.0
    for _ in range(levels - 1):
        p = 1 - math.exp(-p)
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold * p))


def children(path, threshold: float):
    """The paths below path: of each sampled coordinate, with its value."""
    odds = round(1e6 / (threshold * COORDINATES))
    taken = F.filter(F.sequence(F.lit(0), F.lit(COORDINATES - 1)), lambda i: F.pmod(F.xxhash64(path, i), F.lit(1_000_000)) < odds)
    return F.transform(taken, lambda i: F.xxhash64(path, i, F.get(F.col("minima"), i)))


def roots(first: int, last: int):
    """The paths of runs first to last - 1; after COORDINATES runs they come again, and split otherwise below."""
    order = np.argsort(mixed(np.arange(COORDINATES), 17)).tolist()
    of = lambda r: order[r % COORDINATES]
    return F.array(*[F.xxhash64(F.lit(r), F.lit(of(r)), F.get(F.col("minima"), F.lit(of(r)))) for r in range(first, last)])


def candidate_links(nodes: DataFrame, threshold: float, recall: float) -> DataFrame:
    """Links (a, b) between nodes of common buckets whose sketches agree.

    Runs are enough for pairs that are found in one level. Where buckets split further, a
    pair is rarer in all of them, so the nodes of those buckets get the runs that the deepest
    level needs.
    """
    links, done, depth, among = [], 0, 1, nodes
    while done < (runs := runs_for(recall, depth, threshold)):
        more, reached, deep = split(nodes, among, done, runs, threshold)
        links += more
        done, depth = runs, max(depth, reached)
        if deep is not None:
            among = nodes.join(deep, "node", "left_semi")
    out = links[0]
    for more in links[1:]:
        out = out.unionByName(more)
    return cut_lineage(out.distinct())


def split(nodes: DataFrame, among: DataFrame, first: int, last: int, threshold: float):
    """Links that runs first to last - 1 find among some nodes, the levels, and the nodes whose buckets split.

    Only keys and paths are shuffled to find the buckets; sketches follow for nodes that
    share one, and minima for nodes of buckets that split. Each level compares LEADERS of a
    large bucket with all its members, and they leave it. Members that agree with a leader
    get it as home: those of one home are one candidate component and need no more
    comparison, so a bucket of one home is finished. As leaders are taken outside the most
    frequent home, every large bucket comes to an end.
    """
    spark = nodes.sparkSession
    at = among.select("node", F.explode(roots(first, last)).alias("path"), F.lit(None).cast("long").alias("home"))
    fine, links, deep, level = nodes.select("node", "fine"), [], None, 0
    unit = ["path", "chunk"]
    while True:
        level += 1
        sizes = cut_lineage(buckets(at, level > 1).filter("n > 1 and n > at_home"))
        small = at.join(sizes.filter(F.col("n") <= LIMIT).select("path"), "path").join(fine, "node")
        dealt = small.repartition(slices(spark), "path").sortWithinPartitions("path", "node")
        pairs = lambda b: compare_buckets(b, threshold)
        links.append(bound_batches(dealt.select("path", "node", "home", "fine")).mapInArrow(pairs, "a long, b long"))
        if sizes.filter(F.col("n") > LIMIT).isEmpty():
            return links, level, deep
        chunks = F.ceil(F.col("n") / F.lit(CHUNK)).cast("int").alias("chunks")
        large = cut_lineage(at.join(sizes.filter(F.col("n") > LIMIT).select("path", "usual", chunks), "path"))
        place = F.row_number().over(Window.partitionBy("path").orderBy(F.col("home").eqNullSafe(F.col("usual")) & F.col("home").isNotNull(), F.xxhash64("node"), "node"))
        leaders = large.withColumn("place", place).filter(F.col("place") <= LEADERS)
        rows = leaders.select("node", "path", "home", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(0).alias("rank"))
        rows = rows.unionByName(large.select("node", "path", "home", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int").alias("chunk"), F.lit(1).alias("rank")))
        dealt = rows.join(fine, "node").repartition(slices(spark), *unit).sortWithinPartitions(*unit, "rank", "node")
        lead = lambda b: compare_leaders(b, threshold)
        met = cut_lineage(bound_batches(dealt.select(*unit, "rank", "node", "home", "fine")).mapInArrow(lead, "node long, path long, home long, leaves boolean, to array<long>"))
        links.append(met.select(F.explode("to").alias("a"), F.col("node").alias("b")))
        rest = met.filter("not leaves").select("node", "path", "home")
        rest = cut_lineage(rest.join(buckets(rest, True).filter("n > 1 and n > at_home").select("path"), "path"))
        release(large)
        if rest.isEmpty():
            return links, level, deep
        now = rest.select("node").distinct()
        deep = cut_lineage(now if deep is None else deep.union(now).distinct())
        further = rest.groupBy("node").agg(F.collect_list(F.struct("path", "home")).alias("from")).join(nodes.select("node", "minima"), "node")
        below = F.transform("from", lambda x: F.transform(children(x["path"], threshold), lambda p: F.struct(p.alias("path"), x["home"].alias("home"))))
        at = cut_lineage(further.select("node", F.explode(F.flatten(below)).alias("x")).select("node", "x.*"))


def buckets(at: DataFrame, homes: bool) -> DataFrame:
    """path, its nodes n, the most frequent home among them and the nodes that have it."""
    if not homes:
        return at.groupBy("path").agg(F.count("*").alias("n"), F.lit(None).cast("long").alias("usual"), F.lit(0).cast("long").alias("at_home"))
    own = at.groupBy("path", "home").agg(F.count("*").alias("n"))
    at_home = F.when(F.col("home").isNotNull(), F.struct("n", "home"))
    return (
        own.groupBy("path").agg(F.sum("n").alias("n"), F.max(at_home).alias("most"))
        .select("path", "n", F.col("most.home").alias("usual"), F.coalesce("most.n", F.lit(0)).alias("at_home"))
    )


def compare_leaders(batches, threshold: float):
    """Of each member of a large bucket's chunk: its home, whether it leaves as a leader, and leaders it links to.

    A chunk's first rows are the bucket's leaders (rank 0); leaders that agree count as one,
    the first, so that a member has one link to each such group.
    """
    for t in grouped(batches, ["path", "chunk"]):
        nodes, bins = t.column("node").to_numpy(), packed(t.column("fine"))
        many = int((t.column("rank").to_numpy() == 0).sum())
        lead, own = bins[:many], bins[many:]
        alike = np.stack([near(x, lead, threshold) for x in lead])
        group = roots_of(many, *np.nonzero(np.triu(alike, 1)))
        homes, to = t.column("home").to_pylist()[many:], []
        agree = np.stack([near(x, own, threshold) for x in lead], 1)
        to = [np.unique(group[row]).tolist() if row.any() else [] for row in agree]
        home = [h if h is not None else int(nodes[k[0]]) if k else None for h, k in zip(homes, to)]
        # a leader is in its own group, the others of the group come by its first
        out = [[int(nodes[g]) for g in k if nodes[g] != x] for x, k in zip(nodes[many:].tolist(), to)]
        yield pa.RecordBatch.from_pydict({
            "node": pa.array(nodes[many:]), "path": t.column("path").combine_chunks()[many:], "home": pa.array(home, pa.int64()),
            "leaves": pa.array(np.isin(nodes[many:], nodes[:many])), "to": pa.array(out, pa.list_(pa.int64())),
        })


def whole(batches, key: str):
    """Tables of all rows of some keys, from batches in which equal keys stand together; and where each key begins, then the end."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        if not t.num_rows:
            continue
        k = t.column(key).to_numpy()
        edge = np.r_[0, np.flatnonzero(k[1:] != k[:-1]) + 1]
        if len(edge) > 1:
            yield t.slice(0, edge[-1]), edge
        held = t.slice(edge[-1])
    if held is not None and held.num_rows:
        yield held, np.array([0, held.num_rows])


def grouped(batches, keys: list[str]):
    """Tables of the rows of each key, from batches in which equal keys stand together."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
        if not t.num_rows:
            continue
        k = np.stack([t.column(c).to_numpy() for c in keys], 1)
        edge = np.r_[0, np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1]
        for i, j in zip(edge[:-1], edge[1:]):
            yield t.slice(i, j - i)
        held = t.slice(edge[-1])
    if held is not None and held.num_rows:
        yield held


def roots_of(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least member of each one's tree when the pairs (i, j) are joined."""
    top = np.arange(n)
    while True:
        least, now = np.minimum(top[i], top[j]), top.copy()
        np.minimum.at(now, i, least)
        np.minimum.at(now, j, least)
        now = now[now]
        if (now == top).all():
            return top
        top = now


def compare_buckets(batches, threshold: float):
    """A spanning forest of each bucket's pairs that agree and aren't of one home."""
    for t, edge in whole(batches, "path"):
        nodes, bins = t.column("node").to_numpy(), packed(t.column("fine"))
        home = t.column("home").fill_null(NOTHING).to_numpy()
        end = np.repeat(edge[1:], np.diff(edge))
        later = end - np.arange(len(nodes)) - 1  # the pairs that a row begins
        edges = np.r_[0, np.cumsum(later)]
        linked_i, linked_j = [], []
        for start in range(0, int(edges[-1]), PAIRS):
            number = np.arange(start, min(start + PAIRS, int(edges[-1])))
            i = np.searchsorted(edges, number, side="right") - 1
            j = i + 1 + number - edges[i]
            other = (home[i] != home[j]) | (home[i] == NOTHING)
            i, j = i[other], j[other]
            yes = near(bins[i], bins[j], threshold)
            linked_i.append(i[yes])
            linked_j.append(j[yes])
        root = roots_of(len(nodes), np.concatenate(linked_i), np.concatenate(linked_j)) if linked_i else np.arange(len(nodes))
        x = np.flatnonzero(root != np.arange(len(nodes)))
        yield pa.RecordBatch.from_pydict({"a": pa.array(nodes[root[x]]), "b": pa.array(nodes[x])})


def shared(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of a has in common with each of b."""
    out = np.zeros((len(a), len(b)), np.float32)
    ta, tb = np.concatenate(a), np.concatenate(b)
    token, often = np.unique(ta, return_counts=True)
    token = token[often > 1] if a is b else np.intersect1d(token, tb)
    if not len(token):
        return out

    def places(sets, flat):
        row, column = np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.minimum(np.searchsorted(token, flat), len(token) - 1)
        keep = np.flatnonzero(token[column] == flat)
        keep = keep[np.argsort(column[keep], kind="stable")]
        return row[keep], column[keep]

    ra, ca = places(a, ta)
    rb, cb = (ra, ca) if a is b else places(b, tb)
    for start in range(0, len(token), COLUMNS):
        m = []
        for n, row, column in ((len(a), ra, ca), (len(b), rb, cb)):
            i, j = np.searchsorted(column, [start, start + COLUMNS])
            m.append(np.zeros((n, min(COLUMNS, len(token) - start)), np.float32))
            m[-1][row[i:j], column[i:j] - start] = 1
        out += m[0] @ m[1].T
    return out


def linked(a: list[np.ndarray], exact: Fraction, b: list[np.ndarray] | None = None) -> np.ndarray:
    """Whether each set of a has the similarity with each of b, or with each other one of a."""
    b, alone = (a, True) if b is None else (b, False)
    both = shared(a, b).astype(np.int64)
    if alone:
        np.fill_diagonal(both, 0)
    union = np.array([len(s) for s in a])[:, None] + np.array([len(s) for s in b])[None, :] - both
    return (both > 0) & (both * exact.denominator >= exact.numerator * union)


def verify(batches, exact: Fraction):
    """For each node of a unit: the rows it links to there, and the least node it is joined to."""
    for t in grouped(batches, ["component", "i", "j"]):
        i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
        sets = shingle_sets(t.column("text").to_pylist())
        nodes, copies = t.column("node").to_numpy(), t.column("copies").to_numpy()
        if i == j:
            x, y = np.nonzero(np.triu(linked(sets, exact), 1))
        else:
            own = t.column("own").to_numpy()
            left, right = np.flatnonzero(own == i), np.flatnonzero(own == j)
            if not len(left) or not len(right):
                continue
            x, y = np.nonzero(linked([sets[k] for k in left], exact, [sets[k] for k in right]))
            x, y = left[x], right[y]
        links = np.bincount(x, weights=copies[y], minlength=len(nodes)) + np.bincount(y, weights=copies[x], minlength=len(nodes))
        root = roots_of(len(nodes), x, y)
        yield pa.RecordBatch.from_pydict({
            "node": pa.array(nodes), "links": pa.array(links.astype(np.int64)), "root": pa.array(nodes[root]), "alone": t.column("alone").combine_chunks(),
        })


def compared(nodes: DataFrame, parts: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Of the nodes of components: the exact links of each in every pair of blocks it is in, and what they join.

    A component's nodes are dealt into zones of sizes, in which the largest set is less than
    1 / threshold times the smallest, and zones into blocks of bounded size; a block meets
    those of its own zone and the zones beside it.
    """
    exact = Fraction(str(threshold))
    info = parts.join(nodes.select("node", "copies", "key", "text_hash", "size"), "node")
    enough = (F.sum("size") <= BLOCK_SHINGLES) & (F.count("*") <= BLOCK)
    info = info.join(info.groupBy("label").agg(enough.alias("alone")), "label")
    zone = F.when(F.col("alone"), F.lit(0)).otherwise(F.floor(F.log(F.col("size")) / F.lit(math.log(1 / threshold))))
    info = cut_lineage(info.withColumn("zone", zone.cast("long")))
    blocks = info.groupBy("label", "zone").agg(F.greatest(F.ceil(F.sum("size") / F.lit(BLOCK_SHINGLES)), F.ceil(F.count("*") / F.lit(BLOCK))).cast("long").alias("blocks"))
    beside = blocks.select("label", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.col("zone") + d)).alias("zone"), F.struct("zone", "blocks").alias("other"))
    beside = beside.groupBy("label", "zone").agg(F.collect_list("other").alias("others")).join(blocks, ["label", "zone"])
    number = lambda zone, block: F.shiftleft(zone, 32) + block
    members = info.join(beside, ["label", "zone"]).select(
        "node", "copies", "key", "text_hash", F.col("label").alias("component"), "alone", "others",
        number(F.col("zone"), F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("own"))
    own = ["key", "text_hash", "node", "copies", "component", "alone", "others", "own"]
    rows = members.join(texts.filter("text is not null"), ["key", "text_hash"]).groupBy("key", "text_hash", "node").agg(*[F.any_value(c).alias(c) for c in own[3:]], F.any_value("text").alias("text"))
    meets = F.flatten(F.transform("others", lambda x: F.transform(F.sequence(F.lit(0).cast("long"), x["blocks"] - 1), lambda b: number(x["zone"], b))))
    units = rows.select("node", "copies", "component", "alone", "own", "text", F.explode(meets).alias("other")).select("*", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    unit = ["component", "i", "j"]
    dealt = units.repartition(slices(nodes.sparkSession), *unit).sortWithinPartitions(*unit, "node")
    found = cut_lineage(bound_batches(dealt.select(*unit, "node", "copies", "alone", "own", "text")).mapInArrow(lambda b: verify(b, exact), "node long, links long, root long, alone boolean"))
    release(info)
    return found


def join(docs: DataFrame, threshold: float = 0.8, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id and n_links of every row.

    n_links: the other rows whose similarity is threshold or more, copies counted; class_id:
    the least doc_id of all rows that links join. Words are runs of other characters than
    space and U+0009 to U+000D. A null or empty text, and one without words, links to
    nothing and is a class of its own, also beside its copies. A text of fewer than five
    words has one shingle; long texts count whole. Each text counts on its own, whatever
    rows share its doc_id; null counts as the least doc_id. Rows that repeat each give a row
    and link to each other. Other columns are not read; an empty table gives an empty result.
    """
    texts = keyed_text(docs).select(F.coalesce("doc_id", F.lit(NOTHING)).alias("key"), "text", F.xxhash64("text").alias("text_hash"))
    made = cut_lineage(sketch(texts))
    same = ["d1", "d2", "size"]
    sets = made.filter("size > 0").groupBy(*same).agg(F.min(F.struct("key", "text_hash")).alias("first"), F.count("*").alias("copies"), F.any_value(F.struct("minima", "fine")).alias("e"))
    nodes = cut_lineage(sets.select(F.monotonically_increasing_id().alias("node"), *same, "first.*", "copies", "e.*"))
    rows = cut_lineage(made.select("key", *same))
    release(made)
    links = candidate_links(nodes, threshold, recall)
    parts = components(links)
    release(links)
    nodes, before = cut_lineage(nodes.drop("minima", "fine")), nodes
    release(before)
    found = compared(nodes, parts, texts, threshold)
    per_node = found.groupBy("node").agg(F.sum("links").alias("links"), F.min("root").alias("root"), F.min("alone").alias("alone"))
    far = found.filter("not alone and root <> node").select(F.col("root").alias("a"), F.col("node").alias("b"))
    if not far.isEmpty():
        joined = components(far)
        per_node = per_node.join(joined, "node", "left").select("node", "links", F.when(F.col("alone"), F.col("root")).otherwise(F.coalesce("label", "node")).alias("root"))
    result = nodes.join(per_node, "node", "left").select(*same, "key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.coalesce("root", "node").alias("root"))
    result = cut_lineage(result)
    release(parts, found)
    classes = result.groupBy("root").agg(F.min("key").alias("class"))
    of = result.join(classes, "root").select(*same, "links", "class")
    back = F.when(F.col("class") != NOTHING, F.col("class"))
    return (
        rows.select("key", *same).join(of, same, "left")
        .select("key", F.coalesce("links", F.lit(0)).alias("n_links"), F.coalesce("class", "key").alias("class"))
        .select(F.when(F.col("key") != NOTHING, F.col("key")).alias("doc_id"), back.alias("class_id"), "n_links")
    )
