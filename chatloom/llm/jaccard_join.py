"""N-gram Jaccard join by chosen paths.

A text's set is its lower-cased five-word shingles. Each set is embedded as T MinHash values; the shared
tokens of two sets are then the coordinates on which their values agree. A run descends a tree: a node's
own hash samples about 1/threshold of the T coordinates, and a set goes to one child for each sampled
coordinate, named by its value there. Nodes with few sets are compared by brute force on the embeddings;
sets in larger nodes descend again. Runs repeat until a pair at the threshold meets with the target recall.

Two sets of runs do this at a cost that follows the data. The first runs end at depth 1, where nodes of most
texts are small: few runs reach the target there. Sets of larger nodes are first compared in hashed blocks,
which connects crowds of near copies. What the nodes find are candidate links; a node reports the spanning
forest of the greatest agreements, which also connects what its sure links (agreement over the threshold by
some) connect, so no group is expanded into pairs. Candidate groups of up to LOOSE sets stay as they are; larger ones, which common passages
chain together, are cut to what sure links connect. Only sets that lie in a large node or large group whose
sets are not all in one group by then take part in the second runs. These are as many as leaves of depth DEEP
need, begin at depth START (a set's path depends on its own embedding alone, so no data moves for the levels
above) and go on, inside tasks once a node fits there, until nodes are small or hold one group; there the
candidates that connect different groups, again spanning forests of the greatest agreements, are reported, and
confirmed exactly. So their rows grow with the sets, not pairs.

In the groups that result every pair of sets is compared exactly, in blocks of BLOCK sets by BLOCK sets, and a
block reports its sets' numbers of links and a spanning forest of them. Classes are the connected components
of the confirmed links.

Equal word sequences are one class of copies from the start (only their first doc_id takes part), so copies
are never expanded into pairs. A text with one to four words has one shingle of all its words; a text
without words (null, empty) is similar to none and is a class of its own.
Defined results: one row per distinct doc_id of the input, with class_id (the least doc_id of its connected
component) and n_links (other documents that are copies of its text or whose set is linked with its set).
Rows with a null doc_id are left out; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatloom.llm.common import stored, table, words
from chatloom.llm.textops import chunks, mix, shingle_hashes, span_hashes, word_spans
from chatloom.operators.components import connected

T = 128
THRESHOLD = 0.8
RECALL = 0.999
#: Depth at which the second runs begin, and depth of a leaf that they are enough for.
START, DEEP = 3, 8
#: Nodes of this many sets or fewer are compared by brute force.
SMALL = 48
#: Nodes of this many sets or fewer are descended from inside one task.
LOCAL = 4096
#: Levels that nodes over LOCAL are descended from by shuffles, and levels inside a task, before what is left is compared in full.
LEVELS, LOCAL_LEVELS = 16, 24
#: Sets of a candidate group that is compared in full without more ado.
LOOSE = 1024
#: Sets on either side of a block of exact comparisons.
BLOCK = 256
#: Embeddings that agree on fewer coordinates than this below the threshold are not confirmed (four standard deviations);
#: on more than a quarter of it above, they are taken as close.
SLACK = 4 * math.sqrt(THRESHOLD * (1 - THRESHOLD) / T)
LEAST, SURE = (THRESHOLD - SLACK) * T, (THRESHOLD + SLACK / 4) * T
#: Spanning forests of a leaf's candidates that the second runs confirm, one after the other.
FORESTS = 2


def level_recall(depth: int, threshold: float = THRESHOLD, t: int = T) -> float:
    """Chance that a pair at the threshold shares a node at the depth, in one run."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - p * threshold / (threshold * t)) ** t
    return p


def runs_for(depth: int, recall: float = RECALL, threshold: float = THRESHOLD) -> int:
    """Runs after which a pair at the threshold has shared a node of the depth with the target recall."""
    return math.ceil(math.log(1 - recall) / math.log(1 - level_recall(depth, threshold)))


_SEEDS = mix(np.arange(1, T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def sketch_rows(hashes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """T 32-bit MinHash values per row; rows without shingles get all ones."""
    out = np.full((len(at) - 1, T), 0xFFFFFFFF, dtype=np.uint32)
    full = np.flatnonzero(np.diff(at) > 0)
    if not len(full):
        return out
    low = (hashes & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    high = (hashes >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
    for j in range(T):
        a, b = np.uint32(_SEEDS[j] & np.uint64(0xFFFFFFFF)) | np.uint32(1), np.uint32(_SEEDS[j] >> np.uint64(32))
        x = (low ^ b) * a + high * (b | np.uint32(1))
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        x ^= x >> np.uint32(12)
        out[full, j] = np.minimum.reduceat(x, at[full])
    return out


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            starts, ends, first = word_spans(data, offsets)
            hashes, at = shingle_hashes(span_hashes(data, starts, ends), first)
            rows = sketch_rows(hashes, at)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("copy_key"),
                    pa.array(np.diff(first) > 0),
                    pa.array([r.tobytes() for r in rows], pa.binary()),
                ],
                ["doc_id", "copy_key", "has_words", "sketch"],
            )


def _sampled(node: np.ndarray) -> np.ndarray:
    """The coordinates that a node, an array of one, samples."""
    return np.flatnonzero(mix(node + _SEEDS) < np.uint64(int(2**64 / (THRESHOLD * T))))


def _child(node: np.ndarray, coordinate: int, value: np.ndarray) -> np.ndarray:
    return mix(mix(node + np.uint64(coordinate)) ^ value.astype(np.uint64))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, T)


def _children(nodes: np.ndarray, at: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(child, index into rows) of the sets rows[at], each in the node of its place."""
    out, where = [np.zeros(0, dtype=np.uint64)], [np.zeros(0, dtype=np.int64)]
    limit = np.uint64(int(2**64 / (THRESHOLD * T)))
    for c in range(T):
        own = np.flatnonzero(mix(nodes + _SEEDS[c]) < limit)
        out.append(_child(nodes[own], c, rows[at[own], c]))
        where.append(at[own])
    return np.concatenate(out), np.concatenate(where)


def _paths(batches: Iterator[pa.RecordBatch], first: int, runs: int, depth: int) -> Iterator[pa.RecordBatch]:
    """Rows (node, doc_id): the nodes of the depth that each set comes to in the runs from the first on."""
    tops = mix(np.arange(first + 1, first + runs + 1, dtype=np.uint64))
    for batch in batches:
        ids, rows = batch.column("doc_id").to_numpy(zero_copy_only=False), _matrix(batch.column("sketch"))
        for k in range(len(tops)) if len(ids) else []:
            # All sets stand at the top, whose coordinates are sampled once.
            picked, every = _sampled(tops[k : k + 1]), np.arange(len(ids))
            nodes = np.concatenate([np.zeros(0, dtype=np.uint64), *(_child(tops[k : k + 1], c, rows[:, c]) for c in picked)])
            at = np.tile(every, len(picked))
            for _ in range(depth - 1):
                nodes, at = _children(nodes, at, rows)
            if len(at):
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), pa.array(ids[at])], ["node", "doc_id"])


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, doc_id) one level down."""
    for batch in batches:
        if len(batch):
            ids, nodes = batch.column("doc_id").to_numpy(zero_copy_only=False), batch.column("node").to_numpy(zero_copy_only=False).view(np.uint64)
            child, at = _children(nodes, np.arange(len(ids)), _matrix(batch.column("sketch")))
            yield pa.RecordBatch.from_arrays([pa.array(child.view(np.int64)), pa.array(ids[at])], ["node", "doc_id"])


def _runs_of_equals(batches: Iterator[pa.RecordBatch], key: Callable[[pa.RecordBatch], np.ndarray], rows: int) -> Iterator[pa.RecordBatch]:
    """The batches cut anew so that rows of equal key, which come together, are never apart; about rows rows each."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if len(batch):
            held.append(batch)
        if sum(map(len, held)) < rows:
            continue
        whole = pa.concat_batches(held)
        keys = key(whole)
        cut = int(np.flatnonzero(keys != keys[-1])[-1]) + 1 if (keys != keys[-1]).any() else 0
        if cut:
            yield whole.slice(0, cut)
        held = [whole.slice(cut)]
    if held:
        yield pa.concat_batches(held)


def _edges_of(keys: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def forest(near: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the symmetric boolean matrix connects, one less than members for each group."""
    label, out = np.arange(len(near)), []
    for i in range(len(near)):
        for j in np.flatnonzero(near[i, i + 1 :]) + i + 1:
            if label[j] != label[i]:
                out.append((i, int(j)))
                label[label == label[j]] = label[i]
    return out


def spanning(agree: np.ndarray, least: float) -> list[tuple[int, int, int]]:
    """(i, j, agreement) of the spanning forest of the greatest agreements of at least least."""
    best, parent, out = agree[0].copy(), np.zeros(len(agree), dtype=np.int64), []
    best[0] = -1
    for _ in range(len(agree) - 1):
        j = int(best.argmax())
        if best[j] >= least:
            out.append((int(parent[j]), j, int(best[j])))
        closer = (agree[j] > best) & (best >= 0)
        parent[closer], best[closer] = j, agree[j][closer]
        best[j] = -1
    return out


def _agreements(rows: np.ndarray) -> np.ndarray:
    """On how many coordinates each two of the embeddings agree; none with itself."""
    out = np.array([(rows == rows[i]).sum(axis=1) for i in range(len(rows))])
    np.fill_diagonal(out, 0)
    return out


def _links(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    a, b, sure = (np.concatenate([p[k] for p in parts]) if parts else np.zeros(0, dtype=np.int64) for k in range(3))
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(sure.astype(bool))], ["a", "b", "sure"])


LINKS = "a long, b long, sure boolean"


def _brute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Within runs of equal node the spanning forest of the embeddings that agree enough; no node has over a few SMALL."""
    for batch in _runs_of_equals(batches, lambda b: b.column("node").to_numpy(zero_copy_only=False), 4000):
        nodes, ids = batch.column("node").to_numpy(zero_copy_only=False), batch.column("doc_id").to_numpy(zero_copy_only=False)
        rows = _matrix(batch.column("sketch"))
        edges = _edges_of(nodes)
        sizes = np.diff(edges)
        two = edges[:-1][sizes == 2]
        agree = (rows[two] == rows[two + 1]).sum(axis=1)
        two, agree = two[agree >= LEAST], agree[agree >= LEAST]
        parts = [(ids[two], ids[two + 1], agree >= SURE)]
        for s, n in zip(edges[:-1][sizes > 2], sizes[sizes > 2], strict=True):
            if links := spanning(_agreements(rows[s : s + n]), LEAST):
                i, j, agree = np.array(links).T
                parts.append((ids[s + i], ids[s + j], agree >= SURE))
        yield _links(parts)


def cross_pairs(node: np.uint64, rows: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, sure) that connect the embeddings with different labels that agree enough, found in the small nodes of the tree below node."""
    found = [np.zeros((3, 0), dtype=np.int64)]
    todo = [(np.array([node]), np.arange(len(rows)), 0)]
    while todo:
        key, at, depth = todo.pop()
        if (labels[at] == labels[at[0]]).all():
            continue
        if len(at) <= SMALL or depth >= LOCAL_LEVELS:
            agree = _agreements(rows[at])
            # One label's sets are together before all else.
            agree[labels[at][:, None] == labels[at][None, :]] = T + 1
            for _ in range(FORESTS):
                links = np.array([x for x in spanning(agree, LEAST) if x[2] <= T], dtype=np.int64).reshape(-1, 3)
                i, j = links[:, 0], links[:, 1]
                agree[i, j] = agree[j, i] = 0
                found.append(np.stack([np.minimum(at[i], at[j]), np.maximum(at[i], at[j]), links[:, 2] >= SURE]))
            continue
        for c in _sampled(key):
            order = at[np.argsort(rows[at, c], kind="stable")]
            edges = _edges_of(rows[order, c])
            for s, e in zip(edges[:-1], edges[1:], strict=True):
                if e - s > 1:
                    todo.append((_child(key, c, rows[order[s : s + 1], c]), np.sort(order[s:e]), depth + 1))
    i, j, sure = np.unique(np.concatenate(found, axis=1), axis=1)
    return i, j, sure


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """cross_pairs within runs of equal node."""
    for batch in _runs_of_equals(batches, lambda b: b.column("node").to_numpy(zero_copy_only=False), 4000):
        nodes, ids, labels = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("node", "doc_id", "label"))
        rows = _matrix(batch.column("sketch"))
        edges, parts = _edges_of(nodes), []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            i, j, sure = cross_pairs(nodes[s : s + 1].view(np.uint64)[0], rows[s:e], labels[s:e])
            parts.append((ids[s + i], ids[s + j], sure))
        yield _links(parts)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each text's sorted distinct shingle hashes as bytes."""
    for batch in batches:
        for part, data, offsets in chunks(batch, "text"):
            starts, ends, first = word_spans(data, offsets)
            hashes, at = shingle_hashes(span_hashes(data, starts, ends), first)
            sets = [np.unique(hashes[at[i] : at[i + 1]]).tobytes() for i in range(len(at) - 1)]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sets, pa.binary())], ["doc_id", "shingles"])


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two of the sets share."""
    n = len(sets)
    if n == 2:
        both = np.sort(np.concatenate(sets))
        shared = int((both[1:] == both[:-1]).sum())
        return np.array([[len(sets[0]), shared], [shared, len(sets[1])]], dtype=np.float32)
    values, inverse, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    member = np.repeat(np.arange(n), [len(x) for x in sets])
    out = np.diag([float(len(x)) for x in sets]).astype(np.float32)
    keep = counts[inverse] > 1
    column, member = (np.cumsum(counts > 1) - 1)[inverse[keep]], member[keep]
    order = np.argsort(column, kind="stable")
    column, member = column[order], member[order]
    total, width = int((counts > 1).sum()), 4096
    shared = np.zeros((n, n), dtype=np.float32)
    for low in range(0, total, width):
        a, b = np.searchsorted(column, [low, low + width])
        dense = np.zeros((n, min(width, total - low)), dtype=np.float32)
        dense[member[a:b], column[a:b] - low] = 1
        shared += dense @ dense.T
    np.fill_diagonal(shared, 0)
    return out + shared


def _count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each block of rows: (a, links) of every set with links, and (a, b) of a spanning forest of the links."""
    for batch in _runs_of_equals(batches, lambda b: b.column("block").to_numpy(zero_copy_only=False), 1000):
        ids, copies = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "n_copies"))
        side, same = (batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in ("side", "same"))
        sets = [np.frombuffer(x, dtype=np.uint64) for x in batch.column("shingles").to_pylist()]
        edges = _edges_of(batch.column("block").to_numpy(zero_copy_only=False))
        a, b, links = [], [], []
        for s, e in zip(edges[:-1], edges[1:], strict=True):
            if e - s < 2:
                continue
            common = common_counts(sets[s:e])
            size = np.diag(common)
            near = 5 * common >= 4 * (size[:, None] + size[None, :] - common)
            np.fill_diagonal(near, False)
            if not same[s]:
                near &= side[s:e, None] != side[None, s:e]
            for i, j in forest(near):
                a.append(ids[s + i]), b.append(ids[s + j]), links.append(0)
            for i in np.flatnonzero(near.any(axis=1)):
                a.append(ids[s + i]), b.append(None), links.append(int(copies[s:e][near[i]].sum()))
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(links, pa.int64())], ["a", "b", "links"])


def copies_and_sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, copy_key, has_words, sketch), one row per document."""
    text = F.array_join(words(F.lower("text")), " ")
    keyed = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", F.md5(text).alias("copy_key"))
    return keyed.mapInArrow(_sketches, "doc_id long, copy_key string, has_words boolean, sketch binary")


def first_links(sketches: DataFrame, n_reduce: int) -> tuple[DataFrame, DataFrame]:
    """(a, b, sure) that connect the texts whose embeddings agree enough in the first runs' nodes, and (node, doc_id) of the large nodes."""
    rows = stored(sketches.mapInArrow(lambda b: _paths(b, 0, runs_for(1), 1), "node long, doc_id long"), "nodes")
    sizes = stored(rows.groupBy("node").agg(F.count("*").alias("n")).where("n > 1"), "node-sizes")
    sized = rows.join(sizes, "node")
    block = F.xxhash64("node", F.pmod(F.xxhash64("doc_id", "node"), F.ceil(F.col("n") / (SMALL / 2)).cast("long")))
    near = (
        sized.select(F.when(F.col("n") <= SMALL, F.col("node")).otherwise(block).alias("node"), "doc_id")
        .join(sketches.select("doc_id", "sketch"), "doc_id")
        .repartition(n_reduce, "node").sortWithinPartitions("node", "doc_id")
        .mapInArrow(_brute, LINKS)
    )
    found = stored(near.groupBy("a", "b").agg(F.max("sure").alias("sure")), "candidates")
    return found, stored(sized.where(F.col("n") > SMALL).select("node", "doc_id"), "large-nodes")


def _mixed(members: DataFrame, group: str) -> DataFrame:
    """(doc_id,) of the groups of members(group, doc_id, label) that hold several labels."""
    several = members.groupBy(group).agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
    return members.join(several.select(group), group, "left_semi").select("doc_id")


def second_links(hard: DataFrame, n_reduce: int) -> DataFrame:
    """Distinct (a, b, sure), of different labels, that agree enough in the second runs' nodes over hard(doc_id, label, sketch)."""
    runs, found = runs_for(DEEP), []
    rows = stored(hard.select("doc_id", "sketch").mapInArrow(lambda b: _paths(b, 1 << 20, runs, START), "node long, doc_id long").distinct(), "nodes")
    labels = hard.select("doc_id", "label")
    for level in range(LEVELS + 1):
        own = rows.join(labels, "doc_id")
        live = own.groupBy("node").agg(F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")).where("low < high")
        own = stored(rows.join(stored(live.select("node", "n"), "live"), "node"), "live-nodes")
        small = own.where(F.col("n") <= LOCAL).select("node", "doc_id")
        large = own.where(F.col("n") > LOCAL)
        if level == LEVELS:
            # Every two blocks of what is still large make a node of their own.
            blocks = F.ceil(F.col("n") / (LOCAL / 2)).cast("int")
            mine = large.select("node", "doc_id", blocks.alias("blocks"), F.pmod(F.xxhash64("doc_id"), blocks).alias("mine"))
            paired = mine.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            small = small.unionByName(paired.select(F.xxhash64("node", F.least("mine", "other"), F.greatest("mine", "other")).alias("node"), "doc_id"))
        near = (
            small.join(hard, "doc_id").select("node", "doc_id", "label", "sketch")
            .repartition(n_reduce, "node").sortWithinPartitions("node", "doc_id")
            .mapInArrow(_search, LINKS)
        )
        found.append(stored(near.groupBy("a", "b").agg(F.max("sure").alias("sure")), "candidates"))
        if level == LEVELS or not large.head(1):
            break
        rows = stored(large.join(hard, "doc_id").select("node", "doc_id", "sketch").mapInArrow(_descend, "node long, doc_id long").distinct(), "nodes")
    every = found[0]
    for df in found[1:]:
        every = every.unionByName(df)
    return every.distinct()


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) of the rows whose two sets are similar."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist(), strict=True):
            one, two = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
            shared = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(5 * shared >= 4 * (len(one) + len(two) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def confirmed(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The (a, b) of pairs whose sets are similar, exactly."""
    ids = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
    sets = stored(docs.select("doc_id", "text").join(ids.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(_sets, "doc_id long, shingles binary"), "sets")
    one, two = (sets.select(F.col("doc_id").alias(c), F.col("shingles").alias(n)) for c, n in (("a", "one"), ("b", "two")))
    return pairs.join(one, "a").join(two, "b").mapInArrow(_confirm, "a long, b long")


def candidate_groups(docs: DataFrame, sketches: DataFrame, n_reduce: int) -> DataFrame:
    """(node, component): groups of sets that hold every two similar ones, but for the recall's rest; sets without a candidate are left out."""
    found, large = first_links(sketches, n_reduce)
    loose = connected(found).withColumnRenamed("component", "crowd")
    crowds = stored(loose.groupBy("crowd").agg(F.count("*").alias("n")).where(F.col("n") > LOOSE).select("crowd"), "crowds")
    if crowds.head(1):
        crowded = stored(loose.join(crowds, "crowd", "left_semi"), "crowded")
        in_crowd = crowded.select(F.col("node").alias("a"), F.lit(True).alias("crowded"))
        kept = stored(found.join(in_crowd, "a", "left").where(F.col("crowded").isNull() | F.col("sure")).select("a", "b"), "kept")
        groups = connected(kept)
    else:
        crowded, kept, groups = None, found.select("a", "b"), loose.withColumnRenamed("crowd", "component")
    labels = groups.select(F.col("node").alias("doc_id"), F.col("component").alias("label"))

    def labelled(df: DataFrame) -> DataFrame:
        return df.join(labels, "doc_id", "left").withColumn("label", F.coalesce("label", "doc_id"))

    hard = _mixed(stored(labelled(large), "labelled"), "node")
    if crowded is not None:
        hard = hard.unionByName(_mixed(stored(labelled(crowded.withColumnRenamed("node", "doc_id")), "labelled"), "crowd"))
    hard = stored(hard.distinct(), "hard")
    if not hard.head(1):
        return groups
    pairs = stored(second_links(stored(labelled(hard).join(sketches.select("doc_id", "sketch"), "doc_id"), "hard-sketches"), n_reduce), "pairs")
    more = pairs.where("sure").select("a", "b").unionByName(confirmed(docs, pairs.where("NOT sure").select("a", "b")))
    return connected(kept.unionByName(more))


def links_in_groups(docs: DataFrame, groups: DataFrame, copies: DataFrame, n_reduce: int) -> DataFrame:
    """(a, b, links) of _count_links over groups(node, component): all pairs of a group's sets, block by block."""
    sizes = stored(groups.groupBy("component").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "group-sizes")
    own = groups.join(sizes, "component").join(copies.select(F.col("rep").alias("node"), "n_copies"), "node")
    own = own.select(F.col("node").alias("doc_id"), "component", "blocks", "n_copies", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("mine"))
    # A shuffle at every size: whether the ids are few enough to broadcast must not change what the join costs.
    texts = docs.select("doc_id", "text").join(own.select("doc_id").hint("merge"), "doc_id", "left_semi")
    sets = texts.dropDuplicates(["doc_id"]).mapInArrow(_sets, "doc_id long, shingles binary")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    dealt = (
        own.join(sets, "doc_id").select("*", other)
        .select(
            F.xxhash64("component", F.least("mine", "other"), F.greatest("mine", "other")).alias("block"),
            "doc_id", "n_copies", (F.col("mine") > F.col("other")).alias("side"), (F.col("mine") == F.col("other")).alias("same"), "shingles",
        )
    )
    return dealt.repartition(n_reduce, "block").sortWithinPartitions("block", "doc_id").mapInArrow(_count_links, "a long, b long, links long")


def jaccard_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, class_id, n_links) for docs(doc_id, text); see the module's text."""
    spark = docs.sparkSession
    n_reduce = int(spark.conf.get("spark.sql.shuffle.partitions"))
    own = stored(copies_and_sketches(docs.select("doc_id", "text")), "sketches")
    reps = own.groupBy(F.when(F.col("has_words"), F.col("copy_key")).otherwise(F.col("doc_id").cast("string")).alias("copy_key")).agg(
        F.min("doc_id").alias("rep"), F.countDistinct("doc_id").alias("n_copies")
    )
    reps = stored(reps, "copies")
    sketches = stored(
        own.where("has_words").join(reps.select(F.col("rep").alias("doc_id")), "doc_id", "left_semi")
        .groupBy("doc_id").agg(F.first("sketch").alias("sketch")),
        "rep-sketches",
    )
    groups = candidate_groups(docs, sketches, n_reduce)
    found = stored(links_in_groups(docs, groups, reps, n_reduce), "links")
    classes = connected(found.where("b IS NOT NULL").select("a", "b"))
    linked = found.where("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("linked"))
    per_rep = (
        reps.join(linked, "rep", "left").join(classes.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "copy_key",
            F.coalesce("component", "rep").alias("class_id"),
            (F.coalesce("linked", F.lit(0)) + F.col("n_copies") - 1).cast("long").alias("n_links"),
        )
    )
    mine = own.select("doc_id", F.when(F.col("has_words"), F.col("copy_key")).otherwise(F.col("doc_id").cast("string")).alias("copy_key"))
    joined = mine.distinct().join(stored(per_rep, "classes"), "copy_key")
    return joined.groupBy("doc_id").agg(F.min("class_id").alias("class_id"), F.max("n_links").alias("n_links"))


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_classes(table(spark, sf_dir, "documents"))


#: All pairs that share a shingle, exactly: for tables of a few thousand texts.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, [x FOR x IN regexp_split_to_array(lower(coalesce(text, '')), '[\x20\x09-\x0D]+') IF x <> ''] AS ws FROM documents),
sh AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN [array_to_string(ws[i:i+4], ' ') FOR i IN range(1, len(ws) - 3)]
    WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS s FROM d),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
SELECT doc_id, least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS class_id, (SELECT count(*) FROM l WHERE a = doc_id) AS n_links FROM documents
"""
