"""Jaccard self-join of shingle sets with a count-vector R-tree, and its components.

Tokens of a set are hashed into groups; the counts per group are a point. The sum of the
coordinate minima of two points bounds the overlap of their sets from above. That bound prunes
the nodes of an R-tree over the points, and then pairs; the pairs that survive are verified on
the whole sets.

To bring sets together that can link, without comparing all: two sets that link differ in at
most D tokens, where D follows from the size. With more than D groups, at least one group of
the two holds the same tokens. Each set therefore sends keys of its groups, the hash of the
group's tokens, and sets that share a key, directly or through others, form a cluster. Groups
with few tokens are common by chance; there are more groups than the argument needs, so that
those with the fewest tokens are left out, and empty groups always. Clusters are cut into blocks, and each pair of blocks is one task,
which sends on a forest of its links.

Texts that share a passage share some keys by chance, and with many texts such clusters run
together. The sets of a cluster of more than one block therefore send all their groups, the
rarest first, and are clustered again: keys of a passage that many hold are not among those.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vintagelens.llm.common import LOWER, hash_spans, mix, per_row, steps, stored, word_spans
from vintagelens.llm.graph import components

SHINGLE = 3
PERCENT = 90
COUNT_GROUPS = 32
NODE = 16
# Sets and tokens of one block of a cluster.
BLOCK_SETS = 512
BLOCK_TOKENS = 2_000_000
BAND_RATIO = 1.25


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row of a step."""
    starts, ends, rows = word_spans(data, offsets)
    words = hash_spans(LOWER[data], starts, ends)
    edges = per_row(rows, len(offsets) - 1)
    with np.errstate(over="ignore"):
        rolled = np.zeros(max(0, len(words) - width + 1), np.uint64)
        for k in range(width):
            rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + words[k : k + len(rolled)] + np.uint64(k))
        out = []
        for row in range(len(offsets) - 1):
            first, last = edges[row], edges[row + 1]
            if last - first >= width:
                out.append(np.unique(rolled[first : last - width + 1]))
            elif last > first:  # too short for a shingle: the sequence is one
                whole = np.uint64(last - first)
                for word in words[first:last]:
                    whole = mix(np.array([whole * np.uint64(0xD6E8FEB86659FD93) + word]))[0]
                out.append(np.array([whole], np.uint64))
            else:
                out.append(np.zeros(0, np.uint64))
    return out


def bands(largest: int, percent: int = PERCENT, ratio: float = BAND_RATIO) -> list[tuple[int, int]]:
    """Size ranges [from, to) that cover all sizes at which unequal sets can link."""
    first = -(-percent // (100 - percent)) if percent < 100 else largest + 1
    out = []
    while first <= largest:
        last = max(first + 1, int(np.ceil(first * ratio)))
        out.append((first, last))
        first = last
    return out


def groups_of(tokens: np.ndarray, percent: int = PERCENT) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """D, the keys of the groups that hold tokens, their counts, and at times a key for each token.

    One entry for each size band in which the set can have a partner. Of D + 1 + spare groups, two
    sets that link hold at least spare + 1 equal ones. In any order that depends on the keys only,
    empty groups last, the first of these is among the first D + 1 of both: those are to be sent.
    Empty groups have no key: if that first equal group is empty, neither set fills more than
    D groups, and sets that fill so few send each token as well, of which they share one.
    """
    n = len(tokens)
    smallest = -(-percent * n // 100)  # of a smaller partner
    with np.errstate(over="ignore"):
        spread = mix(tokens + np.uint64(0x51ED270B))
        for number, (low, high) in enumerate(bands(n, percent)):
            if high <= smallest or low > n:
                continue
            most_apart = (high - 1) * (100 - percent) // percent
            # Some three tokens a group or more, of which the groups sent hold two or more.
            spare = -(-(most_apart + 1) * (1 if percent >= 90 else 4) // 10) + 1
            groups = most_apart + 1 + spare
            group = (tokens % np.uint64(groups)).astype(np.int64)
            order = np.argsort(group, kind="stable")
            counts = np.bincount(group, minlength=groups)
            full = np.flatnonzero(counts)
            sums = np.add.reduceat(spread[order], (np.cumsum(counts) - counts)[full])
            band = np.uint64(number) << np.uint64(40)
            keys = mix(sums + mix(band + full.astype(np.uint64)) + counts[full].astype(np.uint64))
            few = len(full) <= most_apart
            yield most_apart, keys, counts[full], mix(spread + mix(band + np.uint64(groups))) if few else None


def keys_of(tokens: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Keys of the fullest groups of the set: the D + 1 that come last by count and content."""
    out = []
    for most_apart, keys, counts, single in groups_of(tokens, percent):
        out.append(keys[np.lexsort((keys, counts))[-(most_apart + 1) :]])
        if single is not None:
            out.append(single)
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


class CountTree:
    """R-tree over count vectors, packed by size; nodes keep the largest count per group."""

    def __init__(self, sets: list[np.ndarray], groups: int = COUNT_GROUPS, node: int = NODE):
        sizes = np.array([len(s) for s in sets])
        points = np.stack([np.bincount((s % np.uint64(groups)).astype(np.int64), minlength=groups) for s in sets])
        # Packed by size, then by the groups, so that near points share nodes.
        self.order = np.lexsort((*points.T[:4], sizes))
        self.points, self.sizes, self.node = points[self.order].astype(np.int32), sizes[self.order], node
        self.levels = []
        most, least = self.points, self.sizes
        while len(most) > node:
            starts = np.arange(0, len(most), node)
            most, least = np.maximum.reduceat(most, starts), np.minimum.reduceat(least, starts)
            self.levels.append((most, least))

    def near(self, place: int, percent: int) -> np.ndarray:
        """Later places whose overlap bound allows a link with the set at this place."""
        point, size = self.points[place], self.sizes[place]

        def allowed(most: np.ndarray, least: np.ndarray) -> np.ndarray:
            bound = np.minimum(most, point).sum(axis=1)
            return (100 + percent) * bound >= percent * (size + least)

        inner = self.levels  # from the leaves up
        candidates = np.arange(len(inner[-1][0]) if inner else len(self.points))
        for depth in range(len(inner) - 1, -1, -1):
            most, least = inner[depth]
            kept = candidates[allowed(most[candidates], least[candidates])]
            candidates = (kept[:, None] * self.node + np.arange(self.node)).ravel()
            candidates = candidates[candidates < len(inner[depth - 1][0] if depth else self.points)]
        candidates = candidates[candidates > place]
        return candidates[allowed(self.points[candidates], self.sizes[candidates])]


def forest(sets: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links that connect all that links connect: pairs already connected are not verified."""
    tree, root = CountTree(sets), list(range(len(sets)))

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    links = []
    for place in range(len(sets)):
        one = int(tree.order[place])
        for other in tree.order[tree.near(place, percent)].tolist():
            a, b = find(one), find(other)
            if a != b:
                shared = len(np.intersect1d(sets[one], sets[other], assume_unique=True))
                if 100 * shared >= percent * (len(sets[one]) + len(sets[other]) - shared):
                    root[a] = b
                    links.append((one, other))
    return links


def hash_sets(sets: list[np.ndarray]) -> np.ndarray:
    """64-bit hash of each set of shingles."""
    with np.errstate(over="ignore"):
        return np.array([mix(np.array([s.sum() + mix(s).sum() * np.uint64(3) + np.uint64(len(s))]))[0] for s in sets], np.uint64)


def _as_long(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def _outlines(width: int, percent: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("set_id", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches, "text"):
            sets = shingle_sets(data, offsets, width)
            ids = hash_sets(sets)
            keys = [keys_of(s, percent) for s in sets]
            flat = _as_long(np.concatenate([np.zeros(0, np.uint64), *keys]))
            ends = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
            sizes = pa.array([len(s) for s in sets], pa.int64())
            columns = [batch.column("doc_id").cast(pa.int64()), sizes, pa.array(_as_long(ids)), lists]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return run


_GROUPS = "set_id long, row long, part int, most int, filled int, keys array<long>"


def _all_groups(width: int, percent: int):
    """Keys of all groups of a text; ``most`` of them are to be sent, or all if it is null."""
    names = ["set_id", "row", "part", "most", "filled", "keys"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in steps(batches, "text"):
            out = []
            for set_id, tokens in zip(batch.column("set_id").to_pylist(), shingle_sets(data, offsets, width)):
                # A doc_id that comes with several texts: each is a row of its own.
                row = int(_as_long(hash_sets([tokens]) ^ mix(np.array([set_id], np.int64).view(np.uint64)))[0])
                for part, (most_apart, keys, _, single) in enumerate(groups_of(tokens, percent)):
                    out.append((set_id, row, 2 * part, most_apart + 1, len(keys), _as_long(keys)))
                    if single is not None:
                        out.append((set_id, row, 2 * part + 1, None, len(single), _as_long(single)))
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64())]
            columns = [pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _verify(width: int, percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(group: pa.Table) -> pa.Table:
        ids = group["set_id"].to_numpy()
        sets: list[np.ndarray] = []
        for batch in group.combine_chunks().to_batches():
            for _, data, offsets in steps([batch], "text"):
                sets += shingle_sets(data, offsets, width)
        links = forest(sets, percent)
        pairs = np.array(links, np.int64).reshape(-1, 2)
        return pa.Table.from_arrays([pa.array(ids[pairs[:, 0]]), pa.array(ids[pairs[:, 1]])], schema=schema)

    return run


def stars(keys: DataFrame) -> DataFrame:
    """A star (a, b) per key of ``keys`` (set_id, key): enough to connect all sets that share it.

    The keys move once. A key has a row for each text that holds it at most, of hundreds of keys a text.
    """
    low = F.min("set_id").over(Window.partitionBy("key"))
    return keys.select(low.alias("a"), F.col("set_id").alias("b")).where("a <> b")


def clusters_of(firsts: DataFrame) -> DataFrame:
    """label, blocks: into how many blocks the sets of each cluster are cut."""
    sizes = firsts.groupBy("label").agg(F.count(F.lit(1)).alias("sets"), F.sum("n").alias("tokens"))
    blocks = F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("tokens") / BLOCK_TOKENS)).cast("int")
    return stored(sizes.select("label", blocks.alias("blocks")), "jaccard-clusters")


def parted(texts: DataFrame, firsts: DataFrame, width: int, percent: int) -> DataFrame:
    """node, label: clusters of the sets of ``firsts`` by the rarest of all their groups; ``texts`` are (set_id, text).

    How many rows hold a key is the same for all that hold it, so that the D + 1 rarest hold one
    that two sets that link share. A key that one row has alone takes a place and is not sent.
    """
    wanted = texts.join(firsts.select("set_id"), "set_id", "left_semi")
    rows = stored(wanted.mapInArrow(_all_groups(width, percent), _GROUPS), "jaccard-groups")
    keys = rows.select("set_id", "row", "part", "most", "filled", F.explode("keys").alias("key"))
    of_key = Window.partitionBy("key")
    held = keys.select("*", F.count(F.lit(1)).over(of_key).alias("held"), *[f("row").over(of_key).alias(f.__name__) for f in (F.min, F.max)])
    found = held.where("min < max").groupBy("set_id", "row", "part", "most", "filled")
    ranked = found.agg(F.array_sort(F.collect_set(F.struct("held", "key"))).alias("shared"))
    places = F.greatest(F.lit(0), F.col("most") - (F.col("filled") - F.size("shared")))
    sent = F.slice("shared", F.lit(1), F.when(F.col("most").isNull(), F.size("shared")).otherwise(places))
    sent = ranked.select("set_id", F.explode(sent.getField("key")).alias("key"))
    return components(stars(stored(sent, "jaccard-sent")))


def join(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Members (doc_id, n, set_id) and links (a, b: set ids) that connect all sets that link.

    Equal sets are one set; sets are told apart by 64-bit hashes of their shingles.
    """
    texts = docs.select(F.col("doc_id").cast("long"), "text").where("doc_id is not null")
    outlines = stored(
        texts.mapInArrow(_outlines(width, percent), "doc_id long, n long, set_id long, keys array<long>"), "jaccard-sets"
    )
    clusters = components(stars(outlines.select("set_id", F.explode("keys").alias("key"))))

    members = outlines.select("doc_id", "n", "set_id")
    firsts = members.join(clusters.withColumnRenamed("node", "set_id"), "set_id")
    firsts = firsts.groupBy("set_id", "label", "n").agg(F.min("doc_id").alias("doc_id"))
    firsts = stored(firsts, "jaccard-candidates")
    # Repeated rows of one doc_id: any of them whose set is the wanted one would do, so take each text once.
    texts = stored(texts.join(firsts.select("doc_id", "set_id"), "doc_id").select("set_id", "text"), "jaccard-texts")
    sizes = clusters_of(firsts)
    if not sizes.where("blocks > 1").isEmpty():
        finer = parted(texts, firsts.join(sizes.where("blocks > 1"), "label"), width, percent)
        small = firsts.join(sizes.where("blocks = 1"), "label").select(firsts.columns)
        large = firsts.drop("label").join(finer.withColumnRenamed("node", "set_id"), "set_id").select(firsts.columns)
        firsts = stored(small.unionByName(large), "jaccard-parted")
        sizes = clusters_of(firsts)
    placed = firsts.join(sizes, "label")
    block = F.pmod(F.xxhash64("set_id"), F.col("blocks")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(block, x).alias("i"), F.greatest(block, x).alias("j")))
    wanted = placed.select("set_id", "label", others.alias("pairs"))
    rows = texts.join(wanted, "set_id").select("label", "set_id", "text", F.explode("pairs").alias("pair"))
    tasks = rows.select("label", "pair.i", "pair.j", "set_id", "text").groupBy("label", "i", "j")
    links = tasks.applyInArrow(_verify(width, percent), "a long, b long")
    return members, stored(links, "jaccard-links")


def groups(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that links reach, itself included.

    Reads doc_id and text. Null, empty and blank texts have no shingles and link with nothing;
    rows without a doc_id are left out. Equal texts link. Rows that repeat a doc_id each give a
    row, and connect what they hold. No rows give no rows.
    """
    members, links = join(docs, width, percent)
    labels = components(links).withColumnRenamed("node", "set_id")
    full = members.join(labels, "set_id", "left").withColumn("label", F.coalesce("label", "set_id"))
    full = stored(full.select("doc_id", "n", "label"), "jaccard-members")
    least = stored(full.where("n > 0").groupBy("label").agg(F.min("doc_id").alias("component_id")), "jaccard-least")
    joined = full.join(least, "label", "left")
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
