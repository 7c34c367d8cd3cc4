"""Near-duplicate documents by MinHash with tensored banding.

Two collections of ``SIDE`` half-keys, each over ``ROWS`` minimum hashes, give SIDE x SIDE table keys by combining every key of
one with every key of the other: 2 x SIDE x ROWS minimum hashes stand for SIDE x SIDE x 2 x ROWS. Two documents of similarity
0.8 share a table key with probability (1 - (1 - 0.8^2)^8)^2 = 0.9994, of 0.85 with 0.99997.

Documents with one and the same shingle set are one node. Nodes that share a table key are compared on their full sets, in
numpy, in groups around the most frequent node of their tables (its hub), and only links that join a group's parts leave the
task. A group whose sets exceed ``TILE_BYTES`` is dealt out as pairs of tiles. Links are joined by alternating stars.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from loomstar.llm.tables import column, in_batches, located, prepare, sized
from loomstar.llm.wordbytes import SPACED, batch_words, groups, mixed, shingle_hashes
from loomstar.session import stored

SHINGLE, NEAR = 5, 80
SIDE, ROWS = 8, 2
#: Bytes of shingle sets that one comparison holds in memory (a pair of tiles holds twice as much).
TILE_BYTES = 4 << 20

_FACTORS = mixed(np.arange(1, 2 * SIDE * ROWS + 1, dtype=np.uint64) * np.uint64(0x9FB21C651E98DF25)) | np.uint64(1)
_SUMS = mixed(np.array([0x5851F42D4C957F2D, 0x14057B7EF767814F], np.uint64)) | np.uint64(1)


def shingle_sets(texts: list, size: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, texts, distinct shingles sorted within each text, bounds) for groups of texts."""
    for first, raw in groups(texts):
        value, doc = shingle_hashes(batch_words(raw, SPACED), size)
        order = np.lexsort((value, doc))
        value, doc = value[order], doc[order]
        new = np.ones(len(value), bool)
        new[1:] = (value[1:] != value[:-1]) | (doc[1:] != doc[:-1])
        value, doc = value[new], doc[new]
        yield first, len(raw), value, np.searchsorted(doc, np.arange(len(raw) + 1))


def _set_names(value: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Two 64-bit sums that name each set."""
    out = []
    for factor in _SUMS:
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mixed(value * factor))])
        out.append(mixed(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64))
    return out


def _half_keys(value: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """int64[texts, 2 * SIDE]: the half-keys of both collections; texts without shingles have zeros."""
    full = np.flatnonzero(np.diff(bounds))
    keys = np.zeros((len(bounds) - 1, 2 * SIDE), np.uint64)
    if len(full):
        for k in range(2 * SIDE):
            made = np.full(len(full), k, np.uint64)
            for r in range(ROWS):
                least = np.minimum.reduceat(value * _FACTORS[k * ROWS + r], bounds[full])
                made = mixed(made * np.uint64(0x9E3779B97F4A7C15) + least)
            keys[full, k] = made
    return keys.view(np.int64)


def signatures(docs: DataFrame, doc_id: str, text: str, size: int, place: tuple[str, str] | None = None) -> DataFrame:
    """id, n (distinct shingles), h1 and h2 (name of the set), left and right (half-keys); with ``place`` the row's file and number as well."""
    own = {"file": "string", "at": "long"} if place else {}

    def sign(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for first, count, value, bounds in shingle_sets(frame["text"].tolist(), size):
            (h1, h2), keys = _set_names(value, bounds), _half_keys(value, bounds)
            kept = {c: frame[c].iloc[first : first + count].array for c in ("id", *own)}
            parts.append(pd.DataFrame(kept | {"n": np.diff(bounds), "h1": h1, "h2": h2, "left": list(keys[:, :SIDE]), "right": list(keys[:, SIDE:])}))
        return pd.concat(parts)

    # a null id passes through Python as text, which keeps large numbers exact
    read = docs.select(column(doc_id).cast("long").cast("string").alias("id"), *[column(c).alias(n) for c, n in zip(place or (), own)], column(text).alias("text"))
    made = read.mapInPandas(in_batches(sign), "".join(["id string, ", *(f"{n} {t}, " for n, t in own.items()), "n long, h1 long, h2 long, left array<long>, right array<long>"]))
    return made.withColumn("id", F.col("id").cast("long"))


def _tables(nodes: DataFrame) -> DataFrame:
    """(key, node) for each of the SIDE x SIDE tables."""
    left = nodes.select("node", "right", F.posexplode("left").alias("i", "l"))
    both = left.select("node", "i", "l", F.posexplode("right").alias("j", "r"))
    return both.select(F.xxhash64("i", "j", "l", "r").alias("key"), "node")


def _sets(docs: DataFrame, wanted: DataFrame, doc_id: str, text: str, size: int) -> DataFrame:
    """h1, h2 and the set, as bytes, of the documents whose id is in ``wanted``."""

    def gather(frame: pd.DataFrame) -> pd.DataFrame:
        parts = []
        for _, _, value, bounds in shingle_sets(frame["text"].tolist(), size):
            h1, h2 = _set_names(value, bounds)
            raw = [value[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
            parts.append(pd.DataFrame({"h1": h1, "h2": h2, "items": raw}))
        return pd.concat(parts)

    rows = docs.select(column(doc_id).cast("long").alias("id"), column(text).alias("text"))
    ids = wanted.select(F.col("id").alias("wanted_id")).distinct()
    found = rows.join(sized(stored(ids, "wanted")), F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi").select("text")
    return found.mapInPandas(in_batches(gather), "h1 long, h2 long, items binary").groupBy("h1", "h2").agg(F.first("items").alias("items"))


class _Parts:
    """Disjoint sets of 0..n-1."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def linked_parts(sets: list[np.ndarray], side: np.ndarray, near: int) -> np.ndarray:
    """For each set the smallest position in its part, where sets with 100 * shared >= near * united are linked.

    ``side`` has the tile of each set (-1: both): sets of one tile are compared with the other's alone, if there are two.
    The shared items of one set with all others are counted through lists of the sets that hold each item; sets that are
    already in one part with everything they could link to are passed over.
    """
    n = len(sets)
    parts, size = _Parts(n), np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(n), size)
    _, item = np.unique(np.concatenate(sets), return_inverse=True)
    frequent = np.bincount(item)[item] > 1
    item, owner = item[frequent], owner[frequent]
    by_item = np.argsort(item, kind="stable")
    held, first = owner[by_item], np.searchsorted(item[by_item], np.arange(item.max() + 2 if len(item) else 1))
    mine = np.searchsorted(owner, np.arange(n + 1))
    two = len(set(side.tolist()) - {-1}) > 1
    done = np.zeros(n, bool)
    for x in range(n):
        own = item[mine[x] : mine[x + 1]]
        if not len(own):
            continue
        if done[x]:  # linked to the first set, and so to all that are: only the others are open
            continue
        shared = np.bincount(np.concatenate([held[first[t] : first[t + 1]] for t in own]), minlength=n)
        linked = 100 * shared >= near * (size + size[x] - shared)
        linked[x] = False
        if two:
            linked &= (side != side[x]) | (side == -1)
        for y in np.flatnonzero(linked).tolist():
            parts.join(x, y)
        if x == 0:
            done = linked
    return np.array([parts.root(x) for x in range(n)])


def _compare(near: int):
    """For ``mapInPandas`` over rows (group, tile_a, tile_b, side, node, n, items) sorted by group and tiles, the hub first."""

    def judge(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.drop_duplicates("node")
        sets = [np.frombuffer(x, np.uint64) for x in frame["items"]]
        node = frame["node"].to_numpy()
        root = linked_parts(sets, frame["side"].to_numpy(), near)
        away = np.flatnonzero(root != np.arange(len(node)))
        return pd.DataFrame({"a": node[away], "b": node[root[away]]})

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, held = ["group", "tile_a", "tile_b"], []
        for frame in frames:
            if not len(frame):
                continue
            number = (frame[keys] != frame[keys].shift()).any(axis=1).cumsum()
            pieces = [piece for _, piece in frame.groupby(number.to_numpy(), sort=False)]
            found = []
            for piece in pieces:
                if held and tuple(held[0][keys].iloc[0]) != tuple(piece[keys].iloc[0]):
                    found.append(judge(pd.concat(held)))
                    held = []
                held.append(piece)
            if found:
                yield pd.concat(found)
        if held:
            yield judge(pd.concat(held))

    return run


def links(docs: DataFrame, nodes: DataFrame, doc_id: str, text: str, size: int, near: int, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """(a, b): links between nodes that join all that belong together."""
    keyed = _tables(nodes)
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("held")).where("held > 1")
    tables = stored(keyed.join(sized(stored(shared, "shared")), "key"), "tables")
    weight = tables.groupBy("node").agg(F.sum("held").alias("weight"))
    weighed = tables.join(weight, "node")
    hub = weighed.groupBy("key").agg(F.max(F.struct("weight", "node")).alias("top")).select("key", F.col("top.node").alias("group"))
    members = tables.select("key", "node").join(hub, "key").select("group", "node").distinct()
    members = stored(members.join(nodes.select("node", "id", "n", "h1", "h2"), "node"), "members")
    # only groups too large for one tile are named, and there are at most (bytes of all sets) / tile_bytes of them
    total = members.groupBy("group").agg((F.floor(F.sum("n") * 8 / tile_bytes) + 1).cast("int").alias("tiles")).where("tiles > 1")
    dealt = members.join(sized(stored(total, "tiles")), "group", "left").fillna(1, ["tiles"]).withColumn("mine", F.when(F.col("group") == F.col("node"), -1).otherwise(F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")))
    # the hub goes to every pair of tiles, any other member to the pairs with its own tile
    others = F.sequence(F.lit(0), F.col("tiles") - 1)
    pairs = F.when(F.col("tiles") == 1, F.array(F.struct(F.lit(0).alias("tile_a"), F.lit(0).alias("tile_b")))).when(
        F.col("mine") >= 0, F.transform(others, lambda q: F.struct(F.least("mine", q).alias("tile_a"), F.greatest("mine", q).alias("tile_b")))
    ).otherwise(F.flatten(F.transform(others, lambda p: F.transform(F.sequence(p, F.col("tiles") - 1), lambda q: F.struct(p.alias("tile_a"), q.alias("tile_b"))))))
    spread = dealt.withColumn("pair", F.explode(pairs)).select("group", "pair.*", F.col("mine").alias("side"), "node", "h1", "h2")
    rows = spread.join(_sets(docs, members, doc_id, text, size), ["h1", "h2"]).select("group", "tile_a", "tile_b", "side", "node", "items")
    sorted_rows = rows.repartition("group", "tile_a", "tile_b").sortWithinPartitions("group", "tile_a", "tile_b", (F.col("group") != F.col("node")), "node")
    return sorted_rows.mapInPandas(_compare(near), "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (a, b), by alternating large and small stars."""
    edges = stored(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        large = stored(large, "large")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(down.select("a", F.col("m").alias("b")))
        after = stored(small.where("a != b").distinct(), "small")
        same = edges.count() == after.count() and edges.join(after, ["a", "b"], "left_anti").isEmpty()
        edges = after
        if same:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))


def near_dup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, near: int = NEAR, tile_bytes: int = TILE_BYTES) -> DataFrame:
    """One row per row of ``docs``: id, n_shingles, component_id (smallest id reachable by links), kept (id = component_id).

    Links: 100 * shared >= ``near`` * united, over distinct shingles of ``size`` words. A text of fewer words is one shingle;
    a null, empty or blank text has none and is linked with nothing: its own id is its component. Rows of equal sets are
    linked, so copies and repeated rows share a component. A null id is never a component id unless all ids of its
    component are null; such rows are kept. An empty table gives no rows. Other columns do not matter.
    """
    rows = _grouped(docs, doc_id, text, size, near, tile_bytes)
    return rows.select("id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def _grouped(docs: DataFrame, doc_id: str, text: str, size: int, near: int, tile_bytes: int, place: tuple[str, str] | None = None) -> DataFrame:
    """Each row's id, n, component (least id), root (of its component, null without shingles) and, with ``place``, file and at."""
    prepare(docs.sparkSession)
    signed = stored(signatures(docs, doc_id, text, size, place), "signed")
    numbered = signed.where("n > 0").groupBy("h1", "h2").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("left").alias("left"), F.first("right").alias("right"))
    nodes = stored(numbered.withColumn("node", F.monotonically_increasing_id()), "nodes")
    roots = components(links(docs, nodes, doc_id, text, size, near, tile_bytes))
    ids = nodes.select("node", "id", "h1", "h2").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # nodes that stand alone take no part in the sum over components
    least = roots.select("node", "root").unionByName(roots.select(F.col("root").alias("node"), "root").distinct()).join(nodes.select("node", "id"), "node").groupBy("root").agg(F.min("id").alias("least"))
    named = ids.join(least, "root", "left").select("h1", "h2", "root", F.coalesce("least", "id").alias("component"))
    out = signed.drop("left", "right").join(named, ["h1", "h2"], "left")
    full = F.col("n") > 0
    return out.withColumns({"component": F.when(full, F.col("component")).otherwise(F.col("id")), "root": F.when(full, F.col("root"))}).drop("h1", "h2")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = SHINGLE, near: int = NEAR) -> DataFrame:
    """``docs`` with one row of each group of near copies; all columns as they were, whatever their names.

    Groups are those of ``near_dup``. It is decided row by row, so rows may share an id or have none: the row with the smallest
    id stays, a row without id only if no other has one, and of rows with one id the first by place. Null, empty and blank
    texts are near copies of nothing and all stay. Texts of any length count whole. An empty table gives no rows. Any source
    will do (see ``tables.located``).
    """
    placed, file, at = located(docs)
    rows = stored(_grouped(placed, doc_id, text, size, near, TILE_BYTES, (file, at)).where("root IS NOT NULL").select("root", "id", "file", "at"), "rows")
    order = F.struct(F.col("id").isNull().alias("unnamed"), "id", "file", "at")
    first = rows.groupBy("root").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1").select("root", "first.file", "first.at")
    stays = first.toDF("stays_root", "stays_file", "stays_at")
    others = rows.join(stays, F.col("root") == F.col("stays_root")).where((F.col("file") != F.col("stays_file")) | (F.col("at") != F.col("stays_at")))
    gone = stored(others.select(F.col("file").alias(file), F.col("at").alias(at)), "near")
    return placed.join(sized(gone, 100_000), [file, at], "left_anti").select(*[column(c) for c in docs.columns])
