"""Near-duplicate documents by a chosen-path set similarity join.

A document is the set of its word shingles. Documents with the same set form a class, and classes
are compared.

1. *Trees.* Each class has a sketch of minwise tokens. In every tree a class walks down from the
   root: a node selects one coordinate of the sketch by its path, and the class goes to the child of
   its minwise token there. The walk depends on nothing but the sketch, so nodes are the runs of a
   table sorted by path: it is range-partitioned, which also splits the largest nodes. Small nodes
   are compared exhaustively, larger ones go on to their children, and all members of a large node
   are compared with its first. Nodes at the last level are compared in all pairs, whatever their
   size, but for those that hang together already. Comparisons are by sketch, with a margin; a node gives the edges of
   a spanning forest, not its pairs. Independent trees are repeated to reach the recall.
2. *Groups.* Connected components of these edges hold every link that was found and few others.
3. *Confirmation.* Inside each group all pairs that could still join two parts are compared on full
   sets. Groups beyond a block are first compared with their most typical member; documents that
   match it are settled, and the others meet everything in blocks of bounded size. No pair is
   skipped for lack of room.
4. Components of the confirmed links are the answer.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickfeat.llm.common import keep, lookup, query, table

WORDS = 5
PERCENT = 80
COORDINATES = 64
TREES = 24
DEPTH = 8
#: Members of a node that are compared exhaustively at any depth, and rows of a run held at once,
#: beyond which only a leaf is kept whole.
SMALL_NODE = 48
RUN_ROWS = 20_000
#: Rows of a large leaf that are tried for one that most others are like.
PIVOTS = 8
#: Documents and shingles in a block of the confirmation.
BLOCK_DOCS = 1500
BLOCK_SHINGLES = 4_000_000
#: Standard deviations of the sketch estimate below the threshold that still count as a candidate.
MARGIN = 3.6

_M1, _M2 = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_SHIFT = np.uint64(33)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * _M1
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 500_000:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


def shingle_set(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of one text, A-Z lower-cased.

    A text with fewer words is one shingle; without words there is none.
    """
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(hashes.__getitem__, found), np.uint64, n)
    size = min(words, n)
    total = np.full(n - size + 1, size, np.uint64)
    for i in range(size):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + each[i : n - size + 1 + i])
    return np.unique(total)


def digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def _functions(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(11)
    top = np.iinfo(np.int64).max
    odd = draw.integers(0, top, coordinates, dtype=np.int64).astype(np.uint64) * np.uint64(2)
    return odd + np.uint64(1), draw.integers(0, top, coordinates, dtype=np.int64).astype(np.uint64)


def minwise(shingles: np.ndarray, functions: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The least of each hash function's values over a set, as 32 bits."""
    factors, offsets = functions
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):
        part = shingles[start : start + 2048]
        values = factors[:, None] * part[None, :]
        values += offsets[:, None]
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def _sketcher(words: int, coordinates: int):
    def sketched(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, functions = _WordHashes(), _functions(coordinates)
        for batch in batches:
            sizes, digests, sketches = [], [], []
            for text in batch["_text"]:
                shingles = shingle_set(text, words, hashes)
                sizes.append(len(shingles))
                digests.append(digest(shingles))
                sketches.append(minwise(shingles, functions).tobytes() if len(shingles) else b"")
            yield pd.DataFrame(
                {"_id": batch["_id"].array, "_n": sizes, "_digest": digests, "_sketch": sketches}
            )

    return sketched


def paths(sketches: np.ndarray, tree: int, depth: int) -> np.ndarray:
    """The minwise tokens along each row's walk down one tree: ``rows x depth``."""
    rows, coordinates = sketches.shape
    node = np.full(rows, tree + 1, np.uint64)
    out = np.empty((rows, depth), np.uint32)
    at = np.arange(rows)
    for level in range(depth):
        node = _mix(node * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level))
        out[:, level] = sketches[at, (node % np.uint64(coordinates)).astype(np.int64)]
        node = node ^ out[:, level]
    return out


def _walker(trees: int, depth: int, coordinates: int):
    def walked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            full = np.frombuffer(b"".join(batch["_sketch"]), np.uint32).reshape(-1, coordinates)
            small = [row.tobytes() for row in full.astype(np.uint8)]
            number = batch["_class"].to_numpy()
            for tree in range(trees):
                way = [row.tobytes() for row in paths(full, tree, depth).astype(">u4")]
                # Members with one path are ordered anew in each tree, so cuts fall elsewhere.
                tie = _mix(number.astype(np.uint64) + np.uint64(tree << 48)).view(np.int64)
                yield pd.DataFrame(
                    {"_tree": tree, "_path": way, "_tie": tie, "_class": number, "_small": small}
                )

    return walked


def _forest(pairs: np.ndarray, count: int) -> list[tuple[int, int]]:
    """The pairs that join two parts, in order."""
    parent = list(range(count))
    chosen = []
    for i, j in pairs.tolist():
        a, b = i, j
        while parent[a] != a:
            parent[a] = parent[parent[a]]
            a = parent[a]
        while parent[b] != b:
            parent[b] = parent[parent[b]]
            b = parent[b]
        if a != b:
            parent[max(a, b)] = min(a, b)
            chosen.append((i, j))
    return chosen


def leaf_edges(small: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest over all pairs of rows whose sketches agree in ``least`` places.

    Rows that already hang together with a common one need no comparison with each other; every other
    row is compared with all.
    """
    n = len(small)
    across = np.ascontiguousarray(small.T)
    part = np.arange(n)
    edges: list[tuple[int, int]] = []
    main = -1

    def meet(i: int) -> None:
        same = (across == across[:, i : i + 1]).view(np.uint8).sum(axis=0, dtype=np.uint8)
        for j in np.flatnonzero((same >= least) & (part != part[i])).tolist():
            if part[j] == part[i]:
                continue
            edges.append((min(i, j), max(i, j)))
            if part[j] == main or (part[j] < part[i] and part[i] != main):
                part[part == part[i]] = part[j]
            else:
                part[part == part[j]] = part[i]

    tried = np.unique(np.linspace(0, n - 1, PIVOTS).astype(int)).tolist()
    for i in tried:
        meet(i)
    labels, members = np.unique(part, return_counts=True)
    main = int(labels[members.argmax()])
    for i in range(n):
        if part[i] != main and i not in tried:
            meet(i)
    return edges


def node_edges(way: np.ndarray, small: np.ndarray, least: int) -> list[tuple[int, int]]:
    """Candidate edges in a run of rows that share the first token of their sorted paths."""
    edges: list[tuple[int, int]] = []
    work = [(0, len(way), 1)]
    while work:
        start, stop, level = work.pop()
        n = stop - start
        if n < 2:
            continue
        if n <= SMALL_NODE:
            own = small[start:stop]
            same = (own[:, None, :] == own[None, :, :]).sum(axis=2, dtype=np.int16)
            near = np.argwhere(np.triu(same >= least, 1))
            edges += [(start + i, start + j) for i, j in _forest(near, n)]
            continue
        like = (small[start + 1 : stop] == small[start]).sum(axis=1, dtype=np.int16) >= least
        edges += [(start, start + 1 + i) for i in np.flatnonzero(like).tolist()]
        if level == way.shape[1]:
            # Tokens are used up.
            edges += [(start + i, start + j) for i, j in leaf_edges(small[start:stop], least)]
            continue
        cuts = np.flatnonzero(np.diff(way[start:stop, level])) + 1 + start
        bounds = [start, *cuts.tolist(), stop]
        work += [(a, b, level + 1) for a, b in zip(bounds, bounds[1:])]
    return edges


def _node_reader(depth: int, coordinates: int, least: int):
    def emit(rows: list[pd.DataFrame]) -> list[pd.DataFrame]:
        run = pd.concat(rows, ignore_index=True)
        way = np.frombuffer(b"".join(run["_path"]), ">u4").reshape(-1, depth).astype(np.int64)
        small = np.frombuffer(b"".join(run["_small"]), np.uint8).reshape(-1, coordinates)
        numbers = run["_class"].to_numpy()
        heads = np.flatnonzero((np.diff(way[:, 0]) != 0) | (np.diff(run["_tree"].to_numpy()) != 0)) + 1
        bounds = [0, *heads.tolist(), len(run)]
        found = []
        for a, b in zip(bounds, bounds[1:]):
            if b - a > 1:
                found += [(a + i, a + j) for i, j in node_edges(way[a:b], small[a:b], least)]
        if not found:
            return []
        pairs = numbers[np.array(found)]
        return [pd.DataFrame({"_a": pairs.min(axis=1), "_b": pairs.max(axis=1)})]

    def last_node(whole: pd.DataFrame, level: int) -> int:
        """The first row of the last node of a level, which may go on."""
        way = np.frombuffer(b"".join(whole["_path"]), ">u4").reshape(-1, depth)[:, :level]
        other = (way != way[-1]).any(axis=1) | (whole["_tree"].to_numpy() != whole["_tree"].iat[-1])
        rows = np.flatnonzero(other)
        return int(rows[-1]) + 1 if len(rows) else 0

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        rows, room = 0, RUN_ROWS
        for batch in batches:
            for start in range(0, len(batch), RUN_ROWS):
                held.append(batch.iloc[start : start + RUN_ROWS])
                rows += len(held[-1])
                if rows < room:
                    continue
                # Keep the last node, which may go on: the largest that leaves half of the store free.
                whole = pd.concat(held, ignore_index=True)
                first = last_node(whole, 1)
                cut = first
                for level in range(2, depth + 1):
                    if 2 * cut >= len(whole):
                        break
                    cut = last_node(whole, level)
                if cut > first + 1:
                    # The rest of a node meets its first row again.
                    yield from emit([whole.iloc[:cut]])
                    held = [whole.iloc[first : first + 1], whole.iloc[cut:]]
                elif first:
                    yield from emit([whole.iloc[:first]])
                    held = [whole.iloc[first:]]
                else:
                    held = [whole]
                rows = sum(map(len, held))
                room = max(RUN_ROWS, 2 * rows)
        if held:
            yield from emit(held)

    return read


def components(edges: DataFrame) -> DataFrame:
    """``_class, _label``: the smallest number of each connected component, for nodes of ``_a, _b``.

    Large and small stars in turn, each an aggregate and a join on one node; nodes with many
    neighbours are joined by broadcast. The driver learns two numbers a round.
    """
    edges = keep(edges.distinct(), "edges")
    before = None
    while True:
        both = edges.select(F.col("_a").alias("_u"), F.col("_b").alias("_v")).unionByName(
            edges.select(F.col("_b").alias("_u"), F.col("_a").alias("_v"))
        )
        both = keep(both, "neighbours")
        least = both.groupBy("_u").agg(F.min("_v").alias("_m"), F.count("*").alias("_d"))
        least = keep(least.withColumn("_m", F.least("_u", "_m")), "least-neighbours")
        large = lookup(both, least, ["_u"], "_d").filter("_v > _u").select("_v", "_m")
        large = keep(
            large.filter("_v <> _m").select(F.col("_v").alias("_u"), F.col("_m").alias("_v")).distinct(),
            "large-stars",
        )
        down = large.groupBy("_u").agg(F.min("_v").alias("_m"), F.count("*").alias("_d"))
        down = keep(down, "least-below")
        small = lookup(large, down, ["_u"], "_d").filter("_v <> _m").select("_v", "_m")
        small = small.unionByName(down.select(F.col("_u").alias("_v"), "_m"))
        edges = keep(
            small.select(F.col("_m").alias("_a"), F.col("_v").alias("_b")).distinct(), "edges"
        )
        # Stars only: every node has one edge to its component's smallest.
        tops = edges.agg(
            F.count("*"), F.sum(F.col("_a").cast("decimal(38,0)")), F.sum(F.col("_b").cast("decimal(38,0)"))
        ).first()
        if tops == before:
            break
        before = tops
    roots = edges.select(F.col("_a").alias("_class"), F.col("_a").alias("_label")).distinct()
    return roots.unionByName(edges.select(F.col("_b").alias("_class"), F.col("_a").alias("_label")))


def _set_reader(words: int):
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            sets = [shingle_set(text, words, hashes) for text in batch["_text"]]
            # A row that shares an id with another document's text is not the one asked for.
            same = np.array([digest(s) == d for s, d in zip(sets, batch["_digest"])], bool)
            yield pd.DataFrame(
                {
                    "_class": batch["_class"][same],
                    "_label": batch["_label"][same],
                    "_n": batch["_n"][same],
                    "_small": batch["_small"][same],
                    "_set": [s.tobytes() for s, ok in zip(sets, same) if ok],
                }
            )

    return read


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the similarity of two sorted sets is at least ``percent`` percent."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= percent * (len(a) + len(b) - shared)


def confirmed(sets: list[np.ndarray], part: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links that join the parts of a block, by comparing full sets.

    ``part`` numbers what is known to be together. Each set is compared with all sets that are not yet
    in its part, at once: shingles are numbered, and its marks are summed over all sets.
    """
    sizes = np.array([len(s) for s in sets])
    numbered = np.unique(np.concatenate(sets), return_inverse=True)[1]
    starts = np.cumsum(sizes) - sizes
    mark = np.zeros(int(numbered.max()) + 1, np.int64)
    part = part.copy()
    links = []
    for i in range(len(sets)):
        if (part == part[i]).all():
            continue
        own = numbered[starts[i] : starts[i] + sizes[i]]
        mark[own] = 1
        shared = np.add.reduceat(mark[numbered], starts)
        mark[own] = 0
        like = 100 * shared >= percent * (sizes + sizes[i] - shared)
        for j in np.flatnonzero(like & (part != part[i])).tolist():
            if part[j] != part[i]:
                links.append((i, j))
                part[part == part[j]] = part[i]
    return links


def _block_reader(percent: int):
    def emit(unit: pd.DataFrame) -> list[pd.DataFrame]:
        sets = [np.frombuffer(s, np.uint64) for s in unit["_set"]]
        # Settled documents are one part; every other one is a part of its own.
        settled = unit["_settled"].to_numpy(bool)
        part = np.where(settled, -1, np.arange(len(unit)))
        numbers = unit["_class"].to_numpy()
        links = confirmed(sets, part, percent)
        if not links:
            return []
        pairs = numbers[np.array(links)]
        return [pd.DataFrame({"_a": pairs.min(axis=1), "_b": pairs.max(axis=1)})]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for batch in batches:
            held = batch if held is None else pd.concat([held, batch], ignore_index=True)
            key = held["_unit"].to_numpy()
            cuts = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist()]
            for a, b in zip(cuts, cuts[1:]):
                if b - a > 1:
                    yield from emit(held.iloc[a:b])
            held = held.iloc[cuts[-1] :]
        if held is not None and len(held) > 1:
            yield from emit(held)

    return read


def _matcher(percent: int):
    def matched(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for sets, pivots in batches:
            yield pd.Series(
                [
                    linked(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), percent)
                    for a, b in zip(sets, pivots)
                ],
                dtype=bool,
            )

    return matched


def _typical(members: DataFrame, coordinates: int) -> DataFrame:
    """The member of each group whose sketch agrees most with the group's commonest tokens."""
    place = F.sequence(F.lit(1), F.lit(coordinates))
    tokens = members.select("_label", "_small", F.explode(place).alias("_at")).select(
        "_label", "_at", F.expr("substring(_small, _at, 1)").alias("_token")
    )
    counted = tokens.groupBy("_label", "_at", "_token").agg(F.count("*").alias("_k"))
    most = counted.groupBy("_label", "_at").agg(
        F.max(F.struct("_k", "_token")).alias("_top"), F.sum("_k").alias("_members")
    )
    common = most.groupBy("_label").agg(
        F.sort_array(F.collect_list(F.struct("_at", F.col("_top._token").alias("_token")))).alias("_common"),
        F.max("_members").alias("_members"),
    )
    common = keep(common, "common-tokens")
    seen = lookup(members.select("_class", "_label", "_small"), common, ["_label"], "_members")
    agree = F.size(
        F.filter("_common", lambda c: F.substring(F.col("_small"), c["_at"], F.lit(1)) == c["_token"])
    )
    return seen.groupBy("_label").agg(
        F.max_by("_class", F.struct(agree, -F.col("_class"))).alias("_pivot"),
        F.count("*").alias("_members"),
    )


def _confirm(candidates: DataFrame, percent: int, coordinates: int) -> DataFrame:
    """Confirmed links ``_a, _b`` inside the groups of ``_class, _label, _n, _small, _set``."""
    sizes = candidates.groupBy("_label").agg(F.count("*").alias("_m"), F.sum("_n").alias("_e"))
    blocks = F.ceil(F.greatest(F.col("_m") / BLOCK_DOCS, F.col("_e") / BLOCK_SHINGLES))
    sizes = keep(sizes.withColumn("_blocks", blocks).filter("_m > 1"), "group-sizes")
    sized = lookup(candidates, sizes, ["_label"], "_m", "inner")
    sized = keep(sized.withColumn("_settled", F.lit(False)), "sized-groups")
    columns = ["_class", "_label", "_n", "_set", "_settled", "_blocks"]
    unit = F.concat_ws(":", F.col("_label"), F.lit("0"), F.lit("0"))
    units = [sized.filter("_blocks <= 1").select("_class", "_set", "_settled", unit.alias("_unit"))]
    links = []
    large = sized.filter("_blocks > 1")
    if not large.isEmpty():
        pivots = keep(_typical(large, coordinates), "pivots")
        sets = large.join(pivots, F.col("_class") == F.col("_pivot"), "left_semi")
        sets = keep(
            pivots.join(
                sets.select(F.col("_class").alias("_pivot"), F.col("_set").alias("_pivot_set")), "_pivot"
            ),
            "pivot-sets",
        )
        near = F.pandas_udf(_matcher(percent), "boolean").asNondeterministic()
        tried = lookup(large.select(columns), sets, ["_label"], "_members", "inner")
        tried = keep(
            tried.withColumn("_settled", near("_set", "_pivot_set")).drop("_pivot_set"), "settled"
        )
        links.append(
            tried.filter("_settled AND _class <> _pivot").select(
                F.least("_pivot", "_class").alias("_a"), F.greatest("_pivot", "_class").alias("_b")
            )
        )
        # Documents that aren't settled are few or many; they meet all others block by block.
        rest = tried.filter("NOT _settled").groupBy("_label").agg(
            F.count("*").alias("_u"), F.sum("_n").alias("_ue")
        )
        rest = rest.withColumn(
            "_rest_blocks",
            F.ceil(F.greatest(F.col("_u") / BLOCK_DOCS, F.col("_ue") / BLOCK_SHINGLES)),
        )
        counted = rest.join(sizes.select("_label", "_m"), "_label")
        counted = keep(counted.select("_label", "_m", "_rest_blocks"), "rest-sizes")
        dealt = lookup(tried, counted, ["_label"], "_m", "inner").withColumn(
            "_mine",
            F.pmod(
                F.xxhash64("_class"),
                F.when(F.col("_settled"), F.col("_blocks")).otherwise(F.col("_rest_blocks")),
            ),
        )
        others = F.sequence(F.lit(0), F.col("_rest_blocks") - 1)
        own = F.when(
            F.col("_settled"),
            F.transform(others, lambda o: F.concat_ws(":", "_label", F.lit("s"), "_mine", o)),
        ).otherwise(
            F.concat(
                F.transform(
                    others,
                    lambda o: F.concat_ws(":", "_label", F.lit("u"), F.least("_mine", o), F.greatest("_mine", o)),
                ),
                F.transform(
                    F.sequence(F.lit(0), F.col("_blocks") - 1),
                    lambda s: F.concat_ws(":", "_label", F.lit("s"), s, "_mine"),
                ),
            )
        )
        units.append(dealt.select("_class", "_set", "_settled", F.explode(own).alias("_unit")))
    for unit_rows in units:
        spread = unit_rows.repartition("_unit").sortWithinPartitions("_unit", "_class")
        links.append(spread.mapInPandas(_block_reader(percent), "_a bigint, _b bigint"))
    found = links[0]
    for more in links[1:]:
        found = found.unionByName(more)
    return found


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = WORDS,
    percent: int = PERCENT,
    trees: int = TREES,
) -> DataFrame:
    """One row per input row: ``doc_id, n_shingles, component_id, kept``.

    Documents are linked when their sets of ``words``-word shingles are similar to ``percent`` percent or
    more; the component id is the smallest id that links lead to, and that document is kept. Null
    and empty texts and texts without words have no shingles and are linked with nothing. Rows with a null
    id have a null component and are kept. Repeated rows (equal id and text) are kept together. Other
    columns are not read. An empty table gives no rows.

    A pair of similarity ``t`` becomes a candidate with a probability of about ``1 - (1 - t^d)^trees``,
    where ``d`` is the depth at which its nodes are small, :data:`DEPTH` at most: leaves of any size are
    compared in all pairs. Most nodes are at 1 or 2, where 24 trees miss less than one pair in 10^10;
    in crowds that share most tokens, at depth 8, they miss 1 in 2000 at 0.85 and 1 in 80 at 0.80. Where
    a leaf lies across two of the partitions, that tree misses the pairs across.
    """
    id_type = docs.schema[id_col].dataType.simpleString()
    read = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    sketches = keep(
        read.mapInPandas(
            _sketcher(words, COORDINATES), f"_id {id_type}, _n bigint, _digest binary, _sketch binary"
        ),
        "sketches",
    )
    some = sketches.filter("_n > 0 AND _id IS NOT NULL")
    classes = some.groupBy("_digest").agg(
        F.min("_id").alias("_first"),
        F.count("*").alias("_rows"),
        F.first("_n").alias("_n"),
        F.first("_sketch").alias("_sketch"),
    )
    classes = keep(classes.withColumn("_class", F.monotonically_increasing_id()), "classes")
    share = percent / 100
    least = math.floor(
        COORDINATES * (share - MARGIN * math.sqrt(share * (1 - share) / COORDINATES))
    )
    walks = classes.select("_class", "_sketch").mapInPandas(
        _walker(trees, DEPTH, COORDINATES),
        "_tree int, _path binary, _tie bigint, _class bigint, _small binary",
    )
    # Walks are made twice, for the sample and for the shuffle: that is less work than storing them.
    order = ["_tree", "_path", "_tie"]
    runs = walks.repartitionByRange(*order).sortWithinPartitions(*order)
    edges = runs.mapInPandas(_node_reader(DEPTH, COORDINATES, least), "_a bigint, _b bigint")
    groups = keep(components(edges), "groups")
    members = keep(
        groups.join(classes.select("_class", "_first", "_digest", "_n", "_sketch"), "_class").select(
            F.col("_first").alias("_id"), "_class", "_label", "_digest", "_n",
            F.expr(
                f"unhex(concat_ws('', transform(sequence(0, {COORDINATES - 1}),"
                " i -> hex(substring(_sketch, 4 * i + 1, 1)))))"
            ).alias("_small"),
        ),
        "members",
    )
    texts = read.join(members, "_id").select(
        "_text", "_class", "_label", "_digest", "_n", "_small"
    )
    candidates = keep(
        texts.mapInPandas(
            _set_reader(words), "_class bigint, _label bigint, _n bigint, _small binary, _set binary"
        ).dropDuplicates(["_class"]),
        "candidate-sets",
    )
    links = components(_confirm(candidates, percent, COORDINATES))
    named = classes.select("_class", "_digest", "_first", "_rows").join(links, "_class", "left")
    named = keep(
        named.withColumn("_label", F.coalesce("_label", "_class")).select(
            "_digest", "_first", "_rows", "_label"
        ),
        "labelled-classes",
    )
    smallest = named.groupBy("_label").agg(
        F.min("_first").alias("_component"), F.count("*").alias("_in_label")
    )
    answer = keep(
        lookup(named, keep(smallest, "smallest"), ["_label"], "_in_label").select(
            "_digest", "_rows", "_component"
        ),
        "class-components",
    )
    linked_rows = lookup(some.select("_id", "_n", "_digest"), answer, ["_digest"], "_rows")
    alone = sketches.filter("_n = 0 OR _id IS NULL").select("_id", "_n", F.col("_id").alias("_component"))
    return (
        linked_rows.select("_id", "_n", "_component")
        .unionByName(alone)
        .select(
            F.col("_id").alias("doc_id"),
            F.col("_n").alias("n_shingles"),
            F.col("_component").alias("component_id"),
            F.col("_id").eqNullSafe(F.col("_component")).alias("kept"),
        )
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """The documents of ``docs`` that are kept, all columns as they were; ids must be unique."""
    dropped = near_duplicates(docs, **options).filter("NOT kept").select("doc_id")
    return docs.join(keep(dropped, "near-copies"), "doc_id", "left_anti").select(docs.columns)


@query()
def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=3, percent=85)
