"""Near-duplicate groups from bottom-k sketches.

A text's set is that of its ``width``-word shingles, each hashed to 64 bits by one hash
function; its sketch is the ``k`` smallest hashes. Texts with equal sets are one class, and
only the smallest id of a class goes on.

**Inverted lists.** Of two sets with a similarity of 0.8 or more, each value among the
``k`` smallest of their union is in both sketches with that probability. So the two
sketches nearly surely share ``RUN`` values that follow each other without any other in
between, and a list is kept for each such run, not for each single value: a common shingle
then gives no list of half the corpus. For sets that a sketch holds whole the shared run is
certain: d differing values cut s shared ones into at most d + 1 runs, of which one has
s / (d + 1) values or more; that is 4 from 16 values on, and small sets get lists for runs
of two besides. For longer sketches the chance to miss a link at exactly 0.8 is about 2e-6
(k = 96), and falls fast above.

**Links without all pairs.** First every member of a list is compared with the list's
smallest id only, so n members make n - 1 pairs, and what is linked becomes a component.
Lists whose members then are one component have nothing left to find: that holds for groups
of copies, however large. In the other lists only members of different components are left
to compare. Lists up to ``SHORT`` members give those pairs, some dozens for each row at most.
Longer ones are joined to families and dealt out in pairs of blocks: a task gets two blocks
of sets, counts all shared values by products of incidence matrices, and returns no pairs
but a spanning forest of the links between components. So no link is lost, nothing is
capped and no pair that is not needed is ever a row; for a family of m members of which many
are similar but not linked the comparisons still grow with the square of m, spread over
(m / block)^2 / 2 tasks.

A candidate's union sketch, the k smallest values of both sketches, estimates the
similarity; where that is far too low the pair is dropped, else full sets decide.

Components are found by the same kind of tables: a task joins the links it holds, then each
member takes the smallest id that its neighbours know, until each hangs on its component's.

Cases: null and empty texts, and texts without words, have an empty set and no link; a text
with fewer words than a shingle has one shingle, the whole sequence. Repeated rows are
copies of each other; rows with a null id are counted but take no part in links, as no id
can name their component: it is null. An empty table gives no rows. Other columns are not
read.
"""

from __future__ import annotations


import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from foretell.llm.common import map_texts, stored, texts_of

#: Sketch size, values in a run, set size below which runs of two count, longest short list.
K, RUN, SMALL, SHORT = 96, 4, 16, 64
#: Edges that a task makes stars of at a time.
EDGES = 1 << 20
#: Sets and bytes in a block.
BLOCK, BLOCK_BYTES = 256, 16 << 20
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_SHIFT = np.uint64(32)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = (x ^ (x >> _SHIFT)) * _M2
    x = (x ^ (x >> _SHIFT)) * _M2
    return x ^ (x >> _SHIFT)


def _rows_hash(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` neighbours."""
    n = len(values) - width + 1
    out = np.full(n, width, np.uint64)
    for i in range(width):
        out = _mix(out * _M1 + values[i : i + n])
    return out


def shingle_hashes(text: str, width: int) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    # a set is a sorted array; np.unique() costs several times as much
    values = np.sort(_rows_hash(hashes, min(width, len(words))))
    return values[np.concatenate(([True], values[1:] != values[:-1]))]


def list_keys(sketch: np.ndarray) -> np.ndarray:
    """Keys of the inverted lists that a set with this sketch stands in."""
    keys = []
    if len(sketch) >= RUN:
        keys.append(_rows_hash(sketch, RUN))
    if RUN <= len(sketch) < SMALL:
        keys.append(_rows_hash(sketch, 2))
    return np.concatenate(keys) if keys else np.empty(0, np.uint64)


def _signed(values: np.ndarray) -> list[int]:
    return values.view(np.int64).tolist()


def sketches(df: DataFrame, width: int, k: int = K) -> DataFrame:
    """doc_id, n_shingles, set_hi/set_lo (digest of the set, null if empty), sketch and list keys."""

    def make():
        def work(text):
            values = shingle_hashes(text, width)
            if not len(values):
                return 0, None, None, None
            digest = xxhash.xxh3_128_intdigest(values.tobytes())
            halves = np.array([digest >> 64, digest & (1 << 64) - 1], np.uint64)
            return (len(values), *_signed(halves), _signed(list_keys(values[:k])))

        return work

    return map_texts(df, make, "n_shingles bigint, set_hi bigint, set_lo bigint, keys array<bigint>")


def _full_sets(df: DataFrame, width: int) -> DataFrame:
    def make():
        return lambda text: (shingle_hashes(text, width).tobytes(),)

    return map_texts(df, make, "members binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int, k: int = K) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    from collections.abc import Iterator

    import pyarrow as pa

    both = (
        pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("members").alias("of_a")), "a")
        .join(sets.select(F.col("doc_id").alias("b"), F.col("members").alias("of_b")), "b")
        .select("a", "b", "of_a", "of_b")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                keep.append(similar(x, y, percent, k))
            yield batch.filter(pa.array(keep, pa.bool_())).select([0, 1])

    return both.mapInArrow(run, pairs.select("a", "b").schema)


def union_sketch(x: np.ndarray, y: np.ndarray, k: int) -> tuple[int, int]:
    """Shared values among the k smallest of the union, and how many those are."""
    merged = np.sort(np.concatenate((x[:k], y[:k])), kind="stable")
    twice = merged[1:] == merged[:-1]
    fresh = np.concatenate(([True], ~twice))
    rank = np.cumsum(fresh)
    size = min(k, int(rank[-1]))
    return int((twice & (rank[1:] <= size)).sum()), size


def similar(x: np.ndarray, y: np.ndarray, percent: int, k: int = K) -> bool:
    """100 * shared >= percent * union, on full sets.

    The union sketch decides only where it leaves no doubt: its estimate is more than six
    standard deviations too low (one pair in 10^9 at the bound).
    """
    small, large = sorted((len(x), len(y)))
    if not small or 100 * small < percent * large:
        return False
    shared, size = union_sketch(x, y, k)
    p = percent / 100
    if size == k and shared < k * p - 6 * (k * p * (1 - p)) ** 0.5:
        return False
    merged = np.sort(np.concatenate((x, y)), kind="stable")
    both = int((merged[1:] == merged[:-1]).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest id of its component) in place of the edges (u, v)."""
    nodes, place = np.unique(np.concatenate((u, v)), return_inverse=True)
    root = np.arange(len(nodes))
    x, y = place[: len(u)], place[len(u) :]
    while len(x):
        # a root hangs on the smallest root that an edge of its tree leads to
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        x, y = root[x], root[y]
        x, y = x[x != y], y[x != y]
    hang = root != np.arange(len(nodes))
    return nodes[hang], nodes[root[hang]]


def _contracted(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with the same components, where up to ``EDGES`` rows that a task holds are stars."""
    from collections.abc import Iterator

    import pyarrow as pa

    most = EDGES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined():
            return stars(*(np.concatenate([x[i] for x in held]) for i in (0, 1)))

        def given(found):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["u", "v"])

        held, rows = [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in (0, 1)])
            rows += batch.num_rows
            if rows >= most:
                held = [joined()]
                rows = len(held[0][0])
                if 2 * rows >= most:
                    yield given(held[0])
                    held, rows = [], 0
        if rows:
            yield given(joined())

    return edges.mapInArrow(run, edges.schema)


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root): the smallest id reachable by the edges (a, b), for every node of an edge.

    A task first makes stars of the edges it holds, so few edges, which lie in one partition,
    need no round. Each round links what a node's neighbours know to the smallest of it (large
    star, small star); a node's rows are sums of its edges, so no group is gathered in one
    place. Rounds end when every node hangs on one other, or on none but itself: they are what
    the driver's memory goes into (some dozen jobs each, whatever the input's size).
    """
    pairs = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    for _ in range(rounds + 1):
        now = stored(_contracted(pairs.where("u <> v").distinct()), "edges")
        # a root hangs on itself
        hang = now.unionByName(now.select(F.col("v").alias("u"), "v"))
        torn = hang.groupBy("u").agg((F.min("v") < F.max("v")).alias("torn"))
        if not torn.agg(F.max("torn")).first()[0]:
            return hang.select(F.col("u").alias("node"), F.col("v").alias("root")).distinct()
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # every larger neighbour of u hangs on the smallest known to u
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        # u and its smaller neighbours hang on the smallest of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        pairs = large.join(least, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
    raise RuntimeError("components did not settle")


def _forest(edges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Of all edges, those that join two trees."""
    parent: dict[int, int] = {}

    def top(x):
        while (up := parent.get(x, x)) != x:
            parent[x] = parent.get(up, up)
            x = up
        return x

    out = []
    for a, b in edges:
        x, y = top(a), top(b)
        if x != y:
            parent[max(x, y)] = min(x, y)
            out.append((a, b))
    return out


def block_links(ids, comps, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between sets of different components."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, inverse, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    many = times[inverse] > 1  # a value of one set alone is shared with none
    number = np.cumsum(times > 1) - 1
    owner, column = owner[many], number[inverse[many]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(sets), len(sets)), np.float32)
    step = 2048
    width = int((times > 1).sum())
    for start in range(0, width, step):
        lo, hi = np.searchsorted(column, (start, start + step))
        part = np.zeros((len(sets), min(step, width - start)), np.float32)
        part[owner[lo:hi], column[lo:hi] - start] = 1
        shared += part @ part.T
    joint = sizes[:, None] + sizes[None, :] - shared
    comps = np.asarray(comps)
    linked = (100 * shared >= percent * joint) & (comps[:, None] != comps[None, :])
    x, y = np.nonzero(np.triu(linked, 1))
    found = [(int(ids[i]), int(ids[j])) for i, j in zip(x, y)]
    # members of one component count as joined already
    roots = {int(d): int(c) for d, c in zip(ids, comps)}
    kept = _forest([(roots[a], roots[b]) for a, b in found])
    return kept


def _family_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (between component ids) inside families; ``members``: family, rep, comp, n."""
    import pyarrow as pa

    size = members.groupBy("family").agg(
        F.greatest(F.ceil(F.count("*") / BLOCK), F.ceil(F.sum("n") * 8 / BLOCK_BYTES)).alias("blocks")
    )
    dealt = (
        members.join(size, "family")
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
        # a block meets every block, itself included, once
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .select(
            "family", "rep", "comp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
        )
        .join(sets.withColumnRenamed("doc_id", "rep"), "rep")
    )

    def run(key, members):
        comps = members.column("comp").to_pylist()
        found = [np.frombuffer(x, np.uint64) for x in members.column("members").to_pylist()]
        links = block_links(members.column("rep").to_pylist(), comps, found, percent) if len(set(comps)) > 1 else []
        a, b = (list(c) for c in zip(*links)) if links else ([], [])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return dealt.groupBy("family", "i", "j").applyInArrow(run, "a bigint, b bigint")


def near_groups(
    df: DataFrame, width: int = 5, percent: int = 80, k: int = K, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable), kept (it is that id) for each row.

    Two texts are linked if ``100 * shared >= percent * union`` holds for their shingle sets.
    """
    if percent < 80:
        raise ValueError("the inverted lists find links from 80 percent on")
    texts = texts_of(df, id_col, text_col).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    found = stored(sketches(texts, width, k), "sketches")
    # one representative for each distinct set
    classes = (
        found.where("set_hi is not null and doc_id is not null")
        .groupBy("set_hi", "set_lo")
        .agg(F.min("doc_id").alias("rep"), F.first("keys").alias("keys"), F.first("n_shingles").alias("n"))
    )
    a_list = Window.partitionBy("key")
    lists = stored(
        classes.select("rep", "n", F.explode(F.array_distinct("keys")).alias("key"))
        .withColumns({"members": F.count("*").over(a_list), "leader": F.min("rep").over(a_list)})
        .where("members > 1"),
        "lists",
    )
    leaders = lists.select(F.col("rep").alias("leader"), F.col("n").alias("of_leader")).distinct()
    star = stored(
        lists.where("rep <> leader")
        .select("leader", "rep", "n")
        .distinct()
        .join(leaders, "leader")
        .where(F.least("n", "of_leader") * 100 >= F.greatest("n", "of_leader") * percent)
        .select(F.col("leader").alias("a"), F.col("rep").alias("b")),
        "pairs",
    )
    listed = lists.select(F.col("rep").alias("doc_id")).distinct()
    sets = stored(_full_sets(texts.join(listed, "doc_id", "left_semi"), width).distinct(), "sets")
    first = stored(verified(star, sets, percent, k), "links")
    roots = components(first)
    labelled = lists.join(roots, F.col("rep") == F.col("node"), "left").select(
        "key", "rep", "n", "members", "leader", F.coalesce("root", "rep").alias("comp")
    )
    unlike = F.min("comp").over(a_list) != F.max("comp").over(a_list)
    open_lists = stored(labelled.withColumn("open", unlike).where("open").drop("open"), "open")
    x, y = (open_lists.where(f"members <= {SHORT}").select(*(F.col(c).alias(f"{p}_{c}") for c in ("key", "rep", "n", "comp"))) for p in "xy")
    rest = (
        x.join(y, F.col("x_key") == F.col("y_key"))
        .where("x_rep < y_rep and x_comp <> y_comp")
        .where(F.least("x_n", "y_n") * 100 >= F.greatest("x_n", "y_n") * percent)
        .select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b"))
        .distinct()
        .join(star, ["a", "b"], "left_anti")
    )
    links = first.unionByName(verified(rest, sets, percent, k))
    long_lists = open_lists.where(f"members > {SHORT}")
    if not long_lists.isEmpty():
        families = components(long_lists.select(F.col("rep").alias("a"), F.col("leader").alias("b")).distinct())
        members = stored(
            long_lists.select("rep", "n", "comp")
            .distinct()
            .join(families, F.col("rep") == F.col("node"))
            .select(F.col("root").alias("family"), "rep", "comp", "n"),
            "families",
        )
        links = links.unionByName(_family_links(members, sets, percent))
    final = components(links)
    named = (
        found.where("set_hi is not null and doc_id is not null")
        .groupBy("set_hi", "set_lo")
        .agg(F.min("doc_id").alias("rep"))
        .join(final, F.col("rep") == F.col("node"), "left")
        .select("set_hi", "set_lo", F.coalesce("root", "rep").alias("class_root"))
    )
    return (
        found.join(named, ["set_hi", "set_lo"], "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("class_root", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))
    )
