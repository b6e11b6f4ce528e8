"""MinHash near-deduplication by a multi-index join in the Hamming space of signatures.

A signature has SYMBOLS minima of BITS bits each, and its distance is the number of symbols in which
two signatures differ. The symbols are split into CHUNKS chunks. Two signatures at a distance below
ERRORS + 1 times CHUNKS have, by the pigeonhole principle, a chunk with no more than ERRORS = 1
differences, so each chunk is indexed once for each symbol that may differ, by its other symbols.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from recordflow.llm.memory import giving_back
from recordflow.llm.shingles import mix, shingle_set
from recordflow.ml.components import connected_components
from recordflow.operators.lookups import lookup, saved, saved_rows

SYMBOLS = 128
BITS = 16
CHUNKS = 24
#: All pairs up to this distance are found. Sets of similarity 0.8 differ in 25.6 symbols on
#: average, with a deviation of 4.5; more than 47 have a chance of 3.6 in a million at similarity 0.8.
DISTANCE = 2 * CHUNKS - 1
#: Members of a bucket that are compared with each other in one step.
BLOCK = 256
#: Closest pairs of two components in such a step that are confirmed first; each further round takes
#: so many times more, until none is left out.
QUOTA = 8

_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
MASKS = _rng.integers(0, 2**63, SYMBOLS, dtype=np.uint64)
CHUNK_OF = np.arange(SYMBOLS) * CHUNKS // SYMBOLS
STARTS = np.searchsorted(CHUNK_OF, np.arange(CHUNKS))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The lowest hash of the set under each of SYMBOLS functions, cut to BITS bits."""
    low = np.full(SYMBOLS, np.iinfo(np.uint64).max)
    for a in range(0, len(shingles), 1024):
        part = shingles[a : a + 1024, None]
        np.minimum(low, ((part ^ MASKS) * FACTORS).min(axis=0), out=low)
    return (mix(low) & np.uint64((1 << BITS) - 1)).astype("<u2")


def index_keys(signatures: np.ndarray) -> np.ndarray:
    """For each signature the keys of its chunks, each with one symbol left out in turn."""
    terms = mix((signatures.astype(np.uint64) + np.uint64(1)) * FACTORS + MASKS)
    sums = np.add.reduceat(terms, STARTS, axis=1)[:, CHUNK_OF]
    return mix(sums - terms + MASKS).view(np.int64)


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(``doc_id``, ``n_shingles``, ``digest``, ``signature``); the last two are null for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in giving_back(batches):
            sizes, digests, signatures = [], [], []
            for text in batch.column(1):
                shingles = shingle_set(text.as_py(), width)
                sizes.append(len(shingles))
                full = len(shingles) > 0
                digests.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if full else None)
                signatures.append(signature(shingles).tobytes() if full else None)
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(signatures, pa.binary())], names)

    names = ["doc_id", "n_shingles", "digest", "signature"]
    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(
        run, f"doc_id {kind}, n_shingles long, digest binary, signature binary"
    )


def keyed(groups: DataFrame) -> DataFrame:
    """(``key``, ``node``, ``size``), SYMBOLS rows for each row of ``groups``."""

    def run(batches):
        for batch in giving_back(batches):
            for a in range(0, batch.num_rows, 2000):
                part = batch.slice(a, 2000)
                keys = index_keys(unpack(part.column(2)))
                nodes, sizes = (np.repeat(part.column(i).to_numpy(zero_copy_only=False), SYMBOLS) for i in (0, 1))
                columns = [pa.array(keys.ravel()), pa.array(nodes), pa.array(sizes)]
                yield pa.RecordBatch.from_arrays(columns, ["key", "node", "size"])

    kind = dict(groups.dtypes)["node"]
    rows = groups.select("node", F.col("size").cast("int").alias("size"), "signature")
    return rows.mapInArrow(run, f"key long, node {kind}, size int")


def unpack(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u2").reshape(-1, SYMBOLS)


def near(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) whose signatures and set sizes allow a link."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                apart = (unpack(batch.column(4)) != unpack(batch.column(5))).sum(axis=1)
                sizes = np.sort([batch.column(2).to_numpy(), batch.column(3).to_numpy()], axis=0)
                fits = (apart <= DISTANCE) & (100 * sizes[0] >= percent * sizes[1])
                yield batch.select(["a", "b"]).filter(pa.array(fits))

    for end in ("a", "b"):
        side = groups.select(
            F.col("node").alias(end), F.col("size").alias(f"size_{end}"), F.col("signature").alias(f"signature_{end}")
        )
        pairs = pairs.join(side, end)
    kind = dict(groups.dtypes)["node"]
    wide = pairs.select("a", "b", "size_a", "size_b", "signature_a", "signature_b")
    return saved(wide.mapInArrow(run, f"a {kind}, b {kind}"), "near_pairs")


def linked(pairs: DataFrame, docs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs whose full sets reach the similarity; texts are read again for their ids only."""

    def sets(batches):
        for batch in giving_back(batches):
            values = [shingle_set(t.as_py(), width).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values, pa.binary())], ["node", "shingles"])

    def run(batches):
        for batch in batches:
            fits = []
            for left, right in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                fits.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select(["a", "b"]).filter(pa.array(fits, pa.bool_()))

    kind = dict(pairs.dtypes)["a"]
    nodes = saved(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "near_nodes")
    texts = lookup(docs.select(F.col("doc_id").alias("node"), F.col("text").cast("string")), nodes, ["node"], "inner")
    full = saved(texts.mapInArrow(sets, f"node {kind}, shingles binary"), "near_sets")
    for end in ("a", "b"):
        pairs = pairs.join(full.select(F.col("node").alias(end), F.col("shingles").alias(f"set_{end}")), end)
    wide = pairs.select("a", "b", "set_a", "set_b")
    return saved(wide.mapInArrow(run, f"a {kind}, b {kind}"), "linked_pairs")


def crossing(members: DataFrame, groups: DataFrame, percent: int, quota: int) -> DataFrame:
    """(``a``, ``b``, ``more``): near members of a bucket that do not have the same ``root`` yet.

    ``members`` has ``key``, ``node`` and ``root``. Only members of different roots are compared: those
    of a bucket's largest root and the others are dealt into blocks, and each pair of blocks, one of
    them of others, is a piece of work of its own. A pair of members counts in the first of its common buckets only,
    and of each pair of roots the ``quota`` closest ones are handed on; ``more`` says that others were
    held back. So neither a large group that is connected already nor two large ones that are near are multiplied.
    """
    roots = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("n"))
    mixed = roots.groupBy("key").agg(
        F.max_by("root", F.struct("n", "root")).alias("main"), F.max("n").alias("mains"), F.sum("n").alias("all")
    )
    mixed = mixed.filter(F.col("all") > F.col("mains")).select(
        "key",
        "main",
        F.ceil(F.col("mains") / BLOCK).cast("int").alias("main_blocks"),
        F.ceil((F.col("all") - F.col("mains")) / BLOCK).cast("int").alias("blocks"),
    )
    dealt = members.join(mixed, "key").withColumn("is_main", F.col("root") == F.col("main"))
    into = F.when(F.col("is_main"), F.col("main_blocks")).otherwise(F.col("blocks"))
    dealt = saved(dealt.withColumn("block", F.pmod(F.xxhash64("node"), into).cast("int")), "crossing_members")

    def each(count: str, unit):
        return F.transform(F.sequence(F.lit(0), F.col(count) - 1), unit)

    def unit(i, j):
        return F.struct(i.alias("i"), j.alias("j"))

    block, after = F.col("block"), F.col("main_blocks")
    mains = each("blocks", lambda j: unit(block, j))
    with_mains = each("main_blocks", lambda i: unit(i, block))
    with_others = each("blocks", lambda o: unit(after + F.least(o, block), F.greatest(o, block)))
    units = F.when(F.col("is_main"), mains).otherwise(F.concat(with_mains, with_others))
    dealt = dealt.select("key", "node", "root", "is_main", "block", "main_blocks", F.explode(units).alias("unit"))
    side = groups.select("node", "size", "signature")
    ordered = (
        dealt.join(side, "node")
        .select("key", "unit.*", "node", "root", "is_main", "block", "main_blocks", "size", "signature")
        .repartition("key", "i", "j")
        .sortWithinPartitions("key", "i", "j")
    )

    def compare(rows: pa.Table):
        node, root, block, size = (rows.column(c).to_numpy() for c in ("node", "root", "block", "size"))
        is_main = rows.column("is_main").to_numpy()
        key, i, j, after = (rows.column(c)[0].as_py() for c in ("key", "i", "j", "main_blocks"))
        marks, keys = unpack(rows.column("signature")), None
        left = np.flatnonzero(is_main if i < after else block == i - after)
        right = ~is_main & (block == j)
        found: dict[tuple, list[tuple]] = {}
        for x in left:
            y = np.flatnonzero(right & (root != root[x]) & ((node > node[x]) if i - after == j else True))
            y = y[100 * np.minimum(size[y], size[x]) >= percent * np.maximum(size[y], size[x])]
            apart = (marks[y] != marks[x]).sum(axis=1)
            y, apart = y[apart <= DISTANCE], apart[apart <= DISTANCE]
            if not len(y):
                continue
            if keys is None:
                keys = index_keys(marks)
            common = keys[y] == keys[x]
            here = keys[x][common.argmax(axis=1)] == key
            for k, far in zip(y[here].tolist(), apart[here].tolist()):
                both = (node[x].item(), node[k].item())
                ends = (root[x].item(), root[k].item())
                found.setdefault((min(ends), max(ends)), []).append((far, min(both), max(both)))
        for pairs in found.values():
            closest = sorted(pairs)[:quota]
            for _, a, b in closest:
                yield a, b, len(pairs) > quota

    def run(batches):
        held = None  # rows of a unit that may go on in the next batch
        for batch in chain(batches, [None]):
            found: list[tuple] = []
            if batch is not None:
                table = pa.Table.from_batches([batch])
                held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            if held is not None and held.num_rows:
                ids = np.stack([held.column(c).to_numpy() for c in ("key", "i", "j")])
                cuts = np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1
                edges = [0, *cuts.tolist(), *([held.num_rows] if batch is None else [])]
                for a, b in zip(edges, edges[1:]):
                    if b - a > 1:
                        found += compare(held.slice(a, b - a))
                held = held.slice(edges[-1])
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(side) for side in zip(*found)], ["a", "b", "more"])

    kind = dict(groups.dtypes)["node"]
    return ordered.mapInArrow(run, f"a {kind}, b {kind}, more boolean")


def mark_near_copies(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): ``doc_id``, ``n_shingles``,
    ``component_id``, ``kept``.

    Two texts are linked when their sets of ``width``-word shingles have a Jaccard similarity of
    ``percent`` or more, 80 at least. Links are found by the index, which misses no pair within
    DISTANCE of each other, and confirmed on the full sets. ``component_id`` is the smallest id that
    can be reached over links, and the row with that id is ``kept``.

    Texts with the same set are one node from the start. Each node is paired with the lowest node of
    each of its buckets whose size allows a link, first the one met most often; what is connected by then need not be compared
    again, so a large group of copies costs a few pairs for each of its members. Members of a
    bucket that are still unconnected are compared in blocks, in rounds: the closest pairs of any two components
    are confirmed first, and the next ones only of those that are still apart.

    A null or empty text, or one of white space, has no shingles and is linked with nothing. A row
    without an id is its own component, with a null ``component_id``, and kept. Rows that repeat an id
    and a text are all returned, with the same result; ids with several texts are one node. An empty
    table gives an empty result. Other columns are not looked at.
    """
    if percent < 80:
        raise ValueError("the distance of the index is set for similarities of 0.8 or more")
    prints = saved(fingerprints(docs, width), "fingerprints")
    groups = saved(
        prints.filter("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(
            F.min("doc_id").alias("node"),
            F.any_value("n_shingles").alias("size"),
            F.any_value("signature").alias("signature"),
        ),
        "shingle_groups",
    )
    keys = keyed(groups)
    buckets = keys.groupBy("key").agg(F.min(F.struct("node", "size")).alias("c"), F.count(F.lit(1)).alias("members"))
    buckets = buckets.filter("members > 1").select(
        "key", F.col("c.node").alias("center"), F.col("c.size").alias("center_size"), "members"
    )
    members = saved(keys.join(saved(buckets, "buckets"), "key"), "bucket_members")
    fits = 100 * F.least("size", "center_size").cast("long") >= percent * F.greatest("size", "center_size").cast("long")
    stars = saved(
        members.filter((F.col("node") != F.col("center")) & fits)
        .groupBy("node", "center")
        .agg(F.count(F.lit(1)).alias("met")),
        "stars",
    )
    first = stars.groupBy(F.col("node").alias("b")).agg(F.max_by("center", F.struct("met", "center")).alias("a"))
    links = linked(near(first.select("a", "b"), groups, percent), docs, width, percent)

    nodes = saved(members.select("node").distinct(), "bucket_nodes")
    roots, entries = saved_rows(connected_components(nodes, links), "roots")

    def with_root(rows: DataFrame, end: str, name: str) -> DataFrame:
        table = roots.select(F.col("node").alias(end), F.col("root").alias(name))
        return lookup(rows, table, [end], "inner", entries=entries)

    checked = None

    def also(pairs: DataFrame) -> None:
        """Connect what the open pairs link."""
        nonlocal links, roots, checked
        pairs, size = saved_rows(pairs if checked is None else pairs.join(checked, ["a", "b"], "left_anti"), "open_pairs")
        checked = pairs if checked is None else checked.union(pairs)
        if size:
            links = saved(links.union(linked(pairs, docs, width, percent)), "links")
            roots = saved(connected_components(nodes, links), "roots")

    rest = with_root(with_root(stars, "node", "root"), "center", "center_root").filter("root <> center_root")
    also(near(rest.select(F.col("center").alias("a"), F.col("node").alias("b")), groups, percent))
    # All members are paired with the center; what is left are members in other components.
    inner = saved(members.filter("members > 2 and node <> center").select("key", "node"), "inner_members")
    quota, held_back = QUOTA, 1
    while held_back:
        others = saved(with_root(inner, "node", "root"), "others")
        pairs = saved(crossing(others, groups, percent, quota), "crossing_pairs")
        held_back = pairs.filter("more").count()
        also(pairs.select("a", "b").distinct())
        quota *= QUOTA

    lowest = roots.groupBy("root").agg(F.min("node").alias("component_id"))
    found, entries = saved_rows(lookup(roots, lowest, ["root"]).select("node", "component_id"), "components_by_node")
    classes = lookup(groups.select("digest", "node"), found, ["node"], entries=entries)
    classes = classes.select("digest", F.coalesce("component_id", "node").alias("component_id"))
    marked = lookup(prints.select("doc_id", "n_shingles", "digest"), saved(classes, "classes"), ["digest"])
    alone = F.col("digest").isNull() | F.col("doc_id").isNull()
    component = F.when(alone, F.col("doc_id")).otherwise(F.col("component_id"))
    return marked.select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
