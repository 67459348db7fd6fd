"""Near-duplicate documents by a signature-coordinate inverted join.

Documents with equal shingle sets form classes. Each class is posted under every (coordinate, minimum) pair of its
MinHash signature. Two sets of the wanted similarity agree in at least ``matches`` coordinates (up to a chance of about one
in a hundred thousand), so they share a posting among the first ``coordinates - matches + 1`` of each, in order of
rising frequency; postings behind that prefix, above all the very frequent ones, are skipped. Lists are split by size of
set, since sets of the wanted similarity have sizes in that ratio at least. A posting carries four bits of every
coordinate; collisions are counted on these, which can only count too many, and links are confirmed on whole sets.

Large groups are never expanded into all pairs: members are first compared with the leader of each posting list, the one
that shares most with others. What is then still apart, but collides often enough, makes families, which are compared block
by block inside tasks; these give out one link for each component that a member reaches.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spherecube.llm import texts as tx
from spherecube.llm.common import id_and_text, small_side, stored

COORDINATES = 64
MISS = 1e-5
BLOCK_SHINGLES = 1_000_000
#: members of a posting list that are compared with all others of it in one group
BLOCK_MEMBERS = 4096
#: pairs of members that a task holds at a time
BLOCK_PAIRS = 500_000


def least_matches(coordinates: int, similarity: float, miss: float = MISS) -> int:
    """Largest number of agreeing coordinates that a pair of this similarity falls below with a chance of ``miss`` at most."""
    chance, m = 0.0, 0
    while m < coordinates:
        chance += math.comb(coordinates, m) * similarity**m * (1 - similarity) ** (coordinates - m)
        if chance > miss:
            break
        m += 1
    return max(m, 1)


def shingle_sets(texts: tx.Texts, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of each text, (row, hash) sorted by row; a text of fewer words has its whole sequence as one."""
    words = texts.words(tx.SPACED, lower=True)
    position, value = words.grams(shingle)
    rows, values = [words.row[position]], [value]
    for n in range(1, shingle):
        position, value = words.grams(n)
        short = words.counts[words.row[position]] == n
        rows.append(words.row[position[short]])
        values.append(value[short])
    row, value = np.concatenate(rows), np.concatenate(values)
    order = np.lexsort((value, row))
    row, value = row[order], value[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (value[1:] != value[:-1])
    return row[new], value[new]


def _functions(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    random = np.random.default_rng(20240817)
    return random.integers(0, 1 << 63, coordinates, dtype=np.uint64), random.integers(0, 1 << 63, coordinates, dtype=np.uint64) | np.uint64(1)


def signatures(docs: DataFrame, shingle: int, coordinates: int) -> DataFrame:
    """doc_id, n_shingles, two independent sums over the set (its identity) and the signature, four bytes a coordinate."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flips, factors = _functions(coordinates)
        for part, texts in tx.chunks(batches, "text"):
            row, value = shingle_sets(texts, shingle)
            count = np.bincount(row, minlength=texts.n).astype(np.int64)
            filled = np.flatnonzero(count)
            begin = (np.cumsum(count) - count)[filled]
            a, b = np.zeros(texts.n, dtype=np.uint64), np.zeros(texts.n, dtype=np.uint64)
            minima = np.zeros((texts.n, coordinates), dtype="<u4")
            if len(filled):
                a[filled] = np.add.reduceat(tx.mix(value), begin)
                b[filled] = np.add.reduceat(tx.mix(value ^ np.uint64(0x5851F42D4C957F2D)), begin)
                for k in range(coordinates):
                    mapped = (((value ^ flips[k]) * factors[k]) >> np.uint64(32)).astype(np.uint32)
                    minima[filled, k] = np.minimum.reduceat(mapped, begin)
            packed = pa.array([x.tobytes() if c else None for x, c in zip(minima, count, strict=True)], pa.binary())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(count), pa.array(tx.signed(a)), pa.array(tx.signed(b)), packed], names=["doc_id", "n_shingles", "set_a", "set_b", "signature"])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.mapInArrow(compute, f"doc_id {kind}, n_shingles bigint, set_a bigint, set_b bigint, signature binary")


def _postings(classes: DataFrame, coordinates: int) -> DataFrame:
    """node, token: one row for each class and coordinate."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = tx.mix(np.arange(1, coordinates + 1, dtype=np.uint64) << np.uint64(32))
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                minima = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype="<u4").reshape(part.num_rows, coordinates)
                token = tx.mix(minima.astype(np.uint64) + salt)
                node = part.column("node").take(pa.array(np.repeat(np.arange(part.num_rows), coordinates)))
                yield pa.RecordBatch.from_arrays([node, pa.array(tx.signed(token.ravel()))], names=["node", "token"])

    kind = dict(classes.dtypes)["node"]
    return classes.select("node", "signature").mapInArrow(compute, f"node {kind}, token bigint")


def _prefixes(postings: DataFrame, coordinates: int, matches: int) -> DataFrame:
    """node, token, weight: the rarest postings of each class that a match can't avoid, of those that another class has too.

    ``weight`` tells how much of its signature a class shares with many others; the original of a family has the most.
    """
    shared = postings.groupBy("token").count().filter("count > 1")
    own = postings.join(shared, "token").groupBy("node").agg(F.sort_array(F.collect_list(F.struct("count", "token"))).alias("tokens"), F.sum(F.log("count")).alias("weight"))
    # postings of one class only are the rarest and come first, so they use up part of the prefix
    own = own.filter(F.size("tokens") >= matches)
    kept = own.select("node", "weight", F.explode(F.slice("tokens", F.lit(1), F.size("tokens") - (matches - 1))).alias("t"))
    return kept.select("node", "weight", F.col("t.token").alias("token"))


def components(links: DataFrame) -> DataFrame:
    """Smallest node reachable from each node of the links (a, b): node, component. Alternating large and small stars."""
    edges = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    state = None
    while True:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        # every larger neighbour goes to the smallest one
        large = edges.select(F.col("v").alias("u"), F.col("u").alias("v")).join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.filter("u > v").distinct(), "large-star")
        # every smaller neighbour, and the node itself, go to the smallest one
        small_least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small_least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v")
        edges = stored(moved.union(small_least.select("u", F.col("m").alias("v"))).distinct(), "small-star")
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == state:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        state = now


def _wanted_sets(docs: DataFrame, wanted: DataFrame, shingle: int) -> DataFrame:
    """node, shingles: the whole sets of the wanted classes, taken again from their texts."""
    ids = wanted.select(F.col("node").alias("doc_id")).distinct()
    chosen = docs.join(small_side(ids), "doc_id", "left_semi")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in tx.chunks(batches, "text"):
            row, value = shingle_sets(texts, shingle)
            bounds = np.searchsorted(row, np.arange(texts.n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(bounds), pa.array(tx.signed(value)))], names=["node", "shingles"])

    kind = dict(docs.dtypes)["doc_id"]
    return chosen.mapInArrow(compute, f"node {kind}, shingles array<bigint>").filter(F.size("shingles") > 0).dropDuplicates()


def _digests(classes: DataFrame, coordinates: int) -> DataFrame:
    """node, n_shingles, digest: the lowest four bits of each minimum, sixteen coordinates to a long."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                minima = np.frombuffer(b"".join(part.column("signature").to_pylist()), dtype="<u4").reshape(part.num_rows, coordinates)
                nibbles = np.zeros((part.num_rows, -(-coordinates // 16) * 16), dtype=np.uint64)
                nibbles[:, :coordinates] = minima & np.uint32(15)
                longs = (nibbles.reshape(part.num_rows, -1, 16) << (np.arange(16, dtype=np.uint64) * np.uint64(4))).sum(axis=2, dtype=np.uint64)
                bounds = pa.array(np.arange(part.num_rows + 1, dtype=np.int32) * longs.shape[1])
                digest = pa.ListArray.from_arrays(bounds, pa.array(tx.signed(longs.ravel())))
                yield pa.RecordBatch.from_arrays([part.column("node"), part.column("n_shingles"), digest], names=["node", "n_shingles", "digest"])

    kind = dict(classes.dtypes)["node"]
    return classes.select("node", "n_shingles", "signature").mapInArrow(compute, f"node {kind}, n_shingles bigint, digest array<bigint>")


def _collide(one: str, two: str, coordinates: int, matches: int, percent: int) -> Column:
    """Whether two postings, with ``n`` and ``digest``, have sizes in the ratio and agree in ``matches`` coordinates or more."""
    agree = F.lit(coordinates)
    for k in range(-(-coordinates // 16)):
        differ = F.col(f"{one}.digest")[k].bitwiseXOR(F.col(f"{two}.digest")[k])
        pairs = differ.bitwiseOR(F.shiftright(differ, 1))
        agree = agree - F.bit_count(pairs.bitwiseOR(F.shiftright(pairs, 2)).bitwiseAND(F.lit(0x1111111111111111)))
    na, nb = F.col(f"{one}.n"), F.col(f"{two}.n")
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (agree >= matches)


def _posted(prefix: DataFrame, digests: DataFrame, percent: int) -> DataFrame:
    """token, band, node, weight, n, digest: each posting in the list of its size and in that of the next smaller sizes.

    Bands are a little wider than the ratio of sizes, so that of two sets that can be linked both lie in the list of the smaller.
    """
    band = F.floor(F.log("n_shingles") / (1.01 * math.log(100 / percent))) if percent < 100 else F.col("n_shingles")
    placed = digests.select("node", F.col("n_shingles").alias("n"), "digest", band.alias("own"))
    return prefix.join(placed, "node").select("token", F.explode(F.array("own", F.col("own") - 1)).alias("band"), "node", "weight", "n", "digest")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole sets have the wanted similarity."""
    one, two = (sets.select(F.col("node").alias(c), F.col("shingles").alias(f"s{c}")) for c in "ab")
    both = pairs.join(one, "a").join(two, "b")
    na, nb = F.size("sa"), F.size("sb")
    both = both.filter((F.least(na, nb) * 100 >= F.greatest(na, nb) * percent)).withColumn("shared", F.size(F.array_intersect("sa", "sb")))
    return both.filter(F.col("shared") * 100 >= (na + nb - F.col("shared")) * percent).select("a", "b")


def _differing(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Number of four-bit places in which the rows of two digests differ, as :func:`_collide` counts them."""
    bits = one ^ two
    bits |= bits >> np.uint64(1)
    bits |= bits >> np.uint64(2)
    return np.bitwise_count(bits & np.uint64(0x1111111111111111)).sum(axis=1, dtype=np.int64)


def _pairs_within(group: np.ndarray, limit: int = BLOCK_PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs (a, b) of rows with the same number in the sorted ``group``, about ``limit`` at a time."""
    begin = np.searchsorted(group, group, side="left")
    before = np.arange(len(group)) - begin
    total = np.cumsum(before)
    at = 0
    while at < len(group):
        done = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, done + limit, side="right")))
        size = before[at:stop]
        b = np.repeat(np.arange(at, stop), size)
        a = np.arange(len(b)) - np.repeat(np.cumsum(size) - size, size) + begin[b]
        yield a, b
        at = stop


def _join_roots(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Give the numbers that the pairs (a, b) hold together the same root; ``root`` is flat before and after."""
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        open_ = low != high
        if not open_.any():
            return
        a, b = a[open_], b[open_]
        np.minimum.at(root, high[open_], low[open_])
        while True:
            further = root[root]
            if np.array_equal(further, root):
                break
            root[:] = further


def _candidates(entries: DataFrame, component: DataFrame, coordinates: int, matches: int, percent: int) -> DataFrame:
    """node, component, other: members of a posting list that collide often enough with one of another component.

    Members whose components hang together by such pairs have the same ``other``, one of these components: a list gives out its
    members, not its pairs. One whose members are all linked already has nothing to add. Long ones are compared in blocks of BLOCK_MEMBERS.
    """
    located = entries.join(component, "node", "left").withColumn("component", F.coalesce("component", "node"))
    located = stored(located.select("token", "band", "node", "component", "n", "digest"), "located")
    mixed = located.groupBy("token", "band").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members"))
    blocks = F.ceil(F.col("members") / BLOCK_MEMBERS).cast("int")
    mixed = stored(mixed.filter("low != high").select("token", "band", blocks.alias("blocks")), "mixed-lists")
    members = located.join(small_side(mixed), ["token", "band"]).withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    members = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    cells = members.select("token", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "component", "n", "digest")
    cells = cells.repartition("token", "band", "i", "j").sortWithinPartitions("token", "band", "i", "j")

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for cell, batch in tx.groups(batches, ["token", "band", "i", "j"]):
            code = batch.column("component").dictionary_encode()
            root, code = np.arange(len(code.dictionary)), np.asarray(code.indices).astype(np.int64)
            n, block = np.asarray(batch.column("n")), np.asarray(batch.column("block"))
            across = np.asarray(batch.column("i")) != np.asarray(batch.column("j"))
            digest = np.asarray(batch.column("digest").flatten()).view(np.uint64).reshape(batch.num_rows, -1)
            found = np.zeros(batch.num_rows, dtype=bool)
            for a, b in _pairs_within(cell):
                # pairs of one block are left to that block's own cell
                some = (code[a] != code[b]) & ~(across[a] & (block[a] == block[b]))
                a, b = a[some], b[some]
                some = np.minimum(n[a], n[b]) * 100 >= np.maximum(n[a], n[b]) * percent
                a, b = a[some], b[some]
                some = coordinates - _differing(digest[a], digest[b]) >= matches
                a, b = a[some], b[some]
                found[a] = found[b] = True
                _join_roots(root, code[a], code[b])
            rows = np.flatnonzero(found)
            first = np.zeros(len(root), dtype=np.int64)
            first[code[::-1]] = np.arange(batch.num_rows)[::-1]
            node = np.asarray(batch.column("node").dictionary_encode().indices)[rows]
            rows = rows[np.unique(node, return_index=True)[1]]
            component_of = batch.column("component")
            yield pa.RecordBatch.from_arrays(
                [batch.column("node").take(pa.array(rows)), component_of.take(pa.array(rows)), component_of.take(pa.array(first[root[code[rows]]]))],
                names=["node", "component", "other"])

    kind = dict(entries.dtypes)["node"]
    return cells.mapInArrow(compute, f"node {kind}, component {kind}, other {kind}").distinct()


def _family_links(met: DataFrame, docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) between components that colliding members hold together: one for each member and component it reaches.

    Members outside a family's largest component are compared on whole sets with all members, block by block inside tasks;
    only links come out. Blocks have about BLOCK_SHINGLES shingles, and each side is repeated for the blocks of the other.
    """
    family = components(met.select(F.col("component").alias("a"), F.col("other").alias("b")))
    placed = met.select("node", "component").distinct()
    placed = placed.join(family.select(F.col("node").alias("component"), F.col("component").alias("family")), "component", "left")
    placed = stored(placed.select("node", F.coalesce("family", "component").alias("family"), "component"), "placed")
    sets = stored(_wanted_sets(docs, placed, shingle), "family-sets")
    placed = stored(placed.join(sets.select("node", F.size("shingles").alias("n")), "node"), "families")
    parts = placed.groupBy("family", "component").agg(F.sum("n").alias("n"))
    largest = parts.groupBy("family").agg(
        F.max_by("component", F.struct("n", "component")).alias("largest"), F.count("*").alias("parts"), F.sum("n").alias("n"), F.max("n").alias("most"),
    ).filter("parts > 1")
    blocks = [F.ceil(size / BLOCK_SHINGLES).cast("int") for size in (F.col("n") - F.col("most"), F.col("n"))]
    largest = largest.select("family", "largest", blocks[0].alias("few"), blocks[1].alias("all"))
    members = stored(placed.drop("n").join(largest, "family").join(sets, "node"), "members")

    def block(count: str):
        return F.pmod(F.xxhash64("node"), F.col(count)).cast("int")

    def each(count: str):
        return F.explode(F.sequence(F.lit(0), F.col(count) - 1))

    one = members.filter("component != largest").select("family", block("few").alias("i"), each("all").alias("j"), "node", "component", "shingles")
    two = members.select("family", each("few").alias("i"), block("all").alias("j"), "node", "component", "shingles")

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(left) and len(right):
            size = right["shingles"].map(len).to_numpy()
            words, number = np.unique(np.concatenate(right["shingles"].to_list()), return_inverse=True)
            begin = np.cumsum(size) - size
            part, nodes = pd.factorize(right["component"])[0], right["node"].to_numpy()
            components_of = right["component"].to_numpy()
            flag = np.zeros(len(words), dtype=np.int64)
            for node, own, shingles in zip(left["node"], left["component"], left["shingles"], strict=True):
                slot = np.minimum(np.searchsorted(words, shingles), len(words) - 1)
                slot = slot[words[slot] == shingles]
                flag[slot] = 1
                shared = np.add.reduceat(flag[number], begin)
                flag[slot] = 0
                hit = np.flatnonzero((100 * shared >= percent * (size + len(shingles) - shared)) & (components_of != own))
                _, first = np.unique(part[hit], return_index=True)
                found += [(node, nodes[k]) for k in hit[first]]
        return pd.DataFrame(found, columns=["a", "b"])

    kind = dict(met.dtypes)["node"]
    keys = ["family", "i", "j"]
    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInPandas(meet, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", coordinates: int = COORDINATES) -> DataFrame:
    """One row for each input row: doc_id, n_shingles, component_id (smallest doc_id reachable over links), kept.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Documents without words, null texts among them,
    have empty sets and are linked with nothing. Rows that repeat a doc_id stand for one document: they share its
    component and are all kept or not. Rows without doc_id are kept only where no row with one has the same set, and
    their component is that row's, or null. Ties (equal sets) fall to the smallest doc_id.
    """
    docs = id_and_text(docs, id_col, text_col)
    matches = least_matches(coordinates, percent / 100)
    signed = stored(signatures(docs, shingle, coordinates), "signatures")
    key = ["set_a", "set_b", "n_shingles"]
    of_set = signed.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("node")).filter("node is not null")
    classes = stored(signed.join(of_set, key).filter("doc_id = node").dropDuplicates([*key, "node"]).select("node", *key, "signature"), "classes")
    prefix = stored(_prefixes(_postings(classes, coordinates), coordinates, matches), "prefixes")
    posted = stored(_posted(prefix, _digests(classes, coordinates), percent), "posted")
    entry = F.struct("node", "n", "digest")
    lists = posted.groupBy("token", "band").agg(F.count("*").alias("members"), F.max_by(entry, F.struct("weight", "node")).alias("first")).filter("members > 1")
    lists = stored(lists.select("token", "band", "first"), "lists")
    with_leaders = posted.select("token", "band", entry.alias("own")).join(lists, ["token", "band"])
    with_leaders = with_leaders.filter((F.col("own.node") != F.col("first.node")) & _collide("own", "first", coordinates, matches, percent))
    pairs = with_leaders.select(F.least("own.node", "first.node").alias("a"), F.greatest("own.node", "first.node").alias("b"))
    pairs = stored(pairs.distinct(), "leader-pairs")
    sets = stored(_wanted_sets(docs, stored(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct(), "wanted"), shingle), "sets")
    component = components(stored(_confirmed(pairs, sets, percent), "links"))

    entries = posted.join(lists.select("token", "band"), ["token", "band"], "left_semi")
    rest = stored(_candidates(entries, component, coordinates, matches, percent), "candidates")
    more = stored(_family_links(rest, docs, shingle, percent), "family-links")
    if not more.isEmpty():
        component = components(component.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))

    member = signed.select("doc_id", *key).join(classes.select("node", *key), key, "left").join(component, "node", "left")
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")).otherwise(F.col("doc_id"))
    out = member.select("doc_id", "n_shingles", own.alias("component_id"))
    out = out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
    return out
