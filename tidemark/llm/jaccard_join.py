"""N-gram Jaccard join by vertical partitioning.

The hash order of the shingles is the global order, and it is cut into fragments twice:

* *Candidates.* The order is cut into more fragments than two linked sets can differ in elements, so linked
  sets hold exactly the same elements in at least one fragment. The digest of each fragment is a bucket;
  only sets that meet in a bucket are ever compared. Sizes are dealt into bands, as the number of fragments
  depends on the size; a set near a band's lower end also enters the band below.
* *Overlaps.* A candidate pair's overlap is counted in each of ``PARTS`` fragments separately and summed.

Large groups of near copies are not expanded into pairs: equal sets are one node from the start, elements that
no other remaining set has bound a set's overlap with any other, every bucket is first compared with the
member that has the fewest such elements, and afterwards only members of different components meet.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components
from tidemark.llm.hash_map import hash_map, passing
from tidemark.llm.text_blocks import SPACED, blocks, find_words, mixed, range_hashes, sequence_hashes
from tidemark.session import free_shuffles, passing_tables, place, staged

#: Fragments in which a pair's overlap is counted.
PARTS = 4
#: Fragments beyond the necessary ones and those that are likely to be empty.
SPARE = 1
#: Most fragments of the sketch that tells unlinked sets of one bucket apart.
SKETCH = 256
#: Cuts tried before empty fragments count as agreement.
CUTS = 4

_ODD = np.uint64(0x9E3779B97F4A7C15)
_CUT_SEEDS = mixed(np.arange(1, CUTS + 1, dtype=np.uint64))


class _Bands:
    """Size bands, and the fragments each needs, for the threshold ``num / den``."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den
        n = 1
        while self.differing(n, n * den // num) == 0:
            n += 1
        edges = [n]  # smaller sets are linked with equal sets only
        while edges[-1] < 1 << 40:
            edges.append(edges[-1] * 3 // 2 + 1)
        self.edges = np.array(edges)

    def differing(self, x: int, y: int) -> int:
        """The most elements in which linked sets of these sizes differ."""
        return (self.den - self.num) * (x + y) // (self.den + self.num)

    def of(self, n: int) -> list[int]:
        """Bands of a set of ``n`` elements: its own and that of its smallest partner."""
        own, low = (int(np.searchsorted(self.edges, x, side="right")) - 1 for x in (n, -(-self.num * n // self.den)))
        return [b for b in dict.fromkeys((own, low)) if b >= 0]

    def most(self, band: int) -> int:
        """The most elements in which linked sets differ whose smaller one is in the band."""
        x = int(self.edges[band + 1]) - 1
        return self.differing(x, x * self.den // self.num)

    def fragments(self, band: int) -> int:
        """So many that most sets of the band fill more of them than linked sets can differ in."""
        least, needed = int(self.edges[band]), self.most(band) + 1
        k = needed + SPARE
        while k - (empty := k * math.exp(-least / k)) - 2 * math.sqrt(empty) < needed and k < 2 * needed + SPARE:
            k += max(1, k // 50)
        return k

    @lru_cache(maxsize=256)
    def plan(self, band: int) -> tuple[int, int]:
        """``most`` and ``fragments``."""
        return self.most(band), self.fragments(band)


@lru_cache(maxsize=64)
def _bands(num: int, den: int) -> _Bands:
    return _Bands(num, den)


@lru_cache(maxsize=512)
def _cut_points(k: int) -> np.ndarray:
    return np.array([(i << 63) // k for i in range(k + 1)], dtype=np.uint64)


def _buckets(elements: np.ndarray, bands: _Bands) -> list[tuple[np.ndarray, int]]:
    """For each band of a sorted set of 63-bit elements its bucket numbers, those of the first cut first, and their count."""
    found = []
    for band in bands.of(len(elements)):
        digests = []
        differing, k = bands.plan(band)
        for cut in range(CUTS):
            order = elements if cut == 0 else np.sort(mixed(elements ^ _CUT_SEEDS[cut]) >> np.uint64(1))
            at = np.searchsorted(order, _cut_points(k))
            sums = np.zeros(len(order) + 1, dtype=np.uint64)
            np.cumsum(mixed(order), out=sums[1:])
            full = at[1:] > at[:-1]
            place = np.arange(k, dtype=np.uint64) + np.uint64((((band << 4) + cut) << 40) + 1)
            digest = mixed(mixed(place) + sums[at[1:]] - sums[at[:-1]])
            sure = k - differing - int((~full).sum()) >= 1
            digests.append(digest[full] if sure or cut < CUTS - 1 else digest)
            if sure:
                break
        found.append((np.concatenate(digests), int(np.count_nonzero(full)) if cut == 0 else len(digests[0])))
    return found


def _promising(elements: np.ndarray, bands: _Bands, bits: np.ndarray) -> np.ndarray:
    """The buckets of a set that the map does not rule out, if they are enough for a link.

    A linked set shares all of this set's full fragments but as many as the two may differ in elements: with a partner
    that meets it in its own band as for the largest partner, in the band below as for one of its own size.
    """
    n, kept = len(elements), []
    for (digests, first), partner in zip(_buckets(elements, bands), (n * bands.den // bands.num, n), strict=False):
        shared = passing(bits, digests)
        if np.count_nonzero(shared[:first]) >= first - bands.differing(n, partner):
            kept.append(digests[shared])
    return np.unique(np.concatenate(kept)) if kept else np.zeros(0, dtype=np.uint64)


def _text_sets(column: pa.Array, words: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sorted shingle sets of the texts, as 63-bit hashes, block by block with the first row of the block."""
    for block in blocks(column):
        block = block.lowered()
        found = find_words(block, SPACED)
        hashes = range_hashes(block.data, found.starts, found.ends)
        shingles = sequence_hashes(hashes, words)
        sets = []
        for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True):
            if b - a >= words:
                sets.append(np.unique(shingles[a : b - words + 1] >> np.uint64(1)))
            elif b > a:
                sets.append(sequence_hashes(hashes[a:b], b - a) >> np.uint64(1))
            else:
                sets.append(np.zeros(0, dtype=np.uint64))
        yield block.first, sets


def _set_key(elements: np.ndarray) -> int:
    total = mixed(elements + _ODD).sum(dtype=np.uint64) + np.uint64(len(elements))
    return int(mixed(np.array([total], dtype=np.uint64)).view(np.int64)[0])


def _long_lists(lists: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    values = np.concatenate([*lists, np.zeros(0, dtype=np.uint64)])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def _bucket_pass(words: int, num: int, den: int):
    def run(batches):
        bands = _bands(num, den)
        for batch in batches:
            for _, sets in _text_sets(batch.column(0), words):
                flat = np.concatenate([np.zeros(0, np.uint64), *(digests for x in sets for digests, _ in _buckets(x, bands))])
                yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], ["bucket"])

    return run


def _node_pass(words: int, num: int, den: int, shared_map):
    """``(id, text)`` -> ``(id, node, n, buckets)`` with the buckets in which a link may be found."""

    def run(batches):
        bands, bits = _bands(num, den), shared_map.value
        for batch in batches:
            for first, sets in _text_sets(batch.column(1), words):
                found = [_promising(x, bands, bits) for x in sets]
                nodes, sizes = pa.array([_set_key(x) for x in sets], pa.int64()), pa.array([len(x) for x in sets], pa.int64())
                ids = batch.column(0).slice(first, len(sets))
                yield pa.RecordBatch.from_arrays([ids, nodes, sizes, _long_lists(found)], ["id", "node", "n", "buckets"])

    return run


def _sketch(elements: np.ndarray, bands: _Bands, band: int) -> np.ndarray:
    """Digests of more, smaller fragments: linked sets agree in all but as many as they may differ in elements."""
    k = min(4 * (bands.most(band) + 1), SKETCH)
    at = np.searchsorted(elements, _cut_points(k))
    sums = np.zeros(len(elements) + 1, dtype=np.uint64)
    np.cumsum(mixed(elements), out=sums[1:])
    return (sums[at[1:]] - sums[at[:-1]]).astype(np.uint8).view(np.int8)


def _element_pass(words: int, chosen_map):
    """``(id, text)`` -> ``(node, elements)`` of the rows that the map of id and node lets through."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).fill_null(0).to_numpy()
            for first, sets in _text_sets(batch.column(1), words):
                keys = np.array([_set_key(x) for x in sets], dtype=np.int64)
                taken = np.flatnonzero(passing(chosen_map.value, (keys ^ ids[first : first + len(sets)]).view(np.uint64)))
                yield pa.RecordBatch.from_arrays([pa.array(keys[taken]), _long_lists([sets[i] for i in taken])], ["node", "elements"])

    return run


def _elements_of(column: pa.ListArray) -> Iterator[np.ndarray]:
    values, at = column.values.to_numpy().view(np.uint64), column.offsets.to_numpy()
    return (values[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


def _alone_pass(common_map, num: int, den: int):
    """``(node, elements)`` -> the rows that can link, with the number of elements that no other candidate has."""

    def run(batches):
        for batch in batches:
            alone = np.array([len(x) - int(passing(common_map.value, x).sum()) for x in _elements_of(batch.column(1))], dtype=np.int64)
            n = np.diff(batch.column(1).offsets.to_numpy()).astype(np.int64)
            kept = pa.array(den * (n - alone) >= num * n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n), pa.array(alone)], ["node", "elements", "n", "alone"]).filter(kept)

    return run


def _sketch_pass(num: int, den: int):
    """``(node, elements)`` -> ``(node, band, own, low)``: sketches for the set's bands; ``low`` is null without a lower band."""

    def run(batches):
        bands = _bands(num, den)
        for batch in batches:
            sets = list(_elements_of(batch.column(1)))
            of = [bands.of(len(x)) or [0] for x in sets]
            own = [_sketch(x, bands, b[0]) for x, b in zip(sets, of, strict=True)]
            low = [_sketch(x, bands, b[1]) if len(b) > 1 else None for x, b in zip(sets, of, strict=True)]
            columns = [pa.array([b[0] for b in of], pa.int32()), pa.array(own, pa.list_(pa.int8())), pa.array(low, pa.list_(pa.int8()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["node", "band", "own", "low"])

    return run


def _can_link(a: str, b: str, num: int, den: int) -> str:
    """Whether sets of these sizes can still reach the threshold with the elements they do not have alone."""
    return f"{num + den} * least({a}.n - {a}.alone, {b}.n - {b}.alone) >= {num} * ({a}.n + {b}.n)"


def _sketches_agree(a: str, b: str, num: int, den: int) -> str:
    """Whether the sketches of two sets, for the band of the smaller one, agree as they must if the sets link."""
    band = f"if({a}.n <= {b}.n, {a}.band, {b}.band)"
    of = "if({0}.band = {1}, {0}.own, {0}.low)"
    agree = f"size(filter(zip_with({of.format(a, band)}, {of.format(b, band)}, (p, q) -> p = q), same -> same))"
    return f"{agree} >= size({of.format(a, band)}) - ({den - num} * ({a}.n + {b}.n)) div {den + num}"


def _verified(pairs: DataFrame, parts: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b, na, nb)`` that reach the threshold: partial overlaps by fragment, summed by pair."""
    left = pairs.join(parts.select(F.col("node").alias("a"), "part", F.col("segment").alias("sa")), "a")
    both = left.join(parts.select(F.col("node").alias("b"), "part", F.col("segment").alias("sb")), ["b", "part"])
    overlaps = both.select("a", "b", "na", "nb", F.size(F.array_intersect("sa", "sb")).alias("overlap"))
    summed = overlaps.groupBy("a", "b", "na", "nb").agg(F.sum("overlap").alias("overlap"))
    return summed.where(f"{den} * overlap >= {num} * (na + nb - overlap)").select("a", "b")


def _links(pairs: DataFrame, parts: DataFrame, num: int, den: int, at: str) -> DataFrame:
    """The pairs that reach the threshold, written to ``at``; the buckets they come from are gone before their elements are dealt."""
    spark = pairs.sparkSession
    with passing_tables(spark):
        pairs = staged(pairs)
        free_shuffles(spark)
        return staged(_verified(pairs, parts, num, den), at)


def _roots(docs: DataFrame, nodes: DataFrame, words: int, num: int, den: int) -> DataFrame:
    """``(node, root)`` of the sets that are linked with another one; ``nodes`` say in which buckets links may be found."""
    spark = docs.sparkSession
    members_at, elements_at, parts_at, links_at, late_at = (place(spark) for _ in range(5))
    with passing_tables(spark):
        classes = nodes.where("size(buckets) > 0").groupBy("node").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.first("buckets").alias("buckets"))
        members = staged(classes.select("node", "rep", "n", F.explode("buckets").alias("bucket")))
        met = members.groupBy("bucket").count().where("count > 1").select("bucket")
        members = staged(members.join(met, "bucket"))
        free_shuffles(spark)

        # The elements of the sets that meet another one, and how many of them no other such set has. A row may stand for
        # its set twice if its id does; that only makes elements look less alone.
        chosen = members.select(F.expr("node ^ coalesce(rep, 0)").alias("h")).distinct()
        chosen_map = spark.sparkContext.broadcast(hash_map(chosen, "h"))
        elements = staged(docs.mapInArrow(_element_pass(words, chosen_map), "node long, elements array<long>"))
        chosen_map.unpersist()
        common = elements.select(F.explode("elements").alias("e")).groupBy("e").count().where("count > 1")
        common_map = spark.sparkContext.broadcast(hash_map(common, "e"))
        free_shuffles(spark)
        elements = staged(elements.mapInArrow(_alone_pass(common_map, num, den), "node long, elements array<long>, n long, alone long"), elements_at)
        common_map.unpersist()
        alone = elements.select("node", "n", "alone").distinct()
        part = F.expr(f"transform(sequence(0, {PARTS - 1}), p -> struct(p as part, filter(elements, e -> shiftrightunsigned(e, 61) = p) as segment))")
        parts = staged(elements.select("node", F.inline(part)).dropDuplicates(["node", "part"]), parts_at)
        free_shuffles(spark)
        members = staged(members.select("bucket", "node").join(alone, "node"), members_at)

    # Every bucket against its member with the fewest elements of its own.
    heads = members.groupBy("bucket").agg(F.min(F.struct("alone", "node", "n")).alias("h")).select("bucket", "h.*")
    stars = members.alias("x").join(heads.alias("h"), F.expr(f"x.bucket = h.bucket and x.node <> h.node and {_can_link('x', 'h', num, den)}"))
    pair = "least(x.node, {0}.node) as a", "greatest(x.node, {0}.node) as b", "if(x.node < {0}.node, x.n, {0}.n) as na", "if(x.node < {0}.node, {0}.n, x.n) as nb"
    links = _links(stars.selectExpr(*(c.format("h") for c in pair)).distinct(), parts, num, den, links_at)
    roots = staged(components(links))

    # Members of different components that still share a bucket.
    told = members.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed_buckets = told.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1"), F.min("n").alias("least_n")).where("r0 <> r1")
    open_members = told.join(mixed_buckets, "bucket").where(f"{num + den} * (n - alone) >= {num} * (n + least_n)")
    open_members = staged(open_members.select("bucket", "node", "n", "alone", "root"))
    free_shuffles(spark)
    sketched = elements.select("node", "elements").join(open_members.select("node").distinct(), "node", "left_semi")
    sketched = sketched.mapInArrow(_sketch_pass(num, den), "node long, band int, own array<byte>, low array<byte>").dropDuplicates(["node"])
    open_members = open_members.join(sketched, "node")
    x, y = open_members.alias("x"), open_members.alias("y")
    late = x.join(y, F.expr(f"x.bucket = y.bucket and x.node < y.node and x.root <> y.root and {_can_link('x', 'y', num, den)} and {_sketches_agree('x', 'y', num, den)}"))
    late = _links(late.selectExpr(*(c.format("y") for c in pair)).distinct(), parts, num, den, late_at)
    return components(links.union(late))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """``(id, n, component, node, root)`` of every row: its set's size, and the smallest id linked with it.

    A set holds the distinct ``words``-word shingles of the text with A-Z lower-cased, or the whole sequence of a
    shorter text; two texts link when ``den * intersection >= num * union``. A null or wordless text has an
    empty set and links with nothing; its component is its own id. Equal sets are linked; rows with null ids are
    linked as others are, and a component of null ids only has a null number. Repeated ids are rows of their own.
    Columns other than the two named are not read. ``node`` is a digest of the set, ``root`` the smallest node of its
    component.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    shared = docs.select("text").mapInArrow(_bucket_pass(words, num, den), "bucket long").groupBy("bucket").count().where("count > 1")
    shared_map = spark.sparkContext.broadcast(hash_map(shared, "bucket"))
    nodes = staged(docs.mapInArrow(_node_pass(words, num, den, shared_map), "id long, node long, n long, buckets array<long>"))
    shared_map.unpersist()
    free_shuffles(spark)

    # What leads from the sets to the roots of their components is as large as the sets and read by nothing later.
    at = place(spark)
    with passing_tables(spark):
        roots = staged(_roots(docs, nodes, words, num, den), at)

    labelled = nodes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node")).select("id", "n", "node", "root")
    smallest = labelled.where("n > 0").groupBy("root").agg(F.min("id").alias("component"))
    linked = labelled.where("n > 0").join(smallest, "root")
    return linked.unionByName(labelled.where("n = 0").withColumn("component", F.col("id"))).select("id", "n", "component", "node", "root")


def _split_pass(words: int, special_map, inside: bool, text_at: int):
    """``(doc, id)`` -> ``(doc, k, node)`` of the rows that the map of special rows lets through, or of the others."""

    def run(batches):
        for batch in batches:
            ids, known = batch.column(1).fill_null(0).to_numpy(), batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            for first, sets in _text_sets(batch.column(0).field(text_at), words):
                keys = np.array([_set_key(x) for x in sets], dtype=np.int64)
                at = slice(first, first + len(sets))
                k = np.where(known[at], ids[at], keys)
                special = passing(special_map.value, (keys ^ k).view(np.uint64)) & np.array([len(x) > 0 for x in sets], dtype=bool)
                rows = pa.RecordBatch.from_arrays([batch.column(0).slice(first, len(sets)), pa.array(k), pa.array(keys)], ["doc", "k", "node"])
                yield rows.filter(pa.array(special == inside))

    return run


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, **threshold) -> DataFrame:
    """The rows of ``docs`` less all but one of each group of linked texts.

    Of a group the row of the smallest id stays, a null id only if there is no other; of several texts of that id in
    the group one stays, of equal rows one. Texts without words are linked with nothing and all stay. Only rows that
    go or occur twice, and few others that a map of fixed size can not tell from them, are shuffled.
    """
    at = place(docs.sparkSession)
    with passing_tables(docs.sparkSession):
        found = jaccard_components(docs, id_col, text_col, words, **threshold).where("n > 0")
        found = staged(found.select(F.coalesce("id", "node").alias("k"), F.col("id").isNull().alias("none"), "node", "root"), at)
    first = found.groupBy("root").agg(F.min(F.struct("none", "k", "node")).alias("f"))
    each = found.groupBy("k", "node", "root").agg(F.count("*").alias("c")).join(first, "root")
    each = each.select("k", "node", "c", (~F.col("f.k").eqNullSafe(F.col("k")) | (F.col("f.node") != F.col("node"))).alias("goes"))
    special = staged(each.where("goes OR c > 1").select("k", "node", "goes"))
    special_map = docs.sparkSession.sparkContext.broadcast(hash_map(special, F.expr("node ^ k")))

    rows = docs.select(F.struct("*").alias("doc"), F.col(id_col).cast("long").alias("id"))
    text_at = [c.lower() for c in docs.columns].index(text_col.lower())
    schema = rows.select("doc").schema.add("k", "long").add("node", "long")
    others = rows.mapInArrow(_split_pass(words, special_map, False, text_at), schema).select("doc.*")
    told = rows.mapInArrow(_split_pass(words, special_map, True, text_at), schema).join(special, ["k", "node"], "left")
    # rows that are not special only look so, and each of them stays; one pass tells both kinds
    kept = told.where("goes IS NULL OR NOT goes").withColumn("each", F.when(F.col("goes").isNull(), F.monotonically_increasing_id()))
    return others.union(kept.dropDuplicates(["k", "node", "each"]).select("doc.*"))
