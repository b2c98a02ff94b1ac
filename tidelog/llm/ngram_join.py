"""N-gram Jaccard join (operator 6): prefix filters under several global token orders.

Documents are sets of word shingles; two documents link when the Jaccard
similarity of their sets reaches a threshold (an exact fraction).  The result is
each document's connected component.

1. Texts with equal word sequences form one class; only classes are joined.
2. All shingles of all classes are counted (per task first, then per slice of
   the hash space), which gives two bit maps of fixed size: shingles that several
   classes hold, and frequent ones.  A map may have further bits set: the first
   then filters less, and the second changes the orders, never the result.
3. A class of which fewer shingles are shared than the threshold asks for links
   with nothing.  The others are indexed by the shared shingles of their prefix
   under the first order (rare shingles by hash, then frequent ones by hash): sets
   that reach the threshold share one.  Classes that share one meet in its bucket,
   where the sizes and parity sketches of the sets bound their similarity from above.
4. First, every bucket proposes a spanning forest of its likeliest pairs (linear
   in the bucket).  Verified pairs are joined to components.  Then every bucket
   proposes all pairs that the bounds leave between members of different
   components: no link between components is lost, and pairs inside a component
   need no check.
5. A proposed pair must share prefix shingles under each of the other orders too;
   what passes all filters is verified on the whole sets.  Pairs are verified in
   blocks of classes that many pairs have in common, so a set is sent once a block,
   from a store dealt by class: both rounds look sets up there without a shuffle of all.

Defined cases: null text reads as empty; a text with fewer words than a shingle
has one shingle, the whole sequence; a text without words has none and is linked
with nothing (its component is its own id); repeated rows are in one component;
a null id has a null component; an empty table gives an empty one; other input
columns are ignored.  Shingles and classes are compared by 64-bit hashes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidelog.llm.common import byte_chunks, stored, stored_by, stored_for, whole_text
from tidelog.llm.components import components
from tidelog.llm.texthash import U, mix, sequence_hash, shingle_sets, spaced_words, word_hashes

FREQUENT = 32  # classes that hold a shingle, from which it counts as frequent
FREQUENT_BITS = 23
SHARED_BITS = range(20, 31)  # the map of shared shingles has a bit for every SHARED_BYTES of text
SHARED_BYTES = 8
SKETCH_BITS = 512
ORDERS = (U(0), U(0xA24BAED4963EE407), U(0x9FB21C651E98DF25))
NEVER = 65535
BLOCK = 256  # classes compared with one another at a time when a forest is proposed
SENT = 1024  # classes of a block whose sets are sent to a task together
CHECKED = 1 << 15  # pairs of two blocks that are checked together
INDEXED = 1024  # texts whose sets leave a task in one batch
FOLD = spaced_words()


# --- sets of a block of texts --------------------------------------------------------

def texts_of(batches, size: int):
    """(index in batch, batch, class key, set) of every text, a few at a time."""
    for batch in batches:
        for first, chunk in byte_chunks(batch.column("t")):
            words, offsets = word_hashes(chunk, FOLD)
            keys = sequence_hash(words, offsets).astype(np.int64)
            for i, found in enumerate(shingle_sets(words, offsets, size)):
                yield batch, first + i, int(keys[i]), found


def bits_of(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> U(64 - bits)).astype(np.int64)


def is_set(packed: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return (packed[positions >> 3] >> (7 - (positions & 7)).astype(np.uint8)) & 1


def ordered(found: np.ndarray, order: int, frequent: np.ndarray) -> np.ndarray:
    """A set's shingles in a global order: rare ones by hash, then frequent ones by hash."""
    place = (found if order == 0 else mix(found ^ ORDERS[order])) >> U(1)
    late = is_set(frequent, bits_of(found, FREQUENT_BITS)).astype(np.uint64) << U(63)
    return found[np.argsort(place | late, kind="stable")]


def prefix_length(n: int, num: int, den: int) -> int:
    return n - -(-num * n // den) + 1


def sketch(found: np.ndarray) -> bytes:
    """Parity of the number of shingles at each of SKETCH_BITS places: two sketches
    differ in no more places than the sets differ in shingles."""
    places = (mix(found ^ U(0x5851F42D4C957F2D)) >> U(40)).astype(np.int64) % SKETCH_BITS
    return np.packbits((np.bincount(places, minlength=SKETCH_BITS) & 1).astype(np.uint8)).tobytes()


# --- frequent shingles -------------------------------------------------------------------

def added_up(prints: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(prints, kind="stable")
    prints, counts = prints[order], counts[order]
    starts = np.flatnonzero(np.append(True, prints[1:] != prints[:-1])) if len(prints) else np.empty(0, int)
    return prints[starts], (np.add.reduceat(counts, starts) if len(starts) else counts)


def planes(values: np.ndarray) -> bytes:
    """Small 32-bit numbers with their high bytes together, which compress well."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").reshape(-1)


def shared_bits(rows: DataFrame) -> int:
    total = rows.agg(F.sum(F.octet_length("t")).alias("n")).first()["n"] or 0
    return min(max(int(total // SHARED_BYTES).bit_length(), SHARED_BITS[0]), SHARED_BITS[-1])


def shingle_maps(rows: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """(bit map of shared shingles, of frequent ones, bits of a place in the first),
    from counts over all classes."""
    spark = rows.sparkSession
    bits = shared_bits(rows)
    # slices of the hash space, a power of two; each makes its stretch of both maps
    slice_bits = min(16, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length() + 1)

    def count(batches):
        seen: set[int] = set()
        parts, held = [], 0
        total = np.empty(0, np.uint32), np.empty(0, np.int64)
        for _, _, key, found in texts_of(batches, size):
            if key in seen or not len(found):
                continue
            seen.add(key)
            parts.append((found >> U(32)).astype(np.uint32))
            held += len(found)
            if held > 1 << 22:
                total = joined(total, parts)
                parts, held = [], 0
        prints, counts = joined(total, parts)
        cuts = np.searchsorted(prints >> np.uint32(32 - slice_bits), np.arange((1 << slice_bits) + 1))
        full = np.flatnonzero(np.diff(cuts))
        for some in np.array_split(full, max(1, len(prints) >> 20)):
            yield pa.RecordBatch.from_arrays(
                [pa.array(some, pa.int32()),
                 pa.array([planes(np.diff(prints[cuts[s] : cuts[s + 1]], prepend=0)) for s in some], pa.binary()),
                 pa.array([planes(counts[cuts[s] : cuts[s + 1]]) for s in some], pa.binary())],
                ["slice", "steps", "counts"])

    def joined(total, parts):
        if not parts:
            return total
        new = np.concatenate(parts)
        return added_up(np.concatenate([total[0], new]), np.concatenate([total[1], np.ones(len(new), np.int64)]))

    def merge(group: pa.Table) -> pa.Table:
        prints = [np.cumsum(from_planes(v.as_py()), dtype=np.uint32) for v in group.column("steps")]
        counts = [from_planes(v.as_py()).astype(np.int64) for v in group.column("counts")]
        prints, counts = added_up(np.concatenate(prints), np.concatenate(counts))

        def stretch(keep, map_bits):
            flags = np.zeros(1 << (map_bits - slice_bits), bool)
            flags[(prints[keep] >> np.uint32(32 - map_bits)) & np.uint32(len(flags) - 1)] = True
            return np.packbits(flags).tobytes()

        return pa.table({"slice": pa.array([group.column("slice")[0].as_py()], pa.int32()),
                         "shared": pa.array([stretch(counts > 1, bits)], pa.binary()),
                         "frequent": pa.array([stretch(counts >= FREQUENT, FREQUENT_BITS)], pa.binary())})

    parts = rows.select("t").mapInArrow(count, "slice int, steps binary, counts binary")
    # at most 2 ** (bits - 3) bytes in all, whatever the input
    found = parts.groupBy("slice").applyInArrow(merge, "slice int, shared binary, frequent binary").toPandas()
    shared, frequent = np.zeros(1 << (bits - 3), np.uint8), np.zeros(1 << (FREQUENT_BITS - 3), np.uint8)
    for s, one, other in zip(found["slice"], found["shared"], found["frequent"]):
        for whole, part in ((shared, one), (frequent, other)):
            n = len(whole) >> slice_bits
            whole[s * n : (s + 1) * n] = np.frombuffer(part, np.uint8)
    return shared, frequent, bits


# --- index -----------------------------------------------------------------------------------

def indexed(rows: DataFrame, size: int, num: int, den: int, maps) -> DataFrame:
    """Per text: id, class key, set size and, at the first text of its class in a task
    if the class may link, the set, its sketch and the shared shingles of its prefix
    under the first order (32 bits of each)."""
    own = rows.sparkSession.sparkContext.broadcast(maps)

    def index(batches):
        seen: set[int] = set()
        shared, frequent, bits = own.value
        for batch in (b.slice(start, INDEXED) for b in batches for start in range(0, b.num_rows, INDEXED)):
            n_rows = batch.num_rows
            keys, sizes = np.zeros(n_rows, np.int64), np.zeros(n_rows, np.int64)
            prefixes, sketches, sets = [None] * n_rows, [None] * n_rows, [None] * n_rows
            for _, i, key, found in texts_of([batch], size):
                keys[i], sizes[i] = key, len(found)
                if not len(found) or key in seen:
                    continue
                seen.add(key)
                if den * int(is_set(shared, bits_of(found, bits)).sum()) < num * len(found):
                    continue
                first = ordered(found, 0, frequent)[: prefix_length(len(found), num, den)]
                first = first[is_set(shared, bits_of(first, bits)).astype(bool)]
                prefixes[i] = (first & U(0xFFFFFFFF)).astype(np.uint32).view(np.int32)
                sketches[i], sets[i] = sketch(found), found.view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(keys), pa.array(sizes), pa.array(prefixes, pa.list_(pa.int32())),
                 pa.array(sketches, pa.binary()), pa.array(sets, pa.list_(pa.int64()))],
                ["id", "key", "n", "prefix", "sketch", "shingles"])

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(
        index, f"id {id_type}, key long, n long, prefix array<int>, sketch binary, shingles array<long>")


def differ(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Places at which each sketch of a differs from each of b."""
    out = np.zeros((len(a), len(b)), np.uint16)
    for word in range(a.shape[1]):
        out += np.bitwise_count(a[:, word, None] ^ b[None, :, word])
    return out


def possible(n_a: np.ndarray, n_b: np.ndarray, apart: np.ndarray, num: int, den: int) -> np.ndarray:
    """May sets of these sizes, with sketches so far apart, reach the threshold?"""
    x, y = n_a[:, None], n_b[None, :]
    size_fits = den * np.minimum(x, y) >= num * np.maximum(x, y)
    # num/den <= J = (x + y - d) / (x + y + d), with d >= apart shingles in one set only
    return size_fits & ((num + den) * apart.astype(np.int64) <= (den - num) * (x + y))


def forest(keys: np.ndarray, n: np.ndarray, words: np.ndarray, num: int, den: int):
    """Pairs of a least spanning forest of the possible pairs (by how far their sketches
    are apart), within overlapping blocks in order of size."""
    order = np.lexsort((keys, n))
    keys, n, words = keys[order], n[order], words[order]
    for start in range(0, max(1, len(keys) - BLOCK // 2), BLOCK // 2):
        k, m, w = keys[start : start + BLOCK], n[start : start + BLOCK], words[start : start + BLOCK]
        apart = differ(w, w)
        apart[~possible(m, m, apart, num, den)] = NEVER
        open_ = np.ones(len(k), bool)  # not in the forest yet
        nearest, behind = np.full(len(k), NEVER, np.uint16), np.zeros(len(k), np.int64)
        at = 0
        for _ in range(len(k) - 1):
            open_[at] = False
            nearer = open_ & (apart[at] < nearest)
            nearest[nearer], behind[nearer] = apart[at][nearer], at
            at = int(np.where(open_, nearest, NEVER).argmin())
            if nearest[at] < NEVER and open_[at]:
                yield int(k[at]), int(k[behind[at]])
            else:  # the next tree
                at = int(open_.argmax())


def across(keys: np.ndarray, n: np.ndarray, words: np.ndarray, part: np.ndarray, num: int, den: int):
    """All possible pairs between members of different components."""
    order = np.lexsort((keys, n))
    keys, n, words, part = keys[order], n[order], words[order], part[order]
    names, index, counts = np.unique(part, return_inverse=True, return_counts=True)
    largest = counts.argmax()
    ends = np.searchsorted(n * num, n * den, "right")  # sizes up to n * den / num
    starts = np.searchsorted(n * den, n * num, "left")
    for i in np.flatnonzero(index != largest):
        a, b = starts[i], ends[i]
        apart = differ(words[i : i + 1], words[a:b])
        fits = possible(n[i : i + 1], n[a:b], apart, num, den)[0] & (index[a:b] != index[i])
        for j in np.flatnonzero(fits) + a:
            if index[j] == largest or i < j:
                yield int(keys[i]), int(keys[j])


def member_lists(postings: DataFrame) -> DataFrame:
    """(token, key) of the shingles that several classes hold in their prefixes, with one
    bucket for all shingles of the same members: near copies share most of their
    prefixes, and a list of members proposes the same pairs each time.  The bucket is named by a
    hash of its members; were two lists to get one name, they would propose together."""
    token = Window.partitionBy("token")
    in_order = token.orderBy("key")
    member = F.xxhash64("key")
    once = postings.withColumn("before", F.lag("key").over(in_order)).filter("before IS NULL OR before <> key")
    several = (once.withColumn("lo", F.min("key").over(token)).withColumn("hi", F.max("key").over(token))
               .withColumn("n", F.count("*").over(token)).withColumn("mix", F.bit_xor(member).over(token))
               .filter("lo <> hi"))
    return several.select(F.xxhash64("n", "lo", "hi", "mix").alias("token"), "key").distinct()


def buckets(batches, name: str):
    """Arrays of the rows of each value of a sorted column, across batches."""
    held = None
    for batch in batches:
        table = batch if held is None else pa.Table.from_batches([held, batch]).combine_chunks().to_batches()[0]
        value = table.column(name).to_numpy()
        if not len(value):
            continue
        cuts = np.flatnonzero(value[1:] != value[:-1]) + 1
        last = int(cuts[-1]) if len(cuts) else 0
        for a, b in zip([0, *cuts[:-1]], cuts):
            yield table.slice(int(a), int(b - a))
        held = table.slice(last)
    if held is not None and held.num_rows:
        yield held


def proposals(shared: DataFrame, attributes: DataFrame, num: int, den: int, parts: DataFrame | None) -> DataFrame:
    """Distinct pairs (a < b) of class keys that the buckets propose: forests, or with
    components given all pairs across them."""
    members = shared.join(attributes, "key")
    if parts is not None:
        members = members.join(parts, F.col("key") == F.col("node"), "left").drop("node")
        members = members.withColumn("part", F.coalesce("component", "key")).drop("component")
        several = Window.partitionBy("token")
        members = (members.withColumn("lo", F.min("part").over(several)).withColumn("hi", F.max("part").over(several))
                   .filter("lo <> hi").drop("lo", "hi"))
    columns = ["token", "key", "n", "sketch"] + ["part"] * (parts is not None)
    rows = members.select(*columns)
    if parts is None:
        rows = rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), "token")
    rows = rows.sortWithinPartitions("token")
    given = parts is not None

    def propose(batches):
        found: set[tuple[int, int]] = set()
        done: set[int] = set()  # buckets with the same members propose the same
        for bucket in buckets(batches, "token"):
            keys, first = np.unique(bucket.column("key").to_numpy(), return_index=True)
            mark = hash(keys.tobytes())
            if len(keys) < 2 or mark in done:
                continue
            done.add(mark)
            n = bucket.column("n").to_numpy()[first]
            words = np.frombuffer(b"".join(v.as_py() for v in bucket.column("sketch").take(pa.array(first))),
                                  np.uint64).reshape(len(keys), -1)
            pairs = (across(keys, n, words, bucket.column("part").to_numpy()[first], num, den) if given
                     else forest(keys, n, words, num, den))
            for a, b in pairs:
                found.add((a, b) if a < b else (b, a))
            if len(found) > 1 << 16:
                yield pair_batch(found)
                found.clear()
        if found:
            yield pair_batch(found)

    return rows.mapInArrow(propose, "a long, b long").distinct()


def pair_batch(pairs) -> pa.RecordBatch:
    a, b = zip(*pairs)
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


# --- verification -----------------------------------------------------------------------------

def member(found: np.ndarray, num: int, den: int, frequent: np.ndarray) -> list[np.ndarray]:
    """A set as the filters see it: its prefix under each further order, then the whole
    set, each sorted."""
    n = prefix_length(len(found), num, den)
    return [np.sort(ordered(found, order, frequent)[:n]) for order in range(1, len(ORDERS))] + [found]


def in_common(x: np.ndarray, ys: list[np.ndarray]) -> np.ndarray:
    """Size of the intersection of a sorted set with each of others (none is empty)."""
    every = np.concatenate(ys)
    hit = x[np.minimum(np.searchsorted(x, every), len(x) - 1)] == every
    return np.add.reduceat(hit, np.cumsum([0] + [len(y) for y in ys[:-1]]), dtype=np.int64)


def linked(x: list[np.ndarray], ys: list[list[np.ndarray]], num: int, den: int) -> np.ndarray:
    """Which of several sets pass the prefix filters of all orders with a set, and reach
    the threshold with it?"""
    left = np.arange(len(ys))
    for order in range(len(ORDERS) - 1):
        left = left[in_common(x[order], [ys[i][order] for i in left]) > 0]
        if not len(left):
            return left
    both = in_common(x[-1], [ys[i][-1] for i in left])
    either = len(x[-1]) + np.array([len(ys[i][-1]) for i in left]) - both
    return left[den * both >= num * either]


def verified(pairs: DataFrame, sets: DataFrame, num: int, den: int, frequent: np.ndarray) -> DataFrame:
    """The pairs (a, b) that link, from the sets (key, ``shingles``;
    one row a key, dealt by key).

    Classes that pairs connect are dealt to blocks of about SENT; the pairs of two
    blocks are one group, or several of about CHECKED pairs, to which each set that
    they need is sent once.  A task orders a set once and holds it against all its
    partners in one array.
    """
    spark = pairs.sparkSession
    parts = components(pairs, native=False)
    blocks = parts.groupBy("component").agg(F.ceil(F.count("*") / SENT).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = stored(parts.join(blocks, "component").select("node", "component", block.alias("block")), "jaccard-blocks")
    left = dealt.select(F.col("node").alias("a"), "component", F.col("block").alias("i"))
    right = dealt.select(F.col("node").alias("b"), F.col("block").alias("j"))
    both = pairs.join(left, "a").join(right, "b").select(
        F.xxhash64("component", F.least("i", "j"), F.greatest("i", "j")).alias("of"), "a", "b")
    both = stored(both, "jaccard-grouped")
    splits = both.groupBy("of").agg(F.ceil(F.count("*") / CHECKED).alias("splits"))
    split = F.pmod(F.xxhash64("a"), F.col("splits"))
    both = stored(both.join(splits, "of").select(F.xxhash64("of", split).alias("group"), "a", "b"), "jaccard-split")
    needs = both.select("group", F.col("a").alias("key")).union(both.select("group", F.col("b").alias("key"))).distinct()
    sent = needs.join(sets, "key").select("group", F.col("key").alias("a"), F.lit(None).cast("long").alias("b"),
                                          "shingles")
    rows = sent.unionByName(both.withColumn("shingles", F.lit(None).cast("array<long>")))
    rows = rows.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "group")
    rows = rows.sortWithinPartitions("group", F.col("b").isNotNull(), "a")
    bits = spark.sparkContext.broadcast(frequent)

    def check(batches):
        group, held, a, partners = None, {}, None, []

        def good():
            if partners:
                found = linked(held[a], [held[b] for b in partners], num, den)
                yield from ((a, partners[i]) for i in found)

        for batch in batches:
            links = []
            for g, key, b, found in zip(batch.column("group").to_pylist(), batch.column("a").to_pylist(),
                                        batch.column("b").to_pylist(), batch.column("shingles")):
                if (g, key) != (group, a) or b is None:
                    links += good()
                    partners = []
                if g != group:
                    group, held = g, {}
                a = key
                if b is None:
                    held[a] = member(found.values.to_numpy().view(np.uint64), num, den, bits.value)
                else:
                    partners.append(b)
            if links:
                yield pair_batch(links)
        links = list(good())
        if links:
            yield pair_batch(links)

    return rows.mapInArrow(check, "a long, b long")


# --- components ----------------------------------------------------------------------------------

def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 5,
                     threshold: tuple[int, int] = (4, 5)) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles`` (size of its set of shingles of ``size``
    words) and ``component_id`` (smallest id reachable by links of at least the
    threshold, a fraction)."""
    num, den = threshold
    rows = docs.select(F.col(id_col).alias("id"), F.encode(whole_text(text_col), "UTF-8").alias("t"))
    maps = shingle_maps(rows, size)
    with stored_for(indexed(rows, size, num, den, maps), "jaccard-index") as index:
        texts = stored(index.select("id", "key", "n"), "jaccard-texts")
        may_link = index.filter("sketch IS NOT NULL")
        attributes = stored(may_link.dropDuplicates(["key"]).select("key", "n", "sketch"), "jaccard-attributes")
        shared = member_lists(may_link.select("key", F.explode("prefix").alias("token")))
        shared = stored(shared, "jaccard-shared")
        sets = stored_by(may_link.select("key", "shingles"), "key", "jaccard_sets")

    first = stored(proposals(shared, attributes, num, den, None), "jaccard-pairs")
    links = stored(verified(first, sets, num, den, maps[1]), "jaccard-links")
    parts = stored(components(links, native=False), "jaccard-parts")
    second = stored(proposals(shared, attributes, num, den, parts), "jaccard-pairs")
    more = verified(second, sets, num, den, maps[1])
    stars = parts.select(F.col("node").alias("a"), F.col("component").alias("b"))
    parts = stored(components(stars.union(more), native=False), "jaccard-parts")

    classes = texts.groupBy("key").agg(F.min("id").alias("id"))
    named = classes.join(parts, F.col("key") == F.col("node"), "left").select(
        "key", "id", F.coalesce("component", "key").alias("part"))
    least = named.groupBy("part").agg(F.min("id").alias("component_id"))
    named = named.join(least, "part").select("key", "component_id")
    component = F.when(F.col("n") == 0, F.col("id")).when(F.col("id").isNotNull(), F.col("component_id"))
    return texts.join(named, "key", "left").select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"))
