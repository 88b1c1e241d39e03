"""Jaccard join of documents by word n-grams.

A document's set holds the hashes of its distinct word n-grams; documents of equal
sets are one class from the start and go by one representative. A join of all
classes by tiles would meet all pairs, so tiles are cut by size and by content:

1. Sizes fall into bands, each as wide as a link allows: linked sets lie in one
   band or in neighbours. Tile k is for the links of band k with itself and the
   band above, which have at most D different values. The range of hashes is cut
   into D + SPARE parts; at least SPARE of them are alike in two linked sets. A
   set posts a key for each part with values, of the tile's number, the part's and
   its values. Where all parts that are alike can be empty, SPARE or more are in
   both sets, and such sets post the values of their prefixes as well (the first
   values in the order of hashes, of which linked sets share one). So linked sets
   have a key in common. Large sets post the first PARTS parts only; that misses
   a link of different texts with a probability below 1e-13, less than that two
   n-grams of a large corpus have one hash. most=None posts all parts: exact.
2. The members of a key's list are paired with its hub, the member that meets
   most others; linked classes are joined to components. In a group of copies with
   changes of their own each, the hub is the text that they were made from.
3. Lists whose members are in different components go on. A list of up to LONG
   members is one tile, of bitmaps, and gives back the pairs that these leave open;
   longer ones are joined to families, whose tiles are two blocks of one band or of
   neighbours, with whole sets, and give back links only.

Each pair goes through hashed bitmaps first: a bit for each value modulo SPREAD times
the set's size at least. A bit of the one that the other lacks stands for a value that
the other lacks, so counts of bits bound the overlap from above. Only pairs that
the bound leaves open are intersected, as sorted arrays of whole sets.

Defined results: words are the runs outside 0x20 and 0x09-0x0D after A-Z are
lower-cased; with fewer words than an n-gram has, the whole sequence is the one
n-gram; null, empty and blank texts have an empty set and are linked with nothing;
repeated rows are linked, as equal sets are; rows that repeat an id are linked each
by its own text; rows with a null id stand alone; an empty table stays empty;
columns other than those named are not read. Classes and n-grams go by hashes of 64
bits.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import Marks, discard, only, release, settle, text_chunks, tidied
from quernstone.llm.components import connected
from quernstone.llm.neardup import enough, shingle_set

#: Parts beyond the number of differences, and the parts that a set posts for a tile at most.
SPARE, PARTS = 2, 72
#: Members beyond which a list is cut into blocks; rows and values of a block.
LONG, BLOCK_ROWS, BLOCK_VALUES = 1024, 1024, 1 << 20
#: Bits of a bitmap for each value, at least.
SPREAD = 8
#: Places that the pairs of one class are spread over.
SALTS = 16
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


@cache
def band_starts(percent: int, up_to: int) -> tuple[int, ...]:
    """The least size of each band, until beyond `up_to`."""
    starts = [1]
    while starts[-1] <= up_to:
        starts.append(100 * starts[-1] // percent + 1)
    return tuple(starts)


def band_of(n: int, percent: int) -> int:
    starts = band_starts(percent, 1 << max(10, n.bit_length() + 1))
    return int(np.searchsorted(starts, n, side="right")) - 1


@cache
def differences(band: int, percent: int) -> int:
    """The most values that are in one set only, of linked sets of this band, or of this one and the next."""
    size = 1 << 10
    while len(starts := band_starts(percent, size)) < band + 3:
        size <<= 2
    low = starts[band + 1] - 1
    high = max(low, min(100 * low // percent, starts[band + 2] - 1))
    return (low + high) * (100 - percent) // (100 + percent)


def mixed(values: np.ndarray) -> np.ndarray:
    x = (values ^ (values >> np.uint64(31))) * M2
    x = (x ^ (x >> np.uint64(29))) * M3
    return x ^ (x >> np.uint64(32))


def tile_keys(values: np.ndarray, tile: int, percent: int, most: int | None = PARTS) -> np.ndarray:
    """The keys that a set posts for a tile; values are sorted."""
    n, different = len(values), differences(tile, percent)
    if not different:
        return np.zeros(0, np.uint64)  # linked sets are equal
    parts = different + SPARE
    number = ((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    first = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1])))
    sums = np.add.reduceat(mixed(values), first)
    held = number[first]
    salt = mixed(np.array([tile], np.uint64))
    keys = mixed(sums ^ (held + np.uint64(1)) * M1 ^ salt)
    if most is not None and parts > most:
        return keys[held < most]
    if parts - len(first) >= SPARE:
        prefix = n - (n * percent + 99) // 100 + 1
        keys = np.concatenate((keys, mixed(values[:prefix] + salt)))
    return keys


def posted_keys(values: np.ndarray, percent: int, most: int | None = PARTS) -> np.ndarray:
    """The keys for the tile of a set's own band and the one below."""
    if not len(values):
        return np.zeros(0, np.uint64)
    band = band_of(len(values), percent)
    return np.concatenate([tile_keys(values, tile, percent, most) for tile in (band, band - 1) if tile >= 0])


def bitmap(values: np.ndarray) -> np.ndarray:
    """Words of 64 bits, a power of two of them, with at least SPREAD bits for each value."""
    size = 1 << max(6, (SPREAD * len(values) - 1).bit_length())
    at = values & np.uint64(size - 1)
    out = np.zeros(size // 8, np.uint8)
    np.bitwise_or.at(out, (at >> np.uint64(3)).astype(np.int64), (1 << (at & np.uint64(7))).astype(np.uint8))
    return out.view(np.uint64)


def folded(words: np.ndarray, size: int) -> np.ndarray:
    """A bitmap as one of fewer words: the hash modulo less."""
    return words if len(words) == size else np.bitwise_or.reduce(words.reshape(-1, size), axis=0)


def overlap_bound(n: int, left: np.ndarray, m: int, right: np.ndarray) -> int:
    """No more values than these are in both sets."""
    size = min(len(left), len(right))
    left, right = folded(left, size), folded(right, size)
    lacking, other = int(np.bitwise_count(left & ~right).sum()), int(np.bitwise_count(right & ~left).sum())
    return min(n - lacking, m - other)


def common_values(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted arrays share."""
    if len(x) > len(y):
        x, y = y, x
    return int(np.count_nonzero(y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x))


def open_pairs(n: np.ndarray, sides: np.ndarray, components: np.ndarray, maps: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the pairs of different components, and of different sides unless all rows are of one, whose bitmaps leave a link open; with their greatest likeness."""
    size = min(map(len, maps))
    bits = np.stack([folded(m, size) for m in maps])
    counts = np.bitwise_count(bits).sum(1).astype(np.int64)
    within = sides.min() == sides.max()
    found: list[tuple[np.ndarray, ...]] = []
    for i in range(len(n)):
        others = np.arange(i + 1, len(n)) if within else np.flatnonzero(sides > sides[i])
        others = others[(components[others] != components[i]) & (100 * np.minimum(n[others], n[i]) >= percent * np.maximum(n[others], n[i]))]
        for start in range(0, len(others), max(1, (1 << 20) // size)):
            part = others[start : start + max(1, (1 << 20) // size)]
            shared = np.bitwise_count(bits[i] & bits[part]).sum(1).astype(np.int64)
            bound = np.minimum(n[i] - counts[i] + shared, n[part] - counts[part] + shared)
            union = n[i] + n[part] - bound
            open_ = 100 * bound >= percent * union
            if open_.any():
                found.append((np.full(open_.sum(), i), part[open_], bound[open_] / union[open_]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    return tuple(np.concatenate(x) for x in zip(*found))


def tile_links(ids: list[int], sides: list[int], components: list[int], sets: list[np.ndarray], maps: list[np.ndarray], percent: int, every: bool) -> list[tuple[int, int]]:
    """Links between rows of different sides (or, where all rows are of one, of that): enough to join what they join, or all."""
    left, right, likeness = open_pairs(np.array([len(s) for s in sets], np.int64), np.array(sides), np.array(components), maps, percent)
    label = {c: c for c in components}

    def find(x: int) -> int:
        while label[x] != x:
            x = label[x] = label[label[x]]
        return x

    links = []
    for at in np.argsort(-likeness, kind="stable").tolist():
        i, j = int(left[at]), int(right[at])
        a, b = find(components[i]), find(components[j])
        if (every or a != b) and enough(common_values(sets[i], sets[j]), len(sets[i]), len(sets[j]), percent):
            label[max(a, b)] = min(a, b)
            links.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return links


def _posted(width: int, percent: int, most: int | None):
    import xxhash

    schema = pa.schema([("id", pa.int64()), ("class", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                sets = [shingle_set(t, width) for t in texts]
                classes = np.fromiter((xxhash.xxh3_64_intdigest(s.tobytes()) for s in sets), np.uint64, len(sets)).view(np.int64)
                keys = [posted_keys(s, percent, most) for s in sets]
                offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(keys).view(np.int64)))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(classes), pa.array(map(len, sets), pa.int64()), lists], schema=schema)

    return run


def _kept_keys(marks: Marks):
    """A row for each key whose cell is marked."""
    marked, mask = marks.tester(), np.int64((1 << marks.bits) - 1)
    schema = pa.schema([("key", pa.int64()), ("class", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute  # noqa: F401

        for batch in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
            lists = batch.column("keys")
            keys, times = lists.flatten().to_numpy(zero_copy_only=False), pa.compute.list_value_length(lists).to_numpy(zero_copy_only=False)
            kept = marked(keys & mask)
            own = [np.repeat(batch.column(c).to_numpy(zero_copy_only=False), times)[kept] for c in ("class", "n")]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys[kept], *own)], schema=schema)

    return run


def _sets(width: int, marks: Marks):
    """Whole sets and their bitmaps of the rows whose cell is marked."""
    import xxhash

    marked = marks.tester()
    schema = pa.schema([("class", pa.int64()), ("n", pa.int64()), ("bits", pa.binary()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(marked(batch.column("cell").to_numpy(zero_copy_only=False))))
            for _, texts in text_chunks(batch):
                sets = [s for s in (shingle_set(t, width) for t in texts) if len(s)]
                held = [s.tobytes() for s in sets]
                classes = np.fromiter(map(xxhash.xxh3_64_intdigest, held), np.uint64, len(held)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(classes), pa.array(map(len, sets), pa.int64()), pa.array([bitmap(s).tobytes() for s in sets], pa.binary()), pa.array(held, pa.binary())], schema=schema)

    return run


PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _pairs(found: list[tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    if found:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=PAIRS)


def _possible(percent: int):
    """The pairs whose bitmaps leave a link open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            rows = zip(*[batch.column(c).to_pylist() for c in ("a", "b", "n", "m", "left", "right")])
            yield from _pairs([(a, b) for a, b, n, m, x, y in rows if enough(overlap_bound(n, np.frombuffer(x, np.uint64), m, np.frombuffer(y, np.uint64)), n, m, percent)])

    return run


def _confirmed(percent: int):
    """The pairs whose whole sets are alike enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            rows = zip(*[batch.column(c).to_pylist() for c in ("a", "b", "left", "right")])
            sets = ((a, b, np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)) for a, b, x, y in rows)
            yield from _pairs([(a, b) for a, b, x, y in sets if enough(common_values(x, y), len(x), len(y), percent)])

    return run


def _gathered(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """The rows of one key, which is the first columns, after the other, without it."""
    key, held = None, []
    for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
        for row in zip(*[c.to_pylist() for c in batch.columns]):
            if key != row[:keys]:
                if held:
                    yield held
                key, held = row[:keys], []
            held.append(row[keys:])
    if held:
        yield held


def _tiles(percent: int, every: bool):
    """Links of tiles of whole sets. Rows: family, k, i, l, j, class, side, component, bits, values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, 5):
            ids, sides, components, maps, sets = zip(*held)
            if len(set(components)) > 1:
                yield from _pairs(tile_links(ids, sides, components, [np.frombuffer(s, np.uint64) for s in sets], [np.frombuffer(m, np.uint64) for m in maps], percent, every))

    return run


def _open(percent: int):
    """Pairs of a list that bitmaps leave open. Rows: key, class, n, component, bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _gathered(batches, 1):
            ids, n, components, maps = zip(*held)
            left, right, _ = open_pairs(np.array(n, np.int64), np.zeros(len(n)), np.array(components), [np.frombuffer(m, np.uint64) for m in maps], percent)
            yield from _pairs([(min(ids[i], ids[j]), max(ids[i], ids[j])) for i, j in zip(left.tolist(), right.tolist())])

    return run


def _linked(pairs: DataFrame, sets: DataFrame, percent: int, bounded: bool = False) -> DataFrame:
    """The pairs (a, b) that are linked: by bitmaps, unless these have bounded them, then by whole sets. A class may have any number of pairs as a: they go to SALTS places by b, and its set to each of these."""

    def held(pairs: DataFrame, name: str) -> DataFrame:
        salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
        lefts = salted.select("a", "salt").distinct().join(sets.select(F.col("class").alias("a"), "n", F.col(name).alias("left")), "a")
        rights = sets.select(F.col("class").alias("b"), F.col("n").alias("m"), F.col(name).alias("right"))
        return salted.join(rights, "b").join(lefts, ["a", "salt"]).select("a", "b", "n", "m", "left", "right")

    possible = pairs if bounded else held(pairs, "bits").mapInArrow(tidied(_possible(percent)), "a long, b long")
    return held(possible, "values").mapInArrow(tidied(_confirmed(percent)), "a long, b long")


def _band(percent: int) -> F.Column:
    """The band of n, for any size of a text."""
    starts = band_starts(percent, 1 << 34)
    return F.aggregate(F.array(*[F.lit(s) for s in starts]), F.lit(-1), lambda k, s: k + (F.col("n") >= s).cast("int"))


def _tile_links(members: DataFrame, sets: DataFrame, percent: int, every: bool) -> DataFrame:
    """members: key, class, n, component of long lists. Links found tile by tile."""
    firsts = members.groupBy("key").agg(F.min("class").alias("a"))
    families = connected(members.join(firsts, "key").where("a < class").select("a", F.col("class").alias("b")).distinct()).withColumnsRenamed({"id": "class", "component": "family"})
    rows = members.select("class", "n", "component").distinct().join(families, "class").withColumn("band", _band(percent))
    sizes = rows.groupBy("family", "band").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_VALUES)).cast("int").alias("blocks"))
    # the blocks of the band itself and of its neighbours that a row meets
    near = sizes.select("family", "blocks", F.col("band").alias("with"), F.explode(F.array(F.col("band") - 1, F.col("band"), F.col("band") + 1)).alias("band"))
    near = near.groupBy("family", "band").agg(F.collect_list(F.struct("with", "blocks")).alias("near"))  # three at most
    own = rows.join(sizes, ["family", "band"]).withColumn("own", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")).join(near, ["family", "band"])
    met = F.flatten(F.transform("near", lambda x: F.transform(F.sequence(F.lit(0), x["blocks"] - 1), lambda i: F.struct(x["with"].alias("band"), i.alias("block")))))
    dealt = own.select("family", "class", "component", F.struct("band", F.col("own").alias("block")).alias("own"), F.explode(met).alias("other"))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    dealt = dealt.select("family", low.alias("low"), high.alias("high"), "class", (F.col("own") == F.col("high")).cast("int").alias("side"), "component")
    dealt = dealt.select("family", F.col("low.band").alias("k"), F.col("low.block").alias("i"), F.col("high.band").alias("l"), F.col("high.block").alias("j"), "class", "side", "component").join(sets.select("class", "bits", "values"), "class")
    tile = ["family", "k", "i", "l", "j"]
    return dealt.select(*tile, "class", "side", "component", "bits", "values").repartition(*tile).sortWithinPartitions(*tile).mapInArrow(tidied(_tiles(percent, every)), "a long, b long")


def _rest(lists: DataFrame, sets: DataFrame, tried: DataFrame | None, percent: int, every: bool) -> DataFrame:
    """lists: key, class, n, component. Links between members of different components of a list."""
    open_ = lists.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high").select("key", "size")
    open_ = settle(lists.join(open_, "key"), "open")
    short = open_.where(F.col("size") <= LONG).select("key", "class", "n", "component").join(sets.select("class", "bits"), "class").select("key", "class", "n", "component", "bits")
    pairs = short.repartition("key").sortWithinPartitions("key").mapInArrow(tidied(_open(percent)), "a long, b long").distinct()
    if tried is not None:
        pairs = pairs.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    pairs = settle(pairs, "pairs")
    found = settle(_linked(pairs, sets, percent, bounded=True).union(_tile_links(open_.where(F.col("size") > LONG), sets, percent, every)).distinct(), "links")
    discard(open_, pairs)
    return found


class Join:
    """The join of a frame's documents: `rows` (id, class, n) for each input row, `classes` (class, first, rows) and, of these, the lists and sets of those that may be linked."""

    def __init__(self, frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 4, percent: int = 85, most: int | None = PARTS):
        self.id_col, self.percent = id_col, percent
        frame = only(frame, id_col, text_col)
        text = F.coalesce(frame[f"`{text_col}`"].cast("string"), F.lit(""))
        source = frame.select(frame[f"`{id_col}`"].cast("long").alias("id"), text.alias("text"))
        self.rows = settle(source.mapInArrow(tidied(_posted(width, percent, most)), "id long, class long, n long, keys array<long>"), "rows")
        linkable = self.rows.where("n > 0 AND id IS NOT NULL")
        self.classes = settle(linkable.groupBy("class").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")), "classes")
        keys = linkable.select(F.explode("keys").alias("key"), "class", "n")
        shared = settle(keys.groupBy("key").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high").select("key"), "shared")
        release(frame.sparkSession)
        marks = Marks(shared)
        posted = linkable.select("class", "n", "keys").mapInArrow(tidied(_kept_keys(marks)), "key long, class long, n long").join(shared, "key").distinct()
        posted = settle(posted, "posted")
        members = posted.groupBy("key").agg(F.count(F.lit(1)).alias("members"))
        met = posted.join(members, "key").groupBy("class").agg(F.sum("members").alias("met"))
        self.lists = settle(posted.join(met, "class"), "lists")
        firsts = settle(self.classes.join(self.lists.select("class").distinct(), "class", "left_semi").select(F.xxhash64("first").alias("cell")), "firsts")
        marks = Marks(firsts)
        discard(shared, posted, firsts)
        chosen = source.where("id IS NOT NULL").select("text", marks.cell(F.xxhash64("id")).alias("cell"))
        sets = chosen.mapInArrow(tidied(_sets(width, marks)), "class long, n long, bits binary, values binary")
        self.sets = settle(sets.join(self.lists.select("class").distinct(), "class", "left_semi").dropDuplicates(["class"]), "sets")
        release(frame.sparkSession)

    def links(self, every: bool = True) -> DataFrame:
        """a, b: linked classes, all or, which is much less where many are alike, enough to join what is joined."""
        alone = self.lists.select("key", "class", "n", F.col("class").alias("component"))
        if every:
            return _rest(alone, self.sets, None, self.percent, True)
        hubs = self.lists.groupBy("key").agg(F.max(F.struct("met", "class", "n")).alias("hub"))
        sized = (F.col("n") * 100 >= F.col("hub.n") * self.percent) & (F.col("hub.n") * 100 >= F.col("n") * self.percent)
        star = self.lists.join(hubs, "key").where((F.col("class") != F.col("hub.class")) & sized)
        star = settle(star.select(F.col("hub.class").alias("a"), F.col("class").alias("b")).distinct(), "pairs")
        near = settle(_linked(star, self.sets, self.percent), "links")
        release(star.sparkSession)
        joined = connected(near)
        placed = alone.drop("component").join(joined.withColumnRenamed("id", "class"), "class", "left").withColumn("component", F.coalesce("component", "class"))
        late = _rest(placed, self.sets, star, self.percent, False)
        discard(star, joined)
        return near.union(late)

    def components(self) -> DataFrame:
        """A row for each input row: id, n_shingles, component_id (the smallest id that links reach)."""
        joined = connected(self.links(every=False))
        least = self.classes.join(joined.withColumnRenamed("id", "class"), "class")
        least = least.join(least.groupBy("component").agg(F.min("first").alias("least")), "component").select("class", "least")
        classes = self.classes.join(least, "class", "left").select("class", F.coalesce("least", "first").alias("least"))
        rows = self.rows.select("id", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("class")).alias("class"))
        return rows.join(classes, "class", "left").select(F.col("id").alias(self.id_col), F.col("n").alias("n_shingles"), F.coalesce("least", "id").alias("component_id"))
