"""Near duplicates by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct word shingles; documents of
equal sets are one class from the start. A class's bottom-k sketch retains the
k least hashes of its set. Work goes in three steps, none of which makes all
pairs of a group:

1. Inverted lists of runs of retained values that stand next to each other find
   the classes that may have a partner at all. Sets of at most k values have
   whole sketches: the s values that two of them share lie in at most d + 1
   gaps between the d others, so that one run of s / (d + 1), rounded up, is
   common. Each set posts the lengths that its possible partners' sizes ask for,
   RUN at most, and no such link is lost. With larger sets a value of the joint
   order is shared with probability J; the run is as long as keeps a pair
   without any common one below a probability of 1e-9, for J down to 0.28.
2. Only those classes go on. Their values are ordered, rarest first, and each
   class posts the first values that a partner must share one of (prefix filter:
   exact, whatever the order). Values that no other class has take the first
   places, so that documents which only share a page frame, or an ancestor of
   too low a likeness, rarely meet. A list's hub is the member of most slack: the
   values that it may still lack by its size, less those that it has passed
   before. The members are paired with the hub; pairs whose union sketch rules the
   link out are dropped, the others confirmed on whole sets, and linked classes
   joined to components.
3. What can still be missing are links between members of one list that are in
   different components. In the list of the first value that two linked sets
   share, what both have passed before is in one of them only, so their slacks add
   up to at least none. So members whose slack does not make up for the hub's
   leave the list: of many documents that share a frame and are too unlike, none
   stays. In lists of at most LONG members the pairs that are left are made, by
   lengths and slacks, and confirmed in the same way. Longer lists are joined to
   families; a family is cut into blocks of bounded size, each two blocks meet in
   one task, which counts common values of all its rows at once and gives back no
   more links than join its components.

Defined results: words are the runs outside 0x20 and 0x09-0x0D after A-Z are
lower-cased; with fewer words than a shingle has, the whole sequence is the one
shingle; null, empty and blank texts have an empty set and are linked with
nothing; repeated rows are linked, as equal sets are; rows that repeat an id are
linked each by its own text; rows with a null id stand alone; columns other than those named are not read.
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

#: Retained values, and how many neighbours make a run at most.
K, RUN = 64, 3
#: Members from which on a list is worked on in blocks; rows and values of a block.
LONG, BLOCK_ROWS, BLOCK_VALUES = 128, 1024, 1 << 20
#: Places that the pairs of one class are spread over.
SALTS = 16
#: A pair is dropped unread if the union sketch's estimate is this far below the threshold: over seven standard deviations at k = 64.
MARGIN = 0.35
M1, M2, M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def shingle_set(text: str, width: int) -> np.ndarray:
    """The sorted distinct 64-bit hashes of a text's word shingles."""
    import xxhash

    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, and just these six blanks
    if not words:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    mixed = np.full(n, len(words) if len(words) < width else width, np.uint64)
    for i in range(min(width, len(words))):
        mixed = (mixed ^ hashes[i : i + n]) * M1
        mixed ^= mixed >> np.uint64(32)
    mixed *= M3
    mixed ^= mixed >> np.uint64(29)
    return np.unique(mixed)


def common_run(n: int, m: int, percent: int) -> int:
    """The run that whole sets of n and m values have in common at least if they are linked and differ; 0 if there are none such."""
    shared = max(1, -(-percent * (n + m) // (100 + percent)))
    others = n + m - 2 * shared
    return -(-shared // (others + 1)) if shared <= min(n, m) and others else 0


@cache
def wide_run(percent: int) -> int:
    """The longest run, up to RUN, that K values of a joint order lack with a probability below 1e-9."""
    p = percent / 100
    for run in range(RUN, 1, -1):
        ends = [1.0] + [0.0] * (run - 1)  # by the number of shared values at the end
        for _ in range(K):
            ends = [(1 - p) * sum(ends), *(p * x for x in ends[:-1])]
        if sum(ends) < 1e-9:
            return run
    return 1


@cache
def run_lengths(n: int, percent: int) -> tuple[int, ...]:
    """Lengths of the runs that a set of n values posts, so that each possible partner posts one of them too."""
    if n > K:
        return (wide_run(percent),)
    found = {min(RUN, common_run(n, m, percent)) for m in range(1, K + 1)}
    if common_run(n, K + 1, percent):
        found.add(wide_run(percent))
    return tuple(sorted(found - {0}))


def run_keys(values: np.ndarray, percent: int) -> np.ndarray:
    """A key for each run of neighbours in the sketch of a set, of each length that it posts."""
    made = [np.zeros(0, np.uint64)]
    for run in run_lengths(len(values), percent):
        n = min(len(values), K) - run + 1
        keys = np.full(n, run, np.uint64)
        for i in range(run):
            keys = (keys ^ values[i : i + n]) * M2
            keys ^= keys >> np.uint64(31)
        made.append(keys)
    return np.concatenate(made)


def enough(shared: int, n: int, m: int, percent: int) -> bool:
    return 100 * shared >= percent * (n + m - shared)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    flat = np.concatenate(values) if values else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64) if flat.dtype == np.uint64 else flat, kind))


def _sketches(width: int, percent: int):
    import xxhash

    schema = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()), ("key", pa.binary()), ("runs", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                sets = [shingle_set(t, width) for t in texts]
                keys = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("text_key"), pa.array(map(len, sets), pa.int64()), pa.array(keys, pa.binary()), _lists([run_keys(s, percent) for s in sets], pa.int64())], schema=schema)

    return run


def _sets(width: int, marks: Marks):
    """Whole sets, and their keys, of the rows whose cell is marked."""
    import xxhash

    marked = marks.tester()

    schema = pa.schema([("class", pa.int64()), ("key", pa.binary()), ("n", pa.int64()), ("values", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        for batch in batches:
            batch = batch.filter(pa.array(marked(batch.column("cell").to_numpy(zero_copy_only=False))))
            for part, texts in text_chunks(batch):
                sets = [shingle_set(t, width) for t in texts]
                held = [s.tobytes() for s in sets]
                found = pa.RecordBatch.from_arrays([part.column("id"), pa.array(map(xxhash.xxh3_128_digest, held), pa.binary()), pa.array(map(len, sets), pa.int64()), pa.array(held, pa.binary())], schema=schema)
                yield found.filter(pc.greater(found.column("n"), 0))

    return run


def _values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each value of each set."""
    for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
        sets = [np.frombuffer(x, np.int64) for x in batch.column("values").to_pylist()]
        ids = np.repeat(batch.column("id").to_numpy(zero_copy_only=False), [len(x) for x in sets])
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets)), pa.array(ids, pa.int64())], names=["value", "id"])


def postings_of(sets: DataFrame, percent: int) -> DataFrame:
    """value, id, n, at, excess: the values, rarest first, one of which any partner of at least this likeness must hold, with their places.

    excess is the slack with its sign turned, times 100 + percent: a pair that is linked and meets here first has a sum of none at most, since
    (n - common) + (m - common) is at least the sum of their places, and at most (n + m) * (100 - percent) / (100 + percent).

    Values of a single set come first in the order and match nothing, so they only take up places.
    """
    values = sets.select("id", "values").mapInArrow(tidied(_values), "value long, id long")
    counts = values.groupBy("value").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = values.join(counts, "value").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("df", "value"))).alias("shared"))
    prefix = F.col("n") - F.ceil(F.col("n") * percent / 100 - 1e-6) + 1
    alone = F.col("n") - F.size("shared")
    posted = shared.join(sets.select("id", "n"), "id").withColumn("alone", alone).where(prefix > alone)
    posted = posted.select("id", "n", "alone", F.posexplode(F.slice("shared", F.lit(1), (prefix - alone).cast("int"))).alias("pos", "posted"))
    at = (F.col("alone") + F.col("pos")).cast("int")
    return posted.select(F.col("posted.value").alias("value"), "id", "n", at.alias("at"), (at * (100 + percent) - F.col("n") * (100 - percent)).cast("long").alias("excess"))


def block_links(ids: np.ndarray, components: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links between rows of different components, enough to join what they join."""
    m = len(ids)
    sizes = np.array([len(x) for x in sets], np.int64)
    values, rows = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    order = np.argsort(values, kind="stable")
    values, rows = values[order], rows[order]
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
    times = np.diff(np.append(first, len(values)))
    common = np.zeros(m * m, np.float32)
    for d in np.unique(times[(times > 1) & (times < 64)]).tolist():
        members = rows[first[times == d][:, None] + np.arange(d)]
        for i in range(d):
            for j in range(i + 1, d):
                np.add.at(common, members[:, i] * m + members[:, j], 1)  # a value's rows are in order
    common = common.reshape(m, m)
    often = np.flatnonzero(times >= 64)
    for i in range(0, len(often), 2048):
        part = often[i : i + 2048]
        held = np.zeros((m, len(part)), np.float32)
        for j, at in enumerate(part.tolist()):
            held[rows[first[at] : first[at] + times[at]], j] = 1
        common += held @ held.T
    union = sizes[:, None] + sizes[None, :] - common
    near = np.triu((100 * common >= percent * union) & (components[:, None] != components[None, :]), 1)
    label = {c: c for c in components.tolist()}

    def find(x: int) -> int:
        while label[x] != x:
            x = label[x] = label[label[x]]
        return x

    links = []
    for i, j in zip(*[x.tolist() for x in np.nonzero(near)]):
        a, b = find(int(components[i])), find(int(components[j]))
        if a != b:
            label[max(a, b)] = min(a, b)
            links.append((int(ids[i]), int(ids[j])))
    return links


def _blocks(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def links() -> Iterator[pa.RecordBatch]:
            if held and len({x[1] for x in held}) > 1:
                found = block_links(np.array([x[0] for x in held]), np.array([x[1] for x in held]), [np.frombuffer(x[2], np.uint64) for x in held], percent)
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

        for batch in (whole.slice(i, 1024) for whole in batches for i in range(0, whole.num_rows, 1024)):
            for family, one, two, row, component, values in zip(*[c.to_pylist() for c in batch.columns]):
                if key != (family, one, two):
                    yield from links()
                    key, held = (family, one, two), []
                held.append((row, component, values))
        yield from links()

    return run


def _family_links(members: DataFrame, values: DataFrame, percent: int) -> DataFrame:
    """members: value, id, n, component of long lists. Links found block by block."""
    firsts = members.groupBy("value").agg(F.min("id").alias("a"))
    families = connected(members.join(firsts, "value").where("a < id").select("a", F.col("id").alias("b")).distinct())
    rows = families.withColumnRenamed("component", "family").join(members.select("id", "n", F.col("component")).distinct(), "id")
    sizes = rows.groupBy("family").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS), F.ceil(F.sum("n") / BLOCK_VALUES)).cast("int").alias("blocks"))
    rows = rows.join(sizes, "family").withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    dealt = rows.select("id", "component", "family", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    dealt = dealt.select("family", F.least("own", "other").alias("one"), F.greatest("own", "other").alias("two"), "id", "component").join(values, "id")
    keys = ["family", "one", "two"]
    return dealt.select(*keys, "id", "component", "values").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(tidied(_blocks(percent)), "a long, b long")


def _confirmed(percent: int):
    """Pairs whose whole sets are alike enough; first the union sketch of the pair is read."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(i, 256) for whole in batches for i in range(0, whole.num_rows, 256)):
            found = []
            for a, b, left, right in zip(*[c.to_pylist() for c in batch.columns]):
                x, y = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                low = np.union1d(x[:K], y[:K])[:K]
                shared = np.intersect1d(x[:K], y[:K], assume_unique=True)
                if np.count_nonzero(shared <= low[-1]) < (percent / 100 - MARGIN) * len(low):
                    continue
                if enough(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent):
                    found.append((a, b))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], schema=schema)

    return run


def _bounds(percent: int) -> F.Column:
    """What a link of a and b demands in any list of a value that they share: lengths, and the values passed before."""
    lengths = (F.col("n") * 100 >= F.col("m") * percent) & (F.col("m") * 100 >= F.col("n") * percent)
    least = F.ceil((F.col("n") + F.col("m")) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-6))
    return lengths & (F.abs(F.col("at") - F.col("at_m")) <= F.col("n") + F.col("m") - 2 * least)


def near_duplicates(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, keyed: bool = False) -> DataFrame:
    """A row for each input row: id, n_shingles, component_id (the smallest id that links reach), kept.

    keyed: and text_key, the text's 64-bit hash, and owner, which tells rows of the
    component's smallest id and, of these, least text_key from all others.
    """
    spark, frame = frame.sparkSession, only(frame, id_col, text_col)
    text = F.coalesce(frame[f"`{text_col}`"].cast("string"), F.lit(""))
    source = frame.select(frame[f"`{id_col}`"].cast("long").alias("id"), text.alias("text"))
    keyed_source = source.withColumn("text_key", F.xxhash64("text"))
    rows = settle(keyed_source.mapInArrow(tidied(_sketches(width, percent)), "id long, text_key long, n long, key binary, runs array<long>"), "sketches")
    linkable = rows.where("n > 0 AND id IS NOT NULL")
    grouped = linkable.groupBy("key").agg(F.min(F.struct("id", "text_key")).alias("first"), F.first("runs").alias("runs"))
    # a class goes by a number of its own from here on: rows that repeat an id may be of several classes
    classes = settle(grouped.select("key", F.col("first.id").alias("class"), "first", "runs", F.monotonically_increasing_id().alias("number")), "classes")
    runs = classes.select("class", F.explode("runs").alias("run"))
    shared = runs.groupBy("run").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    partners = settle(runs.join(shared.select("run"), "run", "left_semi").select(F.xxhash64("class").alias("key")).distinct(), "partners")
    marks = Marks(partners)
    discard(partners)
    marked = source.where("id IS NOT NULL").select("id", "text", marks.cell(F.xxhash64("id")).alias("cell"))
    sets = marked.mapInArrow(tidied(_sets(width, marks)), "class long, key binary, n long, values binary")
    # rows of one class may be marked alike: one set for each class
    release(spark)
    numbers = classes.select("class", "key", F.col("number").alias("id"))
    sets = settle(sets.join(numbers, ["class", "key"]).select("id", "n", "values").dropDuplicates(["id"]), "sets")
    release(spark)
    postings = settle(postings_of(sets, percent), "postings")
    release(spark)
    values = sets.select("id", "values")

    def confirm(pairs: DataFrame) -> DataFrame:
        # a hub may have any number of pairs: they go to SALTS places by the other member, and the hub's set to each of these
        salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(SALTS)))
        lefts = salted.select("a", "salt").distinct().join(values.withColumnsRenamed({"id": "a", "values": "left"}), "a")
        both = salted.join(values.withColumnsRenamed({"id": "b", "values": "right"}), "b").join(lefts, ["a", "salt"])
        return both.select("a", "b", "left", "right").mapInArrow(tidied(_confirmed(percent)), "a long, b long")

    hubs = postings.groupBy("value").agg(F.min(F.struct("excess", "id", "n", "at")).alias("hub"), F.count(F.lit(1)).alias("members")).where("members > 1")
    met = postings.join(hubs.select("value", F.col("hub.id").alias("a"), F.col("hub.n").alias("m"), F.col("hub.at").alias("at_m")), "value")
    star = settle(met.where((F.col("id") != F.col("a")) & _bounds(percent)).select("a", F.col("id").alias("b")).distinct(), "pairs")
    links = settle(confirm(star), "links")
    joined = connected(links)
    release(spark)
    # lists whose members are not all in one component yet, without the members that no other one there can be linked with
    possible = postings.join(hubs.select("value", F.col("hub.excess").alias("least")), "value").where(F.col("excess") + F.col("least") <= 0).drop("least")
    placed = possible.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    mixed = placed.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count(F.lit(1)).alias("size")).where("low < high").select("value", "size")
    open_ = settle(placed.join(mixed, "value"), "open")
    short = open_.where(F.col("size") <= LONG)
    other = short.select(F.col("value").alias("value_m"), F.col("id").alias("a"), F.col("n").alias("m"), F.col("at").alias("at_m"), F.col("excess").alias("excess_m"), F.col("component").alias("component_m"))
    rest = short.join(other, (F.col("value") == F.col("value_m")) & (F.col("a") < F.col("id")) & (F.col("component") != F.col("component_m")) & (F.col("excess") + F.col("excess_m") <= 0) & _bounds(percent))
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = rest.select("a", F.col("id").alias("b")).distinct().join(tried, ["a", "b"], "left_anti")
    late = settle(confirm(rest).union(_family_links(open_.where(F.col("size") > LONG), values, percent)), "links")
    if not late.isEmpty():
        first_joined, joined = joined, connected(links.union(late))
        discard(first_joined)
    discard(sets, postings, star, links, open_, late)
    linked = settle(classes.select("key", "first", F.col("number").alias("id")).join(joined, "id"), "linked")
    discard(joined)
    least = linked.groupBy("component").agg(F.min("first").alias("least"))
    linked = linked.join(least, "component").select("key", "least")
    classes = classes.select("key", "first").join(linked, "key", "left").select("key", F.coalesce("least", "first").alias("least"))
    out = rows.select("id", "text_key", "n", F.when((F.col("n") > 0) & F.col("id").isNotNull(), F.col("key")).alias("key")).join(classes, "key", "left")
    component = F.coalesce("least.id", "id")
    owner = F.col("least").isNull() | ((F.col("least.id") == F.col("id")) & (F.col("least.text_key") == F.col("text_key")))
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("id")).alias("kept"), *(["text_key", owner.alias("owner")] if keyed else []))
