"""Language-model scores of a hashed maximum-entropy model with class-factored softmax.

P(word | history) = P(group | history) P(class | group, history) P(word | class).
The first two factors are softmaxes over weights of hashed features: the class of
the word before, the classes of the two before (n-grams), the last frequent word
however many others it skips, and the word before itself. The most frequent
words are classes of their own. All others have FORMS classes by their last two
bytes; which endings make a class is learned from the endings around them, so
that a class holds words of like surroundings. The last factor is absolute
discounting: a word of n training tokens has n - D, and what is taken off goes
to one event of each class that stands for all words it never saw, as the base
score has one such event in all; so the probabilities of the known words and of
these events sum to one after every history.

The weights start at the classes' shares and are trained in rounds: each training
document takes part in one round and one shard, both by the hash of its id and
text; a shard takes gradient steps on its own documents in the order of that
hash, and the shards' changes are averaged by blocks of feature rows on the
executors. Shards follow the number of training tokens, never the partitions, so
the model does not depend on how the input is laid out. Feature rows double with
each sixteenfold of training tokens from 2^26 on.

What grows with the corpus stays distributed: words are counted by a shuffle;
only the counts of frequent words, HEAD of them at most, are broadcast; the
others are joined by word, which changes no score. Scoring runs in sparse numpy
batches.

Defined results: words are the runs outside 0x20 and 0x09-0x0D after A-Z are
lower-cased; each text, a null or empty one too, ends in one end token; words
are told apart by 64-bit hashes; without training tokens all counts are 0 and
every word has the probability of an unknown one; rows that repeat an id are
scored each by its own text; rows of a null id are learned from; rows alike in
id and text are learned in one shard; columns other than those named are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quernstone.llm.common import only, settle, text_chunks, tidied

#: Counts that are broadcast at most: 16 bytes each.
HEAD = 1 << 20
SINGLES, FORMS, GROUP = 64, 64, 16
CLASSES, GROUPS = SINGLES + FORMS, (SINGLES + FORMS) // GROUP
#: Hash values of words' last two bytes, and of the neighbours' by which they are classed (before and after).
CODES, AROUND = 1 << 11, 64
START = CLASSES
ROWS, WIDTH, PER_BLOCK = 1 << 13, GROUPS + CLASSES, 16
ROUNDS, BATCH, RATE, PRIOR = 2, 1 << 12, 0.4, 100.0
#: Training tokens of a shard, about, at ROWS feature rows; a small corpus has up to FEW shards of an eighth of that.
SHARD, FEW = 1 << 21, 8
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
#: The end token's key: the hash of no bytes, which no word has.
END = 0x2D06800538D394C2
END_KEY = int(np.uint64(END).view(np.int64))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").lower().split()


def codes_of(words: list[bytes]) -> np.ndarray:
    """A hash of each word's last two bytes."""
    data = np.frombuffer(b"  " + b"  ".join(words) + b"  ", np.uint8).astype(np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 2)
    mixed = (data[ends - 1] * np.uint64(256) + data[ends - 2]) * M1
    return (mixed >> np.uint64(53)).astype(np.int64)


def around_of(codes: np.ndarray) -> np.ndarray:
    """How often each code has each neighbour: CODES rows; the hashed codes before, then those after. Both ends count as an end token."""
    end = codes_of([b""])
    hashed = ((np.concatenate((end, codes, end)).astype(np.uint64) * M2) >> np.uint64(58)).astype(np.int64)
    cells = codes * (2 * AROUND)
    both = np.concatenate((cells + hashed[:-2], cells + AROUND + hashed[2:]))
    return np.bincount(both, minlength=CODES * 2 * AROUND).reshape(CODES, 2 * AROUND)


def forms_by_neighbours(around: np.ndarray) -> np.ndarray:
    """The form of each code: codes are split along their principal axis, the widest set first, until there are FORMS sets."""
    out, mass = np.zeros(CODES, np.int64), around.sum(1).astype(np.float64)
    used = np.flatnonzero(mass)
    if not len(used):
        return out
    shares = around + 10 * around.sum(0) / around.sum()
    points = np.sqrt(shares / shares.sum(1, keepdims=True))

    def axes(chosen: np.ndarray, n: int) -> np.ndarray:
        """Places of the chosen codes along their n widest axes."""
        weights = mass[chosen][:, None]
        centred = points[chosen] - (points[chosen] * weights).sum(0) / weights.sum()
        found = np.linalg.eigh((centred * weights).T @ centred)[1][:, ::-1][:, :n]
        found *= np.sign(found[np.abs(found).argmax(0), np.arange(found.shape[1])])
        return centred @ found

    reduced = np.zeros((CODES, 4))
    reduced[used] = axes(used, 4)
    points = reduced

    def spread(chosen: np.ndarray) -> float:
        weights = mass[chosen][:, None]
        centred = points[chosen] - (points[chosen] * weights).sum(0) / weights.sum()
        return float((weights * centred**2).sum()) if len(chosen) > 1 else -1.0

    sets = [(spread(used), used)]
    while len(sets) < FORMS:
        at = max(range(len(sets)), key=lambda i: sets[i][0])
        if sets[at][0] <= 0:
            break
        chosen = sets.pop(at)[1]
        place = axes(chosen, 1)[:, 0]
        order = np.argsort(place, kind="stable")
        chosen, place = chosen[order], place[order]
        low, sums = np.cumsum(mass[chosen]), np.cumsum(mass[chosen] * place)
        between = sums[:-1] ** 2 / low[:-1] + (sums[-1] - sums[:-1]) ** 2 / (low[-1] - low[:-1])
        cut = int(between.argmax()) + 1
        sets += [(spread(part), part) for part in (chosen[:cut], chosen[cut:])]
    for form, (_, chosen) in enumerate(sets):
        out[chosen] = form
    return out


def hashes_of(words: list[bytes]) -> np.ndarray:
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


class Tokens:
    """A batch of texts as arrays of all their tokens, end tokens (empty words) included."""

    def __init__(self, texts: list[str]):
        split = [[*words_of(t), b""] for t in texts]
        words = list(chain.from_iterable(split))
        self.lengths = np.fromiter(map(len, split), np.int64, len(split))
        self.hashes, self.codes = hashes_of(words), codes_of(words)
        self.first = np.repeat(np.cumsum(self.lengths) - self.lengths, self.lengths)
        self.place = np.arange(len(words)) - self.first

    def classes(self, singles: np.ndarray, order: np.ndarray, forms: np.ndarray) -> np.ndarray:
        """singles: sorted hashes of the words that are classes; order: their classes; forms: each code's."""
        out = SINGLES + forms[self.codes]
        if len(singles):
            at = np.minimum(np.searchsorted(singles, self.hashes), len(singles) - 1)
            out = np.where(singles[at] == self.hashes, order[at], out)
        return out

    def features(self, classes: np.ndarray, rows: int) -> list[np.ndarray]:
        """Feature rows of each token's history."""

        def back(values: np.ndarray, n: int) -> np.ndarray:
            out = np.full(len(values), START, np.uint64)
            out[n:] = values[:-n] if len(values) > n else values[:0]
            return np.where(self.place >= n, out, np.uint64(START))

        c = classes.astype(np.uint64)
        c1, c2, w1 = back(c, 1), back(c, 2), back(self.hashes, 1)
        last = np.maximum.accumulate(np.where(classes < SINGLES, np.arange(len(classes)), -1))
        last = np.concatenate(([-1], last[:-1]))[: len(classes)]
        skipped = np.where(last >= self.first, c[np.maximum(last, 0)], np.uint64(START))
        made, shift = [], np.uint64(65 - rows.bit_length())
        for kind, key in enumerate((c1, c1 * np.uint64(1009) + c2, skipped, w1)):
            mixed = (key + (np.full(1, kind + 1, np.uint64) * M2)) * M1
            mixed = (mixed ^ (mixed >> np.uint64(32))) * M2
            made.append((mixed >> shift).astype(np.int64))
        return made


class Model:
    """Weights: a row for each feature; GROUPS columns for the groups, then CLASSES for the classes in their groups."""

    def __init__(self, totals: np.ndarray, weights: np.ndarray | None = None, rows: int = ROWS):
        """totals: each class's training tokens."""
        totals = totals.astype(np.float64) + 0.5
        groups = totals.reshape(GROUPS, GROUP).sum(1)
        self.bias = np.concatenate((np.log(groups / groups.sum()), np.log(totals / np.repeat(groups, GROUP)))).astype(np.float32)
        weights = np.zeros((rows, WIDTH), np.float32) if weights is None else weights
        self.rows = len(weights)
        self.outer = weights[:, :GROUPS].copy()
        self.inner = weights[:, GROUPS:].reshape(self.rows * GROUPS, GROUP).copy()

    @property
    def weights(self) -> np.ndarray:
        return np.concatenate((self.outer, self.inner.reshape(self.rows, CLASSES)), 1)

    def forward(self, rows: list[np.ndarray], classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of the groups, and of the classes in the true group."""
        group = classes // GROUP
        outer_scores = np.repeat(self.bias[None, :GROUPS], len(classes), 0)
        inner_scores = self.bias[GROUPS:].reshape(GROUPS, GROUP).take(group, 0)
        for row in rows:
            outer_scores += self.outer.take(row, 0)
            inner_scores += self.inner.take(row * GROUPS + group, 0)
        for scores in (outer_scores, inner_scores):
            scores -= scores.max(1, keepdims=True)
            np.exp(scores, out=scores)
            scores /= scores.sum(1, keepdims=True)
        return outer_scores, inner_scores

    def log10(self, tokens: Tokens, classes: np.ndarray) -> np.ndarray:
        """log10 P(class | history) of each token."""
        rows, out = tokens.features(classes, self.rows), np.empty(len(classes))
        for i in range(0, len(classes), BATCH):
            c = classes[i : i + BATCH]
            outer, inner = self.forward([r[i : i + BATCH] for r in rows], c)
            each = np.arange(len(c))
            out[i : i + BATCH] = np.log10(np.maximum(outer[each, c // GROUP].astype(np.float64) * inner[each, c % GROUP], 1e-30))
        return out

    def learn(self, tokens: Tokens, classes: np.ndarray, seen: np.ndarray) -> None:
        """Gradient steps over batches of tokens. seen: for each feature row and group, the squares of its batches' gradients so far.

        A step is RATE * gradient / sqrt(PRIOR + squares): less than RATE at first, and little for what was met a few times.
        """
        rows = tokens.features(classes, self.rows)
        small = self.rows * GROUPS <= 1 << 16  # 16 bits sort by radix
        for i in range(0, len(classes), BATCH):
            c, part = classes[i : i + BATCH], [r[i : i + BATCH] for r in rows]
            outer, inner = self.forward(part, c)
            each, group = np.arange(len(c)), c // GROUP
            outer[each, group] -= 1
            inner[each, c % GROUP] -= 1
            wrong = np.concatenate((outer, inner), 1)
            for row in part:
                keys = row * GROUPS + group
                order = np.argsort(keys.astype(np.uint16) if small else keys, kind="stable")
                keys = keys[order]
                first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
                keys = keys[first]
                sums = np.add.reduceat(wrong.take(order, 0), first, 0)
                seen[keys] += np.einsum("ij,ij->i", sums, sums)
                sums *= (RATE / np.sqrt(seen[keys] + PRIOR))[:, None]
                self.inner[keys] -= sums[:, GROUPS:]
                at = keys // GROUPS
                starts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
                self.outer[at[starts]] -= np.add.reduceat(sums[:, :GROUPS], starts, 0)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of words (cell -1) and of the neighbours of codes (their cell)."""
    found: Counter[bytes] = Counter()
    around = np.zeros((CODES, 2 * AROUND), np.int64)

    def rows(cells: np.ndarray, words: np.ndarray, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(words, pa.int64()), pa.array(codes, pa.int16()), pa.array(n, pa.int64())], names=["cell", "word", "code", "n"])

    def out() -> pa.RecordBatch:
        words = list(found)
        made = rows(np.full(len(words), -1), hashes_of(words).view(np.int64), codes_of(words), np.fromiter(found.values(), np.int64, len(words)))
        found.clear()
        return made

    for batch in batches:
        for _, texts in text_chunks(batch):
            words = []
            for text in texts:
                words += words_of(text)
                words.append(b"")
            found.update(words)
            around += around_of(codes_of(words))
            if len(found) > 400_000:
                yield out()
    if found:
        yield out()
    cells = np.flatnonzero(around)
    for i in range(0, len(cells), 1 << 16):
        part = cells[i : i + (1 << 16)]
        yield rows(part, np.zeros(len(part)), np.zeros(len(part)), around.reshape(-1)[part])


def count_words(frame: DataFrame, text_col: str = "text") -> DataFrame:
    """Training counts: of words (cell -1, 64-bit hash, code, n) and of the neighbours of codes (cell, 0, 0, n)."""
    source = only(frame, text_col).select(F.col(f"`{text_col}`").cast("string").alias("text"))
    return source.mapInArrow(tidied(_counts), "cell int, word long, code short, n long").groupBy("cell", "word").agg(F.min("code").alias("code"), F.sum("n").alias("n"))


def _gradients(shared):
    """Rows in order of shard and place; the changes that each shard's steps make to the broadcast weights."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, singles, order, forms, weights = shared.value
        model, seen, shard, learned = None, None, None, 0

        def change() -> Iterator[pa.RecordBatch]:
            if learned:
                made = (model.weights - weights).reshape(-1, PER_BLOCK * WIDTH)
                touched = np.flatnonzero(made.any(1))
                yield pa.RecordBatch.from_arrays([pa.array(touched, pa.int32()), pa.array(np.full(len(touched), learned), pa.int64()), pa.array([made[i].tobytes() for i in touched], pa.binary())], names=["block", "tokens", "change"])

        # a shard's texts are cut into batches by their own sizes, so that Arrow's batches change no step
        for number, texts in _shards(batches):
            if number != shard:
                yield from change()
                model, seen, shard, learned = Model(totals, weights), np.zeros(len(weights) * GROUPS, np.float32), number, 0
            tokens = Tokens(texts)
            model.learn(tokens, tokens.classes(singles, order, forms), seen)
            learned += len(tokens.hashes)
        yield from change()

    return run


def _shards(batches: Iterator[pa.RecordBatch], budget: int = 1 << 20) -> Iterator[tuple[int, list[str]]]:
    """Shard numbers with texts of about `budget` characters, or one longer text."""
    shard, held, size = None, [], 0
    for batch in batches:
        for part, texts in text_chunks(batch, budget=budget):
            for number, text in zip(part.column("shard").to_pylist(), texts):
                if held and (number != shard or size + len(text) > budget):
                    yield shard, held
                    held, size = [], 0
                shard = number
                held.append(text)
                size += len(text)
    if held:
        yield shard, held


def _averaged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[int, list] = {}
    for batch in batches:
        for block, tokens, change in zip(*[c.to_pylist() for c in batch.columns]):
            held = sums.setdefault(block, [0, 0.0])
            held[0] += tokens
            held[1] = held[1] + tokens * np.frombuffer(change, np.float32).astype(np.float64)
    for block, (tokens, change) in sums.items():
        yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([(change / tokens).astype(np.float32).tobytes()], pa.binary())], names=["block", "change"])


class Trained:
    """What scoring needs: the counts, the frequent words' part of them, totals, and the model's arrays."""

    def __init__(self, frame: DataFrame, text_col: str = "text", id_col: str = "doc_id", rounds: int = ROUNDS, head: int = HEAD, shard: int = SHARD):
        spark, frame = frame.sparkSession, only(frame, id_col, text_col)
        self.settled = settle(count_words(frame, text_col), "counts")
        self.counts = self.settled.where("cell < 0").select("word", "code", "n")
        around = np.zeros(CODES * 2 * AROUND, np.int64)
        cells = self.settled.where("cell >= 0").select("cell", "n").toArrow()  # CODES * 2 * AROUND rows at most
        around[cells.column("cell").to_numpy()] = cells.column("n").to_numpy()
        self.forms = forms_by_neighbours(around.reshape(CODES, 2 * AROUND))
        by_count = self.counts.groupBy("n").agg(F.count(F.lit(1)).alias("words"))  # as many rows as there are different counts
        # the least count that at most `head` words reach: bins of a 64th of a power of two, since different counts may be many
        level = F.floor(F.log2("n") * 64)
        bins = sorted(by_count.withColumn("bin", level).groupBy("bin").agg(F.sum("words").alias("words"), F.sum(F.col("n") * F.col("words")).alias("tokens")).collect(), reverse=True)
        self.tokens, self.distinct = sum(r.tokens for r in bins), sum(r.words for r in bins)
        least, words = None, 0
        for r in bins:
            words += r.words
            if words > head:
                break
            least = r.bin
        frequent = self.counts.where(level >= least) if least is not None else self.counts.limit(0)
        top = frequent.toArrow()
        keys, n = (top.column(c).to_numpy() for c in ("word", "n"))
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        self.keys, self.n = keys[order], n[order]
        # the words that are classes do not depend on the head; hashes are ordered as unsigned numbers
        words = self.counts.where(F.col("word") != END_KEY)
        leading = words.orderBy(F.desc("n"), F.col("word").bitwiseXOR(F.lit(-(2**63)))).limit(SINGLES - 2).toArrow()
        keys, codes, n = (leading.column(c).to_numpy() for c in ("word", "code", "n"))
        keys = keys.view(np.uint64)
        singles = np.concatenate((np.array([END], np.uint64), keys))
        sort = np.argsort(singles)
        self.singles, self.single_classes = singles[sort], sort.astype(np.int64)
        totals, distinct = np.zeros(CLASSES, np.int64), np.zeros(CLASSES, np.int64)
        once = twice = 0
        times = [F.sum((F.col("n") == i).cast("long")).alias(name) for i, name in ((1, "once"), (2, "twice"))]
        for r in words.groupBy("code").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("words"), *times).collect():  # CODES rows
            at = SINGLES + self.forms[r.code]
            totals[at] += r.n
            distinct[at] += r.words
            once, twice = once + r.once, twice + r.twice
        np.subtract.at(totals, SINGLES + self.forms[codes], n)
        np.subtract.at(distinct, SINGLES + self.forms[codes], 1)
        once, twice = once - int((n == 1).sum()), twice - int((n == 2).sum())
        ends = self.counts.where(F.col("word") == END_KEY).first()
        totals[0] = ends.n if ends else 0
        totals[1 : len(keys) + 1] = n
        #: What is taken off each count, and the logarithms of each form's tokens and of its unseen event's part.
        self.discount = (once + 0.5) / (once + 2 * twice + 1)
        self.norm = np.concatenate((np.zeros(SINGLES), np.log10(totals[SINGLES:] + 1.0)))
        self.unseen = np.log10(self.discount * distinct[SINGLES:] + 1.0)
        rows = ROWS << max(0, (self.tokens.bit_length() - 26) // 4)
        weights = np.zeros((rows, WIDTH), np.float32)
        own_tokens = self.tokens / max(1, rounds)
        shards = max(round(own_tokens / (shard * (rows // ROWS))), min(FEW, math.ceil(own_tokens * 8 / shard)), 1)
        text = frame[f"`{text_col}`"].cast("string")
        source = frame.select(F.xxhash64(frame[f"`{id_col}`"], text).alias("place"), text.alias("text"))
        source = source.select(F.pmod("place", F.lit(rounds)).alias("round"), F.pmod(F.xxhash64("place"), F.lit(shards)).cast("int").alias("shard"), "place", "text")
        for r in range(rounds):
            shared = spark.sparkContext.broadcast((totals, self.singles, self.single_classes, self.forms, weights))
            own = source.where(F.col("round") == r).select("shard", "place", "text").repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "place", "text")
            changes = own.select("shard", "text").mapInArrow(tidied(_gradients(shared)), "block int, tokens long, change binary").repartition("block").mapInArrow(tidied(_averaged), "block int, change binary")
            weights = weights.copy()
            for block, change in changes.toLocalIterator():  # rows / PER_BLOCK rows of fixed size
                weights[block * PER_BLOCK : (block + 1) * PER_BLOCK] += np.frombuffer(change, np.float32).reshape(PER_BLOCK, WIDTH)
        self.totals, self.weights = totals, weights


RARE = pa.struct([("word", pa.int64()), ("form", pa.int8()), ("times", pa.int32())])


def _scores(shared):
    schema = pa.schema([("id", pa.int64()), ("text_key", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("logs", pa.float64()), ("model", pa.float64()), ("rare", pa.list_(RARE))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals, singles, order, forms, weights, keys, n, norm, discount = shared.value
        model, logs, shares = Model(totals, weights), np.log10(n + 1.0), np.log10(n - discount)
        for batch in batches:
            for part, texts in text_chunks(batch, budget=1 << 20):
                tokens = Tokens(texts)
                owner = np.repeat(np.arange(len(texts)), tokens.lengths)
                classes = tokens.classes(singles, order, forms)
                value = model.log10(tokens, classes) - norm[classes]
                at = np.minimum(np.searchsorted(keys, tokens.hashes), max(0, len(keys) - 1))
                known = keys[at] == tokens.hashes if len(keys) else np.zeros(len(at), bool)
                shared_ones = np.flatnonzero(known & (classes >= SINGLES))
                value[shared_ones] += shares[at[shared_ones]]
                rare, rare_form, rare_owner = tokens.hashes[~known].view(np.int64), classes[~known], owner[~known]
                sort = np.lexsort((rare, rare_owner))
                rare, rare_form, rare_owner = rare[sort], rare_form[sort], rare_owner[sort]
                new = np.flatnonzero(np.concatenate(([True], (rare[1:] != rare[:-1]) | (rare_owner[1:] != rare_owner[:-1])))) if len(rare) else np.zeros(0, np.int64)
                offsets = pa.array(np.searchsorted(rare_owner[new], np.arange(len(texts) + 1)).astype(np.int32))
                # forms from 1; a single word has 0
                fields = [pa.array(rare[new], pa.int64()), pa.array(np.maximum(rare_form[new] - SINGLES + 1, 0), pa.int8()), pa.array(np.diff(np.append(new, len(rare))), pa.int32())]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("id"),
                        part.column("text_key"),
                        pa.array(tokens.lengths),
                        pa.array(np.bincount(owner[known], minlength=len(texts)).astype(np.int64)),
                        pa.array(np.bincount(owner[known], logs[at[known]], len(texts)) if len(keys) else np.zeros(len(texts))),
                        pa.array(np.bincount(owner, value, len(texts))),
                        pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(fields, fields=list(RARE))),
                    ],
                    schema=schema,
                )

    return run


def score(frame: DataFrame, trained: Trained, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score (the model), both log10."""
    spark, t, frame = frame.sparkSession, trained, only(frame, id_col, text_col)
    shared = spark.sparkContext.broadcast((t.totals, t.singles, t.single_classes, t.forms, t.weights, t.keys, t.n, t.norm, t.discount))
    text = F.coalesce(frame[f"`{text_col}`"].cast("string"), F.lit(""))
    source = frame.select(frame[f"`{id_col}`"].cast("long").alias("id"), F.xxhash64(text).alias("text_key"), text.alias("text"))
    schema = "id long, text_key long, n_tokens long, known long, logs double, model double, rare array<struct<word:long,form:byte,times:int>>"
    rows = settle(source.mapInArrow(tidied(_scores(shared)), schema), "scores")
    rare = rows.select(F.col("id").alias("i"), F.col("text_key").alias("k"), F.posexplode("rare").alias("at", "token")).select("i", "k", "at", "token.*")
    found = rare.join(t.counts.select("word", "n"), "word", "left")
    unseen = F.element_at(F.array(*[F.lit(float(x)) for x in t.unseen]), F.greatest(F.col("form").cast("int"), F.lit(1)))
    share = F.when(F.col("form") == 0, 0.0).when(F.col("n").isNotNull(), F.log10(F.col("n") - F.lit(float(t.discount)))).otherwise(unseen)
    # rows that repeat id and text are summed together: `copies` of them
    sums = found.groupBy("i", "k").agg(
        F.sum(F.when(F.col("n").isNotNull(), F.col("times")).otherwise(0)).alias("seen"),
        F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 1.0)).alias("more"),
        F.sum(F.col("times") * share).alias("shares"),
        F.sum((F.col("at") == 0).cast("long")).alias("copies"),
    )
    joined = rows.join(sums, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_key") == F.col("k")), "left")
    each = lambda name: F.coalesce(F.col(name) / F.col("copies"), F.lit(0.0))
    base = F.log10(F.lit(float(t.tokens + t.distinct + 1)))
    return joined.select(
        F.col("id").alias(id_col),
        "n_tokens",
        (F.col("known") + each("seen").cast("long")).alias("n_known"),
        F.lit(t.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + each("more") - F.col("n_tokens") * base).alias("base_score"),
        (F.col("model") + each("shares")).alias("score"),
    )
