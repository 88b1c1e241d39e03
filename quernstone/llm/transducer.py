"""Token counts by a tokenizer compiled to deterministic finite-state transducers.

Two machines, both deterministic:

* The splitter reads character classes and has eight states. A stream is cut
  into chunks; each chunk's map from entry state to exit state is found for all
  states at once, the maps are composed by a parallel prefix scan, and the
  chunks are then read from their true entry states. Where tokens begin follows
  from the states alone.
* The word transducer reads a word's bytes (the last one as a symbol of its
  own, since the vocabulary marks word ends) and emits on each transition the
  change of the token count. After a prefix of a word its last token is the one
  vocabulary entry that ends there and may follow the last token before it. A
  state therefore holds, for every start from which a vocabulary entry may
  still run on, the place in the vocabulary trie, the token before that start
  and the count relative to now. States are compiled when first reached; full
  tables start afresh with the states in use, which changes no count. Words
  advance together, a byte at a time. Long words are cut into chunks that advance
  together too, each from the state that a short run-up finds; each chunk then
  maps one entry state to an exit state and a count. A prefix scan over the
  chunks says how far exits and entries agree; where they do not, the chunk is
  mapped again from the state that it is really entered in.

Defined results: a null text is the empty text, of 0 tokens; special tokens'
literals count one each, as the library does by default; repeated rows are
counted one by one; columns other than those named are not read. A vocabulary
whose normaliser, pre-tokenizer or model settings are not those written here is
refused.
"""

from __future__ import annotations

import json
import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from quernstone.llm.bpe import byte_alphabet
from quernstone.llm.common import only, read_vocabulary, text_chunks, tidied

#: Character classes: space, letter, number, other, apostrophe, and the letters that contractions turn on.
SPACE, LETTER, NUMBER, OTHER, TICK, STMD, R, V, L, E = range(10)
#: Splitter states: between tokens, in letters, after a number, in others, after a lone apostrophe, then after 'r or 'v, after 'l, after a contraction.
GAP, WORD, DIGIT, OTHERS, LONE, RV, EL, SHORTENED = range(8)
#: Most states and most table cells at a time, and the words that advance together; BLOCK states and as many new ones must fit.
STATES, CELLS, BLOCK = 1 << 17, 1 << 24, 1 << 15
CHUNK = 128
#: Bytes of a word from which on it is cut, of its chunks, and of the run-up before each.
LONG, CUT, RUN_UP = 2048, 512, 64
#: The parts of the vocabulary file that the machines are written for.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
#: Lower cases that the library knows and Python's Unicode version doesn't yet.
NEWER = (("\ua7cb", "\u0264"), ("\ua7dc", "\u019b"))


def splitter() -> np.ndarray:
    """next state by class * 8 + state."""
    table = np.zeros((10, 8), np.uint8)
    table[NUMBER] = DIGIT
    table[OTHER] = OTHERS
    table[TICK] = LONE
    table[TICK, [OTHERS, LONE]] = OTHERS
    for letter in (LETTER, STMD, R, V, L, E):
        table[letter] = WORD
    table[STMD, LONE] = SHORTENED
    table[[R, V], LONE] = RV
    table[L, LONE] = EL
    table[E, RV] = SHORTENED
    table[L, EL] = SHORTENED
    return table.reshape(-1)


def character_classes() -> np.ndarray:
    import regex

    every = "".join(map(chr, range(0xD800))) + " " * 0x800 + "".join(map(chr, range(0xE000, 0x110000)))
    classes = np.full(0x110000, OTHER, np.uint8)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for found in regex.finditer(pattern, every):
            classes[found.start() : found.end()] = kind
    for kind, chars in ((TICK, "'"), (STMD, "stmd"), (R, "r"), (V, "v"), (L, "l"), (E, "e")):
        classes[[ord(c) for c in chars]] = kind
    return classes


class Splitter:
    def __init__(self):
        self.table, self.classes = splitter(), character_classes()

    def states(self, classes: np.ndarray, chunk: int = CHUNK) -> np.ndarray:
        """The state after each character, from the chunks' state maps and their prefix composition."""
        n = len(classes)
        rows = -(-n // chunk)
        cells = np.full(rows * chunk, SPACE, np.uint8)
        cells[:n] = classes
        cells = np.ascontiguousarray(cells.reshape(rows, chunk).T) * np.uint8(8)
        maps = np.repeat(np.arange(8, dtype=np.uint8)[:, None], rows, 1)
        for column in cells:
            maps = self.table.take(maps + column)
        step = 1
        while step < rows:  # after each round a map covers twice as many chunks
            maps[:, step:] = np.take_along_axis(maps[:, step:], maps[:, :-step], 0)
            step *= 2
        state = np.concatenate(([np.uint8(GAP)], maps[GAP, :-1]))
        out = np.empty_like(cells)
        for j, column in enumerate(cells):
            state = out[j] = self.table.take(state + column)
        return out.T.reshape(-1)[:n]

    def spans(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where tokens start and end, in characters."""
        if not len(points):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        state = self.states(self.classes[points])
        before = np.concatenate(([np.uint8(GAP)], state[:-1]))
        then = np.concatenate((state[1:], [np.uint8(GAP)]))
        start = (state == DIGIT) | (state == LONE) | ((state == OTHERS) & (before != OTHERS) & (before != LONE))
        start |= (state == WORD) & (before != WORD) & (before != RV) & (before != EL)
        start |= ((state == RV) | (state == EL)) & (then != SHORTENED)
        cut = np.flatnonzero(start | (state == GAP))
        ends = np.append(cut[1:], len(points))
        keep = start[cut]
        return cut[keep], ends[keep]


#: The state before a word.
INITIAL = ((0, -1, 0),)


class WordTransducer:
    """Counts of tokens in words, for a byte-level BPE vocabulary whose words' last parts carry a suffix."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        check_model(model)
        vocab, suffix, alphabet = model["vocab"], model["end_of_word_suffix"] or "", byte_alphabet()
        self.added = [x["content"] for x in spec["added_tokens"]]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, (list, tuple)) else pair.split(" ")
            self.ranks[vocab[a], vocab[b]] = rank, vocab[a.removesuffix(suffix) + b if suffix else a + b]

        def symbols(token: str) -> list[int]:
            ends = bool(suffix) and token.endswith(suffix)
            out = [alphabet[c] for c in (token[: -len(suffix)] if ends else token)]
            if ends:
                out[-1] += 256
            return out

        self.symbols = {i: symbols(token) for token, i in vocab.items() if token not in self.added}
        self.single = {parts[0]: i for i, parts in self.symbols.items() if len(parts) == 1}
        if not suffix:
            self.single |= {b + 256: i for b, i in self.single.items()}
        self.child: dict[int, int] = {}
        self.token: list[int] = [-1]
        for i, parts in self.symbols.items():
            if self.merged([self.single[x] for x in parts]) != [i]:
                continue  # no text makes it
            for ending in [parts] if suffix else [parts, [*parts[:-1], parts[-1] + 256]]:
                node = 0
                for x in ending:
                    key = node << 9 | x
                    if key not in self.child:
                        self.child[key] = len(self.token)
                        self.token.append(-1)
                    node = self.child[key]
                self.token[node] = i
        self.restart()

    def restart(self, keep: list[tuple] = [INITIAL], width: int = 64) -> None:
        """Empty tables that hold the given states; the first of them is the state before a word."""
        self.follows: dict[tuple[int, int], bool] = {}
        self.held, self.number = list(keep), {state: i for i, state in enumerate(keep)}
        self.width, self.room = width, min(STATES, CELLS // width)
        self.column, self.bytes = np.full(256, -1, np.int64), []
        self.next = np.full(self.room * width, -1, np.int32)
        self.emit = np.zeros(self.room * width, np.int8)
        self.last = np.full(self.room * width, 127, np.int8)

    def columns(self, data: np.ndarray) -> None:
        """Gives each byte value of the data a column; with too few columns the tables start afresh with more."""
        seen = np.flatnonzero(np.bincount(data, minlength=256)).tolist()
        if len(set(seen) | set(self.bytes)) > self.width:
            width = self.width
            while width < len(set(seen) | set(self.bytes)):
                width *= 2
            seen = [*self.bytes, *seen]
            self.restart(width=width)
        for byte in seen:
            if self.column[byte] < 0:
                self.column[byte] = len(self.bytes)
                self.bytes.append(byte)

    def merged(self, parts: list[int]) -> list[int]:
        """BPE from its definition: the pair of least rank, leftmost first."""
        ranks = self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                found = ranks.get((parts[i], parts[i + 1]))
                if found is not None and (best is None or found[0] < best[0]):
                    best, at = found, i
            if best is None:
                break
            parts = [*parts[:at], best[1], *parts[at + 2 :]]
        return parts

    def may_follow(self, before: int, token: int) -> bool:
        if before < 0:
            return True
        key = before, token
        if key not in self.follows:
            self.follows[key] = self.merged([self.single[x] for x in self.symbols[before] + self.symbols[token]]) == [before, token]
        return self.follows[key]

    def step(self, state: tuple, symbol: int) -> tuple[tuple, int]:
        """The state after one more symbol and the change of the count."""
        kept, last, count = [], -1, 0
        for node, before, at in state:  # the longest first
            node = self.child.get(node << 9 | symbol)
            if node is None:
                continue
            kept.append((node, before, at))
            token = self.token[node]
            if last < 0 and token >= 0 and self.may_follow(before, token):
                last, count = token, at + 1
        return (*[(node, before, at - count) for node, before, at in kept], (0, last, 0)), count

    def compile(self, flat: np.ndarray, final: bool) -> None:
        for key in flat.tolist():
            state, column = divmod(key, self.width)
            after, count = self.step(self.held[state], self.bytes[column] + 256 * final)
            if final:
                self.last[key] = count
                continue
            number = self.number.get(after)
            if number is None:
                number = self.number[after] = len(self.held)
                self.held.append(after)
            self.next[key], self.emit[key] = number, count

    def counts(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Tokens of each word data[start:end]."""
        self.columns(data)
        cells = self.column[data]
        out = np.zeros(len(starts), np.int64)
        short = np.flatnonzero(ends - starts <= LONG)
        for i in range(0, len(short), BLOCK):
            part = short[i : i + BLOCK]
            out[part] = self.block(cells, starts[part], ends[part])
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            out[i] = self.long(cells, int(starts[i]), int(ends[i]))
        return out

    def long(self, cells: np.ndarray, start: int, end: int) -> int:
        """Tokens of one long word, from its chunks' maps."""
        begins = np.arange(start, end - 1, CUT)
        stops = np.append(begins[1:], end)
        n = len(begins)
        entries = np.empty(n, object)
        entries[0] = INITIAL
        if n > 1:
            entries[1:] = self.through(cells, begins[1:] - RUN_UP, begins[1:], [INITIAL] * (n - 1))[0]
        exits, counts, todo = np.empty(n, object), np.zeros(n, np.int64), np.arange(n)
        while len(todo):
            inner = todo[todo < n - 1]
            if len(inner):
                exits[inner], counts[inner] = self.through(cells, begins[inner], stops[inner], list(entries[inner]))
            if todo[-1] == n - 1:
                counts[-1] = self.block(cells, begins[-1:], stops[-1:], [entries[-1]])[0]
            wrong = np.fromiter((exits[i - 1] != entries[i] for i in range(1, n)), bool, n - 1)
            todo = np.flatnonzero(wrong) + 1
            entries[todo] = exits[todo - 1]
        return int(counts.sum())

    def through(self, cells: np.ndarray, starts: np.ndarray, ends: np.ndarray, entries: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """The states after stretches data[start:end] that no word ends in, entered in these states, and the counts' changes."""
        exits, counts = np.empty(len(starts), object), np.zeros(len(starts), np.int64)
        for i in range(0, len(starts), BLOCK):
            part = slice(i, i + BLOCK)
            counts[part] = self.block(cells, starts[part], ends[part], entries[part], exits[part])
        return exits, counts

    def numbers(self, states: list[tuple]) -> np.ndarray:
        """The numbers of states; in full tables all others are given up."""
        fresh = [s for s in dict.fromkeys(states) if s not in self.number]
        if len(self.held) + len(fresh) > self.room:
            column_of, bytes_ = self.column, self.bytes
            self.restart(list(dict.fromkeys([INITIAL, *states])), self.width)
            self.column, self.bytes = column_of, bytes_
            fresh = []
        for s in fresh:
            self.number[s] = len(self.held)
            self.held.append(s)
        return np.fromiter(map(self.number.__getitem__, states), np.int64, len(states))

    def block(self, cells: np.ndarray, starts: np.ndarray, ends: np.ndarray, entries: list[tuple] | None = None, exits: np.ndarray | None = None) -> np.ndarray:
        """All words advance one byte at a time, the longer ones first in order, so that those which go on are a prefix.

        entries: the states to begin in. exits: to be filled with the states after the last bytes, which then end no word.
        """
        lengths = ends - starts
        order = np.argsort(-lengths, kind="stable")
        starts, lengths = starts[order], -lengths[order]
        state, count = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        if entries is not None:
            state = self.numbers([entries[i] for i in order.tolist()])
        if exits is not None:
            lengths = lengths - 1  # one more step, in which no word ends
        now, k = len(order), 0
        while now:
            more = int(np.searchsorted(lengths, -(k + 1), side="left"))
            if exits is not None and more < now:
                for i in range(more, now):
                    exits[order[i]] = self.held[state[i]]
                now, state = more, state[:more]
                if not now:
                    break
            column = cells[starts[:now] + k]
            flat = state * self.width + column
            ending, going = flat[more:], flat[:more]
            self.compile(np.unique(ending[self.last[ending] == 127]), True)
            count[more:now] += self.last[ending]
            missing = np.unique(going[self.next[going] < 0])
            if len(self.held) + len(missing) > self.room:
                active, place = np.unique(np.append(0, state[:more]), return_inverse=True)
                column_of, bytes_ = self.column, self.bytes
                self.restart([self.held[i] for i in active.tolist()], self.width)
                self.column, self.bytes = column_of, bytes_
                going = place[1:] * self.width + column[:more]
                missing = np.unique(going)
            self.compile(missing, False)
            count[:more] += self.emit[going]
            state, now, k = self.next[going].astype(np.int64), more, k + 1
        out = np.empty_like(count)
        out[order] = count
        return out


def check_model(model: dict) -> None:
    """Refuses settings of a BPE model that change what it makes and are not handled."""
    unlike = {name: model.get(name) for name in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(name)}
    if model.get("type") != "BPE" or unlike:
        raise ValueError(f"not the BPE model that is handled: {model.get('type')} {unlike}")


def check_added(added: list[dict]) -> None:
    """Refuses added tokens that take blanks along, stand for whole words only, or are looked for in normalised text."""
    for token in added:
        if token["single_word"] or token["lstrip"] or token["rstrip"] or token["normalized"]:
            raise ValueError(f"not an added token that is handled: {token}")


class TokenCounter:
    """The number of tokens of texts. Normalisation is NFC, then white space to one space, then lower case."""

    def __init__(self, data: bytes):
        import regex

        spec = json.loads(data)
        split, after = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}, {}])[:2]
        if spec["normalizer"] != NORMALIZER or split.get("pattern") != {"Regex": PATTERN} or split.get("behavior") != "Removed" or not split.get("invert"):
            raise ValueError("not the normaliser and split that are handled")
        if after.get("type") != "ByteLevel" or after["add_prefix_space"] or after["use_regex"] or len(spec["pre_tokenizer"]["pretokenizers"]) != 2:
            raise ValueError("not the byte level that is handled")
        check_added(spec["added_tokens"])
        self.words, self.splitter = WordTransducer(data), Splitter()
        self.specials = regex.compile("|".join(map(regex.escape, sorted(self.words.added, key=len, reverse=True)))) if self.words.added else None

    @staticmethod
    def normal(text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # letter by letter, no final sigma
        for upper, lower in NEWER:
            text = text.replace(upper, lower)
        return text.lower()

    def count_all(self, texts: list[str]) -> np.ndarray:
        added, parts = np.zeros(len(texts), np.int64), []
        for i, text in enumerate(texts):
            if any(token in text for token in self.words.added):
                pieces = self.specials.split(text)
                added[i] = len(pieces) - 1
                parts.append(" ".join(map(self.normal, pieces)))
            else:
                parts.append(self.normal(text))
        sizes = np.array([len(x) + 1 for x in parts], np.int64)
        whole = " ".join(parts) + " "
        points = np.frombuffer(whole.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts, ends = self.splitter.spans(points)
        data = np.frombuffer(whole.encode("utf-8", "surrogatepass"), np.uint8)
        document = np.searchsorted(np.cumsum(sizes), starts, side="right")
        if len(data) != len(points):
            places = np.concatenate(([0], np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000))))
            starts, ends = places[starts], places[ends]
        return added + np.bincount(document, self.words.counts(data, starts, ends), len(texts)).astype(np.int64)


_counters: dict[int, TokenCounter] = {}


def counter_of(data: bytes) -> TokenCounter:
    """One counter for each vocabulary and Python worker."""
    key = zlib.crc32(data)
    if key not in _counters:
        _counters[key] = TokenCounter(data)
    return _counters[key]


def count_tokens(frame: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each row's id, `n_bytes` of its text in UTF-8 and `n_tokens`."""
    frame = only(frame, id_col, text_col)
    data = frame.sparkSession.sparkContext.broadcast(read_vocabulary(vocabulary))
    source = frame.select(frame[f"`{id_col}`"].alias("id"), frame[f"`{text_col}`"].cast("string").alias("text"))
    out = T.StructType([T.StructField(id_col, frame.schema[id_col].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc

        counter = counter_of(data.value)
        for batch in batches:
            for part, texts in text_chunks(batch):
                sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("id"), sizes, pa.array(counter.count_all(texts), pa.int64())], names=[id_col, "n_bytes", "n_tokens"])

    return source.mapInArrow(tidied(run), out)
