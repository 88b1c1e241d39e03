"""Fill-in-the-middle transformation by ropes.

A rope is a binary tree whose leaves hold pieces of a text; leaves and nodes cache
how many units and code points lie below them. A unit is a run of blanks with the
word after it, or the blanks that end a text. A text is split at two unit ranks by
a walk down the tree, its three parts are concatenated in another order with
sentinels between them, and no part is copied before the output is written. The
way back splits the output's tree at the code points where the sentinels stand.

Defined results: a null text is an empty one; empty texts, and texts that contain
a sentinel, stay plain; a null id draws as an empty one; rows that repeat an id
draw alike, each by its own text; an empty table stays empty; columns other than
those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quernstone.llm.common import BLANKS, only, text_chunks, tidied

PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Before the prefix, the suffix and the middle.
SENTINELS = ("<P>", "<S>", "<M>")
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: The end of a word that blanks follow: where a text may be cut into leaves.
WORD_END = re.compile(r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])")
#: Code points of a leaf at least; a leaf ends with the first word that ends after them.
LEAF = 2048


@dataclass(slots=True)
class Leaf:
    text: str
    units: int
    chars: int


@dataclass(slots=True)
class Node:
    left: Rope
    right: Rope
    units: int
    chars: int


Rope = Leaf | Node
EMPTY = Leaf("", 0, 0)


def count_units(text: str) -> int:
    """Words, and one more where blanks end the text."""
    return len(text.encode("utf-8", "surrogatepass").split()) + (text[-1:] in set(BLANKS.decode()))


def leaf(text: str) -> Leaf:
    return Leaf(text, count_units(text), len(text))


def joined(*ropes: Rope) -> Rope:
    """The ropes one after the other; no text is copied."""
    return reduce(lambda a, b: Node(a, b, a.units + b.units, a.chars + b.chars) if a.chars and b.chars else a if a.chars else b, ropes, EMPTY)


def rope(text: str, size: int = LEAF) -> Rope:
    """A balanced rope, whose leaves end where units do."""
    level, start = [], 0
    while start < len(text):
        end = WORD_END.search(text, start + size)
        stop = end.start() if end else len(text)
        level.append(leaf(text[start:stop]))
        start = stop
    while len(level) > 1:
        level = [joined(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return level[0] if level else EMPTY


def split(tree: Rope, rank: int, by: str = "units") -> tuple[Rope, Rope]:
    """The first `rank` units (or, by "chars", code points) and the rest: one walk down; what lies aside of it is shared."""
    if rank <= 0:
        return EMPTY, tree
    if rank >= getattr(tree, by):
        return tree, EMPTY
    if isinstance(tree, Node):
        here = getattr(tree.left, by)
        if rank <= here:
            a, b = split(tree.left, rank, by)
            return a, joined(b, tree.right)
        a, b = split(tree.right, rank - here, by)
        return joined(tree.left, a), b
    if by == "chars":
        return leaf(tree.text[:rank]), leaf(tree.text[rank:])
    ends = UNIT.finditer(tree.text)
    for _ in range(rank - 1):
        next(ends)
    at = next(ends).end()
    return Leaf(tree.text[:at], rank, at), Leaf(tree.text[at:], tree.units - rank, tree.chars - at)


def written(tree: Rope) -> str:
    pieces, left = [], [tree]
    while left:
        top = left.pop()
        if isinstance(top, Leaf):
            pieces.append(top.text)
        else:
            left += (top.right, top.left)
    return "".join(pieces)


def drawn(key: str, seed: int) -> list[int]:
    """Four numbers of 32 bits for a document."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearranged(text: str, draws: Sequence[int], rate: int = 50, spm_rate: int = 80, sentinels: Sequence[str] = SENTINELS) -> tuple[int, str, int | None, int | None, str]:
    """Units, form, code points of prefix and middle (None if plain), output."""
    tree = rope(text)
    n = tree.units
    if not text or any(s in text for s in sentinels) or draws[2] % 100 >= rate:
        return n, PLAIN, None, None, text
    low, high = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    head, suffix = split(tree, high)
    prefix, middle = split(head, low)
    p, s, m = (Leaf(x, 0, len(x)) for x in sentinels)
    form = SPM if draws[3] % 100 < spm_rate else PSM
    parts = (s, suffix, p, prefix, m, middle) if form == SPM else (p, prefix, s, suffix, m, middle)
    return n, form, prefix.chars, middle.chars, written(joined(*parts))


def rebuilt(output: str, form: str, sentinels: Sequence[str] = SENTINELS) -> str:
    """The text that an output was made of. No part of it holds a sentinel, and no sentinel begins within another, so each stands once."""
    if form == PLAIN:
        return output
    order = (1, 0, 2) if form == SPM else (0, 1, 2)
    rest, parts, passed = rope(output), {}, 0
    starts = [output.index(sentinels[i]) for i in order]
    for i, start, end in zip(order, starts, [*starts[1:], len(output)]):
        piece, rest = split(rest, end - passed, "chars")
        parts[i] = split(piece, len(sentinels[i]), "chars")[1]
        passed = end
    return written(joined(parts[0], parts[2], parts[1]))


def _checked(sentinels: Sequence[str]) -> tuple[str, str, str]:
    """Three sentinels of which none can begin within another, or within a text and end in one: each has its first character nowhere else."""
    if len(set(sentinels)) != 3 or not all(sentinels) or any(s[0] in t[1:] for s in sentinels for t in sentinels) or any(s != t and t.startswith(s) for s in sentinels for t in sentinels):
        raise ValueError(f"not three sentinels that can be told apart: {sentinels!r}")
    return tuple(sentinels)


def transform(frame: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 42, rate: int = 50, spm_rate: int = 80, sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """A row for each input row: id, n (units), form, prefix_chars, middle_chars, output.

    Of a hundred documents about `rate` are rearranged, of a hundred of these
    `spm_rate` with the suffix first; seed and id decide which, and where the
    text is cut. One pass without a shuffle.
    """
    marks = _checked(sentinels)
    frame = only(frame, id_col, text_col)
    source = frame.select(F.col(f"`{id_col}`").cast("string").alias("key"), F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    kind = source.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                made = [rearranged(t, drawn(k or "", seed), rate, spm_rate, marks) for k, t in zip(part.column("key").to_pylist(), texts)]
                n, form, prefix, middle, output = zip(*made)
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), pa.array(n, pa.int64()), pa.array(form), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())],
                    names=["id", "n", "form", "prefix_chars", "middle_chars", "output"],
                )

    made = source.mapInArrow(tidied(run), f"id {kind.simpleString()}, n long, form string, prefix_chars long, middle_chars long, output string")
    return made.withColumnRenamed("id", id_col)


def restore(frame: DataFrame, output_col: str = "output", form_col: str = "form", sentinels: Sequence[str] = SENTINELS) -> DataFrame:
    """The frame with a column `restored`: the text that each output was made of."""
    marks = _checked(sentinels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, outputs in text_chunks(batch, output_col):
                texts = [rebuilt(o, f, marks) for o, f in zip(outputs, part.column(form_col).to_pylist())]
                yield part.append_column("restored", pa.array(texts, pa.string()))

    return frame.mapInArrow(tidied(run), T.StructType([*frame.schema.fields, T.StructField("restored", T.StringType())]))


SQL = r"""
    WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
    u AS (SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS units,
        CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
    c AS (SELECT *, len(units) AS n, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS low, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS high,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
    p AS (SELECT doc_id, t, n, form, array_to_string(units[1:low], '') AS prefix, array_to_string(units[low + 1:high], '') AS middle, array_to_string(units[high + 1:], '') AS suffix FROM c)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
        sha256(CASE form WHEN 'plain' THEN t WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256 FROM p"""
