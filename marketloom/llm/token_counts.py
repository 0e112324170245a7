"""Token counts that follow edits: only what an edit touches is encoded again.

A document is cut into the tokenizer's pre-tokens, which are encoded one by one.
Runs of them are the leaves of a segment tree that holds the characters and the
tokens of every subtree, so the leaf at a place is found, and the sums above it
renewed, in steps as many as the tree is high. The name of an added token is a
piece of its own, and the text before it ends there. A pre-token so depends on the
text from its start on, to the second character after it, where a name may begin.
An edit therefore leaves alone whatever ends that far before it, the longest name
included, and everything from the first old leaf on that the new pre-tokens meet
again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import whole_row, with_results
from marketloom.llm.shipping import ship_code
from marketloom.llm.tokens import PRE_TOKENS, Encoder, encoder, vocabulary

LEAF = 64
CONTEXT = 2
REMEMBERED = 500_000
PIECES = regex.compile(PRE_TOKENS.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
EDITS = "array<struct<start:int,end:int,text:string>>"
TREE = "struct<leaves:int,chars:array<int>,tokens:array<int>>"


@dataclass
class Counter:
    """Tokens of single pre-tokens, remembered."""

    encode: Encoder
    known: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        names = sorted(self.encode.special, key=len, reverse=True)  # of two names at a place the longer one counts
        self.names = regex.compile("|".join(map(regex.escape, names))) if names else None
        self.context = CONTEXT + max(map(len, names), default=0)

    def spans(self, text: str) -> Iterator[tuple[int, int]]:
        """Where the pre-tokens of a text start and end, names of added tokens among them."""
        at = 0
        for name in self.names.finditer(text) if self.names and any(n in text for n in self.encode.special) else ():
            yield from ((at + m.start(), at + m.end()) for m in PIECES.finditer(text[at : name.start()]))
            yield name.span()
            at = name.end()
        rest = text[at:] if at else text
        yield from ((at + m.start(), at + m.end()) for m in PIECES.finditer(rest))

    def pieces(self, text: str) -> list[str]:
        if not any(name in text for name in self.encode.special):
            return PIECES.findall(text)
        return [text[a:b] for a, b in self.spans(text)]

    def counts(self, pieces: list[str]) -> list[int]:
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        for piece in set(pieces).difference(known):
            known[piece] = len(self.encode.ids(piece))
        return [known[piece] for piece in pieces]


class TokenTree:
    """Sums by subtree: node ``i`` has the children ``2 i`` and ``2 i + 1``; the leaves come last."""

    def __init__(self, leaves: int, chars: np.ndarray, tokens: np.ndarray) -> None:
        self.leaves, self.chars, self.tokens = leaves, chars, tokens

    @classmethod
    def of(cls, chars: Sequence[int], tokens: Sequence[int]) -> TokenTree:
        width = 1 << max(0, len(chars) - 1).bit_length()
        trees = []
        for values in (chars, tokens):
            tree = np.zeros(2 * width, np.int64)
            tree[width : width + len(values)] = values
            level = width
            while level > 1:
                tree[level // 2 : level] = tree[level : 2 * level].reshape(-1, 2).sum(1)
                level //= 2
            trees.append(tree)
        return cls(len(chars), *trees)

    @property
    def total(self) -> int:
        return int(self.tokens[1])

    def leaf_at(self, place: int) -> tuple[int, int]:
        """The leaf that holds a character, and where it starts; the last leaf for places behind the text."""
        node, start, width = 1, 0, len(self.chars) // 2
        while node < width:
            left = int(self.chars[2 * node])
            node *= 2
            if place >= start + left:
                node, start = node + 1, start + left
        leaf = node - width
        if leaf >= self.leaves:
            leaf = self.leaves - 1
            start = int(self.chars[1] - self.chars[width + leaf])
        return leaf, start

    def set_leaf(self, leaf: int, chars: int, tokens: int) -> None:
        node = len(self.chars) // 2 + leaf
        by_chars, by_tokens = chars - self.chars[node], tokens - self.tokens[node]
        while node:
            self.chars[node] += by_chars
            self.tokens[node] += by_tokens
            node //= 2

    def leaf_chars(self, leaf: int) -> int:
        return int(self.chars[len(self.chars) // 2 + leaf])

    def parts(self) -> tuple[list[int], list[int]]:
        width = len(self.chars) // 2
        return self.chars[width : width + self.leaves].tolist(), self.tokens[width : width + self.leaves].tolist()


def build(text: str, counter: Counter) -> TokenTree:
    pieces = counter.pieces(text)
    return TokenTree.of(*_leaves(pieces, counter.counts(pieces), -(-len(pieces) // LEAF)))


def _leaves(pieces: list[str], counts: list[int], n: int) -> tuple[list[int], list[int]]:
    """Characters and tokens of ``n`` leaves that share the pieces evenly; one empty leaf if there are none."""
    if not pieces:
        return [0] * max(1, n), [0] * max(1, n)
    edges = np.linspace(0, len(pieces), max(1, n) + 1).astype(int)
    sums = []
    for values in (list(map(len, pieces)), counts):
        total = np.append(0, np.cumsum(values))
        sums.append(np.diff(total[edges]).tolist())
    return sums[0], sums[1]


def apply_edits(text: str, tree: TokenTree, edits: Sequence[tuple[int, int, str]], counter: Counter) -> tuple[TokenTree, int]:
    """The tree of the edited text, and how many pre-tokens were encoded for it.

    ``edits`` are ``(start, end, replacement)`` in places of ``text``, by start and
    without overlap. Regions of leaves are worked off from the right, so places on
    the left stay as they are.
    """
    encoded = 0
    for first, last, inside in reversed(_regions(tree, edits, counter.context)):
        start, end = first[1], last[1] + tree.leaf_chars(last[0])
        pieces, leaf = [], last[0]
        new, at = [], start
        for a, b, replacement in inside:
            new += [text[at:a], replacement]
            at = b
        while True:
            changed = "".join([*new, text[at:end]])
            pieces, met = _cut(changed, text, end, counter)
            if met or leaf + 1 >= tree.leaves:
                break
            leaf += 1  # the last piece runs on: take the next leaf in
            end += tree.leaf_chars(leaf)
        encoded += len(pieces)
        tree = _renewed(tree, first[0], leaf, pieces, counter.counts(pieces))
        text = text[:start] + changed + text[end:]
    return tree, encoded


def _regions(tree: TokenTree, edits: Sequence[tuple[int, int, str]], context: int) -> list:
    """Edits by the leaves they touch; those whose leaves touch or follow on each other share a region."""
    regions: list = []
    for edit in edits:
        first = tree.leaf_at(max(0, edit[0] - context))
        last = tree.leaf_at(edit[1])
        if regions and first[0] <= regions[-1][1][0] + 1:
            regions[-1][1] = max(regions[-1][1], last)
            regions[-1][2].append(edit)
        else:
            regions.append([first, last, [edit]])
    return regions


def _cut(changed: str, text: str, end: int, counter: Counter) -> tuple[list[str], bool]:
    """Pre-tokens of ``changed`` as it stands before ``text[end:]``, and whether the last one ends with it."""
    reach = 256
    while True:
        context = changed + text[end : end + reach]
        whole = end + reach >= len(text)
        pieces, at = [], 0
        for start, stop in counter.spans(context):
            if start >= len(changed):
                break
            at = stop
            pieces.append(context[start:stop])
        if whole or at + counter.context <= len(context):
            break
        reach *= 4  # a piece as long as the context
    return pieces, at == len(changed)


def _renewed(tree: TokenTree, first: int, last: int, pieces: list[str], counts: list[int]) -> TokenTree:
    """Put new pieces into the leaves from ``first`` to ``last``; a tree whose leaves would grow too far gets more."""
    room = last - first + 1
    needed = -(-len(pieces) // LEAF)
    if needed <= 4 * room:
        for place, (chars, tokens) in enumerate(zip(*_leaves(pieces, counts, room), strict=True)):
            tree.set_leaf(first + place, chars, tokens)
        return tree
    parts = tree.parts()
    new = _leaves(pieces, counts, needed)
    return TokenTree.of(*[old[:first] + list(own) + old[last + 1 :] for old, own in zip(parts, new, strict=True)])


def token_trees(df: DataFrame, tokenizer: str, text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Every row of ``df`` with ``tree``, ``n_tokens``, and the text under ``tree_text``.

    NULL counts as empty, which has no tokens. The name of an added token in a
    text is that token, as the tokenizer takes it. Repeated rows have a tree each,
    and a text of any length has one, a leaf for each ``LEAF`` pieces. ``carry`` names the input columns to
    return (all by default); a result replaces an input column of its name. An
    empty table gives no rows.
    """
    names = df.columns if carry is None else carry
    rows = df.select(whole_row(df, names).alias("row"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def trees(batch: pa.RecordBatch, counter: Counter) -> list[tuple[TokenTree, int]]:
        return [(build(text.as_py(), counter), 0) for text in batch.column("text")]

    built = _mapped(rows, tokenizer, trees)
    results = {"tree_text": F.col("text"), "tree": F.col("tree"), "n_tokens": F.get("tree.tokens", F.lit(1)).cast("long")}
    return with_results(built, names, results)


def edited_counts(trees: DataFrame, tokenizer: str, edits: str = "edits", carry: list[str] | None = None) -> DataFrame:
    """Rows of ``token_trees`` after the edits in column ``edits``: ``n_tokens_after``, ``n_encoded`` and the new ``tree``.

    Edits are structs ``(start, end, text)`` in code points, by start and without
    overlap; NULL or none leaves a document as it is. ``n_encoded`` counts the
    pre-tokens that were encoded anew.
    """
    names = trees.columns if carry is None else carry
    rows = trees.select(
        whole_row(trees, names).alias("row"), F.col("tree_text").alias("text"), F.col("tree"),
        F.coalesce(F.col(edits).cast(EDITS), F.array().cast(EDITS)).alias("edits"),
    )

    def renewed(batch: pa.RecordBatch, counter: Counter) -> list[tuple[TokenTree, int]]:
        trees, todo = _trees_by_row(batch.column("tree")), _edits_by_row(batch.column("edits"))
        texts = batch.column("text")
        return [
            apply_edits(texts[at].as_py(), tree, own, counter) if own else (tree, 0)
            for at, (tree, own) in enumerate(zip(trees, todo, strict=True))
        ]

    done = _mapped(rows, tokenizer, renewed)
    results = {
        "tree": F.col("tree"),
        "n_tokens_after": F.get("tree.tokens", F.lit(1)).cast("long"),
        "n_encoded": F.col("encoded"),
    }
    return with_results(done, [n for n in names if n != "tree_text"], results)


def _mapped(
    rows: DataFrame, tokenizer: str, work: Callable[[pa.RecordBatch, Counter], list[tuple[TokenTree, int]]]
) -> DataFrame:
    """``row, text, tree, encoded`` for the trees that ``work`` makes of a batch."""
    ship_code(rows.sparkSession)
    config = rows.sparkSession.sparkContext.broadcast(vocabulary(tokenizer))
    schema = rows.select("row", "text", F.lit(None).cast(TREE).alias("tree"), F.lit(0).cast("long").alias("encoded")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(encoder(config.value))
        for batch in batches:
            made = work(batch, counter)
            trees = pa.StructArray.from_arrays(
                [
                    pa.array([t.leaves for t, _ in made], pa.int32()),
                    pa.array([t.chars for t, _ in made], pa.list_(pa.int32())),
                    pa.array([t.tokens for t, _ in made], pa.list_(pa.int32())),
                ],
                ["leaves", "chars", "tokens"],
            )
            encoded = pa.array([n for _, n in made], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("text"), trees, encoded], schema.names)

    return rows.mapInArrow(run, schema)


def masked(df: DataFrame, pattern: str, replacement: str, text: str = "text") -> DataFrame:
    """Add ``edits`` that replace every match of a regular expression; NULL text has none."""
    ship_code(df.sparkSession)
    schema = df.select("*", F.lit(None).cast(EDITS).alias("edits")).schema
    search = re.compile(pattern)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("text", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[m.span() for m in search.finditer(t)] if t else [] for t in batch.column(text).to_pylist()]
            flat = [span for spans in found for span in spans]
            structs = pa.StructArray.from_arrays(
                [
                    pa.array([a for a, _ in flat], pa.int32()),
                    pa.array([b for _, b in flat], pa.int32()),
                    pa.array([replacement] * len(flat), pa.string()),
                ],
                ["start", "end", "text"],
            )
            ends = np.cumsum([0, *map(len, found)])
            edits = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs).cast(kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, edits], schema.names)

    return df.mapInArrow(run, schema)


def _edits_by_row(column: pa.ListArray) -> list[list[tuple[int, int, str]]]:
    offsets = column.offsets.to_pylist()
    start, end, text = (column.values.field(name).to_pylist() for name in ("start", "end", "text"))
    return [list(zip(start[a:b], end[a:b], [t or "" for t in text[a:b]], strict=True)) for a, b in zip(offsets, offsets[1:], strict=False)]


def _trees_by_row(column: pa.StructArray) -> list[TokenTree]:
    leaves = column.field("leaves").to_pylist()
    parts = []
    for name in ("chars", "tokens"):
        arrays = column.field(name)
        values, offsets = arrays.values.to_numpy(zero_copy_only=False).astype(np.int64), arrays.offsets.to_pylist()
        parts.append([values[a:b].copy() for a, b in zip(offsets, offsets[1:], strict=False)])
    return [TokenTree(n, chars, tokens) for n, chars, tokens in zip(leaves, *parts, strict=True)]
