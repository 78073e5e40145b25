"""Edit-aware token counts.

A document's text is cut into leaves at safe places (``SAFE``): before a
single space between two characters that are not white space, after a single
line break between two such, and between a closing or separating mark and a
letter. The pre-token pattern starts a pre-token there whatever stands
before, so leaves are whole runs of pre-tokens, their token counts add up to
the document's, and a place stays safe as long as the characters around
it (two before, two after) stay. A segment tree over the leaves' counts is kept with the document.

An edit re-encodes only the leaves it touches plus the boundary context: the
region from the last safe place that ends before it to the first one that
begins after it. The region's new count goes to its first leaf, the others
become empty, and the sums above are updated. Edits of one document are taken
together when their regions meet. ``edit_trees`` returns the edited text with
its own cuts and sums, regions that grew beyond ``LONGEST`` being cut again, so
the next edits start from there and the whole text is never encoded again.

Edits are structs (start, end, replacement) in code points of the original
text, not overlapping. Defined results: null text counts as empty, with no
tokens. Null or no edits leave the count as it is; edits are sorted here, and
one that overlaps an earlier one or lies outside the text is left out and not
counted. Null doc_ids and repeated rows are rows like any other. An empty
table gives an empty result.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAF = 256
#: Characters from which the region of an edit is cut into leaves again.
LONGEST = 4 * LEAF
#: Where a pre-token starts whatever is around. Letters are those of fixed
#: ranges, so that no version of Unicode tells them otherwise; an apostrophe
#: is no such mark, as contractions are pre-tokens.
SAFE = re.compile(r"(?<=\S) (?=\S)|(?<=\S\n)(?=\S)|(?<=[.,;:!?)\]}\"|/\u3001\u3002\uff01\uff0c\uff1a\uff1b\uff1f])(?=[A-Za-z\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3])")
EDITS = "array<struct<start: int, end: int, replacement: string>>"
#: Redactions whose cost in tokens the registered query measures.
REDACTIONS = [(re.compile(r"[A-Za-z0-9._+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"), "<email>"),
              (re.compile(r"[0-9a-f]{32,}"), "<key>"), (re.compile(r"[0-9]{13,19}"), "<number>"), (re.compile(r"\t+| {2,}"), " ")]


def safe_cuts(text: str, leaf: int = LEAF) -> list[int]:
    """Starts of the leaves: 0, then safe places at least ``leaf`` apart."""
    cuts = [0]
    while m := SAFE.search(text, cuts[-1] + leaf):
        cuts.append(m.start())
    return cuts


class CountTree:
    """A segment tree of counts: ``sums[1]`` is the total, leaf i is
    ``sums[size + i]``."""

    def __init__(self, counts: list[int] | None = None, sums: list[int] | None = None):
        if sums is not None:
            self.sums, self.size = sums, len(sums) // 2
            return
        self.size = max(1, 1 << (max(len(counts), 1) - 1).bit_length())
        level = np.zeros(self.size, np.int64)
        level[:len(counts)] = counts
        levels = [level]
        while len(levels[-1]) > 1:
            levels.append(levels[-1].reshape(-1, 2).sum(1))
        self.sums = [0] + np.concatenate(levels[::-1]).tolist()

    @property
    def total(self) -> int:
        return self.sums[1]

    def leaves(self, n: int) -> list[int]:
        return self.sums[self.size:self.size + n]

    def put(self, leaf: int, count: int) -> None:
        i = self.size + leaf
        change = count - self.sums[i]
        while i:
            self.sums[i] += change
            i //= 2


def clean_edits(edits, length: int) -> list[tuple[int, int, str]]:
    out, at = [], 0
    for e in sorted(((x["start"], x["end"], x["replacement"] or "") for x in edits or [] if x and x["start"] is not None and x["end"] is not None)):
        if at <= e[0] <= e[1] <= length:
            out.append(e)
            at = e[1]
    return out


def regions(cuts: list[int], length: int, edits: list[tuple[int, int, str]]) -> list[tuple[int, int, list]]:
    """(first leaf, end leaf, edits) of the regions to be encoded again."""
    starts = np.array(cuts)
    out = []
    for e in edits:
        # kept places have all their characters, p - 2 to p + 1, outside the edit
        lo = max(int(np.searchsorted(starts, e[0] - 1, side="left")) - 1, 0)
        hi = int(np.searchsorted(starts, e[1] + 2, side="left"))
        hi = max(hi, lo + 1)
        if out and lo < out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]), [*out[-1][2], e])
        else:
            out.append((lo, hi, [e]))
    return out


def region_text(text: str, cuts: list[int], lo: int, hi: int, edits: list) -> str:
    begin, end = cuts[lo], cuts[hi] if hi < len(cuts) else len(text)
    parts, at = [], begin
    for s, e, new in edits:
        parts += [text[at:s], new]
        at = e
    return "".join([*parts, text[at:end]])


def apply_edits(text: str, cuts: list[int], tree: CountTree, edits: list, n_tokens) -> int:
    """Update the tree; returns how many leaves were encoded again."""
    again = 0
    for lo, hi, own in regions(cuts, len(text), edits):
        tree.put(lo, n_tokens(region_text(text, cuts, lo, hi, own)))
        for leaf in range(lo + 1, hi):
            tree.put(leaf, 0)
        again += hi - lo
    return again


def edited_tree(text: str, cuts: list[int], tree: CountTree, edits: list, n_tokens) -> tuple[str, list[int], CountTree, int]:
    """Text, cuts and tree after the edits, and how many leaves were encoded
    again. A region becomes one leaf, or several where it is long; the others
    keep their counts and move."""
    counts = tree.leaves(len(cuts))
    parts, new_cuts, new_counts = [], [], []
    at = done = again = 0  # length of the new text, leaves taken over

    def take_over(end: int) -> None:
        nonlocal at, done
        if done < end:
            first, last = cuts[done], cuts[end] if end < len(cuts) else len(text)
            new_cuts.extend(c - first + at for c in cuts[done:end])
            new_counts.extend(counts[done:end])
            parts.append(text[first:last])
            at += last - first
            done = end

    for lo, hi, own in regions(cuts, len(text), edits):
        take_over(lo)
        piece = region_text(text, cuts, lo, hi, own)
        inner = safe_cuts(piece) if len(piece) > LONGEST else [0]
        if piece or not new_cuts:
            new_cuts.extend(c + at for c in inner)
            new_counts.extend(n_tokens(piece[a:b]) for a, b in zip(inner, [*inner[1:], len(piece)]))
        parts.append(piece)
        at += len(piece)
        done = hi
        again += hi - lo
    take_over(len(cuts))
    if len(new_cuts) > 1 and new_cuts[1] == 0:  # an empty region before the rest
        new_cuts, new_counts = new_cuts[1:], new_counts[1:]
    return "".join(parts), new_cuts, CountTree(new_counts), again


def redactions(text: str) -> list[dict]:
    """Edits that replace personal data, keys and runs of blanks."""
    found = sorted((m.start(), m.end(), new) for pattern, new in REDACTIONS for m in pattern.finditer(text))
    return [{"start": s, "end": e, "replacement": new} for s, e, new in found]


class Encoder:
    """tiktoken over a rank file's content, made once per worker."""

    def __init__(self, ranks_file: bytes, pattern: str):
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        self.encode = tiktoken.Encoding("counts", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> int:
        return len(self.encode(text)) if text else 0


def _trees(batches: Iterator[pa.RecordBatch], n_tokens) -> Iterator[pa.RecordBatch]:
    """Adds cuts and sums, the kept tree, to (doc_id, text, ...)."""
    for batch in batches:
        all_cuts, sums = [], []
        for x in batch.column("text"):
            text = x.as_py() or ""
            cuts = safe_cuts(text)
            ends = [*cuts[1:], len(text)]
            all_cuts.append(cuts)
            sums.append(CountTree([n_tokens(text[a:b]) for a, b in zip(cuts, ends)]).sums)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(all_cuts, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int64()))],
                                         names=[*batch.schema.names, "cuts", "sums"])


def _edited(batches: Iterator[pa.RecordBatch], n_tokens, edits_of=None) -> Iterator[pa.RecordBatch]:
    """Applies edits, from a column or a function of the text, to kept trees."""
    for batch in batches:
        out = []
        edits_in = batch.column("edits") if edits_of is None else None
        for i, (x, cuts, sums) in enumerate(zip(batch.column("text"), batch.column("cuts"), batch.column("sums"))):
            text, cuts = x.as_py() or "", cuts.as_py()
            tree = CountTree(sums=sums.as_py())
            before = tree.total
            edits = clean_edits(edits_of(text) if edits_of else edits_in[i].as_py(), len(text))
            again = apply_edits(text, cuts, tree, edits, n_tokens)
            out.append((before, len(edits), tree.total, len(cuts), again))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array([r[k] for r in out], pa.int64()) for k in range(5))],
                                         names=["doc_id", "n_tokens", "n_edits", "n_tokens_after", "n_leaves", "n_encoded_again"])


def _edited_trees(batches: Iterator[pa.RecordBatch], n_tokens) -> Iterator[pa.RecordBatch]:
    """The kept trees after the edits of a column."""
    for batch in batches:
        texts, all_cuts, sums, numbers = [], [], [], []
        for x, cuts, kept, edits in zip(*(batch.column(c) for c in ("text", "cuts", "sums", "edits"))):
            text = x.as_py()
            edits = clean_edits(edits.as_py(), len(text or ""))
            after, cuts, tree, again = edited_tree(text or "", cuts.as_py(), CountTree(sums=kept.as_py()), edits, n_tokens)
            texts.append(after if edits else text)
            all_cuts.append(cuts)
            sums.append(tree.sums)
            numbers.append((tree.total, len(edits), again))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(all_cuts, pa.list_(pa.int32())), pa.array(sums, pa.list_(pa.int64())),
             *(pa.array([n[k] for n in numbers], pa.int64()) for k in range(3))],
            names=["doc_id", "text", "cuts", "sums", "n_tokens", "n_edits", "n_encoded_again"])


COUNTS = "doc_id long, n_tokens long, n_edits long, n_tokens_after long, n_leaves long, n_encoded_again long"


def _encoder(docs: DataFrame, ranks_path: str, pattern: str):
    with open(ranks_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())  # under 1 MB
    return lambda: Encoder(content.value, pattern)


def build_trees(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, text, cuts and sums of every row, to be kept and edited later."""
    make = _encoder(docs, ranks_path, pattern)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(lambda batches: _trees(batches, make()), "doc_id long, text string, cuts array<int>, sums array<long>")


def count_edited(trees: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Counts before and after the column ``edits`` of kept trees."""
    make = _encoder(trees, ranks_path, pattern)
    rows = trees.select("doc_id", "text", "cuts", "sums", F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInArrow(lambda batches: _edited(batches, make()), COUNTS)


def edit_trees(trees: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Kept trees (doc_id, text, cuts, sums) after their column ``edits``, with
    n_tokens, n_edits and n_encoded_again; they can be edited again. A null
    text without edits stays null."""
    make = _encoder(trees, ranks_path, pattern)
    rows = trees.select("doc_id", "text", "cuts", "sums", F.col("edits").cast(EDITS).alias("edits"))
    return rows.mapInArrow(lambda batches: _edited_trees(batches, make()),
                           "doc_id long, text string, cuts array<int>, sums array<long>, n_tokens long, n_edits long, n_encoded_again long")


def count_redacted(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Token counts of every row before and after ``redactions``, in one pass:
    trees are built and edited batch by batch."""
    make = _encoder(docs, ranks_path, pattern)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))

    def run(batches):
        n_tokens = make()
        yield from _edited(_trees(batches, n_tokens), n_tokens, redactions)

    return rows.mapInArrow(run, COUNTS)
