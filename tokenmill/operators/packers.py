"""Sequential packing rules, written against document lengths only.

These functions are the per-group bodies of the Spark packing jobs in
``tokenmill.operators.packing``: they see ``(length)`` per document in
stream order and return a placement plan. Token arrays never pass
through Python; Spark joins the plan back to the tokens and assembles
the rows (see ``packing.assemble_rows``).

A placement is ``(doc, row, dst, src, take)``: ``take`` tokens of
document ``doc`` starting at ``src`` go to row ``row`` at offset ``dst``.
Every function is deterministic for a given input order.

A stream may come in parts. ``pack(..., last=False)`` packs a part that others
follow: it stops where the rule would ask for more input, and returns the
documents of the unfinished row and of the buffer, in order, to be packed
with those of the other parts.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections import deque
from itertools import islice

import numpy as np


class _LengthBuffer:
    """Buffered documents indexed by length; ties keep arrival order.

    Gives the largest length <= x, and the shortest length, in
    O(log distinct lengths), where the reference scans the whole buffer.
    """

    def __init__(self):
        self.lens: list[int] = []          # sorted distinct lengths present
        self.by_len: dict[int, deque] = {}
        self.count = 0

    def add(self, length: int, doc: int):
        q = self.by_len.get(length)
        if q is None:
            q = self.by_len[length] = deque()
            insort(self.lens, length)
        q.append(doc)
        self.count += 1

    def _pop(self, length: int) -> int:
        q = self.by_len[length]
        doc = q.popleft()
        if not q:
            del self.by_len[length]
            self.lens.pop(bisect_right(self.lens, length) - 1)
        self.count -= 1
        return doc

    def pop_largest_fitting(self, room: int):
        i = bisect_right(self.lens, room) - 1
        if i < 0:
            return None
        length = self.lens[i]
        return self._pop(length), length

    def pop_shortest(self):
        length = self.lens[0]
        return self._pop(length), length

    def docs(self) -> list[int]:
        return [d for q in self.by_len.values() for d in q]


def _out(pl):
    if not pl:
        z = np.zeros(0, dtype=np.int64)
        return z, z, z, z, z
    a = np.asarray(pl, dtype=np.int64)
    return a[:, 0], a[:, 1], a[:, 2], a[:, 3], a[:, 4]


def crop_rows(read, cap: int, buffer_size: int = 1000, refill: int = 128, left: list | None = None):
    """Rows ``[(doc, dst, take)]`` of ``bestfit_crop``, one by one. ``read(k)``
    gives the next ``k`` ``(doc, length)`` of the stream, fewer at its end, so
    only the buffer and one row are held."""
    buf = _LengthBuffer()
    more = True
    while True:
        pos = 0
        cur = []
        while pos < cap:
            while buf.count < buffer_size and more:
                got = read(refill)
                more = len(got) == refill
                for d, length in got:
                    buf.add(length, d)
            if left is not None and buf.count < buffer_size:
                left.extend(sorted([c[0] for c in cur] + buf.docs()))
                return
            if buf.count == 0:
                return                 # input exhausted: short last row dropped
            room = cap - pos
            hit = buf.pop_largest_fitting(room)
            if hit is not None:
                d, length = hit
                cur.append((d, pos, length))
                pos += length
            else:
                d, _ = buf.pop_shortest()
                cur.append((d, pos, room))
                pos = cap
        yield cur


def pad_rows(read, cap: int, buffer_size: int = 100, oversize: str = "truncate", left: list | None = None):
    """Rows of ``bestfit_pad`` one by one, as in ``crop_rows``."""
    buf = _LengthBuffer()
    more = True
    while True:
        pos = 0
        cur = []
        while pos < cap:
            while buf.count < buffer_size and more:
                asked = buffer_size - buf.count
                got = read(asked)
                more = len(got) == asked
                for d, length in got:
                    if length > cap:
                        if oversize == "truncate":
                            buf.add(cap, d)
                    else:
                        buf.add(length, d)
            if left is not None and buf.count < buffer_size:
                left.extend(sorted([c[0] for c in cur] + buf.docs()))
                return
            if buf.count == 0:
                break
            hit = buf.pop_largest_fitting(cap - pos)
            if hit is None:
                break                  # pad the rest of this row
            d, length = hit
            cur.append((d, pos, length))
            pos += length
        if not cur:
            return
        yield cur


def _whole(rows, lengths, cap: int, **args):
    """Placements of all rows of the documents ``0, 1, ...``."""
    docs = enumerate(map(int, lengths))
    made = rows(lambda k: list(islice(docs, k)), cap, **args)
    return _out([(d, r, dst, 0, take) for r, row in enumerate(made) for d, dst, take in row])


def bestfit_crop(lengths, cap: int, buffer_size: int = 1000, refill: int = 128, left: list | None = None):
    """Largest buffered doc that fits; when none fits, crop the shortest.

    The buffer is topped up in batches of ``refill`` while it holds fewer
    than ``buffer_size`` docs. Finite input: the buffer is drained and a
    last row that cannot be filled is dropped (100% utilisation). With a list
    ``left`` it stops at the first refill that finds no input instead, and
    puts the documents of that row and of the buffer there.
    """
    return _whole(crop_rows, lengths, cap, buffer_size=buffer_size, refill=refill, left=left)


def bestfit_pad(lengths, cap: int, buffer_size: int = 100, oversize: str = "truncate", left: list | None = None):
    """Largest buffered doc that fits; when none fits, pad the row.

    Nothing is cropped except documents longer than ``cap``: with
    ``oversize='truncate'`` they are cut to ``cap``; with ``'reject'`` they
    are left out of the plan (see ``packing.rejected``). The last row is
    padded, not dropped. ``left`` as in ``bestfit_crop``.
    """
    return _whole(pad_rows, lengths, cap, buffer_size=buffer_size, oversize=oversize, left=left)


def greedy_crop(lengths, cap: int):
    """Documents in order; the one that does not fit is cropped to fill.

    The cropped tail is discarded; the next row starts with the next doc.
    A last row that cannot be filled is dropped.
    """
    placed = []
    row, pos = 0, 0
    cur = []
    for d, length in enumerate(lengths):
        length = int(length)
        room = cap - pos
        if length <= room:
            cur.append((d, row, pos, 0, length))
            pos += length
        else:
            cur.append((d, row, pos, 0, room))
            pos = cap
        if pos == cap:
            placed.extend(cur)
            cur = []
            row += 1
            pos = 0
    return _out(placed)


def greedy_pad(lengths, cap: int):
    """Documents in order; the one that does not fit starts a new row and
    the rest of the current row is padded. Docs longer than ``cap`` are
    cropped to ``cap``. The last row is padded."""
    placed = []
    row, pos = 0, 0
    for d, length in enumerate(lengths):
        length = min(int(length), cap)
        if length > cap - pos:
            row += 1
            pos = 0
        placed.append((d, row, pos, 0, length))
        pos += length
    return _out(placed)


class _MaxTree:
    """Segment tree over row remaining-capacity: first row with room >= x."""

    def __init__(self, size: int, cap: int):
        m = 1
        while m < max(1, size):
            m *= 2
        self.m = m
        self.t = [cap] * (2 * m)

    def first_at_least(self, x: int) -> int:
        if self.t[1] < x:
            return -1
        i = 1
        t = self.t
        while i < self.m:
            i = 2 * i if t[2 * i] >= x else 2 * i + 1
        return i - self.m

    def sub(self, leaf: int, amount: int):
        i = leaf + self.m
        t = self.t
        t[i] -= amount
        i //= 2
        while i:
            t[i] = max(t[2 * i], t[2 * i + 1])
            i //= 2


def first_fit_decreasing(lengths, cap: int):
    """FFD: longest docs first (stable), each into the first row with room.
    Docs longer than ``cap`` are cropped to ``cap``; rows are padded."""
    lens = np.minimum(np.asarray(lengths, dtype=np.int64), cap)
    order = np.argsort(-lens, kind="stable")
    tree = _MaxTree(len(lens), cap)
    fill = [0] * max(1, len(lens))
    placed = []
    rows_used = 0
    for d in order:
        length = int(lens[d])
        r = tree.first_at_least(length)
        placed.append((int(d), r, fill[r], 0, length))
        fill[r] += length
        tree.sub(r, length)
        rows_used = max(rows_used, r + 1)
    placed.sort(key=lambda p: (p[1], p[2]))
    return _out(placed)


PACKERS = {
    "bestfit_crop": bestfit_crop,
    "bestfit_pad": bestfit_pad,
    "greedy_crop": greedy_crop,
    "greedy_pad": greedy_pad,
    "ffd": first_fit_decreasing,
}

# packers that fill every row completely (no padding)
CROPPING = {"bestfit_crop", "greedy_crop"}
BUFFERED = {"bestfit_crop": crop_rows, "bestfit_pad": pad_rows}


def pack(packer: str, lengths, cap: int, last: bool = True, **args):
    """Placements of one part of a stream, and its documents that are left
    for later (none of the last part). Packers without a buffer leave the
    documents of the unfinished row: what a cropping one has put into none,
    the last row of a padding one."""
    rule = PACKERS[packer]
    if last:
        return rule(lengths, cap, **args), np.zeros(0, np.int64)
    if packer in BUFFERED:
        left: list[int] = []
        return rule(lengths, cap, left=left, **args), np.array(left, np.int64)
    placed = rule(lengths, cap, **args)
    if packer in CROPPING:
        # a greedy packer puts every document somewhere; the dropped row's are last
        return placed, np.setdiff1d(np.arange(len(lengths)), placed[0])
    if not len(placed[0]):
        return placed, placed[0]
    open_row = placed[1] == placed[1].max()
    return tuple(x[~open_row] for x in placed), np.sort(placed[0][open_row])


def packed_rows(packer: str, docs, cap: int, last: bool, left: list, **args):
    """Rows ``[(doc, dst, take)]`` of one part of a stream, an iterator of
    ``(doc, length)``; a packer takes a document's first tokens. What is left
    for later is put into ``left`` at the end. A buffered packer reads
    on as it needs documents, the others hold all lengths."""
    if packer in BUFFERED:
        yield from BUFFERED[packer](lambda k: list(islice(docs, k)), cap, **({} if last else {"left": left}), **args)
        return
    names, lengths = zip(*docs)
    (d, r, dst, _, take), rest = pack(packer, np.array(lengths, np.int64), cap, last, **args)
    order = np.lexsort((dst, r))
    row, at = [], None
    for k, i, x, n in zip(r[order].tolist(), d[order].tolist(), dst[order].tolist(), take[order].tolist()):
        if row and k != at:
            yield row
            row = []
        row.append((names[i], x, n))
        at = k
    if row:
        yield row
    left.extend(names[i] for i in rest.tolist())
