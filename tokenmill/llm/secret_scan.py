"""Secret scans with a token-efficiency test.

Three base patterns find assigned secrets, access keys and long hex runs. On
top, runs of key characters that look like nothing a language or a program
would write are found by how badly a tokenizer packs them: a vocabulary
learned from text needs few tokens for words and identifiers but about one
token for every character or two of a random string. A run is cut at base
spans and known digests, and its parts between signs (``SIGNS``) are judged, so
plain words beside a secret do not hide it: each window of neighbouring parts
that takes more tokens than one for ``RATIO`` characters is reported as
``random`` if it has ``LEAST_CHARS`` characters or more, and, under
``LEAST_PLAIN`` characters, a part that looks like no word or name. A run
without such a window is judged whole. Known digests are UUIDs and hex of the
lengths of common digests (the base reports hex as ``hex``). Identifiers are
not reported: words joined by separators whose parts are plain, and names with
a number at an end, if their letters pack at ``RATIO`` characters per token or
more. Numbers, and parts of one token, are no sign of a secret.

Spans are code points, end exclusive. Defined results: null text counts as
empty and has no spans. Null doc_ids and repeated rows are rows like any
other. Other columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
LEAST_ASSIGNED, LEAST_ACCESS = 12, 18
LEAST_CHARS = 12
#: Characters from which plain parts alone (letters of one case, names) count.
LEAST_PLAIN = 20
#: Characters of the part that makes a shorter span one, of no word or name.
LEAST_PART = 10
RATIO = 2.0
SIGNS = "-_/+=.!@#$%^&*~"
RUN = re.compile(rf"[A-Za-z0-9{re.escape(SIGNS)}]{{{LEAST_CHARS},}}")
DIGEST = re.compile(r"(?:[0-9a-f]{32}|[0-9a-f]{40}|[0-9a-f]{56}|[0-9a-f]{64}|[0-9a-f]{96}|[0-9a-f]{128})\Z", re.I)
UUID = re.compile(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\Z", re.I)
KNOWN = re.compile(rf"(?<![A-Za-z0-9])(?:{DIGEST.pattern[:-2]}|{UUID.pattern[:-2]})(?![A-Za-z0-9])", re.I)
PART = re.compile(r"[A-Za-z0-9]+")
#: Words and names with a number at an end (in front of two digits at most), and times as in 20240501T1200Z.
PLAIN_PART = re.compile(r"(?:[0-9]{0,2}(?:[A-Z]?[a-z]+|[A-Z]+|[a-z]+(?:[A-Z][a-z]+)+|(?:[A-Z][a-z]+)+)?[0-9]*|[0-9]{2,8}T[0-9]{2,6}Z?)\Z")
#: Signs that names do not have.
RARE_SIGN = re.compile(r"[!@#$%^&*~]")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, in order of start, then kind."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= LEAST_ASSIGNED]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _letters(part: str) -> str:
    """What of a part is judged: a plain part without the numbers at its ends."""
    return part.strip("0123456789") if PLAIN_PART.match(part) else part


def _score(part: str, n_tokens) -> tuple[float, bool]:
    """By how much a part takes more tokens than one for ``RATIO`` characters,
    and whether it may belong to a random part next to it. A part of one
    token is a word, however short."""
    word = _letters(part)
    n = n_tokens(word) if word else 0
    if n < 2:
        return min(RATIO - len(word), 0.0), len(word) <= RATIO
    return RATIO * n - len(word), len(word) < (RATIO + 1) * n


def is_named(run: str, n_tokens) -> bool:
    """Whether a run is a known digest or an identifier, that is, of plain
    parts that also pack like words."""
    if DIGEST.match(run) or UUID.match(run):
        return True
    parts = PART.findall(run)
    return all(map(PLAIN_PART.match, parts)) and sum(_score(p, n_tokens)[0] for p in parts) <= 0


def _long_enough(span: str) -> bool:
    """Short spans need more: a part of ``LEAST_PART`` characters, or any part
    beside a rare sign, that no word or name looks like. One word of an unknown
    language packs badly too, and so do names of versions, sizes and dates."""
    if len(span) >= LEAST_PLAIN:
        return True
    least = 1 if RARE_SIGN.search(span) else LEAST_PART
    return len(span) >= LEAST_CHARS and any(len(p) >= least and not PLAIN_PART.match(p) for p in PART.findall(span))


def _pieces(text: str, base: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Bounds of the runs, cut at base spans and at known digests and UUIDs."""
    spans: list[tuple[int, int]] = []  # of the base, put together
    for s, _, e in base:
        if spans and s <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(e, spans[-1][1])
        else:
            spans.append((s, e))
    at = 0
    for m in RUN.finditer(text):
        while at < len(spans) and spans[at][1] <= m.start():
            at += 1
        cuts = [(k.start(), k.end()) for k in KNOWN.finditer(text, m.start(), m.end())]
        i = at
        while i < len(spans) and spans[i][0] < m.end():
            cuts.append(spans[i])
            i += 1
        lo, hi = m.span()
        for s, e in [*sorted(cuts), (hi, hi)]:
            # the signs beside a cut belong to neither side
            piece = text[lo:s].lstrip(SIGNS) if lo > m.start() else text[lo:s]
            first = max(s, lo) - len(piece)
            if s < hi:
                piece = piece.rstrip(SIGNS)
            if len(piece) >= LEAST_CHARS:
                yield first, first + len(piece)
            lo = max(lo, e)


def _windows(scores: list[tuple[float, bool]]) -> list[tuple[int, int]]:
    """The windows (first, end) of neighbouring parts whose scores add up to
    most, from left to right."""
    out, i = [], 0
    while i < len(scores):
        total = most = 0.0
        end = i + 1
        for j in range(i, len(scores)):
            total += scores[j][0]
            if total <= 0:
                break
            if total > most:
                most, end = total, j + 1
        if most:
            out.append((i, end))
        i = end
    return out


def _widened(scores: list[tuple[float, bool]], first: int, end: int) -> tuple[int, int]:
    """A window with the parts beside it that may belong to it, if the scores
    still add up to more than 0."""
    lo, hi = first, end
    while lo and scores[lo - 1][1]:
        lo -= 1
    while hi < len(scores) and scores[hi][1]:
        hi += 1
    return (lo, hi) if sum(s for s, _ in scores[lo:hi]) > 0 else (first, end)


def random_spans(text: str, base: list[tuple[int, int, int]], n_tokens) -> list[tuple[int, int, int]]:
    out = []
    for lo, hi in _pieces(text, base):
        run = text[lo:hi]
        if run.isdigit():
            continue
        parts = [m.span() for m in PART.finditer(run)]
        scores = [_score(run[s:e], n_tokens) for s, e in parts]
        found, at = [], 0
        for first, end in _windows(scores):
            first, end = _widened(scores, first, end)
            # signs at an end of the run belong to the part there
            s = parts[first][0] if first else 0
            e = parts[end - 1][1] if end < len(parts) or run[parts[-1][1]:].strip("=") and first else len(run)
            if s >= at and _long_enough(run[s:e]):
                found.append((lo + s, 3, lo + e))
                at = e
        if not found and _long_enough(run) and not is_named(run, n_tokens) and len(run) < RATIO * n_tokens(run):
            found = [(lo, 3, hi)]
        out += found
    return out


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def _scan(ranks_file: bytes, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks_file.splitlines())}
        encoding = tiktoken.Encoding("scan", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        n_tokens = lambda run: len(encoding.encode_ordinary(run))
        for batch in batches:
            counts, digests, joined = [], [], []
            for text in batch.column("text"):
                text = text.as_py() or ""
                base = base_spans(text)
                counts.append([sum(k == i for _, k, _ in base) for i in range(3)])
                digests.append(hashlib.sha256(_joined(base).encode()).hexdigest())
                joined.append(_joined(sorted(base + random_spans(text, base, n_tokens))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([c[i] for c in counts], pa.int64()) for i in range(3)), pa.array(digests, pa.string()), pa.array(joined, pa.string())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])
    return run


def scan(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans of every row.
    ``ranks_path`` is a tiktoken rank file that the driver can read; it is
    sent to the tasks (under 1 MB)."""
    with open(ranks_path, "rb") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        yield from _scan(content.value, pattern)(batches)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
