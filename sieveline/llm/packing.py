"""Training sequences from documents: context tiers, filled windows, balanced steps."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from sieveline.llm.common import pieces
from sieveline.llm.tokens import encoding, whole_text_encoder

TIERS = (256, 512, 1024, 2048)
END_ID = 1
#: Tokens that are packed together: what a task holds at once, whatever its input.
GROUP_TOKENS = 1 << 21
#: Tokens of one training step.
STEP_TOKENS = 1 << 16

PACKED = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "tier int, step_group long"
)

Piece = tuple[int, int, int]


class _Shorter:
    """Pieces by length; the longest that fits a gap is found by one mask."""

    def __init__(self):
        self.mask, self.by_length = 0, {}

    def put(self, piece: Piece) -> None:
        self.mask |= 1 << piece[2]
        self.by_length.setdefault(piece[2], []).append(piece)

    def take(self, most: int) -> Piece | None:
        fitting = self.mask & ((1 << (most + 1)) - 1)
        if not fitting:
            return None
        length = fitting.bit_length() - 1
        stack = self.by_length[length]
        piece = stack.pop()
        if not stack:
            self.mask ^= 1 << length
        return piece


def _cut(stream: list[Piece], sizes: list[int]) -> list[list[Piece]]:
    """The pieces one after another, cut into runs of these sizes."""
    runs, rest = [], stream[::-1]
    for size in sizes:
        run, room = [], size
        while room:
            doc, start, length = rest.pop()
            if length > room:
                rest.append((doc, start + room, length - room))
                length = room
            run.append((doc, start, length))
            room -= length
        runs.append(run)
    return runs


def pack(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[list[Piece]]:
    """Sequences of pieces (document, start, length) that hold every token once.

    A document goes to the smallest tier that holds it; longer ones first give
    whole windows of the longest tier, and what is left is routed. From the longest
    tier down each document opens a window; its gap takes the longest shorter
    documents that fit, then a cut of one. Where nothing shorter is left,
    the tier's own open windows are joined and cut at the tier's length, and the last
    rest is cut at powers of two: every sequence's length is a tier or a power of two.
    """
    top = tiers[-1]
    done: list[list[Piece]] = []
    pool = _Shorter()
    for doc, n in enumerate(lengths):
        whole = n - n % top
        done += [[(doc, at, top)] for at in range(0, whole, top)]
        if n > whole:
            pool.put((doc, whole, n - whole))
    for k in range(len(tiers) - 1, -1, -1):
        tier, below = tiers[k], tiers[k - 1] if k else 0
        unfilled: list[list[Piece]] = []
        while pool.mask.bit_length() - 1 > below:
            window = [pool.take(tier)]
            gap = tier - window[0][2]
            while gap:
                piece = pool.take(min(gap, below)) if below else None
                if piece is None and below and (piece := pool.take(below)):
                    doc, start, length = piece
                    pool.put((doc, start + gap, length - gap))
                    piece = (doc, start, gap)
                if piece is None:
                    break
                window.append(piece)
                gap -= piece[2]
            (unfilled if gap else done).append(window)
        stream = [p for w in unfilled for p in w]
        total = sum(p[2] for p in stream)
        rest = total % tier
        sizes = [tier] * (total // tier) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
        done += _cut(stream, sizes)
    return done


def balanced_steps(sizes: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """Step of each sequence: the longest first, each to the step with the fewest tokens."""
    steps = [(0, i) for i in range(max(1, -(-sum(sizes) // step_tokens)))]
    of = [0] * len(sizes)
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        load, step = heapq.heappop(steps)
        of[k] = step
        heapq.heappush(steps, (load + sizes[k], step))
    return of


def pack_documents(docs: DataFrame, ranks_path: str, pattern: str, group_tokens: int = GROUP_TOKENS, added: tuple[tuple[str, int], ...] = ()) -> DataFrame:
    """Pack all documents into sequences of at most 2048 tokens, without padding.

    A task encodes its rows, closes each document with id 1, and packs them in groups
    of about ``group_tokens`` tokens, so it holds one group at a time; nothing is
    shuffled. The vocabulary is that of a byte-level tokenizer given as ranks, and
    its ids are the same; the ``added`` tokens (name, id) are one id wherever a text
    holds their names. Sequence and step numbers begin with the number of the task, so
    they are unique, and equal whenever a task is run again.

    ``docs`` needs doc_id and text; other columns are ignored. A null or empty text
    is a document of the closing id only. Null and repeated doc_ids are
    documents of their own. Texts of any length are encoded whole, white space of any
    length included. Empty tables give no rows.

    Returns per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, tier (of the document), step_group.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, first = encoding(ranks_path, pattern, added), TaskContext.get().partitionId() << 33
        encode = whole_text_encoder(coder, bool(added))
        made = {"sequences": first, "steps": first}
        names: list = []
        ids: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            sequences = pack([len(x) for x in ids])
            steps = balanced_steps([sum(p[2] for p in s) for s in sequences])
            rows = []
            for number, (sequence, step) in enumerate(zip(sequences, steps, strict=True)):
                offset = 0
                for doc, start, length in sequence:
                    whole = ids[doc]
                    tier = next((t for t in TIERS if len(whole) <= t), TIERS[-1])
                    crc = crc32(whole[start : start + length].astype("<u4").tobytes())
                    rows.append((names[doc], start, length, crc, len(whole), made["sequences"] + number, offset, tier, made["steps"] + step))
                    offset += length
            made["sequences"] += len(sequences)
            made["steps"] += max(steps, default=-1) + 1
            kinds = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
            fields = [part.split()[0] for part in PACKED.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], fields)

        held = 0
        for batch in pieces(batches, most=1 << 21):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for name, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                names.append(name)
                ids.append(np.array([*encode(text), END_ID], np.uint32))
                held += len(ids[-1])
            if held >= group_tokens:
                yield flush()
                names, ids, held = [], [], 0
        if ids:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(run, PACKED)
