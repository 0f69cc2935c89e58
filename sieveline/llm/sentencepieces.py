"""SentencePiece encoding by a lattice of piece edges, and decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import pieces

SPACE_MARK = "▁"
#: A word is a run of spaces and what follows up to the next space: no piece crosses its edge.
WORD = re.compile(f"{SPACE_MARK}*[^{SPACE_MARK}]+|{SPACE_MARK}+")
#: Longer words are merged outside the lattice, by the same rule with a heap.
MAX_LATTICE_CHARS = 48
#: Characters of the words that one lattice holds.
LATTICE_CHARS = 1 << 18
#: Words whose ids a task remembers; beyond it, it forgets all and goes on.
REMEMBERED = 1 << 18

ENCODED = "doc_id long, n_tokens long, ids array<int>, decoded_ok boolean"


def load_pieces(model_path: str) -> list[tuple[str, int, float]]:
    """(piece, id, score) of all text pieces of a model with byte fallback."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    skip = lambda i: model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)
    return [(model.id_to_piece(i), i, model.get_score(i)) for i in range(model.get_piece_size()) if not skip(i)]


def first_byte_id(model_path: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_path).piece_to_id("<0x00>")


def words(text: str | None) -> list[str]:
    if not text:
        return []
    return WORD.findall(SPACE_MARK + text.replace(" ", SPACE_MARK))


class PieceTable:
    """The pieces as a table of prefixes: (prefix, next character) gives the longer prefix.

    Keys are sorted, so that an equi-join of many substrings is one binary search
    per length; ``ids`` is -1 for prefixes that are no piece.
    """

    def __init__(self, table: list[tuple[str, int, float]]):
        number: dict[str, int] = {"": 0}
        keys: list[int] = []
        for piece, _, _ in table:
            for stop in range(1, len(piece) + 1):
                if piece[:stop] not in number:
                    number[piece[:stop]] = len(number)
                    keys.append(number[piece[: stop - 1]] << 21 | ord(piece[stop - 1]))
        made = np.array(keys, np.int64)
        order = np.argsort(made)
        self.keys, self.longer = made[order], order + 1
        self.ids = np.full(len(number), -1, np.int64)
        self.scores = np.zeros(len(number))
        for piece, i, score in table:
            self.ids[number[piece]], self.scores[number[piece]] = i, score
        self.longest = max((len(p) for p, _, _ in table), default=0)
        best_first, self.ranks = np.unique(-self.scores, return_inverse=True)  # equal scores share a rank
        self.n_ranks = len(best_first)

    def extend(self, prefix: np.ndarray, char: np.ndarray) -> np.ndarray:
        """The prefix that each prefix and character make, 0 where there is none."""
        if not len(self.keys):
            return np.zeros(len(prefix), np.int64)
        key = prefix << 21 | char
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.longer[at], 0)


def lattice(chars: np.ndarray, ends: np.ndarray, table: PieceTable) -> tuple[np.ndarray, ...]:
    """Edges (start, stop, id, rank of the score) over the characters of many words at once.

    ``ends`` is the end of each character's word. Substrings from every start grow
    by one character a step and meet the piece table by equality; those that
    no piece begins with end there.
    """
    start, prefix = np.arange(len(chars)), np.zeros(len(chars), np.int64)
    found: list[tuple[np.ndarray, ...]] = []
    for size in range(1, table.longest + 1):
        inside = start + size <= ends[start]
        start, prefix = start[inside], prefix[inside]
        prefix = table.extend(prefix, chars[start + size - 1])
        start, prefix = start[prefix > 0], prefix[prefix > 0]
        piece = table.ids[prefix] >= 0
        found.append((start[piece], start[piece] + size, table.ids[prefix[piece]], table.ranks[prefix[piece]]))
    if not found:
        none = np.empty(0, np.int64)
        return none, none, none, none
    return tuple(np.concatenate(column) for column in zip(*found, strict=True))


def encode_words(distinct: list[str], table: PieceTable, first_byte: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all words in a row, and where each word's ids begin and end, folded over the edges that are grouped by word.

    The model is a merge model: its encoding is not the best path of the lattice. So
    a step of the fold takes, of each word's edges over two neighbouring parts, the
    best one, the leftmost of equals, in place of Viterbi.
    """
    sizes = np.fromiter(map(len, distinct), np.int64, len(distinct))
    chars = np.frombuffer("".join(distinct).encode("utf-32-le"), np.uint32).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    word = np.repeat(np.arange(len(distinct)), sizes)
    start, stop, ids, ranks = lattice(chars, first[1:][word], table)
    single = stop - start == 1
    part = np.full(len(chars), -1, np.int64)
    part[start[single]] = ids[single]
    start, stop, ids, ranks = start[~single], stop[~single], ids[~single], ranks[~single]
    owner = word[start]
    # By word, best score, leftmost, shortest: one number, as sorting by four columns takes longer.
    longest = int(sizes.max(initial=0)) + 1
    order = np.argsort(((owner * table.n_ranks + ranks) * longest + start - first[owner]) * longest + stop - start)
    start, stop, ids, owner = start[order], stop[order], ids[order], owner[order]
    whole = np.ones(len(chars) + 1, bool)
    after = np.arange(1, len(chars) + 2)
    going = np.zeros(len(distinct), bool)
    while len(start):
        fits = np.flatnonzero(after[after[start]] == stop)
        owners = owner[fits]
        best = fits[np.concatenate([[True], owners[1:] != owners[:-1]])] if len(fits) else fits
        whole[after[start[best]]] = False
        after[start[best]], part[start[best]] = stop[best], ids[best]
        going[:] = False
        going[owners] = True
        left = np.flatnonzero(going[owner])
        left = left[whole[start[left]] & whole[stop[left]] & (after[start[left]] != stop[left])]
        start, stop, ids, owner = start[left], stop[left], ids[left], owner[left]
    kept = np.flatnonzero(whole[:-1])
    flat = part[kept]
    alone = flat < 0  # characters that no piece has: their UTF-8 bytes
    code = chars[kept]
    size = np.where(alone, 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF), 1)
    flat = np.repeat(flat, size)
    flat[np.repeat(alone, size)] = first_byte + np.frombuffer("".join(map(chr, code[alone].tolist())).encode(), np.uint8).astype(np.int64)
    return flat, np.concatenate([[0], np.cumsum(size)])[np.searchsorted(kept, first)]


def merge_word(word: str, table: dict[str, tuple[int, float]], first_byte: int) -> list[int]:
    """The same merges for one word, with a heap: for words too long for the lattice."""
    parts: list[str | None] = list(word)
    after, before = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
    heap: list[tuple[float, int, str]] = []

    def offer(i: int) -> None:
        if 0 <= i and (j := after[i]) < len(parts) and (found := table.get(parts[i] + parts[j])):
            heapq.heappush(heap, (-found[1], i, parts[i] + parts[j]))

    for i in range(len(parts) - 1):
        offer(i)
    while heap:
        _, i, joined = heapq.heappop(heap)
        if parts[i] is None or (j := after[i]) >= len(parts) or parts[i] + parts[j] != joined:
            continue
        parts[i], parts[j], after[i] = joined, None, after[j]
        if after[i] < len(parts):
            before[after[i]] = i
        offer(before[i])
        offer(i)
    out: list[int] = []
    for part in parts:
        if part is not None:
            out += [table[part][0]] if part in table else [first_byte + b for b in part.encode()]
    return out


def decode(ids: list[int], raw: dict[int, bytes]) -> str:
    """Text of ids: pieces and bytes joined, space marks turned back, the leading space dropped."""
    return read(b"".join(map(raw.__getitem__, ids)))


def read(spelled: bytes) -> str:
    """Text that the bytes of pieces stand for."""
    return spelled.decode("utf-8", "replace").replace(SPACE_MARK, " ").removeprefix(" ")


class Encoder:
    """Ids of texts; remembers the words of earlier texts up to a bound."""

    def __init__(self, table: list[tuple[str, int, float]], first_byte: int):
        self.table, self.first_byte = PieceTable(table), first_byte
        self.by_piece = {p: (i, s) for p, i, s in table}
        self.raw = {first_byte + b: bytes([b]) for b in range(256)} | {i: p.encode() for p, i, _ in table}
        self.sizes = np.zeros(max(self.raw) + 1, np.int64)
        self.sizes[list(self.raw)] = list(map(len, self.raw.values()))
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {}  # ids of a word, packed as 32-bit numbers
        self.spelled: dict[str, bytes] = {}  # bytes of the pieces of the same words
        self.misspelled: set[str] = set()  # those of them whose pieces do not spell them

    def _remember(self, new: list[str], flat: np.ndarray, cuts: np.ndarray) -> None:
        packed = flat.astype(np.intc).tobytes()
        spelled = b"".join(map(self.raw.__getitem__, flat.tolist()))
        at = (4 * cuts).tolist()
        read_at = np.concatenate([[0], np.cumsum(self.sizes[flat])])[cuts].tolist()
        for word, a, b, c, d in zip(new, at, at[1:], read_at, read_at[1:], strict=False):
            self.known[word] = packed[a:b]
            self.spelled[word] = made = spelled[c:d]
            if made != word.encode():
                self.misspelled.add(word)

    def learn(self, new: list[str]) -> None:
        held: list[str] = []
        size = 0
        for word in new:
            held.append(word)
            size += len(word)
            if size >= LATTICE_CHARS:
                self._remember(held, *encode_words(held, self.table, self.first_byte))
                held, size = [], 0
        if held:
            self._remember(held, *encode_words(held, self.table, self.first_byte))

    def _split(self, texts: list[str]) -> tuple[list[list[str]], list[str]]:
        """Words of each text, all of them known now, and the long ones, to be dropped after use."""
        split = [words(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self._forget()
        new = set().union(*split).difference(self.known)
        long = [w for w in new if len(w) > MAX_LATTICE_CHARS]
        self.learn(list(new.difference(long)))
        for w in long:
            ids = np.array(merge_word(w, self.by_piece, self.first_byte), np.int64)
            self._remember([w], ids, np.array([0, len(ids)]))
        return split, long

    def _drop(self, long: list[str]) -> None:
        for w in long:
            del self.known[w], self.spelled[w]
        self.misspelled.difference_update(long)

    def _spell(self, split: list[str]) -> bytes:
        return b"".join(map(self.spelled.__getitem__, split))

    def packed(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Ids of each text as packed 32-bit numbers, and the bytes that its pieces spell: both joined by word."""
        split, long = self._split(texts)
        out = [b"".join(map(self.known.__getitem__, ws)) for ws in split], [self._spell(ws) for ws in split]
        self._drop(long)
        return out

    def checked(self, texts: list[str]) -> tuple[list[bytes], list[bool]]:
        """Ids of each text as packed 32-bit numbers, and whether they decode to the text.

        Ids are decoded once for each word. A text without space marks of its own, all of whose words
        are spelled by their pieces, decodes to itself; any other is put together and compared.
        """
        split, long = self._split(texts)
        ids = [b"".join(map(self.known.__getitem__, ws)) for ws in split]
        plain = [SPACE_MARK not in text and (not self.misspelled or self.misspelled.isdisjoint(ws)) for ws, text in zip(split, texts, strict=True)]
        same = [fine or read(self._spell(ws)) == text for fine, ws, text in zip(plain, split, texts, strict=True)]
        self._drop(long)
        return ids, same

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [np.frombuffer(ids, np.intc).tolist() for ids in self.checked(texts)[0]]


def encode_documents(docs: DataFrame, table: list[tuple[str, int, float]], first_byte: int) -> DataFrame:
    """Token ids of whole texts, and whether they decode to the text.

    A task takes its rows in pieces of about 1 MB of text. The distinct words of a piece
    that it does not know yet become one lattice: substrings joined to the piece
    table, edges grouped by word, one fold over all words. Nothing is shuffled, and a
    task holds one piece, one lattice and a bounded number of known words.

    ``docs`` needs doc_id and text; other columns are ignored.
    Null and empty texts have no ids. A text's own space marks decode to spaces, which
    ``decoded_ok`` reports as they are. Texts of any length are encoded whole. Repeated rows are encoded each; empty
    tables give no rows. Returns doc_id, n_tokens, ids, decoded_ok.
    """
    # The piece table is a fixed vocabulary: its size is bound by the model.
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, first_byte)
        for batch in pieces(batches, most=1 << 20):
            texts = batch.column("text").to_pylist()
            packed, same = encoder.checked(texts)
            counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(packed), np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), ids, pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids", "decoded_ok"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, ENCODED)
