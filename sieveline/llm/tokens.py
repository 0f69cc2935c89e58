"""Byte-pair encodings over a public vocabulary, one per worker process."""

from __future__ import annotations

import base64
import json
import re
from collections.abc import Callable
from functools import cache

import tiktoken


@cache
def encoding(ranks_path: str, pattern: str, added: tuple[tuple[str, int], ...] = ()) -> tiktoken.Encoding:
    """Encoding of a vocabulary file of base64 tokens and their ranks; ``added`` tokens are whole in text."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens=dict(added))


def added_tokens(json_path: str) -> tuple[tuple[str, int], ...]:
    """Added tokens of a tokenizer file and their ids."""
    with open(json_path, encoding="utf-8") as file:
        return tuple((t["content"], t["id"]) for t in json.load(file)["added_tokens"])


#: White space that the pattern takes as one piece; its matcher gives up beyond about a million characters.
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{65536,}")


def whole_text_encoder(coder: tiktoken.Encoding, special: bool) -> Callable[[str], list[int]]:
    """Encoder of texts with white space of any length: a long stretch is cut where the pattern cuts it.

    Before a word the pattern leaves the last white space character to what follows; before
    an added token (with ``special``) and at the end of the text it does not.
    """
    names = tuple(coder.special_tokens_set) if special else ()

    def plain(text: str) -> list[int]:
        return coder.encode(text, allowed_special="all") if special else coder.encode_ordinary(text)

    def encode(text: str) -> list[int]:
        if len(text) < 65536 or not _LONG_SPACE.search(text):
            return plain(text)
        ids, at = [], 0
        for found in _LONG_SPACE.finditer(text):
            whole = found.end() == len(text) or (names and text.startswith(names, found.end()))
            end = found.end() if whole else found.end() - 1
            ids += plain(text[at : found.start()]) + coder._encode_single_piece(text[found.start() : end])
            at = end
        return ids + plain(text[at:])

    return encode
