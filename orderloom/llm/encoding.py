"""Token ids of texts, and the bytes of each id, under a tokenizer file.

Byte-level BPE files go through the merge ranks in that file, which give the library's
ids faster; texts that the fast encoder gives up on, and other files, go to the library.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Callable, Sequence

import numpy as np

from .token_counts import BYTE_LEVEL_PATTERN, byte_characters, merge_ranks

# Ids of texts; None where a check was asked for and failed.
Encode = Callable[[list[str]], list[np.ndarray | None]]
BYTE_PIECE = re.compile(r"<0x([0-9A-F]{2})>")
SPACE = "▁"


def checked(ids: Sequence[int], of: list[bytes] | None, text: str) -> np.ndarray | None:
    """The ids, or None if their bytes (`of` each id) aren't the text's."""
    if of is not None:
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        if b"".join(map(of.__getitem__, ids)) != text.encode():
            return None
    return np.asarray(ids, dtype=np.int64)


def id_encoder(name: str, data: bytes, special: bool = True, check: bool = False) -> Encode:
    """Ids of whole texts, without added begin or end tokens.  `special`: strings of special
    tokens inside a text are those tokens, as is the library's default; else plain text.
    `check`: None where the ids' bytes aren't the text's (of a .model file, a space's and
    the text's)."""
    of = id_bytes(name, data) if check else None
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [checked(ids, of, " " + t if t else "") for t, ids in zip(texts, pieces.encode(texts, num_threads=1))]
    spec = json.loads(data)
    ranks = merge_ranks(spec)

    @functools.cache
    def library():
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_buffer(data)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        tokenizer.encode_special_tokens = not special
        return tokenizer

    def by_library(text: str) -> Sequence[int]:
        return library().encode_batch([text], add_special_tokens=False)[0].ids

    if ranks is None:
        return lambda texts: [checked(by_library(t), of, t) for t in texts]
    import tiktoken

    known = {t["content"]: t["id"] for t in spec["added_tokens"]}
    encoding = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens=known)
    options = {"allowed_special": "all"} if special else {"disallowed_special": ()}

    def fast(text: str) -> Sequence[int]:
        # Its pattern gives up on runs of about a million spaces; the library does not.
        try:
            return encoding.encode_to_numpy(text, **options)
        except ValueError:
            return by_library(text)

    # Merges of a text's own bytes: no check is needed.
    return lambda texts: [np.asarray(fast(t), dtype=np.int64) for t in texts]


def id_bytes(name: str, data: bytes) -> list[bytes]:
    """The bytes that each id stands for: of a byte-level .json file its entry decoded, of a
    .model file its piece with U+2581 as a space and <0xHH> as that byte."""
    if name.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_proto=data)
        names = [pieces.id_to_piece(i) for i in range(pieces.get_piece_size())]
        found = [BYTE_PIECE.fullmatch(piece) for piece in names]
        return [bytes([int(m[1], 16)]) if m else piece.replace(SPACE, " ").encode() for piece, m in zip(names, found)]
    spec = json.loads(data)
    to_byte = byte_characters()
    special = {t["content"]: t["id"] for t in spec["added_tokens"]}
    entries = {i: bytes(to_byte[c] for c in entry) for entry, i in spec["model"]["vocab"].items() if entry not in special}
    entries |= {i: content.encode() for content, i in special.items()}
    return [entries.get(i, b"") for i in range(max(entries) + 1)]
