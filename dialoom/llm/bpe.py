"""Byte-level BPE vocabularies: file access, library encoders per Python worker."""

from __future__ import annotations

import base64
import functools
import re

import numpy as np

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256


def vocabulary_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.cache
def ranks(path: str | None = None) -> dict[bytes, int]:
    with open(path or vocabulary_path(RANKS), "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@functools.cache
def library(path: str | None = None):
    """The ``tokenizers`` encoder of the JSON file."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path or vocabulary_path(VOCABULARY))
    tok.no_truncation()
    tok.no_padding()
    return tok


@functools.cache
def fast_encoder(path: str | None = None):
    """The same vocabulary and the same special string in the quicker library; ids are equal (tested)."""
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks(path), special_tokens={SPECIAL: SPECIAL_ID}
    )


#: From this many white-space characters in a row the quicker library's splitter may run out of stack.
LONG_RUN = 10_000
_LONG_SPACE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % LONG_RUN)


def encode(text: str, path: str | None = None) -> np.ndarray:
    """Ids of a text of any length, special strings taken as such.

    A very long run of white space is cut out: all of it at the end of the text or before a special string,
    else all but its last character, is one pre-token, and what stands before it ends there anyway.
    """
    encoder = fast_encoder(path)
    run = _LONG_SPACE.search(text) if len(text) >= LONG_RUN else None
    if run is None:
        return encoder.encode_to_numpy(text, allowed_special="all")
    parts, at = [], 0
    while run is not None:
        end = run.end() if run.end() == len(text) or text.startswith(SPECIAL, run.end()) else run.end() - 1
        parts.append(encoder.encode_to_numpy(text[at : run.start()], allowed_special="all"))
        parts.append(np.array(encoder._encode_single_piece(text[run.start() : end]), np.uint32))
        at = end
        run = _LONG_SPACE.search(text, run.end())
    parts.append(encoder.encode_to_numpy(text[at:], allowed_special="all"))
    return np.concatenate(parts)
