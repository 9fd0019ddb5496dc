"""Encoders of rank files, loaded once in each worker."""

from __future__ import annotations

import base64

import tiktoken

_encodings: dict[tuple[str, str], tiktoken.Encoding] = {}


def encoding(path: str, pattern: str) -> tiktoken.Encoding:
    """The byte-level BPE of a rank file; ``pattern`` splits text before the merges."""
    key = path, pattern
    if key not in _encodings:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encodings[key] = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _encodings[key]
