"""Pieces of a public vocabulary, and where they match in words."""

from __future__ import annotations

import base64


def read_pieces(path: str) -> list[bytes]:
    """Pieces of a .tiktoken file in the order of their ranks; all single bytes are among them."""
    with open(path, "rb") as lines:
        ranked = sorted((int(rank), base64.b64decode(piece)) for piece, rank in (line.split() for line in lines if line.strip()))
    return [piece for _, piece in ranked]


class Pieces:
    """Numbers of the pieces, and the prefixes that may still become one."""

    def __init__(self, pieces: list[bytes]):
        self.number = {piece: n for n, piece in enumerate(pieces)}
        self.longest = max(map(len, pieces), default=0)
        self.prefixes = {piece[:k] for piece in pieces for k in range(1, len(piece) + 1)}

    def edges(self, word: bytes) -> list[int]:
        """End, start and number of each piece in ``word``, one after the other, by start."""
        found = []
        number, prefixes = self.number, self.prefixes
        for start in range(len(word)):
            for end in range(start + 1, min(len(word), start + self.longest) + 1):
                part = word[start:end]
                if part not in prefixes:
                    break
                n = number.get(part)
                if n is not None:
                    found += (end, start, n)
        return found
