"""Texts in pieces between single spaces, encoded once a distinct piece and then looked up."""

from __future__ import annotations

from collections.abc import Callable


class ChunkCache:
    """Values of text pieces in two generations of at most `limit` pieces or one call's, so memory is bounded.

    encode gets the distinct pieces that aren't known yet and returns one value each. Once a generation is full it
    becomes the old one; what is used again moves to the new one, the rest is forgotten with the next change. A piece is
    safe if it isn't empty and neither end is white space: only then does cutting the text before the space leave the
    tokens as they are. A text with any other piece is returned as None and is for the caller to encode whole.
    """

    def __init__(self, encode: Callable[[list[str]], list], limit: int = 200_000) -> None:
        self.encode, self.limit, self.known, self.old = encode, limit, {}, {}

    def look_up(self, texts: list[list[str]]) -> list[list | None]:
        """texts: lists of pieces."""
        if len(self.known) > self.limit:
            self.known, self.old = {}, self.known
        known, old = self.known, self.old
        fresh = set().union(*texts).difference(known)
        again = [c for c in fresh if c in old]
        known.update((c, old[c]) for c in again)
        good = [c for c in fresh.difference(again) if c and not c[0].isspace() and not c[-1].isspace()]
        if good:
            known.update(zip(good, self.encode(good), strict=True))
        out: list[list | None] = []
        for parts in texts:
            try:
                out.append(list(map(known.__getitem__, parts)))
            except KeyError:
                out.append(None)
        return out
