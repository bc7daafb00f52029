"""Cut texts where no token can cross, so that equal pieces are tokenised once.

The splitting pattern of the public byte-level vocabularies starts a new match
wherever white space follows another character, wherever letters and other
signs meet (but for contractions after an apostrophe), and after a line break
that is the only white space there. Such cuts are found here on the bytes, at
printable ASCII only, where that is certain; the pieces of a batch are then dictionary-encoded by Arrow, and a tokenizer
sees each distinct piece once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from paylake.llm import words as W

_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = True
_SIGN = _PLAIN & ~_LETTER
_SIGN[0x30:0x3A] = False
_OPENING = _SIGN.copy()
_OPENING[0x27] = False


def distinct_pieces(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(distinct pieces, piece number of every piece in order, pieces per row)."""
    data, offs = W.buffer_of(texts)
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n:
        here, prior = data[1:], data[:-1]
        plain = _PLAIN[data]
        cut[1:n] = (plain[:-1] & W.WHITE[here]) | (_LETTER[prior] & _SIGN[here]) | (_OPENING[prior] & _LETTER[here])
        cut[2:n] |= (data[1:-1] == 10) & plain[:-2] & plain[2:]
        cut[offs[offs < n]] = True
    at = np.flatnonzero(cut[:n])
    pieces = W.binary_array(data, np.concatenate((at, [n])).astype(np.int64) if n else np.zeros(1, np.int64))
    coded = pc.dictionary_encode(pieces)
    per_row = np.diff(np.searchsorted(at, offs))
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), per_row


class Recent:
    """What is known of pieces, in two generations: when the new one is full it
    becomes the old one, and pieces met again move over. So memory is bounded
    and common pieces stay."""

    def __init__(self, most: int):
        self.most = most
        self.new: dict[bytes, object] = {}
        self.old: dict[bytes, object] = {}

    def missing(self, pieces: list[bytes]) -> list[bytes]:
        """The pieces that must be added before ``values`` is called."""
        if len(self.new) > self.most:
            self.old, self.new = self.new, {}
        out = []
        for p in pieces:
            if p not in self.new:
                known = self.old.get(p)
                if known is None:
                    out.append(p)
                else:
                    self.new[p] = known
        return out

    def values(self, pieces: list[bytes]) -> list:
        return [self.new[p] for p in pieces]
