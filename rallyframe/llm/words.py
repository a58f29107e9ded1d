"""Tokenizing whole texts word by word, with the result of whole-text encoding.

Both public tokenizers split a text before they merge, and never merge across the start of white
space. So a text can be cut there, each distinct piece encoded once, and the ids put together by
array arithmetic: the vocabulary of a batch is far smaller than its text. Where white space is
such that a cut could change the ids, the text is encoded whole.
"""

from __future__ import annotations

import functools
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces remembered by a worker; further ones are encoded each time. It changes no result.
CACHE = 900_000
#: Longer pieces are not remembered.
LONGEST = 64
#: A stop or comma after a letter is a piece of its own to both tokenizers.
_STOPS = (".", ",")
#: Bytes of text worked on at a time, unless one text is longer.
SLICE = 4_000_000
_MARK = "\x00"
_SPACE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Runs of white space whose cutting could matter, and what the cut itself uses.
_WHOLE = rf"{_SPACE}{_SPACE}{_SPACE}|{_SPACE}{_SPACE}$|\x00|<\|"
#: Marks the joints when many pieces are encoded at once; no piece holds it (see _WHOLE).
_JOINT = "<|endoftext|>"


class PieceCodec:
    """Encodes arrays of texts to ids as ``Tokenizer.encode(..., add_special_tokens=False)`` does.

    keep_space: white space counts (the byte-level tokenizer); else it is dropped by the tokenizer.
    """

    whole = _WHOLE
    stops = True

    def __init__(self, path: str, keep_space: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.keep_space = keep_space
        self.joint = self.tokenizer.token_to_id(_JOINT)
        self.cache = CACHE
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, dtype=np.uint32)
        self.ends = np.zeros(1, dtype=np.int64)

    def encode_whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _cut(self, texts: pa.Array) -> pa.ListArray:
        if not self.keep_space:
            # This tokenizer lowers all text, so doing it first makes no difference but fewer pieces.
            return pc.ascii_split_whitespace(pc.ascii_lower(texts))
        marked = pc.replace_substring(pc.replace_substring(texts, " ", _MARK + " "), "\n", _MARK + "\n")
        return pc.split_pattern(marked, _MARK)

    def _encode_pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces together, and where each ends."""
        joined = [_JOINT.join(pieces[i : i + 500]) + _JOINT for i in range(0, len(pieces), 500)]
        coded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.concatenate([np.array(c.ids, dtype=np.uint32) for c in coded])
        at = np.flatnonzero(ids == self.joint)
        return ids[ids != self.joint], at - np.arange(len(at))

    def _table(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, ends and the numbers of ``pieces`` among them; what fits is remembered."""
        known = self.known
        new = [p for p in pieces if p not in known]
        learn = [p for p in new if len(p) <= LONGEST][: max(0, self.cache - len(known))]
        if learn:
            ids, ends = self._encode_pieces(learn)
            base = self.ends[-1]
            while base + len(ids) > len(self.ids):
                self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
            self.ids[base : base + len(ids)] = ids
            n = len(known)
            known.update(zip(learn, range(n, n + len(learn))))
            self.ends = np.concatenate([self.ends, base + ends])
        once = [p for p in new if p not in known]
        if not once:
            return self.ids, self.ends, np.fromiter((known[p] for p in pieces), dtype=np.int64, count=len(pieces))
        n, base = len(self.ends) - 1, self.ends[-1]
        ids, ends = self._encode_pieces(once)
        more = dict(zip(once, range(n, n + len(once))))
        number = np.fromiter((known[p] if p in known else more[p] for p in pieces), dtype=np.int64, count=len(pieces))
        return np.concatenate([self.ids[:base], ids]), np.concatenate([self.ends, base + ends]), number

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together, and the n + 1 bounds of each text's ids. Nulls count as empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        whole = np.asarray(pc.match_substring_regex(texts, self.whole))
        easy = pc.if_else(pa.array(~whole), texts, pa.scalar("", pa.large_string()))
        cut = self._cut(easy)
        bounds = np.asarray(cut.offsets) - cut.offsets[0].as_py()
        coded = cut.flatten().dictionary_encode()
        which = np.asarray(coded.indices, dtype=np.int64)
        pieces = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        stems = [p[:-1] if p[-1:] in _STOPS and p[-2:-1].isalpha() else p for p in pieces] if self.stops else pieces
        distinct = list(dict.fromkeys([*stems, *_STOPS] if self.stops else stems))
        place = {p: i for i, p in enumerate(distinct)}
        table_ids, table_ends, number = self._table(distinct)
        stem = np.fromiter((place[p] for p in stems), dtype=np.int64, count=len(stems))
        at = number[stem][which]
        if self.stops:
            tail = np.fromiter((place[p[-1]] if len(p) > len(t) else -1 for p, t in zip(pieces, stems)), dtype=np.int64, count=len(pieces))
            both = np.stack([at, np.where(tail < 0, -1, number[tail])[which]], axis=1).ravel()
            bounds = np.concatenate([[0], np.cumsum(both >= 0)])[2 * bounds]
            at = both[both >= 0]
        starts, lengths = table_ends[at], table_ends[at + 1] - table_ends[at]
        before = np.concatenate([[0], np.cumsum(lengths)])
        ids = table_ids[np.repeat(starts - before[:-1], lengths) + np.arange(before[-1])]
        ends = before[bounds]
        if not whole.any():
            return ids, ends
        parts = [self.encode_whole(texts[i].as_py()) if w else ids[ends[i] : ends[i + 1]] for i, w in enumerate(whole)]
        return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(p) for p in parts])])


@functools.cache
def worker_codec(path: str, keep_space: bool) -> PieceCodec:
    """One codec for all tasks of a Python worker, so that pieces it knows are not encoded again by each task."""
    return PieceCodec(path, keep_space)


def slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """Cuts a batch so that the texts of a slice have about SLICE bytes, at least one row each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    step = np.cumsum(sizes + 1) // SLICE
    starts = np.flatnonzero(np.diff(step, prepend=-1))
    for a, b in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(a, b - a)
