"""SentencePiece encoding with seeded merge-dropout, and decoding.

Pieces of a merge-type (BPE) model are built from characters: an agenda holds the possible merges
of neighbours, best score first, leftmost among equals. Here each merge that comes up is skipped
if a keyed hash of the seed, the document, the word's position in its text, the place and the piece
falls below ``DROPOUT``; a skipped merge comes back only if a neighbour changes. So every occurrence
of a word is cut for itself, the same seed always gives the same ids, and all decode to the text.

No piece of such a model holds a space after another character, so a text is cut before its spaces.
The agendas of many words of about one length advance together, a merge each at a time, by array
arithmetic; words longer than ``LONGEST`` have an agenda of their own. Nothing is remembered between
words, and all are cut alike whatever their length.
"""

from __future__ import annotations

import functools
import hashlib
import heapq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

from rallyframe.llm.words import LONGEST, slices

DROPOUT = 0.1
SEED = 1
_SPACE = "▁"
#: Words advance together with others up to the next of these lengths, so many at a time.
_WIDTHS, _ROWS = (3, 4, 5, 6, 7, 8, 10, 12, 16, 24, 32, 48, 64), 1 << 15
_NONE = np.int32(np.iinfo(np.int32).max)


class Vocabulary:
    """Pieces, ranks, merges and bytes of a SentencePiece model file.

    A symbol is the id of a piece, or ``size`` and a code point for a character that is no piece.
    """

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        pieces, scores, self.bytes_of = {}, np.zeros(self.size), []
        self.byte_id = np.zeros(256, dtype=np.int32)
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes_of.append(b"")
            else:
                pieces[piece] = i
                scores[i] = model.get_score(i)
                self.bytes_of.append(piece.replace(_SPACE, " ").encode())
        #: Best score first; equal scores have one rank.
        self.rank = np.unique(-scores, return_inverse=True)[1].astype(np.int32)

        def symbol(piece: str) -> int | None:
            return pieces.get(piece, self.size + ord(" " if piece == _SPACE else piece) if len(piece) == 1 else None)

        self.symbols = np.arange(self.size, self.size + 0x110000, dtype=np.int32)
        for piece in pieces:
            if len(piece) == 1 and piece != _SPACE:
                self.symbols[ord(piece)] = pieces[piece]
        # A literal low block is no space: it is spelt in bytes, as any unknown character is.
        self.symbols[ord(" ")] = symbol(_SPACE)
        self.merges: dict[int, int] = {}
        for piece, i in pieces.items():
            for at in range(1, len(piece)):
                left, right = symbol(piece[:at]), symbol(piece[at:])
                if left is not None and right is not None:
                    self.merges[left << 32 | right] = i
        self._fill()
        ends = np.cumsum([0, *map(len, self.bytes_of)])
        self._spelt, self._begins, self._many = np.frombuffer(b"".join(self.bytes_of), np.uint8), ends[:-1], np.diff(ends)

    def _fill(self) -> None:
        """A table of the merges, open to arrays of pairs: each in the first free place from its hash on."""
        keys = np.fromiter(self.merges, dtype=np.int64, count=len(self.merges))
        made = np.fromiter(self.merges.values(), dtype=np.int32, count=len(self.merges))
        self._bits = max(8, int(len(keys) * 4).bit_length())
        self._keys, self._made = np.full(1 << self._bits, -1, dtype=np.int64), np.full(1 << self._bits, -1, dtype=np.int32)
        left, self._probes = np.arange(len(keys)), 0
        while len(left):
            slot = self._slot(keys[left], self._probes)
            first = np.unique(slot, return_index=True)[1]
            first = first[self._keys[slot[first]] < 0]
            self._keys[slot[first]], self._made[slot[first]] = keys[left[first]], made[left[first]]
            left = np.delete(left, first)
            self._probes += 1

    def _slot(self, keys: np.ndarray, probe: int) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self._bits)
        return (h.astype(np.int64) + probe) & ((1 << self._bits) - 1)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The pieces that neighbours merge to, -1 where they don't."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys, 0)
        there = self._keys[slot]
        out = np.where(there == keys, self._made[slot], np.int32(-1))
        left_over = np.flatnonzero((there != keys) & (there >= 0))
        for probe in range(1, self._probes):
            if not len(left_over):
                break
            slot = self._slot(keys[left_over], probe)
            there = self._keys[slot]
            on = there == keys[left_over]
            out[left_over[on]] = self._made[slot[on]]
            left_over = left_over[~on & (there >= 0)]
        return out

    def segment(self, symbols: list[int], skipped=None) -> list[tuple[int, int]]:
        """Where each symbol of one word begins in the end, and it. ``skipped`` tells of (place, piece)."""
        n, symbols = len(symbols), list(symbols)
        end = list(range(1, n + 1))  # where the symbol that begins here ends; 0 once it is merged away
        back = list(range(-1, n - 1))
        agenda: list[tuple[int, int, int, int]] = []

        def propose(a: int, b: int) -> None:
            made = self.merges.get(symbols[a] << 32 | symbols[b])
            if made is not None:
                heapq.heappush(agenda, (int(self.rank[made]), a, end[b], made))

        for i in range(n - 1):
            propose(i, i + 1)
        while agenda:
            _, a, stop, made = heapq.heappop(agenda)
            b = end[a]
            if not b or b >= stop or end[b] != stop or (skipped and skipped(a, made)):
                continue
            symbols[a], end[a], end[b] = made, stop, 0
            if stop < n:
                back[stop] = a
                propose(a, stop)
            if back[a] >= 0:
                propose(back[a], a)
        return [(i, symbols[i]) for i in range(n) if end[i]]

    def spelt(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of symbols, where characters that are no piece are spelt in bytes, and the ids of each symbol."""
        odd = np.flatnonzero(symbols >= self.size)
        many = np.ones(len(symbols), dtype=np.int64)
        if not len(odd):
            return symbols, many
        points, which = np.unique(symbols[odd] - self.size, return_inverse=True)
        spelling = [chr(c).encode() for c in points.tolist()]
        table = self.byte_id[np.frombuffer(b"".join(x.ljust(4, b"\0") for x in spelling), np.uint8)].reshape(-1, 4)
        many[odd] = np.array([len(x) for x in spelling])[which]
        at = np.cumsum(many) - many
        ids = np.empty(many.sum(), dtype=np.int32)
        ids[at[symbols < self.size]] = symbols[symbols < self.size]
        for k in range(4):
            here = many[odd] > k
            ids[at[odd[here]] + k] = table[which[here], k]
        return ids, many

    def decoded(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each text of ids, without the space that encoding puts in front."""
        many = self._many[ids]
        before = np.concatenate([[0], np.cumsum(many)])
        spelt = self._spelt[np.repeat(self._begins[ids] - before[:-1], many) + np.arange(before[-1])]
        at = before[bounds]
        return [spelt[a + 1 : b].tobytes() for a, b in zip(at[:-1], at[1:])]

    def decode(self, ids) -> str:
        """The text of ids, without the space that encoding puts in front."""
        return b"".join(map(self.bytes_of.__getitem__, ids))[1:].decode()


@functools.lru_cache(maxsize=1)
def vocabulary(path: str) -> Vocabulary:
    """A worker's vocabulary of a model file."""
    return Vocabulary(path)


def _salt(place, piece):
    """A number of a place in a word and a piece; 64 bits of Python ints or of arrays."""
    if isinstance(place, int):
        return (place * 0x9E3779B97F4A7C15 ^ piece * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF
    return place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ piece.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)


def _mixed(h: np.ndarray) -> np.ndarray:
    """64-bit hashes, mixed (the last steps of MurmurHash3)."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


class DropoutCodec:
    """Encodes arrays of texts under one key."""

    def __init__(self, vocabulary: Vocabulary, dropout: float, key: int):
        self.vocabulary, self.dropout, self.key = vocabulary, dropout, key
        self.limit = np.uint64(int(dropout * (1 << 32)))

    def _skipped(self, own: np.ndarray, place: np.ndarray, piece: np.ndarray) -> np.ndarray:
        return _mixed(own ^ _salt(place, piece)) >> np.uint64(32) < self.limit

    def _together(self, symbols: np.ndarray, many: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Runs the agendas of words, a row of ``symbols`` each; ``many`` is how long each is.

        Returns the symbols, and which places begin one in the end.
        """
        rows, width = symbols.shape
        rank, merged = self.vocabulary.rank, self.vocabulary.merged
        place = np.tile(np.arange(width, dtype=np.int32), rows)
        begins = (place.reshape(rows, width) < many[:, None]).ravel()
        after, before = place + 1, place - 1  # the places of the neighbours
        symbol = symbols.ravel().copy()
        made = np.full(rows * width, -1, dtype=np.int32)
        agenda = np.full(rows * width, _NONE, dtype=np.int32)

        def propose(left: np.ndarray, right: np.ndarray) -> None:
            made[left] = merged(symbol[left], symbol[right])
            agenda[left] = np.where(made[left] >= 0, rank[made[left]], _NONE)

        pairs = np.flatnonzero(begins & (after < np.repeat(many, width)))
        propose(pairs, pairs + 1)
        going = np.arange(rows)
        while True:
            open_ = agenda.reshape(rows, width)[going]
            at = open_.argmin(axis=1)
            on = open_[np.arange(len(going)), at] < _NONE
            going, at = going[on], at[on]
            if not len(going):
                return symbol, begins
            row, a = going, going * width + at
            if self.limit:
                skip = self._skipped(own[row], at, made[a])
                agenda[a[skip]] = _NONE
                row, at, a = row[~skip], at[~skip], a[~skip]
            b = row * width + after[a]
            symbol[a], begins[b], agenda[b], agenda[a] = made[a], False, _NONE, _NONE
            stop = after[a] = after[b]
            more = stop < many[row]
            c = (row * width + stop)[more]
            before[c] = at[more]
            propose(a[more], c)
            first = before[a] >= 0
            propose((row * width + before[a])[first], a[first])

    def encode(self, texts: pa.Array, doc_ids: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts together, and the n + 1 bounds of each text's ids. Nulls count as empty.

        A text is told from others by its doc_id; without any, by none.
        """
        strings = [t or "" for t in texts.to_pylist()]
        points = np.frombuffer("".join(strings).encode("utf-32-le"), dtype="<u4")
        of_text = np.concatenate([[0], np.cumsum([len(t) for t in strings], dtype=np.int64)])
        space = points == ord(" ")
        cut = space.copy()
        cut[1:] &= ~space[:-1]
        cut[of_text[:-1][np.diff(of_text) > 0]] = True
        words = np.flatnonzero(cut)
        lengths = np.diff(words, append=len(points))
        bounds = np.searchsorted(words, of_text)
        per = np.diff(bounds)
        owners = [xxhash.xxh64_intdigest(repr(d).encode(), self.key) for d in doc_ids or [None] * len(strings)]
        nth = (np.arange(len(words)) - np.repeat(bounds[:-1], per)).astype(np.uint64)
        own = _mixed(np.repeat(np.array(owners, dtype=np.uint64), per) + nth * np.uint64(0x9E3779B97F4A7C15))
        symbols = self.vocabulary.symbols[points]
        begins = np.ones(len(points), dtype=bool)
        low = 1  # a word of one character has no merges
        for width in (w for w in _WIDTHS if w <= LONGEST):
            of_width = np.flatnonzero((lengths > low) & (lengths <= width))
            low = width
            for i in range(0, len(of_width), _ROWS):
                some = of_width[i : i + _ROWS]
                many = lengths[some]
                inside = np.arange(width) < many[:, None]
                at = np.minimum(words[some][:, None] + np.arange(width), len(points) - 1)
                symbol, first = self._together(symbols[at], many, own[some])
                symbols[at[inside]], begins[at[inside]] = symbol[inside.ravel()], first[inside.ravel()]
        for i in np.flatnonzero(lengths > low).tolist():
            w, n, mine = int(words[i]), int(lengths[i]), own[i : i + 1]
            skipped = (lambda place, piece: bool(self._skipped(mine, np.array([place]), np.array([piece]))[0])) if self.limit else None
            begins[w : w + n] = False
            for place, symbol in self.vocabulary.segment(symbols[w : w + n].tolist(), skipped):
                symbols[w + place], begins[w + place] = symbol, True
        before = np.concatenate([[0], np.cumsum(begins)])
        ids, many = self.vocabulary.spelt(symbols[begins])
        return ids, np.concatenate([[0], np.cumsum(many)])[before[of_text]]


def encode_array(codec: DropoutCodec, doc_ids: list, texts: pa.Array) -> list[np.ndarray]:
    """Ids of each text. Nulls and empty texts have none."""
    ids, ends = _encoded(codec, doc_ids, texts)
    return [ids[a:b] for a, b in zip(ends[:-1], ends[1:])]


def _encoded(codec: DropoutCodec, doc_ids: list, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return codec.encode(pa.array([None if not t else " " + t for t in texts.to_pylist()], pa.large_string()), doc_ids)


def encoded(docs: DataFrame, model: str, dropout: float = DROPOUT, seed: int = SEED) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256, lossless of each (doc_id, text).

    decoded_sha256 is that of the text decoded from the ids, and lossless whether it equals the
    document's. A null text counts as empty, which has no ids. Repeated rows are encoded alike, and
    so are equal texts whose doc_id is null; a text of any length is encoded whole, its words some
    thousands at a time; other columns are ignored; an empty table gives no rows.
    """

    def encode(batches):
        own = vocabulary(model)
        codec = DropoutCodec(own, dropout, seed)
        for batch in batches:
            for piece in slices(batch, 1):
                ids, ends = _encoded(codec, piece.column(0).to_pylist(), piece.column(1))
                back = own.decoded(ids, ends)
                texts = [(t or "").encode() for t in piece.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0),
                        pa.array(np.diff(ends), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))),
                        pa.array([hashlib.sha256(b).hexdigest() for b in back]),
                        pa.array([a == b for a, b in zip(back, texts)]),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded_sha256", "lossless"],
                )

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>, decoded_sha256 string, lossless boolean")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: every document's ids under seeded merge-dropout, decoded again."""
    import public_tokenizers

    return encoded(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("piece_bpe_32k.model"))
