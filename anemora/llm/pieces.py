"""Texts cut where tokenizers cut them anyway, so that a repeated piece is encoded once per worker."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa

#: Pieces a worker remembers; beyond it those met in one batch only are forgotten.  A cost setting, results do not depend on it.
REMEMBERED = 600_000
#: Bytes of pieces that are encoded as one text.
JOINED = 8_192

_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
# First bytes of characters that are surely not white space; leading bytes C2 and E1 to E3 also begin white space.
_SOLID = np.zeros(256, bool)
_SOLID[[*range(0x21, 0x7F), *range(0xC3, 0xE1), *range(0xE4, 0xF5)]] = True


def cut(raw: np.ndarray, offsets: np.ndarray, marks: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Bounds of all pieces of the texts, and the first piece of each text (one entry more than texts).

    A piece ends before a lone space that something solid follows.  Byte-level BPE over the
    usual word pattern starts a word there, and a piece vocabulary in which no piece has a
    space after another character never merges across it.  With ``marks`` a piece also ends between an
    ASCII letter and an ASCII mark; only the word pattern of the former does that.
    """
    here = np.zeros(len(raw) + 1, bool)
    if len(raw) > 2:
        here[1:-2] = (raw[1:-1] == 32) & (raw[:-2] != 32) & _SOLID[raw[2:]]
        if marks:
            here[1:-2] |= _LETTER[raw[:-2]] & _MARK[raw[1:-1]]
    here[offsets] = True
    bounds = np.flatnonzero(here)
    return bounds, np.searchsorted(bounds, offsets)


def distinct(raw: np.ndarray, bounds: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """The distinct pieces, and each piece's number among them."""
    if len(bounds) < 2:
        return [], np.zeros(0, np.int64)
    column = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds.astype(np.int64)), pa.py_buffer(raw)])
    coded = column.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices).astype(np.int64)


def spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions of all ranges ``start .. start + count``, one after the other."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))


def sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs that start at ``first`` (one entry more than runs; runs may be empty)."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]


class Rows:
    """Growing rows of different lengths in one array."""

    def __init__(self, dtype):
        self.flat, self.used = np.zeros(1024, dtype), 0
        self.start, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, flat: np.ndarray, counts: np.ndarray) -> None:
        if self.used + len(flat) > len(self.flat):
            grown = np.zeros(2 * (self.used + len(flat)), self.flat.dtype)
            grown[:self.used] = self.flat[:self.used]
            self.flat = grown
        self.flat[self.used:self.used + len(flat)] = flat
        self.start = np.concatenate([self.start, self.used + np.cumsum(counts) - counts])
        self.count = np.concatenate([self.count, counts])
        self.used += len(flat)

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        counts = self.count[rows]
        return self.flat[spread(self.start[rows], counts)], counts

    def keep(self, rows: np.ndarray) -> None:
        flat, counts = self.take(rows)
        self.__init__(self.flat.dtype)
        self.add(flat, counts)


class Memory:
    """What is known of each piece, as rows of several kinds; ``build`` makes the rows of new pieces."""

    def __init__(self, build: Callable[[list[bytes]], list[tuple[np.ndarray, np.ndarray]]], kinds: list, limit: int = REMEMBERED):
        self.build, self.limit = build, limit
        self.known: dict[bytes, int] = {}
        self.met = np.zeros(0, np.int32)
        self.kinds = [Rows(k) for k in kinds]

    def find(self, pieces: list[bytes]) -> np.ndarray:
        """The row number of each of these distinct pieces; numbers hold until the next call."""
        if len(self.known) > self.limit:
            self._forget()
        known = self.known
        at = np.fromiter((known.get(p, -1) for p in pieces), np.int64, len(pieces))
        new = np.flatnonzero(at < 0)
        if len(new):
            fresh = [pieces[i] for i in new.tolist()]
            for rows, made in zip(self.kinds, self.build(fresh)):
                rows.add(*made)
            at[new] = len(known) + np.arange(len(new))
            known.update(zip(fresh, at[new].tolist()))
            self.met = np.concatenate([self.met, np.zeros(len(new), np.int32)])
        self.met[at] += 1
        return at

    def _forget(self) -> None:
        again = self.met > 1
        if again.sum() > self.limit // 2:
            again[:] = False
        self.known = {p: i for i, p in enumerate(p for p, stays in zip(self.known, again.tolist()) if stays)}
        rows = np.flatnonzero(again)
        for kind in self.kinds:
            kind.keep(rows)
        self.met = np.zeros(len(rows), np.int32)


# --- the vocabularies ---


@cache
def byte_level() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: visible Latin-1 as itself, the others from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class ByteBpe:
    """Byte-level BPE of a tokenizers file: ``token[i]`` are the bytes of id i, ``size[i]`` their number."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a Spark task has one core
        from tokenizers import Tokenizer

        self.model = Tokenizer.from_file(path)
        self.model.encode_special_tokens = True
        byte = byte_level()
        self.token = [b""] * self.model.get_vocab_size(with_added_tokens=True)
        special = self.model.get_added_tokens_decoder()
        for word, i in self.model.get_vocab(with_added_tokens=True).items():
            self.token[i] = word.encode() if i in special else bytes(byte[c] for c in word)
        self.size = np.array([len(t) for t in self.token], np.int64)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and ids per piece.

        Pieces that start with a lone space are joined, as a word starts there; ids are parted again by their bytes.
        """
        sizes = np.array([len(p) for p in pieces], np.int64)
        joins = np.fromiter((len(p) > 1 and p[0] == 32 and bool(_SOLID[p[1]]) for p in pieces), bool, len(pieces))
        order = np.concatenate([np.flatnonzero(joins), np.flatnonzero(~joins)])
        texts, many, run = [], int(joins.sum()), np.cumsum(sizes[order])
        edges = [*(np.searchsorted(run[:many], np.arange(0, run[many - 1] if many else 0, JOINED)).tolist()), many]
        for a, b in zip(edges, edges[1:]):
            if b > a:
                texts.append(b"".join([pieces[i] for i in order[a:b].tolist()]).decode())
        texts += [pieces[i].decode() for i in order[many:].tolist()]
        ids = np.fromiter((i for e in self.model.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids), np.int32)
        ends = np.searchsorted(np.cumsum(self.size[ids]), run, side="right")
        counts = np.empty(len(pieces), np.int64)
        counts[order] = np.diff(ends, prepend=0)
        if int(self.size[ids].sum()) != int(sizes.sum()):
            raise ValueError("ids do not spell the texts")
        place = np.empty(len(pieces), np.int64)
        place[order] = ends - counts[order]
        return ids[spread(place, counts)], counts


class PieceBpe:
    """A sentencepiece model with byte fallback; it adds a space before the text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("pieces with a space after another character are not supported")
        self.token = [bytes([int(n[3:5], 16)]) if self.model.is_byte(i) else b"" if self.model.is_control(i) else n.replace("▁", " ").encode()
                      for i, n in enumerate(names)]
        self.size = np.array([len(t) for t in self.token], np.int64)

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces, and ids per piece; the space that a piece starts with is the one the model adds."""
        made = self.model.encode([p[1:].decode() for p in pieces], num_threads=1)
        counts = np.fromiter((len(m) for m in made), np.int64, len(made))
        return np.fromiter((i for m in made for i in m), np.int32, int(counts.sum())), counts


@cache
def vocabulary(kind: type, path: str):
    """A worker's vocabulary of a file."""
    return kind(path)


def default_path(name: str) -> str:
    """A vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))
