"""Encoding many texts with a tokenizer of the ``tokenizers`` or ``sentencepiece`` library, repeated pieces once.

Texts are cut where the tokenizer surely ends a token: before a space between two visible characters, between a
letter and a punctuation mark, and between a single line end and a letter. The distinct pieces of a block of
texts are found by Arrow and encoded by the library, each as a text of its own, and their ids are put together.
Whether a tokenizer can be cut there is read from its own file; one that can not gets whole texts. Pieces met
before come from a bounded memo that a worker keeps from task to task; it decides the time and never the ids.
"""

from __future__ import annotations

import functools
import json
import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

MEMO_PIECES = 500_000
BYTE_PIECES = 900_000  # their ids take less room than what else is kept of a piece
MEMO_BYTES = 64
LINES = 4096
_MARKS = b".,;:!?"
# Byte classes. Only visible ASCII and U+00C0 to U+00FF (lead byte C3) count as visible, so that the cuts do not
# depend on a library's Unicode version; the two signs among the latter (C3 97, C3 B7) are no letters.
_LEAD = 0xC3
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = True
_SIGNS = (0x97, 0xB7)
_ONE_LINE = re.compile(rb" ?(?:[!-~]|\xc3[\x80-\xbf])+\Z")
_MARK = np.zeros(256, bool)
_MARK[list(_MARKS)] = True


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Places, with 0 and the end, at which the texts ``data[bounds[i]:bounds[i + 1]]`` are cut into pieces."""
    n = len(data)
    if n == 0:
        return np.zeros(1, np.int64)
    lead = data == _LEAD
    sign = np.zeros(n, bool)  # lead bytes of the two signs
    sign[:-1] = lead[:-1] & ((data[1:] == _SIGNS[0]) | (data[1:] == _SIGNS[1]))
    starts_visible = _VISIBLE[data] | lead
    starts_letter = _LETTER[data] | (lead & ~sign)
    ends_visible, ends_letter = _VISIBLE[data], _LETTER[data]
    ends_visible[1:] |= lead[:-1]
    ends_letter[1:] |= lead[:-1] & ~sign[:-1]
    cut = np.zeros(n + 1, bool)
    space, line = data == 0x20, data == 0x0A
    if n > 2:
        cut[1:n - 1] = space[1:-1] & ends_visible[:-2] & starts_visible[2:]
        cut[2:n] |= starts_letter[2:] & line[1:-1] & ends_visible[:-2]
    last = bounds[1:][np.diff(bounds) > 0] - 1
    cut[last[space[last]]] = False  # a space at a text's end is followed by nothing
    cut[1:n] |= _MARK[data[1:]] & ends_letter[:-1]
    cut[bounds] = True
    cut[[0, n]] = True
    return np.flatnonzero(cut)


class Distinct:
    """The distinct pieces of a block of texts, and which of them each text is made of."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, whole: bool = False):
        """With ``whole`` each text is one piece."""
        at = np.unique(np.concatenate(([0], bounds, [len(data)]))) if whole else cuts(data, bounds)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
        coded = pieces.dictionary_encode()
        self.pieces: list[bytes] = coded.dictionary.to_pylist()
        self.index = coded.indices.to_numpy(zero_copy_only=False)
        self.first = np.searchsorted(at, bounds)  # of each text, and the end


def gather(index: np.ndarray, begin: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``values[begin[i]:begin[i + 1]]`` for each i of ``index``, one after another; and where each starts, with the end."""
    sizes = np.diff(begin)[index]
    out = np.concatenate(([0], np.cumsum(sizes)))
    place = np.repeat(begin[index] - out[:-1], sizes)
    place += np.arange(out[-1])
    return values[place], out


class Memo(dict):
    """Results of short pieces; emptied when it holds too many."""

    def trim(self, fresh: list[bytes], most: int | None = None, keep: Sequence[bytes] = ()) -> None:
        """Forget the long ones among ``fresh``, and everything but ``keep`` when there is too much."""
        if len(self) > (most or MEMO_PIECES):
            kept = {key: self[key] for key in keep if len(key) <= MEMO_BYTES}
            self.clear()
            self.update(kept)
            return
        for key in fresh:
            if len(key) > MEMO_BYTES:
                self.pop(key, None)


class ByteBpe:
    """A tokenizer file of the ``tokenizers`` library."""

    def __init__(self, path: str, plain_special: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_special
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        split = spec.get("pre_tokenizer") or {}
        added = [] if plain_special else [t["content"] for t in spec.get("added_tokens") or []]
        line_end = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line_end = line_end[0] if line_end else -1
        # These regular expressions end a token at each of the cuts, whatever stands on either side of it.
        self.cuts = (split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space", True)
                     and spec.get("normalizer") is None and spec["model"]["type"] == "BPE" and not spec["model"].get("dropout")
                     and len(line_end) == 1 and not any(re.search(r"[\s.,;:!?]", t) for t in added))
        self.size = self.tokenizer.get_vocab_size()
        self.memo = Memo()

    def library(self, texts: list[str]) -> list[bytes]:
        """Ids of each text by the library alone, as little-endian unsigned 32-bit integers."""
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def pieces(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces as of texts of their own; those of one line go to the library together, a line each."""
        out: dict[bytes, bytes] = {}
        lines = [p for p in pieces if _ONE_LINE.match(p) is not None]
        for at in range(0, len(lines), LINES):
            some = lines[at:at + LINES]
            data = self.library([b"".join([b"\n".join(some), b"\n"]).decode("utf-8", "replace")])[0]
            ends = np.flatnonzero(np.frombuffer(data, "<u4") == self.line_end)
            if len(ends) == len(some):
                ends = (4 * ends).tolist()
                out.update((p, data[a + 4:b]) for p, a, b in zip(some, [-4, *ends], ends))
        rest = [p for p in pieces if p not in out]
        out.update(zip(rest, self.library([p.decode("utf-8", "replace") for p in rest])))
        return [out[p] for p in pieces]

    def known(self, block: Distinct) -> list[bytes]:
        """Ids of the block's pieces. What stays in a full memo is what the block has more than once."""
        fresh = [p for p in block.pieces if p not in self.memo]
        self.memo.update(zip(fresh, self.pieces(fresh)))
        found = [self.memo[p] for p in block.pieces]
        often = np.flatnonzero(np.bincount(block.index, minlength=len(found)) > 1) if len(self.memo) > BYTE_PIECES else ()
        self.memo.trim(fresh, BYTE_PIECES, [block.pieces[i] for i in often])
        return found

    def encode(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after another, equal to those of :meth:`library`; and where each text's begin, with the end."""
        block = Distinct(data, bounds, whole=not self.cuts)
        found = self.known(block)
        begin = np.concatenate(([0], np.cumsum(np.fromiter(map(len, found), np.int64, len(found))))) // 4
        ids, at = gather(block.index, begin, np.frombuffer(b"".join(found), "<u4"))
        return ids, at[block.first]


class PieceBpe:
    """A ``sentencepiece`` model that puts a space in front of a text."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        names = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # No merge crosses a cut if no entry goes on after a word's end, has a mark after a letter, or has a line
        # end; nothing but the space in front may be changed, and a line end and what follows it are apart.
        within = not any(re.search("[^▁]▁|[A-Za-zÀ-ÖØ-öø-ÿ][.,;:!?]|\n", name) for name in names)
        plain = [self.model.encode(x, out_type=str) for x in ("a", "a  b ", "\n.")]
        self.cuts = within and ["".join(p).replace("▁", " ") for p in plain] == [" a", " a  b ", " <0x0A>."]
        self.lead = len(self.model.encode("\n")) if self.cuts else 0
        self.bytes = [self._bytes(i, name) for i, name in enumerate(names)]

    def _bytes(self, i: int, name: str) -> bytes:
        if self.model.is_byte(i):
            return bytes([int(name[3:5], 16)])
        return name.replace("▁", " ").encode()

    def pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of the pieces of texts that begin with the space the model would add."""
        texts = [p.decode("utf-8", "replace") for p in pieces]
        own = [t[0] != " " for t in texts]  # a piece inside a word: after a line end instead of a space
        ids = self.model.encode([f"\n{t}" if o else t[1:] for t, o in zip(texts, own)], num_threads=1)
        return [i[self.lead:] if o else i for i, o in zip(ids, own)]


@functools.cache
def byte_level() -> dict[str, int]:
    """The byte for which a character of a byte-level vocabulary stands: visible Latin-1 for itself, the others from U+0100 on."""
    visible = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(0x100 + k): b for k, b in enumerate(hidden)}


@functools.cache
def byte_bpe(path: str, plain_special: bool = False) -> ByteBpe:
    """One per worker, so that its memo outlives the task."""
    return ByteBpe(path, plain_special)


@functools.cache
def piece_bpe(path: str) -> PieceBpe:
    return PieceBpe(path)
