"""Token ids of whole texts through a cache of words.

The tokenizer's rules never join text across ASCII white space, so a text's
ids are its words' ids in a row; each distinct word of a batch goes through
the tokenizer once and then stays in a bounded cache of the worker."""

from __future__ import annotations

import json
import os
import re
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words in one of the two generations of a worker's cache, and pieces.
CACHE_WORDS, CACHE_PIECES = 120_000, 350_000
#: Unknown words that are joined into one text for the tokenizer.
JOINED_WORDS = 2_000


#: FIXED VALUES of the word-end BPE file: what it does to a text before BPE.
#: For such a tokenizer a word of Latin-1 letters, with ASCII punctuation
#: behind it or not, is lower-cased and goes to BPE as one or two pieces.
PLAIN_RULES = ("NFC", "Replace", "Lowercase",
               r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

_PLAIN_WORD = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")


def _byte_letters() -> dict[int, str]:
    """The public byte-level alphabet: printable Latin-1 stands for itself, the
    other bytes for the code points from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordTokens:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        rules = json.loads(self.tokenizer.to_str())
        self.plain = PLAIN_RULES == (
            *[n.get("type") for n in (rules["normalizer"] or {}).get("normalizers", [])],
            *[p["pattern"]["Regex"] for p in (rules["pre_tokenizer"] or {}).get("pretokenizers", []) if "pattern" in p])
        self.alphabet = _byte_letters()
        self.known: dict[str, bytes] = {"": b""}
        self.older: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        letters = piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.alphabet)
        ids = array("H" if self.dtype.itemsize == 2 else "I", [t.id for t in self.tokenizer.model.tokenize(letters)])
        self.pieces[piece] = out = ids.tobytes()
        return out

    def _encode(self, words: list[str]) -> None:
        if self.plain:
            other, piece, known, plain, cached = [], self._piece, self.known, _PLAIN_WORD.fullmatch, self.pieces.get
            for w in words:
                if (m := plain(w)) is None:
                    other.append(w)
                    continue
                head, tail = m.groups()
                head = head.lower()
                ids = cached(head) or piece(head)
                known[w] = ids + (cached(tail) or piece(tail)) if tail else ids
            words = other
        for i in range(0, len(words), JOINED_WORDS):
            part = words[i:i + JOINED_WORDS]
            lengths = np.fromiter(map(len, part), np.int64, len(part))
            starts = np.cumsum(lengths + 1) - lengths - 1
            got = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids = np.array(got.ids, self.dtype)
            begins = np.fromiter((a for a, _ in got.offsets), np.int64, len(ids))
            cuts = np.searchsorted(begins, starts[1:]) * self.dtype.itemsize
            raw, at = ids.tobytes(), [0, *cuts.tolist(), ids.nbytes]
            self.known.update(zip(part, (raw[a:b] for a, b in zip(at, at[1:]))))

    def of(self, words: list[str]) -> list[bytes]:
        """The ids of each word, as little-endian numbers."""
        if len(self.known) > CACHE_WORDS:
            self.older, self.known = self.known, {"": b""}
            if len(self.pieces) > CACHE_PIECES:
                self.pieces = {}
        known, older = self.known, self.older
        out = list(map(known.get, words))
        missing = [w for w, ids in zip(words, out) if ids is None]
        if missing:
            found = list(map(older.get, missing))
            known.update((w, ids) for w, ids in zip(missing, found) if ids is not None)
            self._encode([w for w, ids in zip(missing, found) if ids is None])
            out = list(map(known.get, words))
        return out

    def texts(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a string column and each row's end among them; null
        counts as empty."""
        words = pc.ascii_split_whitespace(pc.fill_null(column, ""))
        coded = words.flatten().dictionary_encode()
        per_word = self.of(coded.dictionary.to_pylist())
        length = np.fromiter(map(len, per_word), np.int32, len(per_word)) // np.int32(self.dtype.itemsize)
        flat = np.frombuffer(b"".join(per_word), self.dtype)
        index = coded.indices.to_numpy()
        counts = length[index]
        ends = np.cumsum(counts, dtype=np.int64)
        shift = (np.cumsum(length, dtype=np.int64) - length)[index] - (ends - counts)
        ids = flat[np.repeat(shift, counts) + np.arange(ends[-1] if len(ends) else 0)]
        word_ends = np.cumsum(pc.list_value_length(words).to_numpy())
        return ids, np.concatenate([[0], ends])[word_ends]


@lru_cache(maxsize=2)
def word_tokens(path: str) -> WordTokens:
    """One per worker process and tokenizer file."""
    return WordTokens(path)
