"""Whole-text token ids from the tokenizers library, at corpus speed.

The library spends most of its time on words it has met before and on building one
result object per text. :class:`Encoder` works on a batch: one scan over its bytes cuts all
texts into pieces, words with the blank before them and other white space; Arrow numbers the
distinct ones; and the ids of all occurrences are gathered from those of the distinct pieces.
A new piece is cut into the units on which the tokenizer works, and the library is asked
only for units that are new. The ids are the library's own, and equal to encoding the text
whole. Texts with characters on whose class regex libraries may differ are given to the
library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

#: Words and units whose ids a worker keeps; later new ones are encoded per batch and not kept.
KEPT_WORDS = 1_000_000
#: Units that are joined into one text for the library.
JOINED = 1_000
#: Bytes of the texts that are cut together (or one longer text).
TOGETHER = 8 << 20

# The published split patterns of the two tokenizers.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# The classes of these patterns among plain characters: Latin letters and general punctuation
# without those that change their length or leave this range when lower-cased.
LETTER, NUMBER = "A-Za-zªµºÀ-ÖØ-öø-ſ", "0-9²³¹¼-¾"
_PLAIN = re.compile("[\\t\\n\\r\\x20-\\x7e\xa1-įı-ſ‐-‧‰-⁞]*").fullmatch


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 13, 32]] = True  # the white space among plain characters
_END_MARKS = frozenset(".,;:!?)")
_END_BYTES = frozenset(b".,;:!?)")


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First bytes of the pieces of plain texts (``bounds`` in their joined bytes), as
    `` ?\\S+|\\s+(?!\\S)|\\s+`` finds them: a word takes one blank before it along, other
    white space before it is a piece, and of that its last character is one of its own."""
    n = len(data)
    starts = np.zeros(n + 1, bool)
    starts[bounds[:-1]] = True
    blank = _BLANK[data]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1  # where words begin or end
    begins = edge[~blank[edge]]
    starts[edge[blank[edge]]] = True
    inside = ~starts[begins]  # the byte before belongs to the same text
    starts[begins[inside] - 1] = True
    starts[begins[inside & (data[begins - 1] != 32)]] = True
    return np.flatnonzero(starts[:n])


def _plain_pattern(split: str) -> re.Pattern:
    for old, new in (("[\\p{L}]", "\\p{L}"), ("[\\p{N}]", "\\p{N}"), ("[^\\s\\p{L}\\p{N}]", f"[^\\s{LETTER}{NUMBER}]"),
                     ("\\p{L}", f"[{LETTER}]"), ("\\p{N}", f"[{NUMBER}]")):
        split = split.replace(old, new)
    return re.compile(split)


class Encoder:
    """Encode texts to little-endian unsigned 32-bit ids, without special tokens.

    A special token's own string inside a text is ordinary text. ``None`` counts as empty.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker per core
        from tokenizers import Tokenizer
        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = True
        conf = json.loads(self.tok.to_str())
        pre, model = conf["pre_tokenizer"] or {}, conf["model"]
        vocab = self.tok.get_vocab()
        self.kind = "whole"
        if pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") \
                and not conf["normalizer"] and "Ċ" in vocab:
            self.kind, self.units = "byte", _plain_pattern(BYTE_SPLIT).findall
            self.newline = vocab["Ċ"]
        elif model.get("end_of_word_suffix") == "</w>" and \
                WORD_SPLIT in [p.get("pattern", {}).get("Regex") for p in pre.get("pretokenizers", [])]:
            self.kind, self.units = "word", _plain_pattern(WORD_SPLIT).findall
            self.ends = np.zeros(max(vocab.values()) + 1, bool)
            self.ends[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        self.known: dict[bytes, bytes] = {}

    def _direct(self, texts: Sequence[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tok.encode_batch_fast(list(texts), add_special_tokens=False)]

    def _units(self, word: str) -> tuple[str, ...] | list[str]:
        if self.kind == "word":
            word = word.strip()
            if not word:
                return ()
        body = word[1:] if word[0] == " " else word
        if body.isalpha():
            return (word,)
        if word[-1] in _END_MARKS and body[:-1].isalpha():
            return word[:-1], word[-1]
        return self.units(word)

    def _cut(self, piece: bytes) -> Sequence[bytes]:
        """The units of a piece; plain words are told without decoding them."""
        word = piece.strip() if self.kind == "word" else piece
        body = word[1:] if word[:1] == b" " else word
        if body.isalpha():
            return (word,)
        if body[:-1].isalpha() and word[-1] in _END_BYTES:
            return word[:-1], word[-1:]
        return [u.encode() for u in self._units(piece.decode())]

    def _learn(self, pieces: list[bytes]) -> dict[bytes, bytes]:
        """Ids of pieces not met before; these and their units' are kept while there is room."""
        known, several, wanted = self.known, {}, set()
        for p in pieces:
            units = self._cut(p)
            if len(units) != 1 or units[0] != p:
                several[p] = units
            wanted.update(units)
        made = self._encode_units([u for u in wanted if u not in known])
        made.update([(p, b"".join([made[u] if u in made else known[u] for u in units])) for p, units in several.items()])
        if len(known) < KEPT_WORDS:
            known.update(made)
        return made

    def _encode_units(self, units: list[bytes]) -> dict[bytes, bytes]:
        """Ids of units, many joined in a call. Byte-level units are told apart by the line
        feed between them, word-level ones by the tokens that end a word."""
        blank = [u for u in units if u.isspace()]
        made = dict(zip(blank, self._direct([u.decode() for u in blank])))
        rest = [u for u in units if not u.isspace()]
        joint = b"\n" if self.kind == "byte" else b" "
        groups = [rest[i:i + JOINED] for i in range(0, len(rest), JOINED)]
        for group, e in zip(groups, self.tok.encode_batch_fast([joint.join(g).decode() for g in groups],
                                                               add_special_tokens=False)):
            ids = np.array(e.ids, "<u4")
            if self.kind == "byte":
                cut = np.flatnonzero(ids == self.newline)
                lo, hi = np.append(0, cut + 1), np.append(cut, ids.size)
            else:
                hi = np.flatnonzero(self.ends[ids]) + 1
                lo = np.append(0, hi[:-1])
            if len(hi) != len(group):
                made.update(zip(group, self._direct([u.decode() for u in group])))
                continue
            raw = ids.tobytes()
            made.update([(u, raw[a:b]) for u, a, b in zip(group, (4 * lo).tolist(), (4 * hi).tolist())])
        return made

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        texts = [t or "" for t in texts]
        if self.kind == "whole":
            return self._direct(texts)
        out: list[bytes | None] = [None] * len(texts)
        plain, size = [], 0
        for i, t in enumerate(texts):
            if not _PLAIN(t):
                out[i], = self._direct([t])
                continue
            plain.append((i, (t.lower() if self.kind == "word" else t).encode()))
            size += len(t)
            if size >= TOGETHER:
                self._encode_plain(plain, out)
                plain, size = [], 0
        self._encode_plain(plain, out)
        return out

    def _encode_plain(self, plain: list[tuple[int, bytes]], out: list) -> None:
        """Ids of plain texts, given with their places in ``out``."""
        joined = b"".join(t for _, t in plain)
        bounds = np.append(0, np.cumsum([len(t) for _, t in plain])).astype(np.int64)
        starts = piece_starts(np.frombuffer(joined, np.uint8), bounds) if joined else np.zeros(0, np.int64)
        offsets = np.append(starts, len(joined))
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        coded = pieces.dictionary_encode()
        distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.known.get, distinct))
        new = [k for k, found in enumerate(ids) if found is None]
        if new:
            learnt = self._learn([distinct[k] for k in new])
            for k in new:
                ids[k] = learnt[distinct[k]]
        flat = np.frombuffer(b"".join(ids), "<u4")
        length = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        first = np.cumsum(length) - length
        code = coded.indices.to_numpy()
        length = length[code]
        before = np.append(0, np.cumsum(length))
        gathered = flat[np.repeat(first[code] - before[:-1], length) + np.arange(before[-1])]
        at = before[np.searchsorted(starts, bounds)]
        for (i, _), lo, hi in zip(plain, at[:-1].tolist(), at[1:].tolist()):
            out[i] = gathered[lo:hi].tobytes()


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder for a vocabulary file; workers are reused between tasks."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]
