"""Whole-text token ids, exact and fast: the tokenizer library plus a table of chunks.

A text is cut at single spaces between two visible characters. There every supported
tokenizer ends one pre-token and begins the next, so the ids of the text are the ids
of its chunks in a row. Chunks repeat far more than texts do: Arrow finds the distinct
ones of a batch, each is given to the tokenizer library once, and its ids are kept in
flat arrays from which those of all texts are gathered. Strings of added tokens stay
within a chunk and become their ids, as in the whole text.
"""

from __future__ import annotations

import json
import os
import re
from itertools import repeat
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import SparkSession

#: Characters that one library or another takes for a space or for nothing, beside spaces.
_BLANK = "\\s\u180e\u200b-\u200f\u2060\ufeff"
#: A chunk that may stand between others: a space first, visible characters beside it and at the end.
INNER = re.compile(f"(?s) [^{_BLANK}](?:.*[^{_BLANK}])?")
#: The same of characters whose UTF-8 length no change of case or composition alters.
PLAIN = re.compile(" [!-~À-ÿ](?:[ \t\n\r!-~À-ÿ]*[!-~À-ÿ])?")
KEPT_CHUNKS = 1_000_000
KEPT_CHARS = 40
#: Texts are gathered in blocks of about this many bytes.
BLOCK_BYTES = 2 << 20
#: Chunks given to the library at once; its own records take some hundred bytes a token.
CALL_CHUNKS = 8192

#: First bytes of characters that always count as visible. Those left out (C2, E1, E2
#: and EF among them) begin some blanks too; a text is not cut beside such a character.
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
_VISIBLE[0xC3:0xE1] = True
_VISIBLE[0xE4:0xEF] = True
_VISIBLE[0xF0:0xF5] = True


def cuts(data: np.ndarray) -> np.ndarray:
    """Positions in UTF-8 bytes of spaces between two visible characters."""
    at = np.flatnonzero(data == 0x20)
    at = at[(at > 0) & (at < len(data) - 1)]
    at = at[_VISIBLE[data[at + 1]]]
    return at[_VISIBLE[data[_lead(data, at - 1)]]]


def _lead(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Where the characters begin that the bytes at `at` belong to."""
    for _ in range(3):  # back over the later bytes of a character
        at = np.where((data[at] & 0xC0 == 0x80) & (at > 0), at - 1, at)
    return at


def surely_inner(chunks: pa.StringArray) -> np.ndarray:
    """Which chunks are a space between visible characters by their first and last bytes;
    each of them matches `INNER`, though some others do too."""
    ends = np.frombuffer(chunks.buffers()[1], np.int32)[: len(chunks) + 1]
    data = np.frombuffer(chunks.buffers()[2] or b"", np.uint8)
    out = np.diff(ends) > 1
    first, last = ends[:-1][out], ends[1:][out] - 1
    out[out] = (data[first] == 0x20) & _VISIBLE[data[first + 1]] & _VISIBLE[data[_lead(data, last)]]
    return out


class Encoder:
    """Ids of whole texts."""

    def __init__(self, tokenizer_json: str, end_id: int | None = 0):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content]
        #: Strings of added tokens, which the library looks for before all else.
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.spaced = [t for t in added if " " in t]
        self.end_id = end_id
        self.token_bytes = self._token_bytes(json.loads(tokenizer_json))
        self._forget()

    def _token_bytes(self, parts: dict) -> np.ndarray | None:
        """Bytes of text behind each token, where a token's letters stand for one byte
        each; else none. Blanks count or are lost, which a trial tells."""
        pre = parts.get("pre_tokenizer") or {}
        steps = [pre, *pre.get("pretokenizers", [])]
        if not any(x.get("type") == "ByteLevel" for x in steps) or any(x.get("add_prefix_space") for x in steps):
            return None
        if parts["model"].get("continuing_subword_prefix") or parts["model"].get("unk_token"):
            return None
        vocab = self.tokenizer.get_vocab()
        sizes = np.zeros(max(vocab.values()) + 1, np.int64)
        for token, i in vocab.items():
            sizes[i] = len(token.removesuffix(parts["model"].get("end_of_word_suffix") or ""))
        trial = " Ab1\n,É x"
        read = int(sizes[self._whole(trial)].sum())
        self.blanks_count = read == len(trial.encode())
        if not self.blanks_count and read != len("".join(trial.split()).encode()):
            return None
        self.inner = INNER if self.blanks_count and not parts.get("normalizer") else PLAIN
        return sizes

    def _forget(self) -> None:
        #: Number of each kept chunk; its ids lie at starts[number] of ids.
        self.known: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.passing: list[str] = []

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _ids(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all chunks in a row, and their number for each chunk."""
        if self.added and self.added.search("\n".join(chunks)):
            odd = {i: self._whole(c) for i, c in enumerate(chunks) if self.added.search(c)}
            flat, counts = self._plain([c for i, c in enumerate(chunks) if i not in odd])
            plain = iter(np.split(flat, np.cumsum(counts)[:-1]) if len(counts) else [])
            each = [odd[i] if i in odd else next(plain) for i in range(len(chunks))]
            return np.concatenate(each), np.array([len(x) for x in each], np.int64)
        return self._plain(chunks)

    def _plain(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not chunks:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        found = self.tokenizer.encode_batch([chunks], is_pretokenized=True, add_special_tokens=False)[0]
        counts = np.bincount(np.array(found.word_ids, np.int64), minlength=len(chunks))
        return np.array(found.ids, np.uint32), counts

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """The same for inner chunks as one text, told apart by the tokens' bytes."""
        flat = np.array(self.tokenizer.encode_batch_fast(["".join(chunks)], add_special_tokens=False)[0].ids, np.uint32)
        read = np.cumsum(self.token_bytes[flat])
        texts = chunks if self.blanks_count else ["".join(c.split()) for c in chunks]
        wanted = np.cumsum(pc.binary_length(pa.array(texts, pa.string())).to_numpy().astype(np.int64))
        last = np.searchsorted(read, wanted)
        if not len(read) or read[-1] != wanted[-1] or (read[last] != wanted).any():
            return None
        return flat, np.diff(last, prepend=-1)

    def _add(self, chunks: list[str]) -> np.ndarray:
        """Ids of new chunks go behind those kept; gives their numbers."""
        fits = np.zeros(len(chunks), bool)
        if self.token_bytes is not None and chunks:
            if self.inner is INNER:
                fits = surely_inner(pa.array(chunks, pa.string()))
            for i in np.flatnonzero(~fits).tolist():
                fits[i] = bool(self.inner.fullmatch(chunks[i]))
            if self.added and self.added.search("\n".join(chunks)):
                for i in np.flatnonzero(fits).tolist():
                    fits[i] = not self.added.search(chunks[i])
        number = np.empty(len(chunks), np.int64)
        for which, joined in ((np.flatnonzero(fits), True), (np.flatnonzero(~fits), False)):
            number[which] = len(self.known) + np.arange(len(which))
            group = [chunks[i] for i in which.tolist()]
            for at in range(0, len(group), CALL_CHUNKS):
                part = group[at : at + CALL_CHUNKS]
                flat, counts = (joined and self._joined(part)) or self._ids(part)
                self._append(part, flat, counts)
        return number

    def _append(self, chunks: list[str], flat: np.ndarray, counts: np.ndarray) -> None:
        n = len(self.known)
        ends = self.starts[n] + np.cumsum(counts)
        self.ids = _room(self.ids, int(ends[-1]))
        self.starts = _room(self.starts, n + 1 + len(chunks))
        self.ids[self.starts[n] : ends[-1]] = flat
        self.starts[n + 1 : n + 1 + len(chunks)] = ends
        self.known.update(zip(chunks, range(n, n + len(chunks))))

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, an end id after each, and their number for each
        text. A null text is an empty one."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at, values, counts = 0, [], []
        while at < len(texts):
            before = size[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(size, before + BLOCK_BYTES, "right")))
            v, c = self._block(texts.slice(at, stop - at))
            values.append(v)
            counts.append(c)
            at = stop
        if not values:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        return np.concatenate(values), np.concatenate(counts)

    def _block(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        _, offsets, data = texts.buffers()
        ends = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
        base, size = int(ends[0]), int(ends[-1] - ends[0])
        opens = np.zeros(size + 1, bool)  # bytes that begin a chunk
        if size:
            opens[cuts(np.frombuffer(data, np.uint8)[base : base + size])] = True
            opens[np.maximum(ends[1:] - base - 1, 0)] = False  # a text's last character
            for token in self.spaced:
                for i in np.flatnonzero(pc.match_substring(texts, token).to_numpy(zero_copy_only=False)):
                    opens[ends[i] - base : ends[i + 1] - base] = False
        opens[ends - base] = True
        bounds = (np.flatnonzero(opens) + base).astype(np.int32)
        chunks = pa.StringArray.from_buffers(len(bounds) - 1, pa.py_buffer(bounds), data).dictionary_encode()
        number = self._numbers(chunks.dictionary.to_numpy(zero_copy_only=False).tolist())[chunks.indices.to_numpy()]
        starts = self.starts[number]
        sizes = self.starts[number + 1] - starts
        read = np.concatenate([[0], np.cumsum(sizes)])
        at = np.repeat(starts - read[:-1], sizes)
        at += np.arange(len(at))
        values = self.ids[at]
        for chunk in self.passing:
            del self.known[chunk]
        self.passing = []
        last = read[np.searchsorted(bounds, ends)]  # ids before each text's end
        counts = np.diff(last)
        if self.end_id is not None:
            values, counts = np.insert(values, last[1:], self.end_id), counts + 1
        return values, counts

    def _numbers(self, distinct: list[str]) -> np.ndarray:
        """Number of each chunk; new ones are encoded. The table begins anew when it is
        full, so it holds at most `KEPT_CHUNKS` chunks and those of one block."""
        if len(self.known) > KEPT_CHUNKS:
            self._forget()
        number = np.fromiter(map(self.known.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(number < 0)
        if len(missing):
            new = [distinct[i] for i in missing.tolist()]
            # Long chunks hardly repeat: they come last and go after the block.
            long = np.fromiter(map(len, new), np.int64, len(new)) > KEPT_CHARS
            number[missing[~long]] = self._add([new[i] for i in np.flatnonzero(~long).tolist()])
            self.passing = [new[i] for i in np.flatnonzero(long).tolist()]
            number[missing[long]] = self._add(self.passing)
        return number

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit bytes."""
        values, counts = self.encode_array(pa.array(texts, pa.string()))
        data = values.astype("<u4", copy=False).tobytes()
        ends = (np.cumsum(counts) * 4).tolist()
        return [data[a:b] for a, b in zip([0, *ends], ends)]


def _room(values: np.ndarray, size: int) -> np.ndarray:
    """The array itself, or one of twice the size and more with the same start."""
    if size <= len(values):
        return values
    grown = np.zeros(max(size, 2 * len(values)), values.dtype)
    grown[: len(values)] = values
    return grown


_ENCODERS: dict[tuple[int, int | None], Encoder] = {}


def encoder(shared: Broadcast, end_id: int | None = 0) -> Encoder:
    """One encoder per Python worker and tokenizer."""
    text = shared.value
    key = (hash(text), end_id)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(text, end_id)
    return _ENCODERS[key]


def share_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer's file, read on the driver: a vocabulary of fixed size (some MB).
    Executors need not see the path."""
    return spark.sparkContext.broadcast(Path(path).read_text(encoding="utf-8"))
