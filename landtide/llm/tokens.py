"""Exact tokenisation with memoised chunks.

A text is cut at blanks and line breaks, where both vocabularies have a token boundary. The chunks of
a slice of texts are made distinct in Arrow; each one not yet known goes through the tokenizers
library, new words of letters together in one string; ids are then gathered in numpy. For the
byte-level vocabulary the cuts are exact where white space stands alone; a text with a run of white
space, or with the string of an added token, goes through the library whole.
"""

from __future__ import annotations

import gc
import os
from collections.abc import Iterable, Iterator
from itertools import takewhile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Entries that a worker's memo holds before it starts anew, words joined in one string, and the
#: bytes of text encoded at a time. They bound memory only.
MEMO_ENTRIES, JOINED, SLICE_BYTES = 1_000_000, 1_000, 6_000_000
_MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Encodes texts to little-endian unsigned 32-bit ids, as the library itself does.

    spaced: white space belongs to tokens (byte-level vocabularies), and a blank to the token after
    it; otherwise the vocabulary lowers case and drops white space.
    """

    def __init__(self, path: str, spaced: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.spaced = spaced
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added_begin = os.path.commonprefix(self.added)
        # what an added token begins with in any case of its letters
        self.added_mark = "".join(takewhile(lambda x: not x.isalpha(), self.added_begin))
        self.memo: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        # where in the ids of joined words each word begins (after a blank, or a line break) or ends
        edge = (lambda t: t[:1] in "ĠĊ") if spaced else (lambda t: t.endswith("</w>"))
        ids = self.tokenizer.get_vocab()
        self.edge = np.zeros(max(ids.values()) + 1, bool)
        self.edge[[i for t, i in ids.items() if t and edge(t)]] = True

    def _holds_added(self, chunk: str) -> bool:
        return self.added_begin in chunk and any(t in chunk for t in self.added)

    def _alone(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _chunk(self, chunk: str) -> bytes:
        return self._alone(chunk if chunk[:1] == "\n" or not self.spaced else f" {chunk}")

    def _words(self, words: list[str], before: str) -> None:
        """Learn words of letters, which stand after a blank or, with ``before`` empty, begin with a line break of their own."""
        for lo in range(0, len(words), JOINED):
            part = words[lo : lo + JOINED]
            ids = np.array(self.tokenizer.encode_batch_fast([before + before.join(part)], add_special_tokens=False)[0].ids, "<u4")
            edges = np.flatnonzero(self.edge[ids])
            if len(edges) != len(part):
                self.memo.update((w, self._chunk(w)) for w in part)
                continue
            cuts = [*edges.tolist(), len(ids)] if self.spaced else [0, *(edges + 1).tolist()]
            data = ids.tobytes()
            self.memo.update((w, data[4 * a : 4 * b]) for w, a, b in zip(part, cuts[:-1], cuts[1:], strict=True))

    def _learn(self, chunks: list[str], plain: bool) -> set[str]:
        """Make chunks known that aren't; returns those beside which white space doesn't stand alone or that hold an added token (not if ``plain``), which stay unknown."""
        memo = self.memo
        if len(memo) > MEMO_ENTRIES:
            memo.clear()
        words: dict[str, None] = {}
        lines: dict[str, None] = {}
        marked, rest, lowered, bad = [], [], [], set()
        for c in chunks:
            if not plain and self._holds_added(c):
                bad.add(c)
                continue
            if not self.spaced and c.isascii() and (low := c.lower()) != c and (plain or not self._holds_added(low)):
                lowered.append((c, low))
                c = low
                if c in memo:
                    continue
            if c.isalpha():
                words[c] = None
                continue
            base = c.rstrip(_MARKS)
            line = self.spaced and base[:1] == "\n"
            if (base[1:] if line else base).isalpha():
                if base is not c and len(base) < len(c):
                    marked.append((c, base))
                if base not in memo:
                    (lines if line else words)[base] = None
            elif self.spaced and (c in ("", "\n") or c[c[0] == "\n"].isspace() or c[-1].isspace()):
                bad.add(c)
            else:
                rest.append(c)
        self._words(list(words), " ")
        self._words(list(lines), "")
        for c, base in marked:
            tail = c[len(base) :]
            if tail not in self.marks:
                if len(self.marks) > 10_000:
                    self.marks.clear()
                self.marks[tail] = self._alone(tail)
            memo[c] = memo[base] + self.marks[tail]
        for c in rest:
            memo[c] = self._chunk(c)
        for c, low in lowered:
            memo[c] = memo[low]
        return bad

    def encode_many(self, texts: pa.Array | list[str]) -> list[bytes]:
        """The ids of each text."""
        own = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
        if not len(own):
            return []
        if self.spaced:
            # each line begins with its break, the first too: a token that is dropped again below
            cut = pc.binary_join_element_wise(pa.scalar("\n", pa.large_string()), pc.replace_substring(own, "\n", " \n"), pa.scalar("", pa.large_string()))
        else:
            cut = pc.replace_substring(pc.replace_substring(own, "\n", " "), "\t", " ")
        parts = pc.split_pattern(cut, " ")
        coded = parts.flatten().dictionary_encode()
        index, chunks = coded.indices.to_numpy(), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        offsets = np.concatenate([[0], np.cumsum(pc.list_value_length(parts).to_numpy(zero_copy_only=False))])
        known = list(map(self.memo.get, chunks))
        new = [i for i, k in enumerate(known) if k is None]
        plain = not self.added or (self.added_mark != "" and not pc.any(pc.match_substring(own, self.added_mark)).as_py())
        bad = self._learn([chunks[i] for i in new], plain)
        for i in new:
            known[i] = b"" if chunks[i] in bad else self.memo[chunks[i]]
        lengths = np.fromiter(map(len, known), "i8", len(known)) // 4
        pool = np.frombuffer(b"".join(known), "<u4")
        n = lengths[index]
        ends = np.cumsum(n)
        at = np.repeat((np.cumsum(lengths) - lengths)[index] - (ends - n), n)
        at += np.arange(len(at))
        data = pool[at].tobytes()
        bounds = np.concatenate([[0], ends])[offsets] * 4
        skip = 4 * self.spaced
        out = [data[a + skip : b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
        if bad:
            is_bad = np.fromiter((c in bad for c in chunks), bool, len(chunks))
            hits = np.concatenate([[0], np.cumsum(is_bad[index])])[offsets]
            for i in np.flatnonzero(np.diff(hits)).tolist():
                out[i] = self._alone(own[i].as_py())
        return out


def encoded(encoder: Encoder, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[object, bytes]]:
    """(key, ids) of each row of batches of key and text, a slice of text at a time."""
    for batch in batches:
        size = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)) // SLICE_BYTES
        for lo, hi in zip([0, *(np.flatnonzero(np.diff(size)) + 1).tolist()], [*(np.flatnonzero(np.diff(size)) + 1).tolist(), len(size)], strict=True):
            if hi > lo:
                yield from zip(batch.column(0).slice(lo, hi - lo).to_pylist(), encoder.encode_many(batch.column(1).slice(lo, hi - lo)), strict=True)


_encoders: dict = {}


def encoder(path: str, spaced: bool) -> Encoder:
    """One encoder for each vocabulary in a worker process."""
    key = (path, spaced)
    if key not in _encoders:
        gc.set_threshold(100_000)  # the memo holds no cycles
        _encoders[key] = Encoder(path, spaced)
    return _encoders[key]
