"""Token ids of whole texts with the tokenizers library, by the distinct words of a run of texts and a bounded cache."""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode

import numpy as np
import pyarrow as pa

from quayledger.llm.words import BASE, mixed

#: Bytes of a worker's cache, keys and all, before it starts anew; bytes of text whose words are looked up together.
CACHE_BYTES, RUN_BYTES = 32 << 20, 8 << 20
#: Bytes of the longest word in the cache, and the powers of their hash.
KNOWN_SIZE = 64
POWERS = np.cumprod(np.concatenate([[np.uint64(1)], np.full(KNOWN_SIZE - 1, BASE)]), dtype=np.uint64)

ASCII_LETTER = np.array([b < 128 and chr(b).isalpha() for b in range(256)])
#: White space, and characters that some Unicode version has counted as such.
ODD_SPACE = re.compile("[\\s\u180e\u200b]")
WHITE = re.compile(b"[ \n]")


def vocabulary_path() -> str:
    """The default vocabulary file, found on the machine that runs the task."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Words:
    """Ids of words and of whole texts.

    A word is " x" or "\\nx", with the white space before it, or "x" at a text's start. The vocabulary's own split never joins
    what stands before a single white space with it, so the words' ids are the text's. A word whose white space doesn't
    follow that form has no ids: its text is encoded as a whole, and so is one that holds an added token."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.whole = Tokenizer.from_file(path)
        self.model, self.split = self.whole.model, self.whole.pre_tokenizer
        self.added = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.shown = self._byte_letters()
        self._forget()
        self.ends = {code: self.ids_of([self.shown[code]]) for code in (10, 44, 46)}
        self.plain = isinstance(self.split, ByteLevel) and self.split.use_regex and not self.split.add_prefix_space and self.whole.normalizer is None

    def _byte_letters(self) -> str:
        """The letter that the vocabulary's split shows for each byte, at the byte's place: its one-byte and two-byte characters name them all."""
        shown = ["?"] * 256
        for code in [*range(128), *range(128, 0x500, 7), *range(0x80, 0x180)]:
            raw = chr(code).encode()
            letters = "".join(s for s, _ in self.split.pre_tokenize_str(chr(code)))
            for byte, letter in zip(raw, letters, strict=True):
                shown[byte] = letter
        return "".join(shown)

    def ids_of(self, parts: list[str]) -> list[int]:
        return [t.id for p in parts for t in self.model.tokenize(p)]

    def new_ids(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words data[starts:ends] one after the other, and how many each has, -1 for a word without ids.

        A word of Latin letters, with a space or line end before it and a full stop or comma after it, has a known split; such words
        are found, and their bytes spelt as the vocabulary does, for all words at once."""
        data = np.append(data, np.uint8(0))
        first, last = data[starts], data[ends - 1]
        two = (data[:-1] == 0xC3) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # the two bytes of a letter from U+00C0 to U+00FF
        letter = ASCII_LETTER[data]
        letter[:-1] |= two
        letter[1:] |= two
        other = np.concatenate([[0], np.cumsum(~letter)])
        before, after = (first == 32) | (first == 10), (last == 46) | (last == 44)
        marks = before.astype(np.int64) + after
        plain = (other[ends] - other[starts] == marks) & (ends - starts > marks)
        shown = charmap_decode(data.tobytes(), "strict", self.shown)[0]
        tokenize, line, mark = self.model.tokenize, self.ends[10], {46: self.ends[46], 44: self.ends[44]}
        flat: list[int] = []
        sizes: list[int] = []
        lists = (c.tolist() for c in (plain, starts, ends, starts + (first == 10), ends - after, first, last, after))
        for is_plain, start, end, a, b, head, tail, marked in zip(*lists):
            was = len(flat)
            if is_plain:
                if head == 10:
                    flat += line
                flat += [t.id for t in tokenize(shown[a:b])]
                if marked:
                    flat += mark[tail]
            else:
                key = data[start:end].tobytes().decode()
                if ODD_SPACE.search(key, head in (10, 32)) or key in (" ", "\n"):
                    sizes.append(-1)
                    continue
                flat += self.ids_of([s for s, _ in self.split.pre_tokenize_str(key)])
            sizes.append(len(flat) - was)
        return np.array(flat, np.uint32), np.array(sizes, np.int32)

    def ids_by_word(self, words: pa.BinaryArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and for each of the distinct words where its own begin and how many it has, -1 for none.

        The cache is arrays: sorted 64-bit hashes of words of up to KNOWN_SIZE bytes, and where their ids lie. It takes in all new
        words of a run, and starts anew when it is full."""
        _, offsets, buffer = words.buffers()
        offsets = np.frombuffer(offsets, np.int32)[: len(words) + 1].astype(np.int64)
        data = np.frombuffer(buffer, np.uint8)[: offsets[-1]] if len(words) else np.zeros(0, np.uint8)
        size = np.diff(offsets)
        inside = np.minimum(np.arange(len(data)) - np.repeat(offsets[:-1], size), KNOWN_SIZE - 1)
        hashes = mixed(np.add.reduceat((data + np.uint64(1)) * POWERS[inside], offsets[:-1])) if len(words) else np.zeros(0, np.uint64)
        at = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        hit = (self.keys[at] == hashes) & (size <= KNOWN_SIZE)
        new = np.flatnonzero(~hit)
        flat, n_new = self.new_ids(data, offsets[new], offsets[new + 1])
        begin, n = self.begin[at].copy(), self.n[at].copy()
        n[new] = n_new
        filled = np.maximum(n_new, 0)
        begin[new] = len(self.flat) + np.cumsum(filled) - filled
        every = np.concatenate([self.flat, flat])
        short = new[size[new] <= KNOWN_SIZE]
        self._remember(hashes[short], begin[short], n[short], every)
        return every, begin, n

    def _remember(self, hashes: np.ndarray, begin: np.ndarray, n: np.ndarray, every: np.ndarray) -> None:
        if 16 * (len(self.keys) + len(hashes)) + every.nbytes > CACHE_BYTES:
            self._forget()
            return
        keys = np.concatenate([self.keys, hashes])
        order = np.argsort(keys, kind="stable")
        self.keys, self.begin, self.n, self.flat = keys[order], np.concatenate([self.begin, begin])[order].astype(np.int32), np.concatenate([self.n, n])[order], every

    def _forget(self) -> None:
        """An empty cache; its one key is the largest hash, which no lookup runs past."""
        self.keys, self.begin, self.n, self.flat = np.array([2**64 - 1], np.uint64), np.zeros(1, np.int32), np.full(1, -1, np.int32), np.zeros(0, np.uint32)

    def _run(self, data: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a run of texts that begin at `firsts`: all ids, where each text's begin (one more at the end), and which texts hold a
        word without ids."""
        begins = (data == 32) | (data == 10)
        begins[firsts[firsts < len(data)]] = True
        at = np.append(np.flatnonzero(begins), len(data)).astype(np.int32)
        words = pa.BinaryArray.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at), pa.py_buffer(data)]).dictionary_encode()
        index = words.indices.to_numpy()
        flat, begin, sizes = self.ids_by_word(words.dictionary)
        odd = sizes < 0
        text = np.searchsorted(firsts, at[:-1], "right") - 1  # a text without a byte begins where the next one does
        n = np.maximum(sizes, 0)[index]
        ends = np.cumsum(n, dtype=np.int64)
        from_ = (begin[index] - (ends - n)).astype(np.int32)  # a run has fewer than 2**31 ids
        ids = flat[np.repeat(from_, n) + np.arange(ends[-1] if len(ends) else 0, dtype=np.int32)]
        of_text = np.bincount(text, n, len(firsts)).astype(np.int64)
        return ids, np.concatenate([[0], np.cumsum(of_text)]), np.bincount(text[odd[index]], minlength=len(firsts)) > 0

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The ids of whole texts. Words are looked up in runs of about RUN_BYTES, which a long text is cut into before white space;
        a word is looked up once in a run."""
        out: list[list[bytes]] = [[] for _ in texts]
        whole = {k for k, t in enumerate(texts) if not self.plain or any(a in t for a in self.added)}
        run: list[tuple[int, bytes]] = []
        held = 0

        def flush() -> None:
            data = np.frombuffer(b"".join(t for _, t in run), np.uint8)
            ids, edges, odd = self._run(data, np.cumsum([0, *(len(t) for _, t in run)])[:-1])
            for (k, _), a, b, o in zip(run, edges.tolist(), edges[1:].tolist(), odd.tolist()):
                whole.update((k,) if o else ())
                out[k].append(ids[a:b].tobytes())
            run.clear()

        for k, text in enumerate(texts):
            start = 0
            while k not in whole and start < len(text):
                end = len(text)
                if end - start > RUN_BYTES and (cut := WHITE.search(text, start + RUN_BYTES)):
                    end = cut.start()
                run.append((k, text[start:end]))
                held, start = held + end - start, end
                if held >= RUN_BYTES:
                    flush()
                    held = 0
        if run:
            flush()
        return [array("I", self.whole.encode(t.decode(), add_special_tokens=False).ids).tobytes() if k in whole else b"".join(out[k]) for k, t in enumerate(texts)]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text."""
        return self.encode_all([text.encode()])[0]


_words: dict[str, Words] = {}


def words_of(path: str | None) -> Words:
    """This worker's cache for a vocabulary file; without a path, the default file."""
    path = path or vocabulary_path()
    if path not in _words:
        _words[path] = Words(path)
    return _words[path]
