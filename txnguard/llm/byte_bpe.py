"""Byte-level BPE over batches of texts, by the ``tokenizers`` library's files.

A batch is split into words (matches of the byte-level pattern) with array
operations over its code points, each distinct word is handled once, and what
was found for it is dealt out to all places where it stands. The class of a
character (letter, number, white space, other) is asked of the library itself,
so the split is the library's for any Unicode version.

Merges inside one word run in the ``tiktoken`` library on ranks read from the
same ``tokenizers`` file, several times faster for single words. ``check``
proves for a file that both give the same ids.
"""

from __future__ import annotations

import json

import numpy as np

from txnguard.llm.span_hash import SpanHash

LETTER, NUMBER, SPACE, OTHER, UNKNOWN = range(5)


class WordSplitter:
    """Splits texts into the words that the byte-level pattern matches."""

    def __init__(self, pre_tokenizer):
        self.pre = pre_tokenizer
        self.classes = np.full(0x110000, UNKNOWN, np.uint8)
        self.hashes = SpanHash()

    def classify(self, points: np.ndarray) -> np.ndarray:
        found = self.classes[points]
        if (found == UNKNOWN).any():
            for p in np.unique(points[found == UNKNOWN]):
                c = chr(p)
                single = [len(self.pre.pre_tokenize_str(x + c)) == 1 for x in ("a", "1", "!")]
                self.classes[p] = single.index(True) if True in single[:2] else OTHER if single[2] else SPACE
            found = self.classes[points]
        return found

    def split(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Code points of all texts, where words start (and one past the last), where
        texts start (likewise), and each character's class."""
        points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")
        texts_at = np.zeros(len(texts) + 1, np.int64)
        np.cumsum([len(t) for t in texts], out=texts_at[1:])
        n = len(points)
        kind = self.classify(points)
        first = np.zeros(n + 4, bool)  # of a text; padded for looks ahead
        first[texts_at] = True
        first[n:] = True
        run = first[:n].copy()
        run[1:] |= kind[1:] != kind[:-1]
        blank = points == 0x20
        start = run.copy()
        # The last white space before a word: a blank belongs to the word, any other stands alone.
        last = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~first[1:n])
        start[last] = True
        start[last + 1] = ~blank[last]
        # 's 't 'm 'd 're 've 'll, where an apostrophe alone begins a word.
        at = np.flatnonzero((points == 0x27) & run & start)
        if len(at):
            at = at[~first[at + 1]]
            at = at[kind[at + 1] == LETTER]
            one = points[at + 1]
            two = np.where(first[at + 2], 0, points[np.minimum(at + 2, n - 1)])
            short = np.isin(one, [ord(c) for c in "stmd"])
            long = ((two == ord("e")) & ((one == ord("r")) | (one == ord("v")))) | ((one == ord("l")) & (two == ord("l")))
            start[at[short | long] + 1] = False
            after = np.concatenate([at[short] + 2, at[long] + 3])
            start[after[after < n]] = True
        return points, np.append(np.flatnonzero(start), n), texts_at, kind


class WordStore:
    """What was found for each distinct word: a short array of integers.

    ``compute`` gets the code points of new words, one after the other, and where
    each begins; it returns their arrays, one after the other, and the sizes. At
    most ``most`` words are held; then the store begins anew, so that its memory
    doesn't grow with the corpus. Results don't depend on it.
    """

    def __init__(self, compute, most: int = 1_000_000):
        self.compute, self.most = compute, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.rows = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.at, self.flat = np.zeros(1, np.int64), np.zeros(0, np.int32)

    def rows_of(self, points: np.ndarray, words_at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The row in ``at`` of each word."""
        keys, where, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(keys) > self.most:
            self.clear()
        i = np.searchsorted(self.keys, keys)
        known = np.zeros(len(keys), bool)
        inside = i < len(self.keys)
        known[inside] = self.keys[i[inside]] == keys[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            found, sizes = self.compute(*ragged(words_at, points, where[new]))
            rows = np.arange(len(new)) + len(self.at) - 1
            self.at = np.concatenate([self.at, np.cumsum(sizes) + len(self.flat)])
            self.flat = np.concatenate([self.flat, found.astype(np.int32)])
            self.keys, self.rows = np.insert(self.keys, i[new], keys[new]), np.insert(self.rows, i[new], rows)
            i = np.searchsorted(self.keys, keys)
        return self.rows[i][back]


def ragged(at: np.ndarray, flat: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The arrays of ``rows``, one after the other, and where each begins."""
    sizes = at[rows + 1] - at[rows]
    begin = np.zeros(len(rows) + 1, np.int64)
    np.cumsum(sizes, out=begin[1:])
    places = np.arange(begin[-1]) + np.repeat(at[rows] - begin[:-1], sizes)
    return flat[places], begin


def byte_letters() -> dict[int, str]:
    """The printable character that stands for each byte in the library's files:
    itself where it is printable Latin-1, else the next of those from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def text_of(points: np.ndarray) -> str:
    return points.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")


class ByteBpe:
    """Ids as ``Tokenizer.encode(text, add_special_tokens=False)`` gives them."""

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer
        from tokenizers.decoders import ByteLevel

        self.path, self.library = path, Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre, model = spec["pre_tokenizer"], spec["model"]
        if (
            spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre.get("use_regex", True)
            or model["type"] != "BPE" or model["dropout"] or model.get("ignore_merges") or model.get("byte_fallback")
        ):
            raise ValueError(f"{path}: a plain byte-level BPE is needed")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens must match plainly")
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.letter = byte_letters()
        back = {c: b for b, c in self.letter.items()}
        self.vocab = {bytes(back[c] for c in t): i for t, i in model["vocab"].items() if t not in self.special}
        ranks = dict(self.vocab)
        for b in range(256):  # tiktoken wants every byte
            ranks.setdefault(bytes([b]), len(model["vocab"]) + len(self.special) + b)
        self.separator = ranks[b"\0"]
        self.words = tiktoken.Encoding("words", pat_str=r"[^\x00]+|\x00", mergeable_ranks=ranks, special_tokens={})
        self.splitter = WordSplitter(self.library.pre_tokenizer)
        self.store = WordStore(self._encode)

    def check(self) -> "ByteBpe":
        """Raise unless merging by the rank of the merged bytes is merging by the list.

        It is if ids rise along the list and each token's own bytes merge into that
        token: where neighbours u and v make up a token whose listed parts are x and
        y, those bytes alone would have come to u and v as well, and stopped there.
        """
        ids = [self.library.token_to_id(a + b) for a, b in self.merges]
        if ids != sorted(set(ids)) or set(ids) & {i for t, i in self.vocab.items() if len(t) == 1}:
            raise ValueError(f"{self.path}: ids don't follow the merges")
        for token, i in self.vocab.items():
            got = self.library.model.tokenize("".join(self.letter[b] for b in token))
            if [t.id for t in got] != [i]:
                raise ValueError(f"{self.path}: token {i} doesn't encode to itself")
        return self

    def _encode(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each word. Words are parted by a zero character; those that hold one go alone."""
        zero = np.flatnonzero(points == 0)
        odd = np.unique(np.searchsorted(at, zero, "right") - 1)
        parted = np.zeros(len(points) + len(at) - 1, points.dtype)
        parted[np.arange(len(points)) + np.repeat(np.arange(len(at) - 1), np.diff(at))] = points
        ids = np.array(self.words.encode_ordinary(text_of(parted)), np.int64)
        if not len(odd):
            ends = np.flatnonzero(ids == self.separator)
            return np.delete(ids, ends), np.diff(np.append(-1, ends)) - 1
        parts = []
        for i in range(len(at) - 1):
            parts.append(self.library.encode(text_of(points[at[i] : at[i + 1]]), add_special_tokens=False).ids)
        return np.concatenate([np.asarray(p, np.int64) for p in parts]), np.array([len(p) for p in parts])

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and where each text's begin."""
        plain = [t if not any(s in t for s in self.special) else "" for t in texts]
        points, words_at, texts_at, _ = self.splitter.split(plain)
        rows = self.store.rows_of(points, words_at, self.splitter.hashes(points, words_at))
        flat, begin = ragged(self.store.at, self.store.flat, rows)
        texts_begin = begin[np.searchsorted(words_at, texts_at)]
        if all(a is b for a, b in zip(plain, texts)):
            return flat, texts_begin
        parts = [
            flat[texts_begin[i] : texts_begin[i + 1]] if a is b else np.array(self.library.encode(b, add_special_tokens=False).ids, np.int32)
            for i, (a, b) in enumerate(zip(plain, texts))
        ]
        ends = np.zeros(len(parts) + 1, np.int64)
        np.cumsum([len(p) for p in parts], out=ends[1:])
        return np.concatenate(parts), ends
