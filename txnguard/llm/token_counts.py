"""Token counts of every prefix of every text, by dynamic programming.

The encoding of a prefix ends in one token ``t``; without ``t`` it is the encoding
of a shorter prefix. Of the vocabulary's tokens that end at a place, exactly one
may follow the last token of the prefix before it, namely if the two tokens'
bytes together encode to those two tokens. So one pass over a word gives
``count[i] = count[i - len(t)] + 1`` at each place, exact at every prefix, and
nothing is encoded again to answer how much text fits a budget.

Words (matches of the pre-tokenizer's pattern) don't share tokens, so a text's
counts are the sum over earlier words plus the count inside the current word.
The one exception is a prefix that ends in white space: all of the white space at
its end is then one word.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from txnguard.llm.byte_bpe import SPACE, ByteBpe, WordStore, text_of
from txnguard.llm.common import arrow_schema, batch_of, id_text, schema_with, text_batches


class PrefixCounts:
    """``counts(texts)``: for each text, the tokens of its first 0, 1, 2, ... code points."""

    def __init__(self, path: str, most_pairs: int = 500_000):
        self.bpe, self.most_pairs = ByteBpe(path), most_pairs
        self.longest = max(map(len, self.bpe.vocab))
        self.bytes_of = {i: t for t, i in self.bpe.vocab.items()}
        self.pairs: dict[tuple[int, int], bool] = {}
        self.store = WordStore(self._words)

    def _follows(self, a: int, b: int) -> bool:
        """Whether tokens a and b may stand side by side."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= self.most_pairs:
                self.pairs.clear()
            both = "".join(self.bpe.letter[x] for x in self.bytes_of[a] + self.bytes_of[b])
            got = self.pairs[a, b] = [t.id for t in self.bpe.library.model.tokenize(both)] == [a, b]
        return got

    def of_word(self, word: bytes, count: list[int] | None = None, last: list[int] | None = None) -> list[int]:
        """Token counts of the first 0, 1, 2, ... bytes. ``count`` and ``last`` hold those
        of a common prefix with the word before, if any, and are carried on in place."""
        if count is None:
            count, last = [0], [-1]
        get, known, longest = self.bpe.vocab.get, self.pairs.get, self.longest
        for i in range(len(count), len(word) + 1):
            for j in range(i - longest if i > longest else 0, i):
                t = get(word[j:i])
                if t is not None:
                    before = last[j]
                    if j == 0 or before >= 0 and (known((before, t)) or self._follows(before, t)):
                        count.append(count[j] + 1)
                        last.append(t)
                        break
        return count

    def _words(self, points: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Counts after each code point of each word; in lexical order, so that a word
        begins from what it shares with the one before."""
        text = text_of(points)
        words = [text[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        found: list = [None] * len(words)
        before, count, last = b"", [0], [-1]
        for raw, k in sorted((w.encode(), k) for k, w in enumerate(words)):
            same = 0
            for x, y in zip(raw, before):
                if x != y:
                    break
                same += 1
            del count[same + 1 :], last[same + 1 :]
            self.of_word(raw, count, last)
            before, word = raw, words[k]
            if len(raw) == len(word):
                found[k] = count[1:]
            else:
                place, found[k] = 0, []
                for c in word:
                    place += len(c.encode())
                    found[k].append(count[place])
        return np.array([x for f in found for x in f], np.int32), np.diff(at)

    def _plain(self, texts: list[str]) -> list[np.ndarray]:
        """As ``counts``, for texts without special strings."""
        points, words_at, texts_at, kind = self.bpe.splitter.split(texts)
        n = len(points)
        if not n:
            return [np.zeros(1, np.int32) for _ in texts]
        rows = self.store.rows_of(points, words_at, self.bpe.splitter.hashes(points, words_at))
        begin, store = self.store.at[rows], self.store
        sizes = np.diff(words_at)
        within = store.flat[np.arange(n) + np.repeat(begin - words_at[:-1], sizes)]
        done = np.zeros(len(rows) + 1, np.int64)
        np.cumsum(store.flat[store.at[rows + 1] - 1], out=done[1:])
        before = done[np.searchsorted(words_at, texts_at)]  # of all texts before each
        total = within + np.repeat(done[:-1], sizes)
        # Prefixes that end in white space, where the full text parts that white space.
        first = np.zeros(n, bool)
        first[texts_at[:-1][texts_at[:-1] < n]] = True
        run = (kind == SPACE) & (first | (np.append(OTHER_FIRST, kind[:-1]) != SPACE))
        starts = np.flatnonzero(run)
        if len(starts):
            inside = np.cumsum(run) - 1
            space = np.flatnonzero(kind == SPACE)
            own = starts[inside[space]]  # where the run of each white space begins
            word = np.searchsorted(words_at, space, "right") - 1
            for p, s in zip(space[words_at[word] > own], own[words_at[word] > own]):
                total[p] = done[np.searchsorted(words_at, s)] + self._space(text_of(points[s : p + 1]))
        out = []
        for i, (a, b) in enumerate(zip(texts_at[:-1], texts_at[1:])):
            counts = np.zeros(b - a + 1, np.int32)
            counts[1:] = total[a:b] - before[i]
            out.append(counts)
        return out

    def _space(self, run: str) -> int:
        return self.of_word(run.encode())[-1]

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        special = self.bpe.special
        odd = [i for i, t in enumerate(texts) if any(s in t for s in special)]
        out = self._plain(["" if i in set(odd) else t for i, t in enumerate(texts)]) if odd else self._plain(texts)
        for i in odd:
            out[i] = self._with_special(texts[i])
        return out

    def _with_special(self, text: str) -> np.ndarray:
        """A special string is one token as soon as it is whole; cut, it is plain text."""
        parts, base = [np.zeros(1, np.int32)], 0
        while text:
            at, name = min(((text.find(s), -len(s), s) for s in self.bpe.special if s in text), default=(len(text), 0, ""))[::2]
            plain = self._plain([text[: at + max(len(name) - 1, 0)]])[0][1:] + base
            base = base + int(plain[at - 1] - base if at else 0)
            parts.append(plain)
            if name:
                base += 1
                parts.append(np.array([base], np.int32))
            text = text[at + len(name) :]
        return np.concatenate(parts).astype(np.int32)


OTHER_FIRST = np.uint8(255)


def longest_prefix(counts: np.ndarray, limit: int) -> int:
    """Code points of the longest prefix of at most ``limit`` tokens (counts may fall as a prefix grows)."""
    return int(np.flatnonzero(counts <= limit)[-1])


def token_counts(
    docs: DataFrame, path: str, limit: int = 1024, id_col: str = "doc_id", text_col: str = "text", prefixes: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_bytes, n_tokens, over_limit, limit_chars``.

    ``limit_chars`` is the length in code points of the longest prefix of at most
    ``limit`` tokens. With ``prefixes=True`` a column ``prefix_tokens`` (array<int>)
    holds the count after each code point, beginning with 0 for none.

    A null text counts as empty: 0 bytes, 0 tokens. A null id stays null; repeated
    rows give repeated rows; an empty table gives none; other columns are ignored.
    Texts are processed whole, a few at a time; memory follows the longest text.
    """
    source = id_text(docs, id_col, text_col)
    PrefixCounts(path).bpe.check()
    schema = schema_with(source, "n_bytes long, n_tokens long, over_limit boolean, limit_chars long" + (", prefix_tokens array<int>" if prefixes else ""))
    arrow = arrow_schema(schema)

    def run(batches):
        dp = PrefixCounts(path)
        for ids, texts in text_batches(batches):
            counts = dp.counts(texts)
            tokens = [int(c[-1]) for c in counts]
            columns = [
                ids, [len(t.encode("utf-8", "surrogatepass")) for t in texts], tokens,
                [t > limit for t in tokens], [longest_prefix(c, limit) for c in counts],
            ]
            yield batch_of(arrow, columns + [[c.tolist() for c in counts]] * prefixes)

    return source.mapInArrow(run, schema)
