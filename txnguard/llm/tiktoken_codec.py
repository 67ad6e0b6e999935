"""Byte-level BPE by the ``tiktoken`` library and a local rank file.

A long text is split beforehand where a word of the pattern surely ends: between
a character that isn't white space and a blank followed by a letter, since a
word never reaches over such a blank and white space before it would. Each part
encodes as it would inside the whole text, so the ids are the library's own.
"""

from __future__ import annotations

import base64
import hashlib

import regex
from pyspark.sql import DataFrame

from txnguard.llm.common import arrow_schema, batch_of, id_text, schema_with, text_batches

SAFE = regex.compile(r"(?<=\S)(?= \p{L})")


class Codec:
    """``encode(text) -> ids`` and ``decode(ids) -> bytes`` for a rank file."""

    def __init__(self, path: str, pattern: str, part_chars: int = 65536):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        self.library = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.part_chars = part_chars

    def parts(self, text: str):
        """The text in parts of ``part_chars`` and up to the next safe boundary."""
        first = 0
        while len(text) - first > self.part_chars:
            at = SAFE.search(text, first + self.part_chars)
            if at is None:
                break
            yield text[first : at.start()]
            first = at.start()
        yield text[first:]

    def encode(self, text: str) -> list[int]:
        if len(text) <= self.part_chars:
            return self.library.encode_ordinary(text)
        return [i for part in self.parts(text) for i in self.library.encode_ordinary(part)]

    def decode(self, ids: list[int]) -> bytes:
        return self.library.decode_bytes(ids)


def tiktoken_digests(
    docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_tokens, ids_sha256, decoded_sha256``.

    ``with_ids=True`` adds ``ids`` (array<int>). A null text counts as empty (no
    ids); a null id stays null; repeated rows give repeated rows; an empty table
    gives none; other columns are ignored. Texts are processed whole.
    """
    source = id_text(docs, id_col, text_col)
    schema = schema_with(source, "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else ""))
    arrow = arrow_schema(schema)

    def run(batches):
        codec = Codec(path, pattern)
        decimal = {}
        for ids, texts in text_batches(batches):
            rows = []
            for text in texts:
                found = codec.encode(text)
                for i in set(found) - decimal.keys():
                    decimal[i] = str(i)
                listed = ",".join([decimal[i] for i in found])
                rows.append((len(found), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(codec.decode(found)).hexdigest(), found))
            yield batch_of(arrow, [ids, *map(list, list(zip(*rows))[: 3 + with_ids])])

    return source.mapInArrow(run, schema)
