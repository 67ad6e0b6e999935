"""Language identification by a string kernel, Nyström landmarks and ridge regression.

Two texts are alike by how many distinct letter n-grams of any of several lengths
they share, over the geometric mean of how many each has (the blended-spectrum
presence kernel). A text is described by its kernel values with a fixed set of
landmark texts, whitened by the landmarks' own kernel (Nyström), and one ridge
regression for each language separates it from the rest. All of that folds into
two matrices, so a batch of texts is scored by two matrix products.

N-grams are hashed to ``DIMS`` columns. Training rows are a sample of bounded
size; from the executors come their presence bits only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from txnguard.llm.common import arrow_schema, batch_of, id_text, lean, schema_with, text_batches

DIMS = 1 << 14
LENGTHS = (1, 2, 3)
UNDETERMINED = "und"


def letter_table() -> np.ndarray:
    """The lower-case letter of each code point, 0 for what isn't a letter."""
    points = np.zeros(0x110000, np.uint32)
    for p in range(0x110000):
        c = chr(p)
        if c.isalpha():
            low = c.lower()
            points[p] = ord(low) if len(low) == 1 else p
    return points


def presence(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts by hashed n-grams (0 or 1), and whether each text has a letter.

    N-grams run within and at the edges of words: all between two letters is one gap.
    """
    out = np.zeros((len(texts), DIMS), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    letters = table[np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4")]
    row = np.repeat(np.arange(len(texts)), sizes)
    has = np.zeros(len(texts), bool)
    has[row[letters > 0]] = True
    # One gap before each text and for each run of other characters.
    keep = letters > 0
    if len(keep):
        keep[1:] |= (letters[:-1] > 0) | (row[1:] != row[:-1])
        keep[0] = True
    letters, row = letters[keep].astype(np.uint64), row[keep]
    code = np.zeros(len(letters), np.uint64)
    for n in range(1, max(LENGTHS) + 1):
        if len(letters) < n:
            break
        m = len(letters) - n + 1
        code = (code[:m] * np.uint64(0x100000001B3) + letters[n - 1 :] + np.uint64(n)) & np.uint64(0xFFFFFFFFFFFF)
        if n in LENGTHS:
            whole = row[:m] == row[n - 1 :]
            mixed = code * np.uint64(0x9E3779B97F4A7C15)
            out[row[:m][whole], (mixed >> np.uint64(50)).astype(np.int64)[whole]] = 1
    return out, has


class Model:
    """Landmarks (n-grams by landmark, each scaled by its size) and weights (landmark by language)."""

    def __init__(self, landmarks: np.ndarray, weights: np.ndarray, languages: list[str], sharpness: float):
        self.landmarks, self.weights, self.languages, self.sharpness = landmarks, weights, languages, sharpness

    @staticmethod
    def kernel(bits: np.ndarray, scaled: np.ndarray) -> np.ndarray:
        own = np.sqrt(np.maximum(bits.sum(1, dtype=np.float32), 1))[:, None]
        return (bits.astype(np.float32) @ scaled) / own

    @classmethod
    def fit(cls, bits: np.ndarray, names: list[str], landmarks: int, ridge: float, sharpness: float) -> "Model":
        languages = sorted(set(names))
        label = np.array([languages.index(n) for n in names], np.int64)
        # Landmarks by turns of the languages, in the sample's order.
        turn = np.zeros(len(label), np.int64)
        for i in range(len(languages)):
            turn[label == i] = np.arange((label == i).sum())
        chosen = np.lexsort((label, turn))[:landmarks]
        base = bits[chosen]
        scaled = (base / np.sqrt(np.maximum(base.sum(1, dtype=np.float32), 1))[:, None]).T.astype(np.float32)
        values, vectors = np.linalg.eigh(cls.kernel(base, scaled).astype(float))
        good = values > 1e-6 * max(values.max(initial=0), 1e-12)
        whiten = vectors[:, good] / np.sqrt(values[good])
        x = cls.kernel(bits, scaled).astype(float) @ whiten
        y = np.where(label[:, None] == np.arange(len(languages)), 1.0, -1.0)
        weight = 1 / np.maximum(np.bincount(label, minlength=len(languages)), 1)[label]  # languages count alike
        w = np.linalg.solve((x.T * weight) @ x + ridge * np.eye(x.shape[1]), (x.T * weight) @ y)
        return cls(scaled, (whiten @ w).astype(np.float32), languages, sharpness)

    def predict(self, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The best language of each row, and its share of the scores (softmax)."""
        z = self.sharpness * (self.kernel(bits, self.landmarks) @ self.weights)
        z = np.exp(z - z.max(1, keepdims=True))
        best = z.argmax(1)
        return best, z[np.arange(len(z)), best] / z.sum(1)


def train(
    docs: DataFrame,
    usable: Column,
    sample: int = 400,
    landmarks: int = 128,
    ridge: float = 0.01,
    sharpness: float = 3.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    most_languages: int = 10_000,
) -> Model | None:
    """A model from rows where ``usable`` holds and the language isn't null.

    Of each language, the ``sample`` rows of smallest hash of id and text are used, repeated
    rows once; None if no row can be. A null id is like any other. Counting is over all
    rows; beside that, only the sample's bits (2 KB a row) reach the driver. More languages
    than ``most_languages`` are an error.
    """
    rows = docs.where(usable & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    hashed = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(text_col), F.lit(6))
    found = rows.groupBy(F.col(lang_col).alias("lang")).agg(F.approx_count_distinct(hashed).alias("n")).limit(most_languages + 1).collect()
    if not found:
        return None
    if len(found) > most_languages:
        raise ValueError(f"more than {most_languages} languages")
    counts = {r[0]: max(r[1], 1) for r in found}
    # A share of each language's distinct rows that holds a little more than the sample.
    mark = F.shiftrightunsigned(hashed, 1).cast("double") / float(1 << 63)
    share = F.element_at(F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, min(1.0, 1.5 * sample / n + 50 / n)))), F.col(lang_col))
    taken = rows.where(mark < share).select(F.struct(F.col(lang_col).alias("lang"), hashed.alias("mark")).alias("doc_id"), F.col(text_col).alias("text"))
    taken = taken.groupBy("doc_id").agg(F.any_value("text").alias("text"))  # equal marks, equal rows
    schema = schema_with(taken, "bits binary")
    arrow = arrow_schema(schema)

    def run(batches):
        table = letter_table()
        for ids, texts in text_batches(batches):
            bits, has = presence(texts, table)
            yield batch_of(arrow, [ids, [np.packbits(b).tobytes() if h else None for b, h in zip(bits, has)]])

    found = taken.mapInArrow(run, schema).where("bits IS NOT NULL").select("doc_id.*", "bits")
    held: dict[str, list] = {}
    for lang, _, raw in sorted(found.collect(), key=lambda r: (r[0], r[1] & (1 << 64) - 1)):
        if len(held.setdefault(lang, [])) < sample:
            held[lang].append(np.frombuffer(raw, np.uint8))
    if not held:
        return None
    bits = np.unpackbits(np.array([b for v in held.values() for b in v]), axis=1)
    return Model.fit(bits, [k for k, v in held.items() for _ in v], landmarks, ridge, sharpness)


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for each row of ``docs``.

    ``und`` with score 0 for a null text, one without letters, or without a model.
    Null ids stay null; repeated rows give repeated rows; an empty table gives none;
    other columns are ignored. Texts are used whole.
    """
    source = id_text(docs, id_col, text_col)
    schema = schema_with(source, "lang_pred string, score double")
    arrow = arrow_schema(schema)
    # At most DIMS x landmarks numbers. Arrays only: tasks don't import this package.
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.landmarks, model.weights, model.languages, model.sharpness))

    def run(batches):
        table, model = letter_table(), shared.value and Model(*shared.value)
        for ids, texts in text_batches(batches):
            names, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
            for i in range(0, len(texts) if model else 0, 256):
                bits, has = presence(texts[i : i + 256], table)
                best, share = model.predict(bits[has])
                for k, b, s in zip(np.flatnonzero(has) + i, best, share):
                    names[k], scores[k] = model.languages[b], s
            yield batch_of(arrow, [ids, names, scores])

    return source.mapInArrow(run, schema)


def keep_identified(docs: DataFrame, model: Model | None, over_chance: float = 1.2, text_col: str = "text") -> DataFrame:
    """``docs`` without the rows whose language can't be told: null texts, texts without
    letters, and those whose best score is below ``over_chance`` times the chance of
    one language among those learned. Without a model, only the first two go.
    All columns stay as they are."""
    plain = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))  # whatever the names are
    arrow, text_at = arrow_schema(plain.schema), docs.columns.index(text_col)
    least = min(over_chance / len(model.languages), 0.99) if model else 0.0
    shared = docs.sparkSession.sparkContext.broadcast(model and (model.landmarks, model.weights, model.languages, model.sharpness))

    def run(batches):
        table, model = letter_table(), shared.value and Model(*shared.value)
        for batch in batches:
            texts, keep = batch.column(text_at), []
            rows = pa.RecordBatch.from_arrays([texts, texts.fill_null("")], ["doc_id", "text"])
            for _, part in text_batches([rows]):
                for i in range(0, len(part), 256):
                    bits, has = presence(part[i : i + 256], table)
                    if model:
                        has[has] = model.predict(bits[has])[1] >= least
                    keep.append(has)
            kept = batch.filter(pa.array(np.concatenate(keep)) if keep else pa.array([], pa.bool_()))
            yield batch_of(arrow, kept.columns)

    return plain.mapInArrow(lean(run), plain.schema).toDF(*docs.columns)


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept out of training: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **train_options) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``: trained on rows that aren't held out,
    applied to all. See ``train`` and ``identify``; a null id isn't held out."""
    model = train(docs, ~held_out(id_col), id_col=id_col, text_col=text_col, lang_col=lang_col, **train_options)
    return identify(docs, model, id_col, text_col).withColumn("held_out", held_out("doc_id")).select("doc_id", "held_out", "lang_pred", "score")
