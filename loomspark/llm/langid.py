"""Language identification: multinomial naive Bayes over hashed character n-grams.

A text is lower-cased by single characters; everything but letters becomes one blank between words.
Each n-gram of ORDERS characters is hashed to one of 2**BITS features. Training counts features per
language over the whole texts of all labelled rows that are not held out: every task adds its texts
into one dense vector a language and emits its non-zero cells, which Spark sums. The driver gets
them a few languages at a time and keeps the matrix of smoothed log probabilities alone, which is
broadcast. It has at most MAX_MATRIX bytes whatever the corpus and however many languages there are:
for each doubling of languages above MAX_MATRIX / (4 * 2**BITS) the hash is cut by one bit, which
adds up the cells of two features. Scoring is by batch in numpy: the n-grams of a batch of texts
become a sparse matrix of texts by features, whose product with the log probabilities is taken
without making a dense one.

The language is the one of the highest posterior. The score is that posterior with the log
likelihood tempered to TEMPER n-grams for longer texts, as n-grams of one text are not independent
and the plain posterior would be 1.

Defined cases: a null text or one without a letter is ``und`` with score 0; so is every text if no
row is labelled; a null doc_id counts as not held out; languages tie to the first by code point; an
empty table gives an empty result; a text of any length is scored in pieces of BLOCK characters,
whole; columns other than doc_id, text, lang are ignored, and lang is read for training only.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm.common import cut

ORDERS = (1, 3)
BITS = 16
SMOOTH = 0.5
FOLDS = 5
TEMPER = 200
#: Bytes that the broadcast matrix may take: 256 languages at full width.
MAX_MATRIX = 64 << 20
#: Cells that the driver gets, and numbers that a product makes, at a time.
SLICE = 1 << 20
#: Characters scored at a time; a block holds no more texts than characters, so their numbers have 16 bits.
BLOCK = (1 << 16) - 1
#: Languages whose counts a task holds before it passes them on (half a megabyte each).
LANGUAGES_AT_ONCE = 64


@lru_cache(maxsize=1)
def _letters():
    """For each code point: its lower case if it is a letter, else a blank."""
    import numpy as np

    table = np.full(0x110000, 32, np.uint32)
    for c in range(0x110000):
        ch = chr(c)
        if ch.isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def features(texts: list[str]):
    """Hashed n-grams of a batch of texts, and for each the number of its text. Texts are told apart by a blank."""
    import numpy as np

    sizes = np.array([len(t) + 2 for t in texts])
    code = _letters()[np.frombuffer("".join([f" {t} " for t in texts]).encode("utf-32-le", "replace"), np.uint32)]
    text = np.repeat(np.arange(len(texts), dtype=np.int32), sizes)
    # Of blanks in a row one stays; at the border of two texts both do.
    blank = code == 32
    keep = np.ones(len(code), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[(np.cumsum(sizes) - sizes)] = True
    code, text = code[keep], text[keep]
    found, owner, n = [], [], len(code)
    for order in ORDERS:
        h = np.full(max(0, n - order + 1), order, np.uint32)
        for k in range(order if len(h) else 0):
            h ^= code[k : n - order + 1 + k]
            h *= np.uint32(0x9E3779B1)
            h ^= h >> np.uint32(15)
        ok = text[: len(h)] == text[order - 1 :] if order > 1 else code != 32
        found.append(h[ok] >> np.uint32(32 - BITS))
        owner.append(text[: len(h)][ok])
    return np.concatenate(found), np.concatenate(owner)


def blocks(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    """Texts with their numbers, some at a time, so that arrays stay small; a long text comes in overlapping pieces."""
    at, some, size = [], [], 0
    for i, t in enumerate(texts):
        for k in range(0, len(t or ""), BLOCK):
            piece = t[max(0, k - max(ORDERS) + 1) : k + BLOCK]
            at.append(i)
            some.append(piece)
            size += len(piece)
            if size >= BLOCK:
                yield at, some
                at, some, size = [], [], 0
    if some:
        yield at, some


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def feature_counts(docs: DataFrame) -> DataFrame:
    """lang, feature and n, summed over all labelled rows that are not held out; feature -1 has the number of rows."""
    import numpy as np

    size = 1 << BITS
    labelled = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))).select("lang", "text")

    def count(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums, rows = {}, {}
        for pdf in frames:
            for lang, group in pdf.groupby("lang", sort=False):
                total = sums.setdefault(lang, np.zeros(size, np.int64))
                rows[lang] = rows.get(lang, 0) + len(group)
                for _, some in blocks(list(group["text"])):
                    total += np.bincount(features(some)[0], minlength=size)
                if len(sums) > LANGUAGES_AT_ONCE:
                    yield cells(sums, rows)
        yield cells(sums, rows)

    def cells(sums: dict, rows: dict) -> pd.DataFrame:
        names, at, n = [], [np.zeros(0, np.int32)], [np.zeros(0, np.int64)]
        for lang, total in sums.items():
            there = np.flatnonzero(total)
            names += [lang] * (len(there) + 1)
            at.append(np.append(there, -1).astype(np.int32))
            n.append(np.append(total[there], rows[lang]))
        sums.clear()
        rows.clear()
        return pd.DataFrame({"lang": pd.Series(names, dtype=object), "feature": np.concatenate(at), "n": np.concatenate(n)})

    return labelled.mapInPandas(count, "lang string, feature int, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, max_matrix: int = MAX_MATRIX):
    """Languages, the matrix of log probabilities (features x languages), log priors, and the bits of a feature that are left out."""
    import numpy as np

    counted = cut(feature_counts(docs))
    langs = sorted(r[0] for r in counted.where("feature = -1").select("lang").collect())
    less = 0
    while less < BITS and 4 * len(langs) << (BITS - less) > max_matrix:
        less += 1
    size = 1 << (BITS - less)
    logs, prior = np.zeros((size, len(langs)), np.float32), np.zeros(len(langs))
    step = max(1, SLICE // size)
    for k in range(0, len(langs), step):
        some = langs[k : k + step]
        codes = F.array_position(F.lit(some), F.col("lang")).cast("int") - 1
        got = counted.where(F.col("lang").isin(some)).groupBy(codes.alias("code"), F.when(F.col("feature") < 0, -1).otherwise(F.shiftright("feature", less)).alias("feature")).agg(F.sum("n").alias("n")).toArrow()
        code, feature, n = (got.column(c).to_numpy() for c in ("code", "feature", "n"))
        seen, counts = feature >= 0, np.zeros((size, len(some)))
        counts[feature[seen], code[seen]] = n[seen]
        prior[k + code[~seen]] = n[~seen]
        logs[:, k : k + len(some)] = np.log(counts + SMOOTH) - np.log(counts.sum(axis=0) + SMOOTH * size)
    return langs, logs, np.log(prior / max(1, prior.sum())), less


def sparse(feature, owner):
    """Rows (texts), columns (features) and values (counts) of the n-grams of a block of fewer than 65,537 texts, sorted by row."""
    import numpy as np

    key = np.sort((owner.astype(np.uint32) << np.uint32(16)) | feature.astype(np.uint32))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return key[first] >> np.uint32(16), key[first] & np.uint32(0xFFFF), np.diff(np.append(first, len(key)))


def product(rows, columns, values, logs, n: int):
    """The sparse matrix (rows, columns, values) of n rows times logs, some cells at a time."""
    import numpy as np

    out = np.zeros((n, logs.shape[1]))
    step = max(1, SLICE // logs.shape[1])
    for k in range(0, len(rows), step):
        r = rows[k : k + step]
        starts = np.flatnonzero(np.append(True, r[1:] != r[:-1]))
        out[r[starts]] += np.add.reduceat(logs[columns[k : k + step]] * values[k : k + step, None], starts, axis=0)
    return out


def predict_batch(texts: list[str | None], langs: list[str], logs, prior, less: int = 0) -> tuple[list[str], list[float]]:
    """The language and score of each text."""
    import numpy as np

    total, n = np.zeros((len(texts), max(1, len(langs)))), np.zeros(len(texts))
    if langs:
        for at, some in blocks(texts):
            feature, owner = features(some)
            at = np.array(at)
            np.add.at(total, at, product(*sparse(feature >> np.uint32(less), owner), logs, len(some)))
            np.add.at(n, at, np.bincount(owner, minlength=len(some)))
    # A text without a letter is blanks alone, which give no n-gram of one character; two of them give none of three.
    letters = n > 0
    shares = prior if langs else 0
    best = (total + shares).argmax(axis=1)
    with np.errstate(divide="ignore"):
        total = total * np.minimum(1, TEMPER / np.maximum(n, 1))[:, None] + shares
    score = 1 / np.exp(total - total[np.arange(len(total)), best][:, None]).sum(axis=1)
    return [langs[b] if ok else "und" for b, ok in zip(best, letters, strict=True)], np.where(letters, score, 0.0).tolist()


def identify(docs: DataFrame, max_matrix: int = MAX_MATRIX) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of docs (doc_id, text, lang)."""
    model = docs.sparkSession.sparkContext.broadcast(train(docs, max_matrix))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            lang, score = predict_batch(list(batch), *model.value)
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict("text").alias("p")).select("doc_id", "held_out", "p.*")
