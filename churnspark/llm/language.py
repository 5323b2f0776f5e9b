"""Language identification: known words by log frequency, unseen words by ever shorter character n-grams."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from string import punctuation
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from churnspark.llm.labelled import draw_labelled
from churnspark.llm.rows import with_text_columns

EACH = 1_500  # distinct labelled texts of each language that the model is fitted on, at most
LONGEST = 5
SMOOTHING = 0.5
EVIDENCE = 40  # words of evidence that a long text counts for, unless told otherwise
CACHED = 500_000  # scored pieces of text a task remembers
UNKNOWN = "und"

_RUN = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> Counter:
    """How often each lower-case run of letters occurs."""
    found = Counter(_RUN.findall(text.lower()))
    for word in [w for w in found if not w.isalpha()]:  # marks and number letters are no letters
        n, only = found.pop(word), "".join(filter(str.isalpha, word))
        if only:
            found[only] += n
    return found


def grams_of(word: str, n: int) -> list[str]:
    """Character n-grams with marks for the word's ends, which alone are no evidence."""
    framed = f"^{word}$" if n > 1 else word
    return [framed[i : i + n] for i in range(len(framed) - n + 1)]


class LanguageModel(NamedTuple):
    languages: list[str]
    tables: list[dict[str, int]]  # [0]: words, [n]: n-grams, each to a row of `rows`
    rows: np.ndarray  # log frequency in each language


def fit_language_model(
    labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", each: int = EACH, most_words: int | None = None, most_grams: int | None = None
) -> LanguageModel:
    """Count words and character n-grams per language over at most ``each`` distinct texts of every language.

    The texts are drawn by hash rank within their language, so a rare language is fitted on all its texts and
    copies count once. All words and n-grams of the drawn texts are kept, or per language the most frequent
    ``most_words`` and, of each length, ``most_grams``. The model grows with the number of languages and with
    ``each``, not with the table. Rows with a null text or language are left out.
    """
    drawn = draw_labelled(labelled, lang_col, each, text_col)
    known = drawn.select("text", F.col("label").cast("string").alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict[str, Counter] = {}
            for text, lang in zip(batch.column(0), batch.column(1), strict=True):
                seen.setdefault(lang.as_py(), Counter()).update(words_of(text.as_py()))
            for lang, words in seen.items():
                for size in range(LONGEST + 1):
                    grams = words if size == 0 else Counter()
                    if size:
                        for word, k in words.items():
                            for gram in grams_of(word, size):
                                grams[gram] += k
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(grams), pa.string()),
                        "size": pa.array([size] * len(grams), pa.int32()),
                        "gram": pa.array(list(grams), pa.string()),
                        "n": pa.array(list(grams.values()), pa.int64()),
                    })

    counts = known.mapInArrow(count, "lang string, size int, gram string, n long").groupBy("lang", "size", "gram")
    counts = counts.agg(F.sum("n").alias("n"))
    counts = counts.withColumn("total", F.sum("n").over(Window.partitionBy("lang", "size")))
    for most, size in ((most_words, F.col("size") == 0), (most_grams, F.col("size") > 0)):
        if most is not None:
            ranked = Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram")
            counts = counts.withColumn("rank", F.row_number().over(ranked)).where(~size | (F.col("rank") <= most)).drop("rank")
    found = counts.select("lang", "size", "gram", "n", "total").toArrow().combine_chunks()  # of the drawn texts, a bounded number per language

    languages = sorted(found["lang"].unique().to_pylist())
    lang = np.array([languages.index(x) for x in found["lang"].unique().to_pylist()], np.int64)[_codes(found["lang"])[1]]
    sizes, n = found["size"].to_numpy(), found["n"].to_numpy()
    tables: list[dict[str, int]] = []
    parts = [np.zeros((0, max(1, len(languages))), np.float32)]
    at = 0
    for size in range(LONGEST + 1):
        mine = np.flatnonzero(sizes == size)
        names, code = _codes(found["gram"].take(pa.array(mine)))
        tables.append(dict(zip(names, range(at, at + len(names)), strict=True)))
        counted = np.full((len(names), max(1, len(languages))), SMOOTHING)
        np.add.at(counted, (code, lang[mine]), n[mine])
        totals = np.ones(max(1, len(languages)))
        totals[lang[mine]] = found["total"].to_numpy()[mine]
        if names:
            parts.append(np.log(counted / (totals + SMOOTHING * len(names))).astype(np.float32))
        at += len(names)
    return LanguageModel(languages, tables, np.concatenate(parts))


def _codes(texts: pa.ChunkedArray) -> tuple[list[str], np.ndarray]:
    """The distinct texts of a column and, for each row, which it is."""
    coded = texts.combine_chunks().dictionary_encode() if len(texts) else pa.array([], pa.string()).dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    return coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.int64)


def evidence_rows(model: LanguageModel, word: str) -> list[int]:
    """Model rows that speak for a word: its own, or for an unseen word those of its longest known n-grams."""
    at = model.tables[0].get(word)
    if at is not None:
        return [at]
    for n in range(min(LONGEST, len(word) + 2), 0, -1):
        table = model.tables[n]
        framed = f"^{word}$" if n > 1 else word
        known = [table[g] for i in range(len(framed) - n + 1) if (g := framed[i : i + n]) in table]
        if known:
            return known
    return []


def piece_scores(model: LanguageModel, pieces: list[str]) -> np.ndarray:
    """For each piece of text between white space: log frequencies of its words summed per language, the number
    of words summed, and the number of words with letters."""
    rows, sizes, owner = [], [], []
    letters = np.zeros(len(pieces), np.float32)
    for i, piece in enumerate(pieces):
        bare = piece if piece.isalpha() else piece.strip(punctuation)
        for word in (bare,) if bare.isalpha() else words_of(bare).elements():
            letters[i] += 1
            if found := evidence_rows(model, word):
                rows += found
                sizes.append(len(found))
                owner.append(i)
    out = np.zeros((len(pieces), len(model.languages) + 2), np.float32)
    out[:, -1] = letters
    if sizes:
        sizes = np.array(sizes)
        means = np.add.reduceat(model.rows[rows], np.cumsum(sizes) - sizes, axis=0) / sizes[:, None]
        np.add.at(out, owner, np.column_stack([means, np.ones(len(sizes)), np.zeros(len(sizes))]))
    return out


def predict_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", share_col: str | None = None, evidence: int = EVIDENCE) -> DataFrame:
    """All columns of ``docs`` with lang_pred and score (columns of these names are replaced).

    The score is that of the words with evidence alone. ``share_col`` names a further column for their share of
    the words with letters; the even chance that a score has to be held against is 1 / number of languages.

    The score is the model's probability of the predicted language, whose evidence counts for no more than
    ``evidence`` words (the mean over all its words is used), so that long texts do not all score 1. A text that is null or has no letter, or any text under a model
    without languages, is `und` with score 0. Letters of which no n-gram is known leave all languages equal;
    ties go to the first language by name. Whole texts are read, repeated rows are scored alike, an empty
    table gives no rows.
    """
    schema = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    if share_col:
        schema = schema.add(share_col, T.DoubleType())
    width = len(model.languages) + 2
    place: dict[str, int] = {}
    memory = np.zeros((0, width), np.float32)

    def score(texts: list[bytes | None]) -> dict[str, pa.Array]:
        nonlocal memory
        pieces = [t.decode().lower().split() if t else [] for t in texts]
        if len(place) > CACHED:
            place.clear()
            memory = memory[:0]
        new = list(set().union(*pieces).difference(place))
        if new:
            place.update(zip(new, range(len(place), len(place) + len(new)), strict=True))
            memory = np.concatenate([memory, piece_scores(model, new)])
        langs, scores, shares = [], [], []
        for run in pieces:
            rows = np.fromiter(map(place.__getitem__, run), np.int64, len(run))
            found = np.ones(len(run), np.float32) @ memory.take(rows, axis=0)
            shares.append(float(found[-2] / max(found[-1], 1)))
            if not found[-1] or not model.languages:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            words = found[-2]
            logs = found[:-2] / max(words, 1) * min(words, evidence)
            chance = np.exp((logs - logs.max()).astype(np.float64))
            best = int(chance.argmax())
            langs.append(model.languages[best])
            scores.append(float(chance[best] / chance.sum()))
        made = {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64())}
        return made | ({share_col: pa.array(shares, pa.float64())} if share_col else {})

    return with_text_columns(docs, text_col, score, schema)
