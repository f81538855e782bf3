"""Language ID, words first: known words score by their log frequency in each language, unseen ones by backing off.

A word that was learnt adds its log frequency in each language. For any other word the longest of its character
n-grams that were learnt decide: n-grams of 5 characters (the word's ends count as one), then 4, and so on to 1, each
step at a fixed discount. Counts come from Spark over a sample of labelled rows, bounded for each language.

Null text or text without letters: ``und`` with score 0, as for every text if there is nothing to learn from. Equal
totals go to the language whose name sorts first. Very long texts count whole. Repeated rows get equal results.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Sent

LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
LONGEST = 5
DISCOUNT = 0.4
CACHED_WORDS = 200_000


def word_grams(word: str, n: int) -> list[str]:
    """The character n-grams of a word whose ends are marked with a blank; a short word is one gram."""
    marked = f" {word} "
    return [marked[i : i + n] for i in range(max(1, len(marked) - n + 1))]


@dataclass
class Model:
    """Log frequencies by language: ``tables[0]`` of words, ``tables[n]`` of n-grams; bounded by ``max_rows``."""

    languages: list[str]
    tables: list[dict[str, int]]
    rows: np.ndarray
    cache: dict[str, int] = field(default_factory=dict)
    extra: list[np.ndarray] = field(default_factory=list)

    def vector(self, word: str) -> np.ndarray:
        """An unseen word's scores: the mean of its known grams of the greatest length that has any."""
        for n in range(LONGEST, 0, -1):
            known = [self.tables[n][g] for g in word_grams(word, n) if g in self.tables[n]]
            if known:
                return self.rows[known].mean(axis=0) * DISCOUNT ** (LONGEST + 1 - n)
        return np.zeros(len(self.languages))

    def predict(self, text: str | None) -> tuple[str, float]:
        words = LETTERS.findall(text.lower()) if text else []
        if not words or not self.languages:
            return "und", 0.0
        total = np.zeros(len(self.languages))
        known, ids = self.tables[0], []
        for w in words:
            at = known.get(w)
            if at is not None:
                ids.append(at)
                continue
            at = self.cache.get(w)
            if at is None:
                if len(self.extra) >= CACHED_WORDS:
                    self.cache.clear()
                    total += np.sum([self.extra[-1 - i] for i in ids if i < 0], axis=0) if any(i < 0 for i in ids) else 0
                    ids = [i for i in ids if i >= 0]
                    self.extra.clear()
                self.extra.append(self.vector(w))
                at = self.cache[w] = -len(self.extra)
            ids.append(at)
        ids_array = np.array(ids)
        total += self.rows[ids_array[ids_array >= 0]].sum(axis=0)
        new = -1 - ids_array[ids_array < 0]
        if len(new):
            which, times = np.unique(new, return_counts=True)
            total += (np.array([self.extra[i] for i in which]) * times[:, None]).sum(axis=0)
        best = int(total.argmax())
        odds = np.exp((total - total[best]) / np.sqrt(len(words)))
        return self.languages[best], float(1 / odds.sum())


def gram_counts(sample: DataFrame) -> DataFrame:
    """``lang``, ``n`` (0 for a word), ``gram``, ``count`` over the texts of ``sample`` (``lang``, ``text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str, Counter[str]] = {}
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(LETTERS.findall(text.lower()))
            for lang, counts in words.items():
                grams: list[Counter[str]] = [counts] + [Counter() for _ in range(LONGEST)]
                for word, times in counts.items():
                    for n in range(1, LONGEST + 1):
                        for g in word_grams(word, n):
                            grams[n][g] += times
                for n, c in enumerate(grams):
                    yield pa.RecordBatch.from_pydict({
                        "lang": pa.array([lang] * len(c)), "n": pa.array([n] * len(c), pa.int32()),
                        "gram": pa.array(list(c)), "count": pa.array(list(c.values()), pa.int64()),
                    })

    parts = sample.mapInArrow(run, "lang string, n int, gram string, count long")
    return parts.groupBy("lang", "n", "gram").agg(F.sum("count").alias("count"))


def train(documents: DataFrame, learn: Column, *, lang_col: str = "lang", text_col: str = "text", id_col: str = "doc_id", per_language: int = 3000, max_rows: int = 300_000) -> Model:
    """Learn from about ``per_language`` rows of each language, chosen by a hash of the id; keep ``max_rows`` grams."""
    rows = documents.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.pmod(F.xxhash64(id_col), F.lit(1 << 20)).alias("_at"))
    # one row for each language
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], [{} for _ in range(LONGEST + 1)], np.zeros((0, 0)))
    below = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, min(1 << 20, (per_language << 20) // n + 1))])
    counts = gram_counts(rows.where(F.col("_at") < below[F.col("lang")]).select("lang", "text"))
    top = counts.groupBy("n", "gram").agg(F.sum("count").alias("total"), F.collect_list(F.struct("lang", "count")).alias("by"))
    top = top.orderBy(F.desc("total"), "n", "gram").limit(max_rows)
    found = top.select("n", "gram", "by").toArrow()
    languages = sorted(sizes)
    number = {k: i for i, k in enumerate(languages)}
    tables: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    seen = np.zeros((len(found), len(languages)))
    order = np.zeros(len(found), np.int64)
    for i, (n, gram, by) in enumerate(zip(found["n"].to_pylist(), found["gram"].to_pylist(), found["by"].to_pylist(), strict=True)):
        tables[n][gram], order[i] = i, n
        for x in by:
            seen[i, number[x["lang"]]] = x["count"]
    for n in range(LONGEST + 1):
        own = order == n
        seen[own] = np.log((seen[own] + 0.5) / (seen[own].sum(axis=0) + 0.5 * max(1, own.sum())))
        # a gram says how much likelier it is in one language than in the mean of all
        seen[own] -= seen[own].mean(axis=1, keepdims=True)
    return Model(languages, tables, seen)


def predict_language(documents: DataFrame, model: Model, *, text_col: str = "text", id_col: str = "doc_id", extra: list[str] | None = None) -> DataFrame:
    """``id_col``, ``extra``, ``lang_pred`` and ``score`` (the winner's share, 0 to 1) for every row."""
    kept = [id_col, *(c for c in extra or [] if c != id_col)]
    rows = documents.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_kept"), F.col(text_col).alias("_text"))
    sent = Sent(documents.sparkSession, model)
    schema = rows.select("_kept").schema.add("lang_pred", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [sent.value.predict(t.as_py()) for t in batch["_text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["_kept"], pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.float64())],
                names=["_kept", "lang_pred", "score"],
            )

    return rows.mapInArrow(run, schema).select("_kept.*", "lang_pred", "score")
